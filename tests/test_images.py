"""Scores of images by embeddings."""

import duckdb
import numpy as np

from rosterforge.catalog import REGISTRY
from rosterforge.operators import images
from rosterforge.plans import enrich
from tools.check_oracle import rows_of


def _vectors(n, at, rng):
    made = rng.normal(0, 0.1, (n, 16))
    made[:, at] += 1
    return made


def test_images_without_negative_mass_tie_by_path(spark):
    rng = np.random.default_rng(5)
    prompts = [(i, v.tolist()) for i, v in enumerate([*_vectors(12, 0, rng), *_vectors(12, 8, rng)])]
    rows = [(i % 3, f"img_{i}.jpg", v.tolist(), 20000) for i, v in enumerate(_vectors(600, 0, rng))]
    shown = spark.createDataFrame(rows, "label int, path string, vector array<float>, size_bytes int").repartition(5)
    ranked = images.rank_images(shown, spark.createDataFrame(prompts, "ord int, vector array<float>"), "label").collect()
    assert {r["score"] for r in ranked} == {1.0}
    want = {(label, path) for label in range(3) for path in sorted(p for at, p, *_ in rows if at == label)[:10]}
    assert {(r["label"], r["path"]) for r in ranked} == want


def test_a_score_depends_on_its_vector_alone(spark):
    rng = np.random.default_rng(6)
    prompts = [(i, v.tolist()) for i, v in enumerate(_vectors(24, 0, rng))]
    vector = rng.normal(0, 1, 16).tolist()
    shown = spark.createDataFrame([(i, vector) for i in range(1001)], "i int, vector array<float>").repartition(3)
    scored = images.score_images(shown, spark.createDataFrame(prompts, "ord int, vector array<float>"), 12, 24)
    assert scored.select("score").distinct().count() == 1


def _embeddings(rng):
    """Labels 0 (all scored), 1 (three scored, the rest without a vector), 2 and null (none scored)."""
    made = [(i, rng.normal(0, 1, 16).tolist(), 0) for i in range(104)]
    made += [(i, rng.normal(0, 1, 16).tolist() if i in (104, 112, 120) else None, 1) for i in range(104, 144)]
    return made + [(i, None, 2) for i in range(144, 184)] + [(i, None, None) for i in range(184, 192)]


def test_images_without_a_vector_follow_the_scored_ones(spark, tmp_path):
    rows = _embeddings(np.random.default_rng(7))
    shown = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(5)
    shown.write.parquet(f"{tmp_path}/embeddings.parquet")
    ranked = REGISTRY["q_image_rank"].run(spark, str(tmp_path))
    mine = rows_of(ranked.columns, ranked.collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    result = con.execute(REGISTRY["q_image_rank"].sql)
    assert mine == rows_of([d[0] for d in result.description], result.fetchall())
    found = {label: [(path, score) for at, path, score in mine if at == label] for label in (0, 1, 2, None)}
    assert {label: len(v) for label, v in found.items()} == {0: 10, 1: 10, 2: 10, None: 4}
    assert {path for path, score in found[1] if score is not None} == {"img_104.jpg", "img_112.jpg", "img_120.jpg"}
    assert {path for path, _ in found[None]} == {f"img_{i}.jpg" for i in (184, 185, 188, 189)}


def test_unread_images_of_a_site_stand_in_only_without_scored_ones(spark):
    rng = np.random.default_rng(8)
    prompts = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(_vectors(24, 0, rng))], "ord int, vector array<float>")
    rows = [("some.org", f"{i:02}.jpg", rng.normal(0, 1, 16).tolist() if i in (3, 7) else None, 20000) for i in range(12)]
    rows += [("none.org", f"{i:02}.jpg", None, 5000 if i == 0 else 20000) for i in range(12)]
    media = spark.createDataFrame(rows, "domain string, local_path string, vector array<float>, size_bytes int").selectExpr(
        "*", "'image' AS type", "local_path AS original_url", "0 AS ord"
    )
    manifest = spark.createDataFrame([("some.org", True), ("none.org", True)], "domain string, website_active boolean")
    texts = spark.createDataFrame([], "domain string, file string, ord int, text string")
    refined = {r["domain"]: r["verified_images"] for r in enrich.refine_stage(manifest, texts, media, prompts, None).collect()}
    assert sorted(refined["some.org"]) == ["03.jpg", "07.jpg"]
    assert refined["none.org"] == [f"{i:02}.jpg" for i in range(1, 11)]
