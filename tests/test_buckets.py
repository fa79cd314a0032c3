"""Bucketed tables: only touched buckets change, the last row wins, old versions go."""

import os
import random

from pyspark.sql import functions as F

from rosterforge.operators import publish
from rosterforge.plans import publish as publish_plan
from rosterforge.sinks import buckets
from tests.test_jobs import flow

SCHEMA = "k string, part string, v int"


def files(root):
    return {
        os.path.join(folder, name): (os.path.getmtime(os.path.join(folder, name)), os.path.getsize(os.path.join(folder, name)))
        for folder, _, names in os.walk(root) for name in names
    }


def test_runs_equal_a_dictionary(spark, tmp_path):
    rng, root, want = random.Random(3), str(tmp_path / "t"), {}
    for run in range(4):
        rows = [(rng.choice([None, *map(str, range(12))]), rng.choice([None, "a", "b"]), run * 100 + i) for i in range(25)]
        fresh = spark.createDataFrame(rows, SCHEMA)
        assert buckets.upsert(fresh, root, ["k", "part"], [F.col("v").desc()], n_buckets=5) == run + 1
        want.update({(k, part): v for k, part, v in rows})
        got = buckets.current(spark, root, fresh.schema).collect()
        assert len(got) == len(want) and {(r["k"], r["part"]): r["v"] for r in got} == want


def test_untouched_files_stay_the_same(spark, tmp_path):
    root = str(tmp_path / "t")
    rows = spark.range(500).select(F.col("id").cast("string").alias("k"), F.lit("a").alias("part"), F.lit(1).alias("v"))
    buckets.upsert(rows, root, ["k"], [F.col("v").desc()], n_buckets=16)
    before, held = files(f"{root}/data"), buckets.folders(spark, root)
    assert len(held) == 16
    one = rows.where("k = '7'").withColumn("v", F.lit(2))
    touched = one.select(buckets.bucket_of(["k"], 16)).first()[0]
    # the table keeps its number of buckets, whatever a later run asks for
    assert buckets.upsert(one, root, ["k"], [F.col("v").desc()], n_buckets=3) == 2
    after = files(f"{root}/data")
    assert all(after[name] == known for name, known in before.items())
    now = buckets.folders(spark, root)
    assert {b for b in held if held[b] != now[b]} == {touched} and set(now) == set(held)
    assert {r["v"]: r["count"] for r in buckets.current(spark, root, rows.schema).groupBy("v").count().collect()} == {1: 499, 2: 1}
    assert buckets.current(spark, root, rows.schema, 1).where("v = 2").count() == 0
    # rewritten folders are read from the touched bucket alone
    assert {os.path.basename(os.path.dirname(f)) for f in set(after) - set(before) if f.endswith(".parquet") and "/." not in f} == {f"table_bucket={touched}"}


def test_old_versions_go_and_empty_runs_change_nothing(spark, tmp_path):
    root = str(tmp_path / "t")
    none = spark.createDataFrame([], SCHEMA)
    assert buckets.upsert(none, root, ["k"], [F.col("v").desc()]) is None
    assert buckets.current(spark, root, none.schema).count() == 0
    for v in range(4):
        buckets.upsert(spark.createDataFrame([("x", "a", v)], SCHEMA), root, ["k"], [F.col("v").desc()], keep=2)
    assert buckets.upsert(none, root, ["k"], [F.col("v").desc()]) == 4
    assert buckets.manifests(spark, root) == [3, 4]
    assert [r["v"] for v in (3, 4) for r in buckets.current(spark, root, none.schema, v).collect()] == [2, 3]
    assert sum(name.endswith(".parquet") for name in files(f"{root}/data")) == 2


def test_an_unfinished_run_does_not_count(spark, tmp_path):
    root = str(tmp_path / "t")
    fresh = spark.createDataFrame([("x", "a", 1)], SCHEMA)
    buckets.upsert(fresh, root, ["k"], [F.col("v").desc()])
    # rows written and a manifest begun, but not committed
    fresh.write.parquet(f"{root}/data/dead/table_bucket=0")
    os.makedirs(f"{root}/manifest/m=00000002")
    assert buckets.manifests(spark, root) == [1] and buckets.current(spark, root, fresh.schema).count() == 1
    assert buckets.upsert(fresh.withColumn("v", F.lit(5)), root, ["k"], [F.col("v").desc()]) == 2
    assert [r["v"] for r in buckets.current(spark, root, fresh.schema).collect()] == [5]


def test_published_tables(spark, tmp_path):
    result = flow(spark, str(tmp_path / "replies"))
    assert result.to_publish().columns == [*result.final.columns, "_ord"]
    # the same id once more, later in its file, with a name that sorts first
    again = result.to_publish().where("daycare_id = 'TX-1'").withColumn("name", F.lit("A Later Name")).withColumn("_ord", F.col("_ord") + 100)
    final = result.to_publish().unionByName(again)
    records = result.records.unionByName(result.records.withColumn("_ord", F.col("_ord") - 100))
    made = publish_plan.build(final, records, result.research, F.lit("2024-01-01"), "https://f/")
    root = str(tmp_path / "tables")
    assert set(publish_plan.write_buckets(made, root, n_buckets=4).values()) == {1}
    once = {t: sorted(map(str, buckets.current(spark, f"{root}/{t}", s).collect())) for t, s in shapes(made).items()}
    publish_plan.write_buckets(made, root)
    assert once == {t: sorted(map(str, buckets.current(spark, f"{root}/{t}", s).collect())) for t, s in shapes(made).items()}
    names = {r["daycare_id"]: r["name"] for r in buckets.current(spark, f"{root}/daycares", made.listings.schema).collect()}
    assert names == {"TX-1": "A Later Name", "TX-2": "Sun 2"}
    assert len(once["daycare_reviews"]) == 2 and len(once["daycare_enrichments"]) == 1
    plain = publish_plan.write(spark, made, str(tmp_path / "plain"))
    assert {t: len(rows) for t, rows in once.items()} == {t: spark.read.parquet(path).count() for t, path in plain.items()}


def shapes(made):
    reviews = made.reviews.select(*publish_plan.REVIEW_COLUMNS).schema
    return {
        "daycares": made.listings.schema, "daycare_reviews": reviews, "daycare_assets": made.assets.schema,
        "daycare_enrichments": made.enrichments.schema,
    }


def test_put_keeps_other_keys(spark):
    old = spark.createDataFrame([("x", None, 1), ("y", "b", 2)], SCHEMA)
    new = spark.createDataFrame([("x", None, 9)], SCHEMA)
    assert sorted(r["v"] for r in publish.put(old, new, ["k", "part"]).collect()) == [2, 9]
