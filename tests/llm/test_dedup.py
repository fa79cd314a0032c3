"""Exact dedup and near dedup against plain Python."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from pyspark.sql import functions as F

from rosterforge.llm import bag_minhash, chunk_dedup, components
from rosterforge.llm.arrow_text import mix
from rosterforge.session import durable
from tests.llm.conftest import ODD_ROWS


def lowered(text):
    return (text or "").encode().lower()


def expected_exact(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(lowered(text), []).append(doc_id)
    out = Counter()
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        done = False
        for i in ids:
            kept = i == keep and not done
            done = done or kept
            out[(i, keep, len(ids), kept, hashlib.sha256(text).hexdigest())] += 1
    return out


@pytest.mark.parametrize("id_bits", [64, 3])
def test_exact_groups(odd, id_bits):
    # with three bits nearly every identifier fails its verification
    rows = chunk_dedup.decide(odd, mean=64, id_bits=id_bits).collect()
    found = Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in rows)
    assert found == expected_exact([r[:2] for r in ODD_ROWS])


def test_recipes_make_the_groups_and_digests_split_wrong_ones(odd):
    made = chunk_dedup.verify(chunk_dedup.recipes(odd, mean=64)).cache()
    # without a digest that tells them apart, the same groups
    blind = chunk_dedup.grouped(made.withColumn("text_sha256", F.lit("x"))).collect()
    found = Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in blind)
    assert found == Counter(k[:4] for k in expected_exact([r[:2] for r in ODD_ROWS]).elements())
    # with one recipe for all, digests alone
    rows = chunk_dedup.grouped(made.withColumn("recipe", F.array(F.lit(1).cast("long")))).collect()
    found = Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in rows)
    assert found == expected_exact([r[:2] for r in ODD_ROWS])


def test_exact_rows(odd, empty):
    kept = chunk_dedup.unique(odd)
    assert kept.schema == odd.schema
    expected = expected_exact([r[:2] for r in ODD_ROWS])
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(k[0] for k in expected.elements() if k[3])
    assert chunk_dedup.unique(empty).count() == 0 and chunk_dedup.decide(empty).count() == 0


def test_boundaries_follow_content():
    rng = np.random.default_rng(0)
    body = rng.integers(97, 123, 50_000).astype(np.uint8)
    moved = np.concatenate([rng.integers(97, 123, 333).astype(np.uint8), body])
    one, _ = chunk_dedup.boundaries(body, np.array([0, len(body)]))
    two, _ = chunk_dedup.boundaries(moved, np.array([0, len(moved)]))
    assert len(set(one.tolist()) & set((two - 333).tolist())) > 0.9 * len(one)
    # neighbours in a batch change nothing
    both, counts = chunk_dedup.boundaries(np.concatenate([moved, body]), np.array([0, len(moved), len(moved) + len(body)]))
    assert (both[counts[0] :] - len(moved)).tolist() == one.tolist()
    flat, _ = chunk_dedup.boundaries(np.full(100_000, 97, np.uint8), np.array([0, 100_000]))
    assert np.diff(flat).max() <= 8192


def bag(text):
    words = lowered(text).split()
    if not words:
        return Counter()
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def expected_classes(rows, threshold=0.8):
    bags = [bag(t) for _, t in rows]
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common, union = sum((bags[i] & bags[j]).values()), sum((bags[i] | bags[j]).values())
            if union == 0 or common >= threshold * union:
                parent[top(i)] = top(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(top(i), []).append(rows[i][0])
    out = Counter()
    for ids in groups.values():
        known = [i for i in ids if i is not None]
        for i in ids:
            out[(i, min(known) if known else None, len(ids))] += 1
    return out, len(groups)


def check_classes(docs, rows):
    found = bag_minhash.classes(docs).collect()
    expected, groups = expected_classes(rows)
    assert Counter((r["doc_id"], r["class_id"], r["class_size"]) for r in found) == expected
    assert sum(r["kept"] for r in found) == groups
    assert all(r["doc_id"] == r["class_id"] for r in found if r["kept"] and r["class_id"] is not None)


def test_near_classes_of_odd_rows(odd, empty):
    check_classes(odd, [r[:2] for r in ODD_ROWS])
    kept = bag_minhash.one_of_each(odd)
    assert kept.schema == odd.schema and kept.count() == expected_classes([r[:2] for r in ODD_ROWS])[1]
    assert bag_minhash.classes(empty).count() == 0


def test_near_classes_of_edited_groups(docs_of):
    random.seed(5)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for group in range(6):
        base = [random.choice(vocabulary) for _ in range(150)]
        for _ in range(25):
            words = list(base)
            for _ in range(random.choice([0, 1, 1, 2, 3, 6, 9])):
                words[random.randrange(len(words))] = random.choice(vocabulary)
            if group == 0:  # counts matter: a repeated passage is part of the multiset
                words += words[:20] * random.randrange(4)
            rows.append((len(rows) * 3 + 1, " ".join(words)))
    random.shuffle(rows)
    check_classes(docs_of(rows), rows)


def test_near_classes_at_a_lower_threshold(docs_of):
    random.seed(6)
    rows = []
    for group in range(40):
        base = [f"g{group}w{i}" for i in range(150)]
        for copy in range(4):
            words = list(base)
            for i in random.sample(range(5, 145), 8 if copy else 0):
                words[i] = f"g{group}c{copy}x{i}"
            rows.append((len(rows) * 3 + 1, " ".join(words)))
    found = bag_minhash.classes(docs_of(rows), 0.5).collect()
    assert Counter((r["doc_id"], r["class_id"], r["class_size"]) for r in found) == expected_classes(rows, 0.5)[0]


def test_banding_follows_the_threshold():
    assert bag_minhash.banding(0.8) == bag_minhash.banding(0.95) == (24, 5, 74)
    for threshold in (0.79, 0.7, 0.5, 0.3, 0.1):
        bands, rows, agree = bag_minhash.banding(threshold)
        assert bands * rows == 120 and (1 - threshold**rows) ** bands < 1e-4 and 0 <= agree < 120 * threshold
    with pytest.raises(ValueError):
        bag_minhash.banding(0.05)


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(2)
    shared, own = mix(np.arange(300, dtype=np.uint64)), mix(np.arange(1000, 1100, dtype=np.uint64))
    one = np.concatenate([shared, np.repeat(shared[:40], 5)])
    two = np.concatenate([shared, np.repeat(shared[:40], rng.integers(1, 9, 40)), own])
    a, b = Counter(one.tolist()), Counter(two.tolist())
    exact = sum((a & b).values()) / sum((a | b).values())
    text, shingle, weight, elements = bag_minhash.bags(np.concatenate([one, two]), np.array([len(one), len(two)]))
    found = bag_minhash.signatures(text, shingle, weight, 2, 20_000)
    assert abs((found[0] == found[1]).mean() - exact) < 0.02
    left, right = elements[: len(one)], elements[len(one) :]
    assert abs(bag_minhash.jaccard([left], [right])[0] - exact) < 1e-12


@pytest.mark.parametrize(("join", "hot"), [(bag_minhash._with_class, "root"), (bag_minhash._placed, "key")])
def test_a_hot_key_is_split_by_spark(spark, join, hot):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
    }
    rows = spark.range(0, 20_000, 1, 8).select(
        F.col("id").alias("uid"), F.col("id").alias("doc_id"), F.col("id").alias("text_hash"), F.col("id").alias("rid"), F.lit(0).alias("band")
    )
    # two thirds of the rows have one key; every key holds two components where the key is not the component
    key = F.expr("IF(uid % 3 < 2, 0, uid DIV 30)")
    rows = rows.withColumns({hot: key} if hot == "root" else {"key": key, "root": F.expr("uid % 2")})
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        done = join(durable(rows, "hot-rows"))
        assert len(done.collect()) == 20_000
        assert "skew=true" in done._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize(("star", "hub"), [(components._large_star, -1), (components._small_star, 100_000)])
def test_a_node_with_many_links_is_split_by_spark(spark, star, hub):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
    }
    # one node links to two thirds of the others, the rest are pairs
    links = spark.range(0, 20_000, 1, 8).selectExpr(f"IF(id % 3 < 2, CAST({hub} AS BIGINT), 200000 + id) AS a", "id AS b")
    links = links.selectExpr("greatest(a, b) AS a", "least(a, b) AS b")
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        done = star(durable(links, "hot-links"))
        found = {tuple(r) for r in done.collect()}
        assert "skew=true" in done._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    pairs = {(200_000 + i, i) for i in range(20_000) if i % 3 == 2}
    members = {i for i in range(20_000) if i % 3 < 2} | {hub}
    root = min(members)
    assert found == pairs | {(i, root) for i in members - {root}}
    roots = {r.node: r.root for r in components.connected(links).collect()}
    assert roots == dict(pairs) | {b: b for _, b in pairs} | dict.fromkeys(members, root)
