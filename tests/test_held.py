"""Streaming dedupe with an index in buckets: equal to a dictionary, reads only its buckets, survives reruns and folds."""

import random

import pytest
from pyspark.sql import functions as F

from rosterforge import schemas
from rosterforge.operators.ordering import digest
from rosterforge.streaming import held, incremental

SCHEMA = schemas.struct(k=schemas.S, part=schemas.S, v=schemas.L)


def land(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").json(folder)


def dedupe(spark, tmp_path, state="state", **settings):
    root = str(tmp_path / "root")
    stream = incremental.landed_stream(spark, str(tmp_path / "in"), SCHEMA)
    incremental.run_first_wins(stream, root, str(tmp_path / state), ["k", "part"], ["v"], **settings)
    return incremental.first_wins_table(spark, root, SCHEMA).collect()


def test_batches_equal_a_dictionary(spark, tmp_path):
    rng, want = random.Random(5), {}
    for batch in range(6):
        # a third of all rows has one key; null parts are keys too
        rows = [(rng.choice(["hot", "hot", *map(str, range(8)), None]), rng.choice([None, "", "a"]), batch * 100 + i) for i in range(30)]
        land(spark, str(tmp_path / "in"), rows)
        for k, part, v in rows:
            want.setdefault((k, part), v)
        got = dedupe(spark, tmp_path, n_buckets=7, fold=3)
        assert len(got) == len(want) and {(r["k"], r["part"]): r["v"] for r in got} == want
    index = str(tmp_path / "root" / "_held")
    assert held.buckets(spark, index) == 7
    assert held.segments(spark, index, 6) == [(0, 3), (4, 4), (5, 5)]
    keys = held.digests(spark, index, list(range(7)), 6)
    assert keys.count() == keys.distinct().count() == len(want)
    assert not (tmp_path / "root" / "_staged").exists()


def test_a_batch_reads_only_its_buckets(spark, tmp_path):
    land(spark, str(tmp_path / "in"), [(str(i), "a", i) for i in range(400)])
    dedupe(spark, tmp_path, n_buckets=16)
    index = str(tmp_path / "root" / "_held")
    key = digest(F.lit("7"), F.lit("a"))
    mine = spark.range(1).select(held.bucket_of(key, 16).alias("b")).first()["b"]
    found = held.digests(spark, index, [mine], 1)
    plan = found._jdf.queryExecution().executedPlan().toString()
    filters = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "PartitionFilters: [isnotnull(bucket" in filters and "ReadSchema: struct<key:binary>" in filters
    assert 0 < found.count() < 60
    assert found.where(F.col("key") == key).count() == 1
    assert held.digests(spark, index, [], 1).count() == 0


def test_rerun_and_lost_index(spark, tmp_path):
    land(spark, str(tmp_path / "in"), [("a", "", 1), ("b", "", 2)])
    first = dedupe(spark, tmp_path)
    # the same landed rows again, from an empty cursor: batch 0 is replaced, with its segment
    assert dedupe(spark, tmp_path, "anew") == first
    index = str(tmp_path / "root" / "_held")
    # an index that was never made, or is lost, comes from the kept rows
    held.forget(spark, index, 0)
    assert held.segments(spark, index, 9) == []
    land(spark, str(tmp_path / "in"), [("a", "", 3), ("c", "", 4)])
    got = dedupe(spark, tmp_path, "anew")
    assert sorted((r["k"], r["v"]) for r in got) == [("a", 1), ("b", 2), ("c", 4)]
    assert held.segments(spark, index, 9) == [(0, 0), (1, 1)]


def test_a_failed_batch_adds_nothing_twice(spark, tmp_path, monkeypatch):
    land(spark, str(tmp_path / "in"), [("a", "", 1)])
    dedupe(spark, tmp_path)
    land(spark, str(tmp_path / "in"), [("a", "", 2), ("b", "", 3)])
    whole = held.add

    def fails(*args):
        raise RuntimeError("executor lost")

    monkeypatch.setattr(held, "add", fails)
    # rows of the batch are written, its segment is not
    with pytest.raises(Exception, match="executor lost"):
        dedupe(spark, tmp_path)
    monkeypatch.setattr(held, "add", whole)
    got = dedupe(spark, tmp_path)
    assert sorted((r["k"], r["v"]) for r in got) == [("a", 1), ("b", 3)]


def test_empty_stream(spark, tmp_path):
    land(spark, str(tmp_path / "in"), [("a", "", 1)])
    dedupe(spark, tmp_path)
    land(spark, str(tmp_path / "in"), [])
    assert len(dedupe(spark, tmp_path)) == 1
