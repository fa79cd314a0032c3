"""The lines of a run against a plain loop: resume, id filter, limit, blank and broken lines, counts."""

import json
import random

import pytest
from pyspark.sql import functions as F

from rosterforge.operators import run_input
from rosterforge.schemas import S, struct

SCHEMA = struct(id=S, name=S)


def loop(lines, ids, start, limit):
    """What one reader would do, line by line."""
    kept, counts, at = [], dict.fromkeys(run_input.OUTCOMES, 0), 0
    for at, line in enumerate(lines):
        if at < start:
            counts["earlier"] += 1
            continue
        if limit and len(kept) >= limit:
            counts["later"] += len(lines) - at
            break
        if line is None or not line.strip():
            counts["blank"] += 1
            continue
        try:
            record = json.loads(line)
            assert isinstance(record, dict)
        except (ValueError, AssertionError):
            counts["bad_json"] += 1
            continue
        if ids is not None and record.get("id", "") not in ids:
            counts["skipped"] += 1
            continue
        kept.append((at, record.get("id"), record.get("name")))
    counts["kept"] = len(kept)
    return kept, counts


def some_lines(n=400, seed=4):
    rng = random.Random(seed)
    made = []
    for i in range(n):
        # a third of the records have one id
        good = json.dumps({"id": rng.choice(["hot", "hot", *map(str, range(6))]), "name": f"n{i}"})
        made.append(rng.choice([good] * 6 + [good[:-1], "", "  ", "[1]", None, '{"name": "no id"}', good + ",0] junk"]))
    return made


@pytest.mark.parametrize("ids", [None, ["hot", "3"], ["", "1"], []])
@pytest.mark.parametrize("start,limit", [(0, None), (37, 0), (37, 25), (0, 10000), (900, 5)])
def test_equals_a_plain_loop(spark, ids, start, limit):
    made = some_lines()
    lines = spark.createDataFrame([(i, x) for i, x in enumerate(made)], "_ord long, line string")
    wanted = None if ids is None else spark.createDataFrame([(i,) for i in [*ids, *ids]], "id string")
    found = run_input.read(lines, SCHEMA, wanted, start, limit)
    kept, counts = loop(made, ids, start, limit)
    assert found.counts == counts and sum(counts.values()) == len(made)
    assert sorted((r["_ord"], r["id"], r["name"]) for r in found.records.collect()) == kept
    assert found.bad.count() == counts["bad_json"]


def test_the_limit_met_by_the_last_record(spark):
    made = ['{"id": "1"}', '{"id": "2"}', "", "broken", '{"id": "9"}']
    lines = spark.createDataFrame([(i, x) for i, x in enumerate(made)], "_ord long, line string")
    ids = spark.createDataFrame([("1",), ("2",)], "id string")
    found = run_input.read(lines, SCHEMA, ids, 0, 2)
    assert found.counts == loop(made, {"1", "2"}, 0, 2)[1]
    assert found.counts["later"] == 3 and found.counts["skipped"] == 0


def test_no_lines(spark):
    lines = spark.createDataFrame([], "_ord long, line string")
    found = run_input.read(lines, SCHEMA, None, 0, 3)
    assert set(found.counts.values()) == {0} and found.records.count() == found.bad.count() == 0


def test_written_and_failed(spark, tmp_path):
    rows = [(("a",), ("a",), None, None, None), (("b",), ("b",), "ERROR", "late", ""), (("c",), ("c",), "ERROR", None, "bad reply")]
    schema = "original_record struct<id string>, final struct<id string>, research_status string, research_error string, synthesis_error string"
    outcomes = spark.createDataFrame(rows, schema)
    counts = run_input.write(outcomes, str(tmp_path / "out"), str(tmp_path / "retry"), F.lit("t"))
    assert counts == {"written": 2, "failed": 3}
    assert spark.read.json(str(tmp_path / "out")).count() == 2 and spark.read.json(str(tmp_path / "retry")).count() == 3
    one = run_input.totals(spark, {**dict.fromkeys(run_input.OUTCOMES, 1)}, counts).first().asDict()
    assert one["lines"] == 6 and one["written"] == 2 and one["failed"] == 3 and one["skipped"] == 1
