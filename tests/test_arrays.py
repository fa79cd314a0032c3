"""Arrays cut over many tasks against one reading of the whole file."""

import gzip
import json
import random

import pytest

from rosterforge import schemas
from rosterforge.sources import arrays, registers

AWKWARD = ['}],[{', '\\"', 'a\\', '"', "{", "]", ",", "é ü", "\n", "\\\\\"}", ""]


@pytest.fixture
def small_blocks(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "500", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "40"}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k in keys:
        spark.conf.unset(k)


def value(rng, deep=0):
    kind = rng.randrange(8 if deep < 3 else 4)
    if kind < 2:
        return "".join(rng.choice(AWKWARD) for _ in range(rng.randrange(4)))
    if kind == 2:
        return rng.choice([1, -2.5, None, True])
    if kind < 6:
        return {f"k{i}": value(rng, deep + 1) for i in range(rng.randrange(4))}
    return [value(rng, deep + 1) for _ in range(rng.randrange(4))]


def read(spark, path, most=arrays.MOST_BYTES):
    return [(r["_raw"], r["_whole"]) for r in arrays.scan_array(spark, str(path), most).orderBy("_ord").collect()]


@pytest.mark.parametrize("indent", [None, 2])
def test_elements_equal_one_reading(spark, tmp_path, small_blocks, indent):
    rng = random.Random(indent or 7)
    made = {}
    for name in ("a", "b", "c"):
        elements = [value(rng) for _ in range(40)]
        (tmp_path / f"{name}.json").write_text(json.dumps(elements, indent=indent, ensure_ascii=False))
        made[name] = elements
    with gzip.open(tmp_path / "d.json.gz", "wt") as f:
        json.dump([{"x": "}"}, 2], f)
    got = read(spark, tmp_path)
    assert all(whole for _, whole in got)
    assert [json.loads(raw) for raw, _ in got] == made["a"] + made["b"] + made["c"] + [{"x": "}"}, 2]
    assert spark.read.option("lineSep", "}").text(str(tmp_path)).rdd.getNumPartitions() >= 8


def test_a_record_over_many_blocks(spark, tmp_path, small_blocks):
    rows = [{"a": 1}, {"long": ["}" * 50 + "x"] * 40, "deep": [{"b": i} for i in range(80)]}, {"c": 2}]
    (tmp_path / "a.json").write_text(json.dumps(rows))
    assert [json.loads(raw) for raw, _ in read(spark, tmp_path)] == rows
    parts = read(spark, tmp_path, 1000)
    assert [w for _, w in parts].count(True) == 2 and "".join(r for r, w in parts if not w).strip() == json.dumps(rows[1])


@pytest.mark.parametrize(
    "text, elements",
    [
        ("", []), (" [ \n ] ", []), ("[1,,2]", ["1", "2"]), ('[{"a":1}', ['{"a":1}']), ('[{"a":1', ['{"a":1']),
        ('[{"a":1},{"b":', ['{"a":1}', '{"b":']), ('x[1]y', ["x", "1", "y"]), ("[1][2]", ["1", "2"]), ('["a]', ['"a]']),
        ('﻿[{"a":{}}]', ['{"a":{}}']), ('[{"a":{}}]\n\n', ['{"a":{}}']), ('[{"a":"\\\\"},"\\"}"]', ['{"a":"\\\\"}', '"\\"}"']),
    ],
)
def test_odd_files(spark, tmp_path, text, elements):
    (tmp_path / "a.json").write_text(text)
    assert [raw.strip() for raw, _ in read(spark, tmp_path)] == elements


def test_broken_elements_are_marked(spark, tmp_path, small_blocks):
    bad = ['5', '"}"', '[{"operation_id":"1"}]', '{"operation_id" 1}', "null", '{"operation_id":"1",}']
    good = [json.dumps({"operation_id": str(i), "operation_name": "}],[{\\"}) for i in range(90)]
    mixed = [x for i, g in enumerate(good) for x in ([g] if i % 15 else [g, bad[i // 15]])]
    (tmp_path / "a.json").write_text("[" + ",".join(mixed) + "]")
    rows = registers.scan_register(spark, str(tmp_path), schemas.RAW_TX, json_lines=False).orderBy("_ord").collect()
    assert [r["_raw"] for r in rows] == mixed
    assert [r["_broken"] for r in rows] == [x in bad for x in mixed]
