"""First rows of large groups and tables by ranges: equal to sorting, hot groups in many tasks."""

import random

import pytest
from pyspark.sql import functions as F

from rosterforge.operators import ordering, selection


def table(spark, seed=1, n=9000):
    rng = random.Random(seed)
    rows = [(rng.choice(["hot", "hot", "hot", "a", "b", None]), f"{rng.random():.9f}" if i else None, i) for i in range(n)]
    return rows, spark.createDataFrame(rows, "source string, at string, id long")


@pytest.mark.parametrize("n", [1001, 2500, 20000])
@pytest.mark.parametrize("down", [False, True])
def test_groups_equal_sorting(spark, n, down):
    rows, df = table(spark)
    order = [F.col("at").desc_nulls_last() if down else F.col("at"), F.col("id")]
    kept = ordering.first_n_per(df, "source", order, n)
    assert kept.columns == df.columns
    want = set()
    for source in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == source]
        mine.sort(key=(lambda r: (r[1] is not None, r[1] or "")) if not down else (lambda r: r[1] or ""), reverse=down)
        want |= {r[2] for r in mine[:n]}
    assert {r["id"] for r in kept.collect()} == want


def test_a_hot_group_lies_in_many_ranges(spark):
    df = spark.range(20000).select(F.lit("hot").alias("source"), "id")
    placed = ordering._in_ranges(df, [F.col("source"), F.col("id")])
    sizes = [r["count"] for r in placed.groupBy("_part").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 20000 / 4
    plan = ordering.first_n_per(df, "source", [F.col("id")], 5000)._jdf.queryExecution().executedPlan().toString()
    # rows are numbered inside one range of the group, never over the whole of it
    assert "_part" in plan.split("Window [row_number()")[1].splitlines()[0]


@pytest.mark.parametrize("n", [1, 1000, 1001, 4321, 9000, 9001])
def test_first_rows_of_a_table(spark, n):
    rows, df = table(spark, 2)
    rows.sort(key=lambda r: (r[1] is not None, r[1] or ""))
    found = selection.first_rows(df, n, "at")
    assert {r["id"] for r in found.collect()} == {r[2] for r in rows[:n]}
    if 1000 < n < 9000:
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "TakeOrdered" not in plan and "Sort" not in plan


def test_ties_and_nulls_at_the_end(spark):
    df = spark.createDataFrame([(None if i < 1200 else i // 3000, i) for i in range(9000)], "at long, id long")
    kept = ordering.first_n(df, "at", 2000)
    assert kept.groupBy("at").count().orderBy("at").collect() == [(None, 1200), (0, 800)]
    assert ordering.first_n(df, "at", 1100).where("at IS NULL").count() == 1100
    assert ordering.nth(df, "at", 3001) == (1, 3000) and ordering.nth(df, "at", 9001) is None
    empty = df.where("false")
    assert ordering.first_n(empty, "at", 5000).count() == ordering.first_n_per(empty, "id", [F.col("at")], 5000).count() == 0
