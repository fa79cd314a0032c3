"""Model calls: bounded in flight, stored by step and bucket, asked once."""

import threading
import time

from pyspark.sql import functions as F

from rosterforge.operators import model_calls


def files(folder):
    return {str(p): p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}


def test_calls_in_flight_are_bounded_and_ordered(spark, tmp_path):
    log = tmp_path / "open"
    log.mkdir()

    def make():
        lock, count = threading.Lock(), [0]

        def call(prompt):
            with lock:
                count[0] += 1
                (log / f"{count[0]}").touch()
            time.sleep(0.005)
            with lock:
                count[0] -= 1
            return prompt + "!", 1, 1

        return call

    prompts = spark.range(60).coalesce(1).select(F.col("id").cast("string").alias("daycare_id"), F.concat(F.lit("p"), "id").alias("prompt"))
    replies = model_calls.apply_model(prompts, make, "s", in_flight=3).collect()
    assert [(r["daycare_id"], r["reply"]) for r in replies] == [(str(i), f"p{i}!") for i in range(60)]
    assert sorted(p.name for p in log.iterdir()) == ["1", "2", "3"]


def test_a_retry_reads_only_its_buckets(spark, tmp_path):
    store = tmp_path / "store"

    def broken():
        def call(prompt):
            if prompt == "p7":
                raise ValueError("no")
            return prompt, 1, 1

        return call

    def never():
        def call(prompt):
            if prompt != "p7":
                raise AssertionError("asked again")
            return "mended", 1, 1

        return call

    prompts = spark.range(200).select(F.col("id").cast("string").alias("daycare_id"), F.concat(F.lit("p"), "id").alias("prompt"))
    one = prompts.where("prompt = 'p7'")
    model_calls.run_model(prompts, broken, "s", str(store), n_buckets=16, tries=1)
    model_calls.run_model(prompts, broken, "other step", str(store), n_buckets=16, tries=1)
    assert len({p.parent for p in (store / "step=s").rglob("*.parquet")}) == 16
    before = files(store)
    found = model_calls.run_model(one, never, "s", str(store), n_buckets=16, tries=1)
    assert [(r["daycare_id"], r["reply"], r["error"]) for r in found.collect()] == [("7", "mended", None)]
    added = set(files(store)) - set(before)
    assert len(added) == 1 and "step=s" in added.pop() and before.items() <= files(store).items()
    scan = next(x for x in found._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in x and "reply" in x)
    assert "step" in scan.split("PartitionFilters")[1] and "bucket" in scan.split("PartitionFilters")[1]
    # nothing is missing now: every reply comes from the store
    assert model_calls.run_model(prompts, never, "s", str(store), n_buckets=16, tries=1).where("error IS NULL").count() == 200


def test_repeated_and_empty_prompts(spark, tmp_path):
    log = tmp_path / "calls"
    log.mkdir()

    def make():
        import uuid

        def call(prompt):
            (log / uuid.uuid4().hex).touch()
            return f"<{prompt}>", 1, 1

        return call

    rows = [("1", "a"), ("1", "a"), ("1", "b"), ("2", ""), ("2", "")]
    prompts = spark.createDataFrame(rows, "daycare_id string, prompt string")
    found = model_calls.run_model(prompts, make, "s", str(tmp_path / "store")).collect()
    assert sorted((r["daycare_id"], r["reply"]) for r in found) == [("1", "<a>"), ("1", "<b>"), ("2", "<>")]
    assert len(list(log.iterdir())) == 3
    assert model_calls.run_model(prompts.where("false"), make, "s", str(tmp_path / "store")).count() == 0
    assert model_calls.run_model(prompts.where("false"), make, "s", str(tmp_path / "none")).count() == 0
