"""Token ids as Parquet list columns that can be read in part.

Documents are range-partitioned and sorted by doc_id, encoded in place, and
written by Spark's Parquet writer: one row per document with its id, its number
of ids, where its ids begin in the file, and the ids as a list column.  Row
groups are kept small, pages hold few rows, and the writer adds page indexes, so
a reader of a doc_id range opens only the pages it needs, and a reader of
counts never touches the ids.  Ids are dictionary-encoded (the dictionary of a
50k vocabulary fits its page) or, on request, delta-encoded.

The text moves once (the range exchange); ids never move.  The position of a
document among all ids is its position in the file plus the files before it,
one number per file.

Defined cases: a null or empty text is the end id alone; repeated ids lie next
to each other in the order of their texts' hashes; a null doc_id sorts first;
an empty table gives an empty file; other columns are not written.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rosterforge.llm.arrow_text import column_bytes, slices
from rosterforge.llm.word_tokens import loaded
from rosterforge.session import ship_package

SCHEMA = "doc_id long, n_tokens long, file_start long, ids array<int>"


def write(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, encoding: str = "dictionary",
    row_group_bytes: int = 32 << 20, page_bytes: int = 256 << 10, page_rows: int = 500,
) -> None:
    """Encode every document and write the files; an existing path is an error."""
    if encoding not in ("dictionary", "delta"):
        raise ValueError(f"unknown encoding {encoding!r}")
    ship_package(docs.sparkSession)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = loaded(tokenizer)
        end = end_id.to_bytes(4, "little")
        begun = 0
        for batch in batches:
            data, offsets = column_bytes(batch.column(1))
            for low, high in slices(offsets, 4 << 20):
                blobs = [words.encode(data[offsets[i] : offsets[i + 1]].tobytes()) + end for i in range(low, high)]
                ends = np.concatenate([[0], np.cumsum([len(b) // 4 for b in blobs])])
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(blobs), np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), pa.array(np.diff(ends)), pa.array(ends[:-1] + begun), ids],
                    ["doc_id", "n_tokens", "file_start", "ids"],
                )
                begun += int(ends[-1])

    placed = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("_hash"))
    ordered = placed.repartitionByRange("doc_id", "_hash").sortWithinPartitions("doc_id", "_hash").select("doc_id", "text")
    (
        ordered.mapInArrow(encoded, SCHEMA).write
        .option("compression", "zstd")
        .option("parquet.block.size", str(row_group_bytes))
        .option("parquet.page.size", str(page_bytes))
        .option("parquet.page.row.count.limit", str(page_rows))
        .option("parquet.enable.dictionary", str(encoding == "dictionary").lower())
        .option("parquet.dictionary.page.size", str(1 << 20))
        .option("parquet.writer.version", "PARQUET_2_0" if encoding == "delta" else "PARQUET_1_0")
        .parquet(path)
    )


def read(spark: SparkSession, path: str) -> DataFrame:
    """`doc_id, start, n_tokens, ids` of every document; columns that are not asked for are not read."""
    # the number in the name, so that a hundred thousand files still sort by their place
    number = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("long")
    rows = spark.read.schema(SCHEMA).parquet(path).withColumn("_file", number)
    # one row per file
    sizes = rows.groupBy("_file").agg(F.sum("n_tokens").alias("_size"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("_file", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_base"))
    return rows.join(bases, "_file").select("doc_id", (F.col("_base") + F.col("file_start")).alias("start"), "n_tokens", "ids")


def digests(stored: DataFrame) -> DataFrame:
    """`doc_id, start, n_tokens, ids_crc32` of stored documents."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(3)
            ends = np.asarray(ids.offsets).astype(np.int64) * 4
            data = memoryview(ids.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False).view(np.uint8))
            crcs = [zlib.crc32(data[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(crcs, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    columns = stored.select("doc_id", "start", "n_tokens", "ids")
    return columns.mapInArrow(summed, "doc_id long, start long, n_tokens long, ids_crc32 long")
