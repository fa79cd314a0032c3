"""Site text without boilerplate and noise, and ranked site documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterforge import fixed
from rosterforge.functions import text as tx
from rosterforge.functions.urls import pdf_score
from rosterforge.operators.ordering import first_n_per
from rosterforge.session import durable

# Every pattern starts with a plain letter: looking at it first passes most
# positions without trying all patterns.
_INITIALS = "".join(sorted({pattern[0] for pattern in fixed.NOISE_PATTERNS}))
_NOISE = f"(?i)(?=[{_INITIALS}])(?:{'|'.join(fixed.NOISE_PATTERNS)})"


def clean_lines(text: Column) -> Column:
    """Trimmed, filled lines of a text file, without its URL line."""
    lines = F.filter(F.split(text, "\n"), lambda line: ~line.startswith("URL:"))
    return F.filter(F.transform(lines, tx.strip), lambda line: line != "")


def is_noise(line: Column) -> Column:
    return line.rlike(_NOISE)


def is_short(line: Column) -> Column:
    """Fewer than four words and not a heading; few lines reach the second test."""
    heading = line.endswith(":") | (tx.is_upper(line) & (F.char_length(line) > 5))
    return ~tx.has_words(line, 4) & ~heading


def line_key(line: Column) -> Column:
    """Digest of a line: what is counted and compared instead of the text."""
    return F.unhex(F.md5(line))


def file_lines(files: DataFrame) -> DataFrame:
    """Files (`domain, file, ord, text`) with their cleaned `lines` array."""
    return files.select("domain", "file", "ord", clean_lines(F.col("text")).alias("lines"))


def worth_lines(files: DataFrame) -> DataFrame:
    """Files with the cleaned lines that noise and length rules leave."""
    return file_lines(files).select("domain", "file", "ord", _worth("lines").alias("lines"))


def _worth(lines: str) -> Column:
    return F.filter(lines, lambda line: ~is_noise(line) & ~is_short(line))


def boilerplate_keys(files: DataFrame) -> DataFrame:
    """`domain, line_key` of boilerplate lines that no other rule removes.

    Occurrences are counted on digests with a map-side combine, so a line that
    is a third of a site costs one row per task.  Lines that noise and length
    rules drop anyway are left out before they are counted.
    """
    counted = (
        # exploding the expression, not a column of it: Spark would put a size
        # test on the column and work it out once more for that
        file_lines(files)
        .select("domain", F.explode(_worth("lines")).alias("line"))
        .groupBy("domain", line_key(F.col("line")).alias("line_key"))
        .agg(F.count("*").alias("occurrences"))
        .where(F.col("occurrences") > 2)
    )
    return _above_threshold(counted, files).select("domain", "line_key")


def boilerplate_lines(files: DataFrame) -> DataFrame:
    """`domain, line, occurrences, n_files` of every boilerplate line."""
    counted = (
        files.select("domain", F.explode(clean_lines(F.col("text"))).alias("line"))
        .groupBy("domain", "line")
        .agg(F.count("*").alias("occurrences"))
        .where(F.col("occurrences") > 2)
    )
    return _above_threshold(counted, files)


def _above_threshold(counted: DataFrame, files: DataFrame) -> DataFrame:
    sizes = files.groupBy("domain").agg(F.count("*").alias("n_files"))
    return counted.join(sizes, "domain").where(
        F.col("occurrences") > F.greatest(F.lit(2.0), F.col("n_files") * 0.5)
    )


def refined_lines(files: DataFrame) -> DataFrame:
    """Files with the lines that survive boilerplate, noise and length rules.

    The boilerplate of a site is an array: at most twice the mean number of
    lines per file can pass the threshold, so it never outgrows a few pages.
    Files meet it over one join; their lines are never shuffled one by one.
    """
    common = boilerplate_keys(files).groupBy("domain").agg(F.collect_set("line_key").alias("common"))
    unusual = F.filter("lines", lambda line: ~F.array_contains(F.col("common"), line_key(line)))
    return (
        worth_lines(files)
        .join(common, "domain", "left")
        .select(
            "domain", "file", "ord",
            F.when(F.col("common").isNull(), F.col("lines")).otherwise(unusual).alias("lines"),
        )
    )


# shortest block a file can add: header, one character, blank line, joins
_SHORTEST_BLOCK = len("--- Source: x ---\nx\n\n\n")


def _file_block(file: Column, lines: Column) -> Column:
    header = F.concat(F.lit("--- Source: "), file, F.lit(" ---"))
    return F.concat_ws("\n", header, F.array_join(lines, "\n"), F.lit("\n"))


def _document_block(file: Column, pages: Column) -> Column:
    header = F.concat(F.lit("\n--- Source: "), file, F.lit(" (PDF) ---\n"))
    body = F.regexp_replace(F.array_join(pages, "\n"), r"\n{3,}", "\n\n")
    return F.concat_ws("\n", header, body, F.lit("\n"))


def site_bodies(
    files: DataFrame, documents: DataFrame | None = None, cap: int = fixed.SITE_TEXT_CAP
) -> DataFrame:
    """One body per site: `domain, body, full_chars`.

    Text files come first in their order, then extracted documents
    (`domain, file, ord, pages`).  The blocks are written once; which of them
    begin within the cap is worked out on their lengths alone, and only for
    sites that exceed it, so that no task ever holds more than the cap and one
    block of a site.
    """
    # a file without lines has no block; asking for that only after the write
    # keeps its lines from being worked out a second time for the filter
    blocks = refined_lines(files).select(
        "domain", F.lit(0).alias("part"), "ord",
        F.when(F.size("lines") > 0, _file_block(F.col("file"), F.col("lines"))).alias("block"),
    )
    if documents is not None:
        filled = F.filter("pages", lambda page: page != "")
        # documents join the body of a site that has text files; alone they give none
        texted = files.select("domain").distinct()
        extra = documents.where(F.size(filled) > 0).join(texted, "domain", "left_semi").select(
            "domain", F.lit(1).alias("part"), "ord", _document_block(F.col("file"), filled).alias("block")
        )
        blocks = blocks.unionByName(extra)
    blocks = durable(blocks, "blocks").where(F.col("block").isNotNull())
    blocks = blocks.withColumn("chars", F.char_length("block").cast("long"))

    lengths = blocks.select("domain", "part", "ord", "chars")
    long_sites = (
        lengths.groupBy("domain")
        .agg((F.sum("chars") + F.count("*") - 1).alias("full_chars"))
        .where(F.col("full_chars") > cap)
    )
    # every block has a least length, so only so many can begin within the cap
    near = first_n_per(
        lengths.join(long_sites, "domain"), "domain", [F.col("part"), F.col("ord")], cap // _SHORTEST_BLOCK + 1
    )
    before = Window.partitionBy("domain").orderBy("part", "ord").rowsBetween(Window.unboundedPreceding, -1)
    cuts = (
        near.withColumn("_start", F.coalesce(F.sum(F.col("chars") + 1).over(before), F.lit(0)))
        .where(F.col("_start") <= cap)
        .groupBy("domain")
        .agg(F.max(F.struct("part", "ord")).alias("last"), F.max("full_chars").alias("full_chars"))
    )
    shown = blocks.join(cuts, "domain", "left").where(
        F.col("last").isNull() | (F.struct("part", "ord") <= F.col("last"))
    )
    piece = F.struct("part", "ord", F.substring("block", 1, cap + 1).alias("block"))
    bodies = shown.groupBy("domain").agg(
        F.array_sort(F.collect_list(piece)).alias("pieces"),
        F.coalesce(F.max("full_chars"), F.sum("chars") + F.count("*") - 1).alias("full_chars"),
    )
    text = F.array_join(F.transform("pieces", lambda p: p["block"]), "\n")
    body = F.when(
        F.col("full_chars") > cap, F.concat(F.substring(text, 1, cap), F.lit(fixed.SITE_TEXT_CAP_MARK))
    ).otherwise(text)
    return bodies.select("domain", body.alias("body"), "full_chars")


def rank_documents(documents: DataFrame, keys: str | list[str], n: int = fixed.PDF_TOP_N) -> DataFrame:
    """Best ``n`` documents per group by keyword score, ties in given order."""
    scored = documents.withColumn("score", pdf_score(F.col("original_url"), F.col("local_path")))
    return first_n_per(scored, keys, [F.col("score").desc(), F.col("ord")], n)
