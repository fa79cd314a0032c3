"""Queries over the training-data operators, each beside its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from rosterforge.llm import bag_minhash, chunk_dedup, cross_tokens, language_id, pigeonhole_join, pseudo_likelihood, quality_mil, repeat_spans, source_mix, ss_packing, token_files, turn_repair, url_filter
from rosterforge.session import durable_path

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable:
    def add(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        REGISTRY[name] = Query(run, sql)
        return run

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query("op5_quality_classifier")
def quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    return quality_mil.classify(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query(
    "op3_exact_dedup",
    """
    WITH t AS (
        SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))
            AS text_sha256 FROM documents
    )
    SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
        doc_id = max(doc_id) OVER g AS kept, text_sha256
    FROM t WINDOW g AS (PARTITION BY text_sha256)
    """,
)
def exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return chunk_dedup.decide(table(spark, sf, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )


@query("op8_minhash_near_dedup")
def minhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return bag_minhash.classes(table(spark, sf, "documents")).select("doc_id", "class_id", "class_size", "kept")


@query("op4_sum_of_squares_packing")
def sum_of_squares_packing(spark: SparkSession, sf: str) -> DataFrame:
    return ss_packing.pack(table(spark, sf, "documents"), WORD_BPE, with_ids=False)


@query("op6_token_files")
def token_id_files(spark: SparkSession, sf: str) -> DataFrame:
    path = durable_path(spark, "token-files")
    token_files.write(table(spark, sf, "documents"), path, WORD_BPE)
    return token_files.digests(token_files.read(spark, path))


@query("op10_source_mix")
def mix_sources(spark: SparkSession, sf: str) -> DataFrame:
    return source_mix.taken(table(spark, sf, "documents"))


@query("op1_url_filter")
def filter_urls(spark: SparkSession, sf: str) -> DataFrame:
    return url_filter.judge(table(spark, sf, "pages"), url_filter.train(url_filter.labelled_urls(spark)))


@query("op7_language_id")
def identify_languages(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return language_id.identify(docs, language_id.train(docs))


@query("op9_pseudo_likelihood")
def pseudo_likelihood_scores(spark: SparkSession, sf: str) -> DataFrame:
    return pseudo_likelihood.score_corpus(table(spark, sf, "documents"))


@query(
    "op2_pigeonhole_join",
    """
    WITH RECURSIVE v AS (
        SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
        WHERE embedding IS NOT NULL AND len(embedding) > 0
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
            AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    ), links AS (
        SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
        WHERE list_cosine_similarity(a.e, b.e) >= 0.9
    ), reach AS (
        SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
    ), least AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
    counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
    SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(least.b, vec_id)) AS component_id,
        vec_id = least(vec_id, coalesce(least.b, vec_id)) AS kept
    FROM embeddings LEFT JOIN counts ON counts.a = vec_id LEFT JOIN least ON least.a = vec_id
    """,
)
def pigeonhole(spark: SparkSession, sf: str) -> DataFrame:
    return pigeonhole_join.link(table(spark, sf, "embeddings"))


@query("op13_cross_tokens")
def cross_tokenizer_alignment(spark: SparkSession, sf: str) -> DataFrame:
    return cross_tokens.link_scores(table(spark, sf, "documents"), BYTE_BPE, PIECES)


@query("op11_repeat_spans")
def repeated_spans(spark: SparkSession, sf: str) -> DataFrame:
    return repeat_spans.removed(table(spark, sf, "documents"))


@query("op12_turn_repair")
def conversation_repair(spark: SparkSession, sf: str) -> DataFrame:
    given = table(spark, sf, "conversations")
    return turn_repair.report(turn_repair.damage(given), given)
