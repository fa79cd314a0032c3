"""Image ranking by embeddings, and image candidates."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterforge import fixed
from rosterforge.operators.ordering import first_n_per, keep_first

LOGIT_SCALE = 100.0


def prompt_matrix(prompts: DataFrame, total: int) -> np.ndarray:
    """Unit prompt vectors (`ord, vector`) as a matrix; their number is checked."""
    rows = prompts.select("ord", "vector").limit(total + 1).collect()
    if len(rows) != total:
        raise ValueError(f"expected {total} prompt vectors")
    matrix = np.array([r["vector"] for r in sorted(rows, key=lambda r: r["ord"])], dtype=np.float64)
    return matrix / np.linalg.norm(matrix, axis=1, keepdims=True)


def margin_scorer(matrix: np.ndarray, positive: int):
    """Softmax mass of the first ``positive`` prompts minus that of the rest.

    A few array operations per Arrow batch: vectors of some hundred numbers
    against one small matrix is where array lambdas in the JVM are slow.  Every
    sum runs in the order of its terms, so a score depends on its vector alone,
    and images without any mass beside the positive prompts score exactly 1 and
    tie: a matrix product rounds by place in the batch, normalised weights rarely
    add up to 1.  A null vector has a null score.
    """
    columns = np.ascontiguousarray(matrix.T)

    def in_order(terms: Iterable[np.ndarray]) -> np.ndarray:
        total = 0.0
        for term in terms:
            total = total + term
        return total

    @F.pandas_udf(T.DoubleType())
    def score(vectors: pd.Series) -> pd.Series:
        known = vectors.dropna()
        if len(known) == 0:
            return pd.Series(np.nan, index=vectors.index, dtype="float64")
        batch = np.stack(known.to_numpy()).astype(np.float64)
        lengths = np.sqrt(in_order(value * value for value in batch.T))
        cosines = in_order(value[:, None] * column for value, column in zip(batch.T, columns, strict=True)) / lengths[:, None]
        logits = LOGIT_SCALE * cosines
        weights = np.exp(logits - logits.max(axis=1, keepdims=True)).T
        mass, rest = in_order(weights[:positive]), in_order(weights[positive:])
        return pd.Series((mass - rest) / (mass + rest), index=known.index).reindex(vectors.index)

    return score


def score_images(images: DataFrame, prompts: DataFrame, positive: int, total: int) -> DataFrame:
    """Images (`vector`) with their `score` against all prompts.

    The prompts are a fixed handful, so they travel with the function; an
    image stays one row, never multiplied by the number of prompts.
    """
    score = margin_scorer(prompt_matrix(prompts, total), positive)
    return images.withColumn("score", score("vector"))


def rank_images(
    images: DataFrame,
    prompts: DataFrame,
    keys: str | list[str],
    n: int = fixed.IMAGE_TOP_N,
    positive: int = len(fixed.POSITIVE_PROMPTS),
    total: int = len(fixed.POSITIVE_PROMPTS) + len(fixed.NEGATIVE_PROMPTS),
) -> DataFrame:
    """Best ``n`` images per group among files above the size floor.

    A path counts once per group.  Images without a vector are ranked too: they
    have a null score and follow the scored ones by path.
    """
    groups = [keys] if isinstance(keys, str) else list(keys)
    valid = images.where(F.col("size_bytes") > fixed.RANK_MIN_BYTES)
    unique = keep_first(valid, [*groups, "path"], [F.col("path"), F.col("vector").isNull(), F.col("size_bytes").desc(), F.col("vector")])
    scored = score_images(unique, prompts, positive, total)
    return first_n_per(scored, groups, [F.col("score").desc_nulls_last(), F.col("path")], n)


def first_images(images: DataFrame, keys: str | list[str], n: int = fixed.IMAGE_TOP_N) -> DataFrame:
    """Fallback without scores: the first valid paths."""
    groups = [keys] if isinstance(keys, str) else list(keys)
    valid = images.where(F.col("size_bytes") > fixed.RANK_MIN_BYTES)
    unique = keep_first(valid, [*groups, "path"], [F.col("path")])
    return first_n_per(unique, groups, [F.col("path")], n)


def image_candidates(site_images: Column, place_photos: Column, n: int = fixed.IMAGE_CANDIDATE_LIMIT) -> Column:
    """Distinct site images, then place photos; the first ``n``."""
    empty = F.array().cast("array<string>")
    both = F.concat(F.coalesce(site_images, empty), F.coalesce(place_photos, empty))
    return F.slice(F.array_distinct(both), 1, n)
