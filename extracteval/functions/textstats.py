"""Response length and n-gram diversity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from extracteval.functions.pytext import col_, py_split, round_half_even


def response_length(text: Column | str) -> Column:
    """``len(text.split())``."""
    return F.size(py_split(col_(text)))


def ngrams(tokens: Column, n: int) -> Column:
    """Contiguous n-grams of a whitespace-token array, each joined by one space.

    Built from ``n`` shifted slices zipped together, so no lambda captures the token expression
    (a captured expression is re-evaluated per element).  Tokens never contain whitespace, so
    the joined text identifies the n-gram exactly and ``array_distinct`` stays hash-based.
    """
    count = F.greatest(F.size(tokens) - F.lit(n - 1), F.lit(0))
    shifted = [F.slice(tokens, k + 1, count) for k in range(n)]
    zipped = F.arrays_zip(*shifted)
    grams = F.transform(zipped, lambda z: F.concat_ws(" ", *[z.getField(str(k)) for k in range(n)]))
    return F.when(F.size(tokens) >= n, grams).otherwise(F.array().cast("array<string>"))


def ngram_diversity(text: Column | str, n: int = 2) -> Column:
    """Unique n-grams / n-grams of the lower-cased tokens, 3 dp; fewer than n tokens -> 0.0."""
    toks = py_split(F.lower(col_(text)))
    grams = ngrams(toks, n)
    ratio = F.size(F.array_distinct(grams)).cast("double") / F.size(grams).cast("double")
    return F.when(F.size(toks) < n, F.lit(0.0)).otherwise(round_half_even(ratio, 3))


def distinct_ngrams(text: Column | str, n: int = 2) -> tuple[Column, Column]:
    """(number of n-grams, number of distinct n-grams) of the lower-cased tokens."""
    grams = ngrams(py_split(F.lower(col_(text))), n)
    return F.size(grams), F.size(F.array_distinct(grams))


def with_text_stats(df: DataFrame, text: str, n: int = 2, prefix: str = "") -> DataFrame:
    """Adds ``{prefix}len``, ``{prefix}n_grams``, ``{prefix}n_distinct``, ``{prefix}diversity``.

    Staged projections: tokens and n-grams are each referenced several times below, which keeps
    Catalyst from inlining them (inside higher-order functions an inlined expression would be
    re-evaluated at every reference).  ``lower`` never creates whitespace, so the lower-cased
    token count is also the length of ``text.split()``.
    """
    t = df.withColumn("_tok", py_split(F.lower(F.col(text))))
    t = t.withColumn("_gram", ngrams(F.col("_tok"), n))
    t = t.withColumn("_gd", F.size(F.array_distinct("_gram"))).withColumn("_gn", F.size("_gram"))
    ratio = F.col("_gd").cast("double") / F.col("_gn").cast("double")
    div = F.when(F.size("_tok") < n, F.lit(0.0)).otherwise(round_half_even(ratio, 3))
    return t.select(
        *df.columns,
        F.size("_tok").alias(f"{prefix}len"),
        F.col("_gn").alias(f"{prefix}n_grams"),
        F.col("_gd").alias(f"{prefix}n_distinct"),
        div.alias(f"{prefix}diversity"),
    )
