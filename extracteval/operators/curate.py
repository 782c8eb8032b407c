"""Preference-pair curation: field coalescing, filters, completion normalisation, sampling,
batching and epochs (F1-F6, P9, T1-T6).

Sampling takes the least ``md5(seed:id)``: the same rows are picked whatever the partitioning, and
a histogram of the digests finds the cut (only the sample is sorted, no task holds all of it).  Batch numbering is an
exact global ordinal computed with ``scan.ordinal_within`` over digest-prefix levels.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from extracteval.operators.scan import hex_levels, least_by_digest, ordinal_within

# Alternative field names, tried in this order.
CHOSEN_SCORE_NAMES = ("chosen_rating", "rating_chosen", "chosen_score")
PROMPT_NAMES = ("input", "question", "prompt", "instruction")
REJECTED_SCORE_NAMES = ("rejected_rating", "rating_rejected", "rejected_score")
MIN_SCORE = 4.0


def first_present(df: DataFrame, names: Sequence[str], default) -> Column:
    """first non-null among the columns that exist, else ``default`` (absent columns skipped)."""
    cols = [F.col(c) for c in names if c in df.columns]
    return F.coalesce(*cols, F.lit(default))


def _score(df: DataFrame, names: Sequence[str]) -> Column:
    cols = [F.col(c).try_cast("double") for c in names if c in df.columns]
    return F.coalesce(*cols, F.lit(0.0))


def coalesce_fields(df: DataFrame) -> DataFrame:
    """add chosen_value, prompt_text, rejected_value."""
    return df.select(
        "*",
        _score(df, CHOSEN_SCORE_NAMES).alias("chosen_value"),
        first_present(df, PROMPT_NAMES, "").alias("prompt_text"),
        _score(df, REJECTED_SCORE_NAMES).alias("rejected_value"),
    )


def is_tie(chosen: Column, rejected: Column) -> Column:
    """F2: a tie needs both scores non-zero (and not NaN) and equal."""
    return (chosen != 0) & (rejected != 0) & ~F.isnan(chosen) & (chosen == rejected)


def non_empty(df: DataFrame, name: str) -> Column:
    """Python truthiness of a text, message-list or VARIANT column (null -> false)."""
    if name not in df.columns:
        return F.lit(False)
    c = F.col(name)
    kind = df.schema[name].dataType
    if isinstance(kind, T.VariantType):
        full = F.when(_is_list(c), F.size(F.try_variant_get(c, "$", "array<variant>")) > 0).otherwise(F.length(_variant_text(c)) > 0)
        return F.coalesce(full, F.lit(False))
    if isinstance(kind, T.ArrayType):
        return F.coalesce(F.size(c) > 0, F.lit(False))
    return F.coalesce(F.length(c) > 0, F.lit(False))


def _is_list(v: Column) -> Column:
    return F.schema_of_variant(v).startswith("ARRAY")


def _variant_text(v: Column) -> Column:
    """Text of a VARIANT: a string itself, JSON null as null, anything else as JSON text."""
    t = F.schema_of_variant(v)
    return F.when(t == "STRING", F.variant_get(v, "$", "string")).when(t != "VOID", F.to_json(v))


def at_least(score: Column, least: float = MIN_SCORE) -> Column:
    """``score >= least`` as Python has it: false for NaN, which Spark orders above all numbers."""
    return (score >= least) & ~F.isnan(score)


def quality_keep(df: DataFrame) -> Column:
    """F3 predicate over a frame that went through ``coalesce_fields``."""
    return (
        ~is_tie(F.col("chosen_value"), F.col("rejected_value"))
        & at_least(F.col("chosen_value"))
        & (F.length("prompt_text") > 0)
        & non_empty(df, "chosen")
        & non_empty(df, "rejected")
    )


def filter_pairs_quality(df: DataFrame) -> DataFrame:
    """not tied, score >= 4.0 (inclusive), prompt / chosen / rejected all non-empty."""
    c = coalesce_fields(df)
    return c.where(quality_keep(c))


def filter_pairs_simple(df: DataFrame) -> DataFrame:
    """``chosen_score`` (null -> 0) >= 4.0 and input, chosen, rejected non-empty; no ties rule."""
    score = F.coalesce(F.col("chosen_score").try_cast("double"), F.lit(0.0)) if "chosen_score" in df.columns else F.lit(0.0)
    return df.where(at_least(score) & non_empty(df, "input") & non_empty(df, "chosen") & non_empty(df, "rejected"))


def normalise_completion(df: DataFrame, name: str) -> Column:
    """Text -> itself; message list -> content of the last assistant message ('' if its
    content is missing), else the last element as JSON text, empty list -> ''."""
    c = F.col(name)
    kind = df.schema[name].dataType
    if isinstance(kind, T.VariantType):
        return _variant_completion(c)
    if not isinstance(kind, T.ArrayType):
        return F.coalesce(c.cast("string"), F.lit(""))
    asst = F.filter(c, lambda m: m["role"] == "assistant")
    return (
        F.when(F.size(asst) > 0, F.coalesce(F.try_element_at(asst, F.lit(-1))["content"], F.lit("")))
        .when(F.size(c) > 0, F.to_json(F.try_element_at(c, F.lit(-1))))
        .otherwise(F.lit(""))
    )


def _variant_completion(c: Column) -> Column:
    """P9 of a VARIANT that holds a text in some rows and a message list in others."""
    turns = F.try_variant_get(c, "$", "array<variant>")
    asst = F.filter(turns, lambda m: F.try_variant_get(m, "$.role", "string") == "assistant")
    said = _variant_text(F.try_variant_get(F.try_element_at(asst, F.lit(-1)), "$.content", "variant"))
    of_list = (
        F.when(F.size(asst) > 0, F.coalesce(said, F.lit("")))
        .when(F.size(turns) > 0, F.to_json(F.try_element_at(turns, F.lit(-1))))
        .otherwise(F.lit(""))
    )
    return F.when(_is_list(c), of_list).otherwise(F.coalesce(_variant_text(c), F.lit("")))


def completion_from_turns(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """P9 long form: (key, turn, role, text) rows -> key, completion; an aggregate, not a list."""
    is_a = F.col("role") == "assistant"
    g = turns.groupBy(key).agg(
        F.count_if(is_a).alias("_na"),
        F.max_by("text", F.when(is_a, F.col("turn"))).alias("_last_a"),
        F.max_by(F.to_json(F.struct(F.col("role"), F.col("text").alias("content"))), "turn").alias("_last"),
        F.count(F.lit(1)).alias("_n"),
    )
    comp = (
        F.when(F.col("_na") > 0, F.coalesce("_last_a", F.lit("")))
        .when(F.col("_n") > 0, F.col("_last"))
        .otherwise(F.lit(""))
    )
    return g.select(key, comp.alias("completion"))


def format_pairs(df: DataFrame) -> DataFrame:
    """P9 + F5: prompt / chosen / rejected as plain non-empty text."""
    c = coalesce_fields(df) if "prompt_text" not in df.columns else df
    out = c.select(
        "pair_id",
        F.col("prompt_text").alias("prompt"),
        normalise_completion(c, "chosen").alias("chosen"),
        normalise_completion(c, "rejected").alias("rejected"),
    )
    return drop_incomplete_pairs(out)


def drop_incomplete_pairs(df: DataFrame) -> DataFrame:
    """drop rows where any of prompt, chosen, rejected is empty."""
    ok = F.lit(True)
    for c in ("prompt", "chosen", "rejected"):
        ok = ok & (F.coalesce(F.length(c), F.lit(0)) > 0)
    return df.where(ok)


def shuffle_key(seed: int, id_col: str = "pair_id", epoch: Column | None = None) -> Column:
    parts = [F.lit(f"{seed}:")]
    if epoch is not None:
        parts += [epoch.cast("string"), F.lit(":")]
    return F.md5(F.concat(*parts, F.col(id_col).cast("string")))


def sample_pairs(df: DataFrame, n: int = 500, seed: int = 42, id_col: str = "pair_id") -> DataFrame:
    """min(n, count) rows without replacement, the first in seeded shuffled order and in that order.

    The rows are found by radix selection of their digests, so ``n`` may be of any size.
    """
    first = least_by_digest(df.withColumn("_key", shuffle_key(seed, id_col)), n, "_key", id_col)
    return first.orderBy("_key", id_col).drop("_key")


def assign_batches(df: DataFrame, batch: int = 2, seed: int = 42, id_col: str = "pair_id") -> DataFrame:
    """Exact global shuffled position, ``batch_id = (position - 1) div batch``."""
    k = df.withColumn("_key", shuffle_key(seed, id_col))
    r = ordinal_within(k, [], ["_key", id_col], "position", levels=hex_levels("_key"))
    return r.withColumn("batch_id", ((F.col("position") - 1) / F.lit(batch)).cast("bigint")).drop("_key")


def collate_batches(batched: DataFrame, cols: Sequence[str], id_col: str = "pair_id") -> DataFrame:
    """One row per batch with its members' columns in shuffled order (batches are bounded)."""
    g = batched.groupBy("batch_id").agg(
        F.array_sort(F.collect_list(F.struct("position", id_col, *cols))).alias("_rows")
    )
    return g.select(
        "batch_id",
        F.size("_rows").cast("bigint").alias("batch_size"),
        *[F.transform("_rows", _field(c)).alias(c) for c in [id_col, *cols]],
    )


def stack_batches(batched: DataFrame, cols: Sequence[str], id_col: str = "pair_id") -> DataFrame:
    """T3 as matrices: one row per batch with each array column of its members stacked in shuffled order.

    ``rows`` and ``columns`` give the shape; a column holds the values row by row.  Members whose
    arrays differ in length cannot be stacked, which raises.
    """
    g = batched.groupBy("batch_id").agg(F.array_sort(F.collect_list(F.struct("position", id_col, *cols))).alias("_rows"))
    size = F.size("_rows")
    widths = F.array_distinct(F.flatten(F.transform("_rows", lambda r: F.array(*[F.size(r[c]) for c in cols]))))
    ragged = F.raise_error(F.concat(F.lit("arrays of different lengths in batch "), F.col("batch_id").cast("string")))
    width = F.when(F.size(widths) == 1, widths[0]).otherwise(ragged.cast("int"))
    shaped = g.select("batch_id", size.alias("rows"), width.alias("columns"), "_rows")
    return shaped.select(
        "batch_id", "rows", "columns", F.transform("_rows", _field(id_col)).alias(id_col),
        *[F.flatten(F.transform("_rows", _field(c))).alias(c) for c in cols],
    )


def _field(name: str):
    return lambda r: r[name]


def repeat_epochs(df: DataFrame, epochs: int, batch: int = 2, seed: int = 42, id_col: str = "pair_id") -> DataFrame:
    """T4: every row once per epoch, re-shuffled per epoch; position and batch inside the epoch."""
    e = df.select("*", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))).alias("epoch"))
    e = e.withColumn("_key", shuffle_key(seed, id_col, F.col("epoch")))
    r = ordinal_within(e, ["epoch"], ["_key", id_col], "position", levels=hex_levels("_key"))
    return r.withColumn("batch_id", ((F.col("position") - 1) / F.lit(batch)).cast("bigint")).drop("_key")


def write_curated(raw: DataFrame, path: str, n: int = 500) -> dict[str, int]:
    """F1-F3, P9 and F5 to a new Parquet folder, and F6's counts, observed by the job that writes.

    ``n_sampled`` is what T1 would take of the formatted rows.
    """
    seen = {stage: Observation(f"curated_{stage}") for stage in ("raw", "filtered", "formatted")}
    count = lambda df, stage: df.observe(seen[stage], F.count(F.lit(1)).alias("n"))
    c = count(coalesce_fields(raw), "raw")
    formatted = count(format_pairs(count(c.where(quality_keep(c)), "filtered")), "formatted")
    formatted.write.parquet(path)
    found = {f"n_{stage}": o.get["n"] for stage, o in seen.items()}
    return found | {"n_sampled": min(n, found["n_formatted"])}


def head_n(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """T5: first n rows by order."""
    return df.orderBy(*order).limit(n)


def training_plan(rows: Column, per_device: int, accumulation: int, steps: Column | None = None,
                  epochs: int | None = None) -> list[Column]:
    """T6 columns from a row count: effective batch, steps, epochs covered (3 dp)."""
    eff = per_device * accumulation
    if steps is None:
        steps = F.ceil(rows / F.lit(eff)) * F.lit(epochs or 1)
    covered = F.rint(steps * F.lit(eff) / rows * F.lit(1000.0)) / F.lit(1000.0)
    return [
        rows.cast("bigint").alias("rows"),
        F.lit(per_device).cast("bigint").alias("per_device_batch"),
        F.lit(accumulation).cast("bigint").alias("grad_accumulation"),
        F.lit(eff).cast("bigint").alias("effective_batch"),
        steps.cast("bigint").alias("steps"),
        covered.alias("epochs_covered"),
    ]
