"""Scoring checkpoint outputs against expected objects.

One ``select`` computes every per-output metric; ``groupBy(label)`` turns them into summaries
with partial (map-side) aggregation, so a label holding most rows costs one partial row per
task.  Means of already-rounded values are summed as whole units of their last digit, so the result
does not depend on partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from extracteval.functions import jsonx, scoring
from extracteval.functions.pytext import py_strip, round_half_even


def union_checkpoints(frames: dict[str, DataFrame]) -> DataFrame:
    """Per-checkpoint output frames (test_id, output) -> one frame with a ``label`` column."""
    parts = [df.select(F.lit(label).alias("label"), "test_id", "output") for label, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def align_outputs_cases(outputs: DataFrame, cases: DataFrame) -> DataFrame:
    """Pair each output with its case by id (inner equi-join; AQE picks the strategy)."""
    return outputs.join(cases.select("test_id", "input", "expected"), "test_id")


def alignment_mismatch(outputs: DataFrame, cases: DataFrame, labels: Sequence[str] | None = None, fail: bool = False) -> DataFrame:
    """(label, test_id, problem): ``no_output`` for a case without an output under a label,
    ``no_case`` for an output without a case, ``duplicate`` for a label's further outputs of a case.

    ``labels`` are the checkpoints to expect (a silent one is then reported for every case); by
    default those that are present.  ``fail=True`` raises on the first problem row that is read.
    """
    if labels is None:
        expected = outputs.select(F.array_sort(F.collect_set("label"))).scalar()
    else:
        expected = F.array(*[F.lit(l) for l in labels]).cast("array<string>")
    counted = outputs.groupBy("test_id", "label").agg(F.count(F.lit(1)).alias("n"))
    present = counted.groupBy("test_id").agg(
        F.collect_set("label").alias("labels"), F.collect_set(F.when(F.col("n") > 1, F.col("label"))).alias("twice")
    )
    have = cases.select("test_id", F.lit(True).alias("has_case")).distinct()
    j = have.join(present, "test_id", "full_outer")
    none = F.array().cast("array<string>")

    def problems(found: Column, name: str) -> Column:
        return F.transform(F.coalesce(found, none), lambda l: F.struct(l.alias("label"), F.lit(name).alias("problem")))

    case = F.col("has_case").isNotNull()
    j = j.select(
        "test_id", "twice",
        F.when(case, F.array_except(expected, F.coalesce("labels", none))).alias("missing"),
        F.when(~case, F.col("labels")).alias("orphan"),
    )
    probs = F.concat(
        problems(F.col("missing"), "no_output"), problems(F.col("orphan"), "no_case"), problems(F.col("twice"), "duplicate")
    )
    rows = j.select("test_id", F.explode(probs).alias("p")).select("p.label", "test_id", "p.problem")
    if fail:
        text = F.concat_ws(" ", F.lit("misaligned outputs:"), "label", F.col("test_id").cast("string"), "problem")
        rows = rows.withColumn("problem", F.when(F.lit(True), F.raise_error(text)))
    return rows


def _with_parsed(df: DataFrame) -> DataFrame:
    """Adds ``_valid`` and ``_value`` of the output, ``_same`` (its object is the expected text as it stands, so neither
    is parsed nor compared again) and ``_full`` (and every key of it earns full credit)."""
    t = df.withColumn("_clean", jsonx.strip_fences("output"))
    t = jsonx.with_parse(t, "_clean", "_valid", "_value", "_slice")
    t = t.withColumn("_same", F.coalesce(F.col("_value").isNotNull() & (F.col("_slice") == F.col("expected")), F.lit(False)))
    return t.withColumn("_full", F.when(F.col("_same"), scoring.earns_all("expected")).otherwise(F.lit(False)))


def _expected_value() -> Column:
    return F.when(F.col("_same"), F.col("_value")).otherwise(F.try_parse_json(jsonx.numbers_for_names(F.col("expected"))))


def score_outputs(aligned: DataFrame) -> DataFrame:
    """A1: label, test_id, input_preview, valid_json, field_accuracy, format_compliance, output_preview."""
    t = _with_parsed(aligned).withColumn("_pm", F.when(~F.col("_full"), jsonx.as_object_map("_value")))
    # the expected object is read only where it is compared or may hold an empty list
    open_list = jsonx.holds_empty_list(F.col("expected"))
    t = t.withColumn("_em", F.when((F.size("_pm") > 0) | open_list, jsonx.as_object_map(_expected_value())))
    full = F.when(jsonx.is_empty_object(F.col("expected")), F.lit(0.0)).otherwise(F.lit(1.0))
    return t.select(
        "label",
        "test_id",
        F.concat(F.left("input", F.lit(60)), F.lit("...")).alias("input_preview"),
        F.col("_valid").alias("valid_json"),
        F.when(F.col("_full"), full).otherwise(scoring.field_accuracy("_em", "_pm")).alias("field_accuracy"),
        scoring.format_compliance("output").alias("format_compliance"),
        py_strip(F.left("output", F.lit(100))).alias("output_preview"),
        F.when(open_list, scoring.empty_list_flag("_em")).otherwise(F.lit(False)).alias("empty_expected_list"),
    )


def _pairs_long(aligned: DataFrame) -> DataFrame:
    """One row per expected key: its value ``e`` and the predicted ``p`` with their types ``et`` and ``pt``, and ``_full``."""
    t = _with_parsed(aligned).withColumn("_em", jsonx.as_object_map(_expected_value()))
    t = t.withColumn("_pm", F.when(~F.col("_same"), jsonx.as_object_map("_value")))
    e = t.select("label", "test_id", "_same", "_full", F.explode(scoring.value_pairs("_em", "_pm")).alias("key", "s"))
    e = e.where(F.col("s.e").isNotNull())
    same, full = F.col("_same"), F.col("_full")
    e = e.select("label", "test_id", "_full", "key", F.col("s.e").alias("e"), F.when(same, F.col("s.e")).otherwise(F.col("s.p")).alias("p"))
    # types are read outside the lambda, where they are compiled
    e = e.withColumn("et", F.schema_of_variant("e"))
    return e.withColumn("pt", F.when(full, F.col("et")).otherwise(F.schema_of_variant("p")))


def _pair() -> dict[str, Column]:
    return {c: F.col(c) for c in ("e", "et", "p", "pt")}


def field_breakdown(aligned: DataFrame) -> DataFrame:
    """J4 + R9 long form: one row per expected key with the predicted value and its credit."""
    e = _pairs_long(aligned)
    s = _pair()
    present = s["p"].isNotNull()
    return e.select(
        "label",
        "test_id",
        "key",
        scoring.rule_from(s["et"]).alias("rule"),
        scoring.py_text(s["e"], s["et"]).alias("expected_value"),
        F.when(present, scoring.py_text(s["p"], s["pt"])).alias("predicted_value"),
        present.alias("present"),
        F.when(F.col("_full"), F.lit(1.0)).otherwise(scoring.pair_credit(s)).alias("credit"),
    )


def list_overlap(aligned: DataFrame) -> DataFrame:
    """Per list-valued expected key, distinct expected / predicted texts and their overlap."""
    e = _pairs_long(aligned).where(F.col("et").startswith("ARRAY"))
    s = _pair()
    es = scoring.text_set(s["e"])
    ps = F.when(s["pt"].startswith("ARRAY"), scoring.text_set(s["p"]))
    return e.select(
        "label",
        "test_id",
        "key",
        F.size(es).cast("bigint").alias("n_expected"),
        F.coalesce(F.size(ps), F.lit(0)).cast("bigint").alias("n_predicted"),
        F.coalesce(F.size(F.array_intersect(es, ps)), F.lit(0)).cast("bigint").alias("n_overlap"),
    )


def _mean_of_rounded(c: str, scale: int = 3) -> Column:
    # whole thousandths add up exactly in any order
    units = F.sum(F.rint(F.col(c) * F.lit(10.0**scale)).cast("bigint"))
    return round_half_even(units.cast("double") / F.lit(10.0**scale) / F.count(F.lit(1)).cast("double"), 3)


def evaluate_outputs(scored: DataFrame) -> DataFrame:
    """A2-A5: label, num_tests, valid_json_rate, field_accuracy, format_compliance, overall_score."""
    s = scored.groupBy("label").agg(
        F.count(F.lit(1)).alias("num_tests"),
        round_half_even(F.avg(F.col("valid_json").cast("int")), 3).alias("valid_json_rate"),
        _mean_of_rounded("field_accuracy").alias("field_accuracy"),
        _mean_of_rounded("format_compliance").alias("format_compliance"),
    )
    overall = (F.col("valid_json_rate") + F.col("field_accuracy") + F.col("format_compliance")) / F.lit(3.0)
    return s.withColumn("overall_score", round_half_even(overall, 3))


def evaluate_checkpoints(outputs: DataFrame, cases: DataFrame) -> DataFrame:
    """J1 -> A1 -> A5 in one job (many labels in one pass)."""
    return evaluate_outputs(score_outputs(align_outputs_cases(outputs, cases)))


def pairwise_checkpoints(scored: DataFrame, labels: Sequence[str], value: str = "field_accuracy") -> DataFrame:
    """One row per test with the value under each label (one shuffle on test_id)."""
    return scored.where(F.col("label").isin(*labels)).groupBy("test_id").pivot("label", list(labels)).agg(F.max(value))
