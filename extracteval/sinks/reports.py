"""Reports (K1-K7) as one-row DataFrames of nested structs, plus their writers.

Every report is built from bounded inputs (per-checkpoint summaries, win counts) so a report row
is small whatever the data size.  Per-test, per-case and prompt rows are tables of their own beside
the report (``publish``) instead of giant lists inside it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from extracteval.functions.pytext import fixed, percent, round_half_even, signed_percent
from extracteval.operators.compare import IMPROVEMENT_KEYS, METRICS, STAGE_PAIRS, quality_pivot, win_rate

SUMMARY_FIELDS = ("label", "num_tests", *METRICS)
STAGES = ("base_model", "sft_model", "dpo_model")


def _nest(row: DataFrame, groups: dict[str, Sequence[str]]) -> DataFrame:
    return row.select(*[F.struct(*[F.col(f"{g}__{c}").alias(c) for c in cols]).alias(g) for g, cols in groups.items()])


def flatten(df: DataFrame, sep: str = "__") -> DataFrame:
    """Nested struct columns -> flat ``a__b`` columns (for display and cross-engine checks)."""

    def walk(dtype, path):
        if isinstance(dtype, T.StructType):
            out = []
            for f in dtype.fields:
                out += walk(f.dataType, path + [f.name])
            return out
        return [F.col(".".join(f"`{p}`" for p in path)).alias(sep.join(path))]

    return df.select(*[c for f in df.schema.fields for c in walk(f.dataType, [f.name])])


def _wide_summaries(summary: DataFrame, labels: dict[str, str]) -> list[Column]:
    cols = []
    for key, label in labels.items():
        cols += [F.max(F.when(F.col("label") == label, F.col(c))).alias(f"{key}__{c}") for c in SUMMARY_FIELDS]
    return cols


def report_before_after(summary: DataFrame, before: str, after: str) -> DataFrame:
    """K1: {before, after, improvement} (test prompts live in their own table, P8)."""
    row = summary.agg(*_wide_summaries(summary, {"before": before, "after": after}))
    imp = [
        round_half_even(F.col(f"after__{m}") - F.col(f"before__{m}"), 3).alias(f"improvement__{k}")
        for m, k in zip(METRICS, IMPROVEMENT_KEYS)
    ]
    row = row.select("*", *imp)
    return _nest(row, {"before": SUMMARY_FIELDS, "after": SUMMARY_FIELDS, "improvement": IMPROVEMENT_KEYS})


def _deltas(row_prefixes: Sequence[tuple[str, str, str]]) -> list[Column]:
    return [
        round_half_even(F.col(f"{a}__{m}") - F.col(f"{b}__{m}"), 3).alias(f"{name}__{m}")
        for a, b, name in row_prefixes
        for m in METRICS
    ]


def report_three_stage(summary: DataFrame, training: dict, hardware: dict) -> DataFrame:
    """K2: three summaries, three delta records, the training log and hardware (pass-through)."""
    labels = {stage: stage for stage in STAGES}
    row = summary.agg(*_wide_summaries(summary, labels))
    row = row.select("*", *_deltas(STAGE_PAIRS))
    extra = [F.lit(v).alias(f"training_config__{k}") for k, v in training.items()]
    extra += [F.lit(v).alias(f"hardware__{k}") for k, v in hardware.items()]
    row = row.select("*", *extra)
    groups = {k: SUMMARY_FIELDS for k in labels}
    groups.update({name: METRICS for _, _, name in STAGE_PAIRS})
    groups["training_config"] = list(training)
    groups["hardware"] = list(hardware)
    return _nest(row, groups)


def report_dpo_change(summary: DataFrame, training: dict) -> DataFrame:
    """K3: {before_dpo, after_dpo, improvement (dpo - sft), training_config}."""
    row = summary.agg(*_wide_summaries(summary, {"before_dpo": "sft_model", "after_dpo": "dpo_model"}))
    row = row.select("*", *_deltas([("after_dpo", "before_dpo", "improvement")]))
    row = row.select("*", *[F.lit(v).alias(f"training_config__{k}") for k, v in training.items()])
    return _nest(row, {"before_dpo": SUMMARY_FIELDS, "after_dpo": SUMMARY_FIELDS, "improvement": METRICS,
                       "training_config": list(training)})


def report_dpo_run(final: DataFrame, config: dict, train_time_s: float, model: str, hardware: str) -> DataFrame:
    """K4: {training_config, final_loss (4 dp), train_time_s (1 dp), model, hardware}; the pairs of
    the training record are the losses that ``final`` (L5) counted."""
    cfg = F.struct(F.col("pairs"), *[F.lit(v).alias(k) for k, v in config.items()])
    return final.select(
        cfg.alias("training_config"),
        round_half_even(F.col("final_loss"), 4).alias("final_loss"),
        round_half_even(F.lit(float(train_time_s)), 1).alias("train_time_s"),
        F.lit(model).alias("model"),
        F.lit(hardware).alias("hardware"),
    )


def report_preference(per_case: DataFrame, quality: DataFrame) -> DataFrame:
    """K5: win statistics, length / diversity of both checkpoints and the five-value summary."""
    stats = ("win_rate", "wins", "ties", "losses")
    wins = win_rate(per_case).select(F.struct(*stats)).scalar()
    q = quality_pivot(quality).withColumn("wins", wins)  # one subquery over the scored set
    cols = ("avg_length_tokens", "avg_diversity_2g", "min_length", "max_length")
    side = lambda tag, lab: F.struct(F.lit(lab).alias("label"), *[F.col(f"{tag}_{c}").alias(c) for c in cols])
    summary = F.struct(
        F.col("wins.win_rate").alias("dpo_win_rate"),
        F.col("dpo_avg_length_tokens").alias("dpo_avg_length"),
        F.col("sft_avg_length_tokens").alias("sft_avg_length"),
        F.col("dpo_avg_diversity_2g").alias("dpo_diversity"),
        F.col("sft_avg_diversity_2g").alias("sft_diversity"),
    )
    return q.select(
        F.col("wins").alias("win_rate_vs_sft"),
        F.struct(side("sft", "sft_model").alias("sft"), side("dpo", "dpo_model").alias("dpo")).alias("output_quality"),
        summary.alias("summary"),
    )


# Header of the README table, and row titles of the console summary and the README table, in order.
MARKDOWN_HEADER = "| Metric | Base Model | Fine-Tuned (LoRA) | Improvement |"
SUMMARY_ROWS = (("valid_json_rate", "Valid JSON Rate"), ("field_accuracy", "Field Accuracy"),
                ("format_compliance", "Format Compliance"), ("overall_score", "Overall Score"))


def summary_table(summary: DataFrame) -> DataFrame:
    """K6: one row per metric: base, sft (delta), dpo, dpo-vs-sft delta, total delta (as text)."""
    wide = summary.agg(*_wide_summaries(summary, {"base": "base_model", "sft": "sft_model", "dpo": "dpo_model"}))
    rows = []
    for order, (m, title) in enumerate(SUMMARY_ROWS):
        b, s, d = F.col(f"base__{m}"), F.col(f"sft__{m}"), F.col(f"dpo__{m}")
        d1 = round_half_even(s - b, 3)
        d2 = round_half_even(d - s, 3)
        d3 = round_half_even(d - b, 3)
        show = (lambda c: fixed(c, 3)) if m == "overall_score" else percent
        rows.append(F.struct(
            F.lit(order).alias("row_no"), F.lit(title).alias("metric"), show(b).alias("base"),
            F.concat(show(s), F.lit(" ("), signed_percent(d1), F.lit(")")).alias("sft"),
            show(d).alias("dpo"), signed_percent(d2).alias("dpo_vs_sft"), signed_percent(d3).alias("total"),
        ))
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def markdown_table(summary: DataFrame, before: str = "base_model", after: str = "sft_model") -> DataFrame:
    """K7: the README table (always a '+' before the improvement, as the reference prints)."""
    wide = summary.agg(*_wide_summaries(summary, {"b": before, "a": after}))
    lines = [F.struct(F.lit(0).alias("line_no"), F.lit(MARKDOWN_HEADER).alias("line")),
             F.struct(F.lit(1).alias("line_no"), F.lit("|---|---|---|---|").alias("line"))]
    for i, (m, title) in enumerate(SUMMARY_ROWS):
        b, a = F.col(f"b__{m}"), F.col(f"a__{m}")
        imp = round_half_even(a - b, 3)
        if m == "overall_score":
            text = F.concat(F.lit(f"| **{title}** | **"), fixed(b, 3), F.lit("** | **"), fixed(a, 3),
                            F.lit("** | **+"), fixed(imp, 3), F.lit("** |"))
        else:
            text = F.concat(F.lit(f"| {title} | "), percent(b, 0), F.lit(" | "), percent(a, 0), F.lit(" | +"),
                            percent(imp, 0), F.lit(" |"))
        lines.append(F.struct(F.lit(i + 2).alias("line_no"), text.alias("line")))
    return wide.select(F.explode(F.array(*lines)).alias("r")).select("r.*")


def write_lines(lines: DataFrame, path: str) -> None:
    """K7 sink: the table as a text file in line order (a handful of rows)."""
    lines.orderBy("line_no").select("line").coalesce(1).write.mode("overwrite").text(path)
