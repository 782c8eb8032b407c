"""Checkpoint comparison: improvements, stage deltas, win/tie/loss, length and diversity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from extracteval.functions.pytext import round_half_even
from extracteval.functions.textstats import with_text_stats
from extracteval.operators.score import pairwise_checkpoints

METRICS = ("valid_json_rate", "field_accuracy", "format_compliance", "overall_score")
# The improvement keys of the before/after report, in metric order.
IMPROVEMENT_KEYS = ("valid_json_improvement", "field_accuracy_improvement", "format_improvement", "overall_improvement")
# The three stage comparisons of the three-stage report (after, before, name).
STAGE_PAIRS = (("sft_model", "base_model", "sft_vs_base"), ("dpo_model", "sft_model", "dpo_vs_sft"),
               ("dpo_model", "base_model", "dpo_vs_base"))


def _at(label: str, metric: str) -> Column:
    return F.max(F.when(F.col("label") == label, F.col(metric)))


def improvement(summary: DataFrame, before: str = "base_model", after: str = "finetuned_model") -> DataFrame:
    """After - before for the four metrics, 3 dp (one row)."""
    return summary.agg(
        *[round_half_even(_at(after, m) - _at(before, m), 3).alias(k) for m, k in zip(METRICS, IMPROVEMENT_KEYS)]
    )


def stage_deltas(summary: DataFrame, pairs: Sequence[tuple[str, str, str]] = STAGE_PAIRS) -> DataFrame:
    """Long (delta, metric, value) for each (after, before, name) label pair."""
    wide = summary.agg(*[_at(l, m).alias(f"{l}__{m}") for l in {x for p in pairs for x in p[:2]} for m in METRICS])
    rows = [
        F.struct(
            F.lit(name).alias("delta"),
            F.lit(m).alias("metric"),
            round_half_even(F.col(f"{a}__{m}") - F.col(f"{b}__{m}"), 3).alias("value"),
        )
        for a, b, name in pairs
        for m in METRICS
    ]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def output_quality(outputs: DataFrame, n: int = 2) -> DataFrame:
    """Per label mean length (1 dp), mean of rounded diversities (3 dp), min and max length."""
    t = with_text_stats(outputs.select("label", "output"), "output", n).select("label", "len", F.col("diversity").alias("div"))
    exact = F.sum(F.col("div").cast("decimal(4,3)")).cast("double") / F.count(F.lit(1)).cast("double")
    return t.groupBy("label").agg(
        round_half_even(F.avg("len"), 1).alias("avg_length_tokens"),
        round_half_even(exact, 3).alias("avg_diversity_2g"),
        F.min("len").cast("bigint").alias("min_length"),
        F.max("len").cast("bigint").alias("max_length"),
    )


def win_tie_loss(scored: DataFrame, base: str = "sft_model", cand: str = "dpo_model", margin: float = 0.05) -> DataFrame:
    """Per test win / tie / loss of ``cand`` against ``base`` on field accuracy (strict)."""
    p = pairwise_checkpoints(scored, [base, cand]).where(F.col(base).isNotNull() & F.col(cand).isNotNull())
    b, c = F.col(base), F.col(cand)
    result = (
        F.when(c > b + F.lit(margin), F.lit("win")).when(c < b - F.lit(margin), F.lit("loss")).otherwise(F.lit("tie"))
    )
    return p.select("test_id", b.alias("sft_acc"), c.alias("dpo_acc"), result.alias("result"))


def win_rate(per_case: DataFrame) -> DataFrame:
    """Wins, ties, losses, total and win rate (ties count in the denominator), 3 dp."""
    r = F.col("result")
    t = per_case.agg(
        F.count_if(r == "win").alias("wins"),
        F.count_if(r == "tie").alias("ties"),
        F.count_if(r == "loss").alias("losses"),
        F.count(F.lit(1)).alias("total"),
    )
    rate = F.when(F.col("total") > 0, F.col("wins").cast("double") / F.col("total").cast("double"))
    return t.withColumn("win_rate", round_half_even(rate, 3))


def quality_pivot(quality: DataFrame, base: str = "sft_model", cand: str = "dpo_model") -> DataFrame:
    """A9 rows of two labels as one row (conditional aggregation, no join)."""
    cols = ["avg_length_tokens", "avg_diversity_2g", "min_length", "max_length"]
    out = []
    for lab, tag in ((base, "sft"), (cand, "dpo")):
        out += [F.max(F.when(F.col("label") == lab, F.col(c))).alias(f"{tag}_{c}") for c in cols]
    return quality.agg(*out)


def length_direction(quality: DataFrame, base: str = "sft_model", cand: str = "dpo_model") -> DataFrame:
    """Q3: 'shorter' when the candidate's mean length is below the base's, else 'longer'."""
    q = quality_pivot(quality, base, cand)
    d = F.when(F.col("dpo_avg_length_tokens") < F.col("sft_avg_length_tokens"), F.lit("shorter")).otherwise(
        F.lit("longer")
    )
    return q.select("sft_avg_length_tokens", "dpo_avg_length_tokens", d.alias("direction"))


def win_report_summary(per_case: DataFrame, quality: DataFrame, base: str = "sft_model", cand: str = "dpo_model") -> DataFrame:
    """The five headline values; the win rate arrives as a scalar subquery, not a join."""
    rate = win_rate(per_case).select("win_rate").scalar()
    q = quality_pivot(quality, base, cand)
    return q.select(
        rate.alias("dpo_win_rate"),
        F.col("dpo_avg_length_tokens").alias("dpo_avg_length"),
        F.col("sft_avg_length_tokens").alias("sft_avg_length"),
        F.col("dpo_avg_diversity_2g").alias("dpo_diversity"),
        F.col("sft_avg_diversity_2g").alias("sft_diversity"),
    )
