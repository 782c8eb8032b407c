"""Preference numerics over logged logits and losses.

Logits arrive long: one row per (pair_id, side, model, pos) with the logits that predict the next
token, and that token as the row's ``label_id`` with its ``label_mask``, as a trainer holds both.
Log-softmax is then worked out where a row is read and no logits array is ever shuffled; all later
steps are keyed aggregations of one number a row.  A log without labels gets them from its own tokens.  The loss uses the overflow-free form
``log1p(exp(-|z|)) - min(z, 0)`` of ``-log(sigmoid(z))``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from extracteval.functions.pytext import round_half_even
from extracteval.operators.curate import assign_batches
from extracteval.operators.scan import ordinal_within

SEQ = ["pair_id", "side", "model"]
BETA = 0.1


def with_labels(tokens: DataFrame) -> DataFrame:
    """(pair_id, side, model, pos, label_id, label_mask): each position with the next one's token.

    For logs that name only their own token: a window over a sequence, which is bounded by its length, on
    narrow token rows.
    """
    w = Window.partitionBy(*SEQ).orderBy("pos")
    shifted = tokens.select(*SEQ, "pos", F.lead("token_id").over(w).alias("label_id"), F.lead("mask").over(w).alias("label_mask"))
    return shifted.where("label_id IS NOT NULL")


def token_logprobs(logits: DataFrame) -> DataFrame:
    """L1: log-softmax of each row's logits at its label; ``pos`` and ``mask`` are the label's (pos >= 1).

    Rows without a label (a sequence's last) predict nothing and are left out.  A log that names only its own
    tokens (``token_id``, ``mask``) is joined with the shifted ones first, which moves its logits unless
    it is bucketed by the sequence and position.
    """
    if "label_id" not in logits.columns:
        narrow = with_labels(logits.select(*SEQ, "pos", "token_id", "mask"))
        logits = logits.join(narrow, [*SEQ, "pos"])
    t = logits.where("label_id IS NOT NULL").withColumn("_m", F.array_max("logits"))
    lse = F.col("_m") + F.log(F.aggregate("logits", F.lit(0.0), lambda acc, x: acc + F.exp(x - F.col("_m"))))
    lp = F.try_element_at("logits", F.col("label_id") + 1) - lse
    return t.select(*SEQ, (F.col("pos") + 1).alias("pos"), F.col("label_mask").alias("mask"), lp.alias("token_logprob"))


def sequence_logprob(tok: DataFrame) -> DataFrame:
    """L2: sum of token log-probs x mask per sequence (prompt tokens included)."""
    return tok.groupBy(*SEQ).agg(F.sum(F.col("token_logprob") * F.col("mask")).alias("logprob"))


def logratios(tok: DataFrame) -> DataFrame:
    """L3: per pair, policy and reference chosen-minus-rejected (one aggregation on pair_id)."""
    s = F.col("token_logprob") * F.col("mask")

    def part(side: str, model: str):
        return F.sum(F.when((F.col("side") == side) & (F.col("model") == model), s))

    def has(side: str, model: str):
        return F.count_if((F.col("side") == side) & (F.col("model") == model))

    g = tok.groupBy("pair_id").agg(
        part("chosen", "policy").alias("_pc"), part("rejected", "policy").alias("_pr"),
        part("chosen", "reference").alias("_rc"), part("rejected", "reference").alias("_rr"),
        F.least(has("chosen", "policy"), has("rejected", "policy"), has("chosen", "reference"),
                has("rejected", "reference")).alias("_k"),
    )
    return g.where(F.col("_k") > 0).select(
        "pair_id",
        (F.col("_pc") - F.col("_pr")).alias("pi_logratio"),
        (F.col("_rc") - F.col("_rr")).alias("ref_logratio"),
    )


def dpo_loss(ratios: DataFrame, beta: float = BETA) -> DataFrame:
    """L4: -log sigmoid(beta * (pi - ref)) per pair."""
    z = F.lit(beta) * (F.col("pi_logratio") - F.col("ref_logratio"))
    loss = F.log1p(F.exp(-F.abs(z))) - F.least(z, F.lit(0.0))
    return ratios.select("pair_id", z.alias("z"), loss.alias("loss"))


def mean_of_batch_means(losses: DataFrame, batch: int = 2, seed: int = 42) -> DataFrame:
    """Average over steps of per-batch mean loss (a short last batch weighs the same), 4 dp;
    ``pairs`` counts the losses."""
    b = assign_batches(losses.select("pair_id", "loss"), batch, seed)
    per = b.groupBy("batch_id").agg(F.avg("loss").alias("m"), F.count(F.lit(1)).alias("n"))
    return per.agg(
        F.count(F.lit(1)).alias("steps"), round_half_even(F.avg("m"), 4).alias("final_loss"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("pairs"),
    )


def running_loss_log(losses: DataFrame, every: int = 20, run: str = "run_id", step: str = "step") -> DataFrame:
    """V1: running mean loss to date per run, reported every ``every`` steps (4 dp)."""
    loss = F.col("loss").cast("double")
    fits = loss.isNotNull() & ~F.isnan(loss) & (F.abs(loss) < 1e12)
    parts = losses.select(
        run, step,
        # exact sums do not depend on the order of addition; 18 decimals keep any loss worth logging,
        # losses of 1e12 or more are added as doubles beside NaN and infinities
        F.when(fits, loss.try_cast("decimal(30,18)")).otherwise(F.lit(0).cast("decimal(30,18)")).alias("_u"),
        F.when(fits, F.lit(0.0)).otherwise(loss).alias("_odd"),
    )
    r = ordinal_within(parts, [run], step, "_n", running=["_u", "_odd"])
    mean = round_half_even((F.col("_u_cum").cast("double") + F.col("_odd_cum")) / F.col("_n"), 4)
    return r.where(F.col(step) % every == 0).select(run, step, mean.alias("running_loss"))


def enumerate_rows(df: DataFrame, order: str = "test_id", out: str = "position") -> DataFrame:
    """V2: 1-based position by a carried key (never monotonically_increasing_id)."""
    return ordinal_within(df, [], order, out)
