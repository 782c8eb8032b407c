"""Derived test views over the given tables (the ``x_*`` views).

Each view is a plain DataFrame plan over the parquet tables, so its size grows with them:
``x_cases`` (orders joined to customers rendered as extraction cases), ``x_outputs`` (three
checkpoints' outputs in eight classes), ``x_pairs`` (preference pairs from conversations),
``x_logits`` (logged logits from embeddings) and ``x_losses`` (logged losses from events).
Label fan-out uses ``explode`` over a fixed literal array, not a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from extracteval.operators.scan import ordinal_within
from extracteval.sources.tables import table

# Checkpoint label, salt, and the output class used for every third case.
CHECKPOINTS = (("base_model", 1, 6), ("sft_model", 4, 0), ("dpo_model", 6, 1))
# The two logged models and their logit scale.
LOGIT_MODELS = (("policy", 8), ("reference", 4))


def _s(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def x_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "o_orderstatus"
    )
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    j = o.join(c, o.o_custkey == c.c_custkey)
    key = _s("o_orderkey")
    total = _s(F.col("o_totalprice").cast("decimal(12,2)"))
    urgent = F.when(F.col("o_orderpriority").like("1%"), F.lit("true")).otherwise(F.lit("false"))
    return j.select(
        F.col("o_orderkey").alias("test_id"),
        F.concat(
            F.lit("Order #"), key, F.lit(" by "), F.col("c_name"), F.lit(". Priority: "),
            F.col("o_orderpriority"), F.lit(". Total: $"), total, F.lit("."),
        ).alias("input"),
        F.concat(
            F.lit('{"order_number": "'), key, F.lit('", "customer_name": "'), F.col("c_name"),
            F.lit('", "total": '), total, F.lit(', "urgent": '), urgent,
            F.lit(', "tags": ["'), F.col("c_mktsegment"), F.lit('", "'), F.col("o_orderstatus"),
            F.lit('"], "note": null}'),
        ).alias("expected"),
    )


def _output_of_class(k: Column, expected: Column, test_id: Column) -> Column:
    tid = _s(test_id)
    swapped = F.replace(
        F.replace(F.replace(expected, F.lit('"total": '), F.lit('"total": "')), F.lit(', "urgent"'), F.lit('", "urgent"')),
        F.concat(F.lit('"'), tid, F.lit('", "customer_name"')),
        F.concat(tid, F.lit(', "customer_name"')),
    )
    return (
        F.when(k == 0, expected)
        .when(k == 1, F.concat(F.lit("```json\n"), expected, F.lit("\n```")))
        .when(k == 2, F.concat(expected, F.lit(" Hope this helps.")))
        .when(k == 3, F.replace(expected, F.lit('"customer_name"'), F.lit('"customer"')))
        .when(k == 4, swapped)
        .when(k == 5, F.left(expected, F.lit(30)))
        .when(k == 6, F.lit("No structured data found."))
        .otherwise(F.replace(F.replace(expected, F.lit("Customer#"), F.lit("Mr Customer#")), F.lit('["'), F.lit('["X')))
    )


def x_outputs(spark: SparkSession, sf_dir: str, cases: DataFrame | None = None) -> DataFrame:
    """label, test_id, k, output — three checkpoints per case, laid out by test_id as a stored table would be."""
    cases = cases if cases is not None else x_cases(spark, sf_dir)
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cases = cases.repartition(tasks, "test_id")
    cps = F.array(*[
        F.struct(F.lit(lab).alias("label"), F.lit(salt).alias("salt"), F.lit(pick).alias("pick"))
        for lab, salt, pick in CHECKPOINTS
    ])
    y = cases.select("test_id", "expected", F.explode(cps).alias("cp"))
    k = F.when(F.col("test_id") % 3 == 0, F.col("cp.pick")).otherwise((F.col("test_id") + F.col("cp.salt")) % 8)
    y = y.select(F.col("cp.label").alias("label"), "test_id", "expected", k.cast("int").alias("k"))
    return y.select("label", "test_id", "k", _output_of_class(F.col("k"), F.col("expected"), F.col("test_id")).alias("output"))


def x_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = table(spark, sf_dir, "conversations")
    u = conv.where(F.col("role") == "user").select(
        F.col("conv_id").alias("u_conv"), F.col("turn").alias("u_turn"), F.col("text").alias("u_text")
    )
    a = conv.where(F.col("role") == "assistant").select(
        F.col("conv_id").alias("a_conv"), F.col("turn").alias("a_turn"), F.col("text").alias("a_text")
    )
    first_reply = (
        conv.where(F.col("role") == "assistant")
        .groupBy("conv_id")
        .agg(F.min_by("text", "turn").alias("b_text"))
        .select((F.col("conv_id") - 1).alias("b_prev"), "b_text")
    )
    j = u.join(a, (a.a_conv == u.u_conv) & (a.a_turn == u.u_turn + 1)).join(
        first_reply, F.col("b_prev") == F.col("u_conv"), "left"
    )
    cid = F.col("u_conv")
    return j.select(
        (cid * 100 + F.col("u_turn")).alias("pair_id"),
        F.when(cid % 3 == 0, F.col("u_text")).alias("input"),
        F.when(cid % 3 == 1, F.col("u_text")).alias("question"),
        F.when(cid % 7 == 2, F.lit("")).otherwise(F.col("u_text")).alias("prompt"),
        F.col("a_text").alias("chosen"),
        F.when(cid % 11 == 5, F.lit("")).otherwise(F.col("b_text")).alias("rejected"),
        F.when(cid % 4 == 0, F.lit(None)).otherwise((F.lit(3) + cid % 3).cast("double")).alias("chosen_rating"),
        (F.lit(2) + cid % 4).cast("double").alias("chosen_score"),
        F.when(cid % 5 == 0, F.lit(None)).otherwise((cid % 6).cast("double")).alias("rejected_rating"),
    )


def x_logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pair_id, side, model, pos, token_id, mask, label_id, label_mask, logits ARRAY<DOUBLE>.

    Vectors are numbered without gaps, eight to a sequence; a sequence's last row has no label.
    """
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    models = F.array(*[F.struct(F.lit(m).alias("model"), F.lit(s).alias("scale")) for m, s in LOGIT_MODELS])
    vid = F.col("vec_id")
    seq = F.floor(vid / 8)
    last = table(spark, sf_dir, "embeddings").agg(F.max("vec_id")).scalar()
    labelled = (vid % 8 < 7) & (vid < last)
    mask = lambda pos: F.when(pos < F.lit(3) + seq % 6, F.lit(1)).otherwise(F.lit(0))
    y = e.select("vec_id", "embedding", F.explode(models).alias("m"))
    return y.select(
        F.floor(vid / 16).cast("bigint").alias("pair_id"),
        F.when(seq % 2 == 0, F.lit("chosen")).otherwise(F.lit("rejected")).alias("side"),
        F.col("m.model").alias("model"),
        (vid % 8).cast("int").alias("pos"),
        ((vid * 7) % 64).cast("int").alias("token_id"),
        mask(vid % 8).alias("mask"),
        F.when(labelled, (((vid + 1) * 7) % 64).cast("int")).alias("label_id"),
        F.when(labelled, mask(vid % 8 + 1)).alias("label_mask"),
        F.transform("embedding", lambda x: x.cast("double") * F.col("m.scale")).alias("logits"),
    )


def x_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """run_id, event_id, loss, step (1-based order of event_id inside the run)."""
    ev = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("run_id"), "event_id", F.col("value").alias("loss")
    )
    return ordinal_within(ev, ["run_id"], "event_id", "step")
