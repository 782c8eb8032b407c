"""Operator semantics on small frames: preference filters, normaliser, numerics, batching."""

import math

from pyspark.sql import functions as F

from extracteval.operators import curate, prefnum
from extracteval.operators.scan import ordinal_within

PAIR_SCHEMA = ("pair_id long, input string, question string, chosen string, rejected string, chosen_rating double, "
               "chosen_score double, rejected_rating double, rejected_score double")

# (row, F3 keep, F4 keep) from the filter table of FIXTURES 4.5
FILTER_ROWS = [
    ((1, "p", None, "c", "r", 4.0, None, 4.0, None), False, False),
    ((2, "p", None, "c", "r", 4.0, None, 0.0, None), True, False),
    ((3, "p", None, "c", "r", None, 5.0, None, None), True, True),
    ((4, "p", None, "c", "r", 0.0, 5.0, None, None), False, True),
    ((5, "p", None, "c", "r", None, 3.99, None, None), False, False),
    ((6, "p", None, "c", "r", None, 5.0, None, 5.0), False, True),
    ((7, "", "q", "c", "r", None, 5.0, None, None), False, False),
    ((8, None, "q", "c", "r", None, 5.0, None, None), True, False),
]


def test_filters(spark):
    df = spark.createDataFrame([r for r, _, _ in FILTER_ROWS], PAIR_SCHEMA)
    q = {r.pair_id for r in curate.filter_pairs_quality(df).collect()}
    s = {r.pair_id for r in curate.filter_pairs_simple(df).collect()}
    assert q == {r[0] for r, k, _ in FILTER_ROWS if k}
    assert s == {r[0] for r, _, k in FILTER_ROWS if k}


def test_normalise_completion(spark):
    msgs = "array<struct<role:string,content:string>>"
    df = spark.createDataFrame(
        [(1, [("user", "u"), ("assistant", "a1"), ("user", "u2"), ("assistant", "a2")]),
         (2, [("assistant", "a"), ("user", "u")]), (3, [("user", "u")]), (4, []), (5, [("assistant", None)])],
        f"id int, chosen {msgs}",
    )
    got = dict(df.select("id", curate.normalise_completion(df, "chosen").alias("c")).collect())
    assert got[1] == "a2" and got[2] == "a" and got[4] == "" and got[5] == ""
    assert '"u"' in got[3] and "user" in got[3]


def test_dpo_loss_values(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0), (2, 8000.0, 0.0), (3, -8000.0, 0.0)], "pair_id long, pi_logratio double, ref_logratio double")
    got = {r.pair_id: r.loss for r in prefnum.dpo_loss(df).collect()}
    assert abs(got[1] - math.log(2)) < 1e-12 and got[2] == 0.0 and abs(got[3] - 800.0) < 1e-9


def test_sequence_logprob_skips_first_position(spark):
    lg = [0.0, 0.0]
    df = spark.createDataFrame(
        [(1, "chosen", "policy", 0, 0, 1, lg), (1, "chosen", "policy", 1, 1, 1, lg), (1, "chosen", "policy", 2, 0, 0, lg)],
        "pair_id long, side string, model string, pos int, token_id int, mask int, logits array<double>",
    )
    r = prefnum.sequence_logprob(prefnum.token_logprobs(df)).first()
    assert abs(r.logprob - math.log(0.5)) < 1e-12


def test_mean_of_batch_means(spark):
    # pair ids chosen so that the seeded order puts {a, b} in one batch and c alone
    df = spark.createDataFrame([(i, float(i)) for i in range(1, 4)], "pair_id long, loss double")
    b = curate.assign_batches(df, 2).collect()
    by_batch = {}
    for r in b:
        by_batch.setdefault(r.batch_id, []).append(r.pair_id)
    want = sum(sum(v) / len(v) for v in by_batch.values()) / len(by_batch)
    got = prefnum.mean_of_batch_means(df).first().final_loss
    assert got == round(want, 4)


def test_ordinal_within_matches_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") % 3).alias("k"), (F.col("id") * 7919 % 100003).alias("o"), F.lit(1.5).alias("v"))
    r = ordinal_within(df, ["k"], "o", "pos", levels=[F.floor(F.col("o") / 97)], running=["v"])
    from pyspark.sql import Window
    ref = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("o")))
    j = r.join(ref, ["k", "o"])
    assert j.where((F.col("pos") != F.col("rn")) | (F.col("v_cum") != F.col("rn") * 1.5)).count() == 0


def test_sample_is_partition_independent(spark):
    df = spark.range(0, 300).withColumnRenamed("id", "pair_id")
    a = [r.pair_id for r in curate.sample_pairs(df.repartition(7), 20).collect()]
    b = [r.pair_id for r in curate.sample_pairs(df.coalesce(1), 20).collect()]
    assert a == b and len(set(a)) == 20


def test_ordinals_with_sparse_duplicate_and_null_values(spark):
    from extracteval.operators.scan import ordinal_within

    ids = [None, 5, 5, 5, 1 << 60, -(1 << 50), 7, 1 << 20, (1 << 20) + 1, None]
    rows = [(k, i, 1.0) for k in ("a", None) for i in ids]
    df = spark.createDataFrame(rows, "k string, o bigint, v double")
    got = ordinal_within(df, ["k"], "o", "pos", running=["v"]).collect()
    assert len(got) == len(rows)
    for key in ("a", None):
        mine = sorted((r.pos, r.o, r.v_cum) for r in got if r.k == key)
        assert [p for p, _, _ in mine] == list(range(1, len(ids) + 1)) == [int(c) for _, _, c in mine]
        assert [o for _, o, _ in mine] == sorted(ids, key=lambda x: (x is not None, x or 0))
    assert ordinal_within(df, [], "o", "pos").count() == len(rows)


def test_round_is_python_round(spark):
    from extracteval.functions.pytext import round_half_even

    xs = [0.0005, 0.0025, 0.1235, 0.0625, 2.675, 1.0005, -0.0025, 0.8055, 1e-9, 123456.7895, 0.5, -0.5]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    assert [r[0] for r in df.select(round_half_even("x", 3)).collect()] == [round(x, 3) for x in xs]


def test_nan_scores_are_not_kept(spark):
    from extracteval.operators.curate import filter_pairs_quality, filter_pairs_simple

    nan = float("nan")
    df = spark.createDataFrame([(1, "p", "a", "b", nan), (2, "p", "a", "b", 4.0)], "pair_id int, input string, chosen string, rejected string, chosen_score double")
    assert [r.pair_id for r in filter_pairs_quality(df).collect()] == [2] == [r.pair_id for r in filter_pairs_simple(df).collect()]


def test_alignment_reports_missing_duplicate_and_silent(spark):
    import pytest
    from extracteval.operators.score import alignment_mismatch

    cases = spark.createDataFrame([(1,), (2,)], "test_id bigint")
    outs = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y"), ("a", 3, "z")], "label string, test_id bigint, output string")
    got = {tuple(r) for r in alignment_mismatch(outs, cases, ["a", "b"]).collect()}
    assert got == {("a", 1, "duplicate"), ("a", 2, "no_output"), ("a", 3, "no_case"), ("b", 1, "no_output"), ("b", 2, "no_output")}
    with pytest.raises(Exception, match="misaligned"):
        alignment_mismatch(outs, cases, ["a", "b"], fail=True).collect()


def test_running_loss_survives_nan_and_keeps_small_losses(spark):
    import math
    from extracteval.operators.prefnum import running_loss_log

    df = spark.createDataFrame([("r", s, 4e-4) for s in range(1, 41)] + [("d", s, float("nan") if s == 3 else 1.0) for s in range(1, 41)], "run_id string, step bigint, loss double")
    got = {(r.run_id, r.step): r.running_loss for r in running_loss_log(df).collect()}
    assert got["r", 20] == got["r", 40] == 0.0004 and math.isnan(got["d", 20])


def test_running_loss_counts_diverged_losses(spark):
    from extracteval.operators.prefnum import running_loss_log

    df = spark.createDataFrame([("r", s, 2e12 if s == 3 else 1.0) for s in range(1, 21)], "run_id string, step bigint, loss double")
    assert abs(running_loss_log(df).first().running_loss - (2e12 + 19) / 20) < 0.01
