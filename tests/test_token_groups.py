"""Rows that share a key are looked up together: the same tokens, without their texts in an exchange."""

import os
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from extracteval.operators import encode
from extracteval.plans import q_tokens
from extracteval.sources import fixtures as X


def rows_of(seed=7, keys=30):
    rnd = random.Random(seed)
    word = lambda: rnd.choice("abcde") * rnd.randint(1, 6)
    rows = [(k, lab, " ".join(word() for _ in range(rnd.randint(0, 12)))) for k in range(keys) for lab in "xyz"]
    return [*rows, rows[0], rows[0], (1, "x", None), (2, "y", " \n  "), (3, "z", "\x1ca aa\x85b\t"), (3, "z", "only here")]


@pytest.mark.parametrize("head", [0, 4, 65_536])
def test_rows_that_share_a_key(spark, head):
    rows = rows_of()
    df = spark.createDataFrame(rows, "k bigint, lab string, text string").repartition(3)
    vocab = encode.build_vocab(df).where("token <> 'bb'")
    ids = {r.token: r.token_id for r in vocab.collect()}
    assert encode.together(df, ["k"]) == ["k"]
    coded = encode.tokenize_ids(df, ["k", "lab"], "text", vocab, head=head, by=["k"])
    want = [(k, lab, [ids.get(w, encode.UNK_ID) for w in (t or "").split()]) for k, lab, t in rows]
    assert sorted(map(tuple, coded.collect())) == sorted(want)
    texts = encode.decode_ids(coded, ["k", "lab"], "ids", vocab, head=head, by=["k"])
    assert sorted(map(tuple, texts.collect())) == sorted((k, lab, " ".join(w for w in (t or "").split() if w != "bb")) for k, lab, t in rows)


def test_large_groups_and_missing_keys_are_looked_up_by_row(spark):
    few = spark.range(2 * encode.SHARED).select((F.col("id") % 2).alias("k"))
    assert encode.together(few, ["k"]) == ["k"]
    assert encode.together(few.union(spark.range(1)), ["k"]) is None
    assert encode.together(few.union(spark.sql("SELECT CAST(NULL AS BIGINT)")), ["k"]) is None


def test_texts_stay_where_they_are(spark):
    df = spark.createDataFrame(rows_of(), "k bigint, lab string, text string")
    vocab = encode.save_vocab(encode.build_vocab(df), f"{spark.conf.get('spark.checkpoint.dir')}/stay")
    laid = df.select("k", "lab").repartition(8, "k").withColumn("text", F.concat(F.col("k").cast("string"), F.lit(" "), F.col("lab")))
    plan = encode.tokenize_ids(laid, ["k", "lab"], "text", vocab, head=2, by=["k"])._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    dealt = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", plan)
    assert dealt and not any("text" in columns for columns in dealt), plan


def test_no_shuffled_file_is_left_of_a_saved_vocabulary(spark):
    df = spark.createDataFrame(rows_of(), "k bigint, lab string, text string")
    folders = [f.getPath() for f in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    files = lambda: {x for d in folders for _, _, names in os.walk(d) for x in names if x.startswith("shuffle_")}
    before = files()
    vocab = encode.save_vocab(encode.build_vocab(df), f"{spark.conf.get('spark.checkpoint.dir')}/left")
    assert not files() - before
    assert Counter({r.token: r.n for r in vocab.collect()}) == Counter(w for _, _, t in rows_of() for w in (t or "").split())
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"


@pytest.mark.parametrize("times", [1, 2, 5])
def test_decoded_outputs_with_repeated_orders(spark, tmp_path, times):
    orders = [(k, k % 3, 10.5 + k, "1-URGENT", "O") for k in range(7)] * times + [(None, 1, 1.0, "5-LOW", "F"), (9, None, 1.0, "5-LOW", "F"), (11, 2, None, "5-LOW", "F")]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_totalprice double, o_orderpriority string, o_orderstatus string").write.parquet(f"{tmp_path}/orders.parquet")
    customers = [(0, "Customer#0", "A B"), (1, "Customer#1 x", "C"), (2, " Customer#2", "D")]
    spark.createDataFrame(customers, "c_custkey long, c_name string, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    outputs = X.x_outputs(spark, str(tmp_path)).collect()
    cases = Counter(r.test_id for r in X.x_cases(spark, str(tmp_path)).where("input IS NOT NULL").collect())
    want = [(r.label, r.test_id, " ".join((r.output or "").split())) for r in outputs for _ in range(cases[r.test_id]) if r.test_id is not None]
    got = [tuple(r) for r in q_tokens.q_p6_ids(spark, str(tmp_path)).collect() if r.test_id != 11]
    key = lambda r: (r[1], r[0], r[2])
    assert sorted(got, key=key) == sorted((r for r in want if r[1] != 11), key=key)
