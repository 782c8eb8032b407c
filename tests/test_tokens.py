"""Vocabulary join, packed blocks, stacked batches and JSON text against plain Python."""

import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from extracteval.operators import curate, encode
from extracteval.operators.prompts import normalise_sft_output


@pytest.fixture(scope="module")
def corpus(spark):
    rnd = random.Random(3)
    texts = [" ".join(rnd.choice("abcdefgh") * rnd.randint(1, 3) for _ in range(rnd.randint(0, 40))) for _ in range(60)]
    texts += ["", None, "  ", texts[0], "word " * 3000]
    rows = [(i % 20, t) for i, t in enumerate(texts)]
    rows += [(1, "a b"), (1, "c d"), (1, "a b"), (None, "a zz")]
    return rows, spark.createDataFrame(rows, "id bigint, text string").repartition(3)


def plain_vocab(rows):
    import hashlib

    n = Counter(w for _, t in rows for w in (t or "").split())
    order = sorted(n, key=lambda w: (-n[w], hashlib.md5(w.encode()).hexdigest(), w))
    return {w: i + encode.FIRST_ID for i, w in enumerate(order)}


@pytest.mark.parametrize("head", [0, 3, 65_536])
def test_repeated_keys_stay_rows_of_their_own(spark, corpus, head):
    rows, df = corpus
    ids = plain_vocab(rows)
    known = encode.build_vocab(df).where("token <> 'b'")
    got = encode.tokenize_ids(df, ["id"], "text", known, head=head).collect()
    want = [(i, [encode.UNK_ID if w == "b" else ids[w] for w in (t or "").split()]) for i, t in rows]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(((r.id, r.ids) for r in got), key=key) == sorted(want, key=key)


def test_cut_before_the_lookup(spark, corpus):
    rows, df = corpus
    ids = plain_vocab(rows)
    got = encode.tokenize_ids(df, ["id"], "text", encode.build_vocab(df), limit=4).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(((r.id, r.ids) for r in got), key=key) == sorted(((i, [ids[w] for w in (t or "").split()][:4]) for i, t in rows), key=key)


@pytest.mark.parametrize("head", [0, 65_536])
def test_decoding_skips_special_and_unknown_ids(spark, corpus, head):
    rows, df = corpus
    vocab = encode.build_vocab(df)
    ids = plain_vocab(rows)
    coded = spark.createDataFrame([(1, [0, ids["a"], 1, ids["zz"], ids["a"], 10**6]), (1, []), (2, None)], "k int, ids array<bigint>")
    assert sorted(tuple(r) for r in encode.decode_ids(coded, ["k"], "ids", vocab, head=head).collect()) == [(1, ""), (1, "a zz a"), (2, "")]
    new = encode.decode_new_ids(coded.withColumn("n", F.lit(2)), ["k"], "n", vocab)
    assert sorted(tuple(r) for r in new.collect()) == [(1, ""), (1, "zz a"), (2, "")]


def test_encoded_pairs_keep_every_row(spark, corpus):
    rows, df = corpus
    ids = plain_vocab(rows)
    pairs = [(1, "a", "b", "c"), (1, "a", "d", "c"), (1, "a", "b", "c"), (2, "a b", "zz", "")]
    got = encode.encode_pairs(spark.createDataFrame(pairs, "pair_id int, input string, chosen string, rejected string"), encode.build_vocab(df), length=3).collect()

    def side(text):
        x = [ids[w] for w in text.split()][:3]
        return x + [0] * (3 - len(x)), [1] * len(x) + [0] * (3 - len(x))

    want = [(p, *side(f"{i} {c}"), *side(f"{i} {r}")) for p, i, c, r in pairs]
    assert sorted((r.pair_id, r.chosen_ids, r.chosen_mask, r.rejected_ids, r.rejected_mask) for r in got) == sorted(want)


@pytest.mark.parametrize("end_id", [None, 9])
def test_blocks_hold_the_stream(spark, end_id):
    rnd = random.Random(4)
    docs = [(i, [rnd.randint(10, 99) for _ in range(rnd.choice([0, 1, 5, 30, 200]))]) for i in range(50)]
    df = spark.createDataFrame(docs, "id bigint, ids array<bigint>").repartition(4)
    stream = [(i, k, x) for i, ids in docs for k, x in enumerate(ids + ([end_id] if end_id is not None else []))]
    got = {r.block_id: r for r in encode.packed_blocks(df, "id", "ids", 64, end_id).collect()}
    assert sorted(got) == list(range(-(-len(stream) // 64)))
    for b, r in got.items():
        part = stream[b * 64 : b * 64 + 64]
        assert r.ids == [x for _, _, x in part]
        assert [(p.id, p.start + j) for p in r.pieces for j in range(p.n)] == [(i, k) for i, k, _ in part]


def test_batches_stack_row_by_row(spark):
    rows = [(i, [i, i + 1, i + 2], [1, 1, 0]) for i in range(5)]
    df = curate.assign_batches(spark.createDataFrame(rows, "pair_id bigint, ids array<bigint>, mask array<int>"), 2)
    by_id = {r[0]: r for r in rows}
    got = curate.stack_batches(df, ["ids", "mask"]).collect()
    assert sorted(r.rows for r in got) == [1, 2, 2]
    for r in got:
        assert r.columns == 3
        assert r.ids == [x for p in r.pair_id for x in by_id[p][1]] and r.mask == [x for p in r.pair_id for x in by_id[p][2]]
    ragged = spark.createDataFrame([(1, [1, 2]), (2, [1])], "pair_id bigint, ids array<bigint>")
    with pytest.raises(Exception, match="different lengths"):
        curate.stack_batches(curate.assign_batches(ragged, 2), ["ids"]).collect()


def test_object_outputs_are_written_as_python_writes_them(spark):
    rnd = random.Random(5)

    def value(depth=0):
        kind = rnd.randint(0, 9 if depth < 3 else 6)
        if kind < 3:
            return rnd.choice([None, True, False, 0, -1, 7, 10**20, 0.5, 1e16, 1e-5, 123456.78, 1.0, -0.0, 1e300, 2.5e-7])
        if kind < 7:
            return "".join(rnd.choice("ab\"\\/\n\t\r\b\f\x01\x7f féß漢😀 {}[],:' ") for _ in range(rnd.randint(0, 8)))
        if kind < 9:
            return [value(depth + 1) for _ in range(rnd.randint(0, 3))]
        return {f"k{9 - i}" + rnd.choice(["", '"', "é"]): value(depth + 1) for i in range(rnd.randint(0, 4))}

    lines = [
        json.dumps({"instruction": "x", "output": value()}, ensure_ascii=rnd.random() < 0.5, separators=rnd.choice([(",", ":"), (" ,", " : ")]))
        for _ in range(400)
    ]
    lines += ['{"output": {"b": 1.10, "a": 1E5, "c": "\\/ \\u0041 \\u00e9 \\ud83d\\ude00 \\"q\\" \\\\"}}', '{"x": 1}', '{"output": {"t": "' + '\\n\\"x\\" ' * 20_000 + '"}}']
    want = []
    for line in lines:
        out = json.loads(line).get("output")
        want.append(out if out is None or isinstance(out, str) else json.dumps(out))
    df = spark.createDataFrame(list(enumerate(lines)), "i int, line string")
    assert [r.o for r in df.select("i", normalise_sft_output("line").alias("o")).orderBy("i").collect()] == want
