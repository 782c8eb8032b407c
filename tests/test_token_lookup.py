"""Tokens outside the head, repeated, unknown or in empty rows keep their places; lookups run in batches."""

from extracteval.operators import encode

ROWS = [(1, "a b  c a zz b"), (1, "a b  c a zz b"), (None, None), (2, ""), (3, "zz yy a a q"), (4, " a")]


def test_lookup_by_any_head(spark):
    t = spark.createDataFrame(ROWS, "k int, text string")
    vocab = spark.createDataFrame([("a", 2, 9), ("b", 3, 5), ("zz", 4, 4), ("c", 5, 1)], "token string, token_id long, n long")
    for head in (0, 1, 3, 9):
        ids = encode.tokenize_ids(t, ["k"], "text", vocab, head=head)
        assert "ArrowEvalPython" in ids._jdf.queryExecution().executedPlan().toString()
        got = sorted(((r.k or 0), r.ids) for r in ids.collect())
        assert got == [(0, []), (1, [2, 3, 5, 2, 4, 3]), (1, [2, 3, 5, 2, 4, 3]), (2, []), (3, [4, 1, 2, 2, 1]), (4, [2])]
        texts = sorted(((r.k or 0), r.text) for r in encode.decode_ids(ids, ["k"], "ids", vocab, head=head).collect())
        assert texts == [(0, ""), (1, "a b c a zz b"), (1, "a b c a zz b"), (2, ""), (3, "zz a a"), (4, "a")]
