"""A prediction of the expected text as it stands is scored without a comparison; the result is that of the rules."""

from pyspark.sql import functions as F

from extracteval.functions import jsonx, scoring
from extracteval.operators import score

EXPECTED = [
    '{"a": "x", "b": 1, "c": true, "d": ["p", "Q", null], "e": null, "f": {"g": [1]}}',
    '{"a": [], "b": 1}', '{"a": [ ], "b": "[ ]"}', '{"a": "[]", "b": 2}', '{"a": {"b": []}, "c": 1}', "{}", "{ }",
    '{"a": 1e400, "b": 1}', '{"a": NaN, "b": 1}', '{"a": -Infinity}', '{"a": "NaN"}', '{"a": 1e2}', '{"a": 1' + "0" * 320 + ', "b": 1}',
    '{"a": 1, "a": 2}', '{"a": 1} x', '{"a": ', "[1]", "", None, '{"a": 0.1, "b": "Infinity", "c": [1.0, "1"]}',
]


def _aligned(spark, wrap):
    rows = [("m", i, wrap(x), "text", x) for i, x in enumerate(EXPECTED)]
    return spark.createDataFrame(rows, "label string, test_id bigint, output string, input string, expected string")


def _by_rules(df):
    """Maps of both texts compared key by key."""
    em = jsonx.as_object_map(F.try_parse_json(jsonx.numbers_for_names(F.col("expected"))))
    pm = jsonx.as_object_map(jsonx.parse_json_safe("output"))
    t = df.withColumn("em", em).withColumn("pm", pm)
    return t.select("test_id", scoring.field_accuracy("em", "pm"), scoring.empty_list_flag("em"), "em", "pm")


def test_scores_of_same_text(spark):
    assert "_full" in score._with_parsed(_aligned(spark, lambda x: x)).columns
    for wrap in (lambda x: x, lambda x: f"```json\n{x}\n```", lambda x: f"So: {x} .", lambda x: x and x.replace('"a": ', '"a":  ')):
        df = _aligned(spark, wrap)
        got = {r.test_id: (r.field_accuracy, r.empty_expected_list) for r in score.score_outputs(df).collect()}
        want = {r[0]: (r[1], r[2]) for r in _by_rules(df).collect()}
        assert got == want
    assert [got[i][0] for i in (0, 1, 5, 13)] == [1.0, 0.5, 0.0, 1.0]


def test_credits_of_same_text(spark):
    df = _aligned(spark, lambda x: x)
    got = sorted(tuple(r) for r in score.field_breakdown(df).select("test_id", "key", "present", "credit").collect())
    pairs = _by_rules(df).select("test_id", F.explode(scoring.field_pairs("em", "pm")).alias("key", "s"))
    s = F.col("s")
    want = pairs.where(s["e"].isNotNull()).select("test_id", "key", s["p"].isNotNull(), scoring.pair_credit(s))
    assert got == sorted(tuple(r) for r in want.collect())


def test_white_space_at_either_end(spark):
    texts = ["", " ", "a", " a", "a ", "\x1fa\x85", "{a} ", "a b", "```json {}```", " {x```", "{a}\n```", None]
    rows = spark.createDataFrame([(x,) for x in texts], "x string").select("x", jsonx.strip_fences("x").alias("s"), scoring.format_compliance("x").alias("c"))
    import re

    for r in rows.collect():
        want = r.x and re.sub(r"```json\s*|\s*```", "", r.x).strip()
        t = (r.x or "").strip()
        assert r.s == want
        assert r.c == (1.0 if t.startswith("{") and t.endswith("}") else 0.5 if "{" in t and "}" in t else 0.0)
