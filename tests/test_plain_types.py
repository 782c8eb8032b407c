"""Values of one plain type are compared as they are; the result is that of the general rules."""

import itertools
import json

from pyspark.sql import functions as F

from extracteval.functions import jsonx, scoring

STRINGS = ["", " ", "a", "A", " a ", "a\u00a0", "\u00c4b", "\u00e4B c", "None", "none", "b a", "\x1fa"]
LISTS = [["a"], ["A", "a"], ["a", None], ["None"], ["none", None], ["b", "a", "b"], ["\u00c4"], ["\u00e4", "x"], ["x", "\u00e4", "x"]]


def _pairs(spark, values):
    rows = [(json.dumps(e), json.dumps(p)) for e, p in itertools.product(values, values)]
    df = spark.createDataFrame(rows, "e string, p string")
    return df.select("e", "p", F.parse_json("e").alias("ev"), F.parse_json("p").alias("pv"))


def test_strings_match_as_texts_do(spark):
    e, p = F.col("ev"), F.col("pv")
    text = F.lit("STRING")
    got = _pairs(spark, STRINGS).select("e", "p", scoring.match_strings(e, p).alias("a"), scoring.match_text(e, text, p, text).alias("b")).collect()
    for r in got:
        x, y = json.loads(r.e).lower(), json.loads(r.p).lower()
        want = 1.0 if x.strip() == y.strip() else 0.5 if x in y else 0.0
        assert r.a == r.b == want, r


def test_string_lists_match_as_lists_do(spark):
    e, p = F.col("ev"), F.col("pv")
    got = _pairs(spark, LISTS).select("e", "p", scoring.match_string_lists(e, p).alias("a"), scoring.match_list(e, p, F.schema_of_variant(p)).alias("b")).collect()
    for r in got:
        x, y = ({str(i).lower() for i in json.loads(t)} for t in (r.e, r.p))
        assert r.a == r.b == len(x & y) / len(x), r


def test_numbers_of_any_type(spark):
    values = [0, 1, True, False, 1.0, 1.005, 12345678901234567890, 2**63 - 1, -3, 1e300, "1", " 1.0 ", "x", None]
    df = _pairs(spark, values)
    e, p = F.col("ev"), F.col("pv")
    got = df.select("e", "p", scoring.match_number(e, F.schema_of_variant(e), p, F.schema_of_variant(p)).alias("a")).collect()
    for r in got:
        try:
            want = 1.0 if abs(float(json.loads(r.e)) - float(json.loads(r.p))) < 0.01 else 0.0
        except (TypeError, ValueError):
            want = 0.0
        assert r.a == want, r


def test_texts_between_braces(spark):
    texts = ["{}", "{", "}", "}{", "{a}", " {a} ", "{```json }", "x{a}y", "```json\n{a}\n```", "{a} ```", "", "{NaN}", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", jsonx.brace_slice("t").alias("s"), jsonx.strip_fences("t").alias("f"), scoring.format_compliance("t").alias("c")).collect()
    for r in got:
        t = r.t or ""
        a, z = t.find("{"), t.rfind("}")
        assert r.s == (t[a : z + 1] if 0 <= a <= z else ""), r
        s = t.strip()
        assert r.c == (1.0 if s.startswith("{") and s.endswith("}") else 0.5 if "{" in s and "}" in s else 0.0), r
    assert {r.t: r.f for r in got}["```json\n{a}\n```"] == "{a}" and {r.t: r.f for r in got}[" {a} "] == "{a}"


def test_prediction_without_keys_is_not_compared(spark):
    df = spark.createDataFrame([("{\"a\": []}", "{}"), ("{\"a\": null}", "x"), ("{}", "{\"a\": 1}"), ("{\"a\": 1}", "{\"a\": 1, \"b\": 2}")], "e string, o string")
    em, pm = jsonx.as_object_map(F.try_parse_json("e")), jsonx.as_object_map(jsonx.parse_json_safe("o"))
    assert [r[0] for r in df.select(scoring.field_accuracy(em, pm)).collect()] == [0.0, 0.0, 0.0, 1.0]
