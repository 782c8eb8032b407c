"""Golden vectors hand-derived from reading the reference scorer (FIXTURES.md section 4)."""

import json

import pytest
from pyspark.sql import functions as F

from extracteval.functions import jsonx, scoring
from extracteval.functions.pytext import py_split, py_strip, round_half_even, signed_percent
from extracteval.functions.textstats import ngram_diversity, response_length

ACCURACY = [
    ('{"a":2}', '{"a":"2"}', 1.0),
    ('{"a":249}', '{"a":"$249"}', 0.0),
    ('{"a":249}', '{"a":249.009}', 1.0),
    ('{"a":249}', '{"a":249.02}', 0.0),
    ('{"a":1000}', '{"a":"1_000"}', 1.0),
    ('{"a":5}', '{"a":"5d"}', 0.0),
    ('{"a":true}', '{"a":"true"}', 0.0),
    ('{"a":true}', '{"a":1}', 1.0),
    ('{"a":5}', '{"a":null}', 0.0),
    ('{"a":["x","y"]}', '{"a":["X"]}', 0.5),
    ('{"a":["x","y"]}', '{"a":"x, y"}', 0.0),
    ('{"a":["x","X"]}', '{"a":["x"]}', 1.0),
    ('{"a":[1,2]}', '{"a":[1.0,2]}', 0.5),
    ('{"a":[null,true]}', '{"a":["None","TRUE"]}', 1.0),
    ('{"a":[]}', '{"a":[]}', 0.0),
    ('{"a":[]}', '{"a":"x"}', 0.0),
    ('{"a":"Moscone Center"}', '{"a":"Moscone Center, SF"}', 0.5),
    ('{"a":"Moscone Center, SF"}', '{"a":"Moscone Center"}', 0.0),
    ('{"a":"abc"}', '{"a":" ABC "}', 1.0),
    ('{"a":""}', '{"a":"zzz"}', 0.5),
    ('{"a":null}', '{"a":null}', 1.0),
    ('{"a":null}', '{"a":"None given"}', 0.5),
    ('{"a":"55821"}', '{"a":55821}', 1.0),
    ('{"a":"1"}', '{"a":1.0}', 0.5),
    ('{"a":"true"}', '{"a":true}', 1.0),
    ('{"a":{"k":1}}', '{"a":{"k":1}}', 1.0),
    ('{"a":1,"b":2,"c":3}', '{"a":1}', 0.333),
    ('{"a":1}', '{"a":1,"z":9}', 1.0),
    ('{"A":1}', '{"a":1}', 0.0),
    ("{}", '{"a":1}', 0.0),
    ('{"a":1}', "not json at all", 0.0),
]


def test_field_accuracy_golden(spark):
    df = spark.createDataFrame(ACCURACY, "expected string, output string, want double")
    em = jsonx.as_object_map(F.try_parse_json("expected"))
    pm = jsonx.as_object_map(jsonx.parse_json_safe("output"))
    rows = df.select("expected", "output", "want", scoring.field_accuracy(em, pm).alias("got")).collect()
    bad = [(r.expected, r.output, r.want, r.got) for r in rows if r.got != r.want]
    assert not bad


def test_empty_list_flag(spark):
    df = spark.createDataFrame([('{"a":[]}',), ('{"a":[1]}',)], "e string")
    got = [r[0] for r in df.select(scoring.empty_list_flag(jsonx.as_object_map(F.try_parse_json("e")))).collect()]
    assert got == [True, False]


FENCE = "```"
VALIDITY = [
    ('{"a":1}', True, ["a"]),
    (FENCE + 'json\n{"a":1}\n' + FENCE, True, ["a"]),
    ("\n" + FENCE + 'json\n{"a":1}\n' + FENCE, False, ["a"]),
    (FENCE + 'JSON\n{"a":1}\n' + FENCE, False, ["a"]),
    ('{"a":1} thanks', False, ["a"]),
    ("5", True, []),
    ('"hi"', True, []),
    ("null", True, []),
    ("NaN", True, []),
    ("Infinity", True, []),
    ("[+Infinity]", False, []),
    ("[NaN,+INF]", False, []),
    ("[INF]", False, []),
    ("[-Infinity, NaN]", True, []),
    ("[-NaN]", False, []),
    ("[1Infinity]", False, []),
    ("[NaN1]", False, []),
    ('{"a":NaN,"b":1}', True, ["a", "b"]),
    ('{"a NaN \\"x":"Infinity, NaN","b":-Infinity}', True, ['a NaN "x', "b"]),
    ('{"a":NaN}\x02', False, ["a"]),
    ('{"a":"NaN\x02"}', False, []),
    ('[{"a":1}]', True, ["a"]),
    ('[{"a":1},{"b":2}]', True, []),
    ('{"a":1}{"b":2}', False, []),
    ('{"a":1,"a":2}', True, ["a"]),
    ('{"a":1,}', False, []),
    ("{'a':1}", False, []),
    ('{"a":01}', False, []),
    ("{a:1}", False, []),
    ("", False, []),
    ("} {", False, []),
]


def test_validity_and_parse(spark):
    df = spark.createDataFrame([(t,) for t, _, _ in VALIDITY], "output string")
    m = jsonx.as_object_map(jsonx.parse_json_safe("output"))
    rows = df.select(
        jsonx.json_validity("output").alias("v"),
        F.coalesce(F.array_sort(F.map_keys(m)), F.array().cast("array<string>")).alias("k"),
    ).collect()
    for (text, valid, keys), r in zip(VALIDITY, rows):
        assert r.v == valid, text
        assert list(r.k) == keys, text


TEXTS = ["1e20", "1e-07", "1.5e300", "-2.5e-5", "1e10", "123456.75e3", "0.0001", "0.00001", "1e15", "1e16", "12345678901234567890.5",
         "1.0", "-0.5", "0.0", "[1, 2]", '["a", "it\'s", "q\\"\'", "x\\\\y"]', "[1.0, true, null, 1e20]", "[]", "Infinity", "-Infinity", "7", "true", "null"]


def test_texts_are_pythons(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    got = df.select(scoring.py_text(F.parse_json(jsonx.numbers_for_names(F.col("t"))))).collect()
    assert [g[0] for g in got] == [str(json.loads(t)) for t in TEXTS]


def test_duplicate_keys_keep_last(spark):
    df = spark.createDataFrame([('{"a":1,"a":2}',)], "output string")
    v = df.select(F.to_json(jsonx.parse_json_safe("output"))).first()[0]
    assert json.loads(v) == {"a": 2}


COMPLIANCE = [('{"a":1}', 1.0), (' {"a":1}\n', 1.0), ("{oops}", 1.0), ("{a} and {b}", 1.0), ('x {"a":1}', 0.5),
              ("[{}]", 0.5), ("} {", 0.5), ('{"a":1', 0.0), ("5", 0.0), ("", 0.0)]


def test_format_compliance(spark):
    df = spark.createDataFrame(COMPLIANCE, "t string, want double")
    for r in df.select("want", scoring.format_compliance("t").alias("got")).collect():
        assert r.got == r.want


LENGTHS = [("a b a b", 4, 0.667), ("A a a", 3, 0.5), ("a", 1, 0.0), ("", 0, 0.0), ("  x y ", 2, 1.0),
           ("x\x1cy\x85z　w", 4, 1.0)]


def test_length_and_diversity(spark):
    df = spark.createDataFrame([(t,) for t, _, _ in LENGTHS], "t string")
    rows = df.select(response_length("t").alias("n"), ngram_diversity("t").alias("d")).collect()
    for (t, n, d), r in zip(LENGTHS, rows):
        assert (r.n, r.d) == (n, d), t


def test_python_whitespace(spark):
    text = "　\x1c a b\x85\n"
    r = spark.createDataFrame([(text,)], "t string").select(py_strip("t").alias("s"), py_split("t").alias("w")).first()
    assert r.s == text.strip() and list(r.w) == text.split()


def test_round_half_even_and_percent(spark):
    df = spark.createDataFrame([(0.5625,), (0.4375,), (0.0625,), (0.477,), (-0.552,), (0.0,)], "x double")
    rows = df.select(round_half_even("x", 3).alias("r"), signed_percent("x").alias("p")).collect()
    assert [r.r for r in rows[:3]] == [0.562, 0.438, 0.062]
    assert [r.p for r in rows[3:]] == ["+47.7%", "-55.2%", "+0.0%"]
