"""Texts that cannot be JSON are refused without a parse."""

from extracteval.functions import jsonx


def test_texts_that_cannot_be_json(spark):
    texts = ["", "{", "}", "x", "No", "[1]", "[1", '"a"', '"a', "1", "-1", "01", "NaN", "-Infinity", "null", '{"a":1} x', None]
    t = jsonx.with_parse(spark.createDataFrame([(x,) for x in texts], "c string"), "c", "valid", "value")
    valid = {r.c for r in t.where("valid").collect()}
    assert valid == {"[1]", '"a"', "1", "-1", "NaN", "-Infinity", "null"}
