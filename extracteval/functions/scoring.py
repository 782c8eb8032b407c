"""Tolerant per-field scoring (R5-R10) over MAP<STRING, VARIANT> columns.

All rules run inside higher-order functions over the expected object's entries, so scoring a
row needs no shuffle and no Python.  Value kinds come from ``schema_of_variant``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from extracteval.functions import jsonx
from extracteval.functions.pytext import col_, float_text, py_float, py_strip, round_half_even, stands_bare

_INTEGRAL = ("BIGINT", "INT", "SMALLINT", "TINYINT")

# Higher-order functions evaluate interpreted: an expression repeated inside a lambda (or an outer
# column captured by it) is re-evaluated per element.  So every value travels with its type string
# ``t = schema_of_variant(v)`` computed once, and no lambda captures an outer expression.


def kind_of(t: Column) -> Column:
    """Coarse kind from a variant type string: null, str, int, dec, dbl, bool, list, obj."""
    return (
        F.when(t.isNull() | (t == "VOID"), F.lit("null"))
        .when(t == "STRING", F.lit("str"))
        .when(t.isin(*_INTEGRAL), F.lit("int"))
        .when(t.startswith("DECIMAL"), F.lit("dec"))
        .when(t.isin("DOUBLE", "FLOAT"), F.lit("dbl"))
        .when(t == "BOOLEAN", F.lit("bool"))
        .when(t.startswith("ARRAY"), F.lit("list"))
        .otherwise(F.lit("obj"))
    )


def vkind(v: Column) -> Column:
    return kind_of(F.schema_of_variant(v))


def _is_num(t: Column) -> Column:
    return t.isin(*_INTEGRAL, "DOUBLE", "FLOAT", "BOOLEAN") | t.startswith("DECIMAL")


def string_repr(s: Column) -> Column:
    """``repr(str)`` of printable text: single quotes, double ones where only they avoid escapes."""
    for raw, escaped in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        s = F.replace(s, F.lit(raw), F.lit(escaped))
    double = (F.instr(s, "'") > 0) & (F.instr(s, '"') == 0)
    single = F.concat(F.lit("'"), F.replace(s, F.lit("'"), F.lit("\\'")), F.lit("'"))
    return F.when(double, F.concat(F.lit('"'), s, F.lit('"'))).otherwise(single)


def list_text(v: Column) -> Column:
    """``str(list)``; lists and objects inside it render as JSON text (declared deviation)."""
    items = F.transform(F.try_variant_get(v, "$", "array<variant>"), lambda x: F.struct(x.alias("x"), F.schema_of_variant(x).alias("t")))
    return F.concat(F.lit("["), F.array_join(F.transform(items, lambda s: _item_text(s["x"], s["t"])), ", "), F.lit("]"))


def _item_text(v: Column, t: Column) -> Column:
    return F.when(t == "STRING", string_repr(F.variant_get(v, "$", "string"))).otherwise(_scalar_text(v, t))


def py_text(v: Column, t: Column | None = None) -> Column:
    """``str(value)`` of the Python object json.loads would build (t: the value's type string).

    Floats arrive as DECIMAL with trailing zeros dropped (1.0 -> DECIMAL(1,0) '1'), so a
    missing '.' gets '.0' back.  Objects render as JSON text (declared deviation from Python's repr).
    """
    t = F.schema_of_variant(v) if t is None else t
    return (
        F.when(t == "STRING", F.variant_get(v, "$", "string"))
        .when(t.startswith("ARRAY"), list_text(v))
        .otherwise(_scalar_text(v, t))
    )


def _scalar_text(v: Column, t: Column) -> Column:
    dec = v.cast("string")
    short = (F.length(dec) <= 16) & (F.abs(dec.try_cast("double")) >= 1e-4)
    return (
        F.when(v.isNull() | (t == "VOID"), F.lit("None"))
        .when(t == "STRING", F.variant_get(v, "$", "string"))
        .when(t == "BOOLEAN", F.when(F.variant_get(v, "$", "boolean"), F.lit("True")).otherwise(F.lit("False")))
        .when(t.startswith("DECIMAL") & short, F.when(F.instr(dec, ".") > 0, dec).otherwise(F.concat(dec, F.lit(".0"))))
        .when(t.startswith("DECIMAL") | t.isin("DOUBLE", "FLOAT"), float_text(F.try_variant_get(v, "$", "double")))
        .when(t.isin(*_INTEGRAL), dec)
        .otherwise(F.to_json(v))
    )


def as_number(v: Column, t: Column) -> Column:
    """``float(value)``: numbers and bools convert, text by Python's float grammar, else null."""
    # a value read as its own type costs a fraction of one that is cast
    return (
        F.when(t.startswith("DECIMAL") | t.isin("DOUBLE", "FLOAT"), F.try_variant_get(v, "$", "double"))
        .when(t == "BOOLEAN", F.try_variant_get(v, "$", "boolean").cast("double"))
        .when(t.isin(*_INTEGRAL), F.try_variant_get(v, "$", "bigint").cast("double"))
        .when(t == "STRING", py_float(F.variant_get(v, "$", "string")))
    )


def match_number(e: Column, et: Column, p: Column, pt: Column) -> Column:
    """1 when |float(pred) - float(exp)| < 0.01 (strict), else 0."""
    diff = F.abs(as_number(p, pt) - as_number(e, et))
    return F.when(diff < F.lit(0.01), F.lit(1.0)).otherwise(F.lit(0.0))


def text_set(v: Column) -> Column:
    """Distinct lower-cased texts of a VARIANT list's elements."""
    items = F.try_variant_get(v, "$", "array<variant>")
    typed = F.transform(items, lambda x: F.struct(x.alias("x"), F.schema_of_variant(x).alias("t")))
    return F.array_distinct(F.transform(typed, lambda s: F.lower(py_text(s["x"], s["t"]))))


def _once(x: Column, use) -> Column:
    """``use`` of ``x`` worked out once: a lambda's variable is bound to its value."""
    return F.get(F.transform(F.array(x), use), F.lit(0))


def _share(e: Column, p: Column) -> Column:
    sets = F.struct(e.alias("e"), p.alias("p"))
    n = lambda c: F.size(c).cast("double")
    return _once(sets, lambda b: F.when(F.size(b["e"]) > 0, n(F.array_intersect(b["e"], b["p"])) / n(b["e"])).otherwise(F.lit(0.0)))


def match_list(e: Column, p: Column, pt: Column) -> Column:
    """|distinct lower texts in both| / |distinct expected|; non-list prediction -> 0."""
    return F.when(pt.startswith("ARRAY"), _share(text_set(e), text_set(p))).otherwise(F.lit(0.0))


def match_string_lists(e: Column, p: Column) -> Column:
    """R6 of two lists that hold strings (at least one each) and nulls only, read without their items' types."""
    es, ps = F.try_variant_get(e, "$", "array<string>"), F.try_variant_get(p, "$", "array<string>")
    texts = lambda c: F.array_distinct(F.transform(c, lambda x: F.lower(F.coalesce(x, F.lit("None")))))
    return F.when(es == ps, F.lit(1.0)).otherwise(_share(texts(es), texts(ps)))


def _texts_differ(texts: Column) -> Column:
    """R7 of the two texts of a struct (e, p) that are not equal as they are."""
    lowered = lambda b: F.struct(F.lower(b["e"]).alias("e"), F.lower(b["p"]).alias("p"))
    differ = lambda b: F.when(py_strip(b["p"]) == py_strip(b["e"]), F.lit(1.0)).when(F.contains(b["p"], b["e"]), F.lit(0.5)).otherwise(F.lit(0.0))
    return _once(lowered(texts), differ)


def match_text(e: Column, et: Column, p: Column, pt: Column) -> Column:
    """Equal after lower+strip -> 1; lower(expected) inside lower(pred) -> 0.5; else 0."""
    texts = F.struct(py_text(e, et).alias("e"), py_text(p, pt).alias("p"))
    return _once(texts, lambda b: F.when(b["e"] == b["p"], F.lit(1.0)).otherwise(_texts_differ(b)))


def match_strings(e: Column, p: Column) -> Column:
    """R7 of two strings."""
    es, ps = F.try_variant_get(e, "$", "string"), F.try_variant_get(p, "$", "string")
    return F.when(es == ps, F.lit(1.0)).otherwise(_once(F.struct(es.alias("e"), ps.alias("p")), _texts_differ))


def rule_from(et: Column) -> Column:
    """Which rule applies to an expected value: number (bool included, X5), list or text."""
    return F.when(_is_num(et), F.lit("number")).when(et.startswith("ARRAY"), F.lit("list")).otherwise(F.lit("text"))


def rule_of(exp: Column) -> Column:
    return rule_from(F.schema_of_variant(exp))


def _empty_map() -> Column:
    return F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<variant>"))


def field_pairs(exp_map: Column | str, pred_map: Column | str) -> Column:
    """MAP<key, STRUCT<e, et, p, pt>> over expected and predicted keys (``e`` null: extra key,
    ``p`` null: key missing from the prediction; a present JSON null is a non-null VOID value)."""
    return F.map_zip_with(
        F.coalesce(col_(exp_map), _empty_map()),
        F.coalesce(col_(pred_map), _empty_map()),
        lambda k, e, p: F.struct(
            e.alias("e"), F.schema_of_variant(e).alias("et"), p.alias("p"), F.schema_of_variant(p).alias("pt")
        ),
    )


def value_pairs(exp_map: Column | str, pred_map: Column | str) -> Column:
    """field_pairs without the types: MAP<key, STRUCT<e, p>>."""
    return F.map_zip_with(
        F.coalesce(col_(exp_map), _empty_map()),
        F.coalesce(col_(pred_map), _empty_map()),
        lambda k, e, p: F.struct(e.alias("e"), p.alias("p")),
    )


def earns_all(expected: Column | str) -> Column:
    """Every key of this JSON object earns its full credit from a prediction of the same text; an empty list and an
    infinite number do not match themselves."""
    x = col_(expected)
    return ~(jsonx.holds_empty_list(x) | jsonx.may_be_infinite(x))


def pair_credit(s: Column | Mapping[str, Column]) -> Column:
    """Credit in [0, 1] of one expected key (``s`` a field_pairs value)."""
    e, et, p, pt = s["e"], s["et"], s["p"], s["pt"]
    strings, lists = F.lit("STRING"), F.lit("ARRAY<STRING>")
    # values of one plain type are compared as they are; all others by the general rules
    return (
        F.when(p.isNull(), F.lit(0.0))
        .when(et == strings, F.when(pt == strings, match_strings(e, p)).otherwise(match_text(e, et, p, pt)))
        .when(et == "VOID", F.when(pt == "VOID", F.lit(1.0)).otherwise(match_text(e, et, p, pt)))
        .when(et.startswith("ARRAY"), F.when((et == lists) & (pt == lists), match_string_lists(e, p)).otherwise(match_list(e, p, pt)))
        .when(_is_num(et), match_number(e, et, p, pt))
        .otherwise(match_text(e, et, p, pt))
    )


def field_accuracy(exp_map: Column | str, pred_map: Column | str) -> Column:
    """Sum of credits / number of expected keys, 3 dp; empty expected -> 0.0."""
    em, pm = col_(exp_map), col_(pred_map)
    pairs = F.map_values(field_pairs(em, pm))
    total = F.aggregate(
        pairs, F.lit(0.0), lambda acc, s: acc + F.when(s["e"].isNull(), F.lit(0.0)).otherwise(pair_credit(s))
    )
    n = F.size(em)
    # a prediction without keys earns nothing, so nothing is compared
    none = em.isNull() | (n <= 0) | pm.isNull() | (F.size(pm) <= 0)
    return F.when(none, F.lit(0.0)).otherwise(round_half_even(total / n.cast("double"), 3))


def empty_list_flag(exp_map: Column | str) -> Column:
    """The expected object holds an empty list (the reference divides by zero there)."""
    em = col_(exp_map)
    return F.coalesce(
        F.exists(F.map_values(em), lambda v: F.size(F.try_variant_get(v, "$", "array<variant>")) == 0),
        F.lit(False),
    )


def format_compliance(output: Column | str) -> Column:
    """1.0 only-braces, 0.5 both braces somewhere, else 0.0 (no validity check)."""
    x = col_(output)
    s = py_strip(x)
    between = stands_bare(x, "{}") & s.startswith("{") & s.endswith("}")
    return (
        F.when(x.startswith("{") & x.endswith("}"), F.lit(1.0))
        .when(F.contains(x, F.lit("{")) & F.contains(x, F.lit("}")), F.when(between, F.lit(1.0)).otherwise(F.lit(0.5)))
        .otherwise(F.lit(0.0))
    )
