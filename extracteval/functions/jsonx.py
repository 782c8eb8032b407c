"""Fence stripping, Python-json validity and safe parsing (R1-R3) as column expressions.

Spark's JSON readers accept trailing text after a complete value (``{"a":1}x`` parses), which
``json.loads`` rejects.  Validity therefore wraps the text with its own md5 as a second element,
which is found there only when the text is one complete JSON value.  Variant parsing has Python's
grammar but for the names NaN and Infinity, which are put as numbers first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from extracteval.functions.pytext import WS, col_, float_text, needs_strip, py_strip

# Fixed value: the fence pattern, with Python's \s spelled as the full whitespace class.
FENCE_RE = "```json" + WS + "*|" + WS + "*```"

# A JSON string (kept as group 1), or a number name where a number may stand.
_STRING_OR_NAME = r'("[^"\\]*+(?:\\.[^"\\]*+)*+")|(?:(?<![\w.+-])NaN|(?<![\w.+])Infinity)(?![\w.+-])'
# A raw control character, which no JSON text may hold.
_MARK = "\x02"


def strip_fences(c: Column | str) -> Column:
    """Remove every fence (```json + whitespace, or whitespace + ```), then strip."""
    x = col_(c)
    return (
        F.when(F.contains(x, F.lit("```")), py_strip(F.regexp_replace(x, FENCE_RE, "")))
        .when(needs_strip(x), py_strip(x))
        .otherwise(x)
    )


def variant_wrap(x: Column) -> Column:
    """``[x, "md5(x)"]`` parsed as VARIANT; the text is one JSON value iff element 1 is the tag."""
    return F.try_parse_json(F.concat(F.lit("["), x, F.lit(',"'), F.md5(x), F.lit('"]')))


def _once(x: Column, use) -> Column:
    """``use`` of ``x`` worked out once: a lambda's variable is bound to its value."""
    return F.get(F.transform(F.array(x), use), F.lit(0))


def _wrap_ok(w: Column, x: Column) -> Column:
    return F.try_variant_get(w, "$[1]", "string") == F.md5(x)


def numbers_for_names(x: Column) -> Column:
    """Bare ``NaN`` / ``Infinity``, which Python's parser takes for numbers, as a number past the
    double range (so both read as infinite); other spellings stay and fail to parse."""
    marked = F.regexp_replace(x, _STRING_OR_NAME, "$1" + _MARK)
    plain = F.replace(F.replace(marked, F.lit('"' + _MARK), F.lit('"')), F.lit(_MARK), F.lit("1e999"))
    has = lambda part: F.contains(x, F.lit(part))
    named = (has("NaN") | has("Infinity")) & ~has(_MARK)
    return F.when(named, plain).otherwise(x)


def _may_be_json(x: Column) -> Column:
    """False only for texts that no parse needs to refuse: by its first character a JSON text without white space
    around it is a container or a string, which its last character closes, a number or a name."""
    pairs = [x.startswith(a) & x.endswith(b) for a, b in (("{", "}"), ("[", "]"), ('"', '"'))]
    return pairs[0] | pairs[1] | pairs[2] | F.left(x, F.lit(1)).between("-", "9") | x.isin("true", "false", "null", "NaN", "Infinity")


def is_valid_json(c: Column | str) -> Column:
    """R2 core: the text is exactly one JSON value under Python's grammar; null -> false.

    Variant parsing accepts trailing text, so the text is wrapped as the first element of an array
    whose second element is the text's own md5 (unforgeable by the text).
    """
    ok = _once(col_(c), lambda v: _once(numbers_for_names(v), lambda x: _wrap_ok(variant_wrap(x), x)))
    return F.coalesce(ok, F.lit(False))


def json_validity(output: Column | str) -> Column:
    """R2: ``is_valid_json(text)`` of the reference (fences removed first)."""
    return is_valid_json(strip_fences(output))


def brace_slice(cleaned: Column | str) -> Column:
    """First '{' through last '}' of the cleaned text; '' when absent or out of order."""
    x = col_(cleaned)
    start = F.locate("{", x)
    back = F.locate("}", F.reverse(x))
    end = F.length(x) - back + 1
    found = F.when((start > 0) & (back > 0) & (end >= start), F.substring(x, start, end - start + 1))
    # "{" is not "}", so a text between braces is its own slice
    return F.when(x.startswith("{") & x.endswith("}"), x).otherwise(F.coalesce(found, F.lit("")))


def parse_json_safe(output: Column | str) -> Column:
    """A VARIANT object parsed from the brace slice; null stands for Python's ``{}``.

    Bare NaN and Infinity count as infinite numbers.
    """
    return parse_json_safe_clean(strip_fences(output))


def parse_json_safe_clean(cleaned: Column | str) -> Column:
    """R3 on text whose fences are already removed."""
    piece = _once(_once(col_(cleaned), brace_slice), numbers_for_names)
    both = _once(piece, lambda x: F.struct(x.alias("x"), variant_wrap(x).alias("w")))
    return _once(both, lambda b: F.when(_wrap_ok(b["w"], b["x"]), F.try_variant_get(b["w"], "$[0]", "variant")))


def with_parse(df: DataFrame, cleaned: str, valid: str, value: str, piece: str | None = None) -> DataFrame:
    """R2 and R3 of text without fences as columns ``valid`` and ``value`` from one parse: where
    the brace slice is the whole text, as it mostly is, its parse also tells the text's validity.
    ``piece`` names a further column for the brace slice."""
    t = df.withColumn("_slice", brace_slice(cleaned)).withColumn("_piece", numbers_for_names(F.col("_slice")))
    # a text that is refused costs more than one that is parsed, so what cannot be JSON is not tried
    t = t.withColumn("_wrap", F.when(F.col("_piece") != "", variant_wrap(F.col("_piece"))))
    t = t.withColumn("_whole", F.coalesce(_wrap_ok(F.col("_wrap"), F.col("_piece")), F.lit(False)))
    same = F.col(cleaned) == F.col("_slice")
    ok = F.when(same, F.col("_whole")).when(_may_be_json(F.col(cleaned)), is_valid_json(cleaned)).otherwise(F.lit(False))
    parsed = F.when(F.col("_whole"), F.try_variant_get("_wrap", "$[0]", "variant"))
    more = [F.col("_slice").alias(piece)] if piece else []
    return t.select(*df.columns, ok.alias(valid), parsed.alias(value), *more)


def as_object_map(v: Column | str) -> Column:
    """VARIANT object -> MAP<STRING, VARIANT> (null for non-objects)."""
    return F.try_variant_get(col_(v), "$", "map<string,variant>")


def holds_empty_list(x: Column) -> Column:
    """False only for JSON texts without an empty list at any depth."""
    return x.rlike(r"\[[ \t\r\n]*+\]")


def is_empty_object(x: Column) -> Column:
    return x.rlike(r"\A\{[ \t\r\n]*+\}\z")


def may_be_infinite(x: Column) -> Column:
    """False only for JSON texts whose numbers are all finite doubles."""
    return F.contains(x, F.lit("NaN")) | F.contains(x, F.lit("Infinity")) | x.rlike("[0-9](?:[eE]|[0-9]{299})")


# The short escapes of JSON by code point.
_SHORT = {8: "\\b", 9: "\\t", 10: "\\n", 12: "\\f", 13: "\\r", 34: '\\"', 92: "\\\\"}
# Stand-ins for an escaped backslash and an escaped quote: control characters, which JSON text never holds.
_BACKSLASH, _QUOTED = "\x01", "\x02"


def _utf16_escapes(c: Column) -> Column:
    """``\\uXXXX`` for each UTF-16 unit of one character."""
    units = F.lower(F.hex(F.encode(c, "UTF-16BE")))
    return F.regexp_replace(units, "(.{4})", r"\\u$1")


def _unit_text(u: Column) -> Column:
    """One character or escape of a string, as Python's encoder writes it (ASCII only)."""
    code = F.when(u.startswith("\\u"), F.conv(F.substring(u, 3, 4), 16, 10).cast("int"))
    text = F.when(u == _BACKSLASH, F.lit("\\\\")).when(u == _QUOTED, F.lit('\\"')).when(u == "\\/", F.lit("/"))
    for point, short in _SHORT.items():
        text = text.when(code == point, F.lit(short))
    text = text.when((code >= 32) & (code <= 126), F.char(code)).when(code.isNotNull(), F.lower(u))
    return text.when(u.startswith("\\") | u.rlike(r"^[ -~]\z"), u).otherwise(_utf16_escapes(u))


def _string_body(x: Column) -> Column:
    units = F.regexp_extract_all(x, F.lit(r"(?s)\\u[0-9a-fA-F]{4}|\\.|."), F.lit(0))
    return F.when(x.rlike(r"^[ -\[\]-~]*+\z"), x).otherwise(F.array_join(F.transform(units, _unit_text), ""))


def _number_text(t: Column) -> Column:
    """A float as Python prints it; other tokens as they are (``-0`` is the integer 0)."""
    value = F.abs(t.try_cast("double"))
    shown = F.when(value == float("inf"), F.lit("Infinity")).otherwise(float_text(value))
    signed = F.concat(F.when(t.startswith("-"), F.lit("-")).otherwise(F.lit("")), shown)
    return F.when(t == "-0", F.lit("0")).when(t.rlike(r"^-?[0-9]+(\.|[eE])"), signed).otherwise(t)


def _structure(x: Column) -> Column:
    """What stands between two strings: white space dropped, ``", "`` and ``": "``, numbers as Python's."""
    tokens = F.regexp_extract_all(x, F.lit(r"-?[0-9]+(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?|[^-0-9]+|-"), F.lit(0))
    numbers = F.when(x.rlike("[0-9]"), F.array_join(F.transform(tokens, _number_text), "")).otherwise(x)
    bare = F.regexp_replace(numbers, r"[ \t\r\n]+", "")
    return F.replace(F.replace(bare, F.lit(","), F.lit(", ")), F.lit(":"), F.lit(": "))


def json_dumps(c: Column | str) -> Column:
    """``json.dumps(json.loads(text))`` of one valid JSON text: separators, escapes, floats; keys stay in order.

    Escaped backslashes and quotes are marked, so every quote that is left bounds a string and the text's parts
    are structure and string in turn.  Separators do not depend on depth, so each part is written on
    its own.  A key that an object holds twice is kept twice (Python keeps the last value), and a number past the
    double range that Spark's reader has put as text stays text.
    """
    marked = F.replace(F.replace(col_(c), F.lit("\\\\"), F.lit(_BACKSLASH)), F.lit('\\"'), F.lit(_QUOTED))
    parts = F.transform(F.split(marked, '"'), lambda x, i: F.when(i % 2 == 0, _structure(x)).otherwise(_string_body(x)))
    return F.array_join(parts, '"')
