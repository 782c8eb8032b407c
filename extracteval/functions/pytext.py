"""Python text and number semantics as Spark column expressions.

The reference is plain Python: ``str.strip``, ``str.split``, ``round``, ``float`` and
``format`` define the results.  Spark's own ``trim``/``split``/``round``/``format_string``
differ (space-only trim, half-up rounding, Java number grammar), so each is rebuilt here from
built-in expressions that stay inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.isspace() accepts (str.strip / str.split / re \s).
PY_WHITESPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same set as a Java regex character class.
WS = r"[\s\x1c-\x1f\x85\p{Z}]"
# Python's float() grammar for finite decimal text (after strip); '_' only between digits.
PY_FLOAT_RE = r"^[+-]?(\d(_?\d)*(\.(\d(_?\d)*)?)?|\.\d(_?\d)*)([eE][+-]?\d(_?\d)*)?$"


def col_(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c: Column | str) -> Column:
    """``str.strip()``: both ends, the full Python whitespace set."""
    return F.trim(col_(c), F.lit(PY_WHITESPACE))


def stands_bare(x: Column, more: str) -> Column:
    """White space or a sign of ``more`` stands at both ends, or the text is empty."""
    signs = F.lit(PY_WHITESPACE + more)
    return F.contains(signs, F.left(x, F.lit(1))) & F.contains(signs, F.substring(x, -1, 1))


def needs_strip(x: Column) -> Column:
    """White space stands at one end, or the text is empty; stripping reads a text several times, this test once."""
    signs = F.lit(PY_WHITESPACE)
    return F.contains(signs, F.left(x, F.lit(1))) | F.contains(signs, F.substring(x, -1, 1))


def py_split(c: Column | str) -> Column:
    """``str.split()`` with no separator: runs of whitespace, no empty tokens."""
    parts = F.split(col_(c), WS + "+")
    return F.filter(parts, lambda t: t != F.lit(""))


def round_half_even(c: Column | str, digits: int) -> Column:
    """Python ``round(x, n)``: half-even on the binary value's exact decimal product.

    Where ``x * 10**n`` lands on a tie only because the product was rounded, the residual of the
    product (Veltkamp split; the scale has few bits, so both partial products are exact) decides.
    """
    scale = float(10**digits)

    def rounded(x: Column) -> Column:
        product = x * F.lit(scale)
        high = x * F.lit(134217729.0) - (x * F.lit(134217729.0) - x)
        residual = (high * F.lit(scale) - product) + (x - high) * F.lit(scale)
        low = F.floor(product).cast("double")
        tie = (product - low) == 0.5
        whole = F.when(tie & (residual > 0), low + 1).when(tie & (residual < 0), low).otherwise(F.rint(product))
        return whole / F.lit(scale)

    # bound by a lambda, so a costly input is worked out once
    return F.get(F.transform(F.array(col_(c).cast("double")), rounded), F.lit(0))


def py_float(c: Column | str) -> Column:
    """``float(text)`` for finite decimal text; null where Python would raise or give inf/nan."""
    s = py_strip(c)
    return F.when(s.rlike(PY_FLOAT_RE), F.regexp_replace(s, "_", "").try_cast("double"))


def signed_percent(c: Column | str, always_sign: bool = True) -> Column:
    """``f"+{v:.1%}"`` when v >= 0 else ``f"{v:.1%}"`` (rounded half-even first, then printed)."""
    v = round_half_even(col_(c) * F.lit(100.0), 1)
    text = F.format_string("%.1f%%", v)
    if not always_sign:
        return text
    return F.when(col_(c) >= 0, F.concat(F.lit("+"), text)).otherwise(text)


def percent(c: Column | str, digits: int = 1) -> Column:
    """``f"{v:.{digits}%}"``."""
    v = round_half_even(col_(c) * F.lit(100.0), digits)
    return F.format_string(f"%.{digits}f%%", v)


def fixed(c: Column | str, digits: int) -> Column:
    """``f"{v:.{digits}f}"`` with Python's half-even rounding."""
    return F.format_string(f"%.{digits}f", round_half_even(c, digits))


def float_text(d: Column) -> Column:
    """``repr(float)``: plain digits for exponents from -4 to 15, else ``1e+20`` / ``1.5e-07``."""
    s = F.abs(d).cast("string")
    mantissa, power = F.substring_index(s, "E", 1), F.substring_index(s, "E", -1).try_cast("int")
    digits = F.regexp_replace(F.replace(mantissa, F.lit("."), F.lit("")), "0+$", "")
    digits = F.when(digits == "", F.lit("0")).otherwise(digits)
    rest = F.substring(digits, F.lit(2), F.length(digits))
    scientific = F.concat(
        F.left(digits, F.lit(1)), F.when(rest == "", F.lit("")).otherwise(F.concat(F.lit("."), rest)),
        F.when(power < 0, F.lit("e-")).otherwise(F.lit("e+")), F.format_string("%02d", F.abs(power)),
    )
    after = F.substring(digits, power + 2, F.length(digits))
    whole = F.concat(F.rpad(F.left(digits, power + 1), power + 1, F.lit("0")), F.lit("."), F.when(after == "", F.lit("0")).otherwise(after))
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), digits)
    text = (
        F.when(s == "Infinity", F.lit("inf"))
        .when(F.instr(s, "E") == 0, s)
        .when((power >= 0) & (power < 16), whole)
        .when((power < 0) & (power >= -4), small)
        .otherwise(scientific)
    )
    return F.when(F.isnan(d), F.lit("nan")).otherwise(F.concat(F.when(d < 0, F.lit("-")).otherwise(F.lit("")), text))
