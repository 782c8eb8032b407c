"""Exact ordinals and running sums that never put a whole key group into one task.

``row_number() over (partition by run order by step)`` sorts every run in a single task; with
one run holding a third of the data that task holds a third of the data.  Here the order key is
cut into ``levels``, each a refinement of the one before and all monotone in the order (16 bits of
a number at a time, or four hex digits of a digest).  Rows are ranked inside their finest level;
level totals are prefix-summed inside their parent, so a window holds at most 65,536 children of
one parent (or the rows of one finest bucket), whatever the ids look like.  Totals come from the
ranked frame, so the input is shuffled once.  Null keys and null order values form groups of
their own (nulls first), and no row is lost.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def radix_levels(order_col: str) -> list[Column]:
    """Sixteen bits more at each level; a bucket of the last level spans 65,536 ids."""
    c = F.col(order_col).cast("bigint")
    return [F.shiftright(c, 48), F.shiftright(c, 32), F.shiftright(c, 16)]


def hex_levels(digest_col: str) -> list[Column]:
    """Four and eight leading characters of a lower-case hex digest."""
    return [F.substring(F.col(digest_col), 1, 4), F.substring(F.col(digest_col), 1, 8)]


def _join(left: DataFrame, right: DataFrame, keys: Sequence[str], levels: Sequence[str]) -> DataFrame:
    """Inner equi-join on ``keys`` (null-safe) and ``levels`` (never null), kept once.

    Plain equality lets the side that is partitioned and sorted for its window stay where it is.
    """
    cols = [*keys, *levels]
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in cols})
    same = [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in keys] + [F.col(c) == F.col(f"_r_{c}") for c in levels]
    return left.join(renamed, reduce(lambda a, b: a & b, same)).drop(*[f"_r_{c}" for c in cols])


def _never_null(level: Column, kind: T.DataType) -> Column:
    """The level with null as a value of its own before all others."""
    return F.coalesce(level, F.lit("") if isinstance(kind, T.StringType) else F.lit(-(1 << 62)).cast("bigint"))


def ordinal_within(
    df: DataFrame,
    keys: Sequence[str],
    order: str | Sequence[str],
    out: str,
    levels: Sequence[Column] | None = None,
    running: Sequence[str] = (),
) -> DataFrame:
    """Add ``out`` = 1-based position of each row in ``order`` inside ``keys``.

    ``running`` names numeric columns that also get ``<name>_cum`` (inclusive running sum).
    ``levels`` must be monotone along ``order``, each refining the one before; default: radix
    levels of ``order[0]``.  The order of rows that tie in ``order`` is not defined.
    """
    order = [order] if isinstance(order, str) else list(order)
    keys, levels = list(keys), list(levels if levels is not None else radix_levels(order[0]))
    names = [f"_lvl{k}" for k in range(len(levels))]
    raw = df.withColumns(dict(zip(names, levels)))
    t = raw.withColumns({c: _never_null(F.col(c), raw.schema[c].dataType) for c in names})
    part = keys + names
    inner = Window.partitionBy(*part).orderBy(*[F.col(c) for c in order]).rowsBetween(Window.unboundedPreceding, 0)
    t = t.withColumn("_pos", F.count(F.lit(1)).over(inner))
    for r in running:
        t = t.withColumn(f"_{r}_in", F.sum(r).over(inner))

    sums = ["_n"] + [f"_{r}_tot" for r in running]
    tables = [t.groupBy(*part).agg(F.count(F.lit(1)).alias("_n"), *[F.sum(r).alias(f"_{r}_tot") for r in running])]
    for k in range(len(names) - 1, 0, -1):
        tables.append(tables[-1].groupBy(*keys, *names[:k]).agg(*[F.sum(s).alias(s) for s in sums]))
    offs = None
    for k, table in enumerate(reversed(tables), 1):
        parent = keys + names[: k - 1]
        before = Window.partitionBy(*parent).orderBy(names[k - 1]).rowsBetween(Window.unboundedPreceding, -1)
        here = table.select(*parent, names[k - 1], *[F.coalesce(F.sum(s).over(before), F.lit(0)).alias(f"{s}_b") for s in sums])
        if offs is not None:
            here = _join(here, offs.withColumnsRenamed({f"{s}_b": f"{s}_up" for s in sums}), keys, names[: k - 1])
            here = here.select(*parent, names[k - 1], *[(F.col(f"{s}_b") + F.col(f"{s}_up")).alias(f"{s}_b") for s in sums])
        offs = here
    j = _join(t, offs, keys, names)
    j = j.withColumn(out, (F.col("_n_b") + F.col("_pos")).cast("bigint"))
    for r in running:
        j = j.withColumn(f"{r}_cum", F.col(f"_{r}_tot_b") + F.col(f"_{r}_in"))
    return j.drop(*names, "_pos", *[f"{s}_b" for s in sums], *[f"_{r}_in" for r in running])


def least_by_digest(df: DataFrame, n: int, digest: str, tie: str) -> DataFrame:
    """The ``n`` rows with the least lower-case hex ``digest`` (ties: least ``tie``), by radix selection.

    A histogram over the digest's four leading digits, at most 65,536 counts, finds the digits of the
    n-th row.  All rows below are kept by a filter where they are, and only the rows that share those digits (a
    65,536th of all) are ranked, by the levelled scan.  No task takes n rows.
    """
    keyed = df.withColumn("_lead", F.left(digest, F.lit(4)))
    counts = keyed.groupBy("_lead").agg(F.count(F.lit(1)).alias("k"))
    upto = F.sum("k").over(Window.orderBy("_lead").rowsBetween(Window.unboundedPreceding, 0))
    runs = counts.select("_lead", (upto - F.col("k")).alias("before")).where(F.col("before") < n)
    cut = runs.agg(F.max(F.struct("_lead", "before")).alias("cut")).scalar()
    edge = keyed.where(F.col("_lead") == cut["_lead"]).withColumn("_row", F.monotonically_increasing_id())
    # repeated ties are dealt out by where they were read, so that no window holds them all
    levels = [F.left(digest, F.lit(8)), F.col(digest), F.shiftright("_row", 33), F.shiftright("_row", 16)]
    ranked = ordinal_within(edge, [], [digest, tie, "_row"], "_ord", levels=levels)
    last = ranked.where(F.col("_ord") + cut["before"] <= n).drop("_row", "_ord")
    return keyed.where(F.col("_lead") < cut["_lead"]).unionByName(last).drop("_lead")
