"""The registered queries: name -> (spark, sf_dir) -> DataFrame, and name -> DuckDB SQL.

Every query reads the given parquet tables (or views Spark derives from them) in full.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from extracteval.session import configure

QueryFn = Callable[[SparkSession, str], DataFrame]

def exact_round(sql: str) -> str:
    """``round_even(x, n)`` as a cast of the printed number: DuckDB prints the binary value exactly,
    so the oracle rounds as Python does without multiplying first."""
    mark = "round_even("
    while (at := sql.find(mark)) >= 0:
        depth, cut, end = 1, -1, at + len(mark)
        while depth:
            c = sql[end]
            depth += (c == "(") - (c == ")")
            if c == "," and depth == 1:
                cut = end
            end += 1
        value, digits = sql[at + len(mark) : cut], sql[cut + 1 : end - 1].strip()
        sql = f"{sql[:at]}CAST(printf('%.{digits}f', CAST({value} AS DOUBLE)) AS DOUBLE){sql[end:]}"
    return sql


QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(spark, sf_dir)

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = exact_round(sql)
        return run

    return deco


def _load() -> None:
    # Importing the query modules fills the registry.
    from extracteval.plans import q_curate, q_io, q_scoring, q_tokens  # noqa: F401


def queries() -> dict[str, QueryFn]:
    _load()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(ORACLE)
