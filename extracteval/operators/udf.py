"""User-supplied Python: row predicates (D1) and batch generation.

Both run through Arrow batches (``pandas_udf`` / ``mapInPandas``); a built-in ``Column``
predicate skips Python entirely.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Predicate = Callable[[pd.DataFrame], pd.Series]
Generator = Callable[[list[str], int], list[str]]


def filter_callable(df: DataFrame, predicate: Column | Predicate, columns: Sequence[str] = ()) -> DataFrame:
    """Keep rows where the predicate holds; a Python predicate sees a pandas batch of ``columns``."""
    if isinstance(predicate, Column):
        return df.where(predicate)

    @F.pandas_udf(T.BooleanType())
    def keep(batch: pd.DataFrame) -> pd.Series:
        return predicate(batch).fillna(False).astype(bool)

    return df.where(keep(F.struct(*columns)))


def echo_generator(prompts: list[str], max_new: int) -> list[str]:
    """Test double for a model: the first ``max_new`` words of each prompt."""
    return [" ".join(p.split()[:max_new]).strip() for p in prompts]


def batch_generate(
    df: DataFrame,
    factory: Callable[[], Generator],
    prompt_col: str = "prompt",
    keys: Sequence[str] = ("test_id",),
    max_new: int = 256,
    out: str = "output",
) -> DataFrame:
    """A continuation per prompt from a user-supplied generator, loaded once per partition."""
    keys = list(keys)
    fields = [df.schema[k] for k in keys] + [T.StructField(out, T.StringType())]
    schema = T.StructType(fields)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gen = factory()
        for b in batches:
            res = b[keys].copy()
            res[out] = gen(b[prompt_col].tolist(), max_new)
            yield res

    return df.select(*keys, prompt_col).mapInPandas(run, schema)
