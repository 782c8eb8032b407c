"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import contextlib
import uuid
from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from extracteval.session import shared_dir, ship_package

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

# Whole texts travel to Python in small batches so a run of very long texts stays bounded.
ARROW_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
}


def prepare(spark: SparkSession) -> SparkSession:
    ship_package(spark)
    for key, value in ARROW_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name under the folder that all machines of the cluster reach."""
    return shared_dir(spark, f"{name}-{uuid.uuid4().hex}")


_scratch: list[str] = []


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: work done once, lineage cut.

    The folder goes when the session ends, or with ``drop_scratch``.
    """
    spark = df.sparkSession
    path = shared_folder(spark, name)
    if not _scratch:
        atexit.register(drop_scratch, spark)
    _scratch.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch_mark() -> int:
    """Where ``drop_scratch`` can start later to delete what is stored from now on."""
    return len(_scratch)


def drop_scratch(spark: SparkSession, mark: int = 0) -> None:
    """Delete what ``stored`` wrote since ``mark``; only for results that have been written themselves."""
    with contextlib.suppress(Exception):  # the session may have ended
        conf = spark._jsparkSession.sessionState().newHadoopConf()
        while len(_scratch) > mark:
            place = spark._jvm.org.apache.hadoop.fs.Path(_scratch.pop())
            place.getFileSystem(conf).delete(place, True)


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(column), F.lit(""))


def id_text(column: str = "doc_id"):
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def held_out(column: str = "doc_id"):
    """True where crc32(doc_id as text) mod 5 is 0 (a null id counts as empty text)."""
    return F.crc32(F.encode(id_text(column), "UTF-8")) % 5 == 0


def pick(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Just the named columns, so columns that share a name with an operator's own never clash."""
    return df.select(*[df[n] for n in names])
