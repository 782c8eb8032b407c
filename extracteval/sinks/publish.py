"""Reports of several tables, made valid by a manifest that is written last.

A report is a new folder with one table a name (``report``, ``per_test``, ``per_case``,
``test_prompts``) and ``manifest``: one JSON row for each table with its schema and row count.
A run that ends early leaves a folder without a manifest, which readers refuse.
Row counts are observed while the tables are written, so they cost no pass of their own.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from extracteval.operators.prompts import test_prompts
from extracteval.sinks import reports

MANIFEST = "manifest"
MANIFEST_SCHEMA = "kind STRING, name STRING, ddl STRING, partition STRING, row_count BIGINT"
# Tables that are split by a column, so readers of one stage skip the others.
PARTITIONS = {"per_test": "label"}


class UnfinishedReport(ValueError):
    """A report folder whose manifest was never written, or that has lost rows since."""


def _status(spark: SparkSession, path: str) -> tuple[bool, list[str]]:
    """Whether ``path`` exists, and the names of the folders in it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not files.exists(place):
        return False, []
    if not files.getFileStatus(place).isDirectory():
        return True, []
    return True, [s.getPath().getName() for s in files.listStatus(place) if s.isDirectory()]


def report_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is anything at ``path``."""
    return _status(spark, path.rstrip("/"))[0]


def publish(tables: Mapping[str, DataFrame], path: str, kind: str) -> None:
    """Write ``tables`` to the new folder ``path`` and then its manifest; an existing folder raises."""
    spark = next(iter(tables.values())).sparkSession
    path = path.rstrip("/")
    if _status(spark, path)[0]:
        raise FileExistsError(f"{path} exists; a report is written to a new folder")
    rows = []
    for name, table in tables.items():
        seen, split = Observation(), PARTITIONS.get(name)
        counted = table.observe(seen, F.count(F.lit(1)).alias("n"))
        writer = counted.coalesce(1).write if name == "report" else counted.write
        (writer.partitionBy(split) if split else writer).json(f"{path}/{name}")
        rows.append((kind, name, table.schema.toDDL(), split, seen.get["n"]))
    spark.createDataFrame(rows, MANIFEST_SCHEMA).coalesce(1).write.json(f"{path}/{MANIFEST}")


def published(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is a finished report; a folder of tables without a manifest raises."""
    there, folders = _status(spark, path.rstrip("/"))
    if not there or not folders:
        return False
    if MANIFEST not in folders or not _status(spark, f"{path.rstrip('/')}/{MANIFEST}/_SUCCESS")[0]:
        raise UnfinishedReport(f"the report at {path} was never finished: it has no manifest")
    return True


def read_report(spark: SparkSession, path: str, verify: bool = False) -> dict[str, DataFrame]:
    """The tables of a finished report by name, each with the schema it was written with.

    ``verify`` also counts the rows and raises where they differ from the manifest.
    """
    path = path.rstrip("/")
    if not published(spark, path):
        raise FileNotFoundError(f"report not found at {path}; write it with sinks.publish first")
    # one row for each table of the report
    tables, lost = {}, []
    for row in spark.read.schema(MANIFEST_SCHEMA).json(f"{path}/{MANIFEST}").collect():
        tables[row.name] = spark.read.schema(row.ddl).json(f"{path}/{row.name}")
        if verify and tables[row.name].count() != row.row_count:
            lost.append(row.name)
    if lost:
        raise UnfinishedReport(f"the report at {path} has not all rows of {', '.join(sorted(lost))}")
    return tables


def _per_test(scored: DataFrame, *labels: str) -> DataFrame:
    return scored.where(F.col("label").isin(*labels))


def publish_before_after(summary: DataFrame, scored: DataFrame, cases: DataFrame, path: str, before: str, after: str) -> None:
    """K1 with its per-test rows and the test prompts in order."""
    report = reports.report_before_after(summary, before, after)
    publish({"report": report, "per_test": _per_test(scored, before, after), "test_prompts": test_prompts(cases)}, path, "before_after")


def publish_three_stage(summary: DataFrame, scored: DataFrame, path: str, training: dict, hardware: dict) -> None:
    """K2 with the per-test rows of its three stages."""
    report = reports.report_three_stage(summary, training, hardware)
    publish({"report": report, "per_test": _per_test(scored, *reports.STAGES)}, path, "three_stage")


def publish_dpo_change(summary: DataFrame, scored: DataFrame, path: str, training: dict) -> None:
    """K3 with the per-test rows of its two stages."""
    report = reports.report_dpo_change(summary, training)
    publish({"report": report, "per_test": _per_test(scored, "sft_model", "dpo_model")}, path, "dpo_change")


def publish_dpo_run(report: DataFrame, path: str) -> None:
    """K4, which has one table."""
    publish({"report": report}, path, "dpo_run")


def publish_preference(per_case: DataFrame, quality: DataFrame, path: str) -> None:
    """K5 with the row of every case."""
    publish({"report": reports.report_preference(per_case, quality), "per_case": per_case}, path, "preference")
