"""File sources: SFT JSONL (strict and lenient), preference pairs, test cases, metric reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from extracteval.functions.jsonx import is_valid_json, numbers_for_names
from extracteval.functions.pytext import py_strip
from extracteval.operators.curate import CHOSEN_SCORE_NAMES, PROMPT_NAMES, REJECTED_SCORE_NAMES
from extracteval.sinks.publish import published, read_report, report_exists

SFT_SCHEMA = "instruction STRING, input STRING, output STRING"
CASE_SCHEMA = "test_id BIGINT, input STRING, expected STRING"
PER_TEST_SCHEMA = (
    "label STRING, test_id BIGINT, input_preview STRING, valid_json BOOLEAN, field_accuracy DOUBLE, "
    "format_compliance DOUBLE, output_preview STRING"
)


PREFERENCE_FIELDS = ("pair_id", *CHOSEN_SCORE_NAMES, *REJECTED_SCORE_NAMES, *PROMPT_NAMES, "chosen", "rejected")
PER_TEST_COLUMNS = [f.split()[0] for f in PER_TEST_SCHEMA.split(", ")]


def _checked(line: Column) -> Column:
    """The line itself; one that is not a single JSON value (trailing text, say) fails the job."""
    bad = F.raise_error(F.concat(F.lit("malformed JSONL line: "), F.left(line, F.lit(80))))
    return F.when(is_valid_json(line), line).otherwise(bad)


def json_records(lines: DataFrame, schema: str | StructType, keep: Sequence[str] = ()) -> DataFrame:
    """Lines (``value``) -> records, after the columns ``keep``; a malformed line fails the job."""
    # a generator parses each line once, however many fields are read
    record = F.from_json(_checked(F.col("value")), schema, {"mode": "FAILFAST"})
    return lines.select(*keep, F.inline(F.array(record)))


def sft_records_strict(lines: DataFrame, schema: str = SFT_SCHEMA) -> DataFrame:
    """S1 on lines: one JSON object a line after stripping; a blank or malformed line fails."""
    line = py_strip(F.col("value"))
    blank = F.raise_error(F.lit("blank line in JSONL source"))
    return json_records(lines.select(F.when(F.length(line) == 0, blank).otherwise(line).alias("value")), schema)


def sft_records_lenient(lines: DataFrame, schema: str = SFT_SCHEMA) -> DataFrame:
    """S2 on lines: blank lines skipped; a malformed line still fails the job."""
    return json_records(lines.where(F.length(py_strip(F.col("value"))) > 0), schema)


def per_test_records(lines: DataFrame, labels: tuple[str, ...] = ("sft_model", "dpo_model")) -> DataFrame:
    """S5 on lines: per-test rows of the given stages."""
    return json_records(lines, PER_TEST_SCHEMA).where(F.col("label").isin(*labels))


def scan_sft_jsonl_strict(spark: SparkSession, path: str, schema: str = SFT_SCHEMA) -> DataFrame:
    """A path of JSONL, strictly."""
    return sft_records_strict(spark.read.text(path), schema)


def scan_sft_jsonl_lenient(spark: SparkSession, path: str, schema: str = SFT_SCHEMA) -> DataFrame:
    """A path of JSONL, leniently."""
    return sft_records_lenient(spark.read.text(path), schema)


def preference_records(lines: DataFrame) -> DataFrame:
    """S3 on lines whose fields may be text in one row and a message list in the next.

    Columns are those of ``PREFERENCE_FIELDS``: scores and prompts as text, ``chosen`` and ``rejected`` as VARIANT;
    an absent field is null.  Blank lines are skipped; a malformed line fails the job.
    """
    line = lines.where(F.length(py_strip(F.col("value"))) > 0)
    # the names for NaN and infinities, which JSON lines may hold, are put as numbers as everywhere else; a
    # generator parses each line once, whatever filters follow
    v = line.select(F.explode(F.array(F.parse_json(numbers_for_names(_checked(F.col("value")))))).alias("v"))
    kinds = {c: "variant" if c in ("chosen", "rejected") else "string" for c in PREFERENCE_FIELDS}
    return v.select(*[F.try_variant_get("v", f"$.{c}", kind).alias(c) for c, kind in kinds.items()])


def scan_preference_pairs(spark: SparkSession, path: str, fmt: str = "parquet", schema: str | None = None) -> DataFrame:
    """S3: a preference-pair table from a user path (parquet / json / jsonl).

    JSON is read with ``schema`` where one is given, otherwise as ``preference_records``; a malformed line fails.
    """
    if fmt in ("json", "jsonl"):
        lines = spark.read.text(path)
        return json_records(lines.where(F.length(py_strip(F.col("value"))) > 0), schema) if schema else preference_records(lines)
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema else reader).load(path)


def scan_test_cases(spark: SparkSession, path: str) -> DataFrame:
    """Test cases that carry their ``test_id``."""
    return json_records(spark.read.text(path), CASE_SCHEMA)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(position, value): the non-blank lines of the files at ``path``, numbered from 1 in file order.

    A line's number is the number of lines before its split of the file plus its place in the split,
    so no line is moved: rows are numbered where they are read, and only the splits' sizes (one row for each) are
    summed up.  Files follow each other by name, as a sorted table is written.  Compressed files
    are one split each.  The files must not change between planning and reading, which is checked.
    """
    held = spark.read.text(path).where(F.length(py_strip(F.col("value"))) > 0)
    rows = held.select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("row"),
    )
    splits = rows.groupBy("file", "split").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n"))
    # a file has one row for each split, a path one for each file, as the session lists them anyway
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    in_file = splits.select("file", "split", "first", "n", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = splits.groupBy("file").agg(F.sum("n").alias("lines"))
    files = files.select("file", F.coalesce(F.sum("lines").over(before), F.lit(0)).alias("offset"))
    place = in_file.join(files, "file").select("file", "split", "first", "n", (F.col("before") + F.col("offset")).alias("offset"))
    inside = F.col("row") - F.col("first")
    position = F.when((inside >= 0) & (inside < F.col("n")), F.col("offset") + inside + 1)
    moved = F.raise_error(F.lit("files changed while their lines were numbered"))
    return rows.join(place, ["file", "split"]).select(F.coalesce(position, moved.cast("bigint")).alias("position"), "value")


def scan_positioned(spark: SparkSession, path: str, schema: str | StructType, position: str = "test_id") -> DataFrame:
    """Records of id-less JSON lines with their position (from 1) as ``position``; blank lines take none."""
    lines = numbered_lines(spark, path).withColumnRenamed("position", position)
    return json_records(lines, schema, [position])


def scan_positioned_cases(spark: SparkSession, path: str) -> DataFrame:
    """S4 where the position in the file is the identity: test_id, input, expected."""
    return scan_positioned(spark, path, "input STRING, expected STRING")


def scan_positioned_outputs(spark: SparkSession, path: str, label: str) -> DataFrame:
    """Outputs of one checkpoint by position: (label, test_id, output), ready for J1."""
    rows = scan_positioned(spark, path, "output STRING")
    return rows.select(F.lit(label).alias("label"), "test_id", "output")


def scan_metrics_report(spark: SparkSession, path: str, labels: tuple[str, ...] = ("sft_model", "dpo_model")) -> DataFrame:
    """Per-test rows of the given stages from a stored report.

    ``path`` is a folder that ``sinks.publish`` wrote (only the requested stages' partitions are read) or one nested
    report: a JSON document with an object for each stage that holds a ``per_test`` list, beside any
    other members.  Such a document is a report on a small evaluation set and is parsed as one value.
    A path that is not there, an unfinished report and a stage that is not in the report raise with a message.
    """
    if not report_exists(spark, path):
        raise FileNotFoundError(f"report not found at {path}; write it with sinks.publish first")
    if published(spark, path):
        report = read_report(spark, path)
        if "per_test" not in report:
            raise ValueError(f"the report at {path} holds no per-test rows")
        per = report["per_test"].where(F.col("label").isin(*labels))
        return per.select(*PER_TEST_COLUMNS)
    document = spark.read.text(path, wholetext=True)
    test = "array<struct<" + ", ".join(f.replace(" ", ":") for f in PER_TEST_SCHEMA.split(", ")[1:]) + ">>"
    whole = document.select(F.parse_json(numbers_for_names(_checked(F.col("value")))).alias("v"))
    stage = lambda label: F.coalesce(
        F.variant_get("v", f'$["{label}"].per_test', test),
        F.raise_error(F.lit(f"stage {label} is not in the report at {path}")).cast(test),
    )
    stages = F.array(*[F.struct(F.lit(label).alias("label"), stage(label).alias("tests")) for label in labels])
    return whole.select(F.inline(stages)).select("label", F.inline("tests")).select(*PER_TEST_COLUMNS)
