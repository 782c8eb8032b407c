"""Score model outputs as they land: file stream of (label, test_id, output) joined to the
static cases table, written to parquet with a checkpoint in the shared checkpoint folder.

The reference has no streaming source; this only shows the batch operators are stream-safe
(row-wise columns plus a stream-static equi-join, no state).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from extracteval.operators import score
from extracteval.session import shared_dir

OUTPUT_SCHEMA = "label STRING, test_id BIGINT, output STRING"


def scored_stream(spark: SparkSession, outputs_dir: str, cases: DataFrame) -> DataFrame:
    stream = spark.readStream.schema(OUTPUT_SCHEMA).json(outputs_dir)
    return score.score_outputs(score.align_outputs_cases(stream, cases))


def start_scoring(spark: SparkSession, outputs_dir: str, cases: DataFrame, sink_dir: str,
                  name: str = "scoring", once: bool = False) -> StreamingQuery:
    writer = (
        scored_stream(spark, outputs_dir, cases)
        .writeStream.format("parquet")
        .option("path", sink_dir)
        .option("checkpointLocation", shared_dir(spark, f"streams/{name}"))
        .outputMode("append")
    )
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()
