"""Corpus pipeline: toxicity, near-duplicates, decontamination, personal data, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; its result is
written as Parquet and read again as the next stage's ``docs``.  All but the last return the
columns of ``documents``; other columns are left behind.

Defined results: null and empty texts are never toxic and hold no benchmark item or personal data;
they share fingerprint zero, so the near-duplicate stage keeps one of them; a null text stays null;
rows that repeat a doc_id within one group are one document; an empty table passes through and
packs to no row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from extracteval.llm.common import DOCUMENT_COLUMNS, drop_scratch, pick, read, scratch_mark, shared_folder
from extracteval.llm.decontamination import keep_uncontaminated
from extracteval.llm.packing import pack_documents
from extracteval.llm.pii import redact
from extracteval.llm.queries import WORD_BPE
from extracteval.llm.simhash import keep_one_of_each
from extracteval.llm.toxicity import keep_clean


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents with a score of 0.5 or more go."""
    return keep_clean(pick(docs, DOCUMENT_COLUMNS), read(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: one document of each group stays, the one with the least doc_id."""
    return keep_one_of_each(pick(docs, DOCUMENT_COLUMNS))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents that hold a benchmark item go."""
    return keep_uncontaminated(pick(docs, DOCUMENT_COLUMNS), read(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: every span is replaced by its kind in brackets; n_chars is counted anew."""
    return redact(pick(docs, DOCUMENT_COLUMNS))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: places of all remaining documents' pieces in sequences of 4096 tokens."""
    return pack_documents(pick(docs, DOCUMENT_COLUMNS), WORD_BPE)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("best_fit_packing", best_fit_packing),
]

# A learned toxicity score and iterated pattern scores have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        mark = scratch_mark()
        result = stage(spark, docs, sf_dir)
        path = shared_folder(spark, f"pipeline-{name}")
        result.write.parquet(path)
        drop_scratch(spark, mark)  # the stage's result is written
        docs = spark.read.schema(result.schema).parquet(path)
    return docs
