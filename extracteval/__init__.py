"""Spark-native extraction scoring, checkpoint comparison and preference-data preparation.

Sub-packages:
  functions  column expressions (Python text semantics, JSON validity/parsing, field scoring)
  sources    table readers, derived test views, JSONL / report readers
  operators  DataFrame -> DataFrame operators (scoring, comparison, curation, encoding, numerics)
  sinks      report writers
  plans      the query registry used by ``__spark_entry__`` and the DuckDB oracle statements
  streaming  the same scoring applied to a file stream
"""

from extracteval.session import configure, get_spark, shared_dir

__all__ = ["configure", "get_spark", "shared_dir"]
