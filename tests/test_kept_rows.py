"""Report rows are worked out once for all tables of a report."""

from extracteval.plans import q_io


def test_report_rows_are_kept_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(q_io, "_new_folder", lambda s, name: f"{tmp_path}/{name}")
    kept = q_io._kept(spark, "scored", spark.range(5))
    assert sorted(r.id for r in kept.collect()) == [0, 1, 2, 3, 4] and len(kept.inputFiles()) > 0
