"""Readers and reports on real files: positions, untyped preferences, published reports."""

import json
import re
import uuid

import pytest
from pyspark.sql import functions as F

from extracteval.operators import compare, curate, prefnum, score
from extracteval.sinks import publish, reports
from extracteval.sources import fixtures as X
from extracteval.sources import readers as R

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def folder(tmp_path):
    return lambda name: str(tmp_path / f"{name}-{uuid.uuid4().hex}")


@pytest.fixture(scope="module")
def scored(spark):
    cases = X.x_cases(spark, SF)
    outputs = X.x_outputs(spark, SF, cases)
    done = score.score_outputs(score.align_outputs_cases(outputs, cases)).drop("empty_expected_list").persist()
    yield done, cases, outputs
    done.unpersist()


@pytest.mark.parametrize("split", ["150", "700", "128m"])
def test_two_files_without_ids_are_aligned_by_position(spark, tmp_path, split):
    n = 300
    cases = tmp_path / "cases.jsonl"
    cases.write_text("\n".join(json.dumps({"input": f"i{i}", "expected": "{}"}) + ("\n" if i % 7 == 3 else "") for i in range(n)) + "\n")
    outputs = tmp_path / "outputs"
    outputs.mkdir()
    for part in range(3):
        rows = [json.dumps({"output": f"o{i}"}) for i in range(part * 100, part * 100 + 100)]
        (outputs / f"part-{part:05d}.json").write_text("\n  \n".join(rows))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        paired = score.align_outputs_cases(R.scan_positioned_outputs(spark, str(outputs), "base"), R.scan_positioned_cases(spark, str(cases)))
        rows = sorted(paired.select("test_id", "input", "output").collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [tuple(r) for r in rows] == [(i + 1, f"i{i}", f"o{i}") for i in range(n)]


def test_numbering_moves_no_line(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x\ny\n")
    plan = R.numbered_lines(spark, str(tmp_path / "a.txt"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" in plan and "RepartitionByExpression" not in plan
    assert [tuple(r) for r in R.numbered_lines(spark, str(tmp_path / "a.txt")).orderBy("position").collect()] == [(1, "x"), (2, "y")]


@pytest.mark.parametrize("bad", ['{"a":1}x', '{"a":1} junk', "[1", "{'a':1}", '{"a":1,}'])
def test_malformed_lines_fail_in_every_reader(spark, tmp_path, bad):
    path = tmp_path / "lines.jsonl"
    path.write_text('{"pair_id": 1}\n' + bad + "\n")
    for scan in (
        R.scan_sft_jsonl_strict, R.scan_sft_jsonl_lenient, R.scan_test_cases, R.scan_positioned_cases,
        lambda s, p: R.scan_preference_pairs(s, p, "jsonl"), lambda s, p: R.scan_preference_pairs(s, p, "jsonl", "pair_id BIGINT"),
    ):
        with pytest.raises(Exception, match="malformed JSONL line"):
            scan(spark, str(path)).collect()


def test_blank_lines(spark, tmp_path):
    path = tmp_path / "lines.jsonl"
    path.write_text('{"input": "a"}\n  \n{"input": "b"}\n')
    assert [r.input for r in R.scan_sft_jsonl_lenient(spark, str(path)).collect()] == ["a", "b"]
    with pytest.raises(Exception, match="blank line"):
        R.scan_sft_jsonl_strict(spark, str(path)).collect()


def test_mixed_completions_pass_the_quality_filter(spark, tmp_path):
    chat = lambda *turns: [{"role": r, "content": c} for r, c in turns]
    rows = [
        {"pair_id": 1, "input": "q", "chosen": "text", "rejected": chat(("user", "u"), ("assistant", "r")), "chosen_score": 5},
        {"pair_id": 2, "prompt": "q", "chosen": chat(("assistant", "c")), "rejected": "x", "chosen_rating": "4.5", "rejected_rating": 2},
        {"pair_id": 3, "prompt": "q", "chosen": [], "rejected": "x", "chosen_rating": 4.5},
        {"pair_id": 4, "prompt": "q", "chosen": None, "rejected": "x", "chosen_rating": 4.5},
        {"pair_id": 5, "prompt": "q", "chosen": "a", "rejected": "x", "chosen_rating": 4.5, "rejected_rating": 4.5},
    ]
    path = tmp_path / "pairs.jsonl"
    path.write_text("\n".join(map(json.dumps, rows)))
    pairs = R.scan_preference_pairs(spark, str(path), "jsonl")
    kept = curate.format_pairs(curate.filter_pairs_quality(pairs)).orderBy("pair_id").collect()
    assert [tuple(r) for r in kept] == [("1", "q", "text", "r"), ("2", "q", "c", "x")]


def test_curation_counts_come_from_the_write(spark, folder):
    path = folder("curated")
    pairs = X.x_pairs(spark, SF)
    counts = curate.write_curated(pairs, path, 2)
    formatted = curate.format_pairs(curate.filter_pairs_quality(pairs))
    assert sorted(spark.read.parquet(path).collect()) == sorted(formatted.collect())
    n = formatted.count()
    assert counts == {"n_raw": pairs.count(), "n_filtered": curate.filter_pairs_quality(pairs).count(), "n_formatted": n, "n_sampled": min(2, n)}


def test_reports_with_side_tables_round_trip(spark, folder, scored):
    done, cases, outputs = scored
    summary = score.evaluate_outputs(done)
    k1, k2, k3, k5 = (folder(k) for k in ("k1", "k2", "k3", "k5"))
    publish.publish_before_after(summary, done, cases, k1, "base_model", "sft_model")
    publish.publish_three_stage(summary, done, k2, {"epochs": 1}, {"gpu": "unknown"})
    publish.publish_dpo_change(summary, done, k3, {"beta": 0.1})
    per_case = compare.win_tie_loss(done)
    publish.publish_preference(per_case, compare.output_quality(outputs), k5)
    n = cases.count()
    back = {k: publish.read_report(spark, k, verify=True) for k in (k1, k2, k3, k5)}
    assert {name: df.count() for name, df in back[k1].items()} == {"report": 1, "per_test": 2 * n, "test_prompts": n}
    assert back[k1]["report"].collect() == reports.report_before_after(summary, "base_model", "sft_model").collect()
    assert back[k2]["report"].collect() == reports.report_three_stage(summary, {"epochs": 1}, {"gpu": "unknown"}).collect()
    assert back[k2]["per_test"].count() == 3 * n and back[k3]["per_test"].count() == 2 * n
    assert sorted(back[k5]["per_case"].select("test_id", "sft_acc", "dpo_acc", "result").collect()) == sorted(per_case.collect())
    # wins, ties and losses are all cases
    stats = back[k5]["report"].select("win_rate_vs_sft.*").first()
    assert stats.wins + stats.ties + stats.losses == n
    # deltas of opposite pairs are each other's negative
    there, back_again = (compare.stage_deltas(summary, [(a, b, "d")]).collect() for a, b in (("sft_model", "base_model"), ("base_model", "sft_model")))
    assert {r.metric: r.value for r in there} == {r.metric: -r.value for r in back_again}
    # the two-step flow reads the stored rows
    columns = R.PER_TEST_COLUMNS
    stored = R.scan_metrics_report(spark, k2).select(*columns)
    assert sorted(stored.collect()) == sorted(done.where("label <> 'base_model'").select(*columns).collect())


def test_unfinished_and_missing_reports_are_refused(spark, folder, scored):
    done, cases, _ = scored
    path = folder("half")
    done.write.partitionBy("label").json(f"{path}/per_test")
    for read in (publish.read_report, R.scan_metrics_report):
        with pytest.raises(publish.UnfinishedReport):
            read(spark, path)
        with pytest.raises(FileNotFoundError):
            read(spark, path + "-nowhere")
    whole = folder("whole")
    publish.publish({"per_case": spark.range(5)}, whole, "k")
    with pytest.raises(FileExistsError):
        publish.publish({"per_case": spark.range(5)}, whole, "k")
    spark.range(2).write.mode("overwrite").json(f"{whole}/per_case")
    with pytest.raises(publish.UnfinishedReport):
        publish.read_report(spark, whole, verify=True)


def test_nested_report_with_other_members(spark, tmp_path):
    test = {"test_id": 1, "input_preview": "i...", "valid_json": True, "field_accuracy": 0.5, "format_compliance": 1.0, "output_preview": "{}"}
    path = tmp_path / "metrics.json"
    path.write_text(json.dumps({"test_prompts": ["p"], "note": "n", "sft_model": {"label": "s", "per_test": [test]}, "dpo_model": {"per_test": [test]}}, indent=2))
    rows = R.scan_metrics_report(spark, str(path)).collect()
    assert [(r.label, r.test_id, r.field_accuracy) for r in rows] == [("sft_model", 1, 0.5), ("dpo_model", 1, 0.5)]
    with pytest.raises(Exception, match="stage base_model is not in the report"):
        R.scan_metrics_report(spark, str(path), ("base_model",)).collect()


def test_held_out_cases_are_not_in_the_training_lines(spark, tmp_path):
    train = tmp_path / "train.jsonl"
    train.write_text("\n".join(json.dumps({"instruction": "x", "input": f"train {i}", "output": "{}"}) for i in range(5)))
    cases = X.x_cases(spark, SF)
    seen = cases.join(R.scan_sft_jsonl_strict(spark, str(train)).select("input"), "input", "left_semi")
    assert seen.count() == 0


def test_no_logits_cross_an_exchange(spark):
    for found in (prefnum.sequence_logprob, prefnum.logratios):
        plan = found(prefnum.token_logprobs(X.x_logits(spark, SF)))._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        )
        exchanges = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: (.*)", plan)
        assert exchanges and not any("logits" in x or "embedding" in x for x in exchanges)


def test_labels_are_the_next_tokens(spark):
    logged = X.x_logits(spark, SF)
    shifted = prefnum.with_labels(logged.select("pair_id", "side", "model", "pos", "token_id", "mask"))
    own = logged.where("label_id IS NOT NULL").select("pair_id", "side", "model", "pos", "label_id", "label_mask")
    assert sorted(shifted.collect()) == sorted(own.collect())


def test_sampling_selects_the_least_digests(spark):
    rows = spark.range(3000).select(F.col("id").alias("pair_id")).repartition(5)
    want = [r.pair_id for r in rows.withColumn("k", curate.shuffle_key(42)).orderBy("k").collect()]
    for n in (0, 1, 7, 999, 3000, 5000):
        got = curate.sample_pairs(rows, n).collect()
        assert sorted(r.pair_id for r in got) == sorted(want[:n])
    plan = curate.sample_pairs(rows, 7)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" not in plan
    # repeated ids are taken as often as needed, also when one id has most rows
    hot = spark.range(2000).select(F.when(F.col("id") < 1500, 1).otherwise(F.col("id")).alias("pair_id"))
    assert [curate.sample_pairs(hot, n).count() for n in (1, 600, 1999)] == [1, 600, 1999]
    assert curate.sample_pairs(rows.limit(0), 5).count() == 0


def test_markdown_lines_are_written_in_order(spark, folder, scored):
    done, _, _ = scored
    path = folder("table")
    table = reports.markdown_table(score.evaluate_outputs(done))
    reports.write_lines(table.repartition(3), path)
    lines = [r.value for r in spark.read.text(path).collect()]
    assert lines == [r.line for r in table.orderBy("line_no").collect()] and lines[0] == reports.MARKDOWN_HEADER
