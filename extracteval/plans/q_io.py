"""Registered source, sink, report and UDF queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from extracteval.operators import compare, curate, prefnum, prompts, score, udf
from extracteval.operators.compare import IMPROVEMENT_KEYS, METRICS, STAGE_PAIRS
from extracteval.plans import sqlparts as S
from extracteval.plans.q_scoring import QUALITY_CTE, W2_CTE, WIN_CTE, _outputs, _scored, _summary
from extracteval.plans.q_tokens import LOGP
from extracteval.plans.q_curate import PROMPT, PROMPT_END
from extracteval.plans.registry import query
from extracteval.session import shared_dir
from extracteval.sinks import publish
from extracteval.sinks import reports as K
from extracteval.sources import fixtures as X
from extracteval.sources import readers as R


def _new_folder(spark, name):
    return shared_dir(spark, f"{name}-{uuid.uuid4().hex}")


def _kept(spark, name, df):
    """The rows of ``df``, worked out once for the tables of a report that are made from them."""
    path = _new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _sft_lines(spark, sf):
    c = X.x_cases(spark, sf)
    return c.select(F.to_json(F.struct(F.lit(prompts.INSTRUCTION).alias("instruction"), "input",
                                       F.col("expected").alias("output"))).alias("value"))


SFT_SQL = S.with_(S.X_CASES) + f"SELECT {S.lit(prompts.INSTRUCTION)} AS instruction, input, expected AS output FROM x_cases"


@query("scan_sft_jsonl_strict", SFT_SQL)
def q_s1(spark, sf):
    """The records of SFT JSONL lines made from the cases, parsed strictly."""
    return R.sft_records_strict(_sft_lines(spark, sf))


@query("scan_sft_jsonl_lenient", SFT_SQL)
def q_s2(spark, sf):
    """The same lines, each followed by a blank one, parsed leniently."""
    lines = _sft_lines(spark, sf).select(F.explode(F.array(F.col("value"), F.lit("  "))).alias("value"))
    return R.sft_records_lenient(lines)


@query("scan_preference_pairs", S.with_(S.X_PAIRS) + "SELECT * FROM x_pairs")
def q_s3(spark, sf):
    """S3: preference pairs parsed from JSON lines made from conversations."""
    pairs = X.x_pairs(spark, sf)
    return R.json_records(pairs.select(F.to_json(F.struct(*pairs.columns)).alias("value")), pairs.schema)


@query("scan_test_cases", S.with_(S.X_CASES) + "SELECT test_id, input, expected FROM x_cases")
def q_s4(spark, sf):
    """Test cases with explicit ids parsed from JSON lines."""
    cases = X.x_cases(spark, sf).select("test_id", "input", "expected")
    return R.json_records(cases.select(F.to_json(F.struct("*")).alias("value")), R.CASE_SCHEMA)


@query("scan_cases_by_position", S.with_(S.X_CASES) + """SELECT CAST(row_number() OVER (ORDER BY test_id) AS BIGINT) AS test_id, input, expected FROM x_cases""")
def q_s4_position(spark, sf):
    """Cases written as JSON lines without ids, read back with their position as identity."""
    cases = X.x_cases(spark, sf).orderBy("test_id")
    path = _new_folder(spark, "cases")
    cases.select(F.to_json(F.struct("input", "expected")).alias("value")).write.text(path)
    return R.scan_positioned_cases(spark, path)


@query("align_by_position", S.with_(S.X_CASES, S.X_OUTPUTS) + """SELECT 'sft_model' AS label, CAST(row_number() OVER (ORDER BY c.test_id) AS BIGINT) AS test_id, c.input, o.output
FROM x_cases c JOIN x_outputs o ON o.test_id = c.test_id AND o.label = 'sft_model'""")
def q_j1_position(spark, sf):
    """J1 by position: two files without ids, one with cases and one with outputs, each with a blank line
    after every record, are paired line by line."""
    cases = X.x_cases(spark, sf)
    outputs = X.x_outputs(spark, sf, cases).where("label = 'sft_model'")
    folders = []
    for name, rows, columns in (("cases", cases, ["input", "expected"]), ("outputs", outputs, ["output"])):
        folders.append(_new_folder(spark, name))
        line = F.concat(F.to_json(F.struct(*columns)), F.lit("\n"))
        rows.orderBy("test_id").select(line.alias("value")).write.text(folders[-1])
    paired = score.align_outputs_cases(R.scan_positioned_outputs(spark, folders[1], "sft_model"), R.scan_positioned_cases(spark, folders[0]))
    return paired.select("label", "test_id", "input", "output")


@query("scan_preference_mixed", S.with_(S.X_PAIRS, S.F1_CTE, S.F3_CTE) + """SELECT CAST(pair_id AS VARCHAR) AS pair_id, prompt_text AS prompt, chosen, rejected FROM f3""")
def q_s3_mixed(spark, sf):
    """S3 with F3, P9 and F5: preference lines whose completions are text in some rows and message
    lists in others."""
    pairs = X.x_pairs(spark, sf)
    said = lambda c: F.to_json(F.array(F.struct(F.lit("assistant").alias("role"), F.col(c).alias("content"))))
    rest = F.to_json(F.struct(*[c for c in pairs.columns if c not in ("chosen", "rejected")]))
    quoted = lambda c: F.regexp_replace(F.to_json(F.array(F.col(c))), r"^\[|\]\z", "")
    listed = F.col("pair_id") % 2 == 0
    sides = [F.concat(F.lit(f',"{c}":'), F.when(listed & (F.length(c) > 0), said(c)).otherwise(quoted(c))) for c in ("chosen", "rejected")]
    line = F.concat(F.left(rest, F.length(rest) - 1), *[F.when(F.col(c).isNotNull(), x).otherwise("") for c, x in zip(("chosen", "rejected"), sides)], F.lit("}"))
    return curate.format_pairs(curate.filter_pairs_quality(R.preference_records(pairs.select(line.alias("value")))))


@query("published_per_test", S.with_(*S.SCORED_CTES) + """SELECT label, test_id, input_preview, valid_json, field_accuracy,
  format_compliance, output_preview FROM scored WHERE label IN ('sft_model', 'dpo_model')""")
def q_k2_tables(spark, sf):
    """The three-stage report published with its per-test rows, two stages read back."""
    scored = _kept(spark, "scored", _scored(spark, sf).drop("empty_expected_list"))
    path = _new_folder(spark, "three-stage")
    publish.publish_three_stage(score.evaluate_outputs(scored), scored, path, TRAINING, HARDWARE)
    return R.scan_metrics_report(spark, path)


@query("published_prompts", S.with_(S.X_CASES) + f"""SELECT CAST(row_number() OVER (ORDER BY test_id) AS BIGINT) AS position, test_id,
  {PROMPT} || input || {PROMPT_END} AS prompt FROM x_cases""")
def q_k1_tables(spark, sf):
    """K1: the before/after report published with its per-test rows and prompts; the prompts read back."""
    cases, scored = X.x_cases(spark, sf), _kept(spark, "scored", _scored(spark, sf).drop("empty_expected_list"))
    path = _new_folder(spark, "before-after")
    publish.publish_before_after(score.evaluate_outputs(scored), scored, cases, path, "base_model", "sft_model")
    return publish.read_report(spark, path)["test_prompts"]


@query("published_per_case", S.with_(*S.SCORED_CTES, WIN_CTE) + "SELECT test_id, sft_acc, dpo_acc, result FROM w1")
def q_k5_tables(spark, sf):
    """K5: the preference report published with the row of every case; those read back."""
    per_case = _kept(spark, "per-case", compare.win_tie_loss(_scored(spark, sf)))
    path = _new_folder(spark, "preference")
    publish.publish_preference(per_case, compare.output_quality(_outputs(spark, sf)), path)
    return publish.read_report(spark, path)["per_case"].select("test_id", "sft_acc", "dpo_acc", "result")


@query("scan_metrics_report", S.with_(*S.SCORED_CTES) + """SELECT label, test_id, input_preview, valid_json, field_accuracy,
  format_compliance, output_preview FROM scored WHERE label IN ('sft_model', 'dpo_model')""")
def q_s5(spark, sf):
    """Per-test rows of two stages parsed from a report's per-test lines."""
    per = _scored(spark, sf).drop("empty_expected_list")
    return R.per_test_records(per.select(F.to_json(F.struct(*R.PER_TEST_COLUMNS)).alias("value")))


def _wide_sql(groups: dict[str, str]) -> str:
    cols = []
    for g, label in groups.items():
        cols += [f"max(CASE WHEN label = '{label}' THEN {c} END) AS {g}__{c}" for c in K.SUMMARY_FIELDS]
    return ", ".join(cols)


def _delta_sql(triples) -> str:
    return ", ".join(f"round_even({a}__{m} - {b}__{m}, 3) AS {n}__{m}" for a, b, n in triples for m in METRICS)


SUMMARY_SQL = S.with_(*S.SCORED_CTES, S.SUMMARY_CTE)
# Pass-through records of the three-stage report (values of the run being reported).
TRAINING = {"epochs": 1, "beta": 0.1}
HARDWARE = {"gpu": "unknown", "vram_gb": 0.0}


@query("report_before_after", SUMMARY_SQL + f"""SELECT *, {", ".join(f"round_even(after__{m} - before__{m}, 3) AS improvement__{k}" for m, k in zip(METRICS, IMPROVEMENT_KEYS))}
FROM (SELECT {_wide_sql({"before": "base_model", "after": "sft_model"})} FROM summary)""")
def q_k1(spark, sf):
    """K1: before/after report (flattened for display)."""
    return K.flatten(K.report_before_after(_summary(spark, sf), "base_model", "sft_model"))


@query("report_three_stage", SUMMARY_SQL + f"""SELECT *, {_delta_sql(STAGE_PAIRS)}, 1 AS training_config__epochs,
  CAST(0.1 AS DOUBLE) AS training_config__beta, 'unknown' AS hardware__gpu, CAST(0.0 AS DOUBLE) AS hardware__vram_gb
FROM (SELECT {_wide_sql({"base_model": "base_model", "sft_model": "sft_model", "dpo_model": "dpo_model"})} FROM summary)""")
def q_k2(spark, sf):
    """K2: three-stage report."""
    return K.flatten(K.report_three_stage(_summary(spark, sf), TRAINING, HARDWARE))


@query("report_dpo_change", SUMMARY_SQL + f"""SELECT *, {_delta_sql([("after_dpo", "before_dpo", "improvement")])},
  1 AS training_config__epochs, CAST(0.1 AS DOUBLE) AS training_config__beta
FROM (SELECT {_wide_sql({"before_dpo": "sft_model", "after_dpo": "dpo_model"})} FROM summary)""")
def q_k3(spark, sf):
    """K3: DPO change report."""
    return K.flatten(K.report_dpo_change(_summary(spark, sf), TRAINING))


DPO_CONFIG = {"epochs": 1, "beta": 0.1, "lr": 5e-5}


@query("report_dpo_run", LOGP + """SELECT pairs AS training_config__pairs, 1 AS training_config__epochs,
  CAST(0.1 AS DOUBLE) AS training_config__beta, CAST(5e-5 AS DOUBLE) AS training_config__lr,
  round_even(final_loss, 4) AS final_loss, CAST(0.0 AS DOUBLE) AS train_time_s, 'policy' AS model, 'local' AS hardware
FROM (SELECT round_even(avg(m), 4) AS final_loss, CAST(sum(n) AS BIGINT) AS pairs FROM (
  SELECT (rn - 1) // 2 AS b, avg(loss) AS m, count(*) AS n FROM (
    SELECT loss, row_number() OVER (ORDER BY md5('42:' || CAST(pair_id AS VARCHAR)), pair_id) AS rn FROM loss) GROUP BY b))""")
def q_k4(spark, sf):
    """K4: the preference run report from logged logits."""
    final = prefnum.mean_of_batch_means(prefnum.dpo_loss(prefnum.logratios(prefnum.token_logprobs(X.x_logits(spark, sf)))))
    return K.flatten(K.report_dpo_run(final, DPO_CONFIG, 0.0, "policy", "local"))


_Q = ("avg_length_tokens", "avg_diversity_2g", "min_length", "max_length")


@query("report_preference", S.with_(*S.SCORED_CTES, WIN_CTE, W2_CTE, QUALITY_CTE) + f"""SELECT
  (SELECT win_rate FROM w2) AS win_rate_vs_sft__win_rate, (SELECT wins FROM w2) AS win_rate_vs_sft__wins,
  (SELECT ties FROM w2) AS win_rate_vs_sft__ties, (SELECT losses FROM w2) AS win_rate_vs_sft__losses,
  'sft_model' AS output_quality__sft__label,
  {", ".join(f"max(CASE WHEN label = 'sft_model' THEN {c} END) AS output_quality__sft__{c}" for c in _Q)},
  'dpo_model' AS output_quality__dpo__label,
  {", ".join(f"max(CASE WHEN label = 'dpo_model' THEN {c} END) AS output_quality__dpo__{c}" for c in _Q)},
  (SELECT win_rate FROM w2) AS summary__dpo_win_rate,
  max(CASE WHEN label = 'dpo_model' THEN avg_length_tokens END) AS summary__dpo_avg_length,
  max(CASE WHEN label = 'sft_model' THEN avg_length_tokens END) AS summary__sft_avg_length,
  max(CASE WHEN label = 'dpo_model' THEN avg_diversity_2g END) AS summary__dpo_diversity,
  max(CASE WHEN label = 'sft_model' THEN avg_diversity_2g END) AS summary__sft_diversity FROM quality""")
def q_k5(spark, sf):
    """K5: preference report (win statistics, quality of both checkpoints, summary)."""
    per_case = compare.win_tie_loss(_scored(spark, sf))
    return K.flatten(K.report_preference(per_case, compare.output_quality(_outputs(spark, sf))))


def _pct(v: str, digits: int = 1) -> str:
    return f"printf('%.{digits}f', {v} * 100) || '%'"


def _sgn(v: str) -> str:
    return f"CASE WHEN {v} >= 0 THEN '+' ELSE '' END || {_pct(v)}"


def _k6_rows() -> str:
    rows = []
    for i, (m, title) in enumerate(K.SUMMARY_ROWS):
        show = (lambda v: f"printf('%.3f', {v})") if m == "overall_score" else _pct
        d1, d2, d3 = (f"round_even(sft__{m} - base__{m}, 3)", f"round_even(dpo__{m} - sft__{m}, 3)",
                      f"round_even(dpo__{m} - base__{m}, 3)")
        rows.append(f"SELECT {i} AS row_no, '{title}' AS metric, {show(f'base__{m}')} AS base, "
                    f"{show(f'sft__{m}')} || ' (' || {_sgn(d1)} || ')' AS sft, {show(f'dpo__{m}')} AS dpo, "
                    f"{_sgn(d2)} AS dpo_vs_sft, {_sgn(d3)} AS total FROM w")
    return "\nUNION ALL\n".join(rows)


@query("summary_table", S.with_(*S.SCORED_CTES, S.SUMMARY_CTE,
       f"w AS (SELECT {_wide_sql({'base': 'base_model', 'sft': 'sft_model', 'dpo': 'dpo_model'})} FROM summary)") + _k6_rows())
def q_k6(spark, sf):
    """K6: console summary table."""
    return K.summary_table(_summary(spark, sf))


def _k7_rows() -> str:
    rows = [f"SELECT 0 AS line_no, '{K.MARKDOWN_HEADER}' AS line",
            "SELECT 1, '|---|---|---|---|'"]
    for i, (m, title) in enumerate(K.SUMMARY_ROWS):
        imp = f"round_even(a__{m} - b__{m}, 3)"
        if m == "overall_score":
            text = (f"'| **{title}** | **' || printf('%.3f', b__{m}) || '** | **' || printf('%.3f', a__{m}) || "
                    f"'** | **+' || printf('%.3f', {imp}) || '** |'")
        else:
            text = (f"'| {title} | ' || {_pct(f'b__{m}', 0)} || ' | ' || {_pct(f'a__{m}', 0)} || ' | +' || "
                    f"{_pct(imp, 0)} || ' |'")
        rows.append(f"SELECT {i + 2}, {text} FROM w")
    return "\nUNION ALL\n".join(rows)


@query("markdown_table", S.with_(*S.SCORED_CTES, S.SUMMARY_CTE,
       f"w AS (SELECT {_wide_sql({'b': 'base_model', 'a': 'sft_model'})} FROM summary)") + _k7_rows())
def q_k7(spark, sf):
    """K7: README markdown table lines."""
    return K.markdown_table(_summary(spark, sf))


@query("filter_callable", S.with_(S.X_PAIRS) + "SELECT pair_id, prompt FROM x_pairs WHERE length(prompt) > 200")
def q_d1(spark, sf):
    """A user-supplied Python predicate (prompt longer than 200 characters) via Arrow."""
    pairs = X.x_pairs(spark, sf)
    return udf.filter_callable(pairs, lambda b: b["prompt"].str.len() > 200, ["prompt"]).select("pair_id", "prompt")


