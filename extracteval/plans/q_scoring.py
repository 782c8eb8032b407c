"""Registered scoring / comparison queries over x_cases and x_outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from extracteval.operators import compare, score
from extracteval.plans import sqlparts as S
from extracteval.plans.registry import query
from extracteval.sources import fixtures as X


def _aligned(spark: SparkSession, sf: str) -> DataFrame:
    cases = X.x_cases(spark, sf)
    outputs = X.x_outputs(spark, sf, cases).select("label", "test_id", "output")
    return score.align_outputs_cases(outputs, cases)


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    return score.score_outputs(_aligned(spark, sf))


def _summary(spark: SparkSession, sf: str) -> DataFrame:
    return score.evaluate_outputs(_scored(spark, sf))


SCORED_SQL = S.with_(*S.SCORED_CTES)
SUMMARY_SQL = S.with_(*S.SCORED_CTES, S.SUMMARY_CTE)


@query("score_outputs", SCORED_SQL + """SELECT label, test_id, input_preview, valid_json, field_accuracy,
  format_compliance, output_preview, empty_expected_list FROM scored""")
def q_score_outputs(spark, sf):
    """A1: per-output validity, accuracy, compliance and previews."""
    return _scored(spark, sf)


@query("evaluate_outputs", SUMMARY_SQL + "SELECT * FROM summary")
def q_evaluate_outputs(spark, sf):
    """A5: one summary row per checkpoint."""
    return _summary(spark, sf)


def _outputs(spark: SparkSession, sf: str) -> DataFrame:
    return X.x_outputs(spark, sf).select("label", "test_id", "output")


@query("align_outputs_cases", S.with_(S.X_CASES, S.X_OUTPUTS, S.ALIGNED) + "SELECT label, test_id, output, input, expected FROM aligned")
def q_align(spark, sf):
    """Outputs paired with their cases by id."""
    return _aligned(spark, sf).select("label", "test_id", "output", "input", "expected")


J2_SQL = S.with_(S.X_CASES, S.X_OUTPUTS, "o AS (SELECT * FROM x_outputs WHERE output <> 'No structured data found.')") + """
SELECT l.label, c.test_id, 'no_output' AS problem
FROM x_cases c CROSS JOIN (SELECT DISTINCT label FROM o) l
WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.test_id = c.test_id AND o.label = l.label)
UNION ALL
SELECT o.label, o.test_id, 'no_case' AS problem FROM o WHERE NOT EXISTS (SELECT 1 FROM x_cases c WHERE c.test_id = o.test_id)"""


@query("alignment_mismatch", J2_SQL)
def q_alignment_mismatch(spark, sf):
    """Outputs that failed to come back (empty generations) show as unaligned cases."""
    cases = X.x_cases(spark, sf)
    outs = X.x_outputs(spark, sf, cases).where(F.col("output") != "No structured data found.")
    return score.alignment_mismatch(outs.select("label", "test_id", "output"), cases)


@query("pairwise_checkpoints", S.with_(*S.SCORED_CTES) + """SELECT test_id,
  max(CASE WHEN label = 'base_model' THEN field_accuracy END) AS base_model,
  max(CASE WHEN label = 'sft_model' THEN field_accuracy END) AS sft_model,
  max(CASE WHEN label = 'dpo_model' THEN field_accuracy END) AS dpo_model
FROM scored GROUP BY test_id""")
def q_pairwise(spark, sf):
    """Field accuracy of each test under every checkpoint, side by side."""
    return score.pairwise_checkpoints(_scored(spark, sf), ["base_model", "sft_model", "dpo_model"])


BREAKDOWN_SQL = S.with_(*S.SCORED_CTES)


@query("expected_vs_predicted_fields", BREAKDOWN_SQL + f"""SELECT label, test_id, key, rule,
  {S.py_text('ev')} AS expected_value, CASE WHEN pv IS NOT NULL THEN {S.py_text('pv')} END AS predicted_value,
  pv IS NOT NULL AS present FROM credits""")
def q_fields(spark, sf):
    """Every expected key with the predicted value found under it (case-sensitive keys)."""
    return score.field_breakdown(_aligned(spark, sf)).drop("credit")


@query("field_credit_breakdown", BREAKDOWN_SQL + "SELECT label, test_id, key, rule, credit FROM credits")
def q_breakdown(spark, sf):
    """Per-key credit rows."""
    return score.field_breakdown(_aligned(spark, sf)).select("label", "test_id", "key", "rule", "credit")


for _rule, _name, _doc in (("number", "match_number", "R5"), ("list", "match_list", "R6"), ("text", "match_text", "R7")):
    def _mk(rule=_rule, doc=_doc):
        def fn(spark, sf):
            b = score.field_breakdown(_aligned(spark, sf))
            return b.where(F.col("rule") == rule).select("label", "test_id", "key", "credit")
        fn.__doc__ = f"{doc}: credits of the {rule} rule."
        return fn
    query(_name, BREAKDOWN_SQL + f"SELECT label, test_id, key, credit FROM credits WHERE rule = '{_rule}'")(_mk())


@query("strip_fences", S.with_(S.X_CASES, S.X_OUTPUTS) + f"SELECT label, test_id, {S.fences('output')} AS cleaned FROM x_outputs")
def q_strip_fences(spark, sf):
    """Fences removed and text stripped."""
    from extracteval.functions.jsonx import strip_fences
    return _outputs(spark, sf).select("label", "test_id", strip_fences("output").alias("cleaned"))


@query("is_valid_json", S.with_(S.X_CASES, S.X_OUTPUTS) + f"SELECT label, test_id, json_valid({S.fences('output')}) AS valid_json FROM x_outputs")
def q_is_valid_json(spark, sf):
    """R2: the cleaned output is one JSON value."""
    from extracteval.functions.jsonx import json_validity
    return _outputs(spark, sf).select("label", "test_id", json_validity("output").alias("valid_json"))


@query("parse_json_safe", S.with_(S.X_CASES, S.X_OUTPUTS, "aligned AS (SELECT label, test_id, output, '' AS input, '{}' AS expected FROM x_outputs)", S.parsed_cte().split(",\nfields AS")[0]) + """
SELECT label, test_id, CAST(len(json_keys(pred)) AS BIGINT) AS n_keys, array_to_string(list_sort(json_keys(pred)), ',') AS keys FROM parsed""")
def q_parse_json_safe(spark, sf):
    """The parsed object's keys (empty object on any failure)."""
    from extracteval.functions.jsonx import as_object_map, parse_json_safe
    m = as_object_map(parse_json_safe("output"))
    keys = F.coalesce(F.array_sort(F.map_keys(m)), F.array().cast("array<string>"))
    return _outputs(spark, sf).select("label", "test_id", F.size(keys).cast("bigint").alias("n_keys"), F.array_join(keys, ",").alias("keys"))


@query("round_half_even", """SELECT l_orderkey, l_linenumber,
  round_even(l_extendedprice * l_discount / 1000.0, 3) AS r3, round_even(l_extendedprice * l_tax, 1) AS r1 FROM lineitem""")
def q_round(spark, sf):
    """Python round() at 3 and 1 dp over line-item amounts."""
    from extracteval.functions.pytext import round_half_even
    from extracteval.sources.tables import table
    li = table(spark, sf, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber",
        round_half_even(F.col("l_extendedprice") * F.col("l_discount") / F.lit(1000.0), 3).alias("r3"),
        round_half_even(F.col("l_extendedprice") * F.col("l_tax"), 1).alias("r1"),
    )


@query("field_accuracy", SCORED_SQL + "SELECT label, test_id, field_accuracy FROM scored")
def q_field_accuracy(spark, sf):
    """Per-output field accuracy."""
    return _scored(spark, sf).select("label", "test_id", "field_accuracy")


@query("format_compliance", S.with_(S.X_CASES, S.X_OUTPUTS) + f"SELECT label, test_id, {S.compliance('output')} AS format_compliance FROM x_outputs")
def q_format_compliance(spark, sf):
    """Only-JSON / JSON with extra text / no JSON."""
    from extracteval.functions.scoring import format_compliance
    return _outputs(spark, sf).select("label", "test_id", format_compliance("output").alias("format_compliance"))


@query("previews", S.with_(S.X_CASES, S.X_OUTPUTS, S.ALIGNED) + f"""SELECT label, test_id, concat(left(input, 60), '...') AS input_preview,
  {S.strip('left(output, 100)')} AS output_preview FROM aligned""")
def q_previews(spark, sf):
    """P5: input[:60] + '...' and output[:100].strip()."""
    return _scored(spark, sf).select("label", "test_id", "input_preview", "output_preview")


for _col, _name, _doc in (("valid_json_rate", "valid_json_rate", "A2"), ("field_accuracy", "avg_field_accuracy", "A3"),
                          ("format_compliance", "avg_format_compliance", "A4")):
    def _mk2(c=_col, doc=_doc):
        def fn(spark, sf):
            return _summary(spark, sf).select("label", c)
        fn.__doc__ = f"{doc}: per-checkpoint {c}."
        return fn
    query(_name, SUMMARY_SQL + f"SELECT label, {_col} FROM summary")(_mk2())


@query("improvement", SUMMARY_SQL + """SELECT
  round_even(a.valid_json_rate - b.valid_json_rate, 3) AS valid_json_improvement,
  round_even(a.field_accuracy - b.field_accuracy, 3) AS field_accuracy_improvement,
  round_even(a.format_compliance - b.format_compliance, 3) AS format_improvement,
  round_even(a.overall_score - b.overall_score, 3) AS overall_improvement
FROM summary a JOIN summary b ON a.label = 'sft_model' AND b.label = 'base_model'""")
def q_improvement(spark, sf):
    """After (sft_model) - before (base_model)."""
    return compare.improvement(_summary(spark, sf), "base_model", "sft_model")


STAGE_SQL = S.with_(*S.SCORED_CTES, S.SUMMARY_CTE, """long AS (
  UNPIVOT (SELECT label, valid_json_rate, field_accuracy, format_compliance, overall_score FROM summary)
  ON valid_json_rate, field_accuracy, format_compliance, overall_score INTO NAME metric VALUE v)""",
  """pairs AS (SELECT * FROM (VALUES ('sft_model', 'base_model', 'sft_vs_base'), ('dpo_model', 'sft_model', 'dpo_vs_sft'),
  ('dpo_model', 'base_model', 'dpo_vs_base')) p(a, b, delta))""",
  """deltas AS (SELECT p.delta, la.metric, round_even(la.v - lb.v, 3) AS value
  FROM pairs p JOIN long la ON la.label = p.a JOIN long lb ON lb.label = p.b AND lb.metric = la.metric)""")


@query("stage_deltas", STAGE_SQL + "SELECT delta, metric, value FROM deltas")
def q_stage_deltas(spark, sf):
    """Sft-base, dpo-sft, dpo-base for the four metrics."""
    return compare.stage_deltas(_summary(spark, sf))


@query("signed_percent", STAGE_SQL + "SELECT delta, metric, CASE WHEN value >= 0 THEN '+' ELSE '' END || printf('%.1f', value * 100) || '%' AS text FROM deltas")
def q_signed_percent(spark, sf):
    """Deltas printed as signed percentages."""
    from extracteval.functions.pytext import signed_percent
    d = compare.stage_deltas(_summary(spark, sf))
    return d.select("delta", "metric", signed_percent("value").alias("text"))


QUALITY_CTE = f"""toks AS (SELECT label, test_id, {S.split('output')} AS w, {S.split('lower(output)')} AS t FROM x_outputs),
qrows AS (SELECT label, CAST(len(w) AS BIGINT) AS len, {S.diversity_of()} AS div FROM (SELECT *, {S.grams()} AS g FROM toks)),
quality AS (SELECT label, round_even(avg(len), 1) AS avg_length_tokens,
  round_even(CAST(sum(CAST(div AS DECIMAL(4,3))) AS DOUBLE) / count(*), 3) AS avg_diversity_2g,
  min(len) AS min_length, max(len) AS max_length FROM qrows GROUP BY label)"""
QUALITY_SQL = S.with_(S.X_CASES, S.X_OUTPUTS, QUALITY_CTE)


@query("avg_length_diversity", QUALITY_SQL + "SELECT * FROM quality")
def q_quality(spark, sf):
    """Per checkpoint mean length, mean bigram diversity, min and max length."""
    return compare.output_quality(_outputs(spark, sf))


WIN_CTE = """w1 AS (SELECT s.test_id, s.field_accuracy AS sft_acc, d.field_accuracy AS dpo_acc,
  CASE WHEN d.field_accuracy > s.field_accuracy + 0.05 THEN 'win' WHEN d.field_accuracy < s.field_accuracy - 0.05 THEN 'loss' ELSE 'tie' END AS result
  FROM scored s JOIN scored d ON s.test_id = d.test_id AND s.label = 'sft_model' AND d.label = 'dpo_model')"""
W2_CTE = """w2 AS (SELECT CAST(count_if(result = 'win') AS BIGINT) AS wins, CAST(count_if(result = 'tie') AS BIGINT) AS ties,
  CAST(count_if(result = 'loss') AS BIGINT) AS losses, CAST(count(*) AS BIGINT) AS total,
  round_even(CAST(count_if(result = 'win') AS DOUBLE) / count(*), 3) AS win_rate FROM w1)"""


@query("win_tie_loss", S.with_(*S.SCORED_CTES, WIN_CTE) + "SELECT * FROM w1")
def q_w1(spark, sf):
    """dpo_model against sft_model per test (margin 0.05)."""
    return compare.win_tie_loss(_scored(spark, sf))


@query("win_rate", S.with_(*S.SCORED_CTES, WIN_CTE, W2_CTE) + "SELECT * FROM w2")
def q_w2(spark, sf):
    """Counts and win rate."""
    return compare.win_rate(compare.win_tie_loss(_scored(spark, sf)))


@query("win_report_summary", S.with_(*S.SCORED_CTES, WIN_CTE, W2_CTE, QUALITY_CTE) + """SELECT
  (SELECT win_rate FROM w2) AS dpo_win_rate,
  max(CASE WHEN label = 'dpo_model' THEN avg_length_tokens END) AS dpo_avg_length,
  max(CASE WHEN label = 'sft_model' THEN avg_length_tokens END) AS sft_avg_length,
  max(CASE WHEN label = 'dpo_model' THEN avg_diversity_2g END) AS dpo_diversity,
  max(CASE WHEN label = 'sft_model' THEN avg_diversity_2g END) AS sft_diversity FROM quality""")
def q_w3(spark, sf):
    """The five headline values of the preference report."""
    return compare.win_report_summary(compare.win_tie_loss(_scored(spark, sf)), compare.output_quality(_outputs(spark, sf)))


@query("length_direction", QUALITY_SQL + """SELECT sft_avg_length_tokens, dpo_avg_length_tokens,
  CASE WHEN dpo_avg_length_tokens < sft_avg_length_tokens THEN 'shorter' ELSE 'longer' END AS direction
FROM (SELECT max(CASE WHEN label = 'sft_model' THEN avg_length_tokens END) AS sft_avg_length_tokens,
  max(CASE WHEN label = 'dpo_model' THEN avg_length_tokens END) AS dpo_avg_length_tokens FROM quality)""")
def q_q3(spark, sf):
    """Q3: is the candidate's output shorter or longer on average."""
    return compare.length_direction(compare.output_quality(_outputs(spark, sf)))


@query("union_checkpoints", S.with_(S.X_CASES, S.X_OUTPUTS) + "SELECT label, test_id, output FROM x_outputs")
def q_union(spark, sf):
    """Per-checkpoint output tables combined with a label column."""
    outs = X.x_outputs(spark, sf)
    frames = {lab: outs.where(F.col("label") == lab).select("test_id", "output") for lab, _, _ in X.CHECKPOINTS}
    return score.union_checkpoints(frames)


@query("token_set_overlap", BREAKDOWN_SQL + f"""SELECT label, test_id, key,
  CAST(len({S.text_set('ev')}) AS BIGINT) AS n_expected,
  CAST(coalesce(len(CASE WHEN json_type(pv) = 'ARRAY' THEN {S.text_set('pv')} END), 0) AS BIGINT) AS n_predicted,
  CAST(coalesce(len(CASE WHEN json_type(pv) = 'ARRAY' THEN list_intersect({S.text_set('ev')}, {S.text_set('pv')}) END), 0) AS BIGINT) AS n_overlap
FROM credits WHERE rule = 'list'""")
def q_u2(spark, sf):
    """Expected / predicted / shared distinct texts of list-valued fields."""
    return score.list_overlap(_aligned(spark, sf))
