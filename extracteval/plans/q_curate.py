"""Registered curation, sampling, batching and prompt-shaping queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from extracteval.operators import curate, prompts
from extracteval.plans import sqlparts as S
from extracteval.plans.registry import query
from extracteval.sources import fixtures as X
from extracteval.sources.tables import table

PAIRS = S.with_(S.X_PAIRS, S.F1_CTE, S.F3_CTE, S.F4_CTE)
SAMPLE_N = 50
T1_CTE = f"""t1 AS (SELECT * FROM f3 ORDER BY md5('42:' || CAST(pair_id AS VARCHAR)), pair_id LIMIT {SAMPLE_N})"""
T2_CTE = """t2 AS (SELECT pair_id, CAST(row_number() OVER (ORDER BY md5('42:' || CAST(pair_id AS VARCHAR)), pair_id) AS BIGINT) AS position
  FROM f3)"""


@query("coalesce_fields", PAIRS + "SELECT pair_id, chosen_value, prompt_text, rejected_value FROM f1")
def q_f1(spark, sf):
    """first non-null of the alternative field names."""
    return curate.coalesce_fields(X.x_pairs(spark, sf)).select("pair_id", "chosen_value", "prompt_text", "rejected_value")


@query("flag_ties", PAIRS + """SELECT pair_id, chosen_value, rejected_value,
  (chosen_value <> 0 AND rejected_value <> 0 AND NOT isnan(chosen_value) AND chosen_value = rejected_value) AS is_tie FROM f1""")
def q_f2(spark, sf):
    """F2: tie only when both scores are non-zero and equal."""
    c = curate.coalesce_fields(X.x_pairs(spark, sf))
    return c.select("pair_id", "chosen_value", "rejected_value",
                    curate.is_tie(F.col("chosen_value"), F.col("rejected_value")).alias("is_tie"))


@query("filter_pairs_quality", PAIRS + "SELECT pair_id, prompt_text, chosen, rejected FROM f3")
def q_f3(spark, sf):
    """quality filter with alternate names and the tie rule."""
    return curate.filter_pairs_quality(X.x_pairs(spark, sf)).select("pair_id", "prompt_text", "chosen", "rejected")


@query("filter_pairs_simple", PAIRS + "SELECT pair_id, input, chosen, rejected FROM f4")
def q_f4(spark, sf):
    """chosen_score >= 4 and input / chosen / rejected present."""
    return curate.filter_pairs_simple(X.x_pairs(spark, sf)).select("pair_id", "input", "chosen", "rejected")


@query("drop_incomplete_pairs", PAIRS + """SELECT pair_id, prompt_text AS prompt, coalesce(chosen, '') AS chosen, coalesce(rejected, '') AS rejected
FROM f1 WHERE length(prompt_text) > 0 AND coalesce(length(chosen), 0) > 0 AND coalesce(length(rejected), 0) > 0""")
def q_f5(spark, sf):
    """normalised pairs with any empty text dropped."""
    return curate.format_pairs(X.x_pairs(spark, sf))


@query("curation_funnel", S.with_(S.X_PAIRS, S.F1_CTE, S.F3_CTE) + f"""SELECT (SELECT CAST(count(*) AS BIGINT) FROM x_pairs) AS n_raw,
  CAST(count(*) AS BIGINT) AS n_filtered, CAST(least({SAMPLE_N}, n_formatted) AS BIGINT) AS n_sampled, n_formatted FROM f3,
  (SELECT CAST(count(*) AS BIGINT) AS n_formatted FROM f3 WHERE length(prompt_text) > 0 AND length(chosen) > 0 AND length(rejected) > 0)
GROUP BY n_formatted""")
def q_f6(spark, sf):
    """row counts raw -> filtered -> formatted in one aggregate pass; ``n_sampled`` is what T1
    would take of the formatted rows."""
    c = curate.coalesce_fields(X.x_pairs(spark, sf))
    keep = F.coalesce(curate.quality_keep(c), F.lit(False))
    texts = [F.col("prompt_text"), curate.normalise_completion(c, "chosen"), curate.normalise_completion(c, "rejected")]
    formatted = keep
    for t in texts:
        formatted = formatted & (F.coalesce(F.length(t), F.lit(0)) > 0)
    counts = c.agg(F.count(F.lit(1)).alias("n_raw"), F.count_if(keep).alias("n_filtered"), F.count_if(formatted).alias("n_formatted"))
    return counts.select("n_raw", "n_filtered", F.least(F.lit(SAMPLE_N), F.col("n_formatted")).cast("bigint").alias("n_sampled"), "n_formatted")


@query("normalise_completion", """SELECT conv_id, CASE WHEN count_if(role = 'assistant') > 0
    THEN coalesce(arg_max(text, turn) FILTER (WHERE role = 'assistant'), '')
    ELSE CAST(to_json(arg_max(struct_pack(role := role, content := text), turn)) AS VARCHAR) END AS completion
FROM conversations GROUP BY conv_id""")
def q_p9(spark, sf):
    """The completion of each conversation (last assistant turn)."""
    conv = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    return curate.completion_from_turns(conv)


@query("normalise_completion_mixed", S.with_(S.X_PAIRS) + """SELECT pair_id,
  CASE WHEN pair_id // 100 % 5 < 2 THEN chosen WHEN pair_id // 100 % 5 = 2 THEN '' WHEN pair_id // 100 % 5 = 3 THEN ''
    ELSE CAST(to_json(struct_pack(content := prompt, role := 'user')) AS VARCHAR) END AS completion,
  CASE WHEN pair_id // 100 % 5 = 0 THEN chosen <> '' ELSE pair_id // 100 % 5 <> 2 END AS present
FROM x_pairs WHERE chosen IS NOT NULL AND prompt IS NOT NULL""")
def q_p9_mixed(spark, sf):
    """P9 on a VARIANT column: a text, a message list, an empty list, an assistant turn without
    content, or a list without an assistant turn, by pair; ``present`` is the filters' truth value."""
    def turn(role, text):
        return F.struct(text.alias("content"), F.lit(role).alias("role"))

    pairs = X.x_pairs(spark, sf).where("chosen IS NOT NULL AND prompt IS NOT NULL")
    kind = F.floor(F.col("pair_id") / 100) % 5
    user, nothing = turn("user", F.col("prompt")), turn("assistant", F.lit(None).cast("string"))
    text = F.to_json(F.array(F.col("chosen")))
    mixed = (
        F.when(kind == 0, F.substring(text, F.lit(2), F.length(text) - 2))
        .when(kind == 1, F.to_json(F.array(user, turn("assistant", F.col("chosen")))))
        .when(kind == 2, F.lit("[]"))
        .when(kind == 3, F.to_json(F.array(user, nothing)))
        .otherwise(F.to_json(F.array(user)))
    )
    t = pairs.select("pair_id", F.parse_json(mixed).alias("completion"))
    return t.select("pair_id", curate.normalise_completion(t, "completion").alias("completion"),
                    curate.non_empty(t, "completion").alias("present"))


@query("sample_pairs", S.with_(S.X_PAIRS, S.F1_CTE, S.F3_CTE, T1_CTE) + "SELECT pair_id, prompt_text, chosen, rejected FROM t1")
def q_t1(spark, sf):
    """Seeded sample of the quality-filtered pairs."""
    f3 = curate.filter_pairs_quality(X.x_pairs(spark, sf))
    return curate.sample_pairs(f3, SAMPLE_N).select("pair_id", "prompt_text", "chosen", "rejected")


@query("assign_batches", S.with_(S.X_PAIRS, S.F1_CTE, S.F3_CTE, T2_CTE) + "SELECT pair_id, position, (position - 1) // 2 AS batch_id FROM t2")
def q_t2(spark, sf):
    """Shuffled batches of 2 over all filtered pairs."""
    f3 = curate.filter_pairs_quality(X.x_pairs(spark, sf))
    return curate.assign_batches(f3.select("pair_id"), 2).select("pair_id", "position", "batch_id")


@query("collate_batches", S.with_(S.X_PAIRS, S.F1_CTE, S.F3_CTE, T2_CTE) + """SELECT (position - 1) // 2 AS batch_id, CAST(count(*) AS BIGINT) AS batch_size,
  string_agg(CAST(pair_id AS VARCHAR), ',' ORDER BY position) AS pair_ids FROM t2 GROUP BY 1""")
def q_t3(spark, sf):
    """One row per batch with its member ids in order."""
    f3 = curate.filter_pairs_quality(X.x_pairs(spark, sf))
    c = curate.collate_batches(curate.assign_batches(f3.select("pair_id"), 2), [])
    return c.select("batch_id", "batch_size", F.array_join(F.col("pair_id").cast("array<string>"), ",").alias("pair_ids"))


@query("repeat_epochs", S.with_(S.X_PAIRS, S.F1_CTE, S.F3_CTE) + """SELECT epoch, pair_id, position, (position - 1) // 2 AS batch_id FROM (
  SELECT e.epoch, f3.pair_id, CAST(row_number() OVER (PARTITION BY e.epoch ORDER BY md5('42:' || CAST(e.epoch AS VARCHAR) || ':' || CAST(f3.pair_id AS VARCHAR)), f3.pair_id) AS BIGINT) AS position
  FROM f3 CROSS JOIN (SELECT CAST(range AS INTEGER) AS epoch FROM range(3)) e)""")
def q_t4(spark, sf):
    """T4: three epochs, re-shuffled each epoch."""
    f3 = curate.filter_pairs_quality(X.x_pairs(spark, sf))
    return curate.repeat_epochs(f3.select("pair_id"), 3, 2).select("epoch", "pair_id", "position", "batch_id")


@query("head_n", S.with_(S.X_PAIRS) + "SELECT pair_id, prompt FROM x_pairs ORDER BY pair_id LIMIT 10")
def q_t5(spark, sf):
    """T5: first 10 pairs by id."""
    return curate.head_n(X.x_pairs(spark, sf), 10, ["pair_id"]).select("pair_id", "prompt")


@query("training_plan", S.with_(S.X_CASES, S.X_PAIRS, S.F1_CTE, S.F3_CTE) + """
SELECT 'sft' AS plan, rows, CAST(4 AS BIGINT) AS per_device_batch, CAST(2 AS BIGINT) AS grad_accumulation,
  CAST(8 AS BIGINT) AS effective_batch, CAST(75 AS BIGINT) AS steps,
  round_even(75 * 8 / rows, 3) AS epochs_covered FROM (SELECT CAST(count(*) AS BIGINT) AS rows FROM x_cases)
UNION ALL
SELECT 'dpo', rows, CAST(2 AS BIGINT), CAST(4 AS BIGINT), CAST(8 AS BIGINT), CAST(ceil(rows / 8) AS BIGINT), round_even(CAST(ceil(rows / 8) AS BIGINT) * 8 / rows, 3)
FROM (SELECT CAST(count(*) AS BIGINT) AS rows FROM f3)""")
def q_t6(spark, sf):
    """SFT (75 steps of 4 x 2 over the corpus) and DPO (1 epoch of 2 x 4 over all formatted pairs)."""
    sft = X.x_cases(spark, sf).agg(F.count(F.lit(1)).alias("n"))
    sft = sft.select(F.lit("sft").alias("plan"), *curate.training_plan(F.col("n"), 4, 2, steps=F.lit(75)))
    pairs = curate.format_pairs(curate.filter_pairs_quality(X.x_pairs(spark, sf)))
    dpo = pairs.agg(F.count(F.lit(1)).alias("n"))
    dpo = dpo.select(F.lit("dpo").alias("plan"), *curate.training_plan(F.col("n"), 2, 4, epochs=1))
    return sft.unionByName(dpo)


PROMPT = S.lit(prompts.USER_TAG + prompts.INSTRUCTION + prompts.TEXT_LABEL)
PROMPT_END = S.lit("\n" + prompts.END_TAG + prompts.ASSISTANT_TAG)


@query("render_inference_prompt", S.with_(S.X_CASES) + f"SELECT test_id, {PROMPT} || input || {PROMPT_END} AS prompt FROM x_cases")
def q_p1(spark, sf):
    """The inference prompt of every case."""
    return X.x_cases(spark, sf).select("test_id", prompts.inference_prompt("input").alias("prompt"))


@query("render_sft_text", S.with_(S.X_CASES) + f"SELECT test_id, {PROMPT} || input || {PROMPT_END} || expected || {S.lit(prompts.END_TAG)} AS text FROM x_cases")
def q_p2(spark, sf):
    """SFT training text (prompt + expected output + end tag)."""
    return X.x_cases(spark, sf).select("test_id", prompts.sft_text("input", "expected").alias("text"))


@query("render_sft_messages", S.with_(S.X_CASES) + f"""SELECT test_id, 'user' AS user_role, {S.lit(prompts.INSTRUCTION + prompts.TEXT_LABEL)} || input AS user_content,
  'assistant' AS assistant_role, expected AS assistant_content FROM x_cases""")
def q_p3(spark, sf):
    """Chat messages of every SFT example."""
    m = X.x_cases(spark, sf).select("test_id", prompts.sft_messages("input", "expected").alias("m"))
    return m.select(
        "test_id",
        F.col("m")[0]["role"].alias("user_role"), F.col("m")[0]["content"].alias("user_content"),
        F.col("m")[1]["role"].alias("assistant_role"), F.col("m")[1]["content"].alias("assistant_content"),
    )


def _escaped(x: str) -> str:
    """Python's ASCII-only JSON text of a string, code point by code point."""
    high = "55296 + (unicode(c) - 65536) // 1024"
    low = "56320 + (unicode(c) - 65536) % 1024"
    unit = (f"CASE WHEN c = chr(34) THEN chr(92) || chr(34) WHEN c = chr(92) THEN chr(92) || chr(92) "
            f"WHEN c = chr(8) THEN chr(92) || 'b' WHEN c = chr(9) THEN chr(92) || 't' WHEN c = chr(10) THEN chr(92) || 'n' "
            f"WHEN c = chr(12) THEN chr(92) || 'f' WHEN c = chr(13) THEN chr(92) || 'r' "
            f"WHEN unicode(c) BETWEEN 32 AND 126 THEN c WHEN unicode(c) < 65536 THEN printf('%su%04x', chr(92), unicode(c)) "
            f"ELSE printf('%su%04x%su%04x', chr(92), {high}, chr(92), {low}) END")
    return f"'\"' || array_to_string(list_transform(regexp_extract_all({x}, '(?s).'), lambda c: {unit}), '') || '\"'"


@query("normalise_sft_output", f"""SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN text ELSE '{{"title": ' || {_escaped("text")} || ', "lang": ' || {_escaped("lang")}
  || ', "n_chars": ' || n_chars || ', "ratio": ' || CAST(n_chars AS DOUBLE) / 8 || ', "tags": [' || {_escaped("source")} || ', null, true, []], "a": {{}}}}' END AS output
FROM documents WHERE text IS NOT NULL""")
def q_p4(spark, sf):
    """SFT records whose output is an object of a whole document become Python's JSON text, keys in
    order; text outputs (every fifth) stay as they are."""
    d = table(spark, sf, "documents").where("text IS NOT NULL")
    # the records' lines, with a key order that is not the alphabet's, no spaces, and raw letters
    value = F.struct(F.col("text").alias("title"), "lang", "n_chars", (F.col("n_chars").cast("double") / 8).alias("ratio"))
    parts = d.select("doc_id", "text", F.to_json(value).alias("head"), F.to_json(F.array("source")).alias("source"))
    tags = F.concat(F.substring("source", F.lit(1), F.length("source") - 1), F.lit(",null,true,[]]"))
    body = F.concat(F.substring("head", F.lit(1), F.length("head") - 1), F.lit(',"tags":'), tags, F.lit(',"a":{}}'))
    text = F.to_json(F.array("text"))
    output = F.when(F.col("doc_id") % 5 == 0, F.substring(text, F.lit(2), F.length(text) - 2)).otherwise(body)
    lines = parts.select("doc_id", F.concat(F.lit('{"instruction":"x","output":'), output, F.lit("}")).alias("line"))
    return lines.select("doc_id", prompts.normalise_sft_output("line").alias("output"))


@query("strip_new_tokens", S.with_(S.X_CASES, S.X_OUTPUTS, S.ALIGNED) + f"""SELECT label, test_id,
  CAST(len(p) AS BIGINT) AS n_prompt_tokens, CAST(len(o) AS BIGINT) AS n_new_tokens, {S.strip("array_to_string(o, ' ')")} AS text
FROM (SELECT label, test_id, {S.split(f"{PROMPT} || input || {PROMPT_END}")} AS p, {S.split('output')} AS o FROM aligned)""")
def q_p6(spark, sf):
    """The generated sequence minus the prompt's tokens, decoded and stripped."""
    cases = X.x_cases(spark, sf)
    al = X.x_outputs(spark, sf, cases).select("label", "test_id", "output").join(cases.select("test_id", "input"), "test_id")
    pt, full = prompts.generated_tokens(prompts.inference_prompt("input"), F.col("output"))
    t = al.select("label", "test_id", pt.alias("pt"), full.alias("full"))
    return t.select(
        "label", "test_id",
        F.size("pt").cast("bigint").alias("n_prompt_tokens"),
        (F.size("full") - F.size("pt")).cast("bigint").alias("n_new_tokens"),
        prompts.strip_new_tokens(F.col("pt"), F.col("full")).alias("text"),
    )


@query("pair_text", PAIRS + "SELECT pair_id, input || ' ' || chosen AS chosen_text, input || ' ' || rejected AS rejected_text FROM f4")
def q_p7(spark, sf):
    """Prompt + ' ' + completion for both sides of the simple-filtered pairs."""
    f4 = curate.filter_pairs_simple(X.x_pairs(spark, sf))
    return f4.select("pair_id", prompts.pair_text("input", "chosen").alias("chosen_text"),
                     prompts.pair_text("input", "rejected").alias("rejected_text"))


@query("test_prompts", S.with_(S.X_CASES) + f"""SELECT CAST(row_number() OVER (ORDER BY test_id) AS BIGINT) AS position, test_id,
  {PROMPT} || input || {PROMPT_END} AS prompt FROM x_cases""")
def q_p8(spark, sf):
    """Ordered prompts of all cases as rows."""
    return prompts.test_prompts(X.x_cases(spark, sf))
