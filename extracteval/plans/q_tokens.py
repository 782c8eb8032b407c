"""Registered text-statistics, token-preparation and preference-numerics queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from extracteval.functions.pytext import py_split, round_half_even
from extracteval.functions.textstats import response_length, with_text_stats
from extracteval.operators import curate, encode, prefnum, prompts
from extracteval.plans import sqlparts as S
from extracteval.plans.registry import query
from extracteval.session import shared_dir
from extracteval.sources import fixtures as X
from extracteval.sources.tables import table

DOCS = f"""d AS (SELECT doc_id, {S.split('text')} AS w, {S.split('lower(text)')} AS t FROM documents),
dg AS (SELECT doc_id, w, t, {S.grams()} AS g FROM d)"""


def _docs(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "text")


@query("response_length", S.with_(DOCS) + "SELECT doc_id, CAST(len(w) AS INTEGER) AS n_words FROM d")
def q_r11(spark, sf):
    """Whitespace word count of every document (whole texts)."""
    return _docs(spark, sf).select("doc_id", response_length("text").alias("n_words"))


@query("ngram_diversity", S.with_(DOCS) + f"SELECT doc_id, {S.diversity_of()} AS diversity FROM dg")
def q_r12(spark, sf):
    """Bigram diversity of every document."""
    return with_text_stats(_docs(spark, sf), "text", 2).select("doc_id", "diversity")


@query("distinct_ngrams", S.with_(DOCS) + "SELECT doc_id, CAST(len(g) AS INTEGER) AS n_bigrams, CAST(len(list_distinct(g)) AS INTEGER) AS n_distinct FROM dg")
def q_u3(spark, sf):
    """Bigrams and distinct bigrams of every document."""
    st = with_text_stats(_docs(spark, sf), "text", 2)
    return st.select("doc_id", F.col("n_grams").alias("n_bigrams"), "n_distinct")


VOCAB_CTE = f"""vocab AS (SELECT token, CAST(row_number() OVER (ORDER BY n DESC, md5(token), token) + 1 AS BIGINT) AS token_id, n
  FROM (SELECT token, CAST(count(*) AS BIGINT) AS n FROM (SELECT unnest({S.split('text')}) AS token FROM documents) GROUP BY token))"""


def _ids_cte(src: str, keys: str, text: str, name: str = "ids") -> str:
    join_on = " AND ".join(f"t.{k.strip()} = s.{k.strip()}" for k in keys.split(","))
    skeys = ", ".join(f"s.{k.strip()}" for k in keys.split(","))
    return f"""{name}_tok AS (SELECT {keys}, unnest(w) AS token, generate_subscripts(w, 1) AS pos
  FROM (SELECT {keys}, {S.split(text)} AS w FROM {src})),
{name} AS (SELECT {skeys}, coalesce(list(coalesce(v.token_id, 1) ORDER BY t.pos) FILTER (WHERE t.pos IS NOT NULL), []) AS ids
  FROM {src} s LEFT JOIN {name}_tok t ON {join_on} LEFT JOIN vocab v ON v.token = t.token GROUP BY {skeys})"""


def _pad(ids: str, n: int = encode.MAX_LEN) -> tuple[str, str]:
    kept = f"{ids}[1:{n}]"
    p = f"array_to_string(list_transform(range(1, {n + 1}), lambda i: CASE WHEN i <= len({kept}) THEN {kept}[i] ELSE 0 END), ',')"
    m = f"array_to_string(list_transform(range(1, {n + 1}), lambda i: CASE WHEN i <= len({kept}) THEN 1 ELSE 0 END), ',')"
    return p, m


def _join_ids(c):
    return F.array_join(F.transform(c, lambda x: x.cast("string")), ",")


@query("build_vocab", S.with_(VOCAB_CTE) + "SELECT token, token_id, n FROM vocab")
def q_n1(spark, sf):
    """Vocabulary of the document corpus (every token, by count)."""
    return encode.build_vocab(_docs(spark, sf))


@query("tokenize_ids", S.with_(VOCAB_CTE, _ids_cte("documents", "doc_id", "text")) +
       "SELECT doc_id, CAST(len(ids) AS INTEGER) AS n_tokens, array_to_string(ids, ',') AS ids FROM ids")
def q_n2(spark, sf):
    """Token ids of every whole document."""
    docs = encode.spread_rows(_docs(spark, sf), ["doc_id", "text"])
    ids = encode.tokenize_ids(docs, ["doc_id"], "text", _saved_vocab(spark, docs, copies="_copies"))
    return ids.select("doc_id", F.size("ids").alias("n_tokens"), _join_ids(F.col("ids")).alias("ids"))


def _saved_vocab(spark, docs, **options):
    """The corpus vocabulary, built once in the shared folder."""
    return encode.save_vocab(encode.build_vocab(docs, **options), shared_dir(spark, f"vocabulary-{uuid.uuid4().hex}"))


_P, _M = _pad("ids")


@query("truncate_pad_mask", S.with_(VOCAB_CTE, _ids_cte("documents", "doc_id", "text")) + f"SELECT doc_id, {_P} AS ids, {_M} AS mask FROM ids")
def q_n3(spark, sf):
    """Ids cut / padded to 384 with the attention mask."""
    docs = encode.spread_rows(_docs(spark, sf), ["doc_id", "text"])
    ids = encode.tokenize_ids(docs, ["doc_id"], "text", _saved_vocab(spark, docs, copies="_copies"), limit=encode.MAX_LEN)
    p, m = encode.truncate_pad("ids")
    return ids.select("doc_id", _join_ids(p).alias("ids"), _join_ids(m).alias("mask"))


N4_SQL = S.with_(S.X_PAIRS, S.F4_CTE, VOCAB_CTE,
    "sides AS (SELECT pair_id, 'chosen' AS side, input || ' ' || chosen AS text FROM f4 UNION ALL SELECT pair_id, 'rejected', input || ' ' || rejected FROM f4)",
    _ids_cte("sides", "pair_id, side", "text")) + f"""SELECT pair_id,
  max(CASE WHEN side = 'chosen' THEN {_P} END) AS chosen_ids, max(CASE WHEN side = 'chosen' THEN {_M} END) AS chosen_mask,
  max(CASE WHEN side = 'rejected' THEN {_P} END) AS rejected_ids, max(CASE WHEN side = 'rejected' THEN {_M} END) AS rejected_mask
FROM ids GROUP BY pair_id"""


@query("encode_pairs", N4_SQL)
def q_n4(spark, sf):
    """All simple-filtered pairs encoded to four fixed-length arrays."""
    pairs = curate.filter_pairs_simple(X.x_pairs(spark, sf))
    enc = encode.encode_pairs(pairs, _saved_vocab(spark, _docs(spark, sf)))
    return enc.select("pair_id", *[_join_ids(F.col(c)).alias(c) for c in ("chosen_ids", "chosen_mask", "rejected_ids", "rejected_mask")])


@query("length_budget", S.with_(S.X_PAIRS, S.F4_CTE) + f"""SELECT pair_id, CAST(len(pk) AS INTEGER) AS prompt_kept, CAST(len(ck) AS INTEGER) AS completion_kept,
  pk[1] AS prompt_first, ck[len(ck)] AS completion_last
FROM (SELECT pair_id, pk, c[1:greatest(512 - len(pk), 0)] AS ck FROM (
  SELECT pair_id, CASE WHEN len(p) > 256 THEN p[len(p) - 255:] ELSE p END AS pk, c FROM (
    SELECT pair_id, {S.split('input')} AS p, {S.split('chosen')} AS c FROM f4)))""")
def q_n5(spark, sf):
    """Prompt keeps its last 256 tokens; completion cut to fit 512 in total."""
    f4 = curate.filter_pairs_simple(X.x_pairs(spark, sf))
    p, c = encode.length_budget(py_split("input"), py_split("chosen"))
    t = f4.select("pair_id", p.alias("pk"), c.alias("ck"))
    return t.select("pair_id", F.size("pk").alias("prompt_kept"), F.size("ck").alias("completion_kept"),
                    F.try_element_at("pk", F.lit(1)).alias("prompt_first"),
                    F.try_element_at("ck", F.lit(-1)).alias("completion_last"))


@query("pack_sequences", S.with_(f"lens AS (SELECT doc_id, CAST(len({S.split('text')}) AS BIGINT) AS n FROM documents)",
    "cum AS (SELECT doc_id, n, CAST(sum(n) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS e FROM lens WHERE n > 0)",
    "pieces AS (SELECT doc_id, e - n AS s, e, unnest(range((e - n) // 1024, (e - 1) // 1024 + 1)) AS block_id FROM cum)") + """
SELECT block_id, CAST(sum(least(e, (block_id + 1) * 1024) - greatest(s, block_id * 1024)) AS BIGINT) AS n_tokens,
  CAST(count(*) AS BIGINT) AS n_pieces, min(doc_id) AS first_id, max(doc_id) AS last_id FROM pieces GROUP BY block_id""")
def q_n6(spark, sf):
    """Documents packed end to end into 1024-token blocks (exact global offsets)."""
    d = _docs(spark, sf).select("doc_id", response_length("text").alias("n"))
    return encode.pack_sequences(d, "doc_id", "n", 1024)


@query("packed_blocks", S.with_(VOCAB_CTE, _ids_cte("documents", "doc_id", "text"),
    "stream AS (SELECT doc_id, pos, id, row_number() OVER (ORDER BY doc_id, pos) - 1 AS place FROM (SELECT doc_id, unnest(ids) AS id, generate_subscripts(ids, 1) AS pos FROM ids))") + """
SELECT CAST(place // 1024 AS BIGINT) AS block_id, string_agg(CAST(id AS VARCHAR), ',' ORDER BY place) AS ids, CAST(count(DISTINCT doc_id) AS INTEGER) AS n_pieces,
  arg_min(doc_id, place) AS first_id, CAST(min(pos) FILTER (WHERE place % 1024 = 0) - 1 AS BIGINT) AS first_start FROM stream GROUP BY 1""")
def q_n6_ids(spark, sf):
    """The token ids of every block of 1024, with the place where its first document goes on."""
    docs = encode.spread_rows(_docs(spark, sf), ["doc_id", "text"])
    ids = encode.tokenize_ids(docs, ["doc_id"], "text", _saved_vocab(spark, docs, copies="_copies"))
    b = encode.packed_blocks(ids, "doc_id", "ids", 1024)
    first = F.col("pieces")[0]
    return b.select("block_id", _join_ids(F.col("ids")).alias("ids"), F.size("pieces").alias("n_pieces"),
                    first["id"].alias("first_id"), first["start"].alias("first_start"))


_SIDES = ("chosen_ids", "chosen_mask", "rejected_ids", "rejected_mask")


@query("stack_batches", f"""WITH enc AS ({N4_SQL}), placed AS (
  SELECT *, row_number() OVER (ORDER BY md5('42:' || CAST(pair_id AS VARCHAR)), pair_id) AS position FROM enc)
SELECT CAST((position - 1) // 2 AS BIGINT) AS batch_id, CAST(count(*) AS INTEGER) AS rows, {encode.MAX_LEN} AS columns,
  string_agg(CAST(pair_id AS VARCHAR), ',' ORDER BY position) AS pair_ids,
  {", ".join(f"string_agg({c}, ',' ORDER BY position) AS {c}" for c in _SIDES)} FROM placed GROUP BY 1""")
def q_t3_stack(spark, sf):
    """Shuffled batches of 2 encoded pairs, each of the four columns stacked to a matrix row by row."""
    pairs = curate.filter_pairs_simple(X.x_pairs(spark, sf))
    enc = encode.encode_pairs(pairs, _saved_vocab(spark, _docs(spark, sf)))
    m = curate.stack_batches(curate.assign_batches(enc, 2), _SIDES)
    return m.select("batch_id", "rows", "columns", _join_ids(F.col("pair_id")).alias("pair_ids"), *[_join_ids(F.col(c)).alias(c) for c in _SIDES])


@query("decode_new_tokens", S.with_(S.X_CASES, S.X_OUTPUTS) + f"SELECT label, test_id, {S.strip("array_to_string(" + S.split("output") + ", chr(32))")} AS text FROM x_outputs")
def q_p6_ids(spark, sf):
    """P6 on token ids: each generated sequence encoded, cut after its prompt's length and decoded."""
    cases = X.x_cases(spark, sf)
    prompt = prompts.inference_prompt("input")
    asked = cases.select("test_id", "input").repartition("test_id").withColumn("n_prompt", F.size(py_split(prompt)))
    al = X.x_outputs(spark, sf, cases).select("label", "test_id", "output").join(asked, "test_id")
    whole = al.select("label", "test_id", "n_prompt", F.concat(prompt, F.col("output")).alias("text"))
    by = encode.together(whole, ["test_id"])
    vocab = _saved_vocab(spark, whole)
    ids = encode.tokenize_ids(whole, ["label", "test_id", "n_prompt"], "text", vocab, by=by)
    return encode.decode_new_ids(ids, ["label", "test_id"], "n_prompt", vocab, by=by)


LOGP = S.with_(S.X_LOGITS,
    "lg AS (SELECT *, lag(logits) OVER (PARTITION BY pair_id, side, model ORDER BY pos) AS prev FROM x_logits)",
    "lm AS (SELECT pair_id, side, model, pos, token_id, mask, prev, list_max(prev) AS m FROM lg WHERE prev IS NOT NULL)",
    "tok AS (SELECT pair_id, side, model, pos, mask, prev[token_id + 1] - (m + ln(list_sum(list_transform(prev, lambda x: exp(x - m))))) AS token_logprob FROM lm)",
    """lr AS (SELECT pair_id,
  sum(CASE WHEN side = 'chosen' AND model = 'policy' THEN token_logprob * mask END) - sum(CASE WHEN side = 'rejected' AND model = 'policy' THEN token_logprob * mask END) AS pi_logratio,
  sum(CASE WHEN side = 'chosen' AND model = 'reference' THEN token_logprob * mask END) - sum(CASE WHEN side = 'rejected' AND model = 'reference' THEN token_logprob * mask END) AS ref_logratio
  FROM tok GROUP BY pair_id HAVING count(DISTINCT side || model) = 4)""",
    "loss AS (SELECT pair_id, 0.1 * (pi_logratio - ref_logratio) AS z, ln(1 + exp(-abs(0.1 * (pi_logratio - ref_logratio)))) - least(0.1 * (pi_logratio - ref_logratio), 0) AS loss FROM lr)")


def _r6(c):
    return round_half_even(F.col(c), 6).alias(c)


def _tok(spark, sf):
    return prefnum.token_logprobs(X.x_logits(spark, sf))


@query("token_logprobs", LOGP + "SELECT pair_id, side, model, pos, mask, round_even(token_logprob, 6) AS token_logprob FROM tok")
def q_l1(spark, sf):
    """L1: shifted token log-probabilities of every logged sequence."""
    t = _tok(spark, sf)
    return t.select("pair_id", "side", "model", "pos", "mask", _r6("token_logprob"))


@query("sequence_logprob", LOGP + "SELECT pair_id, side, model, round_even(sum(token_logprob * mask), 6) AS logprob FROM tok GROUP BY ALL")
def q_l2(spark, sf):
    """L2: masked sequence log-probability."""
    return prefnum.sequence_logprob(_tok(spark, sf)).select("pair_id", "side", "model", _r6("logprob"))


@query("logratios", LOGP + "SELECT pair_id, round_even(pi_logratio, 6) AS pi_logratio, round_even(ref_logratio, 6) AS ref_logratio FROM lr")
def q_l3(spark, sf):
    """L3: policy and reference log-ratios per complete pair."""
    return prefnum.logratios(_tok(spark, sf)).select("pair_id", _r6("pi_logratio"), _r6("ref_logratio"))


@query("dpo_loss", LOGP + "SELECT pair_id, round_even(z, 6) AS z, round_even(loss, 6) AS loss FROM loss")
def q_l4(spark, sf):
    """L4: DPO loss per pair (beta 0.1)."""
    return prefnum.dpo_loss(prefnum.logratios(_tok(spark, sf))).select("pair_id", _r6("z"), _r6("loss"))


@query("mean_of_batch_means", LOGP + """SELECT CAST(count(*) AS BIGINT) AS steps, round_even(avg(m), 4) AS final_loss, CAST(sum(n) AS BIGINT) AS pairs FROM (
  SELECT (rn - 1) // 2 AS b, avg(loss) AS m, count(*) AS n FROM (
    SELECT loss, row_number() OVER (ORDER BY md5('42:' || CAST(pair_id AS VARCHAR)), pair_id) AS rn FROM loss) GROUP BY b)""")
def q_l5(spark, sf):
    """The run's final average loss over batches of 2."""
    return prefnum.mean_of_batch_means(prefnum.dpo_loss(prefnum.logratios(_tok(spark, sf))))


@query("running_loss_log", S.with_(S.X_LOSSES) + f"""SELECT run_id, step, round_even(u, 4) AS running_loss FROM (
  SELECT run_id, step, CAST(sum(CAST(loss AS DECIMAL(30,18))) OVER (PARTITION BY run_id ORDER BY step
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) / step AS u FROM x_losses) WHERE step % 20 = 0""")
def q_v1(spark, sf):
    """V1: running mean loss every 20 steps of each logged run."""
    return prefnum.running_loss_log(X.x_losses(spark, sf))


@query("enumerate_tests", S.with_(S.X_CASES) + "SELECT test_id, CAST(row_number() OVER (ORDER BY test_id) AS BIGINT) AS position FROM x_cases")
def q_v2(spark, sf):
    """V2: 1-based position of each case by its carried id."""
    return prefnum.enumerate_rows(X.x_cases(spark, sf).select("test_id"))
