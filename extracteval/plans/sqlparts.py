"""DuckDB SQL fragments for the oracle statements.

The oracle sees only the raw tables, so every statement inlines the derived views it needs as
CTEs.  The fragments restate the same semantics in DuckDB's dialect: Python whitespace as an
explicit character list, ``round_even`` for Python's rounding, ``json_*`` functions for parsing.
"""

from __future__ import annotations

from extracteval.functions.pytext import PY_FLOAT_RE, PY_WHITESPACE

WS_CHARS = "||".join(f"chr({ord(c)})" for c in PY_WHITESPACE)
WS_RE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"


def strip(x: str) -> str:
    return f"trim({x}, {WS_CHARS})"


def split(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '{WS_RE}+'), lambda t: t <> '')"


def fences(x: str) -> str:
    return strip(f"regexp_replace({x}, '```json{WS_RE}*|{WS_RE}*```', '', 'g')")


def brace_slice(x: str) -> str:
    start = f"instr({x}, '{{')"
    back = f"instr(reverse({x}), '}}')"
    end = f"(length({x}) - {back} + 1)"
    return (f"CASE WHEN {start} > 0 AND {back} > 0 AND {end} >= {start} "
            f"THEN substring({x}, {start}, {end} - {start} + 1) ELSE '' END")


def _scalar_text(j: str) -> str:
    return (f"CASE WHEN {j} IS NULL OR json_type({j}) = 'NULL' THEN 'None' "
            f"WHEN json_type({j}) = 'VARCHAR' THEN json_extract_string({j}, '$') "
            f"WHEN json_type({j}) = 'BOOLEAN' THEN CASE WHEN CAST({j} AS VARCHAR) = 'true' THEN 'True' ELSE 'False' END "
            f"ELSE CAST({j} AS VARCHAR) END")


def py_text(j: str) -> str:
    """Python's ``str`` of a value; a list shows its texts in quotes (single ones unless the text holds one)."""
    t = "json_extract_string(li, '$')"
    shown = (f"CASE WHEN json_type(li) <> 'VARCHAR' THEN {_scalar_text('li')} "
             f"WHEN contains({t}, chr(39)) AND NOT contains({t}, chr(34)) THEN chr(34) || {t} || chr(34) "
             f"ELSE chr(39) || replace({t}, chr(39), chr(92) || chr(39)) || chr(39) END")
    items = f"list_transform(json_extract({j}, '$[*]'), lambda li: {shown})"
    return f"CASE WHEN json_type({j}) = 'ARRAY' THEN '[' || coalesce(array_to_string({items}, ', '), '') || ']' ELSE {_scalar_text(j)} END"


def as_number(j: str) -> str:
    s = strip(f"json_extract_string({j}, '$')")
    return (f"CASE WHEN json_type({j}) IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN CAST({j} AS DOUBLE) "
            f"WHEN json_type({j}) = 'BOOLEAN' THEN CASE WHEN CAST({j} AS VARCHAR) = 'true' THEN 1.0 ELSE 0.0 END "
            f"WHEN json_type({j}) = 'VARCHAR' AND regexp_full_match({s}, '{PY_FLOAT_RE}') "
            f"THEN TRY_CAST(replace({s}, '_', '') AS DOUBLE) END")


def rule(j: str) -> str:
    return (f"CASE WHEN json_type({j}) IN ('UBIGINT', 'BIGINT', 'DOUBLE', 'BOOLEAN') THEN 'number' "
            f"WHEN json_type({j}) = 'ARRAY' THEN 'list' ELSE 'text' END")


def text_set(j: str) -> str:
    return f"list_distinct(list_transform(json_extract({j}, '$[*]'), lambda e: lower({py_text('e')})))"


def credit(ev: str, pv: str) -> str:
    es, ps = text_set(ev), text_set(pv)
    e, p = f"lower({py_text(ev)})", f"lower({py_text(pv)})"
    return (f"CASE WHEN {pv} IS NULL THEN 0.0 "
            f"WHEN {rule(ev)} = 'number' THEN CASE WHEN abs({as_number(pv)} - {as_number(ev)}) < 0.01 THEN 1.0 ELSE 0.0 END "
            f"WHEN {rule(ev)} = 'list' THEN CASE WHEN json_type({pv}) = 'ARRAY' AND len({es}) > 0 "
            f"THEN CAST(len(list_intersect({es}, {ps})) AS DOUBLE) / len({es}) ELSE 0.0 END "
            f"WHEN {strip(p)} = {strip(e)} THEN 1.0 WHEN contains({p}, {e}) THEN 0.5 ELSE 0.0 END")


def compliance(x: str) -> str:
    s = strip(x)
    return (f"CASE WHEN starts_with({s}, '{{') AND ends_with({s}, '}}') THEN 1.0 "
            f"WHEN contains({s}, '{{') AND contains({s}, '}}') THEN 0.5 ELSE 0.0 END")


def r3(x: str) -> str:
    return f"round_even(CAST({x} AS DOUBLE), 3)"


def length(x: str) -> str:
    return f"CAST(len({split(x)}) AS BIGINT)"


def bigram_lists(x: str, n: int = 2) -> str:
    """SELECT-list fragment: tokens t and n-grams g (joined by a space) of lower(x)."""
    return (f"{split(f'lower({x})')} AS t")


def grams(t: str = "t", n: int = 2) -> str:
    return f"list_transform(range(len({t}) - {n - 1}), lambda i: array_to_string({t}[i + 1:i + {n}], ' '))"


def diversity_of(t: str = "t", g: str = "g", n: int = 2) -> str:
    return f"CASE WHEN len({t}) < {n} THEN 0.0 ELSE {r3(f'CAST(len(list_distinct({g})) AS DOUBLE) / len({g})')} END"


X_CASES = """x_cases AS (
  SELECT o_orderkey AS test_id,
    concat('Order #', CAST(o_orderkey AS VARCHAR), ' by ', c_name, '. Priority: ', o_orderpriority,
           '. Total: $', CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR), '.') AS input,
    concat('{"order_number": "', CAST(o_orderkey AS VARCHAR), '", "customer_name": "', c_name,
           '", "total": ', CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR),
           ', "urgent": ', CASE WHEN o_orderpriority LIKE '1%' THEN 'true' ELSE 'false' END,
           ', "tags": ["', c_mktsegment, '", "', o_orderstatus, '"], "note": null}') AS expected
  FROM orders JOIN customer ON o_custkey = c_custkey)"""

X_OUTPUTS = """x_outputs AS (
  SELECT label, test_id, k, CASE k
      WHEN 0 THEN expected
      WHEN 1 THEN concat('```json', chr(10), expected, chr(10), '```')
      WHEN 2 THEN concat(expected, ' Hope this helps.')
      WHEN 3 THEN replace(expected, '"customer_name"', '"customer"')
      WHEN 4 THEN replace(replace(replace(expected, '"total": ', '"total": "'), ', "urgent"', '", "urgent"'),
                          concat('"', CAST(test_id AS VARCHAR), '", "customer_name"'),
                          concat(CAST(test_id AS VARCHAR), ', "customer_name"'))
      WHEN 5 THEN left(expected, 30)
      WHEN 6 THEN 'No structured data found.'
      ELSE replace(replace(expected, 'Customer#', 'Mr Customer#'), '["', '["X') END AS output
  FROM (SELECT label, test_id, expected,
               CAST(CASE WHEN test_id % 3 = 0 THEN pick ELSE (test_id + salt) % 8 END AS INTEGER) AS k
        FROM x_cases CROSS JOIN (VALUES ('base_model', 1, 6), ('sft_model', 4, 0), ('dpo_model', 6, 1)) AS v(label, salt, pick)) y)"""

X_PAIRS = """x_pairs AS (
  SELECT u.conv_id * 100 + u.turn AS pair_id,
    CASE WHEN u.conv_id % 3 = 0 THEN u.text END AS input,
    CASE WHEN u.conv_id % 3 = 1 THEN u.text END AS question,
    CASE WHEN u.conv_id % 7 = 2 THEN '' ELSE u.text END AS prompt,
    a.text AS chosen,
    CASE WHEN u.conv_id % 11 = 5 THEN '' ELSE b.text END AS rejected,
    CASE WHEN u.conv_id % 4 = 0 THEN NULL ELSE CAST(3 + (u.conv_id % 3) AS DOUBLE) END AS chosen_rating,
    CAST(2 + (u.conv_id % 4) AS DOUBLE) AS chosen_score,
    CASE WHEN u.conv_id % 5 = 0 THEN NULL ELSE CAST(u.conv_id % 6 AS DOUBLE) END AS rejected_rating
  FROM conversations u
  JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND u.role = 'user' AND a.role = 'assistant'
  LEFT JOIN (SELECT conv_id, min_by(text, turn) AS text FROM conversations WHERE role = 'assistant' GROUP BY conv_id) b
    ON b.conv_id = u.conv_id + 1)"""

X_LOGITS = """x_logits AS (
  SELECT CAST(floor(vec_id / 16) AS BIGINT) AS pair_id,
    CASE WHEN CAST(floor(vec_id / 8) AS BIGINT) % 2 = 0 THEN 'chosen' ELSE 'rejected' END AS side,
    model, CAST(vec_id % 8 AS INT) AS pos, CAST((vec_id * 7) % 64 AS INT) AS token_id,
    CASE WHEN vec_id % 8 < 3 + CAST(floor(vec_id / 8) AS BIGINT) % 6 THEN 1 ELSE 0 END AS mask,
    list_transform(embedding, lambda x: CAST(x AS DOUBLE) * scale) AS logits
  FROM embeddings CROSS JOIN (VALUES ('policy', 8), ('reference', 4)) AS m(model, scale))"""

X_LOSSES = """x_losses AS (
  SELECT event_type AS run_id, event_id, value AS loss,
    row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS step
  FROM events)"""

ALIGNED = """aligned AS (
  SELECT o.label, o.test_id, o.output, c.input, c.expected FROM x_outputs o JOIN x_cases c ON o.test_id = c.test_id)"""


def parsed_cte(src: str = "aligned") -> str:
    return f"""cleaned AS (SELECT *, {fences('output')} AS clean FROM {src}),
sliced AS (SELECT *, json_valid(clean) AS valid_json, {brace_slice('clean')} AS piece FROM cleaned),
parsed AS (SELECT *, CASE WHEN json_valid(piece) THEN piece ELSE '{{}}' END AS pred FROM sliced),
fields AS (
  SELECT label, test_id, key,
    json_extract(expected, '$."' || key || '"') AS ev,
    json_extract(pred, '$."' || key || '"') AS pv
  FROM parsed, unnest(json_keys(expected)) AS t(key)),
credits AS (SELECT label, test_id, key, {rule('ev')} AS rule, ev, pv, {credit('ev', 'pv')} AS credit FROM fields),
acc AS (
  SELECT label, test_id, {r3('sum(credit) / count(*)')} AS field_accuracy FROM credits GROUP BY label, test_id),
scored AS (
  SELECT p.label, p.test_id, concat(left(p.input, 60), '...') AS input_preview, p.valid_json,
    coalesce(a.field_accuracy, 0.0) AS field_accuracy, {compliance('p.output')} AS format_compliance,
    {strip('left(p.output, 100)')} AS output_preview, false AS empty_expected_list
  FROM parsed p LEFT JOIN acc a ON p.label = a.label AND p.test_id = a.test_id)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


SCORED_CTES = [X_CASES, X_OUTPUTS, ALIGNED, parsed_cte()]

SUMMARY_CTE = """summary AS (
  SELECT label, num_tests, valid_json_rate, field_accuracy, format_compliance,
    round_even((valid_json_rate + field_accuracy + format_compliance) / 3.0, 3) AS overall_score
  FROM (SELECT label, CAST(count(*) AS BIGINT) AS num_tests,
      round_even(avg(CAST(valid_json AS INTEGER)), 3) AS valid_json_rate,
      round_even(CAST(sum(CAST(field_accuracy AS DECIMAL(4,3))) AS DOUBLE) / count(*), 3) AS field_accuracy,
      round_even(CAST(sum(CAST(format_compliance AS DECIMAL(4,3))) AS DOUBLE) / count(*), 3) AS format_compliance
    FROM scored GROUP BY label))"""


def lit(s: str) -> str:
    """A Python string as a DuckDB expression (newlines via chr(10))."""
    parts = ["'" + p.replace("'", "''") + "'" for p in s.split("\n")]
    return "(" + " || chr(10) || ".join(parts) + ")"


F1_CTE = """f1 AS (SELECT *, coalesce(CAST(chosen_rating AS DOUBLE), CAST(chosen_score AS DOUBLE), 0.0) AS chosen_value,
  coalesce(input, question, prompt, '') AS prompt_text,
  coalesce(CAST(rejected_rating AS DOUBLE), 0.0) AS rejected_value FROM x_pairs)"""
F3_CTE = """f3 AS (SELECT * FROM f1 WHERE NOT (chosen_value <> 0 AND rejected_value <> 0 AND NOT isnan(chosen_value)
  AND chosen_value = rejected_value) AND chosen_value >= 4.0 AND NOT isnan(chosen_value) AND length(prompt_text) > 0
  AND coalesce(length(chosen), 0) > 0 AND coalesce(length(rejected), 0) > 0)"""
F4_CTE = """f4 AS (SELECT * FROM x_pairs WHERE coalesce(CAST(chosen_score AS DOUBLE), 0.0) >= 4.0 AND NOT isnan(coalesce(CAST(chosen_score AS DOUBLE), 0.0))
  AND coalesce(length(input), 0) > 0 AND coalesce(length(chosen), 0) > 0 AND coalesce(length(rejected), 0) > 0)"""

