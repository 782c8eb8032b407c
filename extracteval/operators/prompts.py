"""Prompt and record shaping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from extracteval.functions.jsonx import json_dumps
from extracteval.functions.pytext import col_, py_split, py_strip
from extracteval.operators.scan import ordinal_within

# The instruction and chat tags of the extraction prompt.
INSTRUCTION = "Extract structured JSON from the following text. Output ONLY valid JSON, nothing else."
USER_TAG = "<|user|>\n"
END_TAG = "<|end|>\n"
ASSISTANT_TAG = "<|assistant|>\n"
TEXT_LABEL = "\n\nText: "


def inference_prompt(inp: Column | str, instruction: str = INSTRUCTION) -> Column:
    """The chat prompt ending with the assistant tag (concat, so '{input}' in data is inert)."""
    return F.concat(F.lit(USER_TAG + instruction + TEXT_LABEL), col_(inp), F.lit("\n" + END_TAG + ASSISTANT_TAG))


def sft_text(inp: Column | str, output: Column | str, instruction: str = INSTRUCTION) -> Column:
    """Prompt + output + end tag + newline."""
    return F.concat(inference_prompt(inp, instruction), col_(output), F.lit(END_TAG))


def sft_messages(inp: Column | str, output: Column | str, instruction: str = INSTRUCTION) -> Column:
    """[{user: instruction + '\\n\\nText: ' + input}, {assistant: output}]."""
    return F.array(
        F.struct(F.lit("user").alias("role"), F.concat(F.lit(instruction + TEXT_LABEL), col_(inp)).alias("content")),
        F.struct(F.lit("assistant").alias("role"), col_(output).alias("content")),
    )


def normalise_sft_output(line: Column | str, field: str = "output") -> Column:
    """``field`` of an SFT record's JSON text: its text when it is a string, else Python's JSON text of it.

    Key order, ``", "`` and ``": "``, ASCII escapes and floats are Python's; a missing field or JSON null is null.
    """
    record = col_(line)
    value = F.try_variant_get(F.try_parse_json(record), f"$.{field}", "variant")
    kind = F.schema_of_variant(value)
    return F.when(kind == "STRING", F.variant_get(value, "$", "string")).when(kind.isNotNull(), json_dumps(F.get_json_object(record, f"$.{field}")))


def strip_new_tokens(prompt_tokens: Column, all_tokens: Column) -> Column:
    """Tokens after the prompt length, decoded (space-joined) and stripped."""
    new = F.slice(all_tokens, F.size(prompt_tokens) + 1, F.greatest(F.size(all_tokens) - F.size(prompt_tokens), F.lit(0)))
    return py_strip(F.array_join(new, " "))


def pair_text(prompt: Column | str, completion: Column | str) -> Column:
    """Prompt + ' ' + completion (null when either is null, as Python would fail)."""
    return F.concat(col_(prompt), F.lit(" "), col_(completion))


def test_prompts(cases: DataFrame) -> DataFrame:
    """The rendered prompts as ordered rows (position, test_id, prompt) — never one huge list."""
    p = cases.select("test_id", inference_prompt("input").alias("prompt"))
    return ordinal_within(p, [], "test_id", "position").select("position", "test_id", "prompt")


def generated_tokens(prompt: Column, output: Column) -> tuple[Column, Column]:
    """Word tokens of a prompt and of the full generated sequence (prompt followed by output)."""
    pt = py_split(prompt)
    return pt, F.concat(pt, py_split(output))
