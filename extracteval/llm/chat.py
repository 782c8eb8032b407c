"""Chat formatting by event-sourced reconstruction (operator 5).

An event log (conv_id, msg, seq, kind, role, text) is partitioned by conversation, sorted by
message and sequence number, and folded in one pass with bounded state: one open message, plus
the largest sequence number that has rewound the conversation so far.

Kinds: ``open`` starts a message, ``delta`` appends to it, ``edit`` replaces its text,
``regenerate`` clears it for new deltas and rewinds: what later messages recorded before it is
dropped, ``delete`` removes it.  Deltas without an open message start one with the role ``""``.

Each final message becomes one row of the formatted table: ``<|role |>`` newline, the text,
``<|end|>`` newline.  Inside roles and texts a backslash is put before every backslash and into
every control string, so none can be read as a mark, and taking it out again restores the text.
The loss mask covers the text of assistant messages.

Defined results: null text is empty, null role is ""; a conversation's equal rows are each a
message; a null conv_id is a conversation of its own; an empty table gives no row but that of the
fixed conversation; other columns are not read.  A conversation is folded and hashed by one task
as a stream (a SHA-256 over its text cannot be split), with memory bounded by one message.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from extracteval.llm.common import prepare, shared_folder

DELTA_CHARS = 512
# Strings with a meaning in this or other chat templates; escaped inside texts.
CONTROL = ["<|", "|>", "</s>", "<s>", "[INST]", "[/INST]"]
_ESCAPE = re.compile("|".join([r"\\", *map(re.escape, CONTROL)]))
_UNESCAPE = re.compile(r"\\(.)", re.S)
END = "<|end|>\n"
LAST = (1 << 62) + (1 << 61)  # sequence numbers from here on come after all turns
_EVENTS = "array<struct<seq:bigint,kind:string,text:string>>"
EVENT = "conv_id bigint, msg bigint, copy bigint, seq bigint, kind string, role string, text string"
MESSAGE = "conv_id bigint, ord bigint, formatted string, loss_start bigint, loss_end bigint"


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: m[0][0] + "\\" + m[0][1:] if len(m[0]) > 1 else "\\\\", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """-> (formatted message, start and end of the loss mask; equal when nothing is learned)."""
    head = f"<|{escape(role)} |>\n"
    body = escape(text)
    return head + body + END, len(head), len(head) + (len(body) if role == "assistant" else 0)


def parse(formatted: str) -> tuple[str, str]:
    """A formatted message -> (role, text)."""
    role, _, rest = formatted[2:].partition(" |>\n")
    return unescape(role), unescape(rest[: -len(END)])


class Fold:
    """Folds sorted events; ``take`` returns the messages that an event completes."""

    def __init__(self) -> None:
        self.conv = self.key = self.message = None
        self.rewound = self.pending = -1
        self.ord = 0

    def close(self) -> list[tuple]:
        done = []
        if self.message is not None:
            role, parts = self.message
            done = [(self.conv[0], self.ord, *render(role, "".join(parts)))]
            self.ord += 1
        self.message = None
        return done

    def take(self, conv, msg, copy, seq, kind, role, text) -> list[tuple]:
        done = []
        if self.conv is None or self.conv[0] != conv:
            done = self.close()
            self.conv, self.key, self.rewound, self.pending, self.ord = (conv,), None, -1, -1, 0
        if self.key != (msg, copy):
            done += self.close()
            self.rewound = max(self.rewound, self.pending) if self.key is None or self.key[0] != msg else self.rewound
            self.key = (msg, copy)
        if seq < self.rewound:
            return done
        text = text or ""
        if kind == "open":
            self.message = (role or "", [text])
        elif kind == "delete":
            self.message = None
        else:
            if self.message is None:
                self.message = (role or "", [])
            if kind == "edit":
                self.message = (self.message[0], [text])
            elif kind == "regenerate":
                self.message = (self.message[0], [text])
                self.pending = max(self.pending, seq)
            else:
                self.message[1].append(text)
        return done


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    fold = Fold()
    for b in batches:
        rows = [m for event in zip(*(c.to_pylist() for c in b.columns), strict=True) for m in fold.take(*event)]
        yield _messages(rows)
    yield _messages(fold.close())


def _messages(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    columns = list(zip(*rows, strict=True)) or [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["conv_id", "ord", "formatted", "loss_start", "loss_end"])


def format_events(events: DataFrame) -> DataFrame:
    """The formatted messages (MESSAGE) of an event log (EVENT; ``copy`` tells equal rows apart)."""
    prepare(events.sparkSession)
    order = ["conv_id", "msg", "copy", "seq"]
    logs = events.select(*[c.split()[0] for c in EVENT.split(", ")]).repartition("conv_id").sortWithinPartitions(*order, "kind", "text")
    return logs.mapInArrow(_fold, MESSAGE)


def conversation_events(conversations: DataFrame, delta_chars: int = DELTA_CHARS) -> DataFrame:
    """A log that streams these rows the way a chat service records them, detours included.

    By a hash of its row a message is streamed plainly, drafted and then edited, or (assistant messages)
    answered with a draft, regenerated and streamed anew; every fourth row is preceded by a message that
    is deleted again.  A regeneration rewinds the conversation, so later messages also have an attempt
    that was recorded before it.  Sequence numbers rise with turns: a turn's final events come after any
    rewind of an earlier one, and attempts come before all.  Folding the log gives the rows back.

    Equal rows are counted first, so however often a row is repeated it crosses the network once;
    rows that share a turn but differ are told apart by a hash of role and text.  Turns past 2**39
    either way, and null ones, are streamed without detours.
    """
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("msg"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    rows = rows.groupBy("conv_id", "msg", "role", "text").agg(F.count(F.lit(1)).alias("n"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("nth"))
    own = F.xxhash64("role", "text")
    # copies are even, so a message beside one's own has a number of its own
    copy = F.when((F.col("n") == 1), own - F.pmod(own, F.lit(2))).otherwise(own - F.pmod(own, F.lit(1 << 32)) + 2 * F.col("nth"))
    near = F.coalesce(F.col("msg").between(-(1 << 39), (1 << 39) - 1), F.lit(False))
    way = F.when(near, F.pmod(F.xxhash64("conv_id", "msg", "text"), F.lit(4)).cast("int")).otherwise(F.lit(0))
    # final events of a turn begin at its own number; null and far turns come after all rewinds
    first = F.when(near, (F.col("msg") + (1 << 39)) * (1 << 22)).otherwise(F.lit(LAST))
    rows = rows.select("conv_id", "msg", copy.alias("copy"), "role", "text", way.alias("way"), (first + 8).alias("first"))

    def event(seq, kind: str, text) -> Column:
        return F.struct(F.lit(seq).cast("bigint").alias("seq") if isinstance(seq, int) else seq.cast("bigint").alias("seq"), F.lit(kind).alias("kind"), text.alias("text"))

    at, none = F.col("first"), F.lit("")
    draft = F.concat(F.lit("draft: "), F.reverse(F.left("text", F.lit(40))))
    parts = F.regexp_extract_all("text", F.lit(rf"((?s).{{1,{delta_chars}}})"), F.lit(1))
    rest = lambda kept: F.transform(kept, lambda t, i: F.struct((i + 3).cast("bigint").alias("after"), t.alias("text")))
    deltas = lambda kept: F.transform(rest(kept), lambda p: F.struct(p["after"].alias("seq"), F.lit("delta").alias("kind"), p["text"].alias("text")))
    plain = F.concat(F.array(event(0, "open", none)), deltas(parts))
    edited = F.concat(
        F.array(event(0, "open", draft), event(1, "delta", draft), event(2, "edit", F.coalesce(F.get(parts, F.lit(0)), none))),
        deltas(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))),
    )
    again = F.concat(F.array(event(0, "open", none), event(1, "delta", draft), event(2, "regenerate", none)), deltas(parts))
    final = F.when(F.col("way") == 1, edited).when((F.col("way") == 2) & (F.col("role") == "assistant"), again).otherwise(plain)
    before = F.when(F.col("way") > 0, F.array(event(0, "open", none), event(1, "delta", draft))).otherwise(F.array().cast(_EVENTS))
    told = rows.select("conv_id", "msg", "copy", "role", "way", "first", "text", before.alias("before"), final.alias("final"))
    shown = F.concat("before", F.transform("final", lambda e: F.struct((e["seq"] + F.col("first")).alias("seq"), e["kind"].alias("kind"), e["text"].alias("text"))))
    kept = told.select("conv_id", "msg", "copy", "role", F.explode(shown).alias("e"))
    # a message of its own beside the row's, deleted before the conversation goes on
    gone = F.array(event(at, "open", draft), event(at + 1, "delta", draft), event(at + 2, "delete", none))
    ghosts = F.array(F.lit("user"), F.lit("assistant"))
    ghost = F.element_at(ghosts, (F.pmod(F.xxhash64("copy"), F.lit(2)) + 1).cast("int"))
    deleted = told.where("way = 3").select("conv_id", "msg", (F.col("copy") + F.lit(1)).alias("copy"), ghost.alias("role"), F.explode(gone).alias("e"))
    both = kept.unionByName(deleted)
    return both.select("conv_id", "msg", "copy", "e.seq", "e.kind", "role", "e.text")


def digest_conversations(formatted: DataFrame) -> DataFrame:
    """Per conversation, read back from its formatted messages: turn and loss digests."""
    fields = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, rows = None, None, []

        def flush() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) or [()] * 6
            rows.clear()
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=[f.split()[0] for f in fields.split(", ")])

        def close() -> None:
            if state:
                rows.append((now[0], state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

        for b in batches:
            for conv, _, text, start, end in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if now != (conv,):
                    close()
                    now, state = (conv,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, said = parse(text)
                state[0] += 1
                state[1].update(f"{role}\n{said}\n".encode())
                learned = unescape(text[start:end])
                state[2] += len(learned)
                state[3].update(learned.encode())
                state[4] += len(text)
            yield flush()
        close()
        yield flush()

    return formatted.repartition("conv_id").sortWithinPartitions("conv_id", "ord").mapInArrow(run, fields)


def format_conversations(spark: SparkSession, conversations: DataFrame, path: str | None = None) -> DataFrame:
    """Write the formatted messages under ``path`` and return the table read back."""
    path = path or shared_folder(spark, "chat")
    format_events(conversation_events(conversations)).write.parquet(path)
    return spark.read.schema(MESSAGE).parquet(path)


PROBE = "</s>[INST] ok [/INST]"


def with_probe(conversations: DataFrame) -> DataFrame:
    """The table plus conversation -7, whose texts look like another template's marks."""
    probe = conversations.sparkSession.createDataFrame(
        [(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], "conv_id bigint, turn bigint, role string, text string"
    )
    rows = conversations.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), F.col("role").cast("string"), F.col("text").cast("string"))
    return rows.unionByName(probe)


_SQL_ESCAPED = "replace({}, '\\', '\\\\')"
for _c in CONTROL:
    _SQL_ESCAPED = f"replace({_SQL_ESCAPED}, '{_c}', '{_c[0]}\\{_c[1:]}')"

ORACLE_SQL = f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{PROBE}' UNION ALL SELECT -7, 1, 'assistant', '{PROBE}')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length({_SQL_ESCAPED.format('role')}) + length({_SQL_ESCAPED.format('text')}) + {len('<| |>') + 1 + len(END)}) AS BIGINT) AS formatted_chars
FROM rows GROUP BY conv_id"""
