"""Best-fit decreasing packing of token pieces into fixed-length sequences (operator 6).

Best-fit decreasing looks only at lengths, and there are at most ``capacity`` different lengths.
So the corpus is counted by length (one small row a length), and the exact global best-fit
decreasing plan is made over that histogram: a segment tree over remaining capacities finds the
tightest open bin in logarithmic time, and equal lengths are placed a run at a time, which gives
the same bins as placing them one by one.  The plan's size depends on the capacity, never on the
corpus, so sending it to every task has a proven bound.  Pieces are then numbered within their
length (a counter in each task plus the counts of earlier tasks) and look their place up.

Defined results: null and empty texts give one piece holding just the end id; null doc_ids are
kept; repeated rows are packed each; an empty table gives no row; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from extracteval.llm.common import prepare, stored
from extracteval.llm.tokens import encoder

CAPACITY = 4096
END_ID = 1


class OpenBins:
    """Segment tree over remaining capacities: is any bin open with at least so much room?"""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.tree = bytearray(2 * self.leaves)

    def set(self, room: int, there: bool) -> None:
        at = room + self.leaves
        self.tree[at] = there
        while at > 1:
            at //= 2
            self.tree[at] = self.tree[2 * at] | self.tree[2 * at + 1]

    def tightest(self, need: int) -> int | None:
        """The least room >= need of any open bin."""
        at = need + self.leaves
        if self.tree[at]:
            return need
        while at > 1:
            if at % 2 == 0 and self.tree[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at + (not self.tree[2 * at])
                return at - self.leaves
            at //= 2
        return None


def best_fit_plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first ordinal, pieces, pieces a bin, first bin, offset) in placing order.

    Piece ``first + j`` of that length goes to bin ``first bin + j // a bin`` at
    ``offset + (j % a bin) * length``.
    """
    tree, runs, bins, plan = OpenBins(capacity), defaultdict(list), 0, []

    def give(room: int, first: int, n: int) -> None:
        if n and room:
            if not runs[room]:
                tree.set(room, True)
            runs[room].append((first, n))

    for length in sorted((k for k, n in counts.items() if n), reverse=True):
        left, ordinal = counts[length], 0
        while left:
            room = tree.tightest(length)
            if room is None:
                room, each = capacity, capacity // length
                first, n = bins, -(-left // each)
                bins += n
            else:
                each = room // length
                first, n = runs[room].pop()
                if not runs[room]:
                    tree.set(room, False)
            full = min(n, left // each)
            if full:
                plan.append((length, ordinal, full * each, each, first, capacity - room))
                give(room - each * length, first, full)
                ordinal, left = ordinal + full * each, left - full * each
            if full < n and left:  # the last pieces of this length open or reuse one more bin
                plan.append((length, ordinal, left, each, first + full, capacity - room))
                give(room - left * length, first + full, 1)
                give(room, first + full + 1, n - full - 1)
                left = 0
            elif full < n:
                give(room, first + full, n - full)
    return plan


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, spaces: bool, keep_ids: bool) -> DataFrame:
    """One row a piece, numbered within (task, length); stored, so the numbers stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, task, seen = encoder(tokenizer, spaces), TaskContext.get().partitionId(), np.zeros(capacity + 1, dtype=np.int64)
        for b in batches:
            rows = []
            for doc, ids in zip(b.column(0).to_pylist(), enc.ids(b.column(1).to_pylist(), end_id), strict=True):
                wide = ids.astype("<u4")
                for k, at in enumerate(range(0, len(wide), capacity)):
                    part = wide[at : at + capacity]
                    raw = part.tobytes()
                    rows.append((doc, k, at, len(part), zlib.crc32(raw), task, int(seen[len(part)]), *((raw,) if keep_ids else ())))
                    seen[len(part)] += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    fields = "doc_id:int64 piece:int32 start:int64 length:int64 ids_crc32:int64 task:int64 nth:int64".split() + ["ids:binary"] * keep_ids
    schema = pa.schema([(n, getattr(pa, t)()) for n, t in (f.split(":") for f in fields)])
    ddl = ", ".join(f.replace(":int64", " bigint").replace(":int32", " int").replace(":", " ") for f in fields)
    prepare(docs.sparkSession)
    pairs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return stored(pairs.mapInArrow(run, ddl), "token-pieces")


def place_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to stored pieces (length, task, nth)."""
    by_task = pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = by_task.select("length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    counts = {r.length: r.n for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # <= capacity rows
    share = pieces.sparkSession.sparkContext.broadcast(best_fit_plan(counts, capacity))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = np.array(share.value, dtype=np.int64).reshape(-1, 6)
        plan = plan[np.lexsort((plan[:, 1], plan[:, 0]))]
        # one sortable key: ordinals within a length never reach the next length's base
        top = int(plan[:, 1].max(initial=0) + plan[:, 2].max(initial=0)) + 1
        keys = plan[:, 0] * top + plan[:, 1]
        for b in batches:
            length = b.column(names.index("length")).to_numpy()
            nth = b.column(names.index("nth")).to_numpy() + b.column(names.index("before")).to_numpy()
            row = plan[np.searchsorted(keys, length * top + nth, side="right") - 1]
            j = nth - row[:, 1]
            kept = [b.column(names.index(c)) for c in out]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(row[:, 4] + j // row[:, 3]), pa.array(row[:, 5] + j % row[:, 3] * length)], names=[*out, "sequence_id", "offset"])

    joined = pieces.join(before, ["length", "task"])
    names, out = joined.columns, [c for c in pieces.columns if c not in ("task", "nth")]
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema if f.name in out) + ", sequence_id bigint, offset bigint"
    return joined.mapInArrow(run, ddl)


def pack_documents(
    docs: DataFrame, tokenizer: str, end_id: int = END_ID, capacity: int = CAPACITY, spaces: bool = False, keep_ids: bool = False
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids with ``keep_ids``)."""
    return place_pieces(token_pieces(docs, tokenizer, end_id, capacity, spaces, keep_ids), capacity)


def sequences(placed: DataFrame) -> DataFrame:
    """Packed sequences from placed pieces with ids: sequence_id, n_tokens, ids, doc_ids.

    A group is one sequence, so it holds at most ``capacity`` tokens.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "length", "ids", "doc_id")))
    g = placed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), parts.alias("p"))
    joined = F.aggregate("p", F.lit(b""), lambda acc, x: F.concat(acc, x["ids"]))
    return g.select("sequence_id", "n_tokens", joined.alias("ids"), F.transform("p", lambda x: x["doc_id"]).alias("doc_ids"))
