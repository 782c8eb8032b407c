"""Benchmark decontamination by q-gram lemma filtering (operator 9).

Texts are normalised (lower case, runs of other than letters and digits become one space) and
read as UTF-8 bytes.  An occurrence of an item of m bytes with at most e = RATE * m edits shares at
least m + 1 - q (e + 1) q-grams with it, on diagonals that span at most e.  Shared q-grams are
counted in overlapping diagonal bands of 2 (e + 1), one starting every e + 1, so one band holds
them all.  Bands that reach the bound are verified by banded alignment of the whole item.

The index of the items is sent to every task in chunks of about ``CHUNK_BYTES`` of item text.  Each chunk
is a job of its own whose result is written and whose broadcast is destroyed before the next, so the
memory of a worker and of the driver does not grow with the benchmark; a larger one takes more passes
over the documents and misses nothing.

Defined results: null and empty texts hold no item; texts of any length are searched whole; items too short
for the bound to be positive (under 25 bytes or so) are matched exactly at word boundaries; null and blank
items are skipped; of items with equal normalised text each is reported; of an item's occurrences in a
text the first with the least edits is reported; repeated rows each report; other columns are not read.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from extracteval.llm.common import prepare, shared_folder, stored

Q = 8
RATE = 0.08
CHUNK_BYTES = 4 << 20
_WORDS = re.compile(r"[^\W_]+").findall
_TABLE_BITS = 22
_MIX = np.uint64(0x9E3779B97F4A7C15)


def normalise(text: str | None) -> bytes:
    return " ".join(_WORDS((text or "").lower())).encode()


def qgrams(data: bytes) -> np.ndarray:
    """Every q-gram of 8 bytes as an unsigned integer."""
    if len(data) < Q:
        return np.zeros(0, dtype="<u8")
    return np.ndarray((len(data) - Q + 1,), dtype="<u8", buffer=data, strides=(1,))


def banded_edits(item: bytes, window: bytes, budget: int) -> tuple[int, int]:
    """Least edits of the whole ``item`` against any part of ``window``, and that part's end.

    Row i holds the diagonals; a part may start at any of them.  Edits over the budget: budget + 1.
    """
    m, width = len(item), len(window) - len(item) + 1 + 2 * budget
    if width <= 0:
        return budget + 1, 0
    # diagonal j of row i reads window[i + j - budget - 1]
    padded = np.frombuffer(b"\0" * budget + window + b"\0" * (budget + 1), dtype=np.uint8)
    outside = budget + 1
    shift = np.arange(width)
    row = np.zeros(width, dtype=np.int64)
    row[:budget] = outside  # a part cannot start before the window
    for i, letter in enumerate(item):
        read = padded[i : i + width]
        step = row + (read != letter)
        up = np.append(row[1:], outside) + 1
        row = np.minimum(step, up)
        row = np.minimum(np.minimum.accumulate(row - shift) + shift, outside)
        if row.min() >= outside:
            return outside, 0
    best = int(row.argmin())
    return int(row[best]), min(len(window), m + best - budget)


class ItemIndex:
    def __init__(self, items: list[tuple[int, bytes]]):
        self.ids = [i for i, _ in items]
        self.texts = [t for _, t in items]
        size = np.array([len(t) for t in self.texts], dtype=np.int64)
        self.budget = np.floor(RATE * size).astype(np.int64)
        self.need = size + 1 - Q * (self.budget + 1)
        # short items by their first word
        self.short: dict[bytes, list[tuple[int, bytes]]] = {}
        for k in range(len(items)):
            if self.need[k] < 1 and self.texts[k]:
                self.short.setdefault(self.texts[k].split(b" ", 1)[0], []).append((k, self.texts[k]))
        long = [k for k in range(len(items)) if self.need[k] >= 1]
        grams = [qgrams(self.texts[k]) for k in long]
        code = np.concatenate([*grams, np.zeros(0, "<u8")]).astype(np.uint64)
        owner = np.repeat(np.array(long, dtype=np.int64), [len(g) for g in grams]) if long else np.zeros(0, np.int64)
        place = np.concatenate([np.arange(len(g)) for g in grams] + [np.zeros(0, np.int64)]).astype(np.int64)
        order = np.argsort(code, kind="stable")
        self.owner, self.place = owner[order], place[order]
        self.code, self.first, self.count = np.unique(code[order], return_index=True, return_counts=True)
        self.seen = np.zeros(1 << _TABLE_BITS, dtype=bool)
        self.seen[self.slot(self.code)] = True
        self.least = int(self.need[long].min()) if long else 1 << 62

    @staticmethod
    def slot(code: np.ndarray) -> np.ndarray:
        return (code * _MIX) >> np.uint64(64 - _TABLE_BITS)

    def find(self, data: bytes) -> list[tuple[int, int, int, int]]:
        """(item, edits, start, end) of every item that occurs; start and end in normalised bytes."""
        found = {}
        if self.short:
            at = 0
            for word in data.split(b" "):
                for k, text in self.short.get(word, ()):
                    end = at + len(text)
                    if k not in found and data.startswith(text, at) and data[end : end + 1] in (b"", b" "):
                        found[k] = (0, at, end)
                at += len(word) + 1
        grams = qgrams(data)
        at = np.flatnonzero(self.seen[self.slot(grams)]) if len(grams) >= self.least else np.zeros(0, np.int64)
        if len(at) >= self.least:
            where = np.minimum(np.searchsorted(self.code, grams[at]), len(self.code) - 1)
            same = self.code[where] == grams[at]
            at, where = at[same], where[same]
            n = self.count[where]
            pick = np.repeat(self.first[where] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            item = self.owner[pick]
            diagonal = np.repeat(at, n) - self.place[pick]
            step = self.budget[item] + 1
            band = diagonal // step
            base = int(band.min(initial=0)) - 1
            span = int(band.max(initial=0)) - base + 2
            keys, counts = np.unique(np.concatenate([item * span + band - base, item * span + band - 1 - base]), return_counts=True)
            full = counts >= self.need[keys // span]
            for key in keys[full].tolist():
                k, b = key // span, key % span + base
                if found.get(k, (1,))[0]:
                    hit = self.verify(data, k, b)
                    if hit and hit[0] < found.get(k, (1 << 30,))[0]:
                        found[k] = hit
        return [(k, *found[k]) for k in sorted(found)]

    def verify(self, data: bytes, k: int, band: int) -> tuple[int, int, int] | None:
        text, e = self.texts[k], int(self.budget[k])
        low = max(0, band * (e + 1) - e)
        window = data[low : max(0, (band + 2) * (e + 1)) + len(text) + e]
        at = window.find(text)
        if at >= 0:
            return 0, low + at, low + at + len(text)
        edits, end = banded_edits(text, window, e)
        return (edits, max(0, low + end - len(text)), low + end) if edits <= e else None


def item_chunks(benchmark: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> Iterator[list[tuple[int, bytes]]]:
    """The benchmark's normalised items, one bounded chunk after another."""
    items = benchmark.where(F.col("text").isNotNull()).select("item_id", "text")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-size // chunk_bytes)
    for k in range(n):
        rows = items.where(F.pmod(F.xxhash64("text", "item_id"), F.lit(n)) == k).collect()
        yield sorted({(r.item_id, t) for r in rows if (t := normalise(r.text))}, key=lambda x: (x[0] is None, x[0] or 0, x[1]))


def _found(share, names: list[str]):
    """Rows of the first input column beside each item that the text in the second holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = ItemIndex(share.value)
        for b in batches:
            rows = [
                (doc, index.ids[k], edits, start, end)
                for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)
                for k, edits, start, end in index.find(normalise(text))
            ]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    return run


def _leaks(docs: DataFrame, benchmark: DataFrame, key: str, chunk_bytes: int) -> DataFrame:
    """``key``, item_id, edits, start, end for every text and item of ``docs`` (key, text), from one stored table."""
    spark = prepare(docs.sparkSession)
    fields, path = LEAK.replace("doc_id", key), shared_folder(spark, "leaks")
    names, some = [f.split()[0] for f in fields.split(", ")], False
    for k, items in enumerate(item_chunks(benchmark, chunk_bytes)):
        share = spark.sparkContext.broadcast(items)
        docs.mapInArrow(_found(share, names), fields).write.parquet(f"{path}/chunk={k}")
        share.destroy()
        some = True
    if not some:
        return spark.createDataFrame([], fields)
    return spark.read.schema(fields + ", chunk int").parquet(path).drop("chunk")


def find_leaks(docs: DataFrame, benchmark: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """doc_id, item_id, edits, start, end (of the normalised text, in bytes): a row for each document and item it holds."""
    return _leaks(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), benchmark, "doc_id", chunk_bytes)


LEAK = "doc_id bigint, item_id bigint, edits bigint, start bigint, end bigint"


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item.

    A benchmark of one chunk is a filter where the rows are.  For a larger one the rows are numbered and
    written once, leaks name them by number, and an anti-join takes them out.
    """
    spark = prepare(docs.sparkSession)
    chunks = list(itertools.islice(item_chunks(benchmark, chunk_bytes), 2))
    if len(chunks) < 2:
        return docs.where(~_holds_item(spark.sparkContext.broadcast(chunks[0]))("text")) if chunks else docs
    rows = stored(docs.select(F.monotonically_increasing_id().alias("uid"), F.struct(*docs.columns).alias("row")), "leak-rows")
    leaks = _leaks(rows.select("uid", F.col("row.text").alias("text")), benchmark, "uid", chunk_bytes)
    return rows.join(leaks.select("uid").distinct(), "uid", "left_anti").select("row.*")


def _holds_item(share):
    @F.pandas_udf("boolean")
    def leaks(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = ItemIndex(share.value)
        for texts in parts:
            yield pd.Series([bool(index.find(normalise(t))) for t in texts], dtype=bool)

    return leaks
