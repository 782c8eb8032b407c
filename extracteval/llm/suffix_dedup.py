"""Exact removal of repeated passages with suffix arrays (operator 12).

A byte goes if a string of ``length`` bytes that covers it also starts anywhere else, in the same
document or another.  A window is such a string.  Three steps, every one over all windows:

1. Candidates.  A window's anchor is its part of ``length // 4`` bytes with the least hash, so equal windows
   have equal anchors.  Chunks of documents send the fingerprints of all anchors packed by range, and get back
   those that occur more than once (see ``prints``).  Windows with an anchor that occurs once are unique.
2. Shards.  Neighbouring candidate windows with one anchor form a segment.  Equal segments are
   counted and go on as one; the shard of a segment depends on its anchor, so equal windows meet.  A
   shard's suffix array is induced over its segments, and a window is repeated if it shares ``length`` bytes with
   a neighbour in suffix order, which the permuted common prefixes tell, or if its segment occurs twice.
   Only an anchor whose segments are all one text stays out of the shards: its windows can equal
   each other alone, and all are repeated.
3. Removal.  Repeated windows go back to the chunks of all segments like theirs, which cut them.

An anchor that many different segments share (a line that a third of all documents hold) is made
longer, by half of what its windows leave free, to the right where it stands in their left half and to the left
elsewhere.  This splits its segments into groups with fewer windows each, until a group is small; an
anchor as long as the window has one text.  So no group is larger than a shard, and no window is lost.

Defined results: null and empty texts have no byte and nothing is removed; texts shorter than ``length`` are kept;
texts of any length are taken whole; null ids are kept as they are; repeated rows are copies of each other, so both
lose what they share; an empty table gives no row; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from extracteval.llm.common import prepare, stored, text_or_empty
from extracteval.llm.prints import LEFT_OUT, Polynomial, counted, pack48, range_bounds, starts, unpack48
from extracteval.llm.suffixes import permuted_prefixes, suffix_array

LENGTH = 200
CHUNK_BYTES = 8 << 20
RANGE_PRINTS = 1 << 20
STEP = 1 << 16  # windows worked on at a time; their arrays stay in a core's cache
RUN = 512  # windows of a segment; longer runs (of one repeated letter, say) are cut
SHARD_BYTES = 2 << 20
HOT_BYTES = 1 << 18  # of the segments with one anchor; an eighth of a shard


@lru_cache(maxsize=1)
def _hashes() -> Polynomial:
    return Polynomial(12)


def _least(x: np.ndarray, size: int, pick=np.minimum) -> np.ndarray:
    """Least of every ``size`` neighbouring values, by doubling."""
    width = 1
    while width * 2 <= size:
        x = pick(x[:-width], x[width:])
        width *= 2
    return pick(x[: len(x) - (size - width)], x[size - width :]) if width < size else x


def _leftmost(x: np.ndarray, size: int) -> np.ndarray:
    """Place of the first least of every ``size`` neighbouring values."""
    at, width = np.arange(len(x)), 1
    while True:
        step = min(width, size - width)
        if not step:
            return at
        left, right = at[: len(at) - step], at[step:]
        at = np.where(x[right] < x[left], right, left)
        width += step


def anchor_keys(raw: np.ndarray, length: int, level: int = 0) -> np.ndarray:
    """A hash of the anchor of each window of ``raw``; by ``level`` anchors are made longer."""
    size, poly = max(1, length // 4), _hashes()
    if len(raw) < length:
        return np.zeros(0, dtype=np.uint64)
    total = poly.sums(raw)
    kmers = poly.windows(total, size)
    if not level:
        return _least(kmers, length - size + 1)
    at = _leftmost(kmers, length - size + 1)
    window = np.arange(len(at))
    for _ in range(level):
        free = length - size
        more = -(-free // 2)
        at = np.where(at - window > free // 2, at - more, at)
        size += more
    return poly.parts(total, at, at + size)


def levels(length: int) -> int:
    """Levels after which an anchor is as long as its window."""
    size, n = max(1, length // 4), 0
    while size < length:
        size, n = size + -(-(length - size) // 2), n + 1
    return n


def _inside(ends: np.ndarray, begin: int, stop: int, length: int) -> np.ndarray:
    """Whether each window that starts in [begin, stop) ends within its document."""
    at = np.arange(begin, stop)
    return at + length <= ends[np.minimum(np.searchsorted(ends, at, side="right"), len(ends) - 1)]


def _steps(body: bytes, ends: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first window, bytes, keys, inside) for stretches of the windows of a chunk."""
    for begin in range(0, max(0, len(body) - length + 1), STEP):
        stop = min(begin + STEP, len(body) - length + 1)
        raw = np.frombuffer(body, np.uint8, stop - begin + length - 1, begin)
        yield begin, raw, anchor_keys(raw, length), _inside(ends, begin, stop, length)


def anchor_prints(body: bytes, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct fingerprints of the anchors of a chunk: those that stand in one place, and the others."""
    size, found = max(1, length // 4), []
    for _, raw, keys, inside in _steps(body, ends, length):
        poly = _hashes()
        kmers = poly.windows(poly.sums(raw), size)
        # a part is an anchor if it is the least of a window around it, that is of the one with the largest least
        span = length - size + 1
        pad = np.zeros(span - 1, np.uint64)
        most = _least(np.concatenate([pad, np.where(inside, keys, np.uint64(0)), pad]), span, np.maximum)
        found.append(kmers[kmers == most] >> LEFT_OUT)
    prints, n = counted(np.concatenate(found) if found else np.zeros(0, np.uint64))
    return prints[n == 1], prints[n > 1]


def segments(raw: np.ndarray, keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first windows, windows) of the runs of ``wanted`` neighbouring windows with one key."""
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.concatenate([[True], (keys[1:] != keys[:-1]) | (wanted[1:] != wanted[:-1])])
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(keys)))
    first, n = first[wanted[first]], n[wanted[first]]
    cuts = -(-n // RUN)
    part = np.arange(int(cuts.sum())) - np.repeat(np.cumsum(cuts) - cuts, cuts)
    begin = np.repeat(first, cuts) + part * RUN
    return begin, np.minimum(RUN, np.repeat(first + n, cuts) - begin)


def _digest(text: bytes) -> bytes:
    return hashlib.blake2b(text, digest_size=16).digest()


def document_chunks(docs: DataFrame, size: int = CHUNK_BYTES) -> DataFrame:
    """(chunk, bytes, ids, sizes, body): documents by about ``size`` bytes of text, compressed; stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, held, ids, texts = TaskContext.get().partitionId() << 32, 0, 0, [], []

        def close() -> pa.RecordBatch:
            body = b"".join(texts)
            return pa.RecordBatch.from_pydict(
                {
                    "chunk": pa.array([task + number], pa.int64()), "bytes": pa.array([len(body)], pa.int64()),
                    "ids": pa.array([ids], pa.list_(pa.int64())), "sizes": pa.array([[len(t) for t in texts]], pa.list_(pa.int64())),
                    "body": pa.array([pa.compress(body, codec="zstd", asbytes=True)], pa.binary()),
                }
            )

        for b in batches:
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids.append(i)
                texts.append(text.encode())
                held += len(texts[-1])
                if held >= size:
                    yield close()
                    number, held, ids, texts = number + 1, 0, [], []
        if ids:
            yield close()

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    schema = "chunk bigint, bytes bigint, ids array<bigint>, sizes array<bigint>, body binary"
    return stored(rows.mapInArrow(run, schema), "suffix-chunks")


def _opened(size: int, sizes: list[int], body: bytes) -> tuple[bytes, np.ndarray]:
    return pa.decompress(body, size, codec="zstd", asbytes=True), np.cumsum(sizes, dtype=np.int64)


def repeated_prints(chunks: DataFrame, length: int, ranges: int) -> DataFrame:
    """(chunk, prints): for each range, the packed fingerprints of a chunk's anchors that stand in several places."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = range_bounds(ranges)
        for b in batches:
            for chunk, *row in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                once, more = anchor_prints(*_opened(*row), length)
                a, c = np.searchsorted(once, bounds), np.searchsorted(more, bounds)
                rows = [r for r in range(ranges) if a[r] < a[r + 1] or c[r] < c[r + 1]]
                yield pa.RecordBatch.from_pydict(
                    {
                        "chunk": pa.array([chunk] * len(rows), pa.int64()), "range": pa.array(rows, pa.int64()),
                        "once": pa.array([pack48(once[a[r] : a[r + 1]]) for r in rows], pa.binary()),
                        "more": pa.array([pack48(more[c[r] : c[r + 1]]) for r in rows], pa.binary()),
                    }
                )

    def answer(table: pa.Table) -> pa.Table:
        once, more = ([unpack48(x) for x in table.column(c).to_pylist()] for c in ("once", "more"))
        # those of several places in a chunk count twice
        prints = np.concatenate(once + more + more)
        order = np.argsort(prints, kind="stable")
        first = starts(prints[order])
        n = np.diff(np.append(first, len(prints)))
        repeated = np.empty(len(prints), bool)
        repeated[order] = np.repeat(n > 1, n)
        kept = np.split(repeated, np.cumsum([len(x) for x in once]))
        blobs = [pack48(x[k]) + pack48(m) for x, k, m in zip(once, kept[:-1], more, strict=True)]
        return pa.table({"chunk": table.column("chunk"), "prints": pa.array(blobs, pa.binary())})

    sent = chunks.select("chunk", "bytes", "sizes", "body").mapInArrow(send, "chunk bigint, range bigint, once binary, more binary")
    return sent.groupBy("range").applyInArrow(answer, "chunk bigint, prints binary")


def candidate_segments(chunks: DataFrame, repeated: DataFrame, length: int) -> DataFrame:
    """(key, digest, chunk, start, windows, text): all candidate segments, stored; of equal ones of a chunk one holds
    the text."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        (chunk,) = left.column("chunk").to_pylist()
        (row,) = list(zip(*(left.column(c).to_pylist() for c in ("bytes", "sizes", "body")), strict=True))
        body, ends = _opened(*row)
        repeated = np.sort(unpack48(b"".join(right.column("prints").to_pylist())))
        keys_out, digests, begins, sizes, texts, known = [], [], [], [], [], set()
        for at, raw, keys, inside in _steps(body, ends, length):
            prints = keys >> LEFT_OUT
            if not len(repeated):
                break
            begin, n = segments(raw, keys, inside)
            found = repeated[np.minimum(np.searchsorted(repeated, prints[begin]), len(repeated) - 1)] == prints[begin]
            begin, n = begin[found], n[found]
            for b, m in zip((begin + at).tolist(), n.tolist(), strict=True):
                text = body[b : b + m + length - 1]
                digests.append(_digest(text))
                texts.append(None if digests[-1] in known else text)
                known.add(digests[-1])
                begins.append(b)
            keys_out.append(keys[begin])
            sizes.append(n)
        keys = np.concatenate(keys_out).view(np.int64) if keys_out else np.zeros(0, np.int64)
        return pa.table({
            "key": pa.array(keys), "digest": pa.array(digests, pa.binary()), "chunk": pa.array([chunk] * len(begins), pa.int64()),
            "start": pa.array(begins, pa.int64()), "windows": pa.array(np.concatenate([*sizes, np.zeros(0, np.int64)]), pa.int64()),
            "text": pa.array(texts, pa.binary()),
        })

    columns = chunks.select("chunk", "bytes", "sizes", "body")
    found = columns.groupBy("chunk").cogroup(repeated.groupBy("chunk")).applyInArrow(run, "key bigint, digest binary, chunk bigint, start bigint, windows bigint, text binary")
    return stored(found, "suffix-segments")


def shard_repeats(texts: list[bytes], counts: list[int], length: int) -> list[list[tuple[int, int]]]:
    """Runs (first window, windows) of the repeated windows of each segment of a shard."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    # symbols: 0 the sentinel, 1 the end of a segment, bytes from 2
    joined = np.frombuffer(b"".join(texts), np.uint8).astype(np.int64) + 2
    stops = np.cumsum(sizes)
    symbols = np.append(np.insert(joined, stops, 1), 0)
    begin = stops - sizes + np.arange(len(sizes))
    prefix, before = permuted_prefixes(symbols, suffix_array(symbols), 1)
    long = np.flatnonzero(prefix >= length)
    repeated = np.zeros(len(symbols), bool)
    repeated[long] = True
    repeated[before[long]] = True
    out = []
    for b, size, n in zip(begin.tolist(), sizes.tolist(), counts, strict=True):
        windows = size - length + 1
        if n > 1:
            out.append([(0, windows)])
            continue
        edge = np.flatnonzero(np.diff(np.concatenate([[0], repeated[b : b + windows].astype(np.int8), [0]])))
        out.append(list(zip(edge[::2].tolist(), (edge[1::2] - edge[::2]).tolist(), strict=True)))
    return out


def _shard_runs(distinct: DataFrame, length: int, shards: int) -> DataFrame:
    """(digest, first, windows): repeated windows of the segments in ``distinct``, by shards."""

    def run(table: pa.Table) -> pa.Table:
        digests, texts, counts = (table.column(c).to_pylist() for c in ("digest", "text", "n"))
        rows = [(d, *x) for d, runs in zip(digests, shard_repeats(texts, counts, length), strict=True) for x in runs]
        d, first, n = zip(*rows, strict=True) if rows else ((), (), ())
        return pa.table({"digest": pa.array(d, pa.binary()), "first": pa.array(first, pa.int64()), "windows": pa.array(n, pa.int64())})

    dealt = distinct.select(F.pmod(F.xxhash64("key"), F.lit(shards)).alias("shard"), "digest", "text", "n")
    return dealt.groupBy("shard").applyInArrow(run, "digest binary, first bigint, windows bigint")


def _split(hot: DataFrame, length: int, level: int) -> DataFrame:
    """(whole, offset, key, digest, n, windows, text): segments of ``hot`` cut by their longer anchors; stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for digest, text, n in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                raw = np.frombuffer(text, np.uint8)
                keys = anchor_keys(raw, length, level)
                begin, size = segments(raw, keys, np.ones(len(keys), bool))
                for k, x, m in zip(keys[begin].view(np.int64).tolist(), begin.tolist(), size.tolist(), strict=True):
                    part = text[x : x + m + length - 1]
                    rows.append((digest, x, k, _digest(part), n, m, part))
            columns = zip(*rows, strict=True) if rows else [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    names = ["whole", "offset", "key", "digest", "n", "windows", "text"]
    kinds = [pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary()]
    schema = ", ".join(f"{n} {'binary' if pa.types.is_binary(k) else 'bigint'}" for n, k in zip(names, kinds, strict=True))
    return stored(hot.select("digest", "text", "n").mapInArrow(run, schema), "suffix-split")


def repeated_runs(rows: DataFrame, length: int, level: int = 0, hot_bytes: int = HOT_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(digest, first, windows): the repeated windows of the segments in stored ``rows``.

    ``rows`` has key, digest, windows, n (occurrences) and text, which one of equal segments holds.
    """
    texts = rows.groupBy("key", "digest").agg(F.sum("n").alias("n"), F.max("windows").alias("windows"))
    size = F.col("windows") + (length - 1)
    keys = texts.groupBy("key").agg(F.sum(size).alias("bytes"), F.count(F.lit(1)).alias("texts"), F.min("n").alias("least"))
    # 0: all segments are one text; 2: too many for a shard
    hot = F.col("bytes") > hot_bytes if level < levels(length) else F.lit(False)
    kind = F.when((F.col("texts") == 1) & (F.col("least") > 1), 0).when(hot, 2).otherwise(1)
    kinds = stored(keys.select("key", "bytes", kind.alias("kind")), "suffix-keys")
    shares = {r.kind: r.bytes for r in kinds.groupBy("kind").agg(F.sum("bytes").alias("bytes")).collect()}
    runs = texts.join(kinds.where("kind = 0").select("key"), "key").select("digest", F.lit(0).cast("bigint").alias("first"), "windows")
    # only segments that others may overlap carry their text on
    mixed = rows.join(kinds.where("kind > 0").select("key", "kind"), "key")
    distinct = stored(mixed.groupBy("key", "kind", "digest").agg(F.any_value("text", True).alias("text"), F.sum("n").alias("n")), "suffix-distinct")
    shards = max(1, -(-shares.get(1, 0) // shard_bytes))
    runs = runs.unionByName(_shard_runs(distinct.where("kind = 1"), length, shards))
    if 2 not in shares:
        return runs
    split = _split(distinct.where("kind = 2"), length, level + 1)
    deeper = repeated_runs(split, length, level + 1, hot_bytes, shard_bytes)
    places = split.select("whole", "digest", "offset")
    back = deeper.join(places, "digest").select(F.col("whole").alias("digest"), (F.col("offset") + F.col("first")).alias("first"), "windows")
    return runs.unionByName(back)


def remove_repeats(docs: DataFrame, length: int = LENGTH, hot_bytes: int = HOT_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """doc_id, n_bytes, spans (array of begin and end of each removed run), kept (binary) for every row."""
    prepare(docs.sparkSession)
    chunks = document_chunks(docs)
    # about two anchors for each three quarters of a window
    size = chunks.agg(F.sum("bytes")).first()[0] or 0
    ranges = max(1, 2 * size // (length - length // 4) // RANGE_PRINTS)
    found = candidate_segments(chunks, repeated_prints(chunks, length, ranges), length)
    runs = stored(repeated_runs(found.withColumn("n", F.lit(1).cast("bigint")), length, 0, hot_bytes, shard_bytes), "suffix-runs")
    places = found.select("digest", "chunk", "start").join(runs, "digest").select("chunk", (F.col("start") + F.col("first")).alias("first"), "windows")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        (row,) = list(zip(*(left.column(c).to_pylist() for c in ("bytes", "sizes", "body")), strict=True))
        body, ends = _opened(*row)
        change = np.zeros(len(body) + 1, dtype=np.int64)
        first = right.column("first").to_numpy()
        np.add.at(change, first, 1)
        np.add.at(change, first + right.column("windows").to_numpy() + length - 1, -1)
        gone = np.cumsum(change[:-1]) > 0
        begins = ends - np.array(row[1], dtype=np.int64)
        kept, spans = [], []
        for b, e in zip(begins.tolist(), ends.tolist(), strict=True):
            cut = gone[b:e]
            edge = np.flatnonzero(np.diff(np.concatenate([[0], cut.astype(np.int8), [0]])))
            spans.append([{"begin": x, "end": y} for x, y in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)])
            kept.append(np.frombuffer(body, np.uint8, e - b, b)[~cut].tobytes() if len(edge) else body[b:e])
        kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
        return pa.table({
            "doc_id": pa.array(left.column("ids").to_pylist()[0], pa.int64()), "n_bytes": pa.array(row[1], pa.int64()),
            "spans": pa.array(spans, kind), "kept": pa.array(kept, pa.binary()),
        })

    schema = "doc_id bigint, n_bytes bigint, spans array<struct<begin: bigint, end: bigint>>, kept binary"
    return chunks.groupBy("chunk").cogroup(places.groupBy("chunk")).applyInArrow(run, schema)


def repeat_digests(removed: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    gone = F.aggregate("spans", F.lit(0).cast("bigint"), lambda total, s: total + s["end"] - s["begin"])
    return removed.select(
        "doc_id", "n_bytes", gone.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


# The same from a digest of every 200-byte string (two hex digits a byte).
ORACLE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
p AS (SELECT r, h, unnest(range(0, strlen(h) // 2, 100)) AS a FROM d),
q AS (SELECT r, a, substr(h, 2 * a + 1, 600) AS part FROM p),
w AS (
  SELECT r, a + j AS i, substr(part, 2 * j + 1, 2) AS byte, CASE WHEN strlen(part) >= 2 * j + 400 THEN md5(substr(part, 2 * j + 1, 400)) END AS k
  FROM (SELECT r, a, part, unnest(range(0, least(100, strlen(part) // 2))) AS j FROM q)
), n AS (SELECT k FROM w WHERE k IS NOT NULL GROUP BY k HAVING count(*) > 1),
c AS (
  SELECT r, i, byte, max(CAST(n.k IS NOT NULL AS INTEGER)) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 199 PRECEDING AND CURRENT ROW) AS gone
  FROM w LEFT JOIN n ON n.k = w.k
), s AS (SELECT *, lag(gone, 1, 0) OVER (PARTITION BY r ORDER BY i) AS before FROM c),
g AS (
  SELECT r, sum(gone) AS n_removed, count_if(gone = 1 AND before = 0) AS n_spans, string_agg(byte, '' ORDER BY i) FILTER (WHERE gone = 0) AS kept
  FROM s GROUP BY r
)
SELECT doc_id, CAST(strlen(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN g ON g.r = d.r
"""
