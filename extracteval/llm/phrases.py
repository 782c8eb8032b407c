"""Phrase collocations by SON partitioning (operator 11).

Texts become chunks: lower-cased texts of one language, joined with a line feed, which ends a piece.  The chunks are
dealt into ``SHARDS`` shards.

1. Each chunk counts all its phrases of one to ``longest`` words as 48-bit fingerprints, packed into one
   row for each fingerprint range.  Within a range every shard is mined completely at the local support
   ceil(support / shards): a phrase with the global support reaches it in some shard, since otherwise
   it would have at most shards * (ceil(support / shards) - 1) < support occurrences.  The union of the
   locally frequent fingerprints is counted over all shards, and those that reach the support go back to
   the chunks, as one bit for each fingerprint that a chunk sent.
2. Each chunk counts its candidates as words, and Spark sums them by text, so the counts are exact:
   fingerprints only choose candidates, and two that meet by chance only add one.

A range holds about ``RANGE_BYTES`` of text's fingerprints whatever the input, and one phrase adds at most one of
them a chunk.  Scores are integer divisions of decimals; the first rows of a language are found in two steps.

Defined results: null and empty texts have no words; a null ``lang`` is ``und``; repeated rows count again; a word or
text of any length is taken whole; ties end with the phrase in UTF-8 byte order; an empty table gives no row; other
columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from extracteval.llm.common import prepare, stored, text_or_empty
from extracteval.llm.prints import LEFT_OUT, Polynomial, counted, flagged, pack48, range_bounds, starts, unpack48

SUPPORT = 10
LONGEST = 3
TOP = 2000
CONTAINED = 50  # per cent of a phrase's occurrences inside a longer one
SHARDS = 4
CHUNK_BYTES = 8 << 20
RANGE_BYTES = 8 << 20
STEP = 1 << 16  # bytes worked on at a time; their arrays stay in a core's cache
SALTS = 64

# Bytes that separate words, and bytes that end a piece.
_SPACES = b" \t"
_BREAKS = b".,;:!?\n\x0b\x0c\r"
_SEPARATOR = re.compile(rb"[ \t.,;:!?\n\x0b\x0c\r]")
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[list(_SPACES)] = 1
_KIND[list(_BREAKS)] = 2


@lru_cache(maxsize=2)
def _family(number: int) -> Polynomial:
    return Polynomial(number)


def language_seed(lang: str) -> int:
    seed = 0
    for b in lang.encode():
        seed = (seed * 0x100000001B3 + b + 1) % (1 << 64)
    return seed


def phrases(raw: bytes, seed: int, longest: int, families: int = 1) -> Iterator[list[tuple]]:
    """By steps of bounded size: for each k (hashes by family, begins, ends) of its phrases of k words.

    A step has the phrases whose last word it holds; the last words of a step are carried into the next.
    """
    at, carry, pieces = 0, None, 0
    while at < len(raw):
        stop = len(raw)
        if at + STEP < stop and (cut := _SEPARATOR.search(raw, at + STEP)):
            stop = cut.end()
        step = np.frombuffer(raw, np.uint8, stop - at, at)
        kind = _KIND[step]
        word = np.zeros(len(step) + 2, dtype=bool)
        word[1:-1] = kind == 0
        edges = np.flatnonzero(word[1:] != word[:-1])
        begin, end = edges[::2], edges[1::2]
        piece = np.cumsum(kind == 2)
        hashes = [f.mix(f.parts(f.sums(step), begin, end) ^ np.uint64(seed)) for f in map(_family, range(families))]
        new = [begin + at, end + at, (piece[begin] + pieces), *hashes]
        pieces, at = pieces + int(piece[-1]), stop
        old = len(carry[0]) if carry else 0
        begin, end, piece, *hashes = [np.concatenate(x) for x in zip(carry, new, strict=True)] if carry else new
        found, grown = [], hashes
        for k in range(1, longest + 1):
            if k > 1:
                grown = [_family(f).longer(g[: max(0, len(begin) - k + 1)], h[k - 1 :]) for f, (g, h) in enumerate(zip(grown, hashes, strict=True))]
            first = np.arange(max(0, old - k + 1), max(0, len(begin) - k + 1))
            first = first[piece[first] == piece[first + k - 1]]
            found.append(([g[first] for g in grown], begin[first], end[first + k - 1]))
        carry = [x[max(0, len(x) - longest + 1) :] for x in (begin, end, piece, *hashes)] if longest > 1 else None
        yield found


def chunk_prints(raw: bytes, lang: str, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct fingerprints met once, those met more often, and how often."""
    parts = [h[0] >> LEFT_OUT for found in phrases(raw, language_seed(lang), longest) for h, _, _ in found]
    prints, n = counted(np.concatenate(parts) if parts else np.zeros(0, np.uint64))
    return prints[n == 1], prints[n > 1], n[n > 1].astype("<u4")


def text_chunks(docs: DataFrame, size: int = CHUNK_BYTES) -> DataFrame:
    """(chunk, lang, bytes, body): texts of one language by about ``size`` bytes, lower-cased; stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, held, texts = TaskContext.get().partitionId(), 0, 0, {}

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal number
            for lang, parts in texts.items():
                body = b"\n".join(parts).translate(_LOWER)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x], t) for x, t in (((task << 32) + number, pa.int64()), (lang, pa.string()), (len(body), pa.int64()), (body, pa.large_binary()))],
                    names=["chunk", "lang", "bytes", "body"],
                )
                number += 1

        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                raw = text.encode()
                texts.setdefault(lang, []).append(raw)
                held += len(raw)
                if held >= size:
                    yield from close()
                    held, texts = 0, {}
        yield from close()

    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), text_or_empty().alias("text")).where("text <> ''")
    return stored(rows.mapInArrow(run, "chunk bigint, lang string, bytes bigint, body binary"), "phrase-chunks")


def sent_prints(chunks: DataFrame, longest: int, ranges: int) -> DataFrame:
    """(chunk, range, once, more, more_n): every chunk's fingerprints by range."""
    names = ["chunk", "range", "once", "more", "more_n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = range_bounds(ranges)
        for b in batches:
            for chunk, lang, body in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                once, more, n = chunk_prints(body, lang, longest)
                a, c = np.searchsorted(once, bounds), np.searchsorted(more, bounds)
                rows = [r for r in range(ranges) if a[r] < a[r + 1] or c[r] < c[r + 1]]
                for some in (rows[i : i + 64] for i in range(0, len(rows), 64)):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([chunk] * len(some), pa.int64()), pa.array(some, pa.int64()),
                            pa.array([pack48(once[a[r] : a[r + 1]]) for r in some], pa.binary()),
                            pa.array([pack48(more[c[r] : c[r + 1]]) for r in some], pa.binary()),
                            pa.array([n[c[r] : c[r + 1]].tobytes() for r in some], pa.binary()),
                        ],
                        names=names,
                    )

    return chunks.select("chunk", "lang", "body").mapInArrow(run, "chunk bigint, range bigint, once binary, more binary, more_n binary")


def frequent_bits(sent: DataFrame, support: int, shards: int) -> DataFrame:
    """(chunk, range, once, more): one bit for each fingerprint of ``sent``, set for the candidates."""
    local = -(-support // shards)

    def run(table: pa.Table) -> pa.Table:
        chunk, part, once, more, more_n = (table.column(i).to_pylist() for i in range(5))
        blobs = [unpack48(x) for pair in zip(once, more, strict=True) for x in pair]
        sizes = np.array([len(x) for x in blobs])
        prints = np.concatenate(blobs)
        n = np.concatenate([np.concatenate([np.ones(len(o), np.int64), np.frombuffer(m, "<u4")]) for o, m in zip(blobs[::2], more_n, strict=True)])
        shard = np.repeat(np.repeat(np.array(chunk) % shards, 2), sizes)
        order = np.argsort(prints, kind="stable")
        ranked = prints[order]
        first = starts(ranked)
        total, frequent = np.zeros(len(first), np.int64), np.zeros(len(first), bool)
        for s in range(shards):
            mined = np.add.reduceat(np.where(shard[order] == s, n[order], 0), first)
            frequent |= mined >= local
            total += mined
        keep = np.empty(len(prints), bool)
        keep[order] = np.repeat(frequent & (total >= support), np.diff(np.append(first, len(prints))))
        bits = [np.packbits(x).tobytes() for x in np.split(keep, np.cumsum(sizes)[:-1])]
        return pa.table({"chunk": pa.array(chunk, pa.int64()), "range": pa.array(part, pa.int64()), "once": pa.array(bits[::2], pa.binary()), "more": pa.array(bits[1::2], pa.binary())})

    return sent.groupBy("range").applyInArrow(run, "chunk bigint, range bigint, once binary, more binary")


def chunk_candidates(raw: bytes, lang: str, longest: int, candidates: np.ndarray) -> tuple[int, list[tuple[str, int, int]]]:
    """Words of a chunk, and (phrase, words, occurrences) of its candidates (sorted fingerprints)."""
    hashes, checks, begins, ends, sizes, total = [], [], [], [], [], 0
    for found in phrases(raw, language_seed(lang), longest, families=2):
        total += len(found[0][1])
        for k, ((h, check), begin, end) in enumerate(found, 1):
            prints = h >> LEFT_OUT
            at = np.minimum(np.searchsorted(candidates, prints), max(0, len(candidates) - 1))
            kept = np.flatnonzero(candidates[at] == prints) if len(candidates) else np.zeros(0, np.int64)
            for held, x in ((hashes, h), (checks, check), (begins, begin), (ends, end)):
                held.append(x[kept])
            sizes.append(np.full(len(kept), k))
    if not hashes:
        return total, []
    h, check, begin, end, size = (np.concatenate(x) for x in (hashes, checks, begins, ends, sizes))
    order = np.lexsort((check, h))
    h, check, begin, end, size = h[order], check[order], begin[order], end[order], size[order]
    first = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (check[1:] != check[:-1])])) if len(h) else []
    n = np.diff(np.append(first, len(h)))
    rows = []
    for b, e, k, m in zip(begin[first].tolist(), end[first].tolist(), size[first].tolist(), n.tolist(), strict=True):
        text = raw[b:e]
        if k > 1 and (b"\t" in text or text.count(b" ") >= k):
            text = b" ".join(text.replace(b"\t", b" ").split())
        rows.append((text.decode(), k, m))
    return total, rows


def count_candidates(chunks: DataFrame, bits: DataFrame, longest: int, ranges: int) -> DataFrame:
    """(lang, phrase, words, n): exact counts of the candidates; a null phrase has the language's words."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        (lang,), (raw,) = left.column("lang").to_pylist(), left.column("body").to_pylist()
        once, more, _ = chunk_prints(raw, lang, longest)
        bounds, part = range_bounds(ranges), right.column("range").to_pylist()
        kept = [
            flagged(prints, np.searchsorted(prints, bounds), list(zip(part, right.column(name).to_pylist(), strict=True)))
            for name, prints in (("once", once), ("more", more))
        ]
        total, rows = chunk_candidates(raw, lang, longest, np.sort(np.concatenate(kept)))
        rows.append((None, 0, total))
        texts, words, n = zip(*rows, strict=True)
        return pa.table({"lang": pa.array([lang] * len(rows), pa.string()), "phrase": pa.array(texts, pa.string()), "words": pa.array(words, pa.int32()), "n": pa.array(n, pa.int64())})

    together = chunks.select("chunk", "lang", "body").groupBy("chunk").cogroup(bits.groupBy("chunk"))
    found = together.applyInArrow(run, "lang string, phrase string, words int, n bigint")
    return found.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n"))


def frequent_phrases(docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST, shards: int = SHARDS) -> DataFrame:
    """(lang, phrase, words, n) of the phrases of 1 to ``longest`` words with at least ``support``
    occurrences; the row with a null phrase has the number of words of its language."""
    prepare(docs.sparkSession)
    chunks = text_chunks(docs)
    size = chunks.agg(F.sum("bytes")).first()[0] or 0
    ranges = max(1, size // RANGE_BYTES)
    bits = frequent_bits(sent_prints(chunks, longest, ranges), support, shards)
    counts = count_candidates(chunks, bits, longest, ranges)
    return stored(counts.where((F.col("n") >= support) | F.col("phrase").isNull()), "phrase-counts")


def collocations(
    docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST, shards: int = SHARDS, top: int = TOP, contained: int = CONTAINED
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases."""
    counts = frequent_phrases(docs, support, longest, shards)
    known = counts.where("phrase IS NOT NULL")
    split = known.where("words > 1").select("lang", "phrase", F.col("n").alias("a"), "words", F.split("phrase", " ").alias("w"))
    part = lambda start, size: F.array_join(F.slice("w", start, size), " ")
    cuts = split.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("left"), part(F.col("k") + 1, F.col("words") - F.col("k")).alias("right")
    )
    left = known.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l"))
    right = known.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r"))
    ratio = F.expr("CAST((1000000 * CAST(a AS DECIMAL(15,0)) * CAST(a AS DECIMAL(15,0))) DIV (CAST(l AS DECIMAL(19,0)) * CAST(r AS DECIMAL(19,0))) AS BIGINT)")
    scored = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"]).select("lang", "phrase", "a", F.struct(ratio.alias("score"), "k", "l", "r").alias("cut"))
    lowest = scored.groupBy("lang", "phrase", "a").agg(F.min("cut").alias("cut"))
    # the parts of two words or more of every longer candidate
    inside = split.where("words > 2").select("lang", "a", "w", "words", F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("size"))
    inside = inside.select("lang", "a", "w", "size", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)).alias("start"))
    longer = inside.select("lang", part(F.col("start"), F.col("size")).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    left_over = lowest.join(longer, ["lang", "phrase"], "left").where(f"longer IS NULL OR 100 * longer < {contained} * a")
    totals = counts.where("phrase IS NULL").select("lang", F.col("n"))
    rows = left_over.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    first = Window.partitionBy("lang", "salt").orderBy(*order)
    some = salted.withColumn("place", F.row_number().over(first)).where(F.col("place") <= top).drop("place", "salt")
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


# The same from the words of each piece, all phrases counted and joined as texts.
ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), p AS (
  SELECT lang, list_filter(string_split_regex(unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')), '[\x20\x09]+'), lambda x: x <> '') AS w FROM d
), g AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM p, (VALUES (1), (2), (3)) AS s(k) WHERE len(w) >= k)
), c AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 10),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM p GROUP BY lang),
x AS (
  SELECT lang, phrase, f AS a, string_split(phrase, ' ') AS w, unnest(generate_series(1, k - 1)) AS cut FROM c WHERE k > 1
), s AS (
  SELECT x.lang, x.phrase, x.a, x.cut, l.f AS l, r.f AS r,
         ((1000000::HUGEINT * x.a * x.a) // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM x JOIN c l ON l.lang = x.lang AND l.phrase = array_to_string(w[:cut], ' ')
         JOIN c r ON r.lang = x.lang AND r.phrase = array_to_string(w[cut + 1:], ' ')
), b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
o AS (
  SELECT lang, array_to_string(w[i:i + 1], ' ') AS phrase, max(f) AS longer
  FROM (SELECT lang, f, string_split(phrase, ' ') AS w, unnest([1, 2]) AS i FROM c WHERE k = 3) GROUP BY ALL
), t AS (
  SELECT b.* FROM b LEFT JOIN o ON o.lang = b.lang AND o.phrase = b.phrase WHERE o.longer IS NULL OR 100 * o.longer < 50 * b.a
), q AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM t)
SELECT q.lang, q.rank::BIGINT AS rank, q.phrase, q.a, q.l, q.r, n.n, q.score FROM q JOIN n ON n.lang = q.lang WHERE q.rank <= 2000
"""
