"""Personal data by bootstrapped contextual extraction (operator 2).

Base spans (email, ip, card, phone by their rules) are the seeds.  The words before a seed are its
lexical patterns (the last word, the last two).  A pattern's confidence is the weighted share of
its occurrences in the corpus, before any word at all, that stand before known identifiers of one
kind; an instance's confidence is the chance that not all of its patterns are wrong.  The two are
scored in turns over the pattern-instance graph until they settle.  Then confident instances count
as seeds that induce more patterns, until no pattern is added.  Tokens that look like an identifier
but fail the base rules become spans when patterns of that kind are confident enough.

Texts are read twice: for seeds, candidates and their contexts (stored), then to count how often
the patterns that can be induced occur; the second reading tests words against a Bloom filter of fixed size and
the exact counts come from a join.

Defined results: null and empty texts have no span; null ids and repeated rows are kept; an empty
table gives no row; other columns are not read.  Base spans are never dropped; added spans never
overlap them or each other.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from extracteval.llm.common import prepare, stored

KINDS = ["email", "ip", "card", "phone"]
MIN_SEEDS = 3  # distinct seed instances that a pattern must stand before
CONFIDENT = 0.8
TOLERANCE = 1e-6  # scores have settled when no pattern is further from its fixed point
BLOOM_BITS = 1 << 23
LONG = 64  # characters of a word or instance that is kept as it is

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits matches from its start or not at all, so no start inside a run need be tried.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
# Tokens that may be identifiers the base rules refuse, by kind.
_LIKE = {
    "email": re.compile(r"[^\s@<>\"'(),;|]+@[^\s@<>\"'(),;|]*[A-Za-z0-9]"),
    "ip": re.compile(r"(?<![\w.])[0-9]++(?:\.[0-9]++){3,}(?![\w])"),
    "card": re.compile(r"(?<![\w+-])[0-9](?:[ -]?[0-9]){11,18}(?![\w-])"),
    "phone": re.compile(r"(?<![\w+.-])\(?[0-9](?:[ ().-]{0,2}[0-9]){6,14}(?![\w-])"),
}
_EDGE = " \t\n\"'([{<>)]},;|"
_WORD = re.compile(r"\S+")
_QUOTE = "\"'([{<|"


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (1 + k % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of the email rule, found from the @ signs so that long words cost no more."""
    at, free = text.find("@"), 0
    while at >= 0:
        start = max(free, text.rfind("@", free, at) + 1)
        local = at - len(text[start:at]) + len(text[start:at].rstrip(_LOCAL)) if at > start else at
        m = _DOMAIN.match(text, at) if local < at else None
        if m:
            yield local, m.end()
            free = m.end()
        at = text.find("@", max(at + 1, free))


def base_spans(text: str | None) -> list[tuple[int, str, int]]:
    """(start, kind, end) by start, then kind as listed; code points, end exclusive."""
    text = text or ""
    found = [(a, 0, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(int(x[-4:]) <= 255 and (len(x) < 4 or not x.strip("0") or int(x) <= 255) if len(x) < 4000 else not x[:-3].strip("0") and int(x[-3:]) <= 255 for x in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = re.sub(r"[ -]", "", m[0]) if m.end() - m.start() <= 40 else ""
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                found.append((m.start(), 3, m.end()))
    return [(a, KINDS[k], b) for a, k, b in sorted(found)]


def span_text(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, kind, b in sorted(spans, key=lambda s: (s[0], KINDS.index(s[1]))))


def candidates(text: str | None, base: list[tuple[int, str, int]]) -> list[tuple[int, str, int]]:
    """Identifier-like tokens that overlap no base span; of two that overlap, the first kind's."""
    text = text or ""
    if not any(c in text for c in "@0123456789"):
        return []
    taken, out = bytearray(len(text)), []  # a mark for each character of a span
    for a, _, b in base:
        taken[a:b] = b"\1" * (b - a)
    for kind in KINDS:
        for m in _LIKE[kind].finditer(text):
            if taken.find(1, m.start(), m.end()) < 0:
                out.append((m.start(), kind, m.end()))
                taken[m.start() : m.end()] = b"\1" * (m.end() - m.start())
    return sorted(out)


def short(word: str) -> str:
    """Words and instances longer than ``LONG`` stand under a hash of the whole."""
    return word if len(word) <= LONG else "#" + hashlib.sha256(word.encode()).hexdigest()


def left_words(text: str, starts: list[int]) -> dict[int, list[str]]:
    """Patterns of each position: the last word before it, and the last two, in lower case.

    Positions ascend; a word is read once however many positions follow it or stand inside it.
    """
    words, out = _WORD.finditer(text), {}
    word, before = next(words, None), []  # the word that ends after the position; [match, key] of the last two before
    begin = None  # of the word that the position stands inside
    for at in starts:
        while word and word.end() <= at:
            before = [*before[-1:], [word, None]]
            word, begin = next(words, None), None
        for pair in before:
            if pair[1] is None:
                pair[1] = short(pair[0][0].lower().strip(_QUOTE))
        keys = [key for _, key in before]
        if word and word.start() < at:  # the position stands inside a word, whose beginning counts
            if begin is None:
                begin = fed = word.end() - len(word[0].lstrip(_QUOTE))
                hashed = hashlib.sha256()
            end = at
            while end > begin and text[end - 1] in _QUOTE:
                end -= 1
            if end - begin < 2 * LONG:
                keys.append(short(text[begin:end].lower()))
            else:
                hashed.update(text[fed:end].lower().encode())
                fed = end
                keys.append("#" + hashed.hexdigest())
        keys = keys[-2:]
        out[at] = ([keys[-1]] if keys and keys[-1] else []) + ([" ".join(keys)] if len(keys) == 2 and all(keys) else [])
    return out


def instance(kind: str, surface: str) -> str:
    """What makes two mentions one instance: digits alone, or the address in lower case."""
    return surface.lower() if kind == "email" else re.sub(r"\D", "", surface)


def find_mentions(text: str | None) -> tuple[list, list]:
    base = base_spans(text)
    more = candidates(text, base)
    left = left_words(text or "", sorted({a for a, _, _ in base + more}))
    rows = [(a, kind, b, seed, short(instance(kind, text[a:b])), left[a]) for spans, seed in ((base, True), (more, False)) for a, kind, b in spans]
    return base, rows


def mention_rows(docs: DataFrame) -> DataFrame:
    """uid, base, mentions of every row of ``docs`` (uid, text)."""
    found = F.pandas_udf(_mention_frame, "base array<struct<a:int,kind:string,b:int>>, mentions array<struct<a:int,kind:string,b:int,seed:boolean,instance:string,patterns:array<string>>>")
    return docs.withColumn("found", found("text"))


def _mention_frame(texts: pd.Series) -> pd.DataFrame:
    got = [find_mentions(t) for t in texts]
    names = ("a", "kind", "b", "seed", "instance", "patterns")
    return pd.DataFrame({
        "base": [[dict(zip(names, s, strict=False)) for s in base] for base, _ in got],
        "mentions": [[dict(zip(names, m, strict=True)) for m in rows] for _, rows in got],
    })


def _bloom(patterns: list[str] | Iterator[str]) -> bytes:
    bits = np.zeros(BLOOM_BITS, dtype=bool)
    for p in patterns:
        bits[zlib.crc32(p.encode()) % BLOOM_BITS] = True
    return np.packbits(bits).tobytes()


def pattern_filter(patterns: DataFrame) -> bytes:
    """A Bloom filter (one hash) of any number of patterns, made in parts and joined by OR."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(BLOOM_BITS // 8, dtype=np.uint8)
        for b in batches:
            bits |= np.frombuffer(_bloom(b.column(0).to_pylist()), np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array([bits.tobytes()], pa.binary())], names=["bits"])

    total = np.zeros(BLOOM_BITS // 8, dtype=np.uint8)
    for r in patterns.select("pattern").coalesce(4).mapInArrow(run, "bits binary").toLocalIterator():  # 1 MiB each
        total |= np.frombuffer(r.bits, np.uint8)
    return total.tobytes()


def count_occurrences(docs: DataFrame, induced: DataFrame) -> DataFrame:
    """pattern, n: how often each induced pattern stands before any word of the corpus."""
    bits = docs.sparkSession.sparkContext.broadcast(pattern_filter(induced))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        there = np.unpackbits(np.frombuffer(bits.value, np.uint8))
        counts: Counter = Counter()
        for b in batches:
            for text in b.column(0).to_pylist():
                words = [w.strip(_QUOTE) for w in (text or "").lower().split()]
                if max(map(len, words), default=0) > LONG:
                    words = list(map(short, words))
                for grams in (words[:-1], [f"{x} {y}" for x, y in zip(words, words[1:-1], strict=False) if x and y]):
                    if grams:
                        slots = np.fromiter((zlib.crc32(g.encode()) for g in grams), np.int64, len(grams)) % BLOOM_BITS
                        counts.update([grams[k] for k in np.flatnonzero(there[slots]).tolist()])
            if len(counts) > 200_000:  # parts are added up by pattern later
                yield _counted(counts)
                counts = Counter()
        yield _counted(counts)

    parts = docs.select("text").mapInArrow(run, "pattern string, n bigint").groupBy("pattern").agg(F.sum("n").alias("n"))
    return parts.join(induced.select("pattern"), "pattern", "left_semi")


def _counted(counts: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["pattern", "n"])


def link_groups(unknown: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kind, group, pattern, n, weight) and (kind, instance, group): instances that stand after the same
    patterns equally often have equal scores, so they are one group that counts ``weight`` times."""
    signs = [F.sum(F.xxhash64(*c).cast("decimal(38,0)")) for c in (("pattern", "n"), ("n", "pattern"))]
    found = unknown.groupBy("kind", "instance").agg(F.md5(F.concat_ws(",", *signs, F.count(F.lit(1)))).alias("group"))
    members = stored(found, "pii-members")
    weights = members.groupBy("kind", "group").agg(F.count(F.lit(1)).alias("weight"), F.min("instance").alias("instance"))
    # one instance speaks for its group
    links = unknown.join(weights, ["kind", "instance"]).select("kind", "group", "pattern", "n", "weight")
    return stored(links, "pii-links"), members


def settle(links: DataFrame, patterns: DataFrame, tolerance: float) -> tuple[DataFrame, DataFrame, int]:
    """(kind, pattern, trust; kind, group, score; rounds) at the fixed point.

    ``patterns`` has kind, pattern, base (known mentions) and size (occurrences + 1); ``links`` has kind, group,
    pattern, n and weight of the unknown instances.  A pattern's trust is (base + sum of n * weight * score)
    / size, an instance's score 1 - product of (1 - trust) over its patterns.  Both grow with each other along a
    concave function, so the fixed point is single.  Score is linear in one pattern's own
    trust, with the chance that its other patterns are all wrong as the slope, so a round solves each pattern's
    equation for its own trust exactly: what a pattern gains through itself, which may
    take any number of plain rounds, takes one.  Rounds end when what is left of the geometric
    series of moves, as the last two show it, is below ``tolerance``.
    """
    state = stored(patterns.select("kind", "pattern", "base", "size", (F.col("base") / F.col("size")).alias("trust"), F.lit(1.0).alias("move")), "pii-trust")
    known = ["kind", "pattern"]

    def doubts(trust: DataFrame) -> DataFrame:
        return links.join(trust.select(*known, F.log(F.greatest(1 - F.col("trust"), F.lit(1e-300))).alias("doubt")), known)

    rounds, last = 0, 1.0
    while True:
        met = doubts(state)
        every = met.groupBy("kind", "group").agg(F.sum("doubt").alias("all"))
        # the chance that all other patterns of the group are wrong, and that not all of them are
        others = met.join(every, ["kind", "group"]).withColumn("rest", F.least(F.col("all") - F.col("doubt"), F.lit(0.0)))
        n = F.col("n") * F.col("weight")
        sums = others.groupBy(*known).agg(F.sum(n * F.exp("rest")).alias("slope"), F.sum(n * -F.expm1("rest")).alias("gained"))
        after = state.join(sums, known, "left")
        fresh = (F.col("base") + F.coalesce("gained", F.lit(0.0))) / (F.col("size") - F.coalesce("slope", F.lit(0.0)))
        state = stored(after.select(*known, "base", "size", fresh.alias("trust"), F.abs(fresh - F.col("trust")).alias("move")), "pii-trust")
        rounds += 1
        move = state.agg(F.max("move")).first()[0] or 0.0
        ratio = min(move / last, 0.999) if last else 0.0
        last = move
        if move * max(1.0, ratio / (1 - ratio)) < tolerance:
            scores = doubts(state).groupBy("kind", "group").agg((-F.expm1(F.sum("doubt"))).alias("score"))
            return state.select(*known, "trust"), scores, rounds


def _settled_trust(edges: DataFrame, tolerance: float) -> tuple[DataFrame, DataFrame]:
    """(kind, pattern, trust; kind, instance, score of unknown instances) at the fixed point."""
    patterns = edges.groupBy("kind", "pattern").agg(
        F.sum(F.when(F.col("known"), F.col("n")).otherwise(0)).alias("base"), (F.greatest(F.max("total"), F.sum("n")) + 1).alias("size")
    )
    links, members = link_groups(edges.where(~F.col("known")).select("kind", "pattern", "instance", "n"))
    trust, scores, _ = settle(links, patterns, tolerance)
    return trust, stored(members.join(scores, ["kind", "group"]).select("kind", "instance", "score"), "pii-scores")


def confident_mentions(rows: DataFrame, docs: DataFrame, min_seeds: int = MIN_SEEDS, confident: float = CONFIDENT, tolerance: float = TOLERANCE) -> DataFrame:
    """(kind, instance, pattern) of candidates whose confidence reaches ``confident``."""
    mention = rows.select(F.explode("mentions").alias("m")).select("m.kind", "m.seed", "m.instance", F.explode("m.patterns").alias("pattern"))
    merged = stored(mention.groupBy("kind", "pattern", "instance").agg(F.count(F.lit(1)).alias("n"), F.max("seed").alias("seed"), F.count_if(~F.col("seed")).alias("unseen")), "pii-edges")
    # no other pattern can ever be induced, so one more reading of the texts counts for all turns
    possible = stored(merged.groupBy("kind", "pattern").agg(F.count(F.lit(1)).alias("instances")).where(F.col("instances") >= min_seeds).select("kind", "pattern"), "pii-patterns")
    total = stored(count_occurrences(docs, possible.select("pattern").distinct()), "pii-totals")
    seeds = merged.where("seed").select("kind", "instance").distinct().withColumn("known", F.lit(True))
    graph = merged.join(possible, ["kind", "pattern"]).join(total.withColumnRenamed("n", "total"), "pattern").join(seeds, ["kind", "instance"], "left")
    graph = stored(graph.withColumn("known", F.coalesce("known", F.lit(False))), "pii-graph")
    sure = graph.where("known").select("kind", "instance").distinct()
    trust, induced = None, 0
    while True:
        patterns = stored(graph.join(sure, ["kind", "instance"], "left_semi").groupBy("kind", "pattern").agg(F.count(F.lit(1)).alias("seeds")).where(F.col("seeds") >= min_seeds), "pii-induced")
        n = patterns.count()
        if trust is not None and n == induced:
            break
        induced = n
        live = stored(graph.join(patterns.select("kind", "pattern"), ["kind", "pattern"]), "pii-live")
        trust, score = _settled_trust(live, tolerance)
        # scores and patterns only grow from turn to turn
        sure = stored(graph.where("known").select("kind", "instance").unionByName(score.where(F.col("score") >= confident).select("kind", "instance")).distinct(), "pii-sure")
    good = trust.where(F.col("trust") >= confident)
    # a refused form of a known identifier shares its edge with the seed, so edges are kept by their refused mentions
    return live.where("unseen > 0").join(sure, ["kind", "instance"]).join(good, ["kind", "pattern"]).select("kind", "instance", "pattern")


def extract(docs: DataFrame, keep: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows, added): ``keep``, ``uid`` and the ``found`` spans of every row, stored; (uid, added)."""
    prepare(docs.sparkSession)
    found = mention_rows(docs.withColumn("uid", F.monotonically_increasing_id()))
    rows = stored(found.select("uid", *keep, "found"), "pii-rows")
    flat = rows.select(F.col("found.mentions").alias("mentions"))
    sure = confident_mentions(flat, docs)
    mention = rows.select("uid", F.explode("found.mentions").alias("m")).where(~F.col("m.seed"))
    mention = mention.select("uid", F.col("m.a").alias("a"), F.col("m.kind").alias("kind"), F.col("m.b").alias("b"), F.col("m.instance").alias("instance"), F.explode("m.patterns").alias("pattern"))
    hits = mention.join(sure, ["kind", "instance", "pattern"], "left_semi").select("uid", "a", "kind", "b").distinct()
    # a text's spans are together in its row already, so this group is no larger than a row
    return rows, hits.groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("a", "kind", "b"))).alias("added"))


def _digest(base: pd.Series, added: pd.Series) -> pd.DataFrame:
    out = []
    for b, x in zip(base, added, strict=True):
        known = [(s["a"], s["kind"], s["b"]) for s in b]
        more = [] if x is None else [(s["a"], s["kind"], s["b"]) for s in x]
        out.append((hashlib.sha256(span_text(known).encode()).hexdigest(), span_text(known + more)))
    return pd.DataFrame(out, columns=["base_sha256", "spans"])


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans, n_added."""
    rows, added = extract(docs.select("doc_id", "text"), ["doc_id"])
    both = rows.select("uid", "doc_id", F.col("found.base").alias("base")).join(added, "uid", "left")

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    counts = [count(kind) for kind in KINDS]
    digest = F.pandas_udf(_digest, "base_sha256 string, spans string")
    out = both.select("doc_id", *counts, digest("base", "added").alias("d"), F.coalesce(F.size("added"), F.lit(0)).cast("bigint").alias("n_added"))
    return out.select("doc_id", *[f"n_{k}" for k in KINDS], "d.base_sha256", "d.spans", F.greatest("n_added", F.lit(0)).alias("n_added"))


def _redact(texts: pd.Series, base: pd.Series, added: pd.Series) -> pd.Series:
    out = []
    for text, b, x in zip(texts, base, added, strict=True):
        spans = sorted((s["a"], s["b"], s["kind"]) for s in [*b, *([] if x is None else x)])
        if text is not None and spans:
            parts, at = [], 0
            for a, end, kind in spans:
                if a >= at:
                    parts += [text[at:a], f"[{kind.upper()}]"]
                at = max(at, end)
            text = "".join([*parts, text[at:]])
        out.append(text)
    return pd.Series(out, dtype=object)


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets and n_chars counted anew."""
    names = docs.columns
    rows, added = extract(docs.select(F.struct(*names).alias("row"), "text"), ["row", "text"])
    both = rows.join(added, "uid", "left")
    new = both.select("row", F.pandas_udf(_redact, "string")("text", F.col("found.base"), F.col("added")).alias("clean"))
    changed = {"text": F.col("clean"), "n_chars": F.length("clean").cast(docs.schema["n_chars"].dataType)}
    return new.select(*[changed.get(n, F.col(f"row.{n}")).alias(n) for n in names])
