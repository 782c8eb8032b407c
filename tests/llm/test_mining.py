"""Phrase mining, suffix-array removal and spelling variants against brute force, and their edge cases."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from extracteval.llm import phrases, prints, spelling, suffix_dedup, suffixes
from extracteval.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string"
EXTRA = ["chunk", "range", "once", "more", "body", "phrase", "n", "a", "word", "walk", "node", "label", "key", "digest", "start", "windows", "ids", "sizes"]
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def odd_rows():
    rnd = random.Random(6)
    words = ["alpha", "Beta", "gamma", "délta", "漢字", "x\x1cy", "Ünï", "the", "of"]
    text = lambda n: "".join(rnd.choice(words) + rnd.choice([" ", "  ", "\t", " ", ", ", ".\n", "\r"]) for _ in range(n))
    rows = [(i, text(rnd.randint(0, 80)), rnd.choice(["en", None, "de"])) for i in range(40)]
    rows += [(50, None, "en"), (51, "", "en"), (52, " \t\n", None), (None, text(30), "en"), (53, text(9000), "en"), (54, "abcdefg" * 9000, "de")]
    rows += [(54, "abcdefg" * 9000, "de"), rows[3], rows[3], (None, "one two", "und"), (55, "alphabet alphabed alpabet alphabeet " * 12, "en")]
    return rows


@pytest.fixture(scope="module")
def rows():
    return odd_rows()


@pytest.fixture(scope="module")
def odd(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in EXTRA}).repartition(3)


@pytest.mark.parametrize("name", ["op11_son_phrases", "op12_suffix_array_dedup", "op13_trie_frontier_spelling"])
def test_queries_match_their_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    want = con.execute(ORACLE[name])
    columns = [d[0] for d in want.description]
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    key = lambda r: tuple(map(str, r))
    assert sorted((tuple(r) for r in got.select(*columns).collect()), key=key) == sorted(want.fetchall(), key=key)


# phrases


def counted(rows, longest=3):
    seen, n = Counter(), Counter()
    for _, text, lang in rows:
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").encode().translate(LOWER).decode()):
            words = [w for w in re.split("[ \t]+", piece) if w]
            n[lang or "und"] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    seen[lang or "und", " ".join(words[i : i + k])] += 1
    return seen, n


def best_phrases(rows, support, longest=3, top=2000):
    seen, n = counted(rows, longest)
    often = {key: f for key, f in seen.items() if f >= support}
    out = defaultdict(list)
    for (lang, phrase), a in often.items():
        w = phrase.split(" ")
        if len(w) == 1:
            continue
        cuts = [(1_000_000 * a * a // (often[lang, " ".join(w[:k])] * often[lang, " ".join(w[k:])]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        inside = [f for (other, p), f in often.items() if other == lang and len(p.split(" ")) > len(w) and f" {phrase} " in f" {p} "]
        if not any(100 * f >= 50 * a for f in inside):
            out[lang].append((-score, -a, phrase.encode(), often[lang, " ".join(w[:k])], often[lang, " ".join(w[k:])]))
    return sorted(
        (lang, i, p.decode(), -a, lo, hi, n[lang], -s) for lang, found in out.items() for i, (s, a, p, lo, hi) in enumerate(sorted(found)[:top], 1)
    )


@pytest.mark.parametrize("support, longest, shards, top", [(10, 3, 4, 2000), (3, 4, 3, 7), (5, 2, 1, 2000)])
def test_phrases_against_plain_counting(spark, monkeypatch, rows, odd, support, longest, shards, top):
    monkeypatch.setattr(phrases, "RANGE_BYTES", 1 << 12)
    got = phrases.collocations(odd, support, longest, shards, top)
    assert sorted(tuple(r) for r in got.collect()) == best_phrases(rows, support, longest, top)
    assert phrases.collocations(odd.limit(0)).count() == 0


def test_steps_and_chunks_lose_no_phrase(monkeypatch):
    monkeypatch.setattr(phrases, "STEP", 16)
    raw = b"a bb  ccc\tdd a bb. a bb ccc " + b"w" * 90 + b" a bb"
    got = Counter()
    for found in phrases.phrases(raw, 5, 3):
        for k, (_, begin, end) in enumerate(found, 1):
            for b, e in zip(begin, end, strict=True):
                got[k, b" ".join(raw[b:e].split())] += 1
    seen, _ = counted([(1, raw.decode(), "x")])
    assert got == Counter({(len(p.split(" ")), p.encode()): n for (_, p), n in seen.items()})


def test_a_phrase_spread_evenly_is_found(spark):
    # four shards see it at most three times each, one of them at the lowered support
    rows = [(i, f"rare pair {i}", "en") for i in range(10)] + [(100 + i, f"seldom pairs {i}", "en") for i in range(9)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(10)
    assert [(r.phrase, r.a) for r in phrases.collocations(df).collect()] == [("rare pair", 10)]


def test_prints_pack_and_split():
    values = np.sort(np.random.default_rng(1).integers(0, 1 << 48, 1000, dtype=np.uint64))
    assert (prints.unpack48(prints.pack48(values)) == values).all()
    for ranges in (1, 3, 7, 1000):
        bounds = prints.range_bounds(ranges)
        assert bounds[0] == 0 and bounds[-1] == 1 << 48 and (np.diff(bounds.astype(np.int64)) > 0).all()


# suffix arrays


@pytest.mark.parametrize("per_bucket", [0, 1, 512])
def test_suffix_arrays_against_sorting(monkeypatch, per_bucket):
    monkeypatch.setattr(suffixes, "PER_BUCKET", per_bucket)
    rnd = random.Random(per_bucket)
    for _ in range(300):
        letters, n = rnd.choice([1, 2, 3, 20]), rnd.randint(0, 50)
        s = [rnd.randint(1, letters) for _ in range(n)]
        s = s * rnd.choice([1, 1, 3]) + [0]
        order = suffixes.suffix_array(np.array(s))
        assert order.tolist() == sorted(range(len(s)), key=lambda i: s[i:])
        prefix, before = suffixes.permuted_prefixes(np.array(s), order, 1)
        for j, i in zip(order, order[1:], strict=False):
            shared = 0
            while s[i + shared] == s[j + shared] and s[i + shared] > 1:
                shared += 1
            assert prefix[i] == shared and before[i] == j


def removed(rows, length):
    seen = Counter()
    for row in rows:
        raw = (row[1] or "").encode()
        seen.update(raw[i : i + length] for i in range(len(raw) - length + 1))
    out = []
    for row in rows:
        raw = (row[1] or "").encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - length + 1):
            if seen[raw[i : i + length]] > 1:
                gone[i : i + length] = True
        edges = int(np.count_nonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))))
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        out.append((row[0], len(raw), int(gone.sum()), edges // 2, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("length, hot, shard", [(20, 1 << 18, 1 << 21), (20, 60, 500), (7, 30, 200)])
def test_repeats_against_brute_force(spark, monkeypatch, length, hot, shard):
    monkeypatch.setattr(suffix_dedup, "CHUNK_BYTES", 900)
    monkeypatch.setattr(suffix_dedup, "STEP", 64)
    rnd = random.Random(3)
    line = "".join(rnd.choice("abcd é") for _ in range(30))
    rows = []
    for i in range(90):
        text = "".join(rnd.choice("abcde") for _ in range(rnd.randint(0, 120)))
        text = text[:20] + line + text[20:] if i % 3 == 0 else text
        text = "a" * rnd.randint(5, 700) if i % 10 == 0 else text
        text = text * 3 if i % 17 == 0 else text
        rows.append((i if i % 7 else None, text if i % 13 else None, "x"))
    rows += [rows[4], rows[4], (4, "", "x")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = suffix_dedup.repeat_digests(suffix_dedup.remove_repeats(df, length, hot, shard))
    assert sorted((tuple(r) for r in got.collect()), key=str) == removed(rows, length)


def test_removal_on_odd_rows(spark, rows, odd):
    small = [r for r in rows if len(r[1] or "") < 20_000]
    got = suffix_dedup.remove_repeats(odd.where("text IS NULL OR length(text) < 20000"), 40)
    assert sorted((tuple(r) for r in suffix_dedup.repeat_digests(got).collect()), key=str) == removed(small, 40)
    spans = got.select("doc_id", "n_bytes", F.explode("spans").alias("s"), F.octet_length("kept").alias("left")).collect()
    assert spans and all(0 <= r.s.begin < r.s.end <= r.n_bytes for r in spans)
    assert suffix_dedup.remove_repeats(odd.limit(0)).count() == 0
    # two long copies of one periodic text go as a whole
    long = suffix_dedup.repeat_digests(suffix_dedup.remove_repeats(odd.where("length(text) > 20000"))).collect()
    assert [(r.n_removed, r.n_spans) for r in long if r.doc_id == 54] == [(63_000, 1)] * 2


def test_anchors_agree_and_end_as_the_whole_window():
    rnd = np.random.default_rng(5)
    part = rnd.integers(97, 100, 60, dtype=np.uint8)
    raw = np.concatenate([rnd.integers(97, 123, 33, dtype=np.uint8), part, rnd.integers(97, 123, 41, dtype=np.uint8), part])
    for level in range(suffix_dedup.levels(30) + 1):
        keys = suffix_dedup.anchor_keys(raw, 30, level)
        assert (keys[33 : 33 + 31] == keys[134 : 134 + 31]).all()
    windows = {raw[i : i + 30].tobytes() for i in range(len(raw) - 29)}
    assert len(set(keys.tolist())) == len(windows)


# spelling variants


def variants(rows, length=6, count=5, slip=199, dominance=5):
    n = Counter()
    for row in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", (row[1] or "").encode().translate(LOWER).decode()):
            h = zlib.crc32(f"{'' if row[0] is None else row[0]}:{w}".encode())
            if h % slip == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            n[w] += 1
    words = {w: k for w, k in n.items() if k >= count and len(w) >= length}
    near = defaultdict(set)
    for a in words:
        for b in words:
            if a != b and abs(len(a) - len(b)) < 2:
                long, short = (a, b) if len(a) >= len(b) else (b, a)
                i = next((k for k, (x, y) in enumerate(zip(long, short, strict=False)) if x != y), len(short))
                if long[i + 1 :] == (short[i + 1 :] if len(a) == len(b) else short[i:]):
                    near[a].add(b)
    form = {}
    for w in words:
        if near[w]:
            best = min(near[w], key=lambda x: (-words[x], x))
            if words[best] >= dominance * words[w]:
                form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted(((w, form.get(w), root(w), k, len(near[w]), words[form[w]] if w in form else None) for w, k in words.items()), key=str)


@pytest.mark.parametrize("length, count, slip", [(6, 5, 199), (3, 1, 5), (1, 2, 3)])
def test_variants_against_all_pairs(spark, length, count, slip):
    rnd = random.Random(length)
    base = ["".join(rnd.choice("abÀÿcd") for _ in range(rnd.randint(2, 9))) for _ in range(25)]
    base += ["a" * k for k in range(1, 12)] + ["abababab", "babababa", "x" * 300, "x" * 299, "x" * 150 + "y" + "x" * 149]
    rows = []
    for i in range(150):
        words = [rnd.choice(base) for _ in range(12)] + [base[0]] * rnd.randint(0, 9)
        words = [w[:k] + rnd.choice("abcé") + w[k + 1 :] if rnd.random() < 0.2 and (k := rnd.randrange(len(w))) >= 0 else w for w in words]
        rows.append((i if i % 9 else None, " ".join(w.upper() if rnd.random() < 0.1 else w for w in words) if i % 20 else None, "x"))
    rows += [rows[1], rows[1], (7, "", "x"), (8, "12 34 _-", "x")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = spelling.spelling_variants(df, length, count, slip)
    assert sorted((tuple(r) for r in got.collect()), key=str) == variants(rows, length, count, slip)


def test_variants_on_odd_rows(spark, rows, odd):
    got = spelling.spelling_variants(odd)
    assert sorted((tuple(r) for r in got.collect()), key=str) == variants(rows)
    assert spelling.spelling_variants(odd.limit(0)).count() == 0
    lone = spark.createDataFrame([(1, "single " * 5)], "doc_id bigint, text string")
    assert [tuple(r) for r in spelling.spelling_variants(lone).collect()] == [("single", None, "single", 5, 0, None)]
