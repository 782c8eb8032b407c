"""Every operator against a brute-force version on small fixtures, plus its edge cases."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from extracteval.llm import chat, pii, quality, toxicity
from extracteval.llm.block_search import nearest
from extracteval.llm.common import read
from extracteval.llm.decontamination import RATE, ItemIndex, find_leaks, keep_uncontaminated, normalise
from extracteval.llm.packing import best_fit_plan, pack_documents, sequences
from extracteval.llm.queries import BYTE_BPE, ORACLE, QUERIES, WORD_BPE
from extracteval.llm.sharding import cut_links, shard_documents
from extracteval.llm.simhash import RADIUS, covering_masks, fingerprint, fingerprint_components, keep_one_of_each, simhash_components
from extracteval.llm.token_files import decode_values, encode_values, token_files_query
from extracteval.llm.tokens import TextEncoder, public_path

SF = "/root/testdata/sf0.001"
LONG = "word " * 40_000
#: nulls, empty, blank, very long, ties, repeated rows, and columns named like the operators' own
ROWS = [
    (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \n ", None, None, None), (4, LONG, "en", "a", len(LONG)),
    (5, "Same text here, twice.", "en", "a", 1), (6, "Same text here, twice.", "en", "a", 1), (6, "Same text here, twice.", "en", "a", 1),
    (None, "no id", "en", "a", 1), (7, "Ünï漢字 \x1c x\ty  z", "de", "b", 3), (8, "mail a.b@c.de or +1 (212) 555-0100, 10.0.0.1", "en", "a", 2),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
EXTRA = ["uid", "fp", "shard", "ids", "key", "n", "task", "bucket", "score", "row", "found"]


@pytest.fixture(scope="module")
def odd(spark):
    from pyspark.sql import functions as F

    return spark.createDataFrame(ROWS, SCHEMA).withColumns({c: F.lit("x") for c in EXTRA}).coalesce(2)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def texts():
    return dict(duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall())


def test_pieces_encode_like_whole_texts():
    rnd = random.Random(1)
    letters = " \n\t    \x85\x1c'stdlévÀ×.,;!?*|_1²½Ⅷ漢#$%&̸́<>İΣß"
    for name, spaces in ((BYTE_BPE, True), (WORD_BPE, False)):
        enc = TextEncoder(public_path(name), spaces)
        for _ in range(3000):
            text = "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 14)))
            assert enc(text) == enc.whole(text)


def test_values_round_trip():
    values = np.array([0, 1, 255, 256, 65535, 65536, 1 << 24, (1 << 32) - 1] * 5 + [7], dtype=np.uint32)
    control, data = encode_values(values)
    assert len(control) == -(-len(values) // 4)
    assert decode_values(control, data, len(values)).tolist() == values.tolist()
    assert decode_values(*encode_values(values[:0]), 0).tolist() == []


def _ids(enc, text, end):
    return np.append(np.frombuffer(enc.whole(text or ""), enc.dtype), end).astype("<u4")


def _check_tokens(rows, texts):
    enc, start = TextEncoder(public_path(BYTE_BPE), True), 0
    got = {r.doc_id: r for r in rows}
    for doc in sorted(texts):
        ids = _ids(enc, texts[doc], 0)
        assert (got[doc].start, got[doc].n_tokens, got[doc].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_token_files(spark, texts, odd, empty):
    _check_tokens(QUERIES["op3_vbyte_token_files"](spark, SF).collect(), texts)
    rows = token_files_query(odd, public_path(BYTE_BPE)).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, 1, 2, 3, 4, 5, 6, 6, 7, 8]
    assert token_files_query(empty, public_path(BYTE_BPE)).count() == 0


def _check_packing(rows, capacity=4096):
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for pieces in places.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


def _plain_best_fit(lengths, capacity):
    rooms, bins = [], 0
    for length in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= length]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - length)
        else:
            bins += 1
            rooms.append(capacity - length)
    return bins


def test_plan_is_plain_best_fit_decreasing():
    rnd = random.Random(4)
    for _ in range(60):
        lengths = [rnd.randint(1, 50) for _ in range(rnd.randint(1, 80))]
        plan = best_fit_plan(Counter(lengths), 50)
        bins, seen = set(), Counter()
        for length, first, n, each, at, _ in plan:
            assert first == seen[length]
            seen[length] += n
            bins |= {at + j // each for j in range(n)}
        assert seen == Counter(lengths) and len(bins) == _plain_best_fit(lengths, 50)


def test_packing(spark, texts, odd, empty):
    rows = QUERIES["op6_best_fit_packing"](spark, SF).collect()
    assert _check_packing(rows) == _plain_best_fit([r.length for r in rows], 4096)
    enc, by_doc = TextEncoder(public_path(WORD_BPE), False), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
    for doc, text in texts.items():
        ids, at = _ids(enc, text, 1), 0
        for k, r in enumerate(sorted(by_doc[doc], key=lambda r: r.piece)):
            part = ids[at : at + 4096]
            assert (r.piece, r.start, r.length, r.ids_crc32) == (k, at, len(part), zlib.crc32(part.tobytes()))
            at += len(part)
        assert at == len(ids)
    placed = pack_documents(odd, public_path(WORD_BPE), keep_ids=True)
    rows = placed.collect()
    _check_packing(rows)
    assert sum(r.doc_id == 6 for r in rows) == 2 and sum(r.doc_id is None for r in rows) == 1
    built = sequences(placed).collect()
    assert all(len(r.ids) == 4 * r.n_tokens <= 4 * 4096 for r in built) and sum(r.n_tokens for r in built) == sum(r.length for r in rows)
    assert pack_documents(empty, public_path(WORD_BPE)).count() == 0


def _check_shards(rows, shards):
    counts = Counter(r.shard for r in rows)
    sizes = [counts[s] for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert r.law == "rows" and r.grown_shard is None
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_sharding(spark, odd, empty):
    rows = QUERIES["op1_label_propagation_shards"](spark, SF).collect()
    assert len(rows) == 200
    _check_shards(rows, 24)
    rows = shard_documents(odd).collect()
    _check_shards(rows, 24)
    by = {r.doc_id: r for r in rows}
    assert (by[1].size, by[1].text_crc32) == (8, 0) and by[7].text_crc32 == zlib.crc32(ROWS[8][1].encode())
    assert shard_documents(empty).count() == 0


def test_shards_gather_equal_texts(spark):
    rows = [(i, f"unique {i}") for i in range(600)] + [(1000 + i, "hot") for i in range(400)] + [(2000 + i, f"pair {i // 4}") for i in range(200)]
    got = shard_documents(spark.createDataFrame(rows, "doc_id bigint, text string"), shards=6)
    out = got.collect()
    _check_shards(out, 6)
    hot = Counter(r.shard for r in out if 1000 <= r.doc_id < 2000)
    assert len(hot) <= 3
    r = cut_links(got, ["text_crc32", "size"]).first()
    assert r.links == 399 + 50 * 3 and r.cut <= 260


def _brute_components(fps, ids, radius=RADIUS):
    near, comp = np.bitwise_count(fps[:, None] ^ fps) <= radius, np.array(ids)
    while True:
        new = np.where(near, comp[None, :], 1 << 60).min(axis=1)
        if (new == comp).all():
            return comp.tolist()
        comp = new


def test_covering_masks_cover_every_small_difference():
    masks, rnd = covering_masks(list(range(64))), random.Random(2)
    for _ in range(2000):
        bits = sum(1 << b for b in rnd.sample(range(64), RADIUS))
        assert any(not m & bits for m in masks)


def test_fingerprint_by_the_rule():
    import xxhash

    for text in ("One two  Three\tfour one two three", "two Words", "x", "Ünï É A b c"):
        words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text))
        grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
        hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        assert fingerprint(text) == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert fingerprint(None) == fingerprint(" \n") == 0


def test_simhash_components(spark, texts, odd, empty):
    rows = QUERIES["op10_covering_simhash"](spark, SF).collect()
    fps = np.array([int(r.fingerprint, 16) for r in rows], dtype=np.uint64)
    assert [r.component_id for r in rows] == _brute_components(fps, [r.doc_id for r in rows])
    assert all(int(r.fingerprint, 16) == fingerprint(texts[r.doc_id]) for r in rows)
    rows = simhash_components(odd).collect()
    assert len(rows) == len(ROWS) and {r.component_id for r in rows if r.doc_id in (1, 2, 3)} == {1}
    kept = [r.doc_id for r in keep_one_of_each(odd).collect()]
    assert kept.count(6) == 0 and kept.count(5) == 1 and len(kept) == 6 and None in kept
    assert simhash_components(empty).count() == 0 == keep_one_of_each(empty).count()


def test_large_buckets_are_split_without_losing_links(spark):
    rnd, found = random.Random(1), set()
    base = rnd.getrandbits(64)
    while len(found) < 1500:
        x = base
        for _ in range(rnd.randint(0, 4)):
            x ^= 1 << rnd.randrange(64)
        found.add(x)
    fps = np.array(sorted(found), dtype=np.uint64)
    signed = fps.view(np.int64).tolist()
    rows = fingerprint_components(spark.createDataFrame([(x,) for x in signed], "fp bigint"), RADIUS, 256).collect()
    near = _brute_components(fps, list(range(len(fps))))
    mine = defaultdict(set)
    for r in rows:
        mine[r.root].add(r.fp)
    want = defaultdict(set)
    for c, x in zip(near, signed, strict=True):
        want[c].add(x)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, want.values()))


def _brute_nearest(vectors, k=20, every=20):
    out = {}
    for i, x in vectors.items():
        if i % every == 0:
            scores = sorted((-sum(float(a) * float(b) for a, b in zip(x, y, strict=True)), j) for j, y in vectors.items() if j != i)
            out[i] = [j for _, j in scores[:k]]
    return out


def test_block_search(spark):
    vectors = dict(duckdb.sql(f"select vec_id, embedding from '{SF}/embeddings.parquet'").fetchall())
    got = defaultdict(list)
    for r in nearest(read(spark, SF, "embeddings"), block=100).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    assert got == _brute_nearest(vectors)
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]), (None, [1.0, 1.0]), (9, [1.0, 2.0, 3.0]), (20, [1e30, -1e30])]
    odd = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = [tuple(r) for r in nearest(odd).orderBy("query_id", "rank").collect()]
    assert [(q, n, v) for q, n, v, _ in got if q == 0] == [(0, 1, 1), (0, 2, 2), (0, 3, 20)] and {q for q, *_ in got} == {0, 20}
    assert nearest(odd.limit(0)).count() == 0


def _edits(item, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item):
        new = [i + 1]
        for j, e in enumerate(text):
            new.append(min(row[j] + (c != e), row[j + 1] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_leaks_against_full_alignment(texts):
    items = [(i, normalise(t)) for i, t in duckdb.sql(f"select item_id, text from '{SF}/benchmark.parquet'").fetchall()][:12]
    index, rnd, plain = ItemIndex(items), random.Random(3), [normalise(t) for t in list(texts.values())[:20]]
    for _ in range(40):
        k = rnd.randrange(len(items))
        item, budget = bytearray(items[k][1]), int(RATE * len(items[k][1]))
        for _ in range(rnd.randint(0, budget + 3)):
            p, kind = rnd.randrange(len(item)), rnd.random()
            if kind < 0.34:
                item[p] = rnd.choice(b"abcdefgh ")
            elif kind < 0.67:
                del item[p]
            else:
                item.insert(p, rnd.choice(b"abcdefgh "))
        text = rnd.choice(plain)[:300] + b" " + bytes(item) + b" " + rnd.choice(plain)[:200]
        true = _edits(items[k][1], text)
        hit = [h for h in index.find(text) if h[0] == k]
        assert bool(hit) == (true <= budget) and (not hit or hit[0][1] == true)


def test_decontamination(spark, texts, odd, empty):
    rows = QUERIES["op9_qgram_decontamination"](spark, SF).collect()
    items = [normalise(t) for t, in duckdb.sql(f"select text from '{SF}/benchmark.parquet'").fetchall()]
    exact = {d for d, t in texts.items() if any(i in normalise(t) for i in items)}
    assert exact <= {r.doc_id for r in rows}
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "same text HERE twice"), (None, "10 0 0 1")], "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in find_leaks(odd, bench).collect()}
    assert got == {(5, 3), (6, 3), (8, None)}
    assert sorted(r.doc_id or 0 for r in keep_uncontaminated(odd, bench).collect()) == [0, 1, 2, 3, 4, 7]
    assert find_leaks(empty, bench).count() == 0 == find_leaks(odd, bench.limit(0)).count()


BASE = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def _brute_spans(text):
    out = []
    for k, (kind, rule) in enumerate(BASE):
        for m in re.finditer(rule, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if (
                kind == "email" or (kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")))
                or (kind == "card" and 14 <= len(digits) <= 19 and pii.luhn(digits)) or (kind == "phone" and 10 <= len(digits) <= 15)
            ):
                out.append((m.start(), k, m.end()))
    return [(a, BASE[k][0], b) for a, k, b in sorted(out)]


def test_base_spans_by_the_rules(texts):
    rnd = random.Random(5)
    for _ in range(8000):
        text = "".join(rnd.choice("a.@-+%1234567890  ().é\n_000") for _ in range(rnd.randint(0, 40)))
        assert pii.base_spans(text) == _brute_spans(text)
    assert all(pii.base_spans(t) == _brute_spans(t) for t in texts.values())
    assert pii.base_spans("9" * 50_000 + "." + "a" * 50_000) == []


def test_personal_data(spark, texts, odd, empty):
    for r in QUERIES["op2_contextual_personal_data"](spark, SF).collect():
        want = _brute_spans(texts[r.doc_id])
        joined = ",".join(f"{k}:{a}:{b}" for a, k, b in want)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest() and set(filter(None, joined.split(","))) <= set(r.spans.split(","))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for _, k, _ in want) for kind, _ in BASE]
    got = {r.doc_id: r for r in pii.personal_data(odd).collect()}
    assert len(got) == 9 and got[8].spans == "email:5:13,phone:17:34,ip:36:44" and got[1].spans == ""
    clean = {r.doc_id: r for r in pii.redact(odd.select("doc_id", "text", "lang", "source", "n_chars")).collect()}
    assert clean[8].text == "mail [EMAIL] or [PHONE], [IP]" and clean[8].n_chars == len(clean[8].text) and clean[1].text is None
    assert pii.personal_data(empty).count() == 0


def test_patterns_find_unseen_identifiers(spark):
    rows = [(i, f"some words then call us at +1 (212) 555-{1000 + i} today") for i in range(30)]
    rows += [(100, "please call us at 212-555-7788 soon"), (101, "order 212-555-7788 chairs of 212-555-9911 kinds"), (102, "we met us at noon")]
    got = {r.doc_id: r for r in pii.personal_data(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got[100].spans == "phone:18:30" and got[100].n_phone == 0 and got[100].n_added == 1
    assert got[101].n_added == 0 and got[102].n_added == 0


def test_refused_forms_of_known_identifiers_are_found(spark):
    rows = [(i, f"some words then call us at +1 (212) 555-{1000 + i} today") for i in range(30)]
    rows += [(100, "please call us at 1 (212) 555-1003 soon"), (101, "order 1 (212) 555-1003 chairs")]
    got = {r.doc_id: r for r in pii.personal_data(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got[100].spans == "phone:18:34" and got[100].n_phone == 0 and got[101].n_added == 0 and got[3].n_added == 0


def test_few_known_identifiers_lead_to_many_unseen_and_to_new_contexts(spark):
    rows = [(i, f"dial +1 (212) 555-{1000 + i}") for i in range(10)] + [(100 + i, f"dial 212-555-{2000 + i}") for i in range(100)]
    rows += [(300 + i, f"fax 212-555-{2000 + i}") for i in range(20)] + [(400, "fax 212-555-3000"), (401, "order 212-555-3001")]
    got = {r.doc_id: r.n_added for r in pii.personal_data(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert all(got[100 + i] == 1 for i in range(100))  # trust 10/11 by hand
    assert all(got[300 + i] == 1 for i in range(20)) and got[400] == 1 and got[401] == 0


def test_contexts_are_whole_words_of_any_length(spark):
    word, gap = "w" * 200, " " * 100
    rows = [(i, f"{word} +1 (212) 555-{1000 + i}") for i in range(20)] + [(100, f"{word} 212-555-7788"), (101, f"{'w' * 199} 212-555-7799")]
    got = {r.doc_id: r.n_added for r in pii.personal_data(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got[100] == 1 and got[101] == 0
    assert pii.left_words(f"meet{gap}us{gap}1", [206]) == {206: ["us", "meet us"]}
    ends = [pii.find_mentions("a" * 70 + f"{i}@example.org")[1][0][4] for i in range(2)]
    assert ends[0] != ends[1] and max(map(len, ends)) < 70
    glued = "1.2.3.4," * 20_000  # many mentions inside one word take linear time
    assert len(pii.find_mentions(glued)[1]) == 20_000


def test_compression_reads_the_whole_text():
    rnd = random.Random(8)
    noise = "".join(rnd.choice("abcdefghijklmnop") for _ in range(140_000))
    mixed = noise[:70_000] + "a" * 70_000
    at = quality.FEATURES.index("compression")
    assert quality.text_features(noise)[at] - quality.text_features(mixed)[at] > 0.2
    assert abs(quality.text_features(mixed)[at] - len(zlib.compress(mixed.encode(), 1)) / 140_000) < 0.01
    assert quality.text_features("abc " * 99)[at] == len(zlib.compress(b"abc " * 99, 1)) / 396 and quality.text_features("")[at] == 1


def test_quality_learns(spark, odd, empty):
    labels = read(spark, "/root/testdata/sf0.01", "labels")
    rows = quality.score_documents(read(spark, "/root/testdata/sf0.01", "documents"), labels).collect()
    truth = {r.doc_id: r.quality for r in labels.collect()}
    held = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert sum(a == b for a, b in held) / len(held) > 0.9
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    few = spark.createDataFrame([(5, 1, 0), (6, None, 1), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    assert quality.score_documents(odd, few).count() == len(ROWS)
    assert quality.score_documents(empty, few).count() == 0


def test_toxicity_learns(spark, odd, empty):
    labels = read(spark, "/root/testdata/sf0.01", "labels")
    rows = toxicity.score_documents(read(spark, "/root/testdata/sf0.01", "documents"), labels).collect()
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    held = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert sum(a == b for a, b in held) / len(held) > 0.9 and not any(a and not b for a, b in held)
    few = spark.createDataFrame([(5, 1, 0), (6, None, 1), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    assert toxicity.score_documents(odd, few).count() == len(ROWS) and toxicity.keep_clean(odd, few).count() == len(ROWS)
    assert toxicity.score_documents(empty, few).count() == 0


def test_dense_beginnings_count_where_they_are_frequent():
    g = toxicity.Grammar({"grubl@2:300": 6.0}, toxicity.Grammar().weights)
    assert g.score("der grublig und grublo") > 0.5 and g.score("grubl grubl") < 0.1 and g.score("der grublig und") < 0.1
    assert g.score("der grublig. " + "wort. " * 200 + "grublo") < 0.1 and g.score("der grublig. " + "wort. " * 20 + "grublo") > 0.5
    assert {"grubl", "grubl@2:600", "=grublig"} <= toxicity.word_forms("Grublig, grublo")
    forms = toxicity.word_forms("grublig " + "wort " * 130 + "grublig " * 2)
    assert "grubl@2:600" in forms and "grubl@3:1000" in forms and "grubl@4:1600" not in forms
    assert "grubl@2:600" not in toxicity.word_forms("grublig " + "wort " * 130 + "grublig")


def test_dense_passages_score_alike_in_long_texts():
    g = toxicity.Grammar({"grubl@2:300": 6.0}, toxicity.Grammar().weights)
    alone = g.score("der grublig. und grublo.")
    assert alone > 0.5 and g.score("wort. " * 3000 + "der grublig. und grublo. " + "wort. " * 3000) == alone


def test_weights_follow_the_transducers():
    of = lambda text: dict(zip(toxicity.FEATURES, toxicity.Grammar().features(text), strict=True))
    weights = lambda text: {k for k, v in of(text).items() if v and k.startswith("weight")}
    assert weights("an idiot") == {"weight I"} and weights("not an idiot") == {"weight In"} and weights("she said an idiot") == {"weight Irp"}
    assert len(toxicity.FEATURES) == len(toxicity.OUTPUTS) + 8 == len(toxicity.Grammar().weights) - 1


def test_lexicon_chooses_from_all_forms(spark):
    rnd = random.Random(9)
    many = " ".join("".join(rnd.choice("abcdefghijklmnop") for _ in range(10)) for _ in range(500))
    rows = [(many, 1)] * 40 + [("zzgrublig", 1)] * 10 + [("clean words only", 0)] * 200
    found = toxicity.learn_lexicon(spark.createDataFrame(rows, "text string, y int"))
    assert any(f.lstrip("=").startswith("zzg") for f in found)


def test_candidates_keep_clear_of_spans():
    text = "1.2.3.4.5@a.bc 999.1.1.1 999.1.1.1 card 4111 1111 1111 1112"
    base = pii.base_spans(text)
    found = pii.candidates(text, base)
    taken = sorted([*base, *found])
    assert [k for _, k, _ in found] == ["ip", "ip", "card"] and not any(a < e and s < b for a, _, b in found for s, k, e in taken if (s, k, e) not in found)
    many = "999.1.1.1 " * 30_000  # many candidates in one text take linear time
    assert len(pii.candidates(many, [])) == 30_000


def test_grammar_reads_clauses():
    g = toxicity.Grammar()
    score = g.score
    assert score("you are an idiot") > score("an idiot") > 0.5 > score("he is not an idiot")
    assert score("she said he is an idiot") < score("he is an idiot") and score("she said no. He is an idiot") > 0.5
    assert score("idiotic") == score("") == score(None) < 0.1


def _brute_chat(rows):
    out = {}
    for conv, said in rows.items():
        out[conv] = (len(said), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in said).encode()).hexdigest(), "".join(t for r, t in said if r == "assistant"))
    return out


def test_chat_query_and_escapes(spark):
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{SF}/conversations.parquet'")
    df = QUERIES["op5_event_sourced_chat"](spark, SF)
    want = con.execute(ORACLE["op5_event_sourced_chat"])
    names = [d[0] for d in want.description]
    assert {tuple(r[n] for n in names) for r in df.collect()} == set(want.fetchall())
    rnd = random.Random(6)
    for _ in range(4000):
        role, text = ("".join(rnd.choice("<|>\\/s[]INST\nend") for _ in range(rnd.randint(0, n))) for n in (6, 16))
        formatted, a, b = chat.render(role, text)
        assert chat.parse(formatted) == (role, text) and formatted.count("<|") == 2 and chat.unescape(formatted[a:b]) == (text if role == "assistant" else "")


def test_chat_edge_rows(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", None), (1, 1, "assistant", None), (1, 2, None, "x"), (1, 2, "assistant", "y" * 3000), (None, 0, "assistant", "z"), (2, None, "user", "")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {r.conv_id: r for r in chat.digest_conversations(chat.format_conversations(spark, df)).collect()}
    assert got[1].n_turns == 5 and got[1].loss_chars == 3000 and got[None].loss_chars == 1 and got[2].n_turns == 1
    assert chat.format_conversations(spark, df.limit(0)).count() == 0


def test_events_fold(spark):
    log = [
        (1, 0, 0, "open", "user", "q"), (1, 1, 1, "open", "assistant", ""), (1, 1, 2, "delta", None, "bad "), (1, 1, 3, "delta", None, "start"),
        (1, 2, 4, "open", "user", "why?"), (1, 1, 5, "regenerate", None, ""), (1, 1, 6, "delta", None, "good"), (1, 2, 7, "open", "user", "thanks"),
        (1, 0, 8, "edit", None, "question"), (2, 0, 0, "open", "user", "gone"), (2, 0, 1, "delete", None, None), (2, 1, 2, "delta", None, "stray"),
    ]
    events = spark.createDataFrame([(c, m, 0, s, k, r, t) for c, m, s, k, r, t in log], chat.EVENT)
    got = [(r.conv_id, *chat.parse(r.formatted)) for r in chat.format_events(events).orderBy("conv_id", "ord").collect()]
    assert got == [(1, "user", "question"), (1, "assistant", "good"), (1, "user", "thanks"), (2, "", "stray")]
