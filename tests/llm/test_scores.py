"""Scores and moves against plain loops: the toxicity grammar, the additive model, the propagation."""

import itertools
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from extracteval.llm import quality, sharding, toxicity

VOCABULARY = toxicity.INSULTS[:4] + toxicity.THREATS[:3] + toxicity.TARGETS[:4] + toxicity.NEGATIONS[:4] + toxicity.REPORTS[:3]


def plain_features(grammar, text):
    """Every clause through the three transducers one after another; dense places by trying all windows."""
    low = text.lower()
    clauses, at = [], 0
    for m in re.finditer(r"[.!?;:\n]+", low):
        clauses.append((at, m.end()))
        at = m.end()
    clauses.append((at, len(low)))
    words = [(m.start(), m[0]) for m in toxicity.WORD.finditer(low)]
    dense = {}
    for form, weight in grammar.forms.items():
        if "@" in form:
            begin, rule = form.split("@")
            hits, chars = map(int, rule.split(":"))
            places = [p for p, w in words if w.startswith(begin) and len(w) > len(begin)]
            for group in itertools.combinations(places, hits):
                if group[-1] - group[0] < chars:
                    for p in group:
                        clause = next(k for k, (a, b) in enumerate(clauses) if a <= p < b)
                        dense.setdefault(clause, {})[begin] = max(weight, dense.get(clause, {}).get(begin, 0))
    out = dict.fromkeys(toxicity.FEATURES, 0.0)
    for k, (a, b) in enumerate(clauses):
        here, tape = dense.get(k, {}), []
        for p, w in words:
            if a <= p < b:
                known = grammar.forms.get("=" + w)
                begins = [v for f, v in grammar.forms.items() if f[0] != "=" and "@" not in f and w.startswith(f)]
                begins += [v for f, v in here.items() if w.startswith(f)]
                insult = known is not None or bool(begins)
                tape.append(("I" if insult else grammar.symbol.get(w, "O"), known if known is not None else max(begins, default=0.0)))
        for machine in (toxicity.negation, toxicity.reported, toxicity.targeted):
            state, new = 0, []
            for symbol, weight in tape:
                state, symbol = machine(state, symbol)
                new.append((symbol, weight))
            tape = new
        for put in {s for s, _ in tape if s[0] in "IT"}:
            out[f"clauses {put}"] += 1
        for symbol, weight in tape:
            if symbol[0] == "I":
                out[f"weight {symbol}"] += weight
    return [math.log1p(out[f]) for f in toxicity.FEATURES]


def test_grammar_scores_as_the_transducers_in_turn():
    rnd = random.Random(4)
    forms = {"=idiot": 6.0, "=moron": 2.0, "grub": 1.5, "zwack@2:60": 3.0, "zwacko@3:90": 5.0}
    grammar = toxicity.Grammar(forms, [rnd.uniform(-2, 2) for _ in range(len(toxicity.FEATURES) + 1)])
    words = VOCABULARY + ["grubber", "zwacken", "zwackoli", "zwack", "fine", "words", "Ünï"]
    for _ in range(400):
        text = "".join(rnd.choice(words).title() + rnd.choice([" ", " ", " ", ", ", ". ", "!\n", ": "]) for _ in range(rnd.randint(0, 40)))
        want = plain_features(grammar, text)
        assert grammar.features(text).tolist() == pytest.approx(want)
        z = grammar.weights[0] + sum(w * x for w, x in zip(grammar.weights[1:], want, strict=True))
        assert grammar.score(text) == pytest.approx(1 / (1 + math.exp(-max(-30, min(30, z)))))


def test_additive_scores_are_sums_over_tables(spark):
    rnd = random.Random(5)
    texts = ["".join(rnd.choice("abcde  .,\n!1") for _ in range(rnd.randint(0, 300))) for _ in range(120)] + ["", "a", "word " * 500]
    x = quality.feature_matrix(texts)
    model = quality.fit(x, np.array([len(t) % 2 for t in texts], dtype=float))
    assert model.pairs and model.tables
    got = quality.score_column(model, F.col("t"))
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", got.alias("s")).orderBy("i").collect()
    for row, features in zip(rows, x.tolist(), strict=True):
        bins = [sum(v >= e for e in edges) for v, edges in zip(features, model.edges, strict=True)]
        z = model.intercept
        for b, table in zip(bins, model.tables, strict=True):
            z += table[b]
        for i, j, table in model.pairs:
            z += table[bins[i], bins[j]]
        assert row.s == pytest.approx(1 / (1 + math.exp(-max(-30, min(30, z)))))


@pytest.mark.parametrize("sizes, singles, shards", [([4, 4, 4], 12, 3), ([6, 2, 2, 2], 12, 2), ([5, 5], 10, 3), ([2] * 9, 18, 4), ([30], 0, 3), ([3, 3, 3, 3], 12, 4)])
def test_propagation_nears_the_least_cut_where_there_is_room(spark, sizes, singles, shards):
    rows = [(f"t{k}", k) for k, n in enumerate(sizes) for _ in range(n)] + [(f"s{k}", None) for k in range(singles)]
    rnd = random.Random(len(rows))
    rnd.shuffle(rows)
    docs = spark.createDataFrame([(i % 3 or None, t) for i, (t, _) in enumerate(rows)], "doc_id bigint, text string")
    out = sharding.shard_documents(docs, shards)
    counts = sorted(r.n for r in out.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect())
    assert sum(counts) == len(rows) and counts[-1] - counts[0] <= 1
    found = sharding.cut_links(out.where(F.col("size") > 0), ["text_crc32"]).first()
    # the least cut: whole texts in shards where they fit, by trying every order of the texts
    n = len(rows)
    capacity = [n // shards + (s < n % shards) for s in range(shards)]
    best = None
    for order in set(itertools.permutations(sizes)) if len(sizes) < 6 else {tuple(sizes)}:
        room, cut = sorted(capacity, reverse=True), 0
        for size in order:
            left, parts = size, []
            fits = [r for r in room if r >= left]
            while left:
                pick = min(fits) if fits else max(room)
                take = min(left, pick)
                room.remove(pick)
                room.append(pick - take)
                parts.append(take)
                left -= take
                fits = [r for r in room if r >= left] if left else []
            cut += size - max(parts)
        best = cut if best is None else min(best, cut)
    assert best <= found.cut <= best + len(rows) // 5


def test_rows_without_an_id_are_spread(spark):
    docs = spark.range(4000).select(F.lit(None).cast("bigint").alias("doc_id"), F.concat(F.lit("t"), F.col("id") % 50).alias("text"))
    nodes = sharding.document_nodes(docs)
    assert nodes.select("bucket").distinct().count() > 1000
    out = sharding.shard_documents(docs).collect()
    assert len(out) == 4000 and len({(r.shard, r.slot) for r in out}) == 4000
