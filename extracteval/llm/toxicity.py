"""Toxicity by a weighted finite-state pattern grammar (operator 8).

Words of a clause are read as symbols (insult, threat, target, negation, reported speech, other).
Three small transducers rewrite them: negation marks what follows within a few words, reported
speech marks the rest of the clause, target marks insults and threats near a person.  They are
composed into one table, which is run over every clause that holds an insult or threat; what it
puts out (plain, targeted, negated, reported ...) is counted by clause, the weights of insults are
added up by output, and a logistic model weights both.  The insult lexicon is a few fixed words plus words and word beginnings learned from
labelled texts by greedy cover: the form that best tells the toxic texts that are still unexplained.
A word beginning may ask for a density: it then counts only where it stands so many times within a
window of fixed length, whichever clauses the window spans.  What a passage puts out does not
depend on the length of the text around it.

The model is fitted on at most ``FIT_ROWS`` labelled rows (least hashes of the id) and only on rows
outside the held-out fifth; the score uses nothing but the text.

Defined results: null and empty texts score as texts with no match; a text of any length is read whole; a score
equal to the threshold is toxic; equal candidate forms go by length and spelling; null ids count as empty text
for the held-out rule; a document with several labels counts by their mean, rounded half up;
repeated rows each get a row; without labels the fixed lexicon and weights serve; other columns
are not read.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from extracteval.llm.common import held_out, prepare, stored

FIT_ROWS = 20_000
FIXED_WEIGHT = 6.0  # of the grammar's own insults where no label tells more
LEAST_GAIN = 10  # of a form that the greedy cover chooses
DENSITIES = ((2, 600), (3, 1_000), (4, 1_600))  # occurrences of a dense beginning within so many characters
NOISE = 0.5  # a learned form may be in so many other texts for each toxic one
THRESHOLD = 0.5
FORMS_HELD = 50_000  # forms that a counting worker holds before it hands them on

# The grammar's own words.
INSULTS = "idiot moron stupid loser scum trash clown pathetic worthless disgusting imbecile".split()
THREATS = "kill hurt destroy beat burn stab shoot strangle".split()
TARGETS = "you your yours he him his she her they them their u".split()
NEGATIONS = "not no never without isn't aren't wasn't don't doesn't nobody hardly".split()
REPORTS = "said says say wrote called calls claimed claims reported quoted according alleged".split()

WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
CLAUSE_END = re.compile(r"[.!?;:\n]+")
NEGATION_SCOPE, TARGET_SCOPE = 3, 4


def clause_cuts(low: str) -> list[int]:
    """Where clauses begin, and the end of the text."""
    ends = [m.end() for m in CLAUSE_END.finditer(low)]
    return [0, *ends, len(low)] if not ends or ends[-1] < len(low) else [0, *ends]


def dense_starts(starts: list[int], hits: int, chars: int) -> list[int]:
    """Those of ascending ``starts`` that lie in a window of ``chars`` with at least ``hits`` of them."""
    kept = set()
    for i, (a, b) in enumerate(zip(starts, starts[hits - 1 :], strict=False)):
        if b - a < chars:
            kept.update(starts[i : i + hits])
    return sorted(kept)


def negation(state: int, symbol: str) -> tuple[int, str]:
    if symbol == "N":
        return NEGATION_SCOPE, symbol
    out = symbol + "n" if state and symbol[0] in "IT" else symbol
    return max(0, state - 1), out


def reported(state: int, symbol: str) -> tuple[int, str]:
    if symbol == "R":
        return 1, symbol
    return state, symbol + "r" if state and symbol[0] in "IT" else symbol


def targeted(state: int, symbol: str) -> tuple[int, str]:
    if symbol == "P":
        return TARGET_SCOPE, symbol
    out = symbol + "p" if state and symbol[0] in "IT" else symbol
    return max(0, state - 1), out


def compose(*machines, alphabet: str = "OITPNR") -> tuple[dict, list[str]]:
    """One table (state, symbol) -> (state, output) that runs the machines one after another."""
    start = (0,) * len(machines)
    table, todo, outputs = {}, [start], set()
    names = {start: 0}
    while todo:
        state = todo.pop()
        for symbol in alphabet:
            out, after = symbol, []
            for machine, s in zip(machines, state, strict=True):
                s, out = machine(s, out)
                after.append(s)
            after = tuple(after)
            if after not in names:
                names[after] = len(names)
                todo.append(after)
            table[names[state], symbol] = (names[after], out)
            outputs.add(out)
    return table, sorted(o for o in outputs if o[0] in "IT")


TABLE, OUTPUTS = compose(negation, reported, targeted)
INSULTED = [o for o in OUTPUTS if o[0] == "I"]
FEATURES = [f"clauses {o}" for o in OUTPUTS] + [f"weight {o}" for o in INSULTED]


@dataclass
class Grammar:
    """Lexicon and weights; ``forms`` are words ("=idiot"), word beginnings ("idio") and dense word
    beginnings ("idio@2:600", twice within 600 characters or more often) with their weights."""

    forms: dict[str, float] = field(default_factory=lambda: {"=" + w: FIXED_WEIGHT for w in INSULTS})
    weights: list[float] = field(default_factory=lambda: [-4.0] + [
        (6.0 if o[0] == "I" else 3.0) - (6.0 if "n" in o else 0) - (4.0 if "r" in o else 0) + ("p" in o) for o in OUTPUTS
    ] + [0.0 if "n" in o or "r" in o else 0.6 for o in INSULTED])

    def __post_init__(self) -> None:
        fixed = {"T": THREATS, "P": TARGETS, "N": NEGATIONS, "R": REPORTS}
        self.symbol = {w: s for s, words in fixed.items() for w in words}
        whole = [re.escape(f[1:]) + r"(?![^\W\d_])" for f in self.forms if f[0] == "="]
        begin = [re.escape(f) for f in self.forms if f[0] != "=" and "@" not in f]
        threats = [w + r"(?![^\W\d_])" for w in THREATS]
        self.insult = re.compile("|".join(whole + begin) or "(?!)")
        self.beginnings = [f for f in self.forms if f[0] != "=" and "@" not in f]
        parts = [f.rsplit("@", 1) for f in sorted(self.forms) if f[0] != "=" and "@" in f]
        self.dense = [(b, density, re.compile(r"(?<![^\W\d_])" + re.escape(b) + r"(?=[^\W\d_])")) for b, density in parts]
        self.hit = re.compile(r"(?<![^\W\d_])(?:" + "|".join(whole + begin + threats) + ")")

    def weight(self, word: str, active: dict[str, float]) -> float:
        found = self.forms.get("=" + word)
        if found is None:
            plain = [self.forms[f] for f in self.beginnings if word.startswith(f)]
            found = max(plain + [w for b, w in active.items() if word.startswith(b)], default=0.0)
        return found

    def dense_hits(self, low: str, cuts: list[int]) -> dict[int, dict[str, float]]:
        """By clause, the dense beginnings that it holds at a dense place, with their weights."""
        active: dict[int, dict[str, float]] = {}
        for begin, density, pattern in self.dense:
            if begin in low:
                for start in dense_starts([m.start() for m in pattern.finditer(low)], *map(int, density.split(":"))):
                    here = active.setdefault(bisect_right(cuts, start) - 1, {})
                    here[begin] = max(here.get(begin, 0.0), self.forms[f"{begin}@{density}"])
        return active

    def features(self, text: str | None) -> np.ndarray:
        out = np.zeros(len(FEATURES))
        low = (text or "").lower()
        hits = [m.start() for m in self.hit.finditer(low)]
        if not hits and not any(begin in low for begin, _, _ in self.dense):
            return out
        cuts = clause_cuts(low)
        dense = self.dense_hits(low, cuts)
        clauses = sorted({bisect_right(cuts, at) - 1 for at in hits} | set(dense))
        for k in clauses:
            state, seen = 0, set()
            active = dense.get(k, {})
            often = tuple(active)
            for m in WORD.finditer(low, cuts[k], cuts[k + 1]):
                word = m[0]
                symbol = "I" if self.insult.match(word) or word.startswith(often) else self.symbol.get(word, "O")
                state, put = TABLE[state, symbol]
                if put[0] in "IT":
                    seen.add(put)
                    if put[0] == "I":
                        out[len(OUTPUTS) + INSULTED.index(put)] += self.weight(word, active)
            for put in seen:
                out[OUTPUTS.index(put)] += 1
        out[:] = np.log1p(out)
        return out

    def score(self, text: str | None) -> float:
        z = self.weights[0] + float(np.dot(self.weights[1:], self.features(text)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def word_forms(text: str | None) -> set[str]:
    """Forms that a text holds: words, word beginnings and dense word beginnings."""
    words = [(m.start(), m[0]) for m in WORD.finditer((text or "").lower())]
    at: dict[str, list[int]] = {}
    for start, w in words:
        for k in range(3, min(9, len(w))):
            at.setdefault(w[:k], []).append(start)
    dense = {
        f"{b}@{hits}:{chars}"
        for b, starts in at.items()
        for hits, chars in DENSITIES
        if any(y - x < chars for x, y in zip(starts, starts[hits - 1 :], strict=False))
    }
    return {"=" + w for _, w in words} | at.keys() | dense


def _count_forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = (Counter(), Counter())
    for b in batches:
        for text, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            counts[toxic].update(word_forms(text))
        if sum(map(len, counts)) > FORMS_HELD:  # sums are added up by form later
            yield _form_rows(counts)
            counts = (Counter(), Counter())
    yield _form_rows(counts)


def _form_rows(counts: tuple[Counter, Counter]) -> pa.RecordBatch:
    rows = [(f, n, 0) for f, n in counts[1].items()] + [(f, 0, n) for f, n in counts[0].items()]
    columns = list(zip(*rows, strict=True)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())], names=["form", "pos", "neg"])


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int = FIT_ROWS) -> DataFrame:
    """text, y of at most ``rows`` labelled documents outside the held-out fifth, stored."""
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg((F.avg(label) >= 0.5).cast("int").alias("y"))
    chosen = known.where(~held_out()).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    # at most ``rows`` ids and labels are sent out, so the texts need no shuffle
    both = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return stored(both.select("text", "y"), "labelled")


def learn_lexicon(sample: DataFrame) -> dict[str, float]:
    """Greedy cover of the toxic texts by the forms that tell them best."""
    total = {r.y: r.n for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_pos, n_neg = total.get(1, 0), total.get(0, 0)
    base = {"=" + w: FIXED_WEIGHT for w in INSULTS}
    if not n_pos or not n_neg:
        return base
    counted = sample.mapInArrow(_count_forms, "form string, pos bigint, neg bigint").groupBy("form").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    lift = F.log((F.col("pos") + 0.5) / (n_pos + 1)) - F.log((F.col("neg") + 0.5) / (n_neg + 1))
    # a form's gain is greatest before any text is explained, so no other form can ever be chosen
    gain = F.col("pos") * lift - F.col("neg")
    chosen = (gain >= LEAST_GAIN - 1e-6) | F.col("form").isin(list(base))
    table = counted.where((F.col("pos") >= 2) & (lift > 1.5) & chosen).select("form", "neg").collect()
    neg = {r.form: r.neg for r in table}
    wanted = set(neg)

    @F.pandas_udf("array<string>")
    def held(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: sorted(word_forms(t) & wanted))

    groups: dict[str, set[int]] = {f: set() for f in neg}
    for i, r in enumerate(sample.where("y = 1").select(held("text").alias("forms")).collect()):  # at most FIT_ROWS short lists
        for f in r.forms:
            groups[f].add(i)
    def log_odds(f: str) -> float:
        return math.log((len(groups[f]) + 0.5) / (n_pos + 1)) - math.log((neg[f] + 0.5) / (n_neg + 1))

    groups = {f: g for f, g in groups.items() if neg[f] <= NOISE * len(g)}
    found = dict(base)
    left = set(range(n_pos)) - set().union(*(groups.get(f, set()) for f in base))
    while left:
        def value(f: str) -> tuple:
            p = len(groups[f] & left)
            gain = p * (math.log((p + 0.5) / (n_pos + 1)) - math.log((neg[f] + 0.5) / (n_neg + 1))) - neg[f]
            return gain, f[0] == "=", len(f), f

        best = max(groups, key=value, default=None)
        if best is None or len(groups[best] & left) < max(2, n_pos // 200) or value(best)[0] < LEAST_GAIN:
            break
        found[best] = log_odds(best)
        left -= groups.pop(best)
    return found


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> list[float]:
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (y - p) - ridge * w)
        w = w + np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-6:
            break
    return w.tolist()


def learn_grammar(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Grammar:
    prepare(docs.sparkSession)
    sample = labelled_sample(docs, labels, "toxic", rows)
    grammar = Grammar(learn_lexicon(sample))

    @F.pandas_udf("array<double>")
    def vector(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: grammar.features(t).tolist())

    got = sample.select("y", vector("text").alias("x")).collect()  # at most FIT_ROWS short vectors
    if len({r.y for r in got}) == 2:
        order = sorted((r.y, r.x) for r in got)
        grammar.weights = fit_logistic(np.array([x for _, x in order]), np.array([y for y, _ in order], dtype=float))
    return grammar


def score_column(grammar: Grammar, text: Column) -> Column:
    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([grammar.score(t) for t in texts], dtype=float)

    return run(text)


def score_documents(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    grammar = learn_grammar(docs, labels, rows)
    scored = docs.select("doc_id", held_out().alias("held_out"), score_column(grammar, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_clean(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the documents whose score reaches ``threshold``."""
    grammar = learn_grammar(docs, labels, rows)
    return docs.where(score_column(grammar, F.col("text")) < threshold)
