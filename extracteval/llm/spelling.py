"""Spelling variants by a relational trie frontier (operator 13).

Words are the runs of letters of all texts, with a rare, reproducible slip (one letter left out where the
hash of document and run says so), that are long and frequent enough.  Two words are near if one
inserted, deleted or replaced code point turns one into the other.

The trie is a distributed edge table.  A node is a prefix after which words differ, so an edge carries
the letters up to the next such prefix (or to the end of a word).  The frontier holds states
(word, position, node, edits) and is joined with the edge table level by level: an edge is walked
exactly, or, by a state without an edit, with one letter replaced or one letter of the word left out.
A state that ends at a word's end with one edit is a neighbour.  Insertions are the deletions of the
other word, and of two letters only the smaller is replaced, so a pair is met in one direction.

An edit lies in the second half of a word or, read backwards, in the second half of the reversed word:
a second trie holds the words reversed, and in both the frontier starts at the deepest node
of the first half.  States that carry an edit therefore arise only where the trie is sparse.  Each level
is written to the shared folder; the number of levels is the longest chain of branching prefixes in a
second half.

Defined results: null and empty texts hold no word; a null ``doc_id`` counts as empty text in the slip's
hash; repeated rows count again; runs of any length are words as a whole; ties for the form go to the
smallest word in code-point order; an empty table gives no row; other columns are not read.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from extracteval.llm.common import id_text, prepare, stored, text_or_empty

LETTERS = "A-Za-zÀ-ÿ"
MIN_LENGTH = 6
MIN_COUNT = 5
SLIP = 199
DOMINANCE = 5


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def count_words(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, slip: int = SLIP) -> DataFrame:
    """(word, n) for the words of at least ``min_length`` code points and ``min_count`` occurrences."""
    # a slip only shortens a run, so shorter runs can be passed over
    pattern = F.lit(f"[{LETTERS}]{{{min_length},}}")
    runs = docs.select(id_text().alias("id"), F.explode(F.regexp_extract_all(text_or_empty(), pattern, F.lit(0))).alias("run"))
    low = runs.select("id", lower_ascii(F.col("run")).alias("run"))
    hashed = low.select("run", F.crc32(F.encode(F.concat_ws(":", "id", "run"), "UTF-8")).alias("h"))
    at = F.pmod(F.col("h"), F.length("run")).cast("int")
    slipped = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = hashed.select(F.when(F.col("h") % slip == 0, slipped).otherwise(F.col("run")).alias("word"))
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.where((F.col("n") >= min_count) & (F.length("word") >= min_length))


def _node(depth: Column) -> Column:
    return F.xxhash64("side", F.substring("walk", F.lit(1), depth))


def trie_paths(words: DataFrame) -> DataFrame:
    """(side, walk, inner): each word forwards and backwards, with the depths of its branching prefixes."""
    sides = F.array(F.struct(F.lit(0).alias("side"), F.col("word").alias("walk")), F.struct(F.lit(1).alias("side"), F.reverse("word").alias("walk")))
    walks = words.select(F.inline(sides))
    prefixes = walks.select("side", "walk", F.explode(F.sequence(F.lit(1), F.length("walk"))).alias("depth"))
    steps = prefixes.select("side", "walk", "depth", _node(F.col("depth")).alias("node"))
    after = F.substring("walk", F.col("depth") + 1, F.lit(1))
    branching = steps.groupBy("node").agg(F.min(after).alias("low"), F.max(after).alias("high")).where("low <> high").select("node")
    inner = steps.join(branching, "node", "left_semi").select("side", "walk", "depth")
    # every word has a row of its own, also without a branching prefix
    marks = inner.unionByName(walks.select("side", "walk", F.lit(0).alias("depth")))
    return marks.groupBy("side", "walk").agg(F.sort_array(F.collect_list("depth")).alias("inner"))


def trie_edges(paths: DataFrame) -> DataFrame:
    """(parent, label, child, leaf, target): target is the word that ends at the child, if one does."""
    size = F.length("walk")
    depths = F.array_distinct(F.concat("inner", F.array(size)))
    pairs = paths.select("side", "walk", "inner", F.arrays_zip(depths.alias("a"), F.slice(depths, F.lit(2), F.size(depths)).alias("b")).alias("pairs"))
    rows = pairs.select("side", "walk", "inner", F.inline("pairs")).where("b IS NOT NULL")
    edges = rows.select(
        _node(F.col("a")).alias("parent"), F.substring("walk", F.col("a") + 1, F.col("b") - F.col("a")).alias("label"),
        _node(F.col("b")).alias("child"), (~F.array_contains("inner", F.col("b"))).alias("leaf"),
        F.when(F.col("b") == size, F.col("walk")).alias("target"),
    )
    return edges.groupBy("parent", "label", "child").agg(F.min("leaf").alias("leaf"), F.max("target").alias("target"))


def first_states(paths: DataFrame) -> DataFrame:
    """States without an edit at the deepest node of each word's first half."""
    size = F.length("walk")
    half = F.floor(size / 2).cast("int")
    bound = F.when(F.col("side") == 0, half).otherwise(size - half)
    # at least two letters are left to walk, so a word without its last letter is met on the way
    at = F.array_max(F.filter("inner", lambda d: (d <= bound) & (d <= F.greatest(size - 2, F.lit(0)))))
    placed = paths.select("side", "walk", at.alias("pos"))
    return placed.select("side", "walk", "pos", _node(F.col("pos")).alias("node"), F.lit(0).alias("edits"))


def next_states(states: DataFrame, edges: DataFrame) -> DataFrame:
    """The frontier one level on, with the leaf and target of the edge that each state walked."""
    met = states.join(edges, states.node == edges.parent)
    size, pos, clean = F.length("label"), F.col("pos"), F.col("edits") == 0
    here, longer = F.substring("walk", pos + 1, size), F.substring("walk", pos + 1, size + 1)
    read = met.select("side", "walk", "pos", "edits", "label", "child", "leaf", "target", size.alias("size"), here.alias("here"), longer.alias("longer"))
    to = lambda step, edits: F.struct((pos + F.col("size") + step).alias("pos"), edits.alias("edits"))
    replaced = clean & (F.col("here") < F.col("label")) & (F.length("here") == F.col("size")) & (F.levenshtein("here", "label", 1) == 1)
    left_out = clean & (F.length("longer") == F.col("size") + 1) & (F.levenshtein("longer", "label", 1) == 1)
    moves = F.array(
        F.when(F.col("here") == F.col("label"), to(0, F.col("edits"))), F.when(replaced, to(0, F.lit(1))), F.when(left_out, to(1, F.lit(1))),
    )
    walked = read.select("side", "walk", "leaf", "target", F.col("child").alias("node"), F.explode(moves).alias("move")).where("move IS NOT NULL")
    return walked.select("side", "walk", "node", "leaf", "target", "move.pos", "move.edits")


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, other) in both directions for all words one edit apart; ``words`` has distinct ``word``."""
    paths = stored(trie_paths(words), "spelling-paths")
    edges = stored(trie_edges(paths), "spelling-edges")
    states, found = first_states(paths), None
    size = F.length("walk")
    while True:
        level = stored(next_states(states, edges), "spelling-frontier")
        ends = ((F.col("edits") == 1) & (F.col("pos") == size)) | ((F.col("edits") == 0) & (F.col("pos") == size - 1))
        met = level.where(F.col("target").isNotNull() & ends).select("side", "walk", "target")
        found = met if found is None else found.unionByName(met)
        states = level.where(~F.col("leaf") & (F.col("pos") < size)).select("side", "walk", "pos", "node", "edits")
        if states.isEmpty():
            break
    ways = [F.when(F.col("side") == 0, F.col(c)).otherwise(F.reverse(c)).alias(n) for c, n in (("walk", "word"), ("target", "other"))]
    # nodes are hashes of prefixes: two that meet by chance add states, which this check removes
    pairs = found.select(*ways).where(F.levenshtein("word", "other", 1) == 1)
    both = F.array(F.struct("word", "other"), F.struct(F.col("other").alias("word"), F.col("word").alias("other")))
    return pairs.select(F.inline(both)).distinct()


def follow_forms(forms: DataFrame) -> DataFrame:
    """(word, root): forms followed to the last, each round doubling the steps.

    ``forms`` has (word, form) for the words with a form.  Counts grow along forms, so no path returns.
    """
    roots = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        on = roots.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        step = roots.join(on, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved"))
        roots = stored(step, "spelling-roots")
        if roots.where("moved").isEmpty():
            return roots.select("word", "root")


def spelling_variants(
    docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, slip: int = SLIP, dominance: int = DOMINANCE
) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word."""
    prepare(docs.sparkSession)
    words = stored(count_words(docs, min_length, min_count, slip), "spelling-words")
    others = words.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    pairs = near_pairs(words.select("word")).join(others, "other")
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other"))).alias("best")
    near = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    joined = words.join(near, "word", "left")
    strong = -F.col("best.less") >= dominance * F.col("n")
    rows = stored(
        joined.select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
            F.when(strong, F.col("best.other")).alias("form"), F.when(strong, -F.col("best.less")).alias("form_n"),
        ),
        "spelling-forms",
    )
    roots = follow_forms(rows.where("form IS NOT NULL"))
    return rows.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


# The same from each word's texts with one letter left out; crc32 byte by byte with its table made from the rule.
ORACLE_SQL = r"""
WITH RECURSIVE t AS (
  SELECT list(list_reduce([n, 0, 1, 2, 3, 4, 5, 6, 7], lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY n) AS steps
  FROM (SELECT unnest(range(0, 256)) AS n)
), runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
    translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents
), counted AS (SELECT id, run, count(*) AS n, hex(encode(id || ':' || run)) AS h FROM runs WHERE length(run) >= 6 GROUP BY ALL),
hashed AS (
  SELECT run, n, length(run) AS size, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(range(0, strlen(h) // 2), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT))),
    lambda c, b: xor(c >> 8, t.steps[(xor(c, b) % 256) + 1]))) AS hash
  FROM counted, t
), words AS (
  SELECT CASE WHEN hash % 199 = 0 THEN substr(run, 1, hash % size) || substr(run, hash % size + 2) ELSE run END AS word, CAST(sum(n) AS BIGINT) AS n
  FROM hashed GROUP BY 1 HAVING sum(n) >= 5 AND length(word) >= 6
), gaps AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT DISTINCT a.word, b.word AS other, b.n AS other_n FROM gaps a JOIN gaps b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT g.word, w.word, w.n FROM gaps g JOIN words w ON w.word = g.rest
  UNION SELECT w.word, g.word, g.n FROM gaps g JOIN words w ON w.word = g.rest
), best AS (SELECT word, count(*) AS n_near, arg_min(other, (-other_n, other)) AS other, max(other_n) AS other_n FROM near GROUP BY word),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 5 * w.n THEN other END AS form, CASE WHEN other_n >= 5 * w.n THEN other_n END AS form_n
  FROM words w LEFT JOIN best ON best.word = w.word
), path AS (
  SELECT word, word AS root FROM forms
  UNION SELECT path.word, forms.form FROM path JOIN forms ON forms.word = path.root WHERE forms.form IS NOT NULL
)
SELECT forms.word, forms.form, path.root, forms.n, CAST(forms.n_near AS BIGINT) AS n_near, CAST(forms.form_n AS BIGINT) AS form_n
FROM forms JOIN path ON path.word = forms.word JOIN forms last ON last.word = path.root AND last.form IS NULL
"""
