"""The block search against brute force: repeated ids and vectors, odd columns, and the grid's size."""

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from extracteval.llm import block_search
from extracteval.llm.block_search import grid, nearest


def product(x, y):
    total = 0.0  # sum() would correct the rounding
    for a, b in zip(x, y, strict=True):
        total += a * b
    return total


def plain(rows, k=20, every=20):
    rows = sorted({(i, tuple(v)) for i, v in rows})
    out = defaultdict(list)
    for i, x in rows:
        if i % every == 0:
            others = [(-product(x, y), j) for j, y in rows if (j, y) != (i, x) and len(x) == len(y)]
            out[i].append([(n, j, -s) for n, (s, j) in enumerate(sorted(others)[:k], 1)])
    return {i: sorted(v) for i, v in out.items()}


def found(df, **options):
    got = defaultdict(list)
    for r in nearest(df, **options).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    return got


@pytest.mark.parametrize("cells", [1, 6, 4096])
def test_repeated_ids_vectors_and_clashing_columns(spark, monkeypatch, cells):
    monkeypatch.setattr(block_search, "CELLS", cells)
    rnd = np.random.default_rng(2)
    rows = [(int(i), rnd.normal(size=4).round(2).tolist()) for i in rnd.integers(0, 200, 260)]
    rows += rows[:30]  # repeated rows
    rows += [(i, [0.5, 0.25, -1.0, 2.0]) for i in range(300, 380)]  # one common vector
    rows += [(7, [0.5, 0.25, -1.0, 2.0]), (400, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
    odd = df.withColumns({c: F.lit("x") for c in ("ka", "kb", "vector", "block", "cell", "asks", "rank", "score", "query_id", "dim")})
    want = plain(rows, 5)
    got = found(odd, k=5, block=40)
    assert sorted(got) == sorted(i for i, lists in want.items() if any(lists))
    for i, lists in got.items():
        assert sorted(lists) == sorted(x for part in want[i] for x in part)


def test_the_best_row_of_an_id_counts(spark):
    rows = [(0, [1.0]), (1, [0.5]), (1, [0.9]), (2, [0.7])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    assert [(n, j) for n, j, _ in sorted(found(df)[0])] == [(1, 1), (2, 2), (3, 1)]


def test_tasks_do_not_grow_with_the_square():
    for n in (10**3, 10**6, 10**8):
        rows, columns = grid(n, n // 20)
        assert 1 <= rows * columns < 10_000
        assert n // 20 / columns <= 2 * block_search.COLUMN_QUERIES + block_search.BLOCK
    assert grid(0, 0) == (1, 1)
    rows, columns = grid(10**10, 10**10 // 20)
    assert rows >= 1 and columns * block_search.COLUMN_QUERIES >= 10**10 // 20
