"""Nearest neighbours by a block matrix join with int8 tiles (operator 7).

Rows that are equal in id and vector are one row, and each different vector is compared once: its ids
(at most the ``k + 1`` smallest can be among a query's best) and the queries that ask for it are joined on afterwards.
Vectors are cut into blocks by a hash.  A block keeps int8 codes (one scale a vector), norms and
the norms of what rounding lost, and no float vector.

Candidate blocks are dealt into rows and query blocks into columns of a grid of at most ``CELLS`` cells
(more only where a column would hold over ``COLUMN_QUERIES``), so the number of tasks does not grow with the
square of the table and a block is sent once a column, not once a query block.  A cell holds its queries and
reads its candidate blocks one after another: a tile multiplies int8 codes (exactly, in float32 or
float64) and bounds every inner product: |x.y - x^.y^| <= |x - x^| |y| + |x^| |y - y^|.  Pairs whose upper bound
reaches the query's (k + 1)-th largest lower bound go on; the cells' sorted lists are merged by heaps, which
raises the bar once more.  Survivors fetch both float vectors by key and are recomputed in double precision, so
no true neighbour is lost.  Exact, so recall is 1.

Defined results: vectors that are null, empty, all zero or hold null or non-finite components
take no part, nor do rows without an id; repeated rows count once; rows with one id and different vectors are
candidates of their own, and each of them asks if its id does (its ranks start from 1);
vectors of different lengths are not compared; ties go to the smaller id; a query with fewer
candidates returns them all; an empty table gives no row; other columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from extracteval.llm.common import prepare, stored

NEIGHBOURS = 20
QUERY_EVERY = 20
BLOCK = 4096  # vectors in a block, about
STRIP = 256  # queries of a tile that are multiplied at once
CELLS = 4096  # of the grid
COLUMN_QUERIES = 200_000  # queries that a cell holds, about
SALTS = 64
_BLOCK_TYPE = "block bigint, dim bigint, ka binary, kb binary, codes binary, scale binary, norm binary, lost binary"
_SLACK = 1e-9


def grid(vectors: int, queries: int, block: int = BLOCK) -> tuple[int, int]:
    """Rows and columns of the grid, so that few blocks are sent and no column has too many queries."""
    blocks, asked = max(1, -(-vectors // block)), max(1, -(-queries // block))
    cells = min(CELLS, blocks * asked)
    even = math.sqrt(cells * queries / max(1, vectors))
    columns = min(asked, max(1, round(even), -(-queries // COLUMN_QUERIES)))
    return min(blocks, max(1, cells // columns)), columns


def _pack(table: pa.Table) -> pa.Table:
    """The vectors of a block as codes with their bounds."""
    dim = table.column("dim")[0].as_py()
    x = np.array(table.column("vector").combine_chunks().flatten(), dtype="<f8").reshape(-1, dim)
    scale = np.abs(x).max(axis=1) / 127
    scale[scale == 0] = np.finfo(float).tiny
    codes = np.clip(np.rint(x / scale[:, None]), -127, 127).astype(np.int8)
    lost = np.linalg.norm(x - codes * scale[:, None], axis=1)
    keys = [np.array(table.column(c), dtype="<i8").tobytes() for c in ("ka", "kb")]
    blobs = [*keys, codes.tobytes(), scale.tobytes(), np.linalg.norm(x, axis=1).tobytes(), lost.tobytes()]
    columns = [pa.array([table.column("block")[0].as_py()], pa.int64()), pa.array([dim], pa.int64()), *[pa.array([b], pa.binary()) for b in blobs]]
    return pa.Table.from_arrays(columns, names=[f.split()[0] for f in _BLOCK_TYPE.split(", ")])


class _Block:
    def __init__(self, dim: int, ka: bytes, kb: bytes, codes: bytes, scale: bytes, norm: bytes, lost: bytes):
        self.ka, self.kb = (np.frombuffer(k, "<i8") for k in (ka, kb))
        self.scale, self.norm, self.lost = (np.frombuffer(b, "<f8") for b in (scale, norm, lost))
        self.dim, self.codes = dim, np.frombuffer(codes, np.int8).reshape(-1, dim)
        self.close = np.linalg.norm(self.codes * self.scale[:, None], axis=1)


class _Queries(_Block):
    """A query block with each query's best lower bounds so far and the pairs that may still win."""

    def __init__(self, k: int, *row):
        super().__init__(*row)
        self.k = k
        self.best = np.full((len(self.ka), k), -np.inf)
        self.pairs: list[tuple[np.ndarray, ...]] = []

    def meet(self, other: _Block) -> None:
        exact = np.float32 if 127 * 127 * self.dim < 1 << 24 else np.float64
        right = np.ascontiguousarray(other.codes.T.astype(exact))
        for at in range(0, len(self.ka), STRIP):
            rows = slice(at, at + STRIP)
            near = (self.codes[rows].astype(exact) @ right).astype(np.float64) * self.scale[rows, None] * other.scale
            error = self.lost[rows, None] * other.norm + self.close[rows, None] * other.lost
            near_to = self.lost[rows, None] * other.norm + self.norm[rows, None] * other.lost
            error = np.maximum(error, near_to) + _SLACK * (self.norm[rows, None] * np.maximum(other.norm, other.close))
            low, high = near - error, near + error
            both = np.concatenate([self.best[rows], low], axis=1)
            self.best[rows] = np.partition(both, both.shape[1] - self.k, axis=1)[:, -self.k :]
            r, c = np.nonzero(high >= self.best[rows].min(axis=1)[:, None])
            self.pairs.append((r + at, other.ka[c], other.kb[c], low[r, c], high[r, c]))
        if sum(len(p[0]) for p in self.pairs) > 64 * self.k * len(self.ka):
            self.prune()

    def prune(self) -> None:
        q, *rest = (np.concatenate(x) for x in zip(*self.pairs, strict=True))
        kept = rest[-1] >= self.best.min(axis=1)[q]
        self.pairs = [tuple(x[kept] for x in (q, *rest))]

    def rows(self) -> Iterator[tuple]:
        """By query: its key and its pairs' keys and bounds, largest lower bound first."""
        if not self.pairs:
            return
        self.prune()
        q, ka, kb, low, high = self.pairs[0]
        order = np.lexsort((-low, q))
        q, ka, kb, low, high = (x[order] for x in (q, ka, kb, low, high))
        for i, part in enumerate(np.split(np.arange(len(q)), np.searchsorted(q, np.arange(1, len(self.ka))))):
            if len(part):
                yield int(self.ka[i]), int(self.kb[i]), *(x[part].tobytes() for x in (ka, kb, low, high))


_PAIRS = [("qa", pa.int64()), ("qb", pa.int64()), ("ka", pa.binary()), ("kb", pa.binary()), ("low", pa.binary()), ("high", pa.binary())]


def _multiply(k: int):
    names = ["cell", "asks", *[f.split()[0] for f in _BLOCK_TYPE.split(", ")][1:]]

    def out(queries: list[_Queries]) -> Iterator[pa.RecordBatch]:
        for q in queries:
            rows = list(q.rows())
            for at in range(0, len(rows), 512):
                columns = zip(*rows[at : at + 512], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, _PAIRS, strict=True)], names=[n for n, _ in _PAIRS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows come sorted by cell, a cell's queries first
        now, queries = None, []
        for b in batches:
            for at in range(b.num_rows):
                cell, asks, *row = (b.column(names.index(n))[at].as_py() for n in names)
                if cell != now:
                    yield from out(queries)
                    now, queries = cell, []
                if asks:
                    queries.append(_Queries(k, *row))
                else:
                    block = _Block(*row)
                    for q in queries:
                        if q.dim == block.dim:
                            q.meet(block)
        yield from out(queries)

    return names, run


def _merge(k: int):
    """Sorted lists of a query from all cells, merged by a heap up to the k-th lower bound."""

    def out(now: tuple, lists: list[tuple]) -> pa.RecordBatch:
        lows = heapq.merge(*[(-x[2]).tolist() for x in lists])
        best = [v for _, v in zip(range(k), lows, strict=False)]
        bar = -best[-1] if len(best) == k else -np.inf
        ka, kb = (np.concatenate([x[i][x[3] >= bar] for x in lists]) for i in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array([v] * len(ka), pa.int64()) for v in now] + [pa.array(ka), pa.array(kb)], names=["qa", "qb", "ka", "kb"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, lists = None, []
        for b in batches:
            for qa, qb, *blobs in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (qa, qb) != now:
                    if lists:
                        yield out(now, lists)
                    now, lists = (qa, qb), []
                lists.append(tuple(np.frombuffer(x, t) for x, t in zip(blobs, ("<i8", "<i8", "<f8", "<f8"), strict=True)))
        if lists:
            yield out(now, lists)

    return run


def near_pairs(vectors: DataFrame, k: int, block: int = BLOCK) -> DataFrame:
    """(qa, qb, ka, kb): for each asking vector all that may be among its ``k`` largest inner products.

    ``vectors`` has ka, kb (its key), vector, dim and asks, one row for each different vector; stored.
    """
    sizes = vectors.agg(F.count(F.lit(1)).alias("n"), F.count_if("asks").alias("q")).first()
    rows, columns = grid(sizes.n, sizes.q, block)

    def blocks(part: DataFrame, count: int) -> DataFrame:
        keyed = part.select(F.pmod("ka", F.lit(count)).alias("block"), "dim", "ka", "kb", "vector")
        return keyed.groupBy("block", "dim").applyInArrow(_pack, _BLOCK_TYPE)

    def cells(asks: bool, count: int) -> DataFrame:
        held = stored(blocks(vectors.where("asks") if asks else vectors, max(1, -(-count // block))), "search-blocks")
        line = F.pmod("block", F.lit(columns if asks else rows))
        every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit((rows if asks else columns) - 1).cast("bigint")))
        met = held.withColumn("line", line).withColumn("other", every)
        cell = F.col("other") * columns + F.col("line") if asks else F.col("line") * columns + F.col("other")
        return met.select(cell.alias("cell"), F.lit(asks).alias("asks"), *held.columns).drop("block")

    names, run = _multiply(k)
    both = cells(True, sizes.q).unionByName(cells(False, sizes.n))
    dealt = both.repartition(rows * columns, "cell").sortWithinPartitions("cell", F.desc("asks")).select(*names)
    lists = dealt.mapInArrow(run, "qa bigint, qb bigint, ka binary, kb binary, low binary, high binary")
    gathered = lists.repartition("qa", "qb").sortWithinPartitions("qa", "qb")
    return gathered.mapInArrow(_merge(k), "qa bigint, qb bigint, ka bigint, kb bigint")


def nearest(vectors: DataFrame, k: int = NEIGHBOURS, query_every: int = QUERY_EVERY, block: int = BLOCK, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` largest inner products of each query."""
    prepare(vectors.sparkSession)
    v = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    v = v.where(F.col("vec_id").isNotNull() & (F.size("vector") > 0) & fine & F.exists("vector", lambda x: x != 0))
    # 0.0 and -0.0 are one number
    v = v.select("vec_id", F.transform("vector", lambda x: x + F.lit(0.0)).alias("vector"))
    keyed = v.select("vec_id", F.xxhash64("vector").alias("ka"), F.xxhash64(F.lit("vector"), "vector").alias("kb"), "vector")
    asks = F.pmod("vec_id", F.lit(query_every)) == 0
    by_key = keyed.groupBy("ka", "kb").agg(F.any_value("vector").alias("vector"), F.max(asks).alias("asks"))
    different = stored(by_key.select("ka", "kb", "vector", F.size("vector").cast("bigint").alias("dim"), "asks"), "search-vectors")
    rows = stored(keyed.select("vec_id", "ka", "kb").distinct(), "search-rows")

    # of the rows with one vector only the k + 1 smallest ids can be among a query's best
    def least(df: DataFrame, *by) -> DataFrame:
        w = Window.partitionBy(*by).orderBy("vec_id")
        return df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= k + 1).drop("_n")

    salted = rows.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)))
    ids = least(least(salted, "ka", "kb", "salt"), "ka", "kb").select("ka", "kb", "vec_id")

    pairs = near_pairs(different, k + 1, block)
    held = different.select("ka", "kb", "vector")
    query = held.select(F.col("ka").alias("qa"), F.col("kb").alias("qb"), F.col("vector").alias("asked"))
    met = pairs.join(held, ["ka", "kb"]).join(query, ["qa", "qb"])
    product = F.aggregate(F.zip_with("asked", "vector", lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)
    scored = met.select("qa", "qb", "ka", "kb", product.alias("score")).join(ids, ["ka", "kb"])
    by_vector = Window.partitionBy("qa", "qb").orderBy(F.desc("score"), "vec_id")
    best = scored.withColumn("_n", F.row_number().over(by_vector)).where(F.col("_n") <= k + 1).drop("_n")

    queries = rows.where(asks).select(F.col("vec_id").alias("query_id"), F.col("ka").alias("qa"), F.col("kb").alias("qb"))
    own = (F.col("vec_id") == F.col("query_id")) & (F.col("ka") == F.col("qa")) & (F.col("kb") == F.col("qb"))
    found = queries.join(best, ["qa", "qb"]).where(~own)
    by_query = Window.partitionBy("query_id", "qa", "qb").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
