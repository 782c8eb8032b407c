"""SimHash near-duplicates by covering locality-sensitive hashing (operator 10).

A fingerprint bit is set where more than half of a text's shingle hashes have it.  Two
fingerprints are linked within ``radius`` bits.  Each bit position gets a vector of radius + 1
binary digits; for each non-zero v the mask of the positions whose vector has an odd product with
v defines one table.  Any ``radius`` positions leave a non-zero v orthogonal to all of their
vectors, so every pair within the radius agrees on some table's masked bits: no link is missed.

Only distinct fingerprints are hashed into tables.  Buckets of two are compared natively, buckets
of up to ``BUCKET`` inside a task, which sends a spanning forest of the links and never all
pairs.  Larger buckets are split by a covering family over the bits that their mask leaves free;
after three levels few bits are free, so this ends with small buckets and loses no link.
Components come from alternating large-star and small-star steps, each one written to the shared
folder.

Defined results: null, empty and blank texts have fingerprint zero and are linked like others;
a null doc_id is kept and never becomes a component id unless all of its group are null; repeated
rows each give a row; an empty table gives no row; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from extracteval.llm.common import prepare, stored

SHINGLE = 3
RADIUS = 3
BITS = 64
BUCKET = 2048
SEED = 42


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit fingerprint; words are split at ASCII white space, A-Z lower-cased."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    flat = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    end = np.cumsum(size) - 1
    start = end - size + 1
    k = min(shingle, len(words))
    n = len(words) - k + 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(flat[a:b], SEED) for a, b in zip(start[:n].tolist(), end[k - 1 :].tolist(), strict=True)), np.uint64, n
    )
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, n, 1 << 14):
        octets = hashes[at : at + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column, shingle: int = SHINGLE) -> Column:
    @F.pandas_udf("bigint")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64))

    return run(text)


def covering_masks(free: list[int], radius: int = RADIUS) -> list[int]:
    """One mask for each non-zero v: the free positions whose vector has an odd product with v."""
    vectors = (1 << (radius + 1)) - 1
    return [
        sum(1 << bit for k, bit in enumerate(free) if ((k % vectors + 1) & v).bit_count() % 2)
        for v in range(1, vectors + 1)
    ]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _bucket_links(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            first, second = [], []
            for members in b.column(0).to_pylist():
                left = np.sort(np.array(members, dtype=np.int64))
                while len(left) > 1:
                    root, frontier, left = left[0], [left[0]], left[1:]
                    while frontier and len(left):
                        near = np.bitwise_count((left ^ frontier.pop()).view(np.uint64)) <= radius
                        found = left[near].tolist()
                        left = left[~near]
                        frontier += found
                        first += [root] * len(found)
                        second += found
            yield pa.RecordBatch.from_arrays([pa.array(first, pa.int64()), pa.array(second, pa.int64())], names=["a", "b"])

    return run


def fingerprint_links(distinct: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """(a, b): links that connect every pair of the distinct fingerprints ``fp`` within ``radius``."""
    spark = distinct.sparkSession
    masks = {(): 0}
    bucket = max(bucket, 256)  # three levels leave at most 7 bits free, so no bucket stays larger
    rows, links, level = distinct, None, 0
    number = {(): 0}
    while True:
        level += 1
        fine = [
            (number[path], path + (k,), mask | m)
            for path, mask in masks.items()
            for k, m in enumerate(covering_masks([i for i in range(BITS) if not mask >> i & 1], radius))
        ]
        number = {path: n for n, (_, path, _) in enumerate(fine)}
        masks = {path: m for _, path, m in fine}
        # 15, 225 or 3,375 rows by level, whatever the input
        if level == 1:
            table = F.array(*[F.struct(F.lit(number[p]).cast("bigint").alias("finer"), F.lit(_signed(m)).cast("bigint").alias("mask")) for _, p, m in fine])
            met = rows.select("fp", F.explode(table).alias("t")).select("fp", "t.finer", "t.mask")
        else:
            table = spark.createDataFrame([(o, number[p], _signed(m)) for o, p, m in fine], "cover bigint, finer bigint, mask bigint")
            met = rows.join(F.broadcast(table), "cover")
        keyed = met.select("fp", F.col("finer").alias("cover"), F.col("fp").bitwiseAND(F.col("mask")).alias("key"))
        if level > 1:
            keyed = stored(keyed, "simhash-split")
        sizes = stored(
            keyed.groupBy("cover", "key").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).where("n > 1"),
            "simhash-buckets",
        )
        two = sizes.where((F.col("n") == 2) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)).select("a", "b")
        some = sizes.where((F.col("n") > 2) & (F.col("n") <= bucket)).select("cover", "key")
        lists = keyed.join(some, ["cover", "key"]).repartition("cover", "key").groupBy("cover", "key").agg(F.collect_list("fp").alias("fps"))
        new = two.unionByName(lists.select("fps").mapInArrow(_bucket_links(radius), "a bigint, b bigint"))
        links = new if links is None else links.unionByName(new)
        most = sizes.agg(F.max("n")).first()[0] or 0
        if most <= bucket:
            return links.distinct()
        large = sizes.where(F.col("n") > bucket).select("cover", "key")
        rows = keyed.join(large, ["cover", "key"]).select("fp", "cover")


def connected(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, root): every linked node but the roots, with the least node of its component."""
    pairs = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), name)
    seen = None
    while True:
        # the edge set is its own fingerprint: it stops changing when all components are stars
        state = tuple(pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == seen or not state[0]:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = state
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        pairs = stored(small.select("e.u", "e.v").where("u <> v").distinct(), name)


def fingerprint_components(rows: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """(fp, root) for every distinct ``fp`` of ``rows``; the root is a fingerprint of its group."""
    distinct = stored(rows.select("fp").distinct(), "simhash-distinct")
    roots = connected(fingerprint_links(distinct, radius, bucket))
    return distinct.join(roots, distinct.fp == roots.node, "left").select("fp", F.coalesce("root", "fp").alias("root"))


def simhash_components(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (least doc_id reachable)."""
    prepare(docs.sparkSession)
    rows = stored(docs.select(F.col("doc_id"), fingerprint_column(F.col("text"), shingle).alias("fp")), "simhash")
    roots = fingerprint_components(rows, radius)
    first = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    by_root = first.join(roots, "fp").groupBy("root").agg(F.min("first").alias("component_id"))
    ids = stored(roots.join(by_root, "root").select("fp", "component_id"), "simhash-ids")
    return rows.join(ids, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one_of_each(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each component: the least doc_id (nulls last; one of repeated rows)."""
    prepare(docs.sparkSession)
    names = docs.columns
    row = F.struct(*[F.col(n) for n in names]).alias("row")
    held = stored(docs.select(row, fingerprint_column(F.col("text"), shingle).alias("fp"), F.monotonically_increasing_id().alias("uid")), "simhash-rows")
    roots = fingerprint_components(held, radius)
    order = F.struct(F.col("row.doc_id").isNull().alias("none"), F.col("row.doc_id").alias("doc"), F.col("uid"))
    best = held.groupBy("fp").agg(F.min(order).alias("best"))
    kept = best.join(roots, "fp").groupBy("root").agg(F.min("best").alias("best")).select(F.col("best.uid").alias("uid"))
    return held.join(kept, "uid", "left_semi").select("row.*")
