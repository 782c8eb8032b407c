"""Token-id output: frequency-ranked ids in byte-aligned variable-length coding (operator 3).

Ids are replaced by their frequency rank, so common tokens take one byte.  A block holds whole
documents and is one binary value: a header, the document index, the control bytes (two bits for
each value's byte count, four values a byte) and the data bytes.  Blocks are rows of a Parquet
table written in ascending ``doc_id`` order, with the rank table beside it; any store that Spark
writes to will do.  Decoding is a numpy table lookup from control byte to byte counts.

Steps: encode every text once (map only, stored, each task with its id histogram), sum the histograms by id,
rank them (one row for each vocabulary entry), range-partition by ``doc_id``, write blocks.

Defined results: null text encodes as empty (just the end id); a text of any length is one document of one block; null doc_ids come first; repeated
rows are each written; an empty table writes no block and reads back as no row; other columns of
the input are not read.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from extracteval.llm.common import prepare, shared_folder, stored
from extracteval.llm.tokens import encoder

BLOCK_TOKENS = 1 << 17  # a block is closed once it holds so many; a document is never cut
MAGIC = b"FVB1"
_HEAD = struct.Struct("<4sIIIq")  # magic, documents, values, data bytes, start inside the file
# Bytes of the four values that each control byte describes: 256 rows made from the rule.
COUNTS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3) + 1


def encode_values(values: np.ndarray) -> tuple[bytes, bytes]:
    """Unsigned 32-bit values -> (control bytes, data bytes)."""
    values = values.astype(np.uint32)
    size = 1 + (values > 0xFF).astype(np.uint8)
    if int(values.max(initial=0)) > 0xFFFF:
        size = size + (values > 0xFFFF) + (values > 0xFFFFFF)
    code = np.zeros(-(-len(values) // 4) * 4, dtype=np.uint8)
    code[: len(values)] = size - 1
    code = code.reshape(-1, 4)
    control = code[:, 0] | code[:, 1] << 2 | code[:, 2] << 4 | code[:, 3] << 6
    # columns that no value needs are left out of the selection
    wide = int(size.max(initial=1))
    octets = values.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :wide]
    data = octets[np.arange(wide) < size[:, None]]
    return control.tobytes(), data.tobytes()


def decode_values(control: bytes, data: bytes, n: int) -> np.ndarray:
    size = COUNTS[np.frombuffer(control, dtype=np.uint8)].reshape(-1)[:n]
    at = np.cumsum(size) - size
    raw = np.frombuffer(data + b"\0\0\0", dtype=np.uint8)
    out = raw[at].astype(np.uint32)
    for k in range(1, int(size.max(initial=1))):
        longer = np.flatnonzero(size > k)
        out[longer] |= raw[at[longer] + k].astype(np.uint32) << (8 * k)
    return out


def pack_block(doc_ids: list[int | None], counts: list[int], values: np.ndarray, start: int) -> bytes:
    control, data = encode_values(values)
    known = np.array([d is not None for d in doc_ids], dtype=np.uint8)
    return b"".join((
        _HEAD.pack(MAGIC, len(doc_ids), len(values), len(data), start),
        np.array([d or 0 for d in doc_ids], dtype="<i8").tobytes(), known.tobytes(),
        np.array(counts, dtype="<u4").tobytes(), control, data,
    ))


def unpack_block(blob: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray, int]:
    """-> (doc_ids, counts, values, start of the block inside its file)."""
    magic, docs, n, size, start = _HEAD.unpack_from(blob)
    if magic != MAGIC:
        raise ValueError("not a token block")
    at = _HEAD.size
    ids = np.frombuffer(blob, "<i8", docs, at)
    known = np.frombuffer(blob, np.uint8, docs, at + 8 * docs)
    counts = np.frombuffer(blob, "<u4", docs, at + 9 * docs)
    at += 13 * docs
    cut = at + -(-n // 4)
    values = decode_values(blob[at:cut], blob[cut : cut + size], n)
    return [int(i) if k else None for i, k in zip(ids, known, strict=True)], counts, values, start


def encode_texts(docs: DataFrame, tokenizer: str, end_id: int, spaces: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian bytes, end id included), counts; stored once.

    ``counts`` is null but for the last row of each task, which holds the task's id histogram.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, total, held = encoder(tokenizer, spaces), np.zeros(0, dtype=np.int64), None
        for b in batches:
            if not b.num_rows:
                continue
            if held:
                yield _encoded(*held, None)
            ids = list(enc.blobs(b.column(1).to_pylist(), end_id))
            seen = np.bincount(np.frombuffer(b"".join(ids), enc.dtype), minlength=len(total))
            seen[: len(total)] += total
            total, held = seen, (b.column(0), ids, enc.dtype.itemsize)
        if held:
            there = np.flatnonzero(total)
            yield _encoded(*held, there.astype("<i8").tobytes() + total[there].astype("<i8").tobytes())

    prepare(docs.sparkSession)
    pairs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return stored(pairs.mapInArrow(run, "doc_id bigint, n_tokens bigint, ids binary, counts binary"), "token-ids")


def _encoded(doc_ids: pa.Array, ids: list[bytes], width: int, counts: bytes | None) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            doc_ids, pa.array([len(i) // width for i in ids], pa.int64()), pa.array(ids, pa.binary()),
            pa.array([None] * (len(ids) - 1) + [counts], pa.binary()),
        ],
        names=["doc_id", "n_tokens", "ids", "counts"],
    )


def count_ids(encoded: DataFrame) -> DataFrame:
    """token_id, n over all documents, from the histogram that each task stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for blob in b.column(0).to_pylist():
                ids, n = np.frombuffer(blob, "<i8").reshape(2, -1)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n)], names=["token_id", "n"])

    found = encoded.select("counts").where("counts IS NOT NULL").mapInArrow(run, "token_id bigint, n bigint")
    return found.groupBy("token_id").agg(F.sum("n").alias("n"))


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, spaces: bool = True) -> None:
    """Encode ``docs`` (doc_id, text) and write ``path``/blocks and ``path``/ranks."""
    spark = docs.sparkSession
    dtype = str(encoder(tokenizer, spaces).dtype)
    encoded = encode_texts(docs, tokenizer, end_id, spaces)
    # at most one row for each entry of the tokenizer's vocabulary
    counts = sorted((-r.n, r.token_id) for r in count_ids(encoded).collect())
    ids = [i for _, i in counts]
    rank = np.zeros(max(ids, default=0) + 1, dtype=np.uint32)
    rank[ids] = np.arange(len(ids), dtype=np.uint32)
    spark.createDataFrame(list(enumerate(ids)), "rank bigint, token_id bigint").coalesce(1).write.parquet(f"{path}/ranks")
    table = spark.sparkContext.broadcast(rank)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to_rank, file_no = table.value, TaskContext.get().partitionId()
        block, docs_in, held, start = 0, [], 0, 0

        def close() -> pa.RecordBatch:
            blob = pack_block([d for d, _ in docs_in], [len(i) for _, i in docs_in], to_rank[np.concatenate([i for _, i in docs_in])], start)
            return pa.RecordBatch.from_arrays(
                [pa.array([x], t) for x, t in ((file_no, pa.int64()), (block, pa.int64()), (held, pa.int64()), (blob, pa.binary()))],
                names=["file_no", "block_no", "n_values", "block"],
            )

        for b in batches:
            for d, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                docs_in.append((d, np.frombuffer(blob, dtype)))
                held += len(docs_in[-1][1])
                if held >= BLOCK_TOKENS:
                    yield close()
                    block, start, docs_in, held = block + 1, start + held, [], 0
        if docs_in:
            yield close()

    ordered = encoded.select("doc_id", "n_tokens", "ids").repartitionByRange("doc_id", "n_tokens").sortWithinPartitions("doc_id", "n_tokens", "ids")
    blocks = ordered.select("doc_id", "ids").mapInArrow(run, "file_no bigint, block_no bigint, n_values bigint, block binary")
    blocks.write.option("compression", "none").parquet(f"{path}/blocks")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids (little-endian unsigned 32-bit), decoded from the files."""
    blocks = prepare(spark).read.parquet(f"{path}/blocks")
    # one row for each file that was written; one rank for each vocabulary entry
    files = blocks.groupBy("file_no").agg(F.sum("n_values").alias("n")).orderBy("file_no").collect()
    before, base = 0, {}
    for r in files:
        base[r.file_no], before = before, before + r.n
    ranks = spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()
    share = spark.sparkContext.broadcast((base, np.array([r.token_id for r in ranks], dtype="<u4")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, token = share.value
        for b in batches:
            for file_no, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                doc_ids, counts, values, start = unpack_block(blob)
                end = np.cumsum(counts, dtype=np.int64)
                ids = token[values]
                starts = base[file_no] + start + end - counts
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc_ids, pa.int64()), pa.array(starts, pa.int64()), pa.array(counts.astype(np.int64)),
                        pa.array([ids[e - c : e].tobytes() for c, e in zip(counts.tolist(), end.tolist(), strict=True)], pa.binary()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    rows = blocks.select("file_no", "block")
    return rows.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def digest(tokens: DataFrame) -> DataFrame:
    """The ids column as its unsigned crc32."""
    return tokens.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def token_files_query(docs: DataFrame, tokenizer: str) -> DataFrame:
    path = shared_folder(docs.sparkSession, "token-files")
    write_token_files(docs, path, tokenizer)
    return digest(read_token_files(docs.sparkSession, path))
