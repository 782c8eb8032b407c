"""Token-level preparation.

Tokens are whitespace words (the reference's own length approximation) with ids from a
vocabulary table; a pre-tokenised ``ARRAY<INT>`` column works with N3/N5/N6 unchanged.
The vocabulary holds every token unless the caller caps it.  Texts meet it by a head/tail join: a
bounded number of frequent tokens is broadcast, the others are shuffled once a text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from extracteval.functions.pytext import col_, py_strip
from extracteval.operators.prompts import pair_text
from extracteval.operators.scan import ordinal_within
from extracteval.session import ship_package

PAD_ID = 0
UNK_ID = 1
FIRST_ID = 2
MAX_LEN = 384
HEAD = 65_536  # most frequent tokens that are broadcast
HEAD_LENGTH = 64  # code points of a token that is broadcast
SHARED = 64  # rows that are looked up together


def build_vocab(texts: DataFrame, text_col: str = "text", size: int | None = None, copies: str | None = None) -> DataFrame:
    """Token -> token_id by rank of (count desc, digest, token); ids start after pad and unk.

    Tokens are counted in Arrow batches first.  Ranks come from a levelled scan: by count, then by the digest's five leading
    digits (at most 1,048,576 a count), so the many tokens that occur once are spread over all tasks.  ``size`` keeps
    the first so many ids; ``copies`` names a column that says how often a row counts.
    """
    ship_package(texts.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, sizes = _words(batch.column(0))
            coded = flat.dictionary_encode()
            each = np.repeat(batch.column(1).to_numpy(), sizes) if copies else None
            n = np.bincount(coded.indices.to_numpy(), each, len(coded.dictionary))
            yield pa.RecordBatch.from_arrays([coded.dictionary, pa.array(n.astype(np.int64))], ["token", "n"])

    toks = texts.select(F.make_valid_utf8(text_col), *([copies] if copies else [])).mapInArrow(count, "token string, n bigint")
    counts = toks.groupBy("token").agg(F.sum("n").alias("n"))
    digest = F.md5("token")
    keyed = counts.select("token", "n", (-F.col("n")).alias("_less"), F.unhex(digest).alias("_key"))
    ranked = ordinal_within(keyed, [], ["_less", "_key", "token"], "_rank", levels=[F.col("_less"), F.left(digest, F.lit(5))])
    vocab = ranked.select("token", (F.col("_rank") + FIRST_ID - 1).alias("token_id"), "n")
    return vocab if size is None else vocab.where(F.col("token_id") < size + FIRST_ID)


def save_vocab(vocab: DataFrame, path: str) -> DataFrame:
    """Write a vocabulary to a new folder and read it back, as a tokenizer is built once and then loaded.

    What was shuffled for it goes when it is written, not when the driver next collects its garbage.
    """
    conf, name = vocab.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(name, None)
    conf.set(name, "true")
    try:
        vocab.write.parquet(path)
    finally:
        conf.set(name, before or "false")
    return vocab.sparkSession.read.schema(vocab.schema).parquet(path)


def _row_keys(columns: Sequence[str]) -> list[Column]:
    """128 bits that tell different rows apart, the same in every run."""
    return [F.xxhash64(*columns).alias("_ra"), F.xxhash64(F.lit("row"), *reversed(columns)).alias("_rb")]


def spread_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``columns`` of ``df`` dealt out evenly by their content, equal rows as one with their number ``_copies``.

    What is worked out for each row afterwards (``_ra``, ``_rb``) can be gathered without another exchange.
    """
    columns = list(columns)
    keyed = df.select(*columns, *_row_keys(columns))
    same = [F.any_value(c).alias(c) for c in columns]
    return keyed.groupBy("_ra", "_rb").agg(*same, F.count(F.lit(1)).alias("_copies"))


def together(df: DataFrame, by: Sequence[str]) -> list[str] | None:
    """``by`` if each row has it and at most ``SHARED`` rows share one, so that they can be looked up together; else None."""
    by = list(by)
    rows = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows"))
    other = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in by], F.col("_rows") > SHARED)
    return None if rows.where(other).limit(1).count() else by


def _lengths(rows: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(rows), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _offsets(sizes: np.ndarray) -> np.ndarray:
    return np.r_[0, np.cumsum(sizes)].astype(np.int32)


def _only(flat: pa.Array, sizes: np.ndarray, kept: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The elements to keep, and how many of them each row has."""
    if kept.all():
        return flat, sizes
    return flat.filter(pa.array(kept)), np.bincount(np.repeat(np.arange(len(sizes)), sizes)[kept], minlength=len(sizes))


def _words(texts: pa.Array, limit: int | None = None) -> tuple[pa.Array, np.ndarray]:
    """``py_split`` of a batch: its words one after another, and how many each text has (null: none)."""
    parts = pc.utf8_split_whitespace(texts)  # the white space of Python; empty words at both ends
    flat = parts.flatten()
    flat, sizes = _only(flat, _lengths(parts), pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False))
    if limit is None:
        return flat, sizes
    return _only(flat, sizes, np.arange(len(flat)) - np.repeat(_offsets(sizes)[:-1], sizes) < limit)


def _known_ids(rows: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The ids of a batch without special ones, and how many each row has."""
    flat = rows.flatten()
    return _only(flat, _lengths(rows), pc.fill_null(pc.greater_equal(flat, FIRST_ID), False).to_numpy(zero_copy_only=False))


def _as_ids(found: pa.Array, sizes: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(_offsets(sizes), pc.fill_null(found, UNK_ID))


def _as_text(found: pa.Array, sizes: np.ndarray) -> pa.Array:
    flat, sizes = _only(found, sizes, pc.is_valid(found).to_numpy(zero_copy_only=False))
    return pc.binary_join(pa.ListArray.from_arrays(_offsets(sizes), flat), " ")


def _translate(
    rows: DataFrame, asking: DataFrame, by: Sequence[str], keep: Sequence[str], column: str, vocab: DataFrame, key: str, value: str, head: int,
    elements: Callable, result: Callable, kind: T.DataType, out: str,
) -> DataFrame:
    """``keep`` and ``out``: ``result`` of the ``value`` of all ``elements`` (a ``key`` each) of ``column``.

    The ``head`` most frequent tokens (no longer than ``HEAD_LENGTH``) are looked up where the row is. Of all others
    those that rows with equal ``by`` have are shuffled to the vocabulary, each once a batch, and come back as one list.
    ``by`` is never null and tells small groups apart.  ``rows`` stay where they are if they are laid out by it.
    ``asking`` has ``by`` and ``column`` of the same rows; ``rows`` itself where both are read from one exchange.
    """
    ship_package(rows.sparkSession)
    often = (F.col("token_id") < head + FIRST_ID) & (F.length("token") <= HEAD_LENGTH)
    table = vocab.where(often).select(key, value).toArrow().combine_chunks()  # a few megabytes at most
    keys, values = (pa.concat_arrays(table.column(c).chunks) if table.num_rows else pa.array([], table.schema.field(c).type) for c in (key, value))
    at, groups = asking.columns.index(column), [asking.columns.index(c) for c in by]

    def missing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, sizes = elements(batch.column(at))
            coded = flat.dictionary_encode()
            code = coded.indices.to_numpy()
            lost = pc.is_null(pc.index_in(coded.dictionary, value_set=keys)).to_numpy(zero_copy_only=False)[code]
            row, code = np.repeat(np.arange(len(sizes)), sizes)[lost], code[lost]
            group = np.zeros(len(sizes), np.int64)
            for g in groups:
                part = batch.column(g).dictionary_encode()
                group = np.unique(group * len(part.dictionary) + part.indices.to_numpy(), return_inverse=True)[1]
            first = np.unique(group[row] * len(coded.dictionary) + code, return_index=True)[1]
            found = [batch.column(g).take(pa.array(row[first])) for g in groups]
            yield pa.RecordBatch.from_arrays([*found, coded.dictionary.take(pa.array(code[first]))], [*by, key])

    @F.arrow_udf(kind)
    def look_up(batch: pa.Array, far: pa.Array) -> pa.Array:
        flat, sizes = elements(batch)
        coded, late = flat.dictionary_encode(), far.flatten()
        source = pc.fill_null(pc.index_in(coded.dictionary, value_set=keys), -1).to_numpy().copy()
        code = pc.fill_null(pc.index_in(late.field(key), value_set=coded.dictionary), -1).to_numpy()
        source[code[code >= 0]] = len(values) + np.flatnonzero(code >= 0)
        found = pa.concat_arrays([values, late.field(value).cast(values.type)]).take(pa.array(source, mask=source < 0))
        return result(found.take(coded.indices), sizes)

    schema = T.StructType([*(rows.schema[c] for c in by), T.StructField(key, T.StringType() if key == "token" else T.LongType())])
    found = asking.mapInArrow(missing, schema).join(vocab.where(~often).select(key, value), key)
    # dealt out as plain rows, which are smaller than lists of one
    far = found.repartition(*by).groupBy(*by).agg(F.collect_list(F.struct(key, value)).alias("_far"))
    return rows.join(far, list(by), "left").select(*keep, look_up(column, "_far").alias(out))


def _copied(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    many = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies")))
    return df.select(*columns, many).select(*columns)


def tokenize_ids(
    df: DataFrame, keys: Sequence[str], text_col: str, vocab: DataFrame, out: str = "ids", limit: int | None = None, head: int = HEAD,
    by: Sequence[str] | None = None,
) -> DataFrame:
    """Keys + ``out`` ARRAY<BIGINT> of token ids in text order, one row for each row of ``df``.

    Unknown tokens get UNK_ID; ``limit`` keeps a text's first tokens and looks up no other.  The ``head``
    most frequent tokens (no longer than ``HEAD_LENGTH``, so a few megabytes at most) go to all tasks
    and are looked up where the text is, in Arrow batches; only other tokens are shuffled, each once a text.

    Rows that share ``by`` (some of ``keys``, as ``together`` returned them) are looked up together: a token that several of
    them have is shuffled once, and texts are not shuffled at all where ``df`` is laid out by it.
    """
    keys = list(keys)
    words = partial(_words, limit=limit)
    how = (vocab, "token", "token_id", head, words, _as_ids, T.ArrayType(T.LongType()), out)
    valid = F.make_valid_utf8(text_col).alias("_text")
    if by:
        return _translate(df.select(*keys, valid), df.select(*by, valid), by, keys, "_text", *how)
    texts = df if {"_ra", "_rb"} <= set(df.columns) else spread_rows(df, [*keys, text_col])
    row = ["_ra", "_rb"]
    rows = texts.select(*row, *keys, "_copies", valid)
    return _copied(_translate(rows, rows, row, [*keys, "_copies"], "_text", *how), [*keys, out])


def decode_ids(
    df: DataFrame, keys: Sequence[str], ids_col: str, vocab: DataFrame, out: str = "text", head: int = HEAD, by: Sequence[str] | None = None
) -> DataFrame:
    """Ids back to text (tokens joined by a space), special ids (below FIRST_ID) and unknown ones skipped.

    The same table the other way round: frequent ids where the row is, the rest by a shuffle of each
    row's different ids (of the different ids of the rows that share ``by``, see ``tokenize_ids``).
    """
    keys = list(keys)
    ids = F.col(ids_col).cast("array<bigint>").alias("_ids")
    how = (vocab, "token_id", "token", head, _known_ids, _as_text, T.StringType(), out)
    if by:  # ids come out of Arrow batches, so their layout is not known
        rows = df.select(*keys, ids).repartition(*by)
        return _translate(rows, rows, by, keys, "_ids", *how)
    row = ["_ra", "_rb"]
    rows = spread_rows(df, [*keys, ids_col]).select(*row, *keys, "_copies", ids)
    return _copied(_translate(rows, rows, row, [*keys, "_copies"], "_ids", *how), [*keys, out])


def decode_new_ids(
    df: DataFrame, keys: Sequence[str], n_prompt: str, vocab: DataFrame, ids_col: str = "ids", out: str = "text", by: Sequence[str] | None = None
) -> DataFrame:
    """P6 on ids: the ids after the first ``n_prompt``, decoded (special ids skipped) and stripped."""
    new = F.slice(ids_col, F.col(n_prompt) + 1, F.greatest(F.size(ids_col) - F.col(n_prompt), F.lit(0)))
    text = decode_ids(df.select(*keys, new.alias("_new")), keys, "_new", vocab, out, by=by)
    return text.withColumn(out, py_strip(out))


def truncate_pad(ids: Column | str, length: int = MAX_LEN, pad: int = PAD_ID) -> tuple[Column, Column]:
    """First ``length`` ids right-padded with ``pad``, and the 1/0 attention mask."""
    kept = F.slice(col_(ids), 1, length)
    fill = F.greatest(F.lit(length) - F.size(kept), F.lit(0))
    padded = F.concat(kept, F.array_repeat(F.lit(pad), fill))
    mask = F.concat(F.array_repeat(F.lit(1), F.size(kept)), F.array_repeat(F.lit(0), fill))
    return padded, mask


def encode_pairs(pairs: DataFrame, vocab: DataFrame, prompt: str = "input", length: int = MAX_LEN) -> DataFrame:
    """P7 + N2 + N3 for both sides -> chosen_ids, chosen_mask, rejected_ids, rejected_mask."""
    text = lambda side: pair_text(prompt, side)
    # pairs that share an id stay apart: equal ones are interchangeable, others differ in a text
    whole = pairs.select(F.struct(F.xxhash64("pair_id", text("chosen"), text("rejected")), F.xxhash64(text("rejected"), text("chosen"), "pair_id")).alias("pair"), "pair_id", F.array(text("chosen"), text("rejected")).alias("texts"))
    unique = whole.groupBy("pair").agg(F.any_value("pair_id").alias("pair_id"), F.any_value("texts").alias("texts"), F.count(F.lit(1)).alias("copies"))
    long = unique.select("pair", "pair_id", "copies", F.posexplode("texts").alias("side", "text"))
    ids = tokenize_ids(long, ["pair", "pair_id", "copies", "side"], "text", vocab, limit=length)
    padded, mask = truncate_pad("ids", length)
    enc = ids.select("pair", "pair_id", "copies", "side", padded.alias("ids"), mask.alias("mask"))
    pick = lambda side, c: F.max(F.when(F.col("side") == side, F.col(c)))
    both = enc.groupBy("pair", "pair_id", "copies").agg(
        pick(0, "ids").alias("chosen_ids"), pick(0, "mask").alias("chosen_mask"),
        pick(1, "ids").alias("rejected_ids"), pick(1, "mask").alias("rejected_mask"),
    )
    columns = ["pair_id", "chosen_ids", "chosen_mask", "rejected_ids", "rejected_mask"]
    return both.select(*columns, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))).select(*columns)


def length_budget(prompt_ids: Column, completion_ids: Column, max_prompt: int = 256, max_total: int = 512) -> tuple[Column, Column]:
    """Keep the prompt's last ``max_prompt`` tokens, then cut the completion's end to fit ``max_total``."""
    n = F.size(prompt_ids)
    keep = F.least(n, F.lit(max_prompt))
    p = F.when(n > max_prompt, F.slice(prompt_ids, -max_prompt, max_prompt)).otherwise(prompt_ids)
    c = F.slice(completion_ids, 1, F.greatest(F.lit(max_total) - keep, F.lit(0)))
    return p, c


def _block_pieces(df: DataFrame, id_col: str, n: Column, block: int, *keep: str) -> DataFrame:
    """One row for each part of an example in a block: id, start, end, block_id, lo and hi (stream offsets)."""
    t = df.select(id_col, *keep, n.cast("bigint").alias("_n")).where(F.col("_n") > 0)
    r = ordinal_within(t, [], id_col, "_ord", running=["_n"])
    end = F.col("_n_cum")
    start = end - F.col("_n")
    pieces = r.select(
        id_col, *keep, start.alias("_s"), end.alias("_e"),
        F.explode(F.sequence(F.floor(start / block), F.floor((end - 1) / block))).alias("block_id"),
    )
    lo = F.greatest(F.col("_s"), F.col("block_id") * block)
    hi = F.least(F.col("_e"), (F.col("block_id") + 1) * block)
    return pieces.select("*", lo.alias("_lo"), hi.alias("_hi"))


def pack_sequences(df: DataFrame, id_col: str, n_col: str, block: int = 1024) -> DataFrame:
    """Lay examples end to end in id order and cut the stream into blocks of ``block`` tokens.

    The running offset is an exact global prefix sum (bucketed scan), so no window holds the
    whole stream.  Output: block_id, n_tokens, n_pieces, first_id, last_id.
    """
    return _block_pieces(df, id_col, F.col(n_col), block).groupBy("block_id").agg(
        F.sum(F.col("_hi") - F.col("_lo")).cast("bigint").alias("n_tokens"),
        F.count(F.lit(1)).alias("n_pieces"),
        F.min(id_col).alias("first_id"),
        F.max(id_col).alias("last_id"),
    )


def packed_blocks(df: DataFrame, id_col: str, ids_col: str, block: int = 1024, end_id: int | None = None) -> DataFrame:
    """N6 with its tokens: block_id, ids (``block`` of them; the last block may be shorter), pieces.

    ``end_id`` is put after every example.  Offsets are summed over lengths alone; an example's ids are
    cut where they are, and a block gathers no more than its own tokens.  ``pieces`` lists what the block
    holds in order: id, first token in the example and number of tokens.  Examples without tokens are left out
    (with ``end_id`` they hold that).
    """
    ids = F.col(ids_col) if end_id is None else F.concat(F.col(ids_col), F.array(F.lit(end_id).cast("bigint")))
    whole = df.select(id_col, ids.alias("_ids"))
    parts = _block_pieces(whole, id_col, F.size("_ids"), block, "_ids")
    begin, size = F.col("_lo") - F.col("_s"), F.col("_hi") - F.col("_lo")
    cut = parts.select("block_id", F.struct(
        F.col("_lo").alias("at"), F.col(id_col).alias("id"), begin.alias("start"), size.alias("n"), F.slice("_ids", (begin + 1).cast("int"), size.cast("int")).alias("ids")
    ).alias("p"))
    blocks = cut.groupBy("block_id").agg(F.array_sort(F.collect_list("p")).alias("p"))
    return blocks.select(
        "block_id", F.flatten(F.transform("p", lambda p: p["ids"])).alias("ids"),
        F.transform("p", lambda p: F.struct(p["id"].alias("id"), p["start"].alias("start"), p["n"].alias("n"))).alias("pieces"),
    )
