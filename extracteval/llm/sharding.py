"""Balanced label propagation into shards of equal row counts (operator 1, DataFrame only).

Documents with equal text are linked; a link is cut when its ends lie in different shards.  Rows
of one text are interchangeable, so the graph is kept as cells (text, shard, rows): at most one
cell a shard for a text, however often it is repeated.  Every round joins cells with their text's
other cells: a text prefers the shard that already holds most of its rows and still has room, and
its smaller cells ask to move there.  Requests are granted in order of their size while the
shard's quota lasts (sizes are cut into powers of two and spread by hash, so the running total is
taken over a small table); a class that no longer fits whole fills what is left.  Every move goes from
a cell to a larger one of its text, so the sum of the cells' squares grows with each round and
rounds end, when nothing moves.  Documents without links then fill each shard to its capacity, which makes the
counts differ by one at most.

Rows are numbered inside hash buckets and each bucket gets the count of the buckets before it, so
no window holds more than a bucket of a text or shard and no text, however frequent, is in one task.

Defined results: null text counts as empty text of 0 bytes (size 8); null doc_ids and repeated
rows are sharded like others; with fewer rows than shards some shards are empty; an empty table
gives no row; other columns are not read.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from extracteval.llm.common import stored, text_or_empty

SHARDS = 24
BUCKETS = 4096
CLASSES = 64  # hash classes that split requests of like size


def document_nodes(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32 and the text's identity (k1, crc, size), read once and stored.

    Buckets go by where a row was read, so rows that share an id, or have none, are spread like others.
    """
    text = F.encode(text_or_empty(), "UTF-8")
    return stored(
        docs.select(
            F.col("doc_id"),
            (F.octet_length(text_or_empty()) + 8).cast("bigint").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.xxhash64(text_or_empty()).alias("k1"),
        ).withColumn("bucket", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(BUCKETS)).cast("int")),
        "shard-nodes",
    )


def _before(totals: DataFrame, group: list[str], count: str = "n") -> DataFrame:
    """Adds the count of earlier buckets inside each group and the group's total."""
    w = Window.partitionBy(*group)
    earlier = w.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    return totals.withColumn("before", F.coalesce(F.sum(count).over(earlier), F.lit(0))).withColumn("total", F.sum(count).over(w))


def propagate(cells: DataFrame, capacity: Column, shards: int = SHARDS) -> DataFrame:
    """Cells (k1, text_crc32, size, shard, rows) after the moves; ``capacity`` of ``shard``."""
    text = ["k1", "text_crc32", "size"]
    for turn in itertools.count():
        load = cells.groupBy("shard").agg(F.sum("rows").alias("load"))
        every = cells.sparkSession.range(shards).select(F.col("id").cast("int").alias("shard"))
        room = every.join(F.broadcast(load), "shard", "left").select(
            "shard", (capacity - F.coalesce("load", F.lit(0))).alias("room"), F.floor(capacity / 64).alias("least")
        )  # one row a shard
        here = cells.join(F.broadcast(room), "shard")
        # the cell to gather at: most rows, in a shard that takes all the others or is far from
        # full; a tie goes by hash
        rank = F.struct("rows", F.xxhash64("k1", "shard").alias("h"), "shard")
        totals = cells.groupBy(*text).agg(F.sum("rows").alias("total"), F.count(F.lit(1)).alias("cells")).where("cells > 1")
        open_ = (F.col("room") > 0) & ((F.col("room") > F.col("least")) | (F.col("room") >= F.col("total") - F.col("rows")))
        goal = here.join(totals, text).where(open_).groupBy(*text).agg(F.max(rank).alias("goal"))
        asks = cells.join(goal, text).where(
            (F.col("shard") != F.col("goal.shard")) & (F.struct("rows", F.xxhash64("k1", "shard"), "shard") < F.col("goal"))
        ).select(
            *text, "shard", "rows", F.col("goal.shard").alias("to"),
            (-F.floor(F.log2("rows"))).cast("int").alias("turn"), F.pmod(F.xxhash64("k1"), F.lit(CLASSES)).cast("int").alias("part"),
        )
        asks = stored(asks, "shard-asks")
        # at most 64 sizes x CLASSES rows for each shard
        classes = asks.groupBy("to", "turn", "part").agg(F.sum("rows").alias("n"))
        earlier = Window.partitionBy("to").orderBy("turn", "part").rowsBetween(Window.unboundedPreceding, -1)
        quota = classes.withColumn("ahead", F.coalesce(F.sum("n").over(earlier), F.lit(0))).join(
            F.broadcast(room.withColumnRenamed("shard", "to")), "to"
        ).withColumn("left", F.greatest(F.col("room") - F.col("ahead"), F.lit(0)))
        # a class that fits moves whole; of one that does not, each ask moves its share, or, where
        # that is under one row, half of what is left goes to asks picked by hash
        share = F.floor(F.col("rows") * F.col("left") / F.col("n")).cast("bigint")
        lucky = F.pmod(F.xxhash64("k1", "shard", "to", F.lit(turn)), F.col("n")) < F.floor((F.col("left") + 1) / 2)
        granted = asks.join(F.broadcast(quota.select("to", "turn", "part", "left", "n")), ["to", "turn", "part"]).withColumn(
            "move", F.when(F.col("left") >= F.col("n"), F.col("rows")).when(share > 0, share).when(lucky & (F.col("rows") <= F.col("left")), F.col("rows")).otherwise(F.lit(0))
        ).where("move > 0")
        granted = stored(granted.select(*text, "shard", "to", "move"), "shard-moves")
        if granted.isEmpty():
            return cells
        change = granted.select(*text, F.explode(F.array(
            F.struct(F.col("shard"), (-F.col("move")).alias("rows")), F.struct(F.col("to").alias("shard"), F.col("move").alias("rows"))
        )).alias("c")).select(*text, "c.shard", "c.rows")
        cells = stored(
            cells.select(*text, "shard", "rows").unionByName(change).groupBy(*text, "shard").agg(F.sum("rows").alias("rows")).where("rows > 0"),
            "shard-cells",
        )


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (law ``rows``)."""
    text = ["k1", "text_crc32", "size"]
    nodes = document_nodes(docs)
    n = nodes.count()
    capacity = (F.lit(n // shards) + (F.col("shard") < n % shards).cast("int")).cast("bigint")

    # how often each text is there, and how many of its rows lie in earlier buckets
    counts = nodes.groupBy(*text, "bucket").agg(F.count(F.lit(1)).alias("n"))
    linked = stored(_before(counts, text).where("total > 1").select(*text, "bucket", "n", "before", "total"), "shard-links")
    # first labels: rows of a text go round the shards from a start given by its hash
    start = F.pmod(F.xxhash64("k1", "text_crc32"), F.lit(shards))
    totals = linked.groupBy(*text).agg(F.max("total").alias("total"))
    spread = totals.select(*text, "total", F.explode(F.sequence(F.lit(0), F.least(F.col("total"), F.lit(shards)).cast("int") - 1)).alias("j"))
    cells = stored(spread.select(
        *text, F.pmod(start + F.col("j"), F.lit(shards)).cast("int").alias("shard"),
        (F.floor(F.col("total") / shards) + (F.col("j") < F.col("total") % shards).cast("int")).cast("bigint").alias("rows"),
    ), "shard-cells")
    cells = propagate(cells, capacity, shards)

    # rows of a text, in the order of their numbers, fill its cells one after another
    ranges = cells.groupBy(*text).agg(F.array_sort(F.collect_list(F.struct("shard", "rows"))).alias("cells"))  # <= shards entries
    places = linked.join(ranges, text).select(*text, "bucket", "before", "cells")
    number = F.row_number().over(Window.partitionBy(*text, "bucket").orderBy("doc_id")) - 1
    numbered = nodes.withColumn("nth", number).join(places, [*text, "bucket"], "left")
    at = F.col("nth") + F.col("before")
    found = F.aggregate(
        "cells", F.struct(F.lit(0).cast("bigint").alias("end"), F.lit(None).cast("int").alias("shard")),
        lambda acc, c: F.struct(
            (acc["end"] + c["rows"]).alias("end"),
            F.when(acc["shard"].isNotNull(), acc["shard"]).when(at < acc["end"] + c["rows"], c["shard"]).alias("shard"),
        ),
    )["shard"]
    labelled = stored(numbered.select("doc_id", "size", "text_crc32", "bucket", found.alias("label")), "shard-labels")

    # number the rows of each label; what has no label (or exceeds a quota) fills the free slots
    per = _before(labelled.groupBy("label", "bucket").agg(F.count(F.lit(1)).alias("n")), ["label"]).select("label", "bucket", "before")
    number = F.row_number().over(Window.partitionBy("label", "bucket").orderBy("doc_id", "text_crc32")) - 1
    ranked = labelled.withColumn("nth", number).join(
        per.withColumnsRenamed({"label": "l", "bucket": "b"}), F.col("label").eqNullSafe(F.col("l")) & (F.col("bucket") == F.col("b"))
    ).withColumn("at", F.col("nth") + F.col("before")).drop("l", "b")
    held = {r.label: r.n for r in labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}  # shards + 1 rows
    size = [n // shards + (s < n % shards) for s in range(shards)]
    kept = [min(held.get(s, 0), size[s]) for s in range(shards)]
    over, spare, pool, free = [], [], held.get(None, 0), 0
    for s in range(shards):
        over.append(pool)
        pool += held.get(s, 0) - kept[s]
        spare.append(free)
        free += size[s] - kept[s]
    pick = lambda values, index: F.element_at(F.array(*[F.lit(v).cast("bigint") for v in values]), index + 1)
    label = F.col("label")
    stays = label.isNotNull() & (F.col("at") < pick(kept, F.coalesce(label, F.lit(0))))
    index = F.when(label.isNull(), F.col("at")).otherwise(pick(over, F.coalesce(label, F.lit(0))) + F.col("at") - pick(kept, F.coalesce(label, F.lit(0))))
    ranked = ranked.select("doc_id", "size", "text_crc32", "label", "at", stays.alias("stays"), index.alias("index"))
    target = sum((F.col("index") >= s).cast("int") for s in spare[1:]) if shards > 1 else F.lit(0)
    placed = ranked.withColumn("shard", F.when(F.col("stays"), F.col("label")).otherwise(target).cast("int"))
    slot = F.when(F.col("stays"), F.col("at")).otherwise(pick(kept, F.col("shard")) + F.col("index") - pick(spare, F.col("shard")))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", slot.cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def cut_links(sharded: DataFrame, key: list[str]) -> DataFrame:
    """links, cut: linked rows (beyond each group's first) and those outside the group's main shard."""
    cells = sharded.groupBy(*key, "shard").agg(F.count(F.lit(1)).alias("n"))
    groups = cells.groupBy(*key).agg((F.sum("n") - 1).alias("links"), (F.sum("n") - F.max("n")).alias("cut"))
    return groups.agg(F.sum("links").alias("links"), F.sum("cut").alias("cut"))
