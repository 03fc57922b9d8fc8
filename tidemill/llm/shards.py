"""Shards of near-equal size by a minimax contiguous partition, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept, session

#: Atomic groups: texts with the same hash modulo this share one, so equal texts always do. The
#: plan works on the groups' sizes, whose number does not grow with the input.
GROUPS = 65_536
#: Bytes a document counts for besides its text.
OVERHEAD = 16


def group_sizes(rows: DataFrame) -> DataFrame:
    """``(bucket, size, n)`` per atomic group of ``rows (bucket, size)``: at most GROUPS rows."""
    return rows.groupBy("bucket").agg(F.sum("size").alias("size"), F.count("*").alias("n"))


def plan(sizes: DataFrame, shards: int) -> DataFrame:
    """``(bucket, n, pos, shard)``: the groups in order, cut into ``shards`` contiguous runs.

    The order is: groups at least as large as a fair share, largest first, each a shard
    of its own, since no cut can make their shards smaller; then the others by number. Over these a
    binary search finds the smallest capacity with which the shards left suffice; each trial fills
    shards greedily in order. The cuts are those of the last feasible trial. One row with
    an array of at most GROUPS sizes is all that the search reads.
    """
    # Shares of what is left: the largest group is taken out while it is at least a fair share.
    rest = sizes.agg(
        F.sort_array(F.collect_list(F.struct("size", "bucket", "n")), asc=False).alias("largest"), F.sum("size").alias("total")
    )
    giants = F.expr(
        f"""aggregate(slice(largest, 1, {shards - 1}), struct(0 AS k, total AS left, true AS more),
            (a, g) -> IF(a.more AND g.size > 0 AND g.size * ({shards} - a.k) >= a.left,
                struct(a.k + 1 AS k, a.left - g.size AS left, true AS more), struct(a.k AS k, a.left AS left, false AS more)),
            a -> a.k)"""
        if shards > 1
        else "0"
    )
    rest = rest.select("*", giants.alias("giants"))
    rest = rest.select(
        "giants",
        F.expr("slice(largest, 1, giants)").alias("first"),
        F.expr(
            "sort_array(transform(slice(largest, giants + 1, greatest(size(largest) - giants, 0)), g -> struct(g.bucket, g.size, g.n)))"
        ).alias("others"),
        F.lit(shards).alias("shards") - F.col("giants"),
    ).toDF("giants", "first", "others", "left")
    # One row, stored: the searches below read these arrays many times and must not compute them each time.
    rest = kept(rest.select("*", F.expr("transform(others, g -> g.size)").alias("sizes")), "shard-sizes")
    low = "greatest(coalesce(array_max(sizes), 0L), (aggregate(sizes, 0L, (a, s) -> a + s) + left - 1) div left)"
    rest = rest.select("*", F.expr(low).alias("low"))
    # With a fair share plus the largest size, greedy filling always suffices.
    search = """aggregate(sequence(1, 64), struct(low AS lo, low + coalesce(array_max(sizes), 0L) AS hi),
        (a, step) -> IF(a.lo >= a.hi, a, IF(
            aggregate(sizes, struct(1 AS used, 0L AS filled),
                (f, s) -> IF(f.filled + s <= (a.lo + a.hi) div 2, struct(f.used AS used, f.filled + s AS filled),
                    struct(f.used + 1 AS used, s AS filled)), f -> f.used) <= left,
            struct(a.lo AS lo, (a.lo + a.hi) div 2 AS hi), struct((a.lo + a.hi) div 2 + 1 AS lo, a.hi AS hi))),
        a -> a.hi)"""
    rest = kept(rest.select("*", F.expr(search).alias("capacity")), "shard-capacity")
    cuts = """aggregate(sizes, struct(0 AS at, 0L AS filled, CAST(array() AS array<int>) AS cuts),
        (a, s) -> IF(a.filled + s <= capacity, struct(a.at + 1 AS at, a.filled + s AS filled, a.cuts AS cuts),
            struct(a.at + 1 AS at, s AS filled, array_append(a.cuts, a.at) AS cuts)), a -> a.cuts)"""
    rest = rest.select("*", F.expr(cuts).alias("cuts"))
    alone = rest.select("giants", F.posexplode("first").alias("pos", "g")).select(
        F.col("g.bucket").alias("bucket"), F.col("g.n").alias("n"), "pos", F.col("pos").alias("shard")
    )
    filled = rest.select("giants", "cuts", F.posexplode("others").alias("pos", "g")).select(
        F.col("g.bucket").alias("bucket"),
        F.col("g.n").alias("n"),
        (F.col("pos") + F.col("giants")).alias("pos"),
        (F.col("giants") + F.expr("size(filter(cuts, c -> c <= pos))")).alias("shard"),
    )
    return alone.union(filled)


def assign_shards(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text", groups: int = GROUPS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, size, text_crc32, bucket, shard, slot``.

    Shards hold near-equal sums of ``size`` (UTF-8 bytes plus OVERHEAD); equal texts share a shard.
    Slots run from 0 without gaps in each shard, ordered by group, then by a hash and the
    id. They are numbered in cells of bounded length, so a text that holds a third of all
    rows is numbered by many tasks.

    Nulls: a null text has no bytes and the checksum of no bytes; a null id is numbered first in its
    cell. Repeated rows keep a slot each. An empty table gives no rows. Other columns are ignored.
    Only ids, sizes and hashes are shuffled, never texts.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    session(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.pmod(F.xxhash64(text), F.lit(groups)).cast("int").alias("bucket"),
    )
    rows = kept(rows, "shard-rows")
    cut = kept(plan(group_sizes(rows), shards), "shard-plan")
    # Cells: as many as twice the groups at most, whatever the number of rows.
    total = cut.agg(F.sum("n").alias("total")).first()["total"] or 0
    length = max(256, -(-total // groups))
    cells = F.greatest(F.lit(1), F.ceil(F.col("n") / length)).cast("int")
    small = F.broadcast(cut.select("bucket", "pos", "shard", cells.alias("cells")))  # at most `groups` rows
    placed = rows.join(small, "bucket").withColumn("cell", F.pmod(F.xxhash64("doc_id"), F.col("cells")).cast("int"))
    counted = placed.groupBy("shard", "pos", "bucket", "cell").agg(F.count("*").alias("n"))
    before = "sum(n) OVER (PARTITION BY shard ORDER BY pos, cell ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n"
    starts = F.broadcast(counted.select("bucket", "cell", F.expr(before).alias("start")))  # at most 2 * groups rows
    number = "row_number() OVER (PARTITION BY bucket, cell ORDER BY doc_id, text_crc32, size) - 1"
    return (
        placed.join(starts, ["bucket", "cell"])
        .withColumn("slot", F.col("start") + F.expr(number))
        .select("doc_id", "size", "text_crc32", "bucket", "shard", "slot")
    )
