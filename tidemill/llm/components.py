"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept


def _fingerprint(edges: DataFrame) -> tuple:
    """Count and order-free checksum of an edge list: equal lists, equal values."""
    return tuple(
        edges.agg(
            F.count("*"),
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
        ).first()
    )


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of ``edges (u, v)``; root is the component's smallest node.

    Alternates the large-star and the small-star step: every node hands its larger neighbours to
    the smallest node around it, then its smaller ones. Both are a grouped minimum and a join
    on the node, so a node with a large share of all edges is pre-aggregated and its join
    partition can be split. Edge counts never grow, chains shrink by a constant factor per
    round, and each round is a table in the shared folder.

    Rows with a null end and self loops are ignored; repeated edges count once. No edges give no rows.
    """
    u, v = F.least("u", "v"), F.greatest("u", "v")
    now = kept(
        edges.where(F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v")))
        .select(u.alias("u"), v.alias("v"))
        .distinct(),
        "edges",
    )
    before = _fingerprint(now)
    for _ in range(max_rounds):
        if before[0] == 0:
            break
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.join(least, "u")
            .where("v > u and v != m")
            .select(F.col("m").alias("u"), "v")
            .distinct()
        )
        # Each row: u is the smaller end. Per larger end v: its smallest neighbour takes the others over.
        small_least = large.groupBy("v").agg(F.min("u").alias("m"))
        joined = large.join(small_least, "v")
        small = joined.where("u != m").select(F.col("m").alias("u"), F.col("u").alias("v"))
        now = kept(small.union(small_least.select(F.col("m").alias("u"), "v")).distinct(), "edges")
        after = _fingerprint(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = now.groupBy("v").agg(F.min("u").alias("root")).select(F.col("v").alias("node"), "root")
    return roots.union(now.select(F.col("u").alias("node"), F.col("u").alias("root"))).distinct()
