"""Deduplication, sorting, masking and merging over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import (
    aggregate,
    deduplicate,
    detokenize,
    golden_record,
    mask,
    merge,
    record_hash,
    sort,
    token_vault,
    unmask,
)
from ..sources import retain
from .registry import day, query, rounded, table

# --- deduplicate -----------------------------------------------------------------------


@query("dedup_any_keys", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def dedup_any_keys(spark, sf):
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    return deduplicate(items, "l_orderkey,l_linenumber")


_LINE = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax"
_LINE_TIES = "l_partkey,l_suppkey,l_quantity,l_extendedprice,l_discount,l_tax"


def _dedup_lines(spark, sf, keep):
    items = table(spark, sf, "lineitem")
    kept = deduplicate(items, "l_orderkey,l_linenumber", keep, "l_shipdate", _LINE_TIES)
    return kept.select(*_LINE.split(", "), day("l_shipdate").alias("ship_day"))


def _dedup_lines_sql(way):
    order = ", ".join(f"{c} {way}" for c in ["l_shipdate", *_LINE_TIES.split(",")])
    return f"""
        SELECT {_LINE}, strftime(l_shipdate, '%Y-%m-%d') AS ship_day FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {order}) = 1"""


@query("dedup_first", _dedup_lines_sql("ASC NULLS FIRST"))
def dedup_first(spark, sf):
    return _dedup_lines(spark, sf, "first")


@query("dedup_last", _dedup_lines_sql("DESC NULLS LAST"))
def dedup_last(spark, sf):
    return _dedup_lines(spark, sf, "last")


@query(
    "dedup_latest",
    """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS order_day
    FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC) = 1
    """,
)
def dedup_latest(spark, sf):
    kept = deduplicate(table(spark, sf, "orders"), "o_custkey", "latest", "o_orderdate", "o_orderkey")
    return kept.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", day("o_orderdate").alias("order_day"))


@query(
    "dedup_earliest",
    """
    WITH e AS (SELECT *, CASE WHEN event_type <> 'error' THEN ts END AS seen FROM events)
    SELECT user_id, event_type, event_id, seen IS NULL AS unseen FROM e
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY seen ASC NULLS FIRST, event_id ASC) = 1
    """,
)
def dedup_earliest(spark, sf):
    events = table(spark, sf, "events").withColumn("seen", F.when(F.col("event_type") != "error", F.col("ts")))
    kept = deduplicate(events, "user_id", "earliest", "seen", "event_id")
    return kept.select("user_id", "event_type", "event_id", F.col("seen").isNull().alias("unseen"))


@query("dedup_full_row", "SELECT DISTINCT lang, source, n_chars, text FROM documents")
def dedup_full_row(spark, sf):
    return deduplicate(table(spark, sf, "documents").select("lang", "source", "n_chars", "text"), [])


@query(
    "dedup_survivorship",
    """
    SELECT o_custkey,
           arg_max(o_totalprice, (coalesce(o_orderdate, TIMESTAMP '0001-01-01'), o_orderkey)) AS o_totalprice,
           arg_max(o_orderpriority, (coalesce(o_orderdate, TIMESTAMP '0001-01-01'), o_orderkey))
               FILTER (WHERE o_orderpriority <> '5-LOW') AS o_orderpriority
    FROM orders GROUP BY o_custkey
    """,
)
def dedup_survivorship(spark, sf):
    orders = table(spark, sf, "orders").withColumn(
        "o_orderpriority", F.nullif("o_orderpriority", F.lit("5-LOW"))
    )
    return golden_record(orders, "o_custkey", "o_orderdate,o_orderkey", "o_totalprice,o_orderpriority")


# --- sort ------------------------------------------------------------------------------


@query(
    "sort_asc_topk",
    """
    SELECT o_orderkey, o_custkey, o_totalprice,
           row_number() OVER (ORDER BY o_totalprice ASC NULLS FIRST, o_orderkey ASC NULLS FIRST) AS position
    FROM orders
    """,
)
def sort_asc_topk(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return sort(orders, "o_totalprice,o_orderkey", position="position")


@query(
    "sort_desc_topk",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
           row_number() OVER (ORDER BY l_extendedprice DESC NULLS LAST, l_orderkey DESC NULLS LAST, l_linenumber DESC NULLS LAST,
                              l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST) AS position
    FROM lineitem
    """,
)
def sort_desc_topk(spark, sf):
    columns = ["l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return sort(table(spark, sf, "lineitem").select(*columns), columns, "desc", position="position")


@query(
    "sort_nulls_last",
    """
    WITH o AS (SELECT o_orderkey, CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderpriority END AS priority, o_totalprice FROM orders)
    SELECT *, row_number() OVER (ORDER BY priority ASC NULLS LAST, o_totalprice DESC NULLS LAST, o_orderkey ASC) AS position
    FROM o
    """,
)
def sort_nulls_last(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.nullif("o_orderpriority", F.lit("1-URGENT")).alias("priority"), "o_totalprice"
    )
    return sort(orders, "priority,o_totalprice,o_orderkey", "asc,desc,asc", nulls="last", position="position")


@query(
    "sort_global",
    """
    WITH i AS (SELECT l_returnflag, l_shipdate < DATE '1998-01-01' AS early, l_orderkey, l_linenumber, l_quantity FROM lineitem)
    SELECT *, rank() OVER (ORDER BY l_returnflag ASC NULLS FIRST, early ASC NULLS FIRST) AS least_position,
           rank() OVER (ORDER BY l_returnflag ASC NULLS FIRST, early ASC NULLS FIRST)
               + count(*) OVER (PARTITION BY l_returnflag, early) - 1 AS last_position
    FROM i
    """,
)
def sort_global(spark, sf):
    items = table(spark, sf, "lineitem").select(
        "l_returnflag",
        (F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz")).alias("early"),
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
    )
    # Rows of equal keys have no order among themselves, but their positions are a block.
    placed = sort(items, "l_returnflag,early", position="position")
    blocks = placed.groupBy("l_returnflag", "early").agg(
        F.min("position").alias("least_position"), F.max("position").alias("last_position")
    )
    same = F.col("i.l_returnflag").eqNullSafe(F.col("b.l_returnflag")) & F.col("i.early").eqNullSafe(F.col("b.early"))
    return placed.alias("i").join(blocks.alias("b"), same).select(*[f"i.{c}" for c in items.columns], "least_position", "last_position")


# --- mask ------------------------------------------------------------------------------


@query(
    "mask_hash",
    "SELECT sha256(CAST(c_custkey AS VARCHAR)) AS c_custkey, sha256(c_name) AS c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
)
def mask_hash(spark, sf):
    return mask(table(spark, sf, "customer"), "c_custkey,c_name")


@query(
    "mask_tokenize",
    """
    SELECT o_orderkey, sha256('pepper' || CAST(o_custkey AS VARCHAR)) AS o_custkey,
           sha256('pepper' || CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END) AS o_orderpriority
    FROM orders
    """,
)
def mask_tokenize(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority")
    )
    return mask(orders, "o_custkey,o_orderpriority", "tokenize", salt="pepper")


@query("mask_redact", "SELECT '***' AS s_suppkey, '***' AS s_name, s_nationkey, s_acctbal FROM supplier")
def mask_redact(spark, sf):
    return mask(table(spark, sf, "supplier"), "s_suppkey,s_name", "redact")


@query("mask_encrypt_roundtrip", "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_acctbal FROM customer")
def mask_encrypt_roundtrip(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    hidden = mask(customers, "c_custkey,c_name", "encrypt", key="0123456789abcdef")
    return unmask(hidden, "c_custkey,c_name", key="0123456789abcdef")


@query("mask_token_vault", "SELECT user_id, event_id, event_type FROM events")
def mask_token_vault(spark, sf):
    events = table(spark, sf, "events").select(F.col("user_id").cast("string").alias("user_id"), "event_id", "event_type")
    vault = token_vault(events, "user_id", salt="vault")
    back = detokenize(mask(events, "user_id", "tokenize", salt="vault"), "user_id", vault)
    return back.withColumn("user_id", F.col("user_id").cast("long"))


@query(
    "record_hash",
    """
    SELECT c_custkey, sha256('{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '","c_mktsegment":"' || c_mktsegment || '"}')
           AS record_hash
    FROM customer
    """,
)
def record_hash_query(spark, sf):
    return record_hash(table(spark, sf, "customer"), "c_custkey,c_name,c_mktsegment").select("c_custkey", "record_hash")


# --- merge -----------------------------------------------------------------------------


@query(
    "merge_union",
    """
    SELECT s_nationkey AS nationkey, s_acctbal AS balance FROM supplier
    UNION ALL BY NAME SELECT c_acctbal AS balance, c_nationkey AS nationkey FROM customer
    """,
)
def merge_union(spark, sf):
    suppliers = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("balance"))
    customers = table(spark, sf, "customer").select(F.col("c_acctbal").alias("balance"), F.col("c_nationkey").alias("nationkey"))
    return merge(suppliers, customers)


@query(
    "merge_upsert",
    """
    WITH src AS (SELECT o_orderkey, o_custkey, o_totalprice + 1 AS o_totalprice FROM orders WHERE o_orderstatus = 'F'
                 UNION ALL SELECT o_orderkey + 1000000000, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'P'),
         tgt AS (SELECT o_orderkey, o_custkey, o_totalprice FROM orders)
    SELECT o_orderkey, o_custkey, round(o_totalprice, 2) AS o_totalprice FROM src
    UNION
    SELECT o_orderkey, o_custkey, round(o_totalprice, 2) FROM tgt ANTI JOIN src USING (o_orderkey)
    """,
)
def merge_upsert(spark, sf):
    target = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    changed = target.filter("o_orderstatus = 'F'").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    added = target.filter("o_orderstatus = 'P'").withColumn("o_orderkey", F.col("o_orderkey") + 1000000000)
    merged = merge(changed.unionByName(added), target, "o_orderkey")
    return rounded(merged.drop("o_orderstatus"), "o_totalprice")


@query("merge_missing_target", "SELECT p_partkey, p_name, p_brand FROM part")
def merge_missing_target(spark, sf):
    return merge(table(spark, sf, "part").select("p_partkey", "p_name", "p_brand"), None, "p_partkey")


@query(
    "merge_schema_drift",
    """
    SELECT s_nationkey AS nationkey, s_name AS name, NULL AS segment FROM supplier
    UNION ALL SELECT c_nationkey, NULL, c_mktsegment FROM customer
    """,
)
def merge_schema_drift(spark, sf):
    suppliers = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("nationkey"), F.col("s_name").alias("name"))
    customers = table(spark, sf, "customer").select(F.col("c_nationkey").alias("nationkey"), F.col("c_mktsegment").alias("segment"))
    return merge(suppliers, customers)


@query(
    "retention_filter",
    """
    WITH e AS (SELECT event_type, event_id, CASE WHEN event_id % 10 <> 0 THEN ts END AS ts FROM events)
    SELECT event_type, count(*) AS count_rows, min(event_id) AS min_event_id FROM e
    WHERE CAST(ts AS DATE) >= DATE '2024-01-31' - INTERVAL 14 DAY OR ts IS NULL GROUP BY event_type
    """,
)
def retention_filter(spark, sf):
    """Every tenth event has no time, and stays."""
    events = table(spark, sf, "events").withColumn("ts", F.when(F.col("event_id") % 10 != 0, F.col("ts")))
    kept = retain(events, "ts", days=14, today="2024-01-31")
    return aggregate(kept, "event_type", "count:*,min:event_id")
