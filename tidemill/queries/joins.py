"""Joins and lookups over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregate, join, lookup
from ..quality import fx_reconcile
from ..session import shared_path
from ..sources import read_reference
from .registry import query, rounded, table


@query(
    "join_inner",
    """
    SELECT o_orderkey, l_linenumber, o_custkey, o_orderpriority, l_partkey, l_quantity
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey
    """,
)
def join_inner(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return join(orders, items, "orders.o_orderkey = items.l_orderkey", left_id="orders", right_id="items").drop("l_orderkey")


@query(
    "join_using",
    "SELECT doc_id, lang, source, n_chars, quality, toxic FROM documents JOIN labels USING (doc_id)",
)
def join_using(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    return join(documents, table(spark, sf, "labels"), "doc_id")


def _documents(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "lang", "n_chars")


def _labels(spark, sf):
    return table(spark, sf, "labels").withColumn("mark", F.concat(F.col("quality").cast("string"), F.lit("/"), F.col("toxic").cast("string"))).select("doc_id", "mark")


_LABELS = "(SELECT doc_id, quality || '/' || toxic AS mark FROM labels)"

@query("join_left", f"SELECT doc_id, lang, n_chars, mark FROM documents LEFT JOIN {_LABELS} USING (doc_id)")
def join_left(spark, sf):
    return join(_documents(spark, sf), _labels(spark, sf), "doc_id", "left")


@query("join_right", f"SELECT doc_id, mark, lang, n_chars FROM {_LABELS} RIGHT JOIN documents USING (doc_id)")
def join_right(spark, sf):
    return join(_labels(spark, sf), _documents(spark, sf), "doc_id", "right")


# A label feed under other numbers: some documents lack a label and some labels a document.
_MOVED = "(SELECT doc_id * 2 + 1 AS doc_id, quality || '/' || toxic AS mark FROM labels)"


def _moved_labels(spark, sf):
    return _labels(spark, sf).withColumn("doc_id", F.col("doc_id") * 2 + 1)


@query("join_full", f"SELECT doc_id, lang, n_chars, mark FROM documents FULL JOIN {_MOVED} USING (doc_id)")
def join_full(spark, sf):
    return join(_documents(spark, sf), _moved_labels(spark, sf), "doc_id", "full")


@query(
    "join_full_expr",
    f"""
    SELECT d.doc_id AS doc_id, lang, n_chars, b.doc_id AS labels_doc_id, mark
    FROM documents d FULL JOIN {_MOVED} b ON d.doc_id = b.doc_id
    """,
)
def join_full_expr(spark, sf):
    left, right = _documents(spark, sf), _moved_labels(spark, sf)
    return join(left, right, "docs.doc_id = labels.doc_id", "full", left_id="docs", right_id="labels")


@query("join_semi", "SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 400000)")
def join_semi(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    orders = table(spark, sf, "orders").filter("o_orderstatus = 'F' AND o_totalprice > 400000")
    return join(customers, orders, "c.c_custkey = o.o_custkey", "semi", left_id="c", right_id="o")


@query("join_anti", "SELECT c_custkey, c_mktsegment FROM customer ANTI JOIN (SELECT o_custkey AS c_custkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 400000) USING (c_custkey)")
def join_anti(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    orders = table(spark, sf, "orders").filter("o_orderstatus = 'F' AND o_totalprice > 400000")
    return join(customers, orders, "c.c_custkey = o.o_custkey", "anti", left_id="c", right_id="o")


@query(
    "join_theta",
    """
    SELECT o_orderpriority, count(*) AS count_rows, round(sum(l_extendedprice), 2) AS sum_l_extendedprice
    FROM orders o JOIN lineitem l
      ON o.o_orderkey = l.l_orderkey AND l.l_shipdate > o.o_orderdate AND l.l_extendedprice < o.o_totalprice
         AND o.o_orderpriority <> 'this or that' AND NOT (l.l_extendedprice = o.o_totalprice)
    GROUP BY o_orderpriority
    """,
)
def join_theta(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice", "o_orderpriority")
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_shipdate", "l_extendedprice")
    test = """o.o_orderkey = l.l_orderkey AND l.l_shipdate > o.o_orderdate AND l.l_extendedprice < o.o_totalprice
              AND o.o_orderpriority <> 'this or that' AND NOT (l.l_extendedprice = o.o_totalprice)"""
    joined = join(orders, items, test, left_id="o", right_id="l")
    return rounded(aggregate(joined, "o_orderpriority", "count:*,sum:l_extendedprice"), "sum_l_extendedprice")


@query(
    "join_null_safe",
    """
    WITH s AS (SELECT s_suppkey, nullif(s_nationkey, 3) AS nationkey FROM supplier),
         n AS (SELECT nullif(n_nationkey, 3) AS nationkey, n_name FROM nation)
    SELECT s_suppkey, n_name FROM s JOIN n ON s.nationkey IS NOT DISTINCT FROM n.nationkey
    """,
)
def join_null_safe(spark, sf):
    suppliers = table(spark, sf, "supplier").select("s_suppkey", F.nullif("s_nationkey", F.lit(3)).alias("nationkey"))
    nations = table(spark, sf, "nation").select(F.nullif("n_nationkey", F.lit(3)).alias("nationkey"), "n_name")
    return join(suppliers, nations, "nationkey", null_safe=True).drop("nationkey")


# --- lookup ----------------------------------------------------------------------------


def _nation_reference(spark, sf) -> str:
    """The nation table as JSON array documents, the form reference files have: one file per thousand keys."""
    path = shared_path(spark, "nation-reference")
    nations = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey")
    documents = nations.groupBy(F.floor(F.col("c_nationkey") / 1000)).agg(F.to_json(F.collect_list(F.struct(*nations.columns))).alias("value"))
    documents.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return path


@query(
    "src_json_reference",
    """
    SELECT n_regionkey, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_regionkey
    """,
)
def src_json_reference(spark, sf):
    nations = read_reference(spark, _nation_reference(spark, sf), "c_nationkey int, n_name string, n_regionkey int")
    found = lookup(table(spark, sf, "customer").select("c_nationkey"), nations, "c_nationkey", "n_regionkey", "inner")
    return aggregate(found, "n_regionkey", "count:*").withColumnRenamed("count_rows", "customers")


@query(
    "lookup_left_json",
    """
    SELECT c_custkey, c_nationkey, c_mktsegment, n_name, CAST(n_regionkey AS BIGINT) AS n_regionkey
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
    """,
)
def lookup_left_json(spark, sf):
    nations = read_reference(spark, _nation_reference(spark, sf))
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return lookup(customers, nations, "c_nationkey", "n_name,n_regionkey")


@query(
    "lookup_left_dataset",
    """
    SELECT o_orderkey, o_custkey, o_totalprice, c_mktsegment, c_nationkey
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey
    """,
)
def lookup_left_dataset(spark, sf):
    customers = table(spark, sf, "customer").withColumnRenamed("c_custkey", "o_custkey")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return lookup(orders, customers, "o_custkey", "c_mktsegment,c_nationkey")


@query(
    "lookup_inner",
    "SELECT doc_id, source, n_chars, quality FROM documents JOIN labels USING (doc_id) WHERE toxic = 0",
)
def lookup_inner(spark, sf):
    clean = table(spark, sf, "labels").filter("toxic = 0")
    documents = table(spark, sf, "documents").select("doc_id", "source", "n_chars")
    return lookup(documents, clean, "doc_id", "quality", "inner")


@query(
    "lookup_broadcast",
    """
    SELECT l_orderkey, l_linenumber, l_suppkey, s_name AS supplier_s_name FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey
    """,
)
def lookup_broadcast(spark, sf):
    suppliers = table(spark, sf, "supplier").withColumnRenamed("s_suppkey", "l_suppkey")
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    return lookup(items, suppliers, "l_suppkey", "s_name", broadcast=True, prefix="supplier_")


_PAIR_PRICES = "SELECT l_partkey, l_suppkey, max(l_extendedprice) AS max_l_extendedprice FROM lineitem GROUP BY ALL"


@query(
    "lookup_multi_key",
    f"""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, max_l_extendedprice
    FROM lineitem LEFT JOIN ({_PAIR_PRICES}) USING (l_partkey, l_suppkey)
    """,
)
def lookup_multi_key(spark, sf):
    items = table(spark, sf, "lineitem")
    best = aggregate(items, "l_partkey,l_suppkey", "max:l_extendedprice")
    lines = items.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return lookup(lines, best, "l_partkey,l_suppkey", "max_l_extendedprice", grouped=True)


@query(
    "lookup_no_fields",
    "SELECT c_custkey, c_mktsegment FROM customer JOIN (SELECT o_custkey AS c_custkey FROM orders WHERE o_orderstatus = 'O') USING (c_custkey)",
)
def lookup_no_fields(spark, sf):
    open_orders = table(spark, sf, "orders").filter("o_orderstatus = 'O'").withColumnRenamed("o_custkey", "c_custkey")
    return lookup(table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), open_orders, "c_custkey", None, "inner")


@query(
    "fx_reconcile",
    """
    WITH t AS (SELECT o_orderkey,
                      CASE o_orderstatus WHEN 'F' THEN 'USD' WHEN 'O' THEN 'GBP' ELSE 'EUR' END AS txn_ccy,
                      CASE WHEN o_orderstatus = 'P' THEN 'EUR'
                           WHEN o_orderstatus = 'O' THEN CASE WHEN o_orderpriority < '3' THEN 'EUR' ELSE 'GBP' END
                           WHEN o_orderpriority < '2' THEN 'GBP' WHEN o_orderpriority < '4' THEN 'EUR' ELSE 'USD' END AS base_ccy,
                      o_totalprice AS txn_amt
               FROM orders),
         r AS (SELECT *, CASE WHEN txn_ccy = base_ccy THEN 1.0 WHEN txn_ccy = 'USD' AND base_ccy = 'GBP' THEN 1.2
                              WHEN txn_ccy = 'USD' AND base_ccy = 'EUR' THEN 1.5 ELSE 0.9 END AS rate FROM t)
    SELECT txn_ccy, base_ccy, count(*) AS count_rows,
           count(*) FILTER (WHERE o_orderkey % 10 = 0 AND rate <> 1.0) AS mismatches
    FROM r GROUP BY txn_ccy, base_ccy
    """,
)
def fx_reconcile_query(spark, sf):
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    booked = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(status == "F", "USD").when(status == "O", "GBP").otherwise("EUR").alias("txn_ccy"),
        F.when(status == "P", "EUR")
        .when(status == "O", F.when(priority < "3", "EUR").otherwise("GBP"))
        .when(priority < "2", "GBP")
        .when(priority < "4", "EUR")
        .otherwise("USD")
        .alias("base_ccy"),
        F.col("o_totalprice").cast("decimal(31,5)").alias("txn_amt"),
    )
    # Every tenth order is booked at par, which is wrong wherever a rate applies.
    rate = (
        F.when(F.col("txn_ccy") == F.col("base_ccy"), 1)
        .when((F.col("txn_ccy") == "USD") & (F.col("base_ccy") == "GBP"), 1.2)
        .when((F.col("txn_ccy") == "USD") & (F.col("base_ccy") == "EUR"), 1.5)
        .otherwise(0.9)
    )
    par = F.col("o_orderkey") % 10 == 0
    amount = F.col("txn_amt") * F.when(par, F.lit(1.0)).otherwise(rate).cast("decimal(9,5)")
    booked = booked.withColumn("base_amt", amount.cast("decimal(31,5)"))
    checked = fx_reconcile(booked)
    return checked.groupBy("txn_ccy", "base_ccy").agg(
        F.count(F.lit(1)).alias("count_rows"), F.count_if(~F.col("reconciled")).alias("mismatches")
    )
