"""Sources and sinks: round trips of the driver's tables through the shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregate
from ..session import shared_path
from ..sources import (
    enforce_schema,
    load_increment,
    merge_into_table,
    preflight,
    purge_table,
    read_csv,
    read_files,
    read_increment,
    read_sql,
    read_table,
    schema_drift,
    write_csv,
    write_table,
)
from .registry import day, query, rounded, table

# --- sources ---------------------------------------------------------------------------


@query(
    "src_csv_strings",
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus, o_orderpriority
    FROM orders
    """,
)
def src_csv_strings(spark, sf):
    path = shared_path(spark, "csv-strings")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    write_csv(orders, path, delimiter="|")
    return read_csv(spark, path, delimiter="|")


_TYPED = """
    SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS order_day,
           CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS o_orderpriority FROM orders"""


def _typed_csv(spark, sf):
    path = shared_path(spark, "csv-typed")
    orders = table(spark, sf, "orders").select(
        "o_orderkey",
        "o_totalprice",
        F.date_format("o_orderdate", "MM/dd/yyyy").alias("order_day"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority"),
    )
    write_csv(orders, path)
    return path


@query("src_csv_typed", _TYPED)
def src_csv_typed(spark, sf):
    schema = "o_orderkey bigint, o_totalprice double, order_day date, o_orderpriority string"
    orders = read_csv(spark, _typed_csv(spark, sf), schema=schema, date_format="MM/dd/yyyy")
    return orders.withColumn("order_day", day("order_day"))


@query("src_csv_infer", _TYPED)
def src_csv_infer(spark, sf):
    orders = read_csv(spark, _typed_csv(spark, sf), infer_schema=True, date_format="MM/dd/yyyy")
    return orders.withColumns({"order_day": day("order_day"), "o_orderkey": F.col("o_orderkey").cast("long")})


@query("src_parquet", "SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity FROM lineitem")
def src_parquet(spark, sf):
    return read_files(spark, f"{sf}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity")


@query(
    "src_sql_params",
    """
    SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders
    WHERE o_orderdate >= TIMESTAMP '1997-06-01' GROUP BY o_orderstatus
    """,
)
def src_sql_params(spark, sf):
    return read_sql(
        spark,
        """SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM {orders}
           WHERE o_orderdate >= to_timestamp_ntz(:runDate) GROUP BY o_orderstatus""",
        {"orders": table(spark, sf, "orders")},
        {"runDate": "1997-06-01 00:00:00"},
    )


@query(
    "src_incremental",
    """
    WITH o AS (SELECT o_orderkey, o_totalprice, CASE WHEN o_orderkey % 9 <> 0 THEN o_orderdate END AS o_orderdate FROM orders)
    SELECT o_orderkey, o_totalprice FROM o
    WHERE o_orderdate > (SELECT max(o_orderdate) FROM o WHERE o_orderdate < TIMESTAMP '1998-01-01') OR o_orderdate IS NULL
    """,
)
def src_incremental(spark, sf):
    """Every ninth order has no date, and is part of each increment."""
    orders = table(spark, sf, "orders").withColumn("o_orderdate", F.when(F.col("o_orderkey") % 9 != 0, F.col("o_orderdate")))
    loaded = orders.filter(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    return read_increment(orders, loaded, "o_orderdate").select("o_orderkey", "o_totalprice")


@query(
    "src_increment_ties",
    """
    WITH o AS (SELECT o_orderkey, o_totalprice, CASE WHEN o_orderkey % 9 <> 0 THEN date_trunc('month', o_orderdate) END AS month FROM orders),
         mark AS (SELECT max(month) AS month FROM o WHERE month < DATE '1998-01-01'),
         old AS (SELECT *, coalesce(month < (SELECT month FROM mark), false) AS below FROM o
                 WHERE month IS NULL OR month <= (SELECT month FROM mark)),
         first AS (SELECT * FROM old WHERE below OR o_orderkey % 2 = 0)
    SELECT CASE WHEN o.o_orderkey IN (SELECT o_orderkey FROM first) THEN 1 ELSE 2 END AS load, count(*) AS count_rows,
           CAST(sum(o_orderkey) AS BIGINT) AS sum_key, count(month) AS with_month
    FROM o GROUP BY 1
    """,
)
def src_increment_ties(spark, sf):
    """Two loads that share their mark: the second brings late rows at the mark and without one, each row once."""
    month = F.when(F.col("o_orderkey") % 9 != 0, F.date_trunc("month", "o_orderdate"))
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", month.cast("date").alias("month"))
    mark = orders.filter("month < '1998-01-01'").agg(F.max("month")).first()[0]
    at_mark = F.col("month").isNull() | (F.col("month") == F.lit(mark))
    first_feed = orders.filter((F.col("month") < F.lit(mark)) | (at_mark & (F.col("o_orderkey") % 2 == 0)))
    state, loads = shared_path(spark, "increment-state"), []
    for feed in (first_feed, orders):
        increment = load_increment(feed, state, "month")
        loads.append(increment.rows.withColumn("load", F.lit(len(loads) + 1)))
        increment.commit()
    assert load_increment(orders, state, "month").rows.isEmpty()
    both = loads[0].unionByName(loads[1])
    return both.groupBy("load").agg(
        F.count(F.lit(1)).alias("count_rows"), F.sum("o_orderkey").alias("sum_key"), F.count("month").alias("with_month")
    )


@query(
    "src_preflight",
    """
    SELECT count(DISTINCT o_orderstatus) AS files, CAST(0 AS BIGINT) AS empty_files,
           CAST(sum(length(CAST(o_orderkey AS VARCHAR)) + 1) AS BIGINT) AS bytes, 'ok' AS status
    FROM orders
    """,
)
def src_preflight(spark, sf):
    """Order keys as text, one file per status: what a run would find before it reads them."""
    path = shared_path(spark, "preflight")
    keys = table(spark, sf, "orders").select("o_orderstatus", F.col("o_orderkey").cast("string").alias("value"))
    keys.repartition("o_orderstatus").write.partitionBy("o_orderstatus").text(path)
    return preflight(spark, path).drop("path")


# --- sinks -----------------------------------------------------------------------------


@query("sink_csv_roundtrip", "SELECT l_orderkey, l_linenumber, l_returnflag, l_extendedprice FROM lineitem")
def sink_csv_roundtrip(spark, sf):
    path = shared_path(spark, "csv-gzip")
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice")
    write_csv(items, path, header=False, compression="gzip")
    return read_csv(spark, path, header=False, schema=items.schema)


@query(
    "sink_csv_single",
    """
    SELECT l_returnflag, l_linestatus, count(*) AS count_rows, round(sum(l_extendedprice), 2) AS sum_l_extendedprice
    FROM lineitem GROUP BY l_returnflag, l_linestatus
    """,
)
def sink_csv_single(spark, sf):
    path = shared_path(spark, "summary") + ".csv"
    summary = aggregate(table(spark, sf, "lineitem"), "l_returnflag,l_linestatus", "count:*,sum:l_extendedprice")
    summary = rounded(summary, "sum_l_extendedprice")
    write_csv(summary, path, single_file=True)
    return read_csv(spark, path, schema=summary.schema)


@query(
    "sink_csv_text",
    """
    SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN '' WHEN doc_id % 11 <> 0 THEN text END AS text,
           CASE WHEN doc_id % 5 <> 0 THEN lang END AS lang
    FROM documents
    """,
)
def sink_csv_text(spark, sf):
    """Whole texts through delimited files: line breaks, quotes, nulls and empty texts as they were."""
    path = shared_path(spark, "csv-text")
    documents = table(spark, sf, "documents").select(
        "doc_id",
        F.expr("CASE WHEN doc_id % 7 = 0 THEN '' WHEN doc_id % 11 <> 0 THEN text END").alias("text"),
        F.expr("CASE WHEN doc_id % 5 <> 0 THEN lang END").alias("lang"),
    )
    write_csv(documents, path)
    return read_csv(spark, path, schema=documents.schema, line_sep="\n")


def _orders(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")


@query(
    "sink_partitioned_append",
    """
    SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders
    UNION ALL SELECT o_orderkey + 1000000000, o_custkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus <> 'P'
    """,
)
def sink_partitioned_append(spark, sf):
    path, orders = shared_path(spark, "append"), _orders(spark, sf)
    write_table(orders, path, partition_by="o_orderstatus", cluster=True)
    again = orders.filter("o_orderstatus <> 'P'").withColumn("o_orderkey", F.col("o_orderkey") + 1000000000)
    write_table(again, path, partition_by="o_orderstatus")
    return read_files(spark, path, "parquet")


@query(
    "sink_partitioned_overwrite",
    """
    SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'F' THEN 0.0 ELSE o_totalprice END AS o_totalprice, o_orderstatus
    FROM orders
    """,
)
def sink_partitioned_overwrite(spark, sf):
    path, orders = shared_path(spark, "dynamic"), _orders(spark, sf)
    write_table(orders, path, "overwrite", partition_by="o_orderstatus")
    zeroed = orders.filter("o_orderstatus = 'F'").withColumn("o_totalprice", F.lit(0.0))
    write_table(zeroed, path, "overwrite", partition_by="o_orderstatus", dynamic=True)
    return read_files(spark, path, "parquet")


@query("sink_mode_ignore", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def sink_mode_ignore(spark, sf):
    path = shared_path(spark, "ignore")
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    write_table(customers, path, "error", "orc")
    write_table(customers.withColumn("c_acctbal", F.lit(0.0)), path, "ignore", "orc")
    return read_files(spark, path, "orc")


@query(
    "sink_merge_mode",
    """
    SELECT DISTINCT o_orderkey, o_custkey, CASE WHEN o_custkey < 500 THEN round(o_totalprice + 1, 2) ELSE o_totalprice END AS o_totalprice,
           CASE WHEN o_custkey < 500 THEN 'X' ELSE o_orderstatus END AS o_orderstatus
    FROM orders
    UNION SELECT o_orderkey + 1000000000, o_custkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus = 'P'
    """,
)
def sink_merge_mode(spark, sf):
    path, orders = shared_path(spark, "merge"), _orders(spark, sf)
    write_table(orders, path, partition_by="o_orderstatus")
    # Changed rows move to another partition, so the key alone decides and the table is rewritten.
    changed = orders.filter("o_custkey < 500").withColumns(
        {"o_totalprice": F.round(F.col("o_totalprice") + 1, 2), "o_orderstatus": F.lit("X")}
    )
    added = orders.filter("o_orderstatus = 'P'").withColumn("o_orderkey", F.col("o_orderkey") + 1000000000)
    merge_into_table(changed.unionByName(added), path, "o_orderkey", partition_by="o_orderstatus", atomic=True)
    return read_table(spark, path)


@query(
    "sink_merge_partitions",
    """
    SELECT DISTINCT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'F' AND o_totalprice > 250000 THEN 0.0 ELSE o_totalprice END
           AS o_totalprice, o_orderstatus
    FROM orders
    """,
)
def sink_merge_partitions(spark, sf):
    path, orders = shared_path(spark, "merge-partitions"), _orders(spark, sf)
    merge_into_table(orders, path, "o_orderkey,o_orderstatus", partition_by="o_orderstatus")
    changed = orders.filter("o_orderstatus = 'F' AND o_totalprice > 250000").withColumn("o_totalprice", F.lit(0.0))
    merge_into_table(changed, path, "o_orderkey,o_orderstatus", partition_by="o_orderstatus", target_unique=True)
    return read_files(spark, path, "parquet")


@query(
    "sink_merge_buckets",
    """
    SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 50 = 0 THEN 0.0 ELSE l_quantity END AS l_quantity
    FROM (SELECT l_orderkey, l_linenumber, max(l_quantity) AS l_quantity FROM lineitem GROUP BY 1, 2)
    """,
)
def sink_merge_buckets(spark, sf):
    """Line items in a table of 16 buckets by key; two merges, of which the second meets a part of them."""
    path = shared_path(spark, "merge-buckets")
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    merge_into_table(items, path, "l_orderkey,l_linenumber", order_by="l_quantity", buckets=16)
    changed = items.filter("l_orderkey % 50 = 0").withColumn("l_quantity", F.lit(0.0))
    merge_into_table(changed, path, "l_orderkey,l_linenumber")
    return read_table(spark, path)


@query(
    "retention_purge",
    """
    SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS count_rows, CAST(sum(event_id) AS BIGINT) AS sum_event_id,
           strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_ts
    FROM events WHERE ts >= TIMESTAMP '2024-01-17 09:30:00' GROUP BY 1
    """,
)
def retention_purge(spark, sf):
    """Events stored by day; days before the moment go by their folder, its own day is written again."""
    path = shared_path(spark, "retention")
    events = table(spark, sf, "events").select("event_id", "ts", day("ts").alias("day"))
    write_table(events, path, partition_by="day", cluster=True)
    purge_table(spark, path, "day", "ts", "2024-01-17 09:30:00")
    left = read_files(spark, path, "parquet", schema=events.schema)
    return left.groupBy("day").agg(
        F.count(F.lit(1)).alias("count_rows"),
        F.sum("event_id").alias("sum_event_id"),
        F.date_format(F.min("ts"), "yyyy-MM-dd HH:mm:ss").alias("first_ts"),
    )


# --- declared schemas ------------------------------------------------------------------

_DECLARED = "o_orderkey bigint not null, o_totalprice decimal(12,2), o_orderdate date, o_orderpriority int"


def _text_orders(spark, sf):
    """Orders as a text feed in which every urgent order has a bad priority and every low one none."""
    priority = F.col("o_orderpriority")
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.col("o_totalprice").cast("decimal(12,2)").cast("string").alias("o_totalprice"),
        day("o_orderdate").alias("o_orderdate"),
        F.when(priority == "1-URGENT", priority).when(priority != "5-LOW", F.substring(priority, 1, 1)).alias("o_orderpriority"),
        F.col("o_orderstatus"),
    )


@query(
    "schema_enforce",
    """
    SELECT o_orderkey, round(o_totalprice, 2) AS o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate,
           CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE substr(o_orderpriority, 1, 1) END AS o_orderpriority,
           CASE WHEN o_orderpriority = '1-URGENT' THEN 'o_orderpriority' ELSE '' END AS failed
    FROM orders
    """,
)
def schema_enforce(spark, sf):
    good, bad = enforce_schema(_text_orders(spark, sf), _DECLARED)
    good = good.select(
        "o_orderkey",
        F.col("o_totalprice").cast("double").alias("o_totalprice"),
        day("o_orderdate").alias("o_orderdate"),
        F.coalesce(F.col("o_orderpriority").cast("string"), F.lit("")).alias("o_orderpriority"),
        F.lit("").alias("failed"),
    )
    bad = bad.select(
        F.col("o_orderkey").cast("long").alias("o_orderkey"),
        F.col("o_totalprice").cast("double").alias("o_totalprice"),
        "o_orderdate",
        F.substring("o_orderpriority", 1, 1).alias("o_orderpriority"),
        F.col("failed_columns").alias("failed"),
    )
    return good.unionByName(bad)


@query(
    "schema_drift",
    """
    WITH n AS (SELECT count(*) AS rows, count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS urgent FROM orders)
    SELECT 'o_orderkey' AS "column", 'type_changed' AS status, rows, 0::BIGINT AS invalid FROM n
    UNION ALL SELECT 'o_totalprice', 'type_changed', rows, 0 FROM n
    UNION ALL SELECT 'o_orderdate', 'type_changed', rows, 0 FROM n
    UNION ALL SELECT 'o_orderpriority', 'type_changed', rows, urgent FROM n
    UNION ALL SELECT 'o_clerk', 'missing', rows, 0 FROM n
    UNION ALL SELECT 'o_orderstatus', 'unexpected', rows, 0 FROM n
    """,
)
def schema_drift_query(spark, sf):
    report = schema_drift(_text_orders(spark, sf), _DECLARED + ", o_clerk string")
    return report.select("column", "status", "rows", "invalid")
