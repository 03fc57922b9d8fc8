"""Aggregation over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregate, aggregate_levels, aggregate_rolling, aggregate_window, lookup
from ..operators.ranks import Rank, order_statistics
from .registry import day, query, rounded, table


def _items(spark, sf):
    return table(spark, sf, "lineitem")


@query(
    "agg_count_sum",
    """
    SELECT CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS o_orderpriority, o_orderstatus,
           count(*) AS count_rows, count(CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END) AS count_open_price,
           round(sum(o_totalprice), 2) AS sum_o_totalprice
    FROM orders GROUP BY ALL
    """,
)
def agg_count_sum(spark, sf):
    orders = table(spark, sf, "orders").withColumns(
        {
            "o_orderpriority": F.nullif("o_orderpriority", F.lit("5-LOW")),
            "open_price": F.when(F.col("o_orderstatus") != "F", F.col("o_totalprice")),
        }
    )
    out = aggregate(orders, "o_orderpriority,o_orderstatus", "count:*,count:open_price,sum:o_totalprice")
    return rounded(out, "sum_o_totalprice")


@query(
    "agg_global",
    """
    SELECT count(*) AS count_rows, round(sum(l_extendedprice), 2) AS sum_l_extendedprice,
           min(l_quantity) AS min_l_quantity, max(l_quantity) AS max_l_quantity FROM lineitem
    """,
)
def agg_global(spark, sf):
    out = aggregate(_items(spark, sf), None, "count,sum:l_extendedprice,min:l_quantity,max:l_quantity")
    return rounded(out, "sum_l_extendedprice")


@query(
    "agg_basic",
    """
    SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_l_quantity,
           round(avg(l_extendedprice), 2) AS avg_l_extendedprice, round(avg(l_discount), 4) AS mean_l_discount,
           min(l_tax) AS min_l_tax, max(l_extendedprice) AS max_l_extendedprice, count(l_orderkey) AS count_l_orderkey
    FROM lineitem GROUP BY l_returnflag, l_linestatus
    """,
)
def agg_basic(spark, sf):
    out = aggregate(
        _items(spark, sf),
        "l_returnflag,l_linestatus",
        "sum:l_quantity,avg:l_extendedprice,mean:l_discount,min:l_tax,max:l_extendedprice,count:l_orderkey",
    )
    return rounded(rounded(out, "sum_l_quantity", "avg_l_extendedprice"), "mean_l_discount", digits=4)


@query(
    "agg_distinct",
    """
    SELECT l_returnflag, count(DISTINCT l_partkey) AS count_distinct_l_partkey,
           count(DISTINCT l_suppkey) AS "countDistinct_l_suppkey",
           CAST(sum(DISTINCT l_linenumber) AS BIGINT) AS sum_distinct_l_linenumber
    FROM lineitem GROUP BY l_returnflag
    """,
)
def agg_distinct(spark, sf):
    return aggregate(
        _items(spark, sf), "l_returnflag", "count_distinct:l_partkey,countDistinct:l_suppkey,sum_distinct:l_linenumber"
    )


@query("agg_approx_distinct", "SELECT l_returnflag, true AS close FROM lineitem GROUP BY l_returnflag")
def agg_approx_distinct(spark, sf):
    out = aggregate(_items(spark, sf), "l_returnflag", "approx_count_distinct:l_partkey,count_distinct:l_partkey")
    exact = F.col("count_distinct_l_partkey")
    return out.select(
        "l_returnflag", (F.abs(F.col("approx_count_distinct_l_partkey") - exact) / exact < 0.1).alias("close")
    )


_SPREAD = ["stddev", "std", "stddev_samp", "stddev_pop", "variance", "var_samp", "var_pop"]
_SPREAD_SQL = {"stddev": "stddev_samp", "std": "stddev_samp", "variance": "var_samp"}


@query(
    "agg_stddev_variance",
    "SELECT l_linestatus, "
    + ", ".join(f"round({_SPREAD_SQL.get(f, f)}(l_quantity), 4) AS {f}_l_quantity" for f in _SPREAD)
    + " FROM lineitem GROUP BY l_linestatus",
)
def agg_stddev_variance(spark, sf):
    out = aggregate(_items(spark, sf), "l_linestatus", [f"{f}:l_quantity" for f in _SPREAD])
    return rounded(out, *[f"{f}_l_quantity" for f in _SPREAD], digits=4)


@query(
    "agg_shape",
    """
    WITH m AS (SELECT l_linestatus, avg(l_quantity) AS u FROM lineitem GROUP BY 1)
    SELECT lineitem.l_linestatus AS l_linestatus, round(avg((l_quantity - u) ** 3) / avg((l_quantity - u) ** 2) ** 1.5, 5) AS skewness_l_quantity,
           round(avg((l_quantity - u) ** 4) / avg((l_quantity - u) ** 2) ** 2 - 3, 5) AS kurtosis_l_quantity
    FROM lineitem JOIN m ON lineitem.l_linestatus IS NOT DISTINCT FROM m.l_linestatus GROUP BY lineitem.l_linestatus
    """,
)
def agg_shape(spark, sf):
    out = aggregate(_items(spark, sf), "l_linestatus", "skewness:l_quantity,kurtosis:l_quantity")
    return rounded(out, "skewness_l_quantity", "kurtosis_l_quantity", digits=5)


@query(
    "agg_median_mode",
    """
    WITH f AS (SELECT l_returnflag, l_partkey, row_number() OVER (PARTITION BY l_returnflag ORDER BY count(*) DESC, l_partkey) AS r
               FROM lineitem WHERE l_partkey IS NOT NULL GROUP BY l_returnflag, l_partkey),
         g AS (SELECT l_returnflag, count(*) AS count_rows, median(l_extendedprice) AS median_l_extendedprice,
                      median(CAST(l_quantity AS DOUBLE)) AS median_l_quantity
               FROM lineitem GROUP BY l_returnflag)
    SELECT g.l_returnflag AS l_returnflag, count_rows, round(median_l_extendedprice, 4) AS median_l_extendedprice, median_l_quantity,
           l_partkey AS mode_l_partkey
    FROM g JOIN f ON g.l_returnflag IS NOT DISTINCT FROM f.l_returnflag WHERE r = 1
    """,
)
def agg_median_mode(spark, sf):
    out = aggregate(
        _items(spark, sf), "l_returnflag", "count:*,median:l_extendedprice,median:l_quantity,mode:l_partkey"
    )
    return rounded(out, "median_l_extendedprice", digits=4)


@query(
    "agg_median_global",
    "SELECT median(o_totalprice) AS median_o_totalprice, count(*) AS count_rows FROM orders",
)
def agg_median_global(spark, sf):
    return aggregate(table(spark, sf, "orders"), None, "median:o_totalprice,count:*")


@query(
    "agg_percentiles_exact",
    """
    SELECT l_returnflag, quantile_disc(9007199254740993 + l_orderkey, 0.5) AS p50_wide, quantile_disc(9007199254740993 + l_orderkey, 0.99) AS p99_wide,
           quantile_disc(CAST(l_quantity AS BIGINT), 0.1) AS p10_tied, strftime(quantile_disc(l_shipdate, 0.9), '%Y-%m-%d') AS p90_day
    FROM lineitem GROUP BY l_returnflag
    """,
)
def agg_percentiles_exact(spark, sf):
    """Percentiles of integers no double can hold, of values with many ties and of times, all in the same passes."""
    wide = F.lit(9007199254740993) + F.col("l_orderkey")
    nearest = lambda p: lambda n: F.greatest(F.ceil(n * F.lit(p)), F.lit(1))
    ranks = [
        Rank("p50_wide", wide, 0.5, nearest(0.5)),
        Rank("p99_wide", wide, 0.99, nearest(0.99)),
        Rank("p10_tied", F.col("l_quantity").cast("long"), 0.1, nearest(0.1)),
        Rank("p90_day", F.col("l_shipdate"), 0.9, nearest(0.9)),
    ]
    return order_statistics(_items(spark, sf), ["l_returnflag"], ranks).withColumn("p90_day", day("p90_day"))


_PICK = ["first", "last", "first_value", "last_value", "any_value"]


@query(
    "agg_first_last",
    "SELECT o_custkey, " + ", ".join(f"'c' || o_custkey AS {f}_tag" for f in _PICK) + " FROM orders GROUP BY o_custkey",
)
def agg_first_last(spark, sf):
    orders = table(spark, sf, "orders").withColumn("tag", F.concat(F.lit("c"), "o_custkey"))
    return aggregate(orders, "o_custkey", [f"{f}:tag" for f in _PICK])


@query(
    "agg_collect",
    """
    SELECT l_orderkey, coalesce(string_agg(l_linenumber, ',' ORDER BY l_linenumber), '') AS lines,
           coalesce(string_agg(l_linenumber, ',' ORDER BY l_linenumber), '') AS lines_agg,
           coalesce(array_to_string(list_sort(list(DISTINCT l_linenumber) FILTER (WHERE l_linenumber IS NOT NULL)), ','), '') AS line_set
    FROM lineitem GROUP BY l_orderkey
    """,
)
def agg_collect(spark, sf):
    out = aggregate(
        _items(spark, sf),
        "l_orderkey",
        "collect_list:l_linenumber,array_agg:l_linenumber,collect_set:l_linenumber",
    )

    def text(c):
        return F.array_join(F.sort_array(c), ",")

    return out.select(
        "l_orderkey",
        text("collect_list_l_linenumber").alias("lines"),
        text("array_agg_l_linenumber").alias("lines_agg"),
        text("collect_set_l_linenumber").alias("line_set"),
    )


@query(
    "agg_listagg",
    """
    SELECT l_orderkey, string_agg(l_linenumber, ',' ORDER BY l_linenumber) AS lines,
           string_agg(l_linenumber, ',' ORDER BY l_linenumber) AS lines_agg,
           string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS flags
    FROM lineitem GROUP BY l_orderkey
    """,
)
def agg_listagg(spark, sf):
    out = aggregate(
        _items(spark, sf),
        "l_orderkey",
        "listagg:l_linenumber,string_agg:l_linenumber,listagg_distinct:l_returnflag",
    )

    def ordered(c):
        return F.array_join(F.sort_array(F.split(c, ",")), ",")

    return out.select(
        "l_orderkey",
        ordered("listagg_l_linenumber").alias("lines"),
        ordered("string_agg_l_linenumber").alias("lines_agg"),
        ordered("listagg_distinct_l_returnflag").alias("flags"),
    )


@query(
    "agg_boolean",
    """
    SELECT l_suppkey, bool_and(l_quantity > 1) AS bool_and_big, bool_and(l_quantity > 1) AS every_big,
           bool_or(l_discount = 0.1) AS bool_or_deep, bool_or(l_discount = 0.1) AS some_deep,
           count_if(l_quantity > 25)::BIGINT AS count_if_half
    FROM lineitem GROUP BY l_suppkey
    """,
)
def agg_boolean(spark, sf):
    items = _items(spark, sf).select(
        "l_suppkey",
        (F.col("l_quantity") > 1).alias("big"),
        (F.col("l_discount") == 0.1).alias("deep"),
        (F.col("l_quantity") > 25).alias("half"),
    )
    return aggregate(items, "l_suppkey", "bool_and:big,every:big,bool_or:deep,some:deep,count_if:half")


@query(
    "agg_bitwise",
    """
    SELECT l_suppkey, bit_and(l_partkey) AS bit_and_l_partkey, bit_or(l_partkey) AS bit_or_l_partkey,
           bit_xor(l_orderkey) AS bit_xor_l_orderkey FROM lineitem GROUP BY l_suppkey
    """,
)
def agg_bitwise(spark, sf):
    return aggregate(_items(spark, sf), "l_suppkey", "bit_and:l_partkey,bit_or:l_partkey,bit_xor:l_orderkey")


@query(
    "agg_product_try",
    """
    SELECT l_orderkey, round(product(1 - l_discount) * 0.7390851332151607::DOUBLE, 6) AS product_keep,
           CAST(sum(l_linenumber) AS BIGINT) AS try_sum_l_linenumber, round(avg(l_quantity), 4) AS try_avg_l_quantity
    FROM lineitem GROUP BY l_orderkey
    """,
)
def agg_product_try(spark, sf):
    items = _items(spark, sf).withColumn("keep", 1 - F.col("l_discount"))
    out = aggregate(items, "l_orderkey", "product:keep,try_sum:l_linenumber,try_avg:l_quantity")
    # Products of two-digit factors often end in a 5; the odd factor keeps them off rounding ties.
    out = out.withColumn("product_keep", F.col("product_keep") * F.lit(0.7390851332151607))
    return rounded(rounded(out, "product_keep", digits=6), "try_avg_l_quantity", digits=4)


@query(
    "agg_grouping_sets",
    """
    SELECT l_returnflag, l_linestatus, count(*) AS count_rows, sum(l_quantity) AS sum_l_quantity FROM lineitem
    GROUP BY GROUPING SETS ((l_returnflag), (l_linestatus), ())
    """,
)
def agg_grouping_sets(spark, sf):
    return aggregate_levels(
        _items(spark, sf), "count:*,sum:l_quantity", sets=[["l_returnflag"], ["l_linestatus"], []]
    )


@query(
    "agg_rollup",
    """
    SELECT n_name, c_mktsegment, CAST(grouping_id(n_name, c_mktsegment) AS BIGINT) AS level, count(*) AS count_rows,
           round(sum(c_acctbal), 2) AS sum_c_acctbal
    FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ROLLUP (n_name, c_mktsegment)
    """,
)
def agg_rollup(spark, sf):
    nations = table(spark, sf, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    customers = lookup(table(spark, sf, "customer"), nations, "c_nationkey", "n_name", "inner")
    out = aggregate_levels(customers, "count:*,sum:c_acctbal", rollup="n_name,c_mktsegment", level="level")
    return rounded(out.withColumn("level", F.col("level").cast("long")), "sum_c_acctbal")


@query(
    "agg_cube",
    """
    SELECT o_orderstatus, o_orderpriority, count(*) AS count_rows, max(o_totalprice) AS max_o_totalprice
    FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)
    """,
)
def agg_cube(spark, sf):
    return aggregate_levels(table(spark, sf, "orders"), "count:*,max:o_totalprice", cube="o_orderstatus,o_orderpriority")


@query(
    "agg_window_daily",
    """
    SELECT event_type, strftime(date_trunc('day', ts), '%Y-%m-%d') AS window_start, count(*) AS count_rows,
           round(sum(value), 2) AS sum_value
    FROM events GROUP BY ALL
    """,
)
def agg_window_daily(spark, sf):
    out = aggregate_window(table(spark, sf, "events"), "ts", "daily", "event_type", "count:*,sum:value")
    return rounded(out.withColumn("window_start", day("window_start")), "sum_value")


@query(
    "agg_window_weekly",
    """
    SELECT o_orderpriority, strftime(date_trunc('week', o_orderdate), '%Y-%m-%d') AS window_start,
           count(*) AS count_rows, max(o_totalprice) AS max_o_totalprice
    FROM orders GROUP BY ALL
    """,
)
def agg_window_weekly(spark, sf):
    out = aggregate_window(table(spark, sf, "orders"), "o_orderdate", "weekly", "o_orderpriority", "count:*,max:o_totalprice")
    return out.withColumn("window_start", day("window_start"))


@query(
    "agg_window_interval",
    """
    SELECT strftime(time_bucket(INTERVAL '6 hours', ts), '%Y-%m-%d %H:%M') AS window_start, count(*) AS count_rows,
           round(avg(value), 8) AS avg_value
    FROM events GROUP BY 1
    """,
)
def agg_window_interval(spark, sf):
    out = aggregate_window(table(spark, sf, "events"), "ts", "6 hours", None, "count:*,avg:value")
    return rounded(out.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm")), "avg_value", digits=8)


@query(
    "agg_rolling",
    """
    WITH d AS (SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n, count(value) AS c, sum(value) AS s, max(value) AS m
               FROM events GROUP BY ALL)
    SELECT event_type, strftime(day, '%Y-%m-%d') AS day, CAST(sum(n) OVER w AS BIGINT) AS count_rows,
           round(sum(s) OVER w, 2) AS sum_value, round(sum(s) OVER w / sum(c) OVER w, 8) AS avg_value,
           max(m) OVER w AS max_value
    FROM d WINDOW w AS (PARTITION BY event_type ORDER BY day RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW)
    """,
)
def agg_rolling(spark, sf):
    out = aggregate_rolling(
        table(spark, sf, "events"), "ts", 7, "event_type", "count:*,sum:value,avg:value,max:value"
    )
    return rounded(rounded(out.withColumn("day", day("day")), "sum_value"), "avg_value", digits=8)
