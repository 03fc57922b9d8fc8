"""Whole flows: sources, steps and targets declared together."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from ..plans import STEPS, custom_step, read_run_logs, run_flow
from ..quality import Check, NotNull, read_quarantine
from ..session import shared_path
from ..sources import read_csv, read_files
from ..sources.files import publish_small
from .registry import day, query, rounded, table


def _frame(name, df):
    return {"id": name, "type": "frame", "frame": df}


def _parquet(name, sf, file):
    return {"id": name, "type": "parquet", "path": f"{sf}/{file}.parquet"}


def _flow(name, sources, steps=(), targets=(), **more):
    return {"id": name, "app": "sample", "layer": "staging", "sources": sources, "steps": list(steps), "targets": list(targets), **more}


def flagship_flow(spark, sf):
    """Latest order per customer, enriched, masked and summed by market segment."""
    customers = table(spark, sf, "customer").withColumnRenamed("c_custkey", "o_custkey")
    return _flow(
        "latest_orders",
        [_parquet("orders", sf, "orders"), _frame("customer_dim", customers)],
        [
            {"step": "deduplicate", "source": "orders", "keys": "o_custkey", "keep": "latest", "orderBy": "o_orderdate", "tieBreaker": "o_orderkey"},
            {"step": "lookup", "source": "orders", "reference": "customer_dim", "joinColumns": "o_custkey", "outputFields": "c_mktsegment,c_nationkey"},
            {"step": "mask", "source": "orders", "columns": "o_custkey", "strategy": "hash", "output": "masked_orders"},
            {"step": "aggregate", "source": "masked_orders", "groupBy": "c_mktsegment", "metrics": "count:*,sum:o_totalprice", "output": "summary"},
        ],
    )


_FLAGSHIP_SQL = """
    WITH d AS (SELECT * FROM orders QUALIFY row_number() OVER
                 (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC) = 1)
    SELECT c_mktsegment, count(*) AS count_rows, round(sum(o_totalprice), 2) AS sum_o_totalprice
    FROM d LEFT JOIN customer ON o_custkey = c_custkey GROUP BY 1"""


@query("flow_flagship", _FLAGSHIP_SQL)
def flow_flagship(spark, sf):
    run = run_flow(spark, flagship_flow(spark, sf), write=False)
    return rounded(run.datasets["summary"], "sum_o_totalprice")


@query("flow_with_targets", _FLAGSHIP_SQL)
def flow_with_targets(spark, sf):
    """The flagship with both targets written: the masked rows as a table, the summary as CSV."""
    root, summary_path = shared_path(spark, "flow"), shared_path(spark, "flow-summary")
    flow = flagship_flow(spark, sf)
    flow["targets"] = [
        {"type": "hive", "source": "masked_orders", "table": "staging.latest_orders", "mode": "overwrite", "partitionBy": "o_orderstatus"},
        {"type": "csv", "source": "summary", "path": summary_path, "mode": "overwrite"},
    ]
    run = run_flow(spark, flow, data_root=root)
    back = read_csv(spark, summary_path, schema=run.datasets["summary"].schema)
    run.release(spark)
    return rounded(back, "sum_o_totalprice")


@query(
    "flow_target_schema",
    """
    SELECT CASE WHEN o_orderpriority = '1-URGENT' OR o_orderkey % 13 = 0 THEN 'rejected' ELSE 'kept' END AS outcome, count(*) AS count_rows,
           CAST(sum(o_orderkey) AS BIGINT) AS sum_key,
           CAST(sum(CASE WHEN o_orderpriority <> '1-URGENT' AND o_orderkey % 13 <> 0 THEN CAST(substr(o_orderpriority, 1, 1) AS INT) ELSE 0 END) AS BIGINT)
               AS sum_priority
    FROM orders GROUP BY 1
    """,
)
def flow_target_schema(spark, sf):
    """A target with a declared schema: rows with a bad priority or no status go to the quarantine."""
    path, held, ref = shared_path(spark, "declared"), shared_path(spark, "held"), shared_path(spark, "declared-schema")
    fields = [("o_orderkey", "long"), ("priority", "int"), ("o_orderstatus", "string")]
    publish_small(spark, ref, json.dumps({"type": "record", "name": "o", "fields": [{"name": n, "type": t} for n, t in fields]}))
    priority = F.when(F.col("o_orderpriority") == "1-URGENT", "urgent").otherwise(F.substring("o_orderpriority", 1, 1))
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        priority.alias("priority"),
        F.when(F.col("o_orderkey") % 13 != 0, F.col("o_orderstatus")).alias("o_orderstatus"),
    )
    flow = _flow("declared", [_frame("orders", orders)], targets=[{"type": "table", "path": path, "schemaRef": ref}])
    run_flow(spark, flow, quarantine_path=held).release(spark)
    kept = spark.read.parquet(path).select(F.lit("kept").alias("outcome"), "o_orderkey", "priority")
    rejected = read_quarantine(spark, held, orders.schema)
    rejected = rejected.select(F.lit("rejected").alias("outcome"), F.col("o_orderkey").cast("long").alias("o_orderkey"), F.lit(0).alias("priority"))
    return kept.unionAll(rejected).groupBy("outcome").agg(
        F.count(F.lit(1)).alias("count_rows"), F.sum("o_orderkey").alias("sum_key"), F.sum("priority").alias("sum_priority")
    )


@query("flow_passthrough", "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def flow_passthrough(spark, sf):
    path = shared_path(spark, "passthrough")
    run_flow(spark, _flow("copy", [_parquet("part", sf, "part")], targets=[{"type": "table", "path": path}]))
    return read_files(spark, path, "parquet")


def _net(df, rate):
    return df.withColumn("net", F.col("l_extendedprice") * (1 - F.col("l_discount")) * rate)


@query(
    "flow_custom_step",
    """
    SELECT l_returnflag, count(*) AS count_rows, round(sum(l_extendedprice * (1 - l_discount) * 2.0), 2) AS sum_net
    FROM lineitem GROUP BY l_returnflag
    """,
)
def flow_custom_step(spark, sf):
    steps = {**STEPS, "net_price": custom_step(_net, ("source", "rate"))}
    flow = _flow(
        "net",
        [_parquet("items", sf, "lineitem")],
        [
            {"step": "net_price", "source": "items", "rate": 2.0},
            {"step": "aggregate", "source": "items", "groupBy": "l_returnflag", "metrics": "count:*,sum:net"},
        ],
    )
    return rounded(run_flow(spark, flow, steps=steps, write=False).datasets["items"], "sum_net")


def _failing_flow(sf, policy):
    return _flow(
        "failing",
        [_parquet("customers", sf, "customer")],
        [
            {"step": "mask", "source": "customers", "columns": "no_such_column"},
            {"step": "aggregate", "source": "customers", "groupBy": "c_mktsegment", "metrics": "count:*", "output": "segments"},
        ],
        on_step_error=policy,
    )


@query("flow_on_error_skip", "SELECT c_mktsegment, count(*) AS count_rows FROM customer GROUP BY c_mktsegment")
def flow_on_error_skip(spark, sf):
    return run_flow(spark, _failing_flow(sf, "skip"), write=False).datasets["segments"]


@query(
    "flow_on_error_quarantine",
    "SELECT c_custkey, c_name, 'transformation_failure:mask' AS reason, 'run-9' AS run_id FROM customer",
)
def flow_on_error_quarantine(spark, sf):
    path = shared_path(spark, "step-quarantine")
    run_flow(spark, _failing_flow(sf, "quarantine"), {"run_id": "run-9"}, quarantine_path=path, write=False)
    schema = "c_custkey bigint, c_name string, reason string, run_id string"
    return spark.read.schema(schema).json(path)


@query(
    "flow_on_record_error",
    """
    WITH o AS (SELECT coalesce(o_totalprice >= 50000, true) AND coalesce(o_orderstatus <> 'P', false) AS good FROM orders)
    SELECT 'kept' AS side, count(*) AS count_rows FROM o WHERE good
    UNION ALL SELECT 'held', count(*) FROM o WHERE NOT good
    """,
)
def flow_on_record_error(spark, sf):
    path = shared_path(spark, "record-quarantine")
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus")
    )
    flow = _flow(
        "guarded",
        [_frame("orders", orders)],
        [{"step": "aggregate", "source": "orders", "metrics": "count:*", "output": "kept"}],
        record_rules={"orders": [NotNull("status", ["o_orderstatus"]), Check("price", "o_totalprice >= 50000")]},
    )
    run = run_flow(spark, flow, quarantine_path=path, write=False)
    held = spark.read.schema("reason string").json(path).agg(F.count(F.lit(1)).alias("count_rows"))
    kept = run.datasets["kept"].select(F.lit("kept").alias("side"), "count_rows")
    return kept.unionByName(held.select(F.lit("held").alias("side"), "count_rows"))


@query(
    "run_metrics",
    """
    SELECT 'pipeline_source_loaded' AS metric, 1.0::DOUBLE AS value
    UNION ALL SELECT 'pipeline_transform_deduplicate', 1.0
    UNION ALL SELECT 'pipeline_transform_mask', 1.0
    UNION ALL SELECT 'pipeline_targets_written', 2.0
    UNION ALL SELECT 'rows_written', 2 * (count(DISTINCT user_id) + max(CASE WHEN user_id IS NULL THEN 1 ELSE 0 END))::DOUBLE FROM events
    """,
)
def run_metrics(spark, sf):
    """Counters of a run as its log records them; rows are counted by the writes themselves."""
    logs, out = shared_path(spark, "run-logs"), shared_path(spark, "run-out")
    flow = _flow(
        "counted",
        [_parquet("events", sf, "events")],
        [
            {"step": "deduplicate", "source": "events", "keys": "user_id", "keep": "latest", "orderBy": "ts,event_id"},
            {"step": "mask", "source": "events", "columns": "user_id"},
        ],
        [{"type": "table", "path": out}, {"type": "csv", "path": out + "-csv"}],
    )
    run_flow(spark, flow, logs_root=logs, persist_shared=True)
    entry = read_run_logs(spark, f"{logs}/applications", multi_line=False)
    values = F.try_variant_get("metrics", "$", "map<string,double>")
    return entry.select(F.explode(values).alias("metric", "value"))


@query(
    "flow_rolling",
    """
    WITH d AS (SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n, max(value) AS m FROM events GROUP BY ALL)
    SELECT event_type, strftime(day, '%Y-%m-%d') AS day, CAST(sum(n) OVER w AS BIGINT) AS count_rows, max(m) OVER w AS max_value
    FROM d WINDOW w AS (PARTITION BY event_type ORDER BY day RANGE BETWEEN INTERVAL 2 DAY PRECEDING AND CURRENT ROW)
    """,
)
def flow_rolling(spark, sf):
    step = {"step": "rolling", "source": "events", "time": "ts", "days": "3", "groupBy": "event_type", "metrics": "count:*,max:value", "output": "out"}
    out = run_flow(spark, _flow("rolling", [_parquet("events", sf, "events")], [step]), write=False).datasets["out"]
    return out.withColumn("day", day("day"))


@query(
    "flow_rollup",
    """
    SELECT o_orderstatus, o_orderpriority, CAST(grouping_id(o_orderstatus, o_orderpriority) AS BIGINT) AS level,
           count(*) AS count_rows, max(o_totalprice) AS max_o_totalprice
    FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)
    """,
)
def flow_rollup(spark, sf):
    step = {"step": "levels", "source": "orders", "rollup": "o_orderstatus,o_orderpriority", "level": "level", "metrics": "count:*,max:o_totalprice"}
    out = run_flow(spark, _flow("rollup", [_parquet("orders", sf, "orders")], [step]), write=False).datasets["orders"]
    return out.withColumn("level", F.col("level").cast("long"))


@query(
    "flow_collect_set",
    """
    SELECT o_custkey, array_to_string(list_sort(list(DISTINCT o_orderpriority)), ',') AS priorities FROM orders GROUP BY o_custkey
    """,
)
def flow_collect_set(spark, sf):
    step = {"step": "aggregate", "source": "orders", "groupBy": "o_custkey", "metrics": "collect_set:o_orderpriority", "output": "sets"}
    out = run_flow(spark, _flow("sets", [_parquet("orders", sf, "orders")], [step]), write=False).datasets["sets"]
    return out.select("o_custkey", F.array_join(F.sort_array("collect_set_o_orderpriority"), ",").alias("priorities"))
