"""Run history and inventory reports; run logs are derived from the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import (
    daily_runs,
    failure_reasons,
    file_inventory,
    filter_inventory,
    filter_runs,
    inventory_summary,
    inventory_totals,
    latency_percentiles,
    latest_runs,
    read_run_logs,
    run_by_id,
    run_history,
    sla_report,
)
from ..session import shared_path
from .registry import query, table

# Events as run logs: the type names the pipeline, the hour of day the layer, the value the
# duration, with fractions. `view` logs are old ones without status, `signup` logs carry no metrics. A quoted number is a
# direct row count only if it is all digits ("12.5" is not), but adds to the sum; a negative sum is none.
_LOGS_SQL = """
    e AS (SELECT *, CASE WHEN hour(ts) < 8 THEN 'staging' WHEN hour(ts) < 16 THEN 'standardization' ELSE 'service' END AS layer,
                 CASE WHEN user_id < 50 THEN 'cards' ELSE 'loans' END AS app_name FROM events),
    logs AS (SELECT 'run-' || event_id AS run_id, 'load_' || event_type AS pipeline_id, app_name, layer,
                    strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS executed_at,
                    CASE event_type WHEN 'click' THEN event_id
                                    WHEN 'purchase' THEN CASE WHEN 2 * user_id > 0 THEN 2 * user_id END
                                    WHEN 'error' THEN event_id + 12 END AS rows_processed,
                    CASE WHEN event_type = 'error' THEN 'failed' ELSE 'completed' END AS status,
                    floor(value * 4000) / 4 AS duration_ms,
                    CASE WHEN event_type = 'error' THEN 'bad input ' || layer END AS error
             FROM e)"""


def _logs(spark, sf):
    kind, hour = F.col("event_type"), F.hour("ts")
    event, user = F.col("event_id").cast("string"), F.col("user_id").cast("string")
    metrics = (
        F.when(kind == "click", F.concat(F.lit('{"rows_processed": "'), event, F.lit('", "bad_rows": 1}')))
        .when(kind == "purchase", F.concat(F.lit('{"Rows_in": '), user, F.lit(', "good_records": "'), user, F.lit('", "seconds": 9}')))
        .when(kind == "error", F.concat(F.lit('{"rows_processed": "12.5", "rows_in": '), event, F.lit("}")))
        .when(kind == "view", F.lit('{"records_written": "-5"}'))
        .when(kind != "signup", F.lit("{}"))
    )
    layer = F.when(hour < 8, "staging").when(hour < 16, "standardization").otherwise("service")
    return table(spark, sf, "events").select(
        F.concat(F.lit("run-"), "event_id").alias("run_id"),
        F.concat(F.lit("load_"), kind).alias("pipeline_id"),
        F.when(F.col("user_id") < 50, "cards").otherwise("loans").alias("app_name"),
        layer.alias("layer"),
        F.lit("1.0").alias("version"),
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00")).alias("executed_at"),
        F.parse_json(metrics).alias("metrics"),
        F.when(kind == "error", "failed").when(kind != "view", "completed").alias("status"),
        (F.floor(F.col("value") * 4000) / 4).cast("string").alias("duration_ms"),
        F.when(kind == "error", F.concat(F.lit("bad input "), layer)).alias("error"),
    )


_RUN_FIELDS = """run_id, pipeline_id, app_name, layer, executed_at, coalesce(CAST(rows_processed AS VARCHAR), '') AS rows_processed,
           status, CAST(format('{:.2f}', duration_ms / 60000) AS DOUBLE) AS duration_minutes"""


def _printable(runs):
    """A missing row count as empty text."""
    return runs.withColumn("rows_processed", F.coalesce(F.col("rows_processed").cast("string"), F.lit("")))


@query(
    "runs_history",
    f"""
    WITH {_LOGS_SQL}
    SELECT run_id, pipeline_id, 'cards' AS app_name, CASE WHEN pipeline_id = 'load_click' THEN 'staging' ELSE layer END AS layer,
           executed_at, coalesce(CAST(rows_processed AS VARCHAR), '') AS rows_processed, status,
           CAST(format('{{:.2f}}', duration_ms / 60000) AS DOUBLE) AS duration_minutes
    FROM logs WHERE pipeline_id <> 'load_signup'
    """,
)
def runs_history(spark, sf):
    """Through files: click logs lack app and layer (the folder gives them), signup logs are broken."""
    root = shared_path(spark, "history")
    kind = F.col("pipeline_id")
    logs = _logs(spark, sf).withColumns(
        {
            "app_name": F.when(kind == "load_click", F.lit(None)).otherwise(F.lit("cards")),
            "layer": F.when(kind != "load_click", F.col("layer")),
        }
    )
    document = F.to_json(F.struct(*logs.columns))
    lines = logs.select(F.when(kind == "load_signup", F.concat(F.lit("{broken "), "run_id")).otherwise(document).alias("value"))
    lines.write.text(f"{root}/applications/cards/staging")
    return _printable(run_history(read_run_logs(spark, f"{root}/applications", multi_line=False)))


@query(
    "run_log_roundtrip",
    """
    SELECT 'load_' || event_type AS pipeline_id, count(*) AS runs,
           CAST(sum(CASE event_type WHEN 'click' THEN 2 WHEN 'purchase' THEN 3 WHEN 'error' THEN 2 WHEN 'view' THEN 1 ELSE 0 END)
                AS BIGINT) AS metrics
    FROM events GROUP BY event_type
    """,
)
def run_log_roundtrip(spark, sf):
    path = shared_path(spark, "run-log-table")
    _logs(spark, sf).write.mode("append").json(path)
    named = F.size(F.try_variant_get("metrics", "$", "map<string,variant>"))
    return read_run_logs(spark, path, multi_line=False).groupBy("pipeline_id").agg(
        F.count(F.lit(1)).alias("runs"), F.sum(F.coalesce(named, F.lit(0))).cast("long").alias("metrics")
    )


@query("runs_rows_processed", f"WITH {_LOGS_SQL} SELECT run_id, coalesce(CAST(rows_processed AS VARCHAR), '') AS rows_processed FROM logs")
def runs_rows_processed(spark, sf):
    return _printable(run_history(_logs(spark, sf), newest_first=False)).select("run_id", "rows_processed")


@query(
    "runs_latest_n",
    f"""
    WITH {_LOGS_SQL}
    SELECT run_id, executed_at FROM logs WHERE app_name = 'loans' AND layer = 'service' AND pipeline_id = 'load_purchase'
    ORDER BY executed_at DESC, run_id DESC LIMIT 5
    """,
)
def runs_latest_n(spark, sf):
    return latest_runs(_logs(spark, sf), "loans", "service", "load_purchase").select("run_id", "executed_at")


@query(
    "runs_by_id",
    f"""
    WITH {_LOGS_SQL}, f AS (SELECT min(run_id) AS run_id FROM logs WHERE pipeline_id = 'load_error' AND layer = 'staging' AND app_name = 'cards')
    SELECT run_id, executed_at, error FROM logs JOIN f USING (run_id)
    """,
)
def runs_by_id(spark, sf):
    logs = _logs(spark, sf)
    same = (F.col("pipeline_id") == "load_error") & (F.col("layer") == "staging") & (F.col("app_name") == "cards")
    wanted = logs.filter(same).agg(F.min("run_id")).first()[0]
    return run_by_id(logs, "cards", "staging", "load_error", wanted).select("run_id", "executed_at", "error")


@query(
    "runs_filtered",
    f"""
    WITH {_LOGS_SQL}
    SELECT {_RUN_FIELDS} FROM logs
    WHERE app_name = 'cards' AND layer = 'service' AND pipeline_id LIKE '%_vie%' AND substr(executed_at, 1, 10) = '2024-01-15'
    """,
)
def runs_filtered(spark, sf):
    runs = run_history(_logs(spark, sf))
    return _printable(filter_runs(runs, "cards", "service", "_VIE", "2024-01-15"))


@query(
    "runs_daily",
    f"""
    WITH {_LOGS_SQL}
    SELECT substr(executed_at, 1, 10) AS run_date, count(*) AS runs, count(*) FILTER (WHERE status <> 'failed') AS succeeded,
           count(*) FILTER (WHERE status = 'failed') AS failed
    FROM logs GROUP BY 1
    """,
)
def runs_daily(spark, sf):
    return daily_runs(run_history(_logs(spark, sf), newest_first=False))


@query("runs_failure_reasons", f"WITH {_LOGS_SQL} SELECT error, count(*) AS runs FROM logs WHERE status = 'failed' GROUP BY error")
def runs_failure_reasons(spark, sf):
    return failure_reasons(_logs(spark, sf))


@query(
    "runs_latency_percentiles",
    f"""
    WITH {_LOGS_SQL}
    SELECT pipeline_id, count(*) AS runs, quantile_disc(duration_ms, 0.5) AS p50_ms, quantile_disc(duration_ms, 0.9) AS p90_ms,
           quantile_disc(duration_ms, 0.99) AS p99_ms
    FROM logs GROUP BY pipeline_id
    """,
)
def runs_latency_percentiles(spark, sf):
    return latency_percentiles(_logs(spark, sf), "pipeline_id")


@query(
    "runs_sla",
    f"""
    WITH {_LOGS_SQL}
    SELECT pipeline_id, count(*) AS runs, count(*) FILTER (WHERE duration_ms > 100000) AS late_runs,
           round(1 - count(*) FILTER (WHERE duration_ms > 100000) / count(*), 6) AS adherence
    FROM logs GROUP BY pipeline_id
    """,
)
def runs_sla(spark, sf):
    out = sla_report(_logs(spark, sf), 100_000, "pipeline_id")
    return out.withColumn("adherence", F.round("adherence", 6))


# --- inventory -------------------------------------------------------------------------

_ENTRIES_SQL = f"""
    {_LOGS_SQL},
    entries AS (SELECT app_name AS app, layer, 'pipeline' AS kind, pipeline_id AS id FROM logs
                UNION ALL SELECT app_name, layer, 'job', 'job_' || substr(executed_at, 9, 2) FROM logs WHERE status = 'failed'
                UNION ALL SELECT app_name, layer, 'file', run_id FROM logs WHERE status = 'completed'),
    summary AS (SELECT app, layer, list_sort(list(DISTINCT id) FILTER (WHERE kind = 'pipeline')) AS pipelines,
                       list_sort(list(DISTINCT id) FILTER (WHERE kind = 'job')) AS jobs,
                       count(*) FILTER (WHERE kind = 'file') AS data_file_count
                FROM entries GROUP BY app, layer)"""


def _entries(spark, sf):
    """Pipelines, jobs and files per application and layer, as the run logs mention them."""
    logs = run_history(_logs(spark, sf), newest_first=False)
    place = [F.col("app_name").alias("app"), "layer"]
    pipelines = logs.select(*place, F.lit("pipeline").alias("kind"), F.col("pipeline_id").alias("id"))
    job = F.concat(F.lit("job_"), F.substring("executed_at", 9, 2))
    jobs = logs.filter("status = 'failed'").select(*place, F.lit("job").alias("kind"), job.alias("id"))
    files = logs.filter("status = 'completed'").select(*place, F.lit("file").alias("kind"), F.col("run_id").alias("id"))
    return pipelines.unionAll(jobs).unionAll(files)


def _joined(summary):
    return summary.withColumns({c: F.array_join(c, ",") for c in ("pipelines", "jobs")})


_SUMMARY_FIELDS = "app, layer, array_to_string(pipelines, ',') AS pipelines, array_to_string(jobs, ',') AS jobs, data_file_count"


@query("inventory_summary", f"WITH {_ENTRIES_SQL} SELECT {_SUMMARY_FIELDS} FROM summary")
def inventory_summary_query(spark, sf):
    return _joined(inventory_summary(_entries(spark, sf)))


@query(
    "inventory_filtered",
    f"""
    WITH {_ENTRIES_SQL}
    SELECT {_SUMMARY_FIELDS} FROM summary
    WHERE app = 'loans' AND len(list_filter(pipelines, lambda p: contains(lower(p), 'purch'))) > 0
    """,
)
def inventory_filtered(spark, sf):
    return _joined(filter_inventory(inventory_summary(_entries(spark, sf)), app="loans", layer="all", query="PURCH"))


@query(
    "inventory_totals",
    f"""
    WITH {_ENTRIES_SQL}
    SELECT app, layer, CAST(sum(len(pipelines)) AS BIGINT) AS pipelines, CAST(sum(len(jobs)) AS BIGINT) AS jobs,
           CAST(sum(data_file_count) AS BIGINT) AS files
    FROM summary GROUP BY GROUPING SETS ((app), (layer), ())
    """,
)
def inventory_totals_query(spark, sf):
    return inventory_totals(inventory_summary(_entries(spark, sf)))


@query(
    "inventory_files",
    f"""
    WITH {_LOGS_SQL}
    SELECT 'app_name=' || app_name AS app, 'layer=' || layer AS layer, count(DISTINCT pipeline_id) AS files FROM logs GROUP BY ALL
    """,
)
def inventory_files(spark, sf):
    """One file per pipeline that has logs, in folders of application and layer."""
    root, place = shared_path(spark, "inventory"), ["app_name", "layer", "pipeline_id"]
    pipelines = _logs(spark, sf).groupBy(*place).agg(F.max("executed_at").alias("newest"))
    pipelines.repartition(*place).write.partitionBy(*place).csv(root)
    return file_inventory(spark, root)
