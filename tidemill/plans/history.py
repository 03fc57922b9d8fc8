"""Run logs and the reports over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import VariantType

from ..functions import round_binary
from ..operators.ranks import percentiles

#: Fixed value: schema of one run log. Metrics keep their JSON types: a number and digits in quotes count differently.
LOG_SCHEMA = (
    "run_id string, pipeline_id string, app_name string, layer string, version string, executed_at string, "
    "metrics variant, config_path string, status string, duration_ms string, error string"
)

#: Metric names that give the row count directly, in order of preference.
ROW_METRICS = ("rows_processed", "records_processed", "rows_written", "records_written")


def read_run_logs(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Run logs under ``path``; unreadable and empty ones are left out.

    ``multi_line`` reads one indented document per file, otherwise one document per line.
    Absent app and layer come from the folders ``.../<app>/<layer>/<file>``.
    """
    raw = (
        spark.read.schema(f"{LOG_SCHEMA}, _corrupt_record string")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .option("multiLine", multi_line)
        .option("recursiveFileLookup", True)
        .json(path)
    )
    folders = F.split(F.col("_metadata.file_path"), "/")
    fields = [c for c in raw.columns if c not in ("metrics", "_corrupt_record")]
    filled = F.coalesce(*fields).isNotNull() | F.col("metrics").isNotNull()
    return (
        raw.select("*", folders.alias("folders"))
        .filter(F.col("_corrupt_record").isNull() & filled)
        .withColumn("app_name", _or_folder("app_name", -3))
        .withColumn("layer", _or_folder("layer", -2))
        .drop("_corrupt_record", "folders")
    )


def _or_folder(column: str, position: int) -> Column:
    own = F.nullif(F.col(column), F.lit(""))
    return F.coalesce(own, F.try_element_at(F.col("folders"), F.lit(position)))


def rows_processed(metrics: Column) -> Column:
    """``row_count`` of metrics in a map; text values count as quoted ones."""
    return row_count(F.to_variant_object(metrics))


def row_count(metrics: Column) -> Column:
    """Row count of a run from its metrics, a JSON object as ``variant``.

    The first preferred metric that is a number, or nothing but digits in quotes, with fractions cut; else the sum of
    all metrics whose name contains ``row`` or ``record`` and that are, or read as, numbers. A sum that is not
    positive, or nothing at all, is null, as are metrics that are no object. NaN, infinities and
    values no long can hold count as absent, so one bad metric does not fail the report.
    """
    entries = F.try_variant_get(metrics, "$", "map<string,variant>")

    def finite(value: Column) -> Column:
        return F.when(~F.isnan(value) & (F.abs(value) < 2.0**63), value)

    def number(value: Column) -> Column:
        return finite(F.try_variant_get(value, "$", "double"))

    def counted(value: Column) -> Column:
        kind, text = F.schema_of_variant(value), F.try_variant_get(value, "$", "string")
        whole = F.when((kind == "BIGINT") | ((kind == "STRING") & text.rlike(r"^\d+$")), text.try_cast("long"))
        return F.coalesce(whole, F.when(kind.rlike("^(DECIMAL|DOUBLE|FLOAT|BOOLEAN)"), number(value)).try_cast("long"))

    preferred = [counted(F.try_element_at(entries, F.lit(name))) for name in ROW_METRICS]
    related = F.map_filter(entries, lambda k, v: F.lower(k).contains("row") | F.lower(k).contains("record"))
    total = F.aggregate(
        F.map_values(related), F.lit(0.0), lambda acc, v: acc + F.coalesce(number(v), F.lit(0.0))
    )
    return F.coalesce(*preferred, F.when(total > 0, total).try_cast("long"))


def run_history(logs: DataFrame, newest_first: bool = True) -> DataFrame:
    """Eight report fields per run, newest first, runs without a time last."""
    read_as_json = isinstance(logs.schema["metrics"].dataType, VariantType)
    runs = logs.select(
        "run_id",
        "pipeline_id",
        "app_name",
        "layer",
        "executed_at",
        (row_count if read_as_json else rows_processed)(F.col("metrics")).alias("rows_processed"),
        F.coalesce(F.col("status"), F.lit("completed")).alias("status"),
        round_binary(F.col("duration_ms").try_cast("double") / 60000, 2).alias("duration_minutes"),
    )
    return runs.orderBy(F.col("executed_at").desc_nulls_last(), F.col("run_id").desc_nulls_last()) if newest_first else runs


def latest_runs(logs: DataFrame, app: str, layer: str, pipeline_id: str, limit: int = 5) -> DataFrame:
    """The newest runs of one pipeline (a top-N, not a full sort)."""
    return (
        logs.filter(
            (F.col("app_name") == app) & (F.col("layer") == layer) & (F.col("pipeline_id") == pipeline_id)
        )
        .orderBy(F.col("executed_at").desc_nulls_last(), F.col("run_id").desc_nulls_last())
        .limit(limit)
    )


def run_by_id(logs: DataFrame, app: str, layer: str, pipeline_id: str, run_id: str) -> DataFrame:
    """One run's log, or no row."""
    return logs.filter(
        (F.col("app_name") == app)
        & (F.col("layer") == layer)
        & (F.col("pipeline_id") == pipeline_id)
        & (F.col("run_id") == run_id)
    )


def filter_runs(
    runs: DataFrame,
    app: str | None = None,
    layer: str | None = None,
    query: str | None = None,
    date: str | None = None,
) -> DataFrame:
    """Runs by app, layer, part of the pipeline id (any case) and day; empty or ``all`` is no filter."""
    if app and app != "all":
        runs = runs.filter(F.col("app_name") == app)
    if layer and layer != "all":
        runs = runs.filter(F.col("layer") == layer)
    if query:
        runs = runs.filter(F.lower(F.coalesce("pipeline_id", F.lit(""))).contains(query.lower()))
    if date:
        runs = runs.filter(F.substring("executed_at", 1, 10) == date)
    return runs


def daily_runs(runs: DataFrame) -> DataFrame:
    """Runs, successes and failures per day."""
    failed = F.col("status") == "failed"
    return runs.groupBy(F.substring("executed_at", 1, 10).alias("run_date")).agg(
        F.count(F.lit(1)).alias("runs"),
        F.count_if(~failed).alias("succeeded"),
        F.count_if(failed).alias("failed"),
    )


def failure_reasons(logs: DataFrame) -> DataFrame:
    """How often each error text occurred among failed runs."""
    return (
        logs.filter(F.col("status") == "failed")
        .groupBy(F.coalesce("error", F.lit("unknown")).alias("error"))
        .agg(F.count(F.lit(1)).alias("runs"))
    )


def latency_percentiles(logs: DataFrame, by: str, points: tuple[float, ...] = (0.5, 0.9, 0.99)) -> DataFrame:
    """Runs and exact nearest-rank percentiles of ``duration_ms``, fractions included, per group."""
    ms = F.col("duration_ms").try_cast("double")
    runs = logs.groupBy(by).agg(F.count(F.lit(1)).alias("runs"))
    placed = percentiles(logs.filter(ms.isNotNull() & ~F.isnan(ms)), [by], ms, {f"p{round(p * 100)}_ms": p for p in points})
    same = F.col(f"runs.{by}").eqNullSafe(F.col(f"placed.{by}"))
    return runs.alias("runs").join(placed.alias("placed"), same, "left").select("runs.*", *[c for c in placed.columns if c != by])


def sla_report(logs: DataFrame, sla_ms: int | Column, by: str) -> DataFrame:
    """Runs inside and outside their time budget per group."""
    limit = sla_ms if isinstance(sla_ms, Column) else F.lit(sla_ms)
    ms = F.col("duration_ms").try_cast("double")
    late = ~F.isnan(ms) & (ms > limit)
    return logs.groupBy(by).agg(
        F.count(F.lit(1)).alias("runs"),
        F.count_if(late).alias("late_runs"),
        (1 - F.count_if(late) / F.count(F.lit(1))).alias("adherence"),
    )
