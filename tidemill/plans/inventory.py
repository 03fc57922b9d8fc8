"""File and configuration inventory per application and layer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import hadoop


def file_inventory(spark: SparkSession, root: str) -> DataFrame:
    """``app, layer, files`` for ``<root>/<app>/<layer>/...``, any depth below. Metadata only.

    Every file counts, also hidden and empty ones, which Spark's own listings leave out: the file system sums up
    each layer's folder, one request per layer.
    """
    fs, where = hadoop(spark, root)
    folders = lambda path: [s.getPath() for s in fs.listStatus(path) if s.isDirectory()]
    found = [
        (app.getName(), layer.getName(), int(fs.getContentSummary(layer).getFileCount()))
        for app in folders(where)
        for layer in folders(app)
    ]
    return spark.createDataFrame([f for f in found if f[2]], "app string, layer string, files long")


def inventory_summary(entries: DataFrame, files: DataFrame | None = None, max_ids: int | None = None) -> DataFrame:
    """``app, layer, pipelines, jobs, data_file_count`` from rows ``(app, layer, kind, id)``.

    ``kind`` is ``pipeline``, ``job`` or ``file``. Ids come out sorted and once each. They are
    names of configuration documents; with ``max_ids`` given, more of them in one list raises before
    any list is built. ``files`` adds counts from :func:`file_inventory`.
    """
    if max_ids is not None:
        listed = F.when(F.col("kind").isin("pipeline", "job"), F.struct("kind", "id"))
        largest = entries.groupBy("app", "layer").agg(F.count_distinct(listed).alias("n")).agg(F.max("n")).first()[0]
        if largest is not None and largest > max_ids:
            raise ValueError(f"inventory: {largest} ids in one list, over max_ids={max_ids}")

    def ids(kind: str):
        return F.sort_array(F.collect_set(F.when(F.col("kind") == kind, F.col("id"))))

    summary = entries.groupBy("app", "layer").agg(
        ids("pipeline").alias("pipelines"),
        ids("job").alias("jobs"),
        F.count_if(F.col("kind") == "file").alias("data_file_count"),
    )
    if files is None:
        return summary
    counted = files.groupBy("app", "layer").agg(F.sum("files").alias("files"))
    return (
        summary.join(counted, ["app", "layer"], "left")
        .withColumn("data_file_count", F.col("data_file_count") + F.coalesce("files", F.lit(0)))
        .drop("files")
    )


def filter_inventory(
    summary: DataFrame, app: str | None = None, layer: str | None = None, query: str | None = None
) -> DataFrame:
    """Summaries by app, layer and part of any pipeline id (any case)."""
    if app and app != "all":
        summary = summary.filter(F.col("app") == app)
    if layer and layer != "all":
        summary = summary.filter(F.col("layer") == layer)
    if query:
        summary = summary.filter(F.exists("pipelines", lambda p: F.lower(p).contains(query.lower())))
    return summary


def inventory_totals(summary: DataFrame) -> DataFrame:
    """Pipelines, jobs and files: grand total, by app and by layer, in one pass."""
    sized = summary.select(
        "app", "layer", F.size("pipelines").alias("p"), F.size("jobs").alias("j"), F.col("data_file_count").alias("f")
    )
    return sized.groupingSets([[F.col("app")], [F.col("layer")], []], F.col("app"), F.col("layer")).agg(
        F.sum("p").alias("pipelines"), F.sum("j").alias("jobs"), F.sum("f").alias("files")
    )
