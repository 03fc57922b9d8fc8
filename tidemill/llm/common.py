"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from ..session import staged, tune

#: Rows in one Arrow batch to Python: a batch of very long texts must fit in a worker's memory.
ARROW_ROWS = 256


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this library, once per application: their Python need not have it installed."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    target = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="py-")), f"{package.name}.zip")
    with zipfile.ZipFile(target, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, str(file.relative_to(package.parent)))
    context.addPyFile(target)
    _shipped.add(context.applicationId)


def session(spark: SparkSession) -> SparkSession:
    """The session with the library's settings, Arrow batches fit for long texts, and the library shipped."""
    tune(spark)
    ship(spark)
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", None) != str(ARROW_ROWS):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return session(spark).read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back, until ``release_staged``.

    Used where a result is read more than once or ends a loop step: its lineage is cut, it
    outlives the executor that computed it, and the planner knows its size.
    """
    return staged(df, name)
