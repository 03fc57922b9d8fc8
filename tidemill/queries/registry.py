"""Where the example queries register themselves with the SQL they must agree with."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        @wraps(fn)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(tune(spark), folder)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def day(column: str):
    """A date as text, which every engine prints alike."""
    return F.date_format(column, "yyyy-MM-dd")


def rounded(df: DataFrame, *columns: str, digits: int = 2) -> DataFrame:
    """Round floating sums: their last digits depend on the order of addition."""
    return df.withColumns({c: F.round(c, digits) for c in columns})
