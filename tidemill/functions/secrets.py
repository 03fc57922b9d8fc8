"""Keys named by reference: the value reaches the tasks, and neither plans nor logs."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _from_file(spark: SparkSession, name: str) -> DataFrame:
    """The text of a small file any task can reach, without white space around it."""
    return spark.read.text(name, wholetext=True).select(F.trim(F.regexp_replace("value", r"^\s+|\s+$", "")).alias("value"))


def _from_environment(spark: SparkSession, name: str) -> DataFrame:
    """A variable of the driver's environment."""
    if name not in os.environ:
        raise KeyError(f"secret: the environment has no {name}")
    return spark.createDataFrame([(os.environ[name],)], "value string")


#: How each kind of reference (``kind:name``) becomes a frame of one row with the value; add your own key stores.
PROVIDERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {"file": _from_file, "env": _from_environment}


def secret(spark: SparkSession, reference: str) -> Column:
    """The value behind ``file:/keys/cards`` or ``env:CARDS_KEY`` as a column.

    It is a scalar subquery: plans, explain output and event logs show where the value is read from, and the value is
    first known when the query runs. No value, or more than one, fails the query.
    """
    kind, _, name = reference.partition(":")
    if kind not in PROVIDERS or not name:
        raise ValueError(f"secret: {kind!r} is no known kind of reference; known: {sorted(PROVIDERS)}")
    value = PROVIDERS[kind](spark, name)
    return F.coalesce(value.scalar(), F.raise_error(F.lit(f"secret {kind} has no value")).cast("string"))
