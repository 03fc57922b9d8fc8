"""Quarantine of rejected rows, and their replay."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from ..functions import col, names
from ..operators.merge import merge
from .rules import Rule, split_by_rules

#: What quarantine adds to a row.
ADDED = ("reason", "rule_id", "quarantined_at", "run_id")


def quarantine_rows(df: DataFrame, reason: str, run_id: str, rule_column: str | None = None) -> DataFrame:
    """Source rows with reason, run id, the rules they broke and the time."""
    clash = [c for c in ADDED if c in df.columns]
    if clash:
        raise ValueError(f"quarantine: {clash} already exist in the dataset")
    rule = col(rule_column) if rule_column else F.lit(None).cast("string")
    out = df.drop(rule_column) if rule_column else df
    # The rule column may be dropped from the payload, so resolve it on the incoming frame.
    return df.select(
        *[col(c) for c in out.columns],
        F.lit(reason).alias("reason"),
        rule.alias("rule_id"),
        F.current_timestamp().alias("quarantined_at"),
        F.lit(run_id).alias("run_id"),
    )


def quarantine(df: DataFrame, path: str, reason: str, run_id: str, rule_column: str | None = None) -> None:
    """Append the rows as JSON lines under ``path``, one partition folder per run."""
    rows = quarantine_rows(df, reason, run_id, rule_column)
    rows.write.mode("append").option("ignoreNullFields", False).partitionBy("run_id").json(path)


def read_quarantine(
    spark: SparkSession, path: str, schema: StructType, run_id: str | None = None
) -> DataFrame:
    """Quarantined rows; ``schema`` is that of the source rows. A run id prunes to one folder."""
    added = [StructField(c, TimestampType() if c == "quarantined_at" else StringType()) for c in ADDED]
    rows = spark.read.schema(StructType([*schema.fields, *added])).json(path)
    return rows.filter(F.col("run_id") == run_id) if run_id else rows


def replay(
    quarantined: DataFrame,
    correct: Callable[[DataFrame], DataFrame],
    rules: Iterable[Rule],
    target: DataFrame,
    keys: str | Iterable[str],
) -> tuple[DataFrame, DataFrame]:
    """Correct quarantined rows, check them again and upsert those that pass.

    Returns the merged target and the rows that still fail (with ``failed_rules``).
    """
    fixed = correct(quarantined.drop(*ADDED))
    valid, failing = split_by_rules(fixed, rules)
    return merge(valid, target, names(keys)), failing
