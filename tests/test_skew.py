"""A third of the rows under one key: no operator may leave them to one task."""

from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemill.operators import aggregate, deduplicate, join, lookup, merge

N = 60_000
SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    "spark.sql.shuffle.partitions": "12",
}


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("skew"))
    ids = spark.range(0, N, numPartitions=8)
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.pmod(F.hash("id"), F.lit(900)) + 100)
    ids.select(key.alias("k"), "id", F.sha2(F.col("id").cast("string"), 256).alias("p")).write.parquet(f"{root}/fact")
    spark.range(0, 600).select(F.col("id").cast("int").alias("k"), F.concat(F.lit("n"), "id").alias("name")).write.parquet(f"{root}/dim")
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield spark.read.parquet(f"{root}/fact"), spark.read.parquet(f"{root}/dim")
    for k, v in before.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def final_plan(df):
    """Rows and the plan as adaptive execution left it."""
    found = rows(df)
    return found, df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("how", ["inner", "left", "right", "full", "semi", "anti"])
@pytest.mark.parametrize("hot_side", ["left", "right"])
def test_joins_split_the_hot_key(tables, how, hot_side):
    fact, dim = tables
    a, b = (fact, dim) if hot_side == "left" else (dim, fact)
    if hot_side == "right" and how in ("semi", "anti"):
        b = b.select("k", "id")
    found, plan = final_plan(join(a, b, "k", how))
    if hot_side == "left" or how not in ("semi", "anti"):
        assert "skew=true" in plan
    native = rows(a.join(b, "k", {"semi": "left_semi", "anti": "left_anti"}.get(how, how)).select(*_columns(a, b, how)))
    assert found == native


def _columns(a, b, how):
    return a.columns if how in ("semi", "anti") else [*a.columns, *[c for c in b.columns if c != "k"]]


def test_lookup_splits_the_hot_key_next_to_a_grouped_reference(tables):
    fact, _ = tables
    best = aggregate(fact, "k", "max:id")
    found, plan = final_plan(lookup(fact, best, "k", "max_id", grouped=True))
    assert "skew=true" in plan and len(found) == N


def test_hot_copies_collapse_before_they_move(tables):
    fact, _ = tables
    for df in (
        deduplicate(fact, "k", "latest", "id"),
        deduplicate(fact.select("k"), []),
        merge(fact.filter("id < 100"), fact, "k", "id"),
        aggregate(fact, "k", "count:*,max:p"),
    ):
        plan = df._jdf.queryExecution().executedPlan().toString()
        moved = plan.split("Exchange hashpartitioning", 1)[1]
        assert "Partial" in moved or "partial_" in moved or "HashAggregate(keys=[k" in moved
