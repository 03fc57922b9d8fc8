from __future__ import annotations

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemill.operators import deduplicate, golden_record, merge, sort

DDL = "k string, t int, v string"
DATA = [("a", 1, "a1"), ("a", 3, "a3"), ("a", 3, "a3x"), ("b", None, "b0"), ("b", 2, "b2"), (None, 5, "n5"), (None, 4, "n4")]


def frame(spark, data=DATA):
    return spark.createDataFrame(data, DDL)


@pytest.mark.parametrize(
    "keep, expected",
    [
        ("latest", [("a", 3, "a3x"), ("b", 2, "b2"), (None, 5, "n5")]),
        ("last", [("a", 3, "a3x"), ("b", 2, "b2"), (None, 5, "n5")]),
        ("earliest", [("a", 1, "a1"), ("b", None, "b0"), (None, 4, "n4")]),
        ("first", [("a", 1, "a1"), ("b", None, "b0"), (None, 4, "n4")]),
    ],
)
def test_keep_by_order(spark, keep, expected):
    assert rows(deduplicate(frame(spark), "k", keep, "t", "v")) == sorted(expected, key=repr)


def test_any_gives_one_row_per_key(spark):
    kept = deduplicate(frame(spark), ["k"])
    assert rows(kept.select("k")) == sorted([("a",), ("b",), (None,)], key=repr)
    assert set(rows(kept)) <= set(DATA)


def test_no_keys_is_whole_row_distinct(spark):
    assert len(rows(deduplicate(frame(spark, DATA + DATA), []))) == len(DATA)


def test_empty_and_single(spark):
    assert rows(deduplicate(frame(spark, []), "k", "latest", "t")) == []
    assert rows(deduplicate(frame(spark, DATA[:1]), "k", "latest", "t")) == DATA[:1]


@pytest.mark.parametrize("keep, order", [("latest", None), ("first", None), ("newest", "t")])
def test_dedup_refuses(spark, keep, order):
    with pytest.raises(ValueError):
        deduplicate(frame(spark), "k", keep, order)


def test_dedup_unknown_column(spark):
    with pytest.raises(ValueError, match="nope"):
        deduplicate(frame(spark), "nope")


def test_group_limit_runs_before_the_exchange(spark):
    plan = deduplicate(frame(spark), "k", "latest", "t")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_golden_record_takes_newest_value_present(spark):
    data = [("a", 1, "x", 10), ("a", 2, None, 20), ("a", 3, "z", None), ("b", 1, None, None)]
    df = spark.createDataFrame(data, "k string, t int, p string, q int")
    assert rows(golden_record(df, "k", "t", "p,q")) == [("a", "z", 20), ("b", None, None)]


def test_sort_directions_and_nulls(spark):
    def order(**how):
        return [r.v for r in sort(frame(spark), **how).collect()]

    assert order(order_by="t,v") == ["b0", "a1", "b2", "a3", "a3x", "n4", "n5"]
    assert order(order_by="t,v", nulls="last")[-1] == "b0"
    assert order(order_by="t,v", direction="desc") == ["n5", "n4", "a3x", "a3", "b2", "a1", "b0"]
    assert order(order_by="t,v", direction="desc,asc", nulls="first") == ["b0", "n5", "n4", "a3", "a3x", "b2", "a1"]


def test_sort_is_total_over_many_partitions_with_a_hot_value(spark):
    df = spark.range(0, 20000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 100).alias("x"), "id"
    )
    out = sort(df, "x")
    assert out.columns == ["x", "id"]
    got = [r.x for r in out.collect()]
    assert got == sorted(got) and len(got) == 20000
    # Without coalescing of the small test partitions, the hot value fills several tasks.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = out.withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert [r.x for r in placed] == got
    assert len({r.task for r in placed if r.x == 7}) > 1


@pytest.mark.parametrize("how", [{"direction": "up"}, {"nulls": "middle"}, {"direction": "asc,desc,asc"}])
def test_sort_refuses(spark, how):
    with pytest.raises(ValueError):
        sort(frame(spark), "t,v", **how)


def test_merge_source_wins(spark):
    source = frame(spark, [("a", 9, "new"), (None, 9, "newnull"), ("c", 9, "c")])
    target = frame(spark, [("a", 1, "old"), ("b", 1, "b"), ("b", 2, "b2"), (None, 1, "oldnull")])
    assert rows(merge(source, target, "k", "t")) == sorted(
        [("a", 9, "new"), ("b", 2, "b2"), ("c", 9, "c"), (None, 9, "newnull")], key=repr
    )


def test_merge_into_a_unique_target_does_not_shuffle_it(spark, tmp_path):
    spark.range(1000).select(F.col("id").alias("k"), F.lit("old").alias("v")).write.parquet(f"{tmp_path}/t")
    target = spark.read.parquet(f"{tmp_path}/t")
    changes = spark.createDataFrame([(3, "new"), (3, "newer"), (5000, "new")], "k bigint, v string")
    changes.write.parquet(f"{tmp_path}/s")
    source = spark.read.parquet(f"{tmp_path}/s")
    merged = merge(source, target, "k", "v", target_unique=True)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    kept = plan[plan.index("LeftAnti"):]
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in kept.split("BroadcastExchange")[0]
    assert merged.count() == 1001 and rows(merged.filter("v <> 'old'")) == [(3, "newer"), (5000, "new")]


def test_merge_without_keys_keeps_duplicates_and_fills_columns(spark):
    source = frame(spark, DATA[:1])
    target = spark.createDataFrame([("a", 1.5)], "k string, w double")
    merged = merge(source, target)
    assert merged.columns == ["k", "t", "v", "w"]
    assert rows(merged) == sorted([("a", 1, "a1", None), ("a", None, None, 1.5)], key=repr)
    assert len(rows(merge(source, source))) == 2


def test_merge_without_target(spark):
    assert rows(merge(frame(spark), None, "k")) == rows(frame(spark))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 5), st.sampled_from("xyz")), max_size=12),
    st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(0, 5), st.sampled_from("xyz")), max_size=12),
)
def test_merge_matches_brute_force(spark, source, target):
    expected = {}
    for side in (target, source):
        best = {}
        for k, t, v in side:
            best[k] = max(best.get(k, (-1, "")), (t, v))
        expected.update(best)
    expected = sorted(((k, t, v) for k, (t, v) in expected.items()), key=repr)
    assert rows(merge(frame(spark, source), frame(spark, target), "k", "t,v")) == expected
    unique = deduplicate(frame(spark, target), "k", "latest", "t,v")
    assert rows(merge(frame(spark, source), unique, "k", "t,v", target_unique=True)) == expected


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 3), st.sampled_from("xyz")), max_size=10),
    st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(0, 3), st.sampled_from("uvw")), max_size=10),
)
def test_newest_wins_across_both_sides(spark, source, target):
    best = {}
    for side, data in ((0, target), (1, source)):
        for k, t, v in data:
            best[k] = max(best.get(k, (-1, -1, "")), (t, side, v))
    best = sorted(((k, t, side) for k, (t, side, _) in best.items()), key=repr)
    unique = deduplicate(frame(spark, target), "k", "latest", "t,v")
    for old, unique_target in ((frame(spark, target), False), (unique, True)):
        got = merge(frame(spark, source), old, "k", "t", target_unique=unique_target, newest_wins=True)
        assert sorted(((k, t, int(v in "xyz")) for k, t, v in got.collect()), key=repr) == best


def test_newest_wins_needs_an_order(spark):
    with pytest.raises(ValueError):
        merge(frame(spark), frame(spark), "k", newest_wins=True)
