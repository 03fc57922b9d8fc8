from __future__ import annotations

import hashlib
import math
import statistics
from collections import Counter
from datetime import date, timedelta
from decimal import Decimal

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemill.functions import round_binary
from tidemill.operators import (
    aggregate,
    aggregate_levels,
    aggregate_rolling,
    aggregate_window,
    detokenize,
    mask,
    record_hash,
    token_vault,
    unmask,
)
from tidemill.operators import ranks

DATA = [("a", 1.0), ("a", None), ("b", None), (None, 2.0), (None, 4.0)]


def frame(spark, data=DATA):
    return spark.createDataFrame(data, "g string, x double")


def test_count_star_count_column_and_null_group(spark):
    got = rows(aggregate(frame(spark), "g", "count:*,count:x,sum:x"))
    assert got == sorted([("a", 2, 1, 1.0), ("b", 1, 0, None), (None, 2, 2, 6.0)], key=repr)


def test_names_follow_func_and_column(spark):
    assert aggregate(frame(spark), "g", "count,max:x").columns == ["g", "count_rows", "max_x"]


def test_global_and_empty(spark):
    assert rows(aggregate(frame(spark), None, "count:*,avg:x")) == [(5, 7 / 3)]
    assert rows(aggregate(frame(spark, []), "", "count:*,sum:x,median:x")) == [(0, None, None)]
    assert rows(aggregate(frame(spark, []), "g", "count:*")) == []


@pytest.mark.parametrize("metrics", ["", "sum", "explode:x", "sum:*", "max:nope"])
def test_aggregate_refuses(spark, metrics):
    with pytest.raises(ValueError):
        aggregate(frame(spark), "g", metrics)


def test_collecting_needs_room(spark):
    got = rows(aggregate(frame(spark), "g", "collect_set:x", max_items=2).select("g", F.sort_array("collect_set_x")))
    assert got == sorted([("a", [1.0]), ("b", []), (None, [2.0, 4.0])], key=repr)
    with pytest.raises(ValueError, match="max_items"):
        aggregate(frame(spark), "g", "collect_list:x", max_items=1)
    copies = frame(spark, [("a", 1.0)] * 5 + [("b", None)])
    assert rows(aggregate(copies, "g", "listagg_distinct:x", max_items=1)) == [("a", "1.0"), ("b", None)]
    assert rows(aggregate(copies, "g", "listagg:x", max_items=5)) == [("a", "1.0,1.0,1.0,1.0,1.0"), ("b", None)]


@settings(max_examples=16, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(-4, 4).map(float))), max_size=25),
    st.sampled_from([0, 5, 100]),
)
def test_median_and_mode_match_brute_force(spark, data, band):
    ranks.BAND, kept = band, ranks.BAND
    try:
        _check_median_and_mode(spark, data)
    finally:
        ranks.BAND = kept


def _check_median_and_mode(spark, data):
    groups = {}
    for g, x in data:
        groups.setdefault(g, []).append(x)
    expected = []
    for g, xs in groups.items():
        xs = [x for x in xs if x is not None]
        counts = Counter(xs)
        top = min(counts, key=lambda x: (-counts[x], x)) if xs else None
        expected.append((g, len(groups[g]), statistics.median(xs) if xs else None, top))
    got = rows(aggregate(frame(spark, data), "g", "count:*,median:x,mode:x"))
    assert got == sorted(expected, key=repr)


@pytest.mark.parametrize("band", [0, 3, 10**9])
def test_median_of_a_large_hot_group(spark, monkeypatch, band):
    monkeypatch.setattr("tidemill.operators.ranks.BAND", band)
    df = spark.range(0, 30001).select(
        F.when(F.col("id") % 3 < 2, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 50)).alias("g"),
        F.pmod(F.hash("id"), F.lit(9973)).cast("double").alias("x"),
    )
    exact = df.groupBy("g").agg(F.median("x").alias("m"))
    assert rows(aggregate(df, "g", "median:x")) == rows(exact)
    whole = df.agg(F.median("x")).first()[0]
    assert rows(aggregate(df, None, "median:x")) == [(whole,)]


@pytest.mark.parametrize("band", [0, 7, 10**9])
@pytest.mark.parametrize("broadcast", [True, False])
def test_percentiles_keep_their_type(spark, monkeypatch, band, broadcast):
    monkeypatch.setattr(ranks, "BAND", band)
    monkeypatch.setattr(ranks, "MARGIN", 0.2)  # wide enough for a narrowing at this size
    if not broadcast:
        monkeypatch.setattr(ranks, "fits_broadcast", lambda df: False)
    start = date(2000, 1, 1)
    data = []
    for i in range(400):
        k = i * 7919 % 401
        day, cents = start + timedelta(days=k // 3), Decimal(k).scaleb(-2)
        data.append(("ab"[i % 2], 2**53 + 1 + k, 2**62 + k % 9, cents, day, float("nan") if k % 50 == 0 else k / 8))
    data += [("b", None, None, None, None, None), (None, None, None, None, None, None)]
    df = spark.createDataFrame(data, "g string, wide long, tied long, price decimal(20,2), day date, rough double")
    for name in df.columns[1:]:
        got = ranks.percentiles(df, ["g"], F.col(name), {"low": 0.0, "p33": 0.33, "top": 1.0})
        assert got.schema["p33"].dataType == df.schema[name].dataType
        found = {r.g: (r.low, r.p33, r.top) for r in got.collect()}
        assert found.pop(None) == (None, None, None)
        for g in "ab":
            own = [r[df.columns.index(name)] for r in data if r[0] == g and r[df.columns.index(name)] is not None]
            own.sort(key=lambda x: (x != x, x))
            want = tuple(own[max(math.ceil(len(own) * p), 1) - 1] for p in (0.0, 0.33, 1.0))
            assert repr(found[g]) == repr(want)
    whole = ranks.percentiles(df, [], F.col("wide"), {"p50": 0.5}).collect()
    assert [r.p50 for r in whole] == [sorted(r[1] for r in data if r[1] is not None)[199]]
    assert ranks.percentiles(df.filter("wide < 0"), ["g"], F.col("wide"), {"p50": 0.5}).collect() == []
    with pytest.raises(ValueError, match="numbers"):
        ranks.percentiles(df, [], F.col("g"), {"p50": 0.5})


def test_levels(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "x", 3)], "p string, q string, n int")
    got = rows(aggregate_levels(df, "sum:n", rollup="p,q", level="level"))
    assert got == sorted(
        [("a", "x", 0, 1), ("a", "y", 0, 2), ("b", "x", 0, 3), ("a", None, 1, 3), ("b", None, 1, 3), (None, None, 3, 6)],
        key=repr,
    )
    assert len(rows(aggregate_levels(df, "count", cube="p,q"))) == 8
    assert len(rows(aggregate_levels(df, "count", sets=[["p"], ["q"], []]))) == 5
    with pytest.raises(ValueError):
        aggregate_levels(df, "count", rollup="p", cube="q")
    with pytest.raises(ValueError):
        aggregate_levels(df, "median:n", rollup="p")


def times(spark):
    data = [("a", "2024-01-01 10:00:00", 1.0), ("a", "2024-01-03 23:59:59", 2.0), ("a", "2024-01-08 00:00:00", 4.0), ("b", "2024-01-07 12:00:00", None)]
    return spark.createDataFrame(data, "g string, t string, x double").withColumn("t", F.to_timestamp("t"))


def test_windows(spark):
    weekly = aggregate_window(times(spark), "t", "weekly", "g", "sum:x").withColumn("window_start", F.to_date("window_start").cast("string"))
    assert rows(weekly) == sorted([("a", "2024-01-01", 3.0), ("a", "2024-01-08", 4.0), ("b", "2024-01-01", None)], key=repr)
    daily = aggregate_window(times(spark), "t", "daily", None, "count:*")
    assert [r[1] for r in rows(daily)] == [1, 1, 1, 1]


def test_rolling(spark):
    got = aggregate_rolling(times(spark), "t", 6, "g", "count:*,sum:x,avg:x,min:x").withColumn("day", F.col("day").cast("string"))
    assert rows(got) == sorted(
        [
            ("a", "2024-01-01", 1, 1.0, 1.0, 1.0),
            ("a", "2024-01-03", 2, 3.0, 1.5, 1.0),
            ("a", "2024-01-08", 2, 6.0, 3.0, 2.0),
            ("b", "2024-01-07", 1, None, None, None),
        ],
        key=repr,
    )
    with pytest.raises(ValueError):
        aggregate_rolling(times(spark), "t", 3, "g", "stddev:x")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def people(spark):
    return spark.createDataFrame([(1, "Ann", 5), (2, None, 6)], "id int, name string, n int")


def test_mask_strategies(spark):
    assert rows(mask(people(spark), "id,name")) == sorted([(sha("1"), sha("Ann"), 5), (sha("2"), None, 6)], key=repr)
    assert rows(mask(people(spark), "name", "tokenize")) == rows(mask(people(spark), "name", "hash"))
    assert rows(mask(people(spark), "name", "tokenize", salt="s").select("name")) == sorted([(sha("sAnn"),), (None,)], key=repr)
    assert rows(mask(people(spark), "id,name", "redact")) == [("***", "***", 5), ("***", "***", 6)]
    assert mask(people(spark), "name", "redact").columns == ["id", "name", "n"]


def test_mask_refuses(spark):
    with pytest.raises(ValueError):
        mask(people(spark), "nam")
    with pytest.raises(ValueError):
        mask(people(spark), "name", "blur")
    with pytest.raises(ValueError):
        mask(people(spark), "name", "encrypt")


def test_reversible_masks(spark):
    key = "0123456789abcdef"
    hidden = mask(people(spark), "name", "encrypt", key=key)
    assert "Ann" not in [r.name for r in hidden.collect()]
    assert rows(unmask(hidden, "name", key)) == rows(people(spark))
    vault = token_vault(people(spark), "name", "s")
    assert rows(detokenize(mask(people(spark), "name", "tokenize", salt="s"), "name", vault)) == rows(people(spark))


def test_record_hash_depends_on_every_column(spark):
    hashed = record_hash(people(spark)).collect()
    assert len({r.record_hash for r in hashed}) == 2
    assert hashed[0].record_hash == sha('{"id":1,"name":"Ann","n":5}')


def test_round_binary_is_pythons_round(spark):
    df = spark.range(0, 60001, 7).select((F.col("id") / 600).alias("x"))
    df = df.union(spark.range(300, 6_000_000, 600).select((F.col("id") / 60000).alias("x")))
    got = df.select("x", round_binary(F.col("x"), 2).alias("r")).collect()
    assert [(r.x, r.r) for r in got if r.r != round(r.x, 2)] == []
