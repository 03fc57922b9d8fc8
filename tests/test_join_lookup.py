from __future__ import annotations

from importlib import import_module

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemill.operators import join, lookup

joins = import_module("tidemill.operators.join")


@pytest.fixture(scope="module", autouse=True)
def no_broadcast(spark):
    """Tiny frames would all be broadcast, and have no hot keys: the split form of outer joins would never be used."""
    before, rows_before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), joins.HOT_ROWS
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    joins.HOT_ROWS = 0
    yield
    joins.HOT_ROWS = rows_before
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


LEFT = [("a", 1), ("a", 2), ("b", 3), (None, 4)]
RIGHT = [("a", "x"), ("a", "y"), ("c", "z"), (None, "n")]


def left(spark, data=LEFT):
    return spark.createDataFrame(data, "k string, n int")


def right(spark, data=RIGHT):
    return spark.createDataFrame(data, "k string, s string")


def brute(how, a, b, null_safe=False):
    def same(x, y):
        return x == y and (null_safe or x is not None)

    if how == "semi":
        return [x for x in a if any(same(x[0], y[0]) for y in b)]
    if how == "anti":
        return [x for x in a if not any(same(x[0], y[0]) for y in b)]
    out = [(*x, y[1]) for x in a for y in b if same(x[0], y[0])]
    if how in ("left", "full"):
        out += [(*x, None) for x in a if not any(same(x[0], y[0]) for y in b)]
    if how in ("right", "full"):
        out += [(y[0], None, y[1]) for y in b if not any(same(x[0], y[0]) for x in a)]
    return out


@pytest.mark.parametrize("how", ["inner", "left", "right", "full", "semi", "anti"])
@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("split", [True, False])
def test_shared_key(spark, how, null_safe, split):
    got = join(left(spark), right(spark), "k", how, null_safe=null_safe, split_outer=split)
    assert rows(got) == sorted(brute(how, LEFT, RIGHT, null_safe), key=repr)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(0, 3)), max_size=8),
    st.lists(st.tuples(st.sampled_from(["a", "b", "d", None]), st.sampled_from("xy")), max_size=8),
    st.sampled_from(["left", "right", "full"]),
)
def test_split_outer_matches_brute_force(spark, a, b, how):
    got = join(left(spark, a), right(spark, b), ["k"], how)
    assert rows(got) == sorted(brute(how, a, b), key=repr)


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
@pytest.mark.parametrize("test", ["l.k = r.k", "r.k == l.k", "l.k = r.k AND length(r.s) > 0"])
@pytest.mark.parametrize("split", [True, False])
def test_expression_keeps_both_keys(spark, how, test, split):
    got = join(left(spark), right(spark), test, how, left_id="l", right_id="r", split_outer=split)
    assert got.columns == ["k", "n", "r_k", "s"]
    native = left(spark).alias("l").join(right(spark).alias("r"), on=_native("l.k = r.k"), how=how)
    assert rows(got) == rows(native)


def _native(text):
    from pyspark.sql import functions as F

    return F.expr(text)


def test_outer_with_residual_condition(spark):
    test = "l.k = r.k AND l.n > 1"
    got = join(left(spark), right(spark), test, "full", left_id="l", right_id="r")
    native = left(spark).alias("l").join(right(spark).alias("r"), on=_native(test), how="full")
    assert rows(got) == rows(native)


def test_self_join_and_select(spark):
    df = left(spark)
    got = join(df, df, "p.k = q.k", left_id="p", right_id="q", select=["p.n AS a", "q.n AS b"])
    assert rows(got) == [(1, 1), (1, 2), (2, 1), (2, 2), (3, 3)]


@pytest.mark.parametrize("how", ["inner", "left", "right", "full", "semi", "anti"])
@pytest.mark.parametrize("test", ["l.k = r.k", "l.k = r.k AND l.n < 2"])
def test_select_names_both_sides(spark, how, test):
    wanted = ["l.n + 1 AS m", "l.k"] + ([] if how in ("semi", "anti") else ["coalesce(r.k, l.k) AS key", "upper(r.s) AS s"])
    got = join(left(spark), right(spark), test, how, left_id="l", right_id="r", select=wanted)
    kind = {"semi": "left_semi", "anti": "left_anti"}.get(how, how)
    native = left(spark).alias("l").join(right(spark).alias("r"), on=_native(test), how=kind).selectExpr(*wanted)
    assert got.columns == native.columns
    assert rows(got) == rows(native)


def test_clashing_name_is_qualified(spark):
    other = spark.createDataFrame([("a", 7)], "k string, n int")
    assert join(left(spark), other, "k", right_id="old").columns == ["k", "n", "old_n"]


def test_multi_key_using(spark):
    a = spark.createDataFrame([("a", 1, 10), ("a", 2, 20)], "k string, n int, v int")
    b = spark.createDataFrame([("a", 1, 5), ("b", 2, 6)], "k string, n int, w int")
    assert rows(join(a, b, "k, n", "full")) == sorted(
        [("a", 1, 10, 5), ("a", 2, 20, None), ("b", 2, None, 6)], key=repr
    )


@pytest.mark.parametrize("condition", [None, "", [], "l.n < r.n", "l.n <= r.n AND l.k <> r.k", "l.n != r.n", "l.k = r.k OR l.n = r.n",
    "l.k = r.k AND l.n = 1 OR l.n = r.n", "(l.k = r.k OR l.n = r.n) AND l.n > r.n", "l.k = 'a' AND l.n < r.n", "l.k = l.k AND l.n < r.n",
])
def test_condition_needs_an_equality(spark, condition):
    with pytest.raises(ValueError):
        join(left(spark), right(spark), condition, left_id="l", right_id="r")


@pytest.mark.parametrize("condition", ["upper(l.k) = upper(r.k)", "l.k <=> r.k AND (l.n > 1 OR r.s = 'x')", "l.n BETWEEN 1 AND 3 AND l.k == r.k"])
def test_equality_inside_larger_conditions(spark, condition):
    got = join(left(spark), right(spark), condition, left_id="l", right_id="r")
    assert rows(got) == rows(left(spark).alias("l").join(right(spark).alias("r"), on=_native(condition)))


@pytest.mark.parametrize("condition", ["NOT (l.k = r.k)", "l.k = r.k OR l.n = length(r.s)", "CASE WHEN l.k = r.k THEN true ELSE false END",
    "l.n < length(r.s)", "l.k = 'a' AND r.k = 'a'", "l.k <> 'x = y'", "l.k = l.k AND l.n < length(r.s)",
])
def test_no_cross_product_is_planned(spark, condition):
    for how in ("inner", "left", "full", "anti"):
        with pytest.raises(ValueError, match="equality"):
            join(left(spark), right(spark), condition, how, left_id="l", right_id="r")


@pytest.mark.parametrize("condition", ["l.k = r.k AND r.s <> 'this or that'", "(l.k = r.k) AND NOT (l.n = length(r.s))",
    "r.k = concat(l.k, '') AND CASE WHEN l.n = 1 OR r.s = 'x' THEN true ELSE false END",
])
def test_words_in_literals_do_not_matter(spark, condition):
    got = join(left(spark), right(spark), condition, left_id="l", right_id="r")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert rows(got) == rows(left(spark).alias("l").join(right(spark).alias("r"), on=F.expr(condition)).selectExpr("l.*", "r.k r_k", "r.s"))


def test_join_refuses(spark):
    with pytest.raises(ValueError):
        join(left(spark), right(spark), "k", "sideways")
    with pytest.raises(ValueError):
        join(left(spark), right(spark), "k", "cross")
    with pytest.raises(ValueError):
        join(left(spark), right(spark), "missing")


@pytest.mark.parametrize("how, split", [("left", False), ("right", False), ("full", True)])
def test_small_optional_side_is_broadcast_in_one_scan(spark, tmp_path, how, split):
    left(spark).write.parquet(f"{tmp_path}/l")
    right(spark).write.parquet(f"{tmp_path}/r")
    a, b = spark.read.parquet(f"{tmp_path}/l"), spark.read.parquet(f"{tmp_path}/r")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    try:
        got = join(a, b, "k", how)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert rows(got) == sorted(brute(how, LEFT, RIGHT), key=repr)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert ("Union" in plan) == split and "BroadcastHashJoin" in plan


@pytest.fixture
def shuffled(spark, tmp_path):
    """Both sides as tables, no broadcasts, plans as they are first made."""
    left(spark).write.parquet(f"{tmp_path}/l")
    right(spark).write.parquet(f"{tmp_path}/r")
    settings_ = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings_}
    for k, v in settings_.items():
        spark.conf.set(k, v)
    yield spark.read.parquet(f"{tmp_path}/l"), spark.read.parquet(f"{tmp_path}/r")
    for k, v in before.items():
        spark.conf.set(k, v)


def test_outer_join_reuses_the_exchange(shuffled):
    joined = join(*shuffled, "k", "full")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReusedExchange") == 2
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    assert rows(joined) == sorted(brute("full", LEFT, RIGHT), key=repr)


@pytest.mark.parametrize("how", ["left", "right", "full"])
def test_outer_join_without_hot_keys_is_native(shuffled, monkeypatch, how):
    monkeypatch.setattr(joins, "HOT_ROWS", 10_000)
    a, b = shuffled
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in (join(a, b, "k", how), a.join(b, "k", how))]
    for word in ("FileScan", "Exchange", "SortMergeJoin", "Union"):
        assert plans[0].count(word) == plans[1].count(word)


@pytest.mark.parametrize("how", ["left", "right", "full"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_hot_keys_change_no_result(shuffled, spark, how, null_safe):
    a, b = shuffled
    assert rows(join(a, b, "k", how, null_safe=null_safe)) == sorted(brute(how, LEFT, RIGHT, null_safe), key=repr)
    # Keys of two types, two columns, nulls in either, a hot key on both sides, an inequality beside the equality.
    left_rows = [(1, "x", i) for i in range(30)] + [(None, "x", 100), (1, None, 101), (2, "y", 102), (3, "z", 103)] + [(None, None, i) for i in range(20)]
    right_rows = [(1, "x", i) for i in range(0, 60, 5)] + [(2, "y", 0), (2, "y", 500), (None, "x", 1), (9, "z", 2)] + [(None, None, 7)] * 9
    wide = spark.createDataFrame(left_rows, "k int, g string, n int"), spark.createDataFrame(right_rows, "k long, g string, m int")
    assert joins.hot_keys(wide[0], [F.col("k"), F.col("g")], null_safe)
    a, b = wide[0].alias("l"), wide[1].alias("r")
    same = F.col("l.k").eqNullSafe(F.col("r.k")) & F.col("l.g").eqNullSafe(F.col("r.g")) if null_safe else F.expr("l.k = r.k AND l.g = r.g")
    for text, on in (("l.k = r.k AND l.g = r.g", same), ("l.k = r.k AND l.g = r.g AND l.n < r.m", same & F.expr("l.n < r.m"))):
        if null_safe and "<" in text:
            continue
        got = join(*wide, text, how, left_id="l", right_id="r", null_safe=null_safe)
        assert rows(got) == rows(a.join(b, on, how))
        picked = join(*wide, text, how, left_id="l", right_id="r", null_safe=null_safe, select=["l.n AS n", "coalesce(r.m, -1) AS m"])
        assert rows(picked) == rows(a.join(b, on, how).selectExpr("l.n AS n", "coalesce(r.m, -1) AS m"))


def test_grouped_sides_are_spread(spark):
    counted = right(spark).groupBy("k").count()
    got = join(left(spark), counted, "k", "full", right_id="c", grouped="c")
    assert rows(got) == rows(join(left(spark), counted, "k", "full", split_outer=False))
    found = lookup(left(spark), counted, "k", "count", grouped=True)
    assert "REBALANCE" in found._jdf.queryExecution().executedPlan().toString()
    assert rows(found) == rows(lookup(left(spark), counted, "k", "count"))
    with pytest.raises(ValueError, match="grouped"):
        join(left(spark), counted, "k", grouped="nobody")


# --- lookup ----------------------------------------------------------------------------


def ref(spark):
    return spark.createDataFrame([("a", "Alpha", 1), ("c", "Gamma", 3)], "k string, name string, n int")


def test_lookup_left_and_inner(spark):
    expected = [("a", 1, "Alpha"), ("a", 2, "Alpha"), ("b", 3, None), (None, 4, None)]
    assert rows(lookup(left(spark), ref(spark), "k", "name")) == sorted(expected, key=repr)
    assert rows(lookup(left(spark), ref(spark), "k", "name", "inner")) == expected[:2]


def test_lookup_without_fields_filters_and_fans_out(spark):
    twice = spark.createDataFrame([("a",), ("a",)], "k string")
    assert rows(lookup(left(spark), twice, "k", "", "inner")) == [("a", 1), ("a", 1), ("a", 2), ("a", 2)]
    assert lookup(left(spark), ref(spark), "k", None).columns == ["k", "n"]


@pytest.mark.parametrize("limit, hinted", [(100, True), (1, False)])
def test_broadcast_only_within_its_bound(spark, limit, hinted):
    out = lookup(left(spark), ref(spark), "k", "name", broadcast=True, broadcast_rows=limit)
    logical = out._jdf.queryExecution().logical().toString()
    assert ("ResolvedHint" in logical or "UnresolvedHint" in logical) == hinted
    assert rows(out) == rows(lookup(left(spark), ref(spark), "k", "name"))


def test_lookup_refuses(spark):
    with pytest.raises(ValueError, match="missing"):
        lookup(left(spark), ref(spark), "k", "missing")
    assert lookup(left(spark), ref(spark), "k", "missing,name", ignore_missing=True).columns == ["k", "n", "name"]
    with pytest.raises(ValueError, match="prefix"):
        lookup(left(spark), ref(spark), "k", "n")
    assert lookup(left(spark), ref(spark), "k", "n", prefix="ref_").columns == ["k", "n", "ref_n"]
    with pytest.raises(ValueError, match="repeats"):
        lookup(left(spark), right(spark), "k", "s", unique=True)
    with pytest.raises(ValueError):
        lookup(left(spark), ref(spark), "k", "name", "full")


def test_select_expressions_split_outside_parentheses():
    from tidemill.functions import expressions

    assert expressions("l.a, coalesce(l.v, r.w) AS z, 'x, y' AS t") == ["l.a", "coalesce(l.v, r.w) AS z", "'x, y' AS t"]
    assert expressions(["coalesce(a, b)"]) == ["coalesce(a, b)"] and expressions(None) == []


def test_broadcast_is_bounded_by_rows_and_bytes(spark):
    from tidemill.functions import broadcast_if_small

    wide = spark.range(100).select("id", F.repeat(F.lit("x"), 1000).alias("t"), F.array(F.lit("y")).alias("a"), F.lit(None).cast("string").alias("n"))
    assert broadcast_if_small(wide)[1] and broadcast_if_small(wide.limit(0))[1]
    assert not broadcast_if_small(wide, limit=99)[1]
    assert not broadcast_if_small(wide, max_bytes=100_000)[1]
