from __future__ import annotations

import pytest
from conftest import rows

from tidemill.quality import (
    Check,
    NotNull,
    Range,
    Unique,
    evaluate_rules,
    fx_reconcile,
    quarantine,
    read_quarantine,
    replay,
    scorecard,
    split_by_rules,
)

NAN = float("nan")
DATA = [(1, "a", 0.0), (2, None, 10.0), (2, None, 10.5), (None, "b", NAN), (None, "b", None)]


def frame(spark, data=DATA):
    return spark.createDataFrame(data, "k int, s string, x double")


def verdicts(df):
    return [tuple(r) for r in df.collect()]


def test_engine_runs_all_rules_in_order(spark):
    rules = [
        NotNull("filled", ["k", "s", "x"]),
        Unique("once", ["k"]),
        Range("bounds", "x", 0, 10),
        Range("floor", "x", min_value=0),
        Check("known", "s IN ('a', 'b')"),
        NotNull("none", []),
    ]
    assert verdicts(evaluate_rules(frame(spark), rules)) == [
        ("filled", False, 6, "Null values detected: {'k': 2, 's': 2, 'x': 2}"),
        ("once", False, 2, "Duplicate rows detected: 2"),
        ("bounds", False, 1, "Range violations detected: 1 rows"),
        ("floor", True, 0, ""),
        ("known", True, 0, ""),
        ("none", True, 0, ""),
    ]


def test_long_texts_are_counted_whole(spark):
    import hashlib

    long = "x" * 200
    texts = [long, long, long + "y", "x" * 64, "x" * 64, None, None, "#" + hashlib.sha256(long.encode()).hexdigest()]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    assert verdicts(evaluate_rules(df, [Unique("once", ["s"])])) == [("once", False, 3, "Duplicate rows detected: 3")]


def test_rules_on_an_empty_table(spark):
    rules = [NotNull("a", ["k"]), Unique("b", ["k"]), Range("c", "x", 0, 1)]
    assert [r[1:3] for r in verdicts(evaluate_rules(frame(spark, []), rules))] == [(True, 0)] * 3


def test_rules_refuse_unknown_columns(spark):
    for rule in (NotNull("a", ["nope"]), Unique("a", ["nope"]), Range("a", "nope", 0)):
        with pytest.raises(ValueError, match="nope"):
            evaluate_rules(frame(spark), [rule])
    with pytest.raises(ValueError):
        evaluate_rules(frame(spark), [])


def test_split_is_complete_and_disjoint(spark):
    rules = [NotNull("filled", ["k"]), Range("bounds", "x", 1, 10)]
    valid, rejected = split_by_rules(frame(spark), rules)
    assert rows(valid) == [(2, None, 10.0)]
    assert sorted(r.failed_rules for r in rejected.collect()) == ["bounds", "bounds", "filled", "filled"]
    with pytest.raises(ValueError, match="uniqueness"):
        split_by_rules(frame(spark), [Unique("once", ["k"])])


def test_split_needs_no_shuffle(spark):
    valid, rejected = split_by_rules(frame(spark), [Range("bounds", "x", 1, 10)])
    for df in (valid, rejected):
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_scorecard(spark):
    got = scorecard(frame(spark), [NotNull("filled", ["k"]), Range("bounds", "x", 1, 10)], "s")
    assert rows(got) == sorted(
        [("a", "bounds", 1, 1, 0.0), ("a", "filled", 1, 0, 1.0), ("b", "bounds", 2, 0, 1.0), ("b", "filled", 2, 2, 0.0),
         (None, "bounds", 2, 1, 0.5), (None, "filled", 2, 0, 1.0)],
        key=repr,
    )


def test_quarantine_and_replay(spark, tmp_path):
    df = spark.createDataFrame([(1, -5.0), (2, 5.0), (3, None)], "id int, x double")
    rules = [Range("positive", "x", 0), NotNull("present", ["x"])]
    valid, rejected = split_by_rules(df, rules)
    quarantine(rejected, str(tmp_path / "q"), "bad values", "run-1", "failed_rules")
    quarantine(df.limit(0), str(tmp_path / "q"), "other", "run-2")
    held = read_quarantine(spark, str(tmp_path / "q"), df.schema, "run-1")
    assert rows(held.select("id", "x", "reason", "rule_id", "run_id")) == [
        (1, -5.0, "bad values", "positive", "run-1"), (3, None, "bad values", "present", "run-1")
    ]
    merged, failing = replay(held, lambda d: d.withColumn("x", -d.x), rules, valid, "id")
    assert rows(merged) == [(1, 5.0), (2, 5.0)]
    assert rows(failing) == [(3, None, "present")]
    with pytest.raises(ValueError):
        quarantine(held, str(tmp_path / "q2"), "again", "run-3")


def test_fx(spark):
    data = [
        ("USD", "USD", "7000000001.00009", "7000000001.00009"),
        ("USD", "GBP", "1234567890.11111", "1481481468.13333"),
        ("USD", "EUR", "90000000000.00002", "135000000000.00003"),
        ("GBP", "EUR", "10.00000", "9.00200"),
        ("EUR", "USD", "1.00000", "1.00000"),
    ]
    df = spark.createDataFrame(data, "txn_ccy string, base_ccy string, txn_amt string, base_amt string")
    assert [r.reconciled for r in fx_reconcile(df).collect()] == [True, True, True, False, False]
