from __future__ import annotations

import json
import os
import subprocess
import sys
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemill.plans import (
    STEPS,
    check_flow,
    check_inputs,
    custom_step,
    daily_runs,
    failure_reasons,
    file_inventory,
    filter_inventory,
    filter_runs,
    inventory_summary,
    inventory_totals,
    latency_percentiles,
    latest_runs,
    read_run_logs,
    rows_processed,
    run_by_id,
    run_flow,
    run_history,
)
from tidemill.plans.flow import shared_steps
from tidemill.quality import Range, read_quarantine
from tidemill.sources import read_csv

# Readings of river gauges; one gauge sent its first reading twice with different levels.
READINGS = """R1|2031-05-01 06:00|2.50|upper
R1|2031-05-01 06:00|2.75|upper
R1|2031-05-01 18:00|3.00|upper
R2|2031-05-01 07:00|0.25|lower
R2|2031-05-02 07:00|0.75|lower
R9|2031-05-02 09:00|9.00|
"""
REACHES = [{"reach": "upper", "keeper": "Ada", "limit": 2.9}, {"reach": "lower", "keeper": "Ben", "limit": 0.5}]


@pytest.fixture
def home(tmp_path):
    (tmp_path / "feed").mkdir()
    (tmp_path / "ref").mkdir()
    (tmp_path / "feed" / "may.txt").write_text(READINGS)
    (tmp_path / "ref" / "reaches.json").write_text(json.dumps(REACHES))
    return tmp_path


def gauge_flow(home, **more):
    """Readings by day and keeper beside the alarms: a headless feed, a reduced set of columns, three targets."""
    return {
        "id": "gauges",
        "app": "rivers",
        "layer": "standardization",
        "sources": [
            {"id": "raw", "type": "csv", "path": f"{home}/feed/may.txt", "header": "false", "delimiter": "|",
             "schema": "gauge string, at timestamp_ntz, level double, reach string"},
            {"id": "readings", "type": "sql", "sql": "SELECT gauge, at, to_date(at) AS day, level, reach FROM {raw}"},
        ],
        "steps": [
            {"step": "aggregate", "source": "readings", "groupBy": "gauge,day,reach", "metrics": "max:level,count:*", "output": "days"},
            {"step": "lookup", "source": "days", "reference": "reaches", "joinColumns": "reach", "outputFields": "keeper,limit", "joinType": "inner"},
            {"step": "join", "left": "readings", "right": "days", "condition": "gauge,day", "type": "semi", "output": "watched"},
            {"step": "mask", "source": "days", "columns": "keeper"},
        ],
        "targets": [
            {"type": "table", "source": "watched", "path": f"{home}/lake/watched", "format": "orc", "partitionBy": "reach"},
            {"type": "hive", "source": "days", "table": "standardization.days"},
            {"type": "csv", "source": "days", "path": f"{home}/out/days", "delimiter": ";"},
        ],
        **more,
    }


def run(spark, home, flow, **more):
    return run_flow(
        spark, flow, {"run_id": "unit-test"}, data_root=f"{home}/data", reference_root=f"{home}/ref",
        logs_root=f"{home}/logs", quarantine_path=f"{home}/exceptions", **more,
    )


def test_flow_end_to_end(spark, home):
    done = run(spark, home, gauge_flow(home))
    assert done.run_id == "unit-test" and done.status == "completed"
    steps = {f"pipeline_transform_{name}": 1 for name in ("aggregate", "lookup", "join", "mask")}
    assert done.metrics == {"pipeline_source_loaded": 2, **steps, "pipeline_targets_written": 3, "rows_written": 5 + 3 + 3}
    watched = spark.read.orc(f"{home}/lake/watched")
    assert rows(watched.groupBy("reach").count()) == [("lower", 2), ("upper", 3)]
    days = spark.read.parquet(f"{home}/data/hive/standardization/days")
    assert rows(days.select("gauge", "max_level", "count_rows", "limit")) == [
        ("R1", 3.0, 3, 2.9), ("R2", 0.25, 1, 0.5), ("R2", 0.75, 1, 0.5),
    ]
    assert all(len(r.keeper) == 64 for r in days.collect())
    assert (home / "out" / "days").is_dir()
    assert rows(read_csv(spark, f"{home}/out/days", delimiter=";", schema=days.schema)) == rows(days)
    report = run_history(read_run_logs(spark, f"{home}/logs/applications", multi_line=False)).first()
    assert (report.run_id, report.pipeline_id, report.app_name, report.layer) == ("unit-test", "gauges", "rivers", "standardization")
    assert (report.rows_processed, report.status) == (11, "completed")


def test_failure_is_logged_and_raised(spark, home):
    flow = gauge_flow(home)
    flow["steps"][-1]["columns"] = "keeper,colour"
    with pytest.raises(ValueError, match="colour"):
        run(spark, home, flow)
    log = read_run_logs(spark, f"{home}/logs/applications", multi_line=False).first()
    assert log.status == "failed" and "colour" in log.error


def test_an_unwritable_log_does_not_fail_the_run(spark, home):
    (home / "logs").write_text("a file where the folder should be")
    assert run(spark, home, gauge_flow(home)).status == "completed"


def test_skip_and_quarantine_policies(spark, home):
    steps = [{"step": "deduplicate", "source": "readings", "keys": "serial"}]
    flow = gauge_flow(home, on_step_error="skip", steps=steps, targets=[])
    assert run(spark, home, flow).datasets["readings"].count() == 6
    run(spark, home, {**flow, "on_step_error": "quarantine"})
    held = spark.read.json(f"{home}/exceptions")
    assert held.count() == 6 and held.first().reason == "transformation_failure:deduplicate"


def test_record_policy_splits_sources(spark, home):
    flow = gauge_flow(home, record_rules={"readings": [Range("plausible", "level", max_value=5)]}, steps=[], targets=[])
    done = run(spark, home, flow)
    assert done.datasets["readings"].count() == 5 and done.metrics["rows_quarantined"] == 1
    assert {r.rule_id for r in spark.read.json(f"{home}/exceptions").collect()} == {"plausible"}


def test_join_sql_merge_and_custom_steps(spark, home):
    frame = lambda data, ddl: spark.createDataFrame(data, ddl)
    flow = {
        "id": "mix", "app": "a", "layer": "service",
        "sources": [
            {"id": "l", "type": "frame", "frame": frame([(1, "x"), (2, "y")], "id int, v string")},
            {"id": "r", "type": "frame", "frame": frame([(1, 9)], "key int, w int")},
            {"id": "recent", "type": "sql", "sql": "SELECT id, v FROM {l} WHERE id >= :from"},
        ],
        "steps": [
            {"step": "join", "left": "l", "right": "r", "type": "left", "condition": "l.id = r.key", "output": "joined"},
            {"step": "merge", "source": "recent", "target": "l", "keys": "id", "output": "merged"},
            {"step": "merge", "source": "recent", "target": "absent"},
            {"step": "tag", "source": "merged", "word": "t"},
            {"step": "sort", "source": "merged", "orderBy": "id", "direction": "desc"},
        ],
    }
    steps = {**STEPS, "tag": custom_step(lambda df, word: df.withColumn("tag", F.lit(word)))}
    done = run_flow(spark, flow, {"from": 2}, steps=steps)
    assert rows(done.datasets["joined"]) == sorted([(1, "x", 1, 9), (2, "y", None, None)], key=repr)
    assert [tuple(r) for r in done.datasets["merged"].collect()] == [(2, "y", "t"), (1, "x", "t")]
    assert rows(done.datasets["absent"]) == [(2, "y")]


def test_targets_default_to_the_first_dataset_and_ignore_does_not_hang(spark, home):
    flow = gauge_flow(home, steps=[], targets=[{"type": "table", "path": f"{home}/copy"}])
    assert run(spark, home, flow).metrics["rows_written"] == 6
    flow["targets"][0]["mode"] = "ignore"
    assert "rows_written" not in run(spark, home, flow).metrics
    flow["targets"][0]["source"] = "unknown"
    with pytest.raises(KeyError):
        run(spark, home, flow)


def test_merge_target_and_shared_persist(spark, home):
    flow = gauge_flow(home, steps=[], targets=[
        {"type": "table", "path": f"{home}/last", "mode": "merge", "keys": "gauge", "orderBy": "at", "newestWins": "true"},
        {"type": "csv", "path": f"{home}/c"},
    ])
    assert run(spark, home, flow, persist_shared=True).metrics["rows_written"] == 9
    (home / "feed" / "may.txt").write_text("R1|2031-04-30 06:00|1.00|upper\nR2|2031-05-03 06:00|0.50|lower\n")
    run(spark, home, flow)
    assert rows(spark.read.parquet(f"{home}/last").select("gauge", "level")) == [("R1", 3.0), ("R2", 0.5), ("R9", 9.0)]


def test_operators_as_steps(spark, home):
    flow = gauge_flow(home, targets=[], steps=[
        {"step": "golden", "source": "readings", "keys": "gauge", "orderBy": "at,level", "columns": "level,reach", "output": "golden"},
        {"step": "rolling", "source": "readings", "time": "at", "days": "2", "groupBy": "gauge", "metrics": "max:level", "output": "rolling"},
        {"step": "levels", "source": "readings", "cube": "reach", "metrics": "count:*", "output": "levels"},
        {"step": "record_hash", "source": "golden", "columns": "gauge,level", "hashColumn": "h"},
        {"step": "mask", "source": "golden", "columns": "reach", "strategy": "encrypt", "key": "0123456789abcdef", "output": "hidden"},
        {"step": "unmask", "source": "hidden", "columns": "reach", "key": "0123456789abcdef", "output": "shown"},
        {"step": "aggregate", "source": "readings", "groupBy": "gauge", "metrics": "collect_set:reach", "output": "sets"},
        {"step": "lookup", "source": "golden", "reference": "reaches", "joinColumns": "reach", "outputFields": "keeper,nope", "ignoreMissing": "true", "unique": "true", "output": "kept"},
    ])
    found = run(spark, home, flow).datasets
    assert rows(found["golden"].select("gauge", "level")) == [("R1", 3.0), ("R2", 0.75), ("R9", 9.0)]
    assert ("R2", 0.75) in [(r.gauge, r.max_level) for r in found["rolling"].collect()]
    assert sorted(r.count_rows for r in found["levels"].collect()) == [1, 2, 3, 6]
    assert rows(found["shown"].select("gauge", "reach")) == rows(found["golden"].select("gauge", "reach"))
    assert all(len(r.h) == 64 for r in found["golden"].collect())
    assert {r.gauge: r.collect_set_reach for r in found["sets"].collect()} == {"R1": ["upper"], "R2": ["lower"], "R9": []}
    assert {r.gauge: r.keeper for r in found["kept"].collect()} == {"R1": "Ada", "R2": "Ben", "R9": None}
    flow["steps"] = [{"step": "aggregate", "source": "readings", "window": "daily", "metrics": "count:*"}, {"step": "levels", "source": "readings", "metrics": "count:*"}]
    assert len(check_flow(flow)) == 2


def test_check_flow_lists_every_problem():
    problems = check_flow({
        "id": "x", "layer": "gold", "on_step_error": "retry",
        "sources": [{"type": "csv"}, {"type": "ftp"}, {"id": "d", "type": "database", "jdbcUrl": "jdbc:x"}],
        "steps": [{"step": "explode"}, {"step": "mask", "source": "a", "columns": " "}],
        "targets": [{"type": "hive"}, {"type": "table"}],
    })
    text = "\n".join(problems)
    for part in ("'app'", "layer", "on_step_error", "'path'", "'id'", "'ftp'", "table or sql", "'explode'", "'columns'", "'table'", "path or table"):
        assert part in text
    assert check_flow({}) and len(problems) == 11


def test_mock_path_and_schema_ref(spark, home):
    (home / "small.avsc").write_text(json.dumps({"fields": [{"name": "k", "type": "string"}, {"name": "x", "type": "double"}]}))
    (home / "feed" / "small.csv").write_text("k,x\na,1.5\n")
    flow = {
        "id": "s", "app": "a", "layer": "staging",
        "sources": [
            {"id": "typed", "type": "csv", "path": f"{home}/feed/small.csv", "schemaRef": f"{home}/small.avsc"},
            {"id": "db", "type": "database", "mockDataPath": f"{home}/feed/small.csv"},
        ],
    }
    done = run_flow(spark, flow)
    assert rows(done.datasets["typed"]) == [("a", 1.5)] and rows(done.datasets["db"]) == [("a", "1.5")]


def test_schema_ref_may_name_columns_of_later_steps(spark, home):
    (home / "feed" / "named.csv").write_text("reach,level\nupper,1.5\n")
    fields = [{"name": "level", "type": "double"}, {"name": "reach", "type": "string"}, {"name": "keeper", "type": ["null", "string"]}]
    (home / "levels.avsc").write_text(json.dumps({"fields": fields}))
    source = {"id": "levels", "type": "csv", "path": f"{home}/feed/named.csv", "schemaRef": f"{home}/levels.avsc"}
    step = {"step": "lookup", "source": "levels", "reference": "reaches", "joinColumns": "reach", "outputFields": "keeper"}
    done = run(spark, home, gauge_flow(home, sources=[source], steps=[step]), write=False)
    assert dict(done.datasets["levels"].dtypes)["level"] == "double"
    assert [r.keeper for r in done.datasets["levels"].collect()] == ["Ada"]


def test_a_csv_target_is_one_file_if_it_says_so(spark, home):
    targets = [{"type": "csv", "path": f"{home}/all.csv", "singleFile": "true"}, {"type": "csv", "path": f"{home}/parts.csv"}]
    assert run(spark, home, gauge_flow(home, steps=[], targets=targets)).metrics["rows_written"] == 12
    assert (home / "all.csv").is_file() and (home / "parts.csv").is_dir()
    assert rows(read_csv(spark, f"{home}/all.csv")) == rows(read_csv(spark, f"{home}/parts.csv"))


def test_relative_paths_and_input_check(spark, home):
    (home / "data" / "in").mkdir(parents=True)
    (home / "data" / "in" / "x.csv").write_text("a\n1\n")
    (home / "data" / "in" / "void.csv").write_text("")
    flow = {"id": "r", "app": "a", "layer": "staging", "sources": [{"id": "x", "type": "csv", "path": "in/x.csv"}]}
    assert run_flow(spark, flow, data_root=f"{home}/data").datasets["x"].count() == 1
    assert check_inputs(spark, flow, f"{home}/data") == []
    flow["sources"] += [{"id": "v", "type": "csv", "path": "in/void.csv"}, {"id": "n", "type": "csv", "path": "in/none.csv"}]
    assert [p.split("(")[0] for p in check_inputs(spark, flow, f"{home}/data")] == [
        "source 'v': in/void.csv is empty ", "source 'n': in/none.csv is missing "
    ]


# --- run logs --------------------------------------------------------------------------

LOGS = {
    "cards/staging/p_1.log": {"run_id": "1", "pipeline_id": "p", "app_name": "other", "layer": "service", "executed_at": "2025-11-20T17:26:41+00:00", "metrics": {"rows_processed": 7.0, "bad_rows": 1}, "status": "completed", "duration_ms": 6739},
    "cards/staging/p_2.log": {"run_id": "2", "pipeline_id": "p", "executed_at": "2025-11-21T01:00:00+00:00", "metrics": {"pipeline_source_loaded": 1.0}},
    "cards/staging/q_3.log": {"run_id": "3", "pipeline_id": "Quick", "executed_at": "2025-11-21T02:00:00+00:00", "metrics": {"Rows_in": "3", "records_out": 4.5, "x": 9}, "status": "failed", "error": "boom", "duration_ms": 30300},
    "loans/service/r_4.log": {"run_id": "4", "pipeline_id": "r"},
}


@pytest.fixture
def logs(spark, tmp_path):
    root = tmp_path / "logs" / "applications"
    for name, document in LOGS.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text(json.dumps(document, indent=2))
    (root / "cards/staging/broken.log").write_text('{"run_id": ')
    (root / "cards/staging/empty.log").write_text("{}")
    return read_run_logs(spark, str(root))


def test_history(logs):
    got = [tuple(r) for r in run_history(logs).collect()]
    assert got == [
        ("3", "Quick", "cards", "staging", "2025-11-21T02:00:00+00:00", 7, "failed", 0.51),
        ("2", "p", "cards", "staging", "2025-11-21T01:00:00+00:00", None, "completed", None),
        ("1", "p", "other", "service", "2025-11-20T17:26:41+00:00", 7, "completed", 0.11),
        ("4", "r", "loans", "service", None, None, "completed", None),
    ]
    assert got[0][-1] == round(30300 / 60000, 2)


def test_run_selection(logs):
    runs = run_history(logs)
    assert [r.run_id for r in latest_runs(logs, "cards", "staging", "p").collect()] == ["2"]
    assert run_by_id(logs, "cards", "staging", "p", "9").count() == 0
    assert run_by_id(logs, "other", "service", "p", "1").count() == 1
    assert filter_runs(runs, "all", "", None, None).count() == 4
    assert [r.run_id for r in filter_runs(runs, layer="staging", query="UICK").collect()] == ["3"]
    assert [r.run_id for r in filter_runs(runs, date="2025-11-20").collect()] == ["1"]


def test_run_reports(logs):
    assert rows(daily_runs(run_history(logs))) == sorted([("2025-11-21", 2, 1, 1), ("2025-11-20", 1, 1, 0), (None, 1, 1, 0)], key=repr)
    assert rows(failure_reasons(logs)) == [("boom", 1)]


def test_metrics_keep_their_json_types(spark, tmp_path):
    cases = [
        ({"rows_processed": "12.5", "rows_in": 3}, 15), ({"rows_processed": "-5"}, None), ({"rows_processed": 12.9}, 12), ({"rows_written": True}, 1),
        ({"rows_processed": "007", "rows_written": 9}, 7), ({"rows_processed": None, "records_written": 4}, 4), ({"rows_processed": -5}, -5),
        ({"rows_processed": 9007199254740993}, 9007199254740993), ({"rows_a": "1e2", "rows_b": [1], "rows_c": "x"}, 100), ({"rows_processed": "9" * 30, "row": 1}, 1),
        ({}, None), ([1, 2], None), (7, None), (None, None),
    ]
    lines = [json.dumps({"run_id": f"{i:02}", "metrics": m}) for i, (m, _) in enumerate(cases)]
    (tmp_path / "runs.log").write_text("\n".join([*lines, "{broken", ""]))
    got = run_history(read_run_logs(spark, str(tmp_path), multi_line=False), newest_first=False)
    assert {r.run_id: r.rows_processed for r in got.collect()} == {f"{i:02}": want for i, (_, want) in enumerate(cases)}


@pytest.mark.parametrize(
    "metrics, expected",
    [
        (None, None), ({}, None), ({"rows_processed": "0", "rows_written": "5"}, 0), ({"records_written": "12"}, 12),
        ({"rows_written": "x", "row_a": "2", "RECORDS": "3.9"}, 5), ({"other": "5"}, None), ({"row_a": "0"}, None),
    ],
)
def test_rows_processed(spark, metrics, expected):
    df = spark.createDataFrame([(metrics,)], "m map<string,string>")
    assert df.select(rows_processed(F.col("m"))).first()[0] == expected


def test_latency_keeps_fractions(spark):
    df = spark.createDataFrame([("p", d) for d in ("6739.5", "100", "900000.5", "NaN", "x", None)], "pipeline_id string, duration_ms string")
    assert rows(latency_percentiles(df, "pipeline_id")) == [("p", 6, 6739.5, 900000.5, 900000.5)]


def test_latency_is_nearest_rank(spark):
    df = spark.createDataFrame([("p", str(i)) for i in range(1, 101)] + [("q", "5"), ("q", None)], "pipeline_id string, duration_ms string")
    assert rows(latency_percentiles(df, "pipeline_id")) == [("p", 100, 50, 90, 99), ("q", 2, 5, 5, 5)]


def test_inventory(spark, tmp_path):
    for name in ("cards/staging/a.csv", "cards/staging/deep/b.csv", "loans/service/c.csv"):
        (tmp_path / "apps" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "apps" / name).write_text("x")
    (tmp_path / "apps" / "stray.csv").write_text("x")
    (tmp_path / "apps" / "loans" / "service" / "empty.csv").write_text("")
    (tmp_path / "apps" / "loans" / "service" / "_hidden").write_text("x")
    (tmp_path / "apps" / "loans" / "bare").mkdir()
    files = file_inventory(spark, f"{tmp_path}/apps")
    assert rows(files) == [("cards", "staging", 2), ("loans", "service", 3)]
    entries = spark.createDataFrame(
        [("cards", "staging", "pipeline", "Zed"), ("cards", "staging", "pipeline", "abc"), ("cards", "staging", "job", "j"), ("cards", "service", "pipeline", "abc")],
        "app string, layer string, kind string, id string",
    )
    summary = inventory_summary(entries, files)
    assert rows(summary) == [("cards", "service", ["abc"], [], 0), ("cards", "staging", ["Zed", "abc"], ["j"], 2)]
    assert filter_inventory(summary, "cards", "all", "ZE").count() == 1
    assert rows(inventory_totals(summary)) == sorted(
        [("cards", None, 3, 1, 2), (None, "service", 1, 0, 0), (None, "staging", 2, 1, 2), (None, None, 3, 1, 2)], key=repr
    )


def test_rows_processed_ignores_what_is_no_count(spark):
    metrics = [{"rows_processed": float("nan"), "rows_in": 3.0}, {"rows_processed": 1e300}, {"rows_processed": 7.0}]
    df = spark.createDataFrame([(i, m) for i, m in enumerate(metrics)], "i int, metrics map<string,double>")
    got = df.select("i", rows_processed(F.col("metrics")).alias("n")).orderBy("i").collect()
    assert [r.n for r in got] == [3, None, 7]


# --- shared results, target schemas, secrets ---


def branching(frame, keep, tmp_path, targets=2):
    return {
        "id": "b", "app": "a", "layer": "staging",
        "sources": [{"id": "items", "type": "frame", "frame": frame}],
        "steps": [
            {"step": "deduplicate", "source": "items", "keys": "k", "keep": keep, "orderBy": "x"},
            {"step": "record_hash", "source": "items", "columns": "k,x", "output": "hashed"},
            {"step": "aggregate", "source": "hashed", "groupBy": "g", "metrics": "sum:x,count:*", "output": "totals"},
            {"step": "aggregate", "source": "items", "groupBy": "g", "metrics": "max:x", "output": "unused"},
        ],
        "targets": [{"type": "table", "source": s, "path": f"{tmp_path}/{s}"} for s in ("hashed", "totals")[:targets]],
    }


@pytest.mark.parametrize("keep", ["any", "latest"])
def test_what_targets_share_is_computed_once(spark, tmp_path, keep):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def watched(x):
        seen.add(1)
        return x

    # Rows of a key differ at random each time they are computed.
    noisy = spark.range(0, 400, numPartitions=4).select((F.col("id") % 100).alias("k"), (F.col("id") % 3).alias("g"), (watched("id") + F.floor(F.rand() * 1e6)).alias("x"))
    flow = branching(noisy, keep, tmp_path)
    assert shared_steps(flow) == {1}
    done = run_flow(spark, flow)
    assert seen.value == 400 and done.metrics["rows_written"] == 103
    hashed, totals = (spark.read.parquet(f"{tmp_path}/{s}") for s in ("hashed", "totals"))
    assert rows(totals) == rows(hashed.groupBy("g").agg(F.sum("x").alias("sum_x"), F.count("*").alias("count_rows")))
    assert len(done.staged) == 1
    done.release(spark)
    assert done.staged == [] and shared_steps(branching(noisy, keep, tmp_path, 1)) == set()


def test_where_ways_part():
    def flow(steps, targets, sources=("a", "b")):
        named = [{"step": "join" if "right" in s else "mask", **s} for s in steps]
        return {"sources": [{"id": s} for s in sources], "steps": named, "targets": [{"source": t} for t in targets]}

    one = {"source": "a", "output": "c"}
    assert shared_steps(flow([one], ["c", "c"])) == {0}
    assert shared_steps(flow([one], ["a", "a"])) == set()  # a source is not copied
    assert shared_steps(flow([one, {"source": "c", "output": "d"}, {"source": "d", "output": "e"}], ["d", "e"])) == {1}
    twice = [one, {"left": "c", "right": "b", "output": "d"}, {"left": "b", "right": "c", "output": "e"}]
    assert shared_steps(flow(twice, ["d", "e"])) == {0} and shared_steps(flow(twice, ["e"])) == set()
    overwritten = [{"source": "a"}, {"source": "a"}, {"source": "a", "output": "f"}]
    assert shared_steps(flow(overwritten, ["a", "f"])) == {1}


@pytest.mark.parametrize("policy", ["quarantine", "skip"])
def test_a_target_keeps_its_schema(spark, home, policy):
    fields = [{"name": "gauge", "type": "string"}, {"name": "level", "type": "float"}, {"name": "reach", "type": "string"}]
    (home / "out.avsc").write_text(json.dumps({"fields": fields}))
    targets = [{"type": "table", "path": f"{home}/out", "schemaRef": f"{home}/out.avsc"}, {"type": "table", "path": f"{home}/all"}]
    flow = gauge_flow(home, steps=[], targets=targets, on_record_error=policy)
    done = run(spark, home, flow)
    n = len(READINGS.splitlines())
    assert done.metrics["rows_rejected"] == 1 and done.metrics["rows_written"] == 2 * n - 1
    kept = spark.read.parquet(f"{home}/out")
    assert kept.dtypes == [("gauge", "string"), ("level", "float"), ("reach", "string")] and kept.count() == n - 1
    assert done.metrics.get("rows_quarantined") == (1 if policy == "quarantine" else None)
    if policy == "quarantine":
        (bad,) = read_quarantine(spark, f"{home}/exceptions", spark.read.parquet(f"{home}/all").schema).collect()
        assert (bad.gauge, bad.rule_id, bad.reason) == ("R9", "reach", "target_schema:raw")
    (home / "more.avsc").write_text(json.dumps({"fields": [*fields, {"name": "absent", "type": "string"}]}))
    flow["targets"] = [{**targets[0], "schemaRef": f"{home}/more.avsc"}]
    with pytest.raises(ValueError, match="not found"):
        run(spark, home, flow)


def test_increments_count_once_their_targets_are_written(spark, home):
    source = {"id": "readings", "type": "csv", "path": f"{home}/feed/may.txt", "header": "false", "delimiter": "|",
              "schema": "gauge string, at timestamp_ntz, level double, reach string", "watermark": "at", "state": f"{home}/state"}
    good = [{"type": "table", "path": f"{home}/kept", "mode": "merge", "keys": "gauge,at,level", "buckets": 4}]
    flow = {"id": "i", "app": "a", "layer": "staging", "sources": [source], "targets": [*good, {"type": "csv", "path": f"{home}/x", "mode": "wrong"}]}
    with pytest.raises(ValueError, match="mode"):
        run_flow(spark, flow)
    flow["targets"] = good
    n = len(READINGS.splitlines())
    assert [run_flow(spark, flow).metrics["rows_written"] for _ in range(2)] == [n, 0.0]
    with open(home / "feed" / "may.txt", "a") as feed:
        feed.write("R9|2031-05-02 09:00|1.25|lower\nR9|2031-05-03 09:00|1.50|lower\n")
    run_flow(spark, flow)
    again = {"id": "r", "app": "a", "layer": "staging", "sources": [{"id": "t", "type": "table", "path": f"{home}/kept"}]}
    assert run_flow(spark, again).datasets["t"].count() == n + 2
    assert any("both watermark and state" in e for e in check_flow({**flow, "sources": [{**source, "state": None}]}))


def test_a_secret_is_in_no_plan_and_no_log(tmp_path):
    """In a process of its own, as the event log is set when a session starts."""
    script = """
import sys
from pyspark.sql import functions as F
from tidemill.operators import mask, unmask
from tidemill.session import local_session
log, key_file = sys.argv[1:]
spark = local_session("secrets", cores="2", partitions=2, **{"spark.eventLog.enabled": "true", "spark.eventLog.compress": "false", "spark.eventLog.dir": log})
df = spark.range(50).select(F.concat(F.lit("card"), "id").alias("card"))
for ref in ("env:CARD_KEY", f"file:{key_file}"):
    hidden = mask(df, "card", "encrypt", secret_ref=ref)
    shown = unmask(hidden, "card", secret_ref=ref)
    assert sorted(r.card for r in shown.collect()) == sorted(r.card for r in df.collect())
    for frame in (hidden, shown):
        frame.explain("extended")
        print(frame._jdf.queryExecution().toString())
for call in (lambda: mask(df, "card", "encrypt"), lambda: mask(df, "card", "encrypt", secret_ref="nowhere:x"), lambda: mask(df, "card", "encrypt", secret_ref="env:NO_SUCH_KEY")):
    try:
        call()
    except (ValueError, KeyError):
        continue
    raise SystemExit("accepted")
spark.stop()
"""
    (tmp_path / "log").mkdir()
    (tmp_path / "key").write_text("0123456789abcdeF\n")
    env = {**os.environ, "CARD_KEY": "0123456789abcdeF", "PYTHONPATH": str(Path(__file__).resolve().parents[1])}
    done = subprocess.run([sys.executable, "-c", script, f"file://{tmp_path}/log", f"{tmp_path}/key"], env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert "aes_encrypt" in done.stdout
    logged = "".join(p.read_text(errors="replace") for p in (tmp_path / "log").rglob("*") if p.is_file())
    assert "SparkListenerSQLExecutionStart" in logged
    assert "0123456789abcdeF" not in logged + done.stdout + done.stderr
