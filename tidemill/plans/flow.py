"""Declarative batch flows: sources, ordered steps, targets, one run log.

A flow is a plain dict::

    {
        "id": "balances", "app": "cards", "layer": "staging", "version": "1.0",
        "sources": [{"id": "cards", "type": "csv", "path": "in/cards.csv"}],
        "steps":   [{"step": "deduplicate", "source": "cards", "keys": "id"}],
        "targets": [{"type": "table", "source": "cards", "path": "out/cards"}],
        "on_step_error": "halt",            # halt | quarantine | skip
        "record_rules": {"cards": [NotNull("has_id", ["id"])]},
        "on_record_error": "quarantine",    # quarantine | skip
    }

Steps build one lazy plan; work starts when a target is written. Step errors are therefore
planning errors (a missing column, an unknown function). Bad values are handled by
``record_rules``, which split each named source into valid and rejected rows.
"""

from __future__ import annotations

import datetime as dt
import json
import logging
import re
import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import cache
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..quality import quarantine, split_by_rules
from ..session import shared_path
from ..sources import (
    avro_schema,
    declare,
    load_increment,
    path_exists,
    preflight,
    read_csv,
    read_database,
    read_files,
    read_reference,
    read_sql,
    read_table,
    table_path,
    write_csv,
    write_database,
    write_table,
)
from ..sources.files import discard
from ..sources.schema import FAILED_COLUMNS, broken_columns, conforming
from ..sources.writers import merge_into_table
from .steps import STEPS, Step, dataset

log = logging.getLogger(__name__)

#: Counter names of a run, and the reason recorded for a failed step's rows.
SOURCES_LOADED = "pipeline_source_loaded"
STEP_APPLIED = "pipeline_transform_"
TARGETS_WRITTEN = "pipeline_targets_written"
STEP_FAILURE = "transformation_failure:"
TARGET_SCHEMA = "target_schema:"

LAYERS = ("staging", "standardization", "service")
STEP_ERRORS = ("halt", "quarantine", "skip")
RECORD_ERRORS = ("quarantine", "skip")

#: Options each source and target type cannot do without.
SOURCE_REQUIRED = {"csv": ("path",), "files": ("path",), "parquet": ("path",), "database": (), "sql": ("sql",), "frame": ("frame",), "table": ()}
TARGET_REQUIRED = {"csv": ("path",), "table": (), "hive": ("table",), "database": ("url", "table")}


@dataclass
class FlowRun:
    """What a run leaves behind."""

    run_id: str
    datasets: dict[str, DataFrame] = field(default_factory=dict)
    metrics: dict[str, float] = field(default_factory=dict)
    status: str = "completed"
    error: str | None = None
    duration_ms: int = 0
    executed_at: str = ""
    #: Copies in the shared folder that datasets read from.
    staged: list[str] = field(default_factory=list)
    #: What makes the increments of sources count as loaded.
    commits: list[Callable[[], None]] = field(default_factory=list)

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` written to the shared folder, to be computed once for all that read it."""
        path = shared_path(df.sparkSession, name)
        df.write.parquet(path)
        self.staged.append(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def release(self, spark: SparkSession) -> None:
        """Remove the staged copies, once the datasets are no longer needed."""
        while self.staged:
            discard(spark, self.staged.pop())

    def count(self, name: str, by: float = 1.0) -> None:
        self.metrics[name] = self.metrics.get(name, 0.0) + by


def check_flow(flow: Mapping[str, Any], steps: Mapping[str, Step] = STEPS) -> list[str]:
    """Everything wrong with a flow that can be said before any job runs."""
    errors = [f"flow: {k!r} is required" for k in ("id", "app", "layer") if not flow.get(k)]
    if flow.get("layer") and flow["layer"] not in LAYERS:
        errors.append(f"flow: layer must be one of {LAYERS}")
    if not flow.get("sources"):
        errors.append("flow: at least one source is required")
    if flow.get("on_step_error", "halt") not in STEP_ERRORS:
        errors.append(f"flow: on_step_error must be one of {STEP_ERRORS}")
    if flow.get("on_record_error", "quarantine") not in RECORD_ERRORS:
        errors.append(f"flow: on_record_error must be one of {RECORD_ERRORS}")
    for s in flow.get("sources", []):
        errors += _missing("source", s.get("type"), s, SOURCE_REQUIRED, ("id",))
        if s.get("type") == "table" and not (s.get("path") or s.get("table")):
            errors.append("source 'table': path or table is required")
        if (s.get("watermark") is None) != (s.get("state") is None):
            errors.append(f"source {s.get('id')!r}: an increment needs both watermark and state")
        if s.get("type") == "database" and not s.get("mockDataPath"):
            errors += _missing("source", "database", s, {"database": ("url",)}, ())
            if not (s.get("table") or s.get("sql")):
                errors.append("source 'database': table or sql is required")
    for s in flow.get("steps", []):
        known = {name: step.required for name, step in steps.items()}
        errors += _missing("step", s.get("step"), s, known, ())
        if s.get("step") == "aggregate" and s.get("window") and not s.get("time"):
            errors.append("step 'aggregate': a window needs the option 'time'")
        if s.get("step") == "levels" and sum(s.get(o) is not None for o in ("rollup", "cube", "sets")) != 1:
            errors.append("step 'levels': give exactly one of rollup, cube, sets")
    for t in flow.get("targets", []):
        errors += _missing("target", t.get("type"), t, TARGET_REQUIRED, ())
        if t.get("type") == "table" and not (t.get("path") or t.get("table")):
            errors.append("target 'table': path or table is required")
    return errors


def check_inputs(spark: SparkSession, flow: Mapping[str, Any], data_root: str | None = None) -> list[str]:
    """Problems with the files behind a flow's sources; reads listings only."""
    found = []
    for entry in flow.get("sources", []):
        path = entry.get("path") or entry.get("mockDataPath")
        if not path:
            continue
        state = preflight(spark, _resolve(spark, path, data_root)).first()
        if state["status"] != "ok":
            found.append(f"source {entry.get('id')!r}: {path} is {state['status']} ({state['empty_files']} of {state['files']} files are empty)")
    return found


def _missing(what: str, kind: Any, options: Mapping[str, Any], known: Mapping[str, tuple], always: tuple) -> list[str]:
    if kind not in known:
        return [f"{what}: {kind!r} is not registered; known: {sorted(known)}"]
    options = {**options, **_arguments(options)}
    return [
        f"{what} {kind!r}: option {o!r} is required"
        for o in (*always, *known[kind])
        if options.get(o) is None or (isinstance(options[o], str) and not options[o].strip())
    ]


#: Option names as flow documents write them, and the argument each one fills.
OPTION_NAMES = {
    "inferSchema": "infer_schema",
    "dateFormat": "date_format",
    "partitionBy": "partition_by",
    "orderBy": "order_by",
    "singleFile": "single_file",
    "rowsPerFile": "rows_per_file",
    "multiLine": "multi_line",
    "lineSep": "line_sep",
    "nullValue": "null_value",
    "emptyValue": "empty_value",
    "targetUnique": "target_unique",
    "newestWins": "newest_wins",
    "jdbcUrl": "url",
    "sql": "query",
    "fetchSize": "fetch_size",
    "writeBatchSize": "batch_size",
    "isolationLevel": "isolation_level",
    "partitionColumn": "partition_column",
    "lowerBound": "lower_bound",
    "upperBound": "upper_bound",
    "numPartitions": "num_partitions",
}


def _options(entry: Mapping[str, Any], *own: str) -> dict[str, Any]:
    return {k: v for k, v in entry.items() if k not in own}


def _arguments(entry: Mapping[str, Any], *own: str) -> dict[str, Any]:
    return {OPTION_NAMES.get(k, k): v for k, v in entry.items() if k not in own}


def _load(
    spark: SparkSession,
    entry: Mapping[str, Any],
    datasets: dict[str, DataFrame],
    params: Mapping[str, Any],
    data_root: str | None,
) -> DataFrame:
    kind = entry["type"]
    if kind == "frame":
        return entry["frame"]
    if kind == "sql":
        used = {k: v for k, v in params.items() if f":{k}" in entry["sql"]}
        return read_sql(spark, entry["sql"], datasets, used)
    options = _arguments(entry, "id", "type", "schemaRef", "watermark", "state")
    if kind == "table":
        return read_table(spark, _table_at(options, data_root), options.get("format", "parquet"))
    declared = entry.get("schemaRef")
    if "path" in options:
        options["path"] = _resolve(spark, options["path"], data_root)
    if kind == "csv":
        df = read_csv(spark, **(options if not declared else {**options, "infer_schema": False}))
    elif kind in ("files", "parquet"):
        df = read_files(spark, **options)
    elif "mockDataPath" in options:
        df = read_files(spark, _resolve(spark, options["mockDataPath"], data_root))
    else:
        df = read_database(spark, **options)
    if declared:
        document = spark.read.text(_resolve(spark, declared, data_root), wholetext=True).first()[0]
        df = declare(df, avro_schema(document))
    return df


def _resolve(spark: SparkSession, path: str, data_root: str | None) -> str:
    """A relative path means the working folder where it exists there, else the data root."""
    relative = isinstance(path, str) and "://" not in path and not path.startswith("/")
    if not relative or data_root is None:
        return path
    here = path.rstrip("/")
    parent = here.rsplit("/", 1)[0] if "/" in here else here
    if path_exists(spark, here) or ("/" in here and path_exists(spark, parent)):
        return path
    return f"{data_root.rstrip('/')}/{path}"


def _table_at(options: Mapping[str, Any], data_root: str | None) -> str:
    """Where a table named by ``path`` or ``table`` lies."""
    if "table" not in options:
        return options["path"]
    if data_root is None:
        raise ValueError("a table given by name needs data_root")
    return table_path(data_root, options["table"])


def _write(
    df: DataFrame, entry: Mapping[str, Any], data_root: str | None, run_time: dt.datetime, counted: Observation | None
) -> None:
    kind, options = entry["type"], _arguments(entry, "type", "source", "dataset", "schemaRef")
    options["counted"] = counted
    if kind == "csv":
        options["path"] = _resolve(df.sparkSession, options["path"], data_root)
        write_csv(df, run_time=run_time, **options)
    elif kind == "database":
        write_database(df, **options)
    else:
        options["path"] = _table_at(options, data_root)
        options.pop("table", None)
        if options.get("mode") == "merge":
            options.pop("mode")
            merge_into_table(df, **options)
        else:
            write_table(df, run_time=run_time, **options)


def run_flow(
    spark: SparkSession,
    flow: Mapping[str, Any],
    params: Mapping[str, Any] | None = None,
    steps: Mapping[str, Step] = STEPS,
    data_root: str | None = None,
    reference_root: str | None = None,
    quarantine_path: str | None = None,
    logs_root: str | None = None,
    persist_shared: bool = True,
    write: bool = True,
) -> FlowRun:
    """Load the sources, fold the steps over the named datasets, write the targets.

    ``params`` bind into ``sql`` sources (``:runDate``); ``run_id`` among them names the run.
    Targets without a ``source`` take the first dataset; a CSV target is a folder, or with ``singleFile`` one
    file. Row counts come from an observation on each write, at no extra pass. With ``persist_shared`` the result of a
    step that several targets depend on is written once to the shared folder, where their ways part (see
    :func:`shared_steps`), so what leads to it is computed once and all targets see the same rows; the datasets of
    the run read these copies until ``FlowRun.release``. A target's ``schemaRef`` is enforced before it is written: rows
    that break it go to the quarantine, or are left out under ``on_record_error: skip``. A source with ``watermark`` and
    ``state`` brings what no run before has loaded; it counts as loaded once all targets are written.
    ``write=False`` stops after planning. With ``logs_root`` one run log row is appended, on
    failure too. The counts may exceed the rows when a lost executor makes tasks run again.
    """
    errors = check_flow(flow, steps)
    if errors:
        raise ValueError("; ".join(errors))
    params = dict(params or {})
    now = dt.datetime.now(dt.timezone.utc)
    run = FlowRun(run_id=params.pop("run_id", None) or now.strftime("run-%Y%m%dT%H%M%S"))
    started = time.monotonic()
    try:
        _load_sources(spark, flow, run, params, data_root, quarantine_path)
        shared = shared_steps(flow, steps) if write and persist_shared else set()
        _apply_steps(spark, flow, run, steps, reference_root, quarantine_path, shared)
        if write:
            _write_targets(spark, flow, run, data_root, quarantine_path, now)
            for commit in run.commits:
                commit()
    except Exception as error:
        run.status, run.error = "failed", str(error)
        raise
    finally:
        run.duration_ms = int((time.monotonic() - started) * 1000)
        run.executed_at = dt.datetime.now(dt.timezone.utc).isoformat()
        if logs_root:
            try:
                append_run_log(spark, flow, run, logs_root)
            except Exception:  # a run's outcome must not hang on its log
                log.exception("the log of run %s could not be written", run.run_id)
    return run


def _load_sources(spark, flow, run: FlowRun, params, data_root: str | None, quarantine_path: str | None) -> None:
    policy = flow.get("on_record_error", "quarantine")
    for entry in flow["sources"]:
        df = _load(spark, entry, run.datasets, params, data_root)
        if entry.get("state"):
            df, commit = load_increment(df, _resolve(spark, entry["state"], data_root), entry["watermark"])
            run.commits.append(commit)
        rules = flow.get("record_rules", {}).get(entry["id"])
        if rules:
            df, rejected = split_by_rules(df, rules)
            if policy == "quarantine":
                if quarantine_path is None:
                    raise ValueError("on_record_error 'quarantine' needs quarantine_path")
                counted = Observation()
                rejected = rejected.observe(counted, F.count(F.lit(1)).alias("rows"))
                quarantine(rejected, quarantine_path, f"record_rules:{entry['id']}", run.run_id, "failed_rules")
                run.count("rows_quarantined", float(counted.get["rows"]))
        run.datasets[entry["id"]] = df
        run.count(SOURCES_LOADED)


#: Options of a step that may name a dataset it reads.
INPUTS = ("source", "left", "right", "target", "reference")


def shared_steps(flow: Mapping[str, Any], steps: Mapping[str, Step] = STEPS) -> set[int]:
    """Numbers of the steps at which the ways to several targets part.

    Every step is a node that reads the nodes its options name. A result is shared where at least two
    steps or targets read it and each of them leads to a target; its own inputs are then read by it alone.
    """
    current: dict[str, int | str] = {s["id"]: f"source {s['id']}" for s in flow.get("sources", [])}
    first = next(iter(current), None)
    reads: dict[int | str, set] = {}
    for number, entry in enumerate(flow.get("steps", [])):
        used = {current[entry[o]] for o in INPUTS if isinstance(entry.get(o), str) and entry[o] in current}
        reads[number] = used
        stores = steps[entry["step"]].stores
        output = next((entry[o] for o in stores if entry.get(o)), None)
        if output is not None:
            current[output] = number
    for number, entry in enumerate(flow.get("targets", [])):
        name = entry.get("source") or entry.get("dataset") or first
        reads[f"target {number}"] = {current[name]} if name in current else set()
    needed, readers = [n for n in reads if isinstance(n, str)], {}
    for node in needed:  # grows while it is walked
        for used in reads.get(node, ()):
            if used not in readers:
                needed.append(used)
            readers.setdefault(used, set()).add(node)
    return {n for n, own in readers.items() if isinstance(n, int) and len(own) > 1}


def _apply_steps(
    spark, flow, run: FlowRun, steps: Mapping[str, Step], reference_root, quarantine_path, shared: set[int]
) -> None:
    @cache
    def reference(name: str) -> DataFrame:
        if reference_root is None:
            raise KeyError(f"reference {name!r} is no dataset and no reference_root is set")
        return read_reference(spark, f"{reference_root.rstrip('/')}/{name}.json")

    policy = flow.get("on_step_error", "halt")
    for number, entry in enumerate(flow.get("steps", [])):
        name, options = entry["step"], _options(entry, "step")
        step = steps[name]
        try:
            result = step.run(run.datasets, options, reference)
            if number in shared and not re.search(r"\b(void|interval)\b", result.schema.simpleString()):  # no file holds these
                result = run.stage(result, "flow-step")
            output = next(options[o] for o in step.stores if options.get(o))
            run.datasets[output] = result
            run.count(STEP_APPLIED + name)
        except Exception as error:
            log.warning("step %s failed: %s", name, error)
            if policy == "halt":
                raise
            run.count("pipeline_steps_failed")
            source = options.get("source")
            if policy == "quarantine" and source in run.datasets:
                if quarantine_path is None:
                    raise ValueError("on_step_error 'quarantine' needs quarantine_path") from error
                quarantine(run.datasets[source], quarantine_path, STEP_FAILURE + name, run.run_id)


def _write_targets(spark, flow, run: FlowRun, data_root, quarantine_path: str | None, run_time) -> None:
    if not flow.get("targets"):
        log.warning("flow %s has no targets", flow["id"])
    first = next(iter(run.datasets))
    for entry in flow.get("targets", []):
        name = entry.get("source") or entry.get("dataset") or first
        df = dataset(run.datasets, name)
        if entry.get("schemaRef"):
            df = _conforming(spark, flow, run, df, entry, name, data_root, quarantine_path)
        # A write that mode "ignore" skips never runs, and its count would never arrive.
        counted = None if entry.get("mode") == "ignore" else Observation()
        _write(df, entry, data_root, run_time, counted)
        run.count(TARGETS_WRITTEN)
        if counted is not None:
            run.count("rows_written", float(counted.get["rows"]))


def _conforming(
    spark, flow, run: FlowRun, df: DataFrame, entry: Mapping[str, Any], name: str, data_root, quarantine_path: str | None
) -> DataFrame:
    """Rows that keep a target's declared schema, in its columns and types; the others are put aside.

    The dataset is computed once: its rows go to the shared folder with what is wrong with them, are counted on
    the way, and both the target and the quarantine are written from there.
    """
    policy = flow.get("on_record_error", "quarantine")
    if policy == "quarantine" and quarantine_path is None:
        raise ValueError("a target with schemaRef needs quarantine_path, or on_record_error 'skip'")
    document = spark.read.text(_resolve(spark, entry["schemaRef"], data_root), wholetext=True).first()[0]
    schema = avro_schema(document)
    broken = broken_columns(df, schema)
    counted = Observation()
    flagged = df.withColumn(FAILED_COLUMNS, broken).observe(counted, F.count_if(F.col(FAILED_COLUMNS) != "").alias("rows"))
    rows = run.stage(flagged, "flow-target")
    found = counted.get["rows"]
    if found:
        run.count("rows_rejected", float(found))
        if policy == "quarantine":
            rejected = rows.filter(F.col(FAILED_COLUMNS) != "")
            quarantine(rejected, quarantine_path, TARGET_SCHEMA + name, run.run_id, FAILED_COLUMNS)
            run.count("rows_quarantined", float(found))
    return conforming(rows.filter(F.col(FAILED_COLUMNS) == ""), schema)


def append_run_log(spark: SparkSession, flow: Mapping[str, Any], run: FlowRun, logs_root: str) -> None:
    """One JSON line per run, in ``<logs_root>/applications/<app>/<layer>``."""
    document = {
        "run_id": run.run_id,
        "pipeline_id": flow["id"],
        "app_name": flow["app"],
        "layer": flow["layer"],
        "version": flow.get("version", "1.0"),
        "executed_at": run.executed_at,
        "metrics": run.metrics,
        "status": run.status,
        "duration_ms": run.duration_ms,
    }
    if run.error:
        document["error"] = run.error
    path = f"{logs_root.rstrip('/')}/applications/{flow['app']}/{flow['layer']}"
    spark.createDataFrame([(json.dumps(document),)], "value string").coalesce(1).write.mode("append").text(path)
