"""The transformation steps a flow may name, with their options as text or lists."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame

from ..functions import expressions, flag
from ..operators import (
    aggregate,
    aggregate_levels,
    aggregate_rolling,
    aggregate_window,
    deduplicate,
    golden_record,
    join,
    lookup,
    mask,
    merge,
    record_hash,
    sort,
    unmask,
)

Datasets = Mapping[str, DataFrame]
Options = Mapping[str, Any]


@dataclass(frozen=True)
class Step:
    """How one step name is carried out.

    ``run(datasets, options, reference)`` returns the new dataset; ``reference`` loads a named
    reference table. ``required`` lists options that must be present, ``stores`` the options
    that name the output, the first present one winning.
    """

    run: Callable[[Datasets, Options, Callable[[str], DataFrame]], DataFrame]
    required: tuple[str, ...] = ("source",)
    stores: tuple[str, ...] = ("output", "source")


def dataset(datasets: Datasets, name: str) -> DataFrame:
    if name not in datasets:
        raise KeyError(f"dataset {name!r} is not defined; known: {sorted(datasets)}")
    return datasets[name]


def _deduplicate(ds: Datasets, o: Options, reference) -> DataFrame:
    return deduplicate(
        dataset(ds, o["source"]), o["keys"], o.get("keep", "any"), o.get("orderBy"), o.get("tieBreaker")
    )


def _sort(ds: Datasets, o: Options, reference) -> DataFrame:
    return sort(dataset(ds, o["source"]), o["orderBy"], o.get("direction", "asc"), o.get("nulls"), position=o.get("position"))


def _join(ds: Datasets, o: Options, reference) -> DataFrame:
    return join(
        dataset(ds, o["left"]),
        dataset(ds, o["right"]),
        o["condition"],
        o.get("type", "inner"),
        left_id=o["left"],
        right_id=o["right"],
        select=expressions(o["select"]) if "select" in o else None,
        null_safe=flag(o.get("nullSafe"), False),
        grouped=o.get("grouped"),
    )


def _lookup(ds: Datasets, o: Options, reference) -> DataFrame:
    ref = ds[o["reference"]] if o["reference"] in ds else reference(o["reference"])
    return lookup(
        dataset(ds, o["source"]),
        ref,
        o.get("joinColumns", "id"),
        o.get("outputFields"),
        o.get("joinType", "left"),
        broadcast=flag(o.get("broadcast"), False),
        prefix=o.get("prefix"),
        ignore_missing=flag(o.get("ignoreMissing"), False),
        unique=flag(o.get("unique"), False),
        grouped=flag(o.get("grouped"), False),
    )


def _mask(ds: Datasets, o: Options, reference) -> DataFrame:
    return mask(
        dataset(ds, o["source"]), o["columns"], o.get("strategy", "hash"), o.get("key"), o.get("salt"), o.get("secretRef")
    )


def _aggregate(ds: Datasets, o: Options, reference) -> DataFrame:
    df = dataset(ds, o["source"])
    if "window" in o:
        if "time" not in o:
            raise ValueError("aggregate: a window needs the option time")
        return aggregate_window(df, o["time"], o["window"], o.get("groupBy"), o["metrics"], _guard(o))
    return aggregate(df, o.get("groupBy"), o["metrics"], _guard(o))


def _guard(o: Options) -> int | None:
    return None if o.get("maxItems") is None else int(o["maxItems"])


def _rolling(ds: Datasets, o: Options, reference) -> DataFrame:
    return aggregate_rolling(dataset(ds, o["source"]), o["time"], int(o["days"]), o.get("groupBy"), o["metrics"])


def _levels(ds: Datasets, o: Options, reference) -> DataFrame:
    df = dataset(ds, o["source"])
    return aggregate_levels(df, o["metrics"], o.get("rollup"), o.get("cube"), o.get("sets"), o.get("level"))


def _golden(ds: Datasets, o: Options, reference) -> DataFrame:
    return golden_record(dataset(ds, o["source"]), o["keys"], o["orderBy"], o.get("columns"))


def _unmask(ds: Datasets, o: Options, reference) -> DataFrame:
    return unmask(dataset(ds, o["source"]), o["columns"], o.get("key"), o.get("secretRef"))


def _record_hash(ds: Datasets, o: Options, reference) -> DataFrame:
    return record_hash(dataset(ds, o["source"]), o.get("columns"), o.get("hashColumn", "record_hash"))


def _merge(ds: Datasets, o: Options, reference) -> DataFrame:
    return merge(
        dataset(ds, o["source"]),
        ds.get(o["target"]),
        o.get("keys"),
        o.get("orderBy"),
        target_unique=flag(o.get("targetUnique"), False),
        newest_wins=flag(o.get("newestWins"), False),
    )


#: The built-in steps; copy and extend to add your own.
STEPS: dict[str, Step] = {
    "deduplicate": Step(_deduplicate, ("source", "keys")),
    "sort": Step(_sort, ("source", "orderBy")),
    "join": Step(_join, ("left", "right", "condition"), ("output", "left")),
    "lookup": Step(_lookup, ("source", "reference", "joinColumns")),
    "mask": Step(_mask, ("source", "columns")),
    "aggregate": Step(_aggregate, ("source", "metrics")),
    "merge": Step(_merge, ("source", "target"), ("output", "target")),
    "rolling": Step(_rolling, ("source", "time", "days", "metrics")),
    "levels": Step(_levels, ("source", "metrics")),
    "golden": Step(_golden, ("source", "keys", "orderBy")),
    "unmask": Step(_unmask, ("source", "columns")),
    "record_hash": Step(_record_hash),
}


def custom_step(fn: Callable[..., DataFrame], required: tuple[str, ...] = ("source",)) -> Step:
    """Wrap ``fn(df, **options) -> DataFrame`` as a step on its ``source`` dataset."""

    def run(ds: Datasets, o: Options, reference) -> DataFrame:
        rest = {k: v for k, v in o.items() if k not in ("source", "output")}
        return fn(dataset(ds, o["source"]), **rest)

    return Step(run, required)
