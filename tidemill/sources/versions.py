"""Tables of versions: folders that never change, and numbered pointers to those that make up the table.

A version is one small file ``_versions/<number>.json`` that names, for every folder of the table, the parts
(partition or bucket folders) that are valid there. A writer first writes new folders and then
publishes the next pointer, which appears whole or not at all; a reader takes the highest pointer it
finds. So who reads meanwhile sees the table before or after a change, never a part of it, and a
writer that dies leaves the table as it was.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..functions import col, names, require_columns
from ..operators.merge import merge
from ..session import shared_path
from .files import children, discard, folders_of, path_exists, publish_small, read_small

#: Where pointers and folders of versions live (Spark does not list names that begin so), and the bucket column.
VERSIONS, BUCKET = "_versions", "__bucket"
#: Versions whose folders stay: the current one, and those that readers may still be at.
KEPT_VERSIONS = 3


@dataclass(frozen=True)
class Version:
    """One state of a table. ``folders`` maps a folder, relative to the table, to its valid parts."""

    number: int
    format: str
    schema: StructType
    folders: dict[str, list[str]]
    parts: list[str]
    buckets: int | None
    keys: list[str]

    def text(self) -> str:
        return json.dumps({**self.__dict__, "schema": json.loads(self.schema.json())})

    @staticmethod
    def of(text: str) -> Version:
        document = json.loads(text)
        return Version(**{**document, "schema": StructType.fromJson(document["schema"])})


def _pointers(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n.removesuffix(".json")) for n in children(spark, f"{path}/{VERSIONS}") if n.endswith(".json"))


def table_version(spark: SparkSession, path: str) -> Version | None:
    """The current version, or None where ``path`` is no table of versions."""
    path = path.rstrip("/")
    numbers = _pointers(spark, path)
    return Version.of(read_small(spark, f"{path}/{VERSIONS}/{numbers[-1]:08d}.json")) if numbers else None


def read_table(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    """A path-based table: its current version, or plain files where it has none."""
    version = table_version(spark, path)
    return spark.read.format(format).load(path) if version is None else _rows(spark, path.rstrip("/"), version).drop(BUCKET)


def _stored(version: Version) -> StructType:
    bucket = [StructField(BUCKET, IntegerType())] if version.buckets else []
    return StructType([*version.schema, *bucket])


def _rows(spark: SparkSession, path: str, version: Version) -> DataFrame:
    """All rows of a version; each folder is one relation, whose parts are pruned by filters on them."""
    schema = _stored(version)
    frames = []
    for folder, parts in version.folders.items():
        base = f"{path}/{folder}".rstrip("/")
        reader = spark.read.format(version.format).schema(schema).option("basePath", base)
        frames.append(reader.load([f"{base}/{p}".rstrip("/") for p in parts]).select(*[col(c) for c in schema.names]))
    return reduce(DataFrame.unionAll, frames) if frames else spark.createDataFrame([], schema)


def _plain(spark: SparkSession, path: str, format: str, parts: list[str], source: DataFrame) -> Version:
    """A folder of plain files as the version before the first."""
    found = spark.read.format(format).load(path)
    # Folder names are text: without the source's types, "007" would be read back as 7.
    schema = StructType([StructField(f.name, source.schema[f.name].dataType) if f.name in parts else f for f in found.schema])
    return Version(0, format, schema, {"": folders_of(spark, found.inputFiles(), path)}, parts, None, [])


def upsert_version(
    source: DataFrame,
    path: str,
    keys: str | Iterable[str],
    format: str = "parquet",
    partition_by: str | Iterable[str] | None = None,
    buckets: int | None = None,
    order_by: str | Iterable[str] | None = None,
    target_unique: bool = False,
    newest_wins: bool = False,
    counted: Observation | None = None,
) -> Version:
    """Upsert ``source`` into a table of versions and publish the next one.

    ``buckets`` (fixed when the table is made) lays rows out by a hash of the key: then, or when every partition column is a key,
    only the parts that ``source`` has rows for are read, merged and written again; the next version
    takes the others from where they are. A table of plain files becomes one of versions. The
    source is computed once, into the shared folder. Two writers at once: one of them raises, and
    the table is that of the other.
    """
    spark, keys, parts, path = source.sparkSession, names(keys), names(partition_by), path.rstrip("/")
    if not keys:
        raise ValueError("upsert_version: keys are required")
    require_columns(source, [*keys, *parts], "upsert_version")
    head = table_version(spark, path)
    if head is None and path_exists(spark, path) and children(spark, path):
        head = _plain(spark, path, format, parts, source)
        if buckets:
            raise ValueError(f"upsert_version: {path} holds plain files; buckets are laid out when a table is made")
    if head is not None and head.number:
        given = (buckets or head.buckets, parts or head.parts, head.format)
        if given != (head.buckets, head.parts, format):
            raise ValueError(f"upsert_version: {path} has buckets {head.buckets}, partitions {head.parts}, format {head.format}")
        if head.buckets and keys != head.keys:
            raise ValueError(f"upsert_version: {path} is laid out by {head.keys}, not by {keys}")
        buckets, parts = head.buckets, head.parts
    if buckets and parts:
        raise ValueError("upsert_version: give buckets or partition columns, not both")

    incoming = shared_path(spark, "merge-source")
    source.write.parquet(incoming)
    source = spark.read.schema(source.schema).parquet(incoming)
    layout = [BUCKET] if buckets else parts
    # The stored types decide where a key lies, whatever types a later batch brings.
    kinds = {f.name: f.dataType for f in (head.schema if head is not None else source.schema)}
    if buckets:
        key = F.xxhash64(*[col(k).cast(kinds.get(k, source.schema[k].dataType)) for k in keys])
        source = source.withColumn(BUCKET, F.pmod(key, F.lit(buckets)).cast("int"))
    narrow = bool(buckets) or (bool(parts) and set(parts) <= set(keys))
    if head is None:
        merged = merge(source, source.filter(F.lit(False)), keys, order_by)
    else:
        target = _rows(spark, path, head)
        if narrow:
            target = touched(target, source, layout)
        merged = merge(source, target, keys, order_by, target_unique or bool(buckets), newest_wins)

    number = head.number + 1 if head is not None else 1
    folder = f"{VERSIONS}/{number:08d}-{uuid.uuid4().hex}"
    rows = merged if counted is None else merged.observe(counted, F.count(F.lit(1)).alias("rows"))
    writer = rows.hint("rebalance", *[col(p) for p in layout]).write.format(format) if layout else rows.write.format(format)
    (writer.partitionBy(*layout) if layout else writer).save(f"{path}/{folder}")
    files = spark.read.format(format).schema(merged.schema).load(f"{path}/{folder}").inputFiles()
    new = folders_of(spark, files, f"{path}/{folder}")
    folders = {}
    if head is not None and narrow:
        folders = {f: [p for p in own if p not in set(new)] for f, own in head.folders.items()}
    folders = {f: own for f, own in {**folders, folder: new}.items() if own}
    schema = StructType([f for f in merged.schema if f.name != BUCKET])
    version = Version(number, format, schema, folders, parts, buckets, keys)
    try:
        publish_version(spark, path, version)
    except RuntimeError:
        discard(spark, f"{path}/{folder}")
        raise
    finally:
        discard(spark, incoming)
    clean_versions(spark, path)
    return version


def publish_version(spark: SparkSession, path: str, version: Version) -> None:
    """Make ``version`` the current one, unless another writer took its number."""
    try:
        publish_small(spark, f"{path}/{VERSIONS}/{version.number:08d}.json", version.text())
    except FileExistsError as error:
        raise RuntimeError(f"{path}: version {version.number} was made by another writer meanwhile") from error


def clean_versions(spark: SparkSession, path: str, keep: int = KEPT_VERSIONS) -> None:
    """Remove all but the last ``keep`` pointers, and folders none of these names."""
    path = path.rstrip("/")
    numbers = _pointers(spark, path)
    gone, stay = numbers[:-keep], numbers[-keep:]
    if not gone:
        return
    alive = {f for n in stay for f in Version.of(read_small(spark, f"{path}/{VERSIONS}/{n:08d}.json")).folders}
    for n in gone:  # the pointer first: from then on nothing leads to its folders
        discard(spark, f"{path}/{VERSIONS}/{n:08d}.json")
    for name in children(spark, f"{path}/{VERSIONS}"):
        # A folder of a later number may belong to a writer at work.
        if "-" in name and int(name.split("-")[0]) <= stay[-1] and f"{VERSIONS}/{name}" not in alive:
            discard(spark, f"{path}/{VERSIONS}/{name}")
    if "" not in alive:  # the plain files the table once was
        for name in children(spark, path):
            if name != VERSIONS:
                discard(spark, f"{path}/{name}")


#: Partitions up to which a merge names them in the target's scan.
NAMED_PARTITIONS = 1000


def touched(target: DataFrame, source: DataFrame, parts: list[str], limit: int = NAMED_PARTITIONS) -> DataFrame:
    """Target rows in partitions that ``source`` has rows for, null partitions included.

    A limited number of partitions becomes a filter on the partition columns, which the scan
    prunes by; beyond it a semi join decides.
    """
    values = source.select(*[col(p) for p in parts]).distinct()
    named = values.take(limit + 1)
    if len(named) > limit:
        same = reduce(lambda a, b: a & b, [col(p, "t").eqNullSafe(col(p, "s")) for p in parts])
        return target.alias("t").join(values.alias("s"), same, "left_semi")
    tests = [reduce(lambda a, b: a & b, [col(p).eqNullSafe(F.lit(row[p])) for p in parts]) for row in named]
    return target.filter(reduce(lambda a, b: a | b, tests, F.lit(False)))
