"""Target writers: delimited text, partitioned tables, databases, merge into files."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable
from typing import Any

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..functions import col, flag, fresh, names, require_columns
from ..operators.merge import merge
from ..session import shared_path
from .files import children, discard, hadoop, path_exists
from .readers import NULL_MARK
from .versions import NAMED_PARTITIONS, table_version, touched, upsert_version

MODES = ("append", "overwrite", "ignore", "error", "errorifexists")

#: Compressions of which files may be put one behind the other.
JOINABLE = {None: "", "none": "", "uncompressed": "", "gzip": ".gz", "bzip2": ".bz2"}


def _counting(df: DataFrame, counted: Observation | None) -> DataFrame:
    """Count the rows as they are written. Only for a plan that is executed exactly once."""
    return df if counted is None else df.observe(counted, F.count(F.lit(1)).alias("rows"))


def check_mode(mode: str) -> str:
    if mode.lower() not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    return mode.lower()


def dated(path: str, run_time: dt.datetime | None) -> str:
    """Fill ``%Y``, ``%m``, ``%d``, ``%H``, ``%M`` and ``%S`` in a target path from the run's time."""
    return path if run_time is None else re.sub(r"%[YmdHMS]", lambda found: run_time.strftime(found[0]), path)


def write_csv(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    header: bool | str = True,
    compression: str | None = None,
    delimiter: str = ",",
    single_file: bool | str = False,
    run_time: dt.datetime | None = None,
    counted: Observation | None = None,
    quote: str = '"',
    escape: str = '"',
    encoding: str = "UTF-8",
    null_value: str | None = None,
    empty_value: str = '""',
    rows_per_file: int | str = 1_000_000,
) -> None:
    """Delimited text in a folder, at least one file per task, or in one file.

    Values keep their blanks, quotes, delimiters and line breaks; a quote inside a value is
    doubled. A null is written as nothing and an empty text as ``""``, which :func:`read_csv`
    tells apart. A table of one column has no place for "nothing" (its line would be blank), so
    its nulls are written as ``NULL_MARK``. A file whose values hold line breaks is read by one
    task, so files end after ``rows_per_file`` rows.

    ``single_file`` makes ``path`` one file of any size, rows in their order. Rows are computed in parallel into the shared
    folder; one task, as one file has one writer, sorts them by their place (spilling) and writes
    them, and the driver only renames the result. It cannot be appended to, and takes no compression but
    gzip and bzip2.
    """
    mode, path = check_mode(mode), dated(path, run_time)
    single = flag(single_file, False)
    if null_value is None:
        null_value = NULL_MARK if len(df.columns) == 1 else ""
    settings = {
        "sep": delimiter,
        "quote": quote,
        "escape": escape,
        "encoding": encoding,
        "nullValue": null_value,
        "emptyValue": empty_value,
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
    }
    if compression:
        settings["compression"] = compression
    if not single:
        out = _counting(df, counted).write.mode(mode).options(**settings)
        out.option("header", flag(header, True)).option("maxRecordsPerFile", int(rows_per_file)).csv(path)
        return
    if mode == "append":
        raise ValueError("write_csv: a single file cannot be appended to")
    if compression not in JOINABLE or encoding.upper() in ("UTF-16", "UTF-32"):
        raise ValueError("write_csv: a single file takes gzip, bzip2 or no compression, and no encoding with a byte-order mark")
    spark = df.sparkSession
    fs, final = hadoop(spark, path)
    if mode != "overwrite" and fs.exists(final):
        if mode == "ignore":
            return
        raise FileExistsError(path)
    # Rows are computed in parallel, with their place; one task puts them in order and writes the file.
    place = fresh("row_place", df.columns)
    staged, folder = shared_path(spark, "csv-rows"), f"{path}.parts-{dt.datetime.now(dt.timezone.utc):%Y%m%d%H%M%S%f}"
    _counting(df, counted).withColumn(place, F.monotonically_increasing_id()).write.parquet(staged)
    rows = spark.read.parquet(staged).repartition(1).sortWithinPartitions(place).select(*[col(c) for c in df.columns])
    rows.write.options(**settings).option("header", flag(header, True)).csv(folder)
    parts = [n for n in children(spark, folder) if n.startswith("part-")]
    if not parts:  # no rows: nothing but the header
        spark.createDataFrame([], df.schema).coalesce(1).write.mode("overwrite").options(**settings).option("header", flag(header, True)).csv(folder)
        parts = [n for n in children(spark, folder) if n.startswith("part-")]
    if fs.exists(final):
        fs.delete(final, True)
    fs.mkdirs(final.getParent())
    if not fs.rename(hadoop(spark, f"{folder}/{parts[0]}")[1], final):
        raise OSError(f"could not move {folder}/{parts[0]} to {path}")
    discard(spark, folder)
    discard(spark, staged)


def table_path(root: str, table: str) -> str:
    """``staging.cards`` lives under ``<root>/hive/staging/cards``."""
    return f"{root.rstrip('/')}/hive/{table.replace('.', '/')}"


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "append",
    format: str = "parquet",
    partition_by: str | Iterable[str] | None = None,
    dynamic: bool = False,
    cluster: bool = False,
    run_time: dt.datetime | None = None,
    counted: Observation | None = None,
) -> None:
    """Path-based table. ``dynamic`` overwrites only the partitions that ``df`` holds.

    ``cluster`` shuffles rows by partition value first, so a partition gets few files. Adaptive
    execution cuts the partition of a huge value by its measured size, so it is written by as
    many tasks as it needs, and merges small ones.
    """
    mode, parts = check_mode(mode), names(partition_by)
    require_columns(df, parts, "write_table")
    if cluster and parts:
        df = df.hint("rebalance", *[col(p) for p in parts])
    writer = _counting(df, counted).write.mode(mode).format(format)
    if parts:
        writer = writer.partitionBy(*parts)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.save(dated(path, run_time))


def merge_into_table(
    source: DataFrame,
    path: str,
    keys: str | Iterable[str],
    format: str = "parquet",
    partition_by: str | Iterable[str] | None = None,
    order_by: str | Iterable[str] | None = None,
    target_unique: bool = False,
    counted: Observation | None = None,
    newest_wins: bool = False,
    atomic: bool | str = False,
    buckets: int | str | None = None,
) -> None:
    """Upsert ``source`` into a path-based table, source rows winning, or with ``newest_wins`` the row
    of a key that is last by ``order_by``, whichever side it is on.

    The source is computed once, into the shared folder: both the choice of partitions and the
    rows come from that copy, so they agree even if the source would give other rows a second
    time.

    Files cannot be replaced while they are read, so the merged rows are first written to the
    shared folder and then swapped in; after a crash in between, that copy is still there and
    complete. It is removed after the swap. This swap is not atomic: who reads the table meanwhile
    may see a part of it. ``atomic`` keeps the table in versions instead (:mod:`.versions`), as do ``buckets``, a
    layout by hash of the key in which a merge only rewrites the buckets it meets; both are read with
    :func:`~tidemill.sources.versions.read_table`, and once a table has versions every merge adds one.

    When every partition column is also a key, a row cannot change partition: only the
    partitions that ``source`` touches are read and rewritten, the others stay as they are.
    Otherwise the whole table is. ``target_unique`` (a table that only merges have written) spares
    the shuffle of the target, see :func:`~tidemill.operators.merge.merge`.
    """
    spark, keys, parts = source.sparkSession, names(keys), names(partition_by)
    if not keys:
        raise ValueError("merge_into_table: keys are required")
    if buckets or flag(atomic, False) or table_version(spark, path) is not None:
        laid_out = int(buckets) if buckets else None
        upsert_version(source, path, keys, format, parts, laid_out, order_by, target_unique, newest_wins, counted)
        return
    if not path_exists(spark, path):
        first = merge(source, source.filter(F.lit(False)), keys, order_by)
        write_table(first, path, "error", format, parts, counted=counted)
        return
    incoming = shared_path(spark, "merge-source")
    source.write.parquet(incoming)
    source = spark.read.schema(source.schema).parquet(incoming)
    # Folder names are text: without the source's types, "007" would be read back as 7.
    found = spark.read.format(format).load(path).schema
    typed = [StructField(f.name, source.schema[f.name].dataType) if f.name in parts else f for f in found]
    target = spark.read.format(format).schema(StructType(typed)).load(path)
    narrow = bool(parts) and set(parts) <= set(keys)
    if narrow:
        target = touched(target, source, parts, NAMED_PARTITIONS)
    staged = shared_path(spark, "merge-stage")
    _counting(merge(source, target, keys, order_by, target_unique, newest_wins), counted).write.format(format).save(staged)
    write_table(spark.read.format(format).load(staged), path, "overwrite", format, parts, dynamic=narrow)
    discard(spark, staged)
    discard(spark, incoming)


def jdbc_write_options(
    url: str,
    table: str,
    mode: str = "append",
    user: str | None = None,
    password: str | None = None,
    isolation_level: str | None = None,
    batch_size: int | str | None = None,
    column_types: str | None = None,
    num_partitions: int | str | None = None,
    driver: str | None = None,
) -> tuple[str, dict[str, str]]:
    """Save mode and Spark JDBC options. ``truncateInsert`` empties the table, keeping its DDL."""
    truncate = mode.lower() == "truncateinsert"
    wanted = {
        "url": url,
        "dbtable": table,
        "user": user,
        "password": password,
        "isolationLevel": isolation_level,
        "batchsize": batch_size,
        "createTableColumnTypes": column_types,
        "numPartitions": num_partitions,
        "driver": driver,
        "truncate": "true" if truncate else None,
    }
    return ("overwrite" if truncate else check_mode(mode)), {k: str(v) for k, v in wanted.items() if v is not None}


def write_database(
    df: DataFrame, url: str, table: str, counted: Observation | None = None, **options: Any
) -> None:
    """Append (default), overwrite or ``truncateInsert`` a table over JDBC."""
    mode, settings = jdbc_write_options(url, table, **options)
    _counting(df, counted).write.mode(mode).format("jdbc").options(**settings).save()
