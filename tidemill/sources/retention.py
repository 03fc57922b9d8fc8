"""Retention on stored tables: old partitions go by their names, only the one at the boundary is read."""

from __future__ import annotations

import datetime as dt
import re
import uuid
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..functions import col
from .files import children, discard, hadoop
from .versions import VERSIONS, Version, clean_versions, publish_version, table_version

#: Fixed value: the folder of rows whose partition value is null.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


@dataclass
class Purge:
    """What a purge did, by partition value."""

    dropped: list[str] = field(default_factory=list)
    rewritten: list[str] = field(default_factory=list)
    untouched: list[str] = field(default_factory=list)


def period(value: str) -> tuple[dt.datetime, dt.datetime]:
    """First moment of a year, month, day or hour (``2024``, ``2024-03``, ``2024-03-01``, ``2024-03-01-13``), and of the next one."""
    parts = [int(p) for p in re.split("[-T ]", value)] if re.fullmatch(r"\d{4}(-\d{2}(-\d{2}([-T ]\d{2})?)?)?", value) else []
    if not parts:
        raise ValueError(f"purge_table: partition value {value!r} is no year, month, day or hour")
    start = dt.datetime(*(parts + [1, 1])[: max(len(parts), 3)] if len(parts) < 3 else parts)
    if len(parts) == 1:
        return start, dt.datetime(parts[0] + 1, 1, 1)
    if len(parts) == 2:
        return start, dt.datetime(parts[0] + parts[1] // 12, parts[1] % 12 + 1, 1)
    return start, start + (dt.timedelta(days=1) if len(parts) == 3 else dt.timedelta(hours=1))


def purge_table(
    spark: SparkSession, path: str, partition: str, time: str, keep_from: str | dt.datetime, format: str = "parquet"
) -> Purge:
    """Remove rows whose ``time`` is before ``keep_from`` from a table partitioned by the period of ``time``.

    A partition (``day=2024-03-01``; years, months and hours likewise) that ends before the moment is dropped by
    its folder, unread; one that begins later is left alone; only the one in which the moment lies is read and
    written again. Rows without a time, and those in the null partition, stay: their age is not known. A
    folder whose name is no period raises before anything is removed.

    A table of versions gets a next version, so readers see it before or after. Plain folders go one
    by one; a purge that stops half-way is finished by the next one.
    """
    path = path.rstrip("/")
    moment = dt.datetime.fromisoformat(keep_from) if isinstance(keep_from, str) else keep_from
    head = table_version(spark, path)
    if head is None:
        folders = {"": [n for n in children(spark, path) if n.startswith(f"{partition}=")]}
    else:
        folders = head.folders
    done, boundary, left = Purge(), [], {f: [] for f in folders}
    for folder, parts in folders.items():
        for part in parts:
            value = part.split("/")[0].removeprefix(f"{partition}=")
            if value != NULL_FOLDER:
                start, end = period(value)
                if end <= moment:
                    done.dropped.append(part)
                    continue
                if start < moment:
                    boundary.append((folder, part))
                    done.rewritten.append(part)
                    continue
            left[folder].append(part)
            done.untouched.append(part)
    rewritten = f"{VERSIONS}/{(head.number + 1 if head else 0):08d}-{uuid.uuid4().hex}"
    for folder, part in boundary:
        rows = spark.read.format(format).load(f"{path}/{folder}/{part}" if folder else f"{path}/{part}")
        young = (col(time) >= F.lit(moment.isoformat(" ")).cast(rows.schema[time].dataType)) | col(time).isNull()
        rows.filter(young).write.format(format).save(f"{path}/{rewritten}/{part}")
    if head is not None:
        kept = {**left, rewritten: [p for _, p in boundary]}
        following = Version(
            head.number + 1, head.format, head.schema, {f: own for f, own in kept.items() if own}, head.parts, head.buckets, head.keys
        )
        publish_version(spark, path, following)
        clean_versions(spark, path)
        return done
    for part in done.dropped:
        discard(spark, f"{path}/{part}")
    for _, part in boundary:
        fs, new = hadoop(spark, f"{path}/{rewritten}/{part}")
        discard(spark, f"{path}/{part}")
        if not fs.rename(new, hadoop(spark, f"{path}/{part}")[1]):
            raise OSError(f"purge_table: {path}/{rewritten}/{part} could not be moved; it holds the rows of {part} that stay")
    if boundary:
        discard(spark, f"{path}/{rewritten}")
    return done
