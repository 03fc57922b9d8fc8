"""Tables of versions, bucketed upserts, retention on stored tables, increments that remember."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemill.sources import (
    clean_versions,
    load_increment,
    merge_into_table,
    purge_table,
    read_table,
    table_version,
    versions,
    write_csv,
    write_table,
)
from tidemill.sources.retention import period
from tidemill.streaming import drain_merge, stream_files

SCHEMA = "k long, part string, x int"


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def files_of(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}


def live_folders(spark, path):
    return {f"{folder}/{part}" for folder, parts in table_version(spark, path).folders.items() for part in parts}


# --- versions ---


def test_a_reader_between_the_steps_sees_the_old_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    write_table(frame(spark, [(1, "a", 1), (2, "b", 2)]), path, partition_by="part")
    before = read_table(spark, path)
    seen = []
    publish = versions.publish_small

    def watched(*args):
        seen.append(rows(read_table(spark, path).select("k", "part", "x")))
        publish(*args)
        seen.append(rows(read_table(spark, path).select("k", "part", "x")))

    monkeypatch.setattr(versions, "publish_small", watched)
    merge_into_table(frame(spark, [(2, "c", 20), (3, None, 3)]), path, "k", partition_by="part", atomic=True)
    assert seen == [[(1, "a", 1), (2, "b", 2)], [(1, "a", 1), (2, "c", 20), (3, None, 3)]]
    assert rows(before.select("k", "part", "x")) == seen[0]  # planned before, read after


def test_a_writer_that_dies_leaves_the_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    merge_into_table(frame(spark, [(1, "a", 1)]), path, "k", buckets=4)

    def dies(*_):
        raise OSError("gone")

    with monkeypatch.context() as broken:
        broken.setattr(versions, "publish_small", dies)
        with pytest.raises(OSError, match="gone"):
            merge_into_table(frame(spark, [(1, "a", 2)]), path, "k")
    assert rows(read_table(spark, path)) == [(1, "a", 1)]
    merge_into_table(frame(spark, [(1, "a", 3)]), path, "k")
    assert rows(read_table(spark, path)) == [(1, "a", 3)] and table_version(spark, path).number == 2


def test_two_writers_cannot_make_the_same_version(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    merge_into_table(frame(spark, [(1, "a", 1)]), path, "k", buckets=4)
    publish = versions.publish_small

    def late(spark, at, text):
        monkeypatch.setattr(versions, "publish_small", publish)
        merge_into_table(frame(spark, [(5, "b", 5)]), path, "k")
        publish(spark, at, text)

    monkeypatch.setattr(versions, "publish_small", late)
    with pytest.raises(RuntimeError, match="another writer"):
        merge_into_table(frame(spark, [(1, "a", 2)]), path, "k")
    assert rows(read_table(spark, path)) == [(1, "a", 1), (5, "b", 5)]


def test_a_batch_rewrites_only_its_buckets(spark, tmp_path):
    path = str(tmp_path / "t")
    merge_into_table(spark.range(1000).select(F.col("id").alias("k"), F.lit("p").alias("part"), F.lit(0).alias("x")), path, "k", buckets=16)
    first, before = live_folders(spark, path), files_of(path)
    assert len(first) == 16
    merge_into_table(frame(spark, [(7, "q", 1), (7, "q", 1)]), path, "k")
    after = files_of(path)
    changed = {f: t for f, t in after.items() if before.get(f) != t}
    assert len(changed) == 1 and all(after[f] == t for f, t in before.items())
    assert len(live_folders(spark, path) & first) == 15
    got = read_table(spark, path)
    assert got.count() == 1000 and got.columns == ["k", "part", "x"]
    assert rows(got.filter("x = 1")) == [(7, "q", 1)]


def test_narrow_merges_take_the_other_partitions_over(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(frame(spark, [(1, "007", 1), (2, "8", 2), (3, None, 3), (4, "a=b/c d%", 4)]), path, partition_by="part")
    for _ in range(2):
        merge_into_table(frame(spark, [(1, "007", 10), (5, None, 5)]), path, "k,part", partition_by="part", atomic=True)
    folders = table_version(spark, path).folders
    assert folders[""] and len(folders) == 2
    want = [(1, "007", 10), (2, "8", 2), (3, None, 3), (4, "a=b/c d%", 4), (5, None, 5)]
    assert rows(read_table(spark, path).select("k", "part", "x")) == sorted(want, key=repr)


def test_batches_may_add_columns_and_bring_other_types(spark, tmp_path):
    path = str(tmp_path / "t")
    merge_into_table(frame(spark, [(1, "a", 1), (None, "n", 0)]), path, "k", buckets=8)
    merge_into_table(spark.createDataFrame([(1, "new"), (None, "null")], "k int, note string"), path, "k")
    assert rows(read_table(spark, path).select("k", "part", "x", "note")) == sorted([(1, None, None, "new"), (None, None, None, "null")], key=repr)
    with pytest.raises(ValueError, match="buckets"):
        merge_into_table(frame(spark, [(1, "a", 1)]), path, "k", buckets=9)
    with pytest.raises(ValueError, match="laid out"):
        merge_into_table(frame(spark, [(1, "a", 1)]), path, "k,part")


def test_old_versions_go(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(frame(spark, [(1, "a", 1)]), path)
    for x in range(2, 8):
        merge_into_table(frame(spark, [(1, "a", x)]), path, "k", atomic=True)
    pointers = [p.name for p in (tmp_path / "t" / "_versions").glob("*.json")]
    folders = [p for p in (tmp_path / "t" / "_versions").iterdir() if p.is_dir()]
    assert len(pointers) == versions.KEPT_VERSIONS == len(folders)
    assert [p.name for p in (tmp_path / "t").iterdir()] == ["_versions"]  # the plain files are no longer named
    clean_versions(spark, path, keep=1)
    assert rows(read_table(spark, path)) == [(1, "a", 7)]


def test_empty_batches_and_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    merge_into_table(frame(spark, []), path, "k", buckets=4)
    assert rows(read_table(spark, path)) == []
    merge_into_table(frame(spark, [(1, "a", 1)]), path, "k")
    merge_into_table(frame(spark, []), path, "k")
    assert rows(read_table(spark, path)) == [(1, "a", 1)]


def test_streamed_batches_rewrite_their_buckets(spark, tmp_path):
    feed, path = str(tmp_path / "feed"), str(tmp_path / "t")
    for start in (0, 3, 6):
        frame(spark, [(k, "s", start) for k in range(start, start + 4)]).coalesce(1).write.mode("append").parquet(feed)
    stream = stream_files(spark, feed, frame(spark, []).schema, files_per_batch=1)
    drain_merge(stream, path, str(tmp_path / "checkpoint"), "k", order_by="x", buckets=4)
    assert rows(read_table(spark, path)) == sorted((k, "s", max(s for s in (0, 3, 6) if s <= k < s + 4)) for k in range(10))


# --- retention ---


def days(spark, path):
    start = dt.datetime(2024, 3, 1)
    moments = [start + dt.timedelta(hours=5 * h) for h in range(40)]
    data = [(i, m, m.strftime("%Y-%m-%d")) for i, m in enumerate(moments)]
    write_table(spark.createDataFrame([*data, (99, None, None), (98, None, "2024-03-01"), (97, None, "2024-03-04")], "k long, ts timestamp_ntz, day string"), path, partition_by="day")
    return data


def test_purge_drops_folders_and_rewrites_the_boundary(spark, tmp_path):
    path = str(tmp_path / "t")
    data = days(spark, path)
    before = files_of(path)
    done = purge_table(spark, path, "day", "ts", "2024-03-04 12:00:00")
    assert done.dropped == ["day=2024-03-01", "day=2024-03-02", "day=2024-03-03"] and done.rewritten == ["day=2024-03-04"]
    after = files_of(path)
    assert not [f for f in after if f.startswith(("day=2024-03-01", "day=2024-03-02", "day=2024-03-03"))]
    untouched = {f: t for f, t in before.items() if f.split("/")[0] in done.untouched}
    assert untouched and all(after[f] == t for f, t in untouched.items())
    left = {r.k for r in spark.read.parquet(path).collect()}
    assert left == {k for k, ts, _ in data if ts >= dt.datetime(2024, 3, 4, 12)} | {99, 97}
    again = purge_table(spark, path, "day", "ts", dt.datetime(2024, 3, 4, 12))
    assert again.dropped == [] and {r.k for r in spark.read.parquet(path).collect()} == left


def test_purge_of_a_table_of_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    days(spark, path)
    merge_into_table(spark.createDataFrame([(500, dt.datetime(2024, 3, 4, 13), "2024-03-04")], "k long, ts timestamp_ntz, day string"), path, "k,day", partition_by="day", atomic=True)
    old = read_table(spark, path)
    n = old.count()
    purge_table(spark, path, "day", "ts", "2024-03-04 12:00:00")
    assert old.count() == n  # who planned before still reads
    left = read_table(spark, path)
    assert left.filter("ts < '2024-03-04 12:00:00'").count() == 0
    assert left.filter("k = 500").count() == 1 and left.filter("ts IS NULL").count() == 2


def test_purge_refuses_what_is_no_period(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.createDataFrame([(1, dt.datetime(2000, 1, 1), "2000"), (2, dt.datetime(2000, 1, 1), "old")], "k long, ts timestamp_ntz, day string"), path, partition_by="day")
    with pytest.raises(ValueError, match="no year"):
        purge_table(spark, path, "day", "ts", "2024-01-01")
    assert spark.read.parquet(path).count() == 2
    assert period("2023-12") == (dt.datetime(2023, 12, 1), dt.datetime(2024, 1, 1)) and period("2024")[1] == dt.datetime(2025, 1, 1)
    assert period("2024-02-29")[1] == dt.datetime(2024, 3, 1) and period("2024-02-29-23")[1] == dt.datetime(2024, 3, 1)


# --- increments ---


@pytest.mark.parametrize("kind", ["long", "date", "timestamp", "timestamp_ntz", "decimal(20,3)", "string"])
def test_late_rows_at_the_mark_load_once(spark, tmp_path, kind):
    def feed(data):
        day = F.date_add(F.lit("2024-01-01").cast("date"), F.col("m"))
        values = {"long": F.col("m"), "string": F.col("m").cast("string"), "decimal(20,3)": F.col("m")}
        return spark.createDataFrame(data, "k long, m int").select("k", values.get(kind, day).cast(kind).alias("at"))

    def load(data):
        found = load_increment(feed(data), str(tmp_path / "state"), "at")
        keys = sorted(r.k for r in found.rows.collect())
        found.commit()
        return keys

    first = [(1, 1), (2, 2), (3, 2), (4, None)]
    assert load(first) == [1, 2, 3, 4]
    second = [*first, (5, 2), (6, None), (7, 1)]  # late at the mark, late without a time, too late
    assert load(second) == [5, 6]
    assert load(second) == []
    third = [*second, (8, 3), (9, 2), (10, None)]
    assert load(third) == [8, 9, 10]
    assert load([*third, (11, 3), (12, 2)]) == [11]  # the mark has moved on before 12 came


def test_an_increment_that_is_not_committed_comes_again(spark, tmp_path):
    source = spark.createDataFrame([(1, 5), (1, 5), (2, None)], "k long, at int")
    state = str(tmp_path / "state")
    assert load_increment(source.filter("k > 9"), state, "at").rows.count() == 0
    assert load_increment(source, state, "at").rows.count() == 3
    found = load_increment(source, state, "at")
    found.commit()
    assert found.rows.count() == 3 and load_increment(source, state, "at").rows.count() == 0
    with pytest.raises(ValueError, match="not found"):
        load_increment(source, state, "none")


# --- single files ---


def test_single_file_keeps_the_order_of_rows(spark, tmp_path):
    path = str(tmp_path / "one.csv")
    write_csv(spark.range(0, 1000, numPartitions=7).orderBy(F.desc("id")), path, single_file=True)
    lines = Path(path).read_text().splitlines()
    assert lines[0] == "id" and [int(x) for x in lines[1:]] == list(range(999, -1, -1))
    write_csv(spark.range(0), path, single_file=True)
    assert Path(path).read_text().splitlines() == ["id"]
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["one.csv"]
