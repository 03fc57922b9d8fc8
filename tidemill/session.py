"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings the library is tuned for; a cluster adds its own sizes on top.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split hot join partitions even where that costs one more exchange above the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Streaming state on disk, so that it may outgrow an executor's memory.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


#: Bytes one shuffle partition should hold: well within a task's memory before it spills.
PARTITION_BYTES = 256 * 1024**2


def shuffle_partitions(moved_bytes: int, cores: int) -> int:
    """Partitions for a shuffle of ``moved_bytes``: sized for memory, at least two per core.

    Adaptive execution merges small neighbours afterwards, so the number may be generous; too
    few partitions cannot be mended the same way.
    """
    return min(max(-(-moved_bytes // PARTITION_BYTES), 2 * cores), 200_000)


def tune(spark: SparkSession, moved_bytes: int | None = None) -> SparkSession:
    """Apply ``SETTINGS`` to a running session; all of them can change at run time.

    ``moved_bytes`` is the size of the largest shuffle to expect; given, it sets the number of
    shuffle partitions, which Spark otherwise leaves at the session's value.
    """
    wanted = dict(SETTINGS)
    if moved_bytes is not None:
        wanted["spark.sql.shuffle.partitions"] = str(
            shuffle_partitions(moved_bytes, spark.sparkContext.defaultParallelism)
        )
    for key, value in wanted.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(app: str = "tidemill", cores: str = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", os.environ.get("TIDEMILL_DRIVER_MEMORY", "8g"))
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_root: str | None = None


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Where the setting is absent and the master is local (tests), a temporary folder stands
    in for it. On a cluster an absent setting is an error: a machine-local folder would be
    lost with its executor.
    """
    global _local_root
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="tidemill-")
    return _local_root


def shared_path(spark: SparkSession, name: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


_staged: list[str] = []


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, whatever reads it, and not lost with an executor.

    The copy stays until ``release_staged``, as a result may be read at any later time.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    _staged.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release_staged(spark: SparkSession) -> int:
    """Remove all copies ``staged`` has made, once no result that reads them is needed; returns their number."""
    done = 0
    while _staged:
        where = spark._jvm.org.apache.hadoop.fs.Path(_staged.pop())
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
        done += 1
    return done
