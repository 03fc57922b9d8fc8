"""Source readers: delimited text, columnar files, JSON references, databases, SQL."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from ..functions import col, flag, names, require_columns

CORRUPT = "_corrupt_record"

#: Stands for "nothing between two delimiters"; two private-use characters keep it apart from any text.
NULL_MARK = "\ue000null\ue000"


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    header: bool | str = True,
    delimiter: str = ",",
    schema: StructType | str | None = None,
    infer_schema: bool | str = False,
    date_format: str | None = None,
    keep_bad_rows: bool = False,
    quote: str = '"',
    escape: str = '"',
    multi_line: bool | str = True,
    encoding: str = "UTF-8",
    null_value: str | None = None,
    empty_value: str = "",
    line_sep: str | None = None,
) -> DataFrame:
    """Delimited text from a file, folder or glob.

    Without ``schema`` or ``infer_schema`` every column is a string. With a schema a bad
    value fails the job; ``keep_bad_rows`` keeps such rows instead, the raw text in
    ``_corrupt_record``. A schema avoids the extra pass that inference costs.

    Quoted values may hold line breaks, and a quote inside one is doubled. Such a file is read
    by one task: where no value holds a line break, ``multi_line=False`` lets a huge
    uncompressed file be split. Lines end as the first one of a file does; ``line_sep`` names the
    ending and so keeps any other line break inside values as it is.

    Nothing between two delimiters is null, and a quoted empty text is an empty text.
    ``null_value`` is the text that means null instead; ``""`` makes both kinds of empty null.
    """
    reader = spark.read.option("header", flag(header, True)).option("sep", delimiter)
    reader = reader.options(quote=quote, escape=escape, encoding=encoding, emptyValue=empty_value)
    reader = reader.options(multiLine=flag(multi_line, True), nullValue=NULL_MARK if null_value is None else null_value)
    if line_sep:
        reader = reader.option("lineSep", line_sep)
    if date_format:
        reader = reader.option("dateFormat", date_format)
    if schema is None:
        if keep_bad_rows:
            raise ValueError("read_csv: keep_bad_rows needs a schema")
        return reader.option("inferSchema", flag(infer_schema, False)).csv(path)
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    if not keep_bad_rows:
        return reader.schema(schema).option("mode", "FAILFAST").csv(path)
    wide = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    return reader.schema(wide).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).csv(path)


def read_files(
    spark: SparkSession,
    path: str | list[str],
    format: str | None = None,
    schema: StructType | str | None = None,
    **options: Any,
) -> DataFrame:
    """Parquet, ORC, JSON or CSV files; the format follows the suffix unless given.

    This is also the file stand-in for a database source: ``.parquet`` is read as Parquet,
    anything unknown as CSV with a header.
    """
    first = path if isinstance(path, str) else path[0]
    kind = format or {"parquet": "parquet", "orc": "orc", "json": "json"}.get(first.rsplit(".", 1)[-1].lower(), "csv")
    if kind == "csv":
        return read_csv(spark, path, schema=schema, **options)
    reader = spark.read.format(kind).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def read_reference(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """A reference table kept as one JSON array of records. A missing file raises."""
    reader = spark.read.option("multiLine", True).option("mode", "FAILFAST")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def jdbc_read_options(
    url: str,
    table: str | None = None,
    query: str | None = None,
    user: str | None = None,
    password: str | None = None,
    fetch_size: int | str | None = None,
    partition_column: str | None = None,
    lower_bound: Any = None,
    upper_bound: Any = None,
    num_partitions: int | str | None = None,
    driver: str | None = None,
) -> dict[str, str]:
    """Spark JDBC options for a table or a query, checked before any connection is made."""
    if bool(table) == bool(query):
        raise ValueError("database source: give exactly one of table and sql")
    split = (partition_column, lower_bound, upper_bound, num_partitions)
    if any(v is not None for v in split) and any(v is None for v in split):
        raise ValueError("database source: a split read needs partition column, both bounds and the partition count")
    source = table
    if query:
        # Spark refuses `query` together with a partition column; a derived table is the same read.
        source = f"({query}) source_query" if partition_column else None
    wanted = {
        "url": url,
        "dbtable": source,
        "query": None if source else query,
        "user": user,
        "password": password,
        "fetchsize": fetch_size,
        "partitionColumn": partition_column,
        "lowerBound": lower_bound,
        "upperBound": upper_bound,
        "numPartitions": num_partitions,
        "driver": driver,
    }
    return {k: str(v) for k, v in wanted.items() if v is not None}


def read_database(spark: SparkSession, url: str, **options: Any) -> DataFrame:
    """Table or query over JDBC; name a partition column and bounds to read in parallel."""
    return spark.read.format("jdbc").options(**jdbc_read_options(url, **options)).load()


def read_sql(
    spark: SparkSession, sql: str, datasets: Mapping[str, DataFrame], params: Mapping[str, Any] | None = None
) -> DataFrame:
    """A SQL text over named datasets (``{orders}``) with bound parameters (``:runDate``)."""
    return spark.sql(sql, args=dict(params) if params else None, **datasets)


def read_increment(source: DataFrame, loaded: DataFrame, watermark: str) -> DataFrame:
    """Rows of ``source`` newer than the newest row already loaded.

    Only the one maximum reaches the driver; as a literal it is pushed into the source scan
    and prunes files or partitions there. An empty ``loaded`` means everything is new. Rows
    without a watermark cannot be told from loaded ones, so every increment holds all of them:
    upsert them by key, or filter them out.
    """
    require_columns(source, [watermark], "read_increment source")
    require_columns(loaded, [watermark], "read_increment loaded")
    kind = source.schema[watermark].dataType
    newest = F.max(col(watermark)).cast(kind)
    # Through text (or microseconds) the value keeps its own type, whatever the driver's zone is,
    # so the comparison stays on the bare column and reaches the scan.
    if isinstance(kind, TimestampType):
        mark = loaded.agg(F.unix_micros(newest).alias("mark")).first()["mark"]
        bound = F.timestamp_micros(F.lit(mark))
    else:
        mark = loaded.agg(newest.cast("string").alias("mark")).first()["mark"]
        bound = F.lit(mark).cast(kind)
    return source if mark is None else source.filter((col(watermark) > bound) | col(watermark).isNull())


def retain(df: DataFrame, time: str, days: int, today: str) -> DataFrame:
    """Rows not older than ``days`` before ``today``: a plain comparison the scan can prune by.

    Rows without a time stay: their age is not known, and retention must not delete them.
    """
    require_columns(df, [time], "retain")
    cutoff = F.date_sub(F.lit(today).cast("date"), days).cast(df.schema[time].dataType)
    return df.filter((col(time) >= cutoff) | col(time).isNull())


def preflight(spark: SparkSession, path: str | Iterable[str]) -> DataFrame:
    """Files behind a path or glob: ``files``, ``empty_files``, ``bytes`` and a ``status``.

    ``missing`` and ``empty`` (every file has no bytes) are errors, ``partly_empty`` is a
    warning. Only file metadata is read, never content.
    """
    paths = names(path)
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
        listed = len(files._jdf.inputFiles())  # the length alone; the names stay in the JVM
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        files = spark.createDataFrame([], "length long")
        listed = 0
    # Spark plans no read for a file without bytes, so such files are listed but give no row.
    found = files.agg(F.count(F.lit(1)).alias("filled"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))
    total, filled = F.lit(listed).cast("long"), F.col("filled")
    status = (
        F.when(total == 0, "missing").when(filled == 0, "empty").when(filled < total, "partly_empty").otherwise("ok")
    )
    return found.select(
        F.lit(", ".join(paths)).alias("path"),
        total.alias("files"),
        (total - filled).alias("empty_files"),
        "bytes",
        status.alias("status"),
    )
