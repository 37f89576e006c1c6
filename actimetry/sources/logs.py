"""Log streams, raw text lines and the DAU table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_raw_lines(spark: SparkSession, path: str, stream: bool = False,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Raw log lines (``value STRING``) from text files, batch or stream. The file's
    modification time rides along as ``arrival`` (a per-file clock for stamping)."""
    reader = spark.readStream if stream else spark.read
    if stream and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = reader.format("text").load(path)
    return df.select("value", F.col("_metadata.file_modification_time").alias("arrival"))


def admission(max_files: int | None = None, max_bytes: str | int | None = None, archive: str | None = None,
              delete: bool = False) -> dict[str, str]:
    """Options of a file stream that bound a micro-batch and clean up behind it.

    ``max_files`` / ``max_bytes``: a backlog is drained in batches of about so many files or bytes (one of them; the next
    file always goes in). ``archive`` moves the files of committed batches below that folder, ``delete`` deletes
    them; neither keeps them. A file is touched only once the batch after its own has been committed, so a restart finds what it needs.
    """
    if max_files is not None and max_bytes is not None:
        raise ValueError("bound a batch by files or by bytes, not by both")
    if archive and delete:
        raise ValueError("archive or delete, not both")
    out = {"maxFilesPerTrigger": max_files, "maxBytesPerTrigger": max_bytes,
           "cleanSource": "archive" if archive else "delete" if delete else None, "sourceArchiveDir": archive}
    return {k: str(v) for k, v in out.items() if v is not None}


def read_log_stream(spark: SparkSession, source: str, path: str | None = None,
                    schema: T.StructType | str | None = None, options: dict | None = None) -> DataFrame:
    """A stream of log records.

    * ``kafka``: ``path`` is the comma-separated topic list; the record value is the
      JSON text and the broker timestamp is the arrival clock (needs the Kafka jar).
    * ``text`` / ``json``: a directory (or glob) of raw lines.
    * ``parquet``: a directory (or glob) of already-typed records; ``schema`` required.
    ``options`` may come from ``admission``, which bounds the files or bytes of a micro-batch (Kafka has ``maxOffsetsPerTrigger``).
    Offsets/file order are tracked by the query's checkpoint.
    """
    options = dict(options or {})
    if source == "kafka":
        options.setdefault("startingOffsets", "earliest")
        df = spark.readStream.format("kafka").option("subscribe", path).options(**options).load()
        return df.select(F.col("value").cast("string").alias("value"),
                         F.col("timestamp").alias("arrival"))
    if source in ("text", "json"):
        df = spark.readStream.options(**options).format("text").load(path)
        return df.select("value", F.col("_metadata.file_modification_time").alias("arrival"))
    if source == "parquet":
        if schema is None:
            raise ValueError("a parquet log stream needs an explicit schema")
        return spark.readStream.options(**options).schema(schema).parquet(path)
    raise ValueError(f"unknown log source {source!r}")


def dau_table_schema(record: T.StructType) -> T.StructType:
    """Stored DAU table: record columns + partition columns ``log_date`` (text), ``run``
    (the writer: one token per stream checkpoint) and ``batch_id`` (its micro-batch)."""
    fields = [f for f in record.fields if f.name not in ("log_date", "run", "batch_id")]
    return T.StructType(fields + [T.StructField("log_date", T.StringType()),
                                  T.StructField("run", T.StringType()),
                                  T.StructField("batch_id", T.LongType())])


def path_exists(spark: SparkSession, pattern: str) -> bool:
    """Whether any path matches ``pattern`` in its file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return found is not None and len(found) > 0


def read_partitioned(spark: SparkSession, root: str, schema: T.StructType | str,
                     column: str | None = None, values: list[str] | None = None) -> DataFrame:
    """Read a partitioned Parquet table with an explicit schema (partition values keep
    their declared types). With ``column``/``values`` only those ``column=value`` folders
    are listed (a brace glob); if none exists yet the result is empty."""
    root = root.rstrip("/")
    reader = spark.read.schema(schema).option("basePath", root)
    if column is None:
        return reader.parquet(root)
    values = sorted({v for v in values or [] if v is not None})
    if not values:
        return spark.createDataFrame([], schema)
    folders = f"{root}/{column}={{{','.join(values)}}}"
    if not path_exists(spark, folders):
        return spark.createDataFrame([], schema)
    df = reader.parquet(folders)
    return df.where(F.col(column).isin(values))


def read_dau_table(spark: SparkSession, path: str, record: T.StructType, dates: list[str] | None = None) -> DataFrame:
    """Scan a folder of DAU rows as it is on disk. With ``dates`` only those ``log_date=`` folders are listed; the
    explicit schema keeps ``log_date`` text. Readers of a table that is being written use ``DauTable.dau``."""
    return read_partitioned(spark, path, dau_table_schema(record), "log_date" if dates is not None else None, dates)


def seen_keys(dau: DataFrame, date: str | None = None) -> DataFrame:
    """The per-day device set: ``(mid, log_date)`` (one day if ``date`` is given)."""
    if date is not None:
        dau = dau.where(F.col("log_date") == date)
    return dau.select("mid", "log_date").distinct()
