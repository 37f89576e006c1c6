"""File (and Kafka) sinks.

The DAU table is the per-day device set *and* the data: one write per batch into
``log_date=…/run=…/batch_id=…`` folders with dynamic partition overwrite (``run`` is
the writer – one token per stream checkpoint). Replaying a batch id rewrites
exactly its own folders, so a retry after a lost executor or a restart from the
checkpoint leaves the table unchanged; a new checkpoint on an existing table is a
new run, and everything already stored counts as seen.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def init_table(spark: SparkSession, path: str, schema: T.StructType, partition_cols: list[str]) -> None:
    """Create an empty partitioned Parquet table (so the first batch can read it)."""
    spark.createDataFrame([], schema).write.mode("append").partitionBy(*partition_cols).parquet(path)


def spread_for_partitioned_write(df: DataFrame, part_cols, key_cols, n: int | None = None) -> DataFrame:
    """Before a ``partitionBy(part_cols)`` write that spans many partition values: range
    partition on ``(part_cols, key_cols)``. Sampled bounds give balanced tasks even when one
    value holds a third of the rows, and each task covers a contiguous range, i.e. one or
    two folders – so files ≈ tasks instead of tasks × folders. (A plain ``repartition`` on
    the partition column would send a hot value to a single task.)"""
    n = n or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, *[F.col(c) for c in list(part_cols) + list(key_cols)])


def write_by_batch(df: DataFrame, path: str, batch_id: int, partition_cols=("log_date",),
                   run: str = "batch") -> None:
    """Write ``df`` into ``<partition>=…/run=<run>/batch_id=<id>`` folders, replacing only
    those folders (idempotent per writer and batch id)."""
    (df.withColumn("run", F.lit(run)).withColumn("batch_id", F.lit(int(batch_id)).cast("long"))
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*partition_cols, "run", "batch_id").parquet(path))


def write_bucketed(df: DataFrame, path: str, n: int, column: str) -> None:
    """Write ``df`` to ``path`` in ``n`` files, one per bucket of ``column``, each sorted by it. The catalog needs a name for
    that while it is written and forgets it at once; the files stay."""
    spark, name = df.sparkSession, f"bucketed_{uuid.uuid4().hex}"
    try:
        (df.repartition(n, column).write.format("parquet").bucketBy(n, column).sortBy(column)
           .option("path", path).saveAsTable(name))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def bucketed_table(spark: SparkSession, path: str, schema: T.StructType, n: int, column: str) -> DataFrame:
    """The files of ``write_bucketed`` as a frame that is known to be dealt by ``column``: joins on it exchange only their
    other side."""
    name = f"bucketed_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet OPTIONS (path '{path}') "
              f"CLUSTERED BY (`{column}`) SORTED BY (`{column}`) INTO {int(n)} BUCKETS")
    try:
        df = spark.table(name)
        df.schema                     # resolved here; the name is not needed any more
        return df
    finally:
        spark.sql(f"DROP TABLE {name}")


def preview(df: DataFrame, n: int = 10, order=("ts",)) -> DataFrame:
    """First ``n`` rows in ``order`` (a top-k: each task keeps n, one merge)."""
    return df.orderBy(*order).limit(n)
