"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from actimetry.config import scratch_dir

# Rows of text sent to a Python worker at once; Spark also closes a batch at its byte limit.
ARROW_ROWS = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: the lineage ends there, and a lost
    executor costs a re-read of files instead of the work above."""
    path = scratch_dir(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_text(df: DataFrame, fn: Callable[[dict], dict], schema: str,
             rows: int = ARROW_ROWS) -> DataFrame:
    """``fn`` on the columns of each Arrow batch (name -> list of Python values) gives the
    columns of the result (name -> list or Arrow array) in the order of ``schema``."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    names = df.columns
    out = spark.createDataFrame([], schema).schema
    from pyspark.sql.pandas.types import to_arrow_schema
    target = to_arrow_schema(out)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = fn({n: batch.column(i).to_pylist() for i, n in enumerate(names)})
            yield pa.RecordBatch.from_arrays(
                [pa.array(got[f.name], type=f.type) if not isinstance(got[f.name], pa.Array)
                 else got[f.name].cast(f.type) for f in target], schema=target)

    return df.mapInArrow(run, schema)


def neutral(docs: DataFrame, *needed: str) -> DataFrame:
    """``docs`` with every column but ``needed`` called x0, x1, ... by its place, so that no name of
    an extra column can clash with one that an operator adds."""
    return docs.toDF(*[n if n in needed else f"x{i}" for i, n in enumerate(docs.columns)])


def restored(df: DataFrame, plain: DataFrame, docs: DataFrame, without: tuple[str, ...] = ()) -> list[Column]:
    """The columns of ``df`` that ``plain`` = ``neutral(docs)`` had, under the names and in the order of
    ``docs``; names in ``without`` are left out."""
    return [df[p].alias(n) for p, n in zip(plain.columns, docs.columns) if n.lower() not in without]


def held_out(doc_id) -> Column:
    """The held-out fifth: crc32 of the id as text divides by five. A null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def ascii_lower(col) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
