"""The stored table "first startup log per device per day", written a micro-batch at a time.

``DauTable.process(batch, batch_id)`` is the ``foreachBatch`` body. Under the table's folder:

* ``dau``, ``hours`` and ``quarantine`` hold a batch's new rows, their hourly counts and its rejected rows, in
  ``.../run=<writer>/batch_id=<id>`` folders;
* ``stats/run=.../batch_id=...`` is the batch's record, with its counts;
* ``commits/<run>`` names the last batch of each writer that is complete. It is replaced, in one rename, after everything else, and all
  readers join on it: what a crashed batch has written shows nowhere, and the batch that runs again clears it first. A
  batch that is complete is not written twice.
* ``days/<date>/<version>`` is the manifest of a day that was compacted: the folder that holds its rows in one file per
  bucket of ``mid``, its hourly counts, and for each writer the last batch that is in them. Later batches of the day are
  read beside it. Publishing a version is one rename, so readers have the old files or the new ones; ``vacuum`` deletes
  what no reader of the last ``retain`` seconds can be reading.

The first arrived batch wins for a key, even if a later batch has a smaller ts.
"""

from __future__ import annotations

import datetime as _dt
import time
import uuid
from contextlib import contextmanager
from functools import reduce
from typing import Callable
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.storagelevel import StorageLevel

from actimetry.operators.dedup import anti_asof, anti_by_date, first_with_count
from actimetry.operators.route import tag_problems
from actimetry.schemas import CORRUPT_COL
from actimetry.sinks.files import bucketed_table, init_table, write_bucketed, write_by_batch
from actimetry.sinks.records import Records
from actimetry.sources.logs import dau_table_schema, path_exists, read_partitioned

STATS = ("rows_in", "rows_unseen", "rows_first", "rows_new")
STATS_SCHEMA = T.StructType([T.StructField(n, T.LongType()) for n in STATS]
                            + [T.StructField("run", T.StringType()), T.StructField("batch_id", T.LongType())])
QUARANTINE_SCHEMA = T.StructType([
    T.StructField("mid", T.StringType()),
    T.StructField("ts", T.LongType()),
    T.StructField("reason", T.StringType()),
    T.StructField("run", T.StringType()),
    T.StructField("batch_id", T.LongType()),
])
HOURS_SCHEMA = T.StructType([
    T.StructField("log_hour", T.StringType()),
    T.StructField("ct", T.LongType()),
    T.StructField("log_date", T.StringType()),
    T.StructField("run", T.StringType()),
    T.StructField("batch_id", T.LongType()),
])
BUCKETS = 8                 # files of a compacted day; more for days of many gigabytes


def today_in(tz: str) -> Callable[[], str]:
    def today() -> str:
        return _dt.datetime.now(ZoneInfo(tz)).date().isoformat()
    return today


def up_to(last: dict[str, int]) -> Column:
    """Rows of the batches up to ``last`` (run -> batch id): a filter on the partition columns."""
    each = [(F.col("run") == run) & (F.col("batch_id") <= int(b)) for run, b in sorted(last.items())]
    return F.coalesce(reduce(Column.__or__, each, F.lit(False)), F.lit(False))


@contextmanager
def _whole_plans(spark: SparkSession):
    """Keep a plan whole where a stage turns out to have no rows: else the counts observed below it are lost with it."""
    key = "spark.sql.adaptive.optimizer.excludedRules"
    old = spark.conf.get(key, None)
    spark.conf.set(key, ",".join(filter(None, [old, "org.apache.spark.sql.execution.adaptive.AQEPropagateEmptyRelation"])))
    try:
        yield
    finally:
        spark.conf.unset(key) if old is None else spark.conf.set(key, old)


class DauTable:
    """``seen_mode``: ``"record_date"`` (default) drops a row whose device is already stored
    for the row's own day; ``"as_of"`` drops a row whose device is stored for the day
    ``as_of()`` returns when the batch runs (today by the clock in ``tz``), whatever the
    row's day – a late row of yesterday is then checked against today's set.
    One writer per table at a time: concurrent writers would not see each other's rows. Compaction and readers may run beside it.
    """

    def __init__(self, spark: SparkSession, path: str, record: T.StructType, tie_break=None,
                 seen_mode: str = "record_date", as_of: Callable[[], str] | None = None, tz: str = "UTC", run: str = "batch",
                 buckets: int = BUCKETS, create: bool = True):
        if seen_mode not in ("record_date", "as_of"):
            raise ValueError(f"unknown seen_mode {seen_mode!r}")
        self.spark, self.path, self.record, self.tie_break = spark, path.rstrip("/"), record, tie_break
        self.seen_mode, self.as_of = seen_mode, as_of or today_in(tz)
        self.run, self.buckets = run, buckets
        self.dau_path = f"{self.path}/dau"
        self.hours_path = f"{self.path}/hours"
        self.quarantine_path = f"{self.path}/quarantine"
        self.schema = dau_table_schema(record)
        self.records = Records(spark, self.path)
        if not create:
            if not path_exists(spark, self.dau_path):
                raise FileNotFoundError(self.dau_path)
            return
        init_table(spark, self.dau_path, self.schema, ["log_date", "run", "batch_id"])
        init_table(spark, self.hours_path, HOURS_SCHEMA, ["log_date", "run", "batch_id"])
        init_table(spark, self.quarantine_path, QUARANTINE_SCHEMA, ["run", "batch_id"])

    # -- what is committed ----------------------------------------------------
    def committed(self) -> dict[str, int]:
        """The last complete batch of each writer: one small file per checkpoint."""
        return {run: self.records.get(f"commits/{run}")["batch_id"] for run in self.records.names("commits")}

    def _is_done(self, batch_id: int) -> bool:
        last = self.committed().get(self.run)
        if last is None or batch_id > last:
            return False
        if self.records.get(self._stats_name(batch_id)) is None:
            raise ValueError(f"batch {batch_id} comes after batch {last}: the batches of a run come in order")
        return True

    def _stats_name(self, batch_id: int) -> str:
        return f"stats/run={self.run}/batch_id={int(batch_id)}/stats.json"

    def _day_of(self, batch_id: int) -> str:
        """The as-of day of a batch: fixed when the batch first runs, so a replay uses the same."""
        name = f"as_of/{self.run}/{int(batch_id)}"
        self.records.put(name, {"day": self.as_of()}, replace=False)
        return self.records.get(name)["day"]

    # -- the foreachBatch body ------------------------------------------------
    def process(self, batch: DataFrame, batch_id: int) -> None:
        if self._is_done(batch_id):
            return
        # read once: tagged, kept, and only then split
        tagged = tag_problems(batch).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            # one row per day, good and bad
            found = tagged.groupBy("log_date", F.col("reason").isNull().alias("ok")).agg(F.count(F.lit(1)).alias("n")).collect()
            dates = sorted({r["log_date"] for r in found if r["ok"] and r["log_date"] is not None})
            self._clear(batch_id, dates)
            if not all(r["ok"] for r in found):
                bad = tagged.where(F.col("reason").isNotNull())
                write_by_batch(bad.select(*[F.col(f.name).cast(f.dataType) for f in QUARANTINE_SCHEMA.fields[:3]]),
                               self.quarantine_path, batch_id, (), self.run)
            stats = dict.fromkeys(STATS, 0)
            if any(r["ok"] for r in found):
                good = tagged.where(F.col("reason").isNull()).drop("reason", CORRUPT_COL)
                stats = self._write_new(good, batch_id, dates)
            if stats["rows_new"]:
                self._write_hours(batch_id, dates)
        finally:
            tagged.unpersist()
        self.records.put(self._stats_name(batch_id), stats)
        self._commit(batch_id)

    def _commit(self, batch_id: int) -> None:
        self.records.put(f"commits/{self.run}", {"batch_id": int(batch_id)})

    def _clear(self, batch_id: int, dates: list[str]) -> None:
        """Remove what an earlier attempt of this batch has written."""
        own = f"run={self.run}/batch_id={int(batch_id)}"
        self.records.remove(f"quarantine/{own}")
        for day in dates:
            self.records.remove(f"dau/log_date={day}/{own}")
            self.records.remove(f"hours/log_date={day}/{own}")

    def _write_new(self, good: DataFrame, batch_id: int, dates: list[str]) -> dict[str, int]:
        """Write the rows of new keys; the counts are observed on the frames of that one write."""
        arrived, added = Observation(), Observation()
        first = first_with_count(good, tie_break=self.tie_break).observe(
            arrived, F.sum("rows__").alias("rows_in"), F.count(F.lit(1)).alias("rows_first"))
        kept = self._unseen(first, batch_id, dates).observe(
            added, F.sum("rows__").alias("rows_unseen"), F.count(F.lit(1)).alias("rows_new"))
        # one layout for all batches: adaptive execution joins small parts and splits large ones by size
        with _whole_plans(good.sparkSession):
            write_by_batch(kept.select(*[f.name for f in self.record.fields]).hint("rebalance", "log_date"),
                           self.dau_path, batch_id, ("log_date",), self.run)
        return {n: int({**arrived.get, **added.get}[n] or 0) for n in STATS}

    def _unseen(self, first: DataFrame, batch_id: int, dates: list[str]) -> DataFrame:
        if self.seen_mode == "as_of":
            day = self._day_of(batch_id)
            return anti_asof(first, self.dau([day]).select("mid", "log_date"), day)
        closed = self._closed(dates)
        for c in closed:                                   # stored by buckets of mid: only the batch is exchanged
            stored = bucketed_table(self.spark, f"{self.path}/{c['rows']}", self.schema, c["buckets"], "mid")
            # null devices are not in the batch any more, so equality is enough
            first = first.join(stored.select(F.col("mid").alias("mid__")),
                               (F.col("mid") == F.col("mid__")) & (F.col("log_date") == F.lit(c["day"])), "left_anti")
        return anti_by_date(first, self._open(self.dau_path, self.schema, dates, closed, "upto").select("mid", "log_date"))

    def _write_hours(self, batch_id: int, dates: list[str]) -> None:
        """Hourly counts of the batch, from the one column of the rows just written."""
        new = read_partitioned(self.spark, self.dau_path, self.schema, "log_date", dates).where(
            (F.col("run") == self.run) & (F.col("batch_id") == int(batch_id)))
        write_by_batch(new.groupBy("log_date", "log_hour").agg(F.count(F.lit(1)).alias("ct")).coalesce(1),
                       self.hours_path, batch_id, ("log_date",), self.run)

    # -- compaction -----------------------------------------------------------
    def manifest(self, day: str) -> dict | None:
        """The latest manifest of a day, None if it was never compacted."""
        versions = self.records.names(f"days/{day}")
        return self.records.get(f"days/{day}/{versions[-1]}") if versions else None

    def closed_days(self) -> list[str]:
        return self.records.names("days")

    def _publish(self, day: str, old: dict | None, new: dict) -> dict:
        """Put the next version in place; if another writer was faster, nothing changes and it is an error."""
        new = new | {"version": (old["version"] if old else 0) + 1, "at": time.time()}
        if not self.records.put(f"days/{day}/{new['version']:08d}", new, replace=False):
            raise RuntimeError(f"version {new['version']} of {day} was published by another writer")
        return new

    def compact(self, day: str) -> dict:
        """Rewrite a day as ``buckets`` files, with its hourly counts folded into the manifest. Safe beside readers and the writer,
        safe to repeat, and without effect if it ends before the last step."""
        old, last = self.manifest(day), self.committed()
        closed = [old | {"day": day}] if old else []
        folder = f"closed/log_date={day}/{uuid.uuid4().hex[:12]}"
        write_bucketed(self._rows([day], closed, last).select(*self.schema.names), f"{self.path}/{folder}", self.buckets, "mid")
        return self._publish(day, old, {"rows": folder, "buckets": self.buckets, "upto": last,
                                        "hours": self._hours_of(day, closed, last), "hours_upto": last})

    def fold_hours(self, day: str) -> dict:
        """Add the hourly counts since the last fold to the manifest of a compacted day; no row is read."""
        old, last = self.manifest(day), self.committed()
        if old is None:
            raise ValueError(f"{day} was never compacted")
        return self._publish(day, old, old | {"hours": self._hours_of(day, [old | {"day": day}], last), "hours_upto": last})

    def _hours_of(self, day: str, closed: list[dict], last: dict[str, int]) -> dict[str, int]:
        return {r["log_hour"]: r["ct"] for r in self._hour_counts([day], closed, last).collect()}        # 24 rows at most

    def vacuum(self, retain: float = 86_400.0) -> int:
        """Delete the files that no reader of the last ``retain`` seconds can have found in a manifest; how many folders went."""
        gone, now = 0, time.time()
        for day in self.closed_days():
            versions = [self.records.get(f"days/{day}/{v}") for v in self.records.names(f"days/{day}")]
            settled = [v for v in versions if now - v["at"] >= retain]
            if not settled:
                continue
            # whoever reads now has this version or a later one
            base, later = settled[-1], [v for v in versions if v["version"] >= settled[-1]["version"]]
            for root, upto in ((f"dau/log_date={day}", base["upto"]), (f"hours/log_date={day}", base["hours_upto"])):
                for run in self.records.names(root):
                    for b in self.records.names(f"{root}/{run}"):
                        if int(b.split("=", 1)[1]) <= upto.get(run.split("=", 1)[1], -1):
                            gone += self.records.remove(f"{root}/{run}/{b}")
            for folder in self.records.names(f"closed/log_date={day}"):
                name = f"closed/log_date={day}/{folder}"
                # a folder that no manifest names yet may be one that is being written
                if all(v["rows"] != name for v in later) and self.records.age(name) >= retain:
                    gone += self.records.remove(name)
            for v in settled[:-1]:
                self.records.remove(f"days/{day}/{v['version']:08d}")
        return gone

    # -- readers --------------------------------------------------------------
    def _closed(self, dates: list[str] | None) -> list[dict]:
        """The manifests of the days that have one. Taken once for a read, and before the commits: so no batch shows twice."""
        return [self.manifest(d) | {"day": d} for d in self.closed_days() if dates is None or d in dates]

    def _open(self, path: str, schema: T.StructType, dates: list[str] | None, closed: list[dict], upto: str,
              last: dict[str, int] | None = None) -> DataFrame:
        """Rows of committed batches that no manifest covers."""
        df = read_partitioned(self.spark, path, schema, "log_date" if dates is not None else None, dates).where(
            up_to(self.committed() if last is None else last))
        for c in closed:
            df = df.where((F.col("log_date") != c["day"]) | ~up_to(c[upto]))
        return df

    def _rows(self, dates: list[str] | None, closed: list[dict], last: dict[str, int] | None = None) -> DataFrame:
        open_ = self._open(self.dau_path, self.schema, dates, closed, "upto", last)
        if not closed:
            return open_
        rows = self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{c['rows']}" for c in closed])
        return open_.unionByName(rows.select(*open_.columns))

    def _hour_counts(self, dates: list[str] | None, closed: list[dict], last: dict[str, int] | None = None) -> DataFrame:
        h = self._open(self.hours_path, HOURS_SCHEMA, dates, closed, "hours_upto", last).select("log_date", "log_hour", "ct")
        folded = [(c["day"], hour, n) for c in closed for hour, n in c["hours"].items()]
        if folded:
            h = h.unionByName(self.spark.createDataFrame(folded, "log_date string, log_hour string, ct long"))
        return h.groupBy("log_date", "log_hour").agg(F.sum("ct").cast("long").alias("ct"))

    def dau(self, dates: list[str] | None = None) -> DataFrame:
        """The committed rows, of the folders of ``dates`` only if these are given: compacted days, and batches after them."""
        return self._rows(dates, self._closed(dates))

    def hours(self, dates: list[str] | None = None) -> DataFrame:
        """Running DAU by hour ``(log_date, log_hour, ct)``: the folded counts of compacted days and the per-batch counts after them."""
        return self._hour_counts(dates, self._closed(dates))

    def quarantined(self) -> DataFrame:
        return read_partitioned(self.spark, self.quarantine_path, QUARANTINE_SCHEMA).where(up_to(self.committed()))

    def stats(self) -> DataFrame:
        """The counts of each committed batch."""
        if not self.records.names("stats"):
            return self.spark.createDataFrame([], STATS_SCHEMA)
        return (self.spark.read.schema(STATS_SCHEMA).option("basePath", f"{self.path}/stats").json(f"{self.path}/stats")
                .where(up_to(self.committed())))
