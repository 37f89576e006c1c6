"""First-seen table: ``mid → (first_date, first_hour)``, one folder per first day, with a ledger of the days it has seen.

New-device metrics read one or two folders instead of aggregating the whole DAU history. ``build`` seeds the table
from history, ``advance(dau, date)`` takes in one day: its devices that are unknown are new on that day, and those that are
known from a *later* day (this one was skipped, or has late rows) are taken back from there. So days may come in any order
and more than once, and the table is always that of a full recount over the days in the ledger.

``versions/<n>`` is the table: for every first day the folder of its rows, and the ledger (day -> its devices). A step
writes new folders for the days it changes and publishes them, with the ledger, by one rename: a reader or a restart sees all of
a step or nothing, and of two writers one is refused. ``vacuum`` deletes folders that no recent version names.
"""

from __future__ import annotations

import datetime as _dt
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.storagelevel import StorageLevel

from actimetry.operators.metrics import first_seen, new_devices_by_hour
from actimetry.sinks.files import spread_for_partitioned_write
from actimetry.sinks.records import Records

SCHEMA = T.StructType([
    T.StructField("mid", T.StringType()),
    T.StructField("first_hour", T.StringType()),
    T.StructField("first_date", T.StringType()),
])


def _days(first: str, last: str) -> list[str]:
    a, b = _dt.date.fromisoformat(first), _dt.date.fromisoformat(last)
    return [(a + _dt.timedelta(n)).isoformat() for n in range((b - a).days + 1)]


class FirstSeenTable:
    """``create=False`` opens an existing table for reading; a path that isn't there is an error."""

    def __init__(self, spark: SparkSession, path: str, create: bool = True):
        self.spark, self.path = spark, path.rstrip("/")
        self.records = Records(spark, self.path)
        if not self.records.names("versions"):
            if not create:
                raise FileNotFoundError(self.path)
            self.records.put("versions/00000000", {"version": 0, "days": {}, "ledger": {}, "at": time.time()}, replace=False)

    # -- versions -------------------------------------------------------------
    def version(self) -> dict:
        return self.records.get(f"versions/{self.records.names('versions')[-1]}")

    def _publish(self, old: dict, days: dict[str, str], ledger: dict[str, int]) -> None:
        new = {"version": old["version"] + 1, "days": {**old["days"], **days}, "ledger": {**old["ledger"], **ledger}, "at": time.time()}
        if not self.records.put(f"versions/{new['version']:08d}", new, replace=False):
            raise RuntimeError(f"version {new['version']} was published by another writer")

    def _write(self, df: DataFrame, dates: list[str]) -> dict[str, str]:
        """New folders for ``dates``; a day without rows gets one without files, which is not named."""
        step = f"rows/{uuid.uuid4().hex[:12]}"
        # the day is in the rows too, so a folder can be read without the others
        (df.select("mid", "first_hour", F.col("first_date").alias("day"), "first_date")
           .write.partitionBy("first_date").parquet(f"{self.path}/{step}"))
        written = {n.split("=", 1)[1] for n in self.records.names(step) if n.startswith("first_date=")}
        return {d: f"{step}/first_date={d}" if d in written else "" for d in dates}

    def vacuum(self, retain: float = 86_400.0) -> int:
        """Delete the folders that no version of the last ``retain`` seconds names, and older versions; how many folders went."""
        now = time.time()
        versions = [self.records.get(f"versions/{v}") for v in self.records.names("versions")]
        settled = [v for v in versions if now - v["at"] >= retain]
        if not settled:
            return 0
        named = {f for v in versions if v["version"] >= settled[-1]["version"] for f in v["days"].values()}
        gone = 0
        for step in self.records.names("rows"):
            days = [d for d in self.records.names(f"rows/{step}") if d.startswith("first_date=")]
            kept = [d for d in days if f"rows/{step}/{d}" in named]
            if self.records.age(f"rows/{step}") < retain:
                continue
            for d in set(days) - set(kept):
                gone += self.records.remove(f"rows/{step}/{d}")
            if not kept:
                self.records.remove(f"rows/{step}")
        for v in settled[:-1]:
            self.records.remove(f"versions/{v['version']:08d}")
        return gone

    # -- writers --------------------------------------------------------------
    def build(self, dau: DataFrame, upto: str) -> None:
        """Seed from the DAU history up to ``upto`` (inclusive); replaces what the table has of these days. Many days are written at
        once, so rows are range-spread on ``(first_date, mid)`` first (see sinks)."""
        old = self.version()
        days = [r["log_date"] for r in dau.where(F.col("log_date") <= upto).select("log_date").distinct().collect()]    # one row per day
        fs = first_seen(dau, upto=upto).persist(StorageLevel.MEMORY_AND_DISK)  # sampled, then written
        try:
            folders = self._write(spread_for_partitioned_write(fs, ["first_date"], ["mid"]), days)
            sizes = {r["first_date"]: r["count"] for r in fs.groupBy("first_date").count().collect()}
        finally:
            fs.unpersist()
        # history is complete up to ``upto``: its days without rows count as taken in
        span = _days(min(days), upto) if days else []
        self._publish(old, folders, {d: sizes.get(d, 0) for d in span})

    def advance(self, dau: DataFrame, date: str) -> list[str]:
        """Take in the devices of ``date``; ``dau`` needs only that day's rows, but all of them. Returns the later days that lost
        devices to it. A day without rows is entered in the ledger too."""
        _dt.date.fromisoformat(date)
        old = self.version()
        day = dau.where(F.col("log_date") == date).groupBy("mid").agg(F.min("log_hour").alias("hour__"))
        known = self._rows(old)
        # of every device of the day: where it is known from, if at all
        met = day.join(known, "mid", "left").persist(StorageLevel.MEMORY_AND_DISK)
        try:
            later = [r["first_date"] for r in met.where(F.col("first_date") > date).select("first_date").distinct().collect()]   # a row per day
            gained = met.where(F.col("first_date").isNull() | (F.col("first_date") >= date)).select(
                "mid", F.col("hour__").alias("first_hour"), F.lit(date).alias("first_date"))
            # devices that were entered for the day and are not in what it has now stay as they are
            changed = self._rows(old, [date, *later])
            kept = changed.join(gained.select("mid"), "mid", "left_anti")
            folders = self._write(gained.unionByName(kept.select(*gained.columns)), [date, *later])
            size = met.count()
        finally:
            met.unpersist()
        self._publish(old, folders, {date: size})
        return sorted(later)

    # -- readers --------------------------------------------------------------
    def ledger(self) -> dict[str, int]:
        """The days that were taken in, with their devices (of a seeded day: its new ones)."""
        return self.version()["ledger"]

    def missing_days(self, upto: str | None = None) -> list[str]:
        """The days between the first one in the ledger and ``upto`` (or the last one) that were never taken in: new devices after
        such a day may belong to it."""
        days = sorted(self.ledger())
        if not days:
            return []
        return [d for d in _days(days[0], upto or days[-1]) if d not in set(days)]

    def _rows(self, version: dict, dates: list[str] | None = None, before: str | None = None) -> DataFrame:
        folders = [f"{self.path}/{f}" for d, f in sorted(version["days"].items())
                   if f and (dates is None or d in dates) and (before is None or d < before)]
        if not folders:
            return self.spark.createDataFrame([], SCHEMA)
        rows = self.spark.read.schema("mid string, first_hour string, day string").parquet(*folders)
        return rows.withColumnRenamed("day", "first_date")

    def read(self, dates: list[str] | None = None, before: str | None = None) -> DataFrame:
        return self._rows(self.version(), dates, before)

    def new_device_total(self, date: str) -> DataFrame:
        return self.read([date]).agg(F.count(F.lit(1)).alias("new_devices"))

    def new_device_hours(self, dates: list[str]) -> DataFrame:
        return new_devices_by_hour(self.read(dates))
