"""Command line: the two streaming jobs, the daily first-seen job and the two dashboard answers.

    python -m actimetry collect    --lines DIR --archive DIR --routed DIR --checkpoint DIR
    python -m actimetry dau        --lines DIR --table DIR --checkpoint DIR [--seen-mode as_of]
    python -m actimetry first-seen --table DIR --path DIR --date YYYY-MM-DD [--build]
    python -m actimetry total      --table DIR --orders DIR --date YYYY-MM-DD [--first-seen DIR]
    python -m actimetry hours      --table DIR --orders DIR --date YYYY-MM-DD --id dau|order_amount|new_mid

Every command also takes ``--tz`` (zone of dates and hours, default UTC) and
``--master`` (omit under spark-submit). ``--lines`` is a folder of raw JSON text lines;
``--source kafka --lines TOPICS --source-option kafka.bootstrap.servers=HOST:9092`` reads
Kafka; ``--source parquet`` reads ``value`` columns, e.g. the collector's
``routed/topic=startup_log/run=*/batch_id=*``. ``--publish kafka`` (with ``--sink-option``)
makes the collector publish to Kafka instead of ``topic=`` folders. ``--orders`` is a
Parquet table of ``(create_date, create_hour, amount)``. Reports print one JSON
document; the jobs run until stopped (``--once`` processes what is available and exits).
"""

from __future__ import annotations

import argparse
import sys

from actimetry.config import get_or_create_session
from actimetry.schemas import STARTUP_RAW


def _trigger(args) -> dict:
    return {"availableNow": True} if args.once else {"processingTime": f"{args.trigger} seconds"}


def _options(pairs) -> dict:
    out = {}
    for p in pairs or []:
        key, _, value = p.partition("=")
        out[key] = value
    return out


def _dau_record():
    from pyspark.sql import types as T
    return T.StructType(list(STARTUP_RAW.fields) + [T.StructField("log_date", T.StringType()),
                                                    T.StructField("log_hour", T.StringType())])


def _lines(spark, args):
    from pyspark.sql import functions as F
    from actimetry.sources.logs import admission, read_log_stream
    opts = {**admission(args.max_files, args.max_bytes, args.archive_source), **_options(args.source_option)}
    if args.source == "parquet":
        df = read_log_stream(spark, "parquet", args.lines, schema="value string", options=opts)
        return df.select("value", F.col("_metadata.file_modification_time").alias("arrival"))
    return read_log_stream(spark, args.source, args.lines, options=opts)


def _partitions(spark, args) -> int:
    return args.partitions or spark.sparkContext.defaultParallelism


def cmd_collect(spark, args) -> None:
    from actimetry.streaming.collector import Collector, start_collector_stream
    kafka = _options(args.sink_option) if args.publish == "kafka" else None
    collector = Collector(args.archive, args.routed, tz=args.tz, kafka_options=kafka)
    q = start_collector_stream(_lines(spark, args), collector, args.checkpoint, _trigger(args),
                               _partitions(spark, args))
    q.awaitTermination()


def cmd_dau(spark, args) -> None:
    from actimetry.streaming.collector import JsonDauConsumer, start_json_dau_stream
    from actimetry.streaming.dau_stream import DauTable
    table = DauTable(spark, args.table, _dau_record(), seen_mode=args.seen_mode, tz=args.tz)
    q = start_json_dau_stream(_lines(spark, args), JsonDauConsumer(table, f"{args.table}/rejected"),
                              args.checkpoint, args.tz, _trigger(args), _partitions(spark, args))
    q.awaitTermination()


def _dau(spark, args):
    from actimetry.streaming.dau_table import DauTable
    return DauTable(spark, args.table, _dau_record(), create=False).dau()


def cmd_first_seen(spark, args) -> None:
    from actimetry.functions.timefmt import prev_day_str
    from actimetry.streaming.first_seen import FirstSeenTable
    table = FirstSeenTable(spark, args.path)
    if args.build:
        table.build(_dau(spark, args), upto=prev_day_str(args.date))
    table.advance(_dau(spark, args), args.date)


def _firsts(spark, args):
    if not args.first_seen:
        return None
    from actimetry.streaming.first_seen import FirstSeenTable
    return FirstSeenTable(spark, args.first_seen, create=False).read()


def cmd_total(spark, args) -> None:
    from actimetry.plans.report import realtime_total, totals_json
    doc = totals_json(realtime_total(_dau(spark, args), spark.read.parquet(args.orders), args.date,
                                     firsts=_firsts(spark, args)))
    print(doc.first()["doc"])


def cmd_hours(spark, args) -> None:
    from actimetry.plans.report import realtime_hours, to_json_doc
    res = realtime_hours(args.id, _dau(spark, args), spark.read.parquet(args.orders), args.date,
                         firsts=_firsts(spark, args))
    print(to_json_doc(res).first()["doc"])


def main(argv=None) -> int:
    common = argparse.ArgumentParser(add_help=False)
    common.add_argument("--master", default=None, help="e.g. local[8]; omit under spark-submit")
    common.add_argument("--tz", default="UTC", help="zone for dates and hours")
    p = argparse.ArgumentParser(prog="actimetry", parents=[common])
    sub = p.add_subparsers(dest="cmd", required=True)
    for name in ("collect", "dau"):
        s = sub.add_parser(name, parents=[common])
        s.add_argument("--source", default="text", choices=["text", "json", "kafka", "parquet"])
        s.add_argument("--source-option", action="append", metavar="KEY=VALUE")
        s.add_argument("--lines", required=True)
        s.add_argument("--checkpoint", required=True)
        s.add_argument("--trigger", type=int, default=5, help="seconds between micro-batches")
        s.add_argument("--partitions", type=int, default=None,
                       help="shuffle/state partitions, fixed in the checkpoint (default: parallelism)")
        s.add_argument("--once", action="store_true")
        s.add_argument("--max-files", type=int, help="files of a micro-batch at most")
        s.add_argument("--max-bytes", help="bytes of a micro-batch, about, e.g. 256m")
        s.add_argument("--archive-source", help="folder to which read files are moved")
        if name == "collect":
            s.add_argument("--archive", required=True)
            s.add_argument("--routed", required=True)
            s.add_argument("--publish", default="files", choices=["files", "kafka"])
            s.add_argument("--sink-option", action="append", metavar="KEY=VALUE")
        else:
            s.add_argument("--table", required=True)
            s.add_argument("--seen-mode", default="record_date", choices=["record_date", "as_of"],
                           help="check a device against its record's day (default) or today's set")
    s = sub.add_parser("first-seen", parents=[common])
    s.add_argument("--table", required=True)
    s.add_argument("--path", required=True)
    s.add_argument("--date", required=True)
    s.add_argument("--build", action="store_true", help="seed from history before the date first")
    for name in ("total", "hours"):
        s = sub.add_parser(name, parents=[common])
        s.add_argument("--table", required=True)
        s.add_argument("--orders", required=True)
        s.add_argument("--date", required=True)
        s.add_argument("--first-seen", default=None, help="first-seen table (else: from history)")
        if name == "hours":
            s.add_argument("--id", required=True)
    args = p.parse_args(argv)
    spark = get_or_create_session(args.master)
    {"collect": cmd_collect, "dau": cmd_dau, "first-seen": cmd_first_seen,
     "total": cmd_total, "hours": cmd_hours}[args.cmd](spark, args)
    return 0


if __name__ == "__main__":
    sys.exit(main())
