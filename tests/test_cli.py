"""The command line end to end: collect → dau → total / hours, on lines rendered from events."""

import json

from pyspark.sql import functions as F

import actimetry.__main__ as cli
from actimetry.config import scratch_dir
from actimetry.plans import catalog as C
from actimetry.schemas import TOPIC_START
from actimetry.sources.tables import raw_lines_from_events
from tests.conftest import SF_SMALL


def test_cli_flow(spark, capsys):
    root = scratch_dir(spark, "cli")
    # text lines already carrying ts (a stamped feed); the collector re-stamps with file time
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    raw_lines_from_events(ev).select("value").write.text(f"{root}/lines")
    cli.main(["collect", "--lines", f"{root}/lines", "--archive", f"{root}/archive",
              "--routed", f"{root}/routed", "--checkpoint", f"{root}/c1", "--once", "--tz", "UTC"])
    cli.main(["dau", "--source", "parquet", "--lines", f"{root}/routed/topic={TOPIC_START}/run=*/batch_id=*",
              "--table", f"{root}/dau", "--checkpoint", f"{root}/c2", "--once"])
    C.orders(spark, SF_SMALL).write.parquet(f"{root}/orders")
    capsys.readouterr()
    day = spark.read.parquet(f"{root}/dau/dau").select(F.col("log_date").cast("string")).first()[0]
    cli.main(["total", "--table", f"{root}/dau", "--orders", f"{root}/orders", "--date", day])
    totals = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert [t["id"] for t in totals] == ["dau", "new_id", "order_amount"]
    # every startup line arrived at the same file time, so each device has one DAU row that day
    devices = ev.where(F.col("event_type") == "view").select("user_id").distinct().count()
    assert totals[0]["value"] == devices
    cli.main(["hours", "--table", f"{root}/dau", "--orders", f"{root}/orders", "--date", day, "--id", "dau"])
    doc = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert sum(doc["today"].values()) == devices
    # the first-seen table gives the same new-device answers as the history aggregate
    cli.main(["first-seen", "--table", f"{root}/dau", "--path", f"{root}/fs", "--date", day, "--build"])
    for cmd in (["total"], ["hours", "--id", "new_mid"]):
        capsys.readouterr()
        base = ["--table", f"{root}/dau", "--orders", f"{root}/orders", "--date", day]
        cli.main(cmd + base)
        plain = capsys.readouterr().out.strip().splitlines()[-1]
        cli.main(cmd + base + ["--first-seen", f"{root}/fs"])
        assert capsys.readouterr().out.strip().splitlines()[-1] == plain
