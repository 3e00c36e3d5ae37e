"""Streaming plans over tables: few state partitions, each event derived once, times without lookups by row."""

import glob
import json
import os
from datetime import datetime, timezone
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F
from test_queries import SF_DIR

from tallyguard import contracts as C
from tallyguard.functions.times import local_time, wall_clock_millis
from tallyguard.plans import registry, streamed
from tallyguard.plans.streamed import FEW_PARTITIONS, state_partitions, write_topics
from tallyguard.sinks.shared import remove_folder
from tallyguard.sources import tables


def folders(spark):
    return set(glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/stream-*"))


# A store, its files and a Python worker for each of 40 partitions before, 120 of each in a micro-batch.
def test_state_partitions_do_not_grow_with_shuffle_partitions(spark):
    before, old = folders(spark), spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        assert state_partitions(spark) == 3
        spark.conf.set("spark.sql.shuffle.partitions", "40")
        most = max(FEW_PARTITIONS, spark.sparkContext.defaultParallelism)
        assert state_partitions(spark) == min(most, 40)
        streamed = registry.QUERIES["stream_user_alerts"](spark, SF_DIR)
        assert {r.alert_id for r in streamed.collect()} == {
            r.alert_id for r in registry.QUERIES["u11_user_alerts"](spark, SF_DIR).collect()
        }
        assert spark.conf.get("spark.sql.shuffle.partitions") == "40"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    (folder,) = folders(spark) - before
    for operator in range(3):
        assert len(glob.glob(f"{folder}/checkpoint/state/{operator}/[0-9]*")) <= most


def test_topics_are_closed_after_their_newest_event(spark, tmp_path):
    events = tables.order_job_events(spark, SF_DIR)
    topics = [C.ORDER_TOPIC, C.DETAIL_TOPIC, C.PAYMENT_TOPIC]
    paths = write_topics(events, topics, str(tmp_path), 5000)
    newest = events.agg(F.max("event_time_ms")).first()[0]
    found = {topic: [json.loads(r.value) for r in spark.read.text(path).collect()] for topic, path in paths.items()}
    assert sum(len(rows) for rows in found.values()) == events.count() + 1
    (closing,) = [row for row in found[C.PAYMENT_TOPIC] if row["event_id"] == "closing"]
    wall = datetime.fromtimestamp((newest + 5000) / 1000, ZoneInfo(C.BUSINESS_ZONE))
    assert closing["event_time"] == wall.strftime("%Y-%m-%d %H:%M:%S.%f")[:-3]


def test_times_beside_changes_of_the_clock(spark):
    """Business time had summer time until 1991; the session's zone has others."""
    zone, utc = ZoneInfo(C.BUSINESS_ZONE), timezone.utc
    starts = [datetime(y, m, d, tzinfo=utc) for y, m, d in ((1940, 6, 2), (1986, 5, 3), (1991, 9, 14), (2024, 3, 10))]
    millis = [int(s.timestamp()) * 1000 + step * 900_123 for s in starts for step in range(200)]
    rows = spark.createDataFrame([(ms,) for ms in millis], "ms bigint")
    there = rows.select("ms", local_time(F.col("ms")).alias("wall"))
    for r in there.select("ms", "wall", wall_clock_millis(F.col("wall")).alias("back")).collect():
        whole, rest = divmod(r.ms, 1000)
        aware = datetime.fromtimestamp(whole, zone).replace(microsecond=rest * 1000)
        assert r.wall == aware.replace(tzinfo=None, fold=0)
        # Of a time that comes twice the first one counts.
        assert r.back == r.ms - (3_600_000 if aware.fold else 0)


# The topics alone took 294 bytes an event on disk, and stayed there with the checkpoint.
def test_topics_are_compressed_in_files_of_bounded_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(streamed, "FILE_RECORDS", 1000)
    events = tables.order_job_events(spark, SF_DIR)
    paths = write_topics(events, [C.ORDER_TOPIC, C.DETAIL_TOPIC, C.PAYMENT_TOPIC], str(tmp_path), 5000)
    for path in paths.values():
        files = glob.glob(f"{path}/part-*")
        assert files and all(name.endswith(".gz") for name in files)
        assert all(spark.read.text(name).count() <= 1000 for name in files)
        text = spark.read.text(path).agg(F.sum(F.length("value"))).first()[0]
        assert sum(os.path.getsize(name) for name in files) < text / 4


@pytest.mark.parametrize("name", ["stream_order_alerts", "stream_order_alerts_immutable", "stream_user_alerts"])
def test_scratch_of_a_stream_over_tables_goes(spark, monkeypatch, name):
    before, operators = folders(spark), []

    def remove(session, folder):
        operators.extend(glob.glob(f"{folder}/state/*"))
        assert all(len(glob.glob(f"{operator}/[0-9]*")) <= FEW_PARTITIONS for operator in operators)
        remove_folder(session, folder)

    monkeypatch.setattr(streamed, "remove_folder", remove)
    assert registry.QUERIES[name](spark, SF_DIR).count() > 0
    (folder,) = folders(spark) - before
    assert os.listdir(folder) == ["out"] and operators


def test_scratch_of_a_failed_stream_goes(spark):
    before = folders(spark)
    wrong = tables.order_events(spark, SF_DIR).withColumn("user_id", F.lit("nobody"))
    with pytest.raises(Exception, match="type:user_id"):
        streamed.run_over_tables(spark, wrong, [C.ORDER_TOPIC, C.PAYMENT_TOPIC], lambda events: events, 5000)
    (folder,) = folders(spark) - before
    assert not {"in", "checkpoint"} & set(os.listdir(folder))
