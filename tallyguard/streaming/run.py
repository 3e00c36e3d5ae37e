"""Running the two jobs: sinks per micro-batch, bounded retries, restarts from the checkpoint.

    python -m tallyguard.streaming.run order-risk --alerts /shared/alerts
    python -m tallyguard.streaming.run user-risk --lines /shared/events --alerts /shared/alerts
"""

from __future__ import annotations

import argparse
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyguard import contracts as C
from tallyguard.config import JobConfig, OrderParams, UserParams
from tallyguard.functions.lines import order_line, user_line
from tallyguard.operators.checks import broken_checks, order_alert_checks, user_alert_checks
from tallyguard.operators.validate import quarantined
from tallyguard.sinks.alert_log import append_batch, read_log, run_of
from tallyguard.sinks.jdbc import merge_batch
from tallyguard.sinks.shared import job_folder, remove_folder
from tallyguard.sources.files import stream_lines, topic_files
from tallyguard.sources.kafka import stream_topic
from tallyguard.streaming.intake import state_session, stream_events, topic_inputs
from tallyguard.streaming.late import ALERT, LATE, beside_alerts, late_only
from tallyguard.streaming.order_stream import stream_order_alerts
from tallyguard.streaming.silence import IdleWatch, beat_folders, beat_streams
from tallyguard.streaming.user_stream import stream_user_alerts

BatchWriter = Callable[[DataFrame, int], None]

# Per job: the topics it reads, its rules, its table, the constraints and the console line.
JOBS = {
    C.ORDER_JOB: (
        (C.ORDER_TOPIC, C.DETAIL_TOPIC, C.PAYMENT_TOPIC),
        stream_order_alerts,
        C.ORDER_ALERT_TABLE,
        order_alert_checks,
        order_line,
    ),
    C.USER_JOB: (
        (C.ORDER_TOPIC, C.PAYMENT_TOPIC),
        stream_user_alerts,
        C.USER_ALERT_TABLE,
        user_alert_checks,
        user_line,
    ),
}
DEFAULT_PARAMS = {C.ORDER_JOB: OrderParams(), C.USER_JOB: UserParams()}


def accepted(alerts: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """The alerts, stopping on a row that breaks a constraint of its table."""
    broken = F.explode(F.array(broken_checks(checks))).alias("broken")
    message = F.concat(F.lit("alert "), "alert_id", F.lit(" breaks "), F.array_join("broken", ","))
    stop = F.when(F.size("broken") > 0, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return alerts.select("*", broken).filter(stop).drop("broken")


def with_retries(write: BatchWriter, retries: int, delay_seconds: float = 1.0) -> BatchWriter:
    """Repeat a failed write; every sink here may write a batch more than once."""

    def attempt(alerts: DataFrame, batch_id: int) -> None:
        for number in range(retries + 1):
            try:
                return write(alerts, batch_id)
            except Exception:  # noqa: BLE001
                if number == retries:
                    raise
                time.sleep(delay_seconds)

    return attempt


def _print_rows(rows) -> None:
    for row in rows:
        print(row["line"])


def staged_writer(
    write: BatchWriter,
    checkpoint: str,
    retries: int,
    late_path: str | None = None,
    allowance_ms: int = 0,
    delay_seconds: float = 1.0,
) -> BatchWriter:
    """Evaluate a batch once into a folder beside the checkpoint and write from there.

    Only the writing is repeated after a failure, never the stateful plan. A folder without
    Spark's success marker belongs to a driver that died and is written again. With
    ``late_path`` the batch carries late events as well, which go to a folder per batch there.
    """

    def stage(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        folder = f"{checkpoint.rstrip('/')}-staged/batch={batch_id}"
        rows = late_only(batch, checkpoint, batch_id, allowance_ms) if late_path else batch
        rows.write.mode("overwrite").parquet(folder)
        staged = spark.read.schema(rows.schema).parquet(folder)

        def deliver(staged: DataFrame, batch_id: int) -> None:
            if late_path:
                events = staged.filter(F.col(LATE).isNotNull()).select(f"{LATE}.*", "dropped")
                place = f"{late_path.rstrip('/')}/run={run_of(spark, checkpoint)}/batch={batch_id}"
                events.write.mode("overwrite").json(place)
                staged = staged.filter(F.col(ALERT).isNotNull()).select(f"{ALERT}.*")
            write(staged, batch_id)

        with_retries(deliver, retries, delay_seconds)(staged, batch_id)
        remove_folder(spark, folder)

    return stage


def batch_writer(
    job: str,
    config: JobConfig,
    alert_path: str | None,
    checkpoint: str,
    console: bool = False,
    late_path: str | None = None,
    allowance_ms: int = 0,
) -> BatchWriter:
    """Write a batch to the alert log, if a path is given, else merge it into the job's table."""
    _, _, table, checks, line = JOBS[job]

    def write(alerts: DataFrame, batch_id: int) -> None:
        spark, rows = alerts.sparkSession, accepted(alerts, checks())
        run = run_of(spark, checkpoint)
        if alert_path:
            append_batch(rows, alert_path, batch_id, job, run)
            if console:
                log = read_log(spark, alert_path, alerts.schema, job)
                written = log.filter((F.col("run") == run) & (F.col("batch") == batch_id))
                written.select(line().alias("line")).foreachPartition(_print_rows)
        else:
            merge_batch(rows, config, table, run, batch_id)

    return staged_writer(write, checkpoint, config.sink_retries, late_path, allowance_ms)


def raw_streams(
    spark: SparkSession, job: str, config: JobConfig, lines_path: str | None = None, max_files: int | None = None
) -> dict[str, DataFrame]:
    """The job's topics from Kafka, or from folders of JSON lines below ``lines_path``."""
    topics = JOBS[job][0]
    if lines_path is None:
        return {topic: stream_topic(spark, config, topic, config.max_offsets) for topic in topics}
    paths = topic_files(lines_path)
    return {topic: stream_lines(spark, paths[topic], max_files or config.max_files) for topic in topics}


def start_job(
    spark: SparkSession,
    job: str,
    config: JobConfig,
    alert_path: str | None = None,
    lines_path: str | None = None,
    console: bool = False,
    available_now: bool = False,
    max_files: int | None = None,
    strict: bool = True,
    late_path: str | None = None,
    watermark_per_topic: bool | None = None,
    **rule_options,
) -> StreamingQuery:
    """Start one job in a session of its own; progress lives in the job's own checkpoint.

    Each topic has its own watermark, and a topic that is silent for ``config.idle_seconds`` no
    longer holds the others back. A run over what is there (``available_now``) cannot wait for
    silence and has one watermark over all topics, unless ``watermark_per_topic`` says otherwise.
    A checkpoint keeps the form it was begun with.
    """
    session = state_session(spark, config.shuffle_partitions)
    rules = JOBS[job][1]
    raw = raw_streams(session, job, config, lines_path, max_files)
    checkpoint = config.checkpoint_dir or job_folder(spark, job)
    if watermark_per_topic is None:
        watermark_per_topic = not available_now
    if watermark_per_topic:
        folders = beat_folders(session, checkpoint, list(raw))
        events = topic_inputs(raw, strict, beat_streams(session, folders))
        session.streams.addListener(IdleWatch(session, job, folders, config.idle_seconds))
    else:
        events = stream_events(raw, strict)
    out = rules(events, **rule_options)
    allowance_ms = rule_options.get("allowance_ms")
    if allowance_ms is None:
        allowance_ms = (rule_options.get("params") or DEFAULT_PARAMS[job]).ttl_ms
    if late_path:
        out = beside_alerts(out, raw)
    trigger = {"availableNow": True} if available_now else {"processingTime": f"{config.trigger_seconds} seconds"}
    return (
        out.writeStream.queryName(job)
        .outputMode("append")
        .foreachBatch(batch_writer(job, config, alert_path, checkpoint, console, late_path, allowance_ms))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def start_quarantine(
    spark: SparkSession,
    job: str,
    config: JobConfig,
    path: str,
    lines_path: str | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Keep every text of the job's topics that breaks the contract, with the reasons, as JSON lines."""
    raw = raw_streams(spark, job, config, lines_path)
    bad = None
    for topic, stream in raw.items():
        mine = quarantined(stream, topic)
        bad = mine if bad is None else bad.unionByName(mine)
    checkpoint = f"{config.checkpoint_dir.rstrip('/')}-quarantine" if config.checkpoint_dir else None
    trigger = {"availableNow": True} if available_now else {"processingTime": f"{config.trigger_seconds} seconds"}
    return (
        bad.writeStream.queryName(f"{job}-quarantine")
        .format("json")
        .option("path", path)
        .option("checkpointLocation", checkpoint or job_folder(spark, f"{job}-quarantine"))
        .trigger(**trigger)
        .start()
    )


def run_with_restarts(start: Callable[[], StreamingQuery], restarts: int, delay_seconds: float) -> None:
    """Wait for the query; after a failure start it again from its checkpoint, at most ``restarts`` times."""
    for number in range(restarts + 1):
        try:
            start().awaitTermination()
            return
        except Exception:  # noqa: BLE001
            if number == restarts:
                raise
            time.sleep(delay_seconds)


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Run one risk job.")
    parser.add_argument("job", choices=sorted(JOBS))
    parser.add_argument("--alerts", help="folder of the alert log; without it alerts go to MySQL")
    parser.add_argument("--lines", help="folder with JSON lines per topic instead of Kafka")
    parser.add_argument("--quarantine", help="keep invalid texts in this folder; malformed ones no longer stop the job")
    parser.add_argument("--late", help="keep late events in this folder, with a mark on those the rules could not use")
    parser.add_argument("--console", action="store_true", help="also print each alert in one line")
    parser.add_argument(
        "--immutable-facts", action="store_true", help="order-risk only: the producer never sends second versions"
    )
    parser.add_argument("--available-now", action="store_true", help="process what is there and stop")
    options = parser.parse_args(arguments)
    config = JobConfig.from_env(options.job)
    spark = SparkSession.builder.appName(options.job).getOrCreate()
    quarantine = None
    if options.quarantine:
        quarantine = start_quarantine(
            spark, options.job, config, options.quarantine, options.lines, options.available_now
        )

    rule_options = {"immutable_facts": True} if options.immutable_facts else {}

    def start() -> StreamingQuery:
        return start_job(
            spark,
            options.job,
            config,
            options.alerts,
            options.lines,
            options.console,
            options.available_now,
            strict=not options.quarantine,
            late_path=options.late,
            **rule_options,
        )

    run_with_restarts(
        start,
        config.restarts,
        config.restart_delay_seconds,
    )
    if quarantine:
        quarantine.awaitTermination()


if __name__ == "__main__":
    main()
