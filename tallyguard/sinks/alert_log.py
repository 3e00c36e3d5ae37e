"""Alerts on shared storage: one folder per job, run and micro-batch, the newest row per alert id on reading.

A run is a streaming query's checkpoint: writing one of its batches again replaces that batch's
folder, while another job, or a run with a new checkpoint, never touches older folders. The same
alert in a later batch or run is a newer version of the same id, so a replay changes no alert but
its update time.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PLACE = {"job": T.StringType(), "run": T.StringType(), "batch": T.LongType()}


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """The streaming query's own id, which lives as long as its checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()["value"])["id"]


def append_batch(
    alerts: DataFrame, path: str, batch_id: int, job: str = "alerts", run: str = "only", files_per_date: int = 8
) -> None:
    """Write one batch; the rows of a date go to a few files, however many tasks made them."""
    part = F.pmod(F.xxhash64("alert_id"), F.lit(files_per_date))
    rows = alerts.repartition("alert_date", part)
    folder = f"{path.rstrip('/')}/job={job}/run={run}/batch={batch_id}"
    rows.write.mode("overwrite").partitionBy("alert_date").parquet(folder)


def read_log(spark: SparkSession, path: str, schema: T.StructType, job: str | None = None) -> DataFrame:
    """All written rows, or one job's where several write below ``path``; ``alert_date`` prunes folders."""
    logged = T.StructType([*schema.fields, *[T.StructField(n, t) for n, t in PLACE.items()]])
    rows = spark.read.schema(logged).option("basePath", path).parquet(path)
    return rows.filter(F.col("job") == job) if job else rows


def current_alerts(spark: SparkSession, path: str, schema: T.StructType, job: str | None = None) -> DataFrame:
    """One row per alert id. An id carries its date, so a filter on ``alert_date`` still prunes."""
    log = read_log(spark, path, schema, job)
    rest = ["update_time", "batch", "run"]
    rest += [f.name for f in schema.fields if f.name not in (*rest, "alert_date", "alert_id")]
    newest = log.groupBy("alert_date", "alert_id").agg(F.max(F.struct(*rest)).alias("row"))
    return newest.select(*[n if n in ("alert_date", "alert_id") else f"row.{n}" for n in schema.names])
