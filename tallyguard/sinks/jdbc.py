"""Keyed merge of alerts into a MySQL table: executors fill a staging table, one statement merges it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyguard.config import JobConfig


def merge_statement(table: str, staging: str, columns: list[str], key: str = "alert_id") -> str:
    """Insert the staged rows; a row whose key exists updates the old one."""
    names = ", ".join(columns)
    updates = ", ".join(f"{c} = VALUES({c})" for c in columns if c != key)
    return f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging} ON DUPLICATE KEY UPDATE {updates}"


def staging_options(config: JobConfig, staging: str) -> dict[str, str]:
    if not config.mysql_url:
        raise ValueError("MYSQL_HOST is not set")
    return {
        "url": config.mysql_url,
        "user": config.mysql_user or "",
        "password": config.mysql_password or "",
        "dbtable": staging,
        "driver": config.mysql_driver,
        "batchsize": str(config.sink_batch_rows),
        # A bound on connections; it follows the shuffle of ``merge_batch``.
        "numPartitions": str(config.sink_connections),
    }


def _execute(spark: SparkSession, config: JobConfig, statement: str) -> None:
    """One statement on the driver; the data frame API can only append or overwrite."""
    jvm = spark._jvm
    properties = jvm.java.util.Properties()
    properties.setProperty("user", config.mysql_user or "")
    properties.setProperty("password", config.mysql_password or "")
    # Jars added at submission are known to the thread's class loader only.
    loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
    connection = loader.loadClass(config.mysql_driver).newInstance().connect(config.mysql_url, properties)
    try:
        connection.createStatement().executeUpdate(statement)
    finally:
        connection.close()


def staging_table(table: str, run: str, batch_id: int) -> str:
    """A name of its own per run and batch: a driver that is slow to die and its successor share none."""
    return f"{table}_staging_{run.replace('-', '')[:12]}_{batch_id}"


def merge_batch(
    alerts: DataFrame, config: JobConfig, table: str, run: str = "only", batch_id: int = 0, execute=_execute
) -> None:
    """Write this batch to its staging table, merge it and drop the staging table; safe to repeat."""
    staging, spark = staging_table(table, run, batch_id), alerts.sparkSession
    unique = alerts.dropDuplicates(["alert_id"])
    unique.write.format("jdbc").options(**staging_options(config, staging)).mode("overwrite").save()
    execute(spark, config, merge_statement(table, staging, alerts.columns))
    execute(spark, config, f"DROP TABLE {staging}")
