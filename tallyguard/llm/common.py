"""Helpers that the operators of this folder share."""

from __future__ import annotations

import functools
import os
import shutil
import tempfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import tallyguard
from tallyguard.sinks.shared import shared_folder

# Ids of the applications that have this package.
_SHIPPED: set[str] = set()

# A key with at least one row in so many is joined by broadcast; there are never more such keys.
HEAVY_SHARE = 1000
# Parts in which rows of one group are numbered.
NUMBER_PARTS = 1024
BLOCK = 128


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Let executors, new ones too, import this package: Spark hands them a zip of it, once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    source = os.path.dirname(os.path.abspath(tallyguard.__file__))
    with tempfile.TemporaryDirectory() as folder:
        tree = os.path.join(folder, "tree")
        shutil.copytree(source, os.path.join(tree, "tallyguard"), ignore=shutil.ignore_patterns("__pycache__"))
        # Kept until the application ends, since later executors fetch it as well.
        kept = tempfile.mkdtemp(prefix="tallyguard-")
        context.addPyFile(shutil.make_archive(os.path.join(kept, "tallyguard"), "zip", tree))
    _SHIPPED.add(context.applicationId)


def shipping(query: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A query that ships the package before it runs."""

    @functools.wraps(query)
    def run(spark: SparkSession, *rest) -> DataFrame:
        ship_package(spark)
        return query(spark, *rest)

    return run


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the folder that all executors share, and read from there.

    Cuts the lineage: a lost executor costs at most the tasks after this point.
    """
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def whole_text(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed once per row, however often later steps use them (a generator
    is not merged into them)."""
    kept = [c for c in df.columns if c not in columns]
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select(*[F.col(f"`{c}`") for c in kept], F.inline(F.array(row)))


def running(steps: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """Inclusive running results, from 0, over an array of bigint, in blocks, so that long arrays cost little more."""

    def results(values: Column) -> Column:
        start = F.struct(F.lit(0).cast("bigint").alias("last"), F.array().cast("array<bigint>").alias("out"))

        def add(acc: Column, x: Column) -> Column:
            last = combine(acc["last"], x)
            return F.struct(last.alias("last"), F.concat(acc["out"], F.array(last)).alias("out"))

        return F.aggregate(values, start, add, lambda acc: acc["out"])

    last = F.floor((F.size(steps) - 1) / BLOCK).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), last), lambda b: results(F.slice(steps, b * BLOCK + 1, F.lit(BLOCK))))
    totals = results(F.transform(blocks, lambda b: F.element_at(b, -1)))
    before = F.concat(F.array(F.lit(0).cast("bigint")), F.slice(totals, F.lit(1), F.size(totals) - 1))
    shifted = F.zip_with(blocks, before, lambda b, c: F.transform(b, lambda x: combine(c, x)))
    return F.when(F.size(steps) > 0, F.flatten(shifted)).otherwise(F.array().cast("array<bigint>"))


def running_sums(steps: Column) -> Column:
    return running(steps, lambda a, b: a + b)


def running_greatest(steps: Column) -> Column:
    """Of numbers that are not negative."""
    return running(steps, lambda a, b: F.greatest(a, b))


def join_keys(rows: DataFrame, keyed: DataFrame, key: str, count: str) -> DataFrame:
    """``rows`` with the columns of ``keyed``, which has every key once and its number of rows.

    Keys with a thousandth of all rows or more (a thousand keys at most) are broadcast,
    so no hot key meets in one task; the others are joined by shuffle. ``rows`` is read
    twice: pass a stored table.
    """
    total = keyed.agg(F.coalesce(F.sum(count), F.lit(0)).alias("n")).first()["n"]
    is_heavy = F.col(count) * HEAVY_SHARE >= F.lit(total)
    heavy, light = keyed.filter(is_heavy).drop(count), keyed.filter(~is_heavy).drop(count)
    hot = rows.join(F.broadcast(heavy), key)
    rest = rows.join(F.broadcast(heavy.select(key)), key, "left_anti").join(light, key)
    return hot.unionByName(rest)


def numbered(rows: DataFrame, group: list[str], order: list[str], name: str, parts: int = NUMBER_PARTS) -> DataFrame:
    """Number the rows of each group gaplessly from 0 without gathering a group in one task.

    A group is dealt into ``parts`` by a hash of the ordering columns; each part is numbered
    on its own and shifted by the rows of the parts before. Rows that tie in all ordering
    columns are interchangeable. ``rows`` is read twice: pass a stored table.
    """
    dealt = rows.withColumn("_part", F.pmod(F.xxhash64(*order), F.lit(parts)))
    counts = dealt.groupBy(*group, "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select(*group, "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    within = Window.partitionBy(*group, "_part").orderBy(*order)
    local = dealt.withColumn("_local", F.row_number().over(within) - 1)
    joined = local.join(shifts, [*group, "_part"])
    return joined.withColumn(name, F.col("_shift") + F.col("_local")).drop("_part", "_local", "_shift")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, longer where a column of the table starts like it."""
    taken = [c.lower() for c in df.columns]
    while any(c.startswith(name.lower()) for c in taken):
        name = f"_{name}"
    return name


def double_array(values) -> Column:
    """A constant array, written as one text so that the plan stays small; Spark folds it once."""
    return F.split(F.lit(",".join(f"{v:.4g}" for v in values)), ",").cast("array<double>")
