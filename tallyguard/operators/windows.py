"""Counts over sliding windows, without one row per event and window.

A window is named by its slot: window end divided by the slide. An item that lies in
``m`` consecutive windows adds one at its first slot and takes one away ``m`` slots
later; running sums of these steps are the counts, constant between two steps.
Time is cut into blocks of ``block_slots`` slots and an item that crosses a border
gets steps in both blocks, so running sums stay inside a block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_window_slot(time_ms: Column, slide_ms: Column) -> Column:
    """Slot of the first window (start inclusive, end exclusive) that contains the instant."""
    return F.floor(time_ms / slide_ms).cast("bigint") + 1


def window_ends(time_ms: Column, size_ms: int, slide_ms: int) -> Column:
    """Ends of all windows that contain the instant, epoch aligned."""
    first = first_window_slot(time_ms, F.lit(slide_ms)) * slide_ms
    return F.sequence(first, first + (size_ms - slide_ms), F.lit(slide_ms).cast("bigint"))


def count_runs(items: DataFrame, keys: list[str], block_slots: int) -> DataFrame:
    """Runs of consecutive window slots with the same positive count.

    ``items`` has ``keys``, ``first_slot`` and ``slots`` (how many windows it counts
    in). The result has ``keys``, ``block``, ``from_slot``, ``to_slot`` (inclusive) and
    ``count``.
    """
    size = F.lit(block_slots).cast("bigint")
    end = F.col("first_slot") + F.col("slots")
    blocks = F.sequence(
        F.floor(F.col("first_slot") / size).cast("bigint"), F.floor((end - 1) / size).cast("bigint")
    )

    def step(block, slot, change):
        return F.struct(block.alias("block"), slot.alias("slot"), F.lit(change).cast("bigint").alias("change"))

    steps = F.flatten(
        F.transform(
            blocks,
            lambda b: F.array(
                step(b, F.greatest(F.col("first_slot"), b * size), 1),
                step(b, F.least(end, (b + 1) * size), -1),
            ),
        )
    )
    changes = (
        items.filter(F.col("slots") > 0)
        .select(*keys, F.inline(steps))
        .groupBy(*keys, "block", "slot")
        .agg(F.sum("change").alias("change"))
    )
    in_block = Window.partitionBy(*keys, "block").orderBy("slot")
    return (
        changes.withColumns(
            {
                "count": F.sum("change").over(in_block.rowsBetween(Window.unboundedPreceding, 0)),
                "to_slot": F.lead("slot").over(in_block) - 1,
            }
        )
        .filter(F.col("count") > 0)
        .select(*keys, "block", F.col("slot").alias("from_slot"), "to_slot", "count")
    )


def each_slot(runs: DataFrame) -> DataFrame:
    """One row per window: ``keys``, ``slot``, ``count``."""
    keys = [c for c in runs.columns if c not in ("block", "from_slot", "to_slot", "count")]
    return runs.select(*keys, F.explode(F.sequence("from_slot", "to_slot")).alias("slot"), "count")
