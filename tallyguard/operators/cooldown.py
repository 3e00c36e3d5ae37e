"""Greedy cooldown over candidate windows.

Slots are taken in order; after a taken slot the next ``pause - 1`` slots are skipped.
The choice depends on all earlier slots of a key, but a block of slots only needs
to know how many of its first slots are still paused, one of ``pause`` numbers. So
each block is folded on its own for every such number, the blocks of a key are
chained through these small tables, and each block then picks its slots from the
number it really starts with. No group is larger than a block of slots or the
list of a key's blocks, whatever the number of events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _first_allowed(free: Column, run: Column) -> Column:
    return F.greatest(free, run["from_slot"])


def _free_after(free: Column, run: Column, pause: Column) -> Column:
    """First free slot after a run of candidates, given the first free slot before it."""
    first = _first_allowed(free, run)
    taken = F.floor((run["to_slot"] - first) / pause).cast("bigint") + 1
    return F.when(first <= run["to_slot"], first + taken * pause).otherwise(free)


def cooled_down(runs: DataFrame, keys: list[str], pause: Column, block_slots: int) -> DataFrame:
    """The slots of candidate ``runs`` that survive the cooldown: ``keys``, ``slot``, ``count``.

    ``runs`` has ``keys``, ``block``, ``from_slot``, ``to_slot``, ``count`` and no run leaves
    its block; ``pause`` is a positive expression over ``keys``, at most ``block_slots``.
    """
    size = F.lit(block_slots).cast("bigint")
    pause = pause.cast("bigint")
    start, end = F.col("block") * size, (F.col("block") + 1) * size
    run = F.struct("from_slot", "to_slot", "count")
    blocks = runs.groupBy(*keys, "block").agg(F.array_sort(F.collect_list(run)).alias("runs"))

    leftover = F.transform(
        F.sequence(F.lit(0).cast("bigint"), pause - 1),
        lambda paused: F.aggregate(
            "runs",
            start + paused,
            lambda free, r: _free_after(free, r, pause),
            lambda free: F.greatest(F.lit(0).cast("bigint"), free - end),
        ),
    )
    tables = blocks.select(*keys, F.struct("block", leftover.alias("leftover")).alias("entry"))
    chains = tables.groupBy(*keys).agg(F.array_sort(F.collect_list("entry")).alias("chain"))

    # A block without candidates ends any pause, so only neighbours pass one on.
    zero = F.struct(
        F.lit(None).cast("bigint").alias("block"),
        F.lit(0).cast("bigint").alias("paused"),
        F.array().cast("array<struct<block:bigint,paused:bigint>>").alias("starts"),
    )

    def link(state, entry):
        neighbour = F.coalesce(state["block"] + 1 == entry["block"], F.lit(False))
        paused = F.when(neighbour, state["paused"]).otherwise(F.lit(0).cast("bigint"))
        return F.struct(
            entry["block"].alias("block"),
            F.get(entry["leftover"], paused.cast("int")).alias("paused"),
            F.concat(
                state["starts"], F.array(F.struct(entry["block"].alias("block"), paused.alias("paused")))
            ).alias("starts"),
        )

    starts = chains.select(*keys, F.inline(F.aggregate("chain", zero, link, lambda s: s["starts"])))

    picked_type = "array<struct<slot:bigint,count:bigint>>"
    picks_zero = F.struct(
        (start + F.col("paused")).alias("free"), F.array().cast(picked_type).alias("picks")
    )

    def pick(state, r):
        first = _first_allowed(state["free"], r)
        fits = first <= r["to_slot"]
        chosen = F.transform(
            F.sequence(first, r["to_slot"], pause),
            lambda s: F.struct(s.alias("slot"), r["count"].alias("count")),
        )
        return F.struct(
            _free_after(state["free"], r, pause).alias("free"),
            F.when(fits, F.concat(state["picks"], chosen)).otherwise(state["picks"]).alias("picks"),
        )

    return blocks.join(starts, [*keys, "block"]).select(
        *keys, F.inline(F.aggregate("runs", picks_zero, pick, lambda s: s["picks"]))
    )
