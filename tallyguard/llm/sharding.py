"""Sharding by best-fit decreasing bin packing: rows of one group stay together.

Groups are equal texts. Groups of one size are alike, so the choice of shards needs the number of
groups per size only (distinct sizes are at most the square root of twice all bytes). A balanced
tree of runs of equally full shards finds the tightest remaining capacity; groups of one size are
placed in runs, which gives the same loads as placing them one by one. Spark numbers the groups of
each size and looks their shards up.

Null text counts as empty; texts are hashed whole; equal rows are interchangeable; a group larger
than a shard's share has a shard of its own, and the others get equal capacities; an empty table gives an
empty table.
"""

from __future__ import annotations

import random
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyguard.llm.common import numbered, stored, whole_text

# The rows of a group with this share of all rows are joined by broadcast; there are never more such groups.
LARGE_SHARE = 20_000
# Parts in which the groups of one size are numbered.
PARTS = 256


@dataclass
class _Node:
    key: tuple[int, int]
    weight: float
    count: int = 1
    left: _Node | None = None
    right: _Node | None = None


class BinTree:
    """Runs of bins by (remaining capacity, first number) in a treap: the tightest in logarithmic time."""

    def __init__(self):
        self.root: _Node | None = None
        self.random = random.Random(1)

    def _split(self, node: _Node | None, key: tuple) -> tuple[_Node | None, _Node | None]:
        """Nodes below ``key`` and the others."""
        if node is None:
            return None, None
        if node.key < key:
            node.right, rest = self._split(node.right, key)
            return node, rest
        rest, node.left = self._split(node.left, key)
        return rest, node

    def _join(self, low: _Node | None, high: _Node | None) -> _Node | None:
        if low is None or high is None:
            return low or high
        if low.weight > high.weight:
            low.right = self._join(low.right, high)
            return low
        high.left = self._join(low, high.left)
        return high

    def add(self, remaining: int, number: int, count: int = 1) -> None:
        """``count`` bins from ``number`` on have this capacity left."""
        low, high = self._split(self.root, (remaining, number))
        self.root = self._join(self._join(low, _Node((remaining, number), self.random.random(), count)), high)

    def take(self, size: int) -> tuple[int, int, int] | None:
        """Remove the run with the least remaining capacity of ``size`` or more: capacity, first, count."""
        low, high = self._split(self.root, (size, -1))
        node = high
        while node is not None and node.left is not None:
            node = node.left
        if node is not None:
            _, high = self._split(high, (node.key[0], node.key[1] + 1))
        self.root = self._join(low, high)
        return (*node.key, node.count) if node else None

    def take_emptiest(self) -> tuple[int, int, int]:
        node = self.root
        while node.right is not None:
            node = node.right
        self.root, _ = self._split(self.root, node.key)
        return (*node.key, node.count)


def best_fit_runs(
    counts: dict[int, int], capacity: int, count: int | None, first: int = 0
) -> tuple[list[tuple[int, int, int, int]], dict[int, int]]:
    """Best-fit decreasing of ``counts[size]`` groups into bins numbered from ``first`` on.

    Entries (size, first rank, first bin, groups per bin): groups of the size from that rank on fill
    bins from that number on, so many each. Also the remaining capacities of the used bins. With
    ``count`` bins, a group that fits nowhere goes to the emptiest; else it opens a bin.
    """
    tree, entries, bins, used = BinTree(), [], first + (count or 0), {}
    if count:
        tree.add(capacity, first, count)

    def fill(size: int, rank: int, bin_: int, each: int, left: int, many: int) -> None:
        entries.append((size, rank, bin_, each))
        tree.add(left - each * size, bin_, many)

    for size in sorted(counts, reverse=True):
        rank, total = 0, counts[size]
        while rank < total:
            found = tree.take(size)
            if found is None and count:
                left, bin_, many = tree.take_emptiest()
                fill(size, rank, bin_, 1, left, 1)
                rank += 1
                if many > 1:
                    tree.add(left, bin_ + 1, many - 1)
                continue
            if found is None:
                # As many new bins as this size needs; a group larger than a bin has one alone.
                found = capacity, bins, -(-(total - rank) // max(capacity // size, 1))
                bins += found[2]
            left, bin_, many = found
            each = max(left // size, 1)
            full = min(many, (total - rank) // each)
            if full:
                fill(size, rank, bin_, each, left, full)
                rank += full * each
            some = total - rank if full < many else 0
            if some:
                fill(size, rank, bin_ + full, some, left, 1)
                rank = total
            rest = many - full - bool(some)
            if rest:
                tree.add(left, bin_ + full + bool(some), rest)
    while (found := tree.take(-(1 << 63))) is not None:
        used[found[1]] = found
    return entries, {n + i: left for left, n, many in used.values() for i in range(many)}


def best_fit(sizes: list[int], capacity: int, count: int | None) -> tuple[list[int], list[int]]:
    """The bin of each of the falling ``sizes``, and the bins' remaining capacities.

    With ``count`` bins, a size that fits nowhere goes to the emptiest; else it opens a bin.
    """
    counts = Counter(sizes)
    entries, remaining = best_fit_runs(counts, capacity, count)
    ends = [b[1] if b[0] == a[0] else counts[a[0]] for a, b in zip(entries, [*entries[1:], (None, 0)])]
    bins = [first + i // each for (_, rank, first, each), end in zip(entries, ends) for i in range(end - rank)]
    return bins, [remaining[n] for n in sorted(remaining)]


def shard_plan(counts: dict[int, int], count: int | None, capacity: int | None) -> list[tuple[int, int, int, int]]:
    """Entries as of ``best_fit_runs``, for ``count`` shards as equal as can be or shards of ``capacity``.

    Of ``count`` shards, the largest groups take one each while they hold a share or more of what is left.
    """
    if count is None:
        return best_fit_runs(counts, capacity, None)[0]
    left, rest, alone = dict(counts), sum(size * n for size, n in counts.items()), []
    for size in sorted(counts, reverse=True):
        # The last shard takes all that is left.
        own = 0
        while own < left[size] and len(alone) < count - 1 and size * (count - len(alone)) >= rest:
            alone.append((size, own, len(alone), 1))
            own, rest = own + 1, rest - size
        left[size] -= own
        if left[size]:
            break
    bins = count - len(alone)
    entries, _ = best_fit_runs({s: n for s, n in left.items() if n}, max(-(-rest // bins), 1), bins, len(alone))
    shift = Counter(size for size, *_ in alone)
    return alone + [(size, rank + shift[size], first, each) for size, rank, first, each in entries]


def looked_up(ranked: DataFrame, group: str, plan: list[tuple[int, int, int, int]], counts: dict[int, int]) -> DataFrame:
    """``group`` and ``shard`` of groups with ``bytes`` and their ``rank`` among those of equal bytes."""
    # Sizes in order, with the groups before each: then one number tells a group's place in the plan.
    sizes = np.array(sorted(counts), np.int64)
    before = np.concatenate([[0], np.cumsum([counts[s] for s in sizes.tolist()])[:-1]]).astype(np.int64)
    runs = np.array(plan, np.int64).reshape(-1, 4)
    starts = before[np.searchsorted(sizes, runs[:, 0])] + runs[:, 1] if len(runs) else np.zeros(0, np.int64)
    order = np.argsort(starts, kind="stable")
    starts, firsts, each = starts[order], runs[order, 2], runs[order, 3]

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, rank = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            at = before[np.searchsorted(sizes, size)] + rank
            run = np.searchsorted(starts, at, "right") - 1
            shard = firsts[run] + (at - starts[run]) // each[run]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(shard.astype(np.int32), pa.int32())], names=[group, "shard"]
            )

    rows = ranked.select(group, "bytes", F.col("rank").cast("bigint").alias("rank"))
    return rows.mapInArrow(look, T.StructType([ranked.schema[group], T.StructField("shard", T.IntegerType())]))


def assign(rows: DataFrame, group: str, size: str, count: int | None = None, capacity: int | None = None) -> DataFrame:
    """``rows`` with ``shard``: ``count`` shards of equal size, or as few as possible of ``capacity``.

    Rows with equal ``group``, null among them, go to one shard; a group of null or no size counts as 1. ``rows`` is read several times: pass a stored table.
    """
    if (count is None) == (capacity is None):
        raise ValueError("either a number of shards or a capacity")
    summed = F.greatest(F.coalesce(F.sum(size), F.lit(0)), F.lit(1)).alias("bytes")
    groups = stored(rows.groupBy(group).agg(summed, F.count(F.lit(1)).alias("n")), "groups")
    # A row per distinct size.
    found = groups.groupBy("bytes").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("n")).collect()
    counts, all_rows = {r["bytes"]: r["c"] for r in found}, sum(r["n"] for r in found)
    ranked = numbered(groups, ["bytes"], [group], "rank", PARTS)
    shards = looked_up(ranked, group, shard_plan(counts, count, capacity), counts)
    is_large = F.col("n") * LARGE_SHARE >= F.lit(all_rows)
    large = groups.filter(is_large).select(F.col(group).alias("_large"), F.lit(True).alias("_is_large"))
    same = F.col("_group").eqNullSafe(F.col("_large"))
    shards = shards.withColumnRenamed(group, "_group")
    placed = stored(shards.join(F.broadcast(large), same, "left").drop("_large"), "placed")
    # Large groups may hold most rows; their table is bounded, so they need no shuffle by group.
    heavy, light = (placed.filter(c).drop("_is_large") for c in (F.col("_is_large"), F.col("_is_large").isNull()))
    # A null group is a group like any other.
    same = F.col(group).eqNullSafe(F.col("_group"))
    hot = rows.join(F.broadcast(heavy), same)
    others = rows.join(F.broadcast(heavy.select("_group")), same, "left_anti").join(light, same)
    return hot.unionByName(others).drop("_group")


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: the key, its size (bytes of the text and one), the text's CRC and its digest."""
    whole = whole_text(text)
    return docs.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(whole) + 1).cast("bigint").alias("size"),
        F.crc32(whole.cast("binary")).alias("text_crc32"),
        F.unhex(F.sha2(whole, 256)).alias("digest"),
    )


def shard_documents(docs: DataFrame, count: int | None = None, capacity: int | None = None) -> DataFrame:
    """doc_id, size, text_crc32, shard, and slot: the document's number in its shard."""
    rows = stored(digests(docs), "digests")
    placed = stored(assign(rows, "digest", "size", count, capacity), "shards")
    return numbered(placed, ["shard"], ["doc_id", "size", "text_crc32"], "slot").drop("digest")
