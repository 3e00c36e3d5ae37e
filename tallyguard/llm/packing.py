"""Packing documents into token sequences: best-fit decreasing over windows of fixed size.

Overlong documents are cut into full windows and a rest. All pieces of one length are alike, so
the choice of windows needs the number of pieces per length only: a table of at most ``size``
counts, however large the corpus. A segment tree indexed by remaining capacity finds the tightest
open window; pieces of one length are placed in runs, which gives the same windows as placing them
one by one. Spark numbers the pieces of each length and looks their places up.

Null text counts as empty (it still has the end token); texts are tokenized whole; rows that tie
in key, place and tokens are interchangeable; an empty table gives an empty table.
"""

from __future__ import annotations

import base64
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyguard.llm.common import numbered, stored

SIZE, END = 2048, 1
SPECIAL = "<|endoftext|>"
# Parts in which the pieces of one length are numbered.
PARTS = 256


@lru_cache(maxsize=2)
def _encoder(ranks_path: str, json_path: str):
    """Token ids of a text, as the tokenizers library gives them for the JSON file.

    The rank file holds the same vocabulary for a faster library; a text that this one cannot
    take (it gives up on extremely long runs of white space) goes to the former.
    """
    import tiktoken
    from tokenizers import Tokenizer

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding(
        "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={SPECIAL: len(ranks)}
    )
    exact = Tokenizer.from_file(json_path)

    def encode(text: str) -> list[int]:
        try:
            return fast.encode(text, allowed_special="all")
        except BaseException as error:
            if type(error).__name__ != "PanicException" and not isinstance(error, ValueError):
                raise
            return exact.encode(text, add_special_tokens=False).ids

    return encode


def pieces(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    size: int = SIZE,
    end: int = END,
    with_ids: bool = False,
    ranks_path: str | None = None,
    json_path: str | None = None,
) -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens, and the ids on request."""
    ranks_path = ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    json_path = json_path or public_tokenizers.path("byte_bpe_50k.json")
    fields = [docs.schema[key]] + [
        T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32", "doc_tokens")
    ]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(ranks_path, json_path)
        for batch in batches:
            rows, numbers, tokens = [], [[], [], [], []], []
            for place, value in enumerate(batch.column(1)):
                ids = array("I", encode(value.as_py() or ""))
                ids.append(end)
                for start in range(0, len(ids), size):
                    part = ids[start : start + size]
                    rows.append(place)
                    for column, x in zip(numbers, (start, len(part), zlib.crc32(part), len(ids))):
                        column.append(x)
                    if with_ids:
                        tokens.append(part)
            columns = [batch.column(0).take(pa.array(rows, pa.int64())), *[pa.array(c, pa.int64()) for c in numbers]]
            if with_ids:
                columns.append(pa.array(tokens, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    return docs.select(key, text).mapInArrow(cut, T.StructType(fields))


class CapacityTree:
    """Open windows by remaining capacity; finds the smallest capacity that is enough.

    A complete binary tree over the capacities; a node says whether any window is open below it.
    """

    def __init__(self, size: int):
        self.width = 1 << size.bit_length()
        self.open = [False] * (2 * self.width)
        self.runs: dict[int, list[tuple[int, int]]] = {}

    def _mark(self, capacity: int, value: bool) -> None:
        node = self.width + capacity
        self.open[node] = value
        while node > 1:
            node //= 2
            self.open[node] = self.open[2 * node] or self.open[2 * node + 1]

    def put(self, capacity: int, first: int, count: int) -> None:
        """``count`` windows from number ``first`` have this capacity left."""
        if count and capacity:
            self.runs.setdefault(capacity, []).append((first, count))
            if not self.open[self.width + capacity]:
                self._mark(capacity, True)

    def take(self, least: int) -> tuple[int, int, int] | None:
        """Remove a run of the tightest windows with ``least`` or more left: capacity, first, count."""
        node = self.width + least
        if not self.open[node]:
            # Up until a right sibling has open windows, then down its left edge.
            while node > 1 and (node % 2 or not self.open[node + 1]):
                node //= 2
            if node <= 1:
                return None
            node += 1
            while node < self.width:
                node = 2 * node if self.open[2 * node] else 2 * node + 1
        capacity = node - self.width
        run = self.runs[capacity].pop()
        if not self.runs[capacity]:
            self._mark(capacity, False)
        return capacity, *run


def best_fit(counts: dict[int, int], size: int) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing of ``counts[length]`` pieces into windows of ``size``.

    Entries (length, first rank, first window, pieces per window, offset): pieces of the length
    from that rank on fill windows from that number on, so many each, from that offset.
    """
    tree, entries, windows = CapacityTree(size), [], 0
    for length in sorted(counts, reverse=True):
        rank, total = 0, counts[length]
        while rank < total:
            found = tree.take(length)
            if found is None:
                # As many new windows as this run may need; what it does not use is not opened.
                capacity, first, count = size, windows, -(-(total - rank) // (size // length))
                windows += count
            else:
                capacity, first, count = found
            each, offset = capacity // length, size - capacity
            full = min(count, (total - rank) // each)
            if full:
                entries.append((length, rank, first, each, offset))
                rank += full * each
                tree.put(capacity - each * length, first, full)
            if full < count:
                some = total - rank
                if some:
                    entries.append((length, rank, first + full, some, offset))
                    rank = total
                    tree.put(capacity - some * length, first + full, 1)
                tree.put(capacity, first + full + bool(some), count - full - bool(some))
    return entries


def pack(
    cut: DataFrame, key: str = "doc_id", size: int = SIZE
) -> DataFrame:
    """``cut`` (see ``pieces``; read three times: pass a stored table) with sequence_id and offset."""
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    entries: dict[int, list] = {}
    for length, *rest in best_fit(counts, size):
        entries.setdefault(length, []).append(tuple(rest))
    run = "array<struct<rank:bigint,window:bigint,each:bigint,offset:bigint>>"
    places = cut.sparkSession.createDataFrame(list(entries.items()), f"length bigint, runs {run}")
    ranked = numbered(cut, ["length"], [key, "start", "ids_crc32", "doc_tokens"], "_rank", PARTS)
    # The table has a row per length, and its runs depend on the number of lengths.
    placed = ranked.join(F.broadcast(places), "length")
    last = F.size(F.filter("runs", lambda r: r["rank"] <= F.col("_rank")))
    placed = placed.withColumn("_run", F.get("runs", last - 1))
    place = F.col("_rank") - F.col("_run.rank")
    return placed.select(
        *[c for c in cut.columns],
        (F.col("_run.window") + F.floor(place / F.col("_run.each"))).cast("bigint").alias("sequence_id"),
        (F.col("_run.offset") + place % F.col("_run.each") * F.col("length")).alias("offset"),
    )


def packed(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE, **options) -> DataFrame:
    """All pieces of ``docs`` with their places in sequences of ``size`` tokens."""
    return pack(stored(pieces(docs, key, text, size, **options), "pieces"), key, size)
