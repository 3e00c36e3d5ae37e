"""SimHash near-duplicates: meet-in-the-middle ball hashing.

Fingerprints at ``radius`` bits or less share a variant: a value within half the radius of both.
Every distinct fingerprint emits all its variants, variants are grouped, and the fingerprints of a
variant are verified and linked. Classes are the connected components of the links.

The variants of a fingerprint go to the shuffle as one row per block of variants (those with the
same leading bits) and are written out inside the block, so the shuffle carries a small part of
them. A block too large for memory is taken in smaller blocks, one after the other. Links leave a
block as a spanning star of each component found there.

Null text counts as empty; texts without words have fingerprint 0; texts are taken whole; repeated
rows give repeated result rows; null document ids never name a class unless all its ids are null;
an empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyguard.llm.common import free_name, join_keys, stored

BITS = 64
SEED = 42
# Shingles that are hashed and counted at a time.
SLICE = 1 << 18
# Variants that a block of average size has, and that are in memory at once at most.
BLOCK_VARIANTS, VARIANTS_AT_ONCE = 1 << 21, 1 << 23
SPLIT_BITS = 6
# Votes of three bits in one integer, in lanes of 21 bits.
LANE = 21
LANES = 1 | 1 << LANE | 1 << 2 * LANE


def shingles(text: str | None, size: int) -> list[bytes]:
    # On bytes, lower() changes A-Z only and split() cuts at the six ASCII white spaces only.
    words = (text or "").encode().lower().split()
    if len(words) < size:
        return [b" ".join(words)] if words else []
    return list(map(b" ".join, zip(*[words[i:] for i in range(size)])))


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), SLICE):
        part = hashes[at : at + SLICE]
        for j in range(LANE):
            total = int(((part >> np.uint64(j)) & np.uint64(LANES)).sum())
            for lane in range(3):
                counts[j + lane * LANE] += total >> lane * LANE & ((1 << LANE) - 1)
        counts[BITS - 1] += int((part >> np.uint64(BITS - 1)).sum())
    return counts


def fingerprint(text: str | None, size: int) -> int:
    """Bits set in over half the shingles' hashes, as a signed integer of 64 bits."""
    grams = shingles(text, size)
    if not grams:
        return 0
    hashes = np.fromiter((xxhash.xxh64_intdigest(g, SEED) for g in grams), np.uint64, len(grams))
    if len(grams) < 4096:
        counts = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    else:
        counts = _bit_counts(hashes)
    return int(np.packbits(counts * 2 > len(grams), bitorder="little").view(np.int64)[0])


def with_fingerprint(docs: DataFrame, out: str, text: str = "text", size: int = 4) -> DataFrame:
    """``docs`` with the SimHash of ``text`` over shingles of ``size`` words."""
    place = docs.columns.index(text)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t.as_py(), size) for t in batch.column(place)]
            columns = [*batch.columns, pa.array(prints, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, out])

    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.LongType())])
    return docs.mapInArrow(add, schema)


def flips(bits: int, most: int) -> np.ndarray:
    """All masks of up to ``most`` of the lowest ``bits`` bits."""
    masks = [sum(1 << b for b in c) for n in range(most + 1) for c in combinations(range(bits), n)]
    return np.array(masks, np.uint64)


def _meet(prints: np.ndarray, left: np.ndarray, bits: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Star links (place, place of the smallest) among prints that share a variant of the block.

    ``left`` says how many flips each has left for the lowest ``bits`` bits.
    """
    low = prints & np.uint64((1 << bits) - 1)
    values, sources = [], []
    for n in np.unique(left):
        own = np.flatnonzero(left == n)
        masks = flips(bits, int(n))
        values.append((low[own][:, None] ^ masks[None, :]).ravel())
        sources.append(np.repeat(own, len(masks)))
    value, source = np.concatenate(values), np.concatenate(sources)
    order = np.argsort(value, kind="stable")
    value, source = value[order], source[order]
    same = np.flatnonzero(value[1:] == value[:-1])
    if not len(same):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # Places of a variant met by several, and where each variant begins among them.
    many = np.zeros(len(value), bool)
    many[same] = many[same + 1] = True
    value, source = value[many], source[many]
    first = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
    run = np.cumsum(np.concatenate([[False], value[1:] != value[:-1]]))
    centre = source[first][run]
    # Two prints within half the radius of one variant are within the radius of each other.
    near = np.bitwise_count(prints[source] ^ prints[centre]) <= radius
    source, centre = source[near], centre[near]
    pairs = np.unique(np.stack([source, centre], 1)[source != centre], axis=0)
    label = np.arange(len(prints))
    while True:
        before = label.copy()
        smaller = np.minimum(label[pairs[:, 0]], label[pairs[:, 1]])
        np.minimum.at(label, pairs[:, 0], smaller)
        np.minimum.at(label, pairs[:, 1], smaller)
        label = label[label]
        if (label == before).all():
            break
    own = np.flatnonzero(label != np.arange(len(prints)))
    return own, label[own]


def _block_links(prints: np.ndarray, left: np.ndarray, bits: int, radius: int) -> Iterator[tuple]:
    """Links of one block, in smaller blocks while it has too many variants for memory."""
    variants = sum(int((left == n).sum()) * math.comb(bits, k) for n in range(radius // 2 + 1) for k in range(n + 1))
    if variants <= VARIANTS_AT_ONCE or bits <= SPLIT_BITS:
        yield tuple(prints[x] for x in _meet(prints, left, bits, radius))
        return
    rest = bits - SPLIT_BITS
    head = (prints >> np.uint64(rest)) & np.uint64((1 << SPLIT_BITS) - 1)
    for value in range(1 << SPLIT_BITS):
        after = left - np.bitwise_count(head ^ np.uint64(value)).astype(left.dtype)
        inside = after >= 0
        if inside.sum() > 1:
            yield from _block_links(prints[inside], after[inside], rest, radius)


def links(prints: DataFrame, radius: int = 4) -> DataFrame:
    """Links (a, b) that connect all fingerprints at ``radius`` bits or less.

    ``prints`` has each value once, in a bigint column ``fp``, and is read twice: pass a stored
    table. Each link joins two fingerprints of one chain of near ones.
    """
    if radius % 2 or radius < 2:
        raise ValueError("the radius must be even: two variants meet in the middle")
    half = radius // 2
    each = sum(math.comb(BITS, k) for k in range(half + 1))
    blocks = max(1.0, prints.count() * each / BLOCK_VARIANTS)
    lead = min(max(math.ceil(math.log2(blocks)), SPLIT_BITS), 30)
    rest = BITS - lead
    reach = [(int(m), int(m).bit_count()) for m in flips(lead, half)]
    masks = F.array(*[F.struct(F.lit(m).cast("bigint").alias("mask"), F.lit(half - n).alias("left")) for m, n in reach])
    dealt = prints.select("fp", F.inline(masks)).select(
        F.shiftrightunsigned("fp", rest).bitwiseXOR(F.col("mask")).alias("block"), "left", "fp"
    )

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        ends = [(np.zeros(0, np.uint64),) * 2]
        if len(rows) > 1:
            own, left = rows["fp"].to_numpy().astype(np.int64).view(np.uint64), rows["left"].to_numpy()
            ends += _block_links(own, left, rest, radius)
        a, b = (np.concatenate(x).view(np.int64) for x in zip(*ends))
        return pd.DataFrame({"a": a, "b": b}).drop_duplicates()

    return dealt.groupBy("block").applyInPandas(meet, "a bigint, b bigint").distinct()


def components(edges: DataFrame) -> DataFrame:
    """Connected components of links (a, b): (node, root), the root being the smallest node.

    Large and small stars in turn: every node's neighbours are linked to its smallest one, until
    only stars are left. Minima are aggregated before each shuffle and nothing is gathered per
    node. Each round is written to the shared folder.
    """
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    down, before = stored(down, "links"), None
    while True:
        state = down.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return down.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
        both = down.unionByName(down.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large, "links")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        down = stored(small, "links")


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 4, radius: int = 4) -> DataFrame:
    """Per row: the key, ``fingerprint`` (bigint), ``component_id`` (the class's smallest key) and
    ``keeper`` (the fingerprint of the document that bears that key)."""
    named = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    rows = stored(with_fingerprint(named, "fp", "text", size).select("key", "fp"), "fingerprints")
    prints = stored(rows.groupBy("fp").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("n")), "distinct")
    roots = components(links(prints.select("fp"), radius))
    rooted = prints.join(roots, prints["fp"] == roots["node"], "left")
    rooted = rooted.select("fp", "n", "first", F.coalesce("root", "fp").alias("root"))
    # Null keys come last here, so they name a class only if there is no other.
    rank = F.struct(F.col("first").isNull().alias("none"), F.col("first").alias("key"), F.col("fp").alias("fp"))
    best = rooted.groupBy("root").agg(F.min(rank).alias("best"), F.sum("n").alias("n"))
    known = rooted.select("fp", "n", "root").join(best.select("root", "best"), "root")
    known = known.select("fp", "n", F.col("best.key").alias("component_id"), F.col("best.fp").alias("keeper"))
    found = join_keys(rows, stored(known, "classes"), "fp", "n")
    return found.select(F.col("key").alias(key), F.col("fp").alias("fingerprint"), "component_id", "keeper")


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 4, radius: int = 4) -> DataFrame:
    """``docs`` with one document of each class: the one with the smallest key.

    Rows that repeat a kept document's key and fingerprint are dropped too.
    """
    print_name, key_name, kept_name = (free_name(docs, n) for n in ("_fp", "_key", "_keeper"))
    found = classes(docs, key, text, size, radius)
    keepers = found.filter(F.col(key).eqNullSafe(F.col("component_id")) & (F.col("fingerprint") == F.col("keeper")))
    keepers = keepers.select(F.col(key).alias(key_name), F.col("keeper").alias(kept_name)).distinct()
    marked = with_fingerprint(docs, print_name, text, size)
    chosen = F.col(key).eqNullSafe(F.col(key_name)) & (F.col(print_name) == F.col(kept_name))
    kept = marked.join(stored(keepers, "keepers"), chosen, "left_semi").dropDuplicates([key, print_name])
    return kept.drop(print_name)
