"""Ranked lexical search: posting lists in geometric blocks, skipped by exact bounds.

Documents are read once: each gives its length and its counts of the items' terms. The tables
that follow (`Postings`) hold one shard of documents each. In a shard, documents are ordered by
the signs of random projections of their score vectors, so that similar ones are neighbours; each
term's posting list is cut in that order into blocks, and a block keeps, for every term, the
greatest score part that any of its documents has. An item's best sum against such a summary
bounds all documents of the block, so a block is skipped only where the bound is below the item's
20th score so far; all others are scored whole. Lists whose greatest parts cannot reach that score
together are not opened. Scores are integers, so the bounds are exact and no result is lost.

A shard is a bounded number of documents of one partition, thresholds pass on from shard to shard,
each partition returns its best documents per item, and the best of those are the result. A
frequent term's list is thus spread over all partitions.

Items are taken in groups of at most `VOCABULARY` distinct terms (or one item, if it has more),
each with its own pass over the documents, so what is sent to the tasks is bounded.

Null text has no term; texts of any length are read whole, in slices; repeated documents are
ranked each by itself, null ids last among equal scores; repeated items have results each; an item
without terms, or without documents, has no rows; an empty table gives an empty result; other
columns are left out.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallyguard.llm.common import stored

TOP = 20
VOCABULARY = 1 << 16
ITEMS = 4096
SHARD, BLOCK = 1 << 14, 64
# Signs kept of a document's vector; numbers of summary entries kept of opened lists.
SIGNS, SEED, OPENED = 24, 13, 1 << 22
SLICE = 1 << 20
SCALE = 1_000_000_000
# ASCII letters in lower case, digits and bytes of other characters stay; the rest separates.
BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)
)


def terms(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text, slice by slice."""
    plain = (text or "").encode("utf-8", "surrogatepass").translate(BYTES)
    at = 0
    while at < len(plain):
        stop = at + SLICE
        if stop < len(plain):
            stop = plain.find(b" ", stop)
            stop = len(plain) if stop < 0 else stop
        yield plain[at:stop].split()
        at = stop


def item_counts(text: str | None) -> Counter:
    found = Counter()
    for part in terms(text):
        found.update(part)
    return found


def vectors(docs: DataFrame, key: str, text: str, numbers: dict[bytes, int]) -> DataFrame:
    """Per document with a term: key, length ``n``, the numbers of the known terms and their counts."""
    known = docs.sparkSession.sparkContext.broadcast(numbers)
    schema = T.StructType(
        [T.StructField("key", docs.schema[key].dataType), *T.StructType.fromDDL("n bigint, term array<int>, tf array<bigint>").fields]
    )
    target = to_arrow_schema(schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = known.value.get
        for batch in batches:
            rows = []
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                n, found = 0, Counter()
                for words in terms(value.as_py()):
                    n += len(words)
                    found.update(map(get, words))
                found.pop(None, None)
                if n:
                    rows.append((name, n, list(found.keys()), list(found.values())))
            columns = zip(*rows) if rows else ([],) * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, target)], schema=target)

    return docs.select(F.col(key), F.col(text)).mapInArrow(count, schema)


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def length_factor(n: int, documents: int, total: int) -> int:
    return 75 + (25 * n * documents) // total


class Best:
    """An item's best documents so far, best first: score, whether the key is null, key."""

    def __init__(self, top: int):
        self.top = top
        self.rows: tuple[np.ndarray, ...] = (np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64))

    def least(self) -> int:
        """The score that a document must reach."""
        return max(1, int(self.rows[0][-1])) if len(self.rows[0]) == self.top else 1

    def add(self, scores: np.ndarray, none: np.ndarray, keys: np.ndarray) -> None:
        fit = scores >= self.least()
        if fit.any():
            merged = [np.concatenate([old, new[fit]]) for old, new in zip(self.rows, (scores, none, keys))]
            order = np.lexsort((merged[2], merged[1], -merged[0]))[: self.top]
            self.rows = tuple(m[order] for m in merged)


class Postings:
    """A shard's documents as sparse vectors of score parts, and its posting lists in blocks."""

    def __init__(self, keys, none, sizes, term, part, vocabulary: int, projections: np.ndarray):
        # Similar documents become neighbours: sorted by the signs of projections, the first sign first.
        starts = np.concatenate([[0], np.cumsum(sizes)])
        sums = np.zeros((len(sizes), SIGNS))
        owner = np.repeat(np.arange(len(sizes)), sizes)
        for s in range(SIGNS):
            sums[:, s] = np.bincount(owner, projections[s, term] * part, len(sizes))
        signs = ((sums > 0) << np.arange(SIGNS - 1, -1, -1)).sum(1)
        order = np.argsort(signs, kind="stable")
        self.keys, self.none, self.sizes = keys[order], none[order], sizes[order]
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        taken = self._places(starts[order], self.sizes)
        self.term, self.part, self.vocabulary = term[taken], part[taken], vocabulary
        owner = np.repeat(np.arange(len(sizes)), self.sizes)
        by_term = np.argsort(self.term, kind="stable")
        self.holders = owner[by_term]
        self.list_starts = np.searchsorted(self.term[by_term], np.arange(vocabulary + 1))
        self.greatest = np.zeros(vocabulary, np.int64)
        np.maximum.at(self.greatest, self.term, self.part)
        self.opened: dict[int, tuple] = {}
        self.entries = 0

    @staticmethod
    def _places(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The places of all entries of some documents, one after the other."""
        shift = starts - np.concatenate([[0], np.cumsum(sizes)[:-1]])
        return np.arange(int(sizes.sum())) + np.repeat(shift, sizes)

    def blocks(self, term: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A term's list, and the summaries of its blocks as sorted (block, term) codes with maxima."""
        if term not in self.opened:
            if self.entries > OPENED:
                self.opened, self.entries = {}, 0
            docs = self.holders[self.list_starts[term] : self.list_starts[term + 1]]
            places = self._places(self.starts[docs], self.sizes[docs])
            block = np.repeat(np.arange(len(docs)) // BLOCK, self.sizes[docs])
            code = block * self.vocabulary + self.term[places]
            order = np.argsort(code, kind="stable")
            code = code[order]
            first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
            self.opened[term] = docs, code[first], np.maximum.reduceat(self.part[places[order]], first)
            self.entries += len(first)
        return self.opened[term]

    def bounds(self, term: int, asked: np.ndarray, times: np.ndarray) -> np.ndarray:
        """The best sum of an item against each block's summary."""
        docs, code, most = self.blocks(term)
        wanted = np.arange(-(-len(docs) // BLOCK))[:, None] * self.vocabulary + asked[None, :]
        place = np.minimum(np.searchsorted(code, wanted), len(code) - 1)
        return (np.where(code[place] == wanted, most[place], 0) * times[None, :]).sum(1)

    def scores(self, docs: np.ndarray, counts: np.ndarray) -> np.ndarray:
        places = self._places(self.starts[docs], self.sizes[docs])
        parts = self.part[places] * counts[self.term[places]]
        # Every document here has an entry.
        return np.add.reduceat(parts, np.concatenate([[0], np.cumsum(self.sizes[docs])[:-1]]))

    def search(self, asked: np.ndarray, times: np.ndarray, best: Best) -> int:
        """Offer an item all documents that may be among its best; how many were scored."""
        most = self.greatest[asked] * times
        order = np.argsort(most, kind="stable")
        reach = np.cumsum(most[order])
        counts = np.zeros(self.vocabulary, np.int64)
        counts[asked] = times
        seen = np.zeros(len(self.keys), bool)
        # From the list with the greatest parts down, as long as the lists left could do together.
        for i in order[::-1]:
            if reach[np.flatnonzero(order == i)[0]] < best.least():
                break
            if most[i] == 0:
                continue
            bound = self.bounds(asked[i], asked, times)
            docs = self.blocks(asked[i])[0]
            ranked, at, step = np.argsort(-bound, kind="stable"), 0, 1
            while at < len(ranked) and bound[ranked[at]] >= best.least():
                some = ranked[at : at + step]
                some = some[bound[some] >= best.least()]
                found = (some[:, None] * BLOCK + np.arange(BLOCK)[None, :]).ravel()
                found = docs[found[found < len(docs)]]
                found = found[~seen[found]]
                if len(found):
                    seen[found] = True
                    best.add(self.scores(found, counts), self.none[found], self.keys[found])
                at, step = at + step, step * 2
        return int(seen.sum())


def _best_rows(
    rows: DataFrame, asked: list[tuple[int, np.ndarray, np.ndarray]], weights: np.ndarray, documents: int,
    total: int, top: int, shard: int,
) -> DataFrame:
    """Per partition of vectors: the best documents of each item."""
    sent = rows.sparkSession.sparkContext.broadcast((asked, weights))
    key_type = rows.schema["key"].dataType
    schema = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("key", key_type), T.StructField("score", T.LongType())])
    target = to_arrow_schema(schema)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, weights = sent.value
        vocabulary = len(weights)
        projections = np.random.default_rng(SEED).choice([-1.0, 1.0], (SIGNS, vocabulary))
        best = {item: Best(top) for item, *_ in asked}

        def run(parts: list[pa.RecordBatch]) -> None:
            whole = pa.Table.from_batches(parts).combine_chunks()
            names = whole.column("key").combine_chunks()
            none = names.is_null().to_numpy(zero_copy_only=False)
            keys = names.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            lists = whole.column("term").combine_chunks()
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            term = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            tf = whole.column("tf").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            m = np.array([length_factor(n, documents, total) for n in whole.column("n").to_pylist()], np.int64)
            part = weights[term] * ((SCALE * tf) // (1000 * tf + 12 * np.repeat(m, sizes)))
            postings = Postings(keys, none, sizes, term, part, vocabulary, projections)
            for item, of, times in asked:
                postings.search(of, times, best[item])

        waiting, count = [], 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                piece = batch.slice(at, shard - count)
                waiting.append(piece)
                at, count = at + piece.num_rows, count + piece.num_rows
                if count >= shard:
                    run(waiting)
                    waiting, count = [], 0
        if waiting:
            run(waiting)
        for item, found in best.items():
            scores, none, keys = found.rows
            if len(scores):
                columns = [pa.array([item] * len(scores), pa.int32()), pa.array(keys, target.field("key").type, mask=none)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(scores)], schema=target)

    return rows.mapInArrow(search, schema)


def _groups(items: DataFrame, item: str, text: str) -> Iterator[list[tuple]]:
    """Items with their terms' counts, in groups of bounded vocabulary."""
    group, known = [], set()
    for row in items.select(F.col(item), F.col(text)).toLocalIterator():
        counts = item_counts(row[1])
        if group and (len(known | counts.keys()) > VOCABULARY or len(group) >= ITEMS):
            yield group
            group, known = [], set()
        known |= counts.keys()
        group.append((row[0], counts))
    if group:
        yield group


def ranked(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
    item_text: str = "text", top: int = TOP, shard: int = SHARD,
) -> DataFrame:
    """Per item its ``top`` best documents: item, ``rank`` from 1, key (an integer column) and ``score``."""
    spark, result = docs.sparkSession, None
    key_type, item_type = docs.schema[key].dataType, items.schema[item].dataType
    for group in _groups(items, item, item_text):
        vocabulary = sorted(set().union(*[counts for _, counts in group]))
        numbers = {w: i for i, w in enumerate(vocabulary)}
        rows = stored(vectors(docs, key, text, numbers), "ranked")
        documents, total = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        holding = np.zeros(len(vocabulary), np.int64)
        # At most as many rows as the group has terms.
        for r in rows.select(F.explode("term").alias("term")).groupBy("term").count().collect():
            holding[r["term"]] = r["count"]
        weights = np.array([weight(documents, int(h)) for h in holding], np.int64)
        asked = []
        for place, (_, counts) in enumerate(group):
            of = np.array([numbers[w] for w in counts], np.int64)
            asked.append((place, of, np.array(list(counts.values()), np.int64)))
        some = rows.filter(F.size("term") > 0)
        best = _best_rows(some, [a for a in asked if len(a[1])], weights, documents, total, top, shard)
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("key").asc_nulls_last())
        best = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
        names = [(place, name) for place, (name, _) in enumerate(group)]
        named = spark.createDataFrame(
            names, T.StructType([T.StructField("place", T.IntegerType()), T.StructField("name", item_type)])
        )
        out = best.join(F.broadcast(named), F.col("item") == F.col("place")).select(
            F.col("name").alias(item), "rank", F.col("key").alias(key), "score"
        )
        result = out if result is None else result.unionByName(out)
    if result is None:
        fields = [(item, item_type), ("rank", T.IntegerType()), (key, key_type), ("score", T.LongType())]
        return spark.createDataFrame([], T.StructType([T.StructField(n, t) for n, t in fields]))
    return result
