"""Approximate nearest neighbours by shifted space-filling curves.

Vectors are projected at random and ordered along several Hilbert curves, each over its own
projection and shift. An order is cut into key ranges of about equal size; a query looks at the
ranges within ``reach`` (a share of the order) of its own, on every curve; the finds are merged and
ranked by the inner product of the original vectors in double precision.

The reach is fitted on a bounded sample (``SAMPLE`` vectors, ``SAMPLE_QUERIES`` queries): the
smallest that finds a share ``target`` of the true neighbours there. All vectors are indexed; a
sample is sparser than the table, so it finds its neighbours harder.

Vectors that are null or zero, hold null or non-finite components or have not the table's most
frequent dimension take no part. Ties go to the smaller id; a repeated id is asked and listed once;
equal vectors, however many, are split among tasks; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyguard.llm.common import stored

CURVES, DIMENSIONS, BITS = 16, 8, 6
SAMPLE, SAMPLE_QUERIES = 4096, 256
# Rows that meet a range's queries in one task.
CHUNK = 4096
SHIFT = 0.25
# Closer sums may differ by rounding only.
ROUNDING = 1e-9


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places of integer points (below 2^bits in each dimension) on the Hilbert curve.

    Level by level from the top: the axes are reflected and swapped so that the curve enters and
    leaves each subcube at neighbouring corners; the Gray code of the corners is then undone.
    """
    x = cells.astype(np.int64).T.copy()
    dimensions = len(x)
    for level in range(bits - 1, 0, -1):
        below = (1 << level) - 1
        for axis in range(dimensions):
            upper = (x[axis] >> level) & 1 == 1
            swap = np.where(upper, 0, (x[0] ^ x[axis]) & below)
            x[0] ^= np.where(upper, below, swap)
            x[axis] ^= swap
    for axis in range(1, dimensions):
        x[axis] ^= x[axis - 1]
    parity = np.zeros(x.shape[1], np.int64)
    for level in range(bits - 1, 0, -1):
        parity ^= np.where((x[-1] >> level) & 1 == 1, (1 << level) - 1, 0)
    x ^= parity
    key = np.zeros(x.shape[1], np.int64)
    for level in range(bits - 1, -1, -1):
        for axis in range(dimensions):
            key = key << 1 | (x[axis] >> level) & 1
    return key


@dataclass(frozen=True)
class Curves:
    """Projections, scaling and shifts, and the share of an order that a query looks at on each side."""

    axes: np.ndarray
    low: np.ndarray
    width: np.ndarray
    shifts: np.ndarray
    reach: float

    def keys(self, vectors: np.ndarray) -> np.ndarray:
        """One column of keys per curve."""
        unit = (vectors @ self.axes - self.low) / self.width
        columns = []
        for curve, shift in enumerate(self.shifts):
            own = unit[:, curve * len(shift) : (curve + 1) * len(shift)] * (1 - SHIFT) + shift * SHIFT
            cells = np.clip(own * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64)
            columns.append(hilbert_keys(cells, BITS))
        return np.stack(columns, 1)


def valid_vectors(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """``id`` and ``vector`` of the rows that take part."""
    named = rows.select(F.col(key).alias("id"), F.col(vector).alias("vector"))
    wild = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("vector", lambda x: x != 0)
    whole = named.filter(F.col("id").isNotNull() & F.col("vector").isNotNull()).filter(~wild & some)
    sizes = whole.groupBy(F.size("vector").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    first = sizes.orderBy(F.desc("n"), "d").first()
    return whole.filter(F.size("vector") == (first["d"] if first else 0))


def fit(vectors: DataFrame, k: int, target: float = 0.96, seed: int = 7) -> Curves | None:
    """Curves for the vectors, and the reach that finds ``target`` of the sample's neighbours."""
    sample = vectors.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).collect()
    if not sample:
        return None
    x = np.array([r["vector"] for r in sample], np.float64)
    rng = np.random.default_rng(seed)
    size = min(DIMENSIONS, x.shape[1])
    axes = np.concatenate([np.linalg.qr(rng.normal(size=(x.shape[1], size)))[0] for _ in range(CURVES)], 1)
    low, high = (x @ axes).min(0), (x @ axes).max(0)
    shifts = rng.uniform(0, 1, (CURVES, size))
    curves = Curves(axes, low, np.maximum(high - low, 1e-12), shifts, 1.0)
    n, asked = len(x), min(SAMPLE_QUERIES, len(x))
    scores = x[:asked] @ x.T
    scores[np.arange(asked), np.arange(asked)] = -np.inf
    true = np.argsort(-scores, axis=1, kind="stable")[:, : min(k, n - 1)]
    if not true.size:
        return curves
    keys = curves.keys(x)
    nearest = np.full(true.shape, np.inf)
    for curve in range(CURVES):
        place = np.empty(n)
        place[np.argsort(keys[:, curve], kind="stable")] = np.arange(n)
        nearest = np.minimum(nearest, np.abs(place[true] - place[:asked, None]) / n)
    return Curves(axes, low, curves.width, shifts, float(np.quantile(nearest, target)))


def _ranges(keyed: DataFrame, curves: Curves) -> tuple[list[list[int]], list[tuple]]:
    """Per curve the bounds of its key ranges; per range (curve, range, chunks, first, last), the
    first and last being the ranges a query of this range looks at. At most 1024 ranges a curve."""
    number = int(min(max(2 / max(curves.reach, 1e-6), 64), 1024))
    shares = [i / number for i in range(1, number)]
    cuts = keyed.agg(
        *[F.percentile_approx(F.get("keys", c), shares, 20 * number).alias(f"c{c}") for c in range(CURVES)]
    ).first()
    bounds = [sorted(set(cut or [])) for cut in cuts]
    counted = _in_ranges(keyed.select("keys"), bounds).groupBy("curve", "range").agg(F.count(F.lit(1)).alias("n"))
    counts: dict[int, dict[int, int]] = {}
    for r in counted.collect():
        counts.setdefault(r["curve"], {})[r["range"]] = r["n"]
    table = []
    for curve, of in counts.items():
        numbers = sorted(of)
        sizes = np.array([of[r] for r in numbers])
        ends = np.cumsum(sizes)
        starts, far = ends - sizes, curves.reach * ends[-1]
        first = np.searchsorted(ends, starts - far, "right")
        last = np.searchsorted(starts, ends + far, "left") - 1
        for i, r in enumerate(numbers):
            table.append((curve, r, int(-(-sizes[i] // CHUNK)), numbers[first[i]], numbers[last[i]]))
    return bounds, table


def _in_ranges(keyed: DataFrame, bounds: list[list[int]]) -> DataFrame:
    """One row per vector and curve, with the curve and the key range."""
    kept = [c for c in keyed.columns if c != "keys"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            keys = np.array(batch.column("keys").to_pylist(), np.int64).reshape(n, CURVES)
            for curve in range(CURVES):
                found = np.searchsorted(np.array(bounds[curve], np.int64), keys[:, curve], "right")
                columns = [batch.column(c) for c in kept]
                columns += [pa.array(np.full(n, curve, np.int32)), pa.array(found.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, "curve", "range"])

    numbers = [T.StructField(n, T.IntegerType()) for n in ("curve", "range")]
    return keyed.mapInArrow(place, T.StructType([*[keyed.schema[c] for c in kept], *numbers]))


def _with_keys(vectors: DataFrame, curves: Curves) -> DataFrame:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column("vector").to_pylist(), np.float64).reshape(batch.num_rows, -1)
            keys = curves.keys(x) if batch.num_rows else np.zeros((0, CURVES), np.int64)
            columns = [*batch.columns, pa.array(list(keys), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "keys"])

    return vectors.mapInArrow(add, T.StructType([*vectors.schema.fields, T.StructField("keys", T.ArrayType(T.LongType()))]))


def best_of(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, row_ids: np.ndarray, k: int) -> pd.DataFrame:
    """The k nearest rows of each query, by inner product, ties to the smaller id."""
    scores = queries @ rows.T
    scores[query_ids[:, None] == row_ids[None, :]] = -np.inf
    floor = np.full(len(queries), -np.inf)
    if len(rows) > k:
        floor = np.partition(scores, -k, axis=1)[:, -k] - ROUNDING * (1 + np.abs(scores).max(where=np.isfinite(scores), initial=0))
    q, r = np.nonzero((scores >= floor[:, None]) & (scores > -np.inf))
    exact = np.concatenate([np.zeros(0), *[(queries[q[i : i + CHUNK]] * rows[r[i : i + CHUNK]]).sum(1) for i in range(0, len(q), CHUNK)]])
    found = pd.DataFrame({"query_id": query_ids[q], "vec_id": row_ids[r], "score": exact})
    found = found.drop_duplicates(["query_id", "vec_id"]).sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True])
    return found.groupby("query_id", sort=False).head(k)


def nearest(rows: DataFrame, is_query, k: int = 20, key: str = "vec_id", vector: str = "embedding", **options) -> DataFrame:
    """Per query (a row for which ``is_query(id column)`` holds) its k nearest rows found.

    Columns: query_id, rank (from 1), vec_id, score.
    """
    empty = "query_id bigint, rank int, vec_id bigint, score double"
    vectors = valid_vectors(rows, key, vector)
    curves = fit(vectors, k, **options)
    if curves is None:
        return rows.sparkSession.createDataFrame([], empty)
    keyed = stored(_with_keys(vectors.withColumn("id", F.col("id").cast("bigint")), curves), "keys")
    bounds, table = _ranges(keyed, curves)
    # At most 16 times 1024 rows.
    ranges = F.broadcast(
        rows.sparkSession.createDataFrame(table, "curve int, range int, chunks int, first int, last int")
    )
    placed = _in_ranges(keyed, bounds)
    chunk = F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int")
    side = placed.join(ranges.select("curve", "range", "chunks"), ["curve", "range"])
    side = side.select("curve", "range", chunk.alias("chunk"), "id", "vector")
    asked = _in_ranges(keyed.filter(is_query(F.col("id"))).dropDuplicates(["id"]), bounds)
    window = asked.join(ranges.select("curve", "range", "first", "last"), ["curve", "range"])
    window = window.select("curve", "id", "vector", F.explode(F.sequence("first", "last")).alias("range"))
    window = window.join(ranges.select("curve", "range", "chunks"), ["curve", "range"])
    every = F.sequence(F.lit(0), F.col("chunks") - 1)
    window = window.select("curve", "range", F.explode(every).alias("chunk"), "id", "vector")

    def rank(data: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(data) or not len(queries):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        x, ids = np.stack(data["vector"]).astype(np.float64), data["id"].to_numpy()
        parts = [queries.iloc[i : i + 512] for i in range(0, len(queries), 512)]
        found = [best_of(np.stack(p["vector"]).astype(np.float64), p["id"].to_numpy(), x, ids, k) for p in parts]
        return pd.concat(found)

    group = ["curve", "range", "chunk"]
    found = side.groupBy(*group).cogroup(window.groupBy(*group)).applyInPandas(
        rank, "query_id bigint, vec_id bigint, score double"
    )
    merged = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = merged.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
