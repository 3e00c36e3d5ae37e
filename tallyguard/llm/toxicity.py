"""Toxicity: cumulative-link ordinal regression on sparse text features gives an expected severity.

Features are all words that separate toxic from clean labelled documents; a feature's value grows with
the logarithm of its count. One weight vector is shared by ordered thresholds: the chance of grade
g or less is the logistic function of threshold g less the weighted sum. Grades: 0 is clean, 1 to 3
are toxic documents by how dense the telling words are. The expected severity is the sum of the
chances to exceed each threshold; the severity from which a document is toxic is calibrated on
the labelled documents that the fit has not seen, or on all labelled ones where those are too few,
and always lies above the severity of a text without features.

The model is fitted on at most ``MAX_LABELLED`` labelled documents of each class, chosen by a hash
of their ids and weighted by the true sizes of the classes; the cut counts all labelled documents
left; every document is scored, over its whole text. Null text counts as empty; repeated
rows get the same score; null or doubled labels count as absent, or as toxic if one of them is;
without documents of both classes nothing is toxic; an empty table gives an empty table; columns
called like a result are replaced.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_LABELLED = 20_000
# A feature occurs in this many labelled documents at least, multiplies the odds by this much, and
# less than so many features would look as telling by chance.
MIN_DOCUMENTS, MIN_ODDS, BY_CHANCE = 3, 3.0, 0.05
GRADES = 3
HELD_OUT = 5
# The cut is calibrated on unseen documents if there are so many of each class; scores are counted
# in so many steps per grade.
MIN_JUDGED, STEPS = 30, 4096
WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Model:
    """Weights of the features, ordered thresholds, and the severity from which a text is toxic."""

    weights: dict[str, float] = field(default_factory=dict)
    thresholds: tuple[float, ...] = (math.inf,) * GRADES
    cut: float = math.inf


def counted(text: str | None, vocabulary) -> Counter:
    return Counter(w for w in WORD.findall((text or "").lower()) if w in vocabulary)


def value(count: int) -> float:
    return 1 + math.log(count)


def severity(text: str | None, model: Model) -> tuple[float, int]:
    """Expected severity and most likely grade."""
    total = sum(model.weights[w] * value(n) for w, n in counted(text, model.weights).items())
    above = [1 / (1 + math.exp(min(t - total, 700))) for t in model.thresholds]
    edges = [1.0, *above, 0.0]
    chances = [edges[g] - edges[g + 1] for g in range(len(edges) - 1)]
    return sum(above), max(range(len(chances)), key=chances.__getitem__)


def labelled_ids(labels: DataFrame) -> DataFrame:
    """One row per labelled id: _id, toxic."""
    known = labels.select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.filter(F.col("_id").isNotNull() & F.col("toxic").isNotNull())
    return known.groupBy("_id").agg(F.max("toxic").alias("toxic")).filter(F.col("toxic").isin(0, 1))


def chosen_ids(known: DataFrame, most: int) -> DataFrame:
    """Up to ``most`` toxic and ``most`` clean ids: _id, toxic, held."""
    chance = F.xxhash64("_id")
    chosen = None
    for label in (0, 1):
        mine = known.filter(F.col("toxic") == label).orderBy(chance, "_id").limit(most)
        chosen = mine if chosen is None else chosen.unionByName(mine)
    return chosen.select("_id", "toxic", (F.pmod(chance, F.lit(HELD_OUT)) == 0).alias("held"))


def _by_class(rows: DataFrame) -> dict[int, int]:
    return {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}


def _features(sample: DataFrame, totals: dict[int, int], weight: dict[int, float]) -> dict[str, float]:
    """Telling words with the logarithm of their odds of standing in a toxic document.

    ``totals`` are the documents of each class in the whole table, ``weight`` what one of the sample
    stands for.
    """

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter = Counter()
            for text, toxic in zip(batch.column("_text").to_pylist(), batch.column("toxic").to_pylist()):
                found.update((w, toxic) for w in set(WORD.findall((text or "").lower())))
            rows = [(w, t, n) for (w, t), n in found.items()]
            yield pa.RecordBatch.from_pylist(
                [{"w": w, "toxic": t, "n": n} for w, t, n in rows],
                pa.schema([("w", pa.string()), ("toxic", pa.int32()), ("n", pa.int64())]),
            )

    yes, no = (totals[c] / weight[c] for c in (1, 0))
    counts = sample.filter(~F.col("held")).mapInArrow(words, "w string, toxic int, n bigint")
    sums = counts.groupBy("w").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("a"),
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("b"),
    )
    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    sums = sums.filter(a + b >= MIN_DOCUMENTS)
    tests, base = sums.count(), totals[1] / (totals[1] + totals[0])
    odds = F.log(((a + 0.5) * no) / ((b + 0.5) * yes))
    # Log-likelihood ratio of the word's own share of toxic documents against that of all.
    a, b = a * weight[1], b * weight[0]
    ratio = F.when(a > 0, a * F.log(a / (a + b) / base)).otherwise(0.0)
    ratio = ratio + F.when(b > 0, b * F.log(b / (a + b) / (1 - base))).otherwise(0.0)
    scored = sums.select("w", odds.alias("odds"), ratio.alias("x"))
    strong = (F.abs("odds") >= math.log(MIN_ODDS)) & (F.col("x") >= math.log(max(tests, 1) / BY_CHANCE))
    # Bounded by the sample's words.
    return {r["w"]: r["odds"] for r in scored.filter(strong).select("w", "odds").collect()}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def fit_ordinal(
    rows: np.ndarray, columns: np.ndarray, values: np.ndarray, grades: np.ndarray, features: int,
    penalty: float = 1e-3, steps: int = 400, rate: float = 0.1, share: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and increasing thresholds by gradient steps on the mean log-likelihood.

    ``share`` is what each row counts in that mean, by default the same.
    The features are given as (row, column, value) triples. Thresholds are a first one and
    increments kept positive by the exponential function.
    """
    n, top = len(grades), int(GRADES)
    share = np.full(n, 1 / n) if share is None else share / share.sum()
    weights, raw = np.zeros(features), np.concatenate([[1.0], np.zeros(top - 1)])
    state = [np.zeros(features + top), np.zeros(features + top)]
    for step in range(1, steps + 1):
        thresholds = np.cumsum(np.concatenate([raw[:1], np.exp(raw[1:])]))
        total = np.bincount(rows, weights[columns] * values, n)
        # Chances of being at most each grade, with 0 below and 1 above all.
        inner = _sigmoid(thresholds[None, :] - total[:, None])
        at_most = np.concatenate([np.zeros((n, 1)), inner, np.ones((n, 1))], 1)
        slope = at_most * (1 - at_most)
        chance = np.maximum(at_most[np.arange(n), grades + 1] - at_most[np.arange(n), grades], 1e-12)
        upper, lower = slope[np.arange(n), grades + 1] / chance, slope[np.arange(n), grades] / chance
        by_total = (lower - upper) * share
        by_weight = np.bincount(columns, -by_total[rows] * values, features) * -1 - penalty * weights
        by_threshold = np.zeros(top)
        np.add.at(by_threshold, grades[grades < top], (upper * share)[grades < top])
        np.add.at(by_threshold, grades[grades > 0] - 1, -(lower * share)[grades > 0])
        tails = np.cumsum(by_threshold[::-1])[::-1]
        by_raw = np.concatenate([tails[:1], tails[1:] * np.exp(raw[1:])])
        gradient = np.concatenate([by_weight, by_raw])
        state[0] = 0.9 * state[0] + 0.1 * gradient
        state[1] = 0.999 * state[1] + 0.001 * gradient**2
        move = rate * (state[0] / (1 - 0.9**step)) / (np.sqrt(state[1] / (1 - 0.999**step)) + 1e-8)
        weights, raw = weights + move[:features], raw + move[features:]
    return weights, np.cumsum(np.concatenate([raw[:1], np.exp(raw[1:])]))


def train(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", most: int = MAX_LABELLED
) -> Model:
    """Fit the model on a bounded sample of labelled documents, and its cut on all others.

    What reaches the driver are the telling words and, per sampled document, their counts in it;
    of the others, how many have which severity.
    """
    known = labelled_ids(labels)
    chosen = chosen_ids(known, most)
    every = docs.select(F.col(key).alias("_id"), F.col(text).alias("_text"))
    # At most twice `most` rows of ids and labels.
    sample = every.join(F.broadcast(chosen), "_id")
    totals, drawn = _by_class(every.join(known, "_id")), _by_class(sample)
    if not all(counts.get(c) for counts in (totals, drawn) for c in (0, 1)):
        return Model()
    each = sum(drawn.values()) / sum(totals.values())
    # One on average over the sample.
    weight = {c: totals[c] / drawn[c] * each for c in (0, 1)}
    odds = _features(sample, totals, weight)
    if not odds:
        return Model()
    names = sorted(odds)
    number = {w: i for i, w in enumerate(names)}

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text, toxic, held in zip(*[batch.column(c).to_pylist() for c in ("_text", "toxic", "held")]):
                every = WORD.findall((text or "").lower())
                own = Counter(number[w] for w in every if w in number)
                found.append({"toxic": toxic, "held": held, "words": len(every), "at": list(own), "n": list(own.values())})
            yield pa.RecordBatch.from_pylist(found, pa.schema([
                ("toxic", pa.int32()), ("held", pa.bool_()), ("words", pa.int64()),
                ("at", pa.list_(pa.int32())), ("n", pa.list_(pa.int32())),
            ]))

    seen = sample.mapInArrow(vectors, "toxic int, held boolean, words bigint, at array<int>, n array<int>").collect()
    # Density of telling words, in a fixed order of documents, so that any partitioning gives one model.
    seen.sort(key=lambda r: (r["toxic"], r["words"], r["at"], r["n"]))
    positive = [odds[w] > 0 for w in names]
    dense = [sum(n for i, n in zip(r["at"], r["n"]) if positive[i]) / max(r["words"], 1) for r in seen]
    toxic = sorted(d for r, d in zip(seen, dense) if r["toxic"] and not r["held"])
    if not toxic:
        return Model()
    steps = [toxic[len(toxic) * g // GRADES] for g in range(1, GRADES)]
    grades = np.array([1 + sum(d >= s for s in steps) if r["toxic"] else 0 for r, d in zip(seen, dense)])
    kept = [i for i, r in enumerate(seen) if not r["held"]]
    triples = [(row, j, value(n)) for row, i in enumerate(kept) for j, n in zip(seen[i]["at"], seen[i]["n"])]
    table = np.array(triples, np.float64).reshape(-1, 3)
    share = np.array([weight[seen[i]["toxic"]] for i in kept])
    weights, thresholds = fit_ordinal(
        table[:, 0].astype(int), table[:, 1].astype(int), table[:, 2], grades[kept], len(names), share=share
    )
    model = Model(dict(zip(names, map(float, weights))), tuple(map(float, thresholds)))
    return replace(model, cut=calibrated(judged(every, known, chosen, model), severity("", model)[0]))


def judged(every: DataFrame, known: DataFrame, chosen: DataFrame, model: Model) -> list:
    """The severities of all labelled documents, counted: rows of fitted (whether the fit saw them),
    toxic, low and high (of the severities in a step), n."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [severity(t.as_py(), model)[0] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], names=["_id", "_s"])

    scored = every.filter(F.col("_id").isNotNull())
    # The texts stay where they are; only ids and severities are joined with the labels.
    types = T.StructType([every.schema["_id"], T.StructField("_s", T.DoubleType())])
    scored = scored.mapInArrow(add, types).join(known, "_id")
    fitted = chosen.filter(~F.col("held")).select("_id", F.lit(True).alias("fitted"))
    scored = scored.join(F.broadcast(fitted), "_id", "left").fillna(False, ["fitted"])
    # At most `STEPS` rows per grade, class and side; the texts without features have one of their own.
    base = F.lit(severity("", model)[0])
    step = F.when(F.col("_s") > base, F.floor(F.col("_s") * STEPS)).otherwise(-1)
    counted = scored.groupBy("fitted", "toxic", step.alias("step")).agg(
        F.min("_s").alias("low"), F.max("_s").alias("high"), F.count(F.lit(1)).alias("n")
    )
    return counted.select("fitted", "toxic", "low", "high", "n").collect()


def calibrated(found: list, base: float) -> float:
    """The cut by the documents that the fit has not seen, or by all if those are too few or tell nothing."""
    for rows in ([r for r in found if not r["fitted"]], found):
        own = [sum(r["n"] for r in rows if r["toxic"] == c) for c in (0, 1)]
        if rows is not found and min(own) < MIN_JUDGED:
            continue
        # A document counts so that the classes have their true shares.
        worth = [sum(r["n"] for r in found if r["toxic"] == c) / own[c] for c in (0, 1)]
        cut = best_cut([(r["low"], r["high"], r["n"] * worth[r["toxic"]], r["toxic"] == 1) for r in rows], base)
        if cut < math.inf:
            break
    return cut


def best_cut(counts: list[tuple[float, float, float, bool]], base: float) -> float:
    """The severity above ``base`` with the best F measure, between neighbouring ones.

    ``counts`` has (lowest, highest severity, number, toxic) of documents alike. Without toxic
    documents above ``base`` the cut is infinite.
    """
    total = sum(n for *_, n, toxic in counts if toxic)
    ranked = sorted((c for c in counts if c[1] > base), reverse=True)
    # The highest severity behind each place.
    behind = list(accumulate(reversed([c[1] for c in ranked[1:]]), max, initial=base))[::-1]
    best, cut, hits, taken = 0.0, math.inf, 0.0, 0.0
    for (low, _, n, toxic), below in zip(ranked, behind):
        hits, taken = hits + n * toxic, taken + n
        # Steps of the two classes overlap; only places between severities count.
        if below < low and 2 * hits / (taken + total) > best:
            best, middle = 2 * hits / (taken + total), (low + below) / 2
            cut = middle if middle > below else low
    return float(cut)


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with severity (expected, 0 to 3), grade (the most likely) and toxic."""
    names = ["severity", "grade", "toxic"]
    docs = docs.drop(*names)
    place = docs.columns.index(text)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [severity(t.as_py(), model) for t in batch.column(place)]
            numbers = [s for s, _ in found]
            columns = [pa.array(numbers, pa.float64()), pa.array([g for _, g in found], pa.int32())]
            columns.append(pa.array([s >= model.cut for s in numbers], pa.bool_()))
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *names])

    types = [T.DoubleType(), T.IntegerType(), T.BooleanType()]
    added = [T.StructField(n, t) for n, t in zip(names, types)]
    return docs.mapInArrow(add, T.StructType([*docs.schema.fields, *added]))


def without_toxic(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` less those whose severity reaches the model's cut, columns unchanged."""
    place = docs.columns.index(text)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean = [severity(t.as_py(), model)[0] < model.cut for t in batch.column(place)]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
