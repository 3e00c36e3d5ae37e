"""URL filter: host and path rules, and for all other URLs a character language-model ratio.

Two smoothed variable-order Markov models (orders 0 to 2, each order interpolated with the one
below) are counted from accepted and rejected URLs; the length-normalised difference of their
log-likelihoods, against a threshold calibrated out of fold, gives the verdict.

Everything is a column expression. A null URL, or one without ``://``, has an empty host and path
and fits no rule; URLs of any length are scored whole; URLs are judged one by one, so repeated rows
and ties change nothing; an empty table gives an empty table; other columns stay, but for those
called like a result, which are replaced. Without accepted or without rejected URLs the ratio is 0
everywhere and every URL without a rule is allowed.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyguard.llm.common import double_array, once

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Position 1 is the start, digits are one character, everything else is `~`.
ALPHABET = "^abcdefghijklmnopqrstuvwxyz0./-_?=&:#%~"
SIZE = len(ALPHABET)
ALLOW, BLOCK = "allow", "block"
# Parts of the labelled URLs, each scored by models of the others.
FOLDS = 5
BINS = 2000
RANGE = 10.0


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Model:
    """Log-likelihood differences (accepted less rejected) of character triples, and the threshold."""

    ratios: tuple[float, ...]
    threshold: float


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def parts(url: str = "url") -> tuple[Column, Column]:
    """Host and path: the host ends at the first ``/``, ``?``, ``#``, the path at ``?`` or ``#``."""
    place = F.instr(F.col(url), F.lit("://"))
    rest = F.when(place > 0, F.substring(F.col(url), place + 3, F.length(url)))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(ascii_lower(host), F.lit("")), F.coalesce(path, F.lit(""))


def rule_columns(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits host or parent domain and the path's start, and its verdict; else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path)
        rule = F.when(fits, F.lit(r.text)).otherwise(rule)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return rule, verdict


def codes(url: Column) -> Column:
    """The URL's characters as positions in the alphabet, behind two starts."""
    plain = F.regexp_replace(F.regexp_replace(ascii_lower(url), "[0-9]", "0"), r"[^a-z0./_?=&:#%-]", "~")
    return F.transform(F.split(F.concat(F.lit("^^"), plain), ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)


def triples(url: Column) -> Column:
    """Each character with the two before it, as one number."""
    c = codes(url)
    filled = F.filter(c, lambda x: x >= 0)
    ab = F.zip_with(filled, F.slice(filled, F.lit(2), F.size(filled)), lambda a, b: a * SIZE + b)
    abc = F.zip_with(ab, F.slice(filled, F.lit(3), F.size(filled)), lambda a, b: a * SIZE + b)
    return F.filter(abc, lambda x: x.isNotNull())


def smoothed(counts: np.ndarray) -> np.ndarray:
    """Chances of the third character given two, interpolated order by order.

    The weight of an order is its context's count over that count plus its number of distinct
    successors, so a context seen rarely hands over to the shorter one.
    """
    chance = np.full(SIZE, 1 / SIZE)
    for order in (counts.sum((0, 1)), counts.sum(0), counts):
        total, kinds = order.sum(-1, keepdims=True), (order > 0).sum(-1, keepdims=True)
        weight = np.divide(kinds, total + kinds, out=np.ones(total.shape), where=total > 0)
        chance = (1 - weight) * order / np.maximum(total, 1) + weight * chance
    return chance


def ratio(url: Column, ratios, offset: Column | int = 0) -> Column:
    """Difference of the log-likelihoods per character; 0 for an empty URL. With several models one
    behind the other, ``offset`` is the place where the model to use begins."""
    table, found = double_array(ratios), triples(url)
    terms = F.transform(found, lambda t: F.element_at(table, (t + 1 + offset).cast("int")))
    return F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + x) / F.greatest(F.size(found), F.lit(1))


def log_ratios(counts: np.ndarray) -> np.ndarray:
    """Log-likelihood differences of all triples by counts (rejected, accepted); 0 without one of them."""
    if not counts.sum(1).all():
        return np.zeros(SIZE**3)
    no, yes = (smoothed(c.reshape(SIZE, SIZE, SIZE)) for c in counts)
    return np.log(yes / no).ravel()


def train(labelled: DataFrame, url: str = "url", accepted: str = "accepted") -> Model:
    """Count both models from all labelled URLs and calibrate the threshold out of fold.

    Every URL is scored by models counted from the other folds, so all of them calibrate the
    threshold, at every size, and none by a model that has seen it. What reaches the driver is
    bounded by the alphabet (two times 39 cubed counts a fold) and by the bins of the histograms.
    """
    rows = labelled.filter(F.col(url).isNotNull() & F.col(accepted).isNotNull())
    fold = F.pmod(F.xxhash64(F.col(url)), F.lit(FOLDS)).cast("int")
    rows = rows.select(F.col(url).alias("u"), F.col(accepted).alias("a"), fold.alias("f"))
    seen = rows.select("a", "f", F.explode(triples(F.col("u"))).alias("t"))
    counts = np.zeros((FOLDS, 2, SIZE**3))
    for r in seen.groupBy("a", "f", "t").agg(F.count(F.lit(1)).alias("n")).toLocalIterator():
        counts[r["f"], int(r["a"]), r["t"]] = r["n"]
    total = counts.sum(0)
    if not total.sum(1).all():
        return Model((0.0,) * SIZE**3, 0.0)
    ratios = tuple(log_ratios(total).tolist())

    unseen = np.concatenate([log_ratios(total - own) for own in counts])
    score = F.least(F.greatest(ratio(F.col("u"), unseen, F.col("f") * SIZE**3), F.lit(-RANGE)), F.lit(RANGE))
    binned = rows.select("a", F.floor((score + RANGE) / (2 * RANGE) * BINS).cast("int").alias("b"))
    hist = np.zeros((2, BINS + 1))
    for r in binned.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).collect():
        hist[int(r["a"]), r["b"]] = r["n"]
    # Below bin b is rejected: the share of rejected URLs caught plus that of accepted ones kept.
    below = np.concatenate([[[0.0], [0.0]], np.cumsum(hist, 1)], 1) / hist.sum(1, keepdims=True)
    gain = below[0] + 1 - below[1]
    best = np.flatnonzero(gain >= gain.max() - 1e-12)
    return Model(ratios, float((best[0] + best[-1]) / 2 / BINS * 2 * RANGE - RANGE))


def judge(pages: DataFrame, rules: list[Rule], model: Model, url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule, score (null under a rule) and verdict."""
    host, path = parts(url)
    out = once(pages, host=host, path=path)
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    out = once(out, rule=rule, verdict=verdict)
    score = F.when(F.col("verdict").isNull(), ratio(F.coalesce(F.col(url), F.lit("")), model.ratios))
    out = once(out, score=score)
    scored = F.when(F.col("score") >= model.threshold, F.lit(ALLOW)).otherwise(F.lit(BLOCK))
    return out.withColumn("verdict", F.coalesce("verdict", scored))


def rule_labelled(pages: DataFrame, rules: list[Rule], url: str = "url") -> DataFrame:
    """All URLs under a rule, with its verdict as label: what the models are counted from."""
    rule, verdict = rule_columns(*parts(url), rules)
    labelled = pages.select(F.col(url).alias("url"), verdict.alias("v")).filter(F.col("v").isNotNull())
    return labelled.select("url", (F.col("v") == ALLOW).alias("accepted"))
