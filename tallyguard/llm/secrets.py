"""Secrets: patterns, and character Markov models of random strings and of ordinary identifiers.

Two first-order character models are counted from labelled strings. A run of token characters
whose log-likelihood ratio per character speaks for the random model is a secret, besides the
matches of the base patterns, which always stay.

Everything is a column expression. Null text counts as empty and has no span; texts are scanned
whole; rows are judged one by one, so repeated rows and ties change nothing; an empty table, or
labelled strings of one class only, leave that class with its prior; other columns stay.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyguard.llm import spans
from tallyguard.llm.common import double_array, free_name, once, running_greatest, whole_text

BASE_KINDS = ["assign", "access", "hex"]
KEY = "(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
VALUE = "[A-Za-z0-9+/_.=-]"
PATTERNS = {
    "assign": rf"""{KEY}["']?\x20*[:=]\x20*["']?{VALUE}+""",
    "access": "AKIA[A-Z0-9]{16,}",
    "hex": "[0-9a-f]{24,}",
    "random": r"(?:(?<![A-Za-z0-9+/_=-])|\G)[A-Za-z0-9+/_=-]{20,}",
}
ASSIGNED = rf"""^{KEY}["']?\x20*[:=]\x20*["']?({VALUE}+)$"""
WORD = "[A-Za-z][A-Za-z0-9_]{5,}"
# The models' alphabet; position 1 is the start of a string.
ALPHABET = "^abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_.=-"
SIZE = len(ALPHABET)
# Share of the uniform distribution in the random model, and the weight of the smoothing counts.
UNIFORM, PSEUDO = 0.5, 0.5
# Beyond any place in a text.
FARTHEST = 1 << 40


@dataclass(frozen=True)
class Model:
    """Log-likelihood ratios of character pairs, and the ratio per character from which a string is random."""

    ratios: tuple[float, ...]
    threshold: float


def assigned_value(match: Column) -> Column:
    return F.regexp_extract(match, ASSIGNED, 1)


def train(strings: DataFrame) -> Model:
    """Count both models from ``strings`` (value string, secret boolean).

    Counting runs over all strings; what reaches the driver is a count per class and pair of
    characters of the alphabet, two times 69 squared at most.
    """
    # Split, since taking the n-th character of a long string walks to it.
    begun = strings.select("secret", F.split(F.concat(F.lit("^"), "value"), "").alias("chars"))
    following = F.slice("chars", F.lit(2), F.size("chars") - 1)
    pairs = begun.filter(F.size("chars") > 1).select(
        "secret", F.explode(F.zip_with("chars", following, lambda a, b: F.concat(a, b))).alias("pair")
    )
    pairs = pairs.filter(F.col("pair").isNotNull())
    # Pairs outside the alphabet are dropped after counting: there are few distinct ones.
    counts = pairs.groupBy("secret", "pair").agg(F.count(F.lit(1)).alias("n"))
    inside = counts.filter(F.col("pair").rlike(r"^[\^A-Za-z0-9+/_.=-][A-Za-z0-9+/_.=-]$"))
    return model_of([tuple(r) for r in inside.collect()])


def model_of(counts: list[tuple[bool, str, int]]) -> Model:
    table = {flag: [[0.0] * SIZE for _ in ALPHABET] for flag in (True, False)}
    for secret, pair, n in counts:
        table[secret][ALPHABET.index(pair[0])][ALPHABET.index(pair[1])] += n
    flat = 1 / (SIZE - 1)

    def chance(row: list[float], to: int) -> float:
        return (row[to] + PSEUDO) / (sum(row) + PSEUDO * (SIZE - 1))

    ratios, mean = [], {}
    for a in range(SIZE):
        secret, plain = table[True][a], table[False][a]
        ratios += [
            math.log(UNIFORM * flat + (1 - UNIFORM) * chance(secret, b)) - math.log(chance(plain, b))
            for b in range(SIZE)
        ]
    for flag in (True, False):
        total = sum(map(sum, table[flag]))
        cells = [x for row in table[flag] for x in row]
        mean[flag] = sum(n * r for n, r in zip(cells, ratios)) / total if total else None
    sides = [x for x in mean.values() if x is not None]
    # Midway between the classes, and never where the ratio speaks for ordinary text.
    return Model(tuple(ratios), max(sum(sides) / 2, 0.0) if len(sides) == 2 else 1.0)


def ratio(value: Column, model: Model) -> Column:
    """Log-likelihood ratio of a string per character."""
    # Split, since taking the n-th character of a long string walks to it.
    codes = F.transform(F.split(F.concat(F.lit("^"), value), ""), lambda c: F.instr(F.lit(ALPHABET), c))
    codes = F.filter(codes, lambda c: c > 0)
    table = double_array(model.ratios)
    pairs = F.zip_with(codes, F.slice(codes, F.lit(2), F.size(codes)), lambda a, b: (a - 1) * SIZE + b)
    terms = F.transform(F.filter(pairs, lambda p: p.isNotNull()), lambda p: F.element_at(table, p))
    total = F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + x)
    return total / F.greatest(F.size(codes) - 1, F.lit(1))


def kinds(model: Model | None) -> list[spans.Kind]:
    def scored(value: Column, *_) -> Column:
        return ratio(value, model) if model else F.lit(0.0)

    long_enough = lambda v, *_: F.length(assigned_value(v)) >= 6
    found = [
        spans.Kind("assign", PATTERNS["assign"], long_enough, lambda v, *_: scored(assigned_value(v))),
        spans.Kind("access", PATTERNS["access"], lambda *_: F.lit(True), scored),
        spans.Kind("hex", PATTERNS["hex"], lambda *_: F.lit(True), scored),
    ]
    if model:
        random = lambda v, *_: ratio(v, model) > model.threshold
        found.append(spans.Kind("random", PATTERNS["random"], random, scored))
    return found


def labelled_strings(docs: DataFrame, text: str = "text") -> DataFrame:
    """Strings labelled by the base patterns: what they match is random, ordinary words are not.

    All texts are used, so the counts grow with the table.
    """
    whole = whole_text(text)
    parts = [F.transform(F.regexp_extract_all(whole, F.lit(PATTERNS["assign"]), F.lit(0)), assigned_value)]
    parts += [F.regexp_extract_all(whole, F.lit(PATTERNS[k]), F.lit(0)) for k in ("access", "hex")]
    secret = F.filter(F.concat(*parts), lambda v: F.length(v) >= 6)
    words = F.regexp_extract_all(whole, F.lit(WORD), F.lit(0))
    rows = docs.select(F.explode(F.array(F.struct(secret.alias("s"), words.alias("w")))).alias("r"))
    tagged = F.concat(
        F.transform("r.s", lambda v: F.struct(v.alias("value"), F.lit(True).alias("secret"))),
        F.transform("r.w", lambda v: F.struct(v.alias("value"), F.lit(False).alias("secret"))),
    )
    return rows.select(F.inline(tagged))


def find(docs: DataFrame, model: Model, text: str = "text", out: str = "secrets") -> DataFrame:
    """``docs`` with ``out``: secrets as structs (start, rank, kind, end, value, score).

    The score is the log-likelihood ratio per character. A random run that overlaps a base
    span adds nothing.
    """
    source = free_name(docs, "_whole")
    found = spans.matches(docs.withColumn(source, whole_text(text)), source, kinds(model), out).drop(source)
    reach, ahead = f"{source}_reach", f"{source}_ahead"
    none, order = F.lit(0).cast("bigint"), [F.col(f"`{c}`") for c in found.columns]

    def of_base(value: Callable[[Column], Column]) -> Column:
        return F.transform(out, lambda s: F.when(s["kind"] != "random", value(s)).otherwise(none))

    # Spans are sorted by start, base ones first. What the base spans up to a place reach, and
    # the nearest start of one behind it, come from one pass each, so time grows with the spans.
    found = once(
        found,
        **{
            reach: running_greatest(of_base(lambda s: s["end"])),
            ahead: F.reverse(running_greatest(F.reverse(of_base(lambda s: FARTHEST - s["start"])))),
        },
    )
    fresh = F.filter(
        out,
        lambda s, i: (s["kind"] != "random")
        | ((F.get(reach, i) <= s["start"]) & (FARTHEST - F.get(ahead, i) >= s["end"])),
    )
    return once(found, **{out: fresh}).select(*order)
