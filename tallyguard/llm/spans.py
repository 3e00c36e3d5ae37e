"""Matches of regular expressions with their places, as column expressions.

Patterns are written so that the matcher needs time in proportion to the text: repeated
groups are possessive and starts that cannot begin another match are skipped. Places
count code points; the end is exclusive.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyguard.llm.common import free_name, once, running_greatest, running_sums

CONTEXT = 40
# Code points of a block in which places of a long text are looked up.
PIECE = 4096


@dataclass(frozen=True)
class Kind:
    """A pattern and what its matches must satisfy; ``valid`` gets value, text before and text after."""

    name: str
    pattern: str
    valid: Callable[[Column, Column, Column], Column]
    score: Callable[[Column, Column, Column], Column] = lambda value, before, after: F.lit(1.0)


def matches(df: DataFrame, text: str, kinds: list[Kind], out: str) -> DataFrame:
    """Add ``out``: all valid matches as structs (start, rank, kind, end, value, score), sorted.

    A column called ``out`` is replaced.
    """
    df = df.drop(out)
    tmp = free_name(df, "_found")
    numbers = range(len(kinds))
    df = once(df, **{f"{tmp}_v{i}": F.regexp_extract_all(text, F.lit(k.pattern), F.lit(0)) for i, k in enumerate(kinds)})

    def piece(g: Column) -> Column:
        return F.struct(
            F.length(g).cast("bigint").alias("n"),
            F.lower(F.left(g, F.lit(CONTEXT))).alias("head"),
            F.lower(F.right(g, F.lit(CONTEXT))).alias("tail"),
        )

    def pieces(i: int) -> Column:
        """What stands between the matches."""
        return F.when(F.size(f"{tmp}_v{i}") > 0, F.transform(F.split(text, kinds[i].pattern, -1), piece))

    def ends(i: int) -> Column:
        values, gaps = F.col(f"{tmp}_v{i}"), F.col(f"{tmp}_g{i}")
        steps = F.transform(values, lambda v, j: F.get(gaps, j)["n"] + F.length(v))
        return F.when(F.size(values) > 0, running_sums(steps))

    def spans(i: int) -> Column:
        kind, values, gaps, stops = kinds[i], *[F.col(f"{tmp}_{c}{i}") for c in "vge"]

        def span(v: Column, j: Column) -> Column:
            end = F.get(stops, j)
            before, after = F.get(gaps, j)["tail"], F.get(gaps, j + 1)["head"]
            return F.struct(
                (end - F.length(v)).alias("start"),
                F.lit(i).alias("rank"),
                F.lit(kind.name).alias("kind"),
                end.alias("end"),
                v.alias("value"),
                F.when(kind.valid(v, before, after), kind.score(v, before, after)).alias("score"),
            )

        return F.filter(F.transform(values, span), lambda s: s["score"].isNotNull())

    df = once(df, **{f"{tmp}_g{i}": pieces(i) for i in numbers})
    df = once(df, **{f"{tmp}_e{i}": ends(i) for i in numbers})
    df = once(df, **{out: F.array_sort(F.concat(*[spans(i) for i in numbers]))})
    return df.drop(*[f"{tmp}_{c}{i}" for c in "vge" for i in numbers])


def masked(df: DataFrame, text: str, kinds: list[Kind], mask: Callable[[Column], Column]) -> DataFrame:
    """Replace the union of all valid matches in ``text``: spans that overlap are one region, with
    the mask of the kind that begins it (of several, the first listed)."""
    order = [F.col(f"`{c}`") for c in df.columns]
    tmp = free_name(df, "_region")
    found, most, regions, blocks = (f"{tmp}{i}" for i in range(4))
    df = matches(df, text, kinds, found)
    ends = F.transform(F.coalesce(found, F.array().cast(df.schema[found].dataType)), lambda s: s["end"])
    df = once(df, **{most: running_greatest(ends)})

    def begins(s: Column, i: Column) -> Column:
        """Whether no span before reaches into this one."""
        return (i == 0) | (s["start"] >= F.get(most, i - 1))

    def closes(i: Column) -> Column:
        following = F.get(found, i + 1)
        return following.isNull() | (following["start"] >= F.get(most, i))

    starts = F.filter(found, begins)
    stops = F.filter(F.transform(most, lambda m, i: F.when(closes(i), m)), lambda m: m.isNotNull())
    pairs = F.zip_with(starts, stops, lambda s, e: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), e.alias("end")))
    df = once(df, **{regions: pairs})
    # The text in blocks, since finding a place in a long text walks to it.
    any_found = F.size(regions) > 0
    df = once(df, **{blocks: F.when(any_found, F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0)))})

    def between(a: Column, b: Column) -> Column:
        first = F.floor(a / PIECE).cast("int")
        near = F.array_join(F.slice(blocks, first + 1, F.floor(b / PIECE).cast("int") - first + 1), "")
        return F.substring(near, (a % PIECE + 1).cast("int"), (b - a).cast("int"))

    def piece(r: Column, i: Column) -> Column:
        before = F.coalesce(F.get(regions, i - 1)["end"], F.lit(0).cast("bigint"))
        return F.concat(between(before, r["start"]), mask(r["kind"]))

    rest = between(F.element_at(regions, -1)["end"], F.length(text).cast("bigint"))
    joined = F.concat(F.array_join(F.transform(regions, piece), ""), rest)
    return once(df, **{text: F.when(any_found, joined).otherwise(F.col(text))}).select(*order)


def digest_text(spans: Column, names: list[str] | None = None) -> Column:
    """``kind:start:end`` of the spans, comma-joined; of some kinds only, if ``names`` are given."""
    if names is not None:
        spans = F.filter(spans, lambda s: s["kind"].isin(names))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest_columns(spans: str, names: list[str]) -> list[Column]:
    def count(name: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == name)).cast("bigint").alias(f"n_{name}")

    base, every = digest_text(F.col(spans), names), digest_text(F.col(spans))
    return [*map(count, names), F.sha2(base, 256).alias("base_sha256"), every.alias("spans")]
