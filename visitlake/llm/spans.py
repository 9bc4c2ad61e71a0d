"""Match spans as Spark expressions. Offsets count code points, ends are exclusive."""

from __future__ import annotations

import operator
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A span that has not been judged yet, with the text on both sides of it.
MATCH = "array<struct<start:int,end:int,match:string,left:string,right:string>>"

# Running sums are taken within chunks and over chunks, since growing one long array costs its length each time.
_CHUNK = 64
# Code points of the blocks that long texts are cut from, since a substring costs the length of what stands before it.
_BLOCK = 1024


def _running(values: Column, start: Column) -> Column:
    """Sums of `start` and the values up to each one."""
    return F.aggregate(
        values, F.array().cast("array<int>"),
        lambda acc, v: F.concat(acc, F.array((F.coalesce(F.try_element_at(acc, F.lit(-1)), start) + v).cast("int"))),
    )


def running_sums(values: Column) -> Column:
    """Sums of the non-empty array's integers up to each one."""
    total = lambda c: F.aggregate(c, F.lit(0), lambda acc, v: (acc + v).cast("int"))

    def summed(of: Column) -> Column:
        chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(of) - 1) / _CHUNK).cast("int")),
                             lambda i: F.slice(of, i * _CHUNK + 1, F.lit(_CHUNK)))
        before = F.concat(F.array(F.lit(0)), _running(F.transform(chunks, total), F.lit(0)))
        return F.flatten(F.zip_with(chunks, F.slice(before, 1, F.size(chunks)), lambda c, b: _running(c, b)))

    # in an array of one, since an expression inside a lambda is evaluated anew for each element
    return F.flatten(F.transform(F.array(values), summed))


def _spans(gaps: Column, found: Column, context: int) -> Column:
    """Spans of the matches `found` between `gaps`, one gap more than there are matches."""
    ends = running_sums(F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found, lambda g, m: F.length(g) + F.length(m)))
    placed = F.arrays_zip(
        found.alias("match"), ends.alias("end"), F.slice(gaps, F.lit(1), F.size(found)).alias("before"),
        F.slice(gaps, F.lit(2), F.size(found)).alias("after"),
    )
    return F.transform(placed, lambda s: F.struct(
        (s["end"] - F.length(s["match"])).alias("start"), s["end"].alias("end"), s["match"].alias("match"),
        F.substring(s["before"], -context, context).alias("left"), F.substring(s["after"], 1, context).alias("right"),
    )).cast(MATCH)


def with_matches(df: DataFrame, text: str, patterns: dict[str, tuple[str, tuple[str, ...]]], context: int = 1) -> DataFrame:
    """Adds an array column per pattern: its leftmost non-overlapping matches in the column `text`, in order.

    A pattern comes with strings of which a matching text holds at least one (none: no such string), looked for first.
    Elements are (start, end, match, left, right); left and right are up to `context` characters beside the match,
    as far as the neighbouring matches. Splitting by the pattern finds where matches are; only texts that
    have some are matched a second time. Patterns never match empty text and use possessive quantifiers on groups,
    which are matched in a loop; others recurse, which very long texts would exhaust.
    """
    gaps = {}
    for name, (pattern, needed) in patterns.items():
        pieces = F.split(F.col(text), pattern, -1)
        holds = [F.col(text).contains(n) for n in needed]
        gaps[f"_gaps_{name}"] = F.when(reduce(operator.or_, holds), pieces) if holds else pieces
    pieces = df.withColumns(gaps)

    def found_between(name: str, pattern: str) -> Column:
        matches = F.array(F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0)))
        return F.flatten(F.transform(matches, lambda m: _spans(F.col(name), m, context)))

    found = {
        name: F.when(F.size(f"_gaps_{name}") > 1, found_between(f"_gaps_{name}", pattern)).otherwise(F.array().cast(MATCH))
        for name, (pattern, _) in patterns.items()
    }
    return pieces.withColumns(found).drop(*gaps)


def written(spans: Column) -> Column:
    """kind:start:end of each span (kind, start, end), comma-joined in the array's order."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(spans: Column) -> Column:
    return F.sha2(written(spans), 256)


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, of_kind(kind))).cast("bigint")


def _searchable(spans: Column) -> Column:
    """Spans in order that do not overlap, with the steps of a binary search over them."""
    steps = F.filter(F.array(*[F.lit(1 << b) for b in range(24, -1, -1)]), lambda p: p <= F.size(spans))
    return F.struct(spans.alias("spans"), steps.alias("steps"))


def _last_before(ordered: Column, place: Column) -> Column:
    """The last span of a `_searchable` that starts before `place`; null if there is none."""
    ahead = lambda at, step: F.coalesce(F.try_element_at(ordered["spans"], at + step)["start"] < place, F.lit(False))
    number = F.aggregate(ordered["steps"], F.lit(0), lambda at, step: F.when(ahead(at, step), at + step).otherwise(at))
    return F.when(number > 0, F.try_element_at(ordered["spans"], F.greatest(number, F.lit(1))))


def _without(spans: Column, others: Column, field: str, values: tuple[str, ...], hides: Callable[[Column, Column], Column], place) -> Column:
    """The `spans` that none of `others` hides.

    Those of one value of `field` are in order and do not overlap, so only the last of them that starts before `place(span)` may.
    """
    def having(all_: Column, value: str) -> Column:
        return _searchable(F.filter(all_["others"], lambda o: o[field] == value)).alias(value)

    def hidden(of: Column, s: Column) -> Column:
        return reduce(operator.or_, [F.coalesce(hides(_last_before(of[v], place(s)), s), F.lit(False)) for v in values])

    # in arrays of one, since an expression inside a lambda is evaluated anew for each element
    both = F.array(F.struct(spans.alias("spans"), others.alias("others")))
    ordered = F.transform(both, lambda all_: F.struct(all_["spans"].alias("spans"), *[having(all_, v) for v in values]))
    return F.flatten(F.transform(ordered, lambda of: F.filter(of["spans"], lambda s: ~hidden(of, s))))


def apart_from(spans: Column, kept: Column, kinds: tuple[str, ...]) -> Column:
    """The spans that overlap none of `kept`, whose spans of one kind are in order and do not overlap."""
    return _without(spans, kept, "kind", kinds, lambda k, s: k["end"] > s["start"], lambda s: s["end"])


def longest(spans: Column, field: str, values: tuple[str, ...]) -> Column:
    """The spans that lie inside no longer one of them; those of one value of `field` are in order and do not overlap."""
    longer = lambda o, s: (o["end"] >= s["end"]) & (o["end"] - o["start"] > s["end"] - s["start"])
    return _without(spans, spans, field, values, longer, lambda s: s["start"] + 1)


def of_kind(kind: str) -> Callable[[Column], Column]:
    return lambda s: s["kind"] == kind


def replaced(text: Column, spans: Column, kinds: tuple[str, ...], mark: str) -> Column:
    """`text` with `mark` for every stretch that the spans (start, rank, kind, end) cover.

    Spans are in order, by start and then by rank, the place of their kind in `kinds`, and none lies inside another
    one of its kind. Of spans that overlap the first brings the mark. Texts of any length and number of spans take
    time in proportion.
    """
    def between(blocks: Column, start: Column, end: Column) -> Column:
        first = lambda i: F.greatest(start - i * _BLOCK, F.lit(0))
        part = lambda i: F.substring(F.element_at(blocks, i + 1), first(i) + 1, F.least(end - i * _BLOCK, F.lit(_BLOCK)) - first(i))
        numbers = F.sequence(F.floor(start / _BLOCK).cast("int"), F.floor((end - 1) / _BLOCK).cast("int"))
        return F.when(end > start, F.array_join(F.transform(numbers, part), "")).otherwise("")

    def covered_to(of: Column, s: Column) -> Column:
        """End of what earlier spans cover."""
        ends = [_last_before(of[k], s["start"] + F.when(F.lit(rank) < s["rank"], 1).otherwise(0))["end"] for rank, k in enumerate(kinds)]
        return F.greatest(F.lit(0), *ends)

    def joined(of: Column) -> Column:
        stretches = F.transform(of["spans"], lambda s: F.struct(covered_to(of, s).alias("from"), s["start"].alias("to")))
        pieces = F.transform(F.filter(stretches, lambda p: p["to"] >= p["from"]), lambda p: between(of["blocks"], p["from"], p["to"]))
        rest = between(of["blocks"], F.coalesce(F.array_max(of["spans"]["end"]), F.lit(0)), F.length(text))
        return F.array_join(F.concat(pieces, F.array(rest)), mark)

    once = F.transform(F.array(F.array_distinct(spans)), lambda distinct: F.struct(
        distinct.alias("spans"), F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_BLOCK}}}"), F.lit(0)).alias("blocks"),
        *[_searchable(F.filter(distinct, of_kind(k))).alias(k) for k in kinds],
    ))
    return F.element_at(F.transform(once, joined), 1)


def normal_cdf(z: Column) -> Column:
    """Standard normal distribution function, within 1e-7 (Abramowitz and Stegun 26.2.17, as fixed values below)."""
    t = 1 / (1 + 0.2316419 * F.abs(z))
    series = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.exp(-z * z / 2) * 0.3989422804014327 * series
    return F.when(z > 0, 1 - tail).otherwise(tail)
