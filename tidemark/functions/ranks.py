"""Exact order statistics without sorting the data.

A window or an exact percentile over a whole column brings that column into one task. Here
the value at a rank is found by narrowing: a quantile sketch proposes pivots, one counting
pass places the wanted rank between two of them, and only the few rows between those pivots
are looked at again. Every pass is an aggregate with a map-side combine; what reaches one
task or the driver is bounded by ``max_rows`` and by the number of wanted ranks.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.sketch import GRID, spread_quantiles

MAX_ROWS = 1_000_000
#: Values of a span, on average, among which pivots of unordered types are chosen.
SAMPLE = 2_000


@dataclass
class _Span:
    """A stretch of one group's sorted values that holds wanted ranks.

    ``low`` and ``high`` are excluded (None: unbounded) unless they are equal, in which case
    the span is the rows with exactly that value.
    """

    group: Any
    low: Any
    high: Any
    before: int
    size: int
    ranks: list[int]

    def is_point(self) -> bool:
        return self.low is not None and self.low == self.high


def values_at_ranks(
    df: DataFrame,
    value: str,
    ranks: Mapping[Any, Sequence[int]],
    sizes: Mapping[Any, int],
    by: str | None = None,
    tie: str | None = None,
    max_rows: int = MAX_ROWS,
    even: int | None = None,
) -> dict[tuple[Any, int], Any]:
    """Values at zero-based ``ranks`` of each group of ``by``; ``sizes`` are the group counts.

    With ``tie`` the order is (value, tie) and each answer is the pair. Null values must have
    been removed, from ``by`` too. Group keys are the values of ``by`` (the single group is
    ``None``). ``even`` says that the values are spread evenly from 0 to that number, as
    hashes are; the first pivots then need no sketch.
    """
    columns = [c for c in (by, value, tie) if c]
    rows = df.select(*dict.fromkeys(columns))
    found: dict[tuple[Any, int], Any] = {}
    spans = [_Span(g, None, None, 0, sizes[g], sorted(set(r))) for g, r in ranks.items() if len(r)]

    while wide := [s for s in spans if s.size > max_rows and not s.is_point()]:
        done = [s for s in spans if s not in wide]
        guessed, even = even, None
        points = _expected(wide, guessed) if guessed else _sketched(rows, value, wide, by)
        narrowed = _narrow(rows, value, wide, by, points, found, keep_points=tie is not None)
        if not guessed and sum(s.size for s in narrowed) >= sum(s.size for s in wide):
            spans = done + narrowed  # indistinguishable values: the last step still is exact
            break
        spans = done + narrowed

    if spans:
        _read_off(rows, value, spans, by, tie, found)
    return found


def _in_spans(rows: DataFrame, value: str, spans: Sequence[_Span], by: str | None) -> DataFrame:
    """Rows that lie in a span, with the span's number. Spans are disjoint."""
    v = F.col(value)
    if by is not None:
        kinds = [rows.schema[c].dataType.simpleString() for c in (by, value)]
        table = rows.sparkSession.createDataFrame(
            [(s.group, s.low, s.high, s.is_point(), i) for i, s in enumerate(spans)],
            f"_of {kinds[0]}, _low {kinds[1]}, _high {kinds[1]}, _point boolean, _span int",
        )
        inside = F.when(F.col("_point"), v == F.col("_low")).otherwise(
            (F.col("_low").isNull() | (v > F.col("_low"))) & (F.col("_high").isNull() | (v < F.col("_high")))
        )
        # One row per wanted rank at most, all known to the driver.
        joined = rows.join(F.broadcast(table), (F.col(by) == F.col("_of")) & inside)
        return joined.select(*rows.columns, "_span")

    def inside_of(s: _Span) -> Column:
        if s.is_point():
            return v == F.lit(s.low)
        test = v.isNotNull()
        if s.low is not None:
            test = test & (v > F.lit(s.low))
        if s.high is not None:
            test = test & (v < F.lit(s.high))
        return test

    number = F.lit(None).cast("int")
    for i, s in enumerate(spans):
        number = F.when(inside_of(s), F.lit(i)).otherwise(number)
    return rows.withColumn("_span", number).filter("_span IS NOT NULL")


def _expected(spans: Sequence[_Span], even: int) -> dict[int, list[int]]:
    """Pivots six standard deviations to either side of where evenly spread values have the ranks."""
    points = {}
    for i, s in enumerate(spans):
        margin = 3.0 / math.sqrt(s.size)
        places = {r / s.size + side for r in s.ranks for side in (-margin, margin)}
        points[i] = sorted({int(even * min(1.0, max(0.0, p))) for p in places})
    return points


def _sketched(rows, value, spans, by) -> dict[int, list]:
    """Pivots around the wanted ranks from a quantile sketch of each span."""
    near = {
        round((r - s.before) / max(1, s.size - 1) * GRID) + step
        for s in spans
        for r in s.ranks
        for step in (-2, 2)
    }
    offers = sorted({min(1.0, max(0.0, n / GRID)) for n in near})
    kind = rows.schema[value].dataType.simpleString()
    if not isinstance(rows.schema[value].dataType, T.NumericType):
        return _sampled(_in_spans(rows, value, spans, by), value, sum(s.size for s in spans), len(spans), offers)
    pivots = spread_quantiles(_in_spans(rows, value, spans, by), value, offers, ["_span"]).select(
        "_span", F.sort_array(F.array_distinct(F.col("p").cast(f"array<{kind}>"))).alias("p")
    )
    return {r["_span"]: r["p"] for r in pivots.collect()}


def _sampled(marked: DataFrame, value: str, size: int, spans: int, offers: Sequence[float]) -> dict[int, list]:
    """Pivots of values that cannot be sketched, text ids say: quantiles of a sample of them.

    Values are chosen by their hash, about SAMPLE of them for each span on average. Pivots only
    steer the narrowing; the counts that follow are exact.
    """
    share = min(1.0, SAMPLE * spans / max(1, size))
    chosen = marked.filter(F.pmod(F.xxhash64(value), F.lit(1 << 30)) < int(share * (1 << 30)) + 1)
    found = {}
    for r in chosen.groupBy("_span").agg(F.sort_array(F.collect_set(value)).alias("p")).collect():
        found[r["_span"]] = sorted({r["p"][min(len(r["p"]) - 1, int(o * len(r["p"])))] for o in offers})
    return {i: found.get(i, []) for i in range(spans)}


def _narrow(rows, value, spans, by, points, found, keep_points) -> list[_Span]:
    """Count the rows at and between the pivots, and keep the stretches with wanted ranks."""
    marked = _in_spans(rows, value, spans, by)
    kind = rows.schema[value].dataType.simpleString()
    # Slot 2i is the open stretch before pivot i, slot 2i+1 the pivot itself.
    table = rows.sparkSession.createDataFrame(list(points.items()), f"_span int, _p array<{kind}>")
    below = F.size(F.filter("_p", lambda p: p < F.col(value)))
    here = F.array_contains("_p", F.col(value)).cast("int")
    slots = marked.join(F.broadcast(table), "_span").select("_span", (2 * below + here).alias("slot"))
    counts: dict[int, dict[int, int]] = {}
    for r in slots.groupBy("_span", "slot").count().collect():
        counts.setdefault(r["_span"], {})[r["slot"]] = r["count"]

    narrowed: dict[tuple[int, int], _Span] = {}
    for i, s in enumerate(spans):
        histogram = counts[i]
        slots_here, starts, total = sorted(histogram), [], s.before
        for k in slots_here:
            starts.append(total)
            total += histogram[k]
        for rank in s.ranks:
            at = bisect.bisect_right(starts, rank) - 1
            k = slots_here[at]
            if k % 2 == 1:
                low = high = points[i][k // 2]
                if not keep_points:
                    found[s.group, rank] = low
                    continue
            else:
                low = points[i][k // 2 - 1] if k >= 2 else s.low
                high = points[i][k // 2] if k // 2 < len(points[i]) else s.high
            span = narrowed.setdefault((i, k), _Span(s.group, low, high, starts[at], histogram[k], []))
            span.ranks.append(rank)
    return list(narrowed.values())


def _read_off(rows, value, spans, by, tie, found) -> None:
    order = [value] + ([tie] if tie else [])
    wanted = rows.sparkSession.createDataFrame(
        [(i, r - s.before + 1) for i, s in enumerate(spans) for r in s.ranks], "_span int, _at int"
    )
    numbered = _in_spans(rows, value, spans, by).withColumn(
        "_at", F.row_number().over(Window.partitionBy("_span").orderBy(*order))
    )
    for r in numbered.join(F.broadcast(wanted), ["_span", "_at"]).collect():
        s = spans[r["_span"]]
        found[s.group, r["_at"] - 1 + s.before] = (r[value], r[tie]) if tie else r[value]


def exact_quantiles(
    df: DataFrame,
    columns: Mapping[str, Column],
    probabilities: Sequence[float],
    sizes: Mapping[str, int],
    max_rows: int = MAX_ROWS,
) -> dict[str, list[float]]:
    """Linearly interpolated quantiles of several numeric expressions (nulls ignored).

    Few values go through one exact aggregate, which holds them in memory; otherwise the
    ranks of all columns are narrowed together in long form.
    """
    few = sum(sizes[c] for c in columns) <= 2 * max_rows
    names = list(columns)
    if few:
        wanted = F.array(*[F.lit(float(p)) for p in probabilities])
        row = df.agg(*[F.percentile(columns[c], wanted).alias(str(i)) for i, c in enumerate(names)]).first()
        return {c: row[i] for i, c in enumerate(names)}

    pairs = [F.struct(F.lit(i).alias("n"), columns[c].cast("double").alias("v")) for i, c in enumerate(names)]
    long = df.select(F.inline(F.array(*pairs))).filter("v IS NOT NULL")
    last = {i: sizes[c] - 1 for i, c in enumerate(names)}
    ranks = {
        i: [min(end, int(p * end) + step) for p in probabilities for step in (0, 1)] for i, end in last.items()
    }
    at = values_at_ranks(long, "v", ranks, {i: end + 1 for i, end in last.items()}, by="n", max_rows=max_rows)
    result = {}
    for i, c in enumerate(names):
        result[c] = []
        for p in probabilities:
            low, part = divmod(p * last[i], 1)
            first, second = at[i, int(low)], at[i, min(last[i], int(low) + 1)]
            result[c].append(first + (second - first) * part)
    return result
