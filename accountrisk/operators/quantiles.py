"""Exact order statistics of whole columns by distributed selection of ranks.

Wanted ranks are narrowed to intervals of values: a mergeable sketch names values close to each rank, one counting
pass tells how many rows lie below and at each of them, and a rank is then either that of a named value or lies strictly
between two of them. Every round takes named values out of the interval, so a value that fills most of a column cannot
hold it up. Intervals of at most ``sort_limit`` rows or distinct values are finished by range buckets: values are
counted, each bucket's total gives the next one its offset, and the running count is taken within a bucket. No column and
no interval is sorted in one task, and the answer equals linear interpolation on the sorted column.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accountrisk.functions.numeric import number
from accountrisk.operators.ordered import BUCKET, default_buckets, running_totals

SORT_LIMIT = 1_000_000
SKETCH_ACCURACY = 10_000


@dataclass
class _Interval:
    """Values of one column strictly between two bounds (None is open), and the ranks sought there."""

    column: str
    ranks: list[int]
    least: float
    most: float
    size: int
    lower: float | None = None
    upper: float | None = None
    below: int = 0
    inside: int = 0

    def values(self) -> Column:
        value = number(self.column)
        keep = value.isNotNull()
        if self.lower is not None:
            keep = keep & (value > self.lower)
        if self.upper is not None:
            keep = keep & (value < self.upper)
        return F.when(keep, value)

    def bucket(self, value: Column, buckets: int) -> Column:
        """Buckets of equal width between the bounds; they balance the work and change no result."""
        width = (self.most - self.least) / buckets
        if not (math.isfinite(width) and width > 0):
            return F.lit(0)
        place = F.floor((value - F.lit(self.least)) / F.lit(width))
        return F.least(F.greatest(place, F.lit(0)), F.lit(buckets - 1)).cast("int")


def _distinct(value: Column) -> Column:
    """Approximate distinct count in one small mergeable sketch; decides only how far to narrow."""
    return F.hll_sketch_estimate(F.hll_sketch_agg(F.when(value.isNotNull(), F.xxhash64(value))))


def rank_pair(prob: float, count: int) -> tuple[int, int, float]:
    position = prob * (count - 1)
    low = math.floor(position)
    return low, min(low + 1, count - 1), position - low


def order_statistics(
    df: DataFrame,
    columns: Sequence[str],
    ranks_for: Callable[[int, int], Iterable[int]],
    sort_limit: int = SORT_LIMIT,
    accuracy: int = SKETCH_ACCURACY,
) -> tuple[int, dict[str, int], dict[tuple[str, int], float]]:
    """Values at given 0-based ranks of each column's sorted non-null values.

    ``ranks_for(values, rows)`` names the ranks wanted of a column with that many values in a table of
    that many rows. Returns the row count, the value count per column and the value at (column, rank).
    """
    columns = list(columns)
    found = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[
            F.struct(
                F.count(number(c)).alias("n"), F.min(number(c)).alias("least"), F.max(number(c)).alias("most"),
                _distinct(number(c)).alias("distinct"),
            ).alias(f"c{i}")
            for i, c in enumerate(columns)
        ],
    ).first()
    about = {c: found[f"c{i}"] for i, c in enumerate(columns)}
    counts = {c: about[c]["n"] for c in columns}
    wide = [
        _Interval(
            c, sorted(set(ranks_for(counts[c], found["rows"]))), about[c]["least"], about[c]["most"],
            min(about[c]["distinct"], counts[c]), inside=counts[c],
        )
        for c in columns
        if counts[c] > 0
    ]
    known: dict[tuple[str, int], float] = {}
    ready: list[_Interval] = []
    while wide:
        ready += [b for b in wide if b.size <= sort_limit]
        wide = [b for b in wide if b.size > sort_limit]
        if wide:
            wide, values = _narrow(df, wide, accuracy)
            known |= values
    return found["rows"], counts, known | _values_at_ranks(df, ready)


def between(low: float, high: float, share: float) -> float:
    """Linear interpolation that returns equal ends unchanged."""
    return low if low == high else low + (high - low) * share


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    sort_limit: int = SORT_LIMIT,
    accuracy: int = SKETCH_ACCURACY,
) -> dict[str, list[float | None]]:
    """Quantiles per column, nulls skipped; ``None`` for a column without values."""

    def ranks(values: int, _: int) -> list[int]:
        return [r for p in probs for r in rank_pair(p, values)[:2]]

    _, counts, at_rank = order_statistics(df, columns, ranks, sort_limit, accuracy)
    result: dict[str, list[float | None]] = {}
    for c in columns:
        row: list[float | None] = []
        for p in probs:
            if counts[c] == 0:
                row.append(None)
                continue
            low, high, share = rank_pair(p, counts[c])
            row.append(between(at_rank[(c, low)], at_rank[(c, high)], share))
        result[c] = row
    return result


def _narrow(
    df: DataFrame, intervals: list[_Interval], accuracy: int
) -> tuple[list[_Interval], dict[tuple[str, int], float]]:
    """One sketch pass and one counting pass: narrower intervals, and the ranks that fell on a named value."""
    slack = 3.0 / accuracy
    sketches = []
    for i, b in enumerate(intervals):
        wanted = []
        for rank in b.ranks:
            centre = (rank - b.below) / max(b.inside - 1, 1)
            wanted += [max(0.0, centre - slack), min(1.0, centre + slack)]
        sketches.append(F.percentile_approx(b.values(), F.array(*map(F.lit, wanted)), accuracy).alias(f"s{i}"))
    sketch = df.agg(*sketches).first()
    named = [sorted(set(sketch[f"s{i}"])) for i in range(len(intervals))]

    tallies = []
    for i, (b, values) in enumerate(zip(intervals, named, strict=True)):
        value = b.values()
        for j, v in enumerate(values):
            tallies += [F.count_if(value < v).alias(f"below{i}_{j}"), F.count_if(value == v).alias(f"at{i}_{j}")]
    counted = df.agg(*tallies).first()

    narrower: list[_Interval] = []
    known: dict[tuple[str, int], float] = {}
    for i, (b, values) in enumerate(zip(intervals, named, strict=True)):
        gaps: dict[int, list[int]] = {}
        begin = [b.below + counted[f"below{i}_{j}"] for j in range(len(values))]
        end = [start + counted[f"at{i}_{j}"] for j, start in enumerate(begin)]
        for rank in b.ranks:
            before = sum(start <= rank for start in begin)  # named values that begin at or before the rank
            if before and rank < end[before - 1]:
                known[(b.column, rank)] = values[before - 1]
            else:
                gaps.setdefault(before, []).append(rank)
        for j, ranks in gaps.items():
            below = end[j - 1] if j else b.below
            inside = (begin[j] if j < len(values) else b.below + b.inside) - below
            lower, upper = (values[j - 1] if j else b.lower), (values[j] if j < len(values) else b.upper)
            least, most = (b.least if lower is None else lower), (b.most if upper is None else upper)
            narrower.append(_Interval(b.column, ranks, least, most, inside, lower, upper, below, inside))
    return narrower, known


def _values_at_ranks(df: DataFrame, intervals: list[_Interval]) -> dict[tuple[str, int], float]:
    """Order statistics inside the intervals, from distinct values and their counts in range buckets."""
    if not intervals:
        return {}
    buckets = default_buckets(df)
    entries = [
        F.struct(F.lit(i).alias("slot"), b.bucket(b.values(), buckets).alias(BUCKET), b.values().alias("value"))
        for i, b in enumerate(intervals)
    ]
    tallies = (
        df.select(F.inline(F.array(*entries)))
        .where(F.col("value").isNotNull())
        .groupBy("slot", BUCKET, "value")
        .agg(F.count("*").alias("n"))
    )
    wanted = F.create_map(
        *[
            x
            for i, b in enumerate(intervals)
            for x in (F.lit(i), F.array(*[F.lit(r - b.below).cast("bigint") for r in b.ranks]))
        ]
    )
    start = F.col("n_before")
    hits = (
        running_totals(tallies, ["slot"], "value", ["n"])
        .withColumn(
            "ranks",
            F.filter(F.element_at(wanted, F.col("slot")), lambda r: (r >= start) & (r < start + F.col("n"))),
        )
        .where(F.size("ranks") > 0)
        .select("slot", "value", "ranks")
        .collect()  # at most one row per wanted rank
    )
    return {
        (intervals[row["slot"]].column, rank + intervals[row["slot"]].below): row["value"]
        for row in hits
        for rank in row["ranks"]
    }
