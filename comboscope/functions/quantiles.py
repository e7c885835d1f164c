"""Exact quantiles with linear interpolation, without gathering the values in one place."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from comboscope.functions.expr import col, finite

#: Size of a sketch. It keeps every one of up to so many values; beyond, ranks are nearly always off by less than ``MARGIN`` of them.
SKETCH, MARGIN = 4096, 0.002


def exact_quantiles(df: DataFrame, column: Column | str, probs: list[float]) -> list[float | None]:
    """Quantiles of the finite values of ``column``.

    A mergeable sketch of all values brackets every wanted position. The next pass counts exactly what lies below
    and at the ends of each bracket and sketches what lies inside, until a position is at an end or the inside
    fits a sketch whole. Two passes do for a million values, three for several hundred million, whatever
    their distribution and ties. A bracket that misses its position is widened. What reaches the driver
    depends on the number of ``probs`` alone.
    """
    xs = _values(df, column)
    n, sketch = _sketched(xs)
    if n == 0:
        return [None for _ in probs]
    places = [((n - 1) * p, math.floor((n - 1) * p)) for p in probs]
    at = _order_statistics(xs, n, sketch, {k for _, k in places} | {min(k + 1, n - 1) for _, k in places})
    return [at[k] if position == k else at[k] + (at[k + 1] - at[k]) * (position - k) for position, k in places]


def values_at(df: DataFrame, column: Column | str, positions: list[int]) -> list[float]:
    """The finite values of ``column`` at sorted positions, 0 for the least."""
    xs = _values(df, column)
    at = _order_statistics(xs, *_sketched(xs), set(positions))
    return [at[k] for k in positions]


def _values(df: DataFrame, column: Column | str) -> DataFrame:
    return df.select(finite(col(column).cast("double")).alias("x")).where(F.col("x").isNotNull())


def _sketched(xs: DataFrame) -> tuple[int, bytes]:
    return tuple(xs.agg(F.count("x"), F.kll_sketch_agg_double("x", SKETCH)).first())


def _brackets(spark, asked: list[tuple[bytes, int, int, float]]) -> list[tuple[float, float]]:
    """For (sketch, values in it, position among them, margin): two values that the position lies between, equal if known exactly."""
    def value(sketch: bytes, place: float, n: int) -> Column:
        return F.kll_sketch_get_quantile_double(F.lit(bytearray(sketch)), F.lit(min(max((place + 0.5) / n, 0.0), 1.0)))

    spread = [0.0 if n <= SKETCH else margin * n for _, n, _, margin in asked]
    ends = [value(s, k + side * m, n) for (s, n, k, _), m in zip(asked, spread, strict=True) for side in (-1, 1)]
    found = spark.range(1).select(*[v.alias(str(i)) for i, v in enumerate(ends)]).first()
    return list(zip(found[::2], found[1::2], strict=True))


def _order_statistics(xs: DataFrame, n: int, sketch: bytes, wanted: set[int]) -> dict[int, float]:
    """The values at sorted positions ``wanted`` (0-based) among all ``n``."""
    at: dict[int, float] = {}
    # per position: sketch of the values it is among, their number, how many values are below them, margin
    among = {k: (sketch, n, 0, MARGIN) for k in wanted}
    while among:
        todo = sorted(among)
        brackets = dict(zip(todo, _brackets(xs.sparkSession, [(s, m, k - below, margin) for k in todo for s, m, below, margin in [among[k]]]), strict=True))
        for k in todo:
            if among[k][1] <= SKETCH:
                at[k] = brackets[k][0]
                del among[k]
        open_ = sorted({brackets[k] for k in among})
        if not open_:
            break
        x = F.col("x")
        counted = xs.agg(*[c.alias(f"{name}{i}") for i, (lo, hi) in enumerate(open_) for name, c in (
            ("below", F.count_if(x < lo)), ("lo", F.count_if(x == lo)), ("hi", F.count_if(x == hi)), ("n", F.count_if((x > lo) & (x < hi))),
            ("sketch", F.kll_sketch_agg_double(F.when((x > lo) & (x < hi), x), SKETCH)))]).first()
        for k in list(among):
            i = open_.index(brackets[k])
            (lo, hi), below, inside = open_[i], counted[f"below{i}"], counted[f"n{i}"]
            first = below + counted[f"lo{i}"]  # position of the first value above ``lo``
            if below <= k < first:
                at[k] = lo
            elif first <= k < first + inside:
                among[k] = (counted[f"sketch{i}"], inside, first, MARGIN)
                continue
            elif lo < hi and first + inside <= k < first + inside + counted[f"hi{i}"]:
                at[k] = hi
            else:  # the sketch was off by more than its margin
                among[k] = (*among[k][:3], max(among[k][3] * 4, 1 / SKETCH))
                continue
            del among[k]
    return at
