"""Pairwise correlation of many series, and the choice of competitors from it."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from comboscope.functions.quantiles import values_at
from comboscope.functions.storage import written
from comboscope.operators.series import with_ordinal

BLOCK = 256  # items per block; a task holds two blocks
BINS = 1 << 13  # parts of the range of correlations that are counted


def _meetings(values: DataFrame, item: str, at: str, value: str, group: list[str], block: int) -> DataFrame:
    """Every two blocks of packed series side by side, one group per pair of blocks."""
    rows = values.select(*group, F.col(item).alias("item"), F.col(at).cast("long").alias("at"),
                         F.col(value).cast("double").alias("v")).na.drop()
    packed = written(rows.groupBy(*group, "item").agg(
        F.collect_list("at").alias("at"), F.collect_list("v").alias("v")), "series")
    sizes = packed.groupBy(*group).agg(F.ceil(F.count("*") / F.lit(block)).cast("int").alias("blocks"))
    sized = packed.join(sizes, group) if group else packed.withColumn("blocks", sizes.scalar())
    own = F.pmod(F.xxhash64("item"), F.col("blocks")).cast("int")
    return (sized.withColumn("own", own)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumn("lo", F.least("own", "other")).withColumn("hi", F.greatest("own", "other")))


def _kept_pairs(meets: DataFrame, group: list[str], keep: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """Pairs whose correlations ``keep`` marks; the others never leave their task."""
    kinds = dict(meets.dtypes)
    schema = "".join(f"{g} {kinds[g]}, " for g in group) + f"item_a {kinds['item']}, item_b {kinds['item']}, corr double, n long"

    def correlate(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        names, corr, n = _meeting(key, pdf)
        kept = keep(corr)
        out = pd.DataFrame({"item_a": names[0][kept], "item_b": names[1][kept],
                            "corr": corr[kept], "n": n[kept]})
        for name, v in zip(group, key):
            out[name] = v
        return out[[*group, "item_a", "item_b", "corr", "n"]]

    return meets.groupBy(*group, "lo", "hi").applyInPandas(correlate, schema)


def _meeting(key: tuple, pdf: pd.DataFrame):
    pdf = pdf.sort_values("item")  # the same sums in the same order, whenever a block pair is computed again
    lo, hi = key[-2], key[-1]
    left = pdf[pdf.own == lo]
    right = left if lo == hi else pdf[pdf.own == hi]
    return _block_pair(left, right, same=lo == hi)


def pairwise_correlations(values: DataFrame, item: str, at: str, value: str, group: list[str] = [],
                          min_abs: float | None = None, block: int = BLOCK, at_least: float | None = None) -> DataFrame:
    """Pearson correlation of every two items over the positions both have.

    Each item's series is packed into one row (as long as the calendar, no longer) and items are
    hashed into blocks. Every pair of blocks meets in one task as two small matrices whose product
    gives all sums at once, so a group with most of the items only means more block pairs and no
    row per pair and position is ever shuffled. ``min_abs`` keeps only stronger pairs and
    ``at_least`` only pairs that reach it, both inside the task.
    """
    def keep(corr: np.ndarray) -> np.ndarray:
        kept = np.ones(len(corr), dtype=bool) if min_abs is None else np.abs(corr) > min_abs
        return kept if at_least is None else kept & (corr >= at_least)

    return _kept_pairs(_meetings(values, item, at, value, group, block), group, keep)


def strongest_pairs(values: DataFrame, item: str, at: str, value: str, quantile: float, min_abs: float | None = None,
                    block: int = BLOCK) -> tuple[DataFrame, float | None]:
    """Pairs at or above the exact ``quantile`` of all correlations, and that cut; pairs stronger than ``min_abs`` either way stay, too.

    The block kernel runs twice. First it only counts correlations in ``BINS`` equal parts of -1 to 1, which tells the
    part of the wanted position. Then it keeps the pairs from that part on: all that is ever written. The position,
    counted from the top, is exact among them. Correlations that don't exist don't count; without any there is no cut.
    """
    meets = written(_meetings(values, item, at, value, [], block), "meetings")

    def count(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        corr = _meeting(key, pdf)[1]
        bins, n = np.unique(_bin(corr[np.isfinite(corr)]), return_counts=True)
        return pd.DataFrame({"bin": bins, "n": n})

    counted = meets.groupBy("lo", "hi").applyInPandas(count, "bin int, n long").groupBy("bin").agg(F.sum("n").alias("n"))
    counts = np.zeros(BINS, np.int64)
    for place, n in counted.collect():
        counts[place] = n
    total = int(counts.sum())
    if not total:
        return _kept_pairs(meets, [], lambda corr: np.zeros(len(corr), bool)), None
    position = (total - 1) * quantile
    below = math.floor(position)
    first = int(np.searchsorted(np.cumsum(counts), below, side="right"))
    kept = written(_kept_pairs(meets, [], lambda corr: (_bin(corr) >= first) | (np.zeros(len(corr), bool) if min_abs is None else np.abs(corr) > min_abs)), "strong-pairs")
    # ranks from the top are the same among the pairs kept
    top = kept.where(F.floor((F.col("corr") + 1) * F.lit(BINS / 2)) >= F.lit(first))
    n = int(counts[first:].sum())
    low, high = values_at(top, "corr", [below - (total - n), min(below + 1, total - 1) - (total - n)])
    cut = low + (high - low) * (position - below)
    strong = F.col("corr") >= F.lit(cut)
    return kept.where(strong if min_abs is None else strong | (F.abs("corr") > F.lit(min_abs))), cut


def _bin(corr: np.ndarray) -> np.ndarray:
    """Part of -1 to 1 that a correlation is in; -1 where there is none."""
    parts = np.minimum(np.floor((np.where(np.isfinite(corr), corr, -2) + 1) * (BINS / 2)), BINS - 1)
    return np.where(parts < 0, -1, parts).astype(np.int32)


def _block_pair(left: pd.DataFrame, right: pd.DataFrame, same: bool):
    """Names, correlations and overlap counts of all pairs between two blocks of series."""
    none = (np.array([], dtype=object), np.array([], dtype=object))
    if len(left) == 0 or len(right) == 0:
        return none, np.array([]), np.array([], dtype="int64")
    times = np.unique(np.concatenate([*left["at"], *right["at"]]))

    def dense(rows):
        x = np.zeros((len(rows), len(times)))
        m = np.zeros_like(x)
        for i, (at, v) in enumerate(zip(rows["at"], rows["v"])):
            place = np.searchsorted(times, at)
            x[i, place] = v - np.mean(v)  # correlation ignores shifts; centring keeps digits
            m[i, place] = 1.0
        return x, m

    (xa, ma), (xb, mb) = dense(left), dense(right)
    n = ma @ mb.T
    sa, sb = xa @ mb.T, ma @ xb.T
    qa, qb = (xa * xa) @ mb.T, ma @ (xb * xb).T
    va, vb = n * qa - sa * sa, n * qb - sb * sb
    # A side that is constant over the overlap leaves only rounding noise.
    usable = (n >= 2) & (va > 1e-12 * n * qa) & (vb > 1e-12 * n * qb)
    with np.errstate(divide="ignore", invalid="ignore"):
        corr = np.where(usable, (n * (xa @ xb.T) - sa * sb) / np.sqrt(va * vb), np.nan)
    a, b = left["item"].to_numpy(), right["item"].to_numpy()
    i, j = np.nonzero(a[:, None] < b[None, :]) if same else (k.ravel() for k in np.indices(n.shape))
    flip = a[i] > b[j]
    return ((np.where(flip, b[j], a[i]), np.where(flip, a[i], b[j])),
            np.clip(corr[i, j], -1, 1), n[i, j].astype("int64"))


def quantity_correlations(series: DataFrame, align: str = "date", anchor: str | None = None,
                          min_abs: float | None = None) -> DataFrame:
    """Correlation of daily quantities between products.

    'date' matches equal dates and reads every row. 'ordinal' matches the k-th rows of two series;
    rows past the length of the ``anchor`` product (by default the first product of the first day) do not count.
    """
    if align == "date":
        return pairwise_correlations(_dated(series), "product_desc", "at", "quantity_sold", min_abs=min_abs)
    if align != "ordinal":
        raise ValueError("align must be 'ordinal' or 'date'")
    placed = with_ordinal(series.where(F.col("product_desc").isNotNull()))
    placed = written(placed.select("product_desc", "business_date", "ordinal", "quantity_sold"), "ordinals")
    if anchor is None:
        first = placed.agg(F.min(F.struct("business_date", "product_desc")).alias("f")).first().f
        anchor = first.product_desc if first else None
    length = placed.where(F.col("product_desc") == F.lit(anchor)).agg(F.max("ordinal")).first()[0] or 0
    return pairwise_correlations(placed.where(F.col("ordinal") <= length), "product_desc", "ordinal",
                                 "quantity_sold", min_abs=min_abs)


def _dated(series: DataFrame) -> DataFrame:
    return series.withColumn("at", F.unix_date("business_date"))


def strongest_quantity_pairs(series: DataFrame, quantile: float = 0.75, min_abs: float | None = None) -> tuple[DataFrame, float | None]:
    """``strongest_pairs`` of the daily quantities, equal dates against each other."""
    return strongest_pairs(_dated(series), "product_desc", "at", "quantity_sold", quantile, min_abs)


def time_keys(time: str) -> list[str]:
    if time not in ("W", "M"):
        raise ValueError("time must be 'W' or 'M'")
    return ["wk_year", "wk_month", "week_of_year"] if time == "W" else ["year", "month"]


def price_correlations(logs: DataFrame, level: str = "product", time: str = "W", at_least: float | None = None) -> DataFrame:
    """Correlation of log prices within each category, between products or brands; all pairs, or those that reach ``at_least``."""
    ident = "brand" if level == "brand" else "product_desc"
    keys = time_keys(time)
    summed = logs.groupBy("category", *keys, ident).agg(F.sum("log_price").alias("log_price"))
    at = sum((F.col(k) * 100 ** i for i, k in enumerate(reversed(keys))), F.lit(0))
    return pairwise_correlations(summed.withColumn("at", at), ident, "at", "log_price", group=["category"], at_least=at_least)


def both_ways(pairs: DataFrame, group: list[str] = []) -> DataFrame:
    """Pairs as (item, other, corr) in both directions."""
    there = pairs.select(*group, F.col("item_a").alias("item"), F.col("item_b").alias("other"), "corr")
    back = pairs.select(*group, F.col("item_b").alias("item"), F.col("item_a").alias("other"), "corr")
    return there.unionByName(back)


def correlated_products(pairs: DataFrame, threshold: float = 0.6) -> DataFrame:
    """(product, other, corr) where the correlation is stronger than ``threshold`` either way."""
    strong = both_ways(pairs).where(F.abs("corr") > threshold)
    return strong.select(F.col("item").alias("product_desc"), "other", "corr")


def choose_competitors(pairs: DataFrame, max_cross: int = 3, min_corr: float = 0.3, max_inter_corr: float = 0.7,
                       group: list[str] = ["category"]) -> DataFrame:
    """Up to ``max_cross`` best correlated items each, none too close to one already chosen.

    One round per slot: the best remaining candidate of every item is an aggregate, then candidates
    correlated above ``max_inter_corr`` with it leave. Correlations below ``min_corr`` count for
    nothing, and equal ones go by name.
    """
    near = written(both_ways(pairs, group).where(F.col("corr") >= min_corr), "near-pairs")
    blocking = near.where(F.col("corr") > max_inter_corr).select(*group, F.col("item").alias("other"), F.col("other").alias("chosen"))
    left, chosen = near, None
    for slot in range(1, max_cross + 1):
        best = left.groupBy(*group, "item").agg(F.min(F.struct((-F.col("corr")).alias("order"), "other")).alias("b"))
        best = written(best.select(*group, "item", F.lit(slot).alias("slot"), F.col("b.other").alias("competitor"),
                                   (-F.col("b.order")).alias("corr")), "competitors")
        chosen = best if chosen is None else chosen.unionByName(best)
        if slot < max_cross:
            held = best.select(*group, "item", F.col("competitor").alias("chosen"))
            left = (left.join(held, [*group, "item"]).where(F.col("other") != F.col("chosen"))
                    .join(blocking, [*group, "other", "chosen"], "left_anti").drop("chosen"))
    return chosen
