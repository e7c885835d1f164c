"""Baskets as long tables, item statistics, the basket matrix and frequent itemsets."""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame, functions as F

from comboscope.constants import BASKET_DROP_ITEMS
from comboscope.functions.expr import not_in, seeded_draw
from comboscope.functions.ids import dense_ids
from comboscope.functions.quantiles import exact_quantiles
from comboscope.functions.storage import written

TXN_KEY = ["transaction_date", "transaction_uid"]


def basket_rows(lines: DataFrame, key: list[str] = TXN_KEY) -> DataFrame:
    """Quantity per transaction and item. Transactions of different days never merge."""
    return (lines.where(F.col("item").isNotNull()).groupBy(*key, "item")
            .agg(F.coalesce(F.sum("quantity"), F.lit(0.0)).alias("quantity")))


def baskets_with_any(rows: DataFrame, items: DataFrame, key: list[str] = TXN_KEY) -> DataFrame:
    """Whole baskets that hold at least one of ``items`` (one column of names)."""
    wanted = items.select(F.col(items.columns[0]).alias("item")).distinct()
    hits = rows.join(wanted, "item", "left_semi").select(*key).distinct()
    return rows.join(hits, key, "left_semi")


def basket_pivot(rows: DataFrame, items: list[str], key: list[str] = TXN_KEY) -> DataFrame:
    """Wide quantities for a given list of items, absent items as 0."""
    # one aggregate per transaction; a pivot first keeps every pair of transaction and item
    cells = [F.sum(F.when(F.col("item") == F.lit(i), F.col("quantity"))).alias(i) for i in items]
    return rows.groupBy(*key).agg(*cells).na.fill(0.0)


def baskets(rows: DataFrame, dropped: list = BASKET_DROP_ITEMS, key: list[str] = TXN_KEY) -> DataFrame:
    """Distinct bought items per transaction. Repeats collapse before the shuffle, so a basket is at
    most as long as the item catalogue."""
    bought = rows.where((F.col("quantity") > 0) & not_in("item", dropped))
    return bought.groupBy(*key).agg(F.sort_array(F.collect_set("item")).alias("items"))


def item_totals(rows: DataFrame) -> DataFrame:
    return rows.groupBy("item").agg(F.sum("quantity").alias("total_qty"))


def describe(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, standard deviation, minimum, exact quartiles and maximum, as one row."""
    kept = written(df.select(F.col(column).cast("double").alias("x")), "described")
    q1, median, q3 = exact_quantiles(kept, "x", [0.25, 0.5, 0.75])
    return kept.agg(F.count("x").alias("count"), F.avg("x").alias("mean"), F.try_divide(
        F.sqrt(F.var_pop("x") * F.count("x")), F.sqrt(F.count("x") - 1.0)).alias("std"),
        F.min("x").alias("min"), F.lit(q1).alias("q1"), F.lit(median).alias("median"),
        F.lit(q3).alias("q3"), F.max("x").alias("max"))


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Rows per equal-width bin between minimum and maximum, the last bin closed; empty bins are 0."""
    df = written(df.select(column), "histogram")
    lo, hi = df.agg(F.min(column).cast("double"), F.max(column).cast("double")).first()
    if lo is None:
        return df.sparkSession.createDataFrame([], "bin int, bin_start double, n bigint")
    if lo == hi:  # a single value gets a bin range of one unit around it
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    place = F.least(F.floor((F.col(column) - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    counts = df.where(F.col(column).isNotNull()).groupBy(place.alias("bin")).agg(F.count("*").alias("n"))
    all_bins = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return all_bins.join(counts, "bin", "left").select(
        "bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_start"), F.coalesce("n", F.lit(0)).alias("n"))


def basket_matrix(rows: DataFrame, key: list[str] = TXN_KEY) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sparse coordinates (row_id, col_id, quantity) with the item and transaction id tables."""
    rows = written(rows, "basket-rows")
    items = dense_ids(rows, ["item"], "col_id")
    txns = dense_ids(rows, key, "row_id")
    cells = (rows.where(F.col("quantity") > 0).join(items, "item").join(txns, key)
             .select("row_id", "col_id", F.col("quantity").cast("float").alias("quantity")))
    return cells, items, txns


def frequent_itemsets(carts: DataFrame, min_support: float = 0.01, items_column: str = "items") -> DataFrame:
    """Itemsets bought together in at least ``min_support`` of all baskets, with support.

    Items and pairs are counted by plain aggregates. Only baskets that hold three items in frequent pairs, cut to
    those items, are mined for larger sets: a tree over all items of low support is as large as the baskets.
    """
    carts = written(carts.select(F.col(items_column).alias("items")), "carts")
    total, full = carts.agg(F.count("*"), F.count("items")).first()
    if total == 0:
        return carts.sparkSession.createDataFrame([], "items array<string>, freq bigint, support double")
    least = max(math.ceil(min_support * full), 1)
    unique = F.when(F.size("items") == F.size(F.array_distinct("items")), F.col("items")).otherwise(
        F.raise_error(F.lit("Items in a transaction must be unique")))
    lines = carts.where("items IS NOT NULL").withColumn("_cart", F.monotonically_increasing_id()).select("_cart", F.explode(unique).alias("item"))
    singles = written(lines.groupBy("item").agg(F.count("*").alias("freq")).where(F.col("freq") >= least), "frequent-items")
    kept = lines.join(singles.select(F.col("item").alias("_item")), F.col("item").eqNullSafe(F.col("_item")), "left_semi")
    kept = kept.groupBy("_cart").agg(F.array_sort(F.collect_list("item")).alias("items")).where(F.size("items") > 1)
    kept = written(kept.groupBy("items").agg(F.count("*").alias("n")), "frequent-carts")
    # pairs of places of a basket's sorted items; equal baskets are counted once
    pair = F.struct(F.get("items", F.col("_i")).alias("a"), F.get("items", F.col("_j")).alias("b"))
    places = kept.withColumn("_i", F.explode(F.sequence(F.lit(0), F.size("items") - 2)))
    places = places.withColumn("_j", F.explode(F.sequence(F.col("_i") + 1, F.size("items") - 1)))
    pairs = places.groupBy(pair.alias("pair")).agg(F.sum("n").alias("freq")).where(F.col("freq") >= least)
    pairs = written(pairs, "frequent-pairs")
    found = singles.select(F.array("item").alias("items"), "freq").unionByName(pairs.select(F.array("pair.a", "pair.b").alias("items"), "freq"))
    inside = places.select("items", "n", pair.alias("pair")).join(pairs.select("pair"), "pair", "left_semi")
    dense = inside.groupBy("items", "n").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.array("pair.a", "pair.b"))))).alias("some"))
    dense = written(dense.where(F.size("some") > 2).select(F.col("some").alias("items"), F.explode(F.sequence(F.lit(1), F.col("n"))).alias("_n")).drop("_n"), "dense-carts")
    rest = dense.count()
    if rest >= least:
        mined = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / rest).fit(dense).freqItemsets
        found = found.unionByName(mined.where(F.size("items") > 2).select(F.array_sort("items").alias("items"), "freq"))
    # The model mines again whenever its itemsets are read, and rules read them three times.
    return written(found.select("items", "freq", (F.col("freq") / F.lit(total)).alias("support")), "itemsets")


def frequent_itemsets_by_chunk(carts: DataFrame, min_support: float = 0.01, chunks: int = 2, seed: int = 42,
                               key: list[str] = TXN_KEY) -> DataFrame:
    """Itemsets mined apart in hash-chosen chunks, each with the supports of its own chunk."""
    marked = written(carts.withColumn("chunk", F.pmod(seeded_draw(seed, *key), F.lit(chunks)).cast("int")), "chunks")
    out = None
    for c in range(chunks):
        mined = frequent_itemsets(marked.where(F.col("chunk") == c), min_support).withColumn("chunk", F.lit(c))
        out = mined if out is None else out.unionByName(mined)
    return out


def singleton_supports(itemsets: DataFrame) -> DataFrame:
    return itemsets.where(F.size("items") == 1).select(F.element_at("items", 1).alias("item"), "support")


def items_of(itemsets: DataFrame) -> DataFrame:
    """Distinct item names over all itemsets."""
    return itemsets.select(F.explode("items").alias("product_desc")).distinct()
