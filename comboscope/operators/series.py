"""Daily product series and the choice of products to model."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from comboscope.constants import JUMP_DATE, SERIES_DROP_ITEMS, SERIES_DROP_PREFIX
from comboscope.functions.expr import item_id, unit_price
from comboscope.functions.quantiles import exact_quantiles
from comboscope.functions.storage import written
from comboscope.operators.cleaning import drop_named, first_per_key, non_negative_quantity, union_all
from comboscope.sources.tables import rows_in


def daily_series(items: DataFrame, products: DataFrame | list | None = None, sites: DataFrame | list | None = None,
                 by_item_id: bool = False, dedupe_columns: list[str] | None = None, zero_qty: str = "null",
                 partition_date: str | None = None) -> DataFrame:
    """Quantity sold and mean unit price per date and product (and item id).

    ``dedupe_columns`` empty skips the dedupe, None uses every column. With ``partition_date`` only
    the first row per product and partition is kept, as when each day's file is loaded on its own.
    """
    if dedupe_columns is None:
        items = items.dropDuplicates()
    elif dedupe_columns:
        items = items.select(*dedupe_columns).dropDuplicates()
    if by_item_id:
        items = items.withColumn("item_id", item_id("product_id"))
    for column, values in (("site_number", sites), ("product_desc", products)):
        if values is not None:
            items = rows_in(items, column, values)
    keys = [*([partition_date] if partition_date else []), "business_date",
            *(["item_id"] if by_item_id else []), "product_desc"]
    priced = (non_negative_quantity(items)
              .withColumn("price", unit_price("sales_amount", "quantity_sold", zero_qty))
              .na.drop(subset=keys))
    series = (priced.groupBy(*keys)
              .agg(F.coalesce(F.sum("quantity_sold"), F.lit(0.0)).alias("quantity_sold"),
                   F.avg("price").alias("price")))
    if partition_date:
        order = ["business_date", *(["item_id"] if by_item_id else [])]
        series = first_per_key(series, [partition_date, "product_desc"], order)
    return with_calendar(series)


def with_calendar(df: DataFrame, date: str = "business_date") -> DataFrame:
    return (df.withColumn("year", F.year(date)).withColumn("month", F.month(date))
            .withColumn("week", F.weekofyear(date)))


def product_totals(series: DataFrame) -> DataFrame:
    return (series.where(F.col("product_desc").isNotNull()).groupBy("product_desc")
            .agg(F.sum("quantity_sold").alias("total_qty")))


def quantile_cascade(series: DataFrame, cuts: tuple[float, ...] = (0.75, 0.25, 0.75)) -> DataFrame:
    """Totals of the products that stay at or above each quantile of the products left so far."""
    totals = written(product_totals(series), "product-totals")
    for p in cuts:
        cut = exact_quantiles(totals, "total_qty", [p])[0]
        if cut is not None:
            totals = totals.where(F.col("total_qty") >= F.lit(cut))
    return totals


def jump_products(series: DataFrame, date: str = JUMP_DATE, factor: float = 2.0) -> DataFrame:
    """Mean quantity up to and after ``date``; a jump needs rows on both sides."""
    early = F.col("business_date") <= F.lit(date).cast("date")
    means = series.groupBy("product_desc").agg(
        F.avg(F.when(early, F.col("quantity_sold"))).alias("mean_before"),
        F.avg(F.when(~early, F.col("quantity_sold"))).alias("mean_after"))
    jump = F.col("mean_after") > F.lit(float(factor)) * F.col("mean_before")
    return means.withColumn("jump", F.coalesce(jump, F.lit(False)))


def cut_after_jump(series: DataFrame, date: str = JUMP_DATE, factor: float = 2.0) -> DataFrame:
    """Products that jumped lose their rows after ``date``."""
    jumped = jump_products(series, date, factor).where("jump").select("product_desc")
    early = F.col("business_date") <= F.lit(date).cast("date")
    late_of_calm = series.where(~early).join(jumped, "product_desc", "left_anti")
    return series.where(early).unionByName(late_of_calm)


def product_universe(primary: DataFrame, secondary: DataFrame, cuts: tuple[float, ...] = (0.75, 0.25, 0.75),
                     prefix: str | None = SERIES_DROP_PREFIX, names: list = SERIES_DROP_ITEMS,
                     jump_date: str = JUMP_DATE, jump_factor: float = 2.0) -> DataFrame:
    """Primary series plus the best sellers of the secondary one, unwanted names and jumps removed."""
    primary, secondary = written(primary, "primary-series"), written(secondary, "secondary-series")
    extra = secondary.join(primary.select("product_desc").distinct(), "product_desc", "left_anti")
    extra = extra.join(quantile_cascade(extra, cuts).select("product_desc"), "product_desc", "left_semi")
    both = drop_named(union_all([primary, extra]), "product_desc", prefix, names)
    return cut_after_jump(both, jump_date, jump_factor)


# A product has one row per day, so the windows below hold at most one row per calendar day.
def _by_date(keys: list[str]) -> Window:
    return Window.partitionBy(*keys).orderBy("business_date")


def with_price_lags(series: DataFrame, lags: int = 8, keys: list[str] = ["product_desc"]) -> DataFrame:
    """Prices of the previous ``lags`` rows; rows missing any value are dropped."""
    w = _by_date(keys)
    lagged = series.select("*", *[F.lag("price", k).over(w).alias(f"price_lag_{k}") for k in range(1, lags + 1)])
    return lagged.na.drop()


def with_ordinal(series: DataFrame, keys: list[str] = ["product_desc"]) -> DataFrame:
    return series.withColumn("ordinal", F.row_number().over(_by_date(keys)))


def with_split(series: DataFrame, share: float = 0.8, keys: list[str] = ["product_desc"]) -> DataFrame:
    """'train' for the first ``int(share * n)`` rows of each product in date order, 'test' after."""
    n = F.count("*").over(Window.partitionBy(*keys))
    place = F.row_number().over(_by_date(keys))
    return series.withColumn("split", F.when(place <= F.floor(n * F.lit(share)), "train").otherwise("test"))


def last_prices(series: DataFrame, n: int = 3) -> DataFrame:
    """The last ``n`` prices of each product, oldest first."""
    back = Window.partitionBy("product_desc").orderBy(F.col("business_date").desc())
    tail = series.withColumn("_r", F.row_number().over(back)).where(F.col("_r") <= n)
    ordered = F.array_sort(F.collect_list(F.struct("business_date", "price")))
    return tail.groupBy("product_desc").agg(F.transform(ordered, lambda r: r["price"]).alias("past_price"))


def calendar(spark, start: str, end: str) -> DataFrame:
    """Every date from ``start`` to ``end``."""
    days = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return spark.range(1).select(F.explode(days).alias("ds"))
