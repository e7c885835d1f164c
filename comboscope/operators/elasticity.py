"""Price elasticity per product and per category and label."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from comboscope.functions.expr import category_key, half_even, monday_week, week_start
from comboscope.functions.storage import written
from comboscope.operators.correlation import choose_competitors, price_correlations, time_keys
from comboscope.operators.linreg import coefficients, grouped_fit, ridge_cv, with_residuals

LAMBDAS = [float(v) for v in np.logspace(-3, 2, 20)]
ITEM = ["category", "product_desc"]


def with_week_calendar(sales: DataFrame) -> DataFrame:
    """Category key, calendar year and month, and the week each date belongs to."""
    return (sales.withColumn("category", category_key("category_desc"))
            .withColumn("year", F.year("business_date")).withColumn("month", F.month("business_date"))
            .withColumn("week", monday_week("business_date")).withColumn("week_start", week_start("business_date"))
            .withColumn("week_of_year", monday_week("week_start"))
            .withColumn("wk_year", F.year("week_start")).withColumn("wk_month", F.month("week_start")))


def in_years(sales: DataFrame, years: list[int] | None, time: str = "W") -> DataFrame:
    year = "wk_year" if time == "W" else "year"
    return sales if years is None else sales.where(F.col(year).isin(list(years)))


def coverage(sales: DataFrame, presence: int = 4, time: str = "W") -> DataFrame:
    """Share of periods in which an item has more than ``presence`` rows, to two decimals."""
    if time == "W":
        period = F.col("week_start")
    else:
        period = F.col("year") * 12 + F.col("month")
    counts = written(sales.groupBy("item_id", period.alias("period")).agg(F.count("*").alias("rows")), "presence")
    if time == "W":
        span = counts.agg((F.datediff(F.max("period"), F.min("period")) / 7).cast("int")).first()[0] or 0
    else:
        # months are counted from January of the first year, starting at 1
        last, first = counts.agg(F.max("period"), F.min("period")).first()
        span = 0 if last is None else last - ((first - 1) // 12) * 12
    present = F.count_if(F.col("rows") > presence)
    share = half_even(present / F.lit(float(span))) if span else F.when(present > 0, F.lit(math.inf))
    return counts.groupBy("item_id").agg(present.alias("periods"), share.alias("coverage"))


def covered_sales(sales: DataFrame, years: list[int] | None = None, presence: int = 4, threshold: float = 0.8,
                  time: str = "W") -> DataFrame:
    """Sales of the chosen years without the items whose coverage is below ``threshold``."""
    chosen = in_years(sales, years, time)
    masked = coverage(chosen, presence, time).where(F.col("coverage") < threshold).select("item_id")
    return chosen.join(masked, "item_id", "left_anti")


def remaining_items(sales: DataFrame) -> DataFrame:
    return sales.groupBy("category", "label").agg(F.countDistinct("item_id").alias("items"))


def log_sales(sales: DataFrame, time: str = "W", level: str = "product") -> DataFrame:
    """log1p of quantity and of the revenue-weighted price per item and period."""
    keys = ["category", "brand", *(["product_desc"] if level == "product" else []), *time_keys(time)]
    sums = sales.groupBy(*keys).agg(F.sum("quantity_sold").alias("q"),
                                    F.sum(F.col("price") * F.col("quantity_sold")).alias("revenue"))
    return sums.select(*keys, F.log1p("q").alias("log_qty"), F.log1p(F.try_divide("revenue", "q")).alias("log_price"))


def product_weights(sales: DataFrame) -> DataFrame:
    """Each product's share of its category and label's quantity."""
    sold = sales.groupBy("category", "label", "brand", "product_desc").agg(F.sum("quantity_sold").alias("quantity_sold"))
    totals = sales.groupBy("category", "label").agg(F.sum("quantity_sold").alias("total"))
    return (sold.join(totals, ["category", "label"])
            .withColumn("weight", F.try_divide("quantity_sold", "total")).drop("total"))


def with_seasons(logs: DataFrame, time: str = "W") -> tuple[DataFrame, list[str]]:
    """Year and sine/cosine season columns, and their names."""
    time_keys(time)

    def wave(f, column: str, length: int):
        return f(F.lit(2 * math.pi) * F.col(column) / F.lit(length))

    if time == "M":
        return (logs.withColumn("sin_month", wave(F.sin, "month", 12)).withColumn("cos_month", wave(F.cos, "month", 12)),
                ["year", "sin_month", "cos_month"])
    out = (logs.withColumn("sin_week", wave(F.sin, "week_of_year", 52)).withColumn("cos_week", wave(F.cos, "week_of_year", 52))
           .withColumn("sin_month", wave(F.sin, "wk_month", 12)).withColumn("cos_month", wave(F.cos, "wk_month", 12)))
    return out, ["wk_year", "sin_week", "cos_week", "sin_month", "cos_month"]


def seasonal_residuals(logs: DataFrame, time: str = "W", group: list[str] = ITEM) -> DataFrame:
    """log_qty with year and season regressed out of each product's series."""
    missing = [k for k in time_keys(time) if k not in logs.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    seasoned, names = with_seasons(logs, time)
    return with_residuals(seasoned, group, "log_qty", names).select(*logs.columns, "residuals")


def winsorize(df: DataFrame, columns: list[str], share: float = 0.05, group: list[str] = ITEM) -> DataFrame:
    """Each tail of ``int(share * n)`` values pulled in to the nearest value left, per group.

    Groups are series with one row per period.
    """
    whole = Window.partitionBy(*group)
    for c in columns:
        place = F.row_number().over(whole.orderBy(F.col(c).asc_nulls_last()))
        ranked = df.withColumn("_r", place).withColumn("_n", F.count(c).over(whole))
        cut = F.floor(F.lit(share) * F.col("_n"))
        low = F.max(F.when(F.col("_r") == cut + 1, F.col(c))).over(whole)
        high = F.max(F.when(F.col("_r") == F.col("_n") - cut, F.col(c))).over(whole)
        df = (ranked.withColumn("_lo", low).withColumn("_hi", high)
              .withColumn(c, F.when(F.col(c).isNotNull(), F.greatest(F.least(c, "_hi"), "_lo")))
              .drop("_r", "_n", "_lo", "_hi"))
    return df


def with_competitor_prices(rows: DataFrame, logs: DataFrame, competitors: DataFrame, slots: int = 3, time: str = "W",
                           level: str = "product") -> tuple[DataFrame, list[str]]:
    """Log price of each competitor in the same period, one column per slot, null when not sold.

    Slots a product does not use are 0, which carries no weight in a regression; ``n_competitors``
    tells how many are in use.
    """
    ident = "brand" if level == "brand" else "product_desc"
    keys = time_keys(time)
    prices = logs.select("category", *keys, F.col(ident).alias("competitor"), F.col("log_price").alias("_p"))
    offered = competitors.select("category", F.col("item").alias(ident), "slot", "competitor")
    at = offered.join(prices, ["category", "competitor"]).groupBy("category", ident, *keys).agg(
        *[F.max(F.when(F.col("slot") == k, F.col("_p"))).alias(f"log_price_competitor_{k}") for k in range(1, slots + 1)])
    counts = offered.groupBy("category", ident).agg(F.count("*").alias("n_competitors"))
    out = (rows.join(counts, ["category", ident], "left").na.fill(0, ["n_competitors"])
           .join(at, ["category", ident, *keys], "left"))
    names = [f"log_price_competitor_{k}" for k in range(1, slots + 1)]
    for k, name in enumerate(names, 1):
        out = out.withColumn(name, F.when(F.col("n_competitors") >= k, F.col(name)).otherwise(F.lit(0.0)))
    return out, names


def product_elasticities(rows: DataFrame, regressors: list[str], method: str = "ols", time: str = "W",
                         winsor: float | None = 0.05, lambdas: list[float] = LAMBDAS, group: list[str] = ITEM) -> DataFrame:
    """Elasticity of each product: slope of residual log quantity on its own log price.

    ``regressors`` starts with the own price. A product with fewer complete rows than regressors
    in use plus two gets a null result.
    """
    if "n_competitors" not in rows.columns:
        rows = rows.withColumn("n_competitors", F.lit(len(regressors) - 1))
    products = rows.groupBy(*group).agg(F.max("n_competitors").alias("n_competitors"))
    if winsor:
        rows = winsorize(rows, ["log_price", "residuals"], winsor, group)
    complete = rows.na.drop(subset=["residuals", *regressors])
    enough = (F.col("n") >= F.col("n_competitors") + 3) & (F.col("n") >= 3)
    if method == "ols":
        fits = grouped_fit(complete, group, "residuals", regressors).join(products, group).where(enough)
        own = coefficients(fits, group, regressors).where(F.col("feature") == regressors[0])
        out = own.select(*group, F.col("coef").alias("elasticity"), F.col("t").alias("t"), F.col("p").alias("p_value"),
                         F.coalesce(F.col("p") <= 0.05, F.lit(False)).alias("significant"))
        return products.select(*group).join(out, group, "left").na.fill(False, ["significant"])
    if method not in ("ridge", "ridge_debias"):
        raise ValueError("method must be 'ols', 'ridge' or 'ridge_debias'")
    counted = complete.groupBy(*group).agg(F.count("*").alias("n")).join(products, group).where(enough).select(*group)
    slope = "slope" if method == "ridge" else "slope_debiased"
    chosen = ridge_cv(complete.join(counted, group, "left_semi"), group, "residuals", regressors, time_keys(time), lambdas)
    return products.select(*group).join(chosen.select(*group, F.col(slope).alias("elasticity"), F.col("lam").alias("alpha")), group, "left")


def weighted_elasticity(weights: DataFrame, elasticities: DataFrame) -> DataFrame:
    """Weighted elasticity and product count per category and label; missing ones add nothing.

    A product has one elasticity, that of its first category, which counts wherever it is sold.
    """
    first = elasticities
    if "category" in elasticities.columns:
        first = elasticities.groupBy("product_desc").agg(F.min(F.struct("category", "elasticity")).alias("_first")).select("product_desc", "_first.elasticity")
    joined = weights.join(first.select("product_desc", "elasticity"), "product_desc", "left")
    return joined.groupBy("category", "label").agg(
        F.coalesce(F.sum(F.col("weight") * F.col("elasticity")), F.lit(0.0)).alias("weighted_elasticity"),
        F.countDistinct("product_desc").alias("products"))


def elasticity_tables(sales: DataFrame, years: list[int] | None = [2022, 2023, 2024], presence: int = 4,
                      threshold: float = 0.8, time: str = "W", min_corr: float = 0.2, max_inter_corr: float = 0.9,
                      method: str = "ols", winsor: float | None = 0.05) -> tuple[DataFrame, DataFrame]:
    """The whole study: (elasticity per product, weighted elasticity per category and label)."""
    dated = written(with_week_calendar(sales), "dated-sales")
    kept = written(covered_sales(dated, years, presence, threshold, time), "covered-sales")
    logs = written(log_sales(kept, time), "log-sales")
    competitors = choose_competitors(price_correlations(logs, "product", time, min_corr), 3, min_corr, max_inter_corr)
    rows, names = with_competitor_prices(seasonal_residuals(logs, time), logs, competitors, 3, time)
    each = written(product_elasticities(rows, ["log_price", *names], method, time, winsor), "elasticities")
    return each, weighted_elasticity(product_weights(kept), each)
