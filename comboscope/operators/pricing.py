"""Price ladders, expected sales and profit."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from comboscope.constants import OFFER_END, OFFER_START, PRICE_FLOORS, REGULAR_PRICE_OVERRIDES
from comboscope.functions.expr import half_even
from comboscope.operators.series import last_prices

PRODUCT = ["product_desc"]


def _lookup(values: dict[str, float], key):
    """A short fixed table as an expression; null for other keys."""
    out = F.lit(None).cast("double")
    for name, v in values.items():
        out = F.when(key == F.lit(name), F.lit(float(v))).otherwise(out)
    return out


def product_parameters(series: DataFrame, costs: DataFrame, cost_overrides: DataFrame | None = None,
                       regular_prices: dict[str, float] = REGULAR_PRICE_OVERRIDES) -> DataFrame:
    """Cost, regular price and last three prices per product of ``series``.

    Cost is the override, else the cost table's. The regular price is the one set by hand, else the
    cost table's, else the highest past price.
    """
    highest = series.groupBy(*PRODUCT).agg(F.max("price").alias("_highest"))
    out = highest.join(last_prices(series), PRODUCT, "left").join(
        costs.select(*PRODUCT, F.col("product_cost").alias("_cost"), F.col("retail_price").alias("_retail")), PRODUCT, "left")
    if cost_overrides is not None:
        out = out.join(cost_overrides.select(*PRODUCT, F.col("product_cost").alias("_over")), PRODUCT, "left")
    else:
        out = out.withColumn("_over", F.lit(None).cast("double"))
    by_hand = _lookup(regular_prices, F.col("product_desc"))
    return out.select(*PRODUCT, F.coalesce("_over", "_cost").alias("cost"),
                      F.coalesce(by_hand, "_retail", "_highest").alias("retail_price"), "past_price")


def price_ladder(params: DataFrame, step: float = 0.98, floors: dict[str, float] = PRICE_FLOORS) -> DataFrame:
    """Regular price and successive reductions while above cost, as (product, k, price).

    After rounding, one last price at or below the product's floor (its cost unless set) goes.
    Products whose cost is missing, not positive or not below the price have no ladder.
    """
    sellable = params.where((F.col("cost") > 0) & (F.col("retail_price") > F.col("cost")))
    steps = F.ceil(F.log(F.col("cost") / F.col("retail_price")) / F.log(F.lit(step))).cast("int")
    raw = F.transform(F.sequence(F.lit(0), F.greatest(steps, F.lit(0))), lambda k: F.col("retail_price") * F.pow(F.lit(step), k))
    above = F.filter(raw, lambda x: x > F.col("cost"))
    rounded = sellable.withColumn("_l", F.transform(above, lambda x: half_even(x)))
    floor = F.coalesce(_lookup(floors, F.col("product_desc")), F.col("cost"))
    trimmed = F.when(F.element_at("_l", -1) <= floor, F.slice("_l", 1, F.size("_l") - 1)).otherwise(F.col("_l"))
    return rounded.select(*PRODUCT, F.posexplode(trimmed).alias("k", "price"))


def without_ladder(params: DataFrame, ladder: DataFrame) -> DataFrame:
    """Products that cannot be priced, for the report."""
    return params.join(ladder.select(*PRODUCT).distinct(), PRODUCT, "left_anti")


def base_sales(params: DataFrame, ladder: DataFrame, coefs: DataFrame, time: DataFrame,
               start: str = OFFER_START, end: str = OFFER_END) -> DataFrame:
    """Expected sales per product and day before the own-price effect, with that effect's slope.

    Everything but the own price is the same for all ladder steps: constant, year, month, the
    price three days back (past prices for the first three days, the regular price after), other
    products at their regular price, and the time component. Missing coefficients are 0.
    """
    regular = ladder.where(F.col("k") == 0).select(*PRODUCT, F.col("price").alias("regular"))
    others = regular.select(F.concat("product_desc", F.lit("_price")).alias("feature"), F.col("regular").alias("_other"))
    cross = coefs.join(others, "feature").groupBy(*PRODUCT).agg(F.sum(F.col("coef") * F.col("_other")).alias("_cross"))

    def named(feature: str):
        return F.coalesce(F.max(F.when(F.col("feature") == feature, F.col("coef"))), F.lit(0.0)).alias(f"b_{feature}")

    own = coefs.groupBy(*PRODUCT).agg(*[named(f) for f in ("const", "price", "year", "month", "price_lag_3")])
    fixed = (params.join(regular, PRODUCT).join(own, PRODUCT, "left").join(cross, PRODUCT, "left").na.fill(0.0))
    days = time.where(F.col("ds").between(F.lit(start).cast("date"), F.lit(end).cast("date"))).select(*PRODUCT, "ds", "yhat")
    t = F.datediff("ds", F.lit(start))
    lag3 = F.coalesce(F.when(t < 3, F.get("past_price", t)), F.col("regular"))
    base = (F.col("b_const") + F.col("b_year") * F.year("ds") + F.col("b_month") * F.month("ds")
            + F.col("b_price_lag_3") * lag3 + F.col("_cross") + F.col("yhat"))
    return days.join(fixed, PRODUCT).select(*PRODUCT, "ds", base.alias("base"), F.col("b_price").alias("slope"), "cost")


def daily_profit(base: DataFrame, ladder: DataFrame) -> DataFrame:
    """Expected sales and profit per product, day and ladder step."""
    sales = F.col("base") + F.col("slope") * F.col("price")
    return base.join(ladder, PRODUCT).select(*PRODUCT, "ds", "k", "price", sales.alias("sales"),
                                             ((F.col("price") - F.col("cost")) * sales).alias("profit"))


def period_profit(base: DataFrame, ladder: DataFrame, period) -> DataFrame:
    """Profit per product, period and ladder step.

    Sales are linear in the price, so a period's days are summed before meeting the ladder and the
    day-by-step table is never built.
    """
    sums = base.groupBy(*PRODUCT, period.alias("period"), "slope", "cost").agg(F.sum("base").alias("_b"), F.count("*").alias("_n"))
    profit = (F.col("price") - F.col("cost")) * (F.col("_b") + F.col("_n") * F.col("slope") * F.col("price"))
    return sums.join(ladder, PRODUCT).select(*PRODUCT, "period", "k", "price", profit.alias("profit"))


def monthly_profit(base: DataFrame, ladder: DataFrame) -> DataFrame:
    return period_profit(base, ladder, F.month("ds"))


def block_profit(base: DataFrame, ladder: DataFrame, start: str = OFFER_START, days: int = 30) -> DataFrame:
    """Profit per block of ``days`` days, numbered from 0."""
    return period_profit(base, ladder, F.floor(F.datediff("ds", F.lit(start)) / days).cast("int"))


def objective_scale(profits: DataFrame, pairs: DataFrame, max_size: int, zero_fill: bool = False) -> float:
    """Best total profit over the largest total affinity: the weight of one unit of correlation.

    ``zero_fill`` counts levels a shorter ladder lacks as profit 0, so its best is at least 0.
    """
    best = profits.groupBy(*PRODUCT, "period").agg(F.max("profit").alias("best"), F.max("k").alias("top"))
    if zero_fill:
        longest = profits.agg(F.max("k")).first()[0]
        best = best.withColumn("best", F.when(F.col("top") < F.lit(longest), F.greatest("best", F.lit(0.0))).otherwise(F.col("best")))
    total, periods = best.agg(F.sum("best"), F.countDistinct("period")).first()
    corr = pairs.agg(F.max("corr")).first()[0]
    if not corr or not periods or total is None:  # no affinity to weigh
        return 0.0
    return total / (periods * (max_size * (max_size - 1) / 2) * corr)
