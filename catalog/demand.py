"""Demand model queries."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from catalog.elasticity import _project_out, coarse_series
from catalog.registry import query, r
from catalog.views import items, table, with_views
from comboscope.functions.storage import written
from comboscope.operators import correlation, demand, linreg, series

EDGES = """
    , pairs AS (SELECT a.product_desc AS item_a, b.product_desc AS item_b, corr(a.quantity_sold, b.quantity_sold) AS corr
        FROM series_coarse a JOIN series_coarse b ON a.business_date = b.business_date AND a.product_desc < b.product_desc GROUP BY 1, 2),
    edges AS (SELECT item_a AS product_desc, item_b AS other FROM pairs WHERE abs(corr) > 0.04
        UNION ALL SELECT item_b, item_a FROM pairs WHERE abs(corr) > 0.04)"""


def coarse_edges(sales):
    return correlation.correlated_products(correlation.quantity_correlations(sales, min_abs=0.04), 0.04)


@query("cross_price_features", with_views("items series_coarse", EDGES + """
    SELECT s.product_desc, s.business_date, e.other, ROUND(o.price, 6) AS other_price FROM series_coarse s
    JOIN edges e ON e.product_desc = s.product_desc LEFT JOIN series_coarse o ON o.product_desc = e.other AND o.business_date = s.business_date"""))
def cross_price_features(spark, sf):
    sales = written(coarse_series(spark, sf), "sales")
    return demand.cross_prices(sales, sales, coarse_edges(sales)).withColumn("other_price", r("other_price"))


LAGGED = """
    , l AS (SELECT product_desc, business_date, quantity_sold, price, YEAR(business_date)::DOUBLE AS year,
        MONTH(business_date)::DOUBLE AS month, LAG(price, 3) OVER w AS price_lag_3, LAG(price, 8) OVER w AS l8
        FROM series_fine WINDOW w AS (PARTITION BY product_desc ORDER BY business_date)),
    rows8 AS (SELECT * FROM l WHERE l8 IS NOT NULL)"""


def _fwl() -> str:
    xs = ["year", "month", "price_lag_3"]
    out = ", g0 AS (SELECT product_desc, 0 AS wk_year, 0 AS wk_month, 0 AS week_of_year, price, quantity_sold, year, month, price_lag_3 FROM rows8)"
    for i, x in enumerate(xs):
        out += ",\n" + _project_out(f"g{i + 1}", f"g{i}", [x], [*xs[i + 1:], "price", "quantity_sold"])
    return out


def no_edges(spark):
    return spark.createDataFrame([], "product_desc string, other string")


@query("demand_price_effect", with_views("items series_fine", LAGGED + _fwl() + """
    SELECT product_desc, ROUND(regr_slope(quantity_sold, price) * 1000, 5) AS price_effect FROM g3 GROUP BY 1"""))
def demand_price_effect(spark, sf):
    table, names = demand.demand_features(series.daily_series(items(spark, sf, "fine")), no_edges(spark))
    fits = demand.fit_demand(table.withColumn("split", F.lit("train")), names)
    own = linreg.coefficients(fits, ["product_desc"], "names").where(F.col("feature") == "price")
    return own.select("product_desc", r(F.col("coef") * 1000, 5).alias("price_effect"))


@query("demand_feature_rows", with_views("items series_fine", LAGGED + """
    SELECT product_desc, business_date, quantity_sold, ROUND(price, 6) AS price, year, month, ROUND(price_lag_3, 6) AS price_lag_3 FROM rows8"""))
def demand_feature_rows(spark, sf):
    table, _ = demand.demand_features(series.daily_series(items(spark, sf, "fine")), no_edges(spark))
    x = F.col("x")
    return table.select("product_desc", "business_date", "quantity_sold", F.round(x[0], 6).alias("price"), x[1].alias("year"),
                        x[2].alias("month"), F.round(x[3], 6).alias("price_lag_3"))


#: Some products lack a price, or have an infinite one, on the 7th or 13th when those sell 37 or 41 pieces.
_GAPS = """, series_gap AS (SELECT business_date, product_desc, quantity_sold,
    CASE WHEN quantity_sold = 37 AND day(business_date) = 7 THEN NULL WHEN quantity_sold = 41 AND day(business_date) = 13 THEN 'inf'::DOUBLE ELSE price END AS price FROM series_fine)"""


@query("complete_regressors", with_views("items series_fine", _GAPS + """
    , l AS (SELECT product_desc, price, LAG(price, 3) OVER w AS price_lag_3, COUNT(price) OVER (w ROWS BETWEEN 8 PRECEDING AND CURRENT ROW) AS known
        FROM series_gap WINDOW w AS (PARTITION BY product_desc ORDER BY business_date)), rows8 AS (SELECT * FROM l WHERE known = 9)
    SELECT product_desc, CASE WHEN bool_and(coalesce(isfinite(price), false)) THEN 'price;' ELSE '' END || 'year;month' ||
        CASE WHEN bool_and(coalesce(isfinite(price_lag_3), false)) THEN ';price_lag_3' ELSE '' END AS regressors FROM rows8 GROUP BY 1"""))
def complete_regressors(spark, sf):
    """The regressors that each product keeps: those finite on all of its days that have a price and eight before it."""
    sold, day = F.col("quantity_sold"), F.dayofmonth("business_date")
    price = F.when((sold == 37) & (day == 7), F.lit(None)).when((sold == 41) & (day == 13), F.lit(float("inf"))).otherwise(F.col("price"))
    _, names = demand.demand_features(series.daily_series(items(spark, sf, "fine")).withColumn("price", price), no_edges(spark))
    return names.select("product_desc", F.array_join("names", ";").alias("regressors"))


def _partial_out(xs: list[str], source: str, targets: list[str]) -> str:
    """SQL that takes each of ``xs`` in turn out of the later ones and of ``targets``, per product; columns without spread do nothing."""
    out = f", g0 AS (SELECT product_desc, {', '.join([*xs, *targets])} FROM {source})"
    for i, z in enumerate(xs):
        cols = ", ".join(f"{c} - AVG({c}) OVER g - COALESCE(regr_slope({c}, {z}) OVER g, 0) * ({z} - AVG({z}) OVER g) AS {c}" for c in [*xs[i + 1:], *targets])
        out += f",\n g{i + 1} AS (SELECT product_desc, {cols} FROM g{i} WINDOW g AS (PARTITION BY product_desc))"
    return out


#: Series by month, in which the two best correlated others have a price on all of a product's months.
MONTHLY_CROSS = """
    , monthly AS (SELECT product_desc, CAST(date_trunc('month', business_date) AS DATE) AS business_date, SUM(quantity_sold) AS quantity_sold, AVG(price) AS price
        FROM series_coarse GROUP BY 1, 2),
    mpairs AS (SELECT a.product_desc AS item_a, b.product_desc AS item_b, corr(a.quantity_sold, b.quantity_sold) AS corr
        FROM monthly a JOIN monthly b ON a.business_date = b.business_date AND a.product_desc < b.product_desc GROUP BY 1, 2),
    two AS (SELECT item_a AS product_desc, item_b AS other, corr FROM mpairs UNION ALL SELECT item_b, item_a, corr FROM mpairs),
    top AS (SELECT product_desc, other, ROW_NUMBER() OVER (PARTITION BY product_desc ORDER BY abs(corr) DESC, other) AS place FROM two WHERE corr IS NOT NULL),
    ml AS (SELECT *, LAG(price, 3) OVER w AS price_lag_3, LAG(price, 8) OVER w AS l8 FROM monthly WINDOW w AS (PARTITION BY product_desc ORDER BY business_date)),
    mrows AS (SELECT ml.product_desc, ml.business_date, ml.quantity_sold, ml.price, YEAR(ml.business_date)::DOUBLE AS year, MONTH(ml.business_date)::DOUBLE AS month, price_lag_3,
        o1.price AS p1, o2.price AS p2 FROM ml LEFT JOIN top t1 ON t1.product_desc = ml.product_desc AND t1.place = 1
        LEFT JOIN top t2 ON t2.product_desc = ml.product_desc AND t2.place = 2
        LEFT JOIN monthly o1 ON o1.product_desc = t1.other AND o1.business_date = ml.business_date
        LEFT JOIN monthly o2 ON o2.product_desc = t2.other AND o2.business_date = ml.business_date WHERE l8 IS NOT NULL),
    full_rows AS (SELECT * REPLACE (CASE WHEN COUNT(p1) OVER p = COUNT(*) OVER p THEN p1 ELSE 0 END AS p1, CASE WHEN COUNT(p2) OVER p = COUNT(*) OVER p THEN p2 ELSE 0 END AS p2)
        FROM mrows WINDOW p AS (PARTITION BY product_desc))"""


def monthly_cross(spark, sf):
    """The monthly series and its two best correlated others per product."""
    sales = coarse_series(spark, sf)
    sales = written(sales.groupBy("product_desc", F.trunc("business_date", "month").alias("business_date")).agg(
        F.sum("quantity_sold").alias("quantity_sold"), F.avg("price").alias("price")), "monthly-sales")
    pairs = correlation.both_ways(correlation.quantity_correlations(sales)).where(~F.isnan("corr"))
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.abs("corr").desc(), "other"))
    return sales, pairs.withColumn("place", place).where("place <= 2").select(F.col("item").alias("product_desc"), "other")


@query("demand_price_effect_cross", with_views("items series_coarse", MONTHLY_CROSS + _partial_out(["year", "month", "price_lag_3", "p1", "p2"], "full_rows", ["price", "quantity_sold"]) + """
    SELECT product_desc, ROUND(regr_slope(quantity_sold, price), 5) AS price_effect FROM g5 GROUP BY 1"""))
def demand_price_effect_cross(spark, sf):
    table, names = demand.demand_features(*monthly_cross(spark, sf))
    fits = demand.fit_demand(table.withColumn("split", F.lit("train")), names)
    own = linreg.coefficients(fits, ["product_desc"], "names").where(F.col("feature") == "price")
    return own.select("product_desc", r("coef", 5).alias("price_effect"))


@query("ols_or_ridge", """
    WITH l AS (SELECT l_partkey AS product_key, l_quantity AS y, CASE WHEN l_discount = 0 THEN 'inf'::DOUBLE ELSE 1 / l_discount::DOUBLE END AS x FROM lineitem),
    f AS (SELECT product_key, COUNT(*) FILTER (isinf(x)) AS bad, COUNT(*) FILTER (NOT isinf(x)) AS n, regr_slope(y, x) FILTER (NOT isinf(x)) AS slope,
        regr_sxy(y, x) FILTER (NOT isinf(x)) AS sxy, regr_sxx(y, x) FILTER (NOT isinf(x)) AS sxx, MIN(x) AS lo, MAX(x) FILTER (NOT isinf(x)) AS hi FROM l GROUP BY 1)
    SELECT product_key, CASE WHEN bad > 0 THEN 'ridge' ELSE 'ols' END AS method, n, ROUND(CASE WHEN bad > 0 THEN sxy / (sxx + 50) ELSE slope END, 6) AS slope
    FROM f WHERE lo < hi""")
def ols_or_ridge(spark, sf):
    x = F.when(F.col("l_discount") == 0, F.lit(float("inf"))).otherwise(F.try_divide(F.lit(1.0), F.col("l_discount").cast("double")))
    lines = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("product_key"), F.col("l_quantity").alias("y"), x.alias("x"))
    spread = lines.where(F.col("x") < float("inf")).groupBy("product_key").agg(F.min("x").alias("lo"), F.max("x").alias("hi")).where("lo < hi")
    fits = linreg.grouped_fit(lines, ["product_key"], "y", ["x"], "auto", lam=50.0)
    return fits.join(spread, "product_key", "left_semi").select("product_key", "method", "n", r(F.col("fit.coef")[0]).alias("slope"))


@query("own_price_errors", with_views("items series_fine", """
    , f AS (SELECT product_desc, regr_slope(quantity_sold, price) AS b, regr_intercept(quantity_sold, price) AS a FROM series_fine GROUP BY 1),
    e AS (SELECT product_desc, quantity_sold AS y, quantity_sold - a - b * price AS d FROM series_fine JOIN f USING (product_desc))
    SELECT product_desc, ROUND(AVG(d * d), 6) AS mse, ROUND(sqrt(AVG(d * d)), 6) AS rmse, ROUND(AVG(abs(d / y)) * 100, 6) AS mape FROM e GROUP BY 1"""))
def own_price_errors(spark, sf):
    return errors(spark, sf).select("product_desc", r("mse"), r("rmse"), r("mape"))


def errors(spark, sf):
    sales = series.daily_series(items(spark, sf, "fine"))
    rows = linreg.with_residuals(sales, ["product_desc"], "quantity_sold", ["price"])
    return demand.error_metrics(rows.withColumn("fit_value", F.col("quantity_sold") - F.col("residuals")), "quantity_sold", "fit_value")


ERRORS = """
    , f AS (SELECT product_desc, regr_slope(quantity_sold, price) AS b, regr_intercept(quantity_sold, price) AS a FROM series_fine GROUP BY 1),
    e AS (SELECT product_desc, quantity_sold AS y, quantity_sold - a - b * price AS d FROM series_fine JOIN f USING (product_desc)),
    m AS (SELECT product_desc, AVG(d * d) AS mse, sqrt(AVG(d * d)) AS rmse, AVG(abs(d / y)) * 100 AS mape FROM e GROUP BY 1)"""


@query("average_errors", with_views("items series_fine", ERRORS + """
    SELECT ROUND(AVG(mse), 6) AS avg_mse, ROUND(AVG(rmse), 6) AS avg_rmse FROM m"""))
def average_errors(spark, sf):
    return demand.average_metrics(errors(spark, sf)).select(r("avg_mse"), r("avg_rmse"))


@query("best_products", with_views("items series_fine", ERRORS + """
    SELECT product_desc, ROUND(mse, 6) AS mse, ROUND(rmse, 6) AS rmse, ROUND(mape, 6) AS mape FROM (
        (SELECT * FROM m ORDER BY mse, product_desc LIMIT 6) UNION (SELECT * FROM m ORDER BY rmse, product_desc LIMIT 6)
        UNION (SELECT * FROM m ORDER BY mape, product_desc LIMIT 6))"""))
def best_products(spark, sf):
    return demand.best_products(errors(spark, sf)).select("product_desc", r("mse"), r("rmse"), r("mape"))


@query("demand_fit")
def demand_fit(spark, sf):
    sales = written(coarse_series(spark, sf), "sales")
    return demand.demand_model(sales, coarse_edges(sales), steps=0)["coefs"].select("product_desc", "feature", r("coef"))


@query("demand_metrics")
def demand_metrics(spark, sf):
    sales = written(coarse_series(spark, sf), "sales")
    out = demand.demand_model(sales, coarse_edges(sales), purpose="demo")["metrics"]
    return out.select("product_desc", "split", r("mse"), r("rmse"), r("mape"))


@query("demand_log_ar_metrics")
def demand_log_ar_metrics(spark, sf):
    sales = written(coarse_series(spark, sf), "sales")
    out = demand.demand_model(sales, coarse_edges(sales), purpose="demo", link="log", time="ar")["metrics"]
    return out.select("product_desc", "split", r("mse"), r("rmse"), r("mape"))


@query("real_and_predicted")
def real_and_predicted(spark, sf):
    sales = written(coarse_series(spark, sf), "sales")
    out = demand.demand_model(sales, coarse_edges(sales), purpose="demo")["fitted"]
    return out.select("product_desc", "business_date", "split", "quantity_sold", r("predicted"))


@query("forecast")
def forecast(spark, sf):
    sales = written(coarse_series(spark, sf), "sales")
    return demand.demand_model(sales, coarse_edges(sales), steps=257, mode="additive")["time"].where("future").select("product_desc", "ds", r("yhat"))


@query("forecast_multiplicative")
def forecast_multiplicative(spark, sf):
    sales = written(coarse_series(spark, sf), "sales")
    out = demand.demand_model(sales, coarse_edges(sales), steps=257)["time"]
    return out.where("future").select("product_desc", "ds", r("yhat"))
