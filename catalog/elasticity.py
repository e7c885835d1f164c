"""Correlation, regression and elasticity queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query, r
from catalog.views import brand_number, items, with_views
from comboscope.functions.storage import written
from comboscope.operators import correlation, elasticity, linreg, series


def coarse_series(spark, sf):
    return series.daily_series(items(spark, sf, "coarse"))


@query("corr_ordinal", with_views("items series_coarse", """
    , p AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY product_desc ORDER BY business_date) AS o FROM series_coarse),
    cap AS (SELECT COUNT(*) AS n FROM p WHERE product_desc = (SELECT product_desc FROM p ORDER BY business_date, product_desc LIMIT 1)),
    k AS (SELECT p.* FROM p, cap WHERE o <= n)
    SELECT a.product_desc AS item_a, b.product_desc AS item_b, ROUND(corr(a.quantity_sold, b.quantity_sold), 9) AS corr, COUNT(*) AS n
    FROM k a JOIN k b ON a.o = b.o AND a.product_desc < b.product_desc GROUP BY 1, 2"""))
def corr_ordinal(spark, sf):
    return correlation.quantity_correlations(coarse_series(spark, sf), "ordinal").withColumn("corr", r("corr", 9))


@query("corr_by_date", with_views("items series_fine", """
    SELECT a.product_desc AS item_a, b.product_desc AS item_b, CASE WHEN NOT isnan(corr(a.quantity_sold, b.quantity_sold)) THEN ROUND(corr(a.quantity_sold, b.quantity_sold), 7) END AS corr, COUNT(*) AS n
    FROM series_fine a JOIN series_fine b ON a.business_date = b.business_date AND a.product_desc < b.product_desc GROUP BY 1, 2"""))
def corr_by_date(spark, sf):
    out = correlation.quantity_correlations(series.daily_series(items(spark, sf, "fine")))
    return out.withColumn("corr", r("corr", 7)).where("n > 0")


@query("corr_edges", with_views("items series_coarse", """

    SELECT a.product_desc, b.product_desc AS other, ROUND(corr(a.quantity_sold, b.quantity_sold), 9) AS corr
    FROM series_coarse a JOIN series_coarse b ON a.business_date = b.business_date AND a.product_desc <> b.product_desc GROUP BY 1, 2
    HAVING abs(corr(a.quantity_sold, b.quantity_sold)) > 0.04"""))
def corr_edges(spark, sf):
    pairs = correlation.quantity_correlations(coarse_series(spark, sf), min_abs=0.04)
    return correlation.correlated_products(pairs, 0.04).withColumn("corr", r("corr", 9))


WEEKS = """
    , cal AS (SELECT *, CAST(date_trunc('week', business_date) AS DATE) AS week_start,
        'CAT_' || (CAST(split_part(product_desc, '#', 2) AS INTEGER) % 5) AS category, product_desc AS brand,
        CASE WHEN CAST(split_part(product_desc, '#', 2) AS INTEGER) % 4 = 0 THEN 'private' ELSE 'national' END AS label
        FROM series_coarse),
    wk AS (SELECT *, YEAR(week_start) AS wk_year, MONTH(week_start) AS wk_month,
        CAST(strftime(week_start, '%W') AS INTEGER) AS week_of_year, YEAR(business_date) AS year, MONTH(business_date) AS month FROM cal),
    logs AS (SELECT category, product_desc, wk_year, wk_month, week_of_year, ln(1 + SUM(quantity_sold)) AS log_qty,
        ln(1 + SUM(price * quantity_sold) / SUM(quantity_sold)) AS log_price FROM wk GROUP BY ALL)"""


def labelled(spark, sf):
    """Brand-level daily sales with category, brand and label."""
    bn = brand_number(F.col("product_desc"))
    return (coarse_series(spark, sf).withColumn("item_id", F.col("product_desc"))
            .withColumn("brand", F.col("product_desc"))
            .withColumn("category_desc", F.concat(F.lit("CAT "), (bn % 5).cast("string"), F.lit("-C")))
            .withColumn("label", F.when(bn % 4 == 0, "private").otherwise("national")))


def weekly(spark, sf):
    return elasticity.log_sales(elasticity.with_week_calendar(labelled(spark, sf)))


def stored_weekly(spark, sf):
    """Weekly logs for queries that read them more than once."""
    return written(weekly(spark, sf), "log-sales")


@query("weighted_logs", with_views("items series_coarse", WEEKS + """
    SELECT category, product_desc, wk_year, wk_month, week_of_year, ROUND(log_qty, 9) AS log_qty,
        ROUND(log_price, 9) AS log_price FROM logs"""))
def weighted_logs(spark, sf):
    return weekly(spark, sf).drop("brand").withColumn("log_qty", r("log_qty", 9)).withColumn("log_price", r("log_price", 9))


@query("weighted_logs_monthly_brand", with_views("items series_coarse", WEEKS + """
    SELECT category, brand, year, month, ROUND(ln(1 + SUM(quantity_sold)), 9) AS log_qty,
        ROUND(ln(1 + SUM(price * quantity_sold) / SUM(quantity_sold)), 9) AS log_price FROM wk GROUP BY 1, 2, 3, 4"""))
def weighted_logs_monthly_brand(spark, sf):
    out = elasticity.log_sales(elasticity.with_week_calendar(labelled(spark, sf)), "M", "brand")
    return out.withColumn("log_qty", r("log_qty", 9)).withColumn("log_price", r("log_price", 9))


@query("corr_weekly_price", with_views("items series_coarse", WEEKS + """
    SELECT a.category, a.product_desc AS item_a, b.product_desc AS item_b, ROUND(corr(a.log_price, b.log_price), 8) AS corr, COUNT(*) AS n
    FROM logs a JOIN logs b USING (category, wk_year, wk_month, week_of_year) WHERE a.product_desc < b.product_desc GROUP BY 1, 2, 3"""))
def corr_weekly_price(spark, sf):
    return correlation.price_correlations(weekly(spark, sf)).withColumn("corr", r("corr", 8))


@query("corr_monthly_price", with_views("items series_coarse", WEEKS + """
    , m AS (SELECT category, brand, year, month, ln(1 + SUM(price * quantity_sold) / SUM(quantity_sold)) AS log_price
        FROM wk GROUP BY 1, 2, 3, 4)
    SELECT a.category, a.brand AS item_a, b.brand AS item_b, ROUND(corr(a.log_price, b.log_price), 8) AS corr, COUNT(*) AS n
    FROM m a JOIN m b USING (category, year, month) WHERE a.brand < b.brand GROUP BY 1, 2, 3"""))
def corr_monthly_price(spark, sf):
    logs = elasticity.log_sales(elasticity.with_week_calendar(labelled(spark, sf)), "M", "brand")
    return correlation.price_correlations(logs, "brand", "M").withColumn("corr", r("corr", 8))


COVER = """
    , y AS (SELECT * FROM wk WHERE wk_year IN (1996, 1997, 1998)),
    c AS (SELECT product_desc AS item_id, week_start, COUNT(*) AS n FROM y GROUP BY 1, 2),
    s AS (SELECT (MAX(week_start) - MIN(week_start)) / 7 AS span FROM c),
    cov AS (SELECT item_id, COUNT(*) FILTER (n > 3) AS periods, round_even(COUNT(*) FILTER (n > 3) / ANY_VALUE(span) * 100, 0) / 100 AS coverage
        FROM c, s GROUP BY 1)"""


@query("coverage_mask", with_views("items series_coarse", WEEKS + COVER + "SELECT * FROM cov"))
def coverage_mask(spark, sf):
    chosen = elasticity.in_years(elasticity.with_week_calendar(labelled(spark, sf)), [1996, 1997, 1998])
    return elasticity.coverage(chosen, 3)


@query("coverage_mask_monthly", with_views("items series_coarse", WEEKS + """
    , c AS (SELECT product_desc AS item_id, year, month, COUNT(*) AS n FROM wk WHERE year IN (1996, 1997, 1998) GROUP BY 1, 2, 3),
    s AS (SELECT MAX((year - y0) * 12 + month) AS span FROM c, (SELECT MIN(year) AS y0 FROM c))
    SELECT item_id, COUNT(*) FILTER (n > 12) AS periods, round_even(COUNT(*) FILTER (n > 12) / ANY_VALUE(span) * 100, 0) / 100 AS coverage
    FROM c, s GROUP BY 1"""))
def coverage_mask_monthly(spark, sf):
    chosen = elasticity.in_years(elasticity.with_week_calendar(labelled(spark, sf)), [1996, 1997, 1998], "M")
    return elasticity.coverage(chosen, 12, "M")


@query("remaining_items", with_views("items series_coarse", WEEKS + COVER + """
    SELECT category, label, COUNT(DISTINCT product_desc) AS items FROM y
    WHERE product_desc IN (SELECT item_id FROM cov WHERE coverage >= 0.75) GROUP BY 1, 2"""))
def remaining_items(spark, sf):
    sales = elasticity.with_week_calendar(labelled(spark, sf))
    return elasticity.remaining_items(elasticity.covered_sales(sales, [1996, 1997, 1998], 3, 0.75))


@query("product_weights", with_views("items series_coarse", WEEKS + """
    SELECT category, label, brand, product_desc, SUM(quantity_sold) AS quantity_sold,
        ROUND(SUM(quantity_sold) / SUM(SUM(quantity_sold)) OVER (PARTITION BY category, label), 9) AS weight FROM wk GROUP BY 1, 2, 3, 4"""))
def product_weights(spark, sf):
    return elasticity.product_weights(elasticity.with_week_calendar(labelled(spark, sf))).withColumn("weight", r("weight", 9))


WINSOR = """
    , rk AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY product_desc ORDER BY log_price) AS rn,
        COUNT(*) OVER (PARTITION BY product_desc) AS n FROM logs),
    lim AS (SELECT product_desc, MAX(CASE WHEN rn = floor(0.05 * n) + 1 THEN log_price END) AS lo,
        MAX(CASE WHEN rn = n - floor(0.05 * n) THEN log_price END) AS hi FROM rk GROUP BY 1),
    win AS (SELECT logs.* REPLACE (greatest(least(log_price, hi), lo) AS log_price) FROM logs JOIN lim USING (product_desc))"""


@query("winsorized", with_views("items series_coarse", WEEKS + WINSOR + """
    SELECT product_desc, wk_year, wk_month, week_of_year, ROUND(log_price, 9) AS log_price FROM win"""))
def winsorized(spark, sf):
    out = elasticity.winsorize(weekly(spark, sf), ["log_price"])
    return out.select("product_desc", "wk_year", "wk_month", "week_of_year", r("log_price", 9))


@query("competitors", with_views("items series_coarse", WEEKS + """
    , c AS (SELECT a.category, a.product_desc AS item, b.product_desc AS other, corr(a.log_price, b.log_price) AS corr
        FROM logs a JOIN logs b USING (category, wk_year, wk_month, week_of_year) WHERE a.product_desc <> b.product_desc GROUP BY 1, 2, 3),
    e AS (SELECT * FROM c WHERE corr >= 0.05),
    blk AS (SELECT item AS other, other AS chosen FROM e WHERE corr > 0.10),
    p1 AS (SELECT * FROM e QUALIFY ROW_NUMBER() OVER (PARTITION BY item ORDER BY corr DESC, other) = 1),
    e2 AS (SELECT e.* FROM e JOIN p1 ON e.item = p1.item AND e.other <> p1.other
        WHERE NOT EXISTS (SELECT 1 FROM blk WHERE blk.other = e.other AND blk.chosen = p1.other)),
    p2 AS (SELECT * FROM e2 QUALIFY ROW_NUMBER() OVER (PARTITION BY item ORDER BY corr DESC, other) = 1),
    e3 AS (SELECT e2.* FROM e2 JOIN p2 ON e2.item = p2.item AND e2.other <> p2.other
        WHERE NOT EXISTS (SELECT 1 FROM blk WHERE blk.other = e2.other AND blk.chosen = p2.other)),
    p3 AS (SELECT * FROM e3 QUALIFY ROW_NUMBER() OVER (PARTITION BY item ORDER BY corr DESC, other) = 1)
    SELECT category, item, 1 AS slot, other AS competitor, ROUND(corr, 8) AS corr FROM p1 UNION ALL
    SELECT category, item, 2, other, ROUND(corr, 8) FROM p2 UNION ALL SELECT category, item, 3, other, ROUND(corr, 8) FROM p3"""))
def competitors(spark, sf):
    out = correlation.choose_competitors(correlation.price_correlations(weekly(spark, sf), at_least=0.05), 3, 0.05, 0.10)
    return out.withColumn("corr", r("corr", 8))


@query("competitor_prices", with_views("items series_coarse", WEEKS + """
    , c AS (SELECT a.category, a.product_desc AS item, b.product_desc AS other, corr(a.log_price, b.log_price) AS corr
        FROM logs a JOIN logs b USING (category, wk_year, wk_month, week_of_year) WHERE a.product_desc <> b.product_desc GROUP BY 1, 2, 3),
    p AS (SELECT * FROM c WHERE corr >= 0.02 QUALIFY ROW_NUMBER() OVER (PARTITION BY item ORDER BY corr DESC, other) = 1)
    SELECT l.product_desc, l.wk_year, l.wk_month, l.week_of_year, CASE WHEN p.other IS NULL THEN 0 ELSE 1 END AS n_competitors,
        CASE WHEN p.other IS NULL THEN 0 ELSE ROUND(o.log_price, 9) END AS log_price_competitor_1
    FROM logs l LEFT JOIN p ON p.item = l.product_desc LEFT JOIN logs o ON o.product_desc = p.other
        AND o.wk_year = l.wk_year AND o.wk_month = l.wk_month AND o.week_of_year = l.week_of_year"""))
def competitor_prices(spark, sf):
    logs = stored_weekly(spark, sf)
    chosen = correlation.choose_competitors(correlation.price_correlations(logs, at_least=0.02), 1, 0.02, 0.9)
    out, _ = elasticity.with_competitor_prices(logs, logs, chosen, slots=1)
    return out.select("product_desc", "wk_year", "wk_month", "week_of_year", "n_competitors", r("log_price_competitor_1", 9))


@query("ols_own_price", with_views("items series_coarse", WEEKS + """
    , m AS (SELECT product_desc, COUNT(*) AS n, regr_slope(log_qty, log_price) AS b, regr_intercept(log_qty, log_price) AS a,
        regr_syy(log_qty, log_price) AS syy, regr_sxy(log_qty, log_price) AS sxy, regr_sxx(log_qty, log_price) AS sxx FROM logs GROUP BY 1)
    SELECT product_desc, n, ROUND(a, 6) AS intercept, ROUND(b, 6) AS slope,
        ROUND(b / sqrt((syy - b * sxy) / (n - 2) / sxx), 5) AS t, ROUND(syy - b * sxy, 6) AS rss FROM m"""))
def ols_own_price(spark, sf):
    fits = linreg.grouped_fit(weekly(spark, sf), ["product_desc"], "log_qty", ["log_price"])
    return fits.select("product_desc", "n", r(F.col("fit.intercept")).alias("intercept"), r(F.col("fit.coef")[0]).alias("slope"),
                       r(F.col("fit.t")[0], 5).alias("t"), r(F.col("fit.rss")).alias("rss"))


@query("constant_regressor", with_views("items series_coarse", """
    , y AS (SELECT *, YEAR(business_date) AS year FROM series_coarse)
    SELECT product_desc, year, COUNT(*) AS n, false AS has_const, ROUND(regr_slope(quantity_sold, price), 6) AS price_effect,
        ROUND(regr_intercept(quantity_sold, price) / year, 8) AS year_effect FROM y GROUP BY 1, 2 HAVING MIN(price) < MAX(price)"""))
def constant_regressor(spark, sf):
    """Within a year the year is constant and takes the place of the intercept."""
    rows = coarse_series(spark, sf).withColumn("year", F.year("business_date")).withColumn("at", F.col("year"))
    usable = rows.groupBy("product_desc", "at").agg(F.min("price").alias("lo"), F.max("price").alias("hi")).where("lo < hi")
    fits = linreg.grouped_fit(rows.join(usable, ["product_desc", "at"], "left_semi"), ["product_desc", "at"], "quantity_sold", ["price", "year"])
    return fits.select("product_desc", F.col("at").alias("year"), "n", "fit.has_const", r(F.col("fit.coef")[0]).alias("price_effect"),
                       r(F.col("fit.coef")[1], 8).alias("year_effect"))


LAMBDAS = [10 ** (-3 + 5 * k / 19) for k in range(20)]


@query("ridge_own_price", with_views("items series_coarse", WEEKS + f"""
    , dealt AS (SELECT *, (ROW_NUMBER() OVER (PARTITION BY product_desc ORDER BY md5(concat_ws('|', 42, wk_year, wk_month, week_of_year)), wk_year, wk_month, week_of_year) - 1) % 5 AS fold FROM logs),
    scale AS (SELECT product_desc, AVG(log_price) AS m, stddev_pop(log_price) AS s FROM dealt GROUP BY 1),
    z AS (SELECT product_desc, fold, log_qty AS y, (log_price - m) / CASE WHEN s > 0 THEN s ELSE 1 END AS z FROM dealt JOIN scale USING (product_desc)),
    folds AS (SELECT DISTINCT product_desc, fold FROM z),
    train AS (SELECT f.product_desc, f.fold, AVG(y) AS my, AVG(z) AS mz, regr_sxx(y, z) AS szz, regr_sxy(y, z) AS szy
        FROM folds f JOIN z ON z.product_desc = f.product_desc AND z.fold <> f.fold GROUP BY 1, 2),
    lambdas AS (SELECT unnest([{', '.join(f'{x!r}::DOUBLE' for x in LAMBDAS)}]) AS lam),
    errors AS (SELECT z.product_desc, z.fold, lam, AVG((y - my - (z - mz) * szy / (szz + lam)) ** 2) AS err, var_pop(y) AS vy
        FROM z JOIN train USING (product_desc, fold), lambdas GROUP BY 1, 2, 3),
    scores AS (SELECT product_desc, lam, AVG(CASE WHEN vy > 0 THEN 1 - err / vy WHEN err <= 0 THEN 1 ELSE 0 END) AS score FROM errors GROUP BY 1, 2 HAVING COUNT(*) = 5),
    best AS (SELECT product_desc, arg_max(lam, struct_pack(a := score, b := -lam)) AS lam FROM scores GROUP BY 1),
    total AS (SELECT product_desc, regr_sxx(y, z) AS szz, regr_sxy(y, z) AS szy FROM z GROUP BY 1)
    SELECT product_desc, ROUND(szy / (szz + lam) / s, 6) AS elasticity, ROUND((szy / (szz + lam) + lam * szy / (szz + lam) ** 2) / s, 6) AS debiased, ROUND(lam, 9) AS alpha
    FROM total JOIN best USING (product_desc) JOIN scale USING (product_desc)"""))
def ridge_own_price(spark, sf):
    """Own-price elasticity by ridge, plain and bias-corrected, its penalty from folds dealt by a digest of the week."""
    week = ["wk_year", "wk_month", "week_of_year"]
    by = F.md5(F.concat_ws("|", F.lit("42"), *week).cast("binary"))
    out = linreg.ridge_cv(weekly(spark, sf), ["product_desc"], "log_qty", ["log_price"], week, LAMBDAS, by=by)
    return out.select("product_desc", r("slope").alias("elasticity"), r("slope_debiased").alias("debiased"), r("lam", 9).alias("alpha"))


def _project_out(name: str, source: str, done: list[str], todo: list[str]) -> str:
    """SQL that takes the last of ``done`` out of every column in ``todo``, per product."""
    z = done[-1]
    cols = ", ".join(f"{c} - regr_slope({c}, {z}) OVER g * ({z} - AVG({z}) OVER g) - AVG({c}) OVER g AS {c}" for c in todo)
    return f"{name} AS (SELECT product_desc, wk_year, wk_month, week_of_year, {cols} FROM {source} WINDOW g AS (PARTITION BY product_desc))"


def _season_sql() -> str:
    xs = ["x1", "x2", "x3", "x4", "x5"]
    steps = [_project_out(f"f{i + 1}", f"f{i}", xs[:i + 1], [*xs[i + 1:], "res"]) for i in range(5)]
    return """
    , f0 AS (SELECT product_desc, wk_year, wk_month, week_of_year, wk_year::DOUBLE AS x1, sin(2 * pi() * week_of_year / 52) AS x2,
        cos(2 * pi() * week_of_year / 52) AS x3, sin(2 * pi() * wk_month / 12) AS x4, cos(2 * pi() * wk_month / 12) AS x5,
        log_qty AS res FROM logs),""" + ",\n".join(steps)


@query("seasonal_residuals", with_views("items series_coarse", WEEKS + _season_sql() + """
    SELECT product_desc, wk_year, wk_month, week_of_year, ROUND(res, 6) AS residuals FROM f5"""))
def seasonal_residuals(spark, sf):
    out = elasticity.seasonal_residuals(stored_weekly(spark, sf))
    return out.select("product_desc", "wk_year", "wk_month", "week_of_year", r("residuals"))


OWN_PRICE = WEEKS + _season_sql() + """
    , j AS (SELECT product_desc, log_price AS x, res AS y FROM logs JOIN f5 USING (product_desc, wk_year, wk_month, week_of_year)),
    rk AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY product_desc ORDER BY x) AS rx,
        ROW_NUMBER() OVER (PARTITION BY product_desc ORDER BY y) AS ry, COUNT(*) OVER (PARTITION BY product_desc) AS n FROM j),
    lim AS (SELECT product_desc, MAX(CASE WHEN rx = floor(0.05 * n) + 1 THEN x END) AS xl, MAX(CASE WHEN rx = n - floor(0.05 * n) THEN x END) AS xh,
        MAX(CASE WHEN ry = floor(0.05 * n) + 1 THEN y END) AS yl, MAX(CASE WHEN ry = n - floor(0.05 * n) THEN y END) AS yh FROM rk GROUP BY 1),
    w AS (SELECT product_desc, greatest(least(x, xh), xl) AS x, greatest(least(y, yh), yl) AS y FROM j JOIN lim USING (product_desc)),
    m AS (SELECT product_desc, COUNT(*) AS n, regr_slope(y, x) AS b, regr_syy(y, x) AS syy, regr_sxy(y, x) AS sxy, regr_sxx(y, x) AS sxx
        FROM w GROUP BY 1)"""


@query("elasticity_own_price", with_views("items series_coarse", OWN_PRICE + """
    SELECT product_desc, ROUND(b, 5) AS elasticity, ROUND(b / sqrt((syy - b * sxy) / (n - 2) / sxx), 4) AS t FROM m"""))
def elasticity_own_price(spark, sf):
    out = elasticity.product_elasticities(elasticity.seasonal_residuals(stored_weekly(spark, sf)), ["log_price"])
    return out.select("product_desc", r("elasticity", 5), r("t", 4))


@query("weighted_elasticity", with_views("items series_coarse", OWN_PRICE + """
    , sold AS (SELECT category, label, product_desc, SUM(quantity_sold) / SUM(SUM(quantity_sold)) OVER (PARTITION BY category, label) AS weight
        FROM wk GROUP BY 1, 2, 3)
    SELECT category, label, ROUND(SUM(weight * b), 5) AS weighted_elasticity, COUNT(DISTINCT product_desc) AS products
    FROM sold LEFT JOIN m USING (product_desc) GROUP BY 1, 2"""))
def weighted_elasticity(spark, sf):
    sales = written(elasticity.with_week_calendar(labelled(spark, sf)), "dated-sales")
    logs = written(elasticity.log_sales(sales), "log-sales")
    each = elasticity.product_elasticities(elasticity.seasonal_residuals(logs), ["log_price"])
    out = elasticity.weighted_elasticity(elasticity.product_weights(sales), each)
    return out.withColumn("weighted_elasticity", r("weighted_elasticity", 5))


def study(spark, sf, method="ols"):
    return elasticity.elasticity_tables(labelled(spark, sf), [1996, 1997, 1998], 3, 0.75, min_corr=0.05,
                                        max_inter_corr=0.10, method=method)


@query("elasticity_products")
def elasticity_products(spark, sf):
    return study(spark, sf)[0].select("category", "product_desc", r("elasticity"), r("t"), r("p_value"), "significant")


@query("elasticity_report")
def elasticity_report(spark, sf):
    return study(spark, sf)[1].withColumn("weighted_elasticity", r("weighted_elasticity"))


@query("ridge_cv")
def ridge_cv(spark, sf):
    return study(spark, sf, "ridge")[0].select("category", "product_desc", r("elasticity"), "alpha")


@query("ridge_debiased")
def ridge_debiased(spark, sf):
    return study(spark, sf, "ridge_debias")[0].select("category", "product_desc", r("elasticity"), "alpha")
