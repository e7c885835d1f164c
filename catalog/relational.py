"""Scans, filters, joins, series and other relational queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalog.registry import query, r
from catalog.views import headers, items, product, promotion, site, table, with_views
from comboscope.functions import expr
from comboscope.functions.storage import shared_folder
from comboscope.operators import baskets, cleaning, series, transactions
from comboscope.schemas import BRAND_SHEET, PRODUCT
from comboscope.sources import sinks, tables
from comboscope.sources.tables import dated_facts, rows_in


@query("dated_scan", """
    SELECT CAST(l_shipdate AS DATE) AS business_date, COUNT(*) AS n_lines, ROUND(SUM(l_extendedprice), 2) AS sales
    FROM lineitem WHERE l_shipdate BETWEEN TIMESTAMP '1998-01-13' AND TIMESTAMP '1998-02-12' GROUP BY 1""")
def dated_scan(spark, sf):
    lines = table(spark, sf, "lineitem").where(
        F.col("l_shipdate").between(F.lit("1998-01-13").cast("timestamp_ntz"), F.lit("1998-02-12").cast("timestamp_ntz")))
    return (lines.groupBy(F.to_date("l_shipdate").alias("business_date"))
            .agg(F.count("*").alias("n_lines"), r(F.sum("l_extendedprice"), 2).alias("sales")))


@query("reloaded_days", """
    SELECT CAST(l_shipdate AS DATE) AS business_date, COUNT(*) AS n_lines,
        ROUND(SUM(l_quantity * CASE WHEN CAST(l_shipdate AS DATE) = DATE '1998-01-20' THEN 2 ELSE 1 END), 2) AS quantity
    FROM lineitem WHERE l_shipdate BETWEEN TIMESTAMP '1998-01-13' AND TIMESTAMP '1998-02-12' GROUP BY 1""")
def reloaded_days(spark, sf):
    """All lines stored by day, one day loaded again, and a month of days read back."""
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("order_key"), F.col("l_quantity").cast("double").alias("quantity"),
                                                F.to_date("l_shipdate").alias("transaction_date"))
    path = f"{shared_folder(spark)}/comboscope/days-{uuid.uuid4().hex}"
    sinks.replace_days(lines, path)
    sinks.replace_days(lines.where("transaction_date = date'1998-01-20'").withColumn("quantity", F.col("quantity") * 2), path)
    days = dated_facts(spark, path, lines.schema, "1998-01-13", "1998-02-12", ["transaction_date", "quantity"])
    return days.groupBy(F.col("transaction_date").alias("business_date")).agg(F.count("*").alias("n_lines"), r(F.sum("quantity"), 2).alias("quantity"))


def stored(spark, name: str) -> str:
    """A folder of its own for a query's tables."""
    return f"{shared_folder(spark)}/comboscope/{name}-{uuid.uuid4().hex}"


@query("product_parts", """
    SELECT CAST(p_partkey AS BIGINT) AS product_key, p_brand AS item_desc, 'CAT ' || (CAST(split_part(p_brand, '#', 2) AS INTEGER) % 5) || '-C' AS category_desc,
        p_name AS sub_category_desc, p_type AS department_desc FROM part""")
def product_parts(spark, sf):
    """The product dimension in many part files, one folder a category, read back as one table of the declared schema."""
    path, names = stored(spark, "products"), [f.name for f in PRODUCT.fields]
    products = product(spark, sf).select(*[F.col(f.name).cast(f.dataType) for f in PRODUCT.fields])
    sinks.write_table(products, path, partition_by="category_desc")
    return tables.dimension(spark, path, PRODUCT).select(*names)


@query("brand_sheet", """
    SELECT CAST(p_partkey AS VARCHAR) AS item_id, p_type || ', "' || p_brand || '"' AS product_desc, p_brand AS brand,
        CASE WHEN p_partkey % 7 > 0 THEN p_type END AS category_desc, p_name AS sub_category_desc FROM part""")
def brand_sheet(spark, sf):
    """The label sheet as CSV, with commas, quotes and empty cells, and back."""
    path, p = stored(spark, "sheet"), table(spark, sf, "part")
    sheet = p.select(F.col("p_partkey").cast("string").alias("item_id"), F.concat("p_type", F.lit(', "'), "p_brand", F.lit('"')).alias("product_desc"),
                     F.col("p_brand").alias("brand"), F.when(F.col("p_partkey") % 7 > 0, F.col("p_type")).alias("category_desc"), F.col("p_name").alias("sub_category_desc"))
    sinks.write_table(sheet, path, "csv")
    return tables.sheet(spark, path, BRAND_SHEET)


@query("stored_matrix", with_views("items", """
    SELECT transaction_uid, fine AS item, SUM(quantity_sold) AS quantity FROM items GROUP BY 1, 2 HAVING SUM(quantity_sold) > 0"""))
def stored_matrix(spark, sf):
    """The basket matrix written as cells and labels, and read back with its labels."""
    path = stored(spark, "matrix")
    sinks.write_basket_matrix(*baskets.basket_matrix(basket_long_rows(spark, sf), ["transaction_uid"]), path)
    return tables.basket_matrix(spark, path).select("transaction_uid", "item", F.col("quantity").cast("double").alias("quantity"))


@query("stored_report", with_views("items headers", """
    , s AS (SELECT 'sites' AS sheet, CAST(site_number AS VARCHAR) AS name, COUNT(*) AS n FROM headers GROUP BY 1, 2),
    d AS (SELECT 'departments' AS sheet, department_desc AS name, COUNT(*) AS n FROM items GROUP BY 1, 2)
    SELECT * FROM s UNION ALL SELECT * FROM d"""))
def stored_report(spark, sf):
    """Two sheets of one report, each read back from its own dataset."""
    lines = items(spark, sf).join(product(spark, sf), "product_key")
    sheets = {"sites": headers(spark, sf).groupBy(F.col("site_number").cast("string").alias("name")).agg(F.count("*").alias("n")),
              "departments": lines.groupBy(F.col("department_desc").alias("name")).agg(F.count("*").alias("n"))}
    paths = sinks.write_report(sheets, stored(spark, "report"))
    one, two = (spark.read.parquet(path).withColumn("sheet", F.lit(name)) for name, path in zip(sheets, paths, strict=True))
    return one.unionByName(two).select("sheet", "name", "n")


@query("finite_prices", """
    WITH l AS (SELECT l_partkey AS product_key, l_extendedprice AS amount, l_quantity - 25 AS quantity FROM lineitem)
    SELECT product_key, COUNT(*) AS n, COUNT(*) FILTER (quantity = 0) AS n_infinite,
        ROUND(AVG(CASE WHEN quantity <> 0 THEN round_even(amount / quantity * 100, 0) / 100 END), 6) AS mean_price FROM l GROUP BY 1""")
def finite_prices(spark, sf):
    """Prices of lines that may have quantity 0, infinite there, and their mean over the finite ones."""
    price = expr.unit_price("l_extendedprice", F.col("l_quantity") - 25, "inf")
    lines = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("product_key"), price.alias("price"))
    return lines.groupBy("product_key").agg(F.count("*").alias("n"), F.count_if(F.abs("price") == float("inf")).alias("n_infinite"),
                                            r(F.avg(expr.finite("price"))).alias("mean_price"))


@query("region_sites", """
    SELECT n_nationkey AS site_number, r_name AS site_state_desc FROM nation JOIN region ON n_regionkey = r_regionkey
    WHERE r_name = 'AMERICA'""")
def region_sites(spark, sf):
    return site(spark, sf).where(F.col("site_state_desc") == "AMERICA")


@query("sampled_sites", """
    SELECT c_custkey AS site_number FROM customer ORDER BY ('0x' || substr(md5('666|' || c_custkey), 1, 15))::BIGINT, 1 LIMIT 215""")
def sampled_sites(spark, sf):
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("site_number"))
    return cleaning.sample_keys(customers, "site_number", 215, 666)


@query("site_sales", f"""
    WITH region_site AS (SELECT n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'AMERICA'),
    headers AS (SELECT o_orderkey, c_nationkey FROM orders JOIN customer ON o_custkey = c_custkey)
    SELECT c_nationkey AS site_number, COUNT(*) AS n_lines, ROUND(SUM(l_extendedprice), 2) AS sales
    FROM lineitem JOIN headers ON l_orderkey = o_orderkey WHERE c_nationkey IN (SELECT n_nationkey FROM region_site)
    GROUP BY 1""")
def site_sales(spark, sf):
    chosen = region_sites(spark, sf).select("site_number")
    return (rows_in(items(spark, sf, site=True), "site_number", chosen).groupBy("site_number")
            .agg(F.count("*").alias("n_lines"), r(F.sum("sales_amount"), 2).alias("sales")))


@query("kept_categories", with_views("items", """
    SELECT category_desc, COUNT(*) AS n FROM items
    WHERE category_desc NOT IN ('CAT 0-C', 'CAT 3-C') OR category_desc IS NULL GROUP BY 1"""))
def kept_categories(spark, sf):
    lines = items(spark, sf).join(product(spark, sf).select("product_key", "category_desc"), "product_key", "left")
    return (cleaning.exclude_values(lines, "category_desc", ["CAT 0-C", "CAT 3-C"])
            .groupBy("category_desc").agg(F.count("*").alias("n")))


@query("food_items", """
    SELECT DISTINCT p_type || ' ' || p_brand AS item_desc FROM part WHERE p_type NOT IN ('ECONOMY', 'PROMO')""")
def food_items(spark, sf):
    return cleaning.items_outside(product(spark, sf, "fine"), "department_desc", ["ECONOMY", "PROMO"])


@query("unit_prices", with_views("items", """
    SELECT price, COUNT(*) AS n, SUM(quantity_sold) AS qty FROM items WHERE quantity_sold >= 0 GROUP BY price"""))
def unit_prices(spark, sf):
    lines = cleaning.non_negative_quantity(items(spark, sf))
    return (lines.groupBy(expr.unit_price("sales_amount", "quantity_sold").alias("price"))
            .agg(F.count("*").alias("n"), F.sum("quantity_sold").alias("qty")))


@query("retail_calendar", """
    WITH days AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem),
    weeks AS (SELECT d, CAST(date_trunc('week', d) AS DATE) AS week_start FROM days)
    SELECT d AS business_date, YEAR(d) AS year, MONTH(d) AS month, WEEKOFYEAR(d) AS week, week_start,
        CAST(strftime(d, '%W') AS INTEGER) AS week_monday, CAST(strftime(week_start, '%W') AS INTEGER) AS week_of_year,
        YEAR(week_start) AS wk_year, MONTH(week_start) AS wk_month, monthname(d) AS month_name FROM weeks""")
def retail_calendar(spark, sf):
    days = table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("business_date")).distinct()
    start = expr.week_start("business_date")
    return (series.with_calendar(days).withColumn("week_start", start)
            .withColumn("week_monday", expr.monday_week("business_date"))
            .withColumn("week_of_year", expr.monday_week("week_start"))
            .withColumn("wk_year", F.year("week_start")).withColumn("wk_month", F.month("week_start"))
            .withColumn("month_name", expr.month_name("business_date")))


@query("category_keys", """
    SELECT p_type || '-C' AS category_desc, CASE WHEN k = 'SMALL' THEN 'STANDARD' ELSE k END AS category, n FROM (
        SELECT p_type, trim(regexp_replace(p_type || '-C', '-C|-|/| |\\*', '_', 'g'), '_') AS k, COUNT(*) AS n
        FROM part GROUP BY p_type)""")
def category_keys(spark, sf):
    named = table(spark, sf, "part").select(F.concat("p_type", F.lit("-C")).alias("category_desc"))
    return (named.groupBy("category_desc").agg(F.count("*").alias("n"))
            .withColumn("category", expr.category_key("category_desc", {"SMALL": "STANDARD"})))


@query("brand_labels", """
    SELECT split_part(l_partkey || '|' || l_suppkey, '|', 1) AS item_id,
        ANY_VALUE(CASE WHEN p_brand IN ('Brand#4', 'Brand#8', 'Brand#12') THEN 'private' ELSE 'national' END) AS label,
        SUM(l_quantity) AS quantity_sold FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""")
def brand_labels(spark, sf):
    sold = items(spark, sf).select(expr.item_id("product_id").alias("item_id"), "quantity_sold")
    sheet = product(spark, sf).select(F.col("product_key").cast("string").alias("item_id"), "brand",
                                      "category_desc", "sub_category_desc", F.col("item_desc").alias("product_desc"))
    labels = cleaning.label_brands(sheet, ["Brand#4", "Brand#8", "Brand#12"])
    totals = sold.groupBy("item_id").agg(F.sum("quantity_sold").alias("quantity_sold"))
    return cleaning.label_sales(totals, labels).select("item_id", "label", "quantity_sold")


@query("named_items", with_views("items", """
    SELECT coarse AS product_desc, COUNT(*) AS n FROM items
    WHERE NOT starts_with(coarse, 'Brand#1') AND coarse NOT IN ('Brand#2', 'Brand#7') GROUP BY 1"""))
def named_items(spark, sf):
    lines = items(spark, sf, "coarse")
    return (cleaning.drop_named(lines, "product_desc", "Brand#1", ["Brand#2", "Brand#7"])
            .groupBy("product_desc").agg(F.count("*").alias("n")))


@query("headers_without_items", """
    SELECT o_orderkey AS transaction_uid FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""")
def headers_without_items(spark, sf):
    return cleaning.missing_keys(headers(spark, sf), items(spark, sf), "transaction_uid")


@query("deduped_sales", """
    SELECT business_date, COUNT(*) AS n, SUM(quantity_sold) AS qty FROM (
        SELECT DISTINCT CAST(l_shipdate AS DATE) AS business_date, p_brand, c_nationkey, l_quantity AS quantity_sold
        FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey) GROUP BY 1""")
def deduped_sales(spark, sf):
    sold = items(spark, sf, "coarse", site=True)
    return (sold.select("business_date", "product_desc", "site_number", "quantity_sold").dropDuplicates()
            .groupBy("business_date").agg(F.count("*").alias("n"), F.sum("quantity_sold").alias("qty")))


def documents(spark, sf, desc: str = "coarse"):
    sold = items(spark, sf)
    lines = transactions.transaction_lines(headers(spark, sf), sold, product(spark, sf, desc), promotion(spark), key=["transaction_uid"])
    return transactions.transaction_documents(lines, ["transaction_uid"])


@query("transaction_documents", with_views("items headers", """
    , lines AS (SELECT h.transaction_uid, h.business_date, h.site_number, i.line_seq, i.coarse AS item, i.quantity_sold AS q,
        i.price, i.sub_category_desc AS sub, i.category_desc AS cat, 'PROMO ' || i.promotion_key AS promo,
        CASE WHEN i.promotion_key = 0 THEN 'NONE' ELSE 'PCT' END AS ptype
        FROM headers h JOIN (SELECT DISTINCT * FROM items) i USING (transaction_uid) WHERE i.quantity_sold >= 0)
    SELECT transaction_uid, business_date, site_number,
        string_agg(item, ';' ORDER BY line_seq, item, q, price, sub, cat, promo, ptype) AS items,
        string_agg(CAST(q AS VARCHAR), ';' ORDER BY line_seq, item, q, price, sub, cat, promo, ptype) AS quantities,
        string_agg(CAST(CAST(price AS DECIMAL(18, 2)) AS VARCHAR), ';' ORDER BY line_seq, item, q, price, sub, cat, promo, ptype) AS prices,
        string_agg(sub, ';' ORDER BY line_seq, item, q, price, sub, cat, promo, ptype) AS sub_categories,
        string_agg(cat, ';' ORDER BY line_seq, item, q, price, sub, cat, promo, ptype) AS categories,
        string_agg(promo, ';' ORDER BY line_seq, item, q, price, sub, cat, promo, ptype) AS promotions,
        string_agg(ptype, ';' ORDER BY line_seq, item, q, price, sub, cat, promo, ptype) AS promotion_types,
        SUM(q) AS sales_vol, YEAR(business_date) AS year, MONTH(business_date) AS month, WEEKOFYEAR(business_date) AS week
    FROM lines GROUP BY transaction_uid, business_date, site_number"""))
def transaction_documents(spark, sf):
    docs = documents(spark, sf)

    def joined(field: str, cast: str = "string"):
        return F.array_join(F.transform("lines", lambda x: x[field].cast(cast).cast("string")), ";")

    return docs.select(
        "transaction_uid", "business_date", "site_number", joined("item_desc").alias("items"),
        joined("quantity_sold").alias("quantities"), joined("price", "decimal(18,2)").alias("prices"),
        joined("sub_category_desc").alias("sub_categories"), joined("category_desc").alias("categories"),
        joined("promotion_description").alias("promotions"), joined("promotion_type").alias("promotion_types"),
        "sales_vol", "year", "month", "week")


@query("daily_series", with_views("items series_fine", """
    SELECT business_date, product_desc, quantity_sold, ROUND(price, 6) AS price, YEAR(business_date) AS year,
        MONTH(business_date) AS month, WEEKOFYEAR(business_date) AS week FROM series_fine"""))
def daily_series(spark, sf):
    return series.daily_series(items(spark, sf, "fine")).withColumn("price", r("price"))


@query("daily_series_item", """
    WITH six AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS business_date, p_brand AS product_desc,
            CAST(l_partkey AS VARCHAR) AS item_id, c_nationkey, l_quantity, l_extendedprice
        FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey),
    daily AS (SELECT business_date, item_id, product_desc, SUM(l_quantity) AS quantity_sold,
            AVG(round_even(l_extendedprice / l_quantity * 100, 0) / 100) AS price FROM six GROUP BY 1, 2, 3)
    SELECT business_date, item_id, product_desc, quantity_sold, ROUND(price, 6) AS price FROM daily
    QUALIFY ROW_NUMBER() OVER (PARTITION BY business_date, product_desc ORDER BY item_id) = 1""")
def daily_series_item(spark, sf):
    sold = items(spark, sf, "coarse", site=True).withColumn("transaction_date", F.col("business_date"))
    out = series.daily_series(
        sold, by_item_id=True, partition_date="transaction_date",
        dedupe_columns=["transaction_date", "business_date", "product_desc", "product_id", "site_number",
                        "quantity_sold", "sales_amount"])
    return out.select("business_date", "item_id", "product_desc", "quantity_sold", r("price"))


@query("quantile_cascade", """
    WITH t0 AS (SELECT l_partkey AS product_desc, SUM(l_quantity) AS total_qty FROM lineitem GROUP BY 1),
    t1 AS (SELECT * FROM t0 WHERE total_qty >= (SELECT quantile_cont(total_qty, 0.75) FROM t0)),
    t2 AS (SELECT * FROM t1 WHERE total_qty >= (SELECT quantile_cont(total_qty, 0.25) FROM t1))
    SELECT * FROM t2 WHERE total_qty >= (SELECT quantile_cont(total_qty, 0.75) FROM t2)""")
def quantile_cascade(spark, sf):
    sold = items(spark, sf).select(F.col("product_key").alias("product_desc"), "quantity_sold")
    return series.quantile_cascade(sold)


@query("jump_products", with_views("items series_fine", """
    , m AS (SELECT product_desc, AVG(CASE WHEN business_date <= DATE '2001-08-01' THEN quantity_sold END) AS mean_before,
        AVG(CASE WHEN business_date > DATE '2001-08-01' THEN quantity_sold END) AS mean_after FROM series_fine GROUP BY 1)
    SELECT product_desc, ROUND(mean_before, 6) AS mean_before, ROUND(mean_after, 6) AS mean_after,
        COALESCE(mean_after > 1.0 * mean_before, FALSE) AS jump FROM m"""))
def jump_products(spark, sf):
    out = series.jump_products(series.daily_series(items(spark, sf, "fine")), "2001-08-01", 1.0)
    return out.select("product_desc", r("mean_before"), r("mean_after"), "jump")


@query("product_universe", with_views("items series_coarse series_fine", """
    , t0 AS (SELECT product_desc, SUM(quantity_sold) AS t FROM series_fine GROUP BY 1),
    t1 AS (SELECT * FROM t0 WHERE t >= (SELECT quantile_cont(t, 0.75) FROM t0)),
    t2 AS (SELECT * FROM t1 WHERE t >= (SELECT quantile_cont(t, 0.25) FROM t1)),
    t3 AS (SELECT * FROM t2 WHERE t >= (SELECT quantile_cont(t, 0.75) FROM t2)),
    u AS (SELECT * FROM series_coarse UNION ALL SELECT s.* FROM series_fine s JOIN t3 USING (product_desc)),
    k AS (SELECT * FROM u WHERE NOT starts_with(product_desc, 'PROMO') AND product_desc NOT IN ('Brand#3')),
    j AS (SELECT product_desc FROM k GROUP BY 1 HAVING AVG(CASE WHEN business_date > DATE '2001-08-01' THEN quantity_sold END)
        > AVG(CASE WHEN business_date <= DATE '2001-08-01' THEN quantity_sold END))
    SELECT business_date, product_desc, quantity_sold FROM k
    WHERE business_date <= DATE '2001-08-01' OR product_desc NOT IN (SELECT product_desc FROM j)"""))
def product_universe(spark, sf):
    coarse, fine = (series.daily_series(items(spark, sf, d)) for d in ("coarse", "fine"))
    out = series.product_universe(coarse, fine, prefix="PROMO", names=["Brand#3"], jump_date="2001-08-01", jump_factor=1.0)
    return out.select("business_date", "product_desc", "quantity_sold")


@query("series_union", with_views("items series_coarse series_fine", """
    SELECT business_date, product_desc, quantity_sold FROM series_coarse UNION SELECT business_date, product_desc, quantity_sold FROM series_fine
    UNION SELECT business_date, product_desc, quantity_sold FROM series_coarse WHERE product_desc = 'Brand#3'"""))
def series_union(spark, sf):
    coarse, fine = (series.daily_series(items(spark, sf, d)).select("business_date", "product_desc", "quantity_sold") for d in ("coarse", "fine"))
    return cleaning.distinct_union([coarse, fine, coarse.where(F.col("product_desc") == "Brand#3")])


@query("price_lags", with_views("items series_fine", """
    , l AS (SELECT *, LAG(price, 1) OVER w AS l1, LAG(price, 3) OVER w AS l3, LAG(price, 8) OVER w AS l8
        FROM series_fine WINDOW w AS (PARTITION BY product_desc ORDER BY business_date))
    SELECT business_date, product_desc, ROUND(l1, 6) AS price_lag_1, ROUND(l3, 6) AS price_lag_3,
        ROUND(l8, 6) AS price_lag_8 FROM l WHERE l8 IS NOT NULL"""))
def price_lags(spark, sf):
    out = series.with_price_lags(series.daily_series(items(spark, sf, "fine")))
    return out.select("business_date", "product_desc", r("price_lag_1"), r("price_lag_3"), r("price_lag_8"))


@query("train_test_split", with_views("items series_fine", """
    , p AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY product_desc ORDER BY business_date) AS ordinal,
        COUNT(*) OVER (PARTITION BY product_desc) AS n FROM series_fine)
    SELECT product_desc, business_date, CAST(ordinal AS INTEGER) AS ordinal,
        CASE WHEN ordinal <= floor(n * 0.8) THEN 'train' ELSE 'test' END AS split FROM p"""))
def train_test_split(spark, sf):
    out = series.with_split(series.with_ordinal(series.daily_series(items(spark, sf, "fine"))))
    return out.select("product_desc", "business_date", "ordinal", "split")


@query("last_prices", with_views("items series_fine", """
    , t AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY product_desc ORDER BY business_date DESC) AS rn FROM series_fine)
    SELECT product_desc, string_agg(CAST(CAST(ROUND(price, 3) AS DECIMAL(18, 3)) AS VARCHAR), ';' ORDER BY business_date) AS past_price
    FROM t WHERE rn <= 3 GROUP BY 1"""))
def last_prices(spark, sf):
    out = series.last_prices(series.daily_series(items(spark, sf, "fine")))
    return out.select("product_desc", F.array_join(F.transform("past_price", lambda p: F.round(p, 3).cast("decimal(18,3)").cast("string")), ";").alias("past_price"))


@query("item_totals_stats", with_views("items baskets_fine", """
    , t AS (SELECT fine AS item, SUM(quantity_sold) AS x FROM items GROUP BY 1)
    SELECT COUNT(*) AS count, ROUND(AVG(x), 6) AS mean, ROUND(stddev_samp(x), 4) AS std, MIN(x) AS min,
        quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median, quantile_cont(x, 0.75) AS q3, MAX(x) AS max FROM t"""))
def item_totals_stats(spark, sf):
    out = baskets.describe(baskets.item_totals(basket_long_rows(spark, sf)), "total_qty")
    return out.select("count", r("mean"), r("std", 4), "min", "q1", "median", "q3", "max")


@query("item_histogram", """
    WITH t AS (SELECT l_partkey, SUM(l_quantity) AS x FROM lineitem GROUP BY 1),
    b AS (SELECT MIN(x) AS lo, (MAX(x) - MIN(x)) / 50 AS w FROM t),
    c AS (SELECT CAST(LEAST(floor((x - lo) / w), 49) AS INTEGER) AS bin, COUNT(*) AS n FROM t, b GROUP BY 1)
    SELECT CAST(g.range AS INTEGER) AS bin, ROUND(lo + g.range * w, 4) AS bin_start, COALESCE(n, 0) AS n
    FROM range(50) g CROSS JOIN b LEFT JOIN c ON c.bin = g.range""")
def item_histogram(spark, sf):
    totals = items(spark, sf).groupBy("product_key").agg(F.sum("quantity_sold").alias("total_qty"))
    return baskets.histogram(totals, "total_qty").withColumn("bin_start", r("bin_start", 4))


def basket_long_rows(spark, sf, desc: str = "fine"):
    lines = items(spark, sf, desc).select(
        "transaction_uid", F.col("product_desc").alias("item"), F.col("quantity_sold").alias("quantity"))
    return baskets.basket_rows(lines, ["transaction_uid"])
