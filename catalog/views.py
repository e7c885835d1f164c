"""The test tables seen as retail tables, in Spark and, word for word, in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def brand_number(brand) -> F.Column:
    return F.substring_index(brand, "#", -1).cast("int")


def headers(spark, sf) -> DataFrame:
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    return (o.join(c, o.o_custkey == c.c_custkey)
            .select(F.col("o_orderkey").alias("transaction_uid"), F.col("c_nationkey").alias("site_number"),
                    F.to_date("o_orderdate").alias("business_date")))


def items(spark, sf, desc: str | None = None, site: bool = False) -> DataFrame:
    """Item lines; ``desc`` 'coarse' or 'fine' adds the product name, ``site`` the site number."""
    out = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("transaction_uid"), F.col("l_partkey").alias("product_key"),
        F.concat_ws("|", "l_partkey", "l_suppkey").alias("product_id"),
        F.rint(F.col("l_discount") * 100).cast("int").alias("promotion_key"),
        F.to_date("l_shipdate").alias("business_date"), F.col("l_quantity").alias("quantity_sold"),
        F.col("l_extendedprice").alias("sales_amount"), F.col("l_linenumber").alias("line_seq"))
    if desc:
        names = product(spark, sf, desc).select("product_key", F.col("item_desc").alias("product_desc"))
        out = out.join(names, "product_key")
    if site:
        out = out.join(headers(spark, sf).select("transaction_uid", "site_number"), "transaction_uid")
    return out


def product(spark, sf, desc: str = "coarse") -> DataFrame:
    item = F.col("p_brand") if desc == "coarse" else F.concat_ws(" ", "p_type", "p_brand")
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("product_key"), item.alias("item_desc"),
        F.concat(F.lit("CAT "), (brand_number("p_brand") % 5).cast("string"), F.lit("-C")).alias("category_desc"),
        F.col("p_name").alias("sub_category_desc"), F.col("p_type").alias("department_desc"),
        F.col("p_brand").alias("brand"))


def promotion(spark) -> DataFrame:
    key = F.col("id").cast("int")
    return spark.range(11).select(
        key.alias("promotion_key"), F.concat(F.lit("PROMO "), key.cast("string")).alias("promotion_description"),
        F.when(key == 0, "NONE").otherwise("PCT").alias("promotion_type"))


def site(spark, sf) -> DataFrame:
    n, r = table(spark, sf, "nation"), table(spark, sf, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("n_nationkey").alias("site_number"), F.col("r_name").alias("site_state_desc"))


def item_flags(products: DataFrame, item: str = "product_desc") -> DataFrame:
    """Food, beverage, category, manufacturer and label of items named after a brand."""
    bn = brand_number(F.col(item))
    return products.select(
        item, (bn % 3 == 0).cast("int").alias("is_food"), (bn % 3 == 1).cast("int").alias("is_beverage"),
        F.concat(F.lit("CAT "), (bn % 5).cast("string"), F.lit("-C")).alias("category_desc"),
        F.concat(F.lit("M"), (bn % 6).cast("string")).alias("manufacturer"),
        F.when(bn % 4 == 0, "private").otherwise("national").alias("label"))


PAIRS = [("M0", "M1"), ("M2", "M3"), ("M1", "M3")]

SQL = {
    "headers": """SELECT o_orderkey AS transaction_uid, c_nationkey AS site_number,
        CAST(o_orderdate AS DATE) AS business_date FROM orders JOIN customer ON o_custkey = c_custkey""",
    "items": """SELECT l_orderkey AS transaction_uid, l_partkey AS product_key,
        l_partkey || '|' || l_suppkey AS product_id, CAST(round_even(l_discount * 100, 0) AS INTEGER) AS promotion_key,
        CAST(l_shipdate AS DATE) AS business_date, l_quantity AS quantity_sold, l_extendedprice AS sales_amount,
        l_linenumber AS line_seq, p_brand AS coarse, p_type || ' ' || p_brand AS fine, p_type AS department_desc,
        p_name AS sub_category_desc, 'CAT ' || (CAST(split_part(p_brand, '#', 2) AS INTEGER) % 5) || '-C' AS category_desc,
        CASE WHEN l_quantity <> 0 THEN round_even(l_extendedprice / l_quantity * 100, 0) / 100 END AS price
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "series_coarse": """SELECT business_date, coarse AS product_desc, SUM(quantity_sold) AS quantity_sold,
        AVG(price) AS price FROM items WHERE quantity_sold >= 0 GROUP BY 1, 2""",
    "series_fine": """SELECT business_date, fine AS product_desc, SUM(quantity_sold) AS quantity_sold,
        AVG(price) AS price FROM items WHERE quantity_sold >= 0 GROUP BY 1, 2""",
    "baskets_fine": """SELECT DISTINCT transaction_uid, fine AS item FROM items WHERE quantity_sold > 0""",
    "baskets_coarse": """SELECT DISTINCT transaction_uid, coarse AS item FROM items WHERE quantity_sold > 0""",
}


def with_views(names: str, query: str) -> str:
    """``query`` after the named views, as one SQL statement."""
    parts = ",\n".join(f"{n} AS ({SQL[n]})" for n in names.split())
    return f"WITH {parts}\n{query}"
