"""Point-of-sale headers, items and dimensions consolidated into one document per transaction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from comboscope.constants import EXCLUDED_CATEGORIES
from comboscope.functions.expr import not_in, unit_price
from comboscope.operators.baskets import TXN_KEY
from comboscope.operators.cleaning import non_negative_quantity
from comboscope.sources.tables import rows_in

LINE_FIELDS = ["item_desc", "quantity_sold", "price", "sub_category_desc", "category_desc",
               "promotion_description", "promotion_type"]


def transaction_lines(headers: DataFrame, items: DataFrame, product: DataFrame, promotion: DataFrame,
                      sites: DataFrame | list | None = None, excluded_categories: list = EXCLUDED_CATEGORIES,
                      zero_qty: str = "null", dedupe: bool = True, key: list[str] = TXN_KEY) -> DataFrame:
    """Item lines with header, product and promotion columns, unit price and line order.

    Headers keep their site and date; headers without items have no quantity and drop out. The
    site filter sits on the header columns, so it is applied before the join. Both tables are laid out
    by transaction once: copies are found, lines joined and documents grouped in that one layout.
    Rows with a null in the key join nothing, so they go before the shuffle.
    """
    if sites is not None:
        headers = rows_in(headers, "site_number", sites)
    headers, items = (t.na.drop(subset=key) for t in (headers, items))
    if dedupe:
        headers, items = (t.repartition(*key).dropDuplicates() for t in (headers, items))
    lines = items.drop(*[c for c in headers.columns if c not in key])
    joined = headers.join(lines, key)
    joined = joined.join(product, "product_key", "left").join(
        promotion.select("promotion_key", "promotion_description", "promotion_type"), "promotion_key", "left")
    return (non_negative_quantity(joined)
            .withColumn("price", unit_price("sales_amount", "quantity_sold", zero_qty))
            .where(not_in("category_desc", excluded_categories)))


def transaction_documents(lines: DataFrame, key: list[str] = TXN_KEY, line_order: str = "line_seq") -> DataFrame:
    """One row per transaction with its lines as an ordered array of structs.

    Site and date come from the earliest header row. A receipt is one person's purchase, so its
    lines fit one row; steps over all lines read the line table instead.
    """
    line = F.struct(line_order, *LINE_FIELDS)
    docs = lines.groupBy(*key).agg(
        F.min(F.struct("business_date", "site_number")).alias("_head"),
        F.array_sort(F.collect_list(line)).alias("lines"),
        F.coalesce(F.sum("quantity_sold"), F.lit(0.0)).alias("sales_vol"))
    date = F.col("_head.business_date")
    return docs.select(*key, date.alias("business_date"),
                       F.col("_head.site_number").alias("site_number"), "lines", "sales_vol",
                       F.year(date).alias("year"), F.month(date).alias("month"), F.weekofyear(date).alias("week"))


def document_lines(docs: DataFrame, key: list[str] = TXN_KEY) -> DataFrame:
    """Documents back to one row per line."""
    return docs.select(*key, "business_date", F.explode("lines").alias("l")).select(
        *key, "business_date", F.col("l.item_desc").alias("item"), F.col("l.quantity_sold").alias("quantity"))


