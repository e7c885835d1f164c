"""Baskets, itemsets and rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query, r
from catalog.relational import basket_long_rows, documents
from catalog.views import items, product, with_views
from comboscope.operators import baskets, cleaning, rules, transactions

KEY = ["transaction_uid"]


@query("basket_long", with_views("items headers", """
    SELECT h.transaction_uid, i.fine AS item, SUM(i.quantity_sold) AS quantity
    FROM headers h JOIN items i USING (transaction_uid) WHERE i.quantity_sold >= 0 GROUP BY 1, 2"""))
def basket_long(spark, sf):
    return baskets.basket_rows(transactions.document_lines(documents(spark, sf, "fine"), ["transaction_uid"]), KEY)


@query("basket_food_semi", with_views("items", """
    SELECT transaction_uid, fine AS item, SUM(quantity_sold) AS quantity FROM items
    WHERE transaction_uid IN (SELECT transaction_uid FROM items WHERE department_desc NOT IN ('ECONOMY', 'PROMO', 'SMALL'))
    GROUP BY 1, 2"""))
def basket_food_semi(spark, sf):
    food = cleaning.items_outside(product(spark, sf, "fine"), "department_desc", ["ECONOMY", "PROMO", "SMALL"])
    return baskets.baskets_with_any(basket_long_rows(spark, sf), food, KEY)


@query("basket_pivot", with_views("items", """
    SELECT transaction_uid, COALESCE(SUM(CASE WHEN coarse = 'Brand#1' THEN quantity_sold END), 0) AS "Brand#1",
        COALESCE(SUM(CASE WHEN coarse = 'Brand#2' THEN quantity_sold END), 0) AS "Brand#2",
        COALESCE(SUM(CASE WHEN coarse = 'Brand#3' THEN quantity_sold END), 0) AS "Brand#3" FROM items GROUP BY 1"""))
def basket_pivot(spark, sf):
    return baskets.basket_pivot(basket_long_rows(spark, sf, "coarse"), ["Brand#1", "Brand#2", "Brand#3"], KEY)


@query("basket_arrays", with_views("items baskets_coarse", """
    SELECT transaction_uid, string_agg(item, ';' ORDER BY item) AS items FROM baskets_coarse
    WHERE item NOT IN ('Brand#3') GROUP BY 1"""))
def basket_arrays(spark, sf):
    out = baskets.baskets(basket_long_rows(spark, sf, "coarse"), ["Brand#3"], KEY)
    return out.select("transaction_uid", F.array_join("items", ";").alias("items"))


@query("basket_matrix", with_views("items", """
    , q AS (SELECT transaction_uid, fine, SUM(quantity_sold) AS quantity FROM items GROUP BY 1, 2)
    SELECT DENSE_RANK() OVER (ORDER BY transaction_uid) - 1 AS row_id, DENSE_RANK() OVER (ORDER BY fine) - 1 AS col_id,
        quantity FROM q WHERE quantity > 0"""))
def basket_matrix(spark, sf):
    return baskets.basket_matrix(basket_long_rows(spark, sf), KEY)[0].withColumn("quantity", F.col("quantity").cast("double"))


ITEMSETS = """
    , n AS (SELECT COUNT(DISTINCT transaction_uid) AS n FROM {b}),
    s1 AS (SELECT item AS a, COUNT(*) AS f FROM {b} GROUP BY 1 HAVING COUNT(*) >= ceil({s} * (SELECT n FROM n))),
    k AS (SELECT transaction_uid, item FROM {b} WHERE item IN (SELECT a FROM s1)),
    s2 AS (SELECT x.item AS a, y.item AS b, COUNT(*) AS f FROM k x JOIN k y ON x.transaction_uid = y.transaction_uid
        AND x.item < y.item GROUP BY 1, 2 HAVING COUNT(*) >= ceil({s} * (SELECT n FROM n))),
    s3 AS (SELECT x.item AS a, y.item AS b, z.item AS c, COUNT(*) AS f FROM k x
        JOIN k y ON x.transaction_uid = y.transaction_uid AND x.item < y.item
        JOIN k z ON x.transaction_uid = z.transaction_uid AND y.item < z.item
        GROUP BY 1, 2, 3 HAVING COUNT(*) >= ceil({s} * (SELECT n FROM n)))"""


def carts(spark, sf, desc: str):
    return baskets.baskets(basket_long_rows(spark, sf, desc), [], KEY)


@query("frequent_itemsets", with_views("items baskets_coarse", ITEMSETS.format(b="baskets_coarse", s="0.01") + """
    SELECT i AS items, f AS freq, ROUND(CAST(f AS DOUBLE) / n, 9) AS support FROM (SELECT a AS i, f FROM s1 UNION ALL
        SELECT a || ';' || b, f FROM s2 UNION ALL SELECT a || ';' || b || ';' || c, f FROM s3), n"""))
def frequent_itemsets(spark, sf):
    out = baskets.frequent_itemsets(carts(spark, sf, "coarse"), 0.01)
    return out.select(F.array_join("items", ";").alias("items"), "freq", r("support", 9))


@query("singleton_supports", with_views("items baskets_fine", """
    SELECT item, ROUND(COUNT(*)::DOUBLE / (SELECT COUNT(DISTINCT transaction_uid) FROM baskets_fine), 9) AS support
    FROM baskets_fine GROUP BY 1 HAVING COUNT(*) >= ceil(0.01 * (SELECT COUNT(DISTINCT transaction_uid) FROM baskets_fine))"""))
def singleton_supports(spark, sf):
    found = baskets.frequent_itemsets(carts(spark, sf, "fine"), 0.01)
    return baskets.singleton_supports(found).withColumn("support", r("support", 9))


def _chunk_sql(c: int) -> str:
    names = {n: f"{n}_{c}" for n in ("n", "s1", "k", "s2", "s3")}
    part = f"""
    , part_{c} AS (SELECT * FROM baskets_coarse WHERE ('0x' || substr(md5('42|' || transaction_uid), 1, 15))::BIGINT % 2 = {c})"""
    sql = ITEMSETS.format(b=f"part_{c}", s="0.01")
    for name, own in names.items():
        sql = sql.replace(f"{name} AS (", f"{own} AS (").replace(f"FROM {name} x", f"FROM {own} x").replace(f"JOIN {name} ", f"JOIN {own} ")
        sql = sql.replace(f"FROM {name})", f"FROM {own})")
    return part + sql


def _chunk_rows(c: int) -> str:
    return f"""SELECT {c} AS chunk, i AS items, f AS freq, ROUND(CAST(f AS DOUBLE) / n, 9) AS support FROM (SELECT a AS i, f FROM s1_{c} UNION ALL
        SELECT a || ';' || b, f FROM s2_{c} UNION ALL SELECT a || ';' || b || ';' || c, f FROM s3_{c}), n_{c}"""


@query("chunked_itemsets", with_views("items baskets_coarse", _chunk_sql(0) + _chunk_sql(1) + _chunk_rows(0) + " UNION ALL " + _chunk_rows(1)))
def chunked_itemsets(spark, sf):
    out = baskets.frequent_itemsets_by_chunk(carts(spark, sf, "coarse"), 0.01, key=KEY)
    return out.select("chunk", F.array_join("items", ";").alias("items"), "freq", r("support", 9))


@query("itemset_items", with_views("items baskets_coarse", ITEMSETS.format(b="baskets_coarse", s="0.01")
       + "SELECT a AS product_desc FROM s1"))
def itemset_items(spark, sf):
    return baskets.items_of(baskets.frequent_itemsets(carts(spark, sf, "coarse"), 0.01))


RULES = """
    , sup AS (SELECT [a] AS i, f / n AS s FROM s1, n UNION ALL SELECT [a, b], f / n FROM s2, n
        UNION ALL SELECT [a, b, c], f / n FROM s3, n),
    split AS (
        SELECT [a] AS x, [b] AS y, f / n AS s FROM s2, n UNION ALL SELECT [b], [a], f / n FROM s2, n
        UNION ALL SELECT [a], [b, c], f / n FROM s3, n UNION ALL SELECT [b], [a, c], f / n FROM s3, n
        UNION ALL SELECT [c], [a, b], f / n FROM s3, n UNION ALL SELECT [a, b], [c], f / n FROM s3, n
        UNION ALL SELECT [a, c], [b], f / n FROM s3, n UNION ALL SELECT [b, c], [a], f / n FROM s3, n),
    rules AS (SELECT x, y, p.s AS sa, q.s AS sc, split.s AS s, split.s / p.s AS conf, split.s / p.s / q.s AS lift,
        split.s - p.s * q.s AS lev, greatest(split.s * (1 - p.s), p.s * (q.s - split.s)) AS spread
        FROM split JOIN sup p ON p.i = x JOIN sup q ON q.i = y)"""


def mined_rules(spark, sf, metric="lift", threshold=1.3):
    found = baskets.frequent_itemsets(carts(spark, sf, "fine"), 0.001)
    return rules.association_rules(found, metric, threshold)


@query("rules", with_views("items baskets_fine", ITEMSETS.format(b="baskets_fine", s="0.001") + RULES + """
    SELECT array_to_string(x, ',') AS antecedents, array_to_string(y, ',') AS consequents,
        ROUND(sa, 9) AS antecedent_support, ROUND(sc, 9) AS consequent_support, ROUND(s, 9) AS support,
        ROUND(conf, 9) AS confidence, ROUND(lift, 6) AS lift, ROUND(lev, 9) AS leverage,
        CASE WHEN conf >= 1 THEN 'Infinity'::DOUBLE ELSE ROUND((1 - sc) / (1 - conf), 6) END AS conviction,
        CASE WHEN spread = 0 THEN 0 ELSE ROUND(lev / spread, 6) END AS zhang FROM rules WHERE lift >= 1.3"""))
def lift_rules(spark, sf):
    out = mined_rules(spark, sf)
    return out.select(
        F.array_join("antecedents", ",").alias("antecedents"), F.array_join("consequents", ",").alias("consequents"),
        r("antecedent_support", 9), r("consequent_support", 9), r("support", 9), r("confidence", 9), r("lift"),
        r("leverage", 9), F.when(F.col("conviction") == float("inf"), F.col("conviction"))
        .otherwise(F.round("conviction", 6)).alias("conviction"), r("zhang"))


@query("rule_edges", with_views("items baskets_coarse", ITEMSETS.format(b="baskets_coarse", s="0.01") + RULES.replace("rules AS", "cut AS") + """
    SELECT x[1] AS antecedent, y[1] AS consequent, COUNT(*) AS n FROM cut GROUP BY 1, 2"""))
def rule_edges(spark, sf):
    found = baskets.frequent_itemsets(carts(spark, sf, "coarse"), 0.01)
    edges = rules.rule_edges(rules.association_rules(found, "support", 0.0))
    return edges.groupBy("antecedent", "consequent").agg(F.count("*").alias("n"))


@query("rule_pivot", with_views("items baskets_coarse", ITEMSETS.format(b="baskets_coarse", s="0.01") + RULES + """
    SELECT array_to_string(y, ',') AS consequents, ROUND(MAX(CASE WHEN x = ['Brand#1'] THEN conf END), 9) AS "Brand#1",
        ROUND(MAX(CASE WHEN x = ['Brand#2'] THEN conf END), 9) AS "Brand#2",
        ROUND(MAX(CASE WHEN x = ['Brand#3'] THEN conf END), 9) AS "Brand#3" FROM rules GROUP BY 1"""))
def rule_pivot(spark, sf):
    found = baskets.frequent_itemsets(carts(spark, sf, "coarse"), 0.01)
    names = ["Brand#1", "Brand#2", "Brand#3"]
    out = rules.confidence_table(rules.association_rules(found, "support", 0.0), names)
    return out.select("consequents", *[F.round(F.col(f"`{n}`"), 9).alias(n) for n in names])
