"""Point-of-sale tables to baskets, frequent itemsets and rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from comboscope.constants import BASKET_DROP_ITEMS, EXCLUDED_CATEGORIES, NON_FOOD_DEPARTMENTS
from comboscope.functions.storage import written
from comboscope.operators import baskets, cleaning, rules, transactions


def mine_baskets(headers: DataFrame, items: DataFrame, product: DataFrame, promotion: DataFrame, sites: DataFrame,
                 key: list[str] = baskets.TXN_KEY, n_sites: int = 215, seed: int = 666, min_support: float = 0.01,
                 metric: str = "lift", min_threshold: float = 1.3, excluded_categories: list = EXCLUDED_CATEGORIES,
                 non_food: list = NON_FOOD_DEPARTMENTS, dropped: list = BASKET_DROP_ITEMS, chunks: int = 1) -> dict[str, DataFrame]:
    """Baskets of a site sample that hold food, what is often bought together, and the rules.

    With ``chunks`` above 1 each chunk is mined apart and rules stay within their chunk.
    """
    sample = cleaning.sample_keys(sites, "site_number", n_sites, seed)
    lines = transactions.transaction_lines(headers, items, product, promotion, sample, excluded_categories, key=key)
    docs = transactions.transaction_documents(lines, key)
    food = cleaning.items_outside(product, "department_desc", non_food)
    sold = lines.select(*key, F.col("item_desc").alias("item"), F.col("quantity_sold").alias("quantity"))
    rows = baskets.baskets_with_any(written(baskets.basket_rows(sold, key), "basket-rows"), food, key)
    carts = baskets.baskets(rows, dropped, key)
    if chunks > 1:
        found = baskets.frequent_itemsets_by_chunk(carts, min_support, chunks, key=key)
    else:
        found = baskets.frequent_itemsets(carts, min_support)
    mined = rules.association_rules(found, metric, min_threshold, ["chunk"] if chunks > 1 else [])
    return {"sampled_sites": sample, "transactions": docs, "baskets": rows, "itemsets": found, "rules": mined,
            "rule_edges": rules.rule_edges(mined), "items": baskets.items_of(found)}
