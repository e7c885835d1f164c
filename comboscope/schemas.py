"""Declared schemas of the input tables."""

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


S, D, L, I, DT = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType(), T.DateType()

HEADERS = _struct(transaction_uid=S, site_number=S, business_date=DT, transaction_date=DT)
ITEMS = _struct(transaction_uid=S, site_number=S, product_key=L, product_id=S, product_desc=S,
                promotion_key=L, business_date=DT, quantity_sold=S, sales_amount=D, transaction_date=DT)
PRODUCT = _struct(product_key=L, item_desc=S, category_desc=S, sub_category_desc=S, department_desc=S)
PROMOTION = _struct(promotion_key=L, promotion_description=S, promotion_type=S)
SITE = _struct(site_number=S, site_state_desc=S)
BRAND_SHEET = _struct(item_id=S, product_desc=S, brand=S, category_desc=S, sub_category_desc=S)
COST_TABLE = _struct(product_desc=S, product_cost=D, retail_price=D)
FOOD_LABELS = _struct(product_desc=S, is_food=I, is_beverage=I)
SERIES = _struct(business_date=DT, product_desc=S, quantity_sold=D, price=D, year=I, month=I, week=I)
ITEMSETS = T.StructType([T.StructField("items", T.ArrayType(S)), T.StructField("support", D)])
