"""Daily sales and the brand sheet to private and national elasticities."""

from __future__ import annotations

from pyspark.sql import DataFrame

from comboscope.constants import ELASTICITY_EXCLUDED_CATEGORIES, ELASTICITY_EXCLUDED_DEPARTMENTS, PRIVATE_BRANDS
from comboscope.operators import cleaning
from comboscope.operators.elasticity import elasticity_tables


def plan_elasticity(sales: DataFrame, brand_sheet: DataFrame, product: DataFrame, private_brands: list = PRIVATE_BRANDS,
                    departments: list = ELASTICITY_EXCLUDED_DEPARTMENTS, categories: list = ELASTICITY_EXCLUDED_CATEGORIES,
                    **study) -> dict[str, DataFrame]:
    """``sales`` are daily series by item id. Gives the elasticity per product and per category and label."""
    kept = cleaning.exclude_values(cleaning.exclude_values(product, "department_desc", departments), "category_desc", categories)
    labelled = cleaning.label_sales(sales, cleaning.label_brands(brand_sheet, private_brands), kept)
    each, summary = elasticity_tables(labelled, **study)
    return {"products": each, "categories": summary}
