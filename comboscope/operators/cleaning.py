"""Row-level preparation: site choice, exclusions, keyed dedupe, name lists, differences."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from comboscope.functions.expr import brand_label, col, not_in, seeded_draw


def sample_keys(df: DataFrame, key: str, n: int = 215, seed: int = 666) -> DataFrame:
    """``n`` distinct keys chosen by a seeded hash: the same keys whatever the partitioning."""
    return df.select(key).where(F.col(key).isNotNull()).distinct().orderBy(seeded_draw(seed, key), key).limit(n)


def non_negative_quantity(df: DataFrame, column: str = "quantity_sold") -> DataFrame:
    """Quantity as double, zero kept, negative and missing dropped."""
    return df.withColumn(column, F.col(column).cast("double")).where(F.col(column) >= 0)


def exclude_values(df: DataFrame, column: str, values: list) -> DataFrame:
    return df.where(not_in(column, values))


def items_outside(product: DataFrame, group_column: str, excluded: list, item_column: str = "item_desc") -> DataFrame:
    """Distinct items of every group that is not excluded; a missing group counts as a group."""
    return product.where(not_in(group_column, excluded)).select(item_column).distinct()


def drop_named(df: DataFrame, column: str, prefix: str | None = None, names: list | None = None) -> DataFrame:
    keep = F.lit(True) if prefix is None else ~F.col(column).startswith(prefix)
    return df.where(keep & not_in(column, names or []))


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, first by ``order`` and then by the other columns; nulls come last.

    The smallest row is kept by an aggregate, so copies collapse before the shuffle and no key's
    rows are ever sorted in one place.
    """
    rest = [c for c in df.columns if c not in keys]
    ranked = order + [c for c in rest if c not in order]
    ranked = [r for r in ranked if r not in keys]
    parts = [x for r in ranked for x in (F.col(r).isNull().alias(f"_no_{r}"), F.col(r))]
    best = df.groupBy(*keys).agg(F.min(F.struct(*parts)).alias("_row"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def any_of(columns: list[Column | str]) -> Column:
    """Largest of several 0/1 flags, ignoring nulls."""
    return F.greatest(*[col(c) for c in columns]) if len(columns) > 1 else col(columns[0])


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def distinct_union(frames: list[DataFrame]) -> DataFrame:
    """Rows of all frames, each once; a column that a frame lacks is null there."""
    return union_all(frames).distinct()


def missing_keys(wanted: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """Keys of ``wanted`` that ``present`` lacks."""
    return wanted.select(key).distinct().join(present.select(key).distinct(), key, "left_anti")


def label_brands(brand_sheet: DataFrame, private_brands: list[str]) -> DataFrame:
    """One row per item id, with its private or national label."""
    one = first_per_key(brand_sheet.drop("product_desc"), ["item_id"], ["brand"])
    return one.withColumn("label", brand_label("brand", private_brands))


def label_sales(sales: DataFrame, labels: DataFrame, categories: DataFrame | None = None) -> DataFrame:
    """Sales rows with brand, category and label; rows with any missing value are dropped."""
    joined = (sales.withColumn("item_id", F.col("item_id").cast("string"))
              .join(labels.withColumn("item_id", F.col("item_id").cast("string")), "item_id")
              .na.drop())
    if categories is not None:
        joined = joined.join(categories.select("category_desc").distinct(), "category_desc", "left_semi")
    return joined
