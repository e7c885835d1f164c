"""Readers for dated facts, dimensions and sheets exported as CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from comboscope.functions.expr import col


def dated_facts(spark: SparkSession, root: str, schema: T.StructType, start: str, end: str,
                columns: list[str] | None = None, date_column: str = "transaction_date") -> DataFrame:
    """A folder partitioned by day, read between two dates inclusive.

    The date filter prunes partitions and the column list prunes the scan. Absent days, empty
    folders and zero-byte files give no rows: with a declared schema no footer is needed for them.
    """
    facts = (spark.read.schema(schema).option("ignoreMissingFiles", "true").parquet(root)
             .where(F.col(date_column).between(F.lit(start).cast("date"), F.lit(end).cast("date"))))
    return facts.select(*columns) if columns else facts


def rows_in(df: DataFrame, column: str, values: list | DataFrame) -> DataFrame:
    """Rows whose ``column`` is among ``values``: a pushed IN list, or a semi-join with a table."""
    if isinstance(values, DataFrame):
        keys = values.select(F.col(values.columns[0]).alias(column)).distinct()
        return df.join(keys, column, "left_semi")
    return df.where(col(column).isin(list(values)))


def dimension(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """All part files of a dimension as one table."""
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def sheet(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A CSV table, or a spreadsheet sheet exported to CSV, under its declared schema."""
    return spark.read.schema(schema).option("header", "true").csv(path)


def basket_matrix(spark: SparkSession, root: str) -> DataFrame:
    """The coordinate table written by ``write_basket_matrix``, with item and transaction labels."""
    cells, items, txns = (spark.read.parquet(f"{root}/{t}") for t in ("cells", "items", "transactions"))
    return cells.join(items, "col_id").join(txns, "row_id").drop("row_id", "col_id")
