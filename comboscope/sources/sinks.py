"""Writers: single tables, day-partitioned tables, the basket matrix and report bundles."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: str | None = None,
                mode: str = "errorifexists") -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if fmt == "csv":
        writer = writer.option("header", "true")
    writer.format(fmt).save(path)


def replace_days(df: DataFrame, path: str, date_column: str = "transaction_date", files: int = 1) -> None:
    """The days that ``df`` has, written anew into a folder partitioned by day; other days stay as they are.

    A day's rows go to ``files`` tasks, each of which writes one file; take more where a day is more than a task should hold.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.repartition(tasks, date_column, F.pmod(F.xxhash64(*df.columns), F.lit(files)))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(date_column).parquet(path)


def write_basket_matrix(cells: DataFrame, items: DataFrame, transactions: DataFrame, root: str) -> None:
    for name, df in (("cells", cells), ("items", items), ("transactions", transactions)):
        write_table(df, f"{root}/{name}")


def write_report(tables: dict[str, DataFrame], root: str, fmt: str = "parquet") -> list[str]:
    """One dataset per report sheet. Array columns need Parquet or JSON."""
    paths = []
    for name, df in tables.items():
        path = f"{root}/{name}"
        write_table(df, path, fmt)
        paths.append(path)
    return paths
