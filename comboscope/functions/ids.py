"""Dense ids over a sorted key, numbered partition by partition."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from comboscope.functions.storage import written


def dense_ids(keys: DataFrame, columns: list[str], id_name: str) -> DataFrame:
    """Distinct keys with a 0-based id in sorted order.

    A range sort puts the keys in order; each row's partition and place in it are written out, and
    the id is the place plus the row count of earlier partitions. Only that count table, one row
    per partition, is ordered by a single task.
    """
    place = F.monotonically_increasing_id()
    rows = written(keys.select(*columns).distinct().sort(*columns).withColumn("_at", place), "ids")
    part = F.shiftright("_at", 33)
    sizes = rows.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    return (rows.withColumn("_part", part).join(F.broadcast(offsets), "_part")
            .select(*columns, (F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1)).alias(id_name)))
