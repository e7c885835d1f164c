"""Intermediate results that several later steps read, kept in the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a local session without one gets its own."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="comboscope-"))
    return sc.getCheckpointDir()


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back.

    The written table cuts the lineage, survives lost executors and has a known size, so the
    optimiser broadcasts it only when it really is below the broadcast threshold.
    """
    path = f"{shared_folder(df.sparkSession)}/comboscope/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
