"""From raw documents to packed training sequences: five stages, each over all that the one before has kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from comboscope.functions.storage import written
from comboscope.llm import decontamination, jaccard, packing, pii, quality

#: Key of the pseudonyms; a deployment sets its own.
KEY = "example key"

#: The stages need byte-pair ids, compression and alignments, which SQL can't express.
ORACLE_SQL = None


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores 0.3 or more; learnt from the labelled rows that aren't held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(quality.fold("doc_id") != 0)
    scorer, rate = quality.train(docs, labels)
    return quality.quality_scores(docs, scorer, rate, threshold=0.3).where("predicted = 1").select(*docs.columns)


def free(docs: DataFrame, name: str) -> str:
    """A name that ``docs`` has no column of."""
    taken = {c.lower() for c in docs.columns}
    return next(n for n in (name + "_" * k for k in range(len(taken) + 1)) if n not in taken)


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one of the smallest id, those without id last.

    A document is an id with a text: texts that share an id are grouped apart, and rows alike in both are one
    document. Documents without words are near nothing; all of them stay.
    """
    key = free(docs, "document_key")
    keyed = docs.withColumn(key, F.xxhash64("doc_id", "text"))
    groups = jaccard.near_documents(keyed, k=5, percent=80, doc_id=key).where("component_id is not null").select("doc_id", "component_id").distinct()
    ids = keyed.select(F.col(key).alias("key"), F.col("doc_id").alias("id")).distinct()
    first = F.min_by("key", F.struct(F.col("id").isNull().alias("last"), "id", "key")).alias(key)
    kept = groups.withColumnRenamed("doc_id", "key").join(ids, "key").groupBy("component_id").agg(first).select(key)
    return keyed.join(kept, key, "left_semi").dropDuplicates([key]).select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of a test item; those without text hold none."""
    id_, text = free(docs, "id_key"), free(docs, "text_key")
    found = decontamination.contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    found = found.select(F.xxhash64("doc_id").alias(id_), F.col("text_hash").alias(text)).distinct()
    marked = docs.withColumn(id_, F.xxhash64("doc_id")).withColumn(text, F.xxhash64("text"))
    return marked.join(found, [id_, text], "left_anti").select(*docs.columns)


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal values replaced by keyed pseudonyms; null texts stay null."""
    count = free(docs, "replaced_count")
    out = pii.replace_personal(docs, KEY, count=count).drop(count)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents' tokens in sequences of at most 2048."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, limit=2048)


STAGES = [
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", distinct_texts),
    ("benchmark decontamination", without_benchmark),
    ("PII", pseudonyms),
    ("best-fit packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
