"""Corpus pipeline over ``documents``: toxicity, near duplicates, benchmark
decontamination, mixing, sharding. Part of the ``llm`` subpackage.

Each stage works on all that the one before kept, is written as Parquet and
read again; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.llm import common, decontam, mixing, neardup, sharding, toxicity

#: Documents with this score or more are rejected.
TOXIC = 0.3


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below ``TOXIC``; all of them where the
    labels are too few for a model."""
    model = toxicity.fitted(docs, _table(spark, sf_dir, "labels"))
    row = model.first()
    if row is None or not any(row["weight"]):  # no n-gram was learnt
        return docs
    scored = toxicity.toxicity_scores(docs, model, out_col="_toxicity")
    return scored.filter(F.col("_toxicity") < TOXIC).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group (the smallest doc_id; a null id only where the group
    has no other), shingles of five words. Rows have a key of their own, so rows
    that repeat an id, or have none, are judged by their texts; texts without
    words are linked with nothing and all stay."""
    rows = common.stage(docs.withColumn("_row", F.monotonically_increasing_id()), "rows")  # written, so that a row keeps its key
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col("_row").alias("row"))
    found = neardup.near_duplicates(rows.select(key.alias("_key"), "text"), id_col="_key", shingle_words=5)
    kept = common.stage(found.filter("kept").select(F.col("_key.row").alias("_row")), "kept")
    return rows.join(kept, "_row", "left_semi").select(docs.columns)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no test item."""
    return decontam.decontaminated(docs, _table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose source, language and topic marginals are the raked ones."""
    dims = {"source": F.col("source"), "lang": F.col("lang"), "topic": mixing.form_topic(F.col("text"))}
    return mixing.mix(docs, dims).filter("selected").select(docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents' shards and slots; their files are written beside."""
    return sharding.reshard(docs)


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates), ("decontamination", drop_benchmark),
          ("mixing", mix_sources), ("sharding", shard)]

#: Training, components and flows have no SQL form; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents`` of ``sf_dir``."""
    docs = _table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = common.stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
