"""Warehouse reads and writes (S6, S7, S8) over JDBC or Parquet.

A target is either a JDBC table (``url`` + ``table``) or a Parquet path.
Appends are plain ``mode("append")``; the truncate-and-reload of the food
dimension is ``mode("overwrite")`` with ``truncate=true`` on JDBC so the
table definition survives. JDBC writes are parallel per partition
(``numPartitions`` caps concurrent connections); reads of large tables are
split on a numeric column (``partitionColumn`` / bounds).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass
class Target:
    table: str
    url: str | None = None          # JDBC url; None -> Parquet path in ``table``
    properties: dict = field(default_factory=dict)
    num_partitions: int = 8

    @property
    def is_jdbc(self) -> bool:
        return self.url is not None


def read(spark: SparkSession, t: Target, partition_column: str | None = None,
         lower: int | None = None, upper: int | None = None) -> DataFrame:
    if not t.is_jdbc:
        return spark.read.parquet(t.table)
    r = spark.read.format("jdbc").option("url", t.url).option("dbtable", t.table)
    for k, v in t.properties.items():
        r = r.option(k, v)
    if partition_column is not None:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
             .option("upperBound", upper).option("numPartitions", t.num_partitions))
    return r.load()


def existing_keys(spark: SparkSession, t: Target, key: str = "user_id") -> DataFrame:
    """``SELECT DISTINCT key`` pushed to the source (column pruning) + distinct."""
    return read(spark, t).select(key).distinct()


def _jdbc_writer(df: DataFrame, t: Target, mode: str, truncate: bool = False):
    w = (df.write.format("jdbc").option("url", t.url).option("dbtable", t.table)
         .option("numPartitions", t.num_partitions).mode(mode))
    if truncate:
        w = w.option("truncate", "true")
    for k, v in t.properties.items():
        w = w.option(k, v)
    return w


def append(df: DataFrame, t: Target) -> None:
    """S7."""
    if t.is_jdbc:
        _jdbc_writer(df, t, "append").save()
    else:
        df.write.mode("append").parquet(t.table)


def replace(df: DataFrame, t: Target) -> None:
    """Truncate and reload."""
    if t.is_jdbc:
        _jdbc_writer(df, t, "overwrite", truncate=True).save()
    else:
        df.write.mode("overwrite").parquet(t.table)
