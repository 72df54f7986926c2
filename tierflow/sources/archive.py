"""Layer archive and manifest.

Each layer table is archived under ``<archive>/<layer>/<table>``. Its rows are
dealt to a fixed number of buckets by their hash; every bucket has a digest
(rows and two order-independent sums of 64-bit row hashes), every ``FANOUT``
buckets' digests make a group's, and the groups' make the table's checksum. A
run compares the new tree with the one of the last run, from the top, and
copies only the buckets that differ; what is copied is read back and must give
the same digests before the manifest's pointer moves. Buckets that did not
change stay where an earlier run put them. A run that fails leaves the pointer
alone, so readers see the last whole archive.
"""

from __future__ import annotations

import hashlib
import logging
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.operators.ordered import materialize
from tierflow.sources import files

BUCKETS, FANOUT = 64, 8
BUCKET, RUN = "__bucket", "__run"

log = logging.getLogger(__name__)


def _row_hash(columns: list[str], seed: int) -> Column:
    """64-bit hash of a row; nulls count by place, as the hash itself skips them."""
    nulls = F.concat(*[F.isnull(F.col(f"`{c}`")).cast("int").cast("string") for c in columns])
    return F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in columns], nulls)


def _bucketed(df: DataFrame, buckets: int) -> DataFrame:
    return df.withColumn(BUCKET, F.coalesce(F.pmod(_row_hash(df.columns, 0), F.lit(buckets)).cast("int"), F.lit(0)))  # never null, and known not to be


def _of_buckets(source: DataFrame, buckets: list[int]) -> DataFrame:
    """The rows of some buckets. A filter on the bucket (also one that the other side of a join implies) would be moved below
    the source's own aggregates, with all that its columns are made of written out in the row hash and evaluated again; a
    join with the plain numbers stays where it is."""
    numbers = source.sparkSession.createDataFrame([(b,) for b in buckets], f"{BUCKET} int")
    return source.join(F.broadcast(numbers), BUCKET).select(*source.columns)


def _exact_sum(value: Column) -> Column:
    """Exact sum of 64-bit numbers, as two sums of their halves: decimals are added far more slowly."""
    high, low = F.sum(F.shiftright(value, 32)), F.sum(value.bitwiseAND(F.lit(0xFFFFFFFF)))
    return high.cast("decimal(20,0)") * F.lit(1 << 32).cast("decimal(10,0)") + low.cast("decimal(20,0)")


def digests(bucketed: DataFrame) -> DataFrame:
    """(bucket, row_count, digest) of a table with its bucket column; one row a bucket, combined before the shuffle."""
    columns = [c for c in bucketed.columns if c not in (BUCKET, RUN)]
    sums = [_exact_sum(_row_hash(columns, seed)).cast("string") for seed in (1, 2)]
    return bucketed.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("row_count"), F.sha2(F.concat_ws(":", F.count(F.lit(1)).cast("string"), *sums), 256).alias("digest"))


def _joined(of: DataFrame, by: list[Column], order: str) -> DataFrame:
    parts = F.sort_array(F.collect_list(F.struct(F.col(order).alias("at"), F.col("digest").alias("digest"))))  # a fixed number a group
    return of.groupBy(*by).agg(F.sum("row_count").alias("row_count"),
                               F.sha2(F.array_join(F.transform(parts, lambda p: F.concat(p["at"].cast("string"), F.lit(":"), p["digest"])), ","), 256).alias("digest"))


def tree(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The groups' digests (``group``, row_count, digest) and the table's one row (row_count, digest)."""
    groups = _joined(leaves, [F.floor(F.col(BUCKET) / FANOUT).alias("group")], BUCKET)
    return groups, _joined(groups, [], "group")


def table_digest(df: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """One row (row_count, digest): the checksum that ``archive_table`` gives for these rows."""
    return tree(digests(_bucketed(df, buckets)))[1]


def changed_buckets(new: DataFrame, old: DataFrame) -> DataFrame:
    """Buckets of ``new`` that ``old`` lacks or holds with another digest; groups that agree are not opened."""
    open_groups = tree(new)[0].join(tree(old)[0].select("group", "digest"), ["group", "digest"], "left_anti").select("group")
    mine = new.withColumn("group", F.floor(F.col(BUCKET) / FANOUT)).join(F.broadcast(open_groups), "group", "left_semi")
    return mine.join(old.select(BUCKET, "digest"), [BUCKET, "digest"], "left_anti").select(BUCKET)


def _fields(df: DataFrame) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema.fields)


def _folder(path: str, fields: str, buckets: int) -> str:
    """Rows of one schema and number of buckets lie together."""
    return f"{path}/data/{hashlib.sha256(f'{fields}/{buckets}'.encode()).hexdigest()[:12]}"


def _manifest(spark: SparkSession, path: str) -> tuple[DataFrame, str, int] | None:
    """The last whole run's buckets, columns and number of buckets (a row without bucket holds these, also for an empty table)."""
    if files.current_version(spark, f"{path}/manifest") is None:
        return None
    rows = files.read_published(spark, f"{path}/manifest")
    table = rows.filter(F.col(BUCKET).isNull()).first()
    return rows.filter(F.col(BUCKET).isNotNull()), table["fields"], int(table["row_count"])


def read_archived(spark: SparkSession, path: str) -> DataFrame:
    """The rows of an archived table as its last whole run left them."""
    found = _manifest(spark, path)
    if found is None:
        raise FileNotFoundError(f"no archive under {path}")
    manifest, fields, buckets = found
    rows = spark.read.schema(f"{fields}, {RUN} string, {BUCKET} int").parquet(_folder(path, fields, buckets))
    return rows.join(F.broadcast(manifest.select(BUCKET, RUN)), [BUCKET, RUN], "left_semi").drop(BUCKET, RUN)


def archive_table(df: DataFrame, path: str, buckets: int = BUCKETS) -> dict:
    """Archive one table; gives row_count, column_count, checksum, buckets_copied and buckets_kept.

    An empty table is archived as no rows, with a warning. Repeated rows count
    each. Another schema, or another number of buckets, than last time copies everything. Raises if
    the copy's digests are not the source's, as with a source that reads differently each time.
    """
    spark, run = df.sparkSession, "r" + uuid.uuid4().hex[:12]
    if not df.columns:
        raise ValueError(f"nothing to archive for {path}: no columns")
    source, fields = _bucketed(df, buckets), _fields(df)
    folder = _folder(path, fields, buckets)
    leaves = materialize(digests(source))
    found = _manifest(spark, path)
    before = found[0] if found and found[1:] == (fields, buckets) else None
    todo = leaves.select(BUCKET) if before is None else changed_buckets(leaves, before)
    todo = sorted(r[0] for r in todo.collect())  # at most the number of buckets
    moving = F.col(BUCKET).isin(todo) if todo else F.lit(False)
    if todo or before is None:
        # a row's hash decides its bucket, so buckets are even; one row repeated often is split by AQE
        rows = _of_buckets(source, todo).hint("rebalance", BUCKET).withColumn(RUN, F.lit(run))
        rows.write.mode("append").partitionBy(RUN, BUCKET).parquet(folder)
    if todo:
        copy = spark.read.schema(f"{fields}, {RUN} string, {BUCKET} int").parquet(folder).filter(F.col(RUN) == run)
        wrong = leaves.filter(moving).join(digests(copy), [BUCKET, "row_count", "digest"], "left_anti").count()
        if wrong:
            raise OSError(f"{wrong} archived buckets of {path} differ from their source")
    now = leaves.filter(moving).withColumn(RUN, F.lit(run))
    if before is not None:
        # a bucket that lost all its rows is in neither part
        now = now.unionByName(leaves.filter(~moving).join(before.select(BUCKET, RUN), BUCKET))
    now = materialize(now)
    table = spark.createDataFrame([(None, buckets, "", "", fields)], f"{BUCKET} int, row_count long, digest string, {RUN} string, fields string")
    files.publish(now.withColumn("fields", F.lit(None).cast("string")).unionByName(table).coalesce(1), f"{path}/manifest", run)
    top = tree(now)[1].first()
    count = int(top["row_count"] or 0)
    if not count:
        log.warning("archived an empty table: %s", path)
    return {"row_count": count, "column_count": len(df.columns), "checksum": top["digest"], "buckets_copied": len(todo), "buckets_kept": now.count() - len(todo)}


def archive_layers(tables: dict[tuple[str, str], DataFrame], archive_root: str, buckets: int = BUCKETS) -> DataFrame:
    """Archive every (layer, table) frame and return the manifest, a row a table."""
    rows, spark = [], None
    for (layer, name), df in tables.items():
        spark = df.sparkSession
        path = f"{archive_root.rstrip('/')}/{layer}/{name}"
        done = archive_table(df, path, buckets)
        rows.append((layer, name, done["row_count"], done["column_count"], done["checksum"], path, "EMPTY" if not done["row_count"] else "OK",
                     done["buckets_copied"], done["buckets_kept"]))
    if spark is None:
        raise ValueError("no tables to archive")
    return spark.createDataFrame(rows, "layer string, table_name string, row_count long, column_count int, checksum string, path string, status string, "
                                       "buckets_copied int, buckets_kept int")
