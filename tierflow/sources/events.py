"""Profile-event envelope: JSON decode / encode and stream sources.

The topic carries one JSON object per event (a delete carries only
``event_type`` and ``user_id``). ``decode`` parses with a fixed schema
(``from_json``: malformed records become a null struct and are routed to the
reject frame, not an exception), ``encode`` is the inverse with dates as
ISO strings and ``user_id`` as the message key, so a topic partitioned by key
keeps each user's events in order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.schemas import PROFILE_EVENT

ENVELOPE_FIELDS = [f.name for f in PROFILE_EVENT.fields]


def encode(events: DataFrame) -> DataFrame:
    """(key, value) rows — ``value`` is the JSON of the non-null fields."""
    cols = [c for c in ENVELOPE_FIELDS if c in events.columns]
    body = F.struct(*[F.col(c).cast("string").alias(c) if c in ("birth_date", "ts") else F.col(c)
                      for c in cols])
    return events.select(F.col("user_id").cast("string").alias("key"), F.to_json(body).alias("value"))


def _json_schema() -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType() if f.name in ("ts", "birth_date")
                                       else f.dataType) for f in PROFILE_EVENT.fields])


def decode(raw: DataFrame, value_col: str = "value", keep: list[str] | None = None) -> DataFrame:
    """JSON text -> typed event columns plus ``malformed`` for the reject path
    (and the columns ``keep`` of the record)."""
    keep = keep or []
    parsed = raw.select(F.from_json(F.col(value_col).cast("string"), _json_schema()).alias("e"),
                        F.col(value_col).cast("string").alias("raw_value"), *keep)
    cols = []
    for f in PROFILE_EVENT.fields:
        c = F.col(f"e.{f.name}")
        if f.name == "ts":
            c = c.try_cast("timestamp_ntz")
        cols.append(c.alias(f.name))
    # PERMISSIVE parsing yields a struct of nulls for text that is not a JSON object
    all_null = F.lit(True)
    for f in PROFILE_EVENT.fields:
        all_null = all_null & F.col(f"e.{f.name}").isNull()
    malformed = F.col("e").isNull() | all_null
    return parsed.select(*cols, malformed.alias("malformed"), "raw_value", *keep)


#: A record's place in its partition takes the low bits of its event id.
OFFSET_BITS = 48


def topic_events(records: DataFrame, value_col: str = "value") -> DataFrame:
    """Records of a topic (value, partition, offset, timestamp) -> profile
    events. A record that carries neither id nor time, as producers of profile
    events send them, takes its id from (partition, offset) and its time from the
    record. A user's records lie in one partition (keyed by user, or a topic of one
    partition), so ids order them as the topic does, across batches and
    redeliveries. Records that are no JSON object are ``malformed``."""
    events = decode(records, value_col, keep=["partition", "offset", "timestamp"])
    place = F.shiftleft(F.col("partition").cast("long"), OFFSET_BITS).bitwiseOR(F.col("offset"))
    return events.withColumns({"event_id": F.coalesce("event_id", place), "ts": F.coalesce("ts", F.col("timestamp").cast("timestamp_ntz"))}).drop(
        "partition", "offset", "timestamp")


def line_records(lines: DataFrame, first: int = 0) -> DataFrame:
    """Lines of files (``read_line_files``) as records of a topic of one partition: offsets
    go on from ``first`` by the files' time and path and the line's place, the
    record's time is the file's."""
    from tierflow.operators.ordered import row_index

    placed = row_index(lines.withColumn("line", F.monotonically_increasing_id()), ["file_time", "file_path", "block_start", "line"], "offset")
    return placed.select("value", F.lit(0).alias("partition"), (F.col("offset") + first).alias("offset"), F.col("file_time").alias("timestamp"))


def read_line_files(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """S9 file form without ids: a directory of JSON-lines files as a stream, each line with its file and place."""
    r = spark.readStream
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.text(path).select("value", F.col("_metadata.file_modification_time").alias("file_time"), F.col("_metadata.file_path").alias("file_path"),
                               F.col("_metadata.file_block_start").alias("block_start"))


def read_record_files(spark: SparkSession, path: str) -> DataFrame:
    """A directory of topic records in files (value, partition, offset, timestamp) as a stream."""
    return spark.readStream.schema("value string, partition int, offset long, timestamp timestamp").parquet(path)


def read_topic(spark: SparkSession, servers: str, topic: str, starting_offsets: str = "earliest",
               group_id: str | None = None, max_offsets_per_trigger: int | None = None) -> DataFrame:
    """S9 on a broker (needs the Kafka connector on the classpath): earliest
    offsets by default, offsets tracked by the query checkpoint (exactly-once
    with the idempotent ``foreachBatch``), optional consumer group id and a
    bound on the records per micro-batch."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic).option("startingOffsets", starting_offsets))
    if group_id:
        r = r.option("kafka.group.id", group_id)
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return r.load()


def write_topic(events: DataFrame, servers: str, topic: str) -> None:
    """S10 batch publish to a broker, keyed by user (needs the Kafka connector)."""
    (encode(events).write.format("kafka").option("kafka.bootstrap.servers", servers)
     .option("topic", topic).save())


def read_event_files(spark: SparkSession, path: str, schema: T.StructType, glob: str | None = None,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """S9 file form: a directory of parquet event files as a stream."""
    r = spark.readStream.schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)
