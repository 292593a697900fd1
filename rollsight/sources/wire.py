"""Events on the wire: JSON in and out, Kafka or files as the carrier."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import contract as C


def decode(raw: DataFrame, value: str = "value") -> DataFrame:
    """Parse JSON leniently: an absent or unreadable field is NULL, garbage is all NULL."""
    parsed = F.from_json(F.col(value).cast("string"), C.READING_SCHEMA, {"mode": "PERMISSIVE"})
    # `inline` keeps later filters above the parser, so each message is parsed once.
    return raw.select(F.inline(F.array(parsed))).withColumn("ts", F.timestamp_millis("ts_ms"))


def keyed_only(df: DataFrame) -> DataFrame:
    """Drop events without time, coil or stand, ahead of any Python function."""
    return df.dropna(subset=["ts_ms", "coil_id", "stand"])


def encode(events: DataFrame) -> DataFrame:
    """Key = coil id as text, so a coil stays in one topic partition; value = JSON."""
    names = [field.name for field in C.READING_SCHEMA]
    return events.select(
        F.col("coil_id").cast("string").alias("key"),
        F.to_json(F.struct(*names), {"ignoreNullFields": "false"}).alias("value"),
    )


def kafka_events(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """The topic from its first offset (the Kafka connector must be on the class path)."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .options(**options)
        .load()
    )


def file_events(spark: SparkSession, folder: str, per_batch: int | None = None) -> DataFrame:
    """JSON lines dropped into a folder, as a stream of `value` strings."""
    reader = spark.readStream.format("text")
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    return reader.load(folder)


def write_events(events: DataFrame, servers: str, topic: str) -> None:
    (
        encode(events).write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.compression.type", "gzip")
        .option("topic", topic)
        .save()
    )


def preview(df: DataFrame, rows: int = 10):
    """Dry run: print the first rows of a batch, or of each batch of a stream."""
    if df.isStreaming:
        return df.writeStream.format("console").option("numRows", rows).start()
    return df.show(rows, truncate=False)
