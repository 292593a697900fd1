"""Stored tables: idempotent appends, latest-wins views, day partitions, retention, JDBC."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import contract as C
from ..functions.session import shuffle_width
from ..operators.latest import latest

DAY = "ts_day"
DEFAULT_RANGE = "30 minutes"

# Ids one batch may use; 2^25 batches of 2^38 rows fill a bigint.
BATCH_IDS = 1 << 38


def to_sink_schema(df: DataFrame, *also: str) -> DataFrame:
    """Columns of the stored event in order and type; time is cut to milliseconds, UTC."""
    def cast(field):
        column = F.col(field.name)
        if field.name == "ts":
            column = F.date_trunc("millisecond", column)
        return column.cast(field.dataType).alias(field.name)

    return df.select(*[cast(field) for field in C.SCORED_SCHEMA], *also)


def stamp(df: DataFrame, batch_id: int, row: str | None = None) -> DataFrame:
    """Columns the sink adds: a growing id, the arrival time and the day.

    Ids are batch-major and dense within the batch: each partition starts after the rows of
    the ones before it, so no global sort is needed. `row` names the column of
    `monotonically_increasing_id` that the rows got when the batch came in, which is dropped; by
    it a replayed batch gets its ids again, however its stored files are dealt to tasks. Without
    it rows are numbered as they lie, which a second read may change. Call it on a stored batch;
    only one count per partition reaches the driver.
    """
    spark = df.sparkSession
    mark = F.monotonically_increasing_id() if row is None else F.col(row)
    numbered = df.withColumn("_row", mark).withColumns({
        "_part": F.shiftright("_row", 33).cast("int"), "_row": F.col("_row").bitwiseAND((1 << 33) - 1),
    })
    numbered = numbered if row is None else numbered.drop(row)
    sizes = sorted(numbered.groupBy("_part").count().collect())
    if batch_id >= 1 << 25 or sum(size for _, size in sizes) >= BATCH_IDS:
        raise OverflowError(f"batch {batch_id} does not fit the id scheme")
    starts, total = [], batch_id * BATCH_IDS
    for part, size in sizes:
        starts.append((part, total))
        total += size
    offsets = spark.createDataFrame(starts, "_part int, _start long")
    return (
        numbered.join(F.broadcast(offsets), "_part")
        .withColumn("reading_id", F.col("_start") + F.col("_row"))
        .withColumn("ingested_at", F.current_timestamp().cast("timestamp_ntz"))
        .withColumn(DAY, F.to_date("ts"))
        .drop("_part", "_row", "_start")
    )


def append_batch(df: DataFrame, path: str, batch_id: int, by_day: bool = True) -> None:
    """Write one batch under its own folder: running the batch again replaces it."""
    writer = df.write.mode("overwrite")
    if by_day:
        writer = writer.partitionBy(DAY)
    writer.parquet(f"{path}/batch_id={batch_id}")


def read_batches(spark: SparkSession, path: str, schema=None) -> DataFrame:
    reader = spark.read.option("basePath", path)
    return (reader.schema(schema) if schema else reader).parquet(f"{path}/batch_id=*")


def upserted(df: DataFrame, keys: list[str], order: str = "batch_id") -> DataFrame:
    """The row each key holds after all upserts: its latest batch wins."""
    return latest(df, keys, order)


def compact(spark: SparkSession, path: str, target: str, keys: list[str]) -> None:
    """Fold the batches of an upsert table into a new folder (never onto its own input)."""
    folded = upserted(read_batches(spark, path), keys).drop("batch_id")
    folded.write.mode("errorifexists").parquet(f"{target}/batch_id=0")


def compact_events(spark: SparkSession, path: str, target: str, rows_per_file: int = 5_000_000) -> None:
    """Rewrite small batch files into day folders of evenly sized files, sorted by time.

    The order (day, time, id) is range-partitioned, so a day with most of the rows becomes
    many files; within a file the time order lets readers skip row groups.
    """
    events = read_batches(spark, path).drop("batch_id")
    ordered = events.repartitionByRange(shuffle_width(spark), DAY, "ts", "reading_id")
    (
        ordered.sortWithinPartitions(DAY, "ts", "reading_id")
        .write.mode("errorifexists").partitionBy(DAY)
        .option("maxRecordsPerFile", rows_per_file)
        .parquet(f"{target}/batch_id=0")
    )


def newest_batches(df: DataFrame, wanted, rows: int) -> DataFrame:
    """The part of a stored table that holds its `rows` newest rows satisfying `wanted`.

    Ids are batch-major, so the newest rows are in the last batches. The span of batches is
    widened until they hold enough rows or nothing older is left; the answer stays exact.
    """
    if "batch_id" not in df.columns:
        return df
    first, last = df.agg(F.min("batch_id"), F.max("batch_id")).first()
    span = 16
    while last is not None and last - span >= first:
        part = df.where(F.col("batch_id") > last - span)
        if part.where(wanted).limit(rows).count() >= rows:
            return part
        span *= 16
    return df


def between_ts(df: DataFrame, start=None, end=None, now=None) -> DataFrame:
    """start <= ts <= end, with the day predicate that prunes partitions.

    Without an end the range ends now (`now` pins the clock), without a start it is DEFAULT_RANGE long.
    """
    clock = F.current_timestamp() if now is None else F.lit(now)
    end = (clock if end is None else F.lit(end)).cast("timestamp_ntz")
    start = end - F.expr(f"interval {DEFAULT_RANGE}") if start is None else F.lit(start).cast("timestamp_ntz")
    rows = df.where(F.col("ts").between(start, end))
    if DAY in df.columns:
        rows = rows.where(F.col(DAY).between(F.to_date(start), F.to_date(end)))
    return rows


def retained(df: DataFrame, days: int) -> DataFrame:
    """Keep the last `days` days before the newest; rows without a day stay."""
    newest = df.agg(F.max(DAY).alias("newest")).scalar()
    return df.where((F.col(DAY) > F.date_sub(newest, days)) | F.col(DAY).isNull())


def drop_expired(spark: SparkSession, path: str, days: int) -> list[str]:
    """Retention on disk: delete whole day folders, never single rows."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    store = hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    found = {}
    for status in store.globStatus(hadoop.Path(f"{path}/batch_id=*/{DAY}=*")) or []:
        folder = status.getPath()
        found[folder.toString()] = folder.getName().split("=", 1)[1]
    dated = sorted(day for day in found.values() if not day.startswith("__"))
    if not dated:
        return []
    keep_from = dt.date.fromisoformat(dated[-1]) - dt.timedelta(days=days)
    expired = sorted(
        folder for folder, day in found.items()
        if not day.startswith("__") and dt.date.fromisoformat(day) <= keep_from
    )
    for folder in expired:
        store.delete(hadoop.Path(folder), True)
    return expired


def jdbc_options(url: str, table: str, user: str, password: str, driver: str) -> dict[str, str]:
    return {"url": url, "dbtable": table, "user": user, "password": password, "driver": driver}


def write_jdbc(df: DataFrame, **options) -> None:
    """Append to a database table (its driver must be on the class path)."""
    df.write.format("jdbc").options(**jdbc_options(**options)).mode("append").save()


def read_jdbc(spark: SparkSession, partition=None, **options) -> DataFrame:
    """`partition` = (column, lower, upper, count) reads in parallel ranges."""
    reader = spark.read.format("jdbc").options(**jdbc_options(**options))
    if partition:
        names = ("partitionColumn", "lowerBound", "upperBound", "numPartitions")
        reader = reader.options(**dict(zip(names, map(str, partition))))
    return reader.load()
