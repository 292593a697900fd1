"""The wide coil source: scan, stable ids, merge, seeded order and the per-stand unfold."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import contract as C
from ..functions.columns import is_true
from ..functions.session import small_side

_FILE_NUMBER = r"_(\d+)\.[a-z]+$"


def assign_coil_ids(df: DataFrame, row_index: str = "row_index") -> DataFrame:
    """coil_id = file number × 1 000 000 + row index within the file."""
    coil_id = F.col("file_no").cast("long") * C.COIL_STRIDE + F.col(row_index)
    return df.withColumn("coil_id", coil_id)


def read_coil_parquet(spark: SparkSession, path: str, file_no: int | None = None) -> DataFrame:
    """Parquet knows each row's index in its file, so ids need no shuffle."""
    named = F.regexp_extract("_metadata.file_name", _FILE_NUMBER, 1)
    number = named.cast("int") if file_no is None else F.lit(file_no)
    return (
        spark.read.parquet(path)
        .select("*", number.alias("file_no"), F.col("_metadata.row_index").alias("row_index"))
    )


def read_coil_csv(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Scan numbered CSV files; `row_index` counts the data rows of each file.

    A file is read in blocks. Rows are numbered inside their block while scanning; the
    block offsets come from one small table (a row per block), so no row is moved to a
    single task however large one file is.
    """
    raw = (
        spark.read.schema(schema or C.wide_schema())
        .option("header", True)
        .option("columnNameOfCorruptRecord", "_unread")
        .csv(path)
        .withColumn("file", F.col("_metadata.file_name"))
        .withColumn("start", F.col("_metadata.file_block_start"))
        .withColumn("scan_no", F.monotonically_increasing_id())
    )
    blocks = raw.groupBy("file", "start").agg(
        F.min("scan_no").alias("first_no"), F.count(F.lit(1)).alias("rows")
    )
    earlier = W.partitionBy("file").orderBy("start").rowsBetween(W.unboundedPreceding, -1)
    offsets = blocks.withColumn("offset", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))
    return (
        raw.join(small_side(offsets.drop("rows")), ["file", "start"])
        .withColumn("row_index", F.col("scan_no") - F.col("first_no") + F.col("offset"))
        .withColumn("file_no", F.regexp_extract("file", _FILE_NUMBER, 1).cast("int"))
        .drop("file", "start", "scan_no", "first_no", "offset")
    )


def shuffle_key(seed: int = C.SHUFFLE_SEED):
    return F.md5(F.concat(F.col("coil_id").cast("string"), F.lit(f"|{seed}")))


def seeded_shuffle(df: DataFrame, seed: int = C.SHUFFLE_SEED) -> DataFrame:
    """A random-looking row order that the same seed always repeats."""
    return df.withColumn("shuffle_key", shuffle_key(seed)).orderBy("shuffle_key", "coil_id")


def merge_sources(parts: list[DataFrame], seed: int = C.SHUFFLE_SEED) -> DataFrame:
    """Union the numbered files, give stable ids, interleave the rows."""
    merged = reduce(lambda left, right: left.unionByName(right), parts)
    ids = ["coil_id", "file_no"]
    with_ids = assign_coil_ids(merged).drop("row_index")
    ordered = with_ids.select(*ids, *[c for c in with_ids.columns if c not in ids])
    return seeded_shuffle(ordered, seed)


def merged_source(spark: SparkSession, folder: str, merged: str, seed: int = C.SHUFFLE_SEED):
    """Read the merged table; build and store it from the raw CSV files when absent.

    `merged` may be a parquet or a CSV path. A second build never overwrites the first.
    """
    if merged.endswith(".csv"):
        schema = "coil_id LONG, file_no INT, " + C.wide_schema().toDDL()
        return spark.read.schema(schema).option("header", True).csv(merged)
    location = spark._jvm.org.apache.hadoop.fs.Path(merged)
    store = location.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(location):
        raw = read_coil_csv(spark, f"{folder}/*_dataset_*.csv")
        merge_sources([raw], seed).write.mode("errorifexists").parquet(merged)
    return spark.read.parquet(merged)


def first_coils(df: DataFrame, count: int, *order) -> DataFrame:
    """The first `count` coils in source order; 0 keeps all."""
    return df.orderBy(*order).limit(count) if count else df


def _stand_record(stand: int):
    signals = [F.col(f"{name}_{stand}").cast("double").alias(name) for name in C.STAND_SIGNALS]
    tensions = [
        F.col(f"tension_{stand - 1}").cast("double").alias("tension_in"),
        F.col(f"tension_{stand}").cast("double").alias("tension_out"),
    ]
    labels = [
        is_true(F.col(C.WIDE_LABELS[family].format(stand=stand))).alias(f"y_{family}")
        for family in C.FAMILIES
    ]
    return F.struct(F.lit(stand).alias("stand"), *signals, *tensions, *labels)


def unfold(df: DataFrame, *carry: str) -> DataFrame:
    """One wide coil becomes five per-stand rows, in one pass without a shuffle.

    Set-points are copied; the tensions before and after the stand become `tension_in` and
    `tension_out`. `carry` names further coil columns to keep, such as the emission time.
    """
    coil = ["coil_id", "file_no", *carry, *C.SET_POINTS]
    records = F.inline(F.array(*[_stand_record(stand) for stand in C.STANDS]))
    wanted = ["coil_id", "file_no", *carry, *C.FEATURES, *C.LABELS]
    return df.select(*coil, records).select(*wanted)
