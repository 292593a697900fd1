"""What the text operators share: reading tables and turning texts into words."""

from __future__ import annotations

import functools

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.session import scratch_folder, utc

# Words handled at once inside a task; keeps a task's arrays small whatever the texts' lengths.
SLICE_BYTES = 4_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(column: str, divisor: int) -> Column:
    """crc32 of the id written as text, modulo `divisor`; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % divisor


def utf8(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "replace")


def slices(texts, size=SLICE_BYTES):
    """Consecutive runs of texts (null as empty bytes) of about `size` bytes, at least one each."""
    held, weight = [], 0
    for text in texts:
        held.append(utf8(text))
        weight += len(held[-1])
        if weight >= size:
            yield held
            held, weight = [], 0
    if held:
        yield held


def run_starts(lengths) -> np.ndarray:
    """Start of each run when runs of these lengths follow one another; the total at the end."""
    return np.concatenate(([0], np.cumsum(np.asarray(lengths, dtype=np.int64))))


@functools.cache
def fold_table(letters_only: bool) -> bytes:
    """Byte table: A-Z lower-cased; with `letters_only`, ASCII other than 0-9 a-z becomes a blank."""
    out = bytearray(range(256))
    for code in range(128):
        char = chr(code).lower()
        keep = char.isdigit() or "a" <= char <= "z" or not letters_only
        out[code] = ord(char) if keep else 32
    return bytes(out)


def unused(df: DataFrame, base: str) -> str:
    """A column name that `df` does not have, also not in other case."""
    taken = {name.lower() for name in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


class Shelf:
    """Tables stored in the shared folder while an operator runs; `clear` deletes those not kept."""

    def __init__(self, spark: SparkSession):
        self.spark, self.folders = spark, []

    def put(self, df: DataFrame, keep: bool = False) -> DataFrame:
        """Write a result once and read it back; a kept one outlives the shelf."""
        folder = scratch_folder(self.spark, "shelf")
        df.write.parquet(folder)
        if not keep:
            self.folders.append(folder)
        return self.spark.read.schema(df.schema).parquet(folder)

    def clear(self) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for folder in self.folders:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)
        self.folders = []
        free_shuffles(self.spark)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that nothing refers to any more.

    It does so once the driver's collector has found them, which a large driver heap puts off.
    """
    spark._jvm.System.gc()
