"""A corpus from documents to packed sequences; each stage reads what the one before has written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rollsight.functions.session import scratch_folder
from rollsight.llm import bin_completion, decontaminate, line_chunks, resemblance, simhash_index, toxicity
from rollsight.llm.catalog import tokenizer_path
from rollsight.llm.common import remainder, table


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject."""
    labels = table(spark, sf_dir, "labels").where(remainder("doc_id", 5) != 0)
    model = toxicity.fit(toxicity.training_rows(docs, labels))
    return toxicity.not_toxic(docs, model)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without chunks of lines that stand elsewhere first."""
    return line_chunks.without_repeats(docs)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a likeness of 0.8 or more in shingles of five words.

    SimHash components come first, the exact likeness decides, and an exact join finds all other links.
    """
    return simhash_index.first_of_each(docs, resemblance.alike)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that benchmark passages do not contaminate."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents left, packed into sequences."""
    digest = {"ids_crc32": ("long", bin_completion.crc_of)}
    return bin_completion.packed(docs, tokenizer_path(), derive=digest)


STAGES = [
    ("toxicity", without_toxic),
    ("line dedup", without_repeated_lines),
    ("near duplicates", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("packing", packed),
]

# The first stage trains a classifier and the last one searches, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        folder = scratch_folder(spark, f"stage{number}")
        made = stage(spark, docs, sf_dir)
        made.write.parquet(folder)
        docs = spark.read.schema(made.schema).parquet(folder)
    return docs
