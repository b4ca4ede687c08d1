"""A corpus through toxicity, quality, near-duplicates and packing, each stage written and reread."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stocklens.llm.chosen_path import near_duplicates
from stocklens.llm.packing import pack
from stocklens.llm.quality import fit_quality, of_quality
from stocklens.llm.shared import fold, table, written
from stocklens.llm.toxicity import fit_toxicity, without_toxic

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
ROW = "__row"


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is not found toxic."""
    labels = table(spark, sf_dir, "labels")
    model = fit_toxicity(docs, labels, is_training=fold(F.col("doc_id"), 3) != 1)
    return without_toxic(docs.select(*COLUMNS), model)


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    labels = table(spark, sf_dir, "labels")
    model = fit_quality(docs, labels, is_training=fold(F.col("doc_id"), 5) != 0)
    return of_quality(docs.select(*COLUMNS), model)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, similarity 0.8).

    Of rows that share an id one stays as well, the one of the smallest text.
    """
    found = near_duplicates(docs)
    copies = found.filter("not kept").select("doc_id").distinct()
    single = docs.join(copies, "doc_id", "left_anti").select(*COLUMNS)
    first = W.partitionBy("doc_id").orderBy(*COLUMNS[1:])
    known = single.filter("doc_id is not null").withColumn(ROW, F.row_number().over(first))
    return (
        known.filter(F.col(ROW) == 1)
        .select(*COLUMNS)
        .unionByName(single.filter("doc_id is null"))
    )


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces in training sequences."""
    return pack(docs)


STAGES = [
    ("toxicity", clean),
    ("quality", good),
    ("near_duplicates", one_of_each),
    ("packing", packed),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
