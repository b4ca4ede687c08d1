"""What several operators need: shared scratch tables, held-out folds, bounded training samples."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stocklens.sources.sinks import scratch_dir


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def written(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: the lineage ends here."""
    spark, path = df.sparkSession, scratch_dir(df.sparkSession)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fold(key: Column, folds: int) -> Column:
    """The fold of a row: crc32 of its id as text, modulo ``folds``."""
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(folds))


def training_sample(
    labels: DataFrame, label: str, is_training: Column, per_class: int
) -> DataFrame:
    """(doc_id, label) of at most ``per_class`` labelled ids of either class, in hash order.

    Rows without an id or with a label other than 0 and 1 are left out; an id with
    both labels counts as 1. The size is bounded, so callers may broadcast it.
    """
    known = (
        labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & is_training)
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("label"))
    )
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    ones = known.filter("label = 1").orderBy(*order).limit(per_class)
    return ones.unionByName(known.filter("label = 0").orderBy(*order).limit(per_class))


def texts_of(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Each Arrow batch with the Python values of one column."""
    for batch in batches:
        yield batch, batch.column(batch.schema.get_field_index(column)).to_pylist()


def rows_where(
    documents: DataFrame, text_column: str, verdicts: Callable[[list], Sequence[bool]]
) -> DataFrame:
    """The rows of ``documents`` whose text the function accepts, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in texts_of(batches, text_column):
            yield batch.filter(pa.array(verdicts(texts), pa.bool_()))

    return documents.mapInArrow(run, documents.schema)
