"""Where reports are written."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

COMMITTED = "_COMMITTED"
DICTIONARY_BYTES = "parquet.dictionary.page.size"
STATISTICS = "parquet.column.statistics.enabled"


def write_full(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replace the whole target; CSV gets a header."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def long_texts_once(
    spark: SparkSession, size: int = 256 * 1024 * 1024, columns: Iterable[str] = ("suppliers",)
) -> None:
    """Let Parquet writers of the session keep up to ``size`` bytes of a column's values in its dictionary.

    By default a dictionary of over 1 MB, which one long text fills, is given up, and every row
    then holds its text whole. A file of a sorted report may show the lists of all descriptions,
    so ``size`` leaves room for them; a writer holds no more than the distinct texts of its file.
    Writers keep no smallest and largest value of ``columns``: each row's text would be compared
    with both, and Parquet does not store such values of over 4 KB anyway.
    A session that has set its own size or statistics keeps them.
    """
    settings = {DICTIONARY_BYTES: str(size), **{f"{STATISTICS}#{c}": "false" for c in columns}}
    for key, value in settings.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


def write_year(df: DataFrame, path: str, year_column: str = "report_year") -> None:
    """Replace the years present in ``df``; other years of the target stay as they are."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(year_column)
        .parquet(path)
    )


def write_counted(df: DataFrame, path: str, fmt: str = "parquet") -> int:
    """:func:`write_full` of ``df``, returning how many rows were written.

    The count is observed while the rows are written (``DataFrame.observe``): the report
    is computed once, not a second time to be counted.
    """
    seen = Observation("written")
    write_full(df.observe(seen, F.count(F.lit(1)).alias("rows")), path, fmt)
    return int(seen.get["rows"])


def _filesystem(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target, jvm


def _committed_versions(spark: SparkSession, path: str) -> list[str]:
    """Names of the committed version folders below ``path``, oldest first."""
    fs, target, jvm = _filesystem(spark, path)
    if not fs.exists(target):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(target) if status.isDirectory()]
    return sorted(
        n for n in names
        if n.startswith("v=") and fs.exists(jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{n}/{COMMITTED}"))
    )


def write_versioned(df: DataFrame, path: str, keep: int = 2) -> str:
    """Replace the table at ``path`` so that no reader ever sees half a refresh.

    The rows go to a new folder ``v=<time>-<id>`` below ``path``; only after the write job
    has succeeded is an empty ``_COMMITTED`` file created in it. :func:`read_versioned`
    reads the newest committed folder, so a failing or running write leaves the old
    version readable. Of the committed versions the newest ``keep`` stay (readers that
    resolved the one before finish); older ones are deleted. Returns the new folder.
    """
    spark = df.sparkSession
    version = f"{path.rstrip('/')}/v={time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    df.write.parquet(version)
    fs, target, jvm = _filesystem(spark, f"{version}/{COMMITTED}")
    fs.create(target, False).close()
    for old in _committed_versions(spark, path)[:-keep]:
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{old}"), True)
    return version


def read_versioned(spark: SparkSession, path: str) -> DataFrame:
    """The newest committed version written by :func:`write_versioned`; raises if none is."""
    versions = _committed_versions(spark, path)
    if not versions:
        raise FileNotFoundError(f"no committed version below {path}")
    return spark.read.parquet(f"{path.rstrip('/')}/{versions[-1]}")


class Scratch:
    """A scratch folder that one run owns: staged frames go below it, and it is deleted at the end.

    ``with Scratch(spark) as scratch:`` build a report with ``scratch=scratch`` and write or
    collect it inside the block; leaving the block deletes the folder and everything staged
    in it through the file system API, also after an error. Frames staged there cannot be
    read after the block.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = scratch_dir(spark)
        self.folders: list[str] = []

    def path(self) -> str:
        """A new folder below the root, recorded."""
        self.folders.append(f"{self.root}/{len(self.folders) + 1}")
        return self.folders[-1]

    def __enter__(self) -> "Scratch":
        return self

    def __exit__(self, *failure) -> None:
        fs, target, _ = _filesystem(self.spark, self.root)
        if fs.exists(target):
            fs.delete(target, True)


def scratch_dir(spark: SparkSession) -> str:
    """A new directory name that every executor reaches.

    Below the folder of ``spark.checkpoint.dir``; without that setting below the
    warehouse folder, which a session always has and which a cluster shares.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    base = shared or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/stocklens-{uuid.uuid4().hex}"
