"""The tables the reports read, their columns, and the ways to load them."""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stocklens.sources.sinks import Scratch, scratch_dir

# Columns each table must offer; other columns are ignored.
SCHEMAS: dict[str, str] = {
    "documents": (
        "findoc bigint, company int, sosource int, soredir int, sodtype int, fprms int, "
        "tfprms int, period int, trndate timestamp, sotime timestamp, fincode string, "
        "seriesnum int, sumamnt double, trdr bigint, branch int, finstates int, "
        "fullytransf int, iscancel int, origin int, apprv int"
    ),
    "document_stock": "findoc bigint, whouse int, whousesec int",
    "lines": (
        "findoc bigint, company int, sodtype int, mtrl bigint, whouse int, pending int, "
        "restmode int, qty double, qty1 double, qty1cov double, qty1canc double, price double, "
        "disc1prc double, lineval double, ltrnlineval double"
    ),
    "items": (
        "mtrl bigint, company int, sodtype int, code string, name string, mtrcategory int, "
        "mtrmanfctr int, relitem bigint, gweight double, pricer double, cccpartnoexp string, "
        "cccbarcodetp string"
    ),
    "partners": "trdr bigint, code string, name string, socurrency int, country int",
    "partner_extra": "trdr bigint, sodtype int",
    "categories": "mtrcategory int, name string, company int, isactive int, sodtype int",
    "makers": "mtrmanfctr int, name string, company int, isactive int",
    "warehouses": "whouse int, name string, company int",
    "branches": "branch int, name string, company int",
    "doc_types": "fprms int, name string",
    "periods": "period int, name string",
    "countries": "country int, name string",
    "states": "finstates int, name string, company int, isactive int",
    "item_costs": (
        "mtrl bigint, company int, fiscprd int, period int, purfifo double, standcost double"
    ),
    "item_month": "mtrl bigint, company int, fiscprd int, period int, salqty double",
    "item_year": "mtrl bigint, company int, fiscprd int",
    "stock": (
        "productid bigint, supplierproductid string, supplierid int, unitsinstock double, "
        "customerorderunits double, supplierorderunits double"
    ),
    "products": "productid bigint, pricetosell double",
}

# Tables of the second database (the web shop); all others are in the ERP database.
SHOP_TABLES = ("stock", "products")


class Tables:
    """The tables by name, each with the columns of :data:`SCHEMAS`; read when first asked for."""

    def __init__(self, reader: Callable[[str], DataFrame]):
        self._reader = reader

    def __getattr__(self, name: str) -> DataFrame:
        if name not in SCHEMAS:
            raise AttributeError(name)
        table = self._reader(name)
        setattr(self, name, table)
        return table


def load_tables(spark: SparkSession, erp_dir: str, shop_dir: str | None = None) -> Tables:
    """Tables from Parquet; the shop's tables may live in a directory of their own."""
    shop = shop_dir or erp_dir
    return Tables(lambda name: load(spark, shop if name in SHOP_TABLES else erp_dir, name))


def load(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """One table from Parquet, read with its declared columns."""
    return spark.read.schema(SCHEMAS[name]).parquet(os.path.join(directory, f"{name}.parquet"))


def load_catalog(spark: SparkSession, erp: str, shop: str | None = None) -> Tables:
    """Tables from the catalog.

    Stock side and lines saved with ``bucketBy(n, "findoc")`` join without a shuffle
    of their own; the header is exchanged once, by a computed key. Bucketed lines
    have no exchange, so a hot document is then not split.
    """
    schemas = {name: (shop or erp) if name in SHOP_TABLES else erp for name in SCHEMAS}
    return Tables(lambda name: spark.table(f"{schemas[name]}.{name}"))


def load_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    key: str,
    lower: int,
    upper: int,
    partitions: int,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """A table over a database connection, read by ranges of ``key`` in parallel.

    User and password belong in ``properties``, taken from the environment by
    the caller.
    """
    return spark.read.jdbc(
        url,
        table,
        column=key,
        lowerBound=lower,
        upperBound=upper,
        numPartitions=partitions,
        properties=dict(properties or {}),
    )


def empty(spark: SparkSession, schema: str | StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def of_company(df: DataFrame, company: int) -> DataFrame:
    return df.filter(F.col("company") == company)


def stage(
    df: DataFrame,
    name: str | None = None,
    scratch: Scratch | None = None,
    path: str | None = None,
) -> DataFrame:
    """Write an intermediate that several results read, under a view name if given.

    It becomes a Parquet table in the shared scratch folder and is read back: the plan
    ends there, and lost executors cost nothing that is written. Every call writes anew
    from the inputs of that moment, so nothing stale can be served; nothing is cached.
    With ``scratch`` the table goes below that owned folder and is deleted with it; with
    ``path`` it goes there.
    """
    path = path or new_folder(df.sparkSession, scratch)
    df.write.parquet(path)
    staged = df.sparkSession.read.schema(df.schema).parquet(path)
    if name:
        staged.createOrReplaceTempView(name)
    return staged


def new_folder(spark: SparkSession, scratch: Scratch | None = None) -> str:
    """A new folder name below ``scratch``, or in the shared scratch folder."""
    return scratch.path() if scratch else scratch_dir(spark)


def unstage(spark: SparkSession, name: str) -> None:
    """Drop the view of a staged intermediate; its files stay with the scratch folder."""
    if spark.catalog.tableExists(name):
        spark.catalog.dropTempView(name)


def dimension(df: DataFrame, key: str, name: str, as_key: str, as_name: str) -> DataFrame:
    """Distinct (id, name) pairs of a dimension: an id with two names stays two rows."""
    return df.select(F.col(key).alias(as_key), F.col(name).alias(as_name)).distinct()


def lookup(
    df: DataFrame, dim: DataFrame, key: str, name: str, on: str, as_: str, salt_by: Sequence[str] = ()
) -> DataFrame:
    """Add the name of an id column, NULL where the dimension lacks the id.

    No broadcast hint: a dimension under the session's broadcast threshold is
    broadcast, a larger one is joined by shuffle, NULL ids spread (:func:`left_lookup`).
    """
    return left_lookup(df, dimension(dim, key, name, on, as_), on, salt_by=salt_by)


def left_lookup(
    df: DataFrame, dim: DataFrame, on: str, spread: int = 64, *, salt_by: Sequence[str] = ()
) -> DataFrame:
    """``df`` left-joined with ``dim`` on the column ``on``, rows with a NULL ``on`` spread out.

    A NULL id matches nothing, but a shuffled join would still send all such rows to the
    task of one hash. Here they carry a salt from 1 to ``spread`` (a hash of the row), while
    every other row and the dimension carry 0: NULL rows go to ``spread`` tasks, unmatched,
    in the same single pass over ``df``. Columns and rows are those of the plain left join.
    The hash is taken over ``salt_by``, by default over all columns: then none of them can
    be pruned before the join, and every exchange below it carries them all.
    """
    hashed = F.xxhash64(*(salt_by or df.columns))
    salt = F.when(F.col(on).isNull(), F.pmod(hashed, F.lit(spread)) + 1).otherwise(F.lit(0))
    # 0 for every id, written so that the optimizer cannot fold it away from the join keys
    zero = F.when(F.col(on).isNull(), F.lit(-1)).otherwise(F.lit(0)).cast("long")
    joined = df.withColumn("_null_salt", salt).join(dim.withColumn("_null_salt", zero), [on, "_null_salt"], "left")
    return joined.drop("_null_salt")


def ambiguous_ids(dim: DataFrame, key: str, name: str) -> DataFrame:
    """Ids of a dimension that carry more than one name (they would repeat rows)."""
    return (
        dim.select(key, name)
        .distinct()
        .groupBy(key)
        .agg(F.count("*").alias("names"))
        .filter(F.col("names") > 1)
    )


def active(df: DataFrame, company: int) -> Column:
    return (df["company"] == company) & (df["isactive"] == 1)
