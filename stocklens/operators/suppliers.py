"""Which suppliers an item was bought from."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stocklens.config import ReportConfig
from stocklens.functions.text import in_texts, split_list, text_key
from stocklens.operators.lines import document_lines, is_purchase
from stocklens.operators.numbering import numbered
from stocklens.sources.sinks import long_texts_once
from stocklens.sources.tables import Tables, left_lookup, stage

# Items of one description that get their list in one task; more are dealt over several.
LIST_ITEMS = 4096


def item_suppliers(
    t: Tables, cfg: ReportConfig, *, exclude: tuple[str, ...] = (), exclude_type: bool = True
) -> DataFrame:
    """:func:`named_suppliers` of all purchase lines."""
    where = is_purchase(cfg)
    if exclude_type:
        where &= F.col("fprms") != cfg.excluded_purchase_type
    return named_suppliers(document_lines(t, cfg, where, warehouse=False), t, exclude=exclude)


def named_suppliers(
    bought: DataFrame, t: Tables, *, exclude: tuple[str, ...] = ()
) -> DataFrame:
    """Distinct (item, description, supplier) of purchases given by ``item_id`` and ``partner_id``.

    Ids are made distinct before names are looked up, so the lookups meet one row
    per item and supplier. With ``exclude``, purchases from these companies and
    from unnamed suppliers are left out.
    """
    pairs = bought.select("item_id", "partner_id").distinct()
    partners = t.partners.select(
        F.col("trdr").alias("partner_id"), F.col("name").alias("supplier")
    )
    named = pairs.join(partners, "partner_id", "left")
    if exclude:
        named = named.filter(~in_texts(F.col("supplier"), exclude))
    items = t.items.select(F.col("mtrl").alias("item_id"), F.col("name").alias("description"))
    return named.join(items, "item_id", "inner").select("item_id", "description", "supplier")


def with_suppliers(
    rows: DataFrame, pairs: DataFrame, per_list: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Add to rows with an ``item_id`` the suppliers of all items with its description.

    ``pairs`` comes from :func:`item_suppliers`. The list is NULL for items that
    are not among the pairs, for items without a description, and where no supplier
    has a name. Rows meet their description first and its list last: the lists,
    one per description, may be long, and are not carried once per item through
    a shuffle. ``per_list`` adds columns to the frame of lists (column ``suppliers``):
    what follows from a list is computed once per list, not once per item.

    Lists are attached by a sort-merge join, also where they are small enough to be
    broadcast: items of one description then stand next to each other, and a Parquet
    file of them, whose dictionary holds :func:`long_texts_once`, keeps a list once
    instead of once per item. What a task takes is items times list, so a description
    with more than ``LIST_ITEMS`` items is dealt over several tasks, and its list sent to
    each. Items without a description are spread as by :func:`left_lookup`.
    """
    return with_lists(with_list_part(rows, pairs), pairs, per_list)


def with_list_part(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """Add to rows with an ``item_id`` the key of their list and of their part of its items, NULL without a list."""
    items = _keyed(pairs).select("item_id", "description_key").distinct()
    dealt = left_lookup(items, _parts(pairs), "description_key", salt_by=("item_id",))
    part = F.pmod(F.xxhash64("item_id"), F.col("_parts")).cast("int")
    return rows.join(dealt.select("item_id", _list_part(part)), "item_id", "left")


def with_lists(
    found: DataFrame, pairs: DataFrame, per_list: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Attach the lists to rows that have their :func:`with_list_part`, as :func:`with_suppliers` does."""
    lists = _lists(pairs)
    if per_list:
        lists = per_list(lists)
    long_texts_once(found.sparkSession, columns=_texts(lists.drop("description_key")))
    sent = lists.join(_parts(pairs), "description_key").withColumn(
        "_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))
    )
    sent = sent.select(_list_part(F.col("_part")), *lists.drop("description_key").columns)
    listed = left_lookup(found, sent.hint("merge"), "_list", salt_by=("item_id",))
    return listed.drop("_list")


def _parts(pairs: DataFrame) -> DataFrame:
    """Over how many tasks the items of each description are dealt."""
    items = _keyed(pairs).filter("description_key is not null").select("item_id", "description_key")
    return items.distinct().groupBy("description_key").agg(
        F.ceil(F.count(F.lit(1)) / LIST_ITEMS).cast("int").alias("_parts")
    )


def _list_part(part: Column) -> Column:
    """Join key of a list and one of its parts of items; NULL without a description."""
    key = F.struct(F.col("description_key"), part.alias("part"))
    return F.when(F.col("description_key").isNotNull(), key).alias("_list")


def _texts(df: DataFrame) -> list[str]:
    return [name for name, kind in df.dtypes if kind == "string"]


def with_list_key(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """Add to rows with an ``item_id`` the ``description_key`` of their list, NULL for items not among the pairs."""
    items = _keyed(pairs).select("item_id", "description_key").distinct()
    return rows.join(items, "item_id", "left")


def in_order_with_suppliers(ordered: DataFrame, pairs: DataFrame, path: str) -> DataFrame:
    """Add the lists to sorted rows that have their :func:`with_list_key`; their order stays.

    A sort of rows that carry their lists shuffles and spills rows times list. Here the rows
    are sorted without lists and staged below ``path`` with their range (the task of the sort)
    and their place. Every range is then sent each list that its rows show once, not once per
    row, and the two meet in a hash join that keeps the order of the rows. A task holds the
    distinct lists of one range; a shuffle carries at most ranges times lists.

    Spark drops the last sort, as the join keeps the order; it sorts where a session ignores
    join hints. The check of a row's task stands above the join because a session may deal
    both sides anew (``spark.sql.requireAllClusterKeysForDistribution``): the order would be
    lost, so it raises. It stands below the join as well because Spark drops sorts that only
    plain columns and filters part from a join.
    """
    spark = ordered.sparkSession
    long_texts_once(spark)
    placed = ordered.withColumns(
        {"_range": F.spark_partition_id(), "_place": F.monotonically_increasing_id()}
    )
    rows = stage(placed, path=path)
    # one partition would be joined as an unpartitioned side, dealt anew by hash
    ranges = max(2, (rows.agg(F.max("_range")).first()[0] or 0) + 1)
    shown = rows.select("_range", "description_key").filter("description_key is not null").distinct()
    lists = _lists(pairs).join(shown, "description_key").repartitionById(ranges, "_range")
    elsewhere = F.raise_error(F.lit("a sorted row is not in the task of its range"))
    in_place = F.when(F.spark_partition_id() == F.col("_range"), F.lit(True)).otherwise(
        elsewhere.cast("boolean")
    )
    dealt = rows.repartitionById(ranges, "_range").sortWithinPartitions("_place").filter(in_place)
    listed = dealt.join(lists.hint("shuffle_hash"), ["_range", "description_key"], "left")
    kept = listed.filter(in_place).sortWithinPartitions("_place")
    return kept.drop("_range", "_place", "description_key")


def supplier_list(
    pairs: DataFrame, per_list: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Every item among the pairs with its list of suppliers; ``per_list`` as in :func:`with_suppliers`."""
    return with_suppliers(pairs.select("item_id").distinct(), pairs, per_list)


def _keyed(pairs: DataFrame) -> DataFrame:
    return pairs.withColumn("description_key", text_key(F.col("description")))


def _lists(pairs: DataFrame) -> DataFrame:
    """One comma list per description, NULL when none of its suppliers has a name.

    Names are made distinct before they are gathered; gathering skips NULL. A filter
    on the name would reach below the distinct pairs, whose exchange is then no longer
    the one the caller's other use of the pairs has, and the lines be read twice.
    """
    names = (
        _keyed(pairs)
        .filter(F.col("description_key").isNotNull())
        .groupBy("description_key", text_key(F.col("supplier")).alias("supplier_key"))
        .agg(F.min("supplier").alias("supplier"))
    )
    listed = F.array_join(F.array_sort(F.collect_list("supplier")), ", ")
    return names.groupBy("description_key").agg(F.nullif(listed, F.lit("")).alias("suppliers"))


def with_list_size(
    df: DataFrame, name: str = "tokens", column: str = "suppliers"
) -> DataFrame:
    """Add the number of names in each list, NULL without a list."""
    return df.withColumn(name, F.size(split_list(F.col(column))))


def list_width(df: DataFrame, column: str = "suppliers", sizes: str | None = None) -> DataFrame:
    """Length of the longest list, as one row; from the column ``sizes`` where lists are counted already."""
    size = F.col(sizes) if sizes else F.size(split_list(F.col(column)))
    return df.agg(F.coalesce(F.max(size), F.lit(0)).alias("max_tokens"))


def supplier_columns(
    df: DataFrame, n: int, column: str = "suppliers", *, keep: bool = True, drop_empty: bool = True
) -> DataFrame:
    """The list spread over ``supplier_1`` … ``supplier_n``; ``keep`` keeps the list as well.

    Without the list no token may be lost: a row with more than ``n`` tokens then raises.
    """
    tokens = split_list(F.col(column), drop_empty)
    wide = df.select(
        "*", *[F.get(tokens, F.lit(i)).alias(f"supplier_{i + 1}") for i in range(n)]
    )
    if keep:
        return wide
    lost = F.raise_error(F.concat(F.lit(f"more than {n} suppliers: "), F.col(column)))
    first = F.when(F.size(tokens) > n, lost).otherwise(F.get(tokens, F.lit(0)))
    return wide.withColumn("supplier_1", first).drop(column) if n else wide


def supplier_spread(pairs: DataFrame) -> DataFrame:
    """The complete lists in long form: one row per description and supplier, with its place.

    Made from the distinct pairs, never from a gathered text, so it grows with the pairs;
    the distinct (item_id, description) of ``pairs`` leads from items to their list.
    """
    names = (
        pairs.select(
            text_key(F.col("description")).alias("description_key"),
            text_key(F.col("supplier")).alias("supplier_key"),
            "supplier",
        )
        .filter("description_key is not null and supplier is not null")
        .groupBy("description_key", "supplier_key")
        .agg(F.min("supplier").alias("supplier"))
    )
    place = F.row_number().over(W.partitionBy("description_key").orderBy("supplier"))
    return names.select("description_key", place.alias("place"), "supplier")


def _named(pairs: DataFrame) -> DataFrame:
    """Distinct (description_key, supplier) with a name and a description, one spelling per supplier."""
    return (
        pairs.select(
            text_key(F.col("description")).alias("description_key"),
            text_key(F.col("supplier")).alias("supplier_key"),
            "supplier",
        )
        .filter("description_key is not null and supplier is not null")
        .groupBy("description_key", "supplier_key")
        .agg(F.min("supplier").alias("supplier"))
    )


def supplier_places(pairs: DataFrame) -> DataFrame:
    """:func:`supplier_spread` numbered by a sort by range: a description with very many
    suppliers is numbered by many tasks, not by one window task."""
    return numbered(_named(pairs), ["description_key"], ["supplier"]).select(
        "description_key", "place", "supplier"
    )


def supplier_wide(pairs: DataFrame, max_width: int = 16_000) -> DataFrame:
    """One row per item of ``pairs`` with ``supplier_1`` … ``supplier_n``, n the longest list.

    The width comes from the data: one aggregation finds the largest place; a description's
    names then become one array in the order of their places, items meet that one column,
    and the columns are read from it by position (a pivot makes an aggregate and a join of
    n columns). No list text is built or kept. Items without
    a named supplier or without a description have NULL in every column; without any
    supplier at all there are no supplier columns. A width above ``max_width`` (a
    spreadsheet holds about 16,000 columns) raises instead of cutting the list.
    """
    places = supplier_places(pairs)
    width = places.agg(F.max("place")).first()[0] or 0
    if width > max_width:
        raise ValueError(f"{width} suppliers for one description, more than {max_width} columns")
    items = pairs.select("item_id", text_key(F.col("description")).alias("description_key")).distinct()
    if width == 0:
        return items.select("item_id")
    named = F.transform(
        F.array_sort(F.collect_list(F.struct("place", "supplier"))), lambda x: x["supplier"]
    )
    lists = places.groupBy("description_key").agg(named.alias("_names"))
    columns = [F.get("_names", F.lit(i)).alias(f"supplier_{i + 1}") for i in range(width)]
    return items.join(lists, "description_key", "left").select("item_id", *columns)


def supplier_pages(pairs: DataFrame, page_size: int = 50) -> tuple[DataFrame, DataFrame]:
    """Supplier lists encoded once per description: (lists, items).

    ``lists`` holds (list_id, page, suppliers): list_id numbers the descriptions in order of
    their key, from 1; page p (from 1) holds the comma list of places (p - 1) * page_size + 1
    to p * page_size. ``items`` holds (item_id, list_id), NULL for items whose description
    has no named supplier. Bytes grow with the distinct (description, supplier) pairs, not
    with items times suppliers, and no cell holds more than ``page_size`` names. Numbers
    come from sorts by range, so neither a long list nor the list of descriptions is
    numbered in one task.
    """
    places = supplier_places(pairs)
    ids = numbered(places.select("description_key").distinct(), [], ["description_key"], "list_id")
    pages = places.join(ids, "description_key").withColumn(
        "page", (F.floor((F.col("place") - 1) / page_size) + 1).cast("int")
    )
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "supplier"))),
                                      lambda x: x["supplier"]), ", ")
    lists = pages.groupBy("list_id", "page").agg(listed.alias("suppliers"))
    items = (
        pairs.select("item_id", text_key(F.col("description")).alias("description_key")).distinct()
        .join(ids, "description_key", "left")
        .select("item_id", "list_id")
    )
    return lists, items


def supplier_rows(df: DataFrame, column: str = "suppliers") -> DataFrame:
    """The list in long form: one row per supplier with its position from 1."""
    tokens = split_list(F.col(column))
    spread = df.select("*", F.posexplode(tokens).alias("place", "supplier"))
    return spread.withColumn("place", F.col("place") + 1).drop(column)
