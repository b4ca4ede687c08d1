"""Supplier lists by numbers from a sort by range: wide columns from the data, pages per list."""

from __future__ import annotations

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stocklens.operators.numbering import numbered
from stocklens.operators.snapshots import read_snapshot, write_snapshot
from stocklens.operators.suppliers import (
    in_order_with_suppliers,
    list_width,
    supplier_columns,
    supplier_list,
    supplier_pages,
    supplier_spread,
    supplier_wide,
    with_list_key,
    with_list_size,
    with_suppliers,
)
from stocklens.plans.deals import deal_export, deal_report, in_report_order, unordered_deal_report
from stocklens.sources.sample import AS_OF, SAMPLE_CONFIG, previous_export, sample_tables


def pairs_with_a_hot_description(spark, hot: int = 3000):
    rows = [(k, "Hot item", f"Supplier {s:05d}") for k in range(5) for s in range(hot)]
    rows += [(10, "Cold  ", "Solo"), (11, "cold", "solo"), (12, "cold", "Other"), (13, None, "Nobody"),
             (14, "No name", None), (15, "Ψάρι", "Ένας")]
    return spark.createDataFrame(rows, "item_id long, description string, supplier string")


def test_numbers_agree_with_row_number_and_split_a_hot_group(spark):
    df = spark.range(0, 20_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 50).cast("string")).alias("g"),
        F.col("id").alias("o"),
    ).union(spark.createDataFrame([(None, 1)], "g string, o long"))
    got = numbered(df, ["g"], ["o"])
    want = df.filter("g is not null").withColumn("place", F.row_number().over(W.partitionBy("g").orderBy("o")))
    assert got.exceptAll(want.select(*got.columns)).count() == 0 and got.count() == want.count()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")   # tiny data: keep its ranges apart
    try:
        ranged = df.repartitionByRange("g", "o").filter("g = 'hot'")
        assert ranged.select(F.spark_partition_id()).distinct().count() > 1   # the hot group is numbered by many tasks
        assert got.exceptAll(want.select(*got.columns)).count() == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning(g" in plan.lower()


def test_global_numbers(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("k"))
    got = sorted(tuple(r) for r in numbered(df, [], ["k"], "n").collect())
    assert got == [(k, k + 1) for k in range(1000)]


def test_wide_columns_come_from_the_data(spark):
    pairs = pairs_with_a_hot_description(spark)
    wide = supplier_wide(pairs)
    assert wide.columns == ["item_id", *[f"supplier_{i}" for i in range(1, 3001)]]
    rows = {r.item_id: r for r in wide.select("item_id", "supplier_1", "supplier_2", "supplier_3000").collect()}
    assert rows[0].supplier_1 == "Supplier 00000" and rows[0].supplier_3000 == "Supplier 02999"
    assert (rows[10].supplier_1, rows[10].supplier_2) == ("Other", "Solo") and rows[10].supplier_3000 is None
    assert rows[13].supplier_1 is None and rows[14].supplier_1 is None
    long = supplier_spread(pairs).select("description_key", "place", "supplier")
    assert long.count() == 3000 + 2 + 1


def test_wide_columns_are_read_from_one_array_in_the_order_of_places(spark):
    pairs = pairs_with_a_hot_description(spark, hot=40)
    wide = supplier_wide(pairs)
    assert "pivotfirst" not in wide._jdf.queryExecution().optimizedPlan().toString().lower()
    places = {(r.description_key, r.place): r.supplier for r in supplier_spread(pairs).collect()}
    keys = {0: "hot item", 4: "hot item", 10: "cold", 11: "cold", 12: "cold", 13: None, 14: "no name", 15: "ψαρι"}
    rows = {r.item_id: r for r in wide.collect()}
    assert len(rows) == wide.count() == 11
    for item, key in keys.items():
        assert [rows[item][f"supplier_{i}"] for i in range(1, 41)] == [places.get((key, i)) for i in range(1, 41)]


def test_width_over_the_bound_raises_and_cuts_nothing(spark):
    with pytest.raises(ValueError, match="3000 suppliers"):
        supplier_wide(pairs_with_a_hot_description(spark), max_width=2999)
    none = spark.createDataFrame([(1, "a", None)], "item_id long, description string, supplier string")
    assert supplier_wide(none).columns == ["item_id"]


def test_pages_bound_a_cell_and_grow_with_pairs(spark):
    pairs = pairs_with_a_hot_description(spark)
    lists, items = supplier_pages(pairs, page_size=100)
    got = lists.orderBy("list_id", "page").collect()
    hot = [r for r in got if r.suppliers.startswith("Supplier")]
    assert len(hot) == 30 and all(len(r.suppliers.split(", ")) == 100 for r in hot)
    assert ", ".join(r.suppliers for r in hot) == ", ".join(f"Supplier {s:05d}" for s in range(3000))
    assert sorted(r.list_id for r in got if r.page == 1) == [1, 2, 3]
    ids = {r.item_id: r.list_id for r in items.collect()}
    assert ids[10] == ids[11] and ids[13] is None and ids[14] is None and ids[0] == ids[4]
    assert len(ids) == 11


def test_what_follows_from_a_list_is_computed_once_per_list(spark):
    pairs = pairs_with_a_hot_description(spark, hot=30)
    seen = []

    def counted(lists):
        seen.append(lists.count())
        return supplier_columns(with_list_size(lists), 2)

    got = supplier_list(pairs, counted)
    assert seen == [4]   # descriptions, not the eleven items
    plain = supplier_list(pairs)
    want = supplier_columns(with_list_size(plain), 2)
    assert sorted(got.columns) == sorted(want.columns)
    assert got.select(*want.columns).exceptAll(want).count() == 0 and got.count() == want.count() == 11
    width = list_width(supplier_list(pairs, with_list_size), sizes="tokens")
    assert width.collect() == list_width(plain).collect() and width.first()[0] == 30
    optimized = width._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.index("Join") < optimized.index("split(")   # the split is below the items' join


def test_null_ids_spread_over_tasks_and_match_nothing(spark):
    from stocklens.sources.tables import left_lookup

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(0, 30_000).select(
            F.when(F.col("id") % 3 > 0, F.lit(None)).otherwise(F.col("id") % 7).alias("k"), F.col("id").alias("v")
        )
        dim = spark.createDataFrame([(k, f"n{k}") for k in range(5)] + [(None, "null id")], "k long, name string")
        got = left_lookup(rows, dim, "k")
        assert got.columns == ["k", "v", "name"]
        want = rows.join(dim, "k", "left")
        assert got.exceptAll(want).count() == 0 and got.count() == want.count() == 30_000
        tasks = got.filter("k is null").groupBy(F.spark_partition_id()).count().collect()
        assert len(tasks) >= 6 and max(r["count"] for r in tasks) < 20_000 / 4
        assert got.filter("k is null and name is not null").count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_collated_text_folds_accents_beyond_greek(spark):
    from stocklens.functions.text import collated_text, same_text, same_text_collated

    pairs = [("Café", "cafe "), ("Müller", "MULLER"), ("Straße", "strasse"), ("ΆΛΦΑ", "αλφα"), ("τέλος", "ΤΕΛΟΣ"),
             ("Café", "caffe"), (None, "x")]
    df = spark.createDataFrame(pairs, "a string, b string")
    got = [(r.c, r.t) for r in df.select(same_text_collated(F.col("a"), F.col("b")).alias("c"),
                                         same_text(F.col("a"), F.col("b")).alias("t")).collect()]
    assert [c for c, _ in got] == [True, True, True, True, True, False, None]
    assert [t for _, t in got][:3] == [False, False, False]      # the Greek table alone misses them
    keys = df.select(collated_text(F.col("a")).alias("k")).filter("k is not null").distinct().count()
    assert keys == 5


def test_collated_join_is_a_sort_merge_join(spark):
    from stocklens.functions.text import same_text_collated

    a = spark.createDataFrame([("Café",)], "x string")
    b = spark.createDataFrame([("cafe",)], "y string")
    joined = a.join(b, same_text_collated(F.col("x"), F.col("y")))
    assert joined.count() == 1
    assert "SortMergeJoin" in joined._jdf.queryExecution().executedPlan().toString()


def test_a_list_is_written_once_not_once_per_item(spark, tmp_path):
    """Items of a description stand together, so a Parquet dictionary holds their list, over 1 MB long, once."""
    import pyarrow.parquet as pq

    pairs = spark.range(3_000).select(
        (F.col("id") % 200).alias("item_id"),
        F.when(F.col("id") % 200 > 9, F.concat(F.lit("kind "), F.col("id") % 2)).alias("description"),
        F.format_string("%06d%s", F.col("id"), F.repeat(F.lit("name "), 200)).alias("supplier"),
    )
    supplier_list(pairs).write.parquet(str(tmp_path / "lists"))
    rows = spark.read.parquet(str(tmp_path / "lists")).collect()
    assert len(rows) == 200 and sum(r.suppliers is None for r in rows) == 10
    lists = {r.suppliers for r in rows if r.suppliers}
    assert len(lists) == 2 and min(map(len, lists)) > 1024 * 1024
    written = 0
    for path in (tmp_path / "lists").glob("*.parquet"):
        meta = pq.ParquetFile(path).metadata
        groups = [meta.row_group(g) for g in range(meta.num_row_groups)]
        written += sum(c.total_uncompressed_size for g in groups for c in map(g.column, range(g.num_columns))
                       if c.path_in_schema == "suppliers")
    assert written < 3 * sum(map(len, lists))


def test_a_list_of_many_items_is_attached_by_many_tasks(spark):
    """What a task takes is items times list, so the items of one description do not all go to one task."""
    from stocklens.operators.suppliers import LIST_ITEMS

    items = 5 * LIST_ITEMS
    pairs = spark.range(items).select(
        F.col("id").alias("item_id"), F.lit("Hot item").alias("description"),
        F.concat(F.lit("Supplier "), F.col("id") % 3).alias("supplier"),
    ).union(pairs_with_a_hot_description(spark, hot=3).withColumn("item_id", F.col("item_id") + items))
    # one item with two descriptions and one without any: a row for each
    two = [(0, "cold", "Solo"), (0, None, "Solo")]
    pairs = pairs.union(spark.createDataFrame(two, pairs.schema))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = supplier_list(pairs)
        hot = got.filter(F.col("suppliers").startswith("Supplier 0,"))
        tasks = hot.groupBy(F.spark_partition_id()).count().collect()
        assert len(tasks) > 1 and max(r["count"] for r in tasks) < 4 * LIST_ITEMS
        assert got.columns == ["item_id", "suppliers"] and got.count() == items + 11 + 2
        lists = {r.suppliers for r in hot.select("suppliers").distinct().collect()}
        assert lists == {"Supplier 0, Supplier 00000, Supplier 00001, Supplier 00002, Supplier 1, Supplier 2"}
        rest = got.filter("item_id = 0 or item_id > 20484").collect()
        assert sorted(str(r.suppliers) for r in rest if r.item_id == 0)[:2] == ["None", "Other, Solo"]
        assert {r.item_id - items: r.suppliers for r in rest if r.item_id - items in (10, 13, 14, 15)} == {
            10: "Other, Solo", 13: None, 14: None, 15: "Ένας"}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_no_smallest_and_largest_text_is_kept_of_lists(spark, tmp_path):
    """Keeping them compares every row's whole text twice; other columns keep them."""
    import pyarrow.parquet as pq
    from stocklens.plans.labels import labelled

    pairs = pairs_with_a_hot_description(spark, hot=3)

    def piped(lists):
        return lists.withColumn("listed", F.concat("suppliers", F.lit("|")))

    listed = supplier_list(pairs, piped)
    headed = labelled(listed, {"item_id": "Κωδικός", "suppliers": "Προμηθευτές"})
    for n, (df, texts) in enumerate([(listed, {"suppliers", "listed"}), (headed, {"Προμηθευτές"})]):
        df.write.parquet(str(tmp_path / str(n)))
        seen = {}
        for path in (tmp_path / str(n)).glob("*.parquet"):
            meta = pq.ParquetFile(path).metadata
            for g in range(meta.num_row_groups):
                for c in map(meta.row_group(g).column, range(meta.num_columns)):
                    kept = c.statistics is not None and c.statistics.has_min_max
                    seen[c.path_in_schema] = seen.get(c.path_in_schema, False) or kept
        assert {name for name, kept in seen.items() if not kept} == texts and len(seen) == len(df.columns)


# ---- sorted rows and their lists ---------------------------------------------------------------


def sorted_rows(spark, pairs):
    """Rows of the pairs' items and of one item without pairs, each three times, items far from each other."""
    items = pairs.select("item_id").distinct().union(spark.createDataFrame([(99,)], "item_id long"))
    rows = items.crossJoin(spark.range(3).select(F.col("id").alias("n")))
    rows = rows.withColumn("o", F.xxhash64("item_id", "n"))
    return with_list_key(rows, pairs).orderBy("o")


@pytest.mark.parametrize("partitions", ["1", "4", "16"])
@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_lists_meet_sorted_rows_in_their_order(spark, tmp_path, partitions, coalesce):
    pairs = pairs_with_a_hot_description(spark, hot=300)
    settings = {
        "spark.sql.shuffle.partitions": partitions,
        "spark.sql.adaptive.coalescePartitions.enabled": coalesce,
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        rows = sorted_rows(spark, pairs)
        got = in_order_with_suppliers(rows, pairs, str(tmp_path / "ordered"))
        seen = [(r.o, r.item_id, r.suppliers) for r in got.collect()]
        want = with_suppliers(rows.drop("description_key"), pairs)
        assert got.columns == ["item_id", "n", "o", "suppliers"]
        assert seen == sorted((r.o, r.item_id, r.suppliers) for r in want.collect())
        assert len(seen) == 3 * 12 and {s for _, item, s in seen if item in (13, 14, 99)} == {None}
        plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        above, below = plan.split("ShuffledHashJoin", 1)
        # nothing that carries lists by row is sorted or shuffled; the rows below are sorted
        assert "Sort" not in above and "Exchange" not in above and "SortMergeJoin" not in above
        assert "Sort [_place" in below
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_sorted_rows_without_any_row_or_list(spark, tmp_path):
    pairs = pairs_with_a_hot_description(spark, hot=3)
    none = in_order_with_suppliers(sorted_rows(spark, pairs).filter("n > 5"), pairs, str(tmp_path / "a"))
    assert none.collect() == [] and none.columns == ["item_id", "n", "o", "suppliers"]
    bare = sorted_rows(spark, pairs)
    listless = in_order_with_suppliers(bare, pairs.filter("false"), str(tmp_path / "b")).collect()
    assert [r.o for r in listless] == sorted(r.o for r in bare.collect())
    assert {r.suppliers for r in listless} == {None}


def test_the_deal_report_sorts_before_it_has_lists(spark):
    """Reports and exports come in order, though the sort is below the lists."""
    directory = "/root/testdata/sf0.001"
    t = sample_tables(spark, directory)
    want = [tuple(r) for r in in_report_order(unordered_deal_report(t, SAMPLE_CONFIG, AS_OF)).collect()]
    got = deal_report(t, SAMPLE_CONFIG, AS_OF)
    assert [tuple(r) for r in got.collect()] == want and any(r[-4] for r in want)
    export = deal_export(t, SAMPLE_CONFIG, AS_OF, previous_export(spark, directory))
    assert [r.code for r in export.collect()] == [r[0] for r in want]
    for df in (got, export):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "rangepartitioning" not in plan


def test_a_numbered_export_stands_by_its_lists(spark, tmp_path):
    """Its numbers give the output order; a file holds the lists of its descriptions, not those of all."""
    directory = "/root/testdata/sf0.001"
    t, prev = sample_tables(spark, directory), previous_export(spark, directory)
    want = [tuple(r) for r in deal_export(t, SAMPLE_CONFIG, AS_OF, prev).collect()]
    numbered = deal_export(t, SAMPLE_CONFIG, AS_OF, prev, numbered=True)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_snapshot(numbered, str(tmp_path / "first"), numbered=True)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" not in plan and "Sort [row_no" not in plan
    written = spark.read.parquet(str(tmp_path / "first"))
    got = [tuple(r) for r in written.orderBy("row_no").drop("row_no").collect()]
    assert got == want and written.select("row_no").distinct().count() == len(want)
    listed = written.filter("suppliers != ''").select(F.input_file_name().alias("f"), F.lower("description").alias("d"))
    kinds = listed.distinct()
    assert kinds.select("f").distinct().count() > 1 and kinds.select("d").distinct().count() == kinds.count() > 8


def test_an_edited_export_keeps_its_numbers_unsorted(spark, tmp_path):
    first, edited = str(tmp_path / "first"), str(tmp_path / "edited")
    rows = spark.range(100).select(F.col("id").cast("string").alias("code"), F.lit(1.0).alias("last_price"),
                                   F.lit(None).cast("double").alias("new_price"))
    write_snapshot(rows.orderBy(F.desc("code")), first)
    numbers = {r.code: r.row_no for r in read_snapshot(spark, first).collect()}
    shuffled = read_snapshot(spark, first).withColumn("new_price", F.lit(2.0)).repartition(3, "code")
    write_snapshot(shuffled, edited, numbered=True)
    assert {r.code: r.row_no for r in read_snapshot(spark, edited).collect()} == numbers
