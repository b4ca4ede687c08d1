"""What is carried from run to run, and where reports are written."""

from __future__ import annotations

import os
from datetime import date
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from stocklens.operators import snapshots as N
from stocklens.plans.deals import deal_report
from stocklens.plans.export import export_report
from stocklens.plans.retail import retail_category_share
from stocklens.plans.transfers import transfer_suggestions
from stocklens.sources.sample import AS_OF, SAMPLE_CONFIG as CFG, YEAR, read, sample_tables
from stocklens.sources.sinks import scratch_dir, write_full, write_year
from stocklens.sources.tables import load, load_tables, stage, unstage
from tests.erp import Erp, rows

SAMPLE = "/root/testdata/sf0.001"
SAMPLE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def previous(spark, *entries):
    return spark.createDataFrame(entries, N.SNAPSHOT_SCHEMA)


def test_overrides(spark):
    prev = previous(
        spark,
        (" 1 ", 10.0, 8.0, 1),
        ("2.0", 10.0, None, 2),
        ("4", 10.0, 7.0, 3),
        ("4", 11.0, None, 4),
        ("5", 12.0, None, 5),
        ("5", None, None, 6),
        (None, 99.0, 99.0, 7),
    )
    current = spark.createDataFrame(
        [("1",), ("2",), ("3",), ("4",), ("5",), (None,)], "code string"
    ).withColumns({"last_price": F.lit(1.0), "new_price": F.lit(2.0)})
    got = N.carry_forward_overrides(current, prev)
    assert rows(got, "code", "last_price", "new_price") == [
        (None, None, None),
        ("1", 8.0, None),
        ("2", 10.0, None),
        ("3", None, None),
        ("4", 7.0, None),
        ("5", None, None),
    ]


def test_new_items(spark):
    prev = previous(spark, ("001", 1.0, None, 1), ("1", 1.0, None, 2), (None, 1.0, None, 3))
    current = spark.createDataFrame([("1.0",), ("2",), (None,), ("nan",)], "code string")
    got = N.new_items(current, prev)
    assert rows(got, "code", "status") == [
        (None, None),
        ("1.0", None),
        ("2", "NEW"),
        ("nan", None),
    ]


def test_first_run_has_no_snapshot(spark):
    path = scratch_dir(spark)
    prev = N.read_snapshot(spark, path)
    current = spark.createDataFrame([("1",), (None,)], "code string")
    assert rows(N.new_items(current, prev), "code", "status") == [(None, None), ("1", "NEW")]
    got = N.carry_forward_overrides(current, prev)
    assert rows(got, "code", "last_price") == [(None, None), ("1", None)]
    write_full(previous(spark, ("1", 5.0, None, 1)), path)
    assert rows(N.read_snapshot(spark, path), "code", "last_price") == [("1", 5.0)]


def test_integers_and_flags(spark):
    df = spark.createDataFrame(
        [("12",), ("12.0",), ("-3",), ("x",), ("0",), (None,), ("9007199254740993",)], "v string"
    )
    got = [r[0] for r in N.coerce_integers(df, ["v"]).collect()]
    assert got == [12, 12, -3, None, 0, None, 9007199254740993]
    flags = [r["flagged"] for r in N.flag_positive(df, "v").collect()]
    assert flags == [True, True, False, False, False, False, True]


def test_year_slices(spark):
    path = scratch_dir(spark)

    def year(y, *values):
        df = spark.createDataFrame([(v,) for v in values], "v int")
        write_year(df.withColumn("report_year", F.lit(y)), path)

    year(2025, 1, 2)
    year(2026, 3)
    year(2026, 4, 5)
    assert rows(spark.read.parquet(path), "report_year", "v") == [
        (2025, 1),
        (2025, 2),
        (2026, 4),
        (2026, 5),
    ]


def test_full_refresh_and_csv(spark):
    path = scratch_dir(spark)
    write_full(spark.range(5), path)
    write_full(spark.range(2), path)
    assert rows(spark.read.parquet(path), "id") == [(0,), (1,)]
    csv = scratch_dir(spark)
    write_full(spark.range(2).withColumn("name", F.lit("α, β")), csv, "csv")
    assert rows(spark.read.option("header", True).csv(csv), "id", "name") == [
        ("0", "α, β"),
        ("1", "α, β"),
    ]


def test_scratch_follows_the_checkpoint_folder():
    """The setting is fixed when a session starts, so a stand-in carries it here."""
    session = SimpleNamespace(
        conf=SimpleNamespace(get=lambda k, d: {"spark.checkpoint.dir": "/shared/x/"}.get(k, d))
    )
    assert scratch_dir(session).startswith("/shared/x/stocklens-")


def test_tables_from_two_databases(spark):
    erp = Erp()
    erp.item(1, "1")
    erp.stock(1, 13, units=2.0)
    t, erp_dir, shop_dir = erp.tables(spark), scratch_dir(spark), scratch_dir(spark)
    t.items.write.parquet(f"{erp_dir}/items.parquet")
    t.stock.write.parquet(f"{shop_dir}/stock.parquet")
    found = load_tables(spark, erp_dir, shop_dir)
    assert rows(found.items, "code") == [("1",)]
    assert rows(found.stock, "unitsinstock") == [(2.0,)]
    assert rows(load(spark, erp_dir, "items"), "mtrl") == [(1,)]


def test_staging(spark):
    source = scratch_dir(spark)
    write_full(spark.range(3), source)
    staged = stage(spark.read.parquet(source), "staged_range")
    write_full(spark.range(5), source)
    assert staged.count() == 3 and spark.table("staged_range").count() == 3
    assert stage(spark.read.parquet(source)).count() == 5  # a new call sees the new input
    unstage(spark, "staged_range")
    assert not spark.catalog.tableExists("staged_range")


def test_reports_follow_their_input_and_cache_nothing(spark):
    directory = scratch_dir(spark)
    for name in SAMPLE_TABLES:
        read(spark, SAMPLE, name).write.parquet(f"{directory}/{name}.parquet")
    before = retail_category_share(sample_tables(spark, directory), CFG, YEAR)
    whole = before.agg(F.sum("quantity")).first()[0]
    half = read(spark, SAMPLE, "lineitem").filter("l_orderkey % 2 = 0")
    write_full(half, f"{directory}/lineitem.parquet")
    after = retail_category_share(sample_tables(spark, directory), CFG, YEAR)
    assert 0 < after.agg(F.sum("quantity")).first()[0] < whole
    deal_report(sample_tables(spark, directory), CFG, AS_OF).count()
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


def test_snapshot_of_a_run_is_read_by_the_next(spark):
    path = scratch_dir(spark)
    first = spark.createDataFrame([("2", 5.0, None), ("1", None, 7.0)], "code string, last_price double, new_price double")
    N.write_snapshot(first.orderBy("code"), path)
    prev = N.read_snapshot(spark, path)
    assert [r.code for r in prev.orderBy("row_no").collect()] == ["1", "2"]
    got = N.carry_forward_overrides(first, prev)
    assert rows(got, "code", "last_price", "new_price") == [("1", 7.0, None), ("2", 5.0, None)]
    unnumbered = scratch_dir(spark)
    write_full(first, unnumbered)
    with pytest.raises(Exception, match="without row_no"):
        N.carry_forward_overrides(first, N.read_snapshot(spark, unnumbered)).collect()


def test_default_period_is_today(spark):
    t = sample_tables(spark, SAMPLE)
    assert retail_category_share(t, CFG).count() == 0
    assert export_report(t, CFG).count() == 0
    today = transfer_suggestions(t, CFG, CFG.dsv, date.today())
    assert transfer_suggestions(t, CFG, CFG.dsv).count() == today.count()


def test_versioned_refresh_is_never_seen_half_done(spark, tmp_path):
    from pyspark.sql.types import LongType

    from stocklens.sources.sinks import read_versioned, write_versioned

    path = str(tmp_path / "versioned")
    with pytest.raises(FileNotFoundError):
        read_versioned(spark, path)
    write_versioned(spark.range(5), path)
    first = read_versioned(spark, path)
    assert first.count() == 5
    broken = spark.range(3).select(
        F.when(F.col("id") == 2, F.raise_error(F.lit("lost in the middle"))).otherwise(F.col("id")).cast(LongType()).alias("id")
    )
    with pytest.raises(Exception, match="lost in the middle"):
        write_versioned(broken, path)
    assert sorted(r.id for r in read_versioned(spark, path).collect()) == list(range(5))
    for n in (2, 7, 1):
        write_versioned(spark.range(n), path)
    assert read_versioned(spark, path).count() == 1
    committed = [p for p in os.listdir(path) if os.path.exists(os.path.join(path, p, "_COMMITTED"))]
    assert len(committed) == 2


def test_rows_are_counted_while_written(spark, tmp_path):
    from stocklens.sources.sinks import write_counted

    df = spark.range(0, 1000, numPartitions=4).filter("id % 3 = 0")
    assert write_counted(df, str(tmp_path / "a")) == 334
    assert spark.read.parquet(str(tmp_path / "a")).count() == 334
    empty = spark.range(0).filter("id > 0")
    assert write_counted(empty, str(tmp_path / "b")) == 0


def test_owned_scratch_is_empty_after_the_report(spark, tmp_path):
    from checks.queries import CFG
    from stocklens.sources.sample import AS_OF, sample_tables
    from stocklens.sources.sinks import Scratch

    t = sample_tables(spark, "/root/testdata/sf0.001")
    with Scratch(spark) as scratch:
        report = deal_report(t, CFG, AS_OF, scratch=scratch)
        assert len(scratch.folders) == 2
        root = scratch.root.removeprefix("file:")
        assert os.path.isdir(root)
        n = report.count()
    assert not os.path.exists(root)
    assert n == deal_report(t, CFG, AS_OF).count()
    with pytest.raises(RuntimeError):
        with Scratch(spark) as failing:
            spark.range(3).write.parquet(failing.path())
            raise RuntimeError("stop")
    assert not os.path.exists(failing.root.removeprefix("file:"))


def test_default_date_is_the_session_date(spark):
    from datetime import datetime
    from zoneinfo import ZoneInfo

    from stocklens.functions.dates import session_today

    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("Pacific/Kiritimati", "Pacific/Pago_Pago"):          # +14 and -11 hours
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert session_today(spark) == datetime.now(ZoneInfo(zone)).date()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
