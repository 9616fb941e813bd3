"""Zones, safe rewrites, streaming exactly-once and the gated pipeline."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from shoplake.operators import cleaning
from shoplake.plans.lake import Lake
from shoplake.plans.pipeline import run_pipeline
from shoplake.schemas import SILVER, TX_FIELDS
from shoplake.sinks.writers import overwrite_partitions, replace_partitions, write_landing, write_partitioned
from shoplake.sources import tables
from shoplake.sources.bronze import discover_schema
from shoplake.sources.zones import read_bronze
from shoplake.streaming import incremental

from conftest import SF001


def _tx(spark, rows):
    """rows: (id, datetime, amount)"""
    full = [(i, t, "store-1", "North", "P1", "n", "c", 1, a, 0.0, a, "card", "cust-1", False) for i, t, a in rows]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in SILVER.fields[:14])
    return spark.createDataFrame(full, schema)


def _ids_by_day(lake):
    return sorted((r.transaction_id, r.day, r.total_amount) for r in lake.silver().collect())


def test_dynamic_overwrite_keeps_other_days(spark, tmp_root):
    df = spark.createDataFrame([("a", "2026", "05", "01"), ("b", "2026", "05", "02"), ("c", "2026", "05", "03")],
                               "v string, year string, month string, day string")
    write_partitioned(df, tmp_root, mode="overwrite")
    overwrite_partitions(spark.createDataFrame([("z", "2026", "05", "02")], df.schema), tmp_root)
    assert sorted(r.v for r in spark.read.parquet(tmp_root).collect()) == ["a", "c", "z"]


def test_partition_values_stay_padded_text(spark, tmp_root):
    df = spark.createDataFrame([("a", "2026", "05", "01")], "v string, year string, month string, day string")
    write_partitioned(df, tmp_root, mode="overwrite")
    r = spark.read.parquet(tmp_root)
    assert dict(r.dtypes)["month"] == "string" and r.first().month == "05"


def test_replace_reading_own_path_and_clearing_emptied_day(spark, tmp_root):
    lake = Lake(spark, tmp_root)
    incremental.upsert_silver(spark, lake, _tx(spark, [("a", dt.datetime(2026, 5, 1, 23), 1.0),
                                                       ("b", dt.datetime(2026, 5, 2, 1), 2.0)]))
    # 'a' is re-sent later and moves to day 03: day 01 becomes empty and must disappear
    incremental.upsert_silver(spark, lake, _tx(spark, [("a", dt.datetime(2026, 5, 3, 1), 5.0)]))
    assert _ids_by_day(lake) == [("a", "03", 5.0), ("b", "02", 2.0)]
    from shoplake.session import path_exists
    assert not path_exists(spark, f"{lake.silver_path}/year=2026/month=05/day=01")


def test_upsert_twice_is_a_noop(spark, tmp_root):
    lake = Lake(spark, tmp_root)
    batch = _tx(spark, [("a", dt.datetime(2026, 5, 1, 10), 1.0), ("b", dt.datetime(2026, 5, 1, 11), 2.0)])
    incremental.upsert_silver(spark, lake, batch)
    first = _ids_by_day(lake)
    incremental.upsert_silver(spark, lake, batch)
    assert _ids_by_day(lake) == first


def test_older_version_does_not_win(spark, tmp_root):
    lake = Lake(spark, tmp_root)
    incremental.upsert_silver(spark, lake, _tx(spark, [("a", dt.datetime(2026, 5, 2, 10), 2.0)]))
    incremental.upsert_silver(spark, lake, _tx(spark, [("a", dt.datetime(2026, 5, 1, 10), 1.0)]))
    assert _ids_by_day(lake) == [("a", "02", 2.0)]


def test_json_mistyped_field_is_not_corrupt(spark, tmp_root):
    p = f"{tmp_root}/j"
    spark.createDataFrame([('{"transaction_id": "t", "quantity": "zz"}',), ("not json",)], "value string") \
        .write.mode("overwrite").text(p)
    df = read_bronze(spark, p, keep_corrupt=True)
    rows = {r.transaction_id: r for r in df.collect()}
    assert rows["t"].quantity == "zz" and rows["t"]._corrupt_record is None
    assert rows[None]._corrupt_record == "not json"
    assert read_bronze(spark, p, keep_corrupt=False).count() == 1


def test_stream_equals_batch_and_rerun_is_noop(spark, tmp_root):
    landing = f"{tmp_root}/landing"
    write_landing(tables.bronze_dirty(spark, SF001), landing, mode="overwrite")
    batch = cleaning.bronze_to_silver(read_bronze(spark, landing))
    lake = Lake(spark, f"{tmp_root}/lake")
    ckpt = f"{tmp_root}/ckpt"
    incremental.run_incremental(spark, landing, lake, ckpt, max_files_per_trigger=3)
    got = lake.silver().select(*TX_FIELDS, "year", "month", "day")
    assert got.exceptAll(batch).count() == 0 and batch.exceptAll(got).count() == 0
    n = got.count()
    incremental.run_incremental(spark, landing, lake, ckpt, max_files_per_trigger=3)
    assert lake.silver().count() == n


def test_schema_discovery_sees_new_column(spark, tmp_root):
    p = f"{tmp_root}/drift"
    a = spark.createDataFrame([("t1", "2026", "05", "01")], "transaction_id string, year string, month string, day string")
    b = spark.createDataFrame([("t2", "x", "2026", "05", "02")],
                              "transaction_id string, promo string, year string, month string, day string")
    write_partitioned(a, p, mode="append", compression="none") if False else a.write.partitionBy("year", "month", "day").json(p)
    b.write.mode("append").partitionBy("year", "month", "day").json(p)
    out = {r.column_name: (r.data_type, r.partitions) for r in discover_schema(spark, p).collect()}
    assert out == {"promo": ("string", 1), "transaction_id": ("string", 2)}


def test_pipeline_gate_blocks_bad_input_and_runs_good(spark, tmp_root):
    bad_landing, good_landing = f"{tmp_root}/bad", f"{tmp_root}/good"
    write_landing(tables.bronze_dirty(spark, SF001), bad_landing, mode="overwrite")
    write_landing(tables.clean_landing_rows(spark, SF001), good_landing, mode="overwrite")
    bad_lake = Lake(spark, f"{tmp_root}/bad_lake")
    r = run_pipeline(spark, bad_landing, bad_lake, "2000-01-01T00:00:00", ("2024", "01"))
    from shoplake.session import path_exists
    assert r.status == "QUALITY_FAIL" and not path_exists(spark, bad_lake.silver_path)
    assert spark.read.parquet(f"{bad_lake.root}/ops/alerts").count() == 1
    good_lake = Lake(spark, f"{tmp_root}/good_lake")
    r = run_pipeline(spark, good_landing, good_lake, "2000-01-01T00:00:00", ("2024", "01"))
    assert r.status == "OK" and r.quality_score == 1.0
    assert good_lake.silver().count() == tables.events_tx(spark, SF001).count()
    assert set(r.results) == {"monthly_category_revenue", "monthly_region_performance", "transaction_trend"}
    empty = run_pipeline(spark, good_landing, Lake(spark, f"{tmp_root}/e"), "2100-01-01T00:00:00", ("2024", "01"))
    assert empty.status == "NO_DATA"


def test_serving_copy_is_cached(spark, tmp_root):
    from shoplake.plans.serving import serve
    lake = Lake(spark, tmp_root)
    incremental.apply_batch(spark, lake, _tx(spark, [(f"t{d}", dt.datetime(2026, 5, d, 1), 1.0) for d in (1, 2, 3)]))
    copy = serve(spark, lake, prefix="srv_")
    count = lambda: spark.table("srv_gold_revenue_by_region").agg(F.sum("transaction_count")).first()[0]
    assert copy.cached and spark.catalog.isCached("srv_gold_revenue_by_region") and count() == 3 and not copy.refresh()
    incremental.apply_batch(spark, lake, _tx(spark, [("late", dt.datetime(2026, 5, 2, 2), 1.0)]))
    assert copy.refresh() and spark.catalog.isCached("srv_gold_revenue_by_region") and count() == 4
    copy.stop()
    assert not spark.catalog.tableExists("srv_gold_revenue_by_region")
    big = serve(spark, lake, max_bytes=10, prefix="srv_")
    assert not big.cached and not spark.catalog.isCached("srv_gold_revenue_by_region") and count() == 4
    big.stop()


def test_jobs_entry_point(spark, tmp_root):
    from shoplake import jobs
    landing = f"{tmp_root}/landing"
    write_landing(tables.clean_landing_rows(spark, SF001), landing, mode="overwrite")
    lake_root = f"{tmp_root}/lake"
    assert jobs.main(["quality-check", "--bronze", landing]) == 0
    assert jobs.main(["bronze-to-silver", "--bronze", landing, "--lake", lake_root]) == 0
    assert jobs.main(["silver-to-gold", "--lake", lake_root]) == 0
    assert jobs.main(["report", "monthly_category_revenue", "--lake", lake_root, "--year", "2024", "--month", "01",
                      "--out", f"{tmp_root}/results"]) == 0
    assert spark.read.parquet(f"{tmp_root}/results/monthly_category_revenue").count() == 5
    assert jobs.main(["silver-to-gold", "--lake", lake_root, "--days", "2024-01-05"]) == 0


def test_gate_reads_only_new_files(spark, tmp_root):
    import time
    from datetime import datetime, timezone
    landing = f"{tmp_root}/landing"
    write_landing(tables.bronze_dirty(spark, SF001), landing, mode="overwrite")  # old, dirty
    time.sleep(2)
    cut = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S")
    time.sleep(2)
    write_landing(tables.clean_landing_rows(spark, SF001), landing, mode="append")  # new, clean
    assert read_bronze(spark, landing, modified_after=cut).count() == tables.events_tx(spark, SF001).count()
    r = run_pipeline(spark, landing, Lake(spark, f"{tmp_root}/lake"), cut, ("2024", "01"))
    assert r.status == "OK"
    # the files before the cut-off are set aside, not let in unchecked
    lake = Lake(spark, f"{tmp_root}/lake")
    clean = cleaning.bronze_to_silver(read_bronze(spark, landing, modified_after=cut))
    assert lake.silver().count() == clean.count()
    assert spark.read.parquet(f"{lake.root}/quarantine").count() == tables.bronze_dirty(spark, SF001).count()


def _line(i, day=5, quantity=1, amount=3.5, time=None):
    return json.dumps({"transaction_id": i, "timestamp": time or f"2026-05-{day:02d}T10:00:00Z", "store_id": "s", "region": "North",
                       "product_id": "p", "product_name": "n", "category": "c", "quantity": quantity, "unit_price": amount,
                       "discount_pct": 0.0, "total_amount": amount, "payment_method": "card", "customer_id": "u", "is_return": False})


def _land(spark, path, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").format("text") \
        .option("compression", "none").save(path)


def test_failed_batch_never_enters_later(spark, tmp_root):
    landing, lake = f"{tmp_root}/landing", Lake(spark, f"{tmp_root}/lake")
    day = f"{landing}/year=2026/month=05/day=05"
    _land(spark, day, [_line(f"bad{i}", quantity=0) for i in range(10)])
    _rename_to_json(spark, day)
    assert run_pipeline(spark, landing, lake, "2000-01-01T00:00:00", ("2026", "05")).status == "QUALITY_FAIL"
    _land(spark, day, [_line(f"good{i}") for i in range(10)])
    _rename_to_json(spark, day)
    r = run_pipeline(spark, landing, lake, "2000-01-01T00:00:00", ("2026", "05"))
    assert (r.status, r.records) == ("OK", 10)
    assert sorted(x.transaction_id for x in lake.silver().collect()) == [f"good{i}" for i in range(10)]
    assert spark.read.parquet(f"{lake.root}/quarantine").count() == 10


def _rename_to_json(spark, path):
    """Text part files get the suffix of landing files."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for s in fs.listStatus(root):
        if s.getPath().getName().endswith(".txt"):
            fs.rename(s.getPath(), jvm.org.apache.hadoop.fs.Path(root, s.getPath().getName()[:-4] + ".json"))


def test_every_landing_line_is_accounted_for(spark, tmp_root):
    landing, lake = f"{tmp_root}/landing", Lake(spark, f"{tmp_root}/lake")
    _land(spark, landing, [_line("a"), _line("a"), _line("b"), '{"transaction_id": "c", "total', "not json",
                           _line("d", time="soon"), _line("e", amount=-1), _line("f", amount=1e300), _line(None)])
    for _ in range(2):  # a second run takes nothing twice
        incremental.run_incremental(spark, landing, lake, f"{tmp_root}/ckpt")
        errors = {r.error_type: r["count"] for r in lake.errors().groupBy("error_type").count().collect()}
        assert errors == {"corrupt_record": 2, "bad_timestamp": 1, "invalid_amount": 2, "missing_field": 1}
        assert sorted(r.transaction_id for r in lake.silver().collect()) == ["a", "b"]
    kept = {r._corrupt_record for r in lake.errors().filter("error_type = 'corrupt_record'").collect()}
    assert kept == {'{"transaction_id": "c", "total', "not json"}
    # the same as one full load
    full = Lake(spark, f"{tmp_root}/full")
    full.write_errors(read_bronze(spark, landing, keep_corrupt=True), "source=full/batch=0")
    assert full.errors().count() == 6


def test_retry_after_silver_rebuilds_the_day_an_id_left(spark, tmp_root, monkeypatch):
    lake, journal = Lake(spark, tmp_root), f"{tmp_root}/ops/days"
    incremental.apply_batch(spark, lake, _tx(spark, [("a", dt.datetime(2026, 5, 5, 1), 1.0), ("x", dt.datetime(2026, 5, 5, 1), 2.0)]))
    moved = _tx(spark, [("x", dt.datetime(2026, 5, 6, 1), 2.0)])
    with monkeypatch.context() as m:
        m.setattr(incremental, "rebuild_gold", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            incremental.apply_batch(spark, lake, moved, journal)
    incremental.apply_batch(spark, lake, moved, journal)
    gold = {r.day: r.transaction_count for r in lake.gold("revenue_by_region").collect()}
    assert _ids_by_day(lake) == [("a", "05", 1.0), ("x", "06", 2.0)] and gold == {"05": 1, "06": 1}


def test_run_after_a_missed_day_takes_that_day(spark, tmp_root):
    import time
    from datetime import datetime, timezone
    landing, lake = f"{tmp_root}/landing", Lake(spark, f"{tmp_root}/lake")
    for day, cut_here in ((5, False), (6, True)):
        if cut_here:
            time.sleep(2)
            cut = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S")
            time.sleep(2)
        _land(spark, f"{landing}/year=2026/month=05/day=0{day}", [_line(f"d{day}-{i}", day=day) for i in range(3)])
        _rename_to_json(spark, f"{landing}/year=2026/month=05/day=0{day}")
    r = run_pipeline(spark, landing, lake, cut, ("2026", "05"))
    assert (r.status, r.records, r.older) == ("OK", 3, [("OK", 1.0, 3)])
    assert sorted(x.transaction_id for x in lake.silver().collect()) == [f"d{d}-{i}" for d in (5, 6) for i in range(3)]
    assert {x.day: x.transaction_count for x in lake.gold("revenue_by_region").collect()} == {"05": 3, "06": 3}
    from shoplake.session import path_exists
    assert not path_exists(spark, f"{lake.root}/quarantine")


def test_full_rebuild_clears_dead_days(spark, tmp_root):
    lake = Lake(spark, tmp_root)
    for day in (15, 16):
        lake.build_silver(_tx(spark, [("a", dt.datetime(2026, 5, day, 1), 1.0)]))
        lake.build_gold()
    assert _ids_by_day(lake) == [("a", "16", 1.0)]
    for name in ("revenue_by_product", "revenue_by_region", "payment_method_split", "top_products"):
        assert [r.day for r in lake.gold(name).collect()] == ["16"]
