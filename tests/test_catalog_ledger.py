"""Catalog, published Gold, id index, ledger, retention and bounded windows."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from shoplake.operators import cleaning, kpis, ledger, quality
from shoplake.plans import streams
from shoplake.plans.catalog import GROWTH, Catalog
from shoplake.plans.lake import Lake
from shoplake.schemas import GOLD
from shoplake.session import glob_paths, path_exists, read_text, write_text
from shoplake.sinks.id_index import IdIndex
from shoplake.sinks.writers import write_landing
from shoplake.sources import tables
from shoplake.streaming import incremental, windows

from conftest import SF001
from test_storage_streaming import _ids_by_day, _tx


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _days(lake, table="revenue_by_region"):
    return {r.day: r.transaction_count for r in lake.gold(table).collect()}


# --- published together -------------------------------------------------------


def test_a_broken_publication_leaves_all_four_tables(spark, tmp_root):
    lake = Lake(spark, tmp_root)
    incremental.apply_batch(spark, lake, _tx(spark, [("a", dt.datetime(2026, 5, 1, 1), 1.0), ("b", dt.datetime(2026, 5, 2, 1), 2.0)]))
    before = {name: sorted(map(str, lake.gold(name).collect())) for name in GOLD}
    days = incremental.upsert_silver(spark, lake, _tx(spark, [("c", dt.datetime(2026, 5, 2, 2), 5.0)]))
    new = kpis.gold_tables(lake.silver_days(days))
    broken = list(GOLD)[2]
    new[broken] = new[broken].withColumn("payment_method", F.raise_error(F.lit("stop")).cast("string"))
    with pytest.raises(Exception, match="stop"):
        lake.gold_tables.publish(new, days)
    assert {name: sorted(map(str, lake.gold(name).collect())) for name in GOLD} == before
    lake.build_gold(days)  # the retry takes the number that broke off
    assert all({r.day for r in lake.gold(name).collect()} == {"01", "02"} for name in GOLD) and _days(lake) == {"01": 1, "02": 2}


def test_a_reader_keeps_its_publication_until_it_expires(spark, tmp_root):
    lake = Lake(spark, tmp_root)
    incremental.apply_batch(spark, lake, _tx(spark, [(f"t{d}", dt.datetime(2026, 5, d, 1), 1.0) for d in (1, 2, 3)]))
    old = lake.gold("revenue_by_region")
    for n in range(3):
        incremental.apply_batch(spark, lake, _tx(spark, [(f"late{n}", dt.datetime(2026, 5, 2, 2), 1.0)]))
        if n == 0:
            assert {r.day: r.transaction_count for r in old.collect()} == {"01": 1, "02": 1, "03": 1}
    assert _days(lake) == {"01": 1, "02": 4, "03": 1}
    assert {r.day for r in lake.gold("revenue_by_region", ("2026", "05", "02")).collect()} == {"02"}
    gone = lake.gold_tables.expire(keep=2)
    assert sum("revenue_by_region" in p for p in gone) == 1 and _days(lake) == {"01": 1, "02": 4, "03": 1}
    with pytest.raises(FileNotFoundError):
        Lake(spark, f"{tmp_root}/none").gold("revenue_by_region")


def test_small_files_appear_whole_and_once(spark, tmp_root):
    assert read_text(spark, f"{tmp_root}/x") is None
    write_text(spark, f"{tmp_root}/x", "één")
    with pytest.raises(FileExistsError):
        write_text(spark, f"{tmp_root}/x", "two")
    write_text(spark, f"{tmp_root}/x", "three", replace=True)
    assert read_text(spark, f"{tmp_root}/x") == "three" and len(glob_paths(spark, f"{tmp_root}/*")) == 1


# --- id index -----------------------------------------------------------------


def test_a_batch_reads_no_silver_and_does_not_shuffle_the_index(spark, tmp_root):
    lake = Lake(spark, tmp_root)
    lake.build_silver(tables.events_tx(spark, SF001))
    assert not lake.ids.exists()
    incremental.upsert_silver(spark, lake, _tx(spark, [("n1", dt.datetime(2024, 1, 3, 1), 1.0)]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(lake.ids.days_of(tables.events_tx(spark, SF001)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert "silver/transactions" not in plan and "Bucketed: true" in plan
    index_side = plan[:plan.index("Bucketed: true")].rsplit("SortMergeJoin", 1)[1]
    assert "Exchange" not in index_side
    days = {tuple(r) for r in lake.ids.days_of(spark.createDataFrame([("n1",), ("0",)], "transaction_id string")).collect()}
    want = {tuple(r) for r in lake.silver().filter("transaction_id in ('n1', '0')").select("year", "month", "day").collect()}
    assert days == want


def test_stale_index_entries_change_nothing_and_a_rebuild_drops_them(spark, tmp_root):
    lake = Lake(spark, tmp_root)
    for day in (1, 2, 3):  # the id wanders; its old days stay in the index
        incremental.upsert_silver(spark, lake, _tx(spark, [("a", dt.datetime(2026, 5, day, 1), 1.0), (f"d{day}", dt.datetime(2026, 5, day, 1), 1.0)]))
    assert _ids_by_day(lake) == [("a", "03", 1.0), ("d1", "01", 1.0), ("d2", "02", 1.0), ("d3", "03", 1.0)]
    assert lake.ids.read().filter("transaction_id = 'a'").count() == 3
    lake.ids.rebuild(lake.silver())
    assert lake.ids.read().filter("transaction_id = 'a'").count() == 1 and lake.ids.read().count() == 4
    again = IdIndex(spark, f"{tmp_root}/ops/id_index")  # as another session finds it
    assert again.exists() and again.read().count() == 4


# --- catalog ------------------------------------------------------------------


def test_tables_by_name_follow_the_lake(spark, tmp_root):
    landing = f"{tmp_root}/landing"
    write_landing(tables.clean_landing_rows(spark, SF001), landing, mode="overwrite")
    lake = Lake(spark, f"{tmp_root}/lake")
    incremental.run_incremental(spark, landing, lake, f"{tmp_root}/ckpt")
    cat = Catalog(spark, lake, landing, prefix="cat_test")
    cat.register()
    n = tables.events_tx(spark, SF001).count()
    assert cat.table("bronze").count() == cat.table("silver").count() == n
    assert cat.partitions("silver").count() == cat.partitions("bronze").count() == 30
    one_day = spark.sql("SELECT * FROM cat_test_silver.transactions WHERE year = '2024' AND month = '01' AND day = '16'")
    one_day.collect()
    assert re.search(r"PartitionFilters: \[isnotnull\(year", _plan(one_day)) and len(one_day.inputFiles()) < cat.table("silver").count()
    assert all("day=16" in f for f in one_day.inputFiles())
    before = cat.table("gold", "revenue_by_region").agg(F.sum("transaction_count")).first()[0]
    late = _tx(spark, [("late", dt.datetime(2024, 1, 16, 2), 7.0), ("new day", dt.datetime(2024, 2, 1, 2), 7.0)])
    incremental.apply_batch(spark, lake, late)
    changes = cat.refresh()
    assert changes["cat_test_silver.transactions"] == 1 and changes["cat_test_gold.revenue_by_region"] == 3
    assert cat.table("gold", "revenue_by_region").agg(F.sum("transaction_count")).first()[0] == before + 2
    assert cat.table("silver").count() == n + 2 and sum(cat.refresh().values()) == 0
    growth = cat.query(GROWTH, year="2024", month="02", before="01").collect()
    assert [(r.category, r.current_revenue, r.previous_revenue) for r in growth] == [("c", 7.0, 7.0)]


# --- ledger, counters ---------------------------------------------------------


def test_ledger_keeps_one_entry_a_run_with_its_first_errors(spark, tmp_root):
    book = ledger.Ledger(spark, tmp_root)
    rows = [("r1", "2026-05-01 03:00:00", f"t{i}", "0" if i < 7 else "1") for i in range(20)]
    rows += [("r2", "2026-05-01 09:00:00", f"t{i}", "1") for i in range(10)] + [("r3", "2026-05-02 03:00:00", "x", "1")]
    df = spark.createDataFrame(rows, "run_id string, at string, transaction_id string, quantity string").selectExpr(
        "run_id", "cast(at as timestamp_ntz) as checked_at", "transaction_id", "quantity", "'2026' as timestamp", "'s' as store_id",
        "'p' as product_id", "'1.0' as total_amount", "'c' as category", "'0' as discount_pct")
    empty = spark.createDataFrame([("r4",)], "run_id string").selectExpr("run_id", "cast('2026-05-03' as timestamp_ntz) as checked_at")
    scored = ledger.scores(quality.validate(df))
    none = ledger.scores(quality.validate(df.limit(0)), empty)
    for _ in range(2):
        book.record(scored)
        book.record(none)
    found = {r.run_id: r for r in book.read("verdicts").collect()}
    assert {k: (r.status, r.records, r.invalid_records) for k, r in found.items()} == {
        "r1": ("QUALITY_FAIL", 20, 7), "r2": ("OK", 10, 0), "r3": ("OK", 1, 0), "r4": ("NO_DATA", 0, 0)}
    assert [e.record_id for e in found["r1"].errors] == [f"t{i}" for i in range(5)] and found["r2"].errors == []
    assert "quantity" in found["r1"].errors[0].errors
    alerts = {r.run_id: r for r in book.read("alerts").collect()}
    assert set(alerts) == {"r1", "r4"} and len(alerts["r1"].errors) == 5 and alerts["r1"].checked_at == dt.datetime(2026, 5, 1, 3)
    assert book.read("metrics").count() == 8
    history = {r.run_day: (r.mean_value, r.checks) for r in book.history().collect()}
    assert history["2026-05-01"] == (pytest.approx((0.65 + 1) / 2), 2) and history["2026-05-03"] == (0.0, 1)


def test_counters_are_observed_in_the_job_that_writes(spark, tmp_root):
    typed = cleaning.type_transactions(tables.bronze_dirty(spark, SF001).drop("arrival"))
    want = cleaning.cleaning_report(typed).first().asDict()
    lake = Lake(spark, tmp_root)
    assert lake.build_silver(typed) == want
    assert lake.build_silver(typed) == want  # in place of what is there
    silver, _ = cleaning.observed_silver(typed)
    assert len(re.findall(r"FileScan parquet|Scan parquet", _plan(silver))) == len(re.findall(r"FileScan parquet|Scan parquet", _plan(cleaning.to_silver(typed))))


# --- retention ----------------------------------------------------------------


def test_expired_days_leave_silver_and_gold(spark, tmp_root):
    lake = Lake(spark, tmp_root)
    incremental.apply_batch(spark, lake, _tx(spark, [(f"t{d}", dt.datetime(2026, 5, d, 1), 1.0) for d in (1, 2, 20)]))
    assert lake.expire("2026-05-21", 10) == [("2026", "05", "01"), ("2026", "05", "02")]
    assert _ids_by_day(lake) == [("t20", "20", 1.0)] and _days(lake) == {"20": 1}
    assert not path_exists(spark, f"{lake.silver_path}/year=2026/month=05/day=01") and lake.expire("2026-05-21", 10) == []
    # a deleted id that comes again is a fresh row
    incremental.apply_batch(spark, lake, _tx(spark, [("t1", dt.datetime(2026, 5, 20, 3), 2.0)]))
    assert _days(lake) == {"20": 2}


# --- bounded windows ----------------------------------------------------------


def test_window_state_is_bounded_by_the_watermark(spark, tmp_root):
    path = f"{tmp_root}/events"
    ev = tables.table(spark, SF001, "events")
    for day in range(1, 31):  # thirty files in order of arrival
        (ev.filter(F.dayofmonth("ts") == day).coalesce(1).write.mode("append").parquet(path))
    full = ev.groupBy(F.window("ts", "1 hour").start.alias("window_start")).count()
    result, progress = streams._window_run(spark, SF001, "win1h", windows.hourly_sum, folder=path)
    assert result.count() == full.count()
    held = [n for n, _ in windows.state_rows(progress)]
    assert len(held) >= 30 and max(held) <= 80 < full.count() and sum(d for _, d in windows.state_rows(progress)) > 0.9 * full.count()
    batch = windows.hourly_sum(streams._tx_events(ev)).withColumns(
        {"window_start": F.col("w.start").cast("timestamp_ntz")}).select("window_start", "total_value")
    assert result.select("window_start", "total_value").exceptAll(batch).count() == 0


# --- evolving schema ----------------------------------------------------------


def test_types_only_widen():
    from shoplake.sources import evolution

    assert evolution.merged({}, {"a": "bigint", "timestamp": "string", "Region": "string", "n": "struct<x:bigint>"}) == {
        "a": "bigint", "n": "string"}
    held = {"a": "bigint", "b": "boolean", "c": "double"}
    assert evolution.merged(held, {"A": "double", "b": "bigint", "c": "bigint", "d e.f": "boolean"}) == {
        "a": "double", "b": "string", "c": "double", "d e.f": "boolean"}


def test_a_new_column_reaches_silver_and_survives_a_rewrite(spark, tmp_root):
    import json

    from shoplake.sources.bronze import discover_schema
    from test_storage_streaming import _land, _line, _rename_to_json

    landing, lake = f"{tmp_root}/landing", Lake(spark, f"{tmp_root}/lake")

    def land(lines):
        day = f"{landing}/year=2026/month=05/day=05"
        _land(spark, day, lines)
        _rename_to_json(spark, day)
        lake.learn(discover_schema(spark, landing))
        incremental.run_incremental(spark, landing, lake, f"{tmp_root}/ckpt")

    more = lambda line, **columns: json.dumps(json.loads(line) | columns)
    land([_line("a"), _line("b")])
    assert lake.columns() == {}
    land([more(_line("c"), promo="x", points=3, **{"odd name.1": {"k": [1]}}), _line("d")])
    assert lake.columns() == {"odd name.1": "string", "points": "bigint", "promo": "string"}
    land([more(_line("a", time="2026-05-05T11:00:00Z"), points=2.5), "not json"])  # rewrites the day; the type widens
    got = {r.transaction_id: (r.promo, r.points, r["odd name.1"]) for r in lake.silver().collect()}
    assert got == {"a": (None, 2.5, None), "b": (None, None, None), "c": ("x", 3.0, '{"k": [1]}'), "d": (None, None, None)}
    assert _days(lake) == {"05": 4} and lake.errors().count() == 1


# --- landing ------------------------------------------------------------------


def test_a_landing_batch_is_bounded_by_bytes_and_its_files_by_records(spark, tmp_root):
    from shoplake.streaming import landing

    path = f"{tmp_root}/events"
    ev = tables.table(spark, SF001, "events")
    ev.repartition(12).write.parquet(path)
    sizes = [r.length for r in spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).select("length").collect()]
    bound = 3 * max(sizes)
    rows = landing.events_stream(spark, path, "*.parquet", ev.schema, max_bytes=bound)
    query = landing.start_landing(spark, rows, tables.store_regions(spark, SF001), f"{tmp_root}/out", f"{tmp_root}/ckpt", max_records=10)
    query.awaitTermination()
    batches = [p.numInputRows for p in query.recentProgress if p.numInputRows]
    assert len(batches) >= 4 and max(batches) * 12 <= 4 * ev.count() * 1.2
    lines = spark.read.text(f"{tmp_root}/out").groupBy(F.input_file_name()).count()
    assert lines.agg(F.max("count")).first()[0] <= 10
