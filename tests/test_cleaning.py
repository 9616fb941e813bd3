"""Silver helpers on inline rows (the reference's unit tests plus hazards H1-H1d)."""

import datetime as dt

from pyspark.sql import functions as F

from shoplake.functions.timeparse import utc_instant
from shoplake.operators import cleaning
from shoplake.schemas import TX_FIELDS


def _bronze(spark, rows):
    cols = ["transaction_id", "timestamp", "store_id", "product_id", "total_amount"]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols))


def test_drop_nulls_removes_bad_rows(spark):
    df = _bronze(spark, [("tx-1", "2026-05-16T10:00:00Z", "store-001", "P001", "99.9"),
                         (None, "2026-05-16T10:01:00Z", "store-002", "P002", "49.9")])
    assert cleaning.drop_critical_nulls(cleaning.type_transactions(df)).count() == 1


def test_valid_amounts_strictly_positive_and_not_nan(spark):
    df = spark.createDataFrame([("a", 99.9), ("b", 0.0), ("c", -5.0), ("d", 10.0), ("e", float("nan"))],
                               "transaction_id string, total_amount double")
    assert sorted(r[0] for r in cleaning.valid_amounts(df).collect()) == ["a", "d"]


def test_date_partitions_are_zero_padded_strings(spark):
    df = spark.createDataFrame([("tx-1", dt.datetime(2026, 5, 16, 14, 30))], "transaction_id string, timestamp timestamp_ntz")
    r = cleaning.add_date_partitions(df).first()
    assert (r.year, r.month, r.day) == ("2026", "05", "16")


def test_timestamp_parse_both_forms_and_offsets_independent_of_session_tz(spark):
    df = spark.createDataFrame([("2026-05-16T14:30:00Z",), ("2026-05-16T14:30:00.123456Z",),
                                ("2026-05-16T16:30:00+02:00",), ("not-a-time",)], "timestamp string")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            got = [r[0] for r in cleaning.type_transactions(df).select("timestamp").collect()]
            assert got == [dt.datetime(2026, 5, 16, 14, 30), dt.datetime(2026, 5, 16, 14, 30, 0, 123456),
                           dt.datetime(2026, 5, 16, 14, 30), None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_repeated_hour_of_a_dst_change(spark):
    """Both readings of the hour that a zone runs twice keep their own UTC time, from text and from instants."""
    df = spark.createDataFrame([("2026-11-01T05:30:00Z",), ("2026-11-01T06:30:00Z",), ("1969-12-31T23:59:59.999999Z",)],
                               "timestamp string")
    want = [dt.datetime(2026, 11, 1, 5, 30), dt.datetime(2026, 11, 1, 6, 30), dt.datetime(1969, 12, 31, 23, 59, 59, 999999)]
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        typed = cleaning.type_transactions(df).select("timestamp")
        assert [r[0] for r in typed.collect()] == want
        again = cleaning.type_transactions(typed.select(utc_instant(F.col("timestamp")).alias("timestamp")))
        assert [r[0] for r in again.select("timestamp").collect()] == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_non_numeric_amount_text_does_not_abort(spark):
    df = _bronze(spark, [("a", "2026-05-16T10:00:00Z", "s", "p", "abc"), ("b", "2026-05-16T10:00:00Z", "s", "p", "5")])
    silver = cleaning.bronze_to_silver(df)
    assert [r.transaction_id for r in silver.collect()] == ["b"]


def test_dedup_keeps_latest_version(spark):
    rows = [("tx-1", dt.datetime(2026, 5, 16, 10), "store-001", "P1", 10.0),
            ("tx-1", dt.datetime(2026, 5, 16, 12), "store-001", "P1", 11.0),
            ("tx-2", dt.datetime(2026, 5, 16, 9), "store-002", "P2", 20.0)]
    df = spark.createDataFrame(rows, "transaction_id string, timestamp timestamp_ntz, store_id string, "
                                     "product_id string, total_amount double")
    out = {r.transaction_id: r.total_amount for r in cleaning.dedup_latest(df).collect()}
    assert out == {"tx-1": 11.0, "tx-2": 20.0}


def test_dedup_is_an_aggregate_not_a_window(spark):
    df = spark.createDataFrame([("a", dt.datetime(2026, 1, 1), "s", "p", 1.0)],
                               "transaction_id string, timestamp timestamp_ntz, store_id string, product_id string, "
                               "total_amount double")
    plan = cleaning.dedup_latest(df)._jdf.queryExecution().executedPlan().toString()
    # map-side combine: the partial max runs before the shuffle, so a hot key is
    # reduced in every task; no window sorts a whole key in one task
    assert "Window" not in plan
    assert plan.index("partial_max") > plan.index("Exchange hashpartitioning(transaction_id")


def test_cleaning_report_counts(spark):
    df = _bronze(spark, [("a", "2026-05-16T10:00:00Z", "s", "p", "5"), ("a", "2026-05-16T11:00:00Z", "s", "p", "6"),
                         ("b", "2026-05-16T10:00:00Z", None, "p", "5"), ("c", "2026-05-16T10:00:00Z", "s", "p", "0")])
    r = cleaning.cleaning_report(cleaning.type_transactions(df)).first()
    assert (r.raw_rows, r.clean_rows, r.dropped_quality, r.silver_rows, r.dropped_duplicates) == (4, 2, 2, 1, 1)


def test_extra_columns_pass_through_typing(spark):
    df = _bronze(spark, [("a", "2026-05-16T10:00:00Z", "s", "p", "5")]).withColumn("promo", F.lit("x"))
    typed = cleaning.type_transactions(df)
    assert typed.columns[:14] == TX_FIELDS and "promo" in typed.columns


def test_pricing_errors_tolerance(spark):
    df = spark.createDataFrame([("a", 2, 10.0, 20.0), ("b", 2, 10.0, 20.04), ("c", 2, 10.0, 20.05)],
                               "transaction_id string, quantity int, unit_price double, total_amount double")
    assert [r.transaction_id for r in cleaning.pricing_errors(df).collect()] == ["c"]


def test_dedup_with_one_id_holding_a_third_of_rows(spark):
    """A hot key is reduced map-side; the latest of its 3,000 versions wins."""
    base = dt.datetime(2026, 5, 1)
    hot = [("hot", base + dt.timedelta(seconds=i), "s", "p", float(i)) for i in range(3000)]
    cold = [(f"id{i}", base, "s", "p", 1.0) for i in range(6000)]
    df = spark.createDataFrame(hot + cold, "transaction_id string, timestamp timestamp_ntz, store_id string, "
                                           "product_id string, total_amount double").repartition(8)
    out = cleaning.dedup_latest(df)
    assert out.count() == 6001
    assert out.filter("transaction_id = 'hot'").first().total_amount == 2999.0


def test_amounts_beyond_money_and_whole_number_text(spark):
    raw = spark.createDataFrame(
        [("a", "2.0", "10.5"), ("b", "2.5", "Infinity"), ("c", "3", "1e300"), ("d", "x", "NaN"), ("e", "4", "1e16")],
        "transaction_id string, quantity string, total_amount string")
    typed = cleaning.type_transactions(raw)
    assert {r.transaction_id: r.quantity for r in typed.collect()} == {"a": 2, "b": None, "c": 3, "d": None, "e": 4}
    assert [r.transaction_id for r in cleaning.valid_amounts(typed).collect()] == ["a"]


def test_dedup_latest_with_fewer_columns(spark):
    df = spark.createDataFrame([("x", "s1", 1.0), ("x", "s1", 2.0), ("y", "s2", 3.0)],
                               "transaction_id string, store_id string, total_amount double")
    got = cleaning.dedup_latest(df).collect()
    assert sorted((r.transaction_id, r.total_amount) for r in got) == [("x", 2.0), ("y", 3.0)]
