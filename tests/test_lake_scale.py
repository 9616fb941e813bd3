"""The lake's builds and views at size: what is shuffled, and by what (F1-F6 of round 3, F1 of round 4)."""

import datetime as dt
import re
import time

from pyspark.sql import functions as F

from shoplake.operators import cleaning, governance, kpis
from shoplake.plans import lake as plans
from shoplake.schemas import GOLD, SILVER_TYPES, TX_FIELDS
from shoplake.session import INITIAL_PARTITIONS, build_conf, glob_paths
from shoplake.sources import tables


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def _tx(spark, rows):
    """(id, timestamp, amount, customer, order) rows as typed transactions with their order's key."""
    base = spark.createDataFrame(rows, "transaction_id string, timestamp timestamp_ntz, total_amount double, customer_id string, _order long")
    rest = {c: F.lit("x" if SILVER_TYPES[c].typeName() == "string" else 1).cast(SILVER_TYPES[c])
            for c in TX_FIELDS if c not in base.columns and c != "is_return"}
    return base.withColumns({**rest, "is_return": F.lit(False)}).select(*TX_FIELDS, "_order")


def test_ids_that_a_join_has_brought_together_are_not_shuffled_again(spark):
    at = dt.datetime(2026, 5, 1)
    rows = [(f"{o}-{k % 3}", at + dt.timedelta(hours=k), 1.0 + k, None if k % 2 else "c", o) for o in range(40) for k in range(6)]
    rows.append((None, at, 1.0, "c", None))
    typed = _tx(spark, rows)
    orders = spark.range(40).select(F.col("id").alias("_order"))
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        silver = cleaning.to_silver(typed.join(orders, "_order").select(*TX_FIELDS, "_order"), within="_order")
        plan = _final_plan(silver)
        assert set(re.findall(r"hashpartitioning\(([^#]+)#\d+L?, ", plan)) == {"_order"} and "transaction_id#" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    plain = cleaning.to_silver(typed.drop("_order"))
    assert silver.columns == plain.columns
    assert sorted(map(repr, silver.collect())) == sorted(map(repr, plain.collect())) and plain.count() == 120


def test_the_order_key_is_an_extra_column_only(spark):
    d = "/root/testdata/sf0.001"
    with_key, plain = tables.tx_raw(spark, d, order_key="_order"), tables.tx_raw(spark, d)
    assert with_key.columns == [*plain.columns, "_order"]
    assert with_key.filter("_order is null or split(transaction_id, '-')[0] != cast(_order as string)").isEmpty()


def test_a_build_starts_in_many_parts_and_leaves_the_session_as_it_was(spark):
    keys = ["spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes",
            "spark.sql.adaptive.forceOptimizeSkewedJoin", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = [spark.conf.get(k, None) for k in keys]
    with build_conf(spark):
        assert int(spark.conf.get(keys[0])) >= INITIAL_PARTITIONS
        plan = spark.range(10).groupBy((F.col("id") % 3).alias("k")).count()._jdf.queryExecution().executedPlan().toString()
        assert f", {INITIAL_PARTITIONS})" in plan or f", {INITIAL_PARTITIONS}, " in plan
    assert [spark.conf.get(k, None) for k in keys] == before
    spark.conf.set(keys[1], "8m")
    try:
        with build_conf(spark):
            assert spark.conf.get(keys[1]) == "8m"
        assert spark.conf.get(keys[1]) == "8m"
    finally:
        spark.conf.unset(keys[1])


def test_rows_of_a_region_stay_where_they_are_in_the_regional_view(spark):
    silver = spark.range(1000).select("id", F.when(F.col("id") % 4 < 3, F.lit("ASIA")).when(F.col("id") % 8 == 3, F.lit("EUROPE")).alias("region"))
    grants = spark.createDataFrame([("ASIA",), ("ASIA",), ("NOWHERE",), (None,)], "region string")
    view = governance.regional_view(silver, grants)
    plan = _final_plan(view)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    fact = plan[:plan.index("BroadcastQueryStage")]
    assert "ShuffleQueryStage" not in fact and "Exchange hashpartitioning" not in fact
    assert view.count() == 750


def _star(spark, path, lines=240):
    """A small star schema: lines with repeated and null keys, absent lookups, amounts and times that are rejected."""
    at = dt.datetime(2026, 5, 1)
    li = [(None if k % 41 == 0 else k % 30, k % 7, k % 5, k // 30 % 3 + 1, 1.0 + k % 9, -1.0 if k % 37 == 0 else 10.0 + k, (k % 4) / 100,
           "R" if k % 6 == 0 else "N", None if k % 43 == 0 else at + dt.timedelta(days=k % 11, hours=k % 5)) for k in range(lines)]
    made = {
        "lineitem": (li + li[:20], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                     "l_extendedprice double, l_discount double, l_returnflag string, l_shipdate timestamp_ntz"),
        "orders": ([(k, k % 4, f"{k % 3}-URGENT") for k in [*range(28), 3, 3]], "o_orderkey long, o_custkey long, o_orderpriority string"),
        "part": ([(k, f"part {k}", f"TYPE {k % 2}", 5.0 + k) for k in [*range(6), 2]], "p_partkey long, p_name string, p_type string, p_retailprice double"),
        "supplier": ([(k, k % 2) for k in range(5)] + [(1, 0), (None, 1)], "s_suppkey long, s_nationkey int"),
        "nation": ([(0, 0), (1, 1)], "n_nationkey int, n_regionkey int"),
        "region": ([(0, "ASIA"), (1, "EUROPE")], "r_regionkey int, r_name string"),
    }
    for name, (rows, schema) in made.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/{name}.parquet")
    return path


def _rows(df):
    return sorted(map(repr, df.collect()))


def _shuffle_files(spark):
    every = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in re.findall(r"shuffle_\d+_\d+_\d+\.data", every.mkString(" "))}


def test_a_large_lake_is_built_in_shares_with_the_same_rows(spark, tmp_root, monkeypatch):
    d = _star(spark, f"{tmp_root}/star")
    monkeypatch.setattr(plans, "SHARE_ROWS", 20)
    monkeypatch.setattr(plans, "SHARE_BYTES", 8_000)
    written = []
    write = plans.write_partitioned
    monkeypatch.setattr(plans, "write_partitioned", lambda df, path, **k: (written.append((path, k["mode"])), write(df, path, **k)))
    lake = plans.fixture_lake(spark, d, "tx")
    assert [mode for path, mode in written] == ["overwrite", "append", "append", "append"]  # 260 lines, 20 for each of 4 cores
    want = cleaning.to_silver(tables.tx_raw(spark, d))
    assert _rows(lake.silver().select(*want.columns)) == _rows(want) and want.count() > 60
    assert len(lake._day_groups()) > 1
    for name, df in kpis.gold_tables(want).items():
        assert _rows(lake.gold(name)) == _rows(df.select(*GOLD[name].fieldNames())), name
    assert len(glob_paths(spark, f"{lake.gold_root}/_manifests/*.json")) == 1  # all groups are one publication
    assert _rows(lake.partitions()) == _rows(want.select(plans._partition_name().alias("partition")).distinct())


def test_lines_are_not_shuffled_to_join_few_stores(spark, tmp_root, monkeypatch):
    d = _star(spark, f"{tmp_root}/star")
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        few = tables.tx_raw(spark, d, order_key="_order")
        plan = _final_plan(few)
        assert set(re.findall(r"hashpartitioning\(([^#]+)#\d+L?, ", plan)) == {"l_partkey", "p_partkey", "l_orderkey", "o_orderkey"}
        monkeypatch.setattr(tables, "FEW_STORES", 6)  # there are 7
        many = tables.tx_raw(spark, d, order_key="_order")
        assert "hashpartitioning(l_suppkey#" in _final_plan(many)
        assert _rows(few) == _rows(many) == _rows(tables.tx_raw(spark, d).select("*", F.split("transaction_id", "-")[0].cast("long").alias("_order")))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)


def test_shares_replace_what_is_there_and_add_up_their_counters(spark, tmp_root):
    at = dt.datetime(2026, 5, 1)
    rows = [(f"{o}-{k % 3}", at + dt.timedelta(days=k), -1.0 if (o + k) % 7 == 0 else 1.0 + k, "c", o) for o in range(30) for k in range(6)]
    typed = _tx(spark, [*rows, (None, at, 1.0, "c", None)])
    lake, other = plans.Lake(spark, f"{tmp_root}/a"), plans.Lake(spark, f"{tmp_root}/b")
    lake.build_silver(_tx(spark, [("old", dt.datetime(2020, 1, 1), 1.0, "c", 7)]))
    for one in (lake, lake, other):
        assert one.build_silver(typed, within="_order", parts=4) == cleaning.cleaning_report(typed).first().asDict()
        assert _rows(one.silver()) == _rows(cleaning.to_silver(typed.drop("_order")).select(*one.silver().columns))
    assert _rows(lake.days()) == _rows(other.days())


def test_a_build_leaves_no_shuffle_files(spark, tmp_root):
    lake = plans.Lake(spark, f"{tmp_root}/lake")
    typed = _tx(spark, [(f"{o}", dt.datetime(2026, 5, 1 + o % 9), 1.0 + o, "c", o) for o in range(200)])
    before = _shuffle_files(spark)
    lake.build_silver(typed, within="_order")
    lake.build_gold()
    for _ in range(20):  # they are deleted in the background
        if left := _shuffle_files(spark) - before:
            time.sleep(0.25)
    assert not left
    with build_conf(spark):
        assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "true"
    assert lake.gold("top_products").count() > 0
