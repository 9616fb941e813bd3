"""Reading the driver's test tables and mapping them onto transactions.

``tx_raw``: lineitem joined to its order, part and supplier geography.
``events_tx``: the events table seen as store transactions (sub-second
timestamps, many rows per store-day: what the anomaly reports need).
``bronze_dirty``: events rendered as landing text with deterministic defects.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import money as M
from ..functions.timeparse import as_utc_ntz, render_event_time
from ..schemas import TX_FIELDS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --- fixed value ------------------------------------------------------------
# The region of stores that the lookup lacks.
DEFAULT_REGION = "Central"
# Stores up to which a zone's build sends the lookup to every executor: 21 MB.
FEW_STORES = 500_000
# ----------------------------------------------------------------------------


def store_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """store_id -> region: the suppliers' stores and the regions of their nations."""
    return _supplier_regions(spark, sf_dir).select(
        F.concat(F.lit("store-"), F.col("s_suppkey").cast("string")).alias("store_id"), F.col("r_name").alias("region"))


def with_region(df: DataFrame, lookup: DataFrame, default: str = DEFAULT_REGION) -> DataFrame:
    """Left lookup join store_id -> region with a default.

    The lookup has a row per store and grows with the stores: no hint, Spark
    broadcasts it only where its size is known to be under the threshold.
    """
    looked = df.join(lookup.withColumnRenamed("region", "_region"), "store_id", "left")
    return looked.withColumn("region", F.coalesce(F.col("_region"), F.lit(default))).drop("_region")


def _supplier_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    supp = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    # nation and region are fixed-size dimensions (25 and 5 rows): broadcast.
    geo = (table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
           .join(F.broadcast(table(spark, sf_dir, "region").select("r_regionkey", "r_name")),
                 F.col("n_regionkey") == F.col("r_regionkey"))
           .select("n_nationkey", "r_name"))
    return supp.join(F.broadcast(geo), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "r_name")


def tx_raw(spark: SparkSession, sf_dir: str, order_key: str | None = None) -> DataFrame:
    """lineitem x part x supplier x nation x region x orders -> 14 fields.

    ``order_key`` names a further column for the order's key, which a transaction
    id holds: the rows come from the join on it, so ids lie together already. It
    is for builds, where the lines aren't shuffled to join stores counted to be few.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_returnflag", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_retailprice")
    supp_geo = _supplier_regions(spark, sf_dir)
    if order_key and table(spark, sf_dir, "supplier").count() <= FEW_STORES:
        supp_geo = F.broadcast(supp_geo)

    # orders and part grow with the data: no hint, AQE picks the strategy
    # from runtime sizes (sort-merge at scale, broadcast when small). Orders
    # come last, so that what is keyed by them needs no shuffle of its own.
    j = (li.join(part, F.col("l_partkey") == F.col("p_partkey"))
           .join(supp_geo, F.col("l_suppkey") == F.col("s_suppkey"))
           .join(orders, F.col("l_orderkey") == F.col("o_orderkey")))
    return j.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("transaction_id"),
        as_utc_ntz("l_shipdate").alias("timestamp"),
        F.concat(F.lit("store-"), F.col("l_suppkey").cast("string")).alias("store_id"),
        F.col("r_name").alias("region"),
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("l_quantity").cast("int").alias("quantity"),
        M.out(M.discounted("p_retailprice", "l_discount").cast(M.MONEY)).alias("unit_price"),
        F.col("l_discount").alias("discount_pct"),
        M.out(M.discounted("l_extendedprice", "l_discount").cast(M.MONEY)).alias("total_amount"),
        F.col("o_orderpriority").alias("payment_method"),
        F.concat(F.lit("cust-"), F.col("o_custkey").cast("string")).alias("customer_id"),
        (F.col("l_returnflag") == F.lit("R")).alias("is_return"),
        *([F.col("l_orderkey").alias(order_key)] if order_key else []),
    )


def events_tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> transactions (one event = one sale of quantity 1)."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    base = ev.select(
        F.col("event_id").cast("string").alias("transaction_id"),
        as_utc_ntz("ts").alias("timestamp"),
        F.concat(F.lit("store-"), F.col("user_id").cast("string")).alias("store_id"),
        F.concat(F.lit("P-"), F.col("event_type")).alias("product_id"),
        F.col("event_type").alias("product_name"),
        F.col("event_type").alias("category"),
        F.lit(1).alias("quantity"),
        F.col("value").alias("unit_price"),
        F.lit(0.0).alias("discount_pct"),
        F.col("value").alias("total_amount"),
        F.lit("card").alias("payment_method"),
        F.concat(F.lit("cust-"), F.col("user_id").cast("string")).alias("customer_id"),
        (F.col("event_id") % 17 == 0).alias("is_return"),
    )
    return with_region(base, store_regions(spark, sf_dir)).select(*TX_FIELDS)


def _txt(c: Column) -> Column:
    return c.cast("string")


def bronze_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as landing text with deterministic defects (batch read)."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return dirty_landing_rows(ev, store_regions(spark, sf_dir))


def dirty_landing_rows(ev: DataFrame, lookup: DataFrame) -> DataFrame:
    """Render events (batch or streaming) as landing text with defects; ``lookup``: store_id, region.

    Columns: the 14 fields as text plus ``arrival`` (NTZ: when the record
    reached the landing zone; it decides the landing folder).
    """
    orig = ev.select("event_id", "ts", "user_id", "event_type", "value")
    # 1. a later copy of every 131st event: one hour later, one more unit of amount
    copies = (ev.filter(F.col("event_id") % 131 == 0)
                .select("event_id", (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("ts"), "user_id",
                        "event_type", (F.col("value") + F.lit(1.0)).alias("value")))
    rows = orig.unionByName(copies)
    eid = F.col("event_id")
    ts = as_utc_ntz("ts")
    amount = F.col("value")
    amount = F.when(eid % 101 == 0, F.lit(0.0)).otherwise(amount)           # 3. zero amount
    amount = F.when(eid % 103 == 0, F.lit(0.0) - amount).otherwise(amount)  # 4. negative amount
    discount = F.when(eid % 113 == 0, F.lit(1.5)).otherwise(F.lit(0.0))     # 7. discount too high
    discount = F.when(eid % 127 == 0, F.lit(None).cast("double")).otherwise(discount)  # 8. absent
    time_text = F.when(eid % 107 == 0, F.lit("not-a-time")).otherwise(       # 5. bad time
        render_event_time(ts, with_micros=(eid % 2 == 1)))                   # 9. even ids: seconds only
    return rows.select(
        _txt(eid).alias("transaction_id"),
        time_text.alias("timestamp"),
        F.when(eid % 97 == 0, F.lit(None).cast("string"))                    # 2. null store
         .otherwise(F.concat(F.lit("store-"), _txt(F.col("user_id")))).alias("store_id"),
        F.concat(F.lit("store-"), _txt(F.col("user_id"))).alias("_lookup_store"),
        F.concat(F.lit("P-"), F.col("event_type")).alias("product_id"),
        F.col("event_type").alias("product_name"),
        F.col("event_type").alias("category"),
        F.when(eid % 109 == 0, F.lit("0")).otherwise(F.lit("1")).alias("quantity"),  # 6. zero quantity
        _txt(F.col("value")).alias("unit_price"),
        _txt(discount).alias("discount_pct"),
        _txt(amount).alias("total_amount"),
        F.lit("card").alias("payment_method"),
        F.concat(F.lit("cust-"), _txt(F.col("user_id"))).alias("customer_id"),
        _txt(eid % 17 == 0).alias("is_return"),
        ts.alias("arrival"),
    ).transform(lambda d: _bronze_region(d, lookup))


def _bronze_region(d: DataFrame, lookup: DataFrame) -> DataFrame:
    lk = lookup.withColumnRenamed("store_id", "_lookup_store").withColumnRenamed("region", "_r")
    j = d.join(lk, "_lookup_store", "left")
    return j.select(*TX_FIELDS[:3], F.coalesce("_r", F.lit(DEFAULT_REGION)).alias("region"), *TX_FIELDS[4:], "arrival")


def pricing_fixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events_tx with a unit price off by one on every 89th event."""
    tx = events_tx(spark, sf_dir)
    off = F.col("transaction_id").cast("long") % 89 == 0
    return tx.withColumn("unit_price", F.when(off, F.col("unit_price") + F.lit(1.0)).otherwise(F.col("unit_price")))


def clean_landing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events_tx rendered as landing text without defects (the gate passes)."""
    tx = events_tx(spark, sf_dir)
    text = [render_event_time("timestamp").alias("timestamp") if f == "timestamp" else _txt(F.col(f)).alias(f)
            for f in TX_FIELDS]
    return tx.select(*text, F.col("timestamp").alias("arrival"))
