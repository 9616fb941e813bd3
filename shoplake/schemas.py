"""Schemas for the three zones and the quality outputs."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
# The 14 transaction fields in their business order.
TX_FIELDS = [
    "transaction_id", "timestamp", "store_id", "region", "product_id", "product_name",
    "category", "quantity", "unit_price", "discount_pct", "total_amount",
    "payment_method", "customer_id", "is_return",
]

PARTITION_COLS = ["year", "month", "day"]
# ----------------------------------------------------------------------------

# Bronze: every field is read as text. A JSON number arriving as a string must
# not mark the whole row corrupt (a typed read schema would null the field and
# flag the row); typing happens afterwards with try_cast.
CORRUPT_COL = "_corrupt_record"
BRONZE = T.StructType([T.StructField(f, T.StringType(), True) for f in TX_FIELDS])
BRONZE_WITH_CORRUPT = T.StructType(list(BRONZE.fields) + [T.StructField(CORRUPT_COL, T.StringType(), True)])

# Silver time is a UTC wall-clock TIMESTAMP_NTZ: partition values and hour
# buckets then do not depend on the session time zone.
SILVER_TYPES = {
    "transaction_id": T.StringType(),
    "timestamp": T.TimestampNTZType(),
    "store_id": T.StringType(),
    "region": T.StringType(),
    "product_id": T.StringType(),
    "product_name": T.StringType(),
    "category": T.StringType(),
    "quantity": T.IntegerType(),
    "unit_price": T.DoubleType(),
    "discount_pct": T.DoubleType(),
    "total_amount": T.DoubleType(),
    "payment_method": T.StringType(),
    "customer_id": T.StringType(),
    "is_return": T.BooleanType(),
}

TX = T.StructType([T.StructField(f, SILVER_TYPES[f], True) for f in TX_FIELDS])
SILVER = T.StructType(list(TX.fields) + [T.StructField(c, T.StringType(), True) for c in PARTITION_COLS])


def _gold(measures: list[tuple[str, T.DataType]], keys: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType(
        [T.StructField(n, t, True) for n, t in keys + measures]
        + [T.StructField("kpi_type", T.StringType(), False)]
        + [T.StructField(c, T.StringType(), True) for c in PARTITION_COLS]
    )


GOLD = {
    "revenue_by_product": _gold(
        [("total_revenue", T.DoubleType()), ("units_sold", T.LongType()),
         ("transaction_count", T.LongType()), ("avg_order_value", T.DoubleType())],
        [("category", T.StringType())]),
    "revenue_by_region": _gold(
        [("total_revenue", T.DoubleType()), ("transaction_count", T.LongType()),
         ("active_stores", T.LongType()), ("avg_order_value", T.DoubleType())],
        [("region", T.StringType())]),
    "payment_method_split": _gold(
        [("total_revenue", T.DoubleType()), ("transaction_count", T.LongType())],
        [("payment_method", T.StringType())]),
    "top_products": _gold(
        [("total_revenue", T.DoubleType()), ("units_sold", T.LongType()), ("revenue_rank", T.IntegerType())],
        [("product_id", T.StringType()), ("product_name", T.StringType()), ("category", T.StringType())]),
}
