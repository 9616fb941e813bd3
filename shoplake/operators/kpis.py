"""Silver -> Gold: the four daily KPI tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import money as M
from ..schemas import PARTITION_COLS
from .cleaning import sales_only

DAY = PARTITION_COLS

# Columns the KPIs need: reading only these keeps the Silver scan narrow.
KPI_COLS = ["transaction_id", "store_id", "region", "product_id", "product_name", "category",
            "quantity", "total_amount", "payment_method", "is_return", *DAY]


def sales(silver: DataFrame) -> DataFrame:
    return sales_only(silver.select(*KPI_COLS))


def _finish(df: DataFrame, kpi: str, keys: list[str], measures: list[str]) -> DataFrame:
    return df.select(*keys, *measures, F.lit(kpi).alias("kpi_type"), *DAY)


def _tx_count() -> F.Column:
    """Distinct transactions: ids are unique in Silver (keep-latest dedup), so a
    plain count gives their number without a shuffle keyed by the id."""
    return F.count("transaction_id")


def revenue_by_product(sales_df: DataFrame) -> DataFrame:
    """Daily revenue, units, distinct transactions and mean ticket per category."""
    g = sales_df.groupBy(*DAY, "category").agg(
        F.sum(M.money("total_amount")).alias("_rev"),
        F.sum("quantity").alias("units_sold"),
        _tx_count().alias("transaction_count"),
        F.count("total_amount").alias("_n"),
    )
    g = g.select("*", M.out("_rev").alias("total_revenue"), M.exact_mean2(F.col("_rev"), F.col("_n")).alias("avg_order_value"))
    return _finish(g, "revenue_by_product", ["category"],
                   ["total_revenue", "units_sold", "transaction_count", "avg_order_value"])


def revenue_by_region(sales_df: DataFrame) -> DataFrame:
    """Daily revenue, distinct transactions, distinct stores, mean ticket per region.

    Only the store count is distinct: a first stage keyed by store as well, then
    the (day, region) groups.
    """
    g = sales_df.groupBy(*DAY, "region").agg(
        F.sum(M.money("total_amount")).alias("_rev"),
        _tx_count().alias("transaction_count"),
        F.count_distinct("store_id").alias("active_stores"),
        F.count("total_amount").alias("_n"),
    )
    g = g.select("*", M.out("_rev").alias("total_revenue"), M.exact_mean2(F.col("_rev"), F.col("_n")).alias("avg_order_value"))
    return _finish(g, "revenue_by_region", ["region"],
                   ["total_revenue", "transaction_count", "active_stores", "avg_order_value"])


def payment_method_split(sales_df: DataFrame) -> DataFrame:
    """Daily revenue and row count (not distinct) per payment method."""
    g = sales_df.groupBy(*DAY, "payment_method").agg(
        M.money_sum("total_amount").alias("total_revenue"),
        F.count("transaction_id").alias("transaction_count"),
    )
    return _finish(g, "payment_method_split", ["payment_method"], ["total_revenue", "transaction_count"])


def top_products(sales_df: DataFrame, k: int = 10) -> DataFrame:
    """Per day, products ranked by revenue; rank <= k (ties can give more rows).

    rank() with a filter on it becomes a WindowGroupLimit: every task keeps
    its local top-k per day before the day-partitioned shuffle, so a day with
    millions of products ships only k-plus-ties rows per task.
    """
    g = sales_df.groupBy(*DAY, "product_id", "product_name", "category").agg(
        F.sum(M.money("total_amount")).alias("_rev"),
        F.sum("quantity").alias("units_sold"),
    )
    w = Window.partitionBy(*DAY).orderBy(F.col("_rev").desc())
    ranked = g.withColumn("revenue_rank", F.rank().over(w)).filter(F.col("revenue_rank") <= k)
    ranked = ranked.withColumn("total_revenue", M.out("_rev"))
    return _finish(ranked, "top_products", ["product_id", "product_name", "category"],
                   ["total_revenue", "units_sold", "revenue_rank"])


KPIS = {
    "revenue_by_product": revenue_by_product,
    "revenue_by_region": revenue_by_region,
    "payment_method_split": payment_method_split,
    "top_products": top_products,
}


# Rows of each table's preview, the columns of its order and whether it ascends.
PREVIEWS = {
    "revenue_by_product": (5, ["total_revenue"], False),
    "revenue_by_region": (5, ["total_revenue"], False),
    "payment_method_split": (5, ["transaction_count"], False),
    "top_products": (10, [*DAY, "revenue_rank"], True),
}


def preview(name: str, gold: DataFrame) -> DataFrame:
    """The first rows of a Gold table in its preview's order; ties by day, then by the table's keys.

    A sort with a limit: every task keeps its own first rows.
    """
    n, order, ascending = PREVIEWS[name]
    first = [F.asc(c) if ascending else F.desc(c) for c in order]
    return gold.orderBy(*first, *DAY, *[c for c, t in gold.dtypes if t == "string" and c not in DAY]).limit(n)


def gold_tables(silver: DataFrame) -> dict[str, DataFrame]:
    """The four KPIs of a Silver read, where ids are unique by construction.

    Each reads only its own columns of Silver and combines in the map tasks, so
    what is shuffled is a row per group and task.
    """
    sold = sales(silver)
    return {name: kpi(sold) for name, kpi in KPIS.items()}
