"""Parameterised reports over Gold and Silver.

Each report takes the zone DataFrame and its parameters and returns a lazy
DataFrame. The first operation is always the partition filter (year, month
and, where given, day): on a partitioned table read it becomes a
``PartitionFilters`` entry, so a one-month report lists and reads only that
month's folders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import money as M
from .cleaning import sales_only


def _period(df: DataFrame, year: str, month: str | None = None, day: str | None = None) -> DataFrame:
    cond = F.col("year") == F.lit(year)
    if month is not None:
        cond = cond & (F.col("month") == F.lit(month))
    if day is not None:
        cond = cond & (F.col("day") == F.lit(day))
    return df.filter(cond)


def _exact_sum(c: str) -> Column:
    """Sum of a 2-decimal money column, exact, as DECIMAL."""
    return F.sum(M.money(c))


# --- Gold: product revenue -----------------------------------------------------------

def monthly_category_revenue(gold_product: DataFrame, year: str, month: str) -> DataFrame:
    """Per category for a month: revenue, units, transactions, mean of daily tickets."""
    g = _period(gold_product, year, month).groupBy("category").agg(
        M.out(_exact_sum("total_revenue")).alias("monthly_revenue"),
        F.sum("units_sold").alias("monthly_units"),
        F.sum("transaction_count").alias("monthly_transactions"),
        M.exact_mean2(_exact_sum("avg_order_value"), F.count("avg_order_value")).alias("avg_order_value"),
    )
    return g.orderBy(F.col("monthly_revenue").desc_nulls_last())


def category_daily_trend(gold_product: DataFrame, year: str, month: str, category: str) -> DataFrame:
    """One category's days in a month."""
    return (_period(gold_product, year, month).filter(F.col("category") == F.lit(category))
            .select("year", "month", "day", "total_revenue", "units_sold", "transaction_count")
            .orderBy("year", "month", "day"))


def category_revenue_share(gold_product: DataFrame, year: str, month: str, day: str) -> DataFrame:
    """Each category's share of one day's revenue.

    The total is a window over the day's partition key rather than an empty
    OVER (): with an empty window Spark moves all rows into one task.
    """
    d = _period(gold_product, year, month, day)
    total = M.out(F.sum(M.money("total_revenue")).over(Window.partitionBy("year", "month", "day")))
    return (d.select("category", "total_revenue", M.pct(F.col("total_revenue"), total).alias("revenue_share_pct"))
             .orderBy(F.col("revenue_share_pct").desc_nulls_last()))


def mom_growth(gold_product: DataFrame, year: str, month: str, prev_year: str, prev_month: str) -> DataFrame:
    """Month-over-month revenue growth per category.

    One scan of the two pruned months and one aggregate: conditional sums
    replace the two CTEs and their join. Categories without current-month
    rows are dropped; ``previous_revenue`` stays NULL (not 0) when the
    category had no rows the month before, like the left join it replaces.
    """
    cur = (F.col("year") == F.lit(year)) & (F.col("month") == F.lit(month))
    prev = (F.col("year") == F.lit(prev_year)) & (F.col("month") == F.lit(prev_month))
    g = gold_product.filter(cur | prev).groupBy("category").agg(
        F.sum(F.when(cur, M.money("total_revenue"))).alias("_c"),
        F.sum(F.when(prev, M.money("total_revenue"))).alias("_p"),
        F.count_if(cur).alias("_nc"),
    ).filter(F.col("_nc") > 0)
    c, p = M.out("_c"), M.out("_p")
    growth = F.round(F.try_divide(c - p, p) * F.lit(100.0), 2) + F.lit(0.0)
    return (g.select("category", c.alias("current_revenue"), p.alias("previous_revenue"), growth.alias("growth_pct"))
             .orderBy(F.col("growth_pct").desc_nulls_last()))


# --- Gold: regions --------------------------------------------------------------------

def monthly_region_performance(gold_region: DataFrame, year: str, month: str) -> DataFrame:
    g = _period(gold_region, year, month).groupBy("region").agg(
        M.out(_exact_sum("total_revenue")).alias("monthly_revenue"),
        F.sum("transaction_count").alias("monthly_transactions"),
        F.max("active_stores").alias("active_stores"),
        M.exact_mean2(_exact_sum("avg_order_value"), F.count("avg_order_value")).alias("avg_order_value"),
    )
    return g.orderBy(F.col("monthly_revenue").desc_nulls_last())


def region_daily_trend(gold_region: DataFrame, year: str, month: str) -> DataFrame:
    return (_period(gold_region, year, month)
            .select("day", "region", "total_revenue", "transaction_count").orderBy("day", "region"))


def best_region_per_day(gold_region: DataFrame, year: str, month: str) -> DataFrame:
    """Top region per day (all regions tied for first are kept)."""
    w = Window.partitionBy("year", "month", "day").orderBy(F.col("total_revenue").desc())
    return (_period(gold_region, year, month).withColumn("_rnk", F.rank().over(w)).filter(F.col("_rnk") == 1)
            .select("day", "region", "total_revenue").orderBy("day"))


def region_vs_average(gold_region: DataFrame, year: str, month: str) -> DataFrame:
    """Each region's daily revenue against the cross-region mean of that day.

    The per-day means of one month have at most 31 rows: broadcasting them is
    bounded by the month filter, whatever the data volume.
    """
    r = _period(gold_region, year, month)
    daily = r.groupBy("year", "month", "day").agg(
        F.sum(M.money("total_revenue")).alias("_s"), F.count("total_revenue").alias("_n"))
    daily = daily.select("year", "month", "day",
                         (M.out("_s") / F.col("_n")).alias("_avg"),
                         M.exact_mean2(F.col("_s"), F.col("_n")).alias("national_avg"))
    j = r.join(F.broadcast(daily), ["year", "month", "day"])
    vs = F.round(F.try_divide(F.col("total_revenue") - F.col("_avg"), F.col("_avg")) * F.lit(100.0), 2) + F.lit(0.0)
    return (j.select("day", "region", "total_revenue", "national_avg", vs.alias("vs_avg_pct"))
             .orderBy(F.col("day"), F.col("vs_avg_pct").desc_nulls_last()))


# --- Silver: anomalies ----------------------------------------------------------------

def amount_outliers(silver: DataFrame, year: str, month: str, n_sd: float = 3.0, limit: int = 50) -> DataFrame:
    """Transactions above mean + n_sd x sample sd of their category; top ``limit`` by z.

    Moments are exact sums over cents (sum x, sum x^2, n), so mean and sd do
    not depend on how tasks merge partial results. The per-category stats are
    joined without a hint: their size grows with the number of categories,
    and AQE turns the join into a broadcast once the stats stage shows it is
    small (skew-join splitting covers a hot category otherwise).
    """
    s = _period(silver, year, month).select("transaction_id", "store_id", "category", "total_amount")
    x = M.money("total_amount")
    stats = s.groupBy("category").agg(
        F.sum(x).alias("_s1"), F.sum(x * x).alias("_s2"), F.count(x).alias("_n"))
    n = F.col("_n").cast("double")
    mean = M.out("_s1") / n
    var = F.try_divide(M.out(F.col("_n") * F.col("_s2") - F.col("_s1") * F.col("_s1")), n * (n - F.lit(1.0)))
    stats = stats.select("category", mean.alias("_mean"), F.sqrt(var).alias("_sd"))
    j = s.join(stats, "category").filter(F.col("total_amount") > F.col("_mean") + F.lit(n_sd) * F.col("_sd"))
    z = F.round(F.try_divide(F.col("total_amount") - F.col("_mean"), F.col("_sd")), 2)
    out = j.select("transaction_id", "store_id", "category", "total_amount",
                   F.round("_mean", 2).alias("category_mean"), z.alias("z_score"))
    return out.orderBy(F.col("z_score").desc_nulls_last(), F.col("transaction_id")).limit(limit)


def store_volume_drop(silver: DataFrame, year: str, month: str, ratio: float = 0.5) -> DataFrame:
    """Store-days with fewer than ``ratio`` x the store's mean daily count.

    A day with no transactions has no row and is never flagged. The store
    mean is a window over at most 31 daily rows per store (the month filter
    bounds it), so a hot store cannot make one task large.
    """
    daily = _period(silver, year, month).groupBy("store_id", "day").agg(F.count(F.lit(1)).alias("daily_transactions"))
    avg = F.avg("daily_transactions").over(Window.partitionBy("store_id"))
    d = daily.withColumn("_avg", avg).filter(F.col("daily_transactions") < F.col("_avg") * F.lit(ratio))
    return (d.select("store_id", "day", "daily_transactions", F.round("_avg", 1).alias("store_avg"),
                     M.pct(F.col("daily_transactions"), F.col("_avg"), 1).alias("pct_of_avg"))
             .orderBy(F.col("pct_of_avg").asc_nulls_last(), "store_id", "day"))


def return_rate_spikes(silver: DataFrame, year: str, month: str, threshold_pct: float = 10.0) -> DataFrame:
    g = _period(silver, year, month).groupBy("store_id", "day").agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.count_if(F.col("is_return") == F.lit(True)).alias("returns"),
    )
    g = g.withColumn("return_rate_pct", M.pct(F.col("returns"), F.col("total_transactions")))
    return g.filter(F.col("return_rate_pct") > F.lit(threshold_pct)).orderBy(F.col("return_rate_pct").desc_nulls_last())


def hourly_volume(silver: DataFrame, year: str, month: str, day: str) -> DataFrame:
    g = _period(silver, year, month, day).groupBy(F.hour("timestamp").alias("hour_of_day")).agg(
        F.count(F.lit(1)).alias("transaction_count"),
        M.money_sum("total_amount").alias("total_revenue"),
    )
    return g.orderBy("hour_of_day")


# --- Silver: counts and patterns -------------------------------------------------------

def month_transaction_count(silver: DataFrame, year: str, month: str) -> DataFrame:
    return _period(silver, year, month).agg(F.count(F.lit(1)).alias("total_transactions"))


def customer_patterns(silver: DataFrame) -> DataFrame:
    """Per customer over sales: orders, spend, distinct categories, first and last day."""
    s = sales_only(silver.select("customer_id", "transaction_id", "category", "total_amount", "timestamp", "is_return"))
    return s.groupBy("customer_id").agg(
        F.count_distinct("transaction_id").alias("orders"),
        M.money_sum("total_amount").alias("total_spend"),
        F.count_distinct("category").alias("distinct_categories"),
        F.to_date(F.min("timestamp")).alias("first_purchase"),
        F.to_date(F.max("timestamp")).alias("last_purchase"),
    )


def transaction_trend(silver: DataFrame) -> DataFrame:
    """Sales per day (the dashboard's count trend)."""
    return (sales_only(silver.select("year", "month", "day", "is_return"))
            .groupBy("year", "month", "day").agg(F.count(F.lit(1)).alias("transaction_count"))
            .orderBy("year", "month", "day"))
