"""shoplake: a Spark-native medallion lake for retail transactions.

Bronze (raw JSON) -> Silver (typed, deduplicated, date-partitioned Parquet)
-> Gold (daily KPI tables) -> parameterised reports, plus a data-quality
gate and Structured Streaming variants of the incremental steps.

Every function takes and returns DataFrames; nothing here collects data to
the driver except the gate verdict that decides whether a pipeline run
continues (one row).
"""

__all__ = ["session", "schemas"]
