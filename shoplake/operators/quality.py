"""Data-quality gate over raw Bronze records.

The rules are a declarative list evaluated as one projection: each rule is
a (name, failing-predicate, message) triple, and a record's errors are the
messages of its failing rules in list order. No Python per record.

The gate checks raw text: a timestamp only needs to be present here (an
unparseable time passes the gate and is rejected later by cleaning).
Numbers go through try_cast; text that is not a number counts as absent.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
REQUIRED_FIELDS = ["transaction_id", "timestamp", "store_id", "product_id", "total_amount", "quantity", "category"]
QUALITY_THRESHOLD = 0.95
STATUS_NO_DATA, STATUS_FAIL, STATUS_OK = "NO_DATA", "QUALITY_FAIL", "OK"
MSG_MISSING = "Missing field: "
MSG_AMOUNT = "Invalid total_amount: "
MSG_QUANTITY = "Invalid quantity: "
MSG_DISCOUNT = "Discount out of range: "
ABSENT_TEXT = "None"
METRIC_SCORE, METRIC_RECORDS = "QualityScore", "SampledRecords"
UNIT_SCORE, UNIT_RECORDS = "None", "Count"
METRIC_ZONE = "Bronze"
ALERT_SUBJECTS = {
    STATUS_NO_DATA: "WARNING: no new Bronze data",
    STATUS_FAIL: "ALERT: Bronze quality below threshold, ETL stopped",
}
# ----------------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    name: str
    fails: Column
    message: Column


def _num(c: str, absent: float) -> Column:
    return F.coalesce(F.col(c).try_cast("double"), F.lit(absent))


def _shown(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(ABSENT_TEXT))


def rules() -> list[Rule]:
    out = [Rule(f"missing_{f}", F.col(f).isNull(), F.lit(MSG_MISSING + f)) for f in REQUIRED_FIELDS]
    amount, qty, disc = _num("total_amount", -1.0), _num("quantity", -1.0), _num("discount_pct", -1.0)
    out.append(Rule("invalid_total_amount", amount <= 0, F.concat(F.lit(MSG_AMOUNT), _shown("total_amount"))))
    out.append(Rule("invalid_quantity", qty <= 0, F.concat(F.lit(MSG_QUANTITY), _shown("quantity"))))
    # NaN is the largest double in Spark; a NaN discount is not "> 1".
    out.append(Rule("discount_out_of_range", (disc < 0) | ((disc > 1) & ~F.isnan(disc)),
                    F.concat(F.lit(MSG_DISCOUNT), _shown("discount_pct"))))
    return out


def validate(bronze: DataFrame) -> DataFrame:
    """Adds ``errors`` (array of messages, rule order) and ``is_valid`` (Q5)."""
    rs = rules()
    errors = F.filter(F.array(*[F.when(r.fails, r.message) for r in rs]), lambda e: e.isNotNull())
    return bronze.withColumn("errors", errors).withColumn("is_valid", F.size("errors") == 0)


def score(validated: DataFrame) -> DataFrame:
    """One row: records, valid_records, quality_score (0.0 when empty)."""
    agg = validated.agg(F.count(F.lit(1)).alias("records"), F.count_if("is_valid").alias("valid_records"))
    s = F.when(F.col("records") > 0, F.col("valid_records").cast("double") / F.col("records")).otherwise(F.lit(0.0))
    return agg.withColumn("quality_score", s)


def error_log(validated: DataFrame) -> DataFrame:
    """{record_id or 'unknown', errors} for every invalid record (Q6)."""
    return (validated.filter(~F.col("is_valid"))
            .select(F.coalesce(F.col("transaction_id"), F.lit("unknown")).alias("record_id"), "errors"))


def first_errors(validated: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` first records of the error log by record id, for verdicts and alerts (O6): every task keeps n rows."""
    return error_log(validated).orderBy("record_id", F.array_join("errors", "; ")).limit(n)


def error_counts(validated: DataFrame) -> DataFrame:
    """Invalid records per rule: a histogram instead of a 5-row sample (Q7).

    Partial aggregation before the shuffle: the output has one row per
    rule whatever the input size.
    """
    e = validated.filter(~F.col("is_valid")).select(F.explode("errors").alias("error"))
    rule = F.when(F.col("error").startswith(MSG_MISSING), F.col("error")).otherwise(
        F.substring_index(F.col("error"), ":", 1))
    return e.groupBy(rule.alias("rule")).agg(F.count(F.lit(1)).alias("records"))


def status(threshold: float = QUALITY_THRESHOLD) -> Column:
    """Status of a row with ``records`` and ``quality_score``."""
    return (F.when(F.col("records") == 0, F.lit(STATUS_NO_DATA))
            .when(F.col("quality_score") < F.lit(threshold), F.lit(STATUS_FAIL))
            .otherwise(F.lit(STATUS_OK)))


def gate(scored: DataFrame, threshold: float = QUALITY_THRESHOLD, *more: str) -> DataFrame:
    """Verdict row: NO_DATA / QUALITY_FAIL (score strictly below) / OK (Q8), with ``more`` columns of the score."""
    return scored.select(
        status(threshold).alias("status"), "quality_score", "records",
        (F.col("records") - F.col("valid_records")).alias("invalid_records"),
        F.lit(threshold).alias("threshold"), *more,
    )


def points() -> Column:
    """The metric points of a row with ``records`` and ``quality_score``."""
    return F.array(
        F.struct(F.lit(METRIC_SCORE).alias("metric_name"), F.col("quality_score").alias("metric_value"),
                 F.lit(UNIT_SCORE).alias("unit")),
        F.struct(F.lit(METRIC_RECORDS).alias("metric_name"), F.col("records").cast("double").alias("metric_value"),
                 F.lit(UNIT_RECORDS).alias("unit")),
    )


def metrics(scored: DataFrame, zone: str = METRIC_ZONE) -> DataFrame:
    """Two metric points per check: QualityScore and SampledRecords (K6)."""
    return scored.select(F.explode(points()).alias("m")).select("m.*", F.lit(zone).alias("zone"))


def subject() -> Column:
    """The alert's subject for a row with ``status``."""
    return F.when(F.col("status") == STATUS_NO_DATA, F.lit(ALERT_SUBJECTS[STATUS_NO_DATA])).when(
        F.col("status") == STATUS_FAIL, F.lit(ALERT_SUBJECTS[STATUS_FAIL]))


def alerts(verdict: DataFrame) -> DataFrame:
    """Alert rows for NO_DATA and QUALITY_FAIL verdicts (K7); OK gives none."""
    return (verdict.filter(F.col("status") != STATUS_OK)
            .select("status", subject().alias("subject"), "quality_score", "records", "invalid_records", "threshold"))


def sample(bronze_with_file: DataFrame, candidates: DataFrame, files: int = 5, per_file: int = 20,
           seed: int = 42) -> DataFrame:
    """The original spot check: up to ``files`` random files out of
    ``candidates`` (a file listing, e.g. ``new_files``), first ``per_file``
    records of each (S6).

    Files come by a hash of seed and path, alike on every run and partitioning.
    Kept as an option; the default gate runs over every record. Within a
    file, read order is the order of monotonically_increasing_id (a
    landing file is gzip, read by a single task).
    """
    from pyspark.sql import Window

    chosen = candidates.select("file_path").distinct().orderBy(F.xxhash64(F.lit(seed), "file_path"), "file_path").limit(files)
    # ``files`` paths at most; as a filter on the file's own path they keep the other files from being opened
    paths = [r.file_path for r in chosen.collect()]
    rows = bronze_with_file.filter(F.col("file_path").isin(paths)).withColumn("_pos", F.monotonically_increasing_id())
    w = Window.partitionBy("file_path").orderBy("_pos")
    return rows.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= per_file).drop("_n", "_pos")
