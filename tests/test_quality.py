"""Quality rules and the gate verdicts (Q1-Q8)."""

from shoplake.operators import quality
from shoplake.schemas import BRONZE

GOOD = {"transaction_id": "t", "timestamp": "2026-05-16T10:00:00Z", "store_id": "s", "product_id": "p",
        "total_amount": "10", "quantity": "1", "category": "c", "discount_pct": "0.1"}


def _rows(spark, dicts):
    fields = [f.name for f in BRONZE.fields if f.name != "_corrupt_record"]
    return spark.createDataFrame([tuple(d.get(f) for f in fields) for d in dicts],
                                 ", ".join(f"{f} string" for f in fields))


def _verdict(spark, dicts, threshold=0.95):
    return quality.gate(quality.score(quality.validate(_rows(spark, dicts))), threshold).first()


def test_errors_in_rule_order(spark):
    bad = dict(GOOD, store_id=None, total_amount="-1", discount_pct=None)
    errs = quality.validate(_rows(spark, [bad])).first().errors
    assert errs == ["Missing field: store_id", "Invalid total_amount: -1", "Discount out of range: None"]


def test_missing_amount_reports_both(spark):
    errs = quality.validate(_rows(spark, [dict(GOOD, total_amount=None)])).first().errors
    assert errs == ["Missing field: total_amount", "Invalid total_amount: None"]


def test_unparseable_time_passes_gate(spark):
    assert quality.validate(_rows(spark, [dict(GOOD, timestamp="not-a-time")])).first().is_valid


def test_gate_no_data(spark):
    r = _verdict(spark, [])
    assert r.status == "NO_DATA" and r.records == 0 and r.quality_score == 0.0


def test_gate_ok_and_fail(spark):
    assert _verdict(spark, [GOOD] * 3).status == "OK"
    assert _verdict(spark, [GOOD, dict(GOOD, quantity="0")]).status == "QUALITY_FAIL"


def test_exact_threshold_passes(spark):
    rows = [GOOD] * 19 + [dict(GOOD, quantity="0")]  # 19/20 = 0.95
    r = _verdict(spark, rows)
    assert r.quality_score == 0.95 and r.status == "OK"


def test_alerts_only_when_not_ok(spark):
    ok = quality.gate(quality.score(quality.validate(_rows(spark, [GOOD]))))
    assert quality.alerts(ok).count() == 0
    bad = quality.gate(quality.score(quality.validate(_rows(spark, [dict(GOOD, quantity="0")]))))
    assert quality.alerts(bad).first().status == "QUALITY_FAIL"


def test_metrics_two_points(spark):
    m = quality.metrics(quality.score(quality.validate(_rows(spark, [GOOD]))))
    assert sorted((r.metric_name, r.unit, r.zone) for r in m.collect()) == [
        ("QualityScore", "None", "Bronze"), ("SampledRecords", "Count", "Bronze")]


def test_sample_at_most_five_files_twenty_each(spark, tmp_root):
    from pyspark.sql import functions as F
    from shoplake.sinks.writers import write_landing
    from shoplake.sources import tables
    from shoplake.sources.bronze import new_files, read_bronze_with_file
    from conftest import SF001
    landing = f"{tmp_root}/landing"
    write_landing(tables.bronze_dirty(spark, SF001), landing, mode="overwrite")
    files = new_files(spark, landing, "2000-01-01T00:00:00")
    assert files.count() >= 5
    assert new_files(spark, landing, "2100-01-01T00:00:00").count() == 0
    s = quality.sample(read_bronze_with_file(spark, landing), files)
    per_file = s.groupBy("file_path").count().collect()
    assert len(per_file) == 5 and all(r["count"] <= 20 for r in per_file)
    assert s.count() == sum(r["count"] for r in per_file) > 0


def test_cut_off_is_computed_from_a_parameter():
    from shoplake.functions.timeparse import hours_before

    assert hours_before("2026-05-16T01:00:00") == "2026-05-15T00:00:00"
    assert hours_before("2024-03-01T00:30:00", 1) == "2024-02-29T23:30:00"
