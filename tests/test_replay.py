"""Replay of quarantined batches and dead letters (K5): every landing line stays in one place."""

import pytest
from pyspark.sql import functions as F

from shoplake.plans import streams
from shoplake.plans.lake import Lake
from shoplake.session import path_exists
from shoplake.sources.bronze import discover_schema
from shoplake.streaming import incremental, replay

from test_storage_streaming import _land, _line, _rename_to_json

AT = "2026-06-01T00:00:00"


def _accounts(lake):
    return {r.outcome: r.records for r in replay.accounts(lake).collect()}


def _landed(spark, root, lines):
    day = f"{root}/landing/year=2026/month=05/day=05"
    _land(spark, day, lines)
    _rename_to_json(spark, day)
    return f"{root}/landing"


def _one_piece(rows):
    return rows.withColumn("quantity", F.lit("1"))


def _gated(spark, root, lines):
    lake = Lake(spark, f"{root}/lake")
    incremental.run_incremental(spark, _landed(spark, root, lines), lake, f"{root}/ckpt", threshold=0.95)
    return lake


def test_a_mended_batch_leaves_the_quarantine_once(spark, tmp_root):
    lake = _gated(spark, tmp_root, [*[_line(f"t{i}", quantity=0) for i in range(30)], _line("late", time="soon")])
    waiting = replay.quarantined(lake)
    assert len(waiting) == 1 and not path_exists(spark, lake.silver_path)
    # a mend that doesn't help changes nothing
    (row,) = replay.replay_quarantine(lake, lambda rows: rows, AT)
    assert row.status == "QUALITY_FAIL" and replay.quarantined(lake) == waiting
    (row,) = replay.replay_quarantine(lake, _one_piece, AT)
    assert (row.status, row.records) == ("OK", 31) and replay.quarantined(lake) == []
    assert _accounts(lake) == {"silver": 30, "bad_timestamp": 1, "quarantine": 0}
    assert {r.day: r.transaction_count for r in lake.gold("revenue_by_region").collect()} == {"05": 30}
    assert replay.replay_quarantine(lake, _one_piece, AT) == [] and _accounts(lake)["silver"] == 30
    # one run of the replay in the ledger, with its last verdict
    runs = {r.run_id: r.status for r in lake.ledger.read("verdicts").collect()}
    assert sorted(runs.values()) == ["OK", "QUALITY_FAIL"] and sum(k.endswith("-replay") for k in runs) == 1


@pytest.mark.parametrize("where", ["upsert_silver", "rebuild_gold", "delete_path"])
def test_a_replay_that_breaks_off_is_run_again(spark, tmp_root, monkeypatch, where):
    lake = _gated(spark, tmp_root, [*[_line(f"t{i}", quantity=0) for i in range(30)], _line("late", time="soon")])
    with monkeypatch.context() as m:
        m.setattr(replay if where == "delete_path" else incremental, where, lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            replay.replay_quarantine(lake, _one_piece, AT)
    assert len(replay.quarantined(lake)) == 1
    replay.replay_quarantine(lake, _one_piece, AT)
    assert _accounts(lake) == {"silver": 30, "bad_timestamp": 1, "quarantine": 0}
    assert {r.day: r.transaction_count for r in lake.gold("revenue_by_region").collect()} == {"05": 30}


def _in_may(rows):
    return rows.withColumn("timestamp", F.when(F.col("timestamp") == "soon", F.lit("2026-05-09T01:00:00Z")).otherwise(F.col("timestamp")))


@pytest.mark.parametrize("broken", [False, True])
def test_letters_that_are_mended_move_to_silver(spark, tmp_root, monkeypatch, broken):
    lake = Lake(spark, f"{tmp_root}/lake")
    landing = _landed(spark, tmp_root, [_line("a"), _line("b", time="soon"), _line("c", amount=-1), "not json"])
    incremental.run_incremental(spark, landing, lake, f"{tmp_root}/ckpt")
    assert _accounts(lake) == {"silver": 1, "bad_timestamp": 1, "invalid_amount": 1, "corrupt_record": 1, "quarantine": 0}
    assert replay.replay_errors(lake, lambda rows: rows) == []  # nothing is taken, nothing moves
    if broken:
        with monkeypatch.context() as m:
            m.setattr(replay, "delete_path", lambda *a: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                replay.replay_errors(lake, _in_may)
    assert replay.replay_errors(lake, _in_may) == [("2026", "05", "09")]
    left = {"silver": 2, "invalid_amount": 1, "corrupt_record": 1, "quarantine": 0}
    assert _accounts(lake) == left
    assert replay.replay_errors(lake, _in_may) == [] and _accounts(lake) == left
    kept = {r._corrupt_record for r in lake.errors().filter("error_type = 'corrupt_record'").collect()}
    assert kept == {"not json"}
    # a second round, with another mend
    replay.replay_errors(lake, lambda rows: rows.withColumn("total_amount", F.ltrim(F.col("total_amount"), F.lit("-"))))
    assert _accounts(lake) == {"silver": 3, "corrupt_record": 1, "quarantine": 0}


def test_letters_keep_registered_columns(spark, tmp_root):
    lake = Lake(spark, f"{tmp_root}/lake")
    landing = _landed(spark, tmp_root, [_line("a")[:-1] + ', "promo": "p1"}', _line("b", time="soon")[:-1] + ', "promo": "p2", "error_type": "x"}'])
    lake.learn(discover_schema(spark, landing))
    incremental.run_incremental(spark, landing, lake, f"{tmp_root}/ckpt", with_gold=False)
    assert [r.error_type for r in lake.errors().collect()] == ["bad_timestamp"]
    replay.replay_errors(lake, _in_may, with_gold=False)
    assert {(r.transaction_id, r.promo) for r in lake.silver().collect()} == {("a", "p1"), ("b", "p2")}


def test_a_lake_without_anything_set_aside(spark, tmp_root):
    lake = Lake(spark, tmp_root)
    assert replay.replay_quarantine(lake, streams.mended, AT) == [] and replay.replay_errors(lake, streams.mended) == []
