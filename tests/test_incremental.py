"""Incremental refine: equals the full run after every batch, reads what is new, survives crashes."""

from __future__ import annotations

import random
from datetime import UTC, datetime, timedelta
from pathlib import Path

import pytest
from lakeledger.operators.gold import daily_account_totals
from lakeledger.operators.quality import DataQualityBreach, dq_results
from lakeledger.operators.silver import QUARANTINE_REASON, to_silver
from lakeledger.plans import incremental as inc
from lakeledger.schemas import BRONZE_PARTITION
from lakeledger.sources import tables as tb
from rows import NOON, landed

STAMP = datetime(2025, 4, 1, tzinfo=UTC)


def messages(rng, n):
    """Payments with retries (same id, other offsets, amounts and days) and bad rows."""
    return [{"transaction_id": f"t{rng.randrange(n // 2)}", "account_id": rng.choice(["ann", "bob", "cyd"]), "amount_minor": rng.randrange(-2, 9),
             "currency": rng.choice(["JPY", "USD", "XXX"]), "status": rng.choice(["SETTLED", "PENDING"]),
             "event_time": NOON + timedelta(days=rng.randrange(4), minutes=i), "at": (rng.randrange(3), i),
             "seen": NOON + timedelta(days=rng.randrange(4), hours=1, minutes=i)} for i in range(n)]


def land(spark, layout, batch, rows):
    tb.append_once(landed(spark, *rows), layout.path("bronze"), app_id="bronze", version=batch, partition_by=(BRONZE_PARTITION,))


def run(spark, layout, **more):
    try:
        return inc.refine_new(spark, layout, run_id="r", checked_at=STAMP, thresholds=dict.fromkeys(("non_positive_amount", "unknown_currency"), 1.0), **more)
    except DataQualityBreach as breach:
        return breach.args[1]


def same(a, b):
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.select(*a.columns).collect()))


def equals_full(spark, layout):
    bronze = layout.read(spark, "bronze")
    clean, bad = to_silver(bronze)
    same(clean, layout.clean(spark))
    same(bad, layout.quarantined(spark))
    same(daily_account_totals(clean), layout.mart(spark))
    same(dq_results(source=bronze, quarantined=bad, run_id="r", checked_at=STAMP, thresholds=dict.fromkeys(("non_positive_amount", "unknown_currency"), 1.0)),
         layout.read(spark, "dq_results"))


def files(path):
    return {str(f.relative_to(path)): f.read_bytes() for f in Path(path).rglob("*.parquet")}


def test_random_batches_equal_the_full_run(spark, warehouse):
    rng, layout = random.Random(3), inc.IncrementalLayout(warehouse)
    rows = messages(rng, 90)
    rng.shuffle(rows)
    moved = 0
    for n in range(3):
        land(spark, layout, n, rows[30 * n:30 * n + 30])
        summary = run(spark, layout)
        assert summary["run"] == n and summary["batches"] == [("bronze", n)]
        moved += len(summary["rewritten"])
        equals_full(spark, layout)
    assert moved > 0
    assert inc.fold_deltas(spark, layout) > 4
    equals_full(spark, layout)
    parts = tb.read_table(spark, layout.path("mart_deltas"))
    assert parts.count() == layout.mart(spark).count()
    # A run without news changes nothing but its own marks.
    before = files(layout.path("silver"))
    assert run(spark, layout)["batches"] == [] and files(layout.path("silver")) == before
    land(spark, layout, 9, [{"transaction_id": "t0", "at": (0, -1), "event_time": NOON}])
    run(spark, layout)
    equals_full(spark, layout)


def test_a_run_reads_the_new_batch_and_rewrites_one_folder(spark, warehouse, monkeypatch):
    layout, day = inc.IncrementalLayout(warehouse), timedelta(days=1)
    first = [{"transaction_id": f"a{i}", "event_time": NOON + (i % 5) * day, "at": (1, i), "seen": NOON + (i % 5) * day} for i in range(20)]
    land(spark, layout, 0, first)
    run(spark, layout)
    before = files(layout.path("silver"))
    read = []
    real = inc.new_bronze
    monkeypatch.setattr(inc, "new_bronze", lambda *a: read.append(real(*a)) or read[-1])
    # One new day; of the old rows it holds one repeat (later on the log) and one original (earlier).
    land(spark, layout, 1, [{"transaction_id": "new", "event_time": NOON + 9 * day, "at": (2, 0), "seen": NOON + 9 * day},
                            {"transaction_id": "a3", "event_time": NOON + 9 * day, "at": (2, 1), "seen": NOON + 9 * day},
                            {"transaction_id": "a7", "event_time": NOON + 9 * day, "at": (0, 5), "seen": NOON + 9 * day}])
    summary = run(spark, layout)
    opened = read[0].inputFiles()
    assert opened and all("batch_id=1/" in f for f in opened)
    old_day = (NOON + 2 * day).date()
    assert summary["rewritten"] == [("refine", 0, "clean", old_day)]
    after = files(layout.path("silver"))
    untouched = {f: b for f, b in before.items() if f"event_date={old_day}" not in f}
    assert len(untouched) == 4 and all(after[f] == b for f, b in untouched.items())
    assert sum("batch_id=1/" in f for f in after) == 1  # one day was added
    assert summary["gold_dates"] == [str(old_day), str((NOON + 9 * day).date())]
    equals_full(spark, layout)


class Killed(RuntimeError):
    pass


def test_a_run_that_dies_anywhere_is_run_again(spark, tmp_path, monkeypatch):
    rows = messages(random.Random(8), 40)
    real = inc.IncrementalLayout.append_run
    for step in (0, 2, 3, 4, 6, 7):
        layout = inc.IncrementalLayout(str(tmp_path / f"w{step}"))
        land(spark, layout, 0, rows[::2])
        run(spark, layout)
        land(spark, layout, 1, rows[1::2])
        calls = []

        def dying(self, df, table, n, calls=calls, step=step):
            if len(calls) == step:
                raise Killed(table)
            calls.append(table)
            return real(self, df, table, n)

        monkeypatch.setattr(inc.IncrementalLayout, "append_run", dying)
        if step < 7:
            with pytest.raises(Killed):
                run(spark, layout)
            land(spark, layout, 2, [{"transaction_id": "later", "at": (0, 999)}])  # not in the plan of the run that died
            monkeypatch.setattr(inc.IncrementalLayout, "append_run", real)
            again = run(spark, layout)
            assert again["run"] == 1 and again["batches"] == ([("bronze", 1)] if step else [("bronze", 1), ("bronze", 2)])
            run(spark, layout)
        else:
            run(spark, layout)  # seven writes and no more
            assert len(calls) == 7
            monkeypatch.setattr(inc.IncrementalLayout, "append_run", real)
        equals_full(spark, layout)


def test_the_gate_closes_after_the_run_is_done(spark, warehouse):
    layout = inc.IncrementalLayout(warehouse)
    land(spark, layout, 0, [{"amount_minor": -1, "transaction_id": f"t{i}", "at": (0, i)} for i in range(3)])
    with pytest.raises(DataQualityBreach):
        inc.refine_new(spark, layout, run_id="bad")
    assert layout.quarantined(spark).select(QUARANTINE_REASON).distinct().count() == 1
    assert inc.planned(spark, layout) == (1, [])
