"""Events in time: bitmaps, as-of join, sessions, interval join, windowed mart, sketches, diff."""

from __future__ import annotations

import random
import time
from collections import Counter
from datetime import UTC, datetime, timedelta

import pytest
from lakeledger.operators import asof, audit, bitmaps, diff, sessions, sketches
from lakeledger.operators.silver import to_silver
from lakeledger.plans import events
from lakeledger.schemas import LOG_SCHEMA, RAW_TOPIC, SILVER_SCHEMA
from lakeledger.sources import tables as tb
from lakeledger.streaming.ingest import drain, land_stateful, start
from lakeledger.streaming.pairs import settled_within
from lakeledger.streaming.windowed import closed_mart, start_mart_stream
from pyspark.sql import functions as F
from rows import NOON, SF_SMALL, landed


def rows_of(df):
    return sorted(map(repr, df.collect()))


# ------------------------------------------------------------------ bitmaps

#: Offsets at the edges of ranges, with holes, repeats and a range of its own.
OFFSETS = [0, 1, 7, 8, 32_766, 32_767, 32_768, 32_769, 65_535, 65_536, 200_000, 200_002, 5_000_000_000]


def test_bitmap_audits_equal_the_row_audits(spark):
    rng = random.Random(1)
    log = spark.createDataFrame([(b"k", b"v", RAW_TOPIC, p, o, NOON) for p in range(2) for o in OFFSETS], LOG_SCHEMA)
    held = [(RAW_TOPIC, p, o) for p in range(2) for o in OFFSETS if rng.random() < 0.7 for _ in range(rng.randrange(1, 3))]
    held += [(RAW_TOPIC, 1, 77), (RAW_TOPIC, 0, 40_000)]  # never on the log
    landed_at = spark.createDataFrame(held, "kafka_topic string, kafka_partition int, kafka_offset long")
    for mine, rowwise in ((bitmaps.missing(log, landed_at), audit.offset_missing(log, landed_at)),
                          (bitmaps.gaps(landed_at), audit.offset_gaps(landed_at)),
                          (bitmaps.reconcile(log, landed_at), audit.offset_reconcile(log, landed_at))):
        assert rows_of(mine.select(*rowwise.columns)) == rows_of(rowwise)
    none = landed_at.where("false")
    assert bitmaps.gaps(none).count() == 0 and bitmaps.missing(log, none).count() == log.count()
    assert bitmaps.missing(log.where("false"), landed_at).count() == 0


def test_one_bitmap_a_range_is_shuffled(spark):
    positions = spark.range(0, 3 * bitmaps.RANGE, 1, 2).selectExpr("'t' AS kafka_topic", "0 AS kafka_partition", "id AS kafka_offset")
    got = bitmaps.bitmaps(positions).collect()
    assert len(got) == 3 and all(r.rows == bitmaps.RANGE and bytes(r.bits) == b"\xff" * 4096 for r in got)
    plan = bitmaps.bitmaps(positions)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_bitmap_construct_agg") > plan.index("Exchange")  # below it: before the shuffle


# ------------------------------------------------------------------ as-of join


def test_asof_against_brute_force(spark):
    rng = random.Random(5)
    keys = ["hot"] * 60 + ["a", "b", None]
    right = [(rng.choice(keys), NOON + timedelta(hours=rng.randrange(200)), n, rng.choice([None, n])) for n in range(150)]
    right += [("hot", None, 900, 1), ("c", NOON - timedelta(days=400), 901, 2)]
    left = [(n, rng.choice([*keys, "c", "nobody"]), rng.choice([None, NOON + timedelta(hours=rng.randrange(-5, 220))])) for n in range(120)]
    a = spark.createDataFrame(left, "id int, k string, t timestamp")
    b = spark.createDataFrame(right, "k string, t timestamp, n int, v int")
    for block in ("6 hours", "1 day", "900 days"):
        got = {r.id: (r.asof_n, r.asof_v) for r in asof.asof_join(a, b, left_key="k", right_key="k", left_time="t", right_time="t",
                                                                 columns=("n", "v"), order=("n",), block=block).collect()}
        assert len(got) == len(left)
        for i, k, t in left:
            known = [(rt, n, v) for rk, rt, n, v in right if k is not None and t is not None and rt is not None and rk == k and rt <= t]
            want = max(known, key=lambda x: x[:2])[1:] if known else (None, None)
            assert got[i] == want, (i, k, t)
    assert asof.asof_join(a, b.where("false"), left_key="k", right_key="k", left_time="t", right_time="t", columns=("n",)).where("asof_n IS NOT NULL").count() == 0
    assert asof.asof_join(a.where("false"), b, left_key="k", right_key="k", left_time="t", right_time="t", columns=("n",)).count() == 0


def test_asof_splits_a_hot_key(spark):
    """No window is over the key alone but the one with a row a block."""
    df = spark.range(10).selectExpr("'hot' AS k", "timestamp_seconds(id * 90000) AS t", "id AS n")
    joined = asof.asof_join(df, df, left_key="k", right_key="k", left_time="t", right_time="t", columns=("n",))
    assert all(r.n == r.asof_n for r in joined.collect())
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    wide = [line for line in plan.splitlines() if "Window [last(_right" in line.replace("#", "[", 0)]
    assert wide and all("_block" in line for line in wide)


# ------------------------------------------------------------------ sessions


def test_sessions(spark):
    at = [0, 1, 5.999, 6, 12, 18.5, 50]
    silver, _ = to_silver(landed(spark, *({"transaction_id": f"t{i}", "event_time": NOON + timedelta(hours=h), "at": (0, i)} for i, h in enumerate(at))))
    got = [(r.started_at, r.last_at, r.transactions) for r in sessions.account_sessions(silver, gap="6 hours").orderBy("started_at").collect()]
    hours = lambda h: (NOON + timedelta(hours=h)).replace(tzinfo=None)
    assert [(a.hour, n) for a, _, n in got] == [(hours(0).hour, 5), (hours(18.5).hour, 1), (hours(50).hour, 1)]
    assert sum(n for *_, n in got) == len(at)


# ------------------------------------------------------------------ streams


def silver_files(spark, path, *batches):
    for rows in batches:
        silver, _ = to_silver(landed(spark, *rows))
        silver.coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(SILVER_SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)


def pay(n, hours, status="SETTLED", **more):
    at = NOON + timedelta(hours=hours)
    return {"transaction_id": f"t{n}", "status": status, "event_time": at, "seen": at, "at": (0, n)} | more


BATCHES = ([pay(0, 0, "PENDING"), pay(1, 1, "PENDING"), pay(2, 2, account_id="bob")],
           [pay(3, 20), pay(4, 24.5), pay(5, 30, "PENDING", account_id="bob")],
           [pay(6, 80, "PENDING"), pay(7, 81, account_id="bob"), pay(8, 110), pay(9, 110, "PENDING")])


def test_pairs_after_a_crash_and_a_replay(spark, tmp_path):
    path, out, calls = str(tmp_path / "silver"), str(tmp_path / "out"), []
    rows = settled_within(silver_files(spark, path, *BATCHES), within="1 day", delay="1 hour")

    def body(batch, n):
        land_stateful(batch, n, path=out)
        calls.append(n)
        if len(calls) == 2:
            raise RuntimeError("killed")

    for turn in range(2):
        query = start(rows, body, checkpoint_path=str(tmp_path / "ck"), trigger={"availableNow": True})
        if turn:
            drain(query)
        else:
            with pytest.raises(Exception, match="killed"):
                drain(query)
    got = {(r.pending_id, r.settled_id) for r in tb.read_table(spark, out, rows.schema).collect()}
    # t5 was settled too late (80 hours on: t7 is bob's, after 51 hours), t6 only after 30 hours.
    assert got == {("t0", "t3"), ("t1", "t3"), ("t1", "t4"), ("t5", None), ("t6", None), ("t9", "t8")}
    batch = settled_within(spark.read.schema(SILVER_SCHEMA).parquet(path), within="1 day", delay="1 hour")
    assert got <= {(r.pending_id, r.settled_id) for r in batch.collect()}


def test_windowed_mart_with_restatements(spark, tmp_path):
    late = [pay(20, 0.5, amount_minor=50), pay(21, 3, account_id="new")]  # for a day long closed
    source = silver_files(spark, str(tmp_path / "silver"), *BATCHES, [pay(30, 200)], late, [pay(31, 300)])
    root = str(tmp_path / "mart")
    drain(start_mart_stream(source, root=root, checkpoint_path=str(tmp_path / "ck"), delay="1 hour"))
    rows = [r for b in (*BATCHES, [pay(30, 200)], late) for r in b]
    want = Counter()
    for r in rows:
        want[r["event_time"].date(), r.get("account_id", "ann")] += r.get("amount_minor", 700)
    got = {(r.event_date, r.account_id): r.total_amount_minor for r in closed_mart(spark, root).collect()}
    assert got == dict(want)
    restated = tb.read_table(spark, f"{root}/restated")
    assert {(r.account_id, r.transaction_count) for r in restated.collect()} == {("ann", 1), ("new", 1)}


# ------------------------------------------------------------------ sketches and diff


def test_sketches_merge_over_any_days(spark):
    rows = spark.range(60_000).selectExpr(
        "date_add(DATE '2025-01-01', CAST(id % 12 AS INT)) AS ingest_date", "'t' || (id % 40000) AS transaction_id", "'a' || (id % 900) AS account_id",
        "timestamp_seconds(1000) AS produced_at", "timestamp_millis(1000000 + id) AS ingested_at")
    daily = sketches.daily_sketches(rows)
    assert daily.count() == 12
    half = F.when(F.col("ingest_date") < "2025-01-07", 1).otherwise(2).alias("half")
    for by, n_ids in ((F.lit(1).alias("all"), 40_000), (half, None)):
        for r in sketches.estimates(sketches.merged(daily, by)).collect():
            if n_ids:
                assert r.messages == 60_000 and abs(r.transactions - n_ids) <= sketches.DISTINCT_ERROR * n_ids
                assert abs(r.n_accounts - 900) <= sketches.DISTINCT_ERROR * 900
            assert abs(r.p50_lag - 30) <= 60 * sketches.RANK_ERROR and abs(r.p99_lag - 59.4) <= 60 * sketches.RANK_ERROR


def test_diff_is_except_all_both_ways(spark):
    rng = random.Random(7)
    schema = "k string, n int, `a.b` double"

    def some():
        return [(rng.choice(["x", "", None]), rng.choice([None, 0, 1]), rng.choice([None, 0.5])) for _ in range(60)]

    a, b = some(), some()
    got = {tuple(r)[:3]: r.copies for r in diff.table_diff(*(spark.createDataFrame(x, schema).withColumnRenamed("a.b", "f") for x in (a, b))).collect()}
    want = Counter(a)
    want.subtract(Counter(b))
    assert got == {k: n for k, n in want.items() if n}
    same = spark.createDataFrame(a, schema).withColumnRenamed("a.b", "f")
    assert diff.table_diff(same, same.repartition(3)).count() == 0
    assert diff.table_diff(same, same.limit(0)).agg(F.sum("copies")).first()[0] == 60


def test_diff_survives_a_colliding_hash(spark, monkeypatch):
    real = diff._hashes
    monkeypatch.setattr(diff, "_hashes", lambda columns: [F.lit(1).cast("long").alias("_h1"), real(columns)[1]])
    a, b = (spark.createDataFrame(x, "k string") for x in ([("p",), ("q",)], [("q",), ("r",)]))
    assert {(r.k, r.copies) for r in diff.table_diff(a, b).collect()} == {("p", 1), ("r", -1)}


def test_all_queries_have_an_oracle():
    from lakeledger.plans import events_oracle

    assert set(events.QUERIES) == set(events_oracle.ORACLE)


# ------------------------------------------------------------------ growth of the stream queries


def test_silver_of_a_stream_is_computed_once(spark, tmp_path, monkeypatch):
    rows = [r for b in BATCHES for r in b]
    computed = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(account):
        computed.add(1)
        return account

    silver = to_silver(landed(spark, *rows))[0].withColumn("account_id", seen("account_id"))
    monkeypatch.setattr(events.base, "_silver", lambda *_: (silver, None))
    stream = events._silver_stream(spark, "unused", str(tmp_path), lagging=False)
    assert spark.read.schema(SILVER_SCHEMA).parquet(f"{tmp_path}/silver").count() == len(rows)
    assert stream.isStreaming and computed.value == len(rows)


@pytest.mark.parametrize("within", ["1 day", "90 minutes"])
def test_pairs_meet_in_one_span(spark, within):
    rng, day = random.Random(3), {"1 day": 24, "90 minutes": 1.5}[within]
    hours = [0, day, 2 * day, -day, -day / 3] + [rng.uniform(-4 * day, 4 * day) for _ in range(60)]
    rows = [pay(i, h, status=rng.choice(["PENDING", "SETTLED"]), account_id=rng.choice(["ann", "bob", None])) for i, h in enumerate(hours)]
    rows += [pay(900, 0, status="PENDING"), pay(901, day, status="SETTLED"), pay(902, 0, status="SETTLED")]
    columns = ("transaction_id", "status", "event_time", "account_id")
    frame = settled_within(spark.createDataFrame(
        [tuple(({"account_id": "ann"} | r)[c] for c in columns) for r in rows], "transaction_id string, status string, event_time timestamp, account_id string"), within=within)
    want = Counter()
    for p in (r for r in rows if r["status"] == "PENDING"):
        hits = [s["transaction_id"] for s in rows if s["status"] == "SETTLED" and p.get("account_id", "ann") is not None
                and s.get("account_id", "ann") == p.get("account_id", "ann")
                and timedelta(0) <= s["event_time"] - p["event_time"] <= timedelta(hours=day)]
        want.update((p["transaction_id"], s) for s in hits or [None])
    assert Counter((r.pending_id, r.settled_id) for r in frame.collect()) == want
    assert "_settled_span" in frame._jdf.queryExecution().optimizedPlan().toString()  # no account is compared whole


def test_log_files_do_not_multiply(spark, tmp_path, monkeypatch):
    registry = events.base
    monkeypatch.setattr(registry, "RECORDS_PER_FILE", 2)
    monkeypatch.setattr(registry, "LOG_FILES", 8)
    rows = [(b"k", b"{}", RAW_TOPIC, 0, n, NOON) for n in range(400)]
    log = spark.createDataFrame(rows, LOG_SCHEMA).coalesce(1)
    path, admitted = registry._log_files(log, str(tmp_path), registry._records_per_file(log))
    files = list((tmp_path / "log").glob("part-*"))
    assert len(files) == 8 and admitted == 2 and spark.read.parquet(path).count() == 400


def micro_batches(spark, root):
    """(rows, first, last time of the log) of each micro-batch, in the order they come."""
    files = sorted((root / "silver").glob("part-*"), key=lambda f: f.stat().st_mtime_ns)
    assert len(files) % 4 == 0
    groups = [[str(f) for f in files[n:n + 4]] for n in range(0, len(files), 4)]
    return [tuple(spark.read.schema(SILVER_SCHEMA).parquet(*g).agg(F.count("*"), F.min("kafka_timestamp"), F.max("kafka_timestamp")).first())
            for g in groups]


def test_a_large_delivery_comes_in_pieces(spark, tmp_path, monkeypatch):
    (tmp_path / "whole").mkdir()
    events._silver_stream(spark, SF_SMALL, str(tmp_path / "whole"), lagging=False)
    whole = micro_batches(spark, tmp_path / "whole")
    monkeypatch.setattr(events, "ROWS_A_BATCH", 60)
    events._silver_stream(spark, SF_SMALL, str(tmp_path / "cut"), lagging=False)
    cut = micro_batches(spark, tmp_path / "cut")
    assert len(whole) == 4 and len(cut) >= 16 and sum(n for n, *_ in cut) == sum(n for n, *_ in whole)
    assert max(n for n, *_ in cut) <= 120 < min(n for n, *_ in whole)
    assert all(a[2] <= b[1] for a, b in zip(cut, cut[1:]))


@pytest.mark.parametrize("name", ["stream_pairs", "stream_sessions", "stream_mart"])
def test_pieces_give_the_same_rows(spark, monkeypatch, name):
    whole = rows_of(events.QUERIES[name](spark, SF_SMALL))
    monkeypatch.setattr(events, "ROWS_A_BATCH", 120)
    assert rows_of(events.QUERIES[name](spark, SF_SMALL)) == whole and whole


def test_a_trigger_takes_in_one_delivery(spark, tmp_path, monkeypatch):
    """Deliveries of one and two rows, between them one without any."""
    def on(day, n, **more):
        return pay(n, (datetime(2024, 1, day, tzinfo=UTC) - NOON) / timedelta(hours=1), **more)

    silver = to_silver(landed(spark, on(3, 0, status="PENDING"), on(17, 1, status="PENDING"), on(18, 2), on(28, 3)))[0]
    monkeypatch.setattr(events.base, "_silver", lambda *_: (silver, None))
    events._silver_stream(spark, "unused", str(tmp_path), lagging=False)
    assert [(n, first.day, last.day) for n, first, last in micro_batches(spark, tmp_path)] == [(1, 3, 3), (2, 17, 18), (1, 28, 28)]
    got = events.q_stream_pairs(spark, "unused").collect()
    assert sorted((r.pending_id, r.settled_id) for r in got) == [("t0", None), ("t1", "t2")]
    monkeypatch.setattr(events.base, "_silver", lambda *_: (silver.where("false"), None))
    assert events.q_stream_pairs(spark, "unused").count() == 0


def slow_tasks(spark, tasks, seconds):
    @F.udf("long")
    def slow(n):
        time.sleep(seconds)
        return n

    spark.range(0, tasks, 1, tasks).select(slow("id")).write.format("noop").mode("overwrite").save()


@pytest.mark.parametrize("work", ["batches", "tasks"])
def test_a_stream_that_works_is_not_timed_out(spark, tmp_path, work):
    files, done = [[pay(n, n)] for n in range(5 if work == "batches" else 1)], []

    def body(batch, n):
        if work == "batches":
            time.sleep(2.5)
        else:
            slow_tasks(batch.sparkSession, 24 * spark.sparkContext.defaultParallelism, 0.5)
        done.append(n)

    rows = silver_files(spark, str(tmp_path / "silver"), *files)
    drain(start(rows, body, checkpoint_path=str(tmp_path / "ck"), trigger={"availableNow": True}), 5)
    assert done == list(range(len(files)))


def test_a_stream_that_does_nothing_is_stopped(spark, tmp_path):
    rows = silver_files(spark, str(tmp_path / "silver"), [pay(0, 0)])
    query = start(rows, lambda batch, n: time.sleep(12), checkpoint_path=str(tmp_path / "ck"), trigger={"availableNow": True})
    with pytest.raises(TimeoutError, match="ended no task"):
        drain(query, 3)
    assert not query.isActive
