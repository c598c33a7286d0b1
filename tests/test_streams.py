"""Streaming jobs over several batches, replays and late rows."""

import math
import os
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tastemill.functions import pairs
from tastemill.operators import neighbours as nb
from tastemill.streaming import jobs

START = datetime(2024, 1, 1)
SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def event(i, minutes, user, item, kind="view"):
    return (i, START + timedelta(minutes=minutes), user, kind, 1.0, f'{{"k": {item}}}')


@pytest.fixture
def feed(spark, tmp_path):
    """Write one file per batch, dated in batch order; each becomes one micro-batch."""

    def make(*batches):
        folder = tmp_path / "events"
        for n, batch in enumerate(batches):
            known = set(folder.glob("part-*.parquet"))
            spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))
            for f in set(folder.glob("part-*.parquet")) - known:
                os.utime(f, (1_700_000_000 + 10 * n,) * 2)
        return jobs.read_events(spark, str(folder), files_per_batch=1)

    return make


BATCHES = (
    [event(1, 0, 1, 10), event(2, 5, 1, 11), event(3, 6, 2, 10)],
    [event(4, 70, 2, 11, "click"), event(5, 75, 1, 12, "purchase")],
    [event(6, 200, 2, 12), event(7, 1, 1, 13)],
)


def test_cooccurrence_over_batches_and_replay(spark, feed, tmp_path):
    acts = jobs.stream_interactions(feed(*BATCHES))
    store = str(tmp_path / "store")
    totals = jobs.stream_cooccur(acts, store)
    batch = jobs.event_interactions(
        spark.createDataFrame([e for b in BATCHES for e in b], SCHEMA)
    )
    expected = rows(nb.cooccur(batch.select("user", "item").distinct()))
    assert rows(totals) == expected
    again = spark.createDataFrame(list(BATCHES[1]), SCHEMA)
    jobs.cooccur_batch(store)(jobs.event_interactions(again), 1)
    stored = spark.read.schema("a bigint, b bigint, k bigint, batch bigint").parquet(f"{store}/pairs")
    assert rows(stored.groupBy("a", "b").agg(F.sum("k"))) == expected


def test_runs_cover_all_batches_before():
    for n in range(70):
        runs = jobs.owned_runs(n)
        assert [b for low, high in runs for b in range(low, high)] == list(range(n))
        assert len(runs) <= 3 * 4


def test_cooccurrence_reads_its_own_users_in_few_runs(spark, tmp_path):
    """Nine batches of two users each: merged runs, only touched buckets, replays that change nothing."""
    store, buckets = str(tmp_path / "store"), 16
    update = jobs.cooccur_batch(store, buckets)
    batches = [[(u, 10 * n + i) for u in (n % 5, 7) for i in range(3)] + [(7, 0), (None, 1), (3, None)] for n in range(9)]
    for n, batch in enumerate(batches):
        update(spark.createDataFrame(batch, "user bigint, item bigint"), n)
    everything = spark.createDataFrame([r for b in batches for r in b], "user bigint, item bigint").dropna().distinct()
    expected = rows(nb.cooccur(everything))
    assert rows(jobs.stored_cooccur(spark, store)) == expected
    # Batch 8 merged batches 4 to 7; again it, and a batch between merges, with the same rows.
    for n in (8, 6):
        update(spark.createDataFrame(batches[n], "user bigint, item bigint"), n)
        assert rows(jobs.stored_cooccur(spark, store)) == expected
    bucket = F.pmod(F.xxhash64("user"), F.lit(buckets)).cast("int")
    asked = spark.createDataFrame([(2, 0)], "user bigint, item bigint").withColumn("bucket", bucket)
    known = jobs.owned_by(asked, store, 9)
    assert "PartitionFilters: [isnotnull(bucket" in known._jdf.queryExecution().toString()
    assert {r["item"] for r in known.filter("user = 2").collect()} == {r["item"] for r in everything.filter("user = 2").collect()}


def test_empty_batches_leave_the_store_as_it_is(spark, tmp_path):
    store = str(tmp_path / "store")
    update = jobs.cooccur_batch(store)
    schema = "user bigint, item bigint"
    for n, batch in enumerate([[], [(1, 1), (1, 2)], [(None, 3)], [], [(1, 2), (1, 3)]]):
        update(spark.createDataFrame(batch, schema), n)
    assert rows(jobs.stored_cooccur(spark, store)) == [(1, 2, 1), (1, 3, 1), (2, 3, 1)]


def test_pairs_between_cut_groups_equal_a_plain_join(spark, many_parts):
    left = spark.range(40).select((F.col("id") % 2).alias("g"), F.col("id").alias("m"))
    right = spark.range(100, 170).select((F.col("id") % 3).alias("g"), F.col("id").alias("m"))
    plain = left.withColumnRenamed("m", "a").join(right.withColumnRenamed("m", "b"), "g").select("g", "a", "b")
    for cell in (4, 2048):
        assert rows(pairs.pairs_between(left, right, "g", "m", cell)) == rows(plain)


def test_late_rows_are_counted_per_batch(feed, tmp_path):
    report = jobs.late_report(feed(*BATCHES), str(tmp_path / "late"), 3600)
    assert rows(report, "batch", "rows", "late") == [(0, 3, 0), (1, 2, 0), (2, 2, 1)]


def test_profile_does_not_depend_on_order_or_replay(spark, feed, tmp_path):
    acts = jobs.stream_interactions(feed(*BATCHES))
    expected = {}
    weights = {"view": 1.0, "click": 2.0, "purchase": 5.0}
    for user in (1, 2):
        own = [(e[1], weights[e[3]]) for b in BATCHES for e in b if e[2] == user]
        last = max(t for t, _ in own)
        score = sum(w * math.exp(-0.5 * (last - t).total_seconds() / 86400) for t, w in own)
        expected[user] = (round(score, 6), len(own))
    store = str(tmp_path / "store")
    first = jobs.stream_profile(acts, 0.5, store).collect()
    again = jobs.event_interactions(spark.createDataFrame(list(BATCHES[1]), SCHEMA))
    jobs.profile_batch(store, 0.5)(again.withColumn("ts", F.col("ts").cast("timestamp")), 1)
    for got in (first, jobs.stored_profile(spark, store, 0.5).collect()):
        assert {r["user"]: (round(r["score"], 6), r["events"]) for r in got} == expected


def test_idle_profiles_leave_and_their_state_with_them(spark, feed, tmp_path):
    """User 1 is late in the middle of a spell, user 2 returns after the gap, user 3 never does."""
    acts = jobs.stream_interactions(
        feed(
            [event(1, 0, 1, 10), event(2, 50, 1, 11, "click"), event(3, 6, 2, 10), event(4, 7, 3, 10)],
            [event(5, 25, 1, 12, "purchase"), event(6, 55, 4, 10)],
            [event(7, 300, 2, 11), event(8, 301, 2, 12)],
            [event(9, 302, 2, 13, "click")],
            [event(10, 900, 4, 13)],
            [event(11, 901, 4, 13)],
        )
    )
    idle = jobs.stream_profile_idle(acts, 0.5, "60 MINUTES", "30 minutes")
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def go():
        writer = idle.writeStream.outputMode("append").format("parquet").option("path", out)
        query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
        assert query.exception() is None
        return [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]

    held = go()
    minute = 60_000_000
    base = int((START - datetime(1970, 1, 1)).total_seconds()) * 1_000_000

    def aged(*actions):
        last = max(m for m, _ in actions)
        return round(sum(w * math.exp(-0.5 * (last - m) / 1440) for m, w in actions), 6)

    expected = [
        (1, base, base + 50 * minute, 3, aged((0, 1), (25, 5), (50, 2))),
        (2, base + 6 * minute, base + 6 * minute, 1, 1.0),
        (2, base + 300 * minute, base + 302 * minute, 3, aged((300, 1), (301, 1), (302, 2))),
        (3, base + 7 * minute, base + 7 * minute, 1, 1.0),
        (4, base + 55 * minute, base + 55 * minute, 1, 1.0),
    ]
    columns = ["user", "since_us", "last_us", "events", "score"]
    assert rows(spark.read.parquet(out), *columns) == expected
    assert max(held) == 4 and held[-1] == 1
    # Run again from its checkpoint, the job has nothing more to send.
    go()
    assert rows(spark.read.parquet(out), *columns) == expected


def test_spells_fold_whatever_their_order():
    parts = [(0, 10, 2, 1.0), (15, 20, 1, 2.0), (40, 45, 1, 1.0), (5, 12, 1, 4.0)]
    folded = jobs._folded(parts, 6, 0.0)
    assert folded == [(0, 20, 4, 7.0), (40, 45, 1, 1.0)]
    assert jobs._folded(reversed(parts), 6, 0.0) == folded == jobs._folded([*folded[:1], *folded[1:]], 6, 0.0)


def test_dedupe_keeps_one_row_per_key(feed):
    twice = [event(8, 2, 1, 10), event(9, 3, 1, 10)]
    acts = jobs.stream_interactions(feed(BATCHES[0] + twice))
    kept = jobs.run_to_table(jobs.stream_dedupe(acts, ["user", "item"], "1 hour").select("user", "item"), "dedupe")
    assert rows(kept) == [(1, 10), (1, 11), (2, 10)]


def test_windows_close_behind_the_watermark(feed):
    acts = jobs.stream_interactions(feed(*BATCHES[:2], [event(8, 76, 1, 12)], BATCHES[2]))
    counts = jobs.run_to_table(jobs.stream_popular(acts, "1 hour", None, "5 minutes"), "popular")
    got = rows(counts.withColumn("h", F.hour("window_start")), "h", "item", "n")
    # A row is late against the watermark the batch before it used: 70 minutes for the
    # last batch, so event 7 finds its window closed. In the end the watermark is at
    # 195 minutes, which leaves the fourth hour open.
    assert got == [(0, 10, 2), (0, 11, 1), (1, 11, 1), (1, 12, 2)]


def test_unmatched_views_come_with_nulls(spark, feed):
    events = feed(*BATCHES)

    def of(kind):
        return events.filter(F.col("event_type") == kind).select(F.col("user_id").alias("user"), "ts", "event_id")

    inner = jobs.run_to_table(jobs.attribute(of("view"), of("purchase"), "80 MINUTES", "6 hours"), "attribute")
    assert rows(inner, "view_id", "buy_id") == [(1, 5), (2, 5), (7, 5)]
