"""Windows, sessions, joins and incremental tables over the event stream."""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tastemill.functions.exact import exact_sum, require, round6
from tastemill.functions.pairs import pair_stats, pairs_between
from tastemill.session import stage_path, write_stage
from tastemill.sources.tables import EVENT_WEIGHTS, event_interactions


def read_events(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """The event files at ``path`` as a stream, ``ts`` as TIMESTAMP so it can carry a watermark."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))


def _finish(writer: DataStreamWriter, checkpoint: str) -> None:
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


#: What to do before each run over a source; a single run over what is there has one empty step.
Arrivals = Sequence[Callable[[], None]]
_AT_ONCE: Arrivals = (lambda: None,)


def _run(writer: DataStreamWriter, checkpoint: str, arrivals: Arrivals) -> None:
    """Each step's rows are one run of the job, which goes on from its checkpoint."""
    for arrive in arrivals:
        arrive()
        _finish(writer, checkpoint)


def run_to_table(
    stream: DataFrame, label: str, mode: str = "append", arrivals: Arrivals = _AT_ONCE
) -> DataFrame:
    """Run over what is there, or over what arrives step by step, and read the result back.

    Append results go to the exactly-once parquet sink, update results to one
    folder per batch; nothing is held on the driver.
    """
    spark = stream.sparkSession
    out, checkpoint = stage_path(spark, label), stage_path(spark, f"{label}-state")
    if mode == "append":
        writer = stream.writeStream.outputMode("append").format("parquet").option("path", out)
        _run(writer, checkpoint, arrivals)
        return spark.read.schema(stream.schema).parquet(out)

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    _run(stream.writeStream.outputMode(mode).foreachBatch(save), checkpoint, arrivals)
    return spark.read.option("basePath", out).parquet(out)


def arriving(spark: SparkSession, parts: Sequence[DataFrame], label: str) -> tuple[str, Arrivals]:
    """A folder that begins empty, and the steps that add one of ``parts`` after the other to it."""
    path = stage_path(spark, label)
    parts[0].limit(0).write.parquet(path)

    def step(part: DataFrame) -> Callable[[], None]:
        return lambda: part.write.mode("append").parquet(path)

    return path, [step(p) for p in parts]


def stream_popular(interactions: DataFrame, size: str, slide: str | None, late: str) -> DataFrame:
    """Actions per item and event-time window; a window appears once it is closed."""
    require(interactions, "ts", "item")
    window = F.window("ts", size, slide) if slide else F.window("ts", size)
    counts = interactions.withWatermark("ts", late).groupBy(window.alias("w"), "item").count()
    return counts.select(
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        "item",
        F.col("count").alias("n"),
    )


def stream_sessions(events: DataFrame, gap: str, late: str) -> DataFrame:
    """Closed sessions per user: no event for ``gap``.

    Sessions are merged inside each task before the shuffle, so a hot user
    sends sessions and not events to its state.
    """
    require(events, "ts", "user")
    events.sparkSession.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    sessions = events.withWatermark("ts", late).groupBy("user", F.session_window("ts", gap).alias("s")).count()
    return sessions.select(
        "user",
        F.col("s.start").alias("session_start"),
        F.col("s.end").alias("session_end"),
        F.col("count").alias("n"),
    )


def stream_dedupe(events: DataFrame, keys: list[str], late: str) -> DataFrame:
    """First row per key while the watermark keeps the key."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(keys)


def attribute(
    views: DataFrame, purchases: DataFrame, within: str, late: str, how: str = "inner"
) -> DataFrame:
    """Views joined to the same user's purchases up to ``within`` later.

    Both sides carry (user, ts, event_id). Time is cut into slots of ``within``;
    a purchase meets the views of its own slot and of the one before, so a hot
    user's state is spread over slots. With ``left_outer`` a view without a
    purchase appears with nulls once none can arrive any more.
    """
    spark = views.sparkSession
    end = spark.sql(f"SELECT unix_micros(TIMESTAMP_SECONDS(0) + INTERVAL {within})").first()[0]

    def slot(column: str) -> Column:
        return F.floor(F.unix_micros(column) / F.lit(end))

    left = views.select("user", F.col("ts").alias("view_ts"), F.col("event_id").alias("view_id"))
    right = purchases.select(
        F.col("user").alias("buyer"), F.col("ts").alias("buy_ts"), F.col("event_id").alias("buy_id")
    )
    left = left.withWatermark("view_ts", late).withColumn("view_slot", slot("view_ts"))
    right = right.withWatermark("buy_ts", late).withColumn(
        "buy_slot", F.explode(F.array(slot("buy_ts"), slot("buy_ts") - 1))
    )
    reach = F.expr(
        "user = buyer AND view_slot = buy_slot AND buy_ts >= view_ts"
        f" AND buy_ts <= view_ts + INTERVAL {within}"
    )
    return left.join(right, reach, how).select("user", "view_id", "view_ts", "buy_id", "buy_ts")


_PROFILE = "user bigint, slot bigint, score double, events bigint, last_us bigint"
_DAY_US = 86_400_000_000


def profile_batch(store: str, rate: float) -> Callable[[DataFrame, int], None]:
    """Adds a batch's decayed sums to the store, one row per user and day.

    The sums are plain aggregates, partly added up before the shuffle, so a hot
    user is one row per task and day. A repeated batch overwrites its own folder.
    """

    def update(batch: DataFrame, batch_id: int) -> None:
        us = F.unix_micros("ts")
        day = F.floor(us / F.lit(_DAY_US))
        aged = F.col("weight") * F.exp(-rate * ((day + 1) * F.lit(_DAY_US) - us) / float(_DAY_US))
        (
            batch.groupBy("user", day.alias("slot"))
            .agg(
                exact_sum(aged, 1e12).alias("score"),
                F.count(F.lit(1)).alias("events"),
                F.max(us).alias("last_us"),
            )
            .write.mode("overwrite")
            .parquet(f"{store}/profile/batch={batch_id}")
        )

    return update


def stream_profile(
    interactions: DataFrame, rate: float, store: str, arrivals: Arrivals = _AT_ONCE
) -> DataFrame:
    """Decayed weight per user as of the user's newest event, kept up to date in ``store``.

    A decayed sum only changes by a factor as time goes on, so the parts of all
    batches add up whatever their order.
    """
    require(interactions, "user", "ts", "weight")
    spark = interactions.sparkSession
    _open_store(spark, f"{store}/profile", _PROFILE)
    _run(interactions.writeStream.foreachBatch(profile_batch(store, rate)), f"{store}/checkpoint", arrivals)
    return stored_profile(spark, store, rate)


def stored_profile(spark: SparkSession, store: str, rate: float) -> DataFrame:
    """The profiles of all batches so far."""
    return merge_profiles(spark.read.schema(f"{_PROFILE}, batch bigint").parquet(f"{store}/profile"), rate)


def merge_profiles(partials: DataFrame, rate: float) -> DataFrame:
    """One row per user: each part is aged from the end of its day to the user's newest event."""
    last = partials.groupBy("user").agg(F.max("last_us").alias("newest"))
    days = (F.col("newest") - (F.col("slot") + 1) * F.lit(_DAY_US)) / float(_DAY_US)
    return (
        partials.join(last, "user")
        .groupBy("user")
        .agg(
            round6(exact_sum(F.col("score") * F.exp(-rate * days), 1e12)).alias("score"),
            F.sum("events").alias("events"),
            F.max("newest").alias("last_us"),
        )
    )


#: A run of one user's actions: first and last time in microseconds, their number, the decayed weight.
Spell = tuple[int, int, int, float]
_IDLE = "user bigint, since_us bigint, last_us bigint, events bigint, score double"
_OPEN = "since array<bigint>, last array<bigint>, events array<bigint>, score array<double>"


def _folded(spells: Iterable[Spell], idle_us: int, rate: float) -> list[Spell]:
    """Spells (since, last, events, score) with less than ``idle_us`` between them made one, in order of time."""
    merged: list[Spell] = []
    for since, last, events, score in sorted(spells):
        if merged and since - merged[-1][1] < idle_us:
            first, before, n, old = merged.pop()
            newest = max(before, last)
            aged = old * math.exp(-rate * (newest - before) / _DAY_US) + score * math.exp(-rate * (newest - last) / _DAY_US)
            since, last, events, score = first, newest, n + events, aged
        merged.append((since, last, events, score))
    return merged


def _spells_of_task(idle_us: int, rate: float):
    """The spells of each Arrow batch: what a hot user sends to its state."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch.sort_values(["user", "us"], kind="stable")
            user, us = batch["user"].to_numpy(), batch["us"].to_numpy()
            if not len(us):
                continue
            start = np.flatnonzero(np.append(True, (user[1:] != user[:-1]) | (us[1:] - us[:-1] >= idle_us)))
            size = np.diff(np.append(start, len(us)))
            last = us[start + size - 1]
            aged = batch["weight"].to_numpy() * np.exp(-rate * (np.repeat(last, size) - us) / _DAY_US)
            yield pd.DataFrame(
                {
                    "user": user[start],
                    "ts": pd.to_datetime(last, unit="us", utc=True),
                    "since_us": us[start],
                    "last_us": last,
                    "events": size,
                    "score": np.add.reduceat(aged, start),
                }
            )

    return partial


def _close_idle(idle_us: int, rate: float):
    def keep(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        spells = list(zip(*state.get)) if state.exists else []
        for part in parts:
            arrived = part[["since_us", "last_us", "events", "score"]].itertuples(index=False, name=None)
            spells = _folded([*spells, *arrived], idle_us, rate)
        mark = state.getCurrentWatermarkMs()
        # The millisecond after which nothing can join a spell any more.
        ends = [-(-(spell[1] + idle_us) // 1000) for spell in spells]
        closed = [spell for spell, end in zip(spells, ends) if end < mark]
        still = [spell for spell, end in zip(spells, ends) if end >= mark]
        if still:
            state.update(tuple(list(column) for column in zip(*still)))
            state.setTimeoutTimestamp(max(mark + 1, min(end for end in ends if end >= mark)))
        elif state.exists:
            state.remove()
        if closed:
            out = pd.DataFrame(closed, columns=["since_us", "last_us", "events", "score"])
            out.insert(0, "user", key[0])
            yield out

    return keep


def stream_profile_idle(interactions: DataFrame, rate: float, idle: str, late: str) -> DataFrame:
    """A user's profile once the user has been idle: (user, since_us, last_us, events, score).

    A profile is the decayed weight, as of its newest event, of a spell of
    actions with less than ``idle`` between them. It is sent when the watermark
    has passed its last action by ``idle``; a timer does so for users who never
    return, and their state is removed. State is four numbers for each spell
    that is still open, and so bounded by how far rows may be late. Actions are
    folded to spells inside each task first, so a hot user sends one row for
    each Arrow batch and spell. An action without user, time or weight is left
    out; one that comes after its spell was sent begins a spell of its own, if
    the watermark lets it in at all.
    """
    require(interactions, "user", "ts", "weight")
    spark = interactions.sparkSession
    idle_us = spark.sql(f"SELECT unix_micros(TIMESTAMP_SECONDS(0) + INTERVAL {idle})").first()[0]
    rows = interactions.select("user", F.unix_micros("ts").alias("us"), F.col("weight").cast("double").alias("weight"))
    spells = rows.dropna().mapInPandas(
        _spells_of_task(idle_us, rate),
        "user bigint, ts timestamp, since_us bigint, last_us bigint, events bigint, score double",
    )
    return (
        spells.withWatermark("ts", late)
        .groupBy("user")
        .applyInPandasWithState(_close_idle(idle_us, rate), _IDLE, _OPEN, "append", GroupStateTimeout.EventTimeTimeout)
        .withColumn("score", round6(F.col("score")))
    )


def _open_store(spark: SparkSession, path: str, schema: str) -> None:
    """An empty first folder, so that every batch can read what came before it."""
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{path}/batch=-1")


def _earlier(spark: SparkSession, path: str, batch_id: int, schema: str) -> DataFrame:
    """What batches before this one wrote; a replayed batch sees the same rows again."""
    rows = spark.read.schema(f"{schema}, batch bigint").parquet(path)
    return rows.filter(F.col("batch") < batch_id).drop("batch")


_OWNED = "user bigint, item bigint"
_REPORT = "rows bigint, late bigint, newest_us bigint"


#: Users of the co-occurrence store are dealt to so many folders; a batch reads only those its users are in.
_BUCKETS = 64
#: So many runs of one length are merged into the next longer one.
_FAN = 4
Run = tuple[int, int]


def owned_runs(batch_id: int) -> list[Run]:
    """The runs (first batch, batch after the last) that hold what came before ``batch_id``.

    Their lengths are the digits of the number in base ``_FAN``, so there are
    few of them, and they depend on nothing but the number.
    """
    size, low, runs = 1, 0, []
    while size * _FAN <= batch_id:
        size *= _FAN
    while size:
        while low + size <= batch_id:
            runs.append((low, low + size))
            low += size
        size //= _FAN
    return runs


def _run_path(store: str, run: Run) -> str:
    return f"{store}/owned/from={run[0]}/to={run[1]}"


def _read_runs(spark: SparkSession, store: str, runs: list[Run]) -> DataFrame:
    paths = [_run_path(store, run) for run in runs]
    if not paths:
        return spark.createDataFrame([], f"{_OWNED}, bucket int")
    reader = spark.read.schema(f"{_OWNED}, bucket int").option("basePath", f"{store}/owned")
    return reader.parquet(*paths).select("user", "item", "bucket")


def _write_run(rows: DataFrame, store: str, run: Run) -> None:
    # Even parts by bucket; a bucket with a hot user is split over several.
    rows.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(_run_path(store, run))


def merge_runs(spark: SparkSession, store: str, batch_id: int) -> None:
    """Merges the runs that end where ``batch_id`` begins, when enough of one length are there.

    A row is rewritten once for each length of run, so the work for all batches
    grows with the rows and the logarithm of the number of batches. The merged
    run is made of shorter ones that stay, so doing it again changes nothing.
    """
    runs = owned_runs(batch_id)
    if not runs or runs[-1][1] - runs[-1][0] == 1:
        return
    parts = [run for run in owned_runs(batch_id - 1) if run[0] >= runs[-1][0]] + [(batch_id - 1, batch_id)]
    _write_run(_read_runs(spark, store, parts), store, runs[-1])


def owned_by(arrived: DataFrame, store: str, batch_id: int) -> DataFrame:
    """What batches before ``batch_id`` left in the buckets of the users in ``arrived`` (user, item, bucket)."""
    # At most one row a bucket.
    buckets = [r["bucket"] for r in arrived.select("bucket").distinct().collect()]
    known = _read_runs(arrived.sparkSession, store, owned_runs(batch_id))
    return known.filter(F.col("bucket").isin(buckets))


def cooccur_batch(store: str, buckets: int = _BUCKETS) -> Callable[[DataFrame, int], None]:
    """Adds a batch's new (user, item) pairs and the pair counts they cause to the store.

    Owned pairs lie in folders by run of batches and bucket of users. A batch
    reads the buckets its users are in, and writes a run of its own; runs are
    merged as ``merge_runs`` says. What is read and written follows from the
    batch's number and rows alone, so a repeated batch changes nothing. Only
    pairs with at least one new member are counted. ``buckets`` belongs to the
    store and must not change. Rows without user or item are left out.
    """

    def update(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        merge_runs(spark, store, batch_id)
        bucket = F.pmod(F.xxhash64("user"), F.lit(buckets)).cast("int")
        arrived = batch.select("user", "item").dropna().distinct().withColumn("bucket", bucket)
        arrived = write_stage(arrived, "arrived")
        known = owned_by(arrived, store, batch_id)
        own = (batch_id, batch_id + 1)
        _write_run(arrived.join(known, ["bucket", "user", "item"], "left_anti"), store, own)
        fresh = _read_runs(spark, store, [own])
        inside = pair_stats(fresh, "user", "item", [F.count(F.lit(1)).alias("k")])
        old = known.join(fresh.select("user").distinct(), "user", "left_semi")
        met = pairs_between(fresh, old, "user", "item")
        across = met.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.count(F.lit(1)).alias("k"))
        counts = inside.unionByName(across).groupBy("a", "b").agg(F.sum("k").alias("k"))
        counts.write.mode("overwrite").parquet(f"{store}/pairs/batch={batch_id}")

    return update


def stream_cooccur(
    interactions: DataFrame, store: str, arrivals: Arrivals = _AT_ONCE, buckets: int = _BUCKETS
) -> DataFrame:
    """Keeps co-occurrence counts up to date in ``store``; returns the totals so far."""
    require(interactions, "user", "item")
    spark = interactions.sparkSession
    _run(interactions.writeStream.foreachBatch(cooccur_batch(store, buckets)), f"{store}/checkpoint", arrivals)
    return stored_cooccur(spark, store)


def stored_cooccur(spark: SparkSession, store: str) -> DataFrame:
    """The pair counts of all batches so far."""
    rows = spark.read.schema("a bigint, b bigint, k bigint, batch bigint").parquet(f"{store}/pairs")
    return rows.groupBy("a", "b").agg(F.sum("k").alias("k"))


def stream_score(interactions: DataFrame, near: DataFrame, n: int) -> DataFrame:
    """Next items for each event from a batch neighbour table (a, b, score, rank).

    The table already ranks the neighbours of an item, so the best n of an
    event are a filter: the join needs no state and no window.
    """
    require(interactions, "event_id", "user", "item")
    links = near.filter(F.col("rank") <= n).select(
        F.col("a").alias("item"), F.col("b").alias("next"), "score", "rank"
    )
    return interactions.join(links, "item").select("event_id", "user", "item", "next", "score", "rank")


def late_batch(store: str, late_seconds: int) -> Callable[[DataFrame, int], None]:
    """Per batch: rows, rows older than the newest earlier time minus the allowance, newest time."""

    def report(batch: DataFrame, batch_id: int) -> None:
        earlier = _earlier(batch.sparkSession, f"{store}/report", batch_id, _REPORT)
        limit = earlier.agg((F.max("newest_us") - late_seconds * 1_000_000).alias("limit")).scalar()
        us = F.unix_micros("ts")
        (
            batch.select(us.alias("us"))
            .withColumn("_limit", limit)
            .agg(
                F.count(F.lit(1)).alias("rows"),
                F.count_if(F.col("us") < F.col("_limit")).alias("late"),
                F.max("us").alias("newest_us"),
            )
            .write.mode("overwrite")
            .parquet(f"{store}/report/batch={batch_id}")
        )

    return report


def late_report(
    events: DataFrame, store: str, late_seconds: int, arrivals: Arrivals = _AT_ONCE
) -> DataFrame:
    """Late rows per batch, counted apart from the jobs that drop them."""
    spark = events.sparkSession
    _open_store(spark, f"{store}/report", _REPORT)
    _run(events.writeStream.foreachBatch(late_batch(store, late_seconds)), f"{store}/checkpoint", arrivals)
    rows = spark.read.schema(f"{_REPORT}, batch bigint").parquet(f"{store}/report")
    return rows.filter(F.col("batch") >= 0)


def stream_interactions(events: DataFrame) -> DataFrame:
    return event_interactions(events, EVENT_WEIGHTS)


# Tasks get this module's functions by value, so workers need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
