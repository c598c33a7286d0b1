"""Registered queries: streaming jobs run over the whole event table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tastemill.operators import neighbours as nb
from tastemill.operators import interactions as prep
from tastemill.plans import common as c
from tastemill.session import stage_path
from tastemill.streaming import jobs

RATE = 0.1


PARTS = 3


class _Feed:
    """The event table arriving in three parts by time, each one run of a job.

    ``repeats`` sends every third event again with the next part; ``stragglers`` holds every 50th back for one part.
    """

    def __init__(self, s, d, repeats=False, stragglers=False):
        events = c.table(s, d, "events")
        us = F.unix_micros(F.col("ts").cast("timestamp"))
        low, high = events.agg(F.min(us)).scalar(), events.agg(F.max(us)).scalar()
        part = F.floor((us - low) * PARTS / (high - low + 1))
        if stragglers:
            part = F.least(part + F.when(F.col("event_id") % 50 == 0, 1).otherwise(0), F.lit(PARTS - 1))
        if repeats:
            again = F.when(F.col("event_id") % 3 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
            events = events.withColumn("_again", F.explode(again))
            part = F.least(part + F.col("_again"), F.lit(PARTS - 1))
        parts = [events.filter(part == i).drop("_again") for i in range(PARTS)]
        path, self.arrivals = jobs.arriving(s, parts, "feed")
        self.events = jobs.read_events(s, path)
        self.actions = jobs.stream_interactions(self.events)

    def table(self, stream, label, mode="append"):
        return jobs.run_to_table(stream, label, mode, self.arrivals)


def _plain(table, *columns):
    """Times back to wall-clock, as in the tables."""
    for name in columns:
        table = table.withColumn(name, F.col(name).cast("timestamp_ntz"))
    return table


def _popular(size, slide):
    def run(s, d):
        feed = _Feed(s, d)
        counts = jobs.stream_popular(feed.actions, size, slide, "1 hour")
        return _plain(feed.table(counts, "popular"), "window_start", "window_end")

    return run


def _sessions(s, d):
    feed = _Feed(s, d)
    events = feed.events.withColumnRenamed("user_id", "user")
    found = feed.table(jobs.stream_sessions(events, "12 hours", "1 hour"), "sessions")
    return _plain(found, "session_start", "session_end")


def _deduped(s, d):
    feed = _Feed(s, d, repeats=True)
    # A part covers ten days, so a repeat in the next one is not late; only the state of the runs before knows it.
    kept = jobs.stream_dedupe(feed.actions, ["event_id"], "25 days")
    return feed.table(kept.select("event_id", "user", "item"), "dedupe")


def _attributed(how):
    def run(s, d):
        feed = _Feed(s, d)

        def of(kind):
            rows = feed.events.filter(F.col("event_type") == kind)
            return rows.select(F.col("user_id").alias("user"), "ts", "event_id")

        joined = jobs.attribute(of("view"), of("purchase"), "6 HOURS", "1 hour", how)
        return _plain(feed.table(joined, "attribute"), "view_ts", "buy_ts")

    return run


def _profile(s, d):
    feed = _Feed(s, d)
    return jobs.stream_profile(feed.actions, RATE, stage_path(s, "profile"), feed.arrivals)


def _profile_idle(s, d):
    feed = _Feed(s, d)
    return feed.table(jobs.stream_profile_idle(feed.actions, RATE, "12 HOURS", "1 hour"), "profile-idle")


def _near(s, d):
    return nb.cosine(prep.preferences(c.event_interactions(s, d))).nearest(10)


def _scored(s, d):
    feed = _Feed(s, d)
    return feed.table(jobs.stream_score(feed.actions, _near(s, d), 3), "score")


def _cooccur(s, d):
    feed = _Feed(s, d)
    return jobs.stream_cooccur(feed.actions, stage_path(s, "cooccur"), feed.arrivals)


def _late(s, d):
    feed = _Feed(s, d, stragglers=True)
    return jobs.late_report(feed.events, stage_path(s, "late"), 3600, feed.arrivals)


QUERIES = {
    "stream_popular_tumbling": _popular("6 hours", None),
    "stream_popular_sliding": _popular("12 hours", "6 hours"),
    "stream_sessions": _sessions,
    "stream_dedupe": _deduped,
    "stream_attribute": _attributed("inner"),
    "stream_attribute_outer": _attributed("left_outer"),
    "stream_profile": _profile,
    "stream_profile_idle": _profile_idle,
    "stream_cooccur": _cooccur,
    "stream_score": _scored,
    "stream_late_report": _late,
}

# A window counts once the newest event time minus the allowance has passed its end.
_MARK = "mark AS (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 1 HOUR AS mark FROM {source})"


def _windows(starts: str, hours: int) -> str:
    return f"""WITH {c.EVI}, {_MARK.format(source='evi')}, w AS (SELECT i, unnest({starts}) AS ws FROM evi)
        SELECT ws AS window_start, ws + INTERVAL {hours} HOUR AS window_end, i AS item, count(*) AS n FROM w, mark
        WHERE ws + INTERVAL {hours} HOUR <= mark GROUP BY 1, 2, 3"""


_SIX = "time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01')"
_VIEWS = """v AS (SELECT user_id AS u, ts, event_id FROM events WHERE event_type = 'view'),
b AS (SELECT user_id AS u, ts, event_id FROM events WHERE event_type = 'purchase')"""
_MATCH = "b.u = v.u AND b.ts >= v.ts AND b.ts <= v.ts + INTERVAL 6 HOUR"
_JOINED = 'v.u AS "user", v.event_id AS view_id, v.ts AS view_ts, b.event_id AS buy_id, b.ts AS buy_ts'

ORACLE = {
    "stream_popular_tumbling": _windows(f"[{_SIX}]", 6),
    "stream_popular_sliding": _windows(f"[{_SIX}, {_SIX} - INTERVAL 6 HOUR]", 12),
    "stream_sessions": f"""WITH {_MARK.format(source='events')}, g AS (SELECT user_id AS u, ts,
          ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS gap FROM events),
        s AS (SELECT u, ts, sum(CASE WHEN gap IS NULL OR gap >= INTERVAL 12 HOUR THEN 1 ELSE 0 END)
          OVER (PARTITION BY u ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM g),
        t AS (SELECT u, min(ts) AS a, max(ts) + INTERVAL 12 HOUR AS z, count(*) AS n FROM s GROUP BY u, sid)
        SELECT u AS "user", a AS session_start, z AS session_end, n FROM t, mark WHERE z <= mark""",
    "stream_attribute": f"WITH {_VIEWS} SELECT {_JOINED} FROM v JOIN b ON {_MATCH}",
    "stream_attribute_outer": f"""WITH {_VIEWS}, mark AS (SELECT date_trunc('milliseconds', least((SELECT max(ts) FROM v), (SELECT max(ts) FROM b))) - INTERVAL 1 HOUR AS mark)
        SELECT {_JOINED} FROM v LEFT JOIN b ON {_MATCH}, mark WHERE b.u IS NOT NULL OR v.ts + INTERVAL 6 HOUR < mark""",
    "stream_profile": f"""WITH {c.EVI}, t AS (SELECT u, max(epoch_us(ts)) AS last_us FROM evi GROUP BY u)
        SELECT evi.u AS "user", {c.r6(f"sum(w * exp(-{RATE}::DOUBLE * (last_us - epoch_us(ts)) / 86400000000.0::DOUBLE))")} AS score,
          count(*) AS events, max(last_us) AS last_us FROM evi JOIN t ON t.u = evi.u GROUP BY 1""",
    "stream_profile_idle": f"""WITH {c.EVI}, mark AS (SELECT epoch_us(max(ts)) // 1000 - 3600000 AS mark_ms FROM evi),
        g AS (SELECT u, epoch_us(ts) AS us, w, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY u ORDER BY ts) AS gap FROM evi),
        s AS (SELECT u, us, w, sum(CASE WHEN gap IS NULL OR gap >= 43200000000 THEN 1 ELSE 0 END)
          OVER (PARTITION BY u ORDER BY us ROWS UNBOUNDED PRECEDING) AS sid FROM g),
        t AS (SELECT u, us, w, sid, max(us) OVER (PARTITION BY u, sid) AS last_us FROM s)
        SELECT u AS "user", min(us) AS since_us, last_us, count(*) AS events,
          {c.r6(f"sum(w * exp(-{RATE}::DOUBLE * (last_us - us) / 86400000000.0::DOUBLE))")} AS score
        FROM t, mark WHERE (last_us + 43200000000 + 999) // 1000 < mark_ms GROUP BY u, sid, last_us""",
    "stream_cooccur": f"""WITH {c.EVI}, p AS (SELECT DISTINCT u, i FROM evi)
        SELECT x.i AS a, y.i AS b, count(*) AS k FROM p x JOIN p y ON x.u = y.u AND x.i < y.i GROUP BY 1, 2""",
    "stream_score": f"""WITH {c.EVI}, pref AS MATERIALIZED (SELECT DISTINCT u, i FROM evi), {c.PAIRS},
        sim AS (SELECT a, b, k, {c.r6('k / sqrt(CAST(n_a AS DOUBLE) * n_b)')} AS score FROM sized), {c.near_sql('sim', 10)}
        SELECT event_id, u AS "user", i AS item, b AS next, score, rank FROM evi JOIN near ON near.a = evi.i WHERE rank <= 3""",
    "stream_dedupe": f'WITH {c.EVI} SELECT event_id, u AS "user", i AS item FROM evi',
    "stream_late_report": f"""WITH t AS (SELECT event_id, epoch_us(ts) AS us, min(epoch_us(ts)) OVER () AS low, max(epoch_us(ts)) OVER () AS high FROM events),
        p AS (SELECT us, least(CAST(floor((us - low) * {PARTS} / (high - low + 1)) AS BIGINT) + CASE WHEN event_id % 50 = 0 THEN 1 ELSE 0 END, {PARTS - 1}) AS batch FROM t),
        m AS (SELECT batch, max(us) AS newest FROM p GROUP BY 1),
        e AS (SELECT batch, newest, max(newest) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 3600000000 AS lim FROM m)
        SELECT count(*) AS rows, count(*) FILTER (us < lim) AS late, any_value(newest) AS newest_us, batch FROM p JOIN e USING (batch) GROUP BY batch""",
}
