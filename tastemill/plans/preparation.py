"""Registered queries: sources, preparation, popularity and baselines."""

from __future__ import annotations

from pyspark.sql import functions as F

from tastemill.operators import baseline, interactions as prep
from tastemill.plans import common as c
from tastemill.session import stage_path
from tastemill.sources import tables

AS_OF = "2001-08-01"


def _latest(s, d):
    return prep.dedupe_latest(c.purchases(s, d), ["user", "item"], ["basket", "weight"])


def _event_steps(s, d):
    return c.table(s, d, "events").select(F.col("user_id").alias("user"), "ts", "event_id")


def _baskets(s, d):
    made = prep.baskets(prep.basket_items(c.purchases(s, d)))
    return made.select("basket", "part", F.array_join("items", ",").alias("items"))


def _sequences(s, d):
    made = prep.sequences(c.event_interactions(s, d))
    return made.select(
        "user",
        "part",
        F.array_join("seq.event_id", ",").alias("event_ids"),
        F.array_join("seq.item", ",").alias("items"),
    )


def _negatives(s, d):
    items = c.table(s, d, "part").select(F.col("p_partkey").alias("item"))
    # Buckets smaller than the sample, so that every user goes through several rounds.
    return prep.negative_sample(c.prefs(s, d), items, 5, 7, 4)


def _nation_lists(s, d):
    return baseline.popular_by(
        c.prefs(s, d),
        c.table(s, d, "customer").select(F.col("c_custkey").alias("user"), F.col("c_nationkey").cast("bigint").alias("nation")),
        "nation",
        20,
    ).select(F.col("nation").alias("user"), "item", F.col("users").cast("double").alias("score"), "rank")


def _written(s, d):
    path = stage_path(s, "recs")
    tables.write_recs(_nation_lists(s, d), path, 8)
    return tables.read_recs(s, path)


def _saved(s, d):
    """A part's rank among the best of a nation beside each owner there: saved lists joined in their buckets."""
    path = stage_path(s, "saved")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    tables.save_recs_table(_nation_lists(s, d), name, 8, path)
    people = c.table(s, d, "customer").select(F.col("c_nationkey").cast("bigint").alias("user"), F.col("c_custkey").alias("customer"))
    owned = c.prefs(s, d).select(F.col("user").alias("customer"), "item").join(people, "customer")
    joined = tables.join_saved(s.table(name), owned.withColumnRenamed("item", "owned"), 8)
    return joined.filter("item = owned").select(F.col("user").alias("nation"), "customer", "item", "rank")


def _popular_segment(s, d):
    users = c.table(s, d, "customer").select(F.col("c_custkey").alias("user"), "c_mktsegment")
    return baseline.popular_by(c.prefs(s, d), users, "c_mktsegment", 10)


QUERIES = {
    "purchases": c.purchases,
    "event_interactions": c.event_interactions,
    "preferences_sum": c.prefs,
    "preferences_count": lambda s, d: prep.preferences(c.purchases(s, d), "count"),
    "preferences_max": lambda s, d: prep.preferences(c.purchases(s, d), "max"),
    "preferences_last": lambda s, d: prep.preferences(c.purchases(s, d), "last", ["basket"]),
    "decay": lambda s, d: prep.decay(c.purchases(s, d), AS_OF, 0.001),
    "binarise": lambda s, d: prep.binarise(c.prefs(s, d), 20.0),
    "k_core": lambda s, d: prep.k_core(c.prefs(s, d), 22, 22),
    "index_ids": lambda s, d: prep.index_ids(c.prefs(s, d), "user"),
    "indexed_preferences": lambda s, d: prep.apply_index(
        c.prefs(s, d), prep.index_ids(c.prefs(s, d), "user"), "user"
    ),
    "dedupe_latest": _latest,
    "sessionise": lambda s, d: prep.sessionise(_event_steps(s, d), 12 * 3600),
    "baskets": _baskets,
    "sequences": _sequences,
    "negative_sample": _negatives,
    "split_last_one": lambda s, d: prep.split_last_one(_latest(s, d)),
    "split_by_date": lambda s, d: prep.split_by_date(c.purchases(s, d), "2000-01-01"),
    "split_last_fraction": lambda s, d: prep.split_last_fraction(_latest(s, d), 0.2),
    "split_by_hash": lambda s, d: prep.split_by_hash(c.prefs(s, d), 20, "fold"),
    "write_recs": _written,
    "saved_recs_join": _saved,
    "derived_ratings": c.ratings,
    "popular": lambda s, d: baseline.popular(c.prefs(s, d), 50),
    "popularity_ranks": lambda s, d: baseline.popularity_ranks(c.prefs(s, d)),
    "popular_by": _popular_segment,
    "trending": lambda s, d: baseline.trending(c.purchases(s, d), AS_OF, 90, 360, 50),
    "centre_mean": lambda s, d: baseline.centre(c.ratings(s, d), "item"),
    "centre_z": lambda s, d: baseline.centre(c.ratings(s, d), "user", "z"),
    "bias_baseline": lambda s, d: baseline.bias_baseline(c.ratings(s, d), 5.0, 10.0),
    "shrunk_mean": lambda s, d: baseline.shrunk_mean(c.prefs(s, d), 20.0),
    "wilson_lower": lambda s, d: baseline.wilson_lower(c.prefs(s, d), 30.0),
}

_LATEST = f"""{c.PUR}, latest AS MATERIALIZED (SELECT u, i, ts, w, basket FROM (
  SELECT *, row_number() OVER (PARTITION BY u, i ORDER BY ts DESC, basket DESC, w DESC) AS rn FROM pur) WHERE rn = 1)"""
_OUT = 'u AS "user", i AS item'
_AS_OF = f"DATE '{AS_OF}'"


def _core_rounds(rounds: int, k: int) -> str:
    """The k-core unrolled; more rounds than needed change nothing."""
    parts, last = [], "pref"
    for step in range(rounds):
        parts.append(
            f"u{step} AS MATERIALIZED (SELECT * FROM {last} WHERE u IN "
            f"(SELECT u FROM {last} GROUP BY u HAVING count(*) >= {k})), "
            f"c{step} AS MATERIALIZED (SELECT * FROM u{step} WHERE i IN "
            f"(SELECT i FROM u{step} GROUP BY i HAVING count(*) >= {k}))"
        )
        last = f"c{step}"
    return f"WITH {c.PREF}, " + ", ".join(parts) + f' SELECT {_OUT}, w AS weight, last_ts FROM {last}'


def _negative_sql(n: int, seed: int, bucket_items: int) -> str:
    return f"""WITH {c.PREF}, size AS (SELECT greatest(1, count(*) // {bucket_items}) AS nb FROM part),
    users AS (SELECT DISTINCT u, {c.hash_int('u', str(seed))} % nb AS home, nb FROM pref, size),
    items AS (SELECT p_partkey AS i, {c.hash_int(str(seed), 'p_partkey')} % nb AS bucket FROM part, size),
    draws AS (SELECT u, i, CAST(floor(log2((bucket - home + nb) % nb + 1)) AS INTEGER) AS round, {c.hash_int('u', 'i', str(seed))} AS h
      FROM users, items WHERE NOT EXISTS (SELECT 1 FROM pref p WHERE p.u = users.u AND p.i = items.i))
    SELECT * FROM (SELECT {_OUT}, round, {c.rank_int('u', 'round, h, i')} AS rank FROM draws) WHERE rank <= {n}"""


_LISTS = f"""{c.PREF}, t AS (SELECT CAST(c_nationkey AS BIGINT) AS nation, i, count(*) AS users, {c.xsum('w', '1e6')} AS wt
        FROM pref JOIN customer ON c_custkey = u GROUP BY 1, 2),
    lists AS (SELECT * FROM (SELECT nation AS "user", i AS item, CAST(users AS DOUBLE) AS score,
          {c.rank_int('nation', 'users DESC, wt DESC, i')} AS rank FROM t) WHERE rank <= 20)"""

ORACLE = {
    "purchases": f'WITH {c.PUR} SELECT {_OUT}, ts, w AS weight, basket FROM pur',
    "event_interactions": f'WITH {c.EVI} SELECT {_OUT}, ts, w AS weight, event_id FROM evi',
    "preferences_sum": f'WITH {c.PREF} SELECT {_OUT}, w AS weight, last_ts FROM pref',
    "preferences_count": f'WITH {c.PUR} SELECT {_OUT}, CAST(count(w) AS DOUBLE) AS weight, max(ts) AS last_ts FROM pur GROUP BY u, i',
    "preferences_max": f'WITH {c.PUR} SELECT {_OUT}, max(w) AS weight, max(ts) AS last_ts FROM pur GROUP BY u, i',
    "preferences_last": f'WITH {_LATEST} SELECT {_OUT}, w AS weight, ts AS last_ts FROM latest',
    "decay": f"""WITH {c.PUR} SELECT {_OUT}, ts,
        {c.r6(f"w * exp(-0.001 * datediff('day', CAST(ts AS DATE), {_AS_OF}))")} AS weight, basket FROM pur""",
    "binarise": f'WITH {c.PREF} SELECT {_OUT}, CAST(1.0 AS DOUBLE) AS weight, last_ts FROM pref WHERE w >= 20',
    "k_core": _core_rounds(6, 22),
    "index_ids": f"""WITH {c.PREF} SELECT u AS "user", row_number() OVER (ORDER BY u) - 1 AS idx
        FROM (SELECT DISTINCT u FROM pref)""",
    "indexed_preferences": f"""WITH {c.PREF} SELECT dense_rank() OVER (ORDER BY u) - 1 AS "user", i AS item,
        w AS weight, last_ts FROM pref""",
    "dedupe_latest": f'WITH {_LATEST} SELECT {_OUT}, ts, w AS weight, basket FROM latest',
    "sessionise": """WITH gaps AS (SELECT user_id, ts, event_id,
        epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS gap FROM events)
        SELECT user_id AS "user", ts, event_id, CAST(sum(CASE WHEN gap IS NULL OR gap > 43200000000 THEN 1 ELSE 0 END)
          OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session FROM gaps""",
    "baskets": """WITH d AS (SELECT DISTINCT l_orderkey AS basket, l_partkey AS item FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
        n AS (SELECT *, CAST((row_number() OVER (PARTITION BY basket ORDER BY item) - 1) // 4096 AS INTEGER) AS part FROM d)
        SELECT basket, part, string_agg(CAST(item AS VARCHAR), ',' ORDER BY item) AS items FROM n GROUP BY 1, 2""",
    "sequences": f"""WITH {c.EVI}, n AS (SELECT *, CAST((row_number() OVER (PARTITION BY u ORDER BY ts, event_id) - 1) // 4096 AS INTEGER) AS part FROM evi)
        SELECT u AS "user", part, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY ts, event_id) AS event_ids,
          string_agg(CAST(i AS VARCHAR), ',' ORDER BY ts, event_id) AS items FROM n GROUP BY u, part""",
    "negative_sample": _negative_sql(5, 7, 4),
    "split_last_one": f"""WITH {_LATEST} SELECT {_OUT}, ts, w AS weight, basket,
        CASE WHEN row_number() OVER (PARTITION BY u ORDER BY ts DESC, i DESC) = 1 THEN 'test' ELSE 'train' END AS fold FROM latest""",
    "split_by_date": f"""WITH {c.PUR} SELECT {_OUT}, ts, w AS weight, basket,
        CASE WHEN ts >= TIMESTAMP '2000-01-01' THEN 'test' ELSE 'train' END AS fold FROM pur""",
    "split_last_fraction": f"""WITH {_LATEST} SELECT {_OUT}, ts, w AS weight, basket,
        CASE WHEN percent_rank() OVER (PARTITION BY u ORDER BY ts, i) >= 1.0::DOUBLE - 0.2::DOUBLE THEN 'test' ELSE 'train' END AS fold FROM latest""",
    "split_by_hash": f"""WITH {c.PREF} SELECT {_OUT}, w AS weight, last_ts,
        CASE WHEN {c.hash_int("'fold'", 'u', 'i')} % 100 < 20 THEN 'test' ELSE 'train' END AS fold FROM pref""",
    "write_recs": f"WITH {_LISTS} SELECT * FROM lists",
    "saved_recs_join": f"""WITH {_LISTS} SELECT lists.user AS nation, c_custkey AS customer, item, rank
        FROM lists JOIN customer ON c_nationkey = lists.user JOIN pref ON pref.u = c_custkey AND pref.i = item""",
    "derived_ratings": f'WITH {c.RATING} SELECT {_OUT}, CAST(r AS DOUBLE) AS rating FROM rating',
    "popular": f"""WITH {c.PREF} SELECT i AS item, count(*) AS users, {c.xsum('w', '1e6')} AS weight
        FROM pref GROUP BY i ORDER BY users DESC, weight DESC, item LIMIT 50""",
    "popularity_ranks": f"""WITH {c.PREF}, t AS (SELECT i, count(*) AS users, {c.xsum('w', '1e6')} AS wt FROM pref GROUP BY i)
        SELECT i AS item, row_number() OVER (ORDER BY users DESC, wt DESC, i) AS pop FROM t""",
    "popular_by": f"""WITH {c.PREF}, t AS (SELECT c_mktsegment, i AS item, count(*) AS users, {c.xsum('w', '1e6')} AS weight
        FROM pref JOIN customer ON c_custkey = u GROUP BY 1, 2)
        SELECT * FROM (SELECT *, {c.rank_int('c_mktsegment', 'users DESC, weight DESC, item')} AS rank FROM t) WHERE rank <= 10""",
    "trending": f"""WITH {c.PUR}, aged AS (SELECT i, datediff('day', CAST(ts AS DATE), {_AS_OF}) AS age FROM pur),
        n AS (SELECT i, count(*) FILTER (age < 90) AS recent, count(*) FILTER (age >= 90) AS base
          FROM aged WHERE age >= 0 AND age < 450 GROUP BY i)
        SELECT i AS item, recent, base, {c.r6('(recent + 1) * 360.0::DOUBLE / ((base + 1) * 90.0::DOUBLE)')} AS score
        FROM n ORDER BY score DESC, item LIMIT 50""",
    "centre_mean": f"""WITH {c.RATING}, s AS (SELECT i, {c.xsum('r', '1e6')} / count(*) AS mean FROM rating GROUP BY i)
        SELECT u AS "user", rating.i AS item, {c.r6('r - mean')} AS rating FROM rating JOIN s ON s.i = rating.i""",
    "centre_z": f"""WITH {c.RATING}, s AS (SELECT u, {c.xsum('r', '1e6')} / count(*) AS mean, {c.xsum('r * r', '1e6')} / count(*) AS sq FROM rating GROUP BY u),
        v AS (SELECT u, mean, sqrt(greatest(0.0::DOUBLE, sq - mean * mean)) AS sd FROM s)
        SELECT rating.u AS "user", i AS item, {c.r6('CASE WHEN sd > 1e-9 THEN (r - mean) / sd ELSE 0.0::DOUBLE END')} AS rating
        FROM rating JOIN v ON v.u = rating.u""",
    "bias_baseline": f"""WITH {c.RATING}, m AS (SELECT {c.xsum('r', '1e6')} / count(*) AS mu FROM rating),
        bi AS (SELECT i, {c.xsum('r - mu')} / (count(*) + 5.0::DOUBLE) AS b_item FROM rating, m GROUP BY i),
        bu AS (SELECT u, {c.xsum('r - mu - b_item')} / (count(*) + 10.0::DOUBLE) AS b_user
          FROM rating JOIN bi USING (i), m GROUP BY u)
        SELECT u AS "user", i AS item, CAST(r AS DOUBLE) AS rating, {c.r6('mu + b_item + b_user')} AS predicted
        FROM rating JOIN bi USING (i) JOIN bu USING (u), m""",
    "shrunk_mean": f"""WITH {c.PREF}, m AS (SELECT {c.xsum('w', '1e6')} / count(*) AS mu FROM pref),
        t AS (SELECT i, count(*) AS n, {c.xsum('w', '1e6')} AS s FROM pref GROUP BY i)
        SELECT i AS item, n, {c.r6('(s + 20.0::DOUBLE * mu) / (n + 20.0::DOUBLE)')} AS score FROM t, m""",
    "wilson_lower": f"""WITH {c.PREF}, t AS (SELECT i, count(*) AS n, count(*) FILTER (w >= 30) AS liked FROM pref GROUP BY i),
        p AS (SELECT i, n, liked, liked / n AS p, 1.96::DOUBLE AS z FROM t)
        SELECT i AS item, n, liked, {c.r6('(p + z * z / (2.0 * n) - z * sqrt((p * (1.0 - p) + z * z / (4.0 * n)) / n)) / (1.0 + z * z / n)')} AS score FROM p""",
}
