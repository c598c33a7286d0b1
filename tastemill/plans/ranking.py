"""Registered queries: features and ranking models."""

from __future__ import annotations

from pyspark.sql import functions as F

from tastemill.functions.exact import hash_int
from tastemill.operators import ranking as rk
from tastemill.plans import common as c
from tastemill.session import write_stage

AS_OF = "2001-08-01"
WEEK = 7 * 86400
FEATURES = ["hour", "value", "seen", "encoded"]


def _lines(s, d):
    return rk.purchase_lines(c.table(s, d, "lineitem"), c.table(s, d, "orders"))


def _events(s, d):
    return c.table(s, d, "events").select(F.col("user_id").alias("user"), "ts", "event_id")


def examples(s, d):
    return rk.examples_from_events(c.table(s, d, "events"))


def encoded(s, d):
    return rk.target_encode(examples(s, d), "item", 10.0, 5)


def label_scores(s, d):
    """The encoded item rate read as a score, for the metrics of scored rows."""
    return encoded(s, d).select("example_id", "label", F.col("encoded").alias("score"))


def training(s, d):
    seen = rk.point_in_time(examples(s, d), _events(s, d), WEEK)
    rows = encoded(s, d).join(seen, "example_id")
    return rk.assemble(rows, FEATURES).select("example_id", "label", "features")


def _held_out():
    """A fifth of the examples, which no ranker is fitted on."""
    return F.pmod(hash_int(F.lit("held-out"), F.col("example_id")), F.lit(5)) == 0


def _fit(make):
    """Every example scored by a model of the others' folds, with a mark on the rows it has not seen."""

    def run(s, d):
        rows = write_stage(training(s, d), "training")
        model = make(rows.filter(~_held_out()))
        return rk.scored(model, rows).withColumn("held_out", _held_out())

    return run


def _hashed(s, d):
    return rk.hashed_rows(examples(s, d), ["user", "item"], [["item", "hour"]], 4096)


def _regressor(s, d):
    rows = write_stage(training(s, d), "training")
    model = rk.factorisation_machine(rows.filter(~_held_out()), 4, 3, regress=True)
    scores = model.transform(rows).select("example_id", "label", F.col("prediction").alias("score"))
    return scores.withColumn("held_out", _held_out())


QUERIES = {
    "user_features": lambda s, d: rk.user_features(_lines(s, d), AS_OF),
    "item_features": lambda s, d: rk.item_features(_lines(s, d), AS_OF),
    "point_in_time": lambda s, d: rk.point_in_time(examples(s, d), _events(s, d), WEEK),
    "target_encode": lambda s, d: encoded(s, d).select("example_id", "user", "item", "label", "encoded"),
    "hash_features": _hashed,
    "logistic_ctr": _fit(rk.logistic_ctr),
    "factorisation_machine": _fit(lambda r: rk.factorisation_machine(r, 4, 3)),
    "factorisation_regressor": _regressor,
    "random_forest_ranker": _fit(lambda r: rk.forest_ranker(r, 3)),
    "boosted_tree_ranker": _fit(lambda r: rk.boosted_ranker(r, 3)),
    "gbt_plus_lr": _fit(lambda r: rk.gbt_plus_lr(r, 3)),
    "calibration": lambda s, d: rk.calibration(label_scores(s, d), 20),
    "calibration_equal_size": lambda s, d: rk.calibration(label_scores(s, d), 10, True),
}

_LINES = """ln AS MATERIALIZED (SELECT o_custkey AS u, l_partkey AS i, l_orderkey AS basket, o_orderdate AS ts, l_extendedprice AS price,
  l_discount AS discount, l_returnflag AS flag FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def _features(key: str, name: str, other: str) -> str:
    return f"""WITH {_LINES} SELECT {key} AS "{name}", datediff('day', CAST(max(ts) AS DATE), DATE '{AS_OF}') AS recency,
        count(DISTINCT basket) AS frequency, CAST(sum(CAST(floor(price * (1.0::DOUBLE - discount) * 1e4 + 0.5) AS BIGINT)) AS DOUBLE) / 1e4 AS spend,
        count(DISTINCT {other}) AS breadth, {c.r6("count(*) FILTER (flag = 'R') / CAST(count(*) AS DOUBLE)")} AS return_rate FROM ln GROUP BY {key}"""


ENCODED = f"""ex AS MATERIALIZED (SELECT event_id, user_id AS u, ts, CAST(json_extract_string(props, '$.k') AS BIGINT) AS i,
  CASE WHEN event_type = 'purchase' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label, {c.hash_int('event_id')} % 5 AS fold
  FROM events WHERE event_type IN ('view', 'click', 'purchase')),
pf AS (SELECT i, fold, count(*) AS n, {c.xsum('label', '1e6')} AS s FROM ex GROUP BY 1, 2),
tf AS (SELECT i, CAST(sum(n) AS BIGINT) AS tn, {c.xsum('s', '1e6')} AS ts FROM pf GROUP BY 1),
prior AS (SELECT {c.xsum('label', '1e6')} / count(*) AS p FROM ex),
enc AS (SELECT pf.i, fold, {c.r6('(ts - s + 10.0::DOUBLE * p) / (tn - n + 10.0::DOUBLE)')} AS encoded FROM pf JOIN tf ON tf.i = pf.i, prior),
scored AS MATERIALIZED (SELECT event_id AS example_id, u, ex.i, label, encoded AS score FROM ex JOIN enc ON enc.i = ex.i AND enc.fold = ex.fold)"""
_BINS = f"""SELECT bin, count(*) AS n, {c.r6(c.xsum('score') + ' / count(*)')} AS mean_score,
  {c.r6(c.xsum('label', '1e6') + ' / count(*)')} AS mean_label FROM b GROUP BY bin"""

ORACLE = {
    "user_features": _features("u", "user", "i"),
    "item_features": _features("i", "item", "u"),
    "point_in_time": f"""WITH ev AS (SELECT event_id, event_type, count(*) OVER (PARTITION BY user_id ORDER BY epoch_us(ts)
          RANGE BETWEEN {WEEK * 1_000_000} PRECEDING AND 1 PRECEDING) AS seen FROM events)
        SELECT event_id AS example_id, seen FROM ev WHERE event_type IN ('view', 'click', 'purchase')""",
    "hash_features": f"""WITH ex AS (SELECT event_id, user_id AS u, CAST(json_extract_string(props, '$.k') AS BIGINT) AS i, hour(ts) AS h
          FROM events WHERE event_type IN ('view', 'click', 'purchase')),
        p AS (SELECT event_id, unnest([{c.hash_int("'user'", 'u')}, {c.hash_int("'item'", 'i')}, {c.hash_int("'item_hour'", 'i', 'h')}]) % 4096 AS idx FROM ex)
        SELECT event_id AS example_id, idx, CAST(count(*) AS DOUBLE) AS value FROM p GROUP BY 1, 2""",
    "target_encode": f'WITH {ENCODED} SELECT example_id, u AS "user", i AS item, label, score AS encoded FROM scored',
    "calibration": f"WITH {ENCODED}, b AS (SELECT CAST(least(floor(score * 20), 19) AS BIGINT) AS bin, score, label FROM scored) {_BINS}",
    "calibration_equal_size": f"WITH {ENCODED}, b AS (SELECT ntile(10) OVER (ORDER BY score, example_id) - 1 AS bin, score, label FROM scored) {_BINS}",
}
