"""Registered queries: association rules, ordered patterns, next items."""

from __future__ import annotations

from pyspark.sql import functions as F

from tastemill.operators import interactions as prep
from tastemill.operators import patterns as pt
from tastemill.plans import common as c

SUPPORT = 0.0001


def _items(s, d):
    return prep.basket_items(c.purchases(s, d))


def _itemsets(s, d):
    sets = pt.fp_growth(_items(s, d), SUPPORT, 0.05).freqItemsets
    return sets.select(
        F.array_join(F.array_sort("items"), ",").alias("items"), F.size("items").alias("size"), "freq"
    )


def _vertical(s, d):
    sets = pt.vertical_itemsets(_items(s, d), SUPPORT)
    return sets.select(F.array_join("items", ",").alias("items"), F.size("items").alias("size"), "freq")


def _fp_rules(s, d):
    rules = pt.fp_growth(_items(s, d), SUPPORT, 0.05).associationRules
    return rules.select(
        F.array_join(F.array_sort("antecedent"), ",").alias("antecedent"),
        F.col("consequent")[0].alias("consequent"),
        F.floor(F.col("confidence") * 1e6 + 0.5).cast("bigint").alias("confidence_e6"),
    )


def _applied(s, d):
    items = _items(s, d)
    return pt.apply_rules(items, pt.pair_rules(pt.frequent_pairs(items, SUPPORT), 0.03), 5)


def _spans(s, d):
    found = pt.prefix_span(c.event_interactions(s, d), 0.06, 3)
    return found.select(
        F.array_join("pattern", ">").alias("pattern"), F.size("pattern").alias("length"), "freq"
    )


def _session_cf(s, d):
    steps = c.event_interactions(s, d)
    return pt.session_cf(prep.sessionise(steps, 24 * 3600), 10)


QUERIES = {
    "frequent_pairs": lambda s, d: pt.frequent_pairs(_items(s, d), SUPPORT),
    "fp_growth_itemsets": _itemsets,
    "vertical_itemsets": _vertical,
    "fp_growth_rules": _fp_rules,
    "apply_rules": _applied,
    "prefix_span": _spans,
    "markov_next": lambda s, d: pt.markov_next(c.event_interactions(s, d), 10, 0.1),
    "session_cf": _session_cf,
}

_BASKET = f"""d AS MATERIALIZED (SELECT DISTINCT l_orderkey AS basket, l_partkey AS i FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
nb AS (SELECT count(DISTINCT basket) AS big_n FROM d),
f1 AS MATERIALIZED (SELECT i, count(*) AS n FROM d GROUP BY i HAVING count(*) / (SELECT CAST(big_n AS DOUBLE) FROM nb) >= {SUPPORT}::DOUBLE),
f2 AS MATERIALIZED (SELECT x.i AS a, y.i AS b, count(*) AS k FROM d x JOIN d y ON x.basket = y.basket AND x.i < y.i
  GROUP BY 1, 2 HAVING count(*) / (SELECT CAST(big_n AS DOUBLE) FROM nb) >= {SUPPORT}::DOUBLE)"""
_PAIRED = f"""p AS MATERIALIZED (SELECT a, b, k, {c.r6('CAST(k AS DOUBLE) / big_n')} AS support, {c.r6('CAST(k AS DOUBLE) / fa.n')} AS confidence_ab,
  {c.r6('CAST(k AS DOUBLE) / fb.n')} AS confidence_ba, {c.r6('CAST(k AS DOUBLE) * big_n / (CAST(fa.n AS DOUBLE) * fb.n)')} AS lift
  FROM f2 JOIN f1 fa ON fa.i = a JOIN f1 fb ON fb.i = b, nb)"""
# All subsets of every basket, so sets of any size are counted.
_SETS = f"""fd AS MATERIALIZED (SELECT d.basket, d.i FROM d JOIN f1 ON f1.i = d.i),
sub(basket, last, items, size) AS (SELECT basket, i, CAST(i AS VARCHAR), 1 FROM fd
  UNION ALL SELECT sub.basket, fd.i, sub.items || ',' || fd.i, sub.size + 1 FROM sub JOIN fd ON fd.basket = sub.basket AND fd.i > sub.last),
fs AS MATERIALIZED (SELECT items, CAST(size AS INTEGER) AS size, count(*) AS freq FROM sub GROUP BY 1, 2
  HAVING count(*) / (SELECT CAST(big_n AS DOUBLE) FROM nb) >= {SUPPORT}::DOUBLE)"""
_STEPS = f"""{c.EVI}, pos AS MATERIALIZED (SELECT u, i, row_number() OVER (PARTITION BY u ORDER BY ts, event_id) AS p FROM evi),
people AS (SELECT count(DISTINCT u) AS n FROM evi),
firsts AS MATERIALIZED (SELECT u, i, min(p) AS fp, max(p) AS lp FROM pos GROUP BY 1, 2)"""

ORACLE = {
    "frequent_pairs": f"WITH {_BASKET}, {_PAIRED} SELECT * FROM p",
    "fp_growth_itemsets": f"WITH RECURSIVE {_BASKET}, {_SETS} SELECT items, size, freq FROM fs",
    "vertical_itemsets": f"WITH RECURSIVE {_BASKET}, {_SETS} SELECT items, size, freq FROM fs",
    "fp_growth_rules": f"""WITH RECURSIVE {_BASKET}, {_SETS},
        cut AS (SELECT items, freq, unnest(string_split(items, ',')) AS c FROM fs WHERE size > 1),
        r AS (SELECT array_to_string(list_filter(string_split(items, ','), lambda x: x <> c), ',') AS a, CAST(c AS BIGINT) AS c, freq FROM cut)
        SELECT a AS antecedent, c AS consequent, CAST(floor(r.freq / CAST(fs.freq AS DOUBLE) * 1e6 + 0.5) AS BIGINT) AS confidence_e6
        FROM r JOIN fs ON fs.items = r.a WHERE r.freq / CAST(fs.freq AS DOUBLE) >= 0.05::DOUBLE""",
    "apply_rules": f"""WITH {_BASKET}, {_PAIRED}, rules AS (SELECT a, b, confidence_ab AS conf FROM p UNION ALL SELECT b, a, confidence_ba FROM p),
        fired AS (SELECT basket, b AS item, max(conf) AS score FROM d JOIN rules ON rules.a = d.i WHERE conf >= 0.03::DOUBLE GROUP BY 1, 2)
        SELECT * FROM (SELECT basket, item, score, {c.rank_int('basket', 'score DESC, item')} AS rank FROM fired
          WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.basket = fired.basket AND d.i = fired.item)) WHERE rank <= 5""",
    "prefix_span": f"""WITH {_STEPS},
        l1 AS MATERIALIZED (SELECT i AS a, count(*) AS freq FROM firsts GROUP BY 1 HAVING count(*) / (SELECT CAST(n AS DOUBLE) FROM people) >= 0.06::DOUBLE),
        e2 AS MATERIALIZED (SELECT f.u, f.i AS a, q.i AS b, min(q.p) AS e FROM firsts f JOIN pos q ON q.u = f.u AND q.p > f.fp GROUP BY 1, 2, 3),
        l2 AS MATERIALIZED (SELECT a, b, count(*) AS freq FROM e2 GROUP BY 1, 2 HAVING count(*) / (SELECT CAST(n AS DOUBLE) FROM people) >= 0.06::DOUBLE),
        l3 AS (SELECT e2.a, e2.b, f.i AS e, count(*) AS freq FROM e2 JOIN l2 ON l2.a = e2.a AND l2.b = e2.b JOIN firsts f ON f.u = e2.u AND f.lp > e2.e
          GROUP BY 1, 2, 3 HAVING count(*) / (SELECT CAST(n AS DOUBLE) FROM people) >= 0.06::DOUBLE)
        SELECT CAST(a AS VARCHAR) AS pattern, 1::INTEGER AS length, freq FROM l1
        UNION ALL SELECT a || '>' || b, 2, freq FROM l2 UNION ALL SELECT a || '>' || b || '>' || e, 3, freq FROM l3""",
    "markov_next": f"""WITH {c.EVI}, m AS (SELECT i, lead(i) OVER (PARTITION BY u ORDER BY ts, event_id) AS nx FROM evi),
        k AS (SELECT i, nx, count(*) AS k FROM m WHERE nx IS NOT NULL GROUP BY 1, 2),
        t AS (SELECT i, CAST(sum(k) AS BIGINT) AS tot FROM k GROUP BY 1), v AS (SELECT count(DISTINCT i) AS v FROM evi),
        sc AS (SELECT k.i AS item, nx AS next, k, {c.r6('(k + 0.1::DOUBLE) / (tot + 0.1::DOUBLE * v)')} AS score FROM k JOIN t ON t.i = k.i, v)
        SELECT * FROM (SELECT *, {c.rank_int('item', 'score DESC, next')} AS rank FROM sc) WHERE rank <= 10""",
    "session_cf": f"""WITH {c.EVI}, g AS (SELECT *, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY u ORDER BY ts, event_id) AS gap FROM evi),
        se AS (SELECT u, i, ts, event_id, sum(CASE WHEN gap IS NULL OR gap > 86400000000 THEN 1 ELSE 0 END)
          OVER (PARTITION BY u ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sid FROM g),
        po AS MATERIALIZED (SELECT u, sid, i, row_number() OVER (PARTITION BY u, sid ORDER BY ts, event_id) AS p FROM se),
        sim AS (SELECT least(x.i, y.i) AS a, greatest(x.i, y.i) AS b, count(*) AS k, {c.r6(c.xsum('1.0::DOUBLE / (1.0::DOUBLE + (y.p - x.p))'))} AS score
          FROM po x JOIN po y ON x.u = y.u AND x.sid = y.sid AND x.p < y.p AND x.i <> y.i GROUP BY 1, 2),
        {c.near_sql('sim', 10)} SELECT * FROM near""",
}
