"""Registered queries: neighbourhood methods."""

from __future__ import annotations

from pyspark.sql import functions as F

from tastemill.operators import neighbours as nb
from tastemill.plans import common as c
from tastemill.session import write_stage
from tastemill.sources import tables

TOP = 10


def _written(s, d):
    """Preferences written once: a measure reads them for its rows and for its sizes or norms."""
    return write_stage(c.prefs(s, d).select("user", "item", "weight"), "prefs")


def _near(measure):
    return lambda s, d: measure(_written(s, d)).nearest(TOP)


def _rated(measure):
    return lambda s, d: measure(tables.derived_ratings(_written(s, d))).nearest(TOP)


def item_cosine(s, d):
    return nb.cosine(_written(s, d)).nearest(TOP)


def item_cf(s, d):
    # Read by the pair job, the votes and the filter of seen items.
    prefs = write_stage(c.prefs(s, d), "prefs")
    return nb.item_cf(prefs, nb.cosine(prefs).nearest(TOP), TOP)


def _conditional(s, d):
    return nb.conditional(_written(s, d), 0.5).nearest(TOP)


def _user_near(s, d):
    return nb.user_measure(_written(s, d), "cosine").nearest(20)


def _user_cf(s, d):
    # Read by the pair job, the histories and what users have.
    prefs = _written(s, d)
    return nb.user_cf(prefs, nb.user_measure(prefs, "cosine").nearest(20), TOP)


def _slope_one(s, d):
    """Best unrated items among the neighbours of what a user rated."""
    ratings, near = write_stage(c.ratings(s, d), "ratings"), item_cosine(s, d)
    # A list of candidates for each rating, not a row for each.
    links = near.groupBy(F.col("a").alias("item")).agg(F.collect_list("b").alias("items"))
    candidates = ratings.join(links, "item").select("user", "items")
    return nb.slope_one_top(ratings, candidates, nb.deviations(ratings), TOP)


QUERIES = {
    "cooccur": lambda s, d: nb.cooccur(c.prefs(s, d)),
    "item_cosine": item_cosine,
    "item_cosine_weighted": _near(nb.weighted_cosine),
    "item_jaccard": _near(nb.jaccard),
    "item_adjusted_cosine": _rated(nb.adjusted_cosine),
    "item_pearson": _rated(lambda r: nb.pearson(r, 3)),
    "item_lift": _near(nb.lift),
    "item_pmi": _near(nb.pmi),
    "item_llr": _near(nb.llr),
    "item_iuf_cosine": _near(nb.iuf_cosine),
    "item_conditional": _conditional,
    "user_similarity_cosine": _user_near,
    "user_similarity_weighted": _near(lambda p: nb.user_measure(p, "weighted")),
    "user_similarity_jaccard": _near(lambda p: nb.user_measure(p, "jaccard")),
    "user_similarity_adjusted": _rated(lambda r: nb.user_measure(r, "adjusted")),
    "user_similarity_pearson": _rated(lambda r: nb.user_measure(r, "pearson", 3)),
    "item_cf": item_cf,
    "user_cf": _user_cf,
    "slope_one_deviations": lambda s, d: nb.slope_one_deviations(c.ratings(s, d)),
    "slope_one": _slope_one,
}


def _binary(score: str) -> str:
    return f"WITH {c.SIZED}, sim AS (SELECT a, b, k, {c.r6(score)} AS score FROM sized, total), {c.near_sql('sim', TOP)} SELECT * FROM near"


_COSINE = "k / sqrt(CAST(n_a AS DOUBLE) * n_b)"
_LIFT = "CAST(k AS DOUBLE) * big_n / (CAST(n_a AS DOUBLE) * n_b)"


def _xlogx(x: str) -> str:
    return f"(CASE WHEN ({x}) > 0 THEN ({x}) * ln(CAST(({x}) AS DOUBLE)) ELSE 0.0::DOUBLE END)"


_LLR = (
    "greatest(0.0::DOUBLE, 2.0::DOUBLE * ("
    f"({_xlogx('k')} + {_xlogx('n_a - k')} + {_xlogx('n_b - k')} + {_xlogx('big_n - n_a - n_b + k')})"
    f" - ({_xlogx('n_a')} + {_xlogx('big_n - n_a')})"
    f" - ({_xlogx('n_b')} + {_xlogx('big_n - n_b')}) + {_xlogx('big_n')}))"
)

_WEIGHTED = f"""norm AS MATERIALIZED (SELECT i, sqrt({c.xsum('w * w', '1e6')}) AS norm FROM pref GROUP BY i),
dots AS (SELECT x.i AS a, y.i AS b, count(*) AS k, {c.xsum('x.w * y.w', '1e6')} AS dot
  FROM pref x JOIN pref y ON x.u = y.u AND x.i < y.i GROUP BY 1, 2),
sim AS (SELECT a, b, k, {c.r6('dot / (na.norm * nb.norm)')} AS score
  FROM dots JOIN norm na ON na.i = a JOIN norm nb ON nb.i = b WHERE na.norm * nb.norm > 0)"""


def _pearson(overlap: int) -> str:
    return f"""m AS (SELECT x.i AS a, y.i AS b, count(*) AS k, {c.xsum('x.r', '1e6')} AS sa, {c.xsum('y.r', '1e6')} AS sb,
  {c.xsum('x.r * x.r', '1e6')} AS saa, {c.xsum('y.r * y.r', '1e6')} AS sbb, {c.xsum('x.r * y.r', '1e6')} AS sab
  FROM rating x JOIN rating y ON x.u = y.u AND x.i < y.i GROUP BY 1, 2 HAVING count(*) >= {overlap}),
v AS (SELECT a, b, k, k * sab - sa * sb AS cov, k * saa - sa * sa AS va, k * sbb - sb * sb AS vb FROM m),
sim AS (SELECT a, b, k, {c.r6('CASE WHEN va > 0 AND vb > 0 THEN cov / sqrt(va * vb) ELSE 0.0::DOUBLE END')} AS score FROM v)"""


_ADJUSTED = f"""mean AS (SELECT u, {c.xsum('r', '1e6')} / count(*) AS mean FROM rating GROUP BY u),
cen AS MATERIALIZED (SELECT u, i, r - mean AS c FROM rating JOIN mean USING (u)),
m AS (SELECT x.i AS a, y.i AS b, count(*) AS k, {c.xsum('x.c * y.c')} AS ab, {c.xsum('x.c * x.c')} AS aa, {c.xsum('y.c * y.c')} AS bb
  FROM cen x JOIN cen y ON x.u = y.u AND x.i < y.i GROUP BY 1, 2),
sim AS (SELECT a, b, k, {c.r6('CASE WHEN sqrt(aa * bb) > 0 THEN ab / sqrt(aa * bb) ELSE 0.0::DOUBLE END')} AS score FROM m)"""


_PREF_SWAPPED = f"{c.PREF.replace('pref AS MATERIALIZED', 'pref0 AS MATERIALIZED')}, pref AS MATERIALIZED (SELECT i AS u, u AS i, w FROM pref0)"
_RATING_SWAPPED = f"{c.RATING.replace('rating AS MATERIALIZED', 'rating0 AS MATERIALIZED')}, rating AS MATERIALIZED (SELECT i AS u, u AS i, r FROM rating0)"
_USER_PAIRS = f"""{c.PREF}, cnt AS MATERIALIZED (SELECT u, count(*) AS n FROM pref GROUP BY u),
pairs AS (SELECT x.u AS a, y.u AS b, count(*) AS k FROM pref x JOIN pref y ON x.i = y.i AND x.u < y.u GROUP BY 1, 2),
sim AS (SELECT a, b, k, {c.r6('k / sqrt(CAST(ca.n AS DOUBLE) * cb.n)')} AS score
  FROM pairs JOIN cnt ca ON ca.u = a JOIN cnt cb ON cb.u = b), {c.near_sql('sim', 20)}"""


def top_votes(votes: str, n: int) -> str:
    """Unseen best n of a (u, i, score) relation."""
    return f"""SELECT * FROM (SELECT u AS "user", i AS item, score, {c.rank_int('u', 'score DESC, i')} AS rank
  FROM {votes} v WHERE NOT EXISTS (SELECT 1 FROM pref p WHERE p.u = v.u AND p.i = v.i)) WHERE rank <= {n}"""


COSINE_NEAR = f"{c.SIZED}, sim AS (SELECT a, b, k, {c.r6(_COSINE)} AS score FROM sized), {c.near_sql('sim', TOP)}"
ITEM_CF_VOTES = f"""votes AS (SELECT u, near.b AS i, {c.r6(c.xsum('w * score', '1e6'))} AS score
  FROM pref JOIN near ON near.a = pref.i GROUP BY 1, 2)"""
_DEVS = f"""devs AS MATERIALIZED (SELECT x.i AS a, y.i AS b, count(*) AS k, {c.r6(c.xsum('y.r - x.r', '1e6') + ' / count(*)')} AS dev
  FROM rating x JOIN rating y ON x.u = y.u AND x.i < y.i GROUP BY 1, 2)"""

ORACLE = {
    "cooccur": f"WITH {c.SIZED} SELECT a, b, k FROM pairs",
    "item_cosine": _binary(_COSINE),
    "item_cosine_weighted": f"WITH {c.PREF}, {_WEIGHTED}, {c.near_sql('sim', TOP)} SELECT * FROM near",
    "item_jaccard": _binary("k / CAST(n_a + n_b - k AS DOUBLE)"),
    "item_adjusted_cosine": f"WITH {c.RATING}, {_ADJUSTED}, {c.near_sql('sim', TOP)} SELECT * FROM near",
    "item_pearson": f"WITH {c.RATING}, {_pearson(3)}, {c.near_sql('sim', TOP)} SELECT * FROM near",
    "item_lift": _binary(_LIFT),
    "item_pmi": _binary(f"ln({_LIFT})"),
    "item_llr": _binary(_LLR),
    "item_iuf_cosine": f"""WITH {c.PREF}, cnt AS MATERIALIZED (SELECT i, count(*) AS n FROM pref GROUP BY i),
        iuf AS MATERIALIZED (SELECT u, 1.0::DOUBLE / ln(1.0::DOUBLE + count(*)) AS f FROM pref GROUP BY u),
        m AS (SELECT x.i AS a, y.i AS b, count(*) AS k, {c.xsum('f')} AS s
          FROM pref x JOIN pref y ON x.u = y.u AND x.i < y.i JOIN iuf ON iuf.u = x.u GROUP BY 1, 2),
        sim AS (SELECT a, b, k, {c.r6('s / sqrt(CAST(ca.n AS DOUBLE) * cb.n)')} AS score
          FROM m JOIN cnt ca ON ca.i = a JOIN cnt cb ON cb.i = b), {c.near_sql('sim', TOP)} SELECT * FROM near""",
    "item_conditional": f"""WITH {c.SIZED}, both_ways AS (SELECT a, b, k, n_a, n_b FROM sized UNION ALL SELECT b, a, k, n_b, n_a FROM sized),
        sim AS (SELECT a, b, k, {c.r6('k / (n_a * pow(CAST(n_b AS DOUBLE), 0.5))')} AS score FROM both_ways)
        SELECT * FROM (SELECT *, {c.rank_int('a', 'score DESC, b')} AS rank FROM sim) WHERE rank <= {TOP}""",
    "user_similarity_cosine": f"WITH {_USER_PAIRS} SELECT * FROM near",
    "user_similarity_weighted": f"WITH {_PREF_SWAPPED}, {_WEIGHTED}, {c.near_sql('sim', TOP)} SELECT * FROM near",
    "user_similarity_jaccard": f"""WITH {_PREF_SWAPPED}, {c.PAIRS}, sim AS (SELECT a, b, k, {c.r6('k / CAST(n_a + n_b - k AS DOUBLE)')} AS score FROM sized),
        {c.near_sql('sim', TOP)} SELECT * FROM near""",
    "user_similarity_adjusted": f"WITH {_RATING_SWAPPED}, {_ADJUSTED}, {c.near_sql('sim', TOP)} SELECT * FROM near",
    "user_similarity_pearson": f"WITH {_RATING_SWAPPED}, {_pearson(3)}, {c.near_sql('sim', TOP)} SELECT * FROM near",
    "item_cf": f"WITH {COSINE_NEAR}, {ITEM_CF_VOTES} {top_votes('votes', TOP)}",
    "user_cf": f"""WITH {_USER_PAIRS}, votes AS (SELECT near.a AS u, pref.i, {c.r6(c.xsum('w * score', '1e6'))} AS score
        FROM pref JOIN near ON near.b = pref.u GROUP BY 1, 2) {top_votes('votes', TOP)}""",
    "slope_one_deviations": f"WITH {c.RATING}, {_DEVS} SELECT a, b, k, dev FROM devs",
    "slope_one": f"""WITH {c.RATING}, {c.PAIRS}, sim AS (SELECT a, b, k, {c.r6(_COSINE)} AS score FROM sized), {c.near_sql('sim', TOP)},
        {_DEVS}, dir AS MATERIALIZED (SELECT a AS owned, b AS i, dev, k FROM devs UNION ALL SELECT b, a, -dev, k FROM devs),
        target AS MATERIALIZED (SELECT DISTINCT u, near.b AS i FROM pref JOIN near ON near.a = pref.i),
        p AS (SELECT t.u, t.i, {c.r6(c.xsum('k * (r + dev)', '1e6') + ' / CAST(sum(k) AS BIGINT)')} AS score
          FROM target t JOIN rating o ON o.u = t.u JOIN dir ON dir.owned = o.i AND dir.i = t.i
          WHERE NOT EXISTS (SELECT 1 FROM pref q WHERE q.u = t.u AND q.i = t.i) GROUP BY 1, 2) {top_votes('p', TOP)}""",
}
