"""Registered queries: candidate merging, post-processing and offline metrics.

The lists come from item-based filtering on the train fold of the whole
preference table; the test fold is the truth.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tastemill.functions.pairs import mirrored
from tastemill.operators import baseline, interactions as prep, metrics as mt
from tastemill.operators import neighbours as nb
from tastemill.operators import postprocess as pp
from tastemill.plans import common as c
from tastemill.session import write_stage
from tastemill.plans.neighbourhood import COSINE_NEAR, ITEM_CF_VOTES, top_votes
from tastemill.plans.ranking import ENCODED, label_scores
from tastemill.sources import tables

N = 10


def _folds(s, d):
    tagged = write_stage(prep.split_by_hash(c.prefs(s, d).drop("last_ts"), 20, "fold"), "folds")
    train = tagged.filter(F.col("fold") == "train").drop("fold")
    truth = tagged.filter(F.col("fold") == "test").select("user", "item")
    return train, truth


def _sims(prefs):
    return nb.cosine(prefs).nearest(N)


def _train(s, d):
    return _folds(s, d)[0]


def _train_recs(train):
    return nb.item_cf(train, _sims(train), N)


def _recs(s, d):
    return _train_recs(_train(s, d))


def _measured(metric):
    def run(s, d):
        train, truth = _folds(s, d)
        return metric(nb.item_cf(train, _sims(train), N), truth)

    return run


def _items(s, d):
    return c.table(s, d, "part").select(F.col("p_partkey").alias("item"))


def _users(s, d):
    return c.table(s, d, "customer").select(F.col("c_custkey").alias("user"))


def _nation_lists(s, d, train):
    """Ten most popular items of the user's nation, as a second source of candidates."""
    people = c.table(s, d, "customer").select(F.col("c_custkey").alias("user"), "c_nationkey")
    top = baseline.popular_by(train, people, "c_nationkey", N)
    return people.join(top, "c_nationkey").select(
        "user", "item", F.col("users").cast("double").alias("score"), "rank"
    )


def _all_votes(train):
    """Scores before the cut to ten, the input of the re-rankers."""
    return nb.item_cf(train, _sims(train), 50).drop("rank")


def _fill(s, d):
    train = _train(s, d)
    recs = pp.top_n(_strong(train), N)
    return pp.fill_cold(recs, baseline.popularity_ranks(train), _users(s, d), train, N)


def _strong(train):
    """Candidates with a solid score only, so that some lists come up short."""
    return _all_votes(train).filter(F.col("score") >= 4.0)


def _listed(s, d):
    """The lists and the item cosines of the pairs inside a list, written once: both are read several times."""
    train, _ = _folds(s, d)
    recs = write_stage(nb.item_cf(train, _sims(train), N), "recs")
    pairs = recs.select("user", F.col("item").alias("a")).join(recs.select("user", F.col("item").alias("b")), "user")
    sims = nb.item_cosine(train, among=pairs.filter("a < b").select("a", "b"))
    return recs, write_stage(sims, "similarities")


def _mmr(s, d):
    recs, sims = _listed(s, d)
    return pp.mmr(recs, mirrored(sims.select("a", "b", "score"), both=["score"]), 0.05, 4)


def _eligible(s, d):
    items = tables.item_attributes(c.table(s, d, "part"))
    blocked = items.filter(F.col("p_brand") == "Brand#2")
    return pp.eligible(_recs(s, d), items, F.col("p_retailprice").between(900.0, 950.0), blocked)


def _diversity(s, d):
    return mt.intra_list_diversity(*_listed(s, d))


def _ab(s, d):
    rows = c.table(s, d, "events").filter(F.col("event_type").isin("view", "click", "purchase"))
    rows = rows.select(F.col("user_id").alias("user"), (F.col("event_type") == "purchase").alias("success"))
    return mt.ab_summary(rows, "test-1", 3)


def _both_lists(s, d):
    """Two sources of candidates from the one train fold."""
    train = _train(s, d)
    return [_train_recs(train), _nation_lists(s, d, train)]


def _unseen(s, d):
    train = _train(s, d)
    return pp.drop_seen(_nation_lists(s, d, train), train)


def _novelty(s, d):
    train = _train(s, d)
    return mt.novelty(_train_recs(train), train)


QUERIES = {
    "train_recs": _recs,
    "drop_seen": _unseen,
    "top_n": lambda s, d: pp.top_n(
        c.prefs(s, d).select("user", "item", F.col("weight").alias("score")), N
    ),
    "blend": lambda s, d: pp.blend(_both_lists(s, d), [0.7, 0.3], N),
    "reciprocal_rank_fusion": lambda s, d: pp.reciprocal_rank_fusion(_both_lists(s, d), 60, N),
    "cap_per_group": lambda s, d: pp.cap_per_group(
        _all_votes(_train(s, d)), tables.item_attributes(c.table(s, d, "part")), "p_type", 2, N
    ),
    "mmr": _mmr,
    "fill_cold": _fill,
    "eligible": _eligible,
    "precision_recall_at": _measured(lambda r, t: mt.precision_recall_at(r, t, N)),
    "hit_rate_at": _measured(lambda r, t: mt.hit_rate_at(r, t, N)),
    "map_at": _measured(lambda r, t: mt.map_at(r, t, N)),
    "ndcg_at": _measured(lambda r, t: mt.ndcg_at(r, t, N)),
    "mrr": _measured(mt.mrr),
    "coverage": lambda s, d: mt.coverage(_recs(s, d), _items(s, d), _users(s, d)),
    "gini": lambda s, d: mt.gini(_recs(s, d), _items(s, d)),
    "novelty": _novelty,
    "intra_list_diversity": _diversity,
    "rmse_mae": lambda s, d: mt.rmse_mae(baseline.bias_baseline(c.ratings(s, d), 5.0, 10.0)),
    "auc": lambda s, d: mt.auc(label_scores(s, d)),
    "log_loss": lambda s, d: mt.log_loss(label_scores(s, d)),
    "ab_summary": _ab,
}

_SPLIT = f"""{c.PREF.replace('pref AS MATERIALIZED', 'pref_all AS MATERIALIZED')},
tagged AS (SELECT *, {c.hash_int("'fold'", 'u', 'i')} % 100 < 20 AS is_test FROM pref_all),
pref AS MATERIALIZED (SELECT u, i, w, last_ts FROM tagged WHERE NOT is_test),
truth AS MATERIALIZED (SELECT u, i FROM tagged WHERE is_test)"""
_NEAR = f"{_SPLIT}{COSINE_NEAR.removeprefix(c.PREF)}"


def _lists(n: int, name: str) -> str:
    return f'{name} AS MATERIALIZED (SELECT "user" AS u, item AS i, score, rank FROM ({top_votes("votes", n)}))'


_RECS = f"{_NEAR}, {ITEM_CF_VOTES}, {_lists(N, 'recs')}"
_WIDE = f"{_NEAR}, {ITEM_CF_VOTES}, {_lists(50, 'wide')}"
_NATION = f"""nt AS (SELECT c_nationkey, i, count(*) AS users, {c.xsum('w', '1e6')} AS wt FROM pref JOIN customer ON c_custkey = u GROUP BY 1, 2),
nr AS (SELECT * FROM (SELECT *, {c.rank_int('c_nationkey', 'users DESC, wt DESC, i')} AS rank FROM nt) WHERE rank <= {N}),
natl AS MATERIALIZED (SELECT c_custkey AS u, i, CAST(users AS DOUBLE) AS score, rank FROM customer JOIN nr USING (c_nationkey))"""
_REL = "rel AS (SELECT u, count(*) AS relevant FROM truth GROUP BY u)"
_HIT = "hit AS MATERIALIZED (SELECT u, i, rank FROM recs JOIN truth USING (u, i))"


def _avg(term: str) -> str:
    return c.r6(c.xsum(f"coalesce({term}, 0.0::DOUBLE)") + " / count(*)")


def _metric(per_user: str, select: str) -> str:
    return f"WITH {_RECS}, {_REL}, {_HIT}, v AS ({per_user}) SELECT count(*) AS users, {select} FROM rel LEFT JOIN v USING (u)"


def _ranked(source: str, n: int) -> str:
    return f'SELECT * FROM (SELECT u AS "user", i AS item, score, {c.rank_int("u", "score DESC, i")} AS rank FROM {source}) WHERE rank <= {n}'


_SCALED = "SELECT u, i, {w}::DOUBLE * (CASE WHEN max(score) OVER (PARTITION BY u) - min(score) OVER (PARTITION BY u) > 0 THEN (score - min(score) OVER (PARTITION BY u)) / (max(score) OVER (PARTITION BY u) - min(score) OVER (PARTITION BY u)) ELSE 1.0::DOUBLE END) AS s FROM {t}"


def _mmr_sql(n: int) -> str:
    parts = ["sd AS MATERIALIZED (SELECT a, b, score AS sim FROM sim UNION ALL SELECT b, a, score FROM sim)",
             "c1 AS MATERIALIZED (SELECT u, i, score, 0.0::DOUBLE AS near FROM recs)"]
    value = c.r6("0.05::DOUBLE * score - (1.0::DOUBLE - 0.05::DOUBLE) * near")
    picks = []
    for t in range(1, n + 1):
        parts.append(f"p{t} AS MATERIALIZED (SELECT u, i, v FROM (SELECT u, i, {value} AS v, row_number() OVER (PARTITION BY u ORDER BY {value} DESC, i) AS rn FROM c{t}) WHERE rn = 1)")
        parts.append(
            f"c{t+1} AS MATERIALIZED (SELECT c{t}.u, c{t}.i, score, greatest(near, coalesce(sim, 0.0::DOUBLE)) AS near FROM c{t} JOIN p{t} ON p{t}.u = c{t}.u AND p{t}.i <> c{t}.i "
            f"LEFT JOIN sd ON sd.a = p{t}.i AND sd.b = c{t}.i)"
        )
        picks.append(f'SELECT u AS "user", i AS item, v AS score, {t}::INTEGER AS rank FROM p{t}')
    return f"WITH {_RECS}, {', '.join(parts)} " + " UNION ALL ".join(picks)


_BIAS_RMSE = f"""WITH {c.RATING}, m AS (SELECT {c.xsum('r', '1e6')} / count(*) AS mu FROM rating),
bi AS (SELECT i, {c.xsum('r - mu')} / (count(*) + 5.0::DOUBLE) AS b_item FROM rating, m GROUP BY i),
bu AS (SELECT u, {c.xsum('r - mu - b_item')} / (count(*) + 10.0::DOUBLE) AS b_user FROM rating JOIN bi USING (i), m GROUP BY u),
g AS (SELECT r - {c.r6('mu + b_item + b_user')} AS g FROM rating JOIN bi USING (i) JOIN bu USING (u), m)
SELECT count(*) AS n, {c.r6('sqrt(' + c.xsum('g * g') + ' / count(*))')} AS rmse, {c.r6(c.xsum('abs(g)') + ' / count(*)')} AS mae FROM g"""

ORACLE = {
    "rmse_mae": _BIAS_RMSE,
    "train_recs": f"WITH {_NEAR}, {ITEM_CF_VOTES} {top_votes('votes', N)}",
    "drop_seen": f"""WITH {_SPLIT}, {_NATION} SELECT u AS "user", i AS item, score, rank FROM natl
        WHERE NOT EXISTS (SELECT 1 FROM pref p WHERE p.u = natl.u AND p.i = natl.i)""",
    "top_n": f"WITH {c.PREF}, t AS (SELECT u, i, w AS score FROM pref) {_ranked('t', N)}",
    "blend": f"""WITH {_RECS}, {_NATION}, sc AS ({_SCALED.format(w=0.7, t='recs')} UNION ALL {_SCALED.format(w=0.3, t='natl')}),
        t AS (SELECT u, i, {c.r6(c.xsum('s'))} AS score FROM sc GROUP BY 1, 2) {_ranked('t', N)}""",
    "reciprocal_rank_fusion": f"""WITH {_RECS}, {_NATION}, sc AS (SELECT u, i, rank FROM recs UNION ALL SELECT u, i, rank FROM natl),
        t AS (SELECT u, i, {c.r6(c.xsum('1.0::DOUBLE / (rank + 60)'))} AS score FROM sc GROUP BY 1, 2) {_ranked('t', N)}""",
    "cap_per_group": f"""WITH {_WIDE}, t AS (SELECT u, i, score FROM (SELECT u, i, score, row_number() OVER (PARTITION BY u, p_type ORDER BY score DESC, i) AS rn
        FROM wide JOIN part ON p_partkey = i) WHERE rn <= 2) {_ranked('t', N)}""",
    "mmr": _mmr_sql(4),
    "fill_cold": f"""WITH {_WIDE}, recs AS MATERIALIZED (SELECT u, i, score, {c.rank_int('u', 'score DESC, i')} AS rank FROM wide WHERE score >= 4.0::DOUBLE),
        own AS MATERIALIZED (SELECT * FROM recs WHERE rank <= {N}),
        have AS (SELECT c_custkey AS u, count(own.i) AS have FROM customer LEFT JOIN own ON own.u = c_custkey GROUP BY 1),
        pop AS (SELECT i, row_number() OVER (ORDER BY count(*) DESC, {c.xsum('w', '1e6')} DESC, i) AS pop FROM pref GROUP BY i),
        f AS (SELECT h.u, pop.i, have + row_number() OVER (PARTITION BY h.u ORDER BY pop) AS rank FROM have h, pop WHERE have < {N}
          AND NOT EXISTS (SELECT 1 FROM pref p WHERE p.u = h.u AND p.i = pop.i) AND NOT EXISTS (SELECT 1 FROM own p WHERE p.u = h.u AND p.i = pop.i))
        SELECT u AS "user", i AS item, score, rank FROM own
        UNION ALL SELECT u, i, 0.0::DOUBLE, CAST(rank AS INTEGER) FROM f WHERE rank <= {N}""",
    "eligible": f"""WITH {_RECS} SELECT u AS "user", i AS item, score, rank FROM recs JOIN part ON p_partkey = i
        WHERE p_retailprice BETWEEN 900 AND 950 AND p_brand <> 'Brand#2'""",
    "precision_recall_at": _metric(
        "SELECT u, count(*) AS h FROM hit GROUP BY u",
        f"{_avg('h / 10.0::DOUBLE')} AS precision, {_avg('h / CAST(relevant AS DOUBLE)')} AS recall",
    ),
    "hit_rate_at": _metric("SELECT DISTINCT u, 1.0::DOUBLE AS h FROM hit", f"{_avg('h')} AS hit_rate"),
    "map_at": _metric(
        f"SELECT u, {c.xsum('p')} AS g FROM (SELECT u, count(*) OVER (PARTITION BY u ORDER BY rank) / CAST(rank AS DOUBLE) AS p FROM hit) GROUP BY u",
        f"{_avg(f'g / least(relevant, {N})')} AS map",
    ),
    "ndcg_at": _metric(
        f"SELECT u, {c.xsum('1.0::DOUBLE / log2(rank + 1.0::DOUBLE)')} AS g FROM hit GROUP BY u",
        f"{_avg(f'g / list_sum(list_transform(range(1, least(relevant, {N}) + 1), lambda r: 1.0::DOUBLE / log2(r + 1.0::DOUBLE)))')} AS ndcg",
    ),
    "mrr": _metric("SELECT u, 1.0::DOUBLE / min(rank) AS f FROM hit GROUP BY u", f"{_avg('f')} AS mrr"),
    "coverage": f"""WITH {_RECS}, t AS (SELECT count(DISTINCT i) AS items, count(DISTINCT u) AS users FROM recs)
        SELECT items, users, {c.r6('items / CAST((SELECT count(*) FROM part) AS DOUBLE)')} AS item_coverage,
          {c.r6('users / CAST((SELECT count(*) FROM customer) AS DOUBLE)')} AS user_coverage FROM t""",
    "gini": f"""WITH {_RECS}, x AS (SELECT p_partkey AS i, count(recs.i) AS x FROM part LEFT JOIN recs ON recs.i = p_partkey GROUP BY 1),
        o AS (SELECT x, row_number() OVER (ORDER BY x, i) AS r FROM x),
        t AS (SELECT count(*) AS n, CAST(sum(x) AS BIGINT) AS t, CAST(sum(x * r) AS DOUBLE) AS rx FROM o)
        SELECT n AS items, t AS exposures, {c.r6('2.0::DOUBLE * rx / (n * t) - (n + 1.0::DOUBLE) / n')} AS gini FROM t""",
    "novelty": f"""WITH {_RECS}, o AS (SELECT i, count(*) AS n FROM pref GROUP BY i), p AS (SELECT count(DISTINCT u) AS big_n FROM pref)
        SELECT count(*) AS recs, {c.r6(c.xsum('-log2(n / CAST(big_n AS DOUBLE))') + ' / count(*)')} AS novelty FROM recs JOIN o USING (i), p""",
    "intra_list_diversity": f"""WITH {_RECS}, l AS (SELECT x.u, {c.xsum('coalesce(sim.score, 0.0::DOUBLE)')} / count(*) AS near
        FROM recs x JOIN recs y ON x.u = y.u AND x.i < y.i LEFT JOIN sim ON sim.a = x.i AND sim.b = y.i GROUP BY 1)
        SELECT count(*) AS users, {c.r6('1.0::DOUBLE - ' + c.xsum('near') + ' / count(*)')} AS diversity FROM l""",
    "auc": f"""WITH {ENCODED}, s AS (SELECT score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label <> 1) AS neg FROM scored GROUP BY 1),
        t AS (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM s),
        a AS (SELECT CAST(sum(pos * (2 * below + neg)) AS DOUBLE) AS w, CAST(sum(pos) AS BIGINT) AS pos, CAST(sum(neg) AS BIGINT) AS neg FROM t)
        SELECT pos, neg, {c.r6('w / 2.0::DOUBLE / (CAST(pos AS DOUBLE) * neg)')} AS auc FROM a""",
    "log_loss": f"""WITH {ENCODED}, p AS (SELECT label, greatest(1e-6, least(1.0::DOUBLE - 1e-6, score)) AS p FROM scored)
        SELECT count(*) AS n, {_avg('-(label * ln(p) + (1.0::DOUBLE - label) * ln(1.0::DOUBLE - p))')} AS log_loss FROM p""",
    "ab_summary": f"""WITH t AS (SELECT CAST({c.hash_int("'test-1'", 'user_id')} % 3 AS INTEGER) AS arm, count(*) AS n, count(*) FILTER (event_type = 'purchase') AS hits
          FROM events WHERE event_type IN ('view', 'click', 'purchase') GROUP BY 1),
        z AS (SELECT n AS n0, hits AS x0 FROM t WHERE arm = 0),
        v AS (SELECT *, hits / CAST(n AS DOUBLE) AS p, (hits + x0) / CAST(n + n0 AS DOUBLE) AS pool FROM t, z),
        w AS (SELECT *, sqrt(pool * (1.0::DOUBLE - pool) * (1.0::DOUBLE / n + 1.0::DOUBLE / n0)) AS sd FROM v)
        SELECT arm, n, hits, {c.r6('p')} AS rate, {c.r6('sqrt(p * (1.0::DOUBLE - p) / n)')} AS std_error,
          {c.r6('CASE WHEN arm = 0 OR sd = 0 THEN 0.0::DOUBLE ELSE (p - x0 / CAST(n0 AS DOUBLE)) / sd END')} AS z FROM w""",
}
