"""Registered queries: walks on the user-item graph."""

from __future__ import annotations

from pyspark.sql import functions as F

from tastemill.functions.ranked import top_per
from tastemill.operators import graph as gr
from tastemill.plans import common as c

ROUNDS = 4
#: Residual over degree that is pushed on.
PUSH = 4e-6


def _seeds(s, d):
    """The customer with the largest balance in each nation."""
    rows = c.table(s, d, "customer").select(F.col("c_custkey").alias("user"), "c_nationkey", "c_acctbal")
    return top_per(rows, ["c_nationkey"], [F.desc("c_acctbal"), F.asc("user")], 1).select("user")


QUERIES = {
    "pagerank_items": lambda s, d: gr.pagerank_items(c.prefs(s, d), 0.85, ROUNDS),
    "personal_rank": lambda s, d: gr.personal_rank(c.prefs(s, d), _seeds(s, d), 0.8, ROUNDS, 10),
    "personal_rank_push": lambda s, d: gr.personal_rank_push(c.prefs(s, d), _seeds(s, d), 0.8, PUSH, 10),
    "mass_diffusion": lambda s, d: gr.mass_diffusion(c.prefs(s, d), 1.0, 10),
    "heat_conduction_blend": lambda s, d: gr.mass_diffusion(c.prefs(s, d), 0.5, 10),
}

_EDGE = f"""{c.PREF}, nu AS (SELECT u, count(*) AS n_u FROM pref GROUP BY u), ni AS (SELECT i, count(*) AS n_i FROM pref GROUP BY i),
e AS MATERIALIZED (SELECT u, i, n_u, n_i FROM pref JOIN nu USING (u) JOIN ni USING (i))"""


def _pagerank(rounds: int) -> str:
    parts = ["ru0 AS (SELECT u, 1.0::DOUBLE AS r FROM nu)", "ri0 AS (SELECT i, 1.0::DOUBLE AS r FROM ni)"]
    base, keep = "(1.0::DOUBLE - 0.85::DOUBLE)", "0.85::DOUBLE"
    for t in range(1, rounds + 1):
        parts.append(f"ri{t} AS MATERIALIZED (SELECT i, {c.r6(f'{base} + {keep} * ' + c.xsum('r / n_u'))} AS r FROM e JOIN ru{t-1} USING (u) GROUP BY i)")
        parts.append(f"ru{t} AS MATERIALIZED (SELECT u, {c.r6(f'{base} + {keep} * ' + c.xsum('r / n_i'))} AS r FROM e JOIN ri{t-1} USING (i) GROUP BY u)")
    return f"WITH {_EDGE}, {', '.join(parts)} SELECT i AS item, r AS score FROM ri{rounds}"


def _pushed(rounds: int) -> str:
    """As many rounds as it takes on the given tables; a round without a large residual changes nothing."""
    parts = [
        "seed AS MATERIALIZED (SELECT u FROM (SELECT c_custkey AS u, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS rn FROM customer) WHERE rn = 1)",
        "links AS MATERIALIZED (SELECT false AS it, u AS v, n_u AS g, i AS w, n_i AS h FROM e UNION ALL SELECT true, i, n_i, u, n_u FROM e)",
        "st0 AS MATERIALIZED (SELECT seed.u AS s, false AS it, seed.u AS v, n_u AS g, 1.0::DOUBLE AS r, 0.0::DOUBLE AS p FROM seed JOIN nu ON nu.u = seed.u)",
    ]
    for t in range(rounds):
        big = f"r > {PUSH}::DOUBLE * g"
        parts.append(
            f"fl{t} AS (SELECT s, NOT a.it AS it, w AS v, h AS g, {c.xsum('0.8::DOUBLE * r / a.g', '1e12')} AS f FROM st{t} a JOIN links l ON l.it = a.it AND l.v = a.v WHERE a.{big.replace('* g', '* a.g')} GROUP BY 1, 2, 3, 4)"
        )
        parts.append(
            f"st{t + 1} AS MATERIALIZED (SELECT s, it, v, g, coalesce(CASE WHEN {big} THEN 0.0::DOUBLE ELSE r END, 0.0::DOUBLE) + coalesce(f, 0.0::DOUBLE) AS r, "
            f"coalesce(p + CASE WHEN {big} THEN (1.0::DOUBLE - 0.8::DOUBLE) * r ELSE 0.0::DOUBLE END, 0.0::DOUBLE) AS p FROM st{t} FULL JOIN fl{t} USING (s, it, v, g))"
        )
    return f"""WITH {_EDGE}, {', '.join(parts)},
        given AS (SELECT s, {c.r6('1.0::DOUBLE - ' + c.xsum('p', '1e12'))} AS missing FROM st{rounds} GROUP BY s),
        sc AS (SELECT s, v, floor(p * 1e9 + 0.5) / 1e9 AS score FROM st{rounds} x WHERE it AND p > 0 AND NOT EXISTS (SELECT 1 FROM pref q WHERE q.u = x.s AND q.i = x.v))
        SELECT s AS "user", v AS item, score, rank, missing FROM (SELECT *, {c.rank_int('s', 'score DESC, v')} AS rank FROM sc) JOIN given USING (s) WHERE rank <= 10"""


def _personal(rounds: int) -> str:
    parts = [
        "seed AS MATERIALIZED (SELECT u FROM (SELECT c_custkey AS u, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS rn FROM customer) "
        "WHERE rn = 1 AND u IN (SELECT u FROM pref))",
        "mu0 AS (SELECT u AS s, u, 1.0::DOUBLE AS m FROM seed)",
    ]
    d = "0.8::DOUBLE"
    for t in range(1, rounds + 1):
        parts.append(f"mi{t} AS MATERIALIZED (SELECT s, i, {d} * {c.xsum('m / n_u', '1e12')} AS m FROM mu{t-1} JOIN e USING (u) GROUP BY 1, 2)")
        start = f"SELECT u AS s, u, 1.0::DOUBLE - {d} AS m FROM seed"
        if t == 1:
            parts.append(f"mu{t} AS MATERIALIZED ({start})")
        else:
            parts.append(
                f"mu{t} AS MATERIALIZED (SELECT s, u, {c.xsum('m', '1e12')} AS m FROM ({start} UNION ALL "
                f"SELECT s, u, {d} * {c.xsum('m / n_i', '1e12')} AS m FROM mi{t-1} JOIN e USING (i) GROUP BY 1, 2) GROUP BY 1, 2)"
            )
    return f"""WITH {_EDGE}, {', '.join(parts)},
        sc AS (SELECT s, i, CAST(floor(m * 1e9 + 0.5) AS BIGINT) AS e9 FROM mi{rounds} WHERE NOT EXISTS (SELECT 1 FROM pref p WHERE p.u = s AND p.i = mi{rounds}.i))
        SELECT s AS "user", i AS item, e9 / 1e9 AS score, rank FROM (SELECT *, {c.rank_int('s', 'e9 DESC, i')} AS rank FROM sc) WHERE rank <= 10"""


def _diffusion(blend: float) -> str:
    return f"""WITH {_EDGE},
        f AS (SELECT x.i AS a, y.i AS b, x.n_i AS n_a, y.n_i AS n_b, {c.xsum('1.0::DOUBLE / x.n_u')} AS flow
          FROM e x JOIN e y ON x.u = y.u AND x.i < y.i GROUP BY 1, 2, 3, 4),
        dir AS (SELECT * FROM f UNION ALL SELECT b, a, n_b, n_a, flow FROM f),
        sc AS (SELECT a, b, {c.r6(f'flow / (pow(CAST(n_b AS DOUBLE), {1.0 - blend}::DOUBLE) * pow(CAST(n_a AS DOUBLE), {blend}::DOUBLE))')} AS score FROM dir)
        SELECT * FROM (SELECT *, {c.rank_int('a', 'score DESC, b')} AS rank FROM sc) WHERE rank <= 10"""


ORACLE = {
    "pagerank_items": _pagerank(ROUNDS),
    "personal_rank": _personal(ROUNDS),
    "personal_rank_push": _pushed(20),
    "mass_diffusion": _diffusion(1.0),
    "heat_conduction_blend": _diffusion(0.5),
}
