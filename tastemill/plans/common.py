"""Inputs and SQL fragments shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tastemill.operators import interactions as prep
from tastemill.sources import tables


def purchases(spark: SparkSession, folder: str) -> DataFrame:
    return tables.purchases(
        tables.read_table(spark, folder, "lineitem"), tables.read_table(spark, folder, "orders")
    )


def prefs(spark: SparkSession, folder: str) -> DataFrame:
    return prep.preferences(purchases(spark, folder))


def ratings(spark: SparkSession, folder: str) -> DataFrame:
    return tables.derived_ratings(prefs(spark, folder))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return tables.read_table(spark, folder, name)


def event_interactions(spark: SparkSession, folder: str) -> DataFrame:
    return tables.event_interactions(table(spark, folder, "events"))


def xsum(term: str, scale: str = "1e9") -> str:
    """Order-free sum, as ``functions.exact.exact_sum``."""
    return f"(CAST(sum(CAST(floor(({term})*{scale}+0.5) AS BIGINT)) AS BIGINT)/{scale})"


def r6(value: str) -> str:
    return f"(floor(({value})*1e6+0.5)/1e6)"


def hash_int(*parts: str) -> str:
    text = " || '-' || ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"CAST('0x' || substr(md5({text}),1,8) AS BIGINT)"


def rank_int(keys: str, order: str) -> str:
    return f"CAST(row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS INTEGER)"


PUR = """pur AS MATERIALIZED (
  SELECT o_custkey AS u, l_partkey AS i, o_orderdate AS ts, l_quantity AS w, l_orderkey AS basket
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
PREF = f"""{PUR}, pref AS MATERIALIZED (
  SELECT u, i, {xsum('w')} AS w, max(ts) AS last_ts FROM pur GROUP BY u, i)"""
RATING = f"""{PREF}, rating AS MATERIALIZED (
  SELECT u, i, least(5.0, 1.0 + floor(w / 11.0)) AS r FROM pref)"""
EVI = """evi AS MATERIALIZED (
  SELECT user_id AS u, CAST(json_extract_string(props, '$.k') AS BIGINT) AS i, ts, event_id,
    CASE event_type WHEN 'view' THEN 1.0::DOUBLE WHEN 'click' THEN 2.0::DOUBLE ELSE 5.0::DOUBLE END AS w
  FROM events WHERE event_type IN ('view', 'click', 'purchase'))"""
PAIRS = """cnt AS MATERIALIZED (SELECT i, count(*) AS n FROM pref GROUP BY i),
total AS (SELECT count(DISTINCT u) AS big_n FROM pref),
pairs AS MATERIALIZED (
  SELECT x.i AS a, y.i AS b, count(*) AS k
  FROM pref x JOIN pref y ON x.u = y.u AND x.i < y.i GROUP BY 1, 2),
sized AS MATERIALIZED (
  SELECT a, b, k, ca.n AS n_a, cb.n AS n_b
  FROM pairs JOIN cnt ca ON ca.i = a JOIN cnt cb ON cb.i = b)"""
SIZED = f"{PREF}, {PAIRS}"


def near_sql(source: str, k: int, name: str = "near") -> str:
    """Directed top-k list of an undirected (a, b, k, score) relation."""
    return f"""{name}_both AS (SELECT a, b, k, score FROM {source} UNION ALL SELECT b, a, k, score FROM {source}),
{name} AS MATERIALIZED (SELECT * FROM (
  SELECT a, b, k, score, {rank_int('a', 'score DESC, b')} AS rank FROM {name}_both) WHERE rank <= {k})"""
