"""Registered queries: content-based similarity, vectors and latent factors."""

from __future__ import annotations

from pyspark.sql import functions as F

from tastemill.functions.exact import exact_sum, round6
from tastemill.operators import content as ct
from tastemill.operators import factors as fa
from tastemill.operators import neighbours as nb
from tastemill.plans import common as c
from tastemill.session import write_stage
from tastemill.sources import tables

DIM = 64
ATTRIBUTES = {"p_brand": 0.5, "size_band": 0.3}


def _vectors(s, d):
    return tables.item_vectors(c.table(s, d, "embeddings"))


def _terms(s, d):
    return ct.tfidf(c.table(s, d, "documents"))


def _attributes(s, d):
    return ct.attribute_similarity(
        tables.item_attributes(c.table(s, d, "part")), ATTRIBUTES, "p_type", 10
    )


def _profiles(s, d, prefs=None):
    return ct.user_profile(c.prefs(s, d) if prefs is None else prefs, _vectors(s, d), DIM)


def _profile_rows(s, d):
    return _profiles(s, d).select("user", F.posexplode("vec").alias("dim", "value"))


def _content_recs(s, d):
    # Read by the profiles and as what users have seen.
    prefs = write_stage(c.prefs(s, d).select("user", "item", "weight"), "prefs")
    return ct.content_recs(_profiles(s, d, prefs), _vectors(s, d), prefs, 10)


def _als_explicit(s, d):
    ratings = c.ratings(s, d)
    return fa.als_predictions(fa.als_explicit(ratings, 8, 0.1, 5, 11), ratings)


def _als_implicit(s, d):
    prefs = c.prefs(s, d)
    model = fa.als_implicit(prefs, 8, 0.1, 0.5, 5, 11)
    return model.itemFactors.select(
        F.col("id").cast("bigint").alias("item"), F.posexplode("features").alias("dim", "value")
    )


def _als_top_n(s, d):
    prefs = c.prefs(s, d)
    model = fa.als_implicit(prefs, 8, 0.1, 0.5, 5, 11)
    return fa.als_top_n(model, prefs.select("user").distinct(), prefs, 10)


def _fold_in(s, d):
    ratings = c.ratings(s, d)
    model = fa.als_explicit(ratings, 8, 0.1, 5, 11)
    folded = fa.als_fold_in(model.itemFactors, ratings, 0.1, 8)
    return folded.select("user", F.posexplode("features").alias("dim", "value"))


def _item2vec(s, d):
    vectors = fa.item2vec(c.event_interactions(s, d), 16, 5, 3)
    return vectors.select("id", F.posexplode("vec").alias("dim", "value"))


def _clusters(s, d):
    vectors = _vectors(s, d)
    return fa.assign_clusters(fa.cluster_items(vectors, 8, 5), vectors)


def _in_cluster(s, d):
    vectors = _vectors(s, d)
    return fa.nearest_in_cluster(vectors, fa.cluster_items(vectors, fa.cluster_count(vectors), 5), 10, 4)


def _profile_vectors(s, d):
    """Four averages of a part's sales, less those of all parts: a table whose vectors have near neighbours."""
    lines = c.table(s, d, "lineitem")
    share = (F.col("l_returnflag") == "R").cast("double")
    values = {"quantity": F.col("l_quantity") / 50, "discount": F.col("l_discount") * 10, "tax": F.col("l_tax") * 12, "returned": share}
    means = [(exact_sum(v, 1e6) / F.count(F.lit(1))).alias(n) for n, v in values.items()]
    per_part = lines.groupBy(F.col("l_partkey").alias("id")).agg(*means)
    all_parts = lines.agg(*means)
    centred = [round6(F.col(n) - all_parts.select(n).scalar()) for n in values]
    return per_part.select("id", F.array(*centred).alias("vec"))


def _parts_in_cells(s, d):
    vectors = write_stage(_profile_vectors(s, d), "profiles")
    return fa.nearest_in_cluster(vectors, fa.cluster_items(vectors, fa.cluster_count(vectors), 5), 10)


QUERIES = {
    "tfidf": _terms,
    "similar_docs": lambda s, d: ct.similar_docs(_terms(s, d), 5, 0.5),
    "attribute_similarity": _attributes,
    "user_profile": _profile_rows,
    "content_recs": _content_recs,
    "nearest_exact": lambda s, d: fa.nearest_exact(_vectors(s, d), _vectors(s, d), 10),
    "nearest_in_cluster": _in_cluster,
    "nearest_parts_in_cells": _parts_in_cells,
    "nearest_lsh": lambda s, d: fa.nearest_lsh(_vectors(s, d), 10, 0.2, 12, 1.3, 5, 6),
    "minhash_neighbours": lambda s, d: nb.minhash_neighbours(c.prefs(s, d), 16, 0.04, 10),
    "jaccard_join": lambda s, d: nb.jaccard_join(c.prefs(s, d), 0.04, 10),
    "als_explicit": _als_explicit,
    "als_implicit": _als_implicit,
    "als_top_n": _als_top_n,
    "als_fold_in": _fold_in,
    "item_contexts": lambda s, d: fa.item_contexts(c.event_interactions(s, d), 5),
    "item_pmi_cells": lambda s, d: fa.positive_pmi(fa.item_contexts(c.event_interactions(s, d), 5)),
    "item2vec": _item2vec,
    "cluster_items": _clusters,
}

_TERMS = f"""words AS (SELECT doc_id, unnest(string_split_regex(lower(text), '[ \\t\\n\\r\\f]+')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM words WHERE term <> '' GROUP BY 1, 2),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1), nd AS (SELECT count(*) AS n FROM documents),
terms AS MATERIALIZED (SELECT doc_id, tf.term, tf, df, {c.r6('tf * ln((n + 1.0::DOUBLE) / (df + 1.0::DOUBLE))')} AS weight FROM tf JOIN df ON df.term = tf.term, nd)"""
_PROFILE = f"""parts AS (SELECT u, unnest(range(64)) AS dim, unnest(embedding) AS x, w FROM pref JOIN embeddings ON vec_id = i),
prof AS MATERIALIZED (SELECT u, dim, {c.r6(c.xsum('w * CAST(x AS DOUBLE)') + ' / ' + c.xsum('w', '1e6'))} AS value FROM parts GROUP BY 1, 2)"""


def _cosine(a: str, b: str) -> str:
    return c.r6(f"list_dot_product({a}, {b}) / (sqrt(list_dot_product({a}, {a})) * sqrt(list_dot_product({b}, {b})))")


_VECS = "vecs AS MATERIALIZED (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"



def _mean(value: str) -> str:
    return f"{c.xsum(value, '1e6')} / count(*)"


_PARTS = {"q": "l_quantity / 50", "d": "l_discount * 10", "t": "l_tax * 12", "r": "CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"}
_PROFILES = f"""per AS (SELECT l_partkey AS id, {', '.join(f'{_mean(v)} AS {n}' for n, v in _PARTS.items())} FROM lineitem GROUP BY 1),
whole AS (SELECT {', '.join(f'{_mean(v)} AS {n}' for n, v in _PARTS.items())} FROM lineitem),
vecs AS MATERIALIZED (SELECT id, [{', '.join(c.r6(f'per.{n} - whole.{n}') for n in _PARTS)}] AS v FROM per, whole)"""


def _nearest(vectors: str) -> str:
    return f"""WITH {vectors}, sc AS (SELECT x.id, y.id AS b, {_cosine('x.v', 'y.v')} AS score FROM vecs x JOIN vecs y ON x.id <> y.id)
        SELECT * FROM (SELECT *, {c.rank_int('id', 'score DESC, b')} AS rank FROM sc) WHERE rank <= 10"""


_JACCARD = f"""WITH {c.PREF}, n AS (SELECT i, count(*) AS n FROM pref GROUP BY i),
        both_own AS (SELECT x.i AS a, y.i AS b, count(*) AS k FROM pref x JOIN pref y ON x.u = y.u AND x.i <> y.i GROUP BY 1, 2),
        sim AS (SELECT a, b, {c.r6('k / (p.n + q.n - k)')} AS score FROM both_own JOIN n p ON p.i = a JOIN n q ON q.i = b)
        SELECT * FROM (SELECT a AS id, b, score, {c.rank_int('a', 'score DESC, b')} AS rank FROM sim WHERE score >= 0.04::DOUBLE) WHERE rank <= 10"""

# Offsets are an outer table, so that each is an equality join on (user, position).
_CONTEXTS = f"""{c.EVI}, stepped AS MATERIALIZED (SELECT u, i, row_number() OVER (PARTITION BY u ORDER BY ts, event_id) AS pos FROM evi),
context AS MATERIALIZED (SELECT least(x.i, y.i) AS a, greatest(x.i, y.i) AS b, count(*) AS k, CAST(sum(6 - x.far) AS BIGINT) AS weight
  FROM (SELECT u, i, pos, unnest([1, 2, 3, 4, 5]) AS far FROM stepped) x JOIN stepped y ON y.u = x.u AND y.pos = x.pos + x.far GROUP BY 1, 2)"""

ORACLE = {
    "item_contexts": f"WITH {_CONTEXTS} SELECT * FROM context",
    "item_pmi_cells": f"""WITH {_CONTEXTS}, both_ways AS (SELECT a, b, weight AS w FROM context UNION ALL SELECT b, a, weight FROM context),
cell AS MATERIALIZED (SELECT a, b, sum(w) AS w FROM both_ways GROUP BY 1, 2), own AS (SELECT a, sum(w) AS n FROM cell GROUP BY 1), t AS (SELECT sum(w) AS t FROM cell),
scored AS (SELECT cell.a, cell.b, {c.r6('ln(CAST(w AS DOUBLE) * CAST(t AS DOUBLE) / (CAST(x.n AS DOUBLE) * CAST(y.n AS DOUBLE)))')} AS score
  FROM cell JOIN own x ON x.a = cell.a JOIN own y ON y.a = cell.b, t)
SELECT * FROM scored WHERE score > 0""",
    "jaccard_join": _JACCARD,
    # At this bar min-hashes would meet too few pairs, so the lists are the exact ones.
    "minhash_neighbours": _JACCARD,
    "tfidf": f"WITH {_TERMS} SELECT * FROM terms",
    "similar_docs": f"""WITH {_TERMS}, nrm AS (SELECT doc_id, sqrt({c.xsum('weight * weight', '1e6')}) AS nrm FROM terms GROUP BY 1),
        u AS MATERIALIZED (SELECT doc_id AS id, term, weight / nrm AS u FROM terms JOIN nrm USING (doc_id) WHERE nrm > 0),
        sim AS (SELECT x.id AS a, y.id AS b, {c.r6(c.xsum('x.u * y.u'))} AS score FROM u x JOIN u y ON x.term = y.term AND x.id < y.id GROUP BY 1, 2),
        ok AS (SELECT * FROM sim WHERE score >= 0.5::DOUBLE), both_ways AS (SELECT a, b, score FROM ok UNION ALL SELECT b, a, score FROM ok)
        SELECT * FROM (SELECT a AS id, b, score, {c.rank_int('a', 'score DESC, b')} AS rank FROM both_ways) WHERE rank <= 5""",
    "attribute_similarity": f"""WITH it AS (SELECT p_partkey AS i, p_brand, p_type, CAST(floor(p_size / 10) AS INTEGER) AS band FROM part),
        sim AS (SELECT x.i AS id, y.i AS b, {c.r6('(CASE WHEN x.p_brand = y.p_brand THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END) + (CASE WHEN x.band = y.band THEN 0.3::DOUBLE ELSE 0.0::DOUBLE END)')} AS score
          FROM it x JOIN it y ON x.p_type = y.p_type AND x.i <> y.i)
        SELECT * FROM (SELECT *, {c.rank_int('id', 'score DESC, b')} AS rank FROM sim) WHERE rank <= 10""",
    "user_profile": f'WITH {c.PREF}, {_PROFILE} SELECT u AS "user", CAST(dim AS INTEGER) AS dim, value FROM prof',
    "content_recs": f"""WITH {c.PREF}, {_PROFILE}, {_VECS},
        pv AS MATERIALIZED (SELECT u, list(value ORDER BY dim) AS v FROM prof GROUP BY u),
        sc AS (SELECT u, id AS i, {_cosine('pv.v', 'vecs.v')} AS score FROM pv, vecs
          WHERE NOT EXISTS (SELECT 1 FROM pref p WHERE p.u = pv.u AND p.i = vecs.id))
        SELECT * FROM (SELECT u AS "user", i AS item, score, {c.rank_int('u', 'score DESC, i')} AS rank FROM sc) WHERE rank <= 10""",
    "nearest_exact": _nearest(_VECS),
    "nearest_in_cluster": _nearest(_VECS),
    "nearest_parts_in_cells": _nearest(_PROFILES),
    # At these parameters hashing would meet most vectors, so the lists are the exact ones.
    "nearest_lsh": f"""WITH {_VECS}, sc AS (SELECT x.id, y.id AS b, sqrt(list_sum(list_transform(list_zip(x.v, y.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))) AS far FROM vecs x JOIN vecs y ON x.id <> y.id),
        near AS (SELECT id, b, {c.r6('-far')} AS score FROM sc WHERE far <= 1.3::DOUBLE)
        SELECT * FROM (SELECT *, {c.rank_int('id', 'score DESC, b')} AS rank FROM near) WHERE rank <= 10""",
}
