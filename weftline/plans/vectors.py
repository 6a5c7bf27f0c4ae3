"""Queries over vectors: dense and sparse neighbours, mapping, merge candidates, projection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions import vectors as V
from weftline.operators import neighbors as N
from weftline.operators import ontology as O
from weftline.operators import projection as P
from weftline.operators import shortlist as S
from weftline.sources.tables import table


def units(spark: SparkSession, d: str) -> DataFrame:
    """id, v, label of the non-zero vectors, of unit length."""
    e = table(spark, d, "embeddings").where(~V.is_zero(F.col("embedding")))
    return e.select(F.col("vec_id").alias("id"), V.l2_normalize(F.col("embedding")).alias("v"), "label")


def centroids(spark: SparkSession, d: str) -> DataFrame:
    """label, v: the mean vector of every label."""
    e = table(spark, d, "embeddings")
    dims = e.select("label", F.posexplode("embedding").alias("i", "x")).groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    return dims.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("v"))


def knn_dense(spark: SparkSession, d: str) -> DataFrame:
    u = units(spark, d)
    out = N.dense_neighbors(u, u, 8)
    return out.select("id", "neighbor_id", "similarity", F.col("rank").cast("bigint").alias("rank"))


def knn_sparse_jaccard(spark: SparkSession, d: str) -> DataFrame:
    """Top 8 companies by weighted Jaccard of their tag scores."""
    f = table(spark, d, "companies").select("company_id", F.explode(F.arrays_zip("tag_ids", "tag_scores")).alias("z"))
    f = f.select(F.col("company_id").alias("entity"), F.col("z.tag_ids").alias("label"), F.col("z.tag_scores").alias("value")).where("label IS NOT NULL AND value BETWEEN 0 AND 1")
    f = f.groupBy("entity", "label").agg(F.max("value").alias("value"))
    return N.sparse_neighbors(f, 8).withColumn("rank", F.col("rank").cast("bigint"))


def combined_vector(spark: SparkSession, d: str) -> DataFrame:
    """Every dimension of the combined vector of each embedding as description, its reverse as metadata, and no tags for odd ids."""
    e = table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("a"), F.reverse(F.col("embedding").cast("array<double>")).alias("b"))
    tags = F.when(F.col("vec_id") % 2 == 0, F.transform("a", lambda x: -x))
    v = V.combine({"description": F.col("a"), "metadata": F.col("b"), "tags": tags})
    return e.select("vec_id", F.posexplode(v).alias("i", "x")).select("vec_id", F.col("i").cast("bigint").alias("i"), F.round("x", 6).alias("x"))


def term_tag_mapping(spark: SparkSession, d: str) -> DataFrame:
    """Every vector as a term against all vectors as tags: the three nearest and the relation."""
    terms = units(spark, d).select("id", "v")
    near = N.dense_neighbors(terms, units(spark, d), 3, exclude_self=False)
    sims = near.select(F.col("id").alias("term_id"), F.lit("industry").alias("kind"), F.lit("a").alias("term_name"), F.col("neighbor_id").alias("tag_id"), F.lit("b").alias("tag_name"), "similarity")
    return S.term_mapping(sims).withColumn("rank", F.col("rank").cast("bigint"))


def merge_candidates(spark: SparkSession, d: str) -> DataFrame:
    u = units(spark, d).select("id", F.concat(F.lit("v"), F.col("id").cast("string")).alias("name"), F.col("label").alias("facet"), (F.col("id") % 7).alias("support"), "v")
    return O.merge_candidates(u, auto=0.6, review=0.4)


def quantized(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings")
    scale = e.agg(F.max(F.array_max(F.transform("embedding", lambda x: F.abs(x.cast("double"))))).alias("s")).first()["s"]
    q = e.select("vec_id", V.quantize_int8(F.col("embedding"), F.lit(scale)).alias("q"))
    return q.select("vec_id", F.aggregate("q", F.lit(0).cast("bigint"), lambda s, x: s + x).alias("total"), F.array_max("q").cast("bigint").alias("largest"))


def shortlist_rules(spark: SparkSession, d: str) -> DataFrame:
    """Candidate labels of every vector by all six rules: similarity, best of each facet, an alias (the next label), a mapping (its own), parents of the first three labels, and hashed hard negatives."""
    tags = centroids(spark, d).select(F.col("label").cast("long").alias("id"), V.l2_normalize(F.col("v")).alias("v"))
    u = units(spark, d)
    near = N.dense_neighbors(u, tags, max(1, tags.count()), exclude_self=False)
    sims = near.select(F.col("id").alias("entity"), F.col("neighbor_id").alias("tag_id"), (F.col("neighbor_id") % 3).alias("facet"), F.col("similarity").alias("score"))
    label = F.col("label").cast("long")
    alias, mapped = (u.where(w).select(F.col("id").alias("entity"), c.alias("tag_id")) for w, c in (("id % 3 = 0", (label + 1) % 10), ("id % 2 = 0", label)))
    parents = tags.where("id < 3").select(F.col("id").alias("tag_id"), (F.col("id") + 5).alias("parent_id"))
    return S.shortlist(sims, alias, mapped, parents, size=2, hard_negatives=1)


def procrustes_rescale(spark: SparkSession, d: str) -> DataFrame:
    """The first two dimensions, rescaled, against a turned and shifted copy, aligned back."""
    p = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding")[0].cast("double").alias("x"), F.col("embedding")[1].cast("double").alias("y"))
    turned = p.select("id", (-F.col("y") * 2 + 1).alias("x"), (F.col("x") * 2 - 3).alias("y"))
    back = P.align(turned, p)
    return P.rescale(back)


def projection_2d(spark: SparkSession, d: str) -> DataFrame:
    return P.rescale(P.project(units(spark, d).select("id", "v"), neighbors=15, epochs=60))


def kmeans_clusters(spark: SparkSession, d: str) -> DataFrame:
    return P.cluster_summary(P.clusters(P.rescale(P.linear_projection(units(spark, d)))))


_U = "u AS (SELECT vec_id AS id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings)"
_SIM = "list_dot_product(A, B) / (sqrt(list_dot_product(A, A)) * sqrt(list_dot_product(B, B)))"
_C = "c AS (SELECT label, list(x ORDER BY i) AS v FROM (SELECT label, i, avg(x) AS x FROM (SELECT label, unnest(v) AS x, unnest(generate_series(1, len(v))) AS i FROM u) GROUP BY label, i) GROUP BY label)"


def _sim(a: str, b: str) -> str:
    return _SIM.replace("A", a).replace("B", b)


KNN_SPARSE_SQL = """WITH f AS (SELECT e, l, max(v) AS v FROM (SELECT company_id AS e, unnest(tag_ids) AS l, unnest(tag_scores) AS v FROM companies) WHERE l IS NOT NULL AND v BETWEEN 0 AND 1 AND v > 0 GROUP BY ALL),
      t AS (SELECT e, sum(v) AS s FROM f GROUP BY e), p AS (SELECT a.e AS e, b.e AS o, sum(least(a.v, b.v)) AS m FROM f a JOIN f b ON a.l = b.l AND a.e <> b.e GROUP BY ALL),
      s AS (SELECT p.e AS entity, o AS neighbor, round(m / (x.s + y.s - m), 9) AS s FROM p JOIN t x ON x.e = p.e JOIN t y ON y.e = p.o)
      SELECT entity, neighbor, round(s, 6) AS similarity, rn - 1 AS rank FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY s DESC, neighbor) AS rn FROM s) WHERE rn <= 8"""
QUERIES = {f.__name__: f for f in (knn_dense, knn_sparse_jaccard, combined_vector, term_tag_mapping, merge_candidates, quantized, shortlist_rules, procrustes_rescale, projection_2d, kmeans_clusters)}
ORACLES = {
    "knn_dense": f"""WITH {_U}, s AS (SELECT a.id, b.id AS neighbor_id, round({_sim("a.v", "b.v")}, 9) AS s FROM u a JOIN u b ON a.id <> b.id)
      SELECT id, neighbor_id, round(s, 6) AS similarity, rn - 1 AS rank FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY s DESC, neighbor_id) AS rn FROM s) WHERE rn <= 8""",
    "knn_sparse_jaccard": KNN_SPARSE_SQL,
    "combined_vector": """WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS a FROM embeddings),
      n AS (SELECT vec_id, a, list_reverse(a) AS b, sqrt(list_dot_product(a, a)) AS l, CASE WHEN vec_id % 2 = 0 THEN -0.25 ELSE 0 END AS t FROM e),
      m AS (SELECT vec_id, list_transform(generate_series(1, len(a)), lambda i: (0.55 + t) * a[i] / l + 0.20 * b[i] / l) AS v FROM n),
      k AS (SELECT vec_id, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) AS v FROM m)
      SELECT vec_id, i - 1 AS i, round(v[i], 6) AS x FROM k, (SELECT unnest(generate_series(1, (SELECT max(len(embedding)) FROM embeddings)))::BIGINT AS i)""",
    "term_tag_mapping": f"""WITH {_U}, s AS (SELECT c.id AS term_id, u.id AS tag_id, round({_sim("c.v", "u.v")}, 9) AS s FROM u c, u),
      r AS (SELECT *, row_number() OVER (PARTITION BY term_id ORDER BY s DESC, tag_id) AS rank FROM s)
      SELECT term_id, tag_id, CASE WHEN round(s, 6) >= 0.9 THEN 'equivalent' WHEN round(s, 6) >= 0.78 THEN 'narrower' ELSE 'related' END AS relation, round(s, 6) AS similarity, rank FROM r WHERE rank <= 3 AND round(s, 6) >= 0.68""",
    "merge_candidates": f"""WITH {_U}, p AS (SELECT a.id AS i, b.id AS j, a.id % 7 AS si, b.id % 7 AS sj, {_sim("a.v", "b.v")} AS s FROM u a JOIN u b ON a.label = b.label AND a.id < b.id)
      SELECT CASE WHEN si >= sj THEN j ELSE i END AS source_id, CASE WHEN si >= sj THEN i ELSE j END AS target_id, round(s, 6) AS similarity, CASE WHEN s >= 0.6 THEN 'auto_merge' ELSE 'review' END AS verdict FROM p WHERE s >= 0.4""",
    "quantized": """WITH m AS (SELECT max(abs(x::DOUBLE)) AS m FROM (SELECT unnest(embedding) AS x FROM embeddings)),
      q AS (SELECT vec_id, list_transform(embedding, lambda x: greatest(-127, least(127, round_even(x::DOUBLE / m * 127, 0)))) AS q FROM embeddings, m)
      SELECT vec_id, list_sum(q)::BIGINT AS total, list_max(q)::BIGINT AS largest FROM q""",
    "shortlist_rules": f"""WITH {_U}, {_C}, s AS (SELECT u.id AS entity, c.label::BIGINT AS tag_id, c.label % 3 AS facet, round(round({_sim("u.v", "c.v")}, 9), 6) AS score, round({_sim("u.v", "c.v")}, 9) AS s9 FROM u, c),
      r AS (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY score DESC, tag_id) AS rank, row_number() OVER (PARTITION BY entity, facet ORDER BY score DESC, tag_id) AS fr FROM s),
      k0 AS (SELECT entity, tag_id, CASE WHEN rank <= 2 THEN 0 ELSE 1 END AS prio FROM r WHERE rank <= 2 OR fr = 1 UNION ALL SELECT id, (label::BIGINT + 1) % 10, 2 FROM u WHERE id % 3 = 0 UNION ALL SELECT id, label::BIGINT, 3 FROM u WHERE id % 2 = 0),
      k AS (SELECT entity, tag_id, min(prio) AS prio FROM (SELECT * FROM k0 UNION ALL SELECT entity, tag_id + 5, 4 FROM k0 WHERE tag_id < 3) GROUP BY ALL),
      p AS (SELECT r.entity, r.tag_id, score, (['retrieval', 'facet_prior', 'alias', 'metadata_rule', 'parent'])[prio + 1] AS reason, rank FROM r LEFT JOIN k ON k.entity = r.entity AND k.tag_id = r.tag_id),
      h AS (SELECT entity, tag_id, score, row_number() OVER (PARTITION BY entity ORDER BY sha256('20240917|' || entity || '|' || tag_id)) AS n FROM p WHERE reason IS NULL AND rank > 2 AND rank <= 6)
      SELECT entity, tag_id, reason, score FROM p WHERE reason IS NOT NULL UNION ALL SELECT entity, tag_id, 'hard_negative', score FROM h WHERE n = 1""",
    "procrustes_rescale": """WITH p AS (SELECT vec_id AS id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y FROM embeddings), m AS (SELECT avg(x) AS mx, avg(y) AS my FROM p),
      c AS (SELECT id, x - mx AS x, y - my AS y FROM p, m), s AS (SELECT quantile_cont(v, 0.99) AS s FROM (SELECT abs(x) AS v FROM c UNION ALL SELECT abs(y) FROM c))
      SELECT id, round(x / s, 4) + 0.0::DOUBLE AS x, round(y / s, 4) + 0.0::DOUBLE AS y FROM c, s""",
}
