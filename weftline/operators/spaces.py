"""Embedding spaces of companies: their documents, vectors per space, and neighbours of all spaces."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions import vectors as V
from weftline.functions.hashing import stable_hash
from weftline.functions.text import tag_document
from weftline.operators.neighbors import dense_neighbors, sparse_neighbors
from weftline.operators.normalize import description_document
from weftline.runtime import materialize, release, salted_join
from weftline.sources.models import Backend, embed_texts, request_key

DENSE = ("description", "metadata", "tags", "combined")


def tag_documents(features: DataFrame, tags: DataFrame, best: int = 24) -> DataFrame:
    """company_id, text: the documents of a company's best tags (by feature value, then id), in that order."""
    w = Window.partitionBy("company_id").orderBy(F.desc("feature_value"), "tag_id")
    top = features.select("company_id", "tag_id", "feature_value").withColumn("pos", F.row_number().over(w)).where(F.col("pos") <= best)
    named = tags.select("tag_id", tag_document(F.col("canonical_name"), F.col("facet"), F.col("definition")).alias("t"))
    both = salted_join(top, named, ["tag_id"], "inner")
    return both.groupBy("company_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "t"))), lambda x: x["t"]), " ").alias("text"))


def space_documents(companies: DataFrame, features: DataFrame, tags: DataFrame) -> DataFrame:
    """company_id, kind, text of the three spaces that have texts; blank texts are left out."""
    columns = {"website_text": "string", "long_description": "string"}
    c = companies.withColumns({k: F.lit(None).cast(t) for k, t in columns.items() if k not in companies.columns})
    two = c.select("company_id", F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), t.alias("text")) for k, t in (("description", description_document()), ("metadata", F.col("metadata_document")))))).alias("s")).select("company_id", "s.*")
    return two.unionByName(tag_documents(features, tags).select("company_id", F.lit("tags").alias("kind"), "text")).where("trim(text) <> ''")


def embedded(documents: DataFrame, backend: Backend, cache: DataFrame | None = None) -> DataFrame:
    """company_id, kind, vector (unit length), document_hash of all four spaces: every distinct text is asked for once, and the combined vector is of those a company has."""
    keyed = materialize(documents.withColumn("key", request_key(F.col("text"), backend)).withColumn("document_hash", F.sha2("text", 256)), "documents")
    vectors = embed_texts(keyed.select("text"), cache, backend).select("key", V.l2_normalize(F.col("vector")).alias("vector")).where(~V.is_zero(F.col("vector")))
    three = materialize(salted_join(keyed.select("company_id", "kind", "key", "document_hash"), vectors, ["key"], "inner").drop("key"), "vectors")
    wide = three.groupBy("company_id").pivot("kind", list(V.COMBINED)).agg(F.first("vector"))
    digest = stable_hash(**{k: F.coalesce(F.to_json(F.struct(F.lit(k), F.col(k))), F.lit("")) for k in V.COMBINED})
    combined = wide.select("company_id", F.lit("combined").alias("kind"), V.combine({k: F.col(k) for k in V.COMBINED}).alias("vector"), digest.alias("document_hash"))
    release(keyed)
    return three.select("company_id", "kind", "vector", "document_hash").unionByName(combined)


def write_spaces(vectors: DataFrame, path: str) -> None:
    """Vectors partitioned by space, so that one space is one folder."""
    vectors.repartition("kind", F.pmod(F.xxhash64("company_id"), F.lit(64))).write.mode("overwrite").partitionBy("kind").parquet(path)


def all_neighbors(vectors: DataFrame, features: DataFrame, k: int) -> DataFrame:
    """company_id, neighbor_company_id, space, rank, similarity of the four dense spaces and the sparse tags."""
    parts = []
    for kind in DENSE:
        v = vectors.where(F.col("kind") == kind).select(F.col("company_id").alias("id"), F.col("vector").alias("v"))
        parts.append(dense_neighbors(v, v, k).select(F.col("id").alias("company_id"), F.col("neighbor_id").alias("neighbor_company_id"), F.lit(kind).alias("space"), F.col("rank").cast("int").alias("rank"), "similarity"))
    s = sparse_neighbors(features, k, "company_id", "tag_id", "feature_value")
    parts.append(s.select(F.col("entity").alias("company_id"), F.col("neighbor").alias("neighbor_company_id"), F.lit("sparse_tags").alias("space"), F.col("rank").cast("int").alias("rank"), "similarity"))
    return reduce(DataFrame.unionByName, parts)
