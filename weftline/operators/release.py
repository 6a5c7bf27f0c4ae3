"""A published release: its tables, its files with counts and checksums, the pointer that makes it current, and its gates.

A release is a folder of its own. Every artifact is written by the executors as JSON lines (the
details partitioned by shard), only the manifest and the pointer by the driver. The pointer is
replaced last and at once, so readers see the former release or all of the new one.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.functions.hashing import shard_for
from weftline.operators import publish as P
from weftline.operators import quality as Q
from weftline.runtime import materialize, row_numbers, salted_join

#: Spaces whose matches shared tags explain, and those that shared facts explain.
TAG_SPACES, FACT_SPACES = ("combined", "tags", "sparse_tags"), ("combined", "metadata")
PROVENANCE = ("dataset_version", "schema_version", "generated_at", "source_url", "models", "limitations")
ARTIFACTS = ("points", "companies", "tags", "taxonomy_terms", "taxonomy_mappings", "clusters", "search", "detail", "quality")


def published(companies: DataFrame, points: DataFrame) -> DataFrame:
    """Companies that have a point: the map, the index and the details can't disagree."""
    return companies.join(points.select("company_id").distinct(), "company_id", "left_semi")


def detail_tags(features: DataFrame, judged: DataFrame, tags: DataFrame) -> DataFrame:
    """Features with their tags and, where the judgment is a yes, its reasons: rationale, evidence and why it was considered."""
    yes = judged.where("decision = 'yes'").select("company_id", "tag_id", "rationale", "evidence", "shortlist_reason").dropDuplicates(["company_id", "tag_id"])
    rows = features.join(yes, ["company_id", "tag_id"], "left")
    rows = salted_join(rows, tags.select("tag_id", F.col("canonical_name").alias("name"), "facet"), ["tag_id"], "inner")
    evidence = F.transform(F.coalesce("evidence", F.array().cast("array<struct<document_id: string, quote: string>>")), lambda e: F.struct(e["document_id"].alias("doc"), e["quote"].alias("quote")))
    return rows.select(
        "company_id", "tag_id", "name", "facet", F.round("feature_value", 4).alias("value"), F.round("calibrated_confidence", 3).alias("confidence"), F.round("raw_confidence", 3).alias("raw_confidence"),
        F.round("information_weight", 3).alias("weight"), "rationale", evidence.alias("evidence"), "shortlist_reason",
    )


def detail_uncertain(judged: DataFrame, tags: DataFrame, most: int = 12) -> DataFrame:
    """company_id, tag_id, name, notes, place: the first uncertain judgments of a company, by tag."""
    rows = salted_join(judged.where("decision = 'uncertain'").select("company_id", "tag_id", "notes"), tags.select("tag_id", F.col("canonical_name").alias("name")), ["tag_id"], "inner")
    w = Window.partitionBy("company_id").orderBy("tag_id")
    return rows.withColumn("place", F.row_number().over(w)).where(F.col("place") <= most).select("company_id", "tag_id", "name", "notes", "place")


def published_neighbors(neighbors: DataFrame, companies: DataFrame, most: int = 12) -> DataFrame:
    """The first neighbours of a company in every space, among published companies, with ``place`` from 1."""
    ids = companies.select("company_id").distinct()
    kept = neighbors.join(ids, "company_id", "left_semi").join(ids.withColumnRenamed("company_id", "neighbor_company_id"), "neighbor_company_id", "left_semi")
    w = Window.partitionBy("company_id", "space").orderBy("rank", "neighbor_company_id")
    return kept.withColumn("place", F.row_number().over(w)).where(F.col("place") <= most).select("company_id", "space", "place", "neighbor_company_id", "similarity")


def explained_neighbors(kept: DataFrame, features: DataFrame, tags: DataFrame, facts: DataFrame, most_tags: int = 6, most_facts: int = 4) -> DataFrame:
    """Published neighbours with the tags (names, by id) and rare facts both ends share, each where it can explain the space.

    ``facts``: id, facts. Each unordered pair is looked at once, whatever the number of its spaces.
    """
    pairs = kept.select(F.col("company_id").alias("id"), F.col("neighbor_company_id").alias("neighbor_id"), "space")
    t = materialize(pairs.where(F.col("space").isin(*TAG_SPACES)).select("id", "neighbor_id").distinct(), "tag-edges")
    names = tags.select("tag_id", F.col("canonical_name").alias("name")).where("tag_id IS NOT NULL").dropDuplicates(["tag_id"])
    t = P.shared_items(t, features.select(F.col("company_id").alias("id"), "tag_id").distinct(), names, "tag_id", ["tag_id"], "name", most_tags).withColumnRenamed("shared", "shared_tags")
    m = P.neighbor_explanations(pairs.where(F.col("space").isin(*FACT_SPACES)).select("id", "neighbor_id").distinct(), facts, most=most_facts).withColumnRenamed("shared", "shared_metadata")
    out = kept.withColumnsRenamed({"company_id": "id", "neighbor_company_id": "neighbor_id"}).join(t, ["id", "neighbor_id"], "left").join(m, ["id", "neighbor_id"], "left")
    return out.select(
        F.col("id").alias("company_id"), "space", "place", F.col("neighbor_id").alias("neighbor_company_id"), F.round("similarity", 4).alias("score"),
        F.when(F.col("space").isin(*TAG_SPACES), F.col("shared_tags")).alias("shared_tags"), F.when(F.col("space").isin(*FACT_SPACES), F.col("shared_metadata")).alias("shared_metadata"),
    )


def detail_records(companies: DataFrame, tag_rows: DataFrame, uncertain: DataFrame, neighbors: DataFrame, points: DataFrame, shards: int = 64) -> DataFrame:
    """company_id, shard, record (JSON): the company with its tags by value, uncertain tags, explained neighbours by space, and coordinates."""
    t = tag_rows.groupBy("company_id").agg(F.array_sort(F.collect_list(F.struct((-F.col("value")).alias("k"), "tag_id", F.struct(*[c for c in tag_rows.columns if c != "company_id"]).alias("v")))).alias("t"))
    u = uncertain.groupBy("company_id").agg(F.array_sort(F.collect_list(F.struct("place", F.struct("tag_id", "name", "notes").alias("v")))).alias("u"))
    entry = F.struct(F.col("neighbor_company_id").alias("id"), "score", "shared_tags", "shared_metadata")
    n = neighbors.groupBy("company_id", "space").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", entry.alias("v")))), lambda x: x["v"]).alias("e"))
    n = n.groupBy("company_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("space", "e")))).alias("neighbors"))
    p = points.select("company_id", F.struct("x", "y", "cluster").alias("coordinates")).dropDuplicates(["company_id"])
    out = companies.join(t, "company_id", "left").join(u, "company_id", "left").join(n, "company_id", "left").join(p, "company_id", "left")
    out = out.withColumn("tags", F.transform("t", lambda x: x["v"])).withColumn("uncertain_tags", F.transform("u", lambda x: x["v"])).drop("t", "u")
    return out.select("company_id", shard_for(F.col("company_id"), shards).alias("shard"), F.to_json(F.struct(*out.columns)).alias("record"))


def tag_rows(tags: DataFrame, companies: DataFrame, features: DataFrame, most: int = 8) -> DataFrame:
    """Every active tag as published: prevalence, support, counts by year, what it occurs with, aliases."""
    here = features.join(companies.select("company_id").distinct(), "company_id", "left_semi")
    counts = Q.prevalence(here)
    years = P.counts_by_year(here.join(companies.where("batch_year IS NOT NULL").select("company_id", "batch_year"), "company_id"), "tag_id", "batch_year").withColumnRenamed("label", "tag_id")
    with_ = P.cooccurring(here, "company_id", "tag_id", most).groupBy(F.col("label").alias("tag_id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", F.struct(F.col("other").alias("tag_id"), F.col("n").alias("count")).alias("v")))), lambda x: x["v"]).alias("cooccurring"))
    out = tags.where("state = 'active'").drop("cooccurring", "by_year", "prevalence").join(counts, "tag_id", "left").join(years, "tag_id", "left").join(with_, "tag_id", "left")
    return out.select(
        "tag_id", F.col("canonical_name").alias("name"), "facet", "definition", F.slice("aliases", 1, 8).alias("aliases"), F.coalesce("prevalence", F.lit(0).cast("long")).alias("prevalence"), F.col("support_count").alias("support"),
        F.coalesce("cooccurring", F.array().cast("array<struct<tag_id: string, count: bigint>>")).alias("cooccurring"), "by_year",
    ).orderBy(F.desc("prevalence"), F.desc("support"), "tag_id")


def used_taxonomy(entity_terms: DataFrame, terms: DataFrame, mappings: DataFrame, tags: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(terms in use by id, their mappings to existing tags by term and falling similarity). ``entity_terms``: entity, term_id."""
    used = entity_terms.select("term_id").distinct()
    t = terms.join(used, "term_id", "left_semi").select("term_id", "kind", "name", F.col("parent_term_id").alias("parent"), F.col("company_count").alias("count"))
    t = t.groupBy("term_id").agg(F.min(F.struct("kind", "name", "parent", "count")).alias("s")).select("term_id", "s.*").orderBy("term_id")
    m = mappings.join(used, "term_id", "left_semi").join(tags.select("tag_id").distinct(), "tag_id", "left_semi")
    m = m.select("mapping_id", "term_id", "tag_id", "relation", F.round("similarity", 4).alias("similarity"), "reviewed").distinct()
    return t, m.orderBy("term_id", F.desc("similarity"), "tag_id", "mapping_id")


def source_metadata(raw: DataFrame) -> dict[str, Any]:
    """Where and when the raw rows come from: their first row's."""
    row = raw.select("source_url", "retrieved_at", "source_last_updated").limit(1).collect()
    return {k: str(v) for k, v in row[0].asDict().items()} if row else {}


def write_release(spark: SparkSession, root: str, version: str, artifacts: dict[str, DataFrame], provenance: dict[str, Any], shards: int = 64) -> dict[str, int]:
    """Writes a release below ``root`` and makes it the current one; returns its counts.

    ``artifacts``: the tables of ``ARTIFACTS`` (``detail``: company_id, shard, record).
    """
    from pyspark.sql import Observation

    from weftline.sources.files import release_checksums, write_details, write_document

    folder, counts = f"{root}/{version}", {}
    for name in ARTIFACTS:
        seen = Observation()
        df = artifacts[name].observe(seen, F.count(F.lit(1)).alias("n"))
        if name == "detail":
            write_details(df, f"{folder}/detail", shards)
        elif df.columns == ["value"]:  # lines of JSON already
            df.write.mode("overwrite").text(f"{folder}/{name}")
        else:
            df.write.mode("overwrite").option("ignoreNullFields", "true").json(f"{folder}/{name}")
        counts[name] = int(seen.get["n"])
    sums = release_checksums(spark, folder)
    manifest = {"dataset_version": version, "generated_at": datetime.now(UTC).isoformat(), "detail_shards": shards, "counts": counts, "checksums": sums, "files": sorted(sums), "key_map": P.COMPANY_KEYS} | provenance
    write_document(spark, f"{folder}/manifest.json", manifest)
    write_document(spark, f"{root}/index.json", {"current": version, "generated_at": manifest["generated_at"]})
    return counts


def current_release(spark: SparkSession, root: str) -> str:
    """The folder of the current release."""
    from weftline.sources.files import read_document

    return f"{root}/{read_document(spark, f'{root}/index.json')['current']}"


def read_artifact(spark: SparkSession, folder: str, name: str) -> DataFrame:
    if name == "detail":
        return spark.read.parquet(f"{folder}/detail").where("company_id IS NOT NULL")
    if name == "companies":  # short keys that differ by case alone: read by path
        row = lambda k, kind: F.from_json(F.get_json_object("value", f"$.{k}"), kind)
        return spark.read.text(f"{folder}/companies").select(F.get_json_object("value", "$.i").alias("company_id"), row("T", "array<string>").alias("tag_ids"), row("S", "array<double>").alias("tag_scores"))
    return spark.read.json(f"{folder}/{name}")


def published_gates(spark: SparkSession, root: str) -> DataFrame:
    """The gates of a written release, read back from its files; a file that is absent or broken fails its gates."""
    from weftline.sources.files import read_document

    def files() -> tuple[str, dict]:
        folder = current_release(spark, root)
        return folder, read_document(spark, f"{folder}/manifest.json")

    def on(name: str) -> DataFrame:
        return read_artifact(spark, files()[0], name)

    def ids(name: str, column: str) -> DataFrame:
        return on(name).select(F.col(column).alias("company_id"))

    def neighbors() -> DataFrame:
        kind = "struct<company_id: string, neighbors: map<string, array<struct<id: string>>>>"
        r = on("detail").select(F.from_json("record", kind).alias("r")).select("r.company_id", F.explode("r.neighbors").alias("space", "e"))
        return r.select("company_id", F.explode("e").alias("e")).select("company_id", F.col("e.id").alias("neighbor"))

    def referenced() -> DataFrame:
        return on("companies").select(F.explode("tag_ids").alias("tag_id")).distinct()

    def misplaced() -> DataFrame:
        d = on("detail")
        return Q.different_keys(ids("companies", "company_id"), d.select("company_id"), "company_id").unionByName(Q.wrong_shards(d, files()[1]["detail_shards"]).select("company_id"))

    def one(bad: list[str]) -> DataFrame:
        return spark.createDataFrame([(x,) for x in bad], "s string")

    key = F.col("company_id")
    checks: dict[str, Callable[[], DataFrame]] = {
        "manifest_parses": lambda: Q.gate("manifest_parses", one([] if files()[1] else ["empty"]), F.col("s")),
        "files_match_checksums": lambda: Q.gate("files_match_checksums", Q.checksum_violations(spark, files()[0], files()[1]["checksums"]), F.col("path")),
        "points_are_companies": lambda: Q.gate("points_are_companies", Q.different_keys(ids("points", "company_id"), ids("companies", "company_id"), "company_id"), key),
        "points_finite": lambda: Q.gate("points_finite", on("points").where("x IS NULL OR y IS NULL OR isnan(x) OR isnan(y) OR cluster IS NULL"), key),
        "tags_published": lambda: Q.gate("tags_published", Q.dangling(referenced(), ["tag_id"], on("tags"), ["tag_id"]), F.col("tag_id")),
        "scores_parallel": lambda: Q.gate("scores_parallel", Q.unparallel(on("companies"), ["tag_ids", "tag_scores"]), key),
        "details_in_their_shards": lambda: Q.gate("details_in_their_shards", misplaced(), key),
        "neighbors_published": lambda: Q.gate("neighbors_published", Q.dangling(neighbors(), ["neighbor"], ids("companies", "company_id"), ["company_id"]), F.concat_ws("->", "company_id", "neighbor")),
        "search_covers_companies": lambda: Q.gate("search_covers_companies", Q.different_keys(ids("search", "i"), ids("companies", "company_id"), "company_id"), key),
        "provenance": lambda: Q.gate("provenance", one([k for k in PROVENANCE if not files()[1].get(k)]), F.col("s")),
    }
    return Q.run_gates(spark, checks)


def index_rows(companies: DataFrame) -> DataFrame:
    """The compact index under its short keys, as published: one line of JSON a company (``value``)."""
    return P.index_json(P.compact_index(companies)).select(F.col("row").alias("value"))


def point_rows(points: DataFrame, companies: DataFrame) -> DataFrame:
    """position, company_id, x, y (three places), cluster, year: parallel columns in the order of ids."""
    p = points.join(companies.select("company_id", "batch_year").dropDuplicates(["company_id"]), "company_id")
    p = p.select("company_id", F.round("x", 3).alias("x"), F.round("y", 3).alias("y"), F.col("cluster").cast("int").alias("cluster"), F.coalesce("batch_year", F.lit(0)).alias("year"))
    return row_numbers(p, ["company_id"], "position")

