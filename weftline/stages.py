"""The stages of a whole run, each from source tables and earlier stages' tables in a warehouse folder to tables of its own.

A stage names what it reads and writes; :mod:`weftline.pipeline` runs it when that has changed. Every
run of a stage is appended to the run log.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline import __version__
from weftline.config import Config
from weftline.functions import vectors as V
from weftline.functions.prompts import discovery_prompts, prompt_hashes
from weftline.functions.text import tag_document
from weftline.operators import judging, lifecycle, normalize, ontology, projection, publish, quality, release, search, shortlist, spaces
from weftline.operators.neighbors import dense_neighbors
from weftline.pipeline import Store, run_stage
from weftline.plans.judging import DETAIL, ORDER
from weftline.runtime import materialize, rows_of
from weftline.sources.files import append, exists, export_bundle, write_matrix
from weftline.sources.models import Backend, Deterministic, embed_texts, generate, request_key
from weftline.sources.tables import table

CANDIDATE = "array<struct<name: string, facet: string, definition: string, supporting_company_ids: array<string>>>"
#: What a release says of itself besides its versions.
LIMITATIONS = ["Projections are lossy: distance on the map is not similarity.", "Tags are inferred; a missing tag is not a no.", "Clusters are groupings of the map, not categories of the source."]


@dataclass
class Run:
    """Where a run reads and writes, and what with."""

    spark: SparkSession
    data: str
    out: str
    config: Config
    backend: Backend

    def source(self, name: str) -> DataFrame:
        return table(self.spark, self.data, name)

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.out}/{name}.parquet")

    def write(self, **tables: DataFrame) -> dict[str, int]:
        return export_bundle(tables, self.out, csv=False)


def fetch(r: Run) -> dict[str, int]:
    """The newest state of every company, normalised; records that are none; source terms."""
    raw = r.source("companies_raw")
    good, bad = normalize.parse_payloads(raw)
    good = judging.last_wins(good.where("company_id IS NOT NULL"), ["company_id"], ["retrieved_at", "content_hash"], ["p"])
    companies = materialize(normalize.normalize_companies(good), "companies")
    one = lambda n: F.array(F.col(n))
    derived = normalize.taxonomy_counts(companies, {"subindustry": one("subindustry"), "stage": one("stage"), "status": one("status"), "region": F.col("regions"), "industry": one("industry"), "batch": one("batch")})
    derived = derived.select(F.concat("kind", F.lit(":"), "slug").alias("term_id"), "kind", "name", F.lit(None).cast("string").alias("parent_term_id"), F.col("company_count").cast("int").alias("company_count"), F.lit(None).cast("string").alias("source_path"))
    listed = r.source("source_taxonomy_terms").select(*derived.columns)
    return r.write(companies=companies, rejected=bad, terms=normalize.merge_terms(listed, derived))


def discover(r: Run) -> dict[str, int]:
    """Candidates proposed by the model for diverse batches of companies."""
    c = materialize(r.read("companies").select("company_id", "name", "one_liner", "long_description", "industry", "source_tags", "batch_year"), "discover")
    order = [F.coalesce("industry", F.lit("zz")), F.coalesce("batch_year", F.lit(0)), F.col("company_id")]
    batches = ontology.diverse_batches(c, rows_of(c), 28, order)
    prompts = materialize(discovery_prompts(batches).withColumn("key", request_key(F.col("prompt"), r.backend)), "prompts")
    answers = generate(prompts.select("prompt"), None, r.backend, CANDIDATE)
    shown = batches.groupBy("batch").agg(F.collect_list("company_id").alias("batch_company_ids"))  # a batch is of bounded size
    told = prompts.join(answers.where("valid").select("key", F.explode("answer").alias("a")), "key").join(shown, "batch").select("a.*", "batch_company_ids")
    facets = sorted(x[0] for x in r.source("tags").select("facet").where("facet IS NOT NULL").distinct().collect())  # the ontology's facets
    return r.write(candidates=lifecycle.accumulate_candidates(lifecycle.validated_candidates(told, facets)))


def review(r: Run) -> dict[str, int]:
    """The ontology after new candidates, merge proposals, adjudication, merges and activation."""
    tags = r.source("tags").select("tag_id", "canonical_name", "definition", "facet", "aliases", "state", "merged_into", F.col("support_count").cast("int").alias("support_count")).dropDuplicates(["tag_id"])
    tags = tags.withColumns({"source_company_ids": F.array().cast("array<string>"), "positive_examples": F.array().cast("array<string>")})
    found = r.read("candidates").select(F.col("proposed_name").alias("name"), "facet", "definition", F.col("support_company_ids").alias("ids"), F.col("support_count").cast("int").alias("n"), "candidate_id")
    index = ontology.name_index(tags)
    from weftline.functions.text import normalize_name

    new = found.withColumn("key", normalize_name(F.col("name"))).join(index.select("key"), "key", "left_anti")
    new = ontology.mint_ids(new, "name", "facet", ["candidate_id"], tags.select(F.col("tag_id").alias("id")))
    new = new.select(F.col("minted_id").alias("tag_id"), F.col("name").alias("canonical_name"), "definition", "facet", F.array().cast("array<string>").alias("aliases"), F.lit("candidate").alias("state"), F.lit(None).cast("string").alias("merged_into"), F.col("n").alias("support_count"), F.col("ids").alias("source_company_ids"), F.array().cast("array<string>").alias("positive_examples"))
    tags = materialize(tags.unionByName(new), "ontology")
    live = tags.where("state IN ('active', 'candidate')").withColumn("text", tag_document(F.col("canonical_name"), F.col("facet"), F.col("definition"))).withColumn("key", request_key(F.col("text"), r.backend))
    vectors = embed_texts(live.select("text"), None, r.backend).select("key", V.l2_normalize(F.col("vector")).alias("v"))
    rows = live.join(vectors, "key").select(F.col("tag_id").alias("id"), F.col("canonical_name").alias("name"), "facet", F.col("support_count").alias("support"), "v", "definition")
    rows = materialize(rows, "tag-vectors")
    pairs = ontology.merge_candidates(rows.drop("definition"), r.config.auto_merge, r.config.review_merge)
    judged = materialize(ontology.adjudicate(pairs, rows, r.backend, r.config.max_adjudications), "adjudicated")
    proposals = judged.select(F.concat_ws("->", "source_id", "target_id").alias("proposal_id"), F.col("source_id").alias("source_tag_id"), F.col("target_id").alias("target_tag_id"), "similarity", "verdict", "adjudication", "rationale", F.lit(False).alias("applied"))
    order = [F.asc(F.col("verdict") != "auto_merge"), F.desc("similarity"), F.asc("proposal_id")]
    after, told = ontology.apply_merges(tags, proposals, order)
    after = after.withColumn("state", ontology.activation(F.col("state"), F.col("support_count"), F.col("definition"), r.config.min_support))
    return r.write(tags=after, merge_proposals=told)


def map_taxonomy(r: Run) -> dict[str, int]:
    """The nearest active tags of every source term."""
    terms = r.read("terms").select("term_id", "kind", F.col("name").alias("term_name")).where("term_name IS NOT NULL")
    tags = r.read("tags").where("state = 'active'").select("tag_id", F.col("canonical_name").alias("tag_name"))
    keyed = lambda df, c: df.withColumn("key", request_key(F.col(c), r.backend))
    terms, tags = materialize(keyed(terms, "term_name"), "terms"), materialize(keyed(tags, "tag_name"), "tags")
    texts = terms.select(F.col("term_name").alias("text")).union(tags.select("tag_name"))
    v = materialize(embed_texts(texts, None, r.backend).select("key", V.l2_normalize(F.col("vector")).alias("v")).where(~V.is_zero(F.col("v"))), "term-vectors")
    near = dense_neighbors(terms.join(v, "key").select(F.col("term_id").alias("id"), "v"), tags.join(v, "key").select(F.col("tag_id").alias("id"), "v"), 3, exclude_self=False)
    sims = near.select(F.col("id").alias("term_id"), F.col("neighbor_id").alias("tag_id"), "similarity").join(terms.select("term_id", "kind", "term_name"), "term_id").join(tags.select("tag_id", "tag_name"), "tag_id")
    m = shortlist.term_mapping(sims)
    return r.write(mappings=m.select(F.left(F.sha2(F.concat_ws("|", "term_id", "tag_id"), 256), F.lit(16)).alias("mapping_id"), "term_id", "tag_id", "relation", "similarity", F.lit("embedding").alias("method"), F.lit(False).alias("reviewed")))


def assign(r: Run) -> dict[str, int]:
    """The judgment log consolidated, and its information-weighted features."""
    last = materialize(judging.last_wins(r.source("company_tag_judgments"), ["company_id", "tag_id"], ORDER, DETAIL), "judgments")
    return r.write(judgments=last, features=judging.sparse_features(last, last.select("company_id").distinct().count(), minimum=r.config.min_confidence))


def embed(r: Run) -> dict[str, int]:
    """Vectors of all spaces, and the neighbours in each."""
    companies = r.read("companies")
    features = r.read("features").join(companies.select("company_id"), "company_id", "left_semi")
    vectors = materialize(spaces.embedded(spaces.space_documents(companies, features, r.read("tags")), r.backend), "vectors")
    spaces.write_spaces(vectors, f"{r.out}/embeddings.parquet")
    return {"embeddings": rows_of(vectors)} | r.write(neighbors=spaces.all_neighbors(vectors, features, r.config.neighbors))


def project(r: Run) -> dict[str, int]:
    """The map: a layout of the combined vectors, aligned to the former one, clusters and their labels."""
    v = r.spark.read.parquet(f"{r.out}/embeddings.parquet").where("kind = 'combined'").select(F.col("company_id").alias("id"), F.col("vector").alias("v"))
    c = r.config
    flat = projection.rescale(projection.project(v, c.layout_neighbors, c.min_dist, c.seed))
    if exists(r.spark, f"{r.out}/points.parquet"):  # the former map
        flat = projection.align(flat, materialize(r.read("points").select(F.col("company_id").alias("id"), "x", "y"), "former"))
    points = materialize(projection.clusters(flat, c.clusters, c.seed), "points")
    return r.write(points=points.withColumnRenamed("id", "company_id"), clusters=cluster_rows(points, r.read("companies"), r.read("features"), r.read("tags")))


def cluster_rows(points: DataFrame, companies: DataFrame, features: DataFrame, tags: DataFrame) -> DataFrame:
    """cluster, size, centre, label and where it comes from, the tags and source terms that tell it apart. ``points``: id, x, y, cluster."""
    members = points.select("id", "cluster")
    named = features.join(tags.select("tag_id", "canonical_name"), "tag_id").select(F.col("company_id").alias("id"), F.col("canonical_name").alias("term"))
    named = named.join(members.select("id"), "id", "left_semi")
    terms = companies.select(F.col("company_id").alias("id"), F.explode(F.array_compact(F.array("industry", "subindustry"))).alias("term")).join(members.select("id"), "id", "left_semi")
    by_tag, by_term = (materialize(publish.lift_labels(members, x), "lift") for x in (named, terms))
    best = lambda df, c: df.groupBy("cluster").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "term"))), lambda x: x["term"]).alias(c))
    return projection.cluster_summary(points).join(publish.cluster_labels(members, by_tag, by_term), "cluster").join(best(by_tag, "top_tags"), "cluster", "left").join(best(by_term, "top_source_terms"), "cluster", "left")


def artifacts(companies: DataFrame, tags: DataFrame, features: DataFrame, judged: DataFrame, neighbors: DataFrame, points: DataFrame, clusters: DataFrame, terms: DataFrame, mappings: DataFrame, entity_terms: DataFrame, report: DataFrame, config: Config) -> dict[str, DataFrame]:
    """The tables of a release. ``companies`` carry tag_ids and tag_scores; ``points``: company_id, x, y, cluster."""
    companies = materialize(release.published(companies, points), "published")
    features = materialize(features.join(companies.select("company_id"), "company_id", "left_semi").join(tags.where("state = 'active'").select("tag_id"), "tag_id", "left_semi"), "published-features")
    judged = judged.join(companies.select("company_id"), "company_id", "left_semi")
    near = materialize(release.published_neighbors(neighbors, companies, config.published_neighbors), "published-neighbors")
    facts = companies.select(F.col("company_id").alias("id"), publish.metadata_facts().alias("facts"))
    here = points.join(companies.select("company_id"), "company_id", "left_semi")
    detail = release.detail_records(companies.drop("tag_ids", "tag_scores"), release.detail_tags(features, judged, tags), release.detail_uncertain(judged, tags), release.explained_neighbors(near, features, tags, facts), here, config.shards)
    used, maps = release.used_taxonomy(entity_terms.join(companies.select(F.col("company_id").alias("entity")), "entity", "left_semi"), terms, mappings, tags)
    return {
        "points": release.point_rows(here, companies), "companies": release.index_rows(companies), "tags": release.tag_rows(tags, companies, features), "taxonomy_terms": used, "taxonomy_mappings": maps,
        "clusters": clusters, "search": publish.search_documents(companies, tags), "detail": detail, "quality": report,
    }


def tagged(companies: DataFrame, features: DataFrame, tags: DataFrame) -> DataFrame:
    """Companies with the parallel tag_ids and tag_scores of their features of active tags."""
    per = features.join(tags.where("state = 'active'").select("tag_id"), "tag_id", "left_semi").groupBy("company_id").agg(F.array_sort(F.collect_list(F.struct("tag_id", "feature_value"))).alias("t"))
    out = companies.drop("tag_ids", "tag_scores").join(per, "company_id", "left")
    return out.withColumns({"tag_ids": F.coalesce(F.col("t.tag_id"), F.array().cast("array<string>")), "tag_scores": F.coalesce(F.col("t.feature_value"), F.array().cast("array<double>"))}).drop("t")


def publish_data(r: Run) -> dict[str, int]:
    """The release, made current at the end, and the exports."""
    companies, tags, features, judged, points = (r.read(n) for n in ("companies", "tags", "features", "judgments", "points"))
    report = materialize(quality.quality_report(judged.select("company_id").distinct().count(), tags, features, judged), "quality")
    entity_terms = companies.select(F.col("company_id").alias("entity"), F.explode("source_taxonomy_term_ids").alias("term_id"))
    tables = artifacts(tagged(companies, features, tags), tags, features, judged, r.read("neighbors"), points, r.read("clusters"), r.read("terms"), r.read("mappings"), entity_terms, report, r.config)
    source = release.source_metadata(r.source("companies_raw"))
    version = datetime.now(UTC).strftime("%Y%m%d%H%M%S") + "-" + uuid.uuid4().hex[:8]
    provenance = {"schema_version": "1", "pipeline_version": __version__, "source_url": source.get("source_url"), "source": source, "models": {"embedding": r.backend.name, "chat": r.backend.name}, "prompt_hashes": prompt_hashes(), "limitations": LIMITATIONS, "config": asdict(r.config)}
    counts = release.write_release(r.spark, f"{r.out}/public", version, tables, provenance, r.config.shards)
    exports = {"companies": companies, "tags": tags, "source_taxonomy": r.read("terms"), "source_taxonomy_tag_mappings": r.read("mappings"), "company_tags": features, "company_tag_judgments": judged, "company_neighbors": r.read("neighbors"), "umap_points": points}
    counts |= {f"export_{k}": v for k, v in export_bundle(exports, f"{r.out}/exports").items()}
    coo, ptr = publish.csr_matrix(features, companies.select("company_id"), tags.where("state = 'active'").select("tag_id"), "company_id", "tag_id", "feature_value")
    return counts | {"matrix_nnz": write_matrix(coo, ptr, f"{r.out}/exports/company_tag_matrix")}


def migrate(r: Run) -> dict[str, int]:
    """The registered migrations over the ontology; the changes are kept beside it."""
    before = materialize(r.read("tags"), "before")
    after, changes = before, None
    for name in lifecycle.MIGRATIONS:
        after, one = lifecycle.migrate(after, name)
        one = one.withColumn("migration", F.lit(name))
        changes = one if changes is None else changes.unionByName(one)
    return r.write(tags=materialize(after, "after"), ontology_changes=materialize(changes, "changes"))


@dataclass(frozen=True)
class Stage:
    """Work, tables of the warehouse and of the source that it reads, tables that it writes."""

    work: Callable[[Run], dict[str, int]]
    inputs: tuple[str, ...]
    sources: tuple[str, ...]
    outputs: tuple[str, ...]


STAGES: dict[str, Stage] = {
    "fetch": Stage(fetch, (), ("companies_raw", "source_taxonomy_terms"), ("companies", "rejected", "terms")),
    "discover-tags": Stage(discover, ("companies",), ("tags",), ("candidates",)),
    "review-tags": Stage(review, ("candidates",), ("tags",), ("tags", "merge_proposals")),
    "map-taxonomy": Stage(map_taxonomy, ("terms", "tags"), (), ("mappings",)),
    "assign-features": Stage(assign, (), ("company_tag_judgments",), ("judgments", "features")),
    "embed": Stage(embed, ("companies", "features", "tags"), (), ("embeddings", "neighbors")),
    "project": Stage(project, ("embeddings", "companies", "features", "tags"), (), ("points", "clusters")),
    "publish-data": Stage(publish_data, ("companies", "tags", "features", "judgments", "neighbors", "points", "clusters", "terms", "mappings"), ("companies_raw",), ()),
}


def log_run(r: Run, stage: str, started: datetime, counts: dict[str, int], error: str | None) -> None:
    """One row of the run log."""
    row = (uuid.uuid4().hex, stage, started, datetime.now(UTC), "failed" if error else "done", r.config.profile, __version__, r.config.fingerprint(), {"embedding": r.backend.name}, prompt_hashes(), {k: int(v) for k, v in counts.items()}, error)
    ddl = "run_id string, stage string, started_at timestamp, finished_at timestamp, status string, profile string, pipeline_version string, config_fingerprint string, models map<string, string>, prompt_hashes map<string, string>, counts map<string, bigint>, error string"
    append(r.spark.createDataFrame([row], ddl), f"{r.out}/runs.parquet")


def run(r: Run, name: str, force: bool = False, on_done: Callable[[str, dict[str, int]], None] | None = None) -> bool:
    """Runs a stage unless it is fresh, and logs it; True if it ran. ``on_done`` is called with its name and counts once it is recorded."""
    stage, store, started = STAGES[name], Store(r.spark, r.out), datetime.now(UTC)
    made: dict[str, int] = {}

    def work() -> dict[str, int]:
        made.update(stage.work(r))
        return made

    settings = {"data": r.data, "config": r.config.fingerprint(), "model": [r.backend.name, r.backend.digest], "prompts": prompt_hashes()}
    try:
        ran = run_stage(store, name, settings, [f"{i}.parquet" for i in stage.inputs], [f"{o}.parquet" for o in stage.outputs], work, force, [(r.data, t) for t in stage.sources])
    except Exception as e:
        log_run(r, name, started, made, f"{type(e).__name__}: {str(e)[:500]}")
        raise
    if ran:
        log_run(r, name, started, made, None)
        if on_done is not None:
            on_done(name, dict(made))
    return ran


def search_index(r: Run) -> search.SearchIndex:
    """The index over the current release's search documents."""
    docs = release.read_artifact(r.spark, release.current_release(r.spark, f"{r.out}/public"), "search")
    return search.build_index(docs, "i", ("n", "a", "o", "e", "g", "x", "d", "b"))


def default_backend() -> Backend:
    return Deterministic(64)
