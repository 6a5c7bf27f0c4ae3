"""Queries over what is published: details, tags, a whole written release and its gates, the pickers and look-ups on it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline import stages
from weftline.config import load_config
from weftline.functions import hashing as H
from weftline.functions import prompts as PR
from weftline.functions import text as T
from weftline.operators import filters as L
from weftline.operators import judging as J
from weftline.operators import normalize as N
from weftline.operators import projection as M
from weftline.operators import publish as P
from weftline.operators import quality as Q
from weftline.operators import release as E
from weftline.operators import spaces as SP
from weftline.plans import directory as D
from weftline.plans.judging import _FEATURES, DETAIL, consolidated, sparse_features
from weftline.plans.vectors import KNN_SPARSE_SQL, knn_sparse_jaccard
from weftline.runtime import delete, materialize, shared_dir
from weftline.sources import files
from weftline.sources.models import Deterministic
from weftline.sources.tables import table


def _judged(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The newest judgments with their reasons, and the features of them."""
    last = consolidated(spark, d, DETAIL)
    return last, J.sparse_features(last, last.select("company_id").distinct().count())


def detail_tags(spark: SparkSession, d: str) -> DataFrame:
    """A company's tags with values, reasons and the number of quotes."""
    last, features = _judged(spark, d)
    rows = E.detail_tags(features, last, table(spark, d, "tags"))
    return rows.withColumn("quotes", F.size("evidence").cast("bigint")).drop("evidence")


def detail_uncertain(spark: SparkSession, d: str) -> DataFrame:
    last = consolidated(spark, d, DETAIL)
    return E.detail_uncertain(last, table(spark, d, "tags")).withColumn("place", F.col("place").cast("bigint"))


def _edges(spark: SparkSession, d: str) -> DataFrame:
    """Sparse neighbours, and the nearest four of them once more as those of the combined space."""
    e = materialize(knn_sparse_jaccard(spark, d).select(F.col("entity").alias("company_id"), F.col("neighbor").alias("neighbor_company_id"), F.lit("sparse_tags").alias("space"), "rank", "similarity"), "edges")
    return e.unionByName(e.where("rank < 4").withColumn("space", F.lit("combined")))


def detail_neighbors(spark: SparkSession, d: str) -> DataFrame:
    """The first six published neighbours of every space with the shared tags and rare facts that explain them; companies hiring are published."""
    c = D.companies(spark, d)
    kept = E.published_neighbors(_edges(spark, d), c.where("is_hiring"), 6)
    features = c.select("company_id", F.explode(F.array_distinct("tag_ids")).alias("tag_id")).where("tag_id IS NOT NULL")
    facts = c.select(F.col("company_id").alias("id"), P.metadata_facts().alias("facts"))
    out = E.explained_neighbors(kept, features, table(spark, d, "tags"), facts)
    return out.select("company_id", "space", F.col("place").cast("bigint").alias("place"), "neighbor_company_id", "score", F.array_join("shared_tags", "|").alias("shared_tags"), F.array_join("shared_metadata", "|").alias("shared_metadata"))


def neighbor_companies(spark: SparkSession, d: str) -> DataFrame:
    """Name and batch of every neighbour (null where it is not published)."""
    c = D.companies(spark, d).where("is_hiring").select(F.col("company_id").alias("neighbor_company_id"), "name", "batch")
    return _edges(spark, d).where("space = 'combined'").join(c, "neighbor_company_id", "left").select("company_id", "neighbor_company_id", F.col("rank").cast("bigint").alias("rank"), "name", "batch")


def tags_artifact(spark: SparkSession, d: str) -> DataFrame:
    """Every active tag as published."""
    t = E.tag_rows(table(spark, d, "tags"), D.companies(spark, d), sparse_features(spark, d))
    pairs = F.transform(F.array_sort(F.map_entries("by_year")), lambda e: F.concat(e["key"].cast("string"), F.lit(":"), e["value"].cast("string")))
    return t.select(
        "tag_id", "name", "facet", F.size("aliases").cast("bigint").alias("aliases"), "prevalence", F.col("support").cast("bigint").alias("support"),
        F.array_join(F.transform("cooccurring", lambda x: F.concat(x["tag_id"], F.lit(":"), x["count"].cast("string"))), ",").alias("cooccurring"), F.coalesce(F.array_join(pairs, ","), F.lit("")).alias("by_year"),
    )


def tag_documents(spark: SparkSession, d: str) -> DataFrame:
    """The texts by which companies are embedded in the tag space."""
    return SP.tag_documents(sparse_features(spark, d), table(spark, d, "tags")).select("company_id", F.md5("text").alias("digest"))


def tag_terms(spark: SparkSession, d: str) -> DataFrame:
    """The six source terms most similar to each tag."""
    from pyspark.sql import Window

    m = table(spark, d, "source_taxonomy_tag_mappings").where("term_id IS NOT NULL").select("tag_id", "term_id", "similarity").groupBy("tag_id", "term_id").agg(F.max("similarity").alias("similarity"))
    w = Window.partitionBy("tag_id").orderBy(F.desc("similarity"), "term_id")
    return m.withColumn("place", F.row_number().over(w).cast("bigint")).where("place <= 6")


def point_positions(spark: SparkSession, d: str) -> DataFrame:
    """Where every company stands among the points of those that hire, -1 elsewhere."""
    c = D.companies(spark, d)
    return L.point_index(c, c.where("is_hiring")).select("company_id", "position")


def tag_groups(spark: SparkSession, d: str) -> DataFrame:
    """A company's tags by facet, the largest groups first."""
    rows = D.companies(spark, d).select("company_id", F.explode("tag_ids").alias("tag_id")).join(table(spark, d, "tags").select("tag_id", "facet"), "tag_id")
    return L.facet_groups(rows).select("company_id", "facet", F.array_join("tags", ",").alias("tags"), "size", "place")


def legends(spark: SparkSession, d: str) -> DataFrame:
    """Companies by cluster (the label of shards) and with or without a tag."""
    c = D.companies(spark, d)
    return L.tag_legend(c, "escrow-storage").unionByName(L.cluster_legend(c.select((H.shard_for(F.col("company_id")) % 8).alias("cluster"))))


def picker(spark: SparkSession, d: str) -> DataFrame:
    """The tag picker: chosen tags first, then those that match."""
    return L.pinned_first(table(spark, d, "tags").where("state = 'active'"), ["escrow-storage", "grid-sampling"], "cal").select("tag_id")


def filter_full(spark: SparkSession, d: str) -> DataFrame:
    """A filter that came as a URL, with batches, years, stages, flags, ids and a text of its own."""
    wanted = D.companies(spark, d).where("team_size > 5").orderBy("company_id").limit(300)
    spec = L.FilterSpec.from_query(L.FilterSpec(batches=["Winter 2025", "Summer 2019", "Fall 2014", "Winter 2012"], year_from=2010, year_to=2030, stages=["Early", "", "Growth"], nonprofit=False, tag_mode="or").to_query() + "&min_score=oops&year_to=2030")
    return L.select_companies(L.apply_filters(D.companies(spark, d), spec), wanted).select("company_id")


def round_trip(spark: SparkSession, d: str) -> DataFrame:
    """The compact index written as JSON under its short keys, read back and expanded again."""
    c = P.index_json(P.compact_index(D.companies(spark, d)))
    kinds = {"regions": "ARRAY<STRING>", "source_tags": "ARRAY<STRING>", "tag_ids": "ARRAY<STRING>", "tag_scores": "ARRAY<DOUBLE>", "batch_year": "INT", "team_size": "INT", "top_company": "INT", "is_hiring": "INT", "nonprofit": "INT"}
    ddl = ", ".join(f"{k} {kinds.get(v, 'STRING')}" for k, v in P.COMPANY_KEYS.items() if k not in "lcm")
    wide = P.expand_index(_by_path(c, ddl))
    return wide.select("company_id", "name", "one_liner", "status", F.col("team_size").cast("bigint").alias("team_size"), "top_company", "is_hiring", F.size("tag_ids").cast("bigint").alias("tags"), F.size("regions").cast("bigint").alias("regions"))


def _by_path(c: DataFrame, ddl: str) -> DataFrame:
    """The short keys' values, named by their place: S and s, T and t differ by case alone, and JSON paths tell them apart."""
    names = {k: v for k, v in P.COMPANY_KEYS.items()}
    value = lambda k, kind: F.from_json(F.get_json_object("row", f"$.{k}"), kind) if kind.startswith("ARRAY") else F.get_json_object("row", f"$.{k}").cast(kind.lower())
    return c.select(*(value(*x.split(" ", 1)).alias(names[x.split(" ", 1)[0]]) for x in ddl.split(", ")))


def exports(spark: SparkSession, d: str) -> DataFrame:
    """What the CSV, JSON lines and Parquet sinks hold of the tags, read back: rows and columns."""
    out = f"{shared_dir(spark)}/weftline/exports-{uuid.uuid4().hex}"
    tags = table(spark, d, "tags")
    files.export_bundle({"tags": tags}, out)
    files.write_jsonl(tags.select("tag_id", "definition", "support_count"), f"{out}/tags.jsonl", "tag_id")
    files.append(tags.select("tag_id"), f"{out}/log", "1")
    again = files.append(tags.select("tag_id"), f"{out}/log", "1")
    csv, parquet = spark.read.option("header", True).option("multiLine", True).csv(f"{out}/tags.csv"), spark.read.parquet(f"{out}/tags.parquet")
    lines = files.read_jsonl(spark, f"{out}/tags.jsonl", tags.select("tag_id", "definition", "support_count").schema)
    found = [("csv", csv.count(), len(csv.columns)), ("parquet", parquet.count(), len(parquet.columns)), ("jsonl", lines.count(), len(lines.columns)), ("log", spark.read.parquet(f"{out}/log").count() + again, 1)]
    delete(spark, out)
    return spark.createDataFrame(found, "sink string, n bigint, columns bigint")


def call_packs(spark: SparkSession, d: str) -> DataFrame:
    """Judged tags of a company packed into calls of at most eight, facets together: the size of each."""
    pairs = table(spark, d, "company_tag_judgments").where("company_id IS NOT NULL AND tag_id IS NOT NULL").select(F.col("company_id").alias("entity"), "tag_id").distinct().join(table(spark, d, "tags").select("tag_id", "facet"), "tag_id")
    return PR.call_groups(pairs).groupBy("entity", "call").agg(F.count(F.lit(1)).alias("n")).withColumn("call", F.col("call").cast("bigint"))


def conversions(spark: SparkSession, d: str) -> DataFrame:
    """Numbers, timestamps and texts of raw records made safe: the count of every outcome."""
    p = table(spark, d, "companies_raw").select(F.get_json_object("payload", "$.team_size").alias("team"), F.col("source_last_updated").alias("at"), F.get_json_object("payload", "$.one_liner").alias("t"))
    out = p.select(F.when(T.non_negative_int(F.col("team")).isNotNull(), "number").otherwise("none").alias("team"), F.when(T.parse_iso(F.substring("at", 1, 10)).isNotNull(), "time").otherwise("none").alias("at"), F.length(T.truncate(F.col("t"), 40)).cast("bigint").alias("length"))
    return out.groupBy("team", "at", "length").agg(F.count(F.lit(1)).alias("n"))


def evidence_sources(spark: SparkSession, d: str) -> DataFrame:
    """Quotes by the kind of document they cite, as shown."""
    e = table(spark, d, "company_tag_judgments").select(F.explode("evidence.document_id").alias("doc"))
    labels = {"yc_one_liner": "One-liner", "yc_long_description": "Description", "metadata_document": "Directory fields", "website_main_text": "Website"}
    return e.groupBy(T.evidence_source(F.col("doc"), labels).alias("source")).agg(F.count(F.lit(1)).alias("n"))


def wrapped_texts(spark: SparkSession, d: str) -> DataFrame:
    """Document texts fenced for a prompt."""
    return table(spark, d, "documents").select("doc_id", F.md5(T.wrap_untrusted(F.coalesce("text", F.lit("")), "document", 500)).alias("digest"))


def keep_last_success(spark: SparkSession, d: str) -> DataFrame:
    """Fetches of two days, the second with failures: a failed one gives way to the earlier success."""
    c = D.companies(spark, d).select("company_id", F.length("name").alias("n"))
    before = c.where("n % 3 > 0").select("company_id", F.lit(True).alias("ok"), F.lit("before").alias("text"))
    now = c.where("n % 2 = 0").select("company_id", (F.col("n") % 4 == 0).alias("ok"), F.lit("now").alias("text"))
    return N.keep_last_success(now, before, ["company_id"]).select("company_id", "ok", "text")


def orphan_tags(spark: SparkSession, d: str) -> DataFrame:
    """Active tags that no company has."""
    return Q.orphan_tags(table(spark, d, "tags"), sparse_features(spark, d)).select("tag_id")


def feature_gates(spark: SparkSession, d: str) -> DataFrame:
    """Features whose judgment lacks evidence or a rationale, and features of unknown companies or tags."""
    last, features = _judged(spark, d)
    key = F.concat_ws("/", "company_id", "tag_id")
    judged = features.join(last.select("company_id", "tag_id", "evidence", "rationale", F.lit(True).alias("there")), ["company_id", "tag_id"], "left")
    checks = {
        "feature_evidence": lambda: Q.gate("feature_evidence", judged.where("there IS NULL OR size(evidence) = 0 OR trim(coalesce(rationale, '')) = ''"), key),
        "feature_company": lambda: Q.gate("feature_company", Q.dangling(features, ["company_id"], table(spark, d, "companies_normalized"), ["company_id"]), key),
        "feature_tag": lambda: Q.gate("feature_tag", Q.dangling(features, ["tag_id"], table(spark, d, "tags"), ["tag_id"]), key),
        "feature_tag_active": lambda: Q.gate("feature_tag_active", Q.dangling(features, ["tag_id"], table(spark, d, "tags").where("state = 'active'"), ["tag_id"]), key),
        "feature_finite": lambda: Q.gate("feature_finite", Q.not_finite(features, ["raw_confidence", "feature_value", "information_weight"]), key),
    }
    return Q.run_gates(spark, checks).select("gate", "passed", "violations", F.array_join("samples", ",").alias("samples"))


def _release(spark: SparkSession, d: str) -> tuple[str, dict[str, int]]:
    """A whole release of the tables, written below the shared folder: its root and its counts."""
    c = D.companies(spark, d).withColumn("industries", F.array().cast("array<string>")).withColumn("all_locations", F.lit(None).cast("string")).withColumn("launched_at", F.lit(None).cast("timestamp"))
    c = materialize(c.withColumn("metadata_document", N.metadata_document()), "companies")
    last = materialize(consolidated(spark, d, DETAIL), "judgments")  # read by the features, the report and the details
    features = J.sparse_features(last, last.select("company_id").distinct().count())
    tags = table(spark, d, "tags").dropDuplicates(["tag_id"])
    features = materialize(features.join(c.select("company_id"), "company_id", "left_semi"), "features")
    vectors = materialize(SP.embedded(SP.space_documents(c, features, tags), Deterministic(16)), "vectors")
    near = SP.all_neighbors(vectors, features, 12)
    flat = M.rescale(M.linear_projection(vectors.where("kind = 'combined'").select(F.col("company_id").alias("id"), F.col("vector").alias("v"))))
    points = materialize(M.clusters(flat, 12), "points")
    report = Q.quality_report(last.select("company_id").distinct().count(), tags, features, last)
    tables = stages.artifacts(
        stages.tagged(c, features, tags), tags, features, last, near, points.withColumnRenamed("id", "company_id"), stages.cluster_rows(points, c, features, tags),
        table(spark, d, "source_taxonomy_terms"), table(spark, d, "source_taxonomy_tag_mappings"), D.company_terms(c), report, load_config({}, {}),
    )
    root = f"{shared_dir(spark)}/weftline/release-{uuid.uuid4().hex}"
    source = E.source_metadata(table(spark, d, "companies_raw"))
    counts = E.write_release(spark, root, "v1", tables, {"schema_version": "1", "source_url": source["source_url"], "models": {"embedding": "deterministic"}, "limitations": stages.LIMITATIONS})
    return root, counts


def published_gates(spark: SparkSession, d: str) -> DataFrame:
    """The gates of a release written from the tables and read back."""
    root, _ = _release(spark, d)
    out = E.published_gates(spark, root).select("gate", "passed", "violations")
    delete(spark, root)
    return out


def release_counts(spark: SparkSession, d: str) -> DataFrame:
    """How many rows each artifact of a written release has."""
    root, counts = _release(spark, d)
    delete(spark, root)
    return spark.createDataFrame(list(counts.items()), "artifact string, n bigint")


def release_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Details of a written release, each read back by its own shard: company, tags, neighbours."""
    root, _ = _release(spark, d)
    found = E.read_artifact(spark, f"{root}/v1", "detail")
    kind = "struct<company_id: string, name: string, tags: array<struct<tag_id: string>>, coordinates: struct<x: double>>"
    out = materialize(found.select("shard", F.from_json("record", kind).alias("r")).select("r.company_id", "r.name", F.col("shard").cast("bigint").alias("shard"), F.greatest(F.lit(0), F.size("r.tags")).cast("bigint").alias("tags"), F.col("r.coordinates.x").isNotNull().alias("placed")), "details")
    delete(spark, root)
    return out


FUNCTIONS = (
    detail_tags, detail_uncertain, detail_neighbors, neighbor_companies, tags_artifact, tag_documents, tag_terms, point_positions, tag_groups, legends, picker, filter_full, round_trip, exports, call_packs, conversions, evidence_sources,
    wrapped_texts, keep_last_success, orphan_tags, feature_gates, published_gates, release_counts, release_lookup,
)
QUERIES = {f.__name__: f for f in FUNCTIONS}

_PUB = "pub AS (SELECT company_id FROM co WHERE is_hiring)"
_NB = f"""WITH {D._CO}, ed AS ({KNN_SPARSE_SQL}), ek AS (SELECT entity AS company_id, neighbor, 'sparse_tags' AS space, rank, similarity FROM ed UNION ALL SELECT entity, neighbor, 'combined', rank, similarity FROM ed WHERE rank < 4)"""
_TG = "tg AS (SELECT DISTINCT tag_id, canonical_name, facet, definition, state FROM tags)"


def _gate(name: str, body: str) -> str:
    return f"SELECT '{name}' AS gate, count(*) = 0 AS passed, count(*) AS violations, coalesce((SELECT string_agg(s, ',' ORDER BY s) FROM (SELECT company_id || '/' || tag_id AS s FROM ({body}) ORDER BY s LIMIT 5)), '') AS samples FROM ({body})"


ORACLES = {
    "detail_tags": f"""WITH {_FEATURES}, {_TG}, y AS (SELECT * FROM last WHERE decision = 'yes')
      SELECT f.company_id, f.tag_id, canonical_name AS name, facet, round(round(calibrated_confidence * w, 6)::DECIMAL(18, 6), 4)::DOUBLE AS "value", round(calibrated_confidence::DECIMAL(18, 6), 3)::DOUBLE AS confidence, round(raw_confidence::DECIMAL(18, 9), 3)::DOUBLE AS raw_confidence, round(round(w, 6)::DECIMAL(18, 6), 3)::DOUBLE AS weight, rationale, shortlist_reason,
        coalesce(len(evidence), 0) AS quotes FROM features f JOIN tg USING (tag_id) LEFT JOIN y ON y.company_id = f.company_id AND y.tag_id = f.tag_id""",
    "detail_uncertain": f"""WITH {_FEATURES}, {_TG} SELECT company_id, tag_id, name, notes, place FROM (SELECT company_id, l.tag_id, canonical_name AS name, notes, row_number() OVER (PARTITION BY company_id ORDER BY l.tag_id) AS place
      FROM last l JOIN tg ON tg.tag_id = l.tag_id WHERE decision = 'uncertain') WHERE place <= 12""",
    "detail_neighbors": f"""{_NB}, {_PUB}, {_TG}, kp AS (SELECT * FROM (SELECT ek.*, row_number() OVER (PARTITION BY company_id, space ORDER BY rank, neighbor) AS place FROM ek WHERE company_id IN (SELECT company_id FROM pub) AND neighbor IN (SELECT company_id FROM pub)) WHERE place <= 6),
      ft AS (SELECT DISTINCT company_id, t FROM (SELECT company_id, unnest(tag_ids) AS t FROM co) WHERE t IS NOT NULL),
      st AS (SELECT k.company_id, k.neighbor, k.space, t.tag_id, canonical_name, row_number() OVER (PARTITION BY k.company_id, k.neighbor, k.space ORDER BY t.tag_id) AS rn FROM kp k JOIN ft a ON a.company_id = k.company_id JOIN ft b ON b.company_id = k.neighbor AND b.t = a.t JOIN tg t ON t.tag_id = a.t),
      ts AS (SELECT company_id, neighbor, space, string_agg(canonical_name, '|' ORDER BY rn) AS shared_tags FROM st WHERE rn <= 6 GROUP BY ALL),
      f AS (SELECT DISTINCT company_id, x FROM (SELECT company_id, unnest(list_concat([CASE WHEN batch <> '' THEN 'batch: ' || batch END, CASE WHEN industry <> '' THEN 'industry: ' || industry END, CASE WHEN subindustry <> '' THEN 'subindustry: ' || subindustry END,
        CASE WHEN status <> '' THEN 'status: ' || status END, CASE WHEN stage <> '' THEN 'stage: ' || stage END], list_transform(coalesce(regions, []), lambda r: 'region: ' || r), list_transform(coalesce(source_tags, []), lambda r: 'tag: ' || r))) AS x FROM co) WHERE x IS NOT NULL),
      df AS (SELECT x, count(*) AS df FROM f GROUP BY x HAVING count(*) <= greatest(2, floor(0.15 * (SELECT count(*) FROM co)))), fk AS (SELECT company_id, x, df FROM f JOIN df USING (x)),
      sm AS (SELECT k.company_id, k.neighbor, p.x, p.df, row_number() OVER (PARTITION BY k.company_id, k.neighbor ORDER BY p.df, p.x) AS rn FROM (SELECT DISTINCT company_id, neighbor FROM kp WHERE space = 'combined') k JOIN fk p ON p.company_id = k.company_id JOIN fk q ON q.company_id = k.neighbor AND q.x = p.x),
      ms AS (SELECT company_id, neighbor, string_agg(x, '|' ORDER BY rn) AS shared_metadata FROM sm WHERE rn <= 4 GROUP BY ALL)
      SELECT k.company_id, k.space, place, k.neighbor AS neighbor_company_id, round(similarity, 4) AS score, shared_tags, CASE WHEN k.space = 'combined' THEN shared_metadata END AS shared_metadata
      FROM kp k LEFT JOIN ts USING (company_id, neighbor, space) LEFT JOIN ms ON ms.company_id = k.company_id AND ms.neighbor = k.neighbor""",
    "neighbor_companies": f"""{_NB} SELECT ek.company_id, neighbor AS neighbor_company_id, rank, name, batch FROM ek LEFT JOIN (SELECT * FROM co WHERE is_hiring) c ON c.company_id = neighbor WHERE space = 'combined'""",
    "tags_artifact": f"""WITH {_FEATURES}, {D._CO}, h AS (SELECT f.company_id, tag_id, batch_year FROM features f JOIN (SELECT company_id, batch_year FROM co) USING (company_id)), p AS (SELECT tag_id, count(*) AS prevalence FROM h GROUP BY 1),
      y AS (SELECT tag_id, string_agg(batch_year || ':' || n, ',' ORDER BY batch_year) AS by_year FROM (SELECT tag_id, batch_year, count(*) AS n FROM h WHERE batch_year IS NOT NULL GROUP BY ALL) GROUP BY 1),
      c AS (SELECT a.tag_id, b.tag_id AS other, count(*) AS n FROM h a JOIN h b ON a.company_id = b.company_id AND a.tag_id <> b.tag_id GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY tag_id ORDER BY n DESC, other) AS rank FROM c),
      k AS (SELECT tag_id, string_agg(other || ':' || n, ',' ORDER BY rank) AS cooccurring FROM r WHERE rank <= 8 GROUP BY 1)
      SELECT tag_id, canonical_name AS name, facet, least(8, len(aliases)) AS aliases, coalesce(prevalence, 0) AS prevalence, support_count::BIGINT AS support, coalesce(k.cooccurring, '') AS cooccurring, coalesce(by_year, '') AS by_year
      FROM tags LEFT JOIN p USING (tag_id) LEFT JOIN y USING (tag_id) LEFT JOIN k USING (tag_id) WHERE state = 'active'""",
    "tag_documents": f"""WITH {_FEATURES}, {_TG}, r AS (SELECT company_id, tag_id, row_number() OVER (PARTITION BY company_id ORDER BY round(calibrated_confidence * w, 6) DESC, tag_id) AS pos FROM features)
      SELECT company_id, md5(string_agg(canonical_name || ' (' || replace(facet, '_', ' ') || '): ' || definition, ' ' ORDER BY pos)) AS digest FROM r JOIN tg USING (tag_id) WHERE pos <= 24 GROUP BY company_id""",
    "tag_terms": """WITH m AS (SELECT tag_id, term_id, max(similarity) AS similarity FROM source_taxonomy_tag_mappings WHERE term_id IS NOT NULL GROUP BY ALL)
      SELECT tag_id, term_id, similarity, place FROM (SELECT *, row_number() OVER (PARTITION BY tag_id ORDER BY similarity DESC, term_id) AS place FROM m) WHERE place <= 6""",
    "point_positions": f"WITH {D._CO}, {_PUB}, p AS (SELECT company_id, row_number() OVER (ORDER BY company_id) - 1 AS position FROM pub) SELECT company_id, coalesce(position, -1) AS position FROM co LEFT JOIN p USING (company_id)",
    "tag_groups": f"""WITH {D._CO}, {_TG}, e AS (SELECT DISTINCT company_id, facet, tag_id FROM (SELECT company_id, unnest(tag_ids) AS tag_id FROM co) JOIN tg USING (tag_id)), g AS (SELECT company_id, facet, string_agg(tag_id, ',' ORDER BY tag_id) AS tags, count(*) AS size FROM e GROUP BY ALL)
      SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY size DESC, facet) AS place FROM g""",
    "legends": f"""WITH {D._CO}, s AS (SELECT list_reduce(list_transform(string_split(company_id, ''), lambda x: ascii(x)::BIGINT), lambda h, x: (h * 31 + x) & 4294967295, 0::BIGINT) % 64 % 8 AS c FROM co)
      SELECT 'tag' AS kind, CASE WHEN coalesce(list_contains(tag_ids, 'escrow-storage'), false) THEN 'has tag' ELSE 'no tag' END AS bin, count(*) AS n FROM co GROUP BY 2 UNION ALL SELECT 'cluster', c::VARCHAR, count(*) FROM s GROUP BY 2""",
    "picker": """SELECT tag_id FROM tags WHERE state = 'active' AND (tag_id IN ('escrow-storage', 'grid-sampling') OR contains(lower(canonical_name), 'cal')) ORDER BY tag_id IN ('escrow-storage', 'grid-sampling') DESC, support_count DESC, tag_id LIMIT 60""",
    "filter_full": f"""WITH {D._CO}, w AS (SELECT company_id FROM co WHERE team_size > 5 ORDER BY company_id LIMIT 300) SELECT company_id FROM co WHERE batch IN ('Winter 2025', 'Summer 2019', 'Fall 2014', 'Winter 2012') AND batch_year BETWEEN 2010 AND 2030
      AND stage IN ('Early', 'Growth') AND company_id IN (SELECT company_id FROM w)""",
    "round_trip": f"""WITH {D._CO}, {D._RANKED}, b AS (SELECT company_id, count(*) AS k FROM rk GROUP BY 1), o AS (SELECT *, trim(regexp_replace(coalesce(one_liner, ''), '\\s+', ' ', 'g')) AS ol FROM co)
      SELECT o.company_id, name, CASE WHEN length(ol) > 160 THEN rtrim(left(ol, 159)) || '…' ELSE ol END AS one_liner, nullif(status, '') AS status, team_size::BIGINT AS team_size, top_company, is_hiring, coalesce(k, 0) AS tags, coalesce(len(regions), 0) AS regions FROM o LEFT JOIN b USING (company_id)""",
    "exports": """SELECT 'csv' AS sink, count(*) AS n, 11::BIGINT AS "columns" FROM tags UNION ALL SELECT 'parquet', count(*), 12 FROM tags UNION ALL SELECT 'jsonl', count(*), 3 FROM tags UNION ALL SELECT 'log', count(*), 1 FROM tags""",
    "call_packs": """WITH p AS (SELECT DISTINCT company_id, tag_id, facet FROM company_tag_judgments JOIN tags USING (tag_id) WHERE company_id IS NOT NULL), r AS (SELECT company_id, (row_number() OVER (PARTITION BY company_id ORDER BY facet, tag_id) - 1) // 8 AS call FROM p)
      SELECT company_id AS entity, call, count(*) AS n FROM r GROUP BY ALL""",
    "conversions": """WITH p AS (SELECT payload::JSON->>'team_size' AS t, substr(source_last_updated, 1, 10) AS a, trim(regexp_replace(payload::JSON->>'one_liner', '\\s+', ' ', 'g')) AS o FROM companies_raw)
      SELECT CASE WHEN try_cast(t AS INTEGER) >= 0 THEN 'number' ELSE 'none' END AS team, CASE WHEN try_cast(a AS TIMESTAMP) IS NOT NULL THEN 'time' ELSE 'none' END AS "at", length(CASE WHEN length(o) > 40 THEN rtrim(left(o, 39)) || '…' ELSE o END) AS "length", count(*) AS n FROM p GROUP BY 1, 2, 3""",
    "evidence_sources": """SELECT CASE k WHEN 'yc_one_liner' THEN 'One-liner' WHEN 'yc_long_description' THEN 'Description' WHEN 'metadata_document' THEN 'Directory fields' WHEN 'website_main_text' THEN 'Website' ELSE k END AS source, count(*) AS n
      FROM (SELECT split_part(e.document_id, '#', 2) AS k FROM (SELECT unnest(evidence) AS e FROM company_tag_judgments)) GROUP BY 1""",
    "wrapped_texts": r"""SELECT doc_id, md5('<document>' || chr(10) || substr(trim(regexp_replace(regexp_replace(coalesce(text, ''), '</?\s*document[^>]*>', ' ', 'gi'), '\s+', ' ', 'g')), 1, 500) || chr(10) || '</document>') AS digest FROM documents""",
    "keep_last_success": f"""WITH {D._CO}, n AS (SELECT company_id, length(name) AS n FROM co) SELECT company_id, n % 4 = 0 OR n % 3 > 0 AS ok, CASE WHEN n % 4 <> 0 AND n % 3 > 0 THEN 'before' ELSE 'now' END AS text FROM n WHERE n % 2 = 0""",
    "orphan_tags": f"WITH {_FEATURES} SELECT tag_id FROM tags WHERE state = 'active' AND tag_id NOT IN (SELECT tag_id FROM features)",
    "feature_gates": f"WITH {_FEATURES} " + " UNION ALL ".join([
        _gate("feature_evidence", "SELECT f.company_id, f.tag_id FROM features f LEFT JOIN last l ON l.company_id = f.company_id AND l.tag_id = f.tag_id WHERE l.company_id IS NULL OR len(evidence) = 0 OR coalesce(trim(rationale), '') = ''"),
        _gate("feature_company", "SELECT * FROM features WHERE company_id NOT IN (SELECT company_id FROM companies_normalized)"), _gate("feature_tag", "SELECT * FROM features WHERE tag_id NOT IN (SELECT tag_id FROM tags)"),
        _gate("feature_tag_active", "SELECT * FROM features WHERE tag_id NOT IN (SELECT tag_id FROM tags WHERE state = 'active')"), _gate("feature_finite", "SELECT * FROM features WHERE isnan(w) OR isinf(w) OR isnan(raw_confidence) OR isinf(raw_confidence)"),
    ]),
    "published_gates": "SELECT unnest(['manifest_parses', 'files_match_checksums', 'points_are_companies', 'points_finite', 'tags_published', 'scores_parallel', 'details_in_their_shards', 'neighbors_published', 'search_covers_companies', 'provenance']) AS gate, true AS passed, 0::BIGINT AS violations",
    "release_counts": f"""WITH {D._CO}, {D._TERMS}, n AS (SELECT count(*) AS n FROM co), u AS (SELECT DISTINCT term_id FROM e)
      SELECT unnest(['points', 'companies', 'search', 'detail']) AS artifact, n FROM n UNION ALL SELECT 'tags', count(DISTINCT tag_id) FROM tags WHERE state = 'active' UNION ALL SELECT 'taxonomy_terms', count(DISTINCT term_id) FROM source_taxonomy_terms WHERE term_id IN (SELECT term_id FROM u)
      UNION ALL SELECT 'taxonomy_mappings', count(*) FROM (SELECT DISTINCT mapping_id, term_id, tag_id, relation, round(similarity, 4), reviewed FROM source_taxonomy_tag_mappings WHERE term_id IN (SELECT term_id FROM u) AND tag_id IN (SELECT tag_id FROM tags)) UNION ALL SELECT 'clusters', 12 UNION ALL SELECT 'quality', 17""",
    "release_lookup": f"""WITH {_FEATURES}, {D._CO}, k AS (SELECT company_id, count(*) AS k FROM features WHERE tag_id IN (SELECT tag_id FROM tags WHERE state = 'active') GROUP BY 1)
      SELECT co.company_id, name, list_reduce(list_transform(string_split(co.company_id, ''), lambda x: ascii(x)::BIGINT), lambda h, x: (h * 31 + x) & 4294967295, 0::BIGINT) % 64 AS shard, coalesce(k, 0) AS tags, true AS placed FROM co LEFT JOIN k USING (company_id)""",
}
