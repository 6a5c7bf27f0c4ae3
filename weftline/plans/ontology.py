"""Queries over the tag ontology, release gates and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions import hashing as H
from weftline.functions import text as T
from weftline.operators import lifecycle as C
from weftline.operators import ontology as O
from weftline.operators import quality as Q
from weftline.operators import release as E
from weftline.plans import directory as D
from weftline.plans.judging import _FEATURES, consolidated, norm_sql, sparse_features
from weftline.sources.tables import table


def merge_chain_follow(spark: SparkSession, d: str) -> DataFrame:
    """Where every tag's merge pointers end; circles and dangling pointers end in null."""
    tags = table(spark, d, "tags")
    return O.follow_pointers(tags.withColumn("p", F.when(F.col("state") == "merged", F.col("merged_into"))), "tag_id", "p", F.col("state") != "merged")


def minted_ids(spark: SparkSession, d: str) -> DataFrame:
    """Ids for company names, within industries as facets."""
    c = D.current(spark, d).select("company_id", "name", F.coalesce("industry", F.lit("none")).alias("facet"))
    return O.mint_ids(c, "name", "facet", ["company_id"]).select("company_id", "minted_id")


def name_index(spark: SparkSession, d: str) -> DataFrame:
    return O.name_index(table(spark, d, "tags"))


def activation(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "tags")
    return t.select("tag_id", O.activation(F.col("state"), F.col("support_count"), F.col("definition")).alias("state"))


def registry_stats(spark: SparkSession, d: str) -> DataFrame:
    return O.registry_stats(table(spark, d, "tags"))


def facet_distribution(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "tags").where("state = 'active'").groupBy("facet").agg(F.count(F.lit(1)).alias("n"))


def display_names(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "tags").select("tag_id", T.display_name(F.col("tag_id")).alias("name"))


def published_tags(spark: SparkSession, d: str) -> DataFrame:
    """All active tags by prevalence, support and id, as published."""
    p = Q.prevalence(sparse_features(spark, d))
    t = table(spark, d, "tags").where("state = 'active'").join(p, "tag_id", "left")
    return t.select("tag_id", F.coalesce("prevalence", F.lit(0)).alias("prevalence"), F.col("support_count").cast("bigint").alias("support")).orderBy(F.desc("prevalence"), F.desc("support"), "tag_id")


def used_terms(spark: SparkSession, d: str) -> DataFrame:
    """Mappings of used terms to existing tags, by term and falling similarity."""
    _, m = E.used_taxonomy(D.company_terms(D.companies(spark, d)), table(spark, d, "source_taxonomy_terms"), table(spark, d, "source_taxonomy_tag_mappings"), table(spark, d, "tags"))
    return m


def taxonomy_terms(spark: SparkSession, d: str) -> DataFrame:
    """The source terms in use, as published."""
    t, _ = E.used_taxonomy(D.company_terms(D.companies(spark, d)), table(spark, d, "source_taxonomy_terms"), table(spark, d, "source_taxonomy_tag_mappings"), table(spark, d, "tags"))
    return t.withColumn("count", F.col("count").cast("bigint"))


def release_gates(spark: SparkSession, d: str) -> DataFrame:
    """The gates on the tables at hand."""
    judged, tags, companies = consolidated(spark, d), table(spark, d, "tags"), table(spark, d, "companies")
    known = table(spark, d, "companies_normalized")
    log = table(spark, d, "company_tag_judgments")
    checks = {
        "required_ids": lambda: Q.gate("required_ids", Q.missing_values(table(spark, d, "companies_raw").where("source IS NOT NULL"), ["company_id"]), F.col("content_hash")),
        "company_reference": lambda: Q.gate("company_reference", Q.dangling(judged, ["company_id"], known, ["company_id"]), F.concat_ws("/", "company_id", "tag_id")),
        "tag_reference": lambda: Q.gate("tag_reference", Q.dangling(judged, ["tag_id"], tags, ["tag_id"]), F.concat_ws("/", "company_id", "tag_id")),
        "active_tags": lambda: Q.gate("active_tags", Q.dangling(judged, ["tag_id"], tags.where("state = 'active'"), ["tag_id"]), F.concat_ws("/", "company_id", "tag_id")),
        "confidence_range": lambda: Q.gate("confidence_range", Q.outside(log, "confidence"), F.col("judgment_id")),
        "finite_scores": lambda: Q.gate("finite_scores", Q.not_finite(log, ["confidence", "retrieval_score"]), F.col("judgment_id")),
        "evidence": lambda: Q.gate("evidence", judged.where("decision = 'yes' AND size(evidence) = 0"), F.concat_ws("/", "company_id", "tag_id")),
        "parallel_arrays": lambda: Q.gate("parallel_arrays", Q.unparallel(companies.distinct(), ["tag_ids", "tag_scores"]), F.col("company_id")),
        "same_companies": lambda: Q.gate("same_companies", Q.different_keys(companies, known, "company_id"), F.col("company_id")),
        "broken_check": lambda: Q.gate("broken_check", companies.where("no_such_column = 1"), F.col("company_id")),
    }
    return Q.run_gates(spark, checks).select("gate", "passed", "violations", F.array_join("samples", ",").alias("samples"))


def duplicate_names(spark: SparkSession, d: str) -> DataFrame:
    """Companies whose names are spellings of one another."""
    c = D.current(spark, d).select(F.col("company_id").alias("tag_id"), F.col("name").alias("canonical_name"), F.lit("active").alias("state"))
    return Q.duplicate_names(c).select("key", F.array_join("tag_ids", ",").alias("tag_ids"))


def alias_table(spark: SparkSession, d: str) -> DataFrame:
    return C.alias_table(table(spark, d, "tags"))


def accumulated_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Tags of companies as proposals for their facets, two batches of companies by shard parity: support accumulated per candidate."""
    c = D.companies(spark, d).select("company_id", F.explode(F.array_distinct(F.col("tag_ids"))).alias("tag_id")).where("tag_id IS NOT NULL")
    ids = c.withColumn("batch", H.shard_for(F.col("company_id")) % 2).groupBy("batch", "tag_id").agg(F.sort_array(F.collect_set("company_id")).alias("ids"))
    p = ids.join(table(spark, d, "tags").select("tag_id", "facet", "definition"), "tag_id").select(F.col("tag_id").alias("name"), "facet", "definition", F.col("ids").alias("supporting_company_ids"), F.col("ids").alias("batch_company_ids"))
    facets = sorted(r[0] for r in table(spark, d, "tags").select("facet").where("facet IS NOT NULL").distinct().collect())  # the ontology's facets
    out = C.accumulate_candidates(C.validated_candidates(p, facets))
    return out.select("candidate_id", "facet", F.col("support_count").cast("bigint").alias("support"))


def display_name_migration(spark: SparkSession, d: str) -> DataFrame:
    """What the display-name migration would change if ids were names."""
    return C.migrate(table(spark, d, "tags").withColumn("canonical_name", F.col("tag_id")), "normalize-display-names", dry_run=True)[1]


_J = """last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY company_id, tag_id ORDER BY created_at DESC, appended_at DESC, judgment_id DESC) AS rn FROM company_tag_judgments
  WHERE company_id IS NOT NULL AND tag_id IS NOT NULL) WHERE rn = 1)"""


def _gate(name: str, body: str, sample: str) -> str:
    return f"SELECT '{name}' AS gate, count(*) = 0 AS passed, count(*) AS violations, coalesce((SELECT string_agg(s, ',' ORDER BY s) FROM (SELECT {sample} AS s FROM ({body}) ORDER BY s LIMIT 5)), '') AS samples FROM ({body})"


_KEY = "company_id || '/' || tag_id"
QUERIES = {f.__name__: f for f in (merge_chain_follow, minted_ids, name_index, activation, registry_stats, facet_distribution, display_names, published_tags, used_terms, taxonomy_terms, release_gates, duplicate_names, alias_table, accumulated_candidates, display_name_migration)}
ORACLES = {
    "merge_chain_follow": """WITH RECURSIVE t AS (SELECT DISTINCT tag_id, state, CASE WHEN state = 'merged' THEN merged_into END AS p FROM tags),
      c(tag_id, cur, path) AS (SELECT tag_id, tag_id, [tag_id] FROM t UNION ALL SELECT c.tag_id, t.p, list_append(path, t.p) FROM c JOIN t ON t.tag_id = c.cur WHERE t.p IS NOT NULL AND NOT list_contains(path, t.p))
      SELECT t.tag_id AS node, max(e.tag_id) AS terminal FROM t LEFT JOIN c ON c.tag_id = t.tag_id LEFT JOIN t e ON e.tag_id = c.cur AND e.state <> 'merged' AND e.p IS NULL GROUP BY t.tag_id""",
    "minted_ids": f"""WITH c AS (SELECT company_id, {D.slug_sql("name")} AS s, {D.slug_sql("coalesce(industry, 'none')")} AS f, coalesce(industry, 'none') AS facet FROM {D._RAW}),
      n AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY company_id) AS n FROM c), k AS (SELECT *, CASE WHEN n > 1 THEN row_number() OVER (PARTITION BY s, facet, n = 1 ORDER BY company_id) END AS k FROM n),
      l AS (SELECT *, sum(CASE WHEN k > 1 THEN 1 ELSE 0 END) OVER (PARTITION BY s ORDER BY company_id ROWS UNBOUNDED PRECEDING) AS late FROM k)
      SELECT company_id, CASE WHEN n = 1 THEN s WHEN k = 1 THEN f || '-' || s ELSE s || '-' || (late + 1)::BIGINT END AS minted_id FROM l""",
    "name_index": f"""WITH n AS (SELECT {norm_sql("canonical_name")} AS key, tag_id, 0 AS prio FROM tags UNION ALL SELECT {norm_sql("a")}, tag_id, 1 FROM (SELECT unnest(aliases) AS a, tag_id FROM tags))
      SELECT key, tag_id FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY prio, tag_id) AS rn FROM n WHERE key <> '') WHERE rn = 1""",
    "activation": "SELECT tag_id, CASE WHEN state = 'candidate' AND support_count >= 2 AND length(definition) >= 20 THEN 'active' ELSE state END AS state FROM tags",
    "registry_stats": "SELECT count(*) FILTER (WHERE state = 'active') AS active, count(*) FILTER (WHERE state = 'candidate') AS candidate, count(*) FILTER (WHERE state = 'merged') AS merged, count(*) FILTER (WHERE state = 'deprecated') AS deprecated, sum(coalesce(len(aliases), 0))::BIGINT AS aliases FROM tags",
    "facet_distribution": "SELECT facet, count(*) AS n FROM tags WHERE state = 'active' GROUP BY facet",
    "published_tags": f"WITH {_FEATURES}, k AS (SELECT tag_id, count(*) AS k FROM features GROUP BY tag_id) SELECT tag_id, coalesce(k, 0) AS prevalence, support_count::BIGINT AS support FROM tags LEFT JOIN k USING (tag_id) WHERE state = 'active' ORDER BY 2 DESC, 3 DESC, 1",
    "used_terms": f"""WITH {D._CO}, {D._TERMS}
      SELECT DISTINCT mapping_id, term_id, tag_id, relation, round(similarity, 4) AS similarity, reviewed FROM source_taxonomy_tag_mappings WHERE term_id IN (SELECT term_id FROM e) AND tag_id IN (SELECT tag_id FROM tags)""",
    "taxonomy_terms": f"""WITH {D._CO}, {D._TERMS}, t AS (SELECT *, row_number() OVER (PARTITION BY term_id ORDER BY kind, name, parent_term_id NULLS FIRST, company_count) AS rn FROM source_taxonomy_terms WHERE term_id IN (SELECT term_id FROM e))
      SELECT term_id, kind, name, parent_term_id AS parent, company_count::BIGINT AS "count" FROM t WHERE rn = 1""",
    "display_names": """WITH w AS (SELECT tag_id, list_filter(string_split(replace(replace(tag_id, '-', ' '), '_', ' '), ' '), lambda x: x <> '') AS w FROM tags)
      SELECT tag_id, array_to_string(list_transform(w, lambda x: CASE WHEN x IN ('ai', 'api', 'ml', 'hr', 'crm', 'erp', 'ev', 'ui', 'ux', 'ci', 'cd', 'pos', 'kyc', 'aml', 'ehr', 'emr', 'gpu', 'cpu', 'sql', 'ocr', 'nlp', 'seo', 'sdk', 'llm', '3d') THEN upper(x) WHEN x = 'iot' THEN 'IoT' WHEN x = 'saas' THEN 'SaaS'
        ELSE upper(x[1:1]) || x[2:] END), ' ') AS name FROM w""",
    "release_gates": f"WITH {_J}, co AS (SELECT DISTINCT * FROM companies) " + " UNION ALL ".join([
        _gate("required_ids", "SELECT content_hash FROM companies_raw WHERE source IS NOT NULL AND coalesce(trim(company_id), '') = ''", "content_hash"),
        _gate("company_reference", "SELECT * FROM last WHERE company_id NOT IN (SELECT company_id FROM companies_normalized)", _KEY),
        _gate("tag_reference", "SELECT * FROM last WHERE tag_id NOT IN (SELECT tag_id FROM tags)", _KEY),
        _gate("active_tags", "SELECT * FROM last WHERE tag_id NOT IN (SELECT tag_id FROM tags WHERE state = 'active')", _KEY),
        _gate("confidence_range", "SELECT judgment_id FROM company_tag_judgments WHERE confidence IS NOT NULL AND (confidence < 0 OR confidence > 1 OR isnan(confidence))", "judgment_id"),
        _gate("finite_scores", "SELECT judgment_id FROM company_tag_judgments WHERE coalesce(isnan(confidence) OR isinf(confidence), false) OR coalesce(isnan(retrieval_score) OR isinf(retrieval_score), false)", "judgment_id"),
        _gate("evidence", "SELECT * FROM last WHERE decision = 'yes' AND len(evidence) = 0", _KEY),
        _gate("parallel_arrays", "SELECT company_id FROM co WHERE coalesce(len(tag_ids), -1) <> coalesce(len(tag_scores), -1)", "company_id"),
        _gate("same_companies", "(SELECT company_id FROM companies EXCEPT SELECT company_id FROM companies_normalized) UNION ALL (SELECT company_id FROM companies_normalized EXCEPT SELECT company_id FROM companies)", "company_id"),
        "SELECT 'broken_check', false, -1, ''",
    ]),
    "alias_table": f"""WITH a AS (SELECT DISTINCT tag_id, unnest(list_concat([canonical_name], coalesce(aliases, []))) AS alias FROM tags), k AS (SELECT tag_id || ':' || {D.slug_sql("alias")} AS alias_id, tag_id, alias, {norm_sql("alias")} AS normalized_alias FROM a)
      SELECT alias_id, tag_id, alias, normalized_alias FROM (SELECT *, row_number() OVER (PARTITION BY alias_id ORDER BY tag_id, alias) AS rn FROM k WHERE normalized_alias <> '') WHERE rn = 1""",
    "accumulated_candidates": f"""WITH {D._CO}, e AS (SELECT DISTINCT company_id, t FROM (SELECT company_id, unnest(tag_ids) AS t FROM co) WHERE t IS NOT NULL)
      SELECT facet || ':' || t AS candidate_id, facet, count(DISTINCT company_id) AS support FROM e JOIN tags ON tag_id = t WHERE length(trim(definition)) >= 20 GROUP BY ALL""",
    "display_name_migration": """WITH w AS (SELECT tag_id, list_filter(string_split(replace(tag_id, '-', ' '), ' '), lambda x: x <> '') AS w FROM tags),
      n AS (SELECT tag_id, array_to_string(list_transform(w, lambda x: CASE WHEN x IN ('ai', 'api', 'ml', 'hr', 'crm', 'erp', 'ev', 'ui', 'ux', 'ci', 'cd', 'iot', 'pos') THEN upper(x) ELSE upper(x[1:1]) || x[2:] END), ' ') AS name FROM w)
      SELECT tag_id, tag_id AS "before", name AS "after" FROM n WHERE name <> tag_id""",
    "duplicate_names": f"SELECT key, string_agg(company_id, ',' ORDER BY company_id) AS tag_ids FROM (SELECT DISTINCT {norm_sql('name')} AS key, company_id FROM {D._RAW}) WHERE key IS NOT NULL GROUP BY key HAVING count(*) > 1",
}
