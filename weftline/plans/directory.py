"""Queries over the company directory: normalisation, taxonomy, filters, search, publishing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions import hashing as H
from weftline.functions import text as T
from weftline.operators import filters as L
from weftline.operators import normalize as N
from weftline.operators import ontology as O
from weftline.operators import publish as P
from weftline.operators import search as R
from weftline.operators import shortlist as S
from weftline.operators.filters import FilterSpec
from weftline.plans.judging import norm_sql
from weftline.plans.vectors import KNN_SPARSE_SQL, knn_sparse_jaccard
from weftline.sources.tables import table


def companies(spark: SparkSession, d: str) -> DataFrame:
    """The published companies, one row each."""
    return table(spark, d, "companies").distinct()


def current(spark: SparkSession, d: str) -> DataFrame:
    """The current version of every normalised company."""
    rows = table(spark, d, "companies_normalized")
    cols = ["updated_at", *[c for c in rows.columns if c not in ("company_id", "updated_at")]]
    return rows.where("company_id IS NOT NULL").groupBy("company_id").agg(F.max(F.struct(*cols)).alias("s")).select("company_id", "s.*")


_CO = "co AS (SELECT DISTINCT * FROM companies)"
_RAW = "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY updated_at DESC) AS rn FROM companies_normalized WHERE company_id IS NOT NULL) WHERE rn = 1)"


def normalize_raw(spark: SparkSession, d: str) -> DataFrame:
    """Payloads of all deliveries parsed and typed, by delivery and company; which fields a company has."""
    raw = table(spark, d, "companies_raw").withColumn("delivery", F.substring("source_last_updated", 1, 10))
    good, _ = N.parse_payloads(raw.where("company_id IS NOT NULL"))
    out = N.normalize_companies(good, keys=("delivery",))
    big = lambda c: F.col(c).cast("bigint").alias(c)
    return out.select(
        "delivery", "company_id", "yc_id", "name", "slug", "one_liner", "website", "batch", "batch_slug", "batch_season", big("batch_year"), "industry", big("team_size"), "is_hiring", "nonprofit", F.array_join("source_tags", "|").alias("tags"), F.array_join("regions", "|").alias("regions"),
        F.array_join(F.array_sort("source_taxonomy_term_ids"), "|").alias("terms"), F.md5("metadata_document").alias("document"),
    ).distinct()


def rejected_records(spark: SparkSession, d: str) -> DataFrame:
    _, bad = N.parse_payloads(table(spark, d, "companies_raw"))
    return bad.groupBy("error").agg(F.count(F.lit(1)).alias("n"))


def batch_parse(spark: SparkSession, d: str) -> DataFrame:
    b = table(spark, d, "companies_normalized").select("batch").distinct()
    return b.select("batch", T.batch_season(F.col("batch")).alias("season"), T.batch_year(F.col("batch")).cast("bigint").alias("year"), T.batch_slug(F.col("batch")).alias("slug"))


def normalized_names(spark: SparkSession, d: str) -> DataFrame:
    names = table(spark, d, "tags").select(F.col("canonical_name").alias("name")).union(table(spark, d, "companies").select("name")).union(table(spark, d, "source_taxonomy_terms").select("name"))
    return names.distinct().select("name", T.normalize_name(F.col("name")).alias("key"), T.slugify(F.col("name")).alias("slug"))


def normalized_documents(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.sha2(T.normalize_name(F.col("text")), 256).alias("digest"))


def stable_hash_ids(spark: SparkSession, d: str) -> DataFrame:
    c = companies(spark, d).select("company_id", "name").distinct()
    return c.select("company_id", "name", H.short_hash(F.concat_ws("|", "company_id", "name"), 20).alias("short_id"), H.stable_hash(id=F.col("company_id"), slug=T.slugify(F.col("name"))).alias("digest"))


def shard_assignment(spark: SparkSession, d: str) -> DataFrame:
    return companies(spark, d).select("company_id").distinct().select("company_id", H.shard_for(F.col("company_id")).cast("bigint").alias("shard"))


def company_terms(c: DataFrame) -> DataFrame:
    """entity, term_id: the source terms of companies, of all kinds; blanks are none."""
    c = c.withColumn("industries", F.array().cast("array<string>"))
    filled = lambda a: F.filter(F.coalesce(a, F.array().cast("array<string>")), lambda x: F.trim(x) != "")
    c = c.withColumns({n: F.nullif(F.trim(n), F.lit("")) for n in ("industry", "subindustry", "batch", "stage", "status")} | {n: filled(F.col(n)) for n in ("source_tags", "regions")})
    return c.select(F.col("company_id").alias("entity"), F.explode(N.term_ids()).alias("term_id")).where("term_id IS NOT NULL").distinct()


def metadata_documents(spark: SparkSession, d: str) -> DataFrame:
    c = companies(spark, d).withColumn("industries", F.array("industry")).withColumn("all_locations", F.lit(None).cast("string")).withColumn("launched_at", F.lit(None).cast("timestamp"))
    for n in ("status", "stage", "industry", "subindustry", "batch"):
        c = c.withColumn(n, F.nullif(F.col(n), F.lit("")))
    return c.select("company_id", F.md5(N.metadata_document()).alias("digest"))


def source_documents(spark: SparkSession, d: str) -> DataFrame:
    c = companies(spark, d).select("company_id", "one_liner", F.col("name").alias("long_description"))
    return N.source_documents(c).select("document_id", "kind", F.col("char_count").cast("bigint").alias("char_count"), "content_hash")


def taxonomy_counts(spark: SparkSession, d: str) -> DataFrame:
    c = companies(spark, d)
    one = lambda n: F.array(F.col(n))
    out = N.taxonomy_counts(c, {"subindustry": one("subindustry"), "stage": one("stage"), "status": one("status"), "region": F.coalesce("regions", F.array().cast("array<string>"))})
    return out


def merged_terms(spark: SparkSession, d: str) -> DataFrame:
    """Listed terms united with derived ones; a row with a source path wins."""
    cols = ["term_id", "name", "source_path"]
    listed = table(spark, d, "source_taxonomy_terms").select(*cols)
    derived = taxonomy_counts(spark, d).select(F.concat("kind", F.lit(":"), "slug").alias("term_id"), "name", F.lit(None).cast("string").alias("source_path"))
    return N.merge_terms(listed, derived)


def cdc_incremental(spark: SparkSession, d: str) -> DataFrame:
    """Current companies against the versions before, by content hash: how many are new, changed or the same."""
    rows = table(spark, d, "companies_normalized")
    now = current(spark, d).select("company_id", "content_hash", "updated_at")
    before = rows.join(now.select("company_id", F.col("updated_at").alias("last")), "company_id").where("updated_at < last").groupBy("company_id").agg(F.max(F.struct("updated_at", "content_hash")).alias("s")).select("company_id", "s.content_hash")
    return N.incremental(now, before, "company_id", "content_hash").groupBy("change").agg(F.count(F.lit(1)).alias("n"))


AND_FILTER = FilterSpec(year_from=2015, statuses=["Active"], regions=["Remote", "Inland", "North Coast"], min_score=0.5, tags=["escrow-storage"])
OR_FILTER = FilterSpec(industries=["Healthcare", "Business Software"], subindustries=["Consumer -> Security"], tags=["escrow-storage", "factory-imaging", "grid-sampling"], tag_mode="or", is_hiring=True)


def filter_conjunctive(spark: SparkSession, d: str) -> DataFrame:
    return L.apply_filters(companies(spark, d), AND_FILTER).select("company_id")


def filter_disjunctive(spark: SparkSession, d: str) -> DataFrame:
    return L.apply_filters(companies(spark, d), OR_FILTER).select("company_id")


def filter_facet(spark: SparkSession, d: str) -> DataFrame:
    return L.apply_filters(companies(spark, d), FilterSpec(facets=["product"], min_score=0.9), table(spark, d, "tags")).select("company_id")


def facet_counts(spark: SparkSession, d: str) -> DataFrame:
    one = lambda n: F.array(F.col(n))
    return L.facet_counts(companies(spark, d), {n: one(n) for n in ("industry", "batch", "status", "stage")} | {"region": F.coalesce("regions", F.array().cast("array<string>"))})


def legend_bins(spark: SparkSession, d: str) -> DataFrame:
    return L.legend_bins(companies(spark, d), largest=5)


def tag_text_filter(spark: SparkSession, d: str) -> DataFrame:
    return L.tag_text_filter(table(spark, d, "tags"), "product", "record", False).select("tag_id")


def result_page(spark: SparkSession, d: str) -> DataFrame:
    return L.page(companies(spark, d).select("company_id", "name"), [F.asc("name"), F.asc("company_id")], 1)


def diverse_batches(spark: SparkSession, d: str) -> DataFrame:
    c = current(spark, d).select("company_id", "industry", "batch_year")
    order = [F.coalesce("industry", F.lit("zz")), F.coalesce("batch_year", F.lit(0)), F.col("company_id")]
    return O.diverse_batches(c, c.count(), 28, order).select("company_id", "position", "batch")


def stratified_sample(spark: SparkSession, d: str) -> DataFrame:
    c = current(spark, d).select("company_id", F.coalesce("industry", F.lit("Unlisted")).alias("industry"), F.coalesce("batch_year", F.lit(0)).alias("batch_year"))
    return S.stratified_round_robin(c, "company_id", ["industry", "batch_year"], 100).select("company_id")


def search_exact(spark: SparkSession, d: str) -> DataFrame:
    """Exact-token BM25 over all document texts."""
    ix = R.build_index(table(spark, d, "documents").select("doc_id", "text"), "doc_id", ("text",))
    return R.search(ix, "tenant records", None, prefix=False, fuzzy=False, name_field=None, boosts={"text": 1.0}).select("doc", "score")


SEARCHED = ("n", "a", "o", "e", "g", "x", "d", "b")


def company_index(spark: SparkSession, d: str) -> R.SearchIndex:
    return R.build_index(P.search_documents(companies(spark, d), table(spark, d, "tags")), "i", SEARCHED)


def _hits(found: DataFrame) -> DataFrame:
    return found.select("doc", "score", F.array_join("fields", ",").alias("fields"), F.array_join("terms", ",").alias("terms"))


def search_prefix(spark: SparkSession, d: str) -> DataFrame:
    """Weighted fields and prefixes over the search documents; every hit."""
    return _hits(R.search(company_index(spark, d), "trans cal", None, fuzzy=False))


def search_fuzzy(spark: SparkSession, d: str) -> DataFrame:
    """Weighted fields, prefixes and near spellings over the search documents; every hit."""
    return _hits(R.search(company_index(spark, d), "calibratoin", None))


def search_phrase(spark: SparkSession, d: str) -> DataFrame:
    """A quoted phrase has to stand in one of the fields."""
    return _hits(R.search(company_index(spark, d), '"credit unions" audits', None))


def search_tiers(spark: SparkSession, d: str) -> DataFrame:
    """Names that are the query, begin with it or contain it come first; the best 20."""
    return _hits(R.search(company_index(spark, d), "labs", 20))


def search_filtered(spark: SparkSession, d: str) -> DataFrame:
    """Keyword and filter together, in the order of relevance."""
    kept = L.apply_filters(companies(spark, d), FilterSpec(year_from=2012, statuses=["Active"])).select("company_id")
    return R.search_within(company_index(spark, d), "transit survey", kept, "company_id").select("company_id", "score", "place")


def snippets(spark: SparkSession, d: str) -> DataFrame:
    """The text around the first hit of either word."""
    docs = table(spark, d, "documents").where(F.lower("text").contains("tenant"))
    s = docs.select("doc_id", R.snippet(F.col("text"), ["tenant", "records"]).alias("s"))
    return s.select("doc_id", F.md5(F.array_join(F.transform("s", lambda x: x["text"]), "")).alias("digest"), F.size(F.filter("s", lambda x: x["hit"])).cast("bigint").alias("hits"))


def cooccurrence(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "companies").select("company_id", F.explode("tag_ids").alias("tag_id"))
    return P.cooccurring(a, "company_id", "tag_id").select("label", "other", "n", F.col("rank").cast("bigint").alias("rank"))


def prevalence_by_year(spark: SparkSession, d: str) -> DataFrame:
    rows = companies(spark, d).where("batch_year IS NOT NULL").select(F.explode("tag_ids").alias("tag"), "batch_year").where("tag IS NOT NULL")
    m = P.counts_by_year(rows, "tag", "batch_year")
    return m.select("label", F.explode("by_year").alias("year", "n")).select("label", F.col("year").cast("bigint").alias("year"), "n")


def cluster_lift_labels(spark: SparkSession, d: str) -> DataFrame:
    """Industries as clusters: the tags that tell them apart."""
    c = companies(spark, d).where("industry IS NOT NULL")
    return P.lift_labels(c.select(F.col("company_id").alias("id"), F.col("industry").alias("cluster")), c.select(F.col("company_id").alias("id"), F.explode("tag_ids").alias("term")).where("term IS NOT NULL")).select("cluster", "term", "n", "score", F.col("rank").cast("bigint").alias("rank"))


def neighbor_explanations(spark: SparkSession, d: str) -> DataFrame:
    """Facts shared by every company and its neighbours, rarest first."""
    c = companies(spark, d)
    facts = c.select(F.col("company_id").alias("id"), P.metadata_facts().alias("facts"))
    edges = knn_sparse_jaccard(spark, d).select(F.col("entity").alias("id"), F.col("neighbor").alias("neighbor_id"))
    return P.neighbor_explanations(edges, facts).select("id", "neighbor_id", F.array_join("shared", "|").alias("shared"))


def compact_index(spark: SparkSession, d: str) -> DataFrame:
    c = P.compact_index(companies(spark, d))
    return c.select(
        "company_id", "name", "one_liner", "batch", F.col("batch_year").cast("bigint").alias("batch_year"), F.array_join("regions", "|").alias("regions"), F.col("top_company").cast("bigint").alias("top_company"),
        F.size("tag_ids").cast("bigint").alias("tags"), F.try_element_at("tag_scores", F.lit(1)).alias("best"),
    )


def search_docs(spark: SparkSession, d: str) -> DataFrame:
    s = P.search_documents(companies(spark, d), table(spark, d, "tags"))
    return s.select("i", "n", "a", "o", "e", "d", "b", "g", "x")


def csr_export(spark: SparkSession, d: str) -> DataFrame:
    """Row pointers of the company by active tag matrix."""
    c = table(spark, d, "companies")
    f = c.select("company_id", F.explode(F.arrays_zip("tag_ids", "tag_scores")).alias("z")).select("company_id", F.col("z.tag_ids").alias("tag_id"), F.col("z.tag_scores").alias("v")).where("tag_id IS NOT NULL AND v BETWEEN 0 AND 1")
    f = f.groupBy("company_id", "tag_id").agg(F.max("v").alias("v"))
    _, ptr = P.csr_matrix(f, c.select("company_id"), table(spark, d, "tags").where("state = 'active'").select("tag_id"), "company_id", "tag_id", "v")
    return ptr


def coo_export(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "companies")
    f = c.select("company_id", F.explode(F.arrays_zip("tag_ids", "tag_scores")).alias("z")).select("company_id", F.col("z.tag_ids").alias("tag_id"), F.col("z.tag_scores").alias("v")).where("tag_id IS NOT NULL AND v BETWEEN 0 AND 1")
    f = f.groupBy("company_id", "tag_id").agg(F.max("v").alias("v"))
    coo, _ = P.csr_matrix(f, c.select("company_id"), table(spark, d, "tags").where("state = 'active'").select("tag_id"), "company_id", "tag_id", "v")
    return coo


def alias_hits(spark: SparkSession, d: str) -> DataFrame:
    texts = companies(spark, d).where("one_liner IS NOT NULL").select(F.col("company_id").alias("entity"), F.col("one_liner").alias("text"))
    return S.alias_hits(texts, table(spark, d, "tags").where("state = 'active'"))


def mapped_tags(spark: SparkSession, d: str) -> DataFrame:
    return S.mapped_tags(company_terms(companies(spark, d)), table(spark, d, "source_taxonomy_tag_mappings"), table(spark, d, "tags").where("state = 'active'"))


_L = "lower(regexp_replace(strip_accents(X), '[^\\x00-\\x7F]', '', 'g'))"


def slug_sql(x: str) -> str:
    base = f"trim(regexp_replace({_L.replace('X', x)}, '[^a-z0-9]+', '-', 'g'), '-')"
    return f"CASE WHEN {x} IS NULL THEN NULL WHEN {base} = '' THEN 'unnamed' ELSE rtrim(left({base}, 64), '-') END"


_SCORED = "z AS (SELECT company_id, tag_id, max(v) AS v FROM (SELECT company_id, unnest(tag_ids) AS tag_id, unnest(tag_scores) AS v FROM companies) WHERE tag_id IS NOT NULL AND v BETWEEN 0 AND 1 GROUP BY ALL)"
_COO = f"""WITH {_SCORED}, r AS (SELECT company_id, row_number() OVER (ORDER BY company_id) - 1 AS r FROM (SELECT DISTINCT company_id FROM companies)),
  c AS (SELECT tag_id, row_number() OVER (ORDER BY tag_id) - 1 AS c FROM (SELECT DISTINCT tag_id FROM tags WHERE state = 'active')), m AS (SELECT r, c, v FROM z JOIN r USING (company_id) JOIN c USING (tag_id))"""
_RANKED = """rk AS (SELECT company_id, tag, s, row_number() OVER (PARTITION BY company_id ORDER BY s DESC, tag) AS pos FROM (SELECT company_id, t.tag AS tag, coalesce(t.s, 0) AS s FROM
  (SELECT company_id, unnest(list_transform(generate_series(1, greatest(coalesce(len(tag_ids), 0), coalesce(len(tag_scores), 0))), lambda i: {'tag': tag_ids[i], 's': tag_scores[i]})) AS t FROM co)) WHERE tag IS NOT NULL)"""

FUNCTIONS = (
    normalize_raw, rejected_records, batch_parse, normalized_names, normalized_documents, stable_hash_ids, shard_assignment, metadata_documents, source_documents, taxonomy_counts, merged_terms, cdc_incremental,
    filter_conjunctive, filter_disjunctive, filter_facet, facet_counts, legend_bins, tag_text_filter, result_page, diverse_batches, stratified_sample, search_exact, search_prefix, search_fuzzy, search_phrase, search_tiers, search_filtered, snippets, cooccurrence, prevalence_by_year,
    cluster_lift_labels, neighbor_explanations, compact_index, search_docs, csr_export, coo_export, alias_hits, mapped_tags,
)
QUERIES = {f.__name__: f for f in FUNCTIONS}
_SQ = "trim(regexp_replace(X, '\\s+', ' ', 'g'))"


def _clean(x: str) -> str:
    return f"nullif({_SQ.replace('X', x)}, '')"


_TERMS = f"""e AS (SELECT DISTINCT company_id, kind || ':' || {slug_sql("s")} AS term_id FROM (SELECT company_id, 'tag' AS kind, unnest(source_tags) AS s FROM co UNION ALL SELECT company_id, 'region', unnest(regions) FROM co UNION ALL SELECT company_id, 'industry', industry FROM co
  UNION ALL SELECT company_id, 'subindustry', subindustry FROM co UNION ALL SELECT company_id, 'batch', batch FROM co UNION ALL SELECT company_id, 'stage', stage FROM co UNION ALL SELECT company_id, 'status', status FROM co) WHERE trim(s) <> '')"""
_X = """ta AS (SELECT tag_id, min(canonical_name) AS canonical_name, any_value(aliases[1:2]) AS al FROM tags GROUP BY tag_id),
  g AS (SELECT company_id, string_agg(canonical_name, ' ' ORDER BY pos) AS g FROM rk JOIN ta ON ta.tag_id = rk.tag WHERE pos <= 14 GROUP BY 1),
  xa AS (SELECT company_id, v, min(pos * 10 + k) AS nth FROM (SELECT company_id, pos, unnest(al) AS v, unnest(generate_series(1, len(al))) AS k FROM rk JOIN ta ON ta.tag_id = rk.tag WHERE pos <= 8) WHERE v IS NOT NULL GROUP BY ALL),
  xx AS (SELECT company_id, string_agg(v, ' ' ORDER BY nth) AS x FROM xa GROUP BY 1)"""
_SEARCH_DOCS = f"""SELECT co.company_id AS i, name AS n, '' AS a, coalesce(one_liner, '') AS o, '' AS e, concat_ws(' ', industry, subindustry, CASE WHEN source_tags IS NULL THEN NULL ELSE coalesce(array_to_string(list_filter(source_tags, lambda r: r IS NOT NULL), ' '), '') END) AS d,
  concat_ws(' ', batch, CASE WHEN regions IS NULL THEN NULL ELSE coalesce(array_to_string(list_filter(regions, lambda r: r IS NOT NULL), ' '), '') END, status, stage) AS b, coalesce(g, '') AS g, coalesce(x, '') AS x FROM co LEFT JOIN g USING (company_id) LEFT JOIN xx USING (company_id)"""


def _search_sql(terms: list[str], prefix: bool = True, fuzzy: bool = True, where: str = "", query: str = "") -> str:
    """BM25 over the fields of the search documents, in SQL; gives CTEs up to ``hit`` (doc, score, fields, terms)."""
    near = "(CASE WHEN length(q) >= 5 THEN round(length(q) * 0.2) WHEN length(q) = 4 THEN round(length(q) * 0.15) ELSE 0 END)"
    w = "CASE WHEN term = q THEN 1.0::DOUBLE" + (" WHEN length(q) >= 3 AND starts_with(term, q) THEN 0.375::DOUBLE * length(term) / (length(term) + 0.3::DOUBLE * (length(term) - length(q)))" if prefix else "")
    w += (f" WHEN abs(length(term) - length(q)) <= {near} AND levenshtein(term, q) <= {near} THEN 0.45::DOUBLE * length(term) / (length(term) + levenshtein(term, q))" if fuzzy else "") + " END"
    whole = query or " ".join(terms)
    boosts = {"n": 8.0, "a": 5.0, "g": 3.5, "x": 2.5, "o": 2.0, "d": 1.4, "e": 1.0, "b": 1.0}
    fields = " UNION ALL ".join(f"SELECT i AS doc, '{f}' AS field, {x}::DOUBLE AS boost, {f} AS t FROM sd" for f, x in boosts.items())
    return f"""WITH {_CO}, {_RANKED}, {_X}, sd AS ({_SEARCH_DOCS}), fl AS ({fields}),
      tk AS (SELECT doc, field, boost, list_filter(regexp_split_to_array(lower(t), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS w FROM fl), av AS (SELECT field, avg(len(w)) AS avgdl FROM tk GROUP BY field),
      po AS (SELECT doc, field, boost, len(w) AS dl, term, count(*) AS tf FROM (SELECT doc, field, boost, w, unnest(w) AS term FROM tk) GROUP BY ALL), df AS (SELECT term, field, count(*) AS df FROM po GROUP BY ALL),
      qs AS (SELECT term, q, wt FROM (SELECT term, q, {w} AS wt FROM (SELECT DISTINCT term FROM po), (SELECT unnest({terms}) AS q)) WHERE wt IS NOT NULL),
      sc AS (SELECT doc, count(DISTINCT q) AS found, sum(boost * wt * ln(1 + ((SELECT count(*) FROM sd) - df + 0.5) / (df + 0.5)) * (0.5 + tf * 2.2 / (tf + 1.2 * (0.3 + 0.7 * dl / avgdl)))) AS s, string_agg(DISTINCT field, ',' ORDER BY field) AS fields, string_agg(DISTINCT term, ',' ORDER BY term) AS terms
        FROM po JOIN qs USING (term) JOIN df USING (term, field) JOIN av USING (field) GROUP BY doc),
      hit AS (SELECT doc, round(s + CASE WHEN trim(lower(n)) = '{whole}' THEN 10000 WHEN starts_with(trim(lower(n)), '{whole}') THEN 1000 WHEN contains(trim(lower(n)), '{whole}') THEN 200 ELSE 0 END, 6) AS score, fields, terms FROM sc JOIN sd ON sd.i = sc.doc WHERE found = {len(terms)} {where})"""


ORACLES = {
    "normalize_raw": f"""WITH r AS (SELECT substr(source_last_updated, 1, 10) AS delivery, company_id, payload::JSON AS p FROM companies_raw WHERE company_id IS NOT NULL AND json_valid(payload)),
      t AS (SELECT delivery, company_id, (p->>'id')::BIGINT AS yc_id, {_clean("(p->>'name')")} AS name, {_clean("(p->>'one_liner')")} AS one_liner, {_clean("(p->>'batch')")} AS b, {_clean("(p->>'industry')")} AS industry,
        {_clean("(p->>'website')")} AS website, try_cast(p->>'team_size' AS BIGINT) AS team, coalesce((p->>'isHiring')::BOOLEAN, false) AS is_hiring, coalesce((p->>'nonprofit')::BOOLEAN, false) AS nonprofit,
        coalesce(from_json(p->'tags', '["VARCHAR"]'), []) AS tags, coalesce(from_json(p->'regions', '["VARCHAR"]'), []) AS regions FROM r),
      k AS (SELECT *, CASE WHEN team >= 0 THEN team END AS team_size, nullif(regexp_extract(b, '^(?:Winter|Summer|Spring|Fall|IK12|Unspecified)\\s*(\\d{{4}})$', 1), '')::BIGINT AS batch_year FROM t)
      SELECT DISTINCT delivery, company_id, yc_id, name, {slug_sql("name")} AS slug, one_liner, website, b AS batch, {slug_sql("b")} AS batch_slug, is_hiring, nonprofit, team_size, array_to_string(regions, '|') AS regions,
        array_to_string(list_sort(list_distinct(list_concat([CASE WHEN industry IS NOT NULL THEN 'industry:' || {slug_sql("industry")} END, CASE WHEN b IS NOT NULL THEN 'batch:' || {slug_sql("b")} END],
          list_transform(regions, lambda x: 'region:' || {slug_sql("x")}), list_transform(tags, lambda x: 'tag:' || {slug_sql("x")})))), '|') AS terms,
        md5(concat_ws(' ', name || ' is a directory company.', CASE WHEN b IS NULL THEN NULL WHEN batch_year IS NOT NULL THEN 'It participated in the ' || b || ' batch, in ' || batch_year || '.' ELSE 'It participated in the ' || b || ' batch.' END,
          'The directory lists its industry as ' || industry || '.', CASE WHEN len(tags) > 0 THEN 'The directory''s source tags: ' || array_to_string(tags, ', ') || '.' END, CASE WHEN len(regions) > 0 THEN 'Listed regions: ' || array_to_string(regions, ', ') || '.' END,
          'Its team size is ' || team_size || '.', CASE WHEN nonprofit THEN 'It is a nonprofit.' END, CASE WHEN is_hiring THEN 'It is currently hiring.' END)) AS document,
        CASE WHEN regexp_matches(b, '^(Winter|Summer|Spring|Fall)(\\s*\\d{{4}})?$', 'i') THEN regexp_extract(b, '^[A-Za-z]+') ELSE 'Unspecified' END AS batch_season,
        batch_year, industry, array_to_string(tags, '|') AS tags FROM k WHERE yc_id IS NOT NULL AND name IS NOT NULL""",
    "rejected_records": """WITH p AS (SELECT CASE WHEN NOT json_valid(payload) OR json_type(payload::JSON) NOT IN ('OBJECT') THEN 'not an object' WHEN payload::JSON->>'id' IS NULL THEN 'no id' WHEN nullif(trim(payload::JSON->>'name'), '') IS NULL THEN 'no name' END AS error FROM companies_raw)
      SELECT error, count(*) AS n FROM p WHERE error IS NOT NULL GROUP BY error""",
    "batch_parse": f"""SELECT DISTINCT batch, CASE WHEN regexp_matches(trim(batch), '^(Winter|Summer|Spring|Fall)(\\s*\\d{{4}})?$', 'i') THEN regexp_extract(trim(batch), '^[A-Za-z]+') ELSE 'Unspecified' END AS season,
      nullif(regexp_extract(trim(batch), '^(?:Winter|Summer|Spring|Fall|IK12|Unspecified)\\s*(\\d{{4}})$', 1), '')::BIGINT AS year, CASE WHEN batch <> '' THEN {slug_sql("batch")} END AS slug FROM companies_normalized""",
    "normalized_names": f"SELECT name, {norm_sql('name')} AS key, {slug_sql('name')} AS slug FROM (SELECT canonical_name AS name FROM tags UNION SELECT name FROM companies UNION SELECT name FROM source_taxonomy_terms)",
    "normalized_documents": f"SELECT doc_id, sha256({norm_sql('text')}) AS digest FROM documents",
    "stable_hash_ids": f"""SELECT DISTINCT company_id, name, left(sha256(company_id || '|' || name), 20) AS short_id, sha256('{{"id":"' || company_id || '","slug":"' || {slug_sql("name")} || '"}}') AS digest FROM companies""",
    "shard_assignment": "SELECT DISTINCT company_id, list_reduce(list_transform(string_split(company_id, ''), lambda x: ascii(x)::BIGINT), lambda h, x: (h * 31 + x) & 4294967295, 0::BIGINT) % 64 AS shard FROM companies",
    "metadata_documents": f"""WITH {_CO}, k AS (SELECT *, array_to_string(list_filter(source_tags, lambda x: x IS NOT NULL), ', ') AS st, array_to_string(list_filter(regions, lambda x: x IS NOT NULL), ', ') AS rg FROM co)
      SELECT company_id, md5(concat_ws(' ', name || ' is a directory company.',
      CASE WHEN nullif(batch, '') IS NULL THEN NULL WHEN batch_year IS NOT NULL THEN 'It participated in the ' || batch || ' batch, in ' || batch_year || '.' ELSE 'It participated in the ' || batch || ' batch.' END,
      'Its status is ' || lower(nullif(status, '')) || '.', 'Its stage is ' || lower(nullif(stage, '')) || '.', 'The directory lists its industry as ' || nullif(industry, '') || '.',
      CASE WHEN nullif(subindustry, '') IS DISTINCT FROM nullif(industry, '') THEN 'Its sub-industry is ' || trim(replace(subindustry, '->', 'within')) || '.' END,
      CASE WHEN len(source_tags) > 0 THEN 'The directory''s source tags: ' || coalesce(st, '') || '.' END, CASE WHEN len(regions) > 0 THEN 'Listed regions: ' || coalesce(rg, '') || '.' END, 'Its team size is ' || team_size || '.',
      CASE WHEN nonprofit THEN 'It is a nonprofit.' END, CASE WHEN top_company THEN 'The directory lists it as a top company.' END, CASE WHEN is_hiring THEN 'It is currently hiring.' END)) AS digest FROM k""",
    "source_documents": f"""WITH {_CO}, k AS (SELECT company_id, 'yc_one_liner' AS kind, trim(one_liner) AS t FROM co UNION ALL SELECT company_id, 'yc_long_description', trim(name) FROM co)
      SELECT company_id || '#' || kind AS document_id, kind, length(t) AS char_count, sha256(t) AS content_hash FROM k WHERE t <> ''""",
    "taxonomy_counts": f"""WITH {_CO}, t AS (SELECT 'subindustry' AS kind, subindustry AS name FROM co UNION ALL SELECT 'stage', stage FROM co UNION ALL SELECT 'status', status FROM co UNION ALL SELECT 'region', unnest(regions) FROM co)
      SELECT kind, {slug_sql("name")} AS slug, min(name) AS name, count(*) AS company_count FROM t WHERE trim(name) <> '' GROUP BY 1, 2""",
    "merged_terms": f"""WITH {_CO}, t AS (SELECT 'subindustry' AS kind, subindustry AS name FROM co UNION ALL SELECT 'stage', stage FROM co UNION ALL SELECT 'status', status FROM co UNION ALL SELECT 'region', unnest(regions) FROM co),
      g AS (SELECT kind || ':' || {slug_sql("name")} AS term_id, min(name) AS name FROM t WHERE trim(name) <> '' GROUP BY 1), u AS (SELECT term_id, name, source_path, 0 AS part FROM source_taxonomy_terms UNION ALL SELECT term_id, name, NULL, 1 FROM g)
      SELECT term_id, name, source_path FROM (SELECT *, row_number() OVER (PARTITION BY term_id ORDER BY source_path IS NULL, part, name) AS rn FROM u) WHERE rn = 1""",
    "cdc_incremental": f"""WITH n AS (SELECT company_id, content_hash, updated_at FROM {_RAW}), o AS (SELECT c.company_id, arg_max(c.content_hash, c.updated_at) AS h FROM companies_normalized c JOIN n ON n.company_id = c.company_id WHERE c.updated_at < n.updated_at GROUP BY c.company_id)
      SELECT CASE WHEN o.company_id IS NULL THEN 'new' WHEN o.h IS NOT DISTINCT FROM n.content_hash THEN 'same' ELSE 'changed' END AS change, count(*) AS n FROM n LEFT JOIN o USING (company_id) GROUP BY 1""",
    "filter_conjunctive": f"""WITH {_CO}, {_RANKED.replace("coalesce(t.s, 0)", "t.s")} SELECT company_id FROM co WHERE batch_year >= 2015 AND status = 'Active' AND list_has_any(regions, ['Remote', 'Inland', 'North Coast'])
      AND EXISTS (SELECT 1 FROM rk WHERE rk.company_id = co.company_id AND rk.s >= 0.5 AND rk.tag = 'escrow-storage')""",
    "filter_disjunctive": f"""WITH {_CO} SELECT company_id FROM co WHERE (industry IN ('Healthcare', 'Business Software', 'Consumer -> Security') OR subindustry IN ('Healthcare', 'Business Software', 'Consumer -> Security')) AND is_hiring AND list_has_any(tag_ids, ['escrow-storage', 'factory-imaging', 'grid-sampling'])""",
    "filter_facet": f"""WITH {_CO}, {_RANKED.replace("coalesce(t.s, 0)", "t.s")} SELECT company_id FROM co WHERE EXISTS (SELECT 1 FROM rk JOIN tags ON tags.tag_id = rk.tag WHERE rk.company_id = co.company_id AND rk.s >= 0.9 AND facet = 'product')""",
    "facet_counts": f"""WITH {_CO}, t AS (SELECT 'industry' AS facet, industry AS v FROM co UNION ALL SELECT 'batch', batch FROM co UNION ALL SELECT 'status', status FROM co UNION ALL SELECT 'stage', stage FROM co UNION ALL SELECT 'region', unnest(list_distinct(regions)) FROM co)
      SELECT facet, v AS "value", count(*) AS n FROM t WHERE v <> '' GROUP BY ALL""",
    "legend_bins": f"""WITH {_CO}, i AS (SELECT coalesce(industry, 'Unknown') AS v, count(*) AS n FROM co GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY n DESC, v) AS rn FROM i),
      y AS (SELECT min(batch_year) AS lo, greatest(1, ceil((max(batch_year) - min(batch_year) + 1) / 14.0))::INT AS w FROM co)
      SELECT 'industry' AS kind, CASE WHEN rn <= 5 THEN v ELSE 'Other' END AS bin, sum(n)::BIGINT AS n FROM r GROUP BY 2 UNION ALL
      SELECT 'year', CAST(((batch_year - lo) // w) * w + lo AS VARCHAR), count(*) FROM co, y WHERE batch_year IS NOT NULL GROUP BY 2""",
    "tag_text_filter": "SELECT tag_id FROM tags WHERE facet = 'product' AND (contains(lower(canonical_name), 'record') OR contains(lower(definition), 'record') OR len(list_filter(aliases, lambda a: contains(lower(a), 'record'))) > 0)",
    "result_page": f"WITH {_CO} SELECT company_id, name FROM co ORDER BY name, company_id LIMIT 200 OFFSET 50",
    "diverse_batches": f"""WITH c AS (SELECT company_id, row_number() OVER (ORDER BY coalesce(industry, 'zz'), coalesce(batch_year, 0), company_id) - 1 AS position FROM {_RAW})
      SELECT company_id, position, position % greatest(1, (SELECT count(*) FROM c) // 28) AS batch FROM c""",
    "stratified_sample": f"""WITH c AS (SELECT company_id, coalesce(industry, 'Unlisted') AS i, coalesce(batch_year, 0) AS y FROM {_RAW}),
      r AS (SELECT *, row_number() OVER (PARTITION BY i, y ORDER BY sha256('20240917|' || company_id), company_id) AS n FROM c) SELECT company_id FROM r ORDER BY n, sha256('20240917|' || i || '|' || y) LIMIT 100""",
    "search_exact": r"""WITH t AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents), a AS (SELECT count(*) AS n, avg(len(w)) AS l FROM t),
      p AS (SELECT doc_id, len(w) AS dl, q, len(list_filter(w, lambda x: x = q)) AS tf FROM t, (SELECT unnest(['tenant', 'records']) AS q)), f AS (SELECT q, count(*) AS df FROM p WHERE tf > 0 GROUP BY q),
      s AS (SELECT doc_id, count(*) AS c, sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * (0.5 + tf * 2.2 / (tf + 1.2 * (0.3 + 0.7 * dl / l)))) AS s FROM p JOIN f USING (q), a WHERE tf > 0 GROUP BY doc_id)
      SELECT doc_id AS doc, round(s, 6) AS score FROM s WHERE c = 2""",
    "cooccurrence": """WITH e AS (SELECT DISTINCT company_id, t FROM (SELECT company_id, unnest(tag_ids) AS t FROM companies) WHERE t IS NOT NULL), p AS (SELECT a.t AS label, b.t AS other, count(*) AS n FROM e a JOIN e b ON a.company_id = b.company_id AND a.t <> b.t GROUP BY ALL)
      SELECT label, other, n, rank FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY n DESC, other) AS rank FROM p) WHERE rank <= 8""",
    "prevalence_by_year": f"WITH {_CO} SELECT label, y::BIGINT AS year, count(*) AS n FROM (SELECT unnest(tag_ids) AS label, batch_year AS y FROM co WHERE batch_year IS NOT NULL) WHERE label IS NOT NULL GROUP BY ALL",
    "cluster_lift_labels": f"""WITH {_CO}, m AS (SELECT company_id, industry AS cluster FROM co WHERE industry IS NOT NULL), s AS (SELECT cluster, count(*) AS size FROM m GROUP BY 1), e AS (SELECT DISTINCT company_id, t FROM (SELECT company_id, unnest(tag_ids) AS t FROM co WHERE industry IS NOT NULL) WHERE t IS NOT NULL),
      l AS (SELECT cluster, t AS term, count(*) AS n FROM e JOIN m USING (company_id) GROUP BY ALL), g AS (SELECT term, sum(n) AS gl FROM l GROUP BY 1),
      x AS (SELECT cluster, term, n, round(n * (n / size::DOUBLE) / (gl::DOUBLE / (SELECT count(*) FROM m)), 6) AS score FROM l JOIN s USING (cluster) JOIN g USING (term) WHERE n >= greatest(2, 0.12 * size))
      SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY score DESC, term) AS rank FROM x) WHERE rank <= 5""",
    "neighbor_explanations": f"""WITH {_CO}, f AS (SELECT DISTINCT company_id, x FROM (SELECT company_id, unnest(list_concat([CASE WHEN batch <> '' THEN 'batch: ' || batch END, CASE WHEN industry <> '' THEN 'industry: ' || industry END, CASE WHEN subindustry <> '' THEN 'subindustry: ' || subindustry END,
        CASE WHEN status <> '' THEN 'status: ' || status END, CASE WHEN stage <> '' THEN 'stage: ' || stage END], list_transform(coalesce(regions, []), lambda r: 'region: ' || r), list_transform(coalesce(source_tags, []), lambda r: 'tag: ' || r))) AS x FROM co) WHERE x IS NOT NULL),
      d AS (SELECT x, count(*) AS df FROM f GROUP BY x HAVING count(*) <= greatest(2, floor(0.15 * (SELECT count(*) FROM co)))), k AS (SELECT company_id, x, df FROM f JOIN d USING (x)),
      e AS (SELECT entity AS id, neighbor AS neighbor_id FROM ({KNN_SPARSE_SQL})),
      s AS (SELECT id, neighbor_id, p.x, p.df, row_number() OVER (PARTITION BY id, neighbor_id ORDER BY p.df, p.x) AS rn FROM e JOIN k p ON p.company_id = id JOIN k q ON q.company_id = neighbor_id AND q.x = p.x)
      SELECT id, neighbor_id, string_agg(x, '|' ORDER BY rn) AS shared FROM s WHERE rn <= 4 GROUP BY ALL""",
    "compact_index": f"""WITH {_CO}, {_RANKED}, b AS (SELECT company_id, count(*) AS k, max(CASE WHEN pos = 1 THEN round(s, 4) END) AS best FROM rk GROUP BY 1), o AS (SELECT *, {_SQ.replace("X", "coalesce(one_liner, '')")} AS ol FROM co)
      SELECT o.company_id, name, nullif(CASE WHEN length(ol) > 160 THEN rtrim(left(ol, 159)) || '…' ELSE ol END, '') AS one_liner, nullif(batch, '') AS batch, batch_year::BIGINT AS batch_year, CASE WHEN len(regions) > 0 THEN coalesce(array_to_string(list_filter(regions, lambda r: r IS NOT NULL), '|'), '') END AS regions,
      CASE WHEN top_company THEN 1 END::BIGINT AS top_company, b.k AS tags, best FROM o LEFT JOIN b USING (company_id)""",
    "search_docs": f"WITH {_CO}, {_RANKED}, {_X} {_SEARCH_DOCS}",
    "search_prefix": _search_sql(["trans", "cal"], fuzzy=False) + " SELECT doc, score, fields, terms FROM hit",
    "search_fuzzy": _search_sql(["calibratoin"]) + " SELECT doc, score, fields, terms FROM hit",
    "search_phrase": _search_sql(["credit", "unions", "audits"], query="credit unions audits", where="AND contains(lower(concat_ws(chr(10), n, a, o, e, g, d, b)), 'credit unions')") + " SELECT doc, score, fields, terms FROM hit",
    "search_tiers": _search_sql(["labs"]) + " SELECT doc, score, fields, terms FROM hit ORDER BY score DESC, doc LIMIT 20",
    "search_filtered": _search_sql(["transit", "survey"]) + " SELECT doc AS company_id, score, row_number() OVER (ORDER BY score DESC, doc) - 1 AS place FROM hit JOIN co ON co.company_id = doc WHERE batch_year >= 2012 AND status = 'Active'",
    "snippets": r"""WITH d AS (SELECT doc_id, text, regexp_extract(text, '(?is)^(.*?)(records|tenant)', 1) AS head FROM documents WHERE contains(lower(text), 'tenant')),
      c AS (SELECT doc_id, text, greatest(1, length(head) + 1 - 90) AS st FROM d), k AS (SELECT doc_id, substr(text, st, 180) AS cut, st, length(text) AS n FROM c)
      SELECT doc_id, md5(CASE WHEN st > 1 THEN '…' ELSE '' END || cut || CASE WHEN st + 180 <= n THEN '…' ELSE '' END) AS digest, len(regexp_extract_all(lower(cut), 'records|tenant')) AS hits FROM k""",
    "csr_export": _COO + """, n AS (SELECT r.r, count(m.c) AS k FROM r LEFT JOIN m ON m.r = r.r GROUP BY r.r) SELECT r, sum(k) OVER (ORDER BY r)::BIGINT - k AS "start", sum(k) OVER (ORDER BY r)::BIGINT AS "end" FROM n""",
    "coo_export": _COO + "SELECT r, c, v FROM m",
    "alias_hits": f"""WITH {_CO}, a AS (SELECT {norm_sql("a")} AS g, min(tag_id) AS tag_id FROM (SELECT tag_id, unnest(list_concat([canonical_name], coalesce(aliases, []))) AS a FROM tags WHERE state = 'active') GROUP BY 1),
      t AS (SELECT company_id, ' ' || {norm_sql("one_liner")} || ' ' AS x FROM co WHERE one_liner IS NOT NULL) SELECT DISTINCT company_id AS entity, tag_id FROM t JOIN a ON length(g) >= 4 AND contains(x, ' ' || g || ' ')""",
    "mapped_tags": f"""WITH {_CO}, {_TERMS}
      SELECT DISTINCT company_id AS entity, m.tag_id FROM e JOIN source_taxonomy_tag_mappings m USING (term_id) JOIN tags t ON t.tag_id = m.tag_id AND t.state = 'active' WHERE relation IN ('equivalent', 'narrower', 'overlaps')""",
}
