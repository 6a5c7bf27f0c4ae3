"""The queries of this subpackage and their SQL, over the whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm.components import connected_components
from weftline.llm.cooccurrence import cooccurrence
from weftline.llm.leakage import leaked_passages
from weftline.llm.mixture import count_tokens, distinct_texts, mix_plan, mix_report, mix_sources
from weftline.llm.quota_sample import QuotaSample, quota_sample
from weftline.llm.residue import is_residue, mine_templates, residue_documents
from weftline.llm.setsim import class_pairs, link_counts, record_pairs, similar_sets
from weftline.llm.topn import top_n_per_group
from weftline.runtime import materialize, squeeze
from weftline.sources.tables import table

# --- 1 items that appear together


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    pairs = cooccurrence(table(spark, d, "companies"), "company_id", "tag_ids", min_pair=10)
    return pairs.where(F.col("n_ab") * F.col("n") >= 4 * F.col("n_a") * F.col("n_b")).select(F.col("item_a").alias("tag_a"), F.col("item_b").alias("tag_b"))


def p1_pairs(spark: SparkSession, d: str) -> DataFrame:
    """All pairs in at least two companies, with lift and pmi."""
    pairs = cooccurrence(table(spark, d, "companies"), "company_id", "tag_ids", min_pair=2)
    return pairs.select("item_a", "item_b", "n", "n_a", "n_b", "n_ab", F.round("lift", 6).alias("lift"), F.round("pmi", 6).alias("pmi"))


_P1 = """
WITH e AS (SELECT DISTINCT company_id, unnest(tag_ids) AS t FROM companies), i AS (SELECT * FROM e WHERE t IS NOT NULL),
n AS (SELECT count(DISTINCT company_id) AS n FROM companies), m AS (SELECT t, count(*) AS c FROM i GROUP BY t),
p AS (SELECT a.t AS item_a, b.t AS item_b, count(*) AS n_ab FROM i a JOIN i b ON a.company_id = b.company_id AND a.t < b.t GROUP BY ALL),
x AS (SELECT item_a, item_b, n.n, ma.c AS n_a, mb.c AS n_b, n_ab FROM p, n, m ma, m mb WHERE ma.t = item_a AND mb.t = item_b)
"""
P1_FOUND_SQL = _P1 + "SELECT item_a AS tag_a, item_b AS tag_b FROM x WHERE n_ab >= 10 AND n_ab * n >= 4 * n_a * n_b"
P1_PAIRS_SQL = _P1 + """SELECT *, round(n_ab * n::DOUBLE / (n_a::DOUBLE * n_b), 6) AS lift, round(log2(n_ab * n::DOUBLE / (n_a::DOUBLE * n_b)), 6) AS pmi
FROM x WHERE n_ab >= 2"""

# --- 2 similar pairs between set-valued records


def _similar(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Both fields at once: a record is (field, company), and a value carries its field."""
    companies = table(spark, d, "companies")
    ids, tags = F.transform("tag_ids", lambda x: F.concat(F.lit("t "), x)), F.transform("source_tags", lambda x: F.concat(F.lit("s "), F.lower(squeeze(x))))
    values = F.array(*(F.struct(F.lit(n).alias("f"), c.alias("vs")) for n, c in (("tag_ids", ids), ("source_tags", tags))))
    rows = companies.where("company_id IS NOT NULL").select("company_id", F.explode(values).alias("s"))
    return similar_sets(rows, F.struct(F.col("s.f").alias("field_name"), "company_id"), F.col("s.vs"), 0.7, min_size=4)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    pairs = record_pairs(*_similar(spark, d))
    return pairs.select("record_a.field_name", F.col("record_a.company_id").alias("company_a"), F.col("record_b.company_id").alias("company_b"))


def p2_links(spark: SparkSession, d: str) -> DataFrame:
    """One row per company and field: the representative of its equal sets, how many there are, and its number of partners."""
    out = link_counts(*_similar(spark, d))
    return out.select("record.field_name", "record.company_id", F.col("representative.company_id").alias("representative"), "copies", "links")


def p2_class_pairs(spark: SparkSession, d: str) -> DataFrame:
    """The similar pairs of different sets, by their representatives; with p2_links as membership this is every link."""
    out = class_pairs(*_similar(spark, d))
    return out.select("a.field_name", F.col("a.company_id").alias("company_a"), F.col("b.company_id").alias("company_b"), *(F.col(c).cast("bigint").alias(c) for c in ("size_a", "size_b", "shared")))


_P2 = r"""
WITH e AS (SELECT DISTINCT 'tag_ids' AS field_name, company_id, unnest(tag_ids) AS v FROM companies
  UNION SELECT 'source_tags', company_id, lower(trim(regexp_replace(v, '\s+', ' ', 'g'))) FROM (SELECT company_id, unnest(source_tags) AS v FROM companies)),
f AS (SELECT * FROM e WHERE v IS NOT NULL), n AS (SELECT field_name, company_id, count(*) AS n FROM f GROUP BY ALL HAVING count(*) >= 4),
g AS (SELECT f.* FROM f JOIN n USING (field_name, company_id)),
p AS (SELECT a.field_name, a.company_id AS company_a, b.company_id AS company_b, count(*) AS k FROM g a JOIN g b ON a.field_name = b.field_name AND a.v = b.v AND a.company_id < b.company_id GROUP BY ALL),
l AS (SELECT p.field_name, company_a, company_b, x.n AS size_a, y.n AS size_b, k AS shared FROM p JOIN n x ON x.field_name = p.field_name AND x.company_id = company_a
JOIN n y ON y.field_name = p.field_name AND y.company_id = company_b WHERE k * 10 >= 7 * (x.n + y.n - k)),
r AS (SELECT field_name, company_id, min(company_id) OVER w AS representative, count(*) OVER w AS copies
  FROM (SELECT field_name, company_id, list(v ORDER BY v) AS vs FROM g GROUP BY ALL) WINDOW w AS (PARTITION BY field_name, vs))
"""
P2_FOUND_SQL = _P2 + "SELECT field_name, company_a, company_b FROM l"
P2_LINKS_SQL = _P2 + """, ends AS (SELECT field_name, company_a AS company_id FROM l UNION ALL SELECT field_name, company_b FROM l), c AS (SELECT field_name, company_id, count(*) AS links FROM ends GROUP BY ALL)
SELECT field_name, company_id, representative, copies, coalesce(links, 0) AS links FROM r LEFT JOIN c USING (field_name, company_id)"""
P2_CLASS_PAIRS_SQL = _P2 + """SELECT l.* FROM l JOIN r x ON x.field_name = l.field_name AND x.company_id = company_a AND x.representative = company_a
JOIN r y ON y.field_name = l.field_name AND y.company_id = company_b AND y.representative = company_b WHERE shared < size_a OR shared < size_b"""

# --- 4 sample matching target category proportions


def _cells(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "sample_targets").select(
        "cell_id", F.col("industry").alias("category"), F.col("year_lo").alias("lo"), F.col("year_hi").alias("hi"), "target_permille", "min_count"
    ).distinct()


def _sample(spark: SparkSession, d: str) -> QuotaSample:
    return quota_sample(table(spark, d, "companies_normalized"), _cells(spark, d), "company_id", "updated_at", "industry", "batch_year")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """The exhausted reservoirs: those whose final counts are below what their cells need."""
    return _sample(spark, d).report().where("available < need").select("cell_id").distinct()


def p4_sample(spark: SparkSession, d: str) -> DataFrame:
    return _sample(spark, d).sample().select("cell_id", F.col("key").alias("company_id"))


def p4_report(spark: SparkSession, d: str) -> DataFrame:
    """Per cell: what it needs, what there is, and what is missing."""
    return _sample(spark, d).report().select("cell_id", F.col("target_permille").cast("bigint").alias("target_permille"), "need", "available", "missing")


def p4_outcome(spark: SparkSession, d: str) -> DataFrame:
    """Per cell: the share wanted and drawn, and where the need was not met and why."""
    return _sample(spark, d).outcome().select("cell_id", (F.col("target_permille") / 1000).alias("target_share"), "share", "need", "available", "drawn", "unmet", "reason")


_P4 = r"""
WITH c AS (SELECT company_id, arg_max({'i': industry, 'y': batch_year}, updated_at) AS s FROM companies_normalized GROUP BY company_id),
k AS (SELECT company_id, lower(CASE WHEN trim(regexp_replace(coalesce(s.i, ''), '\s+', ' ', 'g')) = '' THEN 'Unlisted' ELSE trim(regexp_replace(s.i, '\s+', ' ', 'g')) END) AS i, coalesce(s.y, 0) AS y FROM c),
m AS (SELECT count(*) // 10 AS m FROM c),
r AS (SELECT t.cell_id, t.target_permille::BIGINT AS target_permille, greatest((t.target_permille * m.m + 999) // 1000, t.min_count)::BIGINT AS need, count(k.company_id) AS available FROM sample_targets t, m
  LEFT JOIN k ON k.i = lower(trim(regexp_replace(t.industry, '\s+', ' ', 'g'))) AND k.y BETWEEN t.year_lo AND t.year_hi
  GROUP BY t.cell_id, t.target_permille, t.min_count, m.m)
"""
P4_FOUND_SQL = _P4 + "SELECT cell_id FROM r WHERE available < need"
P4_REPORT_SQL = _P4 + "SELECT cell_id, target_permille, need, available, greatest(need - available, 0) AS missing FROM r"

# --- 6 top N items within every group


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "companies").select("company_id", F.explode(F.arrays_zip("tag_ids", "tag_scores")).alias("z"))
    rows = rows.select("company_id", F.col("z.tag_ids").alias("tag_id"), F.col("z.tag_scores").alias("score")).where("score BETWEEN 0 AND 1")
    top = top_n_per_group(rows, "tag_id", "company_id", "score", 3)
    return top.select(F.col("grp").alias("tag_id"), F.col("item").alias("company_id"), "place")


P6_FOUND_SQL = """
WITH e AS (SELECT company_id, unnest(tag_ids) AS tag_id, unnest(tag_scores) AS score FROM companies),
b AS (SELECT tag_id, company_id, max(score) AS score FROM e WHERE tag_id IS NOT NULL AND score BETWEEN 0 AND 1 GROUP BY ALL)
SELECT tag_id, company_id, place FROM (SELECT tag_id, company_id, CAST(row_number() OVER (PARTITION BY tag_id ORDER BY score DESC, company_id) AS INTEGER) AS place FROM b) WHERE place <= 3
"""

# --- 7 consolidating pairwise matches into groups


def accepted_links(spark: SparkSession, d: str) -> DataFrame:
    """The two tags of every proposal whose latest row accepts it."""
    p = table(spark, d, "merge_proposals").where("proposal_id IS NOT NULL")
    cols = ["created_at", "source_tag_id", "target_tag_id", "similarity", "verdict", "adjudication"]
    last = p.groupBy("proposal_id").agg(F.max(F.struct(*cols)).alias("s")).select("s.*")
    fold = lambda c: F.lower(squeeze(c))
    ok = (fold("verdict") == "auto_merge") | ((fold("verdict") == "review") & (fold("adjudication") == "merge"))
    return last.where(F.col("similarity").between(0.8, 1.0) & ok).select("source_tag_id", "target_tag_id")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    groups = connected_components(accepted_links(spark, d), "source_tag_id", "target_tag_id")
    return groups.select(F.col("node").alias("tag_id"), F.col("component").alias("group_id"))


P7_FOUND_SQL = r"""
WITH RECURSIVE l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY proposal_id ORDER BY created_at DESC) AS rn FROM merge_proposals) WHERE rn = 1),
g AS (SELECT source_tag_id AS a, target_tag_id AS b FROM l WHERE source_tag_id IS NOT NULL AND target_tag_id IS NOT NULL AND source_tag_id <> target_tag_id
  AND similarity BETWEEN 0.8 AND 1 AND (lower(trim(verdict)) = 'auto_merge' OR (lower(trim(verdict)) = 'review' AND lower(trim(adjudication)) = 'merge'))),
e AS (SELECT a, b FROM g UNION SELECT b, a FROM g),
r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT a AS tag_id, least(a, min(b)) AS group_id FROM r GROUP BY a
"""

# --- 8 evaluation texts leaking into training text


def p8_passages(spark: SparkSession, d: str) -> DataFrame:
    """Every leak within two edits a passage, with the share of the item that is covered."""
    found = leaked_passages(table(spark, d, "documents"), table(spark, d, "eval_items"))
    return found.withColumn("covered", F.round(F.col("passage_words") / F.col("item_words"), 6))


def p8_cover(spark: SparkSession, d: str) -> DataFrame:
    """How many words of each item a document holds word for word."""
    found = leaked_passages(table(spark, d, "documents"), table(spark, d, "eval_items")).where("edits = 0")
    return found.select("doc_id", "item_id", "exact_words", F.col("item_words").cast("bigint").alias("item_words"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    """Passages that the alignment found to have no edit."""
    found = leaked_passages(table(spark, d, "documents"), table(spark, d, "eval_items"))
    return found.where("edits = 0").select("doc_id", "item_id")


_P8 = r"""
WITH d AS (SELECT doc_id, ' ' || array_to_string(regexp_extract_all(lower(text), '[\p{L}\p{N}]+'), ' ') || ' ' AS t FROM documents),
i AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM eval_items),
p AS (SELECT DISTINCT item_id, k, len(w) AS n, ' ' || array_to_string(list_slice(w, k, k + least(12, len(w)) - 1), ' ') || ' ' AS t
  FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - least(12, len(w)) + 1)) AS k FROM i WHERE len(w) > 0)),
f AS (SELECT doc_id, item_id, k, n FROM d JOIN p ON contains(d.t, p.t))
"""
P8_FOUND_SQL = _P8 + "SELECT DISTINCT doc_id, item_id FROM f"
P8_COVER_SQL = _P8 + """SELECT doc_id, item_id, count(DISTINCT pos) AS exact_words, n AS item_words
FROM (SELECT doc_id, item_id, n, unnest(generate_series(k, k + least(12, n) - 1)) AS pos FROM f) GROUP BY doc_id, item_id, n"""

# --- 9 mixing sources to target weights


def _mixture(spark: SparkSession, d: str) -> tuple:
    texts = materialize(distinct_texts(count_tokens(table(spark, d, "documents"), "doc_kind")), "tokens")
    targets = table(spark, d, "mix_targets").select("source", (F.col("target_permille") / 1000).alias("target_share"), "max_repeats").distinct()
    plan = mix_plan(texts, targets)
    return texts, mix_sources(texts, plan), targets, plan


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    """The drawn documents, with how often each is used."""
    return _mixture(spark, d)[1].select("doc_id", "source", "tokens", "repeats")


def p9_report(spark: SparkSession, d: str) -> DataFrame:
    """Wanted, raked and reached shares of sources, languages and topics."""
    return mix_report(*_mixture(spark, d))


# --- 10 template residue and error-page text


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return residue_documents(table(spark, d, "documents")).where(is_residue()).select("doc_id").distinct()


def p10_clean(spark: SparkSession, d: str) -> DataFrame:
    """The documents without those found."""
    docs = table(spark, d, "documents")
    return docs.join(residue_documents(docs).where(is_residue()).select("doc_id"), "doc_id", "left_anti").select("doc_id", "source", "n_chars")


def p10_templates(spark: SparkSession, d: str) -> DataFrame:
    """The mined message templates that occur in at least two documents, with their support and verdicts."""
    templates, _ = mine_templates(table(spark, d, "documents"))
    return templates.where("docs > 1").select("template", "units", "docs", "alone", F.round("p", 6).alias("p"), "verdict")


QUERIES = {
    "p1_found": p1_found, "p1_pairs": p1_pairs, "p2_found": p2_found, "p2_links": p2_links, "p2_class_pairs": p2_class_pairs,
    "p4_found": p4_found, "p4_sample": p4_sample, "p4_report": p4_report, "p4_outcome": p4_outcome,
    "p6_found": p6_found, "p7_found": p7_found, "p8_found": p8_found, "p8_passages": p8_passages, "p8_cover": p8_cover,
    "p9_mix": p9_mix, "p9_report": p9_report, "p10_found": p10_found, "p10_clean": p10_clean, "p10_templates": p10_templates,
}
ORACLES = {
    "p1_found": P1_FOUND_SQL, "p1_pairs": P1_PAIRS_SQL, "p2_found": P2_FOUND_SQL, "p2_links": P2_LINKS_SQL, "p2_class_pairs": P2_CLASS_PAIRS_SQL, "p4_found": P4_FOUND_SQL, "p4_report": P4_REPORT_SQL,
    "p6_found": P6_FOUND_SQL, "p7_found": P7_FOUND_SQL, "p8_found": P8_FOUND_SQL, "p8_cover": P8_COVER_SQL,
}
