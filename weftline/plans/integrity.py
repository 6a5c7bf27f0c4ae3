"""Queries on the table problems that belong to the core: orphan references (p3) and snapshot differences (p5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.operators.references import Parents, References, orphan_references, orphan_report
from weftline.operators.snapshots import snapshot_changes
from weftline.sources.tables import table


def orphans(spark: SparkSession, d: str) -> DataFrame:
    judgments, mappings = table(spark, d, "company_tag_judgments"), table(spark, d, "source_taxonomy_tag_mappings")
    tags = table(spark, d, "tags")
    return orphan_references(
        [
            References("company_tag_judgments", judgments, "judgment_id", "created_at", {"tag_id": "tags", "company_id": "companies_normalized"}),
            References("source_taxonomy_tag_mappings", mappings, "mapping_id", "created_at", {"term_id": "source_taxonomy_terms"}),
        ],
        [
            Parents("tags", tags, "tag_id", "created_at", F.when(tags["state"] == "deprecated", tags["updated_at"])),
            Parents("companies_normalized", table(spark, d, "companies_normalized"), "company_id", "updated_at"),
            Parents("source_taxonomy_terms", table(spark, d, "source_taxonomy_terms"), "term_id", "retrieved_at"),
        ],
    )


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return orphans(spark, d).select("src_table", "ref_column", "row_key", "orphan_kind").distinct()


def p3_report(spark: SparkSession, d: str) -> DataFrame:
    return orphan_report(orphans(spark, d))


_P3 = """
WITH refs AS (
  SELECT 'company_tag_judgments' AS src_table, 'tag_id' AS ref_column, judgment_id AS row_key, tag_id AS k, created_at FROM company_tag_judgments
  UNION ALL SELECT 'company_tag_judgments', 'company_id', judgment_id, company_id, created_at FROM company_tag_judgments
  UNION ALL SELECT 'source_taxonomy_tag_mappings', 'term_id', mapping_id, term_id, created_at FROM source_taxonomy_tag_mappings),
parents AS (
  SELECT 'tag_id' AS ref_column, tag_id AS k, min(created_at) AS s, min(CASE WHEN state = 'deprecated' THEN updated_at END) AS e FROM tags GROUP BY tag_id
  UNION ALL SELECT 'company_id', company_id, min(updated_at), NULL FROM companies_normalized GROUP BY company_id
  UNION ALL SELECT 'term_id', term_id, min(retrieved_at), NULL FROM source_taxonomy_terms GROUP BY term_id),
judged AS (
  SELECT r.*, CASE WHEN p.k IS NULL OR r.k = '' THEN 'missing' WHEN p.s > r.created_at THEN 'late' WHEN p.e <= r.created_at THEN 'deleted' END AS orphan_kind
  FROM refs r LEFT JOIN parents p USING (ref_column, k) WHERE r.k IS NOT NULL)
"""

P3_FOUND_SQL = _P3 + "SELECT DISTINCT src_table, ref_column, row_key, orphan_kind FROM judged WHERE orphan_kind IS NOT NULL"
P3_REPORT_SQL = _P3 + """SELECT src_table, ref_column, orphan_kind, strftime(created_at, '%Y-%m') AS "month",
  count(DISTINCT row_key) AS orphan_rows, count(DISTINCT k) AS orphan_keys
FROM judged WHERE orphan_kind IS NOT NULL GROUP BY ALL"""


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    raw = table(spark, d, "companies_raw")
    digest = F.regexp_replace(F.lower(F.trim("content_hash")), "^sha256:", "")
    out = snapshot_changes(raw, "company_id", F.substring("source_last_updated", 1, 10), digest, "retrieved_at")
    return out.select(F.col("snapshot").alias("snapshot_day"), F.col("key").alias("company_id"), "change_kind")


P5_FOUND_SQL = """
WITH states AS (
  SELECT day, company_id, h FROM (
    SELECT substr(source_last_updated, 1, 10) AS day, company_id, regexp_replace(lower(trim(content_hash)), '^sha256:', '') AS h,
      row_number() OVER (PARTITION BY substr(source_last_updated, 1, 10), company_id
        ORDER BY retrieved_at DESC, regexp_replace(lower(trim(content_hash)), '^sha256:', '') DESC) AS rn
    FROM companies_raw WHERE company_id IS NOT NULL) WHERE rn = 1),
days AS (SELECT day, lag(day) OVER (ORDER BY day) AS before FROM (SELECT DISTINCT day FROM states)),
new AS (SELECT s.*, d.before FROM states s JOIN days d USING (day) WHERE d.before IS NOT NULL),
old AS (SELECT s.company_id, s.h, d.day FROM states s JOIN days d ON s.day = d.before)
SELECT coalesce(n.day, o.day) AS snapshot_day, coalesce(n.company_id, o.company_id) AS company_id,
  CASE WHEN o.company_id IS NULL THEN 'added' WHEN n.company_id IS NULL THEN 'removed' ELSE 'changed' END AS change_kind
FROM new n FULL JOIN old o ON n.day = o.day AND n.company_id = o.company_id
WHERE n.h IS DISTINCT FROM o.h
"""

QUERIES = {"p3_found": p3_found, "p3_report": p3_report, "p5_found": p5_found}
ORACLES = {"p3_found": P3_FOUND_SQL, "p3_report": P3_REPORT_SQL, "p5_found": P5_FOUND_SQL}
