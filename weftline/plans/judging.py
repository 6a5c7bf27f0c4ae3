"""Queries over the judgment log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.operators import judging as J
from weftline.operators import quality as Q
from weftline.runtime import materialize
from weftline.sources.tables import table

KEEP = ["judgment_id", "decision", "confidence", "evidence", "shortlist_reason"]
DETAIL = [*KEEP, "rationale", "notes"]
ORDER = ["created_at", "appended_at", "judgment_id"]


def consolidated(spark: SparkSession, d: str, keep: list[str] = KEEP) -> DataFrame:
    """The newest judgment of every pair, written: what is derived from it reads it and doesn't compute it again."""
    return materialize(J.last_wins(table(spark, d, "company_tag_judgments"), ["company_id", "tag_id"], ORDER, keep), "judgments")


def finalize_last_wins(spark: SparkSession, d: str) -> DataFrame:
    last = J.last_wins(table(spark, d, "company_tag_judgments"), ["company_id", "tag_id"], ORDER, ["judgment_id", "decision", "confidence", "evidence"])
    return last.select("company_id", "tag_id", "judgment_id", "decision", "confidence", F.size("evidence").cast("bigint").alias("quotes"))


_LAST = """
last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY company_id, tag_id ORDER BY created_at DESC, appended_at DESC, judgment_id DESC) AS rn
  FROM company_tag_judgments WHERE company_id IS NOT NULL AND tag_id IS NOT NULL) WHERE rn = 1)"""
_FEATURES = f"""
{_LAST.strip()},
judged AS (SELECT count(DISTINCT company_id) AS n FROM last),
pos AS (SELECT company_id, tag_id, confidence AS c FROM last WHERE decision = 'yes' AND confidence >= 0.55 AND len(evidence) > 0),
prev AS (SELECT tag_id, count(*) AS k FROM pos GROUP BY tag_id),
features AS (SELECT company_id, tag_id, c AS raw_confidence, round(0.5 * c + 0.5 * c * c, 6) AS calibrated_confidence,
  0.15::DOUBLE + 0.85::DOUBLE * least(1.0::DOUBLE, ln(1 / least(1.0::DOUBLE, greatest(1e-6::DOUBLE, k::DOUBLE / n))) / ln(1e6::DOUBLE)) AS w FROM pos JOIN prev USING (tag_id), judged)"""


def sparse_features(spark: SparkSession, d: str) -> DataFrame:
    """The reference's central quantity: confident, evidenced labels weighted by how much they tell."""
    last = consolidated(spark, d)
    return J.sparse_features(last, last.select("company_id").distinct().count())


def inter_run_stability(spark: SparkSession, d: str) -> DataFrame:
    log = table(spark, d, "company_tag_judgments").where("company_id IS NOT NULL AND tag_id IS NOT NULL")
    return J.inter_run_stability(log)


def evidence_verification(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").where("company_id IS NOT NULL").select(F.concat("company_id", F.lit("#"), "doc_kind").alias("document_id"), "text")
    judged = table(spark, d, "company_tag_judgments").where(F.size("evidence") > 0)
    return J.verified_evidence(judged, docs).groupBy("judgment_id").agg(F.count(F.lit(1)).alias("quotes"), F.count_if("verified").alias("verified"))


def gold_scores(spark: SparkSession, d: str) -> DataFrame:
    """The newest judgment of every pair against the first one, taken as the gold label."""
    log = table(spark, d, "company_tag_judgments").where("company_id IS NOT NULL AND tag_id IS NOT NULL")
    first = log.groupBy("company_id", "tag_id").agg(F.min(F.struct("created_at", "appended_at", "judgment_id", "decision")).alias("s")).select("company_id", "tag_id", "s.decision")
    return J.gold_scores(consolidated(spark, d), first)


def quality_metrics(spark: SparkSession, d: str) -> DataFrame:
    last = consolidated(spark, d)
    companies = last.select("company_id").distinct().count()
    return Q.quality_report(companies, table(spark, d, "tags"), J.sparse_features(last, companies), last).withColumn("value", F.round("value", 6))


def quality_details(spark: SparkSession, d: str) -> DataFrame:
    """The parts of the quality report that are lists."""
    last = consolidated(spark, d)
    features = J.sparse_features(last, last.select("company_id").distinct().count())
    return Q.report_details(table(spark, d, "tags"), features, inter_run_stability(spark, d), gold_scores(spark, d)).withColumn("value", F.round("value", 6))


def prevalence_top(spark: SparkSession, d: str) -> DataFrame:
    return Q.top_counts(sparse_features(spark, d), "tag_id", 15)


def decision_mix(spark: SparkSession, d: str) -> DataFrame:
    """Decisions by reason, with zero counts kept."""
    return consolidated(spark, d).groupBy("shortlist_reason").agg(*(F.count_if(F.col("decision") == x).alias(x) for x in ("yes", "no", "uncertain")))


def resume_work(spark: SparkSession, d: str) -> DataFrame:
    """Companies that the newest run has not judged yet: left to do after an interruption."""
    log = table(spark, d, "company_tag_judgments")
    newest = log.agg(F.max("run_id")).first()[0]
    done = log.where(F.col("run_id") == newest).select("company_id").where("company_id IS NOT NULL").distinct()
    return table(spark, d, "companies_normalized").select("company_id").distinct().join(done, "company_id", "left_anti")


def judged_pairs_cleaned(spark: SparkSession, d: str) -> DataFrame:
    """Decisions after hygiene: a yes without evidence is uncertain, confidences are clamped; counted by reason."""
    from weftline.functions.scoring import clamp, clean_decision

    log = table(spark, d, "company_tag_judgments")
    clean = log.select("shortlist_reason", clean_decision(F.col("decision"), F.size("evidence")).alias("decision"), clamp(F.col("confidence")).alias("c"))
    return clean.groupBy("shortlist_reason", "decision").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("c"), 6).alias("mean_confidence"))


_NORM = r"""array_to_string(list_filter(list_transform(list_filter(string_split(trim(regexp_replace(lower(regexp_replace(strip_accents(replace(X, '&', ' and ')), '[^\x00-\x7F]', '', 'g')), '[^a-z0-9]+', ' ', 'g')), ' '), lambda w: w <> ''),
  lambda w: CASE WHEN len(w) > 3 AND w LIKE '%s' AND w NOT LIKE '%ss' THEN w[:-2] ELSE w END), lambda w: w NOT IN ('the', 'a', 'an', 'of', 'for')), ' ')"""


def norm_sql(x: str) -> str:
    return _NORM.replace("X", x, 1)


QUERIES = {f.__name__: f for f in (finalize_last_wins, sparse_features, inter_run_stability, evidence_verification, gold_scores, quality_metrics, quality_details, prevalence_top, decision_mix, resume_work, judged_pairs_cleaned)}
ORACLES = {
    "finalize_last_wins": f"WITH {_LAST} SELECT company_id, tag_id, judgment_id, decision, confidence, len(evidence)::BIGINT AS quotes FROM last",
    "sparse_features": f"WITH {_FEATURES} SELECT company_id, tag_id, raw_confidence, calibrated_confidence, round(w, 6) AS information_weight, round(calibrated_confidence * w, 6) AS feature_value FROM features",
    "inter_run_stability": """WITH p AS (SELECT count(*) AS n, min(decision) AS a, max(decision) AS b, max(confidence) - min(confidence) AS x FROM company_tag_judgments
      WHERE company_id IS NOT NULL AND tag_id IS NOT NULL GROUP BY company_id, tag_id HAVING count(*) > 1)
      SELECT count(*) AS repeated_pairs, round(avg(CASE WHEN a = b THEN 1.0::DOUBLE ELSE 0 END), 4) AS decision_agreement, round(avg(x), 4) AS mean_confidence_delta FROM p""",
    "evidence_verification": f"""WITH q AS (SELECT DISTINCT judgment_id, e.document_id AS document_id, substr(e.quote, 1, 240) AS quote FROM (SELECT judgment_id, unnest(evidence) AS e FROM company_tag_judgments)),
      k AS (SELECT *, {norm_sql("quote")} AS nq FROM q), t AS (SELECT company_id || '#' || doc_kind AS document_id, {norm_sql("text")} AS nt FROM documents WHERE company_id IS NOT NULL AND text IS NOT NULL),
      v AS (SELECT k.judgment_id, k.document_id, k.quote, coalesce(bool_or(len(nq) > 0 AND contains(nt, nq)), false) AS ok FROM k LEFT JOIN t USING (document_id) GROUP BY ALL)
      SELECT judgment_id, count(*) AS quotes, count(*) FILTER (WHERE ok) AS verified FROM v GROUP BY judgment_id""",
    "gold_scores": f"""WITH {_LAST}, g AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY company_id, tag_id ORDER BY created_at, appended_at, judgment_id, decision) AS r1
      FROM company_tag_judgments WHERE company_id IS NOT NULL AND tag_id IS NOT NULL) WHERE r1 = 1),
      c AS (SELECT count(*) AS matched_pairs, count(*) FILTER (WHERE l.decision = 'yes' AND g.decision = 'yes') AS tp, count(*) FILTER (WHERE l.decision = 'yes' AND g.decision <> 'yes') AS fp,
        count(*) FILTER (WHERE l.decision <> 'yes' AND g.decision = 'yes') AS fn FROM last l JOIN g USING (company_id, tag_id)),
      r AS (SELECT *, tp / nullif(tp + fp, 0)::DOUBLE AS p, tp / nullif(tp + fn, 0)::DOUBLE AS q FROM c)
      SELECT matched_pairs, tp, fp, fn, round(p, 6) AS "precision", round(q, 6) AS recall, round(2 * p * q / nullif(p + q, 0), 6) AS f1 FROM r""",
    "quality_metrics": f"""WITH {_FEATURES}, j AS (SELECT count(*) AS judgments, count(*) FILTER (WHERE decision = 'yes') AS yes, count(*) FILTER (WHERE decision = 'no') AS no, count(*) FILTER (WHERE decision = 'uncertain') AS unc,
        count(*) FILTER (WHERE decision = 'yes' AND len(evidence) > 0) AS ev, count(*) FILTER (WHERE shortlist_reason = 'hard_negative') AS hard,
        count(*) FILTER (WHERE shortlist_reason = 'hard_negative' AND decision = 'yes') AS hy, count(DISTINCT company_id) AS companies FROM last),
      t AS (SELECT count(*) FILTER (WHERE state = 'active') AS active, count(*) FILTER (WHERE state = 'candidate') AS cand, count(*) FILTER (WHERE state = 'merged') AS merged FROM tags),
      f AS (SELECT count(*) AS assignments FROM features), k AS (SELECT tag_id, count(*) AS k FROM features GROUP BY tag_id),
      a AS (SELECT count(*) FILTER (WHERE k IS NULL) AS orphans, quantile_cont(coalesce(k, 0), 0.5) AS med FROM tags LEFT JOIN k USING (tag_id) WHERE state = 'active'),
      d AS (SELECT count(*) AS dup FROM (SELECT {norm_sql("canonical_name")} AS nk FROM tags WHERE state = 'active' GROUP BY nk HAVING count(DISTINCT tag_id) > 1)),
      m AS (SELECT [{{'m': 'companies', 'v': companies::DOUBLE}}, {{'m': 'active_tags', 'v': active}}, {{'m': 'candidate_tags', 'v': cand}}, {{'m': 'merged_tags', 'v': merged}}, {{'m': 'assignments', 'v': assignments}},
        {{'m': 'assignments_per_company', 'v': round(assignments / greatest(1, companies)::DOUBLE, 2)}}, {{'m': 'judgments', 'v': judgments}}, {{'m': 'yes', 'v': yes}}, {{'m': 'no', 'v': no}}, {{'m': 'uncertain', 'v': unc}},
        {{'m': 'uncertain_rate', 'v': round(unc / greatest(1, judgments)::DOUBLE, 4)}}, {{'m': 'evidence_coverage', 'v': round(ev / greatest(1, yes)::DOUBLE, 4)}}, {{'m': 'orphan_tag_rate', 'v': round(orphans / greatest(1, active)::DOUBLE, 4)}},
        {{'m': 'duplicate_tag_rate', 'v': round(dup / greatest(1, active)::DOUBLE, 4)}}, {{'m': 'hard_negatives_judged', 'v': hard}}, {{'m': 'hard_negative_acceptance_rate', 'v': round(hy / greatest(1, hard)::DOUBLE, 4)}},
        {{'m': 'tag_prevalence_median', 'v': med}}] AS l FROM j, t, f, a, d)
      SELECT x.m AS metric, x.v::DOUBLE AS "value" FROM (SELECT unnest(l) AS x FROM m)""",
    "quality_details": f"""WITH {_FEATURES}, g AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY company_id, tag_id ORDER BY created_at, appended_at, judgment_id, decision) AS r1 FROM company_tag_judgments WHERE company_id IS NOT NULL AND tag_id IS NOT NULL) WHERE r1 = 1),
      gc AS (SELECT count(*) AS m, count(*) FILTER (WHERE l.decision = 'yes' AND g.decision = 'yes') AS tp, count(*) FILTER (WHERE l.decision = 'yes' AND g.decision <> 'yes') AS fp, count(*) FILTER (WHERE l.decision <> 'yes' AND g.decision = 'yes') AS fn FROM last l JOIN g USING (company_id, tag_id)),
      gr AS (SELECT *, tp / nullif(tp + fp, 0)::DOUBLE AS p, tp / nullif(tp + fn, 0)::DOUBLE AS q FROM gc),
      st AS (SELECT count(*) AS n, round(avg(CASE WHEN a = b THEN 1.0::DOUBLE ELSE 0 END), 4) AS x, round(avg(c), 4) AS y FROM (SELECT count(*) AS n, min(decision) AS a, max(decision) AS b, max(confidence) - min(confidence) AS c FROM company_tag_judgments WHERE company_id IS NOT NULL AND tag_id IS NOT NULL GROUP BY company_id, tag_id HAVING count(*) > 1)),
      du AS (SELECT {norm_sql("canonical_name")} AS nk, count(DISTINCT tag_id) AS n FROM tags WHERE state = 'active' GROUP BY 1 HAVING count(DISTINCT tag_id) > 1)
      SELECT 'facet_distribution' AS metric, facet AS "key", count(*)::DOUBLE AS "value" FROM tags WHERE state = 'active' GROUP BY facet
      UNION ALL SELECT 'tag_prevalence_top', tag_id, n FROM (SELECT tag_id, count(*) AS n FROM features GROUP BY tag_id ORDER BY n DESC, tag_id LIMIT 15)
      UNION ALL SELECT 'orphan_tags', tag_id, 0 FROM (SELECT tag_id FROM tags WHERE state = 'active' AND tag_id NOT IN (SELECT tag_id FROM features) ORDER BY tag_id LIMIT 20)
      UNION ALL SELECT 'duplicate_tag_groups', nk, n FROM (SELECT * FROM du ORDER BY nk LIMIT 10)
      UNION ALL SELECT 'inter_run_stability', unnest(['repeated_pairs', 'decision_agreement', 'mean_confidence_delta']), unnest([n::DOUBLE, x, y]) FROM st
      UNION ALL SELECT 'reviewed_sample', unnest(['matched_pairs', 'tp', 'fp', 'fn', 'precision', 'recall', 'f1']), unnest([m::DOUBLE, tp, fp, fn, round(p, 6), round(q, 6), round(2 * p * q / nullif(p + q, 0), 6)]) FROM gr""",
    "prevalence_top": f"""WITH {_FEATURES} SELECT tag_id AS "value", count(*) AS n FROM features GROUP BY tag_id ORDER BY n DESC, tag_id LIMIT 15""",
    "decision_mix": f"""WITH {_LAST} SELECT shortlist_reason, count(*) FILTER (WHERE decision = 'yes') AS yes, count(*) FILTER (WHERE decision = 'no') AS no,
      count(*) FILTER (WHERE decision = 'uncertain') AS uncertain FROM last GROUP BY shortlist_reason""",
    "resume_work": "SELECT DISTINCT company_id FROM companies_normalized WHERE company_id NOT IN (SELECT company_id FROM company_tag_judgments WHERE company_id IS NOT NULL AND run_id = (SELECT max(run_id) FROM company_tag_judgments))",
    "judged_pairs_cleaned": """SELECT shortlist_reason, CASE WHEN decision IS NULL THEN 'uncertain' WHEN decision = 'yes' AND coalesce(len(evidence), 0) = 0 THEN 'uncertain' ELSE decision END AS decision,
      count(*) AS n, round(avg(greatest(0.0::DOUBLE, least(1.0::DOUBLE, coalesce(confidence, 0)))), 6) AS mean_confidence FROM company_tag_judgments GROUP BY 1, 2""",
}
