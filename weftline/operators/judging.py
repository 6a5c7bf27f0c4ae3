"""Judgment log to sparse features: consolidation, weights, evidence, stability, precision.

Defined cases: rows with a null entity or label are dropped; ties in the log are broken by every
ordering column given and then by the whole record; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions.scoring import calibrate, information_weight
from weftline.functions.text import normalize_name
from weftline.runtime import materialize, salted_join


def last_wins(log: DataFrame, keys: Sequence[str], order: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """The newest record of every key: one aggregation, combined before its shuffle."""
    present = log
    for k in keys:
        present = present.where(F.col(k).isNotNull())
    best = F.max(F.struct(*[F.col(c) for c in order], *[F.col(c).alias(f"k_{c}") for c in keep])).alias("_s")
    return present.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_s.k_{c}").alias(c) for c in keep])


def positive(minimum: float = 0.55) -> Column:
    """A confident yes with evidence."""
    return (F.col("decision") == "yes") & (F.col("confidence") >= minimum) & (F.size("evidence") > 0)


def sparse_features(judged: DataFrame, entities: int, entity: str = "company_id", label: str = "tag_id", minimum: float = 0.55) -> DataFrame:
    """entity, label, raw and calibrated confidence, information weight and their product.

    ``entities``: how many entities were judged, the base of a label's prevalence. The prevalence
    is a small aggregate joined back, not a window, so a label of a third of all rows is no
    single task.
    """
    pos = judged.where(positive(minimum)).select(entity, label, F.col("confidence").alias("raw_confidence"))
    counts = pos.groupBy(label).agg(F.count(F.lit(1)).alias("prevalence"))
    joined = salted_join(pos, counts, [label], "inner")
    weight = information_weight(F.col("prevalence") / F.lit(float(max(1, entities))))
    cal = calibrate(F.col("raw_confidence"), F.lit("yes"))
    return joined.select(
        entity, label, "raw_confidence", cal.alias("calibrated_confidence"),
        F.round(weight, 6).alias("information_weight"), F.round(cal * weight, 6).alias("feature_value"),
    )


def verified_evidence(judged: DataFrame, documents: DataFrame) -> DataFrame:
    """Quotes whose normalised text occurs in the cited document: judgment_id, document_id, quote, verified.

    ``documents``: document_id, text. A quote that normalises to nothing is never verified.
    """
    quotes = judged.select("judgment_id", F.explode("evidence").alias("e")).select("judgment_id", "e.document_id", F.substring("e.quote", 1, 240).alias("quote")).distinct()
    wanted = quotes.select("document_id").distinct()
    # Normalise each cited document once, not once a quote; documents nobody cites drop out first. A document with several texts stays several rows.
    docs = documents.join(wanted, "document_id", "left_semi").where("text IS NOT NULL").select("document_id", normalize_name(F.col("text")).alias("t")).distinct()
    asked = materialize(quotes.withColumn("q", normalize_name(F.col("quote"))), "quotes")
    hit = (F.length("q") > 0) & F.col("t").contains(F.col("q"))
    rows = salted_join(asked, docs, ["document_id"], "left").select("judgment_id", "document_id", "quote", F.coalesce(hit, F.lit(False)).alias("hit"))
    return rows.groupBy("judgment_id", "document_id", "quote").agg(F.max("hit").alias("verified"))


def inter_run_stability(log: DataFrame, keys: Sequence[str] = ("company_id", "tag_id")) -> DataFrame:
    """One row: pairs judged more than once, share with one decision, mean confidence range."""
    per = log.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.min("decision").alias("lo"), F.max("decision").alias("hi"),
        (F.max("confidence") - F.min("confidence")).alias("delta"),
    ).where("n > 1")
    return per.agg(
        F.count(F.lit(1)).alias("repeated_pairs"),
        F.round(F.avg(F.when(F.col("lo") == F.col("hi"), 1.0).otherwise(0.0)), 4).alias("decision_agreement"),
        F.round(F.avg("delta"), 4).alias("mean_confidence_delta"),
    )


def gold_scores(judged: DataFrame, gold: DataFrame, keys: Sequence[str] = ("company_id", "tag_id")) -> DataFrame:
    """One row: matched pairs, precision, recall, F1 (null where nothing matched)."""
    g = gold.select(*keys, F.col("decision").alias("gold"))
    m = judged.select(*keys, "decision").join(g, list(keys))
    yes, want = F.col("decision") == "yes", F.col("gold") == "yes"
    c = m.agg(
        F.count(F.lit(1)).alias("matched_pairs"), F.count_if(yes & want).alias("tp"), F.count_if(yes & ~want).alias("fp"), F.count_if(~yes & want).alias("fn")
    )
    p, r = F.col("tp") / F.nullif(F.col("tp") + F.col("fp"), F.lit(0)), F.col("tp") / F.nullif(F.col("tp") + F.col("fn"), F.lit(0))
    return c.select("matched_pairs", "tp", "fp", "fn", F.round(p, 6).alias("precision"), F.round(r, 6).alias("recall"), F.round(2 * p * r / F.nullif(p + r, F.lit(0.0)), 6).alias("f1"))
