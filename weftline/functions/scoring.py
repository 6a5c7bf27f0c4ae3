"""Weights, calibration and relations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def information_weight(prevalence: Column, floor: float = 0.15) -> Column:
    """Rare labels weigh more: floor .. 1 over prevalences of 1 .. one in a million."""
    p = F.least(F.lit(1.0), F.greatest(F.lit(1e-6), prevalence.cast("double")))
    return F.lit(floor) + F.lit(1 - floor) * F.least(F.lit(1.0), F.log(1 / p) / F.log(F.lit(1e6)))


def calibrate(confidence: Column, decision: Column) -> Column:
    """Half the confidence and half its square for a yes, nothing otherwise."""
    c = confidence.cast("double")
    return F.when(decision == "yes", F.round(0.5 * c + 0.5 * c * c, 6)).otherwise(F.lit(0.0))


def relation(same_name: Column, similarity: Column, kind: Column) -> Column:
    """How a source term relates to a tag, by name and similarity."""
    return (
        F.when(same_name | (similarity >= 0.90), "equivalent")
        .when((similarity >= 0.78) & kind.isin("industry", "subindustry", "batch"), "narrower")
        .when(similarity >= 0.78, "overlaps").when(similarity >= 0.68, "related")
    )


def clean_decision(decision: Column, evidence_count: Column) -> Column:
    """A yes without evidence is uncertain; so is an absent judgment."""
    d = F.coalesce(decision, F.lit("uncertain"))
    return F.when((d == "yes") & (F.coalesce(evidence_count, F.lit(0)) == 0), "uncertain").otherwise(d)


def clamp(c: Column, lo: float = 0.0, hi: float = 1.0) -> Column:
    return F.greatest(F.lit(lo), F.least(F.lit(hi), F.coalesce(c, F.lit(lo))))
