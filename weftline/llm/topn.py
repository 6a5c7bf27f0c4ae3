"""Top N items within every group.

The best score of every (group, item) is taken first (combined before the shuffle) and written in
score bands cut at quantiles of all scores. Bands are processed from the highest: rows of groups
that are already filled are anti-joined away, so most groups never read their lower bands. What is
left of a band is ranked exactly (score descending, then item ascending), with Spark's group limit
keeping N rows per group and task before the shuffle; so a group of millions of tied items is
never gathered in one task.

Defined cases: rows with a null group, item or score, or a NaN score, don't count; a repeated
(group, item) counts once with its highest score; ties are broken by item ascending; a group with
fewer than N items keeps them all; empty input gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.runtime import materialize, release, rows_of, salted_join

#: Shares of all rows above which the bands are cut, from the top.
BANDS = (0.02, 0.1, 0.3, 0.6)


def _ranked(rows: DataFrame, n: int) -> DataFrame:
    w = Window.partitionBy("grp").orderBy(F.desc("score"), F.asc("item"))
    return rows.withColumn("place", F.row_number().over(w)).where(F.col("place") <= n)


def top_n_per_group(rows: DataFrame, group: str, item: str, score: str, n: int, bands: tuple[float, ...] = BANDS) -> DataFrame:
    """grp, item, score, place (1..n) for every group."""
    clean = rows.select(rows[group].alias("grp"), rows[item].alias("item"), rows[score].cast("double").alias("score"))
    clean = clean.where("grp IS NOT NULL AND item IS NOT NULL AND score IS NOT NULL AND NOT isnan(score)")
    best = materialize(clean.groupBy("grp", "item").agg(F.max("score").alias("score")), "scores")
    cuts = best.agg(F.percentile_approx("score", [1 - b for b in bands], 10_000)).first()[0] or []
    cuts = sorted(set(cuts), reverse=True)
    band = sum((F.when(F.col("score") < c, 1).otherwise(0) for c in cuts), F.lit(0))
    banded = materialize(best.withColumn("band", band.cast("int")), "bands", ["band"])
    release(best)
    groups = banded.select("grp").distinct().count()
    taken: list[DataFrame] = []
    filled: DataFrame | None = None
    for b in range(len(cuts) + 1):
        part = banded.where(F.col("band") == b).drop("band")
        if filled is not None:
            part = salted_join(part, filled.select("grp"), ["grp"], "left_anti")
        taken.append(materialize(_ranked(part, n).drop("place"), "taken"))
        counts = reduce(DataFrame.unionByName, taken).groupBy("grp").agg(F.count(F.lit(1)).alias("have"))
        old, filled = filled, materialize(counts.where(F.col("have") >= n), "filled")
        release(old)
        if rows_of(filled) == groups:
            break
    out = materialize(_ranked(reduce(DataFrame.unionByName, taken), n), "top")
    release(banded, filled, *taken)
    return out
