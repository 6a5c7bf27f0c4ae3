"""Which labels are worth judging for an entity: six candidate rules, one reason each.

Rules: the best by similarity, the best of every facet, literal alias hits, source-term mappings,
parents of candidates, and seeded hard negatives from the band below the cutoff. The first rule
names the reason. Similarities come as a table, so their kernel is separate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions.text import normalize_name
from weftline.runtime import materialize, salted_join

REASONS = ("retrieval", "facet_prior", "alias", "metadata_rule", "parent", "hard_negative")


def alias_hits(texts: DataFrame, tags: DataFrame, least: int = 4) -> DataFrame:
    """entity, tag_id: tags one of whose normalised names stands in the normalised text.

    Texts are cut into word n-grams of the lengths that aliases have, however long, and joined on
    equality, so no text meets every alias. An alias of several tags belongs to the smallest id.
    """
    names = tags.select("tag_id", F.explode(F.concat(F.array("canonical_name"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("a"))
    keyed = names.select("tag_id", normalize_name(F.col("a")).alias("gram")).where(F.length("gram") >= least).groupBy("gram").agg(F.min("tag_id").alias("tag_id"))
    keyed = materialize(keyed.where("gram <> ''").withColumn("words", F.size(F.split("gram", " "))), "aliases")
    lengths = sorted(r[0] for r in keyed.select("words").distinct().collect())  # one row a length
    if not lengths:
        return texts.select("entity", F.lit(None).cast("string").alias("tag_id")).limit(0)
    words = F.filter(F.split(normalize_name(F.col("text")), " "), lambda w: w != "")
    w = texts.select("entity", words.alias("w")).where(F.size("w") > 0)
    grams = F.array_distinct(F.flatten(F.transform(F.filter(F.array(*map(F.lit, lengths)), lambda n: n <= F.size("w")), lambda n: F.transform(F.sequence(F.lit(1), F.size("w") - n + 1), lambda i: F.array_join(F.slice("w", i, n), " ")))))
    rows = w.select("entity", F.explode(grams).alias("gram"))
    return salted_join(rows, keyed.drop("words"), ["gram"], "inner").select("entity", "tag_id").distinct()


def mapped_tags(entity_terms: DataFrame, mappings: DataFrame, tags: DataFrame) -> DataFrame:
    """entity, tag_id: tags that a source term of the entity maps to closely enough."""
    m = mappings.where(F.col("relation").isin("equivalent", "narrower", "overlaps")).select("term_id", "tag_id").distinct().join(tags.select("tag_id"), "tag_id", "left_semi")
    return salted_join(entity_terms.select("entity", "term_id").distinct(), m, ["term_id"], "inner").select("entity", "tag_id").distinct()


def shortlist(
    sims: DataFrame, aliases: DataFrame | None = None, mapped: DataFrame | None = None, parents: DataFrame | None = None, size: int = 24, hard_negatives: int = 4, seed: int = 20240917
) -> DataFrame:
    """entity, tag_id, reason, score. ``sims``: entity, tag_id, facet, score; ``parents``: tag_id, parent_id.

    Hard negatives are drawn by a hash of seed, entity and tag, so a rerun or resume draws alike.
    """
    w = Window.partitionBy("entity").orderBy(F.desc("score"), "tag_id")
    ranked = sims.withColumn("rank", F.row_number().over(w))
    base = ranked.select("entity", "tag_id", "score", "rank")
    best = sims.groupBy("entity", "facet").agg(F.min_by("tag_id", F.struct((-F.col("score")).alias("a"), "tag_id")).alias("tag_id"))
    picked = ranked.where(F.col("rank") <= size).select("entity", "tag_id", F.lit(0).alias("prio")).unionByName(best.select("entity", "tag_id", F.lit(1).alias("prio")))
    for extra, prio in ((aliases, 2), (mapped, 3)):
        if extra is not None:
            picked = picked.unionByName(extra.select("entity", "tag_id", F.lit(prio).alias("prio")))
    if parents is not None:
        up = picked.select("entity", "tag_id").join(parents, "tag_id").select("entity", F.col("parent_id").alias("tag_id"), F.lit(4).alias("prio"))
        picked = picked.unionByName(up)
    picked = picked.groupBy("entity", "tag_id").agg(F.min("prio").alias("prio"))
    band = ranked.where((F.col("rank") > size) & (F.col("rank") <= 3 * size)).join(picked, ["entity", "tag_id"], "left_anti")
    h = Window.partitionBy("entity").orderBy(F.sha2(F.concat_ws("|", F.lit(str(seed)), F.col("entity").cast("string"), F.col("tag_id").cast("string")), 256))
    hard = band.withColumn("n", F.row_number().over(h)).where(F.col("n") <= hard_negatives).select("entity", "tag_id", F.lit(5).alias("prio"))
    names = F.array(*map(F.lit, REASONS))
    out = picked.unionByName(hard).join(base, ["entity", "tag_id"])
    return out.select("entity", "tag_id", F.element_at(names, F.col("prio") + 1).alias("reason"), F.round("score", 6).alias("score"))


def stratified_round_robin(rows: DataFrame, key: str, strata: list[str], size: int, seed: int = 20240917) -> DataFrame:
    """A reproducible sample: every stratum gives one member before any gives two.

    Members of a stratum and the strata themselves are ordered by sha256 of the seed with their
    key, so the result doesn't depend on partitioning.
    """
    s = F.concat_ws("|", F.lit(str(seed)), *(F.col(c).cast("string") for c in strata))
    w = Window.partitionBy(*strata).orderBy(F.sha2(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")), 256), key)
    ranked = rows.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= size).withColumn("_s", F.sha2(s, 256))
    return ranked.orderBy("_n", "_s").limit(size).drop("_n", "_s")


def term_mapping(sims: DataFrame, most: int = 3) -> DataFrame:
    """term_id, tag_id, relation, similarity, rank: the nearest tags of a term that are close enough.

    ``sims``: term_id, kind, term_name, tag_id, tag_name, similarity.
    """
    from weftline.functions.scoring import relation

    w = Window.partitionBy("term_id").orderBy(F.desc("similarity"), "tag_id")
    top = sims.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= most)
    same = normalize_name(F.col("term_name")) == normalize_name(F.col("tag_name"))
    return top.withColumn("relation", relation(same, F.col("similarity"), F.col("kind"))).where("relation IS NOT NULL").select("term_id", "tag_id", "relation", F.round("similarity", 6).alias("similarity"), "rank")
