"""Discovery and lifecycle of tags as table transformations: candidates, aliases, states, migrations.

Every change returns a new tag table; ids never change. Applying the same change twice gives the
same table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions.text import clean, closest_facet, display_name, normalize_name, slugify


def _strings(c: str | Column) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.array().cast("array<string>"))


def validated_candidates(proposals: DataFrame, facets: list[str]) -> DataFrame:
    """Raw proposals that hold: a name of 2 characters, a definition of 20, a known facet, support within the batch.

    ``proposals``: name, facet, definition, supporting_company_ids, batch_company_ids (what was shown).
    """
    support = F.array_sort(F.array_distinct(F.array_intersect(_strings("supporting_company_ids"), _strings("batch_company_ids"))))
    out = proposals.select(
        display_name(F.col("name")).alias("proposed_name"), closest_facet(F.col("facet"), facets).alias("facet"), F.coalesce(clean(F.col("definition")), F.lit("")).alias("definition"), support.alias("support_company_ids")
    ).where((F.length("proposed_name") >= 2) & (F.length("definition") >= 20) & F.col("facet").isNotNull() & (F.size("support_company_ids") > 0))
    return out.select(F.concat("facet", F.lit(":"), slugify(F.col("proposed_name"))).alias("candidate_id"), "*", normalize_name(F.col("proposed_name")).alias("normalized_name"))


def accumulate_candidates(candidates: DataFrame) -> DataFrame:
    """One row per candidate id; repeated proposals add their support (a set union, exploded so it combines before the shuffle)."""
    head = candidates.groupBy("candidate_id").agg(*(F.min(F.struct("proposed_name", "definition", "facet")).alias("s"),)).select("candidate_id", "s.*")
    long = candidates.select("candidate_id", F.explode("support_company_ids").alias("c"))
    sets = long.groupBy("candidate_id").agg(F.sort_array(F.collect_set("c")).alias("support_company_ids"))
    return head.join(sets, "candidate_id", "left").withColumn("support_count", F.coalesce(F.size("support_company_ids"), F.lit(0)))


def add_aliases(tags: DataFrame, aliases: DataFrame) -> DataFrame:
    """Tags with more aliases (tag_id, alias): distinct, sorted; names and blanks add nothing."""
    good = aliases.where(normalize_name(F.col("alias")) != "").groupBy("tag_id").agg(F.collect_set("alias").alias("_more"))
    merged = F.array_sort(F.array_distinct(F.concat(_strings("aliases"), F.filter(_strings("_more"), lambda a: a != F.col("canonical_name")))))
    return tags.join(good, "tag_id", "left").withColumn("aliases", merged).drop("_more")


def alias_table(tags: DataFrame) -> DataFrame:
    """alias_id, tag_id, alias, normalized_alias of every name and alias that normalises to something."""
    rows = tags.select("tag_id", F.explode(F.array_distinct(F.concat(F.array("canonical_name"), _strings("aliases")))).alias("alias"))
    out = rows.select(F.concat("tag_id", F.lit(":"), slugify(F.col("alias"))).alias("alias_id"), "tag_id", "alias", normalize_name(F.col("alias")).alias("normalized_alias")).where("normalized_alias <> ''")
    return out.groupBy("alias_id").agg(F.min(F.struct("tag_id", "alias", "normalized_alias")).alias("s")).select("alias_id", "s.*")


def deprecate(tags: DataFrame, reasons: DataFrame) -> DataFrame:
    """Tags of ``reasons`` (tag_id, reason) become deprecated and keep the reason."""
    r = reasons.groupBy("tag_id").agg(F.min("reason").alias("_reason"))
    out = tags.join(r, "tag_id", "left").withColumn("state", F.when(F.col("_reason").isNotNull(), "deprecated").otherwise(F.col("state")))
    old = F.col("deprecation_reason") if "deprecation_reason" in tags.columns else F.lit(None).cast("string")
    return out.withColumn("deprecation_reason", F.coalesce("_reason", old)).drop("_reason")


def normalize_display_names(tags: DataFrame) -> DataFrame:
    """Names formatted again; a spelling that no longer resolves to the new name's key stays as an alias."""
    better = display_name(F.col("canonical_name"))
    renamed = (better != "") & (better != F.col("canonical_name"))
    kept = F.when(renamed & (normalize_name(better) != normalize_name(F.col("canonical_name"))), F.array("canonical_name")).otherwise(F.array().cast("array<string>"))
    return tags.withColumn("_old", kept).withColumn("_new", F.when(renamed, better).otherwise(F.col("canonical_name"))).withColumn("aliases", F.array_sort(F.array_distinct(F.concat(_strings("aliases"), "_old")))).withColumn("canonical_name", F.col("_new")).drop("_old", "_new")


MIGRATIONS: dict[str, Callable[[DataFrame], DataFrame]] = {"normalize-display-names": normalize_display_names}


def migrate(tags: DataFrame, name: str, dry_run: bool = False) -> tuple[DataFrame, DataFrame]:
    """(tags after the migration, or as they were in a dry run; changes: tag_id, before, after)."""
    after = MIGRATIONS[name](tags)
    changes = tags.select("tag_id", F.col("canonical_name").alias("before")).join(after.select("tag_id", F.col("canonical_name").alias("after")), "tag_id").where("before <> after")
    return (tags if dry_run else after), changes
