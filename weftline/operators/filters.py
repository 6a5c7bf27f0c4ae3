"""The interactive filter: a specification, its URL form, its predicate, facet counts and pages."""

from __future__ import annotations

from dataclasses import dataclass, field, fields
from functools import reduce
from urllib.parse import parse_qs, urlencode

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.runtime import row_numbers, salted_join

_LISTS = ("batches", "industries", "subindustries", "statuses", "stages", "regions", "clusters", "tags", "facets", "ids")


@dataclass
class FilterSpec:
    """What a user chose. Empty fields don't filter."""

    q: str = ""
    batches: list[str] = field(default_factory=list)
    year_from: int | None = None
    year_to: int | None = None
    industries: list[str] = field(default_factory=list)
    subindustries: list[str] = field(default_factory=list)
    statuses: list[str] = field(default_factory=list)
    stages: list[str] = field(default_factory=list)
    regions: list[str] = field(default_factory=list)
    clusters: list[str] = field(default_factory=list)
    tags: list[str] = field(default_factory=list)
    tag_mode: str = "and"
    facets: list[str] = field(default_factory=list)
    min_score: float = 0.0
    top_company: bool = False
    is_hiring: bool = False
    nonprofit: bool = False
    ids: list[str] = field(default_factory=list)

    def to_query(self) -> str:
        out = {}
        for f in fields(self):
            v = getattr(self, f.name)
            if v in ("", [], None, False, 0.0) or (f.name == "tag_mode" and v == "and"):
                continue
            out[f.name] = "~".join(v) if isinstance(v, list) else "1" if v is True else str(v)
        return urlencode(out)

    @classmethod
    def from_query(cls, query: str) -> FilterSpec:
        """Malformed numbers become no filter."""
        got = {k: v[0] for k, v in parse_qs(query.lstrip("?")).items()}
        out = cls(q=got.get("q", ""), tag_mode="or" if got.get("tag_mode") == "or" else "and")
        for k in _LISTS:
            setattr(out, k, [x for x in got.get(k, "").split("~") if x])
        for k in ("year_from", "year_to"):
            v = got.get(k, "")
            setattr(out, k, int(v) if v.isdigit() else None)
        try:
            out.min_score = float(got.get("min_score", 0))
        except ValueError:
            out.min_score = 0.0
        for k in ("top_company", "is_hiring", "nonprofit"):
            setattr(out, k, got.get(k) == "1")
        return out

    def active(self) -> int:
        """How many fields filter."""
        names = [f.name for f in fields(self) if f.name != "tag_mode"]
        return sum(getattr(self, n) not in ("", [], None, False, 0.0) for n in names)


def surviving_tags(spec: FilterSpec) -> Column:
    """Tags whose score reaches the threshold (positions of tag_ids and tag_scores)."""
    if spec.min_score <= 0:
        return F.coalesce("tag_ids", F.array().cast("array<string>"))
    zipped = F.filter(F.arrays_zip("tag_ids", "tag_scores"), lambda z: z["tag_scores"] >= spec.min_score)
    return F.coalesce(F.transform(zipped, lambda z: z["tag_ids"]), F.array().cast("array<string>"))


def predicate(spec: FilterSpec, skip: str | None = None) -> Column:
    """One conjunction, cheap scalar tests first (they reach the Parquet scan). ``skip`` leaves one field out."""
    c, p = F.col, []

    def add(name: str, test: Column) -> None:
        if name != skip:
            p.append(test)

    if spec.batches:
        add("batches", c("batch").isin(*spec.batches))
    if spec.year_from is not None:
        add("years", c("batch_year") >= spec.year_from)
    if spec.year_to is not None:
        add("years", c("batch_year") <= spec.year_to)
    if spec.industries or spec.subindustries:  # one list: a name counts at either level
        names = list(dict.fromkeys([*spec.industries, *spec.subindustries]))
        add("industries", F.coalesce(c("industry").isin(*names), F.lit(False)) | F.coalesce(c("subindustry").isin(*names), F.lit(False)))
    if spec.statuses:
        add("statuses", F.coalesce("status", F.lit("")).isin(*spec.statuses))
    if spec.stages:
        add("stages", F.coalesce("stage", F.lit("")).isin(*spec.stages))
    for flag in ("top_company", "is_hiring", "nonprofit"):
        if getattr(spec, flag):
            add(flag, c(flag))
    if spec.ids:
        add("ids", c("company_id").isin(*spec.ids))
    if spec.clusters:
        add("clusters", c("cluster_id").cast("string").isin(*spec.clusters))
    if spec.regions:
        add("regions", F.arrays_overlap("regions", F.array(*map(F.lit, spec.regions))))
    if spec.min_score > 0:
        add("min_score", F.size(surviving_tags(spec)) > 0)
    if spec.tags:
        wanted = F.array(*map(F.lit, dict.fromkeys(spec.tags)))
        have = surviving_tags(spec)
        add("tags", F.size(F.array_intersect(have, wanted)) == len(set(spec.tags)) if spec.tag_mode == "and" else F.size(F.array_intersect(have, wanted)) > 0)
    return reduce(lambda a, b: a & b, p, F.lit(True))


def apply_filters(companies: DataFrame, spec: FilterSpec, tags: DataFrame | None = None) -> DataFrame:
    """Companies that pass. A facet filter semi-joins their surviving tags with those of the facets in ``tags``."""
    out = companies.where(predicate(spec))
    if spec.facets and tags is not None:
        of = tags.where(F.col("facet").isin(*spec.facets)).select("tag_id").distinct()
        hits = salted_join(out.select("company_id", F.explode(F.array_distinct(surviving_tags(spec))).alias("tag_id")), of, ["tag_id"], "left_semi")
        out = out.join(hits.select("company_id").distinct(), "company_id", "left_semi")
    return out


def facet_counts(companies: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """facet, value, n: all facets in one pass (each row unpivots to its values); arrays count each distinct value."""

    def named(k: str, a: Column) -> Column:
        return F.transform(F.array_distinct(a), lambda v: F.struct(F.lit(k).alias("facet"), v.alias("value")))

    rows = companies.select(F.explode(F.flatten(F.array(*(named(k, a) for k, a in columns.items())))).alias("f")).select("f.*").where("value IS NOT NULL AND value <> ''")
    return rows.groupBy("facet", "value").agg(F.count(F.lit(1)).alias("n"))


def page(rows: DataFrame, order: list[Column], number: int, first: int = 50, more: int = 200) -> DataFrame:
    """Page 0 has ``first`` rows, later pages ``more`` each (a top-k, not a full sort)."""
    if number == 0:
        return rows.orderBy(*order).limit(first)
    return rows.orderBy(*order).limit(first + number * more).offset(first + (number - 1) * more)


def tag_text_filter(tags: DataFrame, facet: str | None, text: str, used_only: bool, prevalence: DataFrame | None = None) -> DataFrame:
    """Tags of a facet whose name, definition or an alias contains a text."""
    low = text.lower()
    out = tags
    if facet:
        out = out.where(F.col("facet") == facet)
    if used_only and prevalence is not None:
        out = out.join(prevalence.where("prevalence > 0").select("tag_id"), "tag_id", "left_semi")
    hit = F.lower("canonical_name").contains(low) | F.lower("definition").contains(low) | F.coalesce(F.exists("aliases", lambda a: F.lower(a).contains(low)), F.lit(False))
    return out.where(hit) if low else out


def pinned_first(tags: DataFrame, selected: list[str], text: str, limit: int = 60) -> DataFrame:
    """Selected tags first, then those that match, up to the picker's size."""
    chosen = F.col("tag_id").isin(*selected) if selected else F.lit(False)
    return tags.where(chosen | F.lower("canonical_name").contains(text.lower())).orderBy(F.desc(chosen), F.desc("support_count"), "tag_id").limit(limit)


def select_companies(companies: DataFrame, ids: DataFrame | None = None, limit: int | None = None) -> DataFrame:
    """Companies of a table of ids, or the first so many by id (the limit is what is asked for)."""
    out = companies if ids is None else companies.join(ids.select("company_id").distinct(), "company_id", "left_semi")
    return out if limit is None else out.orderBy("company_id").limit(limit)


def point_index(companies: DataFrame, points: DataFrame) -> DataFrame:
    """Companies with ``position``: their place among the points in the order of ids, -1 without a point."""
    placed = row_numbers(points.select("company_id").distinct(), ["company_id"], "position")
    return companies.join(placed, "company_id", "left").withColumn("position", F.coalesce("position", F.lit(-1).cast("long")))


def facet_groups(tag_rows: DataFrame) -> DataFrame:
    """company_id, facet, tags, size, place: a company's tags by facet, the largest groups first, then by facet."""
    groups = tag_rows.groupBy("company_id", "facet").agg(F.array_sort(F.collect_set("tag_id")).alias("tags")).withColumn("size", F.size("tags").cast("long"))
    w = Window.partitionBy("company_id").orderBy(F.desc("size"), "facet")
    return groups.withColumn("place", F.row_number().over(w).cast("long"))


def tag_legend(companies: DataFrame, tag: str) -> DataFrame:
    """kind, bin, n: companies with and without a tag."""
    has = F.coalesce(F.array_contains("tag_ids", tag), F.lit(False))
    return companies.groupBy(F.when(has, "has tag").otherwise("no tag").alias("bin")).agg(F.count(F.lit(1)).alias("n")).select(F.lit("tag").alias("kind"), "bin", "n")


def cluster_legend(points: DataFrame) -> DataFrame:
    """kind, bin, n: points of every cluster."""
    return points.groupBy(F.col("cluster").cast("string").alias("bin")).agg(F.count(F.lit(1)).alias("n")).select(F.lit("cluster").alias("kind"), "bin", "n")


def legend_bins(companies: DataFrame, largest: int = 23, year_bins: int = 14) -> DataFrame:
    """kind, bin, n: industries (the largest, then Other) and equal year bins; see also ``cluster_legend`` and ``tag_legend``."""
    counts = companies.groupBy(F.coalesce("industry", F.lit("Unknown")).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    ranked = counts.withColumn("r", F.row_number().over(Window.orderBy(F.desc("n"), "v")))  # one row an industry
    industries = ranked.groupBy(F.when(F.col("r") <= largest, F.col("v")).otherwise("Other").alias("bin")).agg(F.sum("n").alias("n")).select(F.lit("industry").alias("kind"), "bin", "n")
    lo, hi = companies.agg(F.min("batch_year"), F.max("batch_year")).first()
    if lo is None:
        return industries
    width = max(1, -(-(hi - lo + 1) // year_bins))
    start = (F.floor((F.col("batch_year") - lo) / width) * width + lo).cast("int").cast("string")
    years = companies.where("batch_year IS NOT NULL").groupBy(start.alias("bin")).agg(F.count(F.lit(1)).alias("n")).select(F.lit("year").alias("kind"), "bin", "n")
    return industries.unionByName(years)
