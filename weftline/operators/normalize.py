"""Raw directory payloads to typed rows, source documents and taxonomy terms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions.hashing import stable_hash
from weftline.functions.text import batch_season, batch_slug, batch_year, clean, non_negative_int, slugify, string_list

PAYLOAD = (
    "id BIGINT, name STRING, slug STRING, former_names ARRAY<STRING>, small_logo_thumb_url STRING, website STRING, url STRING, all_locations STRING, "
    "one_liner STRING, long_description STRING, team_size STRING, industry STRING, subindustry STRING, industries ARRAY<STRING>, regions ARRAY<STRING>, "
    "tags ARRAY<STRING>, batch STRING, status STRING, stage STRING, isHiring BOOLEAN, nonprofit BOOLEAN, top_company BOOLEAN, launched_at DOUBLE"
)
#: The kinds of evidence documents and the columns that hold them.
DOCUMENT_KINDS = {"yc_one_liner": "one_liner", "yc_long_description": "long_description", "metadata_document": "metadata_document", "website_main_text": "website_text"}


def parse_payloads(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, rejected): a record needs to be an object with an id and a name; other fields may drift."""
    parsed = raw.withColumn("p", F.from_json("payload", PAYLOAD, {"mode": "PERMISSIVE"}))
    object_ = F.coalesce(F.ltrim("payload").startswith("{"), F.lit(False)) & F.col("p").isNotNull()
    ok = object_ & F.col("p.id").isNotNull() & clean(F.col("p.name")).isNotNull()
    reason = F.when(~object_, "not an object").when(F.col("p.id").isNull(), "no id").otherwise("no name")
    return parsed.where(ok), parsed.where(~ok).select("company_id", reason.alias("error"))


def metadata_document(directory: str = "directory") -> Column:
    """Publishable fields as fixed sentences in a fixed order; prose is left out. Over normalised columns."""
    c = F.col
    extra = F.array_except(F.coalesce("industries", F.array().cast("array<string>")), F.array(c("industry")))
    listed = lambda a: F.array_join(a, ", ")
    filled = lambda a: F.size(F.coalesce(a, F.array().cast("array<string>"))) > 0
    say = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))
    return F.concat_ws(
        " ",
        say(c("name"), f" is a {directory} company."),
        F.when(c("batch").isNotNull(), F.when(c("batch_year").isNotNull(), say("It participated in the ", c("batch"), " batch, in ", c("batch_year").cast("string"), ".")).otherwise(say("It participated in the ", c("batch"), " batch."))),
        say("Its status is ", F.lower("status"), "."),
        say("Its stage is ", F.lower("stage"), "."),
        say(f"The {directory} lists its industry as ", c("industry"), "."),
        F.when(~c("subindustry").eqNullSafe(c("industry")), say("Its sub-industry is ", F.trim(F.replace(c("subindustry"), F.lit("->"), F.lit("within"))), ".")),
        F.when(filled(extra), say("Additional listed industries: ", listed(extra), ".")),
        F.when(filled(c("source_tags")), say(f"The {directory}'s source tags: ", listed(c("source_tags")), ".")),
        say("It is located in ", c("all_locations"), "."),
        F.when(filled(c("regions")), say("Listed regions: ", listed(c("regions")), ".")),
        say("Its team size is ", c("team_size").cast("string"), "."),
        F.when(c("nonprofit"), "It is a nonprofit."),
        F.when(c("top_company"), f"The {directory} lists it as a top company."),
        F.when(c("is_hiring"), "It is currently hiring."),
        say("It launched in ", F.year("launched_at").cast("string"), "."),
    )


def term_ids() -> Column:
    """``kind:slug`` of every listed category, distinct, in a fixed order of kinds."""
    one = lambda kind, x: F.when(x.isNotNull(), F.array(F.concat(F.lit(f"{kind}:"), slugify(x)))).otherwise(F.array().cast("array<string>"))
    many = lambda kind, a: F.transform(a, lambda x: F.concat(F.lit(f"{kind}:"), slugify(x)))
    c = F.col
    return F.array_distinct(F.concat(
        one("industry", c("industry")), many("industry", c("industries")), one("subindustry", c("subindustry")), many("tag", c("source_tags")),
        one("batch", c("batch")), many("region", c("regions")), one("stage", c("stage")), one("status", c("status")),
    ))


def normalize_companies(good: DataFrame, directory: str = "directory", keys: tuple[str, ...] = ()) -> DataFrame:
    """The typed row of every parsed payload, with documents, term ids and a content hash; ``keys`` are carried along, unhashed."""
    p = lambda n: F.col(f"p.{n}")
    launched = F.when((p("launched_at") > 0) & (p("launched_at") < 253402300800.0), F.timestamp_seconds(p("launched_at")))
    batch = clean(p("batch"))
    out = good.select(
        *keys, "company_id", p("id").alias("yc_id"), F.coalesce(clean(p("slug")), slugify(p("name"))).alias("slug"), clean(p("name")).alias("name"),
        string_list(p("former_names")).alias("former_names"), *(clean(p(n)).alias(n) for n in ("one_liner", "long_description", "website", "all_locations", "status", "stage", "industry", "subindustry")),
        clean(p("url")).alias("url"), clean(p("small_logo_thumb_url")).alias("logo_url"), batch.alias("batch"), batch_slug(batch).alias("batch_slug"),
        batch_season(batch).alias("batch_season"), batch_year(batch).alias("batch_year"), non_negative_int(p("team_size")).alias("team_size"),
        *(F.coalesce(p(a), F.lit(False)).alias(b) for a, b in (("isHiring", "is_hiring"), ("nonprofit", "nonprofit"), ("top_company", "top_company"))),
        string_list(p("industries")).alias("industries"), string_list(p("tags")).alias("source_tags"), string_list(p("regions")).alias("regions"), launched.alias("launched_at"),
    )
    out = out.withColumn("source_taxonomy_term_ids", term_ids()).withColumn("metadata_document", metadata_document(directory))
    return out.withColumn("content_hash", stable_hash(**{c: F.col(c) for c in out.columns if c not in keys}))


def source_documents(companies: DataFrame) -> DataFrame:
    """Up to four evidence documents per company: document_id, company_id, kind, text, char_count, content_hash."""
    there = [(k, c) for k, c in DOCUMENT_KINDS.items() if c in companies.columns]
    rows = F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), F.trim(F.col(c)).alias("text")) for k, c in there)))
    return companies.select("company_id", rows.alias("d")).where("d.text <> ''").select(
        F.concat("company_id", F.lit("#"), "d.kind").alias("document_id"), "company_id", "d.kind", "d.text", F.length("d.text").alias("char_count"), F.sha2("d.text", 256).alias("content_hash")
    )


def description_document() -> Column:
    """Name, one-liner, description and the first 2,000 characters of the website: the text that is embedded."""
    return F.concat_ws("\n", "name", "one_liner", "long_description", F.left(F.col("website_text"), F.lit(2000)))


def taxonomy_counts(companies: DataFrame, kinds: dict[str, Column]) -> DataFrame:
    """kind, slug, name, company_count of derived terms; ``kinds`` maps a kind to an array column."""
    def named(k: str, a: Column) -> Column:
        return F.transform(a, lambda v: F.struct(F.lit(k).alias("kind"), v.alias("name")))

    values = F.explode(F.flatten(F.array(*(named(k, a) for k, a in kinds.items()))))
    terms = companies.select(values.alias("t")).select("t.*").where("name IS NOT NULL AND trim(name) <> ''").withColumn("slug", slugify(F.col("name")))
    return terms.groupBy("kind", "slug").agg(F.min("name").alias("name"), F.count(F.lit(1)).alias("company_count"))


def merge_terms(*parts: DataFrame) -> DataFrame:
    """Union of term tables, one row per term_id: rows with a source path win, then earlier tables."""
    whole = None
    for i, t in enumerate(parts):
        one = t.withColumn("_part", F.lit(i))
        whole = one if whole is None else whole.unionByName(one, allowMissingColumns=True)
    rank = F.struct(F.col("source_path").isNull().alias("a"), "_part", *[c for c in parts[0].columns if c not in ("term_id", "source_path")])
    rest = [c for c in parts[0].columns if c != "term_id"]
    return whole.groupBy("term_id").agg(F.min_by(F.struct(*rest), rank).alias("s")).select("term_id", "s.*")


def unpivot_meta(meta: DataFrame, collections: tuple[str, ...] = ("industries", "tags", "batches")) -> DataFrame:
    """collection, slug, name, count, path of a source's meta document (maps of structs)."""
    out = None
    for c in collections:
        one = meta.select(F.lit(c).alias("collection"), F.explode(c).alias("slug", "v")).select("collection", "slug", "v.name", "v.count", F.col("v.api").alias("source_path"))
        out = one if out is None else out.unionByName(one)
    return out


def incremental(new: DataFrame, old: DataFrame, key: str, hash_column: str) -> DataFrame:
    """Adds ``change``: new, changed or same against the previous rows (null-safe hash comparison)."""
    before = old.select(key, F.col(hash_column).alias("_before"), F.lit(True).alias("_there"))
    out = new.join(before, key, "left")
    kind = F.when(F.col("_there").isNull(), "new").when(F.col(hash_column).eqNullSafe(F.col("_before")), "same").otherwise("changed")
    return out.withColumn("change", kind).drop("_before", "_there")


def keep_last_success(new: DataFrame, old: DataFrame, key: list[str]) -> DataFrame:
    """Failed rows (``ok`` false) give way to the previous successful row of their key."""
    whole = new.withColumn("_o", F.lit(0)).unionByName(old.where("ok").withColumn("_o", F.lit(1)))
    w = Window.partitionBy(*key).orderBy(F.desc("ok"), "_o")
    found = new.select(*key).distinct()
    return whole.join(found, key, "left_semi").withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n", "_o")


def fresh(cache: DataFrame, fetched_at: str, ttl_hours: int, now: Column | None = None) -> DataFrame:
    """Cache rows younger than the time to live."""
    return cache.where(F.col(fetched_at) > (now if now is not None else F.current_timestamp()) - F.make_dt_interval(hours=F.lit(ttl_hours)))
