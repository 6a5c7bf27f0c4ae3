"""Published projections: compact index, search documents, details with explanations, matrix export, lift labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions.text import truncate
from weftline.operators.pairs import basket_pairs
from weftline.runtime import materialize, row_numbers, rows_of, salted_join

#: Of at most so many kinds of items the numbers stand for the names.
CODED = 5_000
#: Transport keys of the company index.
COMPANY_KEYS = {
    "i": "company_id", "n": "name", "o": "one_liner", "b": "batch", "y": "batch_year", "s": "status", "g": "stage", "d": "industry", "u": "subindustry", "r": "regions", "l": "all_locations",
    "t": "team_size", "w": "website", "c": "url", "m": "logo_url", "k": "source_tags", "p": "top_company", "h": "is_hiring", "z": "nonprofit", "T": "tag_ids", "S": "tag_scores",
}


def ranked_tags() -> Column:
    """(tag, score) pairs of the parallel arrays, scored ones first by score, then by tag."""
    pairs = F.filter(F.arrays_zip("tag_ids", "tag_scores"), lambda z: z["tag_ids"].isNotNull())
    keyed = F.transform(pairs, lambda z: F.struct((-F.coalesce(z["tag_scores"], F.lit(0.0))).alias("k"), z["tag_ids"].alias("tag")))
    return F.array_sort(keyed)


def compact_index(companies: DataFrame) -> DataFrame:
    """The columns of the index; blanks and empty lists become null; zero counts stay. ``index_json`` gives them their short keys."""
    r = companies.withColumn("_r", ranked_tags())
    out = []
    for key, name in COMPANY_KEYS.items():
        if key == "T":
            c: Column = F.transform("_r", lambda x: x["tag"])
        elif key == "S":
            c = F.transform("_r", lambda x: F.round(-x["k"], 4))
        elif name not in companies.columns:
            continue
        elif key in ("p", "h", "z"):
            c = F.when(F.col(name), 1)
        elif key == "o":
            c = F.nullif(truncate(F.col(name), 160), F.lit(""))
        else:
            c = F.col(name)
        kind = dict(companies.dtypes).get(name, "")
        if kind.startswith("array") or key in ("T", "S"):
            c = F.when(F.size(c) > 0, c)
        elif kind == "string" and key not in ("i", "n", "o"):
            c = F.nullif(c, F.lit(""))
        out.append(c.alias(name))
    return r.select(*out)


def index_json(compact: DataFrame) -> DataFrame:
    """company_id, row: JSON with the short keys, nulls left out."""
    short = {name: key for key, name in COMPANY_KEYS.items()}
    return compact.select("company_id", F.to_json(F.struct(*(F.col(c).alias(short[c]) for c in compact.columns))).alias("row"))


def expand_index(compact: DataFrame) -> DataFrame:
    """The inverse projection, with defaults for what was left out."""
    lists = {"regions": "array<string>", "source_tags": "array<string>", "tag_ids": "array<string>", "tag_scores": "array<double>"}
    out = []
    for name in compact.columns:
        c: Column = F.col(name)
        if name in lists:
            c = F.coalesce(c, F.array().cast(lists[name]))
        elif name in ("top_company", "is_hiring", "nonprofit"):
            c = F.coalesce(c, F.lit(0)) == 1
        elif name == "one_liner":
            c = F.coalesce(c, F.lit(""))
        out.append(c.alias(name))
    return compact.select(*out)


def search_documents(companies: DataFrame, tags: DataFrame, best: int = 14, alias_tags: int = 8) -> DataFrame:
    """i, n, a, o, e, g, x, d, b: the text columns that are searched (a former names and e description where the companies have them)."""
    lacking = {"former_names": "array<string>", "long_description": "string", "industries": "array<string>", "all_locations": "string"}
    companies = companies.withColumns({c: F.lit(None).cast(t) for c, t in lacking.items() if c not in companies.columns})
    ranked = companies.select("company_id", F.posexplode(ranked_tags()).alias("pos", "r")).select("company_id", "pos", F.col("r.tag").alias("tag_id"))
    named = salted_join(ranked.where(F.col("pos") < best), tags.select("tag_id", "canonical_name", F.slice("aliases", 1, 2).alias("aliases")), ["tag_id"], "inner")
    per = named.groupBy("company_id").agg(F.array_sort(F.collect_set(F.struct("pos", "canonical_name", "aliases"))).alias("t"))
    x = F.array_distinct(F.flatten(F.transform(F.filter("t", lambda t: t["pos"] < alias_tags), lambda t: t["aliases"])))
    base = companies.select("company_id", "name", "former_names", "one_liner", "long_description", "industry", "subindustry", "industries", "source_tags", "batch", "all_locations", "regions", "status", "stage").distinct()
    return base.join(per, "company_id", "left").select(
        F.col("company_id").alias("i"), F.col("name").alias("n"), F.coalesce(F.array_join("former_names", " "), F.lit("")).alias("a"), F.coalesce("one_liner", F.lit("")).alias("o"), F.coalesce(truncate(F.col("long_description"), 420), F.lit("")).alias("e"), F.coalesce(F.array_join(F.transform("t", lambda t: t["canonical_name"]), " "), F.lit("")).alias("g"),
        F.coalesce(F.array_join(x, " "), F.lit("")).alias("x"), F.concat_ws(" ", "industry", "subindustry", F.array_join("industries", " "), F.array_join("source_tags", " ")).alias("d"),
        F.concat_ws(" ", "batch", "all_locations", F.array_join("regions", " "), "status", "stage").alias("b"),
    )


def metadata_facts() -> Column:
    """The set of ``kind: value`` facts of a company row."""
    one = lambda k, c: F.when(F.coalesce(F.col(c), F.lit("")) != "", F.concat(F.lit(f"{k}: "), c))
    many = lambda k, c: F.transform(F.coalesce(c, F.array().cast("array<string>")), lambda v: F.concat(F.lit(f"{k}: "), v))
    single = F.array(one("batch", "batch"), one("industry", "industry"), one("subindustry", "subindustry"), one("status", "status"), one("stage", "stage"))
    return F.array_distinct(F.array_compact(F.concat(single, many("region", "regions"), many("tag", "source_tags"))))


def neighbor_explanations(edges: DataFrame, facts: DataFrame, share: float = 0.15, most: int = 4) -> DataFrame:
    """id, neighbor_id, shared: facts both ends have that few entities have, rarest first.

    ``facts``: id, facts. A fact of more than ``max(2, share of all)`` entities explains nothing and
    is dropped before the joins. The edges, which may come from a search, are made once.
    """
    edges = materialize(edges.select("id", "neighbor_id"), "edges")
    n = facts.count()
    cutoff = max(2, int(n * share))
    long = facts.select("id", F.explode("facts").alias("fact"))
    rare = long.groupBy("fact").agg(F.count(F.lit(1)).alias("df")).where(F.col("df") <= cutoff)
    return shared_items(edges, long, rare, "fact", ["df", "fact"], "fact", most)


def shared_items(edges: DataFrame, items: DataFrame, kinds: DataFrame, key: str, order: list[str], name: str, most: int) -> DataFrame:
    """id, neighbor_id, shared: the names of the first items in an order that both ends have, where they share any.

    ``items``: id, ``key``; ``kinds``: ``key``, the columns of the order (the key among them) and the name. An
    edge is shuffled with its ends' items as their numbers in the order, not as texts; only of more than
    ``CODED`` kinds are they texts.
    """
    kinds = materialize(row_numbers(kinds, order, "code"), "kinds")
    coded = rows_of(kinds) <= CODED
    item = F.col("code").cast("int") if coded else F.struct(*dict.fromkeys([*order, name]))
    own = items.join(F.broadcast(kinds), key) if coded else salted_join(items, kinds, [key], "inner")
    sets = materialize(own.groupBy("id").agg(F.collect_set(item).alias("own")), "items")
    both = salted_join(edges.select("id", "neighbor_id"), sets, ["id"], "inner", rows=getattr(edges, "_weftline_rows", None))
    both = salted_join(both, sets.select(F.col("id").alias("neighbor_id"), F.col("own").alias("theirs")), ["neighbor_id"], "inner")
    both = both.select("id", "neighbor_id", F.slice(F.array_sort(F.array_intersect("own", "theirs")), 1, most).alias("shared")).where(F.size("shared") > 0)
    names = F.array(*(F.lit(r[0]) for r in kinds.orderBy("code").select(name).collect())).cast("array<string>") if coded else None
    return both.withColumn("shared", F.transform("shared", lambda x: F.element_at(names, x + 1) if coded else x[name]))


def cooccurring(assignments: DataFrame, entity: str, label: str, top: int = 8) -> DataFrame:
    """label, other, n, rank: the labels that share most entities with each label (ties by label)."""
    each = assignments.where(F.col(entity).isNotNull() & F.col(label).isNotNull()).select(F.col(entity).alias("basket"), F.col(label).alias("item")).distinct()
    each = materialize(each, "assignments")
    pairs = basket_pairs(each, each.groupBy("basket").agg(F.count(F.lit(1)).alias("c"))).groupBy("item_a", "item_b").agg(F.count(F.lit(1)).alias("n"))
    counts = pairs.select(F.explode(F.array(*(F.struct(F.col(a).alias("label"), F.col(b).alias("other")) for a, b in (("item_a", "item_b"), ("item_b", "item_a"))))).alias("s"), "n").select("s.*", "n")
    w = Window.partitionBy("label").orderBy(F.desc("n"), "other")
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)


def counts_by_year(rows: DataFrame, label: str, year: str) -> DataFrame:
    """label, by_year: a map of year to count, in the order of years."""
    per = rows.groupBy(F.col(label).alias("label"), F.col(year).alias("year")).agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy("label").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("year", "n")))).alias("by_year"))


def lift_labels(members: DataFrame, terms: DataFrame, top: int = 5, share: float = 0.12) -> DataFrame:
    """cluster, term, n, score, rank: the terms that tell clusters from each other.

    ``members``: id, cluster; ``terms``: id, term. score = n (n / cluster size) / (global n / total),
    both over the clustered population; a term needs max(2, share of the cluster) members.
    """
    sizes = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))
    total = F.lit(float(members.count()))
    both = salted_join(terms.select("id", "term").distinct(), members.select("id", "cluster"), ["id"], "inner")
    local = both.groupBy("cluster", "term").agg(F.count(F.lit(1)).alias("n"))
    everywhere = local.groupBy("term").agg(F.sum("n").alias("global"))
    s = local.join(sizes, "cluster").join(everywhere, "term").where(F.col("n") >= F.greatest(F.lit(2.0), F.lit(share) * F.col("size")))
    s = s.withColumn("score", F.round(F.col("n") * (F.col("n") / F.col("size")) / (F.col("global") / total), 6))
    w = Window.partitionBy("cluster").orderBy(F.desc("score"), "term")
    return s.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top).select("cluster", "term", "n", "score", "rank")


def cluster_labels(members: DataFrame, by_tag: DataFrame, by_term: DataFrame) -> DataFrame:
    """cluster, label, label_source: the three best tags, else source terms, else a number."""
    best = lambda d, c: d.where("rank <= 3").groupBy("cluster").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "term"))), lambda x: x["term"]), " · ").alias(c))
    out = members.select("cluster").distinct().join(best(by_tag, "a"), "cluster", "left").join(best(by_term, "b"), "cluster", "left")
    source = F.when(F.col("a").isNotNull(), "tags").when(F.col("b").isNotNull(), "source_terms").otherwise("fallback")
    return out.select("cluster", F.coalesce("a", "b", F.concat(F.lit("Cluster "), F.col("cluster").cast("string"))).alias("label"), source.alias("label_source"))


def csr_matrix(features: DataFrame, rows: DataFrame, columns: DataFrame, row: str, column: str, value: str) -> tuple[DataFrame, DataFrame]:
    """(coo: r, c, v; indptr: r, start, end) with indices in the order of the ids; unmatched entries drop.

    Row numbers come from a range-partitioned sort and per-partition counts, not from one task.
    """
    r = row_numbers(rows.select(F.col(row)).distinct(), [row], "r")
    c = row_numbers(columns.select(F.col(column)).distinct(), [column], "c")
    coo = salted_join(salted_join(features.select(row, column, F.col(value).alias("v")), r, [row], "inner"), c, [column], "inner").select("r", "c", "v")
    per = r.select("r").join(coo.groupBy("r").agg(F.count(F.lit(1)).alias("nnz")), "r", "left").select("r", F.coalesce("nnz", F.lit(0)).alias("nnz"))
    blocks = per.withColumn("b", F.shiftright("r", 16))
    base = blocks.groupBy("b").agg(F.sum("nnz").alias("t"))  # one row for 65,536 rows
    start = base.select("b", F.coalesce(F.sum("t").over(Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("o"))
    w = Window.partitionBy("b").orderBy("r").rowsBetween(Window.unboundedPreceding, 0)
    ptr = blocks.join(F.broadcast(start), "b").withColumn("end", F.col("o") + F.sum("nnz").over(w))
    return coo, ptr.select("r", (F.col("end") - F.col("nnz")).alias("start"), "end")
