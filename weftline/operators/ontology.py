"""Tag ontology: ids, names, activation, merge candidates, merge pointers and application."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions.prompts import merge_prompt
from weftline.functions.text import normalize_name, slugify
from weftline.functions.vectors import dot
from weftline.operators.neighbors import similar_in_groups
from weftline.runtime import materialize, ranks_within, release, row_numbers, rows_of, salted_join
from weftline.sources.models import Backend, generate, request_key


def mint_ids(rows: DataFrame, name: str, facet: str, order: Sequence[str], taken: DataFrame | None = None) -> DataFrame:
    """Adds ``minted_id``, as if ids were given one by one in ``order`` (a total one): the first that is free of the name's
    slug, the facet's slug before it, and the slug with 2, 3 and so on after it. ``taken``: ids given before (``id``).

    All rows choose at once; where two choose alike, or one chose a taken id, the earlier keeps it and
    the id is barred to later rows, until no choice collides. Rows are ranked by a distributed sort,
    so a slug of a third of all rows is no single task. Null names are ``unnamed``.
    """
    base = rows.withColumn("_slug", F.coalesce(slugify(F.col(name)), F.lit("unnamed")))
    base = base.withColumn("_scoped", F.concat(F.coalesce(slugify(F.col(facet)), F.lit("unnamed")), F.lit("-"), "_slug"))
    base = materialize(row_numbers(ranks_within(base, ["_slug"], order, "_n"), order, "_seq"), "names")
    barred = [] if taken is None else [taken.select("id", F.lit(-1).cast("long").alias("by"))]

    def free(c: DataFrame, column: str, keep: str) -> DataFrame:
        if not barred:
            return c.withColumn(keep, F.lit(True))
        b = reduce(DataFrame.unionByName, barred).groupBy(F.col("id").alias(column)).agg(F.min("by").alias("_by"))
        return salted_join(c, b, [column], "left").withColumn(keep, F.coalesce(F.col("_by") >= F.col("_seq"), F.lit(True))).drop("_by")

    while True:
        x = free(base, "_slug", "_free")
        first = (F.col("_n") == 0) & F.col("_free")
        rest = materialize(free(ranks_within(x.where(~first).drop("_free"), ["_slug", "_scoped"], order, "_f"), "_scoped", "_free"), "rest")
        second = (F.col("_f") == 0) & F.col("_free")
        late = ranks_within(rest.where(~second), ["_slug"], order, "_c")
        number = F.col("_c") + 2
        if barred:
            b = reduce(DataFrame.unionByName, barred).select(F.regexp_extract("id", r"^(.*)-([0-9]{1,9})$", 1).alias("_slug"), F.regexp_extract("id", r"-([0-9]{1,9})$", 1).try_cast("long").alias("k"), "by").where("k >= 2")
            late = late.join(b.groupBy("_slug").agg(F.array_sort(F.collect_list(F.struct("k", "by"))).alias("_ks")), "_slug", "left")
            skip = lambda at, s: F.when((s["k"] <= at) & (s["by"] < F.col("_seq")), at + 1).otherwise(at)
            number = F.coalesce(F.aggregate("_ks", number, skip), number)
        cols = rows.columns
        out = x.where(first).select(*cols, "_seq", F.col("_slug").alias("minted_id"))
        out = out.unionByName(rest.where(second).select(*cols, "_seq", F.col("_scoped").alias("minted_id")))
        out = materialize(out.unionByName(late.select(*cols, "_seq", F.concat("_slug", F.lit("-"), number.cast("string")).alias("minted_id"))), "minted")
        clash = materialize(out.groupBy(F.col("minted_id").alias("id")).agg(F.min("_seq").alias("by"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "clash")
        release(rest)
        if not rows_of(clash):
            return out.drop("_seq")
        release(out)
        barred.append(clash)


def diverse_batches(rows: DataFrame, total: int, batch_size: int, order: Sequence[Column]) -> DataFrame:
    """Adds ``position`` (global order, by a distributed sort) and ``batch`` (position modulo the number of batches)."""
    batches = max(1, total // max(1, batch_size))
    return row_numbers(rows, order, "position").withColumn("batch", F.pmod("position", F.lit(batches)))


def merge_candidates(tags: DataFrame, auto: float = 0.94, review: float = 0.86) -> DataFrame:
    """source_id, target_id, similarity, verdict for similar tags of one facet.

    ``tags``: id, name, facet, support, v (unit vectors). Similarities come from matrix products of
    blocks of one facet, which only let pairs out that reach ``review``; equal names come from an equi-join.
    The better supported tag survives, then the smaller id.
    """
    t = materialize(tags.select("id", "facet", "support", "v", normalize_name(F.col("name")).alias("key")), "tags")
    near = similar_in_groups(t.select("id", F.col("facet").alias("grp"), "v"), review)
    keyed = t.where("key <> ''").select("facet", "key", "id")
    names = salted_join(keyed, keyed.withColumnRenamed("id", "id2"), ["facet", "key"], "inner", hot_rows=5_000).where("id < id2").select("id", "id2", F.lit(True).alias("same"))
    light = t.select("id", "support", "v")
    pairs = near.withColumn("same", F.lit(False)).unionByName(names.withColumn("similarity", F.lit(None).cast("double"))).groupBy("id", "id2").agg(F.max("similarity").alias("similarity"), F.max("same").alias("same"))
    pairs = pairs.join(light, "id").join(light.select(*(F.col(c).alias(f"{c}2") for c in light.columns)), "id2")
    pairs = pairs.withColumn("similarity", F.coalesce("similarity", dot(F.col("v"), F.col("v2"))))
    verdict = F.when(F.col("same") | (F.col("similarity") >= auto), "auto_merge").otherwise("review")
    keep_first = F.col("support") >= F.col("support2")
    return pairs.select(
        F.when(keep_first, F.col("id2")).otherwise(F.col("id")).alias("source_id"), F.when(keep_first, F.col("id")).otherwise(F.col("id2")).alias("target_id"),
        F.round("similarity", 6).alias("similarity"), verdict.alias("verdict"),
    )


def adjudicate(candidates: DataFrame, tags: DataFrame, backend: Backend, most: int = 400, cache: DataFrame | None = None) -> DataFrame:
    """Candidates with ``adjudication`` and ``rationale``: the ``most`` similar pairs to review are put to a model, the others wait.

    ``tags``: id, name, facet, definition. An invalid answer leaves the pair without adjudication.
    """
    order = [F.desc("similarity"), F.asc("source_id"), F.asc("target_id")]
    asked = materialize(candidates.where("verdict = 'review'").orderBy(*order).limit(most), "asked")  # the bound is the feature
    named = lambda s: tags.select(F.col("id").alias(f"{s}_id"), *(F.col(c).alias(f"{s}_{c}") for c in ("name", "facet", "definition")))
    text = lambda s: {c: F.col(f"{s}_{c}") for c in ("name", "facet", "definition")}
    prompts = asked.join(named("source"), "source_id").join(named("target"), "target_id").withColumn("prompt", merge_prompt(text("source"), text("target")))
    prompts = materialize(prompts.select(*asked.columns, "prompt", request_key(F.col("prompt"), backend).alias("key")), "prompts")
    answers = generate(prompts.select("prompt"), cache, backend, "struct<verdict: string, rationale: string>")
    told = prompts.join(answers.select("key", "answer"), "key", "left").select("source_id", "target_id", F.col("answer.verdict").alias("adjudication"), F.col("answer.rationale").alias("rationale"))
    return candidates.join(F.broadcast(told), ["source_id", "target_id"], "left") if most <= 100_000 else candidates.join(told, ["source_id", "target_id"], "left")


def follow_pointers(rows: DataFrame, node: str, pointer: str, live: Column, max_hops_log2: int = 40) -> DataFrame:
    """node, terminal: where a chain of pointers ends, by pointer doubling (log2 of its length in joins).

    The terminal is null if the chain runs in a circle or leaves the table, or ends at a row that
    is not ``live`` and has no pointer.
    """
    base = rows.select(F.col(node).alias("node"), F.col(pointer).alias("next"), live.alias("live")).distinct()
    ends = base.where("next IS NULL").select("node", F.when(F.col("live"), F.col("node")).alias("terminal"))
    hop = materialize(base.where("next IS NOT NULL").select("node", "next"), "hops")
    left = hop.count()
    for _ in range(max_hops_log2):
        ahead = hop.select(F.col("node").alias("next"), F.col("next").alias("after"))
        new = materialize(salted_join(hop, ahead, ["next"], "left").select("node", F.coalesce("after", "next").alias("next"), F.col("after").isNotNull().alias("moved")), "hops")
        moved = new.where("moved").count()
        release(hop)
        hop = new.drop("moved")
        if moved == 0 or 2**_ > left:  # done, or longer than any path without a circle
            break
    reached = hop.join(ends.select(F.col("node").alias("next"), "terminal"), "next", "left").select("node", "terminal")
    return ends.unionByName(reached)


def name_index(tags: DataFrame, aliases: str = "aliases") -> DataFrame:
    """key, tag_id: what a normalised name resolves to; canonical names beat aliases, then the smaller id."""
    names = tags.select(normalize_name(F.col("canonical_name")).alias("key"), "tag_id", F.lit(0).alias("prio"))
    more = tags.select(F.explode(aliases).alias("a"), "tag_id").select(normalize_name(F.col("a")).alias("key"), "tag_id", F.lit(1).alias("prio"))
    best = names.union(more).where("key <> ''").groupBy("key").agg(F.min(F.struct("prio", "tag_id")).alias("s"))
    return best.select("key", "s.tag_id")


def activation(state: Column, support: Column, definition: Column, minimum: int = 2, override: Column | None = None) -> Column:
    """The state after activation: candidates with enough support and a definition of 20 characters."""
    enough = (support >= minimum) | (override if override is not None else F.lit(False))
    return F.when((state == "candidate") & enough & (F.length(definition) >= 20), "active").otherwise(state)


def accepted_merges(tags: DataFrame, proposals: DataFrame, order: Sequence[str]) -> DataFrame:
    """source, target, at: the proposals that take effect if they are applied one by one in ``order``, and where each source ends.

    A tag merges once, by its first proposal that doesn't lead back to itself. All tags take their
    first proposal at once; of the proposals in a circle the latest is the one that would have
    closed it, and is struck out; then again until no circle is left. Circles are found by pointer
    doubling that carries the latest proposal along. Proposals already applied, not accepted, of
    merged or unknown sources, or with targets that lead nowhere, have no effect.
    """
    ends = follow_pointers(tags.withColumn("_p", F.when(F.col("state") == "merged", F.col("merged_into"))), "tag_id", "_p", F.col("state") != "merged")
    good = (F.col("verdict") == "auto_merge") | (F.coalesce("adjudication", F.lit("")) == "merge")
    told = row_numbers(proposals, order, "at").where(good & ~F.coalesce("applied", F.lit(False))).select("at", F.col("source_tag_id").alias("source"), F.col("target_tag_id").alias("node"))
    told = told.join(tags.where("state <> 'merged'").select(F.col("tag_id").alias("source")), "source", "left_semi").join(ends.where("terminal IS NOT NULL"), "node")
    left = materialize(told.where("source <> terminal").select("at", "source", F.col("terminal").alias("target")), "merges")
    while True:
        first = materialize(left.groupBy("source").agg(F.min(F.struct("at", "target")).alias("s")).select("source", "s.at", "s.target"), "first")
        hop = materialize(first.select("source", F.col("target").alias("next"), F.col("at").alias("last")), "hops")
        moved, step = rows_of(hop), 1
        while moved and step <= 2 * rows_of(first):  # afterwards only paths into circles still move
            ahead = hop.select(F.col("source").alias("next"), F.col("next").alias("after"), F.col("last").alias("last2"))
            new = salted_join(hop, ahead, ["next"], "left")
            new = materialize(new.select("source", F.coalesce("after", "next").alias("next"), F.greatest("last", "last2").alias("last"), F.col("after").isNotNull().alias("moved")), "hops")
            moved, step = new.where("moved").count(), step * 2
            release(hop)
            hop = new.drop("moved")
            hop._weftline_path, hop._weftline_rows = new._weftline_path, new._weftline_rows
        if not moved:
            return first.join(hop.select("source", F.col("next").alias("end")), "source").select("source", F.col("end").alias("target"), "at")
        in_circle = hop.join(first.select(F.col("source").alias("next")), "next", "left_semi").select(F.col("next").alias("source")).distinct()
        latest = hop.join(in_circle, "source", "left_semi").select("source", "last")
        struck = first.join(latest, "source").where("at = last").select("at")
        left = materialize(left.join(struck, "at", "left_anti"), "merges")


def apply_merges(tags: DataFrame, proposals: DataFrame, order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(tags, proposals) after the accepted merges; see :func:`accepted_merges`. Doing it again changes nothing.

    A surviving tag gains the names, aliases, companies and first six examples of all that ended in
    it, in the order of their merges; a merged one keeps its own and points at the tag it ended in.
    """
    done = materialize(accepted_merges(tags, proposals, order), "accepted")
    strings = lambda c: F.coalesce(c, F.array().cast("array<string>"))
    gone = tags.join(done.select(F.col("source").alias("tag_id"), "target", "at"), "tag_id").select("target", "at", F.concat(F.array("canonical_name"), strings("aliases")).alias("n"), strings("source_company_ids").alias("c"), strings("positive_examples").alias("e"))

    def united(column: str) -> DataFrame:
        each = gone.select("target", "at", F.posexplode(column).alias("pos", "v")).groupBy("target", "v").agg(F.min(F.struct("at", "pos")).alias("k"))
        return each.groupBy("target").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "v"))), lambda x: x["v"]).alias(f"_{column}"))

    more = done.select("target").distinct()
    for c in ("n", "c", "e"):
        more = more.join(united(c), "target", "left")
    out = tags.join(more.withColumnRenamed("target", "tag_id").withColumn("_grew", F.lit(True)), "tag_id", "left").join(done.select(F.col("source").alias("tag_id"), F.col("target").alias("_to")), "tag_id", "left")
    names = F.filter(F.array_distinct(F.concat(strings("aliases"), strings("_n"))), lambda a: a != F.col("canonical_name"))
    companies = F.array_sort(F.array_distinct(F.concat(strings("source_company_ids"), strings("_c"))))
    new = {
        "aliases": F.when(F.col("_grew"), names).otherwise(F.col("aliases")), "source_company_ids": F.when(F.col("_grew"), companies).otherwise(F.col("source_company_ids")),
        "positive_examples": F.when(F.col("_grew"), F.slice(F.array_distinct(F.concat(strings("positive_examples"), strings("_e"))), 1, 6)).otherwise(F.col("positive_examples")),
        "state": F.when(F.col("_to").isNotNull(), "merged").otherwise(F.col("state")), "merged_into": F.coalesce("_to", "merged_into"),
    }
    if "support_count" in tags.columns:
        new["support_count"] = F.when(F.col("_grew"), F.size(companies)).otherwise(F.col("support_count"))
    told = row_numbers(proposals, order, "at").join(done.select("at", F.lit(True).alias("_now")), "at", "left")
    told = told.withColumn("applied", F.coalesce("_now", "applied", F.lit(False))).select(*proposals.columns)
    return out.withColumns(new).select(*tags.columns), told


def registry_stats(tags: DataFrame) -> DataFrame:
    """One row: tags by state, and aliases."""
    states = ("active", "candidate", "merged", "deprecated")
    return tags.agg(*(F.count_if(F.col("state") == s).alias(s) for s in states), F.sum(F.size(F.coalesce("aliases", F.array().cast("array<string>")))).cast("long").alias("aliases"))
