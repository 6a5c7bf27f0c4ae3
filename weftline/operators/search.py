"""Keyword search: postings, BM25 over weighted fields, prefix and fuzzy terms, phrases, tiers, snippets.

The index is written once: postings sorted by term (so a query's terms prune the scan by the files'
own statistics), the vocabulary with document frequencies, and the searched texts. A query reads the
vocabulary to expand its words, then only the postings of those terms.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.runtime import materialize, release, row_numbers, rows_of

#: Field boosts and the public library defaults of the BM25+ variant.
BOOSTS = {"n": 8.0, "a": 5.0, "g": 3.5, "x": 2.5, "o": 2.0, "d": 1.4, "e": 1.0, "b": 1.0}
K, B, DELTA, PREFIX_WEIGHT, FUZZY_WEIGHT = 1.2, 0.7, 0.5, 0.375, 0.45
PHRASE_FIELDS = ("n", "a", "o", "e", "g", "d", "b")
LABELS = {"n": "name", "a": "former names", "o": "one-liner", "e": "description", "g": "tags", "x": "tag aliases", "d": "industry", "b": "batch and location"}
#: Terms of a query up to which they are pushed into the scan as a list; more are joined.
PUSHED_TERMS = 2_000


def tokens(c: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(c, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def parse_query(query: str) -> tuple[list[str], list[str]]:
    """(terms, phrases): quoted parts are phrases and their words are terms too."""
    phrases = [p.strip().lower() for p in re.findall(r'"([^"]+)"', query) if p.strip()]
    terms = [t for t in re.split(r"[^\w]+", query.lower().replace("_", " ")) if t]
    return list(dict.fromkeys(terms)), phrases


@dataclass
class SearchIndex:
    """Written tables. docs: doc and the fields; postings: term, field, doc, tf, dl, df; vocabulary: term."""

    docs: DataFrame
    postings: DataFrame
    vocabulary: DataFrame
    fields: tuple[str, ...]
    n: int
    average: dict[str, float]

    def drop(self) -> None:
        release(self.docs, self.postings, self.vocabulary)


def build_index(docs: DataFrame, key: str, fields: tuple[str, ...]) -> SearchIndex:
    """The index of the given text columns."""
    docs = materialize(docs.select(F.col(key).alias("doc"), *fields), "search-docs")
    per = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), tokens(F.col(f)).alias("t")) for f in fields)))
    rows = docs.select("doc", per.alias("s")).select("doc", "s.field", F.size("s.t").alias("dl"), F.explode("s.t").alias("term"))
    postings = materialize(rows.groupBy("term", "field", "doc").agg(F.count(F.lit(1)).alias("tf"), F.max("dl").alias("dl")), "raw-postings")
    df = postings.groupBy("term", "field").agg(F.count(F.lit(1)).alias("df"))
    # A term's documents may be all there are: its frequency is a small table joined on, never a window over them.
    stats = materialize(df, "frequencies")
    small = F.broadcast(stats) if rows_of(stats) <= 200_000 else stats
    sorted_ = materialize(postings.join(small, ["term", "field"]).repartitionByRange("term", "doc").sortWithinPartitions("term", "field", "doc"), "postings")
    vocabulary = materialize(stats.select("term").distinct(), "vocabulary")
    total = docs.agg(*(F.avg(F.size(tokens(F.col(f)))).alias(f) for f in fields)).first()
    release(postings, stats)
    return SearchIndex(docs, sorted_, vocabulary, fields, rows_of(docs), {f: total[f] or 0.0 for f in fields})


def expand(index: SearchIndex, terms: list[str], prefix: bool = True, fuzzy: bool = True) -> DataFrame:
    """query_term, term, weight: exact terms, prefixes of terms of 3 letters or more, and near spellings."""
    spark = index.docs.sparkSession
    q = F.explode(F.array(*map(F.lit, terms))).alias("query_term")  # the words of one query
    pairs = index.vocabulary.select("term", q) if terms else spark.createDataFrame([], "term string, query_term string")
    exact = F.col("term") == F.col("query_term")
    n = F.length("query_term")
    starts = (n >= 3) & F.col("term").startswith(F.col("query_term")) & ~exact
    edits = F.when(n >= 5, F.round(n * 0.2)).when(n == 4, F.round(n * 0.15)).otherwise(0).cast("int")
    near = (F.abs(F.length("term") - n) <= edits) & (edits > 0) & (F.levenshtein("term", "query_term") <= edits) & ~exact
    gap = F.length("term") - n
    weight = F.when(exact, 1.0)
    if prefix:
        weight = weight.when(starts, PREFIX_WEIGHT * F.length("term") / (F.length("term") + 0.3 * gap))
    if fuzzy:
        weight = weight.when(near, FUZZY_WEIGHT * F.length("term") / (F.length("term") + F.levenshtein("term", "query_term")))
    return pairs.withColumn("weight", weight).where("weight IS NOT NULL")


def search(
    index: SearchIndex, query: str, limit: int | None = 200, prefix: bool = True, fuzzy: bool = True, name_field: str | None = "n", boosts: dict[str, float] | None = None, within: DataFrame | None = None
) -> DataFrame:
    """doc, score, fields (matched), terms (matched): documents with every term, best first, ties by id.

    ``within`` (doc): only these documents, so that a filter comes before the limit and loses no match.
    """
    terms, phrases = parse_query(query)
    boosts = boosts or {f: BOOSTS.get(f, 1.0) for f in index.fields}
    spark = index.docs.sparkSession
    wanted = materialize(expand(index, terms, prefix, fuzzy), "terms")
    stats = F.broadcast(spark.createDataFrame([(f, float(boosts[f]), float(index.average[f] or 1.0)) for f in index.fields], "field string, boost double, avgdl double"))
    postings = index.postings
    if rows_of(wanted) <= PUSHED_TERMS:
        postings = postings.where(F.col("term").isin([r[0] for r in wanted.select("term").distinct().collect()]))  # at most PUSHED_TERMS
        wanted = F.broadcast(wanted)
    if within is not None:
        postings = postings.join(within.select("doc").distinct(), "doc", "left_semi")
    hits = postings.join(wanted, "term").join(stats, "field")
    idf = F.log(1 + (F.lit(float(index.n)) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    tf = F.col("tf").cast("double")
    bm = idf * (DELTA + tf * (K + 1) / (tf + K * (1 - B + B * F.col("dl") / F.col("avgdl"))))
    scored = hits.groupBy("doc").agg(
        F.sum(bm * F.col("boost") * F.col("weight")).alias("score"), F.count_distinct("query_term").alias("found"), F.sort_array(F.collect_set("field")).alias("fields"), F.sort_array(F.collect_set("term")).alias("terms")
    ).where(F.col("found") == len(terms))
    texts = [f for f in PHRASE_FIELDS if f in index.fields] or list(index.fields)
    tiered = name_field in index.fields
    if phrases or tiered:
        need = [f for f in index.fields if (phrases and f in texts) or f == name_field]
        scored = scored.join(index.docs.select("doc", *(F.lower(F.coalesce(f, F.lit(""))).alias(f"_{f}") for f in need)), "doc")
        for p in phrases:
            scored = scored.where(F.concat_ws("\n", *(F.col(f"_{f}") for f in texts)).contains(p))
        if tiered:
            whole = " ".join(query.replace('"', " ").split()).lower()
            name = F.trim(F.col(f"_{name_field}"))
            tier = F.when(name == whole, 10000.0).when(name.startswith(whole), 1000.0).when(name.contains(whole), 200.0).otherwise(0.0)
            scored = scored.withColumn("score", F.col("score") + tier)
    out = scored.select("doc", F.round("score", 6).alias("score"), "fields", "terms")
    return out if limit is None else out.orderBy(F.desc("score"), "doc").limit(limit)


def explain_match() -> Column:
    """The labels of the fields that matched."""
    names = F.create_map(*(F.lit(x) for kv in LABELS.items() for x in kv))
    return F.transform("fields", lambda f: F.coalesce(F.try_element_at(names, f), f))


def search_within(index: SearchIndex, query: str, filtered: DataFrame, key: str, limit: int | None = None, **how) -> DataFrame:
    """Filtered rows with ``score`` and ``place`` (relevance rank from 0) in the order of relevance; without words in the query all rows, unranked."""
    if not parse_query(query)[0]:
        return filtered.withColumn("score", F.lit(None).cast("double")).withColumn("place", F.lit(None).cast("long"))
    found = search(index, query, None, within=filtered.select(F.col(key).alias("doc")), **how).select(F.col("doc").alias(key), "score")
    order = [F.desc("score"), F.asc(key)]
    if limit is not None:
        found = found.orderBy(*order).limit(limit)
    ranked = row_numbers(found, order, "place")
    return filtered.join(ranked, key)


def snippet(c: Column, terms: list[str], radius: int = 90) -> Column:
    """Text around the earliest hit as segments (text, hit), with ellipses where it is cut."""
    pattern = "(?i)" + "|".join(re.escape(t) for t in sorted(terms, key=len, reverse=True)) if terms else "(?!)"
    at = F.regexp_instr(c, F.lit(f"({pattern})"))
    start = F.when(at > 0, F.greatest(F.lit(1), at - radius)).otherwise(1)
    cut = F.substring(c, start, F.lit(2 * radius))
    text = F.concat(F.when(start > 1, "…").otherwise(""), cut, F.when(start + 2 * radius <= F.length(c), "…").otherwise(""))
    marked = F.regexp_replace(text, f"({pattern})", "\u0001\u0002$1\u0001")
    parts = F.filter(F.split(marked, "\u0001"), lambda p: p != "")
    return F.transform(parts, lambda p: F.struct(F.regexp_replace(p, "^\u0002", "").alias("text"), p.startswith("\u0002").alias("hit")))
