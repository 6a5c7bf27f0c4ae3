"""Quality metrics and release gates.

Every gate is a table of violations; its result row has the count and at most five samples. A
gate whose check raises is a failed gate, not a crash.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.functions.text import normalize_name

GATE = "gate string, passed boolean, violations long, samples array<string>, detail string"


def gate(name: str, violations: DataFrame, sample: Column) -> DataFrame:
    """gate, passed, violations, samples (the five smallest), detail."""
    s = violations.select(sample.cast("string").alias("s"))
    five = s.orderBy("s").limit(5).agg(F.sort_array(F.collect_list("s")).alias("samples"))
    n = s.agg(F.count(F.lit(1)).alias("violations"))
    return n.join(F.broadcast(five), F.lit(True)).select(F.lit(name).alias("gate"), (F.col("violations") == 0).alias("passed"), "violations", "samples", F.lit("").alias("detail"))


def run_gates(spark: SparkSession, checks: dict[str, Callable[[], DataFrame]]) -> DataFrame:
    """All gates as one table, in one job; an exception inside a check makes a failed row with its message."""
    rows: list[tuple] = []
    built: dict[str, DataFrame] = {}

    def broken(name: str, e: Exception) -> tuple:
        return (name, False, -1, [], f"{type(e).__name__}: {str(e)[:200]}")

    for name, check in checks.items():
        try:
            built[name] = check()
        except Exception as e:  # noqa: BLE001
            rows.append(broken(name, e))
    try:
        rows += [tuple(r) for r in reduce(DataFrame.unionByName, built.values()).collect()] if built else []  # one row a gate
    except Exception:  # noqa: BLE001, at least one of them: each by itself
        for name, df in built.items():
            try:
                rows += [tuple(r) for r in df.collect()]
            except Exception as e:  # noqa: BLE001
                rows.append(broken(name, e))
    return spark.createDataFrame(rows, GATE)


def missing_values(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with a null or blank required column."""
    return rows.where(reduce(lambda a, b: a | b, (F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == "" for c in columns)))


def not_finite(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with NaN or an infinite number."""
    bad = lambda c: F.isnan(c) | (F.abs(F.col(c)) == float("inf"))
    return rows.where(reduce(lambda a, b: a | b, (F.coalesce(bad(c), F.lit(False)) for c in columns)))


def dangling(rows: DataFrame, columns: list[str], target: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose non-null reference is not in the target."""
    t = target.select(*(F.col(k).alias(c) for k, c in zip(keys, columns, strict=True))).distinct()
    return rows.where(reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in columns))).join(t, columns, "left_anti")


def outside(rows: DataFrame, column: str, lo: float = 0.0, hi: float = 1.0) -> DataFrame:
    return rows.where(~F.col(column).between(lo, hi) | F.isnan(column))


def different_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys in only one of two tables (symmetric difference)."""
    x, y = a.select(key).distinct(), b.select(key).distinct()
    return x.exceptAll(y).unionByName(y.exceptAll(x))


def unparallel(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows whose arrays differ in length."""
    sizes = [F.coalesce(F.size(c), F.lit(-1)) for c in columns]
    return rows.where(reduce(lambda a, b: a | b, (s != sizes[0] for s in sizes[1:])))


def schema_differences(df: DataFrame, expected: list[tuple[str, str]]) -> list[str]:
    """Columns missing, unexpected or of another type than a table contract."""
    have, want = dict(df.dtypes), dict(expected)
    out = [f"missing {c}" for c in want if c not in have] + [f"unexpected {c}" for c in have if c not in want]
    return out + [f"{c} is {have[c]}, not {t}" for c, t in want.items() if c in have and have[c] != t]


def orphan_tags(tags: DataFrame, features: DataFrame) -> DataFrame:
    """Active tags that no feature has."""
    return tags.where("state = 'active'").join(features.select("tag_id").distinct(), "tag_id", "left_anti")


def duplicate_names(tags: DataFrame) -> DataFrame:
    """key, tag_ids: active tags whose normalised names are the same."""
    keyed = tags.where("state = 'active'").select(normalize_name(F.col("canonical_name")).alias("key"), "tag_id")
    return keyed.groupBy("key").agg(F.sort_array(F.collect_set("tag_id")).alias("tag_ids")).where(F.size("tag_ids") > 1)


def prevalence(features: DataFrame) -> DataFrame:
    return features.groupBy("tag_id").agg(F.count(F.lit(1)).alias("prevalence"))


def prevalence_median(tags: DataFrame, features: DataFrame) -> DataFrame:
    """One row: the exact median number of entities of active tags, unused ones counted as zero."""
    per = tags.where("state = 'active'").select("tag_id").join(prevalence(features), "tag_id", "left")
    return per.agg(F.percentile(F.coalesce("prevalence", F.lit(0)), 0.5).alias("median"))


def quality_report(companies: int, tags: DataFrame, features: DataFrame, judged: DataFrame) -> DataFrame:
    """metric, value: the counts and rates of a release (every denominator at least 1)."""
    rate = lambda a, b: F.round(a / F.greatest(b, F.lit(1)), 4)
    j = judged.agg(
        F.count(F.lit(1)).alias("judgments"), *(F.count_if(F.col("decision") == d).alias(d) for d in ("yes", "no", "uncertain")),
        F.count_if((F.col("decision") == "yes") & (F.size("evidence") > 0)).alias("evidenced"),
        F.count_if(F.col("shortlist_reason") == "hard_negative").alias("hard"), F.count_if((F.col("shortlist_reason") == "hard_negative") & (F.col("decision") == "yes")).alias("hard_yes"),
    )
    t = tags.agg(*(F.count_if(F.col("state") == s).alias(s) for s in ("active", "candidate", "merged")))
    f = features.agg(F.count(F.lit(1)).alias("assignments"))
    o = orphan_tags(tags, features).agg(F.count(F.lit(1)).alias("orphans"))
    d = duplicate_names(tags).agg(F.count(F.lit(1)).alias("duplicates"))
    m = prevalence_median(tags, features)
    one = j
    for x in (t, f, o, d, m):  # each is one row
        one = one.join(F.broadcast(x), F.lit(True))
    c = F.col
    values = {
        "companies": F.lit(companies), "active_tags": c("active"), "candidate_tags": c("candidate"), "merged_tags": c("merged"), "assignments": c("assignments"),
        "assignments_per_company": F.round(c("assignments") / F.lit(max(1, companies)), 2), "judgments": c("judgments"), "yes": c("yes"), "no": c("no"), "uncertain": c("uncertain"),
        "uncertain_rate": rate(c("uncertain"), c("judgments")), "evidence_coverage": rate(c("evidenced"), c("yes")), "orphan_tag_rate": rate(c("orphans"), c("active")),
        "duplicate_tag_rate": rate(c("duplicates"), c("active")), "hard_negatives_judged": c("hard"), "hard_negative_acceptance_rate": rate(c("hard_yes"), c("hard")), "tag_prevalence_median": c("median"),
    }
    rows = F.explode(F.array(*(F.struct(F.lit(k).alias("metric"), v.cast("double").alias("value")) for k, v in values.items())))
    return one.select(rows.alias("r")).select("r.*")


def report_details(tags: DataFrame, features: DataFrame, stability: DataFrame, gold: DataFrame | None = None, orphans: int = 20, top: int = 15) -> DataFrame:
    """metric, key, value: what the report holds beside its rates. Facets of active tags, the most frequent tags, the first orphan and duplicate tags by id or key, stability between runs, and the score against gold labels (null where nothing matched)."""
    rows = lambda df, m, k, v: df.select(F.lit(m).alias("metric"), k.cast("string").alias("key"), v.cast("double").alias("value"))
    parts = [
        rows(tags.where("state = 'active'").groupBy("facet").agg(F.count(F.lit(1)).alias("n")), "facet_distribution", F.col("facet"), F.col("n")),
        rows(top_counts(features, "tag_id", top), "tag_prevalence_top", F.col("value"), F.col("n")),
        rows(orphan_tags(tags, features).orderBy("tag_id").limit(orphans), "orphan_tags", F.col("tag_id"), F.lit(0)),
        rows(duplicate_names(tags).orderBy("key").limit(10), "duplicate_tag_groups", F.col("key"), F.size("tag_ids")),
    ]
    for name, one in (("inter_run_stability", stability), ("reviewed_sample", gold)):
        if one is not None:
            pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("key"), F.col(c).cast("double").alias("value")) for c in one.columns)))
            parts.append(one.select(pairs.alias("p")).select(F.lit(name).alias("metric"), "p.key", "p.value"))
    return reduce(DataFrame.unionByName, parts)


def top_counts(rows: DataFrame, column: str, n: int = 15) -> DataFrame:
    """value, n: the most frequent values, ties by value."""
    return rows.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "value").limit(n)


def neighbor_violations(neighbors: DataFrame, companies: DataFrame) -> DataFrame:
    """Edges to unknown ids, to themselves, or of a space with several versions."""
    ids = companies.select("company_id").distinct()
    bad = dangling(neighbors, ["company_id"], ids, ["company_id"]).unionByName(dangling(neighbors, ["neighbor_company_id"], ids, ["company_id"]))
    bad = bad.unionByName(neighbors.where("company_id = neighbor_company_id"))
    if "space_version" in neighbors.columns:
        spaces = neighbors.groupBy("space").agg(F.count_distinct("space_version").alias("v")).where("v > 1").select("space")
        bad = bad.unionByName(neighbors.join(F.broadcast(spaces), "space", "left_semi"))  # five spaces
    return bad


def checksum_violations(spark: SparkSession, folder: str, checksums: dict[str, str]) -> DataFrame:
    """path, problem: files of a release that are absent or differ from their recorded digest."""
    want = spark.createDataFrame([(k, v) for k, v in checksums.items()], "path string, want string")
    have = file_checksums(spark, folder)
    both = want.join(have, "path", "left")
    problem = F.when(F.col("digest").isNull(), "missing").when(F.col("digest") != F.col("want"), "changed")
    return both.select("path", problem.alias("problem")).where("problem IS NOT NULL")


def file_checksums(spark: SparkSession, folder: str) -> DataFrame:
    """path (relative), digest (first 16 hex digits of sha256), bytes; read by the executors."""
    root = folder.rstrip("/")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return files.select(F.split_part("path", F.lit(root.removeprefix("file://") + "/"), F.lit(2)).alias("path"), F.left(F.sha2("content", 256), F.lit(16)).alias("digest"), F.col("length").alias("bytes"))


def wrong_shards(details: DataFrame, shards: int = 64) -> DataFrame:
    from weftline.functions.hashing import shard_for

    return details.where(F.col("shard") != shard_for(F.col("company_id"), shards))
