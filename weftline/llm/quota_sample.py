"""Sample matching target category proportions.

Every record has a random priority (a hash of seed and key). A category's reservoir is its smallest
priorities: reservoirs of parts merge by keeping the smallest of both. As a quota may be a tenth of
billions of rows, a reservoir is spilled in runs of its priority order (bands of about ``run_rows``
records of the whole table): each run is a mergeable list with an exact count, made in one pass by
an aggregation that combines before its shuffle, and keeps at most the largest quota there can be. The runs are
written once. Their counts are the final counts: quotas are planned from them, a reservoir is trimmed
to its quota by taking whole runs and the head of the run in which the quota ends, and categories
whose counts are below their need are exhausted. Within a category all records are equally likely,
and no category is ever gathered in one task.

Quotas: the greater of each cell's minimum and a common multiple of its target share, at most what
it can give, with the multiple chosen so that the quotas add up to the sample size (as far as the
cells can fill it).

Defined cases: records outside every cell are never drawn but count in the sample size; a record in
several cells counts in each and is drawn in the one with the smallest id; null or blank categories
are the named ``missing`` category and null numbers 0; repeated rows count once; empty tables give
an empty sample and a report with zero counts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.runtime import materialize, rows_of, squeeze

#: Cells are a plan made by hand; more than this is refused, because their table is broadcast.
MAX_CELLS = 100_000


def current_rows(rows: DataFrame, key: str, version: str, columns: list[str]) -> DataFrame:
    """The row of each key with the greatest version (ties: the greatest values)."""
    s = F.struct(rows[version].alias("_v"), *(rows[c].alias(c) for c in columns))
    best = rows.where(rows[key].isNotNull()).select(rows[key].alias("key"), s.alias("_s")).groupBy("key").agg(F.max("_s").alias("_s"))
    return best.select("key", *(F.col("_s")[c].alias(c) for c in columns))


def cell_members(current: DataFrame, cells: DataFrame, category: str, number: str, missing: str = "Unlisted") -> DataFrame:
    """key, cells: the sorted ids of the cells (cell_id, category, lo, hi) that a record lies in; one row a record of ``current``."""
    n_cells = cells.count()
    if n_cells > MAX_CELLS:
        raise ValueError(f"{n_cells} cells; at most {MAX_CELLS} are allowed")

    def fold(c: str):
        low = F.lower(squeeze(c))
        return F.when(low.isNull() | (low == ""), F.lit(missing.lower())).otherwise(low)

    spans = cells.select(fold("category").alias("cat"), F.struct("cell_id", "lo", "hi").alias("s")).groupBy("cat").agg(F.collect_set("s").alias("spans"))
    r = current.select("key", fold(category).alias("cat"), F.coalesce(F.col(number), F.lit(0)).alias("num")).join(F.broadcast(spans), "cat")  # at most MAX_CELLS
    inside = F.filter("spans", lambda s: F.col("num").between(s["lo"], s["hi"]))
    return r.select("key", F.array_sort(F.array_distinct(F.transform(inside, lambda s: s["cell_id"]))).alias("cells")).where(F.size("cells") > 0)


@dataclass
class Reservoirs:
    """Written runs: cell_id, run, seen, own, kept."""

    runs: DataFrame

    def counts(self) -> DataFrame:
        """cell_id, available (records in the cell), drawable (those that no smaller cell has)."""
        return self.runs.groupBy("cell_id").agg(F.sum("seen").cast("long").alias("available"), F.sum("own").cast("long").alias("drawable"))

    def trim(self, quotas: dict[int, int]) -> DataFrame:
        """cell_id, key: every reservoir cut to its quota (whole runs, then the head of the last one)."""
        spark = self.runs.sparkSession
        if len(quotas) > MAX_CELLS:
            raise ValueError(f"{len(quotas)} cells; at most {MAX_CELLS} are allowed")
        q = F.broadcast(spark.createDataFrame(list(quotas.items()), "cell_id int, quota long"))
        sizes = self.runs.select("cell_id", "run", "own").join(q, "cell_id")
        ends = sizes.groupBy("cell_id", "quota").agg(F.array_sort(F.collect_list(F.struct("run", "own"))).alias("r"))
        upto = F.aggregate(  # the run in which the quota ends, and what was taken before it
            "r", F.struct(F.lit(0).cast("long").alias("n"), F.lit(-1).cast("long").alias("last"), F.lit(0).cast("long").alias("head")),
            lambda s, x: F.when(s["n"] >= F.col("quota"), s).otherwise(F.struct((s["n"] + x["own"]).alias("n"), x["run"].alias("last"), (F.col("quota") - s["n"]).alias("head"))),
        )
        cut = F.broadcast(ends.select("cell_id", upto.alias("u")).where("u.last >= 0").select("cell_id", "u.last", "u.head"))  # one row a cell
        taken = self.runs.select("cell_id", "run", "kept").join(cut, "cell_id").where("run <= last")
        part = F.when(F.col("run") < F.col("last"), F.col("kept")).otherwise(F.slice("kept", F.lit(1), F.col("head").cast("int")))
        return taken.select("cell_id", F.explode(part).alias("k")).select("cell_id", "k.key")


def reservoirs(members: DataFrame, records: int, most: int, seed: int = 17, run_rows: int = 20_000) -> Reservoirs:
    """The reservoirs of all cells, in one pass over ``members`` (key, cells).

    ``records``: rows of the table, so that a run of the priority order has about ``run_rows`` of them;
    ``most``: the largest quota there can be (the sample's size, or a cell's minimum).
    """
    bits = min(20, max(0, (max(1, records) // run_rows)).bit_length())
    pr = F.xxhash64(F.lit(seed), "key")
    run = F.shiftrightunsigned(pr, 64 - bits) if bits else F.lit(0).cast("long")
    first = F.element_at("cells", 1)
    rows = members.select("key", pr.alias("pr"), run.alias("run"), first.alias("first"), F.explode("cells").alias("cell_id"))
    mine = F.col("cell_id") == F.col("first")
    priority = F.struct(F.col("pr").bitwiseXOR(F.lit(-(1 << 63))).alias("pr"), "key")  # unsigned order
    kept = F.slice(F.array_sort(F.collect_list(F.when(mine, priority))), 1, min(max(most, 1), 2**31 - 1))
    out = rows.groupBy("cell_id", "run").agg(F.count(F.lit(1)).alias("seen"), F.count_if(mine).alias("own"), kept.alias("kept"))
    return Reservoirs(materialize(out, "reservoirs"))


def plan_quotas(cells: list[tuple[int, float, int, int]], size: int) -> dict[int, int]:
    """Feasible quotas. ``cells``: (id, target share, minimum, available)."""

    def quotas(x: float) -> dict[int, float]:
        return {i: min(have, max(least, x * share)) for i, share, least, have in cells}

    lo, hi = 0.0, 1.0
    most = sum(c[3] for c in cells if c[1] > 0 or c[2] > 0)
    goal = min(size, most)
    while sum(quotas(hi).values()) < goal and hi < 1e18:
        hi *= 2
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (lo, mid) if sum(quotas(mid).values()) >= goal else (mid, hi)
    exact = quotas(hi)
    out = {i: int(q + 1e-9) for i, q in exact.items()}
    short = int(goal) - sum(out.values())
    have = {c[0]: c[3] for c in cells}
    for i in sorted(exact, key=lambda i: (out[i] - exact[i], i)):  # largest remainders first
        if short <= 0:
            break
        if out[i] < have[i] and exact[i] > out[i]:
            out[i] += 1
            short -= 1
    return out


@dataclass
class QuotaSample:
    """One pass over a table, from which the exhausted cells, the sample and the reports come."""

    cells: DataFrame
    kept: Reservoirs
    size: int

    def report(self) -> DataFrame:
        """cell_id, target_permille, min_count, need, available, missing: by the final counts. need: the greater of target and minimum."""
        need = F.greatest(F.ceil(F.col("target_permille").cast("long") * self.size / 1000), F.col("min_count").cast("long"))
        have = F.broadcast(self.kept.counts())  # at most MAX_CELLS rows
        out = self.cells.select("cell_id", "target_permille", "min_count", need.alias("need")).join(have, "cell_id", "left")
        zero = lambda c: F.coalesce(c, F.lit(0).cast("long"))
        out = out.withColumns({"available": zero(F.col("available")), "drawable": zero(F.col("drawable"))})
        return out.withColumn("missing", F.greatest(F.col("need") - F.col("available"), F.lit(0).cast("long")))

    def quotas(self) -> dict[int, int]:
        rows = self.report().collect()  # at most MAX_CELLS rows
        return plan_quotas([(r["cell_id"], r["target_permille"] / 1000, r["min_count"], r["drawable"]) for r in rows], self.size)

    def sample(self) -> DataFrame:
        return self.kept.trim(self.quotas())

    def outcome(self) -> DataFrame:
        """The report with drawn, share, unmet (need less drawn) and why: exhausted, overlap (a smaller cell has the records) or crowded_out (the minimums and targets of others fill the sample)."""
        quotas = self.quotas()
        drawn = F.broadcast(self.cells.sparkSession.createDataFrame(list(quotas.items()), "cell_id int, drawn long"))
        out = self.report().join(drawn, "cell_id", "left").withColumn("share", F.round(F.col("drawn") / F.lit(max(1, sum(quotas.values()))), 6))
        out = out.withColumn("unmet", F.greatest(F.col("need") - F.col("drawn"), F.lit(0).cast("long")))
        why = F.when(F.col("unmet") == 0, F.lit(None)).when(F.col("missing") > 0, "exhausted").when(F.col("drawn") == F.col("drawable"), "overlap").otherwise("crowded_out")
        return out.withColumn("reason", why)


def quota_sample(rows: DataFrame, cells: DataFrame, key: str, version: str, category: str, number: str, share: int = 10, seed: int = 17, run_rows: int = 20_000) -> QuotaSample:
    """A sample of one in ``share`` keys, by the current row of each, over cells (cell_id, category, lo, hi, target_permille, min_count)."""
    current = materialize(current_rows(rows, key, version, [category, number]), "current")
    n = rows_of(current)
    least = cells.agg(F.max("min_count")).first()[0] or 0
    kept = reservoirs(cell_members(current, cells, category, number), n, max(n // share, least), seed, run_rows)
    return QuotaSample(cells, kept, n // share)
