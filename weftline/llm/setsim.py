"""All similar pairs between set-valued records, by T-occurrence list merging.

Values are numbered by rising frequency; records with the same set become one class (so copies
are compared once, whatever their number). A pair of sets reaching the similarity must share
``T`` values and therefore one of the first ``size - T + 1`` of both: that value and a range of sizes
(geometric, so that a set meets at most two or three ranges) name the partition in which both meet.
Only (class, value, range) rows are spread; a set's list is fetched once by each task group that
needs it. A partition of over ``block_values`` listed values on either side is cut into a grid of blocks.
Within a partition the indexed sets form inverted lists; each probe sets the longest lists aside,
merges the others with a heap that skips ids which can't be found often enough, looks the survivors
up in the long lists by binary search, and emits those that reach ``T``. A pair found in several
partitions is kept only in that of its first common value. No candidate is capped, and the counts
are exact.

Results are pairs of classes with the members of each; :func:`record_pairs` expands them in blocks
where single records are wanted, so a class of very many copies is spread over many tasks.

Defined cases: null values don't count and repeated ones count once; sets under ``min_size`` have
no pairs; null record ids are ignored; repeated rows of a record are united; empty tables give no
rows.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.runtime import attach, bounded_broadcast, materialize, release, rows_of, salted_join

PAIRS = "class_a long, class_b long, size_a int, size_b int, shared int"


def t_occurrence(lists: list[list[int]], need: int) -> list[tuple[int, int]]:
    """(id, count) for ids that are in at least ``need`` of the sorted lists (divide, then skip)."""
    if need < 1 or len(lists) < need:
        return []
    lists = sorted(lists, key=len)
    aside = min(need - 1, int(need / (0.01 * math.log2(len(lists[-1]) + 1) + 1)))
    short, long = lists[: len(lists) - aside], lists[len(lists) - aside :]
    t = need - aside
    pos = [0] * len(short)
    heap = [(x[0], k) for k, x in enumerate(short) if x]
    heapify(heap)
    out = []
    while len(heap) >= t:
        x = heap[0][0]
        taken = []
        while heap and heap[0][0] == x:
            taken.append(heappop(heap)[1])
        if len(taken) >= t:
            n = len(taken)
            for at, one in enumerate(long):
                if n + len(long) - at < need:
                    break
                p = bisect_left(one, x)
                n += p < len(one) and one[p] == x
            if n >= need:
                out.append((x, n))
            for k in taken:
                pos[k] += 1
                if pos[k] < len(short[k]):
                    heappush(heap, (short[k][pos[k]], k))
        else:
            while heap and len(taken) < t - 1:
                taken.append(heappop(heap)[1])
            if not heap:
                break
            y = heap[0][0]
            for k in taken:
                pos[k] = bisect_left(short[k], y, pos[k])
                if pos[k] < len(short[k]):
                    heappush(heap, (short[k][pos[k]], k))
    return out


def _needed(threshold: float, a: int, b: int) -> int:
    return max(1, math.ceil(threshold * (a + b) / (1 + threshold) - 1e-9))


def _block_pairs(index: list, probes: list, first: int, threshold: float, selfjoin: bool) -> list[tuple]:
    """Pairs of one partition. ``index`` and ``probes``: (class id, values); ``first``: its common value."""
    lists: dict[int, list[int]] = {}
    sizes = [len(values) for _, values in index]
    for at, (_, values) in enumerate(index):
        for v in values:
            lists.setdefault(v, []).append(at)
    smallest, largest = min(sizes), max(sizes)
    sets: dict[int, set[int]] = {}
    out = []
    for pid, values in probes:
        n = len(values)
        lo = max(smallest, math.ceil(threshold * n - 1e-9))
        if lo > (min(n, largest) if selfjoin else largest):
            continue
        mine = [lists[v] for v in values if v in lists]
        for at, shared in t_occurrence(mine, _needed(threshold, n, lo)):
            qid, other = index[at]
            m = sizes[at]
            if shared < _needed(threshold, n, m) or m < lo or (m > n / threshold + 1e-9):
                continue
            if selfjoin and (m > n or (m == n and qid >= pid)):
                continue
            others = sets.setdefault(at, set(other))
            if next(v for v in values if v in others) == first:
                out.append((qid, pid, m, n, shared))
    return out


def _kernel(threshold: float, selfjoin: bool):
    def run(key, light: pd.DataFrame, lists: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        values = {c: v.tolist() for c, v in zip(lists["c"].tolist(), lists["vals"], strict=True)}
        if len(light):
            light = light.sort_values(["w", "g", "ib", "pb", "probe"], kind="stable")
            w, probe, cid = light["w"].tolist(), light["probe"].to_numpy(), light["cid"].tolist()
            part = light[["w", "g", "ib", "pb"]].to_numpy()
            edge = np.nonzero(np.concatenate([[True], (part[1:] != part[:-1]).any(1)]))[0].tolist() + [len(part)]
            for a, b in zip(edge, edge[1:], strict=False):
                cut = a + int(np.searchsorted(probe[a:b], True))
                if cut == a or cut == b or (selfjoin and b - a == 2 and cid[a] == cid[b - 1]):
                    continue
                index, probes = ([(c, values[c]) for c in cid[i:j]] for i, j in ((a, cut), (cut, b)))
                out += _block_pairs(index, probes, w[a], threshold, selfjoin)
        return pd.DataFrame(out, columns=["class_a", "class_b", "size_a", "size_b", "shared"])

    return run


def set_classes(rows: DataFrame, record: Column | str, values: Column | str, min_size: int = 1, broadcast_values: int = 500_000) -> tuple[DataFrame, DataFrame]:
    """(classes: cid, vals sorted by rising frequency, alone (how many of the first occur nowhere else); members: record, cid), both written."""
    values = rows[values] if isinstance(values, str) else values
    record = rows[record] if isinstance(record, str) else record
    sets = (
        rows.where(record.isNotNull()).select(record.alias("record"), F.explode(values).alias("v")).where("v IS NOT NULL")
        .groupBy("record").agg(F.sort_array(F.collect_set("v")).alias("vs")).where(F.size("vs") >= min_size)
    )
    sets = materialize(sets, "sets")
    distinct = materialize(sets.select("vs").distinct().withColumn("cid", F.monotonically_increasing_id()), "distinct")
    freq = distinct.select(F.explode("vs").alias("v")).groupBy("v").count().orderBy("count", "v")
    codes = materialize(freq.select("v", F.monotonically_increasing_id().alias("code"), (F.col("count") == 1).cast("int").alias("one")), "codes")
    coded = distinct.select("cid", F.explode("vs").alias("v")).join(bounded_broadcast(codes, rows_of(codes), broadcast_values), "v")
    classes = coded.groupBy("cid").agg(F.sort_array(F.collect_list("code")).alias("vals"), F.sum("one").cast("int").alias("alone"))
    classes = materialize(classes, "classes")
    members = materialize(salted_join(sets, distinct, ["vs"], "inner").select("record", "cid"), "members")
    release(sets, distinct, codes)
    return classes, members


def similar_classes(index: DataFrame, probes: DataFrame | None, threshold: float, block_values: int = 500_000, bucket_values: int = 2_000_000) -> DataFrame:
    """class_a, class_b, sizes and shared values for classes (cid, vals) with Jaccard >= threshold.

    Within one table (``probes`` None) each unordered pair comes once; between two tables
    class_a is of ``index`` and class_b of ``probes`` (coded together).
    """
    selfjoin = probes is None
    t, eps = F.lit(threshold), F.lit(1e-9)
    ratio = math.log(max(1 / threshold, 1.001))
    size_range = lambda n: F.floor(F.log(n.cast("double")) / ratio + 1e-9).cast("int")

    def need(a: Column, b: Column) -> Column:
        return F.greatest(F.lit(1), F.ceil(t * (a + b) / (1 + t) - eps).cast("int"))

    def prefix(df: DataFrame, length: Column, probe: bool) -> DataFrame:
        skip = F.col("alone") if selfjoin and "alone" in df.columns else F.lit(0)  # values of one class find nobody
        ws = F.slice("vals", skip + 1, F.greatest(F.lit(0), length - skip))
        return df.select("cid", "n", "g", F.lit(probe).alias("probe"), F.explode(ws).alias("w"))

    n = F.size("vals")
    ix = index.withColumns({"n": n, "g": size_range(n)})
    ix = prefix(ix, n - (need(n, n) if selfjoin else need(n, F.ceil(n * t - eps).cast("int"))) + 1, False)
    least = F.greatest(F.lit(1), F.ceil(n * t - eps).cast("int"))
    most = n if selfjoin else F.floor(n / t + eps).cast("int")
    pr = (index if selfjoin else probes).withColumns({"n": n, "g": F.explode(F.sequence(size_range(least), size_range(most)))})
    lowest = F.greatest(least, F.floor(F.exp(F.col("g") * ratio) - 1e-6).cast("int"))  # of the partners in the range
    pr = prefix(pr, n - need(n, lowest) + 1, True)
    light = materialize(ix.unionByName(pr), "prefixes")
    sides = light.groupBy("w", "g").agg(*(F.sum(F.when(F.col("probe") == p, F.col("n")).otherwise(0)).alias(c) for c, p in (("vi", False), ("vp", True))))
    heavy = sides.where((F.col("vi") > block_values) | (F.col("vp") > block_values)).select("w", "g", *(F.ceil(F.col(v) / block_values).cast("int").alias(c) for v, c in (("vi", "ni"), ("vp", "np"))), (F.col("vi") + F.col("vp")).alias("weight"))
    cut = attach(light, materialize(heavy, "cuts"), ["w", "g"], "weight")
    ni, np_ = F.greatest(F.coalesce("ni", F.lit(1)), F.lit(1)), F.greatest(F.coalesce("np", F.lit(1)), F.lit(1))
    own = F.pmod(F.xxhash64("cid"), F.when(F.col("probe"), np_).otherwise(ni).cast("long")).cast("int")
    every = F.sequence(F.lit(0), F.when(F.col("probe"), ni).otherwise(np_) - 1)
    cut = cut.withColumn("own", own).withColumn("other", F.explode(every))
    cut = cut.withColumn("ib", F.when(F.col("probe"), F.col("other")).otherwise(F.col("own"))).withColumn("pb", F.when(F.col("probe"), F.col("own")).otherwise(F.col("other")))
    total = light.agg(F.sum("n")).first()[0] or 0
    buckets = max(1, total // bucket_values)
    placed = materialize(cut.select(F.pmod(F.xxhash64("w", "g", "ib", "pb"), F.lit(buckets)).alias("bucket"), "w", "g", "ib", "pb", "probe", "cid"), "placed")
    vals = index.select("cid", "vals") if selfjoin else index.select("cid", "vals").unionByName(probes.select("cid", "vals")).dropDuplicates(["cid"])
    wanted = placed.select(F.col("bucket").alias("b"), "cid").distinct()
    lists = salted_join(wanted, vals, ["cid"], "inner").select("b", F.col("cid").alias("c"), "vals")
    out = placed.groupBy("bucket").cogroup(lists.groupBy("b")).applyInPandas(_kernel(threshold, selfjoin), PAIRS)
    out = materialize(out, "pairs")
    release(light, placed)
    return out


def similar_sets(rows: DataFrame, record: Column | str, values: Column | str, threshold: float, min_size: int = 1) -> tuple[DataFrame, DataFrame]:
    """(pairs of classes of one table, members: record, cid)."""
    classes, members = set_classes(rows, record, values, min_size)
    return similar_classes(classes, None, threshold), members


def record_pairs(pairs: DataFrame, members: DataFrame, chunk: int = 1000) -> DataFrame:
    """record_a < record_b for all members of linked classes, and of one class among themselves.

    Members are held in chunks of about ``chunk``, and a link becomes one row for each pair of chunks, spread over the tasks.
    """
    sizes = materialize(members.groupBy("cid").agg(F.ceil(F.count(F.lit(1)) / chunk).alias("k")), "sizes")
    part = salted_join(members, sizes, ["cid"], "inner").withColumn("c", F.pmod(F.xxhash64("record"), F.col("k")))
    chunks = materialize(part.groupBy("cid", "c").agg(F.collect_list("record").alias("x"), F.first("k").alias("k")), "chunks")
    here = chunks.select(F.col("cid").alias("class_a"), F.col("c").alias("ca"), F.col("x").alias("xs"), "k")
    there = chunks.select(F.col("cid").alias("class_b"), F.col("c").alias("cb"), F.col("x").alias("ys"))
    linked = salted_join(pairs.select("class_a", "class_b"), sizes.select(F.col("cid").alias("class_b"), F.col("k").alias("kb")), ["class_b"], "inner")
    linked = salted_join(linked, here.drop("k"), ["class_a"], "inner").withColumn("cb", F.explode(F.sequence(F.lit(0).cast("long"), F.col("kb") - 1)))
    within = here.where("k > 1 OR size(xs) > 1").withColumn("cb", F.explode(F.sequence("ca", F.col("k") - 1))).withColumn("class_b", F.col("class_a"))
    cols = ["class_a", "ca", "xs", "class_b", "cb"]
    both = salted_join(linked.select(*cols).unionByName(within.select(*cols)), there, ["class_b", "cb"], "inner")
    if rows_of(sizes) < rows_of(chunks):  # pairs of full chunks grow a million times from here on
        both = both.repartition("class_a", "ca", "class_b", "cb")
    both = both.withColumn("same", (F.col("class_a") == F.col("class_b")) & (F.col("ca") == F.col("cb")))
    both = both.select("ys", "same", F.explode("xs").alias("x")).select("x", "same", F.explode("ys").alias("y")).where("NOT same OR x < y")
    return both.select(F.least("x", "y").alias("record_a"), F.greatest("x", "y").alias("record_b"))


def representatives(members: DataFrame) -> DataFrame:
    """cid, representative (the smallest record of the class), n (its records)."""
    return members.groupBy("cid").agg(F.min("record").alias("representative"), F.count(F.lit(1)).alias("n"))


def class_pairs(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """a < b (representatives of similar classes), size_a, size_b (of their sets), shared. With :func:`link_counts` this is every link, without copies expanded."""
    rep = representatives(members).select("cid", "representative")
    both = salted_join(pairs, rep.select(F.col("cid").alias("class_a"), F.col("representative").alias("x")), ["class_a"], "inner")
    both = salted_join(both, rep.select(F.col("cid").alias("class_b"), F.col("representative").alias("y")), ["class_b"], "inner")
    up = F.col("x") < F.col("y")
    return both.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), *(F.when(up, F.col(p)).otherwise(F.col(q)).alias(p) for p, q in (("size_a", "size_b"), ("size_b", "size_a"))), "shared")


def link_counts(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """record, representative, copies, links: one row per record, links counting all its partners (copies too)."""
    sizes = materialize(representatives(members), "representatives")
    ends = pairs.select(F.col("class_a").alias("cid"), F.col("class_b").alias("o")).union(pairs.select("class_b", "class_a"))
    far = salted_join(ends, sizes.select(F.col("cid").alias("o"), "n"), ["o"], "inner").groupBy("cid").agg(F.sum("n").alias("far"))
    per = sizes.join(far, "cid", "left").select("cid", "representative", F.col("n").alias("copies"), (F.coalesce("far", F.lit(0)) + F.col("n") - 1).alias("links"))
    return salted_join(members, per, ["cid"], "inner").select("record", "representative", "copies", "links")
