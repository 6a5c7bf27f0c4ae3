"""2-D projection, clusters, alignment and rescaling of entity vectors."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.operators.neighbors import dense_neighbors
from weftline.runtime import materialize, row_numbers, rows_of, salted_join

#: The layout is fitted on at most so many points (all of them, or a hash sample); every other point is placed among its neighbours of those.
LANDMARKS = 50_000


def _smooth(group: pd.DataFrame) -> pd.DataFrame:
    """Edge weights of one point: exp(-(d - rho) / sigma), sigma so that they add up to log2(k)."""
    d = group["distance"].to_numpy(float)
    rho, goal = d.min(), math.log2(max(2, len(d)))
    lo, hi = 1e-6, 1e3
    for _ in range(48):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if np.exp(-np.maximum(0, d - rho) / mid).sum() < goal else (lo, mid)
    return pd.DataFrame({"id": group["id"], "neighbor_id": group["neighbor_id"], "w": np.exp(-np.maximum(0, d - rho) / hi)})


def curve_parameters(min_dist: float, spread: float = 1.0) -> tuple[float, float]:
    """(a, b) of 1 / (1 + a x^2b) fitted to the wanted fall-off, by a refined grid."""
    x = np.linspace(0, 3 * spread, 300)
    y = np.where(x < min_dist, 1.0, np.exp(-(x - min_dist) / spread))
    best, ra, rb = (1.5, 0.9), 1.4, 0.6
    for _ in range(8):
        grid = [(a, b) for a in np.linspace(max(0.05, best[0] - ra), best[0] + ra, 15) for b in np.linspace(max(0.2, best[1] - rb), best[1] + rb, 15)]
        best = min(grid, key=lambda p: float(((1 / (1 + p[0] * np.power(x, 2 * p[1])) - y) ** 2).sum()))
        ra, rb = ra / 2, rb / 2
    return float(best[0]), float(best[1])


def _layout(seed: int, epochs: int, a: float, b: float):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        points = group[group["neighbor_id"].isna()].sort_values("id")
        ids = points["id"].to_numpy(np.int64)
        at = {i: n for n, i in enumerate(ids)}
        y = points[["x", "y"]].to_numpy(float)
        y = 10 * (y - y.mean(0)) / max(1e-9, np.abs(y - y.mean(0)).max())
        e = group[group["neighbor_id"].notna()].sort_values(["id", "neighbor_id"])
        i = np.array([at[v] for v in e["id"].astype(np.int64)], int)
        j = np.array([at[v] for v in e["neighbor_id"].astype(np.int64)], int)
        w = e["w"].to_numpy(float)
        rng = np.random.default_rng(seed)
        for epoch in range(epochs if len(i) else 0):
            rate = 1.0 - epoch / epochs
            used = rng.random(len(i)) < w / w.max()
            p, q = i[used], j[used]
            d = y[p] - y[q]
            r2 = np.maximum((d**2).sum(1, keepdims=True), 1e-12)
            pull = np.clip(-2 * a * b * r2 ** (b - 1) / (1 + a * r2**b) * d, -4, 4) * rate
            np.add.at(y, p, pull)
            np.add.at(y, q, -pull)
            for _ in range(5):
                k = rng.integers(0, len(ids), len(p))
                d = y[p] - y[k]
                r2 = (d**2).sum(1, keepdims=True)
                push = np.clip(2 * b / ((0.001 + r2) * (1 + a * r2**b)) * d, -4, 4) * rate
                np.add.at(y, p, np.where((k == p)[:, None], 0, push))
        return pd.DataFrame({"id": ids, "x": y[:, 0], "y": y[:, 1]})

    return run


def linear_projection(vectors: DataFrame) -> DataFrame:
    """id, x, y: the two principal components."""
    v = vectors.select("id", array_to_vector(F.col("v").cast("array<double>")).alias("f"))
    m = PCA(k=2, inputCol="f", outputCol="p").fit(v)
    return m.transform(v).select("id", vector_to_array("p").alias("p")).select("id", F.col("p")[0].alias("x"), F.col("p")[1].alias("y"))


def _placed(others: DataFrame, marks: DataFrame, layout: DataFrame, neighbors: int) -> DataFrame:
    """id, x, y of points outside the layout: the mean of their nearest landmarks, weighted as the layout weighs neighbours."""
    near = dense_neighbors(others, marks, neighbors, exclude_self=False).select("id", "neighbor_id", (1 - F.col("similarity")).alias("distance"))
    w = near.groupBy("id").applyInPandas(_smooth, "id long, neighbor_id long, w double")
    at = salted_join(w, layout.select(F.col("id").alias("neighbor_id"), "x", "y"), ["neighbor_id"], "inner")
    total = F.sum("w")
    return at.groupBy("id").agg((F.sum(F.col("w") * F.col("x")) / total).alias("x"), (F.sum(F.col("w") * F.col("y")) / total).alias("y"))


def project(vectors: DataFrame, neighbors: int = 25, min_dist: float = 0.08, seed: int = 20240917, epochs: int = 200, landmarks: int = LANDMARKS) -> DataFrame:
    """id, x, y: a neighbourhood-preserving layout of unit vectors (UMAP's published algorithm).

    Exact neighbours, fuzzy union of their weights and a linear start run distributed. The layout
    itself is optimised in one seeded task over at most ``landmarks`` points, chosen by a hash where
    there are more; the others are then placed among their nearest landmarks, distributed again.
    Fewer than five points are put on the unit circle.
    """
    if vectors.schema["id"].dataType.simpleString() != "bigint":  # the layout counts on numbers
        numbered = materialize(row_numbers(vectors, ["id"], "_n"), "numbered")
        flat = project(numbered.select(F.col("_n").alias("id"), "v"), neighbors, min_dist, seed, epochs, landmarks)
        return numbered.select("id", "_n").join(flat.withColumnRenamed("id", "_n"), "_n").drop("_n")
    n = vectors.count()
    if n > landmarks:
        mark = F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(n)) < int(landmarks * 0.95)
        kept = materialize(vectors.where(mark).limit(landmarks), "landmarks")
        layout = materialize(project(kept, neighbors, min_dist, seed, epochs, landmarks), "layout")
        others = vectors.join(kept.select("id"), "id", "left_anti")
        return layout.unionByName(_placed(others, kept, layout, min(neighbors, max(1, rows_of(kept)))))
    if n < 5:
        rows = sorted(r["id"] for r in vectors.select("id").collect())  # at most four
        spark = vectors.sparkSession
        return spark.createDataFrame([(i, math.cos(2 * math.pi * k / max(1, n)), math.sin(2 * math.pi * k / max(1, n))) for k, i in enumerate(rows)], "id long, x double, y double")
    start = linear_projection(vectors)
    near = dense_neighbors(vectors, vectors, min(neighbors, n - 1)).select("id", "neighbor_id", (1 - F.col("similarity")).alias("distance"))
    one = near.groupBy("id").applyInPandas(_smooth, "id long, neighbor_id long, w double")
    back = one.select(F.col("neighbor_id").alias("id"), F.col("id").alias("neighbor_id"), F.col("w").alias("w2"))
    both = one.join(back, ["id", "neighbor_id"], "full").select("id", "neighbor_id", F.coalesce("w", F.lit(0.0)).alias("p"), F.coalesce("w2", F.lit(0.0)).alias("q"))
    graph = both.where("id < neighbor_id").select("id", "neighbor_id", (F.col("p") + F.col("q") - F.col("p") * F.col("q")).alias("w"))
    a, b = curve_parameters(min_dist)
    rows = graph.select("id", "neighbor_id", "w", F.lit(None).cast("double").alias("x"), F.lit(None).cast("double").alias("y")).unionByName(start.select("id", F.lit(None).cast("long").alias("neighbor_id"), F.lit(None).cast("double").alias("w"), "x", "y"))
    return rows.withColumn("all", F.lit(1)).groupBy("all").applyInPandas(_layout(seed, epochs, a, b), "id long, x double, y double")


def rescale(points: DataFrame) -> DataFrame:
    """Centred and divided by the 99th percentile of absolute coordinates, rounded to four places."""
    m = points.agg(F.avg("x").alias("mx"), F.avg("y").alias("my"))
    centred = points.join(F.broadcast(m), F.lit(True)).select("id", (F.col("x") - F.col("mx")).alias("x"), (F.col("y") - F.col("my")).alias("y"))  # one row
    scale = centred.select(F.explode(F.array(F.abs("x"), F.abs("y"))).alias("v")).agg(F.percentile("v", 0.99).alias("s"))
    safe = F.when(F.col("s") > 0, F.col("s")).otherwise(1.0)
    return centred.join(F.broadcast(scale), F.lit(True)).select("id", (F.round(F.col("x") / safe, 4) + 0.0).alias("x"), (F.round(F.col("y") / safe, 4) + 0.0).alias("y"))


def alignment_sums(now: DataFrame, before: DataFrame) -> DataFrame:
    """One row: count, means and centred cross products of the shared ids, the inputs of an alignment."""
    b = before.select("id", F.col("x").alias("u"), F.col("y").alias("v"))
    j = now.join(b, "id")
    n = F.count(F.lit(1))
    mean = {c: F.avg(c) for c in ("x", "y", "u", "v")}
    cross = {f"{a}{c}": F.sum(F.col(a) * F.col(c)) - n * mean[a] * mean[c] for a, c in (("x", "u"), ("x", "v"), ("y", "u"), ("y", "v"), ("x", "x"), ("y", "y"))}
    return j.agg(n.alias("n"), *(m.alias(f"m{c}") for c, m in mean.items()), *(m.alias(f"s{c}") for c, m in cross.items()))


def align(now: DataFrame, before: DataFrame, least: int = 8) -> DataFrame:
    """Rotation, scale and shift onto earlier coordinates (Procrustes); unchanged below ``least`` shared ids."""
    s = alignment_sums(now, before).first()
    if s["n"] < least:
        return now
    m = np.array([[s["sxu"], s["sxv"]], [s["syu"], s["syv"]]])
    u, d, vt = np.linalg.svd(m)
    r, spread = u @ vt, s["sxx"] + s["syy"]
    k = float(d.sum() / spread) if spread > 1e-12 else 1.0
    x, y = F.col("x") - s["mx"], F.col("y") - s["my"]
    return now.select("id", (k * (x * float(r[0, 0]) + y * float(r[1, 0])) + s["mu"]).alias("x"), (k * (x * float(r[0, 1]) + y * float(r[1, 1])) + s["mv"]).alias("y"))


def clusters(points: DataFrame, k: int = 24, seed: int = 20240917) -> DataFrame:
    """id, x, y, cluster: k-means on the plane, clusters numbered by falling size, then centre."""
    n = points.count()
    v = materialize(points, "points").withColumn("f", array_to_vector(F.array("x", "y")))
    found = KMeans(k=max(1, min(k, n)), seed=seed, featuresCol="f", predictionCol="c", initSteps=5).fit(v).transform(v).drop("f")
    rows = found.groupBy("c").agg(F.count(F.lit(1)).alias("n"), F.avg("x").alias("cx"), F.avg("y").alias("cy")).collect()  # at most k rows
    order = sorted(rows, key=lambda r: (-r["n"], r["cx"], r["cy"]))
    names = points.sparkSession.createDataFrame([(r["c"], i) for i, r in enumerate(order)], "c int, cluster int")
    return found.join(F.broadcast(names), "c").select("id", "x", "y", "cluster")


def cluster_summary(points: DataFrame) -> DataFrame:
    return points.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"), F.round(F.avg("x"), 4).alias("centroid_x"), F.round(F.avg("y"), 4).alias("centroid_y"))
