"""What changed between consecutive full snapshots.

Each delivery is reduced to one state (key, value digest) per key. States are spread over hash
buckets; per bucket and pair of deliveries the later one is subtracted from the earlier one as
invertible Bloom lookup tables (counts and XOR sums, so both sides fold into one aggregation that
combines before its shuffle). Only cells that differ from zero are left, and these are peeled in
Arrow batches. A bucket that can't be peeled is repeated with four times the cells and other hash
functions until it can; one that still can't with room for all its states several times over (two
keys with one digest) is compared key by key. The recovered digests are then verified against the
states, which also gives the keys back, and classified as added, removed or changed.

Defined cases: rows without key or snapshot are ignored; of several states of a key in one
snapshot the one with the greatest order value counts (then the greatest value); a null value
is a value of its own; with fewer than two snapshots the result is empty.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.runtime import bounded_broadcast, materialize, release, rows_of

#: Hash functions of a lookup table.
HASHES = 3
#: Fixed values of the public XXH64 hash.
P1, P2, P3, P4, P5 = (
    11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261,
)


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def hash_longs(*columns: np.ndarray) -> np.ndarray:
    """What Spark's ``xxhash64`` gives for bigint columns, over NumPy arrays."""
    with np.errstate(over="ignore"):
        seed = np.full(len(columns[0]), 42, np.uint64)
        for c in columns:
            h = seed + np.uint64(P5) + np.uint64(8)
            h ^= _rotl(c.astype(np.int64).view(np.uint64) * np.uint64(P2), 31) * np.uint64(P1)
            h = _rotl(h, 27) * np.uint64(P1) + np.uint64(P4)
            h ^= h >> np.uint64(33)
            h *= np.uint64(P2)
            h ^= h >> np.uint64(29)
            h *= np.uint64(P3)
            seed = h ^ (h >> np.uint64(32))
    return seed.view(np.int64)


def _slots(k1: np.ndarray, k2: np.ndarray, v: np.ndarray, seed: int, width: int) -> np.ndarray:
    """Cell numbers, one row for each hash function."""
    out = []
    for j in range(HASHES):
        h = hash_longs(k1, k2, v, np.full(len(k1), seed * HASHES + j, np.int64))
        out.append(j * width + np.mod(h, width))
    return np.array(out)


def peel(cells: pd.DataFrame, seed: int, width: int) -> tuple[pd.DataFrame, bool]:
    """Recover the elements of one subtracted table; False if cells remain.

    ``cells``: cell, n, k1, k2, v, c (signed count, XOR sums, XOR of checksums).
    """
    size = HASHES * width
    n, *x = (np.zeros(size, np.int64) for _ in range(5))
    at = cells["cell"].to_numpy()
    n[at] = cells["n"].to_numpy()
    for a, name in zip(x, ("k1", "k2", "v", "c"), strict=True):
        a[at] = cells[name].to_numpy()
    k1, k2, v, c = x
    out: list[np.ndarray] = []
    look = at
    while len(look):
        look = look[np.abs(n[look]) == 1]
        look = look[hash_longs(k1[look], k2[look], v[look]) == c[look]] if len(look) else look
        if not len(look):
            break
        got = np.unique(np.stack([k1[look], k2[look], v[look], n[look]], 1), axis=0)
        out.append(got)
        g1, g2, gv, gs = (np.ascontiguousarray(got[:, i]) for i in range(4))
        gc = hash_longs(g1, g2, gv)
        where = _slots(g1, g2, gv, seed, width)
        for row in where:
            np.subtract.at(n, row, gs)
            for a, b in zip(x, (g1, g2, gv, gc), strict=True):
                np.bitwise_xor.at(a, row, b)
        look = np.unique(where)
        if sum(map(len, out)) > 2 * size:  # inconsistent cells can't go on for ever
            break
    found = pd.DataFrame(np.concatenate(out) if out else np.zeros((0, 4), np.int64), columns=["k1", "k2", "v", "sign"])
    return found, not (n.any() or any(a.any() for a in x))


def _peeler(seed: int, width: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        got, ok = peel(group, seed, width)
        if not ok:
            got = pd.DataFrame({"k1": [0], "k2": [0], "v": [0], "sign": [0]})
        got["pair"], got["b"], got["ok"] = group["pair"].iloc[0], group["b"].iloc[0], ok
        return got[["pair", "b", "k1", "k2", "v", "sign", "ok"]]

    return run


def snapshot_states(rows: DataFrame, key: str, snapshot: Column, value: Column, order_by: str) -> DataFrame:
    """One state per snapshot and key: snapshot, key, value (null values become a mark)."""
    base = rows.select(
        snapshot.cast("string").alias("snapshot"), rows[key].cast("string").alias("key"),
        F.struct(rows[order_by].alias("o"), F.coalesce(value.cast("string"), F.lit("\0")).alias("value")).alias("s"),
    ).where("key IS NOT NULL AND snapshot IS NOT NULL")
    return base.groupBy("snapshot", "key").agg(F.max("s").alias("s")).select("snapshot", "key", "s.value")


def snapshot_changes(
    rows: DataFrame,
    key: str,
    snapshot: Column,
    value: Column,
    order_by: str,
    bucket_keys: int = 20_000,
    first_cells: float = 0.3,
    most_cells: int = 64,
) -> DataFrame:
    """snapshot, key, change_kind for each snapshot after the first against the one before.

    ``bucket_keys``: states of one snapshot in a bucket, about; ``first_cells``: cells of a
    bucket's first table as a share of that (a change takes two elements, and a table holds
    about 0.8 elements a cell); ``most_cells``: cells a state after which a bucket is compared instead.
    """
    spark = rows.sparkSession
    names = [r[0] for r in rows.where(rows[key].isNotNull()).select(snapshot.cast("string").alias("s")).distinct().where("s IS NOT NULL").orderBy("s").collect()]  # one row a delivery
    empty = spark.createDataFrame([], "snapshot string, key string, change_kind string")
    if len(names) < 2:
        return empty
    index = F.broadcast(spark.createDataFrame(list(zip(names, range(len(names)), strict=True)), "snapshot string, i int"))
    states = (
        snapshot_states(rows, key, snapshot, value, order_by).join(index, "snapshot")
        .select("i", "key", F.xxhash64("key").alias("k1"), F.xxhash64(F.lit(7), "key").alias("k2"), F.xxhash64(F.lit(11), "value").alias("v"))
    )
    states = materialize(states.withColumn("b", F.pmod(F.shiftright("k1", 20), F.lit(1 << 20)).cast("int")).repartition("b"), "states")
    most = states.groupBy("i").count().agg(F.max("count")).first()[0]
    buckets = max(1, -(-most // bucket_keys))
    keyed = states.withColumn("b", F.pmod("b", F.lit(buckets)))
    width = max(16, int(-(-min(bucket_keys, most) * first_cells // HASHES)))
    found: list[DataFrame] = []
    peeled_tables: list[DataFrame] = []
    todo: DataFrame | None = None
    compared: DataFrame | None = None
    seed = left = 0
    while True:
        sides = F.filter(F.array(
            F.struct(F.col("i").alias("pair"), F.lit(1).alias("sign")),
            F.struct((F.col("i") + 1).alias("pair"), F.lit(-1).alias("sign")),
        ), lambda s: (s["pair"] >= 1) & (s["pair"] < len(names)))
        elements = keyed.withColumn("s", F.explode(sides)).select("s.pair", "b", "s.sign", "k1", "k2", "v", F.xxhash64("k1", "k2", "v").alias("c"))
        if todo is not None:
            elements = elements.join(bounded_broadcast(todo, left), ["pair", "b"], "left_semi")
        slots = F.array(*(
            (F.lit(j * width) + F.pmod(F.xxhash64("k1", "k2", "v", F.lit(seed * HASHES + j).cast("long")), F.lit(width))).cast("int")
            for j in range(HASHES)
        ))
        cells = (
            elements.withColumn("cell", F.explode(slots)).groupBy("pair", "b", "cell")
            .agg(F.sum("sign").alias("n"), *(F.bit_xor(x).alias(x) for x in ("k1", "k2", "v", "c")))
            .where("n <> 0 OR k1 <> 0 OR k2 <> 0 OR v <> 0 OR c <> 0")
        )

        got = materialize(
            cells.groupBy("pair", "b").applyInPandas(_peeler(seed, width), "pair int, b long, k1 long, k2 long, v long, sign long, ok boolean"), "peeled"
        )
        peeled_tables.append(got)
        found.append(got.where("ok"))
        todo = got.where("NOT ok").select("pair", "b")
        left = todo.count()
        if not left:
            break
        seed, width = seed + 1, width * 4
        if width > most_cells * bucket_keys + 64:
            compared = _compare(keyed, todo, left)
            break
    peeled = found[0]
    for f in found[1:]:
        peeled = peeled.unionByName(f)
    kinds = peeled.groupBy("pair", "k1", "k2").agg(
        F.max("sign").alias("hi"), F.min("sign").alias("lo"),
        F.max(F.when(F.col("sign") == 1, F.col("v"))).alias("v_new"), F.max(F.when(F.col("sign") == -1, F.col("v"))).alias("v_old"),
    ).select(
        "pair", "k1", "k2", F.coalesce("v_new", "v_old").alias("v"),
        F.when(F.col("hi") < 0, F.col("pair") - 1).otherwise(F.col("pair")).cast("int").alias("i"),
        F.when(F.col("hi") < 0, "removed").when(F.col("lo") > 0, "added").otherwise("changed").alias("change_kind"),
    )
    kinds = materialize(kinds, "changes")
    rows_found = rows_of(kinds)
    verified = materialize(
        states.join(bounded_broadcast(kinds, rows_found), ["i", "k1", "k2", "v"]).select("pair", "key", "change_kind"), "verified"
    )
    if rows_of(verified) != rows_found:
        raise RuntimeError("a recovered digest has no state; the tables were peeled wrongly")
    if compared is not None:
        verified = materialize(verified.unionByName(compared), "verified")
    release(states, kinds, *peeled_tables)
    back = F.broadcast(spark.createDataFrame(list(zip(range(len(names)), names, strict=True)), "pair int, snapshot string"))
    return verified.join(back, "pair").select("snapshot", "key", "change_kind")


def _compare(keyed: DataFrame, todo: DataFrame, left: int) -> DataFrame:
    """pair, key, change_kind of the buckets of ``todo`` by an outer join of both sides' keys."""
    side = lambda shift, v: keyed.withColumn("pair", F.col("i") + shift).join(bounded_broadcast(todo, left), ["pair", "b"], "left_semi").select("pair", "key", F.col("v").alias(v))
    both = side(0, "now").join(side(1, "before"), ["pair", "key"], "full")
    kind = F.when(F.col("before").isNull(), "added").when(F.col("now").isNull(), "removed").when(F.col("now") != F.col("before"), "changed")
    return both.select("pair", "key", kind.alias("change_kind")).where("change_kind IS NOT NULL")
