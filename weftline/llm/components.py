"""Consolidating pairwise matches into groups: connected components by randomised contraction.

Vertices get 64-bit ids in the order of their names. In each round every id passes through a fresh
bijective hash; each vertex hooks to the smallest hash among itself and its neighbours, and then on
to where that one hooks, edges are relabelled and deduplicated, and loops vanish. The expected number
of vertices falls by a constant factor a round, whatever the shape (chains and stars alike). At the
end the mappings are expanded from the last round back to the first, and the smallest member's id
is the group's label. All aggregations are of one long per key and combine before their shuffle;
relabelling and expansion joins salt hub vertices and huge groups, which are only looked for while the
rows of a round, or of its largest vertex, could make one. Rounds are cut with written tables, whose
rows are counted as they are written.

Defined cases: links with a null end, and links of a vertex with itself, are ignored (such a
vertex appears only if another link has it); repeated links count once; no links give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.runtime import materialize, release, rows_of, salted_join

#: Rounds after which the contraction is taken to have gone wrong; thousands of times the expected need.
MAX_ROUNDS = 500


def _fresh(c: str, r: int) -> Column:
    """Round ``r``'s hash: xxhash64 of one long is a bijection, so no two ids collide."""
    return F.xxhash64(F.col(c).bitwiseXOR(F.lit((r * 7046029254386353131 + 1) % (1 << 63))))


def connected_components(edges: DataFrame, a: str, b: str, hot_rows: int = 500_000) -> DataFrame:
    """node, component: every linked node with the smallest node of its group."""
    links = edges.select(F.least(edges[a], edges[b]).alias("a"), F.greatest(edges[a], edges[b]).alias("b"), edges[a].isNull().alias("x"), edges[b].isNull().alias("y"))
    links = materialize(links.where("NOT x AND NOT y AND a <> b").select("a", "b").distinct(), "links")
    nodes = links.select(F.col("a").alias("node")).union(links.select("b")).distinct().orderBy("node")
    nodes = materialize(nodes.withColumn("id", F.monotonically_increasing_id()), "nodes")
    e = links
    for end in ("a", "b"):
        e = salted_join(e, nodes.select(F.col("node").alias(end), F.col("id").alias(f"{end}_id")), [end], "inner", hot_rows, rows=rows_of(links))
    e = materialize(e.select(F.col("a_id").alias("u"), F.col("b_id").alias("v")), "edges0")
    release(links)
    hooks: list[DataFrame] = []
    while rows_of(e):
        r = len(hooks)
        if r == MAX_ROUNDS:
            raise RuntimeError("the contraction didn't end")
        e_h = e.select(_fresh("u", r).alias("u"), _fresh("v", r).alias("v"))
        one = materialize(
            e_h.union(e_h.select("v", "u")).groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("degree"))
            .select("u", F.least("u", "m").alias("next"), "degree"), "hook",
        )
        # The largest vertex bounds what a relabelling join can bring together.
        most = one.agg(F.max("degree")).first()[0] if rows_of(e) > hot_rows else rows_of(e)
        ahead = one.select(F.col("u").alias("next"), F.col("next").alias("rep"))
        hook = materialize(salted_join(one.select("u", "next"), ahead, ["next"], "inner", hot_rows, rows=min(rows_of(one), most + 1)).select("u", "rep"), f"hook{r}")
        after = e_h
        for end in ("u", "v"):
            to = hook.select(F.col("u").alias(end), F.col("rep").alias(f"{end}_rep"))
            after = salted_join(after, to, [end], "inner", hot_rows, rows=most)
        after = after.where("u_rep <> v_rep").select(F.least("u_rep", "v_rep").alias("u"), F.greatest("u_rep", "v_rep").alias("v")).distinct()
        after = materialize(after, f"edges{r + 1}")
        release(e, one)
        hooks.append(hook)
        e = after
    root: DataFrame | None = None  # u (as hooked in the round), root (in the last hash it went through), last (that round)
    for r in range(len(hooks) - 1, -1, -1):
        to = hooks[r].select("u", "rep")
        if root is None:
            new = to.select("u", F.col("rep").alias("root"), F.lit(r).alias("last"))
        else:  # groups that went on end where the later rounds lead
            later = root.select(F.col("u").alias("h"), F.col("root").alias("r2"), F.col("last").alias("l2"))
            new = salted_join(to.withColumn("h", _fresh("rep", r + 1)), later, ["h"], "left", hot_rows, rows=rows_of(hooks[r]))
            new = new.select("u", F.coalesce("r2", "rep").alias("root"), F.coalesce("l2", F.lit(r)).alias("last"))
        old, root = root, materialize(new, f"expand{r}")
        release(old, hooks[r])
    if root is None:
        return nodes.select("node", F.col("node").alias("component"))
    placed = materialize(nodes.withColumn("u", _fresh("id", 0)).join(root, "u").select("node", "id", "root", "last"), "placed")
    labels = placed.groupBy("root", "last").agg(F.min("id").alias("id"))
    names = labels.join(nodes.select("id", F.col("node").alias("component")), "id").select("root", "last", "component")
    out = materialize(salted_join(placed, names, ["root", "last"], "inner", hot_rows).select("node", "component"), "groups")
    release(nodes, root, placed)
    return out
