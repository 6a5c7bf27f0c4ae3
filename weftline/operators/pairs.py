"""Pairs of items of one basket, however long the basket."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.runtime import attach, materialize, rows_of, salted_join


def basket_pairs(each: DataFrame, sizes: DataFrame, long_basket: int = 256) -> DataFrame:
    """item_a < item_b of every basket. ``each``: distinct (basket, item); ``sizes``: basket, c (its items).

    A basket over ``long_basket`` items is never gathered: its items are spread over blocks of about that
    many by a hash, and every two of its blocks meet in a row of their own.
    """
    long = materialize(sizes.where(F.col("c") > long_basket).select("basket", F.ceil(F.col("c") / long_basket).alias("k"), "c"), "long")
    kept = attach(each, long, ["basket"], "c").withColumn("k", F.coalesce("k", F.lit(1).cast("long"))).withColumn("blk", F.pmod(F.xxhash64("item"), F.col("k")))
    blocks = kept.groupBy("basket", "blk").agg(F.sort_array(F.collect_list("item")).alias("xs"), F.first("k").alias("k"))
    if rows_of(long):
        blocks = materialize(blocks, "blocks")
    within = blocks.where(F.size("xs") > 1).select("xs", F.posexplode("xs").alias("p", "item_a"))
    pairs = within.select("item_a", F.explode(F.slice("xs", F.col("p") + 2, F.size("xs"))).alias("item_b"))
    if not rows_of(long):
        return pairs
    left = blocks.where("k > 1").withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("k") - 1))).where("blk < other")
    right = blocks.where("k > 1").select("basket", F.col("blk").alias("other"), F.col("xs").alias("ys"))
    across = salted_join(left.select("basket", "blk", "other", "xs"), right, ["basket", "other"], "inner").repartition("basket", "blk", "other")
    across = across.select("ys", F.explode("xs").alias("x")).select("x", F.explode("ys").alias("y"))
    return pairs.unionByName(across.select(F.least("x", "y").alias("item_a"), F.greatest("x", "y").alias("item_b")))
