"""Items that appear together: pair counts, lift and pointwise mutual information.

(basket, item) rows are made distinct (combined before the shuffle), marginals counted, items that
cannot reach ``min_pair`` dropped (a pair is never more frequent than its items, so this loses
nothing), ordered pairs emitted and counted with map-side combination, and the measures computed
from the marginals. A basket over ``long_basket`` items is never gathered: its items are spread over
blocks of about that many by a hash, and every two of its blocks meet in a row of their own, so no
task emits all pairs of a huge basket.

Defined cases: null basket ids are ignored; null items never count; a basket without items still
counts in ``n``; repeated rows and repeated items count once; empty input gives no rows. Other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.operators.pairs import basket_pairs
from weftline.runtime import bounded_broadcast, materialize, release, rows_of


def cooccurrence(
    rows: DataFrame, basket: str, items: str, min_pair: int = 1, long_basket: int = 256, broadcast_items: int = 500_000
) -> DataFrame:
    """item_a < item_b, n, n_a, n_b, n_ab, lift, pmi for pairs in at least ``min_pair`` baskets."""
    each = rows.where(rows[basket].isNotNull()).select(rows[basket].alias("basket"), F.explode_outer(rows[items]).alias("item")).distinct()
    each = materialize(each, "items")
    sizes = materialize(each.groupBy("basket").agg(F.count("item").alias("c")), "baskets")
    n = rows_of(sizes)
    marginals = each.where("item IS NOT NULL").groupBy("item").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") >= min_pair)
    marginals = materialize(marginals, "marginals")
    kinds = rows_of(marginals)
    kept = each.join(bounded_broadcast(marginals.select("item"), kinds, broadcast_items), "item", "left_semi")
    pairs = basket_pairs(kept, sizes, long_basket)
    counts = pairs.groupBy("item_a", "item_b").agg(F.count(F.lit(1)).alias("n_ab")).where(F.col("n_ab") >= min_pair)
    side = bounded_broadcast(marginals, kinds, broadcast_items)
    out = counts.join(side.select(F.col("item").alias("item_a"), F.col("c").alias("n_a")), "item_a")
    out = out.join(side.select(F.col("item").alias("item_b"), F.col("c").alias("n_b")), "item_b")
    lift = F.col("n_ab") * F.lit(float(n)) / (F.col("n_a").cast("double") * F.col("n_b"))
    out = out.select("item_a", "item_b", F.lit(n).cast("long").alias("n"), "n_a", "n_b", "n_ab", lift.alias("lift"), F.log2(lift).alias("pmi"))
    out = materialize(out, "pairs")
    release(each, sizes, marginals)
    return out
