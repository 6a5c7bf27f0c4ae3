import math
from collections import Counter
from itertools import combinations

from tests.conftest import rows
from weftline.llm.cooccurrence import cooccurrence


def brute(data, least):
    sets = {}
    for b, items, *_ in data:
        if b is not None:
            sets.setdefault(b, set()).update(x for x in items or [] if x is not None)
    n, single = len(sets), Counter(x for s in sets.values() for x in s)
    pairs = Counter(p for s in sets.values() for p in combinations(sorted(s), 2))
    return {(a, b): (n, single[a], single[b], c) for (a, b), c in pairs.items() if c >= least}


DATA = [("1", ["a", "b", "a", None], "x"), ("1", ["c"], "y"), ("2", ["b", "a"], "x"), ("3", None, None), ("4", [], None), (None, ["a", "b"], None), ("5", [None], None), ("2", ["b", "a"], "x"), ("6", [f"i{k:02}" for k in range(40)], None)]


def test_counts_equal_brute_force_and_long_baskets_are_cut_alike(spark):
    df = spark.createDataFrame(DATA, "basket string, items array<string>, n string")
    for least in (1, 2):
        for cut in (256, 7, 2):
            got = {(r["item_a"], r["item_b"]): (r["n"], r["n_a"], r["n_b"], r["n_ab"]) for r in cooccurrence(df, "basket", "items", least, long_basket=cut).collect()}
            assert got == brute(DATA, least)


def test_lift_and_pmi(spark):
    df = spark.createDataFrame(DATA, "basket string, items array<string>, n string")
    r = cooccurrence(df, "basket", "items").where("item_a = 'a' AND item_b = 'b'").first()
    assert math.isclose(r["lift"], 2 * 6 / (2 * 2)) and math.isclose(r["pmi"], math.log2(r["lift"]))


def test_without_broadcast_and_empty(spark):
    df = spark.createDataFrame(DATA, "basket string, items array<string>, n string")
    assert rows(cooccurrence(df, "basket", "items", broadcast_items=0)) == rows(cooccurrence(df, "basket", "items"))
    assert cooccurrence(df.limit(0), "basket", "items").count() == 0
