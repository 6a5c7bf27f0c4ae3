import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from weftline.llm.setsim import class_pairs, link_counts, record_pairs, set_classes, similar_classes, similar_sets, t_occurrence


def brute(data, t, least):
    sets = {}
    for r, vs, *_ in data:
        if r is not None and vs is not None:
            sets.setdefault(r, set()).update(v for v in vs if v is not None)
    sets = {r: s for r, s in sets.items() if len(s) >= least}
    ids = sorted(sets)
    return sorted((a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if len(sets[a] & sets[b]) >= t * len(sets[a] | sets[b]) - 1e-9)


def data(n, seed, copies=0):
    rng = random.Random(seed)
    base = [sorted(rng.sample("abcdefghijklmnopqrst", rng.randrange(0, 11))) for _ in range(n // 3)]
    out = []
    for i in range(n):
        s = list(rng.choice(base))
        if s and rng.random() < 0.5:
            s[rng.randrange(len(s))] = rng.choice("abcxyz")
        out.append((f"r{i:03}", [*s, None] if rng.random() < 0.2 else s + s[:1], "clash"))
    return out + [(f"c{i:03}", list("abcdef"), "clash") for i in range(copies)] + out[:10] + [(None, list("abcd"), ""), ("null", None, ""), ("empty", [], "")]


SCHEMA = "record string, vals array<string>, cid string"


@pytest.mark.parametrize("t,least,seed", [(0.7, 4, 1), (0.5, 1, 2), (0.9, 2, 3)])
def test_equals_brute_force(spark, t, least, seed):
    d = data(120, seed, copies=15)
    got = rows(record_pairs(*similar_sets(spark.createDataFrame(d, SCHEMA), "record", "vals", t, least)))
    assert got == brute(d, t, least)


def test_hot_partitions_are_cut_into_blocks(spark):
    d = data(150, 5)
    classes, members = set_classes(spark.createDataFrame(d, SCHEMA), "record", "vals", 2)
    got = rows(record_pairs(similar_classes(classes, None, 0.6, block_values=20, bucket_values=200), members, chunk=2))
    assert got == brute(d, 0.6, 2)


def test_large_sets_and_many_copies(spark):
    big = [f"v{i}" for i in range(10_000)]
    d = [("a", big, ""), ("b", big[:-900], ""), ("c", big[2000:], ""), ("d", big[3500:], ""), *((f"x{i:04}", list("pqrs"), "") for i in range(400)), ("y", list("pqrst"), "")]
    pairs, members = similar_sets(spark.createDataFrame(d, SCHEMA), "record", "vals", 0.7, 4)
    linked = {(r["a"], r["b"], r["shared"]) for r in class_pairs(pairs, members).collect()}
    assert linked == {("a", "b", 9100), ("a", "c", 8000), ("b", "c", 7100), ("c", "d", 6500), ("x0000", "y", 4)}
    assert record_pairs(pairs, members, chunk=64).distinct().count() == 4 + 400 + 400 * 399 // 2
    got = {r["record"]: (r["representative"], r["copies"], r["links"]) for r in link_counts(pairs, members).collect()}
    assert got["y"] == ("y", 1, 400) and got["x0399"] == ("x0000", 400, 400) and got["c"] == ("c", 1, 3)


def test_two_tables(spark):
    d = data(90, 8)
    classes, members = set_classes(spark.createDataFrame(d, SCHEMA), "record", "vals", 2)
    even, odd = classes.where("cid % 2 = 0"), classes.where("cid % 2 = 1")
    within = similar_classes(classes, None, 0.6).select(F.least("class_a", "class_b").alias("a"), F.greatest("class_a", "class_b").alias("b"))
    across = similar_classes(even, odd, 0.6).select(F.least("class_a", "class_b").alias("a"), F.greatest("class_a", "class_b").alias("b"))
    assert rows(across) == rows(within.where("a % 2 <> b % 2"))


def test_links_count_all_partners(spark):
    d = data(60, 9, copies=5)
    pairs = brute(d, 0.7, 3)
    got = {r["record"]: r["links"] for r in link_counts(*similar_sets(spark.createDataFrame(d, SCHEMA), "record", "vals", 0.7, 3)).collect()}
    assert all(n == sum(r in p for p in pairs) for r, n in got.items())
    assert {r for p in pairs for r in p} <= set(got)


def test_empty(spark):
    assert record_pairs(*similar_sets(spark.createDataFrame([], SCHEMA), "record", "vals", 0.7, 3)).count() == 0


def test_t_occurrence_against_counting():
    rng = random.Random(1)
    for _ in range(300):
        lists = [sorted(rng.sample(range(30), rng.randrange(0, 15))) for _ in range(rng.randrange(1, 9))]
        need = rng.randrange(1, 8)
        want = [(i, n) for i in range(30) if (n := sum(i in x for x in lists)) >= need]
        assert sorted(t_occurrence(lists, need)) == want
