import random
import re

import numpy as np

from tests.conftest import rows

from weftline.llm import leakage
from weftline.llm.leakage import ItemIndex, _codes, banded_distances, canonical, find_leaks, leaked_passages

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega one two three four five six".split()


def brute(docs, items, words=12):
    out = set()
    for d, t in docs:
        c = canonical(t)
        for i, x in items:
            w = canonical(x).split()
            if w and any(f" {' '.join(w[k : k + words])} " in c for k in range(max(1, len(w) - words + 1))):
                out.add((d, i))
    return sorted(out)


def corpus(seed):
    rng = random.Random(seed)
    items = [(i, " ".join(rng.choices(WORDS, k=rng.randrange(1, 40))).capitalize() + "?") for i in range(25)] + [(100, "No!"), (101, ""), (102, None), (103, "x y"), (104, "Über-maß 12 für 3")]
    docs = []
    for d in range(200):
        text = rng.choices(WORDS, k=rng.randrange(0, 60))
        if rng.random() < 0.6:
            w = re.findall(r"\w+", rng.choice(items)[1] or "")
            k = rng.randrange(8, 16)
            text += w[:k] if rng.random() < 0.5 else w[-k:]
            text += rng.choices(WORDS, k=5)
        sep = rng.choice([" ", "  ", "\n> ", ", "])
        docs.append((d, sep.join(text).upper() if rng.random() < 0.3 else sep.join(text)))
    return docs + [(900, ""), (901, None), (902, "über MASS über-MASS? 12 für 3!"), (903, "say ÜBER maß 12, FÜR 3 now")], items


def leaked(d, i, **kw):
    return rows(leaked_passages(d, i, **kw).where("edits = 0").select("doc_id", "item_id"))


def test_exact_findings_equal_brute_force(spark):
    docs, items = corpus(7)
    d = spark.createDataFrame([(*x, 1) for x in docs], "doc_id long, text string, item_id int")
    i = spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, doc_id int")
    want = brute(docs, items)
    assert sorted(leaked(d, i)) == want
    assert sorted(leaked(d, i, block_chars=100)) == want
    assert leaked_passages(d.limit(0), i).count() == 0 and leaked_passages(d, i.limit(0)).count() == 0


def test_edited_passages_are_found():
    item = "the quick brown fox jumps over the lazy dog near a quiet river bank today"
    ix = ItemIndex([(1, item)], 6, 2, 12)
    doc = "intro words " + item.replace("jumps", "jumpz").replace("lazy", "lzy") + " and more"
    (row,) = find_leaks([(5, doc)], ix)
    assert row[:2] == (5, 1) and 1 <= row[2] <= 2
    assert find_leaks([(5, "the quick brown fox sat still while another lazy cat slept by a river")], ix) == []


def test_long_documents_are_cut_with_overlap():
    item = " ".join(WORDS[:15])
    doc = " ".join(random.Random(2).choices(WORDS, k=3000)) + " " + item + " " + " ".join(random.Random(3).choices(WORDS, k=3000))
    ix = ItemIndex([(1, item)], 10, 2, 12)
    for segment in (500, 1000, 7777):
        assert find_leaks([(1, doc)], ix, segment=segment)[0][:3] == (1, 1, 0)


def plain_distance(part, text):
    """Edit distance to the best stretch of a text."""
    row = [0] * (len(text) + 1)
    for i, ch in enumerate(part):
        new = [i + 1]
        for j, x in enumerate(text):
            new.append(min(row[j] + (ch != x), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def test_banded_distances_equal_plain_ones_within_the_budget():
    rng = random.Random(3)
    jobs = []
    for _ in range(200):
        text = "".join(rng.choices("abc ", k=rng.randrange(5, 40)))
        at = rng.randrange(0, len(text))
        part = list(text[at : at + rng.randrange(3, 15)])
        for _ in range(rng.randrange(0, 3)):
            k = rng.randrange(len(part) + 1)
            part[k : k + rng.randrange(0, 2)] = rng.choices("abcx", k=rng.randrange(0, 2))
        if part:
            jobs.append(("".join(part), text, at))
    whole = "\0".join(t for _, t, _ in jobs)
    first = np.cumsum([0] + [len(t) + 1 for _, t, _ in jobs])
    at = np.array([f + a for (_, _, a), f in zip(jobs, first, strict=False)])
    got = banded_distances([_codes(p) for p, _, _ in jobs], _codes(whole), at - 3, at + 3, np.full(len(jobs), 3), first[:-1], first[1:] - 1)
    for (p, t, _), d in zip(jobs, got, strict=True):
        best = plain_distance(p, t)
        assert best <= d and (best > 3 or d > 3 or d >= best)
    near = banded_distances([_codes("abc")], _codes("xxabxxcxx"), np.array([0]), np.array([4]), np.array([2]), np.array([0]), np.array([9]))
    assert near.tolist() == [1]


def near(docs, items, words=12, q=10, most=2):
    """Brute force: every window against every stretch of every document."""
    out = {}
    for i, x in items:
        w = canonical(x).split()
        for k in range(max(0, len(w) - words + 1) if len(w) >= words else min(1, len(w))):
            part = f" {' '.join(w[k : k + words])} "
            for d, t in docs:
                e = plain_distance(part, canonical(t))
                if e <= max(0, min(most, (len(part) - q) // q)):
                    best, cover = out.get((d, i), (9, set()))
                    out[d, i] = (min(best, e), cover | set(range(k, k + min(words, len(w)))))
    return {k: (e, len(c)) for k, (e, c) in out.items()}


def test_near_passages_and_cover_equal_brute_force():
    rng = random.Random(11)
    items = [(i, " ".join(rng.choices(WORDS, k=rng.randrange(7, 22)))) for i in range(6)]
    docs = []
    for d in range(25):
        text = " ".join(rng.choices(WORDS, k=6))
        for _ in range(2):
            w = rng.choice(items)[1].split()
            a = rng.randrange(0, 6)
            part = list(" ".join(w[a : a + rng.randrange(7, 16)]))
            for _ in range(rng.randrange(0, 3)):
                part[rng.randrange(len(part))] = rng.choice("abz")
            text += " " + "".join(part) + " " + " ".join(rng.choices(WORDS, k=3))
        docs.append((d, text))
    for words in (7, 12):
        want = near(docs, items, words)
        ix = ItemIndex(items, 10, 2, words)
        assert {r[:2]: (r[2], len(r[3])) for r in find_leaks(docs, ix)} == want
    old = leakage.MAX_HITS
    try:
        leakage.MAX_HITS = 50
        assert {r[:2]: (r[2], len(r[3])) for r in find_leaks(docs, ix)} == want
    finally:
        leakage.MAX_HITS = old


def test_the_bound_of_an_item_is_the_lowest_of_its_passages():
    item = "aaa bbb ccc ddd eee fff ggg hhhh iii"  # passages of 29, 30 and 30 characters
    doc = "some words then " + "bbb ccc ddd eee fff ggg hhhh".replace("ccc", "cxc").replace("ggg", "gxg") + " and others"
    whole, alone = (find_leaks([(1, doc)], ItemIndex([(1, x)], 10, 2, 7)) for x in (item, "bbb ccc ddd eee fff ggg hhhh"))
    assert [r[2] for r in alone] == [2] == [r[2] for r in whole]


def test_cover_of_split_leaks_is_united(spark):
    words = [f"{a}{b}" for a in WORDS[:6] for b in WORDS[6:11]]
    doc = " ".join(words[:13]) + " something else in between " + " ".join(words[15:28])
    (row,) = find_leaks([(1, doc)], ItemIndex([(9, " ".join(words))], 10, 2, 12))
    assert len(row[3]) == len(row[4]) == 26
    d = spark.createDataFrame([(1, " ".join(words[:13])), (1, " ".join(words[15:28])), (None, doc), (2, doc)], "doc_id long, text string")
    i = spark.createDataFrame([(9, " ".join(words)), (10, " ".join(words).upper())], "item_id long, text string")
    assert rows(leaked_passages(d, i)) == sorted([(x, y, 0, 26, 26, 30) for x in (1, 2) for y in (9, 10)], key=repr)
