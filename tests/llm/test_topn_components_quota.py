import random
from collections import Counter, defaultdict

from tests.conftest import rows
from weftline.llm.components import connected_components
from weftline.llm.quota_sample import cell_members, current_rows, plan_quotas, quota_sample, reservoirs
from weftline.llm.topn import top_n_per_group


def test_top_n_equals_brute_force_with_ties(spark):
    rng = random.Random(4)
    d = [(rng.choice(["g1", "g2", "hot", "hot", "hot", None]), rng.choice([f"i{k}" for k in range(40)] + [None]), rng.choice([0.1, 0.5, 0.9, 0.9, None, float("nan")]), 1) for _ in range(600)]
    best = defaultdict(dict)
    for g, i, s, _ in d:
        if g and i and s is not None and s == s:
            best[g][i] = max(s, best[g].get(i, s))
    want = sorted(((g, i, s, p) for g, m in best.items() for p, (s, i) in enumerate(sorted(((s, i) for i, s in m.items()), key=lambda x: (-x[0], x[1]))[:3], 1)), key=repr)
    df = spark.createDataFrame(d, "g string, item string, s double, place int")
    assert rows(top_n_per_group(df, "g", "item", "s", 3)) == want
    assert top_n_per_group(df.limit(0), "g", "item", "s", 3).count() == 0
    same = spark.createDataFrame([("g", f"i{k:03}", 1.0) for k in range(500)], "g string, item string, s double")
    assert [r[1] for r in rows(top_n_per_group(same, "g", "item", "s", 2))] == ["i000", "i001"]


def union_find(edges):
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = find(a), find(b)
            up[max(x, y)] = min(x, y)
    return sorted((v, find(v)) for v in up)


def test_components_equal_union_find(spark):
    rng = random.Random(5)
    chain = [(f"c{i:03}", f"c{i + 1:03}") for i in range(60)]
    star = [("hub", f"s{i}") for i in range(80)]
    rand = [(f"n{rng.randrange(200)}", f"n{rng.randrange(200)}") for _ in range(120)]
    edges = chain + star + rand + [(None, "x"), ("y", None), ("loop", "loop"), ("a", "b"), ("b", "a"), ("a", "b")]
    df = spark.createDataFrame([(*e, 1) for e in edges], "x string, y string, node int")
    assert rows(connected_components(df, "x", "y")) == union_find(edges)
    assert rows(connected_components(df, "x", "y", hot_rows=20)) == union_find(edges)
    assert connected_components(df.limit(0), "x", "y").count() == 0
    assert connected_components(df.where("x = 'loop'"), "x", "y").count() == 0


CELLS = [(1, "Retail", 2000, 2010), (2, "Retail", 2011, 2020), (3, "Unlisted", 0, 0), (4, "Mining", 0, 2020)]


def test_quota_sample(spark):
    rng = random.Random(6)
    base = [(f"k{i:04}", rng.choice(["Retail", " retail ", "RETAIL", None, "  ", "Other"]), rng.choice([None, 2005, 2015]), 1, "x") for i in range(900)]
    old = [(k, "Mining", 2005, 0, "x") for k, *_ in base[:200]]
    df = spark.createDataFrame(base + old + base[:50], "company string, industry string, year int, version int, key string")
    current = current_rows(df, "company", "version", ["industry", "year"])
    assert current.count() == 900
    plan = [(*c, t, m) for c, t, m in zip([*CELLS, (5, "retail", 2005, 2005)], (500, 300, 100, 100, 0), (3, 3, 200, 2, 5), strict=True)]
    cells = spark.createDataFrame(plan, "cell_id int, category string, lo int, hi int, target_permille int, min_count int")
    have = Counter()
    for _, ind, y, *_ in base:
        name = (ind or "").strip().lower() or "unlisted"
        for i, c, lo, hi, *_ in plan:
            have[i] += name == c.lower() and lo <= (y or 0) <= hi
    for run_rows in (20_000, 30):
        s = quota_sample(df, cells, "company", "version", "industry", "year", run_rows=run_rows)
        report = {r["cell_id"]: r for r in s.report().collect()}
        assert {i: r["available"] for i, r in report.items()} == {i: have[i] for i, *_ in plan} and report[1]["need"] == 45 and report[5]["drawable"] == 0
        drawn = rows(s.sample())
        assert Counter(c for c, _ in drawn) == +Counter(s.quotas()) and len({k for _, k in drawn}) == len(drawn)
        told = {r["cell_id"]: (r["drawn"], r["unmet"], r["reason"]) for r in s.outcome().collect()}
        assert told[3] == (min(have[3], 200), max(0, 200 - have[3]), "exhausted" if have[3] < 200 else None) and told[4][1:] == (9, "exhausted") and told[5] == (0, 5, "overlap")
        assert told[1][2] == told[2][2] == "crowded_out" and told[1][1] == 45 - told[1][0]
        if run_rows == 30:
            assert s.kept.runs.count() > 40 and drawn == before
        before = drawn
    empty = quota_sample(df.limit(0), cells, "company", "version", "industry", "year")
    assert empty.sample().count() == 0 and empty.report().count() == 5
    assert quota_sample(df, cells.limit(0), "company", "version", "industry", "year").sample().count() == 0


def test_quotas_add_up_and_report_what_is_missing():
    q = plan_quotas([(1, 0.6, 0, 1000), (2, 0.3, 0, 10), (3, 0.1, 25, 1000)], 100)
    assert sum(q.values()) == 100 and q[2] == 10 and q[3] == 25
    assert plan_quotas([(1, 1.0, 5, 3)], 100) == {1: 3}


def test_reservoirs_merge_and_draw_evenly(spark):
    cells = spark.createDataFrame([(1, "a", 0, 9)], "cell_id int, category string, lo int, hi int")
    current = spark.range(4000).selectExpr("CAST(id AS STRING) AS key", "'A' AS c", "1 AS y")
    whole = reservoirs(cell_members(current, cells, "c", "y"), 4000, 1000, run_rows=100)
    parts = reservoirs(cell_members(current.repartition(7), cells, "c", "y"), 4000, 1000, run_rows=100)
    got = [int(k) for _, k in rows(whole.trim({1: 1000}))]
    assert rows(whole.trim({1: 1000})) == rows(parts.trim({1: 1000})) and whole.trim({1: 0}).count() == 0
    assert len(got) == 1000 and 440 < sum(g < 2000 for g in got) < 560
    assert {k for _, k in rows(whole.trim({1: 300}))} < {k for _, k in rows(whole.trim({1: 1000}))}  # smallest priorities first
