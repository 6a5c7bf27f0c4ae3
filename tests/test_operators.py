from datetime import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from weftline.functions import vectors as V
from weftline.operators import filters as L
from weftline.operators import judging as J
from weftline.operators import neighbors as N
from weftline.operators import normalize as M
from weftline.operators import ontology as O
from weftline.operators import projection as P
from weftline.operators import publish as B
from weftline.operators import quality as Q
from weftline.operators import search as R
from weftline.operators import shortlist as S
from weftline.operators import web as W
from weftline.operators.filters import FilterSpec

EV = "array<struct<document_id: string, quote: string>>"
JUDGED = f"company_id string, tag_id string, decision string, confidence double, evidence {EV}, created_at int, judgment_id string, shortlist_reason string"


def judged(spark, data):
    return spark.createDataFrame([(c, t, d, x, [("doc", "q")] if e else [], n, f"{c}{t}{n}", "alias") for c, t, d, x, e, n in data], JUDGED)


def test_last_wins_and_ties(spark):
    log = judged(spark, [("a", "t", "yes", 0.6, 1, 1), ("a", "t", "yes", 0.95, 1, 2), ("a", "t", "no", 0.95, 1, 2), (None, "t", "yes", 0.9, 1, 1), ("b", None, "yes", 0.9, 1, 1)])
    got = J.last_wins(log, ["company_id", "tag_id"], ["created_at", "judgment_id"], ["decision", "confidence"])
    assert rows(got) in ([("a", "t", "yes", 0.95)], [("a", "t", "no", 0.95)]) and rows(got) == rows(got)
    assert J.last_wins(log.limit(0), ["company_id"], ["created_at"], ["decision"]).count() == 0


def test_only_confident_evidenced_yes_becomes_a_feature(spark):
    log = judged(spark, [("a", "t", "yes", 0.9, 1, 1), ("a", "u", "yes", 0.3, 1, 1), ("b", "t", "no", 0.95, 1, 1), ("c", "t", "uncertain", 0.8, 1, 1), ("d", "t", "yes", 0.9, 0, 1)])
    (r,) = J.sparse_features(log, 4).collect()
    assert (r["company_id"], r["tag_id"]) == ("a", "t") and r["feature_value"] == pytest.approx(r["calibrated_confidence"] * r["information_weight"], abs=1e-5)


def test_stability(spark):
    assert rows(J.inter_run_stability(judged(spark, [("a", "t", "yes", 0.9, 1, 1)]))) == [(0, None, None)]
    two = judged(spark, [("a", "t", "yes", 0.9, 1, 1), ("a", "t", "no", 0.4, 1, 2)])
    assert rows(J.inter_run_stability(two)) == [(1, 0.0, 0.5)]


def test_evidence(spark):
    log = spark.createDataFrame([("j", [("d", "Real  SPAN"), ("d", "invented"), ("x", "real span"), ("d", "the of"), ("d", None)])], f"judgment_id string, evidence {EV}")
    docs = spark.createDataFrame([("d", "a real span here"), ("d", None)], "document_id string, text string")
    got = {(r["document_id"], r["quote"]): r["verified"] for r in J.verified_evidence(log, docs).collect()}
    assert got == {("d", "Real  SPAN"): True, ("d", "invented"): False, ("x", "real span"): False, ("d", "the of"): False, ("d", None): False}


def test_gold_without_matches_is_null(spark):
    j = judged(spark, [("a", "t", "yes", 0.9, 1, 1)])
    assert J.gold_scores(j, j.where("false")).first()["precision"] is None
    assert J.gold_scores(j, j).first()["f1"] == 1.0


def test_sparse_neighbours(spark):
    f = spark.createDataFrame([("a", "t1", 1.0), ("a", "t2", 1.0), ("b", "t1", 1.0), ("b", "t2", 1.0), ("c", "t1", 1.0), ("d", "t9", 1.0)], "entity string, label string, value double")
    for block in (8192, 2):
        got = [(r["neighbor"], r["similarity"]) for r in N.sparse_neighbors(f, 5, block=block).where("entity = 'a'").orderBy("rank").collect()]
        assert got == [("b", 1.0), ("c", 0.5)]


def test_sparse_neighbours_leave_out_only_what_cannot_be_best(spark):
    """Long lists, ties and several parts, against all pairs; no row is repeated for blocks."""
    import numpy as np

    rng = np.random.default_rng(1)
    n, labels = 4000, 30
    held = rng.random((n, labels)) < 0.6 / (1 + np.arange(labels) % 10)
    w = np.where(held, rng.integers(1, 12, (n, labels)) / 8, 0.0)
    index = N._Lists(np.cumsum((w > 0).sum(axis=1)), *(x(w) for x in (lambda w: np.nonzero(w)[1].astype(np.int32), lambda w: w[w > 0])), labels)
    for me in range(0, n, 37):
        if w[me].any():
            m = np.minimum(w, w[me]).sum(axis=1)
            sims = np.round(m / (w.sum(axis=1) + w[me].sum() - m), 9)
            sims[me] = 0
            want = [i for i in np.argsort(-sims, kind="stable")[:8] if sims[i] > 0]
            got, s = index.best(np.nonzero(w[me])[0], w[me][w[me] > 0], 8, me)
            assert got.tolist() == want and np.allclose(s, sims[want], atol=1e-9)
    f = spark.createDataFrame([(f"e{i:03}", f"t{j}", float(w[i, j])) for i in range(300) for j in range(labels) if held[i, j]] + [(None, "t1", 1.0), ("e001", None, 1.0)], "entity string, label string, value double")
    one = N.sparse_neighbors(f, 4)
    assert "CoGroup" not in one._jdf.queryExecution().toString()
    assert rows(one) == rows(N.sparse_neighbors(f, 4, block=500)) and None not in {r["neighbor"] for r in one.collect()}


def test_dense_neighbours_of_a_large_base_are_not_repeated(spark):
    """Several parts against all pairs, near ties among them; the base and the queries are not repeated in a shuffle."""
    import numpy as np

    rng = np.random.default_rng(2)
    v = rng.standard_normal((700, 8))
    v[350:] = v[:350] + rng.standard_normal((350, 8)) * 1e-8
    v[600:] = v[0]
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    sims = np.round(v @ v.T, 9)
    np.fill_diagonal(sims, -9)
    want = [(i, int(j)) for i in range(len(v)) for j in np.argsort(-sims[i], kind="stable")[:5]]
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, v array<double>")
    for got in (N.dense_neighbors(df, df, 5), N.dense_neighbors(df, df, 5, block=100, broadcast_numbers=0)):
        assert "CoGroup" not in got._jdf.queryExecution().toString()
        assert [(r["id"], r["neighbor_id"]) for r in got.orderBy("id", "rank").collect()] == want


def test_dense_neighbours_in_blocks_with_ties(spark):
    v = spark.createDataFrame([(i, [1.0, 0.0] if i % 2 else [0.0, 1.0]) for i in range(9)], "id long, v array<double>")
    a, b = rows(N.dense_neighbors(v, v, 3)), rows(N.dense_neighbors(v, v, 3, block=2, broadcast_numbers=0))
    assert a == b == rows(N.dense_neighbors(v, v, 3, broadcast_numbers=0)) and N.dense_neighbors(v.limit(0), v, 3).count() == 0 == N.dense_neighbors(v, v.limit(0), 3).count()
    pairs = rows(N.similar_in_groups(v.withColumn("grp", F.col("id") % 4), 0.5, block=2))
    assert [(r[0], r[1]) for r in pairs] == [(0, 4), (0, 8), (1, 5), (2, 6), (3, 7), (4, 8)] and [r[1] for r in a if r[0] == 0] == [2, 4, 6]


def test_pointers(spark):
    t = spark.createDataFrame([("a", None), ("b", "a"), ("c", "b"), ("x", "y"), ("y", "x"), ("d", "gone"), ("m", None)], "n string, p string")
    got = dict(rows(O.follow_pointers(t, "n", "p", F.col("n") != "m")))
    assert got == {"a": "a", "b": "a", "c": "a", "x": None, "y": None, "d": None, "m": None}


TAGS = "tag_id string, canonical_name string, state string, merged_into string, aliases array<string>, source_company_ids array<string>, positive_examples array<string>, support_count int"
PROPOSALS = "n int, source_tag_id string, target_tag_id string, verdict string, adjudication string, applied boolean"


def test_merges_are_migrations(spark):
    tags = spark.createDataFrame([(i, i.upper(), "active", None, [], [i + "1"], [i], 1) for i in "abc"] + [("old", "OLD", "merged", "a", None, None, None, 0), ("lost", "L", "merged", "gone", None, None, None, 0)], TAGS)
    p = spark.createDataFrame([(1, "b", "a", "auto_merge", None, None), (2, "c", "b", "review", "merge", False), (3, "a", "c", "review", "unclear", None), (4, "a", "lost", "auto_merge", None, None), (5, "nope", "a", "auto_merge", None, None), (6, "a", "old", "auto_merge", None, None)], PROPOSALS)
    out, done = O.apply_merges(tags, p, ["n"])
    by = {r["tag_id"]: r for r in out.collect()}
    assert by["c"]["merged_into"] == "a" == by["b"]["merged_into"] and by["a"]["source_company_ids"] == ["a1", "b1", "c1"] and by["a"]["aliases"] == ["B", "C"] and by["a"]["support_count"] == 3
    assert [r["applied"] for r in done.orderBy("n").collect()] == [True, True, False, False, False, False]
    assert rows(O.apply_merges(out, done, ["n"])[0]) == rows(out)


def test_merges_in_circles_equal_one_by_one(spark):
    import random

    rng = random.Random(8)
    for _ in range(3):
        names = [f"t{i}" for i in range(9)]
        plan = [(n, *rng.sample(names, 2), "auto_merge", None, None) for n in range(30)]
        to = {}

        def end(x, to=to):
            while x in to:
                x = to[x]
            return x

        want = set()
        for n, a, b, *_ in plan:
            if a not in to and end(b) != a:
                to[a] = end(b)
                want.add(n)
        tags = spark.createDataFrame([(i, i, "active", None, [], [i], [], 1) for i in names], TAGS)
        got = O.accepted_merges(tags, spark.createDataFrame(plan, PROPOSALS), ["n"]).collect()
        assert {r["at"] for r in got} == want and {r["source"]: r["target"] for r in got} == {a: end(a) for a in to}


def test_the_most_similar_pairs_are_put_to_a_model(spark):
    from weftline.sources.models import Deterministic

    tags = spark.createDataFrame([(1, "Field pumps", "product", "Pumps for fields"), (2, "Field pump", "product", "Pumps for fields"), (3, "Court records", "market", "Law")], "id long, name string, facet string, definition string")
    c = spark.createDataFrame([(1, 2, 0.9, "review"), (1, 3, 0.88, "review"), (2, 3, 0.87, "review"), (3, 2, 0.99, "auto_merge")], "source_id long, target_id long, similarity double, verdict string")
    got = {(r["source_id"], r["target_id"]): r["adjudication"] for r in O.adjudicate(c, tags, Deterministic(), most=2).collect()}
    assert got == {(1, 2): "merge", (1, 3): "distinct", (2, 3): None, (3, 2): None}


def minted(rows_, taken=()):
    """One by one, in order."""
    used, out = set(taken), []
    for _, name, facet in rows_:
        base = next(x for x in [f"{name}", f"{facet}-{name}", *(f"{name}-{i}" for i in range(2, 999))] if x not in used)
        used.add(base)
        out.append(base)
    return out


def test_ids_and_activation(spark):
    import random

    t = spark.createDataFrame([(1, "AI", "x"), (2, "ai", "y"), (3, "A I", "x"), (4, "a.i", "x"), (5, "ai!", "y")], "n int, name string, facet string")
    assert [r["minted_id"] for r in O.mint_ids(t, "name", "facet", ["n"]).orderBy("n").collect()] == ["ai", "y-ai", "a-i", "x-a-i", "ai-2"]
    foo = [(1, "foo", "f"), (2, "foo", "f"), (3, "foo", "f"), (4, "foo-2", "f"), (5, "f-foo", "g")]
    got = [r["minted_id"] for r in O.mint_ids(spark.createDataFrame(foo, "n int, name string, facet string"), "name", "facet", ["n"]).orderBy("n").collect()]
    assert got == minted(foo) == ["foo", "f-foo", "foo-2", "f-foo-2", "g-f-foo"]
    rng = random.Random(2)
    many = [(i, rng.choice(["a", "b", "a-2", "x-a", "b-3", "a-2-2"]), rng.choice(["x", "a", "b"])) for i in range(40)]
    got = [r["minted_id"] for r in O.mint_ids(spark.createDataFrame(many, "n int, name string, facet string"), "name", "facet", ["n"], spark.createDataFrame([("a",), ("b-2",)], "id string")).orderBy("n").collect()]
    assert len(set(got)) == 40 and not {"a", "b-2"} & set(got) and got == minted(many, ("a", "b-2"))
    c = spark.createDataFrame([("candidate", 1, "d" * 20), ("candidate", 3, "d" * 20), ("candidate", 3, "thin"), ("merged", 9, "d" * 20)], "s string, n int, d string")
    assert [r[0] for r in c.select(O.activation(F.col("s"), F.col("n"), F.col("d"))).collect()] == ["candidate", "active", "candidate", "merged"]


def test_positions_without_one_task_window(spark):
    out = O.diverse_batches(spark.range(100).repartition(7), 100, 30, [F.col("id")])
    assert rows(out.select("id", "position", "batch")) == sorted([(i, i, i % 3) for i in range(100)], key=repr)


COMPANIES = "company_id string, batch string, batch_year int, industry string, subindustry string, regions array<string>, status string, stage string, tag_ids array<string>, tag_scores array<double>, top_company boolean, is_hiring boolean, nonprofit boolean, cluster_id int"


def three(spark):
    return spark.createDataFrame([
        ("a", "Winter 2012", 2012, "B2B", "B2B -> X", ["US", "Remote"], "Active", "Growth", ["t1", "t2"], [0.9, 0.2], True, False, False, 0),
        ("b", "Summer 2020", 2020, "Health", None, ["US"], None, None, ["t2"], [0.8], False, True, False, 1),
        ("c", None, None, None, None, [], "Inactive", "Early", [], [], False, False, True, 1),
    ], COMPANIES)


@pytest.mark.parametrize(
    "spec,want",
    [
        (FilterSpec(), "abc"), (FilterSpec(batches=["Winter 2012"]), "a"), (FilterSpec(year_from=2012, year_to=2020), "ab"), (FilterSpec(industries=["Health"], subindustries=["B2B -> X"]), "ab"), (FilterSpec(industries=["B2B -> X"]), "a"), (FilterSpec(stages=["Growth"]), "a"), (FilterSpec(statuses=["Active"]), "a"),
        (FilterSpec(regions=["Remote"]), "a"), (FilterSpec(tags=["t1", "t2"]), "a"), (FilterSpec(tags=["t1", "t2"], tag_mode="or"), "ab"), (FilterSpec(tags=["t2"], min_score=0.5), "b"), (FilterSpec(min_score=0.1), "ab"), (FilterSpec(nonprofit=True), "c"),
        (FilterSpec(clusters=["1"]), "bc"), (FilterSpec(ids=["a", "c"]), "ac"), (FilterSpec(facets=["f"]), "a"),
    ],
)
def test_filters(spark, spec, want):
    tags = spark.createDataFrame([("t1", "f"), ("t9", "f")], "tag_id string, facet string")
    assert "".join(sorted(r[0] for r in L.apply_filters(three(spark), spec, tags).select("company_id").collect())) == want
    assert FilterSpec.from_query(spec.to_query()) == spec


def test_an_absent_stage_is_the_empty_stage(spark):
    assert rows(L.apply_filters(three(spark), FilterSpec(stages=[""])).select("company_id")) == [("b",)]


def test_filter_urls_forgive():
    s = FilterSpec.from_query("?year_from=abc&min_score=x&tags=a~~b&tag_mode=or&top_company=1")
    assert (s.year_from, s.min_score, s.tags, s.tag_mode, s.active()) == (None, 0.0, ["a", "b"], "or", 2)


def test_predicates_reach_the_scan(spark, tmp_path):
    three(spark).write.parquet(str(tmp_path / "c"))
    plan = spark.read.parquet(str(tmp_path / "c")).where(L.predicate(FilterSpec(year_from=2015, statuses=["Active"]))).select("company_id")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(batch_year,2015)" in plan and "tag_ids" not in plan


def search_index(spark):
    docs = [("1", "Acme", "rockets for coyotes", "space"), ("2", "Acme Tools", "hammers", ""), ("3", "Other", "we like acme and machine learning", "machine learning"), ("4", "Machinery", "learning lathes", None)]
    return R.build_index(spark.createDataFrame(docs, "i string, n string, o string, g string"), "i", ("n", "o", "g"))


def test_search(spark):
    ix = search_index(spark)
    ids = lambda q, **k: [r["doc"] for r in R.search(ix, q, **k).collect()]
    assert ids("acme")[:2] == ["1", "2"]
    assert ids('"machine learning"') == ["3"]
    assert set(ids("machine learning")) == {"3", "4"}
    assert ids("hammars") == ["2"] and ids("rocket")[0] == "1" and ids("zzz") == [] and ids("") == []
    assert ids("hammars", fuzzy=False) == [] and ids("rocket", prefix=False, fuzzy=False) == [] and ids("acme", limit=1) == ["1"]
    few = spark.createDataFrame([("2",), ("3",), ("4",)], "company_id string")
    got = R.search_within(ix, "acme", few, "company_id").orderBy("place").collect()
    assert [(r["company_id"], r["place"]) for r in got] == [("2", 0), ("3", 1)] and R.search_within(ix, "acme", few, "company_id", limit=1).count() == 1 and R.search_within(ix, " ", few, "company_id").count() == 3
    assert R.search(ix, "acme").where("doc = '3'").select(R.explain_match().alias("why"), "terms").first() == (["one-liner"], ["acme"])
    plan = ix.postings.where("term = 'acme'")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(term,acme)" in plan
    ix.drop()


def test_snippets(spark):
    text = "x" * 200 + " needle " + "y" * 200
    (s,) = spark.createDataFrame([(text,)], "t string").select(R.snippet(F.col("t"), ["needle"])).first()
    assert s[0]["text"].startswith("…") and [p["text"] for p in s if p["hit"]] == ["needle"] and s[-1]["text"].endswith("…")


def test_lift_names_what_is_distinctive(spark):
    m = spark.createDataFrame([(i, i // 10) for i in range(20)], "id long, cluster int")
    t = spark.createDataFrame([(i, "all") for i in range(20)] + [(i, "first") for i in range(8)] + [(15, "single")], "id long, term string")
    top = B.lift_labels(m, t)
    assert [r["term"] for r in top.where("cluster = 0").orderBy("rank").collect()] == ["first", "all"]
    labels = {r["cluster"]: (r["label"], r["label_source"]) for r in B.cluster_labels(m, top.where("cluster = 0"), top.where("false")).collect()}
    assert labels == {0: ("first · all", "tags"), 1: ("Cluster 1", "fallback")}


def test_explanations_use_rare_facts(spark):
    f = spark.createDataFrame([(i, ["status: Active", *(["batch: W12"] if i in (1, 2) else [])]) for i in range(20)], "id long, facts array<string>")
    e = spark.createDataFrame([(1, 2), (3, 4)], "id long, neighbor_id long")
    assert rows(B.neighbor_explanations(e, f)) == [(1, 2, ["batch: W12"])]


def test_explanations_search_for_their_edges_once(spark):
    f = spark.createDataFrame([(i, ["batch: W12"] if i in (1, 2) else []) for i in range(20)], "id long, facts array<string>")
    e = spark.createDataFrame([(1, 2), (3, 4)], "id long, neighbor_id long").mapInPandas(lambda bs: bs, "id long, neighbor_id long")
    out = B.neighbor_explanations(e, f)
    assert "MapInPandas" not in out._jdf.queryExecution().toString() and rows(out) == [(1, 2, ["batch: W12"])]


def test_shared_items_travel_as_numbers(spark, monkeypatch):
    e = spark.createDataFrame([(1, 2), (1, 3), (2, 3)], "id long, neighbor_id long")
    i = spark.createDataFrame([(1, "b"), (1, "a"), (1, "c"), (2, "c"), (2, "b"), (2, "x"), (3, "z")], "id long, k string")
    k = spark.createDataFrame([("a", "A"), ("b", None), ("c", "C"), ("z", "Z")], "k string, name string")
    coded = B.shared_items(e, i, k, "k", ["k"], "name", 2)
    assert rows(coded) == [(1, 2, [None, "C"])] and "element_at" in coded._jdf.queryExecution().toString()
    monkeypatch.setattr(B, "CODED", 0)
    assert rows(B.shared_items(e, i, k, "k", ["k"], "name", 2)) == [(1, 2, [None, "C"])]


def test_index_round_trip(spark):
    c = three(spark).withColumn("name", F.lit("N")).withColumn("one_liner", F.lit("")).withColumn("team_size", F.lit(0))
    compact = B.compact_index(c)
    back = B.expand_index(compact).orderBy("company_id").collect()
    assert back[0]["tag_ids"] == ["t1", "t2"] and back[2]["regions"] == [] and back[1]["top_company"] is False
    assert '"t":0' in B.index_json(compact).where("company_id = 'a'").first()["row"]


def test_gates_find_one_violation_each_and_survive_errors(spark):
    bad = spark.createDataFrame([("a", float("nan"), 1.5), ("b", 1.0, 0.5), (None, 2.0, None)], "company_id string, x double, confidence double")
    known = spark.createDataFrame([("b",)], "company_id string")
    got = {r["gate"]: (r["passed"], r["violations"]) for r in Q.run_gates(spark, {
        "ids": lambda: Q.gate("ids", Q.missing_values(bad, ["company_id"]), F.lit("x")), "finite": lambda: Q.gate("finite", Q.not_finite(bad, ["x"]), F.col("company_id")), "fk": lambda: Q.gate("fk", Q.dangling(bad, ["company_id"], known, ["company_id"]), F.col("company_id")),
        "range": lambda: Q.gate("range", Q.outside(bad, "confidence"), F.col("company_id")), "good": lambda: Q.gate("good", bad.where("false"), F.col("company_id")), "crash": lambda: Q.gate("crash", bad.where("nope = 1"), F.lit(1)),
    }).collect()}
    assert got == {"ids": (False, 1), "finite": (False, 1), "fk": (False, 1), "range": (False, 1), "good": (True, 0), "crash": (False, -1)}


def test_alignment_undoes_a_turn(spark):
    p = spark.createDataFrame([(i, float(i % 5), float(i * i % 7)) for i in range(20)], "id long, x double, y double")
    turned = p.select("id", (-F.col("y")).alias("x"), F.col("x").alias("y"))
    back = {r["id"]: (r["x"], r["y"]) for r in P.align(turned, p).collect()}
    assert all(back[r["id"]] == pytest.approx((r["x"], r["y"]), abs=1e-4) for r in p.collect())
    assert rows(P.align(turned.limit(5), p)) == rows(turned.limit(5))


def test_projection_is_repeatable_and_finite(spark):
    v = spark.createDataFrame([(i, [float(i % 3 == j) + 0.01 * i * (j == 3) for j in range(4)]) for i in range(30)], "id long, v array<double>").select("id", V.l2_normalize(F.col("v")).alias("v"))
    a = P.rescale(P.project(v, neighbors=5, epochs=30))
    assert rows(a) == rows(P.rescale(P.project(v, neighbors=5, epochs=30))) and all(abs(r["x"]) < 10 for r in a.collect())
    assert P.project(v.limit(3)).count() == 3
    some = P.project(v, neighbors=5, epochs=10, landmarks=20)  # the others are placed among the landmarks
    assert sorted(r["id"] for r in some.collect()) == list(range(30)) and some.where("isnan(x) OR x IS NULL").count() == 0
    assert {r["id"] for r in P.project(v.withColumn("id", F.concat(F.lit("k"), "id")), neighbors=5, epochs=5).collect()} == {f"k{i}" for i in range(30)}
    assert P.cluster_summary(P.clusters(a, 3)).agg(F.sum("size")).first()[0] == 30


def test_normalisation(spark):
    raw = spark.createDataFrame([("r:1", '{"id":1,"name":" A  B ","batch":"Winter 2012","tags":["x","x"," "],"team_size":"-3","launched_at":1e30,"new":{"a":1}}'), ("r:2", '{"id":2}'), ("r:3", "[]"), ("r:4", "nonsense"), ("r:5", None)], "company_id string, payload string")
    good, bad = M.parse_payloads(raw)
    (c,) = M.normalize_companies(good).collect()
    assert (c["name"], c["batch_year"], c["source_tags"], c["team_size"], c["launched_at"]) == ("A B", 2012, ["x"], None, None)
    assert c["source_taxonomy_term_ids"] == ["tag:x", "batch:winter-2012"] and c["metadata_document"].startswith("A B is a directory company. It participated in the Winter 2012 batch, in 2012.")
    assert bad.count() == 4


def test_alias_hits_are_whole_words(spark):
    tags = spark.createDataFrame([("t1", "Data Pipelines", ["etl"]), ("t2", "art", None), ("t3", "smart", [])], "tag_id string, canonical_name string, aliases array<string>")
    texts = spark.createDataFrame([("e", "our data pipeline is smart"), ("f", None), ("g", "")], "entity string, text string")
    assert rows(S.alias_hits(texts, tags)) == [("e", "t1"), ("e", "t3")]


def test_shortlist_rules(spark):
    sims = spark.createDataFrame([("e", f"t{i}", "f" if i < 5 else "g", 1 - i / 10) for i in range(10)], "entity string, tag_id string, facet string, score double")
    extra = spark.createDataFrame([("e", "t8")], "entity string, tag_id string")
    parents = spark.createDataFrame([("t0", "t9")], "tag_id string, parent_id string")
    got = {r["tag_id"]: r["reason"] for r in S.shortlist(sims, aliases=extra, parents=parents, size=2, hard_negatives=1).collect()}
    assert got["t0"] == got["t1"] == "retrieval" and got["t5"] == "facet_prior" and got["t8"] == "alias" and got["t9"] == "parent" and list(got.values()).count("hard_negative") == 1


def test_web(spark):
    resolver = {"ok.example": ("8.8.8.8",), "in.example": ("8.8.8.8", "10.0.0.1")}
    urls = [
        ("https://ok.example/x", None), ("ftp://ok.example", "scheme"), ("http://", "no host"), ("http://localhost/", "blocked host"), ("http://ok.example:8080", "port"), ("http://127.0.0.1", "not public"), ("http://[::1]/", "not public"), ("http://169.254.169.254/", "not public"),
        ("http://in.example", "not public"), ("http://none.example", "does not resolve"), (None, "scheme"), ("http://u:p@OK.example.:443?q", None), ("javascript:alert(1)", "scheme"), ("http://www.bad.example", "denied domain"), ("http://[::ffff:10.0.0.1]/", "not public"), ("https://8.8.8.8/a:b", None), ("", "scheme"),
    ]
    df = spark.createDataFrame([(u, p) for u, p in urls], "u string, want string").coalesce(1)
    got = df.select("u", "want", W.url_problem(F.col("u"), ("bad.example",), lambda h: resolver.get(h, ())).alias("got")).collect()
    assert [(r["u"], r["got"]) for r in got] == [(r["u"], r["want"]) for r in got]
    html = "<html><head><title>T  x</title></head><body><nav>menu menu</nav><main><div class='cookie-banner'>accept</div><p>Real text</p><p>real TEXT</p><script>var x</script><p>ab</p>More<br>lines</main><footer>foot</footer></body></html>"
    assert W.page_text(html) == ("T x", "Real text\nMore\nlines")
    df = spark.createDataFrame([(1, html), (2, None), (3, "<article>" + "<p>line %d</p>" * 2 % (1, 2))], "k int, h string")
    got = {r["k"]: r["text"] for r in W.extract_pages(df, "k", "h").collect()}
    assert got[2] == "" and got[3] == "line 1line 2" or got[3] == "line 1\nline 2"
    robots = spark.createDataFrame([("User-agent: *\nDisallow: /x", "http://a/x"), (None, "http://a/x")], "t string, u string")
    assert [r[0] for r in robots.select(W.robots_allowed(F.col("t"), F.col("u"), "bot")).collect()] == [False, True]


def test_incremental_and_cache(spark):
    new = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", None)], "k string, h string")
    old = spark.createDataFrame([("a", "1"), ("b", "9"), ("c", None)], "k string, h string")
    assert {r["k"]: r["change"] for r in M.incremental(new, old.where("k <> 'b'").union(old.where("k = 'b'")), "k", "h").collect()} == {"a": "same", "b": "changed", "c": "same"}
    now = F.lit(dt(2024, 1, 31)).cast("timestamp")
    cache = spark.createDataFrame([("x", dt(2024, 1, 30)), ("y", dt(2023, 12, 1))], "k string, t timestamp")
    assert [r["k"] for r in M.fresh(cache, "t", 720, now).collect()] == ["x"]
    pages = spark.createDataFrame([("a", False, "new"), ("b", True, "new")], "k string, ok boolean, v string")
    before = spark.createDataFrame([("a", True, "old"), ("z", True, "old")], "k string, ok boolean, v string")
    assert rows(M.keep_last_success(pages, before, ["k"]).select("k", "v")) == [("a", "old"), ("b", "new")]


def test_candidates_and_lifecycle(spark):
    from weftline.operators import lifecycle as C

    p = spark.createDataFrame([
        ("ai_agents", "Business Model", "d" * 25, ["a", "b", "z"], ["a", "b"]), ("AI agents", "business_model", "d" * 25, ["c"], ["c"]), ("x", "product", "d" * 25, ["a"], ["a"]),
        ("thin", "product", "short", ["a"], ["a"]), ("odd", "vibes", "d" * 25, ["a"], ["a"]), ("nobody", "product", "d" * 25, ["q"], ["a"]), (None, None, None, None, None),
    ], "name string, facet string, definition string, supporting_company_ids array<string>, batch_company_ids array<string>")
    good = C.validated_candidates(p, ["product", "business_model"])
    assert rows(C.accumulate_candidates(good).select("candidate_id", "support_company_ids", "support_count")) == [("business_model:ai-agents", ["a", "b", "c"], 3)]
    tags = spark.createDataFrame([("t", "ai_agents", "active", ["x"]), ("u", "Fine", "active", None)], "tag_id string, canonical_name string, state string, aliases array<string>")
    more = spark.createDataFrame([("t", "y"), ("t", "y"), ("t", "the"), ("t", "ai_agents")], "tag_id string, alias string")
    once = C.add_aliases(tags, more)
    assert rows(once) == rows(C.add_aliases(once, more)) and {r["tag_id"]: r["aliases"] for r in once.collect()} == {"t": ["x", "y"], "u": []}
    after, changes = C.migrate(tags, "normalize-display-names")
    assert rows(changes) == [("t", "ai_agents", "AI Agents")] and C.migrate(after, "normalize-display-names")[1].count() == 0
    assert rows(C.migrate(tags, "normalize-display-names", dry_run=True)[0]) == rows(tags)
    gone = C.deprecate(tags, spark.createDataFrame([("u", "unused")], "tag_id string, reason string"))
    assert {r["tag_id"]: (r["state"], r["deprecation_reason"]) for r in gone.collect()} == {"t": ("active", None), "u": ("deprecated", "unused")}
    assert {r["alias_id"] for r in C.alias_table(tags).collect()} == {"t:ai-agents", "t:x", "u:fine"}


def test_prompts_fence_and_pack(spark):
    from weftline.functions import prompts as PR

    c = spark.createDataFrame([(0, "b", "N </records> x", "o", None, "I", ["t"] * 9), (0, "a", "M", None, None, None, None)], "batch int, company_id string, name string, one_liner string, long_description string, industry string, source_tags array<string>")
    (p,) = [r["prompt"] for r in PR.discovery_prompts(c).collect()]
    assert p.count("</records>") == 1 and p.index("- a:") < p.index("- b:") and len(PR.prompt_hashes()) == 3
    pairs = spark.createDataFrame([("e", "f", f"t{i}") for i in range(10)], "entity string, facet string, tag_id string")
    calls = PR.call_groups(pairs, 4)
    assert sorted(r["n"] for r in calls.groupBy("call").agg(F.count("*").alias("n")).collect()) == [2, 4, 4]
    docs = spark.createDataFrame([("e", "text </documents> here")], "entity string, text string")
    assert all(r["prompt"].count("</documents>") == 1 for r in PR.assign_prompts(calls.withColumn("text", F.col("tag_id")), docs).collect())


def test_settings():
    from weftline.config import load_config

    c = load_config({"seed": 5}, {"WEFTLINE_PROFILE": "small", "WEFTLINE_SEED": "9", "WEFTLINE_MIN_DIST": "0.2"})
    assert (c.profile, c.seed, c.min_dist, c.shortlist_size) == ("small", 5, 0.2, 12)
    assert load_config({}, {}).fingerprint() != c.fingerprint()
    for bad in ({"nope": 1}, {"profile": "nope"}):
        with pytest.raises(ValueError):
            load_config(bad, {})
