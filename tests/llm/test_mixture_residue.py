from collections import defaultdict

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF, rows
from weftline.llm.notices import fit
from weftline.llm.mixture import count_tokens, distinct_texts, feasible_total, mix_plan, mix_report, mix_sources, rake
from weftline.llm.residue import corpus_model, is_residue, mine, mine_templates, residue_documents, scan_text

MODEL = fit([["We sell pumps to farms in the north.", "It saves drivers two hours a day."]])


def kind(unit):
    """What a text of one unit comes to."""
    slots, shorts, texts, doubt = scan_text(unit, MODEL, {})
    return "slot" if slots else "doubt" if doubt else "text" if texts else "short" if shorts else "around"


DOCS = "doc_id long, text string, lang string, source string, kind string, tokens int, digest string"


def test_raking_meets_the_sources_and_the_caps():
    cells = pd.DataFrame([("a", "en", "x", 1000), ("a", "de", "x", 500), ("b", "en", "y", 3000), ("c", "en", "x", 10)], columns=["source", "lang", "topic", "tokens"])
    w = rake(cells, {"a": 0.5, "b": 0.3, "c": 0.2}, {"a": 3, "b": 1, "c": 4}, total=2000)
    got = (w["tokens"] * w["weight"]).groupby(w["source"]).sum()
    assert got["a"] == pytest.approx(1000, rel=1e-3) and got["b"] == pytest.approx(600, rel=1e-3) and got["c"] == pytest.approx(40)
    assert (w["weight"] <= w["source"].map({"a": 3, "b": 1, "c": 4}) + 1e-9).all()


def test_mixture(spark):
    docs = [(i, f"text number {i} says a few words about thing {i % 7}", "EN" if i % 2 else None, "big" if i % 4 else "small", "k", 1, "z") for i in range(400)]
    docs += [(1000 + i, docs[0][1], "en", "big", "k", 1, "z") for i in range(50)] + [(2000, "", "en", "big", "k", 0, ""), (2001, None, None, "big", None, 0, ""), (2002, "alone here", "en", "other", "k", 0, "")]
    df = spark.createDataFrame(docs, DOCS).drop("tokens", "digest")
    counted = count_tokens(df, "kind")
    texts = distinct_texts(counted).cache()
    assert texts.count() == 401  # copies count once, blank texts never
    targets = spark.createDataFrame([("big", 0.5, 1), ("small", 0.5, 3), ("absent", 0.0, 2)], "source string, target_share double, max_repeats int")
    plan = mix_plan(texts, targets)
    mixed = mix_sources(texts, plan)
    used = defaultdict(int)
    for r in mixed.collect():
        used[r["source"]] = max(used[r["source"]], r["repeats"])
    assert used["big"] <= 1 and used["small"] <= 3 and "other" not in used
    report = {(r["marginal"], r["value"]): r for r in mix_report(texts, mixed, targets, plan).collect()}
    small, big = report["source", "small"], report["source", "big"]
    assert small["share"] == pytest.approx(0.5, abs=0.01) and report["source", "absent"]["tokens_drawn"] == 0 and report["source", "other"]["share"] == 0
    assert not small["exhausted"] and not big["exhausted"] and abs(small["residual"]) < 60 and {m for m, _ in report} == {"source", "lang", "topic"}
    assert rows(mix_sources(texts.repartition(3), plan)) == rows(mixed)
    short = mix_plan(texts, spark.createDataFrame([("big", 0.1, 1), ("small", 0.9, 1)], "source string, target_share double, max_repeats int"))
    told = {r["value"]: r["exhausted"] for r in mix_report(texts, mix_sources(texts, short), targets.withColumn("target_share", F.when(F.col("source") == "small", 0.9).otherwise(0.1)), short).where("marginal = 'source'").collect()}
    assert told["small"] and not told["big"]
    cells = pd.DataFrame({"source": ["a", "b"], "tokens": [100, 10]})
    assert feasible_total(cells, {"a": 0.5, "b": 0.5, "none": 0.1}, {"a": 1, "b": 3, "none": 1}) == 60
    assert mix_sources(texts.limit(0), mix_plan(texts.limit(0), targets)).count() == 0


@pytest.mark.parametrize(
    "unit",
    ["Hi {{ first_name }}, thanks.", "Welcome to ${city}, home of us.", "© [Company Name]", "Founded in <year> by <YOUR_NAME>.", "Team size: null.", "Founded in [object Object].", "About %(city)s", "Trusted by *|COMPANY|* teams.", "(year goes here)", "Industry: None, regions: None", "«company_name» est ici.", "Click edit to change this text.", "__CITY__ opened."],
)
def test_slots(unit):
    assert kind(unit) == "slot"


@pytest.mark.parametrize(
    "unit",
    [
        "Writers type {{first_name}} in a subject line and we fill the merge field.", "Templates use ${amount} for totals.", "Its compiler flags undefined behaviour and null pointers.", "None of the builders had to change their forms.", "Ads cost $40 to $90 (plus 17%) per lead.",
        "The editor warns clerks about lorem ipsum left in a draft.", "A page not found costs 12 lost bookings a month, and the crawler repairs such links.", "Pages built with it work even where JavaScript is disabled, which brokers value.", "Our error budget is 75 minutes a month and we publish every internal server error.",
        'Send {"site": "Tarrow", "orders": 12} to the endpoint and read the reply.', "<p>Plain paragraph about nothing in particular here.</p>", "It stores them as <part, price> pairs [see note 12] for later.",
    ],
)
def test_texts_about_marks_are_texts(unit):
    assert kind(unit) != "slot"


def test_documents(spark):
    docs = [
        (1, "404 Page not found\nThe link you followed may be broken.\nHome | Blog | Contact"), (2, "Acme\nPlease enable JavaScript to view this page."), (3, "Lorem ipsum dolor sit amet consectetur.\n© 2026"), (4, "We sell pumps to farms in the north of the country. Some images were not found."),
        (5, "We sell pumps to farms. Contact {{email}} to learn more."), (6, ""), (7, None), (8, "   \n "), (9, "Home | Blog"), (12, "It may have been moved or deleted. Go back to the homepage or use the search."), (13, "ERR-1020 Account suspended - If the problem persists, contact the site owner."), (14, "Home\nTeam"), (10, "We sell pumps to farms in the north of the country. " * 3), (1, "404 Page not found\nThe link you followed may be broken.\nHome | Blog | Contact"), (None, "404 Page not found"), (15, "x" * 300_000),
    ]
    df = spark.createDataFrame([(*d, 1, "u") for d in docs], "doc_id long, text string, unit int, verdict string")
    got = [r[0] for r in residue_documents(df).where(is_residue()).select("doc_id").distinct().orderBy("doc_id").collect()]
    assert got == [1, 2, 3, 5, 12, 13]
    model = corpus_model(df)
    assert rows(residue_documents(df, model=model, broadcast_units=0)) == rows(residue_documents(df.repartition(5), model=model))
    assert residue_documents(df.limit(0)).count() == 0


def test_templates_are_the_same_however_rows_are_cut(spark):
    texts = [(i, f"Error: the file {w} could not be opened now") for i, w in enumerate("abcdefghijklmnopqrst")] + [(50, "Error: the file a could not be closed"), (51, "Error: the disk is full")]
    df = spark.createDataFrame(texts, "doc_id long, unit string").select("unit")
    whole = rows(mine(df))
    assert whole == rows(mine(df.repartition(7))) and {t for u, t in whole if u.endswith("opened now")} == {"Error: the file <*> could not be opened now"}
    assert dict(whole)["Error: the disk is full"] == "Error: the disk is full"


def test_support_decides_what_is_in_doubt_and_units_are_looked_at_themselves(spark):
    doubt = "Uploading is limited at the moment for guests."
    (_, _, _, ((_, p),)) = scan_text(doubt, MODEL, {})
    assert 0.2 <= p < 0.95
    ordinary = "We sell pumps to farms in the north. It saves drivers two hours a day."
    alone = spark.createDataFrame([(i, doubt) for i in range(4)], "doc_id long, text string")
    beside = spark.createDataFrame([(i, f"{ordinary} {doubt}") for i in range(10, 20)], "doc_id long, text string")
    found = lambda df: {r["doc_id"] for r in residue_documents(df, model=MODEL).where(is_residue()).collect()}
    assert found(alone) == {0, 1, 2, 3} and found(alone.union(beside)) == set() == found(beside)
    templates, units = mine_templates(alone.union(beside), model=MODEL)
    assert [(r["docs"], r["alone"], r["verdict"]) for r in templates.collect()] == [(14, 4, "text")] and units.count() == 1
    one = "The page was not found on this ledger harvest tractor later."
    pair = spark.createDataFrame([(1, "The page was not found on this server please try later."), (2, one)], "doc_id long, text string")
    assert found(pair) == found(pair.orderBy(F.desc("doc_id")))


#: Messages of the kinds looked for that are not among the labelled rules.
HELD_OUT = {
    ("error", "en"): ["Nothing lives at this URL.", "Hmm, that page doesn't seem to exist anymore.", "The requested resource is not available.", "Our servers are busy at the moment, please reload in a minute.", "Request blocked. Your IP was flagged by the firewall.", "An application error occurred on the server.", "Your login has expired, please sign in again.", "Could not reach the origin server.", "You are not allowed to open this document.", "Service offline for planned maintenance."],
    ("script", "en"): ["Scripts must be switched on to see this profile.", "This app needs JavaScript, please turn it on.", "Your browser has scripts disabled, so the page cannot be displayed."],
    ("filler", "en"): ["This text is only a placeholder and will be replaced.", "Sample paragraph, to be replaced before launch.", "Dolor sit amet consectetur adipiscing elit sed do eiusmod.", "test test asdf asdf test"],
    ("fill", "en"): ["Insert your company description here.", "Write a short text about your team here.", "Click here to change this text."],
    ("error", "de"): ["Die gesuchte Seite ist leider nicht mehr vorhanden.", "Der Server hat einen internen Fehler gemeldet.", "Sie haben keinen Zugriff auf diese Seite.", "Wegen Wartung ist der Dienst zur Zeit nicht verfügbar."],
    ("script", "de"): ["Um den Inhalt zu sehen, aktivieren Sie bitte JavaScript."],
    ("error", "es"): ["No hemos encontrado la página solicitada.", "El servidor encontró un error interno.", "No tiene acceso a esta página.", "Sitio en mantenimiento, vuelva más tarde."],
    ("script", "es"): ["Necesita activar JavaScript para ver este contenido."],
    ("error", "fr"): ["Nous n'avons pas trouvé la page demandée.", "Le serveur a rencontré une erreur interne.", "Vous n'avez pas accès à cette page.", "Site en maintenance, revenez plus tard."],
    ("script", "fr"): ["Pour voir ce contenu, activez JavaScript dans votre navigateur."],
}
ORDINARY = [
    "The clinic's new wing opened in spring and treats forty patients a day.", "We lease cranes to small ports and train their crews.", "Errors in invoices cost our clients time, so the product checks every line.", "Farmers read soil values on the phone and water less.", "Unser Team plant Schichten für Bäckereien und spart viel Papier.", "Las cooperativas comparten tractores y pagan por hora.",
    "Les ateliers commandent leurs pièces en ligne et les reçoivent le lendemain.", "Scripts for theatre groups are translated and printed by our staff.", "Permission slips for school trips are signed on a tablet.", "Maintenance of lifts is planned a year ahead and done at night.",
]


def test_held_out_messages(spark):
    model = corpus_model(spark.read.parquet(f"{SF}/documents.parquet"))

    def kind(unit):
        slots, _, _, doubt = scan_text(unit, model, {})
        return "slot" if slots else "doubt" if doubt and doubt[0][1] >= 0.5 else "no"

    hit = {k: [kind(u) in ("doubt", "slot") for u in us] for k, us in HELD_OUT.items()}
    share = {k: sum(v) / len(v) for k, v in hit.items()}
    flat = [x for v in hit.values() for x in v]
    false = [u for u in ORDINARY if kind(u) != "no"]
    print(false, {k: round(v, 2) for k, v in share.items()}, [u for k, us in HELD_OUT.items() for u, ok in zip(us, hit[k], strict=True) if not ok])
    assert sum(flat) / len(flat) >= 0.9 and min(share.values()) >= 0.5
    assert len(false) <= 2
