"""Template residue and error-page text.

One pass over the documents cuts texts into units (sentences and lines), finds unfilled slots inside
them by their marks, and gives every unit a probability of being a notice by a small classifier
(:mod:`weftline.llm.notices`, fitted on a bounded labelled sample). Units that may be notices, a few
in a hundred, go on: message templates are mined over them with a prefix tree of fixed depth. Its
first levels are the number of tokens and the first two tokens; in a leaf a token is constant at its
place if it has its share of the leaf's units there, else it is a wildcard, and units of the same
constants are one template. Counts add up, so the tree is mined by aggregations that combine before
their shuffle, and is the same however rows are cut or ordered; no leaf is gathered.

Each template is classified once: by the mean probability of its units over the documents that hold
them and by its support, as log odds: a message stands alone in the documents that hold it, an ordinary
sentence beside others. The verdict goes back to the units, each of which has been checked
itself: one without any doubt is no notice whatever its template, and a sure one is.

* ``slot``: an unfilled slot, an instruction to fill one, or a program's word for no value;
* ``notice``: an error or block message, filler, stand-in copy, or a notice that scripts are needed;
* ``around``: names, titles, navigation, footers, bare codes;
* ``short``: other units of at most six words;
* ``text``: everything else, texts about such things included.

A document is residue if it has a slot anywhere, or a notice and no text (two notices may have one
short unit beside them, an unknown headline). Unresolved slots are found within ordinary units by
their marks, whose sentence must not be about the marks.

Defined cases: null and blank texts are no residue; a unit has no length limit; rows with one
document id are looked at each for itself, equal ones once; empty tables give no rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.notices import NoticeModel, fit
from weftline.runtime import materialize, release, rows_of, salted_join

UNIT_BREAK = re.compile(r"[\n\r\u2028\u2029]+|(?<=[.!?…])\s+")
#: Probabilities: a notice by itself; a unit in doubt, for its template to decide; an instruction to fill in; navigation.
SURE, DOUBT, FILL, AROUND = 0.95, 0.2, 0.7, 0.6
#: What a document that holds a template and no text, or text beside it, adds to the template's log odds of being a notice, and the most that all of them add.
ALONE, BESIDE, MOST = 0.5, -1.5, 6.0

# --- marks

_FIELD = (
    "name first_name last_name full_name company company_name companyname brand product city town country region location address "
    "year date month day amount price number phone email website url link headline title tagline slogan description summary founder "
    "owner industry sector batch team size team_size one_liner item item_title item.title category text content bio quote author role"
)
FIELDS = set(_FIELD.split())
_ID = r"[A-Za-z_][\w.\- |]*"
SLOT = re.compile(
    r"\{\{\{?[^{}\"]*\}?\}\}|[$#!]\{[^{}\"]*\}|\{[!$@%#]\s*" + _ID + r"\s*[%#]?\}|\{[#\d]+\}|\{" + _ID + r"\}|<%.*?%>|<\?.*?\?>|\[%.*?%\]"
    r"|%\([\w. ]+\)[sdrf]|%%?[A-Za-z_][\w.]*%%?|(?<![\w$])\$[A-Za-z_]\w*\$|@@?[A-Za-z_][\w. ]*@@?(?![\w.])|__[A-Za-z][\w ]*?__|\bXX_?\w+_?XX\b|\bX{3,}\b|_{4,}"
    r"|\[\[[^\[\]]+\]\]|\*\|[^|]+\|\*|##[A-Za-z_]\w*##|~~?[A-Z_]{3,}~~?|<<\s*" + _ID + r"\s*>>|\|\|?[A-Z_]{3,}\|\|?|\[object Object\]"
)
#: Marks that also have ordinary uses; their inside decides.
BRACKET = re.compile(r"(?<![!\]\w])\[([^\[\]]+)\](?!\()|<([A-Za-z][^<>]*)>|«\s?([^«»]{1,40})\s?»|\(([^()]+)\)")
#: Titled words in brackets that are links, not slots.
LINKS = set("home about blog docs documentation pricing careers jobs contact team help login status product products features support privacy terms imprint legal cookies search menu press news faq back top next previous download share more".split())
HTML = set("a abbr b blockquote body br button code dd div dl dt em footer form h h1 h2 h3 h4 h5 h6 head header hr html i iframe img input label li link main meta nav ol option p pre q s script section select small span strike strong style sub sup table tbody td th thead title tr tt u ul video".split())
HERE = re.compile(r"(?i)\bgoes here\b|^(?:insert|enter|add|your|type|fill in|write|replace with|put|choose|select)\b.*|.*\b(?:here|einfügen|eintragen|aquí|ici)$|^(?:ihr|ihre|votre|su|tu)\b.*")
NO_VALUE = re.compile(r"(?<![\w.\"'`/-])(?:\(null\)|null|NULL|undefined|NaN|None|nil|#N/A|#REF!|#VALUE!|#NAME\?|#DIV/#!|N/A)(?![\w\"'`])")
_NOT_MISSING = re.compile(
    r"^\s*(?:of\b|behaviou?rs?\b|pointers?\b|hypothes[ei]s\b|references?\b|values?\b|checks?\b|bytes?\b|characters?\b|exceptions?\b|entries\b|marks?\b|cells?\b|fields?\b|variables?\b|errors?\b|\(reading|and\s+(?:#REF|NaN|null|undefined))"
)
_ABOUT_BEFORE = re.compile(r"(?i)(?:\b(?:full of|no|word|says?|shows?|like|such as|called|properties of|and|or|than|every|any|each|handles?|catch(?:es)?|flags?|rejects?|of type)\s*)$")
#: Words of sentences about a program's values. A mark needs more: see ``_speaks_of``.
ABOUT = re.compile(
    r"(?i)\b(?:templates?|merge fields?|mail merge|placeholders?|marks?|markers?|tokens|variables|syntax|macros?|brackets?|braces|subject lines?|labels?|each field|fields? (?:like|such as|named|called)|types?|typed|typing|fills?|"
    r"parsers?|renders?|substitutes?|escapes?|snippets?|spreadsheets?|formulas?|compilers?|firmware|campos?|etiquetas?|plantillas?|marcador(?:es)?|se completan?|rellena[n]?|felder|feld|füllt|füllen|platzhalter|vorlagen?|serienbriefe?|etiketten?|"
    r"champs?|étiquettes?|modèles?|gabarits?|remplit|remplissent|balises?|variables)\b"
)

#: Words for marks and for nothing that a company sells.
MARK_WORD = re.compile(r"(?i)\b(?:merge fields?|mail merge|placeholders?|each field|fields? (?:like|such as|named|called)|marcador(?:es)?|platzhalter|serienbriefe?|gabarits?|balises?)\b")
_HOLDER = r"(?:templates?|marks?|markers?|tokens?|variables?|macros?|brackets?|braces|fields?|snippets?|syntax|campos?|plantillas?|felder|feld|vorlagen?|champs?|modèles?)"
#: What makes a mark the thing spoken of: what holds it or is done with it just before, or its name just after.
_BEFORE_MARK = re.compile(r"(?i)\b(?:" + _HOLDER + r"(?:\s+(?:uses?|like|such as|named|called|contains?|holds?|wie|como|comme))?|types?|typed|typing|fills?|fill in|renders?|substitutes?|replaces?|escapes?|parses?|füllt|füllen|rellenan?|remplit|remplissent)\s+(?:(?:the|a|an|el|la|le|den|die|das)\s+)?[`\"'“‘]?$")
_AFTER_MARK = re.compile(r"(?i)^[`\"'”’]?\s+(?:" + _HOLDER + r"|se completan?)\b")

# --- units by their form

_REF = re.compile(r"(?i)^(?:request id|ref(?:erence)?|id|incident|trace|code|error code|ray id)?[ :#.\-]*[0-9a-f#\-]{3,}\.?$")
_FOOT = re.compile(r"(?i)^(?:©|\(c\)|copyright)[\s#\d\-–.]*[\w .,&\-]{0,40}$")
_STACK = re.compile(r'^(?:at [\w.$<>]+ \(|File "[^"]+", line)')
_JSON = re.compile(r'^\{\s*"(?:error|errors|message|status|code|detail)"\s*:')
_BAR = re.compile(r"\s+[|·»>•/–-]\s+")
WORD = re.compile(r"[^\W\d_]+")
_SPECIAL = re.compile(r"[{<\[|@~«(]|__|##|XX|%[A-Za-z_(]|\$[A-Za-z_]")
_VALUE = re.compile(r"null|NULL|undefined|NaN|None|nil|N/A|#REF|#VALUE|#NAME|#DIV")


def slots(unit: str) -> bool:
    """Is there an unfilled slot, or a word for no value, that the unit is not about?"""
    special = _SPECIAL.search(unit) is not None
    found = list(SLOT.finditer(unit)) if special else []
    for m in BRACKET.finditer(unit) if special else ():
        square, angle, quoted, round_ = m.groups()
        inside = (square or angle or quoted or round_ or "").strip()
        low = inside.lower()
        words = low.replace("_", " ").split()
        if not words:
            continue
        if round_ is not None:
            hit = bool(re.search(r"(?i)\b(?:goes|name|text) here$", inside))
        elif HERE.match(inside) and (square is not None or len(words) <= 7 or (angle is not None and "=" not in inside)):
            hit = True
        elif quoted is not None:
            hit = bool(re.fullmatch(r"[A-Za-z_][\w. ]*", inside)) and (low.replace(" ", "_") in FIELDS or "_" in inside or "." in inside[:-1] or (inside.isupper() and len(inside) > 2))
        elif angle is not None:
            hit = bool(re.fullmatch(r"[A-Za-z_][\w. ]*", inside)) and words[0] not in HTML and (low.replace(" ", "_") in FIELDS or "_" in inside or inside.isupper())
        else:
            titled = re.fullmatch(r"[A-ZÀ-Þ][\w.\-]*(?: [A-ZÀ-Þ0-9][\w.\-]*){0,3}", inside) is not None
            hit = (titled and not set(words) <= LINKS) or low.replace(" ", "_") in FIELDS or re.fullmatch(r"[a-z]+(?:[._][a-z]+)+", inside) is not None
        if hit:
            found.append(m)
    if found and not _speaks_of(unit, found) and not all(_quoted(unit, m) for m in found):
        return True
    for m in NO_VALUE.finditer(unit) if _VALUE.search(unit) else ():
        before, after = unit[: m.start()], unit[m.end() :]
        if _NOT_MISSING.match(after) or _ABOUT_BEFORE.search(before):
            continue
        if m.group() in ("None", "N/A") and not before.strip() and not re.match(r"\s*(?:is an?|was|has|earns|keeps|began)\b|[.]?$", after):
            continue
        if not ABOUT.search(before + after):
            return True
    return False


def _speaks_of(unit: str, found: list[re.Match]) -> bool:
    """Is the sentence about its marks? A word such as labels or types elsewhere in it doesn't make it so."""
    if MARK_WORD.search(_without(unit, found)):
        return True
    return any(_BEFORE_MARK.search(unit[max(0, m.start() - 60) : m.start()]) or _AFTER_MARK.match(unit[m.end() : m.end() + 60]) for m in found)


def _without(unit: str, found: list[re.Match]) -> str:
    out, at = [], 0
    for m in sorted(found, key=lambda m: m.start()):
        if m.start() >= at:
            out.append(unit[at : m.start()])
            at = m.end()
    return " ".join([*out, unit[at:]])


def _quoted(unit: str, m: re.Match) -> bool:
    return unit[m.start() - 1 : m.start()] in ("`", '"', "'", "“", "‘") and unit[m.end() : m.end() + 1] in ("`", '"', "'", "”", "’")


def unit_kind(unit: str, model: NoticeModel) -> tuple[str, float]:
    """(kind, probability of a notice) of a unit with masked numbers: slot, around, short or text, or ``doubt`` from ``DOUBT`` on, for its template to decide."""
    unit = unit.strip(" \t*#>-–|·•=_~`") or unit
    low = model.words(unit)
    if unit[:1] in '{aF' and (_JSON.match(unit) or _STACK.match(unit)):
        return "doubt", 1.0
    if len(unit) < 80 and (not WORD.search(unit) or _REF.match(unit) or _FOOT.match(unit)):
        return "around", 0.0
    shape = model.shape(low)
    notice = model.score(low, "notice", shape)
    if notice >= DOUBT and model.score(low, "fill", shape) >= FILL:
        return "slot", notice
    if len(low) < 9 and (around := model.score(low, "around", shape)) >= AROUND and around >= notice:
        return "around", notice
    if len(unit) < 200 and notice < DOUBT and (parts := _BAR.split(unit))[1:] and all(len(x.split()) <= 3 for x in parts):
        return "around", notice
    if notice >= DOUBT:
        return "doubt", notice
    words = WORD.findall(unit) if len(low) <= 8 else low
    if len(words) <= 4 and unit[-1:] not in ".!?:;," and all(w[:1].isupper() or len(w) <= 3 for w in words):
        return "around", notice
    return ("short" if len(words) <= 6 else "text"), notice


_DIGITS = re.compile(r"\d+")


def cut_units(text: str) -> list[str]:
    """The units of a text with masked numbers and single blanks."""
    return [x for u in UNIT_BREAK.split(text) if (x := " ".join(_DIGITS.sub("#", u).split()))]


def scan_text(text: str, model: NoticeModel, known: dict[str, tuple[str, float]]) -> tuple[int, int, int, list[tuple[str, float]]]:
    """(slots, shorts, texts, units in doubt with their probabilities) of one text."""
    marked = _SPECIAL.search(text) is not None or _VALUE.search(text) is not None
    slots_, shorts, texts, doubt = 0, 0, 0, []
    for u in cut_units(text):
        got = known.get(u)
        if got is None:
            kind, p = unit_kind(u, model)
            got = ("slot" if marked and slots(u) else kind, p)
            if len(known) < 200_000:
                known[u] = got
        kind, p = got
        slots_ += kind == "slot"
        shorts += kind == "short"
        texts += kind == "text"
        if kind == "doubt":
            doubt.append((u, p))
    return slots_, shorts, texts, doubt


SCANNED = "doc_id long, row long, slots int, shorts int, texts int, doubt array<struct<unit: string, p: double>>"


def corpus_model(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sample_docs: int = 600, sample_units: int = 10, rules: dict[str, list[str]] | None = None) -> NoticeModel:
    """The classifier: the labelled rules, and at most ``sample_units`` units of each of ``sample_docs`` documents as ordinary text (both by a hash)."""
    rows = docs.where(docs[text].isNotNull() & docs[doc_id].isNotNull())
    ids = rows.select(docs[doc_id].alias("i")).distinct().orderBy(F.xxhash64(F.lit(3), "i"), "i").limit(sample_docs)  # a bounded sample

    def some(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"units": [sorted(sorted({u[:400] for u in cut_units(t)}, key=lambda u: (hash_of(u), u))[:sample_units]) for t in b["text"]]})

    taken = rows.select(docs[doc_id].alias("i"), docs[text].alias("text")).join(F.broadcast(ids), "i", "left_semi").select("text")
    units = taken.mapInPandas(some, "units array<string>").distinct().limit(2 * sample_docs).collect()
    return fit(sorted(list(r["units"]) for r in units), rules)


def hash_of(text: str) -> int:
    return zlib.crc32(text.encode("utf-8", "surrogatepass"))


def _scan(docs: DataFrame, doc_id: str, text: str, model: NoticeModel) -> DataFrame:
    """Documents with a slot or a unit in doubt, one row each."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the labelled sample

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, tuple[str, float]] = {}
        for b in batches:
            out = []
            for i, row, t in zip(b["doc_id"].tolist(), b["row"].tolist(), b["text"], strict=True):
                slots_, shorts, texts, doubt = scan_text(t, shared.value, known)
                if slots_ or doubt:
                    out.append((i, row, slots_, shorts, texts, [{"unit": u, "p": p} for u, p in doubt]))
            yield pd.DataFrame(out, columns=["doc_id", "row", "slots", "shorts", "texts", "doubt"])

    rows = docs.where(docs[text].isNotNull() & docs[doc_id].isNotNull()).select(docs[doc_id].cast("long").alias("doc_id"), F.xxhash64(docs[text]).alias("row"), docs[text].alias("text"))
    return materialize(rows.mapInPandas(run, SCANNED).dropDuplicates(["doc_id", "row"]), "scanned")


def mine(units: DataFrame, share: float = 0.1) -> DataFrame:
    """unit, template of distinct units (unit), by the prefix tree: number of tokens, first two tokens, then the tokens that are constant at their place in the leaf."""
    tok = units.select("unit", F.split("unit", " ").alias("t")).withColumn("leaf", F.xxhash64(F.size("t"), F.slice("t", 1, 2)))
    size = tok.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"))
    place = tok.where(F.size("t") > 2).select("unit", "leaf", F.posexplode("t").alias("pos", "tok"))
    often = place.groupBy("leaf", "pos", "tok").agg(F.count(F.lit(1)).alias("k"))
    rare = salted_join(often, size, ["leaf"], "inner").where((F.col("k") < share * F.col("n")) & (F.col("pos") > 1)).select("leaf", "pos", "tok")
    wild = salted_join(place, rare, ["leaf", "pos", "tok"], "left_semi").groupBy("unit").agg(F.collect_set("pos").alias("w"))
    word = lambda x, i: F.when(F.array_contains("w", i), "<*>").otherwise(x)
    return tok.join(wild, "unit", "left").select("unit", F.when(F.col("w").isNull(), F.col("unit")).otherwise(F.array_join(F.transform("t", word), " ")).alias("template"))


def mine_templates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", model: NoticeModel | None = None, scanned: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(templates: template, units, docs, alone, p, verdict; units: unit, p, template, verdict), written. ``alone``: documents without any text beside the message."""
    scanned = _scan(docs, doc_id, text, model or corpus_model(docs, doc_id, text)) if scanned is None else scanned
    each = scanned.select("doc_id", "texts", F.explode("doubt").alias("d")).select("doc_id", "texts", "d.unit", "d.p")
    units = materialize(each.groupBy("unit").agg(F.max("p").alias("p"), F.count_distinct("doc_id").alias("docs"), F.count_distinct(F.when(F.col("texts") == 0, F.col("doc_id"))).alias("alone")), "units")
    told = units.join(mine(units), "unit")
    told = materialize(told, "mined")
    per = told.groupBy("template").agg(F.count(F.lit(1)).alias("units"), F.sum("docs").alias("docs"), F.sum("alone").alias("alone"), (F.sum(F.col("p") * F.col("docs")) / F.sum("docs")).alias("p"))
    p = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), F.col("p")))
    support = F.greatest(F.lit(-MOST), F.least(F.lit(MOST), ALONE * F.col("alone") + BESIDE * (F.col("docs") - F.col("alone"))))
    verdict = F.when((F.col("p") >= SURE) | (F.log(p / (1 - p)) + support >= 0), "notice").otherwise("text")
    templates = materialize(per.withColumn("verdict", verdict), "templates")
    back = salted_join(told.select("unit", "p", "template"), templates.select("template", "verdict"), ["template"], "inner")
    back = materialize(back.withColumn("verdict", F.when(F.col("p") >= SURE, "notice").otherwise(F.col("verdict"))), "told")
    release(units, told)
    return templates, back


def residue_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", model: NoticeModel | None = None, broadcast_units: int = 200_000) -> DataFrame:
    """doc_id, slots, notices, shorts, texts: unit counts of every row with a slot or a unit that may be a notice; see ``is_residue``."""
    scanned = _scan(docs, doc_id, text, model or corpus_model(docs, doc_id, text))
    templates, units = mine_templates(docs, doc_id, text, scanned=scanned)
    each = scanned.select("doc_id", "row", F.explode("doubt.unit").alias("unit"))
    notices = units.where("verdict = 'notice'").select("unit", F.lit(1).alias("hit"))
    joined = each.join(F.broadcast(notices), "unit", "left") if rows_of(units) <= broadcast_units else salted_join(each, notices, ["unit"], "left")
    told = joined.groupBy("doc_id", "row").agg(F.count("hit").alias("notices"), F.count_if(F.col("hit").isNull()).alias("cleared"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    out = scanned.join(told, ["doc_id", "row"], "left").select("doc_id", "slots", zero(F.col("notices")).alias("notices"), "shorts", (F.col("texts") + zero(F.col("cleared"))).alias("texts"))
    out = materialize(out, "residue")
    release(scanned, templates, units)
    return out


def is_residue() -> Column:
    few = F.col("shorts") <= F.when(F.col("notices") >= 2, 1).otherwise(0)
    return (F.col("slots") > 0) | ((F.col("notices") > 0) & (F.col("texts") == 0) & few)
