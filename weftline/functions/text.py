"""Text functions as native Column expressions (no Python in the data path)."""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that a normalised name drops, and acronyms a display name keeps.
NAME_STOP_WORDS = ("the", "a", "an", "of", "for")
ACRONYMS = {
    "ai": "AI", "api": "API", "apis": "APIs", "saas": "SaaS", "paas": "PaaS", "iaas": "IaaS", "iot": "IoT", "ml": "ML", "llm": "LLM", "llms": "LLMs",
    "nlp": "NLP", "ocr": "OCR", "crm": "CRM", "erp": "ERP", "hr": "HR", "seo": "SEO", "sdk": "SDK", "ui": "UI", "ux": "UX", "kyc": "KYC", "aml": "AML",
    "ehr": "EHR", "emr": "EMR", "ev": "EV", "evs": "EVs", "gpu": "GPU", "cpu": "CPU", "sql": "SQL", "pos": "POS", "ci": "CI", "cd": "CD",
    "devops": "DevOps", "fintech": "Fintech", "3d": "3D",
}


@cache
def _folds() -> tuple[str, str, tuple[tuple[str, str], ...]]:
    """Characters whose compatibility decomposition has ASCII letters: one-to-one, and longer ones."""
    one, to, more = [], [], []
    for code in range(0x80, 0x10000):
        ch = chr(code)
        low = unicodedata.normalize("NFKD", ch).encode("ascii", "ignore").decode()
        if len(low) == 1:
            one.append(ch)
            to.append(low)
        elif low and code < 0x2190 or 0xFB00 <= code <= 0xFB06:
            more.append((ch, low))
    return "".join(one), "".join(to), tuple(more)


def fold_ascii(c: Column) -> Column:
    """Accents off, other non-ASCII characters dropped."""
    one, to, more = _folds()
    c = F.translate(c, one, to)
    common = [m for m in more if m[0] in "ĲĳǄǅǆǇǈǉǊǋǌǱǲǳﬀﬁﬂﬃﬄﬅﬆ…™℡№¼½¾"]
    for a, b in common:
        c = F.replace(c, F.lit(a), F.lit(b))
    return F.regexp_replace(c, r"[^\x00-\x7F]", "")


def collapse(c: Column) -> Column:
    """Whitespace runs to one blank, trimmed."""
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def clean(c: Column) -> Column:
    """Collapsed text, or null when nothing is left."""
    return F.nullif(collapse(c.cast("string")), F.lit(""))


def slugify(c: Column, max_len: int = 64) -> Column:
    s = F.regexp_replace(F.lower(fold_ascii(c)), "[^a-z0-9]+", "-")
    s = F.regexp_replace(F.substring(F.regexp_replace(s, "^-+|-+$", ""), 1, max_len), "-+$", "")
    return F.when(s == "", "unnamed").otherwise(s)


def normalize_name(c: Column) -> Column:
    """One key for spelling variants: folded, & as and, plurals cut, stop words dropped."""
    s = F.regexp_replace(F.lower(fold_ascii(F.replace(c, F.lit("&"), F.lit(" and ")))), "[^a-z0-9]+", " ")
    words = F.filter(F.split(F.trim(s), " "), lambda w: w != "")
    words = F.transform(words, lambda w: F.when((F.length(w) > 3) & w.endswith("s") & ~w.endswith("ss"), w.substr(F.lit(1), F.length(w) - 1)).otherwise(w))
    return F.array_join(F.filter(words, lambda w: ~w.isin(*NAME_STOP_WORDS)), " ")


def truncate(c: Column, n: int) -> Column:
    t = collapse(c)
    return F.when(F.length(t) > n, F.concat(F.rtrim(F.substring(t, 1, n - 1)), F.lit("…"))).otherwise(t)


def string_list(c: Column) -> Column:
    """Cleaned, distinct, in order; null becomes empty."""
    return F.coalesce(F.array_distinct(F.filter(F.transform(c, clean), lambda x: x.isNotNull())), F.array().cast("array<string>"))


def non_negative_int(c: Column) -> Column:
    n = c.try_cast("int")
    return F.when(n >= 0, n)


def batch_season(c: Column) -> Column:
    m = F.initcap(F.regexp_extract(F.trim(c), r"(?i)^(winter|summer|spring|fall)\s*(?:\d{4})?$", 1))
    return F.when(m.isNull() | (m == ""), "Unspecified").otherwise(m)


def batch_year(c: Column) -> Column:
    return F.nullif(F.regexp_extract(F.trim(c), r"(?i)^(?:winter|summer|spring|fall|ik12|unspecified)\s*(\d{4})$", 1), F.lit("")).cast("int")


def batch_slug(c: Column) -> Column:
    return F.when(F.coalesce(c, F.lit("")) != "", slugify(c))


def display_name(c: Column) -> Column:
    """Separators to blanks; acronyms kept or restored; other words start upper case."""
    words = F.filter(F.split(collapse(F.translate(c, "_-", "  ")), " "), lambda w: w != "")
    known = F.create_map(*(F.lit(x) for kv in ACRONYMS.items() for x in kv))

    def one(w: Column) -> Column:
        low = F.lower(w)
        uppers = F.length(F.regexp_replace(w, r"[^\p{Lu}]", ""))
        shouted = (w == F.upper(w)) & (uppers > 0)
        return (
            F.when(shouted | ((F.length(w) <= 4) & (uppers >= 2)), w)
            .when(F.coalesce(F.try_element_at(known, low), F.lit("")) != "", F.try_element_at(known, low))
            .when(low.rlike("^[a-z][0-9][a-z]$"), F.upper(w))
            .otherwise(F.concat(F.upper(F.substring(w, 1, 1)), w.substr(F.lit(2), F.length(w))))
        )

    return F.array_join(F.transform(words, one), " ")


def closest_facet(c: Column, facets: list[str]) -> Column:
    """Exact or prefix match either way, else the facet sharing most words, else null."""
    c = F.regexp_replace(F.lower(F.trim(c)), "[^a-z0-9]+", "_")
    fs = F.array(*map(F.lit, facets))
    direct = F.try_element_at(F.filter(fs, lambda f: (f == c) | c.startswith(f) | f.startswith(c)), F.lit(1))
    words = F.split(c, "_")
    scored = F.transform(fs, lambda f, i: F.struct(F.size(F.array_intersect(words, F.split(f, "_"))).alias("n"), (-i).alias("i"), f.alias("f")))
    best = F.array_max(scored)
    return F.when(c != "", F.coalesce(direct, F.when(best["n"] > 0, best["f"])))


def tag_document(name: Column, facet: Column, definition: Column) -> Column:
    return F.concat(name, F.lit(" ("), F.replace(facet, F.lit("_"), F.lit(" ")), F.lit("): "), definition)


def unfenced(c: Column, label: str) -> Column:
    """A text without fence marks, whitespace collapsed."""
    return collapse(F.regexp_replace(c, rf"(?i)</?\s*{label}[^>]*>", " "))


def wrap_untrusted(c: Column, label: str, limit: int) -> Column:
    """Fence a text for a prompt: fence marks inside removed, whitespace collapsed, cut at the limit."""
    return F.concat(F.lit(f"<{label}>\n"), F.substring(unfenced(c, label), 1, limit), F.lit(f"\n</{label}>"))


def parse_iso(c: Column) -> Column:
    """A timestamp of an ISO text, null if it is none."""
    return c.try_cast("timestamp_ntz")


def evidence_source(document_id: Column, labels: dict[str, str]) -> Column:
    kind = F.split_part(document_id, F.lit("#"), F.lit(2))
    return F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in labels.items() for x in kv)), kind), kind)
