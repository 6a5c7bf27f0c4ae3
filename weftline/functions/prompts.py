"""Prompts as expressions over request rows; untrusted text is fenced."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions.text import collapse, tag_document, truncate, unfenced

#: What each stage asks; part of every request's key through ``prompt_hashes``.
INSTRUCTIONS = {
    "discovery": "Propose attributes that several of these records share. Answer with a JSON list of name, facet, definition and supporting ids.",
    "merge": "Do these two labels mean the same? Answer with JSON: verdict (merge, distinct or unclear) and rationale.",
    "assign": "For each label decide yes, no or uncertain from the documents alone, quoting them. Answer with a JSON list of tag_id, decision, confidence and evidence.",
}


def prompt_hashes() -> dict[str, str]:
    return {k: hashlib.sha256(v.encode()).hexdigest()[:16] for k, v in INSTRUCTIONS.items()}


def company_text(limit: int = 900) -> Column:
    """A record for discovery: its text, industry and first six source tags."""
    extra = F.concat_ws("; ", "industry", F.concat(F.lit("tags: "), F.array_join(F.slice("source_tags", 1, 6), ", ")))
    return truncate(F.concat_ws(" | ", collapse(F.concat_ws(" ", "name", "one_liner", "long_description")), extra), limit)


def discovery_prompts(batches: DataFrame) -> DataFrame:
    """batch, prompt: one request per batch (batch, company_id and the columns of ``company_text``); batches are of bounded size."""
    line = F.concat(F.lit("- "), F.col("company_id"), F.lit(": "), unfenced(company_text(), "records"))  # cut by record, so none is lost
    rows = batches.select("batch", F.struct("company_id", line.alias("line")).alias("r"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list("r")), lambda r: r["line"]), "\n")
    return rows.groupBy("batch").agg(body.alias("body")).select("batch", F.concat(F.lit(INSTRUCTIONS["discovery"] + "\n<records>\n"), "body", F.lit("\n</records>")).alias("prompt"))


def merge_prompt(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """Two labels (name, facet, definition) to compare."""
    one, two = (tag_document(x["name"], x["facet"], x["definition"]) for x in (a, b))
    return F.concat(F.lit(INSTRUCTIONS["merge"] + "\nA: "), collapse(one), F.lit("\nB: "), collapse(two))


def call_groups(pairs: DataFrame, most: int = 8) -> DataFrame:
    """Adds ``call``: labels of an entity packed into calls of at most ``most``, facets together (entity, facet, tag_id)."""
    w = Window.partitionBy("entity").orderBy("facet", "tag_id")
    return pairs.withColumn("call", F.floor((F.row_number().over(w) - 1) / most).cast("int"))


def assign_prompts(calls: DataFrame, documents: DataFrame) -> DataFrame:
    """entity, call, prompt: labels of a call (tag_id, text) and the entity's documents (entity, text), each of those cut at 8,000 characters."""
    documents = documents.where("text IS NOT NULL").groupBy("entity").agg(F.array_join(F.array_sort(F.collect_list(F.substring(unfenced(F.col("text"), "documents"), 1, 8_000))), "\n").alias("text"))
    labels = calls.groupBy("entity", "call").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("tag_id", "text"))), lambda t: F.concat(F.lit("- "), t["tag_id"], F.lit(": "), t["text"])), "\n").alias("labels"))
    return labels.join(documents, "entity").select("entity", "call", F.concat(F.lit(INSTRUCTIONS["assign"] + "\n"), "labels", F.lit("\n<documents>\n"), "text", F.lit("\n</documents>")).alias("prompt"))
