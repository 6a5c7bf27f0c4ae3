"""Mixing sources to target weights by iterative proportional fitting.

Tokens of a public tokenizer are counted in one map-only pass (no text is shuffled). Copies of a
text count once, under the source of its smallest document id, so no text exceeds its repeats by
having copies. Token totals per cell (source, language, topic) are collected - a table of
categories, refused above ``MAX_CELLS`` - and raked to the source, language and topic marginals in
turn, weights never above the source's repeats. The documents are then drawn systematically by
these calibrated probabilities: in the order of cell, size and hash of the text, each is drawn as
often as the sum of the weights passes a whole number on it. So every cell, and every size within
it, gives what it should but for one document. The sum is kept in integers over a range-partitioned
sort, with one number a partition to carry over: the same on every run, and no group is gathered.

A source is exhausted if its weight stands at its cap in all its cells and its target isn't reached. The
total stays that of the documents unless given, so what exhausted or absent sources leave open is
missing from it: the others keep their wanted sizes, and their shares of what is drawn rise. Give
``total`` (:func:`feasible_total` is the largest at which no source falls short) to avoid that.

Defined cases: null and blank texts have no tokens and are never drawn; documents of sources
without a target are not drawn, and targets without documents reach nothing, both reported; null
languages and topics are categories of their own; a source too small for its target even at its
most repeats is used that often and reported with the share it reached; empty tables give no rows.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.runtime import materialize

#: Cells are combinations of categories; more than this is refused.
MAX_CELLS = 200_000
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
COUNTED = "doc_id long, digest string, source string, lang string, topic string, tokens long"


def _counter(tokenizer: str):
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(tokenizer)
        t.encode_special_tokens = True
        for b in batches:
            texts = b.pop("text")
            kinds = {x: 0 for x in texts}
            todo = [x for x in kinds if x.strip()]
            for i in range(0, len(todo), 256):
                part = todo[i : i + 256]
                kinds.update(zip(part, (len(e.ids) for e in t.encode_batch(part, add_special_tokens=False)), strict=True))
            b["tokens"] = [kinds[x] for x in texts]
            yield b

    return count


def count_tokens(docs: DataFrame, topic: str, tokenizer: str = TOKENIZER) -> DataFrame:
    """One row per document with a text: doc_id, digest, source, lang, topic, tokens."""
    lang = F.coalesce(F.lower(F.trim("lang")), F.lit("und"))
    base = docs.where("text IS NOT NULL").select("doc_id", F.sha2("text", 256).alias("digest"), "source", lang.alias("lang"), F.coalesce(F.col(topic), F.lit("none")).alias("topic"), "text")
    return base.mapInPandas(_counter(tokenizer), COUNTED)


def distinct_texts(counted: DataFrame) -> DataFrame:
    """The first document of every text with tokens."""
    rest = [c for c in counted.columns if c != "digest"]
    first = counted.where("tokens > 0").groupBy("digest").agg(F.min(F.struct(*rest)).alias("s"))
    return first.select("digest", "s.*")


def rake(cells: pd.DataFrame, targets: dict[str, float], repeats: dict[str, int], total: float | None = None, margins: dict[str, dict[str, float]] | None = None, rounds: int = 200) -> pd.DataFrame:
    """Weights per cell. ``cells``: source, lang, topic, tokens; ``targets``: shares of the total.

    ``margins`` gives target shares for lang and topic; by default those of the cells themselves.
    """
    out = cells.copy()
    have = out["tokens"].to_numpy(float)
    total = float(have.sum()) if total is None else float(total)
    share = out["source"].map(targets).fillna(0).to_numpy(float)
    cap = out["source"].map(repeats).fillna(0).to_numpy(float)
    w = np.where(share > 0, 1.0, 0.0)
    wanted: list[tuple[np.ndarray, dict[str, float]]] = []
    for name in ("lang", "topic", "source"):  # the sources last, they have to hold
        codes, kinds = pd.factorize(out[name])
        own = np.bincount(codes, have * (w > 0), len(kinds))
        given = (margins or {}).get(name)
        if name == "source":
            goal = np.array([targets.get(k, 0) * total for k in kinds])
        elif given:
            goal = np.array([given.get(k, 0) * total for k in kinds])
        else:
            goal = own / max(own.sum(), 1) * total
        wanted.append((codes, goal))
    for _ in range(rounds):
        before = w.copy()
        for codes, goal in wanted:
            for _ in range(20):  # a category whose cells are partly capped is filled up from the others
                now = np.bincount(codes, have * w, len(goal))
                factor = np.divide(goal, now, out=np.zeros_like(goal), where=now > 0)
                new = np.minimum(w * factor[codes], cap)
                done = np.allclose(new, w, rtol=1e-9)
                w = new
                if done:
                    break
        if np.allclose(before, w, rtol=1e-7, atol=1e-12):
            break
    out["weight"] = w
    out.attrs["total"] = total
    return out


def feasible_total(cells: pd.DataFrame, targets: dict[str, float], repeats: dict[str, int]) -> float:
    """The largest total at which every source with a target that has any tokens can give its share."""
    have = cells.groupby("source")["tokens"].sum()
    return min((float(have[s]) * repeats[s] / share for s, share in targets.items() if share > 0 and have.get(s, 0) > 0), default=0.0)


#: Parts of one draw: weights are integers of these parts, so their sums are exact in any order.
PARTS = 1 << 30


def mix_plan(texts: DataFrame, targets: DataFrame, total: float | None = None, margins: dict[str, dict[str, float]] | None = None) -> pd.DataFrame:
    """Per cell (source, lang, topic): tokens, weight, cap; at most ``MAX_CELLS`` rows."""
    names = targets.limit(MAX_CELLS + 1).collect()
    table = texts.groupBy("source", "lang", "topic").agg(F.sum("tokens").alias("tokens")).limit(MAX_CELLS + 1).collect()
    if max(len(table), len(names)) > MAX_CELLS:
        raise ValueError(f"over {MAX_CELLS} cells of source, language and topic")
    cells = pd.DataFrame([r.asDict() for r in table], columns=["source", "lang", "topic", "tokens"])
    repeats = {r["source"]: r["max_repeats"] for r in names}
    out = rake(cells[cells["source"].isin(repeats)], {r["source"]: r["target_share"] for r in names}, repeats, total, margins)
    out["cap"] = out["source"].map(repeats)
    return out


def mix_sources(texts: DataFrame, plan: pd.DataFrame, seed: int = 29) -> DataFrame:
    """doc_id, source, lang, topic, tokens, repeats for the drawn documents.

    ``texts``: of :func:`distinct_texts`; ``plan``: of :func:`mix_plan`.
    """
    spark = texts.sparkSession
    rows = [(r.source, r.lang, r.topic, int(round(r.weight * PARTS))) for r in plan.itertuples()]
    weights = F.broadcast(spark.createDataFrame(rows, "source string, lang string, topic string, w long"))  # one row a cell
    drawn = texts.join(weights, ["source", "lang", "topic"]).where("w > 0").select("doc_id", "source", "lang", "topic", "tokens", "w", F.xxhash64(F.lit(seed), "digest").alias("h"), "digest")
    placed = materialize(drawn.orderBy("source", "lang", "topic", "tokens", "h", "digest").withColumn("at", F.monotonically_increasing_id()), "placed")
    part = F.shiftright("at", 33)
    sums = placed.groupBy(part.alias("p")).agg(F.pmod(F.sum(F.col("w").cast("decimal(38,0)")), F.lit(PARTS)).cast("long").alias("s"))  # one row a task
    before = F.coalesce(F.sum("s").over(Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    start = F.broadcast(sums.select("p", F.pmod(before + F.lit(PARTS // 2), F.lit(PARTS)).alias("start")))
    upto = F.col("start") + F.sum("w").over(Window.partitionBy("p").orderBy("at").rowsBetween(Window.unboundedPreceding, 0))
    out = placed.withColumn("p", part).join(start, "p").withColumn("upto", upto)
    repeats = (F.shiftright("upto", 30) - F.shiftright(F.col("upto") - F.col("w"), 30)).cast("int")
    return out.withColumn("repeats", repeats).where("repeats > 0").select("doc_id", "source", "lang", "topic", "tokens", "repeats")


def mix_report(texts: DataFrame, mixed: DataFrame, targets: DataFrame, plan: pd.DataFrame) -> DataFrame:
    """Per marginal (source, lang, topic) and value: wanted share, raked and drawn tokens and shares, tokens there, most repeats used and allowed, and whether a source is exhausted."""
    spark = texts.sparkSession
    total = max(1.0, float((plan["tokens"] * plan["weight"]).sum()))
    drawn = F.lit(float(mixed.agg(F.sum(F.col("tokens") * F.col("repeats"))).first()[0] or 1))
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    goal = F.lit(float(plan.attrs.get("total", plan["tokens"].sum())))
    out = None
    for name in ("source", "lang", "topic"):
        rows = []
        for value, g in plan.groupby(name):
            full = bool((g["weight"] >= g["cap"] - 1e-9).all())
            rows.append((value, float((g["tokens"] * g["weight"]).sum()), full if name == "source" else None))
        raked = spark.createDataFrame(rows, "value string, raked_tokens double, full boolean")  # one row a category
        per = texts.groupBy(F.col(name).alias("value")).agg(F.sum("tokens").alias("tokens_available"))
        used = mixed.groupBy(F.col(name).alias("value")).agg(F.sum(F.col("tokens") * F.col("repeats")).alias("tokens_drawn"), F.max("repeats").alias("repeats_used"))
        one = per.join(used, "value", "full").join(raked, "value", "full")
        wanted = targets.select(F.col("source").alias("value"), "target_share", "max_repeats") if name == "source" else targets.limit(0).select(F.col("source").alias("value"), "target_share", "max_repeats")
        one = one.join(wanted, "value", "full")
        one = one.select(
            F.lit(name).alias("marginal"), "value", "target_share" if name == "source" else F.lit(None).cast("double").alias("target_share"), F.round(z("raked_tokens") / F.lit(total), 6).alias("raked_share"),
            F.round(z("tokens_drawn") / drawn, 6).alias("share"), z("tokens_available").alias("tokens_available"), F.round(z("raked_tokens"), 3).alias("raked_tokens"), z("tokens_drawn").alias("tokens_drawn"),
            F.round(z("tokens_drawn") - z("raked_tokens"), 3).alias("residual"), z("repeats_used").alias("repeats_used"), "max_repeats",
            F.when(F.lit(name == "source") & (F.col("target_share") > 0), F.coalesce("full", F.lit(True)) & (z("raked_tokens") < F.col("target_share") * goal - 0.5)).alias("exhausted"),
        )
        out = one if out is None else out.unionByName(one)
    return out

