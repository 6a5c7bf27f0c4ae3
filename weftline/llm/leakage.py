"""Evaluation texts leaking into training text, by q-gram lemma filtering.

Texts are made canonical (lower-cased runs of letters and digits, one blank between and around
them). The test items are indexed by their character q-grams; every document is read once, its
q-grams looked up, and the hits counted per item in overlapping bands of diagonals. A passage of
``words`` words within ``edits`` edits of a document shares at least ``length - q + 1 - q * edits``
q-grams with it on diagonals at most ``edits`` apart (the q-gram lemma), so passages below that are
dropped without loss (of all passages of an item the lowest such bound holds for the item), and
those that remain are verified by an alignment within the band, all passages of a chunk at once.
The alignment decides: its distance is the number of edits, and 0 is a passage word for word.

One scan of the corpus serves ``block_chars`` characters of items, so what is broadcast is bounded
however many items there are; a worker builds the index once and keeps it. Documents are never
shuffled. Long documents are cut into overlapping segments. Where q-grams are common to very many
items the hits of a chunk are taken in parts of at most ``MAX_HITS``: fewer documents at a time,
then fewer items; nothing is left out.

Defined cases: null texts and texts without letters or digits match nothing; an item with fewer
than ``words`` words is one passage; an item with a passage shorter than a q-gram is looked up
directly and exactly, at the starts of a document's words; items with equal canonical texts are searched once and found under all their
ids; rows with one document id are one document, and what they cover of an item is united.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = re.compile(r"[^\W_]+")
SCHEMA = "doc_id long, item_id long, edits int, cover array<int>, exact array<int>, item_words int"
_BASE = np.uint64(1099511628211)
#: Equal q-grams of documents and items that are held at once.
MAX_HITS = 4_000_000


def canonical(text: str | None) -> str:
    words = WORD.findall(text.lower()) if text else []
    return f" {' '.join(words)} " if words else ""


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _grams(codes: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of the q-gram at each position."""
    n = len(codes) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(q):
            h = h * _BASE + codes[j : j + n].astype(np.uint64)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0x9E3779B97F4A7C15)
    return h


class ItemIndex:
    """The q-grams of a block of items, ready for lookup."""

    def __init__(self, items: list[tuple[int, str]], q: int, edits: int, words: int):
        self.q, self.edits, self.words = q, edits, words
        self.texts, self.windows, self.least, self.n_words = [], [], [], []
        self.tiny: dict[str, list[tuple]] = {}  # passages of items with one shorter than a q-gram: ids, place, words, words of the item
        self.longest = 1
        self.ids: list[list[int]] = []
        by_text: dict[str, set[int]] = {}
        for item_id, text in items:
            by_text.setdefault(canonical(text), set()).add(item_id)
        grams, owner, place = [], [], []
        for c, ids in by_text.items():
            if not c:
                continue
            ends = [i for i, ch in enumerate(c) if ch == " "]  # blanks around the words
            k = min(words, len(ends) - 1)
            windows = [(ends[i], ends[i + k] + 1) for i in range(len(ends) - k)]
            self.longest = max(self.longest, len(c))
            if min(b - a for a, b in windows) < q:
                for w, (a, b) in enumerate(windows):
                    self.tiny.setdefault(c[a:b], []).append((sorted(ids), w, k, len(ends) - 1))
                continue
            at = len(self.ids)
            self.ids.append(sorted(ids))
            self.texts.append(c)
            self.n_words.append(len(ends) - 1)
            w = np.array(windows, np.int64)
            self.windows.append(w)
            self.least.append(int(self.bound(w[:, 1] - w[:, 0]).min()))
            h = _grams(_codes(c), q)
            grams.append(h)
            owner.append(np.full(len(h), at, np.int32))
            place.append(np.arange(len(h), dtype=np.int32))
        h = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        order = np.argsort(h, kind="stable")
        self.owner = np.concatenate(owner)[order] if grams else np.zeros(0, np.int32)
        self.place = np.concatenate(place)[order] if grams else np.zeros(0, np.int32)
        self.keys, self.first, self.count = np.unique(h[order], return_index=True, return_counts=True)
        self.marks = np.zeros(1 << 20, bool)
        self.marks[(self.keys >> np.uint64(44)).astype(np.int64)] = True
        self.least = np.array(self.least, np.int64)
        self.codes = [_codes(t) for t in self.texts]
        self.lengths = sorted({len(t) for t in self.tiny})

    def budget(self, length: np.ndarray) -> np.ndarray:
        """Edits allowed in passages of some lengths, few enough for the lemma to keep at least one q-gram."""
        return np.clip((length - self.q) // self.q, 0, self.edits)

    def bound(self, length: np.ndarray) -> np.ndarray:
        """Shared q-grams that a passage within its budget has at least. It falls where the budget steps up."""
        return np.maximum(1, length - self.q + 1 - self.q * self.budget(length))

    def lookup(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``codes`` whose q-gram some item has, and its number among the keys."""
        h = _grams(codes, self.q)
        at = np.nonzero(self.marks[(h >> np.uint64(44)).astype(np.int64)])[0] if len(h) else np.zeros(0, np.int64)
        k = np.searchsorted(self.keys, h[at])
        k[k == len(self.keys)] = 0
        same = self.keys[k] == h[at] if len(self.keys) else np.zeros(0, bool)
        return at[same], k[same]

    def expand(self, at: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Positions, items and positions in them, of all equal q-grams."""
        n = self.count[k]
        total = int(n.sum())
        start = np.repeat(self.first[k] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) if total else np.zeros(0, np.int64)
        post = start + np.arange(total)
        return np.repeat(at, n), self.owner[post].astype(np.int64), self.place[post].astype(np.int64)


def banded_distances(parts: list[np.ndarray], text: np.ndarray, low: np.ndarray, high: np.ndarray, budget: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Edit distance of every part to the best stretch of ``text`` that starts between ``low`` and ``high``, within that band; above its budget means more.

    All alignments advance together, one character of the parts a step. No character is equal to one outside ``first``..``end`` (its document).
    """
    n, span = len(parts), int((high - low).max()) + 1 if len(parts) else 1
    length = np.array([len(p) for p in parts], np.int64)
    order = np.argsort(-length, kind="stable")  # the alignments still running are a prefix
    width = int(length.max()) if n else 0
    chars = np.zeros((n, width), np.uint32)
    for i, p in enumerate(order):
        chars[i, : length[p]] = parts[p]
    inside = np.arange(span)[None, :] <= (high - low)[order][:, None]
    low, budget, first, end = low[order], budget[order], first[order][:, None], end[order][:, None]
    big = (budget + 1).astype(np.int16)[:, None]
    row = np.where(inside, 0, big).astype(np.int16)
    out = np.zeros(n, np.int64)
    running = n
    for i in range(width):
        while running and length[order[running - 1]] <= i:
            running -= 1
            out[order[running]] = row[running].min()
        r = row[:running]
        at = low[:running, None] + (i + np.arange(span))[None, :]
        equal = (text[np.clip(at, 0, len(text) - 1)] == chars[:running, i][:, None]) & (at >= first[:running]) & (at < end[:running])
        new = r + ~equal
        new[:, :-1] = np.minimum(new[:, :-1], r[:, 1:] + 1)  # a character of the part is extra
        for j in range(1, span):  # a character of the text is extra
            np.minimum(new[:, j], new[:, j - 1] + 1, out=new[:, j])
        new = np.where(inside[:running], np.minimum(new, big[:running]), big[:running])
        row[:running] = new
    for i in range(running):
        out[order[i]] = row[i].min()
    return out


class _Found:
    """What is covered of an item by a document, as bits: within the edits, and word for word."""

    def __init__(self) -> None:
        self.by: dict[tuple[int, int], list] = {}

    def add(self, doc_id: int, ids: list[int], edits: int, first: int, k: int, words: int) -> None:
        bits = ((1 << k) - 1) << first
        for item_id in ids:
            old = self.by.setdefault((doc_id, item_id), [edits, 0, 0, words])
            old[0] = min(old[0], edits)
            old[1] |= bits
            if not edits:
                old[2] |= bits

    def rows(self) -> list[tuple]:
        places = lambda bits: [i for i in range(bits.bit_length()) if bits >> i & 1]
        return [(*key, edits, places(cover), places(exact), words) for key, (edits, cover, exact, words) in self.by.items()]


def find_leaks(docs: list[tuple[int, str]], ix: ItemIndex, chunk: int = 2_000_000, segment: int = 1_000_000) -> list[tuple]:
    """Rows (doc_id, item_id, edits, cover, exact, item_words) of a list of documents."""
    overlap = 2 * ix.longest
    pieces: list[tuple[int, str]] = []
    for doc_id, text in docs:
        c = canonical(text)
        if len(c) <= segment + overlap:
            pieces += [(doc_id, c)] if c else []
        else:
            pieces += [(doc_id, c[i : i + segment + overlap]) for i in range(0, len(c), segment)]
    found = _Found()
    at = 0
    while at < len(pieces):
        group, size = [], 0
        while at < len(pieces) and (not group or size + len(pieces[at][1]) <= chunk):
            group.append(pieces[at])
            size += len(pieces[at][1]) + 1
            at += 1
        _scan(group, ix, found)
        for doc_id, text in group if ix.tiny else ():
            for p in (i for i, ch in enumerate(text) if ch == " "):
                for n in ix.lengths:
                    for ids, w, k, n_words in ix.tiny.get(text[p : p + n], ()):
                        found.add(doc_id, ids, 0, w, k, n_words)
    return found.rows()


def _scan(group: list[tuple[int, str]], ix: ItemIndex, found: _Found) -> None:
    """Looks a chunk up once, and expands the hits in parts that fit."""
    if not ix.ids:
        return
    codes = _codes("\0".join(t for _, t in group))
    at, k = ix.lookup(codes)
    if not len(at):
        return
    starts = np.cumsum([0] + [len(t) + 1 for _, t in group])
    doc = np.searchsorted(starts, at, "right") - 1
    weight = np.cumsum(ix.count[k])
    a = 0
    while a < len(at):
        before = weight[a - 1] if a else 0
        b = int(np.searchsorted(weight, before + MAX_HITS, "right"))
        if b < len(at):  # whole documents only
            whole = int(np.searchsorted(doc, doc[b], "left"))
            b = whole if whole > a else int(np.searchsorted(doc, doc[b], "right"))
        parts = -(-int(weight[b - 1] - before) // MAX_HITS)
        for lo, hi in zip(edges := np.linspace(0, len(ix.ids), parts + 1).astype(int), edges[1:], strict=False):
            hits = ix.expand(at[a:b], k[a:b])
            if parts > 1:
                mine = (hits[1] >= lo) & (hits[1] < hi)
                hits = tuple(x[mine] for x in hits)
            _bands(group, codes, starts, ix, hits, found)
        a = b


def _bands(group: list[tuple[int, str]], codes: np.ndarray, starts: np.ndarray, ix: ItemIndex, hits: tuple, found: _Found) -> None:
    """Counts hits per document, item and band of diagonals, and verifies the passages that have enough."""
    pos, item, place = hits
    if not len(pos):
        return
    doc = np.searchsorted(starts, pos, "right") - 1
    key = doc * len(ix.ids) + item
    _, inverse, n = np.unique(key, return_inverse=True, return_counts=True)
    enough = n[inverse] >= ix.least[item]
    pos, item, place, doc, key = (x[enough] for x in (pos, item, place, doc, key))
    if not len(pos):
        return
    diag = pos - place  # in the chunk
    step = max(1, ix.edits)
    low = np.floor_divide(diag, step)
    # Bands of two steps, one step apart: diagonals at most `edits` apart share at least one band.
    key, band, diag, place, doc, item = (np.concatenate(x) for x in ((key, key), (low, low - 1), (diag, diag), (place, place), (doc, doc), (item, item)))
    order = np.lexsort((place, band, key))
    key, band, diag, place, doc, item = (x[order] for x in (key, band, diag, place, doc, item))
    edge = np.nonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (band[1:] != band[:-1])]))[0]
    last = np.concatenate([edge[1:], [len(key)]])
    todo: set[tuple[int, int, int, int, int]] = set()  # document, item, window, lowest and highest diagonal
    for a, b in zip(edge.tolist(), last.tolist(), strict=True):
        i = int(item[a])
        if b - a < ix.least[i]:
            continue
        windows = ix.windows[i]
        seen = np.zeros(len(ix.texts[i]) + 1, np.int64)
        seen[np.unique(place[a:b]) + 1] = 1
        upto = np.cumsum(seen)
        shared = upto[windows[:, 1] - ix.q + 1] - upto[windows[:, 0]]
        where = (int(diag[a:b].min()), int(diag[a:b].max()))
        kept = np.nonzero(shared >= ix.bound(windows[:, 1] - windows[:, 0]))[0]
        todo.update((int(doc[a]), i, w, *where) for w in kept.tolist())
    _verify(group, codes, starts, ix, sorted(todo), found)


def _verify(group: list[tuple[int, str]], codes: np.ndarray, starts: np.ndarray, ix: ItemIndex, jobs: list[tuple], found: _Found) -> None:
    """Aligns the passages and keeps those within their budgets."""
    for at in range(0, len(jobs), 20_000):
        part = jobs[at : at + 20_000]
        doc, item, window, lo, hi = np.array(part, np.int64).T
        spans = np.array([ix.windows[i][w] for _, i, w, _, _ in part], np.int64)
        budget = ix.budget(spans[:, 1] - spans[:, 0])
        pieces = [ix.codes[i][a:b] for i, (a, b) in zip(item.tolist(), spans.tolist(), strict=True)]
        edits = banded_distances(pieces, codes, spans[:, 0] + lo - budget, spans[:, 0] + hi + budget, budget, starts[doc], starts[doc + 1] - 1)
        for (d, i, w, _, _), e, most in zip(part, edits.tolist(), budget.tolist(), strict=True):
            if e <= most:
                found.add(group[d][0], ix.ids[i], e, w, min(ix.words, ix.n_words[i]), ix.n_words[i])


def _blocks(items: DataFrame, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    block, size = [], 0
    for item_id, text in items.toLocalIterator():
        if block and size + len(text) > block_chars:
            yield block
            block, size = [], 0
        block.append((item_id, text))
        size += len(text)
    if block:
        yield block


def leaked_passages(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text",
    words: int = 12, q: int = 10, edits: int = 2, block_chars: int = 16_000_000,
) -> DataFrame:
    """doc_id, item_id, edits, passage_words, exact_words, item_words for every document with a passage of an item.

    ``edits`` is the fewest edits of any verified passage of ``words`` words (0: word for word),
    ``passage_words`` how many of the item's words lie in verified passages, ``exact_words`` in passages word for word.
    """
    spark = docs.sparkSession
    corpus = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text")).where("text IS NOT NULL AND doc_id IS NOT NULL")
    wanted = items.select(items[item_id].cast("long").alias("item_id"), items[text].alias("text")).where("text IS NOT NULL AND item_id IS NOT NULL")
    found = None
    for block in _blocks(wanted.distinct(), block_chars):
        shared = spark.sparkContext.broadcast({"items": block})  # at most block_chars characters, or one item

        def scan(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            kept = shared.value  # the worker's own copy, which stays while the worker lives
            if (q, edits, words) not in kept:
                kept[q, edits, words] = ItemIndex(kept["items"], q, edits, words)
            for b in batches:
                rows = find_leaks(list(zip(b["doc_id"].tolist(), b["text"].tolist(), strict=True)), kept[q, edits, words])
                yield pd.DataFrame(rows, columns=["doc_id", "item_id", "edits", "cover", "exact", "item_words"])

        part = corpus.mapInPandas(scan, SCHEMA)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "doc_id long, item_id long, edits int, passage_words long, exact_words long, item_words int")
    each = found.select("doc_id", "item_id", "edits", "item_words", F.explode("cover").alias("p"), "exact")
    each = each.select("doc_id", "item_id", "edits", "item_words", "p", F.array_contains("exact", F.col("p")).alias("whole"))
    each = each.groupBy("doc_id", "item_id", "p").agg(F.min("edits").alias("edits"), F.max("item_words").alias("item_words"), F.max("whole").alias("whole"))
    return each.groupBy("doc_id", "item_id").agg(
        F.min("edits").alias("edits"), F.count(F.lit(1)).alias("passage_words"), F.count_if("whole").alias("exact_words"), F.max("item_words").alias("item_words")
    )
