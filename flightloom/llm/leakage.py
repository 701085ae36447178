"""Evaluation texts that leak into training text.

Pigeonhole edit matching.  A passage is a window of ``WINDOW`` item words in a document, of which at most ``BUDGET`` are
wrong (changed, dropped, or joined by foreign ones; a misspelt word is right).  Cut into ``BUDGET + 1`` pieces one is intact, and with at most ``FEW``
wrong words one of ``FEW + 1`` longer pieces is.  Intact pieces are found by exact search, at the hits Myers' bit-parallel distance compares
the item with the document, and what passes is aligned exactly, word by word.

Texts of the same manner share phrases with the items, with other names and figures between them.  Which phrases are
manner is told by the corpus: runs of ``PIECE`` item words that one in ``1 / MANNER_SHARE`` documents carries.  A window with more than ``FEW``
wrong words whose right words are manner is such a text; in windows with fewer it makes no difference.  So the shorter pieces are sought only
where they are no manner: the right words of a window with ``BUDGET`` wrong ones stand in at most ``BUDGET + 1`` runs, those in runs too short for a piece
are at most ``(PIECE - 1) * BUDGET``, and all others but ``MANNER_WORDS`` are in pieces that are sought.

All comparisons are made on squashed text: compatibility forms folded, case and accents
dropped, and only letters and digits kept, so that spacing and punctuation, also within
words and numbers, do not count.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW, BUDGET, FEW = 15, 3, 1
PIECE, LONG_PIECE = WINDOW // (BUDGET + 1), WINDOW // (FEW + 1)
#: Share of documents (and least number of them) that carry a phrase of manner, and right words of a window that may be manner.
MANNER_SHARE, MANNER_DOCUMENTS, MANNER_WORDS = 0.0003, 3, 2
LEAST_COVER = WINDOW - BUDGET - (PIECE - 1) * BUDGET - MANNER_WORDS
#: Characters by which hits of one passage may be shifted against each other.
SHIFT = 48
#: Characters compared at a time, and the share of them that may differ at the best of three places.
BITS, DISTANCE = 64, 0.50
#: Wrong words at either end of a window, which an alignment cannot claim.
ENDS = 1
#: Bytes of item text that one pass over the documents holds.
BYTES_PER_PASS = 16_000_000

_DROP = bytes(c for c in range(256) if not chr(c).isascii() or not chr(c).isalnum())
_LOWER = bytes(range(256)).lower()
_WORDS = regex.compile(r"[\p{L}\p{M}\p{N}]+(?:(?<=\p{N})[.,'’  ](?=\p{N}{3}(?!\p{N}))\p{N}+)*")


def squash(text: str) -> str:
    """Letters and digits only, without case, accents and compatibility forms."""
    if text.isascii():
        return text.encode().translate(_LOWER, _DROP).decode()
    folded = unicodedata.normalize("NFKD", text)
    if not folded.isascii():
        folded = "".join(c for c in folded.casefold() if c.isalnum())
    return folded.encode().translate(_LOWER, _DROP).decode() if folded.isascii() else folded


def words_of(text: str) -> list[str]:
    """Squashed words; a number keeps its groups of thousands in one word."""
    plain = unicodedata.normalize("NFKC", text).replace("­", "").replace("​", "")
    return [s for w in _WORDS.findall(plain) if (s := squash(w))]


@dataclass
class Item:
    words: list[str]
    starts: list[int]
    text: str
    #: whether the run of ``PIECE`` words from each word on is manner
    manner: list[bool] = field(default_factory=list)

    def run(self, k: int, n: int) -> str:
        return self.text[self.starts[k] : self.starts[k + n] if k + n < len(self.starts) else None]


@dataclass
class Index:
    """Items of one pass, with the automaton of their pieces."""

    items: dict[int, Item]
    #: where each piece stands: item, first word, number of words
    pieces: dict[str, list[tuple[int, int, int]]]

    def automaton(self) -> "ahocorasick.Automaton":
        if not hasattr(self, "_automaton"):
            self._automaton = _automaton(self.pieces)
        return self._automaton

    def __getstate__(self):
        return {"items": self.items, "pieces": self.pieces}


def _automaton(pieces) -> "ahocorasick.Automaton":
    a = ahocorasick.Automaton()
    for p in pieces:
        a.add_word(p, p)
    a.make_automaton()
    return a


def read_items(rows: list[tuple[int, str]]) -> dict[int, Item]:
    items: dict[int, Item] = {}
    for item_id, text in rows:
        words = words_of(text or "")
        starts, at = [], 0
        for w in words:
            starts.append(at)
            at += len(w)
        items[item_id] = Item(words, starts, "".join(words))
    return items


def short_pieces(items: dict[int, Item]) -> set[str]:
    return {i.run(k, PIECE) for i in items.values() for k in range(len(i.words) - PIECE + 1)}


def build_index(rows: list[tuple[int, str]], manner: frozenset[str] = frozenset()) -> Index:
    """Index of items; ``manner`` holds the runs of ``PIECE`` words that are phrases of manner in the corpus."""
    items = read_items(rows)
    pieces: dict[str, list[tuple[int, int, int]]] = {}
    for item_id, i in items.items():
        if len(i.words) < WINDOW:
            continue
        i.manner = [i.run(k, PIECE) in manner for k in range(len(i.words) - PIECE + 1)]
        for n in (PIECE, LONG_PIECE):
            for k in range(len(i.words) - n + 1):
                # a longer piece without manner is found by the shorter ones in it
                if any(i.manner[k : k + n - PIECE + 1]) if n == LONG_PIECE else not i.manner[k]:
                    pieces.setdefault(i.run(k, n), []).append((item_id, k, n))
    return Index(items, pieces)


def myers(patterns: list[str], texts: list[str]) -> np.ndarray:
    """Smallest edit distance of each pattern (at most 64 characters) to any stretch of its text.

    Bit-parallel, all pairs side by side: one 64-bit word per pair.
    """
    n = len(patterns)
    if not n:
        return np.zeros(0, dtype=int)
    width, length = max(map(len, patterns)), max(map(len, texts))
    code = lambda rows, w, pad: np.array([np.frombuffer(r.encode("utf-32-le"), dtype="<u4").tolist() + [pad] * (w - len(r)) for r in rows], dtype=np.int64)
    p, t = code(patterns, width, -1), code(texts, length, -2)
    symbols, inverse = np.unique(np.concatenate([p.ravel(), t.ravel()]), return_inverse=True)
    pi, ti = inverse[: p.size].reshape(p.shape), inverse[p.size :].reshape(t.shape)
    peq = np.zeros((len(symbols), n), dtype=np.uint64)
    lane, one = np.arange(n), np.uint64(1)
    sizes, ends = np.array([len(x) for x in patterns]), np.array([len(x) for x in texts])
    for j in range(width):
        has = j < sizes
        peq[pi[has, j], lane[has]] |= one << np.uint64(j)
    top = one << (np.maximum(sizes, 1) - 1).astype(np.uint64)
    pv, mv, score = np.full(n, ~np.uint64(0)), np.zeros(n, dtype=np.uint64), sizes.copy()
    best = sizes.copy()
    for j in range(length):
        eq = peq[ti[:, j], lane]
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph, mh = mv | ~(xh | pv), pv & xh
        score = score + ((ph & top) != 0) - ((mh & top) != 0)
        ph, mh = ph << one, mh << one
        pv, mv = mh | ~(xv | ph), ph & xv
        best = np.where(j < ends, np.minimum(best, score), best)
    return best


def _near(a: str, b: str) -> bool:
    """Equal but for one edit or a swap of neighbours."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > 1 or min(len(a), len(b)) < 3:
        return False
    k = 0
    while k < min(len(a), len(b)) and a[k] == b[k]:
        k += 1
    if len(a) == len(b):
        return a[k + 1 :] == b[k + 1 :] or (a[k : k + 2] == b[k : k + 2][::-1] and a[k + 2 :] == b[k + 2 :])
    return a[k + 1 :] == b[k:] if len(a) > len(b) else a[k:] == b[k + 1 :]


def _extend(words: list[str], k: int, text: str, at: int) -> list[int]:
    """State of each item word from ``k`` on, read along ``text`` from ``at``: 1 right or misspelt, 0 wrong.

    A wrong word may be changed, dropped or joined by a foreign one; after it the next two
    words (or one long or last one) must follow within reach.  More than ``BUDGET`` wrong words in a row end it.
    """
    out: list[int] = []
    n = len(words)
    while k < n:
        w = words[k]
        if text.startswith(w, at):
            out.append(1)
            at += len(w)
            k += 1
            continue
        found = None
        for skip, ahead in ((1, 2), (0, 2), (1, 1), (2, 2), (3, 2), (2, 1)):
            follow = "".join(words[k + skip : k + skip + ahead])
            if not follow or (ahead == 1 and len(follow) < 4 and k + skip + 1 < n):
                continue
            reach = sum(map(len, words[k : k + skip])) + 14 * max(skip, 1)
            to = text.find(follow, at, at + reach + len(follow))
            if to >= 0:
                found = skip, to
                break
        if found is None:
            return out
        skip, to = found
        if skip:
            out += [1 if skip == 1 and _near(w, text[at:to]) else 0] + [0] * (skip - 1)
        at, k = to, k + skip
    return out


def aligned(item: Item, k: int, size: int, text: str, at: int) -> tuple[int, list[int]]:
    """First word and states of the stretch of the item around its words ``k`` to ``k + size`` found at ``at``."""
    end = at + len(item.run(k, size))
    right = _extend(item.words, k + size, text, end)
    left_words = [w[::-1] for w in reversed(item.words[:k])]
    room = item.starts[k] * 2 + 40
    left = _extend(left_words, 0, text[max(0, at - room) : at][::-1], 0)
    return k - len(left), left[::-1] + [1] * size + right


def is_passage(item: Item, first: int, states: list[int]) -> bool:
    """Whether a window of the aligned stretch is a passage, by the number of its wrong words and of its words of manner."""
    low, high = max(0, first - ENDS), min(len(item.words), first + len(states) + ENDS)
    right = [0] * (first - low) + states + [0] * (high - first - len(states))
    for a in range(len(right) - WINDOW + 1):
        wrong = WINDOW - sum(right[a : a + WINDOW])
        if wrong <= FEW:
            return True
        if wrong <= BUDGET:
            rare, common = set(), set()
            for j in range(a, a + WINDOW - PIECE + 1):
                if all(right[j : j + PIECE]):
                    (common if item.manner[low + j] else rare).update(range(j, j + PIECE))
            if len(common - rare) <= MANNER_WORDS:
                return True
    return False


def _anchors(hits: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int]]:
    """One hit of each run of hits that overlap at the same place."""
    last = None
    for k, n, at in sorted(hits):
        if last is None or k > last[0] + last[1] or at - last[2] > SHIFT:
            yield k, n, at
            last = (k, n, at)
        else:
            last = (last[0], max(last[1], k + n - last[0]), at)


def leaks_in(texts: list[str | None], index: Index) -> Iterator[tuple[int, int]]:
    """(position of the text, item) of every text that carries a passage of an item."""
    if not index.pieces:
        return
    automaton = index.automaton()
    candidates: list[tuple[int, int, int, int, int, str]] = []
    for row, raw in enumerate(texts):
        if not raw:
            continue
        text = squash(raw)
        hits: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
        for last, piece in automaton.iter(text):
            at = last - len(piece) + 1
            for item_id, k, n in index.pieces[piece]:
                hits.setdefault((item_id, (at - index.items[item_id].starts[k]) // SHIFT), []).append((k, n, at))
        for (item_id, diagonal), own in hits.items():
            near = hits.get((item_id, diagonal + 1), ())
            if any(n == LONG_PIECE for _, n, _ in own) or len({w for k, n, _ in (*own, *near) for w in range(k, k + n)}) >= LEAST_COVER:
                candidates += [(row, item_id, k, n, at, text) for k, n, at in _anchors(own)]
    if not candidates:
        return
    patterns, regions = [], []
    for _, item_id, k, n, at, text in candidates:
        item = index.items[item_id]
        start, size = item.starts[k], len(item.run(k, n))
        for low in (start, start + size // 2 - BITS // 2, start + size - BITS):
            low = max(0, min(low, len(item.text) - BITS))
            patterns.append(item.text[low : low + BITS])
            a = at - (start - low)
            regions.append(text[max(0, a - 20) : max(0, a + BITS + 20)])
    distance = myers(patterns, regions) / np.maximum([len(p) for p in patterns], 1)
    passed = distance.reshape(-1, 3).min(axis=1) <= DISTANCE
    done: set[tuple[int, int]] = set()
    for ok, (row, item_id, k, n, at, text) in zip(passed, candidates):
        if ok and (row, item_id) not in done and is_passage(index.items[item_id], *aligned(index.items[item_id], k, n, text, at)):
            done.add((row, item_id))
            yield row, item_id


def manner_phrases(documents: DataFrame, text: str, phrases: set[str]) -> frozenset[str]:
    """Those of ``phrases`` (squashed) that are manner in the corpus: counted over all documents and whole texts.

    Tasks send sums per batch, Spark adds them up, and the phrases above the share come back, at most the given ones.
    """
    if not phrases:
        return frozenset()
    shared = documents.sparkSession.sparkContext.broadcast(phrases)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = _automaton(shared.value)
        found, n = Counter(), 0
        for pdf in batches:
            for raw in pdf["text"]:
                n += 1
                if raw:
                    found.update({p for _, p in automaton.iter(squash(raw))})
        yield pd.DataFrame([("", n), *found.items()], columns=["phrase", "n"])

    sums = documents.select(F.col(text).alias("text")).mapInPandas(count, "phrase string, n long").groupBy("phrase").agg(F.sum("n").alias("n"))
    # the empty phrase stands for all documents
    total = sums.where("phrase = ''").select(F.greatest(F.col("n") * MANNER_SHARE, F.lit(float(MANNER_DOCUMENTS))).alias("least"))
    return frozenset(r.phrase for r in sums.where("phrase <> ''").join(F.broadcast(total), F.col("n") >= F.col("least")).select("phrase").toLocalIterator())


def item_portions(items: DataFrame, item_id: str, text: str) -> list[list[tuple[int, str]]]:
    """Items in portions of at most ``BYTES_PER_PASS``, so that what a task holds is bounded."""
    portions: list[list[tuple[int, str]]] = [[]]
    room = BYTES_PER_PASS
    for i, t in items.select(item_id, text).where(F.col(item_id).isNotNull() & F.col(text).isNotNull()).distinct().orderBy(item_id).toLocalIterator():
        if portions[-1] and len(t) > room:
            portions.append([])
            room = BYTES_PER_PASS
        portions[-1].append((i, t))
        room -= len(t)
    return portions


def leaked_items(documents: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id) of every document that carries a passage of an item.

    Whole texts are searched; null and empty texts and items carry nothing; items shorter than
    a passage cannot leak; repeated documents and items count once; columns not named are left
    out; empty tables give no rows.

    The items are the stated query set: they are held by every task in portions of bounded
    size, two passes over the documents each (one counts phrases).  What an item finds does not depend on the other items.  Documents
    are not shuffled.
    """
    portions = item_portions(items, item_id, item_text)
    base = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = f"doc_id {base.schema['doc_id'].dataType.simpleString()}, item_id {items.schema[item_id].dataType.simpleString()}"
    context = documents.sparkSession.sparkContext
    out = None
    for part in portions:
        manner = manner_phrases(documents, text, short_pieces({k: i for k, i in read_items(part).items() if len(i.words) >= WINDOW}))
        shared = context.broadcast(build_index(part, manner))

        def search(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            index = shared.value
            for pdf in batches:
                ids = pdf["doc_id"].tolist()
                rows = [(ids[row], item) for row, item in leaks_in(pdf["text"].tolist(), index)]
                yield pd.DataFrame(rows, columns=["doc_id", "item_id"])

        found = base.mapInPandas(search, schema)
        out = found if out is None else out.unionByName(found)
    return out.distinct()
