"""Benchmark decontamination: a BM25 index of test items, asked by every training passage with block-max WAND, and verified by overlap."""

from __future__ import annotations

import math
import re
from array import array
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracecut.llm.common import check_names, field, map_columns, table

WORD = re.compile(r"[^\W_]+")
SENTENCE = re.compile(r"(?<=[.!?])\s+")
K1, B = 1.2, 0.75
#: Share of an item's score for itself that a passage must reach to be retrieved.
RETRIEVE = 0.6
#: Share of an item's score that its essential terms make up.
SCREEN = 0.7
#: Postings that share one bound.
BLOCK = 64
#: Words of the shingles, and the share of the question's and of the answer's shingles that a passage must hold.
SHINGLE = 5
OVERLAP = 0.8
#: Items, and characters of items, of one broadcast index; more items take more passes.
INDEX_ITEMS = 20_000
INDEX_CHARS = 32_000_000


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """The last sentence is the answer; of a single one the last quarter of the words."""
    parts = [words_of(s) for s in SENTENCE.split(text)]
    parts = [p for p in parts if p]
    if len(parts) > 1:
        return [w for p in parts[:-1] for w in p], parts[-1]
    words = parts[0] if parts else []
    cut = len(words) - len(words) // 4
    return words[:cut], words[cut:]


def shingles(words: list[str]) -> set[tuple[str, ...]]:
    k = min(SHINGLE, len(words))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if k else set()


class Index:
    """Postings by term: items in order, with impacts as shares of the item's score for itself, and a bound per block."""

    def __init__(self, items: list[tuple[object, str]], retrieve: float = RETRIEVE):
        kept = [(k, t, words_of(t)) for k, t in items]
        kept = [x for x in kept if x[2]]
        self.keys = [k for k, _, _ in kept]
        self.retrieve = retrieve
        self.parts = [question_and_answer(t) for _, t, _ in kept]
        self.grams = [(shingles(q), shingles(a)) for q, a in self.parts]
        self.longest = max((len(w) for _, _, w in kept), default=0)
        n = len(kept)
        held = Counter(w for _, _, ws in kept for w in set(ws))
        mean = sum(len(ws) for _, _, ws in kept) / max(n, 1)
        postings: dict[str, list] = {}
        for item, (_, _, ws) in enumerate(kept):
            impact = {}
            for w, tf in Counter(ws).items():
                idf = math.log(1 + (n - held[w] + 0.5) / (held[w] + 0.5))
                impact[w] = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(ws) / mean))
            total = sum(impact.values())
            for w, x in impact.items():
                postings.setdefault(w, []).append((item, x / total))
        self.terms = {w: i for i, w in enumerate(sorted(postings), 1)}
        # 8 bytes each, as every Python worker holds the whole index
        self.items, self.impacts, self.bounds = [array("q")], [array("d")], [array("d")]
        for w in sorted(postings):
            self.items.append(array("q", (i for i, _ in postings[w])))
            self.impacts.append(own := array("d", (x for _, x in postings[w])))
            self.bounds.append(array("d", (max(own[i : i + BLOCK]) for i in range(0, len(own), BLOCK))))
        self.most = [0.0, *(max(b) for b in self.bounds[1:])]
        self.essential(kept, held, postings)

    def essential(self, kept: list, held: Counter, postings: dict[str, list]) -> None:
        """Of each item the rarest terms whose impacts sum to SCREEN; a passage must hold so many of them that the rest could lift it to the threshold."""
        impact = {(w, i): x for w, own in postings.items() for i, x in own}
        rows, self.need = [], np.zeros(len(kept))
        for item, (_, _, ws) in enumerate(kept):
            total = 0.0
            for w in sorted(set(ws), key=lambda w: (held[w], w)):
                if total >= SCREEN:
                    break
                total += impact[w, item]
                rows.append((self.terms[w], item, impact[w, item]))
            self.need[item] = self.retrieve - (1 - total) - 1e-9
        rows.sort()
        self.screen_at = np.searchsorted([r[0] for r in rows], np.arange(len(self.terms) + 2))
        self.screen_items = np.array([r[1] for r in rows], np.int64)
        self.screen_impacts = np.array([r[2] for r in rows])

    def wand(self, terms: list[int]) -> list[tuple[int, float]]:
        """All items whose score reaches the threshold, by block-max WAND.

        Cursors stand in order of their items. The pivot is the first at which the terms' bounds could
        reach the threshold; if the bounds of the blocks there can't, all cursors up to it skip to the
        end of the nearest block; else the pivot's item is scored.
        """
        least = self.retrieve - 1e-9
        cursors = sorted([self.items[t][0], t, 0] for t in terms)
        found = []
        while cursors:
            total, pivot = 0.0, -1
            for i, (_, t, _) in enumerate(cursors):
                total += self.most[t]
                if total >= least:
                    pivot = i
                    break
            if pivot < 0:
                break
            item = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                pivot += 1
            bound, skip = 0.0, cursors[pivot + 1][0] if pivot + 1 < len(cursors) else len(self.keys)
            for _, t, at in cursors[: pivot + 1]:
                at = bisect_left(self.items[t], item, at)
                if at < len(self.items[t]):
                    block = at // BLOCK
                    bound += self.bounds[t][block]
                    skip = min(skip, self.items[t][min((block + 1) * BLOCK, len(self.items[t])) - 1] + 1)
            if bound >= least:
                score, skip = 0.0, item + 1
                for _, t, at in cursors[: pivot + 1]:
                    at = bisect_left(self.items[t], item, at)
                    if at < len(self.items[t]) and self.items[t][at] == item:
                        score += self.impacts[t][at]
                if score >= least:
                    found.append((item, score))
            skip = max(skip, item + 1) if bound < least else skip
            moved = []
            for c in cursors[: pivot + 1]:
                at = bisect_left(self.items[c[1]], skip, c[2])
                if at < len(self.items[c[1]]):
                    moved.append([self.items[c[1]][at], c[1], at])
            cursors = sorted(moved + cursors[pivot + 1 :])
        return found

    def windows(self, ids: np.ndarray) -> np.ndarray:
        """Starts of the passages, two steps long and one step apart, in which some item's essential terms leave it a chance."""
        step = self.longest
        at = np.flatnonzero(ids)
        at = at[self.screen_at[ids[at] + 1] > self.screen_at[ids[at]]]
        if not len(at):
            return at
        terms = ids[at]
        order = np.argsort(terms, kind="stable")
        before = np.full(len(at), -1)
        same = terms[order][1:] == terms[order][:-1]
        before[order[1:][same]] = at[order[:-1][same]]
        half = at // step
        # a term counts where it comes first in a passage; each place lies in two
        first, second = before < half * step, (half > 0) & (before < (half - 1) * step)
        terms, passage = np.concatenate([terms[first], terms[second]]), np.concatenate([half[first], half[second] - 1])
        n = self.screen_at[terms + 1] - self.screen_at[terms]
        where = np.repeat(self.screen_at[terms] - np.cumsum(n) + n, n) + np.arange(n.sum())
        items = self.screen_items[where]
        cells, cell = np.unique(np.repeat(passage, n) * len(self.keys) + items, return_inverse=True)
        total = np.bincount(cell, self.screen_impacts[where], len(cells))
        return np.unique(cells[total >= self.need[cells % len(self.keys)]] // len(self.keys)) * step

    def search(self, text: str | None) -> dict[int, tuple[float, float, float, int]]:
        """Verified items of a text: score, overlap of question and of answer, and the word where the best passage starts."""
        words = words_of(text)
        if not words or not self.keys:
            return {}
        get = self.terms.get
        ids = np.fromiter((get(w, 0) for w in words), np.int64, len(words))
        out: dict[int, tuple] = {}
        step = self.longest
        for start in self.windows(ids).tolist():
            part = ids[start : start + 2 * step]
            hits = self.wand(np.unique(part[part > 0]).tolist())
            if hits:
                near = words[max(0, start - step) : start + 3 * step]
                for item, score in hits:
                    if item in out and out[item][0] >= score:
                        continue
                    overlaps = [self.overlap(near, g) for g in self.grams[item]]
                    if min(overlaps) >= OVERLAP:
                        out[item] = (score, *overlaps, start)
        return out

    @staticmethod
    def overlap(near: list[str], grams: set[tuple[str, ...]]) -> float:
        if not grams:
            return 1.0
        k = len(next(iter(grams)))
        own = {tuple(near[i : i + k]) for i in range(len(near) - k + 1)}
        return len(grams & own) / len(grams)


def indexes(tests: DataFrame, key: str, text: str, retrieve: float):
    """An index per INDEX_ITEMS items or INDEX_CHARS characters, in order of their keys; items without words are in none."""
    block, size = [], 0
    for r in tests.select(key, text).filter(F.col(text).isNotNull()).orderBy(key, text).toLocalIterator():
        if block and (len(block) >= INDEX_ITEMS or size + len(r[1]) > INDEX_CHARS):
            yield Index(block, retrieve)
            block, size = [], 0
        block.append((r[0], r[1]))
        size += len(r[1])
    yield Index(block, retrieve)


def find_leaks(docs: DataFrame, tests: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", retrieve: float = RETRIEVE) -> DataFrame:
    """A row per document and test item that it holds: key, item_id, score, question_overlap, answer_overlap, at_word.

    Every passage of every whole text is a query: twice as long as the longest item, and starting so
    often that any item's place lies in one. Of the items retrieved those stay whose question and
    answer shingles lie near the passage to OVERLAP. The tests are asked in blocks of a bounded index
    each. Null and empty texts and items have no rows; repeated documents or items have a row each.
    """
    names = ["item_id", "score", "question_overlap", "answer_overlap", "at_word"]
    check_names(key, names)
    hit = T.ArrayType(T.StructType([T.StructField("item_id", field(tests, item_key).dataType), *(T.StructField(n, T.DoubleType()) for n in names[1:4]), T.StructField("at_word", T.LongType())]))
    schema = T.StructType([field(docs, key), T.StructField("hits", hit)])
    out = None
    for index in indexes(tests, item_key, item_text, retrieve):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def make(shared=shared) -> Callable:
            index = shared.value

            def step(keys, texts):
                hits = [[dict(zip(names, (index.keys[i], *x), strict=True)) for i, x in sorted(index.search(t).items())] for t in texts]
                found = [i for i, h in enumerate(hits) if h]
                return [keys[i] for i in found], [hits[i] for i in found]

            return step

        part = map_columns(docs.select(key, text), make, schema).select(key, F.explode("hits").alias("hit")).select(key, "hit.*")
        out = part if out is None else out.unionByName(part)
    return out


def without_leaks(docs: DataFrame, tests: DataFrame, columns: list[str], text: str = "text", item_key: str = "item_id", item_text: str = "text", retrieve: float = RETRIEVE) -> DataFrame:
    """The documents in which `find_leaks` finds no item, with these columns.

    Null and empty texts hold none and stay; repeated rows stay or go alike; without items all stay, and
    an empty table gives an empty one.
    """
    out = docs.select(*columns)
    at = columns.index(text)
    for index in indexes(tests, item_key, item_text, retrieve):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def make(shared=shared) -> Callable:
            search = shared.value.search

            def step(*own):
                clean = [i for i, t in enumerate(own[at]) if not search(t)]
                return tuple([c[i] for i in clean] for c in own)

            return step

        out = map_columns(out, make, T.StructType(out.schema.fields))
    return out


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
