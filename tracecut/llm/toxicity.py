"""Toxicity: class-conditional Kneser-Ney bigram models with shared backoff counts."""

from __future__ import annotations

import math
import re
import sys
from collections import Counter
from collections.abc import Callable

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracecut.llm.common import check_names, field, map_columns, table

WORD = re.compile(r"[^\W_]+")
#: Labelled rows of each class that are drawn for the models; their texts are learned whole.
SAMPLE_ROWS = 3_000
#: Words of a stretch over which log-likelihoods are normalised; stretches overlap by half.
STRETCH = 12
#: Log-likelihood ratios move by so much towards 0: lesser differences between the classes are no evidence.
LEAST = 0.8
#: What is taken from each count and given to the shared counts; a count up to this goes there wholly.
DISCOUNT = 4.0
PREDICT_AT = 0.7
MULTIPLIERS = (1, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def words_of(text: str | None) -> list[str]:
    return list(map(sys.intern, WORD.findall(text.lower()))) if text else []


def discount(n: np.ndarray) -> np.ndarray:
    return np.minimum(n, DISCOUNT).astype(np.float64)


class Counts:
    """Discounted word and bigram counts of some texts, given as word ids from 1 on; id 0 is any other word.

    A count is of texts: one counts an expression once, however often it repeats it. Counts up to
    DISCOUNT have no weight of their own, so only sums remain of them.
    """

    def __init__(self, texts: list[np.ndarray], size: int):
        uni = np.zeros(size, np.int64)
        for ids in texts:
            uni[np.unique(ids)] += 1
        pairs = [np.unique(ids[:-1] * size + ids[1:]) for ids in texts]
        code, n = np.unique(np.concatenate([*pairs, np.zeros(0, np.int64)]), return_counts=True)
        self.size = size
        self.uni, self.total = uni - discount(uni), max(int(uni.sum()), 1)
        self.kept = float(discount(uni).sum()) / self.total if uni.any() else 1.0
        self.context = np.bincount(code // size, n, size)
        self.given = np.bincount(code // size, discount(n), size)
        self.continued = np.bincount(code % size, minlength=size)
        self.code, self.n = code[n > DISCOUNT], n[n > DISCOUNT] - discount(n[n > DISCOUNT])

    def words(self, backoff: np.ndarray) -> np.ndarray:
        return self.uni / self.total + self.kept * backoff

    def pairs(self, a: np.ndarray, b: np.ndarray, backoff: np.ndarray) -> np.ndarray:
        total = self.context[a]
        found = np.zeros(len(a))
        if len(self.code):
            code = a * self.size + b
            at = np.minimum(np.searchsorted(self.code, code), len(self.code) - 1)
            found = np.where(self.code[at] == code, self.n[at], 0.0)
        safe = np.maximum(total, 1)
        return np.where(total > 0, found / safe + self.given[a] / safe * backoff, backoff)


    def scaled_sums(self, scale: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Of each context the sum over all words of its probability times the word's scale, if it backs off to words / scale."""
        rest = np.where(self.context > 0, self.given / np.maximum(self.context, 1), 1.0)
        before = self.code // self.size
        return rest * words.sum() + np.bincount(before, self.n / np.maximum(self.context[before], 1) * scale[self.code % self.size], self.size)


def without_copies(texts: list[list[str]]) -> list[list[str]]:
    """The texts but for those that share a smallest five-word shingle hash, by one of four hashes, with an earlier one."""
    seen, out = set(), []
    for words in texts:
        grams = np.array([xxhash.xxh3_64_intdigest(" ".join(words[i : i + 5]).encode()) for i in range(max(1, len(words) - 4))], np.uint64)
        mins = {(k, int((grams * np.uint64(m)).min())) for k, m in enumerate(MULTIPLIERS)}
        if not mins & seen:
            out.append(words)
        seen |= mins
    return out


class Model:
    """A model of each class, and a calibration of a text's log-likelihood ratios.

    P(word | word before) of a class: its discounted bigram count backs off to the bigram in both
    classes, scaled by how much likelier the class has the word itself, and divided by the sum of that
    over all words; the class's word probability backs off to the continuation counts of both classes,
    in how many contexts the word was seen at all. So both are distributions over all words in every
    context, what one class never has is rare there and not impossible, and what is rare in both is no
    evidence.
    """

    def __init__(self, toxic: list[str], plain: list[str]):
        both = [without_copies([words_of(t) for t in dict.fromkeys(texts)]) for texts in (toxic, plain)]
        often = Counter(w for texts in both for words in texts for w in set(words))
        self.ids = {w: i for i, w in enumerate(sorted(w for w, n in often.items() if n > 1), 1)}
        del often
        ids = [[self.encode(words) for words in texts] for texts in both]
        # every fifth text is held back for the calibration
        held = [[w for i, w in enumerate(texts) if i % 5 == 0] for texts in ids]
        rest = [[w for i, w in enumerate(texts) if i % 5] for texts in ids]
        size = len(self.ids) + 1
        self.pooled = Counts(rest[0] + rest[1], size)
        self.toxic, self.plain = (Counts(texts, size) for texts in rest)
        self.shared = (self.pooled.continued + 1.0) / (self.pooled.continued.sum() + size)
        self.words = [c.words(self.shared) for c in (self.toxic, self.plain)]
        self.sums = [self.pooled.scaled_sums(w / self.shared, w) for w in self.words]
        self.weights = np.array([1.0, 1.0, 0.0])
        y = np.repeat([1.0, 0.0], [len(t) for t in held])
        if y.any() and not y.all():
            self.weights = logistic(self.features(held[0] + held[1]), y)

    def encode(self, words: list[str]) -> np.ndarray:
        """Word ids behind a 0 that stands for the start of a text."""
        return np.fromiter((self.ids.get(w, 0) for w in ["", *words]), np.int64, len(words) + 1)

    def probabilities(self, a: np.ndarray, b: np.ndarray) -> list[np.ndarray]:
        """P(b | a) of the toxic and of the ordinary class."""
        pair = self.pooled.pairs(a, b, self.shared[b]) / self.shared[b]
        return [c.pairs(a, b, w[b] * pair / total[a]) for c, w, total in zip((self.toxic, self.plain), self.words, self.sums, strict=True)]

    def log_ratios(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        toxic, plain = self.probabilities(a, b)
        r = np.log(toxic / plain)
        r = np.sign(r) * np.maximum(np.abs(r) - LEAST, 0)
        return np.where(b > 0, r, 0.0)

    def features(self, texts: list[np.ndarray]) -> np.ndarray:
        """Of each text its log-likelihood ratios normalised by length: the largest mean of a stretch, and the sum over the root of the number of words.

        A bigram counts where it comes first. A text without words has zeros.
        """
        out = np.zeros((len(texts), 2))
        if not texts:
            return out
        each = self.log_ratios(np.concatenate([t[:-1] for t in texts]), np.concatenate([t[1:] for t in texts]))
        at = 0
        for k, t in enumerate(texts):
            n = len(t) - 1
            own = each[at : at + n]
            at += n
            places = np.flatnonzero(own)
            if not len(places):
                continue
            first = np.unique(t[places] * self.toxic.size + t[places + 1], return_index=True)[1]
            once = np.zeros(n + 1)
            once[places[first] + 1] = own[places[first]]
            sums = np.cumsum(once)
            ends = np.minimum(np.arange(0, n, STRETCH // 4) + STRETCH, n)
            out[k] = (sums[ends] - sums[np.maximum(ends - STRETCH, 0)]).max() / STRETCH, sums[n] / math.sqrt(n)
        return out

    def scores(self, texts: list[str | None]) -> list[float]:
        z = self.features([self.encode(words_of(t)) for t in texts]) @ self.weights[:2] + self.weights[2]
        return (1 / (1 + np.exp(-np.clip(z, -30, 30)))).tolist()


def logistic(x: np.ndarray, y: np.ndarray, steps: int = 100) -> np.ndarray:
    """Weights of the columns of x (0 at least) and a shift, by damped Newton steps, both classes weighing the same."""
    weight = np.where(y > 0, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    design, ridge = np.column_stack([x, np.ones(len(x))]), np.array([1e-3] * x.shape[1] + [1e-9])
    beta = np.zeros(design.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        grad = design.T @ (weight * (y - p)) - ridge * beta
        hess = (design * (weight * p * (1 - p))[:, None]).T @ design + np.diag(ridge) + 1e-6 * np.eye(len(beta))
        move = np.clip(np.linalg.solve(hess, grad), -2, 2)
        beta += move
        if np.abs(move).max() < 1e-8:
            break
    return np.append(np.maximum(beta[:-1], 0.0), beta[-1])


def fit(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, learn: Callable) -> Model:
    """A model from SAMPLE_ROWS labelled rows a class, those of smallest hash, so that each run draws the same."""
    rows = labels.filter(F.col(label).isin(0, 1) & learn(F.col(key))).select(key, label).distinct()
    picked = [rows.filter(F.col(label) == c).orderBy(F.xxhash64(key), key).limit(SAMPLE_ROWS) for c in (1, 0)]
    chosen = picked[0].unionByName(picked[1])
    got = docs.select(key, F.col(text).alias("__text")).join(F.broadcast(chosen), key).groupBy(key, label).agg(F.min("__text").alias("t")).orderBy(key, label)
    texts: tuple[list, list] = ([], [])
    for r in got.select(label, "t").toLocalIterator():
        texts[r[0]].append(r[1] or "")
    return Model(texts[1], texts[0])


def third(key):
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(3))


def score_toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", learn: Callable | None = None) -> DataFrame:
    """One row a document: its key, score from 0 to 1, predicted (1 from PREDICT_AT on).

    The models learn from a bounded sample of the labelled rows that learn(key column) keeps, all if
    None; null or other labels are no labels. Every whole text is scored, null and empty ones by the
    calibration alone. Without rows of both classes all scores are those of two equal models.
    """
    check_names(key, ["score", "predicted"])
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, key, text, label, learn or (lambda k: k.isNotNull())))
    schema = T.StructType([field(docs, key), T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def make() -> Callable:
        score = model.value.scores

        def step(keys, texts):
            scores = [s for i in range(0, len(texts), 64) for s in score(texts[i : i + 64])]
            return keys, scores, [int(s >= PREDICT_AT) for s in scores]

        return step

    return map_columns(docs.select(key, text), make, schema)


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), learn=lambda k: k.isNotNull() & (third(k) != 1))
    return scored.select("doc_id", (third(F.col("doc_id")) == 1).alias("held_out"), "score", "predicted")
