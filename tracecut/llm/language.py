"""Language ID: a byte convolutional network with max pooling and softmax, trained in numpy, over fixed-length windows."""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tracecut.llm.common import check_names, field, map_columns, table

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 24
#: Windows that the network learns from, and how many of each language at least, however many there are.
SAMPLE_ROWS = 4_000
LEAST_ROWS = 62
EPOCHS = 6
#: Windows that pass the network at once.
CHUNK = 256
LETTER = re.compile(r"[^\W\d_]")
UNDECIDED = "und"


def windows(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a whole text in rows of WINDOW, the last row filled with zeros, and the bytes of each row."""
    raw = np.frombuffer(text.encode(), np.uint8)
    rows = -(-len(raw) // WINDOW)
    out = np.zeros((rows, WINDOW), np.uint8)
    out.ravel()[: len(raw)] = raw
    sizes = np.full(rows, WINDOW)
    sizes[-1] = len(raw) - WINDOW * (rows - 1)
    return out, sizes


class Network:
    """Filters of each width over bytes: a filter is a row of weights per offset and byte value, so it is applied by look-up."""

    def __init__(self, languages: list[str], seed: int = 11):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.filters = {w: rng.normal(0, 0.1, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS}
        self.bias = {w: np.zeros(FILTERS, np.float32) for w in WIDTHS}
        n = FILTERS * len(WIDTHS)
        self.out = rng.normal(0, 1 / np.sqrt(n), (n, len(languages))).astype(np.float32)
        self.out_bias = np.zeros(len(languages), np.float32)

    def pooled(self, x: np.ndarray, where: bool = False):
        """The largest activation of each filter in each window, at least 0; where: with its place."""
        tops, places = [], []
        for w in WIDTHS:
            n = WINDOW - w + 1
            act = self.filters[w][0][x[:, :n]]
            for j in range(1, w):
                act += self.filters[w][j][x[:, j : j + n]]
            if where:
                at = act.argmax(1)
                places.append(at)
                top = np.take_along_axis(act, at[:, None], 1)[:, 0]
            else:
                top = act.max(1)
            tops.append(np.maximum(top + self.bias[w], 0))
        return np.concatenate(tops, 1), places

    def log_probs(self, x: np.ndarray) -> np.ndarray:
        z = self.pooled(x)[0] @ self.out + self.out_bias
        z -= z.max(1, keepdims=True)
        return z - np.log(np.exp(z).sum(1, keepdims=True))

    def train(self, x: np.ndarray, y: np.ndarray, seed: int = 5) -> None:
        """Cross-entropy by Adam-scaled steps over small batches."""
        rng = np.random.default_rng(seed)
        parts = [*self.filters.values(), *self.bias.values(), self.out, self.out_bias]
        first, second = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
        t = 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(x))
            for at in range(0, len(order), 64):
                rows = order[at : at + 64]
                t += 1
                for p, g, m, v in zip(parts, self.gradients(x[rows], y[rows]), first, second, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= 0.004 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)

    def gradients(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        h, places = self.pooled(x, where=True)
        z = h @ self.out + self.out_bias
        z = np.exp(z - z.max(1, keepdims=True))
        d = z / z.sum(1, keepdims=True)
        d[np.arange(len(y)), y] -= 1
        d /= len(y)
        back = (d @ self.out.T) * (h > 0)
        filters, biases = [], []
        for k, w in enumerate(WIDTHS):
            part = back[:, k * FILTERS : (k + 1) * FILTERS]
            g = np.zeros_like(self.filters[w])
            for j in range(w):
                np.add.at(g[j], (np.take_along_axis(x, places[k] + j, 1), np.arange(FILTERS)[None, :]), part)
            filters.append(g)
            biases.append(part.sum(0))
        return [*filters, *biases, h.T @ d, d.sum(0)]

    def classify(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and its probability, by the mean log-probability of a text's windows, each weighing its bytes."""
        parts = [windows(t) if t and LETTER.search(t) else None for t in texts]
        kept = [p for p in parts if p is not None]
        if not kept or not self.languages:
            return [UNDECIDED] * len(texts), [0.0] * len(texts)
        x = np.concatenate([p[0] for p in kept])
        logs = np.concatenate([self.log_probs(x[i : i + CHUNK]) for i in range(0, len(x), CHUNK)]).astype(np.float64)
        logs *= np.concatenate([p[1] for p in kept])[:, None]
        starts = np.cumsum([0, *(len(p[0]) for p in kept[:-1])])
        mean = np.add.reduceat(logs, starts, 0) / np.array([p[1].sum() for p in kept])[:, None]
        mean -= mean.max(1, keepdims=True)
        probs = np.exp(mean)
        probs /= probs.sum(1, keepdims=True)
        best = probs.argmax(1)
        found = iter(zip((self.languages[b] for b in best), probs[np.arange(len(best)), best].tolist(), strict=True))
        pairs = [(UNDECIDED, 0.0) if p is None else next(found) for p in parts]
        return [a for a, _ in pairs], [b for _, b in pairs]


def fit(docs: DataFrame, text: str, lang: str, learn) -> Network:
    """A network of every language, from SAMPLE_ROWS labelled texts or LEAST_ROWS a language, as many of each, those of smallest hash.

    Of each text one stretch of WINDOW characters is taken, at a place given by the hash.
    """
    rows = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull() & learn).select(F.col(lang).alias("__lang"), F.col(text).alias("__text"))
    sizes = rows.groupBy("__lang").count().collect()
    if not sizes:
        return Network([])
    each = max(LEAST_ROWS, SAMPLE_ROWS // len(sizes))
    # a hash below the language's share keeps about three times the rows needed; the limits are exact
    share = docs.sparkSession.createDataFrame([(r[0], min(1.0, 3 * each / r[1])) for r in sizes], "__lang string, __share double")
    h = F.xxhash64("__text")
    uniform = F.pmod(h, F.lit(1 << 30)) / float(1 << 30)
    start = F.pmod(F.shiftright(h, 32), F.greatest(F.length("__text") - WINDOW, F.lit(1))).cast("int") + 1
    near = rows.join(F.broadcast(share), "__lang").filter(uniform < F.col("__share")).select("__lang", h.alias("__hash"), F.col("__text").substr(start, F.lit(WINDOW)).alias("__text"))
    least = Window.partitionBy("__lang").orderBy("__hash", "__text")
    picked = near.distinct().withColumn("__rank", F.row_number().over(least)).filter(F.col("__rank") <= each)
    x, y, languages = [], [], sorted(r[0] for r in sizes)
    places = {language: k for k, language in enumerate(languages)}
    for r in sorted(picked.collect(), key=lambda r: (places[r["__lang"]], r["__rank"])):
        if LETTER.search(r["__text"]):
            x.append(windows(r["__text"])[0][0])
            y.append(places[r["__lang"]])
    net = Network(languages if x else [])
    if x:
        net.train(np.stack(x), np.array(y))
    return net


def fourth(key):
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(4))


def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", learn=None) -> DataFrame:
    """One row a document: its key, lang_pred, score.

    The network learns from a bounded sample of rows with text and language that `learn` (a column,
    all if None) keeps, and is applied to every byte of every text. Null texts, texts without a
    letter, and all texts if there is nothing to learn from are `und` with score 0.
    """
    check_names(key, ["lang_pred", "score"])
    net = docs.sparkSession.sparkContext.broadcast(fit(docs, text, lang, F.lit(True) if learn is None else learn))
    schema = T.StructType([field(docs, key), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def make() -> Callable:
        classify = net.value.classify

        def step(keys, texts):
            langs, scores = [], []
            for i in range(0, len(texts), 64):
                a, b = classify(texts[i : i + 64])
                langs += a
                scores += b
            return keys, langs, scores

        return step

    return map_columns(docs.select(key, text), make, schema)


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify(docs, learn=fourth(F.col("doc_id")) != 2)
    return found.select("doc_id", (fourth(F.col("doc_id")) == 2).alias("held_out"), "lang_pred", "score")
