"""Token counts: pieces are counted once per distinct pre-token and summed over each document's pre-token frequencies."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable

import pyarrow as pa
import public_tokenizers
import sentencepiece
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracecut.llm.common import check_names, field, joined, map_columns, table, written

#: Tokens above which a document is over the limit.
LIMIT = 4096
#: Documents, about, from which the frequent pre-tokens are taken, and how many of these are broadcast.
#: They only spare a shuffle: whichever are taken, every document's sum is the same.
SAMPLE_DOCS = 6_000
BROADCAST_ROWS = 200_000
#: Pre-tokens up to this length are known by themselves, longer ones by their hash, so that what is broadcast has a bound.
KEY_CHARS = 40
#: Distinct pre-tokens that a task counts before it hands them on, and texts that it knows as seen.
FLUSH = 100_000
SEEN = 100_000
#: Runs of letters, or of other characters, each with the blanks before it; runs of line breaks and
#: tabs; blanks at the end. No piece of the vocabulary crosses a border between these (splits_safely
#: tells), so no merge does, and a text's pieces are those of its pre-tokens.
PRE_TOKEN = re.compile(r"[\n\t]+|\x20*[^\W\d_²]+|\x20*(?:(?![\x20\n\t])[\W\d_²])+|\x20+")


def splits_safely(model: sentencepiece.SentencePieceProcessor) -> bool:
    """Whether every piece of the vocabulary lies within one pre-token."""
    pieces = (model.id_to_piece(i).replace("▁", " ") for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i)))
    return all(len(PRE_TOKEN.findall(p)) == 1 for p in pieces)


class PieceCounter:
    """Pieces of one pre-token, as they are inside a longer text."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        if not splits_safely(self.model):
            raise ValueError(f"{path}: its pieces cross the borders of pre-tokens")
        self.lead = len(self.model.encode("\n"))

    def __call__(self, tokens: list[str]) -> list[int]:
        """A line break in front keeps the model's own leading blank apart from the pre-token."""
        return [len(ids) - self.lead for ids in self.model.encode(["\n" + t for t in tokens], num_threads=1)]


def pre_tokens(text: str | None) -> list[str]:
    """The model puts one blank before a text that isn't empty, and so it is done here."""
    return PRE_TOKEN.findall(" " + text.replace("▁", " ")) if text else []


def frequencies(docs: DataFrame, text: str = "text") -> DataFrame:
    """pre_token, freq: over all texts, summed within a task first."""
    schema = T.StructType([T.StructField("pre_token", T.StringType()), T.StructField("freq", T.LongType())])

    def run(batches):
        held: Counter = Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["pre_token", "freq"])

        for batch in batches:
            for t in batch.column(0).to_pylist():
                held.update(pre_tokens(t))
                if len(held) >= FLUSH:
                    yield out()
                    held = Counter()
        if held:
            yield out()

    return docs.select(text).mapInArrow(run, schema).groupBy("pre_token").agg(F.sum("freq").alias("freq"))


def text_key(t: str) -> bytes:
    return xxhash.xxh3_128_digest(t.encode())


def short_key(token: str) -> str | bytes:
    return token if len(token) <= KEY_CHARS else text_key(token)


def frequent(docs: DataFrame, text: str, path: str) -> dict[str | bytes, int]:
    """Pieces by `short_key` of the most frequent pre-tokens of a sample: BROADCAST_ROWS keys of KEY_CHARS characters at most."""
    rows = max(1, docs.count())
    sample = docs.sample(min(1.0, SAMPLE_DOCS / rows), seed=17)
    top = frequencies(sample, text).filter(F.col("freq") > 1).orderBy(F.desc("freq"), F.length("pre_token"), "pre_token").limit(BROADCAST_ROWS)
    schema = T.StructType([T.StructField("short", T.StringType()), T.StructField("hash", T.BinaryType()), T.StructField("pieces", T.LongType())])

    def make() -> Callable:
        count = PieceCounter(path)

        def step(tokens):
            keys = [short_key(t) for t in tokens]
            return [k if isinstance(k, str) else None for k in keys], [k if isinstance(k, bytes) else None for k in keys], count(tokens)

        return step

    found = map_columns(top.select("pre_token"), make, schema).toArrow()
    return {short if short is not None else own: n for short, own, n in zip(*(c.to_pylist() for c in found.columns), strict=True)}


def count_tokens(docs: DataFrame, key: str = "doc_id", text: str = "text", model: str | None = None, limit: int = LIMIT) -> DataFrame:
    """One row a document: its key, n_bytes, n_tokens, over_limit.

    A document's pre-token frequencies are summed at once for pre-tokens that are frequent
    everywhere; those come by broadcast, so none of them is a hot key. All others are dealt out by
    pre-token, so that each distinct one lies in one task and is counted there once, and return as
    sums keyed by the text's hash, so that repeated rows and null keys need no identity. No ids are
    kept. Null and empty texts have 0 bytes and 0 tokens; an empty table gives an empty one.
    """
    check_names(key, ["n_bytes", "n_tokens", "over_limit", "known", "text_key", "rare"])
    path = model or public_tokenizers.path("piece_bpe_32k.model")
    known = docs.sparkSession.sparkContext.broadcast(frequent(docs, text, path))
    schema = T.StructType([field(docs, key), T.StructField("n_bytes", T.LongType()), T.StructField("known", T.LongType()), T.StructField("text_key", T.BinaryType())])
    rest_schema = T.StructType([T.StructField("pre_token", T.StringType()), T.StructField("text_key", T.BinaryType()), T.StructField("n", T.IntegerType())])

    def sums() -> Callable:
        pieces = known.value
        long_known = any(isinstance(k, bytes) for k in pieces)

        def step(keys, texts):
            n_bytes, n_known, hashes = [], [], []
            for t in texts:
                found = list(map(pieces.get, own := pre_tokens(t)))
                missing = None in found
                if missing and long_known:
                    found = [pieces.get(short_key(w)) if n is None and len(w) > KEY_CHARS else n for n, w in zip(found, own, strict=True)]
                    missing = None in found
                n_known.append(sum(filter(None, found)) if missing else sum(found))
                hashes.append(text_key(t) if missing else None)
                n_bytes.append(len(t.encode()) if t else 0)
            return keys, n_bytes, n_known, hashes

        return step

    def others() -> Callable:
        pieces = known.value
        seen: set[bytes] = set()

        def step(texts):
            words, hashes, counts = [], [], []
            for t in texts:
                own = Counter(w for w in pre_tokens(t) if w not in pieces and (len(w) <= KEY_CHARS or short_key(w) not in pieces))
                if own and (h := text_key(t)) not in seen:
                    if len(seen) < SEEN:
                        seen.add(h)
                    words += own.keys()
                    hashes += [h] * len(own)
                    counts += own.values()
            return words, hashes, counts

        return step

    def counted() -> Callable:
        count = PieceCounter(path)
        last: list = [None, 0, None]

        def step(words, hashes, counts):
            """Equal pre-tokens follow each other, across batches too, and within one so do copies of a text."""
            new = [w for w, before in zip(words, [last[0], *words], strict=False) if w != before]
            each, keys, out = iter(count(new) if new else []), [], []
            for w, h, n in zip(words, hashes, counts, strict=True):
                if w != last[0]:
                    last[:] = w, next(each), None
                if h != last[2]:
                    last[2] = h
                    keys.append(h)
                    out.append(n * last[1])
            return keys, out

        return step

    rare = map_columns(docs.select(text), others, rest_schema).repartition("pre_token").sortWithinPartitions("pre_token", "text_key")
    found = map_columns(rare, counted, T.StructType([T.StructField("rare_key", T.BinaryType()), T.StructField("rare", T.LongType())]))
    # summed behind the shuffle only: sums in front of it would save less the more tasks there are
    found = written(found.repartition("rare_key").groupBy("rare_key").agg(F.sum("rare").alias("rare")))
    each = written(map_columns(docs.select(key, text), sums, schema))
    total = F.col("known") + F.coalesce("rare", F.lit(0))
    out = joined(each, found.withColumnRenamed("rare_key", "text_key"), "text_key", "left")
    return out.select(key, "n_bytes", total.alias("n_tokens"), (total > limit).alias("over_limit"))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))
