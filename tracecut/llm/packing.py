"""Packing: cutting-stock column generation over a histogram of lengths, with patterns filled by ranked documents."""

from __future__ import annotations

import json
import os
import zlib
from array import array
from collections.abc import Callable

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from tracecut.llm.common import check_names, field, map_columns, table, written

LENGTH = 2048
END_ID = 1
#: Lengths are grouped in classes of STEP tokens for the linear program; a piece takes the room of its class's largest length.
STEP = 8
#: The program ends when its value is within this share of a lower bound.
GAP = 5e-4
#: Rests are ranked within so many buckets of their size class first, and then across them: the counts of the buckets, 8 bytes each, are summed on the driver.
BUCKETS = 512
#: Distinct words whose ids a task keeps.
CACHE = 450_000
#: Words that are encoded as one text.
JOINED = 200
#: Characters at which Python's white space and the tokenizer's differ, and the start of its special strings.
ODD = ("\x1c", "\x1d", "\x1e", "\x1f", "<|")
TAIL = ".,;:!?()[]\"%"
#: Above this letters may be other than letters to the tokenizer, or are so once it has normalized them; one below is, too.
LETTERS_END, DOTTED_I = "\u0530", "\u0130"
#: How a tokenizer whose words can be encoded apart normalizes and splits a text.
NORMALIZER = {
    "type": "Sequence",
    "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}],
}
PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}


class WordEncoder:
    """Ids of texts, as little-endian unsigned 32-bit bytes.

    Where the tokenizer drops white space and merges nothing across it, as its file tells, a text's ids
    are those of its words, and each distinct word is encoded once as long as there is room to keep it;
    the frequent ones come first. Texts with special strings, or with characters that only Python takes
    for white space, are encoded whole, and so are all texts by any other tokenizer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        spec = json.loads(self.tokenizer.to_str())
        suffix = spec["model"].get("end_of_word_suffix")
        self.by_word = (spec["normalizer"], spec["pre_tokenizer"]) == (NORMALIZER, PRE_TOKENIZER) and bool(suffix) and all("<|" in x["content"] for x in spec["added_tokens"])
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.ends[[i for w, i in vocabulary.items() if suffix and w.endswith(suffix)]] = True
        self.known: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def letters(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters only. Each is one pre-token, whose last id alone ends a word, so many go as one text."""
        out = []
        parts = [words[i : i + JOINED] for i in range(0, len(words), JOINED)]
        for part, e in zip(parts, self.tokenizer.encode_batch_fast([" ".join(x) for x in parts], add_special_tokens=False), strict=True):
            ids = np.array(e.ids, np.uint32)
            cut = 4 * (np.flatnonzero(self.ends[ids]) + 1)
            if len(cut) != len(part):
                out += self.encode(part)
                continue
            raw, at = ids.tobytes(), 0
            for end in cut.tolist():
                out.append(raw[at:end])
                at = end
        return out

    def fresh(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words that aren't known; letters with marks behind them are the letters' ids and the marks'."""
        stems, tails, plain, ends, rest = [], [], [], [], []
        for w in words:
            stem = w.rstrip(TAIL)
            if not stem.isalpha() or stem[-1] >= LETTERS_END or stem[-1] == DOTTED_I:
                rest.append(w)
            elif len(stem) == len(w):
                plain.append(w)
            else:
                stems.append(w)
                tails.append(w[len(stem) :])
                ends.append(stem)
        new = list(set(tails).difference(self.tails))
        self.tails.update(zip(new, self.encode(new), strict=True))
        out = dict(zip(plain, self.letters(plain), strict=True))
        need = list({s for s in ends if s not in out and s not in self.known})
        own = dict(zip(need, self.letters(need), strict=True))
        for w, tail, stem in zip(stems, tails, ends, strict=True):
            ids = own.get(stem) or out.get(stem) or self.known[stem]
            out[w] = ids + self.tails[tail]
        out.update(zip(rest, self.encode(rest), strict=True))
        return out

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        get, rows, lost, new = self.known.get, [], [], set()
        for k, t in enumerate(texts):
            if t and (not self.by_word or any(x in t for x in ODD)):
                rows.append(self.encode([t]))
                continue
            words = (t or "").split()
            ids = list(map(get, words))
            rows.append(ids)
            at = -1
            for _ in range(ids.count(None)):
                at = ids.index(None, at + 1)
                lost.append((k, at, words[at]))
                new.add(words[at])
        found = self.fresh(list(new))
        for k, at, word in lost:
            rows[k][at] = found[word]
        if len(self.known) < CACHE:
            self.known.update(found)
        if len(self.tails) > CACHE:
            self.tails = {}
        end = array("I", [END_ID]).tobytes()
        return [b"".join(ids) + end for ids in rows]


#: A worker process keeps its encoders from task to task.
_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def lone_lengths(length: int) -> list[int]:
    """Powers of two from an eighth of the full length on: such a piece is a sequence by itself and needs no padding."""
    return [1 << k for k in range(length.bit_length()) if length <= 8 << k and 1 << k < length]


def knapsack(values: np.ndarray, sizes: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of sizes within room, by dynamic programming over room."""
    best, last = np.zeros(room + 1), np.full(room + 1, -1)
    for r in range(1, room + 1):
        fit = np.searchsorted(sizes, r, "right")
        total = values[:fit] + best[r - sizes[:fit]]
        k = int(total.argmax()) if fit else -1
        best[r], last[r] = best[r - 1], -1
        if k >= 0 and total[k] > best[r] + 1e-12:
            best[r], last[r] = total[k], k
    pattern, r = np.zeros(len(sizes), np.int64), room
    while r > 0:
        if last[r] < 0:
            r -= 1
        else:
            pattern[last[r]] += 1
            r -= int(sizes[last[r]])
    return float(best[room]), pattern


def patterns(sizes: np.ndarray, demand: np.ndarray, room: int, rounds: int = 3000) -> list[tuple[np.ndarray, int]]:
    """Patterns (pieces of each size) and how often each is used, so that every demand is met exactly.

    The linear program over the patterns so far is kept as a basis with its inverse; its prices go
    to the knapsack, whose pattern enters, until none is worth more than one sequence. The solution is
    rounded down, and what remains of the demand is packed by first fit, longest first.
    """
    m = len(sizes)
    if not m:
        return []
    basis = np.diag(room // sizes).astype(np.float64)
    inverse = np.diag(1 / (room // sizes).astype(np.float64))
    for turn in range(rounds):
        if turn % 200 == 199:
            inverse = np.linalg.inv(basis)
        prices = np.maximum(inverse.sum(0), 0)
        worth, pattern = knapsack(prices, sizes, room)
        if worth <= 1 + GAP:
            break
        direction, uses = inverse @ pattern, inverse @ demand
        ratio = np.where(direction > 1e-9, uses / np.where(direction > 1e-9, direction, 1), np.inf)
        k = int(ratio.argmin())
        if not np.isfinite(ratio[k]):
            break
        basis[:, k] = pattern
        row = inverse[k] / direction[k]
        inverse -= np.outer(direction, row)
        inverse[k] = row
    uses = np.floor(np.linalg.solve(basis, demand) + 1e-9).clip(0).astype(np.int64)
    columns = basis.round().astype(np.int64)
    out, left = [], demand.astype(np.int64).copy()
    for k in range(m):
        n = int(uses[k])
        own = columns[:, k]
        if own.any():
            n = min(n, int((left[own > 0] // own[own > 0]).min()))
            if n:
                out.append((own, n))
                left -= n * own
    while left.any():
        # the same first fit for as many sequences as the remaining demand allows
        own, space = np.zeros(m, np.int64), room
        for k in range(m - 1, -1, -1):
            own[k] = min(int(left[k]), space // int(sizes[k]))
            space -= int(own[k] * sizes[k])
        n = int((left[own > 0] // own[own > 0]).min())
        out.append((own, n))
        left -= n * own
    return out


def slots(sizes: np.ndarray, packed: list[tuple[np.ndarray, int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(size class, first rank and the one behind the last, pieces a sequence, first sequence, position) of each pattern's share of a class."""
    out, rank, sequence = [], np.zeros(len(sizes), np.int64), 0
    for own, n in packed:
        for position, k in enumerate(np.flatnonzero(own)):
            start = int(rank[k])
            rank[k] += int(own[k]) * n
            out.append((int(sizes[k]), start, int(rank[k]), int(own[k]), sequence, position))
        sequence += n
    return out


def pieces_of(docs: DataFrame, key: str, text: str, path: str, length: int) -> DataFrame:
    """A row a document: its ids' number, the checksums of its full pieces and of the rest, and a hash to rank it by."""
    fields = [T.StructField("n", T.LongType()), T.StructField("full", T.ArrayType(T.LongType())), T.StructField("rest", T.LongType())]
    schema = T.StructType([T.StructField("key", field(docs, key).dataType), *fields])

    def make() -> Callable:
        encode = encoder(path)

        def step(keys, texts):
            n, full, rest = [], [], []
            for i in range(0, len(texts), 256):
                for raw in encode(texts[i : i + 256]):
                    size = len(raw) // 4
                    cut = size // length * length
                    n.append(size)
                    full.append([zlib.crc32(raw[4 * a : 4 * (a + length)]) for a in range(0, cut, length)])
                    rest.append(zlib.crc32(raw[4 * cut :]) if cut < size else None)
            return keys, n, full, rest

        return step

    return map_columns(docs.select(key, text), make, schema)


def ranked_buckets(spark: SparkSession, rests: DataFrame) -> tuple[dict[int, int], DataFrame]:
    """Pieces of each size class, and of each bucket of one how many come before it there: BUCKETS rows a class, however long the table."""
    counts = rests.groupBy("size", "bucket").count().toPandas().sort_values(["size", "bucket"])
    each = counts.groupby("size")["count"]
    first = counts.assign(first=each.cumsum() - counts["count"])[["size", "bucket", "first"]]
    return {int(k): int(n) for k, n in each.sum().items()}, spark.createDataFrame(first, "size int, bucket int, first long")


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str | None = None, length: int = LENGTH, step: int = STEP) -> DataFrame:
    """One row a piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's ids, with END_ID behind them, are cut into full pieces, each a sequence of its own,
    and a rest. A rest whose length is a power of two is a sequence by itself, as it needs no padding;
    the others are packed by patterns from a linear program over the histogram of their lengths in
    classes of `step` tokens. Within a class documents are ranked by bucket, and a rank's slot gives
    the sequence. Packed sequences are numbered from 0 without gaps, those of one piece behind them with gaps. Null and empty texts are the end id alone; rows with equal or null keys are packed
    each for itself; an empty table gives an empty one.
    """
    check_names(key, ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
    spark = docs.sparkSession
    path = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    ready = pieces_of(docs, key, text, path, length)
    # the id differs for equal rows too; it is read from the written table only, so it stays what it was
    ready = written(ready.withColumn("bucket", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(BUCKETS)).cast("int")))
    tail = F.pmod(F.col("n"), F.lit(length))
    alone = F.coalesce(F.array_contains(F.array(*(F.lit(x) for x in lone_lengths(length))).cast("array<bigint>"), tail), F.lit(False))
    rests = ready.filter((tail > 0) & ~alone).select("key", "n", "bucket", F.col("rest").alias("crc"), tail.alias("length"))
    rests = rests.withColumn("size", F.least(F.ceil(F.col("length") / step), F.lit(length // step)).cast("int"))
    histogram, firsts = ranked_buckets(spark, rests)
    sizes = np.array(sorted(histogram), np.int64)
    packed = patterns(sizes, np.array([histogram[s] for s in sizes], np.float64), length // step)
    plan = spark.createDataFrame(slots(sizes, packed), "size int, from_rank long, to_rank long, per_sequence int, first_sequence long, position int")

    own = Window.partitionBy("size", "bucket").orderBy("n", "key", "crc")
    ranked = rests.withColumn("rank", F.row_number().over(own) - 1).join(F.broadcast(firsts), ["size", "bucket"])
    rank = F.col("rank") + F.col("first")
    placed = ranked.withColumn("rank", rank).join(F.broadcast(plan), "size").filter("rank >= from_rank AND rank < to_rank")
    nth = F.col("rank") - F.col("from_rank")
    placed = placed.withColumn("sequence_id", F.col("first_sequence") + F.floor(nth / F.col("per_sequence"))).withColumn("place", F.pmod(nth, F.col("per_sequence")))
    before = Window.partitionBy("sequence_id").orderBy("position", "place").rowsBetween(Window.unboundedPreceding, -1)
    tails = placed.select("key", (F.col("n") - F.col("length")).alias("start"), "length", "crc", "n", "sequence_id", F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset"))

    cut = F.when((tail > 0) & alone, F.array_append("full", F.col("rest"))).otherwise(F.col("full"))
    whole = ready.select("key", "n", F.posexplode(cut).alias("i", "crc")).withColumn("start", F.col("i").cast("long") * length)
    # these need no rank: their ids only have to differ, and the written table's rows keep their places
    own_id = F.monotonically_increasing_id() + sum(n for _, n in packed)
    whole = whole.select("key", "start", F.least(F.col("n") - F.col("start"), F.lit(length)).alias("length"), "crc", "n", own_id.alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    out = tails.unionByName(whole)
    return out.select(F.col("key").alias(key), "start", "length", F.col("crc").alias("ids_crc32"), F.col("n").alias("doc_tokens"), "sequence_id", "offset")


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
