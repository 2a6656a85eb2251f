"""Suffix-array dedup: removes every byte of a string of 200 bytes that also starts anywhere else.

Each 200-byte window of a text belongs to one anchor, the least of the 32-byte hashes in it, so equal
windows have equal anchors wherever they are. The stretch of text that an anchor's windows cover is
its region. Regions whose anchor occurs once hold no repeat; those of one anchor go to one shard, and
a shard's suffix array, by induced sorting, and its permuted common prefixes tell which windows repeat.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracecut.llm.common import check_names, field, joined, map_columns, table, written
from tracecut.llm.suffixes import permuted_common_prefixes, suffix_array

SPAN = 200
ANCHOR = 32
#: Bytes of a text whose anchors are found at once; the next part starts so that no window is lost.
PART = 1 << 19
PLACE = np.uint64((1 << 20) - 1)
#: Bytes of regions that a suffix array takes, if a single anchor has no more.
SHARD = 1_500_000
#: Repeated anchors that are broadcast to find their regions (8 bytes each); more are joined.
BROADCAST_ROWS = 6_000_000
#: Different regions of an anchor that are sorted in one task; the windows of an anchor with more are dealt out by their hash.
HOT = 20_000
#: Spans up to which those of all texts are broadcast (16 bytes each, and 40 a text).
SPANS_ROWS = 300_000
SEEN = 200_000
_BASE = 0x9E3779B97F4A7C15
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base of the rolling hash, and of its inverse, modulo 2**64."""
    if n not in _powers:
        found = []
        for x in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(n, x, np.uint64)
            steps[0] = 1
            found.append(np.cumprod(steps))
        _powers[n] = tuple(found)
    return _powers[n]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> np.uint64(32))


def ranges(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of a text's windows, and the first and last window of each. A shorter text has none."""
    if len(raw) < SPAN:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    found = [_ranges(raw[at : at + PART + SPAN - 1], at) for at in range(0, len(raw) - SPAN + 1, PART)]
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _ranges(raw: np.ndarray, at: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    up, down = (x[: len(raw)] for x in powers(PART + SPAN))
    sums = np.concatenate([[np.uint64(0)], np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up)])
    n = len(raw) - ANCHOR + 1
    hashes = mixed((sums[ANCHOR:] - sums[:-ANCHOR]) * down[:n])
    # of equal hashes the first counts
    least, width, wide = (hashes & ~PLACE) | np.arange(n, dtype=np.uint64), 1, SPAN - ANCHOR + 1
    while width * 2 <= wide:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    count = n - wide + 1
    least = np.minimum(least[:count], least[wide - width : wide - width + count])
    place = (least & PLACE).astype(np.int64)
    first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
    last = np.append(first[1:], count) - 1
    return hashes[place[first]].view(np.int64), first + at, last + at


def repeated(regions: list[bytes]) -> list[list[tuple[int, int]]]:
    """Of each region the unions of windows that also start elsewhere in these regions."""
    sizes = np.array([len(r) for r in regions])
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])
    s = np.frombuffer(b"\0".join(regions) + b"\0", np.uint8).astype(np.uint16) + np.uint16(1)
    s[starts[1:] - 1] = 0
    sa = suffix_array(s, 257)
    common = permuted_common_prefixes(s, sa)
    twice = common >= SPAN
    before = np.flatnonzero(twice[sa[1:]])
    twice[sa[before]] = True
    return [covered(np.flatnonzero(twice[a:b])) for a, b in zip(starts[:-1], starts[1:], strict=True)]


def covered(windows: np.ndarray) -> list[tuple[int, int]]:
    """Unions of windows by their starts in order."""
    if not len(windows):
        return []
    cut = np.flatnonzero(np.diff(windows) > SPAN)
    return list(zip(windows[np.append(0, cut + 1)].tolist(), (windows[np.append(cut, len(windows) - 1)] + SPAN).tolist(), strict=True))


def bytes_of(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode(), np.uint8)


SPANS = T.ArrayType(T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())]))


def anchors(texts: DataFrame) -> DataFrame:
    """anchor, text_key: of all windows of (text, text_key)."""

    def make() -> Callable:
        def step(all_texts, keys):
            found = [ranges(bytes_of(t))[0] for t in all_texts]
            return pa.array(np.concatenate(found)), [k for k, x in zip(keys, found, strict=True) for _ in range(len(x))]

        return step

    schema = T.StructType([T.StructField("anchor", T.LongType()), T.StructField("text_key", T.BinaryType())])
    return map_columns(texts, make, schema)


def anchor_counts(texts: DataFrame) -> DataFrame:
    def make() -> Callable:
        return lambda all_texts: (pa.array(np.concatenate([ranges(bytes_of(t))[0] for t in all_texts])),)

    found = map_columns(texts.select("text"), make, T.StructType([T.StructField("anchor", T.LongType())]))
    return found.groupBy("anchor").count().filter("count > 1").select("anchor")


def regions(texts: DataFrame, known) -> DataFrame:
    """anchor, region (its hash), text_key, start, and raw (its bytes, once a task) of each region whose anchor repeats.

    The anchors are a broadcast, or else those in the column `anchors` of each row.
    """
    schema = T.StructType([T.StructField("anchor", T.LongType()), T.StructField("region", T.BinaryType()), T.StructField("text_key", T.BinaryType()), T.StructField("start", T.LongType()), T.StructField("raw", T.BinaryType())])

    def make() -> Callable:
        everywhere = known.value if known is not None else None
        seen: set[bytes] = set()

        def step(all_texts, keys, *own):
            out: tuple[list, ...] = ([], [], [], [], [])
            for i, (t, key) in enumerate(zip(all_texts, keys, strict=True)):
                raw = (t or "").encode()
                found, first, last = ranges(np.frombuffer(raw, np.uint8))
                if not len(found):
                    continue
                these = everywhere if everywhere is not None else np.sort(np.array(own[0][i] or [], np.int64))
                if not len(these):
                    continue
                at = np.minimum(np.searchsorted(these, found), len(these) - 1)
                for j in np.flatnonzero(these[at] == found).tolist():
                    part = raw[first[j] : last[j] + SPAN]
                    h = xxhash.xxh3_128_digest(part)
                    fresh = h not in seen
                    if fresh and len(seen) < SEEN:
                        seen.add(h)
                    for x, v in zip(out, (int(found[j]), h, key, int(first[j]), part if fresh else None), strict=True):
                        x.append(v)
            return out

        return step

    return map_columns(texts, make, schema)


def sorted_regions(raws: DataFrame) -> DataFrame:
    """anchor, region, spans: a row a region, those of an anchor after each other; anchors fill a shard until it is large enough."""
    schema = T.StructType([T.StructField("anchor", T.LongType()), T.StructField("region", T.BinaryType()), T.StructField("spans", SPANS)])
    target = pa.schema([("anchor", pa.int64()), ("region", pa.binary()), ("spans", pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))])

    def judge(shard: list[tuple], whole: list[tuple]) -> pa.RecordBatch:
        spans = repeated([r[2] for r in shard]) if shard else []
        # a region that occurs twice repeats in all its windows
        rows = [(a, h, [(0, len(raw))] if n > 1 else own) for (a, h, raw, n), own in zip(shard, spans, strict=True) if own or n > 1]
        rows = [(a, h, [{"a": x, "b": y} for x, y in own]) for a, h, own in rows + whole]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], target[i].type) for i in range(3)], schema=target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard: list[tuple] = []
        whole: list[tuple] = []
        group: list[tuple] = []
        size, last = 0, None

        def close():
            nonlocal size
            if len(group) == 1:
                # the only region of its anchor occurs more than once, as the anchor does: there is nothing to sort
                whole.append((group[0][0], group[0][1], [(0, len(group[0][2]))]))
            else:
                shard.extend(group)
                size += sum(len(r[2]) for r in group)

        for batch in batches:
            for anchor, region, n, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if anchor != last:
                    close()
                    group, last = [], anchor
                    if size >= SHARD or len(whole) >= SEEN:
                        yield judge(shard, whole)
                        shard, whole, size = [], [], 0
                group.append((anchor, region, raw, n))
        close()
        if shard or whole:
            yield judge(shard, whole)

    return raws.select("anchor", "region", "n", "raw").mapInArrow(run, schema)


def hashed_windows(raws: DataFrame) -> DataFrame:
    """The same for anchors of very many regions: their windows are dealt out by hash and counted."""
    schema = T.StructType([T.StructField("anchor", T.LongType()), T.StructField("region", T.BinaryType()), T.StructField("n", T.LongType()), T.StructField("at", T.LongType()), T.StructField("window", T.BinaryType())])

    def make() -> Callable:
        def step(found, hashes, counts, all_raw):
            out: tuple[list, ...] = ([], [], [], [], [])
            for a, h, n, raw in zip(found, hashes, counts, all_raw, strict=True):
                for i in range(len(raw) - SPAN + 1):
                    for x, v in zip(out, (a, h, n, i, xxhash.xxh3_128_digest(raw[i : i + SPAN])), strict=True):
                        x.append(v)
            return out

        return step

    each = map_columns(raws.select("anchor", "region", "n", "raw"), make, schema)
    twice = each.groupBy("window").agg(F.sum("n").alias("total")).filter("total > 1").select("window")
    hits = each.join(twice, "window").groupBy("anchor", "region", "at").agg(F.lit(1).alias("one"))
    span = F.struct(F.col("at").alias("a"), (F.col("at") + SPAN).alias("b"))
    return hits.groupBy("anchor", "region").agg(F.array_sort(F.collect_list(span)).alias("spans"))


def repeats(docs: DataFrame, text: str) -> DataFrame:
    """text_key, spans: byte ranges that repeat, of each different text that has any."""
    texts = docs.select(F.col(text).alias("text"), F.unhex(F.md5(F.col(text))).alias("text_key")).filter("text IS NOT NULL")
    common = written(anchor_counts(texts))
    if common.count() <= BROADCAST_ROWS:
        known = docs.sparkSession.sparkContext.broadcast(np.sort(common.toArrow().column(0).to_numpy()))
        found = regions(texts, known)
    else:
        own = anchors(texts).distinct().join(common, "anchor").groupBy("text_key").agg(F.collect_list("anchor").alias("anchors"))
        found = regions(texts.join(own, "text_key").select("text", "text_key", "anchors"), None)
    found = written(found)
    places = written(found.groupBy("text_key", "start", "anchor", "region").agg(F.count(F.lit(1)).alias("n")))
    # a region's bytes come once a task that has it, and leave this once
    each = written(found.groupBy("anchor", "region").agg(F.count(F.lit(1)).alias("n"), F.first("raw", ignorenulls=True).alias("raw")))
    hot = written(each.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).filter(F.col("kinds") > HOT).select("anchor"))
    if hot.isEmpty():
        spans = sorted_regions(each.repartition("anchor").sortWithinPartitions("anchor", "region"))
    else:
        # fewer than a HOT-th of all different regions
        few = hot.count() <= BROADCAST_ROWS
        cool, rest = (each.join(F.broadcast(hot) if few else hot, "anchor", how) for how in ("left_anti", "left_semi"))
        spans = sorted_regions(cool.repartition("anchor").sortWithinPartitions("anchor", "region")).unionByName(hashed_windows(rest))
    spans = written(spans)
    own = joined(places, spans.select("region", "spans"), "region").select("text_key", F.transform("spans", lambda x: F.struct((x["a"] + F.col("start")).alias("a"), (x["b"] + F.col("start")).alias("b"))).alias("spans"))
    return own.groupBy("text_key").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", keep_bytes: bool = False) -> DataFrame:
    """One row a document: its key, n_bytes, n_removed, n_spans, kept_sha256, and with keep_bytes what is left.

    Every byte that lies in a 200-byte string which also starts anywhere else, in the same text or any
    other, copies included, is removed, all occurrences alike; strings are judged on the input. Null
    texts count as empty; texts under 200 bytes lose nothing; repeated rows are copies of each other,
    whatever their keys.
    """
    check_names(key, ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])
    spans = written(repeats(docs, text))
    rows = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text"), F.unhex(F.md5(F.col(text))).alias("text_key"))
    # spans are a list a text, so it is their number that tells whether they may be broadcast
    size = spans.agg(F.coalesce(F.sum(F.size("spans")), F.lit(0))).first()[0]
    rows = joined(rows, spans, "text_key", "left", SPANS_ROWS if size <= SPANS_ROWS else 0).select("__key", "__text", "spans")
    fields = [T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")]
    schema = T.StructType([T.StructField(key, field(docs, key).dataType), *fields, T.StructField("kept_sha256", T.StringType()), *([T.StructField("kept", T.BinaryType())] if keep_bytes else [])])

    def make() -> Callable:
        def step(keys, texts, all_spans):
            out: tuple[list, ...] = ([], [], [], [], [])
            for t, own in zip(texts, all_spans, strict=True):
                raw = (t or "").encode()
                left, at, n = [], 0, 0
                for x in own or []:
                    if x["a"] > at or (not n and x["a"] == 0):
                        n += 1
                        left.append(raw[at : x["a"]])
                    at = max(at, x["b"])
                left.append(raw[at:])
                kept = b"".join(left)
                for x, v in zip(out, (len(raw), len(raw) - len(kept), n, hashlib.sha256(kept).hexdigest(), kept), strict=True):
                    x.append(v)
            return (keys, *out) if keep_bytes else (keys, *out[:4])

        return step

    return map_columns(rows, make, schema)


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))
