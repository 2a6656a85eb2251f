"""N-gram Jaccard join: an LSH forest of MinHash signatures finds candidates, exact shingle sets decide.

Each tree of the forest is a prefix trie of signatures, kept as sorted rows: its branches from a depth
on at which pairs at the threshold meet for certain, nearly, and for each row the values below. Matches
are sought at the longest prefix first. What matches is verified; from the similarities of the links
found so far follows the share of all links that this depth finds, and prefixes are shortened by a
value until that share reaches the target.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from fractions import Fraction
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracecut.llm.common import BROADCAST_ROWS, check_names, field, hand_back, joined, map_columns, table, written
from tracecut.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
WORDS = 5
THRESHOLD = 0.8
#: Trees, how many values a prefix has at the most beyond the depth at which it starts, and the bits of each of these.
TREES = 32
LEVELS = 3
BITS = 16
#: Share of all links that the forest must find.
RECALL = 0.99999
#: Links are counted by similarity in so many bins from the threshold to 1.
BINS = 20
#: Texts and shingles that a verification task takes from one block; larger groups are dealt out in pairs of blocks.
BLOCK_TEXTS = 1_000
BLOCK_SHINGLES = 2_000_000
#: Groups up to this size are verified whole; larger ones only if no more pairs are in them than in their prefixes.
WHOLE_TEXTS = 64
#: Copies of a text that a task knows it has handed on, and words whose hash it keeps.
SEEN = 100_000
KNOWN = 150_000
MASK = 2**64 - 1


def reach(similarity: np.ndarray | float, depth: int, trees: int = TREES):
    """The share of pairs of this similarity whose signatures have a common prefix of this depth in some tree."""
    return 1 - (1 - similarity**depth) ** trees


def root_depth(threshold: float = THRESHOLD, trees: int = TREES, recall: float = RECALL) -> int:
    """The shortest prefix that is ever needed: the longest at which pairs at the threshold themselves meet the target recall."""
    d = 1
    while reach(threshold, d + 1, trees) >= recall and d < 64:
        d += 1
    return d


def found_share(links: np.ndarray, depth: int, threshold: float) -> float:
    """The share of all links that this depth finds, by the similarities (counts by bin) of those found.

    Each link found stands for 1/reach links; bins count with their least similarity, and one link more
    is assumed at the threshold.
    """
    least = np.append(threshold + (1 - threshold) * np.arange(len(links)) / len(links), threshold)
    n = np.append(links, 0).astype(np.float64)
    p = reach(least, depth)
    n[-1] = p[-1]
    return float(n.sum() / (n / p).sum())


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Shingler:
    """Sorted distinct 64-bit hashes of a text's WORDS-word shingles; a shorter text is one shingle, one without words has none."""

    def __init__(self, words: int = WORDS):
        self.words = words
        self.known: dict[str, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        own = WORD.findall(text) if text else []
        if not own:
            return np.zeros(0, np.uint64)
        if len(self.known) > KNOWN:
            self.known = {}
        known = self.known
        for w in own:
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w.encode())
        h = np.fromiter(map(known.__getitem__, own), np.uint64, len(own))
        k = min(self.words, len(h))
        out = np.full(len(h) - k + 1, k, np.uint64)
        for j in range(k):
            out = out * np.uint64(0x9E3779B97F4A7C15) + h[j : len(h) - k + 1 + j]
        return np.unique(mixed(out))


def tree_rows(shingles: np.ndarray, root: int, a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each tree the key of its prefix of `root` values, with the tree's number, and the LEVELS values behind it, BITS of each."""
    least = np.empty(len(a), np.uint64)
    step = max(1, 200_000 // max(1, len(shingles)))
    for i in range(0, len(a), step):
        part = a[i : i + step]
        least[i : i + step] = ((shingles[:, None] * part[None, :]) >> np.uint64(16)).min(0)
    least = least.reshape(TREES, root + LEVELS)
    keys = np.arange(1, TREES + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for j in range(root):
        keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + least[:, j])
    tails = np.zeros(TREES, np.uint64)
    for j in range(root, root + LEVELS):
        tails = (tails << np.uint64(BITS)) | (mixed(least[:, j]) & np.uint64((1 << BITS) - 1))
    return keys.view(np.int64), tails.view(np.int64)


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(text))


def members_of(docs: DataFrame, key: str, text: str, words: int, root: int) -> DataFrame:
    """A row a document: key, the hash of its shingle set (null without words), the set's size, the text's hash, and its rows in the trees."""
    longs = T.ArrayType(T.LongType())
    schema = T.StructType([T.StructField("key", field(docs, key).dataType), T.StructField("text_key", T.BinaryType()), T.StructField("set_key", T.BinaryType()), T.StructField("n", T.LongType()), T.StructField("roots", longs), T.StructField("tails", longs)])

    def make() -> Callable:
        shingles = Shingler(words)
        a = np.random.default_rng(29).integers(0, MASK, TREES * (root + LEVELS), np.uint64) | np.uint64(1)

        def step(keys, texts, hashes):
            out: tuple[list, ...] = ([], [], [], [])
            done: dict = {}
            for t, h in zip(texts, hashes, strict=True):
                if h not in done:
                    own = shingles(t)
                    done[h] = (xxhash.xxh3_128_digest(own.tobytes()), len(own), *tree_rows(own, root, a)) if len(own) else (None, 0, None, None)
                for x, v in zip(out, done[h], strict=True):
                    x.append(v)
            return keys, hashes, *out

        return step

    return map_columns(docs.select(key, text, text_key(F.col(text))), make, schema)


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Shingles that each two of the sets share: by products where many sets hold a shingle, by pairs where few do."""
    m = len(sets)
    out = np.zeros((m, m), np.float64)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    _, column, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.argsort(column, kind="stable")
    owner, held = owner[order], held[held > 0]
    starts = np.cumsum(np.append(0, held[:-1]))
    many = np.flatnonzero(held > 32)
    for i in range(0, len(many), 2048):
        part = many[i : i + 2048]
        x = np.zeros((m, len(part)), np.float32)
        for j, c in enumerate(part):
            x[owner[starts[c] : starts[c] + held[c]], j] = 1
        out += x @ x.T
    for k in range(2, 33):
        few = starts[held == k]
        for i in range(0, len(few), 20_000):
            rows = owner[few[i : i + 20_000, None] + np.arange(k)[None, :]]
            flat = (rows[:, :, None] * m + rows[:, None, :]).ravel()
            out += np.bincount(flat, minlength=m * m).reshape(m, m) if len(flat) * 4 > m * m else sparse(flat, m)
    return out


def sparse(flat: np.ndarray, m: int) -> np.ndarray:
    out = np.zeros(m * m, np.float32)
    where, n = np.unique(flat, return_counts=True)
    out[where] = n
    return out.reshape(m, m)


def near_pairs(shared: np.ndarray, sizes: np.ndarray, threshold: float) -> np.ndarray:
    """Which two sets reach the threshold, decided in whole numbers."""
    part = Fraction(threshold).limit_denominator(1_000_000)
    near = shared * (part.numerator + part.denominator) >= part.numerator * (sizes[:, None] + sizes[None, :])
    np.fill_diagonal(near, False)
    return near


def linked(sets: list[np.ndarray], block: np.ndarray, own: bool, threshold: float) -> np.ndarray:
    """Which two sets reach the threshold; of a pair of blocks (own is false) only across them."""
    near = near_pairs(shared_counts(sets), np.array([len(s) for s in sets], np.float64), threshold)
    return near if own else near & (block[:, None] != block[None, :])


def roots(near: np.ndarray) -> np.ndarray:
    """The least index that each index is connected with."""
    root = np.full(len(near), -1)
    for i in range(len(near)):
        if root[i] < 0:
            edge = np.zeros(len(near), bool)
            edge[i] = True
            while edge.any():
                root[edge] = i
                edge = near[edge].any(0) & (root < 0)
    return root


CHECKED = T.StructType([T.StructField("node", T.LongType()), T.StructField("links", T.LongType()), T.StructField("parent", T.LongType()), T.StructField("bins", T.ArrayType(T.LongType()))])


def verified(tasks: DataFrame, threshold: float) -> DataFrame:
    """node, links (documents linked by this task), parent (a node it is connected with here), and on one row of each task its links by similarity.

    Rows of a task follow each other, and one task at a time is held. A pair is left out that an earlier
    depth verified (`old` is equal), that another pair of blocks has (`own` is false, and the blocks are
    equal), or that an earlier tree has (`trees` are the prefixes of the node, `tree` is the task's).
    """
    target = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("parent", pa.int64()), ("bins", pa.list_(pa.int64()))])

    def judge(rows: dict[int, tuple]) -> pa.RecordBatch:
        nodes = sorted(rows)
        raw, weight, block, old, own, tree, trees = (list(x) for x in zip(*(rows[x] for x in nodes), strict=True))
        sets = [np.frombuffer(x, np.uint64) for x in raw]
        sizes = np.array([len(x) for x in sets], np.float64)
        shared = shared_counts(sets)
        near = near_pairs(shared, sizes, threshold)
        for x, differ in ((np.array(old), True), (np.array(block), not own[0])):
            if differ:
                near &= x[:, None] != x[None, :]
        if tree[0] is not None:
            each = np.array(trees, np.int64)
            for t in range(tree[0]):
                near &= each[:, None, t] != each[None, :, t]
        links = near @ np.array(weight)
        at = np.flatnonzero(links)
        if not len(at):
            return pa.RecordBatch.from_pylist([], schema=target)
        i, j = np.nonzero(np.triu(near))
        part = (shared[i, j] / (sizes[i] + sizes[j] - shared[i, j]) - threshold) / max(1 - threshold, 1e-9)
        bins = np.bincount(np.clip((part * BINS + 1e-9).astype(np.int64), 0, BINS - 1), minlength=BINS).tolist()
        above = roots(near)
        columns = [[nodes[k] for k in at], links[at].tolist(), [nodes[above[k]] for k in at], [bins] + [None] * (len(at) - 1)]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, target, strict=True)], schema=target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, rows = None, {}
        for batch in batches:
            for task, node, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if task != last:
                    if len(rows) > 1:
                        yield judge(rows)
                    last, rows = task, {}
                rows[node] = row
        if len(rows) > 1:
            yield judge(rows)
        rows = {}
        hand_back()

    return tasks.select("task", "node", "raw", "weight", "block", "old", "own", "tree", "trees").mapInArrow(run, CHECKED)


def first_copies(docs: DataFrame, text: str) -> DataFrame:
    """text, text_key: a text once a task, as far as the task remembers, so that no text of very many copies is all dealt out."""
    schema = T.StructType([T.StructField("text", T.StringType()), T.StructField("text_key", T.BinaryType())])

    def make() -> Callable:
        seen: set[bytes] = set()

        def step(texts, keys):
            take = []
            for i, k in enumerate(keys):
                if k is not None and k not in seen:
                    if len(seen) < SEEN:
                        seen.add(k)
                    take.append(i)
            return [texts[i] for i in take], [keys[i] for i in take]

        return step

    return map_columns(docs.select(F.col(text).alias("text"), text_key(F.col(text)).alias("text_key")), make, schema)


def shingle_sets(docs: DataFrame, text: str, wanted: DataFrame, words: int) -> DataFrame:
    """node, raw: the shingle set of each wanted (node, text_key), once or, from several tasks, a few times."""
    schema = T.StructType([T.StructField("node", T.LongType()), T.StructField("raw", T.BinaryType())])

    def make() -> Callable:
        shingles = Shingler(words)
        seen: set[int] = set()

        def step(nodes, texts):
            take, raw = [], []
            for node, t in zip(nodes, texts, strict=True):
                if node not in seen:
                    if len(seen) < SEEN:
                        seen.add(node)
                    take.append(node)
                    raw.append(shingles(t).tobytes())
            return take, raw

        return step

    return map_columns(joined(first_copies(docs, text), wanted, "text_key").select("node", "text"), make, schema)


def trie(classes: DataFrame) -> DataFrame:
    """root, tail, node: the rows of all trees, in order, but those whose branch holds no other node."""
    rows = classes.select("node", F.explode(F.arrays_zip("roots", "tails")).alias("x")).select("node", F.col("x.roots").alias("root"), F.col("x.tails").alias("tail"))
    shared = written(rows.groupBy("root").agg(F.min("node").alias("least"), F.max("node").alias("most")).filter("least <> most").select("root"))
    return written(joined(rows, shared, "root").repartitionByRange("root", "tail", "node").sortWithinPartitions("root", "tail", "node"))


def prefixes(rows: DataFrame, depth: int, root: int) -> DataFrame:
    """rows of the trie with `prefix`, the key of their prefix of this depth."""
    cut = BITS * (root + LEVELS - depth)
    return rows.withColumn("prefix", F.xxhash64("root", F.shiftrightunsigned("tail", cut)))


def tasks_at(depth: int, root: int, rows: DataFrame, info: DataFrame, classes: DataFrame) -> DataFrame:
    """The tasks that verify what a depth connects: task, node, weight, block, old, own, tree, trees.

    info: node, comp (connected at this depth), old (connected before), weight, n. A component goes whole,
    in pairs of blocks, if it is small or no more pairs are in it than in its prefixes; of any other only
    nodes with a common prefix meet, and the first of equal prefixes serves for all of them.
    """
    totals = info.groupBy("comp").agg(F.count(F.lit(1)).alias("texts"), F.sum("n").alias("shingles"))
    large = written(totals.filter(F.col("texts") > WHOLE_TEXTS))
    whole = info.withColumn("tree", F.lit(None).cast("int")).withColumn("trees", F.lit(None).cast("array<bigint>")).withColumn("group", F.col("comp").cast("string"))
    groups = totals.withColumn("group", F.col("comp").cast("string")).select("group", "texts", "shingles")
    apart = None
    if not large.isEmpty():
        inside = joined(info.select("node", "comp", "n"), large.select("comp", F.col("texts").alias("of")), "comp").select("node", "comp", "n")
        own = joined(prefixes(rows, depth, root), written(inside), "node")
        each = own.groupBy("prefix").agg(F.first("comp").alias("comp"), F.count(F.lit(1)).alias("texts"), F.sum("n").alias("shingles"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("nodes"))
        each = each.filter("texts > 1").withColumn("tree", F.lit(None).cast("int"))
        pairs = each.groupBy("comp").agg(F.sum(F.col("texts").cast("double") * F.col("texts")).alias("pairs"))
        apart = written(large.join(pairs, "comp").filter(F.col("texts").cast("double") * F.col("texts") > F.col("pairs")).select("comp"))
        apart = None if apart.isEmpty() else apart
    if apart is not None:
        keep = whole.join(F.broadcast(apart) if apart.count() <= 500_000 else apart, "comp", "left_anti")
        loose = joined(info, apart.withColumn("loose", F.lit(True)), "comp").drop("loose")
        cut = BITS * (root + LEVELS - depth)
        keys = classes.select("node", F.transform(F.arrays_zip("roots", "tails"), lambda x: F.xxhash64(x["roots"], F.shiftrightunsigned(x["tails"], cut))).alias("trees"))
        loose = written(joined(keys, written(loose), "node"))
        each = loose.select("*", F.posexplode("trees").alias("tree", "prefix"))
        sets = each.groupBy("prefix").agg(F.first("tree").alias("tree"), F.count(F.lit(1)).alias("texts"), F.sum("n").alias("shingles"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("nodes"), F.min("node").alias("least"))
        first = sets.filter("texts > 1").groupBy("texts", "nodes", "least").agg(F.min(F.struct("tree", "prefix", "shingles")).alias("x"))
        chosen = written(first.select("x.prefix", "texts", "x.shingles"))
        some = joined(each, chosen.select("prefix", F.lit(1).alias("one")), "prefix").withColumn("group", F.concat(F.lit("p"), F.col("prefix").cast("string")))
        whole = keep.select("node", "group", "weight", "old", "tree", "trees").unionByName(some.select("node", "group", "weight", "old", "tree", "trees"))
        groups = groups.unionByName(chosen.select(F.concat(F.lit("p"), F.col("prefix").cast("string")).alias("group"), "texts", "shingles"))
    blocks = groups.select("group", F.greatest(F.ceil(F.col("texts") / BLOCK_TEXTS), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    dealt = joined(written(whole.select("node", "group", "weight", "old", "tree", "trees")), written(blocks), "group")
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    # each text goes to the pairs of its block with every block, its own included
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("block", "other"), F.greatest("block", "other")
    return dealt.select(F.concat_ws(":", "group", low, high).alias("task"), "node", "weight", "block", "old", (low == high).alias("own"), "tree", "trees")


def links_of(docs: DataFrame, text: str, classes: DataFrame, words: int, threshold: float) -> list[DataFrame]:
    """The verified links, a table a depth: from the longest prefixes down to where the links found tell that enough are."""
    root = root_depth(threshold)
    rows = trie(classes)
    nodes = written(rows.select("node").distinct())
    known = written(joined(classes.select("node", "weight", "n", "text_key"), nodes, "node"))
    sets = written(shingle_sets(docs, text, known.select("text_key", "node"), words).dropDuplicates(["node"]))
    state = known.select("node", F.col("node").alias("comp"))
    out: list[DataFrame] = []
    links = np.zeros(BINS, np.int64)
    for depth in range(root + LEVELS, root - 1, -1):
        own = written(joined(prefixes(rows, depth, root), state, "node").select("prefix", "comp").distinct())
        leads = written(own.groupBy("prefix").agg(F.min("comp").alias("lead"), F.max("comp").alias("most")).filter("lead <> most").select("prefix", "lead"))
        # a depth that connects nothing new has nothing to verify
        if not leads.isEmpty():
            edges = joined(own, leads, "prefix").filter("comp <> lead").select("comp", "lead")
            merged = written(components(edges, "comp", "lead").select(F.col("node").alias("comp"), F.col("comp").alias("new")))
            info = joined(state, merged, "comp").select("node", F.col("comp").alias("old"), F.col("new").alias("comp"))
            info = written(joined(known.select("node", "weight", "n"), written(info), "node"))
            tasks = joined(tasks_at(depth, root, rows, info, classes), sets, "node", broadcast_rows=0)
            found = written(verified(tasks.repartition("task").sortWithinPartitions("task"), threshold))
            out.append(found.select("node", "links", "parent"))
            sums = found.select([F.sum(F.get("bins", F.lit(i))).alias(f"b{i}") for i in range(BINS)]).first()
            links += np.array([x or 0 for x in sums])
            state = written(joined(state, merged, "comp", "left").select("node", F.coalesce("new", "comp").alias("comp")))
        if found_share(links, depth, threshold) >= RECALL:
            break
    return out


def join_similar(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, threshold: float = THRESHOLD) -> DataFrame:
    """One row a document: its key, class_id, copy_id, n_links.

    Two texts are linked if the Jaccard similarity of their sets of five-word shingles reaches the
    threshold. n_links counts the other documents linked with a document, copies included; class_id is
    the least key of all that links connect; copy_id that of the documents with the same set.

    Copies are one class first, told apart by 128 bits of their sets. The forest connects classes, and
    what is connected is verified exactly, by tasks of bounded blocks that emit counts and a spanning
    forest, not pairs. Null and empty texts, and others without words, have no links and no class but
    their own key; texts of fewer words than a shingle are one shingle. Null keys count in n_links and
    never give a class its name.
    """
    check_names(key, ["class_id", "copy_id", "n_links"])
    members = written(members_of(docs, key, text, words, root_depth(threshold)))
    classes = members.filter("set_key IS NOT NULL").groupBy("set_key").agg(F.count(F.lit(1)).alias("weight"), F.min("key").alias("copy_id"), F.min("text_key").alias("text_key"), F.first("n").alias("n"), F.first("roots").alias("roots"), F.first("tails").alias("tails"))
    classes = written(classes.withColumn("node", F.monotonically_increasing_id()))
    found = links_of(docs, text, classes, words, threshold)
    named = classes.select("set_key", "node", "copy_id", F.col("weight").alias("copies"))
    if found:
        checked = written(reduce(DataFrame.unionByName, found))
        links = written(checked.groupBy("node").agg(F.sum("links").alias("links")))
        group = written(components(checked, "node", "parent"))
        named = joined(joined(named, links, "node", "left"), group, "node", "left")
    else:
        named = named.withColumns({"links": F.lit(None).cast("long"), "comp": F.lit(None).cast("long")})
    named = written(named.select("set_key", "copy_id", F.coalesce("comp", "node").alias("comp"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    first = written(named.groupBy("comp").agg(F.min("copy_id").alias("class_id")))
    named = written(joined(named, first, "comp").drop("comp"))
    out = joined(members.select("key", "set_key"), named, "set_key", "left")
    return out.select(F.col("key").alias(key), F.coalesce("class_id", "key").alias("class_id"), F.coalesce("copy_id", "key").alias("copy_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def one_of_each(docs: DataFrame, columns: list[str], text: str = "text") -> DataFrame:
    """The first document of each class that `join_similar` finds, with these columns.

    Documents without words, null texts among them, all stay; of equal rows one does. An empty table gives an empty one.
    """
    row = "__row"
    while row in columns:
        row += "_"
    rows = written(docs.select(*columns, F.monotonically_increasing_id().alias(row)))
    gone = written(join_similar(rows, row, text).filter(F.col("class_id") != F.col(row)).select(row))
    few = gone.count() <= BROADCAST_ROWS
    return rows.join(F.broadcast(gone) if few else gone, row, "left_anti").select(*columns)


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_similar(table(spark, sf_dir, "documents"))


def sql() -> str:
    """Exact pairs by shared shingles, and components by a recursive query."""
    return rf"""
    WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM documents WHERE text IS NOT NULL),
    s AS (SELECT DISTINCT doc_id, unnest([ws[i:i + {WORDS - 1}] FOR i IN range(1, greatest(len(ws) - {WORDS - 1}, 1) + 1)]) AS g FROM w WHERE len(ws) > 0),
    sets AS (SELECT doc_id, count(*) AS n, md5(string_agg(g::VARCHAR, '|' ORDER BY g::VARCHAR)) AS h FROM s GROUP BY doc_id),
    reps AS (SELECT h, min(doc_id) AS r, any_value(n) AS n, count(*) AS weight FROM sets GROUP BY h),
    rs AS MATERIALIZED (SELECT r, n, g FROM reps JOIN s ON s.doc_id = r),
    links AS MATERIALIZED (SELECT a.r AS a, b.r AS b FROM rs a JOIN rs b ON a.g = b.g AND a.r <> b.r GROUP BY a.r, b.r, a.n, b.n HAVING count(*) * 9 >= 4 * (a.n + b.n)),
    walk AS (SELECT r AS node, r AS seen FROM reps UNION SELECT links.b, seen FROM walk JOIN links ON links.a = node),
    comp AS (SELECT node, min(seen) AS class_id FROM walk GROUP BY node),
    counts AS (SELECT a, sum(weight) AS links FROM links JOIN reps ON r = b GROUP BY a)
    SELECT d.doc_id, coalesce(class_id, d.doc_id) AS class_id, coalesce(reps.r, d.doc_id) AS copy_id, coalesce(weight - 1 + coalesce(links, 0), 0)::BIGINT AS n_links
    FROM documents d LEFT JOIN sets USING (doc_id) LEFT JOIN reps USING (h) LEFT JOIN comp ON node = reps.r LEFT JOIN counts ON a = reps.r"""
