"""Quality rules: base counts, and the Jensen-Shannon distance of character-class and common-word histograms from language references.

DataFrame functions only; no Python runs on the executors.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tracecut.llm.common import check_names, table, written

SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
#: Character classes by pattern, in code points; a last class holds all others.
CLASSES = (r"\p{Ll}+", r"\p{Lu}+", r"\p{Nd}+", r"[\x20\x09-\x0D]+", r"[.,;:!?'\"()-]+")
#: Common words of a language: the COMMON that most of its documents hold twice or more, one in a hundred at least.
COMMON = 24
COMMON_SHARE = 0.01
#: Distances (0 to 1) above which a document is unlike a language, and the least length for which each counts.
CLASS_LIMIT, CLASS_CHARS = 0.265, 200
WORD_LIMIT, WORD_WORDS = 0.38, 100
MIN_WORDS = 50


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACES), "")


def repeated_words(words: Column, grams: Column) -> Column:
    """Words in three-word windows that a text holds twice or more; windows are equal by a 64-bit hash of their words."""
    tagged = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(grams)) == F.size(grams), F.array().cast("array<struct<g:bigint,i:int>>")).otherwise(tagged)


def counted(docs: DataFrame, key: Column, text: str, lang: str) -> DataFrame:
    """The key and the base counts, with the tokens and classes that the method needs."""
    t = F.coalesce(F.col(text), F.lit(""))
    df = docs.select(key.alias("key"), F.col(lang).alias("lang"), t.alias("text")).withColumn("words", words_of(F.col("text")))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    hashes = F.transform(F.sequence(F.lit(0), F.size("words") - 3), lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)))
    # most of a text is small letters and white space: what is left is short, and the other classes are counted there
    df = df.withColumn("rest", F.regexp_replace("text", r"[\p{Ll}\x20\x09-\x0D]+", "")).withColumn("word_chars", F.length(F.array_join("words", "")))
    small = F.col("word_chars") - F.length("rest")
    others = [F.length("rest") - F.length(F.regexp_replace("rest", c, "")) for c in (CLASSES[1], CLASSES[2], CLASSES[4])]
    df = df.select(
        "key", "lang", "words",
        F.length("text").alias("n_chars"),
        F.col("word_chars").cast("long").alias("word_chars"),
        (F.length("rest") - F.length(F.translate("rest", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        lines.alias("lines"),
        F.array(small, others[0], others[1], F.length("text") - F.col("word_chars"), others[2]).alias("classes"),
        F.array_remove(F.split(F.lower("text"), r"[^\p{L}\p{Nd}]+"), "").alias("tokens"),
        F.when(F.size("words") > 3, hashes).otherwise(F.array().cast("array<bigint>")).alias("grams"),
    )
    df = df.withColumn("sorted", repeated_words(F.col("words"), F.col("grams")))
    s = F.col("sorted")
    twice = F.filter(s, lambda x, j: (F.get(s, j - 1)["g"] == x["g"]) | F.coalesce(F.get(s, j + 1)["g"] == x["g"], F.lit(False)))
    covered = F.array_distinct(F.flatten(F.transform(twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))))
    return df.select(
        "key", "lang", "n_chars", "tokens", "classes",
        F.size("words").cast("long").alias("n_words"), "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(covered).cast("long").alias("n_repeat_words"),
    )


def common_words(docs: DataFrame, text: str, lang: str) -> dict[str, list[str]]:
    """The common words of every language; COMMON of each at most reach the driver."""
    known = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    sizes = {r[0]: r[1] for r in known.groupBy("lang").count().collect()}
    if not sizes:
        return {}
    tokens = known.select("lang", F.sort_array(F.split(F.lower("text"), r"[^\p{L}\p{Nd}]+")).alias("s"))
    s = F.col("s")
    twice = tokens.select("lang", F.explode(F.array_distinct(F.filter(s, lambda x, i: (i > 0) & (F.get(s, i - 1) == x)))).alias("word"))
    share = docs.sparkSession.createDataFrame([(k, n * COMMON_SHARE) for k, n in sizes.items()], "lang string, least double")
    often = twice.filter("word <> ''").groupBy("lang", "word").count().join(F.broadcast(share), "lang").filter(F.col("count") >= F.col("least"))
    best = Window.partitionBy("lang").orderBy(F.desc("count"), "word")
    out: dict[str, list[str]] = {k: [] for k in sizes}
    for r in often.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= COMMON).orderBy("lang", "rank").collect():
        out[r.lang].append(r.word)
    return dict(sorted(out.items()))


def references(features: DataFrame, common: dict[str, list[str]]) -> dict[str, tuple[list[float], list[float]]]:
    """Class and common-word histograms of each language, over all its documents that pass the base rules."""
    base = features.filter(~F.col("base_failed") & F.col("lang").isNotNull())
    n = len(CLASSES)
    sums = base.groupBy("lang").agg(F.sum("n_chars").alias("chars"), F.sum("n_tokens").alias("tokens"), *(F.sum(F.col("classes")[i]).alias(f"c{i}") for i in range(n)))
    words = base.select("lang", F.explode("common").alias("x")).groupBy("lang", "x.w").agg(F.sum("x.n").alias("n"))
    per_word = {(r[0], r[1]): r[2] for r in words.collect()}
    out = {}
    for r in sums.collect():
        classes = [r[f"c{i}"] for i in range(n)]
        own = [per_word.get((r.lang, w), 0) for w in common[r.lang]]
        out[r.lang] = (shares(classes, r.chars), shares(own, r.tokens))
    return out


def shares(counts: list[int], total: int) -> list[float]:
    """Each count's share, and that of the rest; all zero for a total of 0."""
    return [c / total if total else 0.0 for c in [*counts, total - sum(counts)]]


def constant(value: list, schema: str) -> Column:
    """A value of any size as one literal, which the optimizer reads once from its JSON."""
    return F.from_json(F.lit(json.dumps(value)), schema)


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of an array of shares from a histogram, 0 to 1."""

    def term(a: Column, b: Column) -> Column:
        m = (a + b) / 2
        return F.when(a > 0, a * F.log2(a / m)).otherwise(0.0) + F.when(b > 0, b * F.log2(b / m)).otherwise(0.0)

    terms = F.zip_with(p, q, term)
    return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda x, y: x + y) / 2, F.lit(0.0)))


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """One row a document: its key, the base counts, base_failed, kept, and the least distances from a language.

    A document is kept if it passes the base rules and some language's references are near enough: the
    character classes where it has CLASS_CHARS characters, and the common words where it has WORD_WORDS
    words; shorter ones pass. Without any reference the base rules alone decide. Null texts count as
    empty, null languages give no reference, repeated rows and null keys stay as they are.
    """
    check_names(key, ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "class_distance", "word_distance"])
    return judged(docs, F.col(key), text, lang).withColumnRenamed("key", key)


def keep_good(docs: DataFrame, columns: list[str], text: str = "text", lang: str = "lang") -> DataFrame:
    """The documents that `judge` keeps, with these columns.

    Null and empty texts have too few words and go; repeated rows are judged alike, and each stays that is
    kept; null keys and languages are kept as they are; an empty table gives an empty one.
    """
    return judged(docs, F.struct(*columns), text, lang).filter("kept").select("key.*")


def word_counts(words: Column) -> Column:
    """Each word of a sorted array and how often it is there: the places where the word changes, and the distances between them."""
    n = F.size(words)
    starts = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (F.get(words, i) != F.get(words, i - 1)))
    ends = F.array_append(F.slice(starts, F.lit(2), F.greatest(F.size(starts) - 1, F.lit(0))), n)
    counts = F.zip_with(starts, ends, lambda a, b: F.struct(F.get(words, a).alias("w"), (b - a).alias("n")))
    return F.when(n > 0, counts).otherwise(F.array().cast("array<struct<w:string,n:int>>"))


def judged(docs: DataFrame, key: Column, text: str, lang: str) -> DataFrame:
    common = common_words(docs, text, lang)
    listed = sorted({w for ws in common.values() for w in ws})
    base = counted(docs, key, text, lang)
    # one pass over the tokens leaves the few that are common somewhere
    base = base.withColumn("listed", F.sort_array(F.filter("tokens", lambda x: x.isin(*listed))))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    features = written(base.select("*", word_counts(F.col("listed")).alias("common"), F.size("tokens").alias("n_tokens"), failed.alias("base_failed")).drop("tokens", "listed"))
    return verdicts(features, common, references(features, common))


def verdicts(features: DataFrame, common: dict[str, list[str]], refs: dict[str, tuple[list[float], list[float]]]) -> DataFrame:
    out = ["key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    chars, n_tokens = (F.greatest(c, F.lit(1)).cast("double") for c in (F.col("n_chars"), F.col("n_tokens")))
    total = lambda xs: F.aggregate(xs, F.lit(0), lambda x, y: x + y)
    df = features.withColumn("counts", F.map_from_entries("common")).withColumn("shares", F.transform(F.array_append("classes", F.col("n_chars") - total(F.col("classes"))), lambda x: x / chars))
    if not refs:
        return df.select(*out, (~F.col("base_failed")).alias("kept"), F.lit(None).cast("double").alias("class_distance"), F.lit(None).cast("double").alias("word_distance"))
    known = constant([{"listed": common[k], "classes": c, "words": w} for k, (c, w) in refs.items()], "array<struct<listed:array<string>,classes:array<double>,words:array<double>>>")
    df = df.withColumn("own", F.transform(known, lambda r: F.transform(r["listed"], lambda w: F.coalesce(F.try_element_at("counts", w), F.lit(0)))))

    def apart(r: Column, own: Column) -> Column:
        by_word = distance(F.transform(F.array_append(own, F.col("n_tokens") - total(own)), lambda x: x / n_tokens), r["words"])
        return F.struct(distance(F.col("shares"), r["classes"]).alias("c"), by_word.alias("w"))

    df = df.withColumn("near", F.zip_with(known, "own", apart))
    fits = F.exists("near", lambda x: ((F.col("n_chars") < CLASS_CHARS) | (x["c"] <= CLASS_LIMIT)) & ((F.col("n_tokens") < WORD_WORDS) | (x["w"] <= WORD_LIMIT)))
    least = [F.round(F.array_min(F.col(f"near.{n}")), 6).alias(name) for n, name in (("c", "class_distance"), ("w", "word_distance"))]
    return df.select(*out, (~F.col("base_failed") & fits).alias("kept"), *least)


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents")).drop("class_distance", "word_distance")


def sql() -> str:
    """The same in SQL: word and window counts by unnesting, references by grouping."""
    spaces, classes = SPACES, [c.replace("'", "''") for c in CLASSES]
    class_counts = ", ".join(f"length(text) - length(regexp_replace(text, '{c}', '', 'g'))" for c in classes)
    n = len(CLASSES)
    jsd = "sqrt(greatest(sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2, 0))"
    return rf"""
    WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS text FROM documents),
    w AS (SELECT *, list_filter(string_split_regex(text, '{spaces}'), lambda x: x <> '') AS words,
        list_filter(string_split_regex(lower(text), '[^\p{{L}}\p{{Nd}}]+'), lambda x: x <> '') AS tokens,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines, [{class_counts}] AS classes FROM d),
    g AS (SELECT rid, i, words[i:i + 2] AS gram FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
    r AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS n FROM g) WHERE n > 1),
    rep AS (SELECT rid, count(DISTINCT i + j) AS n FROM r, range(3) t(j) GROUP BY rid),
    b AS (SELECT w.*, length(text) AS n_chars, len(words) AS n_words, length(regexp_replace(text, '{spaces}', '', 'g')) AS word_chars,
        length(text) - length(translate(text, '{SYMBOLS}', '')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words
        FROM w LEFT JOIN rep USING (rid)),
    f AS (SELECT *, len(tokens) AS n_tokens, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM b),
    tw AS (SELECT rid, lang, word, count(*) AS n FROM (SELECT rid, lang, unnest(tokens) AS word FROM w) GROUP BY ALL),
    langs AS (SELECT lang, count(*) AS docs FROM documents WHERE lang IS NOT NULL AND text IS NOT NULL GROUP BY lang),
    often AS (SELECT lang, word, count(*) AS n, any_value(docs) AS docs FROM tw JOIN langs USING (lang) WHERE n > 1 GROUP BY lang, word),
    common AS (SELECT lang, word, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS k FROM often WHERE n >= docs * {COMMON_SHARE}::DOUBLE QUALIFY k <= {COMMON}),
    lw AS (SELECT f.lang, sum(n_tokens) AS tokens, sum(n_chars) AS chars, {", ".join(f"sum(classes[{i + 1}]) AS c{i}" for i in range(n))} FROM f JOIN langs USING (lang) WHERE NOT base_failed GROUP BY f.lang),
    lc AS (SELECT c.lang, c.word, c.k, coalesce(sum(tw.n), 0) AS n FROM common c LEFT JOIN (SELECT tw.* FROM tw JOIN f USING (rid) WHERE NOT base_failed) tw ON tw.lang = c.lang AND tw.word = c.word GROUP BY ALL),
    pairs AS (SELECT f.rid, lw.lang AS l, n_tokens, n_chars, classes, tokens AS all_tokens, chars, {", ".join(f"c{i}" for i in range(n))} FROM (SELECT * EXCLUDE (tokens) FROM f) f, lw),
    wp AS (SELECT pairs.rid, l, coalesce(tw.n, 0) / greatest(n_tokens, 1)::DOUBLE AS p, CASE WHEN all_tokens > 0 THEN lc.n / all_tokens::DOUBLE ELSE 0 END AS q FROM pairs JOIN lc ON lc.lang = l LEFT JOIN tw ON tw.rid = pairs.rid AND tw.word = lc.word),
    wa AS (SELECT rid, l, p, q FROM wp UNION ALL SELECT pairs.rid, l, any_value(CASE WHEN n_tokens > 0 THEN 1 ELSE 0 END) - coalesce(sum(wp.p), 0), any_value(CASE WHEN all_tokens > 0 THEN 1 ELSE 0 END) - coalesce(sum(wp.q), 0) FROM pairs LEFT JOIN wp USING (rid, l) GROUP BY ALL),
    wd AS (SELECT rid, l, {jsd} AS w FROM (SELECT rid, l, CASE WHEN p > 1e-12 THEN p ELSE 0 END AS p, CASE WHEN q > 1e-12 THEN q ELSE 0 END AS q FROM wa) GROUP BY rid, l),
    cp AS (SELECT rid, l, unnest([{", ".join(f"classes[{i + 1}]" for i in range(n))}, n_chars - list_sum(classes)]) / greatest(n_chars, 1)::DOUBLE AS p,
        unnest([{", ".join(f"c{i}" for i in range(n))}, chars - ({" + ".join(f"c{i}" for i in range(n))})]) / greatest(chars, 1)::DOUBLE AS q FROM pairs),
    cd AS (SELECT rid, l, {jsd} AS c FROM cp GROUP BY rid, l),
    v AS (SELECT rid, min(c) AS c, min(w) AS w, bool_or((n_chars < {CLASS_CHARS} OR c <= {CLASS_LIMIT}) AND (n_tokens < {WORD_WORDS} OR w <= {WORD_LIMIT})) AS fits FROM cd JOIN wd USING (rid, l) JOIN f USING (rid) GROUP BY rid)
    SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
        base_failed, NOT base_failed AND coalesce(fits, true) AS kept FROM f LEFT JOIN v USING (rid)"""
