"""URL filters: listed rules, and a path-template tree per host whose templates are rejected by smoothed labelled purity."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tracecut.llm.common import check_names, joined, table, written

#: (rule, verdict); a rule is a host and the start of a path.
RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"))
#: A branch stays apart from its siblings from this many pages on, if its labels differ by a test of this chi-square.
SUPPORT = 20
CHI_SQUARE = 3.84
#: Branches that stay are compared by their rates of bad pages in so many steps.
BINS = 10
#: Only sql() knows this: below so many levels it takes all segments for wildcards, where the tree is walked to its end.
DEPTH = 6
#: Labelled pages that a parent's rate weighs in a template's purity, and the rate of bad ones that rejects a template.
PRIOR = 10.0
REJECT = 0.5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """Behind the first :// up to / ? # or the end, A-Z lower-cased; empty for null and without ://."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fits(rule: str, host: Column, path: Column) -> Column:
    name, _, start = rule.partition("/")
    return ((host == name) | host.endswith("." + name)) & path.startswith("/" + start)


def listed(rules, host: Column, path: Column) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; of equally long ones that of the longer host, then the later. Nulls if none fits."""
    order = sorted(range(len(rules)), key=lambda i: (-len(rules[i][0]), -rules[i][0].index("/"), -i))
    rule = F.coalesce(*(F.when(fits(rules[i][0], host, path), F.lit(rules[i][0])) for i in order), F.lit(None).cast("string"))
    verdict = F.coalesce(*(F.when(fits(rules[i][0], host, path), F.lit(rules[i][1])) for i in order), F.lit(None).cast("string"))
    return rule, verdict


def segments(path: Column) -> Column:
    """All of the path's segments but empty ones at its end; runs of digits, long hexadecimal and long segments generalised."""
    typed = F.regexp_replace(F.regexp_replace(path, "[0-9a-f]{16,}", "<x>"), "[0-9]+", "<n>")
    parts = F.split(F.regexp_replace(F.regexp_replace(typed, "[^/]{41,}", "<long>"), "/+$", ""), "/")
    return F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))


def differs(lab: Column, bad: Column, lab2: Column, bad2: Column) -> Column:
    """Whether two shares of bad pages among labelled ones differ by the chi-square test; false without labels on a side."""
    lab, bad, lab2, bad2 = (c.cast("double") for c in (lab, bad, lab2, bad2))
    p = (bad + bad2) / F.nullif(lab + lab2, F.lit(0.0))
    gap = bad / F.nullif(lab, F.lit(0.0)) - bad2 / F.nullif(lab2, F.lit(0.0))
    return F.coalesce(gap * gap > CHI_SQUARE * p * (1 - p) * (1.0 / F.nullif(lab, F.lit(0.0)) + 1.0 / F.nullif(lab2, F.lit(0.0))), F.lit(False))


def merged(kept: DataFrame) -> DataFrame:
    """host, template, seg, name of the branches (with lab, bad) that stay: similar ones of a node have one name.

    Branches of a node with the same step of the rate are one, and so are neighbouring steps unless they
    differ by the test. A branch by itself is named by its segment, several by the least one and the
    number of the others. A node has BINS + 1 steps at most, so no node is too large for a task.
    """
    kept = kept.withColumn("bin", F.struct("host", "template", F.floor(F.col("bad") * BINS / F.col("lab")).alias("step")))
    steps = kept.groupBy("bin").agg(F.sum("lab").alias("lab"), F.sum("bad").alias("bad"), F.min("seg").alias("least"), F.count(F.lit(1)).alias("segs"))
    node = Window.partitionBy("bin.host", "bin.template")
    up = node.orderBy("bin.step")
    apart = differs(F.col("lab"), F.col("bad"), F.lag("lab").over(up), F.lag("bad").over(up)).cast("int")
    steps = steps.withColumn("apart", apart).withColumn("group", F.sum("apart").over(up))
    group = Window.partitionBy("bin.host", "bin.template", "group")
    steps = steps.withColumn("all", F.sum("segs").over(group)).withColumn("least", F.min("least").over(group))
    name = F.when(F.col("all") == 1, F.concat(F.lit("/"), "least")).otherwise(F.concat(F.lit("/{"), "least", F.lit("+"), (F.col("all") - 1).cast("string"), F.lit("}")))
    return joined(kept.select("bin", "host", "template", "seg"), written(steps.select("bin", name.alias("name"))), "bin").select("host", "template", "seg", "name")


def templates(paths: DataFrame) -> DataFrame:
    """host, segs, template of distinct (host, segs) with n, labelled and bad counts.

    Level by level, down to the deepest path, a branch stays apart if it has SUPPORT pages and its share
    of bad pages differs from its siblings'; of those that stay, similar ones are merged; all other
    branches are merged under a wildcard. Sums go by groups, and joins spread hot keys, so a host with
    very many paths is dealt out. A node whose pages are too few, or labelled all alike, can have no
    branch that stays: its paths are finished at once, with a wildcard for each segment left. Hosts with
    empty segments inside a path have paths of several nodes come together again, so theirs are all
    walked to the end.
    """
    sums = [F.sum(c).alias(c) for c in ("n", "lab", "bad")]
    last, columns = F.size("segs"), ["host", "segs", "template", "n", "lab", "bad"]
    paths = written(paths)
    inner = written(paths.groupBy("host").agg(F.max(F.array_contains("segs", "")).alias("inner")).filter("inner"))
    tree = written(joined(paths, inner, "host", "left").withColumn("inner", F.coalesce("inner", F.lit(False))).withColumn("template", F.lit("")))
    done, level = [], 0
    while True:
        here = tree.withColumn("seg", F.coalesce(F.get("segs", F.lit(level)), F.lit("")))
        branch = written(here.groupBy("host", "template", "seg").agg(*sums))
        node = branch.groupBy("host", "template").agg(*(F.sum(c).alias(f"{c}_all") for c in ("n", "lab", "bad")))
        mixed = node.filter((F.col("n_all") > SUPPORT) & (F.col("bad_all") > 0) & (F.col("bad_all") < F.col("lab_all")))
        mixed = written(mixed.withColumn("node", F.struct("host", "template")).drop("host", "template"))
        stays = (F.col("n") >= SUPPORT) & (F.col("seg") != "") & differs(F.col("lab"), F.col("bad"), F.col("lab_all") - F.col("lab"), F.col("bad_all") - F.col("bad"))
        named = written(joined(branch.withColumn("node", F.struct("host", "template")), mixed, "node").withColumn("stays", stays))
        names = merged(named.filter("stays")).unionByName(named.filter("NOT stays").select("host", "template", "seg", F.when(F.col("seg") == "", "").otherwise("/*").alias("name")))
        names = written(names.select(F.struct("host", "template", "seg").alias("branch"), "name"))
        rest = F.array_join(F.transform(F.filter(F.slice("segs", level + 1, F.greatest(last, F.lit(1))), lambda s: s != ""), lambda s: F.lit("/*")), "")
        # a path that ended above stays a sibling once, under the empty segment
        closed = ~F.col("inner") & (F.col("name").isNull() | (last <= level))
        walked = joined(here.withColumn("branch", F.struct("host", "template", "seg")), names, "branch", "left")
        walked = written(walked.select("host", "segs", F.concat("template", F.when(closed, rest).when(F.col("name").isNull(), F.when(F.col("seg") == "", "").otherwise("/*")).otherwise(F.col("name"))).alias("template"), "n", "lab", "bad", "inner", closed.alias("closed")))
        tree, level = walked.filter("NOT closed"), level + 1
        if tree.filter(last > level).isEmpty():
            return reduce(DataFrame.unionByName, [*done, walked.select(*columns)])
        done.append(walked.filter("closed").select(*columns))


def judge(pages: DataFrame, labels: DataFrame, key: str = "page_id", url: str = "url", label_key: str = "doc_id", label: str = "quality", good: int = 1, rules=RULES) -> DataFrame:
    """One row a page: its key, host, path, rule, verdict, template, purity.

    A rule's verdict holds where one fits. Elsewhere the page's template decides: `block` where the
    share of bad labelled pages, smoothed by its host's and that by all pages', reaches REJECT; without any
    label all templates are allowed. Labels
    are rows of `labels` whose key is the page's; null labels are none, and of several the worst counts.
    Null urls and those without :// have an empty host and path, and so the template of those.
    """
    check_names(key, ["host", "path", "rule", "verdict", "template", "purity"])
    marks = labels.filter(F.col(label).isNotNull() & F.col(label_key).isNotNull()).groupBy(F.col(label_key).alias("__key")).agg(F.max((F.col(label) != good).cast("int")).alias("__bad"))
    parsed = pages.select(F.col(key).alias("__page"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    parsed = parsed.withColumn("segs", segments(F.col("path")))
    marked = parsed.join(marks, F.col("__page") == F.col("__key"), "left")
    paths = marked.groupBy("host", "segs").agg(F.count(F.lit(1)).alias("n"), F.count("__bad").alias("lab"), F.coalesce(F.sum("__bad"), F.lit(0)).alias("bad"))
    tree = written(templates(paths))
    hosts = written(tree.groupBy("host").agg(F.sum("lab").alias("lab_h"), F.sum("bad").alias("bad_h")))
    total = tree.agg(F.coalesce(F.sum("lab"), F.lit(0)).alias("lab"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")).first()
    overall = total["bad"] / (total["lab"] + 1.0)
    rate = joined(written(tree.groupBy("host", "template").agg(F.sum("lab").alias("lab"), F.sum("bad").alias("bad"))), hosts, "host")
    above = (F.col("bad_h") + PRIOR * overall) / (F.col("lab_h") + PRIOR)
    rate = written(rate.select(F.struct("host", "template").alias("leaf"), ((F.col("bad") + PRIOR * above) / (F.col("lab") + PRIOR)).alias("purity")))
    by_path = joined(tree.select(F.struct("host", "segs").alias("whole"), "template", F.struct("host", "template").alias("leaf")), rate, "leaf")
    by_path = written(by_path.select("whole", "template", "purity"))
    rule, verdict = listed(rules, F.col("host"), F.col("path"))
    out = joined(parsed.withColumn("whole", F.struct("host", "segs")), by_path, "whole", "left")
    method = F.when(F.col("purity") >= REJECT, "block").otherwise("allow")
    return out.select(F.col("__page").alias(key), "host", "path", rule.alias("rule"), F.coalesce(verdict, method).alias("verdict"), "template", F.round("purity", 6).alias("purity"))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")).select("page_id", "host", "path", "rule", "verdict", "template")


def _fits_sql(rule: str) -> str:
    name, _, start = rule.partition("/")
    return f"(host = '{name}' OR ends_with(host, '.{name}')) AND starts_with(path, '/{start}')"


def _differs_sql(lab: str, bad: str, lab2: str, bad2: str) -> str:
    lab, bad, lab2, bad2 = (f"({x})::DOUBLE" for x in (lab, bad, lab2, bad2))
    p = f"(({bad} + {bad2}) / nullif({lab} + {lab2}, 0))"
    gap = f"({bad} / nullif({lab}, 0) - {bad2} / nullif({lab2}, 0))"
    return f"coalesce({gap} * {gap} > {CHI_SQUARE}::DOUBLE * {p} * (1 - {p}) * (1.0::DOUBLE / nullif({lab}, 0) + 1.0::DOUBLE / nullif({lab2}, 0)), false)"


def _level_sql(level: int) -> str:
    return f"""
    h{level} AS (SELECT *, coalesce(segs[{level + 1}], '') AS seg FROM t{level}),
    b{level} AS (SELECT host, template, seg, sum(n) AS n, sum(lab) AS lab, sum(bad) AS bad FROM h{level} GROUP BY ALL),
    n{level} AS (SELECT *, sum(lab) OVER w AS lab_all, sum(bad) OVER w AS bad_all FROM b{level} WINDOW w AS (PARTITION BY host, template)),
    s{level} AS (SELECT *, floor(bad * {BINS} / lab) AS step FROM n{level} WHERE n >= {SUPPORT} AND seg <> '' AND {_differs_sql("lab", "bad", "lab_all - lab", "bad_all - bad")}),
    u{level} AS (SELECT host, template, step, sum(lab) AS lab, sum(bad) AS bad, min(seg) AS least, count(*) AS segs FROM s{level} GROUP BY ALL),
    a{level} AS (SELECT *, {_differs_sql("lab", "bad", "lag(lab) OVER w", "lag(bad) OVER w")}::INT AS apart FROM u{level} WINDOW w AS (PARTITION BY host, template ORDER BY step)),
    g{level} AS (SELECT *, sum(apart) OVER (PARTITION BY host, template ORDER BY step) AS grp FROM a{level}),
    m{level} AS (SELECT host, template, step, sum(segs) OVER w AS n_segs, min(least) OVER w AS name FROM g{level} WINDOW w AS (PARTITION BY host, template, grp)),
    k{level} AS (SELECT host, template, seg, CASE WHEN n_segs = 1 THEN '/' || name ELSE '/{{' || name || '+' || (n_segs - 1)::BIGINT || '}}' END AS name FROM s{level} JOIN m{level} USING (host, template, step)),
    t{level + 1} AS (SELECT h.host, h.segs, h.template || CASE WHEN h.seg = '' THEN '' ELSE coalesce(k.name, '/*') END AS template, n, lab, bad
        FROM h{level} h LEFT JOIN k{level} k ON h.host = k.host AND h.template = k.template AND h.seg = k.seg),"""


def sql() -> str:
    order = sorted(RULES, key=lambda r: -len(r[0]))
    rule = "CASE " + " ".join(f"WHEN {_fits_sql(r)} THEN '{r}'" for r, _ in order) + " END"
    verdict = "CASE " + " ".join(f"WHEN {_fits_sql(r)} THEN '{v}'" for r, v in order) + " END"
    levels = reduce(str.__add__, map(_level_sql, range(DEPTH)))
    return rf"""
    WITH u AS (SELECT page_id, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}'), '') AS host,
        coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
    s AS (SELECT *, string_split(regexp_replace(regexp_replace(regexp_replace(regexp_replace(path, '[0-9a-f]{{16,}}', '<x>', 'g'), '[0-9]+', '<n>', 'g'), '[^/]{{41,}}', '<long>', 'g'), '/+$', ''), '/') AS parts FROM u),
    parsed AS (SELECT page_id, host, path, parts[2:] AS segs FROM s),
    marks AS (SELECT doc_id, max((quality <> 1)::INT) AS b FROM labels WHERE quality IS NOT NULL AND doc_id IS NOT NULL GROUP BY doc_id),
    t0 AS (SELECT host, segs, '' AS template, count(*) AS n, count(b) AS lab, coalesce(sum(b), 0) AS bad FROM parsed LEFT JOIN marks ON page_id = doc_id GROUP BY host, segs),
    {levels}
    tree AS (SELECT * REPLACE (template || repeat('/*', len(list_filter(segs[{DEPTH + 1}:], lambda x: x <> ''))) AS template) FROM t{DEPTH}),
    total AS (SELECT coalesce(sum(bad), 0) / (coalesce(sum(lab), 0) + 1.0::DOUBLE) AS overall FROM tree),
    hosts AS (SELECT host, sum(lab) AS lab_h, sum(bad) AS bad_h FROM tree GROUP BY host),
    rate AS (SELECT host, template, (sum(bad) + {PRIOR}::DOUBLE * any_value((bad_h + {PRIOR}::DOUBLE * overall) / (lab_h + {PRIOR}::DOUBLE))) / (sum(lab) + {PRIOR}::DOUBLE) AS purity
        FROM tree JOIN hosts USING (host), total GROUP BY host, template)
    SELECT page_id, host, path, {rule} AS rule, coalesce({verdict}, CASE WHEN purity >= {REJECT} THEN 'block' ELSE 'allow' END) AS verdict, template
    FROM parsed LEFT JOIN tree USING (host, segs) LEFT JOIN rate USING (host, template)"""
