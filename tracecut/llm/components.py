"""Connected components of an edge table, by joins and groups only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracecut.llm.common import joined, written


def components(edges: DataFrame, a: str, b: str, rounds: int = 60) -> DataFrame:
    """node, comp: the least node of each component, for all nodes of the edges.

    Large-star and small-star rounds: every node is hung on the least node it knows of, first by its
    larger neighbours and then by its smaller ones, until no edge changes. Each round's edges are
    written to the shared folder, so lineage stays short and nothing is gathered on the driver; a node
    that very many hang on is no single task's, as `joined` spreads it.
    """
    pairs = written(edges.select(F.least(a, b).alias("v"), F.greatest(a, b).alias("u")).filter("u <> v").distinct())
    before = None
    for _ in range(rounds):
        both = pairs.unionByName(pairs.select(F.col("u").alias("v"), F.col("v").alias("u")))
        # large star: the larger neighbours v of u hang on the least of u and its neighbours
        least = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = written(joined(both.filter("v > u"), least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct())
        # small star: u and its smaller neighbours hang on the least of these
        least = written(large.groupBy("u").agg(F.min("v").alias("m")))
        small = joined(large, least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = written(small.unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        now = pairs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(pairs.select(F.col("v").alias("node"), F.col("v").alias("comp"))).distinct()
