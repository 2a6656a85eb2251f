"""Operators over whole recordings: trimming, filtering, segments, statistics, provenance and integrity checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tracecut.sources.store import written


def numbered(episodes: DataFrame, order: str = "ep", spread: bool = False) -> DataFrame:
    """episodes (ep, length) with new_ep, dense from 0 in order, and base, the frames of all before.

    The table has a row an episode, never one a frame, and is ranked in one task; with `spread` it is
    dealt out by ranges of the order and ranked in each, behind the totals of the ranges before.
    """
    if not spread:
        w = Window.orderBy(order)
        before = w.rowsBetween(Window.unboundedPreceding, -1)
        return episodes.withColumn("new_ep", (F.row_number().over(w) - 1).cast("long")).withColumn("base", F.coalesce(F.sum("length").over(before), F.lit(0)))
    ranged = written(episodes.repartitionByRange(order).withColumn("__range", F.spark_partition_id()))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("__range").agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("frames"))
    totals = totals.select("__range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__n"), F.coalesce(F.sum("frames").over(before), F.lit(0)).alias("__frames"))
    w = Window.partitionBy("__range").orderBy(order)
    own = ranged.withColumns({"__at": F.row_number().over(w) - 1, "__before": F.coalesce(F.sum("length").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))})
    out = own.join(F.broadcast(totals), "__range")
    return out.withColumns({"new_ep": (F.col("__n") + F.col("__at")).cast("long"), "base": F.col("__frames") + F.col("__before")}).drop("__range", "__n", "__frames", "__at", "__before")


def rekeyed(frames: DataFrame, points: DataFrame, fps: float) -> DataFrame:
    """Frames from `trim` on, numbered anew: new_ep, frame_index, timestamp (frame/fps as FLOAT), index over all; points: ep, trim, length.

    Episodes of which nothing would be left stay out.
    """
    kept = numbered(points.select("ep", "trim", (F.col("length") - F.col("trim")).alias("length")).filter("length > 0"))
    own = frames.join(kept, "ep").filter("f >= trim").withColumn("frame_index", F.col("f") - F.col("trim"))
    return own.withColumn("timestamp", (F.col("frame_index").cast("double") / fps).cast("float")).withColumn("index", F.col("base") + F.col("frame_index")).drop("base", "length", "trim", "f")


def renumbered(frames: DataFrame, ranges: DataFrame, fps: float) -> DataFrame:
    """Frames of (ep, new_ep, base, start, stop, …) ranges, each an episode of its own: f, frame_index, timestamp (frame/fps as FLOAT) and index over all."""
    own = segment_frames(frames.drop("timestamp", "frame_index", "index"), ranges)
    own = own.withColumns({"f": F.col("frame_index"), "index": F.col("base") + F.col("frame_index"), "timestamp": (F.col("frame_index").cast("double") / fps).cast("float")})
    return own.drop("start", "stop", "base")


def without_episodes(frames: DataFrame, excluded: DataFrame) -> DataFrame:
    """Frames of the episodes that are not in `excluded`, with dense new_ep and index; frame numbers and times stay."""
    kept = frames.join(excluded.select("ep").distinct(), "ep", "left_anti")
    plan = numbered(kept.groupBy("ep").agg(F.count(F.lit(1)).alias("length")))
    return kept.join(plan, "ep").withColumn("index", F.col("base") + F.col("f")).drop("base", "length")


def cut_up(frames: DataFrame, cuts: DataFrame, names: list[str]) -> DataFrame:
    """Frames with segment_no, start, stop: of boundaries 0, cuts (ep and these columns), length the half-open range each frame is in.

    Episodes without a full set of cuts are left out; the join is on the episode, the range is its condition.
    """
    lengths = frames.groupBy("ep").agg(F.count(F.lit(1)).alias("length"))
    edges = F.array(F.lit(0).cast("long"), *(F.col(n) for n in names), F.col("length"))
    whole = cuts.join(lengths, "ep").dropna(subset=names)
    ranges = whole.select("ep", F.posexplode(F.slice(edges, 1, len(names) + 1)).alias("segment_no", "start"), edges.alias("edges"))
    ranges = ranges.select("ep", "segment_no", "start", F.get("edges", F.col("segment_no") + 1).alias("stop"))
    return frames.join(ranges, "ep").filter("f >= start AND f < stop")


def segment_frames(frames: DataFrame, segments: DataFrame) -> DataFrame:
    """Frames of (ep, start, stop, …) intervals, each numbered from 0 as frame_index; intervals may overlap."""
    return frames.join(segments, "ep").filter("f >= start AND f < stop").withColumn("frame_index", F.col("f") - F.col("start"))


def scalar_stats(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """keys, feature, min, max, mean, std (population), count of scalar columns."""
    out = None
    stats = df.groupBy(*keys).agg(*(F.struct(F.min(c).alias("min"), F.max(c).alias("max"), F.avg(c).alias("mean"), F.stddev_pop(c).alias("std"), F.count(c).alias("count")).alias(c) for c in columns))
    each = F.explode(F.array(*(F.struct(F.lit(c).alias("feature"), F.col(c).alias("s")) for c in columns)))
    out = stats.select(*keys, each.alias("x")).select(*keys, "x.feature", "x.s.*")
    return out


def vector_stats(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """keys, dim, min, max, mean, std (population), count of each dimension of an array column."""
    each = df.select(*keys, F.posexplode(column).alias("dim", "x"))
    return each.groupBy(*keys, "dim").agg(F.min("x").alias("min"), F.max("x").alias("max"), F.avg("x").alias("mean"), F.stddev_pop("x").alias("std"), F.count("x").alias("count"))


def stats_document(stats: DataFrame, keys: list[str]) -> DataFrame:
    """Long vector statistics as arrays in order of dim: keys, min, max, mean, std, and count, which is one number for all dimensions."""
    packed = stats.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("dim", "min", "max", "mean", "std", "count"))).alias("xs"))
    return packed.select(*keys, *(F.col(f"xs.{n}").alias(n) for n in ("min", "max", "mean", "std")), F.slice("xs.count", 1, 1).alias("count"))


def feature_stats(frames: DataFrame, features: dict[str, str]) -> DataFrame:
    """ep, feature, min, max, mean, std, count of several features, array columns or scalars, in one scan: features has a column's name in the result."""
    types = dict(frames.dtypes)
    each = []
    for column, name in features.items():
        values = F.col(f"`{column}`").cast("array<double>") if types[column].startswith("array") else F.array(F.col(f"`{column}`").cast("double"))
        each.append(_entries(values, name))
    long = frames.select("ep", F.explode(F.concat(*each)).alias("e")).select("ep", "e.*")
    return stats_document(long.groupBy("ep", "feature", "dim").agg(F.min("x").alias("min"), F.max("x").alias("max"), F.avg("x").alias("mean"), F.stddev_pop("x").alias("std"), F.count("x").alias("count")), ["ep", "feature"])


def _entries(values: Column, name: str) -> Column:
    return F.transform(values, lambda x, i: F.struct(F.lit(name).alias("feature"), i.alias("dim"), x.alias("x")))


def sample_count(n: Column) -> Column:
    """Images that statistics are taken of, for n frames."""
    return F.greatest(F.least(n, F.lit(100)), F.least(F.floor(F.pow(n.cast("double"), 0.75)), F.lit(10000))).cast("long")


def overridden(points: DataFrame, overrides: DataFrame) -> DataFrame:
    """points with trim replaced by the override's, and problem: `missing` without one, `duplicate` with several, `out of range` unless 0 <= trim < length; overrides of other episodes are ignored."""
    given = overrides.groupBy("ep").agg(F.min("trim").alias("trim"), F.count(F.lit(1)).alias("__n"))
    own = points.drop("trim").join(given, "ep", "left")
    problem = F.when(F.col("__n") > 1, "duplicate").when(F.col("trim").isNull(), "missing").when((F.col("trim") < 0) | (F.col("trim") >= F.col("length")), "out of range")
    return own.withColumn("problem", problem).drop("__n")


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).count().filter("count > 1")


def missing_keys(expected: DataFrame, given: DataFrame, key: str = "ep") -> DataFrame:
    return expected.select(key).join(given.select(key).distinct(), key, "left_anti")


def contiguity(intervals: DataFrame) -> DataFrame:
    """intervals (ep, ordinal, start, stop, length) with problem: range, order or gap; null if fine."""
    before = F.lag("stop").over(Window.partitionBy("ep").orderBy("ordinal"))
    bad = F.when((F.col("start") < 0) | (F.col("stop") > F.col("length")), "range").when(F.col("start") >= F.col("stop"), "order").when(before.isNotNull() & (before != F.col("start")), "gap")
    return intervals.withColumn("problem", bad)


def labelled(intervals: DataFrame, spec: DataFrame) -> DataFrame:
    """intervals joined by ordinal to the task's steps (ordinal, id, description), with problem `text` where the descriptions differ and `missing` without a step."""
    own = intervals.join(spec, "ordinal", "left")
    return own.withColumn("problem", F.when(F.col("description").isNull(), "missing").when(F.col("description") != F.col("subtask"), "text"))


def changed_cuts(old: DataFrame, new: DataFrame, names: list[str], times: list[str] | None = None, atol: float = 1e-9, rtol: float = 1e-5) -> DataFrame:
    """Episodes of which a cut's frame differs, or a time by more than atol + rtol * |new time|."""
    differ = [~F.col(f"old.{n}").eqNullSafe(F.col(f"new.{n}")) for n in names]
    for t in times or []:
        a, b = F.col(f"old.{t}"), F.col(f"new.{t}")
        differ.append(~F.coalesce(F.abs(a - b) <= atol + rtol * F.abs(b), F.lit(False)))
    return old.alias("old").join(new.alias("new"), F.col("old.ep") == F.col("new.ep")).filter(reduce(Column.__or__, differ)).select(F.col("new.ep").alias("ep"))


def frame_index_faults(frames: DataFrame, column: str = "frame_index") -> DataFrame:
    """Rows whose number is not their place from 0 in the episode."""
    place = F.row_number().over(Window.partitionBy("ep").orderBy("f")) - 1
    return frames.withColumn("place", place.cast("long")).filter(F.col(column).isNull() | (F.col(column) != F.col("place")))


def global_index_faults(frames: DataFrame, column: str = "index") -> DataFrame:
    """Episodes whose index doesn't go on from the episode before: ep, lowest, highest, length, base."""
    per = frames.groupBy("ep").agg(F.min(column).alias("lowest"), F.max(column).alias("highest"), F.count_distinct(column).alias("different"), F.count(F.lit(1)).alias("length"))
    own = numbered(per)
    return own.filter((F.col("lowest") != F.col("base")) | (F.col("highest") != F.col("base") + F.col("length") - 1) | (F.col("different") != F.col("length"))).drop("new_ep", "different")


def length_faults(frames: DataFrame, meta: DataFrame) -> DataFrame:
    """Episodes whose rows are not as many as meta (ep, length) says, on either side."""
    per = frames.groupBy("ep").agg(F.count(F.lit(1)).alias("rows"))
    return per.join(meta.select("ep", "length"), "ep", "full").filter(~F.col("rows").eqNullSafe(F.col("length")))


def id_faults(episodes: DataFrame) -> DataFrame:
    """One row with n, lowest, highest and different ids if they aren't 0 to n-1, each once; else none."""
    seen = episodes.agg(F.count(F.lit(1)).alias("n"), F.min("ep").alias("lowest"), F.max("ep").alias("highest"), F.count_distinct("ep").alias("different"))
    return seen.filter((F.col("n") > 0) & ((F.col("lowest") != 0) | (F.col("highest") != F.col("n") - 1) | (F.col("different") != F.col("n"))))


def timestamp_faults(frames: DataFrame, fps: float, atol: float = 1e-5, rtol: float = 1e-5) -> DataFrame:
    """Rows whose timestamp is not frame/fps within atol + rtol * |frame/fps|; NaN and null are faults."""
    due = F.col("f").cast("double") / fps
    fine = F.abs(F.col("timestamp").cast("double") - due) <= atol + rtol * F.abs(due)
    return frames.filter(F.isnan("timestamp") | ~F.coalesce(fine, F.lit(False)))


def constant_faults(frames: DataFrame, column: str) -> DataFrame:
    """Episodes in which a column has no or several values."""
    return frames.groupBy("ep").agg(F.min(column).alias("low"), F.max(column).alias("high"), F.count(column).alias("n"), F.count(F.lit(1)).alias("length")).filter("n < length OR low <> high").select("ep", "low", "high")


def totals(frames: DataFrame, chunk: int = 1000, cameras: int = 0) -> DataFrame:
    """One row: total_episodes, total_frames, total_videos, total_chunks."""
    per = frames.groupBy("ep").agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.count(F.lit(1)).alias("total_episodes"), F.coalesce(F.sum("n"), F.lit(0)).alias("total_frames"), (F.count(F.lit(1)) * cameras).alias("total_videos"), F.ceil(F.count(F.lit(1)) / chunk).alias("total_chunks"))


def trim_summary(points: DataFrame, fps: float) -> DataFrame:
    """One row: episodes, source, removed and output frames, removed seconds, median trim."""
    return points.agg(F.count(F.lit(1)).alias("episodes"), F.sum("length").alias("source_frames"), F.sum("trim").alias("removed_frames"), F.sum(F.col("length") - F.col("trim")).alias("output_frames"), (F.sum("trim") / fps).alias("removed_seconds"), F.median("trim").alias("median_trim"))
