"""Window expressions over the frames of an episode.

A frames table has `ep` (episode), `f` (frame, from 0 without gaps) and one DOUBLE column a channel.
All windows share one partitioning and order, so a chain of them needs one exchange and one sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def ordered():
    return Window.partitionBy("ep").orderBy("f")


def whole():
    return Window.partitionBy("ep")


def first_of(c: Column) -> Column:
    """The value at the episode's first frame."""
    return F.first(c).over(ordered().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))


def last_of(c: Column) -> Column:
    return F.last(c).over(ordered().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))


def smoothed(c: Column, n: int) -> Column:
    """Centred mean of n frames; beyond the ends the first and last values repeat. Terms are added in frame order."""
    before, total = n // 2, None
    for o in range(-before, n - before):
        x = c if not o else F.coalesce(F.lag(c, -o).over(ordered()), first_of(c)) if o < 0 else F.coalesce(F.lead(c, o).over(ordered()), last_of(c))
        total = x * (1 / n) if total is None else total + x * (1 / n)
    return total


def step(c: Column) -> Column:
    """How far the channel moves to the next frame; null at the last one."""
    return F.abs(F.lead(c).over(ordered()) - c)


def largest(cs: list[Column]) -> Column:
    return F.greatest(*cs) if len(cs) > 1 else cs[0]


def lasting(condition: Column, k: int) -> Column:
    """Whether the condition holds here and in the k-1 frames after, all within the episode."""
    return F.sum(F.coalesce(condition, F.lit(False)).cast("int")).over(ordered().rowsBetween(0, k - 1)) == k


def runs(df: DataFrame, condition: Column) -> DataFrame:
    """ep, start, stop (inclusive), n: maximal runs of frames that meet the condition."""
    kept = df.filter(condition).select("ep", "f", (F.col("f") - F.row_number().over(ordered())).alias("island"))
    return kept.groupBy("ep", "island").agg(F.min("f").alias("start"), F.max("f").alias("stop"), F.count(F.lit(1)).alias("n")).drop("island")


def with_run_ends(df: DataFrame, **conditions: Column) -> DataFrame:
    """df with each named condition as a column, null as false, and whether a run of it starts and ends at the frame."""
    own = df.withColumns({n: F.coalesce(c, F.lit(False)) for n, c in conditions.items()})
    w, ends = ordered(), {}
    for n in conditions:
        ends[f"{n}_first"] = F.col(n) & ~F.lag(n, 1, False).over(w)
        ends[f"{n}_last"] = F.col(n) & ~F.lead(n, 1, False).over(w)
    return own.withColumns(ends)


def gathered(condition: Column, value: Column) -> Column:
    """The values of the frames that meet the condition, in order; an aggregate. Values start with the frame."""
    return F.sort_array(F.collect_list(F.when(condition, value)))


def run_list(name: str, k: int = 1) -> Column:
    """The runs of a condition of `with_run_ends` with k frames or more, as (start, stop), in order; an aggregate."""
    starts, stops = gathered(F.col(f"{name}_first"), F.col("f")), gathered(F.col(f"{name}_last"), F.col("f"))
    both = F.zip_with(starts, stops, lambda a, b: F.struct(a.alias("start"), b.alias("stop")))
    return F.filter(both, lambda r: r["stop"] - r["start"] + 1 >= k) if k > 1 else both


def last_run(runs: Column, lo: Column, hi: Column) -> Column:
    """The last run that reaches lo and starts before hi; null if none."""
    return F.try_element_at(F.filter(runs, lambda r: (r["stop"] >= lo) & (r["start"] < hi)), F.lit(-1))


def first_gap(runs: Column, at: Column, k: int, end: Column) -> Column:
    """The first frame from `at` on with k frames before `end` that no run holds; null if none."""
    before = F.concat(F.array(F.lit(-1).cast("long")), F.transform(runs, lambda r: r["stop"]))
    behind = F.concat(F.transform(runs, lambda r: r["start"]), F.array(end.cast("long")))
    gaps = F.zip_with(before, behind, lambda a, b: F.struct(F.greatest(a + 1, at).alias("from"), b.alias("to")))
    return F.array_min(F.transform(F.filter(gaps, lambda g: g["from"] + k <= g["to"]), lambda g: g["from"]))


def norm(cs: list[Column]) -> Column:
    total = cs[0] * cs[0]
    for c in cs[1:]:
        total = total + c * c
    return F.sqrt(total)


def first_largest(names: list[str], values: list[Column]) -> Column:
    """The name of the largest value; of equal ones the first."""
    out = F.lit(names[-1])
    for i in range(len(names) - 2, -1, -1):
        out = F.when(values[i] >= largest(values[i + 1 :]), names[i]).otherwise(out)
    return out
