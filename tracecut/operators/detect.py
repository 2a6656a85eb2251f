"""Event detectors over frames: one row an episode, nulls where an episode has no such event.

Every comparison at a threshold is as its docstring says; frames count from 0; a step i is the motion
from frame i to i+1. Nothing is thrown for an episode: failures are data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tracecut.functions.kernel import first_gap, first_largest, first_of, gathered, largest, last_run, lasting, norm, ordered, run_list, runs, smoothed, step, whole, with_run_ends


def episodes(frames: DataFrame) -> DataFrame:
    """ep, length."""
    return frames.groupBy("ep").agg(F.count(F.lit(1)).alias("length"))


def onset(frames: DataFrame, columns: list[str], threshold: float, k: int) -> Column:
    """Whether k frames from here on differ from the first frame by more than the threshold in some channel."""
    away = largest([F.abs(F.col(c) - first_of(F.col(c))) for c in columns])
    return lasting(away > threshold, k)


def sustained_onset(frames: DataFrame, columns: list[str], threshold: float, k: int = 3) -> DataFrame:
    """ep, onset: the first frame of k in a row that are away from the first frame by more than the threshold."""
    hit = frames.withColumn("hit", onset(frames, columns, threshold, k))
    return hit.groupBy("ep").agg(F.min(F.when(F.col("hit"), F.col("f"))).alias("onset"))


def trim_points(frames: DataFrame, groups: dict[str, tuple[list[str], float]], k: int = 3, pre_roll: int = 3) -> DataFrame:
    """ep, length, motion, trim, trigger: the earliest onset of the groups (name -> channels, threshold), pre_roll frames before it, and the names that tie."""
    names = sorted(groups)
    hits = frames.select("ep", "f", *(onset(frames, *groups[n], k).alias(f"__{n}") for n in names))
    per = hits.groupBy("ep").agg(F.count(F.lit(1)).alias("length"), *(F.min(F.when(F.col(f"__{n}"), F.col("f"))).alias(f"__{n}") for n in names))
    motion = F.array_min(F.array(*(F.col(f"__{n}") for n in names)))
    tied = F.array_join(F.array_compact(F.array(*(F.when(F.col(f"__{n}") == F.col("motion"), F.lit(n)) for n in names))), ",")
    per = per.withColumn("motion", motion)
    return per.select("ep", "length", "motion", F.coalesce(F.greatest(F.col("motion") - pre_roll, F.lit(0)), F.lit(0)).alias("trim"), F.when(F.col("motion").isNull(), "none").otherwise(tied).alias("trigger"))


def with_steps(frames: DataFrame, columns: list[str], smooth: int = 1, prefix: str = "step_") -> DataFrame:
    """frames with a step column a channel, of the smoothed signal."""
    if smooth > 1:
        own = frames.select("*", *(smoothed(F.col(c), smooth).alias(f"__s_{c}") for c in columns))
        return own.select(*frames.columns, *(step(F.col(f"__s_{c}")).alias(f"{prefix}{c}") for c in columns))
    return frames.select("*", *(step(F.col(c)).alias(f"{prefix}{c}") for c in columns))


def motion_runs(frames: DataFrame, columns: list[str], least: float, k: int, smooth: int = 1) -> DataFrame:
    """ep, start, stop (inclusive): maximal runs of k steps or more in which some channel moves by `least` or more."""
    moving = largest([F.col(f"step_{c}") for c in columns]) >= least
    return runs(with_steps(frames, columns, smooth), moving).filter(F.col("n") >= k).drop("n")


def motion_start(frames: DataFrame, columns: list[str], least: float, k: int, start: Column, smooth: int = 1) -> DataFrame:
    """ep, motion, channel: the first of k moving steps in a row counted from `start` on, and the channel with the largest of exactly those steps, the first of equal ones."""
    own = with_steps(frames.withColumn("__from", start), columns, smooth).filter(F.col("f") >= F.col("__from"))
    moving = largest([F.col(f"step_{c}") for c in columns]) >= least
    ahead = ordered().rowsBetween(0, k - 1)
    most = own.select("ep", "f", lasting(moving, k).alias("hit"), *(F.max(f"step_{c}").over(ahead).alias(c) for c in columns))
    name = first_largest(columns, [F.col(c) for c in columns])
    return most.groupBy("ep").agg(F.min(F.when(F.col("hit"), F.struct("f", name.alias("channel")))).alias("x")).select("ep", F.col("x.f").alias("motion"), F.col("x.channel").alias("channel"))


def moved_names(columns: list[str], least: float) -> Column:
    """The channels with a step of `least` or more, comma-joined in their order."""
    return F.array_join(F.array_compact(F.array(*(F.when(F.col(f"step_{c}") >= least, F.lit(c)) for c in columns))), ",")


def stop_of(commanded: Column, moving: Column, lo: Column, hi: Column, length: Column, quiet: int, delay: int) -> Column:
    """(start, stop): where the state is quiet for `quiet` steps behind the last commanded run in the window, and `delay` frames later, a frame of the episode or null."""
    asked = last_run(commanded, lo, hi)
    start = F.when(asked.isNotNull(), first_gap(moving, asked["stop"] + 1, quiet, length - 1))
    return F.struct(asked.isNotNull().alias("asked"), start.alias("start"), F.when(start + delay < length, start + delay).alias("stop"))


def names_before(named: Column, at: Column) -> Column:
    """The names of the last of (f, names) before the frame; blank if there is none."""
    return F.coalesce(F.try_element_at(F.filter(named, lambda x: x["f"] < at), F.lit(-1))["names"], F.lit(""))


def arm_stop(frames: DataFrame, actions: list[str], states: list[str], least: float, k: int, lo: Column, hi: Column, smooth: int = 1, quiet: int | None = None, delay: int | None = None) -> DataFrame:
    """ep, stop, channels: where the state has been quiet for a while after the last commanded motion.

    Of the action's runs of k steps or more that reach lo and start before hi the last one counts. From
    the step behind it the first `quiet` quiet state steps (k-1, 1 at least), all inside the episode, are
    sought; the stop is `delay` (k) frames later and must be a frame. channels: those that moved in the
    last moving state step before.
    """
    quiet, delay = max(1, k - 1) if quiet is None else quiet, k if delay is None else delay
    channels = list(dict.fromkeys(actions + states))
    asked, moved = (largest([F.col(f"step_{c}") for c in cs]) >= least for cs in (actions, states))
    own = with_steps(frames.withColumns({"__lo": lo, "__hi": hi}), channels, smooth)
    own = with_run_ends(own.select("ep", "f", "__lo", "__hi", moved_names(states, least).alias("names"), asked.alias("asked"), moved.alias("moved")), asked=F.col("asked"), moved=F.col("moved"))
    per = own.groupBy("ep").agg(
        F.count(F.lit(1)).alias("n"), F.first("__lo").alias("lo"), F.first("__hi").alias("hi"), run_list("asked", k).alias("commanded"), run_list("moved").alias("moving"),
        gathered(F.col("moved_last"), F.struct("f", "names")).alias("named"),
    )
    found = per.select("ep", "named", stop_of(F.col("commanded"), F.col("moving"), F.col("lo"), F.col("hi"), F.col("n"), quiet, delay).alias("x"))
    return found.filter("x.stop IS NOT NULL").select("ep", "x.stop", names_before(F.col("named"), F.col("x.start")).alias("channels"))


def early_overlap(found: DataFrame, stable: DataFrame, most: int) -> DataFrame:
    """ep, lead: of the episodes in which a run of `found` (motion_runs) holds the stable frame and started more than `most` frames before it.

    stable: ep, stable, search_start; runs that end before search_start do not count.
    """
    own = found.join(stable, "ep").filter("stop >= search_start AND start <= stable AND stable <= stop")
    return own.select("ep", (F.col("stable") - F.col("start")).alias("lead")).filter(F.col("lead") > most).groupBy("ep").agg(F.max("lead").alias("lead"))


def discontinuity(frames: DataFrame, states: list[str], actions: list[str], least: float, ratio: float) -> DataFrame:
    """ep, frame, jump: of episodes with a raw state step of `least` or more in a channel whose norm is `ratio` times the action's or more, infinite where that is 0; the step of largest norm, the first of equal ones."""
    own = with_steps(frames, list(dict.fromkeys(states + actions))).filter(F.col(f"step_{states[0]}").isNotNull())
    moved, asked = norm([F.col(f"step_{c}") for c in states]), norm([F.col(f"step_{c}") for c in actions])
    own = own.select("ep", "f", largest([F.col(f"step_{c}") for c in states]).alias("top"), moved.alias("moved"), asked.alias("asked"))
    bad = own.filter((F.col("top") >= least) & F.when(F.col("asked") > 0, F.col("moved") / F.col("asked") >= ratio).otherwise(True))
    return bad.groupBy("ep").agg(F.max(F.struct("moved", (-F.col("f")).alias("f"))).alias("x")).select("ep", (-F.col("x.f")).alias("frame"), F.col("x.moved").alias("jump"))


def release_distance(frames: DataFrame, xyz: list[str], release: Column, distance: float, horizon: int, smooth: int = 1) -> DataFrame:
    """ep, cut: the first frame from the release to `horizon` frames behind it that is `distance` or more from the place of the release; null if none."""
    own = frames.select("ep", "f", release.alias("release"), *(smoothed(F.col(c), smooth).alias(c) for c in xyz))
    base = [F.max(F.when(F.col("f") == F.col("release"), F.col(c))).over(whole()).alias(f"base_{c}") for c in xyz]
    far = norm([F.col(c) - F.col(f"base_{c}") for c in xyz]) >= distance
    own = own.select("*", *base)
    return own.groupBy("ep").agg(F.min(F.when(far & F.col("f").between(F.col("release"), F.col("release") + horizon), F.col("f"))).alias("cut"))


def with_deviation(frames: DataFrame, columns: list[str], change: float, baseline: int, start: int = 0) -> DataFrame:
    """frames with dev_ and hit_ of each channel: how far it is from the median of its first `baseline` frames (null with fewer than two), and the first frame behind `start` at which that is `change` or more."""
    near = F.col("f").between(start, start + baseline - 1)
    enough = F.count(F.when(near, 1)).over(whole()) >= 2
    own = frames.withColumns({f"dev_{c}": F.when(enough, F.abs(F.col(c) - F.percentile(F.when(near, F.col(c)), 0.5).over(whole()))) for c in columns})
    return own.withColumns({f"hit_{c}": F.min(F.when((F.col(f"dev_{c}") >= change) & (F.col("f") > start), F.col("f"))).over(whole()) for c in columns})


def stable_before(column: str, tolerance: float, start: int = 0) -> Column:
    """The last frame within `tolerance` before the channel's hit, `start` if there is none, null without a hit; an aggregate."""
    c = F.col(f"dev_{column}")
    last = F.max(F.when((F.col("f") > start) & (F.col("f") < F.col(f"hit_{column}")) & (c <= tolerance), F.col("f")))
    return F.when(F.count(f"hit_{column}") > 0, F.coalesce(last, F.lit(start).cast("long")))


def earliest(columns: list[str]) -> Column:
    """(cut, i, channel): the least of these columns; of equal ones the first; null if all are."""
    return F.array_min(F.array_compact(F.array(*(F.when(F.col(c).isNotNull(), F.struct(F.col(c).alias("cut"), F.lit(i).alias("i"), F.lit(c).alias("channel"))) for i, c in enumerate(columns)))))


def mutation(frames: DataFrame, columns: list[str], change: float, tolerance: float, baseline: int = 8, smooth: int = 1, start: int = 0) -> DataFrame:
    """ep, and for each channel the last frame within `tolerance` (or equal) of the median of its first `baseline` frames before it first is `change` or more away; null without such a change or with fewer than two frames to take the median of."""
    own = with_deviation(frames.select("ep", "f", *(smoothed(F.col(c), smooth).alias(c) for c in columns)), columns, change, baseline, start)
    # an episode of no more than the start has no row
    return own.filter(F.col("f") > start).groupBy("ep").agg(*(stable_before(c, tolerance, start).alias(c) for c in columns))


def any_mutation(frames: DataFrame, columns: list[str], change: float, tolerance: float, baseline: int = 8, smooth: int = 1, start: int = 0) -> DataFrame:
    """ep, cut, channel: the earliest mutation of the channels that have one; of equal ones that of the first channel."""
    each = mutation(frames, columns, change, tolerance, baseline, smooth, start)
    return each.select("ep", earliest(columns).alias("x")).select("ep", F.col("x.cut").alias("cut"), F.col("x.channel").alias("channel"))


def closures(frames: DataFrame, state: str, action: str, drop: float, reopen: float, slack: float, contact_most: float, contact_gap: float, smooth: int = 1) -> DataFrame:
    """ep, closures, contacts, releases: a two-state automaton over the gripper's opening.

    Open, it holds the highest value and the latest frame within `slack` of it, and closes there once the
    value is `drop` or more below. Closed, it holds the lowest state and action, and opens again at a
    rise of `reopen` or more; the closure was a contact if the state stayed at `contact_most` or less and the
    action went `contact_gap` or more below it. One fold over the episode's frames in order.
    """
    own = frames.select("ep", "f", smoothed(F.col(state), smooth).alias("v"), smoothed(F.col(action), smooth).alias("a"))
    packed = own.groupBy("ep").agg(F.sort_array(F.collect_list(F.struct(F.col("f"), F.col("v"), F.col("a")))).alias("xs"))
    return packed.select("ep", gripper_fold(F.col("xs"), drop, reopen, slack, contact_most, contact_gap).alias("s")).select("ep", "s.closures", "s.contacts", "s.releases")


def gripper_fold(xs: Column, drop: float, reopen: float, slack: float, contact_most: float, contact_gap: float) -> Column:
    """The automaton over an episode's (f, v, a) in order, with its three lists."""
    none = F.array().cast("array<bigint>")
    x0 = F.get(xs, F.lit(0))
    begin = F.struct(F.lit(True).alias("open"), x0["v"].alias("peak"), F.lit(0).cast("long").alias("at"), x0["v"].alias("low"), x0["a"].alias("alow"), none.alias("closures"), none.alias("contacts"), none.alias("releases"))

    def turn(s: Column, x: Column) -> Column:
        peak = F.greatest(s["peak"], x["v"])
        at = F.when(x["v"] >= peak - slack, x["f"]).otherwise(s["at"])
        closes = s["open"] & (peak - x["v"] >= drop)
        low, alow = F.least(s["low"], x["v"]), F.least(s["alow"], x["a"])
        opens = ~s["open"] & (x["v"] - low >= reopen)
        contact = opens & (low <= contact_most) & (low - alow >= contact_gap)
        return F.struct(
            F.when(s["open"], ~closes).otherwise(opens).alias("open"),
            F.when(s["open"], peak).when(opens, x["v"]).otherwise(s["peak"]).alias("peak"),
            F.when(s["open"], at).when(opens, x["f"]).otherwise(s["at"]).alias("at"),
            F.when(s["open"], x["v"]).otherwise(low).alias("low"),
            F.when(s["open"], x["a"]).otherwise(alow).alias("alow"),
            F.when(closes, F.concat(s["closures"], F.array(at))).otherwise(s["closures"]).alias("closures"),
            F.when(contact, F.concat(s["contacts"], F.slice(s["closures"], -1, 1))).otherwise(s["contacts"]).alias("contacts"),
            F.when(contact, F.concat(s["releases"], F.array(x["f"]))).otherwise(s["releases"]).alias("releases"),
        )

    return F.aggregate(F.slice(xs, F.lit(2), F.greatest(F.size(xs), F.lit(1))), begin, turn)


def release_frame(frames: DataFrame, gripper: str, delta: float, k: int) -> DataFrame:
    """ep, release: the first of k frames in a row that are more than `delta` above the first frame; the last frame if none."""
    up = F.col(gripper) > first_of(F.col(gripper)) + delta
    hits = frames.select("ep", "f", lasting(up, k).alias("hit"))
    return hits.groupBy("ep").agg(F.coalesce(F.min(F.when(F.col("hit"), F.col("f"))), F.max("f")).alias("release"))


def longest_pause(frames: DataFrame, xyz: list[str], gripper: str, height: str, delta: float, k: int, slow: float, least: int, opening: int, smooth: int = 1) -> DataFrame:
    """ep, length, insertion, release, start, stop (exclusive): the longest pause between the insertion and the release, the earliest of equal ones.

    The release is release_frame's; the insertion is the first highest frame up to it. A pause is a maximal
    run of steps slower than `slow` there, of `least` steps or more, that ends before the release and
    starts after frame `opening`. Episodes without one have null start and stop. One exchange: all of it
    are windows over the episode and a group.
    """
    up = F.col(gripper) > first_of(F.col(gripper)) + delta
    own = frames.select("ep", "f", *(smoothed(F.col(c), smooth).alias(c) for c in xyz), lasting(up, k).alias("up"))
    speed = norm([F.lead(F.col(c)).over(ordered()) - F.col(c) for c in xyz])
    release = F.coalesce(F.min(F.when(F.col("up"), F.col("f"))).over(whole()), F.max("f").over(whole()))
    own = own.select("ep", "f", F.col(height).alias("z"), speed.alias("speed"), release.alias("release"))
    top = F.max(F.when(F.col("f") <= F.col("release"), F.struct(F.col("z"), (-F.col("f")).alias("f")))).over(whole())
    own = own.withColumn("insertion", -top["f"])
    slowly = F.col("f").between(F.col("insertion"), F.col("release") - 1) & (F.col("speed") < slow)
    per = with_run_ends(own, slowly=slowly).groupBy("ep").agg(F.count(F.lit(1)).alias("length"), F.first("insertion").alias("insertion"), F.first("release").alias("release"), run_list("slowly", least).alias("runs"))
    fine = F.filter("runs", lambda r: (r["stop"] + 1 < F.col("release")) & (r["start"] > opening))
    best = F.array_max(F.transform(fine, lambda r: F.struct((r["stop"] - r["start"]).alias("n"), (-r["start"]).alias("s"), (r["stop"] + 1).alias("stop"))))
    return per.withColumn("x", best).select("ep", "length", "insertion", "release", (-F.col("x.s")).alias("start"), F.col("x.stop").alias("stop"))


def nearest_frames(stamps: DataFrame, times: DataFrame) -> DataFrame:
    """ep, cut_no, frame: for each (ep, cut_no, time) the frame of (ep, f, t) whose t is nearest, the first of equal ones."""
    own = stamps.join(times, "ep")
    return own.groupBy("ep", "cut_no").agg(F.min(F.struct(F.abs(F.col("t") - F.col("time")).alias("d"), F.col("f"))).alias("x")).select("ep", "cut_no", F.col("x.f").alias("frame"))
