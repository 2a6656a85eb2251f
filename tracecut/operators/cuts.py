"""The cut chain: four ordered cuts and an optional end of the task for each episode, or why there are none."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracecut.functions.kernel import first_largest, gathered, largest, norm, ordered, run_list, smoothed, step, with_run_ends
from tracecut.operators import detect as D
from tracecut.sources.store import written

STATUSES = ("ok", "rejected", "error")
CUTS = ["cut1", "cut2", "cut3", "cut4"]


def frames_of(seconds: float, fps: float, least: int = 0) -> int:
    """Half to even, as seconds are turned into frames everywhere."""
    return max(least, round(seconds * fps))


@dataclass(frozen=True)
class Config:
    """Thresholds of the chain by what they are for, and the channels of each signal."""

    fps: float = 30.0
    smooth_frames: int = 5
    # the right arm's mutation
    baseline_frames: int = 8
    mutation_change: float = 0.05
    baseline_tolerance: float = 0.006
    # the gripper's closures
    gripper_drop: float = 0.12
    gripper_reopen: float = 0.12
    gripper_peak_slack: float = 0.01
    gripper_contact_gap: float = 0.02
    gripper_contact_max_position: float = 0.12
    # how far the hand goes after the release, and within what time
    release_distance: float = 0.10
    release_search_seconds: float = 1.0
    # jumps of the recording
    joint_step: float = 0.3
    joint_action_ratio: float = 5.0
    # the step of an arm that moves, and how long it lasts: the left arm's start, a commanded motion, a stop, the cut behind it
    arm_step: float = 0.006
    start_seconds: float = 0.5
    motion_seconds: float = 0.5
    quiet_seconds: float = 0.5
    delay_seconds: float = 0.5
    # how much earlier than the other arm's stop an arm may start, and what the search for the last stop leaves out
    max_lead_seconds: float = 1.0
    tail_seconds: float = 5.0
    right_state: list[str] = field(default_factory=lambda: [f"rs{i}" for i in range(6)])
    right_action: list[str] = field(default_factory=lambda: [f"ra{i}" for i in range(6)])
    left_state: list[str] = field(default_factory=lambda: [f"ls{i}" for i in range(6)])
    left_action: list[str] = field(default_factory=lambda: [f"la{i}" for i in range(6)])
    gripper: str = "grip"
    gripper_action: str = "grip_action"
    xyz: list[str] = field(default_factory=lambda: ["x", "y", "z"])
    #: Names of the channels in reports, where they are others than here.
    names: dict[str, str] = field(default_factory=dict)

    def thresholds(self) -> dict:
        return {k: v for k, v in asdict(self).items() if isinstance(v, (int, float))}


def episode_rows(frames: DataFrame, c: Config) -> DataFrame:
    """A row an episode with all that the chain asks for: its length, jump, mutations, places, and runs of each signal.

    Signals are smoothed once and stepped once. All of it are windows over the episode, in one order, and
    one group, so frames are exchanged once.
    """
    arms = {"la": c.left_action, "ra": c.right_action, "ls": c.left_state, "rs": c.right_state}
    joints = list(dict.fromkeys(x for own in arms.values() for x in own))
    every = list(dict.fromkeys([*joints, c.gripper, c.gripper_action, *c.xyz]))
    smooth = {x: smoothed(F.col(x), c.smooth_frames) if c.smooth_frames > 1 else F.col(x) for x in every}
    raw = frames.select("ep", "f", *(F.col(x).alias(f"raw_{x}") for x in joints), *(e.alias(x) for x, e in smooth.items()))
    own = raw.withColumns({f"step_{x}": step(F.col(x)) for x in joints} | {f"jump_{x}": step(F.col(f"raw_{x}")) for x in joints})
    own = D.with_deviation(own, c.right_state, c.mutation_change, c.baseline_frames)
    moving = {n: largest([F.col(f"step_{x}") for x in xs]) >= c.arm_step for n, xs in arms.items()}
    start = frames_of(c.start_seconds, c.fps, 1)
    ahead = ordered().rowsBetween(0, start - 1)
    named = [F.max(f"step_{x}").over(ahead) for x in c.left_action]
    own = with_run_ends(own, **moving).withColumn("start_name", first_largest([c.names.get(x, x) for x in c.left_action], named) if len(named) > 1 else F.lit(c.names.get(c.left_action[0], c.left_action[0])))

    states, asked = (norm([F.col(f"jump_{x}") for x in xs]) for xs in (c.right_state + c.left_state, c.right_action + c.left_action))
    top = largest([F.col(f"jump_{x}") for x in c.right_state + c.left_state])
    jumps = (top >= c.joint_step) & F.when(asked > 0, states / asked >= c.joint_action_ratio).otherwise(True)
    jump = F.max(F.when(jumps, F.struct(states.alias("moved"), (-F.col("f")).alias("f"), top.alias("top"), asked.alias("asked"))))
    long_run = frames_of(c.motion_seconds, c.fps, 1)
    return own.groupBy("ep").agg(
        F.count(F.lit(1)).alias("length"), jump.alias("jump"), *(D.stable_before(x, c.baseline_tolerance).alias(f"mutation_{x}") for x in c.right_state),
        F.sort_array(F.collect_list(F.struct("f", F.col(c.gripper).alias("v"), F.col(c.gripper_action).alias("a"), *(F.col(x).alias(f"p{i}") for i, x in enumerate(c.xyz))))).alias("xs"),
        run_list("la", long_run).alias("left_runs"), run_list("ra", long_run).alias("right_runs"), run_list("la", start).alias("left_starts"), run_list("ls").alias("left_moves"), run_list("rs").alias("right_moves"),
        gathered(F.col("la"), F.struct("f", "start_name")).alias("start_names"),
        *(gathered(F.col(f"{n}_last"), F.struct("f", D.moved_names(arms[n], c.arm_step).alias("names"))).alias(f"{side}_names") for side, n in (("left", "ls"), ("right", "rs"))),
    )


def python_number(x: Column, digits: int) -> Column:
    return F.when(x == float("inf"), "inf").otherwise(F.format_string(f"%.{digits}f", x))


def find_cuts(frames: DataFrame, c: Config) -> DataFrame:
    """ep, length, status (ok, rejected, error), reason, error, cut1..cut4, left_start, task_end, n_closures, and the channels that gave them: cut1_channel, left_start_channel, cut3_channels, cut4_channels, task_end_channels, task_end_error.

    Stages run in a fixed order, and the first that fails gives the reason and the error's text; what was
    found is null unless all are fine. Rejections are about quality (discontinuity, release_distance,
    early_left, early_right), errors about missing events. task_end is optional: the right arm's stop
    behind cut4. The result, a row an episode, is written and read again.
    """
    quiet, delay, lead = frames_of(c.quiet_seconds, c.fps, 0), frames_of(c.delay_seconds, c.fps), frames_of(c.max_lead_seconds, c.fps)
    quiet, ahead = max(1, quiet - 1), frames_of(c.release_search_seconds, c.fps)
    col = F.col
    one = D.earliest([f"mutation_{x}" for x in c.right_state])
    mutated = {f"mutation_{x}": c.names.get(x, x) for x in c.right_state}
    r = episode_rows(frames, c).withColumn("m", one)
    # greatest leaves nulls out
    r = r.withColumn("cut1", F.when(col("m.cut").isNotNull(), F.greatest("m.cut", F.lit(1)))).withColumn("cut1_channel", F.coalesce(*(F.when(col("m.channel") == k, v) for k, v in mutated.items()), F.lit("")))
    r = r.withColumn("g", D.gripper_fold(F.transform("xs", lambda x: F.struct(x["f"].alias("f"), x["v"].alias("v"), x["a"].alias("a"))), c.gripper_drop, c.gripper_reopen, c.gripper_peak_slack, c.gripper_contact_max_position, c.gripper_contact_gap))
    r = r.withColumns({"n_closures": F.size("g.closures"), "n_contacts": F.size("g.contacts"), "release": F.get("g.releases", F.lit(1))})
    near = F.slice("xs", (col("release") + 1).cast("int"), F.lit(ahead + 1))
    r = r.withColumns({"near": F.when(col("release").isNotNull(), near), "place": F.get("xs", col("release").cast("int"))})
    far = lambda x: norm([x[f"p{i}"] - col(f"place.p{i}") for i in range(len(c.xyz))]) >= c.release_distance
    r = r.withColumn("cut2", F.get(F.filter("near", far), F.lit(0))["f"])
    began = F.filter("left_starts", lambda x: x["stop"] - F.greatest(x["start"], col("cut2") + 1) + 1 >= frames_of(c.start_seconds, c.fps, 1))
    r = r.withColumn("left_start", F.when(col("cut2").isNotNull(), F.greatest(F.get(began, F.lit(0))["start"], col("cut2") + 1)))
    r = r.withColumn("left_start", F.when(F.size(began) > 0, col("left_start"))).withColumn("left_start_channel", F.get(F.filter("start_names", lambda x: x["f"] == col("left_start")), F.lit(0))["start_name"])

    def stop(name: str, side: str, lo: Column, hi: Column) -> None:
        nonlocal r
        r = r.withColumn(f"{name}_x", F.when(lo.isNotNull() & hi.isNotNull(), D.stop_of(col(f"{side}_runs"), col(f"{side}_moves"), lo, hi, col("length"), quiet, delay)))
        r = r.withColumns({name: col(f"{name}_x.stop"), f"{name}_channels": D.names_before(col(f"{side}_names"), col(f"{name}_x.start"))})

    tail = col("length") - frames_of(c.tail_seconds, c.fps)
    stop("cut3", "right", col("cut2") + 1, col("left_start"))
    stop("cut4", "left", col("cut3") + 1, tail)
    stop("task_end", "right", col("cut4") + 1, col("length"))

    def early(side: str, stable: Column, search: Column) -> Column:
        return F.get(F.filter(f"{side}_runs", lambda x: (x["stop"] >= search) & (x["start"] <= stable) & (stable <= x["stop"]) & (stable - x["start"] > lead)), F.lit(0))["start"]

    r = r.withColumns({"early_left": early("left", col("cut3") - delay, col("cut2")), "early_right": early("right", col("cut4") - delay, col("cut3"))})

    def no_stop(name: str) -> Column:
        x = col(f"{name}_x")
        return F.when(~F.coalesce(x["asked"], F.lit(False)), "arm: no sustained action motion found in the search window").when(x["start"].isNull(), "arm: state has no sustained stop after action motion").otherwise("arm: confirmed state stop is beyond the episode")

    def early_text(side: str, other: str, cut: str) -> Column:
        stable, start = col(cut) - delay, col(f"early_{side}")
        return F.format_string(f"{side} arm starts %.3fs before {other} arm return stability (frames %d->%d), exceeds {c.max_lead_seconds:.3f}s", (stable - start) / c.fps, start, stable)

    jump, at = col("jump"), -col("jump.f")
    ratio = F.when(jump["asked"] > 0, jump["moved"] / jump["asked"]).otherwise(float("inf"))
    jumped = F.concat(F.format_string("joint-state jump %.6f, max single-joint jump %.6f, action jump %.6f (ratio ", jump["moved"], jump["top"], jump["asked"]), python_number(ratio, 2), F.format_string(") at frame %d->%d", at, at + 1))
    cuts_list = F.concat(F.lit("["), F.concat_ws(", ", *(col(x).cast("string") for x in CUTS)), F.lit("]"))
    in_order = (col("cut1") < col("cut2")) & (col("cut2") < col("cut3")) & (col("cut3") < col("cut4"))
    stages = [
        ("rejected", "discontinuity", jump.isNotNull(), jumped),
        ("error", "no mutation", col("cut1").isNull(), F.lit("no motor mutation found while scanning forward")),
        ("error", "contacts", col("release").isNull(), F.format_string("right gripper: found %d object-contact closures, need 2", col("n_contacts"))),
        ("rejected", "release_distance", col("cut2").isNull(), F.lit(f"right arm: does not move {c.release_distance:.3f}m away from bread within {c.release_search_seconds:.3f}s after release")),
        ("error", "no left motion", col("left_start").isNull(), F.lit("arm: no sustained motion found while scanning forward")),
        ("error", "no right stop", col("cut3").isNull(), no_stop("cut3")),
        ("rejected", "early_left", col("early_left").isNotNull(), early_text("left", "right", "cut3")),
        ("error", "short tail", tail - (col("cut3") + 1) < c.baseline_frames, F.lit("episode is too short for cut4 tail exclusion")),
        ("error", "no left stop", col("cut4").isNull(), no_stop("cut4")),
        ("rejected", "early_right", col("early_right").isNotNull(), early_text("right", "left", "cut4")),
        ("error", "order", ~in_order, F.concat(F.lit("cut points are not strictly increasing: "), cuts_list)),
    ]
    failed = F.coalesce(*(F.when(bad, F.struct(F.lit(status).alias("status"), F.lit(reason).alias("reason"), F.concat(F.lit("ValueError: " if status == "error" else ""), text).alias("error"))) for status, reason, bad, text in stages))
    r = r.withColumn("failed", failed)
    fine = col("failed").isNull()
    kept = [*CUTS, "left_start", "task_end", "n_closures", "cut1_channel", "left_start_channel", "cut3_channels", "cut4_channels"]
    # written, for a filter that were pushed down would unfold all stages into itself, each as often as later ones ask for it
    return written(r.select(
        "ep", "length", F.coalesce("failed.status", F.lit("ok")).alias("status"), F.coalesce("failed.reason", F.lit("")).alias("reason"), F.coalesce("failed.error", F.lit("")).alias("error"),
        *(F.when(fine, col(x)).alias(x) for x in kept),
        F.when(fine, F.when(col("task_end").isNotNull(), col("task_end_channels")).otherwise("")).alias("task_end_channels"),
        F.when(fine, F.when(col("task_end").isNotNull(), "").otherwise(no_stop("task_end"))).alias("task_end_error"),
    ))


def status_counts(cuts: DataFrame) -> DataFrame:
    """status, n: all three, with zeros, in one pass."""
    counts = F.array(*(F.struct(F.lit(s).alias("status"), F.count_if(F.col("status") == s).alias("n")) for s in STATUSES))
    return cuts.agg(counts.alias("xs")).select(F.explode("xs").alias("x")).select("x.*")
