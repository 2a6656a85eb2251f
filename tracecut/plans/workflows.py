"""Whole workflows over recordings on disk: split, sync, trim, filter, convert, validate and their chains.

Rebuilt datasets are written beside their place, checked there, and moved when sound. Metadata has a row
an episode and is written from the driver; frames never pass through it. `media` says what becomes of
the camera videos: `none` leaves the cameras out of the new dataset, `carry` takes whole files along,
`cut` encodes the frames kept, where ffmpeg is at hand.
"""

from __future__ import annotations

import csv
import io
import json
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracecut.operators import cuts as C
from tracecut.operators import datasets as S
from tracecut.operators import detect as D
from tracecut.sources import frames as R
from tracecut.sources import media as M
from tracecut.sources import sinks as W
from tracecut.sources.store import written

EPISODES = "episode_index long, tasks array<string>, length long"
#: The episode's row of episodes_stats.jsonl, its features left as JSON.
STATS = "episode_index long, stats map<string,string>"
#: What the four steps between the cuts are called in annotations. Fixed values.
SUBTASKS = [
    "Pick up all bread pieces from the bread rack and insert them into the toaster.",
    "Push down the toaster's front lever to activate the toaster, then return the right gripper to its initial resting configuration.",
    "Pour drink from the water bottle into the cup, return the bottle upright, and return the left gripper to its initial resting configuration.",
    "Remove all toasted bread from the toaster and place it on the plate.",
]


def limited(raw: DataFrame, max_episodes: int | None) -> DataFrame:
    """The episodes of the least ids, so many of them; all if None."""
    if max_episodes is None:
        return raw
    if max_episodes <= 0:
        raise ValueError("the number of episodes must be positive")
    return raw.join(F.broadcast(raw.select("ep").distinct().orderBy("ep").limit(max_episodes)), "ep", "left_semi")


def signals(raw: DataFrame, info: dict) -> tuple[DataFrame, dict[str, str]]:
    """One DOUBLE column a channel of the two arms, the right gripper and the right hand's place; and the joints' names."""
    names = info["features"]["observation.state.joint"]["names"]
    grip = info["features"]["observation.gripper_position"]["names"].index("right_gripper_percent")
    wanted, called = {}, {}
    for side, at in (("left", 0), ("right", 7)):
        for i, place in enumerate(R.positions(names, f"_{side}")):
            for kind in ("s", "a"):
                called[f"{side[0]}{kind}{i}"] = names[place]
            wanted[f"{side[0]}s{i}"] = ("joint", place)
            wanted[f"{side[0]}a{i}"] = ("action", at + i)
    wanted |= {"grip": ("gripper", grip), "grip_action": ("action", 13), "x": ("end_pose", 6), "y": ("end_pose", 7), "z": ("end_pose", 8)}
    return R.channels(raw, wanted), called


def timed(found: DataFrame, raw: DataFrame) -> DataFrame:
    """found with the time stamps of its cuts and of the end, time1..time4 and task_end_time, by one join."""
    names = [*C.CUTS, "task_end"]
    places = found.select("ep", F.explode(F.array(*(F.struct(F.lit(n).alias("name"), F.col(n).alias("f")) for n in names))).alias("x")).select("ep", "x.name", "x.f").filter("f IS NOT NULL")
    stamps = raw.select("ep", "f", F.col("timestamp").cast("double").alias("time")).join(places, ["ep", "f"])
    times = stamps.groupBy("ep").agg(*(F.max(F.when(F.col("name") == n, F.col("time"))).alias(f"time{i}" if i < 5 else "task_end_time") for i, n in enumerate(names, 1)))
    return found.join(times, "ep", "left")


def episode_entry(r: dict, source: str, files: list[str]) -> dict:
    """An episode of split_summary.json, from its row of the report."""
    end = {"status": r["task_end_status"], "frame": r["task_end_frame"], "time": r["task_end_time"], "motors": r["task_end_motors"], "error": r["task_end_error"]}
    why = {k: r[k] for k in ("cut1_motor", "cut3_return_motors", "cut3_left_start_motor")} | {"cut3_left_start_frame": str(r["cut3_left_start_frame"])} | {k: r[k] for k in ("cut4_motors", "task_end_motors", "task_end_error")}
    return {"episode_index": r["episode_index"], "source": source, "cut_frames": [r[f"cut{i}_frame"] for i in range(1, 5)], "cut_times": [r[f"cut{i}_time"] for i in range(1, 5)], "task_end": end, "trigger_sources": why, "split_files": files}


def split(spark: SparkSession, source: str, output: str, detect_only: bool = False, max_episodes: int | None = None, overwrite: bool = False, config: C.Config | None = None) -> DataFrame:
    """Cuts of all episodes, or of the first ones; their five segments, a report and a summary are written. Returns find_cuts' rows with times."""
    info = R.document(spark, f"{source}/meta/info.json")
    raw = limited(R.episode_files(spark, source), max_episodes)
    own, names = signals(raw, info)
    config = replace(config or C.Config(), fps=float(info["fps"]), names=names)
    found = written(timed(C.find_cuts(own, config), raw))
    if found.isEmpty():
        raise ValueError(f"no episodes in {source}")
    if not detect_only:
        cut = S.cut_up(raw, found.filter("status = 'ok'").select("ep", *C.CUTS), C.CUTS).withColumn("segment", F.col("segment_no") + 1)
        W.put_episodes(R.original(cut.drop("start", "stop", "segment_no")), f"{output}/parquet", segment="segment", overwrite=overwrite)
    rows = [r.asDict() for r in W.cut_report(found).toLocalIterator()]
    W.put_text(spark, f"{output}/cut_points.csv", W.csv_text(rows, W.CUT_FIELDS))
    chunk = info.get("chunks_size", 1000)

    def entry(r: dict) -> dict:
        files = [] if detect_only else [f"{output}/parquet/episode_{r['episode_index']:06d}/segment_{i:02d}.parquet" for i in range(1, 6)]
        return episode_entry(r, R.episode_path(info, source, r["episode_index"], chunk), files)

    failed = {s: [{k: r[k] for k in ("episode_index", "status", "error")} for r in rows if r["status"] == s] for s in ("rejected", "error")}
    W.put_json(spark, f"{output}/split_summary.json", {"dataset": source, "config": config.thresholds(), "episodes": [entry(r) for r in rows if r["status"] == "ok"], "rejected": failed["rejected"], "errors": failed["error"]})
    return found


def sync(spark: SparkSession, source: str, output: str, dry_run: bool = False, texts: list[str] | None = None, summary: str | None = None, cut_points: str | None = None, split_output: str | None = None, parquet_output: str | None = None) -> DataFrame:
    """Maps the hand-edited cut_times of the summary to the nearest frames and brings all else in line with them.

    The summary, the report and every annotation are written anew, the segments of changed episodes are
    replaced where they lie; what was there is backed up first. Changed are episodes whose frames differ
    from the summary's or whose times from the report's. Returns ep and changed, with old and new frames.
    """
    summary, cut_points = summary or f"{output}/split_summary.json", cut_points or f"{output}/cut_points.csv"
    split_output, parquet_output = split_output or f"{output}/split", parquet_output or f"{output}/parquet"
    info = R.document(spark, f"{source}/meta/info.json")
    fps = float(info["fps"])
    doc = R.document(spark, summary)
    reader = csv.DictReader(io.StringIO(W.get_text(spark, cut_points)))
    rows, fields = list(reader), list(reader.fieldnames or [])
    by_episode = {int(r["episode_index"]): r for r in rows}
    edits, old = [], []
    for e in doc["episodes"]:
        ep, times = int(e["episode_index"]), [float(t) for t in e["cut_times"]]
        if len(times) != 4:
            raise ValueError(f"episode {ep}: expected 4 cut times, found {len(times)}")
        if ep not in by_episode:
            raise ValueError(f"episode {ep} is not in {cut_points}")
        edits += [(ep, i, t) for i, t in enumerate(times, 1)]
        old.append((ep, *(int(x) for x in e["cut_frames"]), *(float(by_episode[ep][f"cut{i}_time"]) for i in range(1, 5))))
    time_names = [f"time{i}" for i in range(1, 5)]
    edited = spark.createDataFrame(edits, "ep long, cut_no int, time double")
    before = spark.createDataFrame(old, "ep long, " + ", ".join([f"{n} long" for n in C.CUTS] + [f"{n} double" for n in time_names]))
    raw = R.episode_files(spark, source).join(F.broadcast(before.select("ep")), "ep", "left_semi")
    lengths = D.episodes(raw)
    near = D.nearest_frames(raw.select("ep", "f", F.col("timestamp").cast("double").alias("t")), edited)
    per = [F.max(F.when(F.col("cut_no") == i, F.col(c))).alias(f"{n}{i}") for c, n in (("frame", "cut"), ("time", "time")) for i in range(1, 5)]
    new = written(near.join(edited, ["ep", "cut_no"]).groupBy("ep").agg(*per).join(lengths, "ep"))
    if lost := [r.ep for r in S.missing_keys(before, new).limit(5).collect()]:
        raise ValueError(f"episodes {lost} of the summary have no recording")
    wrong = new.filter(~((F.col("cut1") > 0) & (F.col("cut1") < F.col("cut2")) & (F.col("cut2") < F.col("cut3")) & (F.col("cut3") < F.col("cut4")) & (F.col("cut4") < F.col("length"))))
    if (bad := wrong.first()) is not None:
        raise ValueError(f"episode {bad.ep}: cut times map to frames {[bad[c] for c in C.CUTS]}, which do not increase or leave an edge empty")
    changed = written(S.changed_cuts(before, new, C.CUTS, time_names))
    result = new.join(changed.withColumn("changed", F.lit(True)), "ep", "left").withColumn("changed", F.coalesce("changed", F.lit(False)))
    result = result.join(before.select("ep", F.array(*C.CUTS).alias("old_frames")), "ep").select("ep", "changed", "old_frames", F.array(*C.CUTS).alias("new_frames"), F.array(*time_names).alias("times"), "length")
    if dry_run:
        return result
    now = {r.ep: r for r in result.toLocalIterator()}
    notes = [f"{split_output}/episode_{ep:06d}.json" for ep, r in sorted(now.items()) if r.changed]
    W.back_up(spark, f"{summary.rpartition('/')[0]}/manual_sync_backups", [summary, cut_points, *(n for n in notes if W.exists(spark, n))])

    def annotate(e: dict) -> None:
        r = now[int(e["episode_index"])]
        e["cut_frames"] = list(r.new_frames)
        for i, (frame, time) in enumerate(zip(r.new_frames, r.times, strict=True), 1):
            by_episode[r.ep] |= {f"cut{i}_frame": frame, f"cut{i}_time": time}
        note = W.split_document(r.ep, r.times, list(r.new_frames), r.length / fps, r.length, texts or SUBTASKS, e.get("task_end"))
        W.put_json(spark, f"{split_output}/episode_{r.ep:06d}.json", note)

    with ThreadPoolExecutor(16) as pool:
        list(pool.map(annotate, doc["episodes"]))
    if not changed.isEmpty():
        again = S.cut_up(raw, new.join(changed, "ep", "left_semi").select("ep", *C.CUTS), C.CUTS).withColumn("segment", F.col("segment_no") + 1)
        W.put_episodes(R.original(again.drop("start", "stop", "segment_no")), parquet_output, segment="segment", keep_others=True)
    W.put_json(spark, summary, doc)
    W.put_text(spark, cut_points, W.csv_text(rows, fields))
    return result


def split_and_sync(spark: SparkSession, source: str, output: str, overwrite: bool = False, reuse_summary: bool = False, max_episodes: int | None = None, config: C.Config | None = None) -> DataFrame:
    """Split, then annotations; with reuse_summary the summary that is there, edited by hand or not, stands in for the split."""
    W.outside(source, output)
    if not reuse_summary:
        split(spark, source, output, max_episodes=max_episodes, overwrite=overwrite, config=config)
    elif not W.exists(spark, f"{output}/split_summary.json"):
        raise FileNotFoundError(f"{output}/split_summary.json")
    return sync(spark, source, output)


def numbers(features: dict) -> list[str]:
    """The features that statistics are taken of: all but pictures and text."""
    return [k for k, v in features.items() if v.get("dtype") not in ("video", "image", "string")]


def cameras_of(info: dict) -> list[str]:
    return [k for k, v in info["features"].items() if v.get("dtype") == "video"]


def publish(spark: SparkSession, frames: DataFrame, info: dict, source: str, path: str, plan: DataFrame, mapping: DataFrame, tasks: DataFrame, media: str, recount: bool, encode: dict) -> None:
    """Data and metadata of a rebuilt dataset.

    frames: new_ep, f and the recording's columns; plan: ep, new_ep, start, stop of each episode. Data is
    written once, and statistics, lengths and totals are read from what was written. Camera statistics
    come from the source's, with the count of the new length where videos are cut.
    """
    if media not in ("none", "carry", "cut"):
        raise ValueError(f"media may be none, carry or cut, not {media}")
    if media == "carry" and recount:
        raise ValueError("whole videos can only be carried along where every frame is kept")
    if media == "cut" and not M.can_cut():
        raise FileNotFoundError("ffmpeg and ffprobe are needed to cut videos")
    chunk = info.get("chunks_size", 1000)
    named = frames.withColumns({"ep": F.col("new_ep"), "episode_index": F.col("new_ep")}).drop("new_ep")
    W.put_episodes(R.original(named, R.episode_files(spark, source, rename=False)), f"{path}/data", chunk)
    back = R.episode_files(spark, path, rename=False)
    lengths = written(D.episodes(back))
    cameras = cameras_of(info) if media != "none" else []
    features = {k: v for k, v in info["features"].items() if k in cameras or v.get("dtype") != "video"}
    if media == "cut":
        for k in cameras:
            features[k] = features[k] | {"info": features[k].get("info", {}) | {"video.codec": "h264", "video.pix_fmt": "yuv420p", "video.fps": info["fps"]}}
    total = lengths.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("frames")).first()
    counts = {"total_episodes": total.n, "total_frames": total.frames, "total_videos": total.n * len(cameras), "total_chunks": ceil(total.n / chunk), "splits": {"train": f"0:{total.n}"}}
    W.put_json(spark, f"{path}/meta/info.json", info | {"features": features} | counts)
    W.put_lines(spark, f"{path}/meta/episodes.jsonl", matched(lengths, tasks.select(F.col("new_ep").alias("ep"), "tasks"), "tasks").orderBy("ep").select(F.col("ep").alias("episode_index"), "tasks", "length"))
    W.put_lines(spark, f"{path}/meta/source_mapping.jsonl", mapping, lambda r: {k: v for k, v in r.items() if v is not None})
    wanted = {k: k for k in numbers(features) if k in back.columns}
    doc = lengths
    if wanted:
        stats = S.feature_stats(back, wanted)
        doc = lengths.join(stats.groupBy("ep").agg(F.map_from_entries(F.collect_list(F.struct("feature", F.struct("min", "max", "mean", "std", "count")))).alias("stats")), "ep", "left")
    else:
        doc = lengths.withColumn("stats", F.lit(None).cast("map<string,struct<min:array<double>,max:array<double>,mean:array<double>,std:array<double>,count:array<bigint>>>"))
    if cameras:
        olds = R.json_lines(spark, f"{source}/meta/episodes_stats.jsonl", STATS).select(F.col("episode_index").alias("from"), F.map_filter("stats", lambda k, _: k.isin(*cameras)).alias("cameras"))
        doc = matched(doc.join(plan.select(F.col("new_ep").alias("ep"), F.col("ep").alias("from")), "ep"), olds, "cameras", "from")
    whole = {k for k in wanted if str(features[k].get("dtype", "")).startswith(("int", "uint", "bool"))}

    def shape(r: dict) -> dict:
        out = {k: v | ({m: [int(x) for x in v[m]] for m in ("min", "max")} if k in whole else {}) for k, v in (r["stats"] or {}).items()}
        for k in cameras:
            old = json.loads(r["cameras"][k])
            out[k] = old | {"count": [r["sampled"]]} if recount else old
        return {"episode_index": r["ep"], "stats": {k: out[k] for k in [*wanted, *cameras] if k in out}}

    W.put_lines(spark, f"{path}/meta/episodes_stats.jsonl", doc.withColumn("sampled", S.sample_count(F.col("length"))).orderBy("ep"), shape)
    if cameras:
        todo = written(M.jobs(plan, source, path, cameras, chunk))
        M.run(spark, todo, media, fps=float(info["fps"]), **encode)
        if bad := M.faults(todo, count_frames=media == "cut"):
            raise RuntimeError(f"{bad} videos are missing or have other frames than the recording")


def matched(left: DataFrame, right: DataFrame, column: str, key: str = "ep") -> DataFrame:
    """left with right's column; a row without one is an error."""
    out = left.join(right, key, "left")
    if (lost := out.filter(F.col(column).isNull()).select(key).first()) is not None:
        raise ValueError(f"episode {lost[0]} has no {column} in the source's metadata")
    return out


def tasks_of(spark: SparkSession, source: str, plan: DataFrame) -> DataFrame:
    meta = R.json_lines(spark, f"{source}/meta/episodes.jsonl", EPISODES).select(F.col("episode_index").alias("ep"), "tasks")
    return matched(plan.select("ep", "new_ep"), meta, "tasks").select("new_ep", "tasks")


def dense(episodes: DataFrame) -> None:
    if (bad := S.id_faults(episodes).first()) is not None:
        raise ValueError(f"episode ids must be 0 to {bad.n - 1}, each once; they go from {bad.lowest} to {bad.highest}")


def sound(spark: SparkSession, path: str) -> None:
    """An error unless `validate` finds no fault."""
    if faults := {k: n for k, n in validate(spark, path).items() if n}:
        raise ValueError(f"{path} is not sound: {faults}")


def copy_tasks(spark: SparkSession, source: str, path: str) -> None:
    if W.exists(spark, f"{source}/meta/tasks.jsonl"):
        lines = [x for x in W.get_text(spark, f"{source}/meta/tasks.jsonl").splitlines() if x.strip()]
        W.put_text(spark, f"{path}/meta/tasks.jsonl", "".join(f"{x}\n" for x in lines))


def overrides_of(spark: SparkSession, path: str) -> DataFrame:
    """ep, trim of a report that was edited by hand."""
    text = csv.DictReader(io.StringIO(W.get_text(spark, path)))
    return spark.createDataFrame([(int(r["episode_index"]), int(r["trim_frame"])) for r in text], "ep long, trim long")


def trim_cuts(spark: SparkSession, source: str, joint: float = 0.005, gripper: float = 0.01, sustain: int = 3, pre_roll: int = 3, overrides: DataFrame | None = None, max_episodes: int | None = None) -> DataFrame:
    """ep, length, motion, trim, trigger, cut_source of each episode; overrides (ep, trim) replace what was detected."""
    if joint <= 0 or gripper <= 0:
        raise ValueError("movement thresholds must be positive")
    if sustain <= 0 or pre_roll < 0:
        raise ValueError("frames to last must be positive, and those before not negative")
    info = R.document(spark, f"{source}/meta/info.json")
    raw = limited(R.episode_files(spark, source), max_episodes)
    n = {c: len(info["features"][k]["names"]) for c, k in (("joint", "observation.state.joint"), ("gripper", "observation.gripper_position"))}
    own = R.channels(raw, {f"{c}{i}": (c, i) for c in n for i in range(n[c])})
    groups = {"observation_joint": ([f"joint{i}" for i in range(n["joint"])], joint), "observation_gripper": ([f"gripper{i}" for i in range(n["gripper"])], gripper)}
    points = written(D.trim_points(own, groups, sustain, pre_roll).withColumn("cut_source", F.lit("auto")))
    if points.isEmpty():
        raise ValueError(f"no episodes in {source}")
    dense(points)
    if overrides is None:
        return points
    checked = written(S.overridden(points, overrides))
    if (wrong := checked.filter("problem IS NOT NULL").orderBy("ep").first()) is not None:
        raise ValueError(f"override of episode {wrong.ep}: {wrong.problem}")
    return checked.drop("problem").withColumn("cut_source", F.lit("csv"))


def trim(spark: SparkSession, source: str, output: str | None = None, report: str | None = None, media: str = "none", encode: dict | None = None, **detection) -> dict:
    """Drops each episode's still start and rebuilds the dataset; without output only the report is written. Returns the summary."""
    if output is None and report is None:
        raise ValueError("either an output or a report is needed")
    points = trim_cuts(spark, source, **detection)
    info = R.document(spark, f"{source}/meta/info.json")
    fps = float(info["fps"])
    if report is not None:
        W.put_csv(spark, report, W.trim_report(points, fps), W.TRIM_FIELDS)
    r = S.trim_summary(points, fps).first().asDict()
    out = {k: r[k] for k in ("episodes", "source_frames", "removed_frames", "removed_seconds", "output_frames")} | {"median_trim_frames": r["median_trim"]}
    if output is None:
        return out
    with W.Staged(spark, source, output) as path:
        kept = written(S.numbered(points.withColumn("source_length", F.col("length")).withColumn("length", F.col("length") - F.col("trim")).filter("length > 0"), spread=True))
        raw = R.episode_files(spark, source)
        frames = S.renumbered(raw, kept.select("ep", "new_ep", "base", F.col("trim").alias("start"), F.col("source_length").alias("stop")), fps)
        mapping = kept.orderBy("new_ep").select(F.col("new_ep").alias("episode_index"), F.col("ep").alias("source_episode_index"), F.col("trim").alias("source_start_frame"), F.col("source_length").alias("source_end_frame"), "source_length", "length", "trigger", "cut_source")
        plan = kept.select("ep", "new_ep", F.col("trim").alias("start"), F.col("source_length").alias("stop"))
        copy_tasks(spark, source, path)
        publish(spark, frames, info, source, path, plan, mapping, tasks_of(spark, source, kept), media, True, encode or {})
        W.put_csv(spark, f"{path}/meta/trim_points.csv", W.trim_report(points, fps), W.TRIM_FIELDS)
        sound(spark, path)
    return out | {"output": output}


def pauses_of(spark: SparkSession, source: str, smooth: int = 7, speed_mm_s: float = 10.5, pause_s: float = 1.0, opening_s: float = 0.2, delta: float = 0.12, sustain: int = 3) -> DataFrame:
    """longest_pause of each episode; thresholds in millimetres and seconds."""
    if smooth <= 0 or smooth % 2 == 0:
        raise ValueError("the smoothing window must be a positive odd number")
    if speed_mm_s <= 0 or pause_s <= 0:
        raise ValueError("the speed and the pause must be positive")
    if opening_s < 0:
        raise ValueError("the opening cannot be negative")
    if delta <= 0 or sustain <= 0:
        raise ValueError("the release's parameters must be positive")
    info = R.document(spark, f"{source}/meta/info.json")
    fps = float(info["fps"])
    raw = R.episode_files(spark, source)
    own = R.channels(raw, {"x": ("end_pose", 6), "y": ("end_pose", 7), "z": ("end_pose", 8), "g": ("gripper", 1)})
    # a start at or before the opening does not count: start/fps <= opening
    opening = max(i for i in range(int(opening_s * fps) + 2) if i / fps <= opening_s)
    pauses = written(D.longest_pause(own, ["x", "y", "z"], "g", "z", delta, sustain, speed_mm_s / 1000.0 / fps, ceil(pause_s * fps), opening, smooth))
    dense(pauses)
    if (n := pauses.count()) != int(info["total_episodes"]):
        raise ValueError(f"{n} recordings, but the metadata has {info['total_episodes']}")
    return pauses


def filter_pauses(spark: SparkSession, source: str, output: str | None = None, report: str | None = None, media: str = "none", **detection) -> dict:
    """Drops episodes with a long pause between insertion and release, and numbers the others anew; without output only the report is written. Returns the summary."""
    if output is None and report is None:
        raise ValueError("either an output or a report is needed")
    pauses = pauses_of(spark, source, **detection)
    info = R.document(spark, f"{source}/meta/info.json")
    fps = float(info["fps"])
    if report is not None:
        W.put_csv(spark, report, W.pause_report(pauses, fps), W.PAUSE_FIELDS)
    removed = [r.ep for r in pauses.filter("start IS NOT NULL").select("ep").orderBy("ep").toLocalIterator()]
    out = {"source": source, "episodes": pauses.count(), "removed_episodes": removed, "kept_episodes": pauses.filter("start IS NULL").count()}
    if output is None:
        return out
    with W.Staged(spark, source, output) as path:
        kept = written(S.numbered(pauses.filter("start IS NULL").select("ep", "length"), spread=True))
        frames = R.episode_files(spark, source).drop("index").join(F.broadcast(kept.select("ep", "new_ep", "base")), "ep").withColumn("index", F.col("base") + F.col("f")).drop("base")
        mapping = kept.select("ep", "new_ep")
        if W.exists(spark, f"{source}/meta/source_mapping.jsonl"):
            earlier = R.json_objects(spark, f"{source}/meta/source_mapping.jsonl").withColumn("ep", F.col("episode_index").cast("long"))
            mapping = mapping.join(earlier.drop("episode_index"), "ep", "left")
        mapping = mapping.orderBy("new_ep").withColumn("episode_index", F.col("new_ep")).withColumn("filtered_source_episode_index", F.col("ep"))
        mapping = mapping.select("episode_index", *(c for c in mapping.columns if c not in ("ep", "new_ep", "episode_index")))
        plan = kept.select("ep", "new_ep", F.lit(0).cast("long").alias("start"), F.col("length").alias("stop"))
        copy_tasks(spark, source, path)
        publish(spark, frames, info, source, path, plan, mapping, tasks_of(spark, source, kept), media, False, {})
        W.put_csv(spark, f"{path}/meta/removed_hesitation_episodes.csv", W.pause_report(pauses, fps), W.PAUSE_FIELDS)
        sound(spark, path)
    return out | {"output": output}


def intervals_of(spark: SparkSession, source: str, annotations: str, spec: dict, max_episodes: int | None = None) -> DataFrame:
    """ep, ordinal, start, stop, id, description, length of each labelled interval; the first fault is an error."""
    if not spec["sub_tasks"]:
        raise ValueError("the task has no steps")
    steps = spark.createDataFrame([(i, str(s["id"]), str(s["description"])) for i, s in enumerate(spec["sub_tasks"])], "ordinal int, id string, description string")
    meta = R.json_lines(spark, f"{source}/meta/episodes.jsonl", EPISODES).select(F.col("episode_index").alias("ep"), F.col("length").alias("episode_length"))
    notes = limited(R.annotations(spark, annotations), max_episodes)
    own = S.contiguity(notes.join(meta, "ep", "left").withColumn("length", F.col("episode_length"))).withColumnRenamed("problem", "where").drop("length")
    own = S.labelled(own, steps).withColumnRenamed("problem", "what")
    n = len(spec["sub_tasks"])
    uneven = (F.col("n_texts") != n) | (F.col("n_starts") != n) | (F.col("n_stops") != n)
    problem = F.when(F.col("episode_length").isNull(), "no episode").when(uneven, f"expected {n} labelled intervals").otherwise(F.coalesce("where", "what"))
    own = written(own.withColumn("problem", problem))
    if (bad := own.filter("problem IS NOT NULL").orderBy("ep", "ordinal").first()) is not None:
        raise ValueError(f"interval {bad.ordinal} of episode {bad.ep}: {bad.problem}")
    if own.isEmpty():
        raise ValueError("no labelled intervals")
    return own.select("ep", "ordinal", "start", "stop", "id", "description", (F.col("stop") - F.col("start")).alias("length"))


def convert(spark: SparkSession, source: str, output: str, spec_path: str, annotations: str | None = None, max_episodes: int | None = None, media: str = "none", encode: dict | None = None, resume: bool = False) -> DataFrame:
    """Turns each labelled interval into an episode of its own. Returns the intervals with their new episodes."""
    info = R.document(spark, f"{source}/meta/info.json")
    spec = R.document(spark, spec_path)
    own = intervals_of(spark, source, annotations or f"{source}/split", spec, max_episodes)
    plan = written(S.numbered(own.withColumn("order", F.struct("ep", "ordinal")), "order", spread=True).drop("order"))
    ranges = plan.select("ep", "new_ep", "base", "start", "stop", F.col("ordinal").cast("long").alias("task_index"))
    with W.Staged(spark, source, output, resume) as path:
        frames = S.renumbered(R.episode_files(spark, source).drop("task_index"), ranges, float(info["fps"]))
        mapping = plan.orderBy("new_ep").select(F.col("new_ep").alias("episode_index"), F.col("ep").alias("source_episode_index"), F.col("ordinal").cast("long").alias("subtask_index"), F.col("id").alias("subtask_id"), F.col("description").alias("task"), F.col("start").alias("source_start_frame"), F.col("stop").alias("source_end_frame"), "length")
        tasks = [s["description"] for s in spec["sub_tasks"]]
        W.put_text(spark, f"{path}/meta/tasks.jsonl", "".join(json.dumps({"task_index": i, "task": t}, ensure_ascii=False, separators=(",", ":")) + "\n" for i, t in enumerate(tasks)))
        publish(spark, frames, info | {"total_tasks": len(tasks)}, source, path, plan.select("ep", "new_ep", "start", "stop"), mapping, plan.select("new_ep", F.array("description").alias("tasks")), media, True, (encode or {}) | {"resume": resume})
        sound(spark, path)
    return plan


def validate(spark: SparkSession, source: str, decode_samples: int = 0) -> dict[str, int]:
    """Faults of a dataset by check; all zero for a sound one.

    Task checks need a source mapping with steps, video checks cameras: `videos` counts missing files,
    `samples` those of decode_samples episodes, the least by hash, whose frames aren't the recording's.
    """
    info = R.document(spark, f"{source}/meta/info.json")
    raw = R.episode_files(spark, source)
    meta = written(R.json_lines(spark, f"{source}/meta/episodes.jsonl", EPISODES).withColumn("ep", F.col("episode_index")))
    total = S.totals(raw, info.get("chunks_size", 1000)).first()
    out = {
        "ids": S.id_faults(meta).count() + S.repeated_keys(meta, "ep").count(),
        "lengths": S.length_faults(raw, meta.select("ep", "length")).count(),
        "frame_index": S.frame_index_faults(raw).count(),
        "index": S.global_index_faults(raw).count(),
        "timestamp": S.timestamp_faults(raw, float(info["fps"])).count(),
        "episode_index": S.constant_faults(raw, "episode_index").count() + raw.filter("episode_index <> ep").count(),
        "totals": sum(int(info[k] != total[k]) for k in ("total_episodes", "total_frames")),
    }
    for name, file in (("stats", "episodes_stats"), ("mapping", "source_mapping")):
        if W.exists(spark, f"{source}/meta/{file}.jsonl"):
            keys = R.json_lines(spark, f"{source}/meta/{file}.jsonl", "episode_index long").select(F.col("episode_index").alias("ep"))
            out[name] = S.missing_keys(meta, keys).count() + S.missing_keys(keys, meta).count() + S.repeated_keys(keys, "ep").count()
    steps = R.json_lines(spark, f"{source}/meta/source_mapping.jsonl", "episode_index long, subtask_index long").filter("subtask_index IS NOT NULL") if "mapping" in out else None
    if steps is not None and not steps.isEmpty():
        tasks = R.json_lines(spark, f"{source}/meta/tasks.jsonl", "task_index long, task string")
        per = raw.groupBy("ep").agg(F.min("task_index").alias("low"), F.max("task_index").alias("high")).join(steps.withColumnRenamed("episode_index", "ep"), "ep", "full")
        out["task_index"] = per.filter(~(F.col("low").eqNullSafe(F.col("subtask_index")) & F.col("high").eqNullSafe(F.col("subtask_index")))).count()
        texts = meta.join(steps.withColumnRenamed("episode_index", "ep"), "ep").join(tasks, F.col("subtask_index") == F.col("task_index"), "left")
        out["task_text"] = texts.filter(~F.col("tasks").eqNullSafe(F.array("task"))).count()
        out["task_total"] = int(tasks.count() != info.get("total_tasks"))
    if cameras := cameras_of(info):
        plan = meta.select("ep", F.col("ep").alias("new_ep"), F.lit(0).cast("long").alias("start"), F.col("length").alias("stop"))
        todo = lambda p: M.jobs(p, source, source, cameras, info.get("chunks_size", 1000))
        out["videos"] = M.faults(todo(plan), count_frames=False)
        if decode_samples > 0:
            out["samples"] = M.faults(todo(plan.orderBy(F.xxhash64("ep"), "ep").limit(decode_samples)), count_frames=True)
    return out


def clean(spark: SparkSession, source: str, output: str, between: str | None = None, media: str = "none") -> dict:
    """Trim, then filter; what lies between is removed once both are done. Videos are cut first and then carried."""
    between = between or f"{output}.trimmed"
    first = trim(spark, source, between, media=media)
    second = filter_pauses(spark, between, output, media="none" if media == "none" else "carry")
    W.remove(spark, between)
    return {"trim": first, "filter": second}
