"""Camera videos beside the recordings: carried along whole, or cut to frames, by tasks on the executors.

Paths must be ones that the executors can open; for cuts and frame counts they need ffmpeg and ffprobe,
on their PATH or where the driver's TRACECUT_FFMPEG and TRACECUT_FFPROBE say. Without them only whole
files can be carried.
"""

from __future__ import annotations

import errno
import os
import shutil
import subprocess
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

JOB = "source string, target string, start long, stop long"


def tools() -> tuple[str, str]:
    """The commands of ffmpeg and ffprobe, as the driver knows them."""
    return os.environ.get("TRACECUT_FFMPEG", "ffmpeg"), os.environ.get("TRACECUT_FFPROBE", "ffprobe")


def jobs(plan: DataFrame, source: str, target: str, cameras: list[str], chunk: int) -> DataFrame:
    """A job a camera and row of plan (ep, new_ep, start, stop): JOB's columns."""
    camera = F.explode(F.array(*map(F.lit, cameras))).alias("camera")

    def path(root: str, ep: str):
        name = F.format_string("%s/videos/chunk-%03d/%s/episode_%06d.mp4", F.lit(root), F.floor(F.col(ep) / chunk), F.col("camera"), F.col(ep))
        return name

    each = plan.select("ep", "new_ep", "start", "stop", camera)
    return each.select(path(source, "ep").alias("source"), path(target, "new_ep").alias("target"), "start", "stop")


def link_or_copy(source: str, target: str) -> None:
    """A hard link, or a copy where the two are on different devices."""
    Path(target).parent.mkdir(parents=True, exist_ok=True)
    try:
        os.link(source, target)
    except FileExistsError:
        os.remove(target)
        link_or_copy(source, target)
    except OSError as problem:
        if problem.errno != errno.EXDEV:
            raise
        shutil.copy2(source, target)


def frame_count(path: str, ffprobe: str) -> int:
    ask = [ffprobe, "-v", "error", "-select_streams", "v:0", "-show_entries", "stream=nb_frames", "-of", "default=nokey=1:noprint_wrappers=1", path]
    return int(subprocess.run(ask, check=True, capture_output=True, text=True).stdout.strip())


def cut(source: str, target: str, start: int, stop: int, fps: float, crf: int, preset: str, commands: tuple[str, str]) -> None:
    """Frames start to stop of a video, encoded anew, with a key frame a second; written beside its place and then moved."""
    Path(target).parent.mkdir(parents=True, exist_ok=True)
    part = f"{target}.part.mp4"
    every = str(round(fps))
    # fixed values: the encoding that a rebuilt dataset's metadata states
    encode = ["-c:v", "libx264", "-preset", preset, "-crf", str(crf), "-pix_fmt", "yuv420p", "-r", str(fps), "-fps_mode", "cfr", "-g", every, "-keyint_min", every, "-sc_threshold", "0", "-threads", "2"]
    frames = ["-vf", f"trim=start_frame={start}:end_frame={stop},setpts=PTS-STARTPTS", "-frames:v", str(stop - start)]
    subprocess.run([commands[0], "-nostdin", "-hide_banner", "-loglevel", "error", "-y", "-i", source, "-an", *frames, *encode, "-movflags", "+faststart", part], check=True)
    if (n := frame_count(part, commands[1])) != stop - start:
        raise RuntimeError(f"{target}: expected {stop - start} frames, found {n}")
    os.replace(part, target)


def complete(target: str, n: int, ffprobe: str) -> bool:
    try:
        return frame_count(target, ffprobe) == n
    except (OSError, subprocess.SubprocessError, ValueError):
        return False


def run(spark: SparkSession, todo: DataFrame, how: str, fps: float = 30.0, crf: int = 18, preset: str = "veryfast", resume: bool = False, workers: int | None = None) -> int:
    """Does the jobs, `carry` (whole files) or `cut`, a task each; with `resume` cuts whose target has its frames already are left. Returns how many were done."""

    commands = tools()

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            done = 0
            for r in batch.itertuples(index=False):
                source, target = r.source.removeprefix("file://"), r.target.removeprefix("file://")
                if how == "carry":
                    link_or_copy(source, target)
                elif resume and complete(target, r.stop - r.start, commands[1]):
                    continue
                else:
                    cut(source, target, r.start, r.stop, fps, crf, preset, commands)
                done += 1
            yield pd.DataFrame({"done": [done]})

    spread = todo.repartition(workers or max(1, min(10_000, todo.count())), "target")
    return spread.mapInPandas(work, "done long").agg(F.coalesce(F.sum("done"), F.lit(0))).first()[0]


def faults(todo: DataFrame, count_frames: bool) -> int:
    """Jobs whose target isn't there, or has other than stop - start frames."""

    ffprobe = tools()[1]

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            bad = 0
            for r in batch.itertuples(index=False):
                target = r.target.removeprefix("file://")
                bad += not (complete(target, r.stop - r.start, ffprobe) if count_frames else os.path.isfile(target))
            yield pd.DataFrame({"bad": [bad]})

    return todo.mapInPandas(look, "bad long").agg(F.coalesce(F.sum("bad"), F.lit(0))).first()[0]


def can_cut() -> bool:
    return all(map(shutil.which, tools()))
