"""The workflows from a shell: python -m tracecut.cli COMMAND …"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from tracecut.plans import workflows as W
from tracecut.sources import sinks


def positive(text: str) -> int:
    if (n := int(text)) <= 0:
        raise argparse.ArgumentTypeError("must be positive")
    return n


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tracecut", description="Curates recordings of robot arms.")
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, text: str, *, output: bool | None = True) -> argparse.ArgumentParser:
        p = commands.add_parser(name, help=text, description=text)
        p.add_argument("--source", "--dataset", dest="source", required=True, help="the dataset to read")
        if output is not None:
            p.add_argument("--output", required=output)
        return p

    def video(p: argparse.ArgumentParser) -> None:
        p.add_argument("--media", choices=("none", "cut"), default="none", help="what becomes of the camera videos")
        p.add_argument("--crf", type=int, default=18)
        p.add_argument("--preset", default="veryfast")
        p.add_argument("--workers", type=positive, default=None, help="videos cut at once")

    p = command("split", "Detects the cuts of each episode and writes its segments.")
    p.add_argument("--detect-only", action="store_true")
    p.add_argument("--overwrite", action="store_true")
    p.add_argument("--max-episodes", type=positive)
    p = command("sync", "Brings frames, annotations and segments in line with hand-edited cut times.")
    p.add_argument("--dry-run", action="store_true")
    for place in ("summary", "cut-points", "split-output", "parquet-output"):
        p.add_argument(f"--{place}")
    p = command("pipeline", "Split, then sync.")
    p.add_argument("--overwrite", action="store_true")
    p.add_argument("--reuse-summary", action="store_true")
    p.add_argument("--max-episodes", type=positive)
    p = command("trim", "Drops the still start of each episode.", output=False)
    p.add_argument("--detect-only", action="store_true")
    p.add_argument("--report")
    p.add_argument("--cuts", help="an edited report, whose trim_frame replaces what was detected")
    p.add_argument("--joint-threshold", type=float, default=0.005)
    p.add_argument("--gripper-threshold", type=float, default=0.01)
    p.add_argument("--sustain-frames", type=int, default=3)
    p.add_argument("--pre-roll-frames", type=int, default=3)
    p.add_argument("--max-episodes", type=positive)
    video(p)
    p = command("filter", "Drops episodes with a long pause.", output=False)
    p.add_argument("--detect-only", action="store_true")
    p.add_argument("--report")
    p.add_argument("--smooth-frames", type=int, default=7)
    p.add_argument("--speed-threshold-mm-s", type=float, default=10.5)
    p.add_argument("--min-pause-seconds", type=float, default=1.0)
    p.add_argument("--ignore-opening-seconds", type=float, default=0.2)
    p.add_argument("--release-delta", type=float, default=0.12)
    p.add_argument("--release-sustain-frames", type=int, default=3)
    p.add_argument("--media", choices=("none", "carry"), default="none")
    p = command("clean", "Trim, then filter.")
    p.add_argument("--trimmed-output")
    p.add_argument("--media", choices=("none", "cut"), default="none")
    p = command("convert", "Turns labelled intervals into episodes.")
    p.add_argument("--split-dir")
    p.add_argument("--task-spec", required=True)
    p.add_argument("--max-source-episodes", type=positive)
    p.add_argument("--resume", action="store_true")
    video(p)
    p = command("validate", "Checks a dataset.", output=None)
    p.add_argument("--decode-samples", type=int, default=0)
    return top


def check(p: argparse.ArgumentParser, a: argparse.Namespace) -> None:
    """What belongs together, or doesn't."""
    if a.command in ("trim", "filter"):
        if a.detect_only and a.output:
            p.error("--detect-only cannot be combined with --output")
        if a.detect_only and not a.report:
            p.error("--detect-only requires --report")
        if a.detect_only and getattr(a, "cuts", None):
            p.error("--detect-only cannot be combined with --cuts")
        if not a.detect_only and not a.output:
            p.error("--output is required, or --detect-only")


def run(spark: SparkSession, a: argparse.Namespace) -> int:
    if not sinks.exists(spark, f"{a.source}/meta/info.json"):
        raise FileNotFoundError(f"{a.source} is not a dataset: it has no meta/info.json")
    encode = {k: getattr(a, k) for k in ("crf", "preset", "workers") if hasattr(a, k)}
    if a.command == "split":
        counts = {r.status: r.n for r in W.C.status_counts(W.split(spark, a.source, a.output, a.detect_only, a.max_episodes, a.overwrite)).collect()}
        print(json.dumps(counts | {"output": a.output}))
        return 1 if counts["error"] else 0
    if a.command in ("sync", "pipeline"):
        if a.command == "sync":
            found = W.sync(spark, a.source, a.output, a.dry_run, None, a.summary, a.cut_points, a.split_output, a.parquet_output)
        else:
            found = W.split_and_sync(spark, a.source, a.output, a.overwrite, a.reuse_summary, a.max_episodes)
        print(f"Episodes: {found.count()}; changed: {found.filter('changed').count()}")
        for r in found.filter("changed").orderBy("ep").toLocalIterator():
            print(f"  episode {r.ep:06d}: {list(r.old_frames)} -> {list(r.new_frames)}")
        return 0
    if a.command == "trim":
        given = W.overrides_of(spark, a.cuts) if a.cuts else None
        out = W.trim(spark, a.source, a.output, a.report, a.media, encode, joint=a.joint_threshold, gripper=a.gripper_threshold, sustain=a.sustain_frames, pre_roll=a.pre_roll_frames, overrides=given, max_episodes=a.max_episodes)
    elif a.command == "filter":
        out = W.filter_pauses(
            spark, a.source, a.output, a.report, a.media, smooth=a.smooth_frames, speed_mm_s=a.speed_threshold_mm_s, pause_s=a.min_pause_seconds,
            opening_s=a.ignore_opening_seconds, delta=a.release_delta, sustain=a.release_sustain_frames,
        )
    elif a.command == "clean":
        out = W.clean(spark, a.source, a.output, a.trimmed_output, a.media)
    elif a.command == "convert":
        plan = W.convert(spark, a.source, a.output, a.task_spec, a.split_dir, a.max_source_episodes, a.media, encode, a.resume)
        out = {"output": a.output, "episodes": plan.count(), "frames": plan.agg({"length": "sum"}).first()[0]}
    else:
        out = W.validate(spark, a.source, a.decode_samples)
        print(json.dumps(out, indent=2))
        return 1 if any(out.values()) else 0
    print(json.dumps(out, ensure_ascii=False, indent=2))
    return 0


def main(argv: list[str] | None = None) -> int:
    p = parser()
    a = p.parse_args(argv)
    check(p, a)
    spark = SparkSession.builder.appName(f"tracecut {a.command}").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        return run(spark, a)
    except (OSError, ValueError, RuntimeError) as problem:
        print(f"{type(problem).__name__}: {problem}", file=sys.stderr)
        return 2


if __name__ == "__main__":
    raise SystemExit(main())
