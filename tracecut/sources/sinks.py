"""Sinks: one Parquet file an episode, reports, JSON documents and lines, and publishing by rename.

Paths go through Hadoop's file system, so any store that Spark writes to will do.
"""

from __future__ import annotations

import csv
import io
import json
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Columns of the reports, in order. Fixed values of the file formats.
TRIM_FIELDS = ["episode_index", "source_length", "motion_frame", "motion_time", "trim_frame", "trim_time", "removed_frames", "output_length", "trigger", "cut_source"]
PAUSE_FIELDS = [
    "episode_index", "episode_frames", "insertion_start_frame", "insertion_start_seconds", "release_frame", "release_seconds",
    "pause_start_frame", "pause_start_seconds", "pause_end_frame", "pause_end_seconds", "pause_frames", "pause_seconds",
]
CUT_FIELDS = [
    "episode_index", "status", "cut1_frame", "cut1_time", "cut1_motor", "cut2_frame", "cut2_time", "cut3_frame", "cut3_time", "cut3_return_motors", "cut3_left_start_frame",
    "cut3_left_start_motor", "cut4_frame", "cut4_time", "cut4_motors", "task_end_status", "task_end_frame", "task_end_time", "task_end_motors", "task_end_error", "right_gripper_closures", "error",
]
REWARDS = ["success", "failure", "pick_success", "place_success", "empty_pick", "empty_place", "drop", "collision"]


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return fs.exists(p)


def rename(spark: SparkSession, source: str, target: str) -> None:
    fs, p, jvm = _fs(spark, source)
    to = jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(to.getParent())
    if not fs.rename(p, to):
        raise OSError(f"cannot move {source} to {target}")


def remove(spark: SparkSession, path: str) -> None:
    fs, p, _ = _fs(spark, path)
    fs.delete(p, True)


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Written beside its place first, and moved over it in one step. Without a checksum file, so that it may be edited by hand."""
    part = f"{path}.{uuid.uuid4().hex}.tmp"
    fs, p, jvm = _fs(spark, part)
    fs.setWriteChecksum(False)
    try:
        out = fs.create(p, True)
        out.write(bytearray(text.encode()))
        out.close()
    finally:
        fs.setWriteChecksum(True)
    over = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    over[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(fs.makeQualified(p), fs.makeQualified(jvm.org.apache.hadoop.fs.Path(path)), over)


def get_text(spark: SparkSession, path: str) -> str:
    return "\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect())


def put_json(spark: SparkSession, path: str, value: object, indent: int | None = 2) -> None:
    put_text(spark, path, json.dumps(value, ensure_ascii=False, indent=indent) + "\n")


def put_lines(spark: SparkSession, path: str, rows: DataFrame, shape: Callable[[dict], dict] = dict) -> None:
    """A row a JSON line, without blanks, each as `shape` gives it; for metadata with a row an episode."""
    put_text(spark, path, "".join(json.dumps(shape(r.asDict(True)), ensure_ascii=False, separators=(",", ":")) + "\n" for r in rows.toLocalIterator()))


def csv_text(rows: list[dict], fields: list[str]) -> str:
    out = io.StringIO()
    writer = csv.DictWriter(out, fields, extrasaction="ignore", lineterminator="\r\n")
    writer.writeheader()
    for r in rows:
        writer.writerow({k: "" if v is None else v for k, v in r.items()})
    return out.getvalue()


def put_csv(spark: SparkSession, path: str, rows: DataFrame, fields: list[str]) -> None:
    """A report with a row an episode; nulls are blank."""
    put_text(spark, path, csv_text([r.asDict() for r in rows.toLocalIterator()], fields))


def put_episodes(frames: DataFrame, root: str, chunk: int = 1000, segment: str | None = None, overwrite: bool = False, keep_others: bool = False) -> None:
    """root/chunk-NNN/episode_NNNNNN.parquet, or root/episode_NNNNNN/segment_NN.parquet with a segment column, in frame order.

    Rows of an episode meet in one task, which writes its file; files then get their names, many at once.
    An existing root is an error unless overwritten; with keep_others only the files given are replaced.
    """
    spark = frames.sparkSession
    if exists(spark, root) and not (overwrite or keep_others):
        raise FileExistsError(root)
    keys = ["ep"] + ([segment] if segment else [])
    part = f"{root}.{uuid.uuid4().hex}.building"
    (
        frames.withColumns({f"__{k}": F.col(k) for k in keys}).repartition(*keys).sortWithinPartitions(*keys, "f").drop(*keys, "f")
        .write.option("compression", "zstd").option("maxRecordsPerFile", 0).partitionBy(*(f"__{k}" for k in keys)).parquet(part)
    )
    if exists(spark, root) and not keep_others:
        remove(spark, root)
    fs, p, _ = _fs(spark, part)
    files, moves = fs.listFiles(p, True), []
    while files.hasNext():
        path = files.next().getPath().toString()
        bits = dict(b.split("=", 1) for b in path.split("/") if b.startswith("__") and "=" in b)
        if bits:
            ep = int(bits["__ep"])
            moves.append((path, f"{root}/episode_{ep:06d}/segment_{int(bits[f'__{segment}']):02d}.parquet" if segment else f"{root}/chunk-{ep // chunk:03d}/episode_{ep:06d}.parquet"))

    def move(pair: tuple[str, str]) -> None:
        if keep_others and exists(spark, pair[1]):
            remove(spark, pair[1])
        rename(spark, *pair)

    with ThreadPoolExecutor(16) as pool:
        list(pool.map(move, moves))
    remove(spark, part)


def outside(source: str, target: str) -> None:
    if f"{target.rstrip('/')}/".startswith(f"{source.rstrip('/')}/"):
        raise ValueError(f"{target} lies in its source")


class Staged:
    """A dataset built beside its place, and moved there when the block ends well; what a failed one left is kept for a look, and for `resume`, which starts on it."""

    def __init__(self, spark: SparkSession, source: str, target: str, resume: bool = False):
        if exists(spark, target):
            raise FileExistsError(target)
        outside(source, target)
        head, _, tail = target.rstrip("/").rpartition("/")
        self.spark, self.target, self.path, self.resume = spark, target.rstrip("/"), f"{head}/.{tail}.building", resume

    def __enter__(self) -> str:
        if exists(self.spark, self.path):
            if not self.resume:
                raise FileExistsError(self.path)
            # videos are what takes long; all else is written anew
            for part in ("data", "meta"):
                remove(self.spark, f"{self.path}/{part}")
        return self.path

    def __exit__(self, kind, *_: object) -> None:
        if kind is None:
            rename(self.spark, self.path, self.target)


def back_up(spark: SparkSession, folder: str, files: list[str]) -> str:
    """Copies of files in a new folder of the time in UTC."""
    to = f"{folder}/{datetime.now(timezone.utc):%Y%m%dT%H%M%SZ}-{uuid.uuid4().hex[:6]}"
    fs, p, jvm = _fs(spark, to)
    fs.mkdirs(p)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for f in files:
        source = jvm.org.apache.hadoop.fs.Path(f)
        jvm.org.apache.hadoop.fs.FileUtil.copy(fs, source, fs, jvm.org.apache.hadoop.fs.Path(p, source.getName()), False, conf)
    return to


def trim_report(points: DataFrame, fps: float) -> DataFrame:
    """The rows of TRIM_FIELDS of trim points with their cut_source."""
    return points.orderBy("ep").select(
        F.col("ep").alias("episode_index"), F.col("length").alias("source_length"), F.col("motion").alias("motion_frame"), (F.col("motion") / fps).alias("motion_time"),
        F.col("trim").alias("trim_frame"), (F.col("trim") / fps).alias("trim_time"), F.col("trim").alias("removed_frames"), (F.col("length") - F.col("trim")).alias("output_length"),
        "trigger", "cut_source",
    )


def cut_report(cuts: DataFrame) -> DataFrame:
    """The rows of CUT_FIELDS of find_cuts with the times time1..time4 and task_end_time."""
    col, fine = F.col, F.col("status") == "ok"
    return cuts.orderBy("ep").select(
        col("ep").alias("episode_index"), "status", *(x for i in range(1, 5) for x in (col(f"cut{i}").alias(f"cut{i}_frame"), col(f"time{i}").alias(f"cut{i}_time"))),
        col("cut1_channel").alias("cut1_motor"), col("cut3_channels").alias("cut3_return_motors"), col("left_start").alias("cut3_left_start_frame"), col("left_start_channel").alias("cut3_left_start_motor"),
        col("cut4_channels").alias("cut4_motors"), F.when(fine, F.when(col("task_end").isNotNull(), "ok").otherwise("unavailable")).alias("task_end_status"), col("task_end").alias("task_end_frame"), "task_end_time",
        col("task_end_channels").alias("task_end_motors"), "task_end_error", col("n_closures").alias("right_gripper_closures"), "error",
    )


def pause_report(pauses: DataFrame, fps: float) -> DataFrame:
    """The rows of PAUSE_FIELDS of the episodes with a pause; pauses: longest_pause with length."""
    pairs = {"insertion_start": "insertion", "release": "release", "pause_start": "start", "pause_end": "stop"}
    each = [x for n, c in pairs.items() for x in (F.col(c).alias(f"{n}_frame"), (F.col(c) / fps).alias(f"{n}_seconds"))]
    n = F.col("stop") - F.col("start")
    return pauses.filter("start IS NOT NULL").orderBy("ep").select(F.col("ep").alias("episode_index"), F.col("length").alias("episode_frames"), *each, n.alias("pause_frames"), (n / fps).alias("pause_seconds"))


def split_document(ep: int, times: list[float], cuts: list[int], duration: float, length: int, texts: list[str], task_end: dict | None = None) -> dict:
    """The annotation of an episode with four cuts: each subtask from its cut to the next, the last to the end; times to milliseconds."""
    t = [round(x, 3) for x in times]
    out = {
        "index": ep,
        "name": f"episode_{ep:06d}.mp4",
        "sub_task": {"subtask": texts, "start_time": t, "end_time": [*t[1:], round(duration, 3)], "start_frame": cuts, "end_frame": [*cuts[1:], length]},
        "idle_frames": {k: [] for k in ("start_time", "end_time", "start_frame", "end_frame")},
        "reward": {k: [] for k in REWARDS},
    }
    return out if task_end is None else out | {"task_end": task_end}
