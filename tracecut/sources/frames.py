"""Frames from recordings on disk, and from the tables that stand in for them."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

EPISODE_FILE = r"episode_(\d+)\.parquet$"
#: Columns of a recording and the names they have here.
SIGNALS = {"observation.state.joint": "joint", "observation.gripper_position": "gripper", "observation.state.end": "end_pose", "actions": "action"}


def episode_files(spark: SparkSession, root: str, rename: bool = True) -> DataFrame:
    """All columns of data/**/episode_*.parquet, with ep from the file's name and f from the row's place in it; arrays of signals by their short names."""
    raw = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "episode_*.parquet").parquet(f"{root}/data")
    name = F.regexp_extract(F.col("_metadata.file_name"), EPISODE_FILE, 1).cast("long")
    return raw.select(name.alias("ep"), F.col("_metadata.row_index").alias("f"), *(F.col(f"`{c}`").alias(SIGNALS.get(c, c) if rename else c) for c in raw.columns))


def original(frames: DataFrame, like: DataFrame | None = None) -> DataFrame:
    """frames with the recordings' own column names; with `like`, a recording read under these, also its columns in its order and types.

    A column that replaces one which the recording doesn't have is an error.
    """
    back = {v: k for k, v in SIGNALS.items()}
    named = frames.withColumnsRenamed({c: back[c] for c in frames.columns if c in back})
    if like is None:
        return named
    if lost := [c for c in ("timestamp", "frame_index", "episode_index", "index") if c not in like.columns]:
        raise ValueError(f"the recordings have no column {lost[0]}")
    return named.select("ep", "f", *(F.col(f"`{x.name}`").cast(x.dataType).alias(x.name) for x in like.schema.fields if x.name not in ("ep", "f")))


def episode_path(info: dict, root: str, episode: int, chunk: int) -> str:
    """The place of an episode's file, by the template of the metadata where it has one."""
    template = info.get("data_path", "data/chunk-{episode_chunk:03d}/episode_{episode_index:06d}.parquet")
    return f"{root}/" + template.format(episode_chunk=episode // chunk, episode_index=episode)


def channels(frames: DataFrame, wanted: dict[str, tuple[str, int]]) -> DataFrame:
    """ep, f and one DOUBLE column a channel; wanted: name -> (array column, index from 0). Arithmetic is in DOUBLE throughout."""
    return frames.select("ep", "f", *(F.get(F.col(c), F.lit(i)).cast("double").alias(n) for n, (c, i) in wanted.items()))


def positions(names: list[str], suffix: str) -> list[int]:
    """Places of the channel names that end so, in declared order."""
    return [i for i, n in enumerate(names) if n.endswith(suffix)]


def document(spark: SparkSession, path: str) -> dict:
    """A JSON document of any store that Spark reads."""
    return json.loads("\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect()))


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines; blank ones are skipped."""
    lines = spark.read.text(path).filter("trim(value) <> ''")
    return lines.select(F.from_json("value", schema).alias("x")).select("x.*")


def json_objects(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines by the columns that they have; blank ones are skipped."""
    return spark.read.option("mode", "FAILFAST").json(path)


def annotations(spark: SparkSession, folder: str) -> DataFrame:
    """ep, ordinal, subtask, start, stop, start_time, stop_time: a row per labelled interval of split/episode_*.json, one of nulls for an episode without any, and how many texts, starts and stops the episode has."""
    schema = "index long, name string, sub_task struct<subtask array<string>, start_time array<double>, end_time array<double>, start_frame array<long>, end_frame array<long>>"
    raw = spark.read.schema(schema).option("multiLine", True).option("pathGlobFilter", "episode_*.json").json(folder)
    s = F.arrays_zip("sub_task.subtask", "sub_task.start_frame", "sub_task.end_frame", "sub_task.start_time", "sub_task.end_time")
    sizes = [F.coalesce(F.size(f"sub_task.{c}"), F.lit(0)).alias(n) for c, n in (("subtask", "n_texts"), ("start_frame", "n_starts"), ("end_frame", "n_stops"))]
    each = raw.select(F.col("index").alias("ep"), *sizes, F.posexplode_outer(s).alias("ordinal", "x"))
    fields = (("subtask", "subtask"), ("start_frame", "start"), ("end_frame", "stop"), ("start_time", "start_time"), ("end_time", "stop_time"))
    return each.select("ep", "n_texts", "n_starts", "n_stops", "ordinal", *(F.col(f"x.{c}").alias(n) for c, n in fields))


def csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def event_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users as episodes of `events`: v the value, a the number in props."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    order = Window.partitionBy("ep").orderBy("ts", "event_id")
    raw = events.select(F.col("user_id").alias("ep"), "ts", "event_id", F.col("value").alias("v"), F.get_json_object("props", "$.k").cast("double").alias("a"))
    return raw.select("ep", (F.row_number().over(order) - 1).cast("long").alias("f"), "v", "a")


def vector_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels as episodes of `embeddings`: x the vector."""
    raw = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("label").cast("long").alias("ep"), "vec_id", F.col("embedding").cast("array<double>").alias("x"))
    order = Window.partitionBy("ep").orderBy("vec_id")
    return raw.select("ep", (F.row_number().over(order) - 1).cast("long").alias("f"), "x")
