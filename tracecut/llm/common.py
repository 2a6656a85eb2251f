"""What the corpus operators share: tables, shared working storage, and Arrow batch mapping."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tracecut.sources.store import written

#: Rows of an Arrow batch sent to Python; Spark also bounds a batch's bytes.
BATCH_ROWS = 1000

#: Rows up to which the smaller side of a join is broadcast.
BROADCAST_ROWS = 200_000
#: A key is hot that more rows have than this, and than a HOT_SHARE-th of all rows; so there are fewer than HOT_SHARE hot keys, however long the table.
HOT_ROWS, HOT_SHARE = 1_000, 50_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def joined(many: DataFrame, few: DataFrame, key: str, how: str = "inner", broadcast_rows: int | None = None) -> DataFrame:
    """many with the columns of few, which has one row a key; how: inner or left.

    Up to BROADCAST_ROWS rows few is broadcast. Above that both are dealt out by key, but for hot keys:
    their rows of few, HOT_SHARE at most, are broadcast, and rows without a key stay where they are, so
    no task gets more than its share. Both tables are read several times: they should be written ones.
    """
    if few.count() <= (BROADCAST_ROWS if broadcast_rows is None else broadcast_rows):
        return many.join(F.broadcast(few), key, how)
    keyed = many.filter(F.col(key).isNotNull())
    sizes = keyed.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    hot = written(sizes.filter(F.col("__n") > max(HOT_ROWS, many.count() // HOT_SHARE)).select(key))
    if hot.isEmpty():
        out = keyed.join(few, key, how)
    else:
        hot_few = F.broadcast(few.join(F.broadcast(hot), key))
        out = keyed.join(F.broadcast(hot), key, "left_semi").join(hot_few, key, how).unionByName(keyed.join(F.broadcast(hot), key, "left_anti").join(few, key, how))
    if how == "inner":
        return out
    return out.unionByName(many.filter(F.col(key).isNull()), allowMissingColumns=True)


def field(df: DataFrame, name: str) -> T.StructField:
    return next(f for f in df.schema.fields if f.name == name)


def check_names(key: str, outputs: list[str]) -> None:
    if key in outputs:
        raise ValueError(f"the key column may not be named {key}: the result has a column of that name")


def hand_back() -> None:
    """Gives the memory that a task has freed back to the system: its Python worker stays, for other tasks."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def map_columns(df: DataFrame, fn: Callable[[], Callable[..., tuple]], schema: T.StructType) -> DataFrame:
    """Arrow batches through Python: fn() makes, once a task, a function from column lists to column lists."""
    target = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = None
        for batch in batches:
            if batch.num_rows:
                step = step or fn()
                out = step(*(c.to_pylist() for c in batch.columns))
                yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, f.type) for x, f in zip(out, target, strict=True)], schema=target)
        step = out = batch = None
        hand_back()

    return df.mapInArrow(run, schema)
