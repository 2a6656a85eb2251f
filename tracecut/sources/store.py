"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def work_dir(spark: SparkSession) -> str:
    """A new path under spark.checkpoint.dir; a session without that setting, as in tests, gets a temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        app = spark.sparkContext.applicationId
        if app not in _own:
            _own[app] = tempfile.mkdtemp(prefix="tracecut-")
        base = _own[app]
    return f"{base.rstrip('/')}/tracecut-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """df as a table there, read again, so that what follows neither repeats nor loses it."""
    path = work_dir(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
