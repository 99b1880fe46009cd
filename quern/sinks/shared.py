"""Tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession) -> str:
    """A new path in the folder named by ``spark.checkpoint.dir``; where it is unset (tests), in a temporary one."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return f"{named.rstrip('/') if named else 'file://' + tempfile.mkdtemp(prefix='quern-shared-')}/{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """The rows, written and read again: what rests on them several times computes them once, and a lost executor costs a reread."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
