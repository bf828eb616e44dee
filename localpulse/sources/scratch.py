"""Tables written to the folder that the cluster shares, to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: list[str] = []


def new_path(spark: SparkSession, tag: str) -> str:
    """A new path under ``spark.checkpoint.dir``; under a folder of our own only where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getConf().get("spark.checkpoint.dir", "")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if not _OWN:
            _OWN.append(f"file://{tempfile.mkdtemp(prefix='localpulse-')}")
        base = _OWN[0]
    return f"{base.rstrip('/')}/market/{tag}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, tag: str) -> DataFrame:
    path = new_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
