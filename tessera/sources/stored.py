"""Tables that are built once and read by several queries, in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_BUILT: dict[tuple[str, str, str], str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; a temporary one only where all run on one machine and none is named."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not named:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tessera-"))
        named = sc.getCheckpointDir()
    return named.rstrip("/")


def built_once(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The table that build makes of the tables in sf_dir, written by the application's first query that needs it."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _BUILT:
        path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        build().write.parquet(path)
        _BUILT[key] = path
    return spark.read.parquet(_BUILT[key])


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and reread: what follows in one query does not compute them again."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
