"""What the operators of this folder share: scratch tables, text access, small Arrow helpers."""

from __future__ import annotations

import ctypes
import gc
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Separator class of the word definition used by several contracts: space and \t \n \v \f \r.
WORD_GAP = r"[\x20\x09-\x0D]+"

#: Rows and bytes handed to Python at once.
ARROW_ROWS, ARROW_BYTES = 2000, 8 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings that the Python stages rely on: small Arrow batches, whatever the length of texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one only where all run on one machine and none is named."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not named:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tessera-"))
        named = sc.getCheckpointDir()
    return named.rstrip("/")


def scratch(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"


def staged(df: DataFrame, tag: str) -> DataFrame:
    """Write df as a table in the shared folder and read it again: lineage ends there and lost executors cost nothing."""
    spark = df.sparkSession
    path = scratch(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(df: DataFrame) -> None:
    """Delete a table made by staged() that nothing needs any longer."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    parents = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    for folder in parents:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents; a file that cannot be split is dealt over the cores once, larger tables are read as they lie."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    cores = spark.sparkContext.defaultParallelism
    return docs.repartition(cores) if docs.rdd.getNumPartitions() < cores else docs


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the key and the whole text; a null text counts as empty."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def give_back() -> None:
    """Return what a finished task has freed to the system: workers stay alive between stages and share an executor's memory."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """mapInArrow whose tasks give their memory back at the end."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return df.mapInArrow(whole, schema)


def map_rows(df: DataFrame, rows: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]], schema) -> DataFrame:
    """mapInArrow for a generator of dicts of equally long column lists; schema as createDataFrame takes it."""
    struct = df.sparkSession.createDataFrame([], schema).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(struct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols in rows(batches):
            yield pa.RecordBatch.from_arrays([cols[f.name] if isinstance(cols[f.name], pa.Array) else pa.array(cols[f.name], type=f.type) for f in arrow], schema=arrow)

    return map_batches(df, run, struct)
