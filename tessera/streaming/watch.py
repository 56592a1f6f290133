"""Continuous ingestion with Structured Streaming, and event-time windows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera import constants as C
from tessera.functions import text as T
from tessera.operators.layers import first_by, format_priority


def file_stream(spark: SparkSession, root: str, quiet: float = C.QUIET_SECONDS) -> DataFrame:
    """New or changed files below a folder, once they have been quiet for a moment."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    files = spark.readStream.format("binaryFile").schema(schema).option("recursiveFileLookup", True).load(root)
    return files.filter(F.col("modificationTime") < F.current_timestamp() - F.expr(f"interval {int(quiet * 1000)} milliseconds"))


def promotion(state: DataFrame, batch: DataFrame) -> DataFrame:
    """rel_path, sha256, revision, outcome of each file of a batch against what was promoted before.

    Unsupported formats are skipped and empty files rejected; a new path is promoted, another content of a known one is a
    revision, the same content is left alone.
    """
    from tessera.sources.readers import SUPPORTED

    known = state.select("rel_path", F.col("sha256").alias("old"), F.col("revision").alias("old_revision"), F.lit(True).alias("known"))
    rows = first_by(batch, ["rel_path"], [F.desc("modified"), F.asc("sha256")]).join(known, "rel_path", "left")
    outcome = F.when(~T.extension(F.col("rel_path")).isin(*SUPPORTED), "skipped").when(F.col("byte_size") == 0, "rejected").when(F.col("known").isNull(), "promoted").when(F.col("old").eqNullSafe(F.col("sha256")), "unchanged").otherwise("revised")
    rows = rows.withColumn("outcome", outcome)
    revision = F.coalesce(F.col("old_revision"), F.lit(0)) + F.when(F.col("outcome") == "revised", 1).otherwise(0)
    return rows.select("rel_path", "sha256", revision.alias("revision"), "outcome")


def next_state(state: DataFrame, promoted: DataFrame) -> DataFrame:
    """State after a batch: promoted and revised files replace what was known of their paths."""
    new = promoted.filter(F.col("outcome").isin("promoted", "revised")).select("rel_path", "sha256", "revision")
    return new.unionByName(state.select("rel_path", "sha256", "revision").join(new.select("rel_path"), "rel_path", "left_anti"))


def seed_set(files: DataFrame, existing: DataFrame) -> DataFrame:
    """Of files that differ only in format the best one, unless the path is there already."""
    stem = F.regexp_replace("rel_path", r"\.[^.]+$", "")
    best = first_by(files.withColumn("stem", stem), ["stem"], [F.desc(format_priority(F.col("rel_path"))), F.asc("rel_path")]).drop("stem")
    return best.join(existing.select("rel_path"), "rel_path", "left_anti")


def rebuild_on_change(stream: DataFrame, rebuild: Callable[[DataFrame, int], None], checkpoint: str, on_error: Callable[[Exception], None] | None = None, once: bool = False):
    """Run rebuild on every batch; a failed build is reported and the loop goes on."""

    def step(batch: DataFrame, number: int) -> None:
        try:
            rebuild(batch, number)
        except Exception as e:  # the loop outlives a failed build
            if on_error is None:
                raise
            on_error(e)

    writer = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="2 seconds")).start()


def tumbling(events: DataFrame, length: str, keys: list[str | Column], lateness: str | None = None) -> DataFrame:
    rows = events.withWatermark("ts", lateness) if lateness else events
    return rows.groupBy(F.window("ts", length).alias("w"), *keys).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


def sliding(events: DataFrame, length: str, step: str, keys: list[str]) -> DataFrame:
    return events.groupBy(F.window("ts", length, step).alias("w"), *keys).agg(F.count("*").alias("n"))


def sessions(events: DataFrame, gap: str, keys: list[str]) -> DataFrame:
    return events.groupBy(F.session_window("ts", gap).alias("w"), *keys).agg(F.count("*").alias("n"))


def deduplicated(events: DataFrame, keys: list[str], lateness: str) -> DataFrame:
    """First event of each key within the watermark; on a batch table, the first at all."""
    if events.isStreaming:
        return events.withWatermark("ts", lateness).dropDuplicatesWithinWatermark(keys)
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("ts", "event_id"))
    return events.withColumn("__place", place).filter("__place = 1").drop("__place")
