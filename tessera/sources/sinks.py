"""Sinks: full refreshes, versioned snapshots with a pointer, exports and manifests."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import schemas
from tessera.operators.layers import first_by


def full_refresh(df: DataFrame, path: str, ddl: str | None = None, partition_by: Sequence[str] = ()) -> None:
    rows = schemas.conform(df, ddl) if ddl else df
    rows.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def upsert_meta(old: DataFrame, new: DataFrame, key: str = "key") -> DataFrame:
    """Key-value rows in which new values replace old ones."""
    return new.unionByName(old.join(new.select(key), key, "left_anti"))


def prune(rows: DataFrame, live: DataFrame, key: str) -> DataFrame:
    return rows.join(live.select(key).distinct(), key, "left_semi")


def write_snapshot(spark: SparkSession, tables: dict[str, DataFrame], root: str, meta: dict[str, str]) -> str:
    """Write tables under a new version and then point to it: readers see the old snapshot or the whole new one."""
    version = uuid.uuid4().hex
    for name, df in tables.items():
        df.write.parquet(f"{root}/{version}/{name}")
    rows = [(k, str(v)) for k, v in sorted({**meta, "version": version}.items())]
    spark.createDataFrame(rows, schemas.META).coalesce(1).write.parquet(f"{root}/{version}/index_meta")
    spark.createDataFrame([(version,)], "version string").withColumn("at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{root}/pointer")
    return version


def open_snapshot(spark: SparkSession, root: str) -> tuple[str, dict[str, str]]:
    """(folder, meta) of the snapshot that the pointer names last."""
    version = spark.read.parquet(f"{root}/pointer").orderBy(F.desc("at"), F.desc("version")).first()["version"]
    meta = {r["key"]: r["value"] for r in spark.read.parquet(f"{root}/{version}/index_meta").collect()}
    return f"{root}/{version}", meta


def export_documents(chunks: DataFrame, schema_version: int = 1) -> DataFrame:
    """One JSON document per doc_id with its chunks in order, keys sorted, no time stamps."""
    item = F.struct("chunk_index", "char_end", "char_start", "chunk_id", "content", "content_sha256", "heading", "token_estimate")
    grouped = chunks.groupBy("doc_id", "rel_path", "doc_type", "title").agg(F.sort_array(F.collect_list(item)).alias("chunks"), F.count("*").alias("chunk_count"))
    return grouped.select("doc_id", F.to_json(F.struct("chunk_count", "chunks", "doc_id", "doc_type", "rel_path", F.lit(schema_version).alias("schema_version"), "title")).alias("json"))


def json_lines(df: DataFrame) -> DataFrame:
    return df.select(F.to_json(F.struct(*sorted(df.columns))).alias("value"))


def graph_feed(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """A drawing's (few) nodes and edges as one JSON row."""
    pack = lambda df, name: df.agg(F.sort_array(F.collect_list(F.to_json(F.struct(*sorted(df.columns))))).alias(name))
    both = pack(nodes, "nodes").join(F.broadcast(pack(edges, "edges")))
    return both.select(F.concat(F.lit('{"edges":['), F.array_join("edges", ","), F.lit('],"nodes":['), F.array_join("nodes", ","), F.lit("]}")).alias("value"))


def best_edges(edges: DataFrame, order: Sequence[str]) -> DataFrame:
    """Insert-or-ignore: the first row of each (source, target, relation) in a total order."""
    return first_by(edges, ["source_id", "target_id", "relation"], [F.asc_nulls_last(c) for c in order])


def file_manifest(spark: SparkSession, root: str) -> DataFrame:
    """path, bytes and sha256 of the files of a snapshot."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return files.select(F.regexp_replace("path", "^.*/", "").alias("path"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def manifest_problems(found: DataFrame, published: DataFrame) -> DataFrame:
    """Files of a published manifest that are missing or differ."""
    both = published.select("path", F.col("sha256").alias("want")).join(found.select("path", "sha256"), "path", "left")
    return both.filter(F.col("sha256").isNull() | (F.col("sha256") != F.col("want"))).select("path", F.when(F.col("sha256").isNull(), "missing").otherwise("differs").alias("problem"))


def release_tag(corpus_id: str, signature: str, chunks: int, vectors: str) -> str:
    import hashlib

    return f"index-{corpus_id.removeprefix('c:')}-{hashlib.sha256(f'{signature}|chunks={chunks}|vec={vectors}'.encode()).hexdigest()[:8]}"
