"""Blocking data-quality audits: each returns the rows that violate it; run_audits raises if any does."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class AuditError(RuntimeError):
    """An audit found violating rows."""


def not_null(df: DataFrame, *columns: str) -> DataFrame:
    return df.filter(" OR ".join(f"`{c}` IS NULL" for c in columns))


def unique_values(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("n")).filter("n > 1")


def text_not_blank(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull() | (F.length(F.trim(F.col(column))) == 0))


def no_self_loops(df: DataFrame, source: str, target: str) -> DataFrame:
    return df.filter(F.col(source) == F.col(target))


def endpoints_resolved(df: DataFrame, source: str = "source_node_id", target: str = "target_node_id") -> DataFrame:
    return not_null(df, source, target)


def every_document_chunked(documents: DataFrame, chunks: DataFrame) -> DataFrame:
    return documents.join(chunks.select("doc_id"), "doc_id", "left_anti")


def sections_survived(chunks: DataFrame, profiled: tuple[str, ...]) -> DataFrame:
    """Documents of a profiled type left with one single chunk without heading."""
    per_doc = chunks.filter(F.col("doc_type").isin(*profiled)).groupBy("doc_id").agg(F.count("*").alias("n"), F.max(F.trim(F.coalesce("heading", F.lit("")))).alias("heading"))
    return per_doc.filter("n = 1 AND heading = ''")


def run_audits(audits: dict[str, Callable[[], DataFrame]]) -> None:
    failed = [name for name, audit in audits.items() if audit().limit(1).count()]
    if failed:
        raise AuditError(", ".join(failed))
