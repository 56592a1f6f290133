"""Readers: raw files, tables, small configuration files, and shaping of what connectors fetch."""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import dates
from tessera.functions import text as T

SUPPORTED = (*T.BINARY, *T.TEXTUAL)


def raw_files(spark: SparkSession, root: str, suffixes: Sequence[str] = SUPPORTED) -> DataFrame:
    """rel_path, content, byte_size, source_modified_at of all supported files below a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    base = root.rstrip("/").split("://")[-1].split("file:")[-1].lstrip("/")
    rel = F.regexp_replace(F.regexp_replace("path", "^[a-z0-9]+:/*", ""), f"^{base}/", "")
    return files.withColumn("rel_path", rel).filter(T.extension(F.col("rel_path")).isin(*suffixes)).select("rel_path", "content", F.col("length").alias("byte_size"), F.col("modificationTime").alias("source_modified_at"))


def lake_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def tsv(spark: SparkSession, path: str, columns: Sequence[str], header: bool = False) -> DataFrame:
    """Tab-separated rows without comments and blank lines."""
    lines = spark.read.text(path).filter((F.trim("value") != "") & ~F.startswith(F.ltrim("value"), F.lit("#")))
    cells = lines.select(F.split("value", "\t").alias("c"))
    rows = cells.select(*[F.trim(F.get("c", F.lit(i))).alias(n) for i, n in enumerate(columns)])
    return rows.filter(F.col(columns[0]) != columns[0]) if header else rows


def judgments(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", True).json(path)


class EmptyBatch(ValueError):
    """A batch file without a single query."""


def batch_queries(spark: SparkSession, path: str) -> DataFrame:
    """position, query of a file with one query a line; blank lines and comments fall away, none left is an error."""
    lines = spark.read.text(path).withColumn("at", F.monotonically_increasing_id())
    rows = lines.select("at", F.trim("value").alias("query")).filter((F.col("query") != "") & ~F.startswith("query", F.lit("#")))
    if not rows.limit(1).count():
        raise EmptyBatch(path)
    return rows


def statute_lines(responses: DataFrame, xml: str = "body") -> DataFrame:
    """Lines of the articles in a statute service's XML."""
    return responses.withColumn("content", T.strip_tags(F.regexp_replace(xml, r"<!\[CDATA\[|\]\]>", "")))


def current_statute(hits: DataFrame) -> DataFrame:
    """Of each statute found, the version in force: the newest one already effective."""
    from tessera.operators.layers import first_by

    return first_by(hits.filter(F.col("effective") <= F.col("today")), ["name"], [F.desc("effective"), F.asc("statute_id")])


def attachments(pages: DataFrame, html: str = "html") -> DataFrame:
    """Distinct (book_id, kind) pairs that a bill page's download calls name."""
    pattern = F.lit(r"openBillFile\('[^']*',\s*'([^']+)',\s*'([^']+)'\)")
    both = F.arrays_zip(F.regexp_extract_all(html, pattern, F.lit(1)).alias("book_id"), F.regexp_extract_all(html, pattern, F.lit(2)).alias("kind"))
    return pages.select(*[c for c in pages.columns if c != html], F.explode(F.array_distinct(both)).alias("a")).select("*", "a.book_id", "a.kind").drop("a")


def filing_windows(spans: DataFrame, days: int = 90) -> DataFrame:
    return spans.select("*", F.explode(dates.windows(F.col("start"), F.col("end"), days)).alias("w")).select("*", "w.begin", F.col("w.end").alias("until")).drop("w")


def matching_filings(filings: DataFrame, terms: Sequence[str]) -> DataFrame:
    """Filings whose report name holds any of the terms."""
    folded = ["".join(unicodedata.normalize("NFC", t).split()).lower() for t in terms]
    name = T.company_key(F.col("report_name"))
    return filings.filter(reduce(lambda a, b: a | b, [F.contains(name, F.lit(t)) for t in folded], F.lit(False)))


def companies(names: DataFrame, needle: str, limit: int = 10) -> DataFrame:
    """Companies whose folded name holds the needle, shortest names first."""
    key = T.company_key(F.col("name"))
    return names.filter(F.contains(key, T.company_key(F.lit(needle)))).orderBy(F.length(key), F.asc("name")).limit(limit)


def filing_families(anchors: DataFrame, filings: DataFrame) -> DataFrame:
    """Anchors and all filings of the same company from a week before to a year after, each once, the newest row of an id."""
    from tessera.operators.layers import first_by

    near = filings.join(anchors.select(F.col("corp").alias("corp_a"), F.col("filed").alias("anchor")), (F.col("corp") == F.col("corp_a")) & dates.within(F.col("filed"), F.col("anchor"))).select(*filings.columns)
    return first_by(anchors.select(*filings.columns).unionByName(near), ["filing_id"], [F.desc("filed"), F.asc("report_name")])


#: Fixed: marks of pages that a site serves instead of content to automated readers.
BLOCK_MARKS = ("captcha", "cf-challenge", "access denied", "are you a robot", "unusual traffic", "enable javascript and cookies")


def blocked(body: Column, status: Column | None = None) -> Column:
    """Whether a response is a block page; such a page is reported and left alone."""
    hit = F.exists(F.array(*[F.lit(m) for m in BLOCK_MARKS]), lambda m: F.instr(F.lower(F.substring(body, 1, 20000)), m) > 0)
    return hit | status.isin(403, 429, 503) if status is not None else hit


def allowed(path: Column, rules: Sequence[tuple[bool, str]]) -> Column:
    """Verdict of a robots file's (allow, prefix) rules: the longest prefix decides, allowing where two are as long."""
    verdict = F.lit(True)
    for allow, prefix in sorted(rules, key=lambda r: (len(r[1]), r[0])):
        verdict = F.when(F.startswith(path, F.lit(prefix)), F.lit(allow)).otherwise(verdict)
    return verdict
