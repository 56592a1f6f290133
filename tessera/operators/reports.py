"""Profiles of a corpus and its index."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upper_median(values: str) -> Column:
    """The element at n div 2 of the sorted values: the first, from above, with half of the values up to it. Equal values are
    counted together before the shuffle."""
    return F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY {values} DESC)")


def density(chunks: DataFrame, by: Sequence[str], chars: Column, tokens: Column) -> DataFrame:
    """Characters per token by slice: upper median, share of all rows."""
    rows = chunks.withColumn("__density", chars / F.nullif(tokens, F.lit(0)))
    total = rows.agg(F.count("*").alias("__all"))
    grouped = rows.groupBy(*by).agg(F.round(upper_median("__density"), 6).alias("median"), F.count("*").alias("n"))
    return grouped.join(F.broadcast(total)).withColumn("share", F.round(F.col("n") / F.col("__all"), 6)).drop("__all")


def ceiling_sweep(chunks: DataFrame, text: str, ceilings: Sequence[int], tokens, cap: int) -> DataFrame:
    """For each candidate length: the most tokens a cut text has and the share of texts over the cap."""
    rows = chunks.select(F.explode(F.array(*[F.lit(c) for c in ceilings])).alias("ceiling"), text)
    n = tokens(F.expr(f"substring({text}, 1, ceiling)"))
    return rows.groupBy("ceiling").agg(F.max(n).cast("long").alias("most"), F.round(F.avg((n > cap).cast("double")), 6).alias("over"))


def flooding(ranked: DataFrame, k: int = 10) -> DataFrame:
    """Slots of a query's first k taken by a section that already has one."""
    return ranked.filter(F.col("rank") <= k).groupBy("query_id").agg((F.count("*") - F.countDistinct("doc_id", "heading")).alias("repeats"))


def box_share(text: Column) -> Column:
    """Share of box-drawing characters."""
    return F.length(F.regexp_replace(text, "[^─-╿]", "")) / F.nullif(F.length(text), F.lit(0))


def corpus_id(files: DataFrame) -> DataFrame:
    """Identity of a corpus (collection, filename, sha256): twelve hex digits over its sorted lines."""
    line = F.concat(F.concat_ws("/", "collection", "filename"), F.lit("\t"), F.col("sha256"))
    return files.agg(F.concat(F.lit("c:"), F.substring(F.sha2(F.array_join(F.sort_array(F.collect_list(line)), "\n"), 256), 1, 12)).alias("corpus_id"))


def undeclared(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files whose hash does not begin with the one the manifest declares for them."""
    return files.join(manifest.select("collection", "filename", F.col("sha256").alias("declared")), ["collection", "filename"]).filter(~F.expr("startswith(sha256, declared)"))


def score_stats(scores, score: str = "score", limit: float = 0.92) -> DataFrame:
    return scores.agg(F.round(F.median(score), 6).alias("median"), F.count_if(F.col(score) < limit).alias("below"), F.count("*").alias("n"))


def hotspots(lines: DataFrame, limit: float = 0.92, severe: float = 0.80) -> DataFrame:
    """Scored lines (page, line, text, score) that need a look, in order, the worse ones marked."""
    return lines.filter(F.col("score") < limit).withColumn("severe", F.col("score") < severe).orderBy("page", "line")


def only_in(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of either table that the other lacks, with the side they are on; empty if both hold the same rows."""
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionAll(b.exceptAll(a).withColumn("side", F.lit("right")))


def scan_lines(files: DataFrame, rules: Sequence[tuple[str, str]], text: str = "content") -> DataFrame:
    """rel_path, line, rule, text of each line that a rule's pattern matches."""
    lines = files.select("rel_path", F.posexplode(F.split(text, "\n")).alias("at", "line_text"))
    hits = F.filter(F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(p).alias("pattern")) for n, p in rules]), lambda r: F.rlike(F.col("line_text"), r["pattern"]))
    return lines.withColumn("hit", F.explode(hits)).select("rel_path", (F.col("at") + 1).alias("line"), F.col("hit.rule").alias("rule"), "line_text")
