"""Ranking metrics, regression floors and gates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera import constants as C


def hit_metrics(ranked: DataFrame, relevant: DataFrame, queries: DataFrame, item: str = "item") -> DataFrame:
    """query_id, p1, r5, r10, mrr of each query: whether a relevant item is among the first k (a hit rate, no set recall)."""
    first = ranked.join(relevant, ["query_id", item]).groupBy("query_id").agg(F.min("rank").alias("first"))
    rows = queries.select("query_id").distinct().join(first, "query_id", "left")
    within = lambda k: F.when(F.col("first") <= k, 1.0).otherwise(0.0)
    return rows.select("query_id", within(1).alias("p1"), within(5).alias("r5"), within(10).alias("r10"), F.when(F.col("first") <= 10, 1.0 / F.col("first")).otherwise(0.0).alias("mrr"))


def means(metrics: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Means in four digits over all rows of each arm and of each kind in one pass (grouping sets)."""
    cols = [c for c in ("p1", "r5", "r10", "mrr") if c in metrics.columns]
    return metrics.groupingSets([[F.col(c)] for c in by], *[F.col(c) for c in by]).agg(*[F.round(F.avg(c), 4).alias(c) for c in cols], F.count("*").alias("n"))


def regressions(current: DataFrame, baseline: DataFrame, tolerance: float = C.ARM_TOLERANCE, keys: tuple[str, ...] = ("arm", "metric")) -> DataFrame:
    """Rows of (keys, value) that fell below their baseline by more than the tolerance, or are missing now."""
    both = baseline.select(*keys, F.col("value").alias("base")).join(current.select(*keys, "value"), list(keys), "left")
    return both.filter(F.col("value").isNull() | (F.col("value") < F.col("base") - tolerance))


def resolvable(judgments: DataFrame, items: DataFrame, least: float = 0.6) -> DataFrame:
    """Share of judgments (query_id, pattern) with an item whose heading literally holds the pattern, and the verdict."""
    found = judgments.join(items, F.instr("heading", F.col("pattern")) > 0, "left_semi").select("query_id").distinct()
    total = judgments.agg(F.countDistinct("query_id").alias("total"))
    return total.join(F.broadcast(found.agg(F.count("*").alias("resolved")))).withColumn("ok", F.col("resolved") >= least * F.col("total"))


def related_outcomes(expected: DataFrame, related: DataFrame, results: DataFrame, known: DataFrame) -> DataFrame:
    """Each expectation (query_id, doc regex, heading regex): hit, absorbed (already a result), miss, or skipped (unknown)."""
    held = lambda df, name: expected.join(df, (expected["query_id"] == df["query_id"]) & F.expr("doc_id rlike doc") & F.expr("coalesce(heading_text, '') rlike heading"), "left_semi").select("query_id", "doc", "heading").withColumn(name, F.lit(True))
    exists = expected.join(known, F.expr("doc_id rlike doc"), "left_semi").select("query_id", "doc", "heading").withColumn("known", F.lit(True))
    on = ["query_id", "doc", "heading"]
    rows = expected.join(held(related, "hit"), on, "left").join(held(results, "absorbed"), on, "left").join(exists, on, "left")
    return rows.select(*on, F.when(F.col("known").isNull(), "skipped").when(F.col("hit"), "hit").when(F.col("absorbed"), "absorbed").otherwise("miss").alias("outcome"))


def related_recall(outcomes: DataFrame) -> DataFrame:
    hit, miss = F.count_if(F.col("outcome") == "hit"), F.count_if(F.col("outcome") == "miss")
    return outcomes.agg(hit.alias("hits"), miss.alias("misses"), F.count_if(F.col("outcome") == "absorbed").alias("absorbed"), F.count_if(F.col("outcome") == "skipped").alias("skipped"), F.round(hit / F.nullif(hit + miss, F.lit(0)), 4).alias("related_recall"))


def relevant_ranks(walked: DataFrame, relevant: DataFrame, order: list) -> DataFrame:
    """The relevant rows of walked with their rank: the number of rows of their query up to them in a total order."""
    place = F.struct(*[c.alias(f"o{k}") for k, c in enumerate(order)])
    mine = walked.join(relevant, ["query_id", "node_id"]).select("query_id", "node_id", "depth", "total_weight", place.alias("mine"))
    both = walked.select("query_id", place.alias("place")).join(F.broadcast(mine), "query_id")  # judged nodes only
    return both.groupBy("query_id", "node_id", "depth", "total_weight").agg(F.count_if(F.col("place") <= F.col("mine")).alias("rank"))


def graph_metrics(walked: DataFrame, relevant: DataFrame) -> DataFrame:
    """Per query: whether a relevant node is reached, stands first, its reciprocal rank, and the mean weight per step."""
    found = walked.join(relevant, ["query_id", "node_id"])
    best = found.groupBy("query_id").agg(F.min("rank").alias("first"), F.avg(F.col("total_weight") / F.col("depth")).alias("path_strength"))
    rows = relevant.select("query_id").distinct().join(best, "query_id", "left")
    return rows.select("query_id", F.col("first").isNotNull().cast("double").alias("reach"), F.coalesce((F.col("first") == 1).cast("double"), F.lit(0.0)).alias("p1"), F.coalesce(1.0 / F.col("first"), F.lit(0.0)).alias("mrr"), F.round(F.coalesce("path_strength", F.lit(0.0)), 4).alias("path_strength"))


def ontology(edges: DataFrame) -> DataFrame:
    return edges.groupBy("relation").agg(F.min("weight").alias("weight"))


def judgment_sha(judgments: DataFrame) -> DataFrame:
    """Twelve hex digits over all judgments in canonical form (sorted keys and lists)."""
    line = F.to_json(F.struct("id", "kind", "query", F.sort_array("relevant").alias("relevant")))
    return judgments.agg(F.substring(F.sha2(F.array_join(F.sort_array(F.collect_list(line)), "\n"), 256), 1, 12).alias("judgment_sha"))


def comparison_status(current: dict[str, str], baseline: dict[str, str], strict: bool = False, keys: tuple[str, ...] = ("judgment_sha", "chunk_count", "source_sha")) -> str:
    """"compare" if two runs judged the same questions on the same corpus; else "skip", which strict mode counts as "fail"."""
    same = all(current.get(k) == baseline.get(k) for k in keys)
    return "compare" if same else "fail" if strict else "skip"
