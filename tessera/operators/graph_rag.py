"""Documents related to a search result through the graph, with the passages and edges that justify them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera import constants as C
from tessera.functions import text as T
from tessera.operators import search
from tessera.operators.layers import first_by


def damping(degree: Column) -> Column:
    return 1 / F.log2(2 + degree)


def admissible(rows: DataFrame, documents: DataFrame, seeds: DataFrame, hidden: DataFrame | None = None, on: str = "doc") -> DataFrame:
    """Rows whose doc is a document, no seed and not hidden."""
    as_doc = lambda df: df.select(F.col(df.columns[0]).alias(on))
    rows = rows.join(as_doc(documents), on, "left_semi").join(as_doc(seeds), on, "left_anti")
    return rows.join(as_doc(hidden), on, "left_anti") if hidden is not None else rows


def both_ways(edges: DataFrame) -> DataFrame:
    """Every edge seen from either end: (node, other, role of node, relation, weight, evidence)."""
    cols = ["relation", "weight", "evidence"]
    return edges.select(F.col("source_id").alias("node"), F.col("target_id").alias("other"), F.lit("source").alias("role"), *cols).unionAll(edges.select("target_id", "source_id", F.lit("target"), *cols))


def direct(edges: DataFrame, seeds: DataFrame, documents: DataFrame, hidden: DataFrame | None = None) -> DataFrame:
    """doc, score, evidence of documents one edge away from a seed; weights add up."""
    near = both_ways(edges).join(seeds.select(F.col(seeds.columns[0]).alias("node")), "node", "left_semi").withColumnRenamed("other", "doc")
    return admissible(near, documents, seeds, hidden).select("doc", F.col("weight").alias("score"), "evidence")


def cocited(edges: DataFrame, seeds: DataFrame, documents: DataFrame, hidden: DataFrame | None = None, cap: int = C.HUB_CAP) -> DataFrame:
    """doc, pivot, score, evidence of documents that share a pivot (no document itself) with a seed in the same role.

    Pivots cited by more than cap documents are hubs and say nothing; others count less the more documents cite them.
    """
    ends = both_ways(edges).join(documents.select(F.col(documents.columns[0]).alias("node")), "node", "left_semi")
    ends = ends.join(documents.select(F.col(documents.columns[0]).alias("other")), "other", "left_anti").withColumnRenamed("other", "pivot")
    cites = ends.groupBy("pivot", "role", "node").agg(F.max("weight").alias("weight"), F.min("evidence").alias("evidence"))
    degree = cites.groupBy("pivot", "role").agg(F.count("*").alias("degree"))
    cites = cites.join(degree.filter(F.col("degree") <= cap), ["pivot", "role"])
    mine = cites.join(seeds.select(F.col(seeds.columns[0]).alias("node")), "node", "left_semi").select("pivot", "role", F.col("node").alias("seed"), F.col("weight").alias("w1"))
    pairs = cites.join(mine, ["pivot", "role"]).filter("node <> seed").withColumnRenamed("node", "doc")
    scored = pairs.select("doc", "pivot", (F.least("weight", "w1") * damping(F.col("degree"))).alias("score"), "evidence")
    return admissible(scored, documents, seeds, hidden)


def second_step(edges: DataFrame, first: DataFrame, seeds: DataFrame, documents: DataFrame, hidden: DataFrame | None = None) -> DataFrame:
    """doc, score of documents one direct edge beyond the first ones: of each only the first edge in order counts."""
    steps = both_ways(edges).join(first.select(F.col("doc").alias("node"), F.col("score").alias("base")), "node")
    new = admissible(steps.withColumnRenamed("other", "doc"), documents, seeds, hidden).join(first.select("doc"), "doc", "left_anti")
    s, t = F.when(F.col("role") == "source", F.col("node")).otherwise(F.col("doc")), F.when(F.col("role") == "source", F.col("doc")).otherwise(F.col("node"))
    one = first_by(new.withColumns({"s": s, "t": t}), ["doc"], [F.asc("s"), F.asc("t"), F.asc("relation")])
    return one.select("doc", (F.col("base") * F.col("weight") * 0.5).alias("score"))


def related(edges: DataFrame, seeds: DataFrame, documents: DataFrame, depth: int = 1, hidden: DataFrame | None = None, most: int = C.RELATED_DOCS) -> DataFrame:
    """doc, score, connectives, truncated: the best related documents, and whether there were more."""
    near = direct(edges, seeds, documents, hidden).withColumn("pivot", F.lit(None).cast("string"))
    near = near.unionByName(cocited(edges, seeds, documents, hidden))
    words = F.slice(F.array_distinct(F.filter(F.flatten(F.sort_array(F.collect_list(F.array(F.coalesce("evidence", F.lit("")), F.coalesce("pivot", F.lit("")))))), lambda x: x != "")), 1, C.CONNECTIVES)
    first = near.groupBy("doc").agg(F.sum("score").alias("score"), words.alias("connectives"))
    if depth > 1:
        first = first.unionByName(second_step(edges, first, seeds, documents, hidden).withColumn("connectives", F.expr("cast(array() as array<string>)")))
    place = F.row_number().over(Window.orderBy(F.desc("score"), F.asc("doc")))
    rows = first.withColumn("score", F.round("score", 4)).orderBy(F.desc("score"), F.asc("doc")).limit(most + 1).withColumn("place", place)
    more = F.max("place").over(Window.partitionBy()) > most
    return rows.withColumn("truncated", more).filter(F.col("place") <= most).drop("place")


def passages(related_docs: DataFrame, chunks: DataFrame, query_hits: DataFrame, connective_hits: DataFrame, query_terms: Sequence[str], per_doc: int = C.PASSAGES_PER_DOC) -> DataFrame:
    """The passages that stand for each related document, by the best tier it has: hits of the query, hits of its
    connectives that share a term with it, chunks that share a term, the head of the document."""
    own = chunks.join(related_docs.select(F.col("doc").alias("doc_id"), "connectives"), "doc_id")
    wanted = F.concat(F.array(*[F.lit(t) for t in query_terms]) if query_terms else F.expr("cast(array() as array<string>)"), T.query_terms(F.array_join("connectives", "\n")))
    shared = F.size(F.array_intersect(T.index_terms(F.col("content")), wanted)) > 0
    marked = own.join(query_hits.select("chunk_id", F.col("rank").alias("q")), "chunk_id", "left").join(connective_hits.select("chunk_id", F.col("rank").alias("c")), "chunk_id", "left")
    tier = F.when(F.col("q").isNotNull() & shared, 1).when(F.col("c").isNotNull() & shared, 2).when(shared, 3).otherwise(4)
    ranked = marked.withColumn("tier", tier).withColumn("order", F.coalesce(F.when(F.col("tier") == 1, F.col("q")), F.when(F.col("tier") == 2, F.col("c")), F.col("chunk_index")))
    best = F.min("tier").over(Window.partitionBy("doc_id"))
    place = F.row_number().over(Window.partitionBy("doc_id").orderBy("tier", "order", "chunk_id"))
    names = F.element_at(F.array(*[F.lit(x) for x in ("query_match", "lexical_overlap", "lexical_overlap", "doc_head")]), F.col("tier"))
    return ranked.withColumns({"best": best, "place": place}).filter((F.col("tier") == F.col("best")) & (F.col("place") <= F.when(F.col("tier") == 4, 1).otherwise(per_doc))).withColumn("match", names).select("doc_id", "chunk_id", "match", "content")


def diagnostics(edges: DataFrame, seeds: DataFrame, documents: DataFrame, cap: int = C.HUB_CAP) -> DataFrame:
    """Counts that tell why nothing was related, and the reason; no document is named."""
    near = both_ways(edges).join(seeds.select(F.col(seeds.columns[0]).alias("node")), "node", "left_semi")
    docs = documents.select(F.col(documents.columns[0]).alias("other"))
    pivots = near.join(docs, "other", "left_anti").select("other").distinct()
    crowd = both_ways(edges).join(documents.select(F.col(documents.columns[0]).alias("node")), "node", "left_semi").join(pivots, "other", "left_semi").groupBy("other").agg(F.countDistinct("node").alias("n"))
    one = seeds.agg(F.count("*").alias("seeds"))
    for name, df in (("seed_edges", near), ("document_neighbours", near.join(docs, "other", "left_semi").select("other").distinct()), ("pivots", pivots), ("hubs_dropped", crowd.filter(F.col("n") > cap)), ("shared_pivots", crowd.filter(F.col("n").between(2, cap)))):
        one = one.join(F.broadcast(df.agg(F.count("*").alias(name))))
    reason = F.when(F.col("seeds") == 0, "no seeds").when(F.col("seed_edges") == 0, "seeds have no edges").when((F.col("document_neighbours") == 0) & (F.col("shared_pivots") == 0) & (F.col("hubs_dropped") > 0), "only hubs in common").when((F.col("document_neighbours") == 0) & (F.col("shared_pivots") == 0), "nothing in common").otherwise("reachable")
    return one.withColumn("reason", reason)


def connective_hits(index, related_docs: DataFrame, depth: int = C.SCOPED_CANDIDATES) -> DataFrame:
    """chunk_id, rank of a related document's own chunks among the best chunks for its connectives."""
    number = F.row_number().over(Window.orderBy("doc"))  # of the few related documents
    docs = related_docs.select("doc", "connectives", number.alias("query_id"))
    asked = docs.select("query_id", F.explode(T.query_terms(F.array_join("connectives", "\n"))).alias("term"))
    hits = index.keyword(asked, depth).join(F.broadcast(docs.select("query_id", "doc")), "query_id")
    own = index.chunks.select("chunk_id", "doc_id").join(F.broadcast(hits), "chunk_id")  # hits: at most depth for each of few documents
    return own.filter(F.col("doc_id") == F.col("doc")).select("chunk_id", "rank")


def _held(rows: DataFrame) -> DataFrame:
    """A top-k result held by the driver, so that plans that name it several times do not search again."""
    return rows.sparkSession.createDataFrame(rows.collect(), rows.schema)


def graph_search(index, edges: DataFrame, documents: DataFrame, variants, limit: int = C.LIMIT, seed_limit: int = C.LIMIT, depth: int = 1, **options) -> tuple[DataFrame, DataFrame]:
    """(results, related): results are those of the plain search, the related documents stay apart."""
    found = _held(index.search(variants, max(limit, seed_limit), **options))
    rank = F.col("final_rank" if "final_rank" in found.columns else "rank")
    seeds = found.filter(rank <= seed_limit).select("doc_id").distinct()
    return found.filter(rank <= limit), _held(related(edges, seeds, documents, depth))


def ask(index, edges: DataFrame, documents: DataFrame, variants, depth: int = 1, retrieved: int = C.SCOPED_CANDIDATES, **options) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(results, related, passages) of a question: the plain search, the documents related to what it found, and the
    passages that stand for them, for which the first wording is retrieved again to a greater depth without a section cap."""
    results, near = graph_search(index, edges, documents, variants, depth=depth, **options)
    terms, vector = variants[0]
    deep = index.search_once(terms, vector, retrieved, retrieved, retrieved).select("chunk_id", F.col("position").alias("rank"))
    return results, near, passages(near, index.chunks, deep, connective_hits(index, near), terms)
