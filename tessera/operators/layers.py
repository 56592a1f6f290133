"""Bronze, silver and gold: which revision, rendition and assertion of a thing is served."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera import constants as C
from tessera import schemas
from tessera.functions import text as T


def bronze(df: DataFrame, ddl: str) -> DataFrame:
    return schemas.conform(df, ddl)


def latest_batch(df: DataFrame, stamp: str = "ingested_at") -> DataFrame:
    """Rows of the newest batch only, so that deletions propagate; the maximum is one row."""
    newest = df.agg(F.max(stamp).alias("__newest"))
    return df.join(F.broadcast(newest), F.col(stamp) == F.col("__newest")).drop("__newest")


def first_by(df: DataFrame, keys: list, order: list[Column]) -> DataFrame:
    """The first row of each key in a total order; the optimiser pushes the limit below the shuffle."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__place", place).filter("__place = 1").drop("__place")


def case_of(column: Column, values: dict, other) -> Column:
    return reduce(lambda case, item: case.when(column == item[0], F.lit(item[1])), list(values.items())[1:], F.when(column == next(iter(values)), F.lit(next(iter(values.values()))))).otherwise(F.lit(other))


def format_priority(path: Column) -> Column:
    return case_of(T.extension(path), C.FORMAT_PRIORITY, 0)


def relation_weight(relation: Column) -> Column:
    return case_of(relation, C.RELATION_WEIGHTS, C.OTHER_WEIGHT)


def not_blank(column: str) -> Column:
    return F.col(column).isNotNull() & (F.length(F.trim(F.col(column))) > 0)


def silver_documents(bronze_docs: DataFrame, twins: DataFrame | None = None) -> DataFrame:
    """Latest batch, newest revision of an id, best rendition of a text, without superseded twins and blank texts."""
    # what is asked of a text is asked before the shuffles, which then carry it only for callers that read it
    rows = latest_batch(bronze_docs).withColumns({"__long": F.length(F.trim("content")) >= C.FINGERPRINT_FLOOR, "__full": not_blank("content")})
    newest = first_by(rows, ["doc_id"], [F.desc("ingested_at"), F.asc_nulls_last("content_sha256")])
    key = F.when(F.col("__long"), F.concat(F.lit("fp:"), F.col("content_fingerprint"))).otherwise(F.concat(F.lit("id:"), F.col("doc_id")))
    one = first_by(newest.withColumn("__key", key), ["__key"], [F.desc(format_priority(F.col("rel_path"))), F.desc("ingested_at"), F.asc_nulls_last("content_sha256"), F.asc("doc_id")]).drop("__key")
    served = one.join(twins.select("doc_id"), "doc_id", "left_anti") if twins is not None else one
    return served.filter("__full").drop("__long", "__full").withColumn("title", T.blank_to_null(F.col("title")))


def silver_chunks(bronze_chunks: DataFrame, documents: DataFrame) -> DataFrame:
    """Newest copy of each chunk whose document is served; path, title and type come from the document."""
    one = first_by(latest_batch(bronze_chunks), ["chunk_id"], [F.desc("ingested_at"), F.asc("rel_path"), F.asc_nulls_last("content_sha256")])
    own = documents.select("doc_id", "rel_path", "title", "doc_type")
    joined = one.drop("rel_path", "title", "doc_type").join(own, "doc_id").filter(not_blank("content"))
    heading = F.coalesce(T.blank_to_null(F.col("heading")), F.col("title"))
    return joined.withColumn("heading", heading).select(*schemas.struct(schemas.CHUNKS).names)


def silver_relations(bronze_relations: DataFrame, documents: DataFrame, rank_after_join: bool = False) -> DataFrame:
    """One assertion of each edge. By default the choice comes before the join with served documents: an edge whose chosen
    asserting document is not served disappears, even if another served document asserts it (rank_after_join changes that)."""
    clean = lambda c: F.lower(F.trim(F.col(c)))
    keys, order = [clean("source_entity"), F.col("relation"), clean("target_entity")], [F.desc("ingested_at"), F.asc("relation_id")]
    rows, own = latest_batch(bronze_relations), documents.select("doc_id")
    one = first_by(rows.join(own, "doc_id", "left_semi"), keys, order) if rank_after_join else first_by(rows, keys, order).join(own, "doc_id", "left_semi")
    kind = lambda c: F.coalesce(T.blank_to_null(F.col(c)), F.lit("unknown"))
    shaped = one.withColumns({"source_entity": clean("source_entity"), "target_entity": clean("target_entity"), "relation": clean("relation"), "source_kind": kind("source_kind"), "target_kind": kind("target_kind")})
    return shaped.filter("source_entity <> target_entity")


def gold_chunks(chunks: DataFrame) -> DataFrame:
    return chunks.withColumn("embed_text", T.embed_text(F.col("title"), F.col("heading"), F.col("content")))


def gold_entities(documents: DataFrame, relations: DataFrame) -> DataFrame:
    """Nodes from documents and both ends of edges, of each id the best kind, with degrees."""
    docs = documents.select(F.col("doc_id").alias("entity_id"), F.lit("document").alias("kind"), F.coalesce("title", "doc_id").alias("label"), "doc_id", "rel_path")
    ends = reduce(DataFrame.unionAll, [relations.select(F.col(f"{e}_entity").alias("entity_id"), F.col(f"{e}_kind").alias("kind"), "doc_id", "rel_path") for e in ("source", "target")])
    seen = ends.groupBy("entity_id", "kind").agg(F.min("doc_id").alias("doc_id"), F.min("rel_path").alias("rel_path")).withColumn("label", F.col("entity_id"))
    rank = case_of(F.col("kind"), {k: i for i, k in enumerate(C.KIND_PRIORITY)}, len(C.KIND_PRIORITY))
    one = first_by(docs.unionByName(seen), ["entity_id"], [F.asc(rank), F.asc("kind"), F.asc("doc_id")])
    return with_degrees(one, relations, "entity_id", "source_entity", "target_entity")


def with_degrees(nodes: DataFrame, edges: DataFrame, node: str, source: str, target: str) -> DataFrame:
    out = edges.groupBy(F.col(source).alias(node)).agg(F.count("*").alias("out_degree"))
    into = edges.groupBy(F.col(target).alias(node)).agg(F.count("*").alias("in_degree"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return nodes.join(out, node, "left").join(into, node, "left").select(*nodes.columns, zero("out_degree"), zero("in_degree"))


def gold_relations(relations: DataFrame, entities: DataFrame) -> DataFrame:
    """Edges with weights and with both ends resolved to nodes; an unresolved end is null and fails its audit."""
    ids = entities.select("entity_id")
    left = ids.select(F.col("entity_id").alias("source_node_id"))
    right = ids.select(F.col("entity_id").alias("target_node_id"))
    joined = relations.join(left, F.col("source_entity") == F.col("source_node_id"), "left").join(right, F.col("target_entity") == F.col("target_node_id"), "left")
    return joined.withColumn("weight", relation_weight(F.col("relation")))


def representatives(chunks: DataFrame, scope: str = "collection", content: str = "content", order: tuple[str, ...] = ("doc_id", "chunk_index")) -> DataFrame:
    """First chunk of each text in a collection: boilerplate is indexed once per collection."""
    return first_by(chunks, [scope, content], [F.asc(c) for c in order])


def duplicate_groups(df: DataFrame, key: Column, member: str) -> DataFrame:
    """Groups of more than one member with their sorted list and how many are redundant."""
    found = df.groupBy(key.alias("fingerprint")).agg(F.count("*").alias("n"), F.sort_array(F.collect_list(member)).alias("members"))
    return found.filter("n > 1").withColumn("redundant", F.col("n") - 1)
