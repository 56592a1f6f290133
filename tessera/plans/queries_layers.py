"""Registered queries of layers, audits, twins and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera import constants as C
from tessera.functions import text as T
from tessera.operators import audits, grading, layers, reports, twins
from tessera.plans import views as V
from tessera.sources.stored import built_once

QUERIES: dict = {}
SQL: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


DOCS, RELS = V.duck(V.BRONZE_DOCS), V.duck(V.BRONZE_RELATIONS)
WITH_DOCS = f"WITH b AS ({DOCS}), latest AS (SELECT * FROM b WHERE ingested_at = (SELECT max(ingested_at) FROM b))"
PRIORITY = "CASE regexp_extract(rel_path, '\\.([^.]+)$', 1) " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in C.FORMAT_PRIORITY.items()) + " ELSE 0 END"
SERVED = f"""{WITH_DOCS}, rev AS (SELECT * FROM latest QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY ingested_at DESC, content_sha256) = 1),
one AS (SELECT * FROM rev QUALIFY row_number() OVER (PARTITION BY CASE WHEN length(trim(content)) >= 200 THEN 'fp:' || content_fingerprint ELSE 'id:' || doc_id END
  ORDER BY {PRIORITY} DESC, ingested_at DESC, content_sha256, doc_id) = 1),
served AS (SELECT * REPLACE (nullif(trim(title), '') AS title) FROM one WHERE length(trim(content)) > 0)"""
RELATIONS = f"""{SERVED}, rb AS ({RELS}), rl AS (SELECT * FROM rb WHERE ingested_at = (SELECT max(ingested_at) FROM rb)),
r1 AS (SELECT * FROM rl QUALIFY row_number() OVER (PARTITION BY lower(trim(source_entity)), relation, lower(trim(target_entity)) ORDER BY ingested_at DESC, relation_id) = 1),
rels AS (SELECT relation_id, doc_id, rel_path, lower(trim(source_entity)) AS source_entity, coalesce(nullif(trim(source_kind), ''), 'unknown') AS source_kind, lower(trim(relation)) AS relation,
  lower(trim(target_entity)) AS target_entity, coalesce(nullif(trim(target_kind), ''), 'unknown') AS target_kind, evidence FROM r1 WHERE doc_id IN (SELECT doc_id FROM served) AND lower(trim(source_entity)) <> lower(trim(target_entity)))"""
KIND = "CASE kind WHEN 'document' THEN 0 WHEN 'module' THEN 1 WHEN 'symbol' THEN 2 WHEN 'unknown' THEN 3 ELSE 4 END"
ENTITIES = f"""{RELATIONS}, ends AS (SELECT source_entity AS entity_id, source_kind AS kind, doc_id, rel_path FROM rels UNION ALL SELECT target_entity, target_kind, doc_id, rel_path FROM rels),
cand AS (SELECT doc_id AS entity_id, 'document' AS kind, coalesce(title, doc_id) AS label, doc_id, rel_path FROM served
  UNION ALL SELECT entity_id, kind, entity_id, min(doc_id), min(rel_path) FROM ends GROUP BY entity_id, kind),
nodes AS (SELECT * FROM cand QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY {KIND}, kind, doc_id) = 1),
entities AS (SELECT n.*, coalesce(o.n, 0) AS out_degree, coalesce(i.n, 0) AS in_degree FROM nodes n LEFT JOIN (SELECT source_entity, count(*) AS n FROM rels GROUP BY 1) o ON o.source_entity = n.entity_id
  LEFT JOIN (SELECT target_entity, count(*) AS n FROM rels GROUP BY 1) i ON i.target_entity = n.entity_id)"""


def bronze(spark, sf_dir):
    return V.view(spark, sf_dir, V.BRONZE_DOCS)


def served(spark, sf_dir):
    return layers.silver_documents(bronze(spark, sf_dir))


def served_names(spark, sf_dir):
    """Ids, paths and titles of the served documents; written once, as edges and nodes read them several times."""
    return built_once(spark, sf_dir, "served-names", lambda: served(spark, sf_dir).select("doc_id", "rel_path", "title"))


#: Columns of edges that the queries read.
EDGE_COLUMNS = ("relation_id", "doc_id", "rel_path", "source_entity", "source_kind", "relation", "target_entity", "target_kind")


def relations(spark, sf_dir):
    """The edges, chosen and written once: nodes, degrees and ends read them again and again."""
    return built_once(spark, sf_dir, "silver-relations", lambda: layers.silver_relations(V.view(spark, sf_dir, V.BRONZE_RELATIONS), served_names(spark, sf_dir)).select(*EDGE_COLUMNS))


def entities(spark, sf_dir):
    return layers.gold_entities(served_names(spark, sf_dir), relations(spark, sf_dir))


@query(f"{WITH_DOCS} SELECT doc_id, rel_path FROM latest")
def latest_batch_filter(spark, sf_dir):
    return layers.latest_batch(bronze(spark, sf_dir)).select("doc_id", "rel_path")


@query(f"{WITH_DOCS} SELECT doc_id, rel_path, content_sha256 FROM latest QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY ingested_at DESC, content_sha256) = 1")
def revision_collapse(spark, sf_dir):
    return layers.first_by(layers.latest_batch(bronze(spark, sf_dir)), ["doc_id"], [F.desc("ingested_at"), F.asc("content_sha256")]).select("doc_id", "rel_path", "content_sha256")


@query(f"{SERVED} SELECT doc_id, rel_path, title, content_sha256 FROM served")
def rendition_collapse(spark, sf_dir):
    return served(spark, sf_dir).select("doc_id", "rel_path", "title", "content_sha256")


@query(f"{WITH_DOCS} SELECT content_fingerprint AS fingerprint, count(*) AS n, string_agg(rel_path, ',' ORDER BY rel_path) AS members, count(*) - 1 AS redundant FROM b GROUP BY 1 HAVING count(*) > 1")
def duplicate_groups(spark, sf_dir):
    return layers.duplicate_groups(bronze(spark, sf_dir), F.col("content_fingerprint"), "rel_path").withColumn("members", F.array_join("members", ","))


@query(f"WITH b AS ({DOCS}) SELECT doc_id, rel_path FROM b WHERE content IS NOT NULL AND length(trim(content)) > 0")
def blank_filter(spark, sf_dir):
    return bronze(spark, sf_dir).filter(layers.not_blank("content")).select("doc_id", "rel_path")


@query(f"WITH b AS ({DOCS}) SELECT rel_path, coalesce(nullif(trim(title), ''), doc_id) AS title FROM b")
def title_default(spark, sf_dir):
    return bronze(spark, sf_dir).select("rel_path", F.coalesce(T.blank_to_null(F.col("title")), F.col("doc_id")).alias("title"))


@query(f"WITH b AS ({DOCS}) SELECT rel_path, sha256(concat_ws(chr(10), '# ' || coalesce(nullif(trim(title), ''), doc_id), CASE WHEN nullif(trim(doc_type), '') IS NULL THEN '' ELSE '## ' || trim(doc_type) END, content)) AS embed_key FROM b")
def embed_text(spark, sf_dir):
    rows = bronze(spark, sf_dir).withColumn("title", F.coalesce(T.blank_to_null(F.col("title")), F.col("doc_id")))
    return rows.select("rel_path", T.sha256(T.embed_text(F.col("title"), F.col("doc_type"), F.col("content"))).alias("embed_key"))


@query("SELECT source AS collection, count(*) AS chunks, count(DISTINCT doc_id) AS documents FROM documents GROUP BY 1")
def collections_report(spark, sf_dir):
    from tessera.operators.search import collections_report as report

    return report(V.table(spark, sf_dir, "documents").withColumnRenamed("source", "collection"))


@query("SELECT page_id, CASE WHEN instr(regexp_replace(url, '^[a-z]+://', ''), '/') > 0 THEN split_part(regexp_replace(url, '^[a-z]+://', ''), '/', 1) ELSE '_root' END AS collection FROM pages")
def collection_of(spark, sf_dir):
    return V.table(spark, sf_dir, "pages").select("page_id", T.collection(F.regexp_replace("url", "^[a-z]+://", "")).alias("collection"))


@query("SELECT doc_id, source FROM documents QUALIFY row_number() OVER (PARTITION BY source, text ORDER BY doc_id) = 1")
def representative_dedup(spark, sf_dir):
    return layers.representatives(V.table(spark, sf_dir, "documents"), "source", "text", ("doc_id",)).select("doc_id", "source")


@query(f"{RELATIONS} SELECT relation_id, source_entity, source_kind, relation, target_entity, target_kind FROM rels")
def relation_dedup(spark, sf_dir):
    return relations(spark, sf_dir).select("relation_id", "source_entity", "source_kind", "relation", "target_entity", "target_kind")


@query(f"{RELATIONS} SELECT relation, CAST(CASE relation WHEN 'depends_on' THEN 1.0 WHEN 'imports' THEN 1.0 WHEN 'delegates_to' THEN 1.0 WHEN 'uses' THEN 0.8 WHEN 'defines' THEN 0.8 WHEN 'supersedes' THEN 0.6 WHEN 'references' THEN 0.5 WHEN 'related_to' THEN 0.4 ELSE 0.3 END AS DOUBLE) AS weight, count(*) AS n FROM rels GROUP BY 1, 2")
def relation_weights(spark, sf_dir):
    return relations(spark, sf_dir).groupBy("relation", layers.relation_weight(F.col("relation")).alias("weight")).agg(F.count("*").alias("n"))


@query(f"{ENTITIES} SELECT entity_id, kind, label, doc_id, rel_path, out_degree, in_degree FROM entities")
def entities_with_degrees(spark, sf_dir):
    return entities(spark, sf_dir)


@query(f"{ENTITIES} SELECT r.relation_id, s.entity_id AS source_node_id, t.entity_id AS target_node_id FROM rels r LEFT JOIN entities s ON r.source_entity = s.entity_id LEFT JOIN entities t ON r.target_entity = t.entity_id")
def endpoint_resolution(spark, sf_dir):
    return layers.gold_relations(relations(spark, sf_dir), entities(spark, sf_dir)).select("relation_id", "source_node_id", "target_node_id")


@query("SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def orphan_documents(spark, sf_dir):
    return audits.every_document_chunked(V.table(spark, sf_dir, "documents"), V.table(spark, sf_dir, "labels")).select("doc_id", "source")


@query(f"WITH b AS ({DOCS}) SELECT rel_path FROM b WHERE title IS NULL OR nullif(trim(title), '') IS NULL")
def audit_not_null(spark, sf_dir):
    return audits.not_null(bronze(spark, sf_dir).withColumn("title", T.blank_to_null(F.col("title"))), "rel_path", "title").select("rel_path")


@query(f"WITH b AS ({DOCS}) SELECT doc_id, count(*) AS n FROM b GROUP BY 1 HAVING count(*) > 1")
def audit_unique(spark, sf_dir):
    return audits.unique_values(bronze(spark, sf_dir), "doc_id")


@query(f"WITH b AS ({DOCS}) SELECT rel_path FROM b WHERE content IS NULL OR length(trim(content)) = 0")
def audit_text_not_blank(spark, sf_dir):
    return audits.text_not_blank(bronze(spark, sf_dir), "content").select("rel_path")


@query(f"WITH r AS ({RELS}) SELECT relation_id FROM r WHERE trim(source_entity) = target_entity")
def audit_self_loops(spark, sf_dir):
    return audits.no_self_loops(V.view(spark, sf_dir, V.BRONZE_RELATIONS).withColumn("source_entity", F.trim("source_entity")), "source_entity", "target_entity").select("relation_id")


@query("SELECT l_orderkey, l_linenumber FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN (SELECT p_partkey FROM part WHERE p_size > 10) ON l_partkey = p_partkey WHERE s_suppkey IS NULL OR p_partkey IS NULL")
def audit_endpoints_resolved(spark, sf_dir):
    t = lambda n: V.table(spark, sf_dir, n)
    rows = t("lineitem").join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey"), "left").join(t("part").filter("p_size > 10").select("p_partkey"), F.col("l_partkey") == F.col("p_partkey"), "left")
    return audits.endpoints_resolved(rows, "s_suppkey", "p_partkey").select("l_orderkey", "l_linenumber")


@query("SELECT doc_id, n, heading FROM (SELECT doc_id, count(*) AS n, max(trim(heading)) AS heading FROM (SELECT conv_id AS doc_id, CASE conv_id % 4 WHEN 0 THEN 'bill' WHEN 1 THEN 'statute' ELSE 'markdown' END AS doc_type, CASE WHEN conv_id % 3 = 0 THEN ' ' ELSE role END AS heading, turn FROM conversations) WHERE doc_type IN ('bill', 'statute') AND (turn = 0 OR doc_id % 5 = 0) GROUP BY 1) WHERE n = 1 AND heading = ''")
def audit_sections_survived(spark, sf_dir):
    """Conversations as documents, some of a profiled type, some left with one turn, some without headings."""
    kind = F.when(F.col("conv_id") % 4 == 0, "bill").when(F.col("conv_id") % 4 == 1, "statute").otherwise("markdown")
    rows = V.table(spark, sf_dir, "conversations").filter("turn = 0 OR conv_id % 5 = 0").select(F.col("conv_id").alias("doc_id"), kind.alias("doc_type"), F.when(F.col("conv_id") % 3 == 0, " ").otherwise(F.col("role")).alias("heading"))
    return audits.sections_survived(rows, ("bill", "statute")).select("doc_id", "n", "heading")


#: Every document is a rendition of its own; its id and format come from doc_id.
TWIN_DOCS = "SELECT doc_id, concat(CAST(doc_id AS STRING), '.', CASE doc_id % 3 WHEN 0 THEN 'pdf' WHEN 1 THEN 'docx' ELSE 'hwp' END) AS rel_path, text AS content FROM documents"
TWINS_SQL = """WITH r AS (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'pdf' WHEN 1 THEN 'docx' ELSE 'hwp' END AS fmt, CASE doc_id % 3 WHEN 0 THEN 1 WHEN 1 THEN 7 ELSE 9 END AS priority,
  regexp_replace(nfc_normalize(text), '[\\t\\n\\f\\r ]', '', 'g') AS norm FROM documents WHERE length(trim(text)) >= 200),
p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM r a JOIN r b ON a.doc_id < b.doc_id AND a.fmt <> b.fmt AND abs(length(a.norm) - length(b.norm)) / greatest(length(a.norm), length(b.norm)) < 0.15)"""


@query(f"{TWINS_SQL} SELECT a, b FROM p")
def twin_candidates(spark, sf_dir):
    return twins.candidates(twins.prepared(V.view(spark, sf_dir, TWIN_DOCS)))


@query(f"""{TWINS_SQL}, sh AS (SELECT DISTINCT doc_id, substring(norm, i, 10) AS s FROM (SELECT doc_id, norm, unnest(range(1, length(norm) - 8)) AS i FROM r)), n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
c AS (SELECT a, b, c FROM p JOIN (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2) USING (a, b)),
j AS (SELECT a, b, c / (na.n + nb.n - c) AS jaccard FROM c JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE c / (na.n + nb.n - c) >= {C.TWIN_JACCARD}),
w AS (SELECT CASE WHEN stays THEN b ELSE a END AS doc_id, CASE WHEN stays THEN a ELSE b END AS superseded_by, jaccard FROM (SELECT j.*, ra.priority > rb.priority AS stays FROM j JOIN r ra ON ra.doc_id = a JOIN r rb ON rb.doc_id = b))
SELECT doc_id, superseded_by, round(jaccard, 6) AS jaccard FROM w QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY w.jaccard DESC, superseded_by) = 1""")
def twins_superseded(spark, sf_dir):
    """Twins among the texts of each source's documents, by exact similarity."""
    return twins.superseded(V.view(spark, sf_dir, TWIN_DOCS)).withColumn("jaccard", F.round("jaccard", 6))


@query("SELECT doc_id, CAST(length(text) AS BIGINT) AS n_chars, CAST(len(list_distinct(CASE WHEN length(n) >= 10 THEN list_transform(range(1, length(n) - 8), lambda i: substring(n, i, 10)) ELSE [] END)) AS BIGINT) AS n_shingles FROM (SELECT doc_id, text, regexp_replace(text, '[\\t\\n\\f\\r ]', '', 'g') AS n FROM documents)")
def char_shingles(spark, sf_dir):
    rows = V.table(spark, sf_dir, "documents")
    return rows.select("doc_id", F.length("text").cast("long").alias("n_chars"), T.shingle_count(T.strip_ascii_space(F.col("text"))).alias("n_shingles"))


@query("SELECT lang, source, round(list_sort(list(d))[count(d) // 2 + 1], 6) AS median, count(*) AS n, round(count(*) / (SELECT count(*) FROM documents), 6) AS share FROM (SELECT lang, source, length(text) / nullif(len(regexp_extract_all(lower(text), '[a-z0-9_]+')), 0) AS d FROM documents) GROUP BY 1, 2")
def density_median(spark, sf_dir):
    return reports.density(V.table(spark, sf_dir, "documents"), ["lang", "source"], F.length("text"), F.size(T.simple_tokens(F.col("text"))))


@query("SELECT CAST(c AS BIGINT) AS ceiling, CAST(max(t) AS BIGINT) AS most, round(avg(CASE WHEN t > 128 THEN 1.0 ELSE 0.0 END), 6) AS over FROM (SELECT c, len(regexp_extract_all(lower(substring(text, 1, c)), '[a-z0-9_]+')) AS t FROM documents, (SELECT unnest([400, 650, 900, 1200]) AS c)) GROUP BY 1")
def ceiling_sweep(spark, sf_dir):
    return reports.ceiling_sweep(V.table(spark, sf_dir, "documents"), "text", (400, 650, 900, 1200), lambda t: F.size(T.simple_tokens(t)), 128).withColumn("ceiling", F.col("ceiling").cast("long"))


@query("SELECT 'c:' || substring(sha256(string_agg(source || '/' || doc_id || chr(9) || sha256(text), chr(10) ORDER BY source || '/' || doc_id || chr(9) || sha256(text))), 1, 12) AS corpus_id FROM documents")
def corpus_id(spark, sf_dir):
    return reports.corpus_id(V.table(spark, sf_dir, "documents").select(F.col("source").alias("collection"), F.col("doc_id").cast("string").alias("filename"), T.sha256(F.col("text")).alias("sha256")))


@query("SELECT lang, round(median(s), 6) AS median, count(*) FILTER (WHERE s < 0.92) AS below, count(*) AS n FROM (SELECT lang, 1 - (length(text) - length(regexp_replace(text, '[|$%&*#!]', '', 'g'))) / nullif(length(text), 0) AS s FROM documents) GROUP BY 1")
def score_statistics(spark, sf_dir):
    clean = 1 - (F.length("text") - F.length(F.regexp_replace("text", "[|$%&*#!]", ""))) / F.nullif(F.length("text"), F.lit(0))
    return reports.score_stats(V.table(spark, sf_dir, "documents").select("lang", clean.alias("s")).groupBy("lang"), "s")


@query("SELECT doc_id, k AS line, 'license' AS rule FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS k FROM documents) WHERE regexp_matches(l, '[Ll]icen[sc]e')")
def scan_lines(spark, sf_dir):
    files = V.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("rel_path"), F.col("text").alias("content"))
    return reports.scan_lines(files, (("license", "[Ll]icen[sc]e"),)).select(F.col("rel_path").alias("doc_id"), F.col("line").cast("long").alias("line"), "rule")


@query("SELECT CAST(count(*) FILTER (WHERE p) AS BIGINT) AS passed, CAST(count(*) FILTER (WHERE NOT p) AS BIGINT) AS failed, CAST(0 AS BIGINT) AS pending, round(count(*) FILTER (WHERE p) / nullif(count(*), 0), 4) AS rate FROM (SELECT regexp_matches(text, '\\.') AS p FROM documents UNION ALL SELECT NOT regexp_matches(text, '\\|') FROM documents)")
def grading_pass_rate(spark, sf_dir):
    outputs = V.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("output_id"), F.col("text").alias("content"))
    return grading.pass_rate(grading.grade(outputs, (("has sentences", r"\.", True), ("no tables", r"\|", False))))


@query("SELECT doc_id, 'missing' AS problem FROM (SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels) UNION ALL SELECT doc_id, 'extra' FROM (SELECT doc_id FROM labels EXCEPT SELECT doc_id FROM documents)")
def set_difference(spark, sf_dir):
    return grading.set_difference(V.table(spark, sf_dir, "labels"), V.table(spark, sf_dir, "documents"), "doc_id")
