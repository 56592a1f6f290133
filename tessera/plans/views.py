"""Inputs that the registered queries derive from the plain tables, as SQL that both engines read.

SHA(x) stands for the engine's hex SHA-256 and is filled in by ``sql_for``.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from tessera.functions import batches

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

#: Documents as files of several formats with three revisions of an id, in three batches, some titles and texts blank.
BRONZE_DOCS = """
SELECT concat('d', CAST(CAST(floor(doc_id / 3) AS BIGINT) AS STRING)) AS doc_id,
  concat(source, '/', CAST(doc_id AS STRING), '.', CASE doc_id % 9 WHEN 0 THEN 'pdf' WHEN 1 THEN 'ppt' WHEN 2 THEN 'pptx' WHEN 3 THEN 'xls' WHEN 4 THEN 'xlsx'
    WHEN 5 THEN 'doc' WHEN 6 THEN 'docx' WHEN 7 THEN 'hwpx' ELSE 'hwp' END) AS rel_path,
  'text' AS doc_type, CASE WHEN doc_id % 5 = 0 THEN '  ' ELSE concat(' Title ', CAST(doc_id AS STRING), ' ') END AS title,
  CASE WHEN doc_id % 97 = 0 THEN '   ' ELSE text END AS content, SHA(text) AS content_sha256, SHA(trim(regexp_replace(text, '[ \\n\\t\\r]+', ' '@G))) AS content_fingerprint,
  CASE WHEN doc_id % 7 = 0 THEN timestamp '2024-01-01 00:00:00' ELSE timestamp '2024-01-02 00:00:00' END AS ingested_at
FROM documents
"""

#: Edges supplier -> part and customer -> order, with case and space variants, loops and several assertions of one edge.
BRONZE_RELATIONS = """
SELECT substring(SHA(concat(CAST(l_orderkey AS STRING), '|', CAST(l_linenumber AS STRING))), 1, 24) AS relation_id, concat('d', CAST(CAST(floor(l_orderkey / 40) AS BIGINT) AS STRING)) AS doc_id,
  concat('r/', CAST(l_orderkey AS STRING)) AS rel_path, CASE WHEN l_linenumber = 1 THEN concat(' Supplier-', CAST(l_suppkey AS STRING)) ELSE concat('supplier-', CAST(l_suppkey AS STRING)) END AS source_entity,
  CASE WHEN l_linenumber = 2 THEN ' ' ELSE 'module' END AS source_kind,
  CASE l_returnflag WHEN 'R' THEN 'supersedes' WHEN 'A' THEN 'depends_on' ELSE CASE l_linestatus WHEN 'O' THEN 'mentions' ELSE 'uses' END END AS relation,
  CASE WHEN l_linenumber = 3 THEN concat('supplier-', CAST(l_suppkey AS STRING)) ELSE concat('part-', CAST(l_partkey AS STRING)) END AS target_entity,
  'symbol' AS target_kind, l_returnflag AS evidence, timestamp '2024-01-02 00:00:00' AS ingested_at
FROM lineitem
"""

#: Small graph with a cycle: region -> nation -> supplier, and back from each region's first nation to it.
GRAPH = """
SELECT concat('r', CAST(n_regionkey AS STRING)) AS source_id, concat('n', CAST(n_nationkey AS STRING)) AS target_id, 'depends_on' AS relation, CAST(1.0 AS DOUBLE) AS weight, n_name AS evidence FROM nation
UNION ALL SELECT concat('n', CAST(s_nationkey AS STRING)), concat('s', CAST(s_suppkey AS STRING)), CASE WHEN s_suppkey % 3 = 0 THEN 'mentions' ELSE 'uses' END, CAST(0.8 AS DOUBLE), s_name FROM supplier
UNION ALL SELECT concat('n', CAST(min(n_nationkey) AS STRING)), concat('r', CAST(n_regionkey AS STRING)), 'references', CAST(0.5 AS DOUBLE), 'back' FROM nation GROUP BY n_regionkey
"""

#: Documents (suppliers) that cite parts: pivots shared by many.
CITATIONS = """
SELECT concat('doc', CAST(l_suppkey AS STRING)) AS source_id, concat('part', CAST(l_partkey AS STRING)) AS target_id, 'uses' AS relation,
  CAST(max(CASE WHEN l_returnflag = 'R' THEN 0.8 ELSE 0.5 END) AS DOUBLE) AS weight, min(l_returnflag) AS evidence FROM lineitem GROUP BY l_suppkey, l_partkey
UNION ALL SELECT concat('doc', CAST(s_suppkey AS STRING)), concat('doc', CAST(s_suppkey % 7 AS STRING)), 'references', CAST(0.5 AS DOUBLE), s_name FROM supplier WHERE s_suppkey % 11 = 0 AND s_suppkey % 7 <> s_suppkey
"""

#: Documents that share a term (three to a term) or a shelf (four to a shelf, which names them), and that refer to an earlier one.
DOCUMENT_EDGES = """
SELECT concat('d', CAST(doc_id AS STRING)) AS source_id, concat('term', CAST(CAST(floor(doc_id / 3) AS BIGINT) AS STRING)) AS target_id, 'uses' AS relation,
  CAST(CASE WHEN doc_id % 2 = 0 THEN 0.8 ELSE 0.5 END AS DOUBLE) AS weight, split_part(text, ' ', 3) AS evidence FROM documents
UNION ALL SELECT concat('shelf', CAST(CAST(floor(doc_id / 4) AS BIGINT) AS STRING)), concat('d', CAST(doc_id AS STRING)), 'defines', CAST(0.8 AS DOUBLE), split_part(text, ' ', 5) FROM documents
UNION ALL SELECT concat('d', CAST(doc_id AS STRING)), concat('d', CAST(doc_id - 7 AS STRING)), 'references', CAST(0.5 AS DOUBLE), source FROM documents
"""

#: Chunks of four lines with a heading for each four chunks.
CHUNK_LINES, CHUNKS_A_SECTION = 4, 4


def sql_for(sql: str, spark: bool) -> str:
    sql = re.sub(r"SHA\((.*?)\)(?= AS content_sha256)", r"sha2(\1, 256)" if spark else r"sha256(\1)", sql)
    out, at = [], 0
    while (k := sql.find("SHA(", at)) >= 0:
        depth, end = 1, k + 4
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        out += [sql[at:k], f"sha2({sql[k + 4 : end - 1]}, 256)" if spark else f"sha256({sql[k + 4 : end - 1]})"]
        at = end
    return ("".join(out) + sql[at:]).replace("@G", "" if spark else ", 'g'")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table; text in a file that cannot be split is dealt over the cores once, larger tables are read as they lie."""
    df = batches.small(spark).read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if name in ("documents", "pages") and df.rdd.getNumPartitions() < cores else df


def view(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """A view of this module over the tables of a folder, without naming anything in the session's catalog."""
    used = [t for t in TABLES if re.search(rf"\b{t}\b", sql)]
    text = sql_for(sql, True).replace("{", "{{").replace("}", "}}")
    for t in used:
        text = re.sub(rf"\bFROM {t}\b", f"FROM {{{t}}}", text)
    return spark.sql(text, **{t: table(spark, sf_dir, t) for t in used if f"{{{t}}}" in text})


def duck(sql: str) -> str:
    return sql_for(sql, False)
