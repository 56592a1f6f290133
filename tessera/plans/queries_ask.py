"""Registered queries of the graph-augmented question: search, related documents and the passages that stand for them."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera import constants as C
from tessera.operators import graph_rag, search
from tessera.plans import queries_search as QS
from tessera.plans import views as V

QUERIES: dict = {}
SQL: dict = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


def rrf_sql(depth: int) -> str:
    arm = lambda name: f"(SELECT * FROM {name} WHERE rank <= {depth}) {name}"
    return f"SELECT coalesce(v.chunk_id, w.chunk_id) AS chunk_id, round(coalesce(1.0 / (60 + v.rank), 0) + coalesce(1.0 / (60 + w.rank), 0), 6) AS rrf_score FROM {arm('v')} FULL JOIN {arm('w')} USING (chunk_id)"


ASK = f"""{QS.arms_sql(C.SCOPED_CANDIDATES)}, f AS ({rrf_sql(C.CANDIDATES)}),
capped AS (SELECT chunk_id, doc_id, rrf_score FROM f JOIN chunks USING (chunk_id) QUALIFY row_number() OVER (PARTITION BY doc_id, heading ORDER BY rrf_score DESC, chunk_id) = 1),
results AS (SELECT chunk_id, doc_id, row_number() OVER (ORDER BY rrf_score DESC, chunk_id) AS rank FROM capped QUALIFY rank <= {C.LIMIT}),
seeds AS (SELECT DISTINCT 'd' || doc_id AS doc FROM results), e AS ({V.duck(V.DOCUMENT_EDGES)}), docs AS (SELECT 'd' || doc_id AS doc FROM documents),
ways AS (SELECT source_id AS node, target_id AS other, 'source' AS role, weight, evidence FROM e UNION ALL SELECT target_id, source_id, 'target', weight, evidence FROM e),
near AS (SELECT other AS doc, weight AS score, coalesce(evidence, '') AS evidence, '' AS hub FROM ways WHERE node IN (FROM seeds) AND other IN (FROM docs) AND other NOT IN (FROM seeds)),
cites AS (SELECT other AS hub, role, node AS doc, max(weight) AS weight, min(evidence) AS evidence FROM ways WHERE node IN (FROM docs) AND other NOT IN (FROM docs) GROUP BY 1, 2, 3),
shared AS (SELECT hub, role, count(*) AS degree FROM cites GROUP BY 1, 2 HAVING count(*) <= {C.HUB_CAP}),
pairs AS (SELECT a.doc, least(a.weight, b.weight) / log2(2 + degree) AS score, coalesce(a.evidence, '') AS evidence, hub FROM cites a JOIN shared USING (hub, role) JOIN cites b USING (hub, role) WHERE b.doc IN (FROM seeds) AND a.doc NOT IN (FROM seeds)),
linked AS (FROM near UNION ALL FROM pairs), scores AS (SELECT doc, round(sum(score), 4) AS score FROM linked GROUP BY 1),
placed AS (SELECT doc, evidence, hub, row_number() OVER (PARTITION BY doc ORDER BY evidence, hub) AS k FROM linked),
said AS (SELECT doc, word, min(nth) AS nth FROM (SELECT doc, evidence AS word, 2 * k AS nth FROM placed UNION ALL SELECT doc, hub, 2 * k + 1 FROM placed) WHERE word <> '' GROUP BY 1, 2),
words AS (SELECT doc, list(word ORDER BY nth)[1:{C.CONNECTIVES}] AS connectives FROM said GROUP BY 1),
related AS (SELECT doc, score, coalesce(connectives, []) AS connectives, (SELECT count(*) FROM scores) > {C.RELATED_DOCS} AS truncated FROM (FROM scores ORDER BY score DESC, doc LIMIT {C.RELATED_DOCS}) LEFT JOIN words USING (doc))"""


def question(spark, sf_dir):
    """The index with documents named as the graph names them, the edges, the documents, and a question's terms and vector."""
    plain = QS.index_of(spark, sf_dir)
    index = search.Index(plain.chunks.withColumn("doc_id", F.concat(F.lit("d"), F.col("doc_id").cast("string"))), plain.vectors, plain.posts, plain.totals, plain.lists)
    docs = V.table(spark, sf_dir, "documents").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("doc"))
    return index, V.view(spark, sf_dir, V.DOCUMENT_EDGES), docs, [(QS.question(spark, sf_dir)["terms"], QS._first_vector(spark, sf_dir))]


@query(f"WITH {ASK} SELECT doc, score, array_to_string(connectives, '|') AS connectives, truncated FROM related")
def graph_ask_related(spark, sf_dir):
    """The documents related to what the search of the first benchmark text finds, and what connects them."""
    return graph_rag.graph_search(*question(spark, sf_dir))[1].select("doc", "score", F.array_join("connectives", "|").alias("connectives"), "truncated")


SCORED = "round(sum(greatest(ln((n - df + 0.5) / (df + 0.5)), 0.000001) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl))), 6)"


@query(f"""WITH {ASK}, deep AS (SELECT chunk_id, row_number() OVER (ORDER BY rrf_score DESC, chunk_id) AS q FROM ({rrf_sql(C.SCOPED_CANDIDATES)}) QUALIFY q <= {C.SCOPED_CANDIDATES}),
said_terms AS (SELECT doc, list_distinct({QS.terms_sql("array_to_string(connectives, chr(10))")}) AS terms FROM related), cq AS (SELECT doc, unnest(terms) AS term FROM said_terms),
cs AS (SELECT doc, chunk_id, {SCORED} AS score FROM posts JOIN dls USING (chunk_id) JOIN dfs USING (term) JOIN cq USING (term), totals GROUP BY 1, 2),
ch AS (SELECT doc, chunk_id, row_number() OVER (PARTITION BY doc ORDER BY score DESC, chunk_id) AS c FROM cs QUALIFY c <= {C.SCOPED_CANDIDATES}),
asked_terms AS (SELECT list(term) AS own FROM qs WHERE query_id = (SELECT min(item_id) FROM benchmark)),
own AS (SELECT s.doc, k.chunk_id, k.chunk_index, k.content, q, c, len(list_intersect({QS.terms_sql('content')}, list_concat(own, terms))) > 0 AS shared FROM chunks k JOIN said_terms s ON s.doc = 'd' || k.doc_id LEFT JOIN deep USING (chunk_id) LEFT JOIN ch ON ch.doc = s.doc AND ch.chunk_id = k.chunk_id, asked_terms),
tiers AS (SELECT *, CASE WHEN q IS NOT NULL AND shared THEN 1 WHEN c IS NOT NULL AND shared THEN 2 WHEN shared THEN 3 ELSE 4 END AS tier FROM own),
ranked AS (SELECT *, min(tier) OVER (PARTITION BY doc) AS best, row_number() OVER (PARTITION BY doc ORDER BY tier, CASE tier WHEN 1 THEN q WHEN 2 THEN c ELSE chunk_index END, chunk_id) AS place FROM tiers)
SELECT doc AS doc_id, chunk_id, CASE tier WHEN 1 THEN 'query_match' WHEN 4 THEN 'doc_head' ELSE 'lexical_overlap' END AS match, md5(content) AS content_key FROM ranked WHERE tier = best AND place <= CASE tier WHEN 4 THEN 1 ELSE {C.PASSAGES_PER_DOC} END""")
def graph_ask_passages(spark, sf_dir):
    """The passages that stand for the related documents."""
    return graph_rag.ask(*question(spark, sf_dir))[2].select("doc_id", "chunk_id", "match", F.md5("content").alias("content_key"))
