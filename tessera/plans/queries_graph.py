"""Registered queries of the graph, of related documents, pages, dates and event windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.operators import evaluate, graph, graph_rag, layers
from tessera.plans import views as V
from tessera.sources import readers
from tessera.streaming import watch

QUERIES: dict = {}
SQL: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


EDGES, CITES = V.duck(V.GRAPH), V.duck(V.CITATIONS)


def walk_sql(start: str, a: str, b: str, depth: int, rel: str) -> str:
    return f"""WITH RECURSIVE e AS ({EDGES}), s AS (SELECT {a} AS src, {b} AS dst, relation, weight FROM e WHERE {rel}),
walk AS (SELECT dst AS node_id, 1 AS depth, weight, relation, [{start}, dst] AS seen FROM s WHERE src = {start} AND dst <> {start}
  UNION ALL SELECT s.dst, w.depth + 1, w.weight + s.weight, s.relation, list_append(w.seen, s.dst) FROM walk w JOIN s ON s.src = w.node_id WHERE w.depth < {depth} AND NOT list_contains(w.seen, s.dst)),
best AS (SELECT node_id, min(depth) AS depth, max(weight) AS total_weight FROM walk GROUP BY 1)
SELECT {start} AS start, node_id, CAST(b.depth AS BIGINT) AS depth, round(b.total_weight, 4) AS total_weight, string_agg(DISTINCT relation, ',' ORDER BY relation) AS via FROM best b JOIN walk w USING (node_id, depth) GROUP BY 1, 2, 3, 4"""


def edges(spark, sf_dir):
    return V.view(spark, sf_dir, V.GRAPH)


def start(spark, node):
    return spark.createDataFrame([(node,)], "node_id string")


@query(walk_sql("'r1'", "source_id", "target_id", 3, "relation <> 'mentions'"))
def graph_walk_down(spark, sf_dir):
    return graph.reached(edges(spark, sf_dir), start(spark, "r1"), "downstream", 3)


@query(walk_sql("'s1'", "target_id", "source_id", 4, "relation <> 'mentions'"))
def graph_walk_up(spark, sf_dir):
    return graph.reached(edges(spark, sf_dir), start(spark, "s1"), "upstream", 4)


@query(walk_sql("'r2'", "source_id", "target_id", 3, "relation IN ('depends_on', 'mentions')"))
def graph_walk_filtered(spark, sf_dir):
    return graph.reached(edges(spark, sf_dir), start(spark, "r2"), "downstream", 3, ["depends_on", "mentions"])


NODES_SQL = f"e AS ({EDGES}), n AS (SELECT id AS node_id, CAST(count(*) FILTER (WHERE side = 'in') AS BIGINT) AS in_degree, CAST(count(*) FILTER (WHERE side = 'out') AS BIGINT) AS out_degree FROM (SELECT source_id AS id, 'out' AS side FROM e UNION ALL SELECT target_id, 'in' FROM e) GROUP BY 1)"


def nodes(spark, sf_dir):
    e = edges(spark, sf_dir)
    ids = e.select(F.col("source_id").alias("node_id")).union(e.select("target_id")).distinct()
    return layers.with_degrees(ids.withColumns({"kind": F.lit("module"), "label": F.col("node_id")}), e, "node_id", "source_id", "target_id")


@query(f"WITH {NODES_SQL} SELECT node_id, in_degree, out_degree FROM n")
def degrees(spark, sf_dir):
    return nodes(spark, sf_dir).select("node_id", "in_degree", "out_degree")


@query(f"WITH {NODES_SQL} SELECT node_id, CAST(node_id = 'n1' AS INT) AS exact, in_degree + out_degree AS degree FROM n WHERE instr(node_id, 'n1') > 0 ORDER BY exact DESC, degree DESC, node_id LIMIT 10")
def resolve_node(spark, sf_dir):
    return graph.resolve(nodes(spark, sf_dir), "N1").select("node_id", "exact", "degree")


@query(f"WITH {NODES_SQL} SELECT node_id, in_degree + out_degree AS degree FROM n ORDER BY degree DESC, node_id LIMIT 6")
def top_hubs(spark, sf_dir):
    return graph.hubs(nodes(spark, sf_dir)).select("node_id", "degree")


@query(f"WITH e AS ({EDGES}) SELECT DISTINCT source_id, target_id, relation FROM e WHERE source_id IN ('n1', 'n2', 'r0') OR target_id IN ('n1', 'n2', 'r0')")
def edges_touching(spark, sf_dir):
    return graph.touching(edges(spark, sf_dir), spark.createDataFrame([("n1",), ("n2",), ("r0",)], "node_id string")).select("source_id", "target_id", "relation")


@query(f"WITH e AS ({EDGES}) SELECT relation, min(weight) AS weight FROM e GROUP BY 1")
def ontology(spark, sf_dir):
    return evaluate.ontology(edges(spark, sf_dir))


@query(f"WITH e AS ({EDGES}) SELECT source_id, target_id, relation, min(evidence) AS evidence FROM e GROUP BY 1, 2, 3")
def edge_dedup(spark, sf_dir):
    return graph.dedup_edges(edges(spark, sf_dir).select("source_id", "target_id", "relation", "evidence"))


@query(f"SELECT CAST(1 AS BIGINT) AS query_id, CAST(1.0 AS DOUBLE) AS reach, CAST(CASE WHEN rk = 1 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS p1, round(1.0 / rk, 6) AS mrr, round(total_weight / depth, 4) AS path_strength FROM (SELECT *, row_number() OVER (ORDER BY depth, total_weight DESC, node_id) AS rk FROM ({walk_sql(chr(39) + 'r1' + chr(39), 'source_id', 'target_id', 3, 'relation <> ' + chr(39) + 'mentions' + chr(39))})) WHERE node_id = 'n1'")
def path_strength(spark, sf_dir):
    rows = graph_walk_down(spark, sf_dir)
    relevant = spark.createDataFrame([(1, "n1")], "query_id long, node_id string")
    ranked = evaluate.relevant_ranks(rows.withColumn("query_id", F.lit(1).cast("long")), relevant, [F.col("depth"), -F.col("total_weight"), F.col("node_id")])
    return evaluate.graph_metrics(ranked, relevant).withColumn("mrr", F.round("mrr", 6))


#: Suppliers are documents, parts are what they cite; the seeds are two suppliers.
CITED = f"""c AS ({CITES}), docs AS (SELECT 'doc' || s_suppkey AS doc FROM supplier), seeds AS (SELECT unnest(['doc1', 'doc11']) AS doc),
ends AS (SELECT source_id AS doc, target_id AS hub, weight FROM c WHERE target_id LIKE 'part%'),
deg AS (SELECT hub, count(*) AS degree FROM ends GROUP BY 1)"""


def citations(spark, sf_dir):
    docs = V.table(spark, sf_dir, "supplier").select(F.concat(F.lit("doc"), F.col("s_suppkey").cast("string")).alias("doc"))
    seeds = spark.createDataFrame([("doc1",), ("doc11",)], "doc string")
    return V.view(spark, sf_dir, V.CITATIONS), seeds, docs


COCITED = f"""{CITED}, pairs AS (SELECT e.doc, e.hub, least(e.weight, m.weight) / log2(2 + degree) AS score FROM ends e JOIN deg USING (hub) JOIN ends m ON m.hub = e.hub AND m.doc IN (SELECT doc FROM seeds)
  WHERE degree <= 24 AND e.doc NOT IN (SELECT doc FROM seeds)), near AS (SELECT CASE WHEN source_id IN (SELECT doc FROM seeds) THEN target_id ELSE source_id END AS doc, weight AS score FROM c
  WHERE (source_id IN (SELECT doc FROM seeds)) <> (target_id IN (SELECT doc FROM seeds)) AND target_id LIKE 'doc%'), near2 AS (SELECT * FROM near WHERE doc IN (SELECT doc FROM docs))"""


@query(f"WITH {COCITED} SELECT doc, round(sum(score), 4) AS score, count(*) AS n FROM pairs GROUP BY 1")
def co_citation(spark, sf_dir):
    found = graph_rag.cocited(*citations(spark, sf_dir))
    return found.groupBy("doc").agg(F.round(F.sum("score"), 4).alias("score"), F.count("*").alias("n"))


@query(f"WITH {COCITED} SELECT doc, round(sum(score), 4) AS score FROM near2 GROUP BY 1")
def related_direct(spark, sf_dir):
    return graph_rag.direct(*citations(spark, sf_dir)).groupBy("doc").agg(F.round(F.sum("score"), 4).alias("score"))


@query(f"WITH {COCITED}, al AS (SELECT doc, round(sum(score), 4) AS score FROM (SELECT doc, score FROM pairs UNION ALL SELECT * FROM near2) GROUP BY 1) SELECT doc, score, (SELECT count(*) FROM al) > 5 AS truncated FROM al ORDER BY score DESC, doc LIMIT 5")
def related_documents(spark, sf_dir):
    return graph_rag.related(*citations(spark, sf_dir)).select("doc", "score", "truncated")


@query(f"""WITH {COCITED}, first AS (SELECT doc, sum(score) AS score FROM near2 GROUP BY 1),
step AS (SELECT f.score * c.weight * 0.5 AS score, CASE WHEN c.source_id = f.doc THEN c.target_id ELSE c.source_id END AS doc, c.source_id AS s, c.target_id AS t, relation FROM c JOIN first f ON f.doc IN (c.source_id, c.target_id) WHERE c.target_id LIKE 'doc%')
SELECT doc, round(score, 6) AS score FROM step WHERE doc IN (SELECT doc FROM docs) AND doc NOT IN (SELECT doc FROM seeds) AND doc NOT IN (SELECT doc FROM first) QUALIFY row_number() OVER (PARTITION BY doc ORDER BY s, t, relation) = 1""")
def related_depth2(spark, sf_dir):
    e, seeds, docs = citations(spark, sf_dir)
    first = graph_rag.direct(e, seeds, docs).groupBy("doc").agg(F.sum("score").alias("score"))
    return graph_rag.second_step(e, first, seeds, docs).withColumn("score", F.round("score", 6))


@query(f"WITH {CITED} SELECT hub, degree, round(1 / log2(2 + degree), 6) AS damping, degree > 24 AS dropped FROM deg")
def hub_damping(spark, sf_dir):
    e = citations(spark, sf_dir)[0].filter("target_id LIKE 'part%'")
    rows = e.groupBy(F.col("target_id").alias("hub")).agg(F.count("*").alias("degree"))
    return rows.withColumns({"damping": F.round(graph_rag.damping(F.col("degree")), 6), "dropped": F.col("degree") > 24})


@query(f"""WITH {CITED}, s AS (SELECT * FROM c WHERE source_id IN (SELECT doc FROM seeds) OR target_id IN (SELECT doc FROM seeds)),
p AS (SELECT DISTINCT target_id AS hub FROM s WHERE target_id LIKE 'part%')
SELECT CAST(2 AS BIGINT) AS seeds, (SELECT count(*) FROM s) AS seed_edges, (SELECT count(*) FROM p) AS pivots, (SELECT count(*) FROM p JOIN deg USING (hub) WHERE degree > 24) AS hubs_dropped, (SELECT count(*) FROM p JOIN deg USING (hub) WHERE degree BETWEEN 2 AND 24) AS shared_pivots, 'reachable' AS reason""")
def reachability_diagnostics(spark, sf_dir):
    return graph_rag.diagnostics(*citations(spark, sf_dir)).drop("document_neighbours")


@query("SELECT page_id, link, n FROM (SELECT page_id, unnest(regexp_extract_all(html, 'href=\"([^\"]+)\"', 1)) AS link FROM pages) JOIN (SELECT 1 AS n) ON true")
def page_links(spark, sf_dir):
    return V.table(spark, sf_dir, "pages").select("page_id", F.explode(T.links(F.col("html"))).alias("link"), F.lit(1).alias("n"))


@query("""SELECT page_id, md5(array_to_string(list_filter(list_transform(string_split(regexp_replace(regexp_replace(html, '(?is)<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>|<!--.*?-->', chr(10), 'g'), '<[^>]+>', chr(10), 'g'), chr(10)), lambda x: trim(x)), lambda x: x <> ''), chr(10))) AS text_key FROM pages""")
def html_strip(spark, sf_dir):
    return V.table(spark, sf_dir, "pages").select("page_id", F.md5(T.strip_tags(F.col("html"))).alias("text_key"))


@query("SELECT page_id, contains(lower(substring(html, 1, 20000)), 'captcha') AS blocked FROM pages")
def blocked_pages(spark, sf_dir):
    return V.table(spark, sf_dir, "pages").select("page_id", readers.blocked(F.col("html")).alias("blocked"))


@query("WITH s AS (SELECT min(o_orderdate)::DATE AS a, max(o_orderdate)::DATE AS b FROM orders) SELECT CAST(d AS DATE) AS begin, least(CAST(d + INTERVAL 89 DAY AS DATE), b) AS until FROM (SELECT unnest(generate_series(a, b, INTERVAL 90 DAY)) AS d, b FROM s)")
def filing_windows(spark, sf_dir):
    spans = V.table(spark, sf_dir, "orders").agg(F.to_date(F.min("o_orderdate")).alias("start"), F.to_date(F.max("o_orderdate")).alias("end"))
    return readers.filing_windows(spans).select("begin", "until")


@query("""WITH f AS (SELECT o_orderkey AS filing_id, o_custkey AS corp, o_orderdate::DATE AS filed, o_orderpriority AS report_name FROM orders), a AS (SELECT * FROM f WHERE report_name = '1-URGENT')
SELECT DISTINCT filing_id, corp, filed FROM (SELECT * FROM a UNION ALL SELECT f.* FROM f JOIN a ON a.corp = f.corp AND f.filed BETWEEN a.filed - 7 AND a.filed + 365)""")
def filing_family(spark, sf_dir):
    f = V.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("filing_id"), F.col("o_custkey").alias("corp"), F.to_date("o_orderdate").alias("filed"), F.col("o_orderpriority").alias("report_name"))
    return readers.filing_families(f.filter("report_name = '1-URGENT'"), f).select("filing_id", "corp", "filed")


@query("SELECT o_orderkey AS filing_id FROM orders WHERE contains(lower(replace(o_orderpriority, ' ', '')), 'urgent') OR contains(lower(replace(o_orderpriority, ' ', '')), '4-notspecified')")
def matching_filings(spark, sf_dir):
    f = V.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("filing_id"), F.col("o_orderpriority").alias("report_name"))
    return readers.matching_filings(f, ("urgent", "4-NOT Specified")).select("filing_id")


def events(spark, sf_dir):
    return V.table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS begin, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def event_tumbling(spark, sf_dir):
    return watch.tumbling(events(spark, sf_dir), "1 hour", ["event_type"]).select(F.col("w.start").cast("timestamp_ntz").alias("begin"), "event_type", "n", "total")


@query("SELECT time_bucket(INTERVAL 30 MINUTE, ts) - k * INTERVAL 30 MINUTE AS begin, event_type, count(*) AS n FROM events, (SELECT unnest([0, 1]) AS k) GROUP BY 1, 2")
def event_sliding(spark, sf_dir):
    return watch.sliding(events(spark, sf_dir), "1 hour", "30 minutes", ["event_type"]).select(F.col("w.start").cast("timestamp_ntz").alias("begin"), "event_type", "n")


@query("""WITH o AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 10 MINUTE THEN 0 ELSE 1 END AS new FROM events),
s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM o) SELECT user_id, min(ts) AS begin, count(*) AS n FROM s GROUP BY user_id, k""")
def event_session(spark, sf_dir):
    return watch.sessions(events(spark, sf_dir), "10 minutes", ["user_id"]).select("user_id", F.col("w.start").cast("timestamp_ntz").alias("begin"), "n")


@query("SELECT user_id, event_type, min(event_id) AS event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS k FROM events) WHERE k = 1 GROUP BY 1, 2")
def stream_dedup(spark, sf_dir):
    return watch.deduplicated(events(spark, sf_dir), ["user_id", "event_type"], "1 hour").select("user_id", "event_type", "event_id")
