"""Registered queries of text functions, small operators, parsing of profiled files and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera import constants as C
from tessera.functions import text as T
from tessera.operators import cache, evaluate, grading, graph, layers, reports, twins
from tessera.plans import parse, profiles
from tessera.plans import views as V
from tessera.plans.queries_search import terms_sql
from tessera.sources import sinks
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


docs = lambda spark, sf_dir: V.table(spark, sf_dir, "documents")

#: Documents with what cleaning is for: Windows and old line ends, controls, decomposed accents, wide spaces.
ODD = "concat(text, '\r\nnext\rline ', chr(7), 'e', chr(769), '  wide', chr(12288), chr(160), 'end ')"
ODD_SPARK = "concat(text, '\\r\\nnext\\rline ', char(7), 'e', decode(unhex('CC81'), 'utf-8'), '  wide', decode(unhex('E38080'), 'utf-8'), decode(unhex('C2A0'), 'utf-8'), 'end ')"
#: Documents with Korean, Japanese and mixed runs behind them.
WIDE = "concat(text, ' 가나다라마 한글ABC12 漢字かな x_1 가 나다 12가나 ', CAST(doc_id AS STRING))"


@query(f"""SELECT doc_id, sha256(nfc_normalize(t)) AS composed, sha256(regexp_replace(t, '[\t\n\f\r ]', '', 'g')) AS bare,
  sha256(trim(regexp_replace(t, '[\\s\\x0b\\x{{85}}\\x{{a0}}\\x{{1680}}\\x{{2000}}-\\x{{200a}}\\x{{2028}}\\x{{2029}}\\x{{202f}}\\x{{205f}}\\x{{3000}}\\x1c-\\x1f]+', ' ', 'g'))) AS collapsed,
  sha256(regexp_replace(t, '\r\n?', '\n', 'g')) AS unix, sha256(regexp_replace(t, '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f]', '', 'g')) AS printable FROM (SELECT doc_id, {ODD} AS t FROM documents)""")
def text_cleanup(spark, sf_dir):
    """Composition, white space, line ends and controls of every text."""
    t = F.col("t")
    made = {"composed": T.nfc(t), "bare": T.strip_ascii_space(t), "collapsed": T.collapse_space(t), "unix": T.unix_lines(t), "printable": T.strip_controls(t)}
    return docs(spark, sf_dir).select("doc_id", F.expr(ODD_SPARK).alias("t")).select("doc_id", *[T.sha256(c).alias(n) for n, c in made.items()])


@query(f"SELECT doc_id, md5(array_to_string({terms_sql('t')}, ' ')) AS terms, CAST(len({terms_sql('t')}) AS BIGINT) AS n FROM (SELECT doc_id, {WIDE} AS t FROM documents)")
def tokenizer_terms(spark, sf_dir):
    """The tokenizer of index and questions, runs of Korean, Chinese and Japanese as overlapping pairs."""
    terms = docs(spark, sf_dir).select("doc_id", T.index_terms(F.expr(WIDE)).alias("terms"))
    return terms.select("doc_id", F.md5(F.array_join("terms", " ")).alias("terms"), F.size("terms").cast("long").alias("n"))


@query(f"SELECT doc_id, md5(array_to_string(list_sort(list_distinct({terms_sql('t')})), ' ')) AS terms FROM (SELECT doc_id, {WIDE} AS t FROM documents)")
def question_terms(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", F.md5(F.array_join(F.array_sort(T.query_terms(F.expr(WIDE))), " ")).alias("terms"))


@query("SELECT doc_id, array_to_string(CASE WHEN length(w) > 2 THEN list_transform(range(1, length(w)), lambda i: substring(w, i, 2)) ELSE [w] END, '|') AS two, array_to_string(CASE WHEN length(w) > 3 THEN list_transform(range(1, length(w) - 1), lambda i: substring(w, i, 3)) ELSE [w] END, '|') AS three FROM (SELECT doc_id, substring(regexp_extract(text, '[^ \n]+'), 1, 12) AS w FROM documents)")
def character_ngrams(spark, sf_dir):
    word = F.substring(F.regexp_extract("text", "[^ \n]+", 0), 1, 12)
    return docs(spark, sf_dir).select("doc_id", *[F.array_join(T.ngrams(word, n), "|").alias(name) for n, name in ((2, "two"), (3, "three"))])


PATHS = "concat(source, '/', CAST(doc_id AS STRING), '_', regexp_replace(substring(text, 1, 24), '[\\x00-\\x1f]', ' '@G), '.', CASE doc_id % 3 WHEN 0 THEN 'MD' WHEN 1 THEN 'HwpX' ELSE 'txt' END)"


@query(f"""SELECT doc_id, lower(regexp_extract(p, '\\.([^.]+)$', 1)) AS ext, trim(regexp_replace(lower(nfc_normalize(p)), '[^\\p{{L}}\\p{{M}}\\p{{Nd}}\\p{{Pc}}]+', '-', 'g'), '-') AS slug,
  trim(regexp_replace(p, '[\\\\/:*?"<>|\\x00-\\x1f]+', '_', 'g')) AS file_name, CASE WHEN instr(p, '/') > 0 THEN split_part(p, '/', 1) ELSE '_root' END AS collection,
  lower(regexp_replace(nfc_normalize(p), '[\\s\\x{{a0}}\\x{{3000}}]+', '', 'g')) AS folded,
  regexp_replace(regexp_replace(regexp_replace(substring(p, instr(p, '/') + 1), '\\.[A-Za-z0-9]+$', ''), '^\\d+_', ''), '_', ' · ', 'g') AS label FROM (SELECT doc_id, {V.duck(PATHS)} AS p FROM documents)""")
def path_names(spark, sf_dir):
    """What is made of a path: extension, slug, safe file name, collection, folded name, label."""
    rows = docs(spark, sf_dir).select("doc_id", F.expr(V.sql_for(PATHS, True).replace("\\", "\\\\")).alias("p"))
    p = F.col("p")
    return rows.select("doc_id", T.extension(p).alias("ext"), T.slug(p).alias("slug"), T.file_name(p).alias("file_name"), T.collection(p).alias("collection"), T.company_key(p).alias("folded"), T.label(F.expr("substring(p, instr(p, '/') + 1)")).alias("label"))


@query("SELECT doc_id, md5(substring(text, 1, 400)) AS shown, length(text) > 400 AS truncated FROM documents")
def snippets(spark, sf_dir):
    cut = T.snippet(F.col("text"))
    return docs(spark, sf_dir).select("doc_id", F.md5(cut["text"]).alias("shown"), cut["truncated"].alias("truncated"))


@query(f"WITH t AS (SELECT item_id, list_distinct({terms_sql('text')}) AS s FROM benchmark) SELECT a.item_id, CAST(len(list_intersect(a.s, b.s)) AS BIGINT) AS shared, round(len(list_intersect(a.s, b.s)) / (len(a.s) + len(b.s) - len(list_intersect(a.s, b.s))), 6) AS jaccard FROM t a JOIN t b ON b.item_id = a.item_id + 1 WHERE len(a.s) + len(b.s) > 0")
def term_overlap(spark, sf_dir):
    """Shared terms of neighbouring benchmark texts, and their Jaccard similarity."""
    t = V.table(spark, sf_dir, "benchmark").select("item_id", T.query_terms(F.col("text")).alias("s"))
    both = t.join(t.select((F.col("item_id") - 1).alias("item_id"), F.col("s").alias("other")), "item_id").filter(F.size("s") + F.size("other") > 0)
    return both.select("item_id", F.size(F.array_intersect("s", "other")).cast("long").alias("shared"), F.round(T.jaccard(F.col("s"), F.col("other")), 6).alias("jaccard"))


@query("SELECT to_json({'doc_id': doc_id, 'lang': lang, 'n_chars': n_chars, 'source': source})::VARCHAR AS value FROM documents")
def json_rows(spark, sf_dir):
    """Rows as compact JSON with sorted keys."""
    return sinks.json_lines(docs(spark, sf_dir).select("source", "n_chars", "lang", "doc_id"))


@query("SELECT CAST(floor(10 * share) AS BIGINT) AS tenth, count(*) AS n FROM (SELECT length(regexp_replace(t, '[^─-╿]', '', 'g')) / length(t) AS share FROM (SELECT concat(substring(text, 1, CAST(doc_id % 50 AS INTEGER) + 1), repeat('─│', CAST(doc_id % 23 AS INTEGER))) AS t FROM documents) WHERE length(t) > 0) GROUP BY 1")
def box_drawing_shares(spark, sf_dir):
    """Histogram of the share of box-drawing characters."""
    t = docs(spark, sf_dir).select(F.expr("concat(substring(text, 1, CAST(doc_id % 50 AS INT) + 1), repeat('─│', CAST(doc_id % 23 AS INT)))").alias("t")).filter(F.length("t") > 0)
    return t.groupBy(F.floor(10 * reports.box_share(F.col("t"))).alias("tenth")).agg(F.count("*").alias("n"))


@query("SELECT page, line, score, score < 0.80 AS severe FROM (SELECT label AS page, vec_id AS line, round(abs(CAST(embedding[1] AS DOUBLE)) * 3, 3) AS score FROM embeddings) WHERE score < 0.92")
def hot_spots(spark, sf_dir):
    rows = V.table(spark, sf_dir, "embeddings").select(F.col("label").alias("page"), F.col("vec_id").alias("line"), F.round(F.abs(F.col("embedding")[0].cast("double")) * 3, 3).alias("score"))
    return reports.hotspots(rows)


@query("SELECT c_custkey AS key, CASE WHEN c_custkey % 3 = 0 THEN 'new' ELSE c_name END AS value FROM customer UNION ALL SELECT -1, 'new'")
def upsert_values(spark, sf_dir):
    rows = V.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("value"))
    new = rows.filter("key % 3 = 0").select("key", F.lit("new").alias("value")).unionAll(spark.createDataFrame([(-1, "new")], rows.schema))
    return sinks.upsert_meta(rows, new)


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey < 10)")
def prune_rows(spark, sf_dir):
    """Rows whose key is still alive."""
    live = V.table(spark, sf_dir, "customer").filter("c_nationkey < 10").select(F.col("c_custkey").alias("o_custkey"))
    return sinks.prune(V.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), live, "o_custkey").select("o_orderkey", "o_custkey")


@query("SELECT l_orderkey, l_partkey, l_quantity FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber, l_partkey, l_quantity) = 1")
def latest_of_key(spark, sf_dir):
    rows = V.table(spark, sf_dir, "lineitem")
    return layers.first_by(rows, ["l_orderkey"], [F.desc("l_shipdate"), F.asc("l_linenumber"), F.asc("l_partkey"), F.asc("l_quantity")]).select("l_orderkey", "l_partkey", "l_quantity")


@query(f"""WITH e AS ({V.duck(V.GRAPH)}), n AS (SELECT DISTINCT id AS node_id FROM (SELECT source_id AS id FROM e UNION ALL SELECT target_id FROM e UNION ALL SELECT 's-lonely')),
shown AS (SELECT node_id FROM n WHERE NOT (node_id LIKE 's%' AND node_id LIKE '%3')), kept AS (SELECT * FROM e WHERE source_id IN (SELECT node_id FROM shown) AND target_id IN (SELECT node_id FROM shown))
SELECT node_id FROM shown WHERE node_id IN (SELECT source_id FROM kept UNION SELECT target_id FROM kept)""")
def viewer_nodes(spark, sf_dir):
    """Nodes that a drawing shows: hidden kinds, dangling edges and lone nodes fall away."""
    e = V.view(spark, sf_dir, V.GRAPH)
    n = e.select(F.col("source_id").alias("node_id")).union(e.select("target_id")).union(spark.createDataFrame([("s-lonely",)], "node_id string")).distinct()
    kind = F.when(F.col("node_id").like("s%") & F.col("node_id").like("%3"), "symbol").otherwise("document")
    return graph.connected_only(n.withColumn("kind", kind), e)[0].select("node_id")


@query(f"WITH e AS ({V.duck(V.GRAPH)}) SELECT (SELECT count(*) FROM supplier) AS nodes, (SELECT count(*) FROM e) AS edges")
def graph_signature(spark, sf_dir):
    return graph.change_signature(V.table(spark, sf_dir, "supplier"), V.view(spark, sf_dir, V.GRAPH))


@query("SELECT round(min(CASE WHEN p THEN s END), 6) AS least_positive, round(max(CASE WHEN NOT p THEN s END), 6) AS greatest_negative, round(min(CASE WHEN p THEN s END) - max(CASE WHEN NOT p THEN s END), 6) AS margin, min(CASE WHEN p THEN s END) >= 0.89 AND max(CASE WHEN NOT p THEN s END) <= 0.63 AS ok FROM (SELECT vec_id % 10 = 0 AS p, CASE WHEN vec_id % 10 = 0 THEN 0.9 + label / 100.0 ELSE label / 20.0 END AS s FROM embeddings)")
def twin_separation(spark, sf_dir):
    rows = V.table(spark, sf_dir, "embeddings").select((F.col("vec_id") % 10 == 0).alias("positive"), F.expr("CASE WHEN vec_id % 10 = 0 THEN CAST(0.9 AS DOUBLE) + label / CAST(100 AS DOUBLE) ELSE label / CAST(20 AS DOUBLE) END").alias("jaccard"))
    return twins.separation(rows).select(*[F.round(c, 6).alias(c) for c in ("least_positive", "greatest_negative", "margin")], "ok")


@query("SELECT conv_id, turn, CAST(len(list_filter(regexp_extract_all(t, '(?is).{0,60}the\\ way.{0,60}'), lambda c: NOT regexp_matches(c, '(?i)\\b(no|not|never|without|must not|cannot|prohibited|forbidden)\\b|않|금지|없'))) AS BIGINT) AS hits FROM (SELECT conv_id, turn, concat(CASE turn % 3 WHEN 0 THEN 'this is not ' WHEN 1 THEN 'this is ' ELSE '' END, 'the way ', text) AS t FROM conversations)")
def banned_phrases(spark, sf_dir):
    """Contexts of a phrase without a negation nearby."""
    t = F.concat(F.when(F.col("turn") % 3 == 0, "this is not ").when(F.col("turn") % 3 == 1, "this is ").otherwise(""), F.lit("the way "), F.col("text"))
    return V.table(spark, sf_dir, "conversations").select("conv_id", "turn", F.size(grading.banned_hits(t, "the way")).cast("long").alias("hits"))


@query("SELECT count(*) AS total, count(*) FILTER (WHERE ok) AS resolved, count(*) FILTER (WHERE ok) >= 0.6 * count(*) AS ok FROM (SELECT n_nationkey, EXISTS (SELECT 1 FROM region r WHERE instr(r.r_name, substring(n.n_name, 1, 1)) > 0) AS ok FROM nation n)")
def resolvable_judgments(spark, sf_dir):
    judged = V.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("query_id"), F.substring("n_name", 1, 1).alias("pattern"))
    return evaluate.resolvable(judged, V.table(spark, sf_dir, "region").select(F.col("r_name").alias("heading")))


@query("""WITH e AS (SELECT n_nationkey AS query_id, '^n' || (n_nationkey % 7) || '$' AS doc, substring(n_name, 1, 1) AS heading FROM nation),
k AS (SELECT DISTINCT 'n' || n_regionkey AS doc_id FROM nation), rel AS (SELECT n_nationkey AS query_id, 'n' || (n_nationkey % 5) AS doc_id, n_name AS h FROM nation WHERE n_nationkey % 2 = 0), res AS (SELECT n_nationkey AS query_id, 'n' || (n_nationkey % 5) AS doc_id, n_name AS h FROM nation WHERE n_nationkey % 3 = 0),
o AS (SELECT CASE WHEN NOT EXISTS (SELECT 1 FROM k WHERE regexp_matches(k.doc_id, e.doc)) THEN 'skipped' WHEN EXISTS (SELECT 1 FROM rel WHERE rel.query_id = e.query_id AND regexp_matches(rel.doc_id, e.doc) AND regexp_matches(rel.h, e.heading)) THEN 'hit'
  WHEN EXISTS (SELECT 1 FROM res WHERE res.query_id = e.query_id AND regexp_matches(res.doc_id, e.doc) AND regexp_matches(res.h, e.heading)) THEN 'absorbed' ELSE 'miss' END AS outcome FROM e)
SELECT count(*) FILTER (WHERE outcome = 'hit') AS hits, count(*) FILTER (WHERE outcome = 'miss') AS misses, count(*) FILTER (WHERE outcome = 'absorbed') AS absorbed, count(*) FILTER (WHERE outcome = 'skipped') AS skipped, round(count(*) FILTER (WHERE outcome = 'hit') / nullif(count(*) FILTER (WHERE outcome IN ('hit', 'miss')), 0), 4) AS related_recall FROM o""")
def related_recall(spark, sf_dir):
    """Expected related sections against those found, those that the results held already, and unknown documents."""
    n = V.table(spark, sf_dir, "nation")
    name = lambda k: F.concat(F.lit("n"), (F.col("n_nationkey") % k).cast("string"))
    expected = n.select(F.col("n_nationkey").alias("query_id"), F.concat(F.lit("^"), name(7), F.lit("$")).alias("doc"), F.substring("n_name", 1, 1).alias("heading"))
    found = n.select(F.col("n_nationkey").alias("query_id"), name(5).alias("doc_id"), F.col("n_name").alias("heading_text"))
    known = n.select(F.concat(F.lit("n"), F.col("n_regionkey").cast("string")).alias("doc_id"), F.lit("").alias("heading_text")).distinct()
    return evaluate.related_recall(evaluate.related_outcomes(expected, found.filter("query_id % 2 = 0"), found.filter("query_id % 3 = 0"), known))


@query("SELECT doc_id, text_a = text_b AS same, CASE WHEN text_a = text_b THEN 0 ELSE (doc_id % 7) + 1 END AS first_difference FROM (SELECT doc_id, repeat('ab', 10) AS text_a, CASE WHEN doc_id % 5 = 0 THEN repeat('ab', 10) ELSE substring(repeat('ab', 10), 1, CAST(doc_id % 7 AS INTEGER)) || '*' || substring(repeat('ab', 10), CAST(doc_id % 7 AS INTEGER) + 2) END AS text_b FROM documents)")
def exact_twin_probe(spark, sf_dir):
    rows = docs(spark, sf_dir).select("doc_id", F.expr("repeat('ab', 10)").alias("text_a"), F.expr("CASE WHEN doc_id % 5 = 0 THEN repeat('ab', 10) ELSE concat(substring(repeat('ab', 10), 1, CAST(doc_id % 7 AS INT)), '*', substring(repeat('ab', 10), CAST(doc_id % 7 AS INT) + 2)) END").alias("text_b"))
    return twins.divergence(rows).select("doc_id", "same", F.coalesce("first_difference", F.lit(0).cast("long")).alias("first_difference"))


@query("SELECT rel_path FROM (SELECT concat(source, '/', CAST(doc_id // 3 AS STRING), CASE doc_id % 3 WHEN 0 THEN '.pdf' WHEN 1 THEN '.hwp' ELSE '.docx' END) AS rel_path, source || '/' || CAST(doc_id // 3 AS STRING) AS stem, CASE doc_id % 3 WHEN 0 THEN 1 WHEN 1 THEN 9 ELSE 7 END AS p FROM documents QUALIFY row_number() OVER (PARTITION BY stem ORDER BY p DESC, rel_path) = 1) WHERE rel_path NOT IN (SELECT source || '/' || CAST(doc_id // 3 AS STRING) || '.hwp' FROM documents WHERE doc_id % 30 = 1)")
def seed_files(spark, sf_dir):
    """Of files that differ only in format the best one, unless it is there already."""
    path = F.expr("concat(source, '/', CAST(doc_id DIV 3 AS STRING), CASE doc_id % 3 WHEN 0 THEN '.pdf' WHEN 1 THEN '.hwp' ELSE '.docx' END)")
    rows = docs(spark, sf_dir).select("doc_id", path.alias("rel_path"))
    return watch.seed_set(rows, rows.filter("doc_id % 30 = 1")).select("rel_path")


@query("SELECT embed_key, place FROM (SELECT embed_key, row_number() OVER (ORDER BY embed_key) - 1 AS place FROM (SELECT DISTINCT sha256(text) AS embed_key FROM documents)) WHERE place % 97 = 0")
def stride_sample(spark, sf_dir):
    """Every 97th key of the sorted keys."""
    return cache.every(cache.keyed(docs(spark, sf_dir).select(F.col("text").alias("embed_text"))).select("embed_key").distinct(), "embed_key", 97)


@query("SELECT item_id FROM benchmark WHERE item_id % 4 = 1")
def text_parity(spark, sf_dir):
    """Texts of an index that differ from those of the lake."""
    rows = V.table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("chunk_id"), F.col("text").alias("embed_text"))
    other = rows.withColumn("embed_text", F.when(F.col("chunk_id") % 4 == 1, F.concat("embed_text", F.lit("."))).otherwise(F.col("embed_text")))
    return cache.text_mismatches(rows, other).select(F.col("chunk_id").alias("item_id"))


@query("SELECT round(min(list_cosine_similarity(CAST(embedding AS DOUBLE[]), CAST(list_concat([embedding[1] + 0.125], embedding[2:]) AS DOUBLE[]))), 6) AS worst, count(*) AS n FROM embeddings")
def provider_equivalence(spark, sf_dir):
    """Worst cosine of two providers' vectors of the same things."""
    rows = V.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("chunk_id"), "embedding")
    moved = F.concat(F.array((F.col("embedding")[0] + F.lit(0.125)).cast("float")), F.expr("slice(embedding, 2, size(embedding) - 1)"))
    return cache.equivalence(rows, rows.select("chunk_id", moved.alias("embedding")))


#: Files of four kinds: bills, decrees, memos and contracts, with a text of the documents inside. LAW(n) stands for a law's name.
FILES = """concat(CASE doc_id % 4
  WHEN 0 THEN concat('의안 번호 ', CAST(doc_id AS STRING), '@N제안이유@N「가나', CAST(doc_id % 50 AS STRING), '법」 일부를 개정하려는 것임.@N주요내용@N「다라법」에 따른 사항.@N제1장 총칙@N제1조(목적) 목적.@N제2조(정의) 정의.@N부 칙@N제1조(시행일) 공포한 날.@N')
  WHEN 1 THEN concat('제1장 총칙@N제1조(목적) 이 영은 「마바', CAST(doc_id % 50 AS STRING), '법」에서 위임된 사항을 정한다.@N제2-1조(정의) 「사아법」에 따른 정의.@N부칙@N제1조(시행일) 공포한 날.@N')
  WHEN 2 THEN '메모@N'
  ELSE '갑과 을은 다음과 같이 정한다.@N제1조(목적) 계약의 목적.@N' END, text)"""
FILES_SQL = FILES.replace("@N", "\n")


def profiled_files(spark, sf_dir):
    rows = docs(spark, sf_dir)
    return rows.select(F.concat(F.lit("f"), F.col("doc_id").cast("string")).alias("doc_id"), F.concat(F.lit("x/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("rel_path"), F.expr(FILES.replace("@N", "\\n")).alias("content"))


def _re2(pattern: str) -> str:
    return "(?m)" + pattern.replace("'", "''")


def claimed_sql() -> str:
    has = lambda p: f"regexp_matches(head, '{_re2(p)}')"
    cases = " ".join(f"WHEN {' AND '.join([*map(has, p.require), *('NOT ' + has(x) for x in p.reject)])} THEN '{p.name}'" for p in profiles.PROFILES)
    return f"SELECT doc_id, content, CASE {cases} ELSE 'markdown' END AS doc_type FROM (SELECT doc_id, content, concat('x/', CAST(doc_id AS STRING), '.txt', chr(10), substring(content, 1, 8000)) AS head FROM (SELECT doc_id, {FILES_SQL} AS content FROM documents))"


@query(f"SELECT doc_type, count(*) AS n FROM ({claimed_sql()}) GROUP BY 1")
def profile_classify(spark, sf_dir):
    """How many text files each profile claims: bills, statutes, and neither."""
    return parse.parsed(profiled_files(spark, sf_dir)).groupBy("doc_type").agg(F.count("*").alias("n"))


@query(f"WITH c AS ({claimed_sql()}) SELECT DISTINCT 'f' || doc_id AS doc_id, relation, target FROM ("
       + " UNION ALL ".join(f"SELECT doc_id, '{e.relation}' AS relation, trim(unnest(regexp_extract_all(content, '{_re2(e.pattern)}', 1))) AS target FROM c WHERE doc_type = '{p.name}'" for p in profiles.PROFILES for e in p.edges) + ")")
def profile_edges(spark, sf_dir):
    """Edges to laws that profiles read from bills and decrees."""
    rows = parse.relation_rows(parse.parsed(profiled_files(spark, sf_dir))).filter("target_kind = 'statute'")
    return rows.select("doc_id", "relation", F.col("target_entity").alias("target"))


@query("SELECT 'f' || doc_id AS doc_id, heading FROM documents, (SELECT unnest(['제안이유', '주요내용', '본칙', '본칙 · 제1조(목적)', '본칙 · 제2조(정의)', '부칙', '부칙 · 제1조(시행일)']) AS heading) WHERE doc_id % 4 = 0 UNION ALL SELECT 'f' || doc_id, heading FROM documents, (SELECT unnest(['제1장 총칙', '제1조(목적)', '제2-1조(정의)', '부칙', '부칙 · 제1조(시행일)']) AS heading) WHERE doc_id % 4 = 1")
def profile_headings(spark, sf_dir):
    """Headings under which the chunks of profiled files stand."""
    chunks = parse.chunk_rows(parse.parsed(profiled_files(spark, sf_dir))).filter("doc_type in ('bill', 'statute')")
    known = [f"{z}{h}" for z in ("", "본칙 · ", "부칙 · ") for h in ("제안이유", "주요내용", "본칙", "부칙", "제1장 총칙", "제1조(목적)", "제2조(정의)", "제2-1조(정의)", "제1조(시행일)")]
    return chunks.filter(F.col("heading").isin(known)).select("doc_id", "heading").distinct()
