import math

import pytest
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.operators import cache, evaluate, graph, graph_rag, grading, reports, search

TEXTS = {"c1": "apples and pears", "c2": "apples apples apples", "c3": "nothing here", "c4": "pears"}


@pytest.fixture(scope="module")
def index(spark):
    rows = [(k, f"d{i % 2}", "h", "col", i, t) for i, (k, t) in enumerate(TEXTS.items())]
    chunks = spark.createDataFrame(rows, "chunk_id string, doc_id string, heading string, collection string, chunk_index int, content string")
    vectors = spark.createDataFrame([(k, [float(i), 1.0]) for i, k in enumerate(TEXTS)], "chunk_id string, embedding array<float>")
    return search.Index(chunks, vectors, search.postings(chunks, T.index_terms(F.col("content"))))


def test_path_strength_ranks_all_nodes(spark, monkeypatch):
    from tessera.plans import queries_graph

    walked = spark.range(100_010).selectExpr("concat('m', id) AS node_id", "1L AS depth", "1.0D AS total_weight").union(spark.createDataFrame([("n1", 2, 1.0)], "node_id string, depth long, total_weight double"))
    monkeypatch.setattr(queries_graph, "graph_walk_down", lambda *_: walked)
    got = queries_graph.path_strength(spark, "").first()
    assert (got.reach, got.p1, got.mrr, got.path_strength) == (1.0, 0.0, round(1 / 100_011, 6), 0.5)


def test_bm25_by_hand(index):
    got = {r.chunk_id: r.score for r in search.keyword_hits(index.posts, ["apples"]).collect()}
    docs = {k: t.split() for k, t in TEXTS.items()}
    avg = sum(map(len, docs.values())) / len(docs)
    idf = max(math.log((4 - 2 + 0.5) / (2 + 0.5)), 1e-6)
    want = {k: round(idf * w.count("apples") * 2.2 / (w.count("apples") + 1.2 * (0.25 + 0.75 * len(w) / avg)), 6) for k, w in docs.items() if "apples" in w}
    assert got == want


@pytest.mark.parametrize("most", [1000, 4])
def test_many_questions_are_scored_where_the_lists_lie(spark, most):
    chunks = spark.createDataFrame([(k, " ".join(f"w{k % n}" for n in (1, 2, 3, 5, 7)) + " w0" * (k % 4)) for k in range(300)] + [(999, "")], "chunk_id long, content string").repartition(7)
    lists = search.term_lists(chunks, T.index_terms(F.col("content"))).persist()
    asked = spark.createDataFrame([(q, f"w{t}") for q in range(6) for t in (0, q, q + 1, 77)], "query_id long, term string").distinct()
    best = search.bm25_top(lists, asked, 10, most=most)
    posts = search.postings(chunks, T.index_terms(F.col("content")))
    plain = search.top(search.bm25(posts, asked), 10, [F.desc("score"), F.asc("chunk_id")], ["query_id"])
    rows = lambda df: sorted(map(tuple, df.select("query_id", "chunk_id", "score", "rank").collect()))
    assert rows(best) == rows(plain) and len(rows(best)) == 60
    plan = lists.select("*")._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and "hashpartitioning" not in search.term_lists(chunks, T.index_terms(F.col("content")))._jdf.queryExecution().executedPlan().toString()
    assert not search.bm25_top(lists, asked.filter("term = 'w77'"), 10).count()


def test_vector_hits_and_zero_query(index):
    assert [r.chunk_id for r in search.vector_hits(index.vectors, [3.0, 1.0], 2).collect()] == ["c4", "c3"]
    assert search.vector_hits(index.vectors, [0.0, 0.0]).count() == 0


def test_section_cap_and_search(index):
    one = index.search_once(["apples"], [0.0, 1.0], limit=4, cap=1).collect()
    assert len(one) == 2 and [r.position for r in one] == [1, 2]
    many = index.search([(["apples"], [0.0, 1.0]), (["pears"], [3.0, 1.0])], limit=4, cap=2)
    assert many.count() == 4
    with pytest.raises(ValueError):
        search.section_cap(index.chunks, 0)
    assert index.search([(["apples"], [0.0, 1.0])], limit=2, reranked=True).count() == 2


def test_results_are_a_prefix_of_longer_ones(index):
    variants = [(["apples"], [0.0, 1.0])]
    long = [r.chunk_id for r in index.search(variants, limit=4, cap=2).orderBy("rank").collect()]
    assert [r.chunk_id for r in index.search(variants, limit=2, cap=2).orderBy("rank").collect()] == long[:2]


def test_aliases():
    groups = {"coin": ["virtual asset", "crypto", "coin"]}
    assert search.alias_variants("law of Crypto trade", groups) == ["law of Crypto trade", "law of virtual asset trade", "law of coin trade"]
    assert search.alias_variants("plain", groups) == ["plain"]


EDGES = [("a", "b", "uses", 0.8), ("b", "c", "uses", 0.5), ("c", "a", "uses", 0.5), ("a", "c", "mentions", 0.3)]


def test_walk_stops_at_cycles(spark):
    edges = spark.createDataFrame(EDGES, "source_id string, target_id string, relation string, weight double")
    start = spark.createDataFrame([("a",)], "node_id string")
    got = {r.node_id: (r.depth, r.total_weight, r.via) for r in graph.reached(edges, start, "downstream", 5).collect()}
    assert got == {"b": (1, 0.8, "uses"), "c": (2, 1.3, "uses")}
    up = {r.node_id: r.depth for r in graph.reached(edges, start, "upstream", 5).collect()}
    assert up == {"c": 1, "b": 2}
    assert graph.reached(edges, spark.createDataFrame([("?",)], "node_id string")).count() == 0
    for bad in (lambda: graph.walk(edges, start, "sideways"), lambda: graph.walk(edges, start, max_depth=0)):
        with pytest.raises(ValueError):
            bad()


def cites(spark, rows):
    return spark.createDataFrame([(s, t, "references", 0.5, f"{s} cites {t}") for s, t in rows], "source_id string, target_id string, relation string, weight double, evidence string")


def ids(spark, names):
    return spark.createDataFrame([(n,) for n in names], "doc string")


def test_related_documents(spark):
    docs = ids(spark, ["s", "x", "y", "z", *[f"h{i}" for i in range(30)]])
    edges = cites(spark, [("s", "x"), ("s", "p"), ("y", "p"), ("x", "z"), ("s", "hub"), *[(f"h{i}", "hub") for i in range(30)]])
    seeds = ids(spark, ["s"])
    one = {r.doc: r.score for r in graph_rag.related(edges, seeds, docs).collect()}
    assert one == {"x": 0.5, "y": round(0.5 / math.log2(4), 4)}
    two = {r.doc: r.score for r in graph_rag.related(edges, seeds, docs, depth=2).collect()}
    assert two["z"] == 0.125
    assert "x" not in {r.doc for r in graph_rag.related(edges, seeds, docs, hidden=ids(spark, ["x"])).collect()}
    reason = lambda e, s: graph_rag.diagnostics(e, ids(spark, s), docs).first()
    assert reason(edges, ["s"]).reason == "reachable" and reason(edges, ["s"]).hubs_dropped == 1
    assert reason(edges, ["lonely"]).reason == "seeds have no edges"
    assert reason(cites(spark, [("s", "hub"), *[(f"h{i}", "hub") for i in range(30)]]), ["s"]).reason == "only hubs in common"


def test_passages(spark, index):
    related = spark.createDataFrame([("d0", 1.0, ["apples"]), ("d1", 1.0, ["zzz"])], "doc string, score double, connectives array<string>")
    none = spark.createDataFrame([], "chunk_id string, rank long")
    hits = spark.createDataFrame([("c1", 1)], "chunk_id string, rank long")
    got = {(r.doc_id, r.chunk_id): r.match for r in graph_rag.passages(related, index.chunks, hits, none, ["pears"]).collect()}
    assert got[("d0", "c1")] == "query_match" and got[("d1", "c4")] == "lexical_overlap"


@pytest.mark.parametrize("options", [{}, {"reranked": True}])
def test_ask_leaves_the_results_alone(spark, index, options):
    edges = spark.createDataFrame([("d0", "term", "uses", 0.8, "pears"), ("d1", "term", "uses", 0.5, "apples")], "source_id string, target_id string, relation string, weight double, evidence string")
    documents = spark.createDataFrame([("d0",), ("d1",)], "doc string")
    variants = [(["nothing"], [2.0, 1.0])]
    plain = index.search(variants, 5, **options).collect()
    results, related, passages = graph_rag.ask(index, edges, documents, variants, **options)
    assert results.collect() == plain and {r.doc_id for r in plain} == {"d0", "d1"}
    assert related.count() == 0 and passages.count() == 0  # both documents are results already
    results, related = graph_rag.graph_search(index, edges, documents, variants, limit=1, seed_limit=1, **options)
    assert results.collect() == plain[:1]
    other = "d1" if plain[0].doc_id == "d0" else "d0"
    assert [(r.doc, r.score) for r in related.collect()] == [(other, 0.25)]


def test_metrics_and_floors(spark):
    ranked = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 7)], "query_id int, item string, rank int")
    relevant = spark.createDataFrame([(1, "b"), (2, "c"), (3, "z")], "query_id int, item string")
    got = {r.query_id: (r.p1, r.r5, r.r10, round(r.mrr, 4)) for r in evaluate.hit_metrics(ranked, relevant, relevant).collect()}
    assert got == {1: (0.0, 1.0, 1.0, 0.5), 2: (0.0, 0.0, 1.0, 0.1429), 3: (0.0, 0.0, 0.0, 0.0)}
    cur = spark.createDataFrame([("v", "p1", 0.5), ("v", "mrr", 0.79)], "arm string, metric string, value double")
    base = spark.createDataFrame([("v", "p1", 0.53), ("v", "mrr", 0.80), ("k", "p1", 0.1)], "arm string, metric string, value double")
    assert {(r.arm, r.metric) for r in evaluate.regressions(cur, base).collect()} == {("v", "p1"), ("k", "p1")}
    judged = spark.createDataFrame([(1, "a.b"), (2, "zzz")], "query_id int, pattern string")
    items = spark.createDataFrame([("x a.b y",), ("x aXb",)], "heading string")
    assert evaluate.resolvable(judged, items).first().ok is False


def test_runs_are_compared_only_on_equal_terms():
    meta = {"judgment_sha": "a", "chunk_count": "5"}
    assert evaluate.comparison_status(meta, meta) == "compare"
    assert evaluate.comparison_status(meta, {**meta, "chunk_count": "6"}) == "skip"
    assert evaluate.comparison_status(meta, {}, strict=True) == "fail"


def test_cache_reuses_and_prunes(spark):
    texts = spark.createDataFrame([("1", "one"), ("2", "two"), ("3", "two")], "chunk_id string, embed_text string")
    old = cache.keyed(spark.createDataFrame([("one",), ("dead",)], "embed_text string")).selectExpr("embed_key", "array(float(9)) as embedding", "'s' as signature")
    found, fresh = cache.encode_with_cache(texts, old, "s", lambda c: F.array(F.length(c).cast("float")))
    assert {r.chunk_id: r.embedding for r in found.collect()} == {"1": [9.0], "2": [3.0], "3": [3.0]} and fresh.count() == 2
    again, _ = cache.encode_with_cache(texts, old, "other", lambda c: F.array(F.length(c).cast("float")))
    assert {r.embedding[0] for r in again.collect()} == {3.0}
    with pytest.raises(cache.SignatureError):
        cache.assert_current("a", "b")


def test_grading(spark):
    out = spark.createDataFrame([("o", "we never promise returns. fine"), ("p", "we promise returns")], "output_id string, content string")
    assert [len(r[0]) for r in out.select(grading.banned_hits(F.col("content"), "promise returns")).collect()] == [0, 1]
    manual = out.filter("output_id = 'o'").selectExpr("output_id", "'tone' as assertion", "sha2(content, 256) as digest", "true as passed").unionAll(out.filter("output_id = 'p'").selectExpr("output_id", "'tone'", "'stale'", "true"))
    got = {(r.output_id, r.assertion): r.passed for r in grading.grade(out, [("fine", "fine", True)], manual).collect()}
    assert got == {("o", "fine"): True, ("p", "fine"): False, ("o", "tone"): True, ("p", "tone"): None}


def test_a_negation_ends_at_any_letter_that_is_not_ascii(spark):
    texts = [("a", "noñ the way"), ("b", "éno the way"), ("c", "no_x the way"), ("d", "No. the way"), ("e", "nota the way")]
    out = spark.createDataFrame(texts, "k string, t string").select("k", F.size(grading.banned_hits(F.col("t"), "the way")))
    assert dict(map(tuple, out.collect())) == {"a": 0, "b": 0, "c": 1, "d": 0, "e": 1}


def test_reports(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("a", 9.0), ("a", 2.0)], "k string, v double")
    assert df.agg(reports.upper_median("v")).first()[0] == 3.0
    assert reports.only_in(df.select("v"), df.select("v")).count() == 0
    files = spark.createDataFrame([("c", "f", "abcd")], "collection string, filename string, sha256 string")
    assert reports.undeclared(files, spark.createDataFrame([("c", "f", "ab")], "collection string, filename string, sha256 string")).count() == 0


@pytest.mark.parametrize("most", [10_000_000, 40, 8])
def test_nearest_of_many_queries(spark, most):
    """Queries held by every task, and dealt in blocks against blocks of vectors, find what brute force finds, ties by id."""
    import numpy as np

    rng = np.random.default_rng(5)
    x = rng.integers(0, 3, size=(60, 4)).astype(float)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    asked = df.filter("vec_id % 5 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    want = set()
    for i in range(0, 60, 5):
        d = [(round(float(np.sqrt(((x[i] - v) ** 2).sum())), 6), j) for j, v in enumerate(x)]
        want |= {(i, j, dist, k) for k, (dist, j) in enumerate(sorted(d)[:7], 1)}
    got = search.knn_batch(df.repartition(3), asked, 7, most=most).select("query_id", "vec_id", "distance", "rank").collect()
    assert {tuple(r) for r in got} == want
    assert search.knn_batch(df, asked.limit(0), 7, most=most).count() == 0 == search.knn_batch(df.limit(0), asked, 7, most=most).count()


def test_strides_and_derived_cache(spark):
    keys = spark.createDataFrame([(f"k{i:03d}", i) for i in range(100)], "embed_key string, n int").repartition(5)
    assert sorted((r.place, r.n) for r in cache.every(keys, "embed_key", 9).collect()) == [(k, k) for k in range(0, 100, 9)]
    chunks = spark.createDataFrame([(1, "same"), (2, "same"), (3, "other")], "chunk_id long, embed_text string")
    vectors = lambda last: spark.createDataFrame([(1, [1.0]), (2, [last]), (3, [2.0])], "chunk_id long, embedding array<float>")
    assert cache.from_index(vectors(1.0), chunks, "s").count() == 2
    with pytest.raises(Exception, match="two vectors"):
        cache.from_index(vectors(3.0), chunks, "s").collect()
