import pytest
from pyspark.sql import functions as F

from tessera import schemas
from tessera.operators import audits, layers, twins

DOCS = "doc_id string, rel_path string, title string, content string, content_sha256 string, content_fingerprint string, ingested_at int"
RELS = "relation_id string, doc_id string, rel_path string, source_entity string, source_kind string, relation string, target_entity string, target_kind string, evidence string, ingested_at int"


def test_served_documents(spark):
    long = "x" * 250
    rows = [("a", "c/a.pdf", "t", long, "1", "fp", 2), ("b", "c/b.hwp", " ", long, "2", "fp", 2), ("old", "c/o.md", "t", "gone", "3", "f3", 1), ("blank", "c/k.md", "t", "  ", "4", "f4", 2), ("r", "c/r.md", "t", "one", "6", "f6", 2), ("r", "c/r.md", "t", "two", "5", "f5", 2)]
    got = {r.doc_id: r for r in layers.silver_documents(spark.createDataFrame(rows, DOCS)).collect()}
    assert set(got) == {"b", "r"} and got["b"].title is None and got["r"].content == "two"


def test_texts_are_shuffled_only_for_those_who_read_them(spark):
    rows = [("a", "c/a.pdf", "t", "x" * 250, "1", "fp", 2)]
    node, seen = layers.silver_documents(spark.createDataFrame(rows, DOCS)).select("doc_id", "rel_path")._jdf.queryExecution().optimizedPlan(), []
    while not node.children().isEmpty():
        if node.nodeName() == "Window":
            seen.append(node.output().toString())
        node = node.children().apply(0)
    assert len(seen) == 2 and not any("content#" in x for x in seen)


def test_edges_are_chosen_once_for_all_that_reads_them(spark):
    import os

    from tessera.plans import queries_layers as QL

    here = "/root/testdata/sf0.001"
    if not os.path.isdir(here):
        pytest.skip("no test tables here")
    files = {f for f in QL.entities(spark, here).inputFiles()}
    assert files and all("silver-relations" in f or "served-names" in f for f in files) and files >= set(QL.relations(spark, here).inputFiles())


def test_edge_is_chosen_before_the_join(spark):
    rel = lambda i, doc: (i, doc, "p", "A ", "k", "uses", "b", " ", "e", 1)
    rows = spark.createDataFrame([rel("1", "gone"), rel("2", "here")], RELS)
    docs = spark.createDataFrame([("here",)], "doc_id string")
    assert layers.silver_relations(rows, docs).count() == 0
    kept = layers.silver_relations(rows, docs, rank_after_join=True).collect()
    assert [(r.source_entity, r.target_kind) for r in kept] == [("a", "unknown")]


def test_audits_fire_and_pass(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", " ", None)], "k string, t string, n int")
    assert audits.not_null(df, "n").count() == 1 and audits.not_null(df, "k").count() == 0
    assert audits.unique_values(df, "k").count() == 1 and audits.unique_values(df, "k", "t").count() == 0
    assert audits.text_not_blank(df, "t").count() == 1 and audits.text_not_blank(df, "k").count() == 0
    with pytest.raises(audits.AuditError, match="blank"):
        audits.run_audits({"blank": lambda: audits.text_not_blank(df, "t"), "fine": lambda: audits.not_null(df, "k")})
    one = spark.createDataFrame([("d", "bill", ""), ("e", "bill", "h"), ("f", "bill", ""), ("f", "bill", "x")], "doc_id string, doc_type string, heading string")
    assert [r.doc_id for r in audits.sections_survived(one, ("bill",)).collect()] == ["d"]


def sentence(k):
    return f"Sentence number {k} speaks of item {k * 7919 % 1000} and of place {k * 104729 % 977}. "


def test_twins_by_brute_force(spark):
    base = "".join(sentence(k) for k in range(60))
    swapped = "".join(sentence(k) for k in [*range(30, 60), *range(30)])
    rows = [("base", "x/base.hwp", base), ("swap", "x/swap.pdf", swapped), ("edit", "x/edit.hwp", base.replace("item", "itym", 1)), ("other", "x/other.pdf", "".join(sentence(k) for k in range(100, 160)))]
    docs = spark.createDataFrame(rows, "doc_id string, rel_path string, content string")
    bare = {n: c.replace(" ", "") for n, _, c in rows}
    cut = {n: {t[i : i + 10] for i in range(len(t) - 9)} for n, t in bare.items()}
    fmt = {n: p.rsplit(".", 1)[1] for n, p, _ in rows}
    expected = {}
    for a in cut:
        for b in cut:
            if a < b and fmt[a] != fmt[b]:
                j = len(cut[a] & cut[b]) / len(cut[a] | cut[b])
                if j >= 0.85:
                    loser, winner = (a, b) if fmt[a] == "pdf" else (b, a)
                    expected[loser] = max(expected.get(loser, ("", 0.0)), (winner, round(j, 9)), key=lambda x: x[1])
    got = {r.doc_id: (r.superseded_by, round(r.jaccard, 9)) for r in twins.superseded(docs).collect()}
    assert got == expected and "swap" in got


def test_copies_of_one_text_yield_to_the_least_id_of_a_better_format(spark):
    text, other = "".join(sentence(k) for k in range(60)), "".join(sentence(k) for k in range(100, 160))
    near = text.replace("item", "itym", 1)
    rows = [("a1", "x/a1.pdf", text), ("a2", "x/a2.pdf", text), ("a3", "x/a3.docx", text), ("a4", "x/a4.docx", text), ("b1", "x/b1.hwp", near)]
    rows += [("c1", "x/c1.aaa", other), ("c2", "x/c2.bbb", other), ("c3", "x/c3.aaa", other), ("e", "x/e.pdf", None), ("f", "x/f.hwp", "")]
    docs = spark.createDataFrame(rows, "doc_id string, rel_path string, content string")
    got = {r.doc_id: (r.superseded_by, r.jaccard == 1.0) for r in twins.superseded(docs).collect()}
    assert got == {"a1": ("a3", True), "a2": ("a3", True), "a3": ("b1", False), "a4": ("b1", False), "c2": ("c1", True), "c3": ("c2", True)}


def test_candidates_of_one_length_are_dealt_over_tasks(spark):
    rows = [(k, ("pdf", "hwp", "docx")[k % 3], 1000 + k % 400) for k in range(120)]
    found = twins.candidates(spark.createDataFrame(rows, "doc_id long, fmt string, len long"))
    want = {(a, b) for a, f, m in rows for b, g, n in rows if a < b and f != g and abs(m - n) / max(m, n) < 0.15}
    assert sorted(map(tuple, found.collect())) == sorted(want)
    assert "salt" in found._jdf.queryExecution().optimizedPlan().toString()


def test_divergence(spark):
    df = spark.createDataFrame([("ab  c", "ab c"), ("abc", "abd"), ("ab", "abc")], "text_a string, text_b string")
    assert [(r.same, r.first_difference) for r in twins.divergence(df).collect()] == [(True, None), (False, 3), (False, 3)]


def test_conform_casts_and_keeps_nested_as_json(spark):
    df = spark.createDataFrame([("1", {"b": 1})], "doc_id string, content map<string,int>")
    row = schemas.conform(df, "doc_id long, content string, missing double").first()
    assert (row.doc_id, row.content, row.missing) == (1, '{"b":1}', None)
    assert schemas.column_type({"type": ["null", "integer"]}) == "bigint" and schemas.column_type({"type": "string", "format": "date-time"}) == "timestamp"


def test_duplicate_groups(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int")
    assert [(r.n, r.members, r.redundant) for r in layers.duplicate_groups(df, F.col("k"), "v").collect()] == [(2, [1, 2], 1)]
