import io
import time
import zipfile

import pytest
from pyspark.sql import functions as F

from tessera.plans import parse, profiles
from tessera.sources import extract, readers, sinks
from tessera.streaming import watch


def test_front_matter():
    fields, body, at = parse.front_matter("---\ntitle: 'T'\n# no\ndepends_on: [a, b]\nrelated:\n  - c\n---\nBody")
    assert fields == {"title": ["T"], "depends_on": ["a", "b"], "related": ["c"]} and body == "Body" and at > 0
    assert parse.front_matter("---\nno end") == ({}, "---\nno end", 0)


def test_windows_cover_and_overlap():
    assert parse.windows("x" * 650) == [(0, 650)]
    assert parse.windows("x" * 651) == [(0, 650), (500, 651)]
    text = "\n".join(["y" * 40] * 29) + "\n\n" + "\n".join(["z" * 40] * 50)
    spans = parse.windows(text)
    assert spans[0][0] == 0 and spans[-1][1] == len(text)
    assert all(b > c and c > a for (a, b), (c, _) in zip(spans, spans[1:])) and all(b - a <= 650 for a, b in spans)


def test_sections_and_slivers():
    body = "lead\n# One\n" + "a" * 100 + "\n## Two\nb"
    chunks = parse.chunk_text(body)
    assert [c["heading"] for c in chunks] == ["", "One", "Two"]
    assert all(body[c["char_start"] : c["char_end"]] == c["content"] for c in chunks)


def test_python_chunks_and_relations():
    code = "import os\nfrom a.b import c\n\n\ndef f():\n    " + "x = 1\n    " * 10 + "return x\n"
    assert [c["heading"] for c in parse.chunk_python(code)] == ["f"]
    assert {(r["relation"], r["target"]) for r in parse.python_relations("me", code)} == {("imports", "os"), ("imports", "a-b"), ("uses", "c"), ("defines", "f")}
    assert parse.python_relations("me", "def (") == []


def test_markdown_relations():
    text = "---\ndepends_on: [Other Doc.md]\n---\nSee [[Page]] and [x](dir/file.md) and `name` and [y](http://z) and [[me]]"
    assert {(r["relation"], r["target"]) for r in parse.markdown_relations("me", text)} == {("depends_on", "other-doc"), ("references", "page"), ("references", "file"), ("mentions", "name")}


STATUTE = "제1장 총칙\n제1조(목적) 이 영은 「가나다법」에서 위임된 사항을 정한다.\n제2조(정의) 「라마법」에 따른 사항은 대통령령으로 정한다.\n"


def test_profiles():
    assert profiles.classify("x.txt", STATUTE) is profiles.STATUTE
    assert profiles.classify("x.txt", "의안번호 1\n제안이유\n" + STATUTE) is not profiles.STATUTE
    assert [h for _, h in profiles.headings(profiles.STATUTE, STATUTE)] == ["제1장 총칙", "제1조(목적)", "제2조(정의)"]
    assert [(e["relation"], e["target"]) for e in profiles.profile_edges(profiles.STATUTE, "d", STATUTE)] == [("delegates_to", "가나다법")]
    assert profiles.classify("x.txt", "## 제1조(목적)\n" + STATUTE) is None and profiles.classify("x.txt", "갑과 을은\n" + STATUTE) is None
    bill = "의 안\r\n번 호 7\r\n제 안 이 유\r\n「가나법률」 일부를 개정\r\n주요내용\r\n「다라법」에 따라\r\n제1장 총칙\r\n제1조(목적) 목적\r\n부 칙 (2024)\r\n제1조(시행일) 날\r\n신·구조문대비표\r\n비용추계서\r\n"
    assert profiles.classify("x.txt", bill) is profiles.BILL and profiles.classify("x.txt", "주 문\n" + bill) is None
    assert [h for _, h in profiles.headings(profiles.BILL, bill)] == ["제안이유", "주요내용", "본칙", "본칙 · 제1조(목적)", "부칙", "부칙 · 제1조(시행일)", "신구조문대비표", "비용추계서"]
    assert [(e["relation"], e["target"]) for e in profiles.profile_edges(profiles.BILL, "d", bill)] == [("amends", "가나법률"), ("references", "다라법")]
    parsed = parse.parse_document("a/x.txt", "x", STATUTE)
    assert parsed["doc_type"] == "statute" and parse.parse_document("a/x.txt", "x", "plain")["doc_type"] == "markdown"


def test_profile_gate():
    text = STATUTE + "제3조(기타) 그 밖의 사항을 정한다.\n제4조(끝) 마지막 사항을 정한다.\n"
    assert all(profiles.gate(profiles.STATUTE, "x.txt", text).values())
    assert not profiles.gate(profiles.BILL, "x.txt", text)["claimed"]
    assert profiles.triage([("a.txt", text), ("b.txt", "plain")]) == {"statute": 1, "": 1}


def test_parse_rows(spark):
    docs = spark.createDataFrame([("d", "c/d.md", "# T\n" + "word " * 300), ("n", None, None)], "doc_id string, rel_path string, content string")
    rows = parse.chunk_rows(parse.parsed(docs)).orderBy("chunk_id").collect()
    assert [r.chunk_id for r in rows] == ["d#0000", "d#0001", "d#0002"] and rows[0].title == "T"


def test_a_batch_is_parsed_by_pieces(spark):
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(spark.createDataFrame([], parse.PARSED).schema)
    batch = pa.RecordBatch.from_pydict({"doc_id": [f"d{k}" for k in range(500)], "rel_path": ["x/d.md"] * 500, "content": ["# h\n" + "word " * 20] * 499 + [None]})
    out = list(parse.parsed_batches([batch], arrow))
    assert max(b.num_rows for b in out) <= 128 and [d for b in out for d in b.column("doc_id").to_pylist()] == batch.column("doc_id").to_pylist()


def test_assemble():
    text = parse.assemble([("# A\n```\n# code\n```", 1), ("{{X}}", 0)], {"X": "y"})
    assert text == "## A\n```\n# code\n```\n\ny\n"
    with pytest.raises(ValueError, match="Z"):
        parse.assemble([("{{Z}}", 0)], {})


def package(parts):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, text in parts.items():
            z.writestr(name, text)
    return out.getvalue()


def p(text):
    return f"<p><r><t>{text}</t></r></p>"


def test_office_formats():
    doc = package({"word/document.xml": f"<d>{p('one')}<p><t>a</t><tab/><t>b</t><x>{p('inner')}</x></p></d>", "word/footnotes.xml": f"<d>{p('note')}</d>"})
    assert extract.extract("x.docx", doc) == ("one\na\tb\ninner\nnote", None)
    slides = package({f"ppt/slides/slide{n}.xml": f"<s>{p(f'slide {n}')}</s>" for n in (10, 2)})
    assert extract.extract("x.pptx", slides)[0].split("\n") == ["# 슬라이드 2", "slide 2", "# 슬라이드 10", "slide 10"]
    book = package({
        "xl/workbook.xml": '<w xmlns:r="urn:r"><sheets><sheet name="S2" r:id="r2"/><sheet name="S1" r:id="r1"/></sheets></w>',
        "xl/_rels/workbook.xml.rels": '<R><x Id="r1" Target="worksheets/a.xml"/><x Id="r2" Target="worksheets/b.xml"/></R>',
        "xl/sharedStrings.xml": "<s><si><t>hi</t></si></s>",
        "xl/worksheets/a.xml": '<w><row><c t="s"><v>0</v></c><c t="b"><v>1</v></c><c><v>3</v></c></row></w>',
        "xl/worksheets/b.xml": '<w><row><c t="inlineStr"><is><t>in</t></is></c></row></w>',
    })
    assert extract.extract("x.xlsx", book)[0] == "# 시트: S2\nin\n# 시트: S1\nhi\tTRUE\t3"
    assert extract.extract("x.hwpx", package({"Contents/section0.xml": f"<s>{p('h')}</s>"})) == ("h", None)


def test_extraction_errors(spark):
    cases = {"a.docx": b"junk", "b.docx": extract.OLE_MAGIC, "c.docx": package({"other.xml": "<a/>"}), "d.docx": package({"word/document.xml": f"<d>{p(' ')}</d>"}), "e.hwp": b"junk", "f.hwp": extract.OLE_MAGIC, "g.pdf": b"%PDF-1.7", "h.xyz": b"", "i.md": b"a\x00b", "j.md": b"ok\r\n", "k.md": b""}
    want = {"a.docx": "corrupt", "b.docx": "protected", "c.docx": "corrupt", "d.docx": "empty", "e.hwp": "corrupt", "f.hwp": "unavailable", "g.pdf": "unavailable", "h.xyz": "unavailable", "i.md": "corrupt", "j.md": None, "k.md": "empty"}
    rows = spark.createDataFrame([(k, bytearray(v)) for k, v in cases.items()], "rel_path string, content binary")
    assert {r.rel_path: r.error for r in extract.extracted(rows).collect()} == want
    texts = spark.createDataFrame([("ok",), (" ",), ("a\x01",)], "t string")
    assert [r[0] for r in texts.select(extract.problem_column(F.col("t"))).collect()] == [None, "empty", "corrupt"]


def test_readers(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a.md").write_text("x")
    (tmp_path / "b.bin").write_text("x")
    assert [r.rel_path for r in readers.raw_files(spark, str(tmp_path)).collect()] == ["sub/a.md"]
    (tmp_path / "t.tsv").write_text("# c\nname\tv\n\na\tb\n")
    assert [tuple(r) for r in readers.tsv(spark, str(tmp_path / "t.tsv"), ["name", "v"], header=True).collect()] == [("a", "b")]
    (tmp_path / "q.txt").write_text("# no\n\n one \ntwo\n")
    assert [r.query for r in readers.batch_queries(spark, str(tmp_path / "q.txt")).orderBy("at").collect()] == ["one", "two"]
    (tmp_path / "e.txt").write_text("# no\n")
    with pytest.raises(readers.EmptyBatch):
        readers.batch_queries(spark, str(tmp_path / "e.txt"))
    path = spark.createDataFrame([("/a/b",), ("/a",), ("/x",)], "p string")
    assert [r[0] for r in path.select(readers.allowed(F.col("p"), [(False, "/a"), (True, "/a/b")])).collect()] == [True, False, True]
    pages = spark.createDataFrame([(1, "openBillFile('u','B1','0') openBillFile('u','B1','0') openBillFile('u', 'B2', '1')")], "id int, html string")
    assert [(r.book_id, r.kind) for r in readers.attachments(pages).collect()] == [("B1", "0"), ("B2", "1")]


def test_snapshots(spark, tmp_path):
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    root = str(tmp_path / "index")
    first = sinks.write_snapshot(spark, {"t": df}, root, {"signature": "s"})
    folder, meta = sinks.open_snapshot(spark, root)
    assert folder.endswith(first) and meta["signature"] == "s"
    time.sleep(0.05)
    second = sinks.write_snapshot(spark, {"t": df.union(df)}, root, {"signature": "s2"})
    folder, meta = sinks.open_snapshot(spark, root)
    assert folder.endswith(second) and spark.read.parquet(f"{folder}/t").count() == 2
    found = sinks.file_manifest(spark, folder + "/t").cache()
    assert sinks.manifest_problems(found, found).count() == 0
    assert sinks.manifest_problems(found.limit(0), found).count() == found.count()
    old = spark.createDataFrame([("a", "1"), ("b", "2")], "key string, value string")
    new = spark.createDataFrame([("b", "3")], "key string, value string")
    assert {tuple(r) for r in sinks.upsert_meta(old, new).collect()} == {("a", "1"), ("b", "3")}


def test_promotion(spark):
    empty = spark.createDataFrame([], "rel_path string, sha256 string, revision int")
    batch = lambda rows: spark.createDataFrame(rows, "rel_path string, sha256 string, byte_size int, modified int")
    one = watch.promotion(empty, batch([("a.md", "1", 5, 1), ("b.exe", "2", 5, 1), ("c.md", "3", 0, 1)]))
    assert {r.rel_path: r.outcome for r in one.collect()} == {"a.md": "promoted", "b.exe": "skipped", "c.md": "rejected"}
    state = watch.next_state(empty, one)
    two = watch.promotion(state, batch([("a.md", "9", 5, 2), ("d.md", "4", 5, 1)]))
    assert {r.rel_path: (r.outcome, r.revision) for r in two.collect()} == {"a.md": ("revised", 1), "d.md": ("promoted", 0)}
    assert watch.promotion(watch.next_state(state, two), batch([("a.md", "9", 5, 3)])).first().outcome == "unchanged"
    seeds = watch.seed_set(spark.createDataFrame([("x/a.pdf",), ("x/a.hwp",), ("x/b.pdf",)], "rel_path string"), spark.createDataFrame([("x/b.pdf",)], "rel_path string"))
    assert [r.rel_path for r in seeds.collect()] == ["x/a.hwp"]


def test_promotion_query_equals_its_sql_on_empty_texts(spark, tmp_path):
    import duckdb

    from tessera.plans import catalog

    texts = {0: "", 1: "", 2: "", 4: None, 5: "x", 6: "", 7: "y", 10: "", 11: "", 13: None}
    spark.createDataFrame([(k, t, "src") for k, t in texts.items()], "doc_id long, text string, source string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, catalog.QUERIES["stream_promotion"](spark, str(tmp_path)).collect()))
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert got == sorted(db.sql(catalog.SQL["stream_promotion"]).fetchall())


def test_stream_equals_batch_and_survives_errors(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for k in range(3):
        (source / f"{k}.md").write_text(f"text {k}")
    time.sleep(1.2)
    seen, errors = [], []

    def rebuild(batch, number):
        seen.extend(sorted(bytes(r.content).decode() for r in batch.select("content").collect()))
        raise RuntimeError("boom")

    run = watch.rebuild_on_change(watch.file_stream(spark, str(source)), rebuild, str(tmp_path / "cp"), errors.append, once=True)
    run.awaitTermination(60)
    assert seen == ["text 0", "text 1", "text 2"] and len(errors) == 1


def test_partitions_make_no_difference(spark):
    docs = spark.createDataFrame([(f"d{i}", f"c/d{i}.md", f"# H{i}\n" + f"line {i} " * 120) for i in range(12)], "doc_id string, rel_path string, content string")
    one, many = (sorted(map(tuple, parse.chunk_rows(parse.parsed(docs.repartition(n))).collect())) for n in (1, 5))
    assert one == many
