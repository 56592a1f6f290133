from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.functions import vectors as V


def values(spark, rows, column):
    return [r[0] for r in spark.createDataFrame([(x,) for x in rows], "x string").select(column).collect()]


def test_nfc_and_spaces(spark):
    x = F.col("x")
    assert values(spark, ["é", "abc", None], T.nfc(x)) == ["é", "abc", None]
    assert values(spark, ["a　 b ", "\r\n a"], T.collapse_space(x)) == ["a b", "a"]
    assert values(spark, ["a　 b\t"], T.strip_ascii_space(x)) == ["a　b"]
    assert values(spark, ["a\r\nb\rc"], T.unix_lines(x)) == ["a\nb\nc"]


def test_nfc_composes_whatever_python_composes(spark):
    import unicodedata

    odd = ["e\u0301", "\u1100\u1161\u11a8", "\uac00\u11a8", "\u212b", "\uf900", "\ufb2a", "\U0001d15e", "a\u0323\u0307", "a\u0307\u0323", "\u0958", "\u30ab\u3099", "\u2000", "\u1e0b\u0323", "\u0374"]
    rows = [f"x{c} 가 漢 \U0001f600{c}" for c in odd]
    assert values(spark, rows, T.nfc(F.col("x"))) == [unicodedata.normalize("NFC", x) for x in rows] != rows
    assert values(spark, rows, F.rlike(F.col("x"), F.lit(T.unsettled()))) == [True] * len(rows)
    assert values(spark, ["ñandú 가나 漢字かな \U0001f600 Ω", "plain"], F.rlike(F.col("x"), F.lit(T.unsettled()))) == [False, False]


def test_shingles_are_counted_one_text_at_a_time(spark):
    assert values(spark, ["abcdefghijk", "abc", "", None, "a" * 30, "가나다라마바사아자차카" * 2], T.shingle_count(F.col("x"))) == [2, 0, 0, 0, 1, 11]


def test_python_gets_bounded_batches(spark, tmp_path):
    import pyarrow as pa

    from tessera.functions import batches
    from tessera.plans import views

    batch = pa.RecordBatch.from_pydict({"t": ["a" * 10, None, "b" * 10, "c" * 50, "d"]})
    assert [p.num_rows for p in batches.pieces(batch, "t", 3, 20)] == [3, 1, 1]
    assert [p.num_rows for p in batches.pieces(batch, "t", 2, 1000)] == [2, 2, 1] and not list(batches.pieces(batch.slice(0, 0), "t"))
    spark.createDataFrame([(k, "x" * 100_000) for k in range(300)], "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/labels.parquet")
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    sizes = views.table(spark, str(tmp_path), "labels").mapInArrow(lambda bs: (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in bs), "n long").collect()
    assert len(sizes) > 2 and max(r.n for r in sizes) < 2 * batches.ARROW_BYTES


def test_ids(spark):
    x = F.col("x")
    assert values(spark, ["a/My File.md", "b/x y.HWP", "plain"], T.document_id(x)) == ["my-file", "x-y-hwp", "plain"]
    assert len(values(spark, ["a/---.md"], T.document_id(x))[0]) == 16
    assert values(spark, ["a/b/c.md", "c.md"], T.collection(x)) == ["a", "_root"]
    assert values(spark, ["'My File.md'"], T.entity_id(x)) == ["my-file"]


def test_tokens(spark):
    x = F.col("x")
    assert values(spark, ["ABC한글12 x_1"], T.tokens(x)) == [["abc", "한글", "12", "x_1"]]
    assert values(spark, ["가나다"], T.index_terms(x)) == [["가나", "나다"]]
    assert values(spark, ["abcdefghijk", "abc", ""], T.shingles(x)) == [["abcdefghij", "bcdefghijk"], [], []]
    assert [len(k) for k in values(spark, ["abcdefghijk", "aaaaaaaaaaaaaaa"], T.shingle_keys(x))] == [2, 1]


def test_strip_tags(spark):
    html = "<html><script>var a='<p>';</script><p> one </p><!-- two --><b>three</b></html>"
    assert values(spark, [html], T.strip_tags(F.col("x"))) == ["one\nthree"]
    assert values(spark, ['<a href="/x">'], T.links(F.col("x"))) == [["/x"]]


def test_hashed_vector_is_unit_or_zero():
    v = T.hashed_vector("some words, some more words", 512)
    assert abs(sum(x * x for x in v) - 1) < 1e-9
    assert not any(T.hashed_vector("", 512))


def test_vector_functions(spark):
    df = spark.createDataFrame([([3.0, 4.0], [6.0, 8.0])], "a array<float>, b array<float>")
    row = df.select(V.norm(F.col("a")), V.cosine(F.col("a"), F.col("b")), V.l2(F.col("a"), F.col("b")), V.unpack(V.pack(F.col("a")))).first()
    assert [round(x, 9) for x in row[:3]] == [5.0, 1.0, 5.0] and row[3] == [3.0, 4.0]


def test_embed_text(spark):
    row = spark.createDataFrame([("t", " ", "c")], "t string, h string, c string").select(T.embed_text(F.col("t"), F.col("h"), F.col("c"))).first()
    assert row[0] == "# t\n\nc"
