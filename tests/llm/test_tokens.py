"""Tokenizing operators against the libraries themselves, on ordinary and on odd texts."""

import hashlib
import io
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import zstandard
from tokenizers import Tokenizer

from tessera.llm import best_fit_packing, byte_bpe, token_store, trie_bpe, whole_token_counts

PATH = byte_bpe.tokenizer_path()
ALPHABET = ["a", "b", " ", "  ", "\n", "\n\n", "\t", "'s", "'ll", "é", "é", "1", "²", "½", "_", "-", "…", "\x1c", "\x85", "\xa0", "　", "日本", "😀", "<|endoftext|>", "the", "▁", "​", "٣", "\r\n", "hello world", ".", ",", "$$$", "'", ".'", "ÿ", "ǅ", "×!", "(a)."]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def odd_texts(n=3000, seed=7):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 30))) for _ in range(n)] + ["", " ", "a ", " a", "\n", "a\n", "a" * 3000, "word " * 3000, "<|endoftext|>"]


def expected(library, texts):
    return [np.array(e.ids, dtype="<u4").tobytes() for e in library.encode_batch(texts, add_special_tokens=False)]


def test_word_encoder_equals_the_library(library):
    texts = odd_texts()
    encoder = byte_bpe.WordEncoder(PATH)
    encoder.pieces.entries = 500  # generations turn over
    assert encoder.encode(texts) == expected(library, texts) == encoder.encode(texts)


def test_trie_equals_the_library_and_decodes(library):
    texts = odd_texts()
    trie = trie_bpe.TrieBpe(PATH)
    coded = trie.encode(texts)
    assert coded == expected(library, texts)
    for data in coded[:800]:
        ids = np.frombuffer(data, dtype="<u4")
        assert trie.decode(ids) == library.decode(ids.tolist(), skip_special_tokens=False)
    assert trie.decode(np.array([trie.base[0xE3]], dtype="<u4")) == "�"


def test_prefixes_are_shared():
    trie = trie_bpe.TrieBpe(PATH)
    words = [b"abcdefgh", b"abcdefgi", b"abcd", b"zz", b" the", b" there"]
    got = trie.encode_words(words)
    assert got == {w: trie.merge(w) for w in words}


def test_pieces_equal_sentencepiece():
    import sentencepiece

    path = byte_bpe.tokenizer_path(whole_token_counts.MODEL)
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    counter = whole_token_counts.PieceCounter(path)
    texts = [*odd_texts(), "▁", "a▁", "▁▁b", "a  b", "<s> </s>", "x" * 5000]
    assert counter.count(texts) == [len(x) for x in model.encode(texts)]
    assert all(len(model.encode(w)) == 1 for w in counter.whole)


DOCS = "doc_id long, text string, n_tokens string, start string, kept string"
ROWS = [(3, "three words here", "x", "x", "x"), (1, None, "x", "x", "x"), (2, "", "x", "x", "x"), (3, "three words here", "x", "x", "x"), (None, "no id", "x", "x", "x"), (9, "long text " * 20_000, "x", "x", "x")]


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_counts_in_a_table(spark):
    got = whole_token_counts.count_tokens(spark.createDataFrame(ROWS, DOCS)).collect()
    assert Counter((r.doc_id, r.n_bytes) for r in got) == Counter((i, len((t or "").encode())) for i, t, *_ in ROWS)
    assert {r.doc_id: r.over_limit for r in got}[9] is True
    assert whole_token_counts.count_tokens(spark.createDataFrame([], DOCS)).count() == 0


def test_round_trip_in_a_table(spark, library):
    got = trie_bpe.round_trip(spark.createDataFrame(ROWS, DOCS)).collect()
    want = Counter((i, len(ids_of(library, t)), hashlib.sha256((t or "").encode()).hexdigest()) for i, t, *_ in ROWS)
    assert Counter((r.doc_id, r.n_tokens, r.decoded_sha256) for r in got) == want
    assert trie_bpe.round_trip(spark.createDataFrame([], DOCS)).count() == 0


def shard(docs, frame=token_store.FRAME_IDS):
    out = io.BytesIO()
    writer = token_store.ShardWriter(out)
    for i, ids in docs:
        writer.add(i, ids)
    writer.close()
    return out


def test_shard_round_trip_and_random_access():
    rng = np.random.default_rng(0)
    docs = [(i, rng.integers(0, 50_257, rng.integers(0, 900)).astype("<u4")) for i in range(60)] + [(None, np.array([1], dtype="<u4")), (99, np.arange(600_000, dtype="<u4") % 50_000)]
    out = shard(docs)
    reader = token_store.ShardReader(out)
    assert all(i == j and (a == b).all() for (i, a), (j, b) in zip(docs, reader.read(), strict=True))
    assert set(reader.documents([3, 99, 1234])) == {3, 99} and (reader.documents([3])[3] == docs[3][1]).all()
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(out.getvalue()), read_across_frames=True).read()
    assert plain == b"".join(a.astype("<u2").tobytes() for _, a in docs)  # any zstandard reader takes the file


def test_damage_is_noticed():
    whole = shard([(1, np.arange(5000, dtype="<u4") % 999)]).getvalue()
    for bad in (whole[:-1], whole[:20], b"", whole[:-9] + b"\0" * 9):
        with pytest.raises(token_store.ShardError):
            token_store.ShardReader(io.BytesIO(bad))
    hurt = bytearray(whole)
    hurt[40] ^= 0xFF
    with pytest.raises(token_store.ShardError):
        list(token_store.ShardReader(io.BytesIO(bytes(hurt))).read())


def test_stored_table(spark, library):
    got = sorted(((r.doc_id is not None, r.doc_id or 0, r.start, r.n_tokens, r.ids_crc32) for r in token_store.stored(spark.createDataFrame(ROWS, DOCS)).collect()))
    at, want = 0, []
    for i, t, *_ in sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*ids_of(library, t), 2], dtype="<u4")
        want.append((i is not None, i or 0, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert got == want
    assert token_store.stored(spark.createDataFrame([], DOCS)).count() == 0


def best_fit(lengths, capacity):
    """Document by document."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        open_ = [(r, k) for k, r in enumerate(rooms) if r >= n]
        if open_:
            rooms[min(open_)[1]] -= n
        else:
            rooms.append(capacity - n)
    return sorted(rooms)


def test_plan_equals_best_fit_decreasing():
    rng = random.Random(5)
    for _ in range(200):
        capacity = rng.randint(1, 40)
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 120))]
        segments = best_fit_packing.plan(dict(Counter(lengths)), capacity)
        used: dict[int, list] = {}
        at = -1
        for rank, n in enumerate(sorted(lengths, reverse=True)):
            while at + 1 < len(segments) and segments[at + 1].rank <= rank:
                at += 1
            s, k = segments[at], rank - segments[at].rank
            assert s.length == n
            used.setdefault(s.sequence + k // s.each, []).append((s.offset + k % s.each * n, n))
        for parts in used.values():
            parts.sort()
            assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
        assert sorted(capacity - sum(n for _, n in parts) for parts in used.values()) == best_fit(lengths, capacity)


def test_room_tree():
    tree = best_fit_packing.RoomTree(8)
    assert tree.tightest(1) is None
    tree.add(3, 2)
    tree.add(8, 1)
    assert [tree.tightest(n) for n in (1, 3, 4, 8)] == [3, 3, 8, 8]
    tree.add(3, -2)
    assert tree.tightest(1) == 8


def test_packed_table(spark, library):
    got = best_fit_packing.pack_documents(spark.createDataFrame(ROWS, DOCS), 16).collect()
    want = Counter()
    for i, t, *_ in ROWS:
        ids = np.array([*ids_of(library, t), 0], dtype="<u4")
        first = (len(ids) - 1) % 16 + 1
        cuts = [0, *range(first, len(ids) + 1, 16)]
        want.update((i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:])))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    sequences: dict = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        parts.sort()
        assert all(o == sum(n for _, n in parts[:i]) for i, (o, _) in enumerate(parts)) and sum(n for _, n in parts) <= 16
    assert sorted(16 - sum(n for _, n in p) for p in sequences.values()) == best_fit([n for (_, _, _, n, _), c in want.items() for _ in range(c)], 16)
    assert best_fit_packing.pack_documents(spark.createDataFrame([], DOCS)).count() == 0
