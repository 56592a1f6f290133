"""Duplicate operators against brute force on small fixtures."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from pyspark.sql import functions as F

from tessera.llm import embedding_dedup, near_copies, simhash, suffix_dedup
from tessera.llm.components import components


def groups(ids, linked):
    up = {i: i for i in ids}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_components(spark):
    rng = random.Random(2)
    edges = [(k, k + 1) for k in range(40)] + [(rng.randint(100, 160), rng.randint(100, 160)) for _ in range(50)] + [(200, k) for k in range(201, 260)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: v for k, v in groups({x for e in edges for x in e}, edges).items() if k in got} and len(got) >= 100
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def fingerprint(text, width=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", low) if w]
    if not words:
        return 0
    cut = [" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in cut]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprint_by_hand():
    for text in ["", " \n", "One", "one Two", "A b c", "ÄB Äb É x\x0by\x1cz", "w " * 2000, " ".join(f"w{i % 97}" for i in range(500))]:
        assert simhash.fingerprint(text) == fingerprint(text)


def near_texts(n=120, seed=3):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        words = [f"w{rng.randint(0, 3000)}" for _ in range(rng.choice([3, 60, 200]))]
        out.append(" ".join(words))
        for _ in range(rng.randint(0, 2)):
            again = list(words)
            again[rng.randrange(len(again))] = f"x{rng.randint(0, 9)}"
            out.append(" ".join(again))
    return out


@pytest.mark.parametrize("tile", [2048, 3])
def test_simhash_groups(spark, tile):
    texts = [*near_texts(), "", " ", None, "same", "Same"]
    rows = list(enumerate(texts)) + [(5, texts[5])]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "coalesce(text, '') as text", "1 as fp", "2 as component_id")
    got = {r.doc_id: (r.fp.f0 & (1 << 64) - 1, r.component_id) for r in simhash.near_duplicates(df, tile=tile).collect()}
    fps = {i: fingerprint(t) for i, t in rows}
    linked = [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 3]
    want = groups(fps, linked)
    assert got == {i: (fps[i], want[i]) for i in fps}
    assert len(set(want.values())) < len(fps) - 5


def test_crowded_blocks_lose_no_link():
    rng = np.random.default_rng(1)
    centre = rng.integers(0, 1 << 63, 1, dtype="u8")
    fps = np.unique(centre ^ (np.uint64(1) << rng.integers(0, 40, 400, dtype="u8")) ^ (np.uint64(1) << rng.integers(0, 40, 400, dtype="u8")))
    pairs = simhash.block_links(fps[None, :], np.zeros(len(fps), "i8"), np.zeros(len(fps), "i8"), (3,))
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3
    linked = [(int(a), int(b)) for a, b in zip(*np.nonzero(np.triu(near, 1)), strict=True)]
    assert len(pairs) < len(fps)
    assert groups(range(len(fps)), pairs.tolist()) == groups(range(len(fps)), linked)


@pytest.mark.parametrize("n", [10, 10**6, 10**8, 10**12])
def test_bands_meet_at_any_size(n):
    masks = simhash.band_masks(n)
    rng = random.Random(n)
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for k in rng.sample(range(64), 3):
            b ^= 1 << k
        assert any(a & m == b & m for m in masks)


def test_keep_one_of_each_group(spark):
    text = " ".join(f"w{i}" for i in range(300))
    rows = [(4, text, "k"), (2, text, "k"), (2, text, "k"), (None, text, "k"), (7, "other words entirely", None), (None, "alone here", "x"), (8, None, "x")]
    got = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string, th string"), (1, 5), (3, 14))
    assert got.columns == ["doc_id", "text", "th"]
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter([(2, text), (7, "other words entirely"), (None, "alone here"), (8, None)])
    assert simhash.keep_one(spark.createDataFrame([], "doc_id long, text string"), (1, 5), (3, 14)).count() == 0


def shingle_set(text, width=5):
    words = (text or "").lower().split()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def block_edits(n=60, seed=5):
    """Texts and copies with a block of words replaced, put in or taken out, most near the similarity of 0.8."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        words = [f"w{rng.randint(0, 3000)}" for _ in range(rng.choice([3, 30, 80, 300]))]
        out.append(" ".join(words))
        for _ in range(rng.randint(0, 3)):
            at, size = rng.randrange(len(words)), rng.randint(1, max(1, len(words) // 7))
            out.append(" ".join(words[:at] + [f"x{rng.randint(0, 99)}" for _ in range(rng.choice([0, size]))] + words[at + rng.choice([0, size]) :]))
    return out


@pytest.mark.parametrize("tile", [512, 3])
def test_near_copies_lose_no_pair(spark, tile):
    same = [" ".join(["shared"] * k + [f"w{i}" for i in range(70)]) for k in range(1, 12)]
    rows = list(enumerate([*block_edits(), *same, "", " ", None, "Two words", "two  WORDS"])) + [(5, "other text"), (None, block_edits()[0])]
    sets = [shingle_set(t) for _, t in rows]
    linked = [(a, b) for b in range(len(rows)) for a in range(b) if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    top = groups(range(len(rows)), linked)
    members: dict = {}
    for k, (i, _) in enumerate(rows):
        members.setdefault(top[k], []).append(i)
    want = Counter((i, min(x for x in members[top[k]] if x is not None)) for k, (i, _) in enumerate(rows))
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "coalesce(text, '') as text")
    assert Counter((r.doc_id, r.component_id) for r in near_copies.near_copies(df, tile).collect()) == want
    assert 20 < len(members) < len(rows) - 20


def test_fingerprints_of_a_set_of_shingles():
    for text in ["One", "One two three four five six", "a b c d e f " * 3, " ".join(f"w{i}" for i in range(900))]:
        found = np.unique(simhash.shingle_hashes(text, 5))
        got = near_copies.prints(found)
        assert len(got) == near_copies.SEEDS and got[0] == simhash.voted(found)
        for k in (0, near_copies.SEEDS - 2):
            mixed = [(int(h) ^ int(near_copies._XOR[k])) * int(near_copies._TIMES[k]) % 2**64 for h in found]
            mixed = [(h ^ h >> 32) * int(near_copies._MIX) % 2**64 for h in mixed]
            assert got[k + 1] == simhash.voted(np.array([h ^ h >> 29 for h in mixed], dtype="u8"))
    assert not len(near_copies.prints(np.zeros(0, "u8")))


@pytest.mark.parametrize("tile", [512, 3])
def test_fingerprints_propose(spark, tile):
    """Proposed together: what shares a band of some fingerprint and is connected by pairs within its radius."""
    same = [" ".join(["shared"] * k + [f"w{i}" for i in range(70)]) for k in range(1, 9)]
    sets = {k: np.unique(simhash.shingle_hashes(t, 5)) for k, t in enumerate(dict.fromkeys([*block_edits(20), *same, ""]))}
    fps = {k: near_copies.prints(s).tolist() for k, s in sets.items()}
    blocks: dict = {}
    for k, s in sets.items():
        for bits in [16] * (5 * len(s) >= 4 * near_copies.SMALL) + [12] * (len(s) <= near_copies.SMALL):
            for seed, f in enumerate(fps[k]):
                for band in range(64 // bits):
                    blocks.setdefault((bits, seed, band, f >> bits * band & (1 << bits) - 1), []).append(k)
    want, linked = set(), set()
    for (_, seed, *_), ids in blocks.items():
        near = [(a, b) for b in ids for a in ids if a < b and (fps[a][seed] ^ fps[b][seed]).bit_count() <= near_copies.RADIUS]
        top = groups(ids, near)
        linked.update(near)
        want.update(tuple(k for k in ids if top[k] == root) for root in set(top.values()))
    rows = [(k, len(s), np.array(fps[k], "u8").view("i8").tolist()) for k, s in sets.items()]
    got: dict = {}
    for r in near_copies.proposals(spark.createDataFrame(rows, "th long, size int, prints array<long>"), tile).collect():
        got.setdefault(r.key, []).append(r.th)
    assert linked and len(linked) < len(rows) ** 2 / 10
    if tile == 512:
        assert {tuple(sorted(g)) for g in got.values()} == {w for w in want if len(w) > 1}
    top = groups(sets, [(g[0], x) for g in got.values() for x in g])
    assert all(top[a] == top[b] for a, b in linked)


def test_near_copies_read_a_set_once(spark, monkeypatch):
    """A family is compared as a whole, its sets not once more for each proposal."""
    family = [" ".join(f"x{k}y{j}" if j // 4 == k else f"w{j}" for j in range(200)) for k in range(40)]
    far = [" ".join(f"v{k}z{j}" if j % 9 == k % 9 else f"w{j}" for j in range(200)) for k in range(3)]
    plain, seen = near_copies._compared, []
    monkeypatch.setattr(near_copies, "_compared", lambda rows: seen.append(rows.count()) or plain(rows))
    df = spark.createDataFrame(list(enumerate([*family, *far])), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_copies.near_copies(df).collect()}
    assert got == {k: 0 if k < 40 else k for k in range(43)}
    assert len(seen) == 1 and 40 <= seen[0] <= 43


def test_near_copies_of_a_wide_family(spark, monkeypatch):
    """A family whose tiles would repeat its sets more often than its proposals do is compared by proposals."""
    chain = [" ".join(f"x{j}" if j < 16 * k else f"w{j}" for j in range(200)) for k in range(5)]
    assert not near_copies.similar(*(np.unique(simhash.shingle_hashes(chain[k], 5)) for k in (0, 2)))
    plain, seen = near_copies.distinct_proposals, []
    monkeypatch.setattr(near_copies, "distinct_proposals", lambda rows: seen.append(rows.count()) or plain(rows))
    monkeypatch.setattr(near_copies, "SHINGLES", 50)
    df = spark.createDataFrame(list(enumerate([*chain, "w0 w1 w2", "other words"])), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_copies.near_copies(df).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 0, 4: 0, 5: 5, 6: 6}
    assert len(seen) == 1 and seen[0] > 5


def test_near_duplicate_stage_finds_block_edits(spark):
    import corpus_pipeline

    rng = random.Random(8)
    words = [f"w{rng.randint(0, 3000)}" for _ in range(300)]
    rows = [(k, " ".join(words[: 10 * k] + [f"x{k}y{j}" for j in range(20)] + words[10 * k + 20 :])) for k in range(1, 20)] + [(30, " ".join(words)), (31, " ".join(words[:200]))]
    kept = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()
    assert sorted(r.doc_id for r in kept) == [1, 31]


def brute_repeats(rows, length):
    seen = Counter()
    texts = [(i, (t or "").encode()) for i, t in rows]
    for _, b in texts:
        seen.update(b[q : q + length] for q in range(len(b) - length + 1))
    out = []
    for i, b in texts:
        cover = np.zeros(len(b) + 1, dtype=int)
        for q in range(len(b) - length + 1):
            if seen[b[q : q + length]] > 1:
                cover[q : q + length] = 1
        cover = cover[: len(b)]
        kept = bytes(x for x, c in zip(b, cover, strict=True) if not c)
        out.append((i, len(b), int(cover.sum()), int((np.diff(np.r_[0, cover]) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def passages(seed=3):
    rng = random.Random(seed)
    voc = ["ab", "c", "é", "xyz ", "foo", "\n", "aaaa", "日"]
    base = ["".join(rng.choice(voc) for _ in range(rng.randint(0, 300))) for _ in range(40)]
    out = list(base)
    for _ in range(90):
        x, y = rng.choice(base), rng.choice(base)
        i, j = rng.randint(0, len(x)), rng.randint(0, len(y))
        out.append(x[i : i + rng.randint(0, 200)] + y[j : j + rng.randint(0, 300)] + rng.choice(base)[:50])
    common = "".join(rng.choice(voc) for _ in range(60))
    out += ["".join(rng.choice(voc) for _ in range(rng.randint(0, 40))) + common + "".join(rng.choice(voc) for _ in range(rng.randint(0, 40))) for _ in range(40)]
    return [*out, "a" * 500, "ab" * 300, "", None, "x"]


@pytest.mark.parametrize(("length", "gram", "group"), [(40, 10, 2000), (40, 10, 3), (60, 25, 5), (12, 12, 1)])
def test_repeated_bytes(spark, length, gram, group):
    rows = list(enumerate(passages())) + [(0, passages()[0]), (None, "no id " * 30)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "coalesce(text, '') as text", "'x' as th", "'y' as spans")
    assert Counter(map(tuple, suffix_dedup.report(df, length, gram, group).drop("text").collect())) == brute_repeats(rows, length)


def test_contexts_are_dealt_after_a_join(spark):
    """The repartition stays above a join on hash: adaptive execution may read that join's own shuffles locally."""
    left = spark.range(10).selectExpr("id hash", "0 d", "id ch", "2L n", "cast('x' as binary) ctx")
    joined = left.join(spark.range(10).selectExpr("id hash").hint("merge"), "hash")
    plan = suffix_dedup.repeated_ranges(joined, 40, 10)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_COL" in plan


def test_blocks_do_not_matter(monkeypatch):
    rng = np.random.default_rng(4)
    data = rng.integers(0, 3, 5000).astype("u1")
    ends = np.array([1200, 1210, 5000])

    def windows():
        out = {}
        for t, q, g, d, h in suffix_dedup.anchors(data, ends, 50, 20):
            for x in zip(t.tolist(), q.tolist(), g.tolist(), d.tolist(), h.tolist(), strict=True):
                for k in range(x[2]):
                    out[x[0], x[1] + k] = (x[3] - k, x[4])
        return out

    whole = windows()
    monkeypatch.setattr(suffix_dedup, "BLOCK", 333)
    assert windows() == whole and len(whole) == (1200 - 49) + (3790 - 49)


def test_cleaned_texts(spark):
    shared = "ein geteilter Absatz über viele Wörter und Sätze é " * 8
    rows = [(1, "Anfang eins " + shared + " Ende eins", 5), (2, "zwei: " + shared + "!", 5), (3, None, 5), (4, "kurz", 5)]
    got = {r.doc_id: r.text for r in suffix_dedup.cleaned(spark.createDataFrame(rows, "doc_id long, text string, n_chars int"), 100, 30).collect()}
    assert got[3] is None and got[4] == "kurz" and "Absatz" not in got[1] + got[2] and got[1].startswith("Anfang") and got[1].endswith("Ende eins")
    assert suffix_dedup.cleaned(spark.createDataFrame([], "doc_id long, text string"), 100, 30).count() == 0


def test_passages_of_short_words(spark):
    import corpus_pipeline

    passage = " ".join(f"{chr(97 + i % 26)}{i}" for i in range(51))
    assert len(passage) < 200
    long, rng = "ein Absatz mit vielen langen Wörtern " * 8, random.Random(4)
    other = [" ".join(f"word{rng.randint(0, 10**6)}" for _ in range(40)) for _ in range(4)]
    fewer = " ".join(f"z{i}" for i in range(50))
    rows = [(1, f"{other[0]} {passage} end one"), (2, f"two: {passage} {other[1]}"), (3, f"{other[2]} {fewer} three"), (4, f"four {fewer} {other[3]}"), (5, f"five {long}!"), (6, f"{long}six {passage}"), (7, None), (8, "short")]
    got = {r.doc_id: r.text for r in corpus_pipeline.passages(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()}
    assert got[1] == f"{other[0]}  end one" and got[2] == f"two:  {other[1]}" and passage not in got[6] and "Absatz" not in got[5] + got[6]
    assert got[3] == rows[2][1] and got[4] == rows[3][1] and got[7] is None and got[8] == "short"


def test_embedding_groups(spark):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(40, 16))
    rows = [(k, [float(x) for x in c + rng.normal(size=16) * rng.choice([0.02, 0.1, 0.4])]) for k, c in enumerate(centres[rng.integers(0, 40, 400)])]
    rows += [(1000 + k, v) for k, v in enumerate([None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [1.0] * 3, [2.0] * 3, rows[0][1], [x * 7 for x in rows[0][1]]])]
    rows += [(1009, [None] + [1.0] * 15), (None, [1.0] * 16), (0, rows[0][1])]
    good = [(k, i, np.array(v)) for k, (i, v) in enumerate(rows) if v and None not in v and np.isfinite(v).all() and any(v)]
    links = Counter()
    linked = []
    for n, (k, i, v) in enumerate(good):
        for m, j, w in good[n + 1 :]:
            if len(v) == len(w) and v @ w / math.sqrt((v @ v) * (w @ w)) >= 0.95:
                links[k] += 1
                links[m] += 1
                linked.append((k, m))
    top = groups(range(len(rows)), linked)
    members: dict = {}
    for k, (i, _) in enumerate(rows):
        members.setdefault(top[k], []).append(i)
    want = Counter((i, links[k], min((x for x in members[top[k]] if x is not None), default=None)) for k, (i, _) in enumerate(rows))
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, v int")
    got = embedding_dedup.near_duplicates(df, tile=64)
    assert Counter((r.vec_id, r.n_links, r.component_id) for r in got.collect()) == want
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0
    assert embedding_dedup.near_duplicates(df.filter("embedding is null")).collect()[0].n_links == 0


def brute_vectors(x, threshold=0.95):
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    near = unit @ unit.T >= threshold
    np.fill_diagonal(near, False)
    label = np.arange(len(x))
    while True:
        least = np.array([min(label[i], label[row].min(initial=len(x))) for i, row in enumerate(near)])
        if (least == label).all():
            return near.sum(axis=1), label
        label = least


@pytest.mark.parametrize("width", [8, 30, 64, 200])
def test_tiles_of_near_unequal_vectors(width):
    """Two clouds of mutually near vectors, and scattered ones: counts and groups of every pair of tiles equal brute force."""
    rng = np.random.default_rng(width)
    centre = rng.normal(size=(2, width))
    x = np.concatenate([centre[rng.integers(0, 2, 700)] + rng.normal(size=(700, width)) * 0.2, rng.normal(size=(600, width))])
    x /= np.linalg.norm(x, axis=1)[:, None]
    order = embedding_dedup.Order(x)
    x = x[np.argsort(order.leaves(order.leading(x)), kind="stable")]
    links, groups = brute_vectors(x)
    halves = [np.arange(0, 650), np.arange(650, 1300)]
    n, dim = np.ones(len(x), dtype="i8"), np.full(len(x), width)
    tiles = [embedding_dedup.Tile(order, rows, x[rows]) for rows in halves]
    total, joined = np.zeros(len(x), dtype="i8"), []
    for one, two in ((tiles[0], tiles[0]), (tiles[0], tiles[1]), (tiles[1], tiles[1])):
        found, label = embedding_dedup.tile_links(one, two, n, dim, 0.95)
        total += found
        joined += [(i, label[i]) for i in np.flatnonzero(found)]
    assert (total == links).all() and links.sum() > 10_000
    assert (embedding_dedup.roots(len(x), *np.array(joined).T) == groups).all()


def test_dense_tile_needs_little_memory():
    """5 000 unequal vectors that all link: their 12 million pairs are never held together."""
    import tracemalloc

    rng = np.random.default_rng(1)
    x = rng.normal(size=64) + rng.normal(size=(5000, 64)) * 0.05
    x /= np.linalg.norm(x, axis=1)[:, None]
    tile = embedding_dedup.Tile(embedding_dedup.Order(x), np.arange(5000), x)
    tracemalloc.start()
    links, label = embedding_dedup.tile_links(tile, tile, np.ones(5000, dtype="i8"), np.full(5000, 64), 0.95)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (links == 4999).all() and (label == 0).all() and peak < 300e6


def test_embedding_table_with_many_links(spark):
    """A table with chains, clouds, copies and short vectors, through the whole query."""
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(40, 16))
    x = np.concatenate([centre[rng.integers(0, 40, 900)] + rng.normal(size=(900, 16)) * rng.choice([0.1, 0.25, 0.5], size=(900, 1)), rng.normal(size=(300, 16))])
    x[50:90] = x[50]
    df = spark.createDataFrame([(7 * i, v.tolist(), "mine", 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, k1 string, place int")
    links, label = brute_vectors(x)
    want = {(7 * i, int(links[i]), 7 * int(label[i]), i == label[i]) for i in range(len(x))}
    assert links.max() > 30
    for tile in (None, 100):
        assert {tuple(r) for r in embedding_dedup.near_duplicates(df, tile=tile).collect()} == want


def test_rows_with_clashing_columns(spark):
    text = " ".join(f"w{i}" for i in range(80))
    schema = "doc_id long, text string, __id string, th double, row int, __spans string, __did string, id string, spans int"
    rows = [(1, text, "a", 0.5, 1, "s", "d", "i", 9), (2, text, "b", 0.6, 2, "s", "d", "i", 9), (3, None, None, None, None, None, None, None, None), (1, text, "c", 0.7, 3, "s", "d", "i", 9)]
    df = spark.createDataFrame(rows, schema)
    kept = {tuple(r) for r in simhash.keep_one(df, (3,), (3,)).collect()}
    assert len(kept) == 2 and rows[2] in kept and len(kept & {rows[0], rows[3]}) == 1
    assert kept == {tuple(r) for r in simhash.keep_one(df.orderBy(F.desc("th")), (3,), (3,)).collect()}  # whichever comes first
    assert {r[2:] for r in map(tuple, near_copies.keep_one(df).collect())} == {r[2:] for r in kept}
    cut = {tuple(r) for r in suffix_dedup.cleaned(df, 100, 30).collect()}
    assert cut == {(r[0], None if r[1] is None else "", *r[2:]) for r in rows}


def test_report_returns_what_is_left(spark):
    import hashlib

    passage = "é" * 30 + "".join(chr(97 + i % 26) for i in range(200))
    df = spark.createDataFrame([(1, "one " + passage + " two"), (2, passage + "é three"), (3, None), (4, "x" * 30)], "doc_id long, text string")
    got = {r.doc_id: r for r in suffix_dedup.report(df.selectExpr("doc_id", "coalesce(text, '') text"), 100, 30).collect()}
    assert got[1].text == "one  two" and got[2].text == "é three" and got[3].text == "" and got[4].text == "x" * 30
    assert got[1].kept_sha256 == hashlib.sha256(b"one  two").hexdigest() and got[4].n_removed == 0
    assert suffix_dedup.report(df.limit(0), 100, 30).count() == 0


def test_components_ignore_loops_and_nulls(spark):
    df = spark.createDataFrame([(1, 1), (2, None), (None, 3), (4, 5), (5, 4), (4, 5), (6, 5)], "a long, b long")
    assert {(r.node, r.root) for r in components(df).collect()} == {(4, 4), (5, 4), (6, 4)}
    assert components(df.limit(0)).count() == 0
