"""Near copies by SimHash with pivot distance tables, decided on the exact Jaccard similarity of word shingles.

A text counts as the set of its shingles. Texts of one set are merged first. Each set gets SEEDS SimHash fingerprints of 64 bits:
the first votes over the XXH64 values as in ``simhash``, the others over values mixed from them. Every fingerprint deals its set
out under its bands of 16 bits. Inside a block the distances to the pivots, as in ``simhash``, discard pairs of that fingerprint
that differ in more than RADIUS bits (a fifth of 64), the bits themselves decide what is left, and the sets that such pairs connect
are proposed together. Two sets of similarity 0.8 are in no proposal with a chance of 2 to 8 in a million, more similar ones
with less. Votes of few shingles scatter more: sets of at most SMALL are dealt out under bands of 12 bits.

Fingerprints only propose. Sets that proposals connect form a family, which is compared as a whole: each set is read once, not once
for each of its up to 176 proposals. Of a family every pair that is not yet connected is held to its exact similarity, unless the
fingerprints of all seeds together differ in more than FAR bits; at a similarity of 0.8 they do with a chance of about one in a
billion. Families of more than TILE members (or SHINGLES shingles) are cut into tiles by size of set and compared tile by tile in
separate tasks, leaving out tiles too far apart. A family so wide that its tiles would repeat its sets more often than its proposals do
is compared proposal by proposal. Blocks of more than TILE members are cut likewise, by distance from the first pivot. Tasks return
a spanning forest of the links they verify.

Defined cases: words are as in ``simhash``; fewer words than a shingle count as one shingle; texts without words are one set;
null ids as in ``simhash``.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import simhash
from tessera.llm.byte_bpe import slices
from tessera.llm.common import drop_staged, map_rows, staged
from tessera.llm.components import components

WIDTH = 5
#: Least similarity, as a fraction of whole numbers.
SIMILARITY = (4, 5)
SEEDS = 44
#: Bits in which the fingerprints of a proposed pair differ at most.
RADIUS = 12
#: Up to this size sets have bands of 12 bits; from 4/5 of it on (no smaller set can be similar to a larger one) bands of 16.
SMALL = 32
TILE = 2048
#: Shingles of the sets of one tile.
SHINGLES = 4_000_000
#: Bits of all fingerprints in which similar sets differ at most: 0.161 of them are expected at 0.8 (0.1515 in large sets), and six deviations.
FAR = 575
#: Smaller sets are compared without that limit: their votes scatter more.
TINY = 12
#: Sizes of sets of one cell and the next; wider than the similarity allows.
CELL = 1.3
#: Rows of blocks compared at once.
ROWS = 50_000
_RNG = np.random.default_rng(80)
_XOR = _RNG.integers(0, 1 << 63, SEEDS - 1, dtype="u8")
_TIMES = _RNG.integers(0, 1 << 63, SEEDS - 1, dtype="u8") * np.uint64(2) + np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def prints(found: np.ndarray) -> np.ndarray:
    """The SimHash fingerprints of a set of shingle hashes; none of the empty set."""
    if not len(found):
        return np.zeros(0, dtype="u8")
    votes = np.zeros(64 * SEEDS, dtype="i8")
    for at in range(0, len(found), 255):  # as many votes as a byte counts
        part = found[at : at + 255, None]
        mixed = (part ^ _XOR) * _TIMES
        mixed ^= mixed >> np.uint64(32)
        mixed *= _MIX
        mixed ^= mixed >> np.uint64(29)
        votes += np.unpackbits(np.hstack([part, mixed]).view("u1"), axis=1, bitorder="little").sum(axis=0, dtype="u1")
    return np.packbits(2 * votes > len(found), bitorder="little").view("u8")


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, th (hash of the text), fp (a struct of two hashes of the text's set of shingles), size and prints of (doc_id, text)."""

    def rows(batches):
        for batch in batches:
            texts, ids, th = batch.column("text").to_pylist(), batch.column("doc_id").to_pylist(), batch.column("th")
            for a, b in slices(texts):
                out = []
                for text in texts[a:b]:
                    found = np.unique(simhash.shingle_hashes(text, WIDTH))
                    whole = hashlib.blake2b(found.tobytes(), digest_size=16).digest()
                    out.append((*np.frombuffer(whole, dtype="i8").tolist(), len(found), prints(found).view("i8")))
                yield {"doc_id": ids[a:b], "th": th.slice(a, b - a)} | dict(zip(("f0", "f1", "size", "prints"), zip(*out, strict=True), strict=True))

    marked = map_rows(docs.select("doc_id", "text", F.xxhash64("text").alias("th")), rows, "doc_id long, th long, f0 long, f1 long, size int, prints array<long>")
    return marked.select("doc_id", "th", F.struct("f0", "f1").alias("fp"), "size", "prints")


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets reach the similarity."""
    up, down = SIMILARITY
    if len(a) > len(b):
        a, b = b, a
    if down * len(a) < up * len(b):
        return False
    both = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
    return down * both >= up * (len(a) + len(b) - both)


def block_links(sets: list[np.ndarray], side: np.ndarray, prints_: np.ndarray) -> list[tuple[int, int]]:
    """Spanning links of one family's sets, whose fingerprints are the rows of prints_; of two tiles (sides 1, 2) only across."""
    up, down = SIMILARITY
    size = np.array([len(s) for s in sets])
    top, out = np.arange(len(sets)), []
    for j in range(1, len(sets)):
        fits = (down * np.minimum(size[:j], size[j]) >= up * np.maximum(size[:j], size[j])) & (top[:j] != top[j]) & ((side[:j] != side[j]) | (side[j] == 0))
        i = np.flatnonzero(fits)
        far = np.bitwise_count(prints_[i] ^ prints_[j]).sum(axis=1, dtype="i4")
        far[np.minimum(size[i], size[j]) < TINY] = 0
        for k in i[np.argsort(far, kind="stable")[: (far <= FAR).sum()]].tolist():
            if top[k] != top[j] and similar(sets[k], sets[j]):
                top[top == top[k]] = top[j]
                out.append((k, j))
    return out


def dealt_out(classes: DataFrame) -> DataFrame:
    """key (of a block), th, f (the fingerprint of the block's seed) of classes (th, size, prints)."""
    wide, narrow = [[F.lit(16 * k + n) * 65536 + F.shiftrightunsigned("f", bits * k).bitwiseAND(F.lit((1 << bits) - 1)) for k in range(64 // bits)] for n, bits in ((0, 16), (8, 12))]
    none = F.array().cast("array<long>")
    up, down = SIMILARITY[0] * SMALL, SIMILARITY[1]
    bands = F.concat(F.when(down * F.col("size") >= up, F.array(*wide)).otherwise(none), F.when(F.col("size") <= SMALL, F.array(*narrow)).otherwise(none))
    seeds = classes.select("th", "size", F.posexplode("prints").alias("seed", "f"))
    return seeds.select("seed", "th", "f", F.explode(bands).alias("band")).select((F.col("seed") * F.lit(1 << 24) + F.col("band")).alias("key"), "th", "f")


def proposals(classes: DataFrame, tile: int = TILE) -> DataFrame:
    """key, root (the least member), th: the sets that fingerprints within the radius connect inside one block."""
    dealt = dealt_out(classes)
    # at most one of tile rows is such a key, of which a row is 16 bytes
    crowded = staged(dealt.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > tile), "copies-crowded")
    small = dealt.join(F.broadcast(crowded), "key", "left_anti").select("key", "th", "f", F.lit(0).alias("side"))
    large = dealt.join(F.broadcast(crowded), "key").withColumn("d0", F.bit_count(F.col("f").bitwiseXOR(F.lit(int(simhash.PIVOTS[:1].view("i8")[0])))))
    large = simhash.tiled(large.withColumn("fp", F.col("th")), RADIUS, tile, "th", "f").select("key", "th", "f", "side")
    found = staged(_proposed(small).unionAll(_proposed(large)), "copies-proposals")
    drop_staged(crowded)
    return found


def _proposed(dealt: DataFrame) -> DataFrame:
    def rows(batches):
        held, n = [], 0
        for batch in batches:
            held.append(np.stack([batch.column(c).to_numpy().astype("i8") for c in ("key", "side", "th", "f")]))
            n += batch.num_rows
            if n >= ROWS:
                block = np.concatenate(held, axis=1)
                last = np.searchsorted(block[0], block[0, -1], "left")  # the last block may go on in the next batch
                yield from propose(block[:, :last])
                held, n = [block[:, last:]], 0
        if held:
            yield from propose(np.concatenate(held, axis=1))

    def propose(block: np.ndarray):
        key, side, th, f = block
        pairs = simhash.block_links(f.view("u8")[None, :], key, side, (RADIUS,)) if len(key) > 1 else ()
        if len(pairs):
            members = np.unique(pairs)
            at = {m: k for k, m in enumerate(members.tolist())}
            forest = simhash.Forest(len(members))
            for i, j in pairs.tolist():
                forest.join(at[i], at[j])
            top = np.array([forest.find(k) for k in range(len(members))])
            least = np.full(len(members), np.iinfo("i8").max)
            np.minimum.at(least, top, th[members])
            yield {"key": key[members], "root": least[top], "th": th[members]}

    found = map_rows(dealt.repartition("key").sortWithinPartitions("key"), rows, "key long, root long, th long")
    return found.select(F.xxhash64("key", "root").alias("key"), "root", "th")


def families(proposed: DataFrame) -> DataFrame:
    """node (a set), root (the least set that proposals connect it with) of all sets of proposals."""
    # a set's roots, at most one for each of its blocks, hang on their least: far fewer edges than rows of proposals
    roots = proposed.groupBy("th").agg(F.collect_set("root").alias("roots")).withColumn("least", F.array_min("roots"))
    edges = roots.select(F.explode(F.array_union(F.array("th"), F.col("roots"))).alias("a"), F.col("least").alias("b"))
    return components(edges.filter("a <> b").distinct())


def links(docs: DataFrame, classes: DataFrame, tile: int = TILE) -> DataFrame:
    """Links (a, b) between the fp of classes (fp, th, size, prints); connected as all links are. docs has the texts."""
    proposed = proposals(classes, tile)
    together = staged(families(proposed), "copies-families")
    sets = classes.select("fp", "th", "size", "prints", F.floor(F.log("size") / float(np.log(CELL))).cast("int").alias("d0"))
    members = staged(together.select(F.col("node").alias("th"), "root").join(sets.hint("merge"), "th"), "copies-members")
    texts = docs.withColumn("th", F.xxhash64("text")).join(members.select("th").hint("merge"), "th", "left_semi")
    texts = staged(texts.groupBy("th").agg(F.first("text").alias("text")), "copies-texts")
    rows_ = proposed.groupBy(F.col("root").alias("node")).agg(F.count("*").alias("rows")).join(together.hint("merge"), "node").groupBy(F.col("root").alias("key")).agg(F.sum("rows").alias("rows"))
    # a set is in as many pairs of tiles as its cell and a neighbour have tiles
    whole = (F.col("n") <= tile) | (2 * F.col("members") * F.ceil(F.col("n") / tile) <= F.col("rows"))
    by_family = members.withColumnRenamed("root", "key")
    counted = staged(weighed(by_family, tile).join(rows_.hint("merge"), "key").select("key", "n", whole.alias("whole")), "copies-counted")
    cut = by_family.join(counted.filter("whole").drop("whole").hint("merge"), "key")
    wide, done = counted.filter("not whole").select("key"), [proposed, together, members, texts, counted]
    if wide.limit(1).count():
        apart = proposed.join(together.withColumnRenamed("root", "key").join(wide.hint("merge"), "key", "left_semi").select(F.col("node").alias("root")).hint("merge"), "root", "left_semi")
        apart = staged(distinct_proposals(apart).join(members.drop("root").hint("merge"), "th"), "copies-apart")
        cut = cut.unionByName(apart.join(weighed(apart, tile).drop("members").hint("merge"), "key"))
        done.append(apart)
    small = cut.filter(F.col("n") <= tile).select("key", "fp", "th", "prints", F.lit(0).alias("side"))
    large = simhash.tiled(cut.filter(F.col("n") > tile), 1, tile, "th", "prints")
    found = staged(_compared(small.unionByName(large).join(texts.hint("merge"), "th")).distinct(), "copies-links")
    for table in done:
        drop_staged(table)
    return found


def weighed(sets: DataFrame, tile: int) -> DataFrame:
    """key, members, n (members, or more where their shingles fill more tiles) of the sets (key, size) compared together."""
    return sets.groupBy("key").agg(F.count("*").alias("members"), F.greatest(F.count("*"), F.ceil(F.sum("size") * tile / SHINGLES)).alias("n"))


def distinct_proposals(proposed: DataFrame) -> DataFrame:
    """key, th of proposals; those of the same members once."""
    blocks = proposed.groupBy("key").agg(F.count("*").alias("n"), F.bit_xor("th").alias("x0"), F.bit_xor(F.xxhash64("th")).alias("x1"))
    return proposed.select("key", "th").join(blocks.groupBy("n", "x0", "x1").agg(F.min("key").alias("key")).select("key").hint("merge"), "key")


def _compared(rows_: DataFrame) -> DataFrame:
    def rows(batches):
        key, held = None, []
        for batch in batches:
            voted = batch.column("prints").flatten().to_numpy().view("u8").reshape(-1, SEEDS)
            for k, *row, fps in zip(*(batch.column(c).to_pylist() for c in ("key", "side", "f0", "f1", "text")), voted, strict=True):
                if k != key and held:
                    yield from compare(held)
                    held = []
                key = k
                held.append((*row[:3], np.unique(simhash.shingle_hashes(row[3], WIDTH)), fps.copy()))
        if held:
            yield from compare(held)

    def compare(held):
        found = block_links([r[3] for r in held], np.array([r[0] for r in held]), np.stack([r[4] for r in held]))
        if found:
            yield {f"{name}{k}": [held[pair[at]][1 + k] for pair in found] for at, name in enumerate("ab") for k in range(2)}

    flat = rows_.select("key", "side", F.col("fp.f0").alias("f0"), F.col("fp.f1").alias("f1"), "prints", "text")
    found = map_rows(flat.repartition("key").sortWithinPartitions("key"), rows, "a0 long, a1 long, b0 long, b1 long")
    return found.select(*[F.struct(F.col(f"{s}0").alias("f0"), F.col(f"{s}1").alias("f1")).alias(s) for s in "ab"])


def near_copies(docs: DataFrame, tile: int = TILE) -> DataFrame:
    """doc_id, th, fp, component_id, first of (doc_id, text), as ``simhash.near_duplicates`` has them."""
    marked = staged(sketches(docs), "copies-sketches")
    classes = staged(marked.groupBy("fp").agg(F.min("th").alias("th"), F.first("size").alias("size"), F.first("prints").alias("prints")), "copies-classes")
    return simhash.grouped(marked.select("doc_id", "th", "fp"), lambda _: links(docs.select("text"), classes, tile))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of docs, with all their columns, that stand for their group: of each group one, with the smallest doc_id."""
    return simhash.standing(docs, near_copies)
