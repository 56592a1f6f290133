"""SimHash near-duplicates with pivot distance tables.

``fingerprints`` votes on 64 bits over the XXH64 values of a text's word shingles. ``links`` finds all pairs of different
fingerprints within the radius. Two such fingerprints agree on some combination of whole bands (with k bands, of which k - 3
are keyed, any three differing bits leave one combination untouched), so each fingerprint is dealt out under all combinations
and compared only inside blocks of the same key. The number of bands follows the number of fingerprints, so that random ones
share a block with few others. Inside a block a table of Hamming distances to many fixed reference fingerprints (the pivots)
comes first: by the triangle inequality a pair whose distances to some pivot differ by more than the radius is discarded;
survivors are verified by counting differing bits. Blocks of more than TILE fingerprints are cut into tiles in order of the
first pivot's distance and compared tile by tile in separate tasks, leaving out tiles too far apart in that distance. Tasks
return, of the links they verify, a spanning forest: enough for components, and never all pairs of a group.

Several fingerprints of shingles of different width can be asked for; then a link needs each of them within its own radius,
the first one deals out the blocks and the others are further conditions on survivors.

Defined cases: a text without words (null, empty, blank) has fingerprint zero and links like any other; fewer words than a
shingle count as one shingle; repeated rows share a fingerprint and so a group; a null id is kept but never represents a
group unless all its ids are null (then the group's id is null).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import combinations, repeat

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.byte_bpe import slices
from tessera.llm.common import drop_staged, map_rows, staged
from tessera.llm.components import components

RADIUS = 3
TILE = 2048
#: Reference fingerprints: fixed, spread at random, from a seed.
PIVOTS = np.random.default_rng(64).integers(0, 1 << 63, 24, dtype="u8") * np.uint64(2) + np.random.default_rng(65).integers(0, 2, 24, dtype="u8")
_BITS = np.unpackbits(np.arange(256, dtype="u1")[:, None], axis=1, bitorder="little").astype("i8")


def shingle_hashes(text: str, width: int = 3, seed: int = 42) -> np.ndarray:
    """XXH64 of each word shingle of a text, repeated ones included."""
    words = text.encode().lower().split()  # of bytes: only A-Z change, only ASCII white space separates
    if not words:
        return np.zeros(0, dtype="<u8")
    shingles = zip(*(words[k:] for k in range(width)), strict=False) if len(words) >= width else [tuple(words)]
    return np.fromiter(map(xxhash.xxh64_intdigest, map(b" ".join, shingles), repeat(seed)), dtype="<u8", count=max(1, len(words) - width + 1))


def voted(hashes: np.ndarray) -> int:
    """The fingerprint of these hashes: the bits that more than half of them have."""
    n = len(hashes)
    if not n:
        return 0
    columns = hashes.view("u1").reshape(n, 8)
    votes = np.concatenate([np.bincount(columns[:, k], minlength=256) @ _BITS for k in range(8)])
    return int.from_bytes(np.packbits(2 * votes > n, bitorder="little").tobytes(), "little")


def fingerprint(text: str, width: int = 3, seed: int = 42) -> int:
    return voted(shingle_hashes(text, width, seed))


def fingerprints(docs: DataFrame, widths: Sequence[int] = (3,), seed: int = 42) -> DataFrame:
    """doc_id, th (hash of the text) and fp, a struct of the fingerprints f0, f1, ... (as signed longs) of (doc_id, text)."""
    names = [f"f{k}" for k in range(len(widths))]

    def rows(batches):
        for batch in batches:
            texts, ids, th = [t or "" for t in batch.column("text").to_pylist()], batch.column("doc_id").to_pylist(), batch.column("th")
            for a, b in slices(texts):
                yield {"doc_id": ids[a:b], "th": th.slice(a, b - a)} | {f: np.array([fingerprint(t, w, seed) for t in texts[a:b]], dtype="u8").view("i8") for f, w in zip(names, widths, strict=True)}

    marked = map_rows(docs.select("doc_id", "text", F.xxhash64("text").alias("th")), rows, "doc_id long, th long, " + ", ".join(f"{f} long" for f in names))
    return marked.select("doc_id", "th", F.struct(*names).alias("fp"))


def band_masks(n: int, radius: int = RADIUS) -> list[int]:
    """Masks of bit combinations of which two fingerprints within the radius share at least one, for n fingerprints."""
    bands = radius + 1
    while bands < radius + 5 and (1 << (64 * (bands - radius) // bands)) * 16 < n:
        bands += 1
    edges = [64 * k // bands for k in range(bands + 1)]
    single = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    return [sum(c) for c in combinations(single, bands - radius)]


def pivot_table(fp: np.ndarray) -> np.ndarray:
    return np.bitwise_count(fp[:, None] ^ PIVOTS[None, :]).astype("i1")


def survivors(fps: np.ndarray, table: np.ndarray, i: np.ndarray, j: np.ndarray, radii: Sequence[int]) -> np.ndarray:
    """Which of the pairs (i, j) are links: coordinate after coordinate of the pivot table, then the bits themselves."""
    alive = np.arange(len(i))
    for k in range(0, table.shape[1], 6):
        near = np.abs(table[i[alive], k : k + 6] - table[j[alive], k : k + 6]).max(axis=1) <= radii[0]
        alive = alive[near]
    for fp, radius in zip(fps, radii, strict=True):
        alive = alive[np.bitwise_count(fp[i[alive]] ^ fp[j[alive]]) <= radius]
    return alive


class Forest:
    """Union-find over the rows of one task's block."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def block_links(fps: np.ndarray, key: np.ndarray, side: np.ndarray, radii: Sequence[int]) -> np.ndarray:
    """Spanning links (pairs of rows) of rows sorted by key: rows of one key are compared, of two tiles (1, 2) only across."""
    table = pivot_table(fps[0])
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    sizes = np.diff(np.r_[starts, len(key)])
    block = np.repeat(np.arange(len(starts)), sizes)
    order = np.lexsort((table[:, 0], block))
    d0 = table[order, 0]
    end = np.repeat(starts + sizes, sizes)
    forest = Forest(len(key))
    out: list[tuple[int, int]] = []
    live = np.arange(len(key))
    shift = 1
    while len(live):
        live = live[live + shift < end[live]]
        live = live[d0[live + shift] - d0[live] <= radii[0]]  # sorted: further rows of the block are further still
        i, j = order[live], order[live + shift]
        across = (side[i] != side[j]) | (side[i] == 0)
        i, j = i[across], j[across]
        hit = survivors(fps, table, i, j, radii)
        out += [(x, y) for x, y in zip(i[hit].tolist(), j[hit].tolist(), strict=True) if forest.join(x, y)]
        shift += 1
    return np.array(out, dtype="i8").reshape(-1, 2)


def links(distinct: DataFrame, radii: Sequence[int] = (RADIUS,), tile: int = TILE) -> DataFrame:
    """Links (a, b) between different fp of a stored table with one row each; connected as all links are."""
    masks = band_masks(distinct.count(), radii[0])
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    mask_cols = F.array(*[F.struct(F.lit(k).alias("band"), F.lit(signed(m)).alias("mask")) for k, m in enumerate(masks)])
    first = F.col("fp.f0")
    dealt = distinct.select("fp", F.bit_count(first.bitwiseXOR(F.lit(signed(int(PIVOTS[0]))))).alias("d0"), F.explode(mask_cols).alias("m"))
    dealt = dealt.select("fp", "d0", F.xxhash64("m.band", first.bitwiseAND(F.col("m.mask"))).alias("key"))
    shared = staged(dealt.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "simhash-blocks")
    rows_ = dealt.join(shared, "key")
    small = rows_.filter(F.col("n") <= tile).select("key", "fp", F.lit(0).alias("side"))
    return _compared(small, radii).unionAll(_compared(tiled(rows_.filter(F.col("n") > tile), radii[0], tile), radii)).distinct()


def tiled(large: DataFrame, radius: int, tile: int, *more: str) -> DataFrame:
    """Large blocks, cut into tiles of one d0 and of bounded size: key (of a pair of tiles that may hold links), fp, more, side."""
    dealt = large.withColumn("tile", F.pmod(F.xxhash64("fp"), F.ceil(F.col("n") / tile).cast("long")).cast("int"))
    tiles = staged(dealt.groupBy("key", "d0", "tile").agg(F.count("*").alias("rows")), "simhash-tiles")
    left = tiles.select("key", F.col("d0").alias("d1"), F.col("tile").alias("t1"))
    right = tiles.select("key", F.col("d0").alias("d2"), F.col("tile").alias("t2"))
    pairs = left.join(right, "key").filter((F.col("d2") - F.col("d1")).between(0, radius) & ((F.col("d1") < F.col("d2")) | (F.col("t1") <= F.col("t2"))))
    pairs = pairs.withColumn("pair", F.xxhash64("key", "d1", "t1", "d2", "t2")).withColumn("one", (F.col("d1") == F.col("d2")) & (F.col("t1") == F.col("t2")))
    sides = pairs.select("key", F.col("d1").alias("d0"), F.col("t1").alias("tile"), "pair", F.when(F.col("one"), 0).otherwise(1).alias("side")).unionAll(
        pairs.filter(~F.col("one")).select("key", F.col("d2").alias("d0"), F.col("t2").alias("tile"), "pair", F.lit(2).alias("side"))
    )
    return dealt.join(sides, ["key", "d0", "tile"]).select(F.col("pair").alias("key"), "fp", *more, "side")


def _compared(dealt: DataFrame, radii: Sequence[int]) -> DataFrame:
    names = [f"f{k}" for k in range(len(radii))]

    def rows(batches):
        held: list[np.ndarray] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            part = np.stack([batch.column(c).to_numpy().astype("i8") for c in ("key", "side", *names)])
            # whole blocks are compared as soon as a later key has come; only the last, open block is held back
            last = np.searchsorted(part[0], part[0, -1], "left")
            if last or (held and held[-1][0, -1] != part[0, -1]):
                yield from compare(np.concatenate([*held, part[:, :last]], axis=1))
                held = []
            held.append(part[:, last:])
        if held:
            yield from compare(np.concatenate(held, axis=1))

    def compare(block: np.ndarray):
        fps = block[2:]
        pairs = block_links(fps.view("u8"), block[0], block[1], radii) if block.shape[1] > 1 else ()
        if len(pairs):
            yield {f"{side}{k}": fps[k, pairs[:, at]] for at, side in enumerate("ab") for k in range(len(names))}

    flat = dealt.select("key", "side", *[F.col("fp")[f].alias(f) for f in names])
    found = map_rows(flat.repartition("key").sortWithinPartitions("key"), rows, ", ".join(f"{side}{k} long" for side in "ab" for k in range(len(names))))
    return found.select(*[F.struct(*[F.col(f"{side}{k}").alias(f) for k, f in enumerate(names)]).alias(side) for side in "ab"])


def near_duplicates(docs: DataFrame, widths: Sequence[int] = (3,), radii: Sequence[int] = (RADIUS,), seed: int = 42, tile: int = TILE) -> DataFrame:
    """doc_id, th, fp, component_id (smallest doc_id of the group), first (th of the row that stands for the group)."""
    marked = staged(fingerprints(docs, widths, seed), "simhash-fingerprints")
    return grouped(marked, lambda classes: links(classes.select("fp"), radii, tile))


def grouped(marked: DataFrame, find: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The stored rows doc_id, th, fp with component_id and first of the groups that the links (a, b) between fp make."""
    lead = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")
    classes = staged(marked.groupBy("fp").agg(F.min(lead).alias("lead")), "simhash-classes")
    roots = staged(components(find(classes)), "simhash-roots")
    group = staged(classes.join(roots, classes["fp"] == roots["node"], "left").select("fp", "lead", F.coalesce("root", "fp").alias("root")), "simhash-members")
    # stored, so that the join's sides are plain exchanges, which adaptive execution can split at a very large group
    least = staged(group.groupBy("root").agg(F.min("lead").alias("lead")), "simhash-leads")
    by_fp = staged(group.select("fp", "root").join(least, "root").select("fp", F.col("lead.doc_id").alias("component_id"), F.col("lead.th").alias("first")), "simhash-groups")
    for done in (classes, roots, group, least):
        drop_staged(done)
    return marked.join(by_fp, "fp").select("doc_id", "th", "fp", "component_id", "first")


def keep_one(docs: DataFrame, widths: Sequence[int], radii: Sequence[int]) -> DataFrame:
    """The rows of docs, with all their columns, that stand for their group: of each group one, with the smallest doc_id."""
    return standing(docs, lambda plain: near_duplicates(plain, widths, radii))


def standing(docs: DataFrame, group: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows of docs, with all their columns whatever their names, that stand for their group by group(doc_id, text).

    Of rows with equal id and text the one with the least hash of the whole row stands.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    none = F.lit(-(1 << 63))
    found = staged(group(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))), "simhash-found")
    leads = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("th") == F.col("first")))
    stay = staged(leads.groupBy(F.coalesce("doc_id", none).alias("id"), "th").agg(F.count("*").alias("n")), "simhash-stay")
    drop_staged(found)
    marked = docs.select(F.struct("*").alias("row"), F.coalesce(F.col("doc_id").cast("long"), none).alias("id"), F.xxhash64(text).alias("th"))
    # a merge join at every size: the same plan for small and large inputs, and nothing that grows is broadcast
    kept = marked.join(stay.filter("n = 1").select("id", "th").hint("merge"), ["id", "th"], "left_semi").select("row")
    if stay.filter("n > 1").limit(1).count():
        repeated = marked.join(stay.filter("n > 1").select("id", "th").hint("merge"), ["id", "th"], "left_semi").withColumn("h", F.xxhash64("row"))
        kept = kept.unionAll(repeated.groupBy("id", "th").agg(F.min_by("row", "h").alias("row")).select("row"))
    return kept.select("row.*")
