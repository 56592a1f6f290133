"""Removal of repeated byte strings by a depth-limited radix sort of suffixes.

A suffix matters only through its first ``length`` bytes (its window). Two steps keep the sort small without losing a match:

1. Anchors. Of the hashes of all ``gram``-byte strings inside a window the least one (the rightmost of equal ones) is the
   window's anchor. It depends on the window's bytes alone, so equal windows have equal anchors at equal distances; windows
   whose anchor occurs only once in the corpus are unique and leave the sort. Neighbouring windows share anchors: a run of
   windows with one anchor is one row with their common bytes as context.
2. Most-significant-digit passes. Windows start grouped by (anchor, distance to it); each pass refines groups by the hash of
   the next ``gram`` bytes and drops groups of one window, until ``length`` bytes are consumed. Groups of two or more that
   are left are exactly the repeated windows. Equal contexts are merged and counted first. An anchor with very many
   different contexts is cut down before: its contexts are sorted over all executors by what follows and by what precedes
   the anchor, common prefixes with both neighbours tell how far any other context agrees, and all bytes beyond are cut off,
   after which contexts of one shared passage are equal and merge. Anchors crowded even then are counted window by window.

All bytes covered by a repeated window are removed, its first occurrence included. Hashes are 64-bit and several must agree,
so a false match is out of question at any realistic size.

Defined cases: null or empty text loses nothing; texts shorter than ``length`` bytes lose nothing; two equal rows (same id
and text) are two documents and so repeat each other; matches never cross documents; very long texts are handled in blocks;
an empty table gives an empty result. What is gathered for one document (its runs, its spans) is less than its text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import drop_staged, map_batches, map_rows, staged

LENGTH, GRAM = 400, 100
BLOCK = 1 << 18
#: Different contexts of one anchor that are compared in one task; more are cut down first.
GROUP = 2000
#: Bytes of contexts refined at once.
BATCH_BYTES = 1 << 20

_RNG = np.random.default_rng(400)
_TABLE = _RNG.integers(0, 1 << 63, 256, dtype="u8") * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_LOW = np.uint64((1 << 24) - 1)
_GAP = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


class Powers:
    """Powers of the base and of its inverse modulo 2^64, as far as asked for."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype="u8")

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            m = 1 << n.bit_length()
            self.up = np.cumprod(np.r_[np.uint64(1), np.full(m, _BASE, dtype="u8")], dtype="u8")
            self.down = np.cumprod(np.r_[np.uint64(1), np.full(m, pow(_BASE, -1, 1 << 64), dtype="u8")], dtype="u8")
        return self.up[:n], self.down[:n]


_POWERS = Powers()


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of each gram-byte string of data; it depends on the string's bytes alone."""
    up, down = _POWERS.upto(len(data) + 1)
    sums = np.concatenate([np.zeros(1, dtype="u8"), np.cumsum(_TABLE[data] * down[: len(data)], dtype="u8")])
    return mixed((sums[gram:] - sums[:-gram]) * up[: len(data) - gram + 1])


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least value of each width neighbours, by prefix and suffix minima of blocks of that width."""
    n = len(x) - width + 1
    padded = np.full(-(-len(x) // width) * width, np.iinfo("u8").max, dtype="u8")
    padded[: len(x)] = x
    rows = padded.reshape(-1, width)
    left = np.minimum.accumulate(rows, axis=1).ravel()
    right = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[width - 1 : width - 1 + n])


def anchors(data: np.ndarray, ends: np.ndarray, length: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Runs of windows with one anchor in texts laid end to end: (text, first window, windows, distance, hash), in blocks."""
    width = length - gram + 1
    starts = np.r_[0, ends[:-1]]
    for at in range(0, len(data) - length + 1, BLOCK):
        part = data[at : at + BLOCK + length - 1]
        if len(part) < length:
            break
        h = gram_hashes(part, gram)
        place = _LOW - np.arange(len(h), dtype="u8")
        least = sliding_min((h & ~_LOW) | place, width)
        anchor = (_LOW - (least & _LOW)).astype("i8")
        text = np.searchsorted(ends, np.arange(at, at + len(anchor)), "right")
        inside = np.arange(at, at + len(anchor)) + length <= ends[text]
        q = np.flatnonzero(inside)
        if not len(q):
            continue
        m, t = anchor[q], text[q]
        first = np.flatnonzero(np.r_[True, (m[1:] != m[:-1]) | (t[1:] != t[:-1]) | (q[1:] != q[:-1] + 1)])
        sizes = np.diff(np.r_[first, len(q)])
        yield t[first], q[first] + at - starts[t[first]], sizes, m[first] - q[first], h[m[first]]


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and the key (did, th) by which results find back to their rows."""
    return docs.select("doc_id", "text", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("did"), F.xxhash64("text").alias("th"))


def _packed(texts: list[bytes], most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield start, i
            start, size = i, 0
        size += len(t)
    if texts:
        yield start, len(texts)


def anchor_rows(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """A row for each run of windows: did, th, q (first window), g (windows), d (distance to the anchor), hash."""

    def rows(batches):
        for batch in batches:
            did, th = batch.column("did").to_numpy(), batch.column("th").to_numpy()
            texts = [t.encode() for t in batch.column("text").to_pylist()]
            for a, b in _packed(texts):
                data = np.frombuffer(b"".join(texts[a:b]), dtype="u1")
                ends = np.cumsum([len(t) for t in texts[a:b]])
                for t, q, g, d, h in anchors(data, ends, length, gram):
                    yield {"did": did[a:b][t], "th": th[a:b][t], "q": q, "g": g.astype("i4"), "d": d.astype("i4"), "hash": h.view("i8")}

    return map_rows(docs.select("did", "th", "text"), rows, "did long, th long, q long, g int, d int, hash long")


def context_rows(docs: DataFrame, runs: DataFrame, length: int) -> DataFrame:
    """The runs with ch (hash of their context) and, where a task meets a context first, the context."""
    lists = runs.groupBy("did", "th").agg(F.collect_set(F.struct("q", "g", "d", "hash")).alias("runs"))

    def rows(batches):
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            out: list[tuple] = []
            for did, th, text, found in zip(*(batch.column(c).to_pylist() for c in ("did", "th", "text", "runs")), strict=True):
                data = text.encode()
                for r in found:
                    ctx = data[r["q"] : r["q"] + r["g"] + length - 1]
                    ch = int.from_bytes(hashlib.blake2b(ctx, digest_size=8).digest(), "little", signed=True)
                    key = (r["hash"], ch)
                    new = key not in seen
                    if new:
                        seen.add(key)
                    out.append((did, th, r["q"], r["g"], r["d"], r["hash"], ch, ctx if new else None))
                if len(out) > 4000:
                    yield dict(zip(names, zip(*out, strict=True), strict=True))
                    out = []
            if out:
                yield dict(zip(names, zip(*out, strict=True), strict=True))
            if len(seen) > 200_000:
                seen.clear()

    names = ("did", "th", "q", "g", "d", "hash", "ch", "ctx")
    # a merge join at every size: the same plan for small and large inputs, and nothing that grows is broadcast
    joined = docs.join(lists.hint("merge"), ["did", "th"]).select("did", "th", "text", "runs")
    return map_rows(joined, rows, "did long, th long, q long, g int, d int, hash long, ch long, ctx binary")


def refine(hashes: np.ndarray, dist: np.ndarray, count: np.ndarray, contexts: list[bytes], length: int, gram: int) -> list[list[tuple[int, int]]]:
    """For each context the ranges of its windows that are repeated among the given ones (whole groups of one anchor)."""
    windows = np.array([len(c) - length + 1 for c in contexts])
    data = np.frombuffer(b"".join(contexts), dtype="u1")
    begin = np.r_[0, np.cumsum([len(c) for c in contexts])][:-1]
    row = np.repeat(np.arange(len(contexts)), windows)
    j = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows)
    place = begin[row] + j
    digits = gram_hashes(data, gram)
    twice = count[row] > 1
    group = mixed(hashes.view("u8")[row] ^ mixed((dist[row] - j).astype("i8").view("u8")))
    alive = np.arange(len(row))
    for k in [*range(0, length - gram, gram), length - gram]:
        digit = digits[place[alive] + k]
        order = np.lexsort((digit, group[alive]))
        g, x = group[alive][order], digit[order]
        new = np.r_[True, (g[1:] != g[:-1]) | (x[1:] != x[:-1])]
        number = np.cumsum(new) - 1
        size = np.bincount(number)
        keep = (size[number] > 1) | twice[alive][order]
        group[alive[order]] = mixed(g * np.uint64(_BASE) + x)  # not a plain xor: the first digit can be the anchor's own hash
        alive = np.sort(alive[order[keep]])
    out: list[list[tuple[int, int]]] = [[] for _ in contexts]
    if len(alive):
        r, p = row[alive], j[alive]
        cut = np.flatnonzero(np.r_[True, (r[1:] != r[:-1]) | (p[1:] != p[:-1] + 1)])
        last = np.r_[cut[1:], len(alive)] - 1
        for x, y in zip(cut.tolist(), last.tolist(), strict=True):
            out[r[x]].append((int(p[x]), int(p[y])))
    return out


def repeated_ranges(contexts: DataFrame, length: int, gram: int) -> DataFrame:
    """hash, ch, lo, hi: the ranges of repeated windows of each of (hash, d, ch, n, ctx); groups of one anchor are compared."""

    def solve(held: list[tuple]):
        h, d, ch, n, ctx = zip(*held, strict=True)
        found = refine(np.array(h, dtype="i8"), np.array(d, dtype="i8"), np.array(n), list(ctx), length, gram)
        out = [(a, c, lo, hi) for a, c, ranges in zip(h, ch, found, strict=True) for lo, hi in ranges]
        if out:
            yield dict(zip(("hash", "ch", "lo", "hi"), zip(*out, strict=True), strict=True))

    def rows(batches):
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for r in zip(*(batch.column(c).to_pylist() for c in ("hash", "d", "ch", "n", "ctx")), strict=True):
                if size > BATCH_BYTES and held[-1][0] != r[0]:
                    yield from solve(held)
                    held, size = [], 0
                held.append(r)
                size += len(r[4])
        if held:
            yield from solve(held)

    # by an expression: a repartition by hash itself is dropped above a join on hash, and a join that turns into a broadcast
    # at run time then reads its shuffle locally, which tears the groups of one anchor apart
    ordered = contexts.select("hash", "d", "ch", "n", "ctx").repartition(F.xxhash64("hash")).sortWithinPartitions("hash")
    return map_rows(ordered, rows, "hash long, ch long, lo int, hi int")


def exploded_ranges(contexts: DataFrame, length: int, gram: int) -> DataFrame:
    """As repeated_ranges, for anchors that are still crowded: a row for each window, counted with partial sums."""

    def rows(batches):
        for batch in batches:
            h, d, n, ch = (batch.column(c).to_numpy() for c in ("hash", "d", "n", "ch"))
            for k, ctx in enumerate(batch.column("ctx").to_pylist()):
                digits = gram_hashes(np.frombuffer(ctx, dtype="u1"), gram)
                j = np.arange(len(ctx) - length + 1)
                one = mixed((d[k] - j).astype("i8").view("u8"))
                two = one + np.uint64(1)
                for at in [*range(0, length - gram, gram), length - gram]:
                    one = mixed(one * np.uint64(_BASE) + digits[j + at])
                    two = mixed(two * np.uint64(_BASE) + digits[j + at])
                yield {"hash": np.full(len(j), h[k]), "ch": np.full(len(j), ch[k]), "j": j.astype("i4"), "n": np.full(len(j), n[k]), "one": one.view("i8"), "two": two.view("i8")}

    windows = staged(map_rows(contexts.select("hash", "d", "n", "ch", "ctx"), rows, "hash long, ch long, j int, n long, one long, two long"), "suffix-windows")
    key = ["hash", "one", "two"]
    repeated = staged(windows.groupBy(*key).agg(F.sum("n").alias("of")).filter("of > 1").select(*key), "suffix-repeated")
    return windows.join(repeated, key).select("hash", "ch", F.col("j").alias("lo"), F.col("j").alias("hi"))


def _agreement(contexts: DataFrame, side: str, out: str) -> DataFrame:
    """The most bytes that a context's side ("after" or "before" the anchor) shares with another one's of the same anchor.

    A range partitioning by (hash, side) sorts them over all executors; the longest common prefix with any other is that
    with a neighbour. Each partition's first row also meets the last row of the partition before, by a small table.
    """
    ordered = staged(contexts.select("hash", "ch", side).repartitionByRange("hash", side).sortWithinPartitions("hash", side).withColumn("place", F.monotonically_increasing_id()), "suffix-order")
    part = F.shiftright("place", 33)
    edge = ordered.groupBy(part.alias("part")).agg(F.max("place").alias("place"))
    tails = ordered.join(F.broadcast(edge), "place").select("part", F.col("hash").alias("h"), F.col(side).alias("s"))
    heads = ordered.groupBy(part.alias("part")).agg(F.min("place").alias("place"))
    firsts = ordered.join(F.broadcast(heads), "place").select("part", F.col("hash").alias("h"), F.col(side).alias("s"))
    by_part = Window.orderBy("part")  # one row for each partition
    before = tails.select((F.col("part")).alias("p"), "h", "s").withColumn("next", F.lead("p").over(Window.orderBy("p"))).select(F.col("next").alias("p"), "h", "s").filter("p is not null").withColumn("last", F.lit(False))
    after = firsts.select("part", "h", "s").withColumn("p", F.lag("part").over(by_part)).select("p", "h", "s").filter("p is not null").withColumn("last", F.lit(True))
    edges = {(r["p"], r["last"]): (r["h"], bytes(r["s"])) for r in before.unionAll(after).collect()}  # two rows a partition

    def shared(a: tuple[int, bytes], b: tuple[int, bytes]) -> int:
        if a[0] != b[0]:
            return 0
        x, y = a[1], b[1]
        if x[: len(y)] == y[: len(x)]:
            return min(len(x), len(y))
        lo, hi = 0, min(len(x), len(y))
        while hi - lo > 1:
            mid = (lo + hi) // 2
            lo, hi = (mid, hi) if x[:mid] == y[:mid] else (lo, mid)
        return lo if x[: lo + 1] != y[: lo + 1] else lo + 1

    def rows(batches):
        last, held, most = None, None, 0
        for batch in batches:
            out_rows: list[tuple] = []
            for h, ch, s, place in zip(*(batch.column(c).to_pylist() for c in ("hash", "ch", side, "place")), strict=True):
                now = (h, s)
                if held is None or place >> 33 != held[2]:
                    if held is not None:
                        out_rows.append((*held[:2], max(most, shared(last, edges.get((held[2], True), (None, b""))))))
                    most = shared(now, edges.get((place >> 33, False), (None, b"")))
                else:
                    same = shared(last, now)
                    out_rows.append((*held[:2], max(most, same)))
                    most = same
                last, held = now, (h, ch, place >> 33)
            if out_rows:
                yield dict(zip(("hash", "ch", out), zip(*out_rows, strict=True), strict=True))
        if held is not None:
            yield {"hash": [held[0]], "ch": [held[1]], out: [max(most, shared(last, edges.get((held[2], True), (None, b""))))]}

    return map_rows(ordered, rows, f"hash long, ch long, {out} int")


def cut_down(contexts: DataFrame, length: int) -> DataFrame:
    """Contexts of crowded anchors without the bytes that no other context of the anchor shares.

    Input (hash, d, ch, n, ctx); output adds c (hash of the cut context) and s (bytes cut off in front); contexts that cannot
    hold a repeated window are dropped. A context that stands for several occurrences stays whole.
    """
    sides = staged(
        contexts.select("*", F.expr("substring(ctx, d + 1)").alias("after"), F.unhex(F.reverse(F.hex(F.expr("substring(ctx, 1, d)")))).alias("before")),
        "suffix-sides",
    )
    after, before = _agreement(sides, "after", "ahead"), _agreement(sides, "before", "back2")
    both = sides.join(after, ["hash", "ch"]).join(before, ["hash", "ch"]).withColumn("back", F.expr("least(back2, d)"))
    both = both.withColumns({"s": F.expr("if(n > 1, 0, d - back)"), "len": F.expr("if(n > 1, length(ctx), back + ahead)")}).filter(F.col("len") >= length)
    return both.select("hash", (F.col("d") - F.col("s")).alias("d"), "ch", "n", "s", F.expr("substring(ctx, s + 1, len)").alias("ctx")).withColumn("c", F.xxhash64("ctx", "d"))


def repeated_intervals(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, group: int = GROUP) -> DataFrame:
    """did, th, spans: for each text with repeated windows the byte intervals (lo, hi) they cover, not yet merged."""
    runs = staged(anchor_rows(docs, length, gram), "suffix-anchors")
    shared = staged(runs.groupBy("hash").agg(F.count("*").alias("n")).filter("n > 1").select("hash"), "suffix-shared")
    found = staged(context_rows(docs, runs.join(shared, "hash"), length), "suffix-contexts")
    drop_staged(runs)
    drop_staged(shared)
    counts = found.groupBy("hash", "ch").agg(F.count("*").alias("n"))
    one = found.filter("ctx is not null").groupBy("hash", "ch").agg(F.first("d").alias("d"), F.first("ctx").alias("ctx"))
    contexts = staged(one.join(counts, ["hash", "ch"]), "suffix-groups")
    sizes = contexts.groupBy("hash").agg(F.count("*").alias("of"), F.max("n").alias("most"))
    live = sizes.filter("of > 1 or most > 1")
    crowded = staged(live.filter(F.col("of") > group).select("hash"), "suffix-crowded")
    usual = contexts.join(live.filter(F.col("of") <= group).select("hash"), "hash")
    ranges = repeated_ranges(usual, length, gram)
    if crowded.limit(1).count():
        cut = staged(cut_down(contexts.join(crowded, "hash"), length), "suffix-cut")
        merged = staged(cut.groupBy("hash", "d", "c").agg(F.sum("n").alias("n"), F.first("ctx").alias("ctx")).withColumnRenamed("c", "ch"), "suffix-merged")
        still = staged(merged.groupBy("hash").agg(F.count("*").alias("of")).filter(F.col("of") > group).select("hash"), "suffix-still")
        few, many = merged.join(still, "hash", "left_anti"), merged.join(still, "hash", "left_semi")
        inner = repeated_ranges(few, length, gram).unionAll(exploded_ranges(many, length, gram)).withColumnRenamed("ch", "c")
        back = cut.select("hash", "c", "ch", "s").join(inner, ["hash", "c"])
        ranges = ranges.unionAll(back.select("hash", "ch", (F.col("lo") + F.col("s")).alias("lo"), (F.col("hi") + F.col("s")).alias("hi")))
    ranges = staged(ranges.groupBy("hash", "ch").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges")), "suffix-ranges")
    hits = found.select("did", "th", "q", "hash", "ch").join(ranges, ["hash", "ch"])
    spans = hits.select("did", "th", F.explode(F.transform("ranges", lambda r: F.struct((F.col("q") + r["lo"]).alias("lo"), (F.col("q") + r["hi"] + length).alias("hi")))).alias("span"))
    out = staged(spans.groupBy("did", "th").agg(F.collect_set("span").alias("spans")), "suffix-spans")
    for done in (found, contexts, crowded, ranges):
        drop_staged(done)
    return out


def short_passages(docs: DataFrame, words: int, below: int) -> DataFrame:
    """did, th, spans: the byte intervals of repeated passages of so many whole words that have fewer bytes than below."""

    def rows(batches):
        for batch in batches:
            out: list[tuple] = []
            for did, th, text in zip(*(batch.column(c).to_pylist() for c in ("did", "th", "text")), strict=True):
                data = text.encode()
                inside = np.r_[False, ~_GAP[np.frombuffer(data, dtype="u1")], False]
                edge = np.flatnonzero(inside[1:] != inside[:-1])
                lo, hi = edge[::2], edge[1::2]
                lo, hi = lo[: max(0, len(lo) - words + 1)], hi[words - 1 :]
                for a, b in zip(lo[hi - lo < below].tolist(), hi[hi - lo < below].tolist(), strict=True):
                    h = hashlib.blake2b(data[a:b], digest_size=16).digest()
                    out.append((did, th, a, b, int.from_bytes(h[:8], "little", signed=True), int.from_bytes(h[8:], "little", signed=True)))
                if len(out) > 4000:
                    yield dict(zip(names, zip(*out, strict=True), strict=True))
                    out = []
            if out:
                yield dict(zip(names, zip(*out, strict=True), strict=True))

    names = ("did", "th", "lo", "hi", "one", "two")
    windows = staged(map_rows(docs.select("did", "th", "text"), rows, "did long, th long, lo long, hi long, one long, two long"), "suffix-short")
    repeated = staged(windows.groupBy("one", "two").agg(F.count("*").alias("of")).filter("of > 1").select("one", "two"), "suffix-short-repeated")
    hits = windows.join(repeated.hint("merge"), ["one", "two"])
    return hits.groupBy("did", "th").agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))


def merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Maximal runs covered by the intervals."""
    out: list[tuple[int, int]] = []
    for lo, hi in sorted((s["lo"], s["hi"]) for s in spans or ()):
        if out and lo <= out[-1][1]:
            out[-1] = out[-1][0], max(hi, out[-1][1])
        else:
            out.append((lo, hi))
    return out


def without(data: bytes, runs: list[tuple[int, int]]) -> bytes:
    at, kept = 0, []
    for lo, hi in runs:
        kept.append(data[at:lo])
        at = hi
    return b"".join([*kept, data[at:]])


def whole_characters(data: bytes, lo: int, hi: int) -> tuple[int, int]:
    """The run without parts of characters at its ends, so that what is left is UTF-8."""
    while lo < hi and data[lo] & 0xC0 == 0x80:
        lo += 1
    while hi > lo and hi < len(data) and data[hi] & 0xC0 == 0x80:
        hi -= 1
    return lo, hi


def report(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, group: int = GROUP) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and text of a table of (doc_id, text).

    text is what is left, in whole characters: parts of a character at the ends of a removed run stay in it.
    """
    marked = keyed(docs)
    joined = marked.join(repeated_intervals(marked, length, gram, group).hint("merge"), ["did", "th"], "left").select("doc_id", "text", "spans")

    def rows(batches):
        for batch in batches:
            out = []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                data, runs = text.encode(), merged(spans)
                left = without(data, [whole_characters(data, lo, hi) for lo, hi in runs]).decode() if runs else text
                out.append((len(data), sum(hi - lo for lo, hi in runs), len(runs), hashlib.sha256(without(data, runs)).hexdigest(), left))
            if out:
                yield {"doc_id": batch.column("doc_id")} | dict(zip(("n_bytes", "n_removed", "n_spans", "kept_sha256", "text"), zip(*out, strict=True), strict=True))

    return map_rows(joined, rows, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, text string")


def cleaned(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, group: int = GROUP, words: int = 0) -> DataFrame:
    """A table (doc_id, text, ...) with its repeated passages cut out of text, in whole characters; other columns, whatever
    their names, and null texts stay as they are, and so do rows of which nothing is left but an empty text. With words,
    repeated passages of so many words go too where they are shorter than length."""
    row, text = F.struct("*").alias("row"), F.coalesce("text", F.lit(""))
    marked = docs.select(row, F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("did"), F.xxhash64(text).alias("th"))
    plain = keyed(docs.select(F.col("doc_id").cast("long"), text.alias("text")))
    spans = repeated_intervals(plain, length, gram, group)
    if words:
        both = spans.unionAll(short_passages(plain, words, length))
        spans = both.groupBy("did", "th").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    joined = marked.join(spans.hint("merge"), ["did", "th"], "left").select("row", "spans")
    place = docs.columns.index("text")

    def cut(batches):
        for batch in batches:
            columns = batch.column("row").flatten()
            texts = columns[place].to_pylist()
            for k, found in enumerate(batch.column("spans").to_pylist()):
                if found and texts[k] is not None:
                    data = texts[k].encode()
                    texts[k] = without(data, [whole_characters(data, lo, hi) for lo, hi in merged(found)]).decode()
            columns[place] = pa.array(texts, type=columns[place].type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = docs.columns
    return map_batches(joined, cut, docs.schema)
