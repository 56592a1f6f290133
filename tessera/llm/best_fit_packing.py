"""Best-fit decreasing packing of all documents into sequences of fixed length, exact over the whole corpus.

Pieces of equal length are interchangeable, so the decisions of best-fit decreasing depend only on how many pieces of each
length there are: a table of at most ``capacity`` rows, whatever the size of the corpus. ``plan`` runs the algorithm on it.
A segment tree over remaining capacities tells for a piece the tightest open sequence in logarithmic time; sequences with
the same room are kept as runs, so that a run takes many pieces in one step. The outcome is a list of segments: the pieces
with ranks a.. of one length go, m to a sequence, into a run of sequences at an offset.

``pack`` then ranks all pieces by (length, doc_id, piece) with a range partitioning (no key of one length lands in one task)
and looks each rank up in the plan.

Defined cases: a null or empty text is its end id alone; repeated rows are packed each; an empty table gives no piece;
a document longer than the capacity is cut into full pieces, the first of which may be shorter.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.byte_bpe import tokenizer_path, word_encoder
from tessera.llm.common import map_rows, staged


class RoomTree:
    """Number of open sequences for each remaining capacity, with the tightest sufficient one found in logarithmic time."""

    def __init__(self, capacity: int) -> None:
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)

    def add(self, room: int, n: int) -> None:
        at = room + self.size
        while at:
            self.count[at] += n
            at //= 2

    def tightest(self, need: int) -> int | None:
        """Smallest room >= need that an open sequence has."""
        at = need + self.size
        if self.count[at]:
            return need
        while at > 1 and (at % 2 or not self.count[at + 1]):
            at //= 2
        if at <= 1:
            return None
        at += 1
        while at < self.size:
            at = 2 * at if self.count[2 * at] else 2 * at + 1
        return at - self.size


@dataclass(frozen=True)
class Segment:
    length: int
    rank: int  # of its first piece among all pieces, longest first
    sequence: int  # the first of its run of sequences
    each: int  # pieces that one sequence takes
    offset: int  # of the first piece in a sequence


def plan(lengths: dict[int, int], capacity: int) -> list[Segment]:
    """Best-fit decreasing of lengths[s] pieces of each length s."""
    tree, open_runs, segments = RoomTree(capacity), {}, []
    sequence = rank = 0

    def opened(first: int, n: int, room: int) -> None:
        if n and room:
            open_runs.setdefault(room, []).append((first, n))
            tree.add(room, n)

    def placed(length: int, first: int, n: int, room: int, each: int) -> None:
        nonlocal rank
        segments.append(Segment(length, rank, first, each, capacity - room))
        rank += n * each
        opened(first, n, room - each * length)

    for length in sorted(lengths, reverse=True):
        left = lengths[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                first, n, room = sequence, -(-left // (capacity // length)), capacity
                sequence += n
            else:
                first, n = open_runs[room].pop()
                tree.add(room, -n)
            each = room // length
            full = min(n, left // each)
            if full:
                placed(length, first, full, room, each)
                left -= full * each
            if full < n and 0 < left < each:
                placed(length, first + full, 1, room, left)
                full, left = full + 1, 0
            if room < capacity:
                opened(first + full, n - full, room)
    return segments


def pieces(docs: DataFrame, capacity: int = 2048, end_id: int = 0, path: str | None = None) -> DataFrame:
    """Pieces of (doc_id, text): doc_id, piece, start, length, ids_crc32."""
    path = path or tokenizer_path()

    def rows(batches):
        encoder = word_encoder(path)
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for a, b, coded in encoder.encode_slices(batch.column("text")):
                out: list[tuple] = []
                for doc_id, own in zip(ids[a:b], coded, strict=True):
                    data, n = own.tobytes() + end, len(own) + 1
                    cut = [0, *range((n - 1) % capacity + 1, n + 1, capacity)]
                    out += [(doc_id, k, x, y - x, zlib.crc32(data[4 * x : 4 * y])) for k, (x, y) in enumerate(zip(cut, cut[1:]))]
                yield dict(zip(("doc_id", "piece", "start", "length", "ids_crc32"), zip(*out, strict=True), strict=True))
        encoder.rest()

    return map_rows(docs.select("doc_id", "text"), rows, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(cut: DataFrame, capacity: int = 2048) -> DataFrame:
    """The pieces with sequence_id and offset. cut is read more than once: give a stored table."""
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # capacity rows at most
    segments = plan(counts, capacity)
    ordered = cut.repartitionByRange(F.desc("length"), F.asc("doc_id"), F.asc("piece")).sortWithinPartitions(F.desc("length"), F.asc("doc_id"), F.asc("piece"), F.asc("ids_crc32"))
    ranked = staged(ordered.withColumn("__place", F.monotonically_increasing_id()), "packing-order")
    part = F.shiftright("__place", 33)
    sizes = sorted((r["p"], r["n"]) for r in ranked.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect())  # one row a partition
    base = dict(zip((p for p, _ in sizes), np.concatenate([[0], np.cumsum([n for _, n in sizes])]).tolist(), strict=False))
    ranks = np.array([s.rank for s in segments], dtype="i8")
    fields = np.array([(s.length, s.sequence, s.each, s.offset) for s in segments], dtype="i8").reshape(-1, 4)

    def rows(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            place = batch.column("__place").to_numpy()
            rank = (place & ((1 << 33) - 1)) + np.array([base[p] for p in (place >> 33).tolist()], dtype="i8")
            at = np.searchsorted(ranks, rank, "right") - 1
            length, sequence, each, offset = fields[at].T
            k = rank - ranks[at]
            cols = {c: batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")}
            yield cols | {"sequence_id": sequence + k // each, "offset": offset + (k % each) * length}

    return map_rows(ranked, rows, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def pack_documents(docs: DataFrame, capacity: int = 2048, end_id: int = 0, path: str | None = None) -> DataFrame:
    return pack(staged(pieces(docs, capacity, end_id, path), "packing-pieces"), capacity)
