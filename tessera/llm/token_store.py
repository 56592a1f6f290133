"""Token ids on disk: independent zstandard frames, a document index and a trailing seek table.

A shard is a valid zstandard stream. Each document's ids form frames of their own (at most FRAME_IDS ids each, so that a very
long document needs no large buffer); each frame carries zstandard's content checksum. A skippable frame behind the data
holds the document index (id, ids, first frame; compressed), and the last one is a seek table in the published seekable
layout: for each frame its compressed size, its size and the low half of its XXH64, then the frame count, a descriptor and a
magic number. A reader takes the table from the file's end and decompresses only the frames of the documents asked for.

``write_shards`` encodes the texts and compresses their frames where they lie, then orders only the frames by document over
range partitions; each task writes one shard under a name of its own into the shared folder and reports it in a manifest;
shards of lost or repeated attempts are in no manifest and are never read.

Defined cases: a null or empty text is stored as its end id alone; null ids come first; repeated rows are stored each;
an empty table has an empty manifest.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.byte_bpe import tokenizer_path, word_encoder
from tessera.llm.common import drop_staged, map_rows, scratch, staged

#: Fixed values of the published zstandard frame and seekable formats.
SKIPPABLE_INDEX, SKIPPABLE_SEEK, SEEKABLE_MAGIC, DESCRIPTOR = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1, 0x80
FRAME_IDS = 1 << 18
NULL_ID = -(1 << 63)


class ShardError(ValueError):
    """A shard that is cut off or whose checksums do not hold."""


def open_store(uri: str):
    """(file system, path) of a URI or plain path, by pyarrow: executors reach the shared folder whatever it is."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def id_width(vocab_size: int) -> str:
    """numpy type in which ids of such a vocabulary are stored."""
    return "<u2" if vocab_size <= 1 << 16 else "<u4"


class Frames:
    """Compresses documents' ids, whose bytes have a shard's width, into frames."""

    def __init__(self, dtype: str, level: int = 3) -> None:
        self.most = FRAME_IDS * np.dtype(dtype).itemsize
        self.zstd = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)

    def of(self, data: memoryview | bytes) -> tuple[bytes, bytes]:
        """A document's frames end to end, and their entries of the seek table."""
        frames, entries = [], []
        for k in range(0, len(data), self.most):
            part = data[k : k + self.most]
            frames.append(self.zstd.compress(part))
            entries.append(struct.pack("<III", len(frames[-1]), len(part), xxhash.xxh64_intdigest(part) & 0xFFFFFFFF))
        return b"".join(frames), b"".join(entries)


class ShardWriter:
    """Writes documents, compressed beforehand or not, to a binary file."""

    def __init__(self, sink, vocab_size: int = 1 << 16, level: int = 3) -> None:
        self.sink, self.dtype = sink, id_width(vocab_size)
        self.frames = Frames(self.dtype, level)
        self.table: list[bytes] = []
        self.n_frames = 0
        self.docs: list[tuple[int, int, int]] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.add_frames(doc_id, len(ids), *self.frames.of(ids.astype(self.dtype).tobytes()))

    def add_frames(self, doc_id: int | None, n_ids: int, frames: bytes, entries: bytes) -> None:
        self.docs.append((NULL_ID if doc_id is None else doc_id, n_ids, self.n_frames))
        self.sink.write(frames)
        self.table.append(entries)
        self.n_frames += len(entries) // 12

    def close(self) -> None:
        index = struct.pack("<B", int(self.dtype[-1])) + self.frames.zstd.compress(np.array(self.docs, dtype="<i8").reshape(-1, 3).tobytes())
        self.sink.write(struct.pack("<II", SKIPPABLE_INDEX, len(index)) + index)
        entries = b"".join([*self.table, struct.pack("<III", len(index) + 8, 0, 0)])
        self.sink.write(struct.pack("<II", SKIPPABLE_SEEK, len(entries) + 9) + entries + struct.pack("<IBI", len(entries) // 12, DESCRIPTOR, SEEKABLE_MAGIC))


class ShardReader:
    """Random access to the documents of a shard given as a seekable binary file."""

    def __init__(self, source) -> None:
        self.source = source
        size = source.seek(0, 2)
        if size < 17:
            raise ShardError("too short for a seek table")
        source.seek(size - 9)
        count, descriptor, magic = struct.unpack("<IBI", source.read(9))
        if magic != SEEKABLE_MAGIC or descriptor != DESCRIPTOR or size < 17 + 12 * count:
            raise ShardError("no seek table at the end")
        source.seek(size - 17 - 12 * count)
        kind, length = struct.unpack("<II", source.read(8))
        if kind != SKIPPABLE_SEEK or length != 12 * count + 9:
            raise ShardError("damaged seek table")
        self.table = np.frombuffer(source.read(12 * count), dtype="<u4").reshape(-1, 3)
        self.offset = np.concatenate([[0], np.cumsum(self.table[:, 0].astype("i8"))])
        source.seek(int(self.offset[-2]))
        kind, length = struct.unpack("<II", source.read(8))
        if kind != SKIPPABLE_INDEX:
            raise ShardError("damaged document index")
        index = source.read(length)
        self.dtype = f"<u{index[0]}"
        self.unpack = zstandard.ZstdDecompressor()
        try:
            self.docs = np.frombuffer(self.unpack.decompress(index[1:]), dtype="<i8").reshape(-1, 3)
        except zstandard.ZstdError as e:
            raise ShardError("damaged document index") from e

    def _frames(self, first: int, n_ids: int) -> np.ndarray:
        n = -(-n_ids // FRAME_IDS)
        self.source.seek(int(self.offset[first]))
        data = memoryview(self.source.read(int(self.offset[first + n] - self.offset[first])))
        parts, at = [], 0
        for packed, size, check in self.table[first : first + n].tolist():
            try:
                part = self.unpack.decompress(data[at : at + packed], max_output_size=size)
            except zstandard.ZstdError as e:
                raise ShardError("damaged frame") from e
            if len(part) != size or xxhash.xxh64_intdigest(part) & 0xFFFFFFFF != check:
                raise ShardError("checksum of a frame does not hold")
            parts.append(part)
            at += packed
        return np.frombuffer(b"".join(parts), dtype=self.dtype).astype("<u4")

    def read(self, rows: Iterable[int] | None = None) -> Iterator[tuple[int | None, np.ndarray]]:
        """(doc_id, ids) of the given places in the shard, or of all."""
        for k in range(len(self.docs)) if rows is None else rows:
            doc_id, n_ids, first = self.docs[k].tolist()
            yield (None if doc_id == NULL_ID else doc_id), self._frames(first, n_ids)

    def documents(self, doc_ids: Sequence[int]) -> dict[int, np.ndarray]:
        """Ids of the documents asked for; only their frames are read."""
        wanted = np.flatnonzero(np.isin(self.docs[:, 0], np.array(list(doc_ids), dtype="i8")))
        return dict(self.read(wanted.tolist()))


def stored_width(path: str, end_id: int) -> str:
    return id_width(max(word_encoder(path).tokenizer.get_vocab_size(), end_id + 1))


def encoded(docs: DataFrame, path: str, end_id: int, dtype: str) -> DataFrame:
    """doc_id, n_ids, frames and entries of (doc_id, text) with the end id: compressed where the texts lie, no row moves."""

    def rows(batches):
        encoder, compress = word_encoder(path), Frames(dtype).of
        width = np.dtype(dtype).itemsize
        end = np.array([end_id], dtype="<u4")
        for batch in batches:
            doc_ids = batch.column("doc_id")
            for a, b, coded in encoder.encode_slices(batch.column("text")):
                data = memoryview(np.concatenate([x for own in coded for x in (own, end)], dtype=np.dtype(dtype), casting="unsafe")).cast("B")
                n_ids = [len(own) + 1 for own in coded]
                ends = (np.cumsum(n_ids) * width).tolist()
                frames, entries = zip(*[compress(data[x:y]) for x, y in zip([0, *ends], ends)], strict=True)
                yield {"doc_id": doc_ids.slice(a, b - a), "n_ids": n_ids, "frames": frames, "entries": entries}
        encoder.rest()

    return map_rows(docs.select("doc_id", "text"), rows, "doc_id long, n_ids long, frames binary, entries binary")


def write_encoded(ids: DataFrame, folder: str, dtype: str) -> DataFrame:
    """Shards of a stored table of encoded() in ascending doc_id order; the manifest (part, uri, n_docs, n_tokens)."""
    vocab_size = 1 << 8 * np.dtype(dtype).itemsize

    def rows(batches):
        part = TaskContext.get().partitionId()
        uri = f"{folder}/shard-{part:06d}-{uuid.uuid4().hex}.zst"
        store = n_tokens = 0
        for batch in batches:
            if batch.num_rows and not store:
                store, name = open_store(uri)
                store.create_dir(name.rsplit("/", 1)[0], recursive=True)
                sink = store.open_output_stream(name, compression=None)
                writer = ShardWriter(sink, vocab_size)
            for doc_id, n_ids, frames, entries in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n_ids", "frames", "entries")), strict=True):
                writer.add_frames(doc_id, n_ids, frames, entries)
                n_tokens += n_ids
        if store:
            writer.close()
            sink.close()
            yield {"part": [part], "uri": [uri], "n_docs": [len(writer.docs)], "n_tokens": [n_tokens]}

    ordered = ids.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "n_ids", "frames")
    return map_rows(ordered, rows, "part long, uri string, n_docs long, n_tokens long")


def write_shards(docs: DataFrame, folder: str, path: str | None = None, end_id: int = 2) -> DataFrame:
    """Encode (doc_id, text), write shards in ascending doc_id order, return the stored manifest."""
    path = path or tokenizer_path()
    dtype = stored_width(path, end_id)
    ids = staged(encoded(docs, path, end_id, dtype), "token-ids")  # sampled for its ranges: it must not be encoded twice
    manifest = staged(write_encoded(ids, folder, dtype), "token-manifest")
    drop_staged(ids)
    return manifest


def read_shards(manifest: DataFrame) -> DataFrame:
    """Every document of the shards in the manifest: doc_id, start, n_tokens, ids_crc32, in blocks of documents per shard."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))

    def rows(batches):
        for batch in batches:
            for uri, start in zip(batch.column("uri").to_pylist(), batch.column("start").to_pylist(), strict=True):
                store, name = open_store(uri)
                with store.open_input_file(name) as source:
                    out: list[tuple] = []
                    for doc_id, ids in ShardReader(source).read():
                        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
                        start += len(ids)
                        if len(out) == 10_000:
                            yield dict(zip(("doc_id", "start", "n_tokens", "ids_crc32"), zip(*out, strict=True), strict=True))
                            out = []
                    if out:
                        yield dict(zip(("doc_id", "start", "n_tokens", "ids_crc32"), zip(*out, strict=True), strict=True))

    spread = placed.select("uri", "start").repartition(max(1, manifest.count()), "uri")
    return map_rows(spread, rows, "doc_id long, start long, n_tokens long, ids_crc32 long")


def stored(docs: DataFrame, path: str | None = None, end_id: int = 2) -> DataFrame:
    """Write the ids of docs, then read every document back from the shards."""
    spark = docs.sparkSession
    return read_shards(write_shards(docs, scratch(spark, "token-shards"), path, end_id))
