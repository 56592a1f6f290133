"""Exact byte-level BPE ids of whole texts through the tokenizers library, each distinct word encoded once.

The file's pre-tokenizer never lets a token cross from other characters to a following white-space character, nor over a
single line end, so in a text without two white-space characters in a row, pieces cut in front of each space and line end
encode independently: the ids of the text are those of its pieces, one after the other. Nor does it let a token cross from a
letter or digit to a mark other than the apostrophe, so marks that end a piece are encoded apart from it, which leaves fewer
distinct pieces. Those are encoded once and memoised per worker in a dictionary of bounded size. Other texts, and texts
holding a special token's string, go to the library whole. Cutting and finding the distinct pieces are Arrow kernels over
whole columns, putting ids together is numpy; only distinct pieces are seen by Python code.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BYTE_BPE = "byte_bpe_50k.json"
#: Entries after which a generation of a worker's dictionary is full; pieces that share one call of the library.
MEMO_ENTRIES, LINES = 600_000, 250
IDLE_ENTRIES = 200_000
#: Characters of text handled at once, which bounds lists of words; bytes of a column that the encoder takes at once.
SLICE_CHARS, ENCODE_BYTES = 2_000_000, 5_000_000

#: White space as the pre-tokenizer or Python understand it.
_GAP = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


#: Marks that may end a piece, and what must stand before them to cut there (letters and digits that no table disputes).
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_BEFORE_MARKS = r"[0-9A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{24f}]\z"


def tokenizer_path(name: str = BYTE_BPE) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def slices(texts: Sequence[str], chars: int = SLICE_CHARS):
    """Ranges of rows whose texts have about that many characters together."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > chars:
            yield start, i
            start, size = i, 0
        size += len(text)
    if texts:
        yield start, len(texts)


class Memo:
    """A dictionary of bounded size in two generations: entries not asked for while a generation fills are forgotten."""

    def __init__(self, entries: int = MEMO_ENTRIES) -> None:
        self.entries = entries
        self.now: dict = {}
        self.old: dict = {}

    def learn(self, keys: Iterable, make: Callable[[list], Iterable]) -> dict:
        """A dictionary that holds all (distinct) keys; make gives the values of a list of new ones. Valid until the next call."""
        if len(self.now) > self.entries:
            self.old, self.now = self.now, {}
        now, old = self.now, self.old
        new = [k for k in keys if k not in now]
        if old and new:
            now.update((k, old[k]) for k in new if k in old)
            new = [k for k in new if k not in old]
        if new:
            now.update(zip(new, make(new), strict=True))
        return now


    def rest(self) -> None:
        """Keep only the earliest entries, which tend to be the most frequent, until the next task."""
        self.old = {}
        if len(self.now) > IDLE_ENTRIES:
            self.now = dict(islice(self.now.items(), IDLE_ENTRIES))


def tails(strings: pa.Array, rows: np.ndarray, size: np.ndarray) -> pa.Array:
    """The last bytes, size of them, of the given rows of a column of strings."""
    offsets = np.frombuffer(strings.buffers()[1], dtype="i4")[strings.offset :]
    ends = np.cumsum(size, dtype="i4")
    place = np.repeat(offsets[rows + 1] - ends, size) + np.arange(ends[-1] if len(ends) else 0, dtype="i4")
    data = np.frombuffer(strings.buffers()[2], dtype="u1")[place]
    return pa.Array.from_buffers(pa.string(), len(rows), [None, pa.py_buffer(np.r_[np.int32(0), ends].astype("i4")), pa.py_buffer(data)])


def gathered(values: np.ndarray, size: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of values (of the sizes given, end to end) in the order of at, and where each ends."""
    begin = np.cumsum(size, dtype="i4") - size
    size_at = size[at]
    ends = np.cumsum(size_at, dtype="i4")  # of a slice of bounded size
    place = np.repeat(begin[at] - (ends - size_at), size_at)
    place += np.arange(len(place), dtype="i4")
    return values[place], ends


class PieceEncoder:
    """Ids of whole texts from the ids of their pieces. A piece starts with the line end that stood in front of it, or else
    has lost the space that did; a text is taken as if a line end stood before it, whose id is dropped again."""

    def __init__(self, special: Sequence[str]) -> None:
        self.pieces, self.marks = Memo(), Memo(20_000)
        self.odd = "|".join([f"{_GAP}{{2}}", f"^{_GAP}", f"{_GAP}$", *map(re.escape, special)]).replace("$", r"\z").replace("^", r"\A")

    def piece_ids(self, pieces: list[str]) -> Iterable[bytes]:
        raise NotImplementedError

    def whole_ids(self, text: str) -> np.ndarray:
        raise NotImplementedError

    def encode_column(self, texts: pa.Array) -> list[np.ndarray]:
        """For each text of a column its ids as unsigned 32-bit integers."""
        odd = pc.match_substring_regex(texts, self.odd)
        plain = self._plain(texts.filter(pc.invert(odd)))
        if not pc.any(odd).as_py():
            return plain
        rest = iter(plain)
        return [self.whole_ids(texts[k].as_py()) if whole else next(rest) for k, whole in enumerate(odd.to_pylist())]

    def _plain(self, texts: pa.Array) -> list[np.ndarray]:
        if not len(texts):
            return []
        cut = pc.split_pattern(pc.binary_join_element_wise("\n", pc.replace_substring(texts, "\n", " \n"), ""), " ")
        coded = cut.flatten().dictionary_encode()
        ids, ends = gathered(*self._distinct(coded.dictionary), coded.indices.to_numpy())
        offsets = cut.offsets.to_numpy()
        bounds = np.r_[0, ends][offsets - offsets[0]].tolist()
        return [ids[a + 1 : b] for a, b in zip(bounds, bounds[1:])]

    def _distinct(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct pieces end to end, and how many each has."""
        cores = pc.utf8_rtrim(pieces, characters=MARKS)
        n_marks = (pc.binary_length(pieces).to_numpy() - pc.binary_length(cores).to_numpy()).astype("i4")
        n_marks[~pc.match_substring_regex(cores, _BEFORE_MARKS).to_numpy(zero_copy_only=False)] = 0
        marked = np.flatnonzero(n_marks)
        words = pc.if_else(pa.array(n_marks > 0), cores, pieces).dictionary_encode()
        marks = tails(pieces, marked, n_marks[marked]).dictionary_encode()
        keys, ends = words.dictionary.to_pylist(), marks.dictionary.to_pylist()
        values = [b"", *map(self.pieces.learn(keys, self.piece_ids).__getitem__, keys)]
        values += map(self.marks.learn(ends, lambda new: [self.whole_ids(m).tobytes() for m in new]).__getitem__, ends)
        both = np.zeros((len(pieces), 2), dtype="i4")
        both[:, 0] = 1 + words.indices.to_numpy()
        both[marked, 1] = 1 + len(keys) + marks.indices.to_numpy()
        size = np.fromiter(map(len, values), dtype="i4", count=len(values)) // 4
        ids, _ = gathered(np.frombuffer(b"".join(values), dtype="<u4"), size, both.ravel())
        return ids, size[both].sum(axis=1, dtype="i4")

    def encode_slices(self, texts: pa.Array, most: int = ENCODE_BYTES) -> Iterator[tuple[int, int, list[np.ndarray]]]:
        """(first row, end row, ids) of a column in ranges of bounded size; null texts count as empty."""
        texts = pc.fill_null(texts, "")
        start, size = 0, 0
        for k, n in enumerate(pc.binary_length(texts).to_pylist()):
            if size and size + n > most:
                yield start, k, self.encode_column(texts.slice(start, k - start))
                start, size = k, 0
            size += n
        if len(texts):
            yield start, len(texts), self.encode_column(texts.slice(start))

    def rest(self) -> None:
        """Called at the end of a task."""
        self.pieces.rest()

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        return [x.tobytes() for _, _, ids in self.encode_slices(pa.array(texts, type=pa.string())) for x in ids]


class WordEncoder(PieceEncoder):
    """Pieces by the tokenizers library."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        super().__init__([t.content for t in self.tokenizer.get_added_tokens_decoder().values()])
        self.line = self.whole_ids("\n")
        if len(self.line) != 1:
            raise ValueError("a line end is not one token of this vocabulary")

    def whole_ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")

    def _lines(self, words: list[str]) -> list[bytes]:
        """Ids of words without white space inside (a space in front allowed), many to one call: a line end between two
        words is a token of its own, at which the ids fall apart again."""
        out: list[bytes] = []
        for a in range(0, len(words), LINES):
            ids = self.whole_ids("\n".join([*words[a : a + LINES], "."]))[:-1]
            data, at = ids.tobytes(), 0
            for end in (4 * np.flatnonzero(ids == self.line[0])).tolist():
                out.append(data[at:end])
                at = end + 4
        return out

    def piece_ids(self, pieces: list[str]) -> list[bytes]:
        words = [p[1:] if p[:1] == "\n" else " " + p for p in pieces]
        found = iter(self._lines([w for w in words if w]))
        line = self.line.tobytes()
        return [(line if p[:1] == "\n" else b"") + (next(found) if w else b"") for p, w in zip(pieces, words, strict=True)]


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)
