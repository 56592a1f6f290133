"""Byte-level BPE encoding and decoding by a prefix-sharing trie traversal.

BPE is compositional: the encoding of a word's prefix that ends in token t is that of the shorter prefix before t followed
by t, if and only if t may stand right behind the shorter prefix's last token, which holds when the two tokens' bytes
encode to exactly those two tokens. So one state for each prefix, its last token, describes all encodings. The distinct
words of a batch form a trie, kept as their sorted list (which is its depth-first order; a word's path shares with its
predecessor all nodes up to their common prefix). The traversal propagates last-token states down the trie, so the
encoding of a shared prefix is computed once; walking the states back from a word's end yields its ids.

Defined cases: null or empty text has no ids (digests of empty strings); a special token's string inside a text becomes its
single id, as the library does by default; very long words only make a path long; repeated rows give repeated results.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import regex
from pyspark.sql import DataFrame

from tessera.llm.byte_bpe import Memo, PieceEncoder, tokenizer_path
from tessera.llm.common import map_rows

#: The published pre-token pattern of this family of vocabularies, with Unicode White_Space spelled out.
_WS = r"\t-\r \x85\xa0  -     　"
PRETOKEN = rf"'(?:s|t|re|ve|m|ll|d)| ?\p{{L}}+| ?\p{{N}}+| ?[^{_WS}\p{{L}}\p{{N}}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+"


def printable_bytes() -> dict[str, int]:
    """The published byte-to-character table of byte-level vocabularies: printable bytes stand for themselves."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class TrieBpe(PieceEncoder):
    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        to_byte = printable_bytes()
        as_bytes = lambda s: bytes(to_byte[c] for c in s)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.ids = {as_bytes(t): i for t, i in spec["model"]["vocab"].items() if t not in self.special}
        self.bytes_of: list[bytes] = [b""] * (max([*self.ids.values(), *self.special.values()]) + 1)
        for b, i in self.ids.items():
            self.bytes_of[i] = b
        for s, i in self.special.items():
            self.bytes_of[i] = s.encode()
        self.merged: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = (as_bytes(x) for x in (pair.split(" ") if isinstance(pair, str) else pair))
            self.merged[self.ids[left], self.ids[right]] = (rank, self.ids[left + right])
        self.base = [self.ids[bytes([b])] for b in range(256)]
        # a token that does not come out of encoding its own bytes can never be the last of a prefix
        self.usable = {b: i for b, i in self.ids.items() if self.merge(b) == [i]}
        self.longest = max(map(len, self.usable))
        self.fits: dict[int, bool] = {}
        self.pattern = regex.compile(PRETOKEN)
        self.words = Memo(300_000)
        super().__init__(list(self.special))

    def merge(self, word: bytes) -> list[int]:
        """Plain merging, lowest rank first; used on pairs of tokens and to prove tokens usable."""
        ids = [self.base[b] for b in word]
        while len(ids) > 1:
            best = min(((self.merged[p], k) for k, p in enumerate(zip(ids, ids[1:])) if p in self.merged), default=None)
            if best is None:
                break
            (_, made), k = best
            ids[k : k + 2] = [made]
        return ids

    def follows(self, a: int, b: int) -> bool:
        """Whether token b may stand right behind token a inside a word."""
        key = a << 32 | b
        known = self.fits.get(key)
        if known is None:
            if len(self.fits) > 2_000_000:
                self.fits.clear()
            known = self.fits[key] = self.merge(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
        return known

    def encode_words(self, words: Iterable[bytes]) -> dict[bytes, list[int]]:
        """Ids of distinct words, by one depth-first pass over their trie."""
        usable, longest, follows, bytes_of = self.usable, self.longest, self.follows, self.bytes_of
        out: dict[bytes, list[int]] = {}
        last: list[int] = [-1]  # last[d]: last token of the first d bytes on the current path
        before = b""
        for word in sorted(words):
            d, most = 0, min(len(word), len(before))
            while d < most and word[d] == before[d]:
                d += 1
            del last[d + 1 :]
            for end in range(d + 1, len(word) + 1):
                for start in range(max(0, end - longest), end):
                    token = usable.get(word[start:end])
                    if token is not None and (start == 0 or follows(last[start], token)):
                        last.append(token)
                        break
            ids, at = [], len(word)
            while at:
                ids.append(last[at])
                at -= len(bytes_of[last[at]])
            out[word] = ids[::-1]
            before = word
        return out

    def _words(self, words: list[str]) -> list[bytes]:
        coded = [w.encode() for w in words]
        found = self.encode_words(coded)
        return [np.array(found[b], dtype="<u4").tobytes() for b in coded]

    def piece_ids(self, pieces: list[str]) -> list[bytes]:
        return self._coded([p if p[:1] == "\n" else " " + p for p in pieces])

    def _coded(self, parts: list[str]) -> list[bytes]:
        cut = [self.pattern.findall(p) for p in parts]
        words = self.words.learn(set().union(*cut), self._words)
        return [b"".join([words[w] for w in c]) for c in cut]

    def whole_ids(self, text: str) -> np.ndarray:
        parts = regex.split("(" + "|".join(map(regex.escape, self.special)) + ")", text) if self.special else [text]
        between = [np.array([self.special[p]], dtype="<u4").tobytes() for p in parts[1::2]]
        return np.frombuffer(b"".join([x for pair in zip(self._coded(parts[::2]), [*between, b""], strict=True) for x in pair]), dtype="<u4")

    def rest(self) -> None:
        super().rest()
        self.words.rest()

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids; malformed UTF-8 becomes U+FFFD."""
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist())).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def trie_bpe(path: str) -> TrieBpe:
    return TrieBpe(path)


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of a table of (doc_id, text)."""
    path = path or tokenizer_path()

    def rows(batches):
        bpe = trie_bpe(path)
        for batch in batches:
            doc_ids = batch.column("doc_id")
            for a, b, coded in bpe.encode_slices(batch.column("text")):
                yield {"doc_id": doc_ids.slice(a, b - a), "n_tokens": list(map(len, coded)), "ids_sha256": [hashlib.sha256(c.tobytes()).hexdigest() for c in coded], "decoded_sha256": [hashlib.sha256(bpe.decode(c).encode()).hexdigest() for c in coded]}
        bpe.rest()

    return map_rows(docs.select("doc_id", "text"), rows, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
