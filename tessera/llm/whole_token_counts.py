"""Token counts of a sentencepiece BPE model with a whole-token shortcut.

Offline, once per worker, ``proven`` encodes every vocabulary string of the shape of one pre-token and keeps those that come
back as a single id. White space is the sign U+2581 in the model; as no vocabulary string holds that sign behind another
character (checked on loading), merges never cross into a new word, so a text is a sequence of independent pre-tokens.
Pre-tokens in the proven table count as one; the rest are merged by the library, each distinct one once per batch and worker.

Defined cases: null or empty text counts 0 tokens and 0 bytes; empty tables give empty results; repeated rows are counted
each; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import lru_cache

from pyspark.sql import DataFrame

from tessera.llm.byte_bpe import MEMO_ENTRIES, Memo, slices, tokenizer_path
from tessera.llm.common import map_rows

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
_PRETOKEN = re.compile(f"{SPACE}+[^{SPACE}]*")


class PieceCounter:
    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any(SPACE in p.lstrip(SPACE) for p in pieces):
            raise ValueError("a vocabulary string crosses words; counts cannot be taken word by word")
        self.whole = self.proven(pieces)
        # a lone space sign is a pre-token too, which the library cannot be given as a word
        self.start = dict.fromkeys(self.whole, 1) | {"": 1 if SPACE in pieces else len(SPACE.encode())}
        self.memo = Memo(MEMO_ENTRIES + len(self.start))

    def proven(self, pieces: Sequence[str]) -> frozenset[str]:
        """Words (without their leading space sign) that the library encodes as one token when they stand alone."""
        words = [p[1:] for p in pieces if p[:1] == SPACE and len(p) > 1 and SPACE not in p[1:]]
        return frozenset(w for w, ids in zip(words, self.model.encode(words, num_threads=1), strict=True) if len(ids) == 1)

    def _merge(self, words: list[str]) -> list[int]:
        """Counts of pre-tokens given without one leading sign; the library puts that sign in front itself."""
        return [len(ids) for ids in self.model.encode(words, num_threads=1)]

    def count(self, texts: Sequence[str]) -> list[int]:
        out: list[int] = []
        for a, b in slices(texts):
            cut = [self._words(t) for t in texts[a:b]]
            get = self.memo.learn(set().union(*cut), self._known_or_merged).__getitem__
            out += [sum(map(get, words)) for words in cut]
        return out

    def _known_or_merged(self, words: list[str]) -> list[int]:
        merged = iter(self._merge([w for w in words if w not in self.start]))
        return [self.start[w] if w in self.start else next(merged) for w in words]

    @staticmethod
    def _words(text: str) -> list[str]:
        if not text:
            return []
        if "  " in text or SPACE in text or text[0] == " " or text[-1] == " ":
            return [m[1:].replace(SPACE, " ") for m in _PRETOKEN.findall(SPACE + text.replace(" ", SPACE))]
        return text.split(" ")


@lru_cache(maxsize=2)
def piece_counter(path: str) -> PieceCounter:
    return PieceCounter(path)


def count_tokens(docs: DataFrame, path: str | None = None, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for a table of (doc_id, text)."""
    path = path or tokenizer_path(MODEL)

    def rows(batches):
        counter = piece_counter(path)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            n = counter.count(texts)
            yield {"doc_id": batch.column("doc_id").to_pylist(), "n_bytes": [len(t.encode()) for t in texts], "n_tokens": n, "over_limit": [x > limit for x in n]}
        counter.memo.rest()

    return map_rows(docs.select("doc_id", "text"), rows, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
