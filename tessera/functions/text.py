"""Text functions as Columns; Arrow UDFs only for what Spark has no function for (NFC, sequence ratio, blake2b)."""

from __future__ import annotations

import difflib
import functools
import hashlib
import math
import re
import unicodedata
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as S

from tessera import constants as C

#: ASCII white space without vertical tab, spelled out because engines differ in what their short class holds.
ASCII_SPACE = r"[\t\n\f\r ]"
UNICODE_SPACE = r"[\s\u0085   -     　\u001c-\u001f]+"
CJK = r"぀-ヿ㐀-䶿一-鿿가-힣"
TOKEN = rf"[A-Za-z_][A-Za-z0-9_]*|\p{{Nd}}+|[{CJK}]+|[\p{{L}}\p{{Nl}}\p{{No}}&&[^{CJK}]]+"


@F.pandas_udf(S.StringType())
def _nfc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: x if x is None else unicodedata.normalize("NFC", x))


#: Blocks without a character that composition may change; tested first, as most texts hold nothing else.
SETTLED = ((0x0, 0x2FF), (0x400, 0x482), (0x48A, 0x590), (0x2010, 0x20CF), (0x3001, 0x3029), (0x3030, 0x3098), (0x309B, 0x9FFF), (0xAC00, 0xD7A3))


@functools.cache
def unsettled() -> str:
    """Class of the characters without which a text is in canonical composition: marks, what is decomposed or composed anew."""
    seconds = {int(d[1], 16) for c in range(0x80, 0x30000) if len(d := unicodedata.decomposition(chr(c)).split()) == 2 and not d[0].startswith("<")}
    jamo = {*range(0x1161, 0x1176), *range(0x11A8, 0x11C3)}
    odd = [c for c in range(0x80, 0x30000) if not 0xD800 <= c < 0xE000 and (c in seconds or c in jamo or unicodedata.combining(chr(c)) or not unicodedata.is_normalized("NFC", chr(c)))]
    starts = [c for c, before in zip(odd, [None, *odd]) if before is None or c != before + 1]
    ends = [c for c, after in zip(odd, [*odd[1:], None]) if after is None or after != c + 1]
    spans = lambda pairs: "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in pairs)
    return f"[[^{spans(SETTLED[:1])}]&&[^{spans(SETTLED[1:])}]&&[{spans(zip(starts, ends))}]]"


def nfc(text: Column) -> Column:
    """Canonical composition; only texts that it may change leave the JVM."""
    return F.coalesce(_nfc(F.when(F.rlike(text, F.lit(unsettled())), text)), text)


def strip_ascii_space(text: Column) -> Column:
    return F.regexp_replace(text, ASCII_SPACE, "")


def collapse_space(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, UNICODE_SPACE, " "))


def unix_lines(text: Column) -> Column:
    return F.regexp_replace(text, "\r\n?", "\n")


def strip_controls(text: Column) -> Column:
    return F.regexp_replace(text, r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", "")


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def content_fingerprint(text: Column) -> Column:
    return sha256(collapse_space(nfc(text)))


def slug(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(nfc(text)), r"(?U)[^\w]+", "-"), "^-+|-+$", "")


def extension(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"\.([^.]+)$", 1))


BINARY = ("hwp", "hwpx", "docx", "pptx", "xlsx", "doc", "xls", "ppt", "pdf")
TEXTUAL = ("md", "txt", "rst", "py")


def document_id(path: Column) -> Column:
    """Slug of the base name without a known suffix; binary formats keep theirs; a path without letters gets a hash."""
    name = F.element_at(F.split(path, "/"), -1)
    ext = extension(name)
    stem = F.when(ext.isin(*BINARY, *TEXTUAL), F.regexp_replace(name, r"\.[^.]+$", "")).otherwise(name)
    base = slug(stem)
    named = F.when(ext.isin(*BINARY), F.concat_ws("-", F.nullif(base, F.lit("")), ext)).otherwise(base)
    return F.when(base == "", F.substring(sha256(path), 1, 16)).otherwise(named)


def entity_id(name: Column) -> Column:
    return slug(F.regexp_replace(F.regexp_replace(F.trim(name), "^[\"']+|[\"']+$", ""), r"\.(md|txt|rst|py)$", ""))


def chunk_id(doc_id: Column, index: Column) -> Column:
    return F.format_string("%s#%04d", doc_id, index.cast("int"))


def relation_id(doc_id: Column, source: Column, relation: Column, target: Column) -> Column:
    return F.substring(sha256(F.concat_ws("|", doc_id, source, relation, target)), 1, 24)


def collection(path: Column) -> Column:
    return F.when(F.instr(path, "/") > 0, F.substring_index(path, "/", 1)).otherwise(F.lit("_root"))


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def embed_text(title: Column, heading: Column, content: Column) -> Column:
    head = blank_to_null(heading)
    return F.concat_ws("\n", F.concat(F.lit("# "), title), F.coalesce(F.concat(F.lit("## "), head), F.lit("")), content)


def token_estimate(text: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(F.length(text) / C.CHARS_PER_TOKEN)).cast("long")


def snippet(text: Column, most: int = C.SNIPPET) -> Column:
    return F.struct(F.substring(text, 1, most).alias("text"), (F.length(text) > most).alias("truncated"))


def tokens(text: Column) -> Column:
    """Identifiers, digit runs, CJK runs and other letters, lower-cased; one tokenizer for index and query."""
    return F.transform(F.regexp_extract_all(nfc(text), F.lit(TOKEN), F.lit(0)), F.lower)


def simple_tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9_]+"), F.lit(0))


def ngrams(run: Column, n: int) -> Column:
    """Overlapping n-character pieces; a run no longer than n stays whole."""
    return F.when(F.length(run) > n, F.transform(F.sequence(F.lit(1), F.length(run) - (n - 1)), lambda i: F.substring(run, i, F.lit(n)))).otherwise(F.array(run))


def index_terms(text: Column, n: int = 2) -> Column:
    """Tokens with CJK runs cut into overlapping bigrams, for postings and queries alike."""
    return F.flatten(F.transform(tokens(text), lambda t: F.when(F.rlike(t, F.lit(f"^[{CJK}]+$")), ngrams(t, n)).otherwise(F.array(t))))


def query_terms(text: Column) -> Column:
    return F.array_distinct(index_terms(text))


@F.pandas_udf(S.ArrayType(S.StringType()))
def shingles(s: pd.Series) -> pd.Series:
    """Distinct pieces of SHINGLE characters, in order; an Arrow UDF because a JVM substring walks a text from its start."""
    w = C.SHINGLE
    return s.map(lambda t: list(dict.fromkeys(t[i : i + w] for i in range(len(t) - w + 1))) if t else [])


@F.pandas_udf(S.ArrayType(S.LongType()))
def shingle_keys(s: pd.Series) -> pd.Series:
    """64-bit hashes of the distinct pieces: what set comparisons need, at a fraction of the size."""
    w = C.SHINGLE

    def keys(t):
        pieces = {t[i : i + w] for i in range(len(t) - w + 1)} if t else ()
        return np.fromiter((int.from_bytes(hashlib.blake2b(p.encode(), digest_size=8).digest(), "little", signed=True) for p in pieces), dtype="i8", count=len(pieces))

    return s.map(keys)


@F.pandas_udf(S.LongType())
def shingle_count(s: pd.Series) -> pd.Series:
    """How many distinct pieces of SHINGLE characters a text has; they stand in memory for one text at a time."""
    w = C.SHINGLE
    return s.map(lambda t: len({t[i : i + w] for i in range(len(t) - w + 1)}) if t else 0)


def jaccard(a: Column, b: Column) -> Column:
    both = F.size(F.array_intersect(a, b))
    return both / F.nullif(F.size(a) + F.size(b) - both, F.lit(0))


def strip_tags(html: Column) -> Column:
    """Lines of text of a page: scripts, styles and comments go, each tag ends a line, blank lines fall away."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)(?![a-z0-9_]).*?</\1\s*>|<!--.*?-->", "\n")
    lines = F.split(F.regexp_replace(bare, r"<[^>]+>", "\n"), "\n")
    return F.array_join(F.filter(F.transform(lines, lambda x: F.trim(x)), lambda x: x != ""), "\n")


def links(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit('href="([^"]+)"'), F.lit(1))


def file_name(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r'[\\/:*?"<>|\x00-\x1f]+', "_"))


def company_key(name: Column) -> Column:
    return F.lower(F.regexp_replace(nfc(name), UNICODE_SPACE, ""))


def label(text: Column, statute: bool = False) -> Column:
    """Readable node label: extension and number prefix go, underscores turn to middle dots, of statutes hyphens to spaces."""
    out = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, r"\.[A-Za-z0-9]+$", ""), r"^\d+_", ""), "_", " · ")
    return F.regexp_replace(out, "-", " ") if statute else out


@F.pandas_udf(S.StringType())
def decode_any(data: pd.Series) -> pd.Series:
    """UTF-8, else EUC-KR, else UTF-8 with replacement."""

    def one(b):
        if b is None:
            return None
        for encoding in ("utf-8", "euc-kr"):
            try:
                return bytes(b).decode(encoding)
            except UnicodeDecodeError:
                pass
        return bytes(b).decode("utf-8", "replace")

    return data.map(one)


@F.pandas_udf(S.DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([difflib.SequenceMatcher(None, x or "", y or "", autojunk=False).ratio() for x, y in zip(a, b, strict=True)])


_CJK_RUN = re.compile(f"[{CJK}]+")
_TOKEN = re.compile(rf"[A-Za-z_][A-Za-z0-9_]*|\d+|[{CJK}]+|[^\W\d_]+")


def features(text: str) -> Counter:
    """Tokens, 2- and 3-grams of CJK runs and pairs of neighbouring tokens, with their counts."""
    words = [t.lower() for t in _TOKEN.findall(unicodedata.normalize("NFC", text))]
    found = Counter(words)
    for w in words:
        if _CJK_RUN.fullmatch(w):
            found.update(w[i : i + n] for n in (2, 3) for i in range(len(w) - n + 1) if len(w) > n)
    found.update(f"{a}_{b}" for a, b in zip(words, words[1:]))
    return found


def hashed_vector(text: str, dim: int = C.EMBED_DIM) -> list[float]:
    """Signed feature hashing: a 64-bit digest gives place and sign, counts weigh 1 + ln, length one; zero without tokens."""
    out = [0.0] * dim
    for f, n in features(text).items():
        h = int.from_bytes(hashlib.blake2b(f.encode(), digest_size=8).digest(), "big")
        out[h % dim] += (-1.0 if h >> 63 else 1.0) * (1 + math.log(n))
    norm = math.sqrt(sum(x * x for x in out))
    return [x / norm for x in out] if norm else out


def hash_embed(dim: int = C.EMBED_DIM):
    @F.pandas_udf(S.ArrayType(S.FloatType()))
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: hashed_vector(x or "", dim))

    return run


@F.pandas_udf(S.MapType(S.StringType(), S.IntegerType()))
def feature_map(s: pd.Series) -> pd.Series:
    return s.map(lambda x: dict(features(x or "")))
