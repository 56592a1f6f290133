"""From a document's text to its chunks and relations: pure functions of (rel_path, text), run in Arrow batches.

Windowing depends on where the window before ended, so it cannot be a join; everything around it stays a DataFrame plan.
"""

from __future__ import annotations

import ast
import hashlib
import re
import unicodedata

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera import constants as C
from tessera.functions.batches import pieces
from tessera.functions.text import BINARY
from tessera.plans import profiles as P

#: Fixed: front-matter keys that state relations, with the relation they state.
FRONT_RELATIONS = {"depends_on": "depends_on", "requires": "depends_on", "supersedes": "supersedes", "related": "related_to", "related_to": "related_to", "references": "references"}
_HEADING = re.compile(r"^(#{1,6})\s+(.+?)\s*#*\s*$", re.MULTILINE)
_ARTICLE = re.compile(r"^[ \t]*(제\d+조(?:의\d+)?\s*\([^)\n]+\)|부\s*칙\b.*|\[?별표\s*\d*\]?.*)", re.MULTILINE)
_FENCE = re.compile(r"^---[ \t]*$", re.MULTILINE)


def front_matter(text: str) -> tuple[dict[str, list[str]], str, int]:
    """(fields, body, offset of the body): a flat block of scalars, [a, b] lists and dash lists between two fences."""
    if not text.startswith("---"):
        return {}, text, 0
    fences = list(_FENCE.finditer(text))
    if len(fences) < 2 or fences[0].start():
        return {}, text, 0
    fields: dict[str, list[str]] = {}
    key = ""
    clean = lambda s: s.strip().strip("'\"")
    for line in text[fences[0].end() : fences[1].start()].split("\n"):
        if not line.strip() or line.lstrip().startswith("#"):
            continue
        if line.lstrip().startswith("- ") and key:
            fields[key].append(clean(line.lstrip()[2:]))
        elif ":" in line:
            key, _, value = (s.strip() for s in line.partition(":"))
            inner = value[1:-1].split(",") if value.startswith("[") and value.endswith("]") else [value] if value else []
            fields[key] = [clean(v) for v in inner if v.strip()]
    offset = fences[1].end() + (1 if text[fences[1].end() : fences[1].end() + 1] == "\n" else 0)
    return fields, text[offset:], offset


def sections(body: str, marks: list[tuple[int, str]] | None = None) -> list[tuple[int, int, str]]:
    """(start, end, heading) spans of a body; what stands before the first heading is a span without one."""
    if marks is None:
        found = {m.start(): m.group(2) for m in _HEADING.finditer(body)}
        for m in _ARTICLE.finditer(body):
            found.setdefault(m.start(), m.group(1).strip())
        marks = sorted(found.items())
    edges = [0, *(at for at, _ in marks), len(body)]
    names = ["", *(h for _, h in marks)]
    return [(a, b, h) for a, b, h in zip(edges, edges[1:], names) if b > a]


def windows(text: str) -> list[tuple[int, int]]:
    """Overlapping spans of bounded length; a span ends at its last blank line, else line end, if enough text stays new."""
    out, at = [], 0
    while at < len(text):
        end = min(at + C.WINDOW, len(text))
        if end < len(text):
            for gap in ("\n\n", "\n"):
                cut = text.rfind(gap, at + C.MIN_CHUNK, end)
                if cut >= 0:
                    end = cut if cut - C.OVERLAP >= at + C.MIN_ADVANCE else end
                    break
        out.append((at, end))
        if end >= len(text):
            break
        at = max(end - C.OVERLAP, at + 1)
    return out


def _pieces(text: str, offset: int, heading: str, keep_short: bool) -> list[dict]:
    spans = windows(text)
    out = []
    for a, b in spans:
        part = text[a:b]
        body = part.strip()
        if not body or (len(body) < C.MIN_CHUNK and not (keep_short and len(spans) == 1)):
            continue
        start = offset + a + len(part) - len(part.lstrip())
        out.append({"heading": heading, "content": body, "char_start": start, "char_end": start + len(body)})
    return out


def chunk_text(body: str, offset: int = 0, marks: list[tuple[int, str]] | None = None) -> list[dict]:
    return [c for a, b, h in sections(body, marks) for c in _pieces(body[a:b], offset + a, h, True)]


def chunk_python(text: str) -> list[dict]:
    """Top-level definitions are sections, what lies between them belongs to the module; unparsable code is plain text."""
    try:
        tree = ast.parse(text)
    except (SyntaxError, ValueError):
        return chunk_text(text)
    starts = [0]
    for line in text.split("\n"):
        starts.append(starts[-1] + len(line) + 1)
    out, at = [], 0
    for node in tree.body:
        if isinstance(node, (ast.FunctionDef, ast.AsyncFunctionDef, ast.ClassDef)):
            first = min([node.lineno, *(d.lineno for d in node.decorator_list)])
            a, b = starts[first - 1], min(starts[node.end_lineno], len(text))
            out += _pieces(text[at:a], at, "module", False) + _pieces(text[a:b], a, node.name, False)
            at = b
    return out + _pieces(text[at:], at, "module", False)


def _norm(name: str) -> str:
    name = re.sub(r"\.(md|txt|rst|py)$", "", unicodedata.normalize("NFC", name.strip().strip("'\"")))
    return re.sub(r"[^\w]+", "-", name.lower()).strip("-")


def _relation(source: str, relation: str, target: str, kind: str, evidence: str) -> dict:
    return {"source": source, "relation": relation, "target": target, "target_kind": kind, "evidence": " ".join(evidence.split())[: C.EVIDENCE_MAX]}


def markdown_relations(doc: str, text: str) -> list[dict]:
    fields, body, _ = front_matter(text)
    found = [_relation(doc, FRONT_RELATIONS[k], _norm(v), "document", f"{k}: {v}") for k, values in fields.items() if k in FRONT_RELATIONS for v in values]
    for m in re.finditer(r"\[\[([^\]|#\n]+)[^\]\n]*\]\]|(?<!!)\[[^\]\n]*\]\(([^)#\s]+)[^)\n]*\)", body):
        target = m.group(1) or m.group(2)
        if "://" not in target:
            found.append(_relation(doc, "references", _norm(target.rsplit("/", 1)[-1]), "document", m.group()))
    found += [_relation(doc, "mentions", _norm(m.group(1)), "symbol", m.group()) for m in re.finditer(r"`([A-Za-z_][\w.]*)`", body)]
    return _distinct(found)


def python_relations(doc: str, text: str) -> list[dict]:
    try:
        tree = ast.parse(text)
    except (SyntaxError, ValueError):
        return []
    found = []
    for node in ast.walk(tree):
        line = text.split("\n")[node.lineno - 1] if hasattr(node, "lineno") else ""
        if isinstance(node, ast.Import):
            found += [_relation(doc, "imports", _norm(a.name), "module", line) for a in node.names]
        elif isinstance(node, ast.ImportFrom) and node.module:
            found.append(_relation(doc, "imports", _norm(node.module), "module", line))
            found += [_relation(doc, "uses", _norm(a.name), "symbol", line) for a in node.names if a.name != "*"]
    found += [_relation(doc, "defines", _norm(n.name), "symbol", f"{n.name}") for n in tree.body if isinstance(n, (ast.FunctionDef, ast.AsyncFunctionDef, ast.ClassDef))]
    return _distinct(found)


def _distinct(found: list[dict]) -> list[dict]:
    kept: dict[tuple, dict] = {}
    for r in found:
        if r["target"] and r["target"] != r["source"]:
            kept.setdefault((r["source"], r["relation"], r["target"]), r)
    return list(kept.values())


def parse_document(rel_path: str, doc_id: str, text: str) -> dict:
    """title, doc_type, chunks and relations of a text; binary formats and plain text may be claimed by a profile."""
    ext = rel_path.rsplit(".", 1)[-1].lower()
    text = text.replace("\r\n", "\n").replace("\r", "\n")
    profile = P.classify(rel_path, text, head=C.CLASSIFY_HEAD) if ext in (*BINARY, "txt") else None
    if ext == "py":
        return {"title": rel_path.rsplit("/", 1)[-1], "doc_type": "python", "chunks": chunk_python(text), "relations": python_relations(doc_id, text)}
    fields, body, offset = front_matter(text)
    marks = P.headings(profile, body) if profile else None
    relations = (P.profile_edges(profile, doc_id, body) if profile else []) + markdown_relations(doc_id, text)
    first = _HEADING.search(body)
    title = (fields.get("title") or [first.group(2) if first else rel_path.rsplit("/", 1)[-1]])[0]
    kind = profile.name if profile else "markdown" if ext in ("md", "txt", "rst") else ext
    return {"title": title, "doc_type": kind, "chunks": chunk_text(body, offset, marks), "relations": _distinct(relations)}


PARSED = (
    "doc_id string, rel_path string, title string, doc_type string, "
    "chunks array<struct<heading:string,content:string,char_start:bigint,char_end:bigint>>, "
    "relations array<struct<source:string,relation:string,target:string,target_kind:string,evidence:string>>"
)


def parsed_batches(batches, arrow: pa.Schema):
    """Documents of (doc_id, rel_path, content) parsed by pieces: a whole batch as Python rows takes many times its size."""
    for piece in (p for batch in batches for p in pieces(batch, "content")):
        rows = [{"doc_id": d, "rel_path": p, **parse_document(p or "", d or "", t or "")} for d, p, t in zip(*(piece.column(c).to_pylist() for c in ("doc_id", "rel_path", "content")), strict=True)]
        yield pa.RecordBatch.from_pylist(rows, schema=arrow)


def parsed(docs: DataFrame) -> DataFrame:
    """One row per document of (doc_id, rel_path, content) with its chunks and relations."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = docs.sparkSession.createDataFrame([], PARSED).schema
    arrow = to_arrow_schema(schema)
    return docs.select("doc_id", "rel_path", "content").mapInArrow(lambda batches: parsed_batches(batches, arrow), schema)


def chunk_rows(parsed_docs: DataFrame) -> DataFrame:
    """The chunks stream: dense index, estimate and hash of each chunk."""
    flat = parsed_docs.select("doc_id", "rel_path", "title", "doc_type", F.posexplode("chunks").alias("chunk_index", "c"))
    return flat.select(F.format_string("%s#%04d", "doc_id", "chunk_index").alias("chunk_id"), "doc_id", "rel_path", "title", "doc_type", F.col("chunk_index").cast("long"), "c.heading", "c.content", "c.char_start", "c.char_end", F.greatest(F.lit(1), F.floor(F.length("c.content") / C.CHARS_PER_TOKEN)).cast("long").alias("token_estimate"), F.sha2("c.content", 256).alias("content_sha256"))


def relation_rows(parsed_docs: DataFrame) -> DataFrame:
    """The relations stream."""
    flat = parsed_docs.select("doc_id", "rel_path", F.explode("relations").alias("r"))
    key = F.substring(F.sha2(F.concat_ws("|", "doc_id", "r.source", "r.relation", "r.target"), 256), 1, 24)
    return flat.select(key.alias("relation_id"), "doc_id", "rel_path", F.col("r.source").alias("source_entity"), F.lit("document").alias("source_kind"), F.col("r.relation").alias("relation"), F.col("r.target").alias("target_entity"), F.col("r.target_kind").alias("target_kind"), F.col("r.evidence").alias("evidence"))


def demote_headings(text: str, levels: int) -> str:
    """Headings moved down, at most to the sixth level; code fences stay as they are."""
    out, fenced = [], False
    for line in text.split("\n"):
        if line.lstrip().startswith(("```", "~~~")):
            fenced = not fenced
        m = None if fenced else re.match(r"(#{1,6})(\s.*)", line)
        out.append("#" * min(6, len(m.group(1)) + levels) + m.group(2) if m else line)
    return "\n".join(out)


def assemble(parts: list[tuple[str, int]], values: dict[str, str]) -> str:
    """Parts joined with their headings demoted and {{NAME}} filled in; a name without a value is an error."""
    text = "\n\n".join(demote_headings(p, n).strip() for p, n in parts) + "\n"
    for name, value in values.items():
        text = text.replace("{{" + name + "}}", value)
    left = sorted(set(re.findall(r"\{\{(\w+)\}\}", text)))
    if left:
        raise ValueError(f"no value for {', '.join(left)}")
    return text


def export_digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
