"""Text from office formats with the standard library; what cannot be read becomes a typed error, never an exception."""

from __future__ import annotations

import io
import re
import zipfile
from xml.etree import ElementTree as ET

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera import constants as C

OLE_MAGIC = b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1"


class ExtractionError(Exception):
    kind = "corrupt"


class Protected(ExtractionError):
    kind = "protected"


class Empty(ExtractionError):
    kind = "empty"


class Unavailable(ExtractionError):
    kind = "unavailable"


def tag(node: ET.Element) -> str:
    return node.tag.rsplit("}", 1)[-1]


def opened(data: bytes) -> zipfile.ZipFile:
    if data[:8] == OLE_MAGIC:
        raise Protected("an encrypted package")
    try:
        return zipfile.ZipFile(io.BytesIO(data))
    except zipfile.BadZipFile as e:
        raise ExtractionError("not a package") from e


def part(package: zipfile.ZipFile, name: str) -> ET.Element | None:
    try:
        return ET.fromstring(package.read(name))
    except KeyError:
        return None
    except ET.ParseError as e:
        raise ExtractionError(f"{name} is damaged") from e


def numbered(package: zipfile.ZipFile, prefix: str) -> list[str]:
    """Parts with a number behind the prefix, in the order of the numbers."""
    found = [(int(m.group(1)), n) for n in package.namelist() if (m := re.fullmatch(re.escape(prefix) + r"(\d+)\.xml", n))]
    return [n for _, n in sorted(found)]


def paragraphs(root: ET.Element) -> list[str]:
    """Texts of the paragraphs; one inside another counts once, with the outer one's text before it."""

    def own(node: ET.Element) -> str:
        out = []
        for child in node:
            name = tag(child)
            if name == "p":
                continue
            out.append((child.text or "") if name == "t" else "\t" if name == "tab" else "\n" if name in ("br", "cr", "lineBreak") else own(child))
        return "".join(out)

    return [text for p in root.iter() if tag(p) == "p" and (text := own(p)).strip()]


def docx(data: bytes) -> str:
    with opened(data) as package:
        roots = [part(package, f"word/{n}.xml") for n in ("document", "footnotes", "endnotes")]
    if roots[0] is None:
        raise ExtractionError("no document part")
    return "\n".join(t for r in roots if r is not None for t in paragraphs(r))


def hwpx(data: bytes) -> str:
    with opened(data) as package:
        names = numbered(package, "Contents/section")
        if not names:
            raise ExtractionError("no section part")
        return "\n".join(t for n in names for t in paragraphs(part(package, n)))


def pptx(data: bytes) -> str:
    with opened(data) as package:
        names = numbered(package, "ppt/slides/slide")
        if not names:
            raise ExtractionError("no slide part")
        out = []
        for n in names:
            number = re.search(r"(\d+)\.xml", n).group(1)
            out += [f"# 슬라이드 {number}", *paragraphs(part(package, n))]
            rels = part(package, f"ppt/slides/_rels/slide{number}.xml.rels")
            for rel in rels if rels is not None else ():
                target = rel.get("Target", "")
                notes = part(package, "ppt/" + target.removeprefix("../")) if "notesSlide" in target else None
                out += paragraphs(notes) if notes is not None else []
    return "\n".join(out)


def xlsx(data: bytes) -> str:
    with opened(data) as package:
        book, rels = part(package, "xl/workbook.xml"), part(package, "xl/_rels/workbook.xml.rels")
        if book is None or rels is None:
            raise ExtractionError("no workbook part")
        shared_root = part(package, "xl/sharedStrings.xml")
        shared = ["".join(t.text or "" for t in item.iter() if tag(t) == "t") for item in shared_root if tag(item) == "si"] if shared_root is not None else []
        target = {r.get("Id"): r.get("Target", "") for r in rels}

        def cell(c: ET.Element) -> str:
            kind = c.get("t")
            if kind == "inlineStr":
                return "".join(t.text or "" for t in c.iter() if tag(t) == "t")
            value = next((v.text or "" for v in c if tag(v) == "v"), "")
            return shared[int(value)] if kind == "s" and value else {"1": "TRUE", "0": "FALSE"}.get(value, value) if kind == "b" else value

        out = []
        for sheet in (s for s in book.iter() if tag(s) == "sheet"):
            rel = next((v for k, v in sheet.attrib.items() if k.endswith("}id")), "")
            path = target.get(rel, "")
            root = part(package, path.lstrip("/") if path.startswith("/") else f"xl/{path}")
            rows = ["\t".join(cell(c) for c in row if tag(c) == "c").rstrip() for row in root.iter() if tag(row) == "row"] if root is not None else []
            if any(r.strip() for r in rows):
                out += [f"# 시트: {sheet.get('name', '')}", *(r for r in rows if r.strip())]
    return "\n".join(out)


def missing_reader(name: str):
    def read(data: bytes) -> str:
        if name in ("hwp", "doc", "xls", "ppt") and data[:8] != OLE_MAGIC:
            raise ExtractionError(f"no {name} file")
        if name == "pdf" and not data.startswith(b"%PDF"):
            raise ExtractionError("no pdf file")
        raise Unavailable(f"no reader for {name} is installed")

    return read


def decoded(data: bytes) -> str:
    return data.decode("utf-8", "replace").replace("\r\n", "\n").replace("\r", "\n")


READERS = {"docx": docx, "hwpx": hwpx, "pptx": pptx, "xlsx": xlsx, **{n: missing_reader(n) for n in ("hwp", "doc", "xls", "ppt", "pdf")}, **dict.fromkeys(("md", "txt", "rst", "py"), decoded)}


def problem(text: str) -> str | None:
    """Why an extracted text is unusable: blank, too many replacement characters, stray control characters."""
    if not text.strip():
        return "empty"
    if text.count("�") > C.REPLACEMENT_RATIO * len(text) or re.search(r"[\x00-\x08\x0e-\x1f]", text):
        return "corrupt"
    return None


def problem_column(text: Column) -> Column:
    """The same rule as a Column, for texts that are in a table already."""
    bad = F.length(text) - F.length(F.replace(text, F.lit("�"), F.lit("")))
    return F.when(F.length(F.regexp_replace(text, r"(?U)\s", "")) == 0, "empty").when((bad > C.REPLACEMENT_RATIO * F.length(text)) | F.rlike(text, F.lit(r"[\x00-\x08\x0e-\x1f]")), "corrupt")


def extract(rel_path: str, data: bytes) -> tuple[str | None, str | None]:
    """(text, error kind): one of them is null."""
    reader = READERS.get(rel_path.rsplit(".", 1)[-1].lower())
    try:
        if reader is None:
            raise Unavailable("unknown format")
        text = reader(data)
    except ExtractionError as e:
        return None, e.kind
    except Exception:  # a damaged file may break any reader
        return None, "corrupt"
    wrong = problem(text)
    return (None, wrong) if wrong else (text, None)


def extracted(files: DataFrame) -> DataFrame:
    """rel_path, text, error of binary files (rel_path, content); equal contents in one task are read once."""

    def run(batches):
        memo: dict[tuple[str, bytes], tuple] = {}
        for batch in batches:
            paths = batch.column("rel_path").to_pylist()
            rows = []
            for p, d in zip(paths, batch.column("content").to_pylist(), strict=True):
                key = (p.rsplit(".", 1)[-1].lower(), d or b"")
                if key not in memo:
                    if len(memo) > 64:
                        memo.clear()
                    memo[key] = extract(p, d or b"")
                rows.append(memo[key])
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array([t for t, _ in rows], pa.string()), pa.array([e for _, e in rows], pa.string())], names=["rel_path", "text", "error"])

    return files.select("rel_path", "content").mapInArrow(run, "rel_path string, text string, error string")
