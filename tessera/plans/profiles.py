"""Document-type profiles: data that tells how to recognise a type, cut it and read edges from it."""

from __future__ import annotations

import re
import time
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Marker:
    pattern: str  # multi-line
    zone: str = ""  # the zone it opens, which prefixes the headings after it; without one the match is a heading
    once: bool = False  # only its first match counts


@dataclass(frozen=True)
class Edge:
    pattern: str  # with named groups
    relation: str
    target: str  # a format over the groups
    source: str = "{doc}"
    target_kind: str = "document"


@dataclass(frozen=True)
class Profile:
    name: str
    require: tuple[str, ...]
    reject: tuple[str, ...] = ()
    markers: tuple[Marker, ...] = ()
    edges: tuple[Edge, ...] = field(default=())


#: The structure words of Korean bills and statutes, often set with spaces between their syllables.
BILL_NUMBER = r"의\s*안[\s\r\n]*번\s*호"
PROPOSAL = r"^[ \t]*제?\s*안\s*이\s*유"
ORDER = r"^[ \t]*주\s*문[\s\r]*$"
CLAIM = r"^[ \t]*청\s*구\s*취\s*지"
PARTIES = r"[「\"']?갑[」\"']?\s*과\s*[「\"']?을[」\"']?"
MARKDOWN = r"^#{1,6}\s"
SUPPLEMENT = r"^[ \t]*부\s*칙[ \t]*(?:\([^)\r\n]{0,40}\))?[ \t\r]*$"
PART, CHAPTER = (rf"^[ \t]*제\s*\d+\s*{x}\s*[^\r\n]{{1,60}}[ \t\r]*$" for x in "편장")
ARTICLE = r"^[ \t]*제\s*\d+\s*조(?:\s*의\s*\d+)?\s*\([^)\r\n]{1,80}\)"
NUMBERED_ARTICLE = r"^[ \t]*제\s*\d+(?:\s*-\s*\d+)?\s*조(?:\s*의\s*\d+)?\s*\([^)\r\n]{1,80}\)"
LAW = r"「(?P<law>[^」\r\n]{2,60}?법(?:률)?)\s*」"

BILL = Profile(
    "bill",
    require=(BILL_NUMBER, PROPOSAL),
    reject=(ORDER, CLAIM, PARTIES),
    markers=(
        Marker(PROPOSAL + r"[ \t\r]*$", "제안이유", once=True),
        Marker(r"^[ \t]*주\s*요\s*내\s*용[ \t\r]*$", "주요내용", once=True),
        Marker(r"^[ \t]*(?:제\s*1\s*편|제\s*1\s*장|제\s*1\s*조\s*\()", "본칙", once=True),
        Marker(SUPPLEMENT, "부칙"),
        Marker(r"^[ \t]*신\s*[·․.]?\s*구\s*조?\s*문?\s*대\s*비\s*표", "신구조문대비표", once=True),
        Marker(r"^[ \t]*비\s*용\s*추\s*계\s*서", "비용추계서", once=True),
        Marker(ARTICLE),
        Marker(CHAPTER),
    ),
    edges=(
        Edge(LAW + r"\s*일부를?\s*개정", "amends", "{law}", target_kind="statute"),
        Edge(LAW + r"\s*에\s*따[른라]", "references", "{law}", target_kind="statute"),
    ),
)
STATUTE = Profile(
    "statute",
    require=(NUMBERED_ARTICLE,),
    reject=(BILL_NUMBER, PROPOSAL, ORDER, PARTIES, MARKDOWN),
    markers=(Marker(SUPPLEMENT, "부칙"), Marker(PART), Marker(CHAPTER), Marker(NUMBERED_ARTICLE)),
    # only the clause of purpose names the enabling law: other laws in the text are citations
    edges=(Edge(r"이\s*(?:영|규정|세칙|규칙)\s*은[^\r\n]{0,12}?" + LAW + r"[^\r\n]{0,240}?에서[^\r\n]{0,45}?위임(?:된|한|하는)", "delegates_to", "{law}", target_kind="statute"),),
)
PROFILES = (BILL, STATUTE)


def classify(rel_path: str, text: str, profiles: tuple[Profile, ...] = PROFILES, head: int = 8000) -> Profile | None:
    """The first profile of which all required patterns and no rejected one occur in path and head of the text."""
    seen = f"{rel_path}\n{text[:head]}"
    has = lambda p: re.search(p, seen, re.MULTILINE) is not None
    return next((p for p in profiles if all(map(has, p.require)) and not any(map(has, p.reject))), None)


def headings(profile: Profile, text: str) -> list[tuple[int, str]]:
    """(offset, heading) of a text's sections; headings carry the zone they stand in, and a zone wins where two begin."""
    found: dict[int, tuple[str, bool]] = {}
    for marker in sorted(profile.markers, key=lambda m: not m.zone):
        for m in re.finditer(marker.pattern, text, re.MULTILINE):
            found.setdefault(m.start(), (marker.zone or m.group().strip(), bool(marker.zone)))
            if marker.once:
                break
    out, zone = [], ""
    for at in sorted(found):
        label, is_zone = found[at]
        zone = label if is_zone else zone
        out.append((at, label if is_zone or not zone else f"{zone} · {label}"))
    return out


def profile_edges(profile: Profile, doc: str, text: str, most: int = 280) -> list[dict]:
    """Edges that the profile's patterns state, each with the words it was read from."""
    out = {}
    for edge in profile.edges:
        for m in re.finditer(edge.pattern, text, re.MULTILINE):
            groups = {"doc": doc, **{k: " ".join((v or "").split()) for k, v in m.groupdict().items()}}
            row = {"source": edge.source.format(**groups), "relation": edge.relation, "target": edge.target.format(**groups), "target_kind": edge.target_kind, "evidence": m.group()[:most]}
            out.setdefault((row["source"], row["relation"], row["target"]), row)
    return list(out.values())


def gate(profile: Profile, rel_path: str, text: str, profiles: tuple[Profile, ...] = PROFILES, least_recall: float = 0.95, most_share: float = 0.5, most_seconds: float = 5.0) -> dict[str, bool]:
    """Whether a profile is fit for a sample: nothing but data, recognised by it alone, nearly all marker lines found, no
    section swallows the text, edges are verbatim, line ends make no difference, and it is quick."""
    began = time.perf_counter()
    found, read = headings(profile, text), profile_edges(profile, "doc", text)
    took = time.perf_counter() - began
    plain = [*profile.require, *profile.reject, *(v for x in (*profile.markers, *profile.edges) for v in vars(x).values())]
    lines = sum(any(re.match(m.pattern, line) for m in profile.markers) for line in text.split("\n"))
    spans = [b - a for (a, _), (b, _) in zip(found, [*found[1:], (len(text), "")], strict=True)]
    unix = text.replace("\r\n", "\n")
    return {
        "pure": all(isinstance(v, (str, bool)) for v in plain),
        "quick": took <= most_seconds,
        "claimed": classify(rel_path, text, profiles) is profile,
        "exclusive": sum(classify(rel_path, text, (p,)) is p for p in profiles) == 1,
        "recall": len(found) >= least_recall * lines,
        "balanced": bool(spans) and max(spans) <= most_share * len(text),
        "verbatim": all(e["evidence"] in text for e in read),
        "line_ends": [h for _, h in headings(profile, unix)] == [h for _, h in headings(profile, unix.replace("\n", "\r\n").replace("\r\n", "\n"))],
    }


def triage(samples: list[tuple[str, str]], profiles: tuple[Profile, ...] = PROFILES) -> dict[str, int]:
    """How many of (rel_path, text) each profile claims; those that none does stand under an empty name."""
    out: dict[str, int] = {}
    for path, text in samples:
        claimed = classify(path, text, profiles)
        name = claimed.name if claimed else ""
        out[name] = out.get(name, 0) + 1
    return out
