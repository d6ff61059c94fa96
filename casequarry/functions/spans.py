"""The facts section of a brief by its headings (method ``rules_v2``).

Headings are found and classified in reading order, sections between them are merged
where they are fact-like, and the span is checked by length and content.  The steps
depend on each other's positions in one text, so they run as one Arrow UDF that returns
a struct; ``sections`` exposes the heading map for analysis with window functions.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructType

from casequarry.functions.text import prepare

# Headings that open a facts section, most specific first.
START = (
    "STATEMENT OF FACTS AND PROCEDURAL HISTORY",
    "STATEMENT OF THE CASE AND FACTS",
    "FACTUAL AND PROCEDURAL BACKGROUND",
    "FACTUAL AND PROCEDURAL HISTORY",
    "FACTS AND PROCEDURAL HISTORY",
    "COUNTER-STATEMENT OF FACTS",
    "COUNTER-STATEMENT OF THE CASE",
    "STATEMENT OF RELEVANT FACTS",
    "STATEMENT OF MATERIAL FACTS",
    "STATEMENT OF THE PROCEEDINGS",
    "RELEVANT FACTUAL BACKGROUND",
    "NATURE OF THE PROCEEDINGS",
    "COURSE OF PROCEEDINGS",
    "STATEMENT OF THE FACTS",
    "STATEMENT OF THE CASE",
    "PRELIMINARY STATEMENT",
    "PROCEDURAL BACKGROUND",
    "FACTUAL BACKGROUND",
    "PROCEDURAL HISTORY",
    "PROCEDURAL POSTURE",
    "STATEMENT OF FACTS",
    "NATURE OF THE CASE",
    "RELEVANT FACTS",
    "BACKGROUND",
)
# Fixed value: a heading that opens facts in some types of documents only.
INTRODUCTION = "INTRODUCTION"
# Headings that end it.
STOP = (
    "SUMMARY OF THE ARGUMENT",
    "SUMMARY OF ARGUMENT",
    "STANDARDS OF REVIEW",
    "STANDARD OF REVIEW",
    "STATEMENT OF THE ISSUES",
    "QUESTIONS PRESENTED",
    "REASONS FOR GRANTING",
    "RELIEF REQUESTED",
    "PRAYER FOR RELIEF",
    "ISSUES PRESENTED",
    "LEGAL FRAMEWORK",
    "LEGAL ANALYSIS",
    "LEGAL STANDARD",
    "ARGUMENTS",
    "ARGUMENT",
    "DISCUSSION",
    "ANALYSIS",
    "CONCLUSION",
)
# Those of START that open the procedural history.
PROCEDURAL = frozenset(
    (
        "PROCEDURAL HISTORY",
        "PROCEDURAL BACKGROUND",
        "PROCEDURAL POSTURE",
        "COURSE OF PROCEEDINGS",
        "STATEMENT OF THE PROCEEDINGS",
        "FACTS AND PROCEDURAL HISTORY",
        "FACTUAL AND PROCEDURAL HISTORY",
        "FACTUAL AND PROCEDURAL BACKGROUND",
        "STATEMENT OF FACTS AND PROCEDURAL HISTORY",
    )
)
# Words that make an all-capitals line a heading.
SOFT_START = r"\bFACT(?:S|UAL)\b|\bBACKGROUND\b|\bSTATEMENT\b|\bPROCEDURAL\b|\bPRELIMINARY\b|\bNATURE\s+OF\b"
SOFT_STOP = r"\bARGUMENT\b|\bDISCUSSION\b|\bSTANDARD\s+OF\s+REVIEW\b|\bLEGAL\s+STANDARD\b|\bCONCLUSION\b|\bRELIEF\b|\bANALYSIS\b"
NOT_HEADING = (
    "TABLE OF CONTENTS",
    "TABLE OF AUTHORITIES",
    "TABLE OF CITATIONS",
    "JURISDICTION",
    "CERTIFICATE",
    "SERVICE",
    "COMPLIANCE",
    "CORPORATE DISCLOSURE",
    "CASE ",
    "DOCUMENT ",
    "FILED ",
    "PAGE ",
)
# Marks of a table of contents.
CONTENTS = ("TABLE OF CONTENTS", "TABLE OF AUTHORITIES", "TABLE OF CITATIONS")
#: Document types whose INTRODUCTION states facts.
FACTUAL_INTRODUCTION = frozenset(("STATE_APPELLATE", "CERT_PETITION", "MERITS_SCOTUS", "DISTRICT_COURT"))
MOST_MERGED, CONTENTS_REACH = 6, 15000
RULES_VERSION = "rules_v2"

# The forms of a heading line, of an entry of a table of contents and of argument.
_PREFIX = r"(?:[IVXLC]+\.)?\s*(?:\d+\.?)?\s*"
_EXACT = re.compile(
    rf"(?m)^\s*{_PREFIX}({'|'.join(map(re.escape, (*START, INTRODUCTION, *STOP)))})\s*[:.\-–—]?\s*(?:\.{{2,}}\s*\d{{1,4}})?\s*(?:\s+\d{{1,4}})?\s*$"
)
_CAPITALS = re.compile(r"(?m)^\s*(?:[IVXLC]+\.)?\s*(?:\d+\.)?\s*([A-Z][A-Z0-9 \-–—/&,:]{2,90})\s*$")
_ARGUMENT = re.compile(r"(?m)^\s*(?:[IVXLC]+\.?)?\s*(?:\d+\.?)?\s*ARGUMENT\s*[:.\-–—]?\s*$")
_AUTHORITIES = re.compile(r"(?m)^\s*TABLE OF AUTHORITIES\s*$")
_LEADERS = re.compile(r"\.{2,}\s*\d{1,4}\s*$")
_PAGE = re.compile(r"\s+\d{1,4}\s*$")
_LABEL_TRIMS = tuple(map(re.compile, (rf"^\s*{_PREFIX}", r"\s*[:.\-–—]?\s*$", r"\.{2,}\s*\d{1,4}\s*$", r"\s+\d{1,4}\s*$")))
CITE = r"\b\d{1,4}\s+[A-Z][A-Za-z\.\s]{0,20}\s+\d{1,5}\b"
ARGUES = r"\b(we\s+argue|this\s+court\s+should|standard\s+of\s+review|for\s+these\s+reasons)\b"
_CITE, _ARGUES = re.compile(CITE), re.compile(ARGUES, re.I)
_SOFT = ((re.compile(SOFT_START), "start"), (re.compile(SOFT_STOP), "stop"))


@dataclass(frozen=True)
class Heading:
    start: int
    end: int
    text: str
    kind: str
    confidence: float
    method: str

    @property
    def role(self) -> str:
        label = self.text.upper()
        if self.kind == "start":
            return "procedural_history" if label in PROCEDURAL else "facts"
        for words, role in ((("ARGUMENT",), "argument"), (("STANDARD", "REVIEW"), "standard_of_review"), (("CONCLUSION", "RELIEF"), "conclusion")):
            if any(w in label for w in words):
                return role
        return "other_stop"


def classify(label: str, doc_type: str) -> tuple[str, float, str]:
    """Kind, confidence and method of a heading's text."""
    up = label.upper().strip()
    for form in (up, up.rstrip(":.–—- ")):
        if form in START:
            return "start", 1.0, "exact"
        if form == INTRODUCTION:
            return ("start", 0.8, "exact") if doc_type in FACTUAL_INTRODUCTION else ("other", 0.0, "exact")
        if form in STOP:
            return "stop", 1.0, "exact"
    for pattern, kind in _SOFT:
        if pattern.search(up):
            return kind, 0.7, "soft"
    return "other", 0.0, "none"


def _in_contents(upper: str, start: int) -> bool:
    """Does a match look like an entry of a table of contents?"""
    before = upper[max(0, start - CONTENTS_REACH) : start]
    if not any(mark in before for mark in CONTENTS):
        return False
    end = upper.find("\n", start)
    line = upper[upper.rfind("\n", 0, start) + 1 : len(upper) if end < 0 else end].strip()
    return bool(_LEADERS.search(line)) or (len(line) >= 20 and bool(_PAGE.search(line)))


def _own_line(text: str, match: re.Match) -> tuple[int, int]:
    """Where a heading's own line begins and ends: blank lines and lines of numbers around it, which its form takes in, are the text's."""
    first, last = match.span(1)
    end = text.find("\n", last, match.end())
    return max(match.start(), text.rfind("\n", 0, first) + 1), match.end() if end < 0 else end


def headings(text: str, doc_type: str = "UNKNOWN") -> tuple[list[Heading], str | None]:
    """The heading map in order, and how an INTRODUCTION was read (None if there is none)."""
    upper = text.upper()
    introduction: str | None = None
    found: list[Heading] = []

    def add(place: tuple[int, int], label: str) -> None:
        nonlocal introduction
        kind, confidence, method = classify(label, doc_type)
        if label.upper() == INTRODUCTION:
            introduction = "factual" if kind == "start" else "argumentative"
        if kind != "other":
            found.append(Heading(*place, label, kind, confidence, method))

    for m in _EXACT.finditer(upper):
        if not _in_contents(upper, m.start()):
            label = m[0].strip()
            for trim in _LABEL_TRIMS:
                label = trim.sub("", label).strip()
            add(_own_line(upper, m), label)
    taken = [h.start for h in found]
    for m in _CAPITALS.finditer(text):
        title, place = m[1].strip(), _own_line(text, m)
        unfit = any(part in title for part in NOT_HEADING) or any(abs(place[0] - s) < 5 for s in taken)
        if not unfit and not _in_contents(upper, m.start()):
            add(place, title)
    kept: list[Heading] = []
    for h in sorted(found, key=lambda x: x.start):
        if kept and h.start - kept[-1].start < 10:
            if h.confidence > kept[-1].confidence:
                kept[-1] = h
        else:
            kept.append(h)
    return kept, introduction


def fact_group(roles: list[str], confidences: list[float], most: int = MOST_MERGED) -> tuple[list[int], list[str]]:
    """Indices of the run of fact-like sections with the greatest summed confidence, and notes."""
    runs: list[list[int]] = [[]]
    for i, role in enumerate(roles):
        if role in ("facts", "procedural_history"):
            runs[-1].append(i)
        elif runs[-1]:
            runs.append([])
    best = max(runs, key=lambda run: sum(confidences[i] for i in run))
    notes = ["merge_limit_warning"] if len(best) > most else []
    best = best[:most]
    return best, [*notes, *([f"merged_{len(best)}_sections"] if len(best) > 1 else [])]


def _trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    body = text[start:end]
    return start + len(body) - len(body.lstrip(" \n\t")), start + len(body.rstrip(" \n\t")) if body.strip(" \n\t") else start + len(body)


def gates(text: str) -> dict[str, float]:
    per = max(len(text), 1) / 10_000.0
    cites, argues = len(_CITE.findall(text)), len(_ARGUES.findall(text))
    return {
        "cite_hits": float(cites),
        "arg_marker_hits": float(argues),
        "cite_hits_per_10k_chars": cites / per,
        "arg_hits_per_10k_chars": argues / per,
        "alpha_ratio": sum(map(str.isalpha, text)) / len(text) if text else 0.0,
        "toc_line_count": float(sum(bool(_LEADERS.search(line.strip())) for line in text.splitlines())),
    }


@dataclass
class Checked:
    end: int | None
    confidence: str
    notes: list[str] = field(default_factory=list)
    gates: dict[str, float] = field(default_factory=dict)


def check(text: str, start: int, end: int, base: float) -> Checked:
    """Length limits and content gates of a span; end is None if the span is too short."""
    least = 400 if base >= 1.0 else 300 if base >= 0.7 else 800
    if end - start < least:
        return Checked(None, "low", ["span_too_short"])
    whole, notes = len(text), []
    most = min(int(0.60 * whole), 50_000)
    if end - start > most > 0:
        notes.append("guardrail_truncated")
        pause = text.rfind("\n\n", start, start + most)
        end = pause if pause > start + least else start + most
    found = gates(text[start:end])
    alpha = found["alpha_ratio"]
    found["alpha_ratio"] = round(alpha, 3)
    argues = found["arg_hits_per_10k_chars"]
    rules = (  # note, does it apply, by how much it lowers confidence
        ("toc_contamination", found["toc_line_count"] > 5, 1),
        ("no_citations_in_facts", found["cite_hits"] == 0 and end - start > 2000, 0),
        ("excessive_citations", found["cite_hits_per_10k_chars"] > 80, 1),
        ("high_argument_contamination", argues > 15.0, 2),
        ("possible_argument_contamination", 5.0 < argues <= 15.0, 1),
        ("low_alpha_ratio", alpha < 0.50, 1),
        ("span_starts_very_early", whole > 0 and start < 0.05 * whole, 0),
        ("span_ends_very_late", whole > 0 and end > 0.95 * whole, 0),
    )
    notes += [note for note, applies, _ in rules if applies]
    lowered = any(applies and by for _, applies, by in rules)
    if base >= 1.0:
        confidence = "medium" if lowered else "high"
    else:
        confidence = "medium" if base >= 0.7 and not lowered else "low"
    return Checked(end, confidence, notes, found)


def _before_argument(text: str) -> tuple[int, int] | None:
    """What stands before the ARGUMENT heading, after any table of authorities."""
    upper = text.upper()
    argument = _ARGUMENT.search(upper)
    if not argument:
        return None
    start, table = 0, _AUTHORITIES.search(upper)
    if table and table.start() < argument.start():
        after = (m for m in _CAPITALS.finditer(upper) if m.start() > table.end() and not any(p in m[1].strip() for p in NOT_HEADING))
        following = next(after, None)
        start = following.end() if following else table.end()
    start, end = _trimmed(text, start, argument.start())
    return (start, end) if end - start >= 800 else None


def find(clean: str, doc_type: str = "UNKNOWN", most_merged: int = MOST_MERGED) -> dict:
    """The facts span of a normalised text, as offsets into the prepared text."""
    text = prepare(clean)
    heads, introduction = headings(text, doc_type)
    chosen, notes = fact_group([h.role for h in heads], [h.confidence for h in heads], most_merged)
    out = {
        "start": None,
        "end": None,
        "confidence": "low",
        "match_method": "none",
        "notes": notes,
        "sections_merged": len(chosen),
        "heading_map_size": len(heads),
        "start_heading": None,
        "stop_heading": None,
        "introduction": introduction,
        "gates": {},
        "text": None,
        "prepared_chars": len(text),
    }

    def take(start: int, end: int, base: float, method: str) -> bool:
        result = check(text, start, end, base)
        out["match_method"], out["confidence"], out["gates"] = method, result.confidence, result.gates
        out["notes"] = out["notes"] + result.notes
        if result.end is not None:
            out["start"], out["end"], out["text"] = start, result.end, text[start : result.end]
        return result.end is not None

    if chosen:
        last = chosen[-1]
        close = heads[last + 1].start if last + 1 < len(heads) else len(text)
        base = max(heads[i].confidence for i in chosen)
        out["start_heading"] = heads[chosen[0]].text
        out["stop_heading"] = next((h.text for h in heads if h.kind == "stop" and h.start >= close - 5), None)
        if take(*_trimmed(text, heads[chosen[0]].end, close), base, "exact" if base >= 1.0 else "soft"):
            return out
    out["notes"] = [*out["notes"], "no_exact_heading"]
    fallback = _before_argument(text)
    if fallback:
        out["notes"].append("fallback_pre_argument")
        if take(*fallback, 0.5, "fallback"):
            return out
    out["notes"] = [*out["notes"], "no_span_found"]
    return out


_GATES = ("cite_hits", "arg_marker_hits", "cite_hits_per_10k_chars", "arg_hits_per_10k_chars", "alpha_ratio", "toc_line_count")
_STRUCT = pa.struct(
    [
        ("start", pa.int32()),
        ("end", pa.int32()),
        ("confidence", pa.string()),
        ("match_method", pa.string()),
        ("notes", pa.list_(pa.string())),
        ("sections_merged", pa.int32()),
        ("heading_map_size", pa.int32()),
        ("start_heading", pa.string()),
        ("stop_heading", pa.string()),
        ("introduction", pa.string()),
        ("gates", pa.struct([(g, pa.float64()) for g in _GATES])),
        ("text", pa.string()),
        ("prepared_chars", pa.int32()),
    ]
)


def _span_type() -> StructType:
    inner = StructType()
    for g in _GATES:
        inner = inner.add(g, DoubleType())
    out = StructType().add("start", IntegerType()).add("end", IntegerType()).add("confidence", StringType()).add("match_method", StringType())
    out = out.add("notes", ArrayType(StringType())).add("sections_merged", IntegerType()).add("heading_map_size", IntegerType())
    out = out.add("start_heading", StringType()).add("stop_heading", StringType()).add("introduction", StringType())
    return out.add("gates", inner).add("text", StringType()).add("prepared_chars", IntegerType())


SPAN = _span_type()


@F.arrow_udf(SPAN)
def facts_span(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """Struct column from (normalised text, document type)."""
    for texts, types in batches:
        yield pa.array([find(t or "", d or "UNKNOWN") for t, d in zip(texts.to_pylist(), types.to_pylist(), strict=True)], _STRUCT)


_HEADING = pa.list_(
    pa.struct([("start", pa.int32()), ("end", pa.int32()), ("text", pa.string()), ("kind", pa.string()), ("confidence", pa.float64()), ("method", pa.string()), ("role", pa.string())])
)
HEADING = (
    StructType().add("start", IntegerType()).add("end", IntegerType()).add("text", StringType()).add("kind", StringType()).add("confidence", DoubleType()).add("method", StringType()).add("role", StringType())
)


@F.arrow_udf(ArrayType(HEADING))
def heading_map(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """Headings of (prepared text, document type)."""
    for texts, types in batches:
        out = []
        for t, d in zip(texts.to_pylist(), types.to_pylist(), strict=True):
            out.append([vars(h) | {"role": h.role} for h in headings(t or "", d or "UNKNOWN")[0]])
        yield pa.array(out, _HEADING)


@F.arrow_udf(ArrayType(StringType()))
def heading_candidates(column: pa.Array) -> pa.Array:
    """Lines in capitals of a normalised text that could be headings, in order; callers slice what they show."""
    return pa.array([candidates(t or "") for t in column.to_pylist()], pa.list_(pa.string()))


def candidates(text: str) -> list[str]:
    titles = (m[1].strip() for m in _CAPITALS.finditer(text.upper()))
    return [t for t in titles if not any(part in t for part in NOT_HEADING)]


def sections(rows: DataFrame, text_col: str = "text", type_col: str = "doc_type_id", id_col: str = "doc_id") -> DataFrame:
    """A row for each section of a prepared text: from its heading's end to the next heading, or the text's end.

    Columns: the id, nth (from 1), heading, role, confidence, start, end.  Texts without headings have none.
    """
    heads = heading_map(F.col(text_col), F.col(type_col))
    found = rows.select(F.col(id_col), F.length(text_col).alias("size"), F.posexplode(heads).alias("nth", "h"))
    following = F.lead("h.start").over(W.partitionBy(id_col).orderBy("nth"))
    return found.select(
        id_col,
        (F.col("nth") + 1).alias("nth"),
        F.col("h.text").alias("heading"),
        F.col("h.role").alias("role"),
        F.col("h.confidence").alias("confidence"),
        F.col("h.end").alias("start"),
        F.coalesce(following, F.col("size")).alias("end"),
    )


def quality_flags(text: Column) -> Column:
    """Citation and argument-marker counts and their densities per 10,000 characters."""
    text = F.coalesce(text, F.lit(""))
    per = F.greatest(F.length(text), F.lit(1)) / 10_000.0
    cites, argues = F.regexp_count(text, F.lit("(?U)" + CITE)), F.regexp_count(text, F.lit("(?iU)" + ARGUES))
    return F.struct(
        cites.alias("cite_hits"),
        argues.alias("arg_marker_hits"),
        (cites / per).alias("cite_hits_per_10k_chars"),
        (argues / per).alias("arg_hits_per_10k_chars"),
    )


def introduction_is_factual(doc_type: Column) -> Column:
    return doc_type.isin(sorted(FACTUAL_INTRODUCTION))

