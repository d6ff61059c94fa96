"""Case citations: extraction, normal form, masking, summaries and leaks.

Offsets, case names and merged masks need matches in order, so extraction and masking
are Arrow UDFs over whole texts; everything after them is column expressions.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

# Reporters in the order in which they are tried, the two generic forms last.
REPORTERS = (
    r"U\.S\.",
    r"S\.\s*Ct\.",
    r"L\.\s*Ed\.\s*2d",
    r"L\.\s*Ed\.",
    r"F\.\s*Supp\.\s*\d[a-z]{1,2}",
    r"F\.\s*Supp\.",
    r"F\.\s*App'x",
    r"F\.\s*\d[a-z]{1,2}",
    r"F\.",
    r"B\.R\.",
    r"A\.\s*\d[a-z]{1,2}",
    r"A\.",
    r"N\.E\.\s*\d[a-z]{1,2}",
    r"N\.E\.",
    r"N\.W\.\s*\d[a-z]{1,2}",
    r"N\.W\.",
    r"P\.\s*\d[a-z]{1,2}",
    r"P\.",
    r"S\.E\.\s*\d[a-z]{1,2}",
    r"S\.E\.",
    r"S\.W\.\s*\d[a-z]{1,2}",
    r"S\.W\.",
    r"So\.\s*\d[a-z]{1,2}",
    r"So\.",
    r"Cal\.\s*Rptr\.\s*\d[a-z]{1,2}",
    r"Cal\.\s*Rptr\.",
    r"Cal\.\s*App\.\s*\d[a-z]{1,2}",
    r"Cal\.\s*App\.",
    r"N\.Y\.S\.\s*\d[a-z]{1,2}",
    r"N\.Y\.S\.",
    r"N\.Y\.\s*\d[a-z]{1,2}",
    r"N\.Y\.",
    r"Ill\.\s*\d[a-z]{1,2}",
    r"Ill\.",
    r"Bankr\.",
    r"[A-Z][A-Za-z]*\.\s*\d[a-z]{1,2}",
    r"[A-Z][A-Za-z]*\.",
)
# How a reporter's spelling is made uniform, applied in this order.
RESPELLED = (
    ("S. Ct.", "S.Ct."),
    ("L. Ed.", "L.Ed."),
    ("L. Ed. 2d", "L.Ed.2d"),
    ("F. 2d", "F.2d"),
    ("F. 3d", "F.3d"),
    ("F. Supp. 2d", "F.Supp.2d"),
    ("F. Supp. 3d", "F.Supp.3d"),
    ("F.Supp. 2d", "F.Supp.2d"),
    ("F.Supp. 3d", "F.Supp.3d"),
    ("F. Supp.", "F.Supp."),
    ("F. App'x", "F.App'x"),
    ("A. 2d", "A.2d"),
    ("A. 3d", "A.3d"),
    ("N.E. 2d", "N.E.2d"),
    ("N.E. 3d", "N.E.3d"),
    ("N.W. 2d", "N.W.2d"),
    ("P. 2d", "P.2d"),
    ("P. 3d", "P.3d"),
    ("S.E. 2d", "S.E.2d"),
    ("S.W. 2d", "S.W.2d"),
    ("S.W. 3d", "S.W.3d"),
    ("So. 2d", "So.2d"),
    ("So. 3d", "So.3d"),
    ("N.Y.S. 2d", "N.Y.S.2d"),
    ("N.Y.S. 3d", "N.Y.S.3d"),
    ("Cal. Rptr.", "Cal.Rptr."),
    ("Cal. Rptr. 2d", "Cal.Rptr.2d"),
    ("Cal. Rptr. 3d", "Cal.Rptr.3d"),
    ("Cal. App.", "Cal.App."),
)
# Fixed patterns.
CASE = r"(\d{1,4})\s+(" + "|".join(REPORTERS) + r")\s+(\d{1,5})(?:,?\s+\d{1,5})?(?:\s*\(([^)]*\d{4}[^)]*)\))?"
_PARTY = r"[A-Z][A-Za-z''.\-]+(?:\s+[A-Za-z''.\-]+){0,5}"
NAME = rf"((?:(?:In\s+re|Ex\s+parte)\s+)?{_PARTY}\s+v\.?\s+{_PARTY})\s*,?\s*"
SHORT = r"\b(?:Id\.|Ibid\.|[Ss]upra|[Ii]nfra)(?:\s+at\s+\d{1,5})?"
STATUTE = r"\b\d{1,3}\s+(?:U\.S\.C|C\.F\.R|Fed\.\s*R\.\s*(?:Civ|Crim|App|Evid)\.\s*P)\.\s*§?\s*\d+"
SECONDARY = r"\b\d{1,3}\s+(?:Am\.\s*Jur\.|C\.J\.S\.|A\.L\.R\.)"
NAME_REACH = 200
PLACEHOLDER = "[CITATION]"

_CASE, _NAME = re.compile(CASE), re.compile(NAME)
#: Other kinds: their pattern, why they are left out, and pieces of which every match holds one; most texts hold none.
_OTHER = {
    "short_form": (re.compile(SHORT), "context_dependent_short_form", ("Id.", "Ibid.", "upra", "nfra")),
    "statute": (re.compile(STATUTE), "non_case_reference", ("U.S.C.", "C.F.R.", "Fed.")),
    "secondary": (re.compile(SECONDARY), "non_case_reference", ("Jur.", "C.J.S.", "A.L.R.")),
}

_TEXTS = ("original_text", "target_type", "volume", "reporter", "page", "court_year", "case_name", "normalized", "resolution_status", "excluded_reason")
CITATION = StructType().add("start", IntegerType()).add("end", IntegerType())
for _name in _TEXTS:
    CITATION = CITATION.add(_name, StringType())
_ARROW = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), *((n, pa.string()) for n in _TEXTS)]))


@lru_cache(4096)
def plain_reporter(reporter: str) -> str:
    """A reporter's uniform spelling; reporters are few, so each is respelled about once a worker."""
    out = " ".join(reporter.split())
    for long, short in RESPELLED:
        out = out.replace(long, short)
    return out


def normalized(volume: Column, reporter: Column, page: Column) -> Column:
    """``volume reporter page`` in the uniform spelling."""
    out = F.regexp_replace(F.regexp_replace(reporter, r"(?U)\s+", " "), r"\A | \z", "")
    for long, short in RESPELLED:
        out = F.replace(out, F.lit(long), F.lit(short))
    return F.concat_ws(" ", volume, out, page)


def _others(kind: str, text: str) -> Iterator[re.Match]:
    """Matches of another kind; a text without any of its pieces is not searched."""
    pattern, _, pieces = _OTHER[kind]
    return pattern.finditer(text) if any(p in text for p in pieces) else iter(())


def _case_name(text: str, start: int) -> str | None:
    """The last ``Party v. Party`` before a citation."""
    last = None
    for last in _NAME.finditer(text[max(0, start - NAME_REACH) : start]):
        pass
    return last[1].strip() if last else None


class _Cover:
    """Answers whether a stretch lies within one of some spans: of those that begin no later, the farthest end decides."""

    def __init__(self, spans: list[tuple[int, int]]):
        spans = sorted(spans)
        self.starts = [a for a, _ in spans]
        self.ends = list(accumulate((b for _, b in spans), max))

    def __contains__(self, span: tuple[int, int]) -> bool:
        i = bisect_right(self.starts, span[0])
        return i > 0 and span[1] <= self.ends[i - 1]


def find(text: str) -> list[dict]:
    """All citations by position; other kinds inside a case citation are left out."""
    found: list[dict] = []
    for m in _CASE.finditer(text):
        volume, reporter, page, year = m.groups()
        found.append(
            {
                "start": m.start(),
                "end": m.end(),
                "original_text": m[0].strip(),
                "target_type": "case",
                "volume": volume,
                "reporter": reporter,
                "page": page,
                "court_year": year.strip() if year else None,
                "case_name": _case_name(text, m.start()),
                "normalized": f"{volume} {plain_reporter(reporter)} {page}",
                "resolution_status": "unresolved",
            }
        )
    cases = _Cover([(c["start"], c["end"]) for c in found])
    for kind, (_, reason, _) in _OTHER.items():
        for m in _others(kind, text):
            if m.span() not in cases:
                found.append(
                    {"start": m.start(), "end": m.end(), "original_text": m[0].strip(), "target_type": kind, "resolution_status": "excluded", "excluded_reason": reason}
                )
    return sorted(found, key=lambda c: c["start"])


@F.arrow_udf(ArrayType(CITATION))
def extract(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        yield pa.array([find(t or "") for t in batch.to_pylist()], _ARROW)


@F.arrow_udf(ArrayType(StringType()))
def cases(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Normal forms of each text's case citations by position: what ``extract`` has of them, without all else."""
    for batch in batches:
        found = [[f"{volume} {plain_reporter(reporter)} {page}" for volume, reporter, page, _ in _CASE.findall(t or "")] for t in batch.to_pylist()]
        yield pa.array(found, pa.list_(pa.string()))


def mask(text: str, placeholder: str = PLACEHOLDER) -> str:
    """Case citations with the names before them, and short forms, replaced; neighbours become one."""
    spans: list[tuple[int, int]] = []
    for m in _CASE.finditer(text):
        start, name = m.start(), _case_name(text, m.start())
        if name:
            at = text.rfind(name, max(0, start - NAME_REACH), start)
            start = at if at >= 0 else start
        spans.append((start, m.end()))
    cases = _Cover(spans)
    spans += [s for m in _others("short_form", text) if (s := m.span()) not in cases]
    out, done, last = [], 0, -2
    for start, end in sorted(spans):
        if start > last + 1:  # not touching the span before
            out += [text[done:start], placeholder]
        last = done = max(last, end)
    return "".join(out) + text[done:]


@F.arrow_udf(StringType())
def masked(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        yield pa.array([None if t is None else mask(t) for t in batch.to_pylist()], pa.string())


def of_kind(citations: Column, kind: str) -> Column:
    return F.filter(citations, lambda c: c["target_type"] == kind)


def distinct_cases(citations: Column) -> Column:
    """Normal forms of the case citations, the first of each."""
    return F.array_distinct(F.transform(of_kind(citations, "case"), lambda c: F.coalesce(c["normalized"], c["original_text"])))


def summary(citations: Column) -> Column:
    return F.struct(
        F.size(citations).alias("total_citations"),
        F.size(of_kind(citations, "case")).alias("case_citations"),
        F.size(distinct_cases(citations)).alias("unique_case_citations"),
        F.size(of_kind(citations, "short_form")).alias("short_form_count"),
        F.size(of_kind(citations, "statute")).alias("statute_count"),
        F.size(of_kind(citations, "secondary")).alias("secondary_count"),
        distinct_cases(citations).alias("normalized_case_cites"),
    )


def leaks(rows: DataFrame, text_col: str = "facts_text_masked", id_col: str = "row_id") -> DataFrame:
    """Rows whose masked text still has case citations, with the first ten of them."""
    found = F.slice(F.regexp_extract_all(F.col(text_col), F.lit(CASE), F.lit(0)), 1, 10)
    return rows.where(F.col(text_col).rlike(CASE)).select(id_col, found.alias("leaked_citations"))


def assert_no_leaks(rows: DataFrame, text_col: str = "facts_text_masked") -> DataFrame:
    """The same rows; reading them fails on the first leak."""
    return rows.where(F.assert_true(~F.coalesce(F.col(text_col).rlike(CASE), F.lit(False)), F.lit("unmasked citation in a masked text")).isNull())
