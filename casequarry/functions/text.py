"""Text normalisation and text statistics as column expressions.

Character classes follow Unicode (``(?U)``), lines end at ``\\n`` only (``(?d)``).  The
line rules of ``preprocess`` look at pairs of lines in order and run as an Arrow UDF.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: What ends a line besides a newline.
OTHER_BREAKS = "\x0b\x0c\x1c\x1d\x1e\x85  "


def once(value: Column, build) -> Column:
    """``build(value)`` with the value computed once and the expression kept small, however often it is used."""
    return F.element_at(F.transform(F.array(value), build), 1)


def blank_if_null(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


#: A class that holds ``\r`` and all of these and is fast: one of single characters is searched one by one.
BREAK_CUE = r"[\x0b-\x0d\x1c-\x1e\x85\u2028-\u2029]"
#: What ``(?U)\s`` matches.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITE))


def blank(text: Column) -> Column:
    """Whether a text has nothing but blanks; a text that has is read up to its first other character."""
    return ~text.rlike(r"(?U)\S")


def replaced(text: Column, cue: Column, pattern: str, by: str) -> Column:
    """``regexp_replace`` of texts for which ``cue`` holds, a cheap test that all texts with a match pass."""
    return F.when(cue, F.regexp_replace(text, pattern, by)).otherwise(text)


def lines(text: Column) -> Column:
    """The lines of a text; a final line break starts no further line."""
    plain = once(text, lambda t: replaced(t, t.rlike(BREAK_CUE), f"\r[\n{OTHER_BREAKS}]?|[{OTHER_BREAKS}]", "\n"))
    whole = once(plain, lambda p: F.split(F.when(p.endswith("\n"), F.substring(p, F.lit(1), F.length(p) - 1)).otherwise(p), "\n"))
    return F.when(text == "", F.array().cast("array<string>")).otherwise(whole)


def normalize(raw: Column) -> Column:
    """Newlines, hyphen breaks, runs of blanks and empty lines, and trailing blanks made uniform."""
    text = F.replace(F.replace(raw, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    text = once(text, lambda t: replaced(t, t.contains("-\n"), r"(?U)(\w)-\n(\w)", "$1$2"))
    text = F.regexp_replace(text, "[ \t]{2,}", " ")
    text = once(text, lambda t: replaced(t, t.contains("\n\n\n"), "\n{3,}", "\n\n"))
    text = once(text, lambda t: replaced(t, t.rlike(BREAK_CUE), f"[{OTHER_BREAKS}]", "\n"))
    return strip(F.regexp_replace(text, r"(?Ud)[\s&&[^\n]]+(?=\n|\z)", ""))


def squash(text: Column) -> Column:
    return strip(F.regexp_replace(text, r"(?U)\s+", " "))


def strip_stamp_headers(text: Column) -> Column:
    """Without the two kinds of court-system header lines."""

    def is_header(line: Column) -> Column:
        up = F.upper(strip(line))
        spread = up.startswith("CASE ") & up.contains("DOCUMENT") & up.contains("FILED") & up.contains("PAGE")
        labelled = up.startswith("CASE:") & up.contains("DOCUMENT:") & up.contains("PAGE:")
        return spread | labelled

    return F.array_join(F.filter(lines(text), lambda line: ~is_header(line)), "\n")


_ROMAN = re.compile(r"[IVXLC]+\Z")


def _is_header(line: str) -> bool:
    up = line.strip().upper()
    if up.startswith("CASE:"):
        return "DOCUMENT:" in up and "PAGE:" in up
    return up.startswith("CASE ") and all(word in up for word in ("DOCUMENT", "FILED", "PAGE"))


def merge_roman_lines(text: str) -> str:
    """A line that is only a roman numeral joins the line after it."""
    out: list[str] = []
    rest = iter(text.splitlines())
    for line in rest:
        numeral = line.strip()
        if _ROMAN.match(numeral):
            following = next(rest, None)
            out.append(line if following is None else f"{numeral}. {following.strip()}")
        else:
            out.append(line)
    return "\n".join(out)


def prepare(text: str) -> str:
    """Header lines removed and roman lines merged, once."""
    return merge_roman_lines("\n".join(line for line in text.splitlines() if not _is_header(line)))


def settle(text: str, most: int = 4) -> str:
    """``prepare`` until nothing changes, at most ``most`` times."""
    for _ in range(most):
        again = prepare(text)
        if again == text:
            break
        text = again
    return text


def _mapped(function):
    @F.arrow_udf(StringType())
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([None if t is None else function(t) for t in batch.to_pylist()], pa.string())

    return run


def preprocess(text: Column) -> Column:
    return _mapped(settle)(text)


def merged_roman(text: Column) -> Column:
    return _mapped(merge_roman_lines)(text)


def letters(text: Column) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, r"\p{L}+", ""))


def letter_share(text: Column) -> Column:
    """Letters over characters; 0 for empty text."""
    return F.when(F.length(text) > 0, letters(text) / F.length(text)).otherwise(0.0)


def toc_lines(text: Column) -> Column:
    """Lines that end in dot leaders and a page number."""
    return F.size(F.filter(lines(text), lambda line: strip(line).rlike(r"(?U)\.{2,}\s*\d{1,4}\s*\z")))


def head_window(text: Column, most: int) -> Column:
    """The first ``most`` characters, cut at the last line break unless that lies in the first half."""
    head = F.substring(text, 1, most)
    last = most - F.locate("\n", F.reverse(head))
    broken = (F.locate("\n", head) > 0) & (last >= most // 2)
    return F.when(F.length(text) <= most, text).when(broken, F.substring(text, F.lit(1), last)).otherwise(head)


def anchor_preview(text: Column, words: int = 12) -> Column:
    """The first words of a text, one space between them."""
    return F.array_join(F.slice(F.regexp_extract_all(text, F.lit(r"(?U)\S+"), F.lit(0)), 1, words), " ")
