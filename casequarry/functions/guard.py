"""Instruction-like passages and hidden characters in untrusted documents."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from operator import or_

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

from casequarry.functions import text as T

# Fixed patterns by name; all ignore case, the two line patterns look at each line's start.
PATTERNS: dict[str, str] = {
    "ignore_previous": r"\b(ignore|disregard|forget|override)\s+(all\s+|any\s+)?(the\s+|your\s+)?(previous|prior|above|earlier|preceding|system)\s+(instructions?|prompts?|directions?|rules?|guidance)\b",
    "role_reassignment": r"\byou are (now )?(a|an|the) (helpful|ai|assistant|language model|new)\b",
    "system_prompt_ref": r"\b(system prompt|developer message|hidden instructions?)\b",
    "chat_template_token": r"<\|im_start\|>|<\|im_end\|>|<\|system\|>|<\|user\|>|<\|assistant\|>|\[INST\]|<<SYS>>",
    "role_line": r"^\s*(assistant|system)\s*:\s*\S",
    "instruction_header": r"^\s*#{1,6}\s*(instructions?|system|prompt)\b",
    "forced_output": r"\b(output|return|respond with|reply with|print|emit)\s+(only\s+)?(the following|this exact|exactly this)\b",
    "schema_tampering": r"\b(set|make|report)\s+has_facts\s+(to|as|=)|facts_(start|end)_anchor\b|\bdo not extract\b",
    "ai_self_reference": r"\bas an ai( language)? model\b",
    "prompt_exfiltration": r"\b(reveal|print|show|repeat|leak)\s+(your|the)\s+(system\s+)?(prompt|instructions)\b",
}
LINE_PATTERNS = ("role_line", "instruction_header")
#: Of each pattern some words, of which every match holds one; a text without any is not searched for the pattern.
CUES: dict[str, tuple[str, ...]] = {
    "ignore_previous": ("ignore", "disregard", "forget", "override"),
    "role_reassignment": ("you are ",),
    "system_prompt_ref": ("system prompt", "developer message", "hidden instruction"),
    "chat_template_token": ("<|", "[inst]", "<<sys>>"),
    "role_line": ("assistant", "system"),
    "instruction_header": ("#",),
    "forced_output": ("the following", "this exact", "exactly this"),
    "schema_tampering": ("has_facts", "facts_start_anchor", "facts_end_anchor", "do not extract"),
    "ai_self_reference": ("as an ai",),
    "prompt_exfiltration": ("prompt", "instructions"),
}
#: What else a pattern takes for an ASCII letter when it ignores case, and the letter.
ALIKE, LETTERS = "ſ\u212aıİ", "skii"
#: Zero-width and direction-control characters.
INVISIBLE = r"[\u200b-\u200f\u202a-\u202e\u2060-\u2064\ufeff]"
MOST_MATCHES, LEAST_INVISIBLE = 20, 20


def java_pattern(name: str) -> str:
    return ("(?imdU)" if name in LINE_PATTERNS else "(?iU)") + PATTERNS[name]


def suspected(text: Column) -> Column:
    """Names of the patterns found, then ``invisible_characters``; empty if the text is clean."""

    def found(text: Column, lower: Column) -> Column:
        cued = {n: reduce(or_, (F.contains(lower, F.lit(c)) for c in cues)) for n, cues in CUES.items()}
        hidden = text.rlike(r"[\u200b-\u2064\ufeff]") & (F.regexp_count(text, F.lit(INVISIBLE)) >= LEAST_INVISIBLE)
        return F.array_compact(
            F.array(*(F.when(cued[n] & text.rlike(java_pattern(n)), F.lit(n)) for n in PATTERNS), F.when(hidden, F.lit("invisible_characters")))
        )

    plain = lambda t: F.lower(F.when(t.rlike(r"[\u0130-\u017f\u212a]"), F.translate(t, ALIKE, LETTERS)).otherwise(t))
    return T.once(T.blank_if_null(text), lambda t: T.once(plain(t), lambda lower: found(t, lower)))


def invisible_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(INVISIBLE))


_COMPILED = {n: re.compile(p, re.I | (re.M if n in LINE_PATTERNS else 0)) for n, p in PATTERNS.items()}
_HIDDEN = re.compile(INVISIBLE)


def find(text: str, most: int = MOST_MATCHES, hidden: int = LEAST_INVISIBLE) -> list[tuple[str, int, str]]:
    """(pattern, offset, snippet) in pattern order, at most ``most`` and one for hidden characters."""
    hits = ((n, m) for n, rx in _COMPILED.items() for m in rx.finditer(text))
    out = [
        (n, m.start(), text[max(0, m.start() - 40) : m.end() + 40].replace("\n", " ")) for n, m in (h for _, h in zip(range(most), hits))
    ]
    count = len(_HIDDEN.findall(text))
    if count >= hidden:
        out.append(("invisible_characters", -1, f"{count} zero-width/bidi chars"))
    return out


_MATCH = StructType().add("pattern", StringType()).add("offset", IntegerType()).add("snippet", StringType())


@F.arrow_udf(ArrayType(_MATCH))
def matches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    kind = pa.list_(pa.struct([("pattern", pa.string()), ("offset", pa.int32()), ("snippet", pa.string())]))
    for batch in batches:
        rows = [[dict(zip(("pattern", "offset", "snippet"), f, strict=True)) for f in find(t or "")] for t in batch.to_pylist()]
        yield pa.array(rows, kind)


def _any_matches(texts: Column, pattern: str) -> Column:
    return F.exists(F.coalesce(texts, F.array().cast("array<string>")), lambda t: F.coalesce(t.rlike(pattern), F.lit(False)))


def output_hits(fields: dict[str, Column]) -> Column:
    """``field:pattern`` for each pattern in the texts (arrays of strings) of an extraction's fields."""
    none = F.array().cast("array<string>")
    named = F.array(*(F.struct(F.lit(name).alias("name"), F.coalesce(texts, none).alias("texts")) for name, texts in fields.items()))

    # One expression for each pattern, whatever the number of fields.
    def found(field: Column) -> Column:
        return F.array_compact(F.array(*(F.when(_any_matches(field["texts"], java_pattern(p)), F.concat(field["name"], F.lit(f":{p}"))) for p in PATTERNS)))

    return F.flatten(F.transform(named, found))


def guarded(checks_ok: Column, flags: Column, found: Column, hits: Column) -> Column:
    """A validation result with guard flags added; suspicion (``suspected``) warns, contaminated output (``output_hits``) fails.

    Both are named columns of an earlier step: they are long expressions, read several times here.
    """
    return F.struct(
        (checks_ok & (F.size(hits) == 0)).alias("ok"),
        F.concat(
            flags,
            F.transform(found, lambda p: F.concat(F.lit("injection_suspected:"), p)),
            F.transform(hits, lambda h: F.concat(F.lit("injection_in_output:"), h)),
        ).alias("flags"),
        (F.size(found) == 0).alias("injection_not_suspected"),
        (F.size(hits) == 0).alias("no_injection_in_output"),
    )
