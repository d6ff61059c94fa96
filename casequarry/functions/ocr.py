"""Does extracted text need OCR?  Page and document decisions as column expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from casequarry.functions import text as T


@dataclass(frozen=True)
class OcrRules:
    """Fixed thresholds."""

    page_chars: int = 120
    page_words: int = 35
    page_alpha: float = 0.35
    page_weird: float = 0.20
    page_body: int = 60
    doc_chars: int = 1200
    doc_chars_per_page: int = 600
    doc_sample_lines: int = 400
    doc_header_share: float = 0.80
    doc_rest_chars: int = 1200
    doc_rest_alpha: int = 600
    doc_body: int = 600
    garbage_alpha: int = 300
    garbage_share: float = 0.02


RULES = OcrRules()

# Fixed patterns of header stamps and of tokens left by broken extraction.
STAMPS = (
    r"(?i)\bCase\s+\d{1,2}:\d{2,4}-[a-z]{2,3}-\d+\b.*\bDocument\s+\d+\b.*\bFiled\s+\d{1,2}/\d{1,2}/\d{2,4}\b",
    r"(?i)\bPage\s+\d+\s+of\s+\d+\b.*\bPageID\b",
    r"(?i)\bcase\b.*\bdocument\b.*\bfiled\b.*\bpage\b",
    r"(?i)^case:\s*\d",
)
GARBAGE_TOKEN = r"/i\d{2,}"
WEIRD_TOKEN = r"^/?[A-Za-z]\d{2,}$"


def is_stamp(line: Column) -> Column:
    out = line.rlike(STAMPS[0])
    for pattern in STAMPS[1:]:
        out = out | line.rlike(pattern)
    return out


def without_blanks(text: Column) -> Column:
    plain = F.replace(F.replace(text, F.lit(" "), F.lit("")), F.lit("\n"), F.lit(""))
    return T.once(plain, lambda p: T.replaced(p, p.rlike(r"[\t-\r\x85\xa0\u1680-\u3000]"), r"(?U)\s+", ""))


def fewer_than(least: int, text: Column) -> Column:
    """Whether a text has fewer other characters than blanks; one whose beginning has enough is not read on."""
    n_chars = lambda t: F.length(without_blanks(t))
    return (n_chars(F.substring(text, 1, 2 * least)) < least) & (n_chars(text) < least)


def strip_stamps(text: Column) -> Column:
    """Blank and stamp lines removed."""
    body = F.filter(T.lines(T.blank_if_null(text)), lambda x: T.once(T.strip(x), lambda bare: (bare != "") & ~is_stamp(bare)))
    return F.array_join(body, "\n")


def page_metrics(text: Column) -> Column:
    """chars, alpha_ratio, weird_token_ratio, word_count, unique_word_count and nonempty_lines, all doubles."""
    return T.once(T.blank_if_null(text), lambda t: T.once(without_blanks(t), lambda dense: _page_metrics(t, dense)))


def _page_metrics(text: Column, dense: Column) -> Column:
    chars = F.length(dense)
    tokens = F.regexp_extract_all(text, F.lit(r"(?U)\S+"), F.lit(0))
    words = F.regexp_extract_all(text, F.lit(r"[A-Za-z]{2,}"), F.lit(0))
    full = F.filter(T.lines(text), lambda x: ~T.blank(x))

    def value(column: Column) -> Column:
        return F.when(chars > 0, column).otherwise(0).cast("double")

    return F.struct(
        chars.cast("double").alias("chars"),
        value(F.try_divide(T.letters(dense).cast("double"), chars)).alias("alpha_ratio"),
        value(F.try_divide(F.size(F.filter(tokens, lambda t: t.rlike(WEIRD_TOKEN))).cast("double"), F.size(tokens))).alias("weird_token_ratio"),
        value(F.size(words)).alias("word_count"),
        value(F.size(F.array_distinct(F.transform(words, F.lower)))).alias("unique_word_count"),
        value(F.size(full)).alias("nonempty_lines"),
    )


def looks_garbled(text: Column, rules: OcrRules = RULES) -> Column:
    # Most texts have letters enough at their beginning and are not read on; white space has no letters.
    some = rf"\A(?:[^\p{{L}}]*+\p{{L}}){{{rules.garbage_alpha}}}"

    def garbled(head: Column) -> Column:
        sparse = T.letters(head) < rules.garbage_share * F.length(without_blanks(head))
        return head.rlike(GARBAGE_TOKEN) | T.blank(head) | (~head.rlike(some) & sparse)

    return T.once(F.substring(T.blank_if_null(text), 1, 30000), garbled)


def only_stamps(text: Column, least: int) -> Column:
    return T.once(strip_stamps(text), lambda body: fewer_than(least, body))


def _named(*reasons: tuple[str, Column]) -> Column:
    return F.array_compact(F.array(*(F.when(test, F.lit(name)) for name, test in reasons)))


def page_reasons(text: Column, rules: OcrRules = RULES) -> Column:
    """Why a page needs OCR; empty if it does not."""

    def reasons(text: Column, dense: Column) -> Column:
        chars = F.length(dense)
        # As ``page_metrics``; only a text with such a token somewhere can have too many.
        tokens = F.regexp_extract_all(text, F.lit(r"(?U)\S+"), F.lit(0))
        weird = T.once(tokens, lambda found: F.try_divide(F.size(F.filter(found, lambda t: t.rlike(WEIRD_TOKEN))).cast("double"), F.size(found)))
        return _named(
            ("garbage_text", looks_garbled(text, rules)),
            ("stamp_only", only_stamps(text, rules.page_body)),
            ("too_few_chars", chars < rules.page_chars),
            ("too_few_words", F.regexp_count(text, F.lit(r"[A-Za-z]{2,}")) < rules.page_words),
            ("low_alpha_ratio", (chars == 0) | (T.letters(dense).cast("double") / chars < rules.page_alpha)),
            ("weird_token_ratio", (chars > 0) & text.rlike(r"[A-Za-z]\d\d") & (weird > rules.page_weird)),
        )

    return T.once(T.blank_if_null(text), lambda t: T.once(without_blanks(t), lambda dense: reasons(t, dense)))


def document_metrics(text: Column, rules: OcrRules = RULES) -> Column:
    """total_chars, header_frac, rest_len and rest_alpha of a document's head."""

    def metrics(text: Column, sample: Column, others: Column) -> Column:
        def told(rest: Column) -> Column:
            return F.struct(
                F.length(without_blanks(text)).alias("total_chars"),
                ((F.size(sample) - F.size(others)) / F.greatest(F.lit(1), F.size(sample))).alias("header_frac"),
                F.length(rest).alias("rest_len"),
                T.letters(rest).alias("rest_alpha"),
            )

        return T.once(without_blanks(F.array_join(others, "\n")), told)

    def sampled(text: Column) -> Column:
        stripped = F.transform(T.lines(F.substring(text, 1, 20000)), T.strip)
        sample = F.slice(F.filter(stripped, lambda x: x != ""), 1, rules.doc_sample_lines)
        return T.once(sample, lambda own: T.once(F.filter(own, lambda x: ~is_stamp(x)), lambda others: metrics(text, own, others)))

    return T.once(T.blank_if_null(text), sampled)


def document_reasons(text: Column, page_count: Column | None = None, rules: OcrRules = RULES) -> Column:
    """Why a document needs OCR; with enough characters a page only garbage and emptiness count."""

    def reasons(text: Column, body: Column, sample: Column) -> Column:
        # As ``document_metrics``; each test is made only where those before it leave the question open.
        others = F.filter(sample, lambda x: ~x["stamp"])
        share = (F.size(sample) - F.size(others)) / F.greatest(F.lit(1), F.size(sample))
        rest = F.array_join(F.transform(others, lambda x: x["line"]), "\n")
        few = T.once(without_blanks(rest), lambda r: (F.length(r) < rules.doc_rest_chars) & (T.letters(r) < rules.doc_rest_alpha))
        named = _named(
            ("no_text", T.blank(text)),
            ("too_little_text", fewer_than(rules.doc_chars, text)),
            ("garbage_text", looks_garbled(text, rules)),
            ("stamp_only_head", fewer_than(rules.doc_body, body)),
            ("header_only", (share >= rules.doc_header_share) & few),
        )
        if page_count is None:
            return named
        dense = F.coalesce((page_count > 0) & (F.length(without_blanks(text)) >= rules.doc_chars_per_page * page_count), F.lit(False))
        return F.when(dense, F.array_intersect(named, F.array(F.lit("no_text"), F.lit("garbage_text")))).otherwise(named)

    def told(text: Column, marked: Column) -> Column:
        body = F.array_join(F.transform(F.filter(marked, lambda x: ~x["stamp"]), lambda x: x["line"]), "\n")
        return T.once(body, lambda b: reasons(text, b, F.slice(marked, 1, rules.doc_sample_lines)))

    def marked(text: Column) -> Column:
        full = F.filter(F.transform(T.lines(F.substring(text, 1, 20000)), T.strip), lambda x: x != "")
        return F.transform(full, lambda x: F.struct(x.alias("line"), is_stamp(x).alias("stamp")))

    return T.once(T.blank_if_null(text), lambda t: T.once(marked(t), lambda m: told(t, m)))


def needs_ocr(text: Column, page_count: Column | None = None, rules: OcrRules = RULES) -> Column:
    return F.size(document_reasons(text, page_count, rules)) > 0


def is_better(new: Column, old: Column) -> Column:
    """Is a second extraction clearly better than the first?"""
    head = lambda text: T.letters(F.substring(T.blank_if_null(text), 1, 40000))
    more = lambda fresh, stale: (fresh >= 1500) & (fresh >= F.greatest(F.floor(stale * 1.5), stale + 800))
    return T.once(head(new), lambda fresh: (fresh >= 800) & (looks_garbled(old) | T.once(head(old), lambda stale: more(fresh, stale))))


def best_text(first: Column, second: Column, normalized_first: Column | None = None) -> Column:
    """Which of two extractions to use: struct of text, extractor (first, second, none) and note."""
    # The texts and the choice are worked out once a row, however many fields are read.
    return T.once(F.struct(first.alias("first"), second.alias("second")), lambda two: _best_text(two["first"], two["second"], normalized_first))


def _best_text(first: Column, second: Column, normalized_first: Column | None) -> Column:
    absent = F.coalesce(first, F.lit("")) == ""
    other = F.coalesce(second, F.lit("")) != ""
    weak = needs_ocr(T.normalize(T.blank_if_null(first)) if normalized_first is None else normalized_first)


    def chosen(turn: Column) -> Column:
        return F.struct(
            F.when(absent | turn, second).otherwise(first).alias("text"),
            F.when(absent & ~other, "none").when(absent | turn, "second").otherwise("first").alias("extractor"),
            F.when(absent, "no_text_from_first").when(turn, "fallback_second").alias("note"),
        )

    return T.once(~absent & other & weak & is_better(second, first), chosen)
