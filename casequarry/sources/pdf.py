"""Text of PDF files by injected readers: page texts, recognition of the pages that need it, and a cache by content.

``Reader`` and ``Recogniser`` wrap whatever library a site has; the engine decides which
pages to recognise, keeps the limits, joins the cache and puts the text together.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

from casequarry.functions import ocr as O
from casequarry.functions import text as T
from casequarry.sources import files

#: Page texts of a file's bytes.
Reader = Callable[[bytes], list[str]]
#: Text of one page (from 0) of a file's bytes.
Recogniser = Callable[[bytes, int], str]


@dataclass(frozen=True)
class Limits:
    """Pages of a file at most, seconds of recognition for a file at most, and what else a cached text depends on."""

    pages: int | None = None
    seconds: float | None = None
    language: str = "eng"
    dpi: int = 300
    full: bool = True
    force: bool = False

    def key(self, sha1: Column) -> Column:
        return F.concat_ws("|", sha1, F.lit(self.language), F.lit(self.dpi), F.lit(self.full), F.lit(self.force))


def readiness(probe: Callable[[], tuple[bool, list[str]]], language: str = "eng") -> tuple[bool, list[str]]:
    """Whether recognition can run, and why not: ``probe`` tells if the library is there and which languages it has."""
    there, languages = probe()
    reasons = [] if there else ["library_missing"]
    reasons += [f"language_missing:{part}" for part in language.split("+") if there and part not in languages]
    return not reasons, reasons


def _page_texts(read: Reader, most: int | None):
    kind = StructType().add("pages", ArrayType(StringType())).add("error", StringType())

    @F.arrow_udf(kind)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            out = []
            for content in column.to_pylist():
                try:
                    pages = [p or "" for p in read(content or b"")]
                    error = f"ValueError: {len(pages)} pages, more than {most}" if most is not None and len(pages) > most else None
                    out.append({"pages": pages if error is None else [], "error": error})
                except Exception as e:  # noqa: BLE001  a file that cannot be read is a result
                    out.append({"pages": [], "error": f"{type(e).__name__}: {e}"})
            yield pa.array(out, pa.struct([("pages", pa.list_(pa.string())), ("error", pa.string())]))

    return run


def page_texts(pdfs: DataFrame, read: Reader, most_pages: int | None = None) -> DataFrame:
    """Adds pages, page_count and error to files with ``content``; what cannot be read has no pages."""
    found = pdfs.withColumn("_p", _page_texts(read, most_pages)("content"))
    return found.withColumns({"pages": F.col("_p.pages"), "page_count": F.size("_p.pages"), "error": F.col("_p.error")}).drop("_p")


def joined_pages(pages: Column, blank: bool = False) -> Column:
    """One text: pages that are not blank apart by an empty line, or all pages by a line break."""
    return F.array_join(pages, "\n") if blank else F.array_join(F.filter(pages, lambda p: T.strip(p) != ""), "\n\n")


def _recognised(recognise: Recogniser, seconds: float | None):
    kind = StructType().add("texts", ArrayType(StringType())).add("error", StringType())

    @F.arrow_udf(kind)
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for contents, wanted in batches:
            out = []
            for content, numbers in zip(contents.to_pylist(), wanted.to_pylist(), strict=True):
                began, texts, error = time.monotonic(), [], None
                for n in numbers or []:
                    if seconds is not None and time.monotonic() - began > seconds:
                        error = f"TimeoutError: recognition took more than {seconds} s"
                        break
                    try:
                        texts.append(recognise(content, n) or "")
                    except Exception as e:  # noqa: BLE001
                        error = f"{type(e).__name__}: {e}"
                        break
                out.append({"texts": texts, "error": error})
            yield pa.array(out, pa.struct([("texts", pa.list_(pa.string())), ("error", pa.string())]))

    return run


def selective(pages: DataFrame, recognise: Recogniser, limits: Limits = Limits(), rules: O.OcrRules = O.RULES) -> DataFrame:
    """Recognises the pages of files (content, pages) that need it; adds text and what was done.

    Columns: ocr_pages_attempted, ocr_pages_succeeded, ocr_used, text, error.  A page keeps its
    own text where recognition gives nothing.  After an error or past the time limit the text ends with
    the page before.
    """
    need = F.lit(True) if limits.force else None
    numbered = F.transform("pages", lambda p, i: F.when(need if need is not None else F.size(O.page_reasons(p, rules)) > 0, i.cast("int")))
    # Made once by a generator of one row: as a column it would be copied into every use of what is recognised.
    asked = pages.select("*", F.explode(F.array(F.array_compact(numbered))).alias("_wanted"))
    asked = asked.withColumn("_r", _recognised(recognise, limits.seconds)("content", "_wanted"))
    got = lambda i: F.get("_r.texts", F.array_position("_wanted", i).cast("int") - 1)
    whole = F.transform("pages", lambda p, i: F.when(~T.blank(F.coalesce(got(i.cast("int")), F.lit(""))), got(i.cast("int"))).otherwise(p))
    failed_at = F.get("_wanted", F.size("_r.texts"))
    ends = F.when(F.col("_r.error").isNotNull(), failed_at).otherwise(F.size("pages"))
    attempted = F.size("_r.texts") + F.when(F.col("_r.error").isNotNull() & ~F.col("_r.error").startswith("TimeoutError"), 1).otherwise(0)
    succeeded = F.size(F.filter("_r.texts", lambda t: ~T.blank(t)))
    before = F.col("error") if "error" in pages.columns else F.lit(None).cast("string")
    made = asked.withColumns(
        {
            "text": F.array_join(F.slice(whole, F.lit(1), ends), "\n"),
            "ocr_pages_attempted": attempted,
            "ocr_pages_succeeded": succeeded,
            "ocr_used": succeeded > 0,
            "error": F.coalesce(before, F.col("_r.error")),
        }
    )
    return made.drop("_wanted", "_r")


def cached_text(pdfs: DataFrame, read: Reader, recognise: Recogniser, cache: DataFrame | None = None, limits: Limits = Limits()) -> tuple[DataFrame, DataFrame]:
    """(path, text, ocr_used, error, cached) of files (path, content, sha1), and the rows (key, text, ocr_used) to add to the cache.

    A file whose content and settings the cache has is neither read nor recognised; failures are not cached.
    """
    keyed = pdfs.withColumn("key", limits.key(F.col("sha1")))
    known = None
    if cache is not None:
        known = keyed.select("path", "key").join(cache.dropDuplicates(["key"]), "key").select("path", "text", "ocr_used", F.lit(None).cast("string").alias("error"), F.lit(True).alias("cached"))
        keyed = keyed.join(cache.select("key").distinct(), "key", "left_anti")
    done = selective(page_texts(keyed, read, limits.pages), recognise, limits)
    fresh = done.where("error is null").select("key", "text", "ocr_used").dropDuplicates(["key"])
    every = done.select("path", "text", "ocr_used", "error", F.lit(False).alias("cached"))
    return (every if known is None else every.unionByName(known)), fresh


def document_text(content: Column, path: Column, read: Reader) -> Column:
    """A file's text by its kind: pages of a PDF, else its bytes as text."""
    pages = _page_texts(read, None)(content)["pages"]
    return F.when(F.lower(path).endswith(".pdf"), joined_pages(pages)).otherwise(files.replaced(content))
