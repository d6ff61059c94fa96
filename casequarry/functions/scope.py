"""Which search hits are briefs, their document type, and their file addresses."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# What a short description must not begin with or contain.
NOT_BRIEF_PREFIXES = (
    "order",
    "notice",
    "report and recommendation",
    "proposed order",
    "stipulation",
    "summons",
    "complaint",
    "indictment",
    "judgment",
    "verdict",
    "warrant",
    "subpoena",
    "transcript",
    "minute",
    "docket",
)
EXCLUDED = (
    "appendix",
    "errata",
    "mandate",
    "transcript",
    "memorandum to counsel",
    "table of authorities",
    "certificate of service",
    "certificate of compliance",
    "corporate disclosure",
    "notice of appeal",
    "reply",
    "claim construction",
    "construction brief",
    "motion",
    "memorandum",
    "points and authorities",
)
#: Fields of a search hit that may hold the file's address, in order.
URL_FIELDS = ("download_url", "file_url", "pdf_url", "download", "url")
#: Fields that may hold the address of a page that links the file.
PAGE_FIELDS = ("absolute_url", "permalink", "web_url")


def _any(tests: list[Column]) -> Column:
    return reduce(or_, tests)


def _lowered(column: Column) -> Column:
    return F.lower(F.coalesce(column, F.lit("")))


def in_scope(short_description: Column, description: Column) -> Column:
    """A merits brief by its description: not amicus, reply, motion or an administrative paper."""
    short = _lowered(short_description)
    said = F.when(short != "", short).otherwise(_lowered(description))
    prefixed = _any([F.ltrim(short).startswith(p) for p in NOT_BRIEF_PREFIXES])
    worded = _any([said.contains(w) for w in EXCLUDED])
    return said.contains("brief") & ~prefixed & ~worded & ~said.rlike(r"(?U)\bamic(us|i)\b")


def document_type(court: Column, court_id: Column, short_description: Column, description: Column) -> Column:
    """One of the seven document types that decide how headings are read."""
    place = F.lower(F.when(F.coalesce(court, F.lit("")) != "", court).otherwise(F.coalesce(court_id, F.lit(""))))
    short = _lowered(short_description)
    said = F.when(short != "", short).otherwise(_lowered(description))

    def says(*words: str) -> Column:
        return _any([said.contains(w) for w in words])

    scotus = place.rlike(r"(?U)\b(scotus|supreme\s+court\s+of\s+the\s+united\s+states)\b") | says("supreme court")
    appellate = place.rlike(r"(?U)\b(ca\d{1,2}|cafc|cadc|circuit)\b") | place.contains("circuit") | says("court of appeals")
    district = place.rlike(r"(?U)\b(district|[a-z]{2,4}d)\b") | says("district")
    return (
        F.when(scotus & says("certiorari", "petition"), "CERT_PETITION")
        .when(scotus, "MERITS_SCOTUS")
        .when(appellate & says("response", "appellee", "respondent", "answering"), "FEDERAL_APPELLATE_RESPONSE")
        .when(appellate, "FEDERAL_APPELLATE_OPENING")
        .when(district, "DISTRICT_COURT")
        .when(_any([place.contains(w) for w in ("app", "appellate", "supreme")]), "STATE_APPELLATE")
        .otherwise("UNKNOWN")
    )


def _filled(column: Column) -> Column:
    trimmed = F.regexp_replace(column, r"(?U)\A\s+|\s+\z", "")
    return F.when(trimmed != "", trimmed)


def absolute(url: Column, site: str) -> Column:
    return F.when(url.startswith("/"), F.concat(F.lit(site), url)).otherwise(url)


def linked_file(html: Column, site: str) -> Column:
    """The first link of a page to a PDF."""
    found = F.regexp_extract(html, r'(?i)href="([^"]+\.pdf[^"]*)"', 1)
    return F.when(found != "", absolute(found, site))


def file_url(fields: dict[str, Column], html: Column, site: str, storage: str) -> Column:
    """Struct of url, strategy and web_url: the stored file, a field of the hit, or a link on its page."""
    none = F.lit(None).cast("string")
    local = _filled(fields.get("filepath_local", none))
    direct = [(name, _filled(fields[name])) for name in URL_FIELDS if name in fields]
    page = F.coalesce(none, *(_filled(fields[name]) for name in PAGE_FIELDS if name in fields))
    asked = local.isNotNull()
    url = F.when(asked, F.concat(F.lit(f"{storage}/"), F.ltrim(F.regexp_replace(local, r"\A/+", ""))))
    strategy = F.when(asked, "search.filepath_local")
    for name, value in direct:
        url = url.when(value.isNotNull(), absolute(value, site))
        strategy = strategy.when(value.isNotNull(), f"search.{name}")
    given = F.coalesce(local, *(v for _, v in direct), none).isNotNull()
    url = url.when(page.isNotNull(), linked_file(html, site))
    strategy = strategy.when(page.isNotNull(), "scrape_webpage_for_pdf").otherwise("no_pdf_fields")
    return F.struct(url.alias("url"), strategy.alias("strategy"), F.when(~given, absolute(page, site)).alias("web_url"))


def candidate_urls(url: Column, site: str, storage: str) -> Column:
    """The addresses to try, the storage host before the site for archived files."""
    to_storage = F.concat(F.lit(storage), F.substring(url, F.lit(len(site) + 1), F.length(url)))
    to_site = F.concat(F.lit(site), F.substring(url, F.lit(len(storage) + 1), F.length(url)))
    return F.array_distinct(
        F.when(url.startswith(f"{site}/recap/"), F.array(to_storage, url))
        .when(url.startswith(f"{storage}/recap/"), F.array(url, to_site))
        .when(url.isNotNull(), F.array(url))
    )
