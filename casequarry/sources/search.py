"""A search service as a Spark source.

The engine calls no service: a ``fetch`` function turns a page address (None for the
first) and parameters into (hits, next address).  Where pages depend on each other one
query is one partition; a service that numbers its pages is read in ranges of them.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, InputPartition

from casequarry import schemas

Fetch = Callable[[str | None, dict[str, str]], tuple[list[dict[str, Any]], str | None]]
#: Tries beside the first, seconds before the first of them (doubled each time), and answers worth another try.
RETRIES, BACKOFF, AGAIN = 6, 1.0, (429, 500, 502, 503, 504)
#: A file that is not there yet.
PENDING = 202


class Status(Exception):
    """What an injected function raises for an answer other than 200."""

    def __init__(self, code: int, text: str = ""):
        super().__init__(f"{code} {text}".strip())
        self.code = code


def persistent(call: Callable[..., Any], retries: int = RETRIES, backoff: float = BACKOFF, again: tuple[int, ...] = AGAIN, sleep: Callable[[float], None] = time.sleep):
    """``call`` with further tries after answers in ``again``; other failures and the last one pass on."""

    def run(*args):
        for n in range(retries + 1):
            try:
                return call(*args)
            except Status as e:
                if e.code not in again or n == retries:
                    raise
                sleep(backoff * 2**n)

    return run


def paged(fetch: Fetch, params: dict[str, str], most: int) -> Iterator[dict[str, Any]]:
    """Hits of all pages, at most ``most``."""
    at, seen = None, 0
    while seen < most:
        hits, at = fetch(at, params)
        for hit in hits[: most - seen]:
            seen += 1
            yield hit
        if not hits or not at:
            return


#: Columns whose equality the service itself can check: they go along as parameters of each request.
FILTERED = ("court", "court_id", "document_type")
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


class Pages(InputPartition):
    """Pages first..last of a query; last None is all pages from the first on, one after another."""

    def __init__(self, query: str, params: dict[str, str], first: int = 0, last: int | None = None, since: int | None = None, until: int | None = None):
        self.query, self.params, self.first, self.last, self.since, self.until = query, params, first, last, since, until


def source(
    fetch: Fetch,
    name: str = "casequarry_search",
    count: Callable[[dict[str, str]], int] | None = None,
    newest: Callable[[dict[str, str]], int] | None = None,
    page_size: int = 20,
    pages: int = 50,
) -> type[DataSource]:
    """A data source class for ``spark.dataSource.register``; options: queries (JSON list), max_items.

    Equalities on FILTERED go to the service, and Spark checks the rest.  A service that tells how many hits a
    query has (``count``) takes page numbers as addresses: a partition then is a range of ``pages`` pages.  One
    whose hits have rising ids (``newest`` tells the highest) can be read as a stream: offsets are ids, so a
    restarted stream asks for no page twice.
    """
    columns = [f.name for f in schemas.schema("search_hit")]

    def rows(part: Pages, most: int) -> Iterator[tuple]:
        params = {"q": part.query, "order_by": "score desc"} | part.params
        if part.since is not None:
            params |= {"order_by": "id asc", "after": str(part.since), "until": str(part.until)}
        if part.last is None:
            hits = paged(fetch, params, most)
        else:
            hits = (hit for page in range(part.first, part.last) for n, hit in enumerate(fetch(str(page), params)[0]) if page * page_size + n < most)
        for hit in hits:
            yield tuple(hit.get(c) for c in columns)

    class Reader(DataSourceReader):
        def __init__(self, options: dict[str, str]):
            self.queries = json.loads(options.get("queries", '[""]'))
            self.most = int(options.get("max_items", "100"))
            self.params: dict[str, str] = {}

        def pushFilters(self, filters):
            for f in filters:
                if isinstance(f, EqualTo) and len(f.attribute) == 1 and f.attribute[0] in FILTERED and f.attribute[0] not in self.params:
                    self.params[f.attribute[0]] = str(f.value)
                else:
                    yield f

        def partitions(self) -> list[InputPartition]:
            if count is None:
                return [Pages(q, self.params) for q in self.queries]
            out: list[InputPartition] = []
            for q in self.queries:
                total = -(-min(self.most, count({"q": q} | self.params)) // page_size)
                out += [Pages(q, self.params, first, min(total, first + pages)) for first in range(0, total, pages)]
            return out

        def read(self, partition: Pages) -> Iterator[tuple]:
            return rows(partition, self.most)

    class Stream(DataSourceStreamReader):
        """Offsets are the highest id of each query that was read."""

        def __init__(self, options: dict[str, str]):
            self.queries = json.loads(options.get("queries", '[""]'))

        def initialOffset(self) -> dict:
            return dict.fromkeys(self.queries, 0)

        def latestOffset(self) -> dict:
            return {q: newest({"q": q}) for q in self.queries}

        def partitions(self, start: dict, end: dict) -> list[InputPartition]:
            return [Pages(q, {}, since=start.get(q, 0), until=end[q]) for q in self.queries if end[q] > start.get(q, 0)]

        def read(self, partition: Pages) -> Iterator[tuple]:
            return rows(partition, 1 << 62)

    class Search(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return schemas.ddl("search_hit")

        def reader(self, schema) -> DataSourceReader:
            return Reader(self.options)

        def streamReader(self, schema) -> DataSourceStreamReader:
            return Stream(self.options)

    return Search


def search(spark: SparkSession, fetch: Fetch, queries: list[str], max_items: int, **service) -> DataFrame:
    """Hits of queries, at most ``max_items`` of each; ``service`` as in ``source``."""
    made = source(fetch, **service)
    spark.dataSource.register(made)
    spark.conf.set(PUSHDOWN, "true")
    return spark.read.format(made.name()).option("queries", json.dumps(queries)).option("max_items", str(max_items)).load()


def search_stream(spark: SparkSession, fetch: Fetch, queries: list[str], newest: Callable[[dict[str, str]], int], name: str = "casequarry_search_stream") -> DataFrame:
    """Hits of queries as they come, by rising id."""
    spark.dataSource.register(source(fetch, name, newest=newest))
    return spark.readStream.format(name).option("queries", json.dumps(queries)).load()


def download(urls: DataFrame, get: Callable[[str], bytes], attempts: int = 3, backoff: float = BACKOFF) -> DataFrame:
    """Adds content and error to (candidates): the first that gives a PDF; fetched by an injected function.

    ``get`` raises ``Status`` for answers other than 200; a pending file is asked for again like a
    failed one, after a pause that doubles.
    """
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            contents, errors = [], []
            for candidates in batch.column("candidates").to_pylist():
                content, error = None, "no_pdf_url"
                for url, n in [(u, n) for u in candidates or [] for n in range(attempts)]:
                    if n:
                        time.sleep(backoff * 2 ** (n - 1))
                    try:
                        content = get(url)
                        error = None if content[:4] == b"%PDF" else "not_a_pdf"
                    except Status as e:
                        error = "pending" if e.code == PENDING else f"status: {e}"
                    except Exception as e:  # noqa: BLE001  a failed download is a result
                        error = f"{type(e).__name__}: {e}"
                    if error is None:
                        break
                contents.append(content if error is None else None)
                errors.append(error)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(contents, pa.binary()), pa.array(errors, pa.string())], names=[*batch.schema.names, "content", "error"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in urls.schema)
    return urls.mapInArrow(run, f"{fields}, content binary, error string")
