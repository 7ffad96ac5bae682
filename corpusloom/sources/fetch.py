"""Fetchers for live sources, and the paginated feed as a Spark data source of one partition a page."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.ident import ORIGIN, SEARCH


class FetchError(RuntimeError):
    """A request failed."""


class Blocked(FetchError):
    """The site's firewall refused the request; a browser might pass."""


class Fetcher(Protocol):
    def get_text(self, url: str) -> str: ...

    def get_bytes(self, url: str) -> bytes: ...


class HttpFetcher:
    """Plain requests by urllib: 403 and 406 mean ``Blocked``, any other failure ``FetchError``."""

    def __init__(self, headers: dict[str, str] | None = None, timeout: float = 30):
        self.headers, self.timeout = headers or {}, timeout

    def get_bytes(self, url: str) -> bytes:
        import urllib.error
        import urllib.request

        try:
            with urllib.request.urlopen(urllib.request.Request(url, headers=self.headers), timeout=self.timeout) as answer:
                return answer.read()
        except urllib.error.HTTPError as e:
            kind = Blocked if e.code in (403, 406) else FetchError
            raise kind(f"HTTP {e.code} for {url}") from e
        except OSError as e:
            raise FetchError(f"{url}: {e}") from e

    def get_text(self, url: str) -> str:
        return self.get_bytes(url).decode("utf-8", "replace")


class FallbackFetcher:
    """The first fetcher; where it is blocked, once the second, which is made only then."""

    def __init__(self, first: Fetcher, second: Callable[[], Fetcher]):
        self.first, self.make, self.second = first, second, None

    def _try(self, what: str, url: str):
        try:
            return getattr(self.first, what)(url)
        except Blocked:
            self.second = self.second or self.make()
            return getattr(self.second, what)(url)

    def get_text(self, url: str) -> str:
        return self._try("get_text", url)

    def get_bytes(self, url: str) -> bytes:
        return self._try("get_bytes", url)


class SavedFetcher:
    """Answers saved by address, for runs without a network; an exception among them is raised."""

    def __init__(self, answers: dict[str, bytes | Exception]):
        self.answers = answers

    def get_bytes(self, url: str) -> bytes:
        if url not in self.answers:
            raise FetchError(f"nothing saved for {url}")
        got = self.answers[url]
        if isinstance(got, Exception):
            raise got
        return got

    def get_text(self, url: str) -> str:
        return self.get_bytes(url).decode("utf-8", "replace")


def delayed(fetcher: Fetcher, seconds: float) -> Fetcher:
    """A fetcher that waits after each request; none if ``seconds`` isn't positive."""
    if seconds <= 0:
        return fetcher

    class Delayed:
        def get_text(self, url: str) -> str:
            out = fetcher.get_text(url)
            time.sleep(seconds)
            return out

        def get_bytes(self, url: str) -> bytes:
            out = fetcher.get_bytes(url)
            time.sleep(seconds)
            return out

    return Delayed()


def search_address(year: int, size: int, page: int) -> str:
    from urllib.parse import urlencode

    query = urlencode({"types": "executive-orders", "fromDate": f"{year}-01-01", "toDate": f"{year}-12-31", "pageSize": size, "currentPage": page})
    return f"{ORIGIN}{SEARCH}?{query}"


class _Page(InputPartition):
    def __init__(self, year: int, page: int, body: str | None):
        self.year, self.page, self.body = year, page, body


def feed_source(make: Callable[[], Fetcher], from_year: int, to_year: int, page_size: int = 100) -> type[DataSource]:
    """A data source ``order_feed`` of (window_year, page, body): the first page of each year tells how many there are, and each
    further page is a partition that its task fetches. ``make`` makes a fetcher where it is needed. Bounds on window_year reach
    the source, and other years aren't asked for."""
    from .archive import Years

    class Reader(DataSourceReader):
        def __init__(self) -> None:
            self.years = Years(from_year, to_year)

        def pushFilters(self, filters):
            return [f for f in filters if f.attribute != ("window_year",) or not self.years.narrow(f)]

        def partitions(self) -> list[InputPartition]:
            fetcher, out = make(), []
            for year in self.years:
                body = fetcher.get_text(search_address(year, page_size, 1))
                out.append(_Page(year, 1, body))
                out += [_Page(year, p, None) for p in range(2, int(json.loads(body).get("totalPages") or 0) + 1)]
            return out

        def read(self, partition: InputPartition | None) -> Iterator[tuple]:
            if partition is None:  # no year is left
                return
            body = partition.body if partition.body is not None else make().get_text(search_address(partition.year, page_size, partition.page))
            yield partition.year, partition.page, body

    class Feed(DataSource):
        @classmethod
        def name(cls) -> str:
            return "order_feed"

        def schema(self) -> str:
            return "window_year int, page int, body string"

        def reader(self, schema) -> DataSourceReader:
            return Reader()

    return Feed


def feed_pages(spark: SparkSession, make: Callable[[], Fetcher], from_year: int, to_year: int, page_size: int = 100) -> DataFrame:
    """(window_year, page, results ...) of the feed over an inclusive range of years. Turns the session's filter pushdown for such
    sources on, so that a filter on window_year decides which pages are fetched."""
    from pyspark.sql import functions as F

    from .archive import PUSHDOWN
    from .tables import FEED

    spark.conf.set(PUSHDOWN, "true")

    spark.dataSource.register(feed_source(make, from_year, to_year, page_size))
    pages = spark.read.format("order_feed").load()
    return pages.withColumn("p", F.from_json("body", F.lit(f"struct<{FEED.replace(' int', ': int').replace('results array', 'results: array').replace('link string', 'link: string').replace('title string', 'title: string').replace('articleDate string', 'articleDate: string')}>"))).select("window_year", "page", "p.*")
