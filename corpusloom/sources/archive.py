"""The archive's capture index as a Spark data source that asks only for what a query needs.

The index answers a prefix query with lines of seven fields, at most so many at a time; an answer that isn't the last ends with
an empty line and a key from which the next one resumes. A partition is a year of captures, whose task follows the resume keys. Filters reach
the source: years decide which partitions there are, a range or prefix of keys (``tables.captures``) what is asked for, and type and
status go along with each request.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from datetime import datetime, timedelta, timezone
from urllib.parse import urlencode

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, StringStartsWith,
)

from .fetch import Fetcher
from .tables import CAPTURE

# Fixed value: the index's address.
INDEX_ADDRESS = "https://web.archive.org/cdx/search/cdx"
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


def address_of(key: str) -> str:
    """The address prefix that a prefix of archive keys stands for."""
    host, _, path = key.partition(")")
    return ".".join(reversed(host.split(","))) + path


def index_address(prefix: str, year: int, filters: list[str], size: int, resume: str | None) -> str:
    query = [("url", prefix), ("matchType", "prefix"), ("from", f"{year}0101000000"), ("to", f"{year}1231235959"), *(("filter", f) for f in filters), ("limit", size), ("showResumeKey", "true")]
    return f"{INDEX_ADDRESS}?{urlencode([*query, ('resumeKey', resume)] if resume else query)}"


def parse_captures(text: str) -> tuple[list[tuple], str | None]:
    """(rows, resume key) of an answer; the key is None if it is the last."""
    lines, key = text.splitlines(), None
    if len(lines) >= 2 and not lines[-2].strip():
        key, lines = lines[-1].strip(), lines[:-2]
    number = lambda x: int(x) if x.isdigit() else None
    rows = []
    for line in lines:
        parts = line.split(" ")
        if len(parts) == 7 and len(parts[1]) == 14 and parts[1].isdigit():
            at = datetime.strptime(parts[1], "%Y%m%d%H%M%S").replace(tzinfo=timezone.utc)
            rows.append((parts[0], at, parts[2], parts[3], number(parts[4]), parts[5], number(parts[6])))
    return rows, key


class Years:
    """A range of whole numbers that filters narrow; each is a bound or a list."""

    def __init__(self, low: int, high: int):
        self.low, self.high, self.only = low, high, None

    def narrow(self, f: Filter, value=lambda v: v) -> bool:
        """Whether ``f`` is a bound on the number, which then holds."""
        if isinstance(f, EqualTo):
            self.low, self.high = max(self.low, value(f.value)), min(self.high, value(f.value))
        elif isinstance(f, In):
            own = {value(v) for v in f.value}
            self.only = own if self.only is None else self.only & own
        elif isinstance(f, GreaterThanOrEqual | GreaterThan):
            self.low = max(self.low, value(f.value) + (isinstance(f, GreaterThan) and value(f.value) == f.value))
        elif isinstance(f, LessThanOrEqual | LessThan):
            self.high = min(self.high, value(f.value) - (isinstance(f, LessThan) and value(f.value) == f.value))
        else:
            return False
        return True

    def __iter__(self) -> Iterator[int]:
        return (y for y in range(self.low, self.high + 1) if self.only is None or y in self.only)


class _Year(InputPartition):
    def __init__(self, year: int):
        self.year = year


def archive_source(make: Callable[[], Fetcher], prefix: str, from_year: int, to_year: int, page_size: int = 10_000) -> type[DataSource]:
    """A data source ``order_captures`` of captures (CAPTURE) under an address prefix, of an inclusive range of years."""

    class Reader(DataSourceReader):
        def __init__(self) -> None:
            self.years, self.prefix, self.asked = Years(from_year, to_year), prefix, []

        def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
            low = next((f.value for f in filters if isinstance(f, GreaterThanOrEqual) and f.attribute == ("urlkey",)), None)
            high = next((f.value for f in filters if isinstance(f, LessThan) and f.attribute == ("urlkey",)), None)
            starts = [f.value for f in filters if isinstance(f, StringStartsWith) and f.attribute == ("urlkey",)]
            if low and high and high == low[:-1] + chr(ord(low[-1]) + 1):
                starts.append(low)
            for key in starts:  # only a narrower prefix is asked for
                if ")" in key and address_of(key).startswith(self.prefix.removeprefix("www.")):
                    self.prefix = address_of(key)
            for f in filters:
                if f.attribute == ("timestamp",):
                    before = timedelta(microseconds=1) if isinstance(f, LessThan) else timedelta()
                    self.years.narrow(f, lambda v, before=before: (v.astimezone(timezone.utc) - before).year)
                elif isinstance(f, EqualTo) and f.attribute in (("mimetype",), ("statuscode",)):
                    self.asked.append(f"{f.attribute[0]}:{f.value}")
                yield f  # Spark still tests each: years and prefixes are coarser than what is asked

        def partitions(self) -> list[InputPartition]:
            return [_Year(y) for y in self.years]

        def read(self, partition: InputPartition | None) -> Iterator[tuple]:
            if partition is None:  # no year is left
                return
            fetcher, resume = make(), None
            while True:
                rows, resume = parse_captures(fetcher.get_text(index_address(self.prefix, partition.year, self.asked, page_size, resume)))
                yield from rows
                if resume is None:
                    return

    class Captures(DataSource):
        @classmethod
        def name(cls) -> str:
            return "order_captures"

        def schema(self) -> str:
            return CAPTURE

        def reader(self, schema) -> DataSourceReader:
            return Reader()

    return Captures


def archive_captures(spark: SparkSession, make: Callable[[], Fetcher], prefix: str, from_year: int, to_year: int, page_size: int = 10_000) -> DataFrame:
    """Captures (CAPTURE) under ``prefix``, read when and as far as they are needed; urlkey is the archive's, so ``tables.captures`` may take
    them as keyed. Turns the session's filter pushdown for such sources on."""
    spark.conf.set(PUSHDOWN, "true")
    spark.dataSource.register(archive_source(make, prefix, from_year, to_year, page_size))
    return spark.read.format("order_captures").load()
