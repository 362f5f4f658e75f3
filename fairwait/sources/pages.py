"""Extraction from a paged JSON service, as a data source with one partition per slice of time.

A service gives one ordered page per call. The window is cut into slices: where the service counts, by
halving time until every slice holds few enough records, so a busy hour is many tasks. Each task
walks through the pages of its own slice with one page in memory.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass
from datetime import datetime, timedelta
from http.client import HTTPException
from urllib.error import HTTPError, URLError
from urllib.parse import urlencode
from urllib.request import Request, urlopen
from zlib import crc32

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# How the service is asked.
PAGE_SIZE = 50_000
ATTEMPTS = 5
LONGEST_WAIT = 30
TIMEOUT = 60

AT_ONCE = 16  # slices that are fetched at the same time
SLICE_PAGES = 4  # pages that a slice holds at most, where the service counts
SHORTEST = timedelta(milliseconds=1)  # the resolution of the service's times

# Condition, offset and size of a page; gives its records.
Fetch = Callable[[str, int, int], list[dict]]
# Condition; gives the number of its records.
Count = Callable[[str], int]


class SliceIncomplete(RuntimeError):
    """The pages of a slice hold another number of records than the service counts."""


@dataclass(frozen=True)
class Slice:
    """Records with ``low <= time < high``; with ``rows`` that many from ``offset`` on, else all there are."""

    low: str
    high: str
    offset: int = 0
    rows: int | None = None

    def condition(self, on: str) -> str:
        return f"{on} >= '{self.low}' AND {on} < '{self.high}'"


def _text(at: datetime) -> str:
    return at.isoformat(timespec="milliseconds" if at.microsecond else "auto")


def time_slices(start: str, end: str, hours: float) -> list[tuple[str, str]]:
    """Consecutive half-open slices of ``start <= t < end`` in ISO form."""
    low, stop = datetime.fromisoformat(start), datetime.fromisoformat(end)
    bounds = []
    while low < stop:
        high = min(low + timedelta(hours=hours), stop)
        bounds.append((low.isoformat(), high.isoformat()))
        low = high
    return bounds


def halved(count: Count, on: str, start: str, end: str, most: int, at_once: int = AT_ONCE) -> list[Slice]:
    """Slices of ``start <= on < end`` with ``most`` records each at most, by the service's own counts.

    A span with more is halved, and the left half is counted: the right half has the others. Spans of one depth are
    counted at the same time. Records of a single instant are dealt by offset.
    """
    spans = [(datetime.fromisoformat(start), datetime.fromisoformat(end))]
    spans = [span for span in spans if span[0] < span[1]]
    done: list[Slice] = []

    def ask(span: tuple[datetime, datetime]) -> int:
        return count(Slice(_text(span[0]), _text(span[1])).condition(on))

    with ThreadPoolExecutor(at_once) as pool:
        sized = list(zip(spans, pool.map(ask, spans)))
        while sized:
            wide = []
            for (low, high), n in sized:
                if n <= most:
                    done.append(Slice(_text(low), _text(high), 0, n))
                elif high - low <= SHORTEST:
                    done += [Slice(_text(low), _text(high), k, min(most, n - k)) for k in range(0, n, most)]
                else:
                    steps = max((high - low) // SHORTEST // 2, 1)
                    wide.append((low, low + steps * SHORTEST, high, n))
            halves = list(pool.map(ask, [(low, middle) for low, middle, _, _ in wide]))
            sized = [((low, middle), left) for (low, middle, _, _), left in zip(wide, halves)]
            sized += [((middle, high), max(n - left, 0)) for (_, middle, high, n), left in zip(wide, halves)]
    return sorted(done, key=lambda s: (datetime.fromisoformat(s.low), s.offset))


def walk(fetch: Fetch, condition: str, size: int) -> Iterator[list[dict]]:
    """Pages of one condition, up to and including the first short one."""
    offset = 0
    while page := fetch(condition, offset, size):
        yield page
        if len(page) < size:
            return
        offset += size


def slice_pages(fetch: Fetch, part: Slice, on: str, size: int) -> Iterator[list[dict]]:
    """Pages of one slice. Where its number of records is known, pages that are shorter than asked do not end it."""
    if part.rows is None:
        yield from walk(fetch, part.condition(on), size)
        return
    found = 0
    while found < part.rows:
        page = fetch(part.condition(on), part.offset + found, min(size, part.rows - found))
        if not page:
            return
        found += len(page)
        yield page


class PagePartition(InputPartition):
    """Slices, with their numbers, that one task walks through one after the other."""

    def __init__(self, number: int, parts: Sequence[tuple[int, Slice]]):
        super().__init__(number)
        self.parts = parts


class PageReader(DataSourceReader):
    """One task per slice; with the option ``tasks`` that many tasks, which are dealt the slices in turn.

    With the option ``report`` a slice ends with a row that says how many records it found and their checksum, or why it
    failed; it fails as a task only as long as Spark has attempts left. Such rows let the other slices' work count.
    """

    def __init__(self, source: PageSource):
        self.options = source.options
        self.calls = source.calls

    def partitions(self) -> Sequence[InputPartition]:
        chosen = self.options.get("slices")
        parts = [Slice(**s) for s in json.loads(chosen)] if chosen else self.planned()
        tasks = int(self.options.get("tasks", 0)) or len(parts)
        return [PagePartition(k, list(enumerate(parts))[k::tasks]) for k in range(min(tasks, len(parts)))]

    def planned(self) -> list[Slice]:
        o, (_, count) = self.options, self.calls(self.options)
        on, size = o.get("on", "created_date"), int(o.get("size", PAGE_SIZE))
        return halved(count, on, o["start"], o["end"], size * int(o.get("slice_pages", SLICE_PAGES)))

    def read(self, partition: PagePartition) -> Iterator[pa.RecordBatch]:
        for number, part in partition.parts:
            yield from self.read_slice(number, part)

    def read_slice(self, number: int, part: Slice) -> Iterator[pa.RecordBatch]:
        fetch, count = self.calls(self.options)
        on, size = self.options.get("on", "created_date"), int(self.options.get("size", PAGE_SIZE))
        reports = int(self.options.get("report", 0))
        found, checksum = 0, 0

        def batch(kind: str, lines: list[str]) -> pa.RecordBatch:
            columns = [pa.array(lines, pa.string())]
            if reports:
                n = len(lines)
                columns += [pa.array([number] * n, pa.int32()), pa.array([kind] * n, pa.string())]
            return pa.RecordBatch.from_arrays(columns, names=["value", "slice", "kind"][: len(columns)])

        try:
            for page in slice_pages(fetch, part, on, size):
                lines = [json.dumps(record) for record in page]
                found += len(lines)
                checksum += sum(crc32(line.encode()) for line in lines)
                yield batch("data", lines)
            # A part of an instant has its own number; any other slice is counted once more.
            within = part.rows is not None and datetime.fromisoformat(part.high) - datetime.fromisoformat(part.low) <= SHORTEST
            expected = part.rows if count is None or within else count(part.condition(on))
            if expected is not None and expected != found:
                raise SliceIncomplete(f"{found} of {expected} records where {part.condition(on)}")
        except Exception as failed:
            context = TaskContext.get()
            if not reports or context is not None and context.attemptNumber() + 1 < reports:
                raise
            yield batch("failed", [json.dumps(f"{type(failed).__name__}: {failed}")])
        else:
            if reports:
                yield batch("done", [json.dumps({"rows": found, "checksum": checksum})])


class PageSource(DataSource):
    """``spark.read.format("service_pages")`` with the options ``url``, ``start`` and ``end``, and if need be ``on``, ``size``
    and ``slice_pages``: records as JSON text, untouched, in the column ``value``."""

    @classmethod
    def name(cls) -> str:
        return "service_pages"

    @staticmethod
    def calls(options: dict) -> tuple[Fetch, Count | None]:
        return http_fetch(options["url"]), http_count(options["url"])

    def schema(self) -> str:
        return "value string, slice int, kind string" if int(self.options.get("report", 0)) else "value string"

    def reader(self, schema) -> DataSourceReader:
        return PageReader(self)


def registered(spark: SparkSession, fetch: Fetch, count: Count | None) -> str:
    """Name of a data source that asks by these two calls."""
    name = f"service_pages_{uuid.uuid4().hex}"
    members = {"name": classmethod(lambda cls: name), "calls": staticmethod(lambda options: (fetch, count))}
    spark.dataSource.register(type("CalledPageSource", (PageSource,), members))
    return name


def read_slices(
    spark: SparkSession, source: str, slices: Sequence[Slice], on: str, size: int, report: int = 0, tasks: int = 0
) -> DataFrame:
    asked = json.dumps([asdict(s) for s in slices])
    reader = spark.read.format(source).option("slices", asked).option("on", on).option("size", str(size))
    return reader.option("report", str(report)).option("tasks", str(tasks)).load()


def read_pages(
    spark: SparkSession,
    fetch: Fetch,
    start: str,
    end: str,
    on: str = "created_date",
    slice_hours: float = 24,
    size: int = PAGE_SIZE,
    count: Count | None = None,
) -> DataFrame:
    """Records with ``start <= on < end`` as JSON text, untouched, a task per slice.

    With ``count`` slices are halved until they hold ``SLICE_PAGES`` pages at most, and every slice is compared with the
    service's own number, since a walk ends early where the service gives shorter pages than it was asked for. Without it
    slices have ``slice_hours``, to be taken short enough for the busiest time. How many calls reach the service
    together is bounded by ``landing.land_slices``, not here.
    """
    slices = planned(start, end, on, slice_hours, size, count)
    return read_slices(spark, registered(spark, fetch, count), slices, on, size)


def planned(
    start: str, end: str, on: str, slice_hours: float, size: int, count: Count | None, at_once: int = AT_ONCE
) -> list[Slice]:
    if count is not None:
        return halved(count, on, start, end, size * SLICE_PAGES, at_once)
    return [Slice(low, high) for low, high in time_slices(start, end, slice_hours)]


def http_fetch(
    url: str, order: str = "created_date, sr_number", headers: dict[str, str] | None = None
) -> Fetch:
    """Pages from ``url``, with growing waits between attempts.

    ``order`` ends in a unique column, so that pages neither overlap nor leave gaps.
    """

    def fetch(condition: str, offset: int, size: int) -> list[dict]:
        asked = {"$limit": size, "$offset": offset, "$order": order, "$where": condition}
        return _ask(url, asked, headers, f"page at offset {offset}")

    return fetch


def http_count(url: str, headers: dict[str, str] | None = None) -> Count:
    """The number of records of a condition, as the service at ``url`` counts them."""


    def count(condition: str) -> int:
        asked = {"$select": "count(*) as n", "$where": condition}
        return int(_ask(url, asked, headers, "number of records")[0]["n"])

    return count


def _ask(url: str, parameters: dict, headers: dict[str, str] | None, what: str) -> list[dict]:
    asked = urlencode(parameters)
    for attempt in range(1, ATTEMPTS + 1):
        try:
            with urlopen(Request(f"{url}?{asked}", headers=headers or {}), timeout=TIMEOUT) as answer:
                return json.load(answer)
        except HTTPError as refused:
            if refused.code != 429 and refused.code < 500:  # asking again would not help
                raise
        except (URLError, HTTPException, TimeoutError, ConnectionError, json.JSONDecodeError):
            pass
        if attempt < ATTEMPTS:
            time.sleep(min(2**attempt, LONGEST_WAIT))
    raise RuntimeError(f"no {what} after {ATTEMPTS} attempts")
