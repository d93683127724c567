"""A paged content service as a Spark data source.

One input partition per page of the listing. Tasks share nothing, so each gets its share of the rate (`slots`, by
default one per page, so that the rate holds however many run at once); inside a task calls are spaced, retried with
backoff, and held back when the service asks for it. The transport is a name of a Python function or the built-in one, so that
tests and other services plug in theirs.
"""

from __future__ import annotations

import importlib
import json
import random
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from pathlib import Path
from typing import Any
from urllib import error, parse, request

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, InputPartition

from foliograph.session import cut

PAGE_SIZE = 500
Fetch = Callable[[str], tuple[int, dict[str, str], bytes]]


class FetchFailed(RuntimeError):
    """A required document that couldn't be had."""


def http_fetch(url: str) -> tuple[int, dict[str, str], bytes]:
    """(status, headers, body) of a URL; file: URLs are read from disk."""
    if url.startswith("file:"):
        path = Path(parse.urlparse(url).path)
        return (200, {}, path.read_bytes()) if path.exists() else (404, {}, b"")
    try:
        with request.urlopen(request.Request(url, headers={"User-Agent": "foliograph"}), timeout=60) as r:  # noqa: S310
            return r.status, dict(r.headers), r.read()
    except error.HTTPError as e:
        return e.code, dict(e.headers), e.read()


class Limiter:
    """Least spacing between the calls of one task, counted from the last one let through; penalise() holds all later
    ones back."""

    def __init__(self, rps: float, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.gap = 1.0 / rps if rps > 0 else 0.0
        self.clock, self.sleep = clock, sleep
        self.let_through = self.held_until = float("-inf")

    def wait(self) -> None:
        due = max(self.let_through + self.gap, self.held_until)
        if (early := due - self.clock()) > 0:
            self.sleep(early)
        self.let_through = max(due, self.clock())

    def penalise(self, seconds: float) -> None:
        self.held_until = max(self.held_until, self.clock() + seconds)


def retryable(status: int) -> bool:
    """Statuses worth another attempt: timeouts, conflicts, too many requests, and errors of the server."""
    return status in (408, 409, 429) or status >= 500


@dataclass(frozen=True)
class RetryPolicy:
    """How often and after which pauses a call is repeated. Attempts and the longest pause."""

    attempts: int = 8
    longest: float = 60.0

    def pauses(self, jitter: Callable[[], float]) -> Iterator[float]:
        """Doubling pauses, one less than there are attempts."""
        base = 1.0
        for _ in range(self.attempts - 1):
            yield min(self.longest, base + jitter())
            base *= 2


@dataclass(frozen=True)
class Outcome:
    """What a call came to; a broken connection has status 599."""

    status: int
    headers: dict[str, str]
    body: bytes

    @property
    def asked_pause(self) -> float | None:
        """Seconds the service wants to be left alone."""
        said = next((v for k, v in self.headers.items() if k.lower() == "retry-after"), "")
        return float(said) if said.isdigit() else None

    def document(self) -> Any:
        return json.loads(self.body) if self.status == 200 else None


class Fetcher:
    """JSON over a transport: 404 is None, retryable statuses are tried again under a policy, others end it."""

    def __init__(self, fetch: Fetch = http_fetch, limiter: Limiter | None = None, attempts: int = RetryPolicy.attempts, jitter: Callable[[], float] = random.random):
        self.fetch, self.limiter, self.policy, self.jitter = fetch, limiter or Limiter(0), RetryPolicy(attempts), jitter

    def call(self, url: str) -> Outcome:
        self.limiter.wait()
        try:
            return Outcome(*self.fetch(url))
        except OSError:
            return Outcome(599, {}, b"")

    def outcome(self, url: str) -> Outcome:
        """The last outcome: the first one that no repetition could mend, or that of the last attempt."""
        got = self.call(url)
        for pause in self.policy.pauses(self.jitter):
            if got.status == 200 or not retryable(got.status):
                break
            self.limiter.penalise(pause if got.asked_pause is None else got.asked_pause)
            got = self.call(url)
        return got

    def get_json(self, url: str, required: bool = False) -> dict[str, Any] | None:
        got = self.outcome(url)
        if required and got.status != 200:
            raise FetchFailed(f"{url}: status {got.status}")
        return got.document()


def fetch_pages(links: DataFrame, transport: str = f"{__name__}.http_fetch", rps: float = 12.0, tasks: int = 8) -> DataFrame:
    """(link, status, body, error) of each distinct link, fetched in `tasks` tasks that share the rate.

    body is the text of a success; error is null for it, `not_found` for 404, else `fetch_failed`. A failure is a row,
    never a failed task. Null links are left out.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fetcher = Fetcher(_named(transport), Limiter(rps / tasks))
        for batch in batches:
            got = [fetcher.outcome(link) for link in batch["link"]]
            error = [None if g.status == 200 else "not_found" if g.status == 404 else "fetch_failed" for g in got]
            yield pd.DataFrame({"link": batch["link"], "status": [g.status for g in got], "body": [g.body.decode("utf-8", "replace") if g.status == 200 else None for g in got], "error": error})

    return links.select("link").filter("link is not null").distinct().repartition(tasks).mapInPandas(run, "link string, status int, body string, error string")


def fetch_twice(links: DataFrame, transport: str = f"{__name__}.http_fetch", rps: float = 12.0, tasks: int = 8) -> DataFrame:
    """fetch_pages, and for what failed a second pass afterwards at a third of the rate (two a second at least) in half
    as many tasks. Pages that aren't there aren't asked for again."""
    first = cut(fetch_pages(links, transport, rps, tasks))
    failed = F.coalesce(F.col("error") == "fetch_failed", F.lit(False))
    return first.filter(~failed).unionByName(fetch_pages(first.filter(failed), transport, max(2.0, rps / 3), max(1, tasks // 2)))


def _named(name: str) -> Fetch:
    module, _, attr = name.rpartition(".")
    return getattr(importlib.import_module(module), attr)


@dataclass
class Page(InputPartition):
    start: int

    def __init__(self, start: int):
        self.start = start


class ListingReader(DataSourceReader):
    """Rows (link, title, format, start, position) of a search service: GET base?start=…&count=…[&filter_format=…]."""

    def __init__(self, options: dict[str, str]):
        self.base = options["path"] if "path" in options else options["url"]
        self.size = int(options.get("pagesize", PAGE_SIZE))
        self.rps, self.transport = float(options.get("rps", 12)), options.get("transport", f"{__name__}.http_fetch")
        self.format, self.slots = options.get("format_filter"), int(options.get("slots", 0))

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("format",):
                self.format = f.value
            yield f  # the service may match loosely, so Spark checks again

    def _url(self, start: int, count: int) -> str:
        wanted = {"start": start, "count": count} | ({"filter_format": self.format} if self.format and self.format != "all" else {})
        return f"{self.base}{'&' if '?' in self.base else '?'}{parse.urlencode(wanted)}"

    def _fetcher(self, share: int = 1) -> Fetcher:
        return Fetcher(_named(self.transport), Limiter(self.rps / max(1, share)))

    def partitions(self) -> list[InputPartition]:
        total = int((self._fetcher().get_json(self._url(0, 0), required=True) or {}).get("total", 0))
        self.pages = max(1, -(-total // self.size))
        return [Page(i * self.size) for i in range(self.pages)]

    def read(self, partition: Page) -> Iterator[tuple]:
        got = self._fetcher(self.slots or getattr(self, "pages", 1)).get_json(self._url(partition.start, self.size), required=True) or {}
        for i, doc in enumerate(got.get("results") or []):
            if doc.get("link"):
                yield doc["link"], doc.get("title"), doc.get("format"), partition.start, i


class Listing(DataSource):
    """spark.read.format("paged_listing").option("url", …): the listing of a paged search service."""

    @classmethod
    def name(cls) -> str:
        return "paged_listing"

    def schema(self) -> str:
        return "link string, title string, format string, start int, position int"

    def reader(self, schema: Any) -> DataSourceReader:  # noqa: ANN401
        return ListingReader(self.options)


def register(spark: SparkSession) -> None:
    """Makes the source known; its filters are pushed down only where the session allows Python sources to."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Listing)
