"""Harvesting: a paginated search source, and rate-limited, retried fetches of single documents.

The network is the caller's: a fetcher is a plain function that is pickled to the
tasks, so tests and offline runs inject their own.
"""

from __future__ import annotations

import threading
import time
from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from queue import Empty, SimpleQueue

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tessera.schemas import PAPER_DETAIL, SEARCH_RECORD

PAGE_SIZE, FIRST_CURSOR = 25, "*"

def pages(fetch: Callable, query: str, most: int | None = None, count: int = PAGE_SIZE, pause: float = 0.0) -> Iterator[dict]:
    """Records of all pages, until a bad status, an empty page, no further cursor, or ``most`` records."""
    cursor, given = FIRST_CURSOR, 0
    while cursor:
        code, records, cursor = fetch(query, cursor, count)
        if code != 200 or not records:
            return
        for r in records:
            if most is not None and given >= most:
                return
            yield r
            given += 1
        if pause:
            time.sleep(pause)


@dataclass
class _Query(InputPartition):
    query: str


def search_source(fetch: Callable, format_name: str = "literature_search") -> type[DataSource]:
    """A data source for ``spark.read.format(format_name)`` with options ``queries`` (one a line) and ``max_results``.

    ``fetch(query, cursor, count) -> (status, records, next_cursor)``.  Every query is a partition; its pages
    follow each other by cursor.
    """

    class SearchSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return format_name

        def schema(self) -> str:
            return SEARCH_RECORD

        def reader(self, schema) -> DataSourceReader:
            return _SearchReader(fetch, self.options)

    return SearchSource


class _SearchReader(DataSourceReader):
    def __init__(self, fetch: Callable, options: dict):
        self.fetch = fetch
        self.queries = [q for q in options.get("queries", "").split("\n") if q.strip()]
        self.most = int(options["max_results"]) if "max_results" in options else None

    def partitions(self) -> list[InputPartition]:
        return [_Query(q) for q in self.queries]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        for r in pages(self.fetch, partition.query, self.most):
            cited = str(r.get("citedby-count", "0"))
            yield (
                r.get("eid"), r.get("prism:doi"), r.get("dc:title"), r.get("prism:publicationName"), r.get("prism:coverDate"),
                int(cited) if cited.isdigit() else None, str(r.get("openaccess", "0")),
            )


def register(spark: SparkSession, fetch: Callable, format_name: str = "literature_search") -> None:
    spark.dataSource.register(search_source(fetch, format_name))


class SlidingWindowLimiter:
    """At most ``rate`` calls in any window of ``window`` seconds, for the threads of one task."""

    def __init__(self, rate: int, window: float = 1.0, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.rate, self.window, self.clock, self.sleep = rate, window, clock, sleep
        self.calls: deque[float] = deque()
        self.lock = threading.Lock()

    def acquire(self) -> None:
        while True:
            with self.lock:
                now = self.clock()
                while self.calls and now - self.calls[0] >= self.window:
                    self.calls.popleft()
                if len(self.calls) < self.rate:
                    self.calls.append(now)
                    return
                pause = self.window - (now - self.calls[0])
            self.sleep(pause)


class Throttled(Exception):
    """The service asks to slow down."""


class Refused(Exception):
    """The service will not serve this request; trying again is no use."""


def with_retries(call: Callable[[], object], attempts: int = 3, sleep: Callable[[float], None] = time.sleep) -> tuple[object, str | None]:
    """The result, or the last error: throttling backs off ``2^n + 2`` seconds, other errors 2 seconds, refusals not at all."""
    error = None
    for n in range(attempts):
        try:
            return call(), None
        except Refused as e:
            return None, str(e)
        except Throttled as e:
            error, pause = str(e) or "throttled", 2**n + 2
        except Exception as e:  # noqa: BLE001
            error, pause = f"{type(e).__name__}: {e}", 2
        if n + 1 < attempts:
            sleep(pause)
    return None, error


def within(call: Callable[[], object], seconds: float | None) -> object:
    """The result of a call, or TimeoutError if it takes longer; a call that is given up runs on in a thread of its own."""
    if seconds is None:
        return call()
    replies: SimpleQueue = SimpleQueue()

    def run() -> None:
        try:
            replies.put((call(), None))
        except BaseException as e:  # noqa: BLE001
            replies.put((None, e))

    threading.Thread(target=run, daemon=True).start()
    try:
        result, error = replies.get(timeout=seconds)
    except Empty:
        raise TimeoutError(f"no reply in {seconds:g} s") from None
    if error is not None:
        raise error
    return result


def fetch_all(keys: DataFrame, fetch: Callable[[str], str], key: str = "doi", rate: int = 8, tasks: int = 1, attempts: int = 3, sleep: Callable[[float], None] = time.sleep, workers: int = 10, timeout: float | None = 180.0) -> DataFrame:
    """``key, body, status, error`` of one fetch per key: 1 fetched, 2 failed, 3 throttled or timed out.

    Each task fetches with ``workers`` threads, and gives a try up after ``timeout`` seconds (None: never).

    ``tasks`` tasks share the rate: each keeps its own sliding window, longer than a second where there are more tasks than calls.  Every try counts.
    """
    share = max(1, rate // tasks)
    window = share * tasks / rate

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        limiter = SlidingWindowLimiter(share, window)

        def one(k: str) -> tuple:
            seen: list[BaseException] = []

            def call() -> object:
                limiter.acquire()
                try:
                    return within(lambda: fetch(k), timeout)
                except (Throttled, TimeoutError) as e:
                    seen.append(e)
                    raise

            body, error = with_retries(call, attempts, sleep)
            return k, body, 1 if error is None else 3 if seen else 2, error

        with ThreadPoolExecutor(workers) as pool:
            for part in parts:
                for at in range(0, len(part), 64 * workers):
                    yield pd.DataFrame(pool.map(one, part[key].iloc[at : at + 64 * workers]), columns=[key, "body", "status", "error"])

    return keys.select(key).repartition(tasks).mapInPandas(run, f"{key} string, body string, status int, error string")


DETAIL_FIELDS = [f.split()[0] for f in PAPER_DETAIL.split(", ")]


def fetch_details(keys: DataFrame, fetch: Callable[[str], dict], key: str = "eid") -> DataFrame:
    """Detail records; a failed fetch is a row with ``error`` and nothing else but the key."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for k in part[key]:
                try:
                    r = fetch(k)
                    names = [a for a in r.get("authors", []) if isinstance(a, str) and a]
                    row = dict.fromkeys(DETAIL_FIELDS) | {f: r.get(f) for f in DETAIL_FIELDS if f in r}
                    row |= {"eid": k, "authors": "; ".join(names[:10]), "author_count": len(names), "abstract": r["description"] if "description" in r else r.get("abstract")}
                except Exception as e:  # noqa: BLE001
                    row = dict.fromkeys(DETAIL_FIELDS) | {"eid": k, "error": f"{type(e).__name__}: {e}"}
                out.append(row)
            yield pd.DataFrame(out, columns=DETAIL_FIELDS)

    return keys.select(key).mapInPandas(run, PAPER_DETAIL)
