"""A paged JSON API as a Spark data source: one partition for each offset."""

from __future__ import annotations

import hashlib
import json
import random
import time
from collections import deque
from collections.abc import Iterator
from urllib.error import HTTPError
from urllib.parse import urlencode
from urllib.request import urlopen

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader

#: Where APIs put their records and the total.
RECORD_FIELDS = ("data", "results", "items", "personas", "records")
TOTAL_FIELDS = ("total", "count", "total_count", "totalCount")
RETRIED = (429, 500, 502, 503, 504)
MAX_PAGES = 100_000


def backoff_delay(attempt: int, base: float = 1.0, most: float = 60.0) -> float:
    return min(base * 2 ** (attempt - 1), most) + random.random()


class RateLimiter:
    """At most so many calls of wait in any minute; one a process, so a cluster asks at most that many times its tasks."""

    def __init__(self, per_minute: int | None, clock=time.monotonic, sleep=time.sleep):
        self.most, self.clock, self.sleep = per_minute, clock, sleep
        self.calls: deque[float] = deque()

    def wait(self) -> None:
        if not self.most:
            return
        while True:
            now = self.clock()
            while self.calls and now - self.calls[0] >= 60:
                self.calls.popleft()
            if len(self.calls) < self.most:
                self.calls.append(now)
                return
            self.sleep(60 - (now - self.calls[0]))


def page_hash(body) -> str:
    """SHA-256 of a page's compact JSON with sorted keys."""
    return hashlib.sha256(json.dumps(body, ensure_ascii=False, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def get_json(url: str, params: dict, tries: int = 5, timeout: float = 25.0, wait=time.sleep, fetch=urlopen):
    """The body as JSON; waits and tries again after errors that may pass."""
    for attempt in range(1, tries + 1):
        try:
            with fetch(f"{url}?{urlencode(params)}" if params else url, timeout=timeout) as answer:
                return json.loads(answer.read())
        except HTTPError as error:
            if error.code not in RETRIED or attempt == tries:
                raise
        except OSError:
            if attempt == tries:
                raise
        wait(backoff_delay(attempt))


def records_and_total(body) -> tuple[list, int | None, bool]:
    """The records, the total where it is known, and whether the shape was recognised."""
    if isinstance(body, list):
        return body, None, True
    if not isinstance(body, dict):
        return [], None, False
    total = next((body[k] for k in TOTAL_FIELDS if isinstance(body.get(k), int) and not isinstance(body.get(k), bool)), None)
    field = next((k for k in RECORD_FIELDS if isinstance(body.get(k), list)), None)
    return (body[field] if field else []), total, field is not None or not body


def page_size_of(returned: int, probed: int, default: int) -> int:
    """What the server gives at most: the default of an empty page, the probe if it was filled, else what came."""
    return default if returned == 0 else min(returned, probed)


class Offset(InputPartition):
    def __init__(self, offset: int, limit: int, until_short: bool = False):
        self.offset, self.limit, self.until_short = offset, limit, until_short


class PagedJsonReader(DataSourceReader):
    def __init__(self, options: dict):
        self.url = options["url"]
        self.default, self.probe = int(options.get("pageSize", "100")), int(options.get("probeLimit", "100"))
        self.params = json.loads(options.get("params", "{}"))
        self.per_minute, self.limiter = int(options.get("perMinute", "0")), None

    def _page(self, offset: int, limit: int):
        if self.limiter is None:
            self.limiter = RateLimiter(self.per_minute)
        self.limiter.wait()
        return get_json(self.url, self.params | {"limit": limit, "offset": offset})

    def partitions(self) -> list[Offset]:
        records, total, _ = records_and_total(self._page(0, self.probe))
        size = page_size_of(len(records), self.probe, self.default)
        if total is None:
            return [Offset(0, size, until_short=True)]
        return [Offset(o, size) for o in range(0, max(total, 1), size)]

    def __getstate__(self):
        return self.__dict__ | {"limiter": None}

    def read(self, partition: Offset) -> Iterator[tuple]:
        offset = partition.offset
        for _ in range(MAX_PAGES):
            body = self._page(offset, partition.limit)
            records, total, known = records_and_total(body)
            digest = page_hash(body)
            for i, record in enumerate(records):
                yield self.url, offset, partition.limit, i, total, known, digest, json.dumps(record, ensure_ascii=False, sort_keys=True, separators=(",", ":"))
            if not partition.until_short or len(records) < partition.limit:
                break
            offset += len(records)


class PagedJson(DataSource):
    """spark.read.format("paged_json").option("url", ...).load(): a row for each record, its page and its JSON. A failing page fails its task, which Spark repeats; no page is skipped."""

    @classmethod
    def name(cls) -> str:
        return "paged_json"

    def schema(self) -> str:
        return "source_url string, offset long, page_limit long, pos long, total long, schema_recognised boolean, content_hash string, record string"

    def reader(self, schema) -> PagedJsonReader:
        return PagedJsonReader(self.options)


#: Where a search answer keeps its records and the next page's token, and under what name the token is sent.
SEARCH_RECORDS, SEARCH_META, NEXT_TOKEN = "data", "meta", "next_token"


def next_token(body) -> str | None:
    meta = body.get(SEARCH_META) if isinstance(body, dict) else None
    token = meta.get(NEXT_TOKEN) if isinstance(meta, dict) else None
    return token if isinstance(token, str) and token else None


def search_params(options: dict) -> dict:
    """Query, page size and, unless it is the beginning of time, the newest record's time that was seen before."""
    params = {"query": options["query"], "max_results": int(options.get("maxResults", "100"))} | json.loads(options.get("params", "{}"))
    after = options.get("updatedAfter", "")
    return params | ({"start_time": after} if after and not after.startswith("1970-") else {})


def token_pages(url: str, params: dict, pages: int, token: str | None = None, fetch=get_json) -> Iterator[tuple[int, dict | list, str | None]]:
    """(page, body, next token) of at most so many pages, each asked for with the token of the one before."""
    for page in range(1, pages + 1):
        body = fetch(url, params | ({NEXT_TOKEN: token} if token else {}))
        token = next_token(body)
        yield page, body, token
        if token is None:
            return


def _search_rows(url: str, page: int, body) -> Iterator[tuple]:
    records = body.get(SEARCH_RECORDS) if isinstance(body, dict) else None
    records, digest = (records if isinstance(records, list) else []), page_hash(body)
    for i, record in enumerate(records):
        yield url, page, i, len(records), digest, json.dumps(record, ensure_ascii=False, sort_keys=True, separators=(",", ":"))


class TokenPagedReader(DataSourceReader):
    """A page's token comes with the page before, so one task reads them all; maxPages bounds it."""

    def __init__(self, options: dict):
        self.url, self.params, self.pages = options["url"], search_params(options), int(options.get("maxPages", "2"))

    def read(self, partition) -> Iterator[tuple]:
        for page, body, _ in token_pages(self.url, self.params, self.pages):
            yield from _search_rows(self.url, page, body)


class TokenPagedStream(SimpleDataSourceStreamReader):
    """The same as a stream: the offset is the next page's token, so a run goes on where the last one ended."""

    def __init__(self, options: dict):
        self.url, self.params, self.pages = options["url"], search_params(options), int(options.get("maxPages", "2"))

    def initialOffset(self) -> dict:
        return {"token": "", "page": 0, "done": False}

    def _from(self, start: dict) -> tuple[list[tuple], dict]:
        rows, at = [], dict(start)
        if start["done"]:
            return rows, at
        for page, body, token in token_pages(self.url, self.params, self.pages, start["token"] or None):
            rows += _search_rows(self.url, start["page"] + page, body)
            at = {"token": token or "", "page": start["page"] + page, "done": token is None}
        return rows, at

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        rows, at = self._from(start)
        return iter(rows), at

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        return iter(self._from(start)[0])


class TokenPaged(DataSource):
    """spark.read or readStream.format("token_paged"), with the options url, query and maxPages: a row for each record of a search whose pages are linked by tokens."""

    @classmethod
    def name(cls) -> str:
        return "token_paged"

    def schema(self) -> str:
        return "source_url string, page int, pos int, records_in_page int, content_hash string, record string"

    def reader(self, schema) -> TokenPagedReader:
        return TokenPagedReader(self.options)

    def simpleStreamReader(self, schema) -> TokenPagedStream:
        return TokenPagedStream(self.options)
