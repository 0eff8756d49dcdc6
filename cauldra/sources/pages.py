"""Paginated JSON catalogues as a Spark data source: one input partition per shop.

``spark.dataSource.register(CatalogSource)``, then ``spark.read.format("catalog_pages").options(
shops='{"key": "https://..."}', run_id=...).load()``. Requests are rate limited per host and retried;
the fetch function is replaceable, so nothing here needs a network to be tested.
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from datetime import datetime, timezone

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Answers that a retry may change, and those that end a shop's run.
RETRIED = frozenset((408, 425, 429, 500, 502, 503, 504))
REFUSED = frozenset((401, 403))
RETRIES, PAGE_SIZE, MOST_PAGES = 3, 250, 250


class Bucket:
    """A token bucket: ``rate`` requests a second, bursts of at least one."""

    def __init__(self, rate: float, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.rate, self.room, self.clock, self.sleep = rate, max(rate, 1.0), clock, sleep
        self.tokens, self.at = self.room, clock()

    def take(self) -> None:
        now = self.clock()
        self.tokens, self.at = min(self.room, self.tokens + (now - self.at) * self.rate), now
        if self.tokens < 1:
            wait = (1 - self.tokens) / self.rate
            self.sleep(wait)
            self.tokens, self.at = 1.0, self.clock()
        self.tokens -= 1


def fetch(url: str) -> tuple[int, dict, bytes]:
    try:
        with urllib.request.urlopen(urllib.request.Request(url, headers={"User-Agent": "cauldra"}), timeout=60) as r:
            return r.status, dict(r.headers), r.read()
    except urllib.error.HTTPError as e:
        return e.code, dict(e.headers or {}), b""


def get_json(url: str, bucket: Bucket, get=fetch, sleep: Callable[[float], None] = time.sleep):
    """The decoded answer; waits 1, 2, 4 seconds, or as the server says, between tries."""
    for tried in range(RETRIES + 1):
        bucket.take()
        status, headers, body = get(url)
        if status == 200:
            return json.loads(body)
        if status in REFUSED or status not in RETRIED or tried == RETRIES:
            raise OSError(f"{status} for {url}")
        told = headers.get("Retry-After", "")
        sleep(float(told) if told.isdigit() else 2.0**tried)


def records(source: str, base: str, run_id: str, rate: float = 2.0, get=fetch, sleep: Callable[[float], None] = time.sleep) -> Iterator[tuple]:
    """Raw records of a shop, page by page until an empty one. Items without id are left out."""
    bucket, index = Bucket(rate, sleep=sleep), 0
    for page in range(1, MOST_PAGES + 1):
        url = f"{base.rstrip('/')}/products.json?limit={PAGE_SIZE}&page={page}"
        items = get_json(url, bucket, get, sleep).get("products") or []
        if not items:
            return
        for item in items:
            if item.get("id") is not None:
                yield source, datetime.now(timezone.utc), run_id, url, index, str(item["id"]), json.dumps(item, ensure_ascii=False, separators=(",", ":"))
                index += 1


class Shop(InputPartition):
    def __init__(self, source: str, base: str):
        self.source, self.base = source, base


class CatalogReader(DataSourceReader):
    get = staticmethod(fetch)

    def __init__(self, options):
        self.options = dict(options)

    def partitions(self):
        return [Shop(k, v) for k, v in sorted(json.loads(self.options["shops"]).items())]

    def read(self, partition):
        yield from records(partition.source, partition.base, self.options.get("run_id", ""), float(self.options.get("rate", "2")), self.get)


class CatalogSource(DataSource):
    @classmethod
    def name(cls):
        return "catalog_pages"

    def schema(self):
        return "source string, scraped_at timestamp, run_id string, endpoint string, record_index int, external_id string, payload string"

    def reader(self, schema):
        return CatalogReader(self.options)
