"""Walks over a site of reviews: a company's index, then each item's page with its pages of notes.

What a page says is read by ``functions.pages``; here is only which pages are asked for, and when to
stop. The fetch function is replaceable, so nothing needs a network to be tested.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from datetime import datetime, timezone

from ..functions import pages as page
from .config import Reviews
from .pages import REFUSED, RETRIED, RETRIES, Bucket, fetch

#: The most pages of an index, and of one item's notes, that are asked for.
MOST_INDEX_PAGES, MOST_NOTE_PAGES = 500, 1000


def get_page(url: str, bucket: Bucket, get=fetch, sleep: Callable[[float], None] = time.sleep) -> page.Node:
    """The parsed page; tries again as ``pages.get_json`` does."""
    for tried in range(RETRIES + 1):
        bucket.take()
        status, headers, body = get(url)
        if status == 200:
            return page.parse(body.decode("utf-8", "replace"))
        if status in REFUSED or status not in RETRIED or tried == RETRIES:
            raise OSError(f"{status} for {url}")
        told = headers.get("Retry-After", "")
        sleep(float(told) if told.isdigit() else 2.0**tried)
    raise OSError(url)


def index_links(base: str, slug: str, ask: Callable[[str], page.Node]) -> list[str]:
    """Links to the items of one company, each once, in the order of the index. Ends at a page without
    links of this company or without a next one."""
    found: dict[str, None] = {}
    for n in range(1, MOST_INDEX_PAGES + 1):
        root = ask(f"{base}/companies/{slug}/teas?page={n}")
        links = page.item_links(root, rf"/teas/{slug}/[^/?#]+")
        found.update(dict.fromkeys(links))
        if not links or not page.has_next(root):
            break
    return list(found)


def item(base: str, link: str, ask: Callable[[str], page.Node]) -> dict:
    """An item's fields with the notes of all its pages; a note that two pages show counts once."""
    root = ask(f"{base}{link}")
    told, notes, n = page.metadata(root), page.notes(root), 1
    while page.has_next(root) and n < MOST_NOTE_PAGES:
        n += 1
        root = ask(f"{base}{link}?page={n}")
        notes += page.notes(root)
    return {**told, "notes": list({x["note_id"]: x for x in reversed(notes)}.values())[::-1]}


def records(config: Reviews, run_id: str, limit: int | None = None, get=fetch, sleep: Callable[[float], None] = time.sleep) -> Iterator[tuple]:
    """Raw records (source, scraped_at, run_id, endpoint, record_index, external_id, payload) of all
    companies of the configuration. ``limit`` holds after the whole index is walked."""
    bucket, base = Bucket(config.rate, sleep=sleep), config.base_url.rstrip("/")
    ask = lambda url: get_page(url, bucket, get, sleep)
    links = [link for slug in config.slugs for link in index_links(base, slug, ask)]
    for i, link in enumerate(links[:limit]):
        body = json.dumps(item(base, link, ask), ensure_ascii=False, separators=(",", ":"))
        yield "reviews", datetime.now(timezone.utc), run_id, f"{base}{link}", i, link.rsplit("/", 1)[1], body
