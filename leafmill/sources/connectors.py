"""Connectors to a wiki's REST interface, behind one small interface, with an offline backend.

A backend answers ``get(path, params) -> (status, body)``. Listings page through it in one of two modes. Network backends are given by the user; queries never
use one. ``WikiListing`` makes any backend a Spark data source with one partition per page id.
"""

from __future__ import annotations

import json
import random
import re
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Any, Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

ERROR_CHARS = 500


class Backend(Protocol):
    def get(self, path: str, params: dict[str, Any]) -> tuple[int, str]: ...


@dataclass
class Credentials:
    """Login of a backend: user and password, a cookie, or both. A cookie file's content takes the place of ``cookie``."""

    user: str = ""
    password: str = ""
    cookie: str = ""
    headers: dict[str, str] = field(default_factory=dict)

    def with_cookie_file(self, path: str) -> "Credentials":
        try:
            with open(path, encoding="utf-8") as f:
                return Credentials(self.user, self.password, f.read().strip(), self.headers)
        except OSError:
            return self


class RestError(RuntimeError):
    """A refused call, with the status and the start of the body."""

    def __init__(self, status: int, body: str):
        super().__init__(f"HTTP {status}: {body[:ERROR_CHARS]}")
        self.status = status


@dataclass
class Fixture:
    """An offline backend: answers from a dictionary by path and ``start``."""

    answers: dict[tuple[str, int], tuple[int, str]]

    def get(self, path: str, params: dict[str, Any]) -> tuple[int, str]:
        return self.answers.get((path, int(params.get("start", 0))), (404, ""))


def throttled(backend: Backend, low: float = 1.0, high: float = 3.0, sleep: Callable[[float], None] = time.sleep) -> Backend:
    """The backend with a random pause before each call."""

    class Paused:
        def get(self, path, params):
            sleep(random.uniform(low, high))
            return backend.get(path, params)

    return Paused()


def get_json(backend: Backend, path: str, params: dict[str, Any] | None = None) -> dict:
    """The decoded answer; an error for any status other than success."""
    status, body = backend.get(path, params or {})
    if not 200 <= status < 300:
        raise RestError(status, body)
    return json.loads(body)


def tolerant_json(backend: Backend, path: str, params: dict[str, Any] | None = None) -> tuple[int, dict | None]:
    """(status, decoded answer): None for a refused or missing page or one that isn't JSON. A call that fails without a status has status 0."""
    try:
        status, body = backend.get(path, params or {})
    except OSError:
        return 0, None
    if not 200 <= status < 300:
        return status, None
    try:
        return status, json.loads(body)
    except ValueError:
        return status, None


def try_json(backend: Backend, path: str, params: dict[str, Any] | None = None) -> dict | None:
    """The answer of :func:`tolerant_json` alone."""
    return tolerant_json(backend, path, params)[1]


def page_meta(backend: Backend, page_id: str, path: str = "/content/{id}") -> dict[str, Any]:
    """id, title, type and slug of a page; a missing or empty title is ``page_<id>``, a missing type ``page``."""
    data = get_json(backend, path.replace("{id}", page_id))
    return {"id": page_id, "title": data.get("title") or f"page_{page_id}", "type": data.get("type") or "page", "slug": data.get("slug")}


def following_start(link: str | None, start: int, limit: int) -> int | None:
    """The start of the next page: from the link, else ``start + limit`` where it names none; None without a link."""
    if not link:
        return None
    m = re.search(r"[?&]start=(\d+)(?:[&#]|$)", link)
    return int(m[1]) if m else start + limit


def linked_pages(backend: Backend, path: str, limit: int = 50) -> Iterator[tuple[int, int, dict]]:
    """(page number, position, item), following next links; ends where there is none, even after a full page."""
    start, number = 0, 0
    while start is not None:
        data = get_json(backend, path, {"start": start, "limit": limit})
        for pos, item in enumerate(data.get("results") or []):
            yield number, pos, item
        start, number = following_start((data.get("_links") or {}).get("next"), start, limit), number + 1


def counted_pages(backend: Backend, path: str, limit: int = 50) -> Iterator[tuple[int, int, dict]]:
    """(page number, position, item) until a page is empty, short or refused."""
    start, number = 0, 0
    while True:
        part = (tolerant_json(backend, path, {"start": start, "limit": limit})[1] or {}).get("results") or []
        for pos, item in enumerate(part):
            yield number, pos, item
        if len(part) < max(1, limit):
            return
        start, number = start + len(part), number + 1


def fetch_page(fetch: Callable[[str, int], tuple[str, str]], page_id: str, strategies: int = 2, pause: Callable[[float], None] = time.sleep) -> tuple[str, str, str, int]:
    """(title, markdown, error, strategy): tries strategies in order until one gives Markdown that isn't blank; keeps the last error.

    Between strategies it waits 1.5 s and half a second more for each one tried.
    """
    error = ""
    for k in range(max(1, min(2, strategies))):
        if k:
            pause(1.5 + 0.5 * (k - 1))
        try:
            title, markdown = fetch(page_id, k)
            if markdown and markdown.strip():
                return title, markdown, "", k
            error = "blank Markdown"
        except Exception as e:  # noqa: BLE001 - the next strategy is the remedy
            error = str(e)
    return f"page_{page_id}", "", error, max(1, min(2, strategies)) - 1


def with_login(backend_of: Callable[["Credentials"], Backend], credentials: "Credentials", login: Callable[["Credentials"], "Credentials"] | None = None) -> Backend:
    """A backend with credentials, renewed once by the login hook after a call was refused with 401 or 403."""

    class Session:
        def __init__(self):
            self.inner, self.renewed = backend_of(credentials), False

        def get(self, path, params):
            status, body = self.inner.get(path, params)
            if status in (401, 403) and login and not self.renewed:
                self.renewed, self.inner = True, backend_of(login(credentials))
                status, body = self.inner.get(path, params)
            return status, body

    return Session()


def children_of(parents: DataFrame, make_backend: Callable[[], Backend], path: str = "/content/{id}/child/page", limit: int = 50) -> DataFrame:
    """(tree_id, parent_id, id, pos, title, node_type, slug): the children of each parent (tree_id, id), listed where the parents are. A page without children gives none."""

    def run(batches):
        backend = make_backend()
        for pdf in batches:
            rows = []
            for tree, parent in zip(pdf["tree_id"], pdf["id"]):
                for place, (_, _, item) in enumerate(linked_pages(backend, path.replace("{id}", parent), limit)):
                    if item.get("id") is not None:
                        own = str(item["id"])
                        rows.append((tree, parent, own, place, item.get("title") or f"page_{own}", item.get("type") or "page", item.get("slug")))
            yield pd.DataFrame(rows, columns=["tree_id", "parent_id", "id", "pos", "title", "node_type", "slug"])

    return parents.select("tree_id", "id").mapInPandas(run, "tree_id string, parent_id string, id string, pos int, title string, node_type string, slug string")


def pages_of(nodes: DataFrame, make_fetch: Callable[[], Callable[[str, int], tuple[str, str]]], strategies: int = 2, pause: Callable[[float], None] = time.sleep) -> DataFrame:
    """The attempts table (page_id, tree_id, strategy_idx, title, markdown, error) of nodes (tree_id, id), fetched where the nodes are."""

    def run(batches):
        fetch = make_fetch()
        for pdf in batches:
            rows = [(p, t, k, title, markdown, error) for t, p in zip(pdf["tree_id"], pdf["id"]) for title, markdown, error, k in [fetch_page(fetch, p, strategies, pause)]]
            yield pd.DataFrame(rows, columns=["page_id", "tree_id", "strategy_idx", "title", "markdown", "error"])

    return nodes.select("tree_id", "id").mapInPandas(run, "page_id string, tree_id string, strategy_idx int, title string, markdown string, error string")


class _Page(InputPartition):
    def __init__(self, page_id: str):
        self.page_id = page_id


class _ListingReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = options

    def partitions(self):
        return [_Page(p) for p in self.options.get("ids", "").split(",") if p]

    def read(self, partition):
        backend = BACKENDS[self.options.get("backend", "fixture")](self.options)
        pages = counted_pages if self.options.get("mode", "linked") == "counted" else linked_pages
        for number, pos, item in pages(backend, self.options.get("path", "/child/page").replace("{id}", partition.page_id), int(self.options.get("limit", "50"))):
            links = item.get("_links") or {}
            yield partition.page_id, number, pos, "" if item.get("id") is None else str(item["id"]), item.get("title"), item.get("type"), links.get("download")


def _fixture(options: dict[str, str]) -> Backend:
    raw = json.loads(options.get("answers", "[]"))
    return Fixture({(a["path"], int(a.get("start", 0))): (int(a.get("status", 200)), json.dumps(a["body"])) for a in raw})


#: Backends by name, made from the reader's options. Register a network backend here in user code.
BACKENDS: dict[str, Callable[[dict[str, str]], Backend]] = {"fixture": _fixture}


class WikiListing(DataSource):
    """``spark.read.format("wiki_listing")`` with options ids, path, mode (linked, counted), limit, backend and the backend's own."""

    @classmethod
    def name(cls) -> str:
        return "wiki_listing"

    def schema(self) -> str:
        return "parent_id string, page_no int, pos int, id string, title string, type string, download string"

    def reader(self, schema):
        return _ListingReader(dict(self.options))
