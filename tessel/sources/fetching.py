"""Getting pages: what robots allow, what a cached body saves, and how PDFs become text.

The transport is a function, so that nothing here needs a network; politeness is kept by
the plan around it.
"""

from __future__ import annotations

import hashlib
import re
import time
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from urllib.parse import urljoin, urlsplit
from urllib.robotparser import RobotFileParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Seconds between requests to a host, redirects, bytes of a body.
INTERVAL, REDIRECTS, MOST_BYTES = 2.0, 5, 15 * 1024 * 1024
PRIVATE = re.compile(r"^(0|10|127|169\.254|192\.168|172\.(1[6-9]|2\d|3[01])|100\.(6[4-9]|[7-9]\d|1[01]\d|12[0-7])|22[4-9]|2[3-5]\d)\.")


@dataclass
class Response:
    status: int
    body: bytes = b""
    headers: dict[str, str] = field(default_factory=dict)


#: A request's URL and headers to its response; OSError where there is none.
Transport = Callable[[str, dict[str, str]], Response]


class Refused(Exception):
    """Robots, an address that must not be reached, or too large a body."""


def public(host: str) -> bool:
    h = host.lower().rstrip(".")
    internal = h in ("", "localhost") or ":" in h or re.search(r"\.(localhost|local|internal|lan|home|corp|intranet)$", h)
    return not internal and not (re.fullmatch(r"(\d{1,3}\.){3}\d{1,3}", h) and PRIVATE.match(h))


class Client:
    """A polite client: one pace for each host, robots first (refused if they can't be read), conditional, one retry."""

    def __init__(self, transport: Transport, agent: str, sleep: Callable[[float], None] = time.sleep, clock: Callable[[], float] = time.monotonic):
        self.transport, self.agent, self.sleep, self.clock = transport, agent, sleep, clock
        self.last: dict[str, float] = {}
        self.robots: dict[str, RobotFileParser | None] = {}

    def _send(self, url: str, headers: dict[str, str]) -> Response:
        host = urlsplit(url).hostname or ""
        if urlsplit(url).scheme not in ("http", "https") or not public(host):
            raise Refused(f"{url} is not a public address")
        wait = self.last.get(host, -INTERVAL) + INTERVAL - self.clock()
        if wait > 0:
            self.sleep(wait)
        self.last[host] = self.clock()
        return self.transport(url, {"User-Agent": self.agent} | headers)

    def _retried(self, url: str, headers: dict[str, str]) -> Response:
        try:
            got = self._send(url, headers)
            if got.status != 429 and got.status < 500:
                return got
        except OSError:
            pass
        return self._send(url, headers)

    def allowed(self, url: str) -> bool:
        """Missing robots allow all; unreadable or forbidden ones nothing."""
        site = "{0.scheme}://{0.netloc}".format(urlsplit(url))
        if site not in self.robots:
            rules = RobotFileParser()
            try:
                got = self._retried(f"{site}/robots.txt", {})
                if got.status in (401, 403) or got.status >= 500:
                    rules.disallow_all = True
                elif got.status >= 400:
                    rules.allow_all = True
                else:
                    rules.parse(got.body.decode("utf-8", "replace").splitlines())
            except OSError:
                rules.disallow_all = True
            self.robots[site] = rules
        return self.robots[site].can_fetch(self.agent, url)

    def get(self, url: str, etag: str | None = None, modified: str | None = None) -> Response:
        """Each hop is checked anew; 304 only comes where a cached body's marks were sent."""
        marks = {k: v for k, v in (("If-None-Match", etag), ("If-Modified-Since", modified)) if v}
        for _ in range(REDIRECTS + 1):
            if not self.allowed(url):
                raise Refused(f"robots refuse {url}")
            got = self._retried(url, marks)
            place = {k.lower(): v for k, v in got.headers.items()}.get("location")
            if 300 <= got.status < 400 and got.status != 304 and place:
                url = urljoin(url, place)
                continue
            if len(got.body) > MOST_BYTES:
                raise Refused(f"{url} is too large")
            return got
        raise Refused(f"{url} redirects too often")

    def body(self, url: str, cached: bytes | None, etag: str | None = None, modified: str | None = None) -> bytes:
        """The body; the cached one where it hasn't changed. Marks are sent only if there is one."""
        got = self.get(url, *((etag, modified) if cached is not None else ()))
        if got.status == 304 and cached is not None:
            return cached
        if got.status >= 400:
            raise OSError(f"{url}: HTTP {got.status}")
        return got.body


def content_hash(body: bytes) -> str:
    return hashlib.sha256(body).hexdigest()


def pdf_text(body: Column, pages: Callable[[bytes], Iterable[str]]) -> Column:
    """Texts of a PDF's pages (by any reader that gives them) with form feeds between, spaces collapsed."""

    @F.pandas_udf("string")
    def run(bodies: pd.Series) -> pd.Series:
        return bodies.map(lambda b: None if b is None else "\n\f\n".join(re.sub(r"[ \t]+", " ", p).strip() for p in pages(bytes(b))))

    return run(body)
