"""A polite website crawler over a table of sites, distributed by host.

All sites of a host go through one task, one page at a time with a pause between them. Every address
is checked before it is fetched, redirects hop by hop, and only pages of the site itself are kept;
robots rules, size and type caps hold. Fetching and name resolution are passed in, so that tests and
closed networks bring their own.
"""

from __future__ import annotations

import hashlib
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from datetime import UTC, datetime
from urllib.parse import urljoin, urlsplit
from urllib.robotparser import RobotFileParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.operators.web import address_problem, lookup, page_text, syntax_problem, url_host

EXTRACTION = "1"
PAGES = "company_id string, url string, final_url string, fetched_at timestamp, status int, content_type string, content_hash string, byte_size int, extraction_version string, ok boolean, error string, robots_allowed boolean, title string, text string"


@dataclass(frozen=True)
class Answer:
    status: int
    content_type: str = ""
    body: bytes = b""
    location: str | None = None


class _Stay(urllib.request.HTTPRedirectHandler):
    def redirect_request(self, *_):  # redirects are looked at by the crawler
        return None


def http_get(url: str, agent: str, most: int, seconds: float = 15) -> Answer:
    """One request, no redirects followed, at most ``most`` + 1 bytes read."""
    ask = urllib.request.Request(url, headers={"User-Agent": agent})
    try:
        with urllib.request.build_opener(_Stay).open(ask, timeout=seconds) as r:
            return Answer(r.status, r.headers.get_content_type(), r.read(most + 1), r.headers.get("Location"))
    except urllib.error.HTTPError as e:
        return Answer(e.code, e.headers.get_content_type() if e.headers else "", b"", e.headers.get("Location") if e.headers else None)


def crawl(
    sites: DataFrame, agent: str, pages: Sequence[str] = ("/", "/about", "/company"), get: Callable[[str, str, int], Answer] = http_get, resolver: Callable[[str], Sequence[str]] = lookup,
    denied: tuple[str, ...] = (), pause: float = 1.0, most_bytes: int = 2_000_000, most_hops: int = 3, types: tuple[str, ...] = ("text/html", "application/xhtml+xml", "text/plain"),
) -> DataFrame:
    """A row for every page of every site (company_id, website); failures are rows with ``ok`` false and the reason."""
    rows = sites.where("website IS NOT NULL").select("company_id", "website", url_host(F.col("website")).alias("host"), syntax_problem(F.col("website"), denied).alias("problem"))

    def fetch(url: str, host: str) -> tuple[str, Answer | None, str | None]:
        """(final URL, answer, problem)."""
        for _ in range(most_hops + 1):
            parts = urlsplit(url)
            if parts.scheme not in ("http", "https") or parts.port not in (None, 80, 443):
                return url, None, "redirect to another scheme or port"
            name = (parts.hostname or "").lower().rstrip(".")
            if name.removeprefix("www.") != host.removeprefix("www."):
                return url, None, "redirect to another site"
            try:
                problem = address_problem(resolver(name))
            except (OSError, UnicodeError, ValueError):
                problem = "does not resolve"
            if problem:
                return url, None, problem
            try:
                a = get(url, agent, most_bytes)
            except Exception as e:  # noqa: BLE001
                return url, None, f"{type(e).__name__}: {str(e)[:200]}"
            if a.status not in (301, 302, 303, 307, 308) or not a.location:
                return url, a, None
            url = urljoin(url, a.location)
        return url, None, "too many redirects"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rules: dict[str, RobotFileParser | None] = {}
        last: dict[str, float] = {}

        def wait(host: str) -> None:
            left = last.get(host, 0) + pause - time.monotonic()
            if left > 0:
                time.sleep(left)
            last[host] = time.monotonic()

        def allowed(root: str, host: str, url: str) -> bool:
            if root not in rules:
                wait(host)
                _, a, problem = fetch(f"{root}/robots.txt", host)
                rules[root] = None
                if not problem and a is not None and a.status == 200:  # no rules to be had: allowed
                    rules[root] = RobotFileParser()
                    rules[root].parse(a.body.decode("utf-8", "replace").splitlines())
            return rules[root] is None or rules[root].can_fetch(agent, url)

        for b in batches:
            out = []
            for company, site, host, problem in zip(b["company_id"], b["website"], b["host"], b["problem"], strict=True):
                parts = urlsplit(site.strip()) if not problem else None
                root = f"{parts.scheme}://{parts.netloc}" if parts else ""
                for path in pages if not problem else ("",):
                    url = root + path if parts else site
                    row = dict.fromkeys((x.split()[0] for x in PAGES.split(", ")), None) | {"company_id": company, "url": url, "fetched_at": datetime.now(UTC).replace(tzinfo=None), "extraction_version": EXTRACTION, "ok": False, "robots_allowed": True, "status": 0, "byte_size": 0}
                    out.append(row)
                    if problem:
                        row["error"] = problem
                        continue
                    if not allowed(root, host, url):
                        row |= {"robots_allowed": False, "error": "disallowed by robots"}
                        continue
                    wait(host)
                    final, a, bad = fetch(url, host)
                    row["final_url"] = final
                    if bad or a is None:
                        row["error"] = bad
                        continue
                    row |= {"status": a.status, "content_type": a.content_type, "byte_size": len(a.body)}
                    if a.status != 200:
                        row["error"] = f"status {a.status}"
                    elif a.content_type not in types:
                        row["error"] = "content type"
                    elif len(a.body) > most_bytes:
                        row["error"] = "too large"
                    else:
                        title, text = page_text(a.body.decode("utf-8", "replace"))
                        row |= {"ok": True, "content_hash": hashlib.sha256(a.body).hexdigest(), "title": title, "text": text}
            yield pd.DataFrame(out, columns=[x.split()[0] for x in PAGES.split(", ")])

    return rows.repartition("host").mapInPandas(run, PAGES)
