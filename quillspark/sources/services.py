"""Paginated searches and document services, asked by tasks through an injected transport.

A transport is a function of a URL, or of a body, that returns text. It runs in
tasks, which Spark may run again, so what it asks must bear being asked twice. A
response that can't be read stops the job: no search or detail ends silently.
"""

from __future__ import annotations

import json
import time
import urllib.parse
import urllib.request
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PAGE_ROWS, MOST_PAGES = 100, 200


def get(url: str, params: dict[str, str] | None = None, tries: int = 3, pause: float = 0.3, opener: Callable = urllib.request.urlopen, sleep: Callable = time.sleep) -> bytes:
    """The body of a response; a failure is tried again after a pause that grows with each try."""
    target = f"{url}?{urllib.parse.urlencode(params)}" if params else url
    for n in range(1, tries + 1):
        try:
            with opener(target, timeout=30) as r:
                return r.read()
        except Exception:
            if n == tries:
                raise
            sleep(pause * n)
    raise AssertionError


def well_formed(text: str | bytes):
    """The root of an XML text, or None."""
    try:
        return ET.fromstring(text)
    except ET.ParseError:
        return None


class IncompleteSearch(RuntimeError):
    """A search that can't be read to its end."""


def pages(fetch: Callable[[str, int], str | bytes], keyword: str, total: str = "totalCnt", item: str = "prec", fields: dict[str, str] | None = None) -> Iterator[dict]:
    """Items of a search, page by page until `total` are seen or a page is empty. A page that can't be parsed or doesn't say the total, or more than MOST_PAGES, raise."""
    seen = 0
    for page in range(1, MOST_PAGES + 1):
        root = well_formed(fetch(keyword, page))
        if root is None:
            raise IncompleteSearch(f"page {page} of the search for {keyword!r} is no XML")
        found = root.findall(f".//{item}")
        for x in found:
            yield {name: _text(x.find(tag)) for name, tag in (fields or {}).items()}
        seen += len(found)
        count = (root.findtext(f".//{total}") or "").strip()
        if not count.isdigit():
            raise IncompleteSearch(f"page {page} of the search for {keyword!r} doesn't say how many items there are")
        if not found or seen >= int(count):
            return
    raise IncompleteSearch(f"the search for {keyword!r} has more than {MOST_PAGES} pages")


def _text(element) -> str:
    """All text inside an element, that of nested ones too."""
    return "" if element is None else "".join(element.itertext()).strip()


def searched(keywords: DataFrame, fetch: Callable[[str, int], str | bytes], fields: dict[str, str], keyword: str = "keyword", item: str = "prec", total: str = "totalCnt") -> DataFrame:
    """(keyword, pos, fields): the items of each keyword in the order of the service, keywords spread over tasks."""

    def run(batches):
        for pdf in batches:
            for k in pdf[keyword]:
                rows = list(pages(fetch, k, total, item, fields))
                yield pd.DataFrame([{keyword: k, "pos": i, **r} for i, r in enumerate(rows)], columns=[keyword, "pos", *fields])

    schema = f"`{keyword}` string, pos long, " + ", ".join(f"`{f}` string" for f in fields)
    return keywords.select(keyword).distinct().repartition(keyword).mapInPandas(run, schema)


def detailed(serials: DataFrame, fetch: Callable[[str], str | bytes], fields: dict[str, str], serial: str = "serial", body: str = "content") -> DataFrame:
    """(serial, fields, raw): the detail of each serial; one whose body is empty is left out, one that can't be parsed raises."""

    def run(batches):
        for pdf in batches:
            rows = []
            for s in pdf[serial]:
                raw = fetch(s)
                root = well_formed(raw)
                if root is None:
                    raise IncompleteSearch(f"the detail of {s!r} is no XML")
                row = {name: _text(root.find(f".//{tag}")) for name, tag in fields.items()}
                if row.get(body):
                    rows.append({serial: s, **row, "raw": raw.decode() if isinstance(raw, bytes) else raw})
            yield pd.DataFrame(rows, columns=[serial, *fields, "raw"])

    schema = f"`{serial}` string, " + ", ".join(f"`{f}` string" for f in fields) + ", raw string"
    return serials.select(serial).distinct().mapInPandas(run, schema)


def discovered(found: DataFrame, aliases: DataFrame, keyword: str = "keyword", serial: str = "serial", target: str = "target") -> DataFrame:
    """(target, serial, pos): the serials of each target's keywords (aliases: target, keyword, order), each once, where it is first found."""
    joined = found.join(aliases, keyword).groupBy(target, serial).agg(F.min(F.struct("order", "pos")).alias("~first"))
    return joined.select(target, serial, (F.col("~first.order") * PAGE_ROWS * MOST_PAGES + F.col("~first.pos")).alias("pos"))


def multipart(fields: dict[str, str], files: dict[str, tuple[str, bytes]], boundary: str) -> bytes:
    """A form as multipart/form-data."""
    out = []
    for name, value in fields.items():
        out.append(f'--{boundary}\r\nContent-Disposition: form-data; name="{name}"\r\n\r\n{value}\r\n'.encode())
    for name, (filename, data) in files.items():
        head = f'--{boundary}\r\nContent-Disposition: form-data; name="{name}"; filename="{filename}"\r\nContent-Type: application/octet-stream\r\n\r\n'
        out.append(head.encode() + data + b"\r\n")
    return b"".join(out) + f"--{boundary}--\r\n".encode()


def ndjson_blocks(text: str) -> list[dict]:
    return [json.loads(line) for line in text.splitlines() if line.strip()]


def parsed_ranges(ranges: DataFrame, parse: Callable[[str, int, int], str], document: str = "document") -> DataFrame:
    """(document, first, last, pos, content) of rows (document, first, last): what a service reads in each page range, whose page marks must be as many as its pages."""

    def run(batches):
        for pdf in batches:
            rows = []
            for d, a, b in zip(pdf[document], pdf["first"], pdf["last"], strict=True):
                blocks = ndjson_blocks(parse(d, int(a), int(b)))
                marks = sum(x.get("type") == "page" for x in blocks)
                if marks != b - a + 1:
                    raise ValueError(f"{d}: {marks} page marks for pages {a} to {b}")
                rows += [(d, a, b, i, x.get("content", "")) for i, x in enumerate(blocks)]
            yield pd.DataFrame(rows, columns=[document, "first", "last", "pos", "content"])

    return ranges.mapInPandas(run, f"`{document}` string, first long, last long, pos long, content string")
