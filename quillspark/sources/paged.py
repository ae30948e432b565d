"""Paged searches as a data source: a page is a partition, so pages are asked for in parallel and a failed one again alone.

    spark.dataSource.register(paged_source(fetch, fields))
    spark.read.format("paged_search").option("keywords", json.dumps(words)).option("store", folder).load()

The first page of each keyword says how many items there are, from which the
pages follow. A page that can't be read, or has another number of items than its
place in the total asks for, raises: nothing ends silently. With a store, a
folder that driver and executors share, each page is kept as it came, whole or
not at all, and never asked for again: a job that failed goes on where it ended.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from quillspark.sources.artifacts import opened, read_whole, write_whole
from quillspark.sources.services import PAGE_ROWS, IncompleteSearch, _text, well_formed


@dataclass
class Page(InputPartition):
    keyword: str
    number: int
    items: int


def paged_source(fetch: Callable[[str, int], str | bytes], fields: dict[str, str], item: str = "prec", total: str = "totalCnt", page_rows: int = PAGE_ROWS, name: str = "paged_search") -> type[DataSource]:
    """A data source of rows (keyword, page, pos, fields) of what fetch(keyword, page) returns as XML; fields map columns to tags. Page numbers and positions in a page begin at 1 and 0."""
    source_name, columns = name, "".join(f", `{f}` string" for f in fields)

    class PagedReader(DataSourceReader):
        def __init__(self, options: dict):
            self.keywords = list(dict.fromkeys(json.loads(options.get("keywords", "[]"))))
            self.store = options.get("store")

        def page(self, keyword: str, number: int):
            """The root of a page, kept or asked for."""
            path = f"pages/{hashlib.sha256(keyword.encode()).hexdigest()}/{number:06}.xml"
            files, base = opened(self.store) if self.store else (None, None)
            content = read_whole(files, f"{base}/{path}") if files else None
            kept = content is not None
            if not kept:
                content = fetch(keyword, number)
                content = content.encode() if isinstance(content, str) else content
            root = well_formed(content)
            if root is None:
                raise IncompleteSearch(f"page {number} of the search for {keyword!r} is no XML")
            if files and not kept:
                write_whole(files, base, path, content)
            return root

        def partitions(self) -> list[InputPartition]:
            out: list[InputPartition] = []
            for k in self.keywords:
                count = (self.page(k, 1).findtext(f".//{total}") or "").strip()
                if not count.isdigit():
                    raise IncompleteSearch(f"the search for {k!r} doesn't say how many items there are")
                out += [Page(k, i // page_rows + 1, min(page_rows, int(count) - i)) for i in range(0, int(count), page_rows)]
            return out or [Page("", 0, 0)]

        def read(self, partition: Page) -> Iterator[tuple]:
            if partition.number:
                found = self.page(partition.keyword, partition.number).findall(f".//{item}")
                if len(found) != partition.items:
                    raise IncompleteSearch(f"page {partition.number} of the search for {partition.keyword!r} has {len(found)} items, not {partition.items}")
                for i, x in enumerate(found):
                    yield (partition.keyword, partition.number, i, *(_text(x.find(tag)) for tag in fields.values()))

    class PagedSearch(DataSource):
        @classmethod
        def name(cls) -> str:
            return source_name

        def schema(self) -> str:
            return f"keyword string, page int, pos int{columns}"

        def reader(self, schema) -> DataSourceReader:
            return PagedReader(self.options)

    return PagedSearch


def search_pages(spark: SparkSession, keywords: list[str], fetch: Callable[[str, int], str | bytes], fields: dict[str, str], store: str | None = None, **options) -> DataFrame:
    """(keyword, page, pos, fields) of all pages of the keywords, in parallel."""
    source = paged_source(fetch, fields, **options)
    spark.dataSource.register(source)
    read = spark.read.format(source.name()).option("keywords", json.dumps(keywords, ensure_ascii=False))
    return (read.option("store", store) if store else read).load()
