"""Paged API pulls as a Python data source, an input partition per run of pages.

The transport is a fetch function ``fetch(params, options) -> document``; retries and
credentials belong to it. When the response states a total, all pages are read in
parallel. Without a total, or with a cursor, a page is only known from the one before,
so a single partition walks them.
"""

from __future__ import annotations

import json
import math
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

MODES = ("none", "page", "offset", "cursor")
SCHEMA = "page_index bigint, item_index int, item string"
# Partitions planned at most; beyond that each reads several pages in a row.
MAX_PARTITIONS = 10_000


def at_path(document, path: str):
    """Value at a dotted path; numeric parts index lists; a missing part is an error."""
    if not path:
        return document
    for part in path.split("."):
        try:
            document = document[int(part)] if isinstance(document, list) else document[part]
        except (KeyError, IndexError, ValueError, TypeError):
            raise KeyError(f"the response has nothing at {path!r}") from None
    return document


@dataclass(frozen=True)
class Paging:
    mode: str = "none"
    page_size: int | None = None
    start: int | None = None  # first page (1) or offset (0); a checkpoint resumes here
    max_pages: int | None = None
    items_path: str = ""
    total_path: str | None = None
    cursor_path: str | None = None
    page_param: str = "page"
    offset_param: str = "offset"
    size_param: str = "page_size"
    cursor_param: str = "cursor"

    def __post_init__(self):
        if self.mode not in MODES:
            raise ValueError(f"unknown paging mode {self.mode!r}")
        if self.mode == "offset" and not self.page_size:
            raise ValueError("offset paging needs a page size")
        if self.mode == "cursor" and not self.cursor_path:
            raise ValueError("cursor paging needs the path of the next cursor")

    def first(self) -> int:
        return self.start if self.start is not None else (1 if self.mode == "page" else 0)

    def params(self, index: int, cursor: str | None = None) -> dict:
        out = {self.size_param: self.page_size} if self.page_size else {}
        if self.mode == "page":
            out[self.page_param] = self.first() + index
        elif self.mode == "offset":
            out[self.offset_param] = self.first() + index * self.page_size
        elif self.mode == "cursor" and cursor is not None:
            out[self.cursor_param] = cursor
        return out

    def page_count(self, document) -> int | None:
        """Pages to read when the response tells the total; None when it does not."""
        if self.mode == "none":
            return 1
        if self.mode == "cursor" or not self.total_path or not self.page_size:
            return None
        left = int(at_path(document, self.total_path))
        left -= (self.first() - 1) * self.page_size if self.mode == "page" else self.first()
        pages = max(1, math.ceil(left / self.page_size))
        return min(pages, self.max_pages) if self.max_pages else pages


class _Pages(InputPartition):
    """Pages ``first`` up to ``end``; without an end, pages are walked until one is the last."""

    def __init__(self, first: int, end: int | None):
        self.first = first
        self.end = end


class _Reader(DataSourceReader):
    def __init__(self, paging: Paging, fetch: Callable, options: dict):
        self.paging, self.fetch, self.options = paging, fetch, options

    def partitions(self) -> list[InputPartition]:
        count = None
        if self.paging.mode != "cursor":
            count = self.paging.page_count(self.fetch(self.paging.params(0), self.options))
        if count is None:
            return [_Pages(0, None)]
        step = math.ceil(count / MAX_PARTITIONS)
        return [_Pages(i, min(i + step, count)) for i in range(0, count, step)]

    def read(self, partition: _Pages) -> Iterator[tuple]:
        paging, index, cursor = self.paging, partition.first, None
        while partition.end is None or index < partition.end:
            document = self.fetch(paging.params(index, cursor), self.options)
            items = at_path(document, paging.items_path)
            rows = items if isinstance(items, list) else [items]
            for position, item in enumerate(rows):
                yield index, position, json.dumps(item, ensure_ascii=False)
            index += 1
            if partition.end is not None:
                continue
            if not rows or (paging.max_pages and index >= paging.max_pages):
                return
            if paging.mode == "cursor":
                cursor = at_path(document, paging.cursor_path)
                if cursor is None or isinstance(cursor, (dict, list)):
                    return
                cursor = str(cursor)
            elif paging.page_size and len(rows) < paging.page_size:
                return


def read_pages(
    spark: SparkSession, paging: Paging, fetch: Callable[[dict, dict], object], **options: str
) -> DataFrame:
    """Items of all pages as JSON text with their page and position."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])

    class Pages(DataSource):
        @classmethod
        def name(cls) -> str:
            return "lamina_pages"

        def schema(self) -> str:
            return SCHEMA

        def reader(self, schema) -> DataSourceReader:
            return _Reader(paging, fetch, options)

    spark.dataSource.register(Pages)
    return spark.read.format("lamina_pages").load()


def resume_after(paging: Paging, pages_read: int) -> int:
    """Start of the next pull."""
    step = paging.page_size if paging.mode == "offset" else 1
    return paging.first() + pages_read * step


def _column_at(df: DataFrame, path: str) -> tuple[Column, T.DataType]:
    first, *rest = path.split(".")
    column, dtype = F.col(f"`{first}`"), df.schema[first].dataType
    for part in rest:
        if isinstance(dtype, T.ArrayType):
            column, dtype = F.get(column, F.lit(int(part))), dtype.elementType
        else:
            column, dtype = column.getField(part), dtype[part].dataType
    return column, dtype


def unwrap(df: DataFrame, path: str, keep: list[str] | None = None) -> DataFrame:
    """Rows for the items at ``path`` of an envelope: a list of objects, or one object."""
    column, dtype = _column_at(df, path)
    kept = [F.col(k) for k in keep or []]
    if isinstance(dtype, T.ArrayType):
        rows = df.select(*kept, F.explode(column).alias("item"))
        dtype = dtype.elementType
    else:
        rows = df.select(*kept, column.alias("item"))
    if isinstance(dtype, T.StructType):
        return rows.select(*(keep or []), "item.*")
    return rows
