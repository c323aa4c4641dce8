"""Registry pages: a paging Python data source for the live endpoint, and saved pages as JSON."""

from __future__ import annotations

import json
import re
import time
from html.parser import HTMLParser
from urllib.parse import urlencode
from urllib.request import Request, urlopen

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.constants import RAW_COLUMNS

PAGE = "data array<array<string>>, recordsTotal string"
HEADERS = {"Content-Type": "application/x-www-form-urlencoded; charset=UTF-8", "X-Requested-With": "XMLHttpRequest"}
NONCE_FIELD = "wdtNonceFrontendEdit_2"


class _Nonce(HTMLParser):
    value: str | None = None

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag == "input" and a.get("id") == NONCE_FIELD and self.value is None:
            self.value = a.get("value")


def find_nonce(html: str) -> str:
    found = _Nonce()
    found.feed(html)
    if found.value is None:
        raise ValueError("the page holds no nonce")
    return found.value


def form(start: int, length: int, nonce: str) -> dict[str, str]:
    """The request for one page: rows in the server's order by the fifth column, descending."""
    fields = {"draw": "5", "order[0][column]": "4", "order[0][dir]": "desc", "start": str(start), "length": str(length), "search[value]": "", "search[regex]": "false", "wdtNonce": nonce, "sRangeSeparator": "|"}
    for i, name in enumerate(RAW_COLUMNS):
        fields |= {f"columns[{i}][{k}]": v for k, v in (("data", str(i)), ("name", name), ("searchable", "true"), ("orderable", "true"), ("search][value", ""), ("search][regex", "false"))}
    return fields


def fetch(endpoint: str, start: int, length: int, nonce: str) -> tuple[list, int]:
    with urlopen(Request(endpoint, urlencode(form(start, length, nonce)).encode(), HEADERS), timeout=120) as reply:
        told = json.load(reply)
    return told["data"], int(told["recordsTotal"])


class _Page(InputPartition):
    def __init__(self, start: int, began: float):
        self.start, self.began = start, began


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.endpoint, self.size, self.delay = options["endpoint"], int(options.get("page_size", 10_000)), float(options.get("delay", 0))
        self.nonce = options.get("nonce")
        if self.nonce is None:
            with urlopen(options["page"], timeout=120) as reply:
                self.nonce = find_nonce(reply.read().decode())

    def partitions(self):
        _, total = fetch(self.endpoint, 0, 1, self.nonce)
        began = time.time()
        return [_Page(s, began) for s in range(0, total, self.size)]

    def read(self, partition):
        """One page; a delay spaces the requests of all tasks by the pages' numbers, from the time the scan was planned."""
        if partition is None:  # an empty registry has no pages
            return
        time.sleep(max(0.0, partition.began + self.delay * (partition.start // self.size) - time.time()) if self.delay else 0)
        rows, total = fetch(self.endpoint, partition.start, self.size, self.nonce)
        if len(rows) < min(self.size, total - partition.start):
            raise ValueError(f"the page from row {partition.start} is incomplete: {len(rows)} rows of {total}")
        for i, cells in enumerate(rows):
            yield partition.start + i, cells


class RegistrySource(DataSource):
    """spark.read.format("registry"): options endpoint, page or nonce, page_size, delay. A page a partition; an incomplete page fails."""

    @classmethod
    def name(cls):
        return "registry"

    def schema(self):
        return "ord long, cells array<string>"

    def reader(self, schema):
        return _Reader(self.options)


def saved_pages(spark: SparkSession, path: str, check_complete: bool = True) -> DataFrame:
    """ord, cells from saved page envelopes; ValueError where their rows are fewer or more than recordsTotal says.

    Pages follow one another by file name, numbers in it by their value; of several envelopes in one file (an array) each is a page.
    """
    pages = spark.read.schema(PAGE).option("multiLine", True).json(path).withColumn("__file", F.input_file_name())
    pages = pages.withColumn("__page", F.monotonically_increasing_id())  # one file is one partition's, whose envelopes keep their order
    if check_complete:
        rows, total = pages.agg(F.sum(F.size("data")), F.max(F.col("recordsTotal").cast("long"))).first()
        if total is not None and (rows or 0) != total:
            raise ValueError(f"the pages hold {rows} rows of {total}")
    # a page's rows keep their order behind the page's own place
    starts = pages.select("__file", "__page", F.size("data").alias("n")).collect()  # a row a page
    before, told = 0, []
    for r in sorted(starts, key=lambda r: (_numbered(r["__file"]), r["__page"])):
        told.append((r["__page"], before))
        before += max(0, r["n"])
    offsets = spark.createDataFrame(told, "__page long, __before long")
    spread = pages.select("__page", F.posexplode("data").alias("pos", "cells"))
    return spread.join(F.broadcast(offsets), "__page").select((F.col("__before") + F.col("pos")).alias("ord"), "cells")


def _numbered(name: str) -> list:
    """A name's parts, for an order in which 2 comes before 10."""
    return [(0, int(x), "") if x.isdigit() else (1, 0, x) for x in re.split(r"(\d+)", name) if x]


def raw_rows(cells: DataFrame) -> DataFrame:
    """ord and the sixteen raw columns, cleaned of HTML."""
    from ..functions.udfs import html_cells

    clean = cells.select("ord", html_cells("cells").alias("c"))
    return clean.select("ord", *(F.coalesce(F.get("c", F.lit(i)), F.lit("")).alias(n) for i, n in enumerate(RAW_COLUMNS)))
