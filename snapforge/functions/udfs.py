"""The functions that have no native form: compatibility normalisation, HTML cells and string similarity."""

from __future__ import annotations

import re
import unicodedata
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType


@F.pandas_udf(StringType())
def compatibility_form(texts: pd.Series) -> pd.Series:
    """NFKC; ASCII comes back as it is."""
    return _forms(texts)


def _forms(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: t if t.isascii() else unicodedata.normalize("NFKC", t), na_action="ignore")


#: The same behind a fence: a filter on what is made of it isn't pushed below it, which would run it twice.
compatibility_form_once = F.pandas_udf(_forms, StringType()).asNondeterministic()


class _Cell(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.href = self.tip = None
        self.texts: list[str] = []

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag == "a" and self.href is None and "href" in a:
            self.href = a["href"] or ""
        if tag == "span" and self.tip is None and (a.get("class") or "") == "has-tip top" and a.get("tabindex") == "2":
            self.tip = a.get("title")
            if self.tip is None:
                raise KeyError("title")

    def handle_data(self, data):
        self.texts.append(data.strip())


def cell_text(cell: str | None) -> str:
    """The first link's address, else the first tooltip's title, else the text of all nodes, each stripped."""
    if cell is None:
        return ""
    if "<" not in cell and "&" not in cell:
        return cell.strip()
    parsed = _Cell()
    parsed.feed(cell)
    parsed.close()
    if parsed.href is not None:
        return parsed.href.strip()
    return parsed.tip.strip() if parsed.tip is not None else "".join(parsed.texts)


@F.pandas_udf(ArrayType(StringType()))
def html_cells(rows: pd.Series) -> pd.Series:
    return rows.map(lambda cells: [cell_text(c) for c in cells], na_action="ignore")


@F.pandas_udf(StringType())
def html_cell(cells: pd.Series) -> pd.Series:
    return cells.map(cell_text)


def places(a: str) -> dict[str, int]:
    """For each character of a the bits of its places."""
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    return where


def common_subsequence(where: dict[str, int], size: int, b: str) -> int:
    """Length of the longest common subsequence of b and a string of that size and those places, a word of bits for a row of the table."""
    row = every = (1 << size) - 1
    for c in b:
        if u := row & where.get(c, 0):
            row = ((row + u) | (row - u)) & every
    return size - row.bit_count()


def ratio(a: str, b: str) -> int:
    """100 * similarity by insertions and deletions, rounded; two empty strings are equal."""
    total = len(a) + len(b)
    return round(200 * common_subsequence(places(a), len(a), b) / total) if total else 100


def process(s: str) -> str:
    """Lower case, everything but letters and digits to spaces, trimmed: what a choice is compared by."""
    return re.sub(r"[\W_]", " ", s).lower().strip()


def token_set_ratio(a: str, b: str) -> int:
    """The best ratio among the shared tokens and the shared tokens with either side's own."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0
    shared, own_a, own_b = (" ".join(sorted(s)) for s in (x & y, x - y, y - x))
    if shared and (not own_a or not own_b):
        return 100
    with_a, with_b = f"{shared} {own_a}".strip(), f"{shared} {own_b}".strip()
    return max(ratio(with_a, with_b), *((ratio(shared, with_a), ratio(shared, with_b)) if shared else (0,)))


def best_ratio(query: str, choices: list[tuple[str, str]], least: int) -> tuple[str | None, int]:
    """(first choice of the best score, score), of (choice, processed choice); choices too short or long to reach least are passed over."""
    q, best, score = process(query), None, -1
    if not q:
        return None, 0
    where, size = places(q), len(q)
    for choice, p in choices:
        total = size + len(p)
        if 200 * min(size, len(p)) / total < max(least, score + 1) - 0.5:
            continue
        if (s := round(200 * common_subsequence(where, size, p) / total)) > score:
            best, score = choice, s
            if s == 100:
                break
    return best, max(score, 0)
