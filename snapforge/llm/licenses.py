"""Licence scans: ordered signature rules behind a keyword automaton.

A text is reduced to its lower-case words joined by single spaces. One Aho-Corasick pass finds the keywords; only the rules
whose keyword occurs are matched. The contract's phrases are rules too, whose matches give the base places and take no
part in what follows. Overlapping detections are settled by interval containment: a detection inside
another one of at least its priority goes, and of equal intervals the one of highest priority, then the first in
the rules' order, stays. A text's score is the best detection's priority, as a share of 100, raised
towards 1 by further detections.

Nulls: a null text has no words: no labels, null first and last word, score 0. Texts are scanned whole. Repeated rows are all
returned; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from . import common
from .license_rules import RULES

#: The contract's phrases and labels.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
#: Lower-cases A-Z and turns every other ASCII character but digits and letters into a space.
WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


@lru_cache(maxsize=1)
def compiled():
    """(keyword automaton, [(label, priority, expression)]); the last rules, of priority 0, are BASE, each its own keyword."""
    import ahocorasick

    rules, by_keyword = [], {}
    lines = [[x.strip() for x in line.split(" | ", 3)] for line in RULES.strip().splitlines()]
    for label, priority, keyword, expression in [*lines, *((label, 0, phrase, phrase) for phrase, label in BASE)]:
        by_keyword.setdefault(keyword, []).append(len(rules))
        rules.append((label, int(priority), re.compile(f"(?<= )(?:{expression})(?= )")))
    automaton = ahocorasick.Automaton()
    for keyword, which in by_keyword.items():
        automaton.add_word(keyword, which)
    automaton.make_automaton()
    return automaton, rules


def matches(text: str) -> list[tuple[int, int, int]]:
    """(start, end, rule) of every rule's matches in reduced text with a space at either end, before suppression."""
    automaton, rules = compiled()
    wanted = sorted({k for _, which in automaton.iter(text) for k in which})
    return [(m.start(), m.end(), k) for k in wanted for m in rules[k][2].finditer(text)]


def detections(matched: list[tuple[int, int, int]]) -> list[tuple[int, int, str, int]]:
    """(start, end, label, priority) of the matches that have a priority, after suppression."""
    rules = compiled()[1]
    found = [f for f in matched if rules[f[2]][1]]
    found.sort(key=lambda f: (f[0], -f[1], -rules[f[2]][1], f[2]))
    kept: list[tuple[int, int, str, int]] = []
    around: list[tuple[int, int]] = []  # (end, priority) of kept ones that may contain what follows
    for start, end, k in found:
        label, priority, _ = rules[k]
        around = [(e, p) for e, p in around if e > start]
        if not any(e >= end and p >= priority for e, p in around):
            kept.append((start, end, label, priority))
            around.append((end, priority))
    # a later, longer one of higher priority may contain an earlier one only at the same start, which the order above settles
    return kept


def scan_text(text: str | None) -> tuple[int, int, int | None, int | None, str, str, float]:
    """n_words, n_base, first_word, last_word, base_labels, labels, score."""
    raw = text.encode("utf-8", "surrogatepass").translate(WORDS).split() if text else []
    plain = b" ".join([b"", *raw, b""]).decode("utf-8", "surrogatepass")
    matched, rules = matches(plain) if raw else [], compiled()[1]
    own = [(start, rules[k][0]) for start, _, k in matched if not rules[k][1]]
    places, base = [start for start, _ in own], {label for _, label in own}
    found = detections(matched)
    labels = base | {f[2] for f in found}
    miss = 1.0
    for p in [f[3] for f in found] or [50] * bool(base):
        miss *= 1 - p / 100
    first, last = (plain.count(" ", 0, p - 1) for p in (min(places), max(places))) if places else (None, None)
    return len(raw), len(places), first, last, ",".join(sorted(base)), ",".join(sorted(labels)), 1 - miss


def scan(docs: DataFrame) -> DataFrame:
    """The scan of every row; a map without a shuffle."""
    kinds = [("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                columns = zip(*map(scan_text, batch.column(1).to_pylist()), strict=True)
                yield pa.record_batch([batch.column(0), *(pa.array(c, k) for c, (_, k) in zip(columns, kinds, strict=True))], names=["doc_id", *(n for n, _ in kinds)])

    return common.id_text(docs).mapInArrow(run, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")


def op10_licenses(spark, sf_dir: str) -> DataFrame:
    """Contract query: all documents."""
    return scan(common.documents(spark, sf_dir))
