"""The tables of n-grams, against the recursion written out; order 2 against the blocks."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from snapforge.llm import katz, katz_tables

TEXTS = ["the cat sat on the mat", "the cat sat on the hat", "A cat ran", "the dog sat on the cat", None, "", "on the mat on the mat the the the", "x y z", "unknown words here the cat"] * 3


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "k", 1) for i, t in enumerate(TEXTS)] + [(None, "the cat", "k", 1), (3, "the cat sat", "k", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, h string, row int").repartition(3)


def brute(rows, order):
    each = [(i, [*(t or "").lower().split(), "\n"]) for i, t in rows]
    train = [d for i, d in each if not katz.is_held_out(i)]
    grams = {n: Counter((*(["\n"] * (n - 1) + d)[k : k + n - 1], w) for d in train for k, w in enumerate(d)) for n in range(1, order + 1)}
    total = sum(grams[1].values())
    unseen = min(0.5, max(1, sum(c == 1 for c in grams[1].values())) / (total + 1))
    d = {n: katz.discounts(np.array([sum(c == k for c in grams[n].values()) for k in range(1, katz.K + 2)])) for n in grams}
    after = {n: defaultdict(dict) for n in grams}
    for n, g in grams.items():
        for x, c in g.items():
            after[n][x[:-1]][x[-1]] = c

    def p(h, w):
        if not h:
            return (1 - unseen) * grams[1][(w,)] / total if (w,) in grams[1] else unseen
        n, seen = len(h) + 1, after[len(h) + 1].get(h)
        if not seen:
            return p(h[1:], w)
        freed = sum((1 - d[n][c - 1]) * c for c in seen.values() if c <= katz.K)
        bottom = sum(seen.values()) + (0 if freed else 1)
        if w in seen:
            return (d[n][seen[w] - 1] if seen[w] <= katz.K else 1) * seen[w] / bottom
        return (freed or 1) / bottom / (1 - sum(p(h[1:], x) for x in seen)) * p(h[1:], w)

    vocabulary = [w for (w,) in grams[1]]
    for n in range(2, order + 1):  # exactly normalised: known words and the unknown one
        for h in after[n]:
            assert abs(sum(p(h, w) for w in vocabulary) + p(h, "never seen") - 1) < 1e-9
    return Counter((i, katz.is_held_out(i), len(x), round(sum(math.log10(p(tuple((["\n"] * (order - 1) + x)[k : k + order - 1]), w)) for k, w in enumerate(x)), 6)) for i, x in each)


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_orders(docs, order):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = Counter((r["doc_id"], r["held_out"], r["n_tokens"], round(r["score"], 6)) for r in katz_tables.score(docs, order).collect())
    assert got == brute(rows, order)


def test_order_two_is_what_the_blocks_give(docs):
    tables, blocks = (Counter((r["doc_id"], r["held_out"], r["n_tokens"], round(r["score"], 6)) for r in df.collect()) for df in (katz_tables.score(docs, 2), katz.score(docs)))
    assert tables == blocks


def test_no_python_and_nothing_of_an_empty_table(docs):
    assert katz_tables.score(docs.limit(0)).isEmpty()
    assert "Python" not in katz_tables.score(docs.limit(5))._jdf.queryExecution().executedPlan().toString()
