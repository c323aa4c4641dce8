"""What the models say, against their formulas written out: toxicity's evidence, quality's posterior, the licences' suppression."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from snapforge.llm import licenses, quality, toxicity


def test_evidence_is_the_formula():
    rng = random.Random(2)
    words = [f"w{'abcdefgh'[i % 8]}{'xyz'[i % 3]}{'q' * (i // 8)}" for i in range(40)]
    bad = ["vile", "nasty"]
    toxic = [" ".join([*rng.choices(words, k=30), *rng.choices(bad, k=3), *rng.choices(words, k=5)]) for _ in range(40)]
    plain = [" ".join(rng.choices(words, k=35)) for _ in range(50)]
    toxic.append(toxic[0])  # a copy changes nothing
    model, d = toxicity.Model(toxic, plain), toxicity.DISCOUNT
    assert toxicity.Model(toxic[:-1], plain).own == model.own

    def triples(texts):
        out = set()
        for t in dict.fromkeys(texts):
            ws, taken = t.split(), Counter()
            for k, w in enumerate(ws):
                taken[w] += 1
                if taken[w] <= toxicity.PER_TEXT:
                    out.add((ws[k - 2] if k > 1 else "", ws[k - 1] if k else "", w))
        return out

    pairs = [Counter((v, w) for _, v, w in triples(x)) for x in (toxic, plain)]
    ones = [Counter(w for _, w in p) for p in pairs]
    totals = [sum(c.values()) for c in ones]
    lesser = {w: min(ones[0][w] / totals[0], ones[1][w] / totals[1]) for w in {*ones[0], *ones[1]}}

    def one(c, w):
        share = sum(min(n, d) for n in ones[c].values()) / totals[c]
        return max(ones[c][w] - d, 0) / totals[c] + share * (lesser.get(w, 0) + (1 - sum(lesser.values())) * model.letters.word(w)[c])

    def two(c, v, w):
        after = {x: n for (u, x), n in pairs[c].items() if u == v}
        if not after:
            return one(c, w)
        n = sum(after.values())
        return max(after.get(w, 0) - d, 0) / n + sum(min(x, d) for x in after.values()) / n * one(c, w)

    for c in (0, 1):  # each level sums to one but for what words that the classes have never said get by their letters
        known = sum(one(c, w) for w in lesser)
        assert 0.9 < known <= 1 + 1e-9
    of = toxicity.Remembered(model).__getitem__
    for text in (toxic[3], plain[4], "never seen vile words nasty"):
        ws = toxicity.words_of(text)
        want = [math.log(two(0, v, w) / two(1, v, w)) for v, w in zip(["", *ws], ws)]
        got = model.evidence(ws, of).tolist()
        assert all(abs(g - x) < 1e-6 or abs(x) > toxicity.MOST_BY_LETTERS for g, x in zip(got, want, strict=True))
        e, n = np.array(got), len(got)
        by_hand = [e.mean(), *(max(e[i : i + min(k, n)].sum() / k for i in range(n - min(k, n) + 1)) for k in toxicity.STRETCHES)]
        assert np.allclose(model.features(text, of), by_hand)
    assert model.alone("vile") > 3 > abs(model.alone(words[0]))


def test_copies_of_texts_are_left_out():
    a, b = [f"a{i}" for i in range(40)], [f"b{i}" for i in range(40)]
    near = [*a[:20], "x", *a[21:]]
    assert list(toxicity.without_copies([a, near, b, a, [], ["one"], ["one"]])) == [a, b, [], ["one"], ["one"]]


def test_posterior_is_expectation_maximisation_over_documents():
    rng = np.random.default_rng(1)
    votes = rng.choice([1, 0, -1], size=(300, 3), p=[0.6, 0.2, 0.2])
    patterns = [(p, n) for p, n in Counter(map(tuple, votes.tolist())).items()]
    prior, ratios = quality.estimate(patterns, 3)
    got = [1 / (1 + math.exp(-prior - sum(r[v] for r, v in zip(ratios, row)))) for row in votes.tolist()]
    like = {y: [dict(zip((1, 0, -1), quality.PRIOR_VOTES[y])) for _ in range(3)] for y in (1, -1)}
    good, weight = quality.PRIOR_GOOD, quality.PRIOR_SHARE * len(votes)
    say = lambda: np.array([good * math.prod(like[1][r][v] for r, v in enumerate(row)) / (good * math.prod(like[1][r][v] for r, v in enumerate(row)) + (1 - good) * math.prod(like[-1][r][v] for r, v in enumerate(row))) for row in votes.tolist()])
    for _ in range(quality.ROUNDS):
        p = say()
        like = {y: [{v: (q[votes[:, r] == v].sum() + weight * quality.PRIOR_VOTES[y][(1, 0, -1).index(v)]) / (q.sum() + weight) for v in (1, 0, -1)} for r in range(3)] for y, q in ((1, p), (-1, 1 - p))}
        good = (p.sum() + weight * quality.PRIOR_GOOD) / (len(votes) + weight)
    assert np.allclose(got, say(), atol=1e-9)


@pytest.mark.parametrize("seed", range(4))
def test_suppression_is_interval_containment(seed):
    rng, rules = random.Random(seed), licenses.compiled()[1]
    real = [k for k, r in enumerate(rules) if r[1]]
    for _ in range(200):
        found = list({(s := rng.randint(0, 20), s + rng.randint(1, 12), rng.choice(real)) for _ in range(rng.randint(0, 12))})
        order = sorted(found, key=lambda f: (f[0], -f[1], -rules[f[2]][1], f[2]))
        kept = []
        for i, (s, e, k) in enumerate(order):
            if not any(a <= s and b >= e and rules[j][1] >= rules[k][1] for a, b, j in kept):
                kept.append((s, e, k))
        assert licenses.detections(list(found)) == [(s, e, rules[k][0], rules[k][1]) for s, e, k in kept]


def test_toxicity_of_odd_rows(spark):
    """Repeated rows, a long text, nulls, and columns with the operator's own names."""
    fixed = toxicity.Model([f"{'x' * i} nastyword" for i in range(1, 50)], [f"{'x' * i} quietword" for i in range(1, 50)])
    fixed.weights = [-6.0, 0.0, 1.0, *[0.0] * (len(toxicity.STRETCHES) - 1)]
    long = "quiet " * 200_000
    rows = [(1, "a nastyword", 0.5, "k"), (1, "a nastyword", 0.5, "k"), (2, long, 0.5, "k"), (3, long + "nastyword", 0.5, "k"), (4, None, 0.5, "k"), (None, "", 0.5, "k"), (5, "İİ \U0001f602", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double, held_out string")
    got = Counter((r["doc_id"], r["score"] >= 0.5) for r in toxicity.score(docs, fixed).collect())
    assert got == Counter([(1, True), (1, True), (2, False), (3, True), (4, False), (None, False), (5, False)])
    assert toxicity.score(docs.limit(0), fixed).isEmpty()
