"""One string against many, against the same scores pair by pair; and the fuzzy queries, against all pairs."""

import os
import random
import time

import pytest
from pyspark.sql import functions as F

from snapforge.functions import constants as K
from snapforge.functions import similarity
from snapforge.functions.similarity import Choices, TokenSets
from snapforge.functions.text import asset_identifier, company_key, match_key
from snapforge.functions.udfs import best_ratio, process, token_set_ratio
from snapforge.operators import resolve
from snapforge.plans import queries

SF = "/root/testdata/sf0.001"


def test_many_at_once_equal_pairs():
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdé01") for _ in range(rng.randint(1, 6)))
    make = lambda: process(" ".join(word() for _ in range(rng.randint(0, 5))))
    for trial in range(60):
        texts = [make() for _ in range(rng.randint(0, 30))] + ["x" * 80] * (trial % 7 == 0)
        choices, sets = Choices(texts), TokenSets(texts)
        for _ in range(10):
            q = make() * (20 if rng.random() < 0.05 else 1)
            for least in (30, 51, 80, 100):
                want = best_ratio(q, list(enumerate(texts)), least)
                assert choices.best(process(q), least) == (None if want[0] is None or want[1] < least else want)
                assert sets.near(q, least) == any(token_set_ratio(q, c) >= least for c in texts)


def test_token_sets_equal_pairs_in_classes(monkeypatch):
    """Few members make a class large, a token frequent and a plan go, so that every way through is taken."""
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdé01") for _ in range(rng.randint(1, 5)))
    for trial in range(150):
        for name, values in {"FREQUENT": (0, 1, 2, 5), "LARGE": (1, 2, 4), "FIRST": (1, 2, 8), "KEPT_CODES": (10, 1 << 20), "KEPT_PLANS": (1, 1000)}.items():
            monkeypatch.setattr(similarity, name, rng.choice(values))
        pool = [word() for _ in range(rng.choice([4, 12]))]
        make = lambda: process(" ".join(rng.choice(pool) if rng.random() < 0.6 else word() for _ in range(rng.randint(0, 5))))  # noqa: B023, E731
        texts = [make() for _ in range(rng.randint(0, 60))] + ["x" * 80] * (trial % 7 == 0)
        sets = TokenSets(texts)
        for _ in range(10):
            q = make() * (20 if rng.random() < 0.05 else 1)
            for least in (30, 51, 65, 80, 100):
                assert sets.near(q, least) == any(token_set_ratio(q, c) >= least for c in texts), (q, texts, least)


def test_token_sets_do_not_go_over_all_choices_for_each_name():
    choices = [f"customer {8 * k:09d} town {k * 7 % 25}" for k in range(30_000)]
    sets = TokenSets(choices)
    names = [f"customer {k * 397 % 900_000:09d} town {k % 25}" for k in range(2000)] + [f"s {k % 90} town {k % 25}" for k in range(2000)]
    began = time.process_time()
    found = [sets.near(n, 80) for n in names]
    assert time.process_time() - began < 5
    for k in (0, 700, 1999, 2000, 2019, 2600):
        assert found[k] == any(token_set_ratio(names[k], c) >= 80 for c in choices)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
@pytest.mark.parametrize("block", [resolve.CHOICES, 7])
def test_fuzzy_queries_equal_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(resolve, "CHOICES", block)
    holders, assets = (queries.fixture(spark, SF, n) for n in ("holders", "assets"))
    named = assets.select("ord", company_key(F.col(f"`{K.ASSET_COMPANY}`")).alias("full"), company_key(F.col(f"`{K.ASSET_SHORT}`")).alias("short"), F.col(f"`{K.ASSET_SHORT}`").alias("told"), F.col(f"`{K.ASSET_ID}`").alias("id"), match_key(F.col(f"`{K.ASSET_ID}`")).alias("norm")).orderBy("ord").collect()
    universe = [c for c in dict.fromkeys([r["full"] for r in named] + [r["short"] for r in named]) if c]
    short = {k: r["told"] for r in named for k in (r["full"], r["short"])}
    prepared = [(c, process(c)) for c in universe]
    want = {}
    for r in holders.select("ord", "Company_Name", company_key(F.col("Company_Name")).alias("k")).collect():
        match, score = best_ratio(r["k"], prepared, 0)
        want[r["ord"]] = short[match] if match and score >= K.COMPANY_SCORE else r["Company_Name"]
    assert {r["ord"]: r["Company_Name"] for r in queries.QUERIES["fuzzy_company"](spark, SF).collect()} == want
    ids, norms = [process(r["id"]) for r in named], {r["norm"] for r in named}
    found = {}
    for r in holders.select("ord", asset_identifier(F.col("Company_Name"), F.col("City")).alias("a")).withColumn("n", match_key(F.col("a"))).collect():
        found[r["ord"]] = int(r["n"] in norms or bool(r["n"]) and any(token_set_ratio(process(r["a"]), c) >= K.ASSET_SCORE for c in ids))
    assert {r["ord"]: r["Match_Found"] for r in queries.QUERIES["asset_fuzzy"](spark, SF).collect()} == found
