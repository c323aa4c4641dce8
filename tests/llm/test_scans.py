"""Personal data and secrets: long texts in time, letters that aren't ASCII, and what the boosted trees add."""

import re
import time

import pytest
from pyspark.sql import functions as F

from snapforge.llm import arrays, common, pii, secrets_scan

MEGABYTE = 1_000_000


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 64, 1000])
def test_running_totals(spark, n):
    rows = spark.range(1).select(F.transform(F.sequence(F.lit(1), F.lit(n)) if n else F.array().cast("array<int>"), lambda x: x * 7 % 10).alias("v"))
    given, sums, tops = rows.select("v", arrays.running(F.col("v")), arrays.running(F.col("v"), lambda a, b: F.greatest(a, b))).first()
    assert sums == [sum(given[: i + 1]) for i in range(n)] and tops == [max(given[: i + 1]) for i in range(n)]


def test_long_texts_of_many_matches(spark):
    """Time in proportion to the text, but for a logarithm."""
    unit = "+1 (017) 555-7713. a@b.cc (030) 123-4567, "
    texts = {1: "12," * (MEGABYTE // 3), 2: unit * 2000, 3: unit * 20}
    docs = common.stage(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), "long")
    began = time.time()
    found = pii.detect(docs)
    assert not re.search("Python|Pandas|Arrow", found._jdf.queryExecution().executedPlan().toString())
    got = {r["doc_id"]: r for r in found.collect()}
    assert time.time() - began < 120  # a quadratic scan takes many minutes
    assert got[1]["n_card"] == 0 and [got[i]["n_email"] for i in (2, 3)] == [2000, 20] and got[2]["n_phone"] == 2000
    assert got[2]["n_added"] == 100 * got[3]["n_added"] > 0


def test_added_spans_are_precise_and_found(spark):
    """On made texts of another seed; the trees saw neither half of them."""
    made = common.stage(pii.examples(spark, 1200, seed=7), "unseen")
    spans = {r["doc_id"]: [(k, int(s), int(e)) for k, s, e in (x.split(":") for x in r["spans"].split(",") if x)] for r in pii.detect(made).collect()}
    right = wrong = missed = 0
    for r in made.collect():
        truth = (pii.KINDS[r["kind"]], r["start"], r["end"])
        near = [k == truth[0] and s < truth[2] and truth[1] < e for k, s, e in spans[r["doc_id"]]]
        right += bool(r["label"] and any(near))
        missed += bool(r["label"] and not any(near))
        wrong += sum(not n or not r["label"] for n in near)
    assert right / (right + wrong) >= 0.85 and right / (right + missed) >= 0.85, (right, wrong, missed)


def test_examples_have_near_misses_of_every_kind(spark):
    made = pii.examples(spark, 400).groupBy("kind", "label").count().collect()
    assert {(r["kind"], r["label"]) for r in made} == {(k, y) for k in range(4) for y in (0, 1)} and min(r["count"] for r in made) > 20


def test_letters_that_only_unicode_folds_are_no_keyword():
    for text in ("toKen=abcdefghijklmnop", "ſecret=abcdefghijklmnop", "TOKEN: abcdefghijklmnop"):
        assert secrets_scan.spans(text) == []
    assert secrets_scan.spans("K TOKEN=abcdefghijklmnop") == [("assign", 2, 24)]


def test_one_attempt_a_run():
    began = time.time()
    for text in ("eyJ" * (MEGABYTE // 3), "eyj" * (MEGABYTE // 3), "eyJabcdefgh." * (MEGABYTE // 12), "token" * (MEGABYTE // 5), "password=" * (MEGABYTE // 9), "AKIA" * (MEGABYTE // 4), "xoxb-" * (MEGABYTE // 5), "-----BEGIN " * (MEGABYTE // 11)):
        secrets_scan.spans(text)
    assert time.time() - began < 60
    head = "eyJhbGciOiJIUzI1NiJ9"
    token = f"{head}.eyJzdWIiOiIxMjM0NTY3ODkwIn0.dozjgNryP4J3jVmNHl0w5N_XgL0n3I9P"
    assert [s for s in secrets_scan.spans(f"x {token} y") if s[0] == "jwt"] == [("jwt", 2, 2 + len(token))]
    assert [s[0] for s in secrets_scan.spans(f"eyjunk.eyjunk {token}")].count("jwt") == 1 and not re.search("jwt", str(secrets_scan.spans("eyJabcdefgh.x")))
