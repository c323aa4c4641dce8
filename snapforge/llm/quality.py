"""Quality rules under weak supervision, in DataFrame operations only.

Each rule looks at a document's counts and votes good (1), bad (-1) or abstains (0). Expectation-maximisation over the corpus
estimates how often each rule votes what for good and for bad documents, and so the posterior probability that a
document is good; a document is kept if that is at least KEEP and the base rules don't fail it. The corpus enters the
estimate as the counts of its vote patterns, at most 3 ** (number of rules) rows that come to the driver; the posterior is
additive in log odds and goes back into the plan as one CASE a rule.

Windows of five words are compared by 64-bit hashes. Repeats are found by sorting (hash bits, place) packed into longs, twice,
with different bits of the hash, in time n log n for any text.

Nulls: a null or empty text has no words and fails the base rules. Repeated rows are all returned, and all count in the
estimate. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .arrays import SPACE, ahead, joined, split_words

GRAM = 5
KEEP = 0.5
#: Weight of what is expected of the rules before any vote, as a share of the documents; the expected share of good ones.
PRIOR_SHARE, PRIOR_GOOD = 0.2, 0.7
PRIOR_VOTES = {1: (0.85, 0.145, 0.005), -1: (0.70, 0.10, 0.20)}  # for good and bad documents: good, abstain, bad
ROUNDS = 50
#: Frequent words of the corpus's languages: a text of sentences holds several of them.
STOP_WORDS = "the of and to in is that for it with as was on are by this la le de les des et en un une est que pour dans qui der die das und ist von den mit zu für ein eine el los las del por con una se no su".split()


def _repeated_places(rows: DataFrame, values: str, places: str, out: str) -> DataFrame:
    """Adds out: those of the places whose value also stands at another one (values and places in parallel)."""
    rows = rows.withColumn("__bits", F.length(F.bin(F.coalesce(F.array_max(places), F.lit(0).cast("long")))))
    rows = rows.withColumn("__sorted", F.sort_array(F.zip_with(values, places, lambda v, p: F.call_function("shiftleft", v, F.col("__bits")).bitwiseOR(p))))
    rows = rows.withColumn("__key", F.transform("__sorted", lambda x: F.call_function("shiftrightunsigned", x, F.col("__bits"))))
    n = F.size("__key")
    same = F.zip_with("__key", ahead(F.col("__key"), 1, n), lambda a, b: F.coalesce(a == b, F.lit(False)))
    rows = rows.withColumn("__next", same)
    before = F.concat(F.array(F.lit(False)), F.col("__next"))
    either = F.zip_with("__next", F.slice(before, 1, n), lambda a, b: a | b)
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("__bits")) - 1
    hit = F.zip_with("__sorted", either, lambda x, f: F.when(f, x.bitwiseAND(mask)))
    return rows.withColumn(out, F.sort_array(F.array_compact(hit))).drop("__bits", "__sorted", "__key", "__next")


def features(docs: DataFrame) -> DataFrame:
    """doc_id and the counts that the rules look at."""
    text = F.coalesce("text", F.lit(""))
    long = lambda c: c.cast("long")
    rows = common.id_text(docs).select("doc_id", text.alias("text"), split_words(text, SPACE).alias("words"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    rows = rows.select(
        "doc_id",
        long(F.size("words")).alias("n_words"),
        long(F.char_length(F.array_join("words", ""))).alias("word_chars"),
        long(F.regexp_count("text", F.lit("[#*$%&|<>]"))).alias("n_symbols"),
        lines.alias("lines"),
        long(F.regexp_count("text", F.lit("[A-Z]"))).alias("n_upper"),
        long(F.regexp_count("text", F.lit("[!|]"))).alias("n_marks"),
        long(F.size(F.array_intersect("words", F.array(*map(F.lit, STOP_WORDS))))).alias("n_stop"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("h"),
    )
    n = F.col("n_words").cast("int")
    rows = rows.withColumn("n_lines", long(F.size("lines"))).withColumn("n_dup_lines", long(F.size("lines") - F.size(F.array_distinct("lines")))).drop("lines")
    rows = rows.withColumn("h2", joined(F.col("h"), ahead(F.col("h"), 1, n)))
    rows = rows.withColumn("h4", joined(F.col("h2"), ahead(F.col("h2"), 2, n)))
    rows = rows.withColumn("h5", F.slice(joined(F.col("h4"), ahead(F.col("h"), GRAM - 1, n)), 1, F.greatest(n - (GRAM - 1), F.lit(0)))).drop("h", "h2", "h4")
    # texts without a repeated window, most of them, end here with empty arrays
    rows = rows.withColumn("h5", F.when(F.size(F.array_distinct("h5")) < F.size("h5"), F.col("h5")).otherwise(F.array().cast("array<bigint>")))
    rows = rows.withColumn("at", F.when(F.size("h5") > 0, F.sequence(F.lit(0).cast("long"), long(F.size("h5") - 1))).otherwise(F.array().cast("array<bigint>")))
    rows = _repeated_places(rows, "h5", "at", "first")
    rows = rows.withColumn("again", F.transform("first", lambda p: F.xxhash64(F.element_at("h5", (p + 1).cast("int")))))
    rows = _repeated_places(rows, "again", "first", "hits")
    steps = F.zip_with("hits", ahead(F.col("hits"), 1, F.size("hits")), lambda a, b: F.least(F.coalesce(b - a, F.lit(GRAM)), F.lit(GRAM)).cast("long"))
    return rows.withColumn("n_repeat_words", F.aggregate(steps, F.lit(0).cast("long"), lambda s, x: s + x)).drop("h5", "at", "first", "again", "hits")


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def _rate(name: str) -> Column:
    return F.col(name) / F.greatest("n_words", F.lit(1))


def _votes(good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def rules() -> list[tuple[str, Column]]:
    """Name and vote of each rule."""
    n, mean = F.col("n_words"), F.col("word_chars") / F.greatest("n_words", F.lit(1))
    return [
        ("length", _votes(n >= 10, n < 10)),
        ("symbols", _votes(_rate("n_symbols") < 0.05, _rate("n_symbols") > 0.3)),
        ("repeats", _votes(_rate("n_repeat_words") < 0.05, 100 * F.col("n_repeat_words") > 20 * n)),
        ("lines", _votes(F.col("n_dup_lines") == 0, 10 * F.col("n_dup_lines") > 3 * F.greatest("n_lines", F.lit(1)))),
        ("capitals", _votes(F.col("n_upper") < 0.15 * F.col("word_chars"), F.col("n_upper") > 0.4 * F.col("word_chars"))),
        ("marks", _votes(_rate("n_marks") < 0.05, _rate("n_marks") > 0.3)),
        ("stop_words", _votes(F.col("n_stop") >= F.when(n < 40, 1).otherwise(3), (F.col("n_stop") == 0) & (n >= 20))),
        ("word_length", _votes((mean >= 3) & (mean <= 9), (mean < 2) | (mean > 14))),
    ]


def estimate(patterns: list[tuple[tuple[int, ...], int]], n_rules: int) -> tuple[float, list[dict[int, float]]]:
    """(log prior odds, for each rule the log-likelihood ratio of each vote) by expectation-maximisation."""
    votes = (1, 0, -1)
    like = {y: [dict(zip(votes, PRIOR_VOTES[y], strict=True)) for _ in range(n_rules)] for y in (1, -1)}
    good = PRIOR_GOOD
    total = sum(n for _, n in patterns)
    weight = PRIOR_SHARE * total
    for _ in range(ROUNDS):
        counts = {y: [defaultdict(float) for _ in range(n_rules)] for y in (1, -1)}
        mass = 0.0
        for pattern, n in patterns:
            odds = math.log(good / (1 - good)) + sum(math.log(like[1][r][v] / like[-1][r][v]) for r, v in enumerate(pattern))
            p = 1 / (1 + math.exp(-max(-700.0, min(700.0, odds))))
            mass += n * p
            for r, v in enumerate(pattern):
                counts[1][r][v] += n * p
                counts[-1][r][v] += n * (1 - p)
        good = (mass + weight * PRIOR_GOOD) / (total + weight)
        for y, shares in PRIOR_VOTES.items():
            for r in range(n_rules):
                whole = sum(counts[y][r].values()) + weight
                like[y][r] = {v: (counts[y][r][v] + weight * s) / whole for v, s in zip(votes, shares, strict=True)}
    return math.log(good / (1 - good)), [{v: math.log(like[1][r][v] / like[-1][r][v]) for v in votes} for r in range(n_rules)]


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed, posterior, kept for every row."""
    named = rules()
    held = common.stage(features(docs).select("*", *(c.cast("byte").alias(f"vote_{name}") for name, c in named)), "features")
    told = held.groupBy(*(f"vote_{name}" for name, _ in named)).count().collect()  # at most 3 ** (number of rules)
    prior, ratios = estimate([(tuple(r)[:-1], r["count"]) for r in told], len(named)) if told else (0.0, [{1: 0.0, 0: 0.0, -1: 0.0}] * len(named))
    odds = F.lit(prior)
    for (name, _), ratio in zip(named, ratios, strict=True):
        odds = odds + F.when(F.col(f"vote_{name}") == 1, ratio[1]).when(F.col(f"vote_{name}") == -1, ratio[-1]).otherwise(ratio[0])
    posterior = 1 / (1 + F.exp(-odds))
    return held.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed().alias("base_failed"), posterior.alias("posterior"), (~base_failed() & (posterior >= KEEP)).alias("kept"))


def op6_quality(spark, sf_dir: str) -> DataFrame:
    """Contract query: all documents."""
    return judge(common.documents(spark, sf_dir))
