"""Personal data by candidate gradient boosting, in DataFrame operations only.

Generators. One expression a kind finds the contract's base matches; broader ones propose spans that may overlap them: spelled-out
addresses, hexadecimal internet addresses, digit groups in the shape of a card, national phone numbers. Every candidate gets format
features (digits, separators, checksum, ending) and context features (telling words before it, counting words and units beside it,
what it touches).

Trees. No table tells what is personal data, so the trees learn from EXAMPLES texts that ``examples`` makes in the same plan: for each
kind true ones and near misses (wrong check digits, hardware addresses, amounts, part numbers, clock times), both in telling and in
misleading contexts. They go through the same generators. The features are small integers, so they enter the training as the counts
of their feature vectors, a table bounded by EXAMPLES that comes to the driver. Boosted trees of depth two are fitted to one
half of it on logistic loss, and go back into the plan as CASE expressions. Each kind's threshold is the least score from
which on the other half, unseen by the trees, is true to PRECISION. Base spans always stay; a broader candidate over the
threshold is added where it overlaps none of them.

The expressions repeat groups possessively, which changes no match (what follows a repeat can't begin inside it) but keeps the
engine from recursing on long texts; a match may begin only where a run begins or the previous match ended. Places are running
totals in log n passes, so a text of n characters takes n log n time.

Nulls: a null text is empty and has no spans. Repeated rows are all returned. An empty table gives no rows. Other
columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .arrays import running

KINDS = ("email", "ip", "card", "phone")
#: The contract's expressions, in possessive form.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Broader proposals; runs are bounded, so each place costs a bounded time.
BROAD = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?[\[({<]at[\])}>]\x20?[A-Za-z0-9-]{1,63}+(?:\x20?(?:\.|[\[({<]dot[\])}>])\x20?[A-Za-z0-9-]{1,63}+){1,5}+",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}+:){5,7}+[0-9A-Fa-f]{1,4}+(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9.])[0-9]{4}+(?:[\x20./_-][0-9]{4,6}+){2,4}+(?![0-9])",
    "phone": r"(?<![0-9+.-])\(?[0-9]{2,4}+\)?[\x20./-]{1,2}+[0-9]{3,4}+[\x20./-][0-9]{3,5}+(?![0-9])",
}
#: A text without this holds no match, which spares it the expression.
NEEDS = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9]", "phone": r"\+[0-9]"}
BROAD_NEEDS = {"email": r"(?:[\[({<]at[\])}>])", "ip": r"[0-9A-Fa-f]:[0-9A-Fa-f]", "card": r"[0-9]{4}[\x20./_-][0-9]{4}", "phone": r"[0-9]{2}\)?[\x20./-]{1,2}[0-9]{3}"}
CONTEXT = {
    "email": r"(?i)(?:mail|contact|write|reach|send|from|to)\W{0,3}$",
    "ip": r"(?i)(?:\bip|addr\w*|host|server|from|client)\W{0,3}$",
    "card": r"(?i)(?:card|visa|master\w*|amex|pay\w*|account|number|nr|no)\W{0,3}$",
    "phone": r"(?i)(?:phone|tel|call|fax|mobile|cell|contact|number|nr|at)\W{0,3}$",
}
#: Beside a match, these tell of something else: sums, versions, part numbers, measures.
COUNTER_BEFORE = r"(?i)(?:[$€£#]|\b(?:eur|usd|gbp|isbn|issn|order|serial|version|part|batch|item|lot|article|total|sum|page|mac)\W{0,2})\s?$"
COUNTER_AFTER = r"(?i)^\s?(?:[%$€£]|(?:eur|usd|gbp|kg|km|mm|pages?|units?|pieces|pcs|am|pm|o'clock)\b)"
#: An address that ends in letters, as top-level domains do.
ENDING = r"[A-Za-z]{2,24}$"
BEFORE, AFTER = 24, 12
#: Feature name and its largest value; all are integers from 0.
FEATURES = (("kind", 3), ("digits", 20), ("separators", 8), ("luhn", 1), ("context", 1), ("counter", 1), ("ending", 1), ("touches", 1))
TREES, RATE = 30, 0.3
PRECISION = 0.9
#: Made texts from which the trees learn, half of them for the thresholds.
EXAMPLES = 3000
CANDIDATE = "struct<kind:int,start:int,end:int,base:boolean,plain:int," + ",".join(f"{name}:int" for name, _ in FEATURES[1:]) + ">"


def _located(pieces: Column, matches: Column) -> Column:
    """(start, end, match, before, after) of matches, from the text's pieces between them; in code points."""
    after = F.slice(pieces, F.lit(2), F.size(matches))
    pairs = F.zip_with(F.slice(pieces, F.lit(1), F.size(matches)), matches, lambda p, m: F.struct(F.char_length(p).alias("gap"), F.char_length(m).alias("size"), m.alias("match"), F.substring(p, -BEFORE, BEFORE).alias("before")))
    pairs = F.zip_with(pairs, after, lambda x, p: F.struct(x["gap"].alias("gap"), x["size"].alias("size"), x["match"].alias("match"), x["before"].alias("before"), F.substring(p, 1, AFTER).alias("after")))
    ends = running(F.transform(pairs, lambda x: x["gap"] + x["size"]))
    return F.zip_with(pairs, ends, lambda x, end: F.struct((end - x["size"]).alias("start"), end.alias("end"), x["match"].alias("match"), x["before"].alias("before"), x["after"].alias("after")))


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether a string of at least one digit passes Luhn's check."""
    def value(i: Column) -> Column:
        d = F.ascii(F.call_function("substr", digits, -i, F.lit(1))) - 48
        twice = d * 2
        return F.when(i % 2 == 1, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.transform(F.sequence(F.lit(1), F.char_length(digits)), value), F.lit(0), lambda a, b: a + b) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    """The base check of a base match."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
        return match.rlike(rf"^{part}(?:\.{part}){{3}}$")
    digits = _digits(match)
    n = F.char_length(digits)
    return F.when(n.between(16, 19), _luhn(digits)).otherwise(F.lit(False)) if kind == "card" else n.between(8, 15)


def _candidate(kind: str, base: bool, x: Column) -> Column:
    digits = _digits(x["match"])
    n = F.char_length(digits)
    return F.struct(
        F.lit(KINDS.index(kind)).alias("kind"),
        x["start"].alias("start"),
        x["end"].alias("end"),
        (_valid(kind, x["match"]) if base else F.lit(False)).alias("base"),
        F.lit(int(base)).alias("plain"),
        F.least(n, F.lit(20)).alias("digits"),
        F.least(F.char_length(F.regexp_replace(x["match"], "[^\\x20.()/_:-]", "")), F.lit(8)).alias("separators"),
        F.when(n.between(12, 19), _luhn(digits).cast("int")).otherwise(0).alias("luhn"),
        x["before"].rlike(CONTEXT[kind]).cast("int").alias("context"),
        (x["before"].rlike(COUNTER_BEFORE) | x["after"].rlike(COUNTER_AFTER)).cast("int").alias("counter"),
        x["match"].rlike(ENDING).cast("int").alias("ending"),
        (x["before"].rlike("[0-9A-Za-z]$") | x["after"].rlike("^[0-9A-Za-z]")).cast("int").alias("touches"),
    ).cast(CANDIDATE)


def _candidates_of(kind: str, base: bool, pieces: Column, matches: Column) -> Column:
    made = F.transform(_located(pieces, matches), lambda x: _candidate(kind, base, x))
    return F.when(F.size(matches) > 0, made).otherwise(F.array().cast(f"array<{CANDIDATE}>"))


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id and candidates, an array of all generators' spans with their features."""
    rows = common.id_text(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    sources = [(k, True, BASE[k], NEEDS[k]) for k in KINDS] + [(k, False, BROAD[k], BROAD_NEEDS[k]) for k in KINDS]
    none = F.array().cast("array<string>")
    for i, (_, _, expression, needs) in enumerate(sources):
        rows = rows.withColumn(f"m{i}", F.when(F.col("text").rlike(needs), F.regexp_extract_all("text", F.lit(expression), F.lit(0))).otherwise(none))
    for i, (_, _, expression, _) in enumerate(sources):
        rows = rows.withColumn(f"s{i}", F.when(F.size(f"m{i}") > 0, F.split("text", expression, -1)).otherwise(none))
    found = [_candidates_of(kind, base, F.col(f"s{i}"), F.col(f"m{i}")) for i, (kind, base, _, _) in enumerate(sources)]
    return rows.select("doc_id", F.concat(*found).alias("candidates"))


class Boosted:
    """Trees of depth two on counted feature vectors."""

    def __init__(self, rows: list[tuple[tuple[int, ...], int, int]]):
        """rows: (features, label, count)."""
        self.trees: list[tuple] = []
        self.score = {x: 0.0 for x, _, _ in rows}
        self.rows = rows
        positive, total = sum(n for _, y, n in rows if y), sum(n for *_, n in rows)
        self.start = math.log((positive + 1) / (total - positive + 1))
        for _ in range(TREES if 0 < positive < total else 0):
            told = []
            for x, y, n in rows:
                p = 1 / (1 + math.exp(-self.start - self.score[x]))
                told.append((x, n * (y - p), n * p * (1 - p)))
            tree = self._grow(told, 2)
            self.trees.append(tree)
            for x in self.score:
                self.score[x] += self._value(tree, x)

    @staticmethod
    def _leaf(told: list[tuple]) -> float:
        return RATE * sum(g for _, g, _ in told) / (sum(h for *_, h in told) + 1.0)

    def _grow(self, told: list[tuple], depth: int) -> tuple:
        gain = lambda part: sum(g for _, g, _ in part) ** 2 / (sum(h for *_, h in part) + 1.0)
        best = (1e-6, None)
        if depth:
            whole = gain(told)
            for f, (_, most) in enumerate(FEATURES):
                for cut in range(most):
                    low, high = [t for t in told if t[0][f] <= cut], [t for t in told if t[0][f] > cut]
                    if low and high and (got := gain(low) + gain(high) - whole) > best[0]:
                        best = (got, (f, cut, low, high))
        if best[1] is None:
            return (self._leaf(told),)
        f, cut, low, high = best[1]
        return f, cut, self._grow(low, depth - 1), self._grow(high, depth - 1)

    def _value(self, tree: tuple, x: tuple[int, ...]) -> float:
        while len(tree) > 1:
            tree = tree[2] if x[tree[0]] <= tree[1] else tree[3]
        return tree[0]

    def value(self, x: tuple[int, ...]) -> float:
        """The trees' sum for a feature vector."""
        return sum(self._value(tree, x) for tree in self.trees)

    def thresholds(self, rows: list[tuple[tuple[int, ...], int, int]]) -> list[float]:
        """For each kind the least score at which the candidates of rows from it on are true to PRECISION, by their counts."""
        out = []
        for kind in range(len(KINDS)):
            by_score: dict[float, list[int]] = {}
            for x, y, n in rows:
                if x[0] == kind:
                    held = by_score.setdefault(round(self.value(x), 9), [0, 0])
                    held[0] += n * y
                    held[1] += n
            least, true, total = math.inf, 0, 0
            for s in sorted(by_score, reverse=True):
                true, total = true + by_score[s][0], total + by_score[s][1]
                if true >= PRECISION * total:
                    least = s
            out.append(least)
        return out

    def column(self, c: Column) -> Column:
        """The score of a candidate as an expression."""
        def of(tree: tuple) -> Column:
            return F.lit(tree[0]) if len(tree) == 1 else F.when(c[FEATURES[tree[0]][0]] <= tree[1], of(tree[2])).otherwise(of(tree[3]))

        total = F.lit(0.0)
        for tree in self.trees:
            total = total + of(tree)
        return total


def examples(spark: SparkSession, n: int = EXAMPLES, seed: int = 1) -> DataFrame:
    """doc_id, text, kind, start, end, label: made texts with one true or false item each, by expressions over a range."""
    h = lambda key, m: F.pmod(F.xxhash64(F.col("id"), F.lit(f"{seed} {key}")), F.lit(m))
    pick = lambda key, *of: F.element_at(F.array(*(x if isinstance(x, Column) else F.lit(x) for x in of)), (h(key, len(of)) + 1).cast("int"))
    number = lambda key, size: F.lpad(h(key, 10**size).cast("string"), size, "0")
    hexes = lambda key, size: F.lpad(F.lower(F.hex(h(key, 16**size))), size, "0")
    joined = lambda sep, *parts: F.concat_ws(sep, *parts)
    name, host = pick("name", "anna.k", "j_doe", "info", "maria", "paul99", "sales"), pick("host", "mail", "example", "firm-x", "web")
    at, dot = pick("at", " [at] ", "(at)", " (at) ", "{at}"), pick("dot", " [dot] ", "(dot)", ".", " (dot) ")
    # a card number of 16 digits whose last one is the check digit, or up to 9 more
    check = lambda body: (10 - F.aggregate(F.transform(F.split(body, ""), lambda c, i: F.when(i % 2 == 1, c.cast("int")).otherwise(c.cast("int") * 2 % 10 + F.floor(c.cast("int") / 5).cast("int"))), F.lit(0), lambda a, b: a + b) % 10) % 10
    wrong = F.when(F.col("label") == 1, 0).otherwise(1 + h("wrong", 9).cast("int"))
    sep = pick("sep", ".", "/", "_")
    items = {
        "email": (
            joined("", name, at, host, dot, pick("tld", "com", "org", "de", "net")),
            pick("no_email", F.concat(F.lit("meet (at) "), number("a", 2), F.lit("."), number("b", 2)), F.concat(F.lit("v[at]"), number("a", 1), F.lit("."), number("b", 1)), F.concat(F.lit("score {at} "), number("a", 1), F.lit("."), number("c", 3))),
        ),
        "ip": (joined(":", *(hexes(f"g{i}", 4) for i in range(8))), joined(":", *(hexes(f"m{i}", 2) for i in range(6)))),
        "card": (F.col("card"),) * 2,
        "phone": (
            pick("phone", F.concat(F.lit("(0"), number("p1", 2), F.lit(") "), number("p2", 3), F.lit("-"), number("p3", 4)), F.concat(F.lit("0"), number("p1", 2), F.lit(" "), number("p2", 4), F.lit(" "), number("p3", 4)), F.concat(F.lit("0"), number("p1", 3), F.lit("/"), number("p2", 3), F.lit(" "), number("p3", 4))),
            pick("no_phone", F.concat(number("q1", 2), F.lit(" 000 000")), F.concat(number("q1", 3), F.lit("-"), number("q2", 4), F.lit("-"), number("q3", 3)), F.concat(number("q1", 2), F.lit("."), number("q2", 3), F.lit("."), number("q3", 3))),
        ),
    }
    telling = {"email": ("contact ", "mail to ", "write "), "ip": ("server ", "host ", "address "), "card": ("card ", "paid by visa ", "account "), "phone": ("call ", "phone ", "tel. ", "fax ")}
    counting = ("a total of ", "part ", "order ", "version ", "serial ", "batch ", "mac ")
    kind = (F.col("id") % 4).cast("int")
    of_kind = lambda f: F.element_at(F.array(*(f(k) for k in KINDS)), kind + 1)
    rows = spark.range(n).withColumn("label", h("label", 2).cast("int")).withColumn("body", F.substring(F.concat(pick("prefix", "4", "5", "37", "6011"), number("body", 15)), 1, 15))
    rows = rows.withColumn("card", F.concat("body", ((check(F.col("body")) + wrong) % 10).cast("string"))).withColumn("sep", sep)
    rows = rows.withColumn("card", F.regexp_replace(F.regexp_replace("card", "([0-9]{4})(?=[0-9])", "$1-"), F.lit("-"), F.col("sep")))
    rows = rows.withColumn("item", of_kind(lambda k: F.when(F.col("label") == 1, items[k][0]).otherwise(items[k][1])))
    true = F.col("label") == 1
    said = lambda k: pick("tell", *telling[k])
    # most true ones stand in a telling context and most false ones in a counting one, but some of either do not
    lead = F.when(h("lead", 10) < F.when(true, 8).otherwise(1), of_kind(said)).when(h("lead", 10) < F.when(true, 9).otherwise(7), pick("plain", "then ", "and so ", "here ")).otherwise(pick("count", *counting))
    lead = F.when(true & (h("lead", 10) == 9), F.lit("see ")).otherwise(lead)
    tail = F.when(~true & (h("tail", 2) == 0), pick("unit", " EUR", " units", " kg", " pages")).otherwise(pick("end", ".", ", then on", " and more", ""))
    rows = rows.withColumn("lead", F.concat(F.lit("Some words "), lead)).withColumn("tail", tail)
    start = F.char_length("lead")
    return rows.select(F.col("id").alias("doc_id"), F.concat("lead", "item", "tail").alias("text"), kind.alias("kind"), start.alias("start"), (start + F.char_length("item")).alias("end"), "label")


def train(spark: SparkSession) -> tuple[Boosted, list[float]]:
    """The trees, and each kind's threshold, from the broader generators' candidates in the made texts."""
    made = common.stage(examples(spark), "examples")
    told = made.select("doc_id", F.col("kind").alias("t_kind"), F.col("start").alias("t_start"), F.col("end").alias("t_end"), "label")
    found = common.stage(candidates(made), "candidates").join(told, "doc_id").select("*", F.explode("candidates").alias("c")).where("c.plain = 0")
    hit = (F.col("c.kind") == F.col("t_kind")) & (F.col("c.start") < F.col("t_end")) & (F.col("t_start") < F.col("c.end"))
    y = F.when(hit, F.col("label")).otherwise(0)
    counts = found.groupBy(*(F.col(f"c.{name}").alias(name) for name, _ in FEATURES), y.alias("y"), F.pmod(F.xxhash64("doc_id"), F.lit(2)).alias("fold")).count().collect()
    rows = [sorted((tuple(r)[: len(FEATURES)], r["y"], r["count"]) for r in counts if r["fold"] == fold) for fold in (0, 1)]
    model = Boosted(rows[0])
    return model, model.thresholds(rows[1])


def _told(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda c: F.concat(F.element_at(names, c["kind"] + 1), F.lit(":"), c["start"].cast("string"), F.lit(":"), c["end"].cast("string"))), ",")


def _clear(base: Column, others: Column) -> Column:
    """Those of the others that overlap no base span; by the furthest end of the base spans before each and the nearest start of those after it."""
    event = lambda x, other: F.struct(x["start"].alias("start"), F.lit(other).alias("other"), x["end"].alias("end"), x["kind"].alias("kind"))
    both = F.array_sort(F.concat(F.transform(base, lambda x: event(x, 0)), F.transform(others, lambda x: event(x, 1))))
    far = F.lit((1 << 31) - 1)
    ends = running(F.transform(both, lambda x: F.when(x["other"] == 0, x["end"]).otherwise(0)), lambda a, b: F.greatest(a, b))
    starts = F.reverse(running(F.reverse(F.transform(both, lambda x: F.when(x["other"] == 0, x["start"]).otherwise(far))), lambda a, b: F.least(a, b), far))
    told = F.zip_with(F.zip_with(both, ends, lambda x, e: F.struct(x.alias("x"), e.alias("e"))), starts, lambda y, s: F.struct(y["x"].alias("x"), (y["e"] <= y["x"]["start"]).alias("after"), (s >= y["x"]["end"]).alias("before")))
    kept = F.filter(told, lambda y: (y["x"]["other"] == 1) & y["after"] & y["before"])
    return F.transform(kept, lambda y: F.struct(y["x"]["kind"].alias("kind"), y["x"]["start"].alias("start"), y["x"]["end"].alias("end")))


def detect(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added for every row; a map without a shuffle."""
    model, cuts = train(docs.sparkSession)
    slim = lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"))

    def over(c: Column) -> Column:
        cut = F.lit(None).cast("double")
        for kind, least in enumerate(cuts):
            if math.isfinite(least):
                cut = F.when(c["kind"] == kind, F.lit(least - 1e-6)).otherwise(cut)
        return (c["plain"] == 0) & F.coalesce(model.column(c) >= cut, F.lit(False))

    none = F.array().cast("array<struct<kind:int,start:int,end:int>>")
    spans = candidates(docs).select("doc_id", F.array_sort(F.transform(F.filter("candidates", lambda c: c["base"]), slim)).alias("base"), F.transform(F.filter("candidates", over), slim).alias("likely"))
    rows = spans.withColumn("added", F.when(F.size("likely") > 0, _clear(F.col("base"), F.col("likely"))).otherwise(none))
    of_kind = lambda k: F.size(F.filter("base", lambda b: b["kind"] == k)).cast("long")
    counts = [of_kind(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return rows.select("doc_id", *counts, F.sha2(_told(F.col("base")), 256).alias("base_sha256"), _told(F.array_sort(F.concat("base", "added"))).alias("spans"), F.size("added").cast("long").alias("n_added"))


def op4_pii(spark, sf_dir: str) -> DataFrame:
    """Contract query: all documents."""
    return detect(common.documents(spark, sf_dir))
