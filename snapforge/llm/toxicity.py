"""Toxicity by class-conditional Kneser-Ney models of words.

Each class, toxic and ordinary, has an interpolated model with absolute discounts; c is a class, v the word before w:

    P_c(w | v) = max(N_c(. v w) - D, 0) / N_c(. v .)   + share_c(v) P_c(w)     in how many left contexts the class says v w
    P_c(w)     = max(N_c(. w) - D, 0) / N_c(. .)       + share_c    P(w)       in how many left contexts the class says w
    P(w)       = the lesser of N_c(. w) / N_c(. .)     + rest       L_c(w)     what the classes share of those counts
    L_c(w)     the word's letters, in contexts of up to ORDER - 1 letters: grams of the top order are the class's own,
               all lower orders continuation counts that the classes share

All counts are of different contexts and near copies of a text are left out, so copies count once. Every share is what the discounts leave, so each level sums to
one. D is DISCOUNT: an expression seen no more often than that in a class keeps no count of its own, is smoothed alike in both
classes by the shared counts, and tells by its letters at most. A text's evidence is the length-normalised difference of its
toxic and ordinary log-likelihoods, over the whole text and over its most toxic stretches of a few lengths, as a long
text may be toxic in one place; a logistic calibration, fitted on labelled texts that the counts haven't seen, turns
it into a probability.

Learning takes a bounded sample: the FIT + CALIBRATE labelled documents of each class with the least hash of their id, none of
them held out, without those of over LONGEST characters; texts in the sample are taken whole. Ids that are labelled both
ways are left out. Scoring takes all of every document, as a map without a shuffle.

Nulls: a null or empty text has no words and gets the calibration's value for no evidence. Labels with a null id or null
label are left out. Repeated rows are all returned. Without labels of both classes every score is 0. An empty
table gives no rows. Other columns are ignored, and kept by ``drop_toxic``.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: Labelled documents of a class whose words are counted, further ones for the calibration, and characters of any one: the sample's bound.
FIT, CALIBRATE, LONGEST = 1500, 700, 50_000
#: Letters in the longest gram of the letter model.
ORDER = 5
#: The absolute discount of words and pairs: what is seen no more often keeps no count of its own.
DISCOUNT = 4
#: A word's contexts in one text count up to so many, or a text that shuffles a few words would make them frequent.
PER_TEXT = 2
#: Evidence of a single word is held within this, and within the lesser bound if it has only its letters to tell.
MOST, MOST_BY_LETTERS = 30.0, 4.0
#: Words of a stretch, and words remembered by a worker.
STRETCHES = (1, 2, 4, 12)
CACHE = 300_000
HELD_OUT_OF = 5
WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def discount(counts: Counter) -> float:
    """Kneser-Ney's n1 / (n1 + 2 n2)."""
    n1, n2 = (sum(c == k for c in counts.values()) for k in (1, 2))
    return n1 / (n1 + 2 * n2) if n1 and n2 else 0.75


class Letters:
    """Letter grams: two classes' counts of the top order over shared continuation counts."""

    def __init__(self, classes: list[Counter]):
        self.top = []
        for counted in classes:
            grams: Counter = Counter()
            for w, n in counted.items():
                padded = "^" * (ORDER - 1) + w + "$"
                for i in range(len(w) + 1):
                    grams[padded[i : i + ORDER]] += n
            d, (total, kinds) = discount(grams), self._contexts(grams)
            seen = {g: max(n - d, 0) / total[g[:-1]] for g, n in grams.items()}
            self.top.append((seen, {h: d * kinds[h] / n for h, n in total.items()}))  # own share of a gram, share left to the backoff of a context
        below, self.shared = {g for seen, _ in self.top for g in seen}, []
        for _ in range(ORDER - 1):  # continuation counts: in how many different left contexts a gram stands
            grams = Counter(g[1:] for g in below)
            self.shared.append((grams, *self._contexts(grams), discount(grams)))
            below = set(grams)
        self.alphabet = len(below) + 1
        self.known: dict[str, float] = {}

    @staticmethod
    def _contexts(grams: Counter) -> tuple[Counter, Counter]:
        total, kinds = Counter(), Counter()
        for g, n in grams.items():
            total[g[:-1]] += n
            kinds[g[:-1]] += 1
        return total, kinds

    def below(self, gram: str) -> float:
        """The shared probability of gram's last letter after the others."""
        if (p := self.known.get(gram)) is None:
            if not gram:
                return 1 / self.alphabet
            grams, total, kinds, d = self.shared[ORDER - 1 - len(gram)]
            rest, n = self.below(gram[1:]), total.get(gram[:-1], 0)
            p = (max(grams.get(gram, 0) - d, 0) + d * kinds[gram[:-1]] * rest) / n if n else rest
            if len(self.known) < CACHE:
                self.known[gram] = p
        return p

    def word(self, w: str) -> tuple[float, float]:
        """P(w) by its letters, in either class."""
        known, padded, out = self.known, "^" * (ORDER - 1) + w + "$", [1.0, 1.0]
        for i in range(len(w) + 1):
            g = padded[i : i + ORDER]
            h, low = g[:-1], g[1:]
            rest = known.get(low) or self.below(low)
            for c, (own, left) in enumerate(self.top):
                out[c] *= own.get(g, 0.0) + left.get(h, 1.0) * rest
        return max(out[0], 1e-250), max(out[1], 1e-250)


def without_copies(texts: Iterable[list[str]]) -> Iterator[list[str]]:
    """The texts but those of whose word triples a third or more stand in earlier ones."""
    seen: set[int] = set()
    for ws in texts:
        own = {hash(x) for x in zip(ws, ws[1:], ws[2:])}
        if not own or 3 * len(own & seen) < len(own):
            yield ws
        seen |= own


def discounted(counts: Counter) -> tuple[dict, float]:
    """(each one's own probability, the share left to the backoff) of counts under an absolute discount of DISCOUNT."""
    total = sum(counts.values())
    return ({w: (n - DISCOUNT) / total for w, n in counts.items() if n > DISCOUNT}, sum(min(n, DISCOUNT) for n in counts.values()) / total) if total else ({}, 1.0)


class Model:
    """Both classes' word models, and the calibration."""

    def __init__(self, toxic: list[str], ordinary: list[str]):
        pairs = []
        for texts in (toxic, ordinary):
            # continuation counts at both levels: in how many different left contexts a pair stands, so that copies of a text count once
            triples: set[tuple[str, str, str]] = set()
            for ws in without_copies(map(words_of, texts)):
                taken: Counter = Counter()
                for triple in zip(["", "", *ws], ["", *ws], ws):
                    taken[triple[2]] += 1
                    if taken[triple[2]] <= PER_TEXT:
                        triples.add(triple)
            pairs.append(Counter((v, w) for _, v, w in triples))
        contexts = [Counter(w for _, w in p) for p in pairs]
        self.own = [discounted(c) for c in contexts]
        totals = [max(1, sum(c.values())) for c in contexts]
        self.shared = {w: min(n / totals[0], contexts[1][w] / totals[1]) for w, n in contexts[0].items() if w in contexts[1]}
        self.rest = max(1e-3, 1 - sum(self.shared.values()))
        self.letters = Letters(contexts)
        self.weights: list[float] | None = None
        self.words: dict[str, tuple[float, float]] = {}
        #: For each word, the log ratio of the shares that its pairs leave to the backoff, and the evidence of pairs that keep counts of their own.
        self.after: dict[str, tuple[float, dict[str, float]]] = {}
        share, kept = [], []
        for p in pairs:
            total, left = Counter(), Counter()
            for (v, _), n in p.items():
                total[v] += n
                left[v] += min(n, DISCOUNT)
            share.append({v: left[v] / n for v, n in total.items() if left[v] < n})
            kept.append({(v, w): (n - DISCOUNT) / total[v] for (v, w), n in p.items() if n > DISCOUNT})
        for v in {*share[0], *share[1]}:
            self.after[v] = (math.log(share[0].get(v, 1.0) / share[1].get(v, 1.0)), {})
        for v, w in {*kept[0], *kept[1]}:
            p = self.word(w)
            each = [kept[c].get((v, w), 0.0) + share[c].get(v, 1.0) * p[c] for c in (0, 1)]
            self.after[v][1][w] = max(-MOST, min(MOST, math.log(each[0] / each[1])))
        self.words.clear()

    def word(self, w: str) -> tuple[float, float]:
        """P_c(w) of either class."""
        if (p := self.words.get(w)) is None:
            by_letters, low = self.letters.word(w), self.shared.get(w, 0.0)
            p = tuple(own.get(w, 0.0) + share * (low + self.rest * by_letters[c]) for c, (own, share) in enumerate(self.own))
            if len(self.words) < CACHE:
                self.words[w] = p
        return p

    def alone(self, w: str) -> float:
        """log P(w | toxic) - log P(w | ordinary), whatever stands before w."""
        a, b = self.word(w)
        most = MOST if any(w in own for own, _ in self.own) else MOST_BY_LETTERS
        return max(-most, min(most, math.log(a / b)))

    def evidence(self, words: list[str], of) -> np.ndarray:
        """log P(w | v, toxic) - log P(w | v, ordinary) of each word."""
        after, out, v = self.after.get, [], ""
        for w in words:
            if (held := after(v)) is None:
                out.append(of(w))
            elif (e := held[1].get(w)) is None:
                out.append(of(w) + held[0])
            else:
                out.append(e)
            v = w
        return np.array(out)

    def features(self, text: str | None, of) -> list[float]:
        """The length-normalised difference over the text and over its most toxic stretches."""
        e = self.evidence(words_of(text), of)
        n = len(e)
        if not n:
            return [0.0] * (1 + len(STRETCHES))
        run = np.concatenate([[0.0], np.cumsum(e)])
        return [float(run[-1] / n), *(float((run[min(k, n) :] - run[: n + 1 - min(k, n)]).max() / k) for k in STRETCHES)]

    def calibrate(self, texts: list[str], labels: list[int]) -> None:
        """Logistic regression with a little shrinkage, by Newton's method."""
        of = Remembered(self).__getitem__
        x = np.array([[1.0, *self.features(t, of)] for t in texts])
        y, w = np.array(labels, float), np.zeros(x.shape[1])
        ridge = np.diag([1e-3] + [0.3] * (len(w) - 1))
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            w = w + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
        self.weights = w.tolist()

    def score(self, text: str | None, of) -> float:
        if self.weights is None:
            return 0.0
        z = sum(a * b for a, b in zip(self.weights, [1.0, *self.features(text, of)], strict=True))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


class Remembered(dict):
    """Evidence of words alone, for up to CACHE of them."""

    def __init__(self, model: Model):
        self.model = model

    def __missing__(self, word: str) -> float:
        if len(self) >= CACHE:
            self.clear()
        made = self[word] = self.model.alone(word)
        return made


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % HELD_OUT_OF == 0


def learn(docs: DataFrame, labels: DataFrame) -> Model | None:
    """The model from the bounded sample, or None without both classes."""
    told = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic is not null")
    told = told.groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most")).where("toxic = most").where(~held_out(F.col("doc_id"))).select("doc_id", "toxic")
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = told.where("toxic = 1").orderBy(*order).limit(FIT + CALIBRATE).unionByName(told.where("toxic = 0").orderBy(*order).limit(FIT + CALIBRATE))
    short = common.id_text(docs).where(F.coalesce(F.char_length("text"), F.lit(0)) <= LONGEST)
    texts = short.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    rows = texts.orderBy(*order).collect()  # at most 2 * (FIT + CALIBRATE) texts
    fit, rest = {}, []
    for y in (1, 0):
        own = [r["text"] for r in rows if r["toxic"] == y]
        cut = min(FIT, len(own) * 2 // 3)
        fit[y] = own[:cut]
        rest += [(t, y) for t in own[cut:]]
    if not fit[1] or not fit[0]:
        return None
    model = Model(fit[1], fit[0])
    model.calibrate([t for t, _ in rest], [y for _, y in rest])
    return model


def _worker(sent) -> tuple:
    """The broadcast model, and what this worker remembers of its evidence."""
    model = sent.value
    return common.held_by_worker(("toxicity", id(model)), lambda: (model, Remembered(model) if model else None))


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, score for every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, of = _worker(sent)
        for batch in batches:
            scores = [own.score(t, of.__getitem__) if own else 0.0 for t in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return common.id_text(docs).mapInArrow(run, "doc_id long, score double")


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs without the rows scored 0.5 or more; all columns stay."""
    sent = docs.sparkSession.sparkContext.broadcast(learn(docs, labels))

    @F.pandas_udf("boolean")
    def ordinary(texts: pd.Series) -> pd.Series:
        own, of = _worker(sent)
        return texts.map(lambda t: own is None or own.score(t, of.__getitem__) < 0.5)

    return docs.where(ordinary(common.TEXT))


def op5_toxicity(spark, sf_dir: str) -> DataFrame:
    """Contract query: all documents."""
    docs = common.documents(spark, sf_dir)
    scored = score(docs, learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
