"""Language-model scoring with a Katz backoff bigram model over the whole corpus, in packed blocks; katz_tables has any order.

Tokens are a text's words, then one end; an end also stands before each text as the first token's history.

    P(w | h) = d_r c(h, w) / c(h)     for a pair seen r times; d_r is Good-Turing's discount for r <= K, else 1
             = bow(h) P(w)            for others; bow(h) is what the discounts left, over what P leaves to unseen words
    P(w)     = (1 - U) c(w) / N       for a known word; U, Good-Turing's unseen mass, belongs to the unknown word

Both levels sum to 1 exactly. A history none of whose pairs is discounted gives one count of its own to the unseen ones.

The corpus stays apart: it is packed once into blocks of documents (local word ids and a local vocabulary). Blocks ask for
counts and get them back in the order they asked in, so no text and no key travels a second time:

  words   block -> (bucket by word): words and their counts -> totals, back to the block
  pairs   block -> (bucket by history): distinct pairs and their counts -> totals and the history's counts of counts, back

A history with more than a quarter of a bucket's share of all tokens is spread over all buckets by the second word. Their sums are added
up over the buckets; while there are at most HOT_SENT of them, which is counted first, they go to all tasks with the few totals,
and else back to the blocks that hold them by a join. Pairs are pre-aggregated in their blocks. Words are compared as strings, pairs by 64-bit hashes. Every step's rows are written to
the shared folder.

Nulls: a null text is empty and has just the end. A null doc_id hashes as the empty string. Repeated rows are all
returned, and all count. An empty table gives no rows; without any training text every known count is 0. Other
columns are ignored.
"""

from __future__ import annotations

import math
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Tokens of a block, and the mean number of tokens whose pairs meet in a bucket.
BLOCK_TOKENS, BUCKET_TOKENS = 1_500_000, 4_000_000
#: A history with fewer tokens is never spread.
HOT_LEAST = 1000
#: Spread histories whose sums are sent to all tasks; of more, each block gets its own.
HOT_SENT = 100_000
#: Counts up to K are discounted.
K = 5
HELD_OUT = (7, 2)
BLOCK = "block string, docs binary, held binary, sizes binary, ids binary, words binary, counts binary"
PIECE = "bucket int, block string, data binary"
ANSWER = "kind int, bucket int, block string, data binary"
RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
MIX = np.uint64(0x9E3779B97F4A7C15)


def pack(*parts: np.ndarray) -> bytes:
    """Arrays to bytes, each in the narrowest unsigned type that holds it."""
    out = []
    for a in parts:
        if a.dtype.kind in "iu" and a.dtype != np.uint64:
            a = a.astype(np.min_scalar_type(int(a.max()))) if len(a) else a.astype(np.uint8)
        raw = a.tobytes()
        body = pa.compress(raw, codec="zstd", asbytes=True) if raw else b""
        head = np.array([ord(a.dtype.char), len(raw), len(body)], "<i8").tobytes()
        out += [head, body]
    return b"".join(out)


def unpack(raw: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(raw):
        kind, n, size = np.frombuffer(raw, "<i8", 3, at).tolist()
        body = raw[at + 24 : at + 24 + size]
        out.append(np.frombuffer(pa.decompress(body, n, codec="zstd", asbytes=True) if n else b"", chr(kind)))
        at += 24 + size
    return out


def unpack_wide(raw: bytes) -> list[np.ndarray]:
    return [a.astype(np.int64) if a.dtype != np.uint64 and a.dtype.kind == "u" else a for a in unpack(raw)]


class Vocabulary(dict):
    def __missing__(self, word: bytes) -> int:
        made = self[word] = len(self)
        return made


def is_held_out(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % HELD_OUT[0] == HELD_OUT[1]


def hashes(words: list[bytes]) -> np.ndarray:
    from xxhash import xxh64_intdigest

    return np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words))


def blocks(docs: DataFrame) -> DataFrame:
    """Documents packed into blocks: their ids, sizes, local word ids and local vocabulary with training counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, n = TaskContext.get().partitionId(), 0
        doc_ids: list[int | None] = []
        held, sizes, ids, words = [], [], array("i"), Vocabulary({b"": 0})

        def made() -> pa.RecordBatch:
            flat, size, out = np.frombuffer(ids, np.int32), np.array(sizes), np.array(held, bool)
            counts = np.bincount(flat[~np.repeat(out, size)], minlength=len(words))
            known = np.array([d is not None for d in doc_ids])
            row = [f"{part}-{n}", pack(known, np.array([d or 0 for d in doc_ids], np.int64).view(np.uint64)), pack(out), pack(size), pack(flat), pa.compress(b" ".join(words), codec="zstd", asbytes=True) + len(b" ".join(words)).to_bytes(8, "little"), pack(counts)]
            return pa.record_batch([pa.array([x]) for x in row], names=["block", "docs", "held", "sizes", "ids", "words", "counts"])

        for batch in batches:
            for doc, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                before = len(ids)
                ids.extend(map(words.__getitem__, (text or b"").lower().split()))
                ids.append(0)
                doc_ids.append(doc)
                held.append(is_held_out(doc))
                sizes.append(len(ids) - before)
                if len(ids) >= BLOCK_TOKENS:
                    yield made()
                    n += 1
                    doc_ids, held, sizes, ids, words = [], [], [], array("i"), Vocabulary({b"": 0})
        if doc_ids:
            yield made()

    raw = common.id_text(docs).withColumn(common.TEXT, F.col(common.TEXT).cast("binary"))
    return raw.mapInArrow(run, BLOCK)


def bucketed(packed: DataFrame) -> DataFrame:
    """The blocks as a table in the shared folder, bucketed by block: joins on block leave it where it is."""
    spark, name = packed.sparkSession, f"snapforge_blocks_{uuid.uuid4().hex}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed.write.option("path", common.scratch(spark, "blocks")).bucketBy(n, "block").sortBy("block").format("parquet").saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # only its name goes: the files lie at a path of their own, which the resolved table goes on reading
    return table


def local_words(raw: bytes) -> list[bytes]:
    return pa.decompress(raw[:-8], int.from_bytes(raw[-8:], "little"), codec="zstd", asbytes=True).split(b" ")


def bucket_of(keys: np.ndarray, n: int) -> np.ndarray:
    return (((keys * MIX) >> np.uint64(32)) % np.uint64(n)).astype(np.int64)


def rows_of(kinds: str, made: list[tuple]) -> pa.RecordBatch:
    names, types = zip(*((c.split()[0], {"int": pa.int32(), "string": pa.string(), "binary": pa.binary()}[c.split()[1]]) for c in kinds.split(", ")), strict=True)
    return pa.record_batch([pa.array([r[i] for r in made], t) for i, t in enumerate(types)], names=list(names))


def ask_words(packed: DataFrame, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, words, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words, (counts,) = local_words(words), unpack(counts)
                which = bucket_of(hashes(words), buckets)
                made = []
                for b in np.unique(which).tolist():
                    own = np.flatnonzero(which == b)
                    made.append((b, block, pack(np.frombuffer(b" ".join([words[i] for i in own]), np.uint8), counts[own])))
                yield rows_of(PIECE, made)

    return packed.select("block", "words", "counts").mapInArrow(run, PIECE)


def answer_words(pieces: DataFrame) -> DataFrame:
    """Rows of kind 0: totals for each asking block; one of kind 1 a bucket: tokens, known words, words seen once."""

    def run(table: pa.Table) -> pa.Table:
        asked = [(b, block, *unpack(data)) for b, block, data in zip(*(c.to_pylist() for c in table.columns), strict=True)]
        places = Vocabulary()
        told = []
        totals = np.zeros(1 << 10, np.int64)
        for b, block, words, counts in asked:
            at = np.fromiter(map(places.__getitem__, words.tobytes().split(b" ")), np.int64)
            if len(places) > len(totals):
                totals = np.concatenate([totals, np.zeros(max(len(totals), len(places)), np.int64)])
            totals[at] += counts  # a block's words are distinct
            told.append((b, block, at))
        stats = np.array([totals.sum(), (totals > 0).sum(), (totals == 1).sum()])
        return pa.Table.from_batches([rows_of(ANSWER, [(1, told[0][0], None, pack(stats)), *((0, b, block, pack(totals[at])) for b, block, at in told)])])

    return pieces.groupBy("bucket").applyInArrow(run, ANSWER)


def answers(told: DataFrame, name: str) -> DataFrame:
    return told.where("kind = 0").groupBy("block").agg(F.collect_list(F.struct("bucket", "data")).alias(name))


def totals_of(words: list[bytes], given: list[dict], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, total count) of a block's words, from the buckets' answers."""
    own = hashes(words)
    which, totals = bucket_of(own, buckets), np.zeros(len(words), np.int64)
    for x in given:
        totals[which == x["bucket"]] = unpack(x["data"])[0]
    return own, totals


class Pairs:
    """A block's distinct pairs in order, and the bucket of each."""

    def __init__(self, ids: np.ndarray, own: np.ndarray, totals: np.ndarray, hot_from: float, buckets: int):
        self.n, flat = len(own), ids.astype(np.int64)
        self.keys = np.concatenate([[0], flat[:-1]]) * self.n + flat
        self.unique = np.unique(self.keys)
        self.h, self.w = self.unique // self.n, self.unique % self.n
        self.hot = totals >= hot_from
        self.bucket = bucket_of(own[self.h] + np.where(self.hot[self.h], own[self.w] * MIX, np.uint64(0)), buckets)

    def parts(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(bucket, places in unique, its distinct histories, pairs of each)."""
        order = np.argsort(self.bucket, kind="stable")
        edge = np.flatnonzero(np.diff(self.bucket[order])) + 1
        for own in np.split(order, edge):
            hs, runs = np.unique(self.h[own], return_counts=True)
            yield int(self.bucket[own[0]]), own, hs, runs


def ask_pairs(joined: DataFrame, buckets: int, word_buckets: int, hot_from: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, held, sizes, ids, words, given in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own, totals = totals_of(local_words(words), given, word_buckets)
                (held,), (sizes,), (ids,) = unpack(held), unpack(sizes), unpack(ids)
                pairs = Pairs(ids, own, totals, hot_from, buckets)
                seen, n = np.unique(pairs.keys[~np.repeat(held, sizes)], return_counts=True)
                counts = np.zeros(len(pairs.unique), np.int64)
                counts[np.searchsorted(pairs.unique, seen)] = n
                for b, at, hs, runs in pairs.parts():
                    ws, which = np.unique(pairs.w[at], return_inverse=True)
                    yield rows_of(PIECE, [(b, block, pack(own[hs], pairs.hot[hs], runs, own[ws], totals[ws], which, counts[at]))])

    return joined.select("block", "held", "sizes", "ids", "words", "word_totals").mapInArrow(run, PIECE)


def answer_pairs(pieces: DataFrame) -> DataFrame:
    """Rows of kind 0: totals of pairs and the histories' sums for each asking block; kind 1: hot histories' sums; kind 2: counts of counts."""

    def run(table: pa.Table) -> pa.Table:
        asked = [(b, block, *unpack_wide(data)) for b, block, data in zip(*(c.to_pylist() for c in table.columns), strict=True)]
        hist = np.concatenate([np.repeat(x[2], x[4]) for x in asked])
        hot = np.concatenate([np.repeat(x[3], x[4]) for x in asked])
        word = np.concatenate([x[5][x[7]] for x in asked])
        count_w = np.concatenate([x[6][x[7]] for x in asked])
        counts = np.concatenate([x[8] for x in asked])
        key = hist * MIX ^ (word + (word << np.uint64(7)))
        del word
        _, first, where = np.unique(key, return_index=True, return_inverse=True)
        del key
        totals = np.bincount(where, counts).astype(np.int64)
        seen = np.flatnonzero(totals > 0)
        own, at = np.unique(hist, return_inverse=True)
        at = at[first[seen]]
        r, cw = totals[seen], count_w[first[seen]]
        sums = np.stack([np.bincount(at[r == k], minlength=len(own)) for k in range(1, K + 1)] + [np.bincount(at, cw, minlength=len(own)).astype(np.int64)])
        made = [(2, asked[0][0], None, pack(np.array([(r == k).sum() for k in range(1, K + 2)])))]
        hot_own = np.unique(hist[hot])
        if len(hot_own):
            made.append((1, asked[0][0], None, pack(hot_own, *sums[:, np.searchsorted(own, hot_own)])))
        start = 0
        for b, block, hs, *_, mine in asked:
            end = start + len(mine)
            made.append((0, b, block, pack(totals[where[start:end]], *sums[:, np.searchsorted(own, hs)])))
            start = end
        return pa.Table.from_batches([rows_of(ANSWER, made)])

    return pieces.groupBy("bucket").applyInArrow(run, ANSWER)


def hot_sums(pairs: DataFrame) -> DataFrame:
    """history and its sums (s1 to sK, sw) over all buckets, of the spread histories."""
    names = [*(f"s{k}" for k in range(1, K + 1)), "sw"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0).to_pylist():
                own, *sums = unpack_wide(data)
                yield pa.record_batch([pa.array(own.view(np.int64)), *map(pa.array, sums)], names=["history", *names])

    told = pairs.where("kind = 1").select("data").mapInArrow(run, "history long, " + ", ".join(f"{n} long" for n in names))
    return told.groupBy("history").agg(*(F.sum(n).alias(n) for n in names))


def hot_of_blocks(with_words: DataFrame, hot: DataFrame, word_buckets: int, hot_from: float) -> DataFrame:
    """block and hot_totals, the sums of the spread histories that it holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, words, given in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own, totals = totals_of(local_words(words), given, word_buckets)
                held = own[totals >= hot_from].view(np.int64)
                yield pa.record_batch([pa.array([block] * len(held), pa.string()), pa.array(held)], names=["block", "history"])

    held = with_words.select("block", "words", "word_totals").mapInArrow(run, "block string, history long")
    return held.join(hot, "history").groupBy("block").agg(F.collect_list(F.struct("*")).alias("hot_totals")).select("block", F.transform("hot_totals", lambda x: x.dropFields("block")).alias("hot_totals"))


def discounts(n: np.ndarray) -> np.ndarray:
    """Katz's d_1 to d_K from the counts of counts n[0] (once) to n[K]; half a count where Good-Turing's formula fails."""
    out = []
    cut = (K + 1) * n[K] / n[0] if n[0] else 1.0
    for r in range(1, K + 1):
        star = (r + 1) * n[r] / n[r - 1] if n[r - 1] else 0.0
        d = (star / r - cut) / (1 - cut) if cut < 1 else 0.0
        out.append(d if 0 < d < 1 else (r - 0.5) / r)
    return np.array(out)


class Backoff:
    """The model's numbers that every block needs; of the corpus only the totals and the hot histories' sums."""

    def __init__(self, tokens: int, known: int, once: int, counts_of_counts: np.ndarray, hot: dict[int, np.ndarray]):
        self.tokens, self.known, self.hot = tokens, known, hot
        self.unseen = min(0.5, max(once, 1) / (tokens + 1)) if tokens else 1.0
        self.d = discounts(counts_of_counts)

    def word(self, c: np.ndarray) -> np.ndarray:
        return np.where(c > 0, (1 - self.unseen) * c / max(1, self.tokens), self.unseen)

    def histories(self, c: np.ndarray, low: np.ndarray, seen_words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bow, denominator of seen pairs, whether discounts apply) of histories with c tokens, low[r - 1] pairs seen r times, and seen_words tokens of words seen after them."""
        freed = ((1 - self.d) * np.arange(1, K + 1)) @ low
        applies = freed > 0
        denominator = np.where(applies, c, c + 1)
        left = np.where(applies, freed, 1) / np.maximum(denominator, 1)
        rest = 1 - (1 - self.unseen) * seen_words / max(1, self.tokens)
        return np.where(c > 0, left / rest, 1.0), np.maximum(denominator, 1), applies

    def pair(self, r: np.ndarray, bow: np.ndarray, denominator: np.ndarray, applies: np.ndarray, word: np.ndarray) -> np.ndarray:
        d = np.where(applies & (r >= 1) & (r <= K), self.d[np.clip(r, 1, K) - 1], 1.0)
        return np.where(r > 0, d * r / denominator, bow * word)


def score_blocks(joined: DataFrame, model: Backoff, buckets: int, word_buckets: int, hot_from: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for docs, held, sizes, ids, words, given, told, hot in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own, c = totals_of(local_words(words), given, word_buckets)
                (held,), (sizes,), (ids,) = unpack(held), unpack(sizes), unpack(ids)
                spread = model.hot if hot is None else {x.pop("history") % (1 << 64): np.array(list(x.values())) for x in hot}
                pairs = Pairs(ids, own, c, hot_from, buckets)
                answer = {x["bucket"]: unpack_wide(x["data"]) for x in told}
                r, low, seen = np.zeros(len(pairs.unique), np.int64), np.zeros((K, len(own)), np.int64), np.zeros(len(own), np.int64)
                for b, at, hs, _ in pairs.parts():
                    r[at], *sums = answer[b]
                    low[:, hs], seen[hs] = sums[:K], sums[K]
                for h in np.flatnonzero(pairs.hot).tolist():
                    if (whole := spread.get(int(own[h]))) is not None:
                        low[:, h], seen[h] = whole[:K], whole[K]
                bow, denominator, applies = model.histories(c, low, seen)
                p = model.pair(r, bow[pairs.h], denominator[pairs.h], applies[pairs.h], model.word(c[pairs.w]))
                starts = np.concatenate([[0], np.cumsum(sizes.astype(np.int64))[:-1]])
                flat = ids.astype(np.int64)
                score = np.add.reduceat(np.log10(p)[np.searchsorted(pairs.unique, pairs.keys)], starts)
                base = np.log10((c + 1) / (model.tokens + model.known + 1))
                known, doc = unpack(docs)
                n = len(sizes)
                columns = [pa.array(doc.view(np.int64), mask=~known), pa.array(held), pa.array(sizes.astype(np.int64)), pa.array(np.add.reduceat((c > 0)[flat].astype(np.int64), starts)), pa.array(np.full(n, model.tokens, np.int64)), pa.array(np.add.reduceat(base[flat], starts)), pa.array(score)]
                yield pa.record_batch(columns, names=[x.split()[0] for x in RESULT.split(", ")])

    return joined.select("docs", "held", "sizes", "ids", "words", "word_totals", "pair_totals", "hot_totals").mapInArrow(run, RESULT)


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    spark = docs.sparkSession
    packed = bucketed(blocks(docs))
    n_blocks = packed.count()
    if not n_blocks:
        return spark.createDataFrame([], RESULT)
    buckets = max(1, math.ceil(n_blocks * BLOCK_TOKENS / BUCKET_TOKENS), min(n_blocks, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    words = common.stage(answer_words(ask_words(packed, buckets)), "words")
    tokens = known = once = 0
    for row in words.where("kind = 1").select("data").toLocalIterator():  # one a bucket
        a, b, c = unpack_wide(row["data"])[0].tolist()
        tokens, known, once = tokens + a, known + b, once + c
    hot_from = max(HOT_LEAST, tokens / (4 * buckets))
    with_words = packed.join(answers(words, "word_totals"), "block")
    pairs = common.stage(answer_pairs(ask_pairs(with_words, buckets, buckets, hot_from)), "pairs")
    counts_of_counts = np.zeros(K + 1, np.int64)
    for row in pairs.where("kind = 2").select("data").toLocalIterator():  # one a bucket
        counts_of_counts += unpack_wide(row["data"])[0]
    hot = common.stage(hot_sums(pairs), "hot")
    answered, sent = with_words.join(answers(pairs, "pair_totals"), "block"), {}
    if hot.count() <= HOT_SENT:
        sent = {r["history"] % (1 << 64): np.array(r[1:]) for r in hot.collect()}
        answered = answered.withColumn("hot_totals", F.lit(None).cast("array<struct<history:bigint>>"))
    else:
        answered = answered.join(hot_of_blocks(with_words, hot, buckets, hot_from), "block", "left").withColumn("hot_totals", F.coalesce("hot_totals", F.array()))
    return score_blocks(answered, Backoff(tokens, known, once, counts_of_counts, sent), buckets, buckets, hot_from)


def op8_katz(spark, sf_dir: str) -> DataFrame:
    """Contract query: all documents."""
    return score(common.documents(spark, sf_dir))
