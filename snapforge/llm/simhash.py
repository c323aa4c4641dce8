"""SimHash near-duplicates: 64-bit fingerprints, linked at 3 or fewer differing bits through a Gray-order hierarchical index.

Candidates. Only distinct fingerprints are compared, so a group of equal texts of any size is one row. Fingerprints
within 3 bits agree on one of four 16-bit blocks at least, so each stands once under each of its (block, value) keys. A key
with far more rows than the mean is dealt out again by the same argument over its other 48 bits (four blocks of 12).

Search. A task sorts the fingerprints of its keys by Gray rank, the key's bits first, so neighbours differ little. Runs of them become
nodes that factor out the bit pattern all members share, as (mask, pattern); runs of nodes become upper nodes, up to a few at the
top. Every fingerprint's search goes down from the top, and drops a node with everything below it once the bits in its mask
differ in more than 3 places, or in one of the key's own.

Groups. A key gives its fingerprints' spanning links, never all pairs; components join them.

Nulls: a null text has no words; documents without words have fingerprint zero and link like others. Null doc_ids
take no part in the minimum; a component of only null ids has a null component_id. Repeated rows
are all returned. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .components import components

RADIUS = 3
SHINGLE = 3
SEED = 42
#: Entries under one index node.
FANOUT = 16
#: (query, node) pairs held at once while searching.
FRONTIER = 4_000_000
#: Rows of a task, about.
TASK_ROWS = 1_000_000
#: A key is dealt out again above this many rows and SPLIT_MEAN times the mean.
SPLIT_LEAST, SPLIT_MEAN = 256, 16


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """The SimHash of a whole text, unsigned: a bit is 1 where it is set in over half the shingles' hashes."""
    from xxhash import xxh64_intdigest

    words = common.lower_ascii(text).split()
    if not words:
        return 0
    shingles = map(b" ".join, zip(*(words[i:] for i in range(size)))) if len(words) >= size else [b" ".join(words)]
    hashes = np.fromiter(map(xxh64_intdigest, shingles, repeat(SEED)), np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        ones += np.unpackbits(hashes[at : at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def _digest(text: str) -> Column:
    """Tells the texts of one doc_id apart; null counts as empty."""
    return F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))


def fingerprints(docs: DataFrame, digest: bool = False) -> DataFrame:
    """doc_id and fingerprint as a signed long; with digest, also the text's."""
    rows = common.id_text(docs)
    rows = rows.withColumn("digest", _digest(common.TEXT)) if digest else rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.array([fingerprint(t) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.record_batch([batch.column(0), pa.array(codes.view(np.int64)), *batch.columns[2:]], names=["doc_id", "code", *batch.schema.names[2:]])

    return rows.mapInArrow(run, "doc_id long, code long, digest long" if digest else "doc_id long, code long")


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The place of each code in reflected Gray order."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """The hierarchy over codes in Gray order: levels[k] is (mask, pattern) of the nodes k steps above the codes."""

    def __init__(self, codes: np.ndarray, exact: int = 0):
        """Codes in Gray order; linked ones must agree in the bits of exact."""
        self.codes, self.exact, self.dropped = codes, np.uint64(exact), 0
        self.levels = [(np.full(len(codes), ~np.uint64(0)), codes)]
        while len(self.levels[-1][1]) > FANOUT:
            mask, pattern = self.levels[-1]
            starts = np.arange(0, len(pattern), FANOUT)
            first = np.repeat(pattern[starts], np.diff(np.append(starts, len(pattern))))
            differ = np.bitwise_or.reduceat((pattern ^ first) | ~mask, starts)
            self.levels.append((~differ, pattern[starts] & ~differ))

    def links(self, radius: int = RADIUS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Index pairs (i, j), i < j, of codes within the radius, in blocks of queries; dropped counts the nodes above codes that were left out."""
        n = len(self.codes)
        at, step = 0, max(1, min(n, FRONTIER // max(1, n), FRONTIER // FANOUT))
        step = max(step, min(n, 4096))  # of small tasks many queries go together: a node's survivors are few
        while at < n:
            queries = np.arange(at, min(n, at + step))
            top = len(self.levels[-1][1])
            q, node = np.repeat(queries, top), np.tile(np.arange(top), len(queries))
            for depth in range(len(self.levels) - 1, -1, -1):
                m, p = self.levels[depth]
                differ = (self.codes[q] ^ p[node]) & m[node]
                near = (differ & self.exact == 0) & (np.bitwise_count(differ) <= radius)
                q, node = q[near], node[near]
                if depth:
                    self.dropped += len(near) - len(q)
                    below = len(self.levels[depth - 1][1])
                    child = (node[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                    q = np.repeat(q, FANOUT)
                    # later codes only: a node's last code is at (node + 1) * FANOUT ** depth - 1
                    kept = (child < below) & ((child + 1) * FANOUT ** (depth - 1) > q)
                    q, node = q[kept], child[kept]
            later = node > q
            yield q[later], node[later]
            at += step


def _unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the groups of a[i] and b[i] in label, which points each entry to its group's least."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(up := label[label], label):
            label[:] = up


def key_first(codes: np.ndarray, block: int, sub: int) -> tuple[np.ndarray, int]:
    """(codes with their bits moved, mask of the key's bits): the 16-bit block at the top, then, for sub 1 to 4, that 12-bit block of the others."""
    one, shift = np.uint64(1), np.uint64(16 * block)
    low = codes & ((one << shift) - one)
    high = codes >> np.uint64(16 * block + 16) if block < 3 else np.zeros_like(codes)
    rest = low | (high << shift)
    if sub:
        up = np.uint64(48 - 12 * sub)
        rest = ((rest << up) | (rest >> (np.uint64(48) - up))) & np.uint64((1 << 48) - 1) if up else rest
    width = 28 if sub else 16
    return ((codes >> shift) & np.uint64(0xFFFF)) << np.uint64(48) | rest, ((1 << width) - 1) << (64 - width)


def spanning(codes: np.ndarray, block: int = 0, sub: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes to a spanning forest of those of their links that agree in a key, as (code, its group's first code)."""
    moved, exact = key_first(codes, block, sub)
    order = np.argsort(gray_rank(moved), kind="stable")
    codes, label = codes[order], np.arange(len(codes))
    for i, j in GrayIndex(moved[order], exact).links():
        _unite(label, i, j)
    apart = label != np.arange(len(codes))
    return codes[apart], codes[label[apart]]


def near_links(codes: DataFrame) -> DataFrame:
    """Distinct codes (column code) to links (u, v) that span their groups."""
    value = lambda b, width, shift: F.shiftrightunsigned("code", shift).bitwiseAND(F.lit((1 << width) - 1))
    blocks = F.array(*(F.struct(F.lit(b).alias("b"), value(b, 16, 16 * b).alias("v")) for b in range(4)))
    keyed = codes.select("code", F.explode(blocks).alias("k")).select("code", (F.col("k.v") * 4 + F.col("k.b")).alias("key"))
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n"))
    count = codes.count()
    mean = count / (1 << 16)
    # at most 4 * 65536 / SPLIT_MEAN keys can lie so far above the mean, whatever the input
    hot = sizes.where(F.col("n") > max(SPLIT_LEAST, SPLIT_MEAN * mean)).select("key", F.lit(True).alias("hot"))
    told = keyed.join(F.broadcast(hot), "key", "left")
    # the 48 bits beside the key's block, then four blocks of 12 of them
    shift = (16 * F.col("key").bitwiseAND(F.lit(3))).cast("int")
    low = F.expr("code & (shiftleft(1L, cast(16 * (key & 3) as int)) - 1)")
    high = F.when(shift == 48, F.lit(0)).otherwise(F.expr("shiftleft(shiftrightunsigned(code, cast(least(16 * (key & 3) + 16, 63) as int)), cast(16 * (key & 3) as int))"))
    rest = low.bitwiseOR(high.cast("long"))
    again = F.array(*(F.lit(1 + s) + 8 * F.shiftrightunsigned("rest", 12 * s).bitwiseAND(F.lit(4095)) for s in range(4)))
    dealt = told.withColumn("rest", rest).select("code", "key", F.explode(F.when(F.col("hot"), again).otherwise(F.array(F.lit(0).cast("long")))).alias("sub"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [b for b in batches if b.num_rows]
        if not rows:
            return
        table = pa.Table.from_batches(rows)
        code = table.column("code").to_numpy().view(np.uint64)
        block, sub = table.column("key").to_numpy() & 3, table.column("sub").to_numpy() & 7
        for b, s in np.unique(np.stack([block, sub], axis=1), axis=0).tolist():
            u, v = spanning(code[(block == b) & (sub == s)], b, s)
            if len(u):
                yield pa.record_batch([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])

    n = max(int(codes.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-4 * count // TASK_ROWS))
    return dealt.repartition(n, "key", "sub").mapInArrow(run, "u long, v long").distinct()


def _grouped(codes: DataFrame) -> DataFrame:
    """codes, staged, with each row's component_id and centre: the code that stands for its group, whatever ids are repeated."""
    distinct = common.stage(codes.groupBy("code").agg(F.min("doc_id").alias("least")), "codes")
    star = components(near_links(distinct.select("code")))
    centred = distinct.join(star.select(F.col("u").alias("code"), F.col("v").alias("centre")), "code", "left").select("code", "least", F.coalesce("centre", "code").alias("centre"))
    group = centred.groupBy("centre").agg(F.min("least").alias("component_id"))
    member = centred.join(group, "centre").select("code", "component_id", "centre")
    return codes.join(member, "code")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, code (signed long), component_id for every row."""
    return _grouped(common.stage(fingerprints(docs), "fingerprints")).select("doc_id", "code", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """docs with one document of each group, the one with the smallest doc_id; all its columns stay.

    A document is a doc_id and a text: where one doc_id carries several texts, each is judged in its own group, and of several
    in one group the one of the least digest stays. Rows equal in both count as one; if their other columns differ, the
    row of the least hash stays (maps can't be hashed and take no part). Rows without a doc_id can't be named as members, so they stay.
    """
    least = _grouped(common.stage(fingerprints(docs, digest=True), "fingerprints")).where("doc_id = component_id")
    kept = least.groupBy("centre").agg(F.min("doc_id").alias("__kept_id"), F.min("digest").alias("__kept_digest")).drop("centre")
    named = docs.where(F.col(common.ID).isNotNull()).withColumn("__digest", _digest(common.TEXT))
    one = named.join(kept, (named[common.ID] == kept["__kept_id"]) & (named["__digest"] == kept["__kept_digest"]), "left_semi")
    columns = [(F.col(f"`{c}`"), kind) for c, kind in docs.dtypes]
    row = F.min_by(F.struct(*(c for c, _ in columns)), F.xxhash64(*(c for c, kind in columns if "map<" not in kind)))
    one = one.groupBy(common.ID, "__digest").agg(row.alias("__row")).select("__row.*")
    return one.unionByName(docs.where(F.col(common.ID).isNull()))


def op2_simhash(spark, sf_dir: str) -> DataFrame:
    """Contract query: fingerprints and components of all documents."""
    found = near_duplicates(common.documents(spark, sf_dir))
    return found.select("doc_id", F.lpad(F.lower(F.hex("code")), 16, "0").alias("fingerprint"), "component_id")
