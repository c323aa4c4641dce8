"""Benchmark decontamination by winnowing, in DataFrame operations only.

Fingerprints. Every word sequence gets the hashes of its 5-grams; the least of each 6 consecutive ones is the fingerprint of
the 10 words they span. A fingerprint is selected once for a run of neighbouring windows that share it. Equal 10-word windows
have equal fingerprints, so a join on the selected ones finds every shared span of 10 words or more. A hit is then
verified and extended over its run: the hash of each window's own 10 words must agree too, and neighbouring hits
flow together into the spans whose words are counted. (Different windows are taken as equal only if both a shared 5-gram
hash and a 64-bit hash of all ten words coincide.)

An item of fewer than 10 words is one window of its own length, matched by the hash of all its words.

Joins. The benchmark's windows are broadcast while there are at most BROADCAST_WINDOWS of them, and they and the ids of the items that
hold them take at most BROADCAST_BYTES; both are counted first. So are its items of each size below 10 words.
Beyond that, documents are first reduced to those that share a fingerprint, by a join on each document's distinct
fingerprints, and both joins shuffle; a fingerprint held by a large share of documents is then a skewed key with few
benchmark rows on the other side, which Spark splits.

Files. The staged windows and the result are dealt out by the size of the items and of the documents, not by
shuffle.partitions, so that small tables leave few files.

Nulls: a null text has no words; an item without words or with a null id has no window. Repeated rows and ids are all
returned, each judged by its own text; repeated items count once. An empty benchmark leaves all documents clean; empty
documents give no rows. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .arrays import NOT_WORD, ahead, joined, lower_ascii, split_words

WINDOW, GRAM = 10, 5
#: Windows, and bytes of them and of the ids of the items that hold them, up to which the benchmark's side is broadcast.
BROADCAST_WINDOWS, BROADCAST_BYTES = 1_000_000, 64 << 20
#: Bytes of staged items, about 130,000 words, whose windows one task groups and writes.
GROUPED_BYTES = 1 << 20


def _words(text: Column) -> Column:
    return split_words(lower_ascii(text), NOT_WORD)


def _hashed(rows: DataFrame) -> DataFrame:
    """rows with words to rows with n (words) and h (a hash for each)."""
    return rows.withColumn("n", F.size("words")).withColumn("h", F.transform("words", lambda w: F.xxhash64(w))).drop("words")


def _windows(rows: DataFrame) -> DataFrame:
    """rows with n and h to rows with fp and whole: for each 10-word window its winnowed fingerprint and the hash of all its words."""
    n, count = F.col("n"), F.greatest(F.col("n") - (WINDOW - 1), F.lit(0))
    rows = rows.withColumn("h2", joined(F.col("h"), ahead(F.col("h"), 1, n)))
    rows = rows.withColumn("h4", joined(F.col("h2"), ahead(F.col("h2"), 2, n)))
    rows = rows.withColumn("h5", joined(F.col("h4"), ahead(F.col("h"), 4, n))).drop("h2", "h4")
    rows = rows.withColumn("h5", F.slice("h5", 1, F.greatest(n - (GRAM - 1), F.lit(0))))
    least = lambda a, b: F.zip_with(a, b, lambda x, y: F.least(x, y))
    rows = rows.withColumn("m2", least(F.col("h5"), ahead(F.col("h5"), 1, n)))
    rows = rows.withColumn("m4", least(F.col("m2"), ahead(F.col("m2"), 2, n)))
    rows = rows.withColumn("fp", F.slice(least(F.col("m4"), ahead(F.col("m2"), 4, n)), 1, count))
    return rows.withColumn("whole", F.slice(joined(F.col("h5"), ahead(F.col("h5"), GRAM, n)), 1, count)).drop("h", "h5", "m2", "m4")


def _short(rows: DataFrame, size: int) -> DataFrame:
    """rows with n and h to rows with whole: for each window of size words the hash of all of them."""
    n = F.col("n")
    rows = rows.withColumn("whole", F.col("h"))
    for k in range(1, size):
        rows = rows.withColumn("whole", joined(F.col("whole"), ahead(F.col("h"), k, n)))
    return rows.withColumn("whole", F.slice("whole", 1, F.greatest(n - (size - 1), F.lit(0)))).drop("h")


def _spread(rows: DataFrame, *keys: str) -> DataFrame:
    """A row a window: keys, pos, fp, whole."""
    pairs = F.zip_with("fp", "whole", lambda a, b: F.struct(a.alias("fp"), b.alias("whole")))
    return rows.select(*keys, F.posexplode(pairs).alias("pos", "w")).select(*keys, "pos", "w.fp", "w.whole")


def _selected(rows: DataFrame, *keys: str, lead: bool = False) -> DataFrame:
    """A row a selected fingerprint: keys, fp, start, wholes of the run of windows from start that share it; with lead, also one of nulls for each row."""
    starts = F.transform("fp", lambda x, i: F.when((i == 0) | (F.get("fp", i - 1) != x), i))
    rows = rows.withColumn("starts", F.array_compact(starts))

    def run(at: Column, i: Column) -> Column:
        after = F.coalesce(F.get("starts", i + 1), F.size("whole"))
        return F.struct(F.get("fp", at).alias("fp"), at.alias("start"), F.slice("whole", at + 1, after - at).alias("wholes"))

    runs = F.transform("starts", run)
    if lead:
        runs = F.concat(F.array(F.lit(None).cast("struct<fp:bigint,start:int,wholes:array<bigint>>")), runs)
    return rows.select(*keys, F.explode(runs).alias("w")).select(*keys, "w.fp", "w.start", "w.wholes")


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, key (one long for doc_id and null alike), digest of the text, text: rows of equal key and digest have equal results."""
    return common.id_text(docs).select("doc_id", F.coalesce("doc_id", F.lit(-1)).alias("key"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("digest"), "text")


def _matches(docs: DataFrame, benchmark: DataFrame, every: bool, broadcast_windows: int) -> DataFrame:
    """doc_id, key, digest, n, pos, size, items: a row a hit; with every, also one with null pos and items for each row of docs."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), _words(F.col("text").cast("string")).alias("words")).where("item is not null and size(words) > 0")
    items = common.stage(_hashed(items), "items")
    short_sizes = sorted(map(tuple, items.where(F.col("n") < WINDOW).groupBy("n").agg(F.count("*"), F.sum(F.octet_length("item") + 64)).collect()))  # at most 9
    long = _spread(_windows(items.where(F.col("n") >= WINDOW)), "item").groupBy("fp", "whole").agg(F.collect_set("item").alias("items"))
    long = common.stage(long.coalesce(common.tasks_for(items, GROUPED_BYTES)), "windows")
    entries, size = long.agg(F.count("*"), F.coalesce(F.sum(F.octet_length(F.array_join("items", "")) + 16 * F.size("items") + 64), F.lit(0))).first()
    small = entries <= broadcast_windows and size <= BROADCAST_BYTES

    names = ["doc_id", "key", "digest", "n"]
    hashed = _hashed(_keyed(docs).select("doc_id", "key", "digest", _words(F.col("text")).alias("words")))
    found = [*names, "pos", F.lit(WINDOW).alias("size"), "items"]
    held_by_item = F.broadcast(long.select("fp").distinct().withColumn("known", F.lit(True)))
    place = (F.col("start") + F.col("k")).alias("pos")
    if small and every:  # one pass: an entry that matches nothing stands before each document's fingerprints
        near = _selected(_windows(hashed), *names, lead=True).join(held_by_item, "fp", "left").where("known or start is null")
        near = near.select(*names, "fp", "start", F.posexplode_outer("wholes").alias("k", "whole")).select(*names, "fp", "whole", place)
        hits = near.join(F.broadcast(long), ["fp", "whole"], "left").where("items is not null or pos is null").select(*found)
    elif small:
        near = _selected(_windows(hashed.where(F.col("n") >= WINDOW)), *names).join(held_by_item, "fp")
        near = near.select(*names, "fp", "start", F.posexplode("wholes").alias("k", "whole")).select(*names, "fp", "whole", place)
        hits = near.join(F.broadcast(long), ["fp", "whole"]).select(*found)
    else:
        windows = _windows(hashed.where(F.col("n") >= WINDOW))
        held = windows.select("key", "digest", F.explode(F.array_distinct("fp")).alias("fp")).join(long.select("fp").distinct(), "fp", "left_semi")
        windows = windows.join(held.select("key", "digest").distinct(), ["key", "digest"], "left_semi")
        hits = _spread(windows, *names).join(long, ["fp", "whole"]).select(*found)
        if every:
            hits = hits.unionByName(hashed.select(*names, F.lit(None).cast("int").alias("pos"), F.lit(WINDOW).alias("size"), F.lit(None).cast("array<string>").alias("items")))
    for size, n_items, n_bytes in short_sizes:
        hinted = F.broadcast if n_items <= broadcast_windows and n_bytes <= BROADCAST_BYTES else (lambda x: x)
        known = _short(items.where(F.col("n") == size), size).select("item", F.explode("whole").alias("whole")).groupBy("whole").agg(F.collect_set("item").alias("items"))
        spread = _short(hashed.where(F.col("n") >= size), size).select(*names, F.posexplode("whole").alias("pos", "whole"))
        hits = hits.unionByName(spread.join(hinted(known), "whole").select(*names, "pos", F.lit(size).alias("size"), "items"))
    return hits


def _covered(starts: Column) -> Column:
    """Words in the union of sorted (pos, size) spans."""
    start = F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).alias("end"))

    def step(held: Column, s: Column) -> Column:
        end = F.greatest(held["end"], s["pos"] + s["size"])
        return F.struct((held["total"] + end - F.greatest(held["end"], s["pos"])).cast("long").alias("total"), end.alias("end"))

    return F.aggregate(starts, start, step)["total"]


def contamination(docs: DataFrame, benchmark: DataFrame, broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for every row."""
    hits = _matches(docs, benchmark, True, broadcast_windows)
    real = F.col("pos").isNotNull()
    each = hits.groupBy("doc_id", "digest", "n").agg(
        F.sum(F.when(real, 0).otherwise(1)).alias("rows"),
        F.sort_array(F.collect_set(F.when(real, F.struct("pos", "size")))).alias("starts"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    each = each.select("doc_id", F.col("n").cast("long").alias("n_words"), _covered(F.col("starts")).alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("starts") > 0).alias("contaminated"), "rows")
    each = each.select(*each.columns[:-1], F.explode(F.sequence(F.lit(1).cast("long"), "rows")).alias("copy")).drop("copy")
    return common.in_few_tasks(each, docs)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without the rows whose text holds a benchmark window; all its columns stay."""
    hits = _matches(docs, benchmark, False, BROADCAST_WINDOWS).select(F.col("key").alias("__key"), F.col("digest").alias("__digest")).distinct()
    same = (F.coalesce(docs[common.ID].cast("long"), F.lit(-1)) == hits["__key"]) & (F.xxhash64(F.coalesce(docs[common.TEXT], F.lit(""))) == hits["__digest"])
    return docs.join(hits, same, "left_anti")


def op9_decontaminate(spark, sf_dir: str) -> DataFrame:
    """Contract query: all documents against all benchmark items."""
    return contamination(common.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
  FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
  FROM benchmark WHERE item_id IS NOT NULL
), sizes AS (
  SELECT DISTINCT least(10, len(words)) AS size FROM b WHERE len(words) > 0
), bw AS (
  SELECT DISTINCT item, size, list_slice(words, p, p + size - 1) AS win
  FROM (SELECT item, words, least(10, len(words)) AS size, unnest(range(1, len(words) - least(10, len(words)) + 2)) AS p FROM b WHERE len(words) > 0)
), dw AS (
  SELECT doc_id, size, p, list_slice(words, p, p + size - 1) AS win
  FROM (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS p FROM d, sizes WHERE len(words) >= size)
), hit AS (
  SELECT doc_id, p, dw.size, item FROM dw JOIN bw ON dw.size = bw.size AND dw.win = bw.win
), cover AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + size)) AS q FROM hit) GROUP BY doc_id
), its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cover USING (doc_id) LEFT JOIN its USING (doc_id)
"""
