"""Token-id output: Arrow stream files of fixed-size-list batches.

A shard is one Arrow IPC stream with the schema

    input_ids  fixed_size_list<uint16 or uint32>[sequence_length]
    mask       fixed_size_list<uint8>[sequence_length / 8]  a bit each, lowest first; 1: a token, 0: padding

The documents of a shard stand in ascending order of doc_id, each closed by the end id, and run on across sequences; only
a shard's last sequence is padded. All buffers are uncompressed and of equal length a row, so a memory-mapped
shard gives sequence i without a copy (``sequence(i)``). Beside it lies ``<shard>.index``, an Arrow stream of
(doc_id, start, n_tokens), start within the shard. Shards are ordered; the manifest adds the ids of all earlier shards.

Nulls: a null text is an empty document (just the end id); rows with a null doc_id come first, as Spark sorts them. Repeated
rows and ids are all kept; rows of one doc_id are ordered by a hash of their text, so equal inputs give equal ids (but for texts
of one doc_id whose 64-bit hashes collide). An empty table
gives no shard and no rows. Other columns are ignored.
"""

from __future__ import annotations

import itertools
import json
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import qualified
from . import common
from .pieces import CORES, Pieces, blocks, by_piece, lowers

SEQUENCE_LENGTH = 1024
#: Sequences in one record batch.
BATCH_SEQUENCES = 256
#: New cores that go to the library in one call.
JOINED = 10_000
#: Texts that go to the library in one call where pieces play no part.
WHOLE = 64
#: Ids that one task reads back; small shards are read by few tasks, so that they leave few files.
READ_IDS = 4_000_000
MANIFEST = "shard int, path string, n_tokens long, n_docs long"
INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


@lru_cache(maxsize=4)
def load_tokenizer(path: str):
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path)
    made.no_truncation()
    made.no_padding()
    return made


def worker_encoder(path: str) -> LibraryEncoder:
    """One encoder a Python worker, so that what it remembers outlives a task."""
    return common.held_by_worker(("library encoder", path), lambda: LibraryEncoder(path))


class LibraryEncoder:
    """Whole texts to ids with the tokenizers library: by pieces where the tokenizer's splitting expression allows it (see pieces), else text by text."""

    def __init__(self, path: str, cores: int = CORES):
        self.tokenizer = load_tokenizer(path)
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        self.width = np.dtype("<u2" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")
        #: An added token that parts cores in one call, as no core of that call holds a bracket.
        self.mark = next(((t["content"].encode(), t["id"]) for t in told.get("added_tokens", [])), None)
        self.pieces = Pieces(self._encode, self.width, lowers(told), cores) if self.mark and by_piece(told) else None

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.asarray(e.ids, self.width) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode(self, cores: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each core has, and all of them; the library goes over many at once."""
        sizes, flat = [], []
        for bracket, run in itertools.groupby(cores, lambda c: b"<" in c or b">" in c):
            run = list(run)
            for at in range(0, len(run), 1 if bracket else JOINED):
                some = run[at : at + (1 if bracket else JOINED)]
                (ids,) = self._ids([(b"" if bracket else self.mark[0]).join(some).decode("utf-8", "replace")])
                if bracket:
                    sizes.append(np.array([len(ids)]))
                    flat.append(ids)
                    continue
                marks = np.flatnonzero(ids == self.mark[1])
                if len(marks) != len(some) - 1:
                    raise ValueError("the tokenizer's added token doesn't part pieces")
                sizes.append(np.diff(np.concatenate([[-1], marks, [len(ids)]])) - 1)
                flat.append(np.delete(ids, marks))
        return np.concatenate(sizes), np.concatenate(flat)

    def encode(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, bool]]:
        """Blocks of (first row, ids of each row, all ids, whether the last row goes on in the next block)."""
        if self.pieces:
            for first, some, more in blocks(texts):
                yield first, *self.pieces.ids(some), more
            return
        for at in range(0, len(texts), WHOLE):
            each = self._ids(pc.fill_null(texts.slice(at, WHOLE), "").to_pylist())
            yield at, np.array([len(e) for e in each]), np.concatenate(each), False


class ShardWriter:
    """Appends documents to one shard, holding one record batch in memory."""

    def __init__(self, base: str, width: np.dtype, sequence_length: int):
        self.fs, self.path = common.open_fs(base)
        self.fs.create_dir(self.path.rpartition("/")[0], recursive=True)
        if sequence_length % 8:
            raise ValueError("sequence_length must be a multiple of 8")
        self.length, self.width, self.pending, self.held, self.total, self.docs = sequence_length, width, [], 0, 0, 0
        self.opened: int | None = None  # where the document that goes on has begun
        kind = pa.from_numpy_dtype(width)
        self.schema = pa.schema([("input_ids", pa.list_(pa.field("item", kind, False), sequence_length)), ("mask", pa.list_(pa.field("item", pa.uint8(), False), sequence_length // 8))])
        self.sink = self.fs.open_output_stream(self.path, compression=None)
        self.stream = pa.ipc.new_stream(self.sink, self.schema)
        self.index_sink = self.fs.open_output_stream(f"{self.path}.index", compression=None)
        self.index = pa.ipc.new_stream(self.index_sink, INDEX)

    def add(self, doc_ids: pa.Array, sizes: np.ndarray, flat: np.ndarray, end_id: int, more: bool = False) -> None:
        """Documents' ids, an end id after each; with more, the last one goes on in the next call."""
        closed = len(sizes) - more
        flat = np.insert(flat, np.cumsum(sizes)[:closed], end_id)
        sizes = sizes[:closed] + 1
        ends = self.total + np.cumsum(sizes)
        starts = np.concatenate([[self.opened if self.opened is not None else self.total], ends])[:closed].astype(np.int64)
        if closed:
            self.index.write_batch(pa.record_batch([doc_ids.slice(0, closed), pa.array(starts), pa.array(ends - starts)], schema=INDEX))
        if more and (closed or self.opened is None):
            self.opened = int(ends[-1]) if closed else self.total
        elif not more:
            self.opened = None
        self.docs += closed
        self.total += len(flat)
        self.held += len(flat)
        self.pending.append(flat.astype(self.width).tobytes())
        if self.held >= self.length * BATCH_SEQUENCES:
            self._flush()

    def _flush(self, last: bool = False) -> None:
        flat = np.frombuffer(b"".join(self.pending), self.width)
        whole = len(flat) // self.length * self.length
        pad = -len(flat) % self.length if last else 0
        body, rest = (np.concatenate([flat, np.zeros(pad, self.width)]), flat[:0]) if last else (flat[:whole], flat[whole:])
        mask = np.ones(len(body), np.uint8)
        if pad:
            mask[-pad:] = 0
        step = self.length * BATCH_SEQUENCES
        for at in range(0, len(body), step):
            parts = body[at : at + step], np.packbits(mask[at : at + step], bitorder="little")
            columns = [pa.FixedSizeListArray.from_arrays(pa.array(x), type=f.type) for x, f in zip(parts, self.schema, strict=True)]
            self.stream.write_batch(pa.record_batch(columns, schema=self.schema))
        self.pending, self.held = [rest.tobytes()] if len(rest) else [], len(rest)

    def close(self) -> None:
        self._flush(last=True)
        for x in (self.stream, self.sink, self.index, self.index_sink):
            x.close()


class ShardReader:
    """A shard, mapped where the file system is local."""

    def __init__(self, base: str):
        filesystem, path = common.open_fs(base)
        local = filesystem.type_name == "local"
        self.source = pa.memory_map(path) if local else filesystem.open_input_stream(path)
        self.stream = pa.ipc.open_stream(self.source)
        self.index = pa.ipc.open_stream(filesystem.open_input_stream(f"{path}.index"))

    def sequences(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids, packed mask) of each record batch as 2-d views of the file's own bytes."""
        for batch in self.stream:
            n = batch.num_rows
            yield tuple(batch.column(i).flatten().to_numpy(zero_copy_only=True).reshape(n, -1) for i in (0, 1))

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, start, ids) of each document, holding one batch and the document at hand."""
        batches = (ids.reshape(-1)[: int(np.bitwise_count(mask).sum())] for ids, mask in self.sequences())  # only a tail is padding
        held = np.empty(0, np.uint16)
        for rows in self.index:
            for doc, start, n in zip(*(c.to_pylist() for c in rows.columns), strict=True):
                parts = [held]
                have = len(held)
                while have < n:
                    parts.append(next(batches))
                    have += len(parts[-1])
                held = np.concatenate(parts) if len(parts) > 1 else held
                yield doc, start, held[:n]
                held = held[n:]


class Sequences:
    """Random access to a mapped shard: sequence(i) is (ids, packed mask) without a copy."""

    def __init__(self, base: str):
        self.parts = list(ShardReader(base).sequences())
        self.ends = np.cumsum([len(x[0]) for x in self.parts])

    def __len__(self) -> int:
        return int(self.ends[-1]) if len(self.ends) else 0

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        k = int(np.searchsorted(self.ends, i, "right"))
        row = i - (int(self.ends[k - 1]) if k else 0)
        return self.parts[k][0][row], self.parts[k][1][row]


def write_tokens(docs: DataFrame, out_dir: str, tokenizer_path: str, end_id: int = 2, sequence_length: int = SEQUENCE_LENGTH, shards: int | None = None) -> DataFrame:
    """Encode all documents into shards under out_dir and return the manifest (shard, path, n_tokens, n_docs).

    One range shuffle carries the texts: by doc_id, then a hash of the text, then the row's place in the input, so no repeated or
    missing doc_id has to go to one task; shards are TASK_BYTES of input each, or shuffle.partitions if that is more. A shard
    is written by one task, under a name of its own for each attempt, so a task that ran twice leaves an unused file and
    never a broken one. The manifest has a row a shard; it is all that the driver sees, and it goes there without files of its own.
    """
    spark, out_dir = docs.sparkSession, qualified(docs.sparkSession, out_dir)
    rows = common.id_text(docs).select(common.ID, F.xxhash64(common.TEXT).alias("digest"), F.monotonically_increasing_id().alias("place"), common.TEXT)
    shards = shards or max(int(spark.conf.get("spark.sql.shuffle.partitions")), common.tasks_for(docs))
    ordered = rows.repartitionByRange(shards, common.ID, "digest", "place").sortWithinPartitions(common.ID, "digest", "place").select(common.ID, common.TEXT)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, writer = worker_encoder(tokenizer_path), None
        shard = TaskContext.get().partitionId()
        path = f"{out_dir}/part-{shard:06d}-{uuid.uuid4().hex}.arrows"
        for batch in batches:
            if batch.num_rows:
                writer = writer or ShardWriter(path, encoder.width, sequence_length)
                for first, sizes, flat, more in encoder.encode(batch.column(1)):
                    writer.add(batch.column(0).slice(first, len(sizes)), sizes, flat, end_id, more)
        if writer:
            writer.close()
            yield pa.record_batch([pa.array([shard], pa.int32()), pa.array([path]), pa.array([writer.total]), pa.array([writer.docs])], names=["shard", "path", "n_tokens", "n_docs"])

    return spark.createDataFrame(ordered.mapInArrow(write, MANIFEST).collect(), MANIFEST)


def read_documents(manifest: DataFrame) -> DataFrame:
    """Per document from the shards' files: doc_id, start, n_tokens, ids_crc32, shard.

    start counts the ids of all documents before it, over all shards; ids_crc32 is the unsigned
    crc32 of its ids as little-endian unsigned 32-bit integers.
    """
    rows = sorted(manifest.collect())  # one a shard
    spark, before, told = manifest.sparkSession, 0, []
    for r in rows:
        told.append((r["shard"], r["path"], before))
        before += r["n_tokens"]
    listed = spark.createDataFrame(told, "shard int, path string, before long")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start", "n_tokens", "ids_crc32", "shard"]
        for batch in batches:
            for shard, path, offset in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                made: list[tuple] = []
                for doc, start, ids in ShardReader(path).documents():
                    made.append((doc, offset + start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), shard))
                    if len(made) == 10_000:
                        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*made, strict=True), (pa.int64(),) * 4 + (pa.int32(),), strict=True)], names=names)
                        made = []
                if made:
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*made, strict=True), (pa.int64(),) * 4 + (pa.int32(),), strict=True)], names=names)

    tasks = max(1, min(len(told), max(spark.sparkContext.defaultParallelism, -(-before // READ_IDS))))
    return listed.repartition(tasks).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long, shard int")


def op1_token_binary(spark, sf_dir: str) -> DataFrame:
    """Contract query: all documents to shards in the shared folder, and per document what the files hold."""
    import public_tokenizers

    manifest = write_tokens(common.documents(spark, sf_dir), common.scratch(spark, "tokens"), public_tokenizers.path("word_bpe_49k.json"))
    return read_documents(manifest)
