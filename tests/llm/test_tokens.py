"""Token ids in bulk, the transducer and the decoder, against the library and against plain merging."""

import json
import random
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from snapforge.llm import bpe, pieces, token_binary

public_tokenizers = pytest.importorskip("public_tokenizers")
WORD_BPE, BYTE_BPE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
RNG = random.Random(3)
TEXTS = [None, "", "  ", "<|endoftext|> a<|startoftext|>b", "\u3000", "é Å. ΣΑΣ. it's IT'S. don't.. 'll 12.. a1. <b> ...", "word " * 500, " ".join(f"w{i}." for i in range(900)), "a" * 9000, "haha" * 3000, "\n\tx\x0b y\x0c z\r"]
TEXTS += ["".join(RNG.choice("abZ '.,!<>|éΣß1 9\u0301\u200d\u3000\n\tx%$") for _ in range(RNG.randint(0, 60))) for _ in range(400)]


def gathered(blocks, n):
    out = [[] for _ in range(n)]
    for first, sizes, flat, _ in blocks:
        for i, ids in enumerate(np.split(flat, np.cumsum(sizes)[:-1])):
            out[first + i] += ids.tolist()
    return out


@pytest.mark.parametrize("make", [token_binary.LibraryEncoder, bpe.Coder])
@pytest.mark.parametrize(("together", "cores"), [(pieces.TOGETHER, pieces.CORES), (40, 250)])
def test_texts_in_blocks_equal_the_library(monkeypatch, make, together, cores):
    """Whatever room a worker has, and however many blocks a text takes."""
    monkeypatch.setattr(pieces, "TOGETHER", together)
    monkeypatch.setattr(token_binary, "JOINED", 7)
    library, made = token_binary.load_tokenizer(WORD_BPE), make(WORD_BPE)
    made.pieces.most = cores
    want = [library.encode(t or "", add_special_tokens=False).ids for t in TEXTS]
    for at in range(0, len(TEXTS), 64):
        some = TEXTS[at : at + 64]
        assert gathered(made.encode(pa.array(some, pa.string())), len(some)) == want[at : at + 64]
    assert max(map(len, (t.encode() for t in TEXTS if t))) > 40


@pytest.mark.parametrize("make", [token_binary.LibraryEncoder, bpe.Coder])
def test_other_splits_go_text_by_text(tmp_path, make):
    """Punctuation belongs to words here, so pieces must not be cut."""
    with open(WORD_BPE, encoding="utf-8") as f:
        told = json.load(f)
    told["pre_tokenizer"]["pretokenizers"][0]["pattern"] = {"Regex": r"\S+"}
    path = str(tmp_path / "other.json")
    with open(path, "w", encoding="utf-8") as f:
        json.dump(told, f)
    made, library = make(path), token_binary.load_tokenizer(path)
    some = [t for t in TEXTS if t is None or len(t) < 1000]
    assert made.pieces is None and gathered(made.encode(pa.array(some, pa.string())), len(some)) == [library.encode(t or "", add_special_tokens=False).ids for t in some]


def toy(letters, rng):
    """A random merge list over a few letters."""
    tokens, pairs = list(letters), []
    for _ in range(rng.randint(2, 14)):
        u, v = rng.choice(tokens), rng.choice(tokens)
        if (u, v) not in pairs and len(u + v) <= 5:
            pairs.append((u, v))
            tokens += [u + v] * (u + v not in tokens)
    longest = max(map(len, tokens))
    return SimpleNamespace(vocab={x: i for i, x in enumerate(tokens)}, names=dict(enumerate(tokens)), suffix="", ranks={p: i for i, p in enumerate(pairs)}, longest=longest, lookahead=bpe.sufficient_lookahead(pairs, longest))


class BoundOnly(bpe.Transducer):
    """Emits by the look-ahead bound alone."""

    def _meeting(self):
        return 0


@pytest.mark.parametrize("kind", [BoundOnly, bpe.Transducer])
def test_transducer_equals_plain_merging(kind):
    rng, early = random.Random(5), 0
    for trial in range(150):
        t = toy("ab" if trial % 2 else "abc", rng)
        machine = kind(t)
        for _ in range(12):
            word = "".join(rng.choice("ab" if trial % 2 else "abc") for _ in range(rng.randint(1, 160)))
            word = (word[: rng.randint(1, 4)] * 160)[:160] if rng.random() < 0.3 else word
            got = []
            for symbol in word:  # one by one
                given = machine.feed(symbol)
                early += len(given)
                got += given
                assert len(machine.path) - 1 + len(machine.held) <= max(t.lookahead, 2 * t.longest) + 3 * t.longest  # constant memory
            assert got + machine.close() == [t.vocab[x] for x in machine.merge(list(word))]
    assert early > 10_000


def test_words_of_all_lengths_go_through_the_transducer(monkeypatch):
    seen = []
    plain = bpe.Transducer.word
    monkeypatch.setattr(bpe.Transducer, "word", lambda self, symbols: seen.append(symbols) or plain(self, symbols))
    long = "ha" * 5000
    assert bpe.Encoder(WORD_BPE).encode(f"the cat {long}") == token_binary.load_tokenizer(WORD_BPE).encode(f"the cat {long}", add_special_tokens=False).ids
    assert seen == ["the", "cat", long]


@pytest.mark.parametrize("path", [WORD_BPE, BYTE_BPE])
def test_decoder_gives_text_as_its_bytes_are_complete(path):
    library, decoder, encoder = token_binary.load_tokenizer(path), bpe.Decoder(path), bpe.Encoder(path)
    for t in ("a 😂 é\u200d", "日本語 text", "x", ""):
        ids = encoder.encode(t)
        assert "".join([*(decoder.feed(i) for i in ids), decoder.close()]) == library.decode(ids, skip_special_tokens=False)
    if path == BYTE_BPE:
        first, *rest = encoder.encode("😂")
        assert rest and decoder.feed(first) == "" and decoder.feed(rest) == "😂" and decoder.close() == ""
        assert decoder.feed(first) == "" and decoder.close() == "\ufffd"


def test_one_id_may_hold_most_rows(spark, tmp_path):
    """Rows of one doc_id, or of none, are spread over shards, and ids stay in ascending order."""
    from snapforge.llm import common

    texts = [f"text number {i} of many" for i in range(400)]
    rows = [(7, t) for t in texts] + [(None, t) for t in texts[:300]] + [(i, "x") for i in range(20)] + [(7, "same")] * 200
    docs = common.stage(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), "hot")
    manifest = token_binary.write_tokens(docs, str(tmp_path / "hot"), WORD_BPE, sequence_length=64, shards=8)
    sizes = [r["n_docs"] for r in manifest.orderBy("shard").collect()]
    assert sum(sizes) == len(rows) and max(sizes) < len(rows) / 3
    told = token_binary.read_documents(manifest).orderBy("start").collect()
    ids = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in told]
    assert ids == sorted(ids) and [r["start"] for r in told] == [sum(x["n_tokens"] for x in told[:i]) for i in range(len(told))]
    library = token_binary.load_tokenizer(WORD_BPE)
    assert sorted(r["n_tokens"] for r in told) == sorted(len(library.encode(t, add_special_tokens=False).ids) + 1 for _, t in rows)


def test_small_shards_leave_few_files(spark, tmp_path):
    """The manifest takes no files, and small shards are read by as many tasks as run at once, not by one each."""
    import glob

    from snapforge import staging

    docs = spark.createDataFrame([(i, f"text {i}") for i in range(400)], "doc_id long, text string")
    before = set(glob.glob(f"{staging.root(spark).removeprefix('file:')}/*/manifest"))
    manifest = token_binary.write_tokens(docs, str(tmp_path / "few"), WORD_BPE, sequence_length=64, shards=40)
    told = token_binary.read_documents(manifest)
    assert manifest.count() > spark.sparkContext.defaultParallelism >= told.rdd.getNumPartitions()
    assert sorted(r["doc_id"] for r in told.collect()) == list(range(400))
    assert set(glob.glob(f"{staging.root(spark).removeprefix('file:')}/*/manifest")) == before


def test_a_long_document_goes_on_over_blocks_in_a_shard(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(pieces, "TOGETHER", 64)
    writer = token_binary.ShardWriter(str(tmp_path / "long"), np.dtype("<u2"), 8)
    texts = ["a b c", "word " * 100, "", "x " * 90, "end"]
    made, library = token_binary.LibraryEncoder(WORD_BPE), token_binary.load_tokenizer(WORD_BPE)
    for first, sizes, flat, more in made.encode(pa.array(texts)):
        writer.add(pa.array(range(5)).slice(first, len(sizes)), sizes, flat, 2, more)
    writer.close()
    want = [[*library.encode(t, add_special_tokens=False).ids, 2] for t in texts]
    got = [(i, start, ids.tolist()) for i, start, ids in token_binary.ShardReader(str(tmp_path / "long")).documents()]
    assert got == [(i, sum(map(len, want[:i])), w) for i, w in enumerate(want)] and (writer.docs, writer.total) == (5, sum(map(len, want)))
