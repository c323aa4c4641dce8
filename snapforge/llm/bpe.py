"""BPE encoding as a bounded-lookahead streaming transducer, and decoding as an incremental byte-to-text state machine.

Encoding. A word's symbols arrive one by one. For each prefix the transducer knows the last token of the prefix's encoding: the
one token that ends there and fits after the last token of what stands before it. So every prefix's encoding is a path
in a tree whose edges are tokens, and a later symbol can only hang a token onto one of the last positions, as far back as
the longest token reaches. Once the paths of those positions meet, the tokens up to the meeting point are stable and
leave. ``sufficient_lookahead`` computes from the merge list how many further symbols decide a token at the latest: what lies
that far back leaves even if no paths have met, so a transducer never holds more than lookahead + 2 * longest symbols.

All words go through the transducer; a worker remembers the ids of a bounded number of cores of words (see pieces), and texts
go in blocks of bounded size, so memory doesn't grow with a text.

Decoding. Ids arrive in blocks and text leaves as soon as its bytes are complete. For byte-level tokenizers a
UTF-8 state machine holds at most three bytes back; malformed bytes become U+FFFD. Where the tokenizer
file names no decoder, tokens are joined by a space, as the library does.

Nulls: a null text is empty: no ids, empty decoded text. Any text is handled whole, however long.
Equal texts get equal rows; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from . import common
from .pieces import CORES, Pieces, blocks, by_piece, lowers

#: Pairs of tokens whose fit a transducer remembers.
FITS = 400_000
#: Below this code point all Unicode versions in use agree on case, letters, digits and white space.
AGREED = 0x530


@lru_cache(maxsize=1)
def byte_symbols() -> list[str]:
    """The printable stand-in of each byte: itself where printable in Latin-1, else the next code point from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


class Tables:
    """A tokenizer file's vocabulary, merges and rules."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        model = told["model"]
        self.path, self.vocab, self.suffix = path, model["vocab"], model.get("end_of_word_suffix") or ""
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.ranks = {pair: i for i, pair in enumerate(pairs)}
        self.added = {t["content"]: t["id"] for t in told.get("added_tokens", [])}
        self.names = {i: t for t, i in (self.vocab | self.added).items()}
        self.added_split = regex.compile("|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True)) or r"(?!)")
        steps = told.get("normalizer") or {}
        self.normal = [s for s in steps.get("normalizers", [steps]) if s]
        self.steps = [(x["type"], regex.compile(x["pattern"]["Regex"]) if x["type"] == "Replace" else None, x.get("content")) for x in self.normal]
        if unknown := {x[0] for x in self.steps} - {"NFC", "Lowercase", "Replace"}:
            raise ValueError(f"normalisation steps not supported: {sorted(unknown)}")
        pre = told.get("pre_tokenizer") or {}
        parts = pre.get("pretokenizers", [pre])
        own = [s["pattern"]["Regex"] for s in parts if s.get("type") == "Split"]
        byte_level = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        self.words = regex.compile(own[0] if own else byte_level)
        self.drops_space = bool(own)
        self.decoder = (told.get("decoder") or {}).get("type")
        self.longest = max((len(t.removesuffix(self.suffix) if self.suffix else t) for t in self.vocab), default=1)
        self.lookahead = sufficient_lookahead(pairs, self.longest)


def sufficient_lookahead(pairs: list[tuple[str, str]], longest: int) -> int:
    """Symbols that decide any boundary: the longest chain of merges in which each can take the next one's right part, times the longest token.

    A merge (u, v) can be undone only by an earlier merge that takes v, or the last piece of v, as its left part; that
    one in turn by a still earlier one. The chain is found in one pass in order of priority.
    """
    right: dict[str, str] = {}
    chain: dict[str, int] = {}
    most = 1
    for u, v in pairs:
        piece, n = v, 0
        while piece is not None:
            n, piece = max(n, chain.get(piece, 0)), right.get(piece)
        chain[u] = max(chain.get(u, 0), n + 1)
        right.setdefault(u + v, v)
        most = max(most, n + 1)
    return (most + 1) * longest


class Transducer:
    """One word's symbols to its ids: feed() gives the tokens that have become stable, close() the rest.

    Symbols are single characters. The last one of a word is marked by the tokenizer's suffix, which only close() can know, so
    up to a longest token's worth is held back. A symbol outside the vocabulary has no id and parts what stands around it.
    """

    def __init__(self, t: Tables):
        import ahocorasick

        self.t, self.fits = t, {}
        self.tokens = ahocorasick.Automaton()  # of tokens inside a word, and the same with the suffix's mark for its end
        self.last_of: dict[str, tuple[int, int]] = {}
        for token, i in t.vocab.items():
            body = token.removesuffix(t.suffix) if t.suffix else token
            if body and (body == token or t.suffix):
                self.tokens.add_word(body if body == token else body[:-1] + self._closing(body[-1]), (i, len(body)))
        self.tokens.make_automaton()
        self.names = t.names
        self.forget()

    @staticmethod
    def _closing(symbol: str) -> str:
        return chr(0xF0000 + ord(symbol))

    def forget(self) -> None:
        """Start the next word."""
        self.given = -1  # the last token given; -1: none, or a symbol outside the vocabulary
        self.path: list[tuple[int, int]] = [(-1, 0)]  # (last token, its length) of each prefix since then
        self.recent = self.held = ""  # symbols searched last; symbols not yet searched

    def merge(self, symbols: list[str]) -> list[str]:
        """The merge rules over a short list of symbols, best rank first, leftmost on ties."""
        rank, never = self.t.ranks.get, 1 << 60
        ranks = [rank(p, never) for p in zip(symbols, symbols[1:])]
        while ranks and (best := min(ranks)) != never:
            i = ranks.index(best)
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank((symbols[i - 1], symbols[i]), never)
            if i < len(ranks):
                ranks[i] = rank((symbols[i], symbols[i + 1]), never)
        return symbols

    def _split(self, token: str) -> list[str]:
        body = token.removesuffix(self.t.suffix) if self.t.suffix else token
        cut = list(body)
        if body != token:
            cut[-1] += self.t.suffix
        return cut

    def _fit(self, left: int, token: int) -> bool:
        """Whether token can stand after left: the two together encode to just these two."""
        names = [self.names[i] for i in (left, token) if i >= 0]
        if len(self.fits) >= FITS:
            self.fits.clear()
        made = self.fits[left << 24 | token] = self.merge([c for n in names for c in self._split(n)]) == names
        return made

    def _step(self, symbols: str) -> None:
        """The last token of each prefix that these further symbols make; of the tokens that end at a place the longest come first."""
        path, fit, base = self.path, self.fits.get, len(self.path)
        before = self.recent[-min(base - 1, self.t.longest) :] if base > 1 else ""
        shift = base - len(before)  # from a place in what is searched to the prefix that ends there
        for at, (token, size) in self.tokens.iter(before + symbols):
            end = at + shift
            if end < len(path):
                continue
            while len(path) < end:  # no token ends at these symbols
                path.append((-1, 1))
            start = end - size
            if start < 0:
                continue
            left = path[start][0] if start else self.given
            if ok if (ok := fit(left << 24 | token)) is not None else self._fit(left, token):
                path.append((token, size))
        path.extend([(-1, 1)] * (base + len(symbols) - len(path)))
        self.recent = (before + symbols)[-self.t.longest :]

    def _leave(self, meet: int) -> list[int]:
        """The ids of the path up to meet, which go."""
        out, at = [], meet
        while at:
            out.append(self.path[at][0])
            at -= self.path[at][1]
        self.given = self.path[meet][0]
        self.path = [(-1, 0), *self.path[meet + 1 :]]
        return [i for i in reversed(out) if i >= 0]

    def _meeting(self) -> int:
        """The last place through which the path of every prefix that a later token may follow goes."""
        end, longest = len(self.path) - 1, self.t.longest
        live = set(range(max(0, end - longest + 1), end + 1))
        while len(live) > 1:
            top = max(live)
            live.remove(top)
            live.add(top - self.path[top][1])
        return live.pop()

    def _stable(self) -> int:
        """The place up to which tokens may leave: where paths meet, or what the merge list's own bound decides."""
        end, longest, lookahead = len(self.path) - 1, self.t.longest, self.t.lookahead
        meet = self._meeting() if end >= 2 * longest else 0
        if not meet and end > lookahead:
            meet = end
            while meet > end - lookahead:
                meet -= self.path[meet][1]
        return meet

    def feed(self, symbols: str) -> list[int]:
        out, longest = [], self.t.longest
        self.held += symbols
        while len(self.held) > longest:
            self._step(self.held[:longest])
            self.held = self.held[longest:]
            if meet := self._stable():
                out += self._leave(meet)
        return out

    def close(self) -> list[int]:
        if self.held:
            self._step(self.held[:-1] + self._closing(self.held[-1]) if self.t.suffix else self.held)
        out = self._leave(len(self.path) - 1)
        self.forget()
        return out

    def word(self, symbols: str) -> list[int]:
        return [*self.feed(symbols), *self.close()]


class Encoder:
    """Texts to ids by way of their words, all of which go through the transducer."""

    def __init__(self, path: str):
        self.t = tables(path)
        self.transducer = Transducer(self.t)
        self.symbols = dict(enumerate(byte_symbols()))
        self.library = None

    def words(self, plain: str) -> Iterator[str]:
        """Byte-symbol words of text without added tokens."""
        if self.t.normal and max(map(ord, plain), default=0) >= AGREED:  # case and letters as the library's own Unicode tables have them
            from .token_binary import load_tokenizer

            self.library = self.library or load_tokenizer(self.t.path)
            yield from (w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(plain)))
            return
        for kind, pattern, content in self.t.steps:
            if kind == "NFC":
                plain = unicodedata.normalize("NFC", plain)
            elif kind == "Lowercase":  # letter by letter: a final sigma stays like any other
                plain = plain.lower() if "\u03a3" not in plain else "".join(c.lower() for c in plain)
            else:
                plain = pattern.sub(content, plain)
        for found in self.t.words.finditer(plain):
            w = found.group()
            yield w if w.isascii() and w.isprintable() and " " not in w else w.encode().decode("latin-1").translate(self.symbols)

    def stream(self, text: str) -> Iterator[int]:
        """Ids of a text or a piece of one, word by word."""
        at = 0
        for found in self.t.added_split.finditer(text) if self.t.added else ():
            for w in self.words(text[at : found.start()]):
                yield from self.transducer.word(w)
            yield self.t.added[found.group()]
            at = found.end()
        for w in self.words(text[at:] if at else text):
            yield from self.transducer.word(w)

    def encode(self, text: str) -> list[int]:
        return list(self.stream(text))


class Decoder:
    """Ids to text, block by block: feed() gives what is complete, close() the rest."""

    def __init__(self, path: str):
        self.t = tables(path)
        byte_of = {s: i for i, s in enumerate(byte_symbols())}
        raw = [b""] * (max(self.t.names, default=-1) + 2)  # one more for ids that have no token
        for i, name in self.t.names.items():
            raw[i] = b" " + name.encode() if self.t.decoder is None else bytes(map(byte_of.get, name)) if all(c in byte_of for c in name) else name.encode()
        self.raw = pa.array(raw, pa.binary())
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")
        self.started = self.t.decoder is not None

    def bytes_of(self, ids: np.ndarray) -> tuple[np.ndarray, memoryview]:
        """(offsets, bytes) of the ids' tokens."""
        made = self.raw.take(pa.array(np.minimum(ids.astype(np.int64), len(self.raw) - 1)))
        _, offsets, data = made.buffers()
        return np.frombuffer(offsets, np.int32, len(made) + 1), memoryview(data) if data else memoryview(b"")

    def feed_bytes(self, raw: memoryview | bytes) -> str:
        """The next tokens' bytes; where tokens are joined by spaces, each brings one, and a text's first goes."""
        if len(raw) and not self.started:
            raw, self.started = raw[1:], True
        return self.machine.decode(raw)

    def feed(self, ids: Iterable[int] | int) -> str:
        offsets, data = self.bytes_of(np.atleast_1d(np.asarray(ids, np.int64)))
        return self.feed_bytes(data[offsets[0] : offsets[-1]])

    def close(self) -> str:
        rest = self.machine.decode(b"", True)
        self.machine.reset()
        self.started = self.t.decoder is not None
        return rest

    def decode(self, ids: Iterable[int]) -> str:
        return self.feed(list(ids)) + self.close()


@lru_cache(maxsize=4)
def tables(path: str) -> Tables:
    return Tables(path)


class Coder:
    """Blocks of texts to ids, and ids to text, as a worker does it."""

    def __init__(self, path: str):
        self.encoder, self.decoder = Encoder(path), Decoder(path)
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        self.pieces = Pieces(self._encode, np.dtype(np.int32), lowers(told), CORES) if by_piece(told) else None
        #: Decimal ids, each after a space.
        self.decimal = pa.array([b" %d" % i for i in range(len(self.decoder.raw))], pa.binary())

    def _encode(self, cores: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        each = [self.encoder.encode(c.decode("utf-8", "replace")) for c in cores]
        return np.fromiter(map(len, each), np.int64, len(each)), np.fromiter((i for e in each for i in e), np.int32)

    def encode(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, bool]]:
        """Blocks of (first row, ids of each row, all ids, whether the last row goes on in the next block)."""
        if self.pieces:
            for first, some, more in blocks(texts):
                yield first, *self.pieces.ids(some), more
            return
        for at, text in enumerate(pc.fill_null(texts, "").to_pylist()):
            ids = np.fromiter(self.encoder.stream(text), np.int32)
            yield at, np.array([len(ids)]), ids, False

    def digests(self, texts: pa.Array) -> Iterator[tuple[int, str, str]]:
        """n_tokens, sha256 of the decimal ids joined by a space, sha256 of the decoded text, of each text."""
        decoder, n, ids_sha, text_sha = self.decoder, 0, hashlib.sha256(), hashlib.sha256()
        for _, sizes, flat, more in self.encode(texts):
            ends = np.cumsum(sizes).tolist()
            told = self.decimal.take(pa.array(flat))
            numbers, digits = np.frombuffer(told.buffers()[1], np.int32, len(told) + 1).tolist() if len(flat) else [0], memoryview(told.buffers()[2] or b"")
            offsets, data = decoder.bytes_of(flat)
            offsets = offsets.tolist()
            for i, (start, end) in enumerate(zip([0, *ends], ends)):
                if end > start:
                    ids_sha.update(digits[numbers[start] + (n == 0) : numbers[end]])
                    text_sha.update(decoder.feed_bytes(data[offsets[start] : offsets[end]]).encode())
                    n += end - start
                if more and i == len(ends) - 1:
                    continue
                text_sha.update(decoder.close().encode())
                yield n, ids_sha.hexdigest(), text_sha.hexdigest()
                n, ids_sha, text_sha = 0, hashlib.sha256(), hashlib.sha256()

    def outputs(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, str]]:
        """The ids and the decoded text of each text."""
        held, text = [], []
        for _, sizes, flat, more in self.encode(texts):
            for i, ids in enumerate(np.split(flat, np.cumsum(sizes)[:-1])):
                held.append(ids)
                text.append(self.decoder.feed(ids))
                if not (more and i == len(sizes) - 1):
                    yield np.concatenate(held), "".join([*text, self.decoder.close()])
                    held, text = [], []


def worker_coder(path: str) -> Coder:
    """One coder a Python worker, so that what it remembers outlives a task."""
    return common.held_by_worker(("coder", path), lambda: Coder(path))


def encode_table(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id, n_tokens, ids (array of int), decoded: the real outputs for every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = worker_coder(tokenizer_path)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                rows = batch.slice(at, 1024)
                each, decoded = zip(*coder.outputs(rows.column(1)), strict=True)
                ends = np.cumsum([0, *map(len, each)])
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(each)))
                yield pa.record_batch([rows.column(0), pa.array(np.diff(ends)), ids, pa.array(decoded, pa.string())], names=["doc_id", "n_tokens", "ids", "decoded"])

    return common.id_text(docs).mapInArrow(run, "doc_id long, n_tokens long, ids array<int>, decoded string")


def digest_table(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for every document; a map without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = worker_coder(tokenizer_path)
        for batch in batches:
            if batch.num_rows:
                n, a, b = zip(*coder.digests(batch.column(1)), strict=True)
                yield pa.record_batch([batch.column(0), pa.array(n, pa.int64()), pa.array(a), pa.array(b)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return common.id_text(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op3_bpe(spark, sf_dir: str) -> DataFrame:
    """Contract query: every document encoded and decoded with the public word-level vocabulary."""
    import public_tokenizers

    return digest_table(common.documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
