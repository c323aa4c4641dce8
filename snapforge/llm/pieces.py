"""Token ids of texts in bulk, by the pieces between ASCII white space.

Arrow splits a block of texts and numbers its distinct pieces. Their cores (pieces without ASCII case and closing punctuation, where
those play no part) are looked up among what the worker remembers; only unknown ones are encoded, many at a time, by the
caller's function. Everything else is gathers over arrays, so no Python runs for each piece of a text.

This holds only for tokenizers whose words can't reach across white space and whose punctuation after a letter is a word of its
own. That is known of one splitting expression, SPLIT; ``by_piece`` says whether a tokenizer file has it. For others,
callers encode whole texts.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: A fixed value: the splitting expression for which the above holds.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Bytes of text in one block; a longer text goes in several.
TOGETHER = 8 << 20
#: Cores that a worker remembers, and their bytes.
CORES, CORE_BYTES = 700_000, 64 << 20
#: ASCII punctuation that closes a piece.
CLOSING = ".,;:!?*%$&#|"
WHITE = re.compile(rb"[\x09-\x0d\x20]")


def by_piece(told: dict) -> bool:
    """Whether the tokenizer file's words lie within pieces, and its added tokens in pieces with a bracket."""
    steps = told.get("normalizer") or {}
    plain = all(s["type"] in ("NFC", "Lowercase") or (s["type"], s.get("pattern"), s.get("content")) == ("Replace", {"Regex": r"\s+"}, " ") for s in steps.get("normalizers", [steps]) if s)
    pre = told.get("pre_tokenizer") or {}
    first, *rest = pre.get("pretokenizers", [pre])
    split = first.get("type") == "Split" and first.get("pattern") == {"Regex": SPLIT} and first.get("behavior") == "Removed" and first.get("invert")
    bytes_only = all(r.get("type") == "ByteLevel" and not r.get("use_regex") and not r.get("add_prefix_space") for r in rest)
    added = all(re.fullmatch(r"<\S+>", t["content"]) and not (t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"]) for t in told.get("added_tokens", []))
    return bool(plain and split and bytes_only and added)


def lowers(told: dict) -> bool:
    steps = told.get("normalizer") or {}
    return any(s.get("type") == "Lowercase" for s in steps.get("normalizers", [steps]))


def taken(offsets: np.ndarray, flat: np.ndarray, which: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, values) of the lists that which names."""
    out = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat)).take(which)
    return out.offsets.to_numpy(), out.flatten().to_numpy()


def blocks(texts: pa.Array) -> Iterator[tuple[int, pa.Array, bool]]:
    """(first row, some texts, whether the last of them goes on in the next block), nulls as empty; a block holds TOGETHER bytes or less, or one piece."""
    texts = pc.fill_null(texts, "")
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(texts):
        before = int(ends[at - 1]) if at else 0
        to = int(np.searchsorted(ends, before + TOGETHER, "right"))
        if to > at:
            yield at, texts.slice(at, to - at), False
            at = to
            continue
        raw, start = memoryview(texts.slice(at, 1).cast(pa.binary())[0].as_buffer()), 0
        while start < len(raw):
            found = WHITE.search(raw, min(start + TOGETHER, len(raw)))
            end = found.start() if found else len(raw)
            yield at, pa.array([bytes(raw[start:end])], pa.binary()).cast(pa.string()), end < len(raw)
            start = end
        at += 1


class Pieces:
    """Texts to ids; encode gives, for distinct cores, how many ids each has and all of them in order."""

    def __init__(self, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], width: np.dtype, fold: bool, most: int = CORES):
        self.encode, self.width, self.fold, self.most = encode, width, fold, most
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.held = 0
        self.offsets, self.flat = np.zeros(1 << 16, np.int32), np.empty(1 << 16, self.width)

    def _learn(self, cores: list[bytes]) -> None:
        n, sizes, ids = len(self.known), *self.encode(cores)
        held = int(self.offsets[n])
        while n + len(cores) >= len(self.offsets):
            self.offsets = np.concatenate([self.offsets, np.zeros(len(self.offsets), np.int32)])
        while held + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty(len(self.flat), self.width)])
        self.offsets[n + 1 : n + 1 + len(cores)] = held + np.cumsum(sizes)
        self.flat[held : held + len(ids)] = ids
        self.known.update(zip(cores, range(n, n + len(cores)), strict=True))
        self.held += sum(map(len, cores))

    def _places(self, cores: list[bytes]) -> np.ndarray:
        """Where the ids of distinct cores stand; when there is no room, what isn't among them goes."""
        found = lambda: np.fromiter(map(self.known.get, cores, repeat(-1)), np.int64, len(cores))
        at = found()
        if not (new := np.flatnonzero(at < 0)).size:
            return at
        if len(self.known) + len(new) > self.most or self.held > CORE_BYTES:
            self._forget()
            self._learn(cores)
        else:
            self._learn([cores[i] for i in new.tolist()])
        return found()

    def _parts(self, pieces: pa.Array) -> tuple[pa.Array, pa.Array]:
        """The core and the tail of each piece; an apostrophe may start a word with letters, a bracket may belong to an added token."""
        bare = pc.ascii_rtrim(pieces, characters=CLOSING)
        plain = pc.invert(pc.match_substring_regex(pieces, "[<>]"))
        cut = pc.and_(plain, pc.match_substring_regex(bare, "[A-Za-z]$"))
        core = pc.if_else(cut, bare, pieces)
        if self.fold:
            core = pc.if_else(pc.and_(plain, pc.string_is_ascii(core)), pc.ascii_lower(core), core)
        closed = pc.and_(cut, pc.less(pc.binary_length(bare), pc.binary_length(pieces)))
        tails = pc.struct_field(pc.extract_regex(pieces.filter(closed), f"(?P<tail>[{re.escape(CLOSING)}]+)$"), "tail")
        tail = pc.replace_with_mask(pa.array(np.full(len(pieces), ""), pa.string()), closed, tails)
        return core, tail

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of each text, all ids) of a block."""
        words = pc.ascii_split_whitespace(texts)
        told = words.flatten().dictionary_encode()
        if not len(told):
            return np.zeros(len(texts), np.int64), np.empty(0, self.width)
        core, tail = (p.dictionary_encode() for p in self._parts(told.dictionary))
        distinct = pa.concat_arrays([core.dictionary, tail.dictionary]).dictionary_encode()
        places = self._places(distinct.dictionary.cast(pa.binary()).to_pylist())[distinct.indices.to_numpy()]
        n = len(core.dictionary)
        units = np.stack([places[:n][core.indices.to_numpy()], places[n:][tail.indices.to_numpy()]], axis=1).ravel()
        offsets, flat = taken(self.offsets[: len(self.known) + 1], self.flat[: self.offsets[len(self.known)]], pa.array(units))
        offsets, flat = taken(offsets[::2], flat, told.indices)
        ends = words.offsets.to_numpy()
        return np.diff(offsets[ends - ends[0]].astype(np.int64)), flat
