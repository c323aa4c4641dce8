"""Secret scans: a keyword automaton first, anchored expressions only at its hits, then embedded checksums.

One Aho-Corasick pass over the lower-cased text gives the places of all keywords; a rule's expression is tried only there, from
the keyword on (or from ``back`` characters before it). Runs of 16 and more hexadecimal digits hold no keyword, so
their one expression goes over the whole text. Token formats that carry a checksum count only when it agrees.

A span is (kind, start, end): code points, end exclusive. Spans of one kind never overlap, the leftmost wins, and a match that
fails its kind's check is dropped without another try inside it. Only A-Z have a lower case here. No rule is tried more than once
in a run that it goes over, so a scan takes time in proportion to the text.

Nulls: a null text is empty and has no spans. Texts are scanned whole, however long. Repeated rows are all returned;
an empty table gives no rows; other columns are ignored, and kept by ``redact_documents``.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import string
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

BASE62 = string.digits + string.ascii_uppercase + string.ascii_lowercase
MARK = "[SECRET]"
#: The contract's kinds, in its order.
BASE_KINDS = ("assign", "access", "hex")
HEX_RUN = re.compile(r"[0-9a-f]{16,}")
ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def base62_crc(token: str) -> bool:
    """prefix_ + 30 characters + 6 of base 62: the crc32 of the 30."""
    body, check = token.rpartition("_")[2][:-6], token[-6:]
    n = zlib.crc32(body.encode())
    want = ""
    for _ in range(6):
        n, digit = divmod(n, 62)
        want = BASE62[digit] + want
    return want == check


def json_head(token: str) -> bool:
    """A web token's first part is base64 of a JSON object that names an algorithm."""
    head = token.partition(".")[0]
    try:
        return "alg" in json.loads(base64.urlsafe_b64decode(head + "=" * (-len(head) % 4)))
    except ValueError:
        return False


def long_value(found: re.Match) -> bool:
    return len(found[2]) >= 12


def whole(check: Callable[[str], bool]) -> Callable[[re.Match], bool]:
    return lambda found: check(found[0])


#: (kind, keywords in lower case, expression from the keyword on, check of a match)
RULES: list[tuple[str, tuple[str, ...], str, Callable[[re.Match], bool]]] = [
    ("assign", ("password", "passwd", "secret", "token", "apikey", "api_key"), r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", long_value),
    ("access", ("akia",), r"AKIA[A-Z0-9]+", whole(lambda t: len(t) >= 18)),
    ("hex", (), "", whole(bool)),
    ("github", ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), r"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])", whole(base62_crc)),
    ("npm", ("npm_",), r"npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])", whole(base62_crc)),
    ("jwt", ("eyj",), r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{16,}", whole(json_head)),
    ("pem", ("-----begin",), r"-----BEGIN (?:[A-Z0-9]+ ){0,3}PRIVATE KEY-----[A-Za-z0-9+/=\s]{32,}-----END (?:[A-Z0-9]+ ){0,3}PRIVATE KEY-----", whole(bool)),
    ("slack", ("xoxb-", "xoxp-", "xoxa-", "xoxr-", "xoxs-"), r"xox[abprs]-[0-9]{8,}-[A-Za-z0-9-]{12,}", whole(bool)),
    ("stripe", ("sk_live_", "rk_live_"), r"[sr]k_live_[A-Za-z0-9]{20,}", whole(bool)),
    ("google", ("aiza",), r"AIza[A-Za-z0-9_-]{35}(?![A-Za-z0-9_-])", whole(bool)),
    ("gitlab", ("glpat-",), r"glpat-[A-Za-z0-9_-]{20}(?![A-Za-z0-9_-])", whole(bool)),
]
KINDS = tuple(r[0] for r in RULES)
#: A web token's parts. Where an attempt at one place of a part has failed, so does any at a later place of it.
PART = re.compile(r"[A-Za-z0-9_-]+")


@lru_cache(maxsize=1)
def compiled():
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for k, (_, keywords, _, _) in enumerate(RULES):
        for word in keywords:
            automaton.add_word(word, (k, len(word)))
    automaton.make_automaton()
    return automaton, [re.compile(r[2], re.ASCII) for r in RULES]  # of letters, only A-Z have another case


def spans(text: str | None) -> list[tuple[str, int, int]]:
    """All spans of a whole text, by start, then kind in the order of RULES."""
    if not text:
        return []
    automaton, expressions = compiled()
    low = text.lower()
    if len(low) != len(text):  # some letters grow when lower-cased; places must stay
        low = text.translate(ASCII_LOWER)
    found, free = [], [0] * len(RULES)
    tried = sorted((end + 1 - length, k) for end, (k, length) in automaton.iter(low))
    jwt = KINDS.index("jwt")
    for at, k in tried:
        if at < free[k] or k == jwt and not text.startswith("eyJ", at):
            continue
        if m := expressions[k].match(text, at):
            free[k] = m.end()
            if RULES[k][3](m):
                found.append((m.start(), k, m.end()))
        elif k == jwt:
            free[k] = PART.match(text, at).end()
    hexes = KINDS.index("hex")
    found += [(m.start(), hexes, m.end()) for m in HEX_RUN.finditer(text)]
    return [(KINDS[k], s, e) for s, k, e in sorted(found)]


def told(found: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in found)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans for every row; a map without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            each = [spans(t) for t in batch.column(1).to_pylist()]
            counts = [pa.array([sum(k == kind for k, _, _ in f) for f in each], pa.int64()) for kind in BASE_KINDS]
            base = [hashlib.sha256(told([s for s in f if s[0] in BASE_KINDS]).encode()).hexdigest() for f in each]
            yield pa.record_batch([batch.column(0), *counts, pa.array(base, pa.string()), pa.array(map(told, each), pa.string())], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return common.id_text(docs).mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redact(text: str | None, mark: str = MARK) -> str | None:
    """text with each run of overlapping spans replaced by mark."""
    out, at, open_until = [], 0, 0
    for _, s, e in spans(text):
        if s >= open_until:
            out += [text[at:s], mark]
        at = open_until = max(open_until, e)
    return "".join([*out, text[at:]]) if out else text


def redact_documents(docs: DataFrame) -> DataFrame:
    """docs with redacted texts, and n_chars, where there is one, of those; a null text stays null."""

    @F.pandas_udf("string")
    def cleaned(texts: pd.Series) -> pd.Series:
        return texts.map(redact, na_action="ignore")

    done = docs.withColumn(common.TEXT, cleaned(common.TEXT))
    return done.withColumn("n_chars", F.char_length(common.TEXT).cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else done


def op7_secrets(spark, sf_dir: str) -> DataFrame:
    """Contract query: all documents."""
    return scan(common.documents(spark, sf_dir))
