"""Secret scans: keyword automaton, anchored patterns at its hits, checksums.

An Aho-Corasick automaton finds the keywords of all kinds in one pass over the
text; a pattern is tried only where its keyword stands. Kinds whose tokens carry
a checksum or an embedded structure are reported only if that holds. Runs of hex
digits have no keyword, so a scan for long runs finds them.

Edge cases: a null text is empty and has no spans; a very long text is read a
fixed number of times, whatever it holds; a token whose header isn't UTF-8 JSON, or
is nested deeper than Python's parser goes, is no token; empty texts, repeated rows
and an empty table need nothing special; a null ``doc_id`` is
returned as null. Only the id and the text are read, so other columns can't clash.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from timbre.llm.common import narrow

SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"

#: Kinds in the order in which spans that start together are listed.
BASE_KINDS = ("assign", "access", "hex")
ADDED_KINDS = ("github", "npm", "jwt", "pem")
KIND_ORDER = {k: i for i, k in enumerate(BASE_KINDS + ADDED_KINDS)}

# Keywords and token formats.
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
GITHUB_WORDS = ("ghp_", "gho_", "ghu_", "ghs_", "ghr_")
GITHUB = re.compile(r"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
NPM = re.compile(r"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
JWT = re.compile(r"(eyJ[A-Za-z0-9_-]+)\.(eyJ[A-Za-z0-9_-]+)\.([A-Za-z0-9_-]{16,})")
TOKEN_RUN = re.compile(r"[A-Za-z0-9_-]*")
PEM = re.compile(r"-----BEGIN ((?:[A-Z]+ )?PRIVATE KEY)-----([A-Za-z0-9+/=\s]+)-----END \1-----")
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

MIN_ASSIGN, MIN_ACCESS = 8, 16


def crc_tail(body: str) -> str:
    """CRC-32 of ``body`` in six base-62 digits."""
    n, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        n, d = divmod(n, 62)
        digits = BASE62[d] + digits
    return digits


def sums_up(m: re.Match) -> bool:
    return crc_tail(m[1]) == m[2]


def names_algorithm(m: re.Match) -> bool:
    """A token whose header decodes to JSON with an ``alg``."""
    try:
        header = json.loads(base64.urlsafe_b64decode(m[1] + "=" * (-len(m[1]) % 4)))
    except (ValueError, binascii.Error, RecursionError):  # the last one: brackets nested too deep
        return False
    return isinstance(header, dict) and isinstance(header.get("alg"), str)


def holds_der(m: re.Match) -> bool:
    """A key whose outer DER sequence is exactly as long as its bytes."""
    try:
        raw = base64.b64decode("".join(m[2].split()), validate=True)
    except (ValueError, binascii.Error):
        return False
    if len(raw) < 2 or raw[0] != 0x30:
        return False
    if raw[1] < 0x80:
        return len(raw) == 2 + raw[1]
    n = raw[1] & 0x7F
    return 0 < n <= 4 and len(raw) == 2 + n + int.from_bytes(raw[2 : 2 + n], "big")


#: kind: pattern and validation of a match.
KINDS = {
    "assign": (ASSIGN, lambda m: len(m[2]) >= MIN_ASSIGN),
    "access": (ACCESS, lambda m: m.end() - m.start() >= MIN_ACCESS),
    "github": (GITHUB, sums_up),
    "npm": (NPM, sums_up),
    "jwt": (JWT, names_algorithm),
    "pem": (PEM, holds_der),
}


@lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    """Lower-case keywords with their kind and length."""
    found = ahocorasick.Automaton()
    words = [(w, "assign") for w in ASSIGN_WORDS] + [(w, "github") for w in GITHUB_WORDS]
    words += [("akia", "access"), ("npm_", "npm"), ("eyj", "jwt"), ("-----begin", "pem")]
    for word, kind in words:
        found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


def spans_of(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of all spans, by start and then kind."""
    low = text.lower()
    if len(low) != len(text):  # only a dotted capital I grows when lowered
        low = text.replace("İ", "i").lower()
    hits = sorted((end + 1 - n, kind) for end, (kind, n) in automaton().iter(low))
    free: dict[str, int] = {}
    found = []
    for at, kind in hits:
        if at < free.get(kind, 0):
            continue
        pattern, valid = KINDS[kind]
        if m := pattern.match(text, at):
            free[kind] = m.end()
            if valid(m):
                found.append((at, m.end(), kind))
        elif kind == "jwt":
            free[kind] = TOKEN_RUN.match(text, at).end()  # a later start in the same run fails where this one has
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    found.sort(key=lambda s: (s[0], KIND_ORDER[s[2]]))
    return found


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        rows = []
        for text in texts:
            spans = spans_of(text.as_py() or "")
            base = [s for s in spans if s[2] in BASE_KINDS]
            kinds = [s[2] for s in base]
            rows.append((*(kinds.count(k) for k in BASE_KINDS), hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)))
        columns = list(zip(*rows)) or [()] * 5
        kinds = [pa.int64()] * 3 + [pa.string()] * 2
        yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, t) for c, t in zip(columns, kinds))], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])


def secret_spans(docs: DataFrame) -> DataFrame:
    """One row per document: counts by base kind, the digest of base spans and all spans."""
    return narrow(docs, doc_id="doc_id", text="text").mapInArrow(scan_batches, SCHEMA)
