"""Personal data by anchor expansion: an automaton finds anchors, small parsers expand and validate what stands at them.

One Aho-Corasick pass finds at-signs, schemes, digits, dots and plus signs before
digits, and the cue words of identifiers. What a hit means is settled near it: e-mail
addresses, network addresses and schemes are expanded to the left over the
characters that they may have, then an anchored pattern reads on to the right, and
the kind's check (part values, Luhn, digit counts, IBAN remainder, number areas)
decides. A kind's spans don't overlap: hits inside the last match of their kind are
passed over, so a text is read once, whatever it holds.

Kinds of the contract: email, ip, card, phone. Added: login (a URL with user
information), tel (a ``tel:`` number), iban, account and ssn (behind their cue),
street (house number, names and a street word, with town and code if they follow).

Edge cases: a null text is empty and has no spans; texts may be empty or of any
length; repeated rows give repeated results; an empty table gives none; a null
``doc_id`` is returned as null. Only the id and the text are read, so other
columns can't clash.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache, partial

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timbre.llm.common import narrow

#: Kinds in the order in which spans that start together are listed.
BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("login", "tel", "iban", "account", "ssn", "street")
KINDS = BASE_KINDS + ADDED_KINDS

# Formats, cue words, IBAN lengths by country.
BASE_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
IBAN_LENGTHS = {
    "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24, "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28,
    "IE": 22, "IT": 27, "LT": 20, "LU": 20, "LV": 21, "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SE": 24, "SI": 19, "SK": 24,
}
ACCOUNT_CUES = ("account", "acct", "konto", "compte", "cuenta")
SSN_CUES = ("ssn", "social security")
STREET_WORDS = ("Street", "Avenue", "Road", "Boulevard", "Lane", "Drive", "Court", "Square", "Place", "Terrace")

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
NAME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz'.-")
DIGITS = frozenset("0123456789")


def either_case(word: str) -> str:
    """A pattern of an ASCII word in either case, without the letters beyond ASCII that a case flag lets in."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


def cues(words: tuple[str, ...]) -> str:
    return r"\b(?:" + "|".join(map(either_case, words)) + r")(?: (?:no|nr|number)\.?)?[ :#=]{1,3}"


#: Patterns of the added kinds; the span is the first group, or the match if there is none.
ADDED_PATTERNS = {
    "login": r"[A-Za-z][A-Za-z0-9+.-]*://[A-Za-z0-9._~%!$&*+,;=-]+(?::[A-Za-z0-9._~%!$&*+,;=:-]*)?@[A-Za-z0-9.-]+",
    "tel": r"\b[Tt][Ee][Ll]:(\+?[0-9](?:[().-]?[0-9])+)",
    "iban": cues(("iban",)) + "(" + "|".join(rf"{c}[0-9]{{2}}(?: ?[A-Z0-9]){{{n - 4}}}" for c, n in IBAN_LENGTHS.items()) + r")\b",
    "account": cues(ACCOUNT_CUES) + r"([0-9](?:-?[0-9])+)\b",
    "ssn": cues(SSN_CUES) + r"([0-9]{3}-[0-9]{2}-[0-9]{4})\b",
    "street": r"\b[0-9]{1,5}[A-Za-z]? (?:[A-Z][A-Za-z'.-]* ){1,4}?(?:" + "|".join(STREET_WORDS) + r")\b(?:, [A-Z][A-Za-z'.-]*(?: [A-Z][A-Za-z'.-]*){0,2})?(?:,? [A-Z]{2} [0-9]{5}(?:-[0-9]{4})?\b)?",
}
PATTERNS = {k: re.compile(p, re.A) for k, p in (BASE_PATTERNS | ADDED_PATTERNS).items()}


def digits_of(text: str) -> str:
    return "".join(c for c in text if c in DIGITS)


def small_parts(text: str) -> bool:
    """Whether all parts of a dotted address are at most 255."""
    return all(len(p) <= 3 and int(p or "0") <= 255 for p in (x.lstrip("0") for x in text.split(".")))


def luhn(text: str) -> bool:
    """12 to 19 digits whose last one is their check digit."""
    n = digits_of(text)
    if not 12 <= len(n) <= 19:
        return False
    twice = (2 * int(c) for c in n[-2::-2])
    return (sum(map(int, n[-1::-2])) + sum(x - 9 if x > 9 else x for x in twice)) % 10 == 0


def iban_holds(text: str) -> bool:
    """The number formed by the moved and spelt out characters leaves 1 by 97."""
    plain = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def ssn_holds(text: str) -> bool:
    area, group, serial = text.split("-")
    return area not in ("000", "666") and area[0] != "9" and group != "00" and serial != "0000"


CHECKS: dict[str, Callable[[str], bool]] = {
    "ip": small_parts,
    "card": luhn,
    "phone": lambda t: 9 <= len(digits_of(t)) <= 15,
    "tel": lambda t: 7 <= len(digits_of(t)) <= 15,
    "iban": iban_holds,
    "account": lambda t: 6 <= len(digits_of(t)) <= 17,
    "ssn": ssn_holds,
}


def leftmost(text: str, at: int, least: int, allowed: frozenset) -> int:
    """Start of the run of allowed characters that ends before ``at``, not before ``least``."""
    while at > least and text[at - 1] in allowed:
        at -= 1
    return at


def house_number(text: str, at: int, least: int) -> int:
    """Place of the house number of a street word at ``at``: one to four names before it, -1 if there is none."""
    for _ in range(5):
        if at <= least or text[at - 1] != " ":
            return -1
        end = at - 1
        at = leftmost(text, end, least, NAME)
        if at == end or text[at - 1 : at].isascii() and text[at - 1 : at].isdigit():
            break  # digits, or a letter behind them
        if not "A" <= text[at] <= "Z":
            return -1
    start = leftmost(text, end - 1 if end > at else end, least, DIGITS)
    return start if 0 < end - start <= 6 else -1


def start_of(kind: str, text: str, at: int, least: int) -> int:
    """Where a match of ``kind`` with its anchor at ``at`` would begin, -1 if nowhere from ``least`` on."""
    if kind == "email":
        return leftmost(text, at, least, LOCAL)
    if kind == "ip":
        return leftmost(text, at, least, DIGITS)
    if kind == "login":
        start = leftmost(text, at, least, SCHEME)
        while start < at and not text[start].isalpha():
            start += 1
        return start
    if kind == "street":
        return house_number(text, at, least)
    return at


@lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    """Anchors in lower case, each with its kinds and its length."""
    anchors: dict[str, list[str]] = {"@": ["email"], "://": ["login"], "tel:": ["tel"], "iban": ["iban"]}
    for d in "0123456789":
        anchors |= {d: ["card"], f".{d}": ["ip"], f"+{d}": ["phone"]}
    for words, kind in ((ACCOUNT_CUES, "account"), (SSN_CUES, "ssn"), (STREET_WORDS, "street")):
        anchors |= {w.lower(): [kind] for w in words}
    found = ahocorasick.Automaton()
    for anchor, kinds in anchors.items():
        found.add_word(anchor, (len(anchor), kinds))
    found.make_automaton()
    return found


def spans_of(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all spans, by start and then kind."""
    low = text.lower()
    if len(low) != len(text):  # only a dotted capital I grows when lowered
        low = text.replace("İ", "i").lower()
    free = dict.fromkeys(KINDS, 0)
    found = []
    for last, (size, kinds) in automaton().iter(low):
        at = last + 1 - size
        for kind in kinds:
            least = free[kind]
            if at < least:
                continue
            start = start_of(kind, text, at, least)
            m = PATTERNS[kind].match(text, start) if start >= 0 else None
            if m is None or m.end() <= at:
                continue
            free[kind] = m.end()
            group = m.re.groups
            if kind not in CHECKS or CHECKS[kind](m[group]):
                found.append((m.start(group), KINDS.index(kind), m.end(group)))
    return [(KINDS[k], start, end) for start, k, end in sorted(found)]


SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
SPANS_SQL = "array<struct<kind:string,start:long,end:long>>"


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each stretch of overlapping spans replaced by the kind of its first."""
    parts, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            parts += [text[at:start], f"<{kind}>"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def span_batches(batches: Iterator[pa.RecordBatch], mask: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans, texts = [], []
        for text in batch.column(1):
            t = text.as_py()
            found = spans_of(t or "")
            spans.append([dict(zip(("kind", "start", "end"), s)) for s in found])
            if mask:
                texts.append(t and masked(t, found))
        columns = [batch.column(0), pa.array(spans, SPANS)] + ([pa.array(texts, pa.string())] if mask else [])
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "spans", "masked"][: len(columns)])


def personal_spans(docs: DataFrame, mask: bool = False) -> DataFrame:
    """Per document its spans by start and kind (code points, end exclusive), and with ``mask`` its text with their kinds in their places."""
    schema = f"doc_id long, spans {SPANS_SQL}" + (", masked string" if mask else "")
    return narrow(docs, doc_id="doc_id", text="text").mapInArrow(partial(span_batches, mask=mask), schema)


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def personal_report(docs: DataFrame) -> DataFrame:
    """One row per document: counts by kind of the contract, the digest of their spans and all spans."""
    of_kind = lambda kind: F.filter("spans", lambda s: s["kind"] == kind)
    counts = [F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in BASE_KINDS]
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return personal_spans(docs).select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def report_sql() -> str:
    """The report in DuckDB's SQL: each kind's pattern over the text, places from the lengths of what lies between the matches."""
    part = "0*(25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
    checks = {
        "ip": rf"regexp_full_match(s, '{part}(\.{part}){{3}}')",
        "card": "length(d) BETWEEN 12 AND 19 AND list_sum(list_transform(range(length(d)), lambda i: CASE WHEN i % 2 = 0 THEN d[length(d) - i]::INT ELSE (2 * d[length(d) - i]::INT) // 10 + (2 * d[length(d) - i]::INT) % 10 END)) % 10 = 0",
        "phone": "length(d) BETWEEN 9 AND 15",
        "tel": "length(d) BETWEEN 7 AND 15",
        "iban": "list_reduce(list_transform(string_split(b[5:] || b[:4], ''), lambda c: strpos('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ', c) - 1), lambda a, x: (CASE WHEN x > 9 THEN 100 ELSE 10 END * a + x) % 97, 0) = 1",
        "account": "length(d) BETWEEN 6 AND 17",
        "ssn": "s[1:3] NOT IN ('000', '666') AND s[1] <> '9' AND s[5:6] <> '00' AND s[8:11] <> '0000'",
    }
    kinds = []
    for n, kind in enumerate(KINDS):
        p = PATTERNS[kind].pattern.replace("'", "''")
        group = f"regexp_extract(m, '{p}', {PATTERNS[kind].groups})" if PATTERNS[kind].groups else "m"
        check = f" WHERE {checks[kind]}" if kind in checks else ""
        lengths = "list_sum(list_transform({}, lambda x: length(x)))".format
        pieces = f"SELECT k, string_split_regex(t, '{p}') AS gaps, regexp_extract_all(t, '{p}') AS hits FROM docs"
        places = f"SELECT {lengths('gaps[1:i]')} + coalesce({lengths('hits[1:i - 1]')}, 0) AS place, hits[i] AS m, k FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM ({pieces}) WHERE len(hits) > 0)"
        values = f"SELECT *, regexp_replace(s, '[^0-9]', '', 'g') AS d, replace(s, ' ', '') AS b FROM (SELECT *, {group} AS s FROM ({places}))"
        kinds.append(f"SELECT k, {n} AS o, '{kind}' AS kind, place + length(m) - length(s) AS f, place + length(m) AS e FROM ({values}){check}")
    counts = ", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in BASE_KINDS)
    return (
        "WITH docs AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t FROM documents), spans AS (" + " UNION ALL ".join(kinds) + ") "
        f"SELECT docs.doc_id, {counts}, sha256(coalesce(string_agg(kind || ':' || f || ':' || e, ',' ORDER BY f, o) FILTER (o < {len(BASE_KINDS)}), '')) AS base_sha256, "
        "coalesce(string_agg(kind || ':' || f || ':' || e, ',' ORDER BY f, o), '') AS spans FROM docs LEFT JOIN spans USING (k) GROUP BY docs.k, docs.doc_id"
    )
