"""Personal data against the plain patterns over whole texts."""

from __future__ import annotations

import hashlib
import random
import re
import time

import pytest

from timbre.llm import personal_data as pd

PARTS = [
    *"1aA0.@-+():/_ \n", "12", "345", "..", "@b", "+1", "  ", "a.b", "x@y.z", "1.2.3.4", "255.0256.1.1", "://", "http://", "ftp://u:p@h", "u:p@h.com", "tel:", "TEL:+1-23-4567890", "IBAN ", "iban: ",
    "DE89 3704 0044 0532 0130 00", "DE89370400440532013000", "account no. ", "acct #", "12345678", "ssn: ", "123-45-6789", "000-12-3456", "12 Main Street", "5A Old Oak Avenue", ", Town, CA 90210", "Elm ",
    "Street", " Road\n", "É", "İ", "\u212a", "İban ", "\uff14", "4111 1111 1111 1111", "4111-1111-1111-1112", "99 ", "Park Lane", "social security number: ", "+1 (555) 010-9999",
]


def plain(text, kinds=pd.KINDS):
    found = []
    for n, kind in enumerate(kinds):
        p = re.compile((pd.BASE_PATTERNS | pd.ADDED_PATTERNS)[kind], re.A)
        found += [(m.start(p.groups), n, m.end(p.groups)) for m in p.finditer(text) if kind not in pd.CHECKS or pd.CHECKS[kind](m[p.groups])]
    return [(kinds[n], a, b) for a, n, b in sorted(found)]


def test_anchors_against_patterns():
    rng = random.Random(5)
    for k in range(20_000):
        t = "".join(rng.choice(PARTS if k % 2 else "01a.@-+ :/") for _ in range(rng.randint(0, 14 if k % 2 else 40)))
        assert pd.spans_of(t) == plain(t), t


def test_checks():
    assert [pd.luhn(x) for x in ("4111 1111-11111111", "4111111111111112", "0" * 11, "0" * 12, "0" * 19, "0" * 20)] == [True, False, False, True, True, False]
    assert [pd.small_parts(x) for x in ("255.0.0.1", "256.0.0.1", "0000255.1.1.1", "9" * 5000 + ".1.1.1")] == [True, False, True, False]
    assert pd.iban_holds("DE89 3704 0044 0532 0130 00") and not pd.iban_holds("DE88 3704 0044 0532 0130 00")
    assert [pd.ssn_holds(x) for x in ("123-45-6789", "000-45-6789", "666-45-6789", "912-45-6789", "123-00-6789", "123-45-0000")] == [True, *[False] * 5]


@pytest.mark.parametrize("unit", ("1", "1.", "a@", "a.b@c.", "a://", "+1 ", "iban ", "Aa Street ", "12 Aa ", "tel:1", "@", "eyJ"))
def test_long_texts_in_linear_time(unit):
    text = unit * (400_000 // len(unit))
    began = time.time()
    pd.spans_of(text)
    assert time.time() - began < 20  # hours, if stretches were read again from each anchor


def test_report(spark):
    texts = ["", None, "mail a.b+c@mail7.example.com, now", "4111 1111 1111 1111 and +1 (555) 010-9999 at 10.0.0.1", "see https://joe:pw@host.example/x and tel:+1-555-0100-99", "İ account no. 1234567 lives at 12 Old Oak Street, New Town, CA 90210.", "x" * 4_000 + " q@r.st"]
    docs = spark.createDataFrame([(i, t, "k", 0, "s") for i, t in enumerate(texts)] + [(None, "a@b.c", "k", 0, "s"), (2, texts[2], "k", 0, "s")], "doc_id long, text string, kind string, n_email int, spans string").repartition(3)
    out = pd.personal_report(docs).collect()
    assert len(out) == len(texts) + 2 and sum(r.doc_id is None for r in out) == 1
    for r in out:
        t = "a@b.c" if r.doc_id is None else texts[r.doc_id] or ""
        base, spans = plain(t, pd.BASE_KINDS), plain(t)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[0] == k for s in base) for k in pd.BASE_KINDS)
        text = lambda x: ",".join(f"{k}:{a}:{b}" for k, a, b in x)
        assert r.spans == text(spans) and r.base_sha256 == hashlib.sha256(text(base).encode()).hexdigest()
    assert pd.personal_report(docs.limit(0)).count() == 0
    kept = {r.doc_id: r.masked for r in pd.personal_spans(docs, mask=True).collect()}
    assert kept[1] is None and kept[2] == "mail <email>, now" and kept[5] == "İ account no. <account> lives at <street>."
