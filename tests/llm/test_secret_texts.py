"""Secrets in random, long and hostile texts."""

from __future__ import annotations

import base64
import json
import random
import re
import time

import pytest

from timbre.llm import secret_scan as ss

BASE = {
    "assign": (r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 8),
    "access": (r"AKIA[A-Z0-9]+", lambda m: m.end() - m.start() >= 16),
    "hex": (r"[0-9a-f]+", lambda m: m.end() - m.start() >= 32),
}
PARTS = [*"aA0f=:\"' _-./+\n", "token", "Secret", "API_KEY", "apikey", "password=", "passwd: ", "AKIA", "AKIA0123456789AB", "deadbeef", "0123456789abcdef" * 2, "eyJ", "eyJhbGciOiJIUzI1NiJ9", ".", "ghp_", "İ", "K", "ſecret=abcdefgh"]


def jwt(header: bytes) -> str:
    return ".".join(base64.urlsafe_b64encode(x).decode().rstrip("=") for x in (header, b'{"sub":"1"}', b"0123456789abcdef"))


def test_base_kinds_in_random_texts():
    rng = random.Random(4)
    for _ in range(20_000):
        t = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 16)))
        want = sorted((m.start(), i, m.end(), k) for i, (k, (p, ok)) in enumerate(BASE.items()) for m in re.finditer(p, t) if ok(m))
        assert [s for s in ss.spans_of(t) if s[2] in BASE] == [(a, b, k) for a, _, b, k in want], t


def test_tokens_in_random_texts():
    """Skipping the rest of a run that has failed loses no token."""
    rng, good = random.Random(6), jwt(b'{"alg":"none"}')
    parts = [good, good[:-20], "eyJ", "eyJa.", "x", ".", " ", good.split(".")[0], "." + good.split(".", 1)[1], "eyJeyJ"]
    for _ in range(5_000):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(0, 6)))
        want = [(m.start(), m.end(), "jwt") for m in ss.JWT.finditer(t) if ss.names_algorithm(m)]
        assert [s for s in ss.spans_of(t) if s[2] == "jwt"] == want, t


@pytest.mark.parametrize("header", (b'{"a":' * 30_000, b'{"alg":' + b"[" * 100_000, b'{"alg":' + b"9" * 5000 + b"}", b'{"alg":"\xff\xfe"}', b'{"alg":1}', b'{"a":1}', b'{"alg":"x"'))
def test_hostile_headers_are_no_tokens(header):
    assert not any(s[2] == "jwt" for s in ss.spans_of("x " + jwt(header) + " password=longenough"))
    assert any(s[2] == "assign" for s in ss.spans_of("x " + jwt(header) + " password=longenough"))


def test_a_plain_header_is_one():
    assert [s[2] for s in ss.spans_of(jwt(json.dumps({"alg": "HS256"}).encode()))] == ["jwt"]


@pytest.mark.parametrize("unit", ("eyJ", "eyJa.", "eyJa.eyJb.", "token ", "token=", "secret:' ", "AKIA", "AKIA ", "ghp_", "npm_a", "-----BEGIN ", "-----BEGIN PRIVATE KEY-----a", "f", "ff "))
def test_time_is_linear(unit):
    text = unit * (1_000_000 // len(unit))
    began = time.time()
    ss.spans_of(text)
    assert time.time() - began < 15  # an hour, if runs were read again from each start
