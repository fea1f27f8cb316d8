"""Label documents: parsing, validation, and labelling calls with retry."""

from __future__ import annotations

import asyncio
import hashlib
import json
import random
from collections.abc import Awaitable, Callable, Iterator
from typing import TypeVar

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from timbre import schemas
from timbre.config import LabelRule

T_ = TypeVar("T_")

#: path: closed vocabulary, or bounds of a number.
CHECKS = {
    "text_verdict": schemas.TEXT_VERDICTS,
    "emotion.primary": schemas.EMOTIONS,
    "emotion.secondary": schemas.EMOTIONS,
    "emotion.intensity": (1, 5),
    "emotion.confidence": (0.0, 1.0),
    "prosody.expressiveness": (1, 5),
    "prosody.speaking_style": schemas.STYLES,
    "prosody.rhythm": schemas.RHYTHMS,
    "context.scenario": schemas.SCENARIOS,
    "context.register": schemas.REGISTERS,
    "language.accent": schemas.ACCENTS,
}
OPTIONAL = frozenset(("emotion.secondary",))
#: Fields of any value that must be there.
REQUIRED = ("text_fixed", "text_punctuated", "prosody.prominent_stress", "context.summary", "language.primary", "language.code_switch", "usable")
BLOCKS = ("emotion", "prosody", "context", "language")
LIST_CHECKS = {"paralinguistic": schemas.EVENTS, "defects": schemas.DEFECTS}


def unfenced(response: Column) -> Column:
    """The document without a code fence and its ``json`` tag."""
    return F.regexp_replace(F.regexp_replace(response, r"^\s*```(?:json)?\s*", ""), r"\s*```\s*$", "")


def schema_errors(document: Column, labels: Column) -> Column:
    """Names of the fields that are missing, outside their vocabulary or bounds, or unknown."""
    found = []
    for path, allowed in CHECKS.items():
        value = labels
        for part in path.split("."):
            value = value[part]
        bounded = not isinstance(allowed[0], str)
        fine = ((value >= allowed[0]) & (value <= allowed[1])) if bounded else value.isin(*allowed)
        bad = value.isNotNull() & ~fine if path in OPTIONAL else value.isNull() | ~fine
        found.append(F.when(bad, path))
    for path, allowed in LIST_CHECKS.items():
        found.append(F.when(F.exists(F.coalesce(labels[path], F.array().cast("array<string>")), lambda x: ~x.isin(*allowed)), path))
    for path in REQUIRED:
        value = labels
        for part in path.split("."):
            value = value[part]
        found.append(F.when(value.isNull(), path))
    none = F.array().cast("array<string>")
    known = {f.name: f.dataType for f in schemas.LABELS.fields}
    keys = lambda text: F.coalesce(F.json_object_keys(text), none)
    foreign = lambda text, names, prefix: F.transform(F.filter(keys(text), lambda k: ~k.isin(*names)), lambda k: F.concat(F.lit("unknown:" + prefix), k))
    unknown = [foreign(document, list(known), "")]
    unknown += [foreign(F.get_json_object(document, f"$.{block}"), known[block].fieldNames(), block + ".") for block in BLOCKS]
    return F.concat(F.array_compact(F.array(*found)), *unknown)


def label_schema() -> dict:
    """The document's JSON schema, as it is sent along with a request."""
    names = {"string": "string", "int": "integer", "double": "number", "boolean": "boolean"}

    def of(kind, path: str) -> dict:
        if isinstance(kind, T.StructType):
            fields = {f.name: of(f.dataType, f"{path}.{f.name}".lstrip(".")) for f in kind.fields}
            lists = {f.name for f in kind.fields if isinstance(f.dataType, T.ArrayType)}
            wanted = [n for n in fields if n not in lists and f"{path}.{n}".lstrip(".") not in OPTIONAL]
            return {"type": "object", "properties": fields, "required": wanted, "additionalProperties": False}
        if isinstance(kind, T.ArrayType):
            return {"type": "array", "items": {"type": "string", "enum": list(LIST_CHECKS[path])}}
        out, allowed = {"type": names[kind.simpleString()]}, CHECKS.get(path)
        if allowed is None:
            return out
        return out | ({"enum": list(allowed)} if isinstance(allowed[0], str) else {"minimum": allowed[0], "maximum": allowed[1]})

    return of(schemas.LABELS, "")


KINDS = {"object": dict, "array": list, "string": str, "boolean": bool, "integer": int, "number": (int, float)}


def problems(value: object, schema: dict, path: str = "") -> list[str]:
    """Names of the fields of a parsed document that its schema doesn't allow or misses."""
    if value is None:
        return []  # whether it may be missing is for the block that holds it
    kind = schema["type"]
    if not isinstance(value, KINDS[kind]) or isinstance(value, bool) and kind != "boolean":
        return [path or "malformed"]
    if kind == "array":
        return [path] if any(x not in schema["items"]["enum"] for x in value) else []
    if kind != "object":
        fine = value in schema["enum"] if "enum" in schema else schema.get("minimum", value) <= value <= schema.get("maximum", value)
        return [] if fine else [path]
    at = lambda name: f"{path}.{name}".lstrip(".")
    found = [at(n) for n in schema["required"] if value.get(n) is None] + ["unknown:" + at(n) for n in value if n not in schema["properties"]]
    return found + [x for n, s in schema["properties"].items() for x in problems(value.get(n), s, at(n))]


def checked(answer: str | None, schema: dict) -> dict:
    """The document of a provider's answer; one that doesn't parse or validate is an error that may pass on another try."""
    text = (answer or "").strip()
    if text.startswith("```"):
        text = text.removeprefix("```").removeprefix("json").strip()
        text = text.removesuffix("```").strip()
    try:
        document = json.loads(text)
    except (ValueError, RecursionError) as e:
        raise LabelError(f"malformed answer: {type(e).__name__}") from e
    if found := problems(document, schema) if document is not None else ["malformed"]:
        raise LabelError(f"malformed answer: {','.join(found)}")
    return document


def parse_labels(df: DataFrame, response: str) -> DataFrame:
    """Adds labels, schema_errors, s4_status and error; what doesn't parse or validate has null labels."""
    out = df.withColumn("__doc", unfenced(F.col(response)))
    out = out.withColumn("__parsed", F.from_json("__doc", schemas.LABELS, {"mode": "PERMISSIVE"}))
    whole = F.json_object_keys("__doc").isNotNull()
    errors = F.when(~F.coalesce(whole, F.lit(False)), F.array(F.lit("malformed"))).otherwise(schema_errors(F.col("__doc"), F.col("__parsed")))
    out = out.withColumn("schema_errors", errors)
    fine = F.size("schema_errors") == 0
    return out.withColumns({"labels": F.when(fine, F.col("__parsed")), "s4_status": F.when(fine, "ok").otherwise("failed"), "error": F.when(~fine, F.left(F.concat_ws(",", "schema_errors"), F.lit(500)))}).drop("__doc", "__parsed")


def retryable(status: int | None, message: str) -> bool:
    """Rate limits, server errors and lost connections may pass; other errors won't."""
    if status is not None:
        return status == 429 or status >= 500
    return any(x in message.lower() for x in ("timeout", "timed out", "connection", "throttl", "rate limit", "ratelimit", "malformed"))


def backoff(attempt: int, rule: LabelRule, rng: random.Random) -> float:
    """Full jitter: a random share of the doubled delay, capped."""
    return rng.uniform(0, min(rule.backoff_cap_s, 2.0**attempt))


class LabelError(Exception):
    def __init__(self, message: str, status: int | None = None):
        super().__init__(message)
        self.status = status


async def with_retry(call: Callable[[], Awaitable[T_]], rule: LabelRule, rng: random.Random, sleep=asyncio.sleep) -> T_:
    for attempt in range(rule.max_attempts):
        try:
            return await call()
        except Exception as e:  # noqa: BLE001
            if attempt + 1 == rule.max_attempts or not retryable(getattr(e, "status", None), f"{type(e).__name__} {e}"):
                raise
            await sleep(backoff(attempt, rule, rng))
    raise AssertionError


def seeded_document(clip_id: str, text: str) -> str:
    """A deterministic document from the hash of the clip: the default provider."""
    rng = random.Random(hashlib.sha256(f"{clip_id}\0{text}".encode()).digest())
    pick = rng.choice
    return json.dumps({
        "text_verdict": pick(schemas.TEXT_VERDICTS), "text_fixed": text, "text_punctuated": text,
        "emotion": {"primary": pick(schemas.EMOTIONS), "secondary": None, "intensity": rng.randint(1, 5), "confidence": round(rng.random(), 3)},
        "prosody": {"expressiveness": rng.randint(1, 5), "speaking_style": pick(schemas.STYLES), "rhythm": pick(schemas.RHYTHMS), "prominent_stress": rng.random() < 0.5},
        "context": {"scenario": pick(schemas.SCENARIOS), "register": pick(schemas.REGISTERS), "summary": ""},
        "language": {"primary": "en", "code_switch": False, "accent": pick(schemas.ACCENTS)},
        "paralinguistic": [], "defects": [], "usable": True,
    }, ensure_ascii=False)


async def seeded_provider(clip_id: str, text: str) -> str:
    return seeded_document(clip_id, text)


Provider = Callable[[str, str], Awaitable[str]]
CALLS = "clip_id string, response string, error string, triaged boolean"


def label_calls(df: DataFrame, rule: LabelRule = LabelRule(), provider: Provider = seeded_provider, triage: Provider | None = None) -> DataFrame:
    """(clip_id, response, error, triaged): one labelled row per row of (clip_id, text), some at a time in each task.

    An answer is parsed and validated inside its call, so a malformed one is asked
    for again. A call that fails for good keeps its row, with the error and no
    response. With ``triage``, a short call comes first; a clip that it finds not
    usable has no further call, no response and no error, and is ``triaged``.
    """
    schema = label_schema()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        async def batch(frame: pd.DataFrame) -> pd.DataFrame:
            gate, rng = asyncio.Semaphore(rule.concurrency), random.Random()

            async def ask(call: Provider, clip_id: str, text: str) -> tuple[str, dict]:
                async def once() -> tuple[str, dict]:
                    answer = await call(clip_id, text)
                    return answer, checked(answer, schema)

                return await with_retry(once, rule, rng)

            async def one(clip_id: str, text: str):
                async with gate:
                    try:
                        if triage is not None and not (await ask(triage, clip_id, text))[1]["usable"]:
                            return clip_id, None, None, True
                        return clip_id, (await ask(provider, clip_id, text))[0], None, False
                    except Exception as e:  # noqa: BLE001  a provider may fail in any way; the row keeps the error
                        return clip_id, None, (str(e) or type(e).__name__)[:500], False

            rows = await asyncio.gather(*(one(c, t or "") for c, t in zip(frame.clip_id, frame.text)))
            return pd.DataFrame(rows, columns=["clip_id", "response", "error", "triaged"])

        for frame in frames:
            yield asyncio.run(batch(frame))

    return df.select("clip_id", "text").mapInPandas(run, CALLS)


def label_rows(calls: DataFrame) -> DataFrame:
    """(clip_id, s4_status, error, triaged, labels) of every call: failed ones keep their error, triaged ones are ok without labels."""
    rows = parse_labels(calls.withColumnRenamed("error", "__error"), "response")
    lost = F.col("__error").isNotNull()
    status = F.when(F.col("triaged"), "ok").when(lost, "failed").otherwise(F.col("s4_status"))
    error = F.when(~F.col("triaged"), F.coalesce("__error", "error"))
    return rows.select("clip_id", status.alias("s4_status"), error.alias("error"), "triaged", F.when(~F.col("triaged") & ~lost, F.col("labels")).alias("labels"))


def label_pass(df: DataFrame, pilot: DataFrame | None = None, rule: LabelRule = LabelRule(), provider: Provider = seeded_provider, triage: Provider = seeded_provider) -> DataFrame:
    """Label rows of ``df``; with triage first where the rule wants two passes or too few documents of ``pilot`` (s4_status, usable) are usable."""
    rate = 1.0 if pilot is None else pilot_rate(pilot).first().pilot_rate
    return label_rows(label_calls(df, rule, provider, triage if needs_second_pass(rate, rule) else None))


def pilot_rate(df: DataFrame) -> DataFrame:
    """(n_ok, n_usable, pilot_rate): usable documents among those that were labelled."""
    ok = F.col("s4_status") == "ok"
    out = df.agg(F.count_if(ok).alias("n_ok"), F.count_if(ok & F.coalesce("usable", F.lit(False))).alias("n_usable"))
    return out.withColumn("pilot_rate", F.when(F.col("n_ok") > 0, F.col("n_usable") / F.col("n_ok")).otherwise(0.0))


def needs_second_pass(rate: float, rule: LabelRule) -> bool:
    return rule.two_pass or rate < rule.pilot_rate
