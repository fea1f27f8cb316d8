"""What the members of a tar shard are called and what their sidecars hold."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timbre.functions.text import first_of, to_number

# Audio suffixes, and the aliases of sidecar fields in order.
AUDIO = (".flac", ".wav", ".ogg", ".mp3", ".opus")
ALIASES = {
    "original_id": ("original_id", "id", "wav", "key"),
    "original_text": ("original_text", "text", "transcript"),
    "original_speaker": ("original_speaker", "speaker", "spk", "speaker_id"),
    "original_language": ("original_language", "language", "lang"),
    "duration_s": ("duration_s", "duration", "dur"),
    "original_dnsmos": ("original_dnsmos", "dnsmos", "dnsmos_ovrl"),
}
NUMBERS = frozenset(("duration_s", "original_dnsmos"))


def stem(member: Column) -> Column:
    """A member's name without its folders and its last suffix."""
    return F.regexp_replace(F.substring_index(member, "/", -1), r"(?<=.)\.[^.]*$", "")


def is_audio(member: Column) -> Column:
    return F.lower(member).rlike("(" + "|".join(x.replace(".", r"\.") for x in AUDIO) + ")$")


def resolved(clips: DataFrame, sidecar: str = "sidecar") -> DataFrame:
    """Adds the sidecar's fields under their own names: the first alias that isn't null."""
    document = F.col(sidecar)

    def field(name: str) -> Column:
        value = first_of(document, ALIASES[name])
        return to_number(value) if name in NUMBERS else value

    return clips.withColumns({name: field(name) for name in ALIASES})


def sidecar_of(**fields: object) -> bytes:
    return json.dumps(fields, ensure_ascii=False).encode()
