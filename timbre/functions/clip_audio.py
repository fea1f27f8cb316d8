"""Clips as columns: WAV bytes from samples and back, trims, and the requests that carry them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from timbre.functions import signal

DECODED = T.StructType([T.StructField("rate", T.IntegerType()), T.StructField("samples", T.ArrayType(T.FloatType())), T.StructField("error", T.StringType())])
WAV_ERRORS = (ValueError, EOFError, KeyError, signal.wave.Error)


def wav_of(rate: int):
    """A UDF: mono 16-bit WAV bytes of an array of samples; null of null."""

    @F.pandas_udf(T.BinaryType())
    def encode(samples: pd.Series) -> pd.Series:
        return samples.map(lambda x: None if x is None else signal.encode_wav(np.asarray(x, np.float32), rate))

    return encode


@F.pandas_udf(DECODED)
def decoded(data: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """The rate and the mono samples of WAV bytes; what can't be decoded has an error and neither."""
    for part in data:
        rows = []
        for d in part:
            try:
                x, rate = (None, None) if d is None else signal.decode_wav(d)
                rows.append((rate, x, None))
            except WAV_ERRORS as e:
                rows.append((None, None, type(e).__name__))
        yield pd.DataFrame(rows, columns=["rate", "samples", "error"])


@F.pandas_udf(T.BinaryType())
def cut(data: pd.Series, start: pd.Series, end: pd.Series) -> pd.Series:
    """The stretch [start, end) in seconds of WAV bytes; the bytes themselves where there is no start, the rest where there is no end."""
    return pd.Series([d if d is None or pd.isna(a) else signal.trimmed_wav(d, a, 1e9 if pd.isna(b) else b) for d, a, b in zip(data, start, end)])


def data_uri(audio: Column, kind: str = "wav") -> Column:
    """The bytes as a data URI."""
    return F.concat(F.lit(f"data:audio/{kind};base64,"), F.base64(audio))


def messages(audio: Column, reference: Column, system: str, instruction: str, kind: str = "wav") -> Column:
    """The messages of a labelling request as JSON: a system turn, and a user turn with the audio and the instruction.

    ``instruction`` has ``{reference_text}`` where the clip's text goes.
    """
    before, _, after = instruction.partition("{reference_text}")
    text = F.concat(F.lit(before), F.coalesce(reference, F.lit("")), F.lit(after)) if "{reference_text}" in instruction else F.lit(instruction)
    sound = F.struct(F.lit("input_audio").alias("type"), F.struct(data_uri(audio, kind).alias("data"), F.lit(kind).alias("format")).alias("input_audio"))
    words = F.struct(F.lit("text").alias("type"), text.alias("text"))
    user = F.concat(F.lit("["), F.to_json(sound), F.lit(","), F.to_json(words), F.lit("]"))
    first = F.to_json(F.struct(F.lit("system").alias("role"), F.lit(system).alias("content")))
    return F.concat(F.lit("["), first, F.lit(',{"role":"user","content":'), user, F.lit("}]"))
