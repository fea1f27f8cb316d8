"""Signal measures: aggregates over samples, and numpy kernels for Arrow UDFs."""

from __future__ import annotations

import hashlib
import io
import wave

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

EPS = 1e-10
FRAME, HOP = 1024, 512


def clipped_share(sample: Column, limit: float = 0.999) -> Column:
    """Aggregate over samples, a row each: the share at full scale; 0 of none."""
    return F.coalesce(F.count_if(F.abs(sample) >= limit) / F.nullif(F.count(sample), F.lit(0)), F.lit(0.0))


def peak_level(sample: Column) -> Column:
    """Aggregate over samples, a row each: the greatest one in dB of full scale; null of none."""
    return 20 * F.log10(F.max(F.abs(sample)) + F.lit(1e-12))


def duration_s(count: Column, rate: Column) -> Column:
    return F.when(rate > 0, count / rate).otherwise(0.0)


def speech_rate(chars: Column, spoken_s: Column, total_s: Column) -> Column:
    """Characters over spoken seconds, over all seconds if none is known, else 0."""
    return F.coalesce(chars / F.nullif(F.greatest(spoken_s, F.lit(0.0)), F.lit(0.0)), chars / F.nullif(F.greatest(total_s, F.lit(0.0)), F.lit(0.0)), F.lit(0.0))


# --- numpy kernels ---


def decode_wav(data: bytes) -> tuple[np.ndarray, int]:
    """Mono samples in [-1, 1] (mean of the channels) and the rate."""
    with wave.open(io.BytesIO(data)) as w:
        width, channels, rate = w.getsampwidth(), w.getnchannels(), w.getframerate()
        raw = w.readframes(w.getnframes())
    if width == 1:
        x = (np.frombuffer(raw, np.uint8).astype(np.float32) - 128) / 128
    elif width == 3:
        b = np.frombuffer(raw, np.uint8).reshape(-1, 3).astype(np.int32)
        x = (((b[:, 0] | b[:, 1] << 8 | b[:, 2] << 16) ^ 0x800000) - 0x800000).astype(np.float32) / (1 << 23)
    else:
        x = np.frombuffer(raw, {2: "<i2", 4: "<i4"}[width]).astype(np.float32) / float(1 << 8 * width - 1)
    return x.reshape(-1, channels).mean(axis=1).astype(np.float32), rate


def encode_wav(x: np.ndarray, rate: int) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes((np.clip(x, -1, 1) * 32767).round().astype("<i2").tobytes())
    return out.getvalue()


def header_rate(data: bytes) -> int | None:
    try:
        with wave.open(io.BytesIO(data)) as w:
            return w.getframerate()
    except (wave.Error, EOFError):
        return None


def trimmed_wav(data: bytes, start_s: float, end_s: float) -> bytes:
    x, rate = decode_wav(data)
    return encode_wav(x[max(0, int(start_s * rate)) : max(0, int(end_s * rate))], rate)


def resample(x: np.ndarray, source: int, target: int, half: int = 16) -> np.ndarray:
    """Windowed-sinc interpolation, low-passed at the lower rate's half; as it is if the rates are equal."""
    if source == target or not len(x):
        return x
    n = max(1, int(round(len(x) * target / source)))
    cut = min(1.0, target / source)
    at = np.arange(n) * (source / target)
    reach = int(np.ceil(half / cut))
    first = np.floor(at).astype(np.int64) - reach + 1
    index = first[:, None] + np.arange(2 * reach)
    distance = index - at[:, None]
    kernel = cut * np.sinc(cut * distance) * np.where(np.abs(distance) < reach, 0.5 + 0.5 * np.cos(np.pi * distance / reach), 0)
    inside = (index >= 0) & (index < len(x))
    return (np.where(inside, x[np.clip(index, 0, len(x) - 1)], 0) * kernel).sum(axis=1).astype(np.float32)


def frames_of(x: np.ndarray, length: int, hop: int) -> np.ndarray:
    """Overlapping frames; a short signal is one frame padded by zeros."""
    if len(x) < length:
        return np.pad(x, (0, length - len(x)))[None, :]
    return np.lib.stride_tricks.sliding_window_view(x, length)[::hop]


def mean_spectrum(x: np.ndarray, rate: int) -> tuple[np.ndarray, np.ndarray]:
    """Frequencies and mean power of Hann-windowed frames."""
    length = max(16, FRAME if len(x) >= FRAME else len(x))
    frames = frames_of(np.asarray(x, np.float64), length, max(1, length // 2))
    power = (np.abs(np.fft.rfft(frames * np.hanning(length), axis=1)) ** 2).mean(axis=0)
    return np.fft.rfftfreq(length, 1 / rate), power


def roll_off(x: np.ndarray, rate: int, share: float = 0.99) -> float:
    """The first frequency at which ``share`` of the power is reached; 0 for silence."""
    frequency, power = mean_spectrum(x, rate)
    total = power.sum()
    if len(x) == 0 or total <= EPS:
        return 0.0
    return float(frequency[np.searchsorted(np.cumsum(power), share * total)])


def frame_snr(x: np.ndarray) -> float:
    """10 log10 of (p95 - p10) / p10 of frame powers, between -20 and 100."""
    if not len(x):
        return 0.0
    power = (frames_of(np.asarray(x, np.float64), FRAME, HOP) ** 2).mean(axis=1)
    noise, speech = np.percentile(power, [10, 95])
    return float(np.clip(10 * np.log10(max(speech - noise, EPS) / max(noise, EPS)), -20, 100))


def biquad(x: np.ndarray, b: tuple, a: tuple) -> np.ndarray:
    """A second-order filter by its impulse response, which has died out after 4,096 samples."""
    n = min(len(x), 4096)
    h = np.zeros(n)
    for i in range(n):
        h[i] = (b[i] if i < 3 else 0.0) - (a[1] * h[i - 1] if i > 0 else 0.0) - (a[2] * h[i - 2] if i > 1 else 0.0)
    size = 1 << (len(x) + n - 1).bit_length()
    return np.fft.irfft(np.fft.rfft(x, size) * np.fft.rfft(h, size), size)[: len(x)]


def k_weighted(x: np.ndarray, rate: int) -> np.ndarray:
    """The two filters of BS.1770, designed for the rate from their published analogue parameters."""
    g, q, f = 3.999843853973347, 0.7071752369554196, 1681.974450955533
    k, v = np.tan(np.pi * f / rate), 10 ** (g / 20)
    w, d = v**0.4996667741545416, 1 + k / q + k * k
    x = biquad(x, ((v + w * k / q + k * k) / d, 2 * (k * k - v) / d, (v - w * k / q + k * k) / d), (1, 2 * (k * k - 1) / d, (1 - k / q + k * k) / d))
    q, f = 0.5003270373238773, 38.13547087602444
    k = np.tan(np.pi * f / rate)
    d = 1 + k / q + k * k
    return biquad(x, (1.0, -2.0, 1.0), (1, 2 * (k * k - 1) / d, (1 - k / q + k * k) / d))


def loudness(x: np.ndarray, rate: int) -> float:
    """Gated loudness of BS.1770 in LUFS; the RMS level of what is shorter than a gating block; -inf of nothing."""
    if not len(x):
        return float("-inf")
    block, hop = int(0.4 * rate), int(0.1 * rate)
    if len(x) < block or hop < 1:
        return float(20 * np.log10(np.sqrt(np.mean(np.square(x, dtype=np.float64))) + 1e-12))
    power = (frames_of(k_weighted(np.asarray(x, np.float64), rate), block, hop) ** 2).mean(axis=1)
    level = -0.691 + 10 * np.log10(power + 1e-20)
    loud = power[level > -70]
    if not len(loud):
        return float("-inf")
    loud = power[(level > -70) & (level > -0.691 + 10 * np.log10(loud.mean()) - 10)]
    return float(-0.691 + 10 * np.log10(loud.mean()))


def frame_rms(x: np.ndarray, rate: int) -> np.ndarray:
    """RMS of 25 ms frames every 10 ms."""
    length, hop = max(1, int(0.025 * rate)), max(1, int(0.010 * rate))
    x = np.asarray(x, np.float64)
    frames = x[None, :] if len(x) < length else frames_of(x, length, hop)
    return np.sqrt((frames**2).mean(axis=1) + 1e-12)


def track_pitch(x: np.ndarray, rate: int, low: float = 65.0, high: float = 500.0) -> np.ndarray:
    """F0 of 40 ms frames every 10 ms by autocorrelation; 0 where unvoiced."""
    length, hop = int(0.040 * rate), max(1, int(0.010 * rate))
    frames = frames_of(np.asarray(x, np.float64), length, hop)
    frames = frames - frames.mean(axis=1, keepdims=True)
    size = 1 << (2 * length - 1).bit_length()
    ac = np.fft.irfft(np.abs(np.fft.rfft(frames, size, axis=1)) ** 2, size, axis=1)[:, :length]
    a, b = max(1, int(rate / high)), min(length - 1, int(rate / low))
    lag = a + ac[:, a : b + 1].argmax(axis=1)
    strength = ac[np.arange(len(ac)), lag] / np.maximum(ac[:, 0], 1e-12)
    return np.where((strength > 0.3) & (ac[:, 0] > 1e-6), rate / lag, 0.0)


def speech_spans(x: np.ndarray, rate: int, share: float = 0.1) -> list[tuple[float, float]]:
    """Spans of frames whose RMS is above a share of the loudest frame's."""
    rms = frame_rms(x, rate)
    on = rms > max(share * rms.max(), 1e-4)
    edges = np.flatnonzero(np.diff(np.r_[False, on, False]))
    return [(s * 0.010, e * 0.010 + 0.015) for s, e in zip(edges[::2], edges[1::2])]


def pitch_metrics(f0: np.ndarray) -> dict[str, float]:
    voiced = f0 > 0
    if not voiced.any():
        return dict.fromkeys(("f0_mean_hz", "f0_std_st", "f0_range_st", "f0_tracker_confidence"), 0.0)
    st = 12 * np.log2(np.maximum(f0, 1e-9) / 55.0)
    pairs = voiced[1:] & voiced[:-1]
    jumps = (np.abs(np.diff(st))[pairs] > 6.0).mean() if pairs.any() else 0.0
    p5, p95 = np.percentile(st[voiced], [5, 95])
    return {"f0_mean_hz": float(f0[voiced].mean()), "f0_std_st": float(st[voiced].std()), "f0_range_st": float(p95 - p5), "f0_tracker_confidence": float(np.clip(voiced.mean() * (1 - jumps), 0, 1))}


def rms_deviation(rms: np.ndarray) -> float:
    loud = rms[rms >= 1e-3 * rms.max()]
    return float((20 * np.log10(loud + 1e-12)).std()) if len(loud) >= 2 else 0.0


def wav_features(data: bytes) -> dict:
    """All measures of one clip in a pass: the audio is decoded once."""
    x, rate = decode_wav(data)
    rms = frame_rms(x, rate)
    spans = speech_spans(x, rate) if len(x) else []
    gaps = [b[0] - a[1] for a, b in zip(spans, spans[1:])]
    return {
        "duration_s": len(x) / rate if rate else 0.0, "clipping_ratio": float((np.abs(x) >= 0.999).mean()) if len(x) else 0.0,
        "peak_dbfs": float(20 * np.log10(np.abs(x).max() + 1e-12)) if len(x) else -240.0, "bandwidth_hz": roll_off(x, rate), "snr_db": frame_snr(x),
        "loudness_lufs": loudness(x, rate), "energy_std_db": rms_deviation(rms), "pause_count": sum(g >= 0.2 for g in gaps), "speech_s": float(sum(e - s for s, e in spans)),
        **pitch_metrics(track_pitch(x, rate)),
    }


FEATURES = T.StructType([T.StructField(n, T.LongType() if n == "pause_count" else T.DoubleType()) for n in ("duration_s", "clipping_ratio", "peak_dbfs", "bandwidth_hz", "snr_db", "loudness_lufs", "energy_std_db", "pause_count", "speech_s", "f0_mean_hz", "f0_std_st", "f0_range_st", "f0_tracker_confidence")])


def features_udf():
    """Arrow UDF from the encoded audio to a struct of all measures."""

    @F.pandas_udf(FEATURES)
    def run(audio: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([wav_features(a) for a in audio], columns=FEATURES.names)

    return run


def seeded_numbers(*parts: object, n: int = 1) -> np.ndarray:
    """Numbers in [0, 1) from the hash of the parts: deterministic stand-ins of models."""
    seed = hashlib.sha256("\0".join(map(str, parts)).encode()).digest()
    return np.random.default_rng(int.from_bytes(seed[:8], "big")).random(n)


def synthetic_voice(seconds: float, rate: int = 16000, seed: int = 0, pauses: tuple[tuple[float, float], ...] = ()) -> np.ndarray:
    """A frequency-modulated sine with a moving gain, silent pauses and faint noise."""
    rng = np.random.default_rng(seed)
    t = np.arange(int(seconds * rate)) / rate
    base = rng.uniform(110, 220)
    phase = 2 * np.pi * np.cumsum(base * (1 + 0.1 * np.sin(2 * np.pi * rng.uniform(0.5, 2) * t))) / rate
    x = 0.5 * np.sin(phase) * (0.7 + 0.3 * np.sin(2 * np.pi * rng.uniform(1, 3) * t))
    for a, b in pauses:
        x[int(a * rate) : int(b * rate)] = 0
    return np.clip(x + rng.normal(0, 1e-3, len(t)), -1, 1).astype(np.float32)
