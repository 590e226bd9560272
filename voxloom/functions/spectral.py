"""Frequency measures of sample arrays. Built-in functions hold no Fourier transform, so these are Arrow-batched.

Frames are WIDTH samples every HOP, Hann-windowed, over the array with WIDTH / 2 zeros at both ends. Null and empty
arrays give the stated value; every clip is worked on by itself, in constant memory beside its own samples.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

WIDTH, HOP = 2048, 512
# fixed values: the band of vocal fry and its spread, the band of speech and its gain
FRY_HZ, FRY_SPREAD = 1000.0, 0.3
SPEECH_HZ, SPEECH_GAIN = (300.0, 3000.0), 1.2


def _window() -> np.ndarray:
    return 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(WIDTH) / WIDTH)


def spectrum(xs: np.ndarray) -> np.ndarray:
    """Complex spectrum, a row a frame."""
    padded = np.concatenate([np.zeros(WIDTH // 2), xs, np.zeros(WIDTH // 2)])
    views = np.lib.stride_tricks.sliding_window_view(padded, WIDTH)[::HOP]
    return np.fft.rfft(views * _window(), axis=1)


def waveform(spec: np.ndarray, n: int) -> np.ndarray:
    """Weighted overlap-add of the frames, cut to n samples."""
    window = _window()
    total = np.zeros(WIDTH + HOP * (len(spec) - 1))
    weight = np.zeros_like(total)
    for k, frame in enumerate(np.fft.irfft(spec, WIDTH, axis=1)):
        total[k * HOP : k * HOP + WIDTH] += frame * window
        weight[k * HOP : k * HOP + WIDTH] += window * window
    out = np.divide(total, weight, out=np.zeros_like(total), where=weight > 1e-10)[WIDTH // 2 :]
    # a copy, as a view would keep whole frames alive for every clip of a batch
    return np.concatenate([out[:n], np.zeros(max(0, n - len(out)))])


def _bins(rate: float) -> np.ndarray:
    return np.arange(WIDTH // 2 + 1) * rate / WIDTH


def has_fry_of(xs: np.ndarray, rate: float) -> bool:
    level = np.abs(spectrum(xs))[:, _bins(rate) <= FRY_HZ].mean(axis=1)
    return bool(level.std() / (level.mean() + 1e-8) > FRY_SPREAD)


def scaled_band(xs: np.ndarray, rate: float, low: float, high: float, factor: float) -> np.ndarray:
    spec, bins = spectrum(xs), _bins(rate)
    spec[:, (bins >= low) & (bins <= high)] *= factor
    return waveform(spec, len(xs))


def trimmed(xs: np.ndarray, rate: float, top_db: float = 40.0) -> np.ndarray:
    """From the first to the last frame whose mean power is within top_db of the loudest; nothing of silence."""
    padded = np.concatenate([np.zeros(WIDTH // 2), xs, np.zeros(WIDTH // 2)])
    power = (np.lib.stride_tricks.sliding_window_view(padded, WIDTH)[::HOP] ** 2).mean(axis=1)
    if power.max() <= 0:
        return xs[:0]
    loud = np.flatnonzero(10 * np.log10(np.maximum(power, 1e-10) / power.max()) > -top_db)
    return xs[loud[0] * HOP : min(len(xs), (loud[-1] + 1) * HOP)]


def _applied(f: Callable, kind: str, empty) -> Callable[[Column, Column], Column]:
    # no iterator of batches: measures of that form would have a Python worker each in every task, those of this one share it
    @F.pandas_udf(kind)
    def run(samples: pd.Series, rates: pd.Series) -> pd.Series:
        return pd.Series([empty if x is None or not len(x) else f(np.asarray(x, float), float(r)) for x, r in zip(samples, rates, strict=True)], dtype=object if kind != "boolean" else "bool")

    return run


def has_fry(samples: Column, rate: Column) -> Column:
    """Whether the level up to 1 kHz varies much from frame to frame; false without samples."""
    return _applied(has_fry_of, "boolean", False)(samples, rate)


def less_fry(samples: Column, rate: Column, aggressive: float = 0.5) -> Column:
    """The band up to 1 kHz turned down by `aggressive`."""
    return _applied(lambda x, r: scaled_band(x, r, 0.0, FRY_HZ, 1 - aggressive), "array<double>", [])(samples, rate)


def more_speech(samples: Column, rate: Column) -> Column:
    """The band of speech turned up."""
    return _applied(lambda x, r: scaled_band(x, r, *SPEECH_HZ, SPEECH_GAIN), "array<double>", [])(samples, rate)


def trim_silence(samples: Column, rate: Column, top_db: float = 40.0) -> Column:
    return _applied(lambda x, r: trimmed(x, r, top_db), "array<double>", [])(samples, rate)
