"""Measures and transforms of sample arrays as column expressions: no UDF, so they stay in generated code.

Every function takes array<double> columns; an empty or null array gives the stated value.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _sum(xs: Column, f=lambda x: x) -> Column:
    return F.aggregate(xs, F.lit(0.0), lambda s, x: s + f(x))


def percentile(xs: Column, p: float) -> Column:
    """Linear-interpolated percentile, as the common numeric libraries define it."""
    ordered = F.array_sort(xs)
    at = (F.size(xs) - 1) * F.lit(p)
    low = F.floor(at).cast("int")
    a, b = F.element_at(ordered, low + 1), F.element_at(ordered, F.least(low + 2, F.size(xs)))
    return F.when(F.size(xs) > 0, a + (b - a) * (at - low))


def magnitude(xs: Column) -> Column:
    return F.transform(xs, lambda x: F.abs(x))


def rms(xs: Column) -> Column:
    return F.when(F.size(xs) > 0, F.sqrt(_sum(xs, lambda x: x * x) / F.size(xs))).otherwise(0.0)


def snr(xs: Column, high: float = 0.95, low: float = 0.05) -> Column:
    """20 log10 of the loud over the quiet percentile, not below 0; 0 if empty, 60 if the quiet one is 0."""
    loud, quiet = percentile(magnitude(xs), high), percentile(magnitude(xs), low)
    return F.when(F.size(xs) == 0, 0.0).when(quiet == 0, 60.0).otherwise(F.greatest(F.lit(0.0), F.coalesce(20 * F.log10(loud / quiet), F.lit(0.0))))


def snr_clamped(xs: Column) -> Column:
    """The 90/10 form within 0 to 60, a vanishing quiet percentile taken as the least double step."""
    loud, quiet = percentile(magnitude(xs), 0.9), percentile(magnitude(xs), 0.1)
    floor_ = F.when(quiet <= 0, 2.220446049250313e-16).otherwise(quiet)
    return F.when(F.size(xs) == 0, 0.0).otherwise(F.least(F.lit(60.0), F.greatest(F.lit(0.0), F.coalesce(20 * F.log10(loud / floor_), F.lit(0.0)))))


def dynamic_range(xs: Column) -> Column:
    loud, quiet = percentile(magnitude(xs), 0.95), percentile(magnitude(xs), 0.05)
    return F.when(F.size(xs) == 0, 0.0).when(quiet == 0, 60.0).otherwise(20 * F.log10(loud / quiet))


def share(xs: Column, test) -> Column:
    return F.when(F.size(xs) > 0, F.size(F.filter(xs, test)) / F.size(xs)).otherwise(0.0)


def clipping(xs: Column) -> Column:
    """Share of samples at 0.99 of full scale, or of the peak if that is over 0.9."""
    peak = F.array_max(magnitude(xs))
    least = F.when(peak > 0.9, 0.99 * peak).otherwise(0.99)
    return share(magnitude(xs), lambda x: x >= least)


def silence(xs: Column) -> Column:
    """Share of samples under a hundredth of the RMS (pure silence has none)."""
    least = 0.01 * rms(xs)
    return share(magnitude(xs), lambda x: x < least)


def dc_offset(xs: Column) -> Column:
    return F.when(F.size(xs) > 0, _sum(xs) / F.size(xs)).otherwise(0.0)


def frames(xs: Column, width: int, hop: int, end_exclusive: bool = False) -> Column:
    """Windows of `width` samples every `hop`, the last one only if its end may be the array's; empty if the array is too short."""
    last = F.size(xs) - width - int(end_exclusive)
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0)), F.lit(hop)), lambda i: F.slice(xs, i + 1, width))).otherwise(F.array().cast("array<array<double>>"))


def speech_ratio(energies: Column) -> Column:
    """Share of frame energies above their 30th percentile; null without frames."""
    least = percentile(energies, 0.3)
    return F.when(F.size(energies) > 0, F.size(F.filter(energies, lambda e: e > least)) / F.size(energies))


def energies(windows: Column) -> Column:
    return F.transform(windows, lambda w: _sum(w, lambda x: x * x))


def stability(levels: Column) -> Column:
    """1 - relative spread of window RMS levels, within 0 to 1; 1 under two windows, 0 for a zero mean."""
    mean = _sum(levels) / F.size(levels)
    spread = F.sqrt(_sum(levels, lambda x: (x - mean) * (x - mean)) / F.size(levels))
    return F.when(F.size(levels) < 2, 1.0).when(mean == 0, 0.0).otherwise(F.greatest(F.lit(0.0), 1 - F.least(F.lit(1.0), spread / mean)))


def snr_of_segment(xs: Column) -> Column:
    """The 95/5 form for a cut segment: silence counts as 0 before a quiet percentile of 0 counts as 60."""
    return F.when(rms(xs) == 0, 0.0).otherwise(snr(xs))


def snr_after_enhancement(xs: Column) -> Column:
    """The 95/5 form of an enhanced recording; 20 where it can't be measured (no samples, or samples that are null)."""
    return F.when(F.coalesce(F.size(xs), F.lit(0)) <= 0, 20.0).when(F.exists(xs, lambda x: x.isNull()), 20.0).otherwise(snr(xs))


def to_peak(xs: Column, peak: float = 0.95) -> Column:
    """Scaled so that the greatest magnitude is `peak`; silence stays."""
    top = F.array_max(magnitude(xs))
    return F.transform(xs, lambda x: F.when(top > 0, x * (F.lit(peak) / top)).otherwise(x))


def to_length(xs: Column, n: Column) -> Column:
    """Cut or padded with zeros to n samples."""
    return F.concat(F.slice(xs, 1, n), F.array_repeat(F.lit(0.0), F.greatest(F.lit(0), n - F.size(xs))))


def mono(left: Column, right: Column) -> Column:
    """Mean of two channels, as long as the shorter one."""
    n = F.least(F.size(left), F.size(right))
    return F.zip_with(F.slice(left, 1, n), F.slice(right, 1, n), lambda a, b: (a + b) / 2)


def joined_with_gaps(parts: Column, gap: int) -> Column:
    """Parts one after the other with `gap` zeros between them."""
    silence_ = F.array_repeat(F.lit(0.0), gap)
    return F.flatten(F.transform(parts, lambda p, i: F.when(i == 0, p).otherwise(F.concat(silence_, p))))


def clip_to_unit(xs: Column) -> Column:
    return F.transform(xs, lambda x: F.greatest(F.lit(-1.0), F.least(F.lit(1.0), x)))


def normalise(xs: Column, mode: str = "lufs", level: float = -23.0) -> Column:
    """Scale to a peak, an RMS of 0.1 or a loudness and clip to +-1; silence stays."""
    peak, power = F.array_max(magnitude(xs)), rms(xs)
    factor = {"peak": F.try_divide(F.lit(10 ** (level / 20)), peak), "rms": F.try_divide(F.lit(0.1), power), "lufs": F.try_divide(F.lit(10 ** ((level + 20) / 20)), power)}[mode]
    scale = F.coalesce(factor, F.lit(1.0))
    return clip_to_unit(F.transform(xs, lambda x: x * scale))


def fade(xs: Column, n_in: int, n_out: int) -> Column:
    """Linear fades at both ends, only if the array is longer than both."""
    size = F.size(xs)
    head = lambda i: F.when(i < n_in, i / F.lit(float(max(1, n_in - 1)))).otherwise(1.0)
    tail = lambda i: F.when(i >= size - n_out, (size - 1 - i) / F.lit(float(max(1, n_out - 1)))).otherwise(1.0)
    return F.when(size > n_in + n_out, F.transform(xs, lambda x, i: x * head(i) * tail(i))).otherwise(xs)


def soft_limit(xs: Column) -> Column:
    """Mean off, tanh compression to 0.95, clip."""
    mean = dc_offset(xs)
    return clip_to_unit(F.transform(xs, lambda x: F.tanh((x - mean) * 0.95) * 0.95))


def cosine_distance(u: Column, v: Column) -> Column:
    """1 - dot product, of unit vectors."""
    return 1 - F.aggregate(F.zip_with(u, v, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)


def unit(xs: Column) -> Column:
    norm = F.sqrt(_sum(xs, lambda x: x * x))
    return F.transform(xs, lambda x: F.try_divide(x, norm))
