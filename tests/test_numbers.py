"""Numbers in messages against Python's own formatting."""

import random
import struct

import pytest
from pyspark.sql import functions as F

from voxloom.functions.numbers import fixed, percent
from voxloom.operators import quality


def some():
    rng = random.Random(3)
    out = [0.25, 1.95, 2.675, 0.35, 0.45, 0.5, 1.5, 2.5, 0.05, 0.005, 0.0005, 0.00048828125, 0.000488, -0.04, -0.0, 0.0, -2.675, 1e-300, 5e-324, 0.125, 0.375, 0.9999, 0.99951171875, 999999.95, 2.0**52 + 0.5, 2.0**53, 2.0**53 - 1, 2.0**62, 123456789012345.67, 1e15 + 0.125, float("nan"), float("inf"), -float("inf")]
    out += [rng.uniform(-50, 50) for _ in range(400)] + [rng.randrange(-4000, 4000) / 16 for _ in range(400)] + [rng.randrange(10**6) / 2000 for _ in range(200)]
    out += [rng.uniform(0, 1) * 2.0 ** -rng.randrange(30) for _ in range(300)]
    while len(out) < 2000:
        x = struct.unpack("d", struct.pack("Q", rng.getrandbits(64)))[0]
        if abs(x) < 2.0**62 or x != x:
            out.append(x)
    return out


@pytest.mark.parametrize("digits", [0, 1, 2, 3])
def test_fixed(spark, digits):
    values = some()
    table = spark.createDataFrame([(i, x) for i, x in enumerate(values)], "i int, x double")
    got = {r["i"]: (r["f"], r["p"]) for r in table.select("i", fixed(F.col("x"), digits).alias("f"), percent(F.col("x"), digits).alias("p")).collect()}
    wrong = [(x, got[i][0]) for i, x in enumerate(values) if got[i][0] != f"{x:.{digits}f}"]
    assert not wrong
    assert not [(x, got[i][1]) for i, x in enumerate(values) if abs(x) < 2.0**55 and got[i][1] != f"{x:.{digits}%}"]


def test_null_and_bad_digits(spark):
    assert spark.range(1).select(fixed(F.lit(None).cast("double"), 1).alias("x")).first()["x"] is None
    with pytest.raises(ValueError):
        fixed(F.lit(1.0), 4)


def test_rejection_messages(spark):
    rows = [(1.95, 20.0, 0.9, 5, True, 0.9), (15.25, 20.0, 0.9, 5, True, 0.9), (5.0, 11.95, 0.9, 5, True, 0.9), (5.0, 20.0, 0.125, 5, True, 0.9), (5.0, 20.0, 0.9, 2, True, 0.9), (5.0, 20.0, 0.9, 5, False, 0.9), (5.0, 20.0, 0.9, 5, True, 0.375), (5.0, 20.0, 0.9, 5, True, 0.9)]
    table = spark.createDataFrame(rows, "duration double, snr double, speech_ratio double, word_count int, complete boolean, quality double")
    got = [r["m"] for r in table.select(quality.reason_message().alias("m")).collect()]
    assert got == ["Too short: 1.9s < 2.0s", "Too long: 15.2s > 15.0s", "Low SNR: 11.9dB < 12.0dB", "Low speech ratio: 0.12 < 0.5", "Too few words: 2 < 3", "Incomplete words/phrases", "Low quality score: 0.38 < 0.5", None]


def test_issue_messages(spark):
    rows = [(0.995, 22050, 20.0, 0.0, 0.0, 20.0, 0.0), (31.005, 8000, 14.95, 0.01255, 0.50055, 9.95, -0.0625), (5.0, 16000, 15.0, 0.01, 0.5, 10.0, 0.01)]
    table = spark.createDataFrame(rows, "duration double, sample_rate int, snr double, clipping double, silence double, dynamic_range double, dc_offset double")
    got = [r["m"] for r in table.select(quality.issue_messages().alias("m")).collect()]
    want = []
    for d, r, s, c, q, g, o in rows:
        m = [f"Too short: {d:.2f}s (min: 1.0s)"] * (d < 1) + [f"Too long: {d:.2f}s (max: 30.0s)"] * (d > 30) + [f"Sample rate too low: {r}Hz (min: 16000Hz)"] * (r < 16000) + [f"Low SNR: {s:.1f}dB (min: 15dB)"] * (s < 15)
        m += [f"Clipping detected: {c:.2%} of samples"] * (c > 0.01) + [f"Too much silence: {q:.1%}"] * (q > 0.5) + [f"Low dynamic range: {g:.1f}dB"] * (g < 10) + [f"DC offset detected: {o:.3f}"] * (abs(o) > 0.01)
        want.append(m)
    assert got == want
