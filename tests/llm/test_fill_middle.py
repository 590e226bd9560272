"""Fill-in-the-middle against slices of Python strings, rank and select against plain counting."""

import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from voxloom.llm.fill_middle import Boundaries, digests, fill_in_middle, restored

TEXTS = [None, "", "a", "ab", "naïve ✓ 𝒳𝒴 end", "<P>", "has <S> inside", "x<M>", "<P", "<", "ends with <P", "M>", "\n\n", "𝒳", "word " * 40000, "é𝒳" * 30000, "tie"]


def expected(doc_id, text):
    t = text or ""
    x = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(x[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(t)
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = t[:low], t[low:high], t[high:]
    if not t or any(s in t for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, t
    if h[3] % 100 < 20:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def test_rank_and_select():
    rng = np.random.default_rng(5)
    for size in (0, 1, 7, 8, 511, 512, 513, 5000):
        for share in (0.0, 0.1, 0.9, 1.0):
            bits = rng.random(size) < share
            marks = Boundaries(bits)
            assert marks.rank(np.arange(size + 1)).tolist() == np.concatenate([[0], np.cumsum(bits)]).tolist()
            ones = np.flatnonzero(bits)
            if len(ones):
                assert marks.select(np.arange(len(ones))).tolist() == ones.tolist()


def test_against_strings(spark):
    rng = random.Random(2)
    some = ["".join(rng.choice("ab é✓𝒳<>PSM\n") for _ in range(rng.randrange(60))) for _ in range(400)]
    rows = list(enumerate(TEXTS + some)) + [(None, "no id"), (3, "repeated id"), (3, "ab"), (-7, "negative id")]
    table = spark.createDataFrame([(i, t, 1.5, "f", [1, 2]) for i, t in rows], "doc_id long, text string, n double, Output string, row array<int>")
    out = fill_in_middle(table)
    assert out.columns == ["doc_id", "text", "n", "Output", "row", "n_1", "form", "prefix_chars", "middle_chars", "output_1"]
    got = sorted(((r["doc_id"], r["text"], r["n_1"], r["form"], r["prefix_chars"], r["middle_chars"], r["output_1"]) for r in out.collect()), key=repr)
    assert got == sorted(((i, t, *expected(i, t)) for i, t in rows), key=repr)
    assert {f for _, _, _, f, *_ in got} == {"plain", "psm", "spm"}
    back = out.select("text", restored(F.col("output_1"), F.col("form")).alias("back")).where("coalesce(text, '') <> back")
    assert back.count() == 0
    assert all(r["n"] == 1.5 and r["Output"] == "f" and r["row"] == [1, 2] for r in out.limit(5).collect())


def test_digests(spark):
    table = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id int, text string")
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    got = {r["doc_id"]: tuple(r)[1:] for r in digests(table).collect()}
    for i, t in enumerate(TEXTS):
        n, form, pre, mid, out = expected(i, t)
        assert got[i] == (n, form, pre, mid, sha(out), sha(t or ""))
    assert digests(table.where("false")).count() == 0

