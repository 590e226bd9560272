"""Language identification: features and cosines by brute force, held-out accuracy, rejection and edge cases."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from voxloom.llm import language_id
from voxloom.llm.language_id import BITS, GRAMS, fit, identify, predict_languages, text_features

SYLLABLES = {"aa": ["ka", "to", "mi"], "bb": ["shre", "lund", "ogt"], "cc": ["être", "çon", "où"], "дд": ["жо", "пра", "ний"]}


def plain_grams(text):
    """Counts of hashed places, by bytes of one text at a time."""
    signs = " " + "".join(c if ord(c) >= 128 or c.isalpha() else " " for c in (text or "").lower()) + " "
    while "  " in signs:
        signs = signs.replace("  ", " ")
    raw = signs.encode()
    out = Counter()
    for n in GRAMS:
        for i in range(len(raw) - n + 1):
            out[int.from_bytes(raw[i : i + n], "big") * (0x9E3779B1 + 2 * n) % 2**32 >> (32 - BITS)] += 1
    return out


def prose(rng, lang, words):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(words))


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(7)
    rows = [(i, prose(rng, lang, rng.randrange(1, 60)), lang) for i, lang in enumerate(rng.choices(list(SYLLABLES), [60, 20, 15, 5], k=700))]
    rows += [(1000, None, "aa"), (1001, "", "bb"), (1002, "12 + 3 !", "cc"), (1003, "katomi", None), (None, "shre lund", "bb"), (5, "où être", "cc"), (5, "катя", "дд")]
    return rows


def test_features():
    rng = random.Random(3)
    texts = [None, "", "a", "A1b", " a  b ", "12", "Ça va, où?", "ЖОПРА ний", "𝒳", *("".join(rng.choice("abÇ é1.\n") for _ in range(rng.randrange(90))) for _ in range(50))]
    together = text_features(pa.array(texts, pa.string()))
    for k, t in enumerate(texts):
        a, b = together.first[k], together.first[k + 1]
        assert dict(zip(together.places[a:b].tolist(), together.counts[a:b].tolist(), strict=True)) == plain_grams(t)
        alone = text_features(pa.array([t], pa.string()))
        assert dict(zip(alone.places.tolist(), alone.counts.tolist(), strict=True)) == plain_grams(t)


def test_features_of_a_long_text(monkeypatch):
    text = prose(random.Random(1), "cc", 400)
    monkeypatch.setattr(language_id, "SLICE", 64)
    alone = text_features(pa.array([text]))
    assert dict(zip(alone.places.tolist(), alone.counts.tolist(), strict=True)) == plain_grams(text)


def test_model_by_brute_force(spark, corpus):
    table = spark.createDataFrame(corpus, "doc_id long, text string, lang string")
    model = fit(table, sample=10**6)
    teach = [(t, lang) for i, t, lang in corpus if i is not None and lang is not None and t and any(c.isalpha() for c in t) and zlib.crc32(str(i).encode()) % 3 != 1]
    seen = Counter(p for t, _ in teach for p in plain_grams(t))
    assert model.languages == sorted({lang for _, lang in teach})
    for p in (*list(seen)[:50], 7):
        assert math.isclose(model.idf[p], math.log((1 + len(teach)) / (1 + seen[p])) + 1)
    assert np.allclose(np.linalg.norm(model.centroids, axis=0), 1, atol=1e-3)

    def scores(text):
        v = {p: (1 + math.log(c)) * model.idf[p] for p, c in plain_grams(text).items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        near = [sum(x * float(model.centroids[p, k]) for p, x in v.items()) / norm for k in range(model.centroids.shape[1])]
        return [max(x for x, o in zip(near, model.of, strict=True) if o == k) for k in range(len(model.languages))]

    out = predict_languages(table, model).join(table.select("doc_id", "text").distinct().groupBy("doc_id").agg(F.first("text").alias("text"), F.count("*").alias("c")).where("c = 1"), "doc_id").where("doc_id % 9 = 0")
    for r in out.collect():
        want = scores(r["text"])
        assert r["lang_pred"] == model.languages[int(np.argmax(want))]
        assert math.isclose(r["score"], min(1, max(want)), abs_tol=1e-4)


def test_accuracy_fold_and_edges(spark, corpus):
    table = spark.createDataFrame([(*r, 1.0, "x") for r in corpus], "doc_id long, text string, lang string, score double, rejected string")
    out = identify(table)
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score", "rejected"]
    got = out.collect()
    assert len(got) == len(corpus)
    truth = {i: lang for i, _, lang in corpus if i is not None and i < 700 and i != 5}
    right = [truth[r["doc_id"]] == r["lang_pred"] for r in got if r["doc_id"] in truth and r["held_out"]]
    assert len(right) > 150 and sum(right) >= 0.98 * len(right)
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 for r in got)
    none = {r["doc_id"]: r for r in got if r["doc_id"] in (1000, 1001, 1002)}
    assert all((r["lang_pred"], r["score"], r["rejected"]) == ("und", 0.0, False) for r in none.values())
    assert {r["lang_pred"] for r in got if r["doc_id"] is None} == {"bb"}
    assert {"cc", "дд"} <= {r["lang_pred"] for r in got if r["doc_id"] == 5}


def test_rejects_what_is_far_and_ignores_labels(spark, corpus):
    rng = random.Random(9)
    model = fit(spark.createDataFrame(corpus, "doc_id long, text string, lang string"))
    far = [(k, " ".join("".join(rng.choice("qxzwvj") for _ in range(6)) for _ in range(30))) for k in range(40)]
    near = [(100 + k, prose(rng, lang, 30)) for k, lang in enumerate([*SYLLABLES] * 25)]
    one, two = (predict_languages(spark.createDataFrame([(i + shift, t) for i, t in far + near], "doc_id long, text string"), model).collect() for shift in (0, 5000))
    assert sum(r["rejected"] for r in one if r["doc_id"] < 100) == 40
    assert sum(r["rejected"] for r in one if r["doc_id"] >= 100) <= 2
    key = lambda r, shift: (r["doc_id"] - shift, r["lang_pred"], r["score"])
    assert sorted(key(r, 0) for r in one) == sorted(key(r, 5000) for r in two)


def test_nothing_to_learn(spark):
    rows = [(1, "some text", None), (2, None, "aa"), (None, "text", "aa")]
    out = identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert {(r["lang_pred"], r["score"], r["rejected"]) for r in out} == {("und", 0.0, False)}
    assert identify(spark.createDataFrame([], "doc_id long, text string, lang string")).count() == 0
    one = identify(spark.createDataFrame([(1, "katomi", "aa"), (2, "shre", None)] * 2, "doc_id long, text string, lang string")).collect()
    assert {r["lang_pred"] for r in one} <= {"aa", "und"} and len(one) == 4
