"""Collocations against plain counting in Python, with hot prefixes, long texts, packing and edge cases."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from voxloom.llm import collocations
from voxloom.llm.collocations import Plan, Suffixes, _pack, _unpack, stack_counts, suffixes_of, windows


def plain_words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\n\x0b\x0c\r]", lowered)]


def plain_suffixes(texts):
    out = Counter()
    for t in texts:
        for w in plain_words(t):
            for i in range(len(w)):
                out[tuple(w[i : i + 3])] += 1
    return out


def plain_collocations(rows, least=10, covered=50, top=2000):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        for w in plain_words(text):
            n[lang or "und"] += len(w)
            for k in (1, 2, 3):
                for i in range(len(w) - k + 1):
                    f[lang or "und"][tuple(w[i : i + k])] += 1
    out = []
    for lang, counts in f.items():
        inside, found = defaultdict(int), []
        for p, a in counts.items():
            if len(p) == 3 and a >= least:
                for q in (p[:2], p[1:]):
                    inside[q] = max(inside[q], a)
        for p, a in counts.items():
            if len(p) < 2 or a < least or (len(p) == 2 and 100 * inside[p] >= covered * a and inside[p]):
                continue
            score, k = min((1000000 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        out += [(lang, r + 1, p.decode(), -a, l, q, n[lang], -s) for r, (s, a, p, l, q) in enumerate(sorted(found)[:top])]
    return sorted(out)


def text(rng, vocabulary, size):
    return "".join(rng.choice(vocabulary) + rng.choice([" ", " ", " ", " ", "  ", "\t", ". ", "\n", ",", "! "]) for _ in range(size))


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, 1, "x") for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string, n int, phrase string")


def as_dict(s: Suffixes):
    words = [b"", *s.words.to_pylist()]
    return {tuple(words[k].decode() for k in r if k): int(c) for r, c in zip(s.rows, s.counts, strict=True)}


def test_suffixes_and_packing():
    rng = random.Random(4)
    vocabulary = ["the", "of", "été", "x", "AbC", "a-b", "💡", "it's", "zz\x00z"]
    texts = [None, "", " ", ".", "one", "a.b", *(text(rng, vocabulary, rng.randrange(40)) for _ in range(60))]
    found = suffixes_of(pa.array(texts))
    assert as_dict(found) == plain_suffixes(texts)
    parts, numbers = _pack(found, np.array([0, 5, 17]))
    assert as_dict(_unpack(parts, numbers)) == plain_suffixes(texts)
    twice = _unpack(parts + parts[1:2], numbers + numbers[1:2])
    assert sum(as_dict(twice).values()) == sum(found.counts) + sum(found.counts[5:17])
    assert not len(suffixes_of(pa.array([None, ""])).rows)


def test_one_stack_counts_all_prefixes():
    rng = random.Random(5)
    texts = [text(rng, ["a", "b", "c", "ab"], 200)]
    counted, ordered = plain_suffixes(texts), suffixes_of(pa.array(texts)).reversed()
    keys = [tuple(r) for r in ordered.rows]
    assert keys == sorted(keys, reverse=True)
    words = [None, *ordered.words.to_pylist()]
    for size, rows, counts in stack_counts(ordered):
        got = {tuple(words[k].decode() for k in r[:size]): c for r, c in zip(rows, counts, strict=True)}
        want = Counter()
        for s, c in counted.items():
            if len(s) >= size:
                want[s[:size]] += c
        assert got == want and len(got) == len(rows)


@pytest.mark.parametrize("limit", [1, 7, 64, 10**6])
def test_windows_of_a_long_text(limit):
    long = text(random.Random(6), ["the", "of", "été", "x", "💡"], 300)
    total = Counter()
    for part, own in windows(long.encode(), limit):
        for s, c in as_dict(suffixes_of(pa.array([part.decode()]), own)).items():
            total[s] += c
    assert total == plain_suffixes([long])


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(8)
    common = ["the", "of", "and", "new", "york", "city", "stock", "exchange"]
    rows = [(rng.choice(["en", "en", "en", "fr", None, "und"]), text(rng, [*common, "New York City", "per se", *(f"w{rng.randrange(400)}" for _ in range(4))], rng.randrange(80))) for _ in range(500)]
    rows += [("en", "hot pair here " * 3000), ("fr", None), ("fr", ""), (None, "ça et là " * 40), ("de", "nur einmal"), *[("en", "a copy of this text, again")] * 30]
    return rows


def test_against_plain_counts(spark, corpus):
    got = sorted(tuple(r) for r in collocations.collocations(table(spark, corpus)).collect())
    assert got == plain_collocations(corpus) and {r[0] for r in got} == {"en", "fr", "und"}


def test_small_parts_flushes_and_hot_prefixes(spark, corpus, monkeypatch):
    for name, value in (("FLUSH", 2000), ("LEAST_HOT", 30), ("SEEN", 2000), ("TOP", 15), ("SPREAD", 4)):
        monkeypatch.setattr(collocations, name, value)
    monkeypatch.setattr(collocations.plan_parts, "__defaults__", (5000,))
    plan = collocations.plan_parts(collocations._texts(table(spark, corpus)))
    assert plan.parts["en"] > 5 and len(plan.one) and len(plan.two)
    got = sorted(tuple(r) for r in collocations.collocations(table(spark, corpus), top=15).collect())
    assert got == plain_collocations(corpus, top=15)
    assert sorted(tuple(r) for r in collocations.collocations(table(spark, corpus), least=3, covered=90).collect()) == plain_collocations(corpus, 3, 90)


def test_frequent_prefixes_are_spread():
    found = suffixes_of(pa.array([" ".join(f"the w{k}" for k in range(2000))]))
    hashes = found.hashes()
    the = hashes[1 + found.words.to_pylist().index(b"the")]
    rows = found.rows[hashes[found.rows[:, 0]] == the]
    none, one = np.zeros(0, np.uint64), np.array([the])
    assert len(set(Plan({"en": 50}, none, none).parts_of("en", hashes, rows))) == 1
    assert len(set(Plan({"en": 50}, one, none).parts_of("en", hashes, rows))) > 40
    assert set(Plan({"en": 50}, one, none).parts_of("fr", hashes, rows)) == {0}


def test_scores_beyond_64_bits(spark):
    a, l, r = 3 * 10**12, 5 * 10**12, 4 * 10**12 + 1
    counts = spark.createDataFrame([("en", 1, "x", l), ("en", 1, "y", r), ("en", 2, "x y", a), ("en", 0, "", 10**13)], "lang string, words int, phrase string, f long")
    row = collocations.scored_candidates(counts, 50).first()
    assert row["score"] == 1000000 * a * a // (l * r)


def test_nothing_to_count(spark):
    assert collocations.collocations(table(spark, [])).count() == 0
    assert collocations.collocations(table(spark, [("en", None), (None, ""), ("en", "only a few words")])).count() == 0
