"""Hits over joined texts against re.findall on the whole text, in pieces of many sizes."""

import random
import re

import pytest
from pyspark.sql import functions as F

from voxloom.operators import joined_hits as J

PATTERNS = [r"\bab\b", r"aa", r"a{1,3}b?", r"ab?a", r"b a", r"\bworld.*best\b", r"a.*b", r"ab.*\bca.*b", r"\bstones?\b", r"pok[eé]mon", r"a\s?b", r"(?:ab|ba)c?"]


def whole(texts, pattern):
    return len(re.findall(pattern, " ".join(t.lower() for t in texts), re.IGNORECASE))


@pytest.mark.parametrize("size", [1, 30, 61, 200, 10**6])
def test_pieces_and_seams(size):
    scanners = [J.Scanner.of(p) for p in PATTERNS]
    for seed in range(60):
        rng = random.Random(seed)
        words = ["ab", "a", "aab", "ba", "c", "world", "best", "stone", "stones", "pokémon", "aaaa", "abaaba", ""]
        texts = [rng.choice([" ", " ", "\n", ""]).join(rng.choice(words) for _ in range(rng.randrange(12))) for _ in range(rng.randrange(1, 40))]
        if rng.random() < 0.3:
            texts = ["".join(rng.choice("ab") for _ in range(rng.randrange(400)))] + texts
        joined = "".join(" " + t.lower() for t in texts)
        pieces = [J._summed(joined[k : k + size], scanners) for k in range(0, len(joined), size)]
        got = J._folded(pieces, scanners)
        assert got == [whole(texts, p) for p in PATTERNS], (seed, texts)


def test_refused_patterns():
    for bad in (r"a+b", r"a*", r"^ab", r"(?=a)b", r"a.*b?c", r".*", r"(a)\1", r"a\Z", r"x(.*)y"):
        with pytest.raises(ValueError):
            J.Scanner.of(bad)


@pytest.mark.parametrize("piece", [50, 1 << 20])
def test_joined_hits(spark, piece):
    rng = random.Random(5)
    rows = [(rng.choice(["hot", "hot", "hot", "x", None]), i, rng.choice([None, "The world", "is the BEST", "ab", "a b\n", "aa", "a", "", "stones ab"])) for i in range(900)]
    table = spark.createDataFrame(rows, "cluster string, ordinal int, text string").repartition(7)
    got = {r["cluster"]: list(r["hits"]) for r in J.joined_hits(table, PATTERNS, "cluster", ["ordinal"], piece=piece).collect()}
    want = {c: [whole([t or "" for k, _, t in rows if k == c], p) for p in PATTERNS] for c in {r[0] for r in rows}}
    assert got == want
    assert J.joined_hits(table.where("false"), PATTERNS, "cluster", ["ordinal"]).count() == 0


def test_joined_scores(spark):
    table = spark.createDataFrame([("a", 1, "gotta"), ("a", 2, "catch em"), ("b", 1, "no")], "speaker string, ordinal int, text string")
    themes = spark.createDataFrame([("a", 2, 0, 0.25), ("b", 1, 1, 1.0)], "speaker string, segments long, theme long, theme_ratio double")
    out = J.joined_scores(table, [("ash", 0, r"\bgotta catch\b"), ("ash", 1, "em"), ("brock", 2, "no")], themes, "speaker", ["ordinal"])
    assert {(r["speaker"], r["label"]): (r["hits"], r["score"]) for r in out.collect()} == {("a", "ash"): (2, 0.5), ("a", "brock"): (0, 0.0), ("b", "ash"): (0, 0.0), ("b", "brock"): (1, 0.0)}
    assert out.select(F.sum("hits")).first()[0] == 3
