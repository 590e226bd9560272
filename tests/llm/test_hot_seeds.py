"""Diagonals of seeds that repeat: those of a plain double loop, in time that doesn't grow with the product."""

import random
import time

import numpy as np
import pyarrow as pa

from voxloom.llm import decontaminate as D
from voxloom.llm.tokens import words_of


def plain(bench, hashed, first):
    """matches() by loops over every hit."""
    found = set()
    for mask, salt, keys, item, place, _ in bench.seeds:
        seeds = D._seed(hashed, mask, salt)
        where = {}
        for k, key in enumerate(keys.tolist()):
            where.setdefault(key, []).append((int(item[k]), int(place[k])))
        for p, key in enumerate(seeds.tolist()):
            d = int(np.searchsorted(first, p, "right")) - 1
            if p + len(mask) <= first[d + 1]:
                found |= {(d, i, p - int(first[d]) - at) for i, at in where.get(key, ())}
    return found


def test_same_matches(monkeypatch):
    rng = random.Random(6)
    items = [(k, " ".join(rng.choice("abc") for _ in range(rng.choice([4, 8, 20, 40])))) for k in range(12)]
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randrange(60))) for _ in range(15)] + [items[3][1], "a " * 30, ""]
    bench, words = D._Bench(items), words_of(pa.array(texts))
    hashed, first = words.hashes(), words.first
    seen = []
    monkeypatch.setattr(D, "_stretch", lambda same: (0, len(same), int(same.sum())))
    monkeypatch.setattr(D, "_longest", lambda same: (0, len(same), int(same.sum())))
    for expanded in (1, 7, 1 << 20):
        monkeypatch.setattr(D, "EXPANDED", expanded)
        seen.append(sorted(bench.matches(hashed, first)))
    assert seen[0] == seen[1] == seen[2] and len(seen[0]) > 20
    assert {m[:2] for m in seen[0]} <= {x[:2] for x in plain(bench, hashed, first)}


def test_one_word_over_and_over():
    bench = D._Bench([(1, "same " * 300)])
    words = words_of(pa.array(["same " * 8000]))
    began = time.time()
    got = list(bench.matches(words.hashes(), words.first))
    assert len(got) == 1 and got[0][4:] == (300, 300, 300) and time.time() - began < 8
