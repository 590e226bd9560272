"""Benchmark decontamination with spaced seeds.

A fixed mask reads some token positions of a span and ignores the others, so a substituted token
at an ignored position leaves the seed hash whole; several masks make a miss unlikely. Seed hashes
of the documents join those of the benchmark; every hit fixes a diagonal (document position minus
item position), along which tokens are compared and the best stretch with at least `identity`
equal tokens is measured: the one of best sum or, if that is too short, the longest one.

The benchmark side goes out in blocks of bounded tokens, so any benchmark size works; the documents
are never shuffled. Counts and decisions use whole texts.

Edge cases: null and empty texts and items match nothing; an item shorter than
MIN_TOKENS is sought as a whole, by masks of its length of which one fits however the substitutions fall; repeated rows give their own results (a document row each, item rows with equal texts
each their own match); ties between diagonals go to the smallest position; empty tables give no matches.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.llm.tokens import mix, slices, words_of

# fixed values: the spaced seeds, 1 = token read, 0 = token ignored
MASKS = ("1101100101101", "111010010111", "11100101011", "110110111", "11101101", "1110111", "11011011")
MIN_TOKENS = 13
IDENTITY = 0.8
BLOCK_TOKENS = 1_000_000
SCHEMA = "doc_id long, item_id long, doc_start int, item_start int, overlap int, matched int, item_tokens int"


def _seed(hashed: np.ndarray, mask: str, salt: int) -> np.ndarray:
    n = max(0, len(hashed) - len(mask) + 1)
    out = np.full(n, salt, np.uint64)
    for k, bit in enumerate(mask):
        if bit == "1":
            out = mix(out ^ hashed[k : k + n])
    return out


def _whole_masks(n: int) -> list[str]:
    """Masks of n tokens: positions go in turn to two groups more than substitutions are allowed, each mask ignores as many groups as there are substitutions."""
    least = next(k for k in range(n + 1) if k >= IDENTITY * n)
    groups = min(n - least + 2, n)
    return ["".join("0" if k % groups in gone else "1" for k in range(n)) for gone in combinations(range(groups), n - least)]


# hits of seeds that are written out at once
EXPANDED = 1 << 20


class _Bench:
    """A block of items with its seed hashes, sorted, behind a bitmap filter."""

    def __init__(self, items: list[tuple[int, str]]):
        texts = pa.array([t for _, t in items], pa.large_string())
        words = words_of(texts)
        hashed, first = words.hashes(), words.first
        self.ids = [i for i, _ in items]
        self.tokens = [hashed[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]
        self.seeds: list[tuple[str, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        short = sorted({len(t) for t in self.tokens if 0 < len(t) < MIN_TOKENS})
        for salt, mask in enumerate([*MASKS, *(m for n in short for m in _whole_masks(n))]):
            keys, item, place = [], [], []
            for k, t in enumerate(self.tokens):
                if len(t) >= MIN_TOKENS if salt < len(MASKS) else len(t) == len(mask):
                    got = _seed(t, mask, salt)
                    keys.append(got)
                    item.append(np.full(len(got), k))
                    place.append(np.arange(len(got)))
            keys, item, place = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (keys, item, place))
            order = np.argsort(keys.astype(np.uint64), kind="stable")
            keys = keys.astype(np.uint64)[order]
            bitmap = np.zeros(1 << 22, bool)
            bitmap[keys >> np.uint64(42)] = True
            if len(keys):
                self.seeds.append((mask, salt, keys, item[order], place[order], bitmap))

    def matches(self, hashed: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, int, int, int, int, int]]:
        """(document, item, document start, item start, overlap, matched, item length) for every verified pair."""
        # a diagonal is a document, an item and the shift between them, packed into one number
        items, longest = max(1, len(self.tokens)), max((len(t) for t in self.tokens), default=0)
        span = longest + int(np.diff(first).max(initial=0)) + 1
        found = np.zeros(0, np.int64)
        for mask, salt, keys, item, place, bitmap in self.seeds:
            seeds = _seed(hashed, mask, salt)
            at = np.flatnonzero(bitmap[seeds >> np.uint64(42)])
            lo, hi = np.searchsorted(keys, seeds[at], "left"), np.searchsorted(keys, seeds[at], "right")
            real = hi > lo
            at, lo, hi = at[real], lo[real], hi[real]
            doc = np.searchsorted(first, at, "right") - 1
            whole = at + len(mask) <= first[doc + 1]
            at, doc, lo, many = at[whole], doc[whole], lo[whole], (hi - lo)[whole]
            ends = np.cumsum(many)
            begin = 0
            # equal seeds meet many times over on few diagonals, so they are made one as they come
            while begin < len(at):
                stop = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + EXPANDED, "right")))
                n = many[begin:stop]
                j = np.repeat(lo[begin:stop], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                shift = np.repeat(at[begin:stop] - first[doc[begin:stop]], n) - place[j]
                found = np.union1d(found, (np.repeat(doc[begin:stop], n) * items + item[j]) * span + shift + longest)
                begin = stop
        best: dict[tuple[int, int], tuple] = {}
        for pair, shift in zip((found // span).tolist(), (found % span - longest).tolist(), strict=True):
            d, i = divmod(pair, items)
            doc, it = hashed[first[d] : first[d + 1]], self.tokens[i]
            a, b = max(0, -shift), min(len(it), len(doc) - shift)
            same = doc[a + shift : b + shift] == it[a:b]
            least = min(MIN_TOKENS, len(it))
            start, length, equal = _stretch(same)
            if length < least:
                start, length, equal = _longest(same)
            if length >= least and ((d, i) not in best or equal > best[d, i][5]):
                best[d, i] = (d, i, a + start + shift, a + start, length, equal, len(it))
        yield from best.values()


def _stretch(equal: np.ndarray) -> tuple[int, int, int]:
    """(start, length, equal tokens) of the stretch with the best sum, an equal token counting +1 and another -IDENTITY/(1-IDENTITY)."""
    gain = np.where(equal, 1.0, -IDENTITY / (1 - IDENTITY))
    total = np.concatenate([[0.0], np.cumsum(gain)])
    least = np.minimum.accumulate(total)
    end = int(np.argmax(total - least))
    start = int(np.flatnonzero(total[: end + 1] == least[end])[-1])
    return start, end - start, int(equal[start:end].sum())


def _longest(equal: np.ndarray) -> tuple[int, int, int]:
    """(start, length, equal tokens) of the longest stretch of which at least IDENTITY are equal, the first of them."""
    part = round(IDENTITY * 100)
    total = np.concatenate([[0], np.cumsum(np.where(equal, 100 - part, -part))])
    # for every end the first place where the running sum was as low: lows only fall, so they are searched
    low = np.minimum.accumulate(total)
    first = np.searchsorted(-low, -total, "left")
    length = np.maximum(np.arange(len(total)) - first, 0)
    end = int(np.argmax(length))
    start = end - int(length[end])
    return start, end - start, int(equal[start:end].sum())


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """Items in blocks of at most BLOCK_TOKENS words (an item at least), streamed through the driver one block at a time."""
    block, size = [], 0
    for r in benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).orderBy("item_id", "text").toLocalIterator():
        n = len(r["text"].split())
        if block and size + n > BLOCK_TOKENS:
            yield block
            block, size = [], 0
        block.append((r["item_id"], r["text"]))
        size += n
    if block:
        yield block


def find_overlaps(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id") -> DataFrame:
    """(doc_id, item_id, doc_start, item_start, overlap, matched, item_tokens): verified overlaps, the best for each pair.

    overlap is the stretch's length in tokens, matched its equal ones.
    """
    parts = []
    for block in _blocks(benchmark):
        bench = docs.sparkSession.sparkContext.broadcast(block)

        def scan(batches: Iterator[pa.RecordBatch], bench=bench) -> Iterator[pa.RecordBatch]:
            index = _Bench(bench.value)
            for batch in batches:
                ids, rows = batch.column("doc_id").to_pylist(), []
                for a, b in slices(batch.column("text")):
                    words = words_of(batch.column("text").slice(a, b - a))
                    rows += [(ids[a + m[0]], index.ids[m[1]], *m[2:]) for m in index.matches(words.hashes(), words.first)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if k < 2 else pa.int32()) for k, c in enumerate(zip(*rows, strict=True))], [f.split()[0] for f in SCHEMA.split(", ")])

        parts.append(docs.select(F.col(key).cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(scan, SCHEMA))
    if not parts:
        return docs.sparkSession.createDataFrame([], SCHEMA)
    return reduce(DataFrame.unionAll, parts)


def remove_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without rows that overlap an item; order, columns and other rows as they were."""
    for block in _blocks(benchmark):
        bench = docs.sparkSession.sparkContext.broadcast(block)

        def keep(batches: Iterator[pa.RecordBatch], bench=bench) -> Iterator[pa.RecordBatch]:
            index = _Bench(bench.value)
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                text = batch.column(batch.schema.get_field_index("text"))
                for a, b in slices(text):
                    words = words_of(text.slice(a, b - a))
                    for m in index.matches(words.hashes(), words.first):
                        clean[a + m[0]] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs
