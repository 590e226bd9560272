"""Language-model scoring with a probabilistic suffix tree.

Symbols are the UTF-8 bytes of the tokens, one space between tokens and a line feed as the end
token, so a text's probability is a product over bytes and every token, known or not, has one.
Contexts have up to DEPTH bytes and may reach over a token's border. A context becomes a state if
its next-symbol distribution diverges from its parent's by at least MIN_GAIN nats over all its
occurrences; all such states and their suffixes are kept, so the model grows with the training
texts. It stays a table, divided by the last two bytes of the contexts into blocks of about
BLOCK_ROWS rows; blocks are broadcast and scored one after the other. A distribution is smoothed by its parent's, weighted SMOOTHING, down to a
uniform one; the longest suffix state of the symbols before a symbol gives its probability.

Counts cover all training texts: tasks count (context, symbol) keys of all their texts, sums go by
the key. A second pass scores texts and looks frequent words up in a dictionary of bounded size;
the other words meet their counts in a join by word.

Edge cases: null and empty texts have the end token only; rows repeating an id are trained on and
scored each; a null id counts as held in and keeps its row; without training rows every symbol is uniform and
base_score follows its formula with N = V = 0; further columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.llm.tokens import mix
from voxloom.llm.workspace import Workspace

DEPTH = 5
MIN_COUNT = 8
MIN_GAIN = 12.0
BLOCK_ROWS = 1_000_000
SMOOTHING = 4.0
FREQUENT = 200_000
SCORE_BYTES = 4 << 20


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 10 == 0, F.lit(False))


def _tokens(text: str | None) -> list[bytes]:
    """Words with A-Z lowered: bytes.lower() and bytes.split() touch ASCII only."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def _stream(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the token streams, each after DEPTH line feeds and with its end symbol; the first predicted place of each and the end."""
    pad = b"\n" * DEPTH
    joined = [pad + b" ".join(t) + b"\n" for t in texts]
    ends = np.cumsum([len(j) for j in joined])
    return np.frombuffer(b"".join(joined), np.uint8), ends


def _keys(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every predicted place its last DEPTH symbols and the symbol, packed; and its text."""
    n = len(data) - DEPTH
    key = np.zeros(n, np.uint64)
    for k in range(DEPTH + 1):
        key = (key << np.uint64(8)) | data[k : k + n]
    starts = np.concatenate([[0], ends[:-1]])
    valid = np.ones(n, bool)
    for s in range(DEPTH):
        at = starts[1:] + s - DEPTH
        valid[at] = False
    size = ends - starts - DEPTH
    return key[valid], np.repeat(np.arange(len(ends)), size)


def count_symbols(docs: DataFrame) -> DataFrame:
    """(key, n): occurrences of each DEPTH + 1 packed symbols over all rows of docs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, pending = np.zeros(0, np.uint64), np.zeros(0, np.int64), []
        for batch in batches:
            texts, size = [], 0
            column = batch.column("text").to_pylist()
            for i, text in enumerate(column):
                texts.append(_tokens(text))
                size += len(text or "")
                if size >= SCORE_BYTES or i + 1 == len(column):
                    pending.append(np.unique(_keys(*_stream(texts))[0], return_counts=True))
                    texts, size = [], 0
            if len(pending) >= 8:
                keys, counts = _merged([(keys, counts), *pending])
                pending = []
            if len(keys) > 4_000_000:
                yield _batch(keys, counts)
                keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        keys, counts = _merged([(keys, counts), *pending])
        for at in range(0, len(keys), 500_000):
            yield _batch(keys[at : at + 500_000], counts[at : at + 500_000])

    def _batch(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], ["key", "n"])

    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts])
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


def smoothed_tree(ws: Workspace, grams: DataFrame) -> DataFrame:
    """(depth, ctx, sym, logp, logback) of every kept state and symbol seen after it; root included.

    logp is the smoothed natural log probability, logback the log weight the parent's distribution has in the state.
    """
    levels = []
    for d in range(DEPTH + 1):
        width = 8 * (d + 1)
        key = F.col("key").bitwiseAND(F.lit((1 << width) - 1))
        level = grams.groupBy(key.alias("key")).agg(F.sum("n").alias("n")).select(F.shiftright("key", 8).alias("ctx"), F.col("key").bitwiseAND(F.lit(255)).alias("sym"), "n")
        total = level.groupBy("ctx").agg(F.sum("n").alias("all"))
        level = level.join(total, "ctx")
        if d == 0:
            level = level.select("ctx", "sym", "n", "all", F.lit(1 / 256).alias("parent"))
        else:
            up = levels[-1].select(F.col("ctx").alias("up"), "sym", F.col("p").alias("parent"))
            level = level.withColumn("up", F.col("ctx").bitwiseAND(F.lit((1 << (width - 16)) - 1)) if d > 1 else F.lit(0).cast("long")).join(up, ["up", "sym"]).select("ctx", "sym", "n", "all", "parent")
        level = level.withColumn("p", (F.col("n") + SMOOTHING * F.col("parent")) / (F.col("all") + SMOOTHING))
        levels.append(ws.table(level, f"level-{d}"))
    gain = F.sum(F.col("n") * F.log(F.col("n") / F.col("all") / F.col("parent")))
    states = None
    for d in range(1, DEPTH + 1):
        tested = levels[d].where(F.col("all") >= MIN_COUNT).groupBy("ctx").agg(gain.alias("gain")).where(F.col("gain") >= MIN_GAIN).select(F.lit(d).alias("depth"), "ctx", "gain")
        states = tested if states is None else states.unionAll(tested)
    kept = ws.table(states, "states").select("depth", "ctx")
    closed = kept
    for d in range(1, DEPTH):
        closed = closed.unionAll(kept.where(F.col("depth") > d).select(F.lit(d).alias("depth"), F.col("ctx").bitwiseAND(F.lit((1 << (8 * d)) - 1)).alias("ctx")))
    closed = ws.table(closed.distinct(), "closed")
    out = None
    for d in range(DEPTH + 1):
        level = levels[d] if d == 0 else levels[d].join(closed.where(F.col("depth") == d).drop("depth"), "ctx", "left_semi")
        rows = level.select(F.lit(d).alias("depth"), "ctx", "sym", F.log("p").alias("logp"), F.log(F.lit(SMOOTHING) / (F.col("all") + SMOOTHING)).alias("logback"))
        out = rows if out is None else out.unionAll(rows)
    return ws.table(out, "tree")


def _group() -> F.Column:
    """The last two bytes of a context: all its suffixes but the root and those of one byte share them."""
    return F.col("ctx").bitwiseAND(F.lit(0xFFFF)).cast("int")


def blocks_of(tree: DataFrame) -> list[list[int]]:
    """Two-byte groups, packed in order into blocks of at most BLOCK_ROWS rows of the tree, or of one group."""
    sizes = {r["g"]: r["n"] for r in tree.where("depth >= 2").groupBy(_group().alias("g")).agg(F.count("*").alias("n")).collect()}
    blocks, size = [[]], 0
    for g in range(1 << 16):
        n = sizes.get(g, 0)
        if blocks[-1] and size + n > BLOCK_ROWS:
            blocks.append([])
            size = 0
        blocks[-1].append(g)
        size += n
    return blocks


def block_rows(tree: DataFrame, groups: list[int]) -> DataFrame:
    """The rows of the tree that keys whose context ends in one of the groups, which follow each other, can need."""
    return tree.where((F.col("depth") < 2) | _group().between(groups[0], groups[-1]))


class SuffixTree:
    """Kept states of a block as sorted tables over packed contexts."""

    def __init__(self, depth: np.ndarray, ctx: np.ndarray, sym: np.ndarray, logp: np.ndarray, logback: np.ndarray):
        self.grams, self.states = [], []
        for d in range(DEPTH + 1):
            own = depth == d
            keys = (ctx[own].astype(np.uint64) << np.uint64(8)) | sym[own].astype(np.uint64)
            order = np.argsort(keys)
            self.grams.append((keys[order], logp[own][order]))
            state, first = np.unique(ctx[own].astype(np.uint64), return_index=True)
            self.states.append((state, logback[own][first]))

    def log10(self, keys: np.ndarray) -> np.ndarray:
        """log10 probability of the last symbol of each packed key after the others."""
        out = np.zeros(len(keys))
        left = np.arange(len(keys))
        for d in range(DEPTH, -1, -1):
            if not len(left):
                break
            part = keys[left] & np.uint64((1 << (8 * (d + 1))) - 1)
            hit, value = _find(*self.grams[d], part)
            out[left[hit]] += value
            left, part = left[~hit], part[~hit]
            hit, value = _find(*self.states[d], part >> np.uint64(8))
            out[left[hit]] += value
        out[left] += np.log(1 / 256)
        return out / np.log(10)


def _find(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), bool), np.zeros(0)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    hit = keys[at] == wanted
    return hit, values[at[hit]]


class _Scorer:
    """Scores batches: distinct keys walk the tree once a batch, every place then reads its key's value."""

    BITS = 20

    def __init__(self, tree: SuffixTree, groups: list[int]):
        self.tree, self.low, self.high = tree, groups[0], groups[-1]
        self.key = np.full(1 << self.BITS, np.uint64(0xFFFFFFFFFFFFFFFF))
        self.value = np.zeros(1 << self.BITS)

    def scores(self, texts: list[list[bytes]]) -> np.ndarray:
        """For each text the sum over the places whose context is of this block."""
        keys, text = _keys(*_stream(texts))
        if self.low > 0 or self.high < 0xFFFF:
            group = (keys >> np.uint64(8)) & np.uint64(0xFFFF)
            own = (group >= self.low) & (group <= self.high)
            keys, text = keys[own], text[own]
        slot = (mix(keys) >> np.uint64(64 - self.BITS)).astype(np.int64)
        value = self.value[slot]
        miss = np.flatnonzero(self.key[slot] != keys)
        if len(miss):
            new, back = np.unique(keys[miss], return_inverse=True)
            scored = self.tree.log10(new)
            value[miss] = scored[back]
            at = (mix(new) >> np.uint64(64 - self.BITS)).astype(np.int64)
            # of keys that share a slot the last stays; key and value are set alike
            self.key[at], self.value[at] = new, scored
        return np.bincount(text, value, len(texts))


def _pieces(column: list[str | None]) -> Iterator[tuple[int, int, list[list[bytes]]]]:
    """(from, to, tokens of each text) over a batch, about SCORE_BYTES of text each."""
    at = 0
    while at < len(column):
        to, size, texts = at, 0, []
        while to < len(column) and size < SCORE_BYTES:
            texts.append(_tokens(column[to]))
            size += len(column[to] or "")
            to += 1
        yield at, to, texts
        at = to


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c) over all rows of docs; words as UTF-8 bytes."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                seen.update(_tokens(text))
                if len(seen) > 1_000_000:
                    yield from _rows(seen)
                    seen = Counter()
        yield from _rows(seen)

    def _rows(seen: Counter) -> Iterator[pa.RecordBatch]:
        words, counts = list(seen), list(seen.values())
        for at in range(0, len(words), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(words[at : at + 100_000], pa.binary()), pa.array(counts[at : at + 100_000], pa.int64())], ["word", "c"])

    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _least_frequent(words: DataFrame) -> int:
    """The least count at which at most FREQUENT words are left; from a histogram of a few hundred rows, not from sorted words."""
    place = F.floor(8 * F.log2("c")).cast("int")
    sizes = sorted(((r["p"], r["n"], r["least"]) for r in words.groupBy(place.alias("p")).agg(F.count("*").alias("n"), F.min("c").alias("least")).collect()), reverse=True)
    total, least = 0, 1 << 62
    for _, n, low in sizes:
        total += n
        if total > FREQUENT:
            break
        least = low
    return least


def score_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of docs."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    with Workspace(spark, "suffix") as ws:
        train = rows.where(~held_out())
        words = ws.table(word_counts(train), "words")
        texts = train.count()
        total = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
        n, v = total[0] + texts, total[1] + (1 if texts else 0)
        base = lambda c: float(np.log10((c + 0.1) / (n + 0.1 * (v + 1))))
        common = words.where(F.col("c") >= _least_frequent(words)).toArrow()
        frequent = {w: i for i, w in enumerate(common.column("word").to_pylist())}
        logs = np.array([base(c) for c in common.column("c").to_pylist()] + [0.0])
        grams = ws.table(count_symbols(train), "grams")
        tree = smoothed_tree(ws, grams)
        blocks = blocks_of(tree)
        # rows are numbered once; where several passes read them, the numbers must be the same in each
        rows = rows.withColumn("row", F.monotonically_increasing_id())
        if len(blocks) > 1:
            rows = ws.table(rows, "rows")

        def broadcast(groups: list[int], *more):
            t = block_rows(tree, groups).toArrow()
            return spark.sparkContext.broadcast((SuffixTree(*(t.column(c).to_numpy() for c in ("depth", "ctx", "sym", "logp", "logback"))), groups, *more))

        model = broadcast(blocks[0], frequent, logs)

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            states, groups, known, value = model.value
            scorer = _Scorer(states, groups)
            for batch in batches:
                ids, numbers = batch.column("doc_id").to_pylist(), batch.column("row").to_pylist()
                for at, to, texts in _pieces(batch.column("text").to_pylist()):
                    sums, counts, rare = [], [], []
                    for t in texts:
                        places = np.fromiter((known.get(w, -1) for w in t), np.int64, len(t))
                        other = Counter(t[i] for i in np.flatnonzero(places < 0))
                        sums.append(value[places].sum())
                        counts.append(len(t) - sum(other.values()))
                        rare.append([{"word": w, "tf": c} for w, c in other.items()])
                    kind = pa.list_(pa.struct([("word", pa.binary()), ("tf", pa.int64())]))
                    yield pa.RecordBatch.from_arrays([pa.array(ids[at:to], pa.int64()), pa.array([len(t) for t in texts], pa.int64()), pa.array(counts, pa.int64()), pa.array(sums, pa.float64()), pa.array(scorer.scores(texts)), pa.array(rare, kind), pa.array(numbers[at:to], pa.int64())], ["doc_id", "words", "known", "base", "score", "rare", "row"])

        scored = ws.table(rows.mapInArrow(score, "doc_id long, words long, known long, base double, score double, rare array<struct<word:binary,tf:long>>, row long"), "scored")
        model.destroy()
        parts = []
        for k, groups in enumerate(blocks[1:]):
            part = broadcast(groups)

            def add(batches: Iterator[pa.RecordBatch], part=part) -> Iterator[pa.RecordBatch]:
                scorer = _Scorer(*part.value)
                for batch in batches:
                    numbers = batch.column("row").to_pylist()
                    for at, to, texts in _pieces(batch.column("text").to_pylist()):
                        yield pa.RecordBatch.from_arrays([pa.array(numbers[at:to], pa.int64()), pa.array(scorer.scores(texts))], ["row", "part"])

            parts.append(ws.table(rows.select("row", "text").mapInArrow(add, "row long, part double"), f"part-{k}"))
            part.destroy()
        if parts:
            sums = reduce(DataFrame.unionAll, parts).groupBy("row").agg(F.sum("part").alias("part"))
            scored = ws.table(scored.join(sums, "row", "left").withColumn("score", F.col("score") + F.coalesce("part", F.lit(0.0))).drop("part"), "summed")
        asked = scored.select("row", F.explode("rare").alias("r")).select("row", "r.word", "r.tf")
        met = asked.join(words, "word", "left")
        c = F.coalesce(F.col("c"), F.lit(0))
        rare = met.groupBy("row").agg(
            F.sum(F.when(c > 0, F.col("tf")).otherwise(0)).alias("rare_known"),
            F.sum(F.col("tf") * F.log10((c + 0.1) / (n + 0.1 * (v + 1)))).alias("rare_base"),
        )
        zero = lambda name: F.coalesce(F.col(name), F.lit(0))
        return ws.keep(
            scored.drop("rare").join(rare, "row", "left").select(
                "doc_id",
                held_out().alias("held_out"),
                (F.col("words") + 1).alias("n_tokens"),
                (F.col("known") + zero("rare_known") + F.lit(1 if texts else 0)).cast("long").alias("n_known"),
                F.lit(n).cast("long").alias("train_tokens"),
                (F.col("base") + zero("rare_base") + F.lit(base(texts))).alias("base_score"),
                "score",
            )
        )
