"""Collocations of two to three words, counted by suffix sorting.

Each word of a piece begins one suffix, truncated to MAX_WORDS words. Suffixes are shuffled by language and first
word, sorted in reverse lexicographic order, and one stack of open prefixes counts all their lengths: in that order a
prefix is complete as soon as a suffix without it comes. Counts of phrases with enough occurrences are then joined
with those of their parts for the cuts, their scores and the removal of phrases within longer ones.

Before the shuffle a task counts equal suffixes of each FLUSH bytes of text and writes, for each part, one row with
its suffixes as sorted, compressed text. A language has a part for every PART bytes of its texts. Prefixes of one or two
words that make up too much of a sample for one part are dealt out further by the word that follows; the sample (SEEN
bytes for each prefix that may be so frequent) only spreads the load and changes no count. At most MOST_HOT prefixes of
a length are kept apart. Their counts are sums over parts, all other counts are complete in one.
Words travel as text and are told apart by text, never by hashes, which only choose parts.

Words are `[^\\x20\\x09]+` of the pieces that `[.,;:!?\\x0A-\\x0D]` leaves, A-Z lower-cased. A phrase is its words joined
by blanks. Of a phrase cut after k words, left and right are counted within pieces like every phrase.

Edge cases: a null text has no words; a null lang counts as `und`, together with a lang of that name; rows that repeat an id
count each; an empty table, or one without a phrase frequent enough, gives an empty result; ties of score and count
go by the phrase's bytes; words may hold any sign but separators; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxloom.llm.tokens import Words, mix, slices, text_bytes
from voxloom.llm.workspace import Workspace

MAX_WORDS = 3
LEAST = 10
COVERED = 50
TOP = 2000
SPREAD = 64
SCALE = 1_000_000
FLUSH = 4 << 20
PART = 4 << 20
SEEN = 2000
LEAST_HOT = 4000
MOST_HOT = 1_000_000

# 1: between words, 2: between pieces
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = 2


_BETWEEN = re.compile(rb"[ \t.,;:!?\n\x0b\x0c\r]")
_NEXT_WORDS = re.compile(rb"(?:[ \t.,;:!?\n\x0b\x0c\r]*[^ \t.,;:!?\n\x0b\x0c\r]+){0,%d}" % (MAX_WORDS - 1))


@dataclass
class Suffixes:
    """Distinct suffixes in lexicographic order: rows of word numbers (0: no word), how often each was met, and the
    words from number 1 on, in the order of their bytes."""

    words: pa.Array
    rows: np.ndarray
    counts: np.ndarray

    def reversed(self) -> Suffixes:
        """Reverse lexicographic: a suffix comes after the longer ones that it begins."""
        return Suffixes(self.words, self.rows[::-1], self.counts[::-1])

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word, 0 for none; the same in every task."""
        ends = np.frombuffer(self.words.buffers()[1], np.int64)[self.words.offset : self.words.offset + len(self.words) + 1]
        data = self.words.buffers()[2]
        raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        return np.append(np.uint64(0), Words(raw, ends[:-1], ends[1:], np.array([0, len(self.words)]), ends[[0, -1]]).hashes())

    def lines(self, columns: int = MAX_WORDS) -> pa.Array:
        """The first words of each suffix, joined by blanks; a missing one is empty."""
        words = pa.concat_arrays([pa.array([b""], pa.large_binary()), self.words])
        return pc.binary_join_element_wise(*[words.take(pa.array(self.rows[:, k])) for k in range(columns)], pa.scalar(b" ", pa.large_binary()))


def _numbered(packed: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Numbers from 1 on of the words whose bytes stand one after the other, and the distinct words in order."""
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(packed)]).dictionary_encode()
    order = pc.sort_indices(coded.dictionary)
    rank = np.zeros(len(order), np.int64)
    rank[order.to_numpy()] = np.arange(1, len(order) + 1)
    return rank[coded.indices.to_numpy()], coded.dictionary.take(order)


def _counted(words: pa.Array, rows: np.ndarray, counts: np.ndarray | None) -> Suffixes:
    """Rows in order, equal ones made one."""
    base = len(words) + 1
    head = rows[:, 0] * base + rows[:, 1]
    if base >= 1 << 21:
        # places of the distinct first two words stand for them, so the key stays within 64 bits
        head = np.unique(head, return_inverse=True)[1]
    key = head * base + rows[:, 2]
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    if counts is None:
        total = np.diff(np.append(first, len(key)))
    else:
        total = np.add.reduceat(counts[order], first) if len(first) else np.zeros(0, np.int64)
    return Suffixes(words, rows[order[first]], total)


def suffixes_of(text: pa.Array, own: int | None = None) -> Suffixes:
    """The truncated suffixes of a slice of texts; own: of its bytes, those whose words begin a suffix (all if None)."""
    raw, offsets = text_bytes(text)
    # a piece ends with its text
    placed = np.full(len(raw) + len(offsets), ord("\n"), np.uint8)
    inner = np.ones(len(placed), bool)
    inner[offsets + np.arange(len(offsets))] = False
    placed[inner] = raw
    kind = _KIND[placed]
    word = kind == 0
    edges = np.flatnonzero(word[1:] != word[:-1]) + 1
    starts, ends = edges[::2], edges[1::2]
    numbers, words = _numbered(placed[word], ends - starts)
    piece = np.cumsum(kind == 2, dtype=np.int32)[starts]
    rows = np.zeros((len(numbers), MAX_WORDS), np.int64)
    for k in range(MAX_WORDS):
        upto = max(0, len(numbers) - k)
        rows[:upto, k] = np.where(piece[:upto] == piece[k:], numbers[k:], 0)
    # a byte stands before the text
    return _counted(words, rows if own is None else rows[starts <= own], None)


def windows(text: bytes, limit: int) -> Iterator[tuple[bytes, int]]:
    """A long text in parts of whole words, each with the next words that its last suffixes need, and the size of its own bytes."""
    at = 0
    while at < len(text):
        found = _BETWEEN.search(text, at + limit)
        end = found.start() if found else len(text)
        yield text[at : _NEXT_WORDS.match(text, end).end()], end - at
        at = end


def _pack(suffixes: Suffixes, heads: np.ndarray) -> tuple[list[bytes], list[bytes]]:
    """Compressed lines and counts of the runs of suffixes that begin at heads."""
    lines = pc.binary_join_element_wise(suffixes.lines(), pa.scalar(b"", pa.large_binary()), pa.scalar(b"\n", pa.large_binary()))
    ends = np.frombuffer(lines.buffers()[1], np.int64)
    text, counts, texts, numbers = memoryview(lines.buffers()[2]), suffixes.counts.astype("<i8"), [], []
    for a, b in zip(heads, np.append(heads[1:], len(suffixes.rows)), strict=True):
        texts.append(int(ends[b] - ends[a]).to_bytes(8, "little") + pa.compress(text[ends[a] : ends[b]], "zstd", asbytes=True))
        numbers.append(pa.compress(counts[a:b].tobytes(), "zstd", asbytes=True))
    return texts, numbers


def _unpack(texts: list[bytes], numbers: list[bytes]) -> Suffixes:
    """The suffixes of several packed rows, equal ones made one."""
    parts, counts = [], []
    for text, number in zip(texts, numbers, strict=True):
        parts.append(pa.decompress(text[8:], int.from_bytes(text[:8], "little"), "zstd", asbytes=True))
        counts.append(np.frombuffer(pa.decompress(number, 8 * parts[-1].count(b"\n"), "zstd", asbytes=True), "<i8"))
    raw = np.frombuffer(b"".join(parts), np.uint8)
    parts.clear()
    # a line holds MAX_WORDS words, empty ones too, so the signs after them tell words and lines apart
    word = (raw != 0x20) & (raw != 0x0A)
    sizes = np.diff(np.flatnonzero(~word), prepend=-1) - 1
    rows = np.zeros(len(sizes), np.int64)
    rows[sizes > 0], words = _numbered(raw[word], sizes[sizes > 0])
    return _counted(words, rows.reshape(-1, MAX_WORDS), np.concatenate(counts))


@dataclass
class Plan:
    """The number of parts of the languages that have several, and the hashes of the frequent prefixes of one and two words."""

    parts: dict[str, int]
    one: np.ndarray
    two: np.ndarray

    def parts_of(self, lang: str, hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
        h, parts = hashes[rows], self.parts.get(lang, 1)
        pair = pair_hash(h)
        one = np.isin(h[:, 0], self.one)
        state = np.where(one, pair, h[:, 0])
        # a frequent pair begins with a frequent word
        state = np.where(one & np.isin(pair, self.two), mix(pair ^ h[:, 2]), state)
        return (mix(state) % np.uint64(parts)).astype(np.int64)

    def partial(self, hashes: np.ndarray, rows: np.ndarray, words: int) -> np.ndarray:
        """Whether the count of each row's prefix of so many words is a part of it only."""
        h = hashes[rows]
        frequent = np.isin(h[:, 0], self.one) if words < MAX_WORDS else np.zeros(len(rows), bool)
        return frequent if words == 1 else frequent & np.isin(pair_hash(h), self.two)


def pair_hash(h: np.ndarray) -> np.ndarray:
    return mix(h[:, 0] * np.uint64(3) ^ h[:, 1])


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text")).where("text is not null")


def plan_parts(rows: DataFrame, part: int = PART) -> Plan:
    """Parts by the bytes of each language, frequent prefixes by the texts whose hash is low enough to make a sample."""
    sizes = rows.rollup("lang").agg(F.sum(F.octet_length("text")).alias("bytes"))
    # a row for each language of over one part, and one for all: as many as there are parts
    found = {r["lang"]: r["bytes"] for r in sizes.where(F.col("lang").isNull() | (F.col("bytes") > part)).collect()}
    total = found.pop(None, 0) or 0
    parts = {lang: -(-size // part) for lang, size in found.items()}
    hot, span = min(max(2 * sum(parts.values()), LEAST_HOT), MOST_HOT), 1 << 40
    drawn = rows.where(F.pmod(F.xxhash64("text", F.lit(11)), F.lit(span)) < min(span, span * SEEN * hot // max(1, total))).select("text").distinct()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column("text"), FLUSH):
                found = suffixes_of(batch.column("text").slice(a, b - a))
                h, total = found.hashes()[found.rows], int(found.counts.sum())
                size, key, n = [0], [np.zeros(1, np.uint64)], [total]
                for words, hashed in ((1, h[:, 0]), (2, pair_hash(h))):
                    own = found.rows[:, words - 1] > 0
                    keys, at = np.unique(hashed[own], return_inverse=True)
                    sums = np.bincount(at, found.counts[own], len(keys)).astype(np.int64)
                    # a prefix frequent in the sample is so in some slice
                    keep = sums * hot >= total
                    size += [words] * int(keep.sum())
                    key.append(keys[keep])
                    n += sums[keep].tolist()
                yield pa.RecordBatch.from_arrays([pa.array(size, pa.int32()), pa.array(np.concatenate(key).view(np.int64)), pa.array(n, pa.int64())], ["words", "h", "n"])

    counted = drawn.mapInArrow(count, "words int, h long, n long").groupBy("words", "h").agg(F.sum("n").alias("n"))
    # the sum of all comes first; of each length no more than `hot` prefixes can make 1 / hot
    most = counted.orderBy(F.desc("n"), "words", "h").limit(2 * hot + 1).toArrow()
    words, h, n = (most.column(c).to_numpy() for c in ("words", "h", "n"))
    frequent = n * hot >= (n[0] if len(n) else 0)
    hashes = lambda k: np.sort(h[frequent & (words == k)]).view(np.uint64)
    return Plan(parts, hashes(1), hashes(2))


def dealt_suffixes(rows: DataFrame, plan: Plan) -> DataFrame:
    """(part, lang, suffixes, numbers): a row for each part and language of every FLUSH bytes of text."""
    shared = rows.sparkSession.sparkContext.broadcast(plan)

    def flush(lang: str, found: Suffixes) -> Iterator[pa.RecordBatch]:
        if len(found.rows):
            part = shared.value.parts_of(lang, found.hashes(), found.rows)
            # stable: within a part suffixes stay in order
            order = np.argsort(part, kind="stable")
            part, found = part[order], Suffixes(found.words, found.rows[order], found.counts[order])
            heads = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
            texts, numbers = _pack(found, heads)
            yield pa.RecordBatch.from_arrays([pa.array(part[heads]), pa.array([lang] * len(heads)), pa.array(texts, pa.binary()), pa.array(numbers, pa.binary())], ["part", "lang", "suffixes", "numbers"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[pa.Array]] = {}
        size: dict[str, int] = {}
        for batch in batches:
            lang = batch.column("lang").dictionary_encode()
            for code, name in enumerate(lang.dictionary.to_pylist()):
                own = pc.cast(batch.column("text").filter(pc.equal(lang.indices, code)), pa.large_string())
                for a, b in slices(own, FLUSH):
                    text = own.slice(a, b - a)
                    much = pc.sum(pc.binary_length(text)).as_py()
                    if b - a == 1 and much > FLUSH:
                        for part, begun in windows(text[0].as_py().encode(), FLUSH):
                            yield from flush(name, suffixes_of(pa.array([part.decode()]), begun))
                        continue
                    held.setdefault(name, []).append(text)
                    size[name] = size.get(name, 0) + much
                    # many languages share the room of one flush
                    while sum(size.values()) >= FLUSH:
                        largest = max(size, key=size.get)
                        size.pop(largest)
                        yield from flush(largest, suffixes_of(pa.concat_arrays(held.pop(largest))))
        for name, texts in held.items():
            yield from flush(name, suffixes_of(pa.concat_arrays(texts)))

    return rows.mapInArrow(deal, "part long, lang string, suffixes binary, numbers binary")


def stack_counts(ordered: Suffixes) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(words, rows, counts) of the prefixes of each length, from suffixes in reverse lexicographic order.

    The stack holds the open prefix of each length. Where a suffix differs from the one before in its k-th word,
    the prefixes of k words and more are complete and leave the stack with the sum of what came since they entered.
    """
    rows, counts = ordered.rows, ordered.counts
    changed = np.zeros(len(rows), bool)
    changed[:1] = True
    for k in range(MAX_WORDS):
        changed[1:] |= rows[1:, k] != rows[:-1, k]
        turns = np.flatnonzero(changed)
        # runs of shorter suffixes end a prefix and enter none
        entered = rows[turns, k] > 0
        if entered.any():
            yield k + 1, rows[turns[entered]], np.add.reduceat(counts, turns)[entered]


def phrase_counts(dealt: DataFrame, plan: Plan, least: int) -> DataFrame:
    """(lang, phrase, words, f): all phrases of 1 to MAX_WORDS words with f >= least; words 0: all words of a language."""
    shared = dealt.sparkSession.sparkContext.broadcast(plan)

    def count(key: tuple, table: pa.Table) -> pa.Table:
        found = _unpack(table.column("suffixes").to_pylist(), table.column("numbers").to_pylist()).reversed()
        hashes = found.hashes()
        phrase, size, f = [pa.array([b""], pa.large_binary())], [0], [np.array([found.counts.sum()])]
        for words, rows, counts in stack_counts(found):
            keep = (counts >= least) | shared.value.partial(hashes, rows, words)
            phrase.append(Suffixes(found.words, rows[keep], counts[keep]).lines(words))
            size += [words] * int(keep.sum())
            f.append(counts[keep])
        return pa.table({"lang": pa.array([key[1].as_py()] * len(size), pa.string()), "phrase": pc.cast(pa.concat_arrays(phrase), pa.string()), "words": pa.array(size, pa.int32()), "f": pa.array(np.concatenate(f), pa.int64())})

    found = dealt.groupBy("part", "lang").applyInArrow(count, "lang string, phrase string, words int, f long")
    return found.groupBy("lang", "words", "phrase").agg(F.sum("f").alias("f")).where(f"f >= {least} or words = 0")


def _words(k: str) -> Column:
    """The first k words of phrase, the last -k if k is negative."""
    return F.expr(f"substring_index(phrase, ' ', {k})")


def scored_candidates(counts: DataFrame, covered: int) -> DataFrame:
    """(lang, phrase, words, a, l, r, score, inside) of all candidates; inside: whether a longer one covers it."""
    part = counts.where("words between 1 and 2").select("lang", F.col("phrase").alias("part"), F.col("f").alias("of_part"))
    candidates = counts.where("words >= 2").select("lang", "phrase", "words", F.col("f").alias("a"))
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.withColumn("left", _words("k")).withColumn("right", _words("k - words"))
    cuts = cuts.join(part.withColumnsRenamed({"part": "left", "of_part": "l"}), ["lang", "left"]).join(part.withColumnsRenamed({"part": "right", "of_part": "r"}), ["lang", "right"])
    # exact in 38 digits: a * a * SCALE holds for a below 10^16
    wide = lambda c: F.col(c).cast("decimal(16,0)")
    cuts = cuts.withColumn("top", (wide("a") * wide("a") * F.lit(SCALE)).cast("decimal(38,0)")).withColumn("under", wide("l") * wide("r"))
    cuts = cuts.withColumn("score", F.expr("cast(top div under as long)"))
    # the least score, then the least k
    best = cuts.groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    longer = candidates.where("words = 3").select("lang", "a", F.explode(F.array(_words("2"), _words("-2"))).alias("phrase"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    inside = F.coalesce(F.lit(100) * F.col("longer") >= F.lit(covered) * F.col("a"), F.lit(False))
    return best.join(longer, ["lang", "phrase"], "left").select("lang", "phrase", "words", "a", "cut.l", "cut.r", "cut.score", inside.alias("inside"))


def collocations(docs: DataFrame, least: int = LEAST, covered: int = COVERED, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first `top` of each language."""
    rows = _texts(docs)
    with Workspace(docs.sparkSession, "phrases") as ws:
        plan = plan_parts(rows)
        counts = ws.table(phrase_counts(dealt_suffixes(rows, plan), plan, least), "counts")
        found = ws.table(scored_candidates(counts, covered), "scored").where("not inside")
        order = [F.desc("score"), F.desc("a"), F.col("phrase")]
        # first among SPREAD shares of a language, so that the last sort meets SPREAD * top rows of it at most
        share = F.pmod(F.xxhash64("phrase"), F.lit(SPREAD))
        near = found.withColumn("share", share).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))).where(F.col("rank") <= top)
        ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
        total = counts.where("words = 0").select("lang", F.col("f").alias("n"))
        result = ranked.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
        return ws.keep(result)
