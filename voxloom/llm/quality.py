"""Quality classifier: support vectors over naive Bayes features.

Features are indicators of hashed n-grams: byte 4-grams of the text as written (case and marks
count) and word bigrams, the bigram of a word with itself being one feature for all words, and n-grams of one
repeated word (RUNS), each entered RUN_WEIGHT times, as they are few among thousands.
Indicators are scaled by the log-count ratio of the classes, each text to unit length; a linear
hinge-loss model is fitted by dual coordinate descent and mixed with the mean naive Bayes weight.
A logistic curve fitted on rows that training left out turns margins into scores of 0 to 1.

Training takes a bounded sample of labelled rows (MAX_TRAIN, those with the least hash of the
id; the bound is a parameter) and reaches the driver as packed feature ids only. Scoring runs
over every whole text, in one pass without a shuffle.

Edge cases: null and empty texts have no features and get the score of the intercept; labels that
are null or not 0 or 1 do not train; rows repeating an id are scored each (a repeated label row
trains once); if only one class is labelled or none, every score is the share of label 1, 0.5 without labels; more columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.llm.tokens import mix, slices, words_of

BITS = 18
MAX_TRAIN = 6000
THRESHOLD = 0.3
RUNS = (2, 3, 4, 5, 6, 8)
RUN_WEIGHT = 8
BLEND = 0.25


def text_features(column: pa.Array) -> Iterator[np.ndarray]:
    """Sorted distinct feature ids (int32) of each text."""
    column = pa.compute.fill_null(column.cast(pa.large_string()), "")
    words = words_of(column)
    hashed = words.hashes()
    shift = np.uint64(64 - BITS)
    pairs = mix(hashed[:-1] * np.uint64(3) ^ hashed[1:]) if len(hashed) else hashed
    same = hashed[:-1] == hashed[1:]
    if len(pairs):
        pairs = np.where(same, np.uint64(0x5A4E), pairs)
    runs = []
    for n in RUNS:
        run = _runs(same, n)
        places = np.flatnonzero(run)
        of = np.searchsorted(words.first, places, "right") - 1
        runs.append(np.unique(of[places + n <= words.first[of + 1]]) if len(places) else places)
    pairs = (mix(pairs) >> shift).astype(np.int32)
    offsets = words.texts
    raw = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    begin = np.frombuffer(column.buffers()[1], np.int64)[column.offset]
    raw = raw[begin : begin + offsets[-1]]
    raw = np.where((raw >= 48) & (raw <= 57), np.uint8(48), raw).astype(np.uint32)
    n = max(0, len(raw) - 3)
    grams = (raw[:n] << 24) | (raw[1 : n + 1] << 16) | (raw[2 : n + 2] << 8) | raw[3 : n + 3]
    grams = (mix(grams.astype(np.uint64)) >> shift).astype(np.int32)
    repeated = np.zeros((len(column), len(RUNS)), bool)
    for j, of in enumerate(runs):
        repeated[of, j] = True
    repeated = np.repeat(repeated, RUN_WEIGHT, axis=1)
    ids_of_runs = (mix(np.arange(1000, 1000 + repeated.shape[1], dtype=np.uint64)) >> shift).astype(np.int32)
    for k in range(len(column)):
        a, b = words.first[k], words.first[k + 1]
        yield np.unique(np.concatenate([grams[offsets[k] : max(offsets[k], offsets[k + 1] - 3)], pairs[a : max(a, b - 1)], ids_of_runs[repeated[k]]]))


def _runs(same: np.ndarray, n: int) -> np.ndarray:
    """Whether n equal words begin at each place, from whether neighbours are equal."""
    total = np.concatenate([[0], np.cumsum(same)])
    return total[n - 1 :] - total[: len(total) - n + 1] == n - 1 if len(total) >= n else np.zeros(0, bool)


@dataclass
class QualityModel:
    """Weight of each feature for an indicator text of unit length, intercept, and the logistic curve."""

    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def margins(self, features: list[np.ndarray]) -> np.ndarray:
        size = np.array([len(f) for f in features])
        total = np.add.reduceat(np.append(self.weights[np.concatenate(features)], 0.0), np.minimum(np.concatenate([[0], np.cumsum(size)[:-1]]), size.sum())) if size.sum() else np.zeros(len(size))
        return np.where(size > 0, total, 0.0) / np.sqrt(np.maximum(size, 1)) + self.bias

    def scores(self, features: list[np.ndarray]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margins(features) + self.offset, -35, 35)))


def held_out(column: str = "doc_id") -> F.Column:
    return F.crc32(F.encode(F.col(column).cast("string"), "UTF-8")) % 5 == 0


def training_rows(docs: DataFrame, labels: DataFrame, most: int = MAX_TRAIN) -> Iterator[tuple[bytes, int]]:
    """(packed feature ids, label) of at most `most` labelled rows outside the held-out fold, one after the other."""
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label")).where("doc_id is not null and label in (0, 1)").where(~held_out())
    chosen = rows.groupBy("doc_id").agg(F.min("label").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("text")
            for a, b in slices(text):
                packed = [f.tobytes() for f in text_features(text.slice(a, b - a))]
                yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary()), batch.column("label").slice(a, b - a), batch.column("doc_id").slice(a, b - a)], ["features", "label", "doc_id"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # at most MAX_TRAIN ids of 12 bytes: a bound known before the broadcast
    found = texts.join(F.broadcast(chosen), "doc_id").select("text", "label", "doc_id")
    got = found.mapInArrow(pack, "features binary, label int, doc_id long").dropDuplicates(["doc_id"]).orderBy(F.xxhash64("doc_id")).limit(most)
    # rows are sorted into one partition and read from it one by one: the driver's Python never holds them as objects
    return ((r["features"], r["label"]) for r in got.toLocalIterator())


def fit(rows: Iterable[tuple[bytes, int]], c: float = 1.0, epochs: int = 12, seed: int = 1) -> QualityModel:
    packed, ends, y = bytearray(), [], []
    for f, label in rows:
        packed += f
        ends.append(len(packed) // 4)
        y.append(1.0 if label else -1.0)
    flat, y = np.frombuffer(packed, np.int32), np.array(y)
    features = [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)]
    size = 1 << BITS
    if len(set(y.tolist())) < 2:
        share = 0.5 if not len(y) else float((y > 0).mean())
        share = min(max(share, 1e-6), 1 - 1e-6)
        return QualityModel(np.zeros(size), 0.0, 0.0, float(np.log(share / (1 - share))))
    rng = np.random.default_rng(seed)
    fold = rng.permutation(len(y)) % 5
    count = {s: np.ones(size) for s in (1.0, -1.0)}
    for f, s in zip(features, y, strict=True):
        count[s][f] += 1
    ratio = np.log(count[1.0] / count[1.0].sum()) - np.log(count[-1.0] / count[-1.0].sum())

    def scaled(i: int) -> np.ndarray:
        """Weights of a row's features, made anew at each step: those of all rows are twice as large as the rows."""
        return ratio[features[i]] / np.sqrt(max(1, len(features[i])))

    def descend(own: np.ndarray) -> tuple[np.ndarray, float]:
        """Dual coordinate descent for the hinge loss; classes weigh the same in total."""
        w, bias, alpha = np.zeros(size), 0.0, np.zeros(len(y))
        limit = {s: c * len(own) / (2 * max(1, (y[own] == s).sum())) for s in (1.0, -1.0)}
        norm = {i: float((v := scaled(i)) @ v) + 1.0 for i in own}
        for _ in range(epochs):
            moved = 0.0
            for i in rng.permutation(own):
                v = scaled(i)
                gap = y[i] * (w[features[i]] @ v + bias) - 1
                new = min(max(alpha[i] - gap / norm[i], 0.0), limit[y[i]])
                if (step := (new - alpha[i]) * y[i]) != 0:
                    w[features[i]] += step * v
                    bias += step
                    moved = max(moved, abs(step))
                    alpha[i] = new
            if moved < 1e-3:
                break
        mean = np.abs(w).mean()
        return ((1 - BLEND) * mean + BLEND * w) * ratio, bias * BLEND

    w, bias = descend(np.flatnonzero(fold != 0))
    part = QualityModel(w, bias, 1.0, 0.0)
    left = np.flatnonzero(fold == 0)
    x, t = part.margins([features[i] for i in left]), (y[left] > 0).astype(float)
    slope, offset = _logistic(x, t)
    w, bias = descend(np.arange(len(y)))
    return QualityModel(w, bias, slope, offset)


def _logistic(x: np.ndarray, t: np.ndarray) -> tuple[float, float]:
    """Newton steps for P(1) = 1 / (1 + exp(-(a x + b))) on smoothed targets, a >= 0."""
    n1, n0 = t.sum(), (1 - t).sum()
    t = np.where(t > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    scale = x.std() or 1.0
    a, b = 1.0, 0.0
    z = (x - x.mean()) / scale
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -35, 35)))
        g = np.array([((p - t) * z).sum() + 1e-3 * a, (p - t).sum() + 1e-3 * b])
        v = p * (1 - p)
        h = np.array([[(v * z * z).sum() + 1e-3, (v * z).sum()], [(v * z).sum(), v.sum() + 1e-3]])
        step = np.linalg.solve(h, g)
        a, b = a - np.clip(step[0], -2, 2), b - np.clip(step[1], -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    a = max(a, 0.0)
    return float(a / scale), float(b - a * x.mean() / scale)


def score_documents(docs: DataFrame, model: QualityModel, columns: list[str] | None = None, name: str = "quality_score") -> DataFrame:
    """The given columns of docs plus the score, under a name that docs must not have."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    kept = docs.select(*columns) if columns else docs

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, out = batch.column(batch.schema.get_field_index("text")), []
            for a, b in slices(text):
                out.append(shared.value.scores(list(text_features(text.slice(a, b - a)))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(out) if out else np.zeros(0))], [*batch.schema.names, name])

    return kept.mapInArrow(score, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields) + f", {name} double")


def classify(docs: DataFrame, labels: DataFrame, most: int = MAX_TRAIN) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of docs."""
    model = fit(training_rows(docs, labels, most))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = score_documents(rows, model)
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), F.col("quality_score").alias("score"), F.when(F.col("quality_score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
