"""Language identification by nearest centroids.

Features are byte n-grams of GRAMS lengths over the case-folded text, in which every run of ASCII signs that are
no letters is one blank and a blank stands before and after; they are hashed to 2 ** BITS places. A text's vector
is (1 + log count) * idf, scaled to unit length. Every language has up to CLUSTERS centroids from spherical k-means,
so texts of one language that differ in kind (prose, lists, junk lines) need not share one mean. A text takes the
language of the centroid with the largest cosine; ties go to the lesser language.

Rejection is by distance: texts that clustering left out give, for each language and size class (power of two of
distinct grams), the cosine that all but REJECT of them reach; SLACK of that is the least a text needs. One whose best
cosine is less is far from everything learned: it keeps the nearest language and is marked rejected.

idf counts every learnable document. Clustering takes, for each language, the distinct texts whose hash is below a
threshold set to leave about SAMPLE of them, and runs as a task for each language; centroids alone reach the
driver: languages * CLUSTERS * 2 ** BITS single floats, whatever the number of documents.
Prediction is one pass over whole texts, without a shuffle; nothing but the text enters it.

Edge cases: a null text or one without a letter is `und` with score 0, not rejected; so is every text if nothing can be
learned; rows with a null lang, a null id or a text without a letter teach nothing; a lang may be any string, `und` too;
rows that repeat an id are predicted each, from their own text, equal texts alike; a language with one text has one
centroid; an empty table gives an empty one; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.llm.tokens import slices

# of 2 to 4 bytes
GRAMS = (2, 3, 4)
BITS = 15
CLUSTERS = 4
SAMPLE = 600
ROUNDS = 12
REJECT = 0.01
SLACK = 0.75
# of the sample, every FOLDth text is left out of clustering and sets the rejection distances
FOLD = 4
CLASSES = 24
LEAST_OF_CLASS = 20
SLICE = 1 << 20
UNKNOWN = "und"

_BLANK = np.uint8(32)
_KIND = np.array([_BLANK if k < 128 and not chr(k).isalpha() else k for k in range(256)], np.uint8)


@dataclass
class Features:
    """Distinct places of several texts and how often each was met: those of text k are [first[k], first[k + 1])."""

    places: np.ndarray
    counts: np.ndarray
    first: np.ndarray

    def sizes(self) -> np.ndarray:
        return np.diff(self.first)


def text_features(column: pa.Array) -> Features:
    """Grams of a slice of texts; a gram never spans two texts."""
    text = pc.utf8_lower(pc.fill_null(pc.cast(column, pa.large_string()), ""))
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
    data = text.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    sizes = np.diff(offsets)
    if len(sizes) == 1:
        return _features_of_one(raw)
    # every text gets a blank on either side
    placed = np.full(len(raw) + 2 * len(sizes), _BLANK)
    of = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes + 2)
    starts = np.cumsum(sizes + 2) - (sizes + 2)
    inner = np.ones(len(placed), bool)
    inner[starts] = inner[starts + sizes + 1] = False
    placed[inner] = _KIND[raw]
    blank = placed == _BLANK
    keep = np.ones(len(placed), bool)
    keep[1:] = ~(blank[1:] & blank[:-1] & (of[1:] == of[:-1]))
    # as narrow as the slice allows: short keys sort several times as fast
    wide = np.uint32 if len(sizes) < 1 << (32 - BITS) else np.uint64
    of = of[keep]
    texts = of.astype(wide) << wide(BITS)
    keys = [(texts[: len(place)] | place)[of[: len(place)] == of[n - 1 :]] for n, place in _places(placed[keep])]
    key = np.sort(np.concatenate(keys))
    head = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    counts = np.diff(np.append(head, len(key)))
    key = key[head].astype(np.int64)
    return Features(key & ((1 << BITS) - 1), counts, np.searchsorted(key >> BITS, np.arange(len(sizes) + 1)))


def _places(signs: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(n, hashed places of all n-grams) for each n of GRAMS."""
    signs = signs.astype(np.uint32)
    value = signs
    for n in range(2, max(GRAMS) + 1):
        value = (value[:-1] << np.uint32(8)) | signs[n - 1 :]
        if n in GRAMS:
            yield n, (value * np.uint32(0x9E3779B1 + 2 * n)) >> np.uint32(32 - BITS)


def _features_of_one(raw: np.ndarray) -> Features:
    """Grams of one text, however long: counted piece by piece, so only its bytes grow with it."""
    placed = np.concatenate([[_BLANK], _KIND[raw], [_BLANK]])
    blank = placed == _BLANK
    signs = placed[np.append(True, ~(blank[1:] & blank[:-1]))]
    seen = np.zeros(1 << BITS, np.int64)
    for at in range(0, len(signs), SLICE):
        for n, place in _places(signs[at : at + SLICE + max(GRAMS) - 1]):
            # a gram belongs to the piece it starts in
            seen += np.bincount(place[:SLICE], minlength=1 << BITS)
    places = np.flatnonzero(seen)
    return Features(places, seen[places], np.array([0, len(places)]))


def _weights(features: Features, idf: np.ndarray) -> np.ndarray:
    """Unit-length weights of the distinct places of each text."""
    raw = (1 + np.log(features.counts)) * idf[features.places]
    total = _sums(raw * raw, features.first)
    return (raw / np.repeat(np.sqrt(np.maximum(total, 1e-30)), features.sizes())).astype(np.float32)


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of each text's values; texts without one have 0. values: one row for each place."""
    padded = np.concatenate([values, np.zeros((1, *values.shape[1:]), values.dtype)])
    out = np.add.reduceat(padded, first[:-1], axis=0) if len(first) > 1 else np.zeros((0, *values.shape[1:]))
    out[first[:-1] == first[1:]] = 0
    return out


def size_class(distinct: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(distinct, 1)).astype(int), CLASSES - 1)


@dataclass
class LanguageModel:
    """Centroids as columns, the language of each, and by language and size class the least cosine that isn't rejected."""

    languages: list[str]
    of: np.ndarray
    centroids: np.ndarray
    idf: np.ndarray
    least: np.ndarray

    def cosines(self, features: Features) -> np.ndarray:
        """Largest cosine of each text with a centroid of each language."""
        weights = _weights(features, self.idf)
        out = np.zeros((len(features.first) - 1, len(self.languages)))
        heads = np.searchsorted(self.of, np.arange(len(self.languages)))
        for k, (a, b) in enumerate(zip(features.first[:-1], features.first[1:], strict=True)):
            if b > a:
                out[k] = np.maximum.reduceat(weights[a:b] @ self.centroids[features.places[a:b]], heads)
        return out

    def predict(self, features: Features) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, score, rejected) of each text."""
        cosines = self.cosines(features)
        best = cosines.argmax(axis=1)
        top = cosines[np.arange(len(best)), best]
        return [self.languages[k] for k in best], np.clip(top, 0, 1), top < self.least[best, size_class(features.sizes())]


def _fold() -> Column:
    return F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 3


def _typed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))


def _lettered() -> Column:
    return F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))


def learnable(docs: DataFrame) -> DataFrame:
    """(text, lang) of the rows that may teach."""
    return _typed(docs).where((_fold() != 1) & F.col("lang").isNotNull() & _lettered()).select("text", "lang")


def _document_frequencies(rows: DataFrame) -> tuple[np.ndarray, int]:
    """In how many documents each place was met, and the number of documents; a row for each place leaves a task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, documents = np.zeros((1 << BITS) + 1, np.int64), 0
        for batch in batches:
            text = batch.column("text")
            for a, b in slices(text, SLICE):
                seen[:-1] += np.bincount(text_features(text.slice(a, b - a)).places, minlength=1 << BITS)
                documents += b - a
        seen[-1] = documents
        places = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(places, pa.int32()), pa.array(seen[places], pa.int64())], ["place", "n"])

    total = rows.select("text").mapInArrow(count, "place int, n long").groupBy("place").agg(F.sum("n").alias("n")).collect()
    out = np.zeros((1 << BITS) + 1)
    for r in total:
        out[r["place"]] = r["n"]
    return out[:-1], int(out[-1])


def _sampled(rows: DataFrame, size: int) -> DataFrame:
    """(text, lang, h): of each language about `size` distinct texts, those with the least hashes."""
    span = 1 << 40
    drawn = rows.select("text", "lang", F.pmod(F.xxhash64("text", F.lit(13)), F.lit(span)).alias("h"))
    share = rows.groupBy("lang").agg(F.least(F.lit(span), F.ceil(F.lit(float(span)) * size / F.count("*"))).alias("below"))
    # a number for each language, of which the model itself sends everywhere CLUSTERS * 2 ** BITS
    return drawn.join(F.broadcast(share), "lang").where("h < below").dropDuplicates(["lang", "h"]).select("lang", "h", "text")


def _spherical_means(rows: np.ndarray, clusters: int) -> np.ndarray:
    """Unit centroids of unit rows. The first seed is the row nearest the mean, each further one the row farthest from all seeds."""
    seeds = [int((rows @ rows.sum(axis=0)).argmax())]
    near = rows @ rows[seeds[0]]
    while len(seeds) < clusters and near.min() < 0.999:
        seeds.append(int(near.argmin()))
        near = np.maximum(near, rows @ rows[seeds[-1]])
    centroids = rows[seeds]
    for _ in range(ROUNDS):
        owner = (rows @ centroids.T).argmax(axis=1)
        means = np.stack([rows[owner == k].sum(axis=0) if (owner == k).any() else centroids[k] for k in range(len(centroids))])
        means /= np.maximum(np.linalg.norm(means, axis=1, keepdims=True), 1e-30)
        moved = np.abs(means - centroids).max()
        centroids = means
        if moved < 1e-4:
            break
    return centroids


def _clustered(rows: DataFrame, idf: np.ndarray, clusters: int) -> list[tuple[str, np.ndarray, list[tuple[int, float]]]]:
    """(language, centroids, (size class, cosine) of the texts left out) of each language."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(idf)

    def fit(key: tuple, table: pa.Table) -> pa.Table:
        # in order of their hash, so a repeated task gives the same centroids
        text = table.column("text").combine_chunks().take(pc.sort_indices(table, sort_keys=[("h", "ascending"), ("text", "ascending")]))
        vectors, sizes = [], []
        for a, b in slices(text, SLICE):
            f = text_features(text.slice(a, b - a))
            w, dense = _weights(f, shared.value), np.zeros((b - a, 1 << BITS), np.float32)
            dense[np.repeat(np.arange(b - a), f.sizes()), f.places] = w
            vectors.append(dense)
            sizes.append(f.sizes())
        vectors, sizes = np.concatenate(vectors), np.concatenate(sizes)
        left_out = np.arange(len(vectors)) % FOLD == FOLD - 1
        own = vectors[~left_out]
        best = (vectors[left_out] @ _spherical_means(own, min(clusters, len(own))).T).max(axis=1) if left_out.any() else np.zeros(0)
        centroids = _spherical_means(vectors, min(clusters, len(vectors)))
        return pa.table({"lang": pa.array([key[0].as_py()]), "centroids": pa.array([centroids.astype(np.float32).tobytes()], pa.binary()), "classes": pa.array([size_class(sizes[left_out]).tolist()], pa.list_(pa.int32())), "cosines": pa.array([best.astype(float).tolist()], pa.list_(pa.float64()))})

    found = rows.groupBy("lang").applyInArrow(fit, "lang string, centroids binary, classes array<int>, cosines array<double>").collect()
    return sorted((r["lang"], np.frombuffer(r["centroids"], np.float32).reshape(-1, 1 << BITS), list(zip(r["classes"], r["cosines"], strict=True))) for r in found)


def _least_cosines(left_out: list[list[tuple[int, float]]], reject: float) -> np.ndarray:
    """By language and size class. A class with too few texts takes that of all languages; where these are too few too,
    that of the class below, as longer texts lie nearer to their centroids; 0 where there is none."""
    pooled = [pair for pairs in left_out for pair in pairs]
    out = np.zeros((len(left_out), CLASSES))
    for k, pairs in enumerate(left_out):
        for c in range(CLASSES):
            out[k, c] = out[k, c - 1] if c else 0
            for some in ([x for d, x in pairs if d == c], [x for d, x in pooled if d == c]):
                if len(some) >= LEAST_OF_CLASS:
                    out[k, c] = SLACK * np.quantile(some, reject)
                    break
    return out


def fit(docs: DataFrame, sample: int = SAMPLE, clusters: int = CLUSTERS, reject: float = REJECT) -> LanguageModel | None:
    """The model of docs (doc_id, text, lang); None if no row may teach."""
    rows = learnable(docs)
    seen, documents = _document_frequencies(rows)
    if not documents:
        return None
    idf = np.log((1 + documents) / (1 + seen)) + 1
    found = _clustered(_sampled(rows, sample), idf, clusters)
    of = np.concatenate([np.full(len(c), k) for k, (_, c, _) in enumerate(found)])
    return LanguageModel([lang for lang, _, _ in found], of, np.ascontiguousarray(np.concatenate([c for _, c, _ in found]).T), idf, _least_cosines([p for _, _, p in found], reject))


def predict_languages(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected) for every row of docs."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    held_out = F.coalesce(_fold() == 1, F.lit(False)).alias("held_out")
    if model is None:
        return rows.select("doc_id", held_out, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(False).alias("rejected"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("text")
            for a, b in slices(text, SLICE):
                names, score, rejected = shared.value.predict(text_features(text.slice(a, b - a)))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), batch.column("lettered").slice(a, b - a), pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())], ["doc_id", "lettered", "lang", "near", "far"])

    found = rows.select("doc_id", "text", _lettered().alias("lettered")).mapInArrow(predict, "doc_id long, lettered boolean, lang string, near double, far boolean")
    return found.select("doc_id", held_out, F.when(F.col("lettered"), F.col("lang")).otherwise(UNKNOWN).alias("lang_pred"), F.when(F.col("lettered"), F.col("near")).otherwise(0.0).alias("score"), (F.col("lettered") & F.col("far")).alias("rejected"))


def identify(docs: DataFrame, sample: int = SAMPLE, clusters: int = CLUSTERS) -> DataFrame:
    """Predictions for every row of docs by the model that docs teach."""
    return predict_languages(docs, fit(docs, sample, clusters))
