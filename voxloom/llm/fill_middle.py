"""Fill-in-the-middle rewriting, with the cuts found by rank and select.

The bytes that begin a code point are the ones of a bitvector, packed eight to a byte over the texts of a
slice, with a directory: the ones before every block of BLOCK bits. rank counts ones before a place by one
directory entry and at most a block of packed bytes; n, the code points of a text, is the rank at its end less
the rank at its start. select finds a block by search in the directory, then the byte and the bit in it; on the
two ranks of a text's cuts it gives the byte offsets, so no text is decoded or walked by character.

Hashes: h1 to h4 are the first 8-digit groups of sha256 of ``1:`` and the decimal doc_id. They depend on the id
alone, so a task that runs again writes the same rows. One pass, no shuffle.

Edge cases: a null text is empty; an empty text is plain with n = 0; a text that holds a sentinel is plain; cuts may
fall together, so any of the three parts may be empty; a null doc_id hashes as ``1:``; rows that repeat an id are cut
by the same hashes, each in its own text; an empty table gives an empty one; further columns stay, whatever
their names, and the new ones take the first free names (`name`, `name_1`, ...).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.llm.names import free_name
from voxloom.llm.tokens import slices

PRE, SUF, MID = "<P>", "<S>", "<M>"
PLAIN_FROM = 90
SPM_BELOW = 20
# bits of a block: a directory entry for every 64 packed bytes
BLOCK = 512

_ONES = np.array([bin(k).count("1") for k in range(256)], np.uint8)
# place of the j-th one of every byte value, least bit first
_PLACE = np.array([([k for k in range(8) if v >> k & 1] + [8] * 8)[:8] for v in range(256)], np.uint8)


class Boundaries:
    """A packed bitvector with a block popcount directory."""

    def __init__(self, bits: np.ndarray):
        self.packed = np.packbits(bits, bitorder="little")
        per = BLOCK // 8
        self.packed = np.append(self.packed, np.zeros(-len(self.packed) % per, np.uint8))
        counts = _ONES[self.packed].reshape(-1, per)
        self.before = np.concatenate([[0], np.cumsum(counts.sum(axis=1, dtype=np.int64))])

    def rank(self, places: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        block, per = places // BLOCK, BLOCK // 8
        inside = places - block * BLOCK
        # the bytes of the place's block, those after the place masked off
        bytes_of = self._blocks(block)
        full = (inside // 8)[:, None]
        at = np.arange(per)[None, :]
        mask = np.where(at < full, 255, np.where(at == full, (1 << (inside % 8))[:, None] - 1, 0)).astype(np.uint8)
        return self.before[block] + _ONES[bytes_of & mask].sum(axis=1, dtype=np.int64)

    def select(self, ranks: np.ndarray) -> np.ndarray:
        """Place of the one that has so many ones before it; each rank is below the number of ones."""
        block = np.searchsorted(self.before, ranks, side="right") - 1
        left = ranks - self.before[block]
        sums = np.cumsum(_ONES[self._blocks(block)], axis=1, dtype=np.int64)
        byte = (sums <= left[:, None]).sum(axis=1)
        rows = np.arange(len(ranks))
        left = left - np.where(byte > 0, sums[rows, np.maximum(byte, 1) - 1], 0)
        return block * BLOCK + byte * 8 + _PLACE[self.packed[block * (BLOCK // 8) + byte], left]

    def _blocks(self, block: np.ndarray) -> np.ndarray:
        per = BLOCK // 8
        padded = self.packed if len(self.packed) else np.zeros(per, np.uint8)
        # a place at the very end has its block past the last one: no byte of it counts
        return padded.reshape(-1, per)[np.minimum(block, len(padded) // per - 1)] * (block < len(padded) // per)[:, None].astype(np.uint8)


def _cut(text: pa.Array, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, bytes, np.ndarray]:
    """(n, first cut, second cut) in code points, the slice's bytes, and (start, cut, cut, end) byte offsets of each text."""
    text = pc.fill_null(pc.cast(text, pa.large_string()), "")
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
    data = text.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    marks = Boundaries((raw & 0xC0) != 0x80)
    ranks = marks.rank(offsets)
    n = np.diff(ranks)
    a, b = h1 % (n + 1), h2 % (n + 1)
    low, high = np.minimum(a, b), np.maximum(a, b)
    total = ranks[-1]
    place = lambda r: np.where(r < total, marks.select(np.minimum(r, total - 1)), len(raw)) if total else np.zeros(len(r), np.int64)
    # a cut after all of a text's code points is its end
    edges = np.stack([offsets[:-1], np.where(low < n, place(ranks[:-1] + low), offsets[1:]), np.where(high < n, place(ranks[:-1] + high), offsets[1:]), offsets[1:]], axis=1)
    return n, low, high, raw.tobytes(), edges


def _rewrite(batches: Iterator[pa.RecordBatch], plain_from: int, spm_below: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text = batch.column("text")
        for start, stop in slices(text):
            rows = stop - start
            h = [batch.column(f"h{k}").slice(start, rows).to_numpy() for k in range(1, 5)]
            n, low, high, raw, edges = _cut(text.slice(start, rows), h[0], h[1])
            forms, outputs, pre, mid = [], [], [], []
            for k, (e0, e1, e2, e3) in enumerate(edges.tolist()):
                whole = raw[e0:e3]
                if not whole or h[2][k] % 100 >= plain_from or any(s in whole for s in (b"<P>", b"<S>", b"<M>")):
                    form, out = "plain", [whole]
                elif h[3][k] % 100 < spm_below:
                    form, out = "spm", [b"<S>", raw[e2:e3], b"<P>", raw[e0:e1], b"<M>", raw[e1:e2]]
                else:
                    form, out = "psm", [b"<P>", raw[e0:e1], b"<S>", raw[e2:e3], b"<M>", raw[e1:e2]]
                forms.append(form)
                outputs.append(b"".join(out))
                pre.append(None if form == "plain" else int(low[k]))
                mid.append(None if form == "plain" else int(high[k] - low[k]))
            made = [pa.array(n, pa.int64()), pa.array(forms, pa.string()), pa.array(pre, pa.int64()), pa.array(mid, pa.int64()), pa.array(outputs, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("row").slice(start, rows), *made], ["row", "n", "form", "prefix_chars", "middle_chars", "output"])


def fill_in_middle(docs: DataFrame, columns: list[str] | None = None, plain_from: int = PLAIN_FROM, spm_below: int = SPM_BELOW) -> DataFrame:
    """The given columns of docs (all, if none are given) with n, form, prefix_chars, middle_chars and output, the rewritten text, for every row."""
    columns = docs.columns if columns is None else columns
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    number = lambda k: F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}")
    every = F.struct(*[F.col(f"`{c}`") for c in columns])
    rows = docs.select(every.alias("row"), F.col("text").cast("string").alias("text"), *[number(k) for k in range(4)])
    made = rows.mapInArrow(lambda batches: _rewrite(batches, plain_from, spm_below), f"row {rows.schema['row'].dataType.simpleString()}, n long, form string, prefix_chars long, middle_chars long, output binary")
    taken, out = list(columns), []
    for c in ("n", "form", "prefix_chars", "middle_chars", "output"):
        taken.append(free_name(c, taken))
        out.append((F.col(c).cast("string") if c == "output" else F.col(c)).alias(taken[-1]))
    return made.select(*[F.col("row").getField(c).alias(c) for c in columns], *out)


def restored(output: Column, form: Column) -> Column:
    """The text an output was made of. Rewritten texts hold no sentinel, so its three are the only ones."""
    parts = F.split(output, "<[PSM]>", -1)
    part = lambda k: F.coalesce(F.get(parts, F.lit(k)), F.lit(""))
    return F.when(form == "psm", F.concat(part(1), part(3), part(2))).when(form == "spm", F.concat(part(2), part(3), part(1))).otherwise(output)


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256) for every row of docs."""
    out = fill_in_middle(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), ["doc_id"])
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"), sha(restored(F.col("output"), F.col("form"))).alias("restored_sha256"))
