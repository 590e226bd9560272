"""Pattern hits in the texts of a cluster joined by blanks, counted without joining them into one value.

Rows are range-partitioned and sorted by (cluster, order), so a task streams through its stretch of the joined text and cuts it
into pieces of about PIECE characters. What a scan does inside a piece depends on what came before only by where it may
begin (a match may reach over the seam) and, for patterns with `.*`, by how much of the pattern the open line has
met already. A piece is summed up as a table of these few cases, with its first and last characters; a cluster's
pieces are then folded in order, the seams scanned as text. The hits are those of a scan over the whole text.

Patterns match in any case, over lower-cased text, from left to right without overlap. They are of two kinds:
bounded ones, whose matches have a greatest length; and parts of fixed length with `.*` between them, greedy and
within a line, so that a line (up to a newline sign) counts once if it holds the parts in order. Others raise ValueError:
unbounded repeats of anything else, `.*` beside parts of varying length, patterns that match an empty text,
anchors other than word boundaries, look-around, groups referred to.

Edge cases: a null text joins as an empty one; a cluster of one row is that row's text; empty tables give empty results.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECE = 1 << 20
_PARSER = re._parser
_REFUSED = {"AT", "ASSERT", "ASSERT_NOT", "GROUPREF", "GROUPREF_EXISTS"}


def _parts(pattern: str) -> list[str]:
    """The pattern's parts between `.*` outside of groups and sets."""
    parts, depth, inset, at, begin = [], 0, False, 0, 0
    while at < len(pattern):
        ch = pattern[at]
        if ch == "\\":
            at += 2
            continue
        if inset:
            inset = ch != "]" or pattern[at - 1] == "["
        elif ch == "[":
            inset = True
        elif ch in "()":
            depth += 1 if ch == "(" else -1
        elif ch == "|" and depth == 0:
            return [pattern]
        elif pattern.startswith(".*", at) and depth == 0:
            parts.append(pattern[begin:at])
            at += 2
            begin = at
            continue
        at += 1
    return [*parts, pattern[begin:]]


def _check(tree) -> None:
    for op, value in tree:
        name = str(op)
        if name in _REFUSED and str(value) not in ("AT_BOUNDARY", "AT_NON_BOUNDARY"):
            raise ValueError(f"{name} in a pattern")
        stack = [value]
        while stack:
            v = stack.pop()
            if isinstance(v, _PARSER.SubPattern):
                _check(v)
            elif isinstance(v, (list, tuple)):
                stack.extend(v)


@dataclass
class Scanner:
    """A pattern by its parts; most: the longest stretch that one match, or one part, can take."""

    parts: list[re.Pattern]
    most: int

    @classmethod
    def of(cls, pattern: str) -> Scanner:
        _check(_PARSER.parse(pattern, re.IGNORECASE))
        parts = _parts(pattern)
        widths = [_PARSER.parse(p, re.IGNORECASE).getwidth() for p in parts]
        if any(low == 0 for low, _ in widths):
            raise ValueError(f"matches an empty text: {pattern}")
        if any(high > 10_000 for _, high in widths) or (len(parts) > 1 and any(low != high for low, high in widths)):
            raise ValueError(f"neither bounded nor of fixed parts: {pattern}")
        if len(parts) > 1:
            # every place where a part may begin, overlaps included
            parts = [f"(?=(?:{p}))" for p in parts]
        return cls([re.compile(p, re.IGNORECASE) for p in parts], max(high for _, high in widths))

    def on(self, text: str) -> Scan:
        return Single(self, text) if len(self.parts) == 1 else Several(self, text)


class Scan:
    """A scanner on one text. advance(state, at, to): (hits, state, at) after all that begins from at up to before to."""

    states = (0,)


class Single(Scan):
    def __init__(self, scanner: Scanner, text: str):
        self.pattern, self.text = scanner.parts[0], text

    def advance(self, state: int, at: int, to: int) -> tuple[int, int, int]:
        hits = 0
        while at < to and (m := self.pattern.search(self.text, at)) and m.start() < to:
            hits += 1
            at = m.end()
        return hits, state, max(at, to)

    def table(self, upto: int, to: int) -> list[list[int]]:
        """[at, state, hits, state, at] for starts 1 to upto; a case holds for all starts up to the one before the next."""
        chain = [(m.start(), m.end()) for m in self.pattern.finditer(self.text, 1)]
        chain = chain[: bisect_left(chain, (to, 0))]
        starts = [a for a, _ in chain]
        out = [[1, 0, len(chain), 0, max(to, chain[-1][1] if chain else 0)]]
        for at in range(starts[0] + 1 if starts else upto + 1, upto + 1):
            hits, now = 0, at
            # a scan from here goes on as the first one as soon as both begin a match at one place
            while now < to and (m := self.pattern.search(self.text, now)) and m.start() < to:
                k = bisect_left(starts, m.start())
                if k < len(starts) and starts[k] == m.start():
                    hits, now = hits + len(chain) - k, chain[-1][1]
                    break
                hits, now = hits + 1, m.end()
            case = [at, 0, hits, 0, max(to, now)]
            if case[1:] != out[-1][1:]:
                out.append(case)
        return out


class Several(Scan):
    """State: the parts that the open line has met; all of them once it counts."""

    def __init__(self, scanner: Scanner, text: str):
        self.count = len(scanner.parts)
        self.states = tuple(range(self.count + 1))
        self.places = [[m.start() for m in p.finditer(text)] for p in scanner.parts]
        # of a fixed length each
        self.widths = [_PARSER.parse(p.pattern[3:-1], re.IGNORECASE).getwidth()[0] for p in scanner.parts]
        self.lines = [k for k, ch in enumerate(text) if ch == "\n"] if "\n" in text else []

    def advance(self, state: int, at: int, to: int) -> tuple[int, int, int]:
        hits = 0
        while at < to:
            k = bisect_left(self.lines, at)
            line_end = self.lines[k] if k < len(self.lines) else None
            stop = to if line_end is None else min(line_end, to)
            while state < self.count:
                places = self.places[state]
                k = bisect_left(places, at)
                if k == len(places) or places[k] >= stop:
                    break
                at = places[k] + self.widths[state]
                state += 1
                hits += state == self.count
            if line_end is None or line_end >= to:
                return hits, state, max(at, to)
            at, state = max(at, line_end + 1), 0
        return hits, state, max(at, to)

    def table(self, upto: int, to: int) -> list[list[int]]:
        out: list[list[int]] = []
        for state in self.states:
            last = None
            # only a part that begins before `at` makes a difference to a start there
            cuts = sorted({1, *(p + 1 for places in self.places for p in places[: bisect_left(places, upto)]), *(n + 1 for n in self.lines[: bisect_left(self.lines, upto)])})
            for at in [c for c in cuts if 1 <= c <= upto]:
                case = [at, state, *self.advance(state, at, to)]
                if last is None or case[2:] != last[2:]:
                    out.append(case)
                    last = case
        return out


def _case(table: list[list[int]], state: int, at: int) -> list[int]:
    return [c for c in table if c[1] == state and c[0] <= at][-1][2:]


def _summed(text: str, scanners: list[Scanner]) -> str:
    """A piece as JSON: its text if it is short, else its ends, length and the table of each pattern."""
    most = max(s.most for s in scanners)
    if len(text) < 4 * most + 8:
        return json.dumps({"text": text})
    # what begins in the last `most` characters may not end in this piece, or need the sign after it
    to = len(text) - most - 1
    return json.dumps({"head": text[: most + 2], "tail": text[-2 * most - 2 :], "size": len(text), "tables": [s.on(text).table(most + 1, to) for s in scanners]})


def _folded(pieces: list[str], scanners: list[Scanner]) -> list[int]:
    """Hits of each pattern over a cluster's pieces in order. Every row begins with a blank; the first one's is no text."""
    most, out = max(s.most for s in scanners), []
    parsed = [json.loads(p) for p in pieces]
    for k, scanner in enumerate(scanners):
        # the text not yet scanned, with what stands before it; the scan's place in it
        buffer, at, state, hits = "", 1, 0, 0
        for piece in parsed:
            if "text" in piece:
                buffer += piece["text"]
                continue
            n, state, at = scanner.on(buffer + piece["head"]).advance(state, at, len(buffer) + 1)
            more, state, at_piece = _case(piece["tables"][k], state, max(1, at - len(buffer)))
            hits += n + more
            buffer, at = piece["tail"], at_piece - (piece["size"] - len(piece["tail"]))
        hits += scanner.on(buffer).advance(state, at, len(buffer))[0]
        out.append(hits)
    assert most > 0
    return out


def joined_hits(utterances: DataFrame, patterns: list[str], by: str, order: list[str], text: str = "text", piece: int = PIECE) -> DataFrame:
    """(by, hits): for each cluster an array of the hits of each pattern in its texts, in order, joined by blanks."""
    scanners = [Scanner.of(p) for p in patterns]
    rows = utterances.select(F.col(by), *[F.col(o).alias(f"__{k}") for k, o in enumerate(order)], F.lower(F.coalesce(F.col(text), F.lit(""))).alias("__text"))
    places = [f"__{k}" for k in range(len(order))]
    ordered = rows.repartitionByRange(by, *places).sortWithinPartitions(by, *places, "__text").select(by, F.col("__text").alias("text"))
    kind = rows.schema[by].dataType.simpleString()

    def sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        now, held, size = None, [], 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now], keys.type), pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([_summed("".join(held), scanners)])], [by, "part", "number", "piece"])

        for batch in batches:
            keys = batch.column(0)
            for key, said in zip(keys.to_pylist(), batch.column(1).to_pylist(), strict=True):
                if held and (key != now or size >= piece):
                    yield out()
                    number, held, size = number + 1, [], 0
                now = key
                # a very long text is dealt out over pieces too
                said = " " + said
                for k in range(0, len(said), piece):
                    if held and size >= piece:
                        yield out()
                        number, held, size = number + 1, [], 0
                    held.append(said[k : k + piece])
                    size += len(held[-1])
        if held:
            yield out()

    def fold(table: pd.DataFrame) -> pd.DataFrame:
        table = table.sort_values(["part", "number"])
        return pd.DataFrame({by: [table[by].iloc[0]], "hits": [_folded(table["piece"].tolist(), scanners)]})

    pieces = ordered.mapInArrow(sum_up, f"`{by}` {kind}, part int, number int, piece string")
    return pieces.groupBy(by).applyInPandas(fold, f"`{by}` {kind}, hits array<bigint>")


def joined_scores(utterances: DataFrame, patterns: list[tuple[str, int, str]], themes: DataFrame, by: str, order: list[str]) -> DataFrame:
    """(cluster, label, hits, score) like labeling.pattern_scores, with hits that may span rows."""
    counted = joined_hits(utterances, [p for _, _, p in patterns], by, order)
    labels = dict.fromkeys(label for label, _, _ in patterns)
    sums = {label: sum((F.get("hits", F.lit(k)) for k, (name, _, _) in enumerate(patterns) if name == label), F.lit(0)) for label in labels}
    hits = counted.select(by, F.explode(F.array(*[F.struct(F.lit(label).alias("label"), n.alias("hits")) for label, n in sums.items()])).alias("p")).select(by, "p.*")
    return hits.join(themes, by).withColumn("score", F.col("hits") / F.col("segments") * F.greatest(F.lit(0.0), 1 - 2 * F.col("theme_ratio"))).select(by, "label", "hits", "score")
