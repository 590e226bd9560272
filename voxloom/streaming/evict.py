"""Removal of overlapping repeats over a stream: the rule of operators.dedup, with state for each (episode, by).

A segment waits until the watermark has passed its time, so segments meet in order whatever the order of files. Then
the rule decides on it against the live segments of its key; a live one is final, and leaves as a result row, when the
watermark has passed its end, as nothing that may still come can reach it. In mode `reference` a row leaves as soon as it
is kept, whether it is evicted later or not.

State of a key: the segments that wait, the live ones that aren't final, and the texts of kept ones. Timers by event time
wake it at the next of these times; one `idle` after its last segment drops the texts and ends the key, so state is
bounded by what lies within `late` of the watermark and by the texts of keys that are still spoken in.

The result is that of `evict_overlaps` over the rows that came in time, if no (episode, by) pauses for longer than `idle`.

Edge cases: rows behind the watermark are late and left out; a null event time too; an empty speaker or text is left
out as in the batch form; a null end is 0, null confidence counts as 1.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from voxloom.operators.dedup import Live, admit

WAITING = "ordinal long, start double, end double, text string, confidence double, speaker string, at long"
FIELDS = ("ordinal", "start", "end", "text", "confidence", "speaker", "at")


class Evictor(StatefulProcessor):
    def __init__(self, mode: str, by: str, idle_ms: int, columns: list[str]):
        self.mode, self.by, self.idle_ms, self.columns = mode, by, idle_ms, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", WAITING)
        self.live = handle.getListState("live", WAITING)
        self.texts = handle.getMapState("texts", "text string", "seen boolean")
        self.last = handle.getValueState("last", "at long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        came = []
        for batch in rows:
            batch = batch.astype(object).where(batch.notna(), None)
            came += [tuple(r) for r in batch[list(FIELDS)].itertuples(index=False)]
        if came:
            self.waiting.appendList(came)
            before = self.last.get()[0] if self.last.exists() else came[0][-1]
            self.last.update((max(before, *(r[-1] for r in came)),))
            self._wake_at(self._next(self.waiting.get(), self.live.get()))
        yield self._rows(key, [])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now, out = timerValues.getCurrentWatermarkInMs(), []
        rows = sorted(self.waiting.get(), key=lambda r: (r[-1], r[0]))
        due = [r for r in rows if r[-1] <= now]
        live = [self._live(r) for r in self.live.get()]
        # `admit` forgets live rows that have ended; those that can't be reached any more are final
        final = []
        for row in due:
            text = (row[3] or "").strip().lower()
            if not text or not key[1] or self.texts.containsKey((text,)):
                continue
            new = self._live(row)
            final += [x.row for x in live if x.end <= new.start]
            live = [x for x in live if x.end > new.start]
            kept, evicted = admit(live, new)
            if evicted is not None:
                self.texts.removeKey((evicted.text,))
            if kept:
                self.texts.updateValue((text,), (True,))
                if self.mode == "reference":
                    out.append(row)
        final += [x.row for x in live if self._ends(x.row) <= now]
        left = [x.row for x in live if self._ends(x.row) > now]
        waiting = rows[len(due) :]
        self._store(self.waiting, waiting)
        self._store(self.live, left)
        if self.mode == "clean":
            out = final
        after = self._next(waiting, left)
        if after is None:
            after = (self.last.get()[0] if self.last.exists() else now) + self.idle_ms
            if after <= now:
                for state in (self.waiting, self.live, self.texts, self.last):
                    state.clear()
                after = None
        self._wake_at(after)
        yield self._rows(key, out)

    @staticmethod
    def _ends(row: tuple) -> int:
        """Event time at which a segment ends."""
        return row[-1] + max(0, -int(-1000 * ((row[2] or 0.0) - (row[1] or 0.0)) // 1))

    @staticmethod
    def _live(row: tuple) -> Live:
        return Live(row[1] or 0.0, row[2] or 0.0, 1.0 if row[4] is None else row[4], (row[3] or "").strip().lower(), row)

    @staticmethod
    def _store(state, rows: list[tuple]) -> None:
        if rows:
            state.put(rows)
        else:
            state.clear()

    def _next(self, waiting, live) -> int | None:
        times = [r[-1] for r in waiting] + [self._ends(r) for r in live]
        return min(times, default=None)

    def _wake_at(self, at: int | None) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if at is not None:
            self.handle.registerTimer(at)

    def _rows(self, key, rows: list[tuple]) -> pd.DataFrame:
        table = pd.DataFrame(rows, columns=list(FIELDS)).drop(columns="at").assign(episode=key[0])
        table[self.by] = key[1]
        return table[self.columns]


def evict_overlaps_stream(segments: DataFrame, ts: str, late: str = "10 minutes", idle_seconds: float = 6 * 3600, mode: str = "clean", by: str = "speaker") -> DataFrame:
    """The streaming form of `dedup.evict_overlaps`; ts: the event time of a segment's start, which grows with start within an episode.

    Needs the RocksDB state store provider.
    """
    if mode not in ("clean", "reference"):
        raise ValueError(f"unknown mode {mode!r}")
    columns = list(dict.fromkeys(["episode", "speaker", by, "ordinal", "start", "end", "text", "confidence"]))
    rows = segments.where(F.col(ts).isNotNull()).withWatermark(ts, late)
    rows = rows.select(ts, *columns, F.unix_millis(F.col(ts).cast("timestamp")).alias("at"))
    schema = StructType([rows.schema[c] for c in columns])
    grouped = rows.groupBy("episode", by)
    return grouped.transformWithStateInPandas(statefulProcessor=Evictor(mode, by, int(idle_seconds * 1000), columns), outputStructType=schema, outputMode="Append", timeMode="EventTime")
