"""The event ledger as a stream: events are appended once, whatever is delivered again."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from skein.sources import merkle


def unique_events(events: DataFrame, id_col: str = "event_id", time_col: str = "ts", delay: str = "10 minutes") -> DataFrame:
    """Drops repeats of an event within the watermark; state is bounded by it."""
    return events.withWatermark(time_col, delay).dropDuplicatesWithinWatermark([id_col])


def windowed_counts(events: DataFrame, window: str = "1 hour", time_col: str = "ts", delay: str = "10 minutes") -> DataFrame:
    return events.withWatermark(time_col, delay).groupBy(F.window(time_col, window).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("events")).select(F.col("w.start").alias("start"), "event_type", "events")


def append_to(events: DataFrame, path: str, checkpoint: str):
    """Runs over what is there and ends; a restart goes on where it ended."""
    return events.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def commit_stream(rows: DataFrame, destination: str, checkpoint: str, key: str = "task_id"):
    """Every micro-batch is merged into the destination's build by key, in the buckets that it touches; a batch that is delivered again changes nothing."""

    def commit(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            merkle.commit(batch.dropDuplicates(), destination, key)

    return rows.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def budget_stream(actions: DataFrame, limits: dict[str, int], key: str = "attempt_id", id_col: str = "event_id", order: str = "seq") -> DataFrame:
    """(key, id_col, allowed) of a stream of actions: each key's sums are its state, and a refused action reserves nothing.

    Rows of a key are taken in the order of `order` inside a micro-batch, and batches as they come.
    """
    costs = list(limits)
    most = [limits[c] for c in costs]
    kind, id_kind = (actions.schema[c].dataType.simpleString() for c in (key, id_col))

    def step(k, frames, state):
        used = list(state.get) if state.exists else [0] * len(costs)
        for frame in frames:
            rows = frame.sort_values(order)
            out = []
            for values in rows[costs].fillna(0).itertuples(index=False):
                new = [u + int(v) for u, v in zip(used, values, strict=True)]
                out.append(all(n <= m for n, m in zip(new, most, strict=True)))
                used = new if out[-1] else used
            yield pd.DataFrame({key: rows[key], id_col: rows[id_col], "allowed": out})
        state.update(tuple(used))

    fields = ", ".join(f"s{i} bigint" for i in range(len(costs)))
    return actions.groupBy(key).applyInPandasWithState(step, f"{key} {kind}, {id_col} {id_kind}, allowed boolean", fields, "append", "NoTimeout")


STATUSES = "attempt_id string, seq long, event_id string, status string"


def _said(key, seq: int, event_id: str, status: str) -> Row:
    return Row(attempt_id=key[0], seq=seq, event_id=event_id, status=status)


class _Attempt(StatefulProcessor):
    """One attempt's ledger: the number that comes next, events that came too early, and whether it is sealed."""

    def __init__(self, final: str, wait: int, keep: int):
        self.final, self.wait, self.keep = final, wait * 1000, keep * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.place = handle.getValueState("place", "next long, sealed boolean")
        self.early = handle.getMapState("early", "seq long", "event_id string, event_type string")

    def _due(self, at: int) -> None:
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        self.handle.registerTimer(at)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        nxt, sealed = self.place.get() if self.place.exists() else (0, False)
        latest = timerValues.getCurrentWatermarkInMs()
        for r in sorted(rows, key=lambda r: (r.seq, r.event_id)):
            latest = max(latest, int(r.ts.timestamp() * 1000))
            if sealed:
                yield _said(key, r.seq, r.event_id, "AFTER_SEAL")
            elif r.seq < nxt or self.early.containsKey((r.seq,)):
                yield _said(key, r.seq, r.event_id, "REPEATED")
            else:
                self.early.updateValue((r.seq,), (r.event_id, r.event_type))
                while not sealed and self.early.containsKey((nxt,)):
                    event_id, kind = self.early.getValue((nxt,))
                    self.early.removeKey((nxt,))
                    yield _said(key, nxt, event_id, "APPENDED")
                    nxt, sealed = nxt + 1, kind == self.final
        if sealed:
            yield from self._left(key, "AFTER_SEAL")
        self.place.update((nxt, sealed))
        self._due(latest + (self.keep if sealed else self.wait))

    def _left(self, key, status: str) -> Iterator[Row]:
        for (seq,), (event_id, _) in sorted((tuple(k), tuple(v)) for k, v in self.early.iterator()):
            yield _said(key, seq, event_id, status)
        self.early.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        """What is sealed is forgotten; of what isn't, the tail that still lacks an event before it is given out as it is."""
        yield from self._left(key, "INCOMPLETE")
        self.place.clear()

    def close(self) -> None:
        pass


def sealed_ledger(events: DataFrame, final: str = "FINAL_OUTPUT", delay: str = "10 minutes", wait: int = 3600, keep: int = 86_400) -> DataFrame:
    """(attempt_id, seq, event_id, status) of a stream of events(attempt_id, seq, event_id, event_type, ts), each event once.

    Numbers begin at 0. APPENDED: in order, what came too early waiting for what is before it; REPEATED: the number has been
    there; AFTER_SEAL: the attempt's final event has been appended; INCOMPLETE: `wait` seconds of event time have passed without
    the missing event. A sealed attempt is forgotten `keep` seconds after its last event. State is kept by RocksDB, so that it may be larger
    than memory: the session sets spark.sql.streaming.stateStore.providerClass.
    """
    rows = events.select(F.col("attempt_id").cast("string").alias("attempt_id"), F.col("seq").cast("long").alias("seq"), F.col("event_id").cast("string").alias("event_id"), "event_type", "ts").withWatermark("ts", delay)
    return rows.groupBy("attempt_id").transformWithState(_Attempt(final, wait, keep), STATUSES, "append", "eventTime")
