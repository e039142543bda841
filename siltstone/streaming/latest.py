"""The newest row per key of a running stream, kept in state instead of in one change set per batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

EVENT = "_event_time"


def latest_updates(rows: DataFrame, key: Sequence[str], order: Sequence[str], event_time: str, delay: str = "1 day", idle_ms: int | None = None) -> DataFrame:
    """A stream of rows that replace what was the newest row of their key, in update mode.

    "Newest" is decided by the columns `order`, NULLs losing, as in `dedupe.latest`; it has to be a total
    order. Rows may arrive out of order: an older one changes nothing and gives nothing. Rows whose
    `event_time` lies more than `delay` behind the newest one seen are late and left out, and so are rows
    without one. With `idle_ms` a key's state is dropped when the watermark has passed its newest event by
    that time; a row that comes afterwards is the first of its key again. Apply the updates to a table by
    key (`tables.upsert_partitions`, a bucketed table); doing so again after a failure changes nothing.

    A key's rows meet in one task; they are reduced to the newest one there and held as one row of state.
    """
    names = rows.columns
    order, key = list(order), list(key)
    # Instants are held as microseconds: state and rows would give them back in different time zones.
    instants = {f.name for f in rows.schema if isinstance(f.dataType, T.TimestampType)} - set(key)
    rows = rows.withColumn(EVENT, F.col(event_time).cast("timestamp")).filter(F.col(EVENT).isNotNull())
    rows = rows.withColumns({c: F.unix_micros(c) for c in instants})
    columns = [c for c in rows.columns if c != EVENT]
    out = T.StructType([rows.schema[c] for c in columns])

    class Newest(StatefulProcessor):
        def init(self, handle) -> None:
            self.handle = handle
            self.held = handle.getValueState("newest", out)

        def handleInputRows(self, key, rows, timerValues):
            def rank(row):
                return [(row[c] is not None, row[c]) for c in order]

            def above(a, b):
                for (has_a, x), (has_b, y) in zip(rank(a), rank(b), strict=True):
                    if has_a != has_b:
                        return has_a
                    if has_a and x != y:
                        return x > y
                return False

            best = Row(*columns)(*self.held.get()) if self.held.exists() else None
            before, event = best, None
            for row in rows:
                event = row[EVENT] if event is None else max(event, row[EVENT])
                plain = Row(*columns)(*[row[c] for c in columns])
                if best is None or above(plain, best):
                    best = plain
            if idle_ms is not None and event is not None:
                for timer in list(self.handle.listTimers()):
                    self.handle.deleteTimer(timer[0] if isinstance(timer, tuple) else timer)
                self.handle.registerTimer(int(event.timestamp() * 1000) + idle_ms)
            if best is not before:
                self.held.update(tuple(best))
                yield best

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            self.held.clear()
            return iter(())

        def close(self) -> None:
            pass

    grouped = rows.withWatermark(EVENT, delay).groupBy(*key)
    newest = grouped.transformWithState(Newest(), out, "Update", "EventTime")
    return newest.select(*[(F.timestamp_micros(c) if c in instants else F.col(c)).alias(c) for c in names])
