"""Live stall detection of a crawl (W6): a row for every tick as soon as event time has passed it.

Two stateful steps, each a ``transformWithState`` processor on the RocksDB store:

1. the visited set, in hash buckets of URLs: a bucket holds its URLs as map
   state and gives, per micro-batch, how many of them are new in each tick;
2. the ticker: one small state (open ticks' counts, the running total) fed by
   at most one row per bucket and tick, with an event-time timer at the end of
   the next tick. A timer fires without any new fetch, which is what a stall is.

Time goes on by the watermark, so a crawl that fetches nothing sends heartbeats:
rows with a null URL and the current time.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from trawl.operators.reports import TICK_SECONDS

NEW_URLS = "at TIMESTAMP, tick BIGINT, new BIGINT"
TICKS = "tick BIGINT, new BIGINT, visited BIGINT, stalled BOOLEAN, first_stall BOOLEAN"
DEFAULT_DELAY = "30 seconds"


# The processors are made inside functions, so that they reach Python workers by value.
def _visited_set(start_us: int, tick_us: int) -> StatefulProcessor:
    import pandas as pd

    class VisitedSet(StatefulProcessor):
        """New URLs of one hash bucket per tick; a URL counts where its first fetch of the micro-batch lies."""

        def init(self, handle: StatefulProcessorHandle) -> None:
            self.seen = handle.getMapState("seen", "url STRING", "us BIGINT")

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
            first: dict[str, int] = {}
            for frame in rows:
                for url, us in frame.groupby("url")["us"].min().items():  # leaves heartbeats out
                    first[url] = min(us, first.get(url, us))
            counts: dict[int, int] = {}
            latest = 0
            for url, us in first.items():
                if not self.seen.containsKey((url,)):
                    self.seen.updateValue((url,), (int(us),))
                    tick = max((us - start_us) // tick_us, 0) + 1
                    counts[tick] = counts.get(tick, 0) + 1
                    latest = max(latest, us)
            if counts:
                # an event time of its own: never behind the watermark
                at = pd.Timestamp(max(latest, timerValues.getCurrentWatermarkInMs() * 1000), unit="us", tz="UTC")
                yield pd.DataFrame({"at": at, "tick": list(counts), "new": list(counts.values())})

        def close(self) -> None:
            pass

    return VisitedSet()


def _ticker(start_us: int, tick_us: int) -> StatefulProcessor:
    import pandas as pd

    class Ticker(StatefulProcessor):
        """Closes ticks in order; a URL that comes after its tick was closed counts in the oldest open one."""

        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.total = handle.getValueState("total", "closed BIGINT, visited BIGINT, stalled BOOLEAN")
            self.open = handle.getMapState("open", "tick BIGINT", "new BIGINT")

        def _wake_after(self, closed: int) -> None:
            self.handle.registerTimer(-(-(start_us + (closed + 1) * tick_us) // 1000))

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
            if not self.total.exists():
                self.total.update((0, 0, False))
                self._wake_after(0)
            closed = self.total.get()[0]
            came: dict[int, int] = {}
            for frame in rows:
                for tick, new in zip(frame["tick"].tolist(), frame["new"].tolist()):
                    tick = max(tick, closed + 1)
                    came[tick] = came.get(tick, 0) + new
            for tick, new in came.items():
                before = self.open.getValue((tick,))[0] if self.open.containsKey((tick,)) else 0
                self.open.updateValue((tick,), (before + new,))
            return iter(())

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            closed, visited, was_stalled = self.total.get()
            last = (timerValues.getCurrentWatermarkInMs() * 1000 - start_us) // tick_us
            ended = {tick: new for (tick,), (new,) in self.open.iterator() if tick <= last}
            for tick in ended:
                self.open.removeKey((tick,))
            out = []
            for tick in range(closed + 1, last + 1):
                new = ended.get(tick, 0)
                visited += new
                stalled = visited > 0 and new == 0
                out.append((tick, new, visited, stalled, stalled and not was_stalled))
                was_stalled = was_stalled or stalled
            closed = max(closed, last)
            self.total.update((closed, visited, was_stalled))
            self._wake_after(closed)
            if out:
                yield pd.DataFrame(out, columns=["tick", "new", "visited", "stalled", "first_stall"])

        def close(self) -> None:
            pass

    return Ticker()


def stall_stream(
    fetches: DataFrame, start: datetime, tick_seconds: int = TICK_SECONDS, delay: str = DEFAULT_DELAY, buckets: int = 256
) -> DataFrame:
    """W6 on a stream ``fetches(url, ts)``: ``(tick, new, visited, stalled, first_stall)`` as ticks end.

    Ticks count from ``start``, when the crawl began. A tick is closed when the
    watermark, the latest time seen less ``delay``, has passed its end; its row
    says how many URLs were first fetched in it, the running total, whether it
    brought none after some were visited, and whether it is the first such. For
    fetches at most ``delay`` out of order and micro-batches in order of time this
    is ``reports.stall_ticks``. A later one is dropped with Spark's late rows, a
    fetch before ``start`` is in tick 1. Null URLs are heartbeats, rows without a
    time count for nothing. ``buckets`` bounds the tasks that hold the visited
    set, and is fixed at the first start. Write in append mode with
    ``index_stream.write_stream(..., state=ROCKSDB)``.
    """
    start_us = int(start.replace(microsecond=0).timestamp()) * 1_000_000 + start.microsecond
    tick_us = tick_seconds * 1_000_000
    timed = fetches.where(F.col("ts").isNotNull()).withWatermark("ts", delay)
    # Heartbeats go on into a bucket: a filter on the URL would be pushed below the watermark, which must see them.
    rows = timed.select(
        F.pmod(F.xxhash64("url"), F.lit(buckets)).alias("bucket"), "url", F.unix_micros("ts").alias("us"), "ts"
    )
    new = rows.groupBy("bucket").transformWithStateInPandas(
        _visited_set(start_us, tick_us), NEW_URLS, "Append", "EventTime", eventTimeColumnName="at"
    )
    crawl = new.withColumn("crawl", F.lit(0)).groupBy("crawl")
    return crawl.transformWithStateInPandas(_ticker(start_us, tick_us), TICKS, "Append", "EventTime")
