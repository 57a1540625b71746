"""Keyed stream state with timers: sliding sums from a ring of slide counts, and running counts with a life time.

Both take counts per slide and key from a plain streaming aggregate, so a very common key costs one row per task and
slide before anything is shuffled, and the state below holds one row per key and live slide, or one row per key.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from fathomline.session import DEFAULTS

_MICROS = 1_000  # in a millisecond, the unit of watermarks and timers
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def keep_keyed_state(spark: SparkSession) -> None:
    """Give a session that still has Spark's default state store the library's, as the other holds no keyed state.

    It lasts for streams that the session starts afterwards; a stream that goes on from a checkpoint keeps its store.
    """
    if spark.conf.get(_PROVIDER).endswith(".HDFSBackedStateStoreProvider"):
        spark.conf.set(_PROVIDER, DEFAULTS[_PROVIDER])


def closed_slides(df: DataFrame, ts: str, key: str, slide: str, delay: str) -> DataFrame:
    """``(key, at, start, n)`` of every slide that the watermark has passed; ``at`` carries the watermark on."""
    timed = df.withColumn(ts, F.col(ts).cast("timestamp"))  # a watermark needs a time zone
    counted = timed.withWatermark(ts, delay).groupBy(F.window(ts, slide).alias("s"), key).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(key, F.window_time("s").alias("at"), F.unix_micros("s.start").alias("start"), "n")


def window_sums(slides: dict[int, int], first: int, last: int, window: int, slide: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts from ``first`` to ``last`` of windows that hold a slide, and their sums.

    A slide is added at the first window that covers it and taken off behind the last, so the sums run along the
    changes and every window costs the same, however many slides it covers.
    """
    if last < first:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    width = (last - first) // slide + 1
    changes = np.zeros(width + 1, dtype=np.int64)
    for start, n in slides.items():
        enters, leaves = (start - window + slide - first) // slide, (start + slide - first) // slide
        if enters < width and leaves > 0:
            changes[max(0, enters)] += n
            changes[min(width, leaves)] -= n
    sums = np.cumsum(changes[:-1])
    held = np.flatnonzero(sums)
    return first + held * slide, sums[held]


class SlidingSums(StatefulProcessor):
    """Sums of all windows that have ended, from slides that arrive once each; times are in microseconds."""

    def __init__(self, key: str, window: int, slide: int):
        self.key, self.window, self.slide = key, window, slide

    def init(self, handle) -> None:
        self.handle = handle
        self.ring = handle.getMapState("ring", "start long", "n long")
        self.upcoming = handle.getValueState("upcoming", "start long")  # the first window that is not out yet

    def handleInputRows(self, key, rows, timerValues):
        least = None
        for frame in rows:
            for start, n in zip(frame["start"].tolist(), frame["n"].tolist(), strict=True):
                self.ring.updateValue((start,), (n,))
                least = start if least is None else min(least, start)
        if least is not None and not self.upcoming.exists():
            self.upcoming.update((least - self.window + self.slide,))
        yield from self._ended(key, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield from self._ended(key, timerValues)

    def _ended(self, key, timers):
        slides = {k[0]: v[0] for k, v in self.ring.iterator()}
        first = self.upcoming.get()[0]
        passed = timers.getCurrentWatermarkInMs() * _MICROS
        # Behind the last slide there is nothing until another one arrives.
        last = min((passed - self.window) // self.slide * self.slide, max(slides) if slides else first - self.slide)
        starts, sums = window_sums(slides, first, last, self.window, self.slide)
        upcoming = max(first, last + self.slide)
        live = False
        for start in slides:
            if start < upcoming:
                self.ring.removeKey((start,))
            else:
                live = True
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if live:
            self.upcoming.update((upcoming,))
            self.handle.registerTimer(-(-(upcoming + self.window) // _MICROS))
        else:  # the next slide starts anew, behind all windows that are out
            self.upcoming.clear()
        if len(starts):
            yield pd.DataFrame({"start": starts, self.key: key[0], "n": sums})

    def close(self) -> None:
        pass


def sliding_sums(df: DataFrame, ts: str, key: str, window: int, slide: int, delay: str) -> DataFrame:
    """``(window_start, key, n)`` of every sliding window that holds an event, once the watermark has passed its end.

    ``window`` and ``slide`` are in microseconds. Rows are shuffled per slide and key, whatever the number of windows
    over a slide; use append mode.
    """
    keep_keyed_state(df.sparkSession)
    slides = closed_slides(df, ts, key, f"{slide} microseconds", delay)
    kind = df.schema[key].dataType.simpleString()
    sums = slides.groupBy(key).transformWithStateInPandas(
        SlidingSums(key, window, slide), f"start long, `{key}` {kind}, n long", "append", "eventTime")
    return sums.select(F.timestamp_micros("start").alias("window_start"), key, "n")


class LivingCounts(StatefulProcessor):
    """A running count per key that is forgotten when no slide arrives for ``life`` (microseconds of event time)."""

    def __init__(self, key: str, life: int, slide: int):
        self.key, self.life, self.slide = key, life, slide

    def init(self, handle) -> None:
        self.handle = handle
        self.count = handle.getValueState("count", "n long, last long")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.count.update((int(initialState["n"].sum()), None))

    def handleInputRows(self, key, rows, timerValues):
        frames = [frame[["start", "n"]] for frame in rows]
        slides = pd.concat(frames).sort_values("start")  # as many rows as slides have closed since the last batch
        n, last = self.count.get() if self.count.exists() else (0, None)
        starts, counts = slides["start"].tolist(), []
        for start, more in zip(starts, slides["n"].tolist(), strict=True):
            n = more if last is not None and start - last > self.life else n + more
            last = start
            counts.append(n)
        self.count.update((n, last))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        # A slide within the life time has closed by then, and rows come before timers.
        self.handle.registerTimer(-(-(last + self.life + self.slide) // _MICROS))
        yield pd.DataFrame({"start": starts, self.key: key[0], "n": counts})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.count.clear()
        return iter(())

    def close(self) -> None:
        pass


def living_counts(df: DataFrame, ts: str, key: str, life: int, slide: int, delay: str,
                  initial: DataFrame | None = None) -> DataFrame:
    """``(slide_start, key, n)``: the count of a key up to each of its slides, since its last silence beyond ``life``.

    ``life`` and ``slide`` are in microseconds; a silence is the time between the starts of two slides. ``initial``
    holds ``(key, n)`` to start from; such a count lives at least until its key is first seen. State of a key that
    stays silent is dropped by a timer, so it does not grow with all keys ever seen.
    """
    keep_keyed_state(df.sparkSession)
    slides = closed_slides(df, ts, key, f"{slide} microseconds", delay)
    kind = df.schema[key].dataType.simpleString()
    start = None if initial is None else initial.select(key, F.col("n").cast("long").alias("n")).groupBy(key)
    counts = slides.groupBy(key).transformWithStateInPandas(
        LivingCounts(key, life, slide), f"start long, `{key}` {kind}, n long", "append", "eventTime", initialState=start)
    return counts.select(F.timestamp_micros("start").alias("slide_start"), key, "n")
