"""Platform sentiment of a trailing time, at every border of a short pane, over a stream of posts.

Posts are summed per pane and platform in a first stateful step, which gives a pane once the watermark has passed it. A second one keeps,
per platform, the panes of one look-back and gives every border that the watermark has passed since, from running sums. So a post is
one row however many windows hold it; what goes to one task per platform is a row per pane of time, whatever the number of posts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from moodgauge.functions.moments import LOOK_BACK_SECONDS
from moodgauge.operators.indices import platform_of, weighted_sentiment
from moodgauge.schemas import INDEX_VALUE

PANE_SECONDS = 30
# borders worked out at once
SLICE = 1 << 16
STATE = "given long, ends array<long>, weights array<string>, rated array<long>, posts array<long>"
BORDERS = "sentiment_type string, end_ms long, n_posts long, weight string, rated long"


def borders(ends: np.ndarray, length: int, step: int, after: int, until: int) -> Iterator[np.ndarray]:
    """Every border after `after`, up to `until`, that has one of the ascending pane ends within `length` before it."""
    following = np.append(ends[1:], until + step)
    first = np.maximum(ends, after + step)
    last = np.minimum(np.minimum(ends + length, following), until + step)
    counts = np.maximum(last - first, 0) // step
    width = max(1, SLICE * step // length)
    for at in range(0, len(ends), width):
        own = counts[at : at + width]
        within = np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
        yield np.repeat(first[at : at + width], own) + within * step


class Trailing(StatefulProcessor):
    """Sums over the last `length` ms at each border of a pane of `step` ms, for one platform."""

    def __init__(self, step: int, length: int):
        self.step, self.length = step, length

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("panes", STATE)

    def give(self, key, fresh: list[tuple], watermark: int) -> Iterator[pd.DataFrame]:
        given, *held = self.held.get() if self.held.exists() else (-1, [], [], [], [])
        panes = sorted([*zip(*held), *fresh])
        until = max(watermark // self.step * self.step, given)
        ends, rated, posts = (np.array([p[k] for p in panes], np.int64) for k in (0, 2, 3))
        # weights as whole numbers of any size, so that their sums are exact
        sums = [np.append(0, np.cumsum(x)) for x in (np.array([int(p[1]) for p in panes], object), rated, posts)]
        for end in borders(ends, self.length, self.step, given, until):
            low, high = np.searchsorted(ends, end - self.length, "right"), np.searchsorted(ends, end, "right")
            weight, n_rated, n_posts = (x[high] - x[low] for x in sums)
            if len(end):
                yield pd.DataFrame({"sentiment_type": key[0], "end_ms": end, "n_posts": n_posts, "weight": [str(x) for x in weight], "rated": n_rated})
        kept = [p for p in panes if p[0] > until + self.step - self.length]
        self.held.update((until, *([p[k] for p in kept] for k in range(4))))
        for moment in list(self.handle.listTimers()):
            self.handle.deleteTimer(moment)
        if kept:
            self.handle.registerTimer(until + self.step)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        found = pd.concat(list(rows))
        fresh = list(zip(*(found[c].tolist() for c in ("end_ms", "weight", "rated", "posts"))))
        yield from self.give(key, fresh, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self.give(key, [], timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


def trailing_panes(posts: DataFrame, event_time: str, pane_seconds: int = PANE_SECONDS, seconds: int = LOOK_BACK_SECONDS, delay: str = "12 hours") -> DataFrame:
    """(sentiment_type, end_ms, n_posts, sentiment_absolute) for each border that has a post of the platform in [end - seconds, end).

    `posts` is a stream of a `changes.with_state_store` session with a timestamp `event_time`; `seconds` is a multiple of `pane_seconds`. A
    border is given once, when the watermark passes it: a post that is late by up to `delay` counts wherever it belongs, a later
    one is dropped. The value is null where no post in reach has a weight, or where it does not fit its decimal.
    """
    if pane_seconds <= 0 or seconds <= 0 or seconds % pane_seconds:
        raise ValueError("the look-back must be a multiple of the pane")
    weight = weighted_sentiment()
    panes = (
        posts.withColumn("sentiment_type", platform_of(F.col("post_type")))
        .filter(F.col("sentiment_type").isNotNull())
        .withWatermark(event_time, delay)
        .groupBy(F.window(event_time, f"{pane_seconds} seconds"), "sentiment_type")
        .agg(F.sum(weight).alias("weight"), F.count(weight).alias("rated"), F.count("*").alias("posts"))
    )
    whole = (F.coalesce("weight", F.lit(0)).cast("decimal(28,4)") * 10_000).cast("decimal(38,0)").cast("string")
    panes = panes.select(F.window_time("window").alias("at"), "sentiment_type", F.unix_millis("window.end").alias("end_ms"), whole.alias("weight"), "rated", "posts")
    state = Trailing(pane_seconds * 1000, seconds * 1000)
    found = panes.groupBy("sentiment_type").transformWithStateInPandas(state, BORDERS, "Append", "EventTime")
    total = (F.col("weight").try_cast("decimal(38,0)").try_cast("decimal(28,0)") / 10_000).try_cast("decimal(24,4)")
    mean = F.when(F.col("rated") > 0, total / F.col("rated")).try_cast(INDEX_VALUE)
    return found.select("sentiment_type", "end_ms", "n_posts", mean.alias("sentiment_absolute"))
