"""Change detection as keyed state of a stream: only versions of a post that differ from the one before travel on.

The state holds one version per key, in RocksDB, and forgets a key that has not been seen for `keep_ms`, which bounds it. A key that comes
again later counts as changed. With `recompute_ms`, a key whose last version was given that long ago is given again by a
processing-time timer, with the reason `due`, so that what hangs on time alone is worked out again without a new event.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from moodgauge.operators.impact import KEY

STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
KEEP_MS = 24 * 3_600_000
CHANGED, DUE = "changed", "due"


def with_state_store(spark: SparkSession) -> SparkSession:
    """A session of the same application whose streams keep their state in RocksDB, as this state needs it."""
    session = spark.newSession()
    for key, value in STATE_STORE.items():
        session.conf.set(key, value)
    session.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    return session


class Changes(StatefulProcessor):
    """Rows (all columns of the versions, and reason) of one key that are new or differ from the row before."""

    def __init__(self, schema: T.StructType, order: list[str], values: list[str], keep_ms: int, recompute_ms: int | None):
        self.schema, self.order, self.values = schema, order, values
        self.keep_ms, self.recompute_ms = keep_ms, recompute_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", self.schema, ttlDurationMs=self.keep_ms)

    def frame(self, rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=[*self.schema.names, "reason"], dtype=object)

    def wait(self, now: int) -> None:
        for moment in list(self.handle.listTimers()):
            self.handle.deleteTimer(moment)
        self.handle.registerTimer(now + self.recompute_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        names = self.schema.names
        found = pd.concat(list(rows))[names].astype(object)
        found = found.where(found.notna(), None).sort_values(self.order)
        before = tuple(self.last.get()) if self.last.exists() else None
        places, out = [names.index(v) for v in self.values], []
        for row in found.itertuples(index=False, name=None):
            if before is None or any(row[k] != before[k] for k in places):
                out.append((*row, CHANGED))
            before = row
        self.last.update(tuple(None if x is None else int(x) if isinstance(f.dataType, T.IntegralType) else x for x, f in zip(before, self.schema)))
        if self.recompute_ms is not None and out:
            self.wait(timerValues.getCurrentProcessingTimeInMs())
        if out:
            yield self.frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.last.exists():
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.recompute_ms)
            yield self.frame([(*self.last.get(), DUE)])

    def close(self) -> None:
        pass


def changes(versions: DataFrame, order, values, keys=KEY, keep_ms: int = KEEP_MS, recompute_ms: int | None = None) -> DataFrame:
    """A stream of versions (of a `with_state_store` session) with those that change something, and their `reason`.

    Versions of a key are ordered within a micro-batch; micro-batches are taken as they come. As timers may fall due without data, Spark
    then runs batches without any; a query that works off what is there and ends needs `spark.sql.streaming.noDataMicroBatches.enabled` off.
    """
    out = T.StructType([*versions.schema.fields, T.StructField("reason", T.StringType())])
    state = Changes(versions.schema, list(order), list(values), keep_ms, recompute_ms)
    return versions.groupBy(*keys).transformWithStateInPandas(state, out, "Append", "ProcessingTime")
