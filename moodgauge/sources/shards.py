"""A sharded log of records in Parquet files, as a stream with a position per shard, and a sink that puts records to it.

A log is a folder of files below `shard=<n>`, with the columns seq, ts (milliseconds) and value; seq rises within a shard. Any Spark job
can write one. `register(spark)` makes the format "shard_log" known:

* reading, `spark.readStream.format("shard_log").load(folder)`: an offset holds, per shard, the first seq not read yet. The option
  `start` says where a new query begins: TRIM_HORIZON (the default), LATEST, AT_SEQUENCE_NUMBER, AFTER_SEQUENCE_NUMBER or AT_TIMESTAMP, the
  last three with the option `at`. A shard that appears later is read from its beginning. A query that is started again goes on from
  its checkpoint. With `recordsPerBatch` a micro-batch has so many records, dealt over the shards that have any, and the last one what is left;
  records with one seq stay together. The option `positions` names a folder for the end of the last planned batch, which such a query
  needs to go on.
* writing, `df.writeStream.format("shard_log").option("shards", n).start(folder)`: rows (key, value) or (key, value, ts) go to the shard that the
  key names, numbered by batch and place. Files are written beside the log; a manifest per batch makes all of them part of it at once, so
  a task or batch that runs again leaves no record twice. Only files in manifests are read where there are manifests.

The driver lists files and reads their footers, each once; only the row groups in which a batch ends are opened there, for their seq alone.
"""

from __future__ import annotations

import json
import time
import uuid
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, DataSourceStreamWriter, InputPartition, WriterCommitMessage

FORMAT = "shard_log"
SCHEMA = "shard long, seq long, ts long, value string"
MANIFESTS, POSITIONS = "_manifests", "positions.json"
STARTS = ("TRIM_HORIZON", "LATEST", "AT_SEQUENCE_NUMBER", "AFTER_SEQUENCE_NUMBER", "AT_TIMESTAMP")
FIRST_SEQ = -(1 << 63)
FILE_ROWS = 1 << 16
#: A batch's records get seq from batch << BATCH_BITS on, a task's from there plus task << TASK_BITS.
BATCH_BITS, TASK_BITS = 40, 24


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path on it."""
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def write_whole(files: pafs.FileSystem, path: str, text: str) -> None:
    """A file that is there in full or not at all."""
    part = f"{path}.{uuid.uuid4().hex}"
    with files.open_output_stream(part) as out:
        out.write(text.encode())
    files.move(part, path)


class RowGroup(NamedTuple):
    path: str
    number: int
    rows: int
    first: int
    last: int
    latest: int  # the highest ts


class Log:
    """The row groups of a log, by shard; a file's footer is read once."""

    def __init__(self, path: str):
        self.files, self.path = opened(path)
        self.known: dict[str, list[RowGroup]] = {}

    def listed(self) -> list[str]:
        manifests = self.files.get_file_info(pafs.FileSelector(f"{self.path}/{MANIFESTS}", allow_not_found=True))
        if manifests:
            names = []
            for info in manifests:
                if info.path.endswith(".json"):
                    with self.files.open_input_stream(info.path) as held:
                        names += [f"{self.path}/{name}" for name in json.loads(held.read())["files"]]
            return names
        found = self.files.get_file_info(pafs.FileSelector(self.path, recursive=True, allow_not_found=True))
        return [x.path for x in found if x.path.endswith(".parquet") and "/shard=" in x.path and "/_" not in x.path[len(self.path) :]]

    def shards(self) -> dict[str, list[RowGroup]]:
        out: dict[str, list[RowGroup]] = {}
        for path in sorted(self.listed()):
            if path not in self.known:
                self.known[path] = list(self.row_groups(path))
            if self.known[path]:
                out.setdefault(path.split("/shard=")[1].split("/")[0], []).extend(self.known[path])
        return {shard: sorted(out[shard], key=lambda g: (g.first, g.path)) for shard in sorted(out, key=int)}

    def row_groups(self, path: str) -> Iterator[RowGroup]:
        footer = pq.read_metadata(path, filesystem=self.files)
        at = {footer.schema.column(k).name: k for k in range(len(footer.schema))}
        for number in range(footer.num_row_groups):
            group = footer.row_group(number)
            seq, ts = (group.column(at[c]).statistics for c in ("seq", "ts"))
            if group.num_rows:
                yield RowGroup(path, number, group.num_rows, seq.min, seq.max, ts.max if ts is not None and ts.has_min_max else FIRST_SEQ)

    def read(self, group: RowGroup, *columns: str) -> pa.Table:
        with self.files.open_input_file(group.path) as held:
            return pq.ParquetFile(held).read_row_group(group.number, columns=list(columns))

    def after(self, groups: list[RowGroup], start: int, most: int) -> tuple[int, int]:
        """Where a read from `start` that takes `most` records ends, and how many it takes; records of one seq stay together."""
        held, wanted = np.zeros(0, np.int64), sorted((g for g in groups if g.last >= start), key=lambda g: g.first)
        for g in wanted:
            if len(held) >= most and held[most - 1] < g.first:
                break
            seq = self.read(g, "seq")["seq"].to_numpy()
            held = np.sort(np.concatenate((held, seq[seq >= start])))
        if not len(held) or most <= 0:
            return start, 0
        end = int(held[min(most, len(held)) - 1]) + 1
        return end, bisect_left(held, end)

    def first_at(self, groups: list[RowGroup], moment: int) -> int:
        """The first seq with a ts of `moment` or later; behind all if there is none."""
        best = max(g.last for g in groups) + 1
        for g in sorted((g for g in groups if g.latest >= moment), key=lambda g: g.first):
            if g.first >= best:
                break
            rows = self.read(g, "seq", "ts")
            seq = rows["seq"].to_numpy()[rows["ts"].to_numpy() >= moment]
            best = min(best, int(seq.min()))
        return best


class Slice(InputPartition):
    """Row groups of one file and the range of seq that is read from them."""

    def __init__(self, shard: int, groups: list[RowGroup], begin: int, end: int):
        self.shard, self.groups, self.begin, self.end = shard, groups, begin, end


class ShardReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.start, self.at = options.get("start", "TRIM_HORIZON").upper(), options.get("at")
        if self.start not in STARTS:
            raise ValueError(f"unknown start position {self.start}")
        if self.start.startswith("A") and self.at is None:
            raise ValueError(f"the start position {self.start} needs the option `at`")
        self.most = int(options["recordsPerBatch"]) if options.get("recordsPerBatch") else None
        self.positions = options.get("positions")
        if self.most is not None and not self.positions:
            raise ValueError("recordsPerBatch needs the option `positions`")
        self.planned: dict | None = None
        self.first: dict | None = None
        self.log: Log | None = None

    def held(self) -> Log:
        self.log = self.log or Log(self.path)
        return self.log

    def initialOffset(self) -> dict:
        """Found once, as Spark asks for the end of the first batch before its start."""
        if self.first is not None:
            return self.first
        log, out = self.held(), {}
        for shard, groups in log.shards().items():
            if self.start == "LATEST":
                out[shard] = max(g.last for g in groups) + 1
            elif self.start == "AT_TIMESTAMP":
                out[shard] = log.first_at(groups, int(self.at))
            elif self.start != "TRIM_HORIZON":
                out[shard] = int(self.at) + (self.start == "AFTER_SEQUENCE_NUMBER")
        self.first = out
        return out

    def position(self) -> dict:
        """The end of the last planned batch; where the query begins if there is none."""
        if self.planned is None and self.positions:
            files, folder = opened(self.positions)
            if files.get_file_info(f"{folder}/{POSITIONS}").type != pafs.FileType.NotFound:
                with files.open_input_stream(f"{folder}/{POSITIONS}") as held:
                    self.planned = json.loads(held.read())
        return self.initialOffset() if self.planned is None else self.planned

    def latestOffset(self) -> dict:
        log, known = self.held(), self.position()
        shards = log.shards()
        if self.most is None:
            return known | {shard: max(known.get(shard, FIRST_SEQ), max(g.last for g in groups) + 1) for shard, groups in shards.items()}
        end, left = dict(known), self.most
        waiting = [s for s in shards if max(g.last for g in shards[s]) >= known.get(s, FIRST_SEQ)]
        while left > 0 and waiting:
            share, more = divmod(left, len(waiting))
            for k, shard in enumerate(list(waiting)):
                begin = end.get(shard, FIRST_SEQ)
                to, taken = log.after(shards[shard], begin, min(left, share + (k < more)))
                if taken:
                    end[shard], left = to, left - taken
                if max(g.last for g in shards[shard]) < end.get(shard, FIRST_SEQ):
                    waiting.remove(shard)
        return end

    def partitions(self, start: dict, end: dict) -> list[Slice]:
        behind = [s for s in start if end.get(s, FIRST_SEQ) < start[s]]
        if behind:
            raise RuntimeError(f"the positions of shards {behind} lie before the checkpoint; use one folder for `positions` per query")
        self.planned = end
        if self.positions:
            files, folder = opened(self.positions)
            files.create_dir(folder, recursive=True)
            write_whole(files, f"{folder}/{POSITIONS}", json.dumps(end))
        out = []
        for shard, groups in self.held().shards().items():
            begin, upto = start.get(shard, FIRST_SEQ), end.get(shard, FIRST_SEQ)
            by_file: dict[str, list[RowGroup]] = {}
            for g in groups:
                if g.last >= begin and g.first < upto:
                    by_file.setdefault(g.path, []).append(g)
            out += [Slice(int(shard), sorted(own, key=lambda g: g.number), begin, upto) for own in by_file.values()]
        return out

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        log = Log(self.path)
        for group in partition.groups:
            rows = log.read(group, "seq", "ts", "value")
            seq = rows["seq"].to_numpy()
            rows = rows.filter(pa.array((seq >= partition.begin) & (seq < partition.end)))
            shard = pa.array(np.full(rows.num_rows, partition.shard))
            yield from pa.table([shard, *(rows[c].cast(kind) for c, kind in (("seq", pa.int64()), ("ts", pa.int64()), ("value", pa.string())))], names=["shard", "seq", "ts", "value"]).to_batches()


class Put(WriterCommitMessage):
    """The files that a task wrote."""

    def __init__(self, files: list[str]):
        self.files = files


class ShardWriter(DataSourceStreamWriter):
    """Task files have names of their own, and only a batch's manifest makes them part of the log."""

    def __init__(self, options: dict):
        self.path, self.shards = options["path"], int(options.get("shards", 4))

    def write(self, iterator: Iterator) -> Put:
        files, base = opened(self.path)
        context = TaskContext.get()
        batch = int(context.getLocalProperty("streaming.sql.batchId") or 0)
        seq = (batch << BATCH_BITS) + (context.partitionId() << TASK_BITS)
        held: dict[int, list[tuple]] = {}
        names: list[str] = []

        def store(shard: int) -> None:
            name = f"shard={shard}/batch-{batch}-{uuid.uuid4().hex}.parquet"
            files.create_dir(f"{base}/shard={shard}", recursive=True)
            columns = [pa.array(x, kind) for x, kind in zip(zip(*held.pop(shard)), (pa.int64(), pa.int64(), pa.string()))]
            pq.write_table(pa.table(columns, names=["seq", "ts", "value"]), f"{base}/{name}", filesystem=files)
            names.append(name)

        for row in iterator:
            values = row.asDict()
            shard = zlib.crc32((values["key"] or "").encode()) % self.shards
            moment = values.get("ts")
            held.setdefault(shard, []).append((seq, int(time.time() * 1000) if moment is None else moment, values["value"]))
            seq += 1
            if len(held[shard]) >= FILE_ROWS:
                store(shard)
        for shard in sorted(held):
            store(shard)
        return Put(names)

    def commit(self, messages: list, batchId: int) -> None:
        files, base = opened(self.path)
        files.create_dir(f"{base}/{MANIFESTS}", recursive=True)
        manifest = f"{base}/{MANIFESTS}/{batchId}.json"
        names = [name for m in messages if m is not None for name in m.files]
        if files.get_file_info(manifest).type != pafs.FileType.NotFound:
            self.drop(names)  # this batch was put before its query was stopped
        else:
            write_whole(files, manifest, json.dumps({"files": names}))

    def abort(self, messages: list, batchId: int) -> None:
        self.drop([name for m in messages if m is not None for name in m.files])

    def drop(self, names: list[str]) -> None:
        files, base = opened(self.path)
        for name in names:
            files.delete_file(f"{base}/{name}")


class ShardLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> ShardReader:
        return ShardReader(self.options)

    def streamWriter(self, schema, overwrite: bool) -> ShardWriter:
        return ShardWriter(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ShardLog)


def write_shards(records, path: str, mode: str = "append") -> None:
    """A table (shard, seq, ts, value) as such a log; rows of a shard in the order of seq."""
    records.select("shard", "seq", "ts", "value").repartition("shard").sortWithinPartitions("shard", "seq").write.mode(mode).partitionBy("shard").parquet(path)


def stream_shards(spark: SparkSession, path: str, start: str = "TRIM_HORIZON", at: int | None = None, records_per_batch: int | None = None, positions: str | None = None):
    """The log as a stream of (shard, seq, ts, value)."""
    register(spark)
    reader = spark.readStream.format(FORMAT).option("start", start)
    for name, value in (("at", at), ("recordsPerBatch", records_per_batch), ("positions", positions)):
        if value is not None:
            reader = reader.option(name, str(value))
    return reader.load(path)


def put_records(records, path: str, checkpoint: str, shards: int = 4):
    """A stream of (key, value) or (key, value, ts), as `writers.keyed_records` gives it, put to the log."""
    register(records.sparkSession)
    return records.writeStream.format(FORMAT).option("shards", str(shards)).option("path", path).option("checkpointLocation", checkpoint)
