"""Concatenated event files and sharded logs, read, written and streamed."""

from pyspark.sql import functions as F

from moodgauge.plans import tables as t
from moodgauge.plans.events import _LINE, _RECORDS, _records
from moodgauge.plans.registry import query
from moodgauge.session import scratch_path
from moodgauge.sources import concatenated, readers, shards, writers

# Of 13 events one lacks its last two braces and one its end with a closing quote; one of 5 is written over several lines
_BROKEN = "event_id % 13 IN (5, 9)"
_TEXTS = f"""
lines AS (SELECT event_id, event_type, props, (epoch_us(ts) // 1000) AS ms, {_LINE} AS line FROM events),
texts AS (SELECT *, CASE event_id % 13 WHEN 9 THEN left(line, length(line) - 2) WHEN 5 THEN left(line, length(line) - 4) END AS cut FROM lines)"""

_CONCATENATED = f"""WITH {_TEXTS}
SELECT event_type AS msgType, ms AS clientReceivedTsMs, event_id AS id, props AS text, NULL AS broken FROM texts WHERE cut IS NULL
UNION ALL SELECT NULL, NULL, NULL, NULL, cut FROM texts WHERE cut IS NOT NULL"""


def _concatenated_files(spark, sf_dir) -> str:
    """A folder of such files: eight events follow each other, on one line where they can."""
    events = t.table(spark, sf_dir, "events")
    line = F.to_json(
        F.struct(
            F.lit("posts-common").alias("schema"), F.col("event_type").alias("msgType"), t.event_ms().alias("clientReceivedTsMs"),
            F.struct(F.col("event_id").alias("id"), F.col("props").alias("text")).alias("data"),
        )
    )
    number, text = F.col("event_id"), F.col("line")
    kept = F.when(number % 13 == 9, F.expr("left(line, length(line) - 2)")).when(number % 13 == 5, F.concat(F.expr("left(line, length(line) - 4)"), F.lit("\n")))
    several = F.when(number % 5 == 0, F.regexp_replace(text, r',"(msgType|data)":', ',\n  "$1":\n')).otherwise(text)
    texts = events.withColumn("line", line).select("event_id", F.coalesce(kept, several).alias("text"))
    groups = texts.groupBy(F.floor(number / 8)).agg(F.array_sort(F.collect_list(F.struct("event_id", "text"))).alias("e"))
    path = scratch_path(spark, "concatenated")
    groups.select(F.array_join(F.transform("e", lambda x: x["text"]), "").alias("value")).write.text(path)
    return path


def _events_and_broken(events):
    return events.select("msgType", "clientReceivedTsMs", "data.id", "data.text", F.col(readers.BAD_RECORD).alias("broken"))


@query("concatenated_events", _CONCATENATED)
def concatenated_events(spark, sf_dir):
    """Concatenated objects, over lines and broken ones between: each event and each broken text once."""
    return _events_and_broken(readers.read_events(spark, _concatenated_files(spark, sf_dir)))


@query("concatenated_stream", _CONCATENATED)
def concatenated_stream(spark, sf_dir):
    """The same files as a stream, landed batch by batch."""
    source, out = _concatenated_files(spark, sf_dir), scratch_path(spark, "concatenated-events")

    def land(records, batch_id):
        _events_and_broken(readers.parse_records(records)).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    concatenated.each_batch(spark, source, land, scratch_path(spark, "state"), files_per_trigger=4).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out).drop("batch_id")


def _log_rows(spark, sf_dir):
    return _records(spark, sf_dir).withColumn("value", F.format_string("event %d", "seq"))


_LOG = f"{_RECORDS}, log AS (SELECT shard, seq, ts, 'event ' || seq AS value FROM records)"


@query(
    "stream_shards",
    f"""WITH {_LOG}, half AS (SELECT max(seq) // 2 AS s FROM log)
SELECT 'TRIM_HORIZON' AS start, log.* FROM log
UNION ALL SELECT 'AFTER_SEQUENCE_NUMBER', log.* FROM log, half WHERE seq > s // 2
UNION ALL SELECT 'LATEST', log.* FROM log, half WHERE seq > s""",
)
def stream_shards(spark, sf_dir):
    """A log read half way, stopped, and read on from the checkpoint when its second half has come."""
    rows, path, out = _log_rows(spark, sf_dir), scratch_path(spark, "log"), scratch_path(spark, "log-read")
    half = rows.agg(F.floor(F.max("seq") / 2)).first()[0]
    shards.write_shards(rows.filter(F.col("seq") <= half), path)
    starts = {"TRIM_HORIZON": None, "AFTER_SEQUENCE_NUMBER": half // 2, "LATEST": None}
    checkpoints = {start: scratch_path(spark, "state") for start in starts}
    for more in (None, rows.filter(F.col("seq") > half)):
        if more is not None:
            shards.write_shards(more, path)
        for start, at in starts.items():
            stream = shards.stream_shards(spark, path, start, at).withColumn("start", F.lit(start))
            stream.writeStream.format("parquet").option("path", f"{out}/{start}").option("checkpointLocation", checkpoints[start]).trigger(availableNow=True).start().awaitTermination()
    found = [spark.read.schema("shard long, seq long, ts long, value string, start string").parquet(f"{out}/{start}") for start in starts]
    return found[0].unionByName(found[1]).unionByName(found[2])


@query(
    "stream_batches",
    """WITH n AS (SELECT count(*) AS n, greatest(1, count(*) * 2 // 7) AS most FROM events)
SELECT k AS batch, least(most, n - k * most) AS rows FROM n, generate_series(0, 3) g(k)""",
)
def stream_batches(spark, sf_dir):
    """Micro-batches by record count: n, n, n, and what is left."""
    rows, path, counts = _log_rows(spark, sf_dir), scratch_path(spark, "log"), scratch_path(spark, "batches")
    shards.write_shards(rows, path)
    most = max(1, rows.count() * 2 // 7)
    stream = shards.stream_shards(spark, path, records_per_batch=most, positions=scratch_path(spark, "positions"))

    def count(batch, batch_id):
        batch.agg(F.lit(batch_id).cast("long").alias("batch"), F.count("*").alias("rows")).write.mode("overwrite").parquet(f"{counts}/batch_id={batch_id}")

    run = stream.writeStream.foreachBatch(count).option("checkpointLocation", scratch_path(spark, "state")).start()
    run.processAllAvailable()
    run.stop()
    return spark.read.parquet(counts).select("batch", "rows")


@query(
    "stream_put",
    f"""WITH l AS (SELECT {_LINE} AS value, (epoch_us(ts) // 1000) AS ts FROM events)
SELECT md5(substr(value, 74, 127)) AS key, value, ts FROM l""",
)
def stream_put(spark, sf_dir):
    """Keyed records of a stream put to a log, and read back from its shards."""
    events = t.table(spark, sf_dir, "events")
    source, path = scratch_path(spark, "raw"), scratch_path(spark, "log")
    value = F.to_json(
        F.struct(
            F.lit("posts-common").alias("schema"), F.col("event_type").alias("msgType"), t.event_ms().alias("clientReceivedTsMs"),
            F.struct(F.col("event_id").alias("id"), F.col("props").alias("text")).alias("data"),
        )
    )
    events.select(value.alias("value"), t.event_ms().alias("ts")).repartition(6).write.parquet(source)
    raw = spark.readStream.schema("value string, ts long").option("maxFilesPerTrigger", 2).parquet(source)
    shards.put_records(writers.keyed_records(raw, keep=["ts"]), path, scratch_path(spark, "state")).trigger(availableNow=True).start().awaitTermination()
    out = scratch_path(spark, "log-read")
    stream = shards.stream_shards(spark, path)
    stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", scratch_path(spark, "state")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(shards.SCHEMA).parquet(out).select(writers.partition_key(F.col("value")).alias("key"), "value", "ts")
