"""Exact de-duplication as a stateful stream: keyed state on disk, without expiry, holds one row per digest.

Every row becomes a narrow record (digest, doc_id, content locator). A stream reads the records; its RocksDB state keeps, per
digest, the smallest (doc_id, locator) and the number of rows, for ever. With a folder of one's own for the state, a later run over a table that has
grown by files adds only the records of new rows and goes on from there.

Rows whose digest was hit more than once are then compared by their full bytes. A bitmap of fixed size tells which rows these may be
before their bytes are shuffled, and the comparison is an aggregate that combines before the shuffle, so a group of any size arrives as one
row per task; what the bitmap let through beside them goes then. Digests of a large share of all rows are joined by a broadcast. Only DataFrame and
SQL functions touch the rows.

Defined cases: a null text is empty; a null doc_id comes after all others; of equal texts with equal doc_ids the one first by
(file, row) stays; further columns are ignored, and kept by `without_copies`, whatever their names; a frame that is no scan of files is written
first; an empty table gives an empty result. A text is one value of Spark's, so it may have up to 2 GB and must fit a task some four times.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodgauge.llm.tables import joined_by_key, locator, rows_without, scanned, stored
from moodgauge.session import scratch_path

# bits that tell digests with hits: 2,048 rows of 4 KB
HIT_BITS = 1 << 26
RECORDS = "doc_id long, locator string, digest binary"
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "4",
    # else each partition of the state reserves some MB of disk before it holds a row
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    # a partition's state leaves the executor with its task
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}


def normalised(text: Column | str = "text") -> Column:
    """Each run of white space as one space; null as empty."""
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def identifier() -> Column:
    """Orders rows by doc_id, nulls last, then by place."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "locator")


def located(docs: DataFrame) -> DataFrame:
    """doc_id, text and locator of each row."""
    docs = scanned(docs)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), locator(docs).alias("locator"))


def land(records: DataFrame, base: str) -> DataFrame:
    """All records below the base, once those that are new are added."""
    spark, landing = records.sparkSession, f"{base}/records"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(landing)
    if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        records = records.join(spark.read.schema(RECORDS).parquet(landing).select("locator"), "locator", "left_anti").select("doc_id", "locator", "digest")
    records.write.mode("append").parquet(landing)
    return spark.read.schema(RECORDS).parquet(landing)


def keep_state(records: DataFrame, base: str) -> DataFrame:
    """Runs the stream over the records below the base to their end and returns its state: digest, first (no_id, doc_id, locator), hits."""
    spark, checkpoint = records.sparkSession, f"{base}/checkpoint"
    session = spark.newSession()
    for key, value in STATE_STORE.items():
        session.conf.set(key, value)
    session.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    stream = session.readStream.schema(records.schema).parquet(f"{base}/records")
    state = stream.groupBy("digest").agg(F.min(identifier()).alias("first"), F.count("*").alias("hits"))
    state.writeStream.outputMode("update").format("noop").option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    if records.isEmpty():  # no records, no state
        return records.groupBy("digest").agg(F.min(identifier()).alias("first"), F.count("*").alias("hits"))
    kept = session.read.format("statestore").load(checkpoint)
    first, hits = (F.col("value").getField(name) for name in kept.schema["value"].dataType.names)
    path = scratch_path(spark, "digests")
    kept.select("key.digest", first.alias("first"), hits.alias("hits")).write.parquet(path)
    return spark.read.parquet(path)


def may_be_hit(rows: DataFrame, hits: DataFrame) -> DataFrame:
    """The rows with a digest of `hits`, and few others, by a bitmap of fixed size; no row is shuffled."""
    bit = F.pmod(F.xxhash64("digest"), F.lit(HIT_BITS)) + 1
    bitmaps = hits.select(bit.alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bitmap"))
    place = F.bitmap_bit_position(bit)
    byte = F.conv(F.hex(F.substring("bitmap", (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    held = F.expr("shiftright(byte, int(place % 8)) & 1") == 1
    marked = rows.withColumn("bucket", F.bitmap_bucket_number(bit)).join(F.broadcast(bitmaps), "bucket")
    return marked.withColumns({"byte": byte, "place": place}).filter(held).drop("bucket", "bitmap", "byte", "place")


def exact_groups(docs: DataFrame, digest: Callable[[Column], Column] = sha256, state_dir: str | None = None) -> DataFrame:
    """One row per document: doc_id, locator, digest, keep_id, keep_locator, group_size.

    Digests only find the hits; texts are equal when their full normalised bytes are, so a weaker digest gives the same groups.
    With `state_dir`, a shared folder, the state stays there, and a later run over the same table with more files goes on from it.
    """
    rows, base = located(docs), state_dir or scratch_path(docs.sparkSession, "dedup-state")
    records = land(rows.select("doc_id", "locator", digest(normalised()).alias("digest")), base)
    state = keep_state(records, base)
    hits = state.filter("hits > 1").select("digest")
    full = rows.select("doc_id", "locator", normalised().alias("body")).withColumn("digest", digest(F.col("body")))
    bodies = may_be_hit(full, hits).groupBy("digest", "body").agg(F.min(identifier()).alias("first"), F.count("*").alias("n"))
    groups = stored(bodies.join(hits, "digest", "left_semi").select("digest", "first", "n", "body"), "hit-groups")
    clash = groups.groupBy("digest").agg(F.count("*").alias("bodies"), F.first("first").alias("first"), F.first("n").alias("n"))
    plain = clash.filter("bodies = 1").select("digest", "first", "n")
    every = plain.unionByName(state.filter("hits = 1").select("digest", "first", F.col("hits").alias("n")))
    mapped = joined_by_key(records, every, "digest", state.select("digest", F.col("hits").alias("n")), records.count())
    clashing = clash.filter("bodies > 1").select("digest")
    if not clashing.isEmpty():
        # different bytes under one digest: these rows are matched by their bytes
        body = full.join(clashing, "digest", "left_semi").join(groups.select("digest", "body", "first", "n"), ["digest", "body"])
        mapped = mapped.unionByName(body.select("digest", "doc_id", "locator", "first", "n"))
    return mapped.select(
        "doc_id", "locator", "digest", F.col("first.doc_id").alias("keep_id"), F.col("first.locator").alias("keep_locator"), F.col("n").alias("group_size")
    )


def exact_dedup(docs: DataFrame) -> DataFrame:
    """One row per document, dropped ones too: doc_id, keep_id, group_size, kept, text_sha256."""
    groups = exact_groups(docs)
    return groups.select(
        "doc_id", "keep_id", "group_size", (F.col("locator") == F.col("keep_locator")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")
    )


def without_copies(docs: DataFrame) -> DataFrame:
    """The rows that stay, with all their columns."""
    docs = scanned(docs)
    return rows_without(docs, exact_groups(docs).filter("locator <> keep_locator"))


SQL = r"""
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = min(doc_id) OVER same AS kept, sha256(body) AS text_sha256
FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents)
WINDOW same AS (PARTITION BY body)
"""
