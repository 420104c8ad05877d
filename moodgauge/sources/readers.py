"""Batch and stream readers for events, corpora and account lists."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodgauge import schemas
from moodgauge.functions.moments import as_ms
from moodgauge.functions.text import split_label_prefix
from moodgauge.operators.filters import not_blank
from moodgauge.sources.concatenated import read_records, records_of

BAD_RECORD = "_corrupt"


def _with_bad_record(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(BAD_RECORD, T.StringType(), True)])


def read_events(spark: SparkSession, path: str, schema: T.StructType = schemas.EVENT) -> DataFrame:
    """Events of JSON files, several on a line or one over several lines; a malformed one becomes a row with its text in `_corrupt`.

    Records are text first and parsed as a column, so that queries on `_corrupt` alone work as well.
    """
    return parse_records(read_records(spark, path), schema=schema)


def stream_events(spark: SparkSession, path: str, schema: T.StructType = schemas.EVENT,
                  files_per_trigger: int | None = None) -> DataFrame:
    """The same as a stream over a folder; the trigger of the query replaces polling.

    A record must end on the line it begins on, else its parts are malformed; `concatenated.each_batch` reads those as well.
    """
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return parse_records(reader.text(path), schema=schema)


def stream_topic(spark: SparkSession, servers: str, topic: str, starting="latest", **options) -> DataFrame:
    """Raw records of a Kafka topic as (value, shard, seq, ts). Needs Spark's Kafka package."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
    reader = reader.option("subscribe", topic).option("startingOffsets", starting)
    for name, value in options.items():
        reader = reader.option(name, value)
    return reader.load().select(
        F.col("value").cast("string").alias("value"),
        F.col("partition").alias("shard"),
        F.col("offset").alias("seq"),
        F.unix_millis("timestamp").alias("ts"),
    )


def parse_records(raw: DataFrame, value: str = "value", schema: T.StructType = schemas.EVENT) -> DataFrame:
    """Text records to events: blank ones are skipped, malformed ones carry their text in `_corrupt`.

    A text of several objects gives a row for each.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_RECORD}
    rest = [F.col(f"`{c}`") for c in raw.columns if c != value]
    records = raw.filter(not_blank(F.col(value))).select(*rest, F.explode(records_of(F.col(value))).alias("_record"))
    good = F.from_json(F.col("_record"), _with_bad_record(schema), options)
    # the text of an event is one object
    no_object = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields], F.col("_record").alias(BAD_RECORD))
    parsed = F.when(F.startswith(F.col("_record"), F.lit("{")), good).otherwise(no_object).alias("_event")
    return records.select(*rest, parsed).select(*rest, "_event.*")


def good_events(events: DataFrame) -> DataFrame:
    return events.filter(F.col(BAD_RECORD).isNull()).drop(BAD_RECORD)


def bad_records(events: DataFrame) -> DataFrame:
    return events.filter(F.col(BAD_RECORD).isNotNull()).select(F.col(BAD_RECORD).alias("value"))


def canonical_lines(raw: DataFrame, value: str = "value", schema: T.StructType = schemas.EVENT) -> DataFrame:
    """Valid records only, each as one line of JSON."""
    return event_lines(good_events(parse_records(raw.select(value), value, schema)))


def event_lines(events: DataFrame) -> DataFrame:
    return events.select(F.to_json(F.struct("*")).alias("value"))


def replay_from(records: DataFrame, position: str, value=None, seq: str = "seq", ts: str = "ts") -> DataFrame:
    """Records from a start position of a stream table on.

    TRIM_HORIZON: all. AT_TIMESTAMP: at or after. AT_SEQUENCE_NUMBER: from it on.
    AFTER_SEQUENCE_NUMBER: behind it. LATEST: behind `value`, the last number known at the start; as
    nothing new has come yet, that leaves none when `value` is not given.
    """
    if position == "TRIM_HORIZON":
        return records
    if position == "AT_TIMESTAMP":
        return records.filter(F.col(ts) >= as_ms(value))
    bound = value if isinstance(value, Column) else F.lit(value)
    if position == "AT_SEQUENCE_NUMBER":
        return records.filter(F.col(seq) >= bound)
    if position == "AFTER_SEQUENCE_NUMBER":
        return records.filter(F.col(seq) > bound)
    if position == "LATEST":
        last = records.agg(F.max(seq)).scalar() if value is None else bound
        return records.filter(F.col(seq) > last)
    raise ValueError(f"unknown start position {position}")


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines, plain or gzip."""
    return spark.read.schema(schema).json(path)


def read_labelled_csv(spark: SparkSession, path: str) -> DataFrame:
    """Headerless (labels, text); quoted text may span lines."""
    return spark.read.schema(schemas.LABELLED_TEXT).csv(path, header=False, quote='"', escape='"', multiLine=True)


def read_label_prefixed(spark: SparkSession, path: str) -> DataFrame:
    """`__label__1 text` lines as (labels, text). Every line is read."""
    label, body = split_label_prefix(F.col("value"))
    return spark.read.text(path).select(label.alias("labels"), body.alias("text"))


def read_accounts(spark: SparkSession, path: str) -> DataFrame:
    return read_json_lines(spark, path, schemas.ACCOUNTS)


def read_topic_posts(spark: SparkSession, path: str) -> DataFrame:
    return read_json_lines(spark, path, schemas.TOPIC_POSTS)


def query_store(spark: SparkSession, statement: str, jdbc_url: str | None = None, **options) -> DataFrame:
    """Result of a SQL statement: in this session, or in an external store through JDBC."""
    if jdbc_url is None:
        return spark.sql(statement)
    return spark.read.format("jdbc").option("url", jdbc_url).option("query", statement).options(**options).load()
