"""Writers for corpora, vocabularies and outgoing events."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodgauge.operators.filters import not_blank
from moodgauge.operators.labelling import CLASS_NAMES
from moodgauge.operators.vocabulary import vocabulary_as_list


def write_event_lines(events: DataFrame, path: str, mode: str = "append") -> None:
    """One JSON document per line."""
    events.write.mode(mode).json(path)


def partition_key(value: Column) -> Column:
    """Key of a record from its characters 74 to 200; unlike a salted hash the same in every process."""
    return F.md5(F.substring(value, 74, 127))


def keyed_records(raw: DataFrame, value: str = "value", keep=()) -> DataFrame:
    """(key, value) of every record that is not blank, as a stream sink takes them, and the columns to keep."""
    kept = raw.filter(not_blank(F.col(value)))
    return kept.select(partition_key(F.col(value)).alias("key"), F.col(value).alias("value"), *keep)


def send_to_topic(records: DataFrame, servers: str, topic: str) -> None:
    """Put keyed records to a Kafka topic. Needs Spark's Kafka package."""
    records.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def write_json_lines(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Distinct rows as gzip JSON lines; null fields are kept."""
    rows = df.dropDuplicates()
    rows.write.mode(mode).option("compression", "gzip").option("ignoreNullFields", "false").json(path)


def write_labelled_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Headerless (labels, text) with quotes doubled inside text."""
    rows = df.select("labels", "text").write.mode(mode)
    # spaces around a text are part of it
    rows = rows.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    rows.csv(path, header=False, quote='"', escape='"', quoteAll=True)


def write_encoded(encoded: DataFrame, vocabulary: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Token ids with their labels, and the vocabulary both as a table and as one list."""
    encoded.write.mode(mode).parquet(f"{path}/ids")
    vocabulary.write.mode(mode).parquet(f"{path}/vocabulary")
    vocabulary_as_list(vocabulary).write.mode(mode).parquet(f"{path}/vocabulary_list")


def write_class_names(spark, path: str, names=CLASS_NAMES, mode: str = "overwrite") -> None:
    """One class name per line, in label order."""
    spark.createDataFrame([(n,) for n in names], "value string").coalesce(1).write.mode(mode).text(path)
