"""Reading the given tables and cutting lineage, for the operators of this folder."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodgauge.session import scratch_path

# labels are learnt from rows outside this fifth
HELD_OUT = "crc32(cast(cast(doc_id as string) as binary)) % 5 = 0"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, **options) -> DataFrame:
    """The frame written to the shared folder and read again: later steps neither recompute it nor depend on an executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, **options)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, most: int = 1 << 16) -> DataFrame:
    """A stored table with a broadcast hint if it has few rows; beyond that the planner joins as it sees fit."""
    return F.broadcast(df) if df.count() <= most else df


def scanned(docs: DataFrame) -> DataFrame:
    """A plain scan of files as it is; any other frame is written to the shared folder first, so that its rows have a place."""
    try:
        if docs.inputFiles():
            docs.select(docs.metadataColumn("_metadata"))
            return docs
    except AnalysisException:  # derived from files, but no scan of them
        pass
    return stored(docs, "scanned")


def mapped_rows(docs: DataFrame, work, added: str | None = None) -> DataFrame:
    """`work` over Arrow batches with all columns of the documents, `text` by its name and the others numbered, whatever their names are.

    It gives the same columns, and one of doubles after them if `added` names it.
    """
    numbered = docs.toDF(*["text" if c == "text" else f"c{k}" for k, c in enumerate(docs.columns)])
    if added is None:
        return numbered.mapInArrow(work, numbered.schema).toDF(*docs.columns)
    return numbered.mapInArrow(work, numbered.withColumn("added", F.lit(0.0)).schema).toDF(*docs.columns, added)


def locator(docs: DataFrame) -> Column:
    """The place of each row of a scan, whatever the names of its columns are."""
    place = docs.metadataColumn("_metadata")
    return F.concat_ws("#", place.getField("file_path"), place.getField("row_index"))


def rows_without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of a scan, with all their columns, whose locator is not in `gone` (locator)."""
    held = docs.select(F.struct("*").alias("row"), locator(docs).alias("place"))
    return held.join(gone.select("locator"), F.col("place") == F.col("locator"), "left_anti").select("row.*")


# a key that holds this share of the rows is hot; there are at most so many of them
HOT_SHARE = 1024


def joined_by_key(left: DataFrame, right: DataFrame, key: str, sizes: DataFrame, rows: int) -> DataFrame:
    """left joined with right, which has each key once. Hot keys, at most HOT_SHARE of them, are broadcast; sizes: (key, n) of left."""
    hot = sizes.filter(F.col("n") * HOT_SHARE >= rows).select(key)
    if hot.isEmpty():
        return left.join(right, key)
    of_hot = stored(right.join(F.broadcast(hot), key, "left_semi"), "hot-keys")
    some = left.join(F.broadcast(of_hot.select(key)), key, "left_anti").join(right, key)
    return some.unionByName(left.join(F.broadcast(of_hot), key))


def drop(*frames: DataFrame) -> None:
    """Deletes tables that `stored` made and that nothing reads any more."""
    for df in frames:
        context = df.sparkSession.sparkContext
        for path in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
            target = context._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)


def held_out(doc_id="doc_id"):
    """True for the fifth of documents from which no label is learnt; a null id counts as the text 'null'."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("null")).cast("binary")) % 5 == 0
