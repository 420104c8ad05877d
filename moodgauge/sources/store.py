"""The posts, impact and index tables as folders of batches.

Every micro-batch writes only its own rows, to a folder named after its batch id, so the cost of a
write does not grow with the table, and a batch that is run again overwrites itself. The current row
of a post is the one of its latest batch. Rows lie in day folders of their event time, so a look-back
opens only the days it needs.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from moodgauge import schemas
from moodgauge.operators.impact import apply_impact
from moodgauge.operators.ordering import last_per_key

_BATCH = T.StructField("batch_id", T.LongType(), True)
_DAY = T.StructField("event_date", T.DateType(), True)
IMPACTS = T.StructType(
    [*schemas.ENGAGEMENT.fields, T.StructField("impact", schemas.IMPACT), T.StructField("created_at_epoch_ms", T.LongType())]
)


def day(ms: Column) -> Column:
    return F.to_date(F.timestamp_millis(ms))


class PostStore:
    """Tables of one deployment below a folder all executors share."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _write(self, df: DataFrame, table: str, batch_id: int) -> None:
        dated = df.withColumn("event_date", day(F.col("created_at_epoch_ms")))
        # few files per day, and several for a day that holds most of the batch
        dated = dated.hint("rebalance", F.col("event_date"))
        dated.write.mode("overwrite").partitionBy("event_date").parquet(f"{self.root}/{table}/batch_id={batch_id}")

    def _read(self, table: str, schema: T.StructType, from_ms=None, before_batch=None, to_ms=None) -> DataFrame:
        path = f"{self.root}/{table}"
        full = T.StructType([*schema.fields, _BATCH, _DAY])
        try:
            rows = self.spark.read.schema(full).option("basePath", path).parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = self.spark.createDataFrame([], full)
        if from_ms is not None:
            # the day folder prunes files, the millisecond prunes row groups
            rows = rows.filter((F.col("event_date") >= day(F.lit(from_ms))) & (F.col("created_at_epoch_ms") >= from_ms))
        if to_ms is not None:
            rows = rows.filter((F.col("event_date") <= day(F.lit(to_ms))) & (F.col("created_at_epoch_ms") <= to_ms))
        if before_batch is not None:
            rows = rows.filter(F.col("batch_id") < before_batch)
        return rows

    # -- posts

    def append_posts(self, posts: DataFrame, batch_id: int) -> None:
        """Rows of one batch, at most one per post."""
        self._write(posts, "posts", batch_id)

    def posts(self, from_ms=None, before_batch: int | None = None) -> DataFrame:
        """The current row of every post, with its latest impact."""
        rows = self._read("posts", schemas.POSTS, from_ms, before_batch)
        current = last_per_key(rows.drop("event_date"), ["post_type", "post_id"], ["batch_id"]).drop("batch_id")
        return apply_impact(current, self.impacts(from_ms, before_batch))

    def post_keys(self, before_batch: int | None = None, from_ms=None, to_ms=None) -> DataFrame:
        """(post_type, post_id) of stored posts created in a span; reads no other column.

        The event time of a post never changes, so the span of a batch's posts is enough to tell
        which of them are stored. The bounds may be scalar subqueries: they prune day folders.
        """
        return self._read("posts", schemas.POSTS, from_ms, before_batch, to_ms).select("post_type", "post_id")

    # -- impact

    def append_impacts(self, impacts: DataFrame, batch_id: int) -> None:
        self._write(impacts, "impacts", batch_id)

    def impacts(self, from_ms=None, before_batch: int | None = None) -> DataFrame:
        """Latest known engagement and impact per post."""
        rows = self._read("impacts", IMPACTS, from_ms, before_batch)
        keys = ["post_type", "message_id"]
        return last_per_key(rows.drop("event_date"), keys, ["batch_id"]).drop("batch_id")

    def impacts_of(self, batch_id: int) -> DataFrame:
        """What one batch changed."""
        return self._read("impacts", IMPACTS).filter(F.col("batch_id") == batch_id)

    # -- indices

    def append_indices(self, rows: DataFrame, batch_id: int) -> None:
        self._write(rows, "indices", batch_id)

    def indices(self, from_ms=None, before_batch: int | None = None) -> DataFrame:
        """Published index rows; a moment published twice counts once."""
        rows = self._read("indices", schemas.GLOBAL_SENTIMENT, from_ms, before_batch)
        keys = ["sentiment_type", "sentiment_seconds_back", "created_at_epoch_ms"]
        return last_per_key(rows.drop("event_date"), keys, ["batch_id"]).drop("batch_id")

    def compact(self, other_root: str, upto_batch: int) -> "PostStore":
        """A store elsewhere that holds the state after `upto_batch` as one batch, for readers to move to."""
        other = PostStore(self.spark, other_root)
        end = upto_batch + 1
        rows = self._read("posts", schemas.POSTS, None, end).drop("event_date")
        posts = last_per_key(rows, ["post_type", "post_id"], ["batch_id"]).drop("batch_id")
        other._write(posts, "posts", upto_batch)
        other._write(self.impacts(before_batch=end), "impacts", upto_batch)
        other._write(self.indices(before_batch=end), "indices", upto_batch)
        return other
