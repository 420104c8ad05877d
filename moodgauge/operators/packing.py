"""Token sequences to training batches: fixed-length blocks, length-sorted batches, padding."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodgauge.operators.ordering import number_rows, running_totals, shuffle_number, whole
from moodgauge.operators.vocabulary import PAD_ID

# Tokens per block and parallel lanes of the language-model loader.
BLOCK, LANES = 70, 52


def _size(ids: str) -> Column:
    return F.coalesce(F.size(ids), F.lit(0))


def _sized(docs: DataFrame, key: str, ids: str) -> DataFrame:
    return docs.select(key, ids, F.size(ids).cast("bigint").alias("_size")).filter("_size > 0")


def pack(docs: DataFrame, key: str, ids: str = "ids", block: int = BLOCK, lanes: int = 1) -> DataFrame:
    """(lane, block, ids): all documents in key order as one sequence, cut to `block` ids each.

    With `lanes` above one the sequence is first cut into that many equally long lanes, and the few
    ids beyond the last full lane are left out as the loader does. Each document is cut into the
    pieces it gives to each block, so whole pieces travel, not single tokens, and no block gets more
    than `block` ids.
    """
    sized = _sized(docs, key, ids)
    starts = running_totals(sized.select(key, "_size"), key, {"_size": "_start"})
    # position -> (lane, block): lanes of equal length, blocks counted inside each
    total = sized.agg(F.sum("_size").alias("n")).scalar()
    lane_len = whole(total, lanes)
    placed = sized.join(starts.select(key, "_start"), key).withColumn("_lane_len", lane_len)
    placed = placed.withColumn("_per_lane", whole(F.col("_lane_len") + block - 1, block))
    end = F.col("_start") + F.col("_size")
    placed = placed.withColumn("_end", F.least(end, F.col("_lane_len") * lanes)).filter("_start < _end")

    def slot(position: Column) -> Column:
        lane = whole(position, F.col("_lane_len"))
        inside = position - lane * F.col("_lane_len")
        return lane * F.col("_per_lane") + whole(inside, block)

    pieces = placed.select(
        ids, "_start", "_end", "_lane_len", "_per_lane",
        F.explode_outer(F.sequence(slot(F.col("_start")), slot(F.col("_end") - 1))).alias("_slot"),
    )
    lane = whole(F.col("_slot"), F.col("_per_lane"))
    number = F.col("_slot") - lane * F.col("_per_lane")
    slot_start = lane * F.col("_lane_len") + number * block
    slot_end = F.least(slot_start + block, (lane + 1) * F.col("_lane_len"))
    first, last = F.greatest(F.col("_start"), slot_start), F.least(F.col("_end"), slot_end)
    pieces = pieces.select(
        lane.alias("lane"),
        number.alias("block"),
        F.struct(
            first.alias("at"),
            F.slice(ids, (first - F.col("_start") + 1).cast("int"), (last - first).cast("int")).alias("ids"),
        ).alias("piece"),
    )
    merged = pieces.groupBy("lane", "block").agg(F.sort_array(F.collect_list("piece")).alias("pieces"))
    return merged.select(
        "lane", "block", F.flatten(F.transform("pieces", lambda p: p["ids"])).alias("ids")
    )


def length_bucket(ids: Column, width: int = 50) -> Column:
    return whole(F.size(ids), width)


def length_batches(docs: DataFrame, key: str, ids: str = "ids", batch_size: int = 48) -> DataFrame:
    """Longest documents first, `batch_size` of them per batch, so that a batch pads little.

    Only (key, length) is ranked; the ids are joined back by key. A null list has length 0.
    """
    sized = docs.select(key, _size(ids).alias("_size"))
    ranked = number_rows(sized, key, "_rank", lead="_size")
    return docs.join(ranked.select(key, whole(F.col("_rank"), batch_size).alias("batch")), key)


def sortish_batches(docs: DataFrame, key: str, ids: str = "ids", batch_size: int = 24, chunk: int = 50,
                    seed: int = 0) -> DataFrame:
    """Random chunks of `chunk` batches, longest documents first inside each, so that batches of one
    length follow no global order. No chunk holds more than `chunk * batch_size` documents.
    """
    sized = docs.select(key, _size(ids).alias("_size"), shuffle_number(F.col(key), seed).alias("_place"))
    ranked = number_rows(sized, "_place", "_rank").withColumn("_chunk", whole(F.col("_rank"), chunk * batch_size))
    inside = F.row_number().over(Window.partitionBy("_chunk").orderBy(F.desc("_size"), key)) - 1
    batch = F.col("_chunk") * chunk + whole(inside, batch_size)
    return docs.join(ranked.select(key, batch.cast("bigint").alias("batch")), key)


def _fill(ids: str, longest: Column, pad_id: int) -> Column:
    return F.concat(ids, F.array_repeat(F.lit(pad_id), longest - F.size(ids)))


def pad_buckets(docs: DataFrame, width: int = 50, ids: str = "ids", pad_id: int = PAD_ID) -> DataFrame:
    """Add the length bucket and fill the lists of each up to its longest one."""
    docs = docs.withColumn("bucket", length_bucket(F.col(ids), width))
    # one small row per bucket, which adaptive execution broadcasts once it has seen its size
    longest = docs.groupBy("bucket").agg(F.max(F.size(ids)).alias("_longest"))
    return docs.join(longest, "bucket").withColumn(ids, _fill(ids, F.col("_longest"), pad_id)).drop("_longest")


def pad_batches(docs: DataFrame, ids: str = "ids", pad_id: int = PAD_ID) -> DataFrame:
    """Fill the lists of each `batch`, which holds a bounded number of documents, up to its longest."""
    longest = F.max(F.size(ids)).over(Window.partitionBy("batch"))
    return docs.withColumn("_longest", longest).withColumn(ids, _fill(ids, F.col("_longest"), pad_id)).drop("_longest")
