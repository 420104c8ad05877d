"""Token counts, vocabularies, token ids and embedding alignment."""

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from moodgauge.functions.text import PAD_TOKEN, UNKNOWN_TOKEN
from moodgauge.operators.ordering import top_by_count

# Vocabulary size limit and the count a token must exceed.
MAX_TOKENS = 60_000
MIN_COUNT = 2
UNKNOWN_ID, PAD_ID = 0, 1
# sketches of frequent tokens: how many tokens one tracks, how many there are at most, and how many tokens are counted after them
SKETCH_ITEMS, SKETCH_PARTS, SKETCH_CANDIDATES = 1 << 14, 64, 1 << 11
TOKEN_BUCKETS = 1 << 16  # a count for each, broadcast


def token_counts(docs: DataFrame, tokens: str = "tokens") -> DataFrame:
    """(token, n) over all documents.

    The outer form of explode keeps the planner from adding a filter on the list's size below it,
    which would tokenise every text twice.
    """
    exploded = docs.select(F.explode_outer(tokens).alias("token")).filter(F.col("token").isNotNull())
    return exploded.groupBy("token").agg(F.count("*").alias("n"))


def most_common(counts: DataFrame, k: int = 25) -> DataFrame:
    return counts.orderBy(F.desc("n"), "token").limit(k)


def least_common(counts: DataFrame, k: int = 25) -> DataFrame:
    return counts.orderBy("n", F.desc("token")).limit(k)


def _tokens(docs: DataFrame, tokens: str) -> DataFrame:
    return docs.select(F.explode_outer(tokens).alias("token")).filter(F.col("token").isNotNull())


def token_sketches(docs: DataFrame, tokens: str = "tokens", items: int = SKETCH_ITEMS) -> DataFrame:
    """(sketch, n): at most SKETCH_PARTS mergeable sketches of the frequent tokens, each of a bounded size, and the tokens they saw."""
    dealt = _tokens(docs, tokens).withColumn("part", F.spark_partition_id() % SKETCH_PARTS)
    sums = dealt.groupBy("part").agg(F.expr(f"approx_top_k_accumulate(token, {items})").alias("sketch"), F.count("*").alias("n"))
    return sums.select("sketch", "n")


def sketch_stream(docs: DataFrame, path: str, checkpoint: str, tokens: str = "tokens", items: int = SKETCH_ITEMS) -> DataStreamWriter:
    """Keep the sketches of each batch of a stream below `path`; a batch that runs again replaces its own."""

    def write(batch: DataFrame, batch_id: int) -> None:
        token_sketches(batch, tokens, items).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return docs.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True)


def frequent_tokens(docs: DataFrame, least: int, tokens: str = "tokens", buckets: int = TOKEN_BUCKETS) -> DataFrame:
    """(token) with repeats: all that occur `least` times or more, and few others, by counts of so many buckets of tokens."""
    rows = _tokens(docs, tokens).withColumn("bucket", F.pmod(F.xxhash64("token"), F.lit(buckets)).cast("int"))
    held = rows.groupBy("bucket").agg(F.count("*").alias("n")).filter(F.col("n") >= least).select("bucket")
    return rows.join(F.broadcast(held), "bucket", "left_semi").select("token")


def top_tokens(docs: DataFrame, k: int = 25, tokens: str = "tokens", sketches: DataFrame | None = None, items: int = SKETCH_ITEMS, candidates: int = SKETCH_CANDIDATES) -> DataFrame:
    """(token, n) of the k most frequent tokens, exact, without a count of every token.

    The sketches, of these documents or as `sketch_stream` kept them, name at most `candidates` tokens, and only these are counted.
    A sketch's error is at most 3.5 / items of all tokens, and a token that it does not name has at most twice that, or the
    least estimate that it names. If the k-th count is not above this, as when counts are nearly flat, all tokens are counted whose
    bucket of tokens has the k-th count at least, as no other can be among the k.
    """
    candidates = min(candidates, items)  # a sketch names no more than it tracks
    if (_tokens(docs, tokens) if sketches is None else sketches).isEmpty():
        return most_common(token_counts(docs, tokens), k)
    if sketches is None:
        sketches = token_sketches(docs, tokens, items)
    merged = sketches.agg(F.expr(f"approx_top_k_combine(sketch, {items})").alias("sketch"), F.sum("n").alias("n"))
    named, n = merged.select(F.expr(f"approx_top_k_estimate(sketch, {candidates})"), "n").first()
    bound = 2 * 3.5 / items * (n or 0)
    if named and len(named) >= candidates:
        bound = max(bound, min(x["count"] for x in named))
    # at most `candidates` rows; else all tokens would be shuffled to meet them
    listed = F.broadcast(docs.sparkSession.createDataFrame([(x["item"],) for x in named or []], "token string"))
    top = most_common(_tokens(docs, tokens).join(listed, "token", "left_semi").groupBy("token").agg(F.count("*").alias("n")), k)
    found = [(r.token, r.n) for r in top.collect()]  # k rows
    if len(found) == k and found[-1][1] > bound:
        return docs.sparkSession.createDataFrame(found, "token string, n long")
    likely = frequent_tokens(docs, found[-1][1], tokens) if len(found) == k else _tokens(docs, tokens)
    return most_common(likely.groupBy("token").agg(F.count("*").alias("n")), k)


def build_vocabulary(counts: DataFrame, max_tokens: int = MAX_TOKENS, min_count: int = MIN_COUNT) -> DataFrame:
    """(token, id): two specials, then tokens seen more than `min_count` times by falling count."""
    ranked = top_by_count(counts.filter(F.col("n") > min_count), max_tokens)
    ids = ranked.select("token", (F.col("rank") + 1).cast("int").alias("id"))
    specials = counts.sparkSession.range(2).select(
        F.when(F.col("id") == UNKNOWN_ID, UNKNOWN_TOKEN).otherwise(PAD_TOKEN).alias("token"),
        F.col("id").cast("int").alias("id"),
    )
    return specials.unionByName(ids)


def encode(docs: DataFrame, vocabulary: DataFrame, key: str, tokens: str = "tokens") -> DataFrame:
    """(key, ids): token ids in document order, 0 for tokens outside the vocabulary.

    A vocabulary of usual size is broadcast by the planner, which checks its bytes; a larger one makes
    a shuffled join, where adaptive execution splits frequent tokens. With the former all tokens of a
    document leave one task, so the lists are built before the shuffle, which then moves one row each.
    """
    table = vocabulary.select("token", "id")
    exploded = docs.select(key, F.posexplode_outer(tokens).alias("_pos", "token"))
    found = exploded.join(table, "token", "left")
    # position and id share a long: half the bytes of a struct, and sorted as a number
    place = F.shiftleft(F.col("_pos").cast("bigint"), 32)
    packed = place + F.coalesce(F.col("id"), F.lit(UNKNOWN_ID)).cast("bigint")
    lists = found.groupBy(key).agg(F.sort_array(F.collect_list(packed)).alias("_packed"))
    return lists.select(
        key, F.transform("_packed", lambda p: p.bitwiseAND(F.lit(0xFFFFFFFF)).cast("int")).alias("ids")
    )


def mean_vector(vectors: DataFrame, column: str) -> DataFrame:
    """One row: the element-wise mean. Partial means of one vector per task are merged."""
    mean = Summarizer.mean(array_to_vector(F.col(column).cast("array<double>")))
    return vectors.agg(vector_to_array(mean).alias("mean"))


def align_embeddings(vocabulary: DataFrame, pretrained: DataFrame, token="token", vector="vector") -> DataFrame:
    """A vector for every vocabulary token: the pretrained one, or the mean of all pretrained ones."""
    mean = mean_vector(pretrained, vector).scalar()
    known = pretrained.select(F.col(token).alias("token"), F.col(vector).cast("array<double>").alias("_vector"))
    joined = vocabulary.join(known, "token", "left")
    return joined.select(
        "token",
        "id",
        F.col("_vector").isNotNull().alias("pretrained"),
        F.coalesce("_vector", mean).cast("array<float>").alias("vector"),
    )


def vocabulary_as_list(vocabulary: DataFrame) -> DataFrame:
    """One row: the tokens in id order. At most MAX_TOKENS + 2 of them."""
    pairs = F.sort_array(F.collect_list(F.struct("id", "token")))
    return vocabulary.agg(F.transform(pairs, lambda p: p["token"]).alias("tokens"))
