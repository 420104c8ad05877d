"""Text classifier, its evaluation, and topics: Spark ML estimators on post text."""

import json

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.clustering import LDA
from pyspark.ml.feature import IDF, CountVectorizerModel, RegexTokenizer, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodgauge.functions.numeric import argmax
from moodgauge.functions.text import words
from moodgauge.operators.metrics import binary_metrics
from moodgauge.operators.ordering import top_by_count
from moodgauge.operators.splits import sample_rows
from moodgauge.operators.vocabulary import MAX_TOKENS, MIN_COUNT, token_counts

# Fixed values of the topic job.
TOPIC_VOCABULARY, TOPICS, TOPIC_ITERATIONS, TERMS_PER_TOPIC = 5000, 100, 5, 3


def _vocabulary(corpus: DataFrame, text: str, limit: int, min_count: int) -> list[str]:
    """The most frequent tokens, at most `limit` strings. Counted and cut by aggregates."""
    counts = token_counts(corpus.select(words(F.col(text)).alias("tokens")))
    top = top_by_count(counts.filter(F.col("n") > min_count), limit)
    return [row.token for row in top.orderBy("rank").select("token").collect()]


def train(corpus: DataFrame, text: str = "text", label: str = "labels", vocabulary: int = MAX_TOKENS,
          min_count: int = MIN_COUNT, iterations: int = 20, l2: float = 0.01) -> PipelineModel:
    """Two-class text classifier over weighted token counts.

    Texts are cut into tokens once for the vocabulary and once for the counts; the counts are kept for the passes of the fit.
    """
    terms = _vocabulary(corpus, text, vocabulary, min_count)
    counting = PipelineModel([
        RegexTokenizer(inputCol=text, outputCol="_tokens", pattern=r"\s+"),
        CountVectorizerModel.from_vocabulary(terms, inputCol="_tokens", outputCol="_counts"),
    ])
    counts = counting.transform(corpus).select(label, "_counts").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        weights = IDF(inputCol="_counts", outputCol="_features").fit(counts)
        classifier = LogisticRegression(featuresCol="_features", labelCol=label, maxIter=iterations, regParam=l2)
        return PipelineModel([*counting.stages, weights, classifier.fit(weights.transform(counts))])
    finally:
        counts.unpersist()


def probabilities(model: PipelineModel, posts: DataFrame) -> DataFrame:
    """Add `scores`, an array of (bear, bull) that sums to 1."""
    scored = model.transform(posts)
    extra = ["_tokens", "_counts", "_features", "rawPrediction", "probability", "prediction"]
    return scored.withColumn("scores", vector_to_array("probability")).drop(*extra)


def predict(model: PipelineModel, posts: DataFrame) -> DataFrame:
    """Add `prediction`, the most probable class."""
    return probabilities(model, posts).withColumn("prediction", argmax(F.col("scores"))).drop("scores")


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def evaluate(model: PipelineModel, posts: DataFrame, label: str = "labels") -> DataFrame:
    return binary_metrics(predict(model, posts), label=label)


def learning_curve(training: DataFrame, validation: DataFrame, row_id: str, sizes, seed: int = 0, **settings) -> DataFrame:
    """Metrics on one validation set by training size; the samples are nested.

    One fit per size. Every fit is a distributed job; the loop only runs over the few sizes.
    """
    curve = None
    for size in sizes:
        model = train(sample_rows(training, row_id, size, seed), **settings)
        row = evaluate(model, validation, settings.get("label", "labels")).select(
            F.lit(int(size)).cast("bigint").alias("train_size"),
            F.log10(F.lit(float(size))).alias("log10_size"),
            "accuracy", "precision", "recall", "f1",
        )
        curve = row if curve is None else curve.unionByName(row)
    return curve


def bag_of_words(posts: DataFrame, text: str = "body", vocabulary: int = TOPIC_VOCABULARY):
    """(model, vectors): presence of the most frequent lower-cased tokens per post."""
    tokens = Tokenizer(inputCol=text, outputCol="_tokens").transform(posts)
    terms = _vocabulary(posts, text, vocabulary, 0)
    model = CountVectorizerModel.from_vocabulary(terms, inputCol="_tokens", outputCol="features", binary=True, minTF=0.0)
    return model, model.transform(tokens).drop("_tokens", text)


def topics(posts: DataFrame, text: str = "body", k: int = TOPICS, iterations: int = TOPIC_ITERATIONS,
           vocabulary: int = TOPIC_VOCABULARY, terms: int = TERMS_PER_TOPIC, seed: int = 1) -> DataFrame:
    """(topic, terms, weights): the strongest terms of every topic."""
    bag, vectors = bag_of_words(posts.select(text), text, vocabulary)
    vectors = vectors.persist(StorageLevel.MEMORY_AND_DISK)
    model = LDA(k=k, maxIter=iterations, seed=seed).fit(vectors)
    vectors.unpersist()
    # k rows; the vocabulary is capped above and goes in as one literal
    vocab = F.from_json(F.lit(json.dumps(bag.vocabulary)), "array<string>")
    found = model.describeTopics(terms)
    return found.select(
        "topic",
        F.transform("termIndices", lambda i: F.get(vocab, i)).alias("terms"),
        F.col("termWeights").alias("weights"),
    )
