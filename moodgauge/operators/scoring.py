"""Scoring requests: classifier and lexicon, blended, attached as a prediction struct."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodgauge.functions.moments import now_ms
from moodgauge.functions.numeric import blend, to_unit_range
from moodgauge.functions.text import model_input
from moodgauge.operators import lexicon as lex
from moodgauge.operators import models
from moodgauge.operators.posts import response_type

REQUEST_MARK = "-sentiment-request"
# Which model scores which type of request; both tweet types share one.
MODEL_OF_TYPE = {"stocktwit": "stocktwits", "twitter-user": "twitter", "twitter-topic": "twitter"}


def prediction(model: str, scores: Column, lexicon_score: Column, context=(), processed=None,
               model_weight: float = 0.8) -> Column:
    """The prediction struct: scores are (bear, bull), the lexicon score lies in [0, 1]."""
    sources = [F.struct(F.lit(s).alias("stoi"), F.lit(d).alias("inputDataset")) for s, d in context]
    empty = F.array().cast("array<struct<stoi:string,inputDataset:string>>")
    return F.struct(
        F.lit(model).alias("model"),
        (F.array(*sources) if sources else empty).alias("context"),
        (now_ms() if processed is None else processed).alias("predictionProcessedTsMs"),
        F.struct(
            F.get(scores, 0).alias("bear_sentiment"),
            F.get(scores, 1).alias("bull_sentiment"),
            lexicon_score.alias("vader_sentiment"),
            blend(F.get(scores, 1), lexicon_score, model_weight).alias("bull_vader_sentiment"),
        ).alias("values"),
    )


def add_lexicon_score(requests: DataFrame, key: str, text: str, lexicon: DataFrame) -> DataFrame:
    """Add `vader` in [0, 1]. Texts stay in place until the join; one narrow row per text meets them."""
    compound = lex.score_texts(requests, key, text, lexicon)
    scored = compound.select(key, to_unit_range(F.col("compound")).alias("vader"))
    return requests.join(scored, key)


def score_requests(requests: DataFrame, models_by_name: dict, lexicon: DataFrame, key: str = "request_id",
                   model_weight: float = 0.8, processed=None) -> DataFrame:
    """Scored events, one per request of a routed type; other types are left out.

    `requests` are events with a unique `key`. Models are Spark ML pipelines on a column `text`.
    """
    kind = F.replace(F.col("msgType"), F.lit(REQUEST_MARK), F.lit(""))
    routed = None
    for name, model in models_by_name.items():
        kinds = [k for k, m in MODEL_OF_TYPE.items() if m == name]
        # lexicon and model read only the requests routed to this model
        part = requests.filter(kind.isin(kinds)).withColumn("text", F.col("data.text"))
        part = add_lexicon_score(part, key, "text", lexicon).withColumn("text", model_input(F.col("text")))
        part = models.probabilities(model, part)
        values = prediction(name, F.col("scores"), F.col("vader"), processed=processed, model_weight=model_weight)
        part = part.withColumn("predictions", values).withColumn("msgType", response_type(F.col("msgType")))
        part = part.drop("scores", "vader", "text")
        routed = part if routed is None else routed.unionByName(part)
    return routed


def score_in_place(requests: DataFrame, models_by_name: dict, lexicon: DataFrame, model_weight: float = 0.8, processed=None) -> DataFrame:
    """What `score_requests` gives, row by row where the request stands: in batch, or on a stream in append mode.

    Nothing is shuffled and no key is needed; requests of a file stay in their order. The lexicon must be small enough for
    `lexicon.known_words`.
    """
    kind = F.replace(F.col("msgType"), F.lit(REQUEST_MARK), F.lit(""))
    names = [n for n in models_by_name if n in MODEL_OF_TYPE.values()]
    routed = requests.withColumn("_model", F.element_at(F.create_map(*[F.lit(x) for pair in MODEL_OF_TYPE.items() for x in pair]), kind))
    routed = routed.filter(F.col("_model").isin(names)).withColumn("text", F.col("data.text"))
    rows = lex.add_compound(routed, "text", lexicon, "_compound").withColumn("_whole", F.col("text")).withColumn("_scores", F.lit(None).cast("array<double>"))
    for name in names:
        own = F.col("_model") == name
        rows = models.probabilities(models_by_name[name], rows.withColumn("text", F.when(own, model_input(F.col("_whole"))).otherwise("")))
        rows = rows.withColumn("_scores", F.when(own, F.col("scores")).otherwise(F.col("_scores"))).drop("scores")
    values = [(name, prediction(name, F.col("_scores"), to_unit_range(F.col("_compound")), processed=processed, model_weight=model_weight)) for name in names]
    chosen = F.coalesce(*[F.when(F.col("_model") == name, value) for name, value in values])
    scored = rows.withColumn("predictions", chosen).withColumn("msgType", response_type(F.col("msgType")))
    return scored.drop("_model", "_compound", "_whole", "_scores", "text")
