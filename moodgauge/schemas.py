"""Schemas of events, stored tables and training corpora."""

from pyspark.sql import types as T

_S, _L, _I, _D, _B = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType()


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


#: Union of the fields both platforms send. `source` is a struct on one platform and a string on the
#: other, so it is read as text.
POST_DATA = _struct(
    id=_L,
    body=_S,
    text=_S,
    created_at=_S,
    source=_S,
    user=_struct(id=_L, username=_S, screen_name=_S, name=_S),
    entities=_struct(sentiment=_struct(basic=_S)),
    conversation=_struct(replies=_L),
    likes=_struct(total=_L),
    favorite_count=_L,
    retweet_count=_L,
)

PREDICTION_VALUES = _struct(
    bear_sentiment=_D, bull_sentiment=_D, vader_sentiment=_D, bull_vader_sentiment=_D
)

PREDICTIONS = _struct(
    model=_S,
    context=T.ArrayType(_struct(stoi=_S, inputDataset=_S)),
    predictionProcessedTsMs=_L,
    values=PREDICTION_VALUES,
)

#: One event as it travels between stages; `predictions` is null before scoring.
EVENT = _struct(
    schema=_S,
    schemaVersion=_S,
    source=_S,
    msgType=_S,
    clientReceivedTsMs=_L,
    entityId=_I,
    entityName=_S,
    dataSource=_S,
    data=POST_DATA,
    predictions=PREDICTIONS,
)

SCORE = T.DecimalType(5, 2)
IMPACT = T.DecimalType(10, 2)
INDEX_VALUE = T.DecimalType(10, 3)

#: Stored posts; key (post_type, post_id).
POSTS = _struct(
    post_type=_S,
    post_id=_L,
    body=_S,
    impact=IMPACT,
    link=_S,
    user_name=_S,
    created_at_epoch_ms=_L,
    sentiment_ml_model=SCORE,
    sentiment_vader_normalized=SCORE,
    sentiment_mixed=SCORE,
    client_received_epoch_ms=_L,
)

#: Published indices; key (sentiment_type, sentiment_seconds_back, created_at_epoch_ms).
GLOBAL_SENTIMENT = _struct(
    sentiment_type=_S,
    sentiment_seconds_back=_L,
    created_at_epoch_ms=_L,
    sentiment_absolute=INDEX_VALUE,
    sentiment_normalized=T.DecimalType(5, 3),
)

#: Engagement counters of one post, as each platform reports them over time.
ENGAGEMENT = _struct(post_type=_S, message_id=_L, interaction_total=_L, likes_total=_L)

ACCOUNTS = _struct(id=_L, name=_S, screen_name=_S)

LABELLED_TEXT = _struct(labels=_I, text=_S)

TOPIC_POSTS = _struct(body=_S)
