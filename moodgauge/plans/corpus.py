"""Text, vocabularies, packing, scoring and models."""

from pyspark.sql import functions as F

from moodgauge.functions import numeric, text
from moodgauge.operators import lexicon, metrics, models, packing, posts, scoring, sequences, splits, vocabulary
from moodgauge.plans import tables as t
from moodgauge.plans.registry import query
from moodgauge.session import scratch_path
from moodgauge.sources import writers


def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _replaced(column: str) -> str:
    for old, new in text.REPLACEMENTS:
        column = f"replace({column}, {_sql_text(old)}, {_sql_text(new)})"
    return column


# the entities that stay in the given pages after the replacement list
_RESOLVED = "replace(replace({}, '&copy;', '©'), '&middot;', '·')"


@query(
    "clean_text",
    f"SELECT page_id, regexp_replace({_RESOLVED.format(_replaced('html'))}, '  +', ' ', 'g') AS text FROM pages",
)
def clean_text(spark, sf_dir):
    return t.table(spark, sf_dir, "pages").select("page_id", text.clean_post(F.col("html")).alias("text"))


_BARE = r"regexp_replace(regexp_replace({}, '(?i)(https?|ftp)://[^\s]+', '', 'g'), '@[\p{{L}}\p{{N}}_]*', '', 'g')"
_TWEET = r"replace(trim(regexp_replace(" + _BARE + r", '\s+', ' ', 'g')), '&#', '#')"


@query(
    "clean_tweets",
    f"""SELECT page_id, regexp_replace({_RESOLVED.format(_replaced(_TWEET.format("url || ' ' || html")))}, '  +', ' ', 'g') AS text
FROM pages""",
)
def clean_tweets(spark, sf_dir):
    raw = F.concat_ws(" ", "url", "html")
    return t.table(spark, sf_dir, "pages").select("page_id", text.clean_tweet(raw).alias("text"))


@query(
    "clean_documents",
    f"SELECT doc_id, regexp_replace({_replaced('text')}, '  +', ' ', 'g') AS text FROM documents",
)
def clean_documents(spark, sf_dir):
    docs = t.table(spark, sf_dir, "documents")
    return docs.select("doc_id", text.clean_post(F.col("text")).alias("text"))


@query(
    "tag_documents",
    "SELECT doc_id, chr(10) || 'xbos xfld 1 ' || text || ' xfld 2 ' || lang AS tagged, 'xbos xfld 1 ' || text AS scoring FROM documents",
)
def tag_documents(spark, sf_dir):
    tagged = text.tag_document(F.col("text"), F.col("lang"))
    return t.table(spark, sf_dir, "documents").select(
        "doc_id", tagged.alias("tagged"), text.tag_for_scoring(F.col("text")).alias("scoring")
    )


def _counts(spark, sf_dir):
    return vocabulary.token_counts(t.documents(spark, sf_dir))


@query("token_freq", f"WITH {t.TOKENS} SELECT * FROM cnt")
def token_freq(spark, sf_dir):
    return _counts(spark, sf_dir)


@query("token_freq_top25", f"WITH {t.TOKENS} SELECT * FROM cnt ORDER BY n DESC, token LIMIT 25")
def token_freq_top25(spark, sf_dir):
    return vocabulary.most_common(_counts(spark, sf_dir))


@query("token_top_sketch", f"WITH {t.TOKENS} SELECT * FROM cnt ORDER BY n DESC, token LIMIT 25")
def token_top_sketch(spark, sf_dir):
    """The most frequent tokens by sketches, then counts of what these name."""
    return vocabulary.top_tokens(t.documents(spark, sf_dir))


@query("stream_token_top_sketch", f"WITH {t.TOKENS} SELECT * FROM cnt ORDER BY n DESC, token LIMIT 25")
def stream_token_top_sketch(spark, sf_dir):
    """The same from sketches that a stream kept per batch."""
    path, sketches = scratch_path(spark, "token-lists"), scratch_path(spark, "sketches")
    docs = t.documents(spark, sf_dir).select("tokens")
    # a file per part of the scan, so that none grows with the input, and four at least for several batches
    (docs if docs.rdd.getNumPartitions() >= 4 else docs.repartition(4)).write.parquet(path)
    half = max(2, -(-len(spark.read.parquet(path).inputFiles()) // 2))
    stream = spark.readStream.schema("tokens array<string>").option("maxFilesPerTrigger", half).parquet(path)
    vocabulary.sketch_stream(stream, sketches, scratch_path(spark, "state")).start().awaitTermination()
    return vocabulary.top_tokens(spark.read.parquet(path), sketches=spark.read.parquet(sketches))


@query("token_freq_bottom25", f"WITH {t.TOKENS} SELECT * FROM cnt ORDER BY n, token DESC LIMIT 25")
def token_freq_bottom25(spark, sf_dir):
    return vocabulary.least_common(_counts(spark, sf_dir))


def _vocabulary(spark, sf_dir):
    return vocabulary.build_vocabulary(_counts(spark, sf_dir))


@query("vocabulary", f"WITH {t.VOCABULARY} SELECT token, id FROM vocab")
def build_vocabulary(spark, sf_dir):
    return _vocabulary(spark, sf_dir)


def _stored_vocabulary(spark, sf_dir):
    """The vocabulary as a written table, as training keeps it between its steps."""
    path = scratch_path(spark, "vocabulary")
    _vocabulary(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(path)


def _encoded(spark, sf_dir):
    return vocabulary.encode(t.documents(spark, sf_dir), _stored_vocabulary(spark, sf_dir), "doc_id")


def _stored_ids(spark, sf_dir):
    """Encoded documents as a written table: packing reads it more than once."""
    path = scratch_path(spark, "ids")
    _encoded(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(path)


def _as_text(df):
    return df.withColumn("ids", F.array_join(F.col("ids").cast("array<string>"), " "))


@query(
    "encode_tokens",
    f"WITH {t.VOCABULARY} SELECT doc_id, coalesce(string_agg(id, ' ' ORDER BY pos), '') AS ids FROM docs LEFT JOIN enc USING (doc_id) GROUP BY doc_id",
)
def encode_tokens(spark, sf_dir):
    return _as_text(_encoded(spark, sf_dir))


_SEQUENCE = "sequence AS (SELECT id, row_number() OVER (ORDER BY doc_id, pos) - 1 AS place, count(*) OVER () AS total FROM enc)"


@query(
    "pack_sequences",
    f"""WITH {t.VOCABULARY}, {_SEQUENCE}
SELECT 0 AS lane, place // 70 AS block, string_agg(id, ' ' ORDER BY place) AS ids FROM sequence GROUP BY block""",
)
def pack_sequences(spark, sf_dir):
    return _as_text(packing.pack(_stored_ids(spark, sf_dir), "doc_id"))


@query(
    "lane_blocks",
    f"""WITH {t.VOCABULARY}, {_SEQUENCE},
placed AS (SELECT id, place, place // (total // 52) AS lane, place % (total // 52) AS inside FROM sequence)
SELECT lane, inside // 70 AS block, string_agg(id, ' ' ORDER BY place) AS ids FROM placed WHERE lane < 52 GROUP BY ALL""",
)
def lane_blocks(spark, sf_dir):
    return _as_text(packing.pack(_stored_ids(spark, sf_dir), "doc_id", lanes=packing.LANES))


def _lengths(spark, sf_dir):
    """Token-length lists as a written table: one id per token, so that only lengths matter."""
    path = scratch_path(spark, "lengths")
    lists = t.documents(spark, sf_dir).select("doc_id", F.transform("tokens", F.length).alias("ids"))
    lists.write.parquet(path)
    return spark.read.parquet(path)


_LENGTHS = t.TOKENS + ", lens AS (SELECT doc_id, len(tokens) AS n, list_transform(tokens, lambda x: length(x)) AS ids FROM docs)"


@query(
    "length_buckets",
    f"""WITH {_LENGTHS}, b AS (SELECT *, n // 50 AS bucket, max(n) OVER (PARTITION BY n // 50) AS widest FROM lens)
SELECT doc_id, bucket, trim(array_to_string(ids, ' ') || repeat(' 1', widest - n)) AS ids FROM b""",
)
def length_buckets(spark, sf_dir):
    return _as_text(packing.pad_buckets(_lengths(spark, sf_dir)))


_BATCHES = "batches AS (SELECT *, (row_number() OVER (ORDER BY n DESC, doc_id) - 1) // 48 AS batch FROM lens)"


@query("length_batches", f"WITH {_LENGTHS}, {_BATCHES} SELECT doc_id, batch, n FROM batches")
def length_batches(spark, sf_dir):
    batches = packing.length_batches(_lengths(spark, sf_dir), "doc_id")
    return batches.select("doc_id", "batch", F.size("ids").cast("bigint").alias("n"))


@query(
    "sortish_batches",
    f"""WITH {_LENGTHS}, r AS (SELECT *, (row_number() OVER (ORDER BY md5('0:' || doc_id)) - 1) // 1200 AS chunk FROM lens)
SELECT doc_id, n, chunk * 50 + (row_number() OVER (PARTITION BY chunk ORDER BY n DESC, doc_id) - 1) // 24 AS batch FROM r""",
)
def sortish_batches(spark, sf_dir):
    batches = packing.sortish_batches(_lengths(spark, sf_dir), "doc_id")
    return batches.select("doc_id", F.size("ids").cast("bigint").alias("n"), "batch")


@query(
    "pad_batch",
    f"""WITH {_LENGTHS}, {_BATCHES}
SELECT doc_id, batch, trim(array_to_string(ids, ' ') || repeat(' 1', max(n) OVER (PARTITION BY batch) - n)) AS ids FROM batches""",
)
def pad_batch(spark, sf_dir):
    return _as_text(packing.pad_batches(packing.length_batches(_lengths(spark, sf_dir), "doc_id")))


@query(
    "encoded_round_trip",
    f"WITH {t.VOCABULARY} SELECT doc_id, count(id) AS n, coalesce(sum(id), 0) AS total FROM docs LEFT JOIN enc USING (doc_id) GROUP BY doc_id",
)
def encoded_round_trip(spark, sf_dir):
    """Ids and vocabulary written and read back."""
    path = scratch_path(spark, "encoded")
    vocab = _stored_vocabulary(spark, sf_dir)
    writers.write_encoded(vocabulary.encode(t.documents(spark, sf_dir), vocab, "doc_id"), vocab, path)
    ids = spark.read.parquet(f"{path}/ids")
    return ids.select(
        "doc_id", F.size("ids").cast("bigint").alias("n"),
        F.aggregate("ids", F.lit(0).cast("bigint"), lambda a, b: a + b).alias("total"),
    )


@query(
    "mean_vector",
    """SELECT pos, round(avg(CAST(v AS DOUBLE)), 6) AS mean
FROM (SELECT unnest(embedding) AS v, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings) GROUP BY pos""",
)
def mean_vector(spark, sf_dir):
    mean = vocabulary.mean_vector(t.table(spark, sf_dir, "embeddings"), "embedding")
    return mean.select(F.posexplode("mean").alias("pos", "mean")).select(
        F.col("pos").cast("bigint").alias("pos"), F.round("mean", 6).alias("mean")
    )


@query(
    "align_embeddings",
    f"""WITH {t.VOCABULARY}, known AS (SELECT '_unk_' AS token, 0 AS vec_id WHERE false
  UNION ALL SELECT token, id - 2 FROM vocab WHERE id >= 2 AND id % 2 = 0),
pre AS (SELECT token, embedding FROM known JOIN embeddings USING (vec_id)),
avgs AS (SELECT round(avg(CAST(embedding[1] AS DOUBLE)), 4) AS first FROM pre)
SELECT token, id, embedding IS NOT NULL AS pretrained,
  coalesce(round(CAST(embedding[1] AS DOUBLE), 4), (SELECT first FROM avgs)) AS first
FROM vocab LEFT JOIN pre USING (token)""",
)
def align_embeddings(spark, sf_dir):
    """Every second of the frequent tokens has a given vector."""
    vocab = _stored_vocabulary(spark, sf_dir)
    vectors = t.table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    tokens = vocab.filter("id >= 2 and id % 2 = 0").select("token", (F.col("id") - 2).alias("vec_id"))
    aligned = vocabulary.align_embeddings(vocab, tokens.join(vectors, "vec_id").select("token", "vector"))
    return aligned.select("token", "id", "pretrained", F.round(F.get("vector", 0).cast("double"), 4).alias("first"))


@query(
    "softmax_argmax",
    """WITH e AS (SELECT vec_id, embedding, list_max(embedding) AS top FROM embeddings),
x AS (SELECT vec_id, embedding, list_transform(embedding, lambda v: exp(CAST(v AS DOUBLE) - CAST(top AS DOUBLE))) AS ex, top FROM e)
SELECT vec_id, CAST(list_position(embedding, top) - 1 AS INTEGER) AS class, round(list_max(ex) / list_sum(ex), 9) AS top_share FROM x""",
)
def softmax_argmax(spark, sf_dir):
    rows = t.table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    shares = rows.withColumn("shares", numeric.softmax(F.col("embedding").cast("array<double>")))
    return shares.select(
        "vec_id", numeric.argmax(F.col("embedding")).alias("class"), F.round(F.array_max("shares"), 9).alias("top_share")
    )


@query(
    "normalise_blend",
    """SELECT event_id, (value / 100 + 1) / 2 AS vader, (event_id % 11) / 10.0 * CAST(0.8 AS DOUBLE) + (value / 100 + 1) / 2 * CAST(0.2 AS DOUBLE) AS mixed,
  (event_id % 11) / 10.0 * CAST(0.6 AS DOUBLE) + (value / 100 + 1) / 2 * CAST(0.4 AS DOUBLE) AS mixed_older FROM events""",
)
def normalise_blend(spark, sf_dir):
    vader, model = numeric.to_unit_range(F.col("value") / 100), (F.col("event_id") % 11) / 10
    return t.table(spark, sf_dir, "events").select(
        "event_id", vader.alias("vader"), numeric.blend(model, vader).alias("mixed"),
        numeric.blend(model, vader, 0.6).alias("mixed_older"),
    )


def _lexicon(spark, sf_dir):
    """Words of the benchmark items, each with a valence from its spelling."""
    items = t.table(spark, sf_dir, "benchmark").select(F.explode(F.split(F.lower("text"), "[^a-zà-ÿ]+")).alias("token"))
    valence = (F.length("token") * 7 + F.ascii("token")) % 9 - 4
    return items.filter("token <> ''").distinct().withColumn("valence", valence.cast("double"))


_UP, _DOWN, _NOT, _TURN = ["the", "que"], ["in", "un"], ["is", "est"], "on"
# the edge punctuation as a pattern
_EDGES = "[!\"#$%&''()*+,\\-./:;<=>?@\\[\\\\\\]^_`{|}~]+"


def _bare(word):
    stripped = f"regexp_replace({word}, '^{_EDGES}|{_EDGES}$', '', 'g')"
    return f"CASE WHEN length({stripped}) <= 2 THEN {word} ELSE {stripped} END"


def _in(words):
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


_LEXICON_SQL = rf"""
lex AS (SELECT DISTINCT token, CAST((length(token) * 7 + unicode(token)) % 9 - 4 AS DOUBLE) AS valence
  FROM (SELECT unnest(regexp_split_to_array(lower(text), '[^a-zà-ÿ]+')) AS token FROM benchmark) WHERE token <> ''),
raw AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM
  (SELECT doc_id, list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '') AS ws FROM documents)),
bare AS (SELECT doc_id, pos, {_bare('word')} AS bare FROM raw),
mark AS (SELECT doc_id, pos, lower(bare) AS token, (bare = upper(bare) AND bare <> lower(bare)) AS shouted,
    CASE WHEN lower(bare) IN {_in(_UP)} THEN 0.293 WHEN lower(bare) IN {_in(_DOWN)} THEN -0.293 ELSE 0 END AS boost,
    lower(bare) IN {_in(_NOT)} AS negates FROM bare),
text_marks AS (SELECT doc_id, bool_or(shouted) AND NOT bool_and(shouted) AS mixed,
    min(pos) FILTER (token = '{_TURN}') AS turn FROM mark GROUP BY doc_id),
near AS (SELECT m.*, lag(boost, 1, 0) OVER w AS b1, lag(boost, 2, 0) OVER w AS b2, lag(boost, 3, 0) OVER w AS b3,
    lag(shouted AND boost <> 0, 1, false) OVER w AS s1, lag(shouted AND boost <> 0, 2, false) OVER w AS s2,
    lag(shouted AND boost <> 0, 3, false) OVER w AS s3,
    lag(negates, 1, false) OVER w AS n1, lag(negates, 2, false) OVER w AS n2, lag(negates, 3, false) OVER w AS n3
  FROM mark m WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
v0 AS (SELECT near.*, mixed, turn, CAST(valence + CASE WHEN shouted AND mixed THEN sign(valence) * 0.733 ELSE 0 END AS DOUBLE) AS v
  FROM near JOIN lex USING (token) JOIN text_marks USING (doc_id)),
v1 AS (SELECT * REPLACE ((v + sign(v) * (CAST(b1 AS DOUBLE) + CASE WHEN s1 AND mixed THEN 0.733 ELSE 0 END)) * CASE WHEN n1 THEN -0.74 ELSE 1 END AS v) FROM v0),
v2 AS (SELECT * REPLACE ((v + sign(v) * 0.95 * (CAST(b2 AS DOUBLE) + CASE WHEN s2 AND mixed THEN 0.733 ELSE 0 END)) * CASE WHEN n2 THEN -0.74 ELSE 1 END AS v) FROM v1),
v3 AS (SELECT * REPLACE ((v + sign(v) * 0.9 * (CAST(b3 AS DOUBLE) + CASE WHEN s3 AND mixed THEN 0.733 ELSE 0 END)) * CASE WHEN n3 THEN -0.74 ELSE 1 END AS v) FROM v2),
sums AS (SELECT doc_id, sum(v * CASE WHEN pos < turn THEN 0.5 WHEN pos > turn THEN 1.5 ELSE 1 END) AS s FROM v3 GROUP BY doc_id),
marks AS (SELECT doc_id, least(length(regexp_replace(text, '[^!]', '', 'g')), 4) * 0.292
    + CASE WHEN length(regexp_replace(text, '[^?]', '', 'g')) <= 1 THEN 0
           WHEN length(regexp_replace(text, '[^?]', '', 'g')) <= 3 THEN length(regexp_replace(text, '[^?]', '', 'g')) * 0.18
           ELSE 0.96 END AS e FROM documents),
total AS (SELECT doc_id, coalesce(s, 0) + sign(coalesce(s, 0)) * CAST(e AS DOUBLE) AS s FROM marks LEFT JOIN sums USING (doc_id))"""


@query(
    "lexicon_score",
    f"WITH {_LEXICON_SQL} SELECT doc_id, round(s / sqrt(s * s + 15), 4) AS compound, (round(s / sqrt(s * s + 15), 4) + 1) / 2 AS vader FROM total",
)
def lexicon_score(spark, sf_dir):
    scored = lexicon.score_texts(
        t.texts(spark, sf_dir), "doc_id", "text", _lexicon(spark, sf_dir), _UP, _DOWN, _NOT, _TURN
    )
    return scored.withColumn("vader", numeric.to_unit_range(F.col("compound")))


# rules for several words, of words that these texts have
_PHRASES = lexicon.Phrases(
    idioms={"of the": 2.5, "the": 0.5, "and the": -1.5, "the the the": 3.0, "la de": 1.5, "de la": -2.0, "der der": 0.25},
    boosters={"to the": -0.293, "and of": 0.293, "the of the": 0.5}, least="a", least_plain=("the", "de"), never="is", so=("that", "the"),
    without="est", doubt="la", silent=("the of", "und die"),
)


def _table(values):
    return ", ".join(f"('{k}', CAST({v} AS DOUBLE))" for k, v in values.items())


def _idioms(words):
    return f"(SELECT w FROM idiom WHERE p = {words})"


def _phrase_boost(words):
    return f"coalesce((SELECT w FROM phrase_boost WHERE p = {words}), 0)"


_NEVER = f"IN {_in(_PHRASES.so)}"
_TURN2 = f"CASE WHEN t2 = '{_PHRASES.never}' AND coalesce(t1 {_NEVER}, false) THEN 1.25 WHEN t2 = '{_PHRASES.without}' AND t1 = '{_PHRASES.doubt}' THEN 1 WHEN n2 THEN -0.74 ELSE 1 END"
_TURN3 = (
    f"CASE WHEN t3 = '{_PHRASES.never}' AND (t1 {_NEVER} OR t2 {_NEVER}) THEN 1.25 "
    f"WHEN t3 = '{_PHRASES.without}' AND (t1 = '{_PHRASES.doubt}' OR t2 = '{_PHRASES.doubt}') THEN 1 WHEN n3 THEN -0.74 ELSE 1 END"
)
_PHRASES_SQL = (
    _LEXICON_SQL.replace("near AS (SELECT m.*,", "near AS (SELECT m.*, lag(token, 1) OVER w AS t1, lag(token, 2) OVER w AS t2, lag(token, 3) OVER w AS t3, "
                         "lead(token, 1) OVER w AS l1, lead(token, 2) OVER w AS l2,")
    .replace("JOIN text_marks USING (doc_id))", f"JOIN text_marks USING (doc_id) WHERE coalesce(token || ' ' || l1 NOT IN {_in(_PHRASES.silent)}, true))")
    .replace("CASE WHEN n2 THEN -0.74 ELSE 1 END", _TURN2)
    .replace("CASE WHEN n3 THEN -0.74 ELSE 1 END", _TURN3)
    .replace("sums AS (", f"""idiom(p, w) AS (VALUES {_table(_PHRASES.idioms)}), phrase_boost(p, w) AS (VALUES {_table(_PHRASES.boosters)}),
v4 AS (SELECT * REPLACE ((coalesce({_idioms("token || ' ' || l1 || ' ' || l2")}, {_idioms("token || ' ' || l1")}, {_idioms("token")},
      {_idioms("t1 || ' ' || token")}, {_idioms("t2 || ' ' || t1 || ' ' || token")}, {_idioms("t2 || ' ' || t1")}, {_idioms("t3 || ' ' || t2 || ' ' || t1")}, {_idioms("t3 || ' ' || t2")}, v)
    + {_phrase_boost("t3 || ' ' || t2 || ' ' || t1")} + {_phrase_boost("t3 || ' ' || t2")} + {_phrase_boost("t2 || ' ' || t1")})
    * CASE WHEN t1 = '{_PHRASES.least}' AND coalesce(t2 NOT IN {_in(_PHRASES.least_plain)}, true) THEN -0.74 ELSE 1 END AS v) FROM v3),
sums AS (""")
    .replace("FROM v3 GROUP BY", "FROM v4 GROUP BY")
)


@query("lexicon_phrases", f"WITH {_PHRASES_SQL} SELECT doc_id, round(s / sqrt(s * s + 15), 4) AS compound FROM total")
def lexicon_phrases(spark, sf_dir):
    """Scores with the rules for several words, in place."""
    texts = t.texts(spark, sf_dir).select("doc_id", "text")
    return lexicon.add_compound(texts, "text", _lexicon(spark, sf_dir), "compound", _UP, _DOWN, _NOT, _TURN, _PHRASES).drop("text")


@query(
    "stream_lexicon_score",
    f"WITH {_LEXICON_SQL} SELECT doc_id, round(s / sqrt(s * s + 15), 4) AS compound, (round(s / sqrt(s * s + 15), 4) + 1) / 2 AS vader FROM total",
)
def stream_lexicon_score(spark, sf_dir):
    """The same scores worked out in place on a stream in append mode."""
    out, texts = scratch_path(spark, "lexicon-scores"), t.texts(spark, sf_dir)
    source = scratch_path(spark, "texts")
    texts.select("doc_id", "text").write.parquet(source)
    stream = spark.readStream.schema("doc_id long, text string").parquet(source)
    scored = lexicon.add_compound(stream, "text", _lexicon(spark, sf_dir), "compound", _UP, _DOWN, _NOT, _TURN).drop("text")
    run = scored.writeStream.format("parquet").option("path", out).option("checkpointLocation", scratch_path(spark, "state"))
    run.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out).withColumn("vader", numeric.to_unit_range(F.col("compound")))


def _training(spark, sf_dir):
    """Labelled documents in the form the classifier reads."""
    labels = t.table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("labels"))
    docs = t.texts(spark, sf_dir).join(labels, "doc_id")
    return docs.withColumn("text", text.model_input(F.col("text")))


def _split_table(spark, sf_dir):
    """Training rows with their split, written once: every pass of a fit reads the table."""
    path = scratch_path(spark, "training")
    splits.split_rows(_training(spark, sf_dir), "doc_id").write.parquet(path)
    return spark.read.parquet(path)


@query("classifier_probs")
def classifier_probs(spark, sf_dir):
    """Class probabilities of the test quarter after training on the rest."""
    rows = _split_table(spark, sf_dir)
    model = models.train(rows.filter("split = 'train'"), iterations=10)
    scored = models.probabilities(model, rows.filter("split = 'test'"))
    return scored.select(
        "doc_id", "labels", F.get("scores", 0).alias("bear"), F.get("scores", 1).alias("bull"),
        numeric.argmax(F.col("scores")).alias("prediction"),
    )


@query("learning_curve")
def learning_curve(spark, sf_dir):
    """Metrics after training on a quarter, half and all of the training rows."""
    rows = _split_table(spark, sf_dir)
    training, validation = rows.filter("split = 'train'").drop("split"), rows.filter("split = 'test'").drop("split")
    n = training.count()
    return models.learning_curve(training, validation, "doc_id", [n // 4, n // 2, n], iterations=10)


@query("topics")
def topics(spark, sf_dir):
    return models.topics(t.texts(spark, sf_dir).select(F.col("text").alias("body")))


@query("score_events")
def score_events(spark, sf_dir):
    """Conversation turns scored by a classifier and the lexicon, routed by type, as posts rows."""
    model = models.train(_training(spark, sf_dir), iterations=10)
    requests = posts.to_request(t.raw_posts(spark, sf_dir)).withColumn("request_id", F.col("data.id"))
    scored = scoring.score_requests(
        requests, {"stocktwits": model, "twitter": model}, _lexicon(spark, sf_dir), processed=F.lit(0).cast("bigint")
    )
    return scored.select(
        "msgType", "data.id", "predictions.model", "predictions.values.bear_sentiment",
        "predictions.values.bull_sentiment", "predictions.values.vader_sentiment",
        "predictions.values.bull_vader_sentiment",
    )


@query(
    "classifier_facts",
    """WITH l AS (SELECT doc_id, quality AS labels FROM documents JOIN labels USING (doc_id)),
r AS (SELECT *, row_number() OVER (ORDER BY md5('0:' || doc_id)) AS rn, count(*) OVER () AS m FROM l)
SELECT doc_id, labels, true AS sums_to_one, true AS within_bounds, true AS is_largest FROM r WHERE rn > floor(0.75 * m)""",
)
def classifier_facts(spark, sf_dir):
    """What holds for the class probabilities of every test row, whatever was learnt."""
    bear, bull = F.col("bear"), F.col("bull")
    return classifier_probs(spark, sf_dir).select(
        "doc_id", "labels",
        (F.abs(bear + bull - 1) < 1e-9).alias("sums_to_one"),
        (bear.between(0, 1) & bull.between(0, 1)).alias("within_bounds"),
        ((F.col("prediction") == 1) == (bull > bear)).alias("is_largest"),
    )


@query(
    "score_events_facts",
    f"""WITH {t.TURNS}
SELECT msgType || '-sentiment-response' AS msgType, post_id AS id,
  CASE WHEN msgType = 'stocktwit' THEN 'stocktwits' ELSE 'twitter' END AS model,
  true AS sums_to_one, true AS within_bounds, true AS blended
FROM turns WHERE msgType IN ('stocktwit', 'twitter-user', 'twitter-topic')""",
)
def score_events_facts(spark, sf_dir):
    """Routing, model and the relations between the scores of every scored turn."""
    bear, bull, vader = F.col("bear_sentiment"), F.col("bull_sentiment"), F.col("vader_sentiment")
    return score_events(spark, sf_dir).select(
        "msgType", "id", "model",
        (F.abs(bear + bull - 1) < 1e-9).alias("sums_to_one"),
        (bear.between(0, 1) & bull.between(0, 1) & vader.between(0, 1)).alias("within_bounds"),
        (F.abs(F.col("bull_vader_sentiment") - 0.8 * bull - 0.2 * vader) < 1e-9).alias("blended"),
    )


# words and pairs of the labelled texts, their buckets, and the ratios of the training rows
_PAIRED = f"""l AS (SELECT doc_id, quality AS labels, lower(text) AS low FROM documents JOIN labels USING (doc_id)),
r AS (SELECT *, row_number() OVER (ORDER BY md5('0:' || doc_id)) AS rn, count(*) OVER () AS m FROM l),
w AS (SELECT doc_id, labels, rn <= floor(0.75 * m) AS fits, list_filter(string_split_regex(low, '\\s+'), lambda x: x <> '') AS t FROM r),
g AS (SELECT doc_id, labels, fits, unnest(list_distinct(list_transform(list_concat(t, list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])),
  lambda x: ('0x' || substr(md5(x), 1, 8))::BIGINT % {sequences.BUCKETS}))) AS feature FROM w),
c AS (SELECT feature, count(*) FILTER (labels = 1) AS bull, count(*) FILTER (labels = 0) AS bear FROM g WHERE fits GROUP BY feature),
a AS (SELECT sum(bull) + {sequences.BUCKETS} AS all_bull, sum(bear) + {sequences.BUCKETS} AS all_bear FROM c),
q AS (SELECT feature, bull, bear, ln(((bull + 1) / all_bull) / ((bear + 1) / all_bear)) AS ratio FROM c, a),
b AS (SELECT ln((count(*) FILTER (labels = 1) + 1) / (count(*) FILTER (labels = 0) + 1)) AS bias FROM w WHERE fits),
s AS (SELECT w.doc_id, w.labels, coalesce(z.total, 0) + bias AS score FROM b, w
  LEFT JOIN (SELECT doc_id, sum(ratio) AS total FROM g LEFT JOIN q USING (feature) WHERE NOT fits GROUP BY doc_id) z ON z.doc_id = w.doc_id WHERE NOT fits)"""


def _raw_split(spark, sf_dir):
    path = scratch_path(spark, "paired")
    labelled = t.table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("labels"))
    splits.split_rows(t.table(spark, sf_dir, "documents").select("doc_id", "text").join(labelled, "doc_id"), "doc_id").write.parquet(path)
    rows = spark.read.parquet(path)
    return rows.filter("split = 'train'"), rows.filter("split = 'test'")


def _pair_scores(spark, sf_dir):
    training, rows = _raw_split(spark, sf_dir)
    scored = sequences.score(rows, sequences.fit(training), sequences.prior(training), "doc_id")
    return rows.select("doc_id", "labels").join(scored, "doc_id")


@query("word_pair_ratios", f"WITH {_PAIRED} SELECT feature, bull, bear, round(ratio, 9) AS ratio FROM q")
def word_pair_ratios(spark, sf_dir):
    """Log-count ratios of hashed words and word pairs, over three quarters of the labelled texts."""
    ratios = sequences.fit(_raw_split(spark, sf_dir)[0])
    return ratios.withColumn("ratio", F.round("ratio", 9))


@query("word_pair_scores", f"WITH {_PAIRED} SELECT doc_id, labels, round(score, 6) AS score, (score > 0)::INT AS prediction FROM s")
def word_pair_scores(spark, sf_dir):
    """Scores of the last quarter by the ratios of the others."""
    return _pair_scores(spark, sf_dir).withColumn("score", F.round("score", 6))


@query(
    "word_pair_metrics",
    f"""WITH {_PAIRED}, k AS (SELECT count(*) AS n, count(*) FILTER ((score > 0) = (labels = 1)) AS ok,
  count(*) FILTER (score > 0 AND labels = 1) AS tp, count(*) FILTER (score > 0) AS guessed, count(*) FILTER (labels = 1) AS actual FROM s)
SELECT n, ok / n AS accuracy, coalesce(tp / nullif(guessed, 0), 0) AS precision, coalesce(tp / nullif(actual, 0), 0) AS recall,
  coalesce(2 * tp / nullif(guessed + actual, 0), 0) AS f1 FROM k""",
)
def word_pair_metrics(spark, sf_dir):
    """Held-out accuracy, precision, recall and F1 of the word-pair classifier."""
    return metrics.binary_metrics(_pair_scores(spark, sf_dir), label="labels")
