"""Account camps and labelled corpora."""

from pyspark.sql import functions as F

from moodgauge.functions.numeric import numeric_label, repeat_factor
from moodgauge.operators import accounts, labelling, metrics, splits
from moodgauge.plans import tables as t
from moodgauge.plans.registry import query
from moodgauge.session import scratch_path
from moodgauge.sources import readers, writers

_FRIENDS = "friends AS (SELECT id, name, screen_name FROM a WHERE segment IN ('BUILDING', 'MACHINERY'))"
_FOLLOWERS = "followers AS (SELECT id, name, screen_name FROM a WHERE nation < 15)"
_LEADERS = "leaders AS (SELECT id, name, screen_name FROM a WHERE nation % 5 = 0)"


def _sides(spark, sf_dir):
    """(friends, followers, leaders)"""
    all_accounts = t.accounts(spark, sf_dir)
    return tuple(
        all_accounts.filter(keep).select(*accounts.FIELDS)
        for keep in ("segment in ('BUILDING', 'MACHINERY')", "nation < 15", "nation % 5 = 0")
    )


@query(
    "camps_union",
    f"""WITH {t.ACCOUNTS}, {_FRIENDS}, {_FOLLOWERS}, {_LEADERS}
SELECT * FROM friends UNION SELECT * FROM followers UNION SELECT * FROM leaders""",
)
def camps_union(spark, sf_dir):
    friends, followers, leaders = _sides(spark, sf_dir)
    return accounts.extended_camp(leaders, friends, followers, intersect=False)


@query(
    "camps_intersect",
    f"""WITH {t.ACCOUNTS}, {_FRIENDS}, {_FOLLOWERS}, {_LEADERS}
SELECT f.* FROM followers f JOIN friends USING (id) UNION SELECT * FROM leaders""",
)
def camps_intersect(spark, sf_dir):
    friends, followers, leaders = _sides(spark, sf_dir)
    return accounts.extended_camp(leaders, friends, followers)


@query(
    "camps_difference",
    f"""WITH {t.ACCOUNTS}, {_FRIENDS}, {_FOLLOWERS}
SELECT * FROM followers WHERE id NOT IN (SELECT id FROM friends)""",
)
def camps_difference(spark, sf_dir):
    friends, followers, _ = _sides(spark, sf_dir)
    return accounts.without(followers, friends)


def _camps(spark, sf_dir):
    friends, followers, _ = _sides(spark, sf_dir)
    return accounts.tag_camps(friends, followers)


_TAGGED = f"""{_FRIENDS}, {_FOLLOWERS},
camps AS (SELECT *, 'Bullish' AS sentiment FROM friends
          UNION ALL SELECT *, 'Bearish' FROM followers WHERE id NOT IN (SELECT id FROM friends))"""


@query("camps_tagged", f"WITH {t.ACCOUNTS}, {_TAGGED} SELECT * FROM camps")
def camps_tagged(spark, sf_dir):
    return _camps(spark, sf_dir)


@query(
    "renamed_accounts",
    f"""WITH {t.ACCOUNTS}, both_names AS (SELECT id, name, screen_name FROM a UNION SELECT id, name, 'new' || id FROM a WHERE id % 3 = 0)
SELECT id, name, min(screen_name) AS screen_name FROM both_names GROUP BY id, name""",
)
def renamed_accounts(spark, sf_dir):
    known = t.accounts(spark, sf_dir).select(*accounts.FIELDS)
    renamed = known.filter("id % 3 = 0").withColumn("screen_name", F.concat(F.lit("new"), "id"))
    return accounts.one_row_per_account(accounts.any_way(known, renamed))


_LISTS = """lists AS (SELECT DISTINCT c_mktsegment AS list_id,
    CASE WHEN c_mktsegment IN ('BUILDING', 'FURNITURE') THEN 'bulls' ELSE 'bears' END AS camp FROM customer),
members AS (SELECT a.*, segment AS list_id FROM a JOIN lists ON list_id = segment WHERE camp = 'bulls')"""


def _members(spark, sf_dir):
    known = t.accounts(spark, sf_dir).withColumnRenamed("segment", "list_id")
    camp = F.when(F.col("list_id").isin("BUILDING", "FURNITURE"), "bulls").otherwise("bears")
    lists = known.select("list_id").distinct().withColumn("camp", camp)
    return accounts.members_of(lists, known, "bulls")


@query("list_members", f"WITH {t.ACCOUNTS}, {_LISTS} SELECT id, name, screen_name FROM members")
def list_members(spark, sf_dir):
    return accounts.list_accounts(_members(spark, sf_dir), ["list_id", "screen_name"])


@query(
    "expand_relationships",
    f"""WITH {t.ACCOUNTS}, {_LISTS},
edges AS (SELECT o_custkey AS src, o_orderkey % (SELECT count(*) FROM customer) AS id, o_orderstatus AS name,
                 'user' || o_orderpriority AS screen_name, o_orderkey AS place FROM orders)
SELECT id, name, screen_name FROM edges WHERE src IN (SELECT id FROM members)
QUALIFY row_number() OVER (PARTITION BY id ORDER BY place) = 1""",
)
def expand_relationships(spark, sf_dir):
    how_many = t.table(spark, sf_dir, "customer").agg(F.count("*")).scalar()
    edges = t.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("src"),
        (F.col("o_orderkey") % how_many).alias("id"),
        F.col("o_orderstatus").alias("name"),
        F.concat(F.lit("user"), "o_orderpriority").alias("screen_name"),
        F.col("o_orderkey").alias("place"),
    )
    return accounts.related_accounts(_members(spark, sf_dir), edges, ["place"])


_AUTHORED = """authored AS (SELECT o_orderkey AS post_id, 'user' || o_custkey AS user_name, o_totalprice / 1000 AS impact,
  'see https://x.example/' || o_orderkey || ' @user' || o_custkey || ' it&#39;s ' || lower(o_orderpriority) || ' &amp; more  @here'
    AS body FROM orders)"""


def _authored(spark, sf_dir):
    """Orders as posts of customers."""
    return t.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("post_id"),
        F.concat(F.lit("user"), "o_custkey").alias("user_name"),
        (F.col("o_totalprice") / 1000).alias("impact"),
        F.concat(
            F.lit("see https://x.example/"), "o_orderkey", F.lit(" @user"), "o_custkey", F.lit(" it&#39;s "),
            F.lower("o_orderpriority"), F.lit(" &amp; more  @here"),
        ).alias("body"),
    )


@query(
    "label_by_author",
    f"""WITH {t.ACCOUNTS}, {_TAGGED}, {_AUTHORED}
SELECT post_id, user_name, id, name, CASE WHEN user_name = 'user7' THEN 'Bearish' ELSE sentiment END AS sentiment
FROM authored JOIN camps ON user_name = screen_name""",
)
def label_by_author(spark, sf_dir):
    posts = _authored(spark, sf_dir).select("post_id", "user_name")
    return labelling.override_label(labelling.label_by_author(posts, _camps(spark, sf_dir)), ["user7"])


@query(
    "label_all_posts",
    f"""WITH {t.ACCOUNTS}, {_TAGGED}, {_AUTHORED}
SELECT post_id, user_name, id, name, sentiment FROM authored LEFT JOIN camps ON user_name = screen_name""",
)
def label_all_posts(spark, sf_dir):
    posts = _authored(spark, sf_dir).select("post_id", "user_name")
    return labelling.label_by_author(posts, _camps(spark, sf_dir), "left")


@query(
    "unknown_authors",
    f"""WITH {t.ACCOUNTS}, {_TAGGED}, {_AUTHORED}
SELECT user_name AS screen_name, count(*) AS counts FROM authored
WHERE user_name NOT IN (SELECT screen_name FROM camps) GROUP BY ALL""",
)
def unknown_authors(spark, sf_dir):
    return labelling.unknown_authors(_authored(spark, sf_dir), _camps(spark, sf_dir))


@query(
    "labelled_corpus",
    f"""WITH {t.ACCOUNTS}, {_TAGGED}, {_AUTHORED}
SELECT post_id, user_name, CASE WHEN user_name = 'user7' OR sentiment = 'Bearish' THEN 0 ELSE 1 END AS labels,
  'see it#39;s' AS head, CAST(trunc(impact / 100 + 1) AS INTEGER) AS repeat, length(body) AS n
FROM authored JOIN camps ON user_name = screen_name""".replace("'see it#39;s' AS head", "'see it''s ' AS head"),
)
def labelled_corpus(spark, sf_dir):
    labelled = labelling.label_posts(_authored(spark, sf_dir), _camps(spark, sf_dir), ["user7"])
    rows = labelling.labelled_rows(labelled)
    return rows.select("post_id", "user_name", "labels", F.substring("text", 1, 9).alias("head"), "repeat", F.length("body").alias("n"))


@query(
    "training_extract",
    f"""WITH {t.POSTS}
SELECT post_id, post_type, body, user_name, CAST(impact AS DOUBLE) AS impact, created_at_epoch_ms, client_received_epoch_ms,
  CAST(sentiment_ml_model AS DOUBLE) AS original_ml_sentiment,
  CAST(sentiment_vader_normalized AS DOUBLE) AS sentiment_vader_normalized,
  CAST(sentiment_mixed AS DOUBLE) AS original_sentiment_mixed
FROM posts, clock WHERE created_at_epoch_ms >= now_ms - 14 * 86400000 AND post_type <> 'stocktwit'""",
)
def training_extract(spark, sf_dir):
    posts = t.posts(spark, sf_dir).withColumn("link", F.lit(""))
    rows = labelling.training_extract(posts, t.now(spark, sf_dir)).drop("link")
    return rows.select(*[F.col(n).cast("double").alias(n) if k.startswith("decimal") else n for n, k in rows.dtypes])


@query(
    "repeat_by_impact",
    f"""WITH {t.POSTS}
SELECT post_id, CAST(trunc(CAST(impact AS DOUBLE) / 100 + 1) AS INTEGER) AS repeat, unnest(range(CAST(trunc(CAST(impact AS DOUBLE) / 100 + 1) AS BIGINT))) * 0 AS zero
FROM posts""",
)
def repeat_by_impact(spark, sf_dir):
    posts = t.posts(spark, sf_dir).select("post_id", repeat_factor(F.col("impact")).alias("repeat"))
    return labelling.repeat_rows(posts, F.col("repeat")).withColumn("zero", F.lit(0).cast("bigint"))


def _sentiments(spark, sf_dir):
    label = F.when(F.col("toxic") == 1, "Undetermined").when(F.col("quality") == 1, "Bullish").otherwise("Bearish")
    return t.table(spark, sf_dir, "labels").select("doc_id", label.alias("sentiment"))


@query(
    "numeric_labels",
    """SELECT doc_id, sentiment, CASE sentiment WHEN 'Bullish' THEN 1 ELSE 0 END AS labels
FROM (SELECT doc_id, CASE WHEN toxic = 1 THEN 'Undetermined' WHEN quality = 1 THEN 'Bullish' ELSE 'Bearish' END AS sentiment FROM labels)
WHERE sentiment <> 'Undetermined'""",
)
def numeric_labels(spark, sf_dir):
    return labelling.labelled_rows(_sentiments(spark, sf_dir))


@query("class_balance", "SELECT count(*) AS n_rows, avg(CASE WHEN quality = 1 THEN 1.0 ELSE 0.0 END) AS share_of_1 FROM labels")
def class_balance(spark, sf_dir):
    return labelling.class_balance(t.table(spark, sf_dir, "labels"), "quality")


@query(
    "shift_labels",
    """SELECT doc_id, quality * 2 + toxic + 3 - lo AS labels, hi - lo + 1 AS n_classes FROM labels,
(SELECT min(quality * 2 + toxic + 3) AS lo, max(quality * 2 + toxic + 3) AS hi FROM labels)""",
)
def shift_labels(spark, sf_dir):
    coded = t.table(spark, sf_dir, "labels").select("doc_id", (F.col("quality") * 2 + F.col("toxic") + 3).alias("labels"))
    return labelling.shift_labels(coded)


@query("unlabelled", "SELECT doc_id, 0 AS labels FROM documents")
def unlabelled(spark, sf_dir):
    return labelling.unlabelled(t.table(spark, sf_dir, "documents").select("doc_id"))


@query("row_ids", "SELECT doc_id * 3 + 1 AS key, row_number() OVER (ORDER BY doc_id) - 1 AS id FROM documents")
def row_ids(spark, sf_dir):
    keyed = t.table(spark, sf_dir, "documents").select((F.col("doc_id") * 3 + 1).alias("key"))
    return labelling.add_row_id(keyed, "key")


@query(
    "train_test_split",
    """WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY md5('0:' || doc_id)) AS rn, count(*) OVER () AS m FROM documents)
SELECT doc_id, CASE WHEN rn <= floor(0.75 * m) THEN 'train' ELSE 'test' END AS split FROM r""",
)
def train_test_split(spark, sf_dir):
    return splits.split_rows(t.table(spark, sf_dir, "documents").select("doc_id"), "doc_id")


@query(
    "train_validate_test_split",
    """WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY md5('9:' || doc_id)) AS rn, count(*) OVER () AS m FROM labels)
SELECT doc_id, CASE WHEN rn <= floor(0.6 * m) THEN 'train' WHEN rn <= floor(0.6 * m) + floor(0.15 * m) THEN 'validate'
  ELSE 'test' END AS split FROM r""",
)
def train_validate_test_split(spark, sf_dir):
    return splits.split_rows(t.table(spark, sf_dir, "labels").select("doc_id"), "doc_id", 0.6, 0.15, seed=9)


@query("sample_n", "SELECT event_id, user_id FROM events ORDER BY md5('4:' || event_id) LIMIT 500")
def sample_n(spark, sf_dir):
    return splits.sample_rows(t.table(spark, sf_dir, "events").select("event_id", "user_id"), "event_id", 500, seed=4)


@query(
    "language_model_split",
    """WITH u AS (SELECT 'd' || doc_id AS id FROM documents UNION ALL SELECT 'b' || item_id FROM benchmark),
r AS (SELECT id, row_number() OVER (ORDER BY md5('0:' || id)) AS rn, count(*) OVER () AS m FROM u)
SELECT id, 0 AS labels, CASE WHEN rn <= floor(0.9 * m) THEN 'train' ELSE 'test' END AS split FROM r""",
)
def language_model_split(spark, sf_dir):
    docs = t.table(spark, sf_dir, "documents").select(F.concat(F.lit("d"), "doc_id").alias("id"))
    items = t.table(spark, sf_dir, "benchmark").select(F.concat(F.lit("b"), "item_id").alias("id"))
    return splits.language_model_split(docs, items, "id")


def _judged(spark, sf_dir):
    return t.table(spark, sf_dir, "labels").select(F.col("quality").alias("label"), F.col("toxic").alias("prediction"))


@query("confusion", "SELECT quality AS label, toxic AS prediction, count(*) AS n FROM labels GROUP BY ALL")
def confusion(spark, sf_dir):
    return metrics.confusion(_judged(spark, sf_dir))


@query(
    "binary_metrics",
    """WITH s AS (SELECT count(*) AS n, count(*) FILTER (quality = toxic) AS ok, count(*) FILTER (quality = 1 AND toxic = 1) AS tp,
  count(*) FILTER (toxic = 1) AS guessed, count(*) FILTER (quality = 1) AS actual FROM labels)
SELECT n, ok / n AS accuracy, tp / guessed AS precision, tp / actual AS recall, 2 * tp / (guessed + actual) AS f1 FROM s""",
)
def binary_metrics(spark, sf_dir):
    return metrics.binary_metrics(_judged(spark, sf_dir))


@query(
    "class_report",
    """SELECT c AS class, count(*) FILTER (quality = c AND toxic = c) / count(*) FILTER (toxic = c) AS precision,
  count(*) FILTER (quality = c AND toxic = c) / count(*) FILTER (quality = c) AS recall,
  2 * count(*) FILTER (quality = c AND toxic = c) / (count(*) FILTER (toxic = c) + count(*) FILTER (quality = c)) AS f1,
  count(*) FILTER (quality = c) AS support
FROM labels, (VALUES (0), (1)) v(c) GROUP BY c""",
)
def class_report(spark, sf_dir):
    return metrics.class_report(_judged(spark, sf_dir))


@query(
    "json_round_trip",
    "SELECT DISTINCT text, n_chars FROM documents",
)
def json_round_trip(spark, sf_dir):
    """Distinct texts through gzip JSON lines."""
    path = scratch_path(spark, "json")
    writers.write_json_lines(t.table(spark, sf_dir, "documents").select("text", "n_chars"), path)
    return readers.read_json_lines(spark, path, "text string, n_chars bigint")


@query("csv_round_trip", "SELECT quality AS labels, text FROM documents JOIN labels USING (doc_id)")
def csv_round_trip(spark, sf_dir):
    """Labelled texts, line breaks and quotes included, through headerless CSV."""
    path = scratch_path(spark, "csv")
    labels = t.table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("labels"))
    writers.write_labelled_csv(t.table(spark, sf_dir, "documents").join(labels, "doc_id"), path)
    return readers.read_labelled_csv(spark, path)


@query(
    "label_prefixed_scan",
    """SELECT CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS labels, ' event ' || event_id AS text FROM events""",
)
def label_prefixed_scan(spark, sf_dir):
    path = scratch_path(spark, "prefixed")
    label = F.when(F.col("event_type") == "error", "__label__1").otherwise("__label__2")
    lines = F.concat(label, F.lit(" event "), F.col("event_id").cast("string"))
    t.table(spark, sf_dir, "events").select(lines.alias("value")).write.text(path)
    return readers.read_label_prefixed(spark, path)


@query(
    "sentiment_by_label",
    "SELECT label, count(*) AS n FROM (SELECT CASE WHEN quality = 1 THEN 1 ELSE 0 END AS label FROM labels) GROUP BY label",
)
def sentiment_by_label(spark, sf_dir):
    named = F.when(F.col("quality") == 1, "Bullish").otherwise("Bearish")
    labels = t.table(spark, sf_dir, "labels").select(numeric_label(named).alias("label"))
    return labels.groupBy("label").agg(F.count("*").alias("n"))
