"""Impact and sentiment indices."""

from pyspark.sql import functions as F

from moodgauge.functions.moments import HOUR_MS
from moodgauge.operators import impact, indices
from moodgauge.operators.ordering import last_per_key, whole
from moodgauge.plans import tables as t
from moodgauge.plans.registry import query

_STORED = """
stored AS (SELECT post_type, message_id, max(ms) AS created FROM p GROUP BY ALL),
relevant AS (SELECT post_type, message_id, max(interaction_total) AS interaction_total, max(likes_total) AS likes_total
  FROM p WHERE (post_type, message_id) IN (SELECT (post_type, message_id) FROM stored, clock WHERE created >= now_ms - 43200000)
  GROUP BY ALL)"""


def _stored(versions):
    """One stored post per key, created when its last version was."""
    rows = versions.groupBy("post_type", "message_id").agg(F.max("ms").alias("created_at_epoch_ms"))
    return rows.withColumnRenamed("message_id", "post_id")


def _index(df):
    return df.select(
        "sentiment_type", "sentiment_seconds_back", "created_at_epoch_ms",
        F.col("sentiment_absolute").cast("double").alias("sentiment_absolute"),
    )


def _mean3(total: str, n: str, times: int = 1, over: int = 1) -> str:
    """SQL for total * times / (over * n), an exact mean in thousandths, rounded half up."""
    return f"sign({total}) * ((2 * abs({total}) * {times} + {over} * {n}) // (2 * {over} * {n})) / 1000.0"


def _thousandths(column: str) -> str:
    return f"CAST(round({column} * 1000) AS BIGINT)"


# 50 * mean(0.5 + x) in thousandths
_COMBINED = _mean3(f"sum(500 + {_thousandths('sentiment_absolute')})", "count(*)", 50)


@query(
    "relevant_posts_impact",
    f"""WITH {t.POST_EVENTS}, {_STORED}
SELECT *, CAST(1 + likes_total + CASE WHEN post_type = 'stocktwit' THEN 1 ELSE 3 END * interaction_total AS DOUBLE) AS impact
FROM relevant""",
)
def relevant_posts_impact(spark, sf_dir):
    versions = t.post_events(spark, sf_dir)
    raw = versions.select("post_type", "message_id", "interaction_total", "likes_total")
    found = impact.relevant_engagement(raw, _stored(versions), t.now(spark, sf_dir))
    return impact.with_impact(found).withColumn("impact", F.col("impact").cast("double"))


_PLATFORM_ROWS = f"""
platform AS (SELECT k.kind AS sentiment_type,
    {_mean3("sum(CAST(impact * (sentiment_mixed - 0.5) * 10000 AS BIGINT))", "count(impact)", 1, 10)} AS mean
  FROM (VALUES ('stocktwits'), ('twitter')) k(kind) LEFT JOIN
    (SELECT *, CASE WHEN post_type = 'stocktwit' THEN 'stocktwits' ELSE 'twitter' END AS kind
     FROM posts, clock WHERE created_at_epoch_ms >= now_ms - 43200000) r USING (kind)
  GROUP BY k.kind)"""


@query(
    "platform_sentiment_12h",
    f"""WITH {t.POSTS}, {_PLATFORM_ROWS}
SELECT sentiment_type, CAST(43200 AS BIGINT) AS sentiment_seconds_back, now_ms AS created_at_epoch_ms,
       mean AS sentiment_absolute FROM platform, clock""",
)
def platform_sentiment(spark, sf_dir):
    return _index(indices.platform_sentiment(t.posts(spark, sf_dir), t.now(spark, sf_dir)))


@query(
    "combined_index",
    f"""WITH {t.POST_EVENTS}, {t.PUBLISHED}
SELECT 'social_combined' AS sentiment_type, sentiment_seconds_back, any_value(now_ms) AS created_at_epoch_ms,
       {_COMBINED} AS sentiment_absolute
FROM published, clock
WHERE sentiment_type IN ('stocktwits', 'twitter') AND created_at_epoch_ms >= now_ms - sentiment_seconds_back * 1000
GROUP BY sentiment_seconds_back""",
)
def combined_index(spark, sf_dir):
    return _index(indices.combined_index(t.published(spark, sf_dir), t.now(spark, sf_dir)))


def _feed_sql(name, event_type):
    # both feeds come out on the same scale, so the union only has to be distinct
    return f"""SELECT '{name}' AS sentiment_type, CAST(43200 AS BIGINT) AS sentiment_seconds_back,
       any_value(c.now_ms) AS created_at_epoch_ms,
       {_mean3('sum(CAST(score * 1000 AS BIGINT))', 'count(score)')} AS sentiment_absolute
FROM clock c LEFT JOIN (SELECT DISTINCT received, score FROM feeds, clock
  WHERE event_type = '{event_type}' AND received >= now_ms - 43200000) ON true"""


@query("social_ensemble", f"WITH {t.POST_EVENTS}, {t.FEEDS} {_feed_sql('social_external_ensemble', 'signup')}")
def social_ensemble(spark, sf_dir):
    feeds = t.feeds(spark, sf_dir)
    return _index(indices.social_ensemble(feeds["sentiment_percent"], feeds["sentiment_score"], t.now(spark, sf_dir)))


@query("news_ensemble", f"WITH {t.POST_EVENTS}, {t.FEEDS} {_feed_sql('news_external_ensemble', 'error')}")
def news_ensemble(spark, sf_dir):
    feeds = t.feeds(spark, sf_dir)
    return _index(indices.news_ensemble(feeds["news_score"], feeds["buzz"], t.now(spark, sf_dir)))


_EXTERNAL_MEAN = _mean3(f"sum({_thousandths('sentiment_absolute')})", "count(*)")
_EXTERNAL = """SELECT 'global_external_ensemble' AS sentiment_type, CAST(43200 AS BIGINT) AS sentiment_seconds_back,
       any_value(now_ms) AS created_at_epoch_ms,
       {mean} AS sentiment_absolute
FROM {rows}, clock WHERE created_at_epoch_ms >= now_ms - 43200000
  AND sentiment_type IN ('news_external_ensemble', 'social_external_ensemble')"""


@query("external_ensemble", f"WITH {t.POST_EVENTS}, {t.PUBLISHED} {_EXTERNAL.format(rows='published', mean=_EXTERNAL_MEAN)}")
def external_ensemble(spark, sf_dir):
    return _index(indices.external_ensemble(t.published(spark, sf_dir), t.now(spark, sf_dir)))


@query(
    "publish_indices",
    f"""WITH {t.POSTS}, {t.PUBLISHED}, {t.FEEDS}, {_PLATFORM_ROWS},
rows1 AS (SELECT sentiment_type, CAST(43200 AS BIGINT) AS sentiment_seconds_back, now_ms AS created_at_epoch_ms,
            mean AS sentiment_absolute FROM platform, clock),
social AS ({_feed_sql('social_external_ensemble', 'signup')}),
news AS ({_feed_sql('news_external_ensemble', 'error')}),
seen1 AS (SELECT * FROM published UNION ALL SELECT * FROM rows1),
seen2 AS (SELECT sentiment_type, sentiment_seconds_back, created_at_epoch_ms,
            CAST(sentiment_absolute AS DOUBLE) AS sentiment_absolute FROM published
          UNION ALL SELECT * FROM social UNION ALL SELECT * FROM news)
SELECT sentiment_type, sentiment_seconds_back, created_at_epoch_ms, CAST(sentiment_absolute AS DOUBLE) AS sentiment_absolute
FROM rows1
UNION ALL SELECT 'social_combined', sentiment_seconds_back, any_value(now_ms),
  {_COMBINED}
  FROM seen1, clock WHERE sentiment_type IN ('stocktwits', 'twitter')
    AND created_at_epoch_ms >= now_ms - sentiment_seconds_back * 1000 GROUP BY sentiment_seconds_back
UNION ALL SELECT * FROM social UNION ALL SELECT * FROM news
UNION ALL {_EXTERNAL.format(rows='seen2', mean=_EXTERNAL_MEAN)}""",
)
def publish_indices(spark, sf_dir):
    rows = indices.publish_all(
        t.posts(spark, sf_dir), t.published(spark, sf_dir), t.feeds(spark, sf_dir), t.now(spark, sf_dir)
    )
    return _index(rows)


@query(
    "trailing_sentiment_12h",
    f"""WITH {t.POSTS},
r AS (SELECT *, CASE WHEN post_type = 'stocktwit' THEN 'stocktwits' ELSE 'twitter' END AS platform FROM posts),
w AS (SELECT platform, created_at_epoch_ms, count(*) OVER s AS n_posts,
        CAST(sum(impact * (sentiment_mixed - 0.5)) OVER s * 10000 AS BIGINT) AS total
      FROM r WINDOW s AS (PARTITION BY platform ORDER BY created_at_epoch_ms
                          RANGE BETWEEN 43200000 PRECEDING AND CURRENT ROW))
SELECT DISTINCT platform, created_at_epoch_ms, n_posts,
       sign(total) * ((2 * abs(total) + 10 * n_posts) // (20 * n_posts)) / 1000.0 AS sentiment_absolute
FROM w""",
)
def trailing_sentiment(spark, sf_dir):
    series = indices.trailing_sentiment(t.posts(spark, sf_dir))
    return series.withColumn("sentiment_absolute", F.col("sentiment_absolute").cast("double"))


@query(
    "backfill_seconds_back",
    f"""WITH {t.POST_EVENTS}, {t.PUBLISHED}
SELECT sentiment_type, CASE WHEN created_at_epoch_ms >= now_ms - 7 * 86400000 THEN 10800000
         ELSE sentiment_seconds_back END AS sentiment_seconds_back,
       created_at_epoch_ms, CAST(sentiment_absolute AS DOUBLE) AS sentiment_absolute FROM published, clock""",
)
def backfill_seconds_back(spark, sf_dir):
    return _index(indices.backfill_seconds_back(t.published(spark, sf_dir), t.now(spark, sf_dir), days=7))


_VALUES = ["interaction_total", "likes_total"]


@query(
    "changed_versions",
    f"""WITH {t.POST_EVENTS},
v AS (SELECT *, row_number() OVER k AS rn, lag(interaction_total) OVER k AS pi, lag(likes_total) OVER k AS pl FROM p
      WINDOW k AS (PARTITION BY post_type, message_id ORDER BY ms, event_id))
SELECT event_id, post_type, message_id, interaction_total, likes_total, ms FROM v
WHERE rn = 1 OR interaction_total IS DISTINCT FROM pi OR likes_total IS DISTINCT FROM pl""",
)
def changed_versions(spark, sf_dir):
    versions = t.post_events(spark, sf_dir).select("event_id", "post_type", "message_id", *_VALUES, "ms")
    hour = whole(F.col("ms"), HOUR_MS)
    return impact.changed_versions(versions, ["ms", "event_id"], _VALUES, hour)


_SNAPSHOTS = """
old AS (SELECT post_type, message_id, max(interaction_total) AS i, max(likes_total) AS l FROM p, clock
        WHERE ms < now_ms - 86400000 GROUP BY ALL),
new AS (SELECT post_type, message_id, max(interaction_total) AS i, max(likes_total) AS l FROM p GROUP BY ALL)"""


def _snapshots(spark, sf_dir):
    versions = t.post_events(spark, sf_dir)
    day_ago = t.now(spark, sf_dir) - 24 * HOUR_MS
    high = [F.max(v).alias(v) for v in _VALUES]
    current = versions.groupBy(*impact.KEY).agg(*high)
    return current, versions.filter(F.col("ms") < day_ago).groupBy(*impact.KEY).agg(*high)


@query(
    "changed_engagement",
    f"""WITH {t.POST_EVENTS}, {_SNAPSHOTS}
SELECT n.post_type, n.message_id, n.i AS interaction_total, n.l AS likes_total FROM new n
LEFT JOIN old o ON o.post_type = n.post_type AND o.message_id = n.message_id
WHERE o.post_type IS NULL OR o.i IS DISTINCT FROM n.i OR o.l IS DISTINCT FROM n.l""",
)
def changed_engagement(spark, sf_dir):
    return impact.changed(*_snapshots(spark, sf_dir))


@query(
    "apply_impact_update",
    f"""WITH {t.POST_EVENTS}, {_STORED}
SELECT s.post_type, s.message_id AS post_id, s.created AS created_at_epoch_ms,
  CAST(coalesce(1 + likes_total + CASE WHEN s.post_type = 'stocktwit' THEN 1 ELSE 3 END * interaction_total, 1) AS DOUBLE) AS impact
FROM stored s LEFT JOIN relevant r ON r.post_type = s.post_type AND r.message_id = s.message_id""",
)
def apply_impact_update(spark, sf_dir):
    versions = t.post_events(spark, sf_dir)
    stored = _stored(versions)
    raw = versions.select("post_type", "message_id", *_VALUES)
    updates = impact.with_impact(impact.relevant_engagement(raw, stored, t.now(spark, sf_dir)))
    done = impact.apply_impact(stored.withColumn("impact", F.lit(1)), updates)
    return done.withColumn("impact", F.col("impact").cast("double"))


@query(
    "latest_version",
    f"""WITH {t.POST_EVENTS}
SELECT post_type, message_id, event_id, user_id, likes_total, ms FROM p
QUALIFY row_number() OVER (PARTITION BY post_type, message_id ORDER BY ms DESC, event_id DESC) = 1""",
)
def latest_version(spark, sf_dir):
    versions = t.post_events(spark, sf_dir).select("post_type", "message_id", "event_id", "user_id", "likes_total", "ms")
    return last_per_key(versions, impact.KEY, ["ms", "event_id"])
