"""Trailing sentiment per pane on a stream against plain Python."""

import collections
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from moodgauge.streaming import changes, panes

STEP, LENGTH = 30_000, 3_600_000


def test_borders():
    ends = np.array([30, 90, 300])
    for after, until in ((-1, 400), (-1, 90), (60, 100), (90, 90), (120, 310)):
        want = [e for e in range(0, 1000, 30) if max(after, 0) < e <= until and any(e - 120 < p <= e for p in ends)]
        assert [e for part in panes.borders(ends, 120, 30, after // 30 * 30, until // 30 * 30) for e in part] == want
    assert sum(len(x) for x in panes.borders(ends[:0], 120, 30, 0, 900)) == 0


def plain(rows, watermark):
    """(platform, end) to (posts, mean) for all borders that the watermark has passed."""
    sums = collections.defaultdict(lambda: [0, 0, Decimal(0)])
    for kind, impact, mixed, ms in rows:
        platform = {"stocktwit": "stocktwits", "twitter-topic": "twitter", "twitter-user": "twitter"}.get(kind)
        if platform is None or ms is None:
            continue
        for k in range(LENGTH // STEP):
            own = sums[platform, (ms // STEP + 1 + k) * STEP]
            own[0] += 1
            if impact is not None and mixed is not None:
                own[1] += 1
                own[2] += impact * (mixed - Decimal("0.5"))
    return {key: (n, (s / rated).quantize(Decimal("0.001"), ROUND_HALF_UP) if rated else None) for key, (n, rated, s) in sums.items() if key[1] <= watermark}


def test_late_posts_gaps_and_nulls(spark, tmp_path):
    rng = np.random.default_rng(3)
    kinds = ["stocktwit", "twitter-topic", "twitter-user", "other", None]
    base = 1_700_000_000_000
    rows = []
    for k in range(300):
        ms = base + int(rng.integers(0, 4 * LENGTH)) + (0 if k % 3 else 40 * LENGTH)  # a gap of many look-backs
        rows.append((kinds[int(rng.integers(0, 5))], None if k % 17 == 0 else Decimal(int(rng.integers(1, 900))), None if k % 23 == 0 else Decimal(int(rng.integers(0, 101))) / 100, ms))
    rows += [("stocktwit", Decimal(2), Decimal("0.9"), base + STEP), ("stocktwit", Decimal(2), Decimal("0.9"), base + STEP), ("stocktwit", None, None, None), ("other", Decimal(1), Decimal(1), base + 46 * LENGTH)]
    received = sorted(rows, key=lambda r: (r[3] or 0) + (1_500_000 if hash(r[0]) and (r[3] or 0) % 7 == 0 else 0))
    schema = "post_type string, impact decimal(10,2), sentiment_mixed decimal(5,2), ms long"
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    session = changes.with_state_store(spark)

    def run():
        stream = session.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path).withColumn("at", F.timestamp_millis("ms"))
        found = panes.trailing_panes(stream, "at", 30, LENGTH // 1000, "1 hour")
        found.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()

    for part in range(5):
        spark.createDataFrame(received[part * len(rows) // 5 : (part + 1) * len(rows) // 5], schema).coalesce(1).write.mode("append").parquet(path)
        if part in (1, 4):
            run()  # the second run goes on from the state of the first
    kinds_known = [r for r in rows if r[0] in kinds[:3] and r[3] is not None]
    watermark = max(r[3] for r in kinds_known) - LENGTH
    got = [(r.sentiment_type, r.end_ms, r.n_posts, r.sentiment_absolute) for r in spark.read.parquet(out).collect()]
    assert len({g[:2] for g in got}) == len(got)  # each border once
    assert {g[:2]: g[2:] for g in got} == plain(rows, watermark)


def test_uneven_look_back(spark):
    with pytest.raises(ValueError):
        panes.trailing_panes(spark.range(1), "id", 30, 100)
