"""All registered queries."""

from moodgauge.plans import corpus, events, labels, logs, sentiment, streams  # noqa: F401
from moodgauge.plans.registry import QUERIES, SQL  # noqa: F401
