"""Session helpers: a local session for tests and benches, and the shared working folder."""

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cpus: int = 8, app: str = "moodgauge") -> SparkSession:
    """A session for one machine; on a cluster the caller brings their own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("MOODGAUGE_DRIVER_MEMORY", "8g"))
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in `spark.checkpoint.dir`.

    A machine-local folder is used only when the session itself runs on one machine.
    """
    context = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_CONF, None) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="moodgauge-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/moodgauge/{name}-{uuid.uuid4().hex}"
