"""Session settings and the shared folder used for checkpoints and written intermediates."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime re-planning does the sizing: small partitions merge, skewed joins split,
# and a join side is broadcast only when its measured size is under the threshold.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


# Shuffle volume aimed at per task before small partitions are merged.
PARTITION_MB = 256


def shuffle_partitions(input_gb: float) -> int:
    """Initial shuffle partitions for an input size; AQE merges the ones that turn out small."""
    return max(200, math.ceil(input_gb * 1024 / PARTITION_MB))


def build_session(
    app: str = "ledgerloom", master: str | None = None, input_gb: float | None = None, **conf: str
) -> SparkSession:
    """A session with the engine's settings; `input_gb` sizes shuffles for large inputs."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    sized = {}
    if input_gb is not None:
        sized["spark.sql.shuffle.partitions"] = str(shuffle_partitions(input_gb))
    for key, value in {**SETTINGS, **sized, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, from spark.checkpoint.dir.

    A local session without the setting gets a temporary folder; a cluster without it is an
    error, since a machine-local folder would not survive the loss of that machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerloom-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
