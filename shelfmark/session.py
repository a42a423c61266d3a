"""Session settings the jobs are tuned for, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the jobs were tuned with. AQE merges small shuffle partitions and
# splits skewed ones towards the advisory size, but it does not split partitions
# that are all too large: how many there are at first must follow the input, see
# ``build_session``.
ADVISORY_BYTES = 128 << 20
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def first_partitions(input_bytes: int) -> int:
    """Shuffle partitions to begin with, for AQE to merge: as many as the input has advisory sizes."""
    return max(200, -(-input_bytes // ADVISORY_BYTES))


def build_session(
    app_name: str, master: str | None = None, input_bytes: int | None = None, **conf: str
) -> SparkSession:
    """A session with ``conf``; the recommended settings fill in what nobody else set.

    ``input_bytes``, about what a run reads, sets the number of shuffle
    partitions that AQE begins with. On a large cluster give it, or set
    ``spark.sql.shuffle.partitions``; the default of Spark is 200.
    """
    if input_bytes is not None:
        initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
        conf = {initial: str(first_partitions(input_bytes)), **conf}
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {"spark.ui.enabled": "false", **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    given = spark.sparkContext.getConf()
    for key, value in RECOMMENDED_CONF.items():
        if not given.contains(key):
            spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder the cluster names in ``spark.checkpoint.dir``.

    A folder on one machine is only used in local mode, where every task runs
    on that machine; on a cluster an unset folder is an error.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="shelfmark-")
        sc.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
