"""Session settings and durable staging of intermediate results."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Runtime re-planning: skewed join partitions are split, small ones merged, and a join turns into a broadcast join
# only when the measured size of a side is under the threshold. Rows of a variant compress to a fraction, so the stock size of a
# merged partition (64 MB as stored) holds millions of them: sorts and hash tables of one task stay small with less.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32m",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def configure(spark: SparkSession) -> SparkSession:
    """Applies the adaptive settings that a session made elsewhere has not set itself."""
    own = spark.conf.getAll
    for key, value in ADAPTIVE.items():
        if key not in own:
            spark.conf.set(key, value)
    return spark


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the adaptive settings the operators are written for."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**ADAPTIVE, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def staging_root(spark: SparkSession) -> str:
    """The shared folder for staged results: the session's checkpoint folder.

    A local master without one gets a temporary folder; on a cluster the setting is required, because a folder on the
    driver's disk is not visible to executors.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if root:
        return root.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder that every executor can reach")
    root = tempfile.mkdtemp(prefix="varloom-")
    spark.conf.set(CHECKPOINT_CONF, root)
    return root


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    For a result that several branches read: it is computed once, a lost executor costs no recomputation of the
    lineage above it, and each branch still gets column pruning and filter pushdown.
    """
    spark = df.sparkSession
    path = f"{staging_root(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _STAGED.append(path)
    return spark.read.schema(df.schema).parquet(path)


_STAGED: list[str] = []


def release(spark: SparkSession) -> int:
    """Deletes the folders this process has staged, once no frame that reads them is needed; how many there were."""
    jvm, conf, n = spark._jvm, spark._jsc.hadoopConfiguration(), len(_STAGED)
    while _STAGED:
        path = jvm.org.apache.hadoop.fs.Path(_STAGED.pop())
        path.getFileSystem(conf).delete(path, True)
    return n
