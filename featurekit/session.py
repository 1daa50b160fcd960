"""Session settings, the shared checkpoint folder and durable intermediate results."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution re-plans joins and splits skewed partitions; the rest keeps results reproducible.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # The JVM does not compile methods beyond 8000 bytes of code, which wide projections exceed when fused.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(app: str, master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only for an unset local session."""
    context = spark.sparkContext
    root = context.getCheckpointDir()
    if root:
        return root
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        context.setCheckpointDir(configured)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="featurekit-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    return context.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared checkpoint folder, so that a lost executor costs no recomputation."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder; it is deleted when the session's application ends."""
    folder = f"{checkpoint_root(spark)}/tables/{uuid.uuid4().hex}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return f"{folder}/{name}"


def materialize_by(df: DataFrame, column: str) -> DataFrame:
    """Like :func:`materialize`, as a Parquet table split by ``column``: a filter on it reads only its part.

    Rows are brought together by ``column`` first, and large parts are split again, so that files are neither many
    nor huge.
    """
    path = scratch_path(df.sparkSession, f"by_{column}")
    df.hint("rebalance", column).write.partitionBy(column).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
