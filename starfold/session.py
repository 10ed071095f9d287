"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "zstd",
}

# Whole-stage code for a wide projection is one method, and the JVM only interprets methods above 8000 bytes. With this
# limit Spark falls back to smaller generated methods there, which the JVM compiles: cleaning all 32 columns runs several
# times faster. Sessions built elsewhere should set it too.
DEFAULTS["spark.sql.codegen.hugeMethodLimit"] = "8000"


def build_session(app: str = "starfold", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; any of them can be overridden by ``conf``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shuffle_conf(input_bytes: int, target_bytes: int = 128 << 20) -> dict[str, str]:
    """Shuffle settings for a known input size.

    The initial partition number is sized so that a partition fits in task
    memory before any coalescing; adaptive execution merges the small ones.
    """
    partitions = max(8, -(-input_bytes // target_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_bytes),
    }


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, removed when the session ends.

    The cluster names that shared folder. Only where it is unset (local runs and
    tests, with every task on this machine) a local folder is chosen and recorded.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="starfold-")
        spark.conf.set("spark.checkpoint.dir", root)
        _delete_on_exit(spark, root)
    path = f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _delete_on_exit(spark, path)
    return path


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps, which it does once the driver has collected their plans.

    The driver collects when its own memory fills up, so left alone the files of a whole load stay on the executors' disks.
    Files of the step that ended last may only go with the next call.
    """
    gc.collect()
    spark._jvm.System.gc()


def _delete_on_exit(spark: SparkSession, path: str) -> None:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
