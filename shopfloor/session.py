"""Session defaults and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution carries the scale story: it measures every shuffle, splits
# hot partitions, and only broadcasts a side whose measured size is small.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # The JVM never compiles methods beyond 8000 bytes of bytecode. Stages generating longer
    # ones run faster operator by operator.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, shared: str | None = None) -> SparkSession:
    """A session for tests and local benchmarking, with ``shared`` as its shared folder. Clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("shopfloor")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    if shared:
        builder = builder.config("spark.checkpoint.dir", shared)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Only where a session on one machine names none, a temporary one is set."""
    if spark.sparkContext.getCheckpointDir() is None:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(base or tempfile.mkdtemp(prefix="shopfloor-"))
    return spark.sparkContext.getCheckpointDir()


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def settled(df: DataFrame, label: str = "") -> DataFrame:
    """``df`` stored once in the shared folder; usable as the ``stage`` of a plan."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
