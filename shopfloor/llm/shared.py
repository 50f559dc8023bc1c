"""Cutting lineage in the shared folder, and other small helpers of this subpackage."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space between words: space and the five control characters 9 to 13.
WHITE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Only where a session on one machine names none, a temporary one is set."""
    if spark.sparkContext.getCheckpointDir() is None:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(base or tempfile.mkdtemp(prefix="settled-"))
    return spark.sparkContext.getCheckpointDir()


def settle(df: DataFrame) -> DataFrame:
    """``df`` stored once in the shared folder, so that lost executors cost no recomputation of what led to it."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def free_shuffles(spark: SparkSession) -> None:
    """Lets Spark drop the shuffle files of steps that nothing refers to; else they stay until the driver happens to collect its garbage."""
    gc.collect()
    spark._jvm.System.gc()


@contextmanager
def stored(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` written once as Parquet in the shared folder, for several readers that end within the block."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/rows-{uuid.uuid4().hex}"
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of ``folder``. Python workers that start elsewhere find this library where the driver has it."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """The words of a text as an array; none for null or blank text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WHITE), "")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
