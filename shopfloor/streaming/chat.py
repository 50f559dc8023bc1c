"""Chat ingest as Structured Streaming: the file source and its checkpoint keep the cursor."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StructField, StructType

from shopfloor.operators.sessions import PAIR_DAY, session_minutes, sessions_of_minutes
from shopfloor.plans.chat import normalize


def read_feed(
    spark: SparkSession, folder: str, schema: StructType | str, pattern: str | None = None, max_files: int | None = None
) -> DataFrame:
    """New Parquet files under ``folder`` as a stream, optionally only those named like ``pattern``."""
    reader = spark.readStream.schema(schema).format("parquet")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder)


def stream_normalize(feed: DataFrame, with_ext: bool = False, with_position: bool = False, counts: str | None = None) -> DataFrame:
    """Same rows as the batch function; a map-only stream without state.

    With ``counts`` each micro-batch's progress reports its messages read, parsed and rejected under that name.
    """
    return normalize(feed, with_ext=with_ext, with_position=with_position, counts=counts)


def batch_sink(path: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch writer that is safe to repeat: every micro-batch owns one folder and replaces it."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def dedup_stream(rows: DataFrame, keys: tuple[str, ...] = ("seq", "_position")) -> DataFrame:
    """One row of each key over the whole stream, however late the others come; a null equals a null.

    A message that names a receiver twice keeps both rows, as its positions differ. The keys seen so far are Spark's
    keyed state: a micro-batch looks up its own keys only, and a replayed one starts from the state before it. Start it
    with ``run_available(..., keyed_state=True)``, which keeps that state on disk instead of in executor memory.
    """
    return rows.dropDuplicates(list(keys))


def _days(path: str, spark: SparkSession, days: list) -> list[str]:
    """The folders under ``path`` that hold rows of the given days."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = fs_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    folders = [f"{path}/msg_date={'__HIVE_DEFAULT_PARTITION__' if d is None else d}" for d in days]
    return [f for f in folders if fs.exists(fs_path(f))]


def session_sink(path: str, gap: int = 60) -> Callable[[DataFrame, int], None]:
    """A repeatable writer of sessions by the batch rule, exact however late messages come.

    Each micro-batch stores its distinct minutes by day, and counts anew the sessions of the senders, receivers and days
    it touches. It lists and reads the folders of those days alone, whatever the history holds besides.
    ``latest_sessions`` reads the newest count of each.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, at = batch.sparkSession, f"{path}/minutes"
        minutes = session_minutes(batch).distinct()
        schema = StructType([*minutes.schema.fields, StructField("batch", IntegerType())])
        # Overwrites this batch's own folders only: msg_date=.../batch=n.
        by_day = minutes.withColumn("batch", F.lit(batch_id)).repartition("msg_date", "sender", "receiver")
        by_day.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("msg_date", "batch").parquet(at)

        days = [r[0] for r in minutes.select("msg_date").distinct().collect()]  # one row a day of the batch
        folders = _days(at, spark, days)
        if not folders:  # an empty batch
            return
        known = spark.read.schema(schema).option("basePath", at).parquet(*folders).where(F.col("batch") <= batch_id)
        touched = known.where(F.col("batch") == batch_id).select(*(F.col(k).alias(f"_{k}") for k in PAIR_DAY)).distinct()
        same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in PAIR_DAY))
        whole = known.drop("batch").join(touched, same, "left_semi").distinct()
        sessions_of_minutes(whole, gap).write.mode("overwrite").parquet(f"{path}/sessions/batch={batch_id}")

    return write


def latest_sessions(spark: SparkSession, path: str) -> DataFrame:
    """Sessions per sender, receiver and day after the last micro-batch."""
    rows = spark.read.schema("sender STRING, receiver STRING, msg_date DATE, sessions BIGINT, batch INT").parquet(f"{path}/sessions")
    return rows.groupBy(*PAIR_DAY).agg(F.max_by("sessions", "batch").alias("sessions"))


#: Keyed state in RocksDB, of which a checkpoint stores what a micro-batch changed.
KEYED_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def run_available(
    stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, keyed_state: bool = False
) -> StreamingQuery:
    """Process everything available, then stop; the checkpoint resumes the next call after it."""
    conf = stream.sparkSession.conf
    before = {k: conf.get(k, None) for k in KEYED_STATE} if keyed_state else {}
    for key in before:
        conf.set(key, KEYED_STATE[key])
    try:  # a query takes its settings when it starts
        query = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        for key, value in before.items():
            conf.unset(key) if value is None else conf.set(key, value)
    query.awaitTermination()
    return query
