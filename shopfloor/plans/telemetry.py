"""Failure and run statistics of the ingest jobs, from their logs as tables or text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopfloor.functions.columns import safe_div

# Status codes, their labels, and which ones a retry may cure.
NETWORK_ERROR = 10001
ERROR_LABELS = {10001: "网络波动", 10002: "数据解析失败", -1000: "临时文件错误", -1001: "文件IO异常"}
UNKNOWN_LABEL = "未知错误"
RETRYABLE_CODES = (10001, 10002, 10003, -1000, -1001)
FAILURE_LINE = r"^\[([^\]]+)\] Type: (.*?) *\| FileID: (.*?) *\| Error: (.*)$"


def error_label(code: Column) -> Column:
    expr = F
    for value, label in ERROR_LABELS.items():
        expr = expr.when(code == value, label)
    return expr.otherwise(F.concat(F.lit(UNKNOWN_LABEL + "("), code.cast("string"), F.lit(")")))


def classify(log: DataFrame, code: str = "ret_code") -> DataFrame:
    """Add the error label and whether the error is retryable."""
    return log.withColumn("error_class", error_label(F.col(code))).withColumn("retryable", F.col(code).isin(*RETRYABLE_CODES))


def failure_stats(log: DataFrame, category: str = "error_class") -> DataFrame:
    """Failures and distinct files per category."""
    return log.groupBy(category).agg(
        F.count(F.lit(1)).alias("failures"), F.count_distinct("sdkfileid").alias("files")
    )


def failure_ids(log: DataFrame, category: str = "error_class") -> DataFrame:
    """The failed files of each category as rows, so no category is gathered in one place."""
    return log.groupBy(category, "sdkfileid").agg(F.count(F.lit(1)).alias("failures"))


def error_codes(log: DataFrame, exclude: Sequence[int] = (NETWORK_ERROR,)) -> DataFrame:
    """Occurrences per status code, plain network errors left out by default."""
    kept = log.where(~F.col("ret_code").isin(*exclude)) if exclude else log
    return kept.groupBy("ret_code").agg(F.count(F.lit(1)).alias("occurrences"))


def run_totals(log: DataFrame, failed_records: DataFrame | None = None) -> DataFrame:
    """One row: files in total, succeeded, failed, expired, and success and failure percentages.

    With ``failed_records``, the log of records that could not be processed, also their number, ``failed_records``. It is a
    counter of its own: a record may fail before it names a file, and a file may fail in several records.
    """
    status = F.col("status")
    totals = log.agg(
        F.count(F.lit(1)).alias("total_files"),
        F.count_if(status == "success").alias("success_files"),
        F.count_if(status == "failed").alias("failed_files"),
        F.count_if(status == "expired").alias("expired_files"),
    )
    percent = lambda c: F.round(safe_div(F.col(c) * 100, F.col("total_files")), 2)
    totals = totals.withColumn("success_pct", percent("success_files")).withColumn("failed_pct", percent("failed_files"))
    if failed_records is None:
        return totals
    return totals.withColumn("failed_records", failed_records.agg(F.count(F.lit(1)).alias("n")).select("n").scalar())


def parse_failures(lines: DataFrame, column: str = "line") -> DataFrame:
    """Columns of failure-log text lines; lines of another shape are skipped."""
    part = lambda i: F.regexp_extract(column, FAILURE_LINE, i)
    return lines.where(F.col(column).rlike(FAILURE_LINE)).select(
        F.try_to_timestamp(part(1)).cast("timestamp_ntz").alias("logged_at"),
        part(2).alias("msgtype"),
        part(3).alias("file_id"),
        part(4).alias("error"),
    )


def run_metrics(runs: DataFrame) -> DataFrame:
    """Runs, rows and durations per task and status."""
    return runs.groupBy("task_name", "status").agg(
        F.count(F.lit(1)).alias("runs"),
        F.sum("data_size").alias("rows_loaded"),
        F.sum("duration_ms").alias("total_ms"),
        F.max("duration_ms").alias("max_ms"),
    )
