"""File formats: CSV with header, JSON-line envelopes, media manifests, daily exports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shopfloor.sources.schemas import ENVELOPE_JSON, MANIFEST_JSON
from shopfloor.sources.tables import Tables


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header row and doubled quotes; the schema is given, never inferred."""
    return spark.read.csv(path, schema=schema, header=True, quote='"', escape='"', mode="PERMISSIVE")


def load_csv_overwrite(tables: Tables, path: str, schema: str, table: str) -> DataFrame:
    """Replace the whole staged table by the file's rows."""
    return tables.materialize(read_csv(tables.spark, path, schema), table)


def read_csv_lenient(spark: SparkSession, path: str, schema: str, min_fields: int) -> DataFrame:
    """CSV where rows with fewer than ``min_fields`` fields are skipped.

    Longer rows lose their surplus, rows between ``min_fields`` and the full width get NULLs.
    The field count is taken from the raw line, kept beside the parsed columns.
    """
    width = len(StructType.fromDDL(schema).fields)
    extra = ", ".join(f"_f{i} STRING" for i in range(width))
    lines = spark.read.csv(
        path, schema=f"{extra}, _bad STRING", header=True, quote='"', escape='"', mode="PERMISSIVE", columnNameOfCorruptRecord="_bad"
    )
    names = [f.name for f in StructType.fromDDL(schema).fields]
    types = [f.dataType for f in StructType.fromDDL(schema).fields]
    # Only a malformed line (wrong number of fields) has its text in _bad; it is re-split on its own quotes.
    fields = F.when(F.col("_bad").isNotNull(), F.size(F.regexp_extract_all("_bad", F.lit(r'("([^"]|"")*"|[^,]*)(,|$)'), 1)) - _ends_empty("_bad"))
    enough = F.col("_bad").isNull() | (fields >= min_fields)
    return lines.where(enough).select(*(F.col(f"_f{i}").try_cast(t).alias(n) for i, (n, t) in enumerate(zip(names, types))))


def _ends_empty(column: str):
    """The split pattern matches once more at the end of a line unless it ends in a comma."""
    return F.when(F.col(column).endswith(","), 0).otherwise(1)


def read_envelopes(spark: SparkSession, path: str) -> DataFrame:
    """Messages of JSON-line envelopes: (seq, msgid, message); malformed lines are skipped."""
    return parse_envelopes(spark.read.text(path))


def parse_envelopes(lines: DataFrame, column: str = "value") -> DataFrame:
    parsed = lines.select(F.from_json(F.col(column), ENVELOPE_JSON).alias("e"))
    rows = parsed.where(F.col("e.chatdata").isNotNull()).select(F.explode("e.chatdata").alias("d"))
    return rows.select(
        F.coalesce(F.col("d.seq"), F.lit("")).try_cast("bigint").alias("seq"),
        F.coalesce(F.col("d.msgid"), F.lit("")).alias("msgid"),
        F.col("d.message").alias("message"),
    )


def write_manifest(manifest: DataFrame, path: str) -> None:
    """Manifest as JSON lines, one file per partition."""
    manifest.select("msgtype", "sdkfileid", "md5sum", "fileext").write.mode("overwrite").json(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Manifest from JSON lines, or from one JSON array when ``path`` ends in .json.

    The array is cut at its closing braces, so that several tasks read one large file. Its entries are flat objects; text
    between two of them that is no such object ends the job with an error instead of losing entries.
    """
    if not path.endswith(".json"):
        return spark.read.schema(MANIFEST_JSON).json(path)
    pieces = spark.read.option("lineSep", "}").text(path)
    body = F.trim(F.regexp_replace("value", r"^\s*[\[,]?\s*|\s+$", ""))
    entry = F.from_json(F.concat(body, F.lit("}")), MANIFEST_JSON, {"mode": "FAILFAST"})
    parsed = pieces.where(~body.isin("", "]")).select(F.when(body.startswith("{"), entry).otherwise(_refused(body)).alias("e"))
    return parsed.select("e.*")


def _refused(text: Column) -> Column:
    return F.raise_error(F.concat(F.lit("not an array of flat manifest entries: "), F.substring(text, 1, 80)))


def export_daily(df: DataFrame, path: str, day: dt.date) -> None:
    """Compressed CSV in a folder per day; writing a day again replaces that day only."""
    (
        df.withColumn("ds", F.lit(day.strftime("%Y%m%d")))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("header", True)
        .option("compression", "gzip")
        .option("escape", '"')
        .partitionBy("ds")
        .csv(path)
    )
