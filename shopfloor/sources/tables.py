"""Catalog tables: reading, staging, publishing."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class Tables:
    """Resolves logical table names to catalog tables or Parquet folders.

    ``Tables(spark, schema="crm.stage")`` reads ``crm.stage.<name>``;
    ``Tables(spark, folder="/data")`` reads ``/data/<name>.parquet``.
    """

    def __init__(self, spark: SparkSession, schema: str | None = None, folder: str | None = None):
        self.spark = spark
        self.schema = schema
        self.folder = folder

    def name(self, table: str) -> str:
        return f"{self.schema}.{table}" if self.schema else table

    def read(self, table: str, columns: Sequence[str] | None = None) -> DataFrame:
        if self.folder:
            df = self.spark.read.parquet(f"{self.folder.rstrip('/')}/{table}.parquet")
        else:
            df = self.spark.table(self.name(table))
        return df.select(*columns) if columns else df

    def materialize(
        self, df: DataFrame, table: str, dist: str | None = None, sort: Sequence[str] = (), buckets: int | None = None
    ) -> DataFrame:
        """Create or replace a stored table and return it.

        ``dist`` co-locates rows of a key. With ``buckets`` the layout is recorded in the
        catalog, so later joins and groupings on ``dist`` need no shuffle.
        """
        if dist and buckets:
            # One task per bucket range: few files, and each bucket is complete in one file.
            df = df.repartition(buckets, dist)
            writer = df.write.bucketBy(buckets, dist)
            if sort:
                writer = writer.sortBy(*sort)
        else:
            if dist:
                df = df.repartition(F.col(dist))
            if sort:
                df = df.sortWithinPartitions(*sort)
            writer = df.write
        writer.mode("overwrite").format("parquet").saveAsTable(self.name(table))
        return self.spark.table(self.name(table))

    def clone_schema(self, source: str, target: str) -> None:
        """An empty table with the columns of another."""
        self.spark.table(self.name(source)).limit(0).write.mode("overwrite").format("parquet").saveAsTable(self.name(target))

    def publish(self, df: DataFrame, table: str, check: Callable[[DataFrame], bool] | None = None) -> DataFrame:
        """Replace what readers of ``table`` see by the frame's rows, in one step and only when all of them are stored.

        The rows go to a stored table of their own; ``table`` is a view that is then switched to it. Until the switch,
        and for good if writing or ``check`` (of the stored rows) fails, readers have the old rows. The version before
        stays for readers that began with it, older ones go.
        """
        target = self.name(table)
        version = f"{target}__{uuid.uuid4().hex}"
        written = Observation()
        try:
            df.observe(written, F.count(F.lit(1)).alias("n")).write.format("parquet").saveAsTable(version)
            stored = self.spark.table(version)
            if stored.count() != written.get["n"] or not (check is None or check(stored)):
                raise ValueError(f"{target}: the rows stored for publication fail the check")
        except Exception:
            self.spark.sql(f"DROP TABLE IF EXISTS {version}")
            raise
        versions = self._versions(target)
        if self.spark.catalog.tableExists(target) and not versions:
            raise ValueError(f"{target} is a table of its own, not a publication; drop it first")
        kept = [version, *versions[:1]]
        self.spark.sql(f"CREATE OR REPLACE VIEW {target} TBLPROPERTIES ('versions' = '{','.join(kept)}') AS SELECT * FROM {version}")
        for old in versions[1:]:
            self.spark.sql(f"DROP TABLE IF EXISTS {old}")
        return self.spark.table(target)

    def _versions(self, target: str) -> list[str]:
        """The stored tables behind a publication, newest first; none for anything else."""
        if not self.spark.catalog.tableExists(target):
            return []
        found = self.spark.sql(f"SHOW TBLPROPERTIES {target}").where("key = 'versions'").collect()
        return found[0]["value"].split(",") if found else []

    def drop(self, *tables: str) -> None:
        for t in tables:
            target = self.name(t)
            versions = self._versions(target)
            if versions:
                self.spark.sql(f"DROP VIEW {target}")
            for stored in versions or [target]:
                self.spark.sql(f"DROP TABLE IF EXISTS {stored}")
