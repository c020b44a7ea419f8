"""Layered storage: ``root/<layer>/<table>`` folders in one columnar format."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

LAYERS = ("bronze", "silver", "gold")


@dataclass(frozen=True)
class Layout:
    """Where the tables live and in which format (``parquet``; any format the session knows)."""

    root: str
    format: str = "parquet"

    def path(self, layer: str, table: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}, expected one of {LAYERS}")
        return f"{self.root.rstrip('/')}/{layer}/{table}"

    @property
    def _packed(self) -> dict[str, str]:
        """Parquet files are read once or twice a run, so they may take longer to pack than Spark's default."""
        return {"compression": "zstd"} if self.format == "parquet" else {}

    def read(self, spark: SparkSession, layer: str, table: str, schema: str | None = None) -> DataFrame:
        reader = spark.read.format(self.format)
        if schema:
            reader = reader.schema(schema)
        return reader.load(self.path(layer, table))

    def write(self, df: DataFrame, layer: str, table: str, partition_by: str | None = None) -> int:
        """Full refresh of one table; returns its row count, taken while writing (no second job).

        A date-partitioned table is rebalanced on the date first: few well-sized files per date,
        and AQE splits a date that holds far more rows than the others.
        """
        counted = Observation(f"{layer}.{table}")
        out = df
        if partition_by:
            out = out.hint("rebalance", F.col(partition_by))
        out = out.observe(counted, F.count(F.lit(1)).alias("rows"))
        writer = out.write.format(self.format).options(**self._packed).mode("overwrite").option(
            "partitionOverwriteMode", "static")
        if partition_by:
            writer = writer.partitionBy(partition_by)
        writer.save(self.path(layer, table))
        return counted.get["rows"]

    def refresh_dates(self, df: DataFrame, layer: str, table: str, partition_by: str = "txn_date") -> int:
        """Replace only the dates that occur in ``df``; all other dates stay as they are."""
        counted = Observation(f"{layer}.{table}.dates")
        (df.hint("rebalance", F.col(partition_by))
           .observe(counted, F.count(F.lit(1)).alias("rows"))
           .write.format(self.format).options(**self._packed).mode("overwrite")
           .option("partitionOverwriteMode", "dynamic")
           .partitionBy(partition_by).save(self.path(layer, table)))
        return counted.get["rows"]

    def register(self, spark: SparkSession, tables: Iterable[tuple[str, str]], prefix: str = "") -> None:
        """Catalog tables over the written folders, named ``<prefix><layer>.<table>``, for sessions that ask in SQL.
        Registering again takes in new dates."""
        for layer, table in tables:
            name = f"`{prefix}{layer}`.`{table}`"
            spark.sql(f"CREATE DATABASE IF NOT EXISTS `{prefix}{layer}`")
            spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING {self.format} LOCATION '{self.path(layer, table)}'")
            if spark.sql(f"DESCRIBE TABLE {name}").where("col_name = '# Partition Information'").count():
                spark.sql(f"MSCK REPAIR TABLE {name}")
            spark.catalog.refreshTable(name)
