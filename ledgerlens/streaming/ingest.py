"""Append-only streaming tables over raw table folders."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ledgerlens import schemas
from ledgerlens.sources.layout import Layout


def open_stream(spark: SparkSession, layout: Layout, table: str, files_per_trigger: int | None = None) -> DataFrame:
    """A raw table as a stream with its declared schema; ``files_per_trigger`` bounds a micro-batch."""
    return follow(spark, layout.path("bronze", table), schemas.BRONZE[table], files_per_trigger, layout.format)


def follow(spark: SparkSession, path: str, schema: str | StructType, files_per_trigger: int | None = None,
           source_format: str = "parquet") -> DataFrame:
    """A landed streaming table as the source of the next stream."""
    reader = spark.readStream.format(source_format).schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def land(stream: DataFrame, path: str, checkpoint: str, name: str | None = None,
         output_format: str = "parquet") -> StreamingQuery:
    """Append everything that is available to a table, exactly once per source file, then stop.

    The checkpoint remembers what was taken: a restart after a lost driver or executor goes on there.
    """
    writer = stream.writeStream.format(output_format).outputMode("append").option(
        "checkpointLocation", checkpoint).trigger(availableNow=True)
    if name:
        writer = writer.queryName(name)
    return writer.start(path)


def finish(queries: Iterable[StreamingQuery]) -> None:
    for q in queries:
        q.awaitTermination()


def ingest(spark: SparkSession, source: Layout, target: Layout, checkpoints: str,
           tables: Iterable[str] = schemas.TABLES, files_per_trigger: int | None = None) -> dict[str, str]:
    """Take in the raw tables side by side as ``bronze_<table>``; returns their paths."""
    paths = {t: target.path("bronze", f"bronze_{t}") for t in tables}
    finish([
        land(open_stream(spark, source, t, files_per_trigger), path, f"{checkpoints}/bronze_{t}",
             output_format=target.format)
        for t, path in paths.items()
    ])
    return paths
