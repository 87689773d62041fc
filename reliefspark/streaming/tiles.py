"""Flight-line statistics of tiles as they arrive in a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import flightlines


def stream(spark: SparkSession, folder: str, schema) -> DataFrame:
    """New Parquet files of points below `folder`, as an unbounded table."""
    return spark.readStream.schema(schema).parquet(folder)


def running_stats(points: DataFrame) -> DataFrame:
    """source_stats over everything so far (complete mode); state is a row a source, not a point."""
    return flightlines.source_stats(points)
