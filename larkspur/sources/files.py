"""Table files: headered CSV and parquet, in and out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def scan_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A headered CSV with declared types; no inference pass."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def scan_parquet(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def sink_dataset(df: DataFrame, path: str, fmt: str = "parquet", partition_by: tuple[str, ...] = ()) -> None:
    """Replace the dataset at ``path``. CSV files carry a header."""
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
