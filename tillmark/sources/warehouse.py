"""Warehouse tables: lake-backed by default, JDBC where a driver is on the classpath."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, root: str, name: str, columns: Sequence[str] = (), where: Column | None = None) -> DataFrame:
    """A warehouse table for serving; projection and filter reach the Parquet scan."""
    df = spark.read.parquet(f"{root}/{name}")
    if where is not None:
        df = df.filter(where)
    return df.select(*columns) if columns else df


def jdbc_table(
    spark: SparkSession,
    url: str,
    name: str,
    *,
    split_on: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 4,
    **options: str,
) -> DataFrame:
    """A database table; give `split_on` and `bounds` to read it with several tasks."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", name).options(**options)
    if split_on and bounds:
        reader = (reader.option("partitionColumn", split_on).option("lowerBound", bounds[0])
                  .option("upperBound", bounds[1]).option("numPartitions", partitions))
    return reader.load()


def product_lookup(products: DataFrame) -> DataFrame:
    """The columns of the product dimension that events are enriched with."""
    return products.select("product_id", F.col("category").alias("dim_category"), F.col("unit_price").alias("list_price"))
