"""Reading the Parquet tables of a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomline.session import ship


def table(spark: SparkSession, folder: str, name: str, columns: list[str] | None = None, spread: bool = False) -> DataFrame:
    """The table ``name`` of a folder; with ``columns``, those only (pruned at the scan).

    ``spread`` deals the rows out to all cores where the files give fewer scan
    partitions than there are cores: for work that costs far more than moving
    the rows.  Larger tables are left as they are read.
    """
    ship(spark)
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    df = df.select(*(f"`{c}`" for c in columns)) if columns else df
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if spread and df.rdd.getNumPartitions() < cores else df
