"""Data flow around training: exact splits, parameter grids, rankings, logs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomline.operators.review import with_ordinal


def split_counts(n: int, validation: float, test: float) -> tuple[int, int]:
    """Rows of the validation and the test split: at least one each of three or more, and training is never empty."""
    sizes = [max(1, int(n * r)) if n >= 3 else int(n * r) for r in (validation, test)]
    while sum(sizes) >= n and sum(sizes) > 0:
        sizes[sizes.index(max(sizes))] -= 1
    return sizes[0], sizes[1]


def exact_split(df: DataFrame, key: str, train: float = 0.8, validation: float = 0.1, test: float = 0.1, seed: int = 42) -> DataFrame:
    """Adds ``split`` with exact counts, in the order of a seeded hash of a unique key.

    The same rows and seed give the same split, however the rows are spread.
    """
    if any(not 0 < r < 1 for r in (train, validation, test)) or abs(train + validation + test - 1) > 1e-9:
        raise ValueError("ratios must lie between 0 and 1 and add up to 1")
    placed = with_ordinal(df.withColumn("__place", F.concat(F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string"))), F.lit("|"), F.col(key).cast("string"))), "__place", "__ord")
    first, second = split_counts(placed.count(), validation, test)
    name = F.when(F.col("__ord") < first, "validation").when(F.col("__ord") < first + second, "test").otherwise("train")
    return placed.withColumn("split", name).drop("__place", "__ord")


def parameter_grid(spark, grid: Mapping[str, Sequence]) -> DataFrame:
    """All combinations of a few parameters' values, numbered in the order given."""
    from itertools import product

    rows = [(i, *values) for i, values in enumerate(product(*grid.values()))]
    return spark.createDataFrame(rows, ["combo_id", *grid])


def rank_by(df: DataFrame, score: str, order: str) -> DataFrame:
    """Adds ``rank``: best score first, ties in ``order``.  One row for each candidate: few."""
    return df.withColumn("rank", F.row_number().over(Window.orderBy(F.desc(score), order)))


def epoch_log(history: DataFrame, columns: list[str]) -> DataFrame:
    """(epoch, columns): the first value that is not null of each column in each epoch, without the first epoch.

    ``history`` has ``step`` (its order) and ``epoch``.
    """
    firsts = [F.min_by(c, F.when(F.col(c).isNotNull(), F.col("step"))).alias(c) for c in columns]
    grouped = history.where("epoch is not null").groupBy("epoch").agg(*firsts)
    return grouped.join(grouped.agg(F.min("epoch").alias("__first")), F.col("epoch") > F.col("__first")).drop("__first")


def last_logged(history: DataFrame, column: str) -> DataFrame:
    """One row with the last value of a column that is not null."""
    return history.where(F.col(column).isNotNull()).agg(F.max_by(column, "step").alias(column))
