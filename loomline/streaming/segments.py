"""Row-level stages on streams: the same operators, applied to arriving segments."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from loomline.functions.text import contamination, strip
from loomline.operators.cleaning import normalize_rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEGMENTS = T.StructType([T.StructField(c, T.StringType()) for c in ("segment_id", "zh-CN", "ko")])


def read_segments(spark: SparkSession, folder: str) -> DataFrame:
    """Segments from the Parquet files that arrive in a folder."""
    rows = spark.readStream.schema(SEGMENTS).parquet(folder)
    return rows.select("segment_id", strip(F.col("`zh-CN`")).alias("src"), strip(F.col("ko")).alias("tgt"))


def cleaned(stream: DataFrame) -> DataFrame:
    """Normalised segments with their contamination: stateless, so late rows need no rule."""
    return normalize_rows(stream).withColumn("contamination", contamination(F.col("tgt")))


def each_batch(stream: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Runs ``work`` on every micro-batch, for stages that aggregate; a batch that
    comes again after a failure has the same number."""
    return stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
