"""Normalisation of JSON lines as they arrive in a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.normalize import normalize


def arriving(spark: SparkSession, folder: str, schema: T.StructType | str, files_at_once: int = 100) -> DataFrame:
    """New JSON-lines files of a folder as a stream; broken lines come as rows of nulls."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).json(folder)


def normalize_stream(raw: DataFrame, dataset: str, url: str, license_: str, retrieved_at: str) -> DataFrame:
    """The same projection as in batch. It keeps no state, so it needs no watermark."""
    return normalize(raw, F.lit(dataset), F.lit(url), F.lit(license_), F.lit(retrieved_at))


def append_to(stream: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Appends to parquet, good and rejected records in folders of their own, once for all files there are."""
    rejected = stream.withColumn("rejected", F.col("error").isNotNull())
    return rejected.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).partitionBy("rejected").format("parquet").start(folder)
