"""Incremental ingest as a stream: each id is stored once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlark.operators.ingest import absent
from ledgerlark.sources import stored


def ingest(spark: SparkSession, source: str, schema: str, key: str, store: str, checkpoint: str) -> None:
    """Append the rows of new Parquet files in source whose key the store has not yet; runs until all files are read.

    The anti-join with the store makes a repeated batch harmless, so a restart after a lost driver or
    executor stores nothing twice.
    """

    def put(batch: DataFrame, _: int) -> None:
        absent(batch, stored(spark, schema, store), [key]).write.mode("append").parquet(store)

    stream = spark.readStream.schema(schema).parquet(source)
    stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
