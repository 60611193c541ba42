"""New files merged into a table as they come: an extension, since the graph's own sources are all bounded."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from statloom.plans.sinks import upsert


def ingest(spark: SparkSession, source: str, schema: str, target: str, table: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] | None = None, files: int = 1000) -> StreamingQuery:
    """Reads Parquet files that appear in ``source`` and upserts their rows by the table's key. A batch that is done
    again after a failure gives the same table."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(source)

    def merge(batch: DataFrame, _: int) -> None:
        upsert(transform(batch) if transform else batch, target, table)

    return rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(merge).trigger(availableNow=True).start()
