"""The folder that executors share, for results that are needed more than once."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; where it is unset, a local session (tests) gets an own folder and a
    cluster, whose executors share no temporary folder, an error."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="statloom-graph-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def saved(df: DataFrame, tag: str) -> DataFrame:
    """Write and read again: cuts the lineage, and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/graph/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def tasks(spark: SparkSession) -> int:
    """A number of parts to state for an exchange of rows that are small on the way and large in memory; AQE would join
    such parts by their size on the way."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
