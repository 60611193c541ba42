"""Session helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def make_importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver found it, and get texts in small batches."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH", "")]))


def id_type(docs: DataFrame, name: str = "doc_id") -> str:
    """The type of an id, which operators keep."""
    return docs.schema[name].dataType.simpleString()


def fresh(docs: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``docs`` doesn't have."""
    have = {c.lower() for c in docs.columns}
    out = []
    for name in names:
        while name.lower() in have:
            name += "_"
        out.append(name)
    return out


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors share: ``spark.checkpoint.dir``. Where that is unset, a local session (tests) gets an
    own folder, and a cluster an error, since its executors share no temporary folder."""
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="statloom-shared-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def new_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/statloom/{tag}-{uuid.uuid4().hex}"


def saved(df: DataFrame, tag: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, tag)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table written by ``saved`` that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def drop_saved(df: DataFrame) -> None:
    for f in {os.path.dirname(x) for x in df.inputFiles()}:
        remove(df.sparkSession, f)
