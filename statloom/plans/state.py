"""State of imports: small tables, changed by writing their next version. There is no lock among writers here: an
outside coordinator gives one; ``may_acquire`` tells whether a lock's row is free or stale."""

from __future__ import annotations

import datetime as dt
import getpass
import platform

from pyspark.sql import DataFrame, SparkSession, functions as F

from statloom.plans.sinks import merged

STATUS = "import_name string, state string, latest_version string, graph_path string, update_time timestamp"
HISTORY = "import_name string, version string, status string, comment string, update_time timestamp"
LOCK = "lock_id string, owner string, acquired timestamp"
SEEDS = [("StatVarGroup", "Class"), ("StatisticalVariable", "Class"), ("Topic", "Class"), ("Provenance", "Class"), ("Source", "Class")]


def may_acquire(lock: DataFrame, lock_id: str, timeout_seconds: int, now: dt.datetime) -> bool:
    """Whether nobody holds the lock, or its owner has held it for longer than the timeout."""
    row = lock.where(F.col("lock_id") == lock_id).select("owner", "acquired").first()
    return row is None or row["owner"] is None or (now - row["acquired"]).total_seconds() > timeout_seconds


def acquired(lock: DataFrame, lock_id: str, owner: str, now: dt.datetime) -> DataFrame:
    return merged(lock, lock.sparkSession.createDataFrame([(lock_id, owner, now)], LOCK), ["lock_id"])


def released(lock: DataFrame, lock_id: str, owner: str) -> DataFrame:
    """The lock without its owner, if that is who asks; otherwise as it was."""
    mine = (F.col("lock_id") == lock_id) & (F.col("owner") == owner)
    return lock.select("lock_id", F.when(mine, None).otherwise(F.col("owner")).alias("owner"), F.when(mine, None).otherwise(F.col("acquired")).alias("acquired"))


def ready_imports(status: DataFrame, names: list[str] | None = None) -> DataFrame:
    """import_name, latest_version, graph_path of imports that wait to be read."""
    out = status.where("state = 'STAGING'")
    if names is not None:
        out = out.where(F.col("import_name").isin(names))
    return out.select("import_name", "latest_version", F.concat_ws("/", F.regexp_replace("latest_version", "/+$", ""), F.regexp_replace("graph_path", "^/+", "")).alias("graph_path"))


def with_status(status: DataFrame, changes: DataFrame) -> DataFrame:
    """Insert or update by import; columns that a change leaves null keep their value."""
    both = changes.alias("c").join(status.alias("s"), F.col("c.import_name") == F.col("s.import_name"), "left")
    filled = both.select(F.col("c.import_name").alias("import_name"), *[F.coalesce(F.col(f"c.{c}"), F.col(f"s.{c}")).alias(c) for c in status.columns if c != "import_name"])
    return merged(status, filled, ["import_name"])


def with_history(history: DataFrame, imports: DataFrame, status: str, comment: str, now: dt.datetime) -> DataFrame:
    """The history and a row for each import (import_name, version)."""
    return history.unionByName(imports.select("import_name", "version", F.lit(status).alias("status"), F.lit(comment).alias("comment"), F.lit(now).cast("timestamp").alias("update_time")))


def latest_version(history: DataFrame, before: str | None = None) -> DataFrame:
    """import_name, version: the newest version that succeeded, other than ``before``."""
    ok = history.where("status = 'SUCCESS'")
    if before is not None:
        ok = ok.where(F.col("version") != before)
    return ok.groupBy("import_name").agg(F.max_by("version", F.struct("update_time", "version")).alias("version"))


def reverted(status: DataFrame, history: DataFrame, import_name: str, now: dt.datetime) -> tuple[DataFrame, DataFrame]:
    """(status, history) with an import set back to the version that succeeded before its present one, waiting to be
    read again, and a row that says so. An import without such a version fails."""
    current = status.where(F.col("import_name") == import_name).select("latest_version").first()
    back = latest_version(history.where(F.col("import_name") == import_name), current["latest_version"] if current else None)
    row = back.first()
    if row is None:
        raise ValueError(f"no earlier version of {import_name}")
    spark = status.sparkSession
    change = spark.createDataFrame([(import_name, "STAGING", row["version"], None, now)], STATUS)
    return with_status(status, change), with_history(history, back, "STAGING", f"reverted from {current['latest_version'] if current else None}", now)


def initialised(spark: SparkSession, tables: dict[str, str], folder: str) -> list[str]:
    """Makes the tables (name -> schema) that aren't there, empty; returns their names."""
    from statloom.plans.sinks import exists

    made = []
    for name, schema in tables.items():
        if not exists(spark, f"{folder}/{name}"):
            spark.createDataFrame([], schema).write.parquet(f"{folder}/{name}")
            made.append(name)
    return made


def seeds(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(s, s, s, [t]) for s, t in SEEDS], "subject_id string, value string, name string, types array<string>")


def ingestion_metrics(counters: DataFrame) -> DataFrame:
    """import_name (null for all), node_count, edge_count, observation_count, timeseries_count of counters (name, value)
    named ``type`` or ``type:import``."""
    kinds = ["node_count", "edge_count", "observation_count", "timeseries_count"]
    c = counters.select(F.regexp_extract("name", "^([^:]+)", 1).alias("kind"), F.when(F.col("name").contains(":"), F.element_at(F.split("name", ":"), -1)).alias("import_name"), "value").where(F.col("kind").isin(kinds))
    sums = [F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("value"))), F.lit(0)).alias(k) for k in kinds]
    return c.agg(*sums).select(F.lit(None).cast("string").alias("import_name"), *kinds).unionByName(c.where("import_name is not null").groupBy("import_name").agg(*sums))


def lookup(observations: DataFrame, place: str, variable: str) -> DataFrame:
    """date, value of a series, for a server: a filter that reaches the scan."""
    return observations.where((F.col("entity") == place) & (F.col("variable") == variable)).select("date", "value").orderBy("date")


def runtime() -> dict[str, str]:
    return {"user": getpass.getuser(), "host": platform.node(), "system": platform.platform(), "python": platform.python_version(), "started": dt.datetime.now(dt.timezone.utc).isoformat()}


def version_files(folder: str, import_name: str, version: str, summary: str, spark: SparkSession) -> None:
    """The import's newest version, and the version's summary, as text."""
    for path, text in ((f"{folder}/{import_name}/latest_version", version), (f"{folder}/{import_name}/{version}/summary", summary)):
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def new_messages(messages: DataFrame, seen: DataFrame) -> DataFrame:
    """Messages of a feed (id, import_name, version, time) that aren't known, each once, the newest of an import."""
    fresh = messages.dropDuplicates(["id"]).join(seen.select("id").distinct(), "id", "left_anti")
    return fresh.groupBy("import_name").agg(F.max_by("version", F.struct("time", "version")).alias("version"), F.max("time").alias("time"))
