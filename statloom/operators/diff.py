"""What changed between two versions of a dataset: one full outer join on the key of observations, or on nodes' ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from statloom.operators.construct import first_of, gathered, is_observation

KEYS = ["variableMeasured", "observationAbout", "observationDate", "observationPeriod", "measurementMethod", "unit", "scalingFactor"]


def _quoted(c: Column) -> Column:
    return F.when(c.contains(","), F.concat(F.lit('"'), c, F.lit('"'))).otherwise(c)


def observation_pairs(pv: DataFrame) -> DataFrame:
    """key (the seven properties between semicolons), value of every observation."""
    return gathered(pv).where(is_observation()).select(F.concat_ws(";", *[_quoted(first_of(p)) for p in KEYS]).alias("key"), _quoted(first_of("value")).alias("value"))


def schema_pairs(pv: DataFrame) -> DataFrame:
    """key (the node's id), value (sorted ``property:value`` between semicolons) of every other node."""
    firsts = F.filter("pvs", lambda x: (x["pos"] == 0) & ~x["prop"].isin("dcid", "Node"))
    text = F.array_join(F.transform(firsts, lambda x: F.concat(x["prop"], F.lit(":"), _quoted(x["value"]))), ";")
    return gathered(pv).where(~is_observation()).select(F.col("node_id").alias("key"), text.alias("value"))


def changes(current: DataFrame, previous: DataFrame) -> DataFrame:
    """key, current, previous, diff_type (ADDED, DELETED or MODIFIED) of (key, value) rows; an empty value counts as
    absent and unchanged keys are left out. A key with several rows in a version fails."""
    def one(df: DataFrame, name: str) -> DataFrame:
        single = F.when(F.count("*") == 1, F.first("value")).otherwise(F.raise_error(F.concat(F.lit("several values of a key: "), F.first("key"))).cast("string"))
        return df.groupBy("key").agg(single.alias(name))

    both = one(current, "current").join(one(previous, "previous"), "key", "full").withColumns({c: F.coalesce(c, F.lit("")) for c in ("current", "previous")})
    kind = F.when(F.col("current") == "", "DELETED").when(F.col("previous") == "", "ADDED").otherwise("MODIFIED")
    return both.where("current <> previous").select("key", "current", "previous", kind.alias("diff_type"))


def write_changes(found: DataFrame, path: str) -> None:
    """One file with a header; rows are joined as they are, since values that need quotes have them."""
    head = found.sparkSession.createDataFrame([(0, "key_combined,value_combined_current,value_combined_previous,diff_type")], "part int, value string")
    lines = found.select(F.lit(1).alias("part"), F.concat_ws(",", "key", "current", "previous", "diff_type").alias("value"))
    head.unionByName(lines).coalesce(1).sortWithinPartitions("part").select("value").write.mode("overwrite").text(path)
