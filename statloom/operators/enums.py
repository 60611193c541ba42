"""Roll-ups of variables along the hierarchy of an enumeration's values."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from statloom.functions import facets
from statloom.functions.ids import generated_id
from statloom.operators.places import COLUMNS
from statloom.schema import FACETS

ROLLED = ["age", "detailedLevelOfSchool", "schoolGradeLevel", "educationalAttainment"]
IGNORED = ["name", "description", "provenance", "isPublic", "url", "memberOf", "label", "alternateName", "utteranceTemplate", "dcid", "keyStr", "differenceBaselineResolution", "scalingFactor", "unit"]


def _key(df: DataFrame, by: list[str]) -> DataFrame:
    pair = F.struct("predicate", F.concat("predicate", F.lit("="), "object_id").alias("pv"))
    return df.groupBy(*by).agg(F.array_join(F.transform(F.array_sort(F.collect_list(pair)), lambda x: x["pv"]), "").alias("key_str"))


def parent_variables(edges: DataFrame, rolled: list[str] = ROLLED, imports: list[str] | None = None) -> DataFrame:
    """source, prop, parent_value, key_str, target, curated, strategy: the variable that stands for the parent value."""
    keyed = facets.in_imports(edges, imports).where(F.col("predicate").isin(rolled)).select("subject_id").distinct()
    props = edges.select("subject_id", "predicate", "object_id").distinct().join(keyed, "subject_id", "left_semi")
    one = lambda p: F.max(F.when(F.col("predicate") == p, F.col("object_id")))
    eligible = props.groupBy("subject_id").agg(one("measuredProperty").alias("mp"), one("statType").alias("st"), one("measurementDenominator").alias("md"))
    eligible = eligible.where("mp is not null and st is not null and md is null").select("subject_id", facets.enum_strategy("st", "mp").alias("strategy")).where("strategy <> 'NONE'")
    up = edges.where("predicate = 'specializationOf'").select(F.col("subject_id").alias("child"), F.col("object_id").alias("parent_value")).distinct()
    moved = props.where(F.col("predicate").isin(rolled)).select("subject_id", F.col("predicate").alias("prop"), F.col("object_id").alias("child")).join(up, "child").select("subject_id", "prop", "parent_value")
    target = props.join(eligible, "subject_id").join(moved, "subject_id").withColumn("object_id", F.when(F.col("predicate") == F.col("prop"), F.col("parent_value")).otherwise(F.col("object_id"))).where(~F.col("predicate").isin(IGNORED))
    keys = _key(target, ["subject_id", "prop", "parent_value", "strategy"])
    curated = edges.where("predicate = 'typeOf' and object_id = 'StatisticalVariable' and subject_id not like 'dc/%'").select("subject_id").distinct()
    curated = _key(edges.select("subject_id", "predicate", "object_id").distinct().where(~F.col("predicate").isin(IGNORED)).join(curated, "subject_id", "left_semi"), ["subject_id"])
    curated = curated.groupBy("key_str").agg(F.min("subject_id").alias("curated_id"))
    out = keys.join(curated, "key_str", "left")
    return out.select(F.col("subject_id").alias("source"), "prop", "parent_value", "key_str", F.coalesce("curated_id", generated_id("key_str")).alias("target"), F.col("curated_id").isNotNull().alias("curated"), "strategy")


def aggregate_enums(points: DataFrame, edges: DataFrame, rolled: list[str] = ROLLED, imports: list[str] | None = None, targets: DataFrame | None = None) -> DataFrame:
    """Points of the parent variables; the provenance gets the suffix _SuperEnum. ``imports`` scopes points and the
    variables whose values are rolled up; ``targets`` is ``parent_variables`` where that is at hand."""
    target = (parent_variables(edges, rolled, imports) if targets is None else targets).select("source", "target", "strategy").distinct()
    joined = facets.in_imports(points, imports).where("value is not null").join(target, points.variable == target.source).withColumns({"method": facets.aggregate_method("method"), "provenance": F.concat("provenance", F.lit("_SuperEnum")), "is_aggregate": F.lit(True)})
    out = joined.groupBy(F.col("target").alias("variable"), "entity", "extra", "date", *FACETS).agg(facets.picked("strategy", "value").alias("value"))
    return out.where("value is not null").select(COLUMNS)
