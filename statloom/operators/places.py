"""Roll-ups of series along containment edges."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from statloom.functions import facets
from statloom.schema import FACETS, POINTS

COLUMNS = [c.strip().split()[0] for c in POINTS.split(",")]
EXCLUDED_METHOD = "CensusACS5yrSurveySubjectTable"


@dataclass
class PlaceAggregation:
    imports: list[str]
    source_type: str
    destination_type: str
    output_import: str
    several_parents: bool = False
    base: bool = True
    strategy: dict[str, str] = field(default_factory=dict)


def variable_strategy(edges: DataFrame) -> DataFrame:
    """variable, known: how a variable with metadata is rolled up (one row a variable)."""
    last = lambda p: F.max(F.when(F.col("predicate") == p, F.col("object_id")))
    meta = edges.where(F.col("predicate").isin("measuredProperty", "statType", "measurementDenominator")).groupBy(F.col("subject_id").alias("variable")).agg(last("measuredProperty").alias("prop"), F.coalesce(last("statType"), F.lit("measuredValue")).alias("stat_type"), last("measurementDenominator").alias("denominator"))
    return meta.select("variable", F.when(F.col("denominator").isNotNull(), "NONE").otherwise(facets.place_strategy("stat_type", "prop")).alias("known"))


def parents(edges: DataFrame, source_type: str, destination_type: str, several: bool) -> DataFrame:
    """entity, parent. Duplicate facts of several imports count once. Types and containment come from one aggregation
    by subject, whose exchange both sides of the join share."""
    kind = F.col("predicate") == "typeOf"
    facts = edges.where(F.col("predicate").isin("typeOf", "containedInPlace")).groupBy("subject_id").agg(
        F.max(kind & (F.col("object_id") == source_type)).alias("is_source"), F.max(kind & (F.col("object_id") == destination_type)).alias("is_destination"), F.collect_set(F.when(~kind, F.col("object_id"))).alias("up")
    )
    inside = facts.where("is_source").select(F.col("subject_id").alias("entity"), F.explode("up").alias("parent"))
    inside = inside.join(facts.where("is_destination").select(F.col("subject_id").alias("parent")), "parent", "left_semi").select("entity", "parent")
    return inside if several else inside.groupBy("entity").agg(F.min("parent").alias("parent"))


def aggregate_places(points: DataFrame, edges: DataFrame, config: PlaceAggregation) -> DataFrame:
    """Points about the destination places. Partial aggregation runs before the only exchange of points."""
    wanted = [facets.provenance_name(i, config.base) for i in config.imports]
    mine = points.where(F.col("provenance").isin(wanted) & (F.coalesce("method", F.lit("")) != EXCLUDED_METHOD) & F.col("value").isNotNull())
    known = points.sparkSession.createDataFrame(list(config.strategy.items()), "variable string, known string") if config.strategy else variable_strategy(edges)
    up = parents(edges, config.source_type, config.destination_type, config.several_parents)
    how = F.coalesce("known", F.lit("NONE" if config.strategy else "SUM"))
    joined = mine.join(up, "entity").join(known, "variable", "left").withColumn("strategy", how).where("strategy <> 'NONE'")
    joined = facets.aggregated(joined, facets.provenance_name(config.output_import, config.base))
    out = joined.groupBy("variable", F.col("parent").alias("entity"), "extra", "date", *FACETS).agg(facets.picked("strategy", "value").alias("value"))
    return out.where("value is not null").select(COLUMNS)
