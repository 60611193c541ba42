"""Tables of the engine.

Points are observations with their series' metadata beside them. The metadata is a handful of low-cardinality strings,
which Parquet stores as dictionary codes, so keeping them on each row costs little and saves the largest join there
would be (observations with series); ``split`` and ``join`` convert to and from the normalised tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

NODE = "subject_id string, value string, bytes binary, name string, types array<string>, last_update_timestamp timestamp"
EDGE = "subject_id string, predicate string, object_id string, provenance string"
FACET = "struct<measurementMethod:string,observationPeriod:string,unit:string,scalingFactor:string,provenance:string,isDcAggregate:boolean>"
TIME_SERIES = f"variable_measured string, entity1 string, extra_entities_id string, facet_id string, facet {FACET}"
OBSERVATION = "variable_measured string, entity1 string, extra_entities_id string, facet_id string, date string, value string"
KEY_VALUE = "type string, key string, provenance string, value string"
TRIPLE = "subject_id string, predicate string, object_id string, object_value string"
MCF_PV = "node_id string, prop string, pos int, type string, value string"

SERIES = ["variable", "entity", "extra"]
FACETS = ["method", "period", "unit", "scaling", "provenance", "is_aggregate"]
POINTS = "variable string, entity string, extra string, date string, value double, method string, period string, unit string, scaling string, provenance string, is_aggregate boolean"


def point_schema() -> T.StructType:
    return T.StructType.fromDDL(POINTS)


def facet_struct():
    return F.struct(
        F.col("method").alias("measurementMethod"),
        F.col("period").alias("observationPeriod"),
        F.col("unit").alias("unit"),
        F.col("scaling").alias("scalingFactor"),
        F.col("provenance").alias("provenance"),
        F.col("is_aggregate").alias("isDcAggregate"),
    )


def split(points: DataFrame, facet_id) -> tuple[DataFrame, DataFrame]:
    """(time_series, observation) of points; ``facet_id`` maps the facet columns to an id column."""
    from statloom.functions.numbers import format_number

    keyed = facet_id(points).select(F.col("variable").alias("variable_measured"), F.col("entity").alias("entity1"), F.col("extra").alias("extra_entities_id"), "facet_id", facet_struct().alias("facet"), "date", format_number("value").alias("value"))
    series = keyed.select("variable_measured", "entity1", "extra_entities_id", "facet_id", "facet").dropDuplicates(["variable_measured", "entity1", "extra_entities_id", "facet_id"])
    return series, keyed.select("variable_measured", "entity1", "extra_entities_id", "facet_id", "date", "value")


def join(series: DataFrame, observation: DataFrame) -> DataFrame:
    """Points of the normalised tables; values that aren't numbers become null."""
    keys = ["variable_measured", "entity1", "extra_entities_id", "facet_id"]
    f = lambda n: F.col("facet")[n]
    return observation.join(series, keys).select(
        F.col("variable_measured").alias("variable"), F.col("entity1").alias("entity"), F.col("extra_entities_id").alias("extra"), "date", F.expr("try_cast(value as double)").alias("value"),
        f("measurementMethod").alias("method"), f("observationPeriod").alias("period"), f("unit").alias("unit"), f("scalingFactor").alias("scaling"), f("provenance").alias("provenance"), f("isDcAggregate").alias("is_aggregate"),
    )
