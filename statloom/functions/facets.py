"""Provenance names and facet rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

AGGREGATE = "dcAggregate/"
#: Method of an aggregate of points without a method; a deployment sets the name that its graph uses.
PLAIN_AGGREGATE = "PlainAggregate"
COUNTABLE = ("amount", "area", "coverageArea", "generation", "reserves", "retailDrugDistribution")
CLIMATE = ("lifetimeContractionProbability", "heavyPrecipitationIndex", "consecutiveDryDays")
SPREADS = ("precipitation", "maxTemperature", "minTemperature")


def provenance_name(import_name: str, base: bool = True) -> str:
    """``dc/base/<import>`` for the base graph, the import's name otherwise."""
    return import_name if not base or import_name.startswith("dc/base/") else f"dc/base/{import_name}"


def generated_provenance(import_name: str, base: bool = True) -> str:
    """``generated/<import>``; applying it again changes nothing."""
    name = import_name.removeprefix("dc/base/")
    return provenance_name(name if name.startswith("generated/") else f"generated/{name}", base)


def aggregate_method(method, plain: str | None = None) -> Column:
    plain = PLAIN_AGGREGATE if plain is None else plain
    m = F.col(method) if isinstance(method, str) else method
    return F.when(m.isNull() | (m == "") | (m == plain), F.lit(plain)).when(m.startswith(AGGREGATE), m).otherwise(F.concat(F.lit(AGGREGATE), m))


def in_imports(points: DataFrame, imports: list[str] | None, base: bool = True) -> DataFrame:
    """Rows of some imports, or of all where these aren't named."""
    return points if imports is None else points.where(F.col("provenance").isin([provenance_name(i, base) for i in imports]))


def aggregated(points: DataFrame, provenance: str) -> DataFrame:
    """Facet columns of a derived series."""
    return points.withColumns({"method": aggregate_method("method"), "provenance": F.lit(provenance), "is_aggregate": F.lit(True)})


def is_countable(prop) -> Column:
    p = F.col(prop) if isinstance(prop, str) else prop
    return F.coalesce(p.isin(*COUNTABLE) | p.endswith("Count") | (p == "count"), F.lit(False))


def place_strategy(stat_type, prop) -> Column:
    """SUM, MIN, MAX, MEAN or NONE for rolling a variable up over places."""
    s, p = F.col(stat_type), F.col(prop)
    kept = F.when(s == "measuredValue", "SUM").when(s == "minValue", "MIN").when(s == "maxValue", "MAX").otherwise("NONE")
    mean = ((s == "meanValue") & (p == "concentration")) | ((s == "measuredValue") & p.isin(*CLIMATE))
    return F.when(is_countable(p), kept).when(F.coalesce(mean, F.lit(False)), "MEAN").otherwise("NONE")


def enum_strategy(stat_type, prop) -> Column:
    """The wider rule for rolling a variable up over values of an enumeration."""
    s, p = F.col(stat_type), F.col(prop)
    countable = F.coalesce(F.lower(p).endswith("count") | p.isin(*COUNTABLE), F.lit(False))
    kept = F.when(s == "measuredValue", "SUM").when(s == "minValue", "MIN").when(s == "maxValue", "MAX").otherwise("NONE")
    mean = ((s == "meanValue") & (p == "concentration")) | ((s == "measuredValue") & p.isin(*CLIMATE)) | (s.isin("kurtosis", "skewness", "stdDeviation") & p.isin(*SPREADS))
    return F.when(countable, kept).when(F.coalesce(mean, F.lit(False)), "MEAN").otherwise("NONE")


def picked(strategy, value) -> Column:
    """The aggregate that the group's strategy names."""
    s, v = F.first(strategy), F.col(value)
    return F.when(s == "SUM", F.sum(v)).when(s == "MIN", F.min(v)).when(s == "MAX", F.max(v)).when(s == "MEAN", F.avg(v))
