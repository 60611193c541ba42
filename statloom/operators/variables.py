"""Sums of variables and arithmetic between two of them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from statloom.functions import facets
from statloom.operators.places import COLUMNS
from statloom.plans.storage import saved, tasks
from statloom.schema import FACETS


@dataclass
class VariableSum:
    ancestor: str
    sources: list[str]
    imports: list[str]
    output_import: str | None = None
    lenient: bool = False
    base: bool = True


def sum_variables(points: DataFrame, config: VariableSum) -> DataFrame:
    """The ancestor variable wherever all sources (or, leniently, any) have a value of the same facet and date. A source
    is a bit of a number, so that one aggregation gives sums and sources, in parts whose number is stated."""
    provenance = facets.provenance_name(config.output_import or f"{config.imports[0]}_StatVarAgg", config.base)
    wanted = [facets.provenance_name(i, config.base) for i in config.imports]
    mine = points.where(F.col("provenance").isin(wanted) & F.col("variable").isin(config.sources) & F.col("value").isNotNull())
    names = sorted(set(config.sources))
    words = {} if config.lenient else {f"seen{a}": names[a : a + 62] for a in range(0, len(names), 62)}
    seen = [F.bit_or(F.create_map(*[x for i, v in enumerate(some) for x in (F.lit(v), F.lit(1 << i).cast("bigint"))])[F.col("variable")]).alias(word) for word, some in words.items()]
    mine = facets.aggregated(mine, provenance).repartition(tasks(points.sparkSession), "entity", "date")
    out = mine.groupBy("entity", "extra", "date", *FACETS).agg(F.sum("value").alias("value"), *seen)
    for word, some in words.items():
        out = out.where(F.col(word) == (1 << len(some)) - 1)
    return out.withColumn("variable", F.lit(config.ancestor)).select(COLUMNS)


@dataclass
class Input:
    variable: str | None = None
    method: str | None = None
    provenance: str | None = None
    unit: str | None = None
    period: str | None = None
    scaling: str | None = None


@dataclass
class Calculation:
    left: Input
    right: Input
    operation: str
    multiplier: float = 1.0
    variable: str | None = None
    variable_prefix: str | None = None
    method: str | None = None
    method_prefix: str | None = None
    unit: str | None = None
    period: str | None = None
    scaling: str | None = None


_META = set(r".^$*+?{}[]\|()")


def matches(column: str, pattern: str | None) -> Column | None:
    """Equality for a plain pattern, which can be pushed to the scan; otherwise ^pattern$ as it is."""
    if pattern is None:
        return None
    c = F.coalesce(F.col(column), F.lit(""))
    return c.rlike(f"^{pattern}$") if set(pattern) & _META else F.col(column) == pattern


def selected(points: DataFrame, wanted: Input) -> DataFrame:
    for condition in (matches("variable", wanted.variable), matches("method", wanted.method), matches("provenance", wanted.provenance)):
        points = points if condition is None else points.where(condition)
    for name in ("unit", "period", "scaling"):
        if (value := getattr(wanted, name)) is not None:
            points = points.where(F.col(name) == value)
    return points


def calculate(points: DataFrame, config: Calculation, output_import: str, base: bool = True, imports: list[str] | None = None) -> DataFrame:
    """One equi-join on entity, extra entities and date. The multiplier counts for DIVIDE and MULTIPLY only."""
    points = facets.in_imports(points, imports, base)
    a = selected(points, config.left).where("value is not null").select("entity", "extra", "date", F.col("variable").alias("v1"), F.col("method").alias("m1"), F.col("value").alias("a"))
    b = selected(points, config.right).where("value is not null").select("entity", "extra", "date", F.col("method").alias("m2"), F.col("value").alias("b"))
    x, y, k = F.col("a"), F.col("b"), F.lit(float(config.multiplier))
    value = {"DIVIDE": F.try_divide(x, y) * k, "MULTIPLY": x * y * k, "ADD": x + y, "SUBTRACT": x - y}[config.operation]
    method1 = F.regexp_replace(F.coalesce("m1", F.lit("")), "^dcAggregate/NASA_Mean_CMIP6_", "")
    mean = F.when(F.col("v1").startswith("Temperature"), F.lit("Mean_")).otherwise(F.lit(""))
    variable = F.lit(config.variable) if config.variable else F.concat(F.lit(config.variable_prefix or ""), mean, F.col("v1"), F.lit("_"), method1)
    if config.method is not None:
        method = F.lit(config.method)
    elif config.method_prefix is not None:
        method = F.concat(F.lit(config.method_prefix), F.regexp_replace(F.coalesce("m2", F.lit("")), "^dcAggregate/", ""))
    else:
        method = F.lit(None).cast("string")
    fixed = {"period": config.period, "unit": config.unit, "scaling": config.scaling}
    out = a.join(b, ["entity", "extra", "date"]).withColumns({"value": value, "variable": variable, "method": method} | {n: F.lit(v).cast("string") for n, v in fixed.items()})
    return out.where("value is not null").withColumns({"provenance": F.lit(facets.provenance_name(output_import, base)), "is_aggregate": F.lit(True)}).select(COLUMNS)


@dataclass
class Calculations:
    calculations: list[Calculation]
    output_import: str
    base: bool = True
    imports: list[str] | None = None


def calculate_all(points: DataFrame, config: Calculations) -> DataFrame:
    """Every calculation reads the same input, none another's output. What any of them needs is selected once, by the
    distinct conditions of all inputs, and written to the shared folder, so the source is scanned once."""
    points = facets.in_imports(points, config.imports, config.base)
    wanted = None
    for one in {(i.variable, i.method, i.provenance) for c in config.calculations for i in (c.left, c.right)}:
        found = F.lit(True)
        for name, pattern in zip(("variable", "method", "provenance"), one):
            if (condition := matches(name, pattern)) is not None:
                found = found & condition
        wanted = found if wanted is None else wanted | found
    points = saved(points.where(wanted), "inputs")
    parts = [calculate(points, c, config.output_import, config.base) for c in config.calculations]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
