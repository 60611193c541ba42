"""Counting entities by location, date and properties."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from statloom.functions import facets
from statloom.functions.ids import fingerprint
from statloom.functions.numbers import to_number
from statloom.operators.places import COLUMNS

PERIODS = {"YYYY": (4, "P1Y"), "YYYY-MM": (7, "P1M"), "YYYY-MM-DD": (10, "P1D")}


@dataclass
class Constraint:
    prop: str
    low: float | None = None
    high: float | None = None
    unit: str = ""
    value: str | None = None

    @property
    def wildcard(self) -> bool:
        return self.low is None and self.high is None and self.value is None

    @property
    def text(self) -> str:
        unit = f" {self.unit}" if self.unit else ""
        if self.low is not None and self.high is not None:
            return f"[{self.low} {self.high}{unit}]"
        return f"[{self.low} -{unit}]" if self.low is not None else f"[- {self.high}{unit}]" if self.high is not None else str(self.value)

    def holds(self, column: str):
        number = to_number(column)
        if self.value is not None:
            return F.col(column) == self.value
        ok = F.lit(True) if self.low is None else number >= self.low
        return ok if self.high is None else ok & (number <= self.high)


@dataclass
class EntityCount:
    types: list[str]
    location_props: list[str]
    output_import: str
    date_prop: str | None = None
    formats: list[str] = field(default_factory=lambda: ["YYYY"])
    constraints: list[Constraint] = field(default_factory=list)
    base: bool = True
    imports: list[str] | None = None  #: whose entities count; locations, dates and properties come from all


def slices(constraints: list[Constraint]) -> list[list[Constraint]]:
    """Each condition goes to the first slice that has no condition on its property but wildcards, else to a new one."""
    out: list[list[Constraint]] = []
    for c in constraints:
        for s in out:
            if not any(x.prop == c.prop and not x.wildcard for x in s):
                s.append(c)
                break
        else:
            out.append([c])
    return out or [[]]


def count_entities(edges: DataFrame, config: EntityCount) -> DataFrame:
    """location, type, date, period, constraints (map), value for each slice.

    The properties of an entity come from one aggregation over its edges, so the edges are shuffled once."""
    wanted = [*config.location_props, *([config.date_prop] if config.date_prop else []), *{c.prop: None for c in config.constraints}]
    own = F.lit(True) if config.imports is None else F.col("provenance").isin([facets.provenance_name(i, config.base) for i in config.imports])
    mine = edges.where(F.col("predicate").isin("typeOf", *wanted)).select("subject_id", "predicate", "object_id", own.alias("own")).distinct()
    of = lambda p: F.collect_set(F.when(F.col("predicate") == p, F.col("object_id"))).alias(f"p_{p}")
    rows = mine.groupBy("subject_id").agg(F.collect_set(F.when((F.col("predicate") == "typeOf") & F.col("object_id").isin(config.types) & F.col("own"), F.col("object_id"))).alias("types"), *[of(p) for p in dict.fromkeys(wanted)])
    rows = rows.select("*", F.explode("types").alias("type")).withColumn("location", F.explode(F.array_distinct(F.flatten(F.array(*[F.col(f"p_{p}") for p in config.location_props])))))
    rows = rows.where(~F.col("location").startswith("latLong/"))
    if config.date_prop:
        rows = rows.withColumn("raw_date", F.explode(f"p_{config.date_prop}"))
    else:
        rows = rows.withColumn("raw_date", F.date_format(F.current_date(), "yyyy-MM-dd"))
    bins = F.array(*[F.struct(F.substring("raw_date", 1, PERIODS[f][0]).alias("date"), F.lit(PERIODS[f][1]).alias("period")) for f in config.formats])
    out = None
    for some in slices(config.constraints):
        part = rows
        for prop in dict.fromkeys(c.prop for c in some):
            part = part.withColumn(f"v_{prop}", F.explode(f"p_{prop}"))
        for c in some:
            if not c.wildcard:
                part = part.where(c.holds(f"v_{c.prop}"))
        last = {c.prop: c for c in some}.values()  # a wildcard beside a condition on the same property names the value
        shown = [x for c in last for x in (F.lit(c.prop), F.col(f"v_{c.prop}") if c.wildcard else F.lit(c.text))]
        held = F.create_map(*shown) if shown else F.create_map().cast("map<string,string>")
        wild = [f"v_{c.prop}" for c in last if c.wildcard]
        part = part.withColumn("b", F.explode(bins)).groupBy("location", "type", F.col("b.date").alias("date"), F.col("b.period").alias("period"), *wild).agg(F.count_distinct("subject_id").cast("double").alias("value"))
        part = part.withColumn("constraints", held).select("location", "type", "date", "period", "constraints", "value")
        out = part if out is None else out.unionByName(part)
    return out


def entity_points(edges: DataFrame, config: EntityCount) -> DataFrame:
    """Points of the counts; the variable's id is the fingerprint of its sorted properties."""
    fixed = F.create_map(F.lit("measuredProperty"), F.lit("count"), F.lit("statType"), F.lit("measuredValue"), F.lit("populationType"), F.col("type"))
    entries = F.array_sort(F.transform(F.map_entries(F.map_concat(fixed, "constraints")), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    counted = count_entities(edges, config).withColumn("variable", F.concat(F.lit("dc/sv/gp/"), fingerprint(F.array_join(entries, ",")).cast("string")))
    none = F.lit(None).cast("string")
    return counted.withColumns({"entity": F.col("location"), "extra": F.lit(""), "method": F.lit(facets.PLAIN_AGGREGATE), "unit": none, "scaling": none, "provenance": F.lit(facets.provenance_name(config.output_import, config.base)), "is_aggregate": F.lit(True)}).select(COLUMNS)
