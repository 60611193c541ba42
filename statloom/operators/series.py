"""Statistics over the points of series: across methods, against a base date, over time, above a threshold."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from statloom.functions import facets
from statloom.functions.numbers import extract_month, extract_year
from statloom.operators.places import COLUMNS

MAX_DIFF = "MaxDiffAcrossMeasurementMethods_"
QUANTILES = (("MedianAcrossModels_", 0.5), ("Percentile10AcrossModels_", 0.1), ("Percentile90AcrossModels_", 0.9))


def _done(df: DataFrame, provenance: str) -> DataFrame:
    return df.where("value is not null").withColumns({"provenance": F.lit(provenance), "is_aggregate": F.lit(True)}).select(COLUMNS)


def spread_across_methods(points: DataFrame, provenance: str, imports: list[str] | None = None) -> DataFrame:
    """max - min where at least two methods have a value."""
    points = facets.in_imports(points, imports)
    keys = ["variable", "entity", "extra", "date", "period", "scaling", "unit"]
    out = points.where("value is not null").groupBy(*keys).agg((F.max("value") - F.min("value")).alias("value"), F.count_distinct("method").alias("n")).where("n >= 2")
    return _done(out.withColumns({"variable": F.concat(F.lit(MAX_DIFF), "variable"), "method": F.lit(facets.AGGREGATE + MAX_DIFF[:-1])}), provenance)


#: What a series and its baseline share: the facet, which has the provenance, is part of it.
_KEYS = ["variable", "entity", "extra", "method", "period", "unit", "scaling", "provenance", "is_aggregate"]


def _matching(points: DataFrame, base: DataFrame, last_year: int, tag: str, provenance: str) -> DataFrame:
    keys = [*_KEYS, "month"]
    on = [F.col(f"p.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    later = points.withColumns({"month": extract_month("date"), "year": extract_year("date")}).where((F.col("year") > last_year) & F.col("value").isNotNull())
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    out = later.alias("p").join(base.alias("b"), cond).select("p.variable", "p.entity", "p.extra", "p.date", "p.method", "p.period", "p.unit", "p.scaling", (F.col("p.value") - F.col("b.base")).alias("value"))
    return _done(out.withColumns({"variable": F.concat(F.lit(f"DifferenceRelativeToBaseDate{tag}_"), "variable"), "method": F.concat(F.lit(facets.AGGREGATE), F.coalesce("method", F.lit("")))}), provenance)


def difference_to_date(points: DataFrame, base_date: str, provenance: str, imports: list[str] | None = None) -> DataFrame:
    """Value less each value of the base date's year and of the same month (0 for yearly dates), for later years, within
    a series of one import. Several base values of a month give a row each."""
    points = facets.in_imports(points, imports)
    base = points.where((extract_year("date") == int(base_date[:4])) & F.col("value").isNotNull()).select(*_KEYS, extract_month("date").alias("month"), F.col("value").alias("base"))
    return _matching(points, base, int(base_date[:4]), base_date.replace("-", ""), provenance)


def difference_to_range(points: DataFrame, start: str, end: str, provenance: str, imports: list[str] | None = None) -> DataFrame:
    """Value less the mean of the same month over the years of the range, for later years."""
    points = facets.in_imports(points, imports)
    y1, y2 = int(start[:4]), int(end[:4])
    base = points.where(extract_year("date").between(y1, y2) & F.col("value").isNotNull()).groupBy(*_KEYS, extract_month("date").alias("month")).agg(F.avg("value").alias("base"))
    return _matching(points, base, y2, f"{start.replace('-', '')}to{end.replace('-', '')}", provenance)


def quantiles_across_methods(points: DataFrame, provenance: str, which=QUANTILES, imports: list[str] | None = None) -> DataFrame:
    """The 50th, 10th and 90th percentile over methods; spreads across methods are left out."""
    points = facets.in_imports(points, imports)
    keys = ["variable", "entity", "extra", "date", "period", "scaling", "unit"]
    mine = points.where("value is not null").where(~F.col("variable").startswith(MAX_DIFF))
    cut = F.percentile_approx("value", [q for _, q in which], 10_000)
    rows = mine.groupBy(*keys).agg(cut.alias("q")).select(*keys, F.posexplode("q").alias("i", "value"))
    name = F.element_at(F.array(*[F.lit(p) for p, _ in which]), F.col("i") + 1)
    method = F.concat(F.lit(facets.AGGREGATE), F.regexp_replace(name, "_$", ""))
    return _done(rows.withColumns({"variable": F.concat(name, "variable"), "method": method}), provenance)


_OVER = {"AVG": (F.avg, "AggregateMean_"), "MAX": (F.max, "HighestValue_"), "MIN": (F.min, "LowestValue_"), "SUM": (F.sum, "AggregateSum_")}


@dataclass
class OverTime:
    function: str
    period: str = "P1Y"
    output_date: str | None = None
    input_period: str | None = None
    prefix: str = ""
    keep_name: bool = True
    variable: str | None = None
    imports: list[str] | None = None


def years_of(window: str | None) -> int | None:
    found = re.fullmatch(r"P(\d+)Y", window or "")
    return int(found[1]) if found else None


def _binned(points: DataFrame, output_date: str | None, period: str) -> tuple[DataFrame, object]:
    """Points of the window, and the date they count for. A window of n years ends with a four-digit output date."""
    if not output_date:
        size = 7 if period == "P1M" else 4
        return points, F.substring("date", 1, size)
    n = years_of(period)
    if n and len(output_date) == 4:
        last = int(output_date)
        points = points.where(extract_year("date").between(last - n + 1, last))
    return points, F.lit(output_date)


def over_time(points: DataFrame, config: OverTime, provenance: str) -> DataFrame:
    """One value for each year or month, or for one output date."""
    function, name = _OVER[config.function]
    mine = facets.in_imports(points, config.imports).where("value is not null")
    if config.input_period:
        mine = mine.where(F.coalesce("period", F.lit("")) == config.input_period)
    if config.variable:
        mine = mine.where(F.col("variable").rlike(f"^{config.variable}$"))
    mine, date = _binned(mine, config.output_date, config.period)
    keys = ["variable", "entity", "extra", "method", "unit", "scaling"]
    out = mine.groupBy(*keys, date.alias("date")).agg(function("value").alias("value"))
    return _done(out.withColumns({"variable": F.concat(F.lit(config.prefix if config.keep_name else name), "variable"), "period": F.lit(config.period)}), provenance)


@dataclass
class Threshold:
    value: float
    at_least: bool = True
    unit: str = ""
    variable: str | None = None
    input_period: str = "P1D"
    output_period: str = "P1Y"
    output_date: str | None = None
    imports: list[str] | None = None


def count_beyond(points: DataFrame, config: Threshold, provenance: str) -> DataFrame:
    """Number of points at or beyond a threshold in each bin; bins without any are dropped, and so is the unit."""
    v = F.col("value")
    hit = v >= config.value if config.at_least else v <= config.value
    mine = facets.in_imports(points, config.imports).where(hit & (F.coalesce("period", F.lit("")) == config.input_period))
    if config.unit:
        mine = mine.where(F.coalesce("unit", F.lit("")) == config.unit)
    if config.variable:
        mine = mine.where(F.col("variable").rlike(f"^{config.variable}$"))
    mine, date = _binned(mine, config.output_date, config.output_period)
    what = "NumberOfMonths_" if config.input_period == "P1M" else "NumberOfDays_"
    name = f"{what}{str(config.value).removesuffix('.0')}{config.unit or 'Units'}{'OrMore_' if config.at_least else 'OrLess_'}"
    out = mine.groupBy("variable", "entity", "extra", "method", "scaling", date.alias("date")).agg(F.count("*").cast("double").alias("value"))
    return _done(out.withColumns({"variable": F.concat(F.lit(name), "variable"), "period": F.lit(config.output_period), "unit": F.lit(None).cast("string")}), provenance)
