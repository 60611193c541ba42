"""Queries over the driver's tables for the graph operators, each with the SQL that gives the same rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from statloom.operators import closure, entities, enums, group_specs, groups, places, series, summaries, variables, vectors
from statloom.plans.registry import NUDGE, QUERIES, SQL, Query, query  # noqa: F401
from statloom.plans.storage import saved
from statloom.sources import star


A = "select 'customer/' || o_custkey as entity, strftime(o_orderdate, '%Y-%m') as date, o_orderpriority as method, sum(o_totalprice) as value from orders group by all"
L = "select 'supplier/' || l_suppkey as entity, strftime(l_shipdate, '%Y-%m') as date, l_returnflag as method, count(*)::double as n, sum(l_quantity) as q, sum(l_extendedprice * (1 - l_discount)) as r from lineitem group by all"
LONG = f"select 'Count_LineItem' as variable, entity, date, method, n as value from ({L}) union all select 'Quantity_LineItem', entity, date, method, q from ({L}) union all select 'Revenue_LineItem', entity, date, method, r from ({L})"
E = "select 'user/' || user_id as entity, strftime(ts, '%Y-%m-%d') as date, event_type as method, sum(value) as value from events group by all"
PLACES = """select 'customer/' || c_custkey as s, 'nation/' || c_nationkey as o, 'customer' as p from customer union all
  select 'supplier/' || s_suppkey, 'nation/' || s_nationkey, 'supplier' from supplier union all select 'nation/' || n_nationkey, 'region/' || n_regionkey, 'nation' from nation"""
AGG = "dcAggregate/"

def shown(df: DataFrame, *columns: str, digits: int = 4) -> DataFrame:
    return df.select(*(columns or ("variable", "entity", "date", "method", "provenance")), F.round(F.col("value") + NUDGE, digits).alias("value"))


# places
def _config(**more) -> places.PlaceAggregation:
    return places.PlaceAggregation(["orders"], "Customer", "Nation", "orders_agg", **more)


def _meta(variable: str, prop: str, stat: str) -> list[tuple[str, str, str]]:
    return [(variable, "measuredProperty", prop), (variable, "statType", stat)]


def _place_sql(variable: str, function: str, join: str = "join customer c on entity = 'customer/' || c_custkey", parent: str = "'nation/' || c_nationkey") -> str:
    return f"with a as ({A}) select '{variable}' as variable, {parent} as entity, date, '{AGG}' || method as method, 'dc/base/orders_agg' as provenance, round({function}(value), 4) as value from a {join} group by all"


@query("place_sum", _place_sql("Amount_Order", "sum"))
def place_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(places.aggregate_places(star.order_points(spark, sf_dir), star.place_edges(spark, sf_dir), _config()))


def _by_strategy(variable: str, prop: str, stat: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        edges = star.place_edges(spark, sf_dir).unionByName(star.edges_of(spark, _meta(variable, prop, stat)))
        return shown(places.aggregate_places(star.order_points(spark, sf_dir, variable), edges, _config()))

    return run


for _n, _v, _p, _s, _f in (("place_min", "Min_Amount_Order", "amount", "minValue", "min"), ("place_max", "Max_Amount_Order", "amount", "maxValue", "max"), ("place_mean", "Mean_Amount_Order", "concentration", "meanValue", "avg")):
    query(_n, _place_sql(_v, _f))(_by_strategy(_v, _p, _s))


@query("place_none", _place_sql("Amount_Order", "sum"))
def place_none(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A variable with a denominator is never rolled up, one without metadata beside it is."""
    edges = star.place_edges(spark, sf_dir).unionByName(star.edges_of(spark, [*_meta("Share", "count", "measuredValue"), ("Share", "measurementDenominator", "Total")]))
    both = star.order_points(spark, sf_dir, "Share").unionByName(star.order_points(spark, sf_dir))
    return shown(places.aggregate_places(both, edges, _config()))


@query("place_chain", f"with a as ({A}) select 'Amount_Order' as variable, 'region/' || n_regionkey as entity, date, '{AGG}' || method as method, 'dc/base/orders_region' as provenance, round(sum(value), 4) as value from a join customer c on entity = 'customer/' || c_custkey join nation on c_nationkey = n_nationkey group by all")
def place_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = star.place_edges(spark, sf_dir)
    one = places.aggregate_places(star.order_points(spark, sf_dir), edges, _config())
    return shown(places.aggregate_places(one, edges, places.PlaceAggregation(["orders_agg"], "Nation", "Region", "orders_region")))


def _two_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    second = star.table(spark, sf_dir, "customer").select(F.concat(F.lit("customer/"), "c_custkey").alias("subject_id"), F.lit("containedInPlace").alias("predicate"), F.concat(F.lit("nation/"), (F.col("c_nationkey") + 1) % 25).alias("object_id"), F.lit("dc/base/second").alias("provenance"))
    return star.place_edges(spark, sf_dir).unionByName(second)


_BOTH = "(select 'customer/' || c_custkey as c, 'nation/' || c_nationkey as p from customer union select 'customer/' || c_custkey, 'nation/' || ((c_nationkey + 1) % 25) from customer)"


@query("place_multi_parent", _place_sql("Amount_Order", "sum", f"join {_BOTH} on entity = c", "p"))
def place_multi_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(places.aggregate_places(star.order_points(spark, sf_dir), _two_parents(spark, sf_dir), _config(several_parents=True)))


@query("place_min_parent", _place_sql("Amount_Order", "sum", f"join (select c, min(p) as p from {_BOTH} group by c) on entity = c", "p"))
def place_min_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(places.aggregate_places(star.order_points(spark, sf_dir), _two_parents(spark, sf_dir), _config()))


# sums of variables and arithmetic
_SUM = f"with l as ({LONG}) select 'Total' as variable, entity, date, '{AGG}' || method as method, 'dc/base/@p' as provenance, round(sum(value), 4) as value from l where variable in ('Count_LineItem', @v) group by all"


@query("sv_sum_strict", _SUM.replace("@p", "lineitem_StatVarAgg").replace("@v", "'Quantity_LineItem'"))
def sv_sum_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(variables.sum_variables(star.line_points(spark, sf_dir), variables.VariableSum("Total", ["Count_LineItem", "Quantity_LineItem"], ["lineitem"])))


@query("sv_sum_lenient", _SUM.replace("@p", "lenient").replace("@v", "'Missing'"))
def sv_sum_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(variables.sum_variables(star.line_points(spark, sf_dir), variables.VariableSum("Total", ["Count_LineItem", "Missing"], ["lineitem"], "lenient", lenient=True)))


_FEW = f"with l as ({LONG}) select 'Total' as variable, entity, date, '{AGG}' || method as method, 'dc/base/x' as provenance, round(sum(value), 4) as value from l where variable = 'Count_LineItem' or (variable = 'Quantity_LineItem' and value > 100) group by all having count(distinct variable) = 2"


@query("sv_sum_incomplete", _FEW)
def sv_sum_incomplete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One of the sources has values for some series and dates only."""
    p = star.line_points(spark, sf_dir).where("variable <> 'Quantity_LineItem' or value > 100")
    return shown(variables.sum_variables(p, variables.VariableSum("Total", ["Count_LineItem", "Quantity_LineItem"], ["lineitem"], "x")))


def _calculation(operation: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        c = variables.Calculation(variables.Input("Revenue_LineItem", method="R"), variables.Input("Quantity_.*", method="R"), operation, 100.0, variable="Derived", method="Calc", period="P1M")
        return shown(variables.calculate(star.line_points(spark, sf_dir), c, "calc"))

    return run


for _op, _x in (("DIVIDE", "r / nullif(q, 0) * 100"), ("MULTIPLY", "r * q * 100"), ("ADD", "r + q"), ("SUBTRACT", "r - q")):
    query("calc_" + _op.lower(), f"with l as ({L}) select 'Derived' as variable, entity, date, 'Calc' as method, 'dc/base/calc' as provenance, round({_x}, 4) as value from l where method = 'R' and {_x} is not null")(_calculation(_op))


@query("calc_prefix", f"with l as ({L}) select 'Ratio_Revenue_LineItem_' || method as variable, entity, date, 'Of_' || method as method, 'dc/base/calc' as provenance, round(r / q, 4) as value from l where method in ('A', 'N')"
       f" and q <> 0 union all select 'Ratio_Revenue_LineItem_' || a.method, entity, date, 'Of_' || b.method, 'dc/base/calc', round(a.r / b.q, 4) from l a join l b using (entity, date) where a.method in ('A', 'N') and b.method in ('A', 'N') and a.method <> b.method and b.q <> 0")
def calc_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = variables.Calculation(variables.Input("Revenue_LineItem", method="[AN]"), variables.Input("Quantity_LineItem", method="[AN]"), "DIVIDE", variable_prefix="Ratio_", method_prefix="Of_")
    return shown(variables.calculate_all(star.line_points(spark, sf_dir), variables.Calculations([c], "calc")))


# series
@query("series_max_diff", f"with a as ({A}) select 'MaxDiffAcrossMeasurementMethods_Amount_Order' as variable, entity, date, '{AGG}MaxDiffAcrossMeasurementMethods' as method, 's' as provenance, round(max(value) - min(value), 4) as value from a group by all having count(distinct method) >= 2")
def series_max_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(series.spread_across_methods(star.order_points(spark, sf_dir), "s"))


def _base_sql(tag: str, base: str, year: int) -> str:
    return f"with l as ({LONG}), b as ({base}) select 'DifferenceRelativeToBaseDate{tag}_' || l.variable as variable, l.entity, l.date, '{AGG}' || l.method as method, 's' as provenance, round(l.value - b.base, 4) as value from l join b on l.variable = b.variable and l.entity = b.entity and l.method = b.method and l.date[6:7]::int = b.month where l.date[1:4]::int > {year}"


_YEAR_1996 = "select variable, entity, method, date[6:7]::int as month, value as base from l where date[1:4] = '1996'"


@query("series_diff_base_date", _base_sql("199601", _YEAR_1996, 1996))
def series_diff_base_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base date stands for its year: every month is compared with its own value of 1996."""
    return shown(series.difference_to_date(star.line_points(spark, sf_dir), "1996-01", "s"))


@query("series_diff_base_year", _base_sql("1996", _YEAR_1996, 1996))
def series_diff_base_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(series.difference_to_date(star.line_points(spark, sf_dir), "1996", "s"))


@query("series_diff_base_range", _base_sql("1995to1996", "select variable, entity, method, date[6:7]::int as month, avg(value) as base from l where date[1:4]::int between 1995 and 1996 group by all", 1996))
def series_diff_base_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(series.difference_to_range(star.line_points(spark, sf_dir), "1995", "1996", "s"))


# two imports with the same series, the second with doubled values, a third that isn't named
_IMPORTS = f"select *, 'one' as i from ({L}) union all select entity, date, method, n * 2, q * 2, r * 2, 'two' from ({L})"


def _three_imports(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = star.line_points(spark, sf_dir)
    more = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(f"dc/base/{i}").alias("i")) for k, i in ((1.0, "one"), (2.0, "two"), (5.0, "three"))])
    return p.withColumn("x", F.explode(more)).withColumns({"value": F.col("value") * F.col("x.k"), "provenance": F.col("x.i")}).select(p.columns)


@query("series_diff_two_imports", f"""with l as ({_IMPORTS}), b as (select i, entity, method, date[6:7]::int as m, n as base from l where date[1:4] = '1996')
select 'DifferenceRelativeToBaseDate1996_Count_LineItem' as variable, l.entity, l.date, '{AGG}' || l.method as method, 's' as provenance, round(l.n - b.base, 4) as value from l join b on l.i = b.i and l.entity = b.entity and l.method = b.method and l.date[6:7]::int = b.m where l.date[1:4]::int > 1996""")
def series_diff_two_imports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(series.difference_to_date(_three_imports(spark, sf_dir).where("variable = 'Count_LineItem'"), "1996", "s", ["one", "two"]))


@query("series_range_two_imports", f"""with l as ({_IMPORTS}), b as (select i, entity, method, date[6:7]::int as m, avg(n) as base from l where date[1:4]::int between 1995 and 1996 group by all)
select 'DifferenceRelativeToBaseDate1995to1996_Count_LineItem' as variable, l.entity, l.date, '{AGG}' || l.method as method, 's' as provenance, round(l.n - b.base, 4) as value from l join b on l.i = b.i and l.entity = b.entity and l.method = b.method and l.date[6:7]::int = b.m where l.date[1:4]::int > 1996""")
def series_range_two_imports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(series.difference_to_range(_three_imports(spark, sf_dir).where("variable = 'Count_LineItem'"), "1995", "1996", "s", ["one", "two"]))


@query("series_max_diff_imports", f"select 'MaxDiffAcrossMeasurementMethods_Count_LineItem' as variable, entity, date, '{AGG}MaxDiffAcrossMeasurementMethods' as method, 's' as provenance, round(max(n) - min(n), 4) as value from ({L}) group by all having count(distinct method) >= 2")
def series_max_diff_imports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(series.spread_across_methods(_three_imports(spark, sf_dir).where("variable = 'Count_LineItem'"), "s", ["one"]))


@query("series_ensemble_imports", f"with l as ({L}) " + " union all ".join(f"select '{p}AcrossModels_Count_LineItem' as variable, entity, date, '{AGG}{p}AcrossModels' as method, 's' as provenance, round(quantile_disc(n * 2, {q}), 4) as value from l group by all" for p, q in (("Median", 0.5), ("Percentile10", 0.1), ("Percentile90", 0.9))))
def series_ensemble_imports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spreads across methods beside the values are left out."""
    p = _three_imports(spark, sf_dir).where("variable = 'Count_LineItem'")
    spread = series.spread_across_methods(p, "dc/base/two", ["one"])
    return shown(series.quantiles_across_methods(p.unionByName(spread), "s", imports=["two"]))


@query("series_over_time_imports", f"with l as ({L}) select 'Yearly_Count_LineItem' as variable, entity, date[1:4] as date, method, 's' as provenance, round(sum(n * 2), 4) as value from l group by all")
def series_over_time_imports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(series.over_time(_three_imports(spark, sf_dir), series.OverTime("SUM", prefix="Yearly_", input_period="P1M", variable="Count_.*", imports=["two"]), "s"))


@query("series_count_imports", f"with l as ({L}) select 'NumberOfMonths_4UnitsOrMore_Count_LineItem' as variable, entity, date[1:4] as date, method, 's' as provenance, count(*)::double as value from l where n * 2 >= 4 group by all")
def series_count_imports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(series.count_beyond(_three_imports(spark, sf_dir), series.Threshold(4.0, variable="Count_.*", input_period="P1M", imports=["two"]), "s"))


@query("calc_imports", f"with l as ({L}) select 'Derived' as variable, entity, date, 'Calc' as method, 'dc/base/calc' as provenance, round(r * 2 + q * 2, 4) as value from l where method = 'R' union all select 'Other', entity, date, null, 'dc/base/calc', round(q * 2 - n * 2, 4) from l where method = 'A'")
def calc_imports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two calculations of one import, from one selection of the input."""
    one = variables.Calculation(variables.Input("Revenue_LineItem", method="R"), variables.Input("Quantity_LineItem", method="R"), "ADD", variable="Derived", method="Calc")
    two = variables.Calculation(variables.Input("Quantity_LineItem", method="A", period="P1M"), variables.Input("Count_LineItem", method="A"), "SUBTRACT", 9.0, variable="Other")
    return shown(variables.calculate_all(_three_imports(spark, sf_dir), variables.Calculations([one, two], "calc", imports=["two"])))


@query("place_filters", _place_sql("Amount_Order", "sum").replace("dc/base/orders_agg", "dc/base/f").replace(f"({A})", f"(select * from ({A}) where method <> '5-LOW')"))
def place_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of another import, and of the method that is never rolled up, stay out."""
    p = star.order_points(spark, sf_dir)
    p = p.withColumn("method", F.when(F.col("method") == "5-LOW", places.EXCLUDED_METHOD).otherwise(F.col("method")))
    p = p.unionByName(star.order_points(spark, sf_dir).withColumn("provenance", F.lit("dc/base/elsewhere")))
    return shown(places.aggregate_places(p, star.place_edges(spark, sf_dir), places.PlaceAggregation(["orders"], "Customer", "Nation", "f")))


@query("summary_imports", f"select variable, 'dc/base/two' as provenance, 'two' as import_name, count(*) as n_points, count(distinct (entity, method)) as n_series from ({LONG}) group by variable")
def summary_imports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.provenance_summary(_three_imports(spark, sf_dir), star.place_edges(spark, sf_dir), imports=["two"]).select("variable", "provenance", "import_name", "n_points", "n_series")


@query("summary_values", f"""with l as ({L}), f as (select method, min(date) as d0, max(date) as d1, min(n) as lo, max(n) as hi, count(*) as c, count(distinct entity) as s from l group by method), e as (select distinct method, entity from l),
  t as (select method, string_agg('"' || entity || '"', ',' order by entity) as top from (select * from e qualify row_number() over (partition by method order by entity) <= 3) group by method)
select 'ProvenanceSummary' as type, 'Count_LineItem' as key, 'dc/base/lineitem' as provenance, '{{"import_name":"lineitem","observation_count":' || sum(c) || ',"time_series_count":' || sum(s) || ',"series_summary":[' || string_agg('{{"series_key":{{"measurement_method":"' || method || '","observation_period":"P1M","is_dc_aggregate":false}},"earliest_date":"' || d0 || '","latest_date":"' || d1 ||
  '","min_value":' || lo || ',"max_value":' || hi || ',"observation_count":' || c || ',"time_series_count":' || s || ',"place_type_summary":{{"Supplier":{{"place_count":' || s || ',"min_value":' || lo || ',"max_value":' || hi || ',"top_places":[' || top || ']}}}}}}', ',' order by method) || ']}}' as value from f join t using (method)""")
def summary_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = star.line_points(spark, sf_dir).where("variable = 'Count_LineItem'")
    return summaries.key_values(summaries.provenance_summary(p, star.place_edges(spark, sf_dir)))


@query("series_ensemble", f"with a as ({A}) " + " union all ".join(f"select '{p}AcrossModels_Amount_Order' as variable, entity, date, '{AGG}{p}AcrossModels' as method, 's' as provenance, round(quantile_disc(value, {q}), 4) as value from a group by all" for p, q in (("Median", 0.5), ("Percentile10", 0.1), ("Percentile90", 0.9))))
def series_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(series.quantiles_across_methods(star.order_points(spark, sf_dir), "s"))


def _over_time(function: str) -> Query:
    return lambda spark, sf_dir: shown(series.over_time(star.line_points(spark, sf_dir), series.OverTime(function, keep_name=False), "s"))


for _fn, _name in (("AVG", "AggregateMean_"), ("MAX", "HighestValue_"), ("MIN", "LowestValue_"), ("SUM", "AggregateSum_")):
    query("series_over_time_" + _fn.lower(), f"with l as ({LONG}) select '{_name}' || variable as variable, entity, date[1:4] as date, method, 's' as provenance, round({_fn}(value), 4) as value from l group by all")(_over_time(_fn))


@query("series_window", f"with l as ({LONG}) select variable, entity, '1998' as date, method, 's' as provenance, round(avg(value), 4) as value from l where date[1:4]::int between 1996 and 1998 group by all")
def series_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(series.over_time(star.line_points(spark, sf_dir), series.OverTime("AVG", "P3Y", "1998"), "s"))


def _beyond(at_least: bool) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return shown(series.count_beyond(star.line_points(spark, sf_dir), series.Threshold(2.0, at_least, variable="Count_.*", input_period="P1M"), "s"))

    return run


for _n, _w, _c in (("ge", "OrMore", ">="), ("le", "OrLess", "<=")):
    query("series_count_" + _n, f"with l as ({L}) select 'NumberOfMonths_2Units{_w}_Count_LineItem' as variable, entity, date[1:4] as date, method, 's' as provenance, count(*)::double as value from l where n {_c} 2 group by all")(_beyond(_n == "ge"))


# counts of entities
def _entity(formats: list[str], constraints: list[entities.Constraint]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        got = entities.count_entities(star.event_edges(spark, sf_dir), entities.EntityCount(["Event"], ["location"], "counts", "startDate", formats, constraints))
        held = F.array_join(F.array_sort(F.transform(F.map_entries("constraints"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ",")
        return got.select("location", "type", "date", "period", held.alias("constraints"), "value")

    return run


def _entity_sql(size: int, period: str, held: str = "''", where: str = "true") -> str:
    return f"select 'user/' || user_id as location, 'Event' as type, strftime(ts, '%Y-%m-%d')[1:{size}] as date, '{period}' as period, {held} as constraints, count(distinct event_id)::double as value from events where {where} group by all"


query("entity_count_year", _entity_sql(4, "P1Y"))(_entity(["YYYY"], []))
query("entity_count_month", _entity_sql(7, "P1M"))(_entity(["YYYY-MM"], []))
query("entity_count_day", _entity_sql(10, "P1D"))(_entity(["YYYY-MM-DD"], []))
query("entity_count_several", " union all ".join(_entity_sql(*x) for x in ((4, "P1Y"), (7, "P1M"))))(_entity(["YYYY", "YYYY-MM"], []))
query("entity_count_wildcard", _entity_sql(7, "P1M", "'kind=' || event_type"))(_entity(["YYYY-MM"], [entities.Constraint("kind")]))
query("entity_count_range", " union all ".join((_entity_sql(7, "P1M", "'amount=[10 50]'", "value between 10 and 50"), _entity_sql(7, "P1M", "'amount=[50 -]'", "value >= 50"))))(_entity(["YYYY-MM"], [entities.Constraint("amount", 10, 50), entities.Constraint("amount", 50)]))


_SLICES = [entities.Constraint("kind"), entities.Constraint("amount", 10, 50), entities.Constraint("amount", 50)]


@query("entity_count_slices", " union all ".join((_entity_sql(7, "P1M", "'amount=[10 50],kind=' || event_type", "value between 10 and 50"), _entity_sql(7, "P1M", "'amount=[50 -]'", "value >= 50"))))
def entity_count_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second condition on a property makes a slice of its own, without the wildcard of the first."""
    return _entity(["YYYY-MM"], _SLICES)(spark, sf_dir)


@query("entity_count_imports", _entity_sql(7, "P1M", where="event_id % 2 = 0"))
def entity_count_imports(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = star.event_edges(spark, sf_dir).withColumn("provenance", F.when((F.col("predicate") == "typeOf") & (F.regexp_extract("subject_id", r"(\d+)$", 1).cast("bigint") % 2 == 0), "dc/base/even").otherwise("dc/base/odd"))
    got = entities.count_entities(edges, entities.EntityCount(["Event"], ["location"], "counts", "startDate", ["YYYY-MM"], [], imports=["even"]))
    return got.select("location", "type", "date", "period", F.lit("").alias("constraints"), "value")


@query("entity_points", _entity_sql(7, "P1M", "'x'").replace("location, 'Event' as type, ", "entity, ").replace(", 'x' as constraints", ", 'dc/base/counts' as provenance, true as is_aggregate"))
def entity_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = entities.entity_points(star.event_edges(spark, sf_dir), entities.EntityCount(["Event"], ["location"], "counts", "startDate", ["YYYY-MM"]))
    return got.select("entity", "date", "period", "provenance", "is_aggregate", "value")


@query("event_series", f"select 'Value_Event' as variable, entity, date, method, 'dc/base/events' as provenance, round(value, 4) as value from ({E})")
def event_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points to series and observations and back."""
    from statloom import schema
    from statloom.functions.ids import with_facet_id

    return shown(schema.join(*schema.split(star.event_points(spark, sf_dir), with_facet_id)))


# closures
@query("linked_contained_in_place", f"""with recursive e as ({PLACES}), w as (select s, o, p, 1 as n from e union select w.s, e.o, w.p, n + 1 from w join e on w.o = e.s where n <= 10)
select distinct s as subject_id, 'linkedContainedInPlace' as predicate, o as object_id, 'dc/base/generated/' || p as provenance from w""")
def linked_contained_in_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    return closure.linked_contained_in_place(star.place_edges(spark, sf_dir))


def _group_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts are members of their brand, brands are specialisations of their last digit's group, these of all."""
    brand = F.regexp_replace("p_brand", "[^A-Za-z0-9]", "")
    half = F.concat(F.lit("Group"), F.right(brand, F.lit(1)))
    edge = lambda s, p, o: F.struct(s.alias("subject_id"), F.lit(p).alias("predicate"), o.alias("object_id"))
    facts = F.array(edge(F.concat(F.lit("part/"), "p_partkey"), "memberOf", brand), edge(brand, "specializationOf", half), edge(half, "specializationOf", F.lit("all")))
    return star.table(spark, sf_dir, "part").select(F.explode(facts).alias("e")).select("e.*", F.lit("dc/base/part").alias("provenance")).distinct()


_B = "regexp_replace(p_brand, '[^A-Za-z0-9]', '', 'g')"
_H = f"('Group' || right({_B}, 1))"


@query("linked_member_of", f"select distinct 'part/' || p_partkey as subject_id, 'linkedMemberOf' as predicate, o as object_id, 'dc/base/generated/part' as provenance from (select p_partkey, unnest([{_B}, {_H}, 'all']) as o from part)")
def linked_member_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return closure.linked_member_of(_group_facts(spark, sf_dir))


def _topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A topic of everything holds a topic for each brand, which holds a peer group of its parts."""
    brand = F.regexp_replace("p_brand", "[^A-Za-z0-9]", "")
    edge = lambda s, p, o: F.struct(s.alias("subject_id"), F.lit(p).alias("predicate"), o.alias("object_id"))
    topic, peers = F.concat(F.lit("topic/"), brand), F.concat(F.lit("peers/"), brand)
    facts = F.array(edge(F.lit("topic/all"), "typeOf", F.lit("Topic")), edge(F.lit("topic/all"), "relevantVariable", topic), edge(topic, "typeOf", F.lit("Topic")), edge(topic, "relevantVariable", peers), edge(peers, "typeOf", F.lit("StatVarPeerGroup")), edge(peers, "member", F.concat(F.lit("part/"), "p_partkey")))
    return star.table(spark, sf_dir, "part").select(F.explode(facts).alias("e")).select("e.*", F.lit("dc/base/part").alias("provenance")).distinct()


@query("linked_member", f"select 'part/' || p_partkey as subject_id, 'linkedMember' as predicate, unnest(['topic/all', 'topic/' || {_B}]) as object_id, 'dc/base/generated/part' as provenance from part")
def linked_member(spark: SparkSession, sf_dir: str) -> DataFrame:
    return closure.linked_member(_topics(spark, sf_dir))


@query("ancestors", f"select distinct {_B} as start, 'all,' || {_H} as ancestors from part union select distinct {_H}, 'all' from part")
def ancestors(spark: SparkSession, sf_dir: str) -> DataFrame:
    sort = F.array_sort(F.col("ancestors"), lambda a, b: F.when(a == "all", -1).when(b == "all", 1).otherwise(F.when(a < b, -1).otherwise(1)))
    return closure.ancestors(_group_facts(spark, sf_dir)).select("start", F.array_join(sort, ",").alias("ancestors"))


# summaries
@query("node_types", "select s as subject_id, t as types from (select 'customer/' || c_custkey as s, 'Customer' as t from customer union all select 'supplier/' || s_suppkey, 'Supplier' from supplier union all select 'nation/' || n_nationkey, 'Nation' from nation union all select 'region/' || r_regionkey, 'Region' from region)")
def node_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.node_types(star.place_edges(spark, sf_dir)).select("subject_id", F.array_join("types", ",").alias("types"))


@query("node_names", "select 'nation/' || n_nationkey as subject_id, least(n_name, upper(n_name) || '_ALT') as name from nation")
def node_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    from statloom.functions.ids import literal_key

    n = star.table(spark, sf_dir, "nation").select(F.concat(F.lit("nation/"), "n_nationkey").alias("s"), F.explode(F.array("n_name", F.concat(F.upper("n_name"), F.lit("_ALT")))).alias("value"))
    n = n.withColumn("key", literal_key("value"))
    edges = n.select(F.col("s").alias("subject_id"), F.lit("name").alias("predicate"), F.col("key").alias("object_id"), F.lit("dc/base/nation").alias("provenance"))
    return summaries.node_names(edges, n.select(F.col("key").alias("subject_id"), "value").distinct())


@query("topic_lists", f"""with b as (select distinct {_B} as b from part), m as (select 'topic/all' as s, 'topic/' || b as o, 'relevantVariableList' as p from b union all select 'topic/' || b, 'peers/' || b, 'relevantVariableList' from b union all select 'peers/' || {_B}, 'part/' || p_partkey, 'memberList' from part)
select s as subject_id, p as predicate, list from (select s, p, string_agg(o, ',' order by o) as list from m group by s, p)""")
def topic_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.member_lists(_topics(spark, sf_dir))


def _nation_names(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    from statloom.functions.ids import literal_key

    n = star.table(spark, sf_dir, "nation").select(F.concat(F.lit("nation/"), "n_nationkey").alias("s"), F.col("n_name").alias("value")).withColumn("key", literal_key("value"))
    edges = n.select(F.col("s").alias("subject_id"), F.lit("name").alias("predicate"), F.col("key").alias("object_id"), F.lit("dc/base/nation").alias("provenance"))
    return edges, n.select(F.col("key").alias("subject_id"), "value")


@query("node_properties", "select 'nation/' || n_nationkey as subject_id, 'Nation' as types, n_name as name from nation union all select 'customer/' || c_custkey, 'Customer', null from customer union all select 'supplier/' || s_suppkey, 'Supplier', null from supplier union all select 'region/' || r_regionkey, 'Region', null from region")
def node_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    named, literals = _nation_names(spark, sf_dir)
    return summaries.node_properties(star.place_edges(spark, sf_dir).unionByName(named), literals).select("subject_id", F.array_join("types", ",").alias("types"), "name")


_LISTS = f"""with b as (select distinct {_B} as b from part), m as (select 'topic/all' as s, 'topic/' || b as o, 'relevantVariableList' as p from b union all select 'topic/' || b, 'peers/' || b, 'relevantVariableList' from b union all select 'peers/' || {_B}, 'part/' || p_partkey, 'memberList' from part),
  l as (select s, p, string_agg(o, ',' order by o) as list from m group by s, p)"""


@query("list_edges", f"{_LISTS} select s as subject_id, p as predicate, left(list, 16) || ':' || sha256(list) as object_id, 'gen' as provenance from l")
def list_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.list_nodes_and_edges(_topics(spark, sf_dir), "gen")[1]


@query("list_nodes", f"{_LISTS} select distinct left(list, 16) || ':' || sha256(list) as subject_id, list as value from l")
def list_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.list_nodes_and_edges(_topics(spark, sf_dir), "gen")[0]


@query("provenance_summary", f"with l as ({LONG}) select variable, 'dc/base/lineitem' as provenance, method, count(*) as n_points, count(distinct entity) as n_series, min(date) as first_date, max(date) as last_date, round(min(value), 4) as min_value, round(max(value), 4) as max_value from l group by all")
def provenance_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = summaries.provenance_summary(star.line_points(spark, sf_dir), star.place_edges(spark, sf_dir)).select("variable", "provenance", F.explode("facets").alias("f"))
    return got.select("variable", "provenance", "f.method", "f.n_points", "f.n_series", "f.first_date", "f.last_date", F.round("f.min_value", 4).alias("min_value"), F.round("f.max_value", 4).alias("max_value"))


@query("place_type_summary", f"with l as ({LONG}), t as (select variable, method, count(distinct entity) as n_places, round(min(value), 4) as min_value, round(max(value), 4) as max_value from l group by all), s as (select distinct variable, method, entity from l), k as (select variable, method, string_agg(entity, ',' order by entity) as sample_places from (select * from s qualify row_number() over (partition by variable, method order by entity) <= 3) group by all) select variable, 'Supplier' as place_type, method, n_places, min_value, max_value, sample_places from t join k using (variable, method)")
def place_type_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = summaries.place_type_summary(star.line_points(spark, sf_dir), star.place_edges(spark, sf_dir))
    return got.select("variable", "place_type", "method", "n_places", F.round("min_value", 4).alias("min_value"), F.round("max_value", 4).alias("max_value"), F.array_join("sample_places", ",").alias("sample_places"))


# enumerations and groups
def _enum_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    brand = F.regexp_replace("p_brand", "[^A-Za-z0-9]", "")
    half = F.concat(F.lit("Group"), F.right(brand, F.lit(1)))
    variable = F.concat(F.lit("Count_Part_"), brand)
    edge = lambda s, p, o: F.struct(s.alias("subject_id"), F.lit(p).alias("predicate"), o.alias("object_id"))
    facts = F.array(edge(variable, "typeOf", F.lit("StatisticalVariable")), edge(variable, "populationType", F.lit("Part")), edge(variable, "measuredProperty", F.lit("count")), edge(variable, "statType", F.lit("measuredValue")), edge(variable, "brand", brand), edge(brand, "specializationOf", half))
    return star.table(spark, sf_dir, "part").select(F.explode(facts).alias("e")).select("e.*", F.lit("dc/base/part").alias("provenance")).distinct()


@query("super_enum", f"select {_H} as parent_value, 'brand=' || {_H} || 'measuredProperty=countpopulationType=PartstatType=measuredValuetypeOf=StatisticalVariable' as key_str, 'part/' || (p_size) as entity, count(*)::double as value from part group by all")
def super_enum(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = _enum_edges(spark, sf_dir)
    part = star.table(spark, sf_dir, "part")
    p = star.points(part, F.lit(""), F.concat(F.lit("part/"), "p_size"), F.lit("2024"), F.count("*").cast("double"), F.concat(F.lit("Count_Part_"), F.regexp_replace("p_brand", "[^A-Za-z0-9]", "")), "P1Y", "part")
    p = p.withColumn("variable", F.col("method")).withColumn("method", F.lit("m"))
    targets = saved(enums.parent_variables(edges, ["brand"]), "targets")
    got = enums.aggregate_enums(p, edges, ["brand"], targets=targets)
    target = targets.select("target", "parent_value", "key_str").distinct()
    return got.join(target, got.variable == target.target).select("parent_value", "key_str", "entity", "value")


@query("super_enum_imports", f"select {_H} as parent_value, 'part/' || p_size as entity, count(*)::double as value from part where right({_B}, 1) = '1' group by all")
def super_enum_imports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of brands that end in 1 are of the import, the others of another."""
    edges = _enum_edges(spark, sf_dir)
    part = star.table(spark, sf_dir, "part")
    p = star.points(part, F.lit(""), F.concat(F.lit("part/"), "p_size"), F.lit("2024"), F.count("*").cast("double"), F.concat(F.lit("Count_Part_"), F.regexp_replace("p_brand", "[^A-Za-z0-9]", "")), "P1Y", "part")
    p = p.withColumns({"variable": F.col("method"), "provenance": F.when(F.col("method").endswith("1"), F.lit("dc/base/part")).otherwise("dc/base/else")}).withColumn("method", F.lit("m"))
    targets = saved(enums.parent_variables(edges, ["brand"], ["part"]), "targets")
    got = enums.aggregate_enums(p, edges, ["brand"], ["part"], targets)
    return got.join(targets.select("target", "parent_value").distinct(), got.variable == F.col("target")).select("parent_value", "entity", "value")


_NAME = "left(@, 16) || ':' || to_base64(unhex(sha256(@)))"
_FB = "regexp_replace(b, '([A-Za-z])([0-9])', '\\1 \\2', 'g')"
_WALK = f"""with v as (select distinct {_B} as b, regexp_replace(p_type, '[^A-Za-z0-9]', '', 'g') as k from part), w as (select *, 'Count_Part_' || b || '_' || k as var, {_FB} as fb from v),
  s as (select var, null as n1, null as n2, null as m2, 'dc/g/Part_Brand-' || b || '_Kind-' || k as n3, 'Part With Brand = ' || fb || ', Kind = ' || k as m3, true as first from w
    union all select var, 'dc/g/Part_Brand-' || b || '_Kind-' || k, 'dc/g/Part_Brand_Kind-' || k, 'Part With Brand, Kind = ' || k, 'dc/g/Part_Kind-' || k, 'Part With Kind = ' || k, false from w
    union all select var, 'dc/g/Part_Brand-' || b || '_Kind-' || k, 'dc/g/Part_Brand-' || b || '_Kind', 'Part With Brand = ' || fb || ', Kind', 'dc/g/Part_Brand-' || b, 'Part With Brand = ' || fb, false from w
    union all select var, 'dc/g/Part_Kind-' || k, 'dc/g/Part_Kind', 'Part With Kind', 'dc/g/Part', 'Part', false from w union all select var, 'dc/g/Part_Brand-' || b, 'dc/g/Part_Brand', 'Part With Brand', 'dc/g/Part', 'Part', false from w)"""
_EDGES = f"""select var as s, 'memberOf' as p, n3 as o from s where first union select n2, 'typeOf', 'StatVarGroup' from s where not first union select n3, 'typeOf', 'StatVarGroup' from s
  union select n2, 'name', {_NAME.replace("@", "m2")} from s where not first union select n3, 'name', {_NAME.replace("@", "m3")} from s union select n1, 'specializationOf', n2 from s where not first union select n2, 'specializationOf', n3 from s where not first
  union select var, 'linkedMemberOf', n2 from s where not first union select var, 'linkedMemberOf', n3 from s"""


@query("sv_groups", f"{_WALK} select s as subject_id, p as predicate, o as object_id, 'dc/base/generated/part' as provenance from ({_EDGES} union select 'dc/g/Part', 'specializationOf', 'dc/g/Uncategorized')")
def sv_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups.build_groups(star.part_edges(spark, sf_dir))


@query("sv_groups_pruned", f"""{_WALK}, kids as (select 'dc/g/Part_Brand-' || b || '_Kind' as half, count(*) as n from w group by 1), kinds as (select 'dc/g/Part_Brand_Kind-' || k as half, count(*) as n from w group by 1)
select 'counted' as what, (select count(*) from w) as n_variables, (select count(*) from kids where n > 1)::bigint as n_brands, (select count(*) from kinds where n > 1)::bigint as n_kinds""")
def sv_groups_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After pruning: variables with a group, and the halves ``Brand-b_Kind`` and ``Brand_Kind-k`` that have several
    children (groups with one child are gone, the full groups always)."""
    e = groups.build_groups(star.part_edges(spark, sf_dir), pruned=True)
    member = e.where("predicate = 'memberOf'").select("subject_id").distinct()
    half = lambda pattern: e.where(F.col("predicate").isin("memberOf", "specializationOf") & F.col("object_id").rlike(pattern)).select("object_id").distinct()
    count = lambda df, name: df.agg(F.count("*").alias(name)).withColumn("what", F.lit("counted"))
    return count(member, "n_variables").join(count(half("^dc/g/Part_Brand-[^_]+_Kind$"), "n_brands"), "what").join(count(half("^dc/g/Part_Brand_Kind-"), "n_kinds"), "what")


def _specs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Variables with constraintProperties; a spec a brand that makes its value dependent, a more specific one for each
    pair with a kind that begins with S, and a vertical."""
    from statloom.functions.ids import literal_key

    edges = star.part_edges(spark, sf_dir)
    v = edges.where("predicate = 'brand'").select("subject_id", F.explode(F.array(F.lit("brand"), F.lit("kind"))).alias("object_id"))
    edges = edges.unionByName(v.select("subject_id", F.lit("constraintProperties").alias("predicate"), "object_id", F.lit("dc/base/part").alias("provenance")))
    p = star.table(spark, sf_dir, "part").select(F.regexp_replace("p_brand", "[^A-Za-z0-9]", "").alias("b"), F.regexp_replace("p_type", "[^A-Za-z0-9]", "").alias("k")).distinct()
    one = p.select(F.concat(F.lit("spec/"), "b").alias("subject_id"), F.explode(F.array(F.struct(F.lit("constraintProperties").alias("p"), F.lit("kind").alias("o")), F.struct(F.lit("dependentPropertyValue").alias("p"), F.concat(F.lit("brand="), "b").alias("o")))).alias("x")).distinct()
    two = p.where("k like 'S%'").select(F.concat(F.lit("spec/"), "b", F.lit("/"), "k").alias("subject_id"), F.explode(F.array(F.struct(F.lit("dependentPropertyValue").alias("p"), F.concat(F.lit("brand="), "b").alias("o")), F.struct(F.lit("dependentPropertyValue").alias("p"), F.concat(F.lit("kind = "), "k").alias("o")))).alias("x"))
    said = one.unionByName(two).select("subject_id", F.col("x.p").alias("p"), F.col("x.o").alias("o"))
    literal = said.where("p = 'dependentPropertyValue'").select(literal_key("o").alias("subject_id"), F.col("o").alias("value"), F.lit(None).cast("array<string>").alias("types")).distinct()
    spec = said.select("subject_id", F.col("p").alias("predicate"), F.when(F.col("p") == "dependentPropertyValue", literal_key("o")).otherwise(F.col("o")).alias("object_id"))
    ids = said.select("subject_id").distinct()
    kind = ids.select("subject_id", F.explode(F.array(*[F.struct(F.lit(a).alias("predicate"), F.lit(b).alias("object_id")) for a, b in (("typeOf", "StatVarGroupSpec"), ("populationType", "Part"), ("vertical", "dc/g/Goods"))])).alias("x")).select("subject_id", "x.*")
    up = spark.createDataFrame([("dc/g/Goods", "specializationOf", "dc/g/Root", "dc/base/schema")], "subject_id string, predicate string, object_id string, provenance string")
    return edges.unionByName(spec.unionByName(kind).withColumn("provenance", F.lit("dc/base/schema"))).unionByName(up), literal


_PK = f"select distinct {_B} as b, regexp_replace(p_type, '[^A-Za-z0-9]', '', 'g') as k from part"


@query("group_dependent_values", f"select 'Count_Part_' || b || '_' || k as variable, case when k like 'S%' then 'Brand = ' || {_FB} || '|Kind = ' || k else 'Brand = ' || {_FB} end as strip from ({_PK})")
def group_dependent_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The more specific of two specs that a variable meets is taken."""
    edges, literal = _specs(spark, sf_dir)
    got = group_specs.dependent_matches(group_specs.base_data(edges), group_specs.dependent_specs(group_specs.specs(edges, literal)))
    return got.select("variable", F.array_join(F.array_sort("strip"), "|").alias("strip"))


@query("group_curated", f"""with v as ({_PK}), f as (select 'Count_Part_' || b || '_' || k as var, b, k from v), g as (select var, k, 'dc/g/Part_Kind-' || k as grp from f where k not like 'S%')
select var as subject_id, 'memberOf' as predicate, grp as object_id from g union select var, 'memberOf', 'dc/g/Part' from f where k like 'S%' union select var, 'linkedMemberOf', unnest([grp, 'dc/g/Part_Kind', 'dc/g/Part', 'dc/g/Root', 'dc/g/Goods']) from g
union select var, 'linkedMemberOf', unnest(['dc/g/Part', 'dc/g/Root', 'dc/g/Goods']) from f where k like 'S%' union select grp, 'specializationOf', 'dc/g/Part_Kind' from g union select 'dc/g/Part_Kind', 'specializationOf', 'dc/g/Part' from g union select 'dc/g/Part', 'specializationOf', 'dc/g/Goods' from f""")
def group_curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole hierarchy with specs: dependent values leave the groups, the population's group has its vertical."""
    edges, literal = _specs(spark, sf_dir)
    got = group_specs.generate(edges, literal)
    return got.where(F.col("predicate").isin("memberOf", "linkedMemberOf", "specializationOf")).select("subject_id", "predicate", "object_id")


@query("group_curated_members", f"""with v as (select 'Count_Part_' || b || '_' || k as var from ({_PK}) where k like 'S%') select var as subject_id, 'linkedMemberOf' as predicate, unnest(['dc/g/Hand', 'dc/g/Goods', 'dc/g/Root']) as object_id, 'dc/base/generated/hand' as provenance from v""")
def group_curated_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges, _ = _specs(spark, sf_dir)
    hand = edges.where("predicate = 'kind' and object_id like 'S%'").select("subject_id", F.lit("memberOf").alias("predicate"), F.lit("dc/g/Hand").alias("object_id"), F.lit("dc/base/hand").alias("provenance"))
    up = spark.createDataFrame([("dc/g/Hand", "specializationOf", "dc/g/Goods", "dc/base/schema")], "subject_id string, predicate string, object_id string, provenance string")
    return group_specs.curated_linked(edges.unionByName(hand).unionByName(up))


# vectors
_COS = "list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])) / (sqrt(list_sum(list_transform(a.v, lambda x: x * x))) * sqrt(list_sum(list_transform(b.v, lambda x: x * x))))"


@query("embedding_topk", f"with e as (select vec_id, embedding::double[] as v from embeddings), s as (select a.vec_id as query, b.vec_id as item, {_COS} as s from e a join e b on a.vec_id <> b.vec_id where a.vec_id % 50 = 0) select query, item, row_number() over (partition by query order by round(s, 9) desc, item)::int as rank, round(s, 6) as similarity from s qualify rank <= 5")
def embedding_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five most similar other vectors of every vector whose id is divisible by 50."""
    e = star.table(spark, sf_dir, "embeddings")
    return vectors.nearest(e, e.where("vec_id % 50 = 0"), 5).select("query", "item", F.col("rank").cast("int").alias("rank"), F.round("similarity", 6).alias("similarity"))


def _word_lengths(texts: list[str]):
    """A model for tests: letters, digits and length of a text."""
    import numpy as np

    return np.array([[sum(c.isalpha() for c in t), sum(c.isdigit() for c in t), len(t)] for t in texts], np.float64)


@query("to_embed", """with p as (select 'part/' || p_partkey as subject_id, case when p_partkey % 3 = 0 then 'a fine ' || p_brand else p_name end as label from part where p_partkey % 2 = 0 and p_size > 10)
select subject_id, label, '{"title":"' || subject_id || '","name":"' || label || '"}' as text, sha256('{"title":"' || subject_id || '","name":"' || label || '"}') as content_key from p""")
def to_embed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts with even keys are variables; those of size 10 or less have not changed since; every third has a sentence."""
    p = star.table(spark, sf_dir, "part")
    n = p.select(F.concat(F.lit("part/"), F.col("p_partkey").cast("string")).alias("subject_id"), F.col("p_name").alias("name"), F.array(F.when(F.col("p_partkey") % 2 == 0, "StatisticalVariable").otherwise("Thing")).alias("types"), F.to_timestamp(F.when(F.col("p_size") > 10, "2024-02-01").otherwise("2024-01-01")).alias("last_update_timestamp"))
    said = p.where("p_partkey % 3 = 0").select(F.concat(F.lit("part/"), F.col("p_partkey").cast("string")).alias("subject_id"), F.concat(F.lit("a fine "), "p_brand").alias("sentence"))
    return vectors.to_embed(n, ["StatisticalVariable"], dt.datetime(2024, 1, 15), said)


@query("embed", "select 'part/' || p_partkey as subject_id, length(regexp_replace(p_name, '[^A-Za-z]', '', 'g'))::double as letters, length(p_name)::double as size from part")
def embed(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = star.table(spark, sf_dir, "part").select(F.concat(F.lit("part/"), F.col("p_partkey").cast("string")).alias("subject_id"), F.col("p_name").alias("text"))
    return vectors.embed(p, _word_lengths).select("subject_id", F.col("embedding")[0].alias("letters"), F.col("embedding")[2].alias("size"))
