"""Queries of the checks of series and nodes, with their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from statloom.operators import checks
from statloom.operators.places import COLUMNS
from statloom.plans.catalogue import LONG, L
from statloom.plans.graph_queries import REF, TEXT, _key, _pv, _v
from statloom.plans.registry import query
from statloom.sources import star


def raw_points(df: DataFrame, entity: Column, date: Column, value: Column, method: Column, variable: str = "V") -> DataFrame:
    """A point for each row, unlike ``star.points``."""
    none = F.lit(None).cast("string")
    fixed = {"variable": F.lit(variable), "extra": F.lit(""), "period": F.lit("P1M"), "unit": none, "scaling": none, "provenance": F.lit("raw"), "is_aggregate": F.lit(False)}
    return df.select(entity.alias("entity"), date.alias("date"), value.cast("double").alias("value"), method.alias("method")).withColumns(fixed).select(COLUMNS)


def _orders(spark: SparkSession, sf_dir: str, date: Column | None = None) -> DataFrame:
    month = F.date_format("o_orderdate", "yyyy-MM")
    return raw_points(star.table(spark, sf_dir, "orders"), F.concat(F.lit("customer/"), (F.col("o_custkey") % 50).cast("string")), month if date is None else date, F.col("o_totalprice"), F.col("o_orderstatus"))


_O = "select 'customer/' || (o_custkey % 50) as entity, strftime(o_orderdate, '%Y-%m') as date, o_totalprice as value, o_orderstatus as method, o_orderkey as k from orders"


@query("check_inconsistent", f"select entity, method, date, count(distinct value) as n_values from ({_O}) group by all having count(distinct value) > 1")
def check_inconsistent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.inconsistent_values(_orders(spark, sf_dir)).select("entity", "method", "date", "n_values")


@query("check_types", f"select entity, 'NUMBER,TEXT' as types from (select entity, case when k % 101 = 0 then 'n/a' else value::varchar end as v from ({_O})) group by entity having count(*) filter (v = 'n/a') between 1 and count(*) - 1")
def check_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = star.table(spark, sf_dir, "orders").select(F.concat(F.lit("customer/"), (F.col("o_custkey") % 50).cast("string")).alias("entity"), F.when(F.col("o_orderkey") % 101 == 0, "n/a").otherwise(F.col("o_totalprice").cast("string")).alias("value"))
    return checks.mixed_types(o, ["entity"]).select("entity", F.array_join("types", ",").alias("types"))


@query("check_sigma", f"""with l as ({L}), s as (select *, avg(n) over w as m, stddev_pop(n) over w as sd, count(*) over w as c from l window w as (partition by entity, method))
select entity, method, date, n as value from s where c >= 2 and sd > 0 and abs(n - m) > 2 * sd + 1e-9""")
def check_sigma(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = star.line_points(spark, sf_dir).where("variable = 'Count_LineItem'")
    return checks.beyond_sigma(p, 2.0).where(F.abs(F.col("value") - F.col("mean")) > 2 * F.col("sd") + 1e-9).select("entity", "method", "date", "value")


@query("check_percent", f"""with l as ({L}), d as (select entity, method, date, round(abs(n - lag(n) over w) / lag(n) over w, 6) as change from l window w as (partition by entity, method order by date)),
  f as (select * from d where change is not null qualify row_number() over (partition by entity, method order by change desc, date) = 1)
select entity, method, date, change, case when change > 5 then 'ALARM' when change > 1 then 'WARNING' else 'FINE' end as level from f""")
def check_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.largest_change(star.line_points(spark, sf_dir).where("variable = 'Count_LineItem'")).select("entity", "method", "date", "change", "level")


@query("check_holes", f"""with l as ({L}), m as (select entity, method, date, date[1:4]::int * 12 + date[6:7]::int as i from l), g as (select *, i - lag(i) over w as gap from m window w as (partition by entity, method order by date)),
  h as (select *, lag(gap) over (partition by entity, method order by date) as gap_before from g) select entity, method, date, gap, gap_before from h where gap <> gap_before""")
def check_holes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.holes(star.line_points(spark, sf_dir).where("variable = 'Count_LineItem'")).select("entity", "method", "date", "gap", "gap_before")


@query("check_granularity", f"""with o as (select entity, method, case when k % 3 = 0 then date[1:4] else date end as date from ({_O})), n as (select entity, method, length(date)::int as length, count(*) as n from o group by all)
select entity, method, length, n from n qualify row_number() over (partition by entity, method order by n desc, length desc) > 1""")
def check_granularity(spark: SparkSession, sf_dir: str) -> DataFrame:
    month = F.date_format("o_orderdate", "yyyy-MM")
    date = F.when(F.col("o_orderkey") % 3 == 0, F.substring(month, 1, 4)).otherwise(month)
    return checks.mixed_granularity(_orders(spark, sf_dir, date)).select("entity", "method", "length", "n")


@query("check_dates", f"select entity, method, '2020-13' as date, value from ({_O}) where k % 17 = 0")
def check_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    date = F.when(F.col("o_orderkey") % 17 == 0, "2020-13").otherwise(F.date_format("o_orderdate", "yyyy-MM"))
    return checks.invalid_dates(_orders(spark, sf_dir, date)).select("entity", "method", "date", "value")


@query("check_duplicates", "select o_orderkey as key, 2::bigint as n_values from orders where o_orderkey % 11 = 0")
def check_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order comes twice; those divisible by eleven with another value, the others with one beyond 32 bits."""
    o = star.table(spark, sf_dir, "orders")
    v = F.col("o_totalprice")
    again = o.select(F.col("o_orderkey").alias("key"), F.when(F.col("o_orderkey") % 11 == 0, v + 10).otherwise(v * (1 + 1e-12)).cast("string").alias("value"))
    return checks.duplicates(o.select(F.col("o_orderkey").alias("key"), v.cast("string").alias("value")).unionByName(again), ["key"]).select("key", "n_values")


def _bad_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, k = star.table(spark, sf_dir, "customer"), F.col("c_custkey") % 10
    return _pv(
        c, _key("c", "c_custkey"), F.when(k != 0, _v("typeOf", REF, "Customer")), _v("dcid", TEXT, F.when(k == 1, F.lit("a b")).otherwise(_key("c", "c_custkey"))), F.when(k == 2, _v("dcid", TEXT, "second", 1)), F.when(k == 3, _v("BadCase", TEXT, "x")), F.when(k == 4, _v("link", REF, "é")),
        F.when(k == 5, _v("containedInPlace", TEXT, "text")), F.when(k == 6, F.struct(F.lit("open").alias("prop"), F.lit(0).alias("pos"), F.lit("ERROR").alias("type"), F.lit(None).cast("string").alias("value"))), F.when(k == 7, _v("dcid", TEXT, F.repeat(F.lit("y"), 300), 1)),
    ).unionByName(_pv(c, _key("o", "c_custkey"), _v("typeOf", REF, "StatVarObservation"), _v("variableMeasured", REF, "V"), F.when(k != 1, _v("observationAbout", REF, "p")), _v("observationDate", TEXT, F.when(k == 2, F.lit("soon")).otherwise(F.lit("2020"))), _v("value", "NUMBER", "1"), F.when(k == 3, _v("value", "NUMBER", "2", 1))))


_BAD = """select 'c' || c_custkey as node_id, u.c as counter from customer, unnest([{k: 0, c: 'Sanity_MissingTypeOf'}, {k: 1, c: 'Sanity_InvalidDcid'}, {k: 2, c: 'Sanity_MultipleDcid'}, {k: 3, c: 'Sanity_PropertyCase'}, {k: 4, c: 'Sanity_NonAsciiReference'}, {k: 5, c: 'Sanity_ReferenceType'},
  {k: 6, c: 'Sanity_Unparsed'}, {k: 7, c: 'Sanity_MultipleDcid'}, {k: 7, c: 'Sanity_LongDcid'}]) t(u) where c_custkey % 10 = u.k
union all select 'o' || c_custkey, u.c from customer, unnest([{k: 1, c: 'Sanity_ObservationAbout'}, {k: 2, c: 'Sanity_ObservationDate'}, {k: 3, c: 'Sanity_ObservationValue'}]) t(u) where c_custkey % 10 = u.k"""


@query("check_nodes", _BAD)
def check_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.node_errors(_bad_nodes(spark, sf_dir))


@query("counters", f"select counter, count(*) as n, list_aggregate(list_slice(list_sort(list(node_id)), 1, 30), 'string_agg', ',') as examples from ({_BAD}) group by counter")
def counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.counters(check_nodes(spark, sf_dir)).select("counter", "n", F.array_join("examples", ",").alias("examples"))


@query("check_references", "select 'customer/' || c_custkey as node_id, 'containedInPlace' as prop, 'nation/' || c_nationkey as value from customer where c_nationkey >= 20")
def check_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    pv = _pv(star.table(spark, sf_dir, "customer"), _key("customer/", "c_custkey"), _v("typeOf", REF, "customer/1"), _v("containedInPlace", REF, _key("nation/", "c_nationkey")))
    known = star.table(spark, sf_dir, "nation").where("n_nationkey < 20").select(_key("nation/", "n_nationkey").alias("subject_id"))
    return checks.missing_references(pv, known).select("node_id", "prop", "value")


@query("check_sv_state", "with p as (select distinct p_brand as a, (p_size % 20)::varchar as b from part), x as (select a as id, count(distinct b) as n from p group by a union all select b, count(distinct a) from p group by b) select id, n from x where n > 1")
def check_sv_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.curated_conflicts(star.table(spark, sf_dir, "part").select(F.col("p_brand").alias("curated"), (F.col("p_size") % 20).cast("string").alias("generated")))


@query("sv_summary_stats", f"with l as ({LONG}) select variable, count(*) as n_points, round(min(value), 4) as min_value, round(max(value), 4) as max_value, count(distinct entity) as n_places, count(distinct date) as n_dates, string_agg(distinct method, ',' order by method) as methods, 'P1M' as periods from l group by variable")
def sv_summary_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from statloom.plans.registry import NUDGE

    s = checks.variable_summary(star.line_points(spark, sf_dir))
    return s.select("variable", "n_points", F.round(F.col("min_value") + NUDGE, 4).alias("min_value"), F.round(F.col("max_value") + NUDGE, 4).alias("max_value"), "n_places", "n_dates", F.array_join("methods", ",").alias("methods"), F.array_join("periods", ",").alias("periods"))


@query("sample_places", """with p as (select distinct 'geoId/' || c_custkey as entity, 'geoId' as namespace from customer union select 'supplier/' || s_suppkey, 'supplier' from supplier)
select namespace, entity from p qualify row_number() over (partition by namespace, case when namespace = 'geoId' then length(entity) else 0 end order by entity) <= case when namespace = 'geoId' then 5 else 25 end""")
def sample_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = star.table(spark, sf_dir, "customer").select(_key("geoId/", "c_custkey").alias("entity"))
    return checks.sample_places(c.unionByName(star.table(spark, sf_dir, "supplier").select(_key("supplier/", "s_suppkey").alias("entity"))))


@query("place_series", f"with l as ({L}) select entity, method, string_agg(date || '=' || n::bigint, ',' order by date) as points from l group by all")
def place_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = checks.place_series(star.line_points(spark, sf_dir).where("variable = 'Count_LineItem'"))
    return s.select("entity", "method", F.array_join(F.transform("points", lambda p: F.concat(p["date"], F.lit("="), p["value"].cast("bigint").cast("string"))), ",").alias("points"))
