"""Queries of graph construction, differences, node text, mutation and resolution, with their SQL.

Nations and customers are nodes, orders and events observations, given as parsed nodes (``MCF_PV``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from statloom.operators import construct, diff, nodes
from statloom.plans.registry import query
from statloom.sources import mcf, star

_X = "struct<prop:string,pos:int,type:string,value:string>"


def _v(prop: str, kind: str, value: Column | str, pos: int = 0) -> Column:
    value = F.lit(value) if isinstance(value, str) else value.cast("string")
    return F.struct(F.lit(prop).alias("prop"), F.lit(pos).alias("pos"), F.lit(kind).alias("type"), value.alias("value"))


def _pv(df: DataFrame, node: Column, *facts: Column) -> DataFrame:
    return df.select(node.alias("node_id"), F.explode(F.array_compact(F.array(*facts))).alias("x")).select("node_id", "x.*")


def _key(kind: str, column: str) -> Column:
    return F.concat(F.lit(kind), F.col(column).cast("string"))


def _money(column: str) -> Column:
    return F.format_string("%.2f", F.col(column))


REF, TEXT, NUMBER = "RESOLVED_REF", "TEXT", "NUMBER"


def schema_pv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations by local ids with a dcid, customers by their dcids."""
    n = _pv(star.table(spark, sf_dir, "nation"), _key("l:n", "n_nationkey"), _v("dcid", TEXT, _key("nation/", "n_nationkey")), _v("typeOf", REF, "Nation"), _v("name", TEXT, F.col("n_name")), _v("containedInPlace", REF, _key("dcid:region/", "n_regionkey")))
    c = _pv(star.table(spark, sf_dir, "customer"), _key("dcid:customer/", "c_custkey"), _v("typeOf", REF, "Customer"), _v("name", TEXT, F.col("c_name")), _v("balance", NUMBER, _money("c_acctbal")), _v("containedInPlace", REF, _key("nation/", "c_nationkey")))
    return n.unionByName(c)


def order_pv(spark: SparkSession, sf_dir: str, value: Column | None = None, where: str = "true") -> DataFrame:
    o = star.table(spark, sf_dir, "orders").where(where)
    aggregate = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("dcAggregate/"), "o_orderpriority")).otherwise(F.col("o_orderpriority"))
    return _pv(
        o, _key("l:o", "o_orderkey"), _v("typeOf", REF, "StatVarObservation"), _v("variableMeasured", REF, _key("Amount_", "o_orderstatus")), _v("observationAbout", REF, _key("customer/", "o_custkey")),
        _v("observationDate", TEXT, F.date_format("o_orderdate", "yyyy-MM-dd")), _v("value", NUMBER, _money("o_totalprice") if value is None else value), _v("measurementMethod", REF, aggregate), _v("observationPeriod", TEXT, F.concat(F.lit("P"), "o_orderkey", F.lit("D"))),
    )


_NODES = """select 'nation/' || n_nationkey as s, 'Nation' as t, n_name as name, 'region/' || n_regionkey as up, null as balance from nation
  union all select 'customer/' || c_custkey, 'Customer', c_name, 'nation/' || c_nationkey, printf('%.2f', c_acctbal) from customer"""
_LITERAL = "left(@, 16) || ':' || to_base64(unhex(sha256(@)))"


def lit(x: str) -> str:
    return _LITERAL.replace("@", x)


@query("graph_to_nodes", f"""with n as ({_NODES}), l as (select name as v from n union select balance from n where balance is not null)
select s as subject_id, s as value, name, t as types from n union all select {lit("v")}, v, null, null from l""")
def graph_to_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = construct.graph_to_nodes(construct.gathered(schema_pv(spark, sf_dir)))
    return got.select("subject_id", "value", "name", F.array_join("types", ",").alias("types"))


@query("graph_to_edges", f"""with n as ({_NODES})
select s as subject_id, 'typeOf' as predicate, t as object_id, 'dc/base/star' as provenance from n union all select s, 'containedInPlace', up, 'dc/base/star' from n
union all select s, 'name', {lit("name")}, 'dc/base/star' from n union all select s, 'balance', {lit("balance")}, 'dc/base/star' from n where balance is not null""")
def graph_to_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return construct.graph_to_edges(construct.gathered(schema_pv(spark, sf_dir)), "dc/base/star")


_ORDER = "select 'Amount_' || o_orderstatus as variable_measured, 'customer/' || o_custkey as entity1, strftime(o_orderdate, '%Y-%m-%d') as date, printf('%.2f', o_totalprice) as value, o_orderpriority as method, 'P' || o_orderkey || 'D' as period, o_orderkey % 3 = 0 as is_aggregate from orders"


@query("graph_to_observations", f"select variable_measured, entity1, '' as extra_entities_id, date, value, method, period, '' as unit, '' as scaling, is_aggregate from ({_ORDER})")
def graph_to_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return construct.observations(construct.gathered(order_pv(spark, sf_dir)), "orders").drop("facet_id", "provenance_url")


@query("graph_to_series", f"""select distinct variable_measured, entity1, '' as extra_entities_id, '{{"entity1":"' || entity1 || '"}}' as entities,
  '{{"measurementMethod":"' || method || '","observationPeriod":"' || period || '","provenance":"dc/base/orders","isDcAggregate":' || is_aggregate || '}}' as facet from ({_ORDER})""")
def graph_to_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return construct.time_series(construct.observations(construct.gathered(order_pv(spark, sf_dir)), "orders"), "dc/base/orders").drop("facet_id")


@query("graph_several_entities", "select 'kind/' || event_type as entity1, 'user/' || user_id || '^day/' || strftime(ts, '%d') as extra_entities_id, strftime(ts, '%Y-%m-%d') as date, event_id::varchar as value from events")
def graph_several_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities by observationProperties, in order of property: aKind, bUser, cDay."""
    e = star.table(spark, sf_dir, "events")
    pv = _pv(
        e, _key("l:e", "event_id"), _v("typeOf", REF, "StatVarObservation"), _v("variableMeasured", REF, "Event"), _v("observationProperties", REF, "bUser"), _v("observationProperties", REF, "cDay", 1), _v("observationProperties", REF, "aKind", 2),
        _v("aKind", REF, _key("kind/", "event_type")), _v("bUser", REF, _key("user/", "user_id")), _v("cDay", REF, F.concat(F.lit("day/"), F.date_format("ts", "dd"))), _v("observationDate", TEXT, F.date_format("ts", "yyyy-MM-dd")), _v("value", NUMBER, F.col("event_id")),
    )
    return construct.observations(construct.gathered(pv), "events").select("entity1", "extra_entities_id", "date", "value")


@query("optimised_series", f"select variable_measured, entity1, method, date, case when value::double = floor(value::double) then value::double::bigint::varchar else value::double::varchar end as value from ({_ORDER})")
def optimised_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations folded to series and unfolded again."""
    series = construct.optimised_series(construct.observations(construct.gathered(order_pv(spark, sf_dir)), "orders"))
    return construct.flatten_series(series).select("variable_measured", "entity1", "method", "date", "value")


@query("combine_nodes", f"""with n as ({_NODES}), p as (
  select s as node_id, 'typeOf' as prop, t as value from n union all select s, 'name', name from n union all select s, 'name', 'Also ' || name from n where t = 'Customer'
  union all select s, 'containedInPlace', up from n union all select s, 'balance', balance from n where balance is not null union all select s, 'dcid', s from n where t = 'Nation')
select node_id, prop, (row_number() over (partition by node_id, prop order by value) - 1)::int as pos, value from p""")
def combine_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers come twice, the second time as places, with prefixes and another name."""
    c = star.table(spark, sf_dir, "customer")
    again = _pv(c, _key("customer/", "c_custkey"), _v("typeOf", REF, "Place"), _v("typeOf", REF, "dcs:Customer", 1), _v("name", TEXT, F.concat(F.lit("Also "), "c_name")), _v("containedInPlace", REF, _key("dcid:nation/", "c_nationkey")))
    got = construct.combine_nodes(schema_pv(spark, sf_dir).unionByName(again))
    return got.select("node_id", "prop", "pos", F.regexp_replace("value", "^(dcid|dcs):", "").alias("value"))


# differences
_CUR = f"select variable_measured || ';' || entity1 || ';' || date || ';' || period || ';' || (case when is_aggregate then 'dcAggregate/' else '' end) || method || ';;' as key, k, value from (select *, regexp_extract(period, '[0-9]+')::bigint as k from ({_ORDER}))"


@query("diff_observations", f"""with c as ({_CUR}), cur as (select key, value from c where k % 7 <> 0), prev as (select key, case when k % 11 = 0 then '0.00' else value end as value from c where k % 5 <> 0)
select key, coalesce(cur.value, '') as current, coalesce(prev.value, '') as previous, case when cur.value is null then 'DELETED' when prev.value is null then 'ADDED' else 'MODIFIED' end as diff_type
from cur full join prev using (key) where cur.value is distinct from prev.value""")
def diff_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = order_pv(spark, sf_dir, where="o_orderkey % 7 <> 0")
    before = order_pv(spark, sf_dir, F.when(F.col("o_orderkey") % 11 == 0, "0.00").otherwise(_money("o_totalprice")), "o_orderkey % 5 <> 0")
    return diff.changes(diff.observation_pairs(now), diff.observation_pairs(before))


@query("diff_schema", """with c as (select 'dcid:customer/' || c_custkey as key, c_custkey as k, 'balance:' || printf('%.2f', c_acctbal) || ';containedInPlace:nation/' || c_nationkey || ';name:' || c_name || ';typeOf:Customer' as value,
  'balance:' || printf('%.2f', c_acctbal) || ';containedInPlace:nation/' || c_nationkey || ';name:"' || c_name || ', old";typeOf:Customer' as old from customer)
select key, value as current, case when k % 4 = 0 then '' else old end as previous, case when k % 4 = 0 then 'ADDED' else 'MODIFIED' end as diff_type from c where k % 4 = 0 or k % 4 = 1""")
def diff_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = star.table(spark, sf_dir, "customer")

    def version(df: DataFrame, name: Column) -> DataFrame:
        return _pv(df, _key("dcid:customer/", "c_custkey"), _v("dcid", TEXT, F.col("c_custkey")), _v("typeOf", REF, "Customer"), _v("name", TEXT, name), _v("balance", NUMBER, _money("c_acctbal")), _v("containedInPlace", REF, _key("nation/", "c_nationkey")))

    old = F.when(F.col("c_custkey") % 4 == 1, F.concat("c_name", F.lit(", old"))).otherwise(F.col("c_name"))
    return diff.changes(diff.schema_pairs(version(c, F.col("c_name"))), diff.schema_pairs(version(c.where("c_custkey % 4 <> 0"), old)))


# node text
def _blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = star.table(spark, sf_dir, "customer")
    lines = [F.concat(F.lit("Node: dcid:customer/"), "c_custkey"), F.lit("typeOf: dcs:Customer"), F.concat(F.lit('name: "'), "c_name", F.lit(', Ltd"')), F.concat(F.lit("balance: "), _money("c_acctbal")), F.concat(F.lit("containedInPlace: dcid:nation/"), "c_nationkey", F.lit(", l:x")), F.lit("age: [Years 18 -]"), F.lit("// a note")]
    return c.select(F.concat_ws("\n", *lines).alias("value"))


_MCF = """select 'customer/' || c_custkey as node_id, u.prop, u.pos::int as pos, u.type, u.value from customer, unnest([
  {prop: 'typeOf', pos: 0, type: 'RESOLVED_REF', value: 'Customer'}, {prop: 'name', pos: 0, type: 'TEXT', value: c_name || ', Ltd'}, {prop: 'balance', pos: 0, type: 'NUMBER', value: printf('%.2f', c_acctbal)},
  {prop: 'containedInPlace', pos: 0, type: 'RESOLVED_REF', value: 'nation/' || c_nationkey}, {prop: 'containedInPlace', pos: 1, type: 'UNRESOLVED_REF', value: 'l:x'}, {prop: 'age', pos: 0, type: 'COMPLEX_VALUE', value: '[Years 18 -]'}]) t(u)"""


@query("mcf_parse", _MCF)
def mcf_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mcf.parse_text(_blocks(spark, sf_dir), resolved=False)


@query("mcf_serialise", """select 'customer/' || c_custkey as node_id, 'Node: dcid:customer/' || c_custkey || chr(10) || 'age: [Years 18 -]' || chr(10) || 'balance: ' || printf('%.2f', c_acctbal) || chr(10) ||
  'containedInPlace: dcid:nation/' || c_nationkey || ', l:x' || chr(10) || 'name: "' || c_name || ', Ltd"' || chr(10) || 'typeOf: dcid:Customer' as text from customer""")
def mcf_serialise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mcf.to_mcf(mcf_parse(spark, sf_dir))


@query("mcf_triples", f"select node_id as subject_id, prop as predicate, case when type in ('RESOLVED_REF', 'UNRESOLVED_REF') then value else '' end as object_id, case when type in ('RESOLVED_REF', 'UNRESOLVED_REF') then '' else value end as object_value from ({_MCF})")
def mcf_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mcf.to_triples(mcf_parse(spark, sf_dir))


@query("tmcf_expand", """select u.node_id, u.prop, u.type, u.value from customer, unnest([
  {node_id: 'customer/' || c_custkey, prop: 'typeOf', type: 'RESOLVED_REF', value: 'Customer'}, {node_id: 'customer/' || c_custkey, prop: 'dcid', type: 'TEXT', value: 'customer/' || c_custkey},
  {node_id: 'customer/' || c_custkey, prop: 'label', type: 'TEXT', value: c_name}, {node_id: 'l:o' || c_custkey, prop: 'typeOf', type: 'RESOLVED_REF', value: 'StatVarObservation'}, {node_id: 'l:o' || c_custkey, prop: 'observationAbout', type: 'RESOLVED_REF', value: 'customer/' || c_custkey},
  {node_id: 'l:o' || c_custkey, prop: 'variableMeasured', type: 'RESOLVED_REF', value: 'Balance'}, {node_id: 'l:o' || c_custkey, prop: 'value', type: 'NUMBER', value: printf('%.2f', c_acctbal)}]) t(u)""")
def tmcf_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    template = mcf.parse_template("Node: E:c->E0\ntypeOf: dcs:Customer\ndcid: C:c->id\nlabel: C:c->c_name\nNode: E:c->E1\ntypeOf: dcs:StatVarObservation\nobservationAbout: E:c->E0\nvariableMeasured: Balance\nvalue: C:c->balance")
    table = star.table(spark, sf_dir, "customer").select(_key("customer/", "c_custkey").alias("id"), "c_name", _money("c_acctbal").alias("balance"), "c_custkey")
    got = mcf.expand_template(table, template, "c")
    # local ids number the rows of the file; the row's customer is named here instead, from the reference beside it
    about = got.where("prop = 'observationAbout'").select("node_id", F.concat(F.lit("l:o"), F.regexp_extract("value", r"(\d+)$", 1)).alias("shown"))
    return got.join(about, "node_id", "left").select(F.coalesce("shown", "node_id").alias("node_id"), "prop", "type", "value")


@query("jsonld_parse", """select 'nation/' || n_nationkey as node_id, u.prop, u.type, u.value from nation, unnest([{prop: 'typeOf', type: 'RESOLVED_REF', value: 'Nation'}, {prop: 'name', type: 'TEXT', value: n_name},
  {prop: 'containedInPlace', type: 'RESOLVED_REF', value: 'region/' || n_regionkey}, {prop: 'rank', type: 'NUMBER', value: n_nationkey::varchar}, {prop: 'part', type: 'RESOLVED_REF', value: 'part/' || n_nationkey}]) t(u)
  union all select 'part/' || n_nationkey, 'typeOf', 'RESOLVED_REF', 'Piece' from nation""")
def jsonld_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document a nation: prefixes of the context, a term that is a reference, and a node within a node."""
    n = star.table(spark, sf_dir, "nation")
    context = '{"@context": {"dcid": "https://x.example/browser/", "up": {"@id": "dcid:containedInPlace", "@type": "@id"}}, "@graph": [{'
    parts = [F.lit(context + '"@id": "dcid:nation/'), F.col("n_nationkey"), F.lit('", "@type": "dcid:Nation", "dcid:name": {"@value": "'), F.col("n_name"), F.lit('"}, "up": "dcid:region/'), F.col("n_regionkey"), F.lit('", "dcid:rank": '), F.col("n_nationkey"), F.lit(', "dcid:part": {"@id": "dcid:part/'), F.col("n_nationkey"), F.lit('", "@type": "dcid:Piece"}}]}')]
    return mcf.parse_jsonld(n.select(F.concat(*[p.cast("string") for p in parts]).alias("value"))).select("node_id", "prop", "type", "value")


# mutation, names and ids
def _sv_pv(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = star.table(spark, sf_dir, "part").select("p_brand", "p_size").distinct()
    brand = F.regexp_replace("p_brand", "[^A-Za-z0-9]", "")
    return _pv(
        p, F.concat(F.lit("Count_"), brand, F.lit("_"), "p_size"), _v("typeOf", REF, "StatisticalVariable"), _v("populationType", REF, "Part"), _v("measuredProperty", REF, "count"), _v("statType", REF, "medianValue"), _v("measurementQualifier", REF, "Annual"), _v("measurementDenominator", REF, "Count_Part"),
        _v("brand", REF, brand), _v("size", "COMPLEX_VALUE", F.concat(F.lit("[Inch "), "p_size", F.lit(" -]"))),
    )


_PART = "select distinct regexp_replace(p_brand, '[^A-Za-z0-9]', '', 'g') as b, p_size as z from part"
_SPACED = "regexp_replace(b, '([a-z])([0-9])', '\\1 \\2')"


@query("mutate", f"""with v as ({_PART}), s as (select distinct z from v)
select 'Count_' || b || '_' || z as node_id, u.prop, u.pos::int as pos, u.type, u.value from v, unnest([
  {{prop: 'typeOf', pos: 0, type: 'RESOLVED_REF', value: 'StatisticalVariable'}}, {{prop: 'populationType', pos: 0, type: 'RESOLVED_REF', value: 'Part'}}, {{prop: 'measuredProperty', pos: 0, type: 'RESOLVED_REF', value: 'count'}},
  {{prop: 'statType', pos: 0, type: 'RESOLVED_REF', value: 'medianValue'}}, {{prop: 'measurementQualifier', pos: 0, type: 'RESOLVED_REF', value: 'Annual'}}, {{prop: 'measurementDenominator', pos: 0, type: 'RESOLVED_REF', value: 'Count_Part'}},
  {{prop: 'brand', pos: 0, type: 'RESOLVED_REF', value: b}}, {{prop: 'size', pos: 0, type: 'RESOLVED_REF', value: 'Inch' || z || 'Onwards'}},
  {{prop: 'constraintProperties', pos: 0, type: 'RESOLVED_REF', value: 'brand'}}, {{prop: 'constraintProperties', pos: 1, type: 'RESOLVED_REF', value: 'size'}},
  {{prop: 'definition', pos: 0, type: 'TEXT', value: 'md=Count_Part,mq=Annual,st=medianValue,mp=count,pt=Part,brand=' || b || ',size=Inch' || z || 'Onwards'}},
  {{prop: 'name', pos: 0, type: 'TEXT', value: 'Median Annual Count of Part: ' || {_SPACED} || ', Inch ' || z || ' Onwards (As fraction of Count Part)'}}]) t(u)
union all select 'Inch' || z || 'Onwards', u.prop, 0, u.type, u.value from s, unnest([{{prop: 'dcid', type: 'TEXT', value: 'Inch' || z || 'Onwards'}}, {{prop: 'name', type: 'TEXT', value: 'Inch ' || z || ' Onwards'}},
  {{prop: 'typeOf', type: 'RESOLVED_REF', value: 'QuantityRange'}}, {{prop: 'startValue', type: 'NUMBER', value: z::varchar}}, {{prop: 'endValue', type: 'TEXT', value: '-'}}, {{prop: 'unit', type: 'RESOLVED_REF', value: 'Inch'}}]) t(u)""")
def mutate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nodes.mutate(_sv_pv(spark, sf_dir))


@query("complex_values", """with p as (select distinct p_size as z, (p_partkey % 90)::int as k from part)
select '[Inch ' || z || ' ' || (z + 1) || ']' as value, 'Inch' || z || 'To' || (z + 1) as id, 'Inch ' || z || ' To ' || (z + 1) as name, 'QuantityRange' as kind from p
union all select '[' || z || ' dcs:Inch]', 'Inch' || z, 'Inch ' || z, 'Quantity' from p union all select '[- ' || z || ' Inch]', 'InchUpto' || z, 'Inch UpTo ' || z, 'QuantityRange' from p
union all select '[LatLong ' || k || '.5S ' || k || '.25E]', 'latLong/-' || k || '50000_' || k || '25000', '-' || k || '.50000,' || k || '.25000', 'GeoCoordinates' from p where k > 0
union all select '[Inch x]', null, null, null from p""")
def complex_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = star.table(spark, sf_dir, "part").select(F.col("p_size").alias("z"), (F.col("p_partkey") % 90).cast("int").alias("k")).distinct()
    z, k, cat = F.col("z"), F.col("k"), lambda *x: F.concat(*[F.lit(y) if isinstance(y, str) else y.cast("string") for y in x])
    forms = F.array(cat("[Inch ", z, " ", z + 1, "]"), cat("[", z, " dcs:Inch]"), cat("[- ", z, " Inch]"), F.when(k > 0, cat("[LatLong ", k, ".5S ", k, ".25E]")), F.lit("[Inch x]"))
    return p.select(F.explode(F.array_compact(forms)).alias("value")).withColumn("c", nodes.complex_value(F.col("value"))).select("value", "c.id", "c.name", "c.kind")


@query("id_keys", f"""select 'v' as kind, 'Count_' || b || '_' || z as node_id, 'brand=' || b || 'measuredProperty=countmeasurementDenominator=Count_PartmeasurementQualifier=AnnualpopulationType=Partsize=Inch' || z || 'OnwardsstatType=medianValuetypeOf=StatisticalVariable' as key_text from ({_PART})
union all select 'o', 'l:o' || o_orderkey, 'observationAbout=customer/' || o_custkey || 'variableMeasured=Amount_' || o_orderstatus || 'observationDate=' || strftime(o_orderdate, '%Y-%m-%d') || 'value=' || printf('%.2f', o_totalprice) || 'observationPeriod=P' || o_orderkey || 'DmeasurementMethod=' ||
  (case when o_orderkey % 3 = 0 then 'dcAggregate/' else '' end) || o_orderpriority from orders
union all select 'p', 'l:p' || c_custkey, 'Personcustomer/' || c_custkey || 'segment' || c_mktsegment from customer
union all select 'b', 'l:b' || c_custkey, 'observedNode=l:p' || c_custkey || 'observationDate=2020measuredProperty=countmeasuredValue=' || c_custkey from customer""")
def id_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the ids of variables, observations, populations and their old observations are made from."""
    c = star.table(spark, sf_dir, "customer")
    p = _pv(c, _key("l:p", "c_custkey"), _v("typeOf", REF, "StatisticalPopulation"), _v("populationType", REF, "Person"), _v("location", REF, _key("customer/", "c_custkey")), _v("segment", REF, F.col("c_mktsegment")), _v("other", REF, "x"), _v("constraintProperties", REF, "segment"))
    b = _pv(c, _key("l:b", "c_custkey"), _v("typeOf", REF, "Observation"), _v("observedNode", "UNRESOLVED_REF", _key("l:p", "c_custkey")), _v("observationDate", TEXT, "2020"), _v("measuredProperty", REF, "count"), _v("measuredValue", NUMBER, F.col("c_custkey")))
    every = _sv_pv(spark, sf_dir).unionByName(order_pv(spark, sf_dir)).unionByName(p).unionByName(b)
    keyed = nodes.keyed(every)
    short = F.element_at(F.create_map(*[F.lit(x) for x in ("VARIABLE", "v", "OBSERVATION", "o", "POPULATION", "p", "OLD_OBSERVATION", "b")]), F.col("kind"))
    return keyed.select(short.alias("kind"), "node_id", "key_text")


@query("place_ids", "select 'l:c' || c_custkey as node_id, case when c_custkey % 3 = 0 then 'geoId/g' || c_custkey when c_custkey % 3 = 1 then 'iso/i' || c_custkey else 'wikidataId/Q' || c_custkey end as dcid from customer")
def place_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, k = star.table(spark, sf_dir, "customer"), F.col("c_custkey") % 3
    pv = _pv(c, _key("l:c", "c_custkey"), _v("typeOf", REF, "City"), F.when(k == 0, _v("geoId", TEXT, _key("g", "c_custkey"))), F.when(k == 1, _v("isoCode", TEXT, _key("i", "c_custkey"))), _v("wikidataId", TEXT, _key("Q", "c_custkey")))
    return nodes.keyed(pv).select("node_id", "dcid")


def _local_pv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations with a dcid, customers as cities by their geoId that refer to them, observations about customers; every
    tenth observation is about nobody, and every seventh customer has no id, so its observations fail too."""
    n = _pv(star.table(spark, sf_dir, "nation"), _key("l:n", "n_nationkey"), _v("typeOf", REF, "Country"), _v("dcid", TEXT, _key("country/", "n_nationkey")))
    cust = star.table(spark, sf_dir, "customer")
    c = _pv(cust, _key("l:c", "c_custkey"), _v("typeOf", REF, "City"), F.when(F.col("c_custkey") % 7 != 0, _v("geoId", TEXT, F.col("c_custkey"))), _v("containedInPlace", "UNRESOLVED_REF", _key("l:n", "c_nationkey")))
    about = F.when(F.col("c_custkey") % 10 == 0, F.lit("l:nobody")).otherwise(_key("l:c", "c_custkey"))
    o = _pv(cust, _key("l:o", "c_custkey"), _v("typeOf", REF, "StatVarObservation"), _v("variableMeasured", REF, "Balance"), _v("observationAbout", "UNRESOLVED_REF", about), _v("observationDate", TEXT, "2020"), _v("value", NUMBER, F.col("c_custkey")))
    return n.unionByName(c).unionByName(o)


@query("resolve_local", """select 'l:n' || n_nationkey as node_id, u.prop, u.value from nation, unnest([{prop: 'typeOf', value: 'Country'}, {prop: 'dcid', value: 'country/' || n_nationkey}]) t(u)
union all select 'l:c' || c_custkey, u.prop, u.value from customer, unnest([{prop: 'typeOf', value: 'City'}, {prop: 'geoId', value: c_custkey::varchar}, {prop: 'containedInPlace', value: 'country/' || c_nationkey}, {prop: 'dcid', value: 'geoId/' || c_custkey}]) t(u) where c_custkey % 7 <> 0
union all select 'l:o' || c_custkey, u.prop, u.value from customer, unnest([{prop: 'typeOf', value: 'StatVarObservation'}, {prop: 'variableMeasured', value: 'Balance'}, {prop: 'observationAbout', value: 'geoId/' || c_custkey}, {prop: 'observationDate', value: '2020'}, {prop: 'value', value: c_custkey::varchar},
  {prop: 'dcid', value: 'dc/o/'}, {prop: 'keyString', value: 'observationAbout=geoId/' || c_custkey || 'variableMeasured=BalanceobservationDate=2020value=' || c_custkey}]) t(u) where c_custkey % 7 <> 0 and c_custkey % 10 <> 0""")
def resolve_local(spark: SparkSession, sf_dir: str) -> DataFrame:
    got, _ = nodes.resolve_local(_local_pv(spark, sf_dir))
    return got.select("node_id", "prop", F.when((F.col("prop") == "dcid") & F.col("value").startswith("dc/o/"), F.lit("dc/o/")).otherwise(F.col("value")).alias("value"))


@query("resolve_failed", """select 'l:c' || c_custkey as node_id, 'no id can be made' as error from customer where c_custkey % 7 = 0
union all select 'l:o' || c_custkey, 'no such node: l:nobody' from customer where c_custkey % 10 = 0 union all select 'l:o' || c_custkey, 'reference to a failed node: l:c' || c_custkey from customer where c_custkey % 7 = 0 and c_custkey % 10 <> 0""")
def resolve_failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nodes.resolve_local(_local_pv(spark, sf_dir))[1]


@query("resolve_external", """select 'l:c' || c_custkey as node_id, case when c_custkey % 5 <> 0 then 'place/' || c_custkey end as dcid, case when c_custkey % 5 = 0 then 'diverging ids' end as error from customer where c_custkey % 2 = 0""")
def resolve_external(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even customers are known by geoId, those divisible by five under another place by wikidataId."""
    c, k = star.table(spark, sf_dir, "customer"), F.col("c_custkey")
    asked = _pv(c, _key("l:c", "c_custkey"), _v("typeOf", REF, "City"), _v("geoId", TEXT, k), _v("wikidataId", TEXT, _key("Q", "c_custkey")))
    known = _pv(c.where("c_custkey % 2 = 0"), _key("l:k", "c_custkey"), _v("dcid", TEXT, _key("place/", "c_custkey")), _v("geoId", TEXT, k)).unionByName(_pv(c.where("c_custkey % 10 = 0"), _key("l:w", "c_custkey"), _v("dcid", TEXT, _key("other/", "c_custkey")), _v("wikidataId", TEXT, _key("Q", "c_custkey"))))
    return nodes.external_ids(asked, nodes.local_mapping(known))
