"""Queries of the importers, writers' tables and state of imports, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from statloom.operators import importers
from statloom.plans import sinks, state
from statloom.plans.registry import query
from statloom.sources import star


def _s(c: str):
    return F.col(c).cast("string")


@query("wide_to_long", """select 'supplier/' || l_suppkey as entity, u.variable, strftime(l_shipdate, '%Y') as date, u.value, 'p1' as provenance, 'USD' as unit, '' as scaling_factor, '' as measurement_method, 'P1Y' as observation_period, '{"k":"v"}' as properties
from (select l_suppkey, l_shipdate, count(*) over (partition by l_suppkey, strftime(l_shipdate, '%Y')) as n, row_number() over (partition by l_suppkey, strftime(l_shipdate, '%Y')) as r from lineitem) l, unnest([{variable: 'Count_Item', value: n::varchar}, {variable: 'Big_Count', value: (n * 1000)::varchar}]) t(u) where r = 1 and (u.variable = 'Big_Count' or n % 3 <> 0)""")
def wide_to_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = star.table(spark, sf_dir, "lineitem").groupBy("l_suppkey", F.date_format("l_shipdate", "yyyy").alias("year")).agg(F.count("*").alias("n"))
    wide = n.select(F.concat(F.lit("dcid:supplier/"), _s("l_suppkey")).alias("place"), "year", F.when(F.col("n") % 3 == 0, "N/A").otherwise(_s("n")).alias("Count Item"), F.format_number(F.col("n") * 1000, 0).alias("Big-Count"), F.lit("x").alias("note"))
    return importers.wide_to_long(wide, "dcid:p1", ignored=["note"], props=importers.Properties("dcid:USD", observation_period="P1Y", custom={"k": "v"}))


@query("long_custom_dims", """select '' as entity, 'V_' || o_orderstatus as variable, strftime(o_orderdate, '%Y-%m-%d') as date, o_orderkey::varchar as value, 'p2' as provenance, case when o_orderkey % 4 = 0 then 'EUR' else 'USD' end as unit, '' as scaling_factor, 'm' as measurement_method, '' as observation_period,
  '{' || (case when o_orderkey % 5 = 0 then '' else '"customer":"c/' || o_custkey || '",' end) || '"priority":"' || o_orderpriority || '","static":"s"}' as properties from orders where o_orderkey % 6 <> 0""")
def long_custom_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = star.table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    long = o.select(
        F.concat(F.lit("dcid:V_"), "o_orderstatus").alias("var"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("when"), F.when(k % 6 == 0, "<NA>").otherwise(F.concat(_s("o_orderkey"), F.lit(".0"))).alias("val"), F.when(k % 4 == 0, "EUR").otherwise("").alias("u"),
        F.when(k % 5 == 0, F.lit(None)).otherwise(F.concat(F.lit("dcid:c/"), _s("o_custkey"))).alias("cust"), F.col("o_orderpriority").alias("prio"),
    )
    mapping = {"dcid:variableMeasured": "var", "dcid:observationDate": "when", "dcid:value": "val", "dcid:unit": "u", "customer": "cust", "priority": "prio"}
    return importers.long_observations(long, "p2", mapping | {}, importers.Properties("USD", measurement_method="m", custom={"static": "s"}))


_CRIME = "select event_id, 'user/' || user_id as place, strftime(ts, '%Y-%m-%d') as day, event_type as kind, case when event_id % 3 = 0 then null else 'v' || event_id end as v from events"


@query("events_to_triples", f"""with e as ({_CRIME}), t as (select event_id::varchar as subject_id, unnest([{{p: 'typeOf', i: 'Event', v: ''}}, {{p: 'location', i: place, v: ''}}, {{p: 'observationDate', i: '', v: day}}, {{p: 'provenance', i: 'p3', v: ''}}, {{p: 'kind', i: '', v: kind}}, {{p: 'the_value', i: '', v: v}}]) as u from e)
select subject_id, u.p as predicate, u.i as object_id, u.v as object_value from t where u.i <> '' or u.v <> ''""")
def events_to_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = star.table(spark, sf_dir, "events")
    rows = e.select(_s("event_id").alias("id"), F.concat(F.lit("dcid:user/"), _s("user_id")).alias("place"), F.date_format("ts", "yyyy-MM-dd").alias("day"), F.col("event_type").alias("kind"), F.when(F.col("event_id") % 3 == 0, "NA").otherwise(F.concat(F.lit("v"), _s("event_id"))).alias("the value"))
    return importers.event_triples(rows, "Event", "p3", "place", "day", "id")


@query("entities_to_triples", """with t as (select 'part/' || p_partkey as subject_id, unnest([{p: 'typeOf', i: 'Part', v: ''}, {p: 'provenance', i: 'p4', v: ''}, {p: 'id', i: 'part/' || p_partkey, v: ''}, {p: 'label', i: '', v: p_name}, {p: 'near', i: 'a/' || p_size, v: ''}, {p: 'near', i: 'b/' || p_size, v: ''}, {p: 'brand', i: p_brand, v: ''}]) as u from part)
select subject_id, u.p as predicate, u.i as object_id, u.v as object_value from t""")
def entities_to_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = star.table(spark, sf_dir, "part")
    rows = p.select(F.concat(F.lit("dcid:part/"), _s("p_partkey")).alias("id"), F.col("p_name").alias("label"), F.concat(F.lit("dcid:a/"), _s("p_size"), F.lit(", dcid:b/"), _s("p_size")).alias("near"), F.col("p_brand").alias("brand"))
    return importers.entity_triples(rows, "dcid:Part", "p4", "id", ["brand"])


@query("count_events", "select 'user/' || user_id as entity, 'Count_Event' as variable, strftime(ts, '%Y-%m') as date, count(*)::varchar as value, 'p5' as provenance from events group by all")
def count_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = star.table(spark, sf_dir, "events").select(F.concat(F.lit("user/"), _s("user_id")).alias("place"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"))
    return importers.count_events(e, "Count_Event", "p5", "place", "at").select("entity", "variable", "date", "value", "provenance")


@query("row_numbers", "select 'Row_' || (row_number() over (order by n_nationkey) - 1) as subject_id, n_name as object_value from nation")
def row_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities without an id are numbered by row, whatever the partitioning."""
    n = star.table(spark, sf_dir, "nation").repartitionByRange(5, "n_nationkey").sortWithinPartitions("n_nationkey").select("n_name")
    return importers.entity_triples(n, "Row", "p").where("predicate = 'n_name'").select("subject_id", "object_value")


_CUST = "select c_custkey as k, case when c_custkey % 4 = 0 then 'dcid:place/' || c_custkey when c_custkey % 4 = 1 then 'X' || c_custkey else c_custkey::varchar end as name from customer"


@query("resolve_entities", f"select k, name, case when k % 4 = 0 then 'place/' || k when k % 4 > 1 then 'wiki/' || k end as name_dcid, case when k % 4 = 1 then 'UNRESOLVED' else 'RESOLVED' end as name_status from ({_CUST})")
def resolve_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    c = star.table(spark, sf_dir, "customer").select(k.alias("k"), F.when(k % 4 == 0, F.concat(F.lit("dcid:place/"), _s("c_custkey"))).when(k % 4 == 1, F.concat(F.lit("X"), _s("c_custkey"))).otherwise(_s("c_custkey")).alias("name"))
    known = star.table(spark, sf_dir, "customer").select(F.lit("description").alias("prop"), _s("c_custkey").alias("value"), F.concat(F.lit("wiki/"), _s("c_custkey")).alias("dcid"))
    return importers.resolve_entities(c, "name", known, "description")


@query("resolution_log", f"select name as input, case when k % 4 = 0 then 'place/' || k when k % 4 > 1 then 'wiki/' || k else '*UNRESOLVED*' end as dcid, case when k % 4 = 0 then 'b/place/' || k when k % 4 > 1 then 'b/wiki/' || k else '' end as link from ({_CUST})")
def resolution_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importers.resolution_log(resolve_entities(spark, sf_dir), "name", "b/")


@query("best_candidate", "with c as (select 'user/' || user_id as entity, event_type as t, event_id as i from events where event_type = 'click') select entity, 'e/' || i as dcid from c qualify row_number() over (partition by entity order by i) = 1")
def best_candidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = star.table(spark, sf_dir, "events")
    return importers.best_candidate(e.select(F.concat(F.lit("user/"), _s("user_id")).alias("entity"), F.concat(F.lit("e/"), _s("event_id")).alias("dcid"), F.col("event_type").alias("dominant_type"), F.col("event_id").alias("position")), "click")


@query("common_types", "with t as (select distinct p_brand as e, p_size as s from part union select distinct p_brand, -1 from part) select s::varchar as type from t group by s having count(*) = (select count(distinct p_brand) from part)")
def common_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = star.table(spark, sf_dir, "part")
    return importers.common_types(p.select(F.col("p_brand").alias("entity"), _s("p_size").alias("type")).union(p.select("p_brand", F.lit("-1"))))


@query("sentences", "select 'part/' || p_partkey as subject_id, case when p_partkey % 2 = 0 then 'about ' || p_brand || ';made of ' || p_type else p_name end as sentence from part")
def sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = star.table(spark, sf_dir, "part")
    said = lambda name, v: F.struct(F.lit(name).alias("predicate"), v.alias("object_value"))
    even = F.col("p_partkey") % 2 == 0
    facts = F.array_compact(F.array(said("name", F.col("p_name")), F.when(even, said("searchDescription", F.concat(F.lit("made of "), "p_type"))), F.when(even, said("searchDescription", F.concat(F.lit("about "), "p_brand")))))
    return importers.sentences(p.select(F.concat(F.lit("part/"), _s("p_partkey")).alias("subject_id"), F.explode(facts).alias("e")).select("subject_id", "e.*", F.lit("").alias("object_id")))


_TOPIC = "select 'topic/' || p_brand as s, 'part/' || p_partkey as m from part"


@query("topic_cache", f"""select '{{"dcid":["' || s || '"],"typeOf":["Topic"],"name":["' || s || '"],"relevantVariableList":["' || string_agg(m, '","' order by m) || '"]}}' as value from (select s, m from ({_TOPIC}) union all select distinct s, 'x' from ({_TOPIC}) union all select distinct s, 'y' from ({_TOPIC})) group by s""")
def topic_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = star.table(spark, sf_dir, "part").select(F.concat(F.lit("topic/"), "p_brand").alias("s"), F.concat(F.lit("part/"), _s("p_partkey")).alias("m"))
    said = lambda df, pred, i, v: df.select(F.col("s").alias("subject_id"), F.lit(pred).alias("predicate"), i.alias("object_id"), v.alias("object_value"))
    none, one = F.lit(""), p.select("s").distinct()
    t = said(p, "relevantVariable", F.col("m"), none).unionByName(said(one, "typeOf", F.lit("Topic"), none)).unionByName(said(one, "name", none, F.col("s"))).unionByName(said(one, "relevantVariableList", none, F.lit("x, y")))
    return importers.topic_json(importers.topic_cache(t))


@query("metadata_errors", "select 'undefined' as kind, 'prov/' || n_nationkey as id from nation where n_nationkey % 3 = 0 union all select 'no source', 'prov/' || n_nationkey from nation where n_nationkey % 3 <> 0 and n_nationkey % 2 = 0")
def metadata_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, k = star.table(spark, sf_dir, "nation"), F.col("n_nationkey")
    pid = F.concat(F.lit("prov/"), _s("n_nationkey"))
    triple = lambda w, p, o: n.where(w).select(pid.alias("subject_id"), F.lit(p).alias("predicate"), F.lit(o).alias("object_id"), F.lit("").alias("object_value"))
    t = triple(k % 3 != 0, "typeOf", "Provenance").unionByName(triple((k % 3 != 0) & (k % 2 == 1), "source", "s"))
    return importers.metadata_errors(t, n.select(pid.alias("provenance")))


@query("schema_names", "select 'nation/' || n_nationkey as subject_id, case when n_nationkey % 2 = 0 then n_name when n_nationkey % 3 = 0 then 'remote ' || n_name else 'nation/' || n_nationkey end as name from nation")
def schema_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = star.table(spark, sf_dir, "nation").select(F.concat(F.lit("nation/"), _s("n_nationkey")).alias("subject_id"), F.col("n_name").alias("name"), F.col("n_nationkey").alias("k"))
    return importers.schema_names(n, n.where("k % 2 = 0").drop("k"), n.where("k % 3 = 0").select("subject_id", F.concat(F.lit("remote "), "name").alias("name")))


@query("node_triples", """select 'nation/' || n_nationkey as subject_id, u.p as predicate, u.i as object_id, u.v as object_value from nation, unnest([{p: 'typeOf', i: 'Nation', v: ''}, {p: 'name', i: '', v: n_name}, {p: 'within', i: 'region/' || n_regionkey, v: ''}, {p: 'within', i: 'earth', v: ''}, {p: 'key', i: '', v: n_nationkey::varchar}]) t(u)""")
def node_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = star.table(spark, sf_dir, "nation")
    return importers.node_triples(n.select(F.concat(F.lit("nation/"), _s("n_nationkey")).alias("subject_id"), F.lit("Nation").alias("type"), F.col("n_name").alias("name"), F.lit(None).cast("string").alias("url"), F.create_map(F.lit("within"), F.array(F.concat(F.lit("region/"), _s("n_regionkey")), F.lit("earth"))).alias("refs"), F.create_map(F.lit("key"), _s("n_nationkey")).alias("values")))


_HB = "regexp_replace(p_brand, '[^A-Za-z0-9]', '', 'g')"


def _hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = star.table(spark, sf_dir, "part").select(F.regexp_replace("p_brand", "[^A-Za-z0-9]", "").alias("b"), _s("p_size").alias("z")).distinct()
    pair = lambda k, v: F.struct(F.lit(k).alias("prop"), v.alias("val"))
    return importers.hierarchy(p.select(F.concat(F.lit("v_"), "b", F.lit("_"), "z").alias("variable"), F.lit("part").alias("population_type"), F.array(pair("brand", F.col("b")), pair("size", F.col("z"))).alias("pvs")))


_HIER = f"""with v as (select distinct {_HB} as b, p_size as z from part)
select 'c/g/Part_Brand-' || b || '_Size-' || z as "group", null as parent, null as specialised, 'v_' || b || '_' || z as via from v
union select 'c/g/Part_Brand-' || b || '_Size-' || z, 'c/g/Part_Brand_Size-' || z, b, null from v union select 'c/g/Part_Brand_Size-' || z, 'c/g/Part_Size-' || z, 'brand', null from v
union select 'c/g/Part_Brand-' || b || '_Size-' || z, 'c/g/Part_Brand-' || b || '_Size', z::varchar, null from v union select 'c/g/Part_Brand-' || b || '_Size', 'c/g/Part_Brand-' || b, 'size', null from v
union select 'c/g/Part_Brand-' || b, 'c/g/Part_Brand', b, null from v union select 'c/g/Part_Brand', 'c/g/Part', 'brand', null from v
union select 'c/g/Part_Size-' || z, 'c/g/Part_Size', z::varchar, null from v union select 'c/g/Part_Size', 'c/g/Part', 'size', null from v"""


@query("sv_hierarchy", _HIER)
def sv_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hierarchy(spark, sf_dir)


@query("group_cache", f"""with h as ({_HIER}), c as (select parent as g, string_agg("group" || '=' || specialised, ',' order by "group", specialised) as children from h where parent is not null group by 1),
  v as (select "group" as g, string_agg(via, ',' order by via) as variables from h where via is not null group by 1) select g as "group", coalesce(children, '') as children, coalesce(variables, '') as variables from c full join v using (g)""")
def group_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = importers.group_cache(_hierarchy(spark, sf_dir))
    return c.select("group", F.coalesce(F.array_join(F.transform("children", lambda x: F.concat(x["id"], F.lit("="), x["specialised"])), ","), F.lit("")).alias("children"), F.coalesce(F.array_join("variables", ","), F.lit("")).alias("variables"))


@query("ngram_match", """with t as (select p_partkey as id, lower(regexp_replace(p_name, '[^A-Za-z0-9 ]', '', 'g')) as t from part),
  k0 as (select id, t, unnest(list_distinct(list_concat(string_split(t, ' '), list_transform(range(1, greatest(length(t) - 4, 0) + 2), lambda i: t[i:i + 3])))) as g from t),
  k as (select id, g, strpos(t, g) - 1 as pos from k0), df as (select g, count(*) as df from k group by g),
  q0 as (select id, length(t) as size, string_split(t, ' ') as words, list_transform(range(1, greatest(length(t) - 4, 0) + 2), lambda i: t[i:i + 3]) as runs from t where id % 50 = 0),
  q1 as (select id, size, list_concat(words, list_distinct(list_filter(runs, lambda x: not list_contains(words, x)))) as gs from q0), q as (select id, size, len(gs) as n, unnest(gs) as g from q1),
  m as (select q.id as query, k.id as key, any_value(size) as size, any_value(n) as n, sum(1.0::double / df) as idf, count(*) as matches, min(pos) as position from q join df using (g) join k using (g) group by 1, 2)
select query, key, matches, position::int as position, (row_number() over (partition by query order by round(idf + (size - position) * 10000 + matches * 100, 6) desc, key))::int as rank from m where matches >= greatest(1.0, n * 0.8)""")
def ngram_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of parts against the names of every fiftieth."""
    p = star.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("text"))
    return importers.ngram_match(p, p.where("id % 50 = 0")).select("query", "key", "matches", F.col("position").cast("int").alias("position"), "rank")


# writers and state
@query("upsert", "select c_custkey as k, case when c_custkey % 3 = 0 then 'new ' || c_name else c_name end as name, case when c_custkey % 3 = 0 then 2 else 1 end as version from customer where c_custkey % 5 <> 0 or c_custkey % 3 = 0")
def upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Old rows without every fifth, new ones of every third, each of these twice."""
    c = star.table(spark, sf_dir, "customer")
    old = c.where("c_custkey % 5 <> 0").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.lit(1).alias("version"))
    new = c.where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("k"), F.explode(F.array(F.struct(F.lit("stale").alias("name"), F.lit(0).alias("version")), F.struct(F.concat(F.lit("new "), "c_name").alias("name"), F.lit(2).alias("version")))).alias("x")).select("k", "x.*")
    return sinks.merged(old, new, ["k"], ["version"])


@query("delete_aggregates", "select 'series' as kind, 's' || n_nationkey as id from nation where n_nationkey % 2 = 1 union all select 'observation', 's' || n_nationkey from nation where n_nationkey % 2 = 1 union all select 'edge', 'e' || n_nationkey from nation where n_nationkey % 2 = 1 union all select 'kv', 'k' || n_nationkey from nation where n_nationkey % 2 = 1")
def delete_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = star.table(spark, sf_dir, "nation")
    p = F.when(F.col("n_nationkey") % 2 == 0, "dc/base/out").otherwise("dc/base/in").alias("provenance")
    i = lambda k: F.concat(F.lit(k), _s("n_nationkey"))
    series = n.select(i("s").alias("variable_measured"), F.lit("e").alias("entity1"), F.lit("").alias("extra_entities_id"), F.lit("f").alias("facet_id"), F.struct(p).alias("facet"))
    obs = series.drop("facet").withColumn("date", F.lit("2020"))
    got = sinks.without_aggregates(n.select(i("e").alias("subject_id"), p), series, obs, n.select(i("k").alias("key"), p), ["out"])
    named = [got[1].select(F.lit("series").alias("kind"), F.col("variable_measured").alias("id")), got[2].select(F.lit("observation"), "variable_measured"), got[0].select(F.lit("edge"), "subject_id"), got[3].select(F.lit("kv"), "key")]
    out = named[0]
    for d in named[1:]:
        out = out.union(d)
    return out


@query("delete_generated", "select 'groups' as what, count(*) filter (n_nationkey % 2 = 1) as n from nation union all select 'linked', count(*) filter (n_nationkey % 2 = 1) from nation union all select 'lists', 0 union all select 'list nodes', 1")
def delete_generated(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = star.table(spark, sf_dir, "nation")
    p = F.when(F.col("n_nationkey") % 2 == 0, "dc/base/generated/a").otherwise("dc/base/b").alias("provenance")
    e = n.select(_s("n_nationkey").alias("subject_id"), F.lit("linkedMemberOf").alias("predicate"), F.lit("o").alias("object_id"), p)
    lists = n.select(_s("n_nationkey").alias("subject_id"), F.lit("memberList").alias("predicate"), F.lit("l").alias("object_id"), p)
    held = spark.createDataFrame([("l", "a,b"), ("o", "other")], "subject_id string, value string")
    rest, left = sinks.without_lists(lists, held)
    count = lambda df, what: df.agg(F.count("*").alias("n")).select(F.lit(what).alias("what"), "n")
    return count(sinks.without_generated_groups(e), "groups").unionByName(count(sinks.without_linked(e, ["a"]), "linked")).unionByName(count(rest, "lists")).unionByName(count(left, "list nodes"))


def _flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_events(spark, sf_dir).withColumns({"unit": F.lit("x"), "scaling_factor": F.lit(""), "measurement_method": F.lit(""), "observation_period": F.lit("P1M"), "properties": F.lit("")})


_CE = "select 'user/' || user_id as e, strftime(ts, '%Y-%m') as d, count(*)::varchar as v from events group by all"
_OID = "'obs_' || sha256(e || '_Count_Event_' || d || '_p5_x__P1M_')"


@query("jsonld_observations", f"""select {_OID} as id, '{{"@id":"dcid:' || {_OID} || '","@type":"dcid:StatVarObservation","dcid:observationAbout":{{"@id":"dcid:' || e || '"}},"dcid:variableMeasured":{{"@id":"dcid:Count_Event"}},"dcid:observationDate":"' || d || '","dcid:value":"' || v || '","dcid:provenance":{{"@id":"dcid:p5"}},"dcid:unit":"x","dcid:observationPeriod":"P1M"}}' as json from ({_CE})""")
def jsonld_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.jsonld_observations(_flat(spark, sf_dir))


@query("jsonld_nodes", """select 'nation/' || n_nationkey as id, '{"@id":"dcid:nation/' || n_nationkey || '","dcid:key":[{"@value":"' || n_nationkey || '"}],"dcid:name":[{"@value":"' || n_name || '"}],"dcid:typeOf":[{"@id":"dcid:Nation"}],"dcid:within":[{"@id":"dcid:earth"},{"@id":"dcid:region/' || n_regionkey || '"}]}' as json from nation""")
def jsonld_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.jsonld_nodes(node_triples(spark, sf_dir))


@query("jsonld_shards", f"select count(*) as n_shards, sum(n)::bigint as n_nodes from (select i // 100 as s, count(*) as n from (select (row_number() over () - 1) as i from ({_CE})) group by 1) where true having max(n) <= 100")
def jsonld_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = sinks.shards(sinks.jsonld_observations(_flat(spark, sf_dir)), 100)
    n = docs.select(F.size(F.split("value", '"@type"')) - 1)
    total = n.toDF("n").agg(F.sum("n").cast("bigint").alias("n_nodes"))
    return total.select(F.ceil(F.col("n_nodes") / 100).alias("n_shards"), "n_nodes")


@query("id_collisions", "select p_brand as id, count(*) as n from part group by 1 having count(*) > 1")
def id_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.collisions(star.table(spark, sf_dir, "part").select(F.col("p_brand").alias("id")))


@query("log_report", "select 'ERROR' as level, event_type as counter, count(*) as n, list_aggregate(list_slice(list_sort(list('m' || event_id)), 1, 30), 'string_agg', ',') as examples, false as stop from events group by event_type")
def log_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = star.table(spark, sf_dir, "events").select(F.lit("ERROR").alias("level"), F.col("event_type").alias("counter"), F.concat(F.lit("m"), _s("event_id")).alias("message"))
    return sinks.report(e).withColumn("examples", F.array_join("examples", ","))


@query("ready_imports", "select 'i' || n_nationkey as import_name, 'v/' || n_nationkey || '/' as latest_version, 'v/' || n_nationkey || '/g.mcf' as graph_path from nation where n_nationkey % 2 = 0")
def ready_imports(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = star.table(spark, sf_dir, "nation")
    return state.ready_imports(n.select(F.concat(F.lit("i"), _s("n_nationkey")).alias("import_name"), F.when(F.col("n_nationkey") % 2 == 0, "STAGING").otherwise("SUCCESS").alias("state"), F.concat(F.lit("v/"), _s("n_nationkey"), F.lit("/")).alias("latest_version"), F.lit("/g.mcf").alias("graph_path")))


@query("latest_versions", "select 'u' || user_id as import_name, arg_max('v' || event_id, (ts, 'v' || event_id)) as version from events where event_type = 'click' group by 1")
def latest_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = star.table(spark, sf_dir, "events")
    return state.latest_version(e.select(F.concat(F.lit("u"), _s("user_id")).alias("import_name"), F.concat(F.lit("v"), _s("event_id")).alias("version"), F.when(F.col("event_type") == "click", "SUCCESS").otherwise("FAILURE").alias("status"), F.col("ts").alias("update_time")))


@query("ingestion_metrics", """with c as (select event_type as t, 'u' || (user_id % 7) as i, event_id as v from events), x as (select case when t = 'click' then 'node_count' else 'edge_count' end as k, i, v from c)
select null as import_name, coalesce(sum(v) filter (k = 'node_count'), 0)::bigint as node_count, coalesce(sum(v) filter (k = 'edge_count'), 0)::bigint as edge_count, 0::bigint as observation_count, 0::bigint as timeseries_count from x
union all select i, coalesce(sum(v) filter (k = 'node_count'), 0)::bigint, coalesce(sum(v) filter (k = 'edge_count'), 0)::bigint, 0, 0 from x group by i""")
def ingestion_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = star.table(spark, sf_dir, "events")
    return state.ingestion_metrics(e.select(F.concat(F.when(F.col("event_type") == "click", "node_count").otherwise("edge_count"), F.lit(":u"), (F.col("user_id") % 7).cast("string")).alias("name"), F.col("event_id").alias("value")))


@query("import_status", "select 'i' || n_nationkey as import_name, case when n_nationkey % 2 = 0 then 'RUNNING' else 'SUCCESS' end as state, 'v1' as latest_version from nation union all select 'fresh', 'RUNNING', null")
def import_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = star.table(spark, sf_dir, "nation")
    name = F.concat(F.lit("i"), _s("n_nationkey")).alias("import_name")
    none = F.lit(None).cast("string").alias("latest_version")
    old = n.select(name, F.lit("SUCCESS").alias("state"), F.lit("v1").alias("latest_version"))
    changes = n.where("n_nationkey % 2 = 0").select(name, F.lit("RUNNING").alias("state"), none).unionByName(n.where("n_nationkey = 0").select(F.lit("fresh").alias("import_name"), F.lit("RUNNING").alias("state"), none))
    return state.with_status(old, changes)


@query("series_lookup", "select strftime(o_orderdate, '%Y-%m') as date, round(sum(o_totalprice), 4) as value from orders where o_custkey = (select min(o_custkey) from orders) group by 1")
def series_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from statloom.plans.catalogue import shown

    first = star.table(spark, sf_dir, "orders").agg(F.min("o_custkey")).first()[0]
    p = star.table(spark, sf_dir, "orders").groupBy(F.concat(F.lit("customer/"), _s("o_custkey")).alias("entity"), F.date_format("o_orderdate", "yyyy-MM").alias("date")).agg(F.sum("o_totalprice").alias("value")).withColumn("variable", F.lit("Amount"))
    return shown(state.lookup(p, f"customer/{first}", "Amount"), "date")
