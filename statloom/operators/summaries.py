"""Summaries of variables, nodes and topics."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from statloom.functions.ids import literal_key
from statloom.functions import facets
from statloom.plans.storage import saved
from statloom.schema import FACETS

MOST_SAMPLES = 3


def facet_summary(points: DataFrame) -> DataFrame:
    """Per variable and facet: numbers of points and series, first and last date, least and greatest value."""
    return points.groupBy("variable", *FACETS).agg(
        F.count("*").alias("n_points"), F.count_distinct(F.struct("entity", "extra")).alias("n_series"), F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.min("value").alias("min_value"), F.max("value").alias("max_value")
    )


def place_type_summary(points: DataFrame, edges: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Per variable, facet and place type: number of places, least and greatest value, and the first three places.

    Points are reduced to one row a place before the types are joined, so that a place of several types isn't carried
    point by point. Places without a type are left out."""
    return _by_place_type(points.groupBy("variable", "entity", *FACETS).agg(F.min("value").alias("lo"), F.max("value").alias("hi")), edges, names)


def _by_place_type(per_place: DataFrame, edges: DataFrame, names: DataFrame | None) -> DataFrame:
    types = edges.where("predicate = 'typeOf'").select(F.col("subject_id").alias("entity"), F.col("object_id").alias("place_type")).distinct()
    sample = F.col("entity") if names is None else F.struct("entity", "name")
    joined = per_place.join(types, "entity")
    if names is not None:
        joined = joined.join(names.select(F.col("subject_id").alias("entity"), "name"), "entity", "left")
    return joined.groupBy("variable", "place_type", *FACETS).agg(F.count_distinct("entity").alias("n_places"), F.min("lo").alias("min_value"), F.max("hi").alias("max_value"), F.slice(F.array_sort(F.collect_set(sample)), 1, MOST_SAMPLES).alias("sample_places"))


def provenance_summary(points: DataFrame, edges: DataFrame, names: DataFrame | None = None, imports: list[str] | None = None) -> DataFrame:
    """variable, provenance, import_name, n_points, n_series, facets (array of structs with place types).

    Points are reduced to a row for each series first; both summaries are made from these, which the shared folder
    holds."""
    points = facets.in_imports(points, imports)
    per = saved(points.groupBy("variable", "entity", "extra", *FACETS).agg(F.count("*").alias("n"), F.min("date").alias("d0"), F.max("date").alias("d1"), F.min("value").alias("lo"), F.max("value").alias("hi")), "per-series")
    facet = per.groupBy("variable", *FACETS).agg(F.sum("n").alias("n_points"), F.count("*").alias("n_series"), F.min("d0").alias("first_date"), F.max("d1").alias("last_date"), F.min("lo").alias("min_value"), F.max("hi").alias("max_value"))
    places = _by_place_type(per, edges, names).groupBy("variable", *FACETS).agg(F.array_sort(F.collect_list(F.struct("place_type", "n_places", "min_value", "max_value", "sample_places"))).alias("place_types"))
    on = None
    right = places.select(*[F.col(c).alias(f"__{c}") for c in ("variable", *FACETS)], "place_types")
    for c in ("variable", *FACETS):
        same = F.col(c).eqNullSafe(F.col(f"__{c}"))
        on = same if on is None else on & same
    both = facet.join(right, on, "left")
    series = F.struct("method", "period", "unit", "scaling", "is_aggregate", "n_points", "n_series", "first_date", "last_date", "min_value", "max_value", "place_types")
    return both.groupBy("variable", "provenance").agg(F.sum("n_points").alias("n_points"), F.sum("n_series").alias("n_series"), F.array_sort(F.collect_list(series)).alias("facets")).withColumn("import_name", F.regexp_replace("provenance", "^dc/base/", ""))


def key_values(summary: DataFrame, kind: str = "ProvenanceSummary") -> DataFrame:
    """Rows of the key-value table, with the names that readers of its JSON expect."""
    of = lambda f: F.struct(
        F.struct(f["method"].alias("measurement_method"), f["period"].alias("observation_period"), f["scaling"].alias("scaling_factor"), f["unit"].alias("unit"), f["is_aggregate"].alias("is_dc_aggregate")).alias("series_key"),
        f["first_date"].alias("earliest_date"), f["last_date"].alias("latest_date"), f["min_value"].alias("min_value"), f["max_value"].alias("max_value"), f["n_points"].alias("observation_count"), f["n_series"].alias("time_series_count"),
        F.map_from_entries(F.transform(F.coalesce(f["place_types"], F.array()), lambda p: F.struct(p["place_type"], F.struct(p["n_places"].alias("place_count"), p["min_value"].alias("min_value"), p["max_value"].alias("max_value"), p["sample_places"].alias("top_places"))))).alias("place_type_summary"),
    )
    value = F.to_json(F.struct("import_name", F.col("n_points").alias("observation_count"), F.col("n_series").alias("time_series_count"), F.transform("facets", of).alias("series_summary")))
    return summary.select(F.lit(kind).alias("type"), F.col("variable").alias("key"), "provenance", value.alias("value"))


def node_types(edges: DataFrame) -> DataFrame:
    return edges.where("predicate = 'typeOf'").groupBy("subject_id").agg(F.array_sort(F.collect_set("object_id")).alias("types"))


def node_names(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """The first name in order of text; name edges point to nodes of literals."""
    e = edges.where("predicate = 'name'").select(F.col("subject_id").alias("node"), F.col("object_id").alias("literal"))
    return e.join(nodes.select(F.col("subject_id").alias("literal"), "value"), "literal").groupBy(F.col("node").alias("subject_id")).agg(F.min("value").alias("name"))


def node_properties(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    return node_types(edges).join(node_names(edges, nodes), "subject_id", "full")


_LISTS = (("Topic", "relevantVariable", "relevantVariableList"), ("StatVarPeerGroup", "member", "memberList"))


def member_lists(edges: DataFrame) -> DataFrame:
    """subject_id, predicate, list: sorted distinct members of topics and peer groups, joined by commas."""
    types = edges.where("predicate = 'typeOf'").select("subject_id", F.col("object_id").alias("type")).distinct()
    out = None
    for kind, predicate, name in _LISTS:
        mine = edges.where(F.col("predicate") == predicate).join(types.where(F.col("type") == kind).select("subject_id"), "subject_id", "left_semi")
        part = mine.groupBy("subject_id").agg(F.array_join(F.array_sort(F.collect_set("object_id")), ",").alias("list")).select("subject_id", F.lit(name).alias("predicate"), "list")
        out = part if out is None else out.unionByName(part)
    return out


def list_nodes_and_edges(edges: DataFrame, provenance: str) -> tuple[DataFrame, DataFrame]:
    """Literal nodes and edges of the lists; these keys have the digest in hexadecimal."""
    lists = member_lists(edges).withColumn("key", literal_key("list", as_hex=True))
    nodes = lists.select(F.col("key").alias("subject_id"), F.col("list").alias("value")).distinct()
    return nodes, lists.select("subject_id", "predicate", F.col("key").alias("object_id"), F.lit(provenance).alias("provenance"))
