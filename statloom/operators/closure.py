"""Closures of edges, materialised so that a lookup needs no walk."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from statloom.functions.facets import generated_provenance, provenance_name
from statloom.plans.storage import saved


def reach(base: DataFrame, step: DataFrame, hops: int) -> DataFrame:
    """(start, end, provenance) that are 1 to ``hops`` steps apart: rows of ``base``, then ``step`` (start, end).

    Semi-naive: a round extends only what the last one found, and what was found before is dropped, which ends cycles.
    Each round is written to the shared folder, so no round is computed twice."""
    step = step.select(F.col("start").alias("__from"), F.col("end").alias("__to")).distinct()
    frontier = saved(base.select("start", "end", "provenance").distinct(), "reach")
    found = frontier
    for _ in range(hops - 1):
        new = frontier.join(step, frontier.end == F.col("__from")).select("start", F.col("__to").alias("end"), "provenance").distinct()
        frontier = saved(new.join(found, ["start", "end", "provenance"], "left_anti"), "reach")
        if frontier.isEmpty():
            break
        found = found.unionByName(frontier)
    return found


def _edges(edges: DataFrame, predicate: str, imports: list[str] | None, base: bool) -> DataFrame:
    out = edges.where(F.col("predicate") == predicate)
    if imports is not None:
        out = out.where(F.col("provenance").isin([provenance_name(i, base) for i in imports]))
    return out.select(F.col("subject_id").alias("start"), F.col("object_id").alias("end"), "provenance")


def _generated(found: DataFrame, predicate: str, base: bool) -> DataFrame:
    bare = F.regexp_replace("provenance", "^dc/base/", "")
    name = F.when(bare.startswith("generated/"), bare).otherwise(F.concat(F.lit("generated/"), bare))
    return found.select(F.col("start").alias("subject_id"), F.lit(predicate).alias("predicate"), F.col("end").alias("object_id"), F.concat(F.lit("dc/base/" if base else ""), name).alias("provenance")).distinct()


def linked_contained_in_place(edges: DataFrame, imports: list[str] | None = None, base: bool = True) -> DataFrame:
    """containedInPlace, followed for up to 11 hops within the imports; the first hop's provenance is kept."""
    inside = _edges(edges, "containedInPlace", imports, base)
    return _generated(reach(inside, inside, 11), "linkedContainedInPlace", base)


def linked_member_of(edges: DataFrame, imports: list[str] | None = None, base: bool = True) -> DataFrame:
    """memberOf, then specializationOf for up to 21 hops in all."""
    return _generated(reach(_edges(edges, "memberOf", imports, base), _edges(edges, "specializationOf", imports, base), 21), "linkedMemberOf", base)


def linked_member(edges: DataFrame, imports: list[str] | None = None, base: bool = True) -> DataFrame:
    """Leaf variables to their topics: relevantVariable of topics and member of peer groups, followed down."""
    types = edges.where("predicate = 'typeOf'").where(F.col("object_id").isin("Topic", "StatVarPeerGroup")).select(F.col("subject_id").alias("start"), F.col("object_id").alias("type")).distinct()
    raw = _edges(edges, "relevantVariable", imports, base).withColumn("of", F.lit("Topic")).unionByName(_edges(edges, "member", imports, base).withColumn("of", F.lit("StatVarPeerGroup")))
    down = raw.join(types, (raw.start == types.start) & (raw.of == types.type), "left_semi").select("start", "end", "provenance").distinct()
    down = saved(down, "hierarchy")
    found = reach(down, down, 21)
    topics = types.where("type = 'Topic'").select("start").distinct()
    leaves = found.join(topics, "start", "left_semi").join(types.select(F.col("start").alias("end")).distinct(), "end", "left_anti")
    return _generated(leaves.select(F.col("end").alias("start"), F.col("start").alias("end"), "provenance"), "linkedMember", base)


def ancestors(edges: DataFrame, predicate: str = "specializationOf", hops: int = 11) -> DataFrame:
    """start, ancestors (sorted array)."""
    up = _edges(edges, predicate, None, True).withColumn("provenance", F.lit(""))
    return reach(up, up, hops).groupBy("start").agg(F.array_sort(F.collect_set("end")).alias("ancestors"))
