"""Hierarchy of variable groups.

A variable of population type T with constraints p = v belongs to the group of all of them; removing one value, then
its property, leads step by step up to T. All groups reached this way are the subsets of the constraints, so the
hierarchy is walked in rounds, one constraint fewer in each, over each subset of a variable's constraints once; no
variable is left out, whatever its number of constraints. ``ROUNDS`` bounds
the depth, as 50 constraints are more than a variable has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from statloom.functions.ids import literal_key
from statloom.functions.numbers import format_name
from statloom.plans.storage import saved

ROUNDS = 50
BASIC = ["Person", "BLSWorker", "USCWorker", "Thing", "Household", "HousingUnit", "Place", "Energy"]


def variables(edges: DataFrame, constraints: list[str] | None = None) -> DataFrame:
    """variable, population_type, attributes (``Prop = Value``, in order of property), provenance."""
    fixed = ["typeOf", "name", "description", "populationType", "measuredProperty", "statType", "measurementQualifier", "measurementDenominator", "memberOf", "constraintProperties"]
    is_variable = edges.where("predicate = 'typeOf' and object_id = 'StatisticalVariable'").select("subject_id").distinct()
    mine = edges.join(is_variable, "subject_id", "left_semi")
    constraint = ~F.col("predicate").isin(fixed) if constraints is None else F.col("predicate").isin(constraints)
    pair = F.when(constraint, F.struct(F.col("predicate").alias("p"), F.concat(format_name("predicate"), F.lit(" = "), format_name("object_id")).alias("text")))
    return mine.groupBy(F.col("subject_id").alias("variable"), "provenance").agg(F.max(F.when(F.col("predicate") == "populationType", F.col("object_id"))).alias("population_type"), F.transform(F.array_sort(F.collect_set(pair)), lambda x: x["text"]).alias("attributes")).where("population_type is not null")


def _id(namespace: str, attributes: Column) -> Column:
    shown = F.transform(attributes, lambda a: F.translate(F.translate(a, " ", ""), "=", "-"))
    return F.concat(F.lit(f"{namespace}g/"), F.col("population_type"), F.when(F.size(attributes) > 0, F.concat(F.lit("_"), F.array_join(shown, "_"))).otherwise(F.lit("")))


def _name(attributes: Column) -> Column:
    return F.concat(format_name("population_type"), F.when(F.size(attributes) > 0, F.concat(F.lit(" With "), F.array_join(attributes, ", "))).otherwise(F.lit("")))


def steps(variables_: DataFrame, namespace: str = "dc/", filter_basic: bool = True) -> DataFrame:
    """variable, provenance, iteration, node1, node2, node2name, node3, node3name as the iterative walk yields them."""
    basic = F.col("population_type").isin(BASIC) & F.lit(filter_basic)
    null = F.lit(None).cast("string")
    top = lambda attributes, x: F.when((F.size(attributes) == 0) & basic, null).otherwise(x)
    at = F.col("attributes")
    start = variables_.select("variable", "provenance", F.lit(0).alias("iteration"), null.alias("node1"), null.alias("node2"), null.alias("node2name"), top(at, _id(namespace, at)).alias("node3"), top(at, _name(at)).alias("node3name"))
    level = variables_.where(F.size("attributes") > 0).select("variable", "provenance", "population_type", F.col("attributes").alias("held"))
    without_value = F.expr("transform(held, (a, i) -> if(i = at, split(a, ' = ')[0], a))")
    without = F.expr("filter(held, (a, i) -> i <> at)")
    out = start
    for k in range(1, ROUNDS + 1):
        walked = level.select("*", F.posexplode("held").alias("at", "removed")).withColumns({"half": without_value, "rest": without})
        walked = saved(walked.select(
            "variable", "provenance", "population_type", "rest", F.lit(k).alias("iteration"), _id(namespace, F.col("held")).alias("node1"), _id(namespace, F.col("half")).alias("node2"), _name(F.col("half")).alias("node2name"),
            top(F.col("rest"), _id(namespace, F.col("rest"))).alias("node3"), top(F.col("rest"), _name(F.col("rest"))).alias("node3name"),
        ), "walk")
        if walked.isEmpty():
            break
        out = out.unionByName(walked.drop("population_type", "rest"))
        level = walked.where(F.size("rest") > 0).select("variable", "provenance", "population_type", F.col("rest").alias("held")).distinct()
    return out.distinct()


def generated_provenance() -> Column:
    bare = F.regexp_replace("provenance", "^dc/base/", "")
    return F.when(bare.startswith("generated/"), F.col("provenance")).otherwise(F.concat(F.when(F.col("provenance").startswith("dc/base/"), "dc/base/").otherwise(""), F.lit("generated/"), bare))


def group_edges(rows: DataFrame) -> DataFrame:
    """subject_id, predicate, object_id, provenance."""
    def edge(s: str, p: str, o, keep: Column) -> Column:
        return F.when(keep, F.struct(F.col(s).alias("subject_id"), F.lit(p).alias("predicate"), o.alias("object_id")))

    c = F.col
    two, three = c("node2").isNotNull(), c("node3").isNotNull()
    all_ = F.array(
        edge("variable", "memberOf", c("node3"), (c("iteration") == 0) & three),
        edge("node2", "typeOf", F.lit("StatVarGroup"), two), edge("node3", "typeOf", F.lit("StatVarGroup"), three),
        edge("node2", "name", literal_key("node2name", trim=False), two), edge("node3", "name", literal_key("node3name", trim=False), three),
        edge("node1", "specializationOf", c("node2"), c("node1").isNotNull() & two), edge("node2", "specializationOf", c("node3"), two & three),
        edge("variable", "linkedMemberOf", c("node2"), two), edge("variable", "linkedMemberOf", c("node3"), three),
    )
    return rows.select(F.explode(F.array_compact(all_)).alias("e"), generated_provenance().alias("provenance")).select("e.*", "provenance").distinct()


def vertical_edges(rows: DataFrame, variables_: DataFrame, verticals: DataFrame | None = None, namespace: str = "dc/", filter_basic: bool = True) -> DataFrame:
    """specializationOf from top groups to their verticals; ``verticals``: population_type, property (null for none), vertical."""
    basic = F.col("population_type").isin(BASIC) & F.lit(filter_basic)
    with_type = rows.join(variables_.select("variable", "provenance", "population_type", "attributes"), ["variable", "provenance"])
    size = F.size("attributes")
    one = with_type.where(basic & (F.col("iteration") == size) & F.col("node2").isNotNull()).select(F.col("node2").alias("group"), "population_type", F.element_at(F.split("node2name", " With "), -1).alias("property"), "provenance")
    none = with_type.where(~basic & (F.col("iteration") == size) & F.col("node3").isNotNull()).select(F.col("node3").alias("group"), "population_type", F.lit("").alias("property"), "provenance")
    top = one.unionByName(none).distinct()
    uncategorised = f"{namespace}g/Uncategorized"
    if verticals is None:
        found = top.withColumn("vertical", F.lit(uncategorised))
    else:
        spec = verticals.select("population_type", F.coalesce(format_name("property"), F.lit("")).alias("property"), "vertical").distinct()
        found = top.join(spec, ["population_type", "property"], "left").withColumn("vertical", F.coalesce("vertical", F.lit(uncategorised)))
    return found.select(F.col("group").alias("subject_id"), F.lit("specializationOf").alias("predicate"), F.col("vertical").alias("object_id"), generated_provenance().alias("provenance")).distinct()


def group_nodes(rows: DataFrame) -> DataFrame:
    two = rows.select(F.col("node2").alias("subject_id"), F.col("node2name").alias("name"))
    three = rows.select(F.col("node3").alias("subject_id"), F.col("node3name").alias("name"))
    return two.unionByName(three).where("subject_id is not null").distinct()


def prune(edges: DataFrame, generated: DataFrame, rounds: int = 50) -> DataFrame:
    """Remove generated groups (subject_id) with at most one child; what hung below them moves up.

    Each round works on what the last one left, written to the shared folder; both predicates keep their kind."""
    edges = saved(edges, "groups")
    first = edges.where(F.col("predicate").isin("specializationOf", "memberOf")).select(F.col("subject_id").alias("child"), F.col("object_id").alias("parent"), "predicate", "provenance").distinct()
    current, gone, left = saved(first, "children"), None, generated.select(F.col("subject_id").alias("parent")).distinct()
    for _ in range(rounds):
        n = current.groupBy("parent").agg(F.count_distinct("child").alias("n"))
        new = saved(left.join(n, "parent", "left").where(F.coalesce("n", F.lit(0)) <= 1).select("parent"), "pruned")
        if new.isEmpty():
            break
        gone = new if gone is None else gone.unionByName(new)
        left = left.join(new, "parent", "left_anti")
        # paths through several groups that go in the same round are followed to their end
        out = saved(current.join(new.select(F.col("parent").alias("child")), "child", "left_semi").select(F.col("child").alias("parent"), F.col("parent").alias("up")).distinct(), "up")
        kept = current.join(new, "parent", "left_anti")
        moving = current.join(new, "parent", "left_semi")
        done = kept
        while True:
            moved = saved(moving.join(out, "parent").select("child", F.col("up").alias("parent"), "predicate", "provenance").distinct(), "moving")
            if moved.isEmpty():
                break
            done = done.unionByName(moved.join(new, "parent", "left_anti"))
            moving = moved.join(new, "parent", "left_semi")
        current = saved(done.join(new.select(F.col("parent").alias("child")), "child", "left_anti").distinct(), "children")
    if gone is None:
        return edges
    rest = edges.where(~F.col("predicate").isin("specializationOf", "memberOf"))
    rest = rest.join(gone.select(F.col("parent").alias("subject_id")), "subject_id", "left_anti").join(gone.select(F.col("parent").alias("object_id")), "object_id", "left_anti")
    return rest.select("subject_id", "predicate", "object_id", "provenance").unionByName(current.select(F.col("child").alias("subject_id"), "predicate", F.col("parent").alias("object_id"), "provenance")).distinct()


def build_groups(edges: DataFrame, namespace: str = "dc/", filter_basic: bool = True, pruned: bool = False, verticals: DataFrame | None = None) -> DataFrame:
    v = saved(variables(edges), "variables")
    rows = saved(steps(v, namespace, filter_basic), "steps")
    out = group_edges(rows).unionByName(vertical_edges(rows, v, verticals, namespace, filter_basic)).distinct()
    return prune(out, group_nodes(rows)) if pruned else out
