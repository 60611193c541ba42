"""The group hierarchy in full: curated specs, dependent values, verticals and curated variables beside the generated
groups of ``groups``.

Specs are few; variables are many. Facts of a variable are gathered once; specs meet them by joins on population type
and on the key of constraint properties.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from statloom.functions.numbers import format_name
from statloom.operators import closure, groups
from statloom.plans.storage import saved

_ARRAYS = ["populationType", "statVarProperties", "constraintProperties", "vertical", "dependentPropertyValue"]


def generated(base: bool = True) -> Column:
    return F.col("provenance").startswith("dc/base/generated/" if base else "generated/")


def specs(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """spec_id and its sorted arrays by predicate; literals are read from their nodes."""
    own = edges.where("predicate = 'typeOf' and object_id = 'StatVarGroupSpec'").select("subject_id").distinct()
    said = edges.where(F.col("predicate").isin(_ARRAYS)).select("subject_id", "predicate", "object_id").distinct().join(own, "subject_id", "left_semi")
    literal = nodes.where(F.coalesce(F.size("types"), F.lit(0)) <= 0).select(F.col("subject_id").alias("object_id"), F.col("value").alias("text"))
    text = F.col("predicate").isin("statVarProperties", "dependentPropertyValue")
    valued = said.join(literal, "object_id", "left").withColumn("v", F.when(text, F.col("text")).otherwise(F.col("object_id"))).where("v is not null")
    of = lambda p: F.array_sort(F.collect_list(F.when(F.col("predicate") == p, F.col("v")))).alias(p)
    return valued.groupBy(F.col("subject_id").alias("spec_id")).agg(*[of(p) for p in _ARRAYS]).withColumn("population_type", F.get("populationType", F.lit(0)))


def _normal(dpv: Column) -> Column:
    parts = F.split(dpv, "=")
    return F.concat(format_name(F.trim(F.get(parts, F.lit(0)))), F.lit(" = "), format_name(F.trim(F.get(parts, F.lit(1)))))


def dependent_specs(spec: DataFrame) -> DataFrame:
    """Specs with dependent values: population_type, props, key of constraint properties, the values in normal form."""
    d = spec.where(F.size("dependentPropertyValue") > 0)
    names = F.transform("dependentPropertyValue", lambda x: F.trim(F.get(F.split(x, "="), F.lit(0))))
    key = F.array_join(F.array_sort(F.array_distinct(F.concat("constraintProperties", names))), ",")
    return d.select("spec_id", "population_type", F.col("statVarProperties").alias("spec_props"), key.alias("key"), F.transform("dependentPropertyValue", _normal).alias("values"), F.size("constraintProperties").alias("n_constraints"))


def base_data(edges: DataFrame, base: bool = True) -> DataFrame:
    """variable, provenance, population_type, props, constraints, pairs (property, text) of variables that aren't
    generated; ``[..]`` values are left out."""
    is_sv = edges.where((F.col("predicate") == "typeOf") & (F.col("object_id") == "StatisticalVariable") & ~generated(base)).select(F.col("subject_id").alias("variable"), "provenance").distinct()
    named = edges.where("predicate = 'constraintProperties'").select(F.col("object_id").alias("predicate")).distinct()
    fixed = ["populationType", "measuredProperty", "constraintProperties"]
    facts = edges.where(F.col("predicate").isin(fixed)).unionByName(edges.where(~F.col("predicate").isin(fixed)).join(named, "predicate", "left_semi").select(edges.columns)).where(~F.col("object_id").startswith("["))
    per = facts.groupBy(F.col("subject_id").alias("variable")).agg(F.array_sort(F.collect_set(F.struct(F.col("predicate").alias("p"), F.col("object_id").alias("o")))).alias("facts"))
    of = lambda p: F.transform(F.filter("facts", lambda f: f["p"] == p), lambda f: f["o"])
    per = per.select("variable", F.explode(of("populationType")).alias("population_type"), F.transform(of("measuredProperty"), lambda x: F.concat(F.lit("measuredProperty="), x)).alias("props"), of("constraintProperties").alias("constraints"), "facts")
    pairs = F.transform(F.filter("facts", lambda f: F.array_contains("constraints", f["p"])), lambda f: F.struct(f["p"].alias("p"), F.concat(format_name(f["p"]), F.lit(" = "), format_name(f["o"])).alias("text")))
    return per.withColumn("pairs", pairs).drop("facts").join(is_sv, "variable")


def dependent_matches(data: DataFrame, dependent: DataFrame) -> DataFrame:
    """variable, strip: the values of the most specific spec that a variable meets: same population type, one of the
    spec's properties (or it has none), exactly its constraint properties, all of its values. More values go first, then
    more constraint properties, then the spec's id."""
    v = data.select("variable", "population_type", "props", F.array_join("constraints", ",").alias("key"), F.transform("pairs", lambda p: p["text"]).alias("texts")).distinct().where("key <> ''")
    met = v.join(dependent, ["population_type", "key"]).where(((F.size("spec_props") == 0) | F.arrays_overlap("props", "spec_props")) & F.forall("values", lambda x: F.array_contains("texts", x)))
    w = Window.partitionBy("variable").orderBy(F.desc(F.size("values")), F.desc("n_constraints"), "spec_id")
    return met.withColumn("r", F.row_number().over(w)).where("r = 1").select("variable", F.col("values").alias("strip"))


def initial(data: DataFrame, matches: DataFrame, curated: DataFrame) -> DataFrame:
    """What groups are generated from: variables without curated ones, their attributes without dependent values."""
    left = data.join(curated.select("variable").distinct(), "variable", "left_anti").join(matches, "variable", "left")
    none = F.array().cast("array<string>")
    attributes = F.filter(F.transform("pairs", lambda p: p["text"]), lambda t: ~F.array_contains(F.coalesce("strip", none), t))
    return left.select("variable", "provenance", "population_type", "props", attributes.alias("attributes")).distinct()


def curated_members(edges: DataFrame, base: bool = True) -> DataFrame:
    return edges.where((F.col("predicate") == "memberOf") & ~generated(base)).select(F.col("subject_id").alias("variable"), F.col("object_id").alias("parent"), "provenance").distinct()


def curated_linked(edges: DataFrame, base: bool = True) -> DataFrame:
    """linkedMemberOf of curated variables: memberOf, then specializationOf for up to 11 hops in all."""
    start = curated_members(edges, base).select(F.col("variable").alias("start"), F.col("parent").alias("end"), "provenance")
    up = edges.where("predicate = 'specializationOf'").select(F.col("subject_id").alias("start"), F.col("object_id").alias("end"))
    found = closure.reach(start, up, 11)
    return found.select(F.col("start").alias("subject_id"), F.lit("linkedMemberOf").alias("predicate"), F.col("end").alias("object_id"), groups.generated_provenance().alias("provenance")).distinct()


def vertical_specs(spec: DataFrame, edges: DataFrame) -> DataFrame:
    """population_type, prop (null for any), constraints (none or one), vertical, linked (with ancestors) of specs that
    have a vertical and at most one constraint property."""
    s = spec.where((F.size("constraintProperties") <= 1) & (F.size("vertical") > 0)).select("spec_id", "population_type", F.explode_outer("statVarProperties").alias("prop"), F.col("constraintProperties").alias("constraints"), "vertical")
    s = s.withColumn("prop", F.get(F.split("prop", ","), F.lit(0)))
    up = closure.ancestors(edges.where("predicate = 'specializationOf'"))
    above = s.select("spec_id", F.explode("vertical").alias("start")).distinct().join(up, "start").groupBy("spec_id").agg(F.flatten(F.collect_list("ancestors")).alias("above"))
    none = F.array().cast("array<string>")
    return s.join(above, "spec_id", "left").withColumn("linked", F.array_sort(F.array_distinct(F.concat("vertical", F.coalesce("above", none))))).drop("above")


def loose_edges(start: DataFrame, verticals: DataFrame, namespace: str = "dc/", filter_basic: bool = True) -> DataFrame:
    """memberOf and linkedMemberOf of variables of basic population types without constraints: to their verticals, else
    to the group of uncategorised variables."""
    mine = start.where((F.size("attributes") == 0) & F.col("population_type").isin(groups.BASIC) & F.lit(filter_basic)).withColumn("own", F.explode_outer("props"))
    v = verticals.where(F.size("constraints") == 0).select("population_type", "prop", "vertical", "linked")
    joined = mine.join(v, (mine.population_type == v.population_type) & (v.prop.isNull() | (v.prop == mine.own)), "left")
    lost, top = f"{namespace}g/Uncategorized", f"{namespace}g/Root"
    member = F.coalesce("vertical", F.array(F.lit(f"{lost}_Variables")))
    linked = F.coalesce("linked", F.array(F.lit(top), F.lit(lost), F.lit(f"{lost}_Variables")))
    every = F.concat(F.transform(member, lambda o: F.struct(F.lit("memberOf").alias("predicate"), o.alias("object_id"))), F.transform(linked, lambda o: F.struct(F.lit("linkedMemberOf").alias("predicate"), o.alias("object_id"))))
    return joined.select(F.col("variable").alias("subject_id"), F.explode(every).alias("e"), groups.generated_provenance().alias("provenance")).select("subject_id", "e.*", "provenance").distinct()


def vertical_edges(rows: DataFrame, start: DataFrame, verticals: DataFrame, namespace: str = "dc/", filter_basic: bool = True) -> DataFrame:
    """specializationOf of top groups to verticals and linkedMemberOf of their variables: of basic population types the
    groups of one property, of others the population's group. A group with a vertical isn't uncategorised, and nor is a
    variable unless one of its groups is."""
    basic = F.col("population_type").isin(groups.BASIC) & F.lit(filter_basic)
    of = start.select("variable", "provenance", "population_type", F.size("attributes").alias("n")).distinct()
    walked = rows.join(of, ["variable", "provenance"])
    one = walked.where(basic & (F.col("iteration") == F.col("n")) & F.col("node2").isNotNull()).select("variable", "provenance", "population_type", F.col("node2").alias("group"), F.element_at(F.split("node2name", " With "), -1).alias("property"))
    none = walked.where(~basic & (F.col("iteration") == F.col("n")) & F.col("node3").isNotNull()).select("variable", "provenance", "population_type", F.col("node3").alias("group"), F.lit("").alias("property"))
    top = one.unionByName(none).distinct()
    v = verticals.select("population_type", F.coalesce(format_name(F.get("constraints", F.lit(0))), F.lit("")).alias("property"), "vertical", "linked")
    lost, root = f"{namespace}g/Uncategorized", f"{namespace}g/Root"
    joined = top.join(v, ["population_type", "property"], "left").withColumns({"vertical": F.coalesce("vertical", F.array(F.lit(lost))), "linked": F.coalesce("linked", F.array(F.lit(root), F.lit(lost)))})
    raw = joined.select(F.col("group").alias("subject_id"), F.explode("vertical").alias("object_id"), groups.generated_provenance().alias("provenance")).distinct()
    w = Window.partitionBy("subject_id", "provenance")
    up = saved(raw.withColumn("known", F.sum((F.col("object_id") != lost).cast("int")).over(w)).where((F.col("object_id") != lost) | (F.col("known") == 0)).drop("known"), "verticals")
    member = joined.select("variable", "group", F.explode("linked").alias("object_id"), groups.generated_provenance().alias("provenance")).distinct()
    open_ = up.where(F.col("object_id") == lost).select(F.col("subject_id").alias("group"), "provenance")
    kept = member.where(F.col("object_id") != lost).unionByName(member.where(F.col("object_id") == lost).join(open_, ["group", "provenance"], "left_semi").select(member.columns))
    return up.select("subject_id", F.lit("specializationOf").alias("predicate"), "object_id", "provenance").unionByName(kept.select(F.col("variable").alias("subject_id"), F.lit("linkedMemberOf").alias("predicate"), "object_id", "provenance").distinct())


def generate(edges: DataFrame, nodes: DataFrame, namespace: str = "dc/", base: bool = True, filter_basic: bool = True, pruned: bool = False) -> DataFrame:
    """All edges of the hierarchy."""
    spec = saved(specs(edges, nodes), "specs")
    data = saved(base_data(edges, base), "variables")
    start = saved(initial(data, dependent_matches(data, dependent_specs(spec)), curated_members(edges, base)), "initial")
    rows = saved(groups.steps(start.select("variable", "provenance", "population_type", "attributes").distinct(), namespace, filter_basic), "steps")
    verticals = saved(vertical_specs(spec, edges), "vertical-specs")
    out = groups.group_edges(rows).unionByName(loose_edges(start, verticals, namespace, filter_basic)).unionByName(vertical_edges(rows, start, verticals, namespace, filter_basic)).unionByName(curated_linked(edges, base)).distinct()
    return groups.prune(out, groups.group_nodes(rows)) if pruned else out
