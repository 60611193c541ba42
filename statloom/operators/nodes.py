"""Parsed nodes made ready: complex values, definitions, names and ids of variables, resolution of references.

Works on gathered nodes (``construct.gathered``): node_id, pvs ARRAY<STRUCT<prop, pos, type, value>>.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from statloom.functions.ids import generated_id, unsigned_fingerprint  # noqa: F401
from statloom.functions.numbers import is_number, strip_schema_prefix
from statloom.operators.construct import first_of, gathered, values_of
from statloom.plans.storage import saved

NOT_CONSTRAINTS = (
    "typeOf dcid provenance isPublic localCuratorLevelId url memberOf name label description descriptionUrl alternateName utteranceTemplate source footnote keyString resMCFFile populationType populationGroup location childhoodLocation "
    "constraintProperties measuredProperty statType measurementDenominator measurementQualifier censusACSTableId measurementMethod scalingFactor unit isNormalizable denominatorForNormalization observationProperties definition linkedMember linkedMemberOf"
).split()
FIXED = ["typeOf", "populationType", "measuredProperty", "statType", "measurementQualifier", "measurementDenominator"]
OBSERVATION_KEY = ["observationAbout", "variableMeasured", "observationDate", "value", "observationPeriod", "unit", "measurementMethod", "scalingFactor"]
OLD_KEY = (
    "observedNode observationDate measuredProperty observationPeriod unit measuredValue minValue maxValue sumValue meanValue medianValue marginOfError measurementMethod measurementResult stdError sampleSize percentile10 percentile25 "
    "percentile75 percentile90 meanStdError growthRate stdDeviationValue confidenceIntervalLowerLimit confidenceIntervalUpperLimit kurtosis skewness measurementDenominator measurementQualifier scalingFactor"
).split()
PLACE_IDS = [
    "unDataCode", "geoId", "isoCode", "nutsCode", "wikidataId", "geoNamesId", "istatId", "austrianMunicipalityKey", "indianCensusAreaCode2011", "indianCensusAreaCode2001", "lgdCode", "udiseCode", "fips52AlphaCode", "countryAlpha3Code",
    "countryNumericCode",
]
PLACES = (
    "Place Continent Country State Province County City StateComponent CensusCoreBasedStatisticalArea USMetropolitanDivision CensusCountyDivision CensusTract CensusBlockGroup CensusZipCodeTabulationArea CongressionalDistrict SchoolDistrict "
    "ElementarySchoolDistrict HighSchoolDistrict CommutingZone Borough Town Village Neighborhood EurostatNUTS1 EurostatNUTS2 EurostatNUTS3 AdministrativeArea AdministrativeArea1 AdministrativeArea2 AdministrativeArea3 AdministrativeArea4 "
    "AdministrativeArea5"
).split()


# complex values
def complex_value(v: Column) -> Column:
    """STRUCT<id, name, kind, a, b, unit> of ``[unit value]``, ``[unit low high]`` (``-`` for open) or
    ``[LatLong x y]``, the unit first or last; null where it is none of these."""
    inner = F.trim(F.substring(v, 2, 1_000_000))
    inner = F.trim(F.substring(inner, F.lit(1), F.length(inner) - 1))
    parts = F.filter(F.split(inner, " +"), lambda x: x != "")
    at = lambda i: F.get(parts, F.lit(i))
    n = F.size(parts)
    last = at(0).rlike(r"^[-0-9]")  # the unit stands last
    unit = F.regexp_replace(F.when(last, F.element_at(parts, -1)).otherwise(at(0)), r"^[^:]*:", "")
    a = F.when(last, at(0)).otherwise(at(1))
    b = F.when(n == 3, F.when(last, at(1)).otherwise(at(2)))
    enclosed = v.startswith("[") & v.endswith("]") & n.isin(2, 3)
    open_ = lambda x: x == "-"

    def degrees(x: Column, plus: str, minus: str, most: float) -> Column:
        u = F.upper(x)
        d = F.when(u.endswith(minus), F.concat(F.lit("-"), F.substring(x, F.lit(1), F.length(x) - 1))).when(u.endswith(plus), F.substring(x, F.lit(1), F.length(x) - 1)).otherwise(x).try_cast("double")
        return F.when(F.abs(d) <= most, d)

    lat, lng = degrees(a, "N", "S", 90.0), degrees(b, "E", "W", 180.0)
    e5 = lambda d: F.floor(d * 100000 + 0.5)
    place = F.struct(
        F.concat(F.lit("latLong/"), e5(lat).cast("string"), F.lit("_"), e5(lng).cast("string")).alias("id"), F.concat(F.format_string("%.5f", e5(lat) / 100000.0), F.lit(","), F.format_string("%.5f", e5(lng) / 100000.0)).alias("name"),
        F.lit("GeoCoordinates").alias("kind"), a.alias("a"), b.alias("b"), unit.alias("unit"),
    )
    made = lambda i, name, kind: F.struct(i.alias("id"), name.alias("name"), F.lit(kind).alias("kind"), a.alias("a"), b.alias("b"), unit.alias("unit"))
    sp = F.lit(" ")
    quantity = made(F.concat(unit, a), F.concat(unit, sp, a), "Quantity")
    ends = F.when(open_(a), F.concat(F.lit("Upto"), b)).when(open_(b), F.concat(a, F.lit("Onwards"))).otherwise(F.concat(a, F.lit("To"), b))
    words = F.when(open_(a), F.concat(F.lit("UpTo "), b)).when(open_(b), F.concat(a, F.lit(" Onwards"))).otherwise(F.concat(a, F.lit(" To "), b))
    span = made(F.concat(unit, ends), F.concat(unit, sp, words), "QuantityRange")
    good = (open_(a) | is_number(a)) & (open_(b) | is_number(b)) & ~(open_(a) & open_(b))
    is_place = F.lower(unit) == "latlong"
    return F.when(enclosed & (n == 2) & is_number(a), quantity).when(enclosed & (n == 3) & is_place & lat.isNotNull() & lng.isNotNull(), place).when(enclosed & (n == 3) & ~is_place & good, span)


def with_complex_ids(pv: DataFrame) -> DataFrame:
    """``MCF_PV`` rows in which complex values are references to their nodes; those that can't be read stay."""
    c = pv.where("type = 'COMPLEX_VALUE'").withColumn("c", complex_value(F.col("value"))["id"])
    done = c.select("node_id", "prop", "pos", F.when(F.col("c").isNull(), F.col("type")).otherwise("RESOLVED_REF").alias("type"), F.coalesce("c", "value").alias("value"))
    return pv.where("type is distinct from 'COMPLEX_VALUE'").select("node_id", "prop", "pos", "type", "value").unionByName(done)


def complex_nodes(pv: DataFrame) -> DataFrame:
    """``MCF_PV`` rows of the nodes that complex values stand for."""
    c = pv.where("type = 'COMPLEX_VALUE'").select(complex_value(F.col("value")).alias("c")).where("c is not null").select("c.*").dropDuplicates(["id"])
    said = lambda p, t, v: F.struct(F.lit(p).alias("prop"), F.lit(t).alias("type") if isinstance(t, str) else t.alias("type"), v.alias("value"))
    kind = F.col("kind")
    end = lambda x: F.when(F.col(x) == "-", "TEXT").otherwise("NUMBER")
    facts = F.array(
        said("dcid", "TEXT", F.col("id")), said("name", "TEXT", F.col("name")), said("typeOf", "RESOLVED_REF", kind),
        *[F.when(kind == "GeoCoordinates", said(p, "TEXT", F.col(x))) for p, x in (("latitude", "a"), ("longitude", "b"))],
        F.when(kind == "Quantity", said("value", "NUMBER", F.col("a"))), F.when(kind == "Quantity", said("unitOfMeasure", "RESOLVED_REF", F.col("unit"))),
        *[F.when(kind == "QuantityRange", said(p, end(x), F.col(x))) for p, x in (("startValue", "a"), ("endValue", "b"))], F.when(kind == "QuantityRange", said("unit", "RESOLVED_REF", F.col("unit"))),
    )
    return c.select(F.col("id").alias("node_id"), F.explode(F.array_compact(facts)).alias("f")).select("node_id", "f.prop", F.lit(0).alias("pos"), "f.type", "f.value")


# definition and name of a variable
def constraints() -> Column:
    """The constraint properties of a node, sorted."""
    return F.array_sort(F.array_distinct(F.transform(F.filter("pvs", lambda x: ~x["prop"].isin(NOT_CONSTRAINTS)), lambda x: x["prop"])))


def definition() -> Column:
    core = []
    for short, p in (("md", "measurementDenominator"), ("mq", "measurementQualifier"), ("st", "statType"), ("mp", "measuredProperty"), ("pt", "populationType")):
        v = first_of(p)
        core.append(F.when((v != "") & ((v != "measuredValue") | F.lit(p != "statType")), F.concat(F.lit(f"{short}="), v)))
    own = F.transform(F.filter("pvs", lambda x: (x["pos"] == 0) & ~x["prop"].isin(NOT_CONSTRAINTS)), lambda x: F.concat(x["prop"], F.lit("="), strip_schema_prefix(x["value"])))
    return F.array_join(F.concat(F.array_compact(F.array(*core)), F.array_sort(own)), ",")


def format_token(x: Column) -> Column:
    v = F.replace(strip_schema_prefix(x), F.lit("_"), F.lit(" "))
    for pattern in (r"([a-z0-9])([A-Z])", r"([A-Z])([A-Z][a-z])", r"([a-zA-Z])([0-9])", r"([0-9])([a-zA-Z])"):
        v = F.regexp_replace(v, pattern, "$1 $2")
    words = F.split(F.trim(F.regexp_replace(v, r"\s+", " ")), " ")
    return F.array_join(F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 100_000))), " ")


OFTEN = ["daily", "weekly", "monthly", "quarterly", "annual"]


def with_variable_name(nodes: DataFrame, overrides: dict[str, str] | None = None) -> DataFrame:
    """Adds variable_name: prefixes, measure and population, qualifiers, constraints, denominator. Step by step, so that
    no part is worked out twice."""
    overrides = {"Count of Person": "Population"} if overrides is None else overrides
    out = nodes.withColumns({
        "nm_st": first_of("statType"), "nm_d": first_of("measurementDenominator"), "nm_mp": first_of("measuredProperty"), "nm_pt": first_of("populationType"),
        "nm_q": F.filter(F.flatten(F.transform(values_of("measurementQualifier"), lambda q: F.split(q, r"[,\s&]+"))), lambda x: x != ""), "nm_c": F.filter("pvs", lambda x: ~x["prop"].isin(NOT_CONSTRAINTS)),
    })
    st = F.col("nm_st")
    plain = (st == "") | F.lower(st).isin("measuredvalue", "dcid:measuredvalue")
    stem = F.when((F.length(st) > 5) & (st.endswith("Value") | st.endswith("value")), F.substring(st, F.lit(1), F.length(st) - 5)).otherwise(st)
    value = lambda x: F.lower(x["value"])
    shown = lambda x: F.concat(format_token(F.when(value(x).isin("true", "false"), x["prop"]).otherwise(x["value"])), F.when(value(x) == "false", " (False)").otherwise(""))
    d = F.col("nm_d")
    parts = F.array_join(F.transform(F.filter(F.split(d, "_"), lambda x: F.trim(x) != ""), format_token), " ")
    out = out.withColumns({
        "nm_first": F.when(plain, F.array().cast("array<string>")).otherwise(F.array(format_token(stem))), "nm_often": F.transform(F.filter("nm_q", lambda q: F.lower(q).isin(OFTEN)), format_token), "nm_rest": F.transform(F.filter("nm_q", lambda q: ~F.lower(q).isin(OFTEN)), format_token),
        "nm_m": format_token(F.col("nm_mp")), "nm_p": format_token(F.col("nm_pt")), "nm_held": F.filter(F.transform("nm_c", shown), lambda x: x != ""),
        "nm_of": F.when(d == "", "").when(F.lower(d).isin("count_person", "person"), "(Per capita)").otherwise(F.concat(F.lit("(As fraction of "), parts, F.lit(")"))),
    })
    m, p = F.col("nm_m"), F.col("nm_p")
    lm, lp = F.lower(m), F.lower(p)
    both = F.when(lp.isin("", "thing"), m).when(m == "", p).when(~lm.contains(lp) & ~lp.contains(lm), F.concat(m, F.lit(" of "), p)).when(lp.contains(lm) & (lp != lm), p).otherwise(m)
    out = out.withColumn("nm_both", both)
    both = F.col("nm_both")
    for a, b in overrides.items():
        both = F.when(F.col("nm_both") == a, b).otherwise(both)
    rest = F.when(F.size("nm_rest") > 0, F.concat(F.lit("("), F.array_join("nm_rest", " & "), F.lit(")"))).otherwise("")
    joined = lambda xs, by: F.array_join(F.filter(F.array(*xs), lambda x: x != ""), by)
    out = out.withColumn("nm_base", joined([F.array_join(F.concat("nm_first", "nm_often"), " "), both, rest], " "))
    out = out.withColumn("nm_named", joined([F.col("nm_base"), F.array_join("nm_held", ", ")], ": "))
    out = out.withColumn("variable_name", F.trim(joined([F.col("nm_named"), F.col("nm_of")], " ")))
    return out.drop(*[c for c in out.columns if c.startswith("nm_")])


def mutate(pv: DataFrame, base: bool = True) -> DataFrame:
    """``MCF_PV`` rows with complex values as references and their nodes added, values of old observations without
    blanks, commas and percent signs, and for variables their sorted constraintProperties, a definition (in the base
    graph) and a name, where they have none."""
    rows = pv.where("value is not null")
    kinds = rows.where("prop = 'typeOf'").groupBy("node_id").agg(F.max(F.col("value").endswith("Observation") & ~F.col("value").contains("StatVar")).alias("old"), F.max(F.col("value") == "StatisticalVariable").alias("is_sv"))
    is_value = F.col("prop").rlike("(?i)value$|^(value|growthRate|stdError|sampleSize|marginOfError|percentile[0-9]+)$")
    changed = with_complex_ids(rows).join(kinds, "node_id", "left")
    changed = changed.withColumn("value", F.when(F.coalesce("old", F.lit(False)) & is_value, F.regexp_replace("value", "[ ,%]", "")).otherwise(F.col("value")))
    sv = with_variable_name(gathered(changed.where("is_sv").select("node_id", "prop", "pos", "type", "value"))).withColumns({"own": constraints(), "has_definition": first_of("definition") != "", "has_name": first_of("name") != ""})
    text = lambda p, v: F.struct(F.lit(p).alias("prop"), F.lit(0).alias("pos"), F.lit("TEXT").alias("type"), v.alias("value"))
    added = F.concat(
        F.transform("own", lambda p, i: F.struct(F.lit("constraintProperties").alias("prop"), i.alias("pos"), F.lit("RESOLVED_REF").alias("type"), p.alias("value"))),
        F.array(text("definition", F.when(~F.col("has_definition") & F.lit(base), definition()))), F.array(text("name", F.when(~F.col("has_name"), F.col("variable_name")))),
    )
    new = sv.select("node_id", F.explode(added).alias("x")).select("node_id", "x.*").where("value <> ''")
    # given constraintProperties make way for the sorted ones
    mine = ~((F.col("prop") == "constraintProperties") & F.coalesce("is_sv", F.lit(False)) & F.coalesce("has_own", F.lit(False)))
    own = F.max(~F.col("prop").isin(NOT_CONSTRAINTS)).alias("has_own")
    kept = changed.join(rows.groupBy("node_id").agg(own), "node_id").where(mine)
    return kept.select("node_id", "prop", "pos", "type", "value").unionByName(new).unionByName(complex_nodes(pv))


# ids
def _by_prop() -> Column:
    """Values by property. The ids below look them up here instead of searching the node again and again."""
    props = F.array_distinct(F.transform("pvs", lambda x: x["prop"]))
    return F.map_from_entries(F.transform(props, lambda p: F.struct(p, F.transform(F.filter("pvs", lambda x: x["prop"] == p), lambda x: x["value"]))))


def _all(p: str) -> Column:
    return F.try_element_at(F.col("by_prop"), F.lit(p))


def _first(p: str) -> Column:
    return F.coalesce(F.get(_all(p), F.lit(0)), F.lit(""))


def _n(p: str) -> Column:
    return F.greatest(F.coalesce(F.size(_all(p)), F.lit(0)), F.lit(0))


def variable_key_text() -> Column:
    """``p=v`` of the fixed and constraint properties that have a single value, in order of property."""
    mine = F.filter(F.map_entries("by_prop"), lambda e: (e["key"].isin(FIXED) | ~e["key"].isin(NOT_CONSTRAINTS)) & (F.size(e["value"]) == 1))
    return F.array_join(F.array_sort(F.transform(mine, lambda e: F.concat(e["key"], F.lit("="), e["value"][0]))), "")


def _ordered_key(props: list[str], required: int, refs: list[str]) -> Column:
    parts, bad = [], F.lit(False)
    for i, p in enumerate(props):
        bad = bad | (_n(p) > 1 if i > required else _n(p) != 1)
        if p in refs:
            bad = bad | _first(p).startswith("l:")
        parts.append(F.when(_n(p) == 1, F.concat(F.lit(f"{p}="), _first(p))).otherwise(""))
    return F.when(~bad, F.concat(*parts))


def observation_key_text() -> Column:
    return _ordered_key(OBSERVATION_KEY, 3, ["observationAbout", "variableMeasured"])


def old_observation_key_text() -> Column:
    return _ordered_key(OLD_KEY, 2, ["location"])


def population_key_text() -> Column:
    named = F.coalesce(_all("constraintProperties"), F.array().cast("array<string>"))
    mine = F.filter(F.map_entries("by_prop"), lambda e: ~e["key"].isin(NOT_CONSTRAINTS) & ((F.size(named) == 0) | F.array_contains(named, e["key"])))
    own = F.array_sort(F.transform(mine, lambda e: F.concat(e["key"], e["value"][0])))
    ok = (_first("populationType") != "") & (_first("location") != "") & ~_first("location").startswith("l:")
    return F.when(ok, F.concat(_first("populationType"), _first("location"), _first("memberOf"), F.array_join(own, "")))


def place_dcid() -> Column:
    renamed = {"isoCode": "iso", "nutsCode": "nuts"}
    return F.coalesce(*[F.when(_first(p) != "", F.concat(F.lit(renamed.get(p, p) + "/"), _first(p))) for p in PLACE_IDS])


def keyed(pv: DataFrame) -> DataFrame:
    """Gathered nodes, complex values by their ids, with kind, key_text and dcid: given, generated from the key, or of
    a place's external id; else null."""
    nodes = gathered(with_complex_ids(pv)).withColumn("by_prop", _by_prop())
    nodes = nodes.withColumns({"first_type": _first("typeOf"), "given_dcid": _first("dcid")})
    t = F.col("first_type")
    kind = F.when(t == "StatVarObservation", "OBSERVATION").when(t == "StatisticalVariable", "VARIABLE").when(t.endswith("Population"), "POPULATION").when(t.endswith("Observation"), "OLD_OBSERVATION").when(t.isin(PLACES), "PLACE").otherwise("OTHER")
    out = nodes.withColumn("kind", kind)
    of = {"OBSERVATION": observation_key_text(), "VARIABLE": variable_key_text(), "POPULATION": population_key_text(), "OLD_OBSERVATION": old_observation_key_text()}
    text = F.lit(None).cast("string")
    for name, key in of.items():
        text = F.when(F.col("kind") == name, key).otherwise(text)
    out = out.withColumn("key_text", text).withColumn("hashed", generated_id("key_text"))
    name = F.element_at(F.create_map(*[F.lit(x) for x in ("OBSERVATION", "dc/o/", "VARIABLE", "dc/", "POPULATION", "dc/p/", "OLD_OBSERVATION", "dc/o/", "PLACE", "", "OTHER", "")]), F.col("kind"))
    made = F.concat(name, F.substring("hashed", 4, 100))
    dcid = F.when(F.col("given_dcid") != "", F.col("given_dcid")).when(F.col("key_text").isNotNull(), made).when(F.col("kind") == "PLACE", place_dcid())
    return out.withColumn("dcid", dcid).drop("by_prop", "first_type", "hashed")


# resolution
def resolve_local(pv: DataFrame, rounds: int = 50) -> tuple[DataFrame, DataFrame]:
    """(``MCF_PV`` of resolved nodes, (node_id, error) of failed ones).

    In turn, local references are replaced by the ids of their nodes, and nodes whose references are all resolved get
    ids; until nothing changes. A reference to a node that isn't there, or that failed, fails its node. Every round is
    a join on the few columns of references, written to the shared folder."""
    current = saved(pv.where("value is not null"), "resolve")
    failed = None
    for _ in range(rounds):
        local = F.col("type").isin("UNRESOLVED_REF") & F.col("value").startswith("l:")
        open_ = F.exists("pvs", lambda x: (x["type"] == "UNRESOLVED_REF") & x["value"].startswith("l:"))
        known_ids = keyed(current).withColumns({"open": open_, "given": F.col("given_dcid") != ""})
        strict = F.col("kind").isin("OBSERVATION", "POPULATION", "OLD_OBSERVATION")
        ids = saved(known_ids.select("node_id", F.when(~(F.col("open") & strict) | F.col("given"), F.col("dcid")).alias("id"), F.col("given").alias("had"), "open", "key_text"), "ids")
        refs = current.where(local).select(F.col("node_id").alias("src"), F.col("value").alias("ref")).distinct()
        # a node that has no id now and nothing open can't get one later
        dead = ids.where("id is null and not open").select("node_id", F.lit("no id can be made").alias("error"))
        orphan = refs.join(ids, refs.ref == ids.node_id, "left_anti").select(F.col("src").alias("node_id"), F.concat(F.lit("no such node: "), "ref").alias("error"))
        to_dead = refs.join(dead.select(F.col("node_id").alias("ref")), "ref").select(F.col("src").alias("node_id"), F.concat(F.lit("reference to a failed node: "), "ref").alias("error"))
        bad = saved(dead.unionByName(orphan).unionByName(to_dead).groupBy("node_id").agg(F.min("error").alias("error")), "failed")
        n_bad = bad.count()
        failed = bad if failed is None else failed.unionByName(bad)
        got = ids.where("id is not null and not had").join(bad, "node_id", "left_anti")
        known = ids.where("id is not null").select(F.col("node_id").alias("ref"), "id").join(bad.select(F.col("node_id").alias("ref")), "ref", "left_anti")
        rest = current.join(bad, "node_id", "left_anti")
        linked = rest.join(known, local & (F.col("value") == F.col("ref")), "left")
        moved = linked.select("node_id", "prop", "pos", F.when(F.col("ref").isNotNull(), "RESOLVED_REF").otherwise(F.col("type")).alias("type"), F.coalesce("id", "value").alias("value"), F.col("ref").isNotNull().alias("changed"))
        extra = got.select("node_id", F.lit("dcid").alias("prop"), F.lit(0).alias("pos"), F.lit("TEXT").alias("type"), F.col("id").alias("value"), F.lit(True).alias("changed"))
        key = got.where("key_text is not null").select("node_id", F.lit("keyString").alias("prop"), F.lit(0).alias("pos"), F.lit("TEXT").alias("type"), F.col("key_text").alias("value"), F.lit(True).alias("changed"))
        new = saved(moved.unionByName(extra).unionByName(key), "resolve")
        n = new.where("changed").count() + n_bad
        current = new.drop("changed")
        if not n:
            break
    left = current.where("type = 'UNRESOLVED_REF' and value like 'l:%'").groupBy("node_id").agg(F.concat(F.lit("reference left: "), F.min("value")).alias("error"))
    left = saved(left, "failed")
    return current.join(left, "node_id", "left_anti"), failed.unionByName(left)


def external_ids(pv: DataFrame, mapping: DataFrame) -> DataFrame:
    """node_id, dcid, error of nodes without a dcid that have external ids of places; ``mapping`` has prop, value,
    dcid, such as from nodes of the same graph (``local_mapping``). Ids that lead to unlike nodes are an error; of
    properties the first in order of preference counts."""
    rank = F.array_position(F.array(*[F.lit(p) for p in PLACE_IDS]), F.col("prop"))
    has = pv.where("prop = 'dcid'").select("node_id").distinct()
    asked = pv.where(F.col("prop").isin(PLACE_IDS)).join(has, "node_id", "left_anti").select("node_id", "prop", "value", rank.alias("rank"))
    found = asked.join(mapping.select("prop", "value", "dcid").distinct(), ["prop", "value"])
    return found.groupBy("node_id").agg(F.min_by("dcid", "rank").alias("first"), F.count_distinct("dcid").alias("n")).select("node_id", F.when(F.col("n") == 1, F.col("first")).alias("dcid"), F.when(F.col("n") > 1, "diverging ids").alias("error"))


def local_mapping(pv: DataFrame) -> DataFrame:
    ids = pv.where("prop = 'dcid'").groupBy("node_id").agg(F.min("value").alias("dcid"))
    return pv.where(F.col("prop").isin(PLACE_IDS)).join(ids, "node_id").select("prop", "value", "dcid").distinct()


def coordinate_mapping(pv: DataFrame) -> DataFrame:
    """node_id, key (``lat#lng``) of nodes with coordinates; their resolution is a join with a table of such keys."""
    at = lambda p: F.max(F.when(F.col("prop") == p, F.col("value")))
    return pv.groupBy("node_id").agg(at("latitude").alias("lat"), at("longitude").alias("lng")).where("lat is not null and lng is not null").select("node_id", F.concat("lat", F.lit("#"), "lng").alias("key"))


def resolve_names(pv: DataFrame, names: DataFrame) -> DataFrame:
    """node_id, dcid of nodes by name and type; ``names`` has name, type, dcid. The first id in order counts."""
    at = lambda p: F.min(F.when(F.col("prop") == p, F.col("value")))
    asked = pv.groupBy("node_id").agg(at("name").alias("name"), at("typeOf").alias("type"), at("dcid").alias("own")).where("own is null and name is not null")
    return asked.join(names, ["name", "type"]).groupBy("node_id").agg(F.min("dcid").alias("dcid"))
