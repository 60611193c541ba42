"""Checks of series and of graph nodes. Every check gives the rows at fault, so that ``counters`` can count them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from statloom.functions.numbers import is_boolean, is_number, month_gap, parse_date
from statloom.plans.storage import tasks
from statloom.sources.mcf import REFERENCES

SERIES = ["variable", "entity", "extra", "method", "period", "unit", "scaling"]
SMALL = 1e-6


def inconsistent_values(points: DataFrame) -> DataFrame:
    """Dates of a series that have several values."""
    return points.groupBy(*SERIES, "date").agg(F.count_distinct("value").alias("n_values")).where("n_values > 1")


def value_type(text: str | Column) -> Column:
    return F.when(is_number(text) | is_boolean(text), "NUMBER").otherwise("TEXT")


def mixed_types(observations: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """Series whose values are of several types, and which."""
    return observations.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.array_sort(F.collect_set(value_type(value))).alias("types")).where(F.size("types") > 1)


def beyond_sigma(points: DataFrame, k: float = 3.0) -> DataFrame:
    """Points further than ``k`` population standard deviations from their series' mean; series that don't vary, or
    have a single point, are left out."""
    w = Window.partitionBy(*SERIES)
    stats = points.where("value is not null").withColumns({"mean": F.avg("value").over(w), "sd": F.stddev_pop("value").over(w), "n": F.count("*").over(w)})
    return stats.where((F.col("n") >= 2) & (F.col("sd") > 0) & (F.abs(F.col("value") - F.col("mean")) > k * F.col("sd")))


def largest_change(points: DataFrame, warn: float = 1.0, alarm: float = 5.0) -> DataFrame:
    """The largest relative change between successive dates of each series and its level; a series with a date that has
    several values is left out. A value of 0 before counts as 1e-6; the first of equal changes is given."""
    w = Window.partitionBy(*SERIES).orderBy("date")
    one = points.where("value is not null").groupBy(*SERIES, "date").agg(F.count_distinct("value").alias("k"), F.min("value").alias("value"))
    one = one.withColumn("bad", F.max("k").over(Window.partitionBy(*SERIES))).where("bad = 1")
    moved = one.withColumn("before", F.lag("value").over(w)).where("before is not null")
    change = F.abs((F.col("value") - F.col("before")) / F.when(F.col("before") == 0, F.lit(SMALL)).otherwise(F.col("before")))
    moved = moved.withColumn("change", F.round(change, 6))
    first = moved.groupBy(*SERIES).agg(F.max("change").alias("change"), F.max_by("date", F.struct("change", -F.unix_timestamp(parse_date("date")))).alias("date"))
    return first.withColumn("level", F.when(F.col("change") > alarm, "ALARM").when(F.col("change") > warn, "WARNING").otherwise("FINE"))


def invalid_dates(points: DataFrame) -> DataFrame:
    return points.where(parse_date("date").isNull())


def mixed_granularity(points: DataFrame) -> DataFrame:
    """Lengths of dates other than a series' most common one (of equally common ones the longest), with their number."""
    n = points.groupBy(*SERIES, F.length("date").alias("length")).agg(F.count("*").alias("n"))
    w = Window.partitionBy(*SERIES).orderBy(F.desc("n"), F.desc("length"))
    return n.withColumn("rank", F.row_number().over(w)).where("rank > 1").drop("rank")


def holes(points: DataFrame) -> DataFrame:
    """Dates at which the gap in months to the date before isn't the gap before that."""
    w = Window.partitionBy(*SERIES).orderBy("date")
    dated = points.select(*SERIES, "date").distinct().withColumn("at", parse_date("date")).where("at is not null")
    gaps = dated.withColumn("gap", month_gap(F.lag("at").over(w), "at")).withColumn("gap_before", F.lag("gap").over(w))
    return gaps.where("gap <> gap_before").drop("at")


def duplicates(observations: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that come with unlike values, compared as 32-bit floats."""
    return observations.groupBy(*keys).agg(F.count_distinct(F.col("value").try_cast("float")).alias("n_values")).where("n_values > 1")


def variable_summary(points: DataFrame) -> DataFrame:
    return points.groupBy("variable").agg(
        F.count("*").alias("n_points"), F.min("value").alias("min_value"), F.max("value").alias("max_value"), F.count_distinct("entity").alias("n_places"), F.count_distinct("date").alias("n_dates"),
        F.array_sort(F.collect_set("method")).alias("methods"), F.array_sort(F.collect_set("unit")).alias("units"), F.array_sort(F.collect_set("period")).alias("periods"), F.array_sort(F.collect_set("scaling")).alias("scalings"),
    )


def place_series(points: DataFrame) -> DataFrame:
    """Each series with its points in order of date."""
    return points.groupBy(*SERIES).agg(F.array_sort(F.collect_list(F.struct("date", "value"))).alias("points"))


def sample_places(points: DataFrame, fine: int = 5, coarse: int = 25) -> DataFrame:
    """The first places, by id, of each namespace; of those with nested ids the first of each length of id."""
    p = points.select("entity").distinct().withColumn("namespace", F.when(F.col("entity").contains("/"), F.split("entity", "/")[0]).otherwise(""))
    nested = F.col("namespace").isin("geoId", "nuts")
    p = p.withColumn("length", F.when(nested, F.length("entity")).otherwise(0))
    w = Window.partitionBy("namespace", "length").orderBy("entity")
    return p.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= F.when(nested, fine).otherwise(coarse)).select("namespace", "entity")


def node_errors(pv: DataFrame) -> DataFrame:
    """node_id, counter of nodes that break the common rules; ``pv`` as the node parser gives it.

    Rows are exchanged before they are gathered by node: what a scan's task makes of a small file can be very much,
    and gathering there would sort it all at once, while tasks behind an exchange are many."""
    per = pv.repartition(tasks(pv.sparkSession), "node_id").groupBy("node_id").agg(
        F.count_if(F.col("prop") == "typeOf").alias("n_type"), F.min(F.when(F.col("prop") == "dcid", F.col("value"))).alias("first_dcid"), F.max(F.when(F.col("prop") == "dcid", F.length("value"))).alias("dcid_length"),
        F.max(F.coalesce((F.col("prop") == "dcid") & ~F.col("value").rlike(r"^[A-Za-z0-9_&/%\-+().~:*]*$"), F.lit(False))).alias("bad_dcid"),
        F.max(~F.col("prop").rlike("^[a-z]")).alias("bad_prop"), F.max((F.col("type") == "RESOLVED_REF") & F.col("value").rlike(r"[^\x00-\x7f]")).alias("wide_ref"), F.max(F.col("type") == "ERROR").alias("unparsed"),
        F.max(F.when(F.col("prop") == "typeOf", F.col("value"))).alias("type"), F.count_if(F.col("prop") == "value").alias("n_value"), F.count_if((F.col("prop") == "observationDate") & parse_date("value").isNotNull()).alias("n_date"),
        F.count_if(F.col("prop") == "variableMeasured").alias("n_variable"), F.count_if(F.col("prop") == "observationAbout").alias("n_about"),
        F.count_if((F.col("prop") == "value") & ~is_number("value")).alias("n_text"), F.max(F.when(F.col("prop") == "name", F.col("value"))).alias("name"), F.max(F.when(F.col("prop") == "dcid", F.col("value"))).alias("dcid"),
        *[F.count_if(F.col("prop") == p).alias(f"n_{p}") for p in ("name", "subClassOf", "populationType", "measuredProperty", "statType", "location", "observedNode", "observationDate")],
        F.max(F.col("prop").isin(REFERENCES) & F.col("type").isin("TEXT", "NUMBER")).alias("loose_ref"), F.max(F.when(F.col("prop").isin("populationType", "typeOf"), F.col("value").rlike("^[a-z]"))).alias("small_class"),
        F.max(F.when(F.col("prop").isin("measuredProperty", "statType"), F.col("value").rlike("^[A-Z]"))).alias("large_prop"),
    )
    observation = F.coalesce(F.col("type").contains("StatVarObservation"), F.lit(False))
    rules = {
        "Sanity_MissingTypeOf": F.col("n_type") == 0, "Sanity_MultipleDcid": F.col("first_dcid") < F.col("dcid"), "Sanity_LongDcid": F.col("dcid_length") > 256, "Sanity_InvalidDcid": F.col("bad_dcid"), "Sanity_PropertyCase": F.col("bad_prop"),
        "Sanity_NonAsciiReference": F.col("wide_ref"), "Sanity_Unparsed": F.col("unparsed"), "Sanity_ObservationValue": observation & (F.col("n_value") != 1), "Sanity_ObservationDate": observation & (F.col("n_date") != 1),
        "Sanity_ObservationNumber": observation & (F.col("n_text") > 0), "Sanity_ReferenceType": F.col("loose_ref"), "Sanity_ClassCase": F.coalesce("small_class", F.lit(False)),
        "Sanity_VariableProps": (F.col("type") == "StatisticalVariable") & ((F.col("n_populationType") != 1) | (F.col("n_measuredProperty") != 1) | (F.col("n_statType") != 1)), "Sanity_PropertyValueCase": (F.col("type") == "StatisticalVariable") & F.coalesce("large_prop", F.lit(False)),
        "Schema_NameIsDcid": F.col("type").isin("Class", "Property") & ((F.col("n_name") != 1) | (F.col("name") != F.coalesce("dcid", F.col("node_id")))), "Schema_ClassInit": (F.col("type") == "Class") & ~F.coalesce(F.col("name").rlike("^[A-Z]"), F.lit(True)),
        "Schema_PropertyInit": (F.col("type") == "Property") & ~F.coalesce(F.col("name").rlike("^[a-z]"), F.lit(True)), "Schema_SubClassOf": (F.col("type") == "Class") & (F.col("n_subClassOf") == 0),
        "Legacy_PopulationProps": F.coalesce(F.col("type").endswith("Population"), F.lit(False)) & ((F.col("n_populationType") != 1) | (F.col("n_location") != 1)),
        "Legacy_ObservationProps": F.coalesce(F.col("type").endswith("Observation") & ~observation, F.lit(False)) & ((F.col("n_observedNode") != 1) | (F.col("n_observationDate") != 1) | (F.col("n_measuredProperty") != 1)),
        "Sanity_ObservationVariable": observation & (F.col("n_variable") != 1), "Sanity_ObservationAbout": observation & (F.col("n_about") != 1),
    }
    found = F.array_compact(F.array(*[F.when(v, F.lit(k)) for k, v in rules.items()]))
    return per.select("node_id", F.explode(found).alias("counter"))


def missing_references(pv: DataFrame, known: DataFrame) -> DataFrame:
    """References to nodes that neither the graph nor ``known`` (subject_id) has."""
    refs = pv.where("type = 'RESOLVED_REF'").select("node_id", "prop", "value").distinct()
    own = pv.where("prop = 'dcid'").select(F.col("value")).union(pv.select("node_id")).union(known.select("subject_id")).distinct()
    return refs.join(own, "value", "left_anti")


def curated_conflicts(pairs: DataFrame) -> DataFrame:
    """Curated ids with several generated ones, and the reverse; ``pairs`` has curated, generated."""
    a = pairs.groupBy(F.col("curated").alias("id")).agg(F.count_distinct("generated").alias("n"))
    b = pairs.groupBy(F.col("generated").alias("id")).agg(F.count_distinct("curated").alias("n"))
    return a.unionByName(b).where("n > 1")


def counters(found: DataFrame, message: str = "node_id", most: int = 30) -> DataFrame:
    """counter, n and the first messages of each. Equal messages count together first, and every task hands on only its
    first ``most`` of a counter, so no task holds all messages."""
    per = found.select("counter", F.col(message).alias("message")).repartition(tasks(found.sparkSession), "counter", "message").groupBy("counter", "message").agg(F.count("*").alias("n"))
    w = Window.partitionBy("counter").orderBy("message")
    first = per.where("message is not null and n > 0").withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= most)
    first = first.groupBy(F.col("counter").alias("c")).agg(F.array_sort(F.collect_list("message")).alias("examples"))
    n = per.groupBy("counter").agg(F.sum("n").alias("n"))
    none = F.array().cast(first.schema["examples"].dataType)
    return n.join(first, n["counter"].eqNullSafe(first["c"]), "left").select("counter", "n", F.coalesce("examples", none).alias("examples"))
