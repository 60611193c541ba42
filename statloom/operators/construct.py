"""From parsed nodes (``MCF_PV``) to the tables of the graph: nodes, edges, series and observations.

Property values are gathered once by node; everything else is a projection of the gathered rows. Of several values the
first by position counts where one is asked for.
"""

from __future__ import annotations

import gzip

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BinaryType

from statloom.functions.facets import AGGREGATE
from statloom.functions.ids import literal_key, unsigned_fingerprint
from statloom.functions.numbers import format_number, strip_schema_prefix

BYTES = ["geoJsonCoordinates", "geoJsonCoordinatesDP1", "geoJsonCoordinatesDP2", "geoJsonCoordinatesDP3", "kmlCoordinates"]
MOST_CHARS = 2_621_440
MOST_BYTES = 10 << 20
OBSERVATION_PROPS = ["variableMeasured", "observationAbout", "observationDate", "value", "measurementMethod", "observationPeriod", "unit", "scalingFactor", "provenanceUrl"]


@F.pandas_udf(BinaryType())
def gzipped(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else gzip.compress(x.encode(), mtime=0))


def gathered(pv: DataFrame) -> DataFrame:
    """node_id, pvs: array of (prop, pos, type, value), in this order."""
    return pv.where("value is not null").groupBy("node_id").agg(F.array_sort(F.collect_list(F.struct("prop", "pos", "type", "value"))).alias("pvs"))


def values_of(prop: str) -> Column:
    return F.transform(F.filter("pvs", lambda x: x["prop"] == prop), lambda x: x["value"])


def first_of(prop: str) -> Column:
    """The first value of a property, empty where there is none."""
    return F.coalesce(F.get(values_of(prop), F.lit(0)), F.lit(""))


def is_observation() -> Column:
    return first_of("typeOf").contains("StatVarObservation")


def subject() -> Column:
    return F.when(first_of("dcid") != "", first_of("dcid")).otherwise(strip_schema_prefix("node_id"))


def split_observations(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(observations, all other nodes) of gathered nodes."""
    return nodes.where(is_observation()), nodes.where(~is_observation())


def _facts(nodes: DataFrame) -> DataFrame:
    """subject, prop, type, value, key and packed bytes of what nodes say, without literals that are too large."""
    rows = nodes.where(~is_observation()).select(subject().alias("subject"), F.explode("pvs").alias("x")).select("subject", "x.prop", "x.type", "x.value").where("prop <> 'dcid'")
    packs = F.col("prop").isin(BYTES) & (F.col("type") != "RESOLVED_REF")
    plain = rows.where(~packs).withColumn("bytes", F.lit(None).cast("binary")).where((F.col("type") == "RESOLVED_REF") | (F.length("value") <= MOST_CHARS))
    packed = rows.where(packs).withColumn("bytes", gzipped("value")).where(F.octet_length("bytes") <= MOST_BYTES)
    return plain.unionByName(packed)


def graph_to_nodes(nodes: DataFrame) -> DataFrame:
    """subject_id, value, bytes, name, types: a row for each node and one for each literal, which has no name or types."""
    types = F.when(F.size(values_of("typeOf")) > 0, values_of("typeOf")).otherwise(F.array(F.lit("Thing")))
    own = nodes.where(~is_observation()).select(subject().alias("subject_id"), subject().alias("value"), F.lit(None).cast("binary").alias("bytes"), F.when(first_of("name") != "", first_of("name")).otherwise(subject()).alias("name"), types.alias("types"))
    literal = _facts(nodes).where("type <> 'RESOLVED_REF'")
    literal = literal.select(literal_key("value").alias("subject_id"), F.when(F.col("bytes").isNull(), F.col("value")).alias("value"), "bytes", F.lit(None).cast("string").alias("name"), F.lit(None).cast("array<string>").alias("types"))
    return own.unionByName(literal.dropDuplicates(["subject_id"]))


def graph_to_edges(nodes: DataFrame, provenance: str) -> DataFrame:
    """An edge for each property value; literals are named by their key."""
    to = F.when(F.col("type") == "RESOLVED_REF", strip_schema_prefix("value")).otherwise(literal_key("value"))
    return _facts(nodes).select(F.col("subject").alias("subject_id"), F.col("prop").alias("predicate"), to.alias("object_id"), F.lit(provenance).alias("provenance"))


def observations(nodes: DataFrame, import_name: str, plain: str = "PlainAggregate", lenient: bool = False) -> DataFrame:
    """Points as written: variable_measured, entity1, extra_entities_id, date, value, method, period, unit, scaling,
    is_aggregate, facet_id, provenance_url. The entities are those of observationProperties, sorted, else
    observationAbout; an observation without one fails, or is left out where ``lenient``."""
    props = F.array_sort(values_of("observationProperties"))
    of = lambda p: F.coalesce(F.get(F.transform(F.filter("pvs", lambda x: x["prop"] == p), lambda x: x["value"]), F.lit(0)), F.lit(""))
    rows = nodes.where(is_observation()).select("node_id", F.when(F.size(props) > 0, F.transform(props, of)).otherwise(F.array(first_of("observationAbout"))).alias("entities"), *[first_of(p).alias(p) for p in OBSERVATION_PROPS if p != "observationAbout"])
    whole = ~F.exists("entities", lambda e: e == "")
    if lenient:
        rows = rows.where(whole)
    else:
        rows = rows.withColumn("entities", F.when(whole, F.col("entities")).otherwise(F.raise_error(F.concat(F.lit("observation without an entity: "), "node_id")).cast("array<string>")))
    m = F.col("measurementMethod")
    aggregate = m.startswith(AGGREGATE) | (m == plain)
    bare = F.replace(m, F.lit(AGGREGATE), F.lit(""))
    method = F.when(m.startswith(AGGREGATE), F.when(bare == plain, "").otherwise(bare)).when(m == plain, "").otherwise(m)
    rows = rows.select(
        F.col("variableMeasured").alias("variable_measured"), F.get("entities", F.lit(0)).alias("entity1"), F.array_join(F.slice("entities", 2, 1000), "^").alias("extra_entities_id"), F.col("observationDate").alias("date"), "value",
        method.alias("method"), F.col("observationPeriod").alias("period"), "unit", F.col("scalingFactor").alias("scaling"), aggregate.alias("is_aggregate"), F.col("provenanceUrl").alias("provenance_url"),
    )
    text = F.concat_ws("^", F.lit(import_name), "method", "period", "scaling", "unit", F.col("is_aggregate").cast("string"))
    return rows.withColumn("facet_id", unsigned_fingerprint(text))


KEY = ["variable_measured", "entity1", "extra_entities_id", "facet_id"]


def facet_json(provenance: Column) -> Column:
    """Facet as JSON: blank fields are left out, the flag is always there."""
    filled = lambda c: F.when(F.trim(c) != "", c)
    return F.to_json(F.struct(filled(F.col("method")).alias("measurementMethod"), filled(F.col("period")).alias("observationPeriod"), filled(F.col("unit")).alias("unit"), filled(F.col("scaling")).alias("scalingFactor"), filled(provenance).alias("provenance"), F.col("is_aggregate").alias("isDcAggregate")))


def time_series(points: DataFrame, provenance: str) -> DataFrame:
    """Distinct series, of rows of ``observations``, with their entities and facet as JSON."""
    extra = F.when(F.col("extra_entities_id") != "", F.split("extra_entities_id", r"\^"))
    entities = F.to_json(F.struct("entity1", F.get(extra, F.lit(0)).alias("entity2"), F.get(extra, F.lit(1)).alias("entity3")))
    return points.dropDuplicates(KEY).select(*KEY, entities.alias("entities"), facet_json(F.lit(provenance)).alias("facet"))


def optimised_series(points: DataFrame) -> DataFrame:
    """A row for each series: its key and its observations in order of date, numbers apart from texts."""
    one = F.struct("date", F.col("value").try_cast("double").alias("number"), F.when(F.col("value").try_cast("double").isNull(), F.col("value")).alias("text"))
    keys = ["variable_measured", "entity1", "extra_entities_id", "method", "period", "scaling", "unit", "is_aggregate", "facet_id"]
    return points.groupBy(*keys).agg(F.array_sort(F.collect_list(one)).alias("observations"))


def flatten_series(series: DataFrame) -> DataFrame:
    """The observations of optimised series, a row each; numbers are written without needless digits."""
    rest = [c for c in series.columns if c != "observations"]
    return series.select(*rest, F.explode("observations").alias("o")).select(*rest, "o.date", F.coalesce(format_number("o.number"), "o.text").alias("value"))


def combine_nodes(pv: DataFrame) -> DataFrame:
    """Nodes with one id made one: the id is the dcid where there is one; values that differ in their prefix only count
    once; the type Place goes where there is another; values are sorted. As ``MCF_PV``.

    The id travels with the rows by one aggregation of the dcids; equal values are dropped before values meet."""
    dcids = pv.where("prop = 'dcid' and value <> ''").groupBy("node_id").agg(F.min_by("value", "pos").alias("dcid"))
    named = pv.where("value is not null").join(dcids, "node_id", "left").select(F.coalesce(strip_schema_prefix("dcid"), strip_schema_prefix("node_id")).alias("node_id"), strip_schema_prefix("prop").alias("prop"), "type", "value")
    once = named.groupBy("node_id", "prop", strip_schema_prefix("value").alias("bare")).agg(F.min(F.struct("value", "type")).alias("v"))
    all_ = F.array_sort(F.collect_list("v"))
    merged = once.groupBy("node_id", "prop").agg(all_.alias("vs"))
    place = lambda v: strip_schema_prefix(v["value"]) == "Place"
    other = F.exists("vs", lambda v: ~place(v))
    kept = F.when((F.col("prop") == "typeOf") & other, F.filter("vs", lambda v: ~place(v))).otherwise(F.col("vs"))
    return merged.select("node_id", "prop", F.posexplode(kept).alias("pos", "v")).select("node_id", "prop", F.col("pos").cast("int").alias("pos"), "v.type", "v.value")


def sharded(rows: DataFrame, shards: int, by_object: bool = False) -> DataFrame:
    """Rows spread over ``shards`` writers: those of a subject together, or, where a subject may have very many rows,
    those of a subject and a part of its objects."""
    keys = [F.col("subject_id")] + ([F.pmod(F.xxhash64("object_id"), F.lit(shards))] if by_object else [])
    return rows.repartition(shards, *keys)
