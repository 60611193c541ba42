"""Tables of files made into flat observations and triples.

Cells are read as text. Observations have the ten columns ``FLAT``; triples are (subject_id, predicate, object_id,
object_value), one of the last two empty.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from statloom.functions.numbers import is_number, strip_namespace
from statloom.plans.storage import tasks

FLAT = ["entity", "variable", "date", "value", "provenance", "unit", "scaling_factor", "measurement_method", "observation_period", "properties"]
PROPS = ["unit", "scaling_factor", "measurement_method", "observation_period"]
#: Cells that stand for a missing value: those of the table reader, and some more.
NA = ["", "#N/A N/A", *"- nil na none <na> <NA> NA N/A #NA #N/A n/a None NULL null nan NaN -nan -NaN 1.#IND -1.#IND 1.#QNAN -1.#QNAN".split()]
STANDARD = {
    "observationAbout": "entity", "variableMeasured": "variable", "observationDate": "date", "value": "value", "unit": "unit", "scalingFactor": "scaling_factor", "measurementMethod": "measurement_method", "observationPeriod": "observation_period",
}
PREFIXES = {"dcid": "", "countryalpha3code": "country/", "geoid": "geoId/"}
ID_PATTERN = re.compile(r"(?:[A-Za-z0-9_/]+:)?[A-Za-z0-9_/]+")


@dataclass
class Properties:
    """Defaults of a file's observations; ``custom`` ones go to the JSON column."""

    unit: str = ""
    scaling_factor: str = ""
    measurement_method: str = ""
    observation_period: str = ""
    custom: dict[str, str] = field(default_factory=dict)


def read_table(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """A CSV as text columns; blanks at the beginning of cells go, and so does a byte-order mark."""
    df = spark.read.option("header", "true").option("sep", sep).option("ignoreLeadingWhiteSpace", "true").option("escape", '"').option("multiLine", "true").csv(path)
    return df.toDF(*[c.lstrip("﻿").strip() for c in df.columns])


def cell(column: str, na: list[str] | None = None) -> Column:
    """Text of a cell, null where it stands for a missing value."""
    c = F.trim(F.col(f"`{column}`").cast("string"))
    return F.when(~c.isin(NA if na is None else na), c)


def _numeric(value: Column, strict: bool) -> Column:
    """Values without thousands separators; a text that is no number fails where ``strict``."""
    v = F.when(value.rlike(r"^[+-]?\d{1,3}(,\d{3})+(\.\d+)?$"), F.replace(value, F.lit(","), F.lit(""))).otherwise(value)
    if not strict:
        return v
    return F.when(v.isNull() | is_number(v), v).otherwise(F.raise_error(F.concat(F.lit("a value that is no number: "), v)).cast("string"))


def _finished(df: DataFrame, provenance: str) -> DataFrame:
    strip = [strip_namespace(c).alias(c) if c in ("entity", "variable", "provenance", "unit", "measurement_method") else F.col(c) for c in FLAT]
    return df.where(F.col("value").isNotNull() & (F.col("value") != "") & (F.col("value") != "<NA>")).withColumn("provenance", F.lit(provenance)).select(strip)


def wide_to_long(df: DataFrame, provenance: str, entity: str | None = None, date: str | None = None, ignored: list[str] | None = None, variables: dict[str, str] | None = None, props: Properties | None = None, strict: bool = True, na: list[str] | None = None) -> DataFrame:
    """Flat observations of a table with a column for each variable; the first column is the entity and the second the
    date unless named. Missing values give nothing."""
    props, ignored = props or Properties(), ignored or []
    columns = [c for c in df.columns if c not in ignored]
    entity = entity or columns[0]
    date = date or columns[1]
    rest = [c for c in columns if c not in (entity, date)]
    slim = df.select(F.trim(F.col(f"`{entity}`").cast("string")).alias("entity"), F.col(f"`{date}`").cast("string").alias("date"), *[cell(c, na).alias(f"v{i}") for i, c in enumerate(rest)])
    names = {f"v{i}": (variables or {}).get(c, variable_id(c)) for i, c in enumerate(rest)}
    pairs = [F.struct(F.lit(n).alias("variable"), F.col(v).alias("value")) for v, n in names.items()]
    long = slim.select("entity", "date", F.explode(F.array(*pairs)).alias("p")).select("entity", "date", "p.variable", "p.value").where("value is not null")
    fixed = {p: F.lit(getattr(props, p)) for p in PROPS} | {"value": _numeric(F.col("value"), strict), "properties": F.to_json(F.create_map(*[F.lit(x) for kv in props.custom.items() for x in kv])) if props.custom else F.lit("{}")}
    return _finished(long.withColumns(fixed), provenance)


def header_errors(mappings: dict[str, str], columns: list[str], ignored: list[str] | None = None) -> list[str]:
    """What is wrong with a mapping of properties to columns of a long table, or with the table."""
    of = {strip_name(k): v for k, v in mappings.items()}
    out = [f"no mapping for {k}" for k in ("variableMeasured", "observationDate", "value") if k not in of]
    dims = [k for k in of if STANDARD.get(k, "entity") == "entity"]
    if not dims:
        out.append("no entity: map observationAbout or a dimension")
    if len(dims) > 3:
        out.append(f"{len(dims)} dimensions of at most 3")
    if out:
        return out
    if missing := sorted(set(of.values()) - set(columns)):
        out.append(f"columns not there: {missing}")
    if more := sorted(set(columns) - set(of.values()) - set(ignored or [])):
        out.append(f"columns neither mapped nor ignored: {more}")
    return out


def strip_name(x: str) -> str:
    return x[x.find(":") + 1 :]


def long_observations(df: DataFrame, provenance: str, mappings: dict[str, str] | None = None, props: Properties | None = None, ignored: list[str] | None = None, na: list[str] | None = None) -> DataFrame:
    """Flat observations of a table with a row for each value. A row's own properties go before the defaults; custom
    dimensions join the static ones in the JSON column, in order of name, and empty ones are left out."""
    props = props or Properties()
    mappings = {strip_name(k): v for k, v in (mappings or {k: n for k, n in (("observationAbout", "entity"), ("variableMeasured", "variable"), ("observationDate", "date"), ("value", "value"))}).items()}
    if errors := header_errors(mappings, df.columns, ignored):
        raise ValueError("; ".join(errors))
    out = {STANDARD[k]: cell(c, na) for k, c in mappings.items() if k in STANDARD}
    out["entity"] = F.coalesce(out.get("entity", F.lit("")), F.lit(""))
    for p in PROPS:
        out[p] = F.coalesce(out[p], F.lit(getattr(props, p))) if p in out else F.lit(getattr(props, p))
    custom = {k: strip_namespace(cell(c, na)) for k, c in mappings.items() if k not in STANDARD}
    pairs = [F.when(v.isNotNull(), F.struct(F.lit(k).alias("key"), v.alias("value"))) for k, v in sorted(({k: F.lit(v) for k, v in props.custom.items()} | custom).items())]
    held = F.array_compact(F.array(*pairs)) if pairs else None
    out["properties"] = F.lit("") if held is None else F.when(F.size(held) > 0, F.to_json(F.map_from_entries(held))).otherwise(F.lit(""))
    out["value"] = F.regexp_replace(_numeric(out["value"], False), r"^(-?\d+)\.0+$", "$1")
    return _finished(df.select([out[c].alias(c) for c in out]), provenance)


_TRIPLE = "array<struct<predicate:string,object_id:string,object_value:string>>"


def _said(predicate: str, value: Column, ref: bool) -> Column:
    """A triple's end, null where there is no value."""
    none = F.lit("")
    return F.when(value.isNotNull() & (value != ""), F.struct(F.lit(predicate).alias("predicate"), (value if ref else none).alias("object_id"), (none if ref else value).alias("object_value")))


def numbered(df: DataFrame, name: str) -> DataFrame:
    """Rows numbered from 0 in their order, whatever the partitioning: the sizes of the partitions before are added to
    a row's place in its own; the table of sizes has a row for each partition."""
    placed = df.withColumns({"row_part": F.spark_partition_id(), "row_at": F.monotonically_increasing_id()})
    size = placed.groupBy("row_part").agg(F.count("*").alias("n"), F.min("row_at").alias("row_first"))
    before = Window.orderBy("row_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = size.select("row_part", "row_first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("row_start"))
    out = placed.join(F.broadcast(starts), "row_part")  # one row a partition
    return out.withColumn(name, F.col("row_start") + F.col("row_at") - F.col("row_first")).drop("row_part", "row_at", "row_first", "row_start")


def event_triples(df: DataFrame, event_type: str, provenance: str, location: str | None = None, date: str | None = None, id_column: str | None = None, names: dict[str, str] | None = None, na: list[str] | None = None) -> DataFrame:
    """Triples of events, one a row: type, location, date, provenance and every other column that has a value."""
    rows = df if id_column else numbered(df, "row_number")
    subject = cell(id_column, na) if id_column else F.concat(F.lit(f"{event_type}_"), F.col("row_number"))
    rest = [c for c in df.columns if c not in (location, date, id_column)]
    ends = [_said("typeOf", F.lit(event_type), True)]
    ends += [_said("location", strip_namespace(cell(location, na)), True)] if location else []
    ends += [_said("observationDate", cell(date, na), False)] if date else []
    ends += [_said("provenance", F.lit(provenance), True)]
    ends += [_said((names or {}).get(c, property_id(c)), cell(c, na), False) for c in rest]
    return rows.select(subject.alias("subject_id"), F.explode(F.array_compact(F.array(*ends)).cast(_TRIPLE)).alias("e")).select("subject_id", "e.*")


def entity_triples(df: DataFrame, entity_type: str, provenance: str, id_column: str | None = None, references: list[str] | None = None, names: dict[str, str] | None = None, na: list[str] | None = None) -> DataFrame:
    """Triples of entities, one a row. Columns of references, and cells with a namespace, hold ids, several between
    commas; other cells are values."""
    rows = df if id_column else numbered(df, "row_number")
    subject = strip_namespace(F.coalesce(cell(id_column, na), F.lit(""))) if id_column else F.concat(F.lit(f"{strip_name(entity_type)}_"), F.col("row_number"))
    parts = [F.array(_said("typeOf", F.lit(strip_name(entity_type)), True), _said("provenance", F.lit(provenance), True))]
    for c in df.columns:
        name, v = (names or {}).get(c, property_id(c)), cell(c, na)
        refs = F.transform(F.split(v, ","), lambda x: _said(name, strip_namespace(F.trim(x)), True))  # noqa: B023
        is_ref = F.lit(c in (references or [])) | v.rlike("^(dcid|dcs|schema):")
        parts.append(F.when(is_ref, refs).otherwise(F.array(_said(name, v, False))))
    ends = F.array_compact(F.flatten(F.array(*[F.coalesce(p, F.array()).cast(_TRIPLE) for p in parts])))
    return rows.select(subject.alias("subject_id"), F.explode(ends).alias("e")).select("subject_id", "e.*")


def count_events(df: DataFrame, variable: str, provenance: str, entity: str, date: str, period: str = "MONTH", na: list[str] | None = None) -> DataFrame:
    """Flat observations: number of rows of each entity and day, month or year."""
    size = {"DAY": 10, "MONTH": 7, "YEAR": 4}[period]
    at = F.date_format(cell(date, na).try_cast("timestamp"), "yyyy-MM-dd")
    n = df.select(cell(entity, na).alias("entity"), F.substring(at, 1, size).alias("date")).where("entity is not null and date is not null").groupBy("entity", "date").agg(F.count("*").cast("string").alias("value"))
    return _finished(n.withColumns({"variable": F.lit(variable), "properties": F.lit("")} | {p: F.lit("") for p in PROPS}), provenance)


# ids
def _valid_id(name: str) -> str | None:
    for x in (name, re.sub("[ -]", "_", name)):
        if ID_PATTERN.fullmatch(x):
            return x
    return None


def variable_id(name: str, counter: list[int] | None = None, namespace: str = "custom") -> str:
    """The name where it is a valid id, else with underscores for blanks and dashes, else the next of a counter."""
    return _valid_id(name) or _next(counter, f"{namespace}/statvar_", name)


def property_id(name: str, counter: list[int] | None = None, namespace: str = "c/prop/") -> str:
    return _valid_id(name) or _next(counter, namespace, name)


def _next(counter: list[int] | None, prefix: str, name: str) -> str:
    if counter is None:
        return prefix + re.sub(r"[^A-Za-z0-9]+", "_", name).strip("_")
    counter.append(len(counter) + 1)
    return f"{prefix}{counter[-1]}"


def group_paths(paths: list[str], namespace: str = "custom", root: str = "dc/g/Root") -> list[tuple[str, str, str, str]]:
    """(path, id, name, parent) of groups given by paths such as ``a/b/c`` and of all that lead to them."""
    out: dict[str, tuple[str, str, str, str]] = {}
    for path in paths:
        tokens = path.split("/")
        for i in range(len(tokens)):
            here, up = "/".join(tokens[: i + 1]), "/".join(tokens[:i])
            if here not in out:
                out[here] = (here, f"{namespace}/g/group_{len(out) + 1}", tokens[i], out[up][1] if up in out else root)
    return list(out.values())


def node_triples(nodes: DataFrame) -> DataFrame:
    """Triples of nodes given as subject_id, type, name, url, refs MAP<predicate, ARRAY<id>>, values MAP<predicate,
    text>: sources, provenances, groups, variables, types, properties and entities alike."""
    ends = [F.array(_said("typeOf", F.col("type"), True), _said("name", F.col("name"), False), _said("url", F.col("url"), False))]
    refs = F.flatten(F.transform(F.map_entries(F.coalesce("refs", F.create_map().cast("map<string,array<string>>"))), lambda e: F.transform(e["value"], lambda v: F.struct(e["key"].alias("predicate"), v.alias("object_id"), F.lit("").alias("object_value")))))
    values = F.transform(F.map_entries(F.coalesce("values", F.create_map().cast("map<string,string>"))), lambda e: F.struct(e["key"].alias("predicate"), F.lit("").alias("object_id"), e["value"].alias("object_value")))
    every = F.array_compact(F.flatten(F.array(*[x.cast(_TRIPLE) for x in (*ends, refs, values)])))
    return nodes.select("subject_id", F.explode(every).alias("e")).select("subject_id", "e.*")


# entities
def resolve_entities(df: DataFrame, column: str, mapping: DataFrame | None = None, prop: str | None = None) -> DataFrame:
    """``df`` with ``<column>_dcid`` and ``<column>_status``: RESOLVED by a namespace, by the column's prefix or by a
    mapping (prop, value, dcid), else UNRESOLVED. The input's other columns stay."""
    c = F.trim(F.col(f"`{column}`").cast("string"))
    named = c.rlike("^(dcid|dcs|schema):")
    prefix = PREFIXES.get(column.lower())
    fixed = F.when(named, F.trim(strip_namespace(c)))
    if prefix is not None:
        fixed = F.coalesce(fixed, F.concat(F.lit(prefix), c))
    out, target = df.withColumn(f"{column}_dcid", fixed), f"{column}_dcid"
    if prefix is None and mapping is not None:
        known = mapping.where(F.col("prop") == prop).groupBy(F.col("value").alias("resolve_value")).agg(F.min("dcid").alias("resolve_dcid"))
        out = out.join(known, c == F.col("resolve_value"), "left").withColumn(target, F.coalesce(target, "resolve_dcid")).drop("resolve_value", "resolve_dcid")
    return out.withColumn(f"{column}_status", F.when(F.col(target).isNotNull(), "RESOLVED").otherwise("UNRESOLVED"))


def resolution_log(resolved: DataFrame, column: str, browser: str = "") -> DataFrame:
    """input, dcid, link of each distinct entity; unresolved ones are marked."""
    one = resolved.select(F.col(f"`{column}`").alias("input"), F.col(f"{column}_dcid").alias("dcid")).distinct()
    return one.select("input", F.coalesce("dcid", F.lit("*UNRESOLVED*")).alias("dcid"), F.when(F.col("dcid").isNotNull(), F.concat(F.lit(browser), "dcid")).otherwise("").alias("link"))


def best_candidate(candidates: DataFrame, wanted: str | None = None) -> DataFrame:
    """entity, dcid of rows (entity, dcid, dominant_type, position): the first of the wanted type, or the first."""
    rank = F.when(F.col("dominant_type") == wanted, 0).otherwise(1) if wanted else F.lit(0)
    rows = candidates.where(F.col("dominant_type") == wanted) if wanted else candidates
    return rows.withColumn("r", F.row_number().over(Window.partitionBy("entity").orderBy(rank, "position"))).where("r = 1").select("entity", "dcid")


def common_types(types: DataFrame) -> DataFrame:
    """type: what all entities of (entity, type) rows have in common."""
    n = types.agg(F.count_distinct("entity").alias("n"))
    return types.groupBy("type").agg(F.count_distinct("entity").alias("k")).join(n, F.col("k") == F.col("n")).select("type")


# S2 cells
def s2_cell_ids(lat: np.ndarray, lng: np.ndarray, level: int) -> np.ndarray:
    """Ids of the cells of a level that hold some points: cube face, quadratic projection, Hilbert curve."""
    phi, theta = np.radians(lat), np.radians(lng)
    xyz = np.stack([np.cos(phi) * np.cos(theta), np.cos(phi) * np.sin(theta), np.sin(phi)])
    axis = np.abs(xyz).argmax(0)
    face = axis + 3 * (xyz[axis, np.arange(len(axis))] < 0)
    x, y, z = xyz
    with np.errstate(divide="ignore", invalid="ignore"):
        u = np.choose(face, [y / x, -x / y, -x / z, z / x, z / y, -y / z])
        v = np.choose(face, [z / x, z / y, -y / z, y / x, -x / y, -x / z])
    place = lambda w: np.where(w >= 0, 0.5 * np.sqrt(1 + 3 * np.abs(w)), 1 - 0.5 * np.sqrt(1 + 3 * np.abs(w)))
    i, j = (np.clip((place(w) * (1 << 30)).astype(np.int64), 0, (1 << 30) - 1) for w in (u, v))
    # position within four quarters by orientation (bit 0: axes swapped, bit 1: both inverted), and what follows
    position = np.array([[0, 1, 3, 2], [0, 3, 1, 2], [2, 3, 1, 0], [2, 1, 3, 0]])
    turn = np.array([1, 0, 0, 3])
    orientation = face & 1
    out = face.astype(np.uint64)
    for k in range(29, -1, -1):
        ij = (((i >> k) & 1) << 1) | ((j >> k) & 1)
        p = position[orientation, ij]
        out = (out << np.uint64(2)) | p.astype(np.uint64)
        orientation = orientation ^ turn[p]
    leaf = (out << np.uint64(1)) | np.uint64(1)
    if level >= 30:
        return leaf
    low = np.uint64(1 << (2 * (30 - level)))
    return (leaf & (np.uint64(0xFFFFFFFFFFFFFFFF) ^ (low - np.uint64(1)) ^ low)) | low


def s2_cells(latlng: Column, level: int) -> Column:
    """``s2CellId/0x..`` of texts such as ``38.7#-119.4``; null where a text isn't one."""
    if not 0 <= level <= 30:
        raise ValueError("levels go from 0 to 30")

    def run(s: pd.Series) -> pd.Series:
        parts = s.astype("string").str.extract(r"^\s*([^#]+?)\s*#\s*(.+?)\s*$")
        lat, lng = (pd.to_numeric(parts[k], errors="coerce").to_numpy(np.float64, na_value=np.nan) for k in (0, 1))
        ok = np.isfinite(lat) & np.isfinite(lng)
        out = np.full(len(s), None, object)
        out[ok] = [f"s2CellId/{int(x):#018x}" for x in s2_cell_ids(lat[ok], lng[ok], level)]
        return pd.Series(out)

    return F.pandas_udf(run, "string")(latlng)


# fuzzy match
def normalised(x: Column) -> Column:
    """Lower case, accents decomposed, single blanks, letters and digits only."""
    def run(s: pd.Series) -> pd.Series:
        return s.str.normalize("NFKD").str.lower()

    bare = F.pandas_udf(run, "string")(x)
    return F.regexp_replace(F.trim(F.regexp_replace(bare, " +", " ")), r"[^\p{L}\p{N} ]", "")


def ngrams(text: Column, n: int = 4) -> Column:
    """Words of a normalised text, as often as they occur, and the other runs of ``n`` characters, once each."""
    words = F.split(text, " ")
    runs = F.transform(F.sequence(F.lit(1), F.greatest(F.length(text) - n, F.lit(0)) + 1), lambda i: F.substring(text, i, F.lit(n)))
    return F.concat(words, F.array_except(runs, words))


SPREAD = 16  #: parts of the keys of one text that meet its queries in tasks of their own


def ngram_match(keys: DataFrame, queries: DataFrame, top: int | None = None, n: int = 4, fraction: float = 0.8) -> DataFrame:
    """query, key, matches, position, score, rank: keys that have at least ``fraction`` of a query's n-grams, ranked by
    rarity of what matches, closeness to the key's beginning and number of matches; ties by key.

    ``keys`` and ``queries`` have (id, text). What is compared are unlike texts (of an id with several rows all its
    texts), each pair of them once; keys are ranked once for all queries of the same text, and only then joined with
    these, so that besides the result itself nothing grows with the number of pairs of ids."""
    parts = tasks(keys.sparkSession)

    def like(df: DataFrame, name: str, alike: str) -> DataFrame:
        """Ids with their texts as one string; normalised texts have no line breaks."""
        per = df.select(F.col("id").alias(name), normalised(F.col("text")).alias("t")).where("t is not null").repartition(parts, name).groupBy(name).agg(F.array_sort(F.collect_list("t")).alias("ts"))
        return per.select(name, F.array_join("ts", "\n").alias(alike))

    own, asked = like(keys, "key", "k_text"), like(queries, "query", "q_text")
    k = own.groupBy("k_text").agg(F.count("*").alias("keys")).select("k_text", "keys", F.explode(F.split("k_text", "\n")).alias("t"))
    k = k.select("k_text", "keys", "t", F.explode(F.array_distinct(ngrams(F.col("t"), n))).alias("g")).withColumn("pos", F.expr("locate(g, t) - 1"))
    df = k.groupBy("g").agg(F.sum("keys").alias("df"))
    q = asked.select("q_text").distinct().select("q_text", F.explode(F.split("q_text", "\n")).alias("t")).withColumn("grams", ngrams(F.col("t"), n))
    q = q.select("q_text", F.length("t").alias("size"), F.size("grams").alias("n"), F.explode("grams").alias("g"))
    hit = q.join(df, "g").join(k.select("g", "k_text", "pos"), "g")
    per = hit.groupBy("q_text", "k_text", "size", "n").agg(F.sum(1 / F.col("df")).alias("idf"), F.count("*").alias("matches"), F.min("pos").alias("position"))
    per = per.where(F.col("matches") >= F.greatest(F.lit(1.0), F.col("n") * fraction))
    per = per.withColumn("score", F.round(F.col("idf") + (F.col("size") - F.col("position")) * 10000 + F.col("matches") * 100, 6))
    ranked = per.join(own.repartition(parts, "k_text"), "k_text").repartition(parts, "q_text").withColumn("rank", F.row_number().over(Window.partitionBy("q_text").orderBy(F.desc("score"), "key")))
    ranked = (ranked if top is None else ranked.where(F.col("rank") <= top)).select("q_text", F.pmod(F.col("rank"), F.lit(SPREAD)).alias("part"), "key", "matches", "position", "score", "rank")
    asked = asked.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    out = ranked.repartition(parts, "q_text", "part").join(asked.repartition(parts, "q_text", "part"), ["q_text", "part"])
    return out.select("query", "key", "matches", "position", "score", "rank")


# text and metadata
def sentences(triples: DataFrame) -> DataFrame:
    """subject_id, sentence: search descriptions between semicolons, sorted, else the name."""
    of = lambda p: F.array_sort(F.collect_list(F.when(F.col("predicate") == p, F.col("object_value"))))
    per = triples.where(F.col("predicate").isin("searchDescription", "name")).groupBy("subject_id").agg(of("searchDescription").alias("d"), of("name").alias("n"))
    return per.select("subject_id", F.when(F.size("d") > 0, F.array_join("d", ";")).otherwise(F.element_at("n", -1)).alias("sentence")).where("sentence <> ''")


def topic_cache(triples: DataFrame) -> DataFrame:
    """subject_id, types, names, variables, members of topics and peer groups (sorted arrays); lists between commas are
    taken apart."""
    ids = lambda single, several: F.array_sort(F.flatten(F.collect_list(F.when(F.col("predicate") == single, F.array("object_id")).when(F.col("predicate") == several, F.transform(F.split("object_value", ","), lambda x: F.trim(x))))))
    text = lambda p, c: F.array_sort(F.collect_list(F.when(F.col("predicate") == p, F.col(c))))
    return triples.groupBy("subject_id").agg(text("typeOf", "object_id").alias("types"), text("name", "object_value").alias("names"), ids("relevantVariable", "relevantVariableList").alias("variables"), ids("member", "memberList").alias("members"))


def topic_json(cache: DataFrame) -> DataFrame:
    filled = lambda c: F.when(F.size(c) > 0, F.col(c))
    return cache.select(F.to_json(F.struct(F.array("subject_id").alias("dcid"), filled("types").alias("typeOf"), filled("names").alias("name"), filled("variables").alias("relevantVariableList"), filled("members").alias("memberList"))).alias("value"))


def metadata_errors(triples: DataFrame, observations: DataFrame) -> DataFrame:
    """kind, id: provenances that rows name but nobody defines, and provenances without a source."""
    named = observations.select(F.col("provenance").alias("id")).union(triples.where("predicate = 'provenance'").select("object_id")).where("id <> ''").distinct()
    defined = triples.where("predicate = 'typeOf' and object_id = 'Provenance'").select(F.col("subject_id").alias("id")).distinct()
    sourced = triples.where("predicate = 'source' and object_id <> ''").select(F.col("subject_id").alias("id")).distinct()
    undefined = named.join(defined, "id", "left_anti").select(F.lit("undefined").alias("kind"), "id")
    return undefined.unionByName(defined.join(sourced, "id", "left_anti").select(F.lit("no source").alias("kind"), "id"))


def schema_names(wanted: DataFrame, own: DataFrame, remote: DataFrame | None = None) -> DataFrame:
    """subject_id, name of wanted ids: the own name first, then that of a reference table, else the id."""
    one = lambda df, c: df.groupBy("subject_id").agg(F.min("name").alias(c))
    out = wanted.select("subject_id").distinct().join(one(own, "a"), "subject_id", "left")
    out = out.join(one(remote, "b"), "subject_id", "left") if remote is not None else out.withColumn("b", F.lit(None).cast("string"))
    return out.select("subject_id", F.coalesce("a", "b", "subject_id").alias("name"))


# hierarchy of variables by triples
MOST_ID = 255


def _token(x: Column) -> Column:
    return F.concat(F.upper(F.substring(x, 1, 1)), F.substring(F.regexp_replace(x, r"[^A-Za-z0-9_.]", ""), 2, 100_000))


def hierarchy(variables: DataFrame, prefix: str = "c/g/") -> DataFrame:
    """group, parent, specialised, via of variables (variable, population_type, pvs ARRAY<STRUCT<prop, val>> by prop): a
    leaf group for each set of pairs, parents without one value, then without its property. ``specialised`` names what
    the child has and the parent hasn't. Ids beyond 255 characters end in part of their hash."""
    shown = lambda pvs: F.transform(pvs, lambda p: F.when(p["val"] != "", F.concat(_token(p["prop"]), F.lit("-"), _token(p["val"]))).otherwise(_token(p["prop"])))

    def group_id(pvs: Column) -> Column:
        full = F.concat(F.lit(prefix), _token(F.col("population_type")), F.when(F.size(pvs) > 0, F.concat(F.lit("_"), F.array_join(shown(pvs), "_"))).otherwise(""))
        cut = F.concat(F.substring(full, 1, MOST_ID - 9), F.lit("-"), F.substring(F.sha2(full.cast("binary"), 256), 1, 8))
        return F.when(F.length(full) > MOST_ID, cut).otherwise(full)

    parts = lambda pvs: F.array_distinct(F.filter(F.flatten(F.transform(pvs, lambda p: F.array(p["prop"], p["val"]))), lambda x: x != ""))
    level = variables.select("population_type", "pvs").distinct()
    none = F.lit(None).cast("string")
    out = variables.select(group_id(F.col("pvs")).alias("group"), none.alias("parent"), none.alias("specialised"), F.col("variable").alias("via")).distinct()
    while True:
        level = level.where(F.size("pvs") > 0)
        half = level.select("population_type", "pvs", F.posexplode("pvs").alias("at", "p"))
        half = half.withColumns({"half": F.expr("transform(pvs, (p, i) -> if(i = at, named_struct('prop', p.prop, 'val', ''), p))"), "rest": F.expr("filter(pvs, (p, i) -> i <> at)")})
        from statloom.plans.storage import saved

        half = saved(half, "hierarchy")
        if half.isEmpty():
            return out.distinct()
        link = lambda a, b: half.select(group_id(F.col(a)).alias("group"), group_id(F.col(b)).alias("parent"), F.array_join(F.array_except(parts(F.col(a)), parts(F.col(b))), ", ").alias("specialised"), none.alias("via"))  # noqa: B023, E731
        out = out.unionByName(link("pvs", "half")).unionByName(link("half", "rest"))
        level = half.select("population_type", F.col("rest").alias("pvs")).distinct()


def group_cache(links: DataFrame) -> DataFrame:
    """group, children (sorted groups with their specialised names), variables of rows of ``hierarchy``."""
    children = links.where("parent is not null").groupBy(F.col("parent").alias("group")).agg(F.array_sort(F.collect_set(F.struct(F.col("group").alias("id"), "specialised"))).alias("children"))
    variables = links.where("via is not null").groupBy("group").agg(F.array_sort(F.collect_set("via")).alias("variables"))
    return children.join(variables, "group", "full")
