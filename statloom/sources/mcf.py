"""Node text, templates with CSV, and JSON-LD, read into one row per property value (``MCF_PV``)."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from statloom.functions.numbers import is_boolean, is_number, strip_schema_prefix
from statloom.schema import MCF_PV

REFERENCES = [
    "typeOf", "subClassOf", "subPropertyOf", "memberOf", "member", "specializationOf", "relevantVariable", "containedInPlace", "populationType", "measuredProperty", "statType", "measurementQualifier", "measurementMethod",
    "measurementDenominator", "unit", "variableMeasured", "observationAbout", "location", "domainIncludes", "rangeIncludes", "isPartOf", "source", "provenance", "affectedPlace",
]
_PREFIX = re.compile(r"^(dcid|dcs|schema):")


def split_values(text: str, delimiter: str = ",") -> list[str] | None:
    """Parts between delimiters outside of double quotes; None where a quote isn't closed. A backslash keeps a quote."""
    out, held, quoted, escaped = [], [], False, False
    for c in text:
        if escaped:
            held.append(c)
            escaped = False
        elif c == "\\" and quoted:
            held.append(c)
            escaped = True
        elif c == '"':
            held.append(c)
            quoted = not quoted
        elif c == delimiter and not quoted:
            out.append("".join(held).strip())
            held = []
        else:
            held.append(c)
    if quoted:
        return None
    return [x for x in [*out, "".join(held).strip()] if x]


def parse_block(text: str) -> Iterator[tuple[str, str, int, str]]:
    """(node, property, position, raw value); an unparsable line gives a value of None."""
    node = None
    for line in text.splitlines():
        line = line.strip()
        if not line or line.startswith(("//", "#")):
            continue
        prop, colon, value = line.partition(":")
        prop, value = prop.strip(), value.strip()
        if prop == "Node" and colon:
            node = _PREFIX.sub("", value)
            continue
        if node is None or not colon or not prop:
            yield node or "", prop, 0, None
            continue
        values = split_values(value)
        if values is None:
            yield node, prop, 0, None
            continue
        for i, v in enumerate(values):
            yield node, prop, i, v


def typed(raw: DataFrame, resolved: bool = True) -> DataFrame:
    """Types of raw values: quoted text, complex value, reference by prefix or property, number, or text."""
    v = F.col("value")
    quoted = v.rlike(r'^".*"$')
    local = v.startswith("l:")
    prefixed = v.rlike(r"^(dcid|dcs|schema):")
    kind = (
        F.when(v.isNull(), "ERROR").when(quoted, "TEXT").when(v.startswith("[") & v.endswith("]"), "COMPLEX_VALUE").when(prefixed, "RESOLVED_REF").when(local & F.lit(not resolved), "UNRESOLVED_REF")
        .when(F.col("prop").isin(REFERENCES), "RESOLVED_REF").when(is_number(v) | is_boolean(v), "NUMBER").otherwise("TEXT")
    )
    bare = F.when(quoted, F.regexp_replace(F.substring(v, 2, F.length(v) - 2), r"\\(.)", "$1")).when(prefixed, strip_schema_prefix(v)).otherwise(v)
    return raw.select("node_id", "prop", F.col("pos").cast("int").alias("pos"), kind.alias("type"), bare.alias("value"))


def parse_text(blocks: DataFrame, column: str = "value", resolved: bool = True) -> DataFrame:
    """``MCF_PV`` rows of texts that hold whole nodes each."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = [r for text in f[column] if text is not None for r in parse_block(text)]
            yield pd.DataFrame(rows, columns=["node_id", "prop", "pos", "value"])

    return typed(blocks.select(column).mapInPandas(run, "node_id string, prop string, pos int, value string"), resolved)


def read_mcf(spark: SparkSession, path: str, resolved: bool = True, whole_files: bool = False) -> DataFrame:
    """Nodes are separated by empty lines, so that a file is read in parallel; ``whole_files`` for files in which a
    separating line isn't quite empty."""
    return parse_text(spark.read.text(path, wholetext=True) if whole_files else spark.read.text(path, lineSep="\n\n"), resolved=resolved)


def to_mcf(pv: DataFrame) -> DataFrame:
    """node_id, text of each node, its properties sorted; texts quoted, references prefixed."""
    value = F.when(F.col("type") == "TEXT", F.concat(F.lit('"'), F.regexp_replace("value", '"', '\\\\"'), F.lit('"'))).when(F.col("type") == "RESOLVED_REF", F.concat(F.lit("dcid:"), F.col("value"))).otherwise(F.col("value"))
    lines = pv.where("value is not null").groupBy("node_id", "prop").agg(F.array_join(F.array_sort(F.collect_set(value)), ", ").alias("v"))
    line = F.concat("prop", F.lit(": "), "v")
    return lines.groupBy("node_id").agg(F.array_join(F.array_sort(F.collect_list(line)), "\n").alias("body")).select("node_id", F.concat(F.lit("Node: dcid:"), "node_id", F.lit("\n"), "body").alias("text"))


def parse_template(text: str) -> dict[str, list[tuple[str, str, str]]]:
    """entity -> (property, kind, argument): E and C terms, or a constant."""
    out: dict[str, list[tuple[str, str, str]]] = {}
    entity = None
    for line in text.splitlines():
        line = line.strip()
        if not line or line.startswith(("//", "#")):
            continue
        prop, _, value = (x.strip() for x in line.partition(":"))
        term = re.fullmatch(r"([EC]):\s*[^-]+->\s*(\S.*)", value)
        if prop == "Node":
            if not term or term[1] != "E":
                raise ValueError(f"not an entity: {value}")
            entity = out.setdefault(term[2], []) if term[2] not in out else out[term[2]]
        elif entity is None:
            raise ValueError(f"before any node: {line}")
        elif term:
            entity.append((prop, term[1], term[2]))
        else:
            entity += [(prop, "V", v) for v in split_values(value) or []]
    return out


def check_template(template: dict[str, list[tuple[str, str, str]]], columns: list[str]) -> list[str]:
    """Entities and columns that a template names but that aren't there."""
    return [f"{e}.{p}: {k}:{a}" for e, terms in template.items() for p, k, a in terms if k == "E" and a not in template or k == "C" and a not in columns]


def expand_template(table: DataFrame, template: dict[str, list[tuple[str, str, str]]], name: str = "table") -> DataFrame:
    """``MCF_PV`` rows: a node for each entity and row, all from one scan. A node's id is its dcid where a column gives
    one, a local id otherwise; empty cells give nothing; cells may hold several values."""
    if bad := check_template(template, table.columns):
        raise ValueError("; ".join(bad))
    from statloom.operators.importers import numbered

    rows = numbered(table, "__row").withColumn("__row", F.col("__row").cast("string"))
    ids = {}
    for e, terms in template.items():
        own = [F.when(F.trim(F.col(f"`{a}`")) != "", strip_schema_prefix(F.trim(F.col(f"`{a}`")))) if k == "C" else F.lit(_PREFIX.sub("", a)) for p, k, a in terms if p == "dcid"]
        ids[e] = F.coalesce(*own, F.concat(F.lit(f"l:{name}/{e}/"), "__row"))
    none = F.array().cast("array<string>")
    cells = []
    for e, terms in template.items():
        for p, k, a in terms:
            values = F.array(ids[a]) if k == "E" else F.array(F.lit(a)) if k == "V" else F.when(F.trim(F.col(f"`{a}`")) != "", F.transform(F.split(F.col(f"`{a}`"), r",(?=(?:[^\"]*\"[^\"]*\")*[^\"]*$)"), lambda x: F.trim(x))).otherwise(none)
            cells.append(F.struct(ids[e].alias("node_id"), F.lit(p).alias("prop"), F.lit(k).alias("kind"), F.coalesce(values, none).alias("vs")))
    long = rows.select(F.explode(F.array(*cells)).alias("c")).select("c.*").select("node_id", "prop", "kind", F.posexplode("vs").alias("pos", "value"))
    linked = long.where("kind = 'E'").select("node_id", "prop", F.col("pos").cast("int").alias("pos"), F.when(F.col("value").startswith("l:"), "UNRESOLVED_REF").otherwise("RESOLVED_REF").alias("type"), "value")
    return typed(long.where("kind <> 'E'"), resolved=False).unionByName(linked)


def read_tmcf(spark: SparkSession, template_path: str, csv_path: str, delimiter: str | None = None) -> DataFrame:
    text = "\n".join(r["value"] for r in spark.read.text(template_path).collect())
    sep = delimiter or ("\t" if csv_path.endswith(".tsv") else ",")
    csv = spark.read.option("header", "true").option("sep", sep).option("escape", "\\").csv(csv_path)
    csv = csv.toDF(*[c.lstrip("﻿").strip() for c in csv.columns])
    return expand_template(csv, parse_template(text), csv_path.rsplit("/", 1)[-1].rsplit(".", 1)[0])


def _local(key: str) -> str:
    """The last part of an expanded key."""
    return re.split(r"[/#:]", key.rstrip("/"))[-1]


def _bare(x: str) -> str:
    """An id without its prefix or the address of one."""
    x = re.sub(r"^https?://.*/(?:browser|kg)/", "", x)
    return x if x.startswith("l:") else re.sub(r"^(dcid|dcs|schema):", "", x)


def expand_jsonld(doc: object) -> Iterator[tuple[str, str, int, str, str]]:
    """``MCF_PV`` rows of a JSON-LD document: an array, a single node or an @graph. Terms and prefixes of the context
    are replaced, terms of type @id are references, nodes within nodes become nodes of their own."""
    import json

    context: dict[str, str] = {}
    links: set[str] = set()
    seen: dict[tuple[str, str], int] = {}
    out: list[tuple[str, str, int, str, str]] = []

    def learn(c: object) -> None:
        for part in c if isinstance(c, list) else [c]:
            for k, v in part.items() if isinstance(part, dict) else ():
                if isinstance(v, dict):
                    links.update([k] if v.get("@type") == "@id" else [])
                    v = v.get("@id", k)
                if isinstance(v, str):
                    context[k] = v

    def full(x: str) -> str:
        if x in context:
            return full(context[x]) if context[x] != x and context[x] in context else context[x]
        prefix, colon, rest = x.partition(":")
        return context[prefix] + rest if colon and prefix in context and not rest.startswith("//") else x

    def name(x: str) -> str:
        prefix, colon, rest = x.partition(":")
        if colon and prefix in context and not rest.startswith("//"):
            return rest if prefix in ("dcid", "dcs", "schema") or context[prefix].endswith(("/", "#")) else full(x)
        return _bare(x)

    def text(v: object) -> str:
        return v if isinstance(v, str) else json.dumps(v)

    def add(node: str, prop: str, kind: str, value: str) -> None:
        k = seen.get((node, prop), 0)
        seen[node, prop] = k + 1
        out.append((node, prop, k, kind, value))

    def value(node: str, prop: str, link: bool, v: object) -> None:
        if isinstance(v, list):
            for x in v:
                value(node, prop, link, x)
        elif isinstance(v, dict):
            if "@value" in v:
                add(node, prop, "TEXT", text(v["@value"]))
            elif "@list" in v or "@set" in v:
                value(node, prop, link, v.get("@list", v.get("@set")))
            elif "@id" in v:
                to = name(str(v["@id"]))
                add(node, prop, "UNRESOLVED_REF" if to.startswith("l:") else "RESOLVED_REF", to)
                for k, x in v.items():
                    if _local(full(k)) == "observationProperties":
                        value(node, "observationProperties", k in links, x)
                if set(v) - {"@id"} - {k for k in v if _local(full(k)) == "observationProperties"}:
                    walk(v)
        elif v is not None:
            to = name(str(v))
            add(node, prop, ("UNRESOLVED_REF" if to.startswith("l:") else "RESOLVED_REF") if link else "NUMBER" if isinstance(v, (int, float)) and not isinstance(v, bool) else "TEXT", to if link else text(v))

    def walk(x: object) -> None:
        if isinstance(x, list):
            for y in x:
                walk(y)
        elif isinstance(x, dict):
            learn(x.get("@context"))
            if "@graph" in x:
                walk(x["@graph"])
            if "@id" not in x:
                return
            node = name(str(x["@id"]))
            for k, v in x.items():
                if k == "@type":
                    for t in v if isinstance(v, list) else [v]:
                        add(node, "typeOf", "RESOLVED_REF", name(str(t)))
                elif not k.startswith("@"):
                    value(node, _local(full(k)), k in links, v)

    walk(doc)
    yield from out


def parse_jsonld(texts: DataFrame, column: str = "value") -> DataFrame:
    """``MCF_PV`` rows of JSON-LD documents, one a row; a document that isn't JSON gives a row of type ERROR."""
    import json

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in batches:
            rows: list[tuple] = []
            for t in f[column]:
                if t is None:
                    continue
                try:
                    rows += expand_jsonld(json.loads(t))
                except ValueError:
                    rows.append(("", "", 0, "ERROR", None))
            yield pd.DataFrame(rows, columns=["node_id", "prop", "pos", "type", "value"])

    return texts.select(column).mapInPandas(run, MCF_PV)


MOST_TRIPLE = 65_535


def to_triples(pv: DataFrame) -> DataFrame:
    """subject_id, predicate, object_id, object_value of parsed nodes by their dcids; a value beyond 65,535 characters,
    and a local node without a dcid, fail."""
    ids = pv.where("prop = 'dcid'").groupBy("node_id").agg(F.min("value").alias("dcid"))
    rows = pv.where("prop <> 'dcid' and value is not null").join(ids, "node_id", "left")
    subject = F.coalesce("dcid", F.when(~F.col("node_id").startswith("l:"), F.col("node_id")).otherwise(F.raise_error(F.concat(F.lit("no dcid for the node "), "node_id")).cast("string")))
    v = F.when(F.length("value") <= MOST_TRIPLE, F.col("value")).otherwise(F.raise_error(F.concat(F.lit("a value is too long: "), "prop")).cast("string"))
    ref = F.col("type").isin("RESOLVED_REF", "UNRESOLVED_REF")
    return rows.select(subject.alias("subject_id"), F.col("prop").alias("predicate"), F.when(ref, v).otherwise("").alias("object_id"), F.when(ref, "").otherwise(v).alias("object_value"))


def read_graph(spark: SparkSession, path: str) -> DataFrame:
    """By the name: parsed nodes as Parquet, packed records of optimised series, JSON-LD, or node text."""
    if path.endswith(".parquet"):
        return spark.read.schema(MCF_PV).parquet(path)
    if "tfrecord" in path:
        from statloom.sources import files

        one = files.series_points(files.read_records(spark, path)).withColumn("node_id", F.coalesce("dcid", F.concat_ws("/", F.lit("o"), F.sha2(F.concat_ws("^", "observation_about", "variable_measured", "date", "measurement_method", "observation_period", "scaling_factor", "unit"), 256))))
        props = {"variableMeasured": "variable_measured", "observationAbout": "observation_about", "measurementMethod": "measurement_method", "observationPeriod": "observation_period", "unit": "unit", "scalingFactor": "scaling_factor"}
        said = [F.struct(F.lit(p).alias("prop"), F.lit("RESOLVED_REF").alias("type"), F.col(c).alias("value")) for p, c in props.items()]
        said += [F.struct(F.lit("typeOf").alias("prop"), F.lit("RESOLVED_REF").alias("type"), F.lit("StatVarObservation").alias("value"))]
        said += [F.struct(F.lit(p).alias("prop"), F.lit("TEXT").alias("type"), F.col(c).alias("value")) for p, c in (("observationDate", "date"), ("value", "value"), ("provenanceUrl", "provenance_url"))]
        return one.select("node_id", F.explode(F.array(*said)).alias("x")).where("x.value <> ''").select("node_id", "x.prop", F.lit(0).alias("pos"), "x.type", "x.value")
    if ".jsonld" in path:
        return parse_jsonld(spark.read.text(path, wholetext=True))
    return read_mcf(spark, path)
