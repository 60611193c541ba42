"""Writers: keyed upserts and scoped deletes of tables, node text, JSON-LD, reports, optimised series.

A table is a folder of Parquet files. Replacing one writes the new rows beside the old ones first and swaps the folders
then, so a lost executor or a failed job leaves the old table.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from statloom.functions.facets import provenance_name
from statloom.plans.storage import saved

KEYS = {
    "node": ["subject_id"], "edge": ["subject_id", "predicate", "object_id", "provenance"], "time_series": ["variable_measured", "entity1", "extra_entities_id", "facet_id"],
    "observation": ["variable_measured", "entity1", "extra_entities_id", "facet_id", "date"], "key_value_store": ["type", "key", "provenance"], "import_status": ["import_name"],
}


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p)


def replace(df: DataFrame, path: str, partition: list[str] | None = None) -> None:
    spark = df.sparkSession
    new, old = f"{path}.new-{uuid.uuid4().hex}", f"{path}.old-{uuid.uuid4().hex}"
    writer = df.write
    (writer.partitionBy(*partition) if partition else writer).parquet(new)
    fs, here = _path(spark, path)
    _, fresh = _path(spark, new)
    _, gone = _path(spark, old)
    if fs.exists(here):
        fs.rename(here, gone)
    fs.rename(fresh, here)
    if fs.exists(gone):
        fs.delete(gone, True)


def merged(old: DataFrame, new: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """``old`` with rows of ``new`` put in place of those with the same key. Of rows of ``new`` with one key the last by
    ``order`` counts (by all its columns where it isn't given)."""
    rest = [c for c in new.columns if c not in keys]
    last = new.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*(order or rest))).alias("row")).select(*keys, "row.*") if rest else new.select(*keys).distinct()
    on = None
    right = new.select(*[F.col(k).alias(f"key_{k}") for k in keys]).distinct()
    for k in keys:
        same = old[k].eqNullSafe(right[f"key_{k}"])
        on = same if on is None else on & same
    return old.join(right, on, "left_anti").unionByName(last, allowMissingColumns=True).select(old.columns)


def upsert(new: DataFrame, path: str, table: str) -> None:
    """Insert or update by the table's key. Provisional nodes (only a key) don't overwrite what is known."""
    spark = new.sparkSession
    if not exists(spark, path):
        rest = [c for c in new.columns if c not in KEYS[table]]
        return replace(new.groupBy(*KEYS[table]).agg(F.max_by(F.struct(*rest), F.struct(*rest)).alias("row")).select(*KEYS[table], "row.*") if rest else new.distinct(), path)
    old = spark.read.parquet(path)
    if set(new.columns) == set(KEYS[table]) and set(old.columns) != set(KEYS[table]):
        new = new.join(old.select(*KEYS[table]), KEYS[table], "left_anti")
        return replace(old.unionByName(new.distinct(), allowMissingColumns=True), path)
    return replace(merged(old, new, KEYS[table]), path)


def delete_provenance(path: str, spark: SparkSession, provenances: list[str]) -> None:
    """Rows of some provenances go."""
    if exists(spark, path):
        df = spark.read.parquet(path)
        replace(df.where(~F.coalesce(F.col("provenance"), F.lit("")).isin(provenances)), path)


def without_aggregates(edges: DataFrame, series: DataFrame, observations: DataFrame, key_values: DataFrame, imports: list[str], base: bool = True) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The tables without what calculations wrote for some output imports; observations go with their series."""
    names = [provenance_name(i, base) for i in imports]
    gone = lambda df, c=F.col("provenance"): df.where(~F.coalesce(c, F.lit("")).isin(names))
    left = gone(series, F.get_json_object("facet", "$.provenance") if dict(series.dtypes)["facet"] == "string" else F.col("facet.provenance"))
    key = KEYS["time_series"]
    return gone(edges), left, observations.join(left.select(*key), key, "left_semi"), gone(key_values)


def without_generated_groups(edges: DataFrame, base: bool = True) -> DataFrame:
    """Edges without those of generated groups: any generated provenance goes, linked members of other imports too."""
    prefix = "dc/base/generated/" if base else "generated/"
    of_groups = F.col("predicate").isin("memberOf", "linkedMemberOf", "specializationOf", "typeOf", "name")
    return edges.where(~(F.col("provenance").startswith(prefix) & of_groups))


def without_linked(edges: DataFrame, imports: list[str], base: bool = True) -> DataFrame:
    names = [provenance_name(f"generated/{i}", base) for i in imports]
    return edges.where(~(F.col("predicate").isin("linkedContainedInPlace", "linkedMemberOf", "linkedMember") & F.col("provenance").isin(names)))


def without_lists(edges: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(edges, nodes) without the lists of topics and their literal nodes."""
    lists = edges.where(F.col("predicate").isin("relevantVariableList", "memberList"))
    rest = edges.where(~F.col("predicate").isin("relevantVariableList", "memberList"))
    held = lists.select(F.col("object_id").alias("subject_id")).distinct().join(rest.select(F.col("object_id").alias("subject_id")).distinct(), "subject_id", "left_anti")
    return rest, nodes.join(held, "subject_id", "left_anti")


def ordered_write(nodes: DataFrame, edges: DataFrame, series: DataFrame, observations: DataFrame, folder: str, provenance: str) -> list[str]:
    """Nodes, then edges once the import's old ones are gone, then series, then observations; returns the order."""
    spark, done = nodes.sparkSession, []
    for name, df, scoped in (("node", nodes, False), ("edge", edges, True), ("time_series", series, False), ("observation", observations, False)):
        if scoped:
            delete_provenance(f"{folder}/{name}", spark, [provenance])
        upsert(df, f"{folder}/{name}", name)
        done.append(name)
    return done


# texts
def write_nodes(text: DataFrame, path: str) -> None:
    """Node text (``mcf.to_mcf``), an empty line between nodes."""
    text.select(F.concat("text", F.lit("\n")).alias("value")).write.mode("overwrite").text(path)


def write_pair(text: DataFrame, failed: DataFrame, folder: str) -> None:
    """Resolved nodes and failed ones in two places; failed ones begin with their error as a comment."""
    bad = text.join(failed, "node_id")
    write_nodes(text.join(failed, "node_id", "left_anti"), f"{folder}/resolved")
    write_nodes(bad.select(F.concat(F.lit("# "), "error", F.lit("\n"), "text").alias("text")), f"{folder}/failed")


def observation_id() -> Column:
    """``obs_`` and the digest of what identifies an observation; the scaling factor isn't part of it."""
    parts = ["entity", "variable", "date", "provenance", "unit", "measurement_method", "observation_period", "properties"]
    return F.concat(F.lit("obs_"), F.sha2(F.concat_ws("_", *[F.coalesce(F.col(p), F.lit("")) for p in parts]).cast("binary"), 256))


_JSON_PROPS = {"unit": "unit", "scaling_factor": "scalingFactor", "measurement_method": "measurementMethod", "observation_period": "observationPeriod"}


def jsonld_observations(flat: DataFrame) -> DataFrame:
    """id, json of flat observations."""
    ref = lambda c: F.struct(F.concat(F.lit("dcid:"), F.col(c)).alias("@id"))
    extra = [F.when(F.col(c) != "", F.col(c)).alias(f"dcid:{p}") for c, p in _JSON_PROPS.items()]
    body = F.struct(F.concat(F.lit("dcid:"), observation_id()).alias("@id"), F.lit("dcid:StatVarObservation").alias("@type"), ref("entity").alias("dcid:observationAbout"), ref("variable").alias("dcid:variableMeasured"), F.col("date").alias("dcid:observationDate"), F.col("value").alias("dcid:value"), ref("provenance").alias("dcid:provenance"), *extra)
    return flat.select(observation_id().alias("id"), F.to_json(body).alias("json"))


def jsonld_nodes(triples: DataFrame) -> DataFrame:
    """id, json of the subjects of triples, their properties sorted."""
    v = F.when(F.col("object_id") != "", F.to_json(F.struct(F.concat(F.lit("dcid:"), "object_id").alias("@id")))).otherwise(F.to_json(F.struct(F.col("object_value").alias("@value"))))
    per = triples.withColumn("v", v).groupBy("subject_id", "predicate").agg(F.array_join(F.array_sort(F.collect_set("v")), ",").alias("vs"))
    entry = F.concat(F.lit('"dcid:'), "predicate", F.lit('":['), "vs", F.lit("]"))
    return per.groupBy(F.col("subject_id").alias("id")).agg(F.array_join(F.array_sort(F.collect_list(entry)), ",").alias("body")).select("id", F.concat(F.lit('{"@id":"dcid:'), "id", F.lit('",'), "body", F.lit("}")).alias("json"))


def shards(rows: DataFrame, size: int = 10_000, prefix: str = "dcid", uri: str = "https://schema.org/") -> DataFrame:
    """shard, value: documents of about ``size`` nodes each, in order of id, none split. The shard of a row follows from
    the number of rows of the ranges of ids before it; no task sees all rows."""
    n = rows.count()
    parts = max(1, -(-n // size))
    ranged = rows.repartitionByRange(parts, "id").withColumn("shard", F.spark_partition_id())
    head = json.dumps({prefix: uri})
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", "json"))), lambda x: x["json"]), ",\n")
    return ranged.groupBy("shard").agg(body.alias("b")).select("shard", F.concat(F.lit('{"@context":' + head + ',"@graph":[\n'), "b", F.lit("\n]}")).alias("value"))


def write_jsonld(rows: DataFrame, path: str, size: int = 10_000) -> None:
    docs = saved(shards(rows, size), "jsonld")
    docs.repartitionByRange(max(1, docs.count()), "shard").select("value").write.mode("overwrite").text(path)


def collisions(ids: DataFrame) -> DataFrame:
    """id, n of ids that stand for several rows."""
    return ids.groupBy("id").agg(F.count("*").alias("n")).where("n > 1")


def write_main(flat: DataFrame, schema_text: DataFrame, folder: str) -> str:
    """Observations as CSV with a fixed template, and node text of variables and groups; returns the template."""
    columns = {"entity": "observationAbout", "variable": "variableMeasured", "date": "observationDate", "value": "value", **{c: p for c, p in _JSON_PROPS.items()}}
    flat.select(*columns).write.mode("overwrite").option("header", "true").csv(f"{folder}/observations")
    write_nodes(schema_text, f"{folder}/schema")
    template = "Node: E:observations->E0\ntypeOf: dcs:StatVarObservation\n" + "".join(f"{p}: C:observations->{c}\n" for c, p in columns.items())
    flat.sparkSession.createDataFrame([(template,)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/template")
    return template


def transfer(df: DataFrame, url: str, table: str, batch: int = 1_000_000, properties: dict[str, str] | None = None) -> None:
    """Rows into a database over JDBC, with a check of the count."""
    df.write.option("batchsize", batch).jdbc(url, table, "overwrite", properties or {})
    want, got = df.count(), df.sparkSession.read.jdbc(url, table, properties=properties or {}).count()
    if want != got:
        raise ValueError(f"{table}: {got} of {want} rows arrived")


# reports
def report(log: DataFrame, most: int = 30, errors: int = 50) -> DataFrame:
    """level, counter, n, examples of (level, counter, message) rows; ``stop`` where there are more error counters than
    ``errors``."""
    ranked = log.withColumn("r", F.row_number().over(Window.partitionBy("level", "counter").orderBy("message")))
    by = ranked.groupBy("level", "counter").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.when(F.col("r") <= most, F.col("message")))).alias("examples"))
    every = Window.partitionBy()  # a row a counter
    return by.withColumn("stop", F.sum((F.col("level") == "ERROR").cast("int")).over(every) > errors)


def variable_report(summary: DataFrame) -> DataFrame:
    """Rows of the CSV about variables (``checks.variable_summary``), lists joined."""
    joined = [F.array_join(c, "|").alias(c) for c in ("methods", "units", "periods", "scalings")]
    return summary.select("variable", "n_points", "n_places", "n_dates", "min_value", "max_value", *joined)


def progress(files: dict[str, str]) -> str:
    """Report of an import: state of every file (STARTED, SUCCESS, FAILURE) and of the whole."""
    states = set(files.values())
    whole = "FAILURE" if "FAILURE" in states else "STARTED" if "STARTED" in states else "SUCCESS"
    return json.dumps({"status": whole, "files": files}, sort_keys=True)
