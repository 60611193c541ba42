"""Parts without SQL: writers, files, orchestration, state, names, cells, pruning."""

import datetime as dt
import gzip
import struct

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from statloom.operators import construct, diff, entities, groups, importers, nodes
from statloom.plans import orchestrate, sinks, state
from statloom.sources import files, mcf
from statloom.streaming import ingest

EDGE = "subject_id string, predicate string, object_id string, provenance string"


def pv(spark, rows):
    return spark.createDataFrame(rows, "node_id string, prop string, pos int, type string, value string")


def test_slices_are_filled_greedily():
    c = entities.Constraint
    kind, a, b = c("kind"), c("amount", 1, 2), c("amount", 2, 3)
    assert entities.slices([kind, a, b]) == [[kind, a], [b]] and entities.slices([]) == [[]]
    assert entities.slices([a, b, c("x", value="1")]) == [[a, c("x", value="1")], [b]]


def test_a_variable_of_many_constraints_keeps_its_groups(spark):
    props = [f"p{i:02d}" for i in range(13)]
    facts = [("V", p, "x1", "dc/base/i") for p in props[:5]] + [("V", "typeOf", "StatisticalVariable", "dc/base/i"), ("V", "populationType", "Person", "dc/base/i")]
    rows = groups.steps(groups.variables(spark.createDataFrame(facts, EDGE)))
    n = rows.select("node1").where("node1 is not null").distinct().count()
    assert n == 2**5 - 1  # every subset but the empty one
    assert {r[0] for r in rows.select("iteration").distinct().collect()} == set(range(6))


def test_pruning_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    facts = []
    for v in range(40):
        for p, o in (("typeOf", "StatisticalVariable"), ("populationType", "Part"), ("a", f"A{rng.integers(6)}x"), ("b", f"B{rng.integers(8)}x")):
            facts.append((f"v{v}", p, o, "dc/base/i"))
    edges = groups.build_groups(spark.createDataFrame(facts, EDGE))
    made = {r[0] for r in edges.where("predicate = 'typeOf'").select("subject_id").collect()}
    up = {(r["subject_id"], r["object_id"]) for r in edges.where(F.col("predicate").isin("memberOf", "specializationOf")).collect()}
    left = set(made)
    for _ in range(50):
        gone = {g for g in left if len({c for c, p in up if p == g}) <= 1}
        if not gone:
            break
        left -= gone
        while any(p in gone for _, p in up):
            up = {(c, p) for c, p in up if p not in gone} | {(c, q) for c, p in up if p in gone for d, q in up if d == p}
        up = {(c, p) for c, p in up if c not in gone}
    got = groups.build_groups(spark.createDataFrame(facts, EDGE), pruned=True)
    assert {(r["subject_id"], r["object_id"]) for r in got.where(F.col("predicate").isin("memberOf", "specializationOf")).collect()} == up


def test_names_of_variables(spark):
    def sv(i, **props):
        return [(f"v{i}", p, k, "TEXT", v) for p, vs in ({"typeOf": "StatisticalVariable"} | props).items() for k, v in enumerate(vs if isinstance(vs, list) else [vs])]

    rows = sv(0, measuredProperty="count", populationType="Person", gender="Female", age="Years15To24") + sv(1, measuredProperty="income", populationType="Household", statType="medianValue", measurementDenominator="Count_Person")
    rows += sv(2, measuredProperty="precipitation", populationType="Thing", measurementQualifier="Daily, Observed & Raw", isX="false") + sv(3, measuredProperty="area", populationType="AreaOfLand", measurementDenominator="Count_Household")
    got = {r["node_id"]: r["n"] for r in nodes.with_variable_name(construct.gathered(pv(spark, rows))).select("node_id", F.col("variable_name").alias("n")).collect()}
    assert got == {"v0": "Population: Years 15 To 24, Female", "v1": "Median Income of Household (Per capita)", "v2": "Daily Precipitation (Observed & Raw): Is X (False)", "v3": "Area Of Land (As fraction of Count Household)"}


def test_generated_ids(spark):
    got = nodes.keyed(pv(spark, [("x", "typeOf", 0, "RESOLVED_REF", "StatisticalVariable"), ("x", "populationType", 0, "RESOLVED_REF", "Person")])).first()
    assert got["key_text"] == "populationType=PersontypeOf=StatisticalVariable" and got["dcid"].startswith("dc/") and len(got["dcid"]) <= 16


def test_cells_of_coordinates(spark):
    got = spark.createDataFrame([("38.7#-119.4",), ("x#1",), ("nope",), (None,)], "p string").select(importers.s2_cells(F.col("p"), 10).alias("c")).collect()
    assert [r["c"] for r in got] == ["s2CellId/0x80982b0000000000", None, None, None]
    ids = importers.s2_cell_ids(np.array([0.0, 90.0, -90.0, 10.0]), np.array([0.0, 0.0, 0.0, 179.9]), 0)
    assert [int(x) >> 61 for x in ids] == [0, 2, 5, 3]


def test_large_literals_and_shapes(spark):
    rows = [("n", "typeOf", 0, "RESOLVED_REF", "Place"), ("n", "geoJsonCoordinates", 0, "TEXT", "{}" * 10), ("n", "note", 0, "TEXT", "x" * 2_621_441), ("n", "short", 0, "TEXT", " s ")]
    got = {r["value"]: r for r in construct.graph_to_nodes(construct.gathered(pv(spark, rows))).collect()}
    assert set(got) == {"n", None, " s "} and gzip.decompress(bytes(got[None]["bytes"])) == b"{}" * 10 and got[" s "]["subject_id"].startswith("s:")
    assert got["n"]["name"] == "n" and got["n"]["types"] == ["Place"]
    assert {r["predicate"] for r in construct.graph_to_edges(construct.gathered(pv(spark, rows)), "p").collect()} == {"typeOf", "geoJsonCoordinates", "short"}


def test_observations_without_entities_fail_or_go(spark):
    rows = [("o", "typeOf", 0, "RESOLVED_REF", "StatVarObservation"), ("o", "value", 0, "NUMBER", "1")]
    assert construct.observations(construct.gathered(pv(spark, rows)), "i", lenient=True).count() == 0
    with pytest.raises(Exception, match="without an entity"):
        construct.observations(construct.gathered(pv(spark, rows)), "i").collect()


def test_several_values_of_a_key_fail(spark):
    two = spark.createDataFrame([("k", "1"), ("k", "2")], "key string, value string")
    with pytest.raises(Exception, match="several values"):
        diff.changes(two, two.where("false")).collect()


def test_changes_are_written_with_a_header(spark, tmp_path):
    now = spark.createDataFrame([("a;b", '"1,000"'), ("c", "2")], "key string, value string")
    diff.write_changes(diff.changes(now, spark.createDataFrame([("c", "3")], "key string, value string")), str(tmp_path / "d"))
    text = next((tmp_path / "d").glob("part*")).read_text().splitlines()
    assert text[0] == "key_combined,value_combined_current,value_combined_previous,diff_type" and sorted(text[1:]) == ['a;b,"1,000",,ADDED', "c,2,3,MODIFIED"]


def test_tables_are_upserted_and_scoped(spark, tmp_path):
    folder, name = str(tmp_path), ["subject_id", "predicate", "object_id", "provenance"]
    n = spark.createDataFrame([("a", "A"), ("b", "B")], "subject_id string, name string")
    e = lambda o, p: spark.createDataFrame([("a", "in", o, p)], EDGE)
    s = spark.createDataFrame([("v", "a", "", "f", "{}")], "variable_measured string, entity1 string, extra_entities_id string, facet_id string, facet string")
    o = lambda v: spark.createDataFrame([("v", "a", "", "f", "2020", v)], "variable_measured string, entity1 string, extra_entities_id string, facet_id string, date string, value string")
    assert sinks.ordered_write(n, e("x", "p"), s, o("1"), folder, "p") == ["node", "edge", "time_series", "observation"]
    sinks.upsert(e("y", "q"), f"{folder}/edge", "edge")
    sinks.ordered_write(spark.createDataFrame([("b", "B2")], "subject_id string, name string"), e("z", "p"), s, o("2"), folder, "p")
    sinks.upsert(spark.createDataFrame([("a",), ("c",)], "subject_id string"), f"{folder}/node", "node")
    read = lambda t: spark.read.parquet(f"{folder}/{t}").collect()
    assert {tuple(r) for r in read("node")} == {("a", "A"), ("b", "B2"), ("c", None)} and {r["object_id"] for r in read("edge")} == {"y", "z"}
    assert [r["value"] for r in read("observation")] == ["2"] and len(read("time_series")) == 1 and spark.read.parquet(f"{folder}/edge").columns == name


def test_texts_are_written_and_read_again(spark, tmp_path):
    rows = pv(spark, [("a", "typeOf", 0, "RESOLVED_REF", "T"), ("a", "name", 0, "TEXT", 'x "y"'), ("b", "typeOf", 0, "RESOLVED_REF", "T")])
    sinks.write_pair(mcf.to_mcf(rows), spark.createDataFrame([("b", "bad")], "node_id string, error string"), str(tmp_path / "m"))
    assert {tuple(r) for r in mcf.read_mcf(spark, str(tmp_path / "m" / "resolved")).select("node_id", "prop", "value").collect()} == {("a", "typeOf", "T"), ("a", "name", 'x "y"')}
    assert "# bad" in spark.read.text(str(tmp_path / "m" / "failed"), wholetext=True).first()[0]
    flat = spark.createDataFrame([(f"e{i}", "v", "2020", str(i), "p", "", "", "", "", "") for i in range(25)], ", ".join(f"{c} string" for c in importers.FLAT))
    sinks.write_jsonld(sinks.jsonld_observations(flat), str(tmp_path / "j"), 10)
    back = mcf.parse_jsonld(spark.read.text(str(tmp_path / "j"), wholetext=True))
    assert back.where("prop = 'value'").count() == 25
    assert "Node: E:observations->E0" in sinks.write_main(flat, mcf.to_mcf(rows), str(tmp_path / "main"))
    assert spark.read.option("header", "true").csv(str(tmp_path / "main" / "observations")).count() == 25


def test_templates_read_files(spark, tmp_path):
    (tmp_path / "t.tmcf").write_text("Node: E:t->E0\ntypeOf: dcs:Place\ndcid: C:t->id\nname: C:t->n\nNode: E:t->E1\ntypeOf: dcs:StatVarObservation\nobservationAbout: E:t->E0\nvalue: C:t->v")
    (tmp_path / "t.csv").write_text('﻿id,n,v\np/1,"a, b",1\np/2,c,\n')
    rows = mcf.read_tmcf(spark, str(tmp_path / "t.tmcf"), str(tmp_path / "t.csv")).collect()
    assert {r["node_id"] for r in rows} == {"p/1", "p/2", "l:t/E1/0", "l:t/E1/1"}
    assert {r["value"] for r in rows if r["prop"] == "name"} == {"a", "b", "c"} and sum(r["prop"] == "value" for r in rows) == 1


def test_record_files(spark, tmp_path):
    def field(n, v):
        return bytes([n << 3 | 2, len(v)]) + v

    key = field(1, b"place/1") + field(2, b"V") + field(6, b"USD")
    obs = field(1, b"2020") + bytes([2 << 3 | 1]) + struct.pack("<d", 2.5) + field(5, b"dc/o/1")
    text = field(1, b"2021") + field(3, b"many") + field(5, b"dc/o/2")
    record = files.frame(field(1, field(1, key) + field(2, obs) + field(2, text)))
    (tmp_path / "a.tfrecord.gz").write_bytes(gzip.compress(record * 2))
    got = files.series_points(files.read_records(spark, str(tmp_path / "a.tfrecord.gz"))).collect()
    assert [(r["observation_about"], r["unit"], r["date"], r["value"]) for r in got] == [("place/1", "USD", "2020", "2.5"), ("place/1", "USD", "2021", "many")] * 2
    assert mcf.read_graph(spark, str(tmp_path / "a.tfrecord.gz")).where("prop = 'value' and node_id = 'dc/o/1'").first()["value"] == "2.5"
    with pytest.raises(ValueError, match="damaged"):
        list(files.frames(record[:-1] + b"x"))
    assert files.crc32c(b"123456789") == 0xE3069283


def test_jsonld_forms():
    doc = [{"@context": {"dcid": "https://x/browser/", "about": {"@id": "dcid:observationAbout", "@type": "@id"}}, "@id": "dcid:o/1", "@type": ["dcid:StatVarObservation"], "about": "dcid:p", "dcid:value": 5, "dcid:tags": ["a", {"@value": True}], "l": {"@id": "l:x"}}]
    got = {(p, k): (t, v) for _, p, k, t, v in mcf.expand_jsonld(doc)}
    assert got["observationAbout", 0] == ("RESOLVED_REF", "p") and got["value", 0] == ("NUMBER", "5") and got["tags", 1] == ("TEXT", "true") and got["l", 0] == ("UNRESOLVED_REF", "l:x") and got["typeOf", 0][1] == "StatVarObservation"


def test_patterns_and_groups_of_files():
    yes = [("a/b/c.csv", "*.csv"), ("a/b/c.csv", "b/*.csv"), ("a/b/c.csv", "/a/**/c.csv"), ("a/c.csv", "/a/**/c.csv"), ("gs://k/a.csv", "gs://k/*.csv"), ("x/a.tsv", "{x,y}/*.{csv,tsv}")]
    no = [("a/b/c.csv", "/b/*.csv"), ("a/b/c.csv", "a/*.csv"), ("a.csv", "gs://a.csv"), ("a/xcsv", "a/*.csv")]
    assert all(files.matches(p, q) for p, q in yes) and not any(files.matches(p, q) for p, q in no)
    with pytest.raises(ValueError):
        files.pattern_regex("a/**.csv")
    assert files.discovered(["a.csv", "b.zip", "c.mcf", "s.csv"], ["*.csv"], {"x": "s.csv"}) == {"a.csv": "*.csv"}
    assert files.grouped(["a.mcf", "b.tmcf", "c.tsv"])["delimiter"] == "\t"
    for bad in (["a.csv", "b.tsv"], ["a.exe"], ["a.jsonld", "b.mcf"]):
        with pytest.raises(ValueError):
            files.grouped(bad)
    c = files.Config({"inputFiles": {"*.csv": {"provenance": "P"}, "b.*": {"format": "x"}}, "generateHierarchy": "yes", "customIdNamespace": "me/"})
    assert c.of("b.csv", "provenance") == "P" and c.of("b.csv", "format") == "variablePerRow" and c.flag("generateHierarchy") and c.group_prefix() == "me/g/" and c.variable("v")["name"] == "v"


def test_ids_groups_and_headers():
    seen: list[int] = []
    assert importers.variable_id("a b-c") == "a_b_c" and importers.variable_id("50%", seen) == "custom/statvar_1" and importers.variable_id("dc/x") == "dc/x"
    assert importers.group_paths(["a/b", "a/c"]) == [("a", "custom/g/group_1", "a", "dc/g/Root"), ("a/b", "custom/g/group_2", "b", "custom/g/group_1"), ("a/c", "custom/g/group_3", "c", "custom/g/group_1")]
    good = {"observationAbout": "e", "variableMeasured": "v", "observationDate": "d", "value": "x"}
    assert importers.header_errors(good, ["e", "v", "d", "x"]) == [] and len(importers.header_errors({"value": "x"}, ["x"])) == 3
    assert "neither mapped" in importers.header_errors(good, ["e", "v", "d", "x", "y"])[0] and "not there" in importers.header_errors(good, ["e"])[0]


def test_values_that_are_no_numbers_fail(spark):
    with pytest.raises(Exception, match="no number"):
        importers.wide_to_long(spark.createDataFrame([("e", "2020", "many")], "e string, d string, v string"), "p").collect()


def test_steps_run_in_order():
    s = orchestrate.Step
    steps = [s("PLACE_AGGREGATION", ["a"], "b"), s("LINKED_EDGES", ["a"]), s("STAT_VAR_AGGREGATION", ["b"], "c", stage=2), s("NODE_PROPERTIES", []), s("STAT_VAR_GROUPS", []), s("ENTITY_AGGREGATION", ["z"], "q"), s("STAT_VAR_CALCULATION", ["*"], "a", disabled=True)]
    assert orchestrate.expanded(steps, ["a"]) == ["a", "b", "c"] and orchestrate.outputs(steps, ["a", "b"]) == ["b", "c"]
    gone: list[str] = []
    done = orchestrate.run(steps, ["a"], lambda step, name: None, gone.extend)
    assert done == [("LINKED_EDGES", "a"), ("PLACE_AGGREGATION", "a"), ("STAT_VAR_AGGREGATION", "b"), ("STAT_VAR_GROUPS", None), ("NODE_PROPERTIES", None)] and gone == ["b", "c"]
    assert orchestrate.check([s("X", ["a"]), s("LINKED_EDGES", [])]) == ["X: unknown type X", "LINKED_EDGES: no inputs"]


def test_state_of_imports(spark):
    now = dt.datetime(2024, 1, 1, 12)
    lock = state.acquired(spark.createDataFrame([], state.LOCK), "l", "me", now)
    assert not state.may_acquire(lock, "l", 60, now) and state.may_acquire(lock, "l", 60, now + dt.timedelta(hours=1)) and state.may_acquire(state.released(lock, "l", "me"), "l", 60, now) and not state.may_acquire(state.released(lock, "l", "you"), "l", 60, now)
    status = spark.createDataFrame([("i", "SUCCESS", "v2", "g", now)], state.STATUS)
    history = spark.createDataFrame([("i", "v1", "SUCCESS", "", now), ("i", "v2", "SUCCESS", "", now + dt.timedelta(days=1)), ("i", "v0", "FAILURE", "", now)], state.HISTORY)
    new, log = state.reverted(status, history, "i", now)
    assert tuple(new.first())[:4] == ("i", "STAGING", "v1", "g") and log.count() == 4
    with pytest.raises(ValueError):
        state.reverted(status, history.where("version = 'v2'"), "i", now)
    assert state.seeds(spark).count() == 5 and set(state.runtime()) == {"user", "host", "system", "python", "started"}
    feed = spark.createDataFrame([("1", "i", "v1", now), ("1", "i", "v1", now), ("2", "i", "v2", now), ("0", "j", "v", now)], "id string, import_name string, version string, time timestamp")
    assert [tuple(r)[:2] for r in state.new_messages(feed, feed.where("id = '0'")).collect()] == [("i", "v2")]


def test_new_files_are_merged(spark, tmp_path):
    src, dst = str(tmp_path / "in"), str(tmp_path / "out")
    for k in range(2):
        spark.createDataFrame(pd.DataFrame({"subject_id": ["a", f"b{k}"], "name": [f"A{k}", "B"]})).write.mode("append").parquet(src)
        ingest(spark, src, "subject_id string, name string", dst, "node", str(tmp_path / "cp")).awaitTermination(60)
    assert {tuple(r) for r in spark.read.parquet(dst).collect()} == {("a", "A1"), ("b0", "B"), ("b1", "B")}


def test_nearest_equals_brute_force(spark, monkeypatch):
    from statloom.operators import vectors

    monkeypatch.setattr(vectors, "PART", 300)
    rng = np.random.default_rng(2)
    v = rng.integers(-2, 3, (300, 8)).astype(float)
    v[7] = 0
    rows = [(f"i{i:03d}", v[i].tolist()) for i in range(300)] + [("none", None)]
    df = spark.createDataFrame(rows, "vec_id string, embedding array<double>")
    got = {}
    for r in vectors.nearest(df, df.where("vec_id like '%0' or vec_id = 'i007'"), 4).orderBy("query", "rank").collect():
        got.setdefault(r["query"], []).append(r["item"])
    n = np.linalg.norm(v, axis=1)
    want = {}
    for i in range(0, 300, 10):
        s = [(-round(float(v[i] @ v[j] / (n[i] * n[j])), 9), f"i{j:03d}") for j in range(300) if j != i and n[j] > 0]
        want[f"i{i:03d}"] = [name for _, name in sorted(s)[:4]]
    assert got == {q: w for q, w in want.items() if n[int(q[1:])] > 0}


def test_progress_and_versions(spark, tmp_path):
    assert '"status": "FAILURE"' in sinks.progress({"a": "SUCCESS", "b": "FAILURE"})
    assert state.initialised(spark, {"t": "a int"}, str(tmp_path)) == ["t"] and state.initialised(spark, {"t": "a int"}, str(tmp_path)) == []
    state.version_files(str(tmp_path), "i", "v1", "fine", spark)
    assert spark.read.text(str(tmp_path / "i" / "latest_version")).first()[0] == "v1"
