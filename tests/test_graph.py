"""Graph queries against their SQL, readers of node text, fingerprints against known values."""

import pytest

from statloom.functions.ids import base32, farm_fingerprints
from statloom.plans import catalogue, check_queries, graph_queries, import_queries, registry  # noqa: F401
from statloom.sources import mcf


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_queries_equal_their_sql(name, same_as_sql):
    same_as_sql(registry.QUERIES[name], registry.SQL[name])


def test_fingerprints_of_known_texts():
    assert farm_fingerprints(["", "a", "NewType22", None]) == [-7286425919675154353, -5528939962900187677, 1402865626124284682, None]
    assert base32(1402865626124284682) == "bsxxcsbwvey61"


def test_node_text_is_typed(spark):
    text = 'Node: dcid:A\n// note\ntypeOf: dcs:Thing\nname: "x, \\"y\\"", plain\nage: [Years 18 -]\nn: 5, true\nlink: l:B\nbad: "open\n'
    rows = {(r["prop"], r["pos"]): (r["type"], r["value"]) for r in mcf.parse_text(spark.createDataFrame([(text,), (None,), ("",)], "value string"), resolved=False).collect()}
    assert rows["typeOf", 0] == ("RESOLVED_REF", "Thing") and rows["name", 0] == ("TEXT", 'x, "y"') and rows["name", 1] == ("TEXT", "plain")
    assert rows["age", 0][0] == "COMPLEX_VALUE" and rows["n", 0][0] == rows["n", 1][0] == "NUMBER" and rows["link", 0] == ("UNRESOLVED_REF", "l:B") and rows["bad", 0] == ("ERROR", None)


def test_templates_expand_rows(spark):
    t = mcf.parse_template("Node: E:t->E0\ntypeOf: dcs:StatVarObservation\nvariableMeasured: C:t->v\nobservationAbout: E:t->E1\nNode: E:t->E1\ntypeOf: schema:Country\ndcid: C:t->c")
    table = spark.createDataFrame([("Count", "country/X"), ("", "")], "v string, c string")
    rows = mcf.expand_template(table, t).collect()
    assert ("observationAbout", "RESOLVED_REF", "country/X") in {(r["prop"], r["type"], r["value"]) for r in rows}
    assert sum(r["prop"] == "variableMeasured" for r in rows) == 1 and sum(r["prop"] == "typeOf" for r in rows) == 4
    with pytest.raises(ValueError):
        mcf.expand_template(table.drop("c"), t)


def test_jsonld_graphs_are_flattened(spark):
    text = '{"@context": {}, "@graph": [{"@id": "dcid:A", "@type": "dcs:Place", "http://x/name": {"@value": "n"}, "in": {"@id": "dcid:B"}, "k": 3}]}'
    rows = {r["prop"]: (r["node_id"], r["type"], r["value"]) for r in mcf.parse_jsonld(spark.createDataFrame([(text,)], "value string")).collect()}
    assert rows == {"typeOf": ("A", "RESOLVED_REF", "Place"), "name": ("A", "TEXT", "n"), "in": ("A", "RESOLVED_REF", "B"), "k": ("A", "NUMBER", "3")}
