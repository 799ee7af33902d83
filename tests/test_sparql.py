import pytest

from eventweave.plans.sparql import sparql, tokens

ROWS = [
    ("e1", "type", "Event"), ("e2", "type", "Event"), ("e3", "type", "Talk"), ("e1", "day", "2022-03-04"), ("e2", "day", "2022-03-05"), ("e1", "during", "t1"), ("e2", "during", "t2"),
    ("t1", "during", "t2"), ("t2", "during", "t3"), ("t2", "label", "Two"), ("t3", "label", "Three"),
]


@pytest.fixture(scope="module")
def t(spark):
    return spark.createDataFrame(ROWS, "s string, p string, o string")


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("SELECT ?e WHERE { ?e a Event }", [("e1",), ("e2",)]),
        ("SELECT ?e ?t { ?e a Event ; during+ ?t }", [("e1", "t1"), ("e1", "t2"), ("e1", "t3"), ("e2", "t2"), ("e2", "t3")]),
        ("SELECT ?l { <e1> during*/label ?l }", [("Three",), ("Two",)]),
        ("SELECT ?t ?l { ?e during ?t OPTIONAL { ?t label ?l } FILTER(?e != \"t2\") }", [("t1", None), ("t2", "Two"), ("t2", "Two")]),
        ("SELECT DISTINCT ?t { ?e during ?t FILTER EXISTS { ?t label ?l } }", [("t2",), ("t3",)]),
        ("SELECT ?x { ?x during ?y FILTER NOT EXISTS { ?x a Event } }", [("t1",), ("t2",)]),
        ("SELECT (COUNT(*) AS ?n) ?m { ?e day ?d BIND(MONTH(?d) AS ?m) } GROUP BY ?m", [(2, 3)]),
        ("SELECT (MIN(?d) AS ?first) { ?e day ?d }", [("2022-03-04",)]),
        ("SELECT ?e { ?e day ?d FILTER(DAY(?d) = 5 || ?e = \"e9\") }", [("e2",)]),
        ("SELECT ?a { { ?a a Talk } UNION { ?a label \"Two\" } }", [("e3",), ("t2",)]),
        ("SELECT ?y { <t1> during? ?y }", [("t1",), ("t2",)]),
        ("SELECT ?e { ?e day ?d } ORDER BY DESC(?d) LIMIT 1", [("e2",)]),
        ("SELECT ?p { <t2> ?p ?o }", [("during",), ("label",)]),
        ("ASK { ?e a Talk }", [(True,)]),
        ("PREFIX x: <http://x/> ASK { ?e x:during x:t9 }", [(False,)]),
    ],
)
def test_queries(t, text, want):
    got = [tuple(r) for r in sparql(t, text).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_odd_text_is_refused():
    with pytest.raises(ValueError, match="unexpected"):
        tokens("SELECT ?a { ?a ^b ?c }")


GRAPHS = [
    ("a", "e1", "during", "t1"), ("b", "t1", "during", "t2"), ("a", "t1", "label", "one"), ("b", "e2", "during", "t1"), ("b", "t2", "label", "two"), ("a", "t2", "label", "two in a"), ("c", "x", "label", "x"),
]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        # the path e1 / t1 / t2 is over two graphs
        ("SELECT ?x ?y { ?x during+ ?y }", [("a", "e1", "t1"), ("b", "e2", "t1"), ("b", "e2", "t2"), ("b", "t1", "t2")]),
        ("SELECT ?l { <e1> during*/label ?l }", [("a", "one")]),
        ("SELECT ?x ?l { ?x during ?y OPTIONAL { ?y label ?l } }", [("a", "e1", "one"), ("b", "e2", None), ("b", "t1", "two")]),
        ("SELECT (COUNT(*) AS ?n) { ?x label ?l }", [("a", 2), ("b", 1), ("c", 1)]),
        ("SELECT ?x { ?x during ?y FILTER NOT EXISTS { ?y label ?l } }", [("b", "e2")]),
        ("ASK { ?x during ?y . ?y during ?z }", [("a", False), ("b", True), ("c", False)]),
        ("SELECT ?x { ?x label ?l } ORDER BY ?x LIMIT 1", [("a", "t1"), ("b", "t2"), ("c", "x")]),
        ("SELECT ?y { <t1> during? ?y }", [("a", "t1"), ("b", "t1"), ("b", "t2"), ("c", "t1")]),
        ("SELECT ?x FROM <b> { ?x during ?y }", [("b", "e2"), ("b", "t1")]),
        ("SELECT ?l { OPTIONAL { ?z none ?w } ?x label ?l } ", [("a", "one"), ("a", "two in a"), ("b", "two"), ("c", "x")]),
    ],
)
def test_each_graph_is_evaluated_apart(spark, text, want):
    from eventweave.plans.sparql import sparql_by_graph

    t = spark.createDataFrame(GRAPHS, "month string, s string, p string, o string")
    assert sorted(map(tuple, sparql_by_graph(t, text).collect()), key=str) == sorted(want, key=str)


def test_an_unbound_variable_agrees_with_any_value(t):
    # ?l is unbound for t1; the second optional binds it
    got = sparql(t, 'SELECT ?x ?l { ?x during ?y OPTIONAL { ?x label ?l } OPTIONAL { ?y label ?l } }')
    assert sorted(map(tuple, got.collect()), key=str) == [("e1", None), ("e2", "Two"), ("t1", "Two"), ("t2", "Two")]


def test_delete_takes_what_its_template_names(spark):
    from eventweave.plans.sparql import deleted, update

    rows = [("a", "x", "type", "News"), ("a", "x", "label", "X"), ("a", "x", "size", "3"), ("b", "x", "label", "B"), ("b", "x", "type", "News"), ("a", "y", "type", "News"), ("a", "z", "type", "Other"), ("a", "z", "label", "Z")]
    store = spark.createDataFrame(rows, "month string, s string, p string, o string")
    text = "DELETE { ?u a News ; label ?l ; size ?n } WHERE { ?u a News ; label ?l OPTIONAL { ?u size ?n } }"
    left = lambda df: sorted(tuple(r) for r in df.collect())
    assert left(update(store, "WITH <a> " + text)) == sorted(r for r in rows if r[1] != "x" or r[0] == "b")  # y lacks a label, so nothing of it goes
    assert left(update(store, text)) == sorted(r for r in rows if r[1] != "x")
    given = spark.createDataFrame([("y",), ("z",)], "u string")
    assert left(update(store, text, given)) == sorted(rows)
    assert left(deleted(store, text, spark.createDataFrame([("x",)], "u string"), "month")) == sorted(r for r in rows if r[1] == "x")
