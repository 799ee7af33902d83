import random

import pytest
import zstandard
from pyspark.sql import functions as F

from eventweave.functions import geo
from eventweave.operators import closure, eventmap, maintain, metrics
from eventweave.plans.sparql import deleted, sparql
from eventweave.sources import modules, pages, triples

SCHEMA = "module string, month string, s string, p string, o string, o_kind string, o_datatype string, o_lang string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_packed_pages_come_before_plain_ones(spark, tmp_path):
    (tmp_path / "A%2FB.html").write_text("plain é")
    (tmp_path / "Both.html").write_text("old")
    (tmp_path / "Both.html.zst").write_bytes(zstandard.ZstdCompressor().compress("new ü".encode()))
    got = pages.cached_pages(spark, f"file://{tmp_path}")
    assert rows(got) == [("A/B", "plain é"), ("Both", "new ü")]
    table = pages.upgraded(spark, f"file://{tmp_path}", f"file://{tmp_path}-table")
    (tmp_path / "Both.html.zst").write_bytes(zstandard.ZstdCompressor().compress(b"newer"))
    (tmp_path / "C.html").write_text("c")
    again = pages.upgraded(spark, f"file://{tmp_path}", f"file://{tmp_path}-table", known=table)
    assert rows(pages.unpacked_table(again)) == [("A/B", "plain é"), ("Both", "new ü"), ("C", "c")]
    urls = spark.createDataFrame([("https://x/wiki/C",), ("https://x/wiki/C/sub",), ("https://x/wiki/D",)], "url string")
    assert rows(pages.article_snapshot(pages.unpacked_table(again), urls)) == [("https://x/wiki/C", "c"), ("https://x/wiki/C/sub", "c")]


def test_module_files_and_named_graphs(spark, tmp_path):
    facts = [("base", "May_2020", "a", "p", "x", "literal", "xsd:string", None), ("base", "May_2020", "a", "q", "b", "uri", None, None), ("ohg", "June_2020", "c", "p", 'é "', "literal", None, "de"), ("base", "June_2020", "a", "q", "b", "uri", None, None)]
    graph = spark.createDataFrame(facts, SCHEMA)
    folder = f"file://{tmp_path}/m"
    modules.save(graph.unionByName(graph), folder)
    assert rows(modules.load(spark, folder)) == sorted(facts, key=str)
    assert rows(modules.load(spark, folder, ["June_2020"], ["ohg"])) == [facts[2]]
    assert modules.exists(spark, folder, "May_2020") and not modules.exists(spark, folder, "July_2020")
    modules.save(graph.where("month = 'May_2020'").limit(1), folder)
    assert len(rows(modules.load(spark, folder))) == 3
    sized = {(r.month, r.module): r.bytes for r in modules.sizes(spark, folder).collect()}
    assert sized["June_2020", "ohg"] > 0
    assert rows(modules.average_megabytes(spark.createDataFrame([("m", "base", 2_000_000), ("n", "base", 4_000_000)], "month string, module string, bytes long"))) == [("base", 3.0)]
    assert len(rows(modules.merged(graph))) == 3
    modules.turtle(graph, f"file://{tmp_path}/ttl", extensions=())
    assert spark.read.text(f"file://{tmp_path}/ttl").where("month = 'June_2020'").count() == 1
    store = modules.Store(spark, f"file://{tmp_path}/store")
    assert store.graphs() == []
    store.load(graph)
    store.load(graph.where("month = 'May_2020'").limit(1))
    assert store.graphs() == ["June_2020", "May_2020"]
    assert store.scan("May_2020").count() == 1 and store.scan().count() == 3
    assert store.drop("May_2020") and store.graphs() == ["June_2020"]
    store.reset()
    assert store.graphs() == []


def test_terms_of_an_unknown_kind_raise(spark):
    df = spark.createDataFrame([('{"type": "uri", "value": "u"}',), ('{"type": "literal", "value": "v", "xml:lang": "en", "datatype": "d"}',)], "binding string")
    assert [tuple(r)[1:] for r in triples.from_bindings(df).collect()] == [("u", "uri", None, None), ("v", "literal", "d", "en")]
    with pytest.raises(Exception, match="unknown kind"):
        triples.from_bindings(spark.createDataFrame([('{"type": "odd", "value": "u"}',)], "binding string")).collect()


@pytest.mark.parametrize("seed", range(3))
def test_reach_is_the_closure_from_its_seeds(spark, seed):
    rng = random.Random(seed)
    edges = {(rng.randrange(12), rng.randrange(12)) for _ in range(14)}
    df = spark.createDataFrame([(str(a), str(b)) for a, b in edges], "src string, dst string")
    every = set(rows(closure.closure(df)))
    seeds = spark.createDataFrame([("3",), ("5",), ("99",)], "node string")
    assert set(rows(closure.reach(df, seeds))) == {p for p in every if p[0] in ("3", "5")}
    assert set(rows(closure.reach(df, seeds, backward=True))) == {p for p in every if p[1] in ("3", "5")}


def test_a_cycle_has_no_levels(spark):
    with pytest.raises(ValueError, match="cycle"):
        closure.levels(spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "b")], "src string, dst string"))
    chain = spark.createDataFrame([("a", "b"), ("b", "c"), ("a", "c")], "src string, dst string")
    assert rows(closure.levels(chain)) == [("a", 0), ("b", 1), ("c", 2)]
    assert closure.levels(chain.limit(0)).count() == 0


def test_stale_entities_leave_with_what_hangs_on_them(spark):
    store = [
        ("event/1", "type", "NewsSummary"), ("event/1", "isIdentifiedBy", "context/1"), ("context/1", "label", "x"), ("s", "referenceContext", "context/1"), ("ph", "referenceContext", "s"), ("ph", "label", "y"),
        ("article/A", "type", "WikipediaArticle"), ("article/A", "source", "url"), ("url", "type", "Document"), ("article/A", "sameAs", "Q1"), ("Q1", "P31", "Q2"), ("place/A", "wikipediaArticle", "article/A"),
        ("place/A", "hasGeometry", "point/1"), ("point/1", "lat", "1"), ("Q2", "label", "old"), ("osm/1", "type", "OsmElement"), ("osm/1", "asWKT", "w"), ("osm/1", "other", "stays"), ("n", "type", "News"), ("n", "label", "l"), ("n", "more", "m"),
    ]
    make = lambda r: spark.createDataFrame(r, "s string, p string, o string")
    fresh = make([("article/A", "type", "WikipediaArticle"), ("event/1", "type", "NewsSummary"), ("osm/1", "type", "OsmElement"), ("Q9", "type", "Q2"), ("Q2", "label", "new")])
    left = set(rows(maintain.stored(make(store), fresh, delete_old=True)))
    assert left == {tuple(r) for r in fresh.collect()} | {("osm/1", "other", "stays"), ("n", "type", "News"), ("n", "label", "l"), ("n", "more", "m")}
    assert set(rows(maintain.stored(make(store), fresh))) == set(store) | {tuple(r) for r in fresh.collect()}
    assert rows(maintain.delete_news(make(store), make([("n", "x", "x")]))) == sorted([r for r in store if r[:2] not in (("n", "type"), ("n", "label"))], key=str)


def test_shapes_points_and_ticks(spark):
    shapes = {"hole": "POLYGON ((0 0, 10 0, 10 10, 0 10, 0 0), (4 4, 6 4, 6 6, 4 6, 4 4))", "two": "MULTIPOLYGON (((0 0, 2 0, 2 2, 0 2, 0 0)), ((5 5, 9 5, 9 9, 5 9, 5 5)))", "tilted": "POLYGON ((0 0, 4 2, 0 4, 0 0))", "point": "POINT (3 4)"}
    df = spark.createDataFrame(list(shapes.items()), "area string, wkt string").withColumn("p", geo.inner_point(F.col("wkt")))
    inside = df.select("area", "p", geo.within(F.col("p.x"), F.col("p.y"), geo.edges_of(geo.rings(F.col("wkt")))).alias("ok"))
    got = {r.area: (r.p.x, r.p.y, r.ok) for r in inside.collect()}
    assert all(got[k][2] for k in ("hole", "two", "tilted")) and got["point"][:2] == (3.0, 4.0)
    hole = spark.createDataFrame([("hole", shapes["hole"])], "region string, wkt string")
    points = spark.createDataFrame([(1, 5.0, 5.0), (2, 1.0, 1.0), (3, 0.0, 5.0), (4, 11.0, 1.0)], "k int, x double, y double")
    assert [r.k for r in geo.points_in_regions(points, hole).collect()] == [2]
    # two equal squares hold each other's points: the smaller name holds the other
    twins = spark.createDataFrame([("b", shapes["hole"]), ("a", shapes["hole"])], "area string, wkt string")
    assert rows(eventmap.containment(twins)) == [("a", "b")]
    assert eventmap.ticks(400) == [0.0, 100.0, 200.0, 300.0, 400.0] and eventmap.ticks(0) == [0.0]


def test_metrics_helpers(spark, tmp_path):
    m = spark.createDataFrame([(1, 2_000_000, 120.0)], "n int, wait_ns long, month_s double")
    assert metrics.in_units(m).first()["wait_ms"] == 2.0 and metrics.in_units(m).first()["month_min"] == 2.0
    none = metrics.confusion(spark.createDataFrame([(True, False)], "t boolean, a boolean"), "t", ["a"]).first()
    assert (none.support, none.precision, none.recall, none.f1) == (1, 0.0, 0.0, 0.0)
    (tmp_path / "x.json").write_text('{"name": "a", "old": true}\n{"name": "b", "old": false}\n{"name": "a", "old": false}\n')
    log = metrics.scan_lines(spark, f"file://{tmp_path}", "name string, old boolean")
    assert rows(metrics.last_records(log)) == [("a", False), ("b", False)]


def test_groups_that_begin_with_optional_or_bind(spark):
    t = spark.createDataFrame([("a", "p", "b"), ("b", "p", "c"), ("c", "q", "d")], "s string, p string, o string")
    assert rows(sparql(t, 'SELECT ?x ?v WHERE { BIND("k" AS ?v) ?x q ?y }')) == [("c", "k")]
    assert rows(sparql(t, "SELECT ?x ?n WHERE { OPTIONAL { ?n nothing ?m } ?x q ?y }")) == [("c", None)]
    assert rows(sparql(t, 'SELECT ?x WHERE { "a" p+ ?x }')) == [("b",), ("c",)]
    assert rows(sparql(t, 'SELECT ?x WHERE { ?x p* "c" }')) == [("a",), ("b",), ("c",)]


def test_deletes_and_merges_write_only_the_months_they_touch(spark, tmp_path):
    fact = lambda m, s, p, o, kind="literal": ("base", m, s, p, o, kind, "xsd:string" if kind == "literal" else None, None)
    facts = [fact(m, f"{m}{i}", p, o, k) for m in "abc" for i in range(3) for p, o, k in (("type", "OsmElement", "uri"), ("label", f"l{i}", "literal"), ("note", "kept", "literal"))]
    store = modules.Store(spark, f"file://{tmp_path}/store")
    store.load(spark.createDataFrame(facts, SCHEMA))
    times = lambda: {p.parent.name: p.stat().st_mtime_ns for p in (tmp_path / "store").rglob("*.parquet")}
    before = times()
    text = "DELETE { ?u a OsmElement ; label ?l } WHERE { ?u a OsmElement ; label ?l }"
    given = spark.createDataFrame([("b0",), ("b1",), ("z",)], "u string")
    assert store.delete(deleted(store.scan(), text, given, "month")) == ["b"]
    after = times()
    assert {m for m in after if after[m] != before[m]} == {"month=b"}
    gone = {(s, p) for s in ("b0", "b1") for p in ("type", "label")}
    assert {(r.month, r.s, r.p, r.o) for r in store.scan().collect()} == {(f[1], *f[2:5]) for f in facts if (f[2], f[3]) not in gone}
    assert store.delete(deleted(store.scan(), text, given, "month")) == [] and times() == after  # a rerun changes nothing
    # a month without triples leaves the list
    store.delete(store.scan("a"))
    assert store.graphs() == ["b", "c"]
    # a new extraction of c0 in month d: its stale facts leave c, the rest stays
    fresh = spark.createDataFrame([fact("d", "c0", "type", "OsmElement", "uri"), fact("d", "c0", "label", "new")], SCHEMA)
    held = times()
    assert store.put(fresh, delete_old=True) == ["c", "d"]
    assert times()["month=b"] == held["month=b"]
    assert {(r.month, r.p, r.o) for r in store.scan().where("s = 'c0'").collect()} == {("c", "note", "kept"), ("d", "type", "OsmElement"), ("d", "label", "new")}
    seen = times()
    assert store.put(fresh, delete_old=True) == [] and times() == seen
    assert store.put(spark.createDataFrame([fact("b", "b9", "note", "x")], SCHEMA)) == ["b"]
    assert not list(tmp_path.glob("store_staged*"))


def test_from_prunes_months(spark, tmp_path):
    store = modules.Store(spark, f"file://{tmp_path}/store")
    store.load(spark.createDataFrame([("base", m, f"{m}1", "p", "x", "uri", None, None) for m in "abcd"], SCHEMA))
    found = sparql(store.scan(), "SELECT ?s FROM <b> FROM <d> WHERE { ?s p ?o }")
    assert sorted(r.s for r in found.collect()) == ["b1", "d1"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan or "PartitionFilters: [month" in plan
    assert {p.rsplit("/", 2)[1] for p in store.scan("b", "d").inputFiles()} >= {"month=b", "month=d"}


def test_packed_module_files_hold_the_same_and_take_less(spark, tmp_path):
    facts = [("raw", "May_2020", f"a{i}", "p", f"<li>é {i} " + "x" * 200, "literal", "xsd:string", None) for i in range(200)]
    graph = spark.createDataFrame(facts, SCHEMA)
    size = {}
    for packed in (False, True):
        folder = f"file://{tmp_path}/{packed}"
        modules.save(graph, folder, packed=packed)
        assert rows(modules.load(spark, folder)) == sorted(facts, key=str) and modules.exists(spark, folder, "May_2020")
        size[packed] = {r.module: r.bytes for r in modules.sizes(spark, folder).collect()}["raw"]
    assert 5 * size[True] < size[False]
