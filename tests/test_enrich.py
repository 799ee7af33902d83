from eventweave.operators import enrich
from eventweave.sources import articles, fixtures, portal


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_lookups(spark):
    make = spark.createDataFrame
    e = make([("Q1",), ("Q2",), ("Q2",)], "entity_id string")
    labels = make([("Q1", "One", "en"), ("Q1", "Eins", "de"), ("Q9", "Nine", "en")], "entity_id string, label string, lang string")
    assert rows(enrich.labels_of(e, labels)) == [("Q1", "One")]
    props = make([("P17", "P276"), ("P276", "location"), ("P18", "location"), ("P18", "image")], "property string, parent string")
    direct = make([("P17", "wdt:P17"), ("P18", "wdt:P18"), ("P276", "wdt:P276")], "property string, predicate string")
    claims = make([("Q1", "wdt:P17", "Q5", "uri"), ("Q1", "wdt:P276", "Q5", "uri"), ("Q1", "wdt:P18", "pic", "uri"), ("Q3", "wdt:P17", "Q5", "uri")], "s string, p string, o string, o_kind string")
    assert rows(enrich.location_relations(props)) == [("P17",), ("P276",)]
    assert [(r.entity_id, r.location) for r in enrich.parent_locations(e, claims, props, direct).collect()] == [("Q1", {"Q5": ["wdt:P17", "wdt:P276"]})]
    assert len(rows(enrich.one_hop(e, claims))) == 3
    sitelinks = make([("Q1", "u1"), ("Q2", None)], "entity_id string, article_url string")
    assert rows(enrich.article_urls(e, sitelinks)) == [("Q1", "u1"), ("Q2", None)]
    links = make([('say "hi"', ["Q1"], ["d"])], "text string, wikidata array<string>, dbpedia array<string>")
    texts = make([("say hi",), ("x",)], "text string")
    assert rows(enrich.linked_entities(texts, links)) == [("say hi", ["Q1"], ["d"]), ("x", [], [])]


def test_outlines_fall_back_to_objects(spark):
    make = spark.createDataFrame
    e = make([("Q1",), ("Q2",), ("Q3",)], "entity_id string")
    ids = make([("x/Q1", "12", "way/3"), ("x/Q1", "bad", None), ("x/Q2", None, "node/4"), ("x/Q2", None, "area/4"), ("x/Q3", None, None)], "entity_uri string, osmrelid string, osmobj string")
    keys = enrich.outline_keys(enrich.osm_ids(e, ids))
    assert rows(keys) == [("Q1", "relation/12"), ("Q2", "node/4")]
    outlines = make([("node/4", "9", "node", "POINT (1 2)"), ("node/4", "8", "node", "POINT (1 1)")], "query_key string, osm_id string, osm_type string, wkt string")
    assert rows(enrich.geocoded(keys, outlines)) == [("Q1", "relation/12", None, None, None), ("Q2", "node/4", "8", "node", "POINT (1 1)")]


def test_events_places_and_depth(spark):
    events = portal.portal_events(fixtures.portal_pages(spark))
    links = enrich.article_links(events)
    wiki = "https://en.wikipedia.org/wiki/"
    assert sorted(r.url for r in links.collect()) == [wiki + "Northtown", wiki + "Reds"]
    parsed = articles.articles(fixtures.article_pages(spark))
    start = spark.createDataFrame([(wiki + "Storm_Ada",)], "url string")
    assert rows(enrich.expanded(start, parsed)) == [(wiki + "Northtown", 2), (wiki + "Storm_Ada", 1)]
    places = spark.createDataFrame([(wiki + "Northtown",)], "url string")
    assert rows(enrich.location_counts(links, places)) == [(0, 1, 0)]
    assert [r.place_url for r in enrich.events_with_location(links, events, places).collect()] == [wiki + "Northtown"]


def test_types_come_from_the_nearest_level(spark):
    make = spark.createDataFrame
    topics = make([("e1", "a"), ("e2", "b"), ("e3", "z")], "event string, topic string")
    types = make([("a", "X"), ("a", "Y"), ("p", "Z")], "topic string, class string")
    parents = make([("a", "p"), ("b", "p")], "topic string, parent string")
    assert rows(enrich.event_types(types, parents, topics)) == [("e1", ["X", "Y"]), ("e2", ["Z"])]
    located = make([("e1", "n"), ("e1", "c"), ("e2", "n")], "event string, place string")
    assert rows(enrich.contained_places(located, make([("n", "c"), ("n", "n")], "place string, parent string"))) == [("e1", "n", "c")]


def test_leaf_places_take_one_pass_over_located(spark):
    located = spark.createDataFrame([("e", "a"), ("e", "b"), ("e", "b"), ("f", "b"), ("f", None), ("g", "c"), ("g", "d"), ("h", "d")], "event string, place string")
    parents = spark.createDataFrame([("a", "b"), ("b", "x"), ("c", "d"), ("c", "c"), ("d", "c")], "place string, parent string")
    leaves = enrich.leaf_places(located.repartition(3), parents)
    assert sorted((r.event, r.place or "") for r in leaves.collect()) == [("e", "a"), ("f", ""), ("f", "b"), ("h", "d")]
    plan = leaves._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 2 and plan.count("Join") == 1
