import datetime
import random
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from eventweave.functions import datetimes, geo, terms, text
from eventweave.operators import closure, maintain, metrics, patterns
from eventweave.sources import articles, fixtures, portal, rendered, triples


def reach(edges):
    out = {}
    for a, _ in edges:
        seen, stack = set(), [a]
        while stack:
            x = stack.pop()
            for s, d in edges:
                if s == x and d not in seen:
                    seen.add(d)
                    stack.append(d)
        out[a] = seen
    return {(a, b) for a, bs in out.items() for b in bs}


@pytest.mark.parametrize("seed", [1, 2])
def test_closure_reduction_and_levels(spark, seed):
    rng = random.Random(seed)
    edges = sorted({(min(p), max(p)) for p in (rng.sample(range(14), 2) for _ in range(30))})
    df = spark.createDataFrame(edges, "src int, dst int")
    pairs = reach(edges)
    assert {tuple(r) for r in closure.closure(df).collect()} == pairs
    kept = {(a, b) for a, b in edges if not any((a, c) in edges and (c, b) in pairs for c in range(14))}
    assert {tuple(r) for r in closure.transitive_reduction(df).collect()} == kept
    level = {}
    for n in range(14):
        level[n] = max((level[a] + 1 for a, b in edges if b == n), default=0)
    used = {x for e in edges for x in e}
    assert {r.node: r.level for r in closure.levels(df).collect()} == {n: level[n] for n in used}


def test_closure_ends_on_cycles(spark):
    df = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), (None, "a")], "src string, dst string")
    assert closure.closure(df).count() == 9


def test_patterns(spark):
    t = spark.createDataFrame([("a", "p", "b"), ("b", "p", "c"), ("a", "l", "A"), ("c", "l", "C"), ("c", "m", "M")], "s string, p string, o string")
    nodes = t.select("s")
    assert {tuple(r) for r in patterns.star(t, "p", "x", "y", nodes).collect()} == {("a", "a"), ("b", "b"), ("c", "c"), ("a", "b"), ("a", "c"), ("b", "c")}
    assert {tuple(r) for r in patterns.sequence(t, ["p", "p"], "x", "y").collect()} == {("a", "c")}
    got = patterns.optional(patterns.triple(t, "l", "x", "l"), patterns.triple(t, "m", "x", "m"))
    assert {tuple(r) for r in got.collect()} == {("a", "A", None), ("c", "C", "M")}
    flags = patterns.exists_flag(nodes.distinct().withColumnRenamed("s", "x"), patterns.triple(t, "m", "x", "m"), "has")
    assert {tuple(r) for r in flags.collect()} == {("a", False), ("b", False), ("c", True)}


def test_tree_skips_loops_shortcuts_and_prunes_newest(spark):
    rows = [("g", "root", "a", 1), ("g", "a", "b", 2), ("g", "root", "b", 3), ("g", "b", "a", 4), ("g", "a", "a", 5), ("g", "root", "c", 2), ("g", "c", "d", 3), ("g", "b", "d", 4)]
    df = spark.createDataFrame([(g, a, b, n) for g, a, b, n in rows], "graph string, src string, dst string, n int")
    df = df.withColumn("day", F.date_add(F.lit("2022-01-01").cast("date"), F.col("n"))).drop("n")
    assert {(r.src, r.dst) for r in closure.topic_trees(df, "root").collect()} == {("root", "a"), ("a", "b"), ("root", "c"), ("c", "d")}


def test_tree_of_wide_nodes_takes_time_in_proportion():
    """30,000 topics below two parents, with edges back: a search down from a parent would pass all of them for each edge."""
    topics = [(f"p{i % 2}", f"t{i}", 2) for i in range(30_000)]
    rows = [("root", "p0", 1), ("root", "p1", 1), *topics, *((b, a, 3) for a, b, _ in topics)]
    begin = time.monotonic()
    got = closure._tree(pd.DataFrame(rows, columns=["src", "dst", "day"]), "root")
    assert {tuple(r) for r in got.itertuples(index=False)} == {*rows[:2], *topics}
    assert time.monotonic() - begin < 20


def test_tree_agrees_with_plain_searches():
    def reaches(edges, a, b):
        seen, todo = set(), [a]
        while todo:
            x = todo.pop()
            if x == b:
                return True
            if x not in seen:
                seen.add(x)
                todo += [d for s, d in edges if s == x]
        return False

    def plain(rows):
        kept = {}
        for a, b, day in sorted(rows, key=lambda r: (r[2], r[0], r[1])):
            if a != b and not reaches(kept, a, b) and not reaches(kept, b, a):
                kept[a, b] = day
        for e in list(kept):
            day = kept.pop(e)
            if not reaches(kept, *e):
                kept[e] = day
        for e, day in sorted(kept.items(), key=lambda x: (x[1], x[0]), reverse=True):
            if sum(b == e[1] for _, b in kept) > 1:
                del kept[e]
                if not reaches(kept, "0", e[1]):
                    kept[e] = day
        return {(*e, day) for e, day in kept.items()}

    for seed in range(40):
        r = random.Random(seed)
        edges = {(str(r.randrange(9)), str(r.randrange(9))) for _ in range(25)}
        rows = [(a, b, r.randrange(6)) for a, b in sorted(edges)]
        got = closure._tree(pd.DataFrame(rows, columns=["src", "dst", "day"]), "0")
        assert {tuple(x) for x in got.itertuples(index=False)} == plain(rows)


@pytest.mark.parametrize(
    ("written", "date", "until", "ongoing"),
    [
        ("March 4, 2021", "2021-03-04", None, False), ("March 4, 2021 – present", "2021-03-04", None, True), ("March 4 – 6, 2021", "2021-03-04", "2021-03-06", False),
        ("March 4 - April 6, 2021", "2021-03-04", "2021-04-06", False), ("March 4, 2020 until April 6, 2021", "2020-03-04", "2021-04-06", False), ("4 March 2021", "2021-03-04", None, False),
        ("4 March 2021 - ongoing", "2021-03-04", None, True), ("4 - 6 March 2021", "2021-03-04", "2021-03-06", False), ("4 March - 6 April 2021", "2021-03-04", "2021-04-06", False),
        ("4 March 2020 - 6 April 2021", "2020-03-04", "2021-04-06", False), ("about\n4 March 2021", "2021-03-04", None, False), ("31 February 2021", None, None, None), ("nothing", None, None, None),
    ],
)
def test_dates(spark, written, date, until, ongoing):
    r = spark.createDataFrame([(written,)], "t string").select(datetimes.parse_dates(F.col("t")).alias("d")).first().d
    got = (str(r.date), str(r.until) if r.until else None, r.ongoing) if r else (None, None, None)
    assert got == (date, until, ongoing)


@pytest.mark.parametrize(
    ("written", "start", "end", "offset"),
    [
        ("7:08 a.m. – 6:37 p.m. (MEZ)", 428, 1117, None), ("16:03 - 17:20 (UTC+5:00)", 963, 1040, 300), ("Shortly after 2:12 a.m. (UTC+9, at sea)", 132, None, 540), ("near 3:40 p.m.", 940, None, None),
        ("5:55 a.m. (UTC-2:30)", 355, None, -150), ("12:05 a.m.", 5, None, None), ("12:05 p.m. and 1:00 p.m.", 725, 780, None), ("no time", None, None, None),
    ],
)
def test_times(spark, written, start, end, offset):
    r = spark.createDataFrame([(written,)], "t string").select(datetimes.parse_times(F.col("t")).alias("x")).first().x
    assert ((r.start_minute, r.end_minute, r.offset_minutes) if r else (None, None, None)) == (start, end, offset)


def test_strings_and_coordinates(spark):
    from urllib.parse import quote_plus

    odd = "a b~*é/ü+&=\n%"
    row = spark.createDataFrame([(odd, "36°13′50,4″S", "5°30′W", "7°E", "x")], "a string, b string, c string, d string, e string")
    got = row.select(terms.form_encode(F.col("a")), *[geo.dms_to_decimal(F.col(c)) for c in "bcde"]).first()
    assert got[0] == quote_plus(odd) and got[1] == pytest.approx(-(36 + 13 / 60 + 50.4 / 3600)) and got[2:] == (-5.5, 7.0, None)
    urls = {"https://en.wikipedia.org/wiki/A_b": True, "https://en.wikipedia.org/wiki/Talk:A": False, "https://de.wikipedia.org/wiki/A": False, "https://en.wikipedia.org/wiki/A,_B:_C": True, None: False}
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert {r.u: r.x for r in df.select("u", terms.is_article_url(F.col("u")).alias("x")).collect()} == urls


def test_sentences(spark):
    cases = {"One. Two. Three.": ["One. ", "Two. ", "Three."], "One. rest": ["One. "], "none": ["none"], "": [""], "A. ": ["A. "]}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert {r.t: r.s for r in df.select("t", text.sentences(F.col("t")).alias("s")).collect()} == cases


def test_polygons(spark):
    points = [(i, (i % 23) / 10 - 0.5537, (i // 23) / 10 - 0.5519) for i in range(23 * 23)]
    df = spark.createDataFrame(points, "i int, x double, y double")
    regions = spark.createDataFrame([("tri", "POLYGON ((0 0, 1.5 0.2, 0.3 1.4, 0 0))")], "region string, wkt string")
    side = lambda a, b, p: (b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0])
    a, b, c = (0, 0), (1.5, 0.2), (0.3, 1.4)
    want = {i for i, x, y in points if all(side(s, t, (x, y)) > 0 for s, t in ((a, b), (b, c), (c, a)))}
    assert {r.i for r in geo.points_in_regions(df, regions).collect()} == want


def test_metrics_merge_and_empty(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", None)], "k string, v double")
    assert {r.k: r["mean"] for r in metrics.averages(df, ["k"], "v").collect()} == {"a": 2.0, "b": -1.0}
    months = spark.createDataFrame([(1, 0, 0), (2, 1, 3), (3, 3, 1)], "month int, hits long, misses long")
    assert [tuple(r) for r in metrics.hit_ratios(months).orderBy("month").collect()] == [(1, None, None), (2, 0.25, 0.25), (3, 0.75, 0.5)]


def test_portal_page(spark):
    pages = fixtures.portal_pages(spark)
    events = portal.portal_events(pages).orderBy("date", "event_index").collect()
    assert [(str(e.date), e.category, e.event_index, e.text) for e in events] == [
        ("2022-01-01", "Storms", 0, "Ada floods Northtown. Two bridges fall."), ("2022-01-01", "Storms", 1, "Both are put off."),
        ("2022-01-01", "Sport", 2, "The Reds win the cup"), ("2022-01-02", None, 0, "No heading here."),
    ]
    assert events[0].source_text == "(Example News)" and [s.text for s in events[0].sentences] == ["Ada floods Northtown. ", "Two bridges fall."]
    assert [l.text for l in events[0].sentences[0].links] == ["Northtown"]
    assert [r.url for r in events[1].refs] == ["https://paper.example.org/b"]
    assert events[1].parent_topics == ["https://en.wikipedia.org/wiki/River_Fest", "https://en.wikipedia.org/wiki/Harbour_Fest"]
    topics = portal.portal_topics(pages).orderBy("topic_index").collect()
    assert [(t.text, t.parents) for t in topics] == [("Storm Ada", []), ("River Fest", ["https://en.wikipedia.org/wiki/Storm_Ada"]), ("Harbour Fest, 2022", ["https://en.wikipedia.org/wiki/Storm_Ada"]), ("A plain topic", [])]


def test_a_large_page_is_parsed_into_bounded_rows(spark):
    n = 2 * portal.ROOM + 1
    items = "".join(f'<li>Event {i}.<sup id="cite_ref-{i}">[1]</sup></li>' for i in range(n))
    note = f'<div class="reflist"><ol><li id="cite_note-{n - 1}"><cite class="news"><a class="external" href="https://a.example.org/">A</a></cite></li></ol></div>'
    html = f'<div id="2022_January_1"><div class="description"><ul>{items}</ul></div></div>{note}'
    bad = '<div id="2022_February_1"></div>'
    pages = spark.createDataFrame([("January_2022", "u", html), ("January_2022", "u", html.replace("January_1", "January_2")), ("February_2022", "v", bad)], "month string, url string, html string")
    parsed = portal.parse_pages(pages).cache()
    assert parsed.agg(F.max(F.size("events"))).first()[0] == portal.ROOM
    found = portal.portal_events(parsed).orderBy("date", "event_index").collect()
    assert [(e.date.day, e.event_index) for e in found] == [(d, i) for d in (1, 2) for i in range(n)] and [r.url for r in found[n - 1].refs] == ["https://a.example.org/"]
    assert {(r.month, r.status, r.pages, r.events) for r in portal.page_status(parsed).collect()} == {("January_2022", "published", 1, 2 * n), ("February_2022", "failed", 1, 0)}


def test_no_row_of_rendered_pages_holds_a_month(spark):
    orders = spark.createDataFrame([(k, 1, "O", datetime.datetime(2022, 1, 1 + k % 28), "LOW") for k in range(56)], "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz, o_orderpriority string")
    customer, nation = spark.createDataFrame([(1, 2)], "c_custkey long, c_nationkey int"), spark.createDataFrame([(2, "N")], "n_nationkey int, n_name string")
    pages = rendered.portal_pages(orders, customer, nation)
    assert pages.count() == 28 and portal.portal_events(pages).groupBy("month", "date").count().where("count = 2").count() == 28


def test_no_row_of_rendered_pages_holds_a_day(spark, monkeypatch):
    orders = spark.createDataFrame([(k, k % 8, "O", datetime.datetime(2022, 1, 1 + k % 2), "LOW" if k % 3 else "HIGH") for k in range(40)], "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz, o_orderpriority string")
    customer, nation = spark.createDataFrame([(c, 2) for c in range(8)], "c_custkey long, c_nationkey int"), spark.createDataFrame([(2, "N")], "n_nationkey int, n_name string")
    seen = {}
    for share in (3, 100):
        monkeypatch.setattr(rendered, "SHARE", share)
        pages = rendered.portal_pages(orders, customer, nation)
        assert pages.agg(F.max(F.expr("(length(html) - length(replace(html, '<li>Order '))) / 10"))).first()[0] == min(share, 20)
        parsed = portal.parse_pages(pages).cache()
        kept = portal.one_a_row(parsed).cache()
        seen[share] = [sorted(map(str, f(x).collect())) for x in (parsed, kept) for f in (portal.portal_events, portal.portal_topics)]
        # numbers go on from part to part
        assert [r.i for r in portal.portal_events(kept).groupBy("date").agg(F.array_sort(F.collect_list("event_index")).alias("i")).collect()] == [list(range(20))] * 2
    assert seen[3] == seen[100] and seen[3][:2] == seen[3][2:]


def test_faulty_months_are_found_in_one_pass(spark):
    from eventweave.plans.extracted import faulty_months

    # a checkpoint would parse the pages twice, and keep what nothing reads
    assert faulty_months(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1


def test_kept_rows_have_one_event_and_errors_stay(spark):
    html = '<div id="2022_January_1"><div class="description"><ul><li>A<ul><li>B</li><li>C</li></ul></li></ul></div></div>'
    pages = spark.createDataFrame([("January_2022", "u", html), ("February_2022", "v", '<div id="2022_February_1"></div>')], "month string, url string, html string")
    kept = portal.one_a_row(portal.parse_pages(pages))
    assert sorted((r.month, r.error is None, r.event and r.event.text, r.topic and r.topic.text) for r in kept.collect()) == [("February_2022", False, None, None), ("January_2022", True, "B", "A"), ("January_2022", True, "C", None)]


def test_article_page(spark):
    rows = articles.articles(fixtures.article_pages(spark)).collect()
    assert len(rows) == 1
    a = rows[0]
    assert (a.canonical, a.location_label, a.location_text, a.templates, a.dtstart) == ("https://en.wikipedia.org/wiki/Storm_Ada", "Areas affected", "Northtown, coast", ["Infobox_storm"], "2022-01-01")
    assert a.begin_texts == ["January 1, 2022 – January 3, 2022"] and a.end_texts == [] and len(a.time_texts) == 1


def test_graph_round_trip_and_idempotence(spark, tmp_path):
    pages = fixtures.portal_pages(spark)
    t = triples.event_triples(portal.portal_events(pages)).unionByName(triples.topic_triples(portal.portal_topics(pages)))
    columns = ["module", "month", *triples.TERM]
    want = {tuple(r) for r in t.select(*columns).collect()}
    assert {tuple(r) for r in triples.from_jsonld(triples.to_jsonld(t)).select(*columns).collect()} == want
    for _ in range(2):
        triples.write(t.unionByName(t), f"file://{tmp_path}/g")
    back = spark.read.parquet(f"file://{tmp_path}/g").select(*columns).collect()
    assert len(back) == len(want) and {tuple(r) for r in back} == want
    assert all(r.value.endswith(" .") and "\n" not in r.value for r in triples.to_ntriples(t).collect())


def test_replacing_is_idempotent(spark):
    store = spark.createDataFrame([("a", "type", "T"), ("a", "label", "old"), ("b", "type", "T"), ("c", "label", "x")], "s string, p string, o string")
    fresh = spark.createDataFrame([("a", "type", "T"), ("a", "label", "new")], "s string, p string, o string")
    once = maintain.replace(store, fresh, ["T"])
    rows = {tuple(r) for r in once.collect()}
    assert rows == {("a", "type", "T"), ("a", "label", "new"), ("b", "type", "T"), ("c", "label", "x")}
    assert {tuple(r) for r in maintain.replace(once, fresh, ["T"]).collect()} == rows
    left = maintain.delete_matching(store, store.select("s"), ["type", "label"])
    assert {tuple(r) for r in left.collect()} == {("b", "type", "T"), ("c", "label", "x")}


def test_time_spans_fill_their_slots_in_order(spark):
    dates = "struct<start:timestamp_ntz,until:timestamp_ntz,ongoing:boolean>"
    times = "struct<start_minute:int,end_minute:int,offset_minutes:int>"
    day = lambda d, h=0, m=0: datetime.datetime(2020, 5, d, h, m)
    cases = [
        # microformats keep the day, a row brings the time
        ((day(1), None), [(day(2, 13, 15), None, False)], [], (day(1, 13, 15), day(1, 13, 15), False, None, None, None)),
        # 13:00 counts as no time, so the next row's is taken
        ((None, None), [(day(1, 13, 0), day(3), False), (day(9, 10, 5), day(9, 11, 6), False)], [], (day(1, 10, 5), day(3, 11, 6), False, None, None, None)),
        # ongoing keeps later ends out, but not an end that a time row gives
        ((None, None), [(day(1), None, True), (None, day(9), False)], [], (day(1), None, True, None, None, None)),
        ((None, None), [(day(1), None, True)], [(600, 660, 120)], (day(1, 10, 0), day(1, 11, 0), True, None, None, 120)),
        ((None, None), [(day(1), day(2), False)], [(600, None, -210)], (day(1), day(2), False, None, None, -210)),
        ((None, None), [], [(600, None, None), (700, 800, 60)], (None, None, False, 600, 800, 60)),
        ((None, day(4)), [], [(600, None, None)], (None, day(4), False, None, None, None)),
        ((None, None), [], [], (None, None, False, None, None, None)),
    ]
    df = spark.createDataFrame([(i, m, r, t) for i, (m, r, t, _) in enumerate(cases)], f"i int, m struct<dtstart:timestamp_ntz,dtend:timestamp_ntz>, r array<{dates}>, t array<{times}>")
    got = {r.i: tuple(r.x) for r in df.select("i", datetimes.timespan(F.col("m"), F.col("r"), F.col("t")).alias("x")).collect()}
    assert got == {i: want for i, (*_, want) in enumerate(cases)}
    shown = spark.createDataFrame([(-210,), (None,), (780,)], "o int").select(datetimes.zone(F.col("o")), datetimes.clock(F.lit(605), F.col("o"))).collect()
    assert [tuple(r) for r in shown] == [("-03:30", "10:05:00-03:30"), (None, "10:05:00"), ("+13:00", "10:05:00+13:00")]


def test_only_named_predicates_are_made_and_read(spark, tmp_path):
    from eventweave.plans.extracted import by_predicate

    events = portal.portal_events(fixtures.portal_pages(spark)).localCheckpoint()
    every, some = triples.event_triples(events), triples.event_triples(events, only=("hasTag", "wikipediaArticle"))
    columns = ["module", "month", *triples.TERM]
    want = sorted(map(str, every.where("p IN ('hasTag', 'wikipediaArticle')").select(*columns).collect()))
    assert sorted(map(str, some.select(*columns).collect())) == want and want
    plan = some._jdf.queryExecution().optimizedPlan().toString()
    # of seven sources two are read, and nothing else is made
    assert plan.count("LogicalRDD") == 2 and "hasRawHtml" not in plan and "referenceContext" not in plan
    stored = by_predicate(spark, every.select("s", "p", "o").distinct(), f"file://{tmp_path}/g")
    assert set(stored.collect()) == set(every.select("s", "p", "o").collect()) and stored.columns == ["s", "p", "o"]
    scan = patterns.triple(stored, "hasTag", "s", "o")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p" in scan and "hasTag" in scan


def test_plain_pages_give_the_trees_of_the_standard_parser():
    from eventweave.sources import dom

    def shape(n):
        return n if isinstance(n, str) else (n.tag, n.attrs, [shape(c) for c in n.children])

    def both(html):
        b = dom._Builder()
        b.feed(html)
        b.close()
        return b.root, dom.parse_with_ids(html)[0]

    rng, plain = random.Random(5), 0
    bits = ["<ul>", "</ul>", "<li>", "<li>", "</li>", "</li>", '<li class="x y" id="i">', "<p>", "</p>", '<div id="i">', "</div>", "<br>", "<table>", "<tr>", "<td>", "</table>", '<a href="/w">', "</a>", '<a href="a" href="b">', "text", " > ", "&amp;", "it's", "'"]
    odd = ["<!-- c -->", "<script>a<b</script>", "<LI>", "<a href=x>", '<a title="a&lt;b">', "a < b", "<br/>", "</p x>", "&", "<a", "<a title='x'>", "</br>"]
    for i in range(3000):
        html = "".join(rng.choice(bits + odd * (i % 3 == 0)) for _ in range(rng.randrange(1, 25)))
        a, b = both(html)
        plain += dom._plain(html) is not None
        assert shape(a) == shape(b), html
        # what an item keeps of the page is what it would be written as
        assert [x.html() for x in a.walk() if x.tag == "li"] == [x.html() for x in b.walk() if x.tag == "li"], html
    assert plain > 1800
    # a rendered page is plain, and its items keep their piece of it
    html = '<div id="2022_January_1"><div class="description"><ul><li>A <a class="external" href="u">b</a><ul><li>C</li></ul></li></ul></div></div>'
    assert [x.kept for x in dom._plain(html)[0].find_all("li")] == ['<li>A <a class="external" href="u">b</a><ul><li>C</li></ul></li>', "<li>C</li>"]


def test_a_source_inside_a_source_leaves_the_text_once():
    html = '<div id="2022_January_1"><div class="description"><ul><li>Ab <a class="external" href="u">(X <a class="external" href="v">(Y)</a>)</a> cd. Ef<sup>1</sup>.</li></ul></div></div>'
    event = portal.parse_page("January_2022", "u", html)[0][0]
    assert event["text"] == "Ab  cd. Ef." and [x["text"] for x in event["sentences"]] == ["Ab  cd. ", "Ef."]


def test_a_day_span_parses_its_months_only(spark, monkeypatch):
    from eventweave.plans import enriched, extracted

    monkeypatch.setattr(extracted, "_made", {})
    alone = enriched.sampled_day_span(spark, "/root/testdata/sf0.001")
    # the months are chosen below the parse
    plan = alone._jdf.queryExecution().optimizedPlan().toString()
    assert -1 < plan.index("MapInArrow") < plan.index("LeftSemi")
    extracted.parsed(spark, "/root/testdata/sf0.001")
    kept = enriched.sampled_day_span(spark, "/root/testdata/sf0.001")
    assert "MapInArrow" not in kept._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(alone.collect()) == sorted(kept.collect()) and alone.count() > 0
