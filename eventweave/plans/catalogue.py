"""Registered queries over the event graph and, beside each, SQL that says the same over the raw tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from eventweave.functions import datetimes, geo, terms, text
from eventweave.operators import closure, enrich, eventmap, maintain, metrics, patterns
from eventweave.plans import graph
from eventweave.plans.graph import table
from eventweave.plans.registry import query

def _year_month(day):
    d = F.to_date(day)
    return F.year(d).cast("long").alias("year"), F.month(d).cast("long").alias("month")


@query("""SELECT r_name AS root, year(o_orderdate) AS year, month(o_orderdate) AS month, count(*) AS num
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL""")
def events_per_month_under_root(spark, sf_dir):
    """Events under each root topic by month: event / during* / article / source."""
    t, e = graph.topics(spark, sf_dir), graph.events(spark, sf_dir)
    nodes = t.where("p = 'type'").select("s")
    up = patterns.star(t, "during", "topic", "root_topic", nodes)
    named = patterns.bgp(patterns.triple(t, "article", "root_topic", "article"), patterns.triple(t, "source", "article", "source"))
    roots = named.where(F.col("root_topic").startswith(graph.ROOT)).select("root_topic", terms.last_segment(F.col("source")).alias("root"))
    facts = patterns.bgp(patterns.triple(e, "during", "event", "topic"), up, roots, patterns.triple(e, "mentionDate", "event", "day"))
    return facts.groupBy("root", *_year_month("day")).agg(F.count("*").alias("num"))


@query("SELECT year(o_orderdate) AS year, count(*) AS num FROM orders GROUP BY ALL")
def events_per_year(spark, sf_dir):
    e = graph.events(spark, sf_dir)
    y = patterns.both(patterns.of_type(e, "NewsSummary", "event"), patterns.triple(e, "mentionDate", "event", "day"))
    return y.groupBy(_year_month("day")[0]).agg(F.count("*").alias("num"))


@query("SELECT year(o_orderdate) AS year, count(DISTINCT o_custkey) AS num FROM orders GROUP BY ALL")
def distinct_topics_per_year(spark, sf_dir):
    e = graph.events(spark, sf_dir)
    y = patterns.both(patterns.triple(e, "during", "event", "topic"), patterns.triple(e, "mentionDate", "event", "day"))
    return y.groupBy(_year_month("day")[0]).agg(F.count_distinct("topic").alias("num"))


@query("""SELECT m AS month, round(coalesce(avg(n), 0), 6) AS mean FROM range(1, 13) t(m)
LEFT JOIN (SELECT month(o_orderdate) AS k, year(o_orderdate) AS y, count(*) AS n FROM orders GROUP BY ALL) ON k = m GROUP BY m""")
def avg_events_per_calendar_month(spark, sf_dir):
    per = table(spark, sf_dir, "orders").groupBy(*_year_month("o_orderdate")).agg(F.count("*").alias("n"))
    months = spark.range(1, 13).select(F.col("id").alias("month"))
    return months.join(per, "month", "left").groupBy("month").agg(F.round(F.coalesce(F.avg("n"), F.lit(0.0)), 6).alias("mean"))


@query("""SELECT 'base' AS module, round(avg(n), 6) AS mean FROM (SELECT strftime(o_orderdate, '%Y-%m') AS m, 4 * count(*) AS n FROM orders GROUP BY m
UNION ALL SELECT '', (SELECT 3 * count(*) FROM customer) + (SELECT 5 * count(*) FROM nation) + (SELECT 4 * count(*) FROM region) + (SELECT 3 * count(*) FROM supplier) + (SELECT 3 * count(*) FROM nation) + (SELECT 2 * count(*) FROM region))
UNION ALL SELECT 'ohg', CAST(count(*) * 3 + count(CASE WHEN p_partkey % 2 = 0 THEN 1 END) AS DOUBLE) FROM part""")
def avg_triples_per_module(spark, sf_dir):
    per = graph.graph(spark, sf_dir).groupBy("module", "month").agg(F.count("*").alias("n"))
    return per.groupBy("module").agg(F.round(F.avg("n"), 6).alias("mean"))


def _companies(spark):
    edges = graph.class_edges(spark)
    up = closure.closure(edges)
    return up.where("dst = 'COMPANY'").select(F.col("src").alias("class"))


COMPANY = "p_type IN ('ECONOMY', 'PROMO', 'BUSINESS', 'COMPANY')"


@query(f"""SELECT year(o_orderdate) AS year, month(o_orderdate) AS month, count(DISTINCT o_orderkey) AS num
FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey WHERE {COMPANY} GROUP BY ALL""")
def company_events_per_month(spark, sf_dir):
    kinds = patterns.triple(graph.entities(spark, sf_dir), "type", "entity", "class").join(_companies(spark), "class", "left_semi")
    linked = graph.links(spark, sf_dir).join(kinds, "entity", "left_semi").select("event").distinct()
    days = patterns.triple(graph.events(spark, sf_dir), "mentionDate", "event", "day")
    return linked.join(days, "event").groupBy(*_year_month("day")).agg(F.count("*").alias("num"))


@query(f"SELECT count(DISTINCT l_partkey) AS num FROM lineitem JOIN part ON p_partkey = l_partkey WHERE {COMPANY}")
def distinct_companies(spark, sf_dir):
    kinds = patterns.triple(graph.entities(spark, sf_dir), "type", "entity", "class").join(_companies(spark), "class", "left_semi")
    return graph.links(spark, sf_dir).join(kinds, "entity", "left_semi").agg(F.count_distinct("entity").alias("num"))


@query("""SELECT n_name AS parent, c_name AS topic, strftime(min(o_orderdate), '%Y-%m-%d') AS day, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS first_event
FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY ALL""")
def topic_pairs_min_date(spark, sf_dir):
    """The earliest mention of each pair of parent and topic, with its event: ties to the smaller event."""
    t, e = graph.topics(spark, sf_dir), graph.events(spark, sf_dir)
    names = patterns.triple(t, "label", "child", "topic"), patterns.triple(t, "label", "up", "parent")
    facts = patterns.bgp(patterns.triple(e, "during", "event", "child"), patterns.triple(e, "mentionDate", "event", "day"), patterns.triple(t, "during", "child", "up"), *names)
    number = terms.last_segment(F.col("event")).cast("long")
    return patterns.arg_min(facts.withColumn("first_event", number), ["parent", "topic"], [F.col("day"), F.col("first_event")], ["day", "first_event"])


@query("""SELECT day, count(*) AS num FROM (SELECT CASE WHEN min(o_orderdate) < DATE '1996-01-01' THEN 'previously' ELSE strftime(min(o_orderdate), '%Y-%m-%d') END AS day
FROM orders GROUP BY o_custkey HAVING min(o_orderdate) < DATE '1999-01-01') GROUP BY day""")
def first_seen_topics_by_day(spark, sf_dir):
    """Topics by the day they first appear, up to a cutoff; what is older than the start is 'previously'."""
    e = graph.events(spark, sf_dir)
    first = patterns.both(patterns.triple(e, "during", "event", "topic"), patterns.triple(e, "mentionDate", "event", "day")).groupBy("topic").agg(F.min("day").alias("day"))
    day = F.when(F.col("day") < "1996-01-01", "previously").otherwise(F.col("day"))
    return first.where("day < '1999-01-01'").groupBy(day.alias("day")).agg(F.count("*").alias("num"))


@query("""SELECT 'place/supplier/' || s_suppkey AS place, 'place/nation/' || n_nationkey AS within FROM supplier JOIN nation ON s_nationkey = n_nationkey
UNION ALL SELECT 'place/supplier/' || s_suppkey, 'place/region/' || n_regionkey FROM supplier JOIN nation ON s_nationkey = n_nationkey
UNION ALL SELECT 'place/nation/' || n_nationkey, 'place/region/' || n_regionkey FROM nation""")
def path_plus(spark, sf_dir):
    return patterns.plus(graph.places(spark, sf_dir), "locatedIn", "place", "within")


@query("""WITH e AS (SELECT 'place/supplier/' || s_suppkey AS a, 'place/nation/' || s_nationkey AS b FROM supplier UNION ALL SELECT 'place/nation/' || n_nationkey, 'place/region/' || n_regionkey FROM nation),
n AS (SELECT 'place/supplier/' || s_suppkey AS x FROM supplier UNION ALL SELECT 'place/nation/' || n_nationkey FROM nation UNION ALL SELECT 'place/region/' || r_regionkey FROM region)
SELECT x AS place, x AS within FROM n UNION ALL SELECT a, b FROM e UNION ALL SELECT e.a, f.b FROM e JOIN e f ON f.a = e.b""")
def path_star(spark, sf_dir):
    """locatedIn*: every place with itself and with all that it lies in."""
    t = graph.places(spark, sf_dir)
    return patterns.star(t, "locatedIn", "place", "within", t.where("p = 'type'").select("s"))


@query("""SELECT 'place/nation/' || n_nationkey AS place, 'place/region/' || n_regionkey AS within FROM nation
UNION ALL SELECT 'place/nation/' || n_nationkey, 'place/nation/' || n_nationkey FROM nation UNION ALL SELECT 'place/region/' || r_regionkey, 'place/region/' || r_regionkey FROM region""")
def path_optional(spark, sf_dir):
    t = graph.places(spark, sf_dir).where(~F.col("s").startswith("place/supplier/"))
    return patterns.maybe(t, "locatedIn", "place", "within", t.select("s"))


@query("""SELECT 'event/' || o_orderkey AS event, 'topic/region/' || n_regionkey AS root FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey""")
def path_sequence(spark, sf_dir):
    t = graph.events(spark, sf_dir).unionByName(graph.topics(spark, sf_dir)).where("p = 'during'")
    return patterns.sequence(t, ["during"] * 3, "event", "root")


@query("SELECT 'entity/' || p_partkey AS entity, p_name AS label, CASE WHEN p_partkey % 2 = 0 THEN CAST(p_size AS VARCHAR) END AS size FROM part")
def optional_claims(spark, sf_dir):
    t = graph.entities(spark, sf_dir)
    return patterns.optional(patterns.triple(t, "label", "entity", "label"), patterns.triple(t, "size", "entity", "size"))


@query("SELECT DISTINCT 'entity/' || p_partkey AS entity, CASE WHEN p_partkey % 2 = 0 THEN CAST(p_size AS VARCHAR) END AS size, CASE WHEN p_brand = 'Brand#1' THEN p_brand END AS brand FROM part")
def double_optional(spark, sf_dir):
    t = graph.entities(spark, sf_dir)
    first = patterns.optional(t.select(F.col("s").alias("entity")).distinct(), patterns.triple(t, "size", "entity", "size"))
    return patterns.optional(first, patterns.triple(t, "brand", "entity", "brand").where("brand = 'Brand#1'")).distinct()


@query("SELECT n_name AS label, 'nation' AS kind FROM nation UNION ALL SELECT r_name, 'region' FROM region UNION ALL SELECT n_name, NULL FROM nation WHERE n_regionkey = 0")
def union_labels(spark, sf_dir):
    t = patterns.triple(graph.places(spark, sf_dir), "label", "place", "label")
    of = lambda k: t.where(F.col("place").startswith(f"place/{k}/")).select("label", F.lit(k).alias("kind"))
    africa = table(spark, sf_dir, "nation").where("n_regionkey = 0").select(F.col("n_name").alias("label"))
    return patterns.union(of("nation"), of("region"), africa)


@query("SELECT 'topic/customer/' || c_custkey AS topic FROM customer")
def not_exists_articles(spark, sf_dir):
    """Text-only topics: those without an article."""
    t = graph.topics(spark, sf_dir)
    every = patterns.of_type(t, "TextTopic", "topic").unionByName(patterns.of_type(t, "ArticleTopic", "topic"))
    return patterns.not_exists(every, patterns.triple(t, "article", "topic", "article"))


@query("SELECT 'entity/' || p_partkey AS entity, p_partkey % 2 = 0 AS sized FROM part")
def exists_flag(spark, sf_dir):
    t = graph.entities(spark, sf_dir)
    return patterns.exists_flag(patterns.triple(t, "label", "entity", "l").select("entity"), patterns.triple(t, "size", "entity", "x"), "sized")


@query("""SELECT 'type' AS p, p_type AS o FROM part WHERE p_partkey = 4 UNION ALL SELECT 'label', p_name FROM part WHERE p_partkey = 4
UNION ALL SELECT 'size', CAST(p_size AS VARCHAR) FROM part WHERE p_partkey = 4 UNION ALL SELECT 'brand', p_brand FROM part WHERE p_partkey = 4""")
def one_hop(spark, sf_dir):
    asked = spark.createDataFrame([("entity/4",)], "entity_id string")
    return enrich.one_hop(asked, graph.entities(spark, sf_dir)).select("p", "o")


@query("SELECT 'topic/nation/' || n_nationkey AS topic FROM nation UNION ALL SELECT 'topic/region/' || r_regionkey FROM region")
def subjects_by_type(spark, sf_dir):
    return patterns.of_type(graph.topics(spark, sf_dir), "ArticleTopic", "topic")


@query("""SELECT 'place/region/' || n_regionkey AS location, string_agg(DISTINCT 'locatedIn', ',') AS relations, count(DISTINCT n_nationkey) AS num FROM nation GROUP BY n_regionkey
UNION ALL SELECT 'place/nation/' || s_nationkey, 'locatedIn', count(*) FROM supplier GROUP BY s_nationkey""")
def parent_relations_grouped(spark, sf_dir):
    """Relations that are sub-properties of location but not of image, by location."""
    props = spark.createDataFrame([("locatedIn", "administrative"), ("administrative", "location"), ("brand", "image"), ("image", "location")], "property string, parent string")
    t = graph.places(spark, sf_dir).unionByName(graph.entities(spark, sf_dir)).withColumn("o_kind", F.lit("uri"))
    asked, direct = t.select(F.col("s").alias("entity_id")), props.select("property", F.col("property").alias("predicate"))
    found = enrich.parent_locations(asked, t, props, direct).select("entity_id", F.explode("location").alias("location", "relations"))
    each = found.select("entity_id", "location", F.explode("relations").alias("relation"))
    return each.groupBy("location").agg(F.array_join(F.array_sort(F.collect_set("relation")), ",").alias("relations"), F.count_distinct("entity_id").alias("num"))


def _event_places(spark, sf_dir):
    """(event, place), a bag: each event's linked suppliers and, for every third event, their nations."""
    link = graph.links(spark, sf_dir).select("event", "place")
    t = graph.places(spark, sf_dir)
    up = patterns.triple(t, "locatedIn", "place", "parent")
    third = terms.last_segment(F.col("event")).cast("long") % 3 == 0
    return link.unionByName(link.where(third).join(up, "place").select("event", F.col("parent").alias("place"))), up


PLACES = """WITH l AS (SELECT DISTINCT l_orderkey AS e, 'place/supplier/' || l_suppkey AS place, 'place/nation/' || s_nationkey AS parent FROM lineitem JOIN supplier ON s_suppkey = l_suppkey),
ep AS (SELECT e, place FROM l UNION SELECT e, parent FROM l WHERE e % 3 = 0),
up AS (SELECT 'place/supplier/' || s_suppkey AS place, 'place/nation/' || s_nationkey AS parent FROM supplier UNION ALL SELECT 'place/nation/' || n_nationkey, 'place/region/' || n_regionkey FROM nation)"""


@query(PLACES + " SELECT DISTINCT 'event/' || a.e AS event, a.place, b.place AS parent FROM ep a JOIN up USING (place) JOIN ep b ON b.e = a.e AND b.place = up.parent WHERE a.place <> b.place")
def sibling_containment(spark, sf_dir):
    """A place is located in a parent that the same event links to."""
    located, up = _event_places(spark, sf_dir)
    return enrich.contained_places(located.distinct(), up)


@query(PLACES + """ SELECT count(*) AS num FROM (SELECT e FROM ep WHERE NOT EXISTS (SELECT 1 FROM ep c JOIN up ON up.place = c.place WHERE c.e = ep.e AND up.parent = ep.place) GROUP BY e HAVING count(*) > 1)""")
def leaf_location_events(spark, sf_dir):
    """Events with more than one place that is no parent of another place of the event."""
    leaves = enrich.leaf_places(*_event_places(spark, sf_dir)).groupBy("event").count()
    return leaves.agg(F.count_if(F.col("count") > 1).alias("num"))


@query("""SELECT o_orderkey AS event, string_agg(DISTINCT t, ',' ORDER BY t) AS types FROM (
SELECT o_orderkey, c_mktsegment AS t FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_mktsegment <> 'BUILDING'
UNION ALL SELECT o_orderkey, r_name FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey WHERE c_mktsegment = 'BUILDING') GROUP BY ALL""")
def event_types_inherited(spark, sf_dir):
    """An event's types are its topics'; where those have none, the nearest ancestors'."""
    c, r = table(spark, sf_dir, "customer"), table(spark, sf_dir, "region")
    own = c.where("c_mktsegment <> 'BUILDING'").select(key_("topic/customer", "c_custkey").alias("topic"), F.col("c_mktsegment").alias("class"))
    types = own.unionByName(r.select(key_("topic/region", "r_regionkey").alias("topic"), F.col("r_name").alias("class")))
    parents = patterns.triple(graph.topics(spark, sf_dir), "during", "topic", "parent")
    topics = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("event"), key_("topic/customer", "o_custkey").alias("topic"))
    return enrich.event_types(types, parents, topics).select("event", F.array_join("types", ",").alias("types"))


@query("""SELECT l_orderkey AS event, string_agg(DISTINCT p_name, ',' ORDER BY p_name) AS refs FROM lineitem JOIN part ON p_partkey = l_partkey AND p_size <= 10 GROUP BY ALL""")
def citation_join(spark, sf_dir):
    """Citations of an event that the page's reference list has."""
    page = F.lit("page").alias("page")
    refs = table(spark, sf_dir, "part").where("p_size <= 10").select(page, F.col("p_partkey").alias("nr"), F.col("p_name").alias("ref"))
    found = enrich.cited(table(spark, sf_dir, "lineitem").select(page, F.col("l_orderkey").alias("event"), F.col("l_partkey").alias("nr")), refs)
    return found.select("event", F.array_join(F.array_sort(F.array_distinct("refs")), ",").alias("refs"))


@query("""SELECT 'Q' || s_suppkey AS entity, CASE WHEN s_suppkey % 3 = 0 THEN 'relation/' || s_suppkey WHEN s_suppkey % 3 = 1 THEN 'way/' || s_nationkey END AS outline FROM supplier""")
def outline_fallback(spark, sf_dir):
    """Relation outlines, object outlines only where there is no relation, and null for entities with neither."""
    s = F.col("s_suppkey")
    rows = table(spark, sf_dir, "supplier").select(F.concat(F.lit("Q"), s).alias("entity_id"), s.alias("k"), "s_nationkey")
    relation = F.when(F.col("k") % 3 == 0, F.col("k").cast("string")).otherwise("none")
    ids = rows.select(F.concat(F.lit("http://www.wikidata.org/entity/"), "entity_id").alias("entity_uri"), relation.alias("osmrelid"), F.when(F.col("k") % 3 < 2, key_("way", "s_nationkey")).otherwise("area/1").alias("osmobj"))
    keys = enrich.outline_keys(enrich.osm_ids(rows, ids))
    return rows.select("entity_id").join(keys, "entity_id", "left").select(F.col("entity_id").alias("entity"), F.col("query_key").alias("outline"))


key_ = graph.key


@query("""SELECT 'https://en.wikipedia.org/wiki/Supplier_' || s_suppkey AS url, 1 AS depth FROM supplier UNION SELECT 'https://en.wikipedia.org/wiki/' || n_name, 2 FROM nation JOIN supplier ON s_nationkey = n_nationkey""")
def two_level_expansion(spark, sf_dir):
    """Articles and what their location rows link to, for exactly two rounds, although nations link on to regions."""
    n, r, s = (table(spark, sf_dir, t) for t in ("nation", "region", "supplier"))
    wiki = lambda *c: F.concat(F.lit(terms.WIKI), *c)
    link = lambda u: F.array(F.struct(u.alias("href")))
    supplier = s.join(n, s.s_nationkey == n.n_nationkey).select(wiki(F.lit("Supplier_"), "s_suppkey").alias("url"), link(wiki("n_name", F.lit("#top"))).alias("location_links"))
    nation = n.join(r, n.n_regionkey == r.r_regionkey).select(wiki("n_name").alias("url"), link(wiki("r_name")).alias("location_links"))
    return enrich.expanded(supplier.select("url"), supplier.unionByName(nation))


@query("SELECT conv_id, turn, lag(turn) OVER w AS previous, lead(turn) OVER w AS next FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)")
def sentence_chain(spark, sf_dir):
    w = Window.partitionBy("conv_id").orderBy("turn")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.lag("turn").over(w).alias("previous"), F.lead("turn").over(w).alias("next"))


@query("SELECT o_orderkey AS event, strftime(o_orderdate, '%Y-%m-%d') || '_' || (row_number() OVER (PARTITION BY o_orderdate ORDER BY o_orderkey) - 1) AS event_id FROM orders")
def event_indices(spark, sf_dir):
    n = F.row_number().over(Window.partitionBy("o_orderdate").orderBy("o_orderkey")) - 1
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("event"), terms.event_id(F.col("o_orderdate"), n).alias("event_id"))


@query(r"""WITH p AS (SELECT doc_id, text, list_filter(string_split(replace(text, '. ', '. ' || chr(1)), chr(1)), lambda x: ends_with(x, '. ')) AS c, string_split(replace(text, '. ', '. ' || chr(1)), chr(1))[-1] AS r FROM documents)
SELECT doc_id, CAST(n AS BIGINT) AS n, md5(j) AS digest FROM (SELECT doc_id, len(s) AS n, array_to_string(s, '|') AS j FROM (
SELECT doc_id, CASE WHEN len(x) = 0 THEN [text] ELSE x END AS s FROM (SELECT doc_id, text, CASE WHEN ends_with(text, '.') AND r <> '' AND NOT ends_with(r, '. ') THEN list_append(c, r) ELSE c END AS x FROM p)))""")
def sentence_split(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", text.sentences(F.col("text")).alias("s"))
    return d.select("doc_id", F.size("s").cast("long").alias("n"), F.md5(F.array_join("s", "|")).alias("digest"))


@query(r"""SELECT page_id, i AS pos, h AS href, CASE WHEN h LIKE '/%' THEN 'https://en.wikipedia.org' || h ELSE h END AS url, string_split(h, '/')[-1] AS last
FROM (SELECT page_id, unnest(x) AS h, unnest(range(len(x))) AS i FROM (SELECT page_id, regexp_extract_all(html, '<a\s[^>]*?href="([^"]*)"', 1) AS x FROM pages))""")
def page_links(spark, sf_dir):
    h = F.col("href")
    rows = table(spark, sf_dir, "pages").select("page_id", F.posexplode(text.anchors(F.col("html"))).alias("pos", "href"))
    return rows.select("page_id", F.col("pos").cast("long").alias("pos"), "href", terms.absolute(h).alias("url"), terms.last_segment(h).alias("last"))


@query(r"""SELECT url, starts_with(url, 'https://en.wikipedia.org/wiki/') AND NOT regexp_matches(substr(url, 31), '^[\p{L}\p{N}_]+:') AS is_article
FROM (SELECT DISTINCT 'https://en.wikipedia.org/wiki/' || p_name AS url FROM part UNION SELECT DISTINCT 'https://en.wikipedia.org/wiki/' || p_type || ':' || p_brand FROM part UNION SELECT DISTINCT url FROM pages)""")
def article_url_predicate(spark, sf_dir):
    p, host = table(spark, sf_dir, "part"), F.lit(terms.WIKI)
    urls = p.select(F.concat(host, "p_name").alias("url")).union(p.select(F.concat(host, "p_type", F.lit(":"), "p_brand"))).union(table(spark, sf_dir, "pages").select("url")).distinct()
    return urls.select("url", terms.is_article_url(F.col("url")).alias("is_article"))


@query("SELECT page_id, regexp_replace(url, '#.*$', '') AS plain, string_split(url, '/')[-1] AS last FROM pages")
def url_parts(spark, sf_dir):
    u = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", terms.without_fragment(u).alias("plain"), terms.last_segment(u).alias("last"))


@query("SELECT p_partkey, replace(replace(url_encode(p_name || ' ~*' || p_brand), '%20', '+'), '%2a', '%2A') AS encoded FROM part")
def form_encode(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", terms.form_encode(F.concat("p_name", F.lit(" ~*"), "p_brand")).alias("encoded"))


@query("""SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date, CASE WHEN o_orderkey % 3 = 1 THEN CAST(o_orderdate AS DATE) + 40 END AS until, o_orderkey % 3 = 2 AS ongoing FROM orders""")
def parse_dates(spark, sf_dir):
    """Dates, spans and ongoing dates written out and read back."""
    d = F.col("o_orderdate")
    single = F.date_format(d, "MMMM d, yyyy")
    span = F.concat(F.lit("held "), F.date_format(d, "d MMMM yyyy"), F.lit(" – "), F.date_format(F.date_add(d, 40), "d MMMM yyyy"))
    k = F.col("o_orderkey") % 3
    written = F.when(k == 0, single).when(k == 1, span).otherwise(F.concat(single, F.lit(" - present")))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", datetimes.parse_dates(written).alias("x"))
    return rows.select("o_orderkey", "x.date", "x.until", "x.ongoing")


@query("""SELECT event_id, hour(ts) * 60 + minute(ts) AS start_minute, CASE WHEN event_id % 2 = 0 THEN (hour(ts) * 60 + minute(ts) + 90) % 1440 END AS end_minute, CASE WHEN event_id % 3 = 0 THEN -210 END AS offset_minutes FROM events""")
def parse_times(spark, sf_dir):
    t, later = F.col("ts"), F.col("ts") + F.expr("interval 90 minutes")
    end = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit(" - "), F.date_format(later, "h:mm a"))).otherwise("")
    zone = F.when(F.col("event_id") % 3 == 0, F.lit(" (UTC-3:30)")).otherwise("")
    rows = table(spark, sf_dir, "events").select("event_id", datetimes.parse_times(F.concat(F.date_format(t, "h:mm a"), end, zone)).alias("x"))
    long = lambda c: F.col(f"x.{c}").cast("long").alias(c)
    return rows.select("event_id", long("start_minute"), long("end_minute"), long("offset_minutes"))


@query("""SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) AS start, CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderdate AS TIMESTAMP) + INTERVAL 9 DAY ELSE CAST(o_orderdate AS TIMESTAMP) END AS until FROM orders""")
def timespans(spark, sf_dir):
    """Date rows fill a start, then an end; a start alone is its own end."""
    d = F.col("o_orderdate")
    row = lambda x: datetimes.combine(datetimes.parse_dates(F.date_format(x, "MMMM d, yyyy")), F.lit(None).cast("struct<start_minute:int,end_minute:int,offset_minutes:int>"))
    second = datetimes.combine(datetimes.parse_dates(F.concat(F.date_format(d, "d MMMM yyyy"), F.lit(" until "), F.date_format(F.date_add(d, 9), "d MMMM yyyy"))), F.lit(None).cast("struct<start_minute:int,end_minute:int,offset_minutes:int>"))
    rows = F.when(F.col("o_orderkey") % 2 == 0, F.array(row(d), second)).otherwise(F.array(row(d)))
    none = F.struct(F.lit(None).cast("timestamp_ntz").alias("dtstart"), F.lit(None).cast("timestamp_ntz").alias("dtend"))
    out = table(spark, sf_dir, "orders").select("o_orderkey", datetimes.fill_timespan(none, rows).alias("x"))
    return out.select("o_orderkey", "x.start", "x.until")


@query("SELECT s_suppkey, round(CASE WHEN s_suppkey % 2 = 0 THEN 1 ELSE -1 END * (s_nationkey + 30 / 60.0 + 36 / 3600.0), 9) AS degrees FROM supplier")
def dms_to_decimal(spark, sf_dir):
    letter = F.when(F.col("s_suppkey") % 2 == 0, "N").otherwise("S")
    written = F.concat(F.col("s_nationkey").cast("string"), F.lit("°30′36,0″"), letter)
    return table(spark, sf_dir, "supplier").select("s_suppkey", F.round(geo.dms_to_decimal(written), 9).alias("degrees"))


@query("""SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, n_regionkey AS geometry, count(DISTINCT o_orderkey) AS num FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey GROUP BY ALL""")
def geometry_event_counts(spark, sf_dir):
    """Events by geometry and day; an event counts once for a geometry."""
    place = patterns.sequence(graph.places(spark, sf_dir), ["locatedIn", "locatedIn"], "place", "region")
    day = patterns.triple(graph.events(spark, sf_dir), "mentionDate", "event", "day")
    hits = graph.links(spark, sf_dir).select("event", "place").join(place, "place").select("event", "region").distinct()
    return hits.join(day, "event").groupBy("day", terms.last_segment(F.col("region")).cast("int").alias("geometry")).agg(F.count("*").alias("num"))


@query("""WITH n AS (SELECT n_nationkey AS k, n_regionkey AS r, count(s_suppkey) AS x FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY ALL)
SELECT 'place/nation/' || k AS area, x + (SELECT sum(x) FROM n m WHERE m.r = n.r) AS total FROM n UNION ALL SELECT 'place/region/' || r, sum(x) FROM n GROUP BY r""")
def layered_sums(spark, sf_dir):
    """Each area's count and those of all areas that contain it; a region counts its nations' suppliers."""
    t = graph.places(spark, sf_dir)
    near = patterns.triple(t, "locatedIn", "place", "area").where(F.col("place").startswith("place/supplier/")).groupBy("area").agg(F.count("*").alias("n"))
    nations = t.where("p = 'type'").where(F.col("s").startswith("place/nation/")).select(F.col("s").alias("area")).join(near, "area", "left").na.fill(0, ["n"])
    edges = patterns.triple(t, "locatedIn", "dst", "src").where(F.col("dst").startswith("place/nation/"))
    regions = nations.join(edges, F.col("area") == F.col("dst")).groupBy(F.col("src").alias("area")).agg(F.sum("n").alias("n"))
    return eventmap.layered_sums(nations.unionByName(regions), edges)


@query("""WITH p AS (SELECT vec_id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y FROM embeddings)
SELECT vec_id, r AS region FROM p JOIN (VALUES ('inner', -0.1, -0.1, 0.1, 0.1), ('west', -1.0, -0.5, 0.0, 0.5)) b(r, x0, y0, x1, y1) ON x > x0 AND x < x1 AND y > y0 AND y < y1""")
def points_in_regions(spark, sf_dir):
    box = lambda a, b, c, d: f"POLYGON (({a} {b}, {c} {b}, {c} {d}, {a} {d}, {a} {b}))"
    regions = spark.createDataFrame([("inner", box(-0.1, -0.1, 0.1, 0.1)), ("west", box(-1.0, -0.5, 0.0, 0.5))], "region string, wkt string")
    p = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding")[0].cast("double").alias("x"), F.col("embedding")[1].cast("double").alias("y"))
    return geo.points_in_regions(p, regions).select("vec_id", "region")


@query("""WITH b AS (SELECT quality = 1 AS t, n_chars > 1000 AS a, lang = 'en' AS b FROM labels JOIN documents USING (doc_id)), l AS (SELECT t, unnest(['long', 'english', 'either']) AS predicate, unnest([a, b, a OR b]) AS s FROM b),
c AS (SELECT predicate, count(*) FILTER (s AND t) AS tp, count(*) FILTER (s AND NOT t) AS fp, count(*) FILTER (NOT s AND t) AS fn, count(*) FILTER (NOT s AND NOT t) AS tn FROM l GROUP BY ALL)
SELECT predicate, tp, fp, fn, tn, round(tp / (tp + fp), 9) AS precision, round(tp / (tp + fn), 9) AS recall, round((tp + tn) / (tp + fp + fn + tn), 9) AS accuracy, round(2 * tp / (2 * tp + fp + fn), 9) AS f1 FROM c""")
def confusion_metrics(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", (F.col("n_chars") > 1000).alias("long"), (F.col("lang") == "en").alias("english"))
    x = table(spark, sf_dir, "labels").join(d, "doc_id").withColumn("truth", F.col("quality") == 1).withColumn("either", F.col("long") | F.col("english"))
    m = metrics.confusion(x, "truth", ["long", "english", "either"]).drop("support")
    return m.withColumns({c: F.round(c, 9) for c in ("precision", "recall", "accuracy", "f1")})


@query("SELECT count(*) AS events, count(*) FILTER (event_type = 'click') AS clicks, count(*) FILTER (value > 10) AS large FROM events")
def counters(spark, sf_dir):
    return table(spark, sf_dir, "events").agg(F.count("*").alias("events"), F.count_if(F.col("event_type") == "click").alias("clicks"), F.count_if(F.col("value") > 10).alias("large"))


@query("SELECT event_type, count(*) AS n, round(avg(value), 6) AS mean FROM events GROUP BY ALL")
def averages(spark, sf_dir):
    a = metrics.averages(table(spark, sf_dir, "events"), ["event_type"], "value")
    return a.select("event_type", "n", F.round("mean", 6).alias("mean"))


@query("SELECT event_type, count(*) AS n FROM events GROUP BY ALL")
def histogram(spark, sf_dir):
    return metrics.histogram(table(spark, sf_dir, "events"), "event_type")


@query("SELECT event_type, count(*) AS n, round(avg(value), 6) AS mean FROM events GROUP BY ALL")
def combined_metrics(spark, sf_dir):
    """Per-day metrics, merged."""
    days = metrics.averages(table(spark, sf_dir, "events").withColumn("day", F.to_date("ts")), ["day", "event_type"], "value")
    return metrics.combine_averages(days, ["event_type"]).select("event_type", "n", F.round("mean", 6).alias("mean"))


@query("""WITH d AS (SELECT CAST(ts AS DATE) AS month, count(*) FILTER (event_type = 'view') AS h, count(*) FILTER (event_type <> 'view') AS m FROM events GROUP BY ALL)
SELECT month, round(h / (h + m), 9) AS ratio, round(sum(h) OVER w / sum(h + m) OVER w, 9) AS ratio_so_far FROM d WINDOW w AS (ORDER BY month)""")
def cumulative_hit_ratio(spark, sf_dir):
    seen = F.col("event_type") == "view"
    days = table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("month")).agg(F.count_if(seen).alias("hits"), F.count_if(~seen).alias("misses"))
    return metrics.hit_ratios(days).select("month", F.round("ratio", 9).alias("ratio"), F.round("ratio_so_far", 9).alias("ratio_so_far"))


@query("SELECT user_id, event_id, event_id - coalesce(lag(event_id) OVER (PARTITION BY user_id ORDER BY event_id), 0) AS delta FROM events")
def cache_deltas(spark, sf_dir):
    return metrics.deltas(table(spark, sf_dir, "events"), ["user_id"], "event_id", "event_id").select("user_id", "event_id", "delta")


@query("SELECT module, count(*) AS n FROM (SELECT 'base' AS module, unnest(range(4)) FROM orders) GROUP BY ALL")
def merge_months(spark, sf_dir):
    """All months as one set: every triple twice is every triple once."""
    e = graph.events(spark, sf_dir)
    merged = e.unionByName(e).drop("month").distinct()
    return merged.groupBy("module").agg(F.count("*").alias("n"))


@query("SELECT 'place/nation/' || n_nationkey AS s, 'label' AS p, n_name AS o FROM nation")
def graph_union_dedup(spark, sf_dir):
    t = graph.places(spark, sf_dir).where("p = 'label'").where(F.col("s").startswith("place/nation/")).select("s", "p", "o")
    return t.unionByName(t).dropDuplicates(["s", "p", "o"])


STORE = """WITH t AS (SELECT 'topic/nation/' || n_nationkey AS s, unnest(['type', 'label', 'during', 'article']) AS p, unnest(['ArticleTopic', n_name, 'topic/region/' || n_regionkey, 'article/nation/' || n_nationkey]) AS o FROM nation
UNION ALL SELECT 'topic/region/' || r_regionkey, unnest(['type', 'label', 'article']), unnest(['ArticleTopic', r_name, 'article/region/' || r_regionkey]) FROM region)"""


def _store(spark, sf_dir):
    return graph.topics(spark, sf_dir).where(F.col("s").rlike("^topic/(nation|region)/")).select("s", "p", "o")


@query(STORE + " SELECT s, p, o FROM t WHERE NOT (s LIKE 'topic/nation/%' AND CAST(string_split(s, '/')[3] AS INT) < 5) UNION ALL SELECT 'topic/nation/' || n_nationkey, unnest(['type', 'label']), unnest(['ArticleTopic', lower(n_name)]) FROM nation WHERE n_nationkey < 5")
def replace_entities(spark, sf_dir):
    """Subject-complete: re-extracted topics replace their old triples."""
    n = table(spark, sf_dir, "nation").where("n_nationkey < 5")
    pairs = F.array(F.struct(F.lit("type").alias("p"), F.lit("ArticleTopic").alias("o")), F.struct(F.lit("label").alias("p"), F.lower("n_name").alias("o")))
    fresh = n.select(key_("topic/nation", "n_nationkey").alias("s"), F.inline(pairs))
    return maintain.replace(_store(spark, sf_dir), fresh, ["ArticleTopic"])


@query(STORE + " SELECT s, p, o FROM t WHERE NOT (s LIKE 'topic/nation/%' AND p IN ('type', 'label', 'during'))")
def delete_matching_patterns(spark, sf_dir):
    """Pattern-faithful: topics without a parent do not match and stay whole."""
    store = _store(spark, sf_dir)
    return maintain.delete_matching(store, maintain.subjects(store, "ArticleTopic"), ["type", "label", "during"])


@query("SELECT 'NATION_' || n_nationkey AS class FROM nation WHERE n_nationkey < 3")
def labelled_classes(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    t = n.select(F.lit("x").alias("s"), F.lit("type").alias("p"), F.concat(F.lit("NATION_"), "n_nationkey").alias("o"))
    t = t.unionByName(n.where("n_nationkey < 3").select(F.concat(F.lit("NATION_"), "n_nationkey").alias("s"), F.lit("label").alias("p"), F.col("n_name").alias("o")))
    return maintain.labelled_classes(t)


REDUCED = "SELECT 'n' || n_nationkey AS src, 'r' || n_regionkey AS dst FROM nation UNION ALL SELECT 's' || s_suppkey, 'n' || s_nationkey FROM supplier"


def _shortcuts(spark, sf_dir):
    n, s = table(spark, sf_dir, "nation"), table(spark, sf_dir, "supplier")
    k = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    base = n.select(k("n", "n_nationkey").alias("src"), k("r", "n_regionkey").alias("dst")).union(s.select(k("s", "s_suppkey"), k("n", "s_nationkey")))
    return base, base.union(s.join(n, s.s_nationkey == n.n_nationkey).select(k("s", "s_suppkey"), k("r", "n_regionkey")))


@query(REDUCED)
def transitive_reduction(spark, sf_dir):
    return closure.transitive_reduction(_shortcuts(spark, sf_dir)[1])


@query("""SELECT 's' || s_suppkey AS node, 0 AS level FROM supplier UNION ALL SELECT 'n' || n_nationkey, CASE WHEN n_nationkey IN (SELECT s_nationkey FROM supplier) THEN 1 ELSE 0 END FROM nation
UNION ALL SELECT 'r' || n_regionkey, 1 + max(CASE WHEN n_nationkey IN (SELECT s_nationkey FROM supplier) THEN 1 ELSE 0 END) FROM nation GROUP BY n_regionkey""")
def topological_levels(spark, sf_dir):
    return closure.levels(_shortcuts(spark, sf_dir)[1])


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_props(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


@query("""SELECT strftime(m, '%B_%Y') AS name FROM (SELECT unnest(range(date_trunc('month', min(o_orderdate))::TIMESTAMP, date_trunc('month', max(o_orderdate))::TIMESTAMP + INTERVAL 1 DAY, INTERVAL 1 MONTH)) AS m FROM orders)""")
def month_range(spark, sf_dir):
    """All months from the first order's to the last's."""
    month = lambda f: F.date_format(f("o_orderdate"), "yyyy-MM")
    ends = table(spark, sf_dir, "orders").agg(month(F.min).alias("first"), month(F.max).alias("last")).first()
    return datetimes.month_range(spark, ends.first, ends.last).select("name")


@query("SELECT c_custkey, 'k1=' || c_mktsegment || ',k2=' || n_name AS merged FROM customer JOIN nation ON n_nationkey = c_nationkey")
def map_merge_last_wins(spark, sf_dir):
    """Two maps as one, the right one's values winning."""
    n = table(spark, sf_dir, "nation")
    x = table(spark, sf_dir, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    left = F.create_map(F.lit("k1"), F.col("c_mktsegment"), F.lit("k2"), F.col("c_name"))
    right = F.create_map(F.lit("k2"), F.col("n_name"))
    merged = F.map_concat(F.map_filter(left, lambda k, _: ~F.map_contains_key(right, k)), right)
    entries = F.array_sort(F.transform(F.map_entries(merged), lambda e: F.concat_ws("=", e["key"], e["value"])))
    return x.select("c_custkey", F.array_join(entries, ",").alias("merged"))


@query("SELECT page_id, len(list_distinct(regexp_extract_all(html, '<a\\s[^>]*?href=\"([^\"]*)\"', 1))) AS num FROM pages")
def distinct_links_per_page(spark, sf_dir):
    """Page scan to the set of linked targets, counted."""
    return table(spark, sf_dir, "pages").select("page_id", F.size(F.array_distinct(text.anchors(F.col("html")))).cast("long").alias("num"))


@query("SELECT label FROM (SELECT n_name AS label, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey DESC) AS r FROM nation) WHERE r = 1")
def last_label_wins(spark, sf_dir):
    """Snapshot lookups keep the last record of each key."""
    w = Window.partitionBy("n_regionkey").orderBy(F.desc("n_nationkey"))
    return table(spark, sf_dir, "nation").withColumn("r", F.row_number().over(w)).where("r = 1").select(F.col("n_name").alias("label"))


@query("SELECT DISTINCT year(o_orderdate) AS y, month(o_orderdate) AS m FROM orders WHERE year(o_orderdate) = 1997")
def month_selection(spark, sf_dir):
    """Months between two bounds, both included."""
    e = table(spark, sf_dir, "orders").where(F.col("o_orderdate").between("1997-01-01", "1997-12-31 23:59:59"))
    return e.select(F.year("o_orderdate").cast("long").alias("y"), F.month("o_orderdate").cast("long").alias("m")).distinct()


@query("SELECT o_orderkey FROM orders WHERE day(o_orderdate) = 14")
def day_filter(spark, sf_dir):
    return table(spark, sf_dir, "orders").where(F.dayofmonth("o_orderdate") == 14).select("o_orderkey")


@query("""SELECT year(o_orderdate) AS year, month(o_orderdate) AS month, count(*) AS num FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey WHERE n_regionkey = 3 GROUP BY ALL""")
def sparql_events_under_root(spark, sf_dir):
    """The flagship as query text."""
    from eventweave.plans.sparql import sparql

    t = graph.events(spark, sf_dir).unionByName(graph.topics(spark, sf_dir))
    return sparql(t, """SELECT ?year ?month (COUNT(*) AS ?num) WHERE {
        ?event a NewsSummary ; mentionDate ?day ; during/during/during ?root . ?root article/source ?page .
        BIND(YEAR(?day) AS ?year) BIND(MONTH(?day) AS ?month) FILTER(?root = "topic/region/3") } GROUP BY ?year ?month""")


@query("""SELECT 'topic/customer/' || c_custkey AS topic, c_name AS label, NULL AS article FROM customer WHERE c_nationkey <> 2
UNION ALL SELECT 'topic/nation/' || n_nationkey, n_name, 'article/nation/' || n_nationkey FROM nation UNION ALL SELECT 'topic/region/' || r_regionkey, r_name, 'article/region/' || r_regionkey FROM region""")
def sparql_optional_union(spark, sf_dir):
    from eventweave.plans.sparql import sparql

    return sparql(graph.topics(spark, sf_dir), """SELECT DISTINCT ?topic ?label ?article WHERE {
        { ?topic a TextTopic FILTER NOT EXISTS { ?topic during "topic/nation/2" } } UNION { ?topic a ArticleTopic }
        ?topic label ?label OPTIONAL { ?topic article ?article } }""")


@query("SELECT 'place/supplier/' || s_suppkey AS place FROM supplier JOIN nation ON n_nationkey = s_nationkey WHERE n_regionkey = 1 UNION ALL SELECT 'place/nation/' || n_nationkey FROM nation WHERE n_regionkey = 1 UNION ALL SELECT 'place/region/1'")
def sparql_star_path(spark, sf_dir):
    from eventweave.plans.sparql import sparql

    return sparql(graph.places(spark, sf_dir), 'SELECT ?place WHERE { ?place locatedIn* "place/region/1" }')


@query("SELECT count(*) > 0 AS answer FROM nation WHERE n_regionkey = 4")
def sparql_ask(spark, sf_dir):
    from eventweave.plans.sparql import sparql

    return sparql(graph.places(spark, sf_dir), 'ASK { ?nation locatedIn "place/region/4" ; label ?name }')
