"""Registered queries for graphs of single months, DELETE texts and deletes on the stored graph, with SQL over the raw tables.

The tables are seen as a news graph: customers are articles, topics and places,
orders are events, their line items the events' sentences, suppliers outlines and
parts labelled classes. What is stale is given as a table of entities, so one job
deletes for all of them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventweave.operators import patterns
from eventweave.operators.closure import cut
from eventweave.plans import graph
from eventweave.plans.extracted import _name, _shared, by_predicate
from eventweave.plans.graph import key, table
from eventweave.plans.registry import query
from eventweave.plans.sparql import deleted, sparql_by_graph, update
from eventweave.sources import modules

# graphs of single months


def _monthly(spark, sf_dir) -> DataFrame:
    """Events, and the edges above them in the month of their first event: a customer's to its nation, a nation's to its region."""
    o, c, n = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    month = F.date_format("o_orderdate", "yyyy-MM").alias("month")
    rows = o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    own = rows.select(month, key("event", "o_orderkey").alias("s"), F.lit("during").alias("p"), key("topic/customer", "c_custkey").alias("o"))
    out = [own]
    for low, high in ((("customer", "c_custkey"), ("nation", "n_nationkey")), (("nation", "n_nationkey"), ("region", "n_regionkey"))):
        first = rows.groupBy(low[1], high[1]).agg(F.date_format(F.min("o_orderdate"), "yyyy-MM").alias("month"))
        out.append(first.select("month", key(f"topic/{low[0]}", low[1]).alias("s"), F.lit("during").alias("p"), key(f"topic/{high[0]}", high[1]).alias("o")))
    return reduce(DataFrame.unionByName, out)


MONTHLY = """WITH r AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderkey AS k, c_custkey AS c, n_nationkey AS n, n_regionkey AS g
FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey),
c1 AS (SELECT c, n, min(month) AS month FROM r GROUP BY ALL), n1 AS (SELECT n, g, min(month) AS month FROM r GROUP BY ALL),
up AS (SELECT month, 'event/' || k AS x, 'topic/customer/' || c AS y FROM r
UNION ALL SELECT month, 'event/' || k, 'topic/nation/' || n FROM r JOIN c1 USING (c, n, month)
UNION ALL SELECT month, 'event/' || k, 'topic/region/' || g FROM r JOIN c1 USING (c, n, month) JOIN n1 USING (n, g, month)
UNION ALL SELECT month, 'topic/customer/' || c, 'topic/nation/' || n FROM c1
UNION ALL SELECT month, 'topic/customer/' || c, 'topic/region/' || g FROM c1 JOIN n1 USING (n, month)
UNION ALL SELECT month, 'topic/nation/' || n, 'topic/region/' || g FROM n1)
"""


@query(MONTHLY + "SELECT DISTINCT month, x, y FROM up")
def month_graph_paths(spark, sf_dir):
    """during+ in each month's graph apart: a path over two months is not found."""
    return sparql_by_graph(_monthly(spark, sf_dir), "SELECT ?x ?y WHERE { ?x during+ ?y }")


@query(MONTHLY + "SELECT month, count(DISTINCT x) AS num FROM up WHERE x LIKE 'event/%' AND y = 'topic/region/1' GROUP BY month")
def month_graph_events_under_root(spark, sf_dir):
    """Events under one root in each month's graph, by a walk back from the root."""
    found = sparql_by_graph(_monthly(spark, sf_dir), "SELECT ?e WHERE { ?e during+ <topic/region/1> }").where(F.col("e").startswith("event/"))
    return found.groupBy("month").agg(F.count("*").alias("num"))


@query(MONTHLY + "SELECT m.month, coalesce(bool_or(u.y IS NOT NULL), FALSE) AS answer FROM (SELECT DISTINCT month FROM r) m LEFT JOIN (SELECT month, y FROM up WHERE x LIKE 'event/%' AND y LIKE 'topic/region/%') u USING (month) GROUP BY m.month")
def month_graph_ask(spark, sf_dir):
    """Does a month's own graph lead from an event to a region? Months without such a path answer no."""
    return sparql_by_graph(_monthly(spark, sf_dir), "ASK { ?e during ?c . ?c during ?n . ?n during ?r }")


# DELETE texts


def _triples(df: DataFrame, s: Column, *facts: tuple[str, Column]) -> DataFrame:
    return graph._facts(df, F.lit("m"), s, "base", list(facts)).select("s", "p", "o")


def _every(k: str, n: int, below: int, value: Column) -> Column:
    return F.when(F.col(k) % n < below, value)


def _article_store(spark, sf_dir) -> DataFrame:
    c, k = table(spark, sf_dir, "customer"), "c_custkey"
    lit = F.lit
    article, doc, wd, place = (key(x, k) for x in ("article", "doc", "wd", "place"))
    return reduce(
        DataFrame.unionByName,
        [
            _triples(c, article, ("type", lit("WikipediaArticle")), ("source", doc), ("label", F.col("c_name")), ("name", _every(k, 2, 1, F.col("c_name"))), ("sameAs", _every(k, 3, 2, wd)), ("note", lit("kept"))),
            _triples(c, doc, ("type", F.when(F.col(k) % 11 > 0, "Document")), ("note", lit("kept"))),
            _triples(c, wd, ("size", _every(k, 3, 2, F.col("c_nationkey"))), ("kind", _every(k, 3, 2, F.col("c_mktsegment")))),
            _triples(
                c.where(F.col(k) % 2 == 0), place, ("type", lit("Location")), ("wikipediaArticle", article), ("label", F.col("c_name")), ("sameAs", _every(k, 3, 1, wd)), ("isLocatedIn", key("place/nation", "c_nationkey")),
                ("hasLatitude", _every(k, 5, 4, lit("1"))), ("hasLongitude", _every(k, 5, 3, lit("2"))), ("hasLocation", _every(k, 5, 2, key("point", k))),
            ),
        ],
    )


DELETE_ARTICLE = """DELETE {
  ?u a WikipediaArticle ; source ?doc ; label ?l ; name ?name ; sameAs ?wd . ?doc a Document . ?wd ?wp ?wo .
  ?loc a Location ; wikipediaArticle ?u ; label ?ll ; sameAs ?wd ; isLocatedIn ?up ; hasLatitude ?lat ; hasLongitude ?lon ; hasLocation ?point
} WHERE {
  ?u a WikipediaArticle ; source ?doc ; label ?l . ?doc a Document
  OPTIONAL { ?u name ?name } OPTIONAL { ?u sameAs ?wd . ?wd ?wp ?wo }
  OPTIONAL { ?loc a Location ; wikipediaArticle ?u ; label ?ll
    OPTIONAL { ?loc sameAs ?wd } OPTIONAL { ?loc isLocatedIn ?up } OPTIONAL { ?loc hasLatitude ?lat ; hasLongitude ?lon ; hasLocation ?point } }
}"""


@query("""WITH c AS (SELECT *, c_custkey AS k, c_mktsegment = 'BUILDING' AND c_custkey % 11 > 0 AS gone FROM customer),
t AS (SELECT gone, 'article/' || k AS s, unnest(['type', 'source', 'label', 'name', 'sameAs']) AS p, unnest(['WikipediaArticle', 'doc/' || k, c_name, CASE WHEN k % 2 = 0 THEN c_name END, CASE WHEN k % 3 < 2 THEN 'wd/' || k END]) AS o FROM c
UNION ALL SELECT FALSE, unnest(['article/', 'doc/']) || k, 'note', 'kept' FROM c UNION ALL SELECT gone, 'doc/' || k, 'type', 'Document' FROM c WHERE k % 11 > 0
UNION ALL SELECT gone, 'wd/' || k, unnest(['size', 'kind']), unnest([CAST(c_nationkey AS VARCHAR), c_mktsegment]) FROM c WHERE k % 3 < 2
UNION ALL SELECT gone, 'place/' || k, unnest(['type', 'wikipediaArticle', 'label', 'isLocatedIn', 'sameAs']), unnest(['Location', 'article/' || k, c_name, 'place/nation/' || c_nationkey, CASE WHEN k % 3 = 0 THEN 'wd/' || k END]) FROM c WHERE k % 2 = 0
UNION ALL SELECT gone AND k % 5 < 2, 'place/' || k, unnest(['hasLatitude', 'hasLongitude', 'hasLocation']), unnest([CASE WHEN k % 5 < 4 THEN '1' END, CASE WHEN k % 5 < 3 THEN '2' END, CASE WHEN k % 5 < 2 THEN 'point/' || k END]) FROM c WHERE k % 2 = 0)
SELECT s, p, o FROM t WHERE NOT gone AND o IS NOT NULL""")
def delete_text_articles(spark, sf_dir):
    """Articles with document, claims and place, in nested optional parts; one whose document is untyped stays whole."""
    given = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(key("article", "c_custkey").alias("u"))
    return update(_article_store(spark, sf_dir), DELETE_ARTICLE, given)


DELETE_TOPIC = """DELETE {
  ?u a TextTopic ; a WikiNews ; a Event ; label ?l ; hasMentionDate ?day ; isOccuringDuring ?up ; hasRawHtml ?html ;
     a ArticleTopic ; wikipediaArticle ?a ; hasLocation ?loc ; hasTimespan ?span
} WHERE {
  ?u a TextTopic ; a WikiNews ; a Event ; label ?l ; hasMentionDate ?day
  OPTIONAL { ?u isOccuringDuring ?up } OPTIONAL { ?u hasRawHtml ?html }
  OPTIONAL { ?u a ArticleTopic ; wikipediaArticle ?a ; hasLocation ?loc OPTIONAL { ?u hasTimespan ?span } }
}"""


@query("""WITH c AS (SELECT *, c_custkey AS k, c_mktsegment = 'BUILDING' AND c_custkey % 7 > 0 AS gone FROM customer),
t AS (SELECT gone, 'topic/' || k AS s, unnest(['type', 'type', 'type', 'label', 'isOccuringDuring', 'hasRawHtml', 'hasMentionDate']) AS p,
unnest(['TextTopic', 'WikiNews', 'Event', c_name, 'topic/nation/' || c_nationkey, CASE WHEN k % 2 = 0 THEN '<li>' END, CASE WHEN k % 7 > 0 THEN '2020-01-01' END]) AS o FROM c
UNION ALL SELECT gone, 'topic/' || k, 'type', 'ArticleTopic' FROM c WHERE k % 3 = 0
UNION ALL SELECT gone AND k % 6 = 0, 'topic/' || k, unnest(['wikipediaArticle', 'hasLocation', 'hasTimespan']), unnest(['article/' || k, CASE WHEN k % 6 = 0 THEN 'place/' || k END, CASE WHEN k % 12 = 0 THEN 'span/' || k END]) FROM c WHERE k % 3 = 0)
SELECT s, p, o FROM t WHERE NOT gone AND o IS NOT NULL""")
def delete_text_topics(spark, sf_dir):
    """Topics with their article links; a constant triple of the template goes also where its optional part has no match."""
    c, k = table(spark, sf_dir, "customer"), "c_custkey"
    lit = F.lit
    store = _triples(
        c, key("topic", k), ("type", lit("TextTopic")), ("type", lit("WikiNews")), ("type", lit("Event")), ("label", F.col("c_name")), ("isOccuringDuring", key("topic/nation", "c_nationkey")),
        ("hasRawHtml", _every(k, 2, 1, lit("<li>"))), ("hasMentionDate", F.when(F.col(k) % 7 > 0, "2020-01-01")), ("type", _every(k, 3, 1, lit("ArticleTopic"))), ("wikipediaArticle", _every(k, 3, 1, key("article", k))),
        ("hasLocation", _every(k, 6, 1, key("place", k))), ("hasTimespan", _every(k, 12, 1, key("span", k))),
    )
    given = c.where("c_mktsegment = 'BUILDING'").select(key("topic", k).alias("u"))
    return update(store, DELETE_TOPIC, given)


def _event_store(spark, sf_dir) -> DataFrame:
    o, li = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    lit, k = F.lit, "o_orderkey"
    text = F.concat(lit("Order "), F.col(k).cast("string"))
    name = lambda kind, n: F.concat(lit(f"{kind}/"), F.col("l_orderkey").cast("string"), lit("_"), n.cast("string"))
    n = F.col("l_linenumber")
    sent, ctx = name("sent", n), key("ctx", "l_orderkey")
    last = li.groupBy("l_orderkey").agg(F.max("l_linenumber").alias("last"))
    each = li.join(last, "l_orderkey")
    linked = F.col("l_returnflag") == "R"
    return reduce(
        DataFrame.unionByName,
        [
            _triples(o, key("event", k), ("type", lit("NewsSummary")), ("type", lit("Event")), ("label", text), ("hasMentionDate", F.date_format("o_orderdate", "yyyy-MM-dd")), ("hasRawHtml", F.when(F.col(k) % 13 > 0, "<li>")), ("isIdentifiedBy", key("ctx", k)), ("hasTag", _every(k, 2, 1, F.col("o_orderpriority")))),
            _triples(o, key("ctx", k), ("type", lit("Context")), ("isString", text), ("source", _every(k, 3, 1, key("news", k)))),
            _triples(li, ctx, ("subString", sent)),
            _triples(each, sent, ("type", lit("Sentence")), ("referenceContext", ctx), ("anchorOf", sent), ("nextSentence", F.when(n < F.col("last"), name("sent", n + 1))), ("previousSentence", F.when(n > 1, name("sent", n - 1))), ("subString", F.when(linked, name("link", n)))),
            _triples(li.where(linked), name("link", n), ("type", lit("Phrase")), ("referenceContext", sent), ("wikipediaArticle", F.when(F.col("l_linenumber") % 2 == 0, key("article", "l_partkey")))),
        ],
    )


DELETE_EVENT = """DELETE {
  ?u a NewsSummary ; a Event ; label ?l ; hasMentionDate ?day ; hasRawHtml ?html ; isIdentifiedBy ?c ; hasTag ?tag .
  ?c a Context ; isString ?text ; source ?news ; subString ?s .
  ?s a Sentence ; referenceContext ?c ; anchorOf ?anchor ; nextSentence ?next ; previousSentence ?prev ; subString ?link .
  ?link a Phrase ; referenceContext ?s ; wikipediaArticle ?a
} WHERE {
  ?u a NewsSummary ; a Event ; label ?l ; hasMentionDate ?day ; hasRawHtml ?html ; isIdentifiedBy ?c OPTIONAL { ?u hasTag ?tag }
  ?c a Context ; isString ?text ; subString ?s OPTIONAL { ?c source ?news }
  ?s a Sentence ; referenceContext ?c ; anchorOf ?anchor OPTIONAL { ?s nextSentence ?next } OPTIONAL { ?s previousSentence ?prev }
  OPTIONAL { ?s subString ?link . ?link a Phrase ; referenceContext ?s ; wikipediaArticle ?a }
}"""

EVENTS = """WITH l AS (SELECT *, l_orderkey AS k, l_linenumber AS n, l_returnflag = 'R' AS linked, max(l_linenumber) OVER (PARTITION BY l_orderkey) AS last FROM lineitem),
e AS (SELECT *, o_orderkey AS k, o_orderstatus = 'F' AND o_orderkey % 13 > 0 AND o_orderkey IN (SELECT l_orderkey FROM lineitem) AS gone FROM orders),
t AS (SELECT gone, 'event/' || k AS s, unnest(['type', 'type', 'label', 'hasMentionDate', 'hasRawHtml', 'isIdentifiedBy', 'hasTag']) AS p,
unnest(['NewsSummary', 'Event', 'Order ' || k, strftime(o_orderdate, '%Y-%m-%d'), CASE WHEN k % 13 > 0 THEN '<li>' END, 'ctx/' || k, CASE WHEN k % 2 = 0 THEN o_orderpriority END]) AS o FROM e
UNION ALL SELECT gone, 'ctx/' || k, unnest(['type', 'isString', 'source']), unnest(['Context', 'Order ' || k, CASE WHEN k % 3 = 0 THEN 'news/' || k END]) FROM e
UNION ALL SELECT gone, 'ctx/' || k, 'subString', 'sent/' || k || '_' || n FROM l JOIN e USING (k)
UNION ALL SELECT gone, 'sent/' || k || '_' || n, unnest(['type', 'referenceContext', 'anchorOf', 'nextSentence', 'previousSentence']),
unnest(['Sentence', 'ctx/' || k, 'sent/' || k || '_' || n, CASE WHEN n < last THEN 'sent/' || k || '_' || (n + 1) END, CASE WHEN n > 1 THEN 'sent/' || k || '_' || (n - 1) END]) FROM l JOIN e USING (k)
UNION ALL SELECT gone AND n % 2 = 0, 'sent/' || k || '_' || n, 'subString', 'link/' || k || '_' || n FROM l JOIN e USING (k) WHERE linked
UNION ALL SELECT gone AND n % 2 = 0, 'link/' || k || '_' || n, unnest(['type', 'referenceContext', 'wikipediaArticle']), unnest(['Phrase', 'sent/' || k || '_' || n, CASE WHEN n % 2 = 0 THEN 'article/' || l_partkey END]) FROM l JOIN e USING (k) WHERE linked)
"""


@query(EVENTS + "SELECT DISTINCT s, p, o FROM t WHERE NOT gone AND o IS NOT NULL")
def delete_text_events(spark, sf_dir):
    """Events with context, sentences and linked phrases; an event without raw text or sentence stays, and so does a phrase that links no article."""
    store = by_predicate(spark, _event_store(spark, sf_dir).distinct(), _shared(spark, f"texts-{_name(sf_dir)}"))
    given = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(key("event", "o_orderkey").alias("u"))
    return update(store, DELETE_EVENT, given)


@query("""WITH t AS (SELECT o_orderpriority = '1-URGENT' AND o_orderkey % 4 > 0 AS gone, 'news/' || o_orderkey AS s, unnest(['type', 'label', 'note']) AS p, unnest(['News', CASE WHEN o_orderkey % 4 > 0 THEN o_orderpriority END, 'kept']) AS o FROM orders)
SELECT s, p, o FROM t WHERE o IS NOT NULL AND (NOT gone OR p = 'note')""")
def delete_text_news(spark, sf_dir):
    """News urls: without a label the required part has no match and nothing goes."""
    o, k = table(spark, sf_dir, "orders"), "o_orderkey"
    store = _triples(o, key("news", k), ("type", F.lit("News")), ("label", F.when(F.col(k) % 4 > 0, F.col("o_orderpriority"))), ("note", F.lit("kept")))
    given = o.where("o_orderpriority = '1-URGENT'").select(key("news", k).alias("u"))
    return update(store, "DELETE { ?u a News ; label ?l } WHERE { ?u a News ; label ?l }", given)


@query("""SELECT s, p, o FROM (SELECT s_acctbal > 5000 AS gone, 'osm/' || s_suppkey AS s, unnest(['type', 'label', 'hasOsmId', 'hasOsmType', 'asWKT', 'note']) AS p,
unnest(['OsmElement', s_name, CASE WHEN s_suppkey % 2 = 0 THEN CAST(s_suppkey AS VARCHAR) END, CASE WHEN s_suppkey % 3 = 0 THEN 'relation' END, CASE WHEN s_suppkey % 5 = 0 THEN 'POINT (1 2)' END, 'kept']) AS o FROM supplier)
WHERE o IS NOT NULL AND (NOT gone OR p = 'note')""")
def delete_text_outlines(spark, sf_dir):
    s, k = table(spark, sf_dir, "supplier"), "s_suppkey"
    lit = F.lit
    store = _triples(s, key("osm", k), ("type", lit("OsmElement")), ("label", F.col("s_name")), ("hasOsmId", _every(k, 2, 1, F.col(k))), ("hasOsmType", _every(k, 3, 1, lit("relation"))), ("asWKT", _every(k, 5, 1, lit("POINT (1 2)"))), ("note", lit("kept")))
    given = s.where("s_acctbal > 5000").select(key("osm", k).alias("u"))
    text = """DELETE { ?u a OsmElement ; label ?l ; hasOsmId ?id ; hasOsmType ?kind ; asWKT ?wkt }
        WHERE { ?u a OsmElement ; label ?l OPTIONAL { ?u hasOsmId ?id } OPTIONAL { ?u hasOsmType ?kind } OPTIONAL { ?u asWKT ?wkt } }"""
    return update(store, text, given)


@query("SELECT 'class/' || p_partkey AS s, 'type' AS p, p_type AS o FROM part UNION ALL SELECT 'class/' || p_partkey, 'label', p_name FROM part WHERE p_size > 10")
def delete_text_labels(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    store = _triples(p, key("class", "p_partkey"), ("type", F.col("p_type")), ("label", F.col("p_name")))
    return update(store, "DELETE { ?u label ?l } WHERE { ?u label ?l }", p.where("p_size <= 10").select(key("class", "p_partkey").alias("u")))


# deletes on the stored graph


@query("""WITH e AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderkey AS k, o_orderstatus FROM orders), v AS (SELECT month FROM e GROUP BY month HAVING month >= '1998-01')
SELECT month, count(*) FILTER (NOT (o_orderstatus = 'F' AND month IN (SELECT month FROM v))) AS events, month IN (SELECT month FROM e WHERE o_orderstatus = 'F' AND month >= '1998-01') AS rewritten FROM e GROUP BY month
HAVING count(*) FILTER (NOT (o_orderstatus = 'F' AND month IN (SELECT month FROM v))) > 0""")
def stored_deletes(spark, sf_dir):
    """Events deleted in the stored graph by text: only the months that hold a victim are written anew."""
    e = graph.events(spark, sf_dir).where("p = 'type' OR p = 'tag'")
    terms = e.select("month", "module", "s", "p", "o", F.lit("literal").alias("o_kind"), F.lit(None).cast("string").alias("o_datatype"), F.lit(None).cast("string").alias("o_lang"))
    cut(spark.range(1))
    store = modules.Store(spark, _shared(spark, "upkeep-store-" + terms.sparkSession.sparkContext.applicationId))
    store.reset()
    store.load(terms)
    given = table(spark, sf_dir, "orders").where("o_orderstatus = 'F' AND o_orderdate >= DATE '1998-01-01'").select(key("event", "o_orderkey").alias("u"))
    doomed = deleted(store.scan(), "DELETE { ?u a NewsSummary ; tag ?t } WHERE { ?u a NewsSummary OPTIONAL { ?u tag ?t } }", given, "month")
    months = store.delete(doomed)
    left = patterns.of_type(store.scan().select("s", "p", "o"), "NewsSummary", "s").join(store.scan().where("p = 'type'").select("s", "month"), "s")
    return left.groupBy("month").agg(F.count("*").alias("events")).withColumn("rewritten", F.col("month").isin(months))
