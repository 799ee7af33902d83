"""Enrichment: parsed events and articles joined with snapshot tables in place of remote services.

Lookups are left joins on distinct keys, so each key is resolved once and a miss
is a null, known or not. Depth is two unrolled rounds, never a recursion.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventweave.functions import terms
from eventweave.operators.closure import closure, cut


def entity_id(uri: Column) -> Column:
    return terms.last_segment(uri)


def labels_of(entities: DataFrame, labels: DataFrame, lang: str = "en") -> DataFrame:
    """(entity_id, label): one language; of several labels the greatest, so that reruns agree; without one, no row."""
    return entities.select("entity_id").distinct().join(labels.where(F.col("lang") == lang), "entity_id").groupBy("entity_id").agg(F.max("label").alias("label"))


def location_relations(properties: DataFrame, location: str = "location", image: str = "image") -> DataFrame:
    """(property): those below ``location`` by one step or more that are not directly below ``image``; from (property, parent)."""
    pairs = closure(properties.select(F.col("property").alias("src"), F.col("parent").alias("dst")))
    below = pairs.where(F.col("dst") == location).select(F.col("src").alias("property"))
    return below.join(properties.where(F.col("parent") == image).select("property"), "property", "left_anti")


def parent_locations(entities: DataFrame, claims: DataFrame, properties: DataFrame, predicates: DataFrame) -> DataFrame:
    """(entity_id, location map: parent to its relations). ``predicates``: (property, predicate) of direct claims."""
    good = predicates.join(location_relations(properties), "property", "left_semi").select(F.col("predicate").alias("p"))
    hits = claims.where("o_kind = 'uri'").join(good, "p", "left_semi").join(entities.select(F.col("entity_id").alias("s")).distinct(), "s", "left_semi")
    per = hits.groupBy("s", "o").agg(F.array_sort(F.collect_set("p")).alias("relations"))
    return per.groupBy(F.col("s").alias("entity_id")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("o", "relations")))).alias("location"))


def one_hop(entities: DataFrame, claims: DataFrame) -> DataFrame:
    return claims.join(entities.select(F.col("entity_id").alias("s")).distinct(), "s", "left_semi")


def osm_ids(entities: DataFrame, table: DataFrame) -> DataFrame:
    """(entity_id, relations, objects): valid ids only; relations are digits, objects are way or node and digits."""
    t = table.select(entity_id(F.col("entity_uri")).alias("entity_id"), "osmrelid", "osmobj")
    relation = F.when(F.col("osmrelid").rlike(r"^\d+$"), F.col("osmrelid"))
    obj = F.when(F.col("osmobj").rlike(r"^(way|node)/\d+$"), F.col("osmobj"))
    return entities.select("entity_id").distinct().join(t, "entity_id").groupBy("entity_id").agg(F.array_sort(F.collect_set(relation)).alias("relations"), F.array_sort(F.collect_set(obj)).alias("objects"))


def outline_keys(ids: DataFrame) -> DataFrame:
    """(entity_id, query_key): relations, and objects only where there are none."""
    chosen = F.when(F.size("relations") > 0, F.transform("relations", lambda r: F.concat(F.lit("relation/"), r))).otherwise(F.col("objects"))
    return ids.select("entity_id", F.explode(chosen).alias("query_key"))


def geocoded(keys: DataFrame, outlines: DataFrame) -> DataFrame:
    """Keys with their first outline (osm_id, osm_type, wkt), null where unknown."""
    first = outlines.groupBy("query_key").agg(F.min(F.struct("osm_id", "osm_type", "wkt")).alias("x"))
    return keys.join(first, "query_key", "left").select(*keys.columns, "x.osm_id", "x.osm_type", "x.wkt")


def article_urls(entities: DataFrame, sitelinks: DataFrame) -> DataFrame:
    """(entity_id, article_url) with nulls for entities without an article."""
    last = sitelinks.groupBy("entity_id").agg(F.max("article_url").alias("article_url"))
    return entities.select("entity_id").distinct().join(last, "entity_id", "left")


def linked_entities(texts: DataFrame, entity_links: DataFrame) -> DataFrame:
    """(text, wikidata, dbpedia): texts are matched as the linker cleans them; unknown texts have empty lists."""
    none = F.array().cast("array<string>")
    known = entity_links.select(terms.linker_text(F.col("text")).alias("clean"), "wikidata", "dbpedia").dropDuplicates(["clean"])
    asked = texts.select("text").distinct().withColumn("clean", terms.linker_text(F.col("text")))
    return asked.join(known, "clean", "left").select("text", F.coalesce("wikidata", none).alias("wikidata"), F.coalesce("dbpedia", none).alias("dbpedia"))


def article_links(events: DataFrame) -> DataFrame:
    """(date, event_index, sentence, url, start_pos) for each link of an event that leads to an article; start_pos is its place in the sentence."""
    link = events.select("date", "event_index", F.inline("sentences")).select("date", "event_index", F.col("idx").alias("sentence"), F.explode("links").alias("l"))
    return link.where(terms.is_article_url(F.col("l.href"))).select("date", "event_index", "sentence", terms.without_fragment(F.col("l.href")).alias("url"), F.col("l.start_pos").alias("start_pos"))


def expanded(urls: DataFrame, articles: DataFrame, rounds: int = 2) -> DataFrame:
    """(url, depth): urls, and what articles' location rows link to, for exactly ``rounds`` rounds; least depth wins."""
    linked = articles.select("url", F.explode("location_links").alias("l")).where(terms.is_article_url(F.col("l.href"))).select("url", terms.without_fragment(F.col("l.href")).alias("next"))
    front = out = urls.select("url").distinct().withColumn("depth", F.lit(1))
    for depth in range(2, rounds + 1):
        front = front.join(linked, "url").select(F.col("next").alias("url")).distinct().withColumn("depth", F.lit(depth))
        out = out.unionByName(front)
    return out.groupBy("url").agg(F.min("depth").alias("depth"))


def event_types(topic_types: DataFrame, parents: DataFrame, event_topics: DataFrame) -> DataFrame:
    """(event, types): the union of the topics' classes; where a group of topics has none, of the next topics up, however far.

    Topics already tried for an event are not tried again, so cycles end.
    """
    front = cut(event_topics.select("event", "topic").distinct())
    tried, out = front, None
    while True:
        hit = cut(front.join(topic_types, "topic").groupBy("event").agg(F.array_sort(F.collect_set("class")).alias("types")))
        out = hit if out is None else out.unionByName(hit)
        up = front.join(hit.select("event"), "event", "left_anti").join(parents, "topic").select("event", F.col("parent").alias("topic")).distinct()
        front = cut(up.join(tried, ["event", "topic"], "left_anti"))
        if front.isEmpty():
            return out
        tried = cut(tried.join(hit.select("event"), "event", "left_anti").unionByName(front))


def resolved(links: DataFrame, articles: DataFrame) -> DataFrame:
    """Links (url, others) with the article that their url leads to (canonical, entity, is_place), null where there is none."""
    return links.join(articles.select("url", "canonical", "entity", "is_place").dropDuplicates(["url"]), "url", "left")


def with_services(articles: DataFrame, labels: DataFrame, parents: DataFrame, ids: DataFrame) -> DataFrame:
    """Articles with their entity's id, label, parent locations and outline ids, each null where unknown; tables keyed by entity_id."""
    keyed = articles.withColumn("entity_id", entity_id(F.col("entity")))
    return keyed.join(labels, "entity_id", "left").join(parents, "entity_id", "left").join(ids, "entity_id", "left")


def location_chain(articles: DataFrame, entity_links: DataFrame, sitelinks: DataFrame) -> DataFrame:
    """(canonical, place): the places named by articles' location texts: text to linked entities to article urls to articles that are places."""
    texts = articles.where("location_text IS NOT NULL AND location_text <> ''").select("canonical", F.col("location_text").alias("text"))
    linked = linked_entities(texts, entity_links).select("text", F.explode("wikidata").alias("entity_uri"))
    keyed = texts.join(linked, "text").select("canonical", entity_id(F.col("entity_uri")).alias("entity_id")).distinct()
    urls = article_urls(keyed, sitelinks).where("article_url IS NOT NULL")
    places = articles.where("is_place").select("url", F.col("canonical").alias("place"))
    return keyed.join(urls, "entity_id").join(places, F.col("article_url") == F.col("url")).select("canonical", "place").distinct()


def leaf_places(located: DataFrame, parents: DataFrame) -> DataFrame:
    """(event, place) without the places that hold another place of the same event, as a set.

    Places and what holds them go by one grouping: what is only held, or only holds, tells itself apart by its marks.
    """
    held = located.join(parents.where("place <> parent"), "place", "left")
    own, holder = F.struct(F.col("place"), F.lit(False).alias("holds")), F.struct(F.col("parent").alias("place"), F.lit(True).alias("holds"))
    marks = held.select("event", F.inline(F.array(own, holder))).where("place IS NOT NULL OR NOT holds")
    return marks.groupBy("event", "place").agg(F.max("holds").alias("holds")).where("NOT holds").select("event", "place")


def cited(citations: DataFrame, references: DataFrame) -> DataFrame:
    """(page, event, refs): each event's references by number, from (page, event, nr) and (page, nr, ref)."""
    met = citations.select("page", "event", "nr").distinct().join(references, ["page", "nr"])
    return met.groupBy("page", "event").agg(F.transform(F.array_sort(F.collect_list(F.struct("nr", "ref"))), lambda x: x["ref"]).alias("refs"))


def geocoded_text(texts: DataFrame, outlines: DataFrame) -> DataFrame:
    """Texts (text) with their first outline; the search table is keyed by the text as asked."""
    return geocoded(texts.select(F.col("text").alias("query_key")), outlines).withColumnRenamed("query_key", "text")


def save_locations(rows: DataFrame, path: str) -> None:
    """The flat events of :func:`events_with_location` as JSON lines."""
    rows.write.mode("overwrite").json(path)


def contained_places(located: DataFrame, parents: DataFrame) -> DataFrame:
    """(event, place, parent): a place lies in another one that the same event links to; (event, place) and (place, parent)."""
    other = located.select("event", F.col("place").alias("parent"))
    return located.join(parents, "place").join(other, ["event", "parent"]).where("place <> parent").select("event", "place", "parent").distinct()


def location_counts(article_links: DataFrame, places: DataFrame) -> DataFrame:
    """One row: sentences with more than one place, events with a place, events with more than one. ``places``: (url)."""
    hits = article_links.select("date", "event_index", "sentence", "url").join(places.select("url").distinct(), "url", "left_semi").distinct()
    sentence = hits.groupBy("date", "event_index", "sentence").count().agg(F.count_if(F.col("count") > 1).alias("sentences_with_more"))
    event = hits.select("date", "event_index", "url").distinct().groupBy("date", "event_index").count()
    counted = event.agg(F.count("*").alias("events_with"), F.count_if(F.col("count") > 1).alias("events_with_more"))
    both = counted.withColumn("sentences_with_more", F.lit(0).cast("long")).unionByName(sentence.select(F.lit(0).cast("long").alias("events_with"), F.lit(0).cast("long").alias("events_with_more"), "sentences_with_more"))
    return both.agg(*[F.sum(c).alias(c) for c in ("sentences_with_more", "events_with", "events_with_more")])


def events_with_location(article_links: DataFrame, events: DataFrame, places: DataFrame) -> DataFrame:
    """Flat rows of events that name a place: (date, event_index, text, place_url), the first located link by place in the text."""
    located = article_links.join(places.select("url").distinct(), "url", "left_semi")
    first = located.groupBy("date", "event_index").agg(F.min(F.struct("sentence", "start_pos", "url")).alias("x"))
    return events.join(first, ["date", "event_index"]).select("date", "event_index", "text", F.col("x.url").alias("place_url"))
