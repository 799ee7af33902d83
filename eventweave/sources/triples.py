"""Graph modules on disk: typed tables to triples, Parquet by module and month, JSON-LD and N-Triples.

A term is (kind, value, datatype, lang) with kind uri, literal or bnode. Set
semantics hold once, at the write. Where triples are made, ``only`` names the
predicates to make; without it all are.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventweave.functions import datetimes, terms
from eventweave.sources import rdf

TERM = ["s", "p", "o", "o_kind", "o_datatype", "o_lang"]


def uri(p: str, o: Column) -> tuple[str, Column]:
    return p, _fact(p, o, "uri", None)


def literal(p: str, o: Column, datatype: str | None = "xsd:string", lang: str | None = None) -> tuple[str, Column]:
    return p, _fact(p, o, "literal", datatype if lang is None else None, lang)


def _fact(p, o, kind, datatype, lang=None) -> Column:
    text = F.lit(None).cast("string")
    some = lambda v: text if v is None else F.lit(v)
    return F.struct(F.lit(p).alias("p"), o.cast("string").alias("o"), F.lit(kind).alias("o_kind"), some(datatype).alias("o_datatype"), some(lang).alias("o_lang"))


def facts(df: DataFrame, module: str, subject: Column, *pairs: tuple[str, Column], only: tuple[str, ...] = ()) -> DataFrame:
    """One triple for each row and pair whose object is present; the source is read once.

    With ``only`` the pairs of other predicates are not made, and a source that none of its pairs needs is not read.
    """
    chosen = [fact for p, fact in pairs if not only or p in only]
    keep = [F.lit(module).alias("module"), "month", subject.alias("s")]
    if not chosen:
        return df.select(*keep, pairs[0][1].alias("none")).where("false").select("module", "month", "s", "none.*")
    return df.select(*keep, F.inline(F.array(*chosen))).where("o IS NOT NULL")


def event_triples(events: DataFrame, only: tuple[str, ...] = ()) -> DataFrame:
    """base and raw triples of parsed portal events: event, context, sentences, links, sources."""
    made = partial(facts, only=only)
    ids = events.withColumn("id", terms.event_id(F.col("date"), F.col("event_index")))
    event, context = F.concat(F.lit("event/"), "id"), F.concat(F.lit("context/"), "id")
    base = made(
        ids, "base", event, uri("type", F.lit("NewsSummary")), uri("type", F.lit("WikiNews")), uri("type", F.lit("Event")), literal("label", F.col("text")),
        uri("isIdentifiedBy", context), literal("hasTag", F.col("category")), literal("hasMentionDate", F.date_format("date", "yyyy-MM-dd'T'00:00:00"), "xsd:dateTime"),
    )
    raw = made(ids, "raw", event, literal("hasRawHtml", F.col("raw")))
    during = made(ids.withColumn("t", F.explode("parent_topics")), "base", event, uri("isOccuringDuring", _topic(F.col("t"))))
    ctx = made(
        ids, "base", context, uri("type", F.lit("Context")), literal("label", F.col("text")), literal("isString", F.col("text")),
        literal("beginIndex", F.lit(0), "xsd:nonNegativeInteger"), literal("endIndex", F.char_length("text"), "xsd:nonNegativeInteger"), uri("sourceUrl", F.col("url")),
    )
    news = made(ids.withColumn("x", F.explode(F.concat(F.transform("source_links", lambda x: x["href"]), F.transform("refs", lambda x: x["url"])))), "base", context, uri("source", F.col("x")))
    each = ids.select("month", "id", F.size("sentences").alias("n"), F.inline("sentences"))
    name = lambda i: F.concat(F.lit("context/"), "id", F.lit("_"), i)
    sent = made(
        each, "base", name(F.col("idx")), uri("type", F.lit("Sentence")), literal("label", F.col("text")), literal("anchorOf", F.col("text")), uri("referenceContext", F.concat(F.lit("context/"), "id")),
        literal("beginIndex", F.col("start"), "xsd:nonNegativeInteger"), literal("endIndex", F.col("end"), "xsd:nonNegativeInteger"),
        uri("previousSentence", F.when(F.col("idx") > 0, name(F.col("idx") - 1))), uri("nextSentence", F.when(F.col("idx") + 1 < F.col("n"), name(F.col("idx") + 1))),
    )
    phrases = each.select("month", "id", "idx", F.posexplode("links").alias("j", "l"))
    is_article = terms.is_article_url(F.col("l.href"))
    phrase = made(
        phrases, "base", F.concat(name(F.col("idx")), F.lit("_"), F.col("j")), uri("type", F.lit("Phrase")), literal("label", F.col("l.text")), literal("anchorOf", F.col("l.text")), uri("referenceContext", name(F.col("idx"))),
        literal("beginIndex", F.col("l.start_pos"), "xsd:nonNegativeInteger"), literal("endIndex", F.col("l.end_pos"), "xsd:nonNegativeInteger"),
        uri("wikipediaArticle", F.when(is_article, F.concat(F.lit("article/"), terms.last_segment(terms.without_fragment(F.col("l.href")))))),
    )
    out = base
    for part in (raw, during, ctx, news, sent, phrase):
        out = out.unionByName(part)
    return out


def _topic(key: Column) -> Column:
    article = F.when(terms.is_article_url(key), terms.last_segment(terms.without_fragment(key)))
    return terms.topic_uri(article, key)


def topic_triples(topics: DataFrame, only: tuple[str, ...] = ()) -> DataFrame:
    """base and raw triples of parsed portal topics; topics with an article share its key over days and months."""
    made = partial(facts, only=only)
    keyed = topics.withColumn("key", F.coalesce("href", "text"))
    article = F.when(terms.is_article_url(F.col("href")), terms.last_segment(terms.without_fragment(F.col("href"))))
    subject = _topic(F.col("key"))
    base = made(
        keyed, "base", subject, uri("type", F.lit("TextTopic")), uri("type", F.lit("WikiNews")), uri("type", F.lit("Event")), uri("type", F.when(article.isNotNull(), F.lit("ArticleTopic"))), literal("label", F.col("text")),
        literal("hasMentionDate", F.date_format("date", "yyyy-MM-dd'T'00:00:00"), "xsd:dateTime"), uri("wikipediaArticle", F.concat(F.lit("article/"), article)),
    )
    up = made(keyed.withColumn("x", F.explode("parents")), "base", subject, uri("isOccuringDuring", _topic(F.col("x"))))
    return base.unionByName(up).unionByName(made(keyed, "raw", subject, literal("hasRawHtml", F.col("raw"))))


def write(triples: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Parquet partitioned by module and month, as a set. Only the written partitions are replaced."""
    spread = triples.dropDuplicates(["module", "month", *TERM])
    spread.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("module", "month").parquet(path)


def missing_months(wanted: DataFrame, built: DataFrame) -> DataFrame:
    """Months (month) of ``wanted`` that no module has yet."""
    return wanted.join(built.select("month").distinct(), "month", "left_anti")


def to_jsonld(triples: DataFrame) -> DataFrame:
    """(module, month, value): an expanded JSON-LD node object a line for each subject."""
    return rdf.node_objects(triples, ["module", "month"])


def from_jsonld(lines: DataFrame) -> DataFrame:
    """The triples of :func:`to_jsonld`'s rows."""
    return rdf.facts_of_lines(lines, ["module", "month"])


def to_ntriples(triples: DataFrame, base: str = "https://example.org/", keep: tuple[str, ...] = ()) -> DataFrame:
    """(value): N-Triples lines, which are Turtle too; columns in ``keep`` stay beside them."""
    def iri(c: Column) -> Column:
        return F.concat(F.lit("<"), F.when(c.contains("://"), c).otherwise(F.concat(F.lit(base), c)), F.lit(">"))

    quoted = F.col("o")
    for raw, escaped in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r")):
        quoted = F.replace(quoted, F.lit(raw), F.lit(escaped))
    kind = F.regexp_replace("o_datatype", "^xsd:", "http://www.w3.org/2001/XMLSchema#")
    tail = F.when(F.col("o_lang").isNotNull(), F.concat(F.lit("@"), "o_lang")).when(F.col("o_datatype").isNotNull(), F.concat(F.lit("^^"), iri(kind))).otherwise("")
    term = F.when(F.col("o_kind") == "literal", F.concat(F.lit('"'), quoted, F.lit('"'), tail)).when(F.col("o_kind") == "bnode", F.col("o")).otherwise(iri(F.col("o")))
    return triples.select(*keep, F.concat_ws(" ", iri(F.col("s")), iri(F.col("p")), term, F.lit(".")).alias("value")).distinct()


def article_triples(articles: DataFrame, only: tuple[str, ...] = ()) -> DataFrame:
    """base and raw triples of articles (month, canonical, name, headline, date_published, date_modified, entity, infobox, is_place, is_topic, location_text, lat, lon).

    A place stands beside an article that is one, and beside every topic's article.
    """
    made = partial(facts, only=only)
    ids = articles.withColumn("id", terms.last_segment(F.col("canonical")))
    article, place, point = F.concat(F.lit("article/"), "id"), F.concat(F.lit("place/"), "id"), terms.point_uri(F.col("lat").cast("string"), F.col("lon").cast("string"))
    own = made(
        ids, "base", article, uri("type", F.lit("WikipediaArticle")), literal("label", F.col("name")), uri("source", F.col("canonical")), uri("sameAs", F.col("entity")),
        literal("datePublished", F.col("date_published"), "xsd:dateTime"), literal("dateModified", F.col("date_modified"), "xsd:dateTime"), literal("name", F.col("name")), literal("headline", F.col("headline")),
    )
    page = made(ids, "base", F.col("canonical"), uri("type", F.lit("Document")))
    raw = made(ids, "raw", article, literal("hasRawHtml", F.col("infobox")))
    placed = ids.where("is_place OR is_topic")
    at = lambda c: F.when(F.col("lat").isNotNull() & F.col("lon").isNotNull(), c)
    spot = made(
        placed, "base", place, uri("type", F.lit("Location")), literal("label", F.col("name")), literal("isIdentifiedBy", F.col("location_text")), uri("wikipediaArticle", article), uri("sameAs", F.col("entity")),
        uri("hasGeometry", at(point)), literal("hasLatitude", at(F.col("lat")), "xsd:decimal"), literal("hasLongitude", at(F.col("lon")), "xsd:decimal"),
    )
    points = made(
        placed.where("lat IS NOT NULL AND lon IS NOT NULL"), "base", point, uri("type", F.lit("Point")), literal("label", F.concat_ws(" ", "lat", "lon")),
        literal("lat", F.col("lat"), "xsd:float"), literal("long", F.col("lon"), "xsd:float"),
    )
    return own.unionByName(page).unionByName(raw).unionByName(spot).unionByName(points)


def nested_place_triples(pairs: DataFrame, only: tuple[str, ...] = ()) -> DataFrame:
    """place isLocatedIn parent, from rows (month, canonical, parent_canonical)."""
    made = partial(facts, only=only)
    of = lambda c: F.concat(F.lit("place/"), terms.last_segment(F.col(c)))
    return made(pairs.where("canonical <> parent_canonical"), "base", of("canonical"), uri("isLocatedIn", of("parent_canonical")))


def timespan_triples(spans: DataFrame, only: tuple[str, ...] = ()) -> DataFrame:
    """Topics' time spans, from rows (month, canonical, start, until, ongoing, evidence) and, if there, start_minute, end_minute, offset_minutes.

    Spans without any part give nothing. Equal spans share their key, which has all parts, the time zone too.
    """
    made = partial(facts, only=only)
    more = {c: F.lit(None).cast("int") for c in ("start_minute", "end_minute", "offset_minutes") if c not in spans.columns}
    known = spans.withColumns(more).where("start IS NOT NULL OR until IS NOT NULL OR ongoing OR start_minute IS NOT NULL OR end_minute IS NOT NULL")
    offset = F.col("offset_minutes")
    stamp, clock = lambda c: datetimes.stamp(F.col(c), offset), lambda c: datetimes.clock(F.col(c), offset)
    key = terms.timespan_uri(stamp("start"), stamp("until"), F.col("ongoing"), clock("start_minute"), clock("end_minute"), datetimes.zone(offset))
    keyed = known.withColumn("key", key).withColumn("topic", F.concat(F.lit("topic/article/"), terms.last_segment(F.col("canonical"))))
    own = made(
        keyed, "base", F.col("key"), uri("type", F.lit("Timespan")), literal("label", F.col("evidence")), literal("hasStartDate", stamp("start"), "xsd:dateTime"),
        literal("hasEndDate", stamp("until"), "xsd:dateTime"), literal("hasOngoingSpan", F.when(F.col("until").isNull() & F.col("ongoing"), F.lit("true")), "xsd:boolean"),
        literal("hasStartTimestamp", clock("start_minute"), "xsd:time"), literal("hasEndTimestamp", clock("end_minute"), "xsd:time"),
    )
    return own.unionByName(made(keyed, "base", F.col("topic"), uri("hasTimespan", F.col("key"))))


def topic_place_triples(topics: DataFrame, only: tuple[str, ...] = ()) -> DataFrame:
    """Topics with an article have the article's place as their location, from rows (month, canonical)."""
    made = partial(facts, only=only)
    ident = terms.last_segment(F.col("canonical"))
    return made(topics, "base", F.concat(F.lit("topic/article/"), ident), uri("hasLocation", F.concat(F.lit("place/"), ident)))


def osm_triples(outlines: DataFrame, only: tuple[str, ...] = ()) -> DataFrame:
    """Outlines of owners, from rows (month, owner, osm_id, osm_type, wkt): only those with any field, keyed by type and id."""
    made = partial(facts, only=only)
    known = outlines.where("osm_id IS NOT NULL OR osm_type IS NOT NULL OR wkt IS NOT NULL")
    key = F.concat(F.lit("osm/"), F.concat_ws("_", "osm_type", "osm_id"))
    own = made(
        known, "osm", key, uri("type", F.lit("OsmElement")), literal("label", F.concat_ws(" ", "osm_type", "osm_id")), literal("hasOsmType", F.col("osm_type")),
        literal("hasOsmId", F.col("osm_id"), "xsd:integer"), literal("asWKT", F.col("wkt"), "geo:wktLiteral"),
    )
    return own.unionByName(made(known, "osm", F.col("owner"), uri("hasOsmElement", key)))


def claim_triples(claims: DataFrame, only: tuple[str, ...] = ()) -> DataFrame:
    """One-hop claims, from rows (month, s, p, o, o_kind, o_datatype, o_lang)."""
    return claims.where(F.col("p").isin(*only) if only else F.lit(True)).select(F.lit("ohg").alias("module"), "month", *TERM)


def event_type_triples(types: DataFrame, labels: DataFrame, only: tuple[str, ...] = ()) -> DataFrame:
    """Events' classes and the classes' labels, from rows (month, event, types) and (entity_id, label)."""
    made = partial(facts, only=only)
    each = types.select("month", "event", F.explode("types").alias("class"))
    named = each.select("month", "class").distinct().join(labels.withColumnRenamed("entity_id", "class"), "class")
    of = F.concat(F.lit("http://www.wikidata.org/entity/"), "class")
    return made(each, "base", F.col("event"), uri("hasWikidataEventType", of)).unionByName(made(named, "base", of, literal("label", F.col("label"))))


def news_triples(events: DataFrame, only: tuple[str, ...] = ()) -> DataFrame:
    """The linked news of parsed events: url type News, with the anchor's text as label."""
    made = partial(facts, only=only)
    sources = F.transform("source_links", lambda x: F.struct(x["href"].alias("url"), x["text"].alias("label")))
    refs = F.transform("refs", lambda x: F.struct(x["url"].alias("url"), x["anchor_text"].alias("label")))
    each = events.select("month", F.inline(F.concat(sources, refs)))
    return made(each, "base", F.col("url"), uri("type", F.lit("News")), literal("label", F.col("label")))


def from_bindings(rows: DataFrame, binding: str = "binding") -> DataFrame:
    """Terms from JSON result bindings, a column of {type, value, datatype, xml:lang}: adds o, o_kind, o_datatype, o_lang; another type raises."""
    kind = F.get_json_object(binding, "$.type")
    known = F.when(kind == "uri", "uri").when(kind.isin("literal", "typed-literal"), "literal").when(kind == "bnode", "bnode")
    bad = F.raise_error(F.concat(F.lit("unknown kind of term: "), F.coalesce(kind, F.lit("none")))).cast("string")
    return rows.withColumns(
        {
            "o": F.get_json_object(binding, "$.value"), "o_kind": F.coalesce(known, bad),
            "o_datatype": F.get_json_object(binding, "$.datatype"), "o_lang": F.get_json_object(binding, "$['xml:lang']"),
        }
    )
