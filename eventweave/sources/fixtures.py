"""Small invented pages in the shapes that the extractors read."""

from __future__ import annotations

PORTAL = """<html><body>
<div id="2022_January_1"><div class="description">
<p><b>Storms</b></p>
<ul><li><a href="/wiki/Storm_Ada">Storm Ada</a><ul>
<li>Ada floods <a href="/wiki/Northtown">Northtown</a>. Two bridges fall. <a class="external" href="https://news.example.org/a">(Example News)</a></li>
<li><a href="/wiki/River_Fest">River Fest</a>, <a href="/wiki/Harbour_Fest">Harbour Fest, 2022</a><ul><li>Both are put off.<sup id="cite_ref-3">[3]</sup></li></ul></li>
</ul></li><li class="mw-empty-elt"></li></ul>
<div class="current-events-content-heading">Sport</div>
<ul><li>A plain topic:<ul><li>The <a href="/wiki/Reds">Reds</a> win the cup</li></ul></li></ul>
<p><b>Empty</b></p>
</div></div>
<div id="2022_January_2"></div><table class="vevent"><tr><td class="description"><ul><li>No heading here.</li></ul></td></tr></table>
<div class="reflist"><ol class="references"><li id="cite_note-n-3"><cite class="news"><a class="external" href="https://paper.example.org/b">Festivals off</a></cite></li></ol></div>
</body></html>"""

ARTICLE = """<html><head><script type="application/ld+json">{"url": "https://en.wikipedia.org/wiki/Storm_Ada#top", "name": "Storm Ada", "mainEntity": "http://www.wikidata.org/entity/Q900001", "datePublished": "2022-01-01T00:00:00Z"}</script>
<script>RLQ.push(function(){mw.config.set({"wgPageParseReport":{"limitreport":{"timingprofile":["100.00% 1.0 1 -total"," 20.00% 0.2 1 Template:Infobox_storm"]}}});});</script></head><body>
<table class="infobox vevent"><tbody><tr><th class="infobox-label">Areas affected</th><td class="infobox-data"><div class="location"><a href="/wiki/Northtown">Northtown</a>, coast</div></td></tr>
<tr><th>Date</th><td>January 1, 2022 – January 3, 2022<sup>[1]</sup></td></tr><tr><th>Time</th><td>6:25 a.m. - 8:05 p.m. (UTC+3)</td></tr><tr><th>Duration</th><td>as of January 2022</td></tr>
<tr><td colspan="2"><span class="dtstart">2022-01-01</span></td></tr></tbody></table>
<div id="coordinates"><span class="geo-dms"><span class="latitude">36°13′50.3″N</span><span class="longitude">5°30′W</span></span></div></body></html>"""


def portal_pages(spark):
    return spark.createDataFrame([("January_2022", "https://en.wikipedia.org/wiki/Portal:Current_events/January_2022", PORTAL)], "month string, url string, html string")


def article_pages(spark):
    rows = [("https://en.wikipedia.org/wiki/Storm_Ada", ARTICLE), ("https://en.wikipedia.org/wiki/Storm_Ada", ARTICLE), ("https://en.wikipedia.org/wiki/Talk:Storm", ARTICLE), ("https://en.wikipedia.org/wiki/Bare", "<p>x")]
    return spark.createDataFrame(rows, "url string, html string")
