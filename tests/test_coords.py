"""Coordinate templates: hand-made cases."""

import pytest
from pyspark.sql import functions as F

from atlaslex.functions.coords import coord_tags, decode_coord, keyword_example, keyword_map, page_coord, preferred_tag
from atlaslex.functions.geo import continent, continent_name
from atlaslex.functions.links import categories, dump_date, dump_language, language_links
from atlaslex.plans import geo_index

POSITIONS = [
    ("Coord|17.250125|-61.504875|type:landmark|name=Gull Point Light", 17.250125, -61.504875, True),
    ("Coord|5|6|N|121|3|W|type:event|name=Regatta start", 5 + 6 / 60, -(121 + 3 / 60), True),
    ("Coord|51|N|108|W|region:CA-SK_type:adm1st_scale:2000000|display=title", 51, -108, True),
    ("Coord|18|24|N|7|11|E|type:city", 18.4, 7 + 11 / 60, True),
    ("Coord|12,5|S|7|30|E", -12.5, 7.5, True),
    ("Coord|1|2|3|n|4|5|6|e", 1 + 2 / 60 + 3 / 3600, 4 + 5 / 60 + 6 / 3600, True),
    ("coord| 10 | 20 |display=title", 10, 20, True),
    ("Coord|LAT|LONG|1_0|2e1", 10, 20, True),
    ("Coord|1|N|2|E|3", 1, 2, True),
    ("Coord|1|2|3|4|N|5|E", (1 + 2 / 60 + 3 / 3600) * 4, 5, True),
    ("Coord|N|5|E", 0, 5, True),
    ("coord|display=title", 0, 0, False),
    ("Coord|1|2|3|4", 0, 0, False),
    ("Coord|42,5|7,1", 0, 0, False),
    ("Coord|1d|2", 0, 0, False),
    ("Coord|1|E|2|N", 0, 0, False),
    ("Coord|1|N|2|S", 0, 0, False),
    ("Coord|1|N|2|E|W", 0, 0, False),
    ("Coord|1|NS|2|EW", 0, 0, False),
    ("Coord|1|N|2|E|x", 0, 0, False),
    ("Coord", 0, 0, False),
    ("", 0, 0, False),
]


def column(spark, texts, expression):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return [r[1] for r in sorted(rows.select("i", expression(F.col("t"))).collect(), key=lambda r: r[0])]


def test_positions(spark):
    for case, row in zip(POSITIONS, column(spark, [p[0] for p in POSITIONS], decode_coord)):
        assert (row.lat, row.lon) == pytest.approx(case[1:3]), case
        assert row.parsed == case[3], case


def test_keywords(spark):
    got = column(
        spark,
        [
            "Coord|51|N|108|W|region:CA-SK_type:adm1st_scale:2000000|display=title|notes=<ref>{{Cite map|4410|Prairie sheet",
            "Coord|1d|2|url=http://x?a=5|url=s|region:A_type:b",
            "Coord|1|2",
        ],
        keyword_map,
    )
    assert got == [
        {"region": "CA-SK_type", "display": "title", "notes": "<ref>{{Cite map"},
        {"url": "s", "region": "A_type"},
        {},
    ]


def test_tags(spark):
    text = "a {{Coord|1|{{Coord|2}} x}} {{coord|3}} Coord|4"
    assert column(spark, [text], coord_tags) == [["Coord|1|{{Coord|2", "Coord|2", "coord|3"]]
    assert column(spark, [text, "none", "Coord|4"], page_coord) == ["Coord|1|{{Coord|2", None, None]


def test_preferred_tag(spark):
    rows = spark.createDataFrame(
        [(["c1", "c2|display=title", "c3|display=title,inline", "c4|display=inline,title"],), (["c1", "c2"],), ([],)],
        "tags array<string>",
    )
    picked = [r[0] for r in rows.select(preferred_tag(F.col("tags"))).collect()]
    assert picked == ["c3|display=title,inline", "c1", None]


def test_keyword_example(spark):
    texts = ["Coord|1|name=A b|name:c", "Coord|name:c|x", "Coord|rename=c"]
    assert column(spark, texts, lambda t: keyword_example(t, "name")) == ["A b", "c", None]


def test_coord_table_defaults(spark):
    tags = spark.createDataFrame(
        [(7, "Here", "Coord|1|2| display=title|type:city|title=no"), (8, None, "Coord|x")],
        "page_id long, title string, coords string",
    )
    first, second = geo_index.explode_keywords(tags).orderBy("page_id").collect()
    assert (first.lat, first.lon, first.type, first.display, first.title, first.url) == (1, 2, "city", "", "Here", "")
    assert (second.lat, second.lon, second.title, second.parsed) == (0, 0, "", False)
    assert len(first) == 26


def test_continents(spark):
    points = [(-60, 0), (40, -100), (-10, -60), (50, 10), (35.8, 10), (10, 50), (30, 50), (-20, 50), (-25, 135), (-55, 0)]
    rows = spark.createDataFrame([(float(a), float(b)) for a, b in points], "lat double, lon double")
    numbers = [r[0] for r in rows.select(continent(F.col("lat"), F.col("lon"))).collect()]
    assert numbers == [4, 0, 1, 5, 6, 6, 2, 6, 3, 6]
    names = [r[0] for r in rows.select(continent_name(continent(F.col("lat"), F.col("lon")))).collect()]
    assert names[:3] == ["Antarctica", "North America", "South America"]


def test_links(spark):
    text = "[[de:Foo]] [[fr:Bar]] [[es:No]] [[de:Last]] [[Category:A b|x]] [[Kategorie:C|y]] [[Category:no pipe]] [[Category:A b|z]]"
    assert column(spark, [text], language_links) == [{"fr": "Bar", "de": "Last"}]
    assert column(spark, [text], categories) == [["A b", "C"]]


def test_dump_names(spark):
    names = ["/d/enwiki-20200101-pages-articles-multistream.xml", "other.xml"]
    assert column(spark, names, dump_language) == ["en", None]
    assert column(spark, names, dump_date) == ["20200101", None]
