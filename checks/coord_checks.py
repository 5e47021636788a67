"""Coordinate templates, the coordinate table and what is asked of it."""

from __future__ import annotations

from pyspark.sql import functions as F

from atlaslex.functions import links as link_functions
from atlaslex.functions.coords import (
    allowed_keywords, coord_tags, decode_coord, keyword_map, mentions_coord, page_coord, position_items, preferred_tag,
)
from atlaslex.operators import sampling
from atlaslex.operators.store import KeyedStore
from atlaslex.operators.page_lists import page_lists
from atlaslex.operators.upsert import insert_if_absent, new_rows, update_by_key, with_defaults
from atlaslex.plans import coord_queries, geo_index, keywords, links
from atlaslex.sinks import files
from atlaslex.staging import new_location
from checks import sql
from checks.adapters import coord_pages, wiki_pages
from checks.registry import Tables, query


def tags(t: Tables):
    """(page_id, title, lang, source, coords)"""
    return coord_pages(t).select("page_id", "title", "lang", "source", F.col("coord").alias("coords"))


def coord_table(t: Tables):
    """The decoded coordinate table."""
    return geo_index.explode_keywords(tags(t))


def rounded(df):
    """Coordinates at nine digits."""
    return df.withColumns({"lat": F.round("lat", 9), "lon": F.round("lon", 9)})


ROUNDED_TABLE = f"select * replace (round(lat, 9) as lat, round(lon, 9) as lon) from ({sql.COORD_TABLE})"

# Three templates per page, one of them nested in another.
MANY_TAGS = "'a {{Coord|1|N|' || page_id || '|E|name=' || '{{' || coord || '}} x}} ' || text || ' {{coord|7|8|display=title|' || source || '}} end'"
INNER_TAGS = f"""select page_id, ['Coord|1|N|' || page_id || '|E|name=' || '{{{{' || coord, coord, 'coord|7|8|display=title|' || source] as tags
 from ({sql.COORD_PAGES})"""


@query("u3_coord_tags", f"select page_id, array_to_string(tags, ' ## ') as tags from ({INNER_TAGS})")
def _(t):
    text = coord_pages(t).selectExpr("page_id", f"{MANY_TAGS} as text")
    return text.select("page_id", F.array_join(coord_tags(F.col("text")), " ## ").alias("tags"))


@query(
    "t4_preferred_tag",
    f"select page_id, coalesce(list_filter(tags, lambda x: contains(x, 'display=title'))[-1], tags[1]) as coords from ({INNER_TAGS})",
)
def _(t):
    text = coord_pages(t).selectExpr("page_id", f"{MANY_TAGS} as text")
    return text.select("page_id", preferred_tag(coord_tags(F.col("text"))).alias("coords"))


@query(
    "u4_keyword_map",
    " union all ".join(
        f"select page_id, '{k}' as keyword, {sql.keyword(k)} as value from ({sql.TAGS}) where {sql.keyword(k)} is not null"
        for k in ("type", "display", " display", "region", "url", "name")
    ),
)
def _(t):
    return tags(t).select("page_id", F.explode(keyword_map(F.col("coords"))).alias("keyword", "value"))


@query(
    "u5_position_items",
    f"""select page_id, array_to_string(list_filter(p[1:cut - 1], lambda x: not regexp_matches(x, 'Coord|coord|LAT|LONG')), '|') as items
 from (select page_id, string_split(coords, '|') p, list_position(list_transform(string_split(coords, '|'), lambda x: contains(x, ':') or contains(x, '=')), true) cut from ({sql.TAGS}))""",
)
def _(t):
    return tags(t).select("page_id", F.array_join(position_items(F.col("coords")), "|").alias("items"))


@query("u6_decode_position", f"select page_id, round(lat, 9) as lat, round(lon, 9) as lon, parsed from ({sql.DECODED})")
def _(t):
    decoded = tags(t).select("page_id", decode_coord(F.col("coords")).alias("at"))
    return decoded.select(
        "page_id", F.round("at.lat", 9).alias("lat"), F.round("at.lon", 9).alias("lon"), "at.parsed"
    )


@query("r6_coord_table", ROUNDED_TABLE)
def _(t):
    return rounded(coord_table(t))


@query(
    "p14_allowed_keywords",
    f"select page_id, len(list_distinct(list_filter(list_transform(list_filter(string_split(coords, '|'), lambda x: contains(x, '=') or contains(x, ':')), lambda x: case when contains(x, '=') then string_split(x, '=')[1] else string_split(x, ':')[1] end), lambda k: k in ('type', 'display', 'region', 'url', 'name')))) as kept from ({sql.TAGS})",
)
def _(t):
    kept = F.size(allowed_keywords(keyword_map(F.col("coords"))))
    return tags(t).select("page_id", kept.cast("bigint").alias("kept"))


@query("p1_mentions_coord", f"select page_id from pages where contains(html, 'Coord') or contains(html, 'coord') union all select page_id from ({sql.WIKI_PAGES})")
def _(t):
    html = t.pages.filter(mentions_coord(F.col("html"))).select("page_id")
    return html.unionByName(wiki_pages(t).filter(mentions_coord(F.col("wikitext"))).select("page_id"))


HTML_AND_WIKI = f"select page_id, wikitext from ({sql.WIKI_PAGES}) union all select -page_id - 1, html from pages"


@query("p2_has_coord_tag", f"select page_id, regexp_extract(wikitext, '(?s)([Cc]oord\\|.*?)\\}}\\}}', 1) as coords from ({HTML_AND_WIKI}) where regexp_matches(wikitext, '(?s)[Cc]oord\\|.*?\\}}\\}}')")
def _(t):
    html = t.pages.select((-F.col("page_id") - 1).alias("page_id"), F.col("html").alias("wikitext"))
    both = wiki_pages(t).select("page_id", "wikitext").unionByName(html)
    return both.select("page_id", page_coord(F.col("wikitext")).alias("coords")).filter("coords <> ''")


@query("p3_shown_in_title", f"select page_id, title from ({sql.COORD_TABLE}) where display = 'inline,title'")
def _(t):
    return geo_index.shown_in_title(coord_table(t)).select("page_id", "title")


@query("p4_of_type", f"select count(*) as cities from ({sql.COORD_TABLE}) where type = 'city'")
def _(t):
    return coord_queries.of_type(coord_table(t), "city").agg(F.count(F.lit(1)).alias("cities"))


@query("p5_bounding_box", f"select title from ({sql.COORD_TABLE}) where lat between 20 and 60 and lon between -120.5 and -10")
def _(t):
    return coord_queries.in_box(coord_table(t), (20, 60), (-120.5, -10))


@query("p6_title_contains", f"select title, type, round(lat, 9) as lat, round(lon, 9) as lon from ({sql.COORD_TABLE}) where contains(title, '7')")
def _(t):
    return rounded(coord_queries.title_contains(coord_table(t), "7"))


@query("p6_title_equals", f"select title, type, round(lat, 9) as lat, round(lon, 9) as lon from ({sql.COORD_TABLE}) where title = 'Doc 12'")
def _(t):
    return rounded(coord_queries.title_is(coord_table(t), "Doc 12"))


@query("p13_after_page", f"select page_id, title from ({sql.COORD_TABLE}) where page_id > 120")
def _(t):
    return coord_queries.after_page(coord_table(t), 120).select("page_id", "title")


@query("q8_coords_sql", f"select type, count(*) as places, round(min(lat), 6) as south, round(max(lat), 6) as north from ({sql.COORD_TABLE}) where lon < 0 group by type")
def _(t):
    return coord_queries.ask(
        coord_table(t),
        "select type, count(*) as places, round(min(lat), 6) as south, round(max(lat), 6) as north from {coords} where lon < 0 group by type",
    )


KEYS = f"""select trim(k, {sql.WS}) as keyword, count(*) as uses from (select page_id, unnest(list_distinct(list_transform(list_filter(string_split(coords, '|'),
 lambda x: contains(x, '=') or contains(x, ':')), lambda x: case when contains(x, '=') then string_split(x, '=')[1] else string_split(x, ':')[1] end))) k from ({sql.TAGS})) group by all"""


@query("a3_keyword_usage", KEYS)
def _(t):
    return keywords.keyword_usage(tags(t))


@query("p10_common_keywords", f"select * from ({KEYS}) where uses > 10")
def _(t):
    return keywords.common_keywords(keywords.keyword_usage(tags(t)))


VALUES = f"""select page_id, case when contains(coords, '|display=') then split_part(split_part(coords, '|display=', 2), '|', 1)
 when contains(coords, '|display:') then split_part(split_part(coords, '|display:', 2), '|', 1) end as value from ({sql.TAGS})"""


@query("t7_keyword_values", f"select * from ({VALUES}) where value is not null")
def _(t):
    return keywords.keyword_values(tags(t), "display")


@query("t7_keyword_examples", f"select least(count(*), 10) as examples, bool_and(value in ('inline,title', 'title')) as known from ({VALUES}) where value is not null")
def _(t):
    examples = keywords.keyword_examples(tags(t), "display", 10)
    return examples.agg(F.count(F.lit(1)).alias("examples"), F.bool_and(F.col("value").isin("inline,title", "title")).alias("known"))


# The drawn rows themselves.
@query(
    "t7_drawn_examples",
    f"select page_id, value from ({VALUES}) where value is not null qualify row_number() over (order by ('0x' || substr(md5(concat_ws(':', '5', page_id)), 1, 13))::bigint, page_id) <= 40",
)
def _(t):
    return keywords.keyword_examples(tags(t), "display", 40, seed=5).select("page_id", "value")


@query(
    "q9_keyword_profile",
    f"select keyword, uses, uses > 10 as common, cast(round(100.0 * uses / (select count(*) from documents), 2) as double) as percent from ({KEYS})",
)
def _(t):
    usage = keywords.keyword_usage(tags(t))
    total = tags(t).agg(F.count(F.lit(1))).scalar()
    return usage.select(
        "keyword", "uses", (F.col("uses") > keywords.RARE_UP_TO).alias("common"),
        F.round(F.lit(100.0) * F.col("uses") / total, 2).alias("percent"),
    )


@query("t5_first_rows", f"select page_id, coords from ({sql.TAGS}) order by page_id limit 50")
def _(t):
    return sampling.first_rows(tags(t).select("page_id", "coords"), 50, ["page_id"])


@query("t8_contiguous_slice", f"select page_id, coords from ({sql.TAGS}) order by page_id limit 10 offset 37")
def _(t):
    return sampling.contiguous_slice(tags(t).select("page_id", "coords"), 37, 10, "page_id")


@query("t6_sample", "select least(count(*), 500) as rows, least(count(*), 500) as distinct_rows from events")
def _(t):
    drawn = sampling.sample_rows(t.events, 500, ["event_id"], seed=7)
    return drawn.agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("event_id").alias("distinct_rows")
    )


# A box of places that lie in the order of their place key.
@query("p5_placed_box", f"select page_id, title, round(lat, 9) as lat, round(lon, 9) as lon from ({sql.COORD_TABLE}) where lat between 20 and 60 and lon between -120.5 and -10")
def _(t):
    path = new_location(t.spark, "map")
    files.write_placed(coord_table(t).select("page_id", "title", "lat", "lon"), path, group_bytes=1 << 14)
    return rounded(coord_queries.placed_in_box(t.spark.read.parquet(path), (20, 60), (-120.5, -10)))


@query("s2_prefix_share", "select doc_id as page_id, text from documents order by doc_id limit (select cast(floor(count(*) * 0.25) + 1 as bigint) from documents)")
def _(t):
    pages = t.documents.select(F.col("doc_id").alias("page_id"), "text")
    return sampling.prefix_share(pages, 0.25, estimate=pages.count())


# Half of the pages is in the store, by folders of 50 ids; all come again, then the labelled ones change, some of them twice.
STORED = "select doc_id as page_id, case when doc_id % 2 = 0 then 'first' else 'second' end as title, lang from documents"


def half_stored(t: Tables) -> KeyedStore:
    store = KeyedStore(t.spark, new_location(t.spark, "store"), "page_id", span=50)
    rows = t.documents.select(F.col("doc_id").alias("page_id"), F.lit("first").alias("title"), "lang")
    store.insert(rows.filter("page_id % 2 = 0"), [F.col("title")])
    store.insert(rows.withColumn("title", F.lit("second")), [F.col("title")])
    return store


@query("k5_store_insert", STORED)
def _(t):
    return half_stored(t).read()


@query("k7_store_update", f"select page_id, case when quality is not null and doc_id % 3 = 0 then 'better' when quality is not null then 'quality ' || quality else title end as title, lang from ({STORED}) left join labels on doc_id = page_id")
def _(t):
    store = half_stored(t)
    changes = t.labels.select(F.col("doc_id").alias("page_id"), F.concat(F.lit("quality "), "quality").alias("title"), F.lit(1).alias("at"))
    twice = changes.filter("page_id % 3 = 0").withColumns({"title": F.lit("better"), "at": F.lit(2)})
    unknown = changes.withColumn("page_id", -F.col("page_id") - 1)
    store.update(changes.unionByName(twice).unionByName(unknown), ["title"], [F.col("at").desc()])
    return store.read()


# Coordinates of English documents are loaded already; the whole table comes in again.
@query("k5_insert_if_absent", f"select page_id, title, case when lang = 'en' then 'old' else coords end as coords from ({sql.TAGS})")
def _(t):
    incoming = tags(t).select("page_id", "title", "coords")
    existing = tags(t).filter("lang = 'en'").select("page_id", "title", F.lit("old").alias("coords"))
    return insert_if_absent(existing, incoming, "page_id", [F.col("coords")])


@query("k5_first_per_key", "select source as title, min(doc_id) as page_id from documents where source not in (select source from documents where n_chars > 20000) group by source")
def _(t):
    rows = t.documents.select(F.col("source").alias("title"), F.col("doc_id").alias("page_id"), "n_chars")
    existing = rows.filter("n_chars > 20000")
    return new_rows(rows, existing, "title", [F.col("page_id")]).select("title", "page_id")


# Every third page comes twice, the second time with another template; the first one loaded counts.
@query("k5_first_loaded_wins", f"select page_id, title, coords from ({sql.TAGS}) where page_id % 2 = 1")
def _(t):
    rows = tags(t).select("page_id", "title", "coords")
    order = {"dump_file": F.lit("file_a"), "dump_position": F.lit(2)}
    again = rows.filter("page_id % 3 = 0").withColumn("coords", F.lit("A template that sorts first"))
    both = rows.withColumns(order).unionByName(again.withColumns(order | {"dump_position": F.lit(5)}))
    existing = rows.filter("page_id % 2 = 0")
    return geo_index.first_loaded(both, existing, ["dump_file", "dump_position"]).select("page_id", "title", "coords")


@query("k6_defaults", "select item_id, text, '' as display, cast(0.0 as double) as lat, coalesce(nullif(text, text), '') as notes from benchmark")
def _(t):
    table = t.benchmark.withColumn("notes", F.lit(None).cast("string"))
    return with_defaults(table, {"display": "", "lat": 0.0, "notes": ""})


@query("k7_update_by_key", "select doc_id as page_id, case when quality is not null then 'quality ' || quality else source end as title, lang from documents left join labels using (doc_id)")
def _(t):
    table = t.documents.select(F.col("doc_id").alias("page_id"), F.col("source").alias("title"), "lang")
    changes = t.labels.select(F.col("doc_id").alias("page_id"), F.concat(F.lit("quality "), "quality").alias("title"))
    return update_by_key(table, changes, "page_id", ["title"])


@query("j2_selected_pages", f"select page_id, length(wikitext) as characters from ({sql.WIKI_PAGES}) where page_id in (select page_id from ({sql.COORD_TABLE}) where display = 'inline,title')")
def _(t):
    chosen = geo_index.selected_pages(wiki_pages(t), coord_table(t))
    return chosen.select("page_id", F.length("wikitext").cast("bigint").alias("characters"))


@query("j3_title_lookup", "select distinct source as title, coalesce(first, -1) as page_id from documents left join (select source as s, min(doc_id) as first from documents where lang = 'de' group by source) on s = source union all select 'No such page', -1")
def _(t):
    german = t.documents.filter("lang = 'de'").select(F.col("source").alias("title"), F.col("doc_id").alias("page_id"))
    asked = t.documents.select(F.col("source").alias("title")).distinct()
    asked = asked.unionByName(t.spark.createDataFrame([("No such page",)], "title string"))
    return geo_index.page_index_of_title(asked, geo_index.title_table(german))


@query("j3_page_text", f"""select distinct source as title, coalesce(first, -1) as page_id, text as wikitext from documents d
 left join (select source as s, min(doc_id) as first from documents where lang = 'de' group by source) on s = source
 left join (select doc_id, text from documents) x on x.doc_id = first""".replace("text as wikitext", "x.text as wikitext"))
def _(t):
    german = t.documents.filter("lang = 'de'").select(F.col("source").alias("title"), F.col("doc_id").alias("page_id"))
    asked = t.documents.select(F.col("source").alias("title")).distinct()
    pages = t.documents.select(F.col("doc_id").alias("page_id"), F.col("text").alias("wikitext"))
    return geo_index.page_of_title(asked, geo_index.title_table(german), pages)


@query("a10_counts", f"select count(*) as rows, count(*) filter (where display <> '') as with_display, max(page_id) as last_page from ({sql.COORD_TABLE})")
def _(t):
    return coord_table(t).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("display") != "").alias("with_display"), F.max("page_id").alias("last_page")
    )


STATISTICS = f"""select count(*) as pages, count(*) filter (where m) as coord_pages, count(*) filter (where m and g) as successes, count(*) filter (where m and not g) as failures,
 cast(round(100.0 * count(*) filter (where m) / count(*), 2) as double) as percent from (select contains(wikitext, 'Coord') or contains(wikitext, 'coord') m, regexp_matches(wikitext, '(?s)[Cc]oord\\|.*?\\}}\\}}') g from ({HTML_AND_WIKI}))"""


@query("a13_load_statistics", STATISTICS)
def _(t):
    html = t.pages.select((-F.col("page_id") - 1).alias("page_id"), F.col("html").alias("wikitext"))
    return geo_index.load_statistics(wiki_pages(t).select("page_id", "wikitext").unionByName(html))


@query("q1_geo_index", ROUNDED_TABLE)
def _(t):
    return rounded(geo_index.build_geo_index(wiki_pages(t)).coords)


@query("q1_geo_pages", f"select page_id, title, coords from ({sql.TAGS})")
def _(t):
    pages = wiki_pages(t)
    twice = pages.unionByName(pages.filter("page_id % 5 = 0"))
    return geo_index.build_geo_index(twice).pages


@query("q1_geo_titles", f"select title, page_id from ({sql.COORD_TABLE}) where display = 'inline,title'")
def _(t):
    return geo_index.build_geo_index(wiki_pages(t)).titles


@query("u10_language_links", f"select page_id, lang as language, title as foreign_title from ({sql.WIKI_PAGES}) where lang <> 'es'")
def _(t):
    return links.language_pages(wiki_pages(t))


@query("u10_same_page_in", f"select page_id, case when lang = 'de' then title end as foreign_title from ({sql.WIKI_PAGES})")
def _(t):
    return links.same_page_in(wiki_pages(t), "de")


@query("u11_categories", f"select page_id, source as category from ({sql.WIKI_PAGES})")
def _(t):
    return links.category_pages(wiki_pages(t)).select("page_id", "category")


@query("j10_category_members", f"select c.page_id, c.source as category, l.quality from ({sql.WIKI_PAGES}) c join labels l on l.doc_id = c.page_id")
def _(t):
    members = links.category_pages(wiki_pages(t))
    return members.join(t.labels.select(F.col("doc_id").alias("page_id"), "quality"), "page_id")


LISTS = """select {key}, cast(sum(n) over (partition by {key}) as bigint) as pagecount, min(first) over (partition by {key}) as first_page,
 cast(row_number() over (partition by {key} order by pages_from) - 1 as integer) as part, pages_from, pages
 from (select {key}, cast(page_id // 1000000 * 1000000 as bigint) as pages_from, count(*) as n, min(page_id) as first,
  string_agg(cast(page_id as varchar), ',' order by page_id) as pages from ({src}) group by {key}, pages_from)"""


@query("a14_category_pages", LISTS.format(key="category", src=f"select page_id, source as category from ({sql.WIKI_PAGES})"))
def _(t):
    return links.category_map(wiki_pages(t)).withColumn("pages", F.array_join("pages", ","))


@query("q10_category_lists_by_100", LISTS.format(key="category", src=f"select page_id, source as category from ({sql.WIKI_PAGES})").replace("1000000", "100"))
def _(t):
    lists = page_lists(links.category_pages(wiki_pages(t)), "category", size=100)
    return lists.withColumn("pages", F.array_join("pages", ","))


FILES = "case when lang = 'es' then source || '.xml' else lang || 'wiki-2020010' || length(source) || '-pages-articles-multistream.xml' end"


@query("u12_dump_file_name", "select doc_id, case when lang <> 'es' then lang end as language, case when lang <> 'es' then '2020010' || length(source) end as dump_date from documents")
def _(t):
    named = t.documents.selectExpr("doc_id", f"'/dumps/' || {FILES} as file")
    return named.select(
        "doc_id",
        link_functions.dump_language(F.col("file")).alias("language"),
        link_functions.dump_date(F.col("file")).alias("dump_date"),
    )
