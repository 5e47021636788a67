"""Symbols in articles."""

from __future__ import annotations

from pyspark.sql import functions as F

from atlaslex.functions.words import code_points
from atlaslex.operators.page_lists import page_lists, page_stats
from atlaslex.operators.page_sets import expand_sets, page_sets, set_stats, union_sets
from atlaslex.plans import symbols
from atlaslex.sinks import files
from atlaslex.staging import new_location, stage
from checks import sql
from checks.adapters import SYMBOL_REMOVALS, SYMBOLS, symbol_set, wiki_pages
from checks.coord_checks import LISTS, coord_table, rounded
from checks.registry import Tables, query

WANTED = f"select distinct unnest(string_split('{SYMBOLS}', '')) as symbol except select unnest(string_split('{SYMBOL_REMOVALS}', ''))"
PAIRS = f"select distinct symbol, page_id from (select page_id, unnest(string_split(wikitext, '')) as symbol from ({sql.WIKI_PAGES})) where symbol in ({WANTED})"
PAGE_STATS = f"select symbol, count(*) as pagecount, min(page_id) as first_page from ({PAIRS}) group by symbol"


def wanted(t: Tables):
    """The symbols looked for."""
    return symbols.wanted_symbols(symbol_set(t), symbol_set(t, SYMBOL_REMOVALS))


def pairs(t: Tables):
    """Distinct (symbol, page_id) of all articles."""
    return symbols.symbol_pages(wiki_pages(t), wanted(t))


@query("e1_symbols_less_removals", f"select symbol from (select distinct unnest(string_split(text, '')) as symbol from benchmark where text <> '' except select unnest(string_split('{SYMBOL_REMOVALS}', '')))")
def _(t):
    found = t.benchmark.select(F.explode(code_points(F.col("text"))).alias("symbol")).distinct()
    return symbols.wanted_symbols(found, symbol_set(t, SYMBOL_REMOVALS))


# Fixed values of the built-in removals and two symbols that look like one of them, around every document.
BUILT_IN = f"select 'x' || text || '원原円₩♞' as wikitext, doc_id as page_id from documents"
BUILT_IN_WANTED = ("原", "♞", "%", "₩")


@query("e1_built_in_removals", f"select distinct symbol, page_id from (select page_id, unnest(string_split(wikitext, '')) as symbol from ({BUILT_IN})) where symbol in {BUILT_IN_WANTED}")
def _(t):
    pages = t.documents.selectExpr("concat('x', text, '원原円₩♞') as wikitext", "doc_id as page_id")
    found = symbol_set(t, "원原円₩♞%#*")
    return symbols.symbol_pages(pages, symbols.wanted_symbols(found, symbols.removal_set(t.spark)))


@query("j6_symbols_on_pages", PAIRS)
def _(t):
    return pairs(t)


@query("e2_common_characters", "select doc_id, cast(len(list_intersect(list_distinct(string_split(text, '')), ['%', '&', '+', '@', '!'])) as bigint) as kinds from documents")
def _(t):
    kinds = F.array(*[F.lit(c) for c in "%&+@!"])
    common = F.array_intersect(code_points(F.col("text")), kinds)
    return t.documents.select("doc_id", F.size(common).cast("bigint").alias("kinds"))


@query("a6_matched_symbols", f"select distinct symbol from ({PAIRS})")
def _(t):
    return symbols.matched_symbols(pairs(t))


@query("e3_union_of_matches", f"select symbol from ({PAIRS}) union select symbol from (select distinct unnest(string_split(html, '')) as symbol from pages) where symbol in ({WANTED})")
def _(t):
    html = symbols.symbol_pages(t.pages.select("page_id", F.col("html").alias("wikitext")), wanted(t))
    return symbols.matched_symbols(pairs(t)).union(symbols.matched_symbols(html)).distinct()


@query("a4_symbol_page_lists", LISTS.format(key="symbol", src=PAIRS))
def _(t):
    return page_lists(pairs(t), "symbol").withColumn("pages", F.array_join("pages", ","))


@query("a5_pages_per_symbol", PAGE_STATS)
def _(t):
    return page_stats(pairs(t), "symbol")


# The same from sets, whose dense members are bitmaps.
def symbol_sets(pages, t: Tables):
    """Stored sets of the pages of each symbol."""
    found = stage(symbols.symbol_pages(pages, wanted(t)), "symbol-pages")
    return stage(page_sets(found, "symbol"), "symbol-sets")


@query("a4_symbol_page_sets", PAIRS)
def _(t):
    return expand_sets(symbol_sets(wiki_pages(t), t), "symbol")


@query("a5_counts_of_sets", PAGE_STATS)
def _(t):
    return set_stats(symbol_sets(wiki_pages(t), t), "symbol")


HTML_PAIRS = f"select distinct symbol, page_id from (select page_id, unnest(string_split(html, '')) as symbol from pages) where symbol in ({WANTED})"


@query("e3_union_of_sets", f"{PAIRS} union {HTML_PAIRS}")
def _(t):
    html = t.pages.select("page_id", F.col("html").alias("wikitext"))
    return expand_sets(union_sets(symbol_sets(wiki_pages(t), t), symbol_sets(html, t), "symbol"), "symbol")


RARE_PAIRS = "select distinct word as symbol, doc_id as page_id from (select doc_id, unnest(string_split(text, ' ')) as word from documents)"


@query("p9_single_page_only", f"select symbol, count(*) as pagecount, min(page_id) as first_page from ({RARE_PAIRS}) group by symbol having count(*) = 1")
def _(t):
    words = t.documents.select(F.explode(F.split("text", " ")).alias("symbol"), F.col("doc_id").alias("page_id"))
    return symbols.single_page_symbols(page_stats(words.distinct(), "symbol"))


@query("p9_single_page_of_sets", f"select symbol, count(*) as pagecount, min(page_id) as first_page from ({RARE_PAIRS}) group by symbol having count(*) = 1")
def _(t):
    words = t.documents.select(F.explode(F.array_distinct(F.split("text", " "))).alias("symbol"), F.col("doc_id").alias("page_id"))
    return symbols.single_page_symbols(set_stats(page_sets(stage(words, "words"), "symbol"), "symbol"))


# Every word of the documents as a symbol, through the file of page lists.
@query("p9_single_page_of_lists", f"select symbol, count(*) as pagecount, min(page_id) as first_page from ({RARE_PAIRS}) group by symbol having count(*) = 1")
def _(t):
    words = t.documents.select(F.explode(F.split("text", " ")).alias("symbol"), F.col("doc_id").alias("page_id"))
    path = new_location(t.spark, "symbol-table")
    files.write_symbol_table(page_lists(words.distinct(), "symbol"), path)
    schema = "symbol string, pages string, pagecount bigint, first_page bigint, part int, pages_from bigint"
    back = t.spark.read.schema(schema).options(header="true", quote='"', escape='"', multiLine="true").csv(path)
    return symbols.single_page_symbols(back).select(F.coalesce("symbol", F.lit("")).alias("symbol"), "pagecount", "first_page")


FIRST = f"select s.symbol, s.pagecount, c.page_id, c.title, round(c.lat, 9) as lat, round(c.lon, 9) as lon from ({PAGE_STATS}) s join ({sql.COORD_TABLE}) c on c.page_id = s.first_page"


@query("j7_first_places", FIRST)
def _(t):
    return rounded(symbols.first_places(page_stats(pairs(t), "symbol"), coord_table(t)))


@query("p8_usable_position", f"select page_id, round(lat, 9) as lat, round(lon, 9) as lon from ({sql.COORD_TABLE}) where lon <> 0")
def _(t):
    return rounded(symbols.usable(coord_table(t)).select("page_id", "lat", "lon"))


SHOWN_PAIRS = f"select * from ({PAIRS}) where page_id in (select page_id from ({sql.SHOWN}) where display = 'inline,title')"
SHOWN_FIRST = FIRST.replace(PAIRS, SHOWN_PAIRS)


@query("q7_symbol_places", f"select * from ({SHOWN_FIRST}) where lon <> 0")
def symbol_places(t):
    return rounded(symbols.symbol_places_of_pages(wiki_pages(t), symbol_set(t), symbol_set(t, SYMBOL_REMOVALS)))


# The records as the writer makes them, read back as text.
@query("u15_json_record", f"""select '{{"title":"' || symbol || '","coordsDecimal":{{"lat":0.0,"lon":0.0}},"page_name":"' || title || '"}}' as record, lat, lon from ({FIRST})""")
def _(t):
    path = new_location(t.spark, "records")
    files.write_symbol_places(symbols.first_places(page_stats(pairs(t), "symbol"), coord_table(t)), path)
    lines = t.spark.read.text(path)
    at = F.from_json("value", "coordsDecimal struct<lat: double, lon: double>")["coordsDecimal"]
    # Engines write doubles in different ways: they are compared as numbers.
    record = F.regexp_replace("value", r'(\{"lat":)[^,]*(,"lon":)[^}]*', "$10.0$20.0")
    return rounded(lines.select(record.alias("record"), at["lat"].alias("lat"), at["lon"].alias("lon")))
