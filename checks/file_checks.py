"""Readers and writers: what is written is read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from atlaslex import jobs
from atlaslex.operators import sampling
from atlaslex.operators.page_lists import page_lists
from atlaslex.plans import labels, significance
from atlaslex.sinks import files
from atlaslex.sources import dump, tables
from atlaslex.staging import new_location, stage
from checks import sql
from checks.adapters import wiki_pages
from checks.map_checks import LABELS, gridded_words
from checks.registry import Tables, query
from checks.symbol_checks import FIRST, PAIRS, coord_table, page_stats, pairs, rounded
from checks.coord_checks import LISTS
from checks.text_checks import TOP_COLUMNS, document_counts, top_words_of_documents
from atlaslex.plans.symbols import first_places


@query("s1_dump_scan", f"select page_id, title, wikitext from ({sql.WIKI_PAGES})")
def _(t: Tables):
    path = new_location(t.spark, "dump")
    files.write_dump(wiki_pages(t), path)
    return dump.read_dump(t.spark, path).select("page_id", "title", "wikitext")


# A dump in the order of its pages, of which the first 120 make up the share; some pages have no template left.
SHARE_OF_DUMP = 119.5 / sampling.PAGES_ESTIMATE
BROKEN = "if(page_id % 7 = 0, replace(wikitext, '}}', ''), if(page_id % 11 = 0, 'no place', wikitext))"
BROKEN_PAGES = f"select page_id, title, case when page_id % 7 = 0 then replace(wikitext, '}}}}', '') when page_id % 11 = 0 then 'no place' else wikitext end as wikitext from ({sql.WIKI_PAGES})"
LEADING = f"select * from ({BROKEN_PAGES}) order by page_id limit 120"


def written_dump(t: Tables) -> str:
    path = new_location(t.spark, "dump")
    files.write_dump(wiki_pages(t).withColumn("wikitext", F.expr(BROKEN)).orderBy("page_id"), path)
    return path


@query("s2_leading_pages", f"select page_id, title, wikitext from ({LEADING})")
def _(t):
    records = dump.leading_records(dump.page_records(t.spark, written_dump(t)), sampling.prefix_rows(SHARE_OF_DUMP))
    return dump.parsed_records(records).select("page_id", "title", "wikitext")


@query(
    "a13_statistics_of_share",
    f"""select count(*) as pages, count(*) filter (where m) as coord_pages, count(*) filter (where g) as successes, cast(0 as bigint) as rejected,
 count(*) filter (where m) - count(*) filter (where g) as failures, cast(round(100.0 * count(*) filter (where m) / count(*), 2) as double) as percent
 from (select contains(title || wikitext, 'Coord') or contains(title || wikitext, 'coord') m, regexp_matches(wikitext, '(?s)[Cc]oord\\|.*?\\}}\\}}') g from ({LEADING}))""",
)
def _(t):
    folder = new_location(t.spark, "map")
    jobs.index(t.spark, folder, written_dump(t), SHARE_OF_DUMP)
    return tables.read_stage(t.spark, f"{folder}/statistics")


TOP_FILE = f"select word, tf, article, df, tf_idf from (select {TOP_COLUMNS} from ({sql.top_words(sql.DOC_COUNTS)}))"


@query("s3_read_word_file", TOP_FILE)
def _(t):
    path = new_location(t.spark, "words")
    files.write_word_file(top_words_of_documents(t), path)
    return tables.read_word_file(t.spark, path)


@query("k2_word_file_rows", f"select word as idx, count(*) as rows from ({TOP_FILE}) group by word")
def _(t):
    path = new_location(t.spark, "words")
    files.write_word_file(top_words_of_documents(t), path)
    lines = t.spark.read.schema("idx string, word string").options(header="true", **tables.CSV_TEXT).csv(path)
    return lines.groupBy("idx").agg(F.count(F.lit(1)).alias("rows"))


CITY = [
    "c_custkey as nn", "c_name as name", "upper(c_name) as name_ascii", "cast(null as {text}) as other_names",
    "cast(c_custkey % 180 - 90 as double) as lat", "cast(c_custkey * 7 % 360 - 180 as double) as lon",
    "c_mktsegment as a", "'P' as b", "'US' as c", "cast(null as {text}) as d", "'x' as e",
    "case when c_acctbal > 0 then c_mktsegment end as f", "'1' as g", "'2' as h", "'3' as i", "'4' as j", "'5' as k",
    "cast(c_nationkey as {text}) as region", "'2020-01-01' as date",
]


def city_columns(text: str) -> list[str]:
    return [c.format(text=text) for c in CITY]


def cities(t: Tables):
    """Customers as a city file, read back."""
    path = new_location(t.spark, "cities")
    t.customer.selectExpr(*city_columns("string")).write.options(sep="\t", quote="").csv(path)
    return tables.read_cities(t.spark, path)


@query("s4_headerless_tsv", f"select {', '.join(city_columns('varchar'))} from customer")
def _(t):
    return cities(t)


@query("p15_city_feature", "select c_custkey as nn, c_mktsegment as f from customer where c_acctbal > 0")
def _(t):
    return tables.cities_with_feature(cities(t)).select("nn", "f")


@query("s5_symbol_pages_json", PAIRS)
def _(t):
    path = new_location(t.spark, "symbols-json")
    files.write_symbol_pages(page_lists(pairs(t), "symbol", size=100), path)
    return tables.read_symbol_pages(t.spark, path).select("symbol", F.explode("pages").alias("page_id"))


# Ids far apart, so that lists have several parts.
SPREAD_PAIRS = f"select symbol, page_id * 7919 as page_id from ({PAIRS})"


def symbol_table(t: Tables):
    """The symbol table written as CSV and read back."""
    path = new_location(t.spark, "symbols-csv")
    spread = pairs(t).withColumn("page_id", F.col("page_id") * 7919)
    files.write_symbol_table(page_lists(spread, "symbol"), path)
    schema = "symbol string, pages string, pagecount bigint, first_page bigint, part int, pages_from bigint"
    return t.spark.read.schema(schema).options(header="true", **tables.CSV_TEXT).csv(path)


@query("k4_symbol_pages_csv", LISTS.format(key="symbol", src=SPREAD_PAIRS))
def _(t):
    return symbol_table(t).withColumn("pages", F.array_join(F.from_json("pages", "array<bigint>"), ","))


@query("p9_single_page_of_file", f"select symbol, count(*) as pagecount, min(page_id) as first_page from ({SPREAD_PAIRS}) group by symbol having count(*) <= 20")
def _(t):
    return symbol_table(t).filter("pagecount <= 20 and part = 0").select("symbol", "pagecount", "first_page")


@query("k4_symbol_places_json", f"select symbol as title, lat, lon, title as page_name from ({FIRST})")
def _(t):
    path = new_location(t.spark, "places")
    files.write_symbol_places(first_places(page_stats(pairs(t), "symbol"), coord_table(t)), path)
    schema = "title string, coordsDecimal struct<lat: double, lon: double>, page_name string"
    back = t.spark.read.schema(schema).json(path)
    return rounded(back.select("title", "coordsDecimal.lat", "coordsDecimal.lon", "page_name"))


WORDS_FILE = "select distinct word from (select unnest(string_split(replace(replace(text, chr(13), chr(10)), chr(10), ' '), ' ')) as word from documents) where word <> ''"


@query("s6_word_set", WORDS_FILE)
def _(t):
    path = new_location(t.spark, "dictionary")
    pieces = t.documents.select(F.explode(F.split("text", "[ \n\r]")).alias("value"))
    pieces.write.text(path)
    return tables.read_word_set(t.spark, path)


@query("s6_symbol_set", "select distinct unnest(string_split(replace(replace(text, chr(10), ''), chr(13), ''), '')) as symbol from documents where text <> ''")
def _(t):
    path = new_location(t.spark, "symbol-file")
    t.documents.select("text").write.text(path)
    return tables.read_symbol_set(t.spark, path)


@query("s7_batch_files", f"select page_id, word, tf from ({sql.DOC_COUNTS})")
def _(t):
    path = new_location(t.spark, "batches")
    english = F.col("lang") == "en"
    for part in (t.documents.filter(english), t.documents.filter(~english)):
        pages = part.select(F.col("doc_id").alias("page_id"), F.lit("batch").alias("title"), "text")
        significance.term_counts(pages).write.mode("append").parquet(path)
    return tables.read_stage(t.spark, path).select("page_id", "word", "tf")


@query("s8_reload_stage", f"select word, count(*) as df from ({sql.DOC_COUNTS}) group by word")
def _(t):
    path = new_location(t.spark, "doc-freq")
    files.write_stage(significance.doc_freq(document_counts(t)), path)
    return tables.read_stage(t.spark, path)


@query("k1_write_stage", f"select page_id, word, tf from ({sql.DOC_COUNTS})")
def _(t):
    return stage(document_counts(t), "counts").select("page_id", "word", "tf")


@query("k3_label_files", f"select cast(zoom as integer) as zoom, label, lat, lon from ({LABELS})")
def _(t):
    path = new_location(t.spark, "labels")
    files.write_labels(labels.label_clusters(gridded_words(t)), path)
    back = t.spark.read.schema("label string, lat double, lon double, zoom int").options(header="true", **tables.CSV_TEXT).csv(path)
    return back.select("zoom", "label", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"))
