"""Markup, words, frequencies and scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from atlaslex.functions.markup import strip_markup
from atlaslex.functions.words import capitalized, code_points, words
from atlaslex.plans import labels, significance
from atlaslex.plans.geo_index import text_pages
from atlaslex.sources.dump import page_length
from atlaslex.staging import stage
from checks import sql
from checks.adapters import wiki_pages
from checks.registry import Tables, query


def document_pages(t: Tables, *others: str):
    """Documents as plain pages."""
    return t.documents.select(
        F.col("doc_id").alias("page_id"), F.concat(F.lit("Doc "), F.col("doc_id")).alias("title"), "text", *others
    )


def document_counts(t: Tables):
    """Term counts of all documents."""
    return significance.term_counts(document_pages(t))


@query("u1_strip_wiki_markup", sql.strip_markup(sql.WIKI_PAGES, "page_id", "wikitext"))
def _(t):
    return wiki_pages(t).select("page_id", strip_markup(F.col("wikitext")).alias("text"))


@query("u1_strip_html_markup", sql.strip_markup("select page_id, html from pages", "page_id", "html"))
def _(t):
    return t.pages.select("page_id", strip_markup(F.col("html")).alias("text"))


@query("u2_words", f"select doc_id, array_to_string({sql.word_list('text')}, ' ') as words from documents")
def _(t):
    return t.documents.select("doc_id", F.array_join(words(F.col("text")), " ").alias("words"))


SPOKEN = "replace(replace(replace(replace(lower(text), ' the ', ' cannot '), ' of ', ' xgonna '), ' and ', ' wanna! '), ' in ', ' gimmes ')"


@query("u2b_contractions", f"select doc_id, array_to_string({sql.word_list(SPOKEN)}, ' ') as words from documents")
def _(t):
    return t.documents.selectExpr("doc_id", f"{SPOKEN} as text").select(
        "doc_id", F.array_join(words(F.col("text")), " ").alias("words")
    )


@query("a1_term_frequency", sql.DOC_COUNTS)
def _(t):
    return document_counts(t).select("page_id", "word", "tf")


@query("a2_document_frequency", f"select word, count(*) as df from ({sql.DOC_COUNTS}) group by word")
def _(t):
    return significance.doc_freq(document_counts(t))


@query(
    "j1_lookup_document_frequency",
    f"select page_id, word, tf, cast(df as bigint) as df from ({sql.scored(sql.DOC_COUNTS)})",
)
def _(t):
    counts = stage(document_counts(t), "counts")
    frequencies = stage(significance.doc_freq(counts), "df")
    return significance.with_doc_freq(counts, frequencies).select("page_id", "word", "tf", "df")


@query(
    "p11_frequency_threshold",
    f"select word, cast(case when count(*) > 10 then count(*) else -1 end as bigint) as df from ({sql.DOC_COUNTS}) group by word",
)
def _(t):
    return significance.doc_freq(document_counts(t)).select("word", significance.usable_df(F.col("df")).alias("df"))


TOP_COLUMNS = "page_id, word, tf, article, cast(df as bigint) as df, round(tf_idf, 9) as tf_idf"


@query("t1_top_words", f"select {TOP_COLUMNS} from ({sql.top_words(sql.DOC_COUNTS)})")
def top_words_of_documents(t):
    best = significance.significant_words_of_pages(document_pages(t))
    return best.withColumn("tf_idf", F.round("tf_idf", 9))


@query("q2_doc_freq", f"select word, count(*) as df from ({sql.WIKI_COUNTS}) group by word")
def doc_freq_of_articles(t):
    return significance.doc_freq(significance.term_counts(significance.plain_pages(text_pages(wiki_pages(t)))))


@query("q3_tfidf", f"select {TOP_COLUMNS} from ({sql.top_words(sql.WIKI_COUNTS)})")
def tfidf_of_articles(t):
    best = significance.significant_words_of_pages(significance.plain_pages(text_pages(wiki_pages(t))))
    return best.withColumn("tf_idf", F.round("tf_idf", 9))


@query("u7_capitalize", f"select word, case left(word, 1) when 'ß' then 'Ss' else upper(left(word, 1)) end || lower(substring(word, 2)) as label from (select distinct unnest(string_split(text, ' ')) as word from documents)")
def _(t):
    pieces = t.documents.select(F.explode(F.split("text", " ")).alias("word")).distinct()
    return pieces.select("word", capitalized(F.col("word")).alias("label"))


@query("u8_log_score", f"select word, round(n * ln(n), 6) as score from (select word, count(*) n from ({sql.DOC_COUNTS}) group by word)")
def _(t):
    frequencies = significance.doc_freq(document_counts(t))
    as_cluster = frequencies.select(F.lit("7").alias("zoom"), F.lit(0).alias("cluster"), "word", F.col("df").cast("double").alias("tf_idf"), F.col("df").alias("ones"))
    return labels.ranked_words(as_cluster, 10_000_000).select("word", F.round("score", 6).alias("score"))


@query("u9_code_points", "select distinct doc_id, unnest(string_split(text, '')) as symbol from documents where text <> ''")
def _(t):
    return t.documents.select("doc_id", F.explode(code_points(F.col("text"))).alias("symbol")).filter("symbol <> ''")


@query("a15_page_length", "select page_id, length(html) as characters from pages")
def _(t):
    return t.pages.select("page_id", page_length(F.col("html")).cast("bigint").alias("characters"))


@query("r2_cast_score", "select event_id, cast(json_extract_string(props, '$.k') as double) as score, value from events")
def _(t):
    return t.events.select(
        "event_id", F.get_json_object("props", "$.k").try_cast("double").alias("score"), "value"
    )


@query(
    "r7_columns",
    "select page_id, word as label, tf from (select page_id, word, tf from (%s))" % sql.DOC_COUNTS,
)
def _(t):
    return document_counts(t).drop("title").withColumnRenamed("word", "label")


@query(
    "e4_bag_union",
    f"select page_id, word, tf from ({sql.DOC_COUNTS}) union all select conv_id * 1000 + turn, word, tf from ({sql.term_counts('select conv_id, turn, text from conversations', 'conv_id', 'text', 'turn')})",
)
def _(t):
    turns = t.conversations.select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("page_id"), F.lit("turn").alias("title"), "text"
    )
    both = document_counts(t).unionByName(significance.term_counts(turns))
    return both.select("page_id", "word", "tf")


@query(
    "u14_string_functions",
    "select doc_id, round(n_chars / 7.0, 3) as part, split_part(text, ' ', 1) as first_word, contains(lower(text), 'the') as has_the,"
    " trim(replace(left(text, 40), '.', '')) as head, array_to_string(string_split(source, 'c'), '-') as dashed from documents",
)
def _(t):
    return t.documents.select(
        "doc_id",
        F.round(F.col("n_chars") / 7.0, 3).alias("part"),
        F.split_part("text", F.lit(" "), F.lit(1)).alias("first_word"),
        F.contains(F.lower("text"), F.lit("the")).alias("has_the"),
        F.trim(F.replace(F.left("text", F.lit(40)), F.lit("."), F.lit(""))).alias("head"),
        F.array_join(F.split("source", "c"), "-").alias("dashed"),
    )
