"""Language links, categories and dump file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from atlaslex.functions import last_wins_map

# Language codes recognised in links.
LANGUAGES = [
    "ru", "nap", "ja", "ta", "tl", "az", "ht", "et", "ca", "wa", "pms", "de", "nl", "su", "bpy", "fa", "tr", "en",
    "eu", "io", "jv", "nds", "pt", "zh", "bn", "lt", "la", "nn", "no", "he", "sh", "lb", "ro", "hr", "scn", "da",
    "it", "te", "br", "an", "fr", "cs", "is", "new", "lv", "ast", "uk", "mk", "oc", "ku", "sl", "sk", "af", "ka",
    "pl", "ceb", "th", "sv", "id", "bs", "hi", "el", "cy", "gl", "vi", "sq", "fi", "mr", "hu", "ar", "bg", "ms",
    "ko", "be",
]
# The word for "category" in ten languages.
CATEGORY_WORDS = {
    "en": "Category", "fr": "Catégorie", "de": "Kategorie", "ja": "Category", "it": "Categoria", "ru": "Категория",
    "pl": "Kategoria", "nl": "Categorie", "sv": "Kategori", "zh": "Category",
}

LANGUAGE_LINK = r"\[\[(" + "|".join(LANGUAGES) + r"):([^\n]+?)\]\]"
CATEGORY_LINK = r"\[\[(?:" + "|".join(dict.fromkeys(CATEGORY_WORDS.values())) + r"):([^\]\|]+)\|[^\n]+?\]\]"
DUMP_FILE = r"^(.*?)wiki-(\d{8})-pages-articles-multistream.xml"


def language_links(text: Column) -> Column:
    """map<language, title>; the last link of a language counts. The map has one entry per language at most."""
    codes = F.regexp_extract_all(text, F.lit(LANGUAGE_LINK), F.lit(1))
    titles = F.regexp_extract_all(text, F.lit(LANGUAGE_LINK), F.lit(2))
    pairs = F.zip_with(codes, titles, lambda c, t: F.struct(c.alias("key"), t.alias("value")))
    return last_wins_map(pairs)


def language_title(text: Column, language: str) -> Column:
    """Title of the same page in another language, or NULL."""
    return F.try_element_at(language_links(text), F.lit(language))


def categories(text: Column) -> Column:
    """Distinct category names of a page (links that carry a sort key)."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(CATEGORY_LINK), F.lit(1)))


def dump_language(file_name: Column) -> Column:
    """Language code in a dump file name, or NULL for other names."""
    base = F.substring_index(file_name, "/", -1)
    return F.when(base.rlike(DUMP_FILE), F.regexp_extract(base, DUMP_FILE, 1))


def dump_date(file_name: Column) -> Column:
    """Date digits in a dump file name, or NULL for other names."""
    base = F.substring_index(file_name, "/", -1)
    return F.when(base.rlike(DUMP_FILE), F.regexp_extract(base, DUMP_FILE, 2))
