"""Coordinate templates: find them, read their keywords, decode their position."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from atlaslex.functions import apply, bind, last_wins_map, strip

# The keywords kept as columns of the coordinate table.
KEYWORD_COLUMNS = [
    "accessdate", "date", "dim", "display", "elevation", "format", "globe", "id", "name", "nosave", "notes",
    "publisher", "reason", "region", "scale", "source", "title", "type", "upright", "url", "work",
]
# Template words that are not part of a position.
NOT_POSITION = ["Coord", "coord", "LAT", "LONG"]
# What Python's float() reads, in lower case; the cast of Spark alone would also take '1d'.
NUMBER = r"^[+-]?((\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)(e[+-]?\d+(_\d+)*)?|inf|infinity|nan)$"


def mentions_coord(text: Column) -> Column:
    """Cheap test that a page may hold a coordinate template."""
    return F.contains(text, F.lit("Coord")) | F.contains(text, F.lit("coord"))


def coord_tags(text: Column) -> Column:
    """All coordinate templates of a page, each up to its first ``}}``; one nested in another is listed too."""
    return F.regexp_extract_all(text, F.lit(r"(?s)(?=([Cc]oord\|.*?)\}\})"), F.lit(1))


def preferred_tag(tags: Column) -> Column:
    """The last tag shown in the page title, else the first tag, else NULL."""
    return apply(
        tags, "tags", "coalesce(try_element_at(filter(tags, t -> contains(t, 'display=title')), -1), get(tags, 0))"
    )


def page_coord(text: Column) -> Column:
    """The coordinate template that stands for the page; NULL when it has none."""
    return preferred_tag(coord_tags(text))


def keyword_map(tag: Column) -> Column:
    """map<string,string> of the ``k=v`` and ``k:v`` items; a value ends at the next ``=`` (or ``:``)."""
    entries = """
    transform(filter(items, i -> contains(i, '=') OR contains(i, ':')), i -> named_struct(
      'key', split_part(i, if(contains(i, '='), '=', ':'), 1),
      'value', split_part(i, if(contains(i, '='), '=', ':'), 2)))
    """
    return last_wins_map(apply(F.split(tag, r"\|"), "items", entries))


def allowed_keywords(keywords: Column) -> Column:
    """Keep the listed keywords; keys are compared as written, white space included."""
    return F.map_filter(keywords, lambda k, _: k.isin(*KEYWORD_COLUMNS))


# The items before the first keyword item that are not template words.
_FIRST_KEYWORD = "array_position(transform(items, i -> contains(i, ':') OR contains(i, '=')), true)"
_LEADING = f"""
filter(slice(items, 1, CAST(if(first = 0, size(items), first - 1) AS INT)), i -> NOT i RLIKE '{"|".join(NOT_POSITION)}')
"""


def position_items(tag: Column) -> Column:
    """The positional items before the first keyword item, without the template name."""
    return apply(F.split(tag, r"\|"), "items", bind("first", _FIRST_KEYWORD, _LEADING))


def _number(item: str) -> str:
    return f"CASE WHEN {item} RLIKE r'{NUMBER}' THEN try_cast(replace({item}, '_', '') AS DOUBLE) END"


def _angle(parts: str, sign: str) -> str:
    """Degrees, minutes and seconds times the sign. With more than three numbers the fourth one is the factor instead:
    so the table was always filled."""
    numbers = f"transform({parts}, p -> {_number("replace(p, ',', '.')")})"
    padded = f"concat({numbers}, array_repeat(0D, greatest(3 - size({parts}), 0)), array({sign}))"
    return bind("a", padded, "(a[0] + a[1] / 60 + a[2] / 3600) * a[3]")


_UNKNOWN = "named_struct('lat', 0D, 'lon', 0D, 'parsed', false)"
_TWO_NUMBERS = f"""
if({_number("q[0]")} IS NULL OR {_number("q[1]")} IS NULL, {_UNKNOWN},
   named_struct('lat', {_number("q[0]")}, 'lon', {_number("q[1]")}, 'parsed', true))
"""
# ns and ew are the places of the direction marks; what is not a mark must be a number.
_MARKED = f"""
if(ns > 0 AND ew > 0 AND size(filter(q, x -> instr('nesw', x) > 0)) = 2
   AND size(filter(q, x -> NOT replace(x, ',', '.') RLIKE r'{NUMBER}')) = 2,
   named_struct(
     'lat', {_angle("slice(q, 1, ns - 1)", "if(q[ns - 1] = 'n', 1D, -1D)")},
     'lon', {_angle("slice(q, ns + 1, ew - 1)", "if(q[ns + ew - 1] = 'e', 1D, -1D)")},
     'parsed', true),
   {_UNKNOWN})
"""
_NS = "CAST(array_position(transform(q, x -> instr('ns', x) > 0), true) AS INT)"
_EW = "CAST(array_position(transform(slice(q, ns + 1, size(q)), x -> instr('ew', x) > 0), true) AS INT)"
_DECODE = f"""
CASE WHEN size(q) < 2 THEN {_UNKNOWN}
     WHEN size(q) = 2 THEN {_TWO_NUMBERS}
     ELSE {bind("ns", _NS, bind("ew", _EW, _MARKED))} END
"""


def decode_position(items: Column) -> Column:
    """struct<lat, lon, parsed>: decimal degrees of the positional items.

    Two numbers are taken as they are. More items must hold one N/S mark and, after it, one E/W mark, each behind
    degrees, minutes and seconds. Whatever cannot be read is (0, 0) with ``parsed`` false.
    """
    trimmed = F.transform(items, lambda i: F.lower(strip(i)))
    return apply(F.filter(trimmed, lambda i: i != ""), "q", _DECODE)


def decode_coord(tag: Column) -> Column:
    """struct<lat, lon, parsed> of a coordinate template."""
    return decode_position(position_items(tag))


def keyword_example(tag: Column, keyword: str) -> Column:
    """Value of one keyword as written in the template (``|kw=`` before ``|kw:``), or NULL."""

    def value(mark: str) -> Column:
        rest = F.split_part(tag, F.lit(f"|{keyword}{mark}"), F.lit(2))
        return F.split_part(rest, F.lit("|"), F.lit(1))

    return F.when(F.contains(tag, F.lit(f"|{keyword}=")), value("=")).when(
        F.contains(tag, F.lit(f"|{keyword}:")), value(":")
    )
