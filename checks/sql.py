"""SQL building blocks for DuckDB. Where it can, the SQL takes another road than the Spark code: markup is followed
character by character, contractions are replaced word by word."""

from __future__ import annotations

from atlaslex.functions.coords import KEYWORD_COLUMNS, NUMBER
from atlaslex.functions import WHITESPACE
from checks.adapters import CENTERS, COORD_PAGE, CUSTOMER_POINT, GRID, WIKI_PAGE

COORD_PAGES = f"select {', '.join(COORD_PAGE)} from documents"
WIKI_PAGES = f"select {', '.join(WIKI_PAGE)} from ({COORD_PAGES})"
POINTS = f"select {', '.join(CUSTOMER_POINT)} from customer"
CENTER_ROWS = "select * from (values " + ", ".join(
    f"({c}, cast({lat} as double), cast({lon} as double), cast({c * 10} as bigint))" for c, lat, lon in CENTERS
) + ") v(cluster, lat, lon, n)"
WS = "'" + "".join(WHITESPACE) + "'"


def ctes(**parts: str) -> str:
    """``with a as (...), b as (...)``"""
    return "with recursive " + ", ".join(f"{name} as ({body})" for name, body in parts.items()) + " "


def strip_markup(src: str, key: str, text: str) -> str:
    """(key, text): markup removed, one row per source row."""
    return f"""
 with src as ({src}),
 ch as (select {key}, unnest(string_split(coalesce({text}, ''), '')) c, generate_subscripts(string_split(coalesce({text}, ''), ''), 1) i from src),
 nb as (select *, lead(c) over w nx, lag(c) over w pv from ch window w as (partition by {key} order by i)),
 mv as (select *, case when c = '{{' and nx = '{{' then 1 when c = '}}' and nx = '}}' then -1 when c = '<' then 1 when c = '>' then -1 else 0 end delta,
   case when c = '<' then coalesce(nx, '') <> '/' when c = '>' and pv = '/' then false end flag from nb),
 st as (select *, sum(delta) over w total, last_value(flag ignore nulls) over w in_tag from mv
   window w as (partition by {key} order by i rows between unbounded preceding and current row)),
 lo as (select *, min(total) over (partition by {key} order by i rows between unbounded preceding and current row) low from st),
 kept as (select {key}, string_agg(case when c = '|' then ' ' else c end, '' order by i) kept from lo
   where total - least(0, low) = 0 and not coalesce(in_tag, false) and c not in ('{{', '}}', '[', ']', '(', ')', '''', '<', '>') group by {key})
 select src.{key}, replace(string_split(coalesce(kept, ''), '==See also==')[1], '=', ' ') as text from src left join kept using ({key})"""


def word_list(text: str) -> str:
    """List of the words of a text expression."""
    split = f"string_split(regexp_replace(lower({text}), '[^\\p{{L}}\\p{{N}}_]+', ' ', 'g'), ' ')"
    pairs = {"cannot": "can not", "gimme": "gim me", "gonna": "gon na", "gotta": "got ta", "lemme": "lem me", "wanna": "wan na"}
    cases = " ".join(f"when '{w}' then ['{p.split()[0]}', '{p.split()[1]}']" for w, p in pairs.items())
    return f"flatten(list_transform(list_filter({split}, lambda w: w <> ''), lambda w: case w {cases} else [w] end))"


def term_counts(src: str, key: str = "page_id", text: str = "text", extra: str = "") -> str:
    """(key, word, tf)"""
    cols = key + (", " + extra if extra else "")
    return f"""select {cols}, word, count(*) tf from (select {cols}, unnest({word_list(text)}) word from ({src})) group by {cols}, word"""


def decode(src: str, tag: str = "coords") -> str:
    """All columns of ``src`` plus lat, lon, parsed."""
    number = NUMBER.replace("'", "''")

    def num(x: str) -> str:
        return f"case when regexp_matches({x}, '{number}') then try_cast(replace({x}, '_', '') as double) end"

    dot = "replace(x, ',', '.')"
    return f"""
 select * exclude (p_, cut_, q_, ns_, ew_, la_, lo_, ok_, marks_, a_, b_), 
  case when len(q_) = 2 and a_ is not null and b_ is not null then a_
       when len(q_) > 2 and ok_ then (la_[1] + coalesce(la_[2], 0) / 60 + coalesce(la_[3], 0) / 3600) * coalesce(la_[4], case when q_[ns_] = 'n' then 1 else -1 end)
       else 0.0 end :: double as lat,
  case when len(q_) = 2 and a_ is not null and b_ is not null then b_
       when len(q_) > 2 and ok_ then (lo_[1] + coalesce(lo_[2], 0) / 60 + coalesce(lo_[3], 0) / 3600) * coalesce(lo_[4], case when q_[ns_ + ew_] = 'e' then 1 else -1 end)
       else 0.0 end :: double as lon,
  case when len(q_) < 2 then false when len(q_) = 2 then a_ is not null and b_ is not null else ok_ end as parsed
 from (select *, {num('q_[1]')} a_, {num('q_[2]')} b_,
   list_transform(q_[1:ns_ - 1], lambda x: {num(dot)}) la_,
   list_transform(q_[ns_ + 1:ns_ + ew_ - 1], lambda x: {num(dot)}) lo_,
   coalesce(marks_ = 2 and ns_ > 0 and ew_ > 0 and len(list_filter(q_, lambda x: {num(dot)} is null)) = 2, false) ok_
  from (select *, coalesce(list_position(list_transform(q_[ns_ + 1:], lambda x: instr('ew', x) > 0), true), 0) ew_,
    len(list_filter(q_, lambda x: instr('nesw', x) > 0)) marks_
   from (select *, coalesce(list_position(list_transform(q_, lambda x: instr('ns', x) > 0), true), 0) ns_
    from (select *, list_filter(list_transform(list_filter(p_[1:cut_ - 1], lambda x: not regexp_matches(x, 'Coord|coord|LAT|LONG')), lambda x: lower(trim(x, {WS}))), lambda x: x <> '') q_
     from (select *, coalesce(nullif(list_position(list_transform(p_, lambda x: contains(x, ':') or contains(x, '=')), true), 0), len(p_) + 1) cut_
      from (select *, string_split({tag}, '|') p_ from ({src})))))))"""


def keyword(name: str, tag: str = "coords") -> str:
    """Value of a keyword by the rules of the keyword map, or NULL: the last item with that key."""
    items = f"list_filter(string_split({tag}, '|'), lambda x: case when contains(x, '=') then string_split(x, '=')[1] = '{name}' else contains(x, ':') and string_split(x, ':')[1] = '{name}' end)"
    return f"(case when contains({items}[-1], '=') then string_split({items}[-1], '=')[2] else string_split({items}[-1], ':')[2] end)"


TAGS = f"select page_id, title, lang, source, coord as coords from ({COORD_PAGES})"
DECODED = decode(TAGS)
SHOWN = f"select *, coalesce({keyword('display')}, '') as display from ({TAGS})"
COORD_TABLE = "select coords, lat, lon, page_id, " + ", ".join(
    (f"title as {k}" if k == "title" else f"coalesce({keyword(k)}, '') as {k}") for k in KEYWORD_COLUMNS
) + f", parsed from ({DECODED})"

CONTINENT = """case when lat < -55 then 4 when lon < -25 then (case when lat < 13 then 1 else 0 end)
 when lon > 35 then (case when lat > 0 then (case when lon < 60 and lat < 20 then 6 else 2 end) else (case when lon < 70 then 6 else 3 end) end)
 when lat > 35.8 then 5 else 6 end"""

# Text of the selected places, their words, frequencies and scores.
WIKI_TEXT = strip_markup(
    f"select page_id, wikitext from ({WIKI_PAGES}) where page_id in (select page_id from ({SHOWN}) where display = 'inline,title')",
    "page_id", "wikitext",
)
WIKI_COUNTS = term_counts(WIKI_TEXT)
DOC_TEXT = "select doc_id as page_id, text from documents"
DOC_COUNTS = term_counts(DOC_TEXT)


def scored(counts: str) -> str:
    """(page_id, word, tf, df, tf_idf)"""
    return f"""with tf as ({counts}), dfq as (select word, count(*) n from tf group by word)
 select page_id, tf.word, tf, case when n > 10 then n else -1 end df, tf / (case when n > 10 then n else -1 end) tf_idf from tf join dfq using (word)"""


def top_words(counts: str, n: int = 50) -> str:
    """(page_id, word, tf, article, df, tf_idf)"""
    return f"""select page_id, word, tf, 'Doc ' || page_id as article, df, tf_idf from ({scored(counts)})
 qualify row_number() over (partition by page_id order by tf_idf desc, word) <= {n}"""


EN_WORDS = f"select distinct word from ({term_counts('''select doc_id as page_id, text from documents where lang = 'en' ''')})"
GEO_WORDS = f"select w.*, d.lat, d.lon from ({top_words(DOC_COUNTS)}) w join ({DECODED}) d using (page_id)"
MAPPABLE = f"""select * from ({GEO_WORDS}) where lat between -90 and 90 and lon between -180 and 180
 and word in (select word from ({EN_WORDS}))"""
GRIDDED = f"select *, {CONTINENT} as cluster_7, {', '.join(GRID)} from ({MAPPABLE})"
ZOOMED = " union all ".join(
    f"select '{z}' as zoom, cluster_{z} as cluster, word, tf_idf, lat, lon from gridded" for z in ("7", "193", "4000", "25000")
)
STATS = f"""with gridded as ({GRIDDED}), zoomed as ({ZOOMED})
 select zoom, cluster, word, sum(tf_idf) tf_idf, count(*) ones, sum(lat) sum_lat, sum(lon) sum_lon from zoomed group by zoom, cluster, word"""
