"""Queries of the text operators over the supplied tables, with their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atlaslex.llm import bpe, chat, fill_middle, language_id, licenses, lm, mixing, multiset_hash, quality, simhash, spelling, suffix_dedup, url_filter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, folder) -> DataFrame`` and its SQL."""

    def register(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def _license_sql() -> str:
    """Phrases by position in the list of words, notices by regular expressions over the joined words."""

    def pattern(template: str) -> str:
        out, depth = "", []
        for token in template.split():
            if token in ("<opt>", "<alt>"):
                depth.append(token)
                out += "(?:(?:" if token == "<alt>" else "(?:"
            elif token in ("</opt>", "</alt>"):
                out += ")?" if depth.pop() == "<opt>" else "))"
            elif token == "|":
                out += ")|(?:"
            elif token.startswith("<var:"):
                low, high = token[5:-1].split("-")
                out += f"(?: [^ ]+){{{low},{high}}}"
            else:
                out += f" {token}"
        return f"{out} "

    phrases = ", ".join(f"('{label}', {phrase.split()})" for phrase, label in licenses.PHRASES.items())
    notices = ", ".join(f"('{label}', '{pattern(t)}')" for label, t in licenses.TEMPLATES.items())
    return rf"""
with phrases(label, phrase) as (values {phrases}), notices(label, pattern) as (values {notices}),
w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') ws from documents
),
spread as (select doc_id, unnest(ws) word, generate_subscripts(ws, 1) - 1 i from w),
near as (
  select doc_id, i, [word, lead(word, 1) over o, lead(word, 2) over o, lead(word, 3) over o] ahead
  from spread window o as (partition by doc_id order by i)
),
places as (select doc_id, label, i from near, phrases where ahead[: len(phrase)] = phrase),
base as (
  select doc_id, count(*) n_base, min(i) first_word, max(i) last_word, list(distinct label) labels from places group by 1
),
whole as (
  select doc_id, list(distinct label) labels from w, notices
  where regexp_matches(' ' || array_to_string(ws, ' ') || ' ', pattern) group by 1
)
select doc_id, len(ws)::bigint n_words, coalesce(n_base, 0)::bigint n_base, first_word, last_word,
  coalesce(array_to_string(list_sort(base.labels), ','), '') base_labels,
  coalesce(array_to_string(list_sort(list_concat(coalesce(base.labels, []), coalesce(whole.labels, []))), ','), '') labels,
  case when whole.labels is not null then 1.0 when n_base > 0 then 0.5 else 0.0 end::double score
from w left join base using (doc_id) left join whole using (doc_id)
"""


@query("op1_license_scan", _license_sql())
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.summary(licenses.find_notices(documents(spark, folder)))


def _url_sql() -> str:
    rules = ", ".join(f"('{r}', '{r[: r.index('/')]}', '{r[r.index('/') :]}', '{v}')" for r, v in url_filter.RULES.items())
    terms = ", ".join(f"('{t}', {w})" for t, w in url_filter.VOCABULARY.items())
    return rf"""
with rules(rule, rule_host, rule_path, says) as (values {rules}), terms(term, weight) as (values {terms}),
cut as (
  select page_id, coalesce(url, '') u,
    case when contains(url, '://') then regexp_extract(substr(url, strpos(url, '://') + 3), '^[^?#]*') else '' end rest
  from pages
),
split as (
  select page_id, translate(u, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') u,
    translate(regexp_extract(rest, '^[^/]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') host,
    case when contains(rest, '/') then substr(rest, strpos(rest, '/')) else '' end path from cut
),
hits as (
  select page_id, sum(case when weight = 2 then len(regexp_extract_all(u, '(?:^|[^a-z0-9])' || term || '(?:[^a-z0-9]|$)')) else 0 end)::bigint strict_hits,
    count(*) filter (weight = 1)::bigint soft_terms
  from split, terms where regexp_matches(u, '(?:^|[^a-z0-9])' || term || '(?:[^a-z0-9]|$)') group by 1
),
fitting as (
  select page_id, arg_max(rule, length(rule)) rule, arg_max(says, length(rule)) says from split, rules
  where (host = rule_host or suffix(host, '.' || rule_host)) and prefix(path, rule_path) group by 1
)
select page_id, host, path, rule, coalesce(says, case when strict_hits > 0 or soft_terms >= {url_filter.SOFT_LIMIT} then 'block' else 'allow' end) verdict,
  coalesce(strict_hits, 0)::bigint strict_hits, coalesce(soft_terms, 0)::bigint soft_terms
from split left join hits using (page_id) left join fitting using (page_id)
"""


@query("op2_bpe_round_trip")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digests(documents(spark, folder))


#: Every string of 100 bytes, as hex digits, with all its places; what is not first is removed.
REPEATS_SQL = """
with d as (select doc_id, hex(encode(coalesce(text, ''))) h, octet_length(encode(coalesce(text, ''))) n from documents),
places as (select doc_id, i, substr(h, 2 * i + 1, 200) w from (select doc_id, h, unnest(range(greatest(n - 99, 0))) i from d)),
later as (select doc_id, i from places qualify row_number() over (partition by w order by doc_id, i) > 1),
marked as (select doc_id, i, coalesce(i > lag(i) over o + 100, true) fresh from later window o as (partition by doc_id order by i)),
runs as (select doc_id, i, sum(fresh::int) over (partition by doc_id order by i) run from marked),
spans as (select doc_id, min(i) a, max(i) + 100 b from runs group by doc_id, run),
gaps as (
  select doc_id, coalesce(lag(b) over (partition by doc_id order by a), 0) a, a b from spans
  union all select doc_id, coalesce(e, 0), n from d left join (select doc_id, max(b) e from spans group by 1) using (doc_id)
),
kept as (select doc_id, string_agg(substr(h, 2 * a + 1, 2 * (b - a)), '' order by a) k from gaps join d using (doc_id) group by 1)
select doc_id, n::bigint n_bytes, coalesce(removed, 0)::bigint n_removed, coalesce(runs, 0)::bigint n_spans, sha256(unhex(k)) kept_sha256
from d join kept using (doc_id) left join (select doc_id, sum(b - a) removed, count(*) runs from spans group by 1) using (doc_id)
"""


@query("op3_suffix_dedup", REPEATS_SQL)
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.digests(documents(spark, folder))


@query("op4_url_filter", _url_sql())
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge_urls(spark.read.parquet(f"{folder}/pages.parquet"))


def _quality_sql(where: str = "") -> str:
    def fails(rule: tuple) -> str:
        value, factor, limit, other = rule
        return f"{value} * {factor} > {other} * {limit}"

    def policy(name: str) -> str:
        return " or ".join(f"({fails(quality.RULES[rule])})" for rule in quality.POLICIES[name])

    return rf"""
with w as (
  select doc_id, coalesce(text, '') t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') ws from documents
),
spread as (select doc_id, unnest(ws) word, generate_subscripts(ws, 1) i from w),
triples as (
  select doc_id, i, word a, lead(word, 1) over o b, lead(word, 2) over o c from spread window o as (partition by doc_id order by i)
),
windows as (select doc_id, i, count(*) over (partition by doc_id, a, b, c) n from triples where c is not null),
repeated as (
  select doc_id, count(distinct p) n_repeat_words from (select doc_id, unnest([i, i + 1, i + 2]) p from windows where n > 1) group by 1
),
lines as (
  select doc_id, count(*) n_lines, count(*) - count(distinct line) n_dup_lines
  from (select doc_id, unnest(string_split(t, chr(10))) line from w) where regexp_matches(line, '[^\x20\x09-\x0D]') group by 1
),
m as (
  select doc_id, len(ws)::bigint n_words, length(array_to_string(ws, ''))::bigint word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint n_symbols, coalesce(n_dup_lines, 0)::bigint n_dup_lines,
    coalesce(n_repeat_words, 0)::bigint n_repeat_words, coalesce(n_lines, 0) n_lines,
    length(regexp_replace(t, '[^!]', '', 'g')) n_marks, length(regexp_replace(t, '[^A-Z]', '', 'g')) n_upper
  from w left join repeated using (doc_id) left join lines using (doc_id)
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 or 100 * n_repeat_words > 50 * n_words base_failed, not ({policy("v2")}) kept
from m {where}
"""


@query("op5_quality_rules", _quality_sql())
def op5(spark: SparkSession, folder: str) -> DataFrame:
    rows = quality.ledger(documents(spark, folder))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~quality.passes("failed_bits", "base")).alias("base_failed"), quality.passes("failed_bits", "v2").alias("kept"),
    )


MIX_SQL = rf"""
with sized as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint size,
    ('0x' || substr(md5('{mixing.SEED}:' || coalesce(doc_id::varchar, md5(coalesce(text, '')))), 1, 8))::bigint / 4294967296.0 draw
  from documents
),
sizes as (
  select source, sum(size)::bigint source_size, [3.0, 1.0, 2.0][1 + (row_number() over (order by source nulls last) - 1) % 3]::double weight
  from sized group by 1
),
levels as (
  select *, (1.5::double * sum(source_size) over () - coalesce(sum(2.0::double * source_size) over (order by source_size / weight, source nulls last
      rows between unbounded preceding and 1 preceding), 0))
    / sum(weight) over (order by source_size / weight, source nulls last rows between current row and unbounded following) as level
  from sizes
),
targets as (
  select source, source_size, round(least(2.0::double * source_size, coalesce(max(case when level * weight <= 2.0 * source_size then level end) over ()
    * weight, 2.0::double * source_size)), 6) target from levels
),
rated as (select *, case when source_size > 0 then target / source_size else 0 end rate from targets)
select doc_id, size, source_size, target, (size * (floor(rate) + (draw < rate - floor(rate))::int))::bigint taken
from sized s join rated r on s.source is not distinct from r.source
"""


@query("op6_mix_sources", MIX_SQL)
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.plan(documents(spark, folder)).select("doc_id", "size", "source_size", "target", "taken")


@query("op7_language_id")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.identify(spark.read.parquet(f"{folder}/pages.parquet"), documents(spark, folder))


@query("op8_lm_scores")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return lm.score(documents(spark, folder))


@query("op9_multiset_fingerprints")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    found = multiset_hash.edited(documents(spark, folder))
    return found.select(
        "doc_id", "n_chars", F.sha2(F.col("edited_text").cast("binary"), 256).alias("edited_sha256"),
        multiset_hash.text_form("fingerprint").alias("fingerprint"),
        multiset_hash.text_form("edited_fingerprint").alias("edited_fingerprint"), "near_edited", "near_next",
    )


@query("op10_simhash_groups")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.components(documents(spark, folder)).select(
        "doc_id", simhash.hex_digits().alias("fingerprint"), "component_id"
    )


#: Of the words of a document about one in 31 loses a code point.
SLIPS = 31


#: CRC-32 by its polynomial, bit by bit; near words meet in the hole that a deleted code point leaves.
SPELLING_SQL = f"""
with recursive runs as (
  select doc_id, run, count(*) n from (
    select doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) run from documents
  ) where length(run) >= 7 group by 1, 2
),
coded as (select *, hex(encode(coalesce(doc_id::varchar, '') || ':' || run)) bytes from runs),
hashed as (
  select *, xor(4294967295::bigint, list_reduce(list_prepend(4294967295::bigint, list_transform(range(0, length(bytes), 2), lambda i: ('0x' || substr(bytes, i + 1, 2))::bigint)),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, bit: xor(x >> 1, 3988292384::bigint * (x & 1))))) h from coded
),
spelled as (
  select case when h % {SLIPS} = 0 then left(run, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) else run end word, n from hashed
),
words as materialized (select word, sum(n)::bigint n from spelled where length(word) >= 7 group by 1 having sum(n) >= 2),
holes as materialized (select word, n, i, left(word, i - 1) || '.' || substr(word, i + 1) hole, left(word, i - 1) || substr(word, i + 1) rest
  from (select word, n, unnest(range(1, length(word) + 1)) i from words)),
deleted as (select distinct h.word, h.n, w.word shorter, w.n shorter_n from holes h join words w on w.word = h.rest),
near as materialized (
  select x.word, y.word other, y.n from holes x join holes y on x.hole = y.hole and x.i = y.i and x.word <> y.word
  union all select word, shorter, shorter_n from deleted union all select shorter, word, n from deleted
),
best as (select word, count(*) n_near, max(n) most from near group by 1),
named as materialized (
  select w.word, w.n, coalesce(b.n_near, 0)::bigint n_near,
    case when b.most >= 10 * w.n then (select min(other) from near where near.word = w.word and near.n = b.most) end form, case when b.most >= 10 * w.n then b.most end form_n
  from words w left join best b using (word)
),
chain as (
  select word, word root, form following from named
  union all select c.word, c.following, f.form from chain c join named f on f.word = c.following
)
select word, form, root, n, n_near, form_n from named join (select word, root from chain where following is null) using (word)
"""


@query("op11_spelling_variants", SPELLING_SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.groups(spelling.vocabulary(documents(spark, folder), slips=SLIPS))


FILL_MIDDLE_SQL = """
with d as (
  select doc_id, coalesce(text, '') t, length(coalesce(text, ''))::bigint n, sha256('1:' || coalesce(doc_id::varchar, '')) h from documents
),
drawn as (
  select *, ('0x' || substr(h, 1, 8))::bigint % (n + 1) h1, ('0x' || substr(h, 9, 8))::bigint % (n + 1) h2,
    ('0x' || substr(h, 17, 8))::bigint % 100 h3, ('0x' || substr(h, 25, 8))::bigint % 100 h4 from d
),
cut as (
  select *, least(h1, h2) a, greatest(h1, h2) b,
    case when n = 0 or h3 >= 90 or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') then 'plain'
      when h4 < 20 then 'spm' else 'psm' end form from drawn
),
pieces as (select *, substr(t, 1, a) p, substr(t, a + 1, b - a) m, substr(t, b + 1) s from cut)
select doc_id, n, form, case when form <> 'plain' then a end prefix_chars, case when form <> 'plain' then b - a end middle_chars,
  sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m else '<S>' || s || '<P>' || p || '<M>' || m end) output_sha256,
  sha256(t) restored_sha256
from pieces
"""


@query("op12_fill_middle", FILL_MIDDLE_SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return fill_middle.digests(documents(spark, folder))


@query("op13_chat_windows")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    turns = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text")
    marked = F.lit("\\### Assistant: </turn> ok")
    role = F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit("assistant"))
    added = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), marked.alias("text"))
    return chat.digests(turns.unionByName(added))
