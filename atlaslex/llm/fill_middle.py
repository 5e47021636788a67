r"""Fill-in-the-middle: texts cut at two places and written in the order prefix, suffix, middle or suffix, prefix, middle.

Places come from a hash of ``doc_id``, so every run cuts alike. ``regexp_count`` tells how many code points a text has. Every row
then has its own pattern of counted possessive groups, ``(.{a}+)(.{b-a}+)(.*+)``: one match takes prefix, middle and suffix,
and the replacement writes them in the order of the row's form. Possessive quantifiers over one character loop
without going back or recursion, so texts may have any length.

A count of every code point by itself would make an array of as many strings. Blocks of ``BLOCK`` are counted first,
then the code points of the rest.

``restored`` makes the text from output and form again, by the three markers. Markers may not begin with what one of them
ends with; a text that holds one stays plain. So each marker stands in an output exactly once.

All of it are DataFrame functions in the row: no shuffle, no Python worker; memory follows the longest text.

Defined cases: a null text is an empty one; empty texts stay plain. A null ``doc_id`` writes as nothing in the hash. Rows with
equal ``doc_id`` and text come out alike, each of them. Other columns pass through, except that ``units``, ``form``,
``prefix_chars``, ``middle_chars`` and ``output`` take the place of columns with these names. An empty table gives an empty result.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atlaslex.llm.batches import unused

MARKERS = ("<P>", "<S>", "<M>")
SEED, RATE, SPM = 1, 90, 20
BLOCK = 1024

PLAIN, PSM, SPM_FORM = "plain", "psm", "spm"


def code_points(text: Column) -> Column:
    """How many code points a text has."""
    rest = F.regexp_extract(text, rf"(?s)\A(?:.{{{BLOCK}}}+)*+(.*+)\z", 1)
    return (F.regexp_count(text, F.lit(f"(?s).{{{BLOCK}}}+")) * BLOCK + F.regexp_count(rest, F.lit("(?s)."))).cast("long")


def draws(seed: int, doc_id: Column) -> list[Column]:
    """Four numbers of 32 bits."""
    digits = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digits, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def _checked(markers: tuple[str, str, str]) -> tuple[str, str, str]:
    ends = [m[-i:] for m in markers for i in range(1, len(m))]
    if len(set(markers)) < 3 or "" in markers or any(m.startswith(e) for m in markers for e in ends) or any(a != b and a in b for a in markers for b in markers):
        raise ValueError(f"{markers}: markers overlap")
    return markers


def _literal(text: str) -> str:
    """A text as it stands in a replacement."""
    return re.sub(r"([\\$])", r"\\\1", text)


def transform(
    docs: DataFrame, rate: int = RATE, spm: int = SPM, seed: int = SEED, markers: tuple[str, str, str] = MARKERS, text: str = "text"
) -> DataFrame:
    """Adds ``units`` (code points), ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    ``rate`` of 100 texts are cut; ``spm`` of 100 of these begin with the suffix, the others with the prefix.
    """
    begin, behind, between = _checked(markers)
    whole = F.coalesce(F.col(text), F.lit(""))
    own = [c for c in docs.columns if c.lower() not in ("units", "form", "prefix_chars", "middle_chars", "output")]
    (drawn,) = unused(docs, "drawn")
    counted = docs.select(*own, code_points(whole).alias("units"), F.array(*draws(seed, F.col("doc_id"))).alias(drawn))
    h1, h2, h3, h4 = (F.col(drawn)[i] for i in range(4))
    plain = (F.col("units") == 0) | (h3 % 100 >= rate)
    for marker in markers:
        plain = plain | F.contains(whole, F.lit(marker))
    form = F.when(plain, F.lit(PLAIN)).when(h4 % 100 < spm, F.lit(SPM_FORM)).otherwise(F.lit(PSM))
    places = F.col("units") + 1
    a, b = F.least(h1 % places, h2 % places), F.greatest(h1 % places, h2 % places)
    cut = counted.select(*own, "units", form.alias("form"), a.alias("prefix_chars"), (b - a).alias("middle_chars"))
    groups = F.concat(F.lit(r"(?s)\A(.{"), F.col("prefix_chars"), F.lit("}+)(.{"), F.col("middle_chars"), F.lit(r"}+)(.*+)\z"))
    order = F.when(F.col("form") == PSM, F.lit(f"{_literal(begin)}$1{_literal(behind)}$3{_literal(between)}$2")).otherwise(
        F.lit(f"{_literal(behind)}$3{_literal(begin)}$1{_literal(between)}$2")
    )
    uncut = F.col("form") == PLAIN
    return cut.select(
        *own, "units", "form", F.when(~uncut, F.col("prefix_chars")).alias("prefix_chars"),
        F.when(~uncut, F.col("middle_chars")).alias("middle_chars"),
        F.when(uncut, whole).otherwise(F.regexp_replace(whole, groups, order)).alias("output"),
    )


def restored(output: Column, form: Column, markers: tuple[str, str, str] = MARKERS) -> Column:
    """The text of an output of ``transform``."""
    begin, behind, between = (re.sub(r"([^\w\s])", r"\\\1", m) for m in _checked(markers))
    psm = form == PSM
    found = F.when(psm, F.lit(rf"(?s)\A{begin}(.*?){behind}(.*?){between}(.*+)\z")).otherwise(F.lit(rf"(?s)\A{behind}(.*?){begin}(.*?){between}(.*+)\z"))
    order = F.when(psm, F.lit("$1$3$2")).otherwise(F.lit("$2$3$1"))
    return F.when(form == PLAIN, output).otherwise(F.regexp_replace(output, found, order))


def digests(docs: DataFrame) -> DataFrame:
    """``doc_id``, sizes, and the SHA-256 of outputs and of the texts made from them again."""
    rows = transform(docs.select("doc_id", "text"))
    return rows.select(
        "doc_id", F.col("units").alias("n"), "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"),
    )
