"""Language of web pages by Bayesian evidence fusion.

Four pieces of evidence are added as logarithms:

* the text: likelihood under byte trigrams of each language, counted over all labelled documents. Trigrams of a text depend on
  each other, so their sum is weighted down by ``TEMPER``;
* the language that the markup declares, as P(declared | language);
* the suffix of the address (``com``), as P(suffix | language);
* a prior for the host, smoothed hierarchically: the host's counts on top of ``STRENGTH`` times its domain's shares, those on top of
  ``STRENGTH`` times the shares of all pages.

The tables behind the last three are not given: they are sums of the languages' shares by text alone, grouped by what
is declared, suffix, host and domain, over all pages. A page's own shares are taken out of its host's and domain's
counts, so that it is no evidence for itself.

Sums are aggregated before they are shuffled, so a host with a third of all pages is one row. Pages meet their host's row
in a join of staged tables, which Spark can split.

Defined cases: a null html has no text and declares nothing; a null url, or one without ``://``, has an empty host and
suffix. What is declared counts up to the first hyphen, lower-cased. Ties go to the language that comes first. Repeated
rows are judged alike. Extra columns are not read. Empty pages give an empty result. Without labelled documents the
language is null. More than ``MOST_LANGUAGES`` labels raise an error, as the tables would no longer be small.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

from atlaslex.llm.batches import LOWER_CASE, arrow_function, cut, text_bytes
from atlaslex.llm.url_filter import split_url
from atlaslex.staging import stage

GRAM_BITS = 15
TEMPER = 0.1
STRENGTH = 5.0
SMOOTH = 0.5
MOST_LANGUAGES = 500

#: Where something that is no text may begin, and how it ends: scripts and styles, comments, tags, and entities.
MARK = re.compile(rb"[<&]")
UNSEEN = re.compile(rb"<(script|style)\b", re.IGNORECASE)
UNSEEN_END = {name: re.compile(rb"</" + name + rb"\s*+>", re.IGNORECASE) for name in (b"script", b"style")}
COMMENT, COMMENT_END, TAG_END = b"<!--", b"-->", b">"
ENTITY = re.compile(rb"&#?+\w++;")
#: The tag, and what stands in it: neither goes back over what it has read, so a page of any length is read once.
HTML_TAG = re.compile(rb"<html\b[^>]*+", re.IGNORECASE)
DECLARED = re.compile(rb"\slang\s*+=\s*+[\"']?+\s*+([A-Za-z]+)", re.IGNORECASE)


def grams(text: bytes) -> np.ndarray:
    """Hashed byte trigrams of a text; A-Z count as a-z."""
    raw = np.frombuffer(text.translate(LOWER_CASE), dtype=np.uint8).astype(np.uint32)
    if len(raw) < 3:
        return raw[:0]
    whole = (raw[:-2] << np.uint32(16)) | (raw[1:-1] << np.uint32(8)) | raw[2:]
    return (whole * np.uint32(2654435761)) >> np.uint32(32 - GRAM_BITS)


def visible(html: bytes) -> bytes:
    """The text of a page: scripts, styles, comments, tags and entities are one blank each; what is not closed is text.

    An end that is missing from one place on is missing from all later places: it is looked for once, so pages of unclosed marks
    are read in linear time.
    """
    out, at, missing = [], 0, set()

    def end_of(kind: bytes, start: int) -> int:
        """Where what began ends; 0 if it does not."""
        if kind in missing:
            return 0
        if kind in UNSEEN_END:
            found = UNSEEN_END[kind].search(html, start)
            found = found.end() if found else 0
        else:
            found = html.find(kind, start)
            found = found + len(kind) if found >= 0 else 0
        if not found:
            missing.add(kind)
        return found

    mark = MARK.search(html)
    while mark:
        start, end = mark.start(), 0
        if mark[0] == b"&":
            entity = ENTITY.match(html, start)
            end = entity.end() if entity else 0
        else:
            unseen = UNSEEN.match(html, start)
            if unseen:
                end = end_of(unseen[1].lower(), unseen.end())
            if not end and html.startswith(COMMENT, start):
                end = end_of(COMMENT_END, start + len(COMMENT))
            if not end:
                end = end_of(TAG_END, start + 1)
        if end:
            out += (html[at:start], b" ")
            at = end
        mark = MARK.search(html, max(at, start + 1))
    return b"".join([*out, html[at:]])


def declared_language(html: bytes) -> str:
    """The language of the first ``<html>`` tag that declares one, wherever it stands; empty if none does."""
    for tag in HTML_TAG.finditer(html):
        if found := DECLARED.search(tag[0]):
            return found[1].decode().lower()
    return ""


def _count(batches):
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
            held = counts.setdefault(lang, np.zeros(1 << GRAM_BITS, dtype=np.int64))
            held += np.bincount(grams(text.as_py()), minlength=1 << GRAM_BITS)
        if len(counts) > MOST_LANGUAGES:
            raise ValueError(f"more than {MOST_LANGUAGES} languages")
    for lang, held in counts.items():
        place = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(place)), pa.array(place), pa.array(held[place])], names=["lang", "gram", "n"])


def text_model(labelled: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages and the log-probabilities of their trigrams, from ``lang`` and ``text`` of all labelled documents."""
    rows = labelled.where("lang is not null").select("lang", text_bytes().alias("text"))
    counted = rows.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counted = stage(counted, "trigrams")
    languages = sorted(row["lang"] for row in counted.select("lang").distinct().limit(MOST_LANGUAGES + 1).collect())
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    counts = np.full((len(languages), 1 << GRAM_BITS), SMOOTH)
    number = {lang: i for i, lang in enumerate(languages)}
    for batch in counted.toArrow().to_batches():
        of = [number[lang] for lang in batch.column("lang").to_pylist()]
        counts[of, batch.column("gram").to_numpy()] += batch.column("n").to_numpy()
    return languages, np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)


EVIDENCE = StructType(
    [StructField(n, StringType()) for n in ("host", "domain", "suffix", "declared")] + [StructField("likelihood", ArrayType(DoubleType()))]
)


def _evidence(shared):
    """(html, url) -> host, domain, suffix, what is declared, and the weighted log-likelihoods of the languages."""
    kind = pa.struct([(n, pa.string()) for n in ("host", "domain", "suffix", "declared")] + [("likelihood", pa.list_(pa.float64()))])

    def part(pages: pa.Array, urls: pa.Array) -> pa.Array:
        model = shared.value
        out = {field.name: [] for field in kind}
        for html, url in zip(pages, urls, strict=True):
            html = html.as_py()
            host, _ = split_url(url.as_py().decode())
            labels = host.rsplit(".", 2)
            found = grams(visible(html))
            values = (host, ".".join(labels[-2:]), labels[-1], declared_language(html))
            for name, value in zip(out, values, strict=False):
                out[name].append(value)
            out["likelihood"].append((TEMPER * model[:, found].sum(axis=1, dtype=np.float64)).tolist())
        return pa.StructArray.from_arrays([pa.array(out[f.name], f.type) for f in kind], fields=list(kind))

    def run(pages: pa.Array, urls: pa.Array) -> pa.Array:
        ranges = cut(pa.compute.binary_length(pages).to_pylist())
        return pa.concat_arrays([pa.array([], kind), *(part(pages.slice(a, b - a), urls.slice(a, b - a)) for a, b in ranges)])

    return arrow_function(run, EVIDENCE)


def _shares(logs: Column) -> Column:
    """Shares that add up to one from an array of logarithms."""
    powers = F.transform(logs, lambda v: F.exp(v - F.array_max(logs)))
    total = F.aggregate(powers, F.lit(0.0), lambda a, b: a + b)
    return F.transform(powers, lambda v: v / total)


def _sums(pages: DataFrame, key: str | None, name: str, number: int) -> DataFrame:
    """The shares of all pages with a key, added up by language."""
    sums = [F.sum(F.get("text_shares", i)).alias(f"s{i}") for i in range(number)]
    grouped = pages.groupBy(*([key] if key else [])).agg(*sums)
    listed = F.array(*(F.coalesce(f"s{i}", F.lit(0.0)) for i in range(number))).alias(name)
    return stage(grouped.select(*([key] if key else []), listed), name)


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, b: a + b)


def _given(counts: str, everything: list[float]) -> Column:
    """log P(value | language) from the shares under one value and those of all pages."""
    whole = F.array(*(F.lit(v) for v in everything))
    return F.zip_with(F.col(counts), whole, lambda n, total: F.log((n + SMOOTH) / (total + 1)))


def _prior(everything: list[float]) -> Column:
    """log P(language | host), without the page's own shares."""
    total = sum(everything)
    shares = [(v + SMOOTH) / (total + SMOOTH * len(everything)) for v in everything]
    domain = F.zip_with("of_domain", "text_shares", lambda n, own: F.greatest(n - own, F.lit(0.0)))
    host = F.zip_with("of_host", "text_shares", lambda n, own: F.greatest(n - own, F.lit(0.0)))
    above = F.zip_with(domain, F.array(*(F.lit(v) for v in shares)), lambda n, p: (n + STRENGTH * p) / (_total(domain) + STRENGTH))
    return F.transform(F.zip_with(host, above, lambda n, p: (n + STRENGTH * p) / (_total(host) + STRENGTH)), lambda v: F.log(v))


def identify(pages: DataFrame, labelled: DataFrame) -> DataFrame:
    """``page_id``, ``lang``, ``confidence`` (its share), ``text_lang`` (by text alone), ``declared``, ``host`` and ``suffix``.

    ``pages`` has ``page_id``, ``url`` and ``html``; ``labelled`` has ``text`` and ``lang``.
    """
    languages, model = text_model(labelled)
    shared = pages.sparkSession.sparkContext.broadcast(model)
    found = pages.select("page_id", _evidence(shared)(text_bytes("html"), text_bytes("url")).alias("e")).select("page_id", "e.*")
    if not languages:
        nothing = F.lit(None).cast("string")
        return found.select("page_id", nothing.alias("lang"), F.lit(None).cast("double").alias("confidence"), nothing.alias("text_lang"), "declared", "host", "suffix")
    rows = stage(found.withColumn("text_shares", _shares(F.col("likelihood"))), "evidence")
    number = len(languages)
    everything = _sums(rows, None, "of_all", number).first()["of_all"]
    for key in ("declared", "suffix", "domain", "host"):
        rows = rows.join(_sums(rows, key, f"of_{key}", number), key)
    added = F.col("likelihood")
    for evidence in (_given("of_declared", everything), _given("of_suffix", everything), _prior(everything)):
        added = F.zip_with(added, evidence, lambda a, b: a + b)
    named = F.array(*map(F.lit, languages))

    def best(values: str) -> Column:
        return F.get(named, (F.array_position(values, F.array_max(values)) - 1).cast("int"))

    return rows.withColumn("shares", _shares(added)).select(
        "page_id", best("shares").alias("lang"), F.round(F.array_max("shares"), 9).alias("confidence"),
        best("text_shares").alias("text_lang"), "declared", "host", "suffix",
    )
