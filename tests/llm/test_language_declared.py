"""The text and the declared language of pages."""

import math
import random
import re
import time
from collections import defaultdict

from atlaslex.llm import language_id, queries

HIDDEN = re.compile(rb"<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&#?\w+;", re.DOTALL | re.IGNORECASE)

FIRST = re.compile(rb"<html\b[^>]*?\slang\s*=\s*[\"']?\s*([A-Za-z]+)", re.IGNORECASE)


def test_late_tags_declare_their_language(spark):
    head = "<!-- licence banner " + "x" * 5000 + " -->\n" + " " * 4096
    labelled = spark.createDataFrame([("en", "the house and the garden"), ("de", "das haus und der garten")], "lang string, text string")
    pages = spark.createDataFrame([(1, "http://a.com/", f'{head}<html lang="de"><p>x'), (2, "http://a.com/", f"{head}<html><p>x")], "page_id long, url string, html string")
    assert {r.page_id: r.declared for r in language_id.identify(pages, labelled).collect()} == {1: "de", 2: ""}


def test_declared_languages_by_one_expression():
    tags = [b"<html>", b"<html lang=en-GB>", b"<html class='a' LANG = \" fr\">", b"<htmlx lang=it>", b"<html xml:lang='es'>", b"<html <html lang=pt>", b"<html lang=>", b"<html lang"]
    for first in tags:
        for second in tags:
            html = first + b"y" * 5000 + second
            found = FIRST.search(html)
            assert language_id.declared_language(html) == (found[1].decode().lower() if found else "")


def test_time_is_linear():
    began = time.process_time()
    assert language_id.declared_language(b"<html " * 500_000) == ""
    assert language_id.declared_language(b"<html lang=" + b" " * 3_000_000) == ""
    assert time.process_time() - began < 5


def test_visible_text_by_one_expression():
    rng = random.Random(5)
    pieces = [b"<", b">", b"<script", b"<SCRIPT>", b"</script>", b"</Script  >", b"</script ", b"<style x>", b"</style>", b"<!--", b"-->", b"--", b"&amp;", b"&#12", b";", b"& ",
              b"<scripts>", b"word ", b"\xc3\xa9", b"\n", b"<p class='a'>", b"</p>", b"<!-", b">", b"&x"]
    for _ in range(6000):
        html = b"".join(rng.choices(pieces, k=rng.randint(0, 25)))
        assert language_id.visible(html) == HIDDEN.sub(b" ", html)


def test_pages_of_unclosed_marks():
    began = time.process_time()
    for mark in (b"<!--", b"<script>", b"<style ", b"<", b"&", b"&#", b"<script></script", b"</script   ", b"<!--<script><style>&a"):
        page = mark * (2_000_000 // len(mark))
        assert len(language_id.visible(page)) <= len(page)
    assert time.process_time() - began < 60


def test_query_by_a_plain_twin(spark):
    """All columns of all pages, with dictionaries and loops in the place of tables and joins."""
    folder = "/root/testdata/sf0.001"
    labelled = [(r.lang, (r.text or "").encode()) for r in queries.documents(spark, folder).collect() if r.lang is not None]
    pages = spark.read.parquet(f"{folder}/pages.parquet").collect()
    languages = sorted({lang for lang, _ in labelled})
    size = 1 << language_id.GRAM_BITS
    counts = {lang: [language_id.SMOOTH] * size for lang in languages}
    for lang, text in labelled:
        for g in language_id.grams(text).tolist():
            counts[lang][g] += 1
    logs = {lang: [math.log(n / sum_) for n in c] for lang, c in counts.items() for sum_ in [sum(c)]}

    def shares(values):
        powers = [math.exp(v - max(values)) for v in values]
        return [p / sum(powers) for p in powers]

    rows = []
    for page in pages:
        html, url = (page.html or "").encode(), page.url or ""
        host = re.split("[/?#]", url.split("://", 1)[1])[0].lower() if "://" in url else ""
        found = FIRST.search(html)
        text = [language_id.TEMPER * sum(logs[lang][g] for g in language_id.grams(HIDDEN.sub(b" ", html)).tolist()) for lang in languages]
        keys = {"declared": found[1].decode().lower() if found else "", "suffix": host.split(".")[-1], "domain": ".".join(host.split(".")[-2:]), "host": host}
        rows.append((page.page_id, text, shares(text), keys))
    sums = defaultdict(lambda: [0.0] * len(languages))
    for _, _, own, keys in rows:
        for key in [("all", ""), *keys.items()]:
            sums[key] = [a + b for a, b in zip(sums[key], own, strict=True)]
    everything = sums["all", ""]
    flat = [(v + language_id.SMOOTH) / (sum(everything) + language_id.SMOOTH * len(languages)) for v in everything]
    expected = {}
    for page_id, text, own, keys in rows:
        prior = flat
        for key in ("domain", "host"):
            others = [max(n - o, 0.0) for n, o in zip(sums[key, keys[key]], own, strict=True)]
            prior = [(n + language_id.STRENGTH * p) / (sum(others) + language_id.STRENGTH) for n, p in zip(others, prior, strict=True)]
        total = [t + math.log(p) for t, p in zip(text, prior, strict=True)]
        for key in ("declared", "suffix"):
            total = [v + math.log((n + language_id.SMOOTH) / (a + 1)) for v, n, a in zip(total, sums[key, keys[key]], everything, strict=True)]
        fused = shares(total)
        expected[page_id] = (languages[fused.index(max(fused))], max(fused), languages[own.index(max(own))], keys["declared"], keys["host"], keys["suffix"])
    found = {r.page_id: r for r in queries.QUERIES["op7_language_id"](spark, folder).collect()}
    assert found.keys() == expected.keys()
    for page_id, (lang, confidence, text_lang, declared, host, suffix) in expected.items():
        row = found[page_id]
        assert (row.lang, row.text_lang, row.declared, row.host, row.suffix) == (lang, text_lang, declared, host, suffix)
        assert abs(row.confidence - confidence) < 1e-4
