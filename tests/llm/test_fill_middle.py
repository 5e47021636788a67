"""Fill-in-the-middle: outputs by brute force, exact round trips. The query has SQL."""

import hashlib

import pytest
from atlaslex.llm import fill_middle
from pyspark.sql import functions as F


def brute(doc_id, text, rate=90, spm=20):
    text = text or ""
    digits = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digits[8 * i : 8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (len(text) + 1), h2 % (len(text) + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return len(text), "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    if h4 % 100 < spm:
        return len(text), "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return len(text), "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def test_messy_rows(spark, messy, nothing):
    odd = ["<P", "<", "a<S>b", "<S<S<M", "\U0001f600" * 3000 + "é中$1\\", "a\U0001f600" * 2000, "\r\n \x00", "$1$2\\E", "é" * 1024]
    more = spark.createDataFrame([(100 * i + j, text) for i in range(12) for j, text in enumerate(odd)], "doc_id long, text string")
    docs = messy.withColumns({c: F.lit("x") for c in ("units", "form", "output")}).unionByName(more, allowMissingColumns=True)
    found = fill_middle.transform(docs).withColumn("again", fill_middle.restored(F.col("output"), F.col("form"))).collect()
    assert len(found) == docs.count() and {r.form for r in found} == {"plain", "psm", "spm"}
    for r in found:
        assert (r.units, r.form, r.prefix_chars, r.middle_chars, r.output) == brute(r.doc_id, r.text)
        assert r.again == (r.text or "")
    assert fill_middle.transform(docs).columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
    assert fill_middle.digests(nothing).count() == 0


def test_rates(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("some text").alias("text"))
    forms = {r.form: r["count"] for r in fill_middle.transform(docs, rate=50, spm=50).groupBy("form").count().collect()}
    assert all(abs(forms[form] - share) < 150 for form, share in (("plain", 2000), ("psm", 1000), ("spm", 1000)))
    assert fill_middle.transform(docs, rate=0).where("form <> 'plain'").isEmpty()


def test_a_very_long_text(spark):
    docs = spark.range(4).select((F.col("id") + 3).alias("doc_id"), F.expr("concat(repeat('é\U0001f600x', 2000000), id)").alias("text"))
    row = fill_middle.digests(docs).collect()
    for r in row:
        text = "é\U0001f600x" * 2_000_000 + str(r.doc_id - 3)
        _, form, a, m, output = brute(r.doc_id, text)
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == (len(text), form, a, m)
        assert r.output_sha256 == hashlib.sha256(output.encode()).hexdigest()
        assert r.restored_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_other_markers(spark):
    markers = ("[$1", "(\\E", "{M}")
    docs = spark.range(30).select(F.col("id").alias("doc_id"), F.lit("[$ (\\ {M $1").alias("text"))
    rows = fill_middle.transform(docs, rate=100, markers=markers)
    again = rows.withColumn("again", fill_middle.restored(F.col("output"), F.col("form"), markers)).collect()
    assert all(r.again == r.text and r.form != "plain" for r in again)
    for overlapping in (("<P>", "<P>", "<M>"), ("ab", "ca", "x"), ("<P>", "<", "<M>")):
        with pytest.raises(ValueError, match="overlap"):
            fill_middle.transform(docs, markers=overlapping)
