"""Markup and words: hand-made cases, and random texts against a plain character scan."""

import random

import pytest
from pyspark.sql import functions as F

from atlaslex.functions.markup import BLOCK, strip_markup
from atlaslex.functions.words import TEXTS_AT_ONCE, capitalized, code_points, word_bag, word_counts, words
from atlaslex.plans import clusters, labels, places, significance
from atlaslex.staging import stage

MARKUP = [
    ("a {{b|c}} d [[X|y]] (z)", "a  d X y z"),
    ("{{{a}}}b", "b"),
    ("x<ref>y</ref>z", "xz"),
    ("x<br>y<b/>z", "xz"),
    ("x<br />y", "xy"),
    ("}} a > b", " a  b"),
    ("{{a>b}}c", "bc"),
    ("x<div><b>q</b>w</div>e", "xwe"),
    ("p ==H== q\n==See also==\nr", "p   H   q\n"),
    ("a }b{ c", "a b c"),
    ("a/>b </> c", "a/b  c"),
    ("=''See also''= ==''See also''== gone", " See also  "),
    ("", ""),
    (None, ""),
]


def scan(text):
    """Plain text by walking over the characters, for comparison."""
    depth, in_tag, out = 0, False, []
    padded = "\0" + text + "\0"
    for at in range(1, len(padded) - 1):
        before, char, after = padded[at - 1 : at + 2]
        if depth == 0 and not in_tag and char not in "{}[]()'<>":
            out.append(" " if char == "|" else char)
        if char == after == "{":
            depth += 1
        elif char == after == "}" or char == ">":
            depth = max(depth - 1, 0)
            in_tag = in_tag and not (char == ">" and before == "/")
        elif char == "<":
            depth += 1
            in_tag = after != "/"
    return "".join(out).partition("==See also==")[0].replace("=", " ")


def column(spark, texts, expression):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return [r[1] for r in sorted(rows.select("i", expression(F.col("t"))).collect())]


def test_markup_cases(spark):
    assert column(spark, [m[0] for m in MARKUP], strip_markup) == [m[1] for m in MARKUP]


def test_markup_random(spark):
    rng = random.Random(1)
    pieces = ["{", "{{", "}}", "}", "<", "</", "/>", ">", "/", "|", "[", "a", "é ", "==See also==", "=", "'"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 60))) for _ in range(600)]
    # Longer than a block of pieces, and much longer.
    texts += ["".join(rng.choice(pieces[:12]) for _ in range(n)) for n in (BLOCK, BLOCK * 3 + 1, 20_000)]
    assert column(spark, texts, strip_markup) == [scan(t) for t in texts]


WORDS = [
    ("I cannot go", ["i", "can", "not", "go"]),
    ("gonna gimme,lemme; gotta wanna", ["gon", "na", "gim", "me", "lem", "me", "got", "ta", "wan", "na"]),
    ("cannots xcannot écannot cannoté _cannot", ["cannots", "xcannot", "écannot", "cannoté", "_cannot"]),
    ("  A-b, C_d 9½ ", ["a", "b", "c_d", "9½"]),
    ("", []),
    (None, []),
]


def test_words(spark):
    assert column(spark, [w[0] for w in WORDS], words) == [w[1] for w in WORDS]


def test_word_counts(spark):
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["a", "B", "c d", "", "é", "cannot"]) for _ in range(rng.randint(0, 50))) for _ in range(200)]
    counted = column(spark, texts, word_counts)
    listed = column(spark, texts, words)
    for pairs, tokens in zip(counted, listed):
        assert dict(pairs) == {w: tokens.count(w) for w in set(tokens)}
        assert len(pairs) == len(set(tokens))


def test_small_functions(spark):
    assert column(spark, ["seattle", "nEW", "ßa", "éa", ""], capitalized) == ["Seattle", "New", "Ssa", "Éa", ""]
    assert sorted(column(spark, ["a😀ba"], code_points)[0]) == ["a", "b", "😀"]


def pages(spark, texts):
    return spark.createDataFrame([(i, f"T{i}", t) for i, t in enumerate(texts)], "page_id long, title string, text string")


def test_scores(spark):
    texts = ["rare rare rare often often often"] + ["often other"] * 11
    best = significance.significant_words_of_pages(pages(spark, texts))
    found = {(r.page_id, r.word): (r.tf, r.df, r.tf_idf) for r in best.collect()}
    assert found[0, "often"] == (3, 12, 0.25)
    assert found[0, "rare"] == (3, -1, -3.0)
    assert found[1, "other"] == (1, 11, 1 / 11)


def test_top_words_ties_by_word(spark):
    best = significance.significant_words_of_pages(pages(spark, ["b a d c"]), n=2)
    assert sorted(r.word for r in best.collect()) == ["a", "b"]


@pytest.mark.parametrize("limit", [0, 10**9])
def test_frequency_lookup_both_ways(spark, limit):
    counts = significance.term_counts(pages(spark, ["x y"] * 30 + ["x z"] * 5 + ["x"] * 100)).cache()
    looked_up = significance.with_doc_freq(counts, significance.doc_freq(counts).cache(), limit=limit)
    assert {(r.word, r.df) for r in looked_up.collect()} == {("x", 135), ("y", 30), ("z", -1)}
    assert looked_up.count() == counts.count()


def test_word_bags_are_word_counts(spark):
    """Texts counted together keep their words apart, without words, at the ends of a batch and beyond it."""
    rng = random.Random(5)
    texts = [None, "", " - ", "a", "\u00c9t\u00e9 \u00e9T\u00c9", "gonna cannot x_1 \u0663", "\U00020000 \u0130"]
    texts += [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 20))) for _ in range(2 * TEXTS_AT_ONCE + 3)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").coalesce(1)
    rows = df.select("i", word_bag(F.col("text")).alias("bag"), word_counts(F.col("text")).alias("counts")).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert len(r.bag.words) == len(set(r.bag.words))
        assert dict(zip(r.bag.words, r.bag.tfs, strict=True)) == {c.word: c.tf for c in r.counts}


def test_pages_are_ranked_where_they_lie(spark):
    """no word of a page goes through a shuffle or a window on its way to the best words."""
    bags = stage(significance.page_bags(pages(spark, ["x y z"] * 30)), "bags")
    best = significance.best_of_pages(bags, stage(significance.doc_freq(significance.words_of_bags(bags)), "df"), 2)
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan
    assert sorted(b.word for r in best.collect() for b in r.best) == ["x"] * 30 + ["y"] * 30


@pytest.mark.parametrize("limit", [0, 10**9])
def test_best_of_pages_is_the_ranking_of_rows(spark, limit):
    """Pages whose id comes again or is missing share their best words, and ties go by word."""
    rng = random.Random(9)
    texts = [" ".join(rng.choice("abcdefghijklmnopqrstuvwxyz\u00e4\u00f6\u00fc") * rng.randint(1, 2) for _ in range(rng.randint(0, 40))) for _ in range(80)]
    keys = [None, None, 7, 7, 7, *range(100, 175)]
    df = spark.createDataFrame([(k, f"T{k}", t) for k, t in zip(keys, texts, strict=True)], "page_id long, title string, text string")
    counts = stage(significance.term_counts(df), "counts")
    rows = significance.significant_words(counts, stage(significance.doc_freq(counts), "df"), 6)
    bags = stage(significance.page_bags(df), "bags")
    best = significance.best_of_pages(bags, stage(significance.doc_freq(significance.words_of_bags(bags)), "df"), 6, limit=limit)
    assert sorted(map(str, significance.words_of_pages(best).collect())) == sorted(map(str, rows.collect()))


def test_words_looked_up_by_frequency(spark):
    """Frequent and rare words find the same dictionary words as in one look-up."""
    words = spark.createDataFrame([(i, f"w{i % 7}", 20 if i % 7 < 4 else -1, 1.0 if i else 91.0, 2.0) for i in range(30)], "page_id int, word string, df long, lat double, lon double")
    known = spark.createDataFrame([("w0", 20), ("w2", 11), ("w5", 10), ("w6", 1), ("w9", 30)], "word string, df long")
    found = clusters.mappable_by_frequency(words, known, 10)
    assert sorted(found.collect()) == sorted(clusters.mappable_words(words, known.select("word")).select(*found.columns).collect())


def test_cluster_means_are_centers(spark):
    """centers alone need no sums per word, so every task sends a row per cluster."""
    rows = [(w, i % 3, 0.5 * i, float(-i)) for i in range(40) for w in (f"w{i % 5}", None)]
    zoomed = spark.createDataFrame(rows, "word string, cluster int, lat double, lon double").selectExpr("'7' as zoom", "*", "1.0d as tf_idf")
    means = labels.cluster_means(zoomed)
    assert "word" not in means._jdf.queryExecution().optimizedPlan().toString().split("LogicalRDD")[0]
    found, expected = ({(r.zoom, r.cluster): (round(r.lat, 9), round(r.lon, 9)) for r in df.collect()} for df in (means, labels.centers(labels.word_stats(zoomed))))
    assert found == expected and len(found) == 3


def test_placed_pages_give_the_words_of_places(spark):
    """A page with two positions lists its words at both."""
    best = spark.createDataFrame([(1, "T", [("a", 2, 20, 0.1), ("b", 1, -1, -1.0)]), (2, "U", [])], "page_id long, article string, best array<struct<word:string,tf:bigint,df:bigint,tf_idf:double>>")
    coords = spark.createDataFrame([(1, 1.0, 2.0), (1, 3.0, 4.0), (2, 0.0, 0.0), (3, 0.0, 0.0)], "page_id long, lat double, lon double")
    rows = places.geo_words(significance.words_of_pages(best), coords)
    found = places.words_of_places(places.geo_pages_words(best, coords))
    assert found.columns == rows.columns and sorted(found.collect()) == sorted(rows.collect()) and found.count() == 4


def clustered_rows(spark):
    """Words of two zoom levels: ties, words once in a cluster, missing words and clusters, a cluster of few words."""
    rng = random.Random(11)
    rows = [(rng.choice([None, *(f"w{k}" for k in range(400))]), rng.choice([-1.0, 0.25, 0.5, 2.0]), rng.choice([0, 1, 2]), rng.choice([None, *range(20)]), float(i % 90), float(-i % 170)) for i in range(6000)]
    rows += [("b", 0.5, 3, 77, 1.0, 2.0), ("a", 0.5, 3, 77, 3.0, 2.0)]
    return spark.createDataFrame(rows, "word string, tf_idf double, cluster_7 int, cluster_193 int, lat double, lon double")


def test_best_scored_are_ranked_words(spark):
    """the words of a cluster are bounded, not sorted: few rows are left for the ranking, and it is the same."""
    clustered, zooms = clustered_rows(spark), ("7", "193")
    scores = stage(labels.word_scores(clustered, zooms), "scores")
    left = labels.leading_by_bound(scores, ["zoom", "cluster"], "score", "word", 6)
    for n in (1, 6, 40):
        ranked = labels.ranked_words(labels.word_stats(labels.by_zoom(clustered, zooms)), n).select("zoom", "cluster", "word", "score", "rank")
        assert sorted(labels.best_scored(scores, n).select(*ranked.columns).collect()) == sorted(ranked.collect())
    assert left.count() < scores.count() / 5


def test_labels_need_no_coordinates_per_word(spark, monkeypatch):
    """what is added up and stored per word and zoom level has no coordinates; centers are those of the sums."""
    clustered, zooms, stored = clustered_rows(spark), ("7", "193"), []
    monkeypatch.setattr(labels, "stage", lambda df, name: stored.append(df.columns) or stage(df, name))
    found = labels.label_clusters(clustered, zooms).collect()
    assert stored and not any("lat" in c for columns in stored for c in columns)
    middle = {(r.zoom, r.cluster): (round(r.lat, 9), round(r.lon, 9)) for r in labels.centers(labels.word_stats(labels.by_zoom(clustered, zooms))).collect()}
    assert {(r.zoom, r.cluster): (round(r.lat, 9), round(r.lon, 9)) for r in found} == middle


def test_characters_between_words(spark):
    """F8: ASCII is told apart by its bytes, other characters by Spark: both as ``word_counts`` does."""
    texts = [f"a{chr(c)}b {chr(c)}{chr(c)}" for c in range(1, 0x3100)] + ["".join(map(chr, range(128))), "x\u00a0y \u2014 z\u00e9-\u00e9!"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    rows = df.select(word_bag(F.col("text")).alias("bag"), word_counts(F.col("text")).alias("counts")).collect()
    assert all(dict(zip(r.bag.words, r.bag.tfs, strict=True)) == {c.word: c.tf for c in r.counts} for r in rows)


def test_words_of_a_page_are_counted_in_batches(spark):
    """F8: words of pages are stored as one string, and become rows after a batch of pages is counted."""
    texts = ["x y", None, "x", " . ", "y z z", "x w"]
    df = spark.createDataFrame([(i, "T", t, lang) for i, (t, lang) in enumerate(zip(texts, ["en", "en", None, "de", "de", "en"], strict=True))], "page_id long, title string, text string, lang string")
    bags = stage(significance.page_bags(df, "lang"), "bags")
    assert dict(bags.dtypes)["words"] == "string"
    marked = F.coalesce(F.bool_or(F.col("lang") == "en"), F.lit(False)).alias("marked")
    found = significance.doc_freq_of_bags(bags, F.col("lang") == "en")
    assert "Generate" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(found.collect()) == sorted(significance.doc_freq(significance.words_of_bags(bags, "lang"), marked).collect())
    assert not significance.doc_freq_of_bags(bags.where("page_id in (1, 3)"), F.lit(True)).collect()
