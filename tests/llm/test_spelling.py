"""Spelling variants: the scan, the blocks and the whole query against brute force."""

import random
import re
from collections import Counter
from zlib import crc32

import pytest
from atlaslex.llm import queries, spelling
from hypothesis import given, settings
from hypothesis import strategies as st

FOLDER = "/root/testdata/sf0.001"
ORDER = ["word", "form", "root", "n", "n_near", "form_n"]


def one_edit(word):
    """Every way to take a code point out, by the rest and the place."""
    return {(word[:i], word[i + 1 :]) for i in range(len(word))}


def brute_near(words):
    near = {word: set() for word in words}
    replaced = {}
    for word in words:
        for hole in one_edit(word):
            replaced.setdefault(hole, set()).add(word)
            shorter = "".join(hole)
            if shorter in near:
                near[word].add(shorter)
                near[shorter].add(word)
    for alike in replaced.values():
        for word in alike:
            near[word] |= alike - {word}
    return near


def brute_groups(counts):
    near, forms = brute_near(counts), {}
    for word, n in counts.items():
        best = min(near[word], key=lambda w: (-counts[w], w), default=None)
        forms[word] = best if best is not None and counts[best] >= 10 * n else None
    rows = set()
    for word, n in counts.items():
        root = word
        while forms[root] is not None:
            root = forms[root]
        rows.add((word, forms[word], root, n, len(near[word]), counts[forms[word]] if forms[word] else None))
    return rows


def brute_words(docs):
    counts = Counter()
    for doc_id, text in docs:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", lower):
            h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {word: n for word, n in counts.items() if len(word) >= 7 and n >= 2}


def rows_of(found):
    return {tuple(row[c] for c in ORDER) for row in found.collect()}


@settings(max_examples=400, deadline=None)
@given(st.sets(st.text("ab", max_size=6), max_size=40))
def test_the_scan_finds_all_pairs(words):
    listed = sorted(words)
    near = brute_near(words)
    expected = {(i, j) for i, a in enumerate(listed) for j, b in enumerate(listed) if i < j and b in near[a]}
    found = list(spelling.near_pairs(listed))
    assert set(found) == expected and len(found) == len(expected)


def test_jumps_skip_words():
    """Words beyond one edit are not read again: few rows are computed for many words."""
    words = sorted({f"{a}{b:03d}" for a in "klmn" for b in range(500)})
    calls, before = [0], spelling.next_row

    def counted(*args):
        calls[0] += 1
        return before(*args)

    spelling.next_row = counted
    try:
        list(spelling.near_pairs(words))
    finally:
        spelling.next_row = before
    assert calls[0] < len(words) ** 2 / 10


@pytest.mark.parametrize("crowd", [2048, 4])
def test_blocks_by_brute_force(spark, monkeypatch, crowd):
    monkeypatch.setattr(spelling, "CROWD", crowd)
    draw = random.Random(7)
    words = {"".join(draw.choices("abé", k=draw.randint(1, 9))) for _ in range(600)}
    words |= {"same" + "".join(draw.choices("xy", k=8)) for _ in range(150)}  # all blocks of their last places are crowded
    counts = {word: draw.choice([1, 2, 20, 300, 4000]) for word in words}
    found = spelling.groups(spark.createDataFrame(list(counts.items()), "word string, n long"))
    assert rows_of(found) == brute_groups(counts)


def test_query_by_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in queries.documents(spark, FOLDER).collect()]
    found = queries.QUERIES["op11_spelling_variants"](spark, FOLDER)
    assert found.columns == ORDER
    rows = found.collect()
    assert {tuple(r) for r in rows} == brute_groups(brute_words(docs)) and len(rows) == len({r.word for r in rows})


def test_forms_are_followed_to_the_last(spark):
    counts = {"abcdefgh": 5000, "abcdefg": 400, "abcdef": 30, "abcde": 2, "zzzzzzz": 9}
    rows = {row[0]: row for row in rows_of(spelling.groups(spark.createDataFrame(list(counts.items()), "word string, n long")))}
    assert [rows["abcde"][i] for i in (1, 2, 5)] == ["abcdef", "abcdefgh", 30]
    assert rows["zzzzzzz"] == ("zzzzzzz", None, "zzzzzzz", 9, 0, None)


def test_messy_rows(spark, messy, nothing):
    docs = [(r.doc_id, r.text) for r in messy.collect()]
    assert rows_of(spelling.groups(spelling.vocabulary(messy, slips=31))) == brute_groups(brute_words(docs))
    assert spelling.groups(spelling.vocabulary(nothing)).count() == 0
    given = spark.createDataFrame([(None, 4), ("", 3), ("twice", 2), ("twice", 5)], "word string, n long")
    assert rows_of(spelling.groups(given)) == {("twice", None, "twice", 7, 0, None)}


def test_very_long_words(spark):
    words = {"x" * 200_000 + end: n for end, n in (("", 3), ("y", 40), ("yy", 5))}
    text = " ".join(" ".join([word] * n) for word, n in words.items())
    found = spelling.groups(spelling.vocabulary(spark.createDataFrame([(1, text)], "doc_id long, text string")))
    assert {(len(r.word), len(r.form or "")) for r in found.collect()} == {(200_000, 200_001), (200_001, 0), (200_002, 0)}
