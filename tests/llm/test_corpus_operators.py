"""Operators that SQL cannot express, against brute force."""

import hashlib
import math
import random
import re
import struct
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
import xxhash
from atlaslex.llm import bpe, components, language_id, lm, multiset_hash, queries, simhash, suffix_dedup
from pyspark.sql import functions as F
from tokenizers import Tokenizer

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id").collect()
    return [(r.doc_id, r.text or "") for r in rows]


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def roots(nodes, pairs):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


# --- encoding


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.default_path())


def test_ids_are_those_of_the_library(library):
    random.seed(5)
    letters = ["a", "B", "9", " ", "  ", "\n", "\t", "\r\n", "é", "ß", "'", "'s", "'ll", "!", "..", "<|endoftext|>", "<|", "中", "😀"]
    letters += [" ", " ", "\x85", "\x1c", "​", "Ⅷ", "٣", "Ж", "x" * 60, " the", " of", "\x00"]
    texts = ["".join(random.choices(letters, k=random.randint(0, 500))) for _ in range(600)]
    texts += ["", "x" * 5000, " " * 3000, "ab " * 3000, "don't " * 900, "a\n" * 2000]
    ids = bpe.encode_texts([t.encode() for t in texts], bpe.default_path())
    assert ids.to_pylist() == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert bpe.decode_lists(ids, bpe.default_path()).to_pylist() == texts
    assert [library.decode(i, skip_special_tokens=False) for i in ids.to_pylist()] == texts


def test_chunks_of_shared_text_are_reused():
    known = bpe.Vocabulary(bpe.default_path())
    random.seed(6)
    shared = " ".join(f"w{random.randint(0, 10**6)}" for _ in range(2000)).encode()
    texts = [b"first head " + shared, b"another beginning, longer " + shared]
    cuts = bpe.chunk_ends(texts)
    assert len(cuts[0]) > 10
    known.encode(texts[0], cuts[0])
    before = known.reused
    known.encode(texts[1], cuts[1])
    assert known.reused - before >= len(cuts[1]) - 2


def test_kept_chunks_are_bounded():
    known = bpe.Vocabulary(bpe.default_path())
    known.chunks = bpe.Kept(50_000)
    random.seed(11)
    often = " ".join(f"v{random.randint(0, 10**6)}" for _ in range(600)).encode()
    for _ in range(300):
        text = " ".join(f"w{random.randint(0, 10**6)}" for _ in range(300)).encode() + often
        known.encode(text, bpe.chunk_ends([text])[0])
        kept = known.chunks
        size = sum(len(t) + n + bpe.ENTRY_BYTES for t, (_, n) in kept.young.items())
        assert size == kept.held <= kept.limit
    assert known.reused >= 200
    kept.put(b"x" * 60_000, 1, 0)
    assert kept.get(b"x" * 60_000) is None


def test_round_trip_of_messy_rows(messy, nothing, library):
    rows = bpe.digests(messy).collect()
    texts = Counter((r.doc_id, r.text or "") for r in messy.collect())
    expected = Counter()
    for (doc, text), times in texts.items():
        ids = library.encode(text, add_special_tokens=False).ids
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        expected[doc, len(ids), digest, hashlib.sha256(text.encode()).hexdigest()] += times
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows) == expected
    assert bpe.digests(nothing).count() == 0
    assert bpe.encode(messy, ids="numbers").columns == [*messy.columns, "numbers"]


# --- repeated passages


def brute_removals(texts, length=100):
    """texts: (id, bytes) in order. Covered flags of each."""
    seen, out = set(), []
    for _, text in texts:
        flags = bytearray(len(text))
        for i in range(len(text) - length + 1):
            if text[i : i + length] in seen:
                flags[i : i + length] = b"\1" * length
            seen.add(text[i : i + length])
        out.append(flags)
    return out


def digest_rows(texts):
    rows = Counter()
    for (doc, text), flags in zip(texts, brute_removals(texts), strict=True):
        runs = sum(1 for i, f in enumerate(flags) if f and (i == 0 or not flags[i - 1]))
        kept = bytes(b for b, f in zip(text, flags, strict=True) if not f)
        rows[doc, len(text), sum(flags), runs, hashlib.sha256(kept).hexdigest()] += 1
    return rows


def found_rows(docs):
    return Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.digests(docs).collect())


def test_repeats_of_all_documents(spark, documents):
    assert found_rows(spark.read.parquet(f"{FOLDER}/documents.parquet")) == digest_rows([(d, t.encode()) for d, t in documents])


@pytest.mark.parametrize("classes", [1 << 14, 1])
def test_repeats_of_built_texts(spark, monkeypatch, classes):
    """Shared pieces at all kinds of places and lengths; with one class per anchor every crowded anchor is split by window."""
    monkeypatch.setattr(suffix_dedup, "CLASSES", classes)
    random.seed(7)
    pieces = ["".join(random.choices("abcé ", k=random.randint(60, 260))) for _ in range(6)]
    texts = ["".join(random.choices(pieces, k=random.randint(1, 5))) + "".join(random.choices("xyz", k=random.randint(0, 90))) for _ in range(60)]
    texts += ["ab" * 300, "zzab" * 200, "q" * 99, "q" * 100, "q" * 101, "", texts[0], texts[1]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert found_rows(docs) == digest_rows([(i, t.encode()) for i, t in enumerate(texts)])


def test_repeats_in_messy_rows(messy, nothing):
    removed = suffix_dedup.remove(messy)
    assert removed.columns == messy.columns and removed.count() == messy.count()
    long = [r for r in removed.collect() if r.doc_id == 4]
    period = "lorem ipsum dolor sit amet "
    assert len(long) == 2 and all(r.text == (period * 5)[: len(r.text)] and len(r.text) <= len(period) and r.n_chars == len(r.text) for r in long)
    assert {r.doc_id: r.text for r in removed.collect()}[1] is None
    assert suffix_dedup.digests(nothing).count() == 0 and suffix_dedup.remove(nothing).count() == 0


def test_removed_text_keeps_whole_characters(spark):
    passage = "é" * 80
    docs = spark.createDataFrame([(1, f"a{passage}"), (2, f"b{passage}c")], "doc_id long, text string")
    assert [r.text for r in suffix_dedup.remove(docs).orderBy("doc_id").collect()] == ["aé", "bc"]


def test_maximal_repeats_by_brute_force():
    random.seed(8)
    for _ in range(30):
        contexts = [bytes(random.choices(b"ab", k=random.randint(1, 14))) for _ in range(5)]
        found = Counter((contexts[o[0][0]][o[0][1] :][:n], tuple(sorted(o))) for n, o in suffix_dedup.maximal_repeats(contexts, 3))
        expected = Counter()
        strings = {c[i:j] for c in contexts for i in range(len(c)) for j in range(i + 3, len(c) + 1)}
        for s in strings:
            places = [(k, i) for k, c in enumerate(contexts) for i in range(len(c)) if c.startswith(s, i)]
            before = {contexts[k][i - 1] if i else (k, i) for k, i in places}
            after = {contexts[k][i + len(s)] if i + len(s) < len(contexts[k]) else (k, i) for k, i in places}
            if len(places) > 1 and len(before) > 1 and len(after) > 1:
                expected[s, tuple(sorted(places))] += 1
        assert found == expected


# --- fingerprints


def brute_simhash(text):
    words = [w for w in lowered(text).replace("\t", " ").replace("\n", " ").replace("\v", " ").replace("\f", " ").replace("\r", " ").split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_groups_of_all_documents(spark, documents):
    prints = {d: brute_simhash(t) for d, t in documents}
    near = [(a, b) for a, b in combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= 2]
    expected = {d: (format(prints[d], "016x"), root) for d, root in roots(prints, near).items()}
    rows = queries.QUERIES["op10_simhash_groups"](spark, FOLDER).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == expected


@pytest.mark.parametrize("most", [64, 3, 0])
def test_links_of_dense_groups(spark, most):
    """Fingerprints around a few centres, with short and with long posting lists."""
    random.seed(9)
    values = set()
    for centre in [0, (1 << 64) - 1, *(random.getrandbits(64) for _ in range(4))]:
        for _ in range(60):
            values.add(centre ^ sum(1 << b for b in random.sample(range(64), random.randint(0, 5))))
    signed = {v - (1 << 64) if v >> 63 else v for v in values}
    near = [(a, b) for a, b in combinations(signed, 2) if ((a ^ b) & (1 << 64) - 1).bit_count() <= 2]
    table = spark.createDataFrame([(v,) for v in signed], "fp long")
    found = components.connected_components(simhash.links(table, most)).collect()
    mine = dict.fromkeys(signed) | {r.node: r.root for r in found}
    assert {n: n if r is None else r for n, r in mine.items()} == roots(signed, near)


def test_components_of_random_graphs(spark):
    random.seed(10)
    for pairs in ([(i, i + 1) for i in range(300)], [(random.randint(0, 400), random.randint(0, 400)) for _ in range(250)], [(0, i) for i in range(1, 200)], [(5, 5)]):
        found = components.connected_components(spark.createDataFrame(pairs, "u long, v long")).collect()
        expected = {n: r for n, r in roots({n for p in pairs for n in p}, pairs).items() if n != r}
        assert {r.node: r.root for r in found} == expected


def test_simhash_on_messy_rows(messy, nothing):
    rows = simhash.components(messy).collect()
    assert len(rows) == messy.count()
    empty = [r for r in rows if r.fp == 0]
    assert {r.component_id for r in empty} == {1} and {r.doc_id for r in empty} == {1, 2, 3, None}
    kept = simhash.keep_one(messy)
    # 5 stands for two different texts, both of which are first of their group: both stay.
    assert kept.columns == messy.columns and sorted(r.doc_id for r in kept.collect()) == [0, 1, 4, 5, 5, 7, 8]
    only = simhash.keep_one(messy.where("doc_id is null")).collect()
    assert sorted(str(r.text) for r in only) == ["None", "no id"]
    assert simhash.components(nothing).count() == 0 and simhash.keep_one(nothing).count() == 0


def test_one_row_of_every_group_stays(spark):
    """Also where ids repeat: one id in several groups, in one group twice, and as the first of another group."""
    base = [f"w{i}" for i in range(6000)]
    edits = ([*base[:-n], *(f"x{i}" for i in range(n))] for n in range(1, 400, 5))
    near = next(e for e in edits if brute_simhash(" ".join(e)) != brute_simhash(" ".join(base)))
    other = [f"v{i}" for i in range(300)]
    texts = {"a": base, "b": near, "c": other, "d": [f"u{i}" for i in range(50)]}
    rows = [(1, "b"), (1, "a"), (1, "c"), (2, "a"), (2, "d"), (3, "c"), (None, "d"), (4, "c"), (1, "c"), (None, "c")]
    docs = spark.createDataFrame([(i, " ".join(texts[t]), t) for i, t in rows], "doc_id long, text string, name string")
    prints = {t: brute_simhash(" ".join(words)) for t, words in texts.items()}
    groups = roots(prints, [(a, b) for a, b in combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= 2])
    assert len(set(groups.values())) < 4
    signed = {t: v - (1 << 64) if v >> 63 else v for t, v in prints.items()}
    expected = {}
    for i, t in rows:
        expected.setdefault(groups[t], []).append((i is None, i, signed[t], t))
    expected = sorted((min(g)[1], min(g)[3]) for g in expected.values())
    assert sorted((r.doc_id, r.name) for r in simhash.keep_one(docs).collect()) == expected


def test_multiset_fingerprints(spark, documents):
    rows = {r.doc_id: r for r in queries.QUERIES["op9_multiset_fingerprints"](spark, FOLDER).collect()}
    for place, (doc, text) in enumerate(documents):
        following = documents[(place + 1) % len(documents)][1]
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        assert rows[doc].n_chars == len(text)
        assert rows[doc].edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
    texts = dict(documents)
    for a, b in combinations(texts, 2):
        if texts[a] == texts[b]:
            assert rows[a].fingerprint == rows[b].fingerprint
    edited, nxt = (np.array([getattr(r, n) for r in rows.values()]) for n in ("near_edited", "near_next"))
    assert (0 <= edited).all() and (edited <= 1).all() and edited.mean() > 0.3 > nxt.mean()


def plain_fingerprint(text):
    """Sums of signed bytes of the paragraphs' hashes, lane by lane."""
    lanes = np.zeros(multiset_hash.LANES, dtype=np.int64)
    for piece in re.split(multiset_hash.BREAKS, text):
        if piece.strip(" "):
            for k in range(multiset_hash.LANES // 8):
                first = xxhash.xxh64_intdigest(struct.pack("<i", k), 42)
                value = xxhash.xxh64_intdigest(piece.encode(), first)
                lanes[8 * k : 8 * k + 8] += np.frombuffer(value.to_bytes(8, "little"), dtype=np.uint8).astype(np.int64) - 128
    return lanes


def plain_likeness(a, b):
    if (a == b).all():
        return 1.0
    length = math.sqrt(float((a * a).sum())) * math.sqrt(float((b * b).sum()))
    return min(1.0, max(0.0, float((a * b).sum()) / length)) if length else 0.0


def test_multiset_columns_by_a_plain_twin(spark, documents):
    rows = {r.doc_id: r for r in queries.QUERIES["op9_multiset_fingerprints"](spark, FOLDER).collect()}
    prints = {doc: plain_fingerprint(text) for doc, text in documents}
    assert len(rows) == len(documents)
    for place, (doc, text) in enumerate(documents):
        after, following = documents[(place + 1) % len(documents)]
        half = len(text) // 2
        edited = plain_fingerprint(text[: len(text) - half] + following[:half])
        for name, lanes in (("fingerprint", prints[doc]), ("edited_fingerprint", edited)):
            assert getattr(rows[doc], name) == "".join(f"{v % 2**32:08x}" for v in lanes.tolist())
        assert rows[doc].near_edited == pytest.approx(plain_likeness(prints[doc], edited), abs=1e-9)
        assert rows[doc].near_next == pytest.approx(plain_likeness(prints[doc], prints[after]), abs=1e-9)


def test_multiset_order_insertion_deletion(spark):
    texts = ["first part\nsecond part\nthird", "third\nfirst part\nsecond part", "first part\nthird", "second part", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    prints = {r.doc_id: r.fingerprint for r in multiset_hash.fingerprints(docs).collect()}
    assert prints[0] == prints[1] != prints[2] and prints[4] == prints[5] == [0] * multiset_hash.LANES
    pair = spark.createDataFrame([(prints[2], prints[3], prints[0])], "a array<long>, b array<long>, c array<long>")
    both = pair.select(multiset_hash.combine(F.col("a"), F.col("b")).alias("sum"), multiset_hash.combine(F.col("c"), F.col("b"), -1).alias("rest")).first()
    assert both["sum"] == prints[0] and both["rest"] == prints[2]


def test_multiset_on_messy_rows(spark, messy, nothing):
    rows = multiset_hash.edited(messy).collect()
    assert len(rows) == messy.count()
    ordered = sorted({r.doc_id for r in messy.collect() if r.doc_id is not None})
    seven = next(r for r in rows if r.doc_id == 7)
    assert seven.edited_text == "no \x00\x1c"
    last = next(r for r in rows if r.doc_id == ordered[-1])
    assert last.n_chars == len("\x00\x1c   odd spaces 中文 😀 <|endoftext|> end")
    assert multiset_hash.edited(nothing).count() == 0
    one = spark.createDataFrame([(9, "abcd")], "doc_id long, text string")
    assert multiset_hash.edited(one).first().edited_text == "abab"


# --- models


def test_language_evidence(spark):
    rows = {r.page_id: r for r in queries.QUERIES["op7_language_id"](spark, FOLDER).collect()}
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{FOLDER}/pages.parquet").select("page_id", "url").collect()}
    assert np.mean([rows[p].lang == url.split("/")[3] for p, url in pages.items()]) > 0.97


def test_language_without_text_uses_other_evidence(spark):
    words = {"en": "the house and the garden of the king", "de": "das haus und der garten des königs"}
    labelled = spark.createDataFrame([(lang, text * 20) for lang, text in words.items()] + [(None, "x"), ("en", None)], "lang string, text string")
    sites = [(i, "http://a.de/x", f'<html lang="de"><p>{words["de"] * 8}</p>') for i in range(40)]
    sites += [(100 + i, "http://b.com/x", f"<html lang=en-GB><p>{words['en'] * 8}</p>") for i in range(40)]
    sites += [(200, "http://a.de/empty", "<html></html>"), (201, "http://c.com/", '<html lang="en"><script>der und das</script>'), (202, None, None), (202, None, None)]
    pages = spark.createDataFrame(sites, "page_id long, url string, html string").withColumns({"host": F.lit("x"), "lang": F.lit("y")})
    rows = language_id.identify(pages, labelled).collect()
    found = {r.page_id: r for r in rows}
    assert len(rows) == len(sites) and all(found[i].lang == "de" and found[100 + i].lang == "en" for i in range(40))
    assert found[200].lang == "de" and found[201].lang == "en" and found[201].declared == "en" and found[202].host == ""
    assert language_id.identify(pages.where("false"), labelled).collect() == []
    assert {r.lang for r in language_id.identify(pages, labelled.where("false")).collect()} == {None}


def brute_base(texts):
    counts, documents = Counter(), 0
    for doc, text in texts:
        if zlib.crc32(str("" if doc is None else doc).encode()) % 10:
            counts.update(text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).encode().split())
            documents += 1
    if documents:
        counts[None] = documents
    total, norm = sum(counts.values()), math.log10(sum(counts.values()) + 0.1 * (len(counts) + 1))
    for doc, text in texts:
        words = [*lm.tokens(text.encode()), None]
        held = zlib.crc32(str("" if doc is None else doc).encode()) % 10 == 0
        score = sum(math.log10(counts[w] + 0.1) - norm for w in words)
        yield doc, held, len(words), sum(counts[w] > 0 for w in words), total, round(score, 5)


@pytest.mark.parametrize("known", [1 << 18, 2100])
def test_scores_of_all_documents(spark, documents, monkeypatch, known):
    monkeypatch.setattr(lm, "KNOWN", known)
    rows = lm.score(spark.read.parquet(f"{FOLDER}/documents.parquet")).collect()
    mine = {(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in rows}
    assert mine == set(brute_base(documents))
    assert sum(r.score for r in rows if r.held_out) > sum(r.base_score for r in rows if r.held_out)


def test_model_is_normalised():
    model = lm.Model.start(np.full(lm.CLASSES, 1 / lm.CLASSES))
    rng = np.random.default_rng(1)
    model.values[:] = rng.normal(0, 0.5, len(model.values))
    every = np.arange(lm.CLASSES)
    for first, second in ((lm.START, lm.START), (3, 7), (lm.CLASSES - 1, 0)):
        logs = model.log_probabilities(every, np.full(len(every), first), np.full(len(every), second))
        assert abs(np.exp(logs).sum() - 1) < 1e-3


def test_rare_classes_share_all_words():
    counts = {f"w{i}x".encode(): 3000 - i for i in range(2500)}
    known = list(counts.items())
    rare = Counter()
    for word, n in known[lm.WORDS :]:
        rare[lm.rare_class(word)] += np.array([n, 1])
    book = lm.Lexicon(known, 5, sum(counts.values()) + 5, len(counts) + 1, {c: tuple(v) for c, v in rare.items()})
    inside = Counter()
    for word, n in known[lm.WORDS :]:
        inside[lm.rare_class(word)] += (n + lm.SMOOTH) / 10 ** book.rare_norm[lm.rare_class(word) - lm.FIRST_RARE]
    unseen = {c: lm.SMOOTH / 10 ** book.rare_norm[c - lm.FIRST_RARE] for c in inside}
    assert all(abs(v + unseen[c] - 1) < 1e-9 for c, v in inside.items())


def test_scores_of_messy_rows(messy, nothing):
    rows = lm.score(messy).collect()
    texts = [(r.doc_id, r.text or "") for r in messy.collect()]
    mine = Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in rows)
    assert mine == Counter(brute_base(texts))
    assert lm.score(nothing).collect() == []


def small_lexicon(words=2600, seldom=2400):
    """More words than classes; the last ones are too seldom for a vector."""
    counts = {f"w{i}x{i % 7}".encode(): 4000 - i if i < seldom else lm.SELDOM - 1 for i in range(words)}
    known = list(counts.items())
    rare = Counter()
    for word, n in known[lm.WORDS :]:
        rare[lm.rare_class(word)] += np.array([n, 1])
    return known, lm.Lexicon(known, 5, sum(counts.values()) + 5, len(counts) + 1, {c: tuple(v) for c, v in rare.items()})


def test_probabilities_within_classes_add_up():
    known, book = small_lexicon()
    values = lm.start_values(book)
    values[lm.CONTEXT_ROW :] = np.random.default_rng(2).normal(0, 1, values[lm.CONTEXT_ROW :].shape)
    within = lm.Within(values, book)
    sums = np.array([within.log_sums(c) for c in range(lm.RARE)])
    assert (book.rows >= 0).sum() == 2400 - lm.WORDS
    for context in (lm.START, 0, 77):
        total = Counter()
        for place in range(lm.WORDS, len(known)):
            c, row = book.classes[place], book.rows[place]
            log = math.log10(known[place][1] + lm.SMOOTH) - book.rare_norm[c - lm.FIRST_RARE]
            if row >= 0:
                log += within.log_shifts(np.array([row]), np.array([c]), np.array([context]), sums)[0] / math.log(10)
            total[c] += 10**log
        for c, value in total.items():
            assert abs(value + lm.SMOOTH / 10 ** book.rare_norm[c - lm.FIRST_RARE] - 1) < 1e-6


def test_words_of_one_class_learn_their_contexts():
    """Two words of a class, each after a context of its own, get a higher probability there than by counts."""
    known, book = small_lexicon()
    values, steps = lm.start_values(book), np.zeros((lm.WORD_ROW + len(book.row_mass), lm.INNER), dtype=np.float32)
    steps[lm.CONTEXT_ROW :] = 1
    within, seen = lm.Within(values, book), lm.Within(steps, book)
    c = int(np.argmax(np.diff(book.row_bounds)))
    first, second = book.row_bounds[c], book.row_bounds[c] + 1
    rows, before = np.array([first, second] * 300), np.array([60, 61] * 300)
    rng = np.random.default_rng(3)
    for _ in range(20):
        within.learn(rows, before, rng, seen)
    sums = np.array([within.log_sums(c) for c in range(lm.RARE)])
    kind = np.array([lm.FIRST_RARE + c] * 4)
    right, right2, wrong, wrong2 = within.log_shifts(np.array([first, second, first, second]), kind, np.array([60, 61, 61, 60]), sums)
    assert min(right, right2) > 1 and max(wrong, wrong2) < min(right, right2) - 1


def test_scores_follow_the_values(spark, monkeypatch):
    """The score of whole texts is the sum that plain Python finds token by token from the same values."""
    monkeypatch.setattr(lm, "KNOWN", 2300)
    monkeypatch.setattr(lm, "SELDOM", 1)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    training = docs.where(~lm.held_out())
    counts = lm.word_counts(training)
    of = {r.word: r.n for r in counts.collect()}
    book = lm.lexicon(counts, training.count())
    values = lm.start_values(book)
    values += np.random.default_rng(4).normal(0, 0.2, values.shape).astype(np.float32)
    monkeypatch.setattr(lm, "train", lambda training, known: values)
    found = {r.doc_id: r.score for r in lm.score(docs).collect()}

    model, c1 = lm.Model(lm.shared_part(values)), lm.FIRST_WORD
    place = {bytes(word): i for i, word in enumerate(book.words)}
    vector = {word: book.rows[i] for word, i in place.items() if book.rows[i] >= 0}
    class_of = lambda word: c1 + place[word] if place.get(word, lm.WORDS) < lm.WORDS else lm.rare_class(word)
    members, mass, different = {}, Counter(), Counter()
    for word, n in of.items():
        if class_of(word) < c1:
            mass[class_of(word)] += n
            different[class_of(word)] += 1
            if word in vector:
                members.setdefault(class_of(word), []).append(word)
    in_classes = {}

    def log_class(w, a, b):
        if (a, b) not in in_classes:
            h = model.contexts[a] * model.near + model.contexts[b] * model.far
            scores = (model.outputs @ h + model.bias).astype(float)
            in_classes[a, b] = scores - np.log(np.exp(scores).sum())
        return in_classes[a, b][w]

    def log_within(word, c, a):
        log = math.log((of.get(word, 0) + 0.1) / (mass[c] + 0.1 * (different[c] + 1)))
        if word not in vector:
            return log
        x, u = values[lm.CONTEXT_ROW + a], values[lm.WORD_ROW :]
        weights = [of[other] + 0.1 for other in members[c]]
        mean = sum(m * math.exp(x @ u[vector[other]]) for m, other in zip(weights, members[c], strict=True)) / sum(weights)
        return log + x @ u[vector[word]] - math.log(mean)

    assert vector
    shorter = sorted(docs.collect(), key=lambda r: len(r.text or ""))[:120]
    for row in shorter:
        b = a = lm.START
        total = 0.0
        for word in [*lm.tokens((row.text or "").encode()), None]:
            w = lm.END if word is None else class_of(word)
            total += log_class(w, a, b) + (log_within(word, w, a) if lm.FIRST_RARE <= w < c1 else 0)
            b, a = a, w
        assert abs(total / math.log(10) - found[row.doc_id]) < 1e-3 * max(1, abs(found[row.doc_id]))
