"""All stages of the pipeline against brute force over the smallest tables."""

from collections import Counter
from itertools import combinations

import corpus_pipeline
from atlaslex.llm import bpe, mixing, quality
from test_corpus_operators import FOLDER, brute_removals, brute_simhash, roots
from tokenizers import Tokenizer


def passes_rules(text):
    found = dict(zip(quality.MEASURES, quality.measure(text.encode()), strict=True))
    for rule in quality.POLICIES["v2"]:
        value, factor, limit, other = quality.RULES[rule]
        if factor * (int(value) if value.isdigit() else found[value]) > limit * found[other]:
            return False
    return True


def without_repeats(docs):
    """A character goes if all its bytes are in removed strings."""
    raw = [(doc, text.encode()) for doc, text in docs]
    for (doc, text), flags in zip(docs, brute_removals(raw), strict=True):
        kept, at = [], 0
        for c in text:
            size = len(c.encode())
            if not all(flags[at : at + size]):
                kept.append(c)
            at += size
        yield doc, "".join(kept)


def test_pipeline_by_brute_force(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id").collect()
    source = {r.doc_id: r.source for r in rows}
    docs = [(r.doc_id, r.text or "") for r in rows if passes_rules(r.text or "")]
    prints = {doc: brute_simhash(text) for doc, text in docs}
    groups = roots(prints, [(a, b) for a, b in combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= 2])
    docs = list(without_repeats([(doc, text) for doc, text in docs if groups[doc] == doc]))
    table = spark.createDataFrame([(d, t, source[d]) for d, t in docs], "doc_id long, text string, source string")
    copies = {r.doc_id: r.copies for r in mixing.plan(table).collect()}
    library = Tokenizer.from_file(bpe.default_path())
    expected = Counter()
    for doc, text in docs:
        expected[doc, tuple(library.encode(text, add_special_tokens=False).ids)] += copies[doc]
    found = Counter((r.doc_id, tuple(r.ids)) for r in corpus_pipeline.run(spark, FOLDER).collect())
    assert found == +expected


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, FOLDER).columns == docs.columns
    assert corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).count() == 0
