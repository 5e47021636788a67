"""Chat windows by a plain walk over every conversation, and exact reading back."""

import hashlib
import random

import pytest
from atlaslex.llm import bpe, chat, queries
from pyspark.sql import functions as F
from tokenizers import Tokenizer

FOLDER = "/root/testdata/sf0.001"
NAMES = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
SAID = "\\### Assistant: </turn> ok"


def write(role, text):
    role = role.replace("%", "%25").replace("\n", "%0A").replace("<", "%3C")
    return f"<turn>{role}\n", text.replace("<turn>", "\\<turn>").replace("</turn>", "\\</turn>"), "\n</turn>\n"


def brute_windows(turns, budget, count):
    """(formatted, masked texts, repeated turns) of the windows of one conversation, one turn after the other."""
    stretch = budget // 4
    written = [write(role, text) for role, text in turns]
    sizes = [max(1, count("".join(w))) for w in written]
    retained = turns[0][0] == "system" and sizes[0] <= stretch
    windows, starts, at, longs, last = [], {}, 0, 0, None
    for i in range(retained, len(turns)):
        starts[i] = at
        key = (at // stretch, longs, sizes[i] > stretch)
        if key != last:
            windows.append([i])
        else:
            windows[-1].append(i)
        last, longs, at = key, longs + (sizes[i] > stretch), at + sizes[i]
    out = []
    for number, own in enumerate(windows or [[]]):
        history = [] if not own else [i for i in range(retained, own[0]) if starts[own[0]] - starts[i] <= stretch]
        front = [0] * retained
        learned = [turns[i][1] for i in (own if number else front + own) if turns[i][0] == "assistant"]
        shown = [*front, *history, *own]
        out.append(("".join("".join(written[i]) for i in shown), learned, len(history) + (retained and number > 0), sum(sizes[i] for i in shown)))
    return out


def brute_digest(conv, turns, budget, count):
    windows = brute_windows(turns, budget, count)
    said = "".join(f"{role}\n{text}\n" for role, text in turns)
    loss = "".join(text for role, text in turns if role == "assistant")
    assert "".join(text for _, learned, _, _ in windows for text in learned) == loss
    sha = [hashlib.sha256(s.encode()).hexdigest() for s in (said, loss)]
    return conv, len(turns), sha[0], len(loss), sha[1], sum(len(w[0]) for w in windows)


def by_conversation(rows):
    found = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0)):
        found.setdefault(conv, []).append((role or "", text or ""))
    return found


def test_query_by_brute_force(spark):
    library = Tokenizer.from_file(bpe.default_path())
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    talks = by_conversation([*rows, (-7, 0, "user", SAID), (-7, 1, "assistant", SAID)])
    expected = {brute_digest(c, t, chat.BUDGET, lambda s: len(library.encode(s, add_special_tokens=False).ids)) for c, t in talks.items()}
    found = queries.QUERIES["op13_chat_windows"](spark, FOLDER)
    assert found.columns == NAMES and {tuple(r) for r in found.collect()} == expected


def made_turns(conversations=12, most=60):
    draw = random.Random(3)
    words = ["one", "two words", "</turn>", "\\<turn>", "<turn", "\n", "\\", "\n</turn>\n", "%3C", "\U0001f600é", ""]
    rows = []
    for conv in range(conversations):
        for turn in range(draw.randint(1, most)):
            role = "system" if turn == 0 and draw.random() < 0.5 else draw.choice(["user", "assistant", "tool\n<%0A>", None, "system"])
            rows.append((conv, turn, role, draw.choice([None, " ".join(draw.choices(words, k=draw.randint(0, 30)))])))
    return rows


@pytest.mark.parametrize("hot", [1 << 20, 400])
@pytest.mark.parametrize("slices", [64, 1])
def test_windows_by_brute_force(spark, monkeypatch, hot, slices):
    monkeypatch.setattr(chat, "SLICE", slices)
    rows, budget, count = made_turns(), 240, F.char_length
    talks = by_conversation(rows)
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    found = chat.read_turns(chat.format_turns(table, budget, count, hot)).orderBy("conv_id", "window").collect()
    seen = {}
    for r in found:
        assert sum(s.chars for s in r.loss) <= len(r.formatted)
        assert r.tokens <= budget or r.n_turns - r.n_repeated == 1
        seen.setdefault(r.conv_id, []).append((r.formatted, r.learned, r.n_repeated, r.tokens))
    assert seen == {c: brute_windows(t, budget, len) for c, t in talks.items()}
    assert max(map(len, seen.values())) > 20
    # Every turn is read back once and in order.
    again = {c: [] for c in talks}
    for r in found:
        again[r.conv_id] += [(t.role, t.text) for t in r.turns]
    assert again == talks
    expected = {brute_digest(c, t, budget, len) for c, t in talks.items()}
    assert {tuple(r) for r in chat.digests(table, budget, count, hot).collect()} == expected


@pytest.mark.parametrize("hot", [1 << 20, 100])
def test_odd_rows(spark, hot):
    rows = [
        (None, None, None, None), (None, 2, "assistant", "no id"), (1, 0, "system", "only rules"),
        (2, 0, "system", "x" * 500), (2, 1, "assistant", "y" * 900), (2, 2, "user", "z"),
        (3, 5, "assistant", "same"), (3, 5, "assistant", "same"), (3, 5, "assistant", "same"), (4, 0, "assistant", ""),
        (5, 0, "user", "word " * 400_000),
    ]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    table = table.withColumns({c: F.lit("x") for c in ("tokens", "tie", "start", "window", "turns", "_own", "system", "slice")})
    expected = {brute_digest(c, t, 400, len) for c, t in by_conversation(rows).items()}
    assert {tuple(r) for r in chat.digests(table, 400, F.char_length, hot).collect()} == expected
    assert chat.digests(table.where("false"), 400, F.char_length, hot).count() == 0
    assert chat.format_turns(table.where("false")).count() == 0


def test_one_shuffle_of_texts(spark):
    table = spark.read.parquet(f"{FOLDER}/conversations.parquet")
    plan = chat.digests(table)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_counted_tokens_are_the_librarys(spark):
    library = Tokenizer.from_file(bpe.default_path())
    texts = ["", "a b", "some words, 中文 \U0001f600 <|endoftext|> and more\n" * 9000, None]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1).select(chat.bpe_tokens(F.col("text")).alias("n")).collect()
    assert [r.n for r in rows] == [len(library.encode(t or "", add_special_tokens=False).ids) for t in texts]
