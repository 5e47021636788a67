r"""Chat formatting: conversations as training windows of a token budget, cut between turns.

*Template.* A turn is ``<turn>role``, a line break, its text, a line break and ``</turn>``. In texts a backslash is put before each
``<turn>`` and ``</turn>`` and nothing else is changed, so the marks of the template are the only ones without one before them,
and taking one backslash before each mark away gives the text again. In roles ``%``, ``<`` and line breaks are written as in addresses.

*Windows.* A turn weighs the tokens of its formatted text. Prefix sums of these choose the windows, without a walk over the
conversation: a turn belongs to the stretch of ``budget / 4`` tokens in which it starts, and a turn of more than that is a
window by itself. So a window has less than ``budget / 2`` tokens of its own, or one turn, and windows begin and end between turns.
A system turn at the start of a conversation, of ``budget / 4`` tokens at most, is retained in front of every window (a longer one is
a turn like others). Between it and the own turns stand the turns before, as far as they have no more than ``budget / 4`` tokens together.
A window exceeds the budget only where one turn does that alone; texts are never cut or left out.

*Mask.* ``loss`` has the places of the texts of assistant turns, in code points. Repeated turns are masked out, so every
assistant text is learned from once.

How it runs: rows are shuffled once, by conversation; prefix sums, windows and repeats are window functions, and the turns of a
window are put together on the same partitions. A conversation of more than ``HOT`` bytes is not brought to one task: its rows are
dealt by ranges, prefix sums are taken within ranges and shifted by those before, and it is cut into slices of ``SLICE``
stretches. The next slice gets a copy of the turns that it may repeat. The same window functions then run over slices.

``digests`` reads turns and masked texts back from the windows. A digest of a whole conversation is sequential by its nature; for a
conversation beyond ``HOT`` it is fed window by window by a task that holds one window at a time.

Defined cases: a null text is an empty one, a null role an empty role, a null ``conv_id`` is one conversation. Turns come in the order
of ``turn`` (null first), then of a hash of role and text; repeated rows are repeated turns. Other columns are not read. Texts may
have any length. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from atlaslex.llm import bpe
from atlaslex.llm.batches import text_bytes
from atlaslex.operators.lookup import broadcast_if_small
from atlaslex.staging import stage

BEGIN, END = "<turn>", "</turn>"
BUDGET = 2048
HOT, SLICE = 1 << 20, 64

SYSTEM, ASSISTANT = "system", "assistant"


def _replaced(text: Column, *pairs: tuple[str, str]) -> Column:
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def escaped(text: Column) -> Column:
    """A text without marks of the template."""
    return _replaced(text, (BEGIN, f"\\{BEGIN}"), (END, f"\\{END}"))


def unescaped(text: Column) -> Column:
    """What ``escaped`` was made from."""
    return _replaced(text, (f"\\{BEGIN}", BEGIN), (f"\\{END}", END))


def _role_written(role: Column) -> Column:
    return _replaced(role, ("%", "%25"), ("\n", "%0A"), ("<", "%3C"))


def _role_read(role: Column) -> Column:
    return _replaced(role, ("%3C", "<"), ("%0A", "\n"), ("%25", "%"))


def _head(role: Column) -> Column:
    return F.concat(F.lit(BEGIN), _role_written(role), F.lit("\n"))


def turn_text(role: Column, text: Column) -> Column:
    """One formatted turn."""
    return F.concat(_head(role), escaped(text), F.lit(f"\n{END}\n"))


def bpe_tokens(text: Column) -> Column:
    """Tokens of a text by the installed byte-level vocabulary."""
    return bpe.token_counter(bpe.default_path())(text_bytes(text))


def _stretch(budget: int) -> int:
    return max(1, budget // 4)


def _placed(rows: DataFrame, before: Column, longs: Column, role: Column, tokens: Column, first: Column, budget: int) -> DataFrame:
    """Adds ``start``, ``longs`` and ``system``; ``role`` and ``tokens`` are those of the conversation's first turn.

    ``before`` and ``longs`` count what stands before a row. A retained system turn weighs nothing and starts at -1.
    """
    retained = (role == SYSTEM) & (tokens <= _stretch(budget))
    start = F.when(~retained, before).when(first, F.lit(-1)).otherwise(before - tokens)
    return rows.withColumns({"start": start.cast("long"), "longs": longs.cast("long"), "system": retained & first})


def _whole(rows: DataFrame, budget: int) -> DataFrame:
    """Rows of conversations that fit into a task, placed by window functions; all of one slice."""
    order = Window.partitionBy("conv_id").orderBy("turn", "tie")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    rows = rows.withColumns({
        "_before": F.coalesce(F.sum("tokens").over(earlier), zero),
        "_longs": F.coalesce(F.sum((F.col("tokens") > _stretch(budget)).cast("long")).over(earlier), zero),
        "_role": F.first("role").over(order), "_tokens": F.first("tokens").over(order), "_at": F.row_number().over(order),
    })
    placed = _placed(rows, F.col("_before"), F.col("_longs"), F.col("_role"), F.col("_tokens"), F.col("_at") == 1, budget)
    return placed.withColumns({"slice": zero, "context": F.lit(False)})


def _sliced(rows: DataFrame, budget: int) -> DataFrame:
    """Rows of very large conversations, placed by ranges and dealt into slices."""
    stretch, size = _stretch(budget), _stretch(budget) * SLICE
    keys = ("conv_id", "turn", "tie", "_row")  # equal rows of any number are dealt out too
    ranges = rows.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    at = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ranged = stage(ranges.withColumns({"_range": F.spark_partition_id(), "_at": at}).drop("_row"), "turn-ranges")
    long = (F.col("tokens") > stretch).cast("long")
    first = F.min(F.struct("_at", "role", "tokens")).alias("f")
    sums = ranged.groupBy("conv_id", "_range").agg(F.sum("tokens").alias("t"), F.sum(long).alias("l"), first)
    order = Window.partitionBy("conv_id").orderBy("_range")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    sums = sums.select(
        F.col("conv_id").alias("_conv"), F.col("_range").alias("_of"), F.coalesce(F.sum("t").over(earlier), zero).alias("_t"),
        F.coalesce(F.sum("l").over(earlier), zero).alias("_l"), F.first("f").over(order).alias("_f"),
        (F.col("_range") == F.first("_range").over(order)).alias("_front"),
        F.sum("t").over(Window.partitionBy("conv_id")).alias("_all"),
    )
    sums = broadcast_if_small(stage(sums, "range-sums"))
    within = Window.partitionBy("_range", "conv_id").orderBy("_at")
    inner = within.rowsBetween(Window.unboundedPreceding, -1)
    rows = ranged.withColumns({"_b": F.coalesce(F.sum("tokens").over(inner), zero), "_n": F.coalesce(F.sum(long).over(inner), zero)})
    rows = rows.join(sums, (F.col("_range") == F.col("_of")) & F.col("conv_id").eqNullSafe(F.col("_conv")))
    first = F.col("_front") & (F.col("_at") == F.col("_f._at"))
    placed = _placed(rows, F.col("_b") + F.col("_t"), F.col("_n") + F.col("_l"), F.col("_f.role"), F.col("_f.tokens"), first, budget)
    own = F.floor(F.col("start") / size)
    # The next slice repeats what starts less than a stretch before it; every slice gets the system turn.
    near = F.col("start") >= (own + 1) * size - stretch
    slices = F.when(F.col("system"), F.sequence(zero, F.floor(F.col("_all") / size))).when(near, F.array(own, own + 1)).otherwise(F.array(own))
    placed = placed.withColumn("_own", F.greatest(own, zero)).withColumn("slice", F.explode(slices))
    return placed.withColumn("context", F.col("slice") != F.col("_own"))


def _windows(rows: DataFrame, budget: int) -> DataFrame:
    """Windows from placed rows, on the partitions on which they lie."""
    stretch = _stretch(budget)
    part = Window.partitionBy("conv_id", "slice")
    order = part.orderBy("start")
    long = F.col("tokens") > stretch
    # A retained system turn is of no stretch, so the turn behind it begins a window.
    place = F.when(~F.col("system"), F.struct(F.floor(F.col("start") / stretch).alias("stretch"), "longs", long.alias("long")))
    begins = ~F.col("system") & ~place.eqNullSafe(F.lag(place).over(order))
    rows = rows.withColumn("_begins", F.when(begins, F.col("start")))
    own = F.when(F.col("system"), F.lit(0)).otherwise(F.last("_begins", ignorenulls=True).over(order))
    later = F.collect_list(F.when(~F.col("context"), F.col("_begins"))).over(order.rangeBetween(1, stretch))
    system = F.max(F.when(F.col("system"), F.struct("role", "text", "tokens"))).over(part)
    no_window = F.array().cast("array<long>")
    rows = rows.withColumns({"_own": own.cast("long"), "_later": later, "_system": system})
    into = F.concat(
        F.when(F.col("context"), no_window).otherwise(F.array("_own")), F.when(F.col("system"), no_window).otherwise(F.col("_later"))
    )
    each = rows.withColumn("window", F.explode(into))
    repeated = F.col("window") != F.col("_own")
    body = F.char_length(escaped(F.col("text"))).alias("body")
    turn = F.struct("start", turn_text(F.col("role"), F.col("text")).alias("text"), F.char_length(_head(F.col("role"))).alias("head"), body,
                    ((F.col("role") == ASSISTANT) & ~repeated).alias("loss"), repeated.alias("repeated"), "tokens")
    # Of a window other than the first the system turn is a copy.
    found = each.groupBy("conv_id", "slice", "window").agg(
        F.sort_array(F.collect_list(turn)).alias("turns"), F.first(F.when(F.col("window") > 0, F.col("_system"))).alias("s")
    )
    copy = F.struct(
        F.lit(-1).cast("long").alias("start"), turn_text(F.col("s.role"), F.col("s.text")).alias("text"), F.lit(0).alias("head"), F.lit(0).alias("body"),
        F.lit(False).alias("loss"), F.lit(True).alias("repeated"), F.col("s.tokens").alias("tokens"),
    )
    found = found.withColumn("turns", F.when(F.col("s").isNull(), F.col("turns")).otherwise(F.concat(F.array(copy), F.col("turns"))))
    spans = F.aggregate(
        "turns", F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,chars:bigint>>").alias("spans")),
        lambda done, t: F.struct(
            (done["at"] + F.char_length(t["text"])).alias("at"),
            F.when(t["loss"], F.concat(done["spans"], F.array(F.struct((done["at"] + t["head"]).alias("start"), t["body"].cast("long").alias("chars")))))
            .otherwise(done["spans"]).alias("spans"),
        ),
        lambda done: done["spans"],
    )
    return found.select(
        "conv_id", "window", F.array_join(F.transform("turns", lambda t: t["text"]), "").alias("formatted"), spans.alias("loss"),
        F.size("turns").alias("n_turns"), F.size(F.filter("turns", lambda t: t["repeated"])).alias("n_repeated"),
        F.aggregate("turns", F.lit(0).cast("long"), lambda total, t: total + t["tokens"]).alias("tokens"),
    )


def _formatted(turns: DataFrame, budget: int, count: Callable[[Column], Column], hot: int) -> tuple[DataFrame, DataFrame | None]:
    """Windows of conversations of up to ``hot`` bytes, and of the others if there are any."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    weight = F.sum(F.octet_length("text") + F.octet_length("role") + 16)
    large = stage(rows.groupBy("conv_id").agg(weight.alias("bytes")).where(F.col("bytes") > hot).select(F.col("conv_id").alias("_conv")), "large")

    def counted(some: DataFrame) -> DataFrame:
        tokens = F.greatest(count(turn_text(F.col("role"), F.col("text"))), F.lit(1)).cast("long")
        return some.withColumns({"tokens": tokens, "tie": F.xxhash64("role", "text")})

    if large.isEmpty():
        return _windows(_whole(counted(rows), budget), budget), None
    large = broadcast_if_small(large)
    same = F.col("conv_id").eqNullSafe(F.col("_conv"))
    usual = _windows(_whole(counted(rows.join(large, same, "left_anti")), budget), budget)
    return usual, _windows(_sliced(counted(rows.join(large, same, "left_semi")), budget), budget)


def format_turns(turns: DataFrame, budget: int = BUDGET, count: Callable[[Column], Column] = bpe_tokens, hot: int = HOT) -> DataFrame:
    """One row for each window: ``conv_id``, ``window`` (place of its first own token), ``formatted``, ``loss`` (``start`` and ``chars`` of
    what is learned from), ``n_turns``, ``n_repeated`` (turns at its front that are repeated) and ``tokens``.

    ``turns`` has ``conv_id``, ``turn``, ``role`` and ``text``; ``count`` tells the tokens of a formatted turn.
    """
    usual, large = _formatted(turns, budget, count, hot)
    return usual if large is None else usual.unionByName(large)


def read_turns(windows: DataFrame) -> DataFrame:
    """Adds ``turns`` (role and text of the window's own turns) and ``learned`` (texts under the mask), both from ``formatted``."""
    parts = F.split("formatted", f"\n{END}\n")
    parts = F.slice(parts, F.col("n_repeated") + 1, F.size(parts) - 1 - F.col("n_repeated"))

    def read(part: Column) -> Column:
        line = F.instr(part, "\n")
        role = F.substring(part, F.lit(len(BEGIN) + 1), line - len(BEGIN) - 1)
        return F.struct(_role_read(role).alias("role"), unescaped(F.substring(part, line + 1, F.char_length(part))).alias("text"))

    learned = F.transform("loss", lambda s: unescaped(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), s["chars"].cast("int"))))
    return windows.withColumns({"turns": F.transform(parts, read), "learned": learned})


def _pieces(windows: DataFrame) -> DataFrame:
    """What a window adds to the digests of its conversation."""
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read_turns(windows).select(
        "conv_id", "window", F.size("turns").cast("long").alias("n"), F.array_join(said, "").alias("said"),
        F.array_join("learned", "").alias("learned"), F.char_length("formatted").cast("long").alias("chars"),
    )


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _streamed(batches):
    """Digests of conversations whose windows come in order."""
    names = [field.split()[0] for field in DIGESTS.split(", ")]
    state: list | None = None
    done: list[tuple] = []

    def closed() -> tuple:
        conv, n, said, chars, learned, formatted = state
        return conv, n, said.hexdigest(), chars, learned.hexdigest(), formatted

    for batch in batches:
        for i in range(batch.num_rows):  # one window at a time
            row = batch.slice(i, 1).to_pylist()[0]
            if state is None or state[0] != row["conv_id"]:
                if state is not None:
                    done.append(closed())
                state = [row["conv_id"], 0, sha256(), 0, sha256(), 0]
            state[1] += row["n"]
            state[2].update(row["said"].encode())
            state[3] += len(row["learned"])
            state[4].update(row["learned"].encode())
            state[5] += row["chars"]
    if state is not None:
        done.append(closed())
    columns = list(zip(*done, strict=True)) or [()] * len(names)
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def digests(turns: DataFrame, budget: int = BUDGET, count: Callable[[Column], Column] = bpe_tokens, hot: int = HOT) -> DataFrame:
    """Per conversation: turns and texts under the mask as they are read back from the windows, and the size of the windows."""
    usual, large = _formatted(turns, budget, count, hot)
    piece = F.struct("window", "n", "said", "learned", "chars")
    rows = _pieces(usual).groupBy("conv_id").agg(F.sort_array(F.collect_list(piece)).alias("w"))

    def whole(field: str) -> Column:
        return F.array_join(F.transform("w", lambda w: w[field]), "")

    def total(field: str) -> Column:
        return F.aggregate("w", F.lit(0).cast("long"), lambda s, w: s + w[field])

    rows = rows.select("conv_id", total("n").alias("n_turns"), whole("said").alias("said"), whole("learned").alias("learned"), total("chars").alias("formatted_chars"))
    found = rows.select(
        "conv_id", "n_turns", F.sha2(F.col("said").cast("binary"), 256).alias("turns_sha256"),
        F.char_length("learned").cast("long").alias("loss_chars"), F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"), "formatted_chars",
    )
    if large is None:
        return found
    dealt = _pieces(large).repartition("conv_id").sortWithinPartitions("conv_id", "window")
    return found.unionByName(dealt.mapInArrow(_streamed, DIGESTS))
