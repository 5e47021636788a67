"""A log-bilinear language model, trained with noise-contrastive estimation and normalised exactly.

The score of a token after the two tokens before it is bilinear: ``(c1 * r(w1) + c2 * r(w2)) . q(w) + b(w)``. Training never
normalises: real tokens are told from ``NOISE`` tokens drawn from the unigram distribution (noise-contrastive estimation). For scoring,
the exponential of the sum is a product of two factors, so the normalisers of all pairs of contexts are one matrix product
``exp(S1) exp(S2)^T``, computed once per worker; a token's log-probability is then three look-ups.

Vocabulary: the ``WORDS`` most frequent words of the training documents and the end have classes of their own. All other
words share ``RARE`` classes by their last letters, and a word's probability is that of its class times that within the class.
Within a class, every word of ``SELDOM`` training occurrences or more (``KNOWN`` words at most, as they go to every task) has a vector too, so
the vocabulary that is learned grows with the corpus. Its probability there is its smoothed count times ``exp(x(w1) . u(w))``, divided by
the exact sum of these products over the class, times the share that the counts give to such words. ``u`` starts at 0, which is the
probability by counts alone, and is trained by telling words from ``NOISE_WITHIN`` words drawn from the same class by count.
Words without a vector have the probability of their smoothed count over all training documents, unseen words together that of one
more word. So the probabilities of all words add up to one. As context, a word without a class of its own counts as its class.

Scale: counts are aggregated over all training documents; the ``KNOWN`` most frequent words (a bound) go to every task, and only
the others are shuffled, once for counting and once for looking up their counts. All training documents train: every Spark
task fits its share from common values, and the values are averaged, weighted by tokens, by a grouped sum; this is done
``ROUNDS`` times over different documents. What tasks give back does not grow with their share, and the driver only gets the average.

Defined cases: a null or empty text is one token, the end. Documents are held out if crc32 of ``doc_id`` as text is divisible
by ten; a null id counts as empty text, whose crc32 is 0. Repeated rows train and score like any others. Without training
documents all counts are 0 and the model is that of equal classes. Extra columns are not read. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections import Counter
from functools import cached_property
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type

from atlaslex.llm.batches import LOWER_CASE, arrow_function, cut, text_bytes
from atlaslex.staging import stage

WORDS, RARE = 2000, 48
KNOWN, KNOWN_BYTES = 1 << 18, 256
SIZE = 16
ROUNDS = 2
NOISE, BATCH, RATE = 64, 4096, 0.1
SMOOTH = 0.1
SELDOM = 10
INNER, NOISE_WITHIN, RATE_WITHIN = 8, 32, 0.15

#: Classes: the end, the rare ones, then the words; the last row of contexts is the start of a text.
END, FIRST_RARE, FIRST_WORD = 0, 1, 1 + RARE
CLASSES = 1 + RARE + WORDS
START = CLASSES

#: Values are kept in rows of ``INNER``: first the model of classes, then contexts within classes, then words within classes.
SHARED = (2 * CLASSES + 1) * SIZE + CLASSES + 2 * SIZE
CONTEXT_ROW = -(-SHARED // INNER)
WORD_ROW = CONTEXT_ROW + CLASSES + 1

#: Different words that one task of the count holds before it hands them on.
HELD_WORDS = 200_000


def held_out() -> Column:
    """True for the documents that are not trained on."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 10 == 0


def tokens(text: bytes) -> list[bytes]:
    """Lower-cased words (A-Z) between white space."""
    return text.translate(LOWER_CASE).split()


def rare_class(word: bytes) -> int:
    """Class of a word that has none of its own, by its last two bytes."""
    return FIRST_RARE + (word[-1] * 31 + (word[-2] if len(word) > 1 else 0) * 7) % RARE


def _count_words(batches):
    held: Counter = Counter()

    def rows():
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

    for batch in batches:
        for text in batch.column("text"):
            held.update(tokens(text.as_py()))
            if len(held) > HELD_WORDS:
                yield rows()
                held.clear()
    if held:
        yield rows()


def word_counts(training: DataFrame) -> DataFrame:
    """``word`` (bytes) and ``n`` over the training documents, staged."""
    parts = training.select(text_bytes().alias("text")).mapInArrow(_count_words, "word binary, n long")
    return stage(parts.groupBy("word").agg(F.sum("n").alias("n")), "word-counts")


class Lexicon:
    """What tasks know of the counts: the most frequent words, and the sums over rare classes."""

    def __init__(self, known: list[tuple[bytes, int]], ends: int, total: int, different: int, rare: dict[int, tuple[int, int]]):
        self.words = [word for word, _ in known]
        self.counts = np.array([n for _, n in known] + [0], dtype=np.float64)
        self.ends, self.total, self.different = ends, total, different
        self.classes = np.array(
            [FIRST_WORD + i if i < WORDS else rare_class(word) for i, word in enumerate(self.words)] + [-1], dtype=np.int32
        )
        sums = np.array([rare.get(c, (0, 0)) for c in range(FIRST_RARE, FIRST_WORD)], dtype=np.float64).reshape(-1, 2)
        self.rare_norm = np.log10(sums[:, 0] + SMOOTH * (sums[:, 1] + 1))
        mass = np.zeros(CLASSES)
        mass[END] = ends
        mass[FIRST_RARE:FIRST_WORD] = sums[:, 0]
        mass[FIRST_WORD : FIRST_WORD + min(WORDS, len(known))] = self.counts[: min(WORDS, len(known))]
        self.unigram = (mass + SMOOTH) / (mass + SMOOTH).sum()
        # Words with a vector within their class, in the order of the classes.
        several = WORDS + int((self.counts[WORDS:-1] >= SELDOM).sum())
        order = np.argsort(self.classes[WORDS:several], kind="stable")
        self.rows = np.full(len(self.classes), -1, dtype=np.int32)
        self.rows[WORDS + order] = np.arange(len(order))
        self.row_mass = self.counts[WORDS:][order] + SMOOTH
        self.row_bounds = np.searchsorted(self.classes[WORDS:several][order], np.arange(FIRST_RARE, FIRST_WORD + 1))

    @cached_property
    def index(self) -> dict[bytes, int]:
        return {word: i for i, word in enumerate(self.words)}

    def look_up(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Place among the known words (-1: none) and class of each word."""
        places = np.fromiter(map(self.index.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        classes = self.classes[places]
        for i in np.flatnonzero(places < 0).tolist():
            classes[i] = rare_class(words[i])
        return places, classes


def lexicon(counts: DataFrame, documents: int) -> Lexicon:
    """The bounded part of the counts: ``KNOWN`` words of at most ``KNOWN_BYTES`` bytes, and one row per rare class."""
    sums = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("words")).first()
    short = counts.where(F.octet_length("word") <= KNOWN_BYTES)
    top = short.orderBy(F.desc("n"), "word").limit(KNOWN).toArrow()
    known = list(zip(top.column("word").to_pylist(), top.column("n").to_pylist(), strict=True))
    # rare_class() of all words, as columns.
    ends = F.hex(F.expr("substring(word, -2, 2)"))
    last = F.conv(F.substring(ends, -2, 2), 16, 10).cast("int")
    before = F.when(F.octet_length("word") > 1, F.conv(F.substring(ends, 1, 2), 16, 10).cast("int")).otherwise(0)
    rare = FIRST_RARE + (last * 31 + before * 7) % RARE
    classes = counts.groupBy(rare.alias("class")).agg(F.sum("n").alias("n"), F.count("*").alias("words"))
    found = {row["class"]: [row["n"], row["words"]] for row in classes.collect()}
    for word, n in known[:WORDS]:
        entry = found[rare_class(word)]
        entry[0] -= n
        entry[1] -= 1
    return Lexicon(known, documents, sums["n"] + documents, sums["words"] + (documents > 0), {c: tuple(v) for c, v in found.items()})


class Within:
    """Vectors of contexts and words that shift the probabilities of words within their class."""

    def __init__(self, values: np.ndarray, known: Lexicon):
        self.contexts, self.words = values[CONTEXT_ROW:WORD_ROW], values[WORD_ROW:]
        self.bounds, self.mass = known.row_bounds, known.row_mass

    def learn(self, rows: np.ndarray, w1: np.ndarray, rng: np.random.Generator, seen: Within) -> None:
        """One step of noise-contrastive estimation in every class, over the tokens whose words have a vector."""
        order = np.argsort(rows, kind="stable")
        rows, w1 = rows[order], w1[order]
        cuts = np.searchsorted(rows, self.bounds)
        log_noise = np.float32(np.log(NOISE_WITHIN))
        for c in np.flatnonzero(np.diff(cuts)).tolist():
            real_rows, at = rows[cuts[c] : cuts[c + 1]], w1[cuts[c] : cuts[c + 1]]
            edges = np.cumsum(self.mass[self.bounds[c] : self.bounds[c + 1]])
            drawn = np.searchsorted(edges, rng.random(NOISE_WITHIN) * edges[-1])
            noise = self.bounds[c] + np.minimum(drawn, len(edges) - 1)
            x, u, u_noise = self.contexts[at], self.words[real_rows], self.words[noise]
            real = 1 - _sigmoid((x * u).sum(axis=1) - log_noise)
            false = -_sigmoid(x @ u_noise.T - log_noise)
            _add(self.contexts, at, real[:, None] * u + false @ u_noise, seen.contexts, RATE_WITHIN)
            gradients = np.concatenate([real[:, None] * x, false.T @ x])
            _add(self.words, np.concatenate([real_rows, noise]), gradients, seen.words, RATE_WITHIN)

    def log_sums(self, c: int) -> np.ndarray:
        """For every context, the log of the mean of ``exp(x . u)`` over the words of a class by their counts."""
        sums = np.zeros(len(self.contexts))
        low, high = self.bounds[c], self.bounds[c + 1]
        for start in range(low, high, 1024):
            end = min(start + 1024, high)
            sums += np.exp(self.contexts @ self.words[start:end].T) @ self.mass[start:end]
        return np.log(sums / self.mass[low:high].sum()) if high > low else sums

    def log_shifts(self, rows: np.ndarray, classes: np.ndarray, w1: np.ndarray, log_sums: np.ndarray) -> np.ndarray:
        """What the contexts add to the logs of the probabilities within the classes; rows are those of words with a vector."""
        products = np.einsum("ij,ij->i", self.contexts[w1], self.words[rows])
        return products.astype(np.float64) - log_sums[classes - FIRST_RARE, w1]


class Model:
    """Parameters as one vector: contexts, tokens, biases and the weights of the two positions."""

    def __init__(self, values: np.ndarray):
        self.values = values
        parts = np.split(values, np.cumsum([(CLASSES + 1) * SIZE, CLASSES * SIZE, CLASSES, SIZE]))
        self.contexts, self.outputs = parts[0].reshape(-1, SIZE), parts[1].reshape(-1, SIZE)
        self.bias, self.near, self.far = parts[2], parts[3], parts[4]

    @classmethod
    def start(cls, unigram: np.ndarray) -> Model:
        """Small vectors from a fixed seed, and biases that make it the unigram model."""
        rng = np.random.default_rng(17)
        vectors = rng.normal(0, 0.1, (2 * CLASSES + 1) * SIZE)
        ends = np.concatenate([vectors, np.log(unigram), np.full(SIZE, 1.0), np.full(SIZE, 0.5)])
        return cls(ends.astype(np.float32))

    def learn(self, w: np.ndarray, w1: np.ndarray, w2: np.ndarray, noise: np.ndarray, log_noise: np.ndarray, seen: Model) -> None:
        """One step of noise-contrastive estimation; ``seen`` holds the squared gradients so far, which scale the steps."""
        r1, r2, q = self.contexts[w1], self.contexts[w2], self.outputs[w]
        h = r1 * self.near + r2 * self.far
        real = 1 - _sigmoid((h * q).sum(axis=1) + self.bias[w] - log_noise[w])
        q_noise = self.outputs[noise]
        false = -_sigmoid(h @ q_noise.T + self.bias[noise] - log_noise[noise])
        dh = real[:, None] * q + false @ q_noise
        self._add("outputs", np.concatenate([w, noise]), np.concatenate([real[:, None] * h, false.T @ h]), seen)
        self._add("bias", np.concatenate([w, noise]), np.concatenate([real, false.sum(axis=0)]), seen)
        self._add("contexts", np.concatenate([w1, w2]), np.concatenate([dh * self.near, dh * self.far]), seen)
        for name, gradient in (("near", (dh * r1).sum(axis=0)), ("far", (dh * r2).sum(axis=0))):
            getattr(seen, name)[:] += gradient**2
            getattr(self, name)[:] += RATE * gradient / np.sqrt(getattr(seen, name) + 1e-6)

    def _add(self, name: str, rows: np.ndarray, gradients: np.ndarray, seen: Model) -> None:
        _add(getattr(self, name), rows, gradients, getattr(seen, name), RATE)

    @cached_property
    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores by the near and by the far context, and the log of the sum over all tokens for every pair of contexts."""
        out = self.outputs.astype(np.float64).T
        near = (self.contexts * self.near).astype(np.float64) @ out
        far = (self.contexts * self.far).astype(np.float64) @ out + self.bias
        top_near, top_far = near.max(axis=1, keepdims=True), far.max(axis=1, keepdims=True)
        sums = np.exp(near - top_near) @ np.exp(far - top_far).T
        whole = np.log(np.maximum(sums, 1e-300)) + top_near + top_far.T
        return near.astype(np.float32), far.astype(np.float32), whole.astype(np.float32)

    def log_probabilities(self, w: np.ndarray, w1: np.ndarray, w2: np.ndarray) -> np.ndarray:
        """Natural logarithms of the probabilities of classes ``w`` after ``w1`` and, before it, ``w2``."""
        near, far, whole = self.tables
        return near[w1, w].astype(np.float64) + far[w2, w] - whole[w1, w2]


def _add(values: np.ndarray, rows: np.ndarray, gradients: np.ndarray, seen: np.ndarray, rate: float) -> None:
    """Adds the gradients of each row, in steps scaled by the squared gradients that the row has seen."""
    # Numbers of 16 bits are sorted by their digits, in linear time.
    order = np.argsort(rows.astype(np.int16) if len(values) < 1 << 15 else rows, kind="stable")
    ordered = rows[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    sums, at = np.add.reduceat(gradients[order], first, axis=0), ordered[first]
    seen[at] += sums**2
    values[at] += rate * sums / np.sqrt(seen[at] + 1e-6)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(np.minimum(np.maximum(-x, -30), 30)))


def _sequence(classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The classes of a text and its end, each with the two before it."""
    whole = np.concatenate([[START, START], classes, [END]]).astype(np.int32)
    return whole[2:], whole[1:-1], whole[:-2]


def start_values(known: Lexicon) -> np.ndarray:
    """The values before training: classes by their counts, and words within classes by theirs."""
    values = np.zeros((WORD_ROW + len(known.row_mass), INNER), dtype=np.float32)
    shared_part(values)[:] = Model.start(known.unigram).values
    values[CONTEXT_ROW:WORD_ROW] = np.random.default_rng(19).normal(0, 0.3, (CLASSES + 1, INNER))
    return values


def shared_part(values: np.ndarray) -> np.ndarray:
    """The values of the model of classes, as a view."""
    return values[:CONTEXT_ROW].reshape(-1)[:SHARED]


FITTED = [f"v{i}" for i in range(INNER)]


def _trainer(shared, number: int):
    """Fits the values to the texts of a task and gives them back in rows, each with the tokens seen as its weight.

    A word within a class weighs its own tokens; one that the task did not see is not given back.
    """

    def run(batches):
        values, known = shared.value
        values, steps = values.copy(), np.zeros_like(values)
        steps[CONTEXT_ROW:] = 1  # short steps for what is seen seldom
        model, seen = Model(shared_part(values)), Model(shared_part(steps))
        within, seen_within = Within(values, known), Within(steps, known)
        weights = np.zeros(len(values), dtype=np.int64)
        rng = np.random.default_rng(101 + number)
        log_noise = np.log(NOISE * known.unigram).astype(np.float32)
        edges = np.cumsum(known.unigram)
        waiting, held, trained = [], 0, 0

        def learn(parts):
            w, w1, w2, rows = (np.concatenate([p[i] for p in parts]) for i in range(4))
            for start in range(0, len(w), BATCH):
                end = start + BATCH
                noise = np.minimum(np.searchsorted(edges, rng.random(NOISE)), CLASSES - 1)
                model.learn(w[start:end], w1[start:end], w2[start:end], noise, log_noise, seen)
            in_class = rows >= 0
            within.learn(rows[in_class], w1[in_class], rng, seen_within)
            np.add.at(weights, WORD_ROW + rows[in_class], 1)
            return len(w)

        for batch in batches:
            for text in batch.column("text"):
                places, classes = known.look_up(tokens(text.as_py()))
                waiting.append((*_sequence(classes), np.append(known.rows[places], -1)))
                held += len(waiting[-1][0])
                if held >= 16 * BATCH:
                    trained += learn(waiting)
                    waiting, held = [], 0
        if waiting:
            trained += learn(waiting)
        weights[:WORD_ROW] = trained
        slots = np.flatnonzero(weights)
        for part in np.array_split(slots, len(slots) // (1 << 15) + 1):
            columns = [pa.array(part), *(pa.array(column) for column in values[part].T), pa.array(weights[part])]
            yield pa.RecordBatch.from_arrays(columns, names=["slot", *FITTED, "weight"])

    return run


def train(training: DataFrame, known: Lexicon) -> np.ndarray:
    """The values of the model after ``ROUNDS`` rounds of local fits and weighted averages."""
    context = training.sparkSession.sparkContext
    values = start_values(known)
    schema = f"slot long, {', '.join(f'{name} float' for name in FITTED)}, weight long"
    means = [(F.sum(F.col(name) * F.col("weight")) / F.sum("weight")).alias(name) for name in FITTED]
    part = F.pmod(F.floor(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) / 10), F.lit(ROUNDS))
    for number in range(ROUNDS):
        share = training.where(part == number).select(text_bytes().alias("text"))
        shared = context.broadcast((values, known))
        fitted = share.mapInArrow(_trainer(shared, number), schema)
        average = fitted.groupBy("slot").agg(*means).toArrow()
        shared.destroy()  # workers would keep the words of every round
        if average.num_rows:
            values = values.copy()
            for i, name in enumerate(FITTED):
                values[average.column("slot").to_numpy(), i] = np.round(average.column(name).to_numpy(), 6)
    return values


def log_sums(spark: SparkSession, values: np.ndarray, known: Lexicon) -> np.ndarray:
    """The normalisers within classes: one row for each class, one column for each context; a task for each class."""
    shared = spark.sparkContext.broadcast((values, known))

    def of_classes(batches):
        within = Within(*shared.value)
        for batch in batches:
            found = [within.log_sums(c) for c in batch.column("id").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, pa.list_(pa.float64()))], names=["id", "sums"])

    rows = spark.range(0, RARE, 1, RARE).mapInArrow(of_classes, "id long, sums array<double>").collect()
    shared.destroy()
    return np.array([row["sums"] for row in sorted(rows)])


SCORED = pa.struct(
    [
        ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("model", pa.float64()),
        ("unknown", pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())]))),
    ]
)


def _scorer(shared):
    """Sums over the words that tasks know, and the other words with their numbers."""

    def run(texts: pa.Array) -> pa.Array:
        fitted = shared.value
        known, model, within = fitted.known, fitted.model, fitted.within
        log_counts = np.log10(known.counts + SMOOTH)
        end_count = np.log10(known.ends + SMOOTH)
        out = {name: [] for name in ("n_tokens", "n_known", "base", "model", "unknown")}
        for text in texts:
            words = tokens(text.as_py())
            places, classes = known.look_up(words)
            found = places >= 0
            counted = np.where(found, log_counts[places], 0.0)
            rare = (classes >= FIRST_RARE) & (classes < FIRST_WORD)
            out["n_tokens"].append(len(words) + 1)
            out["n_known"].append(int(found.sum()) + (known.ends > 0))
            out["base"].append(float(counted.sum() + end_count))
            by_counts = counted[rare].sum() - known.rare_norm[classes[rare] - FIRST_RARE].sum()
            w, w1, w2 = _sequence(classes)
            rows = known.rows[places]
            own = np.flatnonzero(rows >= 0)
            logs = model.log_probabilities(w, w1, w2).sum() + within.log_shifts(rows[own], w[own], w1[own], fitted.log_sums).sum()
            out["model"].append(float(logs / np.log(10) + by_counts))
            others = Counter(words[i] for i in np.flatnonzero(~found).tolist())
            out["unknown"].append([{"word": word, "n": n} for word, n in others.items()])
        columns = [pa.array(out[field.name], field.type) for field in SCORED]
        return pa.StructArray.from_arrays(columns, fields=list(SCORED))

    def in_pieces(texts: pa.Array) -> pa.Array:
        sizes = pa.compute.binary_length(texts).to_pylist()
        return pa.concat_arrays([pa.array([], SCORED), *(run(texts.slice(a, b - a)) for a, b in cut(sizes))])

    return arrow_function(in_pieces, from_arrow_type(SCORED))


class Fitted:
    """What scoring needs. Workers keep the broadcast object, so its tables are computed once for each."""

    def __init__(self, values: np.ndarray, known: Lexicon, log_sums: np.ndarray):
        self.values, self.known, self.log_sums = values, known, log_sums

    @cached_property
    def model(self) -> Model:
        return Model(shared_part(self.values))

    @cached_property
    def within(self) -> Within:
        return Within(self.values, self.known)


def score(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` of every document.

    Scores are log10 probabilities: ``base_score`` by smoothed counts alone, ``score`` by the model.
    """
    context = docs.sparkSession.sparkContext
    training = docs.select("doc_id", "text").where(~held_out())
    counts = word_counts(training)
    known = lexicon(counts, training.count())
    values = train(training, known)
    shared = context.broadcast(Fitted(values, known, log_sums(docs.sparkSession, values, known)))
    scored = docs.select("doc_id", held_out().alias("held_out"), _scorer(shared)(text_bytes()).alias("s"))
    rows = stage(scored.select(F.monotonically_increasing_id().alias("row"), "doc_id", "held_out", "s.*"), "scored")
    others = rows.select("row", F.explode("unknown").alias("u")).select("row", "u.word", F.col("u.n").alias("times"))
    looked_up = others.join(counts, "word", "left").groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + SMOOTH)).alias("logs"),
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("counted"),
    )
    logs, counted = F.coalesce("logs", F.lit(0.0)), F.coalesce("counted", F.lit(0))
    norm = float(np.log10(known.total + SMOOTH * (known.different + 1)))
    return rows.drop("unknown").join(looked_up, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + counted).alias("n_known"),
        F.lit(known.total).cast("long").alias("train_tokens"),
        (F.col("base") + logs - F.col("n_tokens") * norm).alias("base_score"), (F.col("model") + logs).alias("score"),
    )
