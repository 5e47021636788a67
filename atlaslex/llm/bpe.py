"""Byte-level BPE encoding with reuse of content-defined chunks, and decoding.

A rolling hash over the last ``WINDOW`` bytes cuts texts into chunks of about ``CHUNK`` bytes. Cuts depend on nearby bytes only,
so copies and shared passages give the same chunks wherever they stand, and a chunk is encoded once: each Python worker
keeps the ids of its chunks, up to a bound, those that come again longest. No text is shuffled for it, and a chunk that
very many documents share is no hot key.

Chunks do not end where tokens end, so the joins are repaired. The pre-tokenizer's pattern never puts an ASCII character that is
no space and a following blank or line break into one piece, whatever stands around them: at such a place the encoding of a chunk
and of the whole text have the same boundary. The ids of a chunk are taken between its first and its last such
place; what lies between the last one and the first of the next chunk is encoded again as one text. Where a chunk has none, the join
grows over the next chunks until both sides agree. So the ids are those of the whole text.

Added tokens are cut out first, as the tokenizer does; the text between them is encoded on its own.

The vocabulary is read from a ``tokenizer.json`` whose path is a parameter. Text up to U+04FF, whose letter and number
classes do not differ between versions of Unicode, is merged by ``tiktoken`` with that file's own ranks; pieces with other
characters go through the ``tokenizers`` library itself, so that both agree on every character.

Defined cases: a null or empty text has no ids and decodes to an empty text; null ids decode to an empty text; ids outside of
the vocabulary decode to nothing. Equal texts have equal ids. Extra columns pass through. Texts may have any length, with or
without blanks: memory follows the longest one. An empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from codecs import getincrementaldecoder
from functools import cache, cached_property
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from atlaslex.llm.batches import PIECE_BYTES, arrow_function, cut, text_bytes, text_function

#: The pattern of byte-level BPE pre-tokenizers with ``use_regex``; a fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

WINDOW, CHUNK = 16, 512
MULTIPLIER = 0x9E3779B97F4A7C15

#: Bytes of one generation of kept chunks, objects and table included. A worker holds two of them.
CACHE_BYTES = 12 << 20
#: What an entry takes beside the bytes of text and ids: two objects, a tuple and its place in the table.
ENTRY_BYTES = 400

#: Ids that are written and decoded at once.
DIGESTED = 1 << 16

#: Bytes after which a text that is only counted is cut at the next place of agreement.
COUNTED = 1 << 16

AGREEMENT = re.compile(rb"[!-~](?=[ \n])")
RARE = re.compile(rb"[\xd4-\xff]")
#: Blanks in a run that is left to the library: the other one's pattern goes back over a run, and its stack has an end.
BLANKS = re.compile(rb"(?:[\t-\r\x1c-\x20]|\xc2[\x85\xa0]){4096}")

NO_IDS = np.array([], dtype=np.int32)


def default_path() -> str:
    """The byte-level vocabulary that is installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable ones stand for themselves, others follow from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Kept:
    """Values by text in two generations: when the young one is full it becomes the old one, which is then forgotten.

    What is met again moves to the young one, so texts that keep coming stay, and memory never exceeds two generations.
    """

    def __init__(self, limit: int):
        self.limit, self.held = limit, 0
        self.young: dict[bytes, tuple] = {}
        self.old: dict[bytes, tuple] = {}

    def get(self, text: bytes):
        found = self.young.get(text)
        if found is None:
            found = self.old.get(text)
            if found is not None:
                self.put(text, *found)
        return None if found is None else found[0]

    def put(self, text: bytes, value, size: int) -> None:
        whole = len(text) + size + ENTRY_BYTES
        if whole > self.limit:
            return
        if self.held + whole > self.limit:
            self.old, self.young, self.held = self.young, {}, 0
        self.young[text] = value, size
        self.held += whole


class Vocabulary:
    """One ``tokenizer.json``: merges through ranks, pieces with rare characters through its own library."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        before, model = spec["pre_tokenizer"] or {}, spec["model"]
        plain = spec["normalizer"] is None and before.get("type") == "ByteLevel" and model["type"] == "BPE"
        if not plain or before.get("add_prefix_space") or not before.get("use_regex", True):
            raise ValueError(f"{path} is no plain byte-level BPE")
        self.path = path
        self.added = {token["content"].encode(): token["id"] for token in spec["added_tokens"]}
        if any(token[flag] for token in spec["added_tokens"] for flag in ("lstrip", "rstrip", "single_word")):
            raise ValueError(f"{path}: added tokens that take blanks or words are not supported")
        letters = byte_letters()
        ranks = {bytes(letters[c] for c in t): i for t, i in model["vocab"].items() if t.encode() not in self.added}
        merged = [(m if isinstance(m, str) else " ".join(m)).replace(" ", "") for m in model["merges"]]
        if [model["vocab"][t] for t in merged] != sorted(model["vocab"][t] for t in merged):
            raise ValueError(f"{path}: ids are not in the order of the merges")
        self.ranks = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        longest = sorted(self.added, key=len, reverse=True)
        self.split = re.compile(b"(" + b"|".join(map(re.escape, longest)) + b")") if longest else None
        # For decoding: all tokens as one run of bytes, and where each begins. The last entry stands for unknown ids.
        tokens = {i: t for t, i in (ranks | self.added).items()}
        sizes = [len(tokens.get(i, b"")) for i in range(max(tokens) + 1)] + [0]
        self.sizes = np.array(sizes, dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(tokens.get(i, b"") for i in range(len(sizes) - 1)), dtype=np.uint8)
        self.chunks, self.joins = Kept(CACHE_BYTES), Kept(CACHE_BYTES // 4)
        self.seen = self.reused = 0

    @cached_property
    def library(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def encode_piece(self, text: bytes) -> np.ndarray:
        """Ids of a text without added tokens, without reuse."""
        if not text:
            return NO_IDS
        if RARE.search(text) or (len(text) > 4096 and BLANKS.search(text)):
            return np.array(self.library.encode(text.decode(), add_special_tokens=False).ids, dtype=np.int32)
        return np.array(self.ranks.encode_ordinary(text.decode()), dtype=np.int32)

    def chunk(self, text: bytes) -> tuple[int, int, np.ndarray]:
        """First and last place of agreement in a chunk (-1: none) and the ids between them."""
        self.seen += 1
        found = self.chunks.get(text)
        if found is not None:
            self.reused += 1
            return found
        first = AGREEMENT.search(text)
        if first is None:
            found = (-1, -1, NO_IDS)
        else:
            start = end = first.end()
            for match in AGREEMENT.finditer(text, max(start, len(text) - 64)):
                end = match.end()
            if end == start:
                for match in AGREEMENT.finditer(text, start):
                    end = match.end()
            found = (start, end, self.encode_piece(text[start:end]))
        self.chunks.put(text, found, found[2].nbytes)
        return found

    def join(self, text: bytes) -> np.ndarray:
        """Ids between two places of agreement."""
        found = self.joins.get(text)
        if found is None:
            found = self.encode_piece(text)
            if len(text) < 64:
                self.joins.put(text, found, found.nbytes)
        return found

    def encode_segment(self, text: bytes, cuts: list[int]) -> list[np.ndarray]:
        """Ids of a text without added tokens, from its chunks."""
        done, open_join, start = [], [], 0
        for end in [*cuts, len(text)]:
            piece = text[start:end]
            start = end
            first, last, ids = self.chunk(piece)
            if first < 0:
                open_join.append(piece)
                continue
            done += (self.join(b"".join([*open_join, piece[:first]])), ids)
            open_join = [piece[last:]]
        done.append(self.join(b"".join(open_join)))
        return done

    def encode(self, text: bytes, cuts: list[int]) -> list[np.ndarray]:
        """Ids of a text; ``cuts`` are the ends of its chunks but the last."""
        if self.split is None or not self.split.search(text):
            return self.encode_segment(text, cuts)
        done, start = [], 0
        for part in self.split.split(text):
            end = start + len(part)
            if part in self.added:
                done.append(np.array([self.added[part]], dtype=np.int32))
            elif part:
                done += self.encode_segment(part, [c - start for c in cuts if start < c < end])
            start = end
        return done

    def count(self, text: bytes) -> int:
        """How many ids a text has; pieces end at places of agreement, so no list of all ids is made."""
        total = 0
        for part in self.split.split(text) if self.split else [text]:
            if part in self.added:
                total += 1
                continue
            start = 0
            while start < len(part):
                end = AGREEMENT.search(part, start + COUNTED)
                end = end.end() if end else len(part)
                total += len(self.encode_piece(part[start:end]))
                start = end
        return total

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of a run of ids, and how many each id has."""
        unknown = len(self.sizes) - 1
        known = np.where((ids < 0) | (ids > unknown), unknown, ids)
        sizes = self.sizes[known]
        ends = np.cumsum(sizes)
        places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[known] - (ends - sizes), sizes)
        return self.bytes[places], sizes


@cache
def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a file, read once per Python worker."""
    return Vocabulary(path)


def chunk_ends(texts: list[bytes]) -> list[list[int]]:
    """Places inside each text where the rolling hash cuts it; all texts of a piece at once."""
    whole = np.frombuffer(b"".join(texts), dtype=np.uint8)
    lengths = np.array([len(text) for text in texts])
    if len(whole) <= WINDOW:
        return [[] for _ in texts]
    # The hash of 2 n bytes from those of n bytes, up to the window.
    rolled, width, factor = whole.astype(np.uint64), 1, MULTIPLIER
    while width < WINDOW:
        longer = rolled.copy()
        longer[width:] += rolled[:-width] * np.uint64(factor)
        rolled, width, factor = longer, 2 * width, factor * factor % 2**64
    mixed = (rolled ^ (rolled >> np.uint64(29))) * np.uint64(MULTIPLIER)
    places = np.flatnonzero(mixed >> np.uint64(64 - CHUNK.bit_length() + 1) == 0) + 1
    # Only hashes of bytes of one text count.
    ends = np.cumsum(lengths)
    starts = ends - lengths
    of = np.searchsorted(ends, places, side="left")
    of = np.minimum(of, len(texts) - 1)
    inside = (places - starts[of] >= WINDOW) & (places < ends[of])
    places, of = places[inside], of[inside]
    inner = places - starts[of]
    bounds = np.searchsorted(of, np.arange(len(texts) + 1))
    return [inner[bounds[i] : bounds[i + 1]].tolist() for i in range(len(texts))]


def encode_texts(texts: list[bytes], path: str) -> pa.ListArray:
    """The ids of each text."""
    known = vocabulary(path)
    parts, counts = [NO_IDS], [0]
    for text, cuts in zip(texts, chunk_ends(texts), strict=True):
        ids = known.encode(text, cuts)
        parts += ids
        counts.append(sum(map(len, ids)))
    return pa.ListArray.from_arrays(pa.array(np.cumsum(counts), pa.int32()), pa.array(np.concatenate(parts), pa.int32()))


def decode_lists(ids: pa.ListArray, path: str) -> pa.StringArray:
    """The text of each list of ids; bytes that are no UTF-8 become replacement characters."""
    known = vocabulary(path)
    counts = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
    data, sizes = known.decode(np.asarray(pc.list_flatten(ids).to_numpy(zero_copy_only=False), dtype=np.int64))
    after = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)])]
    raw = data.tobytes()
    return pa.array([raw[a:b].decode("utf-8", "replace") for a, b in zip(after, after[1:], strict=False)], pa.string())


def token_counter(path: str):
    """UTF-8 bytes -> how many ids they have."""

    def run(texts: pa.Array) -> pa.Array:
        known = vocabulary(path)
        return pa.array([known.count(text.as_py()) for text in texts], pa.int64())

    return arrow_function(run, LongType())


def encoder(path: str):
    """UTF-8 bytes -> ids."""

    def run(texts: pa.Array) -> pa.Array:
        done = [pa.array([], pa.list_(pa.int32()))]
        for start, end in cut(pc.binary_length(texts).to_pylist()):
            done.append(encode_texts(texts.slice(start, end - start).to_pylist(), path).cast(done[0].type))
        return pa.concat_arrays(done)

    return arrow_function(run, ArrayType(IntegerType()))


def decoder(path: str):
    """Ids -> text."""

    def run(ids: pa.Array) -> pa.Array:
        done = [pa.array([], pa.string())]
        for start, end in cut(pc.fill_null(pc.list_value_length(ids), 0).to_pylist(), PIECE_BYTES // 4):
            done.append(decode_lists(ids.slice(start, end - start), path))
        return pa.concat_arrays(done)

    return arrow_function(run, StringType())


def encode(docs: DataFrame, path: str | None = None, text: str = "text", ids: str = "ids") -> DataFrame:
    """Adds the ids of a text column; texts do not move."""
    return docs.withColumn(ids, encoder(path or default_path())(text_bytes(text)))


def decode(rows: DataFrame, path: str | None = None, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Adds the text of a column of ids."""
    return rows.withColumn(text, decoder(path or default_path())(F.col(ids)))


DIGESTS = StructType([StructField("n", LongType()), StructField("ids", StringType()), StructField("text", StringType())])


def _blocks(runs: list[np.ndarray]) -> Iterator[np.ndarray]:
    """The same ids in blocks of about ``DIGESTED``."""
    start, held = 0, 0
    for i, run in enumerate(runs):
        held += len(run)
        if held >= DIGESTED:
            yield np.concatenate(runs[start : i + 1])
            start, held = i + 1, 0
    if held:
        yield np.concatenate(runs[start:])


def digest(text: bytes, cuts: list[int], known: Vocabulary) -> tuple[int, str, str]:
    """Number of ids, and the SHA-256 of the ids in decimal and of the text decoded from them, block by block."""
    ids, decoded, reader = sha256(), sha256(), getincrementaldecoder("utf-8")("replace")
    n = 0
    for block in _blocks(known.encode(text, cuts)):
        ids.update(b"," * bool(n) + ",".join(map(str, block.tolist())).encode())
        decoded.update(reader.decode(known.decode(block)[0].tobytes()).encode())
        n += len(block)
    decoded.update(reader.decode(b"", True).encode())
    return n, ids.hexdigest(), decoded.hexdigest()


def digester(path: str):
    """UTF-8 bytes -> digests, without a column of ids: one worker, one vocabulary, and never more than one text's runs."""

    def run(texts: list[bytes]) -> dict:
        known = vocabulary(path)
        rows = [digest(text, cuts, known) for text, cuts in zip(texts, chunk_ends(texts), strict=True)]
        return dict(zip(DIGESTS.names, zip(*rows, strict=True), strict=True))

    return text_function(DIGESTS, run)


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id``, ``n_tokens`` and the SHA-256 of the ids in decimal and of the text decoded from them."""
    found = docs.select("doc_id", digester(path or default_path())(text_bytes()).alias("d"))
    return found.select("doc_id", F.col("d.n").alias("n_tokens"), F.col("d.ids").alias("ids_sha256"), F.col("d.text").alias("decoded_sha256"))
