"""Packing of token sequences: length patterns fitted by non-negative least squares."""

from __future__ import annotations

import bisect
import os
import zlib
from array import array
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from meterlens.llm.common import documents, map_batches, number_rows, stored
from meterlens.llm.words import WordHasher, slices

SEQUENCE = 2048
MARKS = ".,;:!?#$%&*+-=/()[]{}\"_~^@`"  # never part of a token with letters
END = 0  # id after each document
TOKENIZER = "word_bpe_49k.json"
TRIPLE_LENGTHS = 24  # first lengths of the three-document patterns
SWEEPS = 15  # of coordinate descent
CACHE_WORDS = 800_000  # words whose ids a worker keeps, in two generations
CACHE_MARKS = 10_000  # runs of marks whose ids are kept besides
TEXT_BYTES = 1 << 21  # of text worked on at once
LETTERS = [c for c in map(chr, range(0x250)) if c.isalpha()]  # none of these joins the next

Pattern = tuple[int, ...]


def equal_words(data: bytes, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each word of ``data`` the number of one that equals it, mostly the same one for all
    equal words. Hashes propose it, the bytes decide."""
    own = np.arange(len(hashes))
    cells = (hashes & np.uint64((1 << (2 * len(hashes)).bit_length()) - 1)).astype(np.int64)
    table = np.empty((1 << (2 * len(hashes)).bit_length()), np.int64)
    table[cells] = own
    same = table[cells]
    rest = np.flatnonzero(hashes[same] != hashes)
    _, first, inverse = np.unique(hashes[rest], return_index=True, return_inverse=True)
    same[rest] = rest[first][inverse]

    lengths = ends - starts
    alike = lengths[same] == lengths
    at = np.flatnonzero(alike & (same != own))
    size = lengths[at]
    place = np.arange(size.sum()) + np.repeat(starts[at] - (np.cumsum(size) - size), size)
    whole = np.frombuffer(data, np.uint8)
    unlike = whole[place] != whole[place + np.repeat(starts[same[at]] - starts[at], size)]
    if unlike.any():
        alike[np.repeat(at, size)[unlike]] = False
    return np.where(alike, same, own)


class WordIds:
    """Ids of texts by way of their words.

    The tokenizer drops white space and never merges across it, so a text's ids are
    those of its words in turn. The distinct words of many texts are found together and
    looked up, and each that isn't known is encoded once.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.model, self.known = Tokenizer.from_file(path), {}
        self.before: dict[bytes, bytes] = {}  # known words of a generation ago
        self.letters: dict[str, bool] = {}
        self.marks: dict[str, bytes] = {}
        self.hasher = WordHasher(b" \t\n\x0b\x0c\r")
        self.merges = self.model.model
        self.written = self._written()
        self.plain = "".join(map(chr, self.written))

    def _written(self) -> dict[int, str]:
        """Letters that stay one letter, and how the model writes them: any run of these is one
        word of the model. None where the tokenizer works otherwise."""
        clean, split = self.model.normalizer, self.model.pre_tokenizer
        if clean is None or split is None:
            return {}
        one = {c: clean.normalize_str(c) for c in LETTERS}
        written = {c: split.pre_tokenize_str(x)[0][0] for c, x in one.items() if len(x) == 1 and self._apart(c)}
        run = split.pre_tokenize_str(clean.normalize_str("".join(written)))
        added = [t.content for t in self.model.get_added_tokens_decoder().values()]
        if [x for x, _ in run] != ["".join(written.values())] or any(not x.strip("".join(written)) for x in added):
            return {}
        return {ord(c): x for c, x in written.items()}

    def encode(self, texts: list[str | bytes | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        coded = [self._lowered(t if isinstance(t, bytes) else (t or "").encode()) for t in texts]
        data = b" ".join(coded)
        hashes, starts, ends = self.hasher(data)
        if not len(hashes):
            return [b""] * len(texts)
        same = equal_words(data, hashes, starts, ends)
        chosen = np.flatnonzero(same == np.arange(len(same)))
        number = np.zeros(len(same), np.int64)
        number[chosen] = np.arange(len(chosen))
        number = number[same]
        ids = self._ids([data[a:b] for a, b in zip(starts[chosen].tolist(), ends[chosen].tolist())])

        count = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        first, count = (np.cumsum(count) - count)[number], count[number]
        stops = np.cumsum(count)
        place = np.arange(stops[-1]) + np.repeat(first - (stops - count), count)
        whole = np.frombuffer(b"".join(ids), np.uint32)[place].tobytes()
        words = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in coded]))
        cuts = 4 * np.concatenate([[0], stops])[np.concatenate([[0], words])]
        return [whole[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]

    @staticmethod
    def _lowered(coded: bytes) -> bytes:
        """A-Z lowered as the tokenizer does, unless special tokens may be there."""
        return coded if b"<|" in coded else coded.lower()

    def _ids(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word."""
        if len(self.known) > CACHE_WORDS // 2:
            self.known, self.before = {}, self.known
        known, before = self.known, self.before
        found, waiting = list(map(known.get, words)), {}
        for i in [i for i, ids in enumerate(found) if ids is None]:
            word = words[i]
            ids = before.get(word)
            if ids is None:
                text = word.decode()
                stem = text.rstrip(MARKS)
                if stem.strip(self.plain) or not stem:
                    waiting[i] = self._parts(text, stem)
                    continue
                ids = self._plain_ids(stem)
                if stem != text:
                    marks = text[len(stem) :]
                    if marks not in self.marks:
                        self._learn([marks], self.marks)
                    ids += self.marks[marks]
            found[i] = known[word] = ids
        coded: dict[str, bytes] = {}
        self._learn(list({p for parts in waiting.values() for p in parts}), coded)
        for i, parts in waiting.items():
            found[i] = known[words[i]] = b"".join(map(coded.__getitem__, parts))
        if len(self.marks) > CACHE_MARKS:
            self.marks = {}
        return found

    def _parts(self, word: str, stem: str) -> list[str]:
        """Letters and the marks after them, which are tokens of their own, or the word."""
        if stem != word and (stem.isascii() and stem.isalpha() or stem and all(map(self._apart, stem))):
            return [stem, word[len(stem) :]]
        return [word]

    def _plain_ids(self, letters: str) -> bytes:
        tokens = self.merges.tokenize(letters.translate(self.written))
        return array("I", [t.id for t in tokens]).tobytes()

    def _apart(self, char: str) -> bool:
        """Whether the tokenizer always parts a character from a mark behind it: what it
        turns some letters into ends with a combining mark, which joins the marks."""
        if char not in self.letters:
            plain = self.model.normalizer.normalize_str(char)
            pieces = self.model.pre_tokenizer.pre_tokenize_str(plain + MARKS)
            whole = [(0, len(plain)), (len(plain), len(plain) + len(MARKS))]
            self.letters[char] = char.isalpha() and [span for _, span in pieces] == whole
        return self.letters[char]

    def _learn(self, parts: list[str], known: dict[str, bytes]) -> None:
        coded = self.model.encode_batch_fast(parts, add_special_tokens=False)
        known.update((p, array("I", c.ids).tobytes()) for p, c in zip(parts, coded, strict=True))


@cache
def word_ids(path: str) -> WordIds:
    """One coder per worker, whose known words serve all its tasks."""
    return WordIds(path)


def token_pieces(docs: DataFrame, id_col: str, text_col: str, path: str, size: int) -> DataFrame:
    """Rows (id, piece, start, length, ids_crc32): documents with their end id, cut to size."""

    def cut(batches):
        coder = word_ids(path)
        for batch in batches:
            ids = batch.column(0)
            for at, texts in slices(batch, 1, TEXT_BYTES):
                rows = []
                for i, coded in enumerate(coder.encode(texts), at):
                    coded += END.to_bytes(4, "little")
                    for piece, start in enumerate(range(0, len(coded) // 4, size)):
                        part = coded[4 * start : 4 * (start + size)]
                        rows.append((i, piece, start, len(part) // 4, zlib.crc32(part)))
                columns = list(zip(*rows, strict=True))
                kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(columns[0]))]
                    + [pa.array(c, k) for c, k in zip(columns[1:], kinds, strict=True)],
                    names=["id", "piece", "start", "length", "ids_crc32"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, piece int, start long, length long, ids_crc32 long"
    return map_batches(docs.select(id_col, text_col), cut, schema)


def length_patterns(lengths: list[int], size: int) -> list[Pattern]:
    """Patterns of one to three of the given lengths that fill a sequence exactly."""
    present = set(lengths)
    patterns = {(size,)} if size in present else set()
    patterns |= {(a, size - a) for a in present if 2 * a >= size and size - a in present}
    third = [x for x in lengths if x <= size // 3]
    for c in third[:: max(1, len(third) // TRIPLE_LENGTHS)]:
        for a in lengths:
            b = size - c - a
            if a >= b >= c and b in present:
                patterns.add((a, b, c))
    return sorted(patterns, reverse=True)


def fitted_counts(patterns: list[Pattern], histogram: dict[int, int]) -> list[float]:
    """Non-negative least squares: repeats per pattern whose lengths best add up to the
    histogram, by coordinate descent."""
    rest = {k: float(v) for k, v in histogram.items()}
    repeats = [0.0] * len(patterns)
    squares = [sum(p.count(x) ** 2 for x in set(p)) for p in patterns]
    for _ in range(SWEEPS):
        for i, pattern in enumerate(patterns):
            step = sum(rest[x] for x in pattern) / squares[i]
            step = max(step, -repeats[i])
            if step:
                repeats[i] += step
                for x in pattern:
                    rest[x] -= step
    return repeats


def packing_plan(histogram: dict[int, int], size: int = SEQUENCE) -> list[tuple[Pattern, int]]:
    """Patterns of lengths with their repeats, which use the histogram up exactly.

    Fitted repeats are rounded to what is there. The rest is packed best fit: the
    largest length left, then always the largest that still fits, repeated while its
    lengths last. Each such pattern uses up a length, so the plan is bounded by the
    number of lengths, whatever the number of documents.
    """
    left = {k: v for k, v in histogram.items() if v > 0}
    patterns = length_patterns(sorted(left), size)
    plan = []
    repeats = fitted_counts(patterns, left)
    for pattern, wanted in sorted(zip(patterns, repeats, strict=True), key=lambda x: -x[1]):
        n = min([int(wanted + 0.5), *[left[x] // pattern.count(x) for x in pattern]])
        if n > 0:
            plan.append((pattern, n))
            for x in pattern:
                left[x] -= n
    sizes = sorted(k for k, v in left.items() if v > 0)
    while sizes:
        pattern, room = [], size
        used: dict[int, int] = {}
        while room > 0:
            at = bisect.bisect_right(sizes, room) - 1
            while at >= 0 and used.get(sizes[at], 0) >= left[sizes[at]]:
                at -= 1
            if at < 0:
                break
            x = sizes[at]
            pattern.append(x)
            used[x] = used.get(x, 0) + 1
            room -= x
        n = min(left[x] // k for x, k in used.items())
        plan.append((tuple(pattern), n))
        for x, k in used.items():
            left[x] -= n * k
        sizes = [x for x in sizes if left[x] > 0]
    return plan


def pack_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SEQUENCE,
    tokenizer_path: str | None = None,
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its ids and an end id; null counts as empty, so it is the end id alone.
    Only documents longer than a sequence are cut. The histogram of piece lengths (at
    most ``size`` numbers) goes to the driver, which plans patterns; pieces of a length
    are numbered and take the plan's places in turn. The plan has at most some
    thousand rows, bounded by the lengths and the enumerated patterns, and is broadcast.
    Repeated rows and null ids are packed like others; an empty table gives no rows.
    """
    path = tokenizer_path or public_tokenizers.path(TOKENIZER)
    pieces = stored(token_pieces(docs, id_col, text_col, path, size), "pack-pieces")
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    places, taken, sequence = [], dict.fromkeys(histogram, 0), 0
    for pattern, repeats in packing_plan(histogram, size):
        offset = 0
        for x in pattern:
            places.append((x, taken[x], taken[x] + repeats, sequence, offset))
            taken[x] += repeats
            offset += x
        sequence += repeats
    plan = docs.sparkSession.createDataFrame(
        places, "plan_length long, first long, stop long, sequence long, offset long"
    )
    ranked = number_rows(pieces, ["length"], ["id", "piece", "ids_crc32"], "rank")
    fits = (
        (F.col("length") == F.col("plan_length"))
        & (F.col("rank") >= F.col("first"))
        & (F.col("rank") < F.col("stop"))
    )
    return ranked.join(F.broadcast(plan), fits).select(
        F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32",
        (F.col("sequence") + F.col("rank") - F.col("first")).alias("sequence_id"),
        "offset",
    )


def packing_query(spark, folder: str) -> DataFrame:
    """All ``documents`` in sequences of 2048 tokens."""
    return pack_documents(documents(spark, folder))
