"""Secret scans: keyword automaton, anchored patterns near its hits, embedded checksums."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlens.llm.common import documents, map_batches

# Keywords, token prefixes and patterns that decide what a secret is.
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS_PREFIX = "akia"
CHECKED_PREFIXES = {
    "ghp_": "github", "gho_": "github", "ghu_": "github", "ghs_": "github", "ghr_": "github",
    "npm_": "npm",
}
KINDS = ("assign", "access", "hex", "github", "npm")
ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
CHECKED = re.compile(r"(?:gh[opusr]|npm)_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
ASSIGN_LENGTH, ACCESS_LENGTH, HEX_LENGTH = 6, 20, 24


@cache
def keywords() -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for word in (*ASSIGN_WORDS, ACCESS_PREFIX, *CHECKED_PREFIXES):
        automaton.add_word(word, word)
    automaton.make_automaton()
    return automaton


def checksum(body: str) -> str:
    """CRC-32 of a token's body in base 62, six digits: the end of checked tokens."""
    rest, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        rest, digit = divmod(rest, 62)
        digits = BASE62[digit] + digits
    return digits


def lowered(text: str) -> str:
    """Lower case with unchanged positions."""
    low = text.lower()
    if len(low) == len(text):
        return low
    return "".join(c.lower() if c < "\x80" else c for c in text)


def hex_runs(text: str) -> Iterator[tuple[int, int]]:
    """Maximal runs of at least ``HEX_LENGTH`` hexadecimal digits.

    Such a run covers one of every ``HEX_LENGTH`` positions, so only those are looked at
    and the pattern is applied around the digits found there.
    """
    end = 0
    for probe in HEX.finditer(text[HEX_LENGTH - 1 :: HEX_LENGTH]):
        for step in range(probe.start(), probe.end()):
            at = HEX_LENGTH - 1 + step * HEX_LENGTH
            if at < end:
                continue
            start = at
            while start > end and text[start - 1] in "0123456789abcdef":
                start -= 1
            end = HEX.match(text, at).end()
            if end - start >= HEX_LENGTH:
                yield start, end


def find_secrets(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` in code points, in that order; kinds index ``KINDS``."""
    found = [(start, 2, end) for start, end in hex_runs(text)]
    hits = sorted(
        (end - len(word) + 1, word) for end, word in keywords().iter(lowered(text))
    )
    free = dict.fromkeys(KINDS, 0)
    for start, word in hits:
        if word == ACCESS_PREFIX:
            match, kind = ACCESS.match(text, start), "access"
            good = match and match.end() - start >= ACCESS_LENGTH
        elif word in CHECKED_PREFIXES:
            match, kind = CHECKED.match(text, start), CHECKED_PREFIXES[word]
            good = match and checksum(match[1]) == match[2]
        else:
            match, kind = ASSIGN.match(text, start), "assign"
            good = match and len(match[2]) >= ASSIGN_LENGTH
        if match and start >= free[kind]:
            free[kind] = match.end()
            if good:
                found.append((start, KINDS.index(kind), match.end()))
    return sorted(found)


def redact(text: str) -> str:
    """The text with every found span replaced by ``[secret]``; overlaps become one."""
    parts, at, end = [], 0, 0
    for start, _, stop in find_secrets(text):
        if start >= end:
            parts += [text[at:start], "[secret]"]
        end = max(end, stop)
        at = end
    return "".join(parts) + text[at:] if parts else text


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id and ``spans``, an array of (kind, start, end).

    A null text counts as empty. Every row gives a row, repeated rows and null ids too;
    other columns are not read, so their names can't clash. One pass, no shuffle.
    """

    def scan(batches):
        for batch in batches:
            spans = [
                [{"kind": KINDS[k], "start": s, "end": e} for s, k, e in find_secrets(t or "")]
                for t in batch.column(1).to_pylist()
            ]
            kind = pa.list_(
                pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(spans, kind)], names=["id", "spans"]
            )

    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"id {id_type}, spans array<struct<kind:string,start:bigint,end:bigint>>"
    rows = map_batches(docs.select(id_col, text_col), scan, schema)
    return rows.select(F.col("id").alias(id_col), "spans")


def without_secrets(docs: DataFrame, text_col: str = "text", length_col: str | None = None):
    """The documents with every secret replaced by ``[secret]``; null texts stay null.

    ``length_col`` names a column that is set to the new number of code points.
    """

    def clean(batches):
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            texts = [None if t is None else redact(t) for t in batch.column(at).to_pylist()]
            columns = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            columns[text_col] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    cleaned = map_batches(docs, clean, docs.schema)
    if length_col is None:
        return cleaned
    kind = docs.schema[length_col].dataType
    return cleaned.withColumn(length_col, F.char_length(text_col).cast(kind))


def secrets_query(spark, folder: str) -> DataFrame:
    """Spans of every document of ``documents`` with counts and digests."""
    found = secret_spans(documents(spark, folder))
    base = F.filter("spans", lambda s: s["kind"].isin(*KINDS[:3]))
    joined = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
