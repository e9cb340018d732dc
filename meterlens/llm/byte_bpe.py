"""Byte-level BPE by recursive queries inside each task."""

from __future__ import annotations

import base64
import bisect

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlens.llm.common import documents, map_batches

RANKS = "byte_bpe_50k.tiktoken"
WORDS = 50_000  # words in one recursive query
LONG_WORD = 1_000  # bytes; longer ones have a query of their own that keeps one state a position
CACHE_WORDS = 500_000  # words whose ids a worker keeps; then it starts anew
CHUNK_CHARS = 4_000_000  # of the texts handled at once inside a batch

# Each step gives every word that still has a mergeable pair its next state: the leftmost
# pair of the smallest rank becomes one token at the left position, and the right
# position goes. A row knows the next token of its word. A word without such a pair puts
# its rows out once more as done and takes no further step; at the fixpoint all are done.
CONTRACT = """
with recursive state(done, word, pos, token, next_pos, next_token) as (
  select false, word, pos, token, lead(pos) over w, lead(token) over w
  from start window w as (partition by word order by pos)
  union all
  select b.word is null, s.word, s.pos,
    case when s.pos = b.pos then b.merged else s.token end,
    case when s.pos = b.pos then b.after else s.next_pos end,
    case when s.pos = b.pos then b.after_token
      when s.next_pos = b.pos then b.merged else s.next_token end
  from (select * from state where not done) s left join (
    select m.word, m.pos, m.merged, m.gone, g.next_pos as after, g.next_token as after_token
    from (
      select word, (min(place) % 1048576)::int as pos, (min(place) // 1048576)::int as merged,
        arg_min(next_pos, place) as gone
      from (
        select word, merged::bigint * 1048576 + pos as place, next_pos
        from (select * from state where not done) join merges on token = a and next_token = b)
      group by word) m
    join state g on g.word = m.word and g.pos = m.gone) b on s.word = b.word
  where b.word is null or s.pos <> b.gone)
select word, token from state where done order by word, pos
"""

# The same for one long word. Rows replace the row of their position (-1: gone), so that
# memory follows the length. A step takes all pairs of the smallest rank from the left, of
# overlapping ones every other, up to the first whose token makes a pair of a smaller rank
# with a neighbour: one by one, that pair would be next. So steps follow the ranks that a
# word uses, not its length.
CONTRACT_LONG = """
with recursive state(pos, token) using key (pos) as (
  select pos, token from start
  union
  (with line as (
    select pos, token, lead(pos) over w as gone, lead(token) over w as next_token,
      lead(token, 2) over w as after_token, lag(token) over w as before_token,
      row_number() over w as place
    from recurring.state where token >= 0 window w as (order by pos)),
  pairs as (
    select pos, gone, place, before_token, after_token, merged
    from line join merges on token = a and next_token = b),
  least as (
    select *, place - row_number() over (order by place) as run
    from pairs where merged = (select min(merged) from pairs)),
  taken as (
    select * from least qualify row_number() over (partition by run order by place) % 2 = 1),
  beside as (
    select pos, gone, merged, after_token,
      case when lag(place) over (order by place) = place - 2 then merged else before_token
      end as before_token
    from taken),
  judged as (
    select t.pos, t.gone, t.merged,
      coalesce(x.merged < t.merged, false) or coalesce(y.merged < t.merged, false) as breaks
    from beside t
    left join merges x on x.a = t.before_token and x.b = t.merged
    left join merges y on y.a = t.merged and y.b = t.after_token),
  joined as (
    select * from judged
    where pos <= (select coalesce(min(pos) filter (where breaks), max(pos)) from judged))
  select pos, merged from joined union all select gone, -1 from joined))
select 0 as word, token from state where token >= 0 order by pos
"""

# Text bytes in hexadecimal, put together in the order of the positions.
DECODE = """
select text, string_agg(hexes, '') as hexes
from (select text, hexes from ids join vocabulary using (token) order by pos) group by text
"""

_MODELS: dict[str, Bpe] = {}  # of this worker, by path


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}


class Bpe:
    """The merge table and the vocabulary in an in-process database of one task."""

    def __init__(self, path: str):
        ranks = read_ranks(path)
        self.single = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        self.split = regex.compile(public_tokenizers.PATTERN)
        self.known: dict[str, bytes] = {}
        splits = [
            (ranks[t[:i]], ranks[t[i:]], r)
            for t, r in ranks.items()
            for i in range(1, len(t))
            if t[:i] in ranks and t[i:] in ranks
        ]
        a, b, merged = (pa.array(x, pa.int32()) for x in zip(*splits, strict=True))
        merges = pa.table({"a": a, "b": b, "merged": merged})  # noqa: F841
        vocabulary = pa.table(  # noqa: F841
            {
                "token": pa.array(list(ranks.values()), pa.int32()),
                "hexes": pa.array([t.hex() for t in ranks]),
            }
        )
        self.db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "400MB"})
        self.db.execute("create table merges as from merges")
        self.db.execute("create table vocabulary as from vocabulary")

    def learn(self, words: list[str]) -> None:
        """Encode words and keep their ids."""
        coded = sorted(((w, w.encode()) for w in words), key=lambda x: len(x[1]))
        short = bisect.bisect_right(coded, LONG_WORD, key=lambda x: len(x[1]))
        for at in range(0, short, WORDS):
            self._contract(coded[at : min(at + WORDS, short)], CONTRACT)
        for word in coded[short:]:
            self._contract([word], CONTRACT_LONG)

    def _contract(self, coded: list[tuple[str, bytes]], query: str) -> None:
        sizes = np.array([len(c) for _, c in coded])
        first = np.repeat(np.cumsum(sizes) - sizes, sizes)
        start = pa.table(
            {
                "word": np.repeat(np.arange(len(coded), dtype=np.int32), sizes),
                "pos": (np.arange(len(first)) - first).astype(np.int32),
                "token": self.single[np.frombuffer(b"".join(c for _, c in coded), np.uint8)],
            }
        )
        self.db.register("start", start)
        out = self.db.execute(query).fetchnumpy()
        self.db.unregister("start")
        ids = np.asarray(out["token"]).astype("<u4").tobytes()
        ends = np.cumsum(np.bincount(np.asarray(out["word"]), minlength=len(coded))) * 4
        begin = 0
        for (text, _), end in zip(coded, ends.tolist(), strict=True):
            self.known[text] = ids[begin:end]
            begin = end

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        words = [self.split.findall(t) for t in texts]
        if len(self.known) > CACHE_WORDS:
            self.known = {}
        self.learn(list({w for text in words for w in text} - self.known.keys()))
        return [b"".join(map(self.known.__getitem__, text)) for text in words]

    def decode(self, coded: list[bytes]) -> list[bytes]:
        sizes = np.array([len(c) // 4 for c in coded])
        ids = pa.table(
            {
                "text": np.repeat(np.arange(len(coded), dtype=np.int32), sizes),
                "pos": np.arange(sizes.sum(), dtype=np.int32),
                "token": np.frombuffer(b"".join(coded), "<u4").astype(np.int32),
            }
        )
        self.db.register("ids", ids)
        rows = dict(self.db.execute(DECODE).fetchall())
        self.db.unregister("ids")
        return [bytes.fromhex(rows.get(i, "")) for i in range(len(coded))]


def _chunks(values: list, limit: int):
    """Ranges of values of about ``limit`` in length together."""
    start, size = 0, 0
    for i, value in enumerate(values):
        size += len(value)
        if size >= limit:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(values):
        yield start, len(values)


def _mapped(df: DataFrame, id_col: str, in_col: str, out_col: str, path: str, work: str):
    def run(batches):
        model = _MODELS.get(path) or _MODELS.setdefault(path, Bpe(path))
        for batch in batches:
            empty = b"" if work == "decode" else ""
            values = [v if v is not None else empty for v in batch.column(1).to_pylist()]
            for start, end in _chunks(values, CHUNK_CHARS):
                done = getattr(model, work)(values[start:end])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, end - start), values_array(values[start:end]), pa.array(done, pa.binary())],
                    names=["id", "value", "done"],
                )

    def values_array(values):
        return pa.array(values, pa.binary() if work == "decode" else pa.string())

    kind = df.schema[id_col].dataType.simpleString()
    held = "binary" if work == "decode" else "string"
    out = map_batches(df.select(id_col, in_col), run, f"id {kind}, value {held}, done binary")
    return out.select(F.col("id").alias(id_col), F.col("value").alias(in_col), F.col("done").alias(out_col))


def encode(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None
) -> DataFrame:
    """Rows (id, text, ids): ids as little-endian unsigned 32-bit integers.

    Null and empty texts have no ids. Each match of the public pattern is encoded apart,
    each distinct match once per task. Rows are independent: repeated rows, null ids and
    further columns make no difference, and there is no shuffle.
    """
    path = path or public_tokenizers.path(RANKS)
    return _mapped(docs, id_col, text_col, "ids", path, "encode")


def decode(
    coded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", path: str | None = None
) -> DataFrame:
    """Rows (id, ids, bytes) for ids as ``encode`` gives them; null counts as none."""
    path = path or public_tokenizers.path(RANKS)
    return _mapped(coded, id_col, ids_col, "bytes", path, "decode")


def byte_bpe_query(spark, folder: str) -> DataFrame:
    """Ids of every document of ``documents`` and the bytes decoded from them, as digests."""
    ids = encode(documents(spark, folder))
    return decode(ids).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )
