"""Removal of passages that stand in an earlier document, by suffix automata."""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlens.llm.common import documents, map_batches, stored, whole_text
from meterlens.llm.words import WordHasher, as_long, combined, key_filter, passes, slices

BLANKS = b" \t\n\x0b\x0c\r"  # fixed value: what stands between words
WINDOW = 13
GRAM = 5  # words of an anchor
SLICE = 1 << 21  # bytes of text that a task works on at once
LAST = (1 << 63) - 1  # the place of null ids
OFTEN = 5_000  # occurrences from which an anchor's windows go their own ways
SHARD_WORDS = 50_000  # of the passages in one automaton, besides those of its last anchor
ONE_SPACE = bytes.maketrans(BLANKS, b" " * len(BLANKS))


class Windows:
    """All windows of some texts with their anchors.

    The anchor of a window is its gram of least hash, so equal windows have equal anchors at
    the same place, and neighbouring windows mostly share one: a *run*.
    """

    def __init__(self, hasher: WordHasher, texts: list[bytes], window: int, gram: int):
        self.data = b" ".join(texts).translate(ONE_SPACE)
        self.hashes, self.starts, self.ends = hasher(self.data)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        self.doc = np.searchsorted(np.cumsum(lengths), self.starts, side="right")
        self.first_word = np.searchsorted(self.doc, np.arange(len(texts)))
        grams = combined(self.hashes, gram)
        count = max(0, len(self.hashes) - window + 1)
        least, place = grams[:count].copy(), np.zeros(count, np.int64)
        for k in range(1, window - gram + 1):
            smaller = grams[k : k + count] < least
            least[smaller] = grams[k : k + count][smaller]
            place[smaller] = k
        at = np.flatnonzero(self.doc[:count] == self.doc[window - 1 :][:count])
        self.at, self.key, anchor = at, least[at], place[at] + at
        self.run = np.flatnonzero(np.diff(anchor, prepend=-1))  # first window of each run


def _anchors(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """Anchors that stand under two ids, ``often`` where there are very many."""

    def run(batches):
        hasher = WordHasher(BLANKS)
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for first, texts in slices(batch, 1, SLICE):
                found = Windows(hasher, texts, window, gram)
                if not len(found.run):
                    continue
                keys = found.key[found.run]
                owner = ids[first + found.doc[found.at[found.run]]]
                order = np.argsort(keys, kind="stable")
                keys, owner = keys[order], owner[order]
                heads = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
                yield pa.RecordBatch.from_arrays(
                    [
                        as_long(keys[heads]),
                        pa.array(np.minimum.reduceat(owner, heads)),
                        pa.array(np.maximum.reduceat(owner, heads)),
                        pa.array(np.diff(heads, append=len(keys))),
                    ],
                    names=["key", "first", "last", "n"],
                )

    anchors = map_batches(docs.select("id", "text"), run, "key long, first long, last long, n long")
    shared = anchors.groupBy("key").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n").alias("n")
    )
    return shared.filter("first < last").select("key", (F.col("n") > OFTEN).alias("often"))


def _passages(docs: DataFrame, shared: DataFrame, window: int, gram: int) -> DataFrame:
    """Runs of windows at shared anchors with their words and where they stand: one row per
    distinct passage and slice of a task. At very frequent anchors each window is a passage
    of its own under its own key, so that no key gathers an unbounded set of texts."""
    context = docs.sparkSession.sparkContext
    cells, bits = key_filter(shared, "key")
    often_cells, often_bits = key_filter(shared.filter("often"), "key")
    known = context.broadcast((bits, often_bits))

    def run(batches):
        hasher = WordHasher(BLANKS)
        bits, often_bits = (np.frombuffer(b, np.uint8) for b in known.value)
        for batch in batches:
            ids, marks = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            for first, texts in slices(batch, 1, SLICE):
                found = Windows(hasher, texts, window, gram)
                if not len(found.run):
                    continue
                ends = np.append(found.run[1:], len(found.at))
                keys = found.key[found.run]
                wanted = passes(keys, cells, bits)
                often = wanted & passes(keys, often_cells, often_bits)
                plain = wanted & ~often
                heads, tails = found.at[found.run[plain]], found.at[ends[plain] - 1]
                alone = np.concatenate(
                    [found.at[a:b] for a, b in zip(found.run[often], ends[often])] or [heads[:0]]
                )
                keys = np.concatenate((keys[plain], combined(found.hashes, window)[alone]))
                heads, tails = np.concatenate((heads, alone)), np.concatenate((tails, alone))
                rows: dict[tuple[int, bytes], list[int]] = {}
                data = found.data
                spans = zip(
                    keys.view(np.int64).tolist(), found.starts[heads].tolist(),
                    found.ends[tails + window - 1].tolist(),
                )
                for number, (key, start, end) in enumerate(spans):
                    words = data[start:end]
                    if b"  " in words:
                        words = b" ".join(words.split())
                    rows.setdefault((key, words), []).append(number)
                if not rows:
                    continue
                doc = found.doc[heads]
                order = np.concatenate([np.array(n) for n in rows.values()])
                sizes = np.fromiter(map(len, rows.values()), np.int64, len(rows))
                offsets = np.concatenate(([0], np.cumsum(sizes)))
                owner = ids[first + doc[order]]
                digests = [hashlib.blake2b(w, digest_size=16).digest() for _, w in rows]
                pairs = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                places = pa.StructArray.from_arrays(
                    [
                        pa.array(owner), pa.array(marks[first + doc[order]]),
                        pa.array((heads - found.first_word[doc])[order].astype(np.int32)),
                    ],
                    names=["id", "mark", "at"],
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([k for k, _ in rows], pa.int64()),
                        pa.array([w for _, w in rows], pa.binary()),
                        pa.array(pairs[:, 0]), pa.array(pairs[:, 1]),
                        pa.array(np.minimum.reduceat(owner, offsets[:-1])),
                        pa.array(np.maximum.reduceat(owner, offsets[:-1])),
                        pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), places),
                    ],
                    names=["key", "words", "d1", "d2", "first", "last", "places"],
                )

    return map_batches(
        docs.select("id", "text", "mark"), run,
        "key long, words binary, d1 long, d2 long, first long, last long, "
        "places array<struct<id: long, mark: long, at: int>>",
    )


class Automaton:
    """Suffix automaton of passages (lists of words). Each state knows the least id of the
    passages that hold its strings."""

    def __init__(self, passages: list[tuple[list[bytes], int]]):
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length, self.least = [-1], [0], [LAST]
        for words, id_ in passages:
            self._add(words, id_)
        order = sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True)
        least, link = self.least, self.link
        for state in order:
            if least[state] < least[link[state]]:
                least[link[state]] = least[state]

    def _state(self, length: int, following: dict, link: int) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        self.least.append(LAST)
        return len(self.next) - 1

    def _split(self, state: int, word: bytes) -> int:
        """The state for the strings of ``state`` and the word: cut off where others share it."""
        target = self.next[state][word]
        if self.length[target] == self.length[state] + 1:
            return target
        half = self._state(self.length[state] + 1, dict(self.next[target]), self.link[target])
        self.link[target] = half
        while state != -1 and self.next[state].get(word) == target:
            self.next[state][word] = half
            state = self.link[state]
        return half

    def _add(self, words: list[bytes], id_: int) -> None:
        next_, link, least, last = self.next, self.link, self.least, 0
        for word in words:
            if word in next_[last]:
                last = self._split(last, word)
            else:
                new, state = self._state(self.length[last] + 1, {}, 0), last
                while state != -1 and word not in next_[state]:
                    next_[state][word] = new
                    state = link[state]
                if state != -1:
                    link[new] = self._split(state, word)
                last = new
            if id_ < least[last]:
                least[last] = id_

    def least_ids(self, words: list[bytes], window: int) -> list[int]:
        """For each window of a text the least id that holds it (``LAST``: none). The matching
        statistics tell how many words before each place match; from ``window`` on, the
        state of the last ``window`` words is the answer."""
        next_, link, length = self.next, self.link, self.length
        state, matched, out = 0, 0, []
        for place, word in enumerate(words):
            while state and word not in next_[state]:
                state = link[state]
                matched = length[state]
            if word in next_[state]:
                state, matched = next_[state][word], matched + 1
            if matched >= window:
                while length[link[state]] >= window:
                    state = link[state]
                matched = window
            if place >= window - 1:
                out.append(self.least[state] if matched >= window else LAST)
        return out


def _first_holders(passages: DataFrame, window: int) -> DataFrame:
    """For each passage the least id of each of its windows, where one is below its own.

    Keys are dealt over shards. A task gathers whole keys into automata of bounded size
    and streams their passages through them."""
    kind = "d1 long, d2 long, holders array<long>"

    def matched(shard: dict):
        """Passages by (key, words): d1, d2, first, last."""
        words = [key[1].split(b" ") for key in shard]
        automaton = Automaton([(w, found[2]) for w, found in zip(words, shard.values())])
        out = []
        for passage, (d1, d2, _, last) in zip(words, shard.values()):
            holders = automaton.least_ids(passage, window)
            if min(holders) < last:
                out.append((d1, d2, holders))
        return out

    def run(batches):
        shard, group, at, size, out = {}, {}, None, 0, []

        def gathered():
            """The key that ended joins the shard, unless one id alone holds it."""
            found = group.values()
            if group and min(f[2] for f in found) < max(f[3] for f in found):
                shard.update(group)
                return sum(key[1].count(b" ") + 1 for key in group)
            return 0

        def packed():
            columns = list(zip(*out))
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                 pa.array(columns[2], pa.list_(pa.int64()))],
                names=["d1", "d2", "holders"],
            )

        for batch in batches:
            for key, words, d1, d2, first, last in zip(*(c.to_pylist() for c in batch.columns)):
                if key != at:
                    size += gathered()
                    group, at = {}, key
                    if size >= SHARD_WORDS:
                        out += matched(shard)
                        shard, size = {}, 0
                        if out:
                            yield packed()
                        out = []
                before = group.get((key, words))
                if before is not None:
                    first, last = min(first, before[2]), max(last, before[3])
                group[key, words] = d1, d2, first, last
        gathered()
        out += matched(shard)
        if out:
            yield packed()

    keyed = passages.select("key", "words", "d1", "d2", "first", "last")
    return map_batches(keyed.repartition("key").sortWithinPartitions("key"), run, kind)


def without_known_passages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
    gram: int = GRAM,
) -> DataFrame:
    """Rows (id, ``n_words``, ``n_removed``, ``kept_text``): each word goes that is covered by
    ``window`` consecutive words which also stand in a document of a smaller id.

    Words are what stands between ASCII blanks, kept ones are joined by one space. Ids are
    whole numbers. Null ids come last and are equal to each other, rows of one id are no
    earlier documents of each other; repeated rows have repeated results. Null and empty
    texts have no words, texts shorter than a window keep all. An empty table gives no
    rows. Other columns are not read.

    Every document is reference to all later ones, so the reference cannot be broadcast. Two
    documents that share a window share its anchor: anchors are counted first, and a filter
    of bounded size of those under several ids is broadcast instead. Only passages at these
    anchors meet the suffix automata of their shard, which give for each window its least
    id. Collisions of anchors cost time only, windows are compared word by word. The places
    found return to their texts in one join.
    """
    source = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("id"),
        whole_text(F.col(text_col)).alias("text"),
        F.xxhash64(whole_text(F.col(text_col))).alias("mark"),
        F.col(id_col).alias("own_id"),
    )
    shared = stored(_anchors(source, window, gram), "shared-anchors")
    passages = stored(_passages(source, shared, window, gram), "passages", "zstd")
    holders = stored(_first_holders(passages, window), "first-holders")
    known = passages.select("d1", "d2", "places").join(holders, ["d1", "d2"])
    placed = known.select("holders", F.explode("places").alias("p")).select(
        "p.id", "p.mark", "p.at", "holders"
    )
    # One bit for each window of a passage that an earlier document holds.
    bits = F.expr(
        "aggregate(holders, named_struct('j', 0, 'b', 0L), (a, h) -> named_struct('j', a.j + 1, "
        "'b', a.b + if(h < id, shiftleft(1L, a.j), 0L)), a -> a.b)"
    )
    removed = (
        placed.select("id", "mark", "at", bits.alias("bits"))
        .filter("bits <> 0")
        .groupBy("id", "mark")
        .agg(F.collect_list(F.struct("at", "bits")).alias("spans"))
    )
    kind = docs.schema[id_col].dataType.simpleString()
    texts = source.join(removed, ["id", "mark"], "left").select("own_id", "text", "spans")

    def run(batches):
        for batch in batches:
            for first, parts in slices(batch, 1, SLICE):
                words = [part.split() for part in parts]
                counts = np.fromiter(map(len, words), np.int64, len(words))
                begins = np.concatenate(([0], np.cumsum(counts)))
                steps = np.zeros(begins[-1] + window + 1, np.int64)
                spans = batch.column(2).slice(first, len(parts))
                owner = np.repeat(
                    np.arange(len(parts)), spans.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                )
                flat = spans.flatten()
                at = flat.field(0).to_numpy() + begins[owner]
                bits = flat.field(1).to_numpy()
                for j in range(window - gram + 1):
                    hit = at[(bits >> j) & 1 != 0] + j
                    np.add.at(steps, hit, 1)
                    np.add.at(steps, hit + window, -1)
                stays = np.cumsum(steps) == 0
                kept = [
                    w if stays[a:b].all() else list(compress(w, stays[a:b].tolist()))
                    for w, a, b in zip(words, begins[:-1].tolist(), begins[1:].tolist())
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(parts)),
                        pa.array(counts),
                        pa.array([a - len(k) for a, k in zip(counts.tolist(), kept)], pa.int64()),
                        pa.array([b" ".join(k) for k in kept], pa.binary()).cast(pa.string()),
                    ],
                    names=["id", "n_words", "n_removed", "kept_text"],
                )

    out = map_batches(texts, run, f"id {kind}, n_words long, n_removed long, kept_text string")
    return out.select(F.col("id").alias(id_col), "n_words", "n_removed", "kept_text")


def passages_query(spark, folder: str) -> DataFrame:
    """Words of earlier documents, removed from every document of ``documents``."""
    kept = without_known_passages(documents(spark, folder))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


PASSAGES_SQL = r"""
with texts as (
  select doc_id, row_number() over () as row_id,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words
  from documents),
starts as (
  select doc_id, row_id, words, unnest(range(1, len(words) - 11)) as s from texts),
windows as (
  select doc_id, row_id, s, array_to_string(words[s : s + 12], ' ') as w from starts),
firsts as (select *, min(doc_id) over (partition by w) as least from windows),
gone as (
  select distinct row_id, unnest(range(s, s + 13)) as place from firsts where least < doc_id),
placed as (
  select doc_id, row_id, unnest(words) as word, unnest(range(1, len(words) + 1)) as place from texts),
kept as (
  select row_id, string_agg(word, ' ' order by place) as body, count(*) as n
  from placed anti join gone using (row_id, place) group by row_id)
select doc_id, cast(len(words) as bigint) as n_words,
  cast(len(words) - coalesce(n, 0) as bigint) as n_removed, sha256(coalesce(body, '')) as kept_sha256
from texts left join kept using (row_id)
"""
