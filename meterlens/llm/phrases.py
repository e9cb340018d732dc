"""Phrases whose words keep company: counts from suffix subtrees of vertical partitions."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlens.llm.common import documents, map_batches, stored, whole_text
from meterlens.llm.words import WordHasher, as_long, combined, key_filter, mixed, passes, slices

# What ends a piece of text, and what stands between its words.
ENDS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
DEPTH = 5  # words of a phrase at most
LEAST, TOP = 100, 2000
SLICE = 1 << 23  # bytes of text that a task works on at once
CELLS = 1 << 16  # into which two-word prefixes are hashed to weigh them
LEAVES = 2_000_000  # memory budget of a group of prefixes: leaves at most
LOWER_WORDS = bytes.maketrans(
    bytes(range(65, 91)) + ENDS + BLANKS, bytes(range(97, 123)) + b" " * len(ENDS + BLANKS)
)
SEEDS = 8  # of word hashes, tried until no frequent word collides
SPREAD = 0x9E3779B97F4A7C15
WORDS = [f"w{k}" for k in range(1, DEPTH + 1)]


def _hasher(seed: int) -> WordHasher:
    return WordHasher(ENDS + BLANKS, fold=True, seed=seed)


def _lang_hash(hasher: WordHasher, lang: str) -> np.uint64:
    """A language name as a word of its own, whatever characters it has."""
    value = np.array([hasher.base], np.uint64)
    for byte in lang.encode():
        value = mixed(value * np.uint64(SPREAD) + np.uint64(byte + 1))
    return value[0]


def _vocabulary(docs: DataFrame, seed: int) -> DataFrame:
    """Occurrences of each word (lower case) of each language, with its hash."""

    def run(batches):
        hasher = _hasher(seed)
        for batch in batches:
            langs = batch.column(0).to_pylist()
            counts: dict[str, Counter] = {}
            for first, texts in slices(batch, 1, SLICE):
                for lang, text in zip(langs[first:], texts):
                    counts.setdefault(lang, Counter()).update(text.translate(LOWER_WORDS).split())
            for lang, found in counts.items():
                if found:
                    words = list(found)
                    hashes = mixed(hasher(b" ".join(words))[0] ^ _lang_hash(hasher, lang))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([lang] * len(words), pa.string()),
                            pa.array(words, pa.binary()).cast(pa.string()),
                            as_long(hashes), pa.array(found.values(), pa.int64()),
                        ],
                        names=["lang", "word", "h", "n"],
                    )

    words = map_batches(docs, run, "lang string, word string, h long, n long")
    return words.groupBy("lang", "word", "h").agg(F.sum("n").alias("n"))


class Pieces:
    """The words of some texts by hash, with the frequent pairs among neighbours."""

    def __init__(self, hasher: WordHasher, langs: list[str], texts: list[bytes]):
        data = b"\n".join(texts)
        hashes, starts, _ = hasher(data)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        doc = np.searchsorted(np.cumsum(lengths), starts, side="right")
        names = {lang: _lang_hash(hasher, lang) for lang in set(langs)}
        self.words = mixed(hashes ^ np.array([names[lang] for lang in langs], np.uint64)[doc])
        ends = np.zeros(256, bool)
        ends[list(ENDS)] = True
        piece = np.searchsorted(np.flatnonzero(ends[np.frombuffer(data, np.uint8)]), starts)
        self.joined = piece[1:] == piece[:-1]

    def pairs(self, cells: int, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and keys of neighbours that are both frequent words."""
        known = passes(self.words, cells, bits)
        at = np.flatnonzero(self.joined & known[1:] & known[:-1])
        return at, combined(self.words, 2)[at]


def _counted(keys: np.ndarray) -> pa.RecordBatch:
    values, counts = np.unique(keys, return_counts=True)
    return pa.RecordBatch.from_arrays([as_long(values), pa.array(counts)], names=["key", "n"])


def _frequent_pairs(docs: DataFrame, seed: int, words: tuple, least: int) -> DataFrame:
    """Keys and occurrences of two-word prefixes that are frequent enough to have a subtree."""
    cells, bits = words[0], docs.sparkSession.sparkContext.broadcast(words[1])

    def run(batches):
        hasher, known = _hasher(seed), np.frombuffer(bits.value, np.uint8)
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for first, texts in slices(batch, 1, SLICE):
                found = Pieces(hasher, langs[first : first + len(texts)], texts)
                _, keys = found.pairs(cells, known)
                if len(keys):
                    yield _counted(keys)

    pairs = map_batches(docs, run, "key long, n long")
    return pairs.groupBy("key").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def _groups(pairs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Vertical partition: first group and number of groups of each cell of prefixes.

    Neighbouring cells share a group while their leaves fit the budget. A cell beyond it is
    extended by the next word and split. Both arrays have ``CELLS`` entries.
    """
    weights = np.zeros(CELLS, np.int64)
    cell = F.col("key").bitwiseAND(F.lit(CELLS - 1).cast("long"))
    for at, n in pairs.groupBy(cell).agg(F.sum("n")).collect():  # at most CELLS rows
        weights[at] = n
    first, parts, group, held = np.zeros(CELLS, np.int64), np.ones(CELLS, np.int64), 0, 0
    for at, n in enumerate(weights.tolist()):
        if held and held + n > LEAVES:
            group, held = group + 1, 0
        first[at], parts[at] = group, max(1, -(-n // LEAVES))
        held += n
        if parts[at] > 1:
            group, held = group + int(parts[at]), 0
    return first, parts


def _leaves(docs: DataFrame, seed: int, words: tuple, pairs: tuple, groups: tuple) -> DataFrame:
    """The suffixes behind every place, cut to ``DEPTH`` words and to frequent pairs, with
    their group: equal ones of a slice are one row."""
    shared = docs.sparkSession.sparkContext.broadcast((words[1], pairs[1], *groups))

    def run(batches):
        word_bits, pair_bits, first_group, parts = shared.value
        word_bits, pair_bits = (np.frombuffer(b, np.uint8) for b in (word_bits, pair_bits))
        hasher = _hasher(seed)
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for first, texts in slices(batch, 1, SLICE):
                found = Pieces(hasher, langs[first : first + len(texts)], texts)
                at, keys = found.pairs(words[0], word_bits)
                good = passes(keys, pairs[0], pair_bits)
                at, keys = at[good], keys[good]
                if not len(at):
                    continue
                chained = np.zeros(len(found.words) + DEPTH, bool)
                chained[at] = True
                padded = np.concatenate((found.words, np.zeros(DEPTH, np.uint64)))
                columns, goes_on = [padded[at], padded[at + 1]], np.ones(len(at), bool)
                for k in range(2, DEPTH):
                    goes_on = goes_on & chained[at + k - 1]
                    columns.append(np.where(goes_on, padded[at + k], np.uint64(0)))
                whole = keys
                for column in columns[2:]:
                    whole = mixed(whole * np.uint64(SPREAD) + column)
                order = np.argsort(whole, kind="stable")
                columns = [c[order] for c in columns]
                head = np.zeros(len(order), bool)
                head[0] = True
                for column in columns:  # suffixes whose hash collides stay apart
                    head[1:] |= column[1:] != column[:-1]
                heads = np.flatnonzero(head)
                columns, cell = [c[heads] for c in columns], (keys[order][heads] & np.uint64(CELLS - 1))
                part = mixed(columns[2]) % parts[cell].astype(np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(first_group[cell] + part.astype(np.int64)),
                        *map(as_long, columns), pa.array(np.diff(heads, append=len(order))),
                    ],
                    names=["part", *WORDS, "n"],
                )

    return map_batches(docs, run, f"part long, {', '.join(f'{w} long' for w in WORDS)}, n long")


def _subtree_counts(leaves: DataFrame, least: int) -> DataFrame:
    """Occurrences of each phrase: the leaf totals below its node.

    A task holds whole groups in suffix order, so a subtree is read off its leaves
    in one pass, keeping only the prefix that is still open.
    """

    def run(batches):
        def counted(rows: list[np.ndarray]) -> pa.RecordBatch:
            *words, n = rows
            new, out = np.zeros(len(n), bool), []
            new[:1] = True
            for depth, column in enumerate(words, 1):
                new[1:] |= column[1:] != column[:-1]
                if depth < 2 or not len(n):
                    continue
                heads = np.flatnonzero(new)
                totals = np.add.reduceat(n, heads)
                # A pair split over groups is summed up later; longer phrases are whole here.
                real = (column[heads] != 0) & ((totals >= least) | (depth == 2))
                nodes = [c[heads][real] if d < depth else np.zeros(real.sum(), np.int64)
                         for d, c in enumerate(words)]
                out.append([*nodes, totals[real]])
            columns = [np.concatenate(parts) for parts in zip(*out)]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[*WORDS, "n"])

        open_ = None
        for batch in batches:
            rows = [batch.column(k).to_numpy() for k in range(1, DEPTH + 2)]
            if open_ is not None:
                rows = [np.concatenate(pair) for pair in zip(open_, rows)]
            if not len(rows[0]):
                continue
            last = np.flatnonzero((rows[0] != rows[0][-1]) | (rows[1] != rows[1][-1]))
            cut = int(last[-1]) + 1 if len(last) else 0
            open_ = [c[cut:] for c in rows]
            # Leaves of the open prefix that are equal become one.
            new = np.zeros(len(open_[0]), bool)
            new[0] = True
            for column in open_[:-1]:
                new[1:] |= column[1:] != column[:-1]
            heads = np.flatnonzero(new)
            open_ = [*[c[heads] for c in open_[:-1]], np.add.reduceat(open_[-1], heads)]
            if cut:
                yield counted([c[:cut] for c in rows])
        if open_ is not None:
            yield counted(open_)

    ordered = leaves.repartition("part").sortWithinPartitions(*WORDS)
    nodes = map_batches(ordered, run, f"{', '.join(f'{w} long' for w in WORDS)}, n long")
    return nodes.groupBy(*WORDS).agg(F.sum("n").alias("a")).filter(F.col("a") >= least)


def _scored(phrases: DataFrame, units: DataFrame, totals: DataFrame) -> DataFrame:
    """Phrases (``ws``: word hashes) with their lowest-scoring cut."""
    cuts = phrases.select("ws", "a", "lang", F.explode(F.expr("sequence(1, size(ws) - 1)")).alias("k"))
    left, right = units.select(F.col("ws").alias("x"), F.col("a").alias("l")), units.select(
        F.col("ws").alias("y"), F.col("a").alias("r")
    )

    def exact(column: Column) -> Column:
        return column.cast("decimal(19,0)")

    cut = (
        cuts.withColumns({"x": F.expr("slice(ws, 1, k)"), "y": F.expr("slice(ws, k + 1, size(ws) - k)")})
        .join(left, "x").join(right, "y").join(totals, "lang")
        .withColumn("top", (exact(F.col("a")) * exact(F.col("total"))) * F.lit(1000).cast("decimal(4,0)"))
        .withColumn("below", exact(F.col("l")) * exact(F.col("r")))
        .withColumn("score", F.expr("top div below"))
    )
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    return cut.groupBy("lang", "ws", "a", "total").agg(lowest).select(
        "lang", "ws", "a", "cut.l", "cut.r", F.col("total").alias("n"), "cut.score"
    )


def _absorbed(phrases: DataFrame) -> DataFrame:
    """Phrases that stand inside a longer one just as often. It is enough to look one word
    further: a longer phrase is never more frequent than those between."""
    inside = F.array(F.expr("slice(ws, 1, size(ws) - 1)"), F.expr("slice(ws, 2, size(ws) - 1)"))
    parts = phrases.filter(F.size("ws") > 2).select(F.explode(inside).alias("ws"), "a")
    longest = parts.groupBy("ws").agg(F.max("a").alias("within"))
    same = phrases.join(longest, "ws").filter(F.col("within") * 100 >= F.col("a") * 100)
    return same.select("ws")


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, top: int = TOP
) -> DataFrame:
    """The best ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    A phrase has 2 to 5 neighbouring words of one piece (texts in lower case, cut at
    punctuation and line ends) and occurs ``least`` times or more (``a``). Its score is the
    least, over its cuts in two, of floor(1000 * a * n / (l * r)), where n counts all words
    of the language, l and r its parts. Phrases that always stand inside a longer one are
    left out. Equal scores go by ``a``, then by the phrase.

    Null texts have no words, a null language is ``und``. Repeated rows count each time, an
    empty table gives no rows, other columns are not read. Words are told apart by 64-bit
    hashes per language that are checked: where a frequent word collides with any other,
    all is counted under another hash. Products are exact decimals.

    Vertical partitioning: words, then word pairs are counted; only pairs that are frequent
    open a subtree. Pairs are hashed into cells, and cells with some ``LEAVES`` suffixes make
    a group, built on its own by one task from suffixes of at most 5 words, equal ones
    of a slice being one row. Two filters of bounded size and the table of cells are
    all that is broadcast.
    """
    source = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
        whole_text(F.col(text_col)).alias("text"),
    )
    for seed in range(SEEDS):
        vocabulary = stored(_vocabulary(source, seed), "vocabulary")
        same = vocabulary.groupBy("h").agg(F.count(F.lit(1)).alias("names"), F.sum("n").alias("n"))
        if same.filter((F.col("names") > 1) & (F.col("n") >= least)).isEmpty():
            break
    else:
        raise RuntimeError("word hashes collide under every seed")
    totals = vocabulary.groupBy("lang").agg(F.sum("n").alias("total"))
    frequent = vocabulary.filter(F.col("n") >= least)
    words = key_filter(frequent, "h")
    pairs = stored(_frequent_pairs(source, seed, words, least), "frequent-pairs")
    leaves = _leaves(source, seed, words, key_filter(pairs, "key"), _groups(pairs))
    counted = stored(_subtree_counts(leaves, least), "phrase-counts")
    own = frequent.select("lang", "word", "h")
    phrases = counted.select(
        F.array_remove(F.array(*WORDS), F.lit(0).cast("long")).alias("ws"), "a", F.col("w1").alias("h")
    ).join(own.drop("word"), "h").drop("h")
    units = phrases.select("ws", "a").unionByName(
        frequent.select(F.array("h").alias("ws"), F.col("n").alias("a"))
    )
    scored = _scored(phrases.join(_absorbed(phrases), "ws", "left_anti"), units, totals)
    spelt = (
        scored.select("*", F.posexplode("ws").alias("at", "h")).join(own.drop("lang"), "h")
        .groupBy("lang", "ws", "a", "l", "r", "n", "score")
        .agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("named"))
        .withColumn("phrase", F.array_join(F.col("named.word"), " "))
    )
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = spelt.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def phrases_query(spark, folder: str) -> DataFrame:
    """The best 2000 phrases of each language of ``documents``."""
    return collocations(documents(spark, folder))


PHRASES_SQL = r"""
with pieces as (
  select lang, row_number() over () as piece, words from (
    select lang, regexp_extract_all(part, '[^\x20\x09]+') as words from (
      select coalesce(lang, 'und') as lang,
        unnest(regexp_split_to_array(translate(coalesce(text, ''),
          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as part
      from documents))),
totals as (select lang, cast(sum(len(words)) as hugeint) as n from pieces group by lang),
starts as (select lang, words, unnest(range(1, len(words) + 1)) as s from pieces),
grams as (
  select lang, words[s : s + k - 1] as ws from starts, range(1, 6) as sizes(k)
  where s + k - 1 <= len(words)),
counts as (
  select lang, ws, cast(count(*) as hugeint) as f from grams group by lang, ws having count(*) >= 100),
cuts as (
  select lang, ws, f, k, ws[1 : k] as x, ws[k + 1 :] as y
  from counts, range(1, 5) as places(k) where k < len(ws)),
scores as (
  select c.lang, c.ws, c.f as a, k, l.f as l, r.f as r, n, (1000 * c.f * n) // (l.f * r.f) as score
  from cuts c join counts l on l.lang = c.lang and l.ws = c.x
  join counts r on r.lang = c.lang and r.ws = c.y join totals t on t.lang = c.lang),
lowest as (
  select * from scores qualify row_number() over (partition by lang, ws order by score, k) = 1),
parts as (
  select lang, f, ws[i : i + m - 1] as ws from counts, range(2, 5) as sizes(m), range(1, 5) as places(i)
  where m < len(ws) and i + m - 1 <= len(ws)),
absorbed as (
  select distinct c.lang, c.ws from counts c join parts p on p.lang = c.lang and p.ws = c.ws
  where 100 * p.f >= 100 * c.f),
named as (
  select *, array_to_string(ws, ' ') as phrase from lowest anti join absorbed using (lang, ws)),
ranked as (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) as place from named)
select lang, cast(place as bigint) as rank, phrase, cast(a as bigint) as a, cast(l as bigint) as l,
  cast(r as bigint) as r, cast(n as bigint) as n, cast(score as bigint) as score
from ranked where place <= 2000
"""
