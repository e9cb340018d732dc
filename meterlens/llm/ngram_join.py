"""Exact n-gram Jaccard join by partitions of the token universe."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterlens.llm.common import documents, map_batches, stored
from meterlens.llm.components import connected_components
from meterlens.llm.words import WordHasher, combined, mixed, slices

WORDS = 5
THRESHOLD = 80  # per cent: linked when 100 * intersection >= 80 * union
BAND = 1.6  # sizes of a band lie within this ratio
SPARE = 1.2  # segments per needed one, so that poor ones can be left out
DELETION_SIZE = 128  # bands up to this start index one-deletion neighbours
SAMPLE_DOCS, FREQUENT = 20_000, 200_000  # bounds of the sample for costs and of its result
LONG_WORD = 128  # bytes; longer words have a hash of their own
TEXT_BYTES, DEALT_SHINGLES = 1 << 21, 1 << 17  # worked on at once
BITMAP_WORDS = 16  # 64-bit words of the parity bitmap


class Shingler:
    """Shingle sets of texts as sorted distinct 64-bit hashes."""

    def __init__(self, words: int = WORDS):
        self.words, self.hasher = words, WordHasher(b" \t\n\x0b\x0c\r", fold=True)

    def sets(self, texts: list[bytes]) -> list[np.ndarray]:
        """The set of each text; a text of fewer words than a shingle has one for all.

        The words of all texts are hashed together. A polynomial in the bytes tells short
        words apart; of longer ones some are built to meet.
        """
        data = b" ".join(texts)
        hashes, starts, ends = self.hasher(data)
        for i in np.flatnonzero(ends - starts > LONG_WORD):
            hashes[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]].lower())
        grams = combined(hashes, self.words)
        stops = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in texts]))
        sets, start = [], 0
        for stop in stops.tolist():
            size = stop - start
            if size >= self.words:
                sets.append(np.unique(grams[start : stop - self.words + 1]))
            elif size:
                sets.append(mixed(combined(hashes[start:stop], size) + np.uint64(size)))
            else:
                sets.append(np.zeros(0, np.uint64))
            start = stop
        return sets


def band_of(size: int) -> int:
    """Index of the size band; band i holds sizes from ``band_start(i)``."""
    band = max(0, int(np.log(size) / np.log(BAND)) - 1)
    while band_start(band + 1) <= size:
        band += 1
    return band


def band_start(band: int) -> int:
    return int(np.ceil(BAND**band))


def allowed(size: int) -> int:
    """Most differing shingles between a set of this size and a larger linked one: sizes
    a <= b differ in at most (a + b)(1 - t)/(1 + t) shingles, and b <= a/t."""
    return int(size * (100 - THRESHOLD) / THRESHOLD + 1e-9)


def segments(band: int) -> int:
    """Segments into which probes of a band split the universe."""
    need = allowed(band_start(band + 1) - 1) + 1
    return need if need < 3 else int(np.ceil(need * SPARE))


def bands_indexed(size: int) -> list[int]:
    """Bands whose probes may look for a set of this size: its own, and the one below if
    a set there can be small enough to link with it."""
    band = band_of(size)
    below = band > 0 and size * THRESHOLD <= 100 * (band_start(band) - 1)
    return [band, band - 1] if below else [band]


def allocation(sizes: np.ndarray, rare: np.ndarray, need: np.ndarray, small: bool) -> np.ndarray:
    """Weight of each segment (columns) of sets (rows): 0 not probed, 1 probed for equality,
    2 probed with its one-deletion neighbours (``small`` bands only).

    If two sets differ in fewer than ``need`` shingles and the weights add up to
    ``need``, some segment differs in fewer shingles than its weight. A probe costs as
    many partners as share the segment by chance: most where it is empty, many where
    all its shingles are frequent, fewer the more rare shingles have to agree. So the
    dearest segments are left out as far as spare ones go. Where that would still take
    an empty one, the richest segments get weight 2, a probe per shingle in them.
    """
    order = np.lexsort((-sizes, -np.minimum(rare, 2)))
    taken = np.arange(sizes.shape[1]) < need[:, None]
    weights = np.zeros(sizes.shape, np.int8)
    chosen = taken.astype(np.int8)
    if small:
        held = np.take_along_axis(sizes, order, 1)
        missing = (taken & (held == 0)).sum(1) + np.maximum(0, need - sizes.shape[1])
        rich = taken & (held > 1)
        rich &= np.cumsum(rich, 1) <= missing[:, None]
        chosen[rich] = 2
    np.put_along_axis(weights, order, chosen, 1)
    if small:
        empty = (weights == 1) & (sizes == 0)
        weights[empty & (np.cumsum(empty, 1) <= rich.sum(1)[:, None])] = 0
    return weights


def _band_keys(sets: list[np.ndarray], band: int, own: np.ndarray, frequent: np.ndarray):
    """Keys of sets in a band, the number of the set of each and whether it is a probe; sets
    that are not the band's ``own`` are only indexed.

    A set is dealt over the segments of the band. A segment's key hashes band, segment
    number and content; a one-deletion key is that of a segment without one shingle.
    """
    m, small = segments(band), band_start(band) <= DELETION_SIZE
    salt = np.uint64((band + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))
    number = mixed(np.arange(m, dtype=np.uint64) + salt * np.array([3], np.uint64))
    lengths = np.array([len(g) for g in sets])
    grams, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), lengths)
    part = ((mixed(grams ^ salt) >> np.uint64(20)) % np.uint64(m)).astype(np.int64)
    cell, values = owner * m + part, mixed(grams + salt)
    sums = np.zeros(len(sets) * m, np.uint64)
    np.add.at(sums, cell, values)
    keys = mixed(sums.reshape(-1, m) + number)

    weights = np.zeros(keys.shape, np.int8)
    if own.any():
        sizes = np.bincount(cell, minlength=len(sums)).reshape(keys.shape)
        rare = sizes
        if len(frequent):
            known = frequent[np.minimum(np.searchsorted(frequent, grams), len(frequent) - 1)] == grams
            rare = np.bincount(cell[~known], minlength=len(sums)).reshape(keys.shape)
        need = np.array([allowed(n) + 1 for n in lengths[own].tolist()])
        weights[own] = allocation(sizes[own], rare[own], need, small)
    numbers, probes = np.repeat(np.arange(len(sets)), m), (weights > 0).ravel()
    if not small:
        return keys.ravel(), numbers, probes
    deletions = mixed(sums[cell] - values + number[part])
    return (
        np.concatenate([keys.ravel(), deletions]), np.concatenate([numbers, owner]),
        np.concatenate([probes, weights.ravel()[cell] == 2]),
    )


def set_keys(sets: list[np.ndarray], frequent: np.ndarray):
    """Batches of keys of sets that aren't empty, the number of the set of each key and
    whether it is a probe; every key is in the index.

    One-deletion neighbours are in the index of the bands up to ``DELETION_SIZE``. In
    larger bands spare segments outnumber the empty ones, and the rare set for which they
    don't probes empty segments as well: more candidates, none lost. The sets of a band
    are dealt together, some ``DEALT_SHINGLES`` at once.
    """
    members: dict[int, list[int]] = {}
    for i, grams in enumerate(sets):
        for band in bands_indexed(len(grams)):
            members.setdefault(band, []).append(i)
    for band, numbers in members.items():
        held = np.cumsum([len(sets[i]) for i in numbers]) // DEALT_SHINGLES
        for group in np.split(np.array(numbers), np.flatnonzero(np.diff(held)) + 1):
            own = np.array([band_of(len(sets[i])) == band for i in group])
            keys, owner, probes = _band_keys([sets[i] for i in group], band, own, frequent)
            yield keys, group[owner], probes


def parity(grams: np.ndarray) -> np.ndarray:
    """Bitmap of hashed shingle parities: two sets differ in at least as many shingles as
    their bitmaps do in bits."""
    bits = mixed(grams) & np.uint64(64 * BITMAP_WORDS - 1)
    odd = (np.bincount(bits.astype(np.int64), minlength=64 * BITMAP_WORDS) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def _node(grams: np.ndarray) -> int | None:
    return xxhash.xxh3_64_intdigest(grams.tobytes()) - 2**63 if len(grams) else None


def _described(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (id, text_key, n, node, bits): a hash of the text, set size, 64-bit hash of the set
    (null if empty), bitmap."""

    def run(batches):
        shingler = Shingler()
        for batch in batches:
            for at, texts in slices(batch, 1, TEXT_BYTES):
                sets = shingler.sets(texts)
                n = [len(grams) for grams in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(n)),
                        batch.column(2).slice(at, len(n)),
                        pa.array(n, pa.int64()),
                        pa.array(map(_node, sets), pa.int64()),
                        pa.array(list(map(parity, sets)), pa.list_(pa.int64())),
                    ],
                    names=["id", "text_key", "n", "node", "bits"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, text_key long, n long, node long, bits array<long>"
    return map_batches(docs.select(id_col, text_col, F.xxhash64(text_col)), run, schema)


def _frequent(docs: DataFrame, text_col: str, total: int) -> np.ndarray:
    """Sorted hashes of shingles that many documents of a bounded sample hold. They only
    steer which segments are probed; results don't depend on them."""

    def run(batches):
        shingler = Shingler()
        for batch in batches:
            for _, texts in slices(batch, 0, TEXT_BYTES):
                grams = np.concatenate(shingler.sets(texts))
                yield pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64))], names=["gram"])

    share = min(1.0, SAMPLE_DOCS / max(total, 1))
    limit = int(share * 2**32)
    sample = docs.select(text_col).filter(F.crc32(F.col(text_col).cast("binary")) < limit)
    least = max(3, int(share * total / 10_000))
    rows = (
        map_batches(sample, run, "gram long").groupBy("gram").count()
        .filter(F.col("count") >= least).orderBy(F.desc("count"), "gram").limit(FREQUENT).collect()
    )
    return np.sort(np.array([r.gram for r in rows], np.int64).view(np.uint64))


def _unseen(sets: list[np.ndarray], seen: set[int]) -> tuple[list[int], list[np.ndarray]]:
    """The nodes not ``seen`` before, and their sets; empty sets are none."""
    new = {node: grams for node, grams in zip(map(_node, sets), sets) if node is not None and node not in seen}
    seen.update(new)
    return list(new), list(new.values())


def _keyed(docs: DataFrame, text_col: str, frequent: np.ndarray) -> DataFrame:
    """Rows (key, node, probe), once per distinct set of a task."""

    def run(batches):
        shingler, seen = Shingler(), set()
        for batch in batches:
            for _, texts in slices(batch, 0, TEXT_BYTES):
                nodes, sets = _unseen(shingler.sets(texts), seen)
                names = np.array(nodes, np.int64)
                for keys, numbers, probes in set_keys(sets, frequent):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys.view(np.int64)), pa.array(names[numbers]), pa.array(probes)],
                        names=["key", "node", "probe"],
                    )

    return map_batches(docs.select(text_col), run, "key long, node long, probe boolean")


def _sets(docs: DataFrame, text_col: str, wanted: DataFrame, described: DataFrame, id_col: str):
    """Rows (node, grams), one for each wanted node and now and then one that isn't wanted.

    Rows are fetched by id and hash of the text, one of each node. Ids may be null or stand
    on several texts and hashes may meet, so a node is told from the fetched text itself.
    """
    one = (
        described.join(wanted, "node", "left_semi").groupBy("node")
        .agg(F.min(F.struct("text_key", "id")).alias("row"))
        .select(F.col("row.text_key").alias("wanted_key"), F.col("row.id").alias("wanted_id"))
    )

    def run(batches):
        shingler, seen = Shingler(), set()
        for batch in batches:
            for _, texts in slices(batch, 0, TEXT_BYTES):
                nodes, sets = _unseen(shingler.sets(texts), seen)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes, pa.int64()), pa.array([g.view(np.int64) for g in sets], pa.list_(pa.int64()))],
                    names=["node", "grams"],
                )

    keyed = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_key"))
    same = (F.col("text_key") == F.col("wanted_key")) & F.col("id").eqNullSafe(F.col("wanted_id"))
    texts = keyed.join(one.hint("shuffle_hash"), same, "left_semi").select("text")
    return map_batches(texts, run, "node long, grams array<long>").dropDuplicates(["node"])


def _linked(pairs: DataFrame, described: DataFrame, sets) -> DataFrame:
    """The pairs (a, b) of nodes that link: bounded by size and bitmap, then in full."""
    nodes = described.filter("n > 0").groupBy("node").agg(F.first("n").alias("n"), F.first("bits").alias("bits"))
    left = nodes.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("bits").alias("bits_a"))
    right = nodes.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("bits_b"))
    total = F.col("na") + F.col("nb")
    differ = sum(
        F.bit_count(F.element_at("bits_a", i + 1).bitwiseXOR(F.element_at("bits_b", i + 1)))
        for i in range(BITMAP_WORDS)
    )
    possible = stored(
        pairs.join(left, "a").join(right, "b")
        .filter(100 * F.least("na", "nb") >= THRESHOLD * F.greatest("na", "nb"))
        .filter((100 + THRESHOLD) * differ <= (100 - THRESHOLD) * total)
        .select("a", "b"),
        "join-possible",
    )
    wanted = possible.select(F.col("a").alias("node")).union(possible.select("b")).distinct()
    full = stored(sets(wanted), "join-sets")
    both = F.size(F.array_intersect("grams_a", "grams_b"))
    union = F.size("grams_a") + F.size("grams_b") - both
    return (
        possible.join(full.select(F.col("node").alias("a"), F.col("grams").alias("grams_a")), "a")
        .join(full.select(F.col("node").alias("b"), F.col("grams").alias("grams_b")), "b")
        .filter(100 * both >= THRESHOLD * union)
        .select("a", "b")
    )


def ngram_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``n_shingles``, ``component_id``.

    Words are split at blanks, A-Z lowered; a set holds the distinct shingles of five
    words (of all words if fewer, none without words). Documents link when 100 times the
    intersection is at least 80 times the union; a component is named by its smallest
    id. An empty set links with nothing and names its own row. Null texts count as
    empty; null ids are ordinary but never the smallest unless alone; repeated rows get
    a row each. Shingles and sets are compared by 64-bit hashes.

    Documents of equal sets are one node. Each node splits the shingle universe into
    segments and is found by any segment that a linked node keeps. All nodes of a key
    are first compared with the key's first probing node only; then, for keys whose nodes are
    not yet in one component, every probing node with all nodes of other components.
    So a large group of near copies is never listed as pairs, yet no link is lost that
    could change a component.
    """
    docs = docs.select(id_col, text_col)
    described = stored(_described(docs, id_col, text_col), "join-described")
    frequent = _frequent(docs, text_col, described.count())
    # Probing nodes come first in a key, so the first one tells whether any probes it.
    order = Window.partitionBy("key").orderBy(F.desc("probe"), "node")
    shared = stored(
        _keyed(docs, text_col, frequent)
        .withColumn("first", F.first("node").over(order))
        .withColumn("probed", F.first("probe").over(order))
        .withColumn("next", F.lead("node").over(order))
        .filter("probed").filter((F.col("node") != F.col("first")) | (F.col("next") != F.col("node")))
        .select("key", "node", "probe", "first"),
        "join-keys",
    )
    sets = lambda wanted: _sets(docs, text_col, wanted, described, id_col)
    stars = (
        shared.filter("node <> first")
        .select(F.least("first", "node").alias("a"), F.greatest("first", "node").alias("b")).distinct()
    )
    links = stored(_linked(stars, described, sets), "join-links")
    labels = connected_components(links)
    placed = shared.select("key", "node", "probe").join(labels, "node", "left").select(
        "key", "node", "probe", F.coalesce("component", "node").alias("component")
    )
    placed = stored(placed, "join-placed")
    open_keys = (
        placed.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"))
        .filter("x <> y").select("key")
    )
    # Size and folded bitmap are compared inside the join: pairs that can't link don't
    # leave it.
    half = BITMAP_WORDS // 2
    folded = [f"f{i}" for i in range(half)]
    short = described.filter("n > 0").groupBy("node").agg(
        F.first("n").alias("n"), F.first("bits").alias("bits")
    ).select("node", "n", *[
        F.element_at("bits", i + 1).bitwiseXOR(F.element_at("bits", i + 1 + half)).alias(f)
        for i, f in enumerate(folded)
    ])
    rest = placed.join(open_keys, "key").distinct().join(short, "node")
    probing = rest.filter("probe").select(
        "key", F.col("node").alias("p"), F.col("component").alias("p_in"), F.col("n").alias("p_n"),
        *[F.col(f).alias(f"p_{f}") for f in folded],
    )
    differ = sum(F.bit_count(F.col(f).bitwiseXOR(F.col(f"p_{f}"))) for f in folded)
    possible = (
        (F.col("p_in") != F.col("component"))
        & (100 * F.least("n", "p_n") >= THRESHOLD * F.greatest("n", "p_n"))
        & ((100 + THRESHOLD) * differ <= (100 - THRESHOLD) * (F.col("n") + F.col("p_n")))
    )
    rest = rest.select(F.col("key").alias("rest_key"), "node", "component", "n", *folded)
    across = (
        probing.join(rest, (F.col("key") == F.col("rest_key")) & possible)
        .select(F.least("p", "node").alias("a"), F.greatest("p", "node").alias("b")).distinct()
        .join(stars, ["a", "b"], "left_anti")
    )
    links = links.unionByName(_linked(across, described, sets))
    labels = connected_components(links)
    grouped = described.join(labels, "node", "left").withColumn("set", F.coalesce("component", "node"))
    grouped = stored(grouped.select("id", "n", "set"), "join-grouped")
    names = grouped.filter("set is not null").groupBy("set").agg(F.min("id").alias("name"))
    return grouped.join(names, "set", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("set").isNull(), F.col("id")).otherwise(F.col("name")).alias("component_id"),
    )


def ngram_join_query(spark, folder: str) -> DataFrame:
    """Components of near-equal documents among all ``documents``."""
    return ngram_components(documents(spark, folder))


NGRAM_JOIN_SQL = r"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents),
shingles as (
  select distinct doc_id, unnest(case when len(w) = 0 then []::varchar[]
    when len(w) < 5 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as s
  from words),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
links as (
  select a.doc_id as x, b.doc_id as y
  from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id
    join sizes p on p.doc_id = a.doc_id join sizes q on q.doc_id = b.doc_id
  group by a.doc_id, b.doc_id, p.n, q.n
  having 100 * count(*) >= 80 * (p.n + q.n - count(*))),
reach as (
  select doc_id, doc_id as other from documents
  union
  select r.doc_id, l.y from reach r join links l on r.other = l.x)
select d.doc_id, coalesce(any_value(n), 0) as n_shingles, min(other) as component_id
from documents d left join sizes s on s.doc_id = d.doc_id join reach r on r.doc_id = d.doc_id
group by d.doc_id
"""
