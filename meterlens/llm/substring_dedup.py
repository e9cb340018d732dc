"""Removal of repeated byte strings: anchored strings in suffix order, anchor by anchor."""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlens.llm.common import documents, map_batches, stored, whole_text

LENGTH = 200  # bytes of a string that counts as repeated
GRAM = 50  # bytes of an anchor
SEGMENT = 2**20  # bytes looked at together; the positions of an anchor need 24 bits
GROUP = 1000  # contexts of one anchor that are sorted together
BATCH = 2**18  # context bytes sorted at once
# A key with more than a SPREAD-th of all rows is hot: there are fewer than SPREAD of them,
# and the rows of each are dealt over as many salts.
SPREAD = 1000

_RNG = np.random.default_rng(20240607)
_BYTES = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_POWERS: list[np.ndarray] = []


def _mix(x):
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if not _POWERS or len(_POWERS[0]) < n:
        inverse = pow(_BASE, -1, 2**64)
        _POWERS[:] = [
            np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, np.uint64(b)))]) for b in (_BASE, inverse)
        ]
    return _POWERS[0], _POWERS[1]


def anchors(data: np.ndarray, ends: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Anchors of the strings of ``length`` bytes in some texts put end to end.

    Each string is assigned the leftmost of its grams with the smallest hash, which its
    content alone decides: equal strings have their anchor at the same place. Gives for
    each run of strings with one anchor: hash of the gram, hash of the run's bytes and
    place, first and last start of its strings, start of the gram.
    """
    n, windows = len(data), length - gram + 1
    power, inverse = _powers(max(n, SEGMENT) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[data] * power[:n])])
    grams = n - gram + 1
    if grams < windows:
        return [np.zeros(0, np.uint64)] * 2 + [np.zeros(0, np.int64)] * 3
    hashes = _mix((sums[gram:] - sums[:grams]) * inverse[:grams])
    key = (hashes & ~np.uint64(2**24 - 1)) | np.arange(grams, dtype=np.uint64)
    pad = -grams % windows
    blocks = np.concatenate([key, np.full(pad, 2**64 - 1, np.uint64)]).reshape(-1, windows)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = grams - windows + 1
    least = np.minimum(behind[:starts], ahead[windows - 1 : windows - 1 + starts])
    anchor = (least & np.uint64(2**24 - 1)).astype(np.int64)
    # A string has to lie inside one text.
    at = np.arange(starts)
    inside = at + length <= ends[np.searchsorted(ends, at, side="right")]
    new = np.ones(starts, bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | ~inside[:-1]
    first = np.flatnonzero(inside & new)
    stop = np.ones(starts, bool)
    stop[:-1] = new[1:] | ~inside[1:]
    last = np.flatnonzero(inside & stop)
    place = anchor[first]
    whole = (sums[last + length] - sums[first]) * inverse[first]
    shape = ((place - first) * 1000 + (last - first)).astype(np.uint64)
    return [hashes[place], _mix(whole + _mix(shape)), first, last, place]


def _segments(text: bytes, length: int):
    """(offset, bytes) parts of a text that together hold each of its strings once."""
    for offset in range(0, max(len(text) - length + 1, 0), SEGMENT - length + 1):
        yield offset, text[offset : offset + SEGMENT]


def _anchored(docs: DataFrame) -> DataFrame:
    """Rows (gram, run, uid, first, more, back) of all anchors. The strings start at
    first..first + more, the gram ``back`` bytes after the first one."""

    def run(batches):
        for batch in batches:
            parts: list[tuple[int, int, bytes]] = []
            size = 0
            uids = batch.column(0).to_pylist()
            for uid, text in zip(uids, batch.column(1).to_pylist(), strict=True):
                coded = text.encode()
                for offset, part in _segments(coded, LENGTH):
                    parts.append((uid, offset, part))
                    size += len(part)
                    if size >= SEGMENT:
                        yield found(parts)
                        parts, size = [], 0
            if parts:
                yield found(parts)

    def found(parts):
        data = np.frombuffer(b"".join(p for _, _, p in parts), np.uint8)
        sizes = np.array([len(p) for _, _, p in parts])
        ends = np.cumsum(sizes)
        gram, whole, first, last, place = anchors(data, ends)
        part = np.searchsorted(ends, first, side="right")
        shift = np.array([o for _, o, _ in parts]) - (ends - sizes)
        uid = np.array([u for u, _, _ in parts], np.int64)[part]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(gram.view(np.int64)), pa.array(whole.view(np.int64)), pa.array(uid),
                pa.array((first + shift[part]).astype(np.int64)),
                pa.array((last - first).astype(np.int32)), pa.array((place - first).astype(np.int32)),
            ],
            names=["gram", "run", "uid", "first", "more", "back"],
        )

    schema = "gram long, run long, uid long, first long, more int, back int"
    return map_batches(docs.select("uid", "text"), run, schema)


def previous_and_next(strings: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each suffix, cut to ``LENGTH`` bytes: whether an equal one stands at a smaller
    ``rank`` (place in the corpus), and at a larger one.

    In suffix order the suffixes that share their first ``LENGTH`` bytes are neighbours.
    Ordered by place inside such a run, the previous smaller position is the neighbour
    before and the next one the neighbour after: where it is in the run, the longest
    previous factor is at least ``LENGTH``.
    """
    order = np.lexsort((rank, _suffix_ranks(strings)))
    ordered = strings[order]
    same = (ordered[1:] == ordered[:-1]).all(axis=1)
    earlier, later = np.zeros(len(order), bool), np.zeros(len(order), bool)
    earlier[order[1:]] = same
    later[order[:-1]] = same
    return earlier, later


def _suffix_ranks(strings: np.ndarray) -> np.ndarray:
    """Rank of each row among the distinct rows in byte order."""
    flat = np.ascontiguousarray(strings).view(np.dtype((np.void, strings.shape[1]))).ravel()
    order = np.argsort(flat)
    ordered = strings[order]
    new = np.ones(len(order), np.int64)
    new[1:] = (ordered[1:] != ordered[:-1]).any(axis=1)
    ranks = np.empty(len(order), np.int64)
    ranks[order] = np.cumsum(new)
    return ranks


def _compared(contexts: DataFrame, keep_first: bool) -> DataFrame:
    """Rows (uid, first, last): starts of strings with an equal one in their group (gram,
    key), or with one at an earlier place. Takes rows (gram, key, uid, first, context)."""

    def run(batches):
        held: list[tuple] = []
        size, last_key = 0, None
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(5)]
            for row in zip(*columns, strict=True):
                key = row[:2]
                if key != last_key and size >= BATCH:
                    yield compare(held)
                    held, size = [], 0
                last_key = key
                held.append(row)
                size += len(row[4])
        if held:
            yield compare(held)

    def compare(rows):
        data = np.frombuffer(b"".join(r[4] for r in rows), np.uint8)
        sizes = np.array([len(r[4]) for r in rows])
        counts = sizes - LENGTH + 1
        owner = np.repeat(np.arange(len(rows)), counts)
        step = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        start = np.repeat(np.cumsum(sizes) - sizes, counts) + step
        strings = np.lib.stride_tricks.sliding_window_view(data, LENGTH)[start]
        # Contexts come in the order of their places, so a string's index is its rank.
        earlier, later = previous_and_next(strings, np.arange(len(start)))
        first = np.array([r[3] for r in rows], np.int64)[owner] + step
        uid = np.array([r[2] for r in rows], np.int64)[owner]
        kept = np.flatnonzero(earlier if keep_first else earlier | later)
        breaks = np.ones(len(kept), bool)
        breaks[1:] = (kept[1:] != kept[:-1] + 1) | (owner[kept[1:]] != owner[kept[:-1]])
        begin = kept[breaks]
        stop = kept[np.append(np.flatnonzero(breaks)[1:] - 1, len(kept) - 1)] if len(kept) else begin
        return pa.RecordBatch.from_arrays(
            [pa.array(uid[begin]), pa.array(first[begin]), pa.array(first[stop])], names=["uid", "first", "last"]
        )

    groups = contexts.repartition("gram", "key").sortWithinPartitions("gram", "key", "uid", "first")
    return map_batches(groups, run, "uid long, first long, last long")


def _joined(rows: DataFrame, facts: DataFrame, keys: list[str], count: str, how: str = "inner") -> DataFrame:
    """``rows`` (with uid, first) joined with ``facts``, a stored table of one row per key
    and the ``count`` of its rows. Only the keys of hot ones are broadcast, fewer than
    ``SPREAD``; no other key has more than that share of the rows."""
    total = facts.agg(F.sum(count)).first()[0] or 0
    hot = F.broadcast(facts.filter(F.col(count) > max(GROUP, total // SPREAD)).select(*keys, F.lit(True).alias("hot")))
    dealt = rows.join(hot, keys, "left").withColumn(
        "salt", F.when(F.col("hot"), F.pmod(F.xxhash64("uid", "first"), F.lit(SPREAD))).otherwise(0).cast("int")
    )
    salted = facts.join(hot, keys, "left").withColumn(
        "salt", F.explode(F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SPREAD - 1))).otherwise(F.array(F.lit(0))))
    )
    return dealt.drop("hot").join(salted.drop("hot"), [*keys, "salt"], how).drop("salt")


def _halves(level: DataFrame) -> DataFrame:
    """The strings of each context, dealt by the halves of the range ``lo``..``hi`` in which
    their anchor's offset lies.

    All strings of a half hold the same bytes around their gram: the smaller the range the
    more, the whole string at last. The ``key`` hashes these, so that equal strings stay
    together; ``run`` hashes all bytes of the half's strings.
    """
    mid = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
    halves = F.array(
        F.struct(F.col("lo").alias("a"), mid.alias("b")), F.struct((mid + 1).alias("a"), F.col("hi").alias("b"))
    )
    place = F.col("first") + F.col("back")
    begin = F.greatest("first", place - F.col("half.b"))
    end = F.least(F.col("first") + F.col("more"), place - F.col("half.a"))
    cut = level.withColumn("half", F.explode(halves)).withColumn("begin", begin).withColumn("end", end)
    cut = cut.filter("begin <= end").select(
        "gram", F.col("half.a").alias("lo"), F.col("half.b").alias("hi"), "uid", F.col("begin").alias("first"),
        (F.col("end") - F.col("begin")).cast("int").alias("more"), (place - F.col("begin")).cast("int").alias("back"),
        F.col("context").substr(
            (F.col("begin") - F.col("first") + 1).cast("int"), (F.col("end") - F.col("begin") + LENGTH).cast("int")
        ).alias("context"),
    )
    shared = F.col("context").substr(F.col("back") - F.col("lo") + 1, LENGTH + F.col("lo") - F.col("hi"))
    return cut.select(
        "*", F.xxhash64("lo", shared).alias("key"), F.xxhash64("context", "back", "more").alias("run")
    )


def _copies(rows: DataFrame, keep_first: bool) -> DataFrame:
    """Rows (uid, first, last) of the runs that have an equal run; ``u`` and ``f`` tell the
    place of the first of these."""
    copied = F.col("times") > 1
    if keep_first:
        copied &= (F.col("uid") != F.col("u")) | (F.col("first") != F.col("f"))
    return rows.filter(copied).select("uid", "first", (F.col("first") + F.col("more")).alias("last"))


def repeated_spans(docs: DataFrame, keep_first: bool = False) -> DataFrame:
    """Rows (uid, first, last): starts first..last of strings of ``LENGTH`` bytes that also
    start elsewhere in the same ``text`` or in one of another ``uid``; with ``keep_first``
    those that also start at an earlier place (order of uid and position). A uid has one
    row."""
    rows = _anchored(docs)
    repeated = stored(rows.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "repeat-grams")
    kept = stored(_joined(rows, repeated, ["gram"], "n", "left_semi"), "repeat-anchors")
    times = F.count(F.lit(1)).alias("times")
    least = F.min(F.struct("uid", "first")).alias("place")
    runs = kept.groupBy("gram", "run").agg(times, least, F.min("more").alias("more"), F.min("back").alias("back"))
    runs = stored(
        runs.select("gram", "run", "times", F.col("place.uid").alias("uid"), F.col("place.first").alias("first"), "more", "back"),
        "repeat-runs",
    )
    several = F.count(F.lit(1)).alias("variants")
    variants = stored(runs.groupBy("gram").agg(several).filter("variants > 1"), "repeat-variants")
    firsts = runs.filter("times > 1").select("gram", "run", "times", F.col("uid").alias("u"), F.col("first").alias("f"))
    found = [_copies(_joined(kept, firsts, ["gram", "run"], "times"), keep_first)]
    wanted = _joined(runs.drop("times", "run"), variants, ["gram"], "variants")
    places = wanted.groupBy("uid").agg(
        F.collect_list(F.struct("gram", "variants", "first", "more", "back")).alias("places")
    )

    def cut(batches):
        for batch in batches:
            out = []
            for uid, text, places in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                coded = text.encode()
                out += [
                    (p["gram"], p["variants"], uid, p["first"], p["more"], p["back"], coded[p["first"] : p["first"] + p["more"] + LENGTH])
                    for p in places
                ]
                if len(out) > 5000:
                    yield contexts_batch(out)
                    out = []
            if out:
                yield contexts_batch(out)

    def contexts_batch(out):
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
            names=["gram", "variants", "uid", "first", "more", "back", "context"],
        )

    texts = docs.select("uid", "text").join(places.hint("shuffle_hash"), "uid").select("uid", "text", "places")
    schema = "gram long, variants long, uid long, first long, more int, back int, context binary"
    contexts = stored(map_batches(texts, cut, schema), "repeat-contexts")
    small = ["gram", "key", "uid", "first", "context"]
    sorted_together = [contexts.filter(F.col("variants") <= GROUP).withColumn("key", F.lit(0).cast("long")).select(*small)]
    level = contexts.filter(F.col("variants") > GROUP).select(
        "*", F.lit(0).alias("lo"), F.lit(LENGTH - GRAM).alias("hi")
    )
    keys = ["gram", "key"]
    while not level.isEmpty():
        halves = stored(_halves(level), "repeat-halves")
        equal = halves.groupBy(*keys, "run").agg(times, least).select(
            *keys, "run", "times", F.col("place.uid").alias("u"), F.col("place.first").alias("f")
        )
        met = stored(_joined(halves, stored(equal, "repeat-equal"), [*keys, "run"], "times"), "repeat-met")
        found.append(_copies(met, keep_first))
        one = met.filter("uid = u and first = f").drop("run", "times", "u", "f")
        variants = stored(one.groupBy(*keys).agg(several).filter("variants > 1"), "repeat-variants")
        level = stored(_joined(one, variants, keys, "variants"), "repeat-level")
        sorted_together.append(level.filter(F.col("variants") <= GROUP).select(*small))
        level = level.filter(F.col("variants") > GROUP)
    found.append(_compared(functools.reduce(DataFrame.unionByName, sorted_together), keep_first))
    return functools.reduce(DataFrame.unionByName, found)


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_first: bool = False
) -> DataFrame:
    """One row per input row: id, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept``.

    Removes each byte covered by a string of ``LENGTH`` bytes that also starts anywhere
    else, in the same text or another; with ``keep_first`` only by one that starts at an
    earlier place too (order of the text's hash, then position; of equal texts the rows of
    the smallest id), so that one copy stays. ``kept`` holds the other bytes. Null texts
    count as empty; texts shorter than a string stay whole; repeated rows and null ids are
    rows like others. Texts are told apart by a 64-bit hash.

    A suffix order of all bytes is not built: equal strings share their anchor, so only
    suffixes at anchors that occur again are put in suffix order, anchor by anchor. Runs
    of strings that are equal as a whole are told by hash before that. The contexts of an
    anchor with very many of them are dealt by the bytes that all their strings share on
    either side of it, again and again by halves of the anchor's offset where these are
    frequent too: equal strings stay in one group, and no row is made per string.
    """
    base = docs.select(
        F.col(id_col).alias("id"), whole_text(F.col(text_col)).alias("text"),
        F.xxhash64(whole_text(F.col(text_col))).alias("uid"),
    )
    copies = stored(
        base.filter(F.octet_length("text") >= LENGTH).groupBy("uid")
        .agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("one")).filter("n > 1"),
        "repeat-copies",
    )
    long = base.filter(F.octet_length("text") >= LENGTH).select("uid", "text")
    spans = repeated_spans(stored(long.distinct(), "repeat-texts"), keep_first)
    found = (
        spans.select("uid", F.struct("first", "last").alias("span"), F.lit(False).alias("copied"))
        .unionByName(copies.select("uid", F.lit(None).cast("struct<first:bigint,last:bigint>").alias("span"), F.lit(True).alias("copied")))
        .groupBy("uid").agg(F.collect_list("span").alias("spans"), F.max("copied").alias("copied"))
    )
    # At most 1000 texts have more than a thousandth of all rows. Their rows are removed
    # whole and need not meet in a join.
    most = max(1000, docs.count() // 1000)
    hot = F.broadcast(copies.filter(F.col("n") > most).select("uid"))
    rest, removed_whole = (base, None) if keep_first else (
        base.join(hot, "uid", "left_anti"),
        base.join(hot, "uid", "left_semi").select(
            "id", F.octet_length("text").cast("long").alias("n_bytes"),
            F.octet_length("text").cast("long").alias("n_removed"),
            F.lit(1).cast("long").alias("n_spans"), F.lit("").cast("binary").alias("kept"),
        ),
    )

    def cut(batches):
        for batch in batches:
            ids, texts, all_spans, whole = (batch.column(i) for i in range(4))
            rows = []
            for text, spans, copied in zip(texts.to_pylist(), all_spans.to_pylist(), whole.to_pylist(), strict=True):
                coded, kept, end, removed = text.encode(), [], 0, 0
                n_spans, begin = 0, 0
                if copied:
                    spans = [{"first": 0, "last": len(coded) - LENGTH}]
                for s in sorted((s["first"], s["last"] + LENGTH) for s in spans or ()):
                    if n_spans and s[0] <= end:
                        if s[1] > end:
                            removed += s[1] - end
                            end = s[1]
                    else:
                        kept.append(coded[end : s[0]])
                        n_spans += 1
                        removed += s[1] - s[0]
                        end = s[1]
                kept.append(coded[end:])
                rows.append((len(coded), removed, n_spans, b"".join(kept)))
            n_bytes, n_removed, counts, left = zip(*rows, strict=True) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(counts, pa.int64()), pa.array(left, pa.binary())],
                names=["id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    # With keep_first, of equal texts the row of the smallest id keeps what its spans leave.
    stays = F.lit(False)
    if keep_first:
        found = found.join(copies.select("uid", "one"), "uid", "left")
        stays = F.col("id") == F.col("one")
    joined = rest.join(found.hint("shuffle_hash"), "uid", "left").select(
        "id", "text", "spans", (F.coalesce("copied", F.lit(False)) & ~F.coalesce(stays, F.lit(False))).alias("copied")
    )
    out = map_batches(joined, cut, f"id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")
    if removed_whole is not None:
        out = out.unionByName(removed_whole)
    return out.withColumnRenamed("id", id_col)


def substring_dedup_query(spark, folder: str) -> DataFrame:
    """What remains of all ``documents`` without any repeated string of 200 bytes."""
    return remove_repeats(documents(spark, folder)).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )
