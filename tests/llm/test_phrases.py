"""Collocations against counts of all phrases in plain Python."""

import random
import re
from collections import Counter

import pytest

from meterlens.llm import phrases

DOCS = "doc_id bigint, text string, lang string, n bigint, h int, word string, a string"


def expected(rows, least, top):
    counts, totals = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", lower):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i : i + k])] += 1
    out = []
    for lang, found in counts.items():
        kept = {p: a for p, a in found.items() if a >= least and len(p) > 1}
        absorbed = {
            p[i : i + m]
            for p, a in kept.items()
            for m in range(2, len(p))
            for i in range(len(p) - m + 1)
            if 100 * a >= 100 * found[p[i : i + m]]
        }
        scored = []
        for p, a in kept.items():
            if p in absorbed:
                continue
            score, k = min(
                (1000 * a * totals[lang] // (found[p[:k]] * found[p[k:]]), k) for k in range(1, len(p))
            )
            scored.append((-score, -a, " ".join(p).encode(), found[p[:k]], found[p[k:]]))
        for rank, (score, a, name, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, name.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def made(seed):
    draw = random.Random(seed)
    names = ["New", "york", "the", "of", "é", "漢", "state", "a", "b", "\x00", "x-y"]
    fixed = ["new york state of", "a a a a a a", "x-y é 漢"]
    rows = []
    for _ in range(300):
        words = [draw.choice(names + fixed) for _ in range(draw.randint(0, 25))]
        text = "".join(w + draw.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\r\n", " "]) for w in words)
        rows.append((text, draw.choice(["en", "en", "en", "De", "de", None, ""])))
    return [*rows, (None, "en"), ("", "en"), ("only here once", "xx"), ("a b " * 20_000, "fr"), rows[0], rows[0]]


@pytest.fixture(scope="module")
def table(spark):
    def build(rows):
        data = [(i, text, lang, 1, 2, "w", "a") for i, (text, lang) in enumerate(rows)]
        return spark.createDataFrame(data, DOCS).repartition(4)

    return build


def results(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("least, top, leaves", [(5, 2000, 2_000_000), (5, 7, 50), (100, 2000, 1)])
def test_every_phrase_against_plain_counts(table, monkeypatch, least, top, leaves):
    monkeypatch.setattr(phrases, "LEAVES", leaves)
    rows = made(least)
    found = results(phrases.collocations(table(rows), least=least, top=top))
    assert len(found) > 5 and found == expected(rows, least, top)


def test_an_empty_table(table):
    assert results(phrases.collocations(table([]))) == []


def test_products_beyond_64_bits_are_exact(spark):
    big, ws = 4_000_000_000_000, "array<bigint>"
    found = spark.createDataFrame([([1, 2], big, "en")], f"ws {ws}, a bigint, lang string")
    units = spark.createDataFrame([([1], big + 1), ([2], big + 3)], f"ws {ws}, a bigint")
    totals = spark.createDataFrame([("en", 9_999_999_999_999)], "lang string, total bigint")
    (row,) = phrases._scored(found, units, totals).collect()
    assert row.score == 1000 * big * 9_999_999_999_999 // ((big + 1) * (big + 3))


def test_a_colliding_word_hash_is_replaced(table, monkeypatch):
    class Poor(phrases.WordHasher):
        def __call__(self, data):
            hashes, starts, ends = super().__call__(data)
            return (hashes % 5 if self.poor else hashes), starts, ends

    def hasher(seed):
        made_ = Poor(phrases.ENDS + phrases.BLANKS, fold=True, seed=seed)
        made_.poor = seed < 2
        return made_

    monkeypatch.setattr(phrases, "_hasher", hasher)
    rows = made(3)[:200]
    assert results(phrases.collocations(table(rows), least=5)) == expected(rows, 5, 2000)
