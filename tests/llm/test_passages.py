"""Removal of known passages against a comparison of all windows."""

import random

import pytest

from meterlens.llm import passages
from meterlens.llm.words import CHUNK, WordHasher

DOCS = "doc_id bigint, text string, id int, mark string, own_id int, words string"


def words_of(text):
    return (text or "").encode().split()


def expected(rows, window=13):
    first = {}
    for id_, text in rows:
        words, key = words_of(text), (id_ is None, id_ or 0)
        for i in range(len(words) - window + 1):
            w = tuple(words[i : i + window])
            first[w] = min(first.get(w, key), key)
    out = []
    for id_, text in rows:
        words, gone, key = words_of(text), set(), (id_ is None, id_ or 0)
        for i in range(len(words) - window + 1):
            if first[tuple(words[i : i + window])] < key:
                gone.update(range(i, i + window))
        kept = [w for i, w in enumerate(words) if i not in gone]
        out.append((id_, len(words), len(gone), b" ".join(kept).decode()))
    return sorted(out, key=repr)


def made(seed):
    draw = random.Random(seed)
    vocabulary = ["".join(draw.choices("abcé漢", k=draw.randint(1, 4))) for _ in range(60)]

    def prose(n):
        return draw.choices(vocabulary, k=n)

    shared = [prose(draw.randint(10, 60)) for _ in range(12)]
    few = [["x"] * 40, ["x", "y"] * 30, prose(3) * 20]
    rows = []
    for i in range(150):
        parts = [prose(draw.randint(0, 30))]
        for _ in range(draw.randint(0, 4)):
            passage = draw.choice(shared + few)
            cut = draw.randint(0, 5)
            parts += [passage[cut:], prose(draw.randint(0, 20))]
        words = [w for part in parts for w in part]
        text = "".join(w + draw.choice([" ", " ", "  ", "\n", "\t \r"]) for w in words)
        rows.append((draw.choice([i, i, i, None, 7]), text))
    rows += [(500, None), (501, ""), (502, " \n"), (503, "x"), rows[3], rows[3], (None, rows[5][1])]
    rows.append((999, " ".join(prose(4000) + shared[0] + prose(4000))))
    return rows


@pytest.fixture(scope="module")
def table(spark):
    def build(rows):
        return spark.createDataFrame([(*r, 7, "m", 7, "w") for r in rows], DOCS).repartition(5)

    return build


def results(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("often", [5000, 2])
def test_every_word_against_all_windows(table, monkeypatch, often):
    monkeypatch.setattr(passages, "OFTEN", often)
    rows = made(often)
    assert results(passages.without_known_passages(table(rows))) == expected(rows)


def test_other_windows_and_an_empty_table(table):
    rows = made(9)[:60]
    found = passages.without_known_passages(table(rows), window=6, gram=2)
    assert results(found) == expected(rows, 6)
    assert results(passages.without_known_passages(table([]))) == []


def test_automaton_knows_the_least_holder_of_every_string():
    draw = random.Random(4)
    held = [([draw.choice([b"a", b"b", b"c"]) for _ in range(draw.randint(1, 25))], i) for i in range(40)]
    draw.shuffle(held)
    automaton = passages.Automaton(held)
    for n in (1, 3, 6):
        for _ in range(50):
            text = [draw.choice([b"a", b"b", b"c", b"d"]) for _ in range(20)]
            least = []
            for i in range(len(text) - n + 1):
                holders = [
                    id_ for words, id_ in held
                    if any(words[k : k + n] == text[i : i + n] for k in range(len(words) - n + 1))
                ]
                least.append(min(holders, default=passages.LAST))
            assert automaton.least_ids(text, n) == least


def test_words_that_cross_chunks_have_the_hash_of_the_word():
    hasher, long_ = WordHasher(b" \n"), b"ab" * CHUNK
    for data in (b"x " * CHUNK + b"yes", b"yes " + long_ + b" no " + long_, b"", b" ", b"q" * CHUNK):
        hashes, starts, ends = hasher(data)
        assert [data[a:b] for a, b in zip(starts, ends)] == data.split()
        assert [int(hasher(w)[0][0]) for w in data.split()[-3:]] == hashes[-3:].tolist()
    assert WordHasher(b" ", fold=True)(b"ABc")[0] == WordHasher(b" ", fold=True)(b"abC")[0]
