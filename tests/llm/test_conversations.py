"""Conversation repair against a search over whole audits."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from meterlens.llm import conversations as conv

COLUMNS = "conv_id bigint, turn bigint, role string, text string, id int, copies int, first string"
BLANKS = " \t\n\x0b\x0c\r"


def legal(initials):
    return re.fullmatch(r"(s?(ua)+)?", initials) is not None


def cheapest(rows):
    """Dijkstra over (rows done, roles put out so far), whole audits as tie-breakers."""
    faults, seen = [], set()
    for role, text in rows:
        body = text.strip(BLANKS)
        fault = "blank" if not body else "duplicate" if (role, text) in seen else None
        faults.append(fault or (None if body[-1] in ".!?" else "truncated"))
        seen.add((role, text))
    heap, done = [(0, "", 0, ())], set()
    while heap:
        cost, audit, at, out = heapq.heappop(heap)
        initials = "".join(o[0][:1] for o in out)
        if at == len(rows) and legal(initials):
            body = "\n".join(f"{r}:{t}" for r, t in out)
            return faults, cost, audit, hashlib.sha256(body.encode()).hexdigest()
        state = at, initials[-1:], bool(initials)
        if state in done:
            continue
        done.add(state)
        moves = [("I", 2, at, (role, "")) for role in ("user", "assistant")]
        if at < len(rows):
            role, text = rows[at]
            moves.append(("D", 3, at + 1, None))
            if faults[at] not in ("blank", "duplicate"):
                more = int(faults[at] == "truncated")
                moves.append(("K", more, at + 1, (role, text)))
                moves += [("R", 2 + more, at + 1, (r, text)) for r in ("user", "assistant")]
        for letter, price, to, put in moves:
            grown = out if put is None else (*out, put)
            roles = "".join(o[0][:1] or "-" for o in grown)
            if re.fullmatch(r"(s|s?(ua)*u?)", roles):
                heapq.heappush(heap, (cost + price, audit + letter, to, grown))
    raise AssertionError


def hurt(rows):
    """The rows of one conversation after damage, in order."""
    out = []
    spaced = [(t, " " if r is None else r, " " if x is None else x, c) for c, t, r, x in rows]
    for turn, role, text, conv_id in spaced:
        key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        role = "user" if fault == 4 else role
        out += [(turn, role, text)] * {0: 0, 3: 2}.get(fault, 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def expected(rows):
    rows = hurt(rows)
    faults, cost, audit, digest = cheapest([r[1:] for r in rows])
    turns = sorted({r[0] for r in rows} - {None})
    initials = [r[1][:1] for r in rows]
    return (
        turns[-1] - turns[0] + 1 - len(turns) if turns else 0,
        *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        cost, audit, digest,
    )


def made(seed):
    draw = random.Random(seed)
    rows = []
    for conv_id in [*range(120), None]:
        size = draw.choice([1, 2, 4, 6, 9, 14])
        for turn in sorted(draw.sample(range(20), size)):
            role = draw.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "sys"])
            text = draw.choice(["Yes.", "No", "Why?", " \n", "", None, "a b c!", "x\n", "é…", "Yes."])
            rows.append((conv_id, draw.choice([turn, turn, turn, None]), role, text))
            if draw.random() < 0.1:
                rows.append(rows[-1])
    return rows


@pytest.fixture(scope="module")
def tables(spark):
    def build(rows):
        return spark.createDataFrame([(*r, 7, 7, "x") for r in rows], COLUMNS)

    return build


def repaired(df):
    rows, copies = conv.damaged(df)
    return {r[0]: tuple(r)[1:] for r in conv.repaired_conversations(rows, copies=copies).collect()}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_every_conversation_against_a_search_over_whole_audits(tables, seed):
    rows = made(seed)
    by_id = {}
    for row in rows:
        by_id.setdefault(row[0], []).append(row)
    assert repaired(tables(rows)) == {i: expected(r) for i, r in by_id.items()}


def test_a_conversation_without_rows_left_has_zeros(tables):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    empty = hashlib.sha256(b"").hexdigest()
    assert repaired(tables([(gone, 0, "user", "Hi.")])) == {gone: (0, 0, 0, 0, 0, 0, "", empty)}
    assert repaired(tables([])) == {}


def audit_of(rows):
    repair = conv.Repair()
    for role, text, truncated, must_go in rows:
        repair.add(role, text, truncated, must_go)
    return repair.end()


def many(seed, size):
    draw = random.Random(seed)
    roles = ["user", "assistant", "system", "tool"]
    return [
        (draw.choice(roles), str(i), draw.random() < 0.2, draw.random() < 0.1) for i in range(size)
    ]


def test_settled_edits_and_colliding_hashes_change_nothing(monkeypatch):
    rows = many(5, 3000)
    plain = audit_of(rows)
    monkeypatch.setattr(conv, "SETTLE", 10**9)
    assert audit_of(rows) == plain
    monkeypatch.setattr(conv, "MODULUS", 7)
    assert audit_of(rows) == plain
    monkeypatch.setattr(conv, "SETTLE", 3)
    assert audit_of(rows) == plain


def test_a_long_conversation_holds_undecided_rows_only():
    repair = conv.Repair()
    for row in many(6, 20_000):
        repair.add(*row)
    assert max(f[1].depth for f in repair.best if f) < 2000


def test_audits_compare_as_strings():
    draw = random.Random(1)
    for _ in range(300):
        words = ["".join(draw.choices("DIKR", k=draw.randint(1, 9))) for _ in range(2)]
        root = conv.Edit(None, "", None, 0)
        ends = []
        for word in words:
            node = root
            for letter in word:
                node = conv.Edit(node, letter, None, 0)
            ends.append(node)
        if not (words[0].startswith(words[1]) or words[1].startswith(words[0])):
            assert conv.before(*ends) == (words[0] < words[1])
