"""Repair of damaged conversations by the cheapest edits, kept as a persistent audit."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlens.llm.common import map_batches

# Costs of the edits and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
# Neighbours that a conversation may have, by the initials of their roles.
LEGAL = {"su", "ua", "au"}
# What a row suffers, by the remainder of its checksum.
FAULTS = 20
DROPPED, EMPTIED, UNSTOPPED, REPEATED, USURPED = range(5)

# States by what was put out last: nothing, system, user, assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
FOLLOWS = (USER, USER, ASSISTANT, USER)
NAMES = ("", "system", "user", "assistant")
AFTER_INITIAL = {("s", START): SYSTEM} | {(NAMES[q][0], s): q for s, q in enumerate(FOLLOWS)}

# What a state costs at most to do as another would from here on: a system row that may no
# longer open the conversation is deleted, an open user turn gets its answer inserted.
INSTEAD = {
    (START, ASSISTANT): DELETE, (START, USER): DELETE + INSERT,
    (SYSTEM, START): 0, (SYSTEM, ASSISTANT): 0, (SYSTEM, USER): INSERT,
}

MODULUS, BASE = (1 << 61) - 1, 1_000_003
SETTLE = 256  # rows between two looks at which edits are settled


class Edit:
    """The last edit of an audit prefix. Prefixes that begin alike share their nodes.

    ``ups[k]`` is the ancestor 2**k edits back, ``hash`` the rolling hash of the whole
    prefix, ``row`` the row edited (None: inserted) and ``state`` what follows it.
    """

    __slots__ = ("letter", "depth", "hash", "ups", "row", "state")

    def __init__(self, parent: Edit | None, letter: str, row, state: int):
        self.letter, self.row, self.state = letter, row, state
        if parent is None:
            self.depth, self.hash, self.ups = 0, 0, ()
            return
        self.depth = parent.depth + 1
        self.hash = (parent.hash * BASE + ord(letter)) % MODULUS
        ups, k = [parent], 0
        while k < len(ups[k].ups):
            ups.append(ups[k].ups[k])
            k += 1
        self.ups = tuple(ups)


def _lifted(node: Edit, depth: int) -> Edit:
    while node.depth > depth:
        for up in reversed(node.ups):
            if up.depth >= depth:
                node = up
                break
    return node


def _first_difference(a: Edit, b: Edit, same=lambda x, y: x.hash == y.hash) -> tuple[Edit, Edit]:
    """The nodes behind the longest common prefix of two prefixes of equal depth."""
    while a.ups and a.ups[0] is not b.ups[0]:
        for up, other in zip(reversed(a.ups), reversed(b.ups)):
            if not same(up, other):
                a, b = up, other
                break
        else:
            break
    return a, b


def _differ(a: Edit, b: Edit) -> tuple[Edit, Edit] | None:
    """Where two prefixes of equal depth differ first, None if nowhere. What the hashes call
    common is verified letter by letter, back to the node that both share."""
    if a.hash != b.hash:
        a, b = _first_difference(a, b)
    found = None
    while a is not b:
        if a.letter != b.letter:
            found = a, b
        a, b = a.ups[0], b.ups[0]
    return found


def before(a: Edit, b: Edit) -> bool:
    """Whether prefix a is smaller in ASCII order. Prefixes compared have edited the same
    rows at the same cost, so none is the beginning of another."""
    depth = min(a.depth, b.depth)
    found = _differ(_lifted(a, depth), _lifted(b, depth))
    return a.depth < b.depth if found is None else found[0].letter < found[1].letter


def _better(old: tuple[int, Edit] | None, cost: int, node_of) -> tuple[int, Edit]:
    if old is None or cost < old[0]:
        return cost, node_of()
    if cost == old[0] and before(node := node_of(), old[1]):
        return cost, node
    return old


class Repair:
    """The cheapest audit of one conversation, row by row.

    For each state the best prefix is kept. Edits that all of them share are settled: they
    leave the tree, and their rows are put out, so only undecided rows are held.
    """

    def __init__(self):
        self.best: list[tuple[int, Edit] | None] = [(0, Edit(None, "", None, START)), None, None, None]
        self._insert()
        self.audit: list[str] = []
        self.text, self.parts, self.rows = hashlib.sha256(), 0, 0

    def _insert(self) -> None:
        """Add the insertions: each leads to the next state, two in a row to the one behind."""
        for _ in range(2):
            grown = list(self.best)
            for state, found in enumerate(self.best):
                if found is not None:
                    cost, node = found
                    to = FOLLOWS[state]
                    grown[to] = _better(
                        grown[to], cost + INSERT, lambda n=node, t=to: Edit(n, "I", None, t)
                    )
            self.best = grown

    def add(self, role: str, text: str, truncated: bool, must_go: bool) -> None:
        row, after = (role, text), [None] * 4
        extra = TRUNCATED if truncated else 0
        for state, found in enumerate(self.best):
            if found is None:
                continue
            cost, node = found
            after[state] = _better(
                after[state], cost + DELETE, lambda n=node, s=state: Edit(n, "D", row, s)
            )
            if must_go:
                continue
            to = AFTER_INITIAL.get((role[:1], state))
            if to is not None:
                after[to] = _better(after[to], cost + extra, lambda n=node, t=to: Edit(n, "K", row, t))
            to = FOLLOWS[state]
            after[to] = _better(
                after[to], cost + REROLE + extra, lambda n=node, t=to: Edit(n, "R", row, t)
            )
        self.best = after
        self._insert()
        for (state, other), most in INSTEAD.items():  # prefixes that can neither win nor tie
            worse, found = self.best[state], self.best[other]
            if worse is not None and found is not None and worse[0] > found[0] + most:
                self.best[state] = None
        self.rows += 1
        if self.rows % SETTLE == 0:
            self._settle()

    def _put_out(self, edits: list[Edit]) -> None:
        for edit in edits:
            self.audit.append(edit.letter)
            if edit.letter == "D":
                continue
            role, text = edit.row or ("", "")
            role = role if edit.letter == "K" else NAMES[edit.state]
            line = f"{role}:{text}" if not self.parts else f"\n{role}:{text}"
            self.text.update(line.encode())
            self.parts += 1

    def _chain(self, node: Edit, depth: int) -> list[Edit]:
        chain = []
        while node.depth > depth:
            chain.append(node)
            node = node.ups[0]
        return chain[::-1]

    def _settle(self) -> None:
        ends = [found[1] for found in self.best if found is not None]
        depth = min(node.depth for node in ends)
        shared = ends[0]
        for node in ends[1:]:
            depth = min(shared.depth, node.depth)
            a, b = _lifted(shared, depth), _lifted(node, depth)
            if a is not b:
                a = _first_difference(a, b, lambda x, y: x is y)[0].ups[0]
            shared = a
        if not shared.depth:
            return
        self._put_out(self._chain(shared, 0))
        # The rest grows anew from a root that stands for what was settled.
        moved = {id(shared): Edit(None, "", None, shared.state)}

        def copied(node: Edit) -> Edit:
            for edit in self._chain(node, shared.depth):
                if id(edit) not in moved:
                    moved[id(edit)] = Edit(moved[id(edit.ups[0])], edit.letter, edit.row, edit.state)
            return moved[id(node)]

        self.best = [f if f is None else (f[0], copied(f[1])) for f in self.best]

    def end(self) -> tuple[int, str, str]:
        """Cost, audit and hash of the repaired conversation."""
        best = None
        for found in (self.best[START], self.best[ASSISTANT]):
            if found is not None:
                best = _better(best, found[0], lambda n=found[1]: n)
        self._put_out(self._chain(best[1], 0))
        return best[0], "".join(self.audit), self.text.hexdigest()


class Conversation:
    """Counts and repair of one conversation, its rows in order."""

    def __init__(self):
        self.repair = Repair()
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.turn = self.last = self.initial = None

    def add(self, turn: int | None, role: str, text: str, seen: bool) -> None:
        here = turn, role, text
        if turn is not None and turn != self.turn:
            self.first = turn if self.first is None else self.first
            self.turn, self.turns = turn, self.turns + 1
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in LEGAL:
            self.illegal += 1
        self.initial = initial
        body = text.encode().rstrip()  # of bytes: the blanks of the ASCII table only
        blank, seen = not body, seen or here == self.last
        self.last = here
        truncated = not blank and not seen and body[-1:] not in (b".", b"!", b"?")
        self.blank += blank
        self.duplicate += seen and not blank
        self.truncated += truncated
        self.repair.add(role, text, truncated, blank or seen)

    def end(self) -> tuple:
        gaps = 0 if self.first is None else self.turn - self.first + 1 - self.turns
        cost, audit, digest = self.repair.end()
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit, digest


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def repaired_conversations(
    rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
    text_col: str = "text", copies: Column | None = None,
) -> DataFrame:
    """One row per conversation id: the counts of its faults, ``cost``, ``audit`` and
    ``repaired_sha256`` (the repaired ``role:text`` lines).

    A row's first fault counts: blank, duplicate (its role and text stand earlier),
    truncated (it does not end with a full stop, exclamation or question mark). The audit
    has the cheapest edits that lead to roles ``(s?(ua)+)?``, of equal costs the one least
    in ASCII: Keep, Rerole, Delete, Insert.

    Rows are taken by turn, null turns first, of one turn by role and text. Null roles and
    texts count as one space; a null id is a conversation like others. ``copies`` repeats a
    row next to itself; 0 leaves it out but names its conversation, which then has zeros, an
    empty audit and the hash of nothing. Repeated rows are duplicates of their first. An
    empty table gives no rows, other columns are not read.

    Whether a text was seen earlier comes from an aggregate per role and text, so copies
    combine before the shuffle. A conversation's rows then stream through one task in order
    (its hash cannot be computed otherwise); the task holds undecided rows only.
    """
    kind = rows.schema[id_col].dataType.simpleString()
    lines = rows.select(
        F.col(id_col).alias("id"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text_col), F.lit(" ")).alias("text"),
        (F.lit(1) if copies is None else copies).cast("int").alias("copies"),
    ).withColumn("digest", F.unhex(F.sha2("text", 256)))
    # Null turns come first: the least turn of a text counts only if none of them has it.
    firsts = (
        lines.filter("copies > 0")
        .groupBy("id", "role", "digest")
        .agg(F.min("turn").alias("first"), F.count_if(F.isnull("turn")).alias("untimed"))
        .select(*[F.col(c).alias(f"f_{c}") for c in ("id", "role", "digest", "first", "untimed")])
    )
    same = [lines[c].eqNullSafe(firsts[f"f_{c}"]) for c in ("id", "role", "digest")]
    seen = F.col("turn").isNotNull() & ((F.col("f_untimed") > 0) | (F.col("f_first") < F.col("turn")))
    marked = lines.join(firsts, same, "left").select(
        "id", "turn", "role", "text", "copies", F.coalesce(seen, F.lit(False)).alias("seen"), "digest"
    )
    ordered = marked.repartition("id").sortWithinPartitions(
        F.asc_nulls_first("id"), F.asc_nulls_first("turn"), "role", "text"
    )

    def run(batches):
        last, open_, out, ids = None, None, [], None

        def packed():
            kinds = [ids, *[pa.int64()] * 6, pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                names=["id", *COUNTS, "audit", "repaired_sha256"],
            )

        for batch in batches:
            ids = batch.schema.field(0).type
            for id_, turn, role, text, copies, seen in zip(*(c.to_pylist() for c in batch.columns)):
                if open_ is None or id_ != last:
                    if open_ is not None:
                        out.append((last, *open_.end()))
                    last, open_ = id_, Conversation()
                for _ in range(copies):
                    open_.add(turn, role, text, seen)
            if len(out) >= 1000:
                yield packed()
                out = []
        if open_ is not None:
            out.append((last, *open_.end()))
        if out:
            yield packed()

    schema = f"id {kind}, {', '.join(f'{c} long' for c in COUNTS)}, audit string, repaired_sha256 string"
    result = map_batches(ordered.drop("digest"), run, schema)
    return result.select(F.col("id").alias(id_col), *COUNTS, "audit", "repaired_sha256")


def damaged(rows: DataFrame) -> tuple[DataFrame, Column]:
    """Conversation rows with the faults their checksums give them, and the number of times
    each stands. A null counts as one space."""

    def known(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn"))) % FAULTS
    text = (
        F.when(fault == EMPTIED, "")
        .when(fault == UNSTOPPED, F.regexp_replace(known("text"), "[.!?]", ""))
        .otherwise(known("text"))
    )
    role = F.when(fault == USURPED, "user").otherwise(known("role"))
    copies = F.when(fault == DROPPED, 0).when(fault == REPEATED, 2).otherwise(1)
    hurt = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copies"))
    return hurt, F.col("copies")


def conversations_query(spark, folder: str) -> DataFrame:
    """Damage and repair of every conversation of ``conversations``."""
    rows, copies = damaged(spark.read.parquet(f"{folder}/conversations.parquet"))
    return repaired_conversations(rows, copies=copies)
