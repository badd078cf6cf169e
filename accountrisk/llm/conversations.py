"""Damage and least-cost repair of conversation structure.

A repaired conversation is empty or an optional system turn followed by pairs of a user and an assistant turn. Four
edits lead there: Keep, Rerole (to user or assistant), Delete and Insert (an empty turn). Of the cheapest sequences of
edits the one whose initials are least in ASCII order wins.

Method. A sequence of edits is one integer: the high digits are its cost, the low digits its initials from the left,
one octal digit each (D 1, I 2, K 3, R 4), padded at the end with zeros to a fixed width. Integers then order as costs
do, equal costs as their initials do, and a sequence comes before its extensions. The edits of a block of rows are a
directed acyclic graph whose nodes are (rows done, state), the states being: nothing yet, after system, after user,
after assistant. Each node holds the least integer of what may follow it, so one minimum per node decides cost and
initials together. Equal initials from one state always end in one state, so the integer tells the whole repair.

Spread. Rows are shuffled once by conversation, sorted there by Spark (which spills) and streamed; the digest of a
conversation's text is a sequential function of it, so one task reads each conversation, but never holds it: rows go in
blocks of bounded rows and bytes. A block maps each state before it to the best way to each state behind it; what came before
is kept as cost, rank and initials per state, and as running digests. Blocks end behind a row's own letter, where no
initials of one state can be a beginning of another's at the same cost, so ranks of earlier initials decide ties.

Defined cases. A null role or text counts as one space, in the key of the damage also a null id or turn. Null ids
form one conversation with a null id. Null turns come first; rows of equal turn go by role and text, repeated rows are
duplicates. A role without a first letter s, u or a cannot be kept where it stands, an empty role never. Turns beyond
the range of the difference of two longs raise. Empty table: no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

#: White space of the contract.
BLANKS = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
LETTERS = {"D": 1, "I": 2, "K": 3, "R": 4}
NAMES = {code: letter for letter, code in LETTERS.items()}
BITS = 3
START, SYSTEM, USER, ASSISTANT = range(4)
#: State after a turn of that first letter; roles not listed cannot follow.
AFTER = {
    START: {"s": SYSTEM, "u": USER},
    SYSTEM: {"u": USER},
    USER: {"a": ASSISTANT},
    ASSISTANT: {"u": USER},
}
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: State after an inserted or reroled turn: the one of those roles that may follow.
PLACED = {state: next(b for b in after.values() if b in ROLES) for state, after in AFTER.items()}
COMPLETE = (START, ASSISTANT)
#: A third insertion in a row leads back to the state after the first, at a higher cost.
MOST_INSERTS = 2
BLOCK_ROWS = 256
BLOCK_BYTES = 4_000_000


def damaged(turns: DataFrame) -> DataFrame:
    """The rows with ``kind`` (0 to 19) and what the damage left: ``role``, ``text`` and ``times`` (0 to 2)."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.pmod(F.crc32(key.cast("binary")), F.lit(20))
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    role = F.coalesce(F.col("role").cast("string"), F.lit(" "))
    return turns.select("conv_id", "turn", kind.alias("kind"), role.alias("role"), text.alias("text")).select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1).alias("times"),
    )


def with_faults(rows: DataFrame) -> DataFrame:
    """Rows in order within their conversation's partition, with ``fault``: blank, duplicate, truncated or null.

    Rows that the damage dropped stay with ``times`` 0, so that their conversation is not lost. The window of equal
    roles and texts lies within the conversation, so one shuffle serves it and the stream.
    """
    end = F.rtrim("text", F.lit(BLANKS))
    told = rows.withColumn("end", F.right(end, F.lit(1))).withColumn("digest", F.unhex(F.md5(F.col("text").cast("binary"))))
    order = [F.col("turn").asc_nulls_first()]
    same = Window.partitionBy("conv_id", "times_0", "role", "digest").orderBy(*order)
    nth = F.row_number().over(same)
    spread = told.withColumn("times_0", F.col("times") == 0).repartition("conv_id").withColumn("nth", nth)
    fault = (
        F.when(F.col("times") == 0, None)
        .when(F.col("end") == "", "blank")
        .when(F.col("nth") > 1, "duplicate")
        .when(~F.col("end").isin(".", "!", "?"), "truncated")
    )
    told = spread.withColumn("fault", fault).sortWithinPartitions("conv_id", *order, "role", "text", "nth")
    return told.select("conv_id", "turn", "role", "text", "times", "fault")


class Row:
    """What the repair needs of a row."""

    __slots__ = ("initial", "kept", "fixed", "extra", "role", "text")

    def __init__(self, role: str, text: str, fault: str | None):
        self.role, self.text, self.initial = role, text, role[:1]
        self.fixed = fault in ("blank", "duplicate")
        self.extra = TRUNCATED if fault == "truncated" else 0


def row_edges(row: Row, state: int) -> Iterator[tuple[str, int, int]]:
    """(letter, cost, state behind) of the edits of one row."""
    yield "D", DELETE, state
    if row.fixed:
        return
    if row.initial and row.initial in AFTER[state]:
        yield "K", KEEP + row.extra, AFTER[state][row.initial]
    yield "R", REROLE + row.extra, PLACED[state]


class Scalars:
    """Integers that order sequences of edits of at most ``places`` letters."""

    def __init__(self, places: int):
        self.low = BITS * places
        self.mask = (1 << self.low) - 1
        self.top = {letter: code << (self.low - BITS) for letter, code in LETTERS.items()} if places else {}

    def before(self, letter: str, cost: int, rest: int) -> int:
        """The letter put before the sequence ``rest``; its last place is free, the width being the longest path."""
        return ((rest >> self.low) + cost) << self.low | self.top[letter] | (rest & self.mask) >> BITS

    def read(self, value: int) -> tuple[int, str]:
        letters = []
        for shift in range(self.low - BITS, -1, -BITS):
            digit = (value >> shift) & ((1 << BITS) - 1)
            if not digit:
                break
            letters.append(NAMES[digit])
        return value >> self.low, "".join(letters)


def with_inserts(nodes: list[int | None], scalars: Scalars) -> list[int | None]:
    """The least integer per state when up to MOST_INSERTS insertions may come first."""
    best, layer = list(nodes), list(nodes)
    for _ in range(MOST_INSERTS):
        onward = [layer[PLACED[s]] for s in AFTER]
        layer = [None if v is None else scalars.before("I", INSERT, v) for v in onward]
        best = [b if a is None else a if b is None else min(a, b) for a, b in zip(layer, best, strict=True)]
    return best


def best_edits(rows: list[Row], behind: list[int | None], scalars: Scalars) -> list[int | None]:
    """Least integer per state before the rows, given those per state behind them."""
    nodes = behind
    for row in reversed(rows):
        reached = []
        for state in AFTER:
            found = [scalars.before(letter, cost, nodes[b]) for letter, cost, b in row_edges(row, state) if nodes[b] is not None]
            reached.append(min(found) if found else None)
        nodes = with_inserts(reached, scalars)
    return nodes


def apply_edits(rows: list[Row], audit: str, state: int, write) -> int:
    """Write the repaired turns of those edits; returns the state behind."""
    left = iter(rows)
    for letter in audit:
        if letter == "I":
            state = PLACED[state]
            write(ROLES[state] + ":")
            continue
        row = next(left)
        if letter == "K":
            state = AFTER[state][row.initial]
            write(f"{row.role}:{row.text}")
        elif letter == "R":
            state = PLACED[state]
            write(f"{ROLES[state]}:{row.text}")
    return state


class Digest:
    """SHA-256 of turns joined by line feeds."""

    def __init__(self, other: Digest | None = None):
        self.state, self.begun = (other.state.copy(), other.begun) if other else (hashlib.sha256(), False)

    def write(self, turn: str) -> None:
        if self.begun:
            self.state.update(b"\n")
        self.begun = True
        self.state.update(turn.encode("utf-8", "surrogatepass"))


class Conversation:
    """Counts and best repairs of the rows read so far."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal, self.turns, self.first, self.last, self.initial = 0, 0, None, None, None
        self.rows: list[Row] = []
        self.bytes = 0
        # per state: cost, rank of the initials, their pieces as (piece, earlier pieces), digest
        self.ways: dict[int, tuple[int, int, tuple, Digest]] = {START: (0, 0, (), Digest())}

    def add(self, turn, role: str, text: str, fault: str | None) -> None:
        if turn is not None:
            if self.first is None:
                self.first = turn
            if turn != self.last:
                self.turns, self.last = self.turns + 1, turn
        if fault:
            self.counts[fault] += 1
        if self.initial is not None and self.initial + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = role[:1]
        self.rows.append(Row(role, text, fault))
        self.bytes += len(text)
        if len(self.rows) >= BLOCK_ROWS or self.bytes >= BLOCK_BYTES:
            self.close_block()

    def close_block(self) -> None:
        """Carry the best way to each state over the rows held, and let go of them."""
        scalars = Scalars((1 + MOST_INSERTS) * len(self.rows))
        found = {}
        for target in AFTER:
            nodes = best_edits(self.rows, [0 if s == target else None for s in AFTER], scalars)
            if any(nodes[s] is not None for s in self.ways):
                found[target] = self.joined(nodes, scalars)
        # initials of equal earlier rank go on from one way, so the initials of these rows order them
        order = sorted(found, key=lambda s: found[s][1])
        self.ways = {s: (found[s][0], order.index(s), *found[s][2:]) for s in found}
        self.rows, self.bytes = [], 0

    def joined(self, nodes: list[int | None], scalars: Scalars) -> tuple[int, tuple[int, int], tuple, Digest]:
        """The least of (cost, rank of the initials before, initials of the rows) over the states before."""

        def weight(state: int) -> tuple[int, int, int]:
            cost, rank, *_ = self.ways[state]
            return cost + (nodes[state] >> scalars.low), rank, nodes[state] & scalars.mask

        start = min((s for s in self.ways if nodes[s] is not None), key=weight)
        total, *place = weight(start)
        _, audit = scalars.read(nodes[start])
        _, _, pieces, digest = self.ways[start]
        digest = Digest(digest)
        apply_edits(self.rows, audit, start, digest.write)
        return total, tuple(place), (audit, pieces) if audit else pieces, digest

    def result(self) -> tuple:
        if self.initial is None:
            return (self.conv_id, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
        scalars = Scalars((1 + MOST_INSERTS) * len(self.rows) + MOST_INSERTS)
        behind = with_inserts([0 if s in COMPLETE else None for s in AFTER], scalars)
        nodes = best_edits(self.rows, behind, scalars)
        cost, _, pieces, digest = self.joined(nodes, scalars)
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        counts = self.counts
        return (
            self.conv_id, gaps, counts["blank"], counts["duplicate"], counts["truncated"], self.illegal, cost,
            spelled(pieces), digest.state.hexdigest(),
        )


def spelled(pieces: tuple) -> str:
    found = []
    while pieces:
        piece, pieces = pieces
        found.append(piece)
    return "".join(reversed(found))


def repair_conversations(turns: DataFrame) -> DataFrame:
    """Faults, cost, edits (``audit``) and the digest of the repaired turns per conversation of
    ``turns`` (conv_id, turn, role, text; extra columns are ignored), after the damage of :func:`damaged`."""
    rows = with_faults(damaged(turns))
    long = [T.StructField(n, T.LongType()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    text = [T.StructField(n, T.StringType()) for n in ("audit", "repaired_sha256")]
    kind = turns.schema["conv_id"].dataType
    schema = T.StructType([T.StructField("conv_id", kind), *long, *text])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Conversation | None = None
        done: list[tuple] = []
        shape = None

        def batch_of(results: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*results, strict=True))
            arrays = [pa.array(columns[0], shape), *[pa.array(c, pa.int64()) for c in columns[1:7]], *[pa.array(c, pa.string()) for c in columns[7:]]]
            return pa.RecordBatch.from_arrays(arrays, schema.names)

        for batch in batches:
            shape = batch.schema.field(0).type
            columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            for conv_id, turn, role, text_, times, fault in zip(*columns, strict=True):
                if held is None or held.conv_id != conv_id:
                    if held:
                        done.append(held.result())
                    held = Conversation(conv_id)
                    if len(done) >= 1000:
                        yield batch_of(done)
                        done = []
                for repeat in range(times):
                    held.add(turn, role, text_, fault if repeat == 0 or fault == "blank" else "duplicate")
        if held:
            done.append(held.result())
        if done:
            yield batch_of(done)

    return rows.mapInArrow(run, schema)
