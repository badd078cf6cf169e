"""Benchmark decontamination with a generalised suffix automaton of the benchmark items.

The items' words become one automaton per block of at most ``block_words`` item words, or of one longer item. Tasks
build the automata; each block has a pass over the documents, in which it alone is broadcast, so what the driver and
a worker hold has a fixed bound however large the benchmark is. The hits of earlier passes are written by the digest
of the text and join the last pass; a benchmark of one block takes one pass and no shuffle. A task streams the words
of each document through the automaton and tracks the longest match that ends at each word.
A word is hit when it lies in an occurrence of a window: ``window`` consecutive words of an item, or the whole
item where it is shorter.

Cases: null or empty texts have no words, no hits and are clean. Items without words have no window. Items
with a null id hit but are not listed. Repeated documents or items, ties and extra columns are independent of
each other; an extra column with the name of a result column is replaced. With no items nothing is hit.
"""

from __future__ import annotations

import pickle
import re
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accountrisk.llm.bpe import kept
from accountrisk.llm.common import as_bytes, steps
from accountrisk.session import written

WINDOW = 13
#: A document is contaminated when its hits reach this share of its words (1 in COVERAGE).
COVERAGE = 20
BLOCK_WORDS = 250_000

_LETTERS = bytes(range(ord("a"), ord("z") + 1))
#: Lower-cases A-Z and blanks every other ASCII byte that is neither digit nor a-z.
FOLD = bytes(
    b if b >= 0x80 or chr(b).isdigit() or b in _LETTERS else b + 32 if chr(b).isupper() else 0x20 for b in range(256)
)
WORD = re.compile(rb"[^ ]+")
COUNTED = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
ITEMS = pa.list_(pa.string())
RESULT = "n_words long, n_hit long, spans array<struct<start:long,end:long>>, item_ids array<string>, contaminated boolean, clean_text string"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


class Automaton:
    """Generalised suffix automaton over word numbers, with the windows marked at their states."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        numbered = [(k, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in ws]) for k, ws in items if ws]
        self.size = max(1, len(self.vocabulary))
        self.next: dict[int, int] = {}
        self.link, self.length = [-1], [0]
        self.out: list[list[int]] = [[]]
        for _, numbers in numbered:
            last = 0
            for w in numbers:
                last = self.extend(last, w)
        del self.out
        self.shortest = min((min(window, len(ws)) for _, ws in numbered), default=window)
        self.mark(numbered)

    def state(self, length: int) -> int:
        self.length.append(length)
        self.link.append(0)
        self.out.append([])
        return len(self.length) - 1

    def put(self, state: int, word: int, to: int) -> None:
        key = state * self.size + word
        if key not in self.next:
            self.out[state].append(word)
        self.next[key] = to

    def split(self, p: int, word: int, q: int) -> int:
        """A state for the strings of ``q`` that are no longer than those of ``p`` and one word."""
        clone = self.state(self.length[p] + 1)
        for w in self.out[q]:
            self.put(clone, w, self.next[q * self.size + w])
        self.link[clone] = self.link[q]
        self.link[q] = clone
        while p >= 0 and self.next.get(p * self.size + word) == q:
            self.next[p * self.size + word] = clone
            p = self.link[p]
        return clone

    def extend(self, last: int, word: int) -> int:
        q = self.next.get(last * self.size + word)
        if q is not None:  # an earlier item already has this string
            return q if self.length[q] == self.length[last] + 1 else self.split(last, word, q)
        new = self.state(self.length[last] + 1)
        p = last
        while p >= 0 and p * self.size + word not in self.next:
            self.put(p, word, new)
            p = self.link[p]
        if p >= 0:
            q = self.next[p * self.size + word]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self.split(p, word, q)
        return new

    def holder(self, state: int, length: int) -> int:
        """The state that holds the suffix of that length of the state's strings."""
        while state and self.length[self.link[state]] >= length:
            state = self.link[state]
        return state

    def mark(self, numbered: list[tuple[str | None, list[int]]]) -> None:
        """Items by state that holds a window of theirs; ``short``: whole items below the window's length."""
        self.items: dict[int, set[str]] = {}
        short: dict[int, list[tuple[int, str | None]]] = {}
        for key, numbers in numbered:
            state = 0
            for j, w in enumerate(numbers):
                state = self.next[state * self.size + w]
                if j + 1 >= self.window:
                    self.items.setdefault(self.holder(state, self.window), set()).add(key)
            if len(numbers) < self.window:
                short.setdefault(self.holder(state, len(numbers)), []).append((len(numbers), key))
        order = sorted(range(len(self.length)), key=self.length.__getitem__)
        self.short: dict[int, list[tuple[int, str | None]]] = {}
        for s in order:
            own = short.get(s, []) + (self.short.get(self.link[s], []) if s else [])
            if own:
                self.short[s] = own
        # the state that holds the window at the end of a longer match
        self.window_state = [0] * len(self.length)
        for s in order:
            if self.length[s] >= self.window:
                up = self.link[s]
                self.window_state[s] = self.window_state[up] if self.length[up] >= self.window else s

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """(start, end) of window occurrences or of longer matches made of them, and the items that occur."""
        known = np.fromiter((self.vocabulary.get(w, -1) for w in words), np.int64, len(words))
        edge = np.flatnonzero(np.diff(np.concatenate([[0], (known >= 0).astype(np.int8), [0]])))
        spans, found = [], set()
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            if b - a >= self.shortest:
                self.scan(known[a:b].tolist(), a, spans, found)
        return spans, found

    def scan(self, numbers: list[int], base: int, spans: list, found: set) -> None:
        state = length = 0
        size, follow, window, short = self.size, self.next, self.window, self.short
        for j, w in enumerate(numbers, base + 1):
            to = follow.get(state * size + w)
            while to is None:  # every number is in some item, so the root has it
                state = self.link[state]
                length = self.length[state]
                to = follow.get(state * size + w)
            state, length = to, length + 1
            if length >= window:
                spans.append((j - length, j))
                found |= self.items[self.window_state[state]]
            if state in short:
                for n, key in short[state]:
                    if n <= length:
                        spans.append((j - n, j))
                        found.add(key)


def union_of(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def without(text: bytes, spans: list[tuple[int, int]]) -> str:
    """The text without the hit words and what stands between them."""
    at = [m.span() for m in WORD.finditer(text.translate(FOLD))]
    kept, done = [], 0
    for a, b in spans:
        kept.append(text[done : at[a][0]])
        done = at[b - 1][1]
    return b"".join([*kept, text[done:]]).decode("utf-8", "replace")


def item_blocks(items: DataFrame, id_col: str, text_col: str, block_words: int, window: int) -> DataFrame:
    """(block, automaton): the items in blocks of at most ``block_words`` words, or of one longer item, each built and
    pickled in a task."""
    rows = written(items.select(F.col(id_col).cast("string").alias("id"), as_bytes(text_col).alias("text")), "benchmark-items")
    total = rows.agg(F.sum(F.regexp_count(F.col("text").cast("string"), F.lit(COUNTED)))).first()[0] or 0
    parts = int(1.1 * total // block_words) + 1  # a tenth of room, since the parts differ a little in size

    def run(batches):
        part, number, block, held = TaskContext.get().partitionId(), 0, [], 0

        def packed():
            data = pickle.dumps(Automaton(block, window), pickle.HIGHEST_PROTOCOL)
            return pa.RecordBatch.from_arrays([pa.array([f"{part}-{number}"]), pa.array([data], pa.large_binary())], ["block", "automaton"])

        for batch in batches:
            for key, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                words = words_of(text)
                if block and held + len(words) > block_words:
                    yield packed()
                    number, block, held = number + 1, [], 0
                if words:
                    block.append((key, words))
                    held += len(words)
        if block:
            yield packed()

    numbered = rows.withColumn("nth", F.monotonically_increasing_id())
    dealt = rows.coalesce(1) if parts == 1 else numbered.repartition(parts, "nth")
    return written(dealt.mapInArrow(run, "block string, automaton binary"), "benchmark-blocks")


def block_hits(texts: DataFrame, block: Broadcast, token: str) -> DataFrame:
    """(text_key, spans, item_ids) of the texts that one block's windows hit; rows of equal texts give one row."""
    names = ["text_key", "block_spans", "block_items"]

    def run(batches):
        automaton = kept(token, lambda: pickle.loads(block.value))
        for batch in batches:
            for part in steps(batch, "text"):
                hit = []
                for key, text in zip(part.column("text_key").to_pylist(), part.column("text").to_pylist(), strict=True):
                    spans, found = automaton.hits(words_of(text))
                    if spans:
                        spans = [{"start": a, "end": b} for a, b in union_of(spans)]
                        hit.append((key, spans, sorted(k for k in found if k is not None)))
                if hit:
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*hit, strict=True), (pa.binary(), SPANS, ITEMS), strict=True)], names)

    found = texts.mapInArrow(run, "text_key binary, block_spans array<struct<start:long,end:long>>, block_items array<string>")
    return written(found.dropDuplicates(["text_key"]), "benchmark-hits")


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    coverage: int = COVERAGE,
    max_span: int | None = None,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``spans`` (word positions, end exclusive, merged), ``item_ids``
    (sorted), ``contaminated`` and ``clean_text`` (the text without the hit spans; the text itself where
    nothing is hit).

    ``contaminated``: hits make up at least 1 in ``coverage`` words, or one merged span has more than
    ``max_span`` words where that is given.
    """
    spark = docs.sparkSession
    base = docs.drop(*(c.split()[0] for c in RESULT.split(", ")))
    out = base.withColumn(text_col, F.col(text_col).cast("string"))
    result = out.select("*", *(F.lit(None).cast(kind).alias(name) for name, kind in (c.split(" ", 1) for c in RESULT.split(", ")))).schema
    kinds = [pa.int64(), pa.int64(), SPANS, ITEMS, pa.bool_(), pa.string()]
    names = result.names
    width, at = len(out.columns), out.columns.index(text_col)

    blocks = item_blocks(items, item_id_col, item_text_col, block_words, window)
    numbers = sorted(r.block for r in blocks.select("block").collect())

    def sent(number: str) -> Broadcast:
        return spark.sparkContext.broadcast(bytes(blocks.where(F.col("block") == number).first().automaton))

    token = uuid.uuid4().hex
    # all blocks but the last have a pass of their own, so that one block at a time is held
    key = F.unhex(F.md5(as_bytes(text_col)))
    earlier = None
    for number in numbers[:-1]:
        block = sent(number)
        hits = block_hits(out.select(key.alias("text_key"), as_bytes(text_col).alias("text")), block, f"{token}-{number}")
        block.destroy()
        earlier = hits if earlier is None else earlier.union(hits)
    last = sent(numbers[-1]) if numbers else None
    given = [f"spans_{token}", f"items_{token}"]
    if earlier is None:
        rows = out.select("*", F.lit(None).cast("array<struct<start:long,end:long>>").alias(given[0]), F.lit(None).cast("array<string>").alias(given[1]))
    else:
        found = earlier.groupBy(F.col("text_key").alias(f"hit_{token}"))
        found = found.agg(*(F.flatten(F.collect_list(c)).alias(n) for c, n in zip(("block_spans", "block_items"), given, strict=True)))
        rows = out.withColumn(f"key_{token}", key).join(found, F.col(f"key_{token}") == F.col(f"hit_{token}"), "left").drop(f"key_{token}", f"hit_{token}")

    def judged(automaton: Automaton | None, text: bytes, spans: list | None, found: list | None):
        words = words_of(text)
        own, items = automaton.hits(words) if automaton else ([], set())
        spans = union_of(own + [(s["start"], s["end"]) for s in spans or []])
        n_hit = sum(b - a for a, b in spans)
        bad = n_hit > 0 and (coverage * n_hit >= len(words) or any(max_span is not None and b - a > max_span for a, b in spans))
        keys = sorted({k for k in items if k is not None}.union(found or []))
        return len(words), n_hit, [{"start": a, "end": b} for a, b in spans], keys, bad, without(text, spans) if spans else None

    def run(batches):
        automaton = last and kept(token, lambda: pickle.loads(last.value))
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                texts = part.column(at)
                known = zip(texts.cast(pa.binary()).to_pylist(), part.column(width).to_pylist(), part.column(width + 1).to_pylist(), strict=True)
                rows = [judged(automaton, t or b"", spans, found) for t, spans, found in known]
                made = [pa.array(list(v), k) for v, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                made[-1] = pc.if_else(made[-1].is_null(), texts, made[-1])
                yield pa.RecordBatch.from_arrays([*part.columns[:width], *made], names)

    return rows.mapInArrow(run, result)
