"""Spelling variants: words that differ by one inserted, deleted or replaced code point, joined by variable-length grams.

Method. A dictionary of grams of 2 to ``QMAX`` code points is grown level by level: a gram is lengthened only while it is
frequent, so all its beginnings are in the dictionary, and rare grams stay short. A word, with a mark at both ends,
is decomposed into the longest dictionary gram from each place, but for grams that lie inside an earlier one. An edit at
a place can only touch grams whose look-up read that place, and hide grams behind it that a new gram ending there
could cover; the largest number of them is the word's bound of affected grams. Near words share all others, so among
the (bound + 1) rarest grams of either word the rarest unaffected one stands in both: these lists are merged.

Lists are split by what an unaffected gram leaves equal: everything up to its end if the edit comes later (L), else everything
from its start (R). Of a word's grams only those go in that no rarer one precedes (L) or follows (R), since the rarer
one's list holds the same pairs; the place of the next one limits where the edit of a pair may lie, so that a pair is
found about once a side. A list is sorted by length and compared at rising distance; letter masks leave few pairs, which
are verified exactly. Words whose bound covers all their grams are joined among themselves by the same index over plain 2-grams,
where one edit affects few grams of seven letters or more.

Spread. Counts are summed in tasks before they are shuffled; lists are shuffled by hash and context, only verified pairs
go on. A word has at most (2 * length + 1) * 92 near words. The dictionary is collected and broadcast: at most
``EXPANDED`` grams a level are lengthened, whatever the number of words, by at most 94 code points.

Defined cases. Null and empty texts have no words; a null id is the empty text in the hash that deletes a code point. Repeated rows count
each time. Ties of a form go by code points. Empty table: no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accountrisk.llm.common import as_bytes, mix, steps
from accountrisk.session import written

QMIN, QMAX = 2, 6
#: A gram as frequent as that is lengthened, but of all places no more than one in EXPANDED begins it.
EXPAND_AT, EXPANDED = 2_000, 5_000
FIRST, LAST = "\x02", "\x03"
DAMAGE = 31
RATIO = 10
#: Words counted in a task before they are handed on.
HELD_WORDS = 400_000
NO_LIMIT = np.int32(2**31 - 1)
#: Longer words are verified one by one.
WIDE = 48


# ---- words ----------------------------------------------------------------------------------------------
def damaged_runs(doc_id: str, text: str, runs: re.Pattern, min_chars: int) -> Iterator[tuple[str, int]]:
    """(word, occurrences): runs of letters, of every 31st hash one code point is missing."""
    start = zlib.crc32(f"{doc_id}:".encode())
    for run, n in Counter(runs.findall(text)).items():
        h = zlib.crc32(run.encode(), start)
        if h % DAMAGE == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        if len(run) >= min_chars:
            yield run, n


def word_counts(docs: DataFrame, min_chars: int = 7, min_count: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): the words of at least ``min_chars`` code points that occur ``min_count`` times."""
    name = F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = re.compile("[a-zÀ-ÿ]{%d,}" % max(min_chars, 1))
        held: Counter = Counter()

        def handed_on() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for part in steps(batch, "text"):
                for doc_id, text in zip(part.column("id").to_pylist(), part.column("text").to_pylist(), strict=True):
                    # lower() of bytes changes A-Z alone
                    for word, n in damaged_runs(doc_id, text.lower().decode("utf-8", "replace"), runs, min_chars):
                        held[word] += n
                if len(held) >= HELD_WORDS:
                    yield handed_on()
                    held.clear()
        if held:
            yield handed_on()

    counts = docs.select(name, as_bytes(text_col).alias("text")).mapInArrow(run, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# ---- grams ----------------------------------------------------------------------------------------------
def grow_dictionary(words: DataFrame, qmax: int = QMAX, expand_at: int = EXPAND_AT, expanded: int = EXPANDED) -> dict[str, int]:
    """Occurrences of the dictionary's grams. The counts of a level come from all words; see the module for the bound."""
    found: dict[str, int] = {}
    parents: set[str] | None = None
    for q in range(QMIN, qmax + 1):
        level = {r["gram"]: r["n"] for r in gram_counts(words, q, parents).collect()}
        found |= level
        if q == QMIN:
            expand_at = max(expand_at, sum(level.values()) // expanded)
        parents = {g for g, n in level.items() if n >= expand_at}
        if not parents:
            break
    return found


def gram_counts(words: DataFrame, q: int, parents: set[str] | None) -> DataFrame:
    """Occurrences of the grams of ``q`` code points whose beginning is one of ``parents`` (None: any)."""
    allowed = words.sparkSession.sparkContext.broadcast(parents)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held = allowed.value, Counter()
        for batch in batches:
            for word in batch.column(0).to_pylist():
                s = FIRST + word + LAST
                grams = [s[p : p + q] for p in range(len(s) - q + 1)]
                held.update(grams if known is None else [g for g in grams if g[:-1] in known])
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["gram", "n"])

    return words.select("word").mapInArrow(run, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))


class GramIndex:
    """Decomposes words and tells the lists they go into."""

    def __init__(self, counts: dict[str, int]):
        self.counts = counts
        self.qmax = max(map(len, counts), default=QMIN)
        self.tails = {g[k:] for g in counts for k in range(1, len(g))}

    def decompose(self, s: str) -> list[tuple[int, int]]:
        """(place, length) of the grams of a marked word; starts and ends both rise."""
        grams, end, size = [], -1, len(s)
        for p in range(size - QMIN + 1):
            n = QMIN
            while n < self.qmax and p + n < size and s[p : p + n + 1] in self.counts:
                n += 1
            if p + n - 1 > end:
                grams.append((p, n))
                end = p + n - 1
        return grams

    def affected(self, s: str, grams: list[tuple[int, int]]) -> int:
        """The most grams that one edit of a marked word can touch or hide."""
        most, size, low = 0, len(s), 0
        for i in range(size - 1):
            hidden = i + 1
            while hidden + 1 < size and s[i + 1 : hidden + 2] in self.tails:
                hidden += 1
            while low < len(grams) and sum(grams[low]) < i:
                low += 1
            count = 0
            for p, n in grams[low:]:
                if p > i and p + n - 1 > hidden:
                    break
                count += 1
            most = max(most, count)
        return most

    def lists(self, word: str) -> tuple[list[tuple[bytes, int]], bool]:
        """((context, limit) of the lists of a word, whether its bound is below the number of its grams).

        L contexts: pairs whose first difference lies beyond the limit are found by a rarer gram further on. R
        contexts: the same for a first difference before the limit.
        """
        s = FIRST + word + LAST
        grams = self.decompose(s)
        bound = self.affected(s, grams)
        ranked = sorted((self.counts.get(s[p : p + n], 0), s[p : p + n], p, n) for p, n in grams)[: bound + 1]
        by_place = sorted((p, n, rank) for rank, (_, _, p, n) in enumerate(ranked))
        found = []
        left = minima(by_place)
        for (p, n, _), after in zip(left, [*left[1:], None], strict=True):
            found.append((f"L{p} {s[: p + n]}".encode(), int(NO_LIMIT) if after is None else after[0] + after[1]))
        right = minima(by_place[::-1])
        for (p, n, _), after in zip(right, [*right[1:], None], strict=True):
            limit = -1 if after is None else min(after[0] - 1, after[0] + after[1] - 2 - self.qmax)
            found.append((f"R{n} {s[p:]}".encode(), limit))
        return found, bound < len(grams)


def minima(by_place: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The entries rarer than all before them."""
    found: list[tuple[int, int, int]] = []
    for entry in by_place:
        if not found or entry[2] < found[-1][2]:
            found.append(entry)
    return found


def letter_masks(words: list[str]) -> np.ndarray:
    """One bit per letter of a word; an edit changes at most two."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    bits = np.uint64(1) << (mix(codes) & np.uint64(63))
    return np.bitwise_or.reduceat(bits, np.append(0, np.cumsum(lengths)[:-1]))


def list_entries(words: DataFrame, counts: dict[str, int], qmax: int) -> DataFrame:
    """(list, size, limit, left, mask, word, n): the lists of all words. Words without a useful bound are told by
    ``loose`` and are in all lists of their grams."""
    shared = words.sparkSession.sparkContext.broadcast({g: n for g, n in counts.items() if len(g) <= qmax})
    schema = "list long, size int, limit int, left boolean, mask long, loose boolean, word string, n long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = GramIndex(shared.value)
        for batch in batches:
            for start in range(0, batch.num_rows, 5_000):
                part = batch.slice(start, 5_000)
                texts = part.column(0).to_pylist()
                keys, limits, owners, left, loose = [], [], [], [], []
                for row, word in enumerate(texts):
                    found, tight = index.lists(word)
                    for context, limit in found:
                        keys.append(hashlib.blake2b(context, digest_size=8).digest())
                        limits.append(limit)
                        left.append(context[:1] == b"L")
                        owners.append(row)
                        loose.append(not tight)
                owner = np.array(owners, np.int64)
                sizes = np.fromiter(map(len, texts), np.int32, len(texts))
                columns = [
                    pa.array(np.frombuffer(b"".join(keys), np.int64)),
                    pa.array(sizes[owner]),
                    pa.array(limits, pa.int32()),
                    pa.array(left, pa.bool_()),
                    pa.array(letter_masks(texts).view(np.int64)[owner]),
                    pa.array(loose, pa.bool_()),
                    part.column(0).take(pa.array(owner)),
                    part.column(1).take(pa.array(owner)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["list", "size", "limit", "left", "mask", "loose", "word", "n"])

    return words.select("word", "n").mapInArrow(run, schema)


# ---- pairs ----------------------------------------------------------------------------------------------
def shared_ends(a: str, b: str) -> tuple[int, int]:
    """Code points that two words share at the start, and at the end."""
    least = min(len(a), len(b))
    start = next((i for i in range(least) if a[i] != b[i]), least)
    end = next((i for i in range(least) if a[-1 - i] != b[-1 - i]), least)
    return start, end


class Letters:
    """Code points of words from the left and from the right, in rows of equal width."""

    def __init__(self, words: list[str]):
        self.words = words
        self.lengths = np.fromiter(map(len, words), np.int64, len(words))
        self.narrow = self.lengths <= WIDE
        short = [w if len(w) <= WIDE else "" for w in words]
        width = max(1, max(map(len, short), default=1))
        self.left = self.matrix(short, width)
        self.right = self.matrix([w[::-1] for w in short], width)

    @staticmethod
    def matrix(words: list[str], width: int) -> np.ndarray:
        return np.array(words, dtype=f"<U{width}").view(np.uint32).reshape(-1, width).astype(np.uint16)

    def shared(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Shared code points at the start and at the end of words i and j."""
        least = np.minimum(self.lengths[i], self.lengths[j])

        def run_of(letters: np.ndarray) -> np.ndarray:
            differ = letters[i] != letters[j]
            return np.where(differ.any(axis=1), differ.argmax(axis=1), least)

        start, end = np.minimum(run_of(self.left), least), np.minimum(run_of(self.right), least)
        for k in np.flatnonzero(~(self.narrow[i] & self.narrow[j])):
            start[k], end[k] = shared_ends(self.words[i[k]], self.words[j[k]])
        return start, end


def near_pairs(keys: np.ndarray, sizes: np.ndarray, limits: np.ndarray, left: np.ndarray, masks: np.ndarray, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) of the near words of whole lists, sorted by list and size, each pair where its list's limits let it be."""
    letters = Letters(words.to_pylist())
    found_i, found_j = [], []
    wait_i: list[np.ndarray] = []
    wait_j: list[np.ndarray] = []
    waiting = 0

    def verify() -> None:
        i, j = np.concatenate(wait_i), np.concatenate(wait_j)
        for a in range(0, i.size, 200_000):
            x, y = i[a : a + 200_000], j[a : a + 200_000]
            start, end = letters.shared(x, y)
            most = np.maximum(sizes[x], sizes[y])
            near = (start + end >= most - 1) & ~((start == most) & (sizes[x] == sizes[y]))
            place = start + 1
            here = np.where(
                left[x],
                (place <= limits[x]) & (place <= limits[y]),
                (place >= limits[x]) & (place >= limits[y]),
            )
            found_i.append(x[near & here])
            found_j.append(y[near & here])
        wait_i.clear()
        wait_j.clear()

    live, gap = np.arange(keys.size), 0
    while live.size:
        gap += 1
        live = live[live + gap < keys.size]
        other = live + gap
        together = (keys[live] == keys[other]) & (sizes[other] - sizes[live] <= 1)
        live, other = live[together], other[together]
        close = np.bitwise_count(masks[live] ^ masks[other]) <= 2
        if close.any():
            wait_i.append(live[close])
            wait_j.append(other[close])
            waiting += wait_i[-1].size
            if waiting > 1_000_000:
                verify()
                waiting = 0
    if wait_i:
        verify()
    empty = np.empty(0, np.int64)
    return np.concatenate([empty, *found_i]), np.concatenate([empty, *found_j])


def verified(entries: DataFrame, ratio: int) -> DataFrame:
    """(word, near, form_n): both directions of the near pairs of each list; ``form_n`` is the occurrences of
    ``near`` if they are ``ratio`` times those of the word or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def pairs_of(part: pa.Table) -> Iterator[pa.RecordBatch]:
            part = part.combine_chunks()
            columns = {name: part.column(name).chunk(0) for name in part.column_names}
            keys, sizes, limits, masks = (columns[c].to_numpy() for c in ("list", "size", "limit", "mask"))
            alone = np.append(True, keys[1:] != keys[:-1])
            kept = np.flatnonzero(~(alone & np.append(alone[1:], True)))
            if not kept.size:
                return
            words, n = columns["word"].take(pa.array(kept)), columns["n"].to_numpy()[kept]
            left = columns["left"].to_numpy(zero_copy_only=False)[kept]
            i, j = near_pairs(keys[kept], sizes[kept], limits[kept], left, masks[kept].view(np.uint64), words)
            for a in range(0, i.size, 50_000):
                x, y = i[a : a + 50_000], j[a : a + 50_000]
                word, near = np.concatenate([x, y]), np.concatenate([y, x])
                grown = n[near] >= ratio * n[word]
                form_n = pa.array(n[near], pa.int64(), mask=~grown)
                yield pa.RecordBatch.from_arrays([words.take(pa.array(word)), words.take(pa.array(near)), form_n], ["word", "near", "form_n"])

        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            if held.num_rows < 100_000:
                continue
            keys = held.column("list").to_numpy()
            whole = int(np.searchsorted(keys, keys[-1]))  # the last list may go on
            if whole:
                yield from pairs_of(held.slice(0, whole))
                held = held.slice(whole)
        if held is not None and held.num_rows:
            yield from pairs_of(held)

    columns = ["list", "size", "limit", "left", "mask", "word", "n"]
    sorted_lists = entries.select(*columns).repartition("list").sortWithinPartitions("list", "size")
    return sorted_lists.mapInArrow(run, "word string, near string, form_n long")


def near_words(words: DataFrame, ratio: int = RATIO, qmax: int = QMAX, expand_at: int = EXPAND_AT) -> DataFrame:
    """(word, n_near, form, form_n) of the words that have near words, by the gram index."""
    counts = grow_dictionary(words, qmax, expand_at)
    entries = written(list_entries(words, counts, qmax), "gram-lists")
    loose = entries.where("loose").select("word", "n").distinct()
    pairs = verified(entries, ratio).union(verified(list_entries(loose, counts, QMIN), ratio))
    # both groupings need the words together only, so one shuffle serves them
    once = pairs.repartition("word").groupBy("word", "near").agg(F.max("form_n").alias("form_n"))
    best = F.min(F.when(F.col("form_n").isNotNull(), F.struct((-F.col("form_n")).alias("less"), F.col("near"))))
    told = once.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    return told.select("word", "n_near", F.col("best.near").alias("form"), (-F.col("best.less")).alias("form_n"))


def roots(forms: DataFrame, most: int, least: int, ratio: int = RATIO) -> DataFrame:
    """(word, root): the last of the forms that follow one another from ``word``, by pointer doubling.

    Occurrences grow by ``ratio`` with every form, so ``most`` / ``least`` bounds the number of forms in a row.
    """
    pointers = forms.select("word", F.col("form").alias("root"))
    longest = int(math.log(max(most, 1) / max(least, 1), ratio) + 1e-9) if ratio > 1 else 0
    for _ in range(math.ceil(math.log2(longest)) if longest > 1 else 0):
        onward = pointers.select(F.col("word").alias("root"), F.col("root").alias("further"))
        pointers = written(pointers.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "roots")
    return pointers


def spelling_variants(
    docs: DataFrame, min_chars: int = 7, min_count: int = 2, ratio: int = RATIO, id_col: str = "doc_id", text_col: str = "text", qmax: int = QMAX, expand_at: int = EXPAND_AT
) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of the words of ``docs``; ``ratio`` must be above 1."""
    if ratio < 2 or min_chars < 7:
        raise ValueError("ratio must be at least 2, and words have at least 7 code points, below which the bounds do not hold")
    words = written(word_counts(docs, min_chars, min_count, id_col, text_col), "words")
    told = written(words.join(near_words(words, ratio, qmax, expand_at), "word", "left"), "near-words")
    forms = told.where("form IS NOT NULL").select("word", "form")
    most = words.agg(F.max("n")).first()[0] or 0
    found = told.join(roots(forms, most, min_count, ratio), "word", "left")
    return found.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form", "form_n", F.coalesce("root", "word").alias("root")
    )
