"""Removal of repeated byte strings by blockwise suffix sorting with a difference cover.

A byte goes when some string of ``LENGTH`` bytes that covers it starts at two places or more, in one document or
in several; strings are judged on the input and never cross documents.

1. *Buckets.* Sorting every suffix would shuffle many times the corpus. Suffixes are dealt to buckets by an anchor:
   among the ``GRAM``-byte strings of a window of LENGTH bytes the one with the least hash, leftmost. Equal windows
   have equal anchors at the same offset, so equal suffixes meet in one bucket, and a bucket of one anchor
   occurrence has no repeat. Only the anchors (hash, place, hash of the bytes around) are shuffled.
2. *Contexts.* Occurrences with equal bytes around (all windows of the anchor) repeat as a whole. Buckets with
   several contexts get the bytes of one occurrence each.
3. *Sorting.* A task sorts one bucket after the other. The contexts of a bucket are aligned at the anchor. For the
   columns of a difference cover (modulo ``PERIOD``) it precomputes ranks to depth 156 by doubling; a suffix is
   ordered by the rank at its next cover column, whatever the length of the tie, and by the few bytes before and
   behind that the rank leaves out. So memory is that of one bucket's contexts.
4. Buckets of more than ``BUCKET`` contexts are dealt on by window: equal windows are counted by 128-bit
   fingerprints, in as many tasks as needed. It is the exact way for buckets no task should hold.

Cases: null and empty texts, and texts below LENGTH bytes, keep all their bytes. Repeated rows, and rows that share
an id, are documents of their own. Extra columns are left out. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from accountrisk.llm.common import as_bytes, mix, steps
from accountrisk.session import written

LENGTH = 200
GRAM = 48
REACH = LENGTH - GRAM  # windows of an anchor begin at most so far before it
WIDTH = REACH + LENGTH
PERIOD = 31
COVER = (1, 5, 11, 24, 25, 27)  # a perfect difference set modulo 31 (fixed values)
BUCKET = 20_000
#: Anchors told to all tasks as frequent at most (only spares a grouping), and what counts as frequent.
KNOWN_FREQUENT, LOCAL_COUNT, TOTAL_COUNT = 200_000, 3, 64
STEP = 1_000_000

_BASE = 0x2545F4914F6CDD1D  # odd, so that it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, at least n of each; kept for the process."""
    if len(_powers[0]) < n:
        for k, factor in enumerate((_BASE, _INVERSE)):
            row = np.full(n, factor, np.uint64)
            row[0] = 1
            _powers[k] = np.multiply.accumulate(row)
    return _powers


class Rolling:
    """Hashes of any stretch of some bytes from one running sum."""

    def __init__(self, raw: np.ndarray):
        up, self.down = powers(len(raw) + 1)
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_BYTE[raw] * up[: len(raw)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])


def anchors(raw: np.ndarray, ends: np.ndarray, contexts: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, place in it, anchor hash, context hash) of the anchors of texts that lie in ``raw`` one after the
    other, ``ends`` with a leading 0."""
    none = np.empty(0, np.int64)
    if len(raw) < LENGTH:
        return none, none, none.view(np.uint64), none.view(np.uint64)
    rolling = Rolling(raw)
    n = len(raw) - GRAM + 1
    low = rolling.sums[GRAM:] - rolling.sums[:n]
    low *= rolling.down[:n]
    low ^= low >> np.uint64(31)
    low *= _FACTOR
    low &= np.uint64(0xFFFFFFFF00000000)
    low |= np.arange(n, dtype=np.uint64)
    # least of REACH + 1 grams from each place on, by doubling
    width = 1
    while 2 * width <= REACH + 1:
        np.minimum(low[:-width], low[width:], out=low[:-width])
        low = low[:-width]
        width *= 2
    rest = REACH + 1 - width
    low = np.minimum(low[: len(low) - rest], low[rest:]) if rest else low
    sizes = np.diff(ends)
    inside = np.zeros(len(raw) + 1, np.int64)
    long = sizes >= LENGTH
    np.add.at(inside, ends[:-1][long], 1)
    np.add.at(inside, ends[1:][long] - LENGTH + 1, -1)
    chosen = (low & np.uint64(0xFFFFFFFF))[np.cumsum(inside)[: len(low)] > 0].astype(np.int64)
    if not len(chosen):
        return none, none, none.view(np.uint64), none.view(np.uint64)
    at = chosen[np.append(True, chosen[1:] != chosen[:-1])]
    doc = np.searchsorted(ends, at, side="right") - 1
    first, last = np.maximum(at - REACH, ends[doc]), np.minimum(at + LENGTH, ends[doc + 1])
    if not contexts:
        return doc, at - ends[doc], rolling.of(at, at + GRAM), None
    around = rolling.of(first, last) ^ mix(((at - first) * 1000 + (last - at)).astype(np.uint64))
    return doc, at - ends[doc], rolling.of(at, at + GRAM), around


def anchor_table(texts: DataFrame, known=None) -> DataFrame:
    """(h, c, id, v, pos) of every anchor; with ``known`` also whether h is known to be frequent."""
    kind = texts.schema["id"].dataType.simpleString()
    schema = f"h long, c long, id {kind}, v binary, pos int" + ", known boolean" * (known is not None)
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches):
        for batch in batches:
            for part in steps(batch, "t", STEP):
                values = part.column("t").to_pylist()
                ends = np.append(0, np.cumsum([len(x) for x in values]))
                doc, pos, h, c = anchors(np.frombuffer(b"".join(values), np.uint8), ends)
                took = pa.array(doc)
                columns = [pa.array(h.view(np.int64)), pa.array(c.view(np.int64)), part.column("id").take(took), part.column("v").take(took), pa.array(pos.astype(np.int32))]
                if known is not None:
                    list_ = known.value
                    columns.append(pa.array(list_[np.minimum(np.searchsorted(list_, h), len(list_) - 1)] == h if len(list_) else np.zeros(len(h), bool)))
                yield pa.RecordBatch.from_arrays(columns, names)

    return texts.select("id", "v", "t").mapInArrow(run, schema)


def frequent_anchors(texts: DataFrame) -> np.ndarray:
    def run(batches):
        for batch in batches:
            found = []
            for part in steps(batch, "t", STEP):
                values = part.column("t").to_pylist()
                found.append(anchors(np.frombuffer(b"".join(values), np.uint8), np.append(0, np.cumsum([len(x) for x in values])), False)[2])
            h, n = np.unique(np.concatenate(found or [np.empty(0, np.uint64)]), return_counts=True)
            often = n >= LOCAL_COUNT
            yield pa.RecordBatch.from_arrays([pa.array(h[often].view(np.int64)), pa.array(n[often])], ["h", "n"])

    tallies = texts.select("t").mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    top = tallies.where(F.col("n") >= TOTAL_COUNT).orderBy(F.desc("n"), "h").limit(KNOWN_FREQUENT).toArrow()
    return np.sort(top.column("h").to_numpy().view(np.uint64))


# ---- sorting of buckets ---------------------------------------------------------------------------------
def dense(*keys: np.ndarray) -> np.ndarray:
    """Ranks of rows by the keys, the first the most significant; equal rows share a rank."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(new)
    return rank


def next_cover() -> np.ndarray:
    """The next cover column from each column on."""
    cover = [x for x in range(WIDTH) if x % PERIOD in COVER]
    return np.array([cover[np.searchsorted(cover, x)] if x <= cover[-1] else WIDTH for x in range(WIDTH)])


def repeated_windows(contexts: np.ndarray, bucket: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each context (rows of WIDTH bytes, anchor at REACH) the windows, by first column, that another context
    of the same bucket has at the same column."""
    rows = len(contexts)
    out = np.zeros((rows, REACH + 1), bool)
    padded = np.hstack([contexts, np.zeros((rows, 8), np.uint8)])
    word = np.lib.stride_tricks.sliding_window_view(padded, 8, axis=1)

    def words(column: int, n: int) -> list[np.ndarray]:
        return [np.ascontiguousarray(word[:, min(column + 8 * k, WIDTH)]).view(">u8").ravel().astype(np.uint64) for k in range(n)]

    cover = next_cover()
    wanted = sorted({int(cover[o]) for o in range(REACH + 1)})
    ranks: dict[tuple[int, int], np.ndarray] = {}

    def rank(column: int, depth: int) -> np.ndarray:
        """Rank of the first ``depth`` bytes from a cover column on: 32, then pairs of ranks a multiple of PERIOD apart."""
        if (column, depth) not in ranks:
            if depth == 32:
                ranks[column, depth] = dense(bucket, *words(column, 4))
            else:
                half, shift = {63: (32, PERIOD), 125: (63, 2 * PERIOD), 156: (125, PERIOD)}[depth]
                ranks[column, depth] = dense(rank(column, half), rank(column + shift, half))
        return ranks[column, depth]

    done = {s: rank(s, 156) for s in wanted}
    for o in range(REACH + 1):
        has = np.flatnonzero((REACH - left <= o) & (o + LENGTH <= REACH + right))
        if len(has) < 2:
            continue
        # the rank covers [s, s + 156), s - o <= 13; left are the bytes before s and from o + 152 on
        edge = np.zeros(rows, np.uint64)
        for w in (*words(o, 2), *words(o + 152, 6)):
            edge = mix(edge * np.uint64(0x9E3779B97F4A7C15) + w)
        r, e = done[int(cover[o])][has], edge[has]
        order = np.lexsort((e, r))
        same = (r[order][1:] == r[order][:-1]) & (e[order][1:] == e[order][:-1])
        hit = np.append(False, same) | np.append(same, False)
        out[has[order[hit]], o] = True
    return out


def relative_spans(mask: np.ndarray) -> list[dict]:
    """Bytes that the marked windows cover, from the anchor on."""
    out: list[dict] = []
    for o in np.flatnonzero(mask).tolist():
        if out and o - REACH <= out[-1]["end"]:
            out[-1]["end"] = o - REACH + LENGTH
        else:
            out.append({"start": o - REACH, "end": o - REACH + LENGTH})
    return out


def matrix_of(batch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(contexts, bytes left of the anchor, bytes from the anchor on)."""
    left = batch.column("left").to_numpy().astype(np.int64)
    values = batch.column("bytes").to_pylist()
    out = np.zeros((len(values), WIDTH), np.uint8)
    for row, value, k in zip(out, values, left.tolist(), strict=True):
        row[REACH - k : REACH - k + len(value)] = np.frombuffer(value, np.uint8)
    return out, left, np.array([len(v) for v in values]) - left


SPANS = "array<struct<start:int,end:int>>"
SPANS_ARROW = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def sorted_buckets(contexts: DataFrame) -> DataFrame:
    """(h, c, spans) of contexts (h, c, left, bytes), whole buckets a task."""
    parts = int(contexts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = contexts.repartition(parts, "h").sortWithinPartitions("h")

    def emit(batch):
        rows, left, right = matrix_of(batch)
        hits = repeated_windows(rows, batch.column("h").to_numpy(), left, right)
        spans = pa.array([relative_spans(m) for m in hits], SPANS_ARROW)
        return pa.RecordBatch.from_arrays([batch.column("h"), batch.column("c"), spans], ["h", "c", "spans"])

    def run(batches):
        held = None
        for batch in batches:
            for start in range(0, batch.num_rows, 5_000):
                part = batch.slice(start, 5_000)
                if held is not None:
                    part = pa.Table.from_batches([held, part]).combine_chunks().to_batches()[0]
                h = part.column("h").to_numpy()
                change = np.flatnonzero(h[1:] != h[:-1]) + 1
                cut = int(change[-1]) if len(change) else 0
                if cut:
                    yield emit(part.slice(0, cut))
                held = part.slice(cut)
        if held is not None and held.num_rows:
            yield emit(held)

    return dealt.mapInArrow(run, f"h long, c long, spans {SPANS}")


def counted_windows(contexts: DataFrame) -> DataFrame:
    """As ``sorted_buckets``, for buckets too large for a task: windows meet by fingerprint."""

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                rows, left, right = matrix_of(part)
                first = np.arange(REACH + 1)
                has = (REACH - left[:, None] <= first) & (first + LENGTH <= (REACH + right)[:, None])
                r, o = np.nonzero(has)
                rolling = Rolling(rows.ravel())
                f1 = rolling.of(r * WIDTH + o, r * WIDTH + o + LENGTH)
                f2 = rolling.of(r * WIDTH + o + 7, r * WIDTH + o + LENGTH) ^ mix(f1)
                took = pa.array(r)
                yield pa.RecordBatch.from_arrays(
                    [part.column("h").take(took), part.column("c").take(took), pa.array(o.astype(np.int32)), pa.array(f1.view(np.int64)), pa.array(f2.view(np.int64))],
                    ["h", "c", "o", "f1", "f2"],
                )

    windows = written(contexts.mapInArrow(run, "h long, c long, o int, f1 long, f2 long"), "windows")
    keys = ["h", "o", "f1", "f2"]
    often = windows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").drop("n")
    hits = windows.join(often, keys, "left_semi")
    spans = F.transform(F.array_sort(F.collect_set("o")), lambda o: F.struct((o - REACH).cast("int").alias("start"), (o - REACH + LENGTH).cast("int").alias("end")))
    return hits.groupBy("h", "c").agg(spans.alias("spans"))


# ---- the operator ---------------------------------------------------------------------------------------
def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``n_bytes``, ``spans`` (removed bytes, merged), ``kept`` (binary, the
    remaining bytes)."""
    texts = docs.select(F.col(id_col).alias("id"), as_bytes(text_col).alias("t"))
    # rows are told apart by id and, where ids repeat or are null, by 128 bits of the text
    texts = texts.withColumn("v", F.unhex(F.md5("t")))
    known = docs.sparkSession.sparkContext.broadcast(frequent_anchors(texts))
    found = anchor_table(texts, known)
    single = found.where("NOT known").withColumn("k", F.count("*").over(Window.partitionBy("h"))).where("k > 1")
    shared = written(single.drop("k", "known").union(found.where("known").drop("known")), "anchors")

    place = F.min(F.struct("id", "v", "pos")).alias("place")
    kinds = written(shared.groupBy("h", "c").agg(F.count("*").alias("n"), place), "anchor-contexts")
    sizes = kinds.groupBy("h").agg(F.count("*").alias("m")).where("m > 1")
    several = kinds.join(sizes, "h").select("h", "c", "m", "place.*")

    # bytes around one occurrence of each context
    asked = several.groupBy("id", "v").agg(F.collect_list(F.struct("h", "c", "m", "pos")).alias("asked"))
    asked = written(asked, "asked").toDF("id_", "v_", "asked")
    same = F.col("id").eqNullSafe(F.col("id_")) & (F.col("v") == F.col("v_"))
    # identical rows hold the same bytes: any of them serves
    served = texts.join(asked, same).select("t", "asked")

    def cut(batches):
        for batch in batches:
            rows = []
            for text, own in zip(batch.column("t").to_pylist(), batch.column("asked").to_pylist(), strict=True):
                for a in own:
                    p = a["pos"]
                    rows.append((a["h"], a["c"], a["m"], min(p, REACH), text[max(0, p - REACH) : p + LENGTH]))
            for k in range(0, len(rows), 5_000):
                columns = zip(*rows[k : k + 5_000], strict=True)
                kinds_ = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds_, strict=True)], ["h", "c", "m", "left", "bytes"])

    contexts = written(served.mapInArrow(cut, "h long, c long, m long, left int, bytes binary"), "contexts").dropDuplicates(["h", "c"])
    small = sorted_buckets(contexts.where(F.col("m") <= BUCKET).drop("m"))
    large = counted_windows(contexts.where(F.col("m") > BUCKET).drop("m"))
    partly = written(small.union(large), "bucket-spans").where(F.size("spans") > 0)

    # a context that stands twice repeats as a whole
    whole = kinds.where("n > 1").select("h", "c", F.lit(True).alias("whole"), F.lit(None).cast(SPANS).alias("spans"))
    part = partly.join(kinds.where("n = 1").select("h", "c"), ["h", "c"], "left_semi").select("h", "c", F.lit(False).alias("whole"), "spans")
    marks = shared.join(whole.union(part), ["h", "c"]).groupBy("id", "v").agg(F.collect_list(F.struct("pos", "whole", "spans")).alias("marks"))
    marks = marks.toDF("id_", "v_", "marks")
    joined = texts.join(marks, same, "left").select("id", "t", "marks")

    def finish(batches):
        for batch in batches:
            ids = batch.column("id")
            spans, kept, sizes_ = [], [], []
            for text, own in zip(batch.column("t").to_pylist(), batch.column("marks").to_pylist(), strict=True):
                cover = []
                for m in own or []:
                    p = m["pos"]
                    if m["whole"]:
                        cover.append((max(0, p - REACH), min(len(text), p + LENGTH)))
                    else:
                        cover += [(p + s["start"], p + s["end"]) for s in m["spans"]]
                merged: list[list[int]] = []
                for a, b in sorted(cover):
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(b, merged[-1][1])
                    else:
                        merged.append([a, b])
                spans.append([{"start": a, "end": b} for a, b in merged])
                edges = [0, *(x for s in merged for x in s), len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
                sizes_.append(len(text))
            yield pa.RecordBatch.from_arrays([ids, pa.array(sizes_, pa.int64()), pa.array(spans, SPANS_ARROW), pa.array(kept, pa.binary())], ["id", "n_bytes", "spans", "kept"])

    kind = texts.schema["id"].dataType.simpleString()
    out = joined.mapInArrow(finish, f"id {kind}, n_bytes long, spans {SPANS}, kept binary")
    return out.withColumnRenamed("id", id_col)
