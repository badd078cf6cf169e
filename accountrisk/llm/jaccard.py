"""N-gram Jaccard join of near copies: count-vector R-trees over blocks of documents.

A document's set holds its distinct word shingles as 64-bit hashes; documents with equal sets (128-bit digest) are
one class, and the work is done between classes. Two classes link when ``100 * overlap >= 75 * union``.

1. *Order.* One pass tallies shingles that stand out within each task and sums the tallies; shingles known to be
   frequent come last in the global order, the rest by hash. The order changes the cost only, never the result.
2. *Blocks.* Classes that link share a shingle among the first n - ceil(0.75 n) + 1 of each set, so each of those
   shingles is a block. Frequent shingles are salted into sub-blocks.
3. *Pivots.* Every member of a sub-block is paired with its pivot, pivots of a frequent shingle with one of them.
   Pairs whose count vectors bound the overlap high enough are verified on the sets; the links join classes into
   components.
4. *Trees.* Blocks that still hold several components get an R-tree over the members' count vectors (shingles
   hashed into groups, counted; the more groups, the larger the set). A query bounds the overlap with a node by the sum of coordinate minima with the
   node's upper corner, and leaves subtrees that cannot reach the needed overlap or hold its own component only.
   Blocks over ``TILE`` members are cut into tiles, every pair of parts being a tile, so that no task holds a whole
   block. Pairs that survive are verified; their links finish the components. Where many pairs survive among few
   classes, as between near copies that missed their pivot, each class's best bounded pair is verified first: pairs that
   those links put into one component need no check.

A pair inside a component needs no check: components are the result. So a group of copies costs its members, not
its pairs, and nothing is dropped, capped or sampled.

Cases: null, empty and blank texts have no shingles, are components of their own and link with nothing. Texts of
fewer words than a shingle are one shingle. Repeated rows and repeated ids are rows of their own; a null id is
never the smallest of its component unless all are null. Extra columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from contextlib import contextmanager
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from accountrisk.llm.common import as_bytes, list_array, mix, steps, trimmed
from accountrisk.session import written

WORDS = 5
MIN_GROUPS = 64
#: Frequent shingles told to all tasks at most (a hint for the order, 16 bytes each), and what counts as frequent.
KNOWN_FREQUENT, LOCAL_COUNT, TOTAL_COUNT = 200_000, 3, 64
SALTS = 64
TILE = 1024
FANOUT = 16
#: Candidate pairs a class from which on the best pairs are verified before the others; changes no result.
DENSE = 4

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


# ---- sets -----------------------------------------------------------------------------------------------
def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words (SipHash with a fixed key)."""
    flat = np.empty(len(words), object)
    flat[:] = words
    return pd.util.hash_array(flat, categorize=False)


def joined_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """Hashes of ``size`` consecutive words from each place on."""
    n = len(h) - size + 1
    total = h[:n] + np.uint64(size)
    for k in range(1, size):
        total *= _FACTOR
        total += h[k : n + k]
    return mix(total)


def shingle_sets(texts: list[bytes], n_words: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    split = [t.translate(_LOWER).split() for t in texts]
    h = word_hashes([w for words in split for w in words])
    whole = joined_hashes(h, n_words) if len(h) >= n_words else h[:0]
    out, at = [], 0
    for words in split:
        n = len(words)
        if n >= n_words:
            s = np.sort(whole[at : at + n - n_words + 1])
            s = s[np.append(True, s[1:] != s[:-1])]
        else:
            s = joined_hashes(h[at : at + n], n) if n else h[:0]
        out.append(s)
        at += n
    return out


def digests(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums over each set, whose elements are spread hashes."""
    a = np.array([s.sum(dtype=np.uint64) for s in sets], np.uint64)
    b = np.array([((s ^ (s >> np.uint64(29))) * _FACTOR).sum(dtype=np.uint64) for s in sets], np.uint64)
    return mix(a).view(np.int64), mix(b).view(np.int64)


def count_vector(s: np.ndarray) -> bytes:
    """Counts of a set's hashes by group, four bits each, with half as many groups as hashes or more: unrelated sets then
    bound far below a link, and sets that share 0.7 mostly do. Empty, which bounds nothing, where a count is over 15."""
    groups = max(MIN_GROUPS, 1 << max(0, len(s).bit_length() - 1) if len(s) else 0)
    counts = np.bincount((s & np.uint64(groups - 1)).astype(np.int64), minlength=groups).astype(np.uint8)
    return (counts[::2] | counts[1::2] << 4).tobytes() if counts.max(initial=0) < 16 else b""


def groups_of(vector: bytes) -> int:
    return 2 * len(vector)


def folded(vectors: list[bytes], groups: int) -> np.ndarray:
    """Rows of so many groups from vectors of as many or of a multiple (the groups are low bits)."""
    out = np.empty((len(vectors), groups), np.int16)
    for k, v in enumerate(vectors):
        packed = np.frombuffer(v, np.uint8)
        row = np.stack([packed & 15, packed >> 4], 1).ravel()
        out[k] = row if len(row) == groups else row.reshape(-1, groups).sum(0)
    return out


def prefix_length(n: int) -> int:
    """Two linked sets share one of so many first elements of each."""
    return n - (3 * n + 3) // 4 + 1


def links(overlap, n_a, n_b):
    """100 * overlap >= 75 * union, without the union."""
    return 7 * overlap >= 3 * (n_a + n_b)


def frequent_shingles(docs: DataFrame, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted hashes, counts) of shingles that stand out in the tasks' tallies."""

    def run(batches):
        for batch in batches:
            for part in steps(batch, "t", 8_000_000):
                sets = shingle_sets(part.column("t").to_pylist(), n_words)
                flat = np.concatenate(sets)
                flat.sort()
                first = np.flatnonzero(np.append(True, flat[1:] != flat[:-1])) if flat.size else np.empty(0, np.int64)
                count = np.diff(np.append(first, flat.size))
                often = count >= LOCAL_COUNT
                yield pa.RecordBatch.from_arrays([pa.array(flat[first[often]].view(np.int64)), pa.array(count[often])], ["shingle", "n"])

    tallies = docs.select("t").mapInArrow(trimmed(run), "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    top = tallies.where(F.col("n") >= TOTAL_COUNT).orderBy(F.desc("n"), "shingle").limit(KNOWN_FREQUENT).toArrow()
    hashes = top.column("shingle").to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], top.column("n").to_numpy()[order]


def profile_table(docs: DataFrame, frequent, n_words: int) -> DataFrame:
    """One row per document: uid, id, n (set size), digest d1, d2, count vector, the prefix in the global
    order and how many of it are not known to be frequent; and its ``key`` where ``docs`` has one."""
    own = [c for c in docs.columns if c == "key"]
    known = docs.sparkSession.sparkContext.broadcast(frequent)

    def prefix_of(s: np.ndarray) -> tuple[np.ndarray, int]:
        size, (hashes, counts) = prefix_length(len(s)), known.value
        if not len(hashes):
            return s[:size], size
        at = np.minimum(np.searchsorted(hashes, s), len(hashes) - 1)
        is_known = hashes[at] == s
        light = s[~is_known][:size]
        if len(light) == size:
            return light, size
        heavy, n = s[is_known], counts[at[is_known]]
        return np.concatenate([light, heavy[np.lexsort((heavy, n))][: size - len(light)]]), len(light)

    def run(batches):
        uid = TaskContext.get().partitionId() << 33
        for batch in batches:
            for part in steps(batch, "t"):
                sets = shingle_sets(part.column("t").to_pylist(), n_words)
                sizes = np.array([len(s) for s in sets])
                prefixes = [prefix_of(s) if len(s) else (s, 0) for s in sets]
                counts = [count_vector(s) for s in sets]
                ends = np.append(0, np.cumsum([len(p) for p, _ in prefixes]))
                flat = np.concatenate([p for p, _ in prefixes]).view(np.int64)
                columns = [
                    pa.array(np.arange(uid, uid + len(sets))),
                    part.column("id"),
                    pa.array(sizes),
                    *map(pa.array, digests(sets)),
                    pa.array(counts, pa.binary()),
                    list_array(flat, ends),
                    pa.array([k for _, k in prefixes], pa.int32()),
                    *map(part.column, own),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["uid", "id", "n", "d1", "d2", "counts", "prefix", "n_light", *own])
                uid += len(sets)

    kind = docs.schema["id"].dataType.simpleString()
    keys = "".join(f", {c} {docs.schema[c].dataType.simpleString()}" for c in own)
    return docs.mapInArrow(trimmed(run), f"uid long, id {kind}, n long, d1 long, d2 long, counts binary, prefix array<long>, n_light int{keys}")


# ---- components -----------------------------------------------------------------------------------------
def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that ``edges`` (a, b) reach, for every node of an edge.

    Alternating large and small stars, each round written to the shared folder, until the edges are stars.
    """
    now = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    mark = None
    while True:
        new = now.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        if new == mark or not new.n:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b").distinct())
        mark = new
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select("b", "a"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        large = written(large, "edges")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = written(small.union(low).distinct(), "edges")


# ---- verification ---------------------------------------------------------------------------------------
@contextmanager
def early_join_filter(spark: SparkSession):
    """Let Spark filter a scan by a Bloom filter of the join's other side also below its usual sizes."""
    name = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "16MB")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def set_table(docs: DataFrame, profiles: DataFrame, wanted: DataFrame, n_words: int) -> DataFrame:
    """(cid, n, set) of the wanted classes (cid), from the texts of their first rows."""
    chosen = written(profiles.join(wanted, F.col("uid") == F.col("cid")).select("cid", "id", "n", "d1", "d2"), "wanted")
    ids = chosen.where("n >= 1").select(F.col("id").alias("wanted_id"))
    picked = docs.join(ids, F.col("id").eqNullSafe(F.col("wanted_id")), "left_semi").select("t")

    def run(batches):
        for batch in batches:
            for part in steps(batch, "t"):
                sets = shingle_sets(part.column("t").to_pylist(), n_words)
                ends = np.append(0, np.cumsum([len(s) for s in sets]))
                yield pa.RecordBatch.from_arrays([*map(pa.array, digests(sets)), list_array(np.concatenate(sets).view(np.int64), ends)], ["e1", "e2", "shingles"])

    made = picked.mapInArrow(trimmed(run), "e1 long, e2 long, shingles array<long>")
    same = (F.col("e1") == F.col("d1")) & (F.col("e2") == F.col("d2"))
    with early_join_filter(docs.sparkSession):
        return written(made.dropDuplicates(["e1", "e2"]).join(chosen, same).select("cid", "n", "shingles"), "sets")


def verified(docs: DataFrame, profiles: DataFrame, pairs: DataFrame, n_words: int) -> DataFrame:
    """The pairs (a, b) of classes that link."""
    wanted = pairs.select(F.col("a").alias("cid")).union(pairs.select("b")).distinct()
    sets = set_table(docs, profiles, wanted, n_words)
    one, two = (sets.toDF(f"cid_{k}", f"n_{k}", f"set_{k}") for k in "ab")
    joined = pairs.join(one, F.col("a") == F.col("cid_a")).join(two, F.col("b") == F.col("cid_b"))
    overlap = F.size(F.array_intersect("set_a", "set_b"))
    return written(joined.where(links(overlap, F.col("n_a"), F.col("n_b"))).select("a", "b").distinct(), "links")


def most_overlap(a: bytes, b: bytes) -> int | float:
    """The sum of coordinate minima; without end where a vector bounds nothing."""
    if not a or not b:
        return float("inf")
    x, y = folded([a, b], min(groups_of(a), groups_of(b)))
    return int(np.minimum(x, y).sum())


def bounded(profiles: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs whose count vectors allow the needed overlap."""
    one, two = (profiles.select(F.col("uid").alias(f"uid_{k}"), F.col("n").alias(f"n_{k}"), F.col("counts").alias(f"counts_{k}")) for k in "ab")
    joined = pairs.join(one, F.col("a") == F.col("uid_a")).join(two, F.col("b") == F.col("uid_b")).drop("uid_a", "uid_b")
    joined = joined.where((4 * F.col("n_a") >= 3 * F.col("n_b")) & (4 * F.col("n_b") >= 3 * F.col("n_a")))

    def run(batches):
        for batch in batches:
            n = (batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()).tolist()
            vectors = zip(batch.column("counts_a").to_pylist(), batch.column("counts_b").to_pylist(), n, strict=True)
            yield batch.select(["a", "b"]).filter(pa.array([7 * most_overlap(x, y) >= 3 * k for x, y, k in vectors], pa.bool_()))

    return written(joined.mapInArrow(trimmed(run), "a long, b long"), "pivot-pairs")


# ---- trees ----------------------------------------------------------------------------------------------
class CountTree:
    """R-tree over count vectors, packed by set size: per node the upper corner, the smallest set size, and the
    component if all points below are of one (else -1)."""

    def __init__(self, counts: np.ndarray, sizes: np.ndarray, roots: np.ndarray):
        self.order = np.lexsort((roots, sizes))
        self.levels = [(counts[self.order], sizes[self.order], roots[self.order])]
        while len(self.levels[-1][1]) > FANOUT:
            high, low, root = self.levels[-1]
            cut = np.arange(0, len(low), FANOUT)
            mixed = np.maximum.reduceat(root, cut) != np.minimum.reduceat(root, cut)
            self.levels.append((np.maximum.reduceat(high, cut), np.minimum.reduceat(low, cut), np.where(mixed | (np.minimum.reduceat(root, cut) < 0), -1, root[cut])))

    def search(self, counts: np.ndarray, sizes: np.ndarray, roots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, point) numbers of the pairs of different components that the bound lets through."""
        high, _, _ = self.levels[-1]
        q, node = (x.ravel() for x in np.meshgrid(np.arange(len(sizes)), np.arange(len(high)), indexing="ij"))
        for depth in range(len(self.levels) - 1, -1, -1):
            high, low, root = self.levels[depth]
            may = (root[node] != roots[q]) & (4 * sizes[q] >= 3 * low[node])
            q, node = q[may], node[may]
            keep, chunk = np.zeros(len(q), bool), max(1, 4_000_000 // counts.shape[1])
            for k in range(0, len(q), chunk):
                a, b = q[k : k + chunk], node[k : k + chunk]
                keep[k : k + chunk] = links(np.minimum(counts[a], high[b]).sum(1, dtype=np.int64), sizes[a], low[b])
            q, node = q[keep], node[keep]
            if depth:
                below = len(self.levels[depth - 1][1])
                child = (node[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                q = np.repeat(q, FANOUT)[child < below]
                node = child[child < below]
        return q, self.order[node]


def shared_counts(x: np.ndarray, y: np.ndarray, q: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Sums of coordinate minima of the pairs x[q], y[p]."""
    out, chunk = np.zeros(len(q), np.int64), max(1, 4_000_000 // x.shape[1])
    for k in range(0, len(q), chunk):
        out[k : k + chunk] = np.minimum(x[q[k : k + chunk]], y[p[k : k + chunk]]).sum(1, dtype=np.int64)
    return out


def tile_search(rows: dict, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers of the pairs that the trees let through, and the bound on their overlap by the sum of sizes. Sets that can link differ in size by a third at most, so
    their vectors have equally many groups or one twice as many: each number of groups has its tree, which also takes
    the next larger vectors, folded."""
    groups = np.fromiter(map(groups_of, rows["counts"]), np.int64, len(rows["cid"]))
    found = []
    for g in np.unique(groups[groups > 0]).tolist():
        mine = (groups == g) | (groups == 2 * g)
        x, y = left[mine[left]], right[mine[right]]
        if not len(x) or not len(y) or not ((groups[x] == g).any() or (groups[y] == g).any()):
            continue
        at, where = np.unique(np.concatenate([x, y]), return_inverse=True)
        vectors = folded([rows["counts"][k] for k in at.tolist()], g)
        size, root = rows["n"], rows["root"]
        of_x, of_y = vectors[where[: len(x)]], vectors[where[len(x) :]]
        q, p = CountTree(of_y, size[y], root[y]).search(of_x, size[x], root[x])
        once = (groups[x[q]] == g) | (groups[y[p]] == g)
        q, p = q[once], p[once]
        a, b = x[q], y[p]
        found.append((a, b, shared_counts(of_x, of_y, q, p) / (size[a] + size[b])))
    for side, other in ((left, right), (right, left)):  # vectors that bound nothing meet all rows of the tile
        for k in side[groups[side] == 0].tolist():
            may = other[rows["root"][other] != rows["root"][k]]
            found.append((np.full(len(may), k), may, np.ones(len(may))))
    a, b, bound = zip(*found, strict=True) if found else ((left[:0],), (left[:0],), (np.zeros(0),))
    return np.concatenate(a), np.concatenate(b), np.concatenate(bound)


def tile_pairs(rows: dict) -> tuple[np.ndarray, np.ndarray]:
    """Candidate pairs (smaller cid first) of one tile, without those of an earlier frequent shingle in common, and
    their bounds."""
    cid, half = rows["cid"], rows["half"]
    whole = not half.any()
    left = np.arange(len(cid)) if whole else np.flatnonzero(half < 0)
    right = left if whole else np.flatnonzero(half > 0)
    a, b, bound = tile_search(rows, left, right)
    if len(a) and any(len(x) for x in rows["earlier"]):
        sizes = np.fromiter(map(len, rows["earlier"]), np.int64, len(cid))
        tokens = np.unique(np.concatenate(rows["earlier"]), return_inverse=True)[1]
        holds = np.zeros((len(cid), tokens.max() + 1), bool)
        holds[np.repeat(np.arange(len(cid)), sizes), tokens] = True
        fresh = np.zeros(len(a), bool)
        for k in range(0, len(a), 20_000):
            fresh[k : k + 20_000] = ~(holds[a[k : k + 20_000]] & holds[b[k : k + 20_000]]).any(1)
        a, b, bound = a[fresh], b[fresh], bound[fresh]
    pairs, at = np.unique(np.stack([np.minimum(cid[a], cid[b]), np.maximum(cid[a], cid[b])], 1), axis=0, return_index=True)
    return pairs, bound[at]


def tree_pairs(members: DataFrame) -> DataFrame:
    """Pairs from tiles; members: token, tile (i, j), cid, root, n, counts, half (-1, 0, 1: the tile's side, 0 where
    the tile is one part with itself), earlier. A tile's rows come together, its size is bounded by ``TILE``."""
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["token", "i", "j"]
    dealt = members.repartition(parts, *keys).sortWithinPartitions(*keys)

    def rows_of(batch) -> dict:
        rows = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in (*keys, "cid", "root", "n", "half")}
        rows["counts"] = batch.column("counts").to_pylist()
        rows["earlier"] = [np.array(x or [], np.int64) for x in batch.column("earlier").to_pylist()]
        return rows

    def run(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
            batch = table.to_batches()[0] if table.num_rows else batch
            rows = rows_of(batch)
            change = np.flatnonzero(np.any([np.diff(rows[k]) != 0 for k in keys], axis=0)) + 1
            cuts = np.append(0, change)
            for x, y in zip(cuts, cuts[1:], strict=False):
                yield from emit({k: v[x:y] for k, v in rows.items()})
            held = batch.slice(int(cuts[-1]))
        if held is not None and held.num_rows:
            yield from emit(rows_of(held))

    def emit(rows: dict):
        if len(rows["cid"]) > 1:
            pairs, bound = tile_pairs(rows)
            if len(pairs):
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), pa.array(bound)], ["a", "b", "bound"])

    return dealt.mapInArrow(trimmed(run), "a long, b long, bound double")


def tree_links(docs: DataFrame, profiles: DataFrame, pairs: DataFrame, n_words: int) -> DataFrame:
    """Links (a, b) of candidate ``pairs`` (a, b, bound) that join all classes which any of the pairs join.

    While the pairs are many for their classes, the best pair of each class is verified, and pairs inside the
    components so found go unchecked. A round that spares less than half of the pairs is the last of its kind.
    """
    found = []
    while True:
        ends = pairs.select("a").union(pairs.select("b"))
        n, classes = pairs.count(), ends.distinct().count()
        if n <= DENSE * classes:
            break
        both = pairs.select("a", "b", "bound").union(pairs.select("b", "a", "bound"))
        best = both.groupBy("a").agg(F.max_by("b", F.struct("bound", "b")).alias("b"))
        best = written(best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "best-pairs")
        found.append(verified(docs, profiles, best, n_words))
        roots = components(found[0] if len(found) == 1 else reduce(DataFrame.union, found))
        rest = pairs.join(best, ["a", "b"], "left_anti")
        for side in "ab":
            named = roots.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}"))
            rest = rest.join(named, side, "left").withColumn(f"root_{side}", F.coalesce(f"root_{side}", side))
        pairs = written(rest.where("root_a <> root_b").select("a", "b", "bound"), "tree-pairs")
        if 2 * pairs.count() > n:
            break
    found.append(verified(docs, profiles, pairs.select("a", "b"), n_words))
    return reduce(DataFrame.union, found)


def tiles(blocks: DataFrame, sizes: DataFrame) -> DataFrame:
    """Members of blocks dealt to tiles: a block of m members has ceil(m / TILE) parts, a tile for each two of them."""
    joined = blocks.join(sizes, "token").withColumn("parts", F.ceil(F.col("m") / TILE).cast("int"))
    part = F.pmod(F.xxhash64("cid"), F.col("parts")).cast("int")
    dealt = joined.withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    side = F.when(F.col("part") == F.col("other"), 0).when(F.col("part") < F.col("other"), -1).otherwise(1)
    return dealt.select("*", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), side.cast("int").alias("half"))


# ---- the join -------------------------------------------------------------------------------------------
def link_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_words: int = WORDS, key_col: str | None = None
) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``n_shingles`` (set size), ``component_id`` (smallest id that links
    reach, the row's own included). With ``key_col`` also that column and ``component``, a number of the component
    that no other has, also where ids repeat or are null."""
    own = [F.col(key_col).alias("key")] if key_col else []
    keyed = docs.select(F.col(id_col).alias("id"), as_bytes(text_col).alias("t"), *own)
    source = keyed.select("id", "t")
    profiles = written(profile_table(keyed, frequent_shingles(source, n_words), n_words), "profiles")
    classes = profiles.where("n > 0").groupBy("d1", "d2").agg(F.min("uid").alias("cid"), F.min("id").alias("first_id"))
    classes = written(classes, "classes")

    # blocks, and the pivot of each sub-block; equal sets have equal shingles and salts, so the pivot of a sub-block,
    # its smallest uid, is a class's first row, and other rows of a class can go afterwards
    salt = F.pmod(F.col("d1"), F.lit(SALTS)) + 1
    tokens = profiles.select("uid", "n_light", salt.alias("salt"), F.posexplode("prefix").alias("pos", "token"))
    side = F.when(F.col("pos") >= F.col("n_light"), F.col("salt")).otherwise(0)
    tokens = tokens.select("token", "uid", (F.shiftleft(side, 40) + F.col("pos")).alias("info"))
    of = Window.partitionBy("token", F.shiftright("info", 40))
    tokens = tokens.withColumn("k", F.count("*").over(of)).withColumn("pivot", F.min("uid").over(of))
    tokens = tokens.withColumn("frequent", F.shiftright("info", 40) > 0).where("k > 1 OR frequent")
    tokens = tokens.select("token", F.col("uid").alias("cid"), F.col("info").bitwiseAND((1 << 40) - 1).cast("int").alias("pos"), "frequent", "pivot")
    shared = written(tokens.join(classes.select("cid"), "cid", "left_semi"), "shared")

    own = shared.where("cid <> pivot").select(F.col("cid").alias("a"), F.col("pivot").alias("b"))
    tops = shared.where("frequent").select("token", F.col("pivot").alias("a")).distinct()
    top = tops.groupBy("token").agg(F.min("a").alias("b"))
    between = tops.join(top, "token").where("a <> b").select("a", "b")
    found = verified(source, profiles, bounded(profiles, own.union(between).distinct()), n_words)
    roots = components(found)

    # what is still apart inside a block
    labelled = shared.join(roots, F.col("cid") == F.col("node"), "left").select("token", "cid", "pos", "frequent", F.coalesce("root", "cid").alias("root"))
    labelled = written(labelled, "labelled")
    seen = [F.bit_xor(F.xxhash64("cid", F.lit(k))).alias(f"x{k}") for k in (1, 2)]
    blocks = labelled.groupBy("token").agg(F.count("*").alias("m"), F.max("frequent").alias("hot"), F.min("root").alias("r1"), F.max("root").alias("r2"), *seen)
    # a block of two had its only pair checked with the pivot; of blocks with the same members one is enough
    apart = blocks.where("r1 <> r2 AND (m > 2 OR hot)")
    light = apart.where("NOT hot").groupBy("m", "x1", "x2").agg(F.min("token").alias("token")).select("token", "m")
    sizes = written(apart.where("hot").select("token", "m").union(light), "blocks")
    members = tiles(labelled, sizes)
    about = profiles.select("uid", "n", "counts", "n_light", "prefix")
    members = members.join(about, F.col("cid") == F.col("uid"))
    earlier = F.when(F.col("frequent") & (F.col("pos") > F.col("n_light")), F.slice("prefix", F.col("n_light") + 1, F.col("pos") - F.col("n_light")))
    members = members.select("token", "i", "j", "cid", "root", "n", "counts", "half", earlier.alias("earlier"))
    pairs = written(tree_pairs(members).groupBy("a", "b").agg(F.max("bound").alias("bound")), "tree-pairs")
    more = tree_links(source, profiles, pairs, n_words)
    # the components found before are stars already, so few rounds are left
    stars = roots.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
    roots = written(components(stars.union(more)), "components")

    # smallest id of each component, then of each row
    named = classes.join(roots, F.col("cid") == F.col("node"), "left").select("d1", "d2", "first_id", F.coalesce("root", "cid").alias("root"))
    smallest = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_class = named.join(smallest, "root").select(F.col("d1").alias("c1"), F.col("d2").alias("c2"), "component_id", "root")
    same = (F.col("d1") == F.col("c1")) & (F.col("d2") == F.col("c2")) & (F.col("n") > 0)
    extra = ["uid", "key"] if key_col else []
    out = profiles.select("id", "n", "d1", "d2", *extra).join(of_class, same, "left")
    more = [F.col("key").alias(key_col), F.coalesce("root", "uid").alias("component")] if key_col else []
    component_id = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component_id, *more)
