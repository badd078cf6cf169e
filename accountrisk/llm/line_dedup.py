"""Lines that many documents share, found in one sorted stream of line hashes; keep bitmaps instead of texts.

Method. Every document gives one record per distinct line key: the key's 128-bit hash, the document and the places of
its lines. Records are range-partitioned by hash, document and digest and sorted so within partitions: the records of a
hash stand together, its first occurrence first, and a hash that a third of all documents hold is spread over
partitions by document. A task streams its records and holds at most ``min_docs`` of a run of equal hashes; from the
record on that reaches ``min_docs``, decisions go out at once. Only the first and the last run of a partition may go
on in another one: such a run leaves its count and the records it still holds, which the summed counts (two rows a
partition) settle. Dropped places are gathered per document into deflated bitmaps; texts are not shuffled for that.

Rows equal in id and text are one record with a count, so copies of a row meet nowhere; each counts as a document.
Keys of equal 128-bit hash are taken to be equal.

Defined cases. A null or empty text is one empty line. White space alone gives the empty key, which is never dropped.
Rows are told apart by id and text together, so null and repeated ids do no harm. There are no ties: records differ in
hash, id or digest. Empty table: no rows. Extra columns stay; columns named like an output are replaced.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from accountrisk.llm.common import as_bytes, steps
from accountrisk.session import written

#: White space of the contract, stripped at both ends of a line.
BLANKS = b" \t\n\x0b\x0c\r"
OUTPUTS = ("n_lines", "n_dropped", "keep_bits")


def row_digest(id_col: str, text_col: str) -> Column:
    """Digest of id and text, equal for rows equal in both only."""
    name = F.coalesce(F.concat(F.lit("i"), F.col(id_col).cast("string")), F.lit("n"))
    kind = F.when(F.col(text_col).isNull(), "n").otherwise("t")
    return F.unhex(F.md5(F.concat(F.concat_ws("\n", name, kind, F.lit("")).cast("binary"), as_bytes(text_col))))


def keys_of(text: bytes) -> list[bytes]:
    """The key of each line; ``bytes.lower`` changes A-Z alone."""
    return [line.strip(BLANKS) for line in text.lower().split(b"\n")]


def record_schema(id_type: T.DataType) -> T.StructType:
    """A key's hash, a document, and the places of the key's lines in it."""
    return (
        T.StructType()
        .add("high", "long").add("low", "long").add("id", id_type).add("digest", "binary").add("places", T.ArrayType(T.IntegerType()))
    )


def line_records(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """One record per document and distinct key of at least ``min_chars`` code points."""
    texts = docs.select(F.col(id_col).alias("id"), row_digest(id_col, text_col).alias("digest"), as_bytes(text_col).alias("text"))
    schema = record_schema(docs.schema[id_col].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, "text"):
                hashes, owners, places, ends = [], [], [], [0]
                for row, text in enumerate(part.column("text").to_pylist()):
                    found: dict[bytes, list[int]] = {}
                    for place, key in enumerate(keys_of(text)):
                        if key:
                            found.setdefault(key, []).append(place)
                    for key, at in found.items():
                        if min_chars <= 1 or len(key.decode("utf-8", "replace")) >= min_chars:
                            hashes.append(hashlib.blake2b(key, digest_size=16).digest())
                            owners.append(row)
                            places += at
                            ends.append(len(places))
                halves = np.frombuffer(b"".join(hashes), np.int64).reshape(-1, 2)
                owner = pa.array(owners, pa.int64())
                columns = [
                    pa.array(np.ascontiguousarray(halves[:, 0])),
                    pa.array(np.ascontiguousarray(halves[:, 1])),
                    part.column("id").take(owner),
                    part.column("digest").take(owner),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(places, pa.int32())),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return texts.mapInArrow(run, schema)


class _Run:
    """A run of equal hashes within one partition: its first record, and others until it is known to be frequent."""

    def __init__(self, key: tuple[int, int], border: bool, lead: tuple):
        self.key, self.border, self.lead, self.n, self.held = key, border, lead, 0, []

    def close(self, last: bool, min_docs: int) -> Iterator[tuple]:
        if self.border or last:
            yield "edge", *self.key, None, None, self.n
            yield "open lead", *self.key, *self.lead, 0
            for record in self.held:
                yield "open", *self.key, *record, 0
        elif self.n >= min_docs:
            yield "lead", *self.key, *self.lead, 0


def stream_runs(records: Iterator[tuple], min_docs: int) -> Iterator[tuple]:
    """Events (kind, high, low, digest, places, n) of the sorted records (high, low, digest, places, n) of a partition.

    ``drop``: lines of a frequent key; ``lead``: the same for the record that leads the run; ``open`` and ``open
    lead``: the same if the border run proves frequent; ``edge``: documents of a border run in this partition.
    """
    run: _Run | None = None
    for high, low, digest, places, n in records:
        if run is None or run.key != (high, low):
            if run:
                yield from run.close(False, min_docs)
            run = _Run((high, low), run is None, (digest, places))
        else:
            run.held.append((digest, places))
        run.n += n
        if run.n >= min_docs:
            for record in run.held:
                yield "drop", high, low, *record, 0
            run.held = []
    if run:
        yield from run.close(True, min_docs)


def line_events(records: DataFrame, min_docs: int) -> DataFrame:
    schema = (
        T.StructType()
        .add("part", "integer").add("kind", "string").add("high", "long").add("low", "long")
        .add("digest", "binary").add("places", T.ArrayType(T.IntegerType())).add("n", "long")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()

        def rows() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)

        def batch_of(events: list[tuple]) -> pa.RecordBatch:
            columns = zip(*events, strict=True)
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int32()), pa.int64())
            arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]
            return pa.RecordBatch.from_arrays([pa.array([part] * len(events), pa.int32()), *arrays], schema.names)

        events = []
        for event in stream_runs(rows(), min_docs):
            events.append(event)
            if len(events) == 10_000:
                yield batch_of(events)
                events = []
        if events:
            yield batch_of(events)

    order = ["high", "low", "id", "digest"]
    spread = records.repartitionByRange(*order).sortWithinPartitions(*order)
    return spread.select("high", "low", "digest", "places", "n").mapInArrow(run, schema)


def deflated(bits: np.ndarray) -> bytes:
    return zlib.compress(np.packbits(bits, bitorder="little").tobytes(), 1)


def inflated(data: bytes | None, size: int) -> np.ndarray:
    """The first ``size`` bits; bits that were not stored are 0."""
    bits = np.zeros(size, np.uint8)
    if data:
        stored = np.unpackbits(np.frombuffer(zlib.decompress(data), np.uint8), bitorder="little")[:size]
        bits[: stored.size] = stored
    return bits


def repeated_lines(
    docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep_first: bool = False, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(digest, drop_bits): per document with dropped lines a deflated bitmap of their places.

    Keys of at least ``min_chars`` code points found in at least ``min_docs`` documents lose their lines; with
    ``keep_first`` the first line of the first document, in the order of ids and digests, stays.
    """
    records = line_records(docs, id_col, text_col, min_chars).groupBy("high", "low", "id", "digest")
    records = written(records.agg(F.any_value("places").alias("places"), F.count("*").alias("n")), "line-records")
    events = written(line_events(records, min_docs), "line-events")
    edges = events.where("kind = 'edge'").groupBy("high", "low").agg(F.sum("n").alias("n"), F.min("part").alias("first_part"))
    # at most two rows a partition
    frequent = F.broadcast(edges.where(F.col("n") >= min_docs).drop("n"))
    settled = events.where("kind IN ('open', 'open lead')").join(frequent, ["high", "low"])
    leads = (F.col("kind") == "open lead") & (F.col("part") == F.col("first_part"))
    dropped = events.where("kind IN ('drop', 'lead')").select("digest", "places", (F.col("kind") == "lead").alias("leads"))
    dropped = dropped.union(settled.select("digest", "places", leads))
    if keep_first:
        dropped = dropped.withColumn("places", F.when(F.col("leads"), F.slice("places", 2, F.size("places"))).otherwise(F.col("places")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            maps = []
            for lists in batch.column(1).to_pylist():
                at = np.concatenate([np.asarray(x, np.int64) for x in lists])
                bits = np.zeros(int(at.max()) + 1 if at.size else 0, np.uint8)
                bits[at] = 1
                maps.append(deflated(bits))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(maps, pa.binary())], ["digest", "drop_bits"])

    # the records of one document: no more than it has lines
    per_document = dropped.groupBy("digest").agg(F.collect_list("places").alias("lists"))
    return per_document.mapInArrow(run, "digest binary, drop_bits binary")


def with_keep_bitmaps(docs: DataFrame, drops: DataFrame, text_col: str = "text", id_col: str = "doc_id", with_text: bool = False) -> DataFrame:
    """``docs`` with ``n_lines``, ``n_dropped`` and ``keep_bits`` (deflated, one bit a line, lowest first); the text is
    left out, or with ``with_text`` replaced by its kept lines."""
    own = "__line_digest", "__drop_bits"
    base = docs.drop(*OUTPUTS, *own)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keyed = base.withColumn(own[0], row_digest(id_col, text_col)).withColumn(text_col, text)
    if not with_text:
        keyed = keyed.withColumn(text_col, F.regexp_replace(F.col(text_col), "[^\n]+", ""))
    joined = keyed.join(drops.select(F.col("digest").alias("__d"), F.col("drop_bits").alias(own[1])), F.col(own[0]) == F.col("__d"), "left")
    joined = joined.select(*base.columns, own[1])
    at = base.columns.index(text_col)
    out = joined.drop(own[1]).withColumns({"n_lines": F.lit(0).cast("long"), "n_dropped": F.lit(0).cast("long"), "keep_bits": F.lit(b"")})
    names = out.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, batch.schema.names[at]):
                lines, dropped, maps, texts = [], [], [], []
                for text_, drop in zip(part.column(at).to_pylist(), part.column(part.num_columns - 1).to_pylist(), strict=True):
                    n = text_.count("\n") + 1
                    bits = inflated(drop, n)
                    lines.append(n)
                    dropped.append(int(bits.sum()))
                    maps.append(deflated(1 - bits))
                    if drop is None or not dropped[-1]:
                        texts.append(text_)
                    else:
                        texts.append("\n".join(line for line, gone in zip(text_.split("\n"), bits.tolist(), strict=True) if not gone))
                columns = [*part.columns[:-1], pa.array(lines, pa.int64()), pa.array(dropped, pa.int64()), pa.array(maps, pa.binary())]
                columns[at] = pa.array(texts, part.schema.field(at).type)
                yield pa.RecordBatch.from_arrays(columns, names)

    done = joined.mapInArrow(run, out.schema)
    return done if with_text else done.drop(text_col)


def drop_repeated_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep_first: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the kept lines as text, joined by line feeds, and the columns of :func:`with_keep_bitmaps`."""
    drops = repeated_lines(docs, min_docs, min_chars, keep_first, id_col, text_col)
    return with_keep_bitmaps(docs, drops, text_col, id_col, with_text=True)
