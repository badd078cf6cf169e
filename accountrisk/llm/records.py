"""Token sequences in length-delimited binary records, with an offset index for shuffled reads.

A shard is a file of frames, each

    payload length (uint64) | masked checksum of those 8 bytes (uint32) | payload | masked checksum of the payload

all little-endian. The payload is one byte, the width of an id in bytes (2 while the vocabulary allows it, else 4),
and the ids. Beside each shard stands ``<shard>.idx``: per record the id of its row and whether it
has one, the byte offset of its frame, the byte length of the frame and the number of ids, five int64. The checksum is CRC-32, masked by a rotation and a constant so that
a checksum of stored checksums does not degenerate.

Rows are dealt by ranges of the id, ties by the text, then by their place in the input, so that equal ids may span
shards; a task writes its range in order into shards of bounded size. Files carry the attempt in their names and
become part of the data set only by the manifest, a Parquet table that Spark commits: what a lost or repeated
attempt left behind is never read.

Cases: null and empty texts give a record that holds the end id only; rows with a null id come first; repeated rows
give repeated records; an empty table gives no shard; other columns are not stored.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import WhitespaceSplit

from accountrisk.llm.bpe import TEXT_BYTES, BpeEncoder, kept, tables_of, white_space_split
from accountrisk.llm.common import list_array, steps
from accountrisk.session import written

SHARD_BYTES = 64_000_000
JOINED = 400  # words given to the library in one text
MEMO_BYTES = 32_000_000  # texts and ids that a memo of a worker holds before it starts anew
MASK_DELTA = 0xA282EAD8  # fixed value of the record format
INDEX_ROW = np.dtype([("key", "<i8"), ("has_key", "<i8"), ("offset", "<i8"), ("bytes", "<i8"), ("ids", "<i8")])
#: Schemes that tasks open, by the name that Arrow knows them by.
SCHEMES = {"file": "file", "hdfs": "hdfs", "viewfs": "viewfs", "s3": "s3", "s3a": "s3", "gs": "gs", "abfs": "abfs", "abfss": "abfss"}
MANIFEST = "range_no int, file_no int, path string, records long, ids long, bytes long"


class CorruptRecord(ValueError):
    """A frame whose lengths or checksums do not hold."""


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join([length, struct.pack("<I", masked(length)), payload, struct.pack("<I", masked(payload))])


def unframed(data: bytes) -> bytes:
    """The payload of one frame."""
    if len(data) < 16 or struct.unpack_from("<I", data, 8)[0] != masked(data[:8]):
        raise CorruptRecord("length checksum")
    (size,) = struct.unpack_from("<Q", data)
    if size != len(data) - 16 or struct.unpack_from("<I", data, 12 + size)[0] != masked(data[12 : 12 + size]):
        raise CorruptRecord("payload checksum")
    return data[12 : 12 + size]


def ids_of(payload: bytes) -> np.ndarray:
    return np.frombuffer(payload, "<u2" if payload[0] == 2 else "<u4", offset=1)


def shared_folder(spark: SparkSession, folder: str) -> str:
    """The folder, made, with the scheme of the driver's file system, so that tasks open the same place by it.
    Schemes that tasks cannot open are refused."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    full = system.makeQualified(path).toString()
    scheme = full.partition(":")[0]
    if scheme not in SCHEMES:
        raise ValueError(f"tasks cannot write to {full}: its scheme is none of {', '.join(sorted(SCHEMES))}")
    system.mkdirs(path)
    return full


def place(path: str) -> tuple[fs.FileSystem, str]:
    """(file system, path in it) of a path with its scheme."""
    scheme, _, rest = path.partition(":")
    if scheme not in SCHEMES:
        raise ValueError(f"no scheme that tasks can open: {path}")
    return fs.FileSystem.from_uri(f"{SCHEMES[scheme]}:{rest}")


class ShardWriter:
    """Writes the records of one task, a new file whenever the current one is full."""

    def __init__(self, folder: str, name: str, range_no: int, limit: int):
        self.folder, self.name, self.range_no, self.limit = folder, name, range_no, limit
        self.file_no, self.file, self.rows = 0, None, []

    def add(self, key: int | None, payload: bytes) -> tuple | None:
        """The manifest row of the file that this record has filled, if it has."""
        if self.file is None:
            self.path = f"{self.folder}/{self.name}-{self.file_no:05d}.rec"
            self.fs, self.local = place(self.path)
            self.file, self.rows, self.at = self.fs.open_output_stream(self.local), [], 0
        data = frame(payload)
        self.file.write(data)
        self.rows.append((key or 0, key is not None, self.at, len(data), (len(payload) - 1) // payload[0]))
        self.at += len(data)
        return self.close() if self.at >= self.limit else None

    def close(self) -> tuple | None:
        if self.file is None:
            return None
        self.file.close()
        rows = np.array(self.rows, INDEX_ROW)
        with self.fs.open_output_stream(self.local + ".idx") as index:
            index.write(rows.tobytes())
        self.file = None
        self.file_no += 1
        return self.range_no, self.file_no - 1, self.path, len(rows), int(rows["ids"].sum()), self.at


def gathered(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, picks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(flat, ends from 0) of the picked stretches, one after the other."""
    sizes = lengths[picks]
    ends = np.append(0, np.cumsum(sizes))
    return flat[np.arange(ends[-1]) + np.repeat(starts[picks] - ends[:-1], sizes)], ends


class ArrowMemo:
    """Ids of distinct texts, by a function that encodes those not met before; texts are held and looked up by Arrow, so
    that none becomes a Python object. Starts anew once it holds ``MEMO_BYTES``; that changes no result."""

    def __init__(self, encode_new):
        self.encode_new = encode_new
        self.clear()

    def clear(self) -> None:
        self.texts = pa.array([], pa.string())
        self.ids, self.ends = np.empty(0, np.int32), np.zeros(1, np.int64)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, ends from 0) of texts that differ from each other."""
        if self.texts.nbytes + self.ids.nbytes + self.ends.nbytes > MEMO_BYTES:
            self.clear()
        place = pc.index_in(texts, value_set=self.texts)
        known = place.is_valid().to_numpy(zero_copy_only=False)
        picks = place.fill_null(0).to_numpy().astype(np.int64)
        picks[~known] = len(self.texts) + np.arange(len(texts) - known.sum())
        if not known.all():
            new = texts.filter(place.is_null())
            ids, ends = self.encode_new(new)
            self.texts = pa.concat_arrays([self.texts, new])
            self.ids, self.ends = np.append(self.ids, ids), np.append(self.ends, self.ends[-1] + ends[1:])
        return gathered(self.ids, self.ends[:-1], np.diff(self.ends), picks)


class LibraryEncoder(BpeEncoder):
    """An encoder whose words are merged by the tokenizers library: white space, normal form and the split into words
    are done before, so that the library meets each distinct word once, many words in one call."""

    def __init__(self, spec: str):
        super().__init__(tables_of(json.loads(spec)))
        self.library = Tokenizer(Tokenizer.from_str(spec).model)
        self.library.pre_tokenizer = WhitespaceSplit()
        self.shown = np.array([ord(c) for c in self.tables["chars"]], "<u2")
        self.shown[ord("\n")] = ord(" ")  # no word has a line feed
        self.ends_word = np.array([t.endswith(self.tables["word_end"]) for t in self.tables["tokens"]])
        self.apart = pa.array(["\n", *self.tables["special"]], pa.string())
        self.special_ids = np.array(list(self.tables["special"].values()), np.int32)
        self.memo, self.word_memo = ArrowMemo(self.chunk_ids), ArrowMemo(self.word_ids)

    def word_ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        joined = pc.binary_join(list_array(words, np.array([0, len(words)])), "\n")[0]
        raw = np.frombuffer(joined.as_buffer(), np.uint8)
        text = self.shown[raw].tobytes().decode("utf-16-le")  # a character for each byte
        cuts = [0, *(np.flatnonzero(raw == ord("\n"))[JOINED - 1 :: JOINED] + 1).tolist(), len(text)]
        texts = [text[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        ids = np.concatenate([np.array(e.ids, np.int32) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)])
        return ids, np.append(0, np.flatnonzero(self.ends_word[ids]) + 1)

    def chunk_ids(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same of chunks; the words of a chunk end with a line feed, special tokens are words of their own."""
        coded = pa.array(self.pieces(chunks.to_pylist()), pa.string()).dictionary_encode()
        values, picks = coded.dictionary, coded.indices.to_numpy()
        apart = pc.index_in(values, value_set=self.apart)
        is_word = apart.is_null().to_numpy(zero_copy_only=False)
        apart = apart.fill_null(0).to_numpy()
        ids, ends = self.word_memo.encode(values.filter(pa.array(is_word)))
        starts, lengths = (ids.size + apart - 1).astype(np.int64), np.minimum(apart, 1).astype(np.int64)
        starts[is_word], lengths[is_word] = ends[:-1], np.diff(ends)
        flat, ends = gathered(np.append(ids, self.special_ids), starts, lengths, picks)
        line_feed = (~is_word & (apart == 0))[picks]
        return flat, np.append(0, ends[:-1][line_feed])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, offsets) of texts."""
        chunks, offsets = white_space_split(texts)
        coded = chunks.dictionary_encode()
        ids, ends = self.memo.encode(coded.dictionary)
        flat, ends = gathered(ids, ends[:-1], np.diff(ends), coded.indices.to_numpy())
        return flat, ends[offsets]


def write_records(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    folder: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """Encode the whole texts, append ``end_id`` and write them by ascending id below ``folder``, which all
    executors share. Returns the manifest, written below it too; its rows in (range_no, file_no) order are the
    data set's order."""
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as file:
        spec = spark.sparkContext.broadcast(file.read())
    folder = shared_folder(spark, folder)
    keys = [F.col("id").asc_nulls_first(), F.xxhash64("text"), F.col("nth")]
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), F.monotonically_increasing_id().alias("nth"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).select("id", "text")

    key = uuid.uuid4().hex

    def run(batches):
        context = TaskContext.get()
        writer = ShardWriter(folder, f"shard-{context.partitionId():06d}-{context.taskAttemptId()}", context.partitionId(), shard_bytes)
        encoder = kept(key, lambda: LibraryEncoder(spec.value))
        width = 2 if max(len(encoder.tables["tokens"]), end_id + 1) <= 1 << 16 else 4
        dtype = f"<u{width}"
        last = np.array([end_id], dtype).tobytes()
        done = []
        for batch in batches:
            for part in steps(batch, "text", TEXT_BYTES):
                flat, offsets = encoder.encode(part.column("text"))
                data, at = flat.astype(dtype).tobytes(), (offsets * width).tolist()
                head = bytes([width])
                keyed = zip(part.column("id").to_pylist(), at, at[1:], strict=False)
                done += [r for i, a, b in keyed if (r := writer.add(i, head + data[a:b] + last))]
        if r := writer.close():
            done.append(r)
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*done, strict=True)], [c.split()[0] for c in MANIFEST.split(", ")]).cast(
                pa.schema([("range_no", pa.int32()), ("file_no", pa.int32()), ("path", pa.string()), ("records", pa.int64()), ("ids", pa.int64()), ("bytes", pa.int64())])
            )

    return written(dealt.mapInArrow(run, MANIFEST), "records-manifest")


def with_starts(manifest: DataFrame) -> DataFrame:
    """The manifest with ``first_record`` and ``first_id``: records and ids in the shards before. One row a shard."""
    before = Window.orderBy("range_no", "file_no").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.select("*", *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(n) for c, n in (("records", "first_record"), ("ids", "first_id"))))


def read_records(manifest: DataFrame, id_col: str = "doc_id", with_ids: bool = True, shuffle_seed: int | None = None) -> DataFrame:
    """Read the shards back by their offset indexes, checking every checksum.

    Columns: ``record_no`` (place in the data set), the row's id, ``path``, ``offset``, ``start`` (ids before the record),
    ``n_tokens``, ``ids_crc32`` (of the ids as unsigned 32-bit little-endian integers) and, if asked for, ``ids``.
    With ``shuffle_seed`` a task reads its shard's records in a drawn order.
    """
    columns = f"record_no long, {id_col} long, path string, offset long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    shards = with_starts(manifest).select("path", "first_record", "first_id", "range_no", "file_no")
    parts = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = shards.repartition(parts, "range_no", "file_no")
    names = [c.split()[0] for c in columns.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())][: len(names)]

    def run(batches):
        for batch in batches:
            for shard in batch.to_pylist():
                system, local = place(shard["path"])
                with system.open_input_stream(local + ".idx") as file:
                    index = np.frombuffer(file.read(), INDEX_ROW)
                starts = shard["first_id"] + np.append(0, np.cumsum(index["ids"]))
                order = np.arange(len(index))
                if shuffle_seed is not None:
                    np.random.default_rng(shuffle_seed).shuffle(order)
                with system.open_input_file(local) as file:
                    for k in range(0, len(order), 2_000):
                        out = []
                        for n in order[k : k + 2_000].tolist():
                            file.seek(int(index["offset"][n]))
                            ids = ids_of(unframed(file.read(int(index["bytes"][n])))).astype("<u4")
                            if len(ids) != index["ids"][n]:
                                raise CorruptRecord("index")
                            key = int(index["key"][n]) if index["has_key"][n] else None
                            row = (shard["first_record"] + n, key, shard["path"], int(index["offset"][n]), int(starts[n]), len(ids), zlib.crc32(ids.tobytes()))
                            out.append((*row, ids.astype(np.int32)) if with_ids else row)
                        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names)

    return shards.mapInArrow(run, columns)
