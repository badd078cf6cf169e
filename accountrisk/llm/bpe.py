"""BPE encoding and decoding in batched numpy merge rounds.

The tokenizer file (``tokenizers`` JSON: NFC, lower case, a split pattern, byte symbols, word-end suffix)
is read once on the driver; its tables, whose size is that of the file, are broadcast.

Encoding works on white-space chunks: none of the file's steps looks across white space, so a chunk has the
same ids wherever it stands. Each task keeps a bounded memo of chunks. Words that the memo lacks are merged
together: the symbols of all of them lie in one flat array; every round looks up all adjacent pairs by binary
search over the sorted pair keys, finds the lowest rank of each word and merges that pair's occurrences from
the left. A later pair never outranks the pair that made one of its halves, so merging equal pairs of a word
in one round gives what merging one at a time gives.

Nulls encode as empty texts, empty texts as no ids. Rows are independent: repeated ids, ties and clashing
extra columns have no influence.
"""

from __future__ import annotations

import json
import uuid
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import unicodedata
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accountrisk.llm.common import list_array, steps, trimmed

#: Entries of a task's memo; at that size it starts anew, which changes no result.
MEMO_ENTRIES = 300_000
#: Text bytes encoded together: many, for fewer distinct chunks.
TEXT_BYTES = 8_000_000
#: Bytes that the memo of a worker that also decodes may hold, and text bytes and rows it works on at once.
MEMO_BYTES, STEP_TEXT_BYTES, STEP_ROWS = 64_000_000, 4_000_000, 500
NO_RANK = np.int64(1 << 40)


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself if visible, else the next one from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


def load_tables(path: str) -> dict:
    """What encoding and decoding need of a tokenizer file: plain arrays, lists and strings."""
    with open(path, encoding="utf-8") as file:
        return tables_of(json.load(file))


def tables_of(spec: dict) -> dict:
    """The same of the file's content."""
    model, end = spec["model"], spec["model"]["end_of_word_suffix"]
    vocab = model["vocab"]
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    left = np.array([vocab[a] for a, _ in model["merges"]], np.int64)
    right = np.array([vocab[b] for _, b in model["merges"]], np.int64)
    made = np.array([vocab[a + b] for a, b in model["merges"]], np.int64)
    keys = (left << 32) | right
    order = np.argsort(keys, kind="stable")
    tokens = {i: t for t, i in chain(vocab.items(), special.items())}
    pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
    chars = byte_characters()
    return {
        "keys": keys[order],
        "ranks": order.astype(np.int64),
        "made": made[order],
        "byte_ids": np.array([vocab[c] for c in chars], np.int64),
        "last_ids": np.array([vocab[c + end] for c in chars], np.int64),
        "chars": chars,
        "word_end": end,
        "tokens": [tokens.get(i, "") for i in range(max(tokens) + 1)],
        "special": special,
        "pattern": pattern,
    }


def merge_words(words: list[bytes], tables: dict) -> tuple[np.ndarray, np.ndarray]:
    """(flat ids, offsets) of non-empty words."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths)
    raw = np.frombuffer(b"".join(words), np.uint8)
    symbols = tables["byte_ids"][raw]
    symbols[ends - 1] = tables["last_ids"][raw[ends - 1]]
    owner = np.repeat(np.arange(len(words)), lengths)
    done_symbols, done_owner = [], []
    keys, ranks, made = tables["keys"], tables["ranks"], tables["made"]

    def look_up(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, what it makes) of the pairs that begin at those places."""
        pair = (symbols[at] << 32) | symbols[at + 1]
        k = np.minimum(np.searchsorted(keys, pair), keys.size - 1)
        found = (keys[k] == pair) & (owner[at] == owner[at + 1])
        return np.where(found, ranks[k], NO_RANK), made[k]

    rank, makes = np.full(symbols.size, NO_RANK), np.zeros(symbols.size, np.int64)
    rank[:-1], makes[:-1] = look_up(np.arange(symbols.size - 1))
    while symbols.size:
        first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        lowest = np.minimum.reduceat(rank, first)
        spread = np.repeat(lowest, np.diff(np.append(first, owner.size)))
        live = spread < NO_RANK
        if not live.all():
            done_symbols.append(symbols[~live])
            done_owner.append(owner[~live])
            symbols, owner, rank, makes, spread = symbols[live], owner[live], rank[live], makes[live], spread[live]
        if not symbols.size:
            break
        chosen = rank == spread
        # of pairs that overlap (a a a) the first, third, ... of the run are merged
        index = np.arange(chosen.size)
        starts = chosen & ~np.append(False, chosen[:-1])
        chosen &= (index - np.maximum.accumulate(np.where(starts, index, 0))) % 2 == 0
        where = np.flatnonzero(chosen)
        symbols[where] = makes[where]
        keep = np.ones(symbols.size, bool)
        keep[where + 1] = False
        symbols, owner, rank, makes = symbols[keep], owner[keep], rank[keep], makes[keep]
        # only the pairs on both sides of a merged symbol have changed
        merged = where - np.arange(where.size)
        touched = np.zeros(symbols.size, bool)
        touched[merged] = True
        touched[np.maximum(merged - 1, 0)] = True
        touched[-1] = False
        changed = np.flatnonzero(touched)
        rank[changed], makes[changed] = look_up(changed)
        if merged[-1] == symbols.size - 1:
            rank[-1] = NO_RANK
    symbols, owner = np.concatenate(done_symbols), np.concatenate(done_owner)
    order = np.argsort(owner, kind="stable")
    counts = np.bincount(owner, minlength=len(words))
    return symbols[order].astype(np.int32), np.append(0, np.cumsum(counts))


def white_space_split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(chunks between white space, offsets by text); an empty chunk has no ids. U+001C to U+001F, white space for
    Arrow, are none for the file's pattern: texts with them are split by that pattern."""
    texts = texts.fill_null("")
    if pc.any(pc.match_substring_regex(texts, "[\\x1c-\\x1f]")).as_py():
        lists = pa.array([regex.findall(r"[^\s]+", t) for t in texts.to_pylist()], pa.list_(pa.string()))
    else:
        lists = pc.utf8_split_whitespace(texts)
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    return lists.flatten(), np.append(0, np.cumsum(sizes))


class ChunkMemo:
    """Ids of white-space chunks, by a function that encodes the chunks not met before."""

    def __init__(self, encode_new):
        self.encode_new = encode_new
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.ids = np.empty(0, np.int32)
        self.starts = np.empty(0, np.int64)
        self.lengths = np.empty(0, np.int64)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, offsets) of texts. Arrow numbers the distinct chunks; only those meet the memo."""
        chunks, offsets = white_space_split(texts)
        coded = chunks.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        missing = [c for c in distinct if c not in self.index]
        if len(missing) + len(self.index) > MEMO_ENTRIES and self.index:
            self.clear()
            missing = distinct
        if missing:
            ids, ends = self.encode_new(missing)
            base = len(self.index)
            self.index.update(zip(missing, range(base, base + len(missing)), strict=True))
            self.starts = np.append(self.starts, self.ids.size + ends[:-1])
            self.lengths = np.append(self.lengths, np.diff(ends))
            self.ids = np.append(self.ids, ids)
        place = np.fromiter(map(self.index.__getitem__, distinct), np.int64, len(distinct))
        picks = place[coded.indices.to_numpy(zero_copy_only=False)] if len(distinct) else place
        lengths = self.lengths[picks]
        ends = np.append(0, np.cumsum(lengths))
        source = np.arange(ends[-1]) + np.repeat(self.starts[picks] - ends[:-1], lengths)
        return self.ids[source], ends[offsets]


class ByteBoundMemo(ChunkMemo):
    """A memo that starts anew once its chunks and ids take ``most`` bytes; that changes no result."""

    def __init__(self, encode_new, most: int = MEMO_BYTES):
        self.most = most
        super().__init__(lambda chunks: self.counted(encode_new, chunks))

    def clear(self) -> None:
        super().clear()
        self.held = 0

    def counted(self, encode_new, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, ends = encode_new(chunks)
        # a text object and its entry, the letters, ids and places
        self.held += 150 * len(chunks) + 2 * sum(map(len, chunks)) + ids.nbytes + 16 * len(chunks)
        return ids, ends

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if self.held > self.most:
            self.clear()
        return super().encode(texts)


_kept: dict[str, object] = {}


def kept(key: str, make):
    """The object of that key, made once in each Python worker; one object is held at a time."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


class BpeEncoder:
    """Encodes chunks; ``merge`` makes (flat ids, offsets) of words, by the merge rounds above if not given."""

    def __init__(self, tables: dict, merge=None):
        self.tables = tables
        self.merge = merge or (lambda words: merge_words(words, tables))
        self.words = regex.compile(tables["pattern"] + r"|\n")
        self.special = regex.compile("(" + "|".join(map(regex.escape, tables["special"])) + ")")
        self.memo = ChunkMemo(self.encode_chunks)

    def normal(self, text: str) -> str:
        # lower case goes by single characters: the final form of sigma has no part in it
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def pieces(self, chunks: list[str]) -> list[str]:
        """The words of all chunks in order, a line feed after each chunk; special tokens stay whole."""
        marked = [i for i, c in enumerate(chunks) if "<|" in c and self.special.search(c)]
        if not marked:
            return self.words.findall(self.normal("\n".join(chunks) + "\n"))
        words, done = [], 0
        for i in marked:
            if i > done:
                words += self.words.findall(self.normal("\n".join(chunks[done:i]) + "\n"))
            for piece in self.special.split(chunks[i]):
                words += [piece] if piece in self.tables["special"] else self.words.findall(self.normal(piece))
            words.append("\n")
            done = i + 1
        return words + self.words.findall(self.normal("".join(c + "\n" for c in chunks[done:])))

    def encode_chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        words = self.pieces(chunks)
        special = self.tables["special"]
        slots = {w: i for i, w in enumerate(dict.fromkeys(w for w in words if w != "\n" and w not in special))}
        ids, offsets = self.merge([w.encode() for w in slots]) if slots else (np.empty(0, np.int32), np.zeros(1, np.int64))
        starts = np.concatenate([offsets[:-1], ids.size + np.arange(len(special))])
        lengths = np.concatenate([np.diff(offsets), np.ones(len(special), np.int64)])
        ids = np.append(ids, np.array(list(special.values()), np.int32))
        slots |= {t: len(slots) + i for i, t in enumerate(special)} | {"\n": -1}
        picks = np.fromiter(map(slots.__getitem__, words), np.int64, len(words))
        is_word = picks >= 0
        owner = np.cumsum(~is_word)[is_word]
        picks = picks[is_word]
        sizes = lengths[picks]
        ends = np.append(0, np.cumsum(sizes))
        source = np.arange(ends[-1]) + np.repeat(starts[picks] - ends[:-1], sizes)
        counts = np.bincount(owner, weights=sizes, minlength=len(chunks)).astype(np.int64)
        return ids[source], np.append(0, np.cumsum(counts))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        return self.memo.encode(texts)


def encode(docs: DataFrame, tokenizer: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with ``ids_col`` (array of int), the ids of the whole text; a column of that name is replaced.

    ``tokenizer`` is the path of the tokenizer file on the driver.
    """
    tables = docs.sparkSession.sparkContext.broadcast(load_tables(tokenizer))
    base = docs.drop(ids_col)
    at = base.columns.index(text_col)

    key = uuid.uuid4().hex

    def run(batches):
        encoder = kept(key, lambda: BpeEncoder(tables.value))
        for batch in batches:
            for part in steps(batch, batch.schema.names[at], TEXT_BYTES):
                flat, offsets = encoder.encode(part.column(at))
                yield pa.RecordBatch.from_arrays([*part.columns, list_array(flat, offsets)], [*part.schema.names, ids_col])

    out = base.withColumn(text_col, F.col(text_col).cast("string"))
    return out.mapInArrow(run, out.withColumn(ids_col, F.lit(None).cast("array<int>")).schema)


def decoded_texts(tokens: pa.Array, flat: pa.Array, sizes: np.ndarray) -> pa.Array:
    """The tokens of each list of ids, joined by one space; ids outside the vocabulary give nothing."""
    known = pc.and_(pc.greater_equal(flat, 0), pc.less(flat, len(tokens)))
    picked = tokens.take(pc.if_else(known, flat, None))
    lists = list_array(picked, np.append(0, np.cumsum(sizes)))
    if picked.null_count:
        return pa.array([" ".join(t for t in x if t is not None) for x in lists.to_pylist()], pa.string())
    return pc.binary_join(lists, " ").cast(pa.string())


def encode_and_decode(
    docs: DataFrame, tokenizer: str, text_col: str = "text", ids_col: str = "ids", out_col: str = "decoded", keep_memo: bool = True
) -> DataFrame:
    """What :func:`encode` and then :func:`decode` give, in one pass: a worker holds the tables once.

    Without ``keep_memo`` a worker lets go of its memo and free memory after each task, for other work that it goes on with.
    """
    tables = docs.sparkSession.sparkContext.broadcast(load_tables(tokenizer))
    base = docs.drop(ids_col, out_col)
    at = base.columns.index(text_col)
    key = uuid.uuid4().hex

    def make():
        encoder = BpeEncoder(tables.value)
        encoder.memo = ByteBoundMemo(encoder.encode_chunks)
        return encoder, pa.array(tables.value["tokens"])

    def run(batches):
        encoder, tokens = kept(key, make)
        for batch in batches:
            for step in steps(batch, batch.schema.names[at], STEP_TEXT_BYTES):
                for start in range(0, step.num_rows, STEP_ROWS):
                    part = step.slice(start, STEP_ROWS)
                    flat, offsets = encoder.encode(part.column(at))
                    text = decoded_texts(tokens, pa.array(flat), np.diff(offsets))
                    yield pa.RecordBatch.from_arrays([*part.columns, list_array(flat, offsets), text], [*part.schema.names, ids_col, out_col])
        if not keep_memo:
            encoder.memo.clear()

    out = base.withColumn(text_col, F.col(text_col).cast("string"))
    return out.mapInArrow(run if keep_memo else trimmed(run), out.withColumns({ids_col: F.lit(None).cast("array<int>"), out_col: F.lit("")}).schema)


def decode(encoded: DataFrame, tokenizer: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``encoded`` with ``out_col``: the tokens of the ids, special ones too, joined by one space.

    The file names no decoder, so word ends and byte characters stay as they are in the vocabulary. Null ids
    decode to the empty text, ids outside the vocabulary to nothing.
    """
    tables = encoded.sparkSession.sparkContext.broadcast(load_tables(tokenizer)["tokens"])
    base = encoded.drop(out_col)
    at = base.columns.index(ids_col)

    def run(batches):
        tokens = pa.array(tables.value)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                column = part.column(at)
                sizes = pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False)
                text = decoded_texts(tokens, column.flatten(), sizes)
                yield pa.RecordBatch.from_arrays([*part.columns, text], [*part.schema.names, out_col])

    return base.mapInArrow(run, base.withColumn(out_col, F.lit("")).schema)
