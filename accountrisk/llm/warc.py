"""WARC archives: write captures of pages, read them back, and assemble the records of a capture.

Writing: each page becomes a request, a response or revisit, and a metadata record, each a gzip member of its own.
Of pages with equal payloads of at least ``MIN_REVISIT`` bytes the one with the smallest id is the response, the
others revisit it and carry no payload. Request and metadata name the response or revisit in WARC-Concurrent-To.
Files have a bounded size and the attempt in their names; only files in the committed list are data.

A revisit names the record id of the response, which is derived from page and digest, and its page beside it.

Reading: files are streamed member by member, so memory holds one record. Transactions: records meet by the
identifiers they are concurrent to, of which a record may name several. A primary record (response, revisit,
resource, conversion) names its capture; a record that a chain of links, in either direction, joins to a primary
record joins its capture.

Cases: a null html is an empty payload; empty payloads and short ones are responses always; null urls are empty;
repeated page ids stay apart, as captures of their own; rows with a null id are captures without an id, written as
responses; an empty table writes no file. A record that joins no capture is a capture with that record alone.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accountrisk.llm.common import as_bytes
from accountrisk.llm.records import place, shared_folder
from accountrisk.session import written

MIN_REVISIT = 100
FILE_BYTES = 64_000_000
DATE = "2024-01-01T00:00:00Z"  # the tables hold no capture time
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PRIMARY = ("response", "revisit", "resource", "conversion")


# ---- writing --------------------------------------------------------------------------------------------
def record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member."""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}"]
    raw = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def with_originals(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """(page_id, url, body, digest, original, first): ``original`` is the page that holds the payload, where it is
    another; ``first`` tells whether this row is the response that the others of its payload refer to."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("url"), as_bytes(html_col).alias("body"))
    # the place in the table matters only where the smallest id itself is repeated
    rows = rows.withColumn("digest", F.sha2("body", 256)).withColumn("nth", F.monotonically_increasing_id())
    heads = rows.where((F.length("body") >= MIN_REVISIT) & F.col("page_id").isNotNull()).groupBy(F.col("digest").alias("head_digest"))
    heads = heads.agg(F.min(F.struct("page_id", "nth")).alias("head"), F.count("*").alias("n")).where("n > 1").drop("n")
    joined = rows.join(heads, F.col("digest") == F.col("head_digest"), "left")
    other = F.col("page_id").isNotNull() & (F.col("head.page_id") != F.col("page_id"))
    first = F.coalesce((F.col("head.page_id") == F.col("page_id")) & (F.col("head.nth") == F.col("nth")), F.lit(False))
    return joined.select("page_id", "url", "body", "digest", F.when(other, F.col("head.page_id")).alias("original"), first.alias("first"))


def first_id(page, digest: str) -> str:
    """The record id of the response that holds a payload, which its revisits can tell without reading it."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page}:sha256:{digest}')}>"


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write the captures below ``folder``, which all executors share; returns the list (path, records, bytes)."""
    folder = shared_folder(pages.sparkSession, folder)
    # rows that share the smallest id of a payload are responses, all of them
    rows = with_originals(pages, id_col, url_col, html_col)

    def capture(page, url: str, body: bytes, digest: str, original, first: bool) -> list[bytes]:
        main, when = first_id(page, digest) if first else f"<urn:uuid:{uuid.uuid4()}>", ("WARC-Date", DATE)
        target = ("WARC-Target-URI", url.replace("\r", " ").replace("\n", " "))
        digest_ = ("WARC-Payload-Digest", f"sha256:{digest}")
        page_ = [] if page is None else [("X-Page-Id", str(page))]
        http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n".encode()
        about = [("WARC-Record-ID", main), when, target, digest_, *page_, ("Content-Type", "application/http; msgtype=response")]
        if original is None:
            answer = record("response", about, http + body)
        else:
            refers = [("WARC-Refers-To", first_id(original, digest)), ("X-Refers-To-Page", str(original))]
            answer = record("revisit", [*about, ("WARC-Profile", PROFILE), *refers], http)

        def beside(kind: str, content: str, block: bytes) -> bytes:
            own = [("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), when, target, ("WARC-Concurrent-To", main), ("Content-Type", content)]
            return record(kind, own, block)

        asked = beside("request", "application/http; msgtype=request", f"GET {target[1]} HTTP/1.1\r\n\r\n".encode())
        return [asked, answer, beside("metadata", "application/warc-fields", f"payload-bytes: {len(body)}\r\n".encode())]

    def run(batches):
        context, number, file, done, count, size = TaskContext.get(), 0, None, [], 0, 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "body", "digest", "original", "first")), strict=True):
                if file is None:
                    name = f"{folder}/captures-{context.partitionId():06d}-{context.taskAttemptId()}-{number:05d}.warc.gz"
                    system, local = place(name)
                    file, count, size = system.open_output_stream(local, compression=None), 0, 0
                for data in capture(*row):
                    file.write(data)
                    count, size = count + 1, size + len(data)
                if size >= FILE_BYTES:
                    file.close()
                    done.append((name, count, size))
                    file, number = None, number + 1
        if file is not None:
            file.close()
            done.append((name, count, size))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*done, strict=True)], ["path", "records", "bytes"])

    return written(rows.mapInArrow(run, "path string, records long, bytes long"), "warc-files")


# ---- reading --------------------------------------------------------------------------------------------
def members(stream, chunk: int = 1 << 20):
    """The gzip members of a stream, unpacked one at a time."""
    unpacker, parts, pending = zlib.decompressobj(31), [], b""
    while True:
        data = pending or stream.read(chunk)
        pending = b""
        if not data:
            if parts:
                raise ValueError("archive ends inside a record")
            return
        parts.append(unpacker.decompress(data))
        if unpacker.eof:
            yield b"".join(parts)
            pending, unpacker, parts = unpacker.unused_data, zlib.decompressobj(31), []


def parsed(raw: bytes) -> tuple[dict[str, list[str]], bytes]:
    """(values of each header, names in lower case; block) of a record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record")
    headers: dict[str, list[str]] = {}
    for line in lines[1:]:
        name, _, value = line.partition(":")
        headers.setdefault(name.strip().lower(), []).append(value.strip())
    return headers, rest[: int(headers["content-length"][0])]


RECORD = (
    "path string, offset_no long, record_id string, record_type string, concurrent_to array<string>, target_uri string, page_id string, "
    "refers_to string, refers_to_id string, stated_digest string, block_bytes long, payload_bytes long, payload_digest string"
)


def read_archives(files: DataFrame, with_payload: bool = False) -> DataFrame:
    """One row per record of the files (column ``path``), with the payload itself where asked for.

    ``payload_bytes`` and ``payload_digest`` are those of the full payload: of a response counted on what the archive
    holds, of a revisit as its headers state them. ``refers_to`` is the page and ``refers_to_id`` the record that a
    revisit repeats; ``concurrent_to`` has every value of its header.
    """
    columns = RECORD + ", payload binary" * with_payload
    names = [c.split()[0] for c in columns.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<string>": pa.list_(pa.string())}
    types = [kinds[c.split()[1]] for c in columns.split(", ")]
    parts = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def row(path: str, number: int, raw: bytes) -> tuple:
        headers, block = parsed(raw)

        def first(name: str) -> str | None:
            return headers.get(name, [None])[0]

        kind = first("warc-type")
        stated = (first("warc-payload-digest") or "").removeprefix("sha256:") or None
        http, _, payload = block.partition(b"\r\n\r\n") if kind in ("response", "revisit") else (b"", b"", block)
        size, digest = len(payload), None
        if kind == "response":
            digest = hashlib.sha256(payload).hexdigest()
        elif kind == "revisit":
            fields = dict(x.split(b": ", 1) for x in http.split(b"\r\n")[1:] if b": " in x)
            size, digest = int(fields.get(b"Content-Length", b"0")), stated
        out = (path, number, first("warc-record-id"), kind, headers.get("warc-concurrent-to", []), first("warc-target-uri"), first("x-page-id"))
        out += (first("x-refers-to-page"), first("warc-refers-to"), stated, len(block), size, digest)
        return (*out, payload) if with_payload else out

    def run(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                system, local = place(path)
                rows, held = [], 0
                with system.open_input_stream(local, compression=None) as stream:
                    for number, raw in enumerate(members(stream)):
                        rows.append(row(path, number, raw))
                        held += len(raw)
                        if held >= 8_000_000:
                            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    return files.select("path").repartition(parts, "path").mapInArrow(run, columns)


# ---- transactions ---------------------------------------------------------------------------------------
def captures_of(links: DataFrame) -> DataFrame:
    """(id, capture) of records that are not primary themselves and reach a primary one by links. A primary record
    that the record itself names comes first; then the shortest chain counts, links read both ways; ties go to the
    smallest id. ``links``: record_id, is_primary, concurrent_to (array).

    A round settles the records one link further away. Archives whose records all name a primary record need none.
    """
    primary = links.where("is_primary").select(F.col("record_id").alias("id")).distinct()
    waiting = links.where("NOT is_primary").select(F.col("record_id").alias("id")).distinct()
    stated = links.select(F.col("record_id").alias("a"), F.explode("concurrent_to").alias("b"), "is_primary")
    direct = stated.where("NOT is_primary").join(primary, F.col("b") == F.col("id"))
    settled = written(direct.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("capture")), "warc-settled")
    unsettled = written(waiting.join(settled, "id", "left_anti"), "warc-open")
    edges = written(stated.select("a", "b").union(stated.select("b", "a")).distinct(), "warc-edges") if not unsettled.isEmpty() else None
    frontier, further = primary.select("id", F.col("id").alias("capture")), settled
    while not (unsettled.isEmpty() or frontier.isEmpty()):
        found = edges.join(unsettled, F.col("a") == F.col("id"), "left_semi").join(frontier, F.col("b") == F.col("id"))
        found = written(found.groupBy(F.col("a").alias("id")).agg(F.min("capture").alias("capture")), "warc-settled")
        unsettled = written(unsettled.join(found, "id", "left_anti"), "warc-open")
        settled = settled.union(found)
        # records that name a primary one stand as far from it as those that it names
        frontier, further = found if further is None else found.union(further), None
    return settled


def transactions(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``capture_id``, ``main`` (the primary record), ``requests``, ``metadata`` and
    ``others`` (arrays of records, in archive order). ``concurrent_to`` may be a string or an array. A record without
    an id is a capture of its own. The records are written once and then read from that table."""
    records = written(records, "warc-records")
    fields = [c for c in records.columns if c != "capture_id"]
    to = F.col("concurrent_to")
    if records.schema["concurrent_to"].dataType.typeName() != "array":
        to = F.array(to)
    to = F.array_compact(F.coalesce(to, F.array().cast("array<string>")))
    is_primary = F.coalesce(F.col("record_type").isin(*PRIMARY), F.lit(False))
    links = records.where("record_id IS NOT NULL").select("record_id", is_primary.alias("is_primary"), to.alias("concurrent_to"))

    def said(targets):
        return F.coalesce(F.get(targets, F.lit(0)), F.col("record_id"))

    # most records join the capture that they name first; only the others are looked up
    claims = links.where("NOT is_primary").withColumn("said", said(F.col("concurrent_to"))).groupBy(F.col("record_id").alias("b_id"))
    claims = claims.agg(F.min("said").alias("least"), F.max("said").alias("most"))
    truth = claims.join(captures_of(links), F.col("b_id") == F.col("id"), "left").withColumn("capture", F.coalesce("capture", "b_id"))
    other = written(truth.where("capture <> least OR capture <> most").select("b_id", "capture"), "warc-other")
    unnamed = F.concat(F.lit("unnamed-"), F.monotonically_increasing_id().cast("string"))
    joined = records.withColumn("unnamed", unnamed).withColumn("said", said(to)).join(other, F.col("record_id") == F.col("b_id"), "left")
    own = F.when(is_primary, F.col("record_id")).otherwise(F.coalesce("capture", "said"))
    joined = joined.withColumn("capture_id", F.when(F.col("record_id").isNull(), F.col("unnamed")).otherwise(own))
    whole = F.struct(*fields)

    def listed(condition):
        return F.array_sort(F.collect_list(F.when(condition, whole)))

    kind = F.coalesce("record_type", F.lit(""))
    return joined.groupBy("capture_id").agg(
        F.min(F.when(is_primary, whole)).alias("main"),
        listed(kind == "request").alias("requests"),
        listed(kind == "metadata").alias("metadata"),
        listed(~is_primary & ~kind.isin("request", "metadata")).alias("others"),
    )
