"""WARC archives of pages: written as one gzip stream per file, normalised to one member per record, read by offset.

`write` gives an archive per task, the whole file one gzip stream, which only a reader from the start can use. `normalise` inflates each
such file once, from start to end, writes every record as a gzip member of its own and, beside the new archive, an index of
where each member begins. `read` opens members by that index. Files go through pyarrow's file systems, below a
folder that all executors reach; names hold the task attempt, and only files of attempts that ended well are listed, so
that lost executors and repeated tasks leave no wrong record.

Payload: the page's html in UTF-8. Of records with equal payloads of at least `least` bytes the one with the largest
page_id is a response, others are revisits that hold no payload and name the response.

Results for odd input: null html is an empty payload, like an empty html. Null url: the record has no target. A null page_id
is no largest one; where all are null, all are responses. Repeated rows that share the largest page_id are responses
all. Names or urls with line breaks are written percent-encoded. Empty table: no archives, no rows. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import urllib.parse
import uuid
import zlib

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import small_batches, small_enough, stored
from clickloom.session import fresh_dir

#: Fixed: the alphabet of RFC 4648 base 32.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CHUNK = 1 << 20
#: Bytes of members that a task reads, about.
RANGE = 16 << 20
#: Digests that repeat are broadcast up to this many rows, joined by shuffle beyond.
BROADCAST_ROWS = 300_000
RECORDS = ("archive string, offset long, length long, page_id long, url string, record_type string, payload_digest string, "
           "payload_bytes long, refers_to long, payload binary")


def base32_sha1(text: Column) -> Column:
    """The SHA-1 of a text as bare upper-case base 32: every five hex digits are four letters."""
    digits = F.sha1(text)
    parts = []
    for i in range(8):
        number = F.conv(F.substr(digits, F.lit(5 * i + 1), F.lit(5)), 16, 10).cast("int")
        parts += [F.substr(F.lit(BASE32), F.shiftright(number, 15 - 5 * j).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for j in range(4)]
    return F.concat(*parts)


def typed(pages: DataFrame, least: int = 0) -> DataFrame:
    """page_id, url, html (never null), payload_digest, record_type and refers_to of every page."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    pages = pages.withColumn("payload_digest", base32_sha1(F.col("html")))
    # Only payloads that occur twice need the largest id; their html is not shuffled for it.
    best = (pages.where(F.octet_length("html") >= least).groupBy("payload_digest")
            .agg(F.max("page_id").alias("_best"), F.count("*").alias("_n")).where("_n > 1"))
    best = stored(best.select(F.col("payload_digest").alias("_digest"), "_best"), "digests")
    best = F.broadcast(best) if small_enough(best, BROADCAST_ROWS) else best
    own = pages.join(best, F.col("payload_digest") == F.col("_digest"), "left")
    again = F.col("_best").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_best"))
    return own.select("page_id", "url", F.when(again, F.lit("")).otherwise(F.col("html")).alias("html"), "payload_digest",
                      F.when(again, "revisit").otherwise("response").alias("record_type"),
                      F.when(again, F.col("_best")).alias("refers_to"))


def _files(folder: str) -> tuple[pafs.FileSystem, str]:
    if "://" in folder or folder.startswith("file:"):
        return pafs.FileSystem.from_uri(folder)
    return pafs.LocalFileSystem(), folder


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def record(page_id: int | None, url: str | None, html: str, digest: str, kind: str, refers_to: int | None) -> bytes:
    """One WARC record: headers, an HTTP head, and the payload of a response."""
    payload = html.encode("utf-8", "surrogatepass")
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + payload
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_record_id(page_id, digest)}", "WARC-Date: 2024-01-01T00:00:00Z"]
    if url is not None:
        head.append(f"WARC-Target-URI: {urllib.parse.quote(url, safe=SAFE)}")
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if kind == "revisit":
        head += [f"WARC-Refers-To: {_record_id(refers_to, digest)}", f"X-Refers-To-Page-ID: {refers_to}",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    block_digest = base64.b32encode(hashlib.sha1(block).digest()).decode()
    head += [f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{block_digest}",
             "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8") + b"\r\n\r\n" + block + b"\r\n\r\n"


#: Characters of a url that are written as they are; line breaks and other controls are not.
SAFE = "".join(chr(i) for i in range(33, 127) if chr(i) != "%")


def write(pages: DataFrame, folder: str, level: int = 1) -> DataFrame:
    """Write typed pages below `folder`, a file of one gzip stream per task: (archive, records, bytes)."""
    def run(batches):
        task = TaskContext.get()
        fs, base = _files(folder)
        fs.create_dir(base, recursive=True)
        path = f"{base}/pages-{task.partitionId():06d}-{task.taskAttemptId()}.warc.gz"
        records = size = 0
        zip_ = zlib.compressobj(level, zlib.DEFLATED, 31)
        with fs.open_output_stream(path, compression=None) as out:
            for batch in batches:
                for row in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                    data = zip_.compress(record(*row))
                    size += out.write(data)
                    records += 1
            size += out.write(zip_.flush())
        yield pa.RecordBatch.from_pydict({"archive": [path], "records": [records], "bytes": [size]},
                                         schema=pa.schema([("archive", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))

    order = ["page_id", "url", "html", "payload_digest", "record_type", "refers_to"]
    return stored(pages.select(order).mapInArrow(run, "archive string, records long, bytes long"), "archives").where("records > 0")


def inflated(stream, chunk: int = CHUNK):
    """The inflated bytes of a gzip file of one or more members, in pieces of at most `chunk` bytes; a cut file is an error."""
    zip_, begun = zlib.decompressobj(31), False
    while data := stream.read(chunk):
        while True:
            begun = True
            piece = zip_.decompress(data, chunk)
            if piece:
                yield piece
            data = zip_.unconsumed_tail
            if zip_.eof:
                data = zip_.unused_data
                zip_, begun = zlib.decompressobj(31), False
                if not data:
                    break
            elif not data and len(piece) < chunk:
                break
    if begun:
        raise EOFError("the gzip stream is cut off")


def parsed(pieces):
    """Records of inflated bytes as (header bytes, iterator over the block's pieces); each iterator has to be used up."""
    pieces, buffer = iter(pieces), bytearray()

    def more() -> bool:
        piece = next(pieces, None)
        if piece is not None:
            buffer.extend(piece)
        return piece is not None

    def block(left: int):
        while left:
            if not buffer and not more():
                raise EOFError("a record is cut off")
            part = bytes(buffer[:left])
            del buffer[:len(part)]
            left -= len(part)
            yield part

    while True:
        while buffer[:2] == b"\r\n" or len(buffer) < 2:
            if buffer[:2] == b"\r\n":
                del buffer[:2]
            elif not more():
                if buffer:
                    raise EOFError("a record is cut off")
                return
        while (end := buffer.find(b"\r\n\r\n")) < 0:
            if not more():
                raise EOFError("a header is cut off")
        head = bytes(buffer[:end + 4])
        del buffer[:end + 4]
        yield head, block(int(fields(head)["content-length"]))


def fields(head: bytes) -> dict[str, str]:
    """Header fields by lower-case name."""
    lines = head.decode("utf-8").split("\r\n")[1:]
    return {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines if line)}


def normalise(archives: DataFrame, folder: str, level: int = 6) -> DataFrame:
    """Rewrite each archive with a member per record and a sidecar index: (archive, index, records)."""
    def run(batches):
        task = TaskContext.get()
        fs, base = _files(folder)
        fs.create_dir(base, recursive=True)
        for batch in batches:
            for source in batch.column(0).to_pylist():
                name = f"{base}/{source.rsplit('/', 1)[1].removesuffix('.warc.gz')}-{task.taskAttemptId()}"
                at = records = 0
                with (fs.open_input_stream(source, compression=None) as raw, fs.open_output_stream(f"{name}.norm.warc.gz", compression=None) as out,
                      fs.open_output_stream(f"{name}.index.jsonl") as index):
                    for head, block in parsed(inflated(raw)):
                        zip_, begin = zlib.compressobj(level, zlib.DEFLATED, 31), at
                        at += out.write(zip_.compress(head))
                        for part in block:
                            at += out.write(zip_.compress(part))
                        at += out.write(zip_.compress(b"\r\n\r\n") + zip_.flush())
                        own = fields(head)
                        index.write(json.dumps({"archive": f"{name}.norm.warc.gz", "offset": begin, "length": at - begin,
                                                "id": own["warc-record-id"], "type": own["warc-type"]}).encode() + b"\n")
                        records += 1
                yield pa.RecordBatch.from_pydict({"archive": [f"{name}.norm.warc.gz"], "index": [f"{name}.index.jsonl"], "records": [records]},
                                                 schema=pa.schema([("archive", pa.string()), ("index", pa.string()), ("records", pa.int64())]))

    # A number that is given is not coalesced: each archive has a task of its own.
    dealt = archives.select("archive").repartitionByRange(max(1, archives.count()), "archive")
    return stored(dealt.mapInArrow(run, "archive string, index string, records long"), "normal")


def read(normal: DataFrame, with_payload: bool = False) -> DataFrame:
    """The records of normalised archives, opened member by member through their indexes."""
    def offsets(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, at = _files(path)
                with fs.open_input_stream(at) as lines:
                    rows = [json.loads(x) for x in lines.read().splitlines()]
                yield pa.RecordBatch.from_pylist([{k: r[k] for k in ("archive", "offset", "length")} for r in rows],
                                                 schema=pa.schema([("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64())]))

    def run(batches):
        kind = pa.schema([("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("page_id", pa.int64()),
                          ("url", pa.string()), ("record_type", pa.string()), ("payload_digest", pa.string()),
                          ("payload_bytes", pa.int64()), ("refers_to", pa.int64()), ("payload", pa.binary())])
        open_, file = None, None
        try:
            for batch in batches:
                out, held = [], 0
                for row in batch.to_pylist():
                    if row["archive"] != open_:
                        if file:
                            file.close()
                        fs, path = _files(row["archive"])
                        open_, file = row["archive"], fs.open_input_file(path)
                    data = zlib.decompress(file.read_at(row["length"], row["offset"]), 31)
                    end = data.index(b"\r\n\r\n") + 4
                    own = fields(data[:end])
                    block = data[end:end + int(own["content-length"])]
                    payload = block[block.index(b"\r\n\r\n") + 4:]
                    response = own["warc-type"] == "response"
                    digest = own["warc-payload-digest"].removeprefix("sha1:")
                    if response and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                        raise ValueError(f"payload and digest differ at {row['offset']} of {row['archive']}")
                    number = lambda name: int(own[name]) if name in own else None
                    out.append({**row, "page_id": number("x-page-id"), "url": urllib.parse.unquote(own["warc-target-uri"]) if "warc-target-uri" in own else None,
                                "record_type": own["warc-type"], "payload_digest": digest, "payload_bytes": len(payload) if response else None,
                                "refers_to": number("x-refers-to-page-id"), "payload": payload if with_payload else None})
                    held += len(payload) if with_payload else 0
                    if held > 8 * CHUNK:
                        yield pa.RecordBatch.from_pylist(out, schema=kind)
                        out, held = [], 0
                yield pa.RecordBatch.from_pylist(out, schema=kind)
        finally:
            if file:
                file.close()

    spread = normal.select("index").repartitionByRange(max(1, normal.count()), "index")
    places = stored(spread.mapInArrow(offsets, "archive string, offset long, length long"), "places")
    # Tasks read ranges of about RANGE bytes, whichever archive these are in.
    size = places.agg(F.sum("length")).first()[0] or 0
    return places.repartitionByRange(size // RANGE + 1, "archive", "offset").sortWithinPartitions("archive", "offset").mapInArrow(run, RECORDS)


def archived(pages: DataFrame, least: int = 0, folder: str | None = None) -> DataFrame:
    """Write, normalise and read back: one row per page, the payload's size and digest resolved for revisits."""
    small_batches(pages.sparkSession)
    folder = folder or fresh_dir(pages.sparkSession, "warc")
    normal = normalise(write(typed(pages, least), f"{folder}/streams"), f"{folder}/members")
    rows = stored(read(normal).drop("payload"), "records")
    # A revisit has the size of its response, found by digest.
    sizes = rows.where("record_type = 'response'").groupBy(F.col("payload_digest").alias("_digest")).agg(F.max("payload_bytes").alias("_bytes"))
    sizes = sizes.join(rows.where("record_type = 'revisit'").select(F.col("payload_digest").alias("_digest")).distinct(), "_digest")
    return rows.join(sizes, rows["payload_digest"] == F.col("_digest"), "left").withColumn(
        "payload_bytes", F.coalesce("payload_bytes", "_bytes")).drop("_digest", "_bytes")
