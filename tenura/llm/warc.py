"""WARC archives: a writer with revisit records, and a sequential reader.

An archive is a sequence of gzip members, one for each record. Archives are kept as rows
(archive, chunk, data): the chunks of one archive, joined in order, are the bytes of a .warc.gz file.
`export_archives` writes them as such files.
"""

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenura.session import written_table

CHUNK = 256 * 1024
ARCHIVE = 64 << 20              # an archive that has grown to this size is closed
PIECE = 1 << 20                 # inflated at a time
CHUNKS = T.StructType([
    T.StructField("archive", T.LongType()), T.StructField("chunk", T.LongType()), T.StructField("data", T.BinaryType())])
RECORDS = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("uri", T.StringType()), T.StructField("record_type", T.StringType()),
    T.StructField("payload_digest", T.StringType()), T.StructField("payload_bytes", T.LongType()),
    T.StructField("refers_to", T.LongType()), T.StructField("payload", T.BinaryType()), T.StructField("problem", T.StringType())])
DATE = "2020-01-01T00:00:00Z"  # records carry no capture time of their own


def payload_roles(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, sha1, refers_to): among equal payloads of at least `min_bytes` bytes the largest page_id is
    the response and the others refer to it; refers_to is null for responses. Narrow rows only: payloads are
    hashed where they are read, and a payload that a third of all pages share is aggregated map-side."""
    narrow = pages.select("page_id", "sha1", "payload_bytes")
    first = (
        narrow.where(F.col("payload_bytes") >= min_bytes).groupBy("sha1")
        .agg(F.max("page_id").alias("response"), F.count("*").alias("n")).where("n > 1").select("sha1", "response")
    )
    other = ~F.col("page_id").eqNullSafe(F.col("response"))
    return (
        narrow.join(first, "sha1").where(F.col("response").isNotNull() & other)
        .select("page_id", "sha1", F.col("response").alias("refers_to")).distinct()
    )


def _clean(value: str | None) -> str:
    """A header value: line ends and other control characters would break the framing."""
    return "".join(c if c >= " " and c != "\x7f" else "%%%02X" % ord(c) for c in value or "")


def record(page_id: int | None, uri: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record; a revisit has no block."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    name = "none" if page_id is None else str(page_id)
    block = b"" if refers_to is not None else payload
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{name}>",
        f"WARC-Date: {DATE}", f"WARC-Target-URI: {_clean(uri)}", f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <urn:page:{refers_to}>"]
    else:
        head.append(f"WARC-Block-Digest: sha1:{digest}")
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """One gzip member."""
    press = zlib.compressobj(6, zlib.DEFLATED, 31)
    return press.compress(data) + press.flush()


def _write(archive_bytes: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    archive, chunk, held = TaskContext.get().partitionId() << 32, 0, bytearray()
    schema = pa.schema([("archive", pa.int64()), ("chunk", pa.int64()), ("data", pa.binary())])

    def row(data: bytes) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([archive]), pa.array([chunk]), pa.array([data])], schema=schema)

    for batch in batches:
        for k in range(batch.num_rows):
            page_id, uri, payload, refers_to = (c[k].as_py() for c in batch.columns)
            held += member(record(page_id, uri, payload, refers_to))
            while len(held) >= CHUNK:
                yield row(bytes(held[:CHUNK]))
                del held[:CHUNK]
                chunk += 1
            if chunk * CHUNK + len(held) >= archive_bytes:
                if held:
                    yield row(bytes(held))
                archive, chunk, held = archive + 1, 0, bytearray()
    if held:
        yield row(bytes(held))


def write_warc(pages: DataFrame, min_bytes: int = 0, archive_bytes: int = ARCHIVE) -> DataFrame:
    """Archives (archive, chunk, data) with one record for each row of `pages` (page_id, url, html).

    The payload is the html in UTF-8, null counts as empty. Repeated rows give a record each, all of the
    same type. A null page_id is never referred to and refers to the others like any page. An empty table
    gives no archive. Other columns are not read.

    An archive ends with the record that takes it to `archive_bytes`, so that many tasks share the reading;
    only a page that is longer itself makes a longer one.
    """
    payload = F.coalesce(F.encode(pages["html"].cast("string"), "UTF-8"), F.lit(b""))
    held = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("uri"),
                        payload.alias("payload"))
    held = held.withColumn("sha1", F.sha1("payload")).withColumn("payload_bytes", F.octet_length("payload"))
    # Written, so that pages are shuffled to meet their roles only where the revisits are too many to broadcast.
    roles = written_table(pages.sparkSession, payload_roles(held, min_bytes).select(
        F.col("page_id").alias("role_id"), F.col("sha1").alias("role_sha1"), "refers_to"))
    typed = held.join(roles, held["page_id"].eqNullSafe(roles["role_id"]) & (held["sha1"] == roles["role_sha1"]), "left")
    return typed.select("page_id", "uri", "payload", "refers_to").mapInArrow(lambda b: _write(archive_bytes, b), CHUNKS)


class RecordReader:
    """Feeds on an archive piece by piece and gives its records in order.

    Each gzip member is inflated as its bytes come, `PIECE` bytes at a time; headers end at an empty line, the
    block has as many bytes as Content-Length says and two line ends follow. Memory: one record and one piece,
    however far the bytes fed at once inflate. The block of the last record held is handed over uncopied.
    """

    def __init__(self):
        self.inflate, self.held, self.need = zlib.decompressobj(31), bytearray(), None
        self.inside = False  # of a gzip member
        self.head: dict[str, str] = {}

    def feed(self, data: bytes) -> Iterator[tuple[dict[str, str], bytearray]]:
        pending = False         # a full piece may leave more to inflate without more bytes
        while data or pending:
            piece = self.inflate.decompress(data, PIECE)
            self.held += piece
            self.inside = not self.inflate.eof
            yield from self._records()
            if self.inside:
                data, pending = self.inflate.unconsumed_tail, len(piece) == PIECE
                continue
            if self.held or self.need is not None:
                raise ValueError("a gzip member ends inside a record")
            data, pending = self.inflate.unused_data, False
            self.inflate = zlib.decompressobj(31)

    def close(self) -> None:
        if self.inside or self.held or self.need is not None:
            raise ValueError("the archive ends inside a record")

    def _records(self) -> Iterator[tuple[dict[str, str], bytearray]]:
        while True:
            if self.need is None:
                end = self.held.find(b"\r\n\r\n")
                if end < 0:
                    return
                first, *lines = bytes(self.held[:end]).decode().split("\r\n")
                if not first.startswith("WARC/"):
                    raise ValueError("not a WARC record")
                self.head = dict(line.split(": ", 1) for line in lines)
                self.need = int(self.head["Content-Length"])
                del self.held[:end + 4]
            if len(self.held) < self.need + 4:
                return
            if self.held[self.need:self.need + 4] != b"\r\n\r\n":
                raise ValueError("a record's block is longer than its Content-Length")
            block, self.held = self.held, self.held[self.need + 4:]
            del block[self.need:]
            self.need = None
            yield self.head, block


def _page(name: str | None) -> int | None:
    number = (name or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number not in ("", "none") else None


def _row(head: dict[str, str], block: bytes, keep: bool = True) -> tuple:
    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
    kind, problem, size = head["WARC-Type"], None, int(head["X-Payload-Length"])
    if kind == "response":
        if base64.b32encode(hashlib.sha1(block).digest()).decode() != digest:
            problem = "digest"
        elif len(block) != size:
            problem = "length"
    elif block or size < 0:
        problem = "length"
    return (_page(head["WARC-Record-ID"]), head["WARC-Target-URI"], kind, digest, size,
            _page(head.get("WARC-Refers-To")), bytes(block) if keep and kind == "response" else None, problem)


def _read(keep_payload: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("page_id", pa.int64()), ("uri", pa.string()), ("record_type", pa.string()), ("payload_digest", pa.string()),
                        ("payload_bytes", pa.int64()), ("refers_to", pa.int64()), ("payload", pa.binary()), ("problem", pa.string())])
    reader, last, rows, size = RecordReader(), None, [], 0

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    for batch in batches:
        for archive, data in zip(batch.column(0).to_pylist(), batch.column(1)):
            if archive != last:
                reader.close()
                reader, last = RecordReader(), archive
            for head, block in reader.feed(data.as_py()):
                rows.append(_row(head, block, keep_payload))
                size += len(block) * keep_payload
                if len(rows) >= 1000 or size > 8 << 20:
                    yield out()
                    rows, size = [], 0
    reader.close()
    if rows:
        yield out()


def read_warc(archives: DataFrame, keep_payload: bool = True) -> DataFrame:
    """Records of archives (archive, chunk, data), each archive read in order by one task.

    Columns: page_id, uri, record_type, payload_digest, payload_bytes, refers_to, payload (null for
    revisits or without `keep_payload`), problem (null, or `digest` or `length` where the payload is not
    what its header says). A revisit has no payload, so its length and digest are those of its header.
    Broken framing is an error. Very long pages: the reader holds one record at a time.
    """
    dealt = archives.repartition("archive").sortWithinPartitions("archive", "chunk")
    return dealt.select("archive", "data").mapInArrow(lambda b: _read(keep_payload, b), RECORDS)


def export_archives(archives: DataFrame, folder: str) -> DataFrame:
    """Write each archive as <folder>/<archive>.warc.gz; `folder` is a path or URI that every executor
    reaches. A file appears under its name when complete, so a repeated task does no harm."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)
        store.create_dir(root, recursive=True)
        out, name, part = None, None, None
        done = []
        for batch in batches:
            for archive, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                if archive != name:
                    if out:
                        out.close()
                        store.move(part, f"{root}/{name}.warc.gz")
                        done.append(f"{root}/{name}.warc.gz")
                    name, part = archive, f"{root}/.{archive}-{uuid.uuid4().hex}"
                    out = store.open_output_stream(part)
                out.write(data.as_py())
        if out:
            out.close()
            store.move(part, f"{root}/{name}.warc.gz")
            done.append(f"{root}/{name}.warc.gz")
        yield pa.RecordBatch.from_arrays([pa.array(done, pa.string())], names=["path"])

    dealt = archives.repartition("archive").sortWithinPartitions("archive", "chunk")
    return dealt.select("archive", "data").mapInArrow(run, "path string")
