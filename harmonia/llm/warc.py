"""Operator 11: WARC archives, and a normaliser for archives that are one gzip stream.

``write_monolithic`` writes a record per page.  Spark's text writer does it:
a row is one record, the line separator is the CRLF CRLF that ends a record,
and gzip compresses each file as a whole, so a file can only be read from its
start.  ``normalise`` mends that: Spark's reader inflates each whole-file
stream once, a task follows the stream record by record (a record at a time
in memory), compresses every record as a gzip member of its own and notes
where it lies.  The members go to new archives, the notes to a sidecar index
beside each archive.  ``read_records`` takes records, all or those of some
index rows, out of the archives by offset and length and inflates each
member alone.

Archives are bounded (``ARCHIVE_BYTES``, ``ARCHIVE_RECORDS``): a long stream
goes on in a further one, so that an archive is a fair piece of work for a
reader.  Short streams that one task reads share archives: files and folders
grow with the bytes, not with the number of streams.  Between members stands an empty gzip member (``REST``), as Spark's
writer needs a separator; gzip readers pass over it.  Files are written and
read by Spark alone, in its commit protocol and on any file system; lost
tasks are run again, and their archives come out the same byte for byte.

Of pages with equal payloads of at least ``min_revisit`` bytes the one with
the smallest id is a response, the others are revisits without payload that
refer to it.

Cases: a null payload counts as empty; a null url is left out; pages of no id
revisit the smallest id of their payload, and are responses where it has none;
rows that repeat an id and payload are alike; carriage returns and line feeds
in urls are percent-encoded; other columns are not archived; no rows: no
records.  Bytes of a foreign archive that are no record end up in one record
of type ``malformed``.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CRLF = b"\r\n"
END = CRLF + CRLF
ARCHIVE_BYTES = 32 << 20
ARCHIVE_RECORDS = 50_000
#: Results are handed on when so many bytes have gathered.
BATCH_BYTES = 4 << 20
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def gzip_member(data: bytes) -> bytes:
    """One gzip member without time stamp: equal data, equal bytes."""
    press = zlib.compressobj(6, zlib.DEFLATED, 31)
    return press.compress(data) + press.flush()


REST = gzip_member(b"")

_INDEX = [("archive", pa.string()), ("seq", pa.int64()), ("offset", pa.int64()), ("length", pa.int64()),
          ("record_type", pa.string()), ("record_id", pa.string()), ("target_uri", pa.string()),
          ("payload_digest", pa.string()), ("refers_to", pa.string())]
_SQL = {pa.string(): "string", pa.int64(): "long", pa.binary(): "binary"}


def _ddl(fields: list) -> str:
    return ", ".join(f"{n} {_SQL[t]}" for n, t in fields)


INDEX_SCHEMA = _ddl(_INDEX)


# --- writing --------------------------------------------------------------------------------

def plan_records(pages: DataFrame, page_id: str = "page_id", uri: str = "url", payload: str = "html",
                 min_revisit: int = 100) -> DataFrame:
    """Per page ``id, uri, payload, n, digest, refers_to`` (null: a response).

    The smallest id of each repeated payload comes from a partial aggregate;
    pages of a very common payload meet it in a join that Spark can split.
    """
    rows = pages.select(F.col(page_id).alias("id"), F.col(uri).cast("string").alias("uri"),
                        F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumns({"n": F.octet_length("payload"), "digest": F.sha2("payload", 256)})
    first = (rows.filter(F.col("n") >= min_revisit).groupBy("digest")
             .agg(F.min("id").alias("first"), F.count("*").alias("times")).filter("times > 1").drop("times"))
    again = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    return rows.join(first, "digest", "left").select(
        "id", "uri", "payload", "n", "digest", F.when(again, F.col("first")).alias("refers_to"))


def _urn(c: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(F.url_encode(c.cast("string")), F.lit("*")), F.lit(">"))


def _record_text(date: str) -> Column:
    """The bytes of a record up to the separator that follows it."""
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("n").cast("string"), F.lit("\r\n\r\n"))
    size = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("n"))
    uri = F.replace(F.replace(F.col("uri"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), _urn(F.col("id")), F.lit(f"\r\nWARC-Date: {date}"),
        F.coalesce(F.concat(F.lit("\r\nWARC-Target-URI: "), uri), F.lit("")),
        F.lit("\r\nWARC-Payload-Digest: sha256:"), F.col("digest"),
        F.when(revisit, F.concat(F.lit(f"\r\nWARC-Profile: {PROFILE}\r\nWARC-Refers-To: "), _urn(F.col("refers_to"))))
        .otherwise(F.lit("")),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), size.cast("string"),
        F.lit("\r\n\r\n"), http, F.when(revisit, F.lit("")).otherwise(F.col("payload").cast("string")))


def write_monolithic(records: DataFrame, path: str, date: str = DATE) -> None:
    """Writes planned records as WARC files, each one gzip stream."""
    (records.select(_record_text(date).alias("value")).write.option("compression", "gzip")
     .option("lineSep", END.decode()).text(path))


# --- following a stream -----------------------------------------------------------------------

class RecordStream:
    """Cuts a stream that arrives in pieces into whole WARC records."""

    def __init__(self):
        self.held, self.at, self.need = bytearray(), 0, 0

    def feed(self, piece: bytes) -> Iterator[bytes]:
        """The records that ``piece`` completes, with the separator that ends each.

        ``need`` is the size of the record at hand once its header is whole;
        ``at`` is how far a header's end was looked for.
        """
        self.held += piece
        while True:
            if not self.need:
                end = self.held.find(END, max(0, self.at - len(END)))
                if end < 0:
                    self.at = len(self.held)
                    return
                self.need = end + 2 * len(END) + self._length(end)
            if len(self.held) < self.need:
                return
            yield bytes(self.held[:self.need])
            del self.held[:self.need]
            self.at = self.need = 0

    def _length(self, end: int) -> int:
        """The block length that the header names; what is no header is a record without block."""
        named = re.search(rb"(?mi)^content-length:[ \t]*(\d+)[ \t]*\r?$", self.held[:end])
        return int(named[1]) if named and self.held.startswith(b"WARC/") else -len(END)

    def rest(self) -> bytes:
        """What is left when the stream has ended."""
        return bytes(self.held)


def headers_of(record: bytes) -> tuple[dict[str, str], bytes]:
    """A record's header fields by lower-case name, and its block."""
    head, _, rest = record.partition(END)
    if not head.startswith(b"WARC/"):
        return {"warc-type": "malformed"}, record
    named = dict(line.split(":", 1) for line in head.decode("utf-8", "replace").split("\r\n")[1:] if ":" in line)
    named = {k.strip().lower(): v.strip() for k, v in named.items()}
    size = named.get("content-length", "")
    if not size.isdigit() or len(rest) < int(size):
        return {"warc-type": "malformed"}, record
    return named, rest[:int(size)]


def _digest(named: dict[str, str]) -> str | None:
    return named["warc-payload-digest"].rpartition(":")[2] if "warc-payload-digest" in named else None


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of streams in file order to members of archives, with their index fields.

    Archives bear the name of the task's first file.
    """
    schema = pa.schema([*_INDEX, ("member", pa.binary())])
    out: list[tuple] = []
    size, state = 0, {}

    def begin(file: str) -> None:
        if not state:
            name = re.sub(r"[^A-Za-z0-9_-]", "-", file.rpartition("/")[2].split(".")[0])
            state.update(part=0, seq=0, offset=0, name=f"{name}-{hashlib.sha256(file.encode()).hexdigest()[:8]}")
        state.update(file=file, stream=RecordStream())

    def add(record: bytes) -> None:
        nonlocal size
        member = gzip_member(record)
        if state["seq"] >= ARCHIVE_RECORDS or state["seq"] and state["offset"] + len(member) > ARCHIVE_BYTES:
            state.update(part=state["part"] + 1, seq=0, offset=0)
        named, _ = headers_of(record)
        out.append((f"{state['name']}-{state['part']:05d}", state["seq"], state["offset"], len(member),
                    named.get("warc-type"), named.get("warc-record-id"), named.get("warc-target-uri"), _digest(named),
                    named.get("warc-refers-to"), member))
        state["seq"] += 1
        state["offset"] += len(member) + len(REST)
        size += len(member)

    def finish() -> None:
        if state and (left := state["stream"].rest()).strip(CRLF):
            add(left)

    def ready() -> pa.RecordBatch:
        nonlocal size
        batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)
        out.clear()
        size = 0
        return batch

    for batch in batches:
        for piece, file in zip(batch.column(0), batch.column(1).to_pylist()):
            if file != state.get("file"):
                finish()
                begin(file)
            for record in state["stream"].feed(piece.as_py() + END):
                add(record)
                if size >= BATCH_BYTES:
                    yield ready()
    finish()
    if out:
        yield ready()


def normalise(spark: SparkSession, source: str, root: str) -> None:
    """Rewrites gzipped WARC files below ``source``: archives with a member per
    record in ``root/archives``, the sidecar index of each in ``root/index``.

    Both are written from one pass over the streams, kept by the block manager
    (recomputed from the source where an executor is lost).
    """
    pieces = spark.read.option("lineSep", END.decode()).text(source)
    pieces = pieces.select(F.col("value").cast("binary").alias("piece"), F.col("_metadata.file_path").alias("file"))
    members = pieces.mapInArrow(_members, f"{INDEX_SCHEMA}, member binary")
    members = members.sortWithinPartitions("archive", "seq").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        (members.select("archive", F.col("member").cast("string").alias("value")).write.partitionBy("archive")
         .option("lineSep", REST.decode("latin-1")).option("encoding", "ISO-8859-1").text(f"{root}/archives"))
        members.drop("member").write.partitionBy("archive").parquet(f"{root}/index")
    finally:
        members.unpersist()


# --- reading ---------------------------------------------------------------------------------

def read_index(spark: SparkSession, root: str) -> DataFrame:
    """The sidecar index of all archives."""
    return spark.read.schema(T._parse_datatype_string(INDEX_SCHEMA)).parquet(f"{root}/index")


_RECORD = [("archive", pa.string()), ("offset", pa.int64()), ("record_type", pa.string()), ("record_id", pa.string()),
           ("target_uri", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
           ("refers_to", pa.string()), ("payload", pa.binary())]


def read_member(member: bytes | memoryview) -> tuple:
    """The fields of the record in one gzip member, after checking it against its own headers."""
    inflate = zlib.decompressobj(31)
    record = inflate.decompress(member)
    if not inflate.eof or inflate.unused_data:
        raise ValueError("the index does not point at a whole gzip member")
    named, block = headers_of(record)
    kind, digest = named["warc-type"], _digest(named)
    if "application/http" in named.get("content-type", ""):
        http, _, payload = block.partition(END)
        length = re.search(rb"(?mi)^content-length:[ \t]*(\d+)[ \t]*\r?$", http)
    else:
        payload, length = block, None
    if kind == "revisit":
        return (kind, named.get("warc-record-id"), named.get("warc-target-uri"), int(length[1]) if length else None,
                digest, named.get("warc-refers-to"), None)
    found = hashlib.sha256(payload).hexdigest()
    if digest is not None and len(digest) == len(found) and digest != found:
        raise ValueError(f"payload of {named.get('warc-record-id')} does not have the digest that its record names")
    return kind, named.get("warc-record-id"), named.get("warc-target-uri"), len(payload), found, None, payload


def read_records(spark: SparkSession, root: str, wanted: DataFrame | None = None, payload: bool = True) -> DataFrame:
    """Records of normalised archives, taken by the offsets of ``wanted`` (rows
    of the index; all by default): ``archive, offset, record_type, record_id,
    target_uri, payload_bytes, payload_digest, refers_to`` and ``payload``
    (null for revisits).  Each archive is read whole once, and is bounded."""
    wanted = read_index(spark, root) if wanted is None else wanted
    at = wanted.groupBy("archive").agg(F.sort_array(F.collect_list(F.struct("offset", "length"))).alias("at"))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{root}/archives").select(
        F.regexp_extract("path", "/archive=([^/]+)/", 1).alias("archive"), "content")
    both = files.join(at.hint("shuffle_hash"), "archive").select("archive", "at", "content")
    fields = _RECORD if payload else _RECORD[:-1]
    schema = pa.schema(fields)

    def inflate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, at, content in zip(*(batch.column(i) for i in range(3))):
                archive, bytes_of, rows, size = archive.as_py(), memoryview(content.as_buffer()), [], 0
                at = at.as_py()
                for i, x in enumerate(at, 1):
                    member = bytes_of[x["offset"]:x["offset"] + x["length"]]
                    rows.append((archive, x["offset"], *read_member(member)))
                    size += rows[-1][5] or 0
                    if size >= BATCH_BYTES or i == len(at):
                        columns = list(zip(*rows))[:len(fields)]
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)
                        rows, size = [], 0

    return both.mapInArrow(inflate, _ddl(fields))


def page_of(urn: Column, kind: str) -> Column:
    """The page id in a record id that ``write_monolithic`` made, as type ``kind``."""
    text = F.regexp_extract(urn, "^<urn:page:(.*)>$", 1)
    return F.when(text != "*", F.url_decode(text)).cast(kind)
