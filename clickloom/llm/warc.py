"""WARC archives: a writer with revisit records and a splittable reader.

Each record is a gzip member of its own.  A reading task has a byte range: it looks for gzip
magic in it, decodes the beginning of each candidate, and owns the records
that start inside the range, also where they end behind it.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.files import attempt_name, folder, opened
from clickloom.session import pin

GZIP = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CHUNK = 1 << 18
PAGE = re.compile(r"<urn:page:(-?\d+)(?::[^>]*)?>")
LEAST_REVISIT = 1000


# --- one record ------------------------------------------------------------------------

def _record(kind: str, record_id: str, date: str, content: str, block: bytes, more: list[str]) -> bytes:
    lines = [VERSION.decode(), f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id}", f"WARC-Date: {date}", *more,
             f"Content-Type: {content}", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def page_id_text(page_id: int | None, own: str = "") -> str:
    """The id of a page's record; ``own`` tells records of one page apart."""
    return f"<urn:page:{'null' if page_id is None else page_id}{':' + own if own else ''}>"


def record(page_id: int | None, url: str | None, payload: bytes, size: int, sha1: str, refers_to: int | None,
           date: str, own: str = "") -> bytes:
    """A response with the payload, or a revisit that keeps the HTTP head (and with it the length) only."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    target = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    more = [f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(sha1)).decode()}"]
    if refers_to is not None:
        more += [f"WARC-Refers-To: {page_id_text(refers_to)}", f"WARC-Profile: {IDENTICAL}"]
    return _record("response" if refers_to is None else "revisit", page_id_text(page_id, own), date,
                   "application/http;msgtype=response", head if refers_to is not None else head + payload, more)


def info(name: str, date: str) -> bytes:
    """The record that begins an archive."""
    return _record("warcinfo", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>", date, "application/warc-fields",
                   b"format: WARC File Format 1.1\r\n", [f"WARC-Filename: {name}"])


def member(data: bytes, level: int = 6) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _headers(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields.setdefault(name.strip().lower(), value.strip())
    return fields, rest


def _page(value: str | None) -> int | None:
    """The page of a record id of this writer; None for ids of other kinds."""
    found = PAGE.fullmatch(value or "")
    return int(found.group(1)) if found else None


def _number(value: str | None) -> int | None:
    return int(value) if value and value.isascii() and value.isdigit() else None


def _sha1(value: str | None) -> str | None:
    """A SHA-1 given in base 32 or hexadecimal, as lower-case hexadecimal; None for none and for other digests."""
    name, _, digest = (value or "").partition(":")
    if name.lower() != "sha1":
        return None
    try:
        return digest.lower() if len(digest) == 40 else base64.b32decode(digest.upper()).hex()
    except ValueError:
        return None


def parse(data: bytes) -> dict:
    """Fields of one record of any type.

    The payload is what follows the HTTP head where the block is an HTTP message (``application/http``), else the block; a revisit
    has none, and its length is the one its HTTP head tells, if any.  The digest is that of the record, or
    computed where it gives none; ids stay text, page numbers are there where the ids are of this writer.  A block that is shorter than
    its length, and a payload of a response that does not have its digest, are damage and an error; not so a payload
    that was cut or encoded in transfer, whose digest may be of the original.
    """
    fields, rest = _headers(data)
    name, kind = fields.get("warc-record-id"), fields.get("warc-type", "")
    size = _number(fields.get("content-length"))
    block = rest if size is None else rest[:size]
    if size is not None and len(block) < size:
        raise ValueError(f"damaged record {name}")
    http, payload = {}, block
    if fields.get("content-type", "").lower().startswith("application/http"):
        http, payload = _headers(block)
    told = _sha1(fields.get("warc-payload-digest"))
    if kind == "revisit":
        payload, length, digest = None, _number(http.get("content-length")), told
    else:
        found = hashlib.sha1(payload).hexdigest()
        whole = "warc-truncated" not in fields and "transfer-encoding" not in http
        length, digest = len(payload), told or found
        if kind == "response" and whole and (found != digest or (_number(http.get("content-length")) or length) != length):
            raise ValueError(f"damaged record {name}")
    return {"page_id": _page(name), "url": fields.get("warc-target-uri"), "record_type": kind, "payload_bytes": length,
            "payload_digest": digest, "refers_to": _page(fields.get("warc-refers-to")), "payload": payload,
            "record_id": name, "refers_to_id": fields.get("warc-refers-to"), "content_type": fields.get("content-type")}


# --- writing ------------------------------------------------------------------------------

def with_revisits(pages: DataFrame, key: str = "page_id", url: str = "url", body: str = "html",
                  least: int = LEAST_REVISIT) -> DataFrame:
    """(page_id, url, payload, payload_bytes, payload_digest, refers_to, repeated) of every page.

    Of pages with equal payloads of at least ``least`` bytes, that with the largest key is written in full and the others refer to it.
    Rows that repeat the largest key are all written in full; so are rows with a null key.  Only payloads that occur under several keys are
    joined, by a written table, so that a payload which a third of the pages share is split.  Rows that share their key with
    others, or have none, are marked ``repeated``: their records get ids of their own.  Other columns are ignored.
    """
    payload = F.coalesce(F.col(body).cast("binary"), F.lit(b""))
    slim = pages.select(F.col(key).alias("page_id"), F.sha1(payload).alias("payload_digest"), F.length(payload).alias("_n"))
    leaders = (slim.filter(F.col("_n") >= least).groupBy("payload_digest")
               .agg(F.max("page_id").alias("_leader"), F.min("page_id").alias("_least"))
               .filter(F.col("_least") < F.col("_leader")).select(F.col("payload_digest").alias("_digest"), "_leader"))
    leaders = pin(leaders, "warc-leaders")
    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"payload_bytes": F.length("payload").cast("long"), "payload_digest": F.sha1("payload")})
    refers = F.when((F.col("page_id") != F.col("_leader")) & (F.col("payload_bytes") >= least), F.col("_leader")).cast("long")
    twice = pin(pages.groupBy(F.col(key).cast("long").alias("_twice")).count().filter(
        (F.col("count") > 1) & F.col("_twice").isNotNull()).select("_twice"), "warc-repeated")
    out = (rows.join(leaders, F.col("payload_digest") == F.col("_digest"), "left")
           .select("page_id", "url", F.when(refers.isNull(), F.col("payload")).alias("payload"), "payload_bytes",
                   "payload_digest", refers.alias("refers_to")))
    if twice.isEmpty():
        return out.withColumn("repeated", F.col("page_id").isNull())
    marked = out.join(twice, F.col("page_id") == F.col("_twice"), "left")
    return marked.withColumn("repeated", F.col("page_id").isNull() | F.col("_twice").isNotNull()).drop("_twice")


def write_warc(records: DataFrame, name: str = "warc", date: str = "2024-01-01T00:00:00Z", level: int = 6) -> DataFrame:
    """Write the rows of ``with_revisits``, one archive per task, each after a ``warcinfo`` record; returns the written list (path, bytes).

    A file that is not in the list was left by a lost attempt and is never read.
    """
    root = folder(records.sparkSession, name)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = f"{root}/{attempt_name(TaskContext.get().partitionId(), '.warc.gz')}"
        out, size = None, 0
        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "payload", "payload_bytes", "payload_digest", "refers_to", "repeated")]
            for i in range(batch.num_rows):
                page, url, payload, n, sha1, refers, repeated = (c[i].as_py() for c in columns)
                if out is None:
                    filesystem, inside = opened(path)
                    out = filesystem.open_output_stream(inside, compression=None)
                    size = out.write(member(info(path.rsplit("/", 1)[-1], date), level))
                own = uuid.uuid5(uuid.NAMESPACE_URL, f"{path}#{size}").hex if repeated else ""
                size += out.write(member(record(page, url, payload or b"", n, sha1, refers, date, own), level))
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([size], type=pa.int64())], names=["path", "bytes"])

    return pin(records.mapInArrow(write, "path string, bytes long"), f"{name}-files")


# --- reading --------------------------------------------------------------------------------

class _Bytes:
    """A file read piece by piece from anywhere."""

    def __init__(self, path: str):
        filesystem, inside = opened(path)
        self.file = filesystem.open_input_file(inside)
        self.size = self.file.size()

    def at(self, lo: int, n: int) -> bytes:
        return self.file.read_at(max(0, min(n, self.size - lo)), lo) if lo < self.size else b""


def _decoded(source: _Bytes, at: int) -> tuple[bytes, int] | None:
    """The whole record of the member at ``at`` and the place behind it, or None if no record begins there."""
    unpacker = zlib.decompressobj(31)
    pieces, place, checked, want = [], at, False, 1 << 12
    while not unpacker.eof:
        data = source.at(place, want)
        if not data:
            if checked:
                raise ValueError(f"the archive ends inside the record at {at}")
            return None
        try:
            pieces.append(unpacker.decompress(data))
        except zlib.error:
            if checked:
                raise
            return None
        place += len(data)
        want = CHUNK
        if not checked:
            begin = b"".join(pieces)[:len(VERSION)]
            if not VERSION[:7].startswith(begin[:7]) or len(begin) < 7 and unpacker.eof:
                return None
            checked = len(begin) >= 7
    return b"".join(pieces), place - len(unpacker.unused_data)


def records_in(source: _Bytes, lo: int, hi: int) -> Iterator[tuple[int, bytes]]:
    """(place, record) of the members that start in [lo, hi)."""
    at = lo
    while at < hi:
        # two more bytes, so that magic across the end of the chunk is seen; it must start before hi
        chunk = source.at(at, min(CHUNK, hi - at) + 2)
        found = chunk.find(GZIP)
        if found < 0 or at + found >= hi:
            at += max(1, len(chunk) - 2)
            continue
        place = at + found
        whole = _decoded(source, place)
        if whole is None:
            at = place + 1
        else:
            yield place, whole[0]
            at = whole[1]


PAGES = ("response", "revisit")


def read_warc(files: DataFrame, split_bytes: int = 4 << 20, payloads: bool = False, kinds: Sequence[str] | None = PAGES) -> DataFrame:
    """Records of the listed archives (path, bytes), read in ranges of ``split_bytes``; archives of any writer, a gzip member for each record.

    ``kinds``: the record types wanted, None for all.  See ``parse`` for the columns; those that a record does not have are null.  A damaged
    member fails the job, it is not skipped.
    """
    fields = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "record_id", "refers_to_id", "content_type"]
    schema = ("page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, "
              "record_id string, refers_to_id string, content_type string")
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
    if payloads:
        fields, schema, types = [*fields, "payload"], schema + ", payload binary", [*types, pa.binary()]
    wanted = None if kinds is None else set(kinds)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.to_pylist():
                rows, held = [], 0
                for _, data in records_in(_Bytes(part["path"]), part["lo"], part["hi"]):
                    found = parse(data)
                    if wanted is not None and found["record_type"] not in wanted:
                        continue
                    rows.append(found if payloads else {**found, "payload": None})
                    held += len(data) if payloads else 400
                    if held >= 8 << 20:
                        yield _batch(rows)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows)

    def _batch(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[f] for r in rows], type=t) for f, t in zip(fields, types)], names=fields)

    ranges = pin(files.select("path", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)),
                                                           F.lit(split_bytes).cast("long"))).alias("lo"), "bytes")
                 .select("path", "lo", F.least(F.col("lo") + split_bytes, F.col("bytes")).alias("hi")), "warc-ranges")
    return ranges.repartition(max(1, ranges.count()), "path", "lo").mapInArrow(read, schema)
