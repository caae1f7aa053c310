"""WARC archives: written with revisit records for equal payloads, read by a splittable reader.

Every record is a gzip member of its own. A reading task gets a byte range of an archive: it scans
for the gzip magic, takes a candidate for a record if its header decodes and begins with the WARC
version line, reads on member by member, and owns the records that *start* inside its range (the
last one may end beyond it). Archives of any size are thus read in parallel, without an index.

Writing: payloads are compared by their SHA-1 and length. Of each distinct payload one copy moves, the others are left
out before the shuffle, and meets the id and url of its response; revisits are made from the rows' ids, urls and digests alone.
Each task names its archive anew in every attempt and its manifest row goes through Spark's committer, so archives
of lost attempts are never read.

Reading: where the magic stands by chance, no WARC version line follows. Where one does, a header or body that does not
decode, or that the archive's end cuts off, is an error with its path and place; no record is left out.

Defined results: a null payload is empty; of equal payloads of at least ``least_bytes`` the largest
id (of equal ids, the largest url) is the response and all others revisit it; null ids count as the smallest id; of repeated rows
one is the response; a null url leaves out the target header; an empty table gives an
empty result. Extra columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import math
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import filesystem, scratch_uri, slices, staged

NULL_ID = -(2**63)
MAGIC, VERSION = b"\x1f\x8b\x08", b"WARC/1.1\r\n"
#: Bytes of a reading task's range, and bytes read from the store at a time.
SPLIT_BYTES, CHUNK = 32 << 20, 1 << 20
#: Revisits of equal rows are made from their count in two steps, by this many.
COPIES = 1000


def digest_text(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _urn(page_id: int) -> str:
    return f"<urn:page:{'null' if page_id == NULL_ID else page_id}>"


def _page_id(urn: str) -> int | None:
    name = urn[len("<urn:page:") : -1]
    return None if name == "null" else int(name)


def _header_value(text: str) -> str:
    """No control characters in a header line: they are percent-encoded."""
    return "".join(f"%{ord(c):02X}" if c < " " or c == "\x7f" else c for c in text)


def record(page_id: int, url: str | None, payload: bytes | None, digest: bytes, refers_to: int | None, length: int | None = None, level: int = 2) -> bytes:
    """One gzip member: a response with the payload, or a revisit of ``refers_to`` without it, but with its ``length``."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % (len(payload or b"") if length is None else length)
    block = http if refers_to is not None else http + payload
    lines = [f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_urn(page_id)}", "WARC-Date: 1970-01-01T00:00:00Z"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_header_value(url)}")
    lines.append(f"WARC-Payload-Digest: sha1:{digest_text(digest)}")
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {_urn(refers_to)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    head = VERSION + "\r\n".join(lines).encode() + b"\r\n\r\n"
    return packer.compress(head + block + b"\r\n\r\n") + packer.flush()


def parse_record(data: bytes) -> dict:
    """The headers of a decoded record, its payload and the payload's full length."""
    head, _, rest = data.partition(b"\r\n\r\n")
    found = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(found["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(line.split(b":", 1)[1]) for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:"))
    return found | {"payload": payload, "length": length}


class _Window:
    """Bytes of an archive by position, read in chunks as they are needed."""

    def __init__(self, source, at: int, size: int) -> None:
        self.source, self.base, self.size, self.data = source, at, size, b""

    def more(self) -> bool:
        at = self.base + len(self.data)
        if at >= self.size:
            return False
        got = self.source.read_at(min(CHUNK, self.size - at), at)
        if not got:
            raise EOFError(f"the archive ends before byte {self.size}")
        self.data += got
        return True

    def drop(self, upto: int) -> None:
        self.data = self.data[upto - self.base :]
        self.base = upto


def _begins_record(window: _Window, at: int) -> bool:
    """Whether a gzip member that opens with the WARC version line begins here; an error if its header does not end."""
    opener, done, head = zlib.decompressobj(31), at - window.base, b""
    while b"\r\n\r\n" not in head[-4100:]:
        try:
            head += opener.decompress(window.data[done : done + 4096], 4096)
        except zlib.error as error:
            if head.startswith(VERSION):
                raise ValueError(f"byte {at}: a record's header does not decode ({error})") from error
            return False
        done = min(done + 4096, len(window.data)) - len(opener.unconsumed_tail)
        if not head.startswith(VERSION[: len(head)]):
            return False
        if b"\r\n\r\n" not in head[-4100:] and (opener.eof or (done >= len(window.data) and not opener.unconsumed_tail and not window.more())):
            if head.startswith(VERSION):
                raise ValueError(f"byte {at}: a record's header does not end")
            return False
    return True


def _member(window: _Window, at: int) -> tuple[bytes, int]:
    """The decoded member that begins at ``at`` and its end; an error if it does not decode as a whole."""
    opener, done, parts = zlib.decompressobj(31), at - window.base, []
    while not opener.eof:
        if done >= len(window.data) and not window.more():
            raise ValueError(f"byte {at}: the archive ends inside a record")
        piece = window.data[done : done + CHUNK]
        try:
            parts.append(opener.decompress(piece))
        except zlib.error as error:
            raise ValueError(f"byte {at}: a record does not decode ({error})") from error
        done += len(piece)
    return b"".join(parts), window.base + done - len(opener.unused_data)


def read_split(source, size: int, start: int, end: int) -> Iterator[bytes]:
    """The decoded records of an archive that start in bytes start..end-1.

    The first is searched by the magic; where one ends, the next one begins, or it is an error."""
    window, at, known = _Window(source, start, size), start, start == 0
    while at < end:
        found = window.data.find(MAGIC, at - window.base)
        if found < 0 or found + len(MAGIC) > len(window.data):
            keep = at if known else max(at, window.base + len(window.data) - len(MAGIC) + 1)
            if not window.more():
                if known:
                    raise ValueError(f"byte {at}: no record begins where the last one ends")
                return
            window.drop(keep)
            at = keep
            continue
        first = window.base + found
        if known and (first != at or not _begins_record(window, at)):
            raise ValueError(f"byte {at}: no record begins where the last one ends")
        at = first
        if at >= end:
            return
        if not known and not _begins_record(window, at):  # the magic by chance
            at += 1
            continue
        data, at = _member(window, at)
        yield data
        known = True
        window.drop(at)


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0, id_column: str = "page_id", url_column: str = "url", payload_column: str = "html") -> DataFrame:
    """One archive a task below ``folder``; the manifest: path and size of each."""
    payload = F.coalesce(F.col(payload_column), F.lit("")).cast("binary")
    key = F.coalesce(F.col(id_column).cast("long"), F.lit(NULL_ID)).alias("key")
    rows = pages.select(key, F.col(url_column).alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"digest": F.unhex(F.sha1("payload")), "length": F.octet_length("payload").cast("long")})
    same = ["digest", "length"]

    copies = staged(rows.where(F.col("length") >= least_bytes).groupBy("key", "url", *same).agg(F.count("*").alias("n")), "warc-copies")
    answers = staged(copies.groupBy(*same).agg(F.max(F.struct("key", "url")).alias("answer"), F.sum("n").alias("all")), "warc-answers")
    responses = rows.where(F.col("length") >= least_bytes).groupBy(*same).agg(F.first("payload").alias("payload"))
    none = F.lit(None).cast("long").alias("refers")
    responses = responses.join(answers, same).select("answer.key", "answer.url", "payload", *same, none)
    small = rows.where(F.col("length") < least_bytes).select("key", "url", "payload", *same, none)

    met = copies.join(answers.where("all > 1"), same)
    left = F.col("n") - (F.struct("key", "url").eqNullSafe(F.col("answer"))).cast("long")
    met = met.withColumn("left", left).where("left > 0")
    met = met.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("left") - 1) / COPIES))))
    met = met.withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.least(F.lit(COPIES), F.col("left") - F.col("block") * COPIES).cast("int"))))
    revisits = met.select("key", "url", F.lit(None).cast("binary").alias("payload"), *same, F.col("answer.key").alias("refers"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        fs.create_dir(root, recursive=True)
        out, path, size = None, f"{root}/{uuid.uuid4().hex}.warc.gz", 0
        for batch in slices(batches, "payload", 16 << 20):
            for row in batch.to_pylist():
                data = record(row["key"], row["url"], row["payload"], row["digest"], row["refers"], row["length"])
                if out is None:
                    out = fs.open_output_stream(path, compression=None)
                out.write(data)
                size += len(data)
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pylist([{"path": path, "size": size}])

    return staged(responses.unionAll(small).unionAll(revisits).mapInArrow(write, "path string, size long"), "warc-manifest")


def read_archives(manifest: DataFrame, folder: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Per record: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    ranges = manifest.select("path", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(split_bytes).cast("long"))).alias("start"))
    n = manifest.agg(F.sum(F.ceil(F.col("size") / split_bytes))).first()[0] or 1

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = filesystem(folder)
        for batch in batches:
            for split in batch.to_pylist():
                with fs.open_input_file(split["path"]) as source:
                    found = []
                    try:
                        for data in read_split(source, split["size"], split["start"], min(split["size"], split["start"] + split_bytes)):
                            found.append(_row(parse_record(data)))
                            if len(found) == 5000:
                                yield pa.RecordBatch.from_pylist(found, schema=OUT)
                                found = []
                    except ValueError as error:
                        raise ValueError(f"{split['path']}: {error}") from error
                    if found:
                        yield pa.RecordBatch.from_pylist(found, schema=OUT)

    return ranges.repartition(max(1, min(int(n), 100_000))).mapInArrow(read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


OUT = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])


def _row(found: dict) -> dict:
    kind, digest = found["WARC-Type"], found["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and digest != digest_text(hashlib.sha1(found["payload"]).digest()):
        raise ValueError(f"{found['WARC-Record-ID']}: the payload does not match its digest")
    return {
        "page_id": _page_id(found["WARC-Record-ID"]),
        "payload_bytes": found["length"],
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": _page_id(found["WARC-Refers-To"]) if "WARC-Refers-To" in found else None,
    }


def archive_pages(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write all pages to archives in the shared folder and read them back."""
    folder = scratch_uri(spark, "warc")
    return read_archives(write_archives(pages, folder), folder)
