"""WARC archives: writing, and a sequential reader.

A file is a chain of gzip members, one record each (WARC/1.1).  The reader
walks a file from its start: it inflates each member piece by piece,
frames the block by Content-Length and checks the block and payload
digests; a torn or altered record raises ``WarcError``.

Writing goes through Spark's text sink, which reaches any store, and whose
commit protocol drops the files of lost or repeated tasks.  The sink ends
each row with a separator, here the zero byte: it serves as the last byte
of the gzip member (the top byte of its length field, zero below 16 MiB).
Larger members are written whole, and the zero after them is the padding
that gzip allows; the reader skips it.

Defined cases: null html is an empty payload; equal payloads of at least
``min_bytes`` have one response, the record of the largest page id (null
ids are below all others; rows that repeat that id are responses too);
an empty table gives no files; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ladle.llm.common import saved, text_or_empty, total_bytes

MIN_BYTES = 1000
FILE_BYTES = 32 << 20
PIECE = 64 << 10
GZIP_LEVEL = 4
BROADCAST_ROWS = 500_000  # of about 60 bytes each
URN = "urn:page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class WarcError(ValueError):
    pass


def _b32(sha1: bytes) -> str:
    return "sha1:" + base64.b32encode(sha1).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, sha1: bytes) -> bytes:
    """One record, uncompressed.  A revisit has the HTTP header but not the payload."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <{URN}{'' if page_id is None else page_id}>", "WARC-Date: 1970-01-01T00:00:00Z",
            "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: {_b32(sha1)}",
            f"WARC-Block-Digest: {_b32(hashlib.sha1(block).digest())}", f"Content-Length: {len(block)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(c for c in url if c >= " "))
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{URN}{refers_to}>", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes) -> bytes:
    z = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def _write_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for page, url, html, refers in zip(*(c for c in b.columns)):
            payload = html.as_py().encode("utf-8", "surrogatepass")
            m = gzip_member(record(page.as_py(), url.as_py(), payload, refers.as_py(), hashlib.sha1(payload).digest()))
            out.append(m[:-1] if m[-1] == 0 else m)
            if sum(map(len, out[-64:])) > 8 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])
                out = []
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])


def with_revisits(pages: DataFrame, key: str, html: str, min_bytes: int) -> DataFrame:
    """page_id, url, html, refers_to.  Only digests are shuffled, never pages.

    The table of repeated payloads has one row per digest; it is broadcast
    when counted small, and beyond that joined by sort and merge, where
    Spark splits a digest that many pages share.
    """
    p = pages.select(F.col(key).cast("long").alias("page_id"),
                     (F.col("url").cast("string") if "url" in pages.columns else F.lit(None).cast("string")).alias("url"),
                     text_or_empty(html).alias("html"))
    big = F.octet_length("html") >= min_bytes
    digest = F.when(big, F.sha1("html"))
    twice = saved(p.select("page_id", digest.alias("d")).where("d is not null").groupBy("d")
                  .agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("last"))
                  .where("n > 1 and last is not null").drop("n"), "repeated-payloads")
    n = twice.count()
    if not n:
        return p.withColumn("refers_to", F.lit(None).cast("long"))
    table = F.broadcast(twice) if n <= BROADCAST_ROWS else twice
    return (p.withColumn("d", digest).join(table, "d", "left")
            .select("page_id", "url", "html", F.when(~F.col("last").eqNullSafe(F.col("page_id")), F.col("last")).alias("refers_to")))


def write_warc(pages: DataFrame, path: str, key: str = "page_id", html: str = "html", min_bytes: int = MIN_BYTES,
               file_bytes: int = FILE_BYTES) -> None:
    """A record per row, in files of about ``file_bytes`` of payload below ``path``."""
    files = max(1, -(-total_bytes(pages, html) // file_bytes))
    rows = with_revisits(pages, key, html, min_bytes)
    if files > 1:
        rows = rows.repartition(files, F.xxhash64("page_id", "html"))
    (rows.mapInArrow(_write_records, "value binary").select(F.col("value").cast("string").alias("value"))
     .write.text(path, lineSep="\0"))


def members(data: memoryview) -> Iterator[Iterator[bytes]]:
    """The gzip members of a file, each as its inflated pieces."""
    at = 0

    def inflate() -> Iterator[bytes]:
        nonlocal at
        z = zlib.decompressobj(31)
        while not z.eof:
            piece = bytes(data[at:at + PIECE])
            if not piece:
                raise WarcError("the file ends inside a record")
            try:
                out = z.decompress(piece)
            except zlib.error as e:
                raise WarcError(f"bad gzip data: {e}") from e
            at += len(piece) - len(z.unused_data)
            if out:
                yield out

    while at < len(data):
        if data[at] == 0:
            at += 1
            continue
        own = inflate()
        yield own
        for _ in own:  # a member not read to its end
            pass


def _lines(head: bytes) -> tuple[str, dict[str, str]]:
    first, *rest = head.decode("utf-8", "surrogatepass").split("\r\n")
    out = {}
    for x in rest:
        name, colon, value = x.partition(":")
        if not colon:
            raise WarcError(f"bad header line {x!r}")
        out[name.strip().lower()] = value.strip()
    return first, out


def read_record(pieces: Iterator[bytes]) -> tuple[dict[str, str], bytes, dict[str, str], bytes]:
    """WARC header, block, HTTP header and payload of one member, verified."""
    held = b""
    while (end := held.find(b"\r\n\r\n")) < 0:
        more = next(pieces, None)
        if more is None:
            raise WarcError("no end of the record's header")
        held += more
    version, head = _lines(held[:end])
    if not version.startswith("WARC/"):
        raise WarcError(f"not a record: {version[:20]!r}")
    size = int(head["content-length"])
    got = [held[end + 4:]]
    have = len(got[0])
    for more in pieces:
        got.append(more)
        have += len(more)
        if have > size + 4:
            raise WarcError("the record is longer than its Content-Length")
    data = b"".join(got)
    if len(data) != size + 4 or data[size:] != b"\r\n\r\n":
        raise WarcError("the record does not end where its Content-Length says")
    block = data[:size]
    if "warc-block-digest" in head and _b32(hashlib.sha1(block).digest()) != head["warc-block-digest"]:
        raise WarcError("block digest differs")
    http, payload = {}, block
    if head.get("content-type", "").startswith("application/http"):
        top, sep, payload = block.partition(b"\r\n\r\n")
        if not sep:
            raise WarcError("no end of the HTTP header")
        http = _lines(top)[1]
    if head.get("warc-type") != "revisit" and "warc-payload-digest" in head and _b32(
            hashlib.sha1(payload).digest()) != head["warc-payload-digest"]:
        raise WarcError("payload digest differs")
    return head, block, http, payload


def _page(urn: str | None) -> int | None:
    name = (urn or "").strip("<>").removeprefix(URN)
    return int(name) if name.lstrip("-").isdigit() else None


def _read_files(keep_payload: bool):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column(0):
                rows, held = [], 0
                for pieces in members(memoryview(content.as_buffer())):
                    head, _, http, payload = read_record(pieces)
                    size = int(http["content-length"]) if "content-length" in http else len(payload)
                    digest = head.get("warc-payload-digest", "").removeprefix("sha1:")
                    rows.append((_page(head.get("warc-record-id")), size,
                                 base64.b32decode(digest).hex() if digest else None, head.get("warc-type"),
                                 _page(head.get("warc-refers-to")), head.get("warc-target-uri"),
                                 payload if keep_payload and head.get("warc-type") != "revisit" else None))
                    held += len(payload)
                    if held > 8 << 20:
                        yield _batch(rows)
                        rows, held = [], 0
                yield _batch(rows)

    return work


_KINDS = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(),
          "refers_to": pa.int64(), "url": pa.string(), "payload": pa.binary()}


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [()] * len(_KINDS)
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, _KINDS.values())], list(_KINDS))


def read_warc(spark: SparkSession, path: str, keep_payload: bool = False) -> DataFrame:
    """One row per record of the files below ``path``; ``payload`` holds the bytes if asked for."""
    return (spark.read.format("binaryFile").load(path).where("length > 0").select("content")
            .mapInArrow(_read_files(keep_payload), "page_id long, payload_bytes long, payload_digest string, "
                        "record_type string, refers_to long, url string, payload binary"))
