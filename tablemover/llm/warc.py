"""WARC archives as a chunked record table.

Writing: each task streams its rows into one gzip archive, a member per record, and reports the file; a
manifest lists the files of the attempts that ended well, so what a lost executor left behind is never
read. Records with equal payloads of ``min_revisit`` bytes or more are written once; the others become
`revisit` records that refer to it.

Reading: each archive is decompressed block by block and turned into rows (record id, chunk number),
every chunk carrying the SHA-1 of the payload up to its end. Nothing holds a record as a whole: a record of
any size needs one block and one chunk of memory, and its last chunk has the digest of all of it.

Executors open the archives by URI (file, hdfs, s3, gs, abfs) in the shared folder.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import new_work_dir
from .common import col, written

_BLOCK = 1 << 16


def _open_folder(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


# -- writing ---------------------------------------------------------------------------------------

def choose_records(pages: DataFrame, id_col: str, url_col: str, html_col: str, min_revisit: int) -> DataFrame:
    """(id, url, payload, digest, refers_to): refers_to is the id of the record with the same payload that
    keeps it, null for records that are written in full.

    Only payloads that occur twice are joined back; their number of rows is the corpus's copies, and the
    join is one that adaptive execution splits or broadcasts by measured size.
    """
    payload = F.coalesce(col(html_col), F.lit("")).cast("binary")
    rows = pages.select(col(id_col).alias("id"), col(url_col).cast("string").alias("url"), payload.alias("payload"),
                        F.sha1(payload).alias("digest"))
    twice = (rows.where(F.octet_length("payload") >= min_revisit).groupBy("digest")
             .agg(F.max("id").alias("keeper"), F.count(F.lit(1)).alias("n")).where("n > 1")
             .select(F.col("digest").alias("same"), "keeper"))
    # Written first, so its size is known before any payload moves: few copies are broadcast, and the
    # payloads are shuffled only when there are many.
    twice = written(twice, "warc-copies")
    out = rows.join(twice, (F.col("digest") == F.col("same")) & (F.octet_length("payload") >= min_revisit), "left")
    revisit = F.col("same").isNotNull() & ~F.col("id").eqNullSafe(F.col("keeper"))
    return out.select("id", "url", F.when(~revisit, F.col("payload")).alias("payload"), "digest",
                      F.octet_length("payload").cast("long").alias("size"), revisit.alias("revisit"),
                      F.when(revisit, F.col("keeper")).alias("refers_to"))


def record_name(page_id, digest: str) -> str:
    return f"<urn:x-page:{'' if page_id is None else quote(str(page_id), safe='')}:{digest}>"


def record_head(page_id, url, digest: str, size: int, revisit: bool, refers_to, date: str) -> bytes:
    """The record's header and its HTTP header."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {size}\r\n\r\n".encode()
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_name(page_id, digest)}",
             f"WARC-Date: {date}", "Content-Type: application/http;msgtype=response",
             "WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()]
    if url:
        lines.append("WARC-Target-URI: " + quote(url, safe="%:/?#[]@!$&'()*+,;=~"))
    if revisit:
        lines += [f"WARC-Refers-To: {record_name(refers_to, digest)}",
                  "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines.append(f"Content-Length: {len(http) + (0 if revisit else size)}")
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + http


def write_archives(records: DataFrame, folder: str, level: int = 4, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Writes ``choose_records`` rows to ``folder`` and returns the manifest (file, records)."""

    def run(batches):
        where, path = _open_folder(folder)
        name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
        out, n = None, 0
        for batch in batches:
            ids, urls, payloads, digests, sizes, revisits, refers = batch.columns
            for i in range(batch.num_rows):
                out = out or where.open_output_stream(f"{path}/{name}", compression=None)
                member = zlib.compressobj(level, zlib.DEFLATED, 31)
                out.write(member.compress(record_head(ids[i].as_py(), urls[i].as_py(), digests[i].as_py(), sizes[i].as_py(),
                                                      revisits[i].as_py(), refers[i].as_py(), date)))
                if not revisits[i].as_py():
                    view = memoryview(payloads[i].as_buffer())
                    for a in range(0, len(view), _BLOCK):
                        out.write(member.compress(view[a:a + _BLOCK]))
                out.write(member.compress(b"\r\n\r\n"))
                out.write(member.flush())
                n += 1
        if out:
            out.close()
            yield pa.RecordBatch.from_pydict({"file": [f"{folder}/{name}"], "records": pa.array([n], pa.int64())})

    return written(records.mapInArrow(run, "file string, records long"), "warc-manifest")


# -- reading ---------------------------------------------------------------------------------------

class Unzipped:
    """The bytes of a file of gzip members, a bounded block at a time."""

    def __init__(self, raw):
        self.raw, self.tail, self.member, self.buf = raw, b"", None, b""

    def more(self) -> bool:
        """Adds a block to ``buf``; False at the end of the file."""
        while True:
            if not self.tail:
                self.tail = self.raw.read(_BLOCK)
                if not self.tail:
                    if self.member is not None:
                        raise EOFError("archive ends within a record")
                    return False
            if self.member is None:
                self.member = zlib.decompressobj(31)
            out = self.member.decompress(self.tail, _BLOCK)
            if self.member.eof:
                self.tail, self.member = self.member.unused_data, None
            else:
                self.tail = self.member.unconsumed_tail
            if out:
                self.buf += out
                return True

    def until(self, mark: bytes) -> bytes | None:
        """What comes up to and with ``mark``; None at the end of the file."""
        while (k := self.buf.find(mark)) < 0:
            if not self.more():
                if self.buf:
                    raise EOFError("archive ends within a header")
                return None
        out, self.buf = self.buf[:k + len(mark)], self.buf[k + len(mark):]
        return out

    def some(self, most: int) -> bytes:
        """1 to ``most`` bytes."""
        if not self.buf and not self.more():
            raise EOFError("archive ends within a record")
        out, self.buf = self.buf[:most], self.buf[most:]
        return out


def _fields(head: bytes) -> dict:
    pairs = (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:] if line)
    return {k.strip().lower(): v.strip() for k, _, v in pairs}


def read_chunks(raw, chunk_bytes: int):
    """Chunks of every record of an archive: (record id, type, refers to, url, stated SHA-1, stated size,
    chunk number, data, running digest, bytes so far, last)."""
    src = Unzipped(raw)
    while (head := src.until(b"\r\n\r\n")) is not None:
        if not head.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        f = _fields(head)
        left = int(f["content-length"])
        size = left
        if f.get("content-type", "").startswith("application/http"):
            http = src.until(b"\r\n\r\n")
            left -= len(http)
            size = int(_fields(http).get("content-length", left))
        digest, done, number = hashlib.sha1(), 0, 0
        stated = f.get("warc-payload-digest", "")
        stated = base64.b32decode(stated[5:]).hex() if stated.startswith("sha1:") else None
        whole = (f.get("warc-record-id"), f.get("warc-type"), f.get("warc-refers-to"), f.get("warc-target-uri"), stated, size)
        while True:
            parts, have = [], 0
            while have < min(chunk_bytes, left):
                part = src.some(min(chunk_bytes, left) - have)
                parts.append(part)
                have += len(part)
                digest.update(part)
            left -= have
            done += have
            yield *whole, number, parts, digest.hexdigest(), done, left == 0
            number += 1
            if not left:
                break
        if src.until(b"\r\n\r\n") != b"\r\n\r\n":
            raise ValueError("record longer than its Content-Length")


_CHUNKS = ("record_id string, record_type string, refers_to string, url string, stated_sha1 string, stated_bytes long, "
           "chunk long, bytes_so_far long, running_sha1 string, last boolean, data binary")


def record_chunks(manifest: DataFrame, chunk_bytes: int = 1 << 20, with_data: bool = True) -> DataFrame:
    """The chunked record table of the archives that ``manifest`` names (column ``file``): one row per
    (record, chunk); a record without payload has one empty chunk. ``with_data=False`` leaves the bytes out."""
    names = [c.split()[0] for c in _CHUNKS.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}
    schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in _CHUNKS.split(", ")])
    spark = manifest.sparkSession
    n = max(1, manifest.count())

    def run(batches):
        rows, held = [], 0
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                folder, _, name = uri.rpartition("/")
                where, path = _open_folder(folder)
                with where.open_input_stream(f"{path}/{name}", compression=None) as raw:
                    for rid, kind, refers, url, stated, size, k, parts, sha, done, last in read_chunks(raw, chunk_bytes):
                        data = b"".join(parts) if with_data else None
                        rows.append((rid, kind, refers, url, stated, size, k, done, sha, last, data))
                        held += len(data or b"") + 500
                        if held > 4 * chunk_bytes:
                            yield pa.RecordBatch.from_pydict(dict(zip(names, zip(*rows))), schema=schema)
                            rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pydict(dict(zip(names, zip(*rows))), schema=schema)

    # One task per archive: files are dealt by range of their names, which are distinct.
    files = manifest.select("file").repartitionByRange(min(n, 100_000), "file")
    return files.mapInArrow(run, _CHUNKS)


def archive_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                  min_revisit: int = 1000, folder: str | None = None) -> DataFrame:
    """Writes one record per row and returns the manifest of the archives.

    Null html is an empty payload, null urls have no target line, null ids an empty name. Of equal payloads
    of ``min_revisit`` bytes or more the largest id keeps the payload (rows that repeat that id and payload
    are all written in full; if all ids are null, all are). An empty table gives an empty manifest.
    """
    folder = folder or new_work_dir(pages.sparkSession, "warc")
    where, path = _open_folder(folder)
    where.create_dir(path, recursive=True)
    return write_archives(choose_records(pages, id_col, url_col, html_col, min_revisit), folder)


def page_of(name):
    """The page id in a record name, as text (null if empty)."""
    return F.nullif(F.url_decode(F.regexp_extract(name, r"^<urn:x-page:(.*):[0-9a-f]+>$", 1)), F.lit(""))
