"""10. WARC: a sequential reader, and the writer that its round trips need.

A file is a run of gzip members, one record each (or plain records). The reader inflates a member bit by bit, takes
the header up to the empty line, then as many bytes as Content-Length says, and verifies the block and payload digests
(sha1, base 32). It never holds more than one record. Files are read side by side, one task each.

Defined results: a record that is cut off, isn't gzip, has no length or a length that doesn't fit gets an ``error`` and
what could be read; reading goes on at the next gzip member, if any; an empty file gives no record; digest_ok is null
where the header has none. Writer: a null html becomes a metadata record without a block and reads back as null, an
empty one reads back empty; null page_id and url are left out of the header; repeated rows give repeated records; other
columns are ignored; an empty table gives files with a warcinfo record only.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pandas as pd
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import util

CHUNK = 1 << 16
DATE = "2024-01-01T00:00:00Z"
LEVEL = 4


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


class Stream:
    """Bytes of the records of a file: of one gzip member after another, or of the plain file."""

    def __init__(self, raw: BinaryIO) -> None:
        self.raw, self.rest, self.out = raw, b"", bytearray()
        self.inflate = None
        self.error: str | None = None
        self.plain = False

    def _more(self) -> bytes:
        if self.rest:
            got, self.rest = self.rest, b""
            return got
        return self.raw.read(CHUNK)

    def next_member(self) -> bool:
        """Go to the next member; False at the end of the file."""
        self.error = None
        if self.plain:
            if not self.out:
                self.out += self._more()
            while self.out[:1] in (b"\r", b"\n"):
                del self.out[:1]
                if not self.out:
                    self.out += self._more()
            return bool(self.out)
        while self.inflate is not None and not self.inflate.eof and self.error is None:
            self._fill()  # what follows the record within its member
            self.out.clear()
        self.out.clear()
        head = self._more()
        while len(head) < 5 and (got := self.raw.read(CHUNK)):
            head += got
        if not head:
            return False
        if head[:5] == b"WARC/":
            self.plain = True
            self.out += head
            return True
        self.rest = head
        self.inflate = zlib.decompressobj(31)
        if head[:2] != b"\x1f\x8b":
            self.error = "not gzip"
            self._resync(0)
        return True

    def _resync(self, skip: int) -> None:
        """To the next gzip header."""
        held = self.rest[skip:]
        while True:
            at = held.find(b"\x1f\x8b\x08")
            if at >= 0:
                self.rest = held[at:]
                break
            got = self.raw.read(CHUNK)
            if not got:
                self.rest = b""
                break
            held = held[-2:] + got
        self.inflate = None

    def _fill(self) -> bool:
        if self.plain:
            got = self._more()
            self.out += got
            return bool(got)
        if self.inflate is None or self.inflate.eof or self.error:
            return False
        data = self.inflate.unconsumed_tail or self._more()
        if not data:
            self.error = "truncated"
            self.inflate = None
            return False
        try:
            self.out += self.inflate.decompress(data, CHUNK * 4)
        except zlib.error:
            self.error = "bad gzip"
            self.rest = data
            self._resync(1)
            return False
        if self.inflate.eof:
            self.rest = self.inflate.unused_data + self.rest
        return True

    def until(self, mark: bytes, begin: bytes) -> bytes | None:
        """Up to and with the mark, however far; None where that isn't there or, after empty lines, ``begin`` isn't."""
        at = self.out.find(mark)
        while at < 0:
            head = bytes(self.out[:64]).lstrip(b"\r\n")
            have = len(self.out)
            if not begin.startswith(head[: len(begin)]) or not self._fill():
                return None
            at = self.out.find(mark, max(0, have - len(mark) + 1))
        got = bytes(self.out[: at + len(mark)])
        del self.out[: at + len(mark)]
        return got

    def take(self, n: int) -> bytes:
        while len(self.out) < n and self._fill():
            pass
        got = bytes(self.out[:n])
        del self.out[:n]
        return got


def records(raw: BinaryIO) -> Iterator[dict]:
    """Records in order: headers (lower-case names), block, error."""
    s = Stream(raw)
    while s.next_member():
        if s.error:
            yield {"headers": {}, "block": b"", "error": s.error}
            continue
        head = s.until(b"\r\n\r\n", b"WARC/")
        if head is None or not head.lstrip(b"\r\n").startswith(b"WARC/"):
            yield {"headers": {}, "block": b"", "error": s.error or "no header"}
            if s.plain:
                return
            continue
        headers = {}
        for line in head.lstrip(b"\r\n").decode("utf-8", "replace").split("\r\n")[1:]:
            name, colon, value = line.partition(":")
            if colon:
                headers[name.strip().lower()] = value.strip()
        length = headers.get("content-length", "")
        if not length.isdigit():
            yield {"headers": headers, "block": b"", "error": "no length"}
            if s.plain:
                return
            continue
        block = s.take(int(length))
        error = s.error
        if error is None and len(block) < int(length):
            error = "truncated"
        if error is None and s.take(4) != b"\r\n\r\n":
            error = s.error or "bad length"
        yield {"headers": headers, "block": block, "error": error}


def _parse(r: dict) -> dict:
    h, block = r["headers"], r["block"]
    http, payload = None, block
    if h.get("content-type", "").startswith("application/http"):
        head, gap, body = block.partition(b"\r\n\r\n")
        if gap:
            http, payload = head.split(b"\r\n")[0].decode("latin-1"), body
    checks = [(h[k], v) for k, v in (("warc-block-digest", block), ("warc-payload-digest", payload)) if k in h]
    ok = all(want.lower() == digest(v).lower() for want, v in checks) if checks else None
    page = h.get("warc-page-id")
    kind = h.get("warc-type")
    return {
        "record_type": kind, "page_id": int(page) if page and page.lstrip("-").isdigit() else None, "url": h.get("warc-target-uri"), "date": h.get("warc-date"), "status": http,
        "payload": payload if kind in ("response", "resource", "conversion") else None, "content_length": len(payload) if kind in ("response", "resource", "conversion") else None, "digest_ok": ok, "error": r["error"],
    }


SCHEMA = "record_type string, page_id bigint, url string, date string, status string, payload binary, content_length bigint, digest_ok boolean, error string"


def _read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = [c.split()[0] for c in SCHEMA.split(", ")]

    def frame(rows: list[dict]) -> pd.DataFrame:
        x = pd.DataFrame(rows, columns=columns)
        return x.astype({"page_id": "Int64", "content_length": "Int64", "digest_ok": "boolean"})

    for f in frames:
        for path in f["path"]:
            fs, where = pafs.FileSystem.from_uri(path)
            held, size = [], 0
            with fs.open_input_stream(where, compression=None) as raw:
                for r in records(raw):
                    held.append(_parse(r))
                    size += len(r["block"])
                    if size > 4_000_000 or len(held) >= 1000:
                        yield frame(held)
                        held, size = [], 0
            if held:
                yield frame(held)


def read_warc(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Records of the files, one task for each file."""
    util.make_importable(spark)
    files = spark.createDataFrame([(i, p if "://" in p else "file://" + p) for i, p in enumerate(sorted(paths))], "n int, path string")
    return files.repartitionByRange(max(1, len(paths)), "n").select("path").mapInPandas(_read, SCHEMA)


def record(kind: str, block: bytes, fields: dict[str, str | None], payload: bytes | None = None) -> bytes:
    """A gzip member with one record."""
    seed = "|".join(f"{k}={v}" for k, v in sorted(fields.items())) + digest(block)
    head = {"WARC-Type": kind, "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, seed)}>", "WARC-Date": DATE} | {k: v for k, v in fields.items() if v is not None}
    head["WARC-Block-Digest"] = digest(block)
    if payload is not None:
        head["WARC-Payload-Digest"] = digest(payload)
    head["Content-Length"] = str(len(block))
    data = "WARC/1.0\r\n".encode() + "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode() + b"\r\n" + block + b"\r\n\r\n"
    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def page_record(page_id: int | None, url: str | None, html: str | None) -> bytes:
    fields = {"WARC-Target-URI": None if url is None else url.replace("\r", "%0D").replace("\n", "%0A"), "WARC-Page-ID": None if page_id is None else str(int(page_id))}
    if html is None:
        return record("metadata", b"", fields | {"Content-Type": "application/warc-fields"})
    body = html.encode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n".encode()
    return record("response", http + body, fields | {"Content-Type": "application/http; msgtype=response"}, body)


def write_warc(pages: DataFrame, folder: str) -> list[str]:
    """One file for each partition of pages (page_id, url, html), in a folder that all executors share. A file appears
    under its name only when whole, so a task that runs again does no harm. Returns the paths."""
    util.make_importable(pages.sparkSession)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow as pa  # noqa: F401

        n = TaskContext.get().partitionId()
        fs, where = pafs.FileSystem.from_uri(folder)
        fs.create_dir(where, recursive=True)
        temporary, final = f"{where}/.{n:06d}-{uuid.uuid4().hex}", f"{where}/part-{n:06d}.warc.gz"
        with fs.open_output_stream(temporary, compression=None) as out:
            out.write(record("warcinfo", b"format: WARC File Format 1.0\r\n", {"Content-Type": "application/warc-fields"}))
            for batch in frames:
                for page_id, url, html in zip(batch["page_id"].tolist(), batch["url"].tolist(), batch["html"].tolist()):
                    out.write(page_record(None if pd.isna(page_id) else page_id, url, html))
        fs.move(temporary, final)
        yield pd.DataFrame({"path": [folder.rstrip("/") + f"/part-{n:06d}.warc.gz"]})

    slim = pages.select(F.col("page_id").try_cast("bigint").cast("string").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return sorted(r["path"] for r in slim.mapInPandas(run, "path string").collect())


def round_trip(pages: DataFrame) -> DataFrame:
    """page_id, url, html, content_length, digest_ok of all pages after writing and reading WARC files; a record that
    can't be read stays, with digest_ok = false."""
    spark = pages.sparkSession
    folder = util.new_path(spark, "warc")
    paths = write_warc(pages, folder if "://" in folder else "file://" + folder)
    return _pages(read_warc(spark, paths))


def _pages(got: DataFrame) -> DataFrame:
    ok = F.when(F.col("error").isNull(), F.col("digest_ok")).otherwise(False).alias("digest_ok")
    return got.where("record_type is distinct from 'warcinfo' or error is not null").select("page_id", "url", F.col("payload").cast("string").alias("html"), "content_length", ok)


ORACLE = "select page_id::bigint as page_id, url, html, strlen(html)::bigint as content_length, true as digest_ok from pages"
