"""WARC archives: written from pages, and read back sequentially.

An archive is a gzip member per record.  The reader decompresses member by
member in small steps, frames the record by its Content-Length and checks the
block and payload digests as the bytes pass, so its memory does not depend on
the sizes of archives or records.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK = 1 << 16
HEADER_MOST = 1 << 20
ARCHIVE_BYTES = 256 << 20
LEVEL = 3
TASKS_MOST = 20_000
DATE = "2020-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
URN = "urn:x-page:"
END = b"\r\n\r\n"


class WarcError(ValueError):
    """The archive is not what its headers say."""


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record(page_id: int | None, url: str | None, payload: bytes | None, length: int, digest: str,
           refers_to: int | None = None) -> bytes:
    """One record as a gzip member: a response with its payload, or (payload None) a revisit without."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    block = http + (payload or b"")
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if payload is None else 'response'}",
             f"WARC-Record-ID: <{URN}{page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~')}")
    if payload is None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{URN}{refers_to}>"]
    lines += [f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{base32(hashlib.sha1(block).digest())}",
              "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(LEVEL, wbits=31)
    return packer.compress("\r\n".join(lines).encode() + END) + packer.compress(block + END) + packer.flush()


class _Bytes:
    """The decompressed bytes of one gzip member after another."""

    def __init__(self, stream):
        self.stream, self.raw, self.member = stream, b"", None

    def next_member(self) -> bool:
        """Goes to the next member; False at the archive's end."""
        self.raw = self.raw or self.stream.read(CHUNK)
        self.member = zlib.decompressobj(wbits=31) if self.raw else None
        return bool(self.raw)

    def read(self) -> bytes:
        """Some bytes of the member, at most CHUNK; b'' at its end."""
        while not self.member.eof:
            self.raw = self.raw or self.stream.read(CHUNK)
            if not self.raw:
                raise WarcError("the archive ends within a gzip member")
            try:
                out = self.member.decompress(self.raw, CHUNK)
            except zlib.error as e:
                raise WarcError(f"bad gzip member: {e}") from e
            self.raw = self.member.unused_data if self.member.eof else self.member.unconsumed_tail
            if out:
                return out
        return b""


def _fields(header: bytes) -> tuple[str, dict[str, str]]:
    first, *lines = header.decode("utf-8", "replace").split("\r\n")
    return first, {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def read_archive(stream, payloads: bool = False) -> Iterator[dict]:
    """The records of an archive in order, each verified: type, id, uri, refers_to, payload_bytes,
    payload_digest, and with ``payloads`` the payload (None for revisits)."""
    source = _Bytes(stream)
    while source.next_member():
        head = b""
        while END not in head:
            if len(head) > HEADER_MOST or not (more := source.read()):
                raise WarcError("no end of the record's header")
            head += more
        header, _, rest = head.partition(END)
        version, fields = _fields(header)
        if not version.startswith("WARC/") or not fields.get("content-length", "").isdigit():
            raise WarcError(f"not a record: {version[:80]!r}")
        left = int(fields["content-length"])
        block, payload, http, kept, size = hashlib.sha1(), hashlib.sha1(), b"", [], 0
        in_http, tail = "application/http" in fields.get("content-type", ""), b""
        http_fields: dict[str, str] = {}
        while True:
            part, tail = rest[:left], tail + rest[left:]
            left -= len(part)
            block.update(part)
            if in_http:
                http += part
                if END in http:
                    http, _, part = http.partition(END)
                    http_fields, in_http = _fields(http)[1], False
                elif len(http) > HEADER_MOST:
                    raise WarcError("no end of the HTTP header")
                else:
                    part = b""
            payload.update(part)
            size += len(part)
            if payloads and part:
                kept.append(part)
            if len(tail) > len(END) or not (rest := source.read()):
                break
        if left or tail != END:
            raise WarcError(f"the record's block isn't framed by its Content-Length {fields['content-length']}")
        revisit = fields.get("warc-type") == "revisit"
        for name, found in (("block", block), *(() if revisit else (("payload", payload),))):
            said = fields.get(f"warc-{name}-digest")
            if said is not None and said != f"sha1:{base32(found.digest())}":
                raise WarcError(f"{name} digest of {fields.get('warc-record-id')}: {said}")
        yield {"type": fields.get("warc-type"), "id": fields.get("warc-record-id", "").strip("<>"),
               "uri": fields.get("warc-target-uri"), "refers_to": fields.get("warc-refers-to", "").strip("<>") or None,
               "payload_bytes": int(http_fields.get("content-length", "0")) if revisit else size,
               "payload_digest": fields.get("warc-payload-digest", "").removeprefix("sha1:"),
               "payload": b"".join(kept) if payloads and not revisit else None}


def with_types(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(page_id, url, html, n, sha1, first): ``first`` is the smallest page_id of the equal payloads.

    Payloads shorter than ``least_bytes`` have no ``first``.  The minimum is
    aggregated before the shuffle, and a payload that very many pages share
    only meets a join that Spark can split.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    p = pages.select("page_id", "url", html.alias("html"), F.octet_length(html).cast("long").alias("n"),
                     F.sha1(html.cast("binary")).alias("sha1"), F.xxhash64(html).alias("_x"))
    same = ["sha1", "_x", "n"]
    firsts = p.filter(F.col("n") >= least_bytes).groupBy(*same).agg(F.min("page_id").alias("first"))
    return p.join(firsts, same, "left").drop("_x")


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes a record per page and returns the manifest (path, records), read from ``folder``.

    ``folder`` must be seen by all executors.  Each task attempt writes
    archives under names of its own, and the manifest, which Spark commits,
    names those of the attempts that count; archives of lost executors are
    left unnamed.
    """
    typed = with_types(pages, least_bytes).select("page_id", "url", "html", "n", "sha1", "first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        out, path, records, size = None, "", 0, 0
        done: list[tuple[str, int]] = []
        for b in batches:
            for page, url, html, n, sha1, first in zip(*[c for c in b.columns], strict=True):
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    path, records, size = f"{folder.rstrip('/')}/{name}", 0, 0
                    store.create_dir(root, recursive=True)
                    out = store.open_output_stream(f"{root.rstrip('/')}/{name}", compression=None)
                page, first = page.as_py(), first.as_py()
                revisit = first is not None and page != first
                member = record(page, url.as_py(), None if revisit else html.as_py().encode("utf-8", "surrogatepass"),
                                n.as_py(), base32(bytes.fromhex(sha1.as_py())), first if revisit else None)
                out.write(member)
                records, size = records + 1, size + len(member)
                if size >= archive_bytes:
                    out.close()
                    out = done.append((path, records))
        if out is not None:
            out.close()
            done.append((path, records))
        if done:
            yield pa.RecordBatch.from_pydict({"path": [d[0] for d in done], "records": [d[1] for d in done]})

    manifest = f"{folder.rstrip('/')}/manifest"
    typed.mapInArrow(run, "path string, records long").write.parquet(manifest)
    return pages.sparkSession.read.parquet(manifest)


def read_archives(spark: SparkSession, manifest: DataFrame, payloads: bool = False, rows_at_once: int = 2000) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to[, payload]) of all archives named.

    Archives are dealt over as many tasks as there are archives, TASKS_MOST at
    most: the few bytes of their names would otherwise be read by one task.
    """
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", *["payload"] * payloads]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), *[pa.binary()] * payloads]
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"

    def number(urn: str | None) -> int | None:
        digits = (urn or "").removeprefix(URN)
        return int(digits) if digits not in ("", "None") else None

    def batch(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for b in batches:
            for path in b.column(0).to_pylist():
                store, place = fs.FileSystem.from_uri(path)
                with store.open_input_stream(place, compression=None) as stream:
                    for r in read_archive(stream, payloads):
                        row = (number(r["id"]), r["uri"], r["payload_bytes"], r["payload_digest"], r["type"],
                               number(r["refers_to"]))
                        rows.append((*row, r["payload"]) if payloads else row)
                        held += len(r["payload"] or b"")
                        if len(rows) >= rows_at_once or held > ARCHIVE_BYTES >> 4:
                            yield batch(rows)
                            rows, held = [], 0
        if rows:
            yield batch(rows)

    files = manifest.select("path").repartition(max(1, min(manifest.count(), TASKS_MOST)), "path")
    return files.mapInArrow(run, schema + ", payload binary" * payloads)


def archive_round_trip(pages: DataFrame, folder: str, least_bytes: int = 0, payloads: bool = False) -> DataFrame:
    """The records of ``pages`` (page_id, url, html) after writing them to archives in ``folder`` and reading those.

    A null html is an empty payload.  Of equal payloads of ``least_bytes`` or
    more, the rows with the smallest page_id are responses and the others
    revisit it; shorter ones are all responses.  Without any page_id there is
    nothing to refer to: such records are responses; a null page_id beside
    others revisits.  Repeated rows of the smallest page_id are all responses.
    An empty table gives an empty result; other columns are ignored.
    """
    return read_archives(pages.sparkSession, write_archives(pages, folder, least_bytes), payloads)


def oracle(pages: str = "pages") -> str:
    """DuckDB SQL of the round trip; SHA-1 in base32 from five hex digits (four letters) at a time."""
    letters = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((v[{g + 1}] >> {s}) & 31)::INT, 1)"
                          for g in range(8) for s in (15, 10, 5, 0))
    groups = ", ".join(f"('0x' || substr(h, {5 * g + 1}, 5))::BIGINT" for g in range(8))
    return f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM {pages}),
f AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS first FROM p), d AS (SELECT *, [{groups}] AS v FROM f)
SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, {letters} AS payload_digest,
  CASE WHEN first IS DISTINCT FROM page_id AND first IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first IS DISTINCT FROM page_id THEN first END AS refers_to FROM d"""
