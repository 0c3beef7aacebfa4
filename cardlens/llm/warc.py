"""WARC archives: a record per page, one gzip member per record, read in sequence.

*Writing* (:func:`write_archives`): payload digests are grouped with partial
aggregation; of equal payloads of at least ``min_bytes`` the smallest id is
the response, the others become revisits that carry its HTTP header only. Each
task writes one archive of its rows to the shared folder under a name of its
own attempt, and the manifest (a written table) lists the archives of the
attempts that counted; files of lost or repeated attempts are never read.

*Reading* (:func:`read_archives`): one task streams through an archive in
chunks: it inflates a member at a time, takes the header up to the empty
line, then exactly ``Content-Length`` bytes, and checks the block digest, the
payload digest and the record's end. Memory holds one record and one chunk.

Archives live wherever ``pyarrow.fs`` can write (file, HDFS, S3, GCS).

Defined cases: a null payload is empty; of rows that repeat the smallest id, all
are responses; a null id comes last (a group of null ids only: all are
responses); a null or empty URL is written as ``urn:page:<id>``; control
characters and spaces in a URL are percent-encoded; other columns are
ignored; an empty table gives an empty manifest and no records.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlens.llm.scratch import cut
from cardlens.session import ensure_checkpoint_dir

CHUNK = 1 << 16  # bytes read from an archive at a time
ROWS_BYTES = 1 << 24  # payload bytes of a batch of records
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2026-01-01T00:00:00Z"  # the pages carry no capture time


# -- one record ---------------------------------------------------------------
def _uri(url: str | None, page_id) -> str:
    text = url or f"urn:page:{page_id}"
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def http_header(size: int) -> bytes:
    return (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n"
    ).encode()


def record(page_id, url: str | None, payload: bytes | None, digest: str, size: int, refers_to) -> bytes:
    """One gzip member. ``payload`` is None for a revisit."""
    kind = "response" if payload is not None else "revisit"
    block = http_header(size) + (payload or b"")
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", _uri(url, page_id)),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if kind == "revisit":
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    head = VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head + block + b"\r\n\r\n") + packer.flush()


# -- an archive ---------------------------------------------------------------
class Members:
    """Bytes of an archive, inflated a chunk at a time, one gzip member after
    another. ``source(n)`` returns up to n bytes, none at the end."""

    def __init__(self, source):
        self.source, self.raw, self.out = source, b"", bytearray()
        self.unzip = None

    def _more(self) -> bool:
        """Inflate some more of the current member; False at its end."""
        while not self.unzip.eof:
            self.raw = self.raw or self.source(CHUNK)
            if not self.raw:
                raise ValueError("archive ends inside a gzip member")
            got = self.unzip.decompress(self.raw, CHUNK)
            self.raw = self.unzip.unused_data if self.unzip.eof else self.unzip.unconsumed_tail
            if got:
                self.out += got
                return True
        return False

    def open(self) -> bool:
        """Start the next member; False at the end of the archive."""
        self.raw = self.raw or self.source(CHUNK)
        if not self.raw:
            return False
        self.unzip, self.out = zlib.decompressobj(31), bytearray()
        return True

    def until(self, mark: bytes) -> bytes:
        at = 0
        while (end := self.out.find(mark, at)) < 0:
            at = max(0, len(self.out) - len(mark))
            if not self._more():
                raise ValueError("record without an end of header")
        found = bytes(self.out[: end + len(mark)])
        del self.out[: end + len(mark)]
        return found

    def exactly(self, n: int) -> bytes:
        while len(self.out) < n:
            if not self._more():
                raise ValueError(f"record block of {len(self.out)} bytes, {n} announced")
        found = bytes(self.out[:n])
        del self.out[:n]
        return found

    def close(self) -> None:
        while self._more():
            pass
        if self.out != b"\r\n\r\n":
            raise ValueError("record does not end in two empty lines")


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")
    return {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if x)}


def records(source) -> Iterator[tuple[dict[str, str], dict[str, str], bytes]]:
    """WARC fields, HTTP fields and payload of each record, in order. Raises
    ValueError on a broken member, frame or digest."""
    archive = Members(source)
    while archive.open():
        head = archive.until(b"\r\n\r\n")
        if not head.startswith(VERSION):
            raise ValueError(f"no WARC record: {head[:20]!r}")
        fields = _fields(head)
        block = archive.exactly(int(fields["content-length"]))
        archive.close()
        if fields["warc-block-digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
            raise ValueError(f"block digest of {fields['warc-record-id']} does not fit")
        http, _, payload = block.partition(b"\r\n\r\n")
        if fields["warc-type"] == "response":
            if fields["warc-payload-digest"] != f"sha256:{hashlib.sha256(payload).hexdigest()}":
                raise ValueError(f"payload digest of {fields['warc-record-id']} does not fit")
        yield fields, _fields(http), payload


# -- jobs -----------------------------------------------------------------------
def plan_records(
    pages: DataFrame, min_bytes: int, id_col: str, payload_col: str
) -> DataFrame:
    """``first_digest, first_id``: of each payload that several rows share, the
    digest and the id of its response. Only digests are shuffled."""
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    rows = pages.select(
        F.col(id_col).alias("first_id"),
        F.octet_length(payload).alias("size"),
        F.sha2(payload, 256).alias("first_digest"),
    )
    shared = rows.filter(F.col("size") >= min_bytes).groupBy("first_digest")
    return shared.agg(F.min("first_id").alias("first_id"), F.count("*").alias("n")).filter("n > 1").drop("n")


def write_archives(
    pages: DataFrame,
    folder: str,
    min_bytes: int = 100,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
) -> DataFrame:
    """Write the archives under ``folder`` (a URI on storage that all executors
    share); returns the manifest ``path, n_records, n_bytes``, already written.

    Rows look up their response in the written table of shared digests: Spark
    broadcasts it if the files are under its threshold, else it shuffles both
    sides and splits the partition of a payload that very many rows share."""
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    rows = pages.select(
        F.col(id_col).alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        payload.cast("binary").alias("payload"),
        F.octet_length(payload).cast("long").alias("size"),
        F.sha2(payload, 256).alias("digest"),
    )
    shared = cut(plan_records(pages, min_bytes, id_col, payload_col), "shared")
    first = F.col("first_id")
    joined = rows.join(
        shared, (F.col("digest") == F.col("first_digest")) & (F.col("size") >= min_bytes), "left"
    )
    again = first.isNotNull() & ~F.col("page_id").eqNullSafe(first)
    records_of = joined.select(
        F.col("page_id").cast("string").alias("page_id"),
        "url",
        F.when(~again, F.col("payload")).alias("payload"),
        "size",
        "digest",
        F.when(again, first).cast("string").alias("refers_to"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(folder)
        fs.create_dir(base, recursive=True)
        name, out, n = f"part-{uuid.uuid4().hex}.warc.gz", None, 0
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                out.write(record(row["page_id"], row["url"], row["payload"], row["digest"], row["size"], row["refers_to"]))
                n += 1
        if out is not None:
            size = out.tell()
            out.close()
            yield pa.RecordBatch.from_pylist([{"path": f"{folder}/{name}", "n_records": n, "n_bytes": size}])

    return cut(records_of.mapInArrow(run, "path string, n_records long, n_bytes long"), "manifest")


def read_archives(manifest: DataFrame) -> DataFrame:
    """Every record of the archives that ``manifest`` lists: ``page_id string,
    url, record_type, payload_bytes, payload_digest, refers_to string, payload``
    (null payload for a revisit, whose HTTP header gives the full length)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [(c, pa.string()) for c in ("page_id", "url", "record_type")]
            + [("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.string()), ("payload", pa.binary())]
        )
        for batch in batches:
            for path in batch.column("path").to_pylist():
                fs, name = pafs.FileSystem.from_uri(path)
                with fs.open_input_stream(name, compression=None) as f:
                    rows, size = [], 0
                    for fields, http, payload in records(f.read):
                        whole = fields["warc-type"] == "response"
                        refers = fields.get("warc-refers-to")
                        rows.append(
                            {
                                "page_id": fields["warc-record-id"][10:-1] or None,
                                "url": fields["warc-target-uri"],
                                "record_type": fields["warc-type"],
                                "payload_bytes": len(payload) if whole else int(http["content-length"]),
                                "payload_digest": fields["warc-payload-digest"].removeprefix("sha256:"),
                                "refers_to": refers and refers[10:-1],
                                "payload": payload if whole else None,
                            }
                        )
                        size += len(payload)
                        if len(rows) >= 1000 or size >= ROWS_BYTES:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, size = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema)

    spread = manifest.repartition(max(1, manifest.count()))
    return spread.mapInArrow(
        run,
        "page_id string, url string, record_type string, payload_bytes long, payload_digest string, "
        "refers_to string, payload binary",
    )


def archive_folder(df: DataFrame) -> str:
    """A new folder for archives in the cluster's shared checkpoint folder."""
    base = ensure_checkpoint_dir(df.sparkSession).rstrip("/")
    base = base if ":/" in base else f"file://{base}"
    return f"{base.replace('file:///', 'file:/').replace('file:/', 'file:///')}/warc-{uuid.uuid4().hex}"
