"""WARC archives: write, normalise monolithic gzip files, index, and read back by offset.

Archives are written as one gzip stream each. The normaliser inflates such a stream once, front to back in
bounded memory, rewrites every record as a gzip member of its own, and writes a sidecar index with the
offset and length of each member; records are then read by seeking to their offset.

All files lie in the shared folder, which has to be mounted on the nodes. A task writes to a temporary name
and renames it, so a retry after a lost executor replaces the same file.

Defined cases: null pages have an empty payload; null urls get the record's own id as target; repeated rows
(equal id and payload) have the same type each; rows with equal payloads and a null id refer to the greatest
id, and are responses if there is none; an empty table gives no archive and an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratovox.llm.common import required, saved, shared_folder

# Fixed values of the format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = b"2024-01-01T00:00:00Z"
GZIP = 31  # zlib's window setting for gzip framing
CHUNK = 1 << 16


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_name(number: int | None) -> bytes:
    return b"<urn:x-page:%s>" % (b"none" if number is None else b"%d" % number)


def record_number(name: str) -> int | None:
    text = name.strip("<>").rpartition(":")[2]
    return None if text == "none" else int(text)


def record(number: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One uncompressed record; a revisit carries the HTTP header without the payload."""
    name = record_name(number)
    target = " ".join(url.split()).encode() if url and url.split() else name.strip(b"<>")
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    lines = [
        VERSION, b"WARC-Type: " + (b"revisit" if revisit else b"response"), b"WARC-Record-ID: " + name, b"WARC-Date: " + DATE,
        b"WARC-Target-URI: " + target, b"WARC-Payload-Digest: sha1:" + base32_sha1(payload).encode(),
        b"Content-Type: application/http; msgtype=response", b"Content-Length: %d" % len(block),
    ]
    if revisit:
        lines += [b"WARC-Profile: " + REVISIT_PROFILE, b"WARC-Refers-To: " + record_name(refers_to)]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


class Inflated:
    """The bytes of a gzip file, one stream or many members, in order and bounded memory."""

    def __init__(self, file):
        self.file, self.stream, self.held = file, zlib.decompressobj(GZIP), b""

    def more(self) -> bool:
        while True:
            data = self.stream.unconsumed_tail or self.stream.unused_data or self.file.read(CHUNK)
            if not data:
                return False
            if self.stream.eof:
                self.stream = zlib.decompressobj(GZIP)
            new = self.stream.decompress(data, 4 * CHUNK)
            if new:
                self.held += new
                return True

    def head(self) -> bytes | None:
        """The next record's header block, None at the end."""
        while True:
            self.held = self.held.lstrip(b"\r\n")  # what ends the record before
            at = self.held.find(b"\r\n\r\n")
            if at >= 0:
                out, self.held = self.held[: at + 4], self.held[at + 4 :]
                return out
            if not self.more():
                if self.held:
                    raise ValueError("the archive ends inside a record's header")
                return None

    def take(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.held and not self.more():
                raise ValueError("the archive ends inside a record")
            part, self.held = self.held[:n], self.held[n:]
            n -= len(part)
            yield part


def headers(head: bytes) -> dict[str, str]:
    pairs = (x.partition(b":") for x in head.split(b"\r\n")[1:] if b":" in x)
    return {k.strip().lower().decode(): v.strip().decode() for k, _, v in pairs}


@dataclass
class Entry:
    """A line of the sidecar index."""

    offset: int
    length: int
    kind: str
    name: str
    target: str = field(default="")

    def line(self) -> bytes:
        return f"{self.offset} {self.length} {self.kind} {self.name} {self.target}\n".encode()


def normalise(source: str, target: str, level: int = 6) -> list[Entry]:
    """Rewrite a gzip archive with one member a record, and write ``target + '.idx'``; the entries, in order."""
    entries: list[Entry] = []
    suffix = f".{os.getpid()}.tmp"
    with open(source, "rb") as file, open(target + suffix, "wb") as out:
        inflated, offset = Inflated(file), 0
        while (head := inflated.head()) is not None:
            fields = headers(head)
            member = zlib.compressobj(level, zlib.DEFLATED, GZIP)
            out.write(member.compress(head))
            for part in inflated.take(int(fields["content-length"])):
                out.write(member.compress(part))
            out.write(member.compress(b"\r\n\r\n") + member.flush())
            entries.append(Entry(offset, out.tell() - offset, fields["warc-type"], fields["warc-record-id"], fields.get("warc-target-uri", "")))
            offset = out.tell()
    with open(target + ".idx" + suffix, "wb") as index:
        index.writelines(e.line() for e in entries)
    os.replace(target + suffix, target)
    os.replace(target + ".idx" + suffix, target + ".idx")
    return entries


def read_member(file, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """(headers, block) of the record in the member at ``offset``."""
    file.seek(offset)
    head, _, rest = zlib.decompress(file.read(length), GZIP).partition(b"\r\n\r\n")
    fields = headers(head)
    return fields, rest[: int(fields["content-length"])]


def planned(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """``(id, url, payload, revisit, refers_to)``: of equal payloads of ``min_bytes`` or more, the greatest id is the response.

    Equal payloads meet by their SHA-1 in a partial aggregation, so a group of any size costs a row for each task.
    """
    payload = F.coalesce(F.col(html_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("sha", F.sha1("payload"))
    named = rows.where(F.length("payload") >= min_bytes).select("id", "sha")
    keep = named.groupBy("sha").agg(F.max("id").alias("keep"), F.count("*").alias("n")).where("n > 1 and keep is not null").drop("n")
    moved = named.join(keep, "sha").where("id is null or id <> keep").distinct().withColumnRenamed("id", "other").withColumnRenamed("sha", "other_sha")
    joined = rows.join(moved, (F.col("sha") == F.col("other_sha")) & F.col("id").eqNullSafe(F.col("other")), "left")
    return joined.select("id", "url", "payload", F.col("keep").isNotNull().alias("revisit"), F.col("keep").alias("refers_to"))


def write(plan: DataFrame, folder: str, level: int = 6) -> DataFrame:
    """Write each task's records as one gzip stream into ``folder`` (of :func:`shared_folder`); ``(path, records)`` of every archive."""
    def store(batches):
        where = required(folder)
        path = f"{where}/pages-{TaskContext.get().partitionId():06d}.warc.gz"
        n, stream, file = 0, zlib.compressobj(level, zlib.DEFLATED, GZIP), None
        suffix = f".{TaskContext.get().taskAttemptId()}.tmp"
        for batch in batches:
            for row in batch.to_pylist():
                if file is None:
                    file = open(path + suffix, "wb")
                file.write(stream.compress(record(row["id"], row["url"], row["payload"], row["refers_to"], row["revisit"])))
                n += 1
        if file is not None:
            file.write(stream.flush())
            file.close()
            os.replace(path + suffix, path)
            yield pa.RecordBatch.from_pydict({"path": [path], "records": pa.array([n], pa.int64())})

    return saved(plan.mapInArrow(store, "path string, records long"), "archives")


def normalised(archives: DataFrame, folder: str, remove_source: bool = False) -> DataFrame:
    """Normalise every archive into ``folder``; the index ``(path, offset, length, kind, name)`` as a table."""
    def rewrite(batches):
        where = required(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                target = f"{where}/{os.path.basename(path)}"
                if not os.path.exists(path) and os.path.exists(target + ".idx"):  # an earlier attempt got here
                    with open(target + ".idx") as index:
                        split = [line.split(" ", 4) for line in index]
                    entries = [Entry(int(a), int(b), c, d) for a, b, c, d, _ in split]
                else:
                    entries = normalise(path, target)
                for i in range(0, len(entries), 10_000):
                    part = entries[i : i + 10_000]
                    yield pa.RecordBatch.from_pydict({
                        "path": [target] * len(part), "offset": pa.array([e.offset for e in part], pa.int64()), "length": pa.array([e.length for e in part], pa.int64()),
                        "kind": [e.kind for e in part], "name": [e.name for e in part],
                    })
                if remove_source and os.path.exists(path):
                    os.remove(path)

    n = archives.count() or 1
    return saved(archives.select("path").repartition(n).mapInArrow(rewrite, "path string, offset long, length long, kind string, name string"), "index")


def read(index: DataFrame) -> DataFrame:
    """Every indexed record, read by its offset: ``id, url, kind, refers_to, payload_bytes, digest, payload``.

    Length and digest of a response are computed from what was read, and must equal what its header says; those
    of a revisit come from its header. ``payload`` is null for revisits.
    """

    def load(batches):
        file, opened = None, None
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                out = {k: [] for k in ("id", "url", "kind", "refers_to", "payload_bytes", "digest", "payload")}
                for row in batch.slice(i, 500).to_pylist():
                    if opened != row["path"]:
                        file, opened = open(row["path"], "rb"), row["path"]
                    fields, block = read_member(file, row["offset"], row["length"])
                    http, _, payload = block.partition(b"\r\n\r\n")
                    size, digest = int(headers(http)["content-length"]), fields["warc-payload-digest"].removeprefix("sha1:")
                    revisit = fields["warc-type"] == "revisit"
                    if not revisit and (size != len(payload) or digest != base32_sha1(payload)):
                        raise ValueError(f"record {fields['warc-record-id']} of {row['path']} is damaged")
                    values = (record_number(fields["warc-record-id"]), fields["warc-target-uri"], fields["warc-type"], record_number(fields["warc-refers-to"]) if revisit else None, size, digest, None if revisit else payload)
                    for column, value in zip(out.values(), values):
                        column.append(value)
                kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds)], names=list(out))

    return index.mapInArrow(load, "id long, url string, kind string, refers_to long, payload_bytes long, digest string, payload binary")


def round_trip(pages: DataFrame, min_bytes: int = 0, **columns) -> DataFrame:
    """Write, normalise, index and read back; the records of :func:`read`. The one-stream archives are removed once normalised."""
    streams, members = (shared_folder(pages.sparkSession, name) for name in ("warc-streams", "warc-members"))
    archives = write(planned(pages, min_bytes=min_bytes, **columns), streams)
    return read(normalised(archives, members, remove_source=True))
