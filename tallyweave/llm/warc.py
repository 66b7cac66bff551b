"""WARC archives with revisit records, and a two-level capture index: sorted compressed blocks, and a sparse directory for each index file; both are bisected before range reads."""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.llm.common import checkpointed, discard, file_system, pieces, qualified, shared_dir, table, text_map, utf8

#: Index lines of a block; directories of index files that a reader keeps.
BLOCK_LINES, HELD_DIRECTORIES = 500, 8
DATE = "2024-01-01T00:00:00Z"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def url_key(url: str | None) -> str:
    """The sort key of a URL: its host's labels reversed, then the rest, so that a domain's captures stand together. Null: empty."""
    head, mark, rest = (url or "").partition("://")
    if not mark:
        return (url or "").replace("\n", "%0A").replace(" ", "%20").replace("\r", "%0D")
    cut = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    host, _, port = rest[:cut].lower().partition(":")
    key = ",".join(reversed(host.split("."))) + (f":{port}" if port else "") + ")" + (rest[cut:] or "/")
    return key.replace("\n", "%0A").replace("\r", "%0D").replace(" ", "%20")


def record_bytes(page_id, url: str | None, kind: str, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC record as a gzip member. A revisit holds the digest and the length of the payload, not the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http + (payload if kind == "response" else b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    head += ["Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest}"]
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head.append(f"Content-Length: {len(body)}")
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n", 6, mtime=0)


def read_record(member: bytes) -> dict:
    """What a record says: id, url, kind, digest, refers_to, payload (None for a revisit) and payload_bytes."""
    raw = gzip.decompress(member)
    end = raw.index(b"\r\n\r\n")
    head = dict(line.split(": ", 1) for line in raw[:end].decode().split("\r\n")[1:])
    body = raw[end + 4 : end + 4 + int(head["Content-Length"])]
    cut = body.index(b"\r\n\r\n")
    length = int(next(x for x in body[:cut].split(b"\r\n") if x.startswith(b"Content-Length"))[15:])
    part = lambda name: head[name][len("<urn:page:") : -1] if name in head else None
    return {
        "id": part("WARC-Record-ID") or None, "url": head.get("WARC-Target-URI"), "kind": head["WARC-Type"], "digest": head["WARC-Payload-Digest"].removeprefix("sha1:"),
        "refers_to": part("WARC-Refers-To"), "payload": body[cut + 4 :] if head["WARC-Type"] == "response" else None, "payload_bytes": length,
    }


def place(key: str, page_id) -> tuple:
    """Where a capture stands in the index: by its key, then by its id; null ids come first."""
    return key, page_id is not None, page_id or 0


@dataclass
class Archive:
    """folder: where archives, index blocks and directories are. top: first place and name of each index file, sorted; there is one for each task that wrote the index."""

    folder: str
    top: list[tuple[tuple, str]]


class Index:
    """A reader of an archive's index: bisects the index files, the sparse directory of a file and the lines of a block. It keeps the directories and the block it read last."""

    def __init__(self, archive: Archive) -> None:
        self.fs, self.path = file_system(archive.folder)
        self.top, self.firsts = archive.top, [x[0] for x in archive.top]
        self.opened: dict = {}
        self.directories: dict[str, tuple[list, list]] = {}
        self.block: tuple = (None, None, None)

    def read(self, file: str, at: int, size: int) -> bytes:
        return _range(self.fs, self.path, file, at, size, self.opened)

    def directory(self, name: str) -> tuple[list, list]:
        """First places and (offset, length) of the blocks of an index file."""
        if name not in self.directories:
            if len(self.directories) >= HELD_DIRECTORIES:
                self.directories.pop(next(iter(self.directories)))
            with self.fs.open_input_file(f"{self.path}/{name}.dir") as file:
                rows = [json.loads(x) for x in gzip.decompress(file.read()).decode().split("\n")[:-1]]
            self.directories[name] = [place(key, i) for key, i, _, _ in rows], [(at, size) for _, _, at, size in rows]
        return self.directories[name]

    def lines(self, name: str, at: int, size: int) -> tuple[list, list]:
        """Places and (file, offset, length) of the captures of a block."""
        if self.block[0] != (name, at):
            rows = [(key, json.loads(rest)) for key, _, rest in (x.partition(" ") for x in gzip.decompress(self.read(f"{name}.cdx.gz", at, size)).decode().split("\n")[:-1])]
            self.block = (name, at), [place(key, rest[0]) for key, rest in rows], [tuple(rest[1:]) for _, rest in rows]
        return self.block[1:]

    def find(self, low: tuple, high: tuple) -> Iterator[tuple[str, int, int]]:
        """(file, offset, length) of the captures at places from low to high. What equals low can begin at the end of the block before the first that does."""
        for f in range(max(0, bisect.bisect_left(self.firsts, low) - 1), bisect.bisect_right(self.firsts, high)):
            name = self.top[f][1]
            firsts, blocks = self.directory(name)
            for i in range(max(0, bisect.bisect_left(firsts, low) - 1), bisect.bisect_right(firsts, high)):
                places, captures = self.lines(name, *blocks[i])
                yield from captures[bisect.bisect_left(places, low) : bisect.bisect_right(places, high)]


def write(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_bytes: int = 0, folder: str | None = None) -> Archive:
    """Writes a record for each row of pages and the index of the captures.

    Of rows with equal payloads of least_bytes or more, that with the smallest id is a response and the
    others revisit it; rows that repeat its id are responses too, and so are rows with a null id if no
    other has the payload. Null payloads are empty; each row gives a record, an empty table an archive
    without records. A task writes files of its own names: what a lost or repeated task leaves behind is
    in no index. A folder without a scheme is in Spark's default file system.
    """
    folder = qualified(pages.sparkSession, (folder or f"{shared_dir(pages.sparkSession)}/tallyweave-warc/{uuid.uuid4().hex}").rstrip("/"))
    fs, path = file_system(folder)
    fs.create_dir(path, recursive=True)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            payload = utf8(batch.column(2))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(payload, pa.binary()), pa.array([len(x) for x in payload], pa.int64()), pa.array([payload_digest(x) for x in payload])], ["id", "url", "payload", "n", "digest"])

    rows = text_map(pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), F.col(payload_col).alias("payload")), ["id", "url", "payload"], digests, "id long, url string, payload binary, n long, digest string")
    # Only digests of several rows; written, so that Spark can split a payload that a third of all rows have.
    first = checkpointed(rows.where(F.col("n") >= least_bytes).groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("c")).where("c > 1").drop("c"))
    rows = rows.join(first, "digest", "left").select("id", "url", "payload", "digest", F.when(F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("id")), F.col("first")).alias("first"))

    def archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = file_system(folder)
        name, at, out = f"{uuid.uuid4().hex}.warc.gz", 0, None
        try:
            for batch in pieces(batches, 256):
                lines = []
                for i, url, payload, digest, first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    out = out or fs.open_output_stream(f"{path}/{name}", compression=None)
                    member = record_bytes(i, url, "response" if first is None else "revisit", payload, digest, first)
                    out.write(member)
                    lines.append((url_key(url), i, name, at, len(member)))
                    at += len(member)
                columns = list(zip(*lines, strict=True)) or [()] * 5
                kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["key", "id", "file", "at", "size"])
        finally:
            if out:
                out.close()

    lines = checkpointed(rows.mapInArrow(archives, "key string, id long, file string, at long, size long"))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = file_system(folder)
        name, at, out, held, fences = uuid.uuid4().hex, 0, None, [], []

        def close(held: list[tuple]) -> None:
            nonlocal at, out
            out = out or fs.open_output_stream(f"{path}/{name}.cdx.gz", compression=None)
            member = gzip.compress("".join(f"{key} {json.dumps(rest)}\n" for key, *rest in held).encode(), 6, mtime=0)
            out.write(member)
            fences.append((held[0][0], held[0][1], at, len(member)))
            at += len(member)

        try:
            for batch in batches:
                for line in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    held.append(line)
                    if len(held) == BLOCK_LINES:
                        close(held)
                        held = []
            if held:
                close(held)
        finally:
            if out:
                out.close()
        if fences:
            with fs.open_output_stream(f"{path}/{name}.dir", compression=None) as file:
                file.write(gzip.compress("".join(json.dumps(x) + "\n" for x in fences).encode(), 6, mtime=0))
            yield pa.RecordBatch.from_arrays([pa.array([fences[0][0]], pa.string()), pa.array([fences[0][1]], pa.int64()), pa.array([name], pa.string())], ["key", "id", "name"])

    ordered = lines.repartitionByRange("key", "id").sortWithinPartitions("key", "id", "file", "at")
    top = [(place(r["key"], r["id"]), r["name"]) for r in ordered.mapInArrow(blocks, "key string, id long, name string").collect()]
    discard(lines, first)
    return Archive(folder, sorted(top))


def _range(fs, path: str, file: str, at: int, size: int, opened: dict | None = None) -> bytes:
    opened = {} if opened is None else opened
    if file not in opened:
        if len(opened) > 64:
            opened.popitem()[1].close()
        opened[file] = fs.open_input_file(f"{path}/{file}")
    return opened[file].read_at(size, at)


def lookup(archive: Archive, url: str) -> list[dict]:
    """The records of a URL, by bisection and range reads. Revisits come with the payload of what they revisit only if asked for by its own URL."""
    index, key = Index(archive), url_key(url)
    return [read_record(index.read(*x)) for x in index.find((key, False, 0), (key, True, float("inf")))]


def read_back(archive: Archive, pages: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, url) of the records of all url and id pairs of pages; pairs without a record give no row, repeated pairs their records once.

    The pairs are sorted, so that a task reads each block of the index once; each pair is found by
    bisection of the index files, the directory and the block, and its records by range reads. Digest
    and length of responses are those of the payload read; a record that doesn't hold its digest raises
    ValueError.
    """

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([url_key(x) for x in batch.column(0).to_pylist()], pa.string()), batch.column(1)], ["key", "id"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(archive)
        number = lambda x: None if x is None else int(x)
        for batch in pieces(batches):
            wanted = [place(*x) for x in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            got = []
            for x in sorted(c for p in wanted for c in index.find(p, p)):
                r = read_record(index.read(*x))
                if r["payload"] is not None and (payload_digest(r["payload"]) != r["digest"] or len(r["payload"]) != r["payload_bytes"]):
                    raise ValueError(f"record {r['id']} doesn't hold its digest")
                got.append((number(r["id"]), r["payload_bytes"], r["digest"], r["kind"], number(r["refers_to"]), r["url"]))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*got, strict=True)) or [()] * 6, kinds, strict=True)], ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"])

    pairs = text_map(pages.select(F.col(url_col).alias("url"), F.col(id_col).cast("long").alias("id")), ["url", "id"], keyed, "key string, id long").distinct()
    dealt = pairs.repartitionByRange("key", "id").sortWithinPartitions("key", "id")
    return dealt.mapInArrow(work, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string")


def _sql() -> str:
    """DuckDB SQL for op9_warc's rows: base32 digits of the SHA-1's hex digits, five hex digits (20 bits) at a time."""
    digit = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((x // {d}) % 32)::INTEGER + 1, 1)"
    four = " || ".join(digit.format(d=d) for d in (32768, 1024, 32, 1))
    chunks = " || ".join(f"(SELECT {four} FROM (SELECT ('0x' || substr(sha, {5 * i + 1}, 5))::BIGINT AS x))" for i in range(8))
    return f"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS sha FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY sha) AS first FROM p)
SELECT page_id, payload_bytes, {chunks} AS payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to FROM f
"""


OP9_SQL = _sql()


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return read_back(write(pages), pages).drop("url")
