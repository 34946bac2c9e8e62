"""Operator 4: a deterministic, sharded WARC writer and its reader.

Files are written by the executors below one shared folder through
``pyarrow.fs`` (local or any store it knows by URI). Every record is a gzip
member of its own with a fixed time stamp, so equal input gives equal bytes.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import new_folder, written

ENTRY = "final string, temp string, shard long, seq long, records long, bytes long, sha256 string"
RECORD = ("page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, "
          "payload string, file string")
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
READ_BYTES = 1 << 20


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def _line(value: str) -> str:
    """A header value on one line, in characters a header may hold."""
    return "".join(ch if 32 < ord(ch) < 127 else "".join(f"%{b:02X}" for b in ch.encode("utf-8", "replace"))
                   for ch in value)


def _record(kind: str, page_id: int | None, url: str, payload: bytes, digest: str, first: int | None,
            date: str) -> bytes:
    http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http + (payload if kind == "response" else b"")
    rid = uuid.uuid5(_NAMESPACE, f"{page_id}|{url}|{digest}|{kind}")
    block_digest = base64.b32encode(hashlib.sha1(block).digest()).decode()
    head = [f"WARC/1.1\r\nWARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{rid}>", f"WARC-Date: {date}",
            f"WARC-Target-URI: {_line(url)}", f"WARC-Block-Digest: sha1:{block_digest}",
            f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response"]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if kind == "revisit":
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"X-Refers-To-Page-ID: {first}")
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    c = zlib.compressobj(6, zlib.DEFLATED, 31)  # a gzip member without name or time
    return c.compress(data) + c.flush()


def _writer(folder: str, roll_bytes: int, date: str):
    """Sorted rows of whole shards -> files under temporary names, one manifest entry each."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = _store(folder)
        attempt = uuid.uuid4().hex
        out, entry, first, seen = None, None, {}, set()
        store.create_dir(f"{root}/_tmp", recursive=True)

        def close():
            out.close()
            entry["sha256"] = entry["sha256"].hexdigest()
            return pd.DataFrame([entry])

        shard, seq = None, 0
        for rows in batches:
            for r_shard, page_id, url, html, digest, resp in zip(rows["shard"], rows["page_id"], rows["url"],
                                                                 rows["html"], rows["digest"], rows["resp"]):
                page_id = None if pd.isna(page_id) else int(page_id)
                if r_shard != shard:
                    if out is not None:
                        yield close()
                        out = None
                    shard, seq, first, seen = r_shard, 0, {}, set()
                if not pd.isna(resp):  # a decision, sorted before the page it is about
                    first = {(page_id, digest): int(resp)}
                    continue
                key = (page_id, digest)
                refers = first.get(key)
                kind = "response"
                if refers is not None:
                    kind = "revisit" if refers != page_id or key in seen else "response"
                    if refers == page_id:
                        seen = {key}
                payload = (html or "").encode("utf-8")
                b32 = base64.b32encode(bytes.fromhex(digest)).decode()
                data = _member(_record(kind, page_id, url or "", payload, b32, refers, date))
                if out is not None and entry["bytes"] >= roll_bytes:
                    yield close()
                    out, seq = None, seq + 1
                if out is None:
                    name = f"part-{shard:012d}-{seq:06d}.warc.gz" if shard >= 0 else f"part-n{-shard:011d}-{seq:06d}.warc.gz"
                    entry = {"final": name, "temp": f"_tmp/{name}.{attempt}", "shard": shard, "seq": seq,
                             "records": 0, "bytes": 0, "sha256": hashlib.sha256()}
                    out = store.open_output_stream(f"{root}/{entry['temp']}", compression=None)
                out.write(data)
                entry["sha256"].update(data)
                entry["records"] += 1
                entry["bytes"] += len(data)
        if out is not None:
            yield close()

    return write


def _committer(folder: str):
    """Move each file to its final name; doing it again does nothing."""

    def commit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = _store(folder)
        for rows in batches:
            for temp, final in zip(rows["temp"], rows["final"]):
                if store.get_file_info(f"{root}/{temp}").type != pafs.FileType.NotFound:
                    store.move(f"{root}/{temp}", f"{root}/{final}")
                elif store.get_file_info(f"{root}/{final}").type == pafs.FileType.NotFound:
                    raise FileNotFoundError(f"{folder}/{final}: neither written nor committed")
            yield rows

    return commit


def write_warc(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html",
               min_revisit_bytes: int = 0, shard_rows: int = 2048, roll_bytes: int = 32 << 20,
               date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write ``pages`` as gzipped WARC files below ``folder`` and commit.

    A shard is a range of ``shard_rows`` page ids, written in the order
    (page id, payload digest, url) by one task and rolled to a new file when
    the compressed size reaches ``roll_bytes``; shards and file names
    depend on the rows alone, not on the number of executors. Files are
    written under temporary names (one per task attempt); the written
    manifest of the attempts that succeeded decides which of them get their
    final names, so a lost executor or a speculative twin leaves nothing in
    the final names but its equal twin. Returns the manifest (``final, shard,
    seq, records, bytes, sha256``), also stored as ``folder/manifest``.

    Of records with equal payloads of at least ``min_revisit_bytes`` bytes
    the one with the smallest page id is the response and the others are
    revisits; smaller payloads are always responses. The payload is
    shuffled once: the decisions travel as narrow rows beside the pages.

    Null html: an empty payload. Null url: an empty target. Null page id:
    written without an id, spread over shards of their own by payload hash;
    a page without an id is never referred to, but may be a revisit.
    Repeated rows: the first is the response, the rest revisits of the same
    id. No rows: an empty manifest. Extra columns are ignored.
    """
    spark = pages.sparkSession
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    shard = F.coalesce(F.floor(F.col(page_id) / shard_rows), -1 - F.pmod(F.xxhash64(html), F.lit(1 << 20)))
    base = pages.select(shard.cast("long").alias("shard"), F.col(page_id).cast("long").alias("page_id"),
                        F.col(url).alias("url"), F.col(html).alias("html"), F.sha1(payload).alias("digest"))
    narrow = (pages.where(F.length(payload) >= min_revisit_bytes)
              .select(shard.cast("long").alias("shard"), F.col(page_id).cast("long").alias("page_id"),
                      F.unhex(F.sha1(payload)).alias("sha")))
    first = (narrow.groupBy("sha").agg(F.min("page_id").alias("resp"), F.count(F.lit(1)).alias("n"))
             .where("n > 1 and resp is not null").drop("n"))
    # Ids repeat only for repeated rows, so this is about a row per copy.
    decisions = (narrow.join(first, "sha").groupBy("shard", "page_id", "sha").agg(F.min("resp").alias("resp"))
                 .select("shard", "page_id", F.lit(None).cast("string").alias("url"),
                         F.lit(None).cast("string").alias("html"), F.lower(F.hex("sha")).alias("digest"), "resp"))
    rows = (base.withColumn("resp", F.lit(None).cast("long")).unionByName(decisions)
            .repartition("shard").sortWithinPartitions("shard", "page_id", "digest", F.col("resp").isNull(), "url"))
    entries = written(rows.mapInPandas(_writer(folder, roll_bytes, date), ENTRY), "warc-entries")
    done = entries.repartition("final").mapInPandas(_committer(folder), ENTRY)
    manifest = done.select("final", "shard", "seq", "records", "bytes", "sha256")
    manifest.write.parquet(f"{folder}/manifest")
    store, root = _store(folder)
    if store.get_file_info(f"{root}/_tmp").type == pafs.FileType.Directory:
        store.delete_dir(f"{root}/_tmp")  # what lost attempts left
    return spark.read.schema(manifest.schema).parquet(f"{folder}/manifest")


def _members(store: pafs.FileSystem, path: str) -> Iterator[bytes]:
    """The decompressed members of a file, one at a time."""
    with store.open_input_stream(path, compression=None) as f:
        z, parts = zlib.decompressobj(31), []
        data = f.read(READ_BYTES)
        while data:
            parts.append(z.decompress(data))
            data = z.unused_data if z.eof else b""
            if z.eof:
                yield b"".join(parts)
                z, parts = zlib.decompressobj(31), []
            data = data or f.read(READ_BYTES)
        if parts:
            raise ValueError(f"{path}: ends inside a record")


def _parse(data: bytes) -> dict:
    head, _, rest = data.partition(b"\r\n\r\n")
    h = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[:int(h["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    kind, digest = h["WARC-Type"], h["WARC-Payload-Digest"].removeprefix("sha1:")
    if base64.b32encode(hashlib.sha1(block).digest()).decode() != h["WARC-Block-Digest"].removeprefix("sha1:"):
        raise ValueError(f"block digest of {h['WARC-Record-ID']}")
    if kind == "response" and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
        raise ValueError(f"payload digest of {h['WARC-Record-ID']}")
    size = dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"]
    number = lambda k: int(h[k]) if h.get(k, "None") != "None" else None
    return {"page_id": number("X-Page-ID"), "url": h["WARC-Target-URI"], "record_type": kind,
            "payload_bytes": int(size), "payload_digest": digest, "refers_to": number("X-Refers-To-Page-ID"),
            "payload": payload.decode("utf-8") if kind == "response" else None}


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """The records of the files that the manifest of ``folder`` names, one
    row each, with block and payload digests verified. A file is streamed
    record by record by one task; files are bounded by ``roll_bytes`` plus
    one record."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = _store(folder)
        for rows in batches:
            for name in rows["final"]:
                some, size = [], 0
                for data in _members(store, f"{root}/{name}"):
                    some.append(_parse(data) | {"file": name})
                    size += len(data)
                    if size > 4 * READ_BYTES:
                        yield _frame(some)
                        some, size = [], 0
                if some:
                    yield _frame(some)

    files = spark.read.parquet(f"{folder}/manifest").select("final")
    # A task per file: adaptive execution would merge these tiny rows into one task.
    return files.repartition(max(1, files.count()), "final").mapInPandas(read, RECORD)


def _frame(rows: list[dict]) -> pd.DataFrame:
    df = pd.DataFrame(rows)
    for c in ("page_id", "refers_to"):
        df[c] = df[c].astype("Int64")
    return df


def archive(pages: DataFrame, **options) -> DataFrame:
    """Write ``pages`` to a fresh shared folder and read the records back."""
    folder = new_folder(pages.sparkSession, "warc")
    write_warc(pages, folder, **options)
    return read_warc(pages.sparkSession, folder)
