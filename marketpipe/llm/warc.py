"""A deterministic sharded WARC writer and its reader.

Records are sorted by range: pages whose ids share page_id div RANGE_PAGES go to one task in id order. A file is rolled when its
compressed size reaches ROLL_BYTES or the range ends, so names and bytes depend on the records alone, never on the number of
partitions or on retries. Each file is written under a hidden temporary name and then renamed; the manifest, a Parquet table
written last, lists the files with their sizes and digests, and is what readers go by.

Headers and digests are made anew: record ids from the page id, payload and block digests from the bytes. Of equal payloads of
at least REVISIT_BYTES the one with the largest page_id is a response and the others revisit it, pages without an id too (all repeated
rows of that page_id are responses; where no page of a payload has an id, all are). Null html is an empty payload, a null url an empty target. An empty table gives an empty archive.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import fresh_path, whole, written

RANGE_PAGES, ROLL_BYTES, REVISIT_BYTES = 512, 16 << 20, 1000
#: Ranges over which pages without an id are dealt: by payload, and those of one payload by their targets.
NAMELESS, NAMELESS_PARTS = 4096, 64
#: The archive's date is a parameter, as the pages carry none.
DATE = "2000-01-01T00:00:00Z"
#: Fixed values of the WARC format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "file string, n_records bigint, n_bytes bigint, sha256 string, first_id bigint, last_id bigint"
RECORDS = "file string, page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, payload binary"


def record_id(page_id: int | None) -> str:
    name = "none" if page_id is None else str(page_id)
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{name}')}>"


def sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id: int | None, url: str, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """One gzip member with one record."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": record_id(page_id),
        "WARC-Date": date,
        "WARC-Target-URI": quote(url, safe=":/?#[]@!$&'()*+,;=%~"),
        "WARC-Payload-Digest": sha1(payload),
        "WARC-Block-Digest": sha1(block),
        "Content-Type": "application/http; msgtype=response",
        "X-Page-Id": "" if page_id is None else str(page_id),
    }
    if refers_to is not None:
        head |= {"WARC-Profile": PROFILE, "WARC-Refers-To": record_id(refers_to), "X-Refers-To-Page": str(refers_to)}
    head["Content-Length"] = str(len(block))
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return gzip.compress(b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n", 6, mtime=0)


def revisits(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """(page_id, key, refers_to, part) of the pages whose payload, of SHA-256 key, another page holds as the response. Of pages without an
    id a row for each payload and part of its ranges; part is null for the others."""
    keys = pages.filter(F.octet_length(whole("html")) >= revisit_bytes).select(F.col("page_id").cast("bigint").alias("page_id"), F.sha2("html", 256).alias("key"))
    same = keys.groupBy("key").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).filter("n > 1 and refers_to is not null").drop("n")
    # written, so that the join has plain shuffles on both sides and a payload of very many pages is split over tasks
    same = written(same, "same-payloads")
    named = keys.join(same, "key").filter("page_id <> refers_to").select("page_id", "key", "refers_to", F.lit(None).cast("bigint").alias("part")).distinct()
    nameless = keys.filter("page_id is null").select("key").distinct().join(same, "key")
    parts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(NAMELESS_PARTS - 1).cast("bigint"))).alias("part")
    return named.unionByName(nameless.select(F.lit(None).cast("bigint").alias("page_id"), "key", "refers_to", parts))


def write(pages: DataFrame, path: str, date: str = DATE, range_pages: int = RANGE_PAGES, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Writes the archive and its manifest under path, a URI of the shared storage; returns the manifest."""
    spark = pages.sparkSession

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, folder = pafs.FileSystem.from_uri(f"{path}/data")
        fs.create_dir(folder, recursive=True)
        held, ids, now, part = io.BytesIO(), [], None, 0

        def roll() -> pd.DataFrame:
            data, name = held.getvalue(), f"pages-{now:012d}-{part:05d}.warc.gz"
            temporary = f"{folder}/_{name}.{uuid.uuid4().hex}"
            with fs.open_output_stream(temporary, compression=None) as out:
                out.write(data)
            fs.move(temporary, f"{folder}/{name}")
            held.seek(0)
            held.truncate()
            row = (name, len(ids), len(data), hashlib.sha256(data).hexdigest(), min((i for i in ids if i is not None), default=None), max((i for i in ids if i is not None), default=None))
            return pd.DataFrame([row], columns=["file", "n_records", "n_bytes", "sha256", "first_id", "last_id"]).astype({"first_id": "Int64", "last_id": "Int64"})

        known: tuple[tuple | None, dict[str, int]] = None, {}
        for frame in frames:
            for rng, page_id, url, html, key, refers_to in zip(*(frame[c] for c in ("rng", "page_id", "url", "html", "key", "refers_to"))):
                page = None if pd.isna(page_id) else int(page_id)
                if (rng, page) != known[0]:
                    known = (rng, page), {}
                if html is None:  # what is known of the page stands before its rows
                    known[1][key] = int(refers_to)
                    continue
                if now is not None and rng != now:
                    yield roll()
                    ids, part = [], 0
                elif held.tell() >= roll_bytes:
                    yield roll()
                    ids, part = [], part + 1
                now, payload = rng, html.encode()
                held.write(record(page, url, payload, known[1].get(hashlib.sha256(payload).hexdigest()) if known[1] else None, date))
                ids.append(page)
        if ids:
            yield roll()

    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), whole("url").alias("url"), whole("html").alias("html"))
    rows = rows.unionByName(revisits(pages), allowMissingColumns=True)
    # pages without an id are dealt over ranges of their own
    key = F.coalesce("key", F.when(F.col("page_id").isNull(), F.sha2("html", 256)))
    part = F.coalesce("part", F.pmod(F.xxhash64("url"), F.lit(NAMELESS_PARTS)))
    nameless = -1 - (F.pmod(F.xxhash64(key), F.lit(NAMELESS // NAMELESS_PARTS)) * NAMELESS_PARTS + part)
    rng = F.coalesce(F.floor(F.col("page_id") / range_pages), nameless).cast("bigint")
    sorted_ = rows.withColumn("rng", rng).repartitionByRange("rng").sortWithinPartitions("rng", "page_id", F.col("html").asc_nulls_first(), "url")
    sorted_.mapInPandas(work, MANIFEST).write.parquet(f"{path}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifest")


def parse(data: bytes) -> Iterator[tuple[dict[str, str], dict[str, str], bytes]]:
    """(record headers, HTTP headers, payload) of each record of a file; raises where a digest does not hold."""
    with gzip.GzipFile(fileobj=io.BytesIO(data)) as f:
        while version := f.readline():
            if not version.startswith(b"WARC/"):
                raise ValueError("not a WARC record")
            head = _headers(f)
            block = f.read(int(head["Content-Length"]))
            f.read(4)
            if sha1(block) != head["WARC-Block-Digest"]:
                raise ValueError(f"block digest of {head['WARC-Record-ID']}")
            inner = io.BytesIO(block)
            inner.readline()
            http = _headers(inner)
            payload = inner.read()
            if head["WARC-Type"] == "response" and sha1(payload) != head["WARC-Payload-Digest"]:
                raise ValueError(f"payload digest of {head['WARC-Record-ID']}")
            yield head, http, payload


def _headers(f: io.BufferedIOBase) -> dict[str, str]:
    out = {}
    while (line := f.readline().rstrip(b"\r\n")):
        name, _, value = line.decode().partition(": ")
        out[name] = value
    return out


def read(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """RECORDS of the files in the manifest; payload is null for revisits, or always without with_payload."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for file, data in zip(frame["path"], frame["content"]):
                rows = []
                for head, http, payload in parse(data):
                    page, refers = head["X-Page-Id"], head.get("X-Refers-To-Page")
                    digest = base64.b32decode(head["WARC-Payload-Digest"].partition(":")[2]).hex()
                    own = payload if with_payload and head["WARC-Type"] == "response" else None
                    rows.append((file.rpartition("/")[2], int(page) if page else None, head["WARC-Target-URI"], head["WARC-Type"], int(refers) if refers else None, int(http["Content-Length"]), digest, own))
                yield pd.DataFrame(rows, columns=["file", "page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]).astype({"page_id": "Int64", "refers_to": "Int64"})

    manifest = spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "pages-*.warc.gz").load(f"{path}/data").select("path", "content")
    return files.mapInPandas(work, RECORDS).join(manifest.select("file"), "file", "left_semi")


def archive(pages: DataFrame) -> DataFrame:
    """Writes pages to a new archive in the shared folder and returns its records as read back, without payloads."""
    spark = pages.sparkSession
    path = fresh_path(spark, "warc")
    if write(pages, path).isEmpty():
        return spark.createDataFrame([], RECORDS)
    return read(spark, path, with_payload=False)
