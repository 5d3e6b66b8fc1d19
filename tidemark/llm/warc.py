"""WARC archives with an index of byte ranges.

Writing puts each page into a gzip member of its own and yields an index row
(path, offset, length, URL, digest). Pages whose payload was archived before
become ``revisit`` records without payload. Reading starts from the index:
rows are selected there, sorted by place, near ranges are read in one request,
and each record is inflated and parsed by itself.

Archives lie in the shared checkpoint folder. A task writes under a name of
its own attempt, and the index is written by Spark's commit protocol, so it
names only archives of tasks that succeeded.
"""

from __future__ import annotations

import base64
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import partitions_for, saved, table
from tidemark.session import fresh_scratch

MIN_REVISIT_BYTES = 1000
ARCHIVE_BYTES = 1 << 30  # an archive is closed beyond this size
GAP_BYTES = 64 << 10  # ranges this near are read together
RANGE_BYTES = 8 << 20  # bytes of one read request
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = ("page_id long, url string, payload_digest string, payload_bytes long, record_type string, "
         "refers_to long, path string, offset long, length long")
RECORD = ("page_id long, url string, record_type string, refers_to long, payload binary, "
          "declared_digest string, declared_bytes long")


def place(uri: str):
    """File system and path of a URI or an absolute path."""
    from pyarrow import fs
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC/1.1 record; a revisit of ``refers_to`` if that is not None."""
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
            + str(len(payload)).encode() + b"\r\n\r\n")
    block = http if refers_to is not None else http + payload
    sha = "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: {record_id(page_id, digest)}", f"WARC-Date: {DATE}",
            f"WARC-Payload-Digest: {sha}"]
    if url is not None and ("\r" in url or "\n" in url):
        url = url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")
        head.append("X-Target-URI-Escaped: 1")
    if url is not None:
        head.append(f"WARC-Target-URI: {url}")
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest)}",
                 f"X-Refers-To-Page-ID: {refers_to}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode("utf-8") + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple:
    """A record's fields, in the order of ``RECORD``."""
    end = raw.index(b"\r\n\r\n")
    lines = raw[:end].decode("utf-8").split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC/1.1 record")
    head = dict(x.split(": ", 1) for x in lines[1:])
    block = raw[end + 4:end + 4 + int(head["Content-Length"])]
    stop = block.index(b"\r\n\r\n")
    http = dict(x.split(": ", 1) for x in block[:stop].decode("latin-1").split("\r\n")[1:])
    url = head.get("WARC-Target-URI")
    if "X-Target-URI-Escaped" in head:
        url = url.replace("%0D", "\r").replace("%0A", "\n").replace("%25", "%")
    page, refers = head.get("X-Page-ID"), head.get("X-Refers-To-Page-ID")
    kind = head["WARC-Type"]
    digest = base64.b32decode(head["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    return (None if page is None else int(page), url, kind, None if refers is None else int(refers),
            block[stop + 4:] if kind == "response" else None, digest, int(http["Content-Length"]))


def deflate(data: bytes, level: int = 6) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def _write(folder: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        fs, base = place(folder)
        task = TaskContext.get().partitionId()
        out, path, at = None, "", 0
        try:
            for f in batches:
                rows = []
                for page, no_id, url, payload, digest, refers, no_ref in zip(
                        f["page_id"].tolist(), f["no_id"], f["url"], f["payload"], f["digest"],
                        f["refers_to"].tolist(), f["no_ref"]):
                    page, refers = None if no_id else page, None if no_ref else refers
                    if out is None or at >= ARCHIVE_BYTES:
                        if out is not None:
                            out.close()
                        name = f"part-{task:05d}-{uuid.uuid4().hex}.warc.gz"
                        path, at = f"{folder}/{name}", 0
                        out = fs.open_output_stream(f"{base}/{name}", compression=None)
                    data = deflate(record(page, url, payload, digest, refers))
                    out.write(data)
                    rows.append((page, url, digest, len(payload),
                                 "response" if refers is None else "revisit", refers, path, at, len(data)))
                    at += len(data)
                yield pd.DataFrame(rows, columns=[c.split()[0] for c in INDEX.split(", ")],
                                   dtype=object)
        finally:
            if out is not None:
                out.close()
    return run


def archive(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html", min_revisit: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Write a record per row and return the index.

    Of rows with equal payloads of at least ``min_revisit`` bytes, those with
    the largest id are responses and the others revisit it. Null html is an
    empty payload; null URLs have no target header; rows without an id are
    never revisited. Rows that repeat id and payload are records of their own,
    of the same type. An empty table writes no archive. Other columns are not
    read.
    """
    fs, base = place(folder)
    fs.create_dir(base, recursive=True)
    payload = F.coalesce(F.col(f"`{html_col}`"), F.lit("")).cast("binary")
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"),
                        F.col(f"`{url_col}`").alias("url"), payload.alias("payload"),
                        F.sha1(payload).alias("digest"))
    # counted from the narrow columns; only digests of several rows are kept
    many = saved(rows.filter(F.octet_length("payload") >= min_revisit).groupBy("digest")
                 .agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
                 .filter("n > 1 and first is not null").select("digest", "first"), "warc-repeated")
    refers = F.when(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    placed = (rows.join(many, "digest", "left").withColumn("refers_to", refers)
              .select(F.coalesce("page_id", F.lit(0)).alias("page_id"), F.col("page_id").isNull().alias("no_id"),
                      "url", "payload", "digest", F.coalesce("refers_to", F.lit(0)).alias("refers_to"),
                      F.col("refers_to").isNull().alias("no_ref")))
    return saved(placed.mapInPandas(_write(folder), INDEX), "warc-index")


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [c.split()[0] for c in RECORD.split(", ")]
    held = ("", None)
    for f in batches:
        rows, size, k = [], 0, 0
        paths, at, n = f["path"].tolist(), f["offset"].tolist(), f["length"].tolist()
        while k < len(f):
            last = k
            while (last + 1 < len(f) and paths[last + 1] == paths[k]
                   and at[last + 1] - at[last] - n[last] <= GAP_BYTES
                   and at[last + 1] + n[last + 1] - at[k] <= RANGE_BYTES):
                last += 1
            if held[0] != paths[k]:
                if held[1] is not None:
                    held[1].close()
                fs, path = place(paths[k])
                held = (paths[k], fs.open_input_file(path))
            data = held[1].read_at(at[last] + n[last] - at[k], at[k])
            for i in range(k, last + 1):
                lo = at[i] - at[k]
                rows.append(parse(zlib.decompress(data[lo:lo + n[i]], 31)))
            size += len(data)
            k = last + 1
            if size >= RANGE_BYTES:
                yield pd.DataFrame(rows, columns=names, dtype=object)
                rows, size = [], 0
        yield pd.DataFrame(rows, columns=names, dtype=object)
    if held[1] is not None:
        held[1].close()


def read(index: DataFrame) -> DataFrame:
    """Records of the index rows: see ``RECORD`` (no payload for revisits).
    Select rows of the index first; rows are read sorted by place, in runs."""
    n = partitions_for(index.sparkSession)
    return (index.select("path", "offset", "length").repartitionByRange(n, "path", "offset")
            .sortWithinPartitions("path", "offset").mapInPandas(_read, RECORD))


def op2_warc_index(spark, sf_dir: str) -> DataFrame:
    """Every page archived and read back through the index."""
    index = archive(table(spark, sf_dir, "pages"), fresh_scratch(spark, "warc"))
    return read(index).select(
        "page_id", F.coalesce(F.octet_length("payload"), "declared_bytes").cast("long").alias("payload_bytes"),
        F.coalesce(F.sha1("payload"), "declared_digest").alias("payload_digest"), "record_type", "refers_to",
        "url")


ORACLE = """
WITH p AS (SELECT page_id, url, sha1(encode(coalesce(html, ''))) AS payload_digest,
                  octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes FROM pages),
     m AS (SELECT payload_digest AS d, max(page_id) AS first, count(*) AS n FROM p
           WHERE payload_bytes >= 1000 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN n > 1 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n > 1 AND first <> page_id THEN first END AS refers_to, url
FROM p LEFT JOIN m ON payload_digest = d
"""
