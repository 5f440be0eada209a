"""WARC archives and transaction assembly.

Writing: each page becomes a request, a response (or revisit) and a metadata
record that name each other by WARC-Concurrent-To; a record is one gzip member
of its archive.  Of pages with equal payloads of ``min_revisit`` bytes or more
the one with the largest id is the response, the others revisit it.

Reading: every record of every archive becomes a row; the records of a
transaction are joined through their concurrent-to identifiers, and a revisit
is joined with the response that it refers to.  One nested row per capture.

Scale: digests are narrow rows, aggregated before they are joined (a payload
may be that of a third of all pages, so Spark may split that join); the pages
are shuffled once, by their own id.  Archives are written and read as streams
with a record in memory at a time, and a new one is begun every
``archive_bytes``, so that readers share the work.  A retried task writes
archives under new names; only those in the manifest count.

Defined results: null html is an empty payload; a null url is written as
``about:blank``; repeated rows are written each (rows of the largest id are
all responses); rows without an id are responses of their own; an empty table
gives no archive and no rows.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm._common import batch_of, open_store, stored

MANIFEST = "path string, n_captures long, n_bytes long"
RECORDS = ("record_id string, record_type string, target_uri string, concurrent_to string, refers_to string, "
           "payload_digest string, page_id long, payload_bytes long, payload binary")
DATE = "2024-01-01T00:00:00Z"


def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", str(len(block)))])
    return gzip.compress(b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n", compresslevel=1, mtime=0)


def _one_line(url: str | None) -> str:
    """A header's value: no line breaks."""
    return "".join(c if c > " " else "%%%02X" % ord(c) for c in url) if url else "about:blank"


def urn(page_id: int | None, row: str, part: str) -> str:
    """A record's identifier; a function of the page's id where it has one."""
    name = f"{page_id}" if page_id is not None else f"row:{row}"
    return f"<{uuid.uuid5(uuid.NAMESPACE_OID, f'{name}/{part}').urn}>"


def capture_records(page_id, url, payload: bytes, digest: str, response_id: int | None, row: str) -> bytes:
    """The three records of a capture; response_id: the page that it revisits."""
    uri, main, date = _one_line(url), urn(page_id, row, "response"), ("WARC-Date", DATE)
    ask = urn(page_id, row, "request")
    path, host = "/", uri.partition("://")[2].partition("/")[0]
    if "/" in uri.partition("://")[2]:
        path = "/" + uri.partition("://")[2].partition("/")[2]
    request = f"GET {path} HTTP/1.1\r\nHost: {host}\r\n\r\n".encode()
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    common = [("WARC-Record-ID", main), date, ("WARC-Target-URI", uri), ("WARC-Payload-Digest", f"sha1:{digest}"),
              ("Content-Type", "application/http;msgtype=response")]
    if response_id is None:
        body = _record([("WARC-Type", "response"), *common], http + payload)
    else:
        body = _record([("WARC-Type", "revisit"), *common, ("WARC-Refers-To", urn(response_id, "", "response")),
                        ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")], http)
    about = f"page_id: {'' if page_id is None else page_id}\r\n".encode()
    return (_record([("WARC-Type", "request"), ("WARC-Record-ID", ask), date, ("WARC-Target-URI", uri),
                     ("WARC-Concurrent-To", main), ("Content-Type", "application/http;msgtype=request")], request) + body +
            _record([("WARC-Type", "metadata"), ("WARC-Record-ID", urn(page_id, row, "metadata")), date, ("WARC-Target-URI", uri),
                     ("WARC-Concurrent-To", main), ("Content-Type", "application/warc-fields")], about))


def write_archives(pages: DataFrame, out_dir: str, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   min_revisit: int = 1000, archive_bytes: int = 64 << 20) -> DataFrame:
    """Write the pages' archives under ``out_dir``; returns the manifest."""
    spark = pages.sparkSession
    html = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    pages = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), html.alias("html"))
    digests = stored(pages.where("page_id IS NOT NULL").where(F.octet_length("html") >= min_revisit)
                     .select("page_id", F.sha1("html").alias("digest")), "digests")
    largest = digests.groupBy("digest").agg(F.max("page_id").alias("response_id"), F.count(F.lit(1)).alias("n")).where("n > 1")
    revisits = digests.join(largest.drop("n"), "digest").where("page_id <> response_id").distinct()
    rows = (pages.withColumn("digest", F.sha1("html")).join(revisits, ["page_id", "digest"], "left")
            .select("page_id", "url", "html", "digest", "response_id"))

    store, inner = open_store(out_dir)
    store.create_dir(inner)

    def write(batches):
        from pyspark import TaskContext

        part, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex[:8]
        file, n, size, k, path = None, 0, 0, 0, ""
        row = 0
        for batch in batches:
            for page_id, url, html, digest, response_id in zip(*(c.to_pylist() for c in batch.columns)):
                if file is None:
                    path = f"{out_dir}/pages-{part:06d}-{k:04d}-{attempt}.warc.gz"
                    fs, name = open_store(path)
                    file, n, size, k = fs.open_output_stream(name, compression=None), 0, 0, k + 1
                    file.write(_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<{uuid.uuid4().urn}>"), ("WARC-Date", DATE),
                                        ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
                data = capture_records(page_id, url, html, digest, response_id, f"{attempt}/{part}/{row}")
                file.write(data)
                n, size, row = n + 1, size + len(data), row + 1
                if size >= archive_bytes:
                    file.close()
                    file = None
                    yield batch_of([(path, n, size)], MANIFEST)
        if file is not None:
            file.close()
            yield batch_of([(path, n, size)], MANIFEST)

    rows.mapInArrow(write, MANIFEST).write.parquet(f"{out_dir}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{out_dir}/manifest")


class _Members(io.RawIOBase):
    """The bytes of a stream of gzip members, one after the other."""

    def __init__(self, raw):
        self.raw, self.pending, self.z = raw, b"", zlib.decompressobj(31)

    def readable(self):
        return True

    def readinto(self, target) -> int:
        while True:
            data = self.pending or self.raw.read(1 << 18)
            if not data:
                return 0
            if self.z.eof:
                self.z = zlib.decompressobj(31)
            out = self.z.decompress(bytes(data), len(target))
            self.pending = self.z.unused_data if self.z.eof else self.z.unconsumed_tail
            if out:
                target[:len(out)] = out
                return len(out)


def parse_archive(raw):
    """(headers, block) of each record of an opened archive."""
    stream = io.BufferedReader(_Members(raw), 1 << 18)
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            if line.strip():
                raise ValueError(f"no WARC record where one is due: {line[:40]!r}")
            continue
        headers = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.decode().partition(":")
            headers[name.lower()] = value.strip()
        yield headers, stream.read(int(headers["content-length"]))


def read_records(manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    """A row per record; payload: the body of HTTP messages (null if not wanted)."""
    def read(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, name = open_store(path)
                rows, size = [], 0
                with fs.open_input_stream(name, compression=None) as raw:
                    for h, block in parse_archive(raw):
                        kind = h["warc-type"]
                        if kind == "warcinfo":
                            continue
                        page_id = payload = digest = None
                        if kind == "metadata":
                            fields = dict(x.split(": ", 1) for x in block.decode().splitlines() if ": " in x)
                            page_id = int(fields["page_id"]) if fields.get("page_id") else None
                        elif kind == "response":
                            payload = block.partition(b"\r\n\r\n")[2]
                            digest = hashlib.sha1(payload).hexdigest()
                        elif kind == "revisit":
                            digest = h["warc-payload-digest"].removeprefix("sha1:")
                        n = None if payload is None else len(payload)
                        rows.append((h["warc-record-id"], kind, h.get("warc-target-uri"), h.get("warc-concurrent-to"), h.get("warc-refers-to"),
                                     digest, page_id, n, payload if with_payload else None))
                        size += len(payload or b"") if with_payload else 100
                        if size >= 1 << 22:
                            yield batch_of(rows, RECORDS)
                            rows, size = [], 0
                yield batch_of(rows, RECORDS)

    n = max(1, min(manifest.count(), 10_000))  # archives are read a task each, up to so many tasks
    return manifest.select("path").repartition(n).mapInArrow(read, RECORDS)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: page_id, target_uri, request, response (of
    the capture itself or, for a revisit, the one that it refers to) and
    metadata, joined through concurrent-to identifiers."""
    main = records.where(F.col("record_type").isin("response", "revisit"))
    side = (records.where(F.col("record_type").isin("request", "metadata")).groupBy(F.col("concurrent_to").alias("_of")).agg(
        F.max(F.when(F.col("record_type") == "request", F.struct("record_id", "target_uri"))).alias("request"),
        F.max(F.when(F.col("record_type") == "metadata", F.struct("record_id", "page_id"))).alias("metadata")))
    captures = main.drop("concurrent_to", "page_id").join(side, F.col("record_id") == F.col("_of"), "left").select(
        F.col("metadata.page_id").alias("page_id"), "target_uri", "record_type", "refers_to", "request",
        F.struct("record_id", "payload_digest", "payload_bytes", "payload").alias("response"), "metadata")
    # what revisits refer to: aggregated, then joined (Spark may split a response that many refer to)
    wanted = captures.where("record_type = 'revisit'").select(F.col("refers_to").alias("id")).distinct()
    own = captures.where("record_type = 'response'")
    targets = (own.join(wanted, F.col("response.record_id") == F.col("id"), "left_semi")
               .select(F.col("response.record_id").alias("id"), F.col("page_id").alias("target_page"),
                       F.col("response").alias("target")).dropDuplicates(["id"]))
    again = captures.where("record_type = 'revisit'").join(targets, F.col("refers_to") == F.col("id"), "left")
    keep = ["page_id", "target_uri", "record_type", "request", "metadata"]
    referred = F.struct("target.record_id", "response.payload_digest", "target.payload_bytes", "target.payload")
    return (own.select(*keep, "response", F.lit(None).cast("long").alias("refers_to"))
            .unionByName(again.select(*keep, referred.alias("response"), F.col("target_page").alias("refers_to"))))


def captures(spark: SparkSession, manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    records = read_records(manifest, with_payload)
    return assemble(records if with_payload else stored(records, "records"))
