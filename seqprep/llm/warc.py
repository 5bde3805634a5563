"""WARC archives with an index: written once, read back by sorted byte ranges.

Every task writes archives of its own into the shared folder, each record a gzip
member, and returns a row per record: file, offset, length, URL and digest. These rows
are the index, kept as a table. A reader selects index rows; neighbours are read in one
range, and ranges, not files, are the units of work.

Of records with equal payloads the one with the largest page id is the response, and
the others are revisits that name it. A file of a task that was lost and run again has
another name and no index row, so it is never read.

Cases: a null html is an empty payload, and empty payloads are equal to each other. A
null URL is written as ``urn:x-unknown``; line breaks in URLs are percent-encoded, all else
of a URL stays as it is. The reader takes URLs from the index, which holds them unchanged. Very
long payloads are one record, which a task holds whole. An empty table has no archive. Rows
with a repeated page id have a record each; equal ones with the largest id are all
responses. A row without a page id is a revisit of an equal payload's page, or else a
response. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Callable, Iterator
from datetime import datetime

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqprep.llm.shared import few_files, new_folder, quoted, small_batches, table

#: An archive is closed, and the next one begun, from this size on.
ROLL_BYTES = 1 << 30
#: Records whose offsets are in the same stretch of this size form one unit of work.
RANGE_BYTES = 4 << 20
#: A task reads at most about so many bytes of archives.
TASK_BYTES = 256 << 20
#: Records at most this far apart are read together.
GAP_BYTES = 64 << 10
UNKNOWN_URL = "urn:x-unknown"
PAGE = "urn:x-page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

Batches = Iterator[pa.RecordBatch]
INDEX = "page_id long, url string, file string, offset long, length long, digest string"
READ = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, payload binary"
)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One WARC record; the block of a revisit holds the HTTP headers only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    revisit = refers_to is not None
    block = http.encode() if revisit else http.encode() + payload
    name = uuid.uuid4().hex if page_id is None else page_id
    target = (url or UNKNOWN_URL).replace("\r", "%0D").replace("\n", "%0A")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{PAGE}{name}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        head[-2:-2] = [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{PAGE}{refers_to}>"]
    return "\r\n".join([*head, "", ""]).encode() + block + b"\r\n\r\n"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _writing(folder: str, date: str) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        context = TaskContext.get()
        stem = f"{base}/part-{context.partitionId():06d}-{context.taskAttemptId()}"
        out, path, offset, files = None, "", 0, 0
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("page_id", "url", "keeper")]
            rows = []
            for (page_id, url, keeper), html in zip(zip(*columns), batch.column("html")):
                payload = (html.as_py() or "").encode()
                digest = base32_sha1(payload)
                if out is None or offset >= ROLL_BYTES:
                    if out is not None:
                        out.close()
                    path, offset, files = f"{stem}-{files}.warc.gz", 0, files + 1
                    out = store.open_output_stream(path, compression=None)
                refers_to = keeper if keeper != page_id else None
                packed = gzip.compress(record(page_id, url, payload, digest, refers_to, date), 1, mtime=0)
                out.write(packed)
                rows.append((page_id, url, path, offset, len(packed), digest))
                offset += len(packed)
            if rows:
                names = ["page_id", "url", "file", "offset", "length", "digest"]
                kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names
                )
        if out is not None:
            out.close()

    return run


def write_archives(
    pages: DataFrame,
    folder: str,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    date: datetime = datetime(2024, 1, 1),
) -> DataFrame:
    """Write archives into ``folder``/archives and return the index kept beside them.

    ``folder`` is a URI or path that all executors share.
    """
    rows = small_batches(pages).select(
        F.col(quoted(page_id)).cast("long").alias("page_id"),
        F.col(quoted(url)).alias("url"),
        F.col(quoted(html)).alias("html"),
    ).withColumn("same", F.sha1(F.coalesce("html", F.lit(""))))
    keepers = rows.groupBy("same").agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("n"))
    keepers = keepers.where("n > 1").drop("n")
    made = rows.sparkSession.range(0, 1, 1, 1).mapInArrow(_making(folder), "made boolean").first()
    assert made is not None
    stamp = date.strftime("%Y-%m-%dT%H:%M:%SZ")
    # equal pages may be a third of all: adaptive execution splits that join
    joined = few_files(rows.join(keepers, "same", "left").select("page_id", "url", "html", "keeper"))
    joined.mapInArrow(_writing(f"{folder}/archives", stamp), INDEX).write.parquet(f"{folder}/index")
    return rows.sparkSession.read.schema(INDEX).parquet(f"{folder}/index")


def _making(folder: str) -> Callable[[Batches], Batches]:
    """Make the folder where the executors see it."""

    def run(batches: Batches) -> Batches:
        from pyarrow import fs

        for batch in batches:
            store, base = fs.FileSystem.from_uri(f"{folder}/archives")
            store.create_dir(base, recursive=True)
            yield pa.RecordBatch.from_arrays([pa.array([True] * len(batch))], ["made"])

    return run


def parse(raw: bytes, url: str | None) -> tuple:
    """(page id, URL as the index has it, payload bytes, digest, type, page referred to, payload or None)."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x.split(b": ")[1]) for x in http.split(b"\r\n") if x.startswith(b"Content-Length"))
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != size or base32_sha1(payload) != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")

    def page(name: str) -> int | None:
        text = fields.get(name, "").removeprefix(f"<{PAGE}").removesuffix(">")
        return int(text) if text.lstrip("-").isdigit() else None

    return page("WARC-Record-ID"), url, size, digest, fields["WARC-Type"], page("WARC-Refers-To"), None if revisit else payload


def _reading(folder: str, with_payload: bool) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        from pyarrow import fs

        store, _ = fs.FileSystem.from_uri(folder)
        names = [x.split()[0] for x in READ.split(", ")]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        for batch in batches:
            for one in batch.to_pylist():
                wanted = [(x["offset"], x["length"], x["url"]) for x in one["records"]]
                out = []
                with store.open_input_file(one["file"]) as file:
                    at = 0
                    while at < len(wanted):
                        stop, end = at + 1, sum(wanted[at][:2])
                        while stop < len(wanted) and wanted[stop][0] - end <= GAP_BYTES:
                            end = sum(wanted[stop][:2])
                            stop += 1
                        start = wanted[at][0]
                        file.seek(start)
                        data = file.read(end - start)
                        for offset, length, url in wanted[at:stop]:
                            found = parse(gzip.decompress(data[offset - start : offset - start + length]), url)
                            out.append(found if with_payload else (*found[:-1], None))
                        at = stop
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    return run


def read_records(index: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """The records of the rows of ``index``, a selection of ``write_archives``' index.

    Responses are checked against their digests. Revisits have no payload of their own.
    Tasks are dealt by the bytes they read, not by those of the index.
    """
    total = index.agg(F.sum("length")).first()[0] or 0
    stretches = -(-total // RANGE_BYTES)
    tasks = max(1, -(-total // TASK_BYTES), min(stretches, index.sparkSession.sparkContext.defaultParallelism))
    ranges = (
        index.withColumn("stretch", F.floor(F.col("offset") / RANGE_BYTES))
        .repartition(tasks, "file", "stretch")
        .groupBy("file", "stretch")
        .agg(F.sort_array(F.collect_list(F.struct("offset", "length", "url"))).alias("records"))
        .select("file", "records")
    )
    return ranges.mapInArrow(_reading(f"{folder}/archives", with_payload), READ)


# --- query ---------------------------------------------------------------------------


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to an archive and read back by the index."""
    folder = new_folder(spark, "warc")
    index = write_archives(table(spark, sf_dir, "pages"), folder)
    return read_records(index, folder, with_payload=False).drop("url", "payload")


def _base32_sql(digest: str) -> str:
    """DuckDB's text for the base32 of a SHA-1 in hexadecimal: five digits make four letters."""
    value = f"('0x' || substr({digest}, 5 * (i // 4) + 1, 5))::BIGINT"
    letter = f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (({value} >> (15 - 5 * (i % 4))) & 31)::INT + 1, 1)"
    return f"array_to_string([{letter} for i in range(32)], '')"


OP2_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
k AS (SELECT hex, max(page_id) AS keeper FROM p GROUP BY hex)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes, {_base32_sql("hex")} AS payload_digest,
  CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = keeper THEN NULL ELSE keeper END AS refers_to
FROM p JOIN k USING (hex)
"""
