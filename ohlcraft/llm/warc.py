"""WARC archives with an index: write records, note their byte ranges, read ranges back.

Each task writes archives of its own, gzipped record by record, and returns a row per record:
archive, offset, length, URL and digest. The index is what Spark commits; archives of failed
attempts bear other names and are in no index. Reading sorts the wanted rows by archive and
offset and fetches neighbouring records in one range.
"""

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from ohlcraft.llm.common import stage

#: An archive is closed beyond so many bytes, and the task goes on with another.
ARCHIVE_BYTES = 1 << 30
#: Ranges with a gap of at most GAP_BYTES are read together, up to READ_BYTES at a time.
GAP_BYTES, READ_BYTES = 1 << 16, 1 << 23
DATE = "1970-01-01T00:00:00Z"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
# Fixed value of the standard.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id, digest: str) -> str:
    return f"<{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id} {digest}').urn}>"


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to=None, date: str = DATE) -> bytes:
    """One record. With ``refers_to``, a revisit of that page's response: headers alone."""
    target = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    kind = "response" if refers_to is None else "revisit"
    block = HTTP % len(payload) + (payload if refers_to is None else b"")
    fields = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_record_id(page_id, digest)}",
        f"WARC-Date: {date}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{digest}"]
    if refers_to is not None:
        fields += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_id(refers_to, digest)}"]
    fields += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(fields).encode() + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """A gzipped record's header fields, and its payload (empty for a revisit)."""
    head, _, rest = zlib.decompress(raw, wbits=31).partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("no WARC record at this place")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    size = int(fields["Content-Length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("a record of another length than it says")
    return fields, rest[:size].partition(b"\r\n\r\n")[2]


def with_first_copies(pages: DataFrame, min_bytes: int) -> DataFrame:
    """Rows (page_id, url, payload) with refers_to: null, or the smallest page_id of those with
    an equal payload if that is another page's.

    The long rows are dealt by (page_id, digest), so that many copies of one payload part; who
    has copies is settled on digests alone.
    """
    digest = F.unhex(F.sha1("payload"))
    rows = pages.withColumn("_digest", digest)
    shared = (
        rows.where(F.octet_length("payload") >= min_bytes).groupBy("_digest")
        .agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    revisits = (
        rows.select("page_id", "_digest").join(shared, "_digest")
        .where(~F.col("page_id").eqNullSafe(F.col("refers_to"))).distinct()
        .select(F.col("page_id").alias("_page"), F.col("_digest").alias("_same"), "refers_to"))
    return rows.join(
        revisits, F.col("page_id").eqNullSafe(F.col("_page")) & (F.col("_digest") == F.col("_same")), "left",
    ).drop("_page", "_same", "_digest")


def write_archives(
    pages: DataFrame, folder: str, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """Writes a record per page under ``folder`` (a URI all nodes reach) and returns the index.

    Index: path, offset, length, page_id, url, digest, record_type, refers_to. Of pages with
    equal payloads of at least ``min_bytes``, that with the smallest id is the response; the
    others revisit it. Null html: an empty payload. Null url: an empty target. Null id: after
    all others. Rows that repeat a page, id and payload alike, are written alike. An
    empty table gives an empty index.
    """
    kind = pages.schema[id_col].dataType
    rows = with_first_copies(pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"),
        F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8").alias("payload")), min_bytes)
    out = T.StructType([
        T.StructField("path", T.StringType()), T.StructField("offset", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("page_id", kind),
        T.StructField("url", T.StringType()), T.StructField("digest", T.StringType()),
        T.StructField("record_type", T.StringType()), T.StructField("refers_to", kind)])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = arrow_fs.FileSystem.from_uri(folder)
        task, sink, path, at, n = TaskContext.get(), None, "", 0, 0
        try:
            for batch in batches:
                ids, urls, payloads, firsts = (batch.column(i).to_pylist() for i in range(4))
                paths, offsets, lengths, digests = [], [], [], []
                for page_id, url, payload, first in zip(ids, urls, payloads, firsts):
                    if sink is None or at > ARCHIVE_BYTES:
                        if sink:
                            sink.close()
                        name = f"part-{task.partitionId()}-{n}-{uuid.uuid4().hex}.warc.gz"
                        store.create_dir(base, recursive=True)
                        sink, path, at, n = store.open_output_stream(f"{base}/{name}", compression=None), name, 0, n + 1
                    digest = payload_digest(payload)
                    packer = zlib.compressobj(wbits=31)
                    raw = packer.compress(record(page_id, url, payload, digest, first)) + packer.flush()
                    sink.write(raw)
                    paths.append(f"{folder}/{path}")
                    offsets.append(at)
                    lengths.append(len(raw))
                    digests.append(digest)
                    at += len(raw)
                kinds = ["response" if first is None else "revisit" for first in firsts]
                yield pa.RecordBatch.from_arrays([
                    pa.array(paths, pa.string()), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64()),
                    batch.column(0), batch.column(1), pa.array(digests, pa.string()),
                    pa.array(kinds, pa.string()), batch.column(3)], names=out.names)
        finally:
            if sink:
                sink.close()

    return stage(rows.select("page_id", "url", "payload", "refers_to").mapInArrow(write, out), "warc-index")


def _ranges(paths: list[str], offsets: list[int], lengths: list[int]) -> Iterator[tuple[int, int]]:
    """Runs of sorted records to be read at once."""
    first = 0
    for i in range(1, len(paths) + 1):
        if i == len(paths) or paths[i] != paths[first] or (
                offsets[i] - offsets[i - 1] - lengths[i - 1] > GAP_BYTES
                or offsets[i] + lengths[i] - offsets[first] > READ_BYTES):
            yield first, i
            first = i


def read_records(index: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of these index rows, read from their archives and held against their digests.

    Columns: page_id, url, record_type, refers_to, digest, payload_bytes and, if wanted, payload
    (both null for revisits, which carry none). An empty index gives no rows.
    """
    spark = index.sparkSession
    kind = index.schema["page_id"].dataType
    out = T.StructType([
        T.StructField("page_id", kind), T.StructField("url", T.StringType()),
        T.StructField("record_type", T.StringType()), T.StructField("refers_to", kind),
        T.StructField("digest", T.StringType()), T.StructField("payload_bytes", T.LongType()),
        *([T.StructField("payload", T.BinaryType())] if payloads else [])])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, offsets, lengths, kinds, digests = (batch.column(n).to_pylist() for n in (
                "path", "offset", "length", "record_type", "digest"))
            for a, b in _ranges(paths, offsets, lengths):
                store, path = arrow_fs.FileSystem.from_uri(paths[a])
                with store.open_input_file(path) as file:
                    chunk = file.read_at(offsets[b - 1] + lengths[b - 1] - offsets[a], offsets[a])
                sizes, bodies = [], []
                for i in range(a, b):
                    at = offsets[i] - offsets[a]
                    fields, body = parse(chunk[at:at + lengths[i]])
                    told = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    whole = fields["WARC-Type"] == "response"
                    if fields["WARC-Type"] != kinds[i] or told != digests[i] or (
                            whole and payload_digest(body) != told):
                        raise ValueError(f"the record at {paths[i]}:{offsets[i]} is not the one of the index")
                    sizes.append(len(body) if whole else None)
                    bodies.append(body if whole else None)
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([
                    part.column("page_id"), part.column("url"), part.column("record_type"),
                    part.column("refers_to"), part.column("digest"), pa.array(sizes, pa.int64()),
                    *([pa.array(bodies, pa.binary())] if payloads else [])], names=out.names)

    # as many tasks as a scan of the archives would get
    held = index.agg(F.sum("length")).first()[0] or 0
    at_once = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return (
        index.repartitionByRange(max(1, -(-held // at_once)), "path", "offset")
        .sortWithinPartitions("path", "offset").mapInArrow(read, out))


def resolved(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to: a revisit's payload is
    that of the response it refers to. Join of short rows; ``records`` is read twice."""
    responses = records.where("record_type = 'response'")
    payloads = responses.where("page_id IS NOT NULL").select(
        F.col("page_id").alias("refers_to"), "digest", "payload_bytes").distinct()
    revisits = records.where("record_type = 'revisit'").drop("payload_bytes").join(payloads, ["refers_to", "digest"])
    wanted = ["page_id", "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to"]
    return responses.select(wanted).unionByName(revisits.select(wanted))
