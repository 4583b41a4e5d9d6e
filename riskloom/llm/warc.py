"""WARC archives (operator 6): a deterministic sharded writer and its reader.

*Plan.*  Records are sorted by (url, page_id, digest).  A first pass makes
each record only to learn its compressed size; the sorted sizes are summed
up, and a record belongs to the file in which its first byte falls if files
are cut every ``roll_bytes``.  So file names and contents depend on the
records alone, not on partitions, sampling or the order in which tasks run.
Only keys and sizes are shuffled for that.

*Writing.*  The files are dealt to ranges of about equal bytes, each of
which begins with a file; their first keys and byte numbers (one row a
range) go to the tasks.  Payloads are shuffled once, to their range, where
the plan's rows tell which page a record refers to; headers and digests are
made anew from the payload.  Records with equal payloads: the one with the
smallest page_id is a response, the others are revisits that refer to it.

A task writes each file under a temporary name that holds its attempt
number and renames it when it is complete.  The list of files is itself a
table, written by Spark's commit protocol: only a finished attempt's rows
are in it, and readers open only what it lists.  What failed attempts left
under temporary names is deleted when the list stands.

Files are written with ``pyarrow.fs``: local, ``hdfs://``, ``s3://`` (also
as ``s3a://``) and ``gs://`` folders.

Memory: a task holds one Arrow batch (the payloads in it zstd-compressed,
which also keeps the shuffle small) and one record.  Equal payloads are
found by a grouped minimum over digests, so a payload that a third of all
pages share arrives as few rows, and the join back, without payloads, is one
that Spark splits when skewed.

Defined results: null html is an empty payload, and all empty payloads are
equal; a null url becomes ``urn:page:<id>``; control characters and spaces
in urls are percent-encoded; repeated rows with the group's smallest
page_id are all responses; in a group with some null page_ids those rows
are revisits, in one with only nulls all are responses; an empty table
writes no file; extra columns are not archived.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.llm.common import materialize, release
from riskloom.session import scratch_path

ROLL_BYTES = 16 << 20
#: One date for all records: the archive depends on its records alone.
DATE = "2020-01-01T00:00:00Z"
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # RFC 4122's namespace for URLs
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Ranges of files that are written side by side.
MOST_RANGES = 4096
_MEASURED = "page_id long, url string, hex string, n long, size long"
_PLACED = "page_id long, url string, hex string, first long, before long, size long"
_DEALT = "range int, page_id long, url string, hex string, first long, z binary"
_MANIFEST = "file string, records long, bytes long, first_url string, last_url string"
_RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"


def base32(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def _record_id(page_id: int | None, url: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'page:{page_id}' if page_id is not None else f'url:{url}')}>"


def _clean(url: str) -> str:
    return "".join(c if "!" <= c != "\x7f" else "".join(f"%{x:02X}" for x in c.encode()) for c in url)


def record(page_id: int | None, url: str | None, payload: bytes | None, first: int | None, n: int = 0, digest: str = "") -> bytes:
    """One WARC record; ``first`` is the page_id of the response that a revisit refers to.

    A revisit needs only the payload's size and digest.
    """
    if payload is not None:
        n, digest = len(payload), base32(hashlib.sha1(payload).digest())
    uri = _clean(url) if url else f"urn:page:{page_id}"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n".encode()
    block = http if first is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if first is None else 'revisit'}", f"WARC-Record-ID: {_record_id(page_id, uri)}", f"WARC-Date: {DATE}", f"WARC-Target-URI: {uri}"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{base32(hashlib.sha1(block).digest())}"]
    if first is not None:
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {_record_id(first, '')}", f"X-Refers-To-Page: {first}"]
    if page_id is not None:
        head.append(f"X-Page: {page_id}")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    gz = zlib.compressobj(6, wbits=31)
    return gz.compress(data) + gz.flush()


def _batch(columns: list, schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    fields = [x.split() for x in schema.split(", ")]
    cols = columns or [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(cols, fields, strict=True)], names=[n for n, _ in fields])


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size of each page and of its record as a response."""
    for b in batches:
        page, url, hex_ = (b.column(i).to_pylist() for i in range(3))
        html = b.column(3).cast(pa.binary()).to_pylist()
        sizes = [len(_member(record(i, u, h, None))) for i, u, h in zip(page, url, html, strict=True)]
        yield _batch([page, url, hex_, list(map(len, html)), sizes], _MEASURED)


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of the sorted records before each, within the partition; a revisit's size is worked out here."""
    at = 0
    for b in batches:
        rows = b.to_pylist()
        before = []
        for r in rows:
            before.append(at)
            digest = base32(bytes.fromhex(r["hex"]))
            at += r["size"] if r["first"] is None else len(_member(record(r["page_id"], r["url"], None, r["first"], r["n"], digest)))
        sizes = [y - x for x, y in zip(before, [*before[1:], at], strict=True)]
        yield _batch([[r[c] for r in rows] for c in ("page_id", "url", "hex", "first")] + [before, sizes], _PLACED)


def _order(url: str | None, page_id: int | None, hex_: str) -> tuple:
    """Spark's order of (url, page_id, hex): nulls first, strings by UTF-8 bytes."""
    return (url is not None, (url or "").encode(), page_id is not None, page_id or 0, hex_)


def _dealt(starts: list[tuple], numbers: list[int]):
    """Rows with the number of their range: the last whose first record does not stand after them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        for b in batches:
            page, url, hex_, first = (b.column(i).to_pylist() for i in range(4))
            html = b.column(4).cast(pa.binary()).to_pylist()
            at = [numbers[max(0, bisect_right(starts, _order(u, i, h)) - 1)] for i, u, h in zip(page, url, hex_, strict=True)]
            yield _batch([at, page, url, hex_, first, [None if h is None else pack.compress(h) for h in html]], _DEALT)

    return run


def _filesystem(root: str):
    return pafs.FileSystem.from_uri("s3://" + root[6:] if root.startswith("s3a://") else root)


def _writer(root: str, roll_bytes: int, starts: dict[int, int]):
    """``starts``: byte number of each range's first record, by the range's number."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, top = _filesystem(root)
        attempt = TaskContext.get().taskAttemptId()
        unpack = zstandard.ZstdDecompressor()
        out, files, temp, row, number, range_, at, known = None, [], "", None, -1, -1, 0, (None, None)

        def finish() -> None:
            out.close()
            name = f"{number:08d}.warc.gz"
            fs.move(temp, f"{top}/{name}")
            files.append([name, *row])

        for b in batches:
            for part, page_id, url, hex_, first, z in zip(*(b.column(i).to_pylist() for i in range(6)), strict=True):
                if z is None:  # a row of the plan
                    known = ((url, page_id, hex_), first)
                    continue
                if known[0] != (url, page_id, hex_):
                    raise ValueError(f"page {page_id} is not in the plan")
                if part != range_:
                    range_, at = part, starts[part]
                payload = unpack.decompress(z)
                data = _member(record(page_id, url, payload, known[1]))
                if out is None or at // roll_bytes != number:
                    if out is not None:
                        finish()
                    number = at // roll_bytes
                    temp = f"{top}/_temporary-{number:08d}-{attempt}"
                    out, row = fs.open_output_stream(temp, compression=None), [0, 0, url, url]
                out.write(data)
                at += len(data)
                row[0] += 1
                row[1] += len(data)
                row[3] = url
        if out is not None:
            finish()
        yield _batch(list(zip(*files, strict=True)), _MANIFEST)

    return write


def write(pages: DataFrame, root: str, roll_bytes: int = ROLL_BYTES, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Archive ``pages`` below ``root``; returns the manifest (one row a file)."""
    spark, key = pages.sparkSession, ["url", "page_id", "hex"]
    fs, top = _filesystem(root)
    fs.create_dir(top, recursive=True)
    p = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))
    p = p.select("page_id", "url", F.sha1(F.col("html").cast("binary")).alias("hex"), "html")
    sizes = materialize(p.mapInArrow(_measured, _MEASURED), "warc-sizes")
    firsts = sizes.groupBy("hex").agg(F.min("page_id").alias("first"), F.count("*").alias("copies")).where("copies > 1").select("hex", "first")
    plan = sizes.join(firsts, "hex", "left").withColumn("first", F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first")))
    plan = plan.select("page_id", "url", "hex", "first", "n", "size").repartitionByRange(*key).sortWithinPartitions(*key)
    plan = materialize(plan.mapInArrow(_placed, _PLACED).withColumn("part", F.shiftright(F.monotonically_increasing_id(), 33)), "warc-plan")
    release(sizes)
    per = plan.groupBy("part").agg(F.sum("size").alias("size"))  # a row a partition of the sort
    per = per.select("part", F.coalesce(F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"), F.sum("size").over(Window.partitionBy(F.lit(0))).alias("all"))
    at = plan.join(per, "part").withColumn("at", F.col("offset") + F.col("before"))
    ranges = max(1, min(MOST_RANGES, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    files = at.withColumn("file", F.call_function("div", F.col("at"), F.lit(roll_bytes))).withColumn("last", F.call_function("div", F.col("all"), F.lit(roll_bytes)))
    dealt = files.groupBy(F.call_function("div", F.col("file") * ranges, F.col("last") + 1).alias("range"))
    starts = dealt.agg(F.min(F.struct("at", *key)).alias("s")).select("s.*").orderBy("at").collect()  # MOST_RANGES rows at most
    # One number for each range that Spark's hash puts into a partition of its own.
    n = len(starts) or 1
    numbers = spark.range(40 * n).select(F.col("id").cast("int").alias("id")).groupBy(F.pmod(F.hash("id"), F.lit(n)).alias("part")).agg(F.min("id").alias("id")).collect()
    numbers = sorted(r.id for r in numbers) + [40 * n + k for k in range(n - len(numbers))]
    deal = _dealt([_order(r.url, r.page_id, r.hex) for r in starts], numbers)
    null = F.lit(None)
    rows = p.select("page_id", "url", "hex", null.cast("long").alias("first"), "html").mapInArrow(deal, _DEALT)
    rows = rows.unionByName(plan.select("page_id", "url", "hex", "first", null.cast("string").alias("html")).mapInArrow(deal, _DEALT))
    # The plan's row of a record stands before its payloads.
    rows = rows.repartition(n, "range").sortWithinPartitions("range", *key, F.col("z").isNotNull())
    manifest = rows.mapInArrow(_writer(root, roll_bytes, dict(zip(numbers, (r["at"] for r in starts), strict=False))), _MANIFEST)
    path = f"{root}/_manifest"
    manifest.write.parquet(path)
    release(plan)
    for left in fs.get_file_info(pafs.FileSelector(top)):
        if left.base_name.startswith("_temporary-"):
            fs.delete_file(left.path)
    return spark.read.schema(_MANIFEST).parquet(path)


def _members(stream) -> Iterator[bytes]:
    """The gzip members of a stream, one by one."""
    left = b""
    while True:
        one, parts = zlib.decompressobj(31), []
        while not one.eof:
            left = left or stream.read(1 << 16)
            if not left:
                if parts:
                    raise ValueError("the archive ends inside a record")
                return
            parts.append(one.decompress(left))
            left = one.unused_data
        yield b"".join(parts)


def parse(data: bytes) -> tuple:
    """(page_id, payload bytes, payload digest, type, refers_to, url, payload) of a record; digests are checked."""
    head, _, rest = data.partition(b"\r\n\r\n")
    field = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[: int(field["Content-Length"])]
    if base32(hashlib.sha1(block).digest()) != field["WARC-Block-Digest"].removeprefix("sha1:"):
        raise ValueError(f"block digest differs in {field['WARC-Record-ID']}")
    http, _, payload = block.partition(b"\r\n\r\n")
    n = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    digest, kind = field["WARC-Payload-Digest"].removeprefix("sha1:"), field["WARC-Type"]
    if kind == "response" and (len(payload) != n or base32(hashlib.sha1(payload).digest()) != digest):
        raise ValueError(f"payload differs in {field['WARC-Record-ID']}")
    number = lambda k: int(field[k]) if k in field else None
    return number("X-Page"), n, digest, kind, number("X-Refers-To-Page"), field["WARC-Target-URI"], payload if kind == "response" else None


def _reader(root: str, with_payload: bool):
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
    names = [x.split()[0] for x in _RECORD.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, top = _filesystem(root)

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

        for b in batches:
            for name, want in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                rows, found, size = [], 0, 0
                with fs.open_input_stream(f"{top}/{name}", compression=None) as stream:
                    for data in _members(stream):
                        row = parse(data)
                        rows.append(row if with_payload else (*row[:6], None))
                        found, size = found + 1, size + len(data)
                        if size >= 8 << 20:
                            yield batch(rows)
                            rows, size = [], 0
                if found != want:
                    raise ValueError(f"{name} has {found} records, its manifest row {want}")
                if rows:
                    yield batch(rows)

    return read


def read(spark: SparkSession, root: str, with_payload: bool = True) -> DataFrame:
    """The records of the files that the manifest below ``root`` lists, one file a task."""
    files = spark.read.schema(_MANIFEST).parquet(f"{root}/_manifest").select("file", "records")
    return files.repartition(max(1, files.count()), "file").mapInArrow(_reader(root, with_payload), _RECORD)


def round_trip(pages: DataFrame) -> DataFrame:
    """Archive the pages below the shared folder and read the archives back."""
    spark = pages.sparkSession
    root = scratch_path(spark, "warc")
    write(pages, root)
    return read(spark, root, with_payload=False).drop("payload")
