"""WARC archives: a writer of gzip-member records and a splittable reader.

Writing: each task writes one archive file into a shared folder, one gzip member
per record.  Payloads that are equal and long enough are written once, as the
``response`` of the smallest page id; the others become ``revisit`` records.

Reading: archives are cut into byte ranges and every range is a task row.  A task
scans its range for the gzip magic, takes a position as a candidate member only
if its header decodes to a WARC version line and a complete header block, and
owns every record that *starts* inside its range, reading past the end where the
last one does.  A magic that appears by chance inside a member does not inflate
to a WARC header, and a range that begins inside a member finds the next one.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import materialize, scratch_path, ship

#: payload bytes from which an equal payload is written as a revisit
REVISIT_BYTES = 100
#: bytes of archive that a reading task scans, and bytes read at once
SPLIT_BYTES, BLOCK = 16 << 20, 1 << 20
#: salts of the join that finds the response of a payload
SALTS = 16

_MAGIC = b"\x1f\x8b\x08"
_VERSION = b"WARC/1.1"


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") \
        else (pafs.LocalFileSystem(), path)


# ------------------------------------------------------------------- writing

def encode_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
                  revisit: bool) -> bytes:
    """One record as a gzip member."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http if revisit else http + payload
    name = "" if page_id is None else str(page_id)
    head = [_VERSION.decode(), f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: <urn:page:{name}>", "WARC-Date: 1970-01-01T00:00:00Z",
            f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {len(payload)}",
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if url is not None:
        # header lines end at a line break; a url holds none once it is quoted
        head.append("WARC-Target-URI: " + url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A"))
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <urn:page:{refers_to}>"]
    raw = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    squeeze = zlib.compressobj(1, zlib.DEFLATED, 31)
    return squeeze.compress(raw) + squeeze.flush()


def plan_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                 least: int = REVISIT_BYTES) -> DataFrame:
    """(page_id, url, payload, digest, refers_to, revisit): what each page is written as.

    Of equal payloads of at least ``least`` bytes the smallest page id is the
    response; of rows that repeat that id, and of rows without id if there is no
    other, each is a response."""
    src = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                       F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary").alias("payload"))
    src = src.withColumn("digest", F.sha2("payload", 256)).withColumn("salt", F.expr(
        f"CAST(pmod(xxhash64(page_id), {SALTS}) AS INT)"))
    first = (src.where(F.octet_length("payload") >= least).groupBy("digest")
             .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 AND first IS NOT NULL"))
    # a payload may be a third of all pages: its rows join from several salts
    first = first.select("digest", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    out = src.join(first, ["digest", "salt"], "left")
    revisit = F.coalesce(F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id")), F.lit(False))
    return out.select("page_id", "url", "payload", "digest",
                      F.when(revisit, F.col("first")).alias("refers_to"), revisit.alias("revisit"))


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Write planned records below ``folder``; (path, bytes, records) of the finished files.

    A file has a name of its own for each attempt and counts only if its task
    ended: a lost or repeated task leaves a file that no row names."""
    ship(records.sparkSession)

    def run(batches):
        fs, root = _filesystem(folder)
        out, size, count, path = None, 0, 0, f"{root}/{uuid.uuid4().hex}.warc.gz"
        for b in batches:
            cols = {n: b.column(b.schema.get_field_index(n)) for n in b.schema.names}
            for i in range(b.num_rows):
                if out is None:
                    fs.create_dir(root, recursive=True)
                    out = fs.open_output_stream(path, compression=None)
                v = {n: c[i].as_py() for n, c in cols.items()}
                raw = encode_record(v["page_id"], v["url"], v["payload"], v["digest"], v["refers_to"], v["revisit"])
                out.write(raw)
                size, count = size + len(raw), count + 1
        if out is not None:
            out.close()
            uri = folder.rstrip("/") + path[len(root):]
            yield pa.RecordBatch.from_arrays([pa.array([uri]), pa.array([size], pa.int64()),
                                              pa.array([count], pa.int64())], ["path", "bytes", "records"])

    return records.mapInArrow(run, "path STRING, bytes BIGINT, records BIGINT")


# ------------------------------------------------------------------- reading

class _Window:
    """Reads of a file through one block of it that is kept."""

    def __init__(self, f):
        self.f, self.at, self.block = f, 0, b""

    def read(self, pos: int, n: int) -> bytes:
        if pos < self.at or pos + n > self.at + len(self.block):
            self.f.seek(pos)
            self.at, self.block = pos, self.f.read(max(n, BLOCK))
        return self.block[pos - self.at:pos - self.at + n]


def _member(w: _Window, at: int, size: int):
    """(inflated bytes, end position) of the record in a gzip member at ``at``; None if
    there is none: it does not inflate, or not to a WARC version line and header block."""
    inflate, out, pos, step = zlib.decompressobj(31), bytearray(), at, 2048
    while pos < size and not inflate.eof:
        raw = w.read(pos, min(step, size - pos))
        if not raw:
            break
        pos += len(raw)
        try:
            out += inflate.decompress(raw)
        except zlib.error:
            return None
        if not _VERSION.startswith(out[:len(_VERSION)]):
            return None
        step = min(2 * step, BLOCK)
    if not inflate.eof or b"\r\n\r\n" not in out:
        return None
    return bytes(out), pos - len(inflate.unused_data)


def parse_record(raw: bytes) -> dict | None:
    """Header fields and block of an inflated record; None if it is cut short."""
    head, found, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not found or not lines[0].startswith("WARC/"):
        return None
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    size = int(fields.get("content-length", "-1"))
    if size < 0 or len(rest) < size:
        return None
    return {"fields": fields, "block": rest[:size]}


def records_in_range(f, size: int, start: int, end: int):
    """(position, inflated record) of the records that start in [start, end)."""
    at, w, more = start, _Window(f), len(_MAGIC) - 1
    while at < end:
        if w.read(at, len(_MAGIC)) != _MAGIC:
            # next magic after ``at``; it may straddle two blocks
            block = w.read(at, min(1 << 16, end - at) + more)
            hit = block.find(_MAGIC)
            at += hit if hit >= 0 else max(1, len(block) - more)
            continue
        member = _member(w, at, size)
        if member is None or parse_record(member[0]) is None:
            at += 1
            continue
        yield at, member[0]
        at = member[1]  # the next member, if it starts inside the range


def _urn(value: str | None) -> int | None:
    text = (value or "").removeprefix("<urn:page:").removesuffix(">")
    return int(text) if text else None


def splits(files: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """(path, bytes, start, end): byte ranges of the archives."""
    starts = F.expr(f"sequence(CAST(0 AS BIGINT), greatest(bytes - 1, 0), CAST({split_bytes} AS BIGINT))")
    return files.select("path", "bytes", F.explode(starts).alias("start")) \
        .withColumn("end", F.expr(f"least(start + {split_bytes}, bytes)"))


def read_archives(files: DataFrame, split_bytes: int = SPLIT_BYTES, tasks: int | None = None) -> DataFrame:
    """Records of the archives named by ``files`` (path, bytes): path, position, page_id, url,
    record_type, refers_to, payload_bytes, payload_digest, payload (null for a revisit).

    Length and digest of a response are those of the payload that was read; a
    revisit has none, and gives those of the payload that it stands for."""
    spark = files.sparkSession
    ship(spark)
    schema = pa.schema([("path", pa.string()), ("position", pa.int64()), ("page_id", pa.int64()),
                        ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])

    def run(batches):
        for b in batches:
            for path, size, start, end in zip(*(b.column(i).to_pylist() for i in range(4))):
                fs, name = _filesystem(path)
                rows, held = [], 0
                with fs.open_input_file(name) as f:
                    for at, raw in records_in_range(f, size, start, end):
                        r = parse_record(raw)
                        h = r["fields"]
                        payload = r["block"].partition(b"\r\n\r\n")[2]
                        if h["warc-type"] == "revisit":
                            n, digest, payload = int(h["x-payload-length"]), h["warc-payload-digest"], None
                        else:
                            n, digest = len(payload), hashlib.sha256(payload).hexdigest()
                        url = h.get("warc-target-uri")
                        if url is not None:
                            url = url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
                        rows.append((path, at, _urn(h.get("warc-record-id")), url, h["warc-type"],
                                     _urn(h.get("warc-refers-to")), n, digest.removeprefix("sha256:"), payload))
                        held += len(raw)
                        if held > 4 * BLOCK:
                            yield _rows(rows, schema)
                            rows, held = [], 0
                if rows:
                    yield _rows(rows, schema)

    ranges = splits(files, split_bytes)
    ranges = ranges.repartition(tasks or spark.sparkContext.defaultParallelism * 2, "path", "start")
    return ranges.mapInArrow(run, "path STRING, position BIGINT, page_id BIGINT, url STRING, record_type STRING, "
                                  "refers_to BIGINT, payload_bytes BIGINT, payload_digest STRING, payload BINARY")


def _rows(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)


def round_trip(spark: SparkSession, pages: DataFrame, folder: str | None = None, id_col: str = "page_id",
               url_col: str = "url", html_col: str = "html", split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Write ``pages`` as archives below ``folder`` (by default in the shared folder) and
    return what the reader finds.

    A null html is an empty payload; empty and short payloads are always responses.
    Repeated rows and null ids or urls are records of their own.  Other columns are
    not looked at.  An empty table gives an empty result."""
    folder = folder or scratch_path(spark, "warc")
    planned = plan_records(pages, id_col, url_col, html_col)
    files = materialize(write_archives(planned, folder), "archives")
    return read_archives(files, split_bytes)
