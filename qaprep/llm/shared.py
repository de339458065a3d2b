"""What the operators share: scratch tables, Arrow text chunks, vectorised words.

Python stages run as ``mapInArrow``.  A record batch is cut into chunks of a
bounded number of text bytes, and each chunk is handled as one byte buffer
with document offsets, so memory follows the chunk (or the longest single
document), never the partition.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: bytes of text handled at once inside a task
CHUNK_BYTES = 4 << 20

_MADE: list[str] = []


# ------------------------------------------------------------------ executors

_SHIPPED: set[str] = set()

#: rows of an Arrow batch, where the session has Spark's default of 10,000: rows here are whole texts
BATCH_ROWS = 2000


def ship(spark: SparkSession) -> None:
    """Let the Python workers import this package, and keep Arrow batches of texts small.

    Nothing to ship where it is on ``PYTHONPATH``; else the package goes along as a
    zip file, as with ``spark-submit --py-files``.  A batch size that the session
    sets itself stays as it is."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED or root in os.environ.get("PYTHONPATH", "").split(":"):
        return
    import zipfile
    path = os.path.join(tempfile.mkdtemp(prefix="qaprep-py-"), "qaprep.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(os.path.join(root, "qaprep")):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


# ------------------------------------------------------------- shared folder

def scratch_dir(spark: SparkSession) -> str:
    """The folder that all executors share (``spark.checkpoint.dir``).

    Only a local-mode session that names none gets a folder of its own."""
    ship(spark)
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None) \
        or sc.getCheckpointDir()
    if base:
        return base.rstrip("/")
    if sc.master.startswith("local-cluster") or not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    sc.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="qaprep-llm-", dir=os.environ.get("TMPDIR", "/tmp")))
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    path = f"{scratch_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    _MADE.append(path)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet in the shared folder and read it back.

    Cuts the lineage where a stage is read more than once: a lost executor
    re-reads the table instead of replaying the scoring before it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release_scratch(spark: SparkSession) -> None:
    """Delete the tables that this process made in the shared folder."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    while _MADE:
        p = jvm.org.apache.hadoop.fs.Path(_MADE.pop())
        p.getFileSystem(conf).delete(p, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        name = f"__{name}"
        while name in taken:
            name += "_"
        taken.add(name)
        out.append(name)
    return out


def held_out_column(doc_id="doc_id"):
    """True for the fold that nothing is learned from: crc32(id as text) mod 5 = 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


# ---------------------------------------------------------------- text chunks

class Chunk:
    """Rows of a record batch with one text column as bytes.

    ``data`` holds the texts back to back, ``offs`` (rows + 1) their bounds;
    a null text is empty."""

    def __init__(self, rows: pa.RecordBatch, col: str):
        self.rows = rows
        arr = rows.column(rows.schema.get_field_index(col))
        self.valid = np.asarray(pc.is_valid(arr))
        arr = pc.fill_null(arr.cast(pa.large_binary()), b"")
        off = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset:arr.offset + len(arr) + 1]
        buf = arr.buffers()[2]
        raw = np.frombuffer(buf, np.uint8) if buf is not None and buf.size else np.empty(0, np.uint8)
        self.data = raw[off[0]:off[-1]]
        self.offs = off - off[0]

    def __len__(self) -> int:
        return self.rows.num_rows

    def column(self, name: str) -> pa.Array:
        return self.rows.column(self.rows.schema.get_field_index(name))

    def text(self, i: int) -> bytes:
        return self.data[self.offs[i]:self.offs[i + 1]].tobytes()


def chunks(batches: Iterator[pa.RecordBatch], col: str, size: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Cut record batches into chunks of at most ``size`` bytes of ``col`` (a longer text: alone)."""
    for b in batches:
        if not b.num_rows:
            continue
        n = pc.fill_null(pc.binary_length(b.column(b.schema.get_field_index(col))), 0)
        ends = np.cumsum(np.asarray(n).astype(np.int64))
        at, done = 0, 0
        while at < b.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, done + size, "right")))
            yield Chunk(b.slice(at, to - at), col)
            done, at = int(ends[to - 1]), to


# ----------------------------------------------------- words as number arrays

def byte_set(spec: str) -> np.ndarray:
    """256-entry truth table of a byte class, e.g. ``'^ \\t-\\r'`` (ranges with '-')."""
    neg, spec = spec.startswith("^"), spec.removeprefix("^")
    out = np.zeros(256, bool)
    i = 0
    while i < len(spec):
        if i + 2 < len(spec) and spec[i + 1] == "-":
            out[ord(spec[i]):ord(spec[i + 2]) + 1] = True
            i += 3
        else:
            out[ord(spec[i])] = True
            i += 1
    return ~out if neg else out


#: words [^\x20\x09-\x0D]+
NON_SPACE = byte_set("^ \t-\r")
#: words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ (after A-Z are lower-cased)
ALNUM = byte_set("^\x00-\x2f\x3a-\x60\x7b-\x7f")

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def word_bounds(data: np.ndarray, offs: np.ndarray, members: np.ndarray):
    """Starts, ends and document numbers of the words in a chunk; no word crosses a document."""
    n = len(data)
    if not n:
        z = np.empty(0, np.int64)
        return z, z, z
    m = members[data]
    first = np.zeros(n, bool)
    inner = offs[:-1][offs[:-1] < offs[1:]]
    first[inner] = True
    before = np.zeros(n, bool)
    before[1:] = m[:-1]
    starts = np.flatnonzero(m & (first | ~before))
    after = np.zeros(n, bool)
    after[:-1] = m[1:] & ~first[1:]
    ends = np.flatnonzero(m & ~after) + 1
    return starts, ends, np.searchsorted(offs, starts, "right") - 1


def pieces(data: np.ndarray, size: int, members: np.ndarray) -> Iterator[tuple[int, int]]:
    """Bounds of pieces of about ``size`` bytes of one text that no word of ``members`` crosses."""
    at, n = 0, len(data)
    while at < n:
        to = min(n, at + size)
        while to < n and members[data[to]]:
            gap = np.flatnonzero(~members[data[to:to + size]])
            to = to + int(gap[0]) if len(gap) else min(n, to + size)
        yield at, to
        at = to


_MULT = np.uint64(0x9E3779B97F4A7C15 | 1)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("p", ())) < n + 1:
        size = max(n + 1, 1 << 16)
        inv = np.uint64(pow(int(_MULT), -1, 1 << 64))
        for key, base in (("p", _MULT), ("q", inv)):
            a = np.full(size, base, np.uint64)
            a[0] = 1
            _POWERS[key] = np.multiply.accumulate(a)
    return _POWERS["p"], _POWERS["q"]


_BYTE_VALUE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Prefix sums of a polynomial hash modulo 2**64 (random byte values)."""
    p, _ = _powers(len(data))
    out = np.empty(len(data) + 1, np.uint64)
    out[0] = 0
    np.cumsum(_BYTE_VALUE[data] * p[:len(data)], out=out[1:])
    return out


def mix(h: np.ndarray) -> np.ndarray:
    """Finisher that spreads a 64-bit hash over all its bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span [start, end)."""
    _, q = _powers(len(prefix) - 1)
    return mix((prefix[ends] - prefix[starts]) * q[starts] + (ends - starts).astype(np.uint64))


def per_doc(values: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Sum of ``values`` per document number."""
    return np.bincount(doc, weights=values, minlength=n)


def batch(schema: pa.Schema, *cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t.type)
                                       for c, t in zip(cols, schema, strict=True)], schema=schema)


def pack_model(arrays: dict[str, np.ndarray]) -> bytes:
    """A fitted model (bounded by its hash-table sizes) as one compressed blob."""
    import io
    out = io.BytesIO()
    np.savez(out, **arrays)
    return zlib.compress(out.getvalue(), 1)


def unpack_model(blob: bytes) -> dict[str, np.ndarray]:
    import io
    with np.load(io.BytesIO(zlib.decompress(blob))) as z:
        return {k: z[k] for k in z.files}
