"""Quoted CSV read by many tasks per file.

Spark reads a CSV with line breaks inside fields by one task per file, because a
line break ends a record only outside quotes, which a task that starts in the
middle of a file cannot know.  Here the text source deals byte ranges to tasks
(it owns every line that begins in its range), and quote parity settles the rest:

1. *Count*: quotes per range; one aggregation, narrow rows only.
2. *Prefix*: the parity of all quotes before a range, per file.  An odd one means
   that the range begins inside a quoted field.
3. *Cut*: a second scan cuts each range into the records that begin in it, in Arrow
   batches (a line begins a record if the quotes before it are even, so record bounds
   are a subset of line bounds and no text is copied apart).  No text is shuffled.
4. *Join*: only the record that crosses the end of a range is put together from its
   first part and the parts that later ranges begin with.

Records are parsed by Spark's own ``from_csv``.  As in RFC 4180 a quote stands only
around a field or doubled inside it.  The ranges of the first two steps reach the
third by a broadcast join of 16 bytes a range of odd parity, that is 16 bytes for
each ``spark.sql.files.maxPartitionBytes`` of input.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package

_RECORD, _HEAD, _TAIL = 0, 1, 2
_CUT = "file STRING, start BIGINT, seq BIGINT, kind INT, text STRING"
_cut_schema = pa.schema([("file", pa.string()), ("start", pa.int64()), ("seq", pa.int64()), ("kind", pa.int32()),
                         ("text", pa.string())])


class _Range:
    """One byte range: its quotes so far and the parts of the record that is still open."""

    def __init__(self, file: str, start: int, odd: bool):
        self.file, self.start, self.quotes = file, start, int(odd)
        self.open: list[bytes] = []
        self.own = False  # the open record begins in this range
        self.seq = 0

    def _row(self, kind: int, text: pa.Array) -> pa.RecordBatch:
        n = len(text)
        seq = np.arange(self.seq, self.seq + n)
        self.seq += n
        return pa.RecordBatch.from_arrays(
            [pa.array([self.file]).take(pa.array(np.zeros(n, np.int64))), pa.array(np.full(n, self.start)),
             pa.array(seq), pa.array(np.full(n, kind, np.int32)), text.cast(pa.string())], schema=_cut_schema)

    def _close(self, kind: int) -> Iterator[pa.RecordBatch]:
        if self.open:
            yield self._row(kind, pa.array([b"".join(self.open)], pa.binary()))
        self.open = []

    def add(self, lines: pa.Array) -> Iterator[pa.RecordBatch]:
        """The records that are complete once ``lines`` are read."""
        if self.start == 0 and not self.own:  # empty lines before the header
            blank = np.asarray(pc.is_in(lines, pa.array(["", "\r"])))
            lines = lines.slice(int(np.argmin(blank)) if not blank.all() else len(lines))
            if not len(lines):
                return
        count = np.asarray(pc.count_substring(lines, '"')).astype(np.int64)
        before = self.quotes + np.cumsum(count) - count
        self.quotes += int(count.sum())
        text = pc.binary_join_element_wise(  # line + "" + separator
            lines.cast(pa.large_binary()), *(pa.scalar(x, pa.large_binary()) for x in (b"", b"\n")))
        off = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
        data = text.buffers()[2]
        first = np.flatnonzero(before % 2 == 0)
        cut = off[first] if len(first) else off[-1:]
        if cut[0] > off[0]:
            self.open.append(data[int(off[0]):int(cut[0])].to_pybytes())
        if not len(first):
            return
        yield from self._close(_RECORD if self.own else _HEAD)
        self.own = True
        if len(first) > 1:
            yield self._row(_RECORD, pa.Array.from_buffers(
                pa.large_binary(), len(cut) - 1, [None, pa.py_buffer(cut.tobytes()), data]).cast(pa.large_string()))
        self.open.append(data[int(cut[-1]):int(off[-1])].to_pybytes())

    def end(self) -> Iterator[pa.RecordBatch]:
        yield from self._close(_HEAD if not self.own else _TAIL if self.quotes % 2 else _RECORD)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now: _Range | None = None
    for b in batches:
        if not b.num_rows:
            continue
        start = np.asarray(b.column(1))
        files = pc.dictionary_encode(b.column(0))
        code = np.asarray(files.indices)
        change = np.flatnonzero((start[1:] != start[:-1]) | (code[1:] != code[:-1])) + 1
        bounds = [0, *change.tolist(), b.num_rows]
        for i, j in zip(bounds, bounds[1:]):
            file = files.dictionary[int(code[i])].as_py()
            if now is None or (now.file, now.start) != (file, int(start[i])):
                if now is not None:
                    yield from now.end()
                now = _Range(file, int(start[i]), b.column(2)[i].as_py())
            yield from now.add(b.column(3).slice(i, j - i))
    if now is not None:
        yield from now.end()


def csv_records(spark: SparkSession, path: str | list[str], encoding: str = "UTF-8") -> DataFrame:
    """(file, start, seq, text): every record of the files, with its trailing line break.

    Order within a file is (start, seq).  Empty lines between records are left out."""
    if encoding.upper().replace("_", "-").startswith(("UTF-16", "UTF-32")):
        raise ValueError("line breaks are searched as single bytes; convert UTF-16 and UTF-32 first")
    ship_package(spark)
    src = spark.read.option("lineSep", "\n").text(path)
    value = F.col("value")
    if encoding.upper() not in ("UTF-8", "UTF8"):
        value = F.decode(value.cast("binary"), encoding)
    lines = src.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                       value.alias("text"))
    quotes = F.length("text") - F.length(F.replace("text", F.lit('"'), F.lit("")))
    counts = lines.groupBy("file", "start").agg(F.sum(quotes).alias("quotes"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    odd = (counts.select("file", "start", F.coalesce(F.sum("quotes").over(before), F.lit(0)).alias("q"))
           .where(F.col("q") % 2 == 1).select(F.xxhash64("file", "start").alias("range")))
    cut = (lines.withColumn("range", F.xxhash64("file", "start"))
           .join(F.broadcast(odd.withColumn("odd", F.lit(True))), "range", "left")
           .select("file", "start", F.coalesce("odd", F.lit(False)).alias("odd"), "text").mapInArrow(_cut, _CUT))
    whole = cut.where(F.col("kind") == _RECORD).select("file", "start", "seq", "text")
    parts = cut.where(F.col("kind") != _RECORD)
    chain = Window.partitionBy("file").orderBy("start", "seq").rowsBetween(Window.unboundedPreceding, 0)
    parts = parts.withColumn("nr", F.count(F.when(F.col("kind") == _TAIL, 1)).over(chain))
    joined = (parts.groupBy("file", "nr").agg(F.array_sort(F.collect_list(F.struct("start", "seq", "text"))).alias("p"))
              .select("file", F.col("p")[0]["start"].alias("start"), F.col("p")[0]["seq"].alias("seq"),
                      F.array_join(F.transform("p", lambda x: x["text"]), "").alias("text")))
    return whole.unionByName(joined).where(~F.col("text").isin("\n", "\r\n"))


def read_csv(spark: SparkSession, path: str | list[str], schema: str, header: bool = True, encoding: str = "UTF-8",
             order: bool = False) -> DataFrame:
    """Rows of quoted CSV files by ``schema`` (columns by position), any file by many tasks.

    Columns of ``schema`` that the folders name (``type=train/``) come from there.
    ``order`` adds ``_file``, ``_start`` and ``_seq``, which sort the rows as in the
    files.  The first record of a file is its header unless ``header`` is False."""
    rec = csv_records(spark, path, encoding)
    if header:
        rec = rec.where((F.col("start") > 0) | (F.col("seq") > 0))
    fields = T.StructType.fromDDL(schema).fields
    folders = [c for c in spark.read.text(path).columns if c != "value"]
    in_file = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields if f.name not in folders)
    # a file with \r\n between records has it inside fields too; there it is one line break
    text = F.when(F.col("text").endswith("\r\n"), F.replace("text", F.lit("\r\n"), F.lit("\n"))).otherwise(F.col("text"))
    row = F.from_csv(F.regexp_replace(text, "\\n\\z", ""), in_file,
                     {"quote": '"', "escape": '"', "multiLine": "true"})
    out = rec.select(row.alias("r"), F.col("file").alias("_file"), F.col("start").alias("_start"),
                     F.col("seq").alias("_seq"))

    def column(f):
        if f.name not in folders:
            return F.col("r")[f.name].alias(f.name)
        name = F.regexp_extract("_file", f"/{f.name}=([^/]*)/", 1)
        for _ in range(2):  # escaped as a folder name, then as part of a path
            name = F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))
        return F.nullif(name, F.lit("__HIVE_DEFAULT_PARTITION__")).cast(f.dataType).alias(f.name)
    return out.select(*map(column, fields), *(["_file", "_start", "_seq"] if order else []))
