"""SimHash near-duplicate groups by anchor-point covering.

Two 64-bit fingerprints that differ in at most three bits differ in at most
one bit of their lower or of their upper half.  Each half is covered by a
product code: the perfect Hamming(31, 26) code on 31 bits (covering radius 1)
times the free 32nd bit.  A fingerprint is *at home* at its nearest anchor
(distance <= 1) and is replicated to every anchor within covering radius plus
threshold (1 + 1 = 2): at most 17 per half.  If two halves differ in one bit,
one fingerprint visits the anchor where the other is at home, so comparing
homes with visitors per anchor finds every link.

Skew: equal fingerprints are one row before anything is replicated.  An anchor
that more than ``HOT_ANCHOR`` distinct fingerprints visit is refined: of the
four bytes of the other half at least one is equal (three differing bits), so
its rows are dealt by (anchor, byte number, byte value).  Per anchor only a
spanning forest of the links is returned, never all pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components, forest
from .shared import batch, chunks, fresh, materialize, ship

#: words in a shingle and largest number of differing bits (fixed by the contract)
SHINGLE, MAX_BITS = 3, 3
#: distinct fingerprints at one anchor above which its rows are dealt again
HOT_ANCHOR = 4096
#: pairs compared at once in a task
PAIR_BLOCK = 1 << 21

_FP = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64()), ("text_hash", pa.int64())])


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of a text: bit set if set in over half of the shingle hashes."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(g, 42) for g in grams], np.uint64)
    ones = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp, text_hash) of whole texts; null and word-less texts have fingerprint 0."""
    ship(docs.sparkSession)

    def run(batches):
        for c in chunks(batches, "text"):
            fps = np.array([fingerprint(c.text(i), shingle) for i in range(len(c))], np.uint64)
            yield batch(_FP, c.column("doc_id").cast(pa.int64()), fps.view(np.int64), c.column("text_hash"))
    text = F.col(text_col).cast("string")
    src = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text.alias("text"),
                      F.xxhash64(text).alias("text_hash"))
    return src.mapInArrow(run, "doc_id BIGINT, fp BIGINT, text_hash BIGINT")


# ------------------------------------------------------------------- anchors

_PAIRS = np.array([[(i, i ^ s) for i in range(1, 32) if i < (i ^ s)] for s in range(1, 32)], np.uint32)


def _syndrome(x: np.ndarray) -> np.ndarray:
    s = np.zeros(len(x), np.uint32)
    for i in range(31):
        s ^= ((x >> np.uint32(i)) & np.uint32(1)) * np.uint32(i + 1)
    return s


def anchors_of(half: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, anchor, home) for 32-bit halves: the anchors within distance 2 and
    whether the anchor is the nearest one."""
    one, top = np.uint32(1), np.uint32(1 << 31)
    s = _syndrome(half)
    near = np.where(s > 0, half ^ (one << (np.maximum(s, 1) - one)), half)
    rows = np.arange(len(half))
    odd = np.flatnonzero(s)
    flips = _PAIRS[s[odd] - 1] - one  # rows x 15 x 2 bit numbers
    far = half[odd, None] ^ (one << flips[:, :, 0]) ^ (one << flips[:, :, 1])
    row = np.concatenate([rows, rows, np.repeat(odd, far.shape[1])])
    anchor = np.concatenate([near, near ^ top, far.ravel()])
    return row, anchor, np.arange(len(row)) < len(half)


def _replicate(batches):
    schema = pa.schema([("anchor", pa.int64()), ("fp", pa.int64()), ("home", pa.bool_())])
    for b in batches:
        fp = np.asarray(b.column(0)).astype(np.int64).view(np.uint64)
        for side in (0, 1):
            half = (fp >> np.uint64(32 * side)).astype(np.uint32)
            row, anchor, home = anchors_of(half)
            yield batch(schema, anchor.astype(np.int64) | (side << 32), fp[row].view(np.int64), home)


def _links_per_group(batches, keys: list[str], max_bits: int):
    """Spanning links of each group of consecutive rows with equal ``keys``."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def links(key_cols, fp, home):
        n = len(fp)
        cut = np.zeros(n, bool)
        cut[0] = True
        for k in key_cols:
            cut[1:] |= k[1:] != k[:-1]
        first = np.flatnonzero(cut)
        size = np.diff(np.append(first, n))
        group = np.cumsum(cut) - 1
        homes = np.flatnonzero(home)
        width = size[group[homes]]
        at, ends = 0, np.cumsum(width)
        while at < len(homes):
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + PAIR_BLOCK, "right")))
            h, w = homes[at:to], width[at:to]
            i = np.repeat(h, w)
            j = np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w) + np.repeat(first[group[h]], w)
            ok = (np.bitwise_count(fp[i] ^ fp[j]) <= max_bits) & (fp[i] != fp[j])
            if ok.any():
                yield batch(schema, *(x.view(np.int64) for x in forest(fp[i[ok]], fp[j[ok]])))
            at = to

    held = None
    for b in batches:
        if not b.num_rows:
            continue
        cols = [np.asarray(b.column(b.schema.get_field_index(k))) for k in keys]
        cols += [np.asarray(b.column(b.schema.get_field_index("fp"))).astype(np.int64).view(np.uint64),
                 np.asarray(b.column(b.schema.get_field_index("home")).cast(pa.int8())).astype(bool)]
        if held is not None:
            cols = [np.concatenate(p) for p in zip(held, cols)]
        last = np.ones(len(cols[0]), bool)
        for k in cols[:len(keys)]:
            last &= k == k[-1]
        done = int(np.flatnonzero(~last)[-1]) + 1 if not last.all() else 0  # the last group may go on
        if done:
            yield from links([k[:done] for k in cols[:len(keys)]], cols[-2][:done], cols[-1][:done])
        held = [c[done:] for c in cols]
    if held is not None and len(held[0]):
        yield from links(held[:len(keys)], held[-2], held[-1])


def near_links(distinct_fps: DataFrame, max_bits: int = MAX_BITS, hot: int = HOT_ANCHOR) -> DataFrame:
    """(u, v): links that connect all fingerprints (column ``fp``, distinct)
    within ``max_bits`` (at most 3) of each other, as a spanning forest per anchor."""
    if not 0 <= max_bits <= 3:
        raise ValueError("the covering of two halves holds for at most 3 differing bits")
    spots = distinct_fps.select("fp").mapInArrow(_replicate, "anchor BIGINT, fp BIGINT, home BOOLEAN")
    # visitors of one anchor: the fingerprints there, and those at home
    seen = spots.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.max("home").alias("used"))
    seen = materialize(seen.where("used AND n > 1").select("anchor", "n"), "anchor-sizes")
    spots = materialize(spots.join(seen, "anchor"), "anchors")
    even = (spots.where(F.col("n") <= hot).repartition("anchor").sortWithinPartitions("anchor")
            .mapInArrow(lambda it: _links_per_group(it, ["anchor"], max_bits), "u BIGINT, v BIGINT"))
    byte = F.expr("transform(sequence(0, 3), j -> struct(j AS j, "
                  "shiftright(fp, CAST(8 * j AS INT) + IF(anchor >= 4294967296, 0, 32)) & 255 AS byte))")
    dealt = (spots.where(F.col("n") > hot).withColumn("k", F.explode(byte))
             .select("anchor", F.col("k.j").alias("j"), F.col("k.byte").alias("byte"), "fp", "home"))
    again = (dealt.repartition("anchor", "j", "byte").sortWithinPartitions("anchor", "j", "byte")
             .mapInArrow(lambda it: _links_per_group(it, ["anchor", "j", "byte"], max_bits),
                         "u BIGINT, v BIGINT"))
    return even.unionByName(again)


def group_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   shingle: int = SHINGLE, max_bits: int = MAX_BITS, hot: int = HOT_ANCHOR) -> DataFrame:
    """(doc_id, fingerprint, component_id, text_hash, group_fingerprint) of every document.

    Documents whose fingerprints differ in at most ``max_bits`` bits are
    linked; ``component_id`` is the smallest id that can be reached (the own id
    included).  Null and word-less texts have fingerprint zero and link like any
    other.  A repeated row, or two rows with one id, are documents of their own
    and each returns a row; a null id is never the smallest unless all of a group
    are null, then ``component_id`` is null; ``group_fingerprint``, the smallest of
    the group, tells groups apart in any case.  Other columns of ``docs`` are not
    looked at.  An empty table gives an empty result."""
    fps = materialize(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    least = fps.groupBy("fp").agg(F.min("doc_id").alias("low"))
    roots = connected_components(near_links(least, max_bits, hot))
    tagged = least.join(roots.withColumnRenamed("node", "fp"), "fp", "left") \
        .select("fp", "low", F.coalesce("root", "fp").alias("root"))
    tagged = materialize(tagged, "groups")
    comp = tagged.groupBy("root").agg(F.min("low").alias("component_id"))
    by_fp = materialize(tagged.join(comp, "root").select("fp", "component_id", "root"), "group-ids")

    def digits(c):
        return F.lpad(F.lower(F.hex(c)), 16, "0")
    return fps.join(by_fp, "fp").select("doc_id", digits("fp").alias("fingerprint"), "component_id", "text_hash",
                                        digits("root").alias("group_fingerprint"))


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   shingle: int = SHINGLE, max_bits: int = MAX_BITS, hot: int = HOT_ANCHOR) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every document: ``group_rows`` without its hashes."""
    return group_rows(docs, id_col, text_col, shingle, max_bits, hot).select("doc_id", "fingerprint", "component_id")


def keep_one(docs: DataFrame, groups: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each of its ``groups`` (``group_rows(docs)``): that with
    the smallest id (null ids last), of several with this id that with the smallest hash of
    its text, of rows that repeat it one.

    Groups are told apart by their fingerprints, so ids that repeat in other groups, or
    are null, leave one row a group as well; ``simhash_groups`` does not hold them, and
    they are then found here."""
    if "group_fingerprint" not in groups.columns:
        groups = group_rows(docs, id_col, text_col)
    i, t, h = fresh(docs, "id", "text", "hash")
    row = F.struct(F.col("doc_id").isNull(), F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"))
    stay = (groups.groupBy("group_fingerprint").agg(F.min(row).alias("row"))
            .select(F.col("row.id").alias(i), F.col("row.hash").alias(t)))
    on = F.col(id_col).cast("bigint").eqNullSafe(F.col(i)) & (F.col(h) == F.col(t))
    return (docs.withColumn(h, F.xxhash64(F.col(text_col).cast("string"))).join(stay, on, "left_semi")
            .dropDuplicates([id_col, h]).drop(h))
