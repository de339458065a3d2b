"""Many short strings searched in many documents, each document read once.

An Aho-Corasick automaton over the strings finds all of them, nested and overlapping
ones too, in one pass over a text, so the time follows the text and the hits, not the
number of strings.  The strings go to the tasks as a broadcast of a checked size: they
are dealt into blocks of at most ``BLOCK_CHARS`` characters and ``BLOCK_ITEMS`` strings,
and the documents are read once per block (one block, unless there are very many).
"""

from __future__ import annotations

from typing import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package

BLOCK_CHARS, BLOCK_ITEMS = 1 << 24, 1 << 20
SALTS = 64

#: the automaton last built by this Python worker
_BUILT: dict[int, object] = {}


def _automaton(model):
    key = model.value[0]
    if key not in _BUILT:
        import ahocorasick
        found = ahocorasick.Automaton()
        for text, number in model.value[1].items():
            found.add_word(text, number)
        found.make_automaton()
        _BUILT.clear()
        _BUILT[key] = found
    return _BUILT[key]


def _search(model, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _automaton(model)
        for b in batches:
            row, hit = [], []
            for i, text in enumerate(b.column(1)):
                found = {number for _, number in machine.iter(text.as_py())}
                row += [i] * len(found)
                hit += found
            if row:
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row)), pa.array(hit, pa.int64())],
                                                 schema=schema)
    return run


def contained(texts: DataFrame, items: DataFrame, doc_key: str, doc_text: str, item_key: str, item_text: str,
              block_chars: int = BLOCK_CHARS, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """(item, doc) for every item whose text occurs in a document's text, once each.

    A blank item occurs in every text; a null text holds nothing and null items occur
    nowhere.  Items of one text share a place in the automaton."""
    spark = texts.sparkSession
    ship_package(spark)
    docs = texts.where(F.col(doc_text).isNotNull()).select(doc_key, F.col(doc_text).alias("_dtext"))
    items = items.where(F.col(item_text).isNotNull()).select(item_key, F.col(item_text).alias("_itext"))
    words = items.where(F.col("_itext") != "").groupBy("_itext").agg(F.min(F.xxhash64("_itext")).alias("_h"))
    size = words.agg(F.coalesce(F.sum(F.length("_itext")), F.lit(0)), F.count("*")).first()
    blocks = max(-(-size[0] // block_chars), -(-size[1] // block_items))
    # every document pairs with every blank item: the documents are dealt by salts, the items go to each
    salt = F.pmod(F.xxhash64(doc_key), F.lit(SALTS)).cast("int")
    blank = items.where(F.col("_itext") == "").select(item_key, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_k"))
    out = docs.select(doc_key, salt.alias("_k")).join(blank, "_k").select(item_key, doc_key)
    key_type = docs.schema[doc_key].dataType
    from pyspark.sql.pandas.types import to_arrow_type
    schema = pa.schema([("_doc", to_arrow_type(key_type)), ("_n", pa.int64())])
    for b in range(blocks):
        mine = sorted(r[0] for r in words.where(F.pmod("_h", F.lit(blocks)) == b).select("_itext").collect())
        model = spark.sparkContext.broadcast((hash((b, blocks, *mine)), {t: n for n, t in enumerate(mine)}))
        number = spark.createDataFrame(list(enumerate(mine)), "_n BIGINT, _itext STRING") if mine else None
        if number is None:
            continue
        hits = docs.select(doc_key, "_dtext").mapInArrow(_search(model, schema), f"_doc {key_type.simpleString()}, _n BIGINT")
        which = items.join(number, "_itext").select(item_key, "_n")
        out = out.unionByName(hits.join(which, "_n").select(item_key, F.col("_doc").alias(doc_key)))
    return out
