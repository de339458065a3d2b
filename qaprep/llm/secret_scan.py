"""Secrets in texts: strong findings alone, weak candidates only in company.

Three strong kinds are reported wherever they stand: ``assign`` (a secret's name
with a value), ``access`` (an access key id) and ``hex`` (a long hexadecimal run).

Credentials often come in several parts, each of which means little by itself: an
identifier (``client_id = ...``), a secret (a short password, a random-looking
token), an endpoint (a url, a host).  Such weak candidates are linked by an interval
join: every part is an interval, its reach is that interval stretched by ``WINDOW``
code points and cut at the bounds of its scope (a paragraph: lines up to a blank
one), and a weak part is reported if parts that complete it lie within its reach:

* ``secret`` needs an identifier (strong or weak),
* ``ident`` needs a secret (strong or weak),
* ``endpoint`` needs an identifier and a secret.

A part never completes a part that it overlaps.  The join counts interval ends on
either side by binary search in sorted arrays, so a text costs its length plus its
parts times their logarithm, however many parts lie close together.  Documents are
independent: nothing is shuffled.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import chunks, ship

CHUNK = 1 << 20

#: code points between the parts of a credential
WINDOW = 300

#: in the order of reports that start at one place
KINDS = ("assign", "access", "hex", "ident", "secret", "endpoint")
STRONG = 3

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")
_ASSIGN_CHARS, _ACCESS_CHARS = 12, 18

_SET = r"""["']?[ \t]*[:=][ \t]*["']?"""
_IDENT = re.compile(
    r"(?<![A-Za-z0-9])(?:(?:client|account|tenant|app|application|access[_-]?key|project|subscription)[_-]?id"
    r"|user(?:[_-]?(?:name|id))?|login)" + _SET + r"([A-Za-z0-9._@+-]{3,128})"
    r"|(?<![A-Z0-9])A(?:SIA|IDA|ROA)[A-Z0-9]{12,128}", re.I | re.A)
_NAMED = re.compile(
    r"(?<![A-Za-z0-9])(?:pass(?:word|wd|phrase)?|pwd|secret|token|api_?key|auth|credentials?|private[_-]?key|signature)"
    + _SET + r"([A-Za-z0-9+/_.=!@#$%^&*-]{6,128})", re.I | re.A)
_TOKEN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,128}(?![A-Za-z0-9+/_=-])")
_ENDPOINT = re.compile(
    r"(?<![A-Za-z0-9])[A-Za-z][A-Za-z0-9+.-]{1,15}://[^\s\"'<>]{3,2048}"
    r"|(?<![A-Za-z0-9])(?:host(?:name)?|endpoint|server|base[_-]?url)" + _SET + r"[A-Za-z0-9._:/-]{3,256}"
    r"|(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}:[0-9]{2,5}(?![0-9])", re.I | re.A)
_BLANK = re.compile(r"\n[ \t\r\x0b\x0c]*\n")

# what any match of a kind holds, in lower case: a text without it is not searched
_HINTS = {"assign": ("passw", "secret", "token", "apikey", "api_key"),
          "ident": ("id", "user", "login", "asia", "aroa"),
          "named": ("pass", "pwd", "secret", "token", "key", "auth", "credential", "signature"),
          "endpoint": ("://", "host", "endpoint", "server", "base")}


def _spans(rx: re.Pattern, text: str, ok=None) -> np.ndarray:
    """(n, 2) starts and ends of the matches that pass ``ok``."""
    flat = [x for m in rx.finditer(text) if ok is None or ok(m) for x in m.span()]
    return np.array(flat, np.int64).reshape(-1, 2)


def _random_looking(m: re.Match) -> bool:
    """Upper case, lower case and digits, and at least ten different characters."""
    s = m[0]
    return len(set(s)) >= 10 and any("0" <= c <= "9" for c in s) and any("A" <= c <= "Z" for c in s) \
        and any("a" <= c <= "z" for c in s)


def _apart(spans: np.ndarray, others: np.ndarray) -> np.ndarray:
    """The spans that overlap none of ``others``."""
    if not len(spans) or not len(others):
        return spans
    return spans[_count(others, spans[:, 0], spans[:, 1]) == 0]


def _count(parts: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """How many intervals of ``parts`` overlap each open interval (lo, hi)."""
    return (np.searchsorted(np.sort(parts[:, 0]), hi, "left")
            - np.searchsorted(np.sort(parts[:, 1]), lo, "right"))


def _met(spans: np.ndarray, others: np.ndarray, scopes: np.ndarray, window: int) -> np.ndarray:
    """True for each span with one of ``others`` in its reach and not on it."""
    if not len(others):
        return np.zeros(len(spans), bool)
    at = np.searchsorted(scopes, spans[:, 0], "right") - 1
    lo = np.maximum(spans[:, 0] - window, scopes[at])
    hi = np.minimum(spans[:, 1] + window, scopes[at + 1])
    return _count(others, lo, hi) > _count(others, spans[:, 0], spans[:, 1])


def findings(text: str, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(kind numbers, (n, 2) code point spans) of a text, by start, then kind."""
    low = text.lower()

    def held(kind):
        return any(h in low for h in _HINTS[kind])

    none = np.empty((0, 2), np.int64)
    assign = _spans(_ASSIGN, text, lambda m: m.end(2) - m.start(2) >= _ASSIGN_CHARS) if held("assign") else none
    access = _spans(_ACCESS, text, lambda m: m.end() - m.start() >= _ACCESS_CHARS) if "AKIA" in text else none
    hexa = _spans(_HEX, text)
    found = [assign, access, hexa]

    ident = _spans(_IDENT, text) if held("ident") else none
    named = _spans(_NAMED, text) if held("named") else none
    ident = _apart(ident, np.concatenate([access, assign]))
    if len(ident) or len(access):  # without an identifier no weak part is ever complete
        token = _spans(_TOKEN, text, _random_looking)
        strong = np.concatenate(found)
        named = _apart(named, strong)
        token = _apart(token, np.concatenate([strong, named, ident]))
        weak = np.concatenate([named, token])
        endpoint = _spans(_ENDPOINT, text) if held("endpoint") or text.count(".") > 2 else none
        endpoint = _apart(endpoint, np.concatenate([strong, ident, weak]))
        scopes = np.array([0, *(m.end() for m in _BLANK.finditer(text)), len(text) + 1], np.int64)
        long_hex = hexa[hexa[:, 1] - hexa[:, 0] >= 20]
        idents, secrets = np.concatenate([access, ident]), np.concatenate([assign, long_hex, weak])
        ident_ok = _met(ident, secrets, scopes, window)
        weak_ok = _met(weak, idents, scopes, window)
        end_ok = _met(endpoint, secrets, scopes, window) & _met(endpoint, idents, scopes, window)
        found += [ident[ident_ok], weak[weak_ok], endpoint[end_ok]]
    kind = np.repeat(np.arange(len(found)), [len(x) for x in found])
    spans = np.concatenate(found)
    order = np.lexsort((spans[:, 1], kind, spans[:, 0]))
    return kind[order], spans[order]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(doc_id, findings) of every row: findings are structs (kind, start, end), in code
    points of the whole text, end exclusive, by start, then in the order of ``KINDS``.

    A null or empty text has an empty list.  Null ids and repeated rows return a row
    each; other columns are not looked at; an empty table gives an empty result."""
    ship(docs.sparkSession)
    names = pa.array(KINDS)

    def run(batches):
        for ch in chunks(batches, "text", CHUNK):
            got = [findings(t or "", window) for t in ch.column("text").to_pylist()]
            offs = np.cumsum([0] + [len(k) for k, _ in got]).astype(np.int32)
            kind = np.concatenate([k for k, _ in got])
            spans = np.concatenate([s for _, s in got])
            parts = pa.StructArray.from_arrays(
                [names.take(pa.array(kind)), pa.array(spans[:, 0]), pa.array(spans[:, 1])], ["kind", "start", "end"])
            yield pa.RecordBatch.from_arrays([ch.column("doc_id"), pa.ListArray.from_arrays(offs, parts)],
                                             ["doc_id", "findings"])

    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, findings ARRAY<STRUCT<kind: STRING, start: BIGINT, `end`: BIGINT>>")


def span_list(found: Column) -> Column:
    """``kind:start:end`` of all findings, comma-joined."""
    return F.array_join(F.transform(found, lambda f: F.concat_ws(
        ":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))), ",")


def report(docs: DataFrame) -> DataFrame:
    """Counts and digests of the findings of every document."""
    found = F.col("findings")

    def count(kind):
        return F.size(F.filter(found, lambda f: f["kind"] == kind)).cast("long")

    base = F.filter(found, lambda f: f["kind"].isin(*KINDS[:STRONG]))
    return scan(docs).select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(span_list(base).cast("binary"), 256).alias("base_sha256"), span_list(found).alias("spans"),
        (F.size(found) - F.size(base)).cast("long").alias("n_linked"))
