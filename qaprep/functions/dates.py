"""Column expressions for date mentions inside prose.

Dates are text only: a mention is found by ``DATE_RX``, split on
whitespace, and each part that is an English month name or a non-zero
four-digit integer is swapped for a false one.  The swaps are applied as an
ordered fold of literal replace-all calls, so a later mention sees the text
produced by the earlier ones (the cascade the surveyed tool has).

All randomness is ``hash60(seed, key, mention_no, part_no)``; both indexes
are 0-based.  Everything stays JVM-side (regexp, transform, aggregate).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import DATE_MARKER, FALSE_YEAR_MAX, FALSE_YEAR_MIN, MONTHS
from .keys import hash60

MONTH_ALT = "|".join(MONTHS)

_YEAR = r"[0-9]{4}(?:(?:-|–)[0-9]{2,4})?"
# a month with its day, either way round
_MONTH_DAY = r"(?:[0-9]{1,2} (?:of )?(?:" + MONTH_ALT + r")|(?:" + MONTH_ALT + r") [0-9]{1,2})"

# A mention: a year range; a month with a day, or a range of such days, with or
# without a year; a month with a year; or a bare year.  ASCII classes and no
# look-around so RE2 (DuckDB) and Java agree.
DATE_RX = (
    r"\b(?:[0-9]{4}(?:-|–)[0-9]{2,4}"
    r"|" + _MONTH_DAY + r"(?:(?: to | and | ?(?:-|–) ?)(?:" + _MONTH_DAY + r"|[0-9]{1,2}))?(?:,?(?: of)? " + _YEAR + r")?"
    r"|(?:" + MONTH_ALT + r")(?: of)? " + _YEAR +
    r"|[0-9]{4})\b"
)

# optional extra alternative: a month name on its own ("in June")
DATE_RX_WITH_BARE_MONTH = DATE_RX[:-3] + r"|(?:" + MONTH_ALT + r"))\b"

# Every mention begins with a digit or the initial of a month.  Tested first, this spares
# the alternatives at nearly all places of a text; the matches are the same.  For Java's
# engine only: RE2 has no look-ahead.
_MAY_BEGIN = "(?=[0-9" + "".join(sorted({m[0] for m in MONTHS})) + "])"

_N_YEARS = FALSE_YEAR_MAX - FALSE_YEAR_MIN + 1   # 174


def months_array() -> Column:
    return F.array(*[F.lit(m) for m in MONTHS])


def _java(pattern: str) -> str:
    return _MAY_BEGIN + pattern if pattern in (DATE_RX, DATE_RX_WITH_BARE_MONTH) else pattern


def extract_mentions(text: Column, pattern: str = DATE_RX) -> Column:
    """All mentions in text order, duplicates kept."""
    return F.regexp_extract_all(text, F.lit(_java(pattern)), 0)


def safe_int(c: Column) -> Column:
    """Integer value or null (never raises)."""
    return c.try_cast("int")


def false_year(year: Column, h: Column) -> Column:
    """Uniform year in 1850..2023 other than ``year`` (all 174 if outside)."""
    inside = year.between(FALSE_YEAR_MIN, FALSE_YEAR_MAX)
    y0 = F.lit(FALSE_YEAR_MIN) + F.pmod(h, F.lit(_N_YEARS - 1))
    return (F.when(inside, y0 + F.when(y0 >= year, 1).otherwise(0))
            .otherwise(F.lit(FALSE_YEAR_MIN) + F.pmod(h, F.lit(_N_YEARS))))


def month_index() -> Column:
    """Literal map month name -> 0-based index."""
    return F.create_map(*[x for i, m in enumerate(MONTHS) for x in (F.lit(m), F.lit(i))])


def false_month(month: Column, h: Column, i0: Column | None = None) -> Column:
    """Uniform English month name other than ``month``."""
    if i0 is None:
        i0 = F.element_at(month_index(), month)
    return F.element_at(months_array(), (F.pmod(i0 + 1 + F.pmod(h, F.lit(11)), F.lit(12)) + 1).cast("int"))


def is_year_part(part: Column) -> Column:
    """Exactly four ASCII digits and not zero (``1993,`` and ``1990s`` are kept)."""
    return part.rlike("^[0-9]{4}$") & (part.try_cast("int") != 0)


def fake_mention(mention: Column, key: Column, seed, mention_no: Column, sep: str = r"\s+") -> Column:
    """Falsified text of one mention; whitespace collapses to single spaces.

    Each part is first annotated once (month index, integer value; then the hash, of
    parts that change only) so the per-part rule does not recompute md5 or lookups
    (no CSE in lambdas).
    """
    parts = F.split(F.trim(mention), sep)
    ann = F.transform(parts, lambda p, j: F.struct(
        p.alias("p"), j.alias("j"), F.element_at(month_index(), p).alias("m"),
        F.when(p.rlike("^[0-9]{4}$"), p.try_cast("int")).alias("y")))
    ann = F.transform(ann, lambda a: F.struct(
        a["p"].alias("p"), a["m"].alias("m"), a["y"].alias("y"),
        F.when(a["m"].isNotNull() | (a["y"] != 0), hash60(F.lit(str(seed)), key, mention_no, a["j"])).alias("h")))

    def one(a):
        return (F.when(a["m"].isNotNull(), false_month(a["p"], a["h"], a["m"]))
                .when(a["y"].isNotNull() & (a["y"] != 0), false_year(a["y"], a["h"]).cast("string"))
                .otherwise(a["p"]))

    return F.array_join(F.transform(ann, one), " ")


def date_swaps(text: Column, key: Column, seed, pattern: str = DATE_RX) -> Column:
    """array<struct<orig, fake>> in mention order."""
    # our own patterns have single spaces only, and Java splits at these without a pattern
    sep = " " if pattern in (DATE_RX, DATE_RX_WITH_BARE_MONTH) else r"\s+"
    return F.transform(
        extract_mentions(text, pattern),
        lambda m, i: F.struct(m.alias("orig"), fake_mention(m, key, seed, i, sep).alias("fake")),
    )


def apply_swaps(text: Column, swaps: Column) -> Column:
    """Ordered fold: replace every literal occurrence, one swap after another."""
    return F.aggregate(swaps, text, lambda acc, s: F.replace(acc, s["orig"], s["fake"]))


def falsify(text: Column, key: Column, seed, pattern: str = DATE_RX) -> Column:
    return apply_swaps(text, date_swaps(text, key, seed, pattern))


def mark(text: Column, pattern: str = DATE_RX) -> Column:
    """Wrap every mention in ``####`` in one pass (no double wrapping)."""
    return F.regexp_replace(text, F.lit(_java(pattern)), F.lit(DATE_MARKER + "$0" + DATE_MARKER))


def parse_marked(marked: Column) -> Column:
    """Mentions a date-marking reply wrapped in ``####``."""
    return F.regexp_extract_all(marked, F.lit(DATE_MARKER + "(.+?)" + DATE_MARKER), 1)


def unmark(marked: Column) -> Column:
    return F.replace(marked, F.lit(DATE_MARKER), F.lit(""))
