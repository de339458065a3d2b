"""Quality rules: a threshold table compiled into one Spark projection.

Measures of a text (word, symbol, stop-word and line counts) are Column
expressions; every rule compares the ratio of two measures with bounds in whole
percent, so a verdict is integer arithmetic.  No user function runs: words are an
array, repeats are found by sorting the hashes of five-word windows inside the
row, and nothing is shuffled, so no key can be hot.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: words in a repeated window; least words, and largest percent of repeated words of a sound text
REPEAT_WINDOW, LEAST_WORDS, MOST_REPEATED = 5, 10, 20

#: frequent function words, a line or two a language; texts in other scripts (see LISTED) are not judged by them
STOP_WORDS = """
the of and to in is that it for was on are as with be this by from at or an not have
der die das und ist nicht mit von den ein eine auf zu sich im dem des
le la les et est une dans pour que qui du en sur pas au un il elle
el los las de y es por con para una su se no lo como
di che il non per sono della gli nel
da do um uma os não em mais ao
het van een dat niet op te zijn voor
och att som det är inte av på
og ikke til af jeg har
ja on ei että oli mutta
w z na nie się jest że jak przez
v že je jsou ale pro s podle
és az egy nem hogy van mint
și nu cu este care pe din
ve bir bu için ile da olarak
и в не на что с он как это
і та що з у до за
και το της του για από με
dan yang di dengan untuk ini itu
và của là có không cho các
""".split()

#: scripts that the words above are written in: Latin, Greek and Cyrillic
LISTED = r"[\x{0000}-\x{052F}\x{1E00}-\x{1FFF}]+"

#: the words as they stand in a sentence and at its start
STOP_FORMS = sorted({f for w in STOP_WORDS for f in (w, w.capitalize())})

#: rule name, measure, measure it is divided by, least and most percent (None: open)
RULES: list[tuple[str, str, str, int | None, int | None]] = [
    ("word_length", "word_chars", "n_words", 150, 2000),
    ("symbols", "n_symbols", "n_words", None, 20),
    ("stop_words", "n_stop_words", "n_words", 1, None),
    ("duplicate_lines", "n_dup_lines", "n_lines", None, 50),
    ("bullet_lines", "n_bullet_lines", "n_lines", None, 90),
    ("ellipsis_lines", "n_ellipsis_lines", "n_lines", None, 50),
]

_SPACE = r"[\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once (a lambda variable is not copied into its uses)."""
    return F.transform(F.array(value), body)[0]


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("bigint"), lambda a, b: a + b)


def _repeat_words(words: Column, window: int) -> Column:
    """Words inside windows that occur twice or more; windows are compared by a 64-bit hash."""
    def covered(places: Column) -> Column:
        # each place covers ``window`` words, less those that the place before it covers
        return _total(F.transform(places, lambda p, k: F.least(
            F.lit(window), p - F.when(k == 0, F.lit(-window)).otherwise(places[k - 1])).cast("bigint")))

    def places(grams: Column) -> Column:
        n = F.size(grams)
        same = F.transform(grams, lambda g, k: F.when(
            ((k > 0) & (g["h"] == F.get(grams, k - 1)["h"])) | ((k < n - 1) & (g["h"] == F.get(grams, k + 1)["h"])),
            g["i"]))
        return F.sort_array(F.filter(same, lambda i: i.isNotNull()))

    def sorted_grams(grams: Column) -> Column:
        return F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def keys(hashes: Column) -> Column:
        spots = F.sequence(F.lit(0), F.size(hashes) - window)
        return F.transform(spots, lambda i: F.xxhash64(*(F.get(hashes, i + j) for j in range(window))))

    none = F.lit(0).cast("bigint")
    # most texts repeat no window: their hashes are all different, and nothing needs sorting
    found = let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: let(keys(h), lambda g: F.when(
        F.size(F.array_distinct(g)) < F.size(g), let(let(g, sorted_grams), lambda s: let(places(s), covered)))
        .otherwise(none)))
    return F.when(F.size(words) > window, found).otherwise(none)


def measures(text: Column) -> Column:
    """Struct of all measures of a text column; a null text has no words and no lines."""
    text = F.coalesce(text.cast("string"), F.lit(""))

    def of_words(words: Column) -> list[Column]:
        stop = F.filter(words, lambda w: w.isin(STOP_FORMS))
        joined = F.array_join(words, "")
        foreign = F.length(F.regexp_replace(joined, LISTED, "")) * 2 > F.length(joined)
        return [F.size(words).cast("bigint").alias("n_words"),
                F.when(foreign, F.size(words)).otherwise(F.size(stop)).cast("bigint").alias("n_stop_words"),
                _repeat_words(words, REPEAT_WINDOW).alias("n_repeat_words"),
                F.length(F.array_join(words, "")).cast("bigint").alias("word_chars")]

    def of_lines(lines: Column) -> list[Column]:
        bullets = F.filter(lines, lambda s: s.rlike(r"^[\x20\x09]*[-*\x{2022}]"))
        dots = F.filter(lines, lambda s: s.rlike(r"(\.\.\.|\x{2026})[\x20\x09\x0D]*$"))
        return [F.size(lines).cast("bigint").alias("n_lines"),
                (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"),
                F.size(bullets).cast("bigint").alias("n_bullet_lines"),
                F.size(dots).cast("bigint").alias("n_ellipsis_lines")]

    words = F.array_remove(F.split(text, _SPACE), "")
    lines = F.filter(F.split(text, "\n"), lambda s: s.rlike(r"[^\x20\x09-\x0D]"))
    by_word = let(words, lambda w: F.struct(*of_words(w)))
    by_line = let(lines, lambda x: F.struct(*of_lines(x)))
    symbols = F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("bigint")
    return F.struct(by_word.alias("w"), by_line.alias("l"), F.struct(symbols.alias("n_symbols")).alias("c"))


MEASURES = {"w": ["n_words", "n_stop_words", "n_repeat_words", "word_chars"],
            "l": ["n_lines", "n_dup_lines", "n_bullet_lines", "n_ellipsis_lines"],
            "c": ["n_symbols"]}


def failed_rules(rules=None) -> Column:
    """Comma-joined names of the rules that the measure columns break (empty: none)."""
    broken = []
    for name, part, whole, low, high in rules or RULES:
        bad = F.lit(False)
        if low is not None:
            bad = bad | (F.col(part) * 100 < F.col(whole) * low)
        if high is not None:
            bad = bad | (F.col(part) * 100 > F.col(whole) * high)
        broken.append(F.when(bad, F.lit(name)))
    return F.concat_ws(",", *broken)


def apply_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=None) -> DataFrame:
    """Per document: doc_id, the measures, base_failed (under 10 words, or over 20 % of the
    words repeated), failed (names of broken rules) and kept.

    A null, empty or blank text has no words and fails.  Repeated rows and null ids
    return a row each; other columns are not looked at; an empty table gives an
    empty result."""
    m = docs.select(F.col(id_col).alias("doc_id"), measures(F.col(text_col)).alias("m"))
    flat = m.select("doc_id", *(F.col(f"m.{part}.{name}").alias(name) for part, names in MEASURES.items()
                                for name in names))
    base = (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED)
    return (flat.withColumn("base_failed", base).withColumn("failed", failed_rules(rules))
            .withColumn("kept", ~F.col("base_failed") & (F.col("failed") == "")))


def rules_sql(rules=None) -> str:
    """The rules as an SQL condition over the measure columns (for the oracle)."""
    parts = []
    for _, part, whole, low, high in rules or RULES:
        parts += [f"{part} * 100 >= {whole} * {low}"] * (low is not None)
        parts += [f"{part} * 100 <= {whole} * {high}"] * (high is not None)
    return " AND ".join(parts)
