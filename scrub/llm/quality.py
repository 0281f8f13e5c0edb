"""Quality rules: a table of thresholds compiled into one projection of Spark's own expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A word: a run of anything but a blank and 0x09 to 0x0D.
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
#: Low bits that hold a position in a document, so up to 67 million words; the rest is fingerprint.
PLACE_BITS = 26
PLACE = (1 << PLACE_BITS) - 1
WINDOW = 3

#: Common words of the languages that are kept. A text holds some of them unless it is a list.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "was", "on", "with", "by",
    "de", "la", "le", "les", "et", "des", "en", "un", "du", "que", "el", "los", "y", "se", "del",
    "der", "die", "und", "den", "von", "zu", "das", "mit", "ist", "des", "ein",
)


@dataclass(frozen=True)
class Threshold:
    """``measure`` is an SQL expression over the measures; a row passes between the two limits."""

    name: str
    measure: str
    at_least: float | None = None
    at_most: float | None = None

    def fails(self) -> str:
        tests = [f"({self.measure}) < {self.at_least}"] * (self.at_least is not None)
        tests += [f"({self.measure}) > {self.at_most}"] * (self.at_most is not None)
        return "(" + " OR ".join(tests) + ")"


#: Ratios are written as products, so that whole numbers are compared and nothing is divided by zero.
BASE = (
    Threshold("few_words", "n_words", at_least=50),
    Threshold("repeated_words", "100 * n_repeat_words - 50 * n_words", at_most=0),
)
RULES = (
    Threshold("short_words", "10 * word_chars - 25 * n_words", at_least=0),
    Threshold("long_words", "word_chars - 14 * n_words", at_most=0),
    Threshold("symbols", "10 * n_symbols - n_words", at_most=0),
    Threshold("stop_words", "n_stop_words", at_least=2),
    Threshold("repeated_lines", "10 * n_dup_lines - 5 * n_lines", at_most=0),
    Threshold("shouting", "10 * n_exclaimed - 3 * n_words", at_most=0),
)
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_stop_words", "n_exclaimed",
)


def _neighbours(values: Column, size: Column) -> Column:
    """A fingerprint of every three neighbouring values."""
    count = F.greatest(size - (WINDOW - 1), F.lit(0))
    tail = F.zip_with(F.slice(values, 2, count), F.slice(values, 3, count), lambda b, c: F.xxhash64(b, c))
    return F.zip_with(F.slice(values, 1, count), tail, lambda a, rest: F.xxhash64(a, rest))


def _packed(grams: Column, seed: int) -> Column:
    """Fingerprint and position in one number, sorted: equal ones become neighbours."""
    return F.sort_array(
        F.transform(
            grams,
            lambda g, i: F.xxhash64(g, F.lit(seed)).bitwiseAND(F.lit(~PLACE)).bitwiseOR(i.cast("long")),
        )
    )


def _repeated(packed: Column, size: Column) -> Column:
    """Positions whose fingerprint another position has too."""
    same = F.zip_with(
        packed, F.slice(packed, 2, size),
        lambda a, b: F.coalesce(F.shiftright(a, PLACE_BITS) == F.shiftright(b, PLACE_BITS), F.lit(False)),
    )
    either = F.zip_with(same, F.concat(F.array(F.lit(False)), same), lambda a, b: F.coalesce(a, F.lit(False)) | b)
    places = F.zip_with(packed, either, lambda p, on: F.when(on, p.bitwiseAND(F.lit(PLACE))))
    return F.filter(places, lambda p: p.isNotNull())


def measured(docs: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with the measures of its text added as ``prefix`` + name; no shuffle, no user function.

    n_words; word_chars (characters in words); n_symbols; n_lines (with a word) and n_dup_lines
    (equal to an earlier one); n_repeat_words (in three-word windows that occur twice or more);
    n_stop_words (different ones); n_exclaimed (exclamation marks). All are 0 for a NULL or empty text.

    Repeated windows are found by sorting two independent fingerprints packed with their positions;
    a position counts when both agree, so a chance of about 1e-14 per long document is left.
    """
    word, own = F.lit(WORD), [F.col(f"`{c}`") for c in docs.columns]
    body = F.coalesce(F.col(text), F.lit(""))
    s1 = docs.select(*own, body.alias("_t"), F.regexp_extract_all(body, word, F.lit(0)).alias("_w"))
    s2 = s1.select(
        *own, "_t", "_w", F.size("_w").alias("_n"),
        F.filter(F.split("_t", "\n"), lambda x: x.rlike(WORD)).alias("_l"),
        F.transform("_w", lambda w: F.xxhash64(w)).alias("_h"),
    )
    stops = F.array(*[F.lit(w) for w in dict.fromkeys(STOP_WORDS)])
    s3 = s2.select(
        *own, F.col("_n").cast("long").alias("n_words"),
        F.length(F.regexp_replace("_t", r"[\x20\x09-\x0D]+", "")).cast("long").alias("word_chars"),
        (F.length("_t") - F.length(F.translate("_t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.length("_t") - F.length(F.translate("_t", "!", ""))).cast("long").alias("n_exclaimed"),
        F.size("_l").cast("long").alias("n_lines"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.size(F.array_intersect("_w", stops)).cast("long").alias("n_stop_words"),
        _neighbours(F.col("_h"), F.col("_n")).alias("_g"),
    )
    kept = [F.col(c) for c in MEASURES if c != "n_repeat_words"]
    s4 = s3.select(*own, *kept, F.size("_g").alias("_m"), *[_packed(F.col("_g"), s).alias(f"_p{s}") for s in (1, 2)])
    s5 = s4.select(*own, *kept, *[_repeated(F.col(f"_p{s}"), F.col("_m")).alias(f"_r{s}") for s in (1, 2)])
    s6 = s5.select(*own, *kept, F.sort_array(F.array_intersect("_r1", "_r2")).alias("_r"))
    steps = F.zip_with(
        F.col("_r"), F.slice("_r", 2, F.greatest(F.size("_r"), F.lit(1))),
        lambda a, b: F.coalesce(F.least(b - a, F.lit(WINDOW).cast("long")), F.lit(WINDOW).cast("long")),
    )
    repeat = F.aggregate(steps, F.lit(0).cast("long"), lambda n, x: n + x).alias("n_repeat_words")
    s7 = s6.select(*own, *kept, repeat)
    return s7.select(*own, *[F.col(c).alias(prefix + c) for c in MEASURES])


def _any(rules: tuple[Threshold, ...]) -> str:
    return " OR ".join(r.fails() for r in rules) or "false"


def judge(
    docs: DataFrame,
    base: tuple[Threshold, ...] = BASE,
    rules: tuple[Threshold, ...] = RULES,
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """One row per row of ``docs``: key, measures, ``base_failed``, ``failed`` (rule names), ``kept``.

    Rows are judged one by one, so repeated rows get equal answers; a text without words fails.
    Columns other than key and text play no part, whatever their names.
    """
    rows = measured(docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")), "_text")
    names = F.filter(
        F.array(*[F.when(F.expr(r.fails()), F.lit(r.name)) for r in (*base, *rules)]), lambda x: x.isNotNull()
    )
    return rows.select(
        F.col("_key").alias(key), *MEASURES, F.expr(_any(base)).alias("base_failed"),
        names.alias("failed"), F.expr(f"NOT ({_any(base)} OR {_any(rules)})").alias("kept"),
    )


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that no rule rejects, unchanged."""
    prefix = "_q_"
    while any(c.startswith(prefix) for c in docs.columns):
        prefix = "_" + prefix
    own = [F.col(f"`{c}`") for c in docs.columns]
    verdict = f"NOT ({_any(BASE)} OR {_any(RULES)})"
    boxed = docs.select(F.struct(*own).alias(prefix + "row"), F.col(text).alias("_text"))
    # A filter that only reads measures would be moved below the projections that compute them, and
    # take their expressions apart; it is not moved below a row number.
    numbered = measured(boxed, "_text").select("*", F.monotonically_increasing_id().alias("_row"))
    return numbered.where(f"_row >= 0 AND {verdict}").select(prefix + "row.*")


#: The same measures and verdict for DuckDB.
_STOPS = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
MEASURE_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM {{documents}}),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
g AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS gram
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
r AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1),
n AS (SELECT doc_id, count(DISTINCT j) AS n_repeat_words
      FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM r) GROUP BY 1),
m AS (SELECT w.doc_id, len(w)::BIGINT AS n_words,
             length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
             (length(t) - length(translate(t, '{SYMBOLS}', '')))::BIGINT AS n_symbols,
             (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
             coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, len(l)::BIGINT AS n_lines,
             len(list_distinct(list_filter(w, lambda x: x IN ({_STOPS}))))::BIGINT AS n_stop_words,
             (length(t) - length(replace(t, '!', '')))::BIGINT AS n_exclaimed
      FROM w LEFT JOIN n ON w.doc_id IS NOT DISTINCT FROM n.doc_id)
"""
ORACLE = (
    MEASURE_SQL.replace("{documents}", "documents")
    + "SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,"
    + f" ({_any(BASE)}) AS base_failed, NOT ({_any(BASE)} OR {_any(RULES)}) AS kept FROM m"
)
