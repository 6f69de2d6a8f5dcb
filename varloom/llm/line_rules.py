"""Line-first cleaning: rules per line, then a verdict per document. DataFrame functions only, one row in, one row out."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEPARATORS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
MIN_WORDS = 50
MAX_LOST = 30  # percent of the words
WINDOW = 3

# A sentence may close with quotes or brackets behind its mark, at the end of the line or before a space.
ENDING = r"""[.!?…。！？؟।]["'”’»)\]]*([\x20\x09-\x0D]|\z)"""
MARKS = r"[!?][!?]+"
SYMBOLS = r"[#*$%&|<>]"
STEPS = r"[|»›·•>]"
MENU = (
    r"(?i)\A\W*(home|menu|search|log ?in|log ?out|sign (in|up|out)|register|next|previous|prev|back|back to top|skip to (main )?content|"
    r"contact( us)?|about( us)?|sitemap|share|tweet|print|email|reply|faq|help)\W*\z"
)
#: Phrases of page furniture and licence headers, in lower case.
BOILERPLATE = [
    "all rights reserved", "copyright (c)", "copyright 19", "copyright 20", "©", "privacy policy", "cookie policy", "use cookies",
    "uses cookies", "terms of use", "terms of service", "terms and conditions", "terms & conditions", "subscribe to our", "subscribe to the",
    "sign up for our", "click here", "read more", "enable javascript", "javascript is", "javascript must be", "lorem ipsum",
    "powered by ", "follow us on", "share this", "spdx-license-identifier",
]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_in(text: Column) -> Column:
    """The words of a text in order."""
    bare = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SEPARATORS))


def repeated_words(words: Column, size: int = WINDOW) -> Column:
    """Words that lie in a window of ``size`` words found twice or more, first included.

    Windows are sorted by their hash with their place, so that equal ones are neighbours; then the places in order: each adds
    the words up to the next one, ``size`` at most.
    """

    def hashes(w: Column) -> Column:
        starts = F.slice(w, F.lit(1), F.size(w) - (size - 1))
        return F.transform(starts, lambda x, i: F.xxhash64(x, *[F.get(w, i + k) for k in range(1, size)]))

    def twice(s: Column) -> Column:
        hash_at = lambda i: F.get(s, i)["h"]
        met = F.filter(s, lambda x, i: (hash_at(i - 1) == x["h"]) | (hash_at(i + 1) == x["h"]))
        return F.sort_array(F.transform(met, lambda x: x["p"]))

    def covered(p: Column) -> Column:
        step = F.transform(p, lambda x, i: F.least(F.lit(size), F.coalesce(F.get(p, i + 1) - x, F.lit(size))))
        return F.aggregate(step, F.lit(0), lambda a, x: a + x)

    def count(h: Column) -> Column:
        placed = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p")))
        some = let(F.sort_array(placed), lambda s: let(twice(s), covered))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(some)

    return let(words, lambda w: F.when(F.size(w) < size, F.lit(0)).otherwise(let(hashes(w), count)))


def measured(line: Column) -> Column:
    """A line with its words, steps and symbols."""
    found = {"n": WORD, "steps": STEPS, "symbols": SYMBOLS}
    return F.struct(line.alias("line"), *[F.regexp_count(line, F.lit(p)).alias(n) for n, p in found.items()])


def line_verdict(x: Column) -> Column:
    """Which rule a measured line fails, or null. Lines without words fail none."""
    line, n = x["line"], x["n"]
    phrase = let(F.lower(line), lambda low: reduce(lambda a, b: a | b, [F.contains(low, F.lit(p)) for p in BOILERPLATE]))
    return (
        F.when(n == 0, F.lit(None).cast("string"))
        .when((x["steps"] >= 2) & (x["steps"] * 6 > n), "navigation")
        .when((x["symbols"] >= 3) & (x["symbols"] * 10 > n), "symbols")
        .when((n <= 4) & line.rlike(MENU), "navigation")
        .when(phrase, "boilerplate")
        .when(F.regexp_count(line, F.lit(MARKS)) * 10 > n * 3, "marks")
        .when(~line.rlike(ENDING), "no_sentence")
    )


def cleaned_lines(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), max_lost: int = MAX_LOST) -> DataFrame:
    """The ``keep`` columns with the base counts of the whole text, the cleaned text and the verdict.

    A line goes if it is navigation (two or more steps such as ``|`` or ``»``, more than one for six words, or nothing but a menu
    entry), holds a phrase of page boilerplate, has three or more symbols and more than one for ten words, has runs of ``!`` or
    ``?`` behind more than three of ten words, or holds no end of a sentence. Lines without words always stay. A
    document is rejected if the lost lines hold more than ``max_lost`` percent of its words; ``base_failed`` (under 50 words, or
    more than half of them in repeated windows of three) rejects it as well.

    Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lost_lines, n_lost_words (long), lost (lines by rule),
    cleaned (text), base_failed, kept. One row each, no shuffle. A null or empty text has no words and is not kept; its
    cleaned text is empty. Repeated and null keys are rows of their own; columns not kept are ignored.
    """
    whole = F.coalesce(docs[text], F.lit(""))
    names = list(keep)
    rows = docs.select(*names, whole.alias("__text"))
    lines = F.transform(F.split("__text", "\n"), measured)
    judged = F.transform(lines, lambda x: F.struct(x["line"], x["n"], x["symbols"], line_verdict(x).alias("rule")))
    rows = rows.select("*", judged.alias("__lines"), words_in(F.col("__text")).alias("__words"))
    lost = F.filter("__lines", lambda x: x["rule"].isNotNull())
    total = lambda lines, what: F.aggregate(lines, F.lit(0), lambda a, x: a + x[what])
    worded = F.transform(F.filter("__lines", lambda x: x["n"] > 0), lambda x: x["line"])
    stay = F.transform(F.filter("__lines", lambda x: x["rule"].isNull()), lambda x: x["line"])
    counts = {
        "n_words": F.size("__words"),
        "word_chars": F.char_length(F.array_join("__words", "")),
        "n_symbols": total(F.col("__lines"), "symbols"),
        "n_dup_lines": let(worded, lambda w: F.size(w) - F.size(F.array_distinct(w))),
        "n_repeat_words": repeated_words(F.col("__words")),
        "n_lost_lines": F.size(lost),
        "n_lost_words": total(lost, "n"),
    }
    rows = rows.select(
        *names,
        *[c.cast("long").alias(n) for n, c in counts.items()],
        F.transform(lost, lambda x: x["rule"]).alias("lost"),
        F.array_join(stay, "\n").alias("cleaned"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rows = rows.withColumn("base_failed", failed)
    return rows.withColumn("kept", ~F.col("base_failed") & (100 * F.col("n_lost_words") <= max_lost * F.col("n_words")))


def _sql(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


_N = f"len(regexp_extract_all(line, {_sql(SYMBOLS)}))"
_S = f"len(regexp_extract_all(line, {_sql(STEPS)}))"

_PHRASE = "(" + " OR ".join(f"contains(lower(line), {_sql(p)})" for p in BOILERPLATE) + ")"

#: The same counts and verdict in SQL, over ``documents``.
ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS row_no, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT row_no, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d),
win AS (SELECT row_no, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c FROM (SELECT row_no, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
again AS (SELECT row_no, i FROM (SELECT row_no, i, count(*) OVER (PARTITION BY row_no, a, b, c) AS met FROM win) WHERE met > 1),
rep AS (SELECT row_no, count(DISTINCT i + k) AS n_repeat_words FROM again, (SELECT unnest([0, 1, 2]) AS k) GROUP BY row_no),
l AS (SELECT row_no, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n FROM (SELECT row_no, unnest(string_split(text, chr(10))) AS line FROM w)),
j AS (SELECT *, n > 0 AND (({_S} >= 2 AND {_S} * 6 > n) OR (n <= 4 AND regexp_matches(line, {_sql(MENU)})) OR {_PHRASE}
  OR ({_N} >= 3 AND {_N} * 10 > n) OR len(regexp_extract_all(line, {_sql(MARKS)})) * 10 > n * 3 OR NOT regexp_matches(line, {_sql(ENDING)})) AS bad FROM l),
ls AS (SELECT row_no, count_if(n > 0) - count(DISTINCT CASE WHEN n > 0 THEN line END) AS n_dup_lines,
  CAST(coalesce(sum(CASE WHEN bad THEN n END), 0) AS BIGINT) AS n_lost_words FROM j GROUP BY row_no),
c AS (SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
  CAST(len(regexp_extract_all(text, {_sql(SYMBOLS)})) AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, n_lost_words FROM w JOIN ls USING (row_no) LEFT JOIN rep USING (row_no)),
f AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lost_words, base_failed,
  NOT base_failed AND 100 * n_lost_words <= {MAX_LOST} * n_words AS kept FROM f
"""
