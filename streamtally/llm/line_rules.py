"""Operator 12: quality rules, line first, with DataFrame functions only.

Every line is judged by itself: does it end like prose and hold few marks (punctuation), is it a row of links
(navigation), is it a notice that stands on every page (boilerplate). Lines that fail are removed; then a document
that lost too much of its text, or that fails the base rules as a whole, is rejected. All of it is arrays of the row:
no line or word ever leaves its document, so nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, register, table, unused

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
# Words of a window that counts as repeated.
WINDOW = 8
MIN_WORDS = 20
# Percent of the words that repeated windows may cover, and of the characters in words that lines may take away.
REPEATED_PERCENT = 30
LOST_PERCENT = 50
# Prose ends with a full stop or its like, with or without closing quotes and brackets.
ENDS = r"[.!?…。！？][\"'”’»)\]]*[\x20\x09-\x0D]*$"
MARKS = "!#$%&*<>|^~=_"
SEPARATOR = r"^[|>»·•/\\]+$"
MIN_SEPARATORS = 3
# Links and notices are short; a long line that holds such words is prose about them.
LINK_WORDS = 8
NOTICE_WORDS = 30
# Wordings of links and of notices.
LINKS = (
    "home page", "main menu", "next page", "previous page", "read more", "log in", "sign in", "sign up", "skip to content",
    "back to top", "site map", "weiterlesen", "anmelden", "startseite", "lire la suite", "accueil", "leer m", "iniciar sesi",
)
NOTICES = (
    "copyright", "all rights reserved", "licensed under", "terms of use", "terms of service", "privacy policy", "use cookies",
    "uses cookies", "enable javascript", "subscribe to", "alle rechte vorbehalten", "tous droits r", "todos los derechos",
)
_LINK, _NOTICE = (r"(?i)(^|[^A-Za-z])(" + "|".join(p) + ")" for p in (LINKS, NOTICES))
REASONS = ("navigation", "boilerplate", "punctuation")
_ADDED = ("clean_text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "removed_lines", "lost_chars", "base_failed", "kept")


def _words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def _count(text: Column, letters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, letters, ""))


def _in_words(text: Column) -> Column:
    return F.length(F.translate(text, SPACES, ""))


def repeat_words(words: Column, window: int = WINDOW) -> Column:
    """How many words lie in windows of ``window`` words that occur twice or more, the first occurrence included."""

    def places(v: Column) -> Column:
        # Windows in order of their words: equal ones are neighbours.
        windows = F.array_sort(F.transform(v["starts"], lambda i: F.struct(F.slice(v["words"], i, window).alias("w"), i.alias("i"))))
        alike = lambda s, x, k: F.coalesce(F.get(s, k)["w"] == x["w"], F.lit(False))
        twice = let(
            lambda u: F.filter(u["s"], lambda x, k: alike(u["s"], x, k + 1) | ((k > 0) & alike(u["s"], x, F.greatest(k - 1, F.lit(0))))), s=windows
        )
        return F.array_sort(F.transform(twice, lambda x: x["i"]))

    def covered(starts: Column) -> Column:
        # A window adds what the one before it does not cover.
        state = F.struct(F.lit(-window).alias("last"), F.lit(0).cast("long").alias("n"))
        step = lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(i - acc["last"], F.lit(window))).alias("n"))
        return F.aggregate(starts, state, step, lambda acc: acc["n"])

    def work(v: Column) -> Column:
        hashes = F.transform(v["starts"], lambda i: F.xxhash64(F.slice(v["words"], i, window)))
        # Different hashes are different windows; only texts with equal ones are compared word by word.
        return let(lambda h: F.when(F.size(F.array_distinct(h["h"])) == F.size(h["h"]), F.lit(0).cast("long")).otherwise(covered(places(v))), h=hashes)

    def spread(v: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(v["words"]) - (window - 1))
        return F.when(F.size(v["words"]) <= window, F.lit(0).cast("long")).otherwise(let(work, words=v["words"], starts=starts))

    return let(spread, words=words)


def line_reason(line: Column) -> Column:
    """Why a line is removed: the first of REASONS whose rule it fails, else null. Lines without words stay."""

    def judged(v: Column) -> Column:
        n = F.size(v["words"])
        separators = F.size(F.filter(v["words"], lambda w: w.rlike(SEPARATOR)))
        navigation = ((separators >= MIN_SEPARATORS) & (4 * separators >= n)) | ((n <= LINK_WORDS) & v["line"].rlike(_LINK))
        boilerplate = (n <= NOTICE_WORDS) & v["line"].rlike(_NOTICE)
        punctuation = ~v["line"].rlike(ENDS) | (2 * _count(v["line"], MARKS) > n)
        return (
            F.when(n == 0, F.lit(None).cast("string"))
            .when(navigation, F.lit("navigation"))
            .when(boilerplate, F.lit("boilerplate"))
            .when(punctuation, F.lit("punctuation"))
        )

    return let(judged, line=line, words=_words(line))


def clean(docs: DataFrame, lost_percent: int = LOST_PERCENT) -> DataFrame:
    """Every row of ``docs`` with its text after line cleaning and the counts that decide.

    Added: clean_text (failing lines removed, all others unchanged and in order), n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, n_lines (with words), removed_lines (array of line number from 0 and reason),
    lost_chars (characters in words of removed lines), base_failed and kept. Columns of these names in ``docs`` are
    replaced, all others pass through whatever their names. A null text counts as empty and fails the base rules; its
    clean_text is empty. Rows are judged alone, so repeated rows and ties get equal results, and the order of rows or a
    missing doc_id changes nothing. Whole texts are read, however long: the work grows as n log n with the words of a
    text where windows repeat, else with n."""
    passing = [F.col(f"`{c}`") for c in docs.columns if c not in _ADDED]
    # The row travels as one struct, so that no name of its columns can meet one used here. It is never without a field.
    [end] = unused(docs, "end")
    rows = docs.select(F.struct(*passing, F.lit(0).alias(end)).alias("doc"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    lines = F.transform(F.split("text", "\n"), lambda x, i: F.struct(i.alias("line"), x.alias("text"), line_reason(x).alias("reason")))
    split = rows.select("doc", "text", _words(F.col("text")).alias("words"), lines.alias("lines"))
    with_words = F.filter(F.transform("lines", lambda x: x["text"]), lambda x: x.rlike(WORD))
    removed = F.filter("lines", lambda x: x["reason"].isNotNull())
    kept_text = F.array_join(F.transform(F.filter("lines", lambda x: x["reason"].isNull()), lambda x: x["text"]), "\n")
    counted = split.select(
        "doc",
        kept_text.alias("clean_text"),
        F.size("words").cast("long").alias("n_words"),
        _in_words(F.col("text")).cast("long").alias("word_chars"),
        _count(F.col("text"), SYMBOLS).cast("long").alias("n_symbols"),
        let(lambda v: F.struct(F.size(v["l"]).alias("all"), F.size(F.array_distinct(v["l"])).alias("once")), l=with_words).alias("worded"),
        repeat_words(F.col("words")).alias("n_repeat_words"),
        F.transform(removed, lambda x: F.struct(x["line"].alias("line"), x["reason"].alias("reason"))).alias("removed_lines"),
        F.aggregate(removed, F.lit(0).cast("long"), lambda acc, x: acc + _in_words(x["text"])).alias("lost_chars"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))
    judged = counted.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (100 * F.col("lost_chars") <= lost_percent * F.col("word_chars"))
    )
    named = {
        "n_lines": F.col("worded.all").cast("long"),
        "n_dup_lines": (F.col("worded.all") - F.col("worded.once")).cast("long"),
    }
    return judged.select(
        *[F.col("doc").getField(c).alias(c) for c in docs.columns if c not in _ADDED],
        *[named.get(c, F.col(c)).alias(c) for c in _ADDED],
    )


def _sql_text(pattern: str) -> str:
    return pattern.replace("'", "''")


_SQL_COUNT = "length({0}) - length(regexp_replace({0}, '{1}', '', 'g'))"
SQL = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
split AS (
  SELECT doc_id, text, regexp_extract_all(text, '{WORD}') AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines FROM texts),
spans AS (
  SELECT doc_id, unnest(range(1, len(words) - {WINDOW - 2})) AS i, words FROM split WHERE len(words) >= {WINDOW}),
windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(words[i:i + {WINDOW - 1}], ' ')) AS n FROM spans),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM windows, (SELECT unnest(range({WINDOW})) AS k) WHERE n > 1 GROUP BY doc_id),
lined AS (
  SELECT doc_id, line, regexp_extract_all(line, '{WORD}') AS ws,
    length(regexp_replace(line, '{SPACE}', '', 'g')) AS chars FROM (SELECT doc_id, unnest(lines) AS line FROM split)),
judged AS (
  SELECT doc_id, chars, len(ws) AS n, len(list_filter(ws, lambda w: regexp_matches(w, '{SEPARATOR}'))) AS seps,
    regexp_matches(line, '{_LINK}') AS link, regexp_matches(line, '{_NOTICE}') AS notice,
    regexp_matches(line, '{_sql_text(ENDS)}') AS prose, {_SQL_COUNT.format("line", "[!#$%&*<>|^~=_]")} AS marks FROM lined),
lost AS (
  SELECT doc_id, sum(chars) AS chars FROM judged
  WHERE (seps >= {MIN_SEPARATORS} AND 4 * seps >= n) OR (n <= {LINK_WORDS} AND link) OR (n <= {NOTICE_WORDS} AND notice)
    OR NOT prose OR 2 * marks > n GROUP BY doc_id),
counted AS (
  SELECT doc_id, len(words) AS n_words, length(regexp_replace(text, '{SPACE}', '', 'g')) AS word_chars,
    {_SQL_COUNT.format("text", "[#*$%&|<>]")} AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(c.n, 0) AS n_repeat_words, coalesce(l.chars, 0) AS lost_chars
  FROM split LEFT JOIN covered c USING (doc_id) LEFT JOIN lost l USING (doc_id)),
based AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEATED_PERCENT} * n_words AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND 100 * lost_chars <= {LOST_PERCENT} * word_chars AS kept
FROM based
"""


@register(SQL)
def op12_line_rules(spark: SparkSession, folder: str) -> DataFrame:
    found = clean(table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
