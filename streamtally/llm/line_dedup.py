"""Operator 10: line dedup by winnowing over line hashes, with DataFrame functions only.

A gram is the shortest run of whole lines from a line on that holds ``gram_words`` words. Among the grams that
start within ``window_words`` words of each other the one of least hash is a fingerprint (the rightmost of equals),
so every repeated passage of gram_words + window_words words made of whole lines holds a fingerprint in each of
its copies. Each fingerprint is joined to the first occurrence of the same gram (smallest doc_id, then position),
never to all others; the match is extended line by line both ways, and the later run is deleted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import register, row_key, table, unused

GRAM_WORDS = 40
WINDOW_WORDS = 10
WORD = r"[^ \t\r\x0B\f]+"


def _lines(docs: DataFrame) -> DataFrame:
    """One row per line with words: key of its document, position among all lines, hash and words before it."""
    did, seen = row_key(docs)
    keyed = docs.select(did.alias("did"), seen.alias("seen"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    lines = keyed.select("did", "seen", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    found = lines.filter(F.col("line").rlike(WORD))
    rows = found.select("did", "seen", "pos", F.xxhash64("line").alias("line"), F.regexp_count("line", F.lit(WORD)).cast("long").alias("words"))
    # Repeated rows (same id and text) are one document here.
    return rows.dropDuplicates(["did", "seen", "pos"])


def _fingerprints(lines: DataFrame, gram_words: int, window_words: int) -> DataFrame:
    """The selected grams: where they start, their hash, how many lines they have, and the hashes of the lines
    before and after their start, as far as an extension can need them."""
    doc = Window.partitionBy("did", "seen")
    ordered = doc.orderBy("pos")
    offset = lines.withColumn("nth", F.row_number().over(ordered).cast("long")).withColumn(
        "start", F.sum("words").over(ordered.rowsBetween(Window.unboundedPreceding, 0)) - F.col("words")
    )
    by_words = doc.orderBy("start")
    reach = gram_words + window_words
    spans = (
        offset.withColumn("total", F.sum("words").over(doc))
        .withColumn("gram_lines", F.collect_list("line").over(by_words.rangeBetween(0, gram_words - 1)))
        .withColumn("whole", F.col("total") - F.col("start") >= gram_words)
        .withColumn("gram", F.when(F.col("whole"), F.xxhash64(F.concat_ws(",", F.col("gram_lines").cast("array<string>")))))
        .withColumn("after", F.collect_list("line").over(by_words.rangeBetween(0, 2 * reach - 1)))
        .withColumn("before", F.collect_list("line").over(by_words.rangeBetween(-reach, -1)))
        .withColumn("after_pos", F.collect_list("pos").over(by_words.rangeBetween(0, 2 * reach - 1)))
        .withColumn("before_pos", F.collect_list("pos").over(by_words.rangeBetween(-reach, -1)))
    )
    least = F.min(F.when(F.col("whole"), F.struct("gram", (-F.col("nth")).alias("back")))).over(
        by_words.rangeBetween(0, max(window_words - 1, 0))
    )
    # A line is selected if it is the least of any window it lies in.
    chosen = spans.withColumn("pick", least).filter("pick is not null and whole")
    picks = F.collect_set(-F.col("pick.back")).over(by_words.rangeBetween(-max(window_words - 1, 0), 0))
    return (
        chosen.withColumn("picked", picks)
        .filter(F.array_contains("picked", F.col("nth")))
        .select("did", "seen", "nth", "gram", F.size("gram_lines").cast("long").alias("n_lines"), "before", "after", "before_pos", "after_pos")
    )


def _same_start(a: Column, b: Column) -> Column:
    """How many leading elements two arrays share."""
    n = F.least(F.size(a), F.size(b))
    equal = F.zip_with(F.slice(a, 1, n), F.slice(b, 1, n), lambda x, y: x == y)
    first = F.array_position(equal, F.lit(False))
    return F.when(n == 0, F.lit(0).cast("long")).when(first == 0, n.cast("long")).otherwise(first - 1)


def repeated_runs(lines: DataFrame, gram_words: int = GRAM_WORDS, window_words: int = WINDOW_WORDS) -> DataFrame:
    """Runs of lines to delete: did, seen, first and last position."""
    from streamtally.session import stored

    prints = stored(_fingerprints(lines, gram_words, window_words), "fingerprints")
    place = F.struct("did", "seen", "nth")
    # Only the place is compared, in the map tasks first; its row is fetched for the grams that repeat.
    firsts = prints.groupBy("gram").agg(F.min(place).alias("first"), F.count("*").alias("n")).filter("n > 1")
    source = prints.alias("p").join(
        firsts.select("gram", "first"),
        (F.col("p.gram") == firsts["gram"]) & (F.struct("p.did", "p.seen", "p.nth") == F.col("first")),
    ).select(F.col("p.gram").alias("gram"), "first", F.col("p.before").alias("s_before"), F.col("p.after").alias("s_after"))
    matched = prints.join(source, "gram").filter(F.struct("did", "seen", "nth") > F.col("first"))
    forward = _same_start(F.col("after"), F.col("s_after"))
    backward = _same_start(F.reverse("before"), F.reverse("s_before"))
    # A gram can repeat a run that lies just before it in its own document; that run itself stays.
    own = (F.col("did") == F.col("first.did")) & (F.col("seen") == F.col("first.seen"))
    gap = F.col("nth") - F.col("first.nth")
    backward = F.when(own, F.least(backward, F.greatest(gap - 1, F.lit(0)))).otherwise(backward)
    first = F.when(F.col("back") > 0, F.element_at("before_pos", (-F.col("back")).cast("int"))).otherwise(F.element_at("after_pos", 1))
    runs = matched.select("did", "seen", "n_lines", "before_pos", "after_pos", forward.alias("n"), backward.alias("back")).filter("n >= n_lines")
    return runs.select("did", "seen", first.alias("first"), F.element_at("after_pos", F.col("n").cast("int")).alias("last"))


def dedup_lines(docs: DataFrame, gram_words: int = GRAM_WORDS, window_words: int = WINDOW_WORDS) -> DataFrame:
    """``docs`` without later repeats of passages, and with the number of deleted lines as ``n_deleted``.

    The first occurrence of every passage stays. Lines are separated by newlines; the other lines keep their order.
    A document without repeats keeps its text to the letter, null included; one whose lines are all deleted keeps an
    empty text here. Null ids sort first. Repeated rows (same id and same text) are one document and treated alike.
    Texts are read whole, however long; an empty table gives no rows. Columns of any name pass through, except that
    n_deleted is replaced."""
    from streamtally.session import stored

    lines = _lines(docs)
    runs = repeated_runs(lines, gram_words, window_words)
    per_doc = stored(
        runs.groupBy("did", "seen").agg(F.sort_array(F.collect_set(F.struct("first", "last"))).alias("runs")), "runs"
    )
    did, seen = row_key(docs)
    id_, hash_, runs_ = unused(docs, "did", "seen", "runs")
    kept = docs.drop("n_deleted").withColumns({id_: did, hash_: seen})
    # One plan at every size: the runs grow with the documents, so they are never broadcast.
    found = per_doc.select(F.col("did").alias(id_), F.col("seen").alias(hash_), F.col("runs").alias(runs_))
    joined = kept.join(found.hint("merge"), [id_, hash_], "left")
    return _rebuilt(joined, docs.columns, runs_)


def _rebuilt(joined: DataFrame, columns: list[str], runs: str) -> DataFrame:
    """The texts without the lines that lie in a run."""
    parts = F.split(F.coalesce("text", F.lit("")), "\n")
    gone = lambda i: F.exists(runs, lambda r: (i >= r["first"]) & (i <= r["last"]))
    changed = F.col(runs).isNotNull()
    passing = [F.col(f"`{c}`") for c in columns if c not in ("text", "n_deleted")]
    return joined.select(
        *passing,
        F.when(changed, F.array_join(F.filter(parts, lambda x, i: ~gone(i)), "\n")).otherwise(F.col("text")).alias("text"),
        F.when(changed, F.size(F.filter(parts, lambda x, i: gone(i) & x.rlike(WORD)))).otherwise(0).cast("long").alias("n_deleted"),
    )


def drop_repeats(docs: DataFrame) -> DataFrame:
    """The documents with shortened texts and unchanged columns; documents of which nothing is left go."""
    found = dedup_lines(docs)
    left = (F.col("n_deleted") == 0) | F.col("text").rlike(r"[^ \t\n\r\x0B\f]")
    kept = found.filter(left)
    return kept.select(*[(F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(f"`{c}`")) for c in docs.columns])


@register()
def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, n_deleted lines and the sha256 of what is left of the text."""
    found = dedup_lines(table(spark, folder, "documents"))
    return found.select("doc_id", "n_deleted", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))
