"""Operator 5: toxicity by class-conditional Kneser-Ney models.

Two models of letters in words, one of toxic and one of ordinary documents, share their backoff counts: what a
class has not seen after a context is left to continuation counts gathered over both, so that a rare expression
is judged by what its spelling has in common with known ones. The models are built by Spark over every training
row; only the curve is fitted on evidence that models without its documents give. A word's evidence is the difference
of its two log-likelihoods, normalised by its length; a document's evidence (its strongest words and its mean, all
normalised by length) goes through a logistic curve.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks, mix64, register, row_key, table, unused

# Letters of a gram: the predicted one and its context.
ORDER = 6
BACKOFF = 3
DISCOUNT = 0.75
# At most about so many labelled documents fit the final curve.
CURVE_DOCS = 20_000
# Tables of grams, and of contexts, of at most so many rows (12 bytes each in a task) are broadcast; larger ones are joined.
BROADCAST_ROWS = 4_000_000
THRESHOLD = 0.3
N_EVIDENCE = 5
# A word of at least this evidence is a strong one.
STRONG = 0.7
WORD = re.compile(r"[^\W\d_]+")


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4. Rows of fold 2 are never learnt from; fold 3 fits the curve before it is counted."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(4))


def _letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the words between a start and an end mark, one after the other, and each word's size."""
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    flat = np.frombuffer("".join(f"\x02{w}\x03" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32)
    return flat, sizes


def _gram_keys(flat: np.ndarray, sizes: np.ndarray, order: int) -> np.ndarray:
    """Of each letter, the 63-bit key of the gram of up to ``order`` letters that ends there within its word."""
    ends = np.cumsum(sizes)
    depth = np.arange(len(flat)) - np.repeat(ends - sizes, sizes)
    key = mix64(flat)
    for back in range(1, order):
        inside = depth >= back
        further = np.zeros(len(flat), np.uint64)
        further[back:] = mix64(flat[:-back] + np.uint32(back << 24)) if back < len(flat) else 0
        key = np.where(inside, mix64(key ^ further), key)
    return (key >> np.uint64(1)).astype(np.int64)


def split_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Distinct words (runs of letters in lower case), each text's words as numbers into them, and where each
    text's words end."""
    split = [WORD.findall(t.lower()) for t in texts]
    words = [w for one in split for w in one]
    codes, distinct = pd.factorize(np.array(words, dtype=object)) if words else (np.zeros(0, np.int64), [])
    return codes, np.cumsum([len(s) for s in split]), list(distinct)


def _gram_table(grams: list[str]) -> pd.DataFrame:
    """The keys of each gram, of its ending and of the contexts of both."""
    sizes = np.fromiter(map(len, grams), np.int64, len(grams))
    flat = np.frombuffer("".join(grams).encode("utf-32-le", "surrogatepass"), np.uint32)
    last = np.cumsum(sizes) - 1
    # The context of a letter is the gram that ends before it.
    return pd.DataFrame({
        "gram": _gram_keys(flat, sizes, ORDER)[last], "context": _gram_keys(flat, sizes, ORDER - 1)[last - 1],
        "low": _gram_keys(flat, sizes, BACKOFF)[last], "low_context": _gram_keys(flat, sizes, BACKOFF - 1)[last - 1],
        "letter": flat[last].astype(np.int64),
    })


def _spelled(labelled: DataFrame) -> DataFrame:
    """Of (text, toxic), the spelling of every gram and its counts in toxic and in ordinary documents. Spellings
    travel, not keys: a few letters instead of five numbers."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in chunks(batch):
                codes, ends, words = split_words(part["text"].tolist())
                if not len(words):
                    continue
                toxic = np.repeat(part["toxic"].to_numpy(), np.diff(ends, prepend=0))
                flat, sizes = _letters(words)
                starts = np.cumsum(sizes) - sizes
                letter = np.ones(len(flat), bool)
                letter[starts] = False
                grams = pd.DataFrame({"gram": _gram_keys(flat, sizes, ORDER), "end": np.arange(len(flat)) + 1, "start": np.repeat(starts, sizes)})[letter]
                for name, rows in (("n_toxic", toxic == 1), ("n_ordinary", toxic == 0)):
                    grams[name] = np.repeat(np.bincount(codes[rows], minlength=len(words)), sizes - 1)
                grams = grams[(grams["n_toxic"] > 0) | (grams["n_ordinary"] > 0)]
                found = grams.groupby("gram").agg({"end": "first", "start": "first", "n_toxic": "sum", "n_ordinary": "sum"})
                line = "".join(f"\x02{w}\x03" for w in words)
                lo = np.maximum(found["start"], found["end"] - ORDER)
                spelling = [line[i:j] for i, j in zip(lo, found["end"], strict=True)]
                yield found[["n_toxic", "n_ordinary"]].assign(spelling=spelling)

    return _summed(labelled.select("text", "toxic").mapInPandas(work, "spelling string, n_toxic long, n_ordinary long"))


def _summed(parts: DataFrame) -> DataFrame:
    return parts.groupBy("spelling").agg(*[F.sum(c).alias(c) for c in ("n_toxic", "n_ordinary")])


def _keyed_grams(spelled: DataFrame) -> DataFrame:
    """The rows of ``spelled`` with the keys of their grams."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield pd.concat([_gram_table(batch["spelling"].tolist()), batch.reset_index(drop=True)], axis=1)

    keys = "gram long, context long, low long, low_context long, letter long"
    return spelled.mapInPandas(work, f"{keys}, spelling string, n_toxic long, n_ordinary long")


def gram_counts(labelled: DataFrame) -> DataFrame:
    """Counts of every gram in toxic and in ordinary documents, from (text, toxic)."""
    return _keyed_grams(_spelled(labelled))


def gram_weights(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of every gram the difference of its log probabilities in the two models, and of every context that of the
    weights both give to backing off. ``counts`` is a stored table."""
    d = DISCOUNT
    # Shared lower orders: of how many different grams is this the ending.
    letters = counts.groupBy("letter").agg(F.count("*").alias("ways"))
    all_ways = letters.agg(F.sum("ways")).first()[0] or 1
    lows = counts.groupBy("low").agg(
        F.min("low_context").alias("low_context"), F.min("letter").alias("letter"), F.count("*").alias("ways")
    )
    low_contexts = lows.groupBy("low_context").agg(F.sum("ways").alias("context_ways"), F.count("*").alias("kinds"))
    p1 = F.col("letter_ways") / F.lit(all_ways)
    shared = (
        lows.join(low_contexts, "low_context")
        .join(letters.withColumnRenamed("ways", "letter_ways"), "letter")
        .select("low", ((F.col("ways") - d + d * F.col("kinds") * p1) / F.col("context_ways")).alias("p_shared"))
    )
    contexts = counts.groupBy("context").agg(
        *[F.sum(f"n_{c}").alias(f"all_{c}") for c in ("toxic", "ordinary")],
        *[F.sum((F.col(f"n_{c}") > 0).cast("long")).alias(f"kinds_{c}") for c in ("toxic", "ordinary")],
    )

    def back(c: str) -> Column:
        return F.when(F.col(f"all_{c}") > 0, d * F.col(f"kinds_{c}") / F.col(f"all_{c}")).otherwise(1.0)

    def p(c: str) -> Column:
        seen = F.greatest(F.col(f"n_{c}") - d, F.lit(0.0)) / F.greatest(F.col(f"all_{c}"), F.lit(1))
        return seen + back(c) * F.col("p_shared")

    weights = (
        counts.join(contexts, "context")
        .join(shared, "low")
        .select(F.col("gram").alias("key"), F.log(p("toxic") / p("ordinary")).alias("weight"))
    )
    backing = contexts.select(F.col("context").alias("key"), F.log(back("toxic") / back("ordinary")).alias("weight"))
    return weights, backing


def _by_key(weights: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """All keys in order and their weights: 12 bytes for each. By Arrow, since rows as objects take thirty times that."""
    found = weights.select("key", F.col("weight").cast("float").alias("weight")).toArrow()
    keys, values = found.column("key").to_numpy(), found.column("weight").to_numpy()
    order = np.argsort(keys)
    return keys[order], values[order]


def _look_up(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> np.ndarray:
    """The keys' weights, NaN where the very key was never counted."""
    known, weight = table
    if not len(known):
        return np.full(len(keys), np.nan, np.float32)
    distinct, at = np.unique(keys, return_inverse=True)
    place = np.minimum(np.searchsorted(known, distinct), len(known) - 1)
    return np.where(known[place] == distinct, weight[place], np.float32(np.nan))[at]


def evidence(texts: list[str], grams: tuple[np.ndarray, np.ndarray], backing: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Per text: strongest word, mean of its three strongest, of its eight strongest, share of strong words, mean."""
    codes, ends, words = split_words(texts)
    out = np.zeros((len(texts), N_EVIDENCE))
    if not len(words):
        return out
    flat, sizes = _letters(words)
    start = np.zeros(len(flat), bool)
    start[np.cumsum(sizes) - sizes] = True
    weight = _look_up(grams, _gram_keys(flat, sizes, ORDER))
    # An unseen gram is left to backing off from the gram before it.
    unseen = np.flatnonzero(np.isnan(weight) & ~start)
    weight[unseen] = np.nan_to_num(_look_up(backing, _gram_keys(flat, sizes, ORDER - 1)[unseen - 1]))
    weight[start] = 0
    per_word = np.add.reduceat(weight.astype(np.float64), np.cumsum(sizes) - sizes) / (sizes - 1)
    values = per_word[codes]
    lo = 0
    for i, hi in enumerate(ends):
        if hi > lo:
            v = values[lo:hi]
            top = -np.partition(-v, min(8, len(v)) - 1)[:8]
            top = -np.sort(-top)
            out[i] = top[0], top[:3].mean(), top.sum() / 8, (v > STRONG).mean(), v.mean()
        lo = hi
    return out


def _fit_curve(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ridge logistic regression by Newton steps on standardised evidence."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    w = np.zeros(z.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (p - y) + 0.1 * w
        hessian = (z * (p * (1 - p))[:, None]).T @ z + 0.1 * np.eye(len(w))
        w -= np.linalg.solve(hessian, gradient)
    return mean, scale, w


def _letter_rows(words: DataFrame) -> DataFrame:
    """word, gram and context of each letter but the start mark, of (word)."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in chunks(batch, "word", 1 << 18):
                names = part["word"].tolist()
                flat, sizes = _letters(names)
                start = np.zeros(len(flat), bool)
                start[np.cumsum(sizes) - sizes] = True
                at = np.flatnonzero(~start)
                word = np.repeat(np.array(names, object), sizes - 1)
                yield pd.DataFrame({"word": word, "gram": _gram_keys(flat, sizes, ORDER)[at], "context": _gram_keys(flat, sizes, ORDER - 1)[at - 1]})

    return words.mapInPandas(work, "word string, gram long, context long")


def _bags(texts: DataFrame) -> DataFrame:
    """did, seen, word and how often a text holds it; rows of one key hold the same."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in chunks(batch):
                codes, ends, words = split_words(part["text"].tolist())
                if not len(words):
                    continue
                row = np.repeat(np.arange(len(part)), np.diff(ends, prepend=0))
                pairs, times = np.unique(row * len(words) + codes, return_counts=True)
                row, word = np.divmod(pairs, len(words))
                yield pd.DataFrame({"did": part["did"].to_numpy()[row], "seen": part["seen"].to_numpy()[row],
                                    "word": np.array(words, object)[word], "times": times})

    bags = texts.select("did", "seen", "text").mapInPandas(work, "did long, seen long, word string, times long")
    return bags.groupBy("did", "seen", "word").agg(F.max("times").alias("times"))


def joined_evidence(texts: DataFrame, weights: DataFrame, backing: DataFrame) -> DataFrame:
    """did, seen and x, as :func:`evidence` gives it, of the texts that have words, by joins alone: distinct words take
    the weights of their grams, documents the evidence of their words. Nothing of the corpus is held in one place."""
    from streamtally.session import stored

    bags = stored(_bags(texts), "bags")
    letters = _letter_rows(bags.select("word").distinct())
    known = letters.join(weights.select(F.col("key").alias("gram"), "weight"), "gram", "left")
    backed = known.join(backing.select(F.col("key").alias("context"), F.col("weight").alias("back")), "context", "left")
    weight = F.coalesce(F.col("weight").cast("float"), F.col("back").cast("float"), F.lit(0.0))
    words = stored(backed.groupBy("word").agg(F.avg(weight).alias("v")), "words")
    found = bags.join(words, "word").groupBy("did", "seen").agg(
        F.sum("times").alias("n"),
        F.sum(F.col("v") * F.col("times")).alias("total"),
        F.sum(F.when(F.col("v") > STRONG, F.col("times")).otherwise(0)).alias("strong"),
        # At most the distinct words of one document.
        F.slice(F.sort_array(F.collect_list(F.struct("v", "times")), asc=False), 1, 8).alias("best"),
    )
    top = F.slice(F.flatten(F.transform("best", lambda b: F.array_repeat(b["v"], F.least(b["times"], F.lit(8)).cast("int")))), 1, 8)
    added = lambda k: F.aggregate(F.slice("top", 1, k), F.lit(0.0), lambda acc, v: acc + v)
    x = F.array(F.element_at("top", 1), added(3) / F.least(F.size("top"), F.lit(3)), added(8) / 8, F.col("strong") / F.col("n"), F.col("total") / F.col("n"))
    return found.withColumn("top", top).select("did", "seen", x.alias("x"))


class Toxicity:
    """What :func:`fit` has learnt: two models, their tables, and the curve.

    Tables of at most ``broadcast_rows`` rows each are looked up in every task, where texts are read. Larger ones are
    joined: the same evidence, by shuffles."""

    def __init__(self, weights: DataFrame, backing: DataFrame, broadcast_rows: int) -> None:
        self.weights, self.backing = weights, backing
        self.small = max(weights.count(), backing.count()) <= broadcast_rows
        self.tables = weights.sparkSession.sparkContext.broadcast((_by_key(weights), _by_key(backing))) if self.small else None
        self.curve: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None

    def evidence(self, texts: DataFrame) -> DataFrame:
        """did, seen and x of every row of ``texts`` (did, seen, text and other columns), with its other columns."""
        rest = [c for c in texts.columns if c not in ("did", "seen", "text")]
        if not self.small:
            found = joined_evidence(texts, self.weights, self.backing)
            joined = texts.drop("text").join(found, ["did", "seen"], "left")
            return joined.withColumn("x", F.coalesce("x", F.array(*[F.lit(0.0)] * N_EVIDENCE)))
        tables = self.tables

        def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for part in chunks(batch):
                    found = evidence(part["text"].tolist(), *tables.value)
                    yield part.drop(columns="text").assign(x=list(found))

        schema = T.StructType([f for f in texts.schema.fields if f.name != "text"]).add("x", T.ArrayType(T.DoubleType()))
        return texts.select("did", "seen", *rest, "text").mapInPandas(work, T.StructType([schema[c] for c in ("did", "seen", *rest, "x")]))

    def score(self) -> Column:
        """The score of the evidence ``x``."""
        if self.curve is None:
            return F.lit(0.0)
        mean, scale, w = self.curve
        z = sum((F.lit(float(w[i + 1] / scale[i])) * (F.element_at("x", i + 1) - F.lit(float(mean[i]))) for i in range(N_EVIDENCE)), F.lit(float(w[0])))
        return 1 / (1 + F.exp(-F.least(F.greatest(z, F.lit(-30.0)), F.lit(30.0))))


def _keyed(docs: DataFrame, *more: Column) -> DataFrame:
    did, seen = row_key(docs)
    return docs.select(did.alias("did"), seen.alias("seen"), F.coalesce(F.col("text"), F.lit("")).alias("text"), *more)


def fit(docs: DataFrame, labels: DataFrame, curve_docs: int = CURVE_DOCS, broadcast_rows: int = BROADCAST_ROWS) -> Toxicity:
    """The model of the scores.

    Several labels of one document: one toxic label makes it toxic. Labels of no document, and rows without
    doc_id, teach nothing. Without a single training row of both classes every score is 0."""
    from streamtally.session import stored

    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .filter("doc_id is not null and toxic in (0, 1)")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .filter(fold(F.col("doc_id")) != 2)
    )
    texts = _keyed(docs, fold(F.col("doc_id")).alias("fold"), F.col("doc_id").cast("long").alias("doc_id"))
    # One plan at every size: the labels grow with the documents, so they are never broadcast.
    train = texts.filter("fold != 2").join(known.hint("merge"), "doc_id")
    first = stored(gram_counts(train.filter("fold != 3")), "grams")
    rest = _spelled(train.filter("fold = 3"))
    counts = stored(_keyed_grams(_summed(first.select(rest.columns).unionByName(rest))), "all-grams")

    def model(of: DataFrame) -> Toxicity:
        weights, backing = gram_weights(of)
        return Toxicity(stored(weights, "weights"), stored(backing, "backing"), broadcast_rows)

    # The curve is fitted on fold 3 by models that have not counted it; the scores' models have.
    partial, shared = model(first), model(counts)
    held = known.filter(fold(F.col("doc_id")) == 3).count()
    slots = max(1, -(-held // max(1, curve_docs)))
    chosen = (F.col("fold") == 3) & (F.pmod(F.xxhash64("doc_id"), F.lit(slots)) == 0)
    sample = texts.filter(chosen).join(known.hint("merge"), "doc_id")
    fitted = partial.evidence(sample.select("did", "seen", "text", "toxic")).select("toxic", "x").toArrow()
    y = fitted.column("toxic").to_numpy()
    if len(set(y.tolist())) == 2:
        shared.curve = _fit_curve(np.array(fitted.column("x").to_pylist()), y)
    return shared


def score_documents(docs: DataFrame, labels: DataFrame, curve_docs: int = CURVE_DOCS, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``.

    Rows without any label, or whose doc_id is null, only get a score. Null and empty texts get the score of a
    text without evidence; whole texts are scored, however long. Repeated rows are scored alike; an empty table has no
    rows; other columns are ignored."""
    model = fit(docs, labels, curve_docs, broadcast_rows)
    held = (fold(F.col("doc_id")) == 2).alias("held_out")
    found = model.evidence(_keyed(docs, F.col("doc_id").cast("long").alias("doc_id"), held))
    scored = found.select("doc_id", "held_out", model.score().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """The rows of ``docs`` whose score stays below the threshold, with all their columns, whatever their names.

    Null and empty texts, repeated rows and null ids are scored as in :func:`score_documents`."""
    from streamtally.session import stored

    model = fit(docs, labels, broadcast_rows=broadcast_rows)
    found = model.evidence(_keyed(docs))
    id_, hash_ = unused(docs, "did", "seen")
    gone = stored(found.filter(model.score() >= THRESHOLD).select(F.col("did").alias(id_), F.col("seen").alias(hash_)).distinct(), "toxic")
    did, seen = row_key(docs)
    # Written first, so that the optimizer knows the size of what goes when it chooses the join.
    return docs.withColumns({id_: did, hash_: seen}).join(gone, [id_, hash_], "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


@register()
def op5_toxicity_kneser_ney(spark: SparkSession, folder: str) -> DataFrame:
    return score_documents(table(spark, folder, "documents"), table(spark, folder, "labels"))
