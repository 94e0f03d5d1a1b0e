"""Operator 13: how far the sources of a language diverge, term by term and pair by pair.

Counts become whole numbers p (a share of 10^9, add-one smoothed), and a term's divergence of p from q is
floor((p - q)^2 / q). All of it is integer arithmetic.

Terms: a group's highest values are found by dominance. A term with a count as high, a lang count as low and earlier
letters than another always ranks before it, so a term dominated by k others can't be among the first k. Each partition
retains its k-skyband (terms dominated by fewer than k others of the partition); the merged skybands hold every term of
the result, and only they are ranked by their exact values.

Pairs: only terms that both sources hold are looked at together. With f00 the value of a term that neither holds,
sum f(p, q) = V f00 + sum over s (f(p, q0) - f00) + sum over o (f(p0, q) - f00)
              + sum over both (f(p, q) - f(p, q0) - f(p0, q) + f00),
where the second and third sums need no more than how often each p occurs in a source.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from streamtally.session import stored

from .common import expand, register, table

SCALE = 1_000_000_000
MIN_DOCS = 3
TOP_TERMS = 200
# Distinct (group, term) entries that a task counts before it passes them on.
HELD_ENTRIES = 300_000
# Terms compared with the skyband at a time, and pairs of sources looked at at a time.
BAND_ROWS = 512
PAIR_ROWS = 1 << 20
# Bytes of a text: A-Z become a-z, other ASCII letters and all bytes above ASCII stay, the rest separates terms.
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_COUNTED = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])
_BOTH = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())])


def _named(docs: DataFrame, *columns: str) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns])


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences) and docs (rows that hold it), in parts that are still to be added up."""

    def emitted(held: dict[tuple[str, str], tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs_) in held.items():
            terms = list(n)
            if terms:
                columns = [
                    pa.array([lang] * len(terms), pa.string()),
                    pa.array([source] * len(terms), pa.string()),
                    pa.array(terms, pa.binary()).cast(pa.string()),
                    pa.array(n.values(), pa.int64()),
                    pa.array([docs_[t] for t in terms], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=_COUNTED)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        entries = 0
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), texts, strict=True):
                n, docs_ = held.setdefault((lang, source), (Counter(), Counter()))
                before = len(n)
                terms = text.as_py().translate(_BYTES).split()
                n.update(terms)
                docs_.update(set(terms))
                entries += len(n) - before
                if entries >= HELD_ENTRIES:
                    yield from emitted(held)
                    held, entries = {}, 0
        yield from emitted(held)

    schema = "lang string, source string, term string, n long, docs long"
    return _named(docs, "lang", "source", "text").mapInArrow(work, schema)


def _share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE (count + 1) / (total + terms)), in decimals that hold any count."""
    whole = lambda c: c.cast("decimal(20,0)")
    fraction = F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * whole(count + 1), whole(total + terms))
    return F.when(total + terms > 0, fraction + 1)


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def _value(p: Column, q: Column) -> Column:
    return _div((p - q) * (p - q), q)


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """lang, source, term, n, lang_n of the terms that ``min_docs`` rows of their lang hold, and, once for each term of
    a lang, first. Everything of one term stays in one place, so one shuffle does."""
    # Without a map-side part: the tasks have added up what they can.
    dealt = term_counts(docs).repartition("lang", "term")
    summed = dealt.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    one = Window.partitionBy("lang", "term")
    spread = summed.withColumns(
        {"lang_n": F.sum("n").over(one), "lang_docs": F.sum("docs").over(one), "first": F.min("source").over(one) == F.col("source")}
    )
    return spread.filter(F.col("lang_docs") >= min_docs).select("lang", "source", "term", "n", "lang_n", "first")


def group_totals(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """One row for each group that occurs: total and n_terms (with a count) of the group, v and lang_total of its lang,
    and p0, the share of a term without occurrence (null if v is 0)."""
    found = kept.groupBy("lang", "source").agg(
        F.sum("n").alias("total"), F.count("*").alias("n_terms"), F.sum(F.col("first").cast("long")).alias("firsts")
    )
    groups = _named(docs, "lang", "source").distinct().join(found, ["lang", "source"], "left").fillna(0, ["total", "n_terms", "firsts"])
    # One row per group: its lang's groups are few beside its terms.
    lang = Window.partitionBy("lang")
    whole = groups.withColumns({"v": F.sum("firsts").over(lang), "lang_total": F.sum("total").over(lang)})
    p0 = F.when(F.col("v") > 0, _share(F.lit(0).cast("long"), F.col("total"), F.col("v")))
    return whole.withColumn("p0", p0).drop("firsts")


def measured(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """The kept terms with p (of the group), q (of its lang) and p0."""
    joined = kept.join(groups, ["lang", "source"])
    return joined.withColumns(
        {"p": _share(F.col("n"), F.col("total"), F.col("v")), "q": _share(F.col("lang_n"), F.col("lang_total"), F.col("v"))}
    )


def _band(held: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Which of ``rows`` (n, lang_n; in order of their terms) fewer than k earlier ones dominate. ``held`` is the
    skyband of all before them: who is dominated by k is dominated by k of its members."""
    n, lang_n = rows[:, 0], rows[:, 1]
    above = ((held[None, :, 0] >= n[:, None]) & (held[None, :, 1] <= lang_n[:, None])).sum(axis=1)
    earlier = np.tri(len(rows), k=-1, dtype=bool)
    above += ((n[None, :] >= n[:, None]) & (lang_n[None, :] <= lang_n[:, None]) & earlier).sum(axis=1)
    return above < k


def skyband(rows: DataFrame, k: int = TOP_TERMS) -> DataFrame:
    """Of ``rows`` (lang, source, term, n, lang_n and more) each partition's terms that fewer than k others of the same
    group and partition dominate: n at least as high, lang_n at least as low, term earlier in UTF-8. Rows keep their
    columns. Memory holds one group's skyband."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, np.zeros((0, 2), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            pairs = np.column_stack([batch.column("n").to_numpy(), batch.column("lang_n").to_numpy()])
            names = pd.DataFrame({c: batch.column(c).to_pandas() for c in ("lang", "source")})
            cuts = np.flatnonzero((names != names.shift()).any(axis=1).to_numpy())
            keep = np.zeros(batch.num_rows, bool)
            for lo, hi in zip(cuts, [*cuts[1:], batch.num_rows], strict=True):
                key = tuple(names.iloc[lo])
                if key != group:
                    group, held = key, np.zeros((0, 2), np.int64)
                for at in range(lo, hi, BAND_ROWS):
                    part = pairs[at : min(hi, at + BAND_ROWS)]
                    keep[at : at + len(part)] = stays = _band(held, part, k)
                    held = np.concatenate([held, part[stays]])
            yield batch.filter(pa.array(keep))

    return rows.sortWithinPartitions("lang", "source", "term").mapInArrow(work, rows.schema)


def divergent_terms(terms: DataFrame, k: int = TOP_TERMS) -> DataFrame:
    """lang, source, item, value, rank: each group's k terms of highest value among those with p > q."""
    over = terms.filter("p > q").select("lang", "source", "term", "n", "lang_n", "p", "q")
    merged = skyband(over, k).select("lang", "source", F.col("term").alias("item"), _value(F.col("p"), F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return merged.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _both(terms: DataFrame) -> DataFrame:
    """The last sum of the module text, in parts, from terms that several sources of a lang hold."""
    held = terms.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "p", "p0")).alias("held")).filter(F.size("held") > 1)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[pd.DataFrame] = []
        keys = ["lang", "source", "item"]

        def summed() -> pd.DataFrame:
            return pd.concat(parts).groupby(keys, as_index=False, sort=False)["value"].sum()

        for batch in batches:
            lists = batch.column("held")
            sizes = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten()
            names = pa.compute.dictionary_encode(flat.field("source"))
            langs = pa.compute.dictionary_encode(batch.column("lang"))
            name, lang = names.indices.to_numpy().astype(np.int64), langs.indices.to_numpy().astype(np.int64)
            p, p0 = flat.field("p").to_numpy(), flat.field("p0").to_numpy()
            starts = np.cumsum(sizes) - sizes
            pairs = sizes.astype(np.int64) ** 2
            piece = (np.cumsum(pairs) - pairs) // PAIR_ROWS
            f = lambda a, b: (a - b) ** 2 // b
            for lo, hi in zip(cuts := np.flatnonzero(np.diff(piece, prepend=-1)), [*cuts[1:], len(sizes)], strict=True):
                s, k = starts[lo:hi].astype(np.int64), sizes[lo:hi].astype(np.int64)
                # Every element of a list beside every element of the same list.
                each = expand(s, k)
                width = np.repeat(k, k)
                left, right = np.repeat(each, width), expand(np.repeat(s, k), width)
                value = f(p[left], p[right]) - f(p[left], p0[right]) - f(p0[left], p[right]) + f(p0[left], p0[right])
                n = len(names.dictionary)
                code = (np.repeat(np.repeat(lang[lo:hi], k), width) * n + name[left]) * n + name[right]
                got = pd.DataFrame({"code": code, "value": value})[left != right].groupby("code", sort=False)["value"].sum()
                code = got.index.to_numpy()
                take = lambda d, i: d.take(pa.array(i)).to_pandas()
                parts.append(
                    pd.DataFrame(
                        {
                            "lang": take(langs.dictionary, code // (n * n)),
                            "source": take(names.dictionary, code // n % n),
                            "item": take(names.dictionary, code % n),
                            "value": got.to_numpy(),
                        }
                    )
                )
                if sum(map(len, parts)) > PAIR_ROWS:
                    parts = [summed()]
                    if len(parts[0]) > PAIR_ROWS // 2:
                        yield pa.RecordBatch.from_pandas(parts.pop(), _BOTH, preserve_index=False)
        if parts:
            yield pa.RecordBatch.from_pandas(summed(), _BOTH, preserve_index=False)

    return held.select("lang", "held").mapInArrow(work, "lang string, source string, item string, value long")


def source_pairs(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item (each other source of the lang), value (summed over all kept terms of the lang) and rank."""
    s = groups.select("lang", "source", "v", F.col("p0").alias("s0"))
    o = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("o0"))
    # The result itself has these rows.
    pairs = s.join(o, "lang").filter("source <> item")
    # How often each share occurs in a source, beside every other source of the lang.
    shares = terms.groupBy("lang", "source", "p").agg(F.count("*").alias("times"))
    beside = shares.join(pairs, ["lang", "source"])
    only = lambda here, there, value, none: beside.select(
        "lang", F.col(here).alias("source"), F.col(there).alias("item"), (F.col("times") * (value - none)).alias("value")
    )
    s0, o0, p = F.col("s0"), F.col("o0"), F.col("p")
    parts = (
        only("source", "item", _value(p, o0), _value(s0, o0))
        .unionByName(only("item", "source", _value(o0, p), _value(o0, s0)))
        .unionByName(_both(terms))
    )
    sums = parts.groupBy("lang", "source", "item").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("more"))
    none = F.coalesce(F.col("v") * _value(s0, o0), F.lit(0)).cast("decimal(38,0)")
    whole = pairs.join(sums, ["lang", "source", "item"], "left").select(
        "lang", "source", "item", (none + F.coalesce("more", F.lit(0).cast("decimal(38,0)"))).cast("long").alias("value")
    )
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return whole.withColumn("rank", F.row_number().over(order))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part (pair or term), item, value and rank of every group of ``docs``.

    Null text, lang and source count as empty strings. Terms are runs of ASCII letters and of anything above ASCII, with
    only A-Z lower-cased; whole texts of any length are counted. Every row counts, so repeated rows count repeatedly; doc_id and all other
    columns are ignored. A lang without kept terms has pairs of value 0 and no terms; a lang of one source has no pairs; an
    empty table has no rows. Equal values are ranked by the UTF-8 of their item."""
    kept = stored(kept_terms(docs, min_docs), "kept-terms")
    groups = stored(group_totals(docs, kept), "groups")
    terms = measured(kept, groups)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    pair = source_pairs(terms, groups).withColumn("part", F.lit("pair"))
    term = divergent_terms(terms, top).withColumn("part", F.lit("term"))
    return pair.select(columns).unionByName(term.select(columns))


SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
  FROM documents),
groups AS (SELECT DISTINCT lang, source FROM docs),
tokens AS (SELECT row, lang, source, unnest(terms) AS term FROM docs),
kept AS (SELECT lang, term, CAST(count(*) AS HUGEINT) AS n FROM tokens GROUP BY ALL HAVING count(DISTINCT row) >= {MIN_DOCS}),
counts AS (SELECT t.lang, source, term, CAST(count(*) AS HUGEINT) AS n FROM tokens t JOIN kept USING (lang, term) GROUP BY ALL),
langs AS (SELECT lang, CAST(count(*) AS HUGEINT) AS v, sum(n) AS total FROM kept GROUP BY lang),
totals AS (SELECT lang, source, sum(n) AS total FROM counts GROUP BY ALL),
grid AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + ({SCALE}::HUGEINT * (coalesce(c.n, 0) + 1)) // (coalesce(t.total, 0) + l.v) AS p,
    1 + ({SCALE}::HUGEINT * (k.n + 1)) // (l.total + l.v) AS q
  FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang)
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
  LEFT JOIN totals t ON t.lang = g.lang AND t.source = g.source),
pairs AS (
  SELECT s.lang, s.source, o.source AS item, sum(((s.p - o.p) * (s.p - o.p)) // o.p) AS value
  FROM grid s JOIN grid o ON s.lang = o.lang AND s.term = o.term AND s.source <> o.source GROUP BY ALL),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(p.value, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, CAST(((p - q) * (p - q)) // q AS BIGINT) FROM grid WHERE n > 0 AND p > q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM found)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= {TOP_TERMS}
"""


@register(SQL)
def op13_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return audit(table(spark, folder, "documents"))
