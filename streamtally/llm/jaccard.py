"""Operator 7: n-gram Jaccard join with R-trees over count vectors.

A document is the set of its distinct five-word shingles. Its tokens (shingles) are hashed into groups; the counts
per group are a point. The overlap of two sets is at most the sum of the coordinate minima of their points, which
also bounds the overlap with everything below an R-tree node whose maxima are known. What survives the bound is
verified on the sets themselves.

Where the trees are built: documents meet in cells. Every document names the first n - ceil(0.8 n) + 1 shingles of
its set in one global order (frequent shingles last); two linked documents share at least one of them. The documents
that name a shingle meet in the cell of the smallest of them. First every cell is searched for partners of that
document alone; once the links found this way are followed, only cells that still hold several components are
searched again, block against block. So copies by the thousand need no pairs among themselves, and no cell, however
many documents meet there, has to fit into one task.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from streamtally.session import stored

from .common import chunks, expand, merged, mix64, register, row_key, table, texts_of, unused
from .components import components

SHINGLE_WORDS = 5
GROUPS = 256
# Points in one tree.
BLOCK = 1024
FANOUT = 16
# Pairs of two components that one block tries first.
LIKELIEST = 8
# Shingles that go last in the global order, found on a bounded sample. The choice only decides speed.
FREQUENT = 100_000
SAMPLE_DOCS = 10_000
# Partners of a document that are verified in one block.
PARTNERS = 256
# Destinations of sets, about 30 bytes each, that may be broadcast to where texts are read.
BROADCAST_SENT = 500_000
_FACTORS = mix64(np.arange(1, SHINGLE_WORDS + 1, dtype=np.uint64)) | np.uint64(1)


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text. With fewer than five words the sequence is the only one."""
    split = [t.encode("utf-8", "surrogatepass").lower().split() for t in texts]
    words = [w for one in split for w in one]
    if not words:
        return [np.zeros(0, np.int64) for _ in texts]
    codes, distinct = pd.factorize(np.array(words, dtype=object))
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, distinct), np.uint64, len(distinct))[codes]
    rolled = np.zeros(len(hashes), np.uint64)
    for i in range(SHINGLE_WORDS):
        rolled[: len(hashes) - i] += hashes[i:] * _FACTORS[i]
    rolled = mix64(rolled).view(np.int64)
    out, at = [], 0
    for one in split:
        n = len(one)
        if n >= SHINGLE_WORDS:
            out.append(np.unique(rolled[at : at + n - SHINGLE_WORDS + 1]))
        else:
            short = (hashes[at : at + n] * _FACTORS[:n]).sum(dtype=np.uint64) + np.uint64(n)
            out.append(mix64(np.array([short] if n else [], np.uint64)).view(np.int64))
        at += n
    return out


def _digest(items: np.ndarray) -> tuple[int, int]:
    """Two signed 64-bit hashes of a set."""
    both = np.frombuffer(xxhash.xxh3_128_digest(items.tobytes()), ">i8")
    return int(both[0]), int(both[1])


def _sets_of(docs: DataFrame, shape, schema: str) -> DataFrame:
    """Applies ``shape`` (rows of a slice, their sets) -> rows to all documents."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in chunks(batch, size=1 << 20):
                yield shape(part, shingle_sets(part["text"].tolist()))

    return docs.mapInPandas(work, schema)


def frequent_shingles(texts: DataFrame, most: int = FREQUENT, sample: int = SAMPLE_DOCS) -> np.ndarray:
    """The shingles in most documents of a sample of about ``sample`` documents, sorted; at most ``most``."""
    slots = max(1, -(-texts.count() // max(1, sample)))
    seen = texts.filter(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(slots)) == 0)
    rows = _sets_of(seen, lambda part, sets: pd.DataFrame({"s": np.concatenate([*sets, np.zeros(0, np.int64)])}), "s long")
    found = rows.groupBy("s").count().filter("count > 2").orderBy(F.desc("count"), "s").limit(most)
    return np.sort(found.select("s").toArrow().column("s").to_numpy())


def sketches(texts: DataFrame, most: int = FREQUENT, sample: int = SAMPLE_DOCS) -> DataFrame:
    """Per row: doc_id, n (set size), two hashes of the set, its point, and its first shingles in the global order."""
    last = texts.sparkSession.sparkContext.broadcast(frequent_shingles(texts, most, sample))

    def shape(part: pd.DataFrame, sets: list[np.ndarray]) -> pd.DataFrame:
        sizes = np.fromiter(map(len, sets), np.int64, len(sets))
        flat = np.concatenate([*sets, np.zeros(0, np.int64)])
        ends = np.cumsum(sizes)
        common = last.value
        rare = np.ones(len(flat), bool)
        if len(common) and len(flat):
            rare = common[np.minimum(np.searchsorted(common, flat), len(common) - 1)] != flat
        rows = np.repeat(np.arange(len(sets)), sizes)
        points = np.bincount(rows * GROUPS + (flat & (GROUPS - 1)), minlength=len(sets) * GROUPS).reshape(-1, GROUPS)
        firsts = []
        for s, lo, hi in zip(sets, ends - sizes, ends, strict=True):
            n = len(s)
            mask = rare[lo:hi]
            firsts.append(np.concatenate([s[mask], s[~mask]])[: n - (4 * n + 4) // 5 + 1] if n else s)
        digests = [_digest(s) for s in sets]
        return pd.DataFrame(
            {
                "doc_id": part["doc_id"].array,
                "n": sizes,
                "k1": [d[0] for d in digests],
                "k2": [d[1] for d in digests],
                # One byte a count as long as all fit, compressed: points travel more than anything else.
                "point": [zlib.compress(p.astype("u1" if p.max() < 256 else "<i4").tobytes(), 1) for p in points],
                "firsts": firsts,
            }
        )

    return _sets_of(texts, shape, "doc_id long, n long, k1 long, k2 long, point binary, firsts array<long>")


class RTree:
    """Points packed into nodes bottom-up; a node knows the maxima of its coordinates and its least size."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray) -> None:
        self.order = np.lexsort((points.argmax(axis=1), sizes))
        self.levels = [(points[self.order], sizes[self.order], sizes[self.order])]
        while len(self.levels[-1][0]) > FANOUT:
            top, least, most = self.levels[-1]
            cuts = np.arange(0, len(top), FANOUT)
            self.levels.append(
                (np.maximum.reduceat(top, cuts), np.minimum.reduceat(least, cuts), np.maximum.reduceat(most, cuts))
            )

    def search(self, points: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs (query, point) whose bound allows a link, nine overlaps reaching four times the sum of the sizes,
        and the bound's share of that sum."""
        height = len(self.levels) - 1
        width = len(self.levels[height][0])
        queries, nodes = np.repeat(np.arange(len(points)), width), np.tile(np.arange(width), len(points))
        for level in range(height, -1, -1):
            top, least, most = self.levels[level]
            if level < height:
                first = nodes * FANOUT
                counts = np.minimum(first + FANOUT, len(top)) - first
                queries, nodes = np.repeat(queries, counts), expand(first, counts)
            # Sizes first: the smaller set has at least four fifths of the larger.
            own = sizes[queries]
            fits = (5 * most[nodes] >= 4 * own) & (4 * least[nodes] <= 5 * own)
            queries, nodes = queries[fits], nodes[fits]
            keep, share = np.zeros(len(queries), bool), np.zeros(len(queries))
            for lo in range(0, len(queries), 1 << 14):
                q, x = queries[lo : lo + (1 << 14)], nodes[lo : lo + (1 << 14)]
                shared = np.minimum(points[q], top[x]).sum(axis=1, dtype=np.int64)
                other = np.maximum(least[x], (4 * sizes[q] + 4) // 5)
                keep[lo : lo + (1 << 14)] = 9 * shared >= 4 * (sizes[q] + other)
                share[lo : lo + (1 << 14)] = shared / (sizes[q] + other)
            queries, nodes = queries[keep], nodes[keep]
        return queries, self.order[nodes], share[keep]


def _grouped(rows: DataFrame, keys: list[str], columns: list[str], search, schema: str) -> DataFrame:
    """Applies ``search`` to the rows of each key, many keys to a task; a key's rows are one block at most."""
    dealt = rows.repartition(*keys).sortWithinPartitions(*keys).select(*keys, *columns)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            rest = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            key = rest[keys].to_numpy()
            cuts = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
            found = [search(rest.iloc[a:b]) for a, b in zip([0, *cuts[:-1]], cuts, strict=False)] if len(cuts) else []
            rest = rest.iloc[cuts[-1] :] if len(cuts) else rest
            if found:
                yield pd.concat(found, ignore_index=True)
        if rest is not None and len(rest):
            yield search(rest)

    return dealt.mapInPandas(work, schema)


def _points(rows: pd.DataFrame) -> np.ndarray:
    plain = map(zlib.decompress, rows["point"])
    wide = [p if len(p) > GROUPS else np.frombuffer(p, "u1").astype("<i4").tobytes() for p in plain]
    return np.frombuffer(b"".join(wide), "<i4").reshape(-1, GROUPS)


def _hub_search(rows: pd.DataFrame) -> pd.DataFrame:
    """Partners of the cell's smallest document among one block of the others."""
    hub = rows["k1"].to_numpy() == rows["hub"].to_numpy()
    points, sizes = _points(rows), rows["n"].to_numpy()
    others = np.flatnonzero(~hub)
    if not hub.any() or not len(others):
        return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
    one = np.flatnonzero(hub)[:1]
    _, found, _ = RTree(points[others], sizes[others]).search(points[one], sizes[one])
    ids = rows["k1"].to_numpy()
    return pd.DataFrame({"a": np.repeat(ids[one], len(found)), "b": ids[others[found]]})


def _block_search(rows: pd.DataFrame, most: int | None) -> pd.DataFrame:
    """Pairs of different components in one block, or between two blocks, of a cell: all of them, or of any two
    components the ``most`` likeliest, with a mark if there are more."""
    ids, label, side = (rows[c].to_numpy() for c in ("k1", "label", "side"))
    points, sizes = _points(rows), rows["n"].to_numpy()
    left = np.flatnonzero(side != 1)
    right = np.flatnonzero(side != 0)
    if not len(left) or not len(right):
        return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64), "more": np.zeros(0, bool)})
    q, x, share = RTree(points[right], sizes[right]).search(points[left], sizes[left])
    q, x = left[q], right[x]
    new = (label[q] != label[x]) & ((side[q] != 2) | (ids[q] < ids[x]))
    q, x, share = q[new], x[new], share[new]
    more = np.zeros(len(q), bool)
    if most is not None and len(q):
        low, high = np.minimum(label[q], label[x]), np.maximum(label[q], label[x])
        order = np.lexsort((-share, high, low))
        q, x, low, high = q[order], x[order], low[order], high[order]
        starts = np.flatnonzero(np.r_[True, (low[1:] != low[:-1]) | (high[1:] != high[:-1])])
        sizes_ = np.diff(np.r_[starts, len(q)])
        rank = np.arange(len(q)) - np.repeat(starts, sizes_)
        more = np.repeat(sizes_ > most, sizes_)
        q, x, more = q[rank < most], x[rank < most], more[rank < most]
    a, b = ids[q], ids[x]
    return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b), "more": more})


def _once(texts: DataFrame, rows: DataFrame) -> DataFrame:
    """``texts`` with one row for each doc_id and text: only ids that stand on several rows are compared."""
    several = stored(rows.groupBy("doc_id").count().filter("count > 1").select("doc_id"), "several")
    if several.isEmpty():
        return texts
    again = texts.join(several, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return texts.join(several, "doc_id", "left_anti").unionByName(again)


def _verified(pairs: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose sets really reach the similarity. ``nodes``: k1 and one doc_id each.

    Whole sets travel only for pairs that their shortened items leave possible: most pairs that points let through are
    of long sets far apart, and a short item is a quarter of a whole one."""
    possible = stored(_compared(pairs, nodes, texts, short=True), "possible")
    return _compared(possible, nodes, texts, short=False)


def _compared(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, short: bool) -> DataFrame:
    """The pairs whose sets reach the similarity; with ``short``, those that may, by the first 16 bits of the items
    (points hold the last ones).

    The sets of b travel to their a, once each: a's partners are cut into blocks of bounded size, and a's own set goes
    to the head of each block."""
    blocks = pairs.groupBy("a").agg(F.ceil(F.count("*") / PARTNERS).cast("int").alias("blocks"))
    heads = blocks.select(F.col("a").alias("k1"), F.col("a").alias("target"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    others = merged(pairs, blocks, "a").select(F.col("b").alias("k1"), F.col("a").alias("target"), F.pmod(F.xxhash64("b"), F.col("blocks")).cast("int").alias("block"))
    sent = heads.withColumn("head", F.lit(True)).unionByName(others.withColumn("head", F.lit(False)))
    # A node's destinations in lists of bounded length, so that its text is read and cut once for each list.
    lists = sent.groupBy("k1").agg(F.ceil(F.count("*") / PARTNERS).cast("int").alias("lists"))
    part = F.pmod(F.xxhash64("target", "block"), F.col("lists"))
    listed = merged(sent, lists, "k1").groupBy("k1", part.alias("part")).agg(F.collect_list(F.struct("target", "block", "head")).alias("sent"))
    wanted = stored(merged(nodes, listed, "k1").select("k1", F.col("rep").alias("doc_id"), "sent"), "wanted")
    # Up to a bound the texts stay where they are; beyond it they are shuffled to their destinations.
    small = (wanted.agg(F.sum(F.size("sent"))).first()[0] or 0) <= BROADCAST_SENT

    def keyed(part: pd.DataFrame, sets: list[np.ndarray]) -> pd.DataFrame:
        # A doc_id may stand on several rows of different texts: the row whose set has the node's hash counts.
        right = np.array([_digest(s)[0] for s in sets], np.int64) == part["k1"].to_numpy()
        out = [(k1, len(s), np.unique((s >> 48).astype(np.int16)) if short else s, to) for k1, s, to, ok in zip(part["k1"], sets, part["sent"], right, strict=True) if ok]
        return pd.DataFrame(out, columns=["k1", "n", "items", "sent"])

    place = "array<struct<target:long,block:int,head:boolean>>"
    sets = _sets_of(texts.join(F.broadcast(wanted) if small else wanted, "doc_id"), keyed, f"k1 long, n long, items array<{'smallint' if short else 'long'}>, sent {place}")
    rows = sets.select("k1", "n", "items", F.explode("sent").alias("to")).select("k1", "n", "items", "to.*")
    block = Window.partitionBy("target", "block").orderBy(F.desc("head"))
    met = rows.withColumn("own", F.first(F.struct("n", "items")).over(block)).filter(~F.col("head"))
    # Items that are equal when shortened count once in a set; at most so many more can be shared.
    hidden = F.least(F.col("own.n") - F.size("own.items"), F.col("n") - F.size("items"))
    linked = 9 * (F.size(F.array_intersect("own.items", "items")) + hidden) >= 4 * (F.col("own.n") + F.col("n"))
    return met.filter(linked).select(F.col("target").alias("a"), F.col("k1").alias("b")).distinct()


def _unjoined(members: DataFrame, nodes: DataFrame, links: DataFrame, block: int, most: int | None) -> DataFrame:
    """Pairs (a, b, more) that may be links, of members of one cell that ``links`` do not join yet."""
    label = components(links).withColumnRenamed("node", "k1").withColumnRenamed("component", "label")
    labelled = stored(merged(members, label, "k1", "left").select("hub", "k1", F.coalesce("label", "k1").alias("label")), "labelled")
    per_label = labelled.groupBy("hub", "label").agg(F.count("*").alias("c"))
    several = (
        per_label.groupBy("hub")
        .agg(F.sum("c").alias("cell"), F.max(F.struct("c", "label")).alias("main"), F.count("*").alias("kinds"))
        .filter("kinds > 1 and cell > 2")
        .select(
            "hub",
            F.col("main.label").alias("main"),
            F.ceil(F.col("main.c") / block).cast("int").alias("main_blocks"),
            F.ceil((F.col("cell") - F.col("main.c")) / block).cast("int").alias("other_blocks"),
        )
    )
    again = merged(merged(labelled, stored(several, "several"), "hub"), nodes.select("k1", "n", "point"), "k1")
    # The cell's largest component has blocks of its own after the others'; two of those need not meet.
    at, is_main = F.xxhash64("k1"), F.col("label") == F.col("main")
    numbered = again.withColumn(
        "mine",
        F.when(is_main, F.col("other_blocks") + F.pmod(at, F.col("main_blocks")).cast("int")).otherwise(
            F.pmod(at, F.col("other_blocks")).cast("int")
        ),
    ).withColumn("blocks", F.when(is_main, F.col("other_blocks")).otherwise(F.col("other_blocks") + F.col("main_blocks")))
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda j: F.struct(F.least(j, F.col("mine")).alias("lo"), F.greatest(j, F.col("mine")).alias("hi"),
                           F.when(j == F.col("mine"), 2).when(j > F.col("mine"), 0).otherwise(1).alias("side")),
    )
    spread = numbered.select("hub", "k1", "label", "n", "point", F.explode(pairs).alias("pair")).select(
        "hub", "pair.lo", "pair.hi", "k1", "label", "n", "point", "pair.side"
    )
    search = functools.partial(_block_search, most=most)
    return _grouped(spread, ["hub", "lo", "hi"], ["k1", "label", "side", "n", "point"], search, "a long, b long, more boolean")


def near_duplicates(docs: DataFrame, block: int = BLOCK, most: int = FREQUENT, sample: int = SAMPLE_DOCS) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs``.

    Null and empty texts have no shingles and are linked with nothing. Rows of one doc_id with different texts are
    one node. Rows without doc_id have no component (null) and link nothing. Other columns are ignored."""
    texts = texts_of(docs)
    all_rows = stored(sketches(texts, most, sample), "sketches")
    rows = all_rows.filter("doc_id is not null and n > 0")
    nodes = stored(rows.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("point").alias("point")), "nodes")

    # Cells: (hub, member) for every named shingle that different sets share.
    named = rows.select("k1", F.explode("firsts").alias("s"))
    shared = stored(named.groupBy("s").agg(F.min("k1").alias("hub"), F.max("k1").alias("top")).filter("hub < top").select("s", "hub"), "shared")
    members = stored(merged(named, shared, "s").select("hub", "k1").distinct(), "members")
    sizes = members.groupBy("hub").agg(F.count("*").alias("cell"))
    described = merged(merged(members, sizes, "hub"), nodes.select("k1", "n", "point"), "k1")
    blocks = F.ceil(F.col("cell") / block).cast("int")
    dealt = described.withColumn(
        "block",
        F.explode(
            F.when(F.col("k1") == F.col("hub"), F.sequence(F.lit(0), blocks - 1)).otherwise(
                F.array(F.pmod(F.xxhash64("k1"), blocks).cast("int"))
            )
        ),
    )
    stars = _grouped(dealt, ["hub", "block"], ["k1", "n", "point"], _hub_search, "a long, b long")
    stars = stored(stars, "stars")
    once = _once(texts, rows)
    links = stored(_verified(stars, nodes, once), "links")

    # What the stars have not joined yet: cells of several components, block against block. Two components need one
    # link only, so the likeliest pairs of any two come first, and all others in a second round if some are left.
    tested = stars
    for most in (LIKELIEST, None):
        rest = stored(_unjoined(members, nodes, links, block, most), "rest")
        pairs = stored(merged(rest.select("a", "b").distinct(), tested, ["a", "b"], "left_anti"), "untested")
        links = stored(links.union(_verified(pairs, nodes, once)), "links")
        tested = tested.union(pairs)
        if rest.filter("more").isEmpty():
            break

    # Components of doc ids: links between sets, and rows that share a doc_id.
    rep = nodes.select("k1", "rep")
    from_a = merged(links, rep.select(F.col("k1").alias("a"), F.col("rep").alias("x")), "a")
    linked = merged(from_a, rep.select(F.col("k1").alias("b"), F.col("rep").alias("y")), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    owned = stored(merged(rows.select("doc_id", "k1", "k2").distinct(), nodes.select("k1", "k2", "rep"), ["k1", "k2"]).select("doc_id", "rep"), "owned")
    several_sets = owned.groupBy("doc_id").agg(F.min("rep").alias("x"), F.max("rep").alias("y")).filter("x < y")
    joined = merged(owned, several_sets.select("doc_id", "x"), "doc_id").select(F.col("x").alias("a"), F.col("rep").alias("b"))
    found = components(linked.union(joined)).withColumnRenamed("node", "rep")
    per_doc = merged(owned.groupBy("doc_id").agg(F.min("rep").alias("rep")), found, "rep", "left").select(
        "doc_id", F.coalesce("component", "rep").alias("component")
    )
    return merged(all_rows.select("doc_id", F.col("n").alias("n_shingles")), per_doc, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each group of near duplicates (the one of smallest doc_id), with all its columns, whatever their
    names.

    Of the rows of that doc_id those of different texts stay, and of rows equal in id and text the one with the least
    hash of all columns; rows without doc_id stay, equal ones too. Null and empty texts are near no other."""
    found = near_duplicates(docs)
    id_, hash_, gone_, twins_ = unused(docs, "did", "seen", "gone", "twins")
    gone = found.filter("component_id <> doc_id").select(F.col("doc_id").alias(id_), F.lit(True).alias(gone_), F.lit(False).alias(twins_))
    did, seen = row_key(docs)
    keys = docs.filter(F.col("doc_id").isNotNull()).select(did.alias(id_), seen.alias(hash_))
    twins = keys.groupBy(id_, hash_).count().filter("count > 1").select(id_, F.lit(False).alias(gone_), F.lit(True).alias(twins_))
    marks = stored(gone.unionByName(twins).groupBy(id_).agg(F.max(gone_).alias(gone_), F.max(twins_).alias(twins_)), "marks")
    keyed = docs.withColumn(id_, F.col("doc_id").cast("long"))
    kept = merged(keyed, marks, id_, "left").filter(~F.coalesce(F.col(gone_), F.lit(False)))
    single, several = kept.filter(F.col(twins_).isNull()), kept.filter(F.col(twins_))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    one = several.groupBy(id_, F.xxhash64(F.coalesce("text", F.lit(""))).alias(hash_)).agg(
        F.min_by(F.struct(*columns), F.xxhash64(*columns)).alias(gone_)
    )
    return single.select(*columns).unionByName(one.select(*[F.col(gone_).getField(c).alias(c) for c in docs.columns]))


@register()
def op7_jaccard_rtree(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))
