import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from streamtally.llm import components, jaccard, mixing
from streamtally.session import stored

from .frames import awkward, documents, empty, text


def brute(rows):
    """Components by comparing every pair; rows without doc_id have none."""
    sets = []
    for _, t in rows:
        words = re.findall("[^\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        grams = {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())
        sets.append(grams)
    parent = {i: i for i, _ in rows if i is not None}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x, (a, _) in enumerate(rows):
        for y, (b, _) in enumerate(rows[:x]):
            if a is None or b is None or not sets[x] or not sets[y]:
                continue
            both = len(sets[x] & sets[y])
            if 100 * both >= 80 * (len(sets[x]) + len(sets[y]) - both):
                a_, b_ = root(a), root(b)
                parent[max(a_, b_)] = min(a_, b_)
    return sorted(((i, len(s), None if i is None else root(i)) for (i, _), s in zip(rows, sets, strict=True)), key=repr)


def got(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def variants(seed, n, copies):
    words = text(seed, n).split()
    out = []
    for c in range(copies):
        mine = list(words)
        for k in range(c % 4):
            mine[(c * 37 + k * 11) % n] = f"edit{c}x{k}"
        out.append(" ".join(mine))
    return out


def test_awkward_rows(spark):
    rows = awkward()
    assert got(jaccard.near_duplicates(documents(spark, rows))) == brute(rows)


def test_groups_of_near_copies_and_a_shared_passage(spark):
    rows, passage = [], text(99, 30)
    for seed in range(6):
        rows += [(100 * seed + i, t) for i, t in enumerate(variants(seed, 60 + 25 * seed, 14))]
    rows += [(1000 + i, passage + " " + text(500 + i, 9 + i % 5)) for i in range(40)]
    # Small blocks, so that cells are cut and searched block against block.
    assert got(jaccard.near_duplicates(documents(spark, rows), block=4)) == brute(rows)


def test_rows_that_share_an_id_are_one_node(spark):
    a, b = text(1, 50), text(2, 50)
    rows = [(5, a), (5, b), (2, a), (9, b)]
    assert {r.component_id for r in jaccard.near_duplicates(documents(spark, rows)).collect()} == {2}


def test_one_of_each_group_stays(spark):
    rows = awkward()
    kept = jaccard.keep_one(documents(spark, rows))
    assert kept.columns == documents(spark, rows).columns
    ids = sorted((r.doc_id for r in kept.collect()), key=repr)
    assert ids == sorted([0, 1, 2, 3, 5, 7, 9, 10, 11, None], key=repr)


def test_empty_table(spark):
    assert jaccard.near_duplicates(empty(spark)).count() == 0
    assert jaccard.keep_one(empty(spark)).count() == 0


def test_tree_loses_no_pair_that_the_bound_allows():
    rng = np.random.default_rng(0)
    points = rng.poisson(2.0, (300, jaccard.GROUPS))
    points[150:] = points[:150] + (rng.random((150, jaccard.GROUPS)) < 0.02)
    sizes = points.sum(axis=1)
    q, x, _ = jaccard.RTree(points, sizes).search(points, sizes)
    shared = np.minimum(points[:, None, :], points[None, :, :]).sum(axis=2)
    want = {(a, b) for a, b in zip(*np.nonzero(9 * shared >= 4 * (sizes[:, None] + sizes[None, :])), strict=True)}
    assert want <= set(zip(q.tolist(), x.tolist(), strict=True))


def test_partners_in_blocks_and_lists_of_bounded_length(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "PARTNERS", 3)
    rows = [(100 * seed + i, t) for seed in range(3) for i, t in enumerate(variants(seed, 80, 20))]
    rows += [(7, rows[0][1]), (7, rows[0][1]), (500, text(5, 20_000)), (501, text(5, 19_000))]
    assert got(jaccard.near_duplicates(documents(spark, rows), block=4)) == brute(rows)


def test_short_items_rule_out_far_pairs_of_long_sets(spark):
    long = text(5, 9000)
    near = long + " and some more words"
    far = long[: len(long) // 2] + text(6, 4500)
    texts = jaccard.texts_of(documents(spark, {1: long, 2: near, 3: far, 4: text(8, 30), 5: text(8, 30) + " end"}))
    nodes = jaccard.sketches(texts).select("k1", F.col("doc_id").alias("rep")).cache()
    key = {r.rep: r.k1 for r in nodes.collect()}
    pairs = spark.createDataFrame([(key[a], key[b]) for a, b in [(1, 2), (1, 3), (2, 3), (4, 5), (4, 1)]], "a long, b long")
    for short in (True, False):
        found = {(r.a, r.b) for r in jaccard._compared(pairs, nodes, texts, short).collect()}
        assert found == {(key[1], key[2]), (key[4], key[5])}


@pytest.mark.parametrize("names", [("_gone", "_did", "_twins"), ("did", "Gone", "seen", "twins")])
def test_survivors_are_defined_and_columns_of_any_name_pass(spark, names):
    a, b = text(1, 50), text(2, 50)
    # Document 5 stands on two different texts and, of one of them, on three rows; 9 is a copy of one of its texts.
    rows = [(5, a), (5, a), (5, a), (5, b), (9, b), (None, a), (None, a), (6, None), (6, None), (8, text(3, 40))]
    docs = documents(spark, rows).withColumn("n_chars", F.monotonically_increasing_id())
    for name in names:
        docs = docs.withColumn(name, F.concat(F.lit(f"{name}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))))
    docs = spark.createDataFrame(docs.collect(), docs.schema)
    out = [jaccard.keep_one(d) for d in (docs, docs.orderBy(F.desc("n_chars")).repartition(3))]
    first, second = (sorted(map(tuple, o.collect()), key=repr) for o in out)
    assert out[0].columns == docs.columns and first == second
    assert sorted(((r.doc_id, r.text) for r in out[0].collect()), key=repr) == sorted(
        [(5, a), (5, b), (None, a), (None, a), (6, None), (8, rows[-1][1])], key=repr
    )
    assert all(r[n] == f"{n}:{'none' if r.doc_id is None else r.doc_id}" for r in out[0].collect() for n in names)


def test_no_join_gathers_a_table_in_the_driver(spark, monkeypatch):
    """Broadcast joins make tables of some megabytes in the driver however few their rows; 65 of them in this stage
    brought the pipeline's driver near its limit. Only the bounded destinations of sets are broadcast."""
    plans = []

    def seen(rows, label="stored"):
        plans.append((label, rows._jdf.queryExecution().executedPlan().toString().count("BroadcastExchange")))
        return stored(rows, label)

    for module in (components, jaccard):
        monkeypatch.setattr(module, "stored", seen)
    rows = [(10 * g + i, t) for g in range(3) for i, t in enumerate(variants(g, 60, 4))]
    found = jaccard.near_duplicates(documents(spark, rows))
    assert got(found) == brute(rows)
    plans.append(("result", found._jdf.queryExecution().executedPlan().toString().count("BroadcastExchange")))
    assert {"members", "stars", "wanted", "edges", "labels", "rest", "owned", "result"} <= {label for label, _ in plans}
    assert [p for p in plans if p[1] > (p[0] in ("possible", "links"))] == []
    leaves = spark.createDataFrame([("even", "en", "src0", 100), ("odd", "fr", "src3", 1)], "domain string, lang string, source string, n_tokens long")
    assert "BroadcastExchange" not in mixing.budgets(leaves, 80)._jdf.queryExecution().executedPlan().toString()
