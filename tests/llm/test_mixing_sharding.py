import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from streamtally.llm import mixing, sharding
from streamtally.session import fresh_folder

from .frames import awkward, documents, empty, text


def water(can: dict, weight, total):
    """Shares by filling one child after another."""
    out, left, open_ = {}, float(total), dict(can)
    while open_:
        rate = left / sum(weight(k) for k in open_)
        full = [k for k in open_ if open_[k] <= rate * weight(k) + 1e-9]
        if not full:
            return out | {k: rate * weight(k) for k in open_}
        for k in full:
            out[k] = float(open_.pop(k))
            left -= out[k]
    return out


def test_budgets_fill_siblings_before_ancestors(spark):
    leaves = {("even", "en", "src0"): 100, ("even", "en", "src2"): 5, ("even", "de", "src0"): 10, ("odd", "en", "src1"): 40, ("odd", "fr", "src3"): 1}
    frame = spark.createDataFrame([(*k, n) for k, n in leaves.items()], "domain string, lang string, source string, n_tokens long")
    weights = {"domain": {"even": 3.0}, "lang": {"en": 2.0}, "source": {}}
    got = {(r.domain, r.lang, r.source): r.budget for r in mixing.budgets(frame, 120, weights, 2).collect()}
    weigh = lambda level: lambda k: weights[level].get(k, 1.0)

    def below(path):
        found = defaultdict(float)
        for k, n in leaves.items():
            if k[: len(path)] == path:
                found[k[len(path)]] += 2 * n
        return found

    want = {}
    for d, budget in water(below(()), weigh("domain"), 120).items():
        for la, part in water(below((d,)), weigh("lang"), budget).items():
            for s, leaf in water(below((d, la)), weigh("source"), part).items():
                want[d, la, s] = int(leaf + 1e-9)
    assert got == want and sum(got.values()) <= 120


@pytest.mark.parametrize("share", [0.3, 1.0])
def test_each_leaf_takes_a_prefix_of_its_seeded_order(spark, share):
    rows = [(i, text(i, 3 + i % 17)) for i in range(300)] + awkward()[:4]
    got = mixing.mix(documents(spark, rows), share=share, weights={}, max_epochs=2).collect()
    leaves = defaultdict(list)
    for r in got:
        leaves[r.domain, r.lang, r.source].append(r)
    for found in leaves.values():
        size, budget = sum(r.n_tokens for r in found), found[0].budget
        epochs = budget // size if size else 0
        order = sorted(found, key=lambda r: hashlib.md5(f"{mixing.SEED}:{epochs}:{r.did}:{r.seen}".encode()).hexdigest())
        left, over = budget - epochs * size, False
        for r in order:
            left -= r.n_tokens
            over |= left < 0
            assert r.n_copies == epochs + (0 if over or budget == epochs * size else 1), r


def test_mixed_rows_keep_their_columns(spark):
    docs = documents(spark, awkward())
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns and out.count() > 0
    assert mixing.mix(empty(spark)).count() == 0 and mixing.mixed_documents(empty(spark)).count() == 0


@pytest.mark.parametrize("names", [("_did", "_seen", "_copies", "_copy"), ("did", "SEEN", "copies", "n_copies")])
def test_columns_of_any_name_pass(spark, names):
    docs = documents(spark, awkward())
    for name in names:
        docs = docs.withColumn(name, F.concat(F.lit(f"{name}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))))
    out = mixing.mixed_documents(docs)
    rows = out.collect()
    assert out.columns == docs.columns and rows
    assert all(r[n] == f"{n}:{'none' if r.doc_id is None else r.doc_id}" for r in rows for n in names)


def test_rows_without_id_stay_without(spark):
    docs = documents(spark, [(None, text(1, 30)), (None, text(1, 30)), (None, None), (4, text(2, 30))])
    folder = fresh_folder(spark, "tables")
    docs.write.parquet(f"{folder}/documents.parquet")
    got = mixing.op9_source_mixing(spark, folder).collect()
    assert {r.doc_id for r in got} == {None, 4} and len(got) == 3


def test_only_oversized_buckets_split(spark):
    rows = [(i, "x" * (i * 37 % 900)) for i in range(400)] + [(None, None), (3, "y" * 5000), (7, "z"), (7, "z")]
    limit = 3000
    got = sharding.assign(documents(spark, rows), limit).collect()
    assert len(got) == len(rows)
    size = lambda bits, hashes: [n for h, n in hashes if h.startswith(bits)]

    def key(i, t):
        did = "null" if i is None else str(i)
        head, tail = (int(hashlib.md5(x.encode()).hexdigest()[:8], 16) for x in (did, f"{did}:{t or ''}"))
        return f"{head << 31 | tail >> 1:063b}"

    hashes = [(key(i, t), len(t or "")) for i, t in rows]
    for r in got:
        held = size(r.shard, hashes)
        assert (sum(held), len(held)) == (r.shard_bytes, r.shard_rows) and len(r.shard) == r.depth
        assert r.shard_bytes <= limit or len({h for h, _ in hashes if h.startswith(r.shard)}) == 1
        # Its parent was too large, or there is none.
        assert r.depth == 0 or sum(size(r.shard[:-1], hashes)) > limit


def test_equal_rows_and_empty_table(spark):
    same = [(1, "a" * 500)] * 9 + [(1, "b" * 500)]
    got = sharding.assign(documents(spark, same), 1000).collect()
    assert sorted(r.shard_rows for r in got) == [1] + [9] * 9
    assert sharding.assign(empty(spark)).count() == 0
