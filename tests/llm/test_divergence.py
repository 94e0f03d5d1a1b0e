import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from streamtally.llm import divergence

from .frames import awkward, documents, empty, text

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
SCHEMA = "doc_id long, text string, lang string, source string, p long, rank string, item int"


def brute(rows, min_docs=3, top=200):
    """Every term of every group, every pair of sources, as the definitions say."""
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    docs = defaultdict(Counter)
    counts = defaultdict(Counter)
    for text_, lang, source in rows:
        terms = TERM.findall((text_ or "").translate(lower))
        counts[lang or "", source or ""].update(terms)
        docs[lang or ""].update(set(terms))
    out = set()
    for lang in docs:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        groups = {s: c for (la, s), c in counts.items() if la == lang}
        whole = sum(groups.values(), Counter())

        def shares(c, kept=kept):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 1) // (total + len(kept)) for t in kept}

        p, q = {s: shares(c) for s, c in groups.items()}, shares(whole)
        f = lambda a, b: (a - b) ** 2 // b
        for s in groups:
            pairs = [(-sum(f(p[s][t], p[o][t]) for t in kept), o) for o in groups if o != s]
            terms = [(-f(p[s][t], q[t]), t) for t in kept if groups[s][t] and p[s][t] > q[t]]
            for part, found, limit in (("pair", pairs, None), ("term", terms, top)):
                order = sorted(found, key=lambda x: (x[0], x[1].encode()))[:limit]
                out |= {(lang, s, part, item, -v, i + 1) for i, (v, item) in enumerate(order)}
    return out


def rows_of(frame):
    return {(r.lang, r["source"], r.part, r["item"], r.value, r["rank"]) for r in frame.collect()}


def corpus(seed, n):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in ("be", "Ko", "éÉ", "zu-x", "日本") for b in ("la", "MI", "ß", "t_r", "o'o", "ux")]
    weights = [1 / (i + 1) for i in range(len(words))]
    return [
        (" ".join(rng.choices(words, weights, k=rng.randrange(0, 60))), rng.choice(["en", "de", None, "", "xx"][: 1 + seed % 5]),
         "s0" if rng.random() < 0.4 else f"s{rng.randrange(6)}")
        for _ in range(n)
    ]


@pytest.mark.parametrize(("seed", "top"), [(0, 200), (3, 7), (4, 3)])
def test_equals_brute_force(spark, seed, top):
    rows = [*corpus(seed, 150), ("alone Only here", "fr", "s9"), (None, "fr", None), ("", None, "s1")]
    frame = spark.createDataFrame([(i, t, la, s, 1, "x", 2) for i, (t, la, s) in enumerate(rows)], SCHEMA)
    got = divergence.audit(frame.repartition(5), top=top)
    assert rows_of(got) == brute(rows, top=top) and dict(got.dtypes)["value"] == "bigint"


def test_awkward_rows(spark):
    rows = awkward() + [(50, text(5, 20_000)), (51, "a\x00b\x7fc \x80\x85 é"), (52, "a b c é"), (53, "C B A")]
    docs = documents(spark, rows)
    have = [(r.text, r.lang, r["source"]) for r in docs.collect()]
    assert rows_of(divergence.audit(docs)) == brute(have)


def test_groups_without_terms_and_empty_table(spark):
    rows = [("solo", "en", "a"), (None, "en", "b"), ("!?", "de", "c")]
    got = divergence.audit(spark.createDataFrame([(i, *r, 1, "x", 2) for i, r in enumerate(rows)], SCHEMA))
    assert rows_of(got) == {("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)} == brute(rows)
    assert divergence.audit(empty(spark)).count() == 0


def test_tasks_pass_on_what_they_cannot_hold(spark, monkeypatch):
    rows = corpus(4, 120)
    frame = spark.createDataFrame([(i, *r, 1, "x", 2) for i, r in enumerate(rows)], SCHEMA).coalesce(1)
    monkeypatch.setattr(divergence, "HELD_ENTRIES", 20)
    monkeypatch.setattr(divergence, "PAIR_ROWS", 50)
    assert rows_of(divergence.audit(frame)) == brute(rows)


@pytest.mark.parametrize("k", [1, 3, 20])
def test_skyband_is_what_fewer_than_k_dominate(spark, k):
    rng = random.Random(k)
    points = [("en", f"s{i % 2}", f"t{i:05d}", rng.randrange(12), rng.randrange(12)) for i in rng.sample(range(90_000), 1500)]
    frame = spark.createDataFrame(points, "lang string, source string, term string, n long, lang_n long").coalesce(1)
    got = {r.term for r in divergence.skyband(frame, k).collect()}
    want = set()
    for group in ("s0", "s1"):
        mine = sorted(p for p in points if p[1] == group)
        n, lang_n = (np.array([p[i] for p in mine]) for i in (3, 4))
        for i, p in enumerate(mine):
            if ((n[:i] >= n[i]) & (lang_n[:i] <= lang_n[i])).sum() < k:
                want.add(p[2])
    assert got == want


def test_large_counts_stay_exact(spark):
    big = 3_000_000_000_000
    kept = spark.createDataFrame(
        [("en", "a", "x", big, big + 7, True), ("en", "b", "x", 7, big + 7, False), ("en", "b", "y", 5 * big, 5 * big, True)],
        "lang string, source string, term string, n long, lang_n long, first boolean",
    )
    docs = spark.createDataFrame([("en", "a", ""), ("en", "b", "")], "lang string, source string, text string")
    groups = divergence.group_totals(docs, kept)
    got = {(r["source"], r.term): (r.p, r.q) for r in divergence.measured(kept, groups).collect()}
    share = lambda c, n: 1 + 10**9 * (c + 1) // (n + 2)
    total = 6 * big + 7
    assert got == {
        ("a", "x"): (share(big, big), share(big + 7, total)),
        ("b", "x"): (share(7, 5 * big + 7), share(big + 7, total)),
        ("b", "y"): (share(5 * big, 5 * big + 7), share(5 * big, total)),
    }
