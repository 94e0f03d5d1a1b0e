import itertools
import re

from streamtally.llm import filter_audit

from .frames import awkward, documents, empty, text

LABELS = "doc_id long, quality int, toxic int, text string"


def failing(t: str) -> set[str]:
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    found = {
        "A": len(words) < 50,
        "B": 100 * len(set(words)) < 65 * len(words),
        "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
        "D": re.search("[#$%&*|]", t) is not None,
    }
    return {k for k, v in found.items() if v}


def brute(rows, sources, labels):
    """Every order and step, one document after another."""
    out = {}
    texts = [(i, t or "") for i, t in rows]
    fails = []
    for i, t in texts:
        f = failing(t)
        if i is not None and any(j is not None and j < i and u == t for j, u in texts):
            f.add("E")
        fails.append(f)
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    orders = ["".join(o) for o in itertools.permutations("ABCDE")]
    for part in set(sources):
        mine = [(i, f) for (i, _), f, s in zip(texts, fails, sources, strict=True) if s == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in orders:
            left = mine
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                shapley[f] += len(gone)
                out[part, order, step] = [
                    len(left), len(gone), sum(f in d[1] for d in mine) - len(gone), sum(d[1] == {f} for d in mine),
                    sum(d[0] in good for d in gone), sum(d[0] in toxic for d in gone),
                ]
        for order in orders:
            for step, f in enumerate(order, 1):
                out[part, order, step].append(shapley[f])
    return out


def counts(frame):
    return {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley] for r in frame.collect()}


def test_equals_brute_force(spark):
    marked = ["LOUD WORDS HERE | " + text(i, 60) for i in range(3)] + ["a b " * 40, text(77, 400), "x " * 20_000]
    rows = awkward() + [(20 + i, t) for i, t in enumerate(marked)] + [(40, text(0, 40)), (41, marked[0]), (None, marked[0]), (42, "")]
    labels = [(0, 1, 0), (4, 1, 1), (4, 0, 1), (20, 1, 0), (41, 0, 1), (41, None, None), (None, 1, 1), (999, 1, 1), (25, 1, None)]
    docs = documents(spark, rows)
    kinds = filter_audit.document_kinds(docs, spark.createDataFrame([(*r, "x") for r in labels], LABELS))
    got = counts(filter_audit.interactions(kinds))
    assert len(got) == 3 * 120 * 5
    assert got == brute(rows, [f"src{(i or 0) % 3}" for i, _ in rows], labels)


def test_null_and_empty_source_are_one_part(spark):
    docs = spark.createDataFrame([(1, "a", None), (2, "a", ""), (3, None, None), (3, None, None)], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], LABELS)
    got = counts(filter_audit.interactions(filter_audit.document_kinds(docs, labels)))
    assert {k[0] for k in got} == {""} and len(got) == 600
    # The second "a" is a repeat; the two rows of document 3 repeat no smaller id.
    assert got["", "EABCD", 1][:2] == [3, 1] and got["", "AEBCD", 1][:2] == [0, 4]


def test_empty_tables(spark):
    kinds = filter_audit.document_kinds(empty(spark), spark.createDataFrame([], LABELS))
    assert filter_audit.interactions(kinds).count() == 0


def test_ranks_are_the_least_place_of_a_failing_filter():
    orders, rank = filter_audit.removal_ranks(4)
    assert len(orders) == 24
    for mask in range(16):
        for o, order in enumerate(orders):
            places = [i for i, f in enumerate(order) if mask >> f & 1]
            assert min(rank[mask, o], filter_audit.NEVER) == (places[0] if places else filter_audit.NEVER)
