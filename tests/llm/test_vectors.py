import numpy as np
import pytest

from streamtally.llm import ann, ball_tree
from streamtally.llm.vectors import usable

SCHEMA = "vec_id long, embedding array<float>, label int, score double, rank int, v string"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, 0.0, 1, "x") for i, v in rows], SCHEMA)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(8, 12))
    data = (centres[rng.integers(0, 8, 700)] + 0.3 * rng.normal(size=(700, 12))).astype(np.float32)
    data[300:420] = data[300]  # one very common vector
    out = [(i, data[i].tolist()) for i in range(700)]
    out += [(700, None), (701, []), (702, [float("nan")] * 12), (703, [float("inf")] + [0.0] * 11), (704, [None] + [1.0] * 11)]
    return [*out, (705, [0.0] * 12), (10, data[10].tolist()), (None, data[5].tolist())]


def parts(rows):
    good = {i: np.array(v, np.float32).astype(np.float64) for i, v in rows if i is not None and i < 700 or i == 705}
    ids = np.array(sorted(good))
    return ids, np.stack([good[i] for i in ids])


def test_exact_products(spark, rows):
    vectors = ball_tree.scaled(frame(spark, rows))
    got = ball_tree.top_k(vectors, vectors.filter("vec_id % 50 = 0"), 5, shard_rows=150, query_rows=4)
    ids, data = parts(rows)
    data = np.floor(256 * data)
    want = []
    for q in np.flatnonzero(ids % 50 == 0):
        score = data @ data[q]
        order = [j for j in np.lexsort((ids, -score)) if j != q][:5]
        want += [(int(ids[q]), r + 1, int(ids[j]), int(score[j])) for r, j in enumerate(order)]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_bounds_hold():
    rng = np.random.default_rng(5)
    points, queries = rng.integers(-99, 99, (1000, 7)).astype(float), rng.integers(-99, 99, (20, 7)).astype(float)
    tree = ball_tree.BallTree(points)
    bound = tree.bounds(queries)
    for at, node in enumerate(tree.leaves):
        lo, hi = tree.spans[node]
        assert (queries @ points[tree.order[lo:hi]].T <= bound[:, at, None]).all()
    assert sorted(tree.order.tolist()) == list(range(1000))


def test_neighbours_and_recall(spark, rows):
    vectors = usable(frame(spark, rows), zero=False)
    got = ann.nearest(vectors, vectors.filter("vec_id % 20 = 0"), 10, list_rows=40, part_rows=32).collect()
    ids, data = parts(rows)
    ids, data = ids[:-1], data[:-1]  # the zero vector takes no part
    hits = total = 0
    for q in np.flatnonzero(ids % 20 == 0):
        far = np.sqrt(((data - data[q]) ** 2).sum(axis=1))
        order = [j for j in np.lexsort((ids, far)) if j != q][:10]
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == ids[q])
        assert [r[0] for r in mine] == list(range(1, 11)) and len({r[1] for r in mine}) == 10
        assert [r[2] for r in mine] == pytest.approx([far[ids == r[1]][0] for r in mine])
        assert [(r[2], r[1]) for r in mine] == sorted((r[2], r[1]) for r in mine)
        hits, total = hits + len({r[1] for r in mine} & {int(ids[j]) for j in order}), total + 10
    assert hits / total >= 0.9


def test_the_ratio_alone_decides_which_lists_are_searched():
    rng = np.random.default_rng(6)
    apart = 50 * rng.normal(size=(40, 6))
    for centres in (rng.normal(size=(600, 6)), (apart[:, None] + rng.normal(size=(40, 15, 6))).reshape(-1, 6), rng.normal(size=(3, 6))):
        graph = ann.Graph(centres)
        for query in [*rng.normal(size=(10, 6)), *(apart[:10] + rng.normal(size=(10, 6)))]:
            exact = np.sqrt(((centres - query) ** 2).sum(axis=1))
            for ratio in (1.0, 1.3, 3.0):
                ids, far = graph.walk(query, ratio)
                assert sorted(ids.tolist()) == np.flatnonzero(exact <= ratio * exact.min() + 1e-12).tolist()
                assert far == pytest.approx(np.sort(exact)[: len(far)])


def test_whole_recall_with_several_hundred_lists(spark):
    rng = np.random.default_rng(7)
    data = rng.normal(size=(3000, 24)).astype(np.float32)
    vectors = usable(frame(spark, [(i, v.tolist()) for i, v in enumerate(data)]), zero=False)
    got = ann.nearest(vectors, vectors.filter("vec_id % 100 = 0"), 10, search_ratio=2.0, list_rows=10).collect()
    data, found = data.astype(np.float64), {(r.query_id, r.vec_id) for r in got}
    for q in range(0, 3000, 100):
        far = ((data - data[q]) ** 2).sum(axis=1)
        far[q] = np.inf
        assert {(q, int(j)) for j in np.argsort(far)[:10]} <= found


def test_few_or_no_vectors(spark):
    few = frame(spark, [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0, 1.0])])
    scaled = ball_tree.scaled(few)
    assert sorted(map(tuple, ball_tree.top_k(scaled, scaled.filter("vec_id = 0")).collect())) == [(0, 1, 1, 0)]
    near = ann.nearest(usable(few), usable(few).filter("vec_id = 0"))
    assert [(r.query_id, r.rank, r.vec_id) for r in near.collect()] == [(0, 1, 1)]
    none = ball_tree.scaled(frame(spark, [(1, None)]))
    assert ball_tree.top_k(none, none).count() == 0 and ann.nearest(none, none).count() == 0
