"""The graph index against brute force: recall, exact scores, ties, odd rows."""

import numpy as np
import pytest

from ledgerleaf.llm import graph_index

SCHEMA = "vec_id long, embedding array<double>, number int, shard string, ids string"


def table(spark, rows, kind="double"):
    schema = SCHEMA.replace("double", kind)
    return spark.createDataFrame([(i, v, 1, "s", "i") for i, v in rows], schema).repartition(3)


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)


def brute(rows, every, k=5):
    """(query_id, rank, vec_id, score) over all rows but the query's own."""
    good = [(i, np.array(v, dtype=float)) for i, v in rows if usable(v)]
    out = []
    for at, (own, q) in enumerate(good):
        if own is None or own % every:
            continue
        q1 = q / np.abs(q).max()
        scored = []
        for other, (i, v) in enumerate(good):
            if other != at and len(v) == len(q):
                v1 = v / np.abs(v).max()
                scored.append((-float(q1 @ v1 / (np.linalg.norm(q1) * np.linalg.norm(v1))), i))
        scored.sort(key=lambda x: (round(x[0], 12), x[1] is None, x[1]))
        out += [(own, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)]
    return out


def clustered(n, d=24, seed=1):
    """A third of all rows near one point, some groups, and the rest anywhere."""
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=d)
    x = rng.normal(size=(n, d))
    x[: n // 3] = centre + 0.05 * rng.normal(size=(n // 3, d))
    for c in range(10):
        x[n // 3 + 20 * c : n // 3 + 20 * c + 20] = rng.normal(size=d) + 0.2 * rng.normal(size=(20, d))
    return x[rng.permutation(n)]


@pytest.mark.parametrize("shards", [1, 5])
def test_recall(spark, shards):
    x = clustered(3000)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    vectors = table(spark, rows)
    index = graph_index.build_index(vectors, rows_per_shard=3000 // shards)
    assert index.count() == shards and index.selectExpr("sum(size(ids)) n").first().n == 3000
    got = graph_index.search(index, vectors.filter("vec_id % 20 = 0"), queries_per_block=64).collect()
    want = brute(rows, 20)
    assert len(got) == len(want) == 750
    true = {(q, i): s for q, _, i, s in want}
    hits = [r for r in got if (r.query_id, r.vec_id) in true]
    assert len(hits) / len(want) >= 0.95
    assert all(abs(r.score - true[r.query_id, r.vec_id]) < 1e-12 for r in hits)


def test_small_tables_are_exact(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(60, 8))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(100 + i, rows[7][1]) for i in range(12)] + [(200, (2 * x[7]).tolist())]  # more copies than are kept, and a longer one
    rows += [(300, None), (310, []), (320, [0.0] * 8), (330, [float("nan")] * 8), (340, [float("inf")] + [1.0] * 7), (350, [None] + [1.0] * 7)]
    rows += [(None, x[3].tolist()), (None, x[9].tolist()), (10, x[10].tolist()), (10, x[11].tolist())]  # null and repeated ids
    rows += [(400, [1.0, 2.0]), (410, [2.0, 1.0]), (500, [3.0]), (600, [1e200] * 3), (610, [1e200, 1e199, 0.0])]  # other widths, great numbers
    for rows_per_shard in (1000, 15):
        vectors = table(spark, rows)
        index = graph_index.build_index(vectors, rows_per_shard=rows_per_shard)
        got = graph_index.search(index, vectors.filter("vec_id % 10 = 0")).collect()
        want = brute(rows, 10)
        order = lambda found: sorted((q, r, -1 if i is None else i, round(s, 10)) for q, r, i, s in found)
        assert order(map(tuple, got)) == order(want)


def test_equal_vectors(spark):
    rows = [(i, [1.0, 2.0]) for i in range(1, 400)] + [(1000, [2.0, 1.0])]
    got = graph_index.neighbours(table(spark, rows, "float"), every=50).collect()
    by = {q: [r.vec_id for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == q] for q in (50, 350, 1000)}
    assert by == {50: [1, 2, 3, 4, 5], 350: [1, 2, 3, 4, 5], 1000: [1, 2, 3, 4, 5]}


def test_nothing(spark):
    assert graph_index.neighbours(table(spark, []), every=50).count() == 0
    assert graph_index.neighbours(table(spark, [(50, [1.0])]), every=50).count() == 0
    assert graph_index.neighbours(table(spark, [(51, [1.0]), (52, [2.0])]), every=50).count() == 0


def test_graphs_hold_every_node():
    x = graph_index.directions(clustered(1500))
    layers = graph_index.build(x)
    nodes, links = layers[-1]
    assert sorted(nodes.tolist()) == list(range(1500)) and links.shape == (1500, 2 * graph_index.LINKS)
    assert all(len(a) < len(b) for (a, _), (b, _) in zip(layers, layers[1:]))
    assert all(np.array_equal(nodes[: len(a)], a) and n.max() < len(a) for a, n in layers)
