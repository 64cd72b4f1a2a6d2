import numpy as np
import pytest

from ledgerline.llm import covertree

SCHEMA = "vec_id long, embedding array<float>, label int, n string, cls string, cell string"


def slow(rows, threshold=0.93):
    def usable(e, label):
        return (label is not None and e and all(v is not None and np.isfinite(v) for v in e) and any(e))
    ids = [r[0] for r in rows]
    links, reach = [set() for _ in rows], list(range(len(rows)))
    for a, (_, x, la) in enumerate(rows):
        for b, (_, y, lb) in enumerate(rows):
            if a != b and la == lb and usable(x, la) and usable(y, lb) and len(x) == len(y):
                p, q = np.array(x, np.float32).astype(float), np.array(y, np.float32).astype(float)
                if p @ q / np.sqrt(p @ p) / np.sqrt(q @ q) >= threshold:
                    links[a].add(b)
    out = []
    for a in range(len(rows)):
        seen, todo = {a}, [a]
        while todo:
            for b in links[todo.pop()] - seen:
                seen.add(b)
                todo.append(b)
        low = min((ids[k] for k in seen if ids[k] is not None), default=None)
        out.append((ids[a], len(links[a]), low, ids[a] == low))
    return sorted(out, key=str)


def cloud(seed, n, dim=8, spread=0.25):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    return [(int(k), (centres[rng.integers(12)] + rng.normal(size=dim) * spread).astype(np.float32).tolist(),
             int(rng.integers(3)) if k % 17 else None) for k in rng.permutation(n)]


def run(spark, rows, **options):
    frame = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)
    return sorted((tuple(r) for r in covertree.linked(frame, **options).collect()), key=str)


@pytest.mark.parametrize("block", [16, 4096])
def test_matches_brute_force(spark, block):
    rows = cloud(1, 350)
    rows += [(1000 + k, rows[5][1], rows[5][2]) for k in range(6)]  # copies
    assert run(spark, rows, block=block) == slow(rows)


def test_awkward_vectors(spark):
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, None, 1), (4, [], 1), (5, [0.0, 0.0], 1), (6, [1.0, None], 1),
            (7, [float("nan"), 1.0], 1), (8, [float("inf"), 1.0], 1), (9, [1.0, 0.0], None), (10, [1.0, 0.0, 0.0], 1),
            (None, [1.0, 0.0], 1), (11, [1e-30, 0.0], 1), (1, [1.0, 0.0], 1)]
    got = run(spark, rows)
    linked = {r[0]: r[1:] for r in got if r[0] in (1, 2, 11)}
    assert linked == {1: (4, 1, True), 2: (4, 1, False), 11: (4, 1, False)}
    alone = [r for r in got if r[0] not in (1, 2, 11, None)]
    assert all(r[1] == 0 and r[2] == r[0] and r[3] for r in alone) and len(alone) == 8
    assert [r for r in got if r[0] is None] == [(None, 4, 1, False)]


def test_empty_table(spark):
    assert run(spark, []) == []


def test_dual_traversal_yields_each_pair_once():
    x = covertree._unit(np.array([r[1] for r in cloud(3, 500, dim=4, spread=0.1)], float))
    want = {(i, j) for i, j in np.argwhere(x @ x.T >= 0.97).tolist() if i < j}
    tree = covertree.CoverTree(x, leaf=4)
    got = [tuple(sorted(p)) for i, j in covertree.dual_traversal(tree, tree, 0.97) for p in zip(i.tolist(), j.tolist())]
    assert len(got) == len(set(got)) and set(got) == want
    a, b = covertree.CoverTree(x[:200], leaf=4), covertree.CoverTree(x[200:], leaf=4)
    got = [(i, j + 200) for p, q in covertree.dual_traversal(a, b, 0.97) for i, j in zip(p.tolist(), q.tolist())]
    assert len(got) == len(set(got)) and set(got) == {(i, j) for i, j in want if i < 200 <= j}


def test_levels_nest_and_halve():
    x = covertree._unit(np.random.default_rng(2).normal(size=(400, 5)))
    tree = covertree.CoverTree(x, leaf=4)
    todo = [(0, tree.radius[0])]
    while todo:
        node, reach = todo.pop()
        rows, kids = tree.rows[node], tree.children[node]
        assert covertree._distance(x[rows], x[tree.centre[node]][None])[:, 0].max() <= tree.radius[node] + covertree._SLACK
        if kids is not None:
            assert sorted(np.concatenate([tree.rows[k] for k in kids])) == sorted(rows)
            assert any(tree.centre[k] == tree.centre[node] for k in kids)
            assert all(tree.radius[k] <= reach / 2 + 1e-6 for k in kids)
            todo += [(k, reach / 2) for k in kids]


def test_double_vectors_at_the_threshold(spark):
    """Pairs whose cosine is within 1e-9 of the threshold: single precision would misjudge them."""
    rng, threshold, rows, want = np.random.default_rng(5), 0.93, [], {}
    for k in range(200):
        x = rng.normal(size=6)
        x /= np.sqrt(x @ x)
        y = rng.normal(size=6)
        y -= (y @ x) * x
        y /= np.sqrt(y @ y)
        cosine = threshold + (1e-9 if k % 2 else -1e-9)
        z = cosine * x + np.sqrt(1 - cosine * cosine) * y
        rows += [(2 * k, x.tolist(), k), (2 * k + 1, z.tolist(), k)]
        want[2 * k] = want[2 * k + 1] = k % 2
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: r["n_links"] for r in covertree.linked(frame, threshold).collect()}
    assert got == want
