import math
import random
from collections import defaultdict

import numpy as np
import pytest

from seclake.llm import covertree


def brute(rows, least=0.93):
    """(id, links, component, kept) of rows (id, vector, label), in order."""
    n = len(rows)
    links, near = [0] * n, defaultdict(list)
    good = [v is not None and label is not None and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v, label in rows]
    for a in range(n):
        for b in range(a):
            if good[a] and good[b] and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.array(rows[a][1], dtype=float), np.array(rows[b][1], dtype=float)
                if x @ y / math.sqrt(x @ x) / math.sqrt(y @ y) >= least:
                    links[a] += 1
                    links[b] += 1
                    near[a].append(b)
                    near[b].append(a)
    out, done = [None] * n, set()
    for a in range(n):
        if a not in done:
            group, todo = {a}, [a]
            while todo:
                for b in near[todo.pop()]:
                    if b not in group:
                        group.add(b)
                        todo.append(b)
            done |= group
            least_id = min((rows[b][0] for b in group if rows[b][0] is not None), default=None)
            for b in group:
                out[b] = (rows[b][0], links[b], least_id, rows[b][0] == least_id)
    return sorted(out, key=repr)


def vectors(seed, n, d=16):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(8, d))
    out = [(centres[k % 8] + draw.normal(size=d) * draw.choice([0.02, 0.15, 0.3, 2.0])).astype(np.float32).tolist() for k in range(n)]
    return [(int(i), v, random.Random(i).choice([1, 1, 1, 2, None])) for i, v in enumerate(out)]


def run(spark, rows):
    df = spark.createDataFrame([(i, v, label, 0, "x") for i, v, label in rows], "vec_id long, embedding array<float>, label int, n_links int, point string")
    got = covertree.near_duplicates(df)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    return sorted(map(tuple, got.collect()), key=repr)


@pytest.mark.parametrize("sizes", [(50, 60, 1024), (50, 60, 3), (40, 10_000, 16)])
def test_equals_brute_force(spark, monkeypatch, sizes):
    """Labels cut into cells; few pivots; and no cells but several tasks."""
    for name, n in zip(("TASK_POINTS", "CELL_POINTS", "MAX_PIVOTS"), sizes):
        monkeypatch.setattr(covertree, name, n)
    rows = vectors(sum(sizes), 500)
    rows += [(600 + i, rows[0][1], rows[0][2]) for i in range(120)] + [(700 + i, [2 * x for x in rows[1][1]], 1) for i in range(50)]
    assert run(spark, rows) == brute(rows)


def test_odd_rows(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(5, v, 1), (5, v, 1), (None, v, 1), (3, [2.0, 4.0, 6.0], 1), (4, v, None), (6, None, 1), (7, [0.0, 0.0, 0.0], 1), (8, [0.0, 0.0, 0.0], 1), (9, [float("nan"), 1.0, 1.0], 1),
            (10, [None, 1.0, 1.0], 1), (11, [], 1), (12, [float("inf"), 1.0, 1.0], 1), (13, [1.0, 2.0], 1), (None, None, None), (14, [1e38, 2e38, 3e38], 1), (15, [1e-40, 2e-40, 3e-40], 1), (16, v, 2)]
    got = run(spark, rows)
    want = brute([r for r in rows if r[0] not in (14, 15)] )
    assert {r for r in got if r[0] in (14, 15)} == {(14, 5, 3, False), (15, 5, 3, False)}
    assert sorted((r[0], r[2], r[3]) for r in got if r[0] not in (14, 15, None)) == sorted((r[0], r[2], r[3]) for r in want if r[0] is not None)
    assert run(spark, []) == []


@pytest.mark.parametrize("n", [1, 2, 33, 400])
def test_tree_covers(n):
    draw = np.random.default_rng(n)
    points = draw.normal(size=(n, 6))
    points[n // 2:] = points[0] + 0.01 * draw.normal(size=(n - n // 2, 6))
    points /= np.linalg.norm(points, axis=1)[:, None]
    tree = covertree.CoverTree(points)
    assert sorted(tree.order) == list(range(n))
    for k in range(len(tree.centre)):
        inside = tree.order[tree.first[k]:tree.end[k]]
        assert tree.centre[k] in inside
        assert np.linalg.norm(points[inside] - points[tree.centre[k]], axis=1).max() <= tree.radius[k] + 1e-7
        assert not tree.children[k] or sorted(tree.order[tree.first[k]:tree.end[k]]) == sorted(x for c in tree.children[k] for x in tree.order[tree.first[c]:tree.end[c]])
        assert not tree.children[k] or tree.centre[k] in [tree.centre[c] for c in tree.children[k]]  # nested
