import math

import numpy as np
import pytest

from slicewarden.llm import lattice_dedup as ld

SCHEMA = "vec_id long, embedding array<float>, label int, pid string, v int, iid int"


def plain(rows, threshold):
    """All pairs, in memory: (links, component) of each row."""
    unit = []
    for _, v, label in rows:
        ok = (label is not None and v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v)
              and any(x != 0 for x in v))
        unit.append(np.array(v, np.float32).astype(float) if ok else None)
    n, links, root = len(rows), [0] * len(rows), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            a, b = unit[i], unit[j]
            if a is None or b is None or rows[i][2] != rows[j][2] or len(a) != len(b):
                continue
            if a @ b / math.sqrt((a @ a) * (b @ b)) >= threshold:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    best = {}
    for i, (k, _, _) in enumerate(rows):
        if k is not None:
            best[find(i)] = min(best.get(find(i), k), k)
    return [(str(rows[i][0]), links[i], best.get(find(i))) for i in range(n)]


def around(rng, center, spread, n):
    out = center + rng.standard_normal((n, len(center))) * spread / math.sqrt(len(center))
    return out / np.linalg.norm(out, axis=1)[:, None]


def direction(rng, dim=64):
    v = rng.standard_normal(dim)
    return v / np.linalg.norm(v)


def at_cosine(rng, u, cos):
    w = direction(rng, len(u))
    w = w - (w @ u) * u
    return cos * u + math.sqrt(1 - cos * cos) * w / np.linalg.norm(w)


def run(spark, rows, **more):
    df = spark.createDataFrame([(k, v if v is None else [None if x is None else float(x) for x in v], g, "clash", 1, 2)
                                for k, v, g in rows], SCHEMA).repartition(3)
    got = ld.vector_links(df, **more).collect()
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)
    return sorted(((str(r["vec_id"]), r["n_links"], r["component_id"]) for r in got), key=str)


def test_decode_finds_the_nearest_point():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((300, 8)) * 2
    near = ld.decode(x)
    twice = np.rint(2 * near).astype(int)
    assert np.abs(2 * near - twice).max() == 0
    assert ((twice % 2 == twice[:, :1] % 2).all(1) & (near.sum(1) % 2 == 0)).all()        # points of E8
    steps = ld.roots()
    assert len(steps) == 240 and np.allclose((steps ** 2).sum(1), 2)
    others = near[:, None, :] + np.concatenate([steps, 2 * np.eye(8), -2 * np.eye(8)])[None]
    assert (((x - near) ** 2).sum(1)[:, None] <= ((x[:, None, :] - others) ** 2).sum(2) + 1e-9).all()
    assert ((x - near) ** 2).sum(1).max() <= 1 + 1e-9                                     # the covering radius


def test_groups_match_all_pairs(spark):
    """Tight groups with far members, small groups, copies and odd rows."""
    rng = np.random.default_rng(5)
    rows = [(k, direction(rng), k % 3) for k in range(150)]
    for g, (spread, n) in enumerate([(0.1, 60), (0.12, 60), (0.02, 30), (0.16, 30)]):
        rows += [(1000 + 100 * g + k, v, g % 3) for k, v in enumerate(around(rng, direction(rng), spread, n))]
    near = direction(rng)
    rows += [(2000 + k, at_cosine(rng, near, c), 1) for k, c in enumerate([0.999, 0.97, 0.96, 0.95, 0.5])]
    rows += [(2010, near, 1), (2011, near * 3, 1), (2012, near, 2), (2013, near, None), (2010, near, 1), (None, near, 1)]
    rows += [(3000, None, 1), (3001, [], 1), (3002, [0.0] * 64, 1), (3003, [math.nan, 1.0], 1), (3004, [None, 1.0], 1),
             (3005, [math.inf, 1.0], 1), (3006, [1.0, 0.0], 1), (3007, [2.0, 0.0], 1), (3008, [2.0, 0.0, 0.0], 1),
             (None, None, 1), (3009, [1e-38, 0.0], 1), (3010, [3e38, 1e-3], 1)]
    rows += [(4000 + k, rows[160][1], 0) for k in range(200)]                              # copies of one vector
    assert run(spark, rows) == sorted(plain(rows, 0.93), key=str)


def test_larger_plans_and_other_thresholds(spark):
    rng = np.random.default_rng(6)
    rows = [(k, direction(rng, 32), 1) for k in range(60)]
    rows += [(100 + k, v, 1) for k, v in enumerate(around(rng, direction(rng, 32), 0.08, 40))]
    rows += [(200 + k, at_cosine(rng, rows[3][1], 0.95), 1) for k in range(5)]
    for plan in list(ld.PLANS.values())[1:3]:
        assert run(spark, rows, plan=plan) == sorted(plain(rows, 0.93), key=str)
    assert run(spark, rows, threshold=0.85) == sorted(plain(rows, 0.85), key=str)


@pytest.mark.parametrize("cos", [0.931, 0.95])
def test_recall_at_the_threshold(spark, cos):
    rng = np.random.default_rng(7)
    rows = []
    for k in range(400):
        u = direction(rng)
        rows += [(2 * k, u, 1), (2 * k + 1, at_cosine(rng, u, cos), 1)]
    found, want = run(spark, rows), plain(rows, 0.93)
    assert sum(n for _, n, _ in found) >= 0.95 * sum(n for _, n, _ in want)
    exact = dict((k, n) for k, n, _ in want)
    assert all(n <= exact[k] for k, n, _ in found)                                         # none below it


def test_empty_and_unlinkable_tables(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None, 1), (2, [0.0], 1), (3, [1.0], None)]) == [("1", 0, 1), ("2", 0, 2), ("3", 0, 3)]


def test_tight_groups_are_not_compared_in_pairs(spark):
    rng = np.random.default_rng(8)
    rows = [(k, v, 1) for k, v in enumerate(around(rng, direction(rng), 0.05, 400))]
    df = spark.createDataFrame([(k, [float(x) for x in v], g, "", 0, 0) for k, v, g in rows], SCHEMA)
    points = ld.stored(ld.directions(df, "vec_id", "embedding", "label").selectExpr(
        "pid", "label", "v", "1L as weight", "id as first"), "points")
    members = ld.with_items(ld.with_cells(points, 0.93, ld.PLANS[10_000], 11), math.acos(0.93))
    items = members.select("iid").distinct().count()
    assert items < 40 and ld.candidates(members, 64).count() < 40 * 39 / 2
