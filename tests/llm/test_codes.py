"""Vector codes against plain k-means over all rows, and the trees by themselves."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditlens.llm import codes

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error string, key string"


def plain(rows):
    """vec_id, code, error and label error by whole loops; the codebooks."""
    kept = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    if not kept:
        return [], []
    values = np.array([[math.floor(4096 * float(np.float32(x))) for x in r[1]] for r in kept], np.int64)
    width = values.shape[1]
    cuts = [i * width // 8 for i in range(9)]
    found, books = [], []
    for a, b in zip(cuts, cuts[1:]):
        part = values[:, a:b]
        book = part[:16].copy()

        def near():
            away = ((part[:, None] - book[None]) ** 2).sum(axis=2)
            return away.argmin(axis=1), away.min(axis=1)

        for _ in range(6):
            own, _ = near()
            for entry in range(len(book)):
                if (own == entry).any():
                    total, n = part[own == entry].sum(axis=0), int((own == entry).sum())
                    book[entry] = [int(t) // n for t in total]
        found.append(near())
        books.append(book)
    errors = sum(f[1] for f in found)
    by_label = {}
    for r, e in zip(kept, errors):
        by_label[r[2]] = by_label.get(r[2], 0) + int(e)
    return [
        (r[0], "".join(f"{int(f[0][i]):02x}" for f in found), int(errors[i]), by_label[r[2]]) for i, r in enumerate(kept)
    ], books


def coded(frame):
    blocks, books, width = codes.train(frame)
    rows = codes.with_label_error(codes.encode(blocks, books, width)).collect()
    return [(r["key"], "".join(f"{c:02x}" for c in r["codes"]), r["error"], r["label_error"]) for r in rows], books


def text(rows):
    return sorted(map(str, rows))


def same(frame, rows):
    ours, books = coded(frame)
    theirs, plain_books = plain(rows)
    assert text(ours) == text(theirs)
    if theirs:
        assert codes.digest(books) == codes.digest(plain_books)


def made(n, width, seed, spread=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 1, (12, width))
    values = centres[rng.integers(0, 12, n)] + rng.normal(0, spread, (n, width))
    return [(int(i), [float(x) for x in v.astype(np.float32)], int(i % 3) or None, "c", "e", "k") for i, v in enumerate(values)]


@pytest.mark.parametrize("n, width, spread", [(900, 64, 0.05), (900, 16, 1.0), (5, 64, 1.0), (300, 13, 0.3), (200, 5, 0.3)])
def test_equals_plain_k_means(spark, monkeypatch, n, width, spread):
    monkeypatch.setattr(codes, "BLOCK", 256)
    rows = made(n, width, n, spread)
    same(spark.createDataFrame(rows, SCHEMA).repartition(3), rows)


def test_odd_rows(spark):
    rows = made(60, 16, 3)
    rows += [(100, None, 1, "", "", ""), (101, [], 1, "", "", ""), (102, [1.0] * 15 + [None], 1, "", "", "")]
    rows += [(103, [1.0] * 15 + [float("nan")], 1, "", "", ""), (104, [float("inf")] * 16, 1, "", "", ""), (105, [1.0] * 8, 1, "", "", "")]
    rows += [(None, [0.5] * 16, None, "", "", ""), (7, [0.25] * 16, 2, "", "", ""), (7, [0.25] * 16, 2, "", "", "")]
    rows += [(200 + i, [0.125, -0.125] * 8, 5, "", "", "") for i in range(400)]
    same(spark.createDataFrame(rows, SCHEMA), rows)
    assert coded(spark.createDataFrame([], SCHEMA))[0] == []
    assert coded(spark.createDataFrame(rows[60:62], SCHEMA))[0] == []


def test_large_components_saturate(spark):
    rows = [(i, [1e30 * (-1) ** i, float(i)] * 8, 0, "", "", "") for i in range(40)]
    ours, _ = coded(spark.createDataFrame(rows, SCHEMA))
    assert len(ours) == 40
    numbers = codes.whole_numbers(spark.createDataFrame(rows, SCHEMA), "vec_id", "embedding", "label")
    assert {r["values"][0] for r in numbers.collect()} == {codes.MOST, -codes.MOST}


def test_tree_holds_every_point_once_and_owns_balls():
    rng = np.random.default_rng(5)
    centres = rng.integers(-8000, 8000, (6, 8))
    points = (centres[rng.integers(0, 6, 3000)] + rng.integers(-90, 90, (3000, 8))).astype(np.int32)
    points[1000:2000] = points[0]
    tree = codes.build(points)
    assert sorted(tree.order.tolist()) == list(range(3000))
    for (start, end, left, right), pivot, radius, total in zip(tree.links, tree.pivots, tree.radii, tree.sums):
        own = points[tree.order[start:end]].astype(np.int64)
        assert (own.sum(axis=0) == total).all() and np.allclose(pivot, total / len(own))
        assert np.sqrt(((own - pivot) ** 2).sum(axis=1)).max() <= radius * (1 + 1e-12)
        if left >= 0:
            assert tree.links[left][0] == start and tree.links[left][1] == tree.links[right][0] and tree.links[right][1] == end
    book = np.concatenate([centres, centres[:2], rng.integers(-8000, 8000, (4, 8))]).astype(np.int64)
    sums, counts, own, owned = codes.assign(tree, points, book)
    away = ((points[:, None].astype(np.int64) - book[None]) ** 2).sum(axis=2)
    assert (own == away.argmin(axis=1)).all() and counts.sum() == 3000 and owned >= 6
    for k in range(len(book)):
        assert (sums[k] == points[own == k].astype(np.int64).sum(axis=0)).all()


def test_ties_go_to_the_lower_entry():
    points = np.array([[0, 0], [2, 0], [1, 5]] * 50, np.int32)
    book = np.array([[2, 0], [0, 0], [0, 0], [1, 4], [1, 6]], np.int64)
    own = codes.assign(codes.build(points), points, book)[2]
    assert own[:3].tolist() == [1, 0, 3]
