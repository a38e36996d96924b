import hashlib
import math

import numpy as np
import pytest
from cases import no_rows, saved

from riskweave.llm import vector_codes as v

VECTORS = "vec_id long, embedding array<double>, label int"


def plain_codes(rows, parts=16, entries=64, rounds=2):
    """The contract read line by line, in whole numbers."""
    kept = [(i, [math.floor(256 * x) for x in e], label) for i, e, label in rows if e is not None and all(x is not None and math.isfinite(x) for x in e)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // parts
    cut = lambda x: [tuple(x[p * width : (p + 1) * width]) for p in range(parts)]
    books = [[cut(x)[p] for _, x, _ in kept[:entries]] for p in range(parts)]
    near = lambda p, y: min((sum((a - b) ** 2 for a, b in zip(y, e)), k) for k, e in enumerate(books[p]))
    for _ in range(rounds):
        members = [[[] for _ in books[p]] for p in range(parts)]
        for _, x, _ in kept:
            for p, y in enumerate(cut(x)):
                members[p][near(p, y)[1]].append(y)
        books = [
            [tuple(sum(c) // len(m) for c in zip(*m)) if m else e for e, m in zip(books[p], members[p])] for p in range(parts)
        ]
    found = []
    for i, x, label in kept:
        best = [near(p, y) for p, y in enumerate(cut(x))]
        found.append((i, "".join(f"{k:02x}" for _, k in best), sum(d for d, _ in best), label))
    digest = hashlib.sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()
    errors = {}
    for _, _, e, label in found:
        errors[label] = errors.get(label, 0) + e
    return sorted(((i, code, e, errors[label], digest) for i, code, e, label in found), key=repr)


def codes(spark, rows, **options):
    table = saved(spark.createDataFrame(rows, VECTORS).selectExpr("*", "1 AS code", "'x' AS x", "2 AS _n"))
    return sorted((tuple(r) for r in v.code_table(table, **options).collect()), key=repr)


def some_vectors(n, seed=1, width=2):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 0.5, (7, 16 * width))
    return [(i, [float(x) for x in centres[i % 7] + rng.normal(0, 0.1, 16 * width)], (i % 3) or None) for i in range(n)]


def test_codes_equal_the_plain_version(spark):
    rows = some_vectors(300)
    rows += [(1000, None, 1), (1001, [0.5] * 31 + [None], 1), (1002, [0.5] * 31 + [float("nan")], 1), (1003, [float("-inf")] + [0.1] * 31, 2)]
    rows += [(2000 + i, [0.25] * 32, None) for i in range(40)] + [(5, rows[5][1], 2), (None, rows[6][1], 0), (3000, [-0.001] * 32, 9)]
    assert codes(spark, rows) == plain_codes(rows)


@pytest.mark.parametrize("n", [1, 5])
def test_fewer_vectors_than_entries(spark, n):
    rows = some_vectors(n)
    assert codes(spark, rows) == plain_codes(rows)


def test_no_vectors(spark):
    assert v.code_table(no_rows(spark, VECTORS)).collect() == []
    assert codes(spark, [(1, None, 1)]) == []


def test_vectors_that_cannot_be_cut_keep_their_row(spark):
    rows = some_vectors(100)
    odd = [(500, [0.1] * 33, 1), (501, [0.1] * 16, 1), (502, [1e300] + [0.1] * 31, 1)]
    got = codes(spark, rows + odd)
    assert [r for r in got if r[0] < 500] == plain_codes(rows)
    assert [r[:3] for r in got if r[0] >= 500] == [(i, None, None) for i in (500, 501, 502)]


def test_bounds_save_measurements_and_change_nothing():
    rng = np.random.default_rng(3)
    centres = rng.integers(-4000, 4000, (64, 4, 4))
    x = centres[rng.integers(0, 64, 3000)] + rng.integers(-60, 60, (3000, 4, 4))
    book = centres.transpose(1, 0, 2).copy()
    history = [book, book + rng.integers(-9, 9, book.shape)]
    history.append(book + rng.integers(-9, 9, book.shape))
    marks = v.no_marks(len(x), 4, 4)
    for t in range(3):
        marks, distance, measured = v.nearest(x, history[: t + 1], marks)
        for p in range(4):
            d = ((x[:, p, None] - history[t][p][None]) ** 2).sum(-1)
            assert (marks.code[:, p] == d.argmin(1)).all() and (distance[:, p] == d.min(1)).all()
    assert measured.mean() < 0.1 * 4 * 64  # a full pass measures 256 entries a vector


def test_net_displacement_is_no_more_than_the_steps_added_up():
    rng = np.random.default_rng(4)
    history = [rng.integers(-50, 50, (1, 32, 4)) for _ in range(4)]
    steps = sum(np.array([np.sqrt(((b - a)[0] ** 2).sum(1))[g : g + v.GROUP].max() for g in (0, 16)]) for a, b in zip(history, history[1:]))
    assert (v.displacement(history, 0)[0] <= steps + 1e-9).all() and (v.displacement(history, 0)[-1] == 0).all()
