"""Exact searches over vectors against brute force, and on rows that invite crashes."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelforge.llm import bit_sliced, multi_index

KIND = "vec_id long, embedding array<float>, label int"


def frame(spark, rows):
    return spark.createDataFrame(rows, KIND).select("*", *(F.lit("?").alias(c) for c in ("id", "row", "dim", "vector", "score", "rank", "given")))


def odd_rows():
    """Ties, repeated rows, NULLs, other lengths, and one vector that a third share."""
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=6).astype(np.float32).round(2).tolist(), int(i % 3)) for i in range(240)]
    same = rng.normal(size=6).astype(np.float32).tolist()
    rows += [(1000 + i, same, int(i % 4)) for i in range(120)]
    rows += [(0, rows[0][1], 0), (300, rows[3][1], 1), (300, rows[3][1], 1), (None, rows[5][1], 2), (None, same, 0)]
    rows += [(2000, None, 1), (2100, [1.0, math.nan] * 3, 1), (2200, [1.0, None] * 3, 1), (2300, [math.inf] * 6, 1), (2400, [], 1)]
    rows += [(2500, [1.0, 2.0], 1), (2600, [2.0, 1.0], 0), (2550, [2.0, 2.0], 1), (2700, [3.0], 1), (2800, [0.0] * 6, 2), (2850, [0.0] * 6, None)]
    return rows


def numbers(rows, scale):
    out = []
    for i, (vec_id, v, label) in enumerate(rows):
        if v and all(x is not None and math.isfinite(x) for x in v):
            out.append((i, vec_id, [math.floor(scale * float(np.float32(x))) for x in v], label))
    return out


def dot(a, b):
    return sum(x * y for x, y in zip(a, b))


def order(hit):
    return -hit[0], hit[1] is None, hit[1] or 0, hit[2]


def plain_top(rows, k, of, scale=1024):
    out = []
    every = numbers(rows, scale)
    for i, vec_id, q, _ in every:
        if vec_id is not None and vec_id % of == 0:
            hits = [(dot(q, v), other, j) for j, other, v, _ in every if j != i and len(v) == len(q)]
            out += [(vec_id, r + 1, h[1], h[0]) for r, h in enumerate(sorted(hits, key=order)[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("segment", [64, 16_384])
def test_bit_sliced_equals_brute_force(spark, monkeypatch, segment):
    monkeypatch.setattr(bit_sliced, "SEGMENT", segment)
    rows = odd_rows()
    got = bit_sliced.top_k(frame(spark, rows), lambda i: i % 50 == 0, k=7).select("query_id", "rank", "vec_id", "score")
    assert sorted(map(tuple, got.collect()), key=str) == plain_top(rows, 7, 50)


def test_bit_sliced_of_an_empty_table(spark):
    assert bit_sliced.top_k(frame(spark, [(1, None, 1)]).limit(0), lambda i: i % 2 == 0).count() == 0
    assert bit_sliced.top_k(frame(spark, [(2, None, 1), (4, [1.0], 1)]), lambda i: i % 2 == 0).count() == 0


def test_slices_of_a_sum():
    """Sums out of bitmaps, their k-th largest, and the rows from there on."""
    rng = np.random.default_rng(1)
    values = rng.integers(-300, 300, (1000, 9))
    s = bit_sliced.Segment(values, 4)
    lead = (values - s.least) >> s.cut
    for q in rng.integers(-500, 500, (10, 9)):
        slices, raised = s.sums(q)
        bits = {at: np.unpackbits(b.view(np.uint8), bitorder="little")[:1000].astype(int) for at, b in slices.items()}
        sums = sum(b << at for at, b in bits.items())
        assert (sums - raised == lead @ q).all()
        for k in (1, 10, 400):
            limit = bit_sliced.kth_largest(slices, s.all, k)
            assert limit == np.sort(sums)[-k]
            assert (bit_sliced.rows_of(bit_sliced.at_least(slices, s.all, limit)) == np.flatnonzero(sums >= limit)).all()
        best = np.argsort(-(values @ q), kind="stable")[:10]
        found = s.candidates(q, 10)
        assert set(best) <= set(found) and len(found) < 600
    assert all(sum(sign << at for at, sign in bit_sliced.signed_digits(n)) == n for n in range(-300, 300))


def plain_negatives(rows, of, positives=5, negatives=3, scale=256):
    out = []
    every = [r for r in numbers(rows, scale) if r[3] is not None]
    for i, vec_id, q, label in every:
        if vec_id is None or vec_id % of:
            continue
        hits = sorted(((dot(q, v), other, j, lab) for j, other, v, lab in every if j != i and len(v) == len(q)), key=order)
        for p in [h for h in hits if h[3] == label][:positives]:
            window = [h for h in hits if h[3] != label and 50 * p[0] <= 100 * h[0] <= 95 * p[0]]
            out += [(vec_id, p[1], r + 1, h[1], p[0], h[0]) for r, h in enumerate(window[:negatives])]
    return sorted(out, key=str)


NAMES = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


@pytest.mark.parametrize("cell,first,block", [(512, 2048, 4096), (4, 16, 8)])
def test_multi_index_equals_brute_force(spark, monkeypatch, cell, first, block):
    for name, value in (("CELL", cell), ("FIRST", first), ("ROWS", block), ("ANCHORS", block)):
        monkeypatch.setattr(multi_index, name, value)
    rows = odd_rows()
    got = multi_index.hard_negatives(frame(spark, rows), lambda i: i % 20 == 0, sample=100).select(*NAMES)
    want = plain_negatives(rows, 20)
    assert sorted(map(tuple, got.collect()), key=str) == want and len(want) > 60


def test_multi_index_of_an_empty_table(spark):
    assert multi_index.hard_negatives(frame(spark, [(1, None, 1)]), lambda i: i % 2 == 0).count() == 0


def test_cells_come_by_descending_bound():
    rng = np.random.default_rng(3)
    for n, m in ((1, 1), (1, 7), (9, 4), (20, 20)):
        u, v = rng.normal(size=n).round(1), rng.normal(size=m).round(1)
        walk = list(multi_index.cells_in_order(u, v))
        assert len({x[:2] for x in walk}) == n * m
        assert [x[2] for x in walk] == sorted((x[2] for x in walk), reverse=True)
        rows = np.ones((n, m), int)
        found, done = multi_index.first_cells(u, v, rows, 5)
        rest = multi_index.further_cells(u, v, rows, done, -math.inf)
        assert sorted(found + rest) == list(range(n * m))


def test_bounds_hold_for_every_row():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(500, 7)) * 100
    words = tuple(multi_index.learn_words(h, 5, rng) for h in (x[:, :3], x[:, 3:]))
    index = multi_index.Index(words, (np.zeros(5), np.zeros(5)), np.ones((5, 5)))
    (i, far1), (j, far2) = index.codes(x)
    for r, code, far in zip(index.radii, (i, j), (far1, far2)):
        np.maximum.at(r, code, far)
    u, v = index.bounds(x[:20])
    assert (x[:20] @ x.T <= u[:, i] + v[:, j]).all()
