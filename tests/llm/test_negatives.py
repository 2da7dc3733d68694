"""Operator 12 against brute force, and its edge cases."""

import math

import numpy as np
import pytest

from arenaspark.llm import negatives

SCHEMA = "vec_id bigint, embedding array<float>, label int, rid string, low int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, lab, "x", 1) for i, v, lab in rows], SCHEMA)


def brute(rows, every=50, positives=5, negatives=3):
    use = [(i, [math.floor(256 * float(np.float32(x))) for x in v], lab) for i, v, lab in rows
           if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (i, v, lab) in enumerate(use):
        if i % every:
            continue
        scored = sorted(((-sum(a * b for a, b in zip(v, w)), j, other) for m, (j, w, other) in enumerate(use) if m != n),
                        key=lambda z: z[:2])
        for s, j, _ in [z for z in scored if z[2] == lab][:positives]:
            fits = [(t, k) for t, k, other in scored if other != lab and 50 * -s <= 100 * -t <= 95 * -s]
            out += [(i, j, r + 1, k, -s, -t) for r, (t, k) in enumerate(fits[:negatives])]
    return sorted(out)


def vectors(seed, n=600, dims=12, labels=3):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(labels, dims)) * 0.4
    lab = rng.integers(0, labels, n)
    v = (rng.normal(size=(n, dims)) * 0.5 + centre[lab]).astype(np.float32)
    return [(int(i), [float(x) for x in row], int(y)) for i, row, y in zip(range(n), v, lab)]


@pytest.mark.parametrize("small", [False, True])
def test_equals_brute_force(spark, monkeypatch, small):
    if small:  # many tiles and slices
        for name, value in (("ROW_BLOCK", 100), ("ANCHOR_BLOCK", 5), ("SLICE_A", 2), ("SLICE_B", 30), ("PANEL", 3)):
            monkeypatch.setattr(negatives, name, value)
    rows = vectors(3)
    got = sorted(map(tuple, negatives.hard_negatives(frame(spark, rows)).collect()))
    assert got == brute(rows)
    assert len(got) > 20


def test_ties_repeats_nulls_and_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (3, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (4, [0.75, 0.5], 2), (5, [0.75, -0.5], 2), (6, [0.75], 2),
            (8, [0.75, 0.0, 3.0], 2), (9, [], 2), (10, [0.5], 3), (11, [nan, 1.0], 2), (12, [inf], 2), (13, [None, 1.0], 2),
            (None, [0.9], 2), (14, None, 2), (15, [0.9], None), (50, [], 4), (100, [-1.0], 1), (6, [0.75], 2), (150, [0.1], 9)]
    got = sorted(map(tuple, negatives.hard_negatives(frame(spark, rows)).collect()))
    assert got == brute(rows)
    assert (0, 2, 1, 4, 65536, 49152) in got  # equal scores: the smaller id first
    assert negatives.hard_negatives(frame(spark, [])).collect() == []


def test_large_components_are_exact(spark):
    big = 3.0e6
    rows = [(0, [big, 1.0], 1), (1, [big, 2.0], 1), (2, [big * 0.75, 1.0], 2), (3, [big * 0.75, 1.5], 2)]
    assert sorted(map(tuple, negatives.hard_negatives(frame(spark, rows)).collect())) == brute(rows)


def test_suffixes_under_the_threshold_are_not_indexed():
    """Rows whose whole norm cannot reach the threshold drop out; results stay those of a full scan."""
    rng = np.random.default_rng(1)
    x = np.floor(rng.normal(size=(5, 16)) * 100)
    y = np.floor(rng.normal(size=(400, 16)) * 100 * rng.choice([0.01, 1.0], size=(400, 1)))
    xn, yn = negatives.suffix_norms(x), negatives.suffix_norms(y)
    full = x @ y.T
    for part in (0.2, 0.5, 0.9):
        least = part * full.max(axis=1)
        a, b, s = negatives.threshold_join(x, xn, y, yn, least, np.ones(full.shape, bool))
        assert sorted(zip(a, b, s)) == sorted((i, j, full[i, j]) for i, j in zip(*np.nonzero(full >= least[:, None])))
