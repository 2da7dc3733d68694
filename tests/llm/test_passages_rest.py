"""The last round of operator 9: which texts meet, against the aligner, and how many."""

import random

import numpy as np

from arenaspark.llm import passages
from test_decontam_passages import docs, words


def met(codes_a, codes_b):
    """What the join of the surroundings lets through."""
    z = codes_a ^ codes_b
    other = (((z[:, :, None] >> np.arange(0, 64, 4, dtype=np.uint64)) & np.uint64(15)) != 0).reshape(len(z), 2, -1)
    beside = np.minimum(other[:, :, :30].sum(2).min(1), other[:, :, :15].sum((1, 2)))
    return (beside <= passages.MOST_OTHER) & (other.sum((1, 2)) <= 2 * passages.AROUND + passages.SEED_WORDS - passages.LEAST_SAME)


def test_no_passage_is_kept_from_the_aligner():
    """Passages with words changed, left out and put in: around one of their seeds, or over two, all pass the filters."""
    rng, hasher = random.Random(3), passages.WordHasher()
    vocabulary = words(rng, 300)
    found = 0
    for _ in range(1200):
        part = rng.choices(vocabulary, k=rng.choice((45, 50, 52, 60, 80, 120, 200)))
        change, move, other = rng.choice((0, .05, .1, .15, .2)), rng.choice((0, 0, .02, .05)), []
        for w in part:
            x = rng.random()
            other += [rng.choice(vocabulary)] if x < change else [] if x < change + move / 2 else \
                [w, rng.choice(vocabulary)] if x < change + move else [w]
        a, b = (hasher(" ".join(rng.choices(vocabulary, k=rng.randint(0, 90)) + p + rng.choices(vocabulary, k=rng.randint(0, 90))))
                for p in (part, other))
        (sa, pa, _), (sb, pb, _) = passages.seeds(a), passages.seeds(b)
        x, y = (o[np.lexsort((pa[np.nonzero(sa[:, None] == sb)[0]],))] for o in
                (pa[np.nonzero(sa[:, None] == sb)[0]], pb[np.nonzero(sa[:, None] == sb)[1]]))
        if not len(x) or not passages.align(a, b):
            continue
        found += 1
        left, right = passages.surrounding_codes(a, x), passages.surrounding_codes(b, y)
        kept = (met(left, right) & passages.diagonal_passage(left, right)).any()
        dx, dy = x - x[:, None], y - y[:, None]
        i, j = np.nonzero((dx > 0) & (dy > 0) & (dx <= passages.NEAR) & (dy <= passages.NEAR) & (dx != dy))
        if not kept and len(i):
            one, two = passages.near_codes(a, x[i]), passages.near_codes(b, y[i])
            kept = (passages.shifted_passage(one, two, dx[i, j]) & passages.shifted_passage(two, one, dy[i, j])).any()
        assert kept
    assert found > 400


def test_surroundings_of_texts_at_their_ends():
    hasher = passages.WordHasher()
    p = words(random.Random(1), 60)
    left, right = (passages.surrounding_codes(hasher(" ".join(t)), np.array([0, 55])) for t in (p, p[:59] + ["other"]))
    assert left.shape == (2, 8) and (left[0, :4] == 0).all() and (left[1, 4:] == 0).all()
    assert (left[0, :7] == right[0, :7]).all() and left[0, 7] != right[0, 7]
    assert passages.diagonal_passage(left, left).all()


def test_a_line_at_both_ends_of_many_texts_makes_no_square(spark, monkeypatch):
    """150 texts with one short line before and after their own words: all have two far seeds in common, and no passage."""
    rng = random.Random(17)
    line, part = words(rng, 13), words(rng, 55)
    rows = [(i, " ".join(line + words(rng, 40 + rng.randint(0, 60)) + line)) for i in range(150)]
    for i in (20, 90):  # and a passage of two of them
        rows[i] = (i, " ".join(line + words(rng, 30) + part + words(rng, 30) + line))
    held = {}
    write = passages.shared_table

    def counted(df, name):
        out = write(df, name)
        held[name] = out.count()
        return out
    monkeypatch.setattr(passages, "shared_table", counted)
    got = {r.doc_id: r.class_id for r in passages.repeated_passages(docs(spark, rows)).collect()}
    assert got == {20: 20, 90: 20}
    assert held["rest-pairs"] < 150  # 150 * 149 / 2 when two seeds far apart were enough
