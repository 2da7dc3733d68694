"""Operator 11 against brute force, and its edge cases."""

import itertools
import random

import numpy as np
import pytest

from arenaspark.llm import jaccard

SCHEMA = "doc_id bigint, text string, n bigint, digest string, s string, t string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x", "y", "z") for i, t in rows], SCHEMA)


def shingles(text, k=5):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\x0b\x0c\r":
        w = w.replace(space, " ")
    w = [x for x in w.split(" ") if x]
    if len(w) < k:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}


def brute(rows, percent=80, k=5):
    sets = {i: shingles(t, k) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            p, q = sorted((find(a), find(b)))
            root[q] = p
    return sorted((i, len(s), find(i)) for i, s in sets.items())


def corpus(seed):
    """Chains and stars of edited copies around 0.8, a passage that all share, short and empty texts."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passage = rng.choices(words, k=30)
    texts = ["", None, " \t\n", "one two", "ONE two", "one two three four five", "One two three four five six"]
    for _ in range(6):
        base = rng.choices(words, k=rng.randint(20, 90)) + passage
        texts.append(" ".join(base))
        for _ in range(12):
            copy = list(rng.choice([base, texts[-1].split()]))
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = f"e{rng.random()}"
            texts.append(" ".join(copy + rng.choices(words, k=rng.choice([0, 0, 5, 20]))))
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed, percent, k", [(1, 80, 5), (2, 80, 5), (3, 60, 3), (4, 95, 2)])
def test_classes_equal_brute_force(spark, seed, percent, k):
    rows = corpus(seed)
    got = jaccard.jaccard_classes(frame(spark, rows), shingle=k, percent=percent)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, got.collect())) == brute(rows, percent, k)


def test_exact_threshold_is_a_link(spark):
    # 9 and 9 shingles, 8 in common: 8 of 10; then 7 of 11
    a, b, c = "a b c d e f g h i j k l m", "b c d e f g h i j k l m n", "c d e f g h i j k l m n o"
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_classes(frame(spark, [(3, a), (5, b), (9, c), (7, a + " p q r s")])).collect()}
    assert got == {3: 3, 5: 3, 9: 3, 7: 7}


def test_null_ids_repeated_rows_and_empty_table(spark):
    text = " ".join(f"w{i}" for i in range(30))
    near = text.replace("w29", "x")
    rows = [(None, text), (8, near), (8, near), (None, None), (4, ""), (None, "lone words here")]
    got = sorted(map(tuple, jaccard.jaccard_classes(frame(spark, rows)).collect()), key=str)
    assert got == sorted([(None, 26, 8), (8, 26, 8), (8, 26, 8), (None, 0, None), (4, 0, 4), (None, 1, None)], key=str)
    assert jaccard.jaccard_classes(frame(spark, [])).collect() == []


def test_group_of_near_copies_is_not_expanded(spark):
    """300 copies with one edit each: candidates stay in proportion to the rows, and the class is whole."""
    rng = random.Random(7)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(300):
        copy = list(base)
        copy[rng.randrange(120)] = f"e{i}"
        rows.append((i + 10, " ".join(copy)))
    sizes = []
    verified = jaccard._verified
    try:
        jaccard._verified = lambda pairs, *rest: (sizes.append(pairs.count()), verified(pairs, *rest))[1]
        got = {r.component_id for r in jaccard.jaccard_classes(frame(spark, rows)).collect()}
    finally:
        jaccard._verified = verified
    assert got == {10}
    assert sum(sizes) < 20 * len(rows)


def test_very_long_text_is_read_whole():
    a = jaccard.shingle_set(b" ".join(b"w%d" % i for i in range(200_000)))
    b = jaccard.shingle_set(b" ".join(b"w%d" % i for i in range(200_000)) + b" tail")
    assert len(a) == 199_996 and len(b) == 199_997 and len(np.intersect1d(a, b)) == 199_996


def test_parameters_are_checked(spark):
    with pytest.raises(ValueError):
        jaccard.jaccard_classes(frame(spark, []), percent=0)
